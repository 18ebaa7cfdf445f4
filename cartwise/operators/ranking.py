"""Scores to ranks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def rank_topk(
    scored: DataFrame,
    top_k: int | None = None,
    user_col: str = "customer_id",
    item_col: str = "item_id",
    score_col: str = "score",
) -> DataFrame:
    """``rank`` 1..n per user by falling score, equal scores by item id.

    With ``top_k`` every task keeps the best k rows per user before the shuffle.
    """
    order = Window.partitionBy(user_col).orderBy(F.desc(score_col), F.asc(item_col))
    ranked = scored.withColumn("rank", F.row_number().over(order))
    return ranked if top_k is None else ranked.where(F.col("rank") <= top_k)


def linear_score(weights: dict[str, float]) -> Column:
    """A fixed weighted sum, added in the order of ``weights``."""
    terms = [F.col(c).cast("double") * F.lit(float(w)) for c, w in weights.items()]
    total = terms[0]
    for term in terms[1:]:
        total = total + term
    return total
