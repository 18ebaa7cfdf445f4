"""Ranking metrics.

Three populations are kept apart, as they give different averages:

``both``       users with predictions and with purchases (:func:`evaluate_recommendations`);
``predicted``  every user with predictions; no purchases count as 0 (:func:`evaluate_ranking`);
``truth``      users with purchases and predictions, precision over the list that
               is actually there (:func:`evaluate_ground_truth`).

All of them rank once, to the largest k. A user's predictions are an array of at
most that many items; the purchases are joined to it on the user and every
metric at every k is a conditional sum over the joined rows, which are already
partitioned by user.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwise import config
from cartwise.operators.ranking import rank_topk


def _pairs(df: DataFrame, user_col: str, item_col: str, id_type: str | None) -> DataFrame:
    user, item = F.col(user_col), F.col(item_col)
    if id_type:
        user, item = user.cast(id_type), item.cast(id_type)
    return df.select(user.alias("user"), item.alias("item")).distinct()


def _lists(ranked: DataFrame, id_type: str | None = None) -> DataFrame:
    """One row per user: items and ranks in rank order."""
    item = F.col("item").cast(id_type) if id_type else F.col("item")
    user = F.col("user").cast(id_type) if id_type else F.col("user")
    ordered = F.sort_array(F.collect_list(F.struct("rank", item.alias("item"))))
    return (
        ranked.groupBy(user.alias("user"))
        .agg(ordered.alias("list"))
        .select("user", F.col("list.item").alias("items"), F.col("list.rank").alias("ranks"))
    )


def _ideal_gain(k: int, n: Column) -> Column:
    """Best possible gain with ``n`` relevant items: a lookup in k + 1 constants."""
    sums = [0.0]
    for r in range(1, k + 1):
        sums.append(sums[-1] + 1.0 / math.log2(r + 1))
    table = F.expr(f"array({', '.join(f'{v!r}D' for v in sums)})")
    return F.element_at(table, (F.least(n, F.lit(k)) + 1).cast("int"))


def _ranks_up_to(k: int) -> Column:
    return F.size(F.filter("ranks", lambda r: r <= k))


def _per_user(lists: DataFrame, truth: DataFrame, how: str, ks: Sequence[int]) -> DataFrame:
    """Per user: relevant items and, for each k, predicted, hits, gain and precision sum."""
    position = F.when(
        F.col("item").isNotNull(), F.array_position(F.col("items"), F.col("item"))
    )
    joined = (
        lists.join(truth, "user", how)
        .withColumn("place", F.nullif(position, F.lit(0)))
        .withColumn("rank", F.try_element_at(F.col("ranks"), F.col("place").cast("int")))
    )
    aggs = [F.count("item").alias("n_relevant")]
    for k in ks:
        hit = F.col("rank") <= k
        gain = 1.0 / F.log2(F.col("rank") + F.lit(1.0))
        aggs += [
            F.count_if(hit).alias(f"hits_{k}"),
            F.coalesce(F.sum(F.when(hit, gain)), F.lit(0.0)).alias(f"gain_{k}"),
            F.max(_ranks_up_to(k)).alias(f"listed_{k}"),
        ]
    # The hit ranks of one user: at most max(ks) entries.
    aggs.append(F.sort_array(F.collect_list("rank")).alias("hit_ranks"))
    out = joined.groupBy("user").agg(*aggs)
    precisions = F.transform("hit_ranks", lambda r, i: (i + 1) / r)
    out = out.withColumn("hit_precisions", precisions)
    for k in ks:
        first_hits = F.slice("hit_precisions", F.lit(1), F.col(f"hits_{k}").cast("int"))
        total = F.aggregate(first_hits, F.lit(0.0), lambda a, p: a + p)
        out = out.withColumn(f"precision_sum_{k}", total)
    return out


def _long(one_row: DataFrame, metrics: Sequence[str], ks: Sequence[int]) -> DataFrame:
    entries = F.array(
        *[
            F.struct(
                F.lit(m).alias("metric"),
                F.lit(k).alias("k"),
                F.coalesce(F.col(f"{m}_{k}"), F.lit(0.0)).alias("value"),
            )
            for m in metrics
            for k in ks
        ]
    )
    return one_row.select(F.inline(entries))


def _ratio(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def evaluate_recommendations(
    predictions: DataFrame,
    ground_truth: DataFrame,
    k_values: Sequence[int] = config.DEFAULT_K_VALUES,
    user_col: str = "customer_id",
    item_col: str = "item_id",
    score_col: str = "score",
) -> DataFrame:
    """precision, recall, ndcg and map at every k over users on both sides: ``(metric, k, value)``."""
    ks = list(k_values)
    top = rank_topk(predictions, max(ks), user_col, item_col, score_col).select(
        F.col(user_col).alias("user"), F.col(item_col).alias("item"), "rank"
    )
    users = _per_user(_lists(top), _pairs(ground_truth, user_col, item_col, None), "inner", ks)
    n = F.col("n_relevant")
    means = []
    for k in ks:
        hits = F.col(f"hits_{k}")
        means += [
            F.avg(hits / F.lit(k)).alias(f"precision_{k}"),
            F.avg(_ratio(hits, n)).alias(f"recall_{k}"),
            F.avg(F.col(f"gain_{k}") / _ideal_gain(k, n)).alias(f"ndcg_{k}"),
            F.avg(F.col(f"precision_sum_{k}") / F.least(n, F.lit(k))).alias(f"map_{k}"),
        ]
    return _long(users.agg(*means), ("precision", "recall", "ndcg", "map"), ks)


def _one_metric(metric: str, predictions, ground_truth, k, user_col, item_col, score_col):
    everything = evaluate_recommendations(
        predictions, ground_truth, [k], user_col, item_col, score_col
    )
    return everything.where(F.col("metric") == metric)


def precision_at_k(
    predictions: DataFrame,
    ground_truth: DataFrame,
    k: int,
    user_col: str = "customer_id",
    item_col: str = "item_id",
    score_col: str = "score",
) -> DataFrame:
    """Hits over k, averaged over users on both sides (one row)."""
    return _one_metric("precision", predictions, ground_truth, k, user_col, item_col, score_col)


def recall_at_k(
    predictions: DataFrame,
    ground_truth: DataFrame,
    k: int,
    user_col: str = "customer_id",
    item_col: str = "item_id",
    score_col: str = "score",
) -> DataFrame:
    """Hits over the user's distinct purchases."""
    return _one_metric("recall", predictions, ground_truth, k, user_col, item_col, score_col)


def ndcg_at_k(
    predictions: DataFrame,
    ground_truth: DataFrame,
    k: int,
    user_col: str = "customer_id",
    item_col: str = "item_id",
    score_col: str = "score",
) -> DataFrame:
    """Discounted gain of the hits over the best possible gain."""
    return _one_metric("ndcg", predictions, ground_truth, k, user_col, item_col, score_col)


def mean_average_precision_at_k(
    predictions: DataFrame,
    ground_truth: DataFrame,
    k: int,
    user_col: str = "customer_id",
    item_col: str = "item_id",
    score_col: str = "score",
) -> DataFrame:
    """Precision at every hit, summed, over min(purchases, k)."""
    return _one_metric("map", predictions, ground_truth, k, user_col, item_col, score_col)


def evaluate_ranking(
    predictions: DataFrame,
    ground_truth: DataFrame,
    k_values: Sequence[int] = config.DEFAULT_K_VALUES,
    user_col: str = "customer_id",
    item_col: str = "item_id",
) -> DataFrame:
    """precision and ndcg at every k over all users with predictions, by given ranks."""
    ks = list(k_values)
    top = predictions.where(F.col("rank") <= max(ks)).select(
        F.col(user_col).alias("user"), F.col(item_col).alias("item"), "rank"
    )
    users = _per_user(_lists(top), _pairs(ground_truth, user_col, item_col, None), "left", ks)
    means = []
    for k in ks:
        ideal = _ideal_gain(k, F.col("n_relevant"))
        means += [
            F.avg(F.col(f"hits_{k}") / F.lit(k)).alias(f"precision_{k}"),
            F.avg(_ratio(F.col(f"gain_{k}"), ideal)).alias(f"ndcg_{k}"),
        ]
    return _long(users.agg(*means), ("precision", "ndcg"), ks)


def evaluate_ground_truth(
    predictions: DataFrame,
    ground_truth: DataFrame,
    k_values: Sequence[int] = config.DEFAULT_K_VALUES,
    user_col: str = "customer_id",
    item_col: str = "item_id",
) -> DataFrame:
    """precision, recall, ndcg and f1 over users with purchases and predictions.

    Ids are compared as text. k only filters the ranks that are there: lists cut
    at 10 have the same hits at 20. Precision divides by the listed items; f1 is
    taken from the averaged precision and recall.
    """
    ks = list(k_values)
    top = predictions.where(F.col("rank") <= max(ks)).select(
        F.col(user_col).alias("user"), F.col(item_col).alias("item"), "rank"
    )
    truth = _pairs(ground_truth, user_col, item_col, "string")
    users = _per_user(_lists(top, "string"), truth, "inner", ks)
    n = F.col("n_relevant")
    means = []
    for k in ks:
        hits, listed = F.col(f"hits_{k}"), F.col(f"listed_{k}")
        present = listed > 0
        means += [
            F.avg(F.when(present, hits / listed)).alias(f"precision_{k}"),
            F.avg(F.when(present, hits / n)).alias(f"recall_{k}"),
            F.avg(F.when(present, F.col(f"gain_{k}") / _ideal_gain(k, n))).alias(f"ndcg_{k}"),
        ]
    averaged = users.agg(*means)
    for k in ks:
        p, r = F.col(f"precision_{k}"), F.col(f"recall_{k}")
        averaged = averaged.withColumn(f"f1_{k}", _ratio(2 * p * r, p + r))
    return _long(averaged, ("precision", "recall", "ndcg", "f1"), ks)


def ground_truth_pairs(ground_truth: DataFrame) -> DataFrame:
    """``(customer_id, item_id)`` pairs, both as text, of a table of item lists.

    ``items`` is an array of ids, an array of such arrays (the first one counts),
    or JSON text of either. Text that is no list is skipped.
    """
    kind = dict(ground_truth.dtypes)["items"]
    if kind == "string":
        text = F.trim("items")
        nested = F.from_json(text, "array<array<string>>")
        flat = F.from_json(text, "array<string>")
        ids = F.when(text.rlike(r"^\[\s*\["), F.get(nested, F.lit(0))).when(
            text.startswith("["), flat
        )
    elif kind.startswith("array<array<"):
        ids = F.get(F.col("items"), F.lit(0)).cast("array<string>")
    else:
        ids = F.col("items").cast("array<string>")
    return (
        ground_truth.select(
            F.col("customer_id").cast("string").alias("customer_id"),
            F.explode(ids).alias("item_id"),
        )
        .where(F.col("item_id").isNotNull())
        .distinct()
    )
