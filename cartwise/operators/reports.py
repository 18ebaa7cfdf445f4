"""Reports over predictions, metrics and importances."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwise import config
from cartwise.functions.expressions import seeded_key
from cartwise.functions.quantiles import union_all
from cartwise.operators.submission import top_customers_by_score

# Earlier results that new ones are compared with (fixed values).
DEFAULT_BOOSTING = {("precision", 10): 0.0412, ("ndcg", 10): 0.1190}
WITH_HISTORY = {("precision", 10): 0.0415, ("ndcg", 10): 0.1195}
IMPORTANT_BELOW = -5.0
NOT_IMPORTANT_ABOVE = 5.0


# --- predictions ------------------------------------------------------------


def prediction_overview(predictions: DataFrame) -> DataFrame:
    """Rows, customers, items and the mean, extremes and spread of the score."""
    return predictions.agg(
        F.count(F.lit(1)).alias("n_predictions"),
        F.count_distinct("customer_id").alias("n_customers"),
        F.count_distinct("item_id").alias("n_items"),
        F.avg("score").alias("mean_score"),
        F.stddev_samp("score").alias("std_score"),
        F.min("score").alias("min_score"),
        F.max("score").alias("max_score"),
    )


def top_recommended(predictions: DataFrame, n: int = 20) -> DataFrame:
    """The ``n`` items recommended most, with mean score and rank."""
    return (
        predictions.groupBy("item_id")
        .agg(
            F.count(F.lit(1)).alias("num_recommendations"),
            F.avg("score").alias("avg_score"),
            F.avg("rank").alias("avg_rank"),
        )
        .orderBy(F.desc("num_recommendations"), "item_id")
        .limit(n)
    )


def rank_distribution(predictions: DataFrame) -> DataFrame:
    """Rows per rank."""
    return predictions.groupBy("rank").agg(F.count(F.lit(1)).alias("n")).orderBy("rank")


def recs_per_customer(predictions: DataFrame) -> DataFrame:
    """Rows per customer."""
    return predictions.groupBy("customer_id").agg(F.count(F.lit(1)).alias("n"))


def item_rec_frequency(predictions: DataFrame) -> DataFrame:
    """Rows per item, most first."""
    counts = predictions.groupBy("item_id").agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.desc("n"), "item_id")


def _drawn(customers: DataFrame, n: int, seed: int, method: str) -> DataFrame:
    key = seeded_key(F.col("customer_id"), seed, method)
    return customers.select("customer_id").distinct().orderBy(key, "customer_id").limit(n)


def sample_customer_recs(
    predictions: DataFrame,
    n: int = 3,
    top_k: int = 10,
    seed: int = config.RANDOM_STATE,
    method: str = "xxhash64",
) -> DataFrame:
    """The best ``top_k`` predictions of ``n`` drawn customers."""
    drawn = _drawn(predictions, n, seed, method)
    return predictions.where(F.col("rank") <= top_k).join(drawn, "customer_id", "left_semi")


def overview_counts(
    predictions: DataFrame, ground_truth: DataFrame, n_features: int = len(config.FEATURE_COLUMNS)
) -> DataFrame:
    """Predictions, customers with a ground truth, features."""
    truth = ground_truth.agg(F.count_distinct("customer_id")).scalar()
    return predictions.agg(F.count(F.lit(1)).alias("total_predictions")).select(
        "total_predictions",
        truth.alias("total_customers"),
        F.lit(n_features).cast("long").alias("num_features"),
    )


# --- single cases -----------------------------------------------------------


def mark_hits(predictions: DataFrame, ground_truth: DataFrame) -> DataFrame:
    """Predictions with ``is_hit``: whether the customer bought the item."""
    truth = ground_truth.select("customer_id", "item_id").distinct().withColumn("__t", F.lit(1))
    return predictions.join(truth, ["customer_id", "item_id"], "left").withColumn(
        "is_hit", F.col("__t").isNotNull()
    ).drop("__t")


def case_status(hits: Column) -> Column:
    """EXCELLENT from 7 hits, GOOD from 4, FAIR below."""
    return F.when(hits >= 7, "EXCELLENT").when(hits >= 4, "GOOD").otherwise("FAIR")


def customer_cases(predictions: DataFrame, ground_truth: DataFrame, k: int = 10) -> DataFrame:
    """Per customer with predictions and purchases: purchases, hits, precision, status.

    A customer's list holds at most ``k`` items; its purchases meet the list on
    the customer id.
    """
    lists = (
        predictions.where(F.col("rank") <= k)
        .groupBy("customer_id")
        .agg(F.collect_set("item_id").alias("listed"))
    )
    return (
        ground_truth.select("customer_id", "item_id")
        .distinct()
        .join(lists, "customer_id")
        .groupBy("customer_id")
        .agg(
            F.count(F.lit(1)).alias("n_actual"),
            F.count_if(F.array_contains("listed", F.col("item_id"))).alias("hits"),
        )
        .select(
            "customer_id",
            "n_actual",
            "hits",
            (F.col("hits") / F.lit(k)).alias("precision"),
            case_status(F.col("hits")).alias("status"),
        )
    )


def case_best_worst(
    predictions: DataFrame,
    ground_truth: DataFrame,
    k: int = 10,
    min_actual: int = 2,
) -> DataFrame:
    """The customers with the highest and lowest precision: two rows, ``case`` and figures.

    Of all customers with ``min_actual`` purchases.
    """
    cases = customer_cases(predictions, ground_truth, k)
    cases = cases.where(F.col("n_actual") >= min_actual)
    # best: a positive precision; worst: one below 1. The lower id wins a tie.
    row = F.struct("customer_id", "n_actual", "hits", "precision", "status")
    ends = cases.agg(
        F.min_by(
            F.when(F.col("precision") > 0, row), F.struct(-F.col("hits"), F.col("customer_id"))
        ).alias("best"),
        F.min_by(
            F.when(F.col("precision") < 1, row), F.struct(F.col("hits"), F.col("customer_id"))
        ).alias("worst"),
    )
    entries = F.array(
        F.struct(F.lit("best").alias("case"), F.col("best").alias("row")),
        F.struct(F.lit("worst").alias("case"), F.col("worst").alias("row")),
    )
    return ends.select(F.inline(entries)).where(F.col("row").isNotNull()).select("case", "row.*")


def case_random(
    predictions: DataFrame,
    ground_truth: DataFrame,
    k: int = 10,
    seed: int = config.RANDOM_STATE,
    method: str = "xxhash64",
) -> DataFrame:
    """One drawn customer with its hits, precision and status."""
    cases = customer_cases(predictions, ground_truth, k)
    key = seeded_key(F.col("customer_id"), seed, method)
    return cases.orderBy(key, "customer_id").limit(1)


# --- customers by behaviour -------------------------------------------------


def _with_share(counts: DataFrame) -> DataFrame:
    total = counts.agg(F.sum("n_customers")).scalar()
    return counts.withColumn("pct", F.col("n_customers") / total * 100)


def purchase_count_distribution(transactions: DataFrame, last: int = 15) -> DataFrame:
    """Customers by number of purchases, those above ``last`` together."""
    per_customer = transactions.groupBy("customer_id").agg(F.count(F.lit(1)).alias("n"))
    bucket = F.when(F.col("n") > last, F.lit(f">{last}")).otherwise(F.col("n").cast("string"))
    counts = per_customer.groupBy(bucket.alias("n_purchases")).agg(
        F.count(F.lit(1)).alias("n_customers")
    )
    return _with_share(counts)


def precision_tiers(cases: DataFrame) -> DataFrame:
    """Customers by precision: above 0.5, 0.1 to 0.5, below 0.1."""
    p = F.col("precision")
    tier = F.when(p > 0.5, "above 0.5").when(p >= 0.1, "0.1 to 0.5").otherwise("below 0.1")
    counts = cases.groupBy(tier.alias("tier")).agg(F.count(F.lit(1)).alias("n_customers"))
    return _with_share(counts)


def precision_by_loyalty(
    cases: DataFrame, top_brand_ratio: DataFrame, high: float = 0.7, low: float = 0.3
) -> DataFrame:
    """Mean precision of customers with a high, a low and a medium share of their top
    brand. ``top_brand_ratio`` is ``(customer_id, X8_top_brand_ratio)``."""
    x8 = F.col(config.FEATURE_COLUMNS[7])
    band = F.when(x8 > high, "high").when(x8 < low, "low").otherwise("medium")
    return (
        cases.join(top_brand_ratio, "customer_id")
        .groupBy(band.alias("loyalty"))
        .agg(F.count(F.lit(1)).alias("n_customers"), F.avg("precision").alias("precision"))
    )


def coverage_tradeoff(
    predictions: DataFrame, cases: DataFrame, cut_offs: Sequence[int]
) -> DataFrame:
    """For each cut-off: customers submitted (highest mean scores first), those of them
    with purchases, and the mean precision of these.

    Each cut-off is a top-n of customer means, so no global ranking is needed.
    """
    rows = []
    for n in cut_offs:
        kept = top_customers_by_score(predictions, n).select("customer_id")
        rows.append(
            kept.join(cases.select("customer_id", "precision"), "customer_id", "left").agg(
                F.lit(n).cast("long").alias("cut_off"),
                F.count(F.lit(1)).alias("n_customers"),
                F.count("precision").alias("n_with_purchases"),
                F.avg("precision").alias("precision"),
            )
        )
    return union_all(rows)


def truth_coverage(predictions: DataFrame, ground_truth: DataFrame) -> DataFrame:
    """Customers of the ground truth, those with predictions, and their share in percent."""
    predicted = predictions.select("customer_id").distinct().withColumn("__p", F.lit(1))
    joined = ground_truth.select("customer_id").distinct().join(predicted, "customer_id", "left")
    return joined.agg(
        F.count(F.lit(1)).alias("n_truth"),
        F.count("__p").alias("n_predicted"),
        (F.count("__p") / F.count(F.lit(1)) * 100).alias("coverage_pct"),
    )


# --- importances ------------------------------------------------------------


def importance_pct(importance: DataFrame, n: int = 10) -> DataFrame:
    """Importances as shares of their sum in percent, the ``n`` highest."""
    total = importance.agg(F.sum("importance")).scalar()
    share = F.when(total > 0, F.col("importance") / total * 100).otherwise(F.lit(0.0))
    return (
        importance.select("feature", "importance", share.alias("pct"))
        .orderBy(F.desc("importance"), "feature")
        .limit(n)
    )


# --- comparing results ------------------------------------------------------

# (metric, k) shown per feature set, as column names.
_TABLE = {
    "p5": ("precision", 5),
    "p10": ("precision", 10),
    "p20": ("precision", 20),
    "r10": ("recall", 10),
    "r20": ("recall", 20),
    "ndcg10": ("ndcg", 10),
    "map10": ("map", 10),
}


def compare_feature_sets(metrics: DataFrame) -> DataFrame:
    """One row per feature set with its main figures, missing ones 0, smallest set first.

    ``metrics`` is ``(feature_count, metric, k, value)``.
    """

    def pick(metric: str, k: int) -> Column:
        return F.max(F.when((F.col("metric") == metric) & (F.col("k") == k), F.col("value")))

    cells = [F.coalesce(pick(*v), F.lit(0.0)).alias(c) for c, v in _TABLE.items()]
    return metrics.groupBy("feature_count").agg(*cells).orderBy("feature_count")


def _change_pct(value: Column, base: Column) -> Column:
    return F.when(base > 0, (value - base) / base * 100).otherwise(F.lit(0.0))


def improvement_vs_baseline(metrics: DataFrame) -> DataFrame:
    """Change of precision, recall and ndcg at 10 against the smallest feature set in percent."""
    table = compare_feature_sets(metrics)
    columns = ("p10", "r10", "ndcg10")
    first = table.agg(
        F.min_by(F.struct("feature_count", *columns), "feature_count").alias("b")
    ).scalar()
    with_base = table.withColumn("__b", first)
    return with_base.where(F.col("feature_count") > F.col("__b.feature_count")).select(
        "feature_count",
        (F.col("feature_count") - F.col("__b.feature_count")).alias("added_features"),
        *columns,
        *[_change_pct(F.col(c), F.col(f"__b.{c}")).alias(f"{c}_change_pct") for c in columns],
    )


def impact_class(change_pct: Column) -> Column:
    """What leaving features out did: below -5 % important, above 5 % not, minor between."""
    return (
        F.when(change_pct < IMPORTANT_BELOW, "important")
        .when(change_pct > NOT_IMPORTANT_ABOVE, "not important")
        .otherwise("minor")
    )


def improvement_vs_constants(
    metrics: DataFrame, reference: dict[tuple[str, int], float]
) -> DataFrame:
    """Change in percent against earlier figures, with the impact class of each."""
    base = None
    for (metric, k), value in reference.items():
        hit = (F.col("metric") == metric) & (F.col("k") == k)
        base = F.when(hit, F.lit(value)) if base is None else base.when(hit, F.lit(value))
    change = _change_pct(F.col("value"), F.col("reference"))
    return (
        metrics.withColumn("reference", base)
        .where(F.col("reference").isNotNull())
        .withColumn("change_pct", change)
        .withColumn("impact", impact_class(F.col("change_pct")))
    )


def comparison_summary(metrics: DataFrame, compared_at: str) -> DataFrame:
    """One record: date, number of sets and the array of their rows (one per set)."""
    names = F.create_map(
        *[F.lit(x) for pair in config.FEATURE_SET_NAMES.items() for x in pair]
    )
    rows = compare_feature_sets(metrics).withColumn(
        "feature_set", F.try_element_at(names, F.col("feature_count"))
    )
    entry = F.struct("feature_count", "feature_set", *_TABLE)
    return rows.agg(
        F.lit(compared_at).alias("comparison_date"),
        F.count(F.lit(1)).alias("models_compared"),
        F.sort_array(F.collect_list(entry)).alias("results"),
    )


def metric_curves(metrics: DataFrame) -> DataFrame:
    """Precision and ndcg by k of every metrics file."""
    curves = metrics.where(F.col("metric").isin("precision", "ndcg"))
    return curves.select("file_name", "metric", "k", "value").orderBy("file_name", "metric", "k")
