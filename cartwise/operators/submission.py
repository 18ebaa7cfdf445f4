"""Recommendation lists for submission."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwise.functions.quantiles import nth_smallest, value_counts, values_at_ranks
from cartwise.session import materialize

MAX_CUSTOMERS = 100_000
LIST_LENGTH = 10
# Bounds of the upload size in MiB.
TOO_LARGE_MB = 90
TOO_SMALL_MB = 8


def top_customers_by_score(predictions: DataFrame, n: int = MAX_CUSTOMERS) -> DataFrame:
    """The ``n`` customers with the highest mean score: ``(customer_id, avg_score)``.

    Equal means go by the lower id; a mean of no scores is below all others, a null id is no
    customer. The n-th mean, and the n-th id among those who have it, are exact order
    statistics; the rest is a filter. No task merges the best n of all others.
    """
    if n < 1:
        raise ValueError("n must be 1 or more")
    known = predictions.where(F.col("customer_id").isNotNull())
    means = materialize(known.groupBy("customer_id").agg(F.avg("score").alias("avg_score")), "mean-scores")
    total = means.count()
    if total <= n:
        return means
    mean = F.coalesce("avg_score", F.lit(float("-inf")))
    counts = value_counts(means.select(F.lit("mean").alias("metric"), mean.alias("value")))
    last = values_at_ranks(counts, F.array(F.lit(total - n).cast("long"))).first()["value"]
    above = means.where(mean > F.lit(last))
    left = n - above.count()
    equal = means.where(mean == F.lit(last))
    end = nth_smallest(equal, F.col("customer_id"), F.lit(left)).first()["value"]
    return above.unionByName(equal.where(F.col("customer_id") <= F.lit(end)))


def keep_top_customers(predictions: DataFrame, n: int = MAX_CUSTOMERS) -> DataFrame:
    """Predictions of the :func:`top_customers_by_score`."""
    return predictions.join(top_customers_by_score(predictions, n), "customer_id", "left_semi")


def submission_lists(predictions: DataFrame, length: int = LIST_LENGTH) -> DataFrame:
    """Per customer (id as text) the items of the first ``length`` ranks, in order."""
    entries = F.sort_array(F.collect_list(F.struct("rank", "item_id")))
    return (
        predictions.where(F.col("rank") <= length)
        .groupBy("customer_id")
        .agg(entries.alias("list"))
        .select(
            F.col("customer_id").cast("string").alias("customer_id"),
            F.col("list.item_id").alias("items"),
        )
    )


def submission_lines(lists: DataFrame) -> DataFrame:
    """One compact JSON object per customer: ``{"id":[items]}``."""
    entry = F.to_json(F.create_map("customer_id", "items"))
    return lists.select(entry.alias("value"))


def write_submission(lists: DataFrame, path: str) -> None:
    """JSON lines, written by all tasks in parallel."""
    submission_lines(lists).write.mode("overwrite").text(path)


def submission_size(lists: DataFrame) -> DataFrame:
    """Customers, size in MiB of the lines with their line ends, and a verdict."""
    size = F.coalesce(F.sum(F.octet_length("value") + 1), F.lit(0)) / F.lit(1024.0 * 1024.0)
    mb = F.col("size_mb")
    verdict = (
        F.when(mb > TOO_LARGE_MB, "too large")
        .when(mb < TOO_SMALL_MB, "might be too small")
        .otherwise("ok")
    )
    return (
        submission_lines(lists)
        .agg(F.count(F.lit(1)).alias("n_customers"), size.alias("size_mb"))
        .withColumn("verdict", verdict)
    )


def prediction_coverage(predictions: DataFrame, valid_customers: DataFrame) -> DataFrame:
    """Prediction rows and customers, before and after keeping the valid customers.

    One row per customer carries its prediction count, so both figures come from
    one pass and a join of customers, not of predictions.
    """
    per_customer = predictions.groupBy("customer_id").agg(F.count(F.lit(1)).alias("n"))
    valid = valid_customers.select("customer_id").distinct().withColumn("valid", F.lit(True))
    known = F.col("valid").isNotNull()
    return per_customer.join(valid, "customer_id", "left").agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_predictions"),
        F.count(F.lit(1)).alias("n_customers"),
        F.coalesce(F.sum(F.when(known, F.col("n"))), F.lit(0)).alias("n_predictions_valid"),
        F.count_if(known).alias("n_customers_valid"),
    )
