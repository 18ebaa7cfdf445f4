"""Exploratory reports over the three input tables."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cartwise.functions.expressions import count_nulls_as_value, whole_days
from cartwise.functions.quantiles import long_form, quantiles, value_counts
from cartwise.session import fan_out_partitions
from cartwise.sources.schemas import TS_COL

CUSTOMER_METRICS = ("num_purchases", "num_unique_items", "days_active")
_QUARTILES = {"q1": 0.25, "median": 0.5, "q3": 0.75}


def compute_null_rates(df: DataFrame, name: str) -> DataFrame:
    """Nulls and null share per column, highest share first."""
    counts = df.agg(
        F.count(F.lit(1)).alias("__rows"),
        *[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns],
    )
    entries = F.array(
        *[F.struct(F.lit(c).alias("column"), F.col(c).alias("null_count")) for c in df.columns]
    )
    rate = F.when(F.col("__rows") > 0, F.col("null_count") / F.col("__rows")).otherwise(0.0)
    return (
        counts.select("__rows", F.inline(entries))
        .select(F.lit(name).alias("table_name"), "column", "null_count", rate.alias("null_rate"))
        .orderBy(F.desc("null_rate"), "column")
    )


# --- customers and items ----------------------------------------------------


def customer_stats(transactions: DataFrame) -> DataFrame:
    """Per customer: purchases, distinct items and whole days between first and last."""
    return transactions.groupBy("customer_id").agg(
        F.count("item_id").alias("num_purchases"),
        count_nulls_as_value("item_id").alias("num_unique_items"),
        whole_days(F.min(TS_COL), F.max(TS_COL)).cast("long").alias("days_active"),
    )


def top_customers(transactions: DataFrame, n: int = 20) -> DataFrame:
    """The ``n`` customers with the most purchases."""
    return customer_stats(transactions).orderBy(F.desc("num_purchases"), "customer_id").limit(n)


def _item_counts(transactions: DataFrame) -> DataFrame:
    return transactions.groupBy("item_id").agg(
        F.count(F.lit(1)).alias("num_purchases"),
        count_nulls_as_value("customer_id").alias("num_customers"),
    )


def item_stats(transactions: DataFrame, items: DataFrame) -> DataFrame:
    """Per item: rows, distinct customers and the item's attributes."""
    return _item_counts(transactions).join(items, "item_id", "left")


def top_items(transactions: DataFrame, items: DataFrame, n: int = 20) -> DataFrame:
    """The ``n`` items with the most rows. Attributes are joined to the ``n`` only."""
    best = _item_counts(transactions).orderBy(F.desc("num_purchases"), "item_id").limit(n)
    return best.join(items, "item_id", "left").orderBy(F.desc("num_purchases"), "item_id")


def value_distribution(items: DataFrame, column: str, top: int | None = None) -> DataFrame:
    """Items per value of brand, age group or category, most frequent first."""
    counts = (
        items.groupBy(column)
        .agg(F.count(F.lit(1)).alias("n_items"))
        .orderBy(F.desc("n_items"), column)
    )
    return counts if top is None else counts.limit(top)


def category_volume(transactions: DataFrame, items: DataFrame) -> DataFrame:
    """Purchases per category, most first. Rows are counted per item before the
    join, so the join sees the catalogue, not the history."""
    per_item = transactions.groupBy("item_id").agg(F.count(F.lit(1)).alias("n"))
    return (
        per_item.join(items.select("item_id", "category"), "item_id", "left")
        .groupBy("category")
        .agg(F.sum("n").alias("num_purchases"))
        .orderBy(F.desc("num_purchases"), "category")
    )


def brand_age_matrix(
    items: DataFrame, age_groups: Sequence[str] | None = None, top_brands: int = 10
) -> DataFrame:
    """Items per brand (the most frequent ones) and age group, one column per group.

    The columns are part of the schema. Pass ``age_groups``; otherwise Spark reads
    the distinct values first and refuses more than ``spark.sql.pivotMaxValues``.
    """
    counts = items.groupBy("brand", "age_group").agg(F.count(F.lit(1)).alias("n"))
    best = (
        counts.where(F.col("brand").isNotNull())
        .groupBy("brand")
        .agg(F.sum("n").alias("n_items"))
        .orderBy(F.desc("n_items"), "brand")
        .limit(top_brands)
    )
    kept = counts.join(best, "brand", "left_semi")
    values = list(age_groups) if age_groups is not None else None
    return kept.groupBy("brand").pivot("age_group", values).agg(F.sum("n")).fillna(0)


# --- time -------------------------------------------------------------------


def time_range(transactions: DataFrame) -> DataFrame:
    """First and last transaction."""
    return transactions.agg(
        F.min(TS_COL).alias("first_transaction"), F.max(TS_COL).alias("last_transaction")
    )


def daily_volume(transactions: DataFrame) -> DataFrame:
    """Rows per calendar date, by date."""
    return (
        transactions.groupBy(F.to_date(TS_COL).alias("date"))
        .agg(F.count(F.lit(1)).alias("num_transactions"))
        .orderBy("date")
    )


def cohort_retention(transactions: DataFrame, calendar: bool = False) -> DataFrame:
    """Active customers per month of first purchase and months since.

    Months since is ``floor(days between month starts / 30)``; with ``calendar``
    it is the number of calendar months. Purchases are reduced to distinct
    (customer, month) rows first, so a customer's group is its active months.
    """
    months = transactions.select(
        "customer_id", F.to_date(F.date_trunc("month", F.col(TS_COL))).alias("month")
    ).distinct()
    first = F.min("month").over(Window.partitionBy("customer_id"))
    since = (
        F.months_between("month", "cohort_month")
        if calendar
        else F.datediff("month", "cohort_month") / 30
    )
    return (
        months.withColumn("cohort_month", first)
        .select("customer_id", "cohort_month", F.floor(since).cast("int").alias("months_since_first"))
        .distinct()
        .groupBy("cohort_month", "months_since_first")
        .agg(F.count(F.lit(1)).alias("active_customers"))
    )


def cohort_sample(retention: DataFrame, n: int = 6) -> DataFrame:
    """The rows of the first ``n`` cohorts."""
    first = retention.select("cohort_month").distinct().orderBy("cohort_month").limit(n)
    return retention.join(first, "cohort_month", "left_semi")


# --- distributions ----------------------------------------------------------


def describe_stats(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, nulls, mean, standard deviation, minimum, quartiles and maximum per column."""
    values = long_form(df, list(columns))
    moments = values.groupBy("metric").agg(
        F.count("value").alias("count"),
        F.count_if(F.col("value").isNull()).alias("null_count"),
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    )
    inner = quantiles(value_counts(values), _QUARTILES).drop("total")
    return moments.join(inner, "metric", "left").select(
        "metric", "count", "null_count", "mean", "std", "min", "q1", "median", "q3", "max"
    )


def box_stats(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Five-number summaries."""
    return describe_stats(df, columns).select("metric", "min", "q1", "median", "q3", "max")


def iqr_outliers(
    df: DataFrame, columns: Sequence[str], interpolation: str = "linear"
) -> DataFrame:
    """Quartiles, 1.5 IQR bounds and the number and share of values outside.

    The outliers are counted on the value counts already made for the quartiles.
    """
    counts = value_counts(long_form(df, list(columns)))
    quartiles = quantiles(counts, {"q1": 0.25, "q3": 0.75}, interpolation)
    iqr = F.col("q3") - F.col("q1")
    bounds = quartiles.select(
        "metric",
        "total",
        "q1",
        "q3",
        iqr.alias("iqr"),
        (F.col("q1") - 1.5 * iqr).alias("lower_bound"),
        (F.col("q3") + 1.5 * iqr).alias("upper_bound"),
    )
    outside = (F.col("value") < F.col("lower_bound")) | (F.col("value") > F.col("upper_bound"))
    # One row per metric.
    tallied = (
        counts.join(F.broadcast(bounds), "metric")
        .groupBy("metric", "total", "q1", "q3", "iqr", "lower_bound", "upper_bound")
        .agg(F.coalesce(F.sum(F.when(outside, F.col("n"))), F.lit(0)).alias("num_outliers"))
    )
    return tallied.select(
        "metric",
        "q1",
        "q3",
        "iqr",
        "lower_bound",
        "upper_bound",
        "num_outliers",
        (F.col("num_outliers") / F.col("total")).alias("outlier_rate"),
    )


def histogram_bins(df: DataFrame, columns: Sequence[str], bins: int = 50) -> DataFrame:
    """Equal-width counts between minimum and maximum, empty bins included; the
    last bin is closed on both sides. A constant column has width 1 around it."""
    counts = value_counts(long_form(df, list(columns)))
    ends = counts.groupBy("metric").agg(F.min("value").alias("a"), F.max("value").alias("b"))
    half = F.when(F.col("a") == F.col("b"), F.lit(0.5)).otherwise(F.lit(0.0))
    ends = ends.select("metric", (F.col("a") - half).alias("a"), (F.col("b") + half).alias("b"))
    width = (F.col("b") - F.col("a")) / F.lit(bins)
    index = F.least(F.floor((F.col("value") - F.col("a")) / width), F.lit(bins - 1)).cast("int")
    # One row per metric, then one per metric and bin.
    filled = (
        counts.join(F.broadcast(ends), "metric")
        .groupBy("metric", index.alias("bin"))
        .agg(F.sum("n").alias("n"))
    )
    edges = ends.select(
        "metric", "a", width.alias("w"), F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin")
    )
    return edges.join(filled, ["metric", "bin"], "left").select(
        "metric",
        "bin",
        (F.col("a") + F.col("bin") * F.col("w")).alias("bin_start"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def metric_correlation(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlation of every pair of columns: ``(metric_a, metric_b, corr)``."""
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i:]]
    one_row = df.agg(*[F.corr(a, b).alias(f"{a}|{b}") for a, b in pairs])
    entries = F.array(
        *[
            F.struct(
                F.lit(a).alias("metric_a"), F.lit(b).alias("metric_b"), F.col(f"{a}|{b}").alias("corr")
            )
            for a, b in pairs
        ]
    )
    return one_row.select(F.inline(entries))


# --- data quality -----------------------------------------------------------


def sparsity(transactions: DataFrame) -> DataFrame:
    """Customers, items, interactions, possible interactions, sparsity and density."""
    base = transactions.agg(
        F.count_distinct("customer_id").alias("n_customers"),
        F.count_distinct("item_id").alias("n_items"),
        F.count(F.lit(1)).alias("n_interactions"),
    )
    possible = F.col("n_customers").cast("double") * F.col("n_items")
    density = F.col("n_interactions") / possible
    return base.select(
        "n_customers",
        "n_items",
        "n_interactions",
        possible.alias("n_possible"),
        (1 - density).alias("sparsity"),
        density.alias("density"),
    )


def duplicate_rows(df: DataFrame, name: str) -> DataFrame:
    """Rows beyond the first of each group of equal rows.

    Rows are dealt out by all their columns first: as they come (from a join, say) they may
    lie in few large partitions, whose groups one task would hold twice over.
    """
    dealt = df.repartition(fan_out_partitions(df), *df.columns)
    groups = dealt.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("n"))
    return groups.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("n_duplicates")).select(
        F.lit(name).alias("table_name"), "n_duplicates"
    )


def _absent(facts: DataFrame, dimension: DataFrame, key: str) -> Column:
    ids = facts.where(F.col(key).isNotNull()).select(key).distinct()
    return ids.join(dimension.select(key), key, "left_anti").agg(F.count(F.lit(1))).scalar()


def orphan_ids(transactions: DataFrame, items: DataFrame, users: DataFrame) -> DataFrame:
    """Distinct customers and items of the history that their tables do not have."""
    one_row = transactions.sparkSession.range(1)
    return one_row.select(
        _absent(transactions, users, "customer_id").alias("orphan_customers"),
        _absent(transactions, items, "item_id").alias("orphan_items"),
    )


def future_birth_dates(users: DataFrame, ref_date: date) -> DataFrame:
    """Users born after the reference date."""
    return users.where(F.col("date_of_birth") > F.lit(ref_date)).agg(
        F.count(F.lit(1)).alias("n_future")
    )
