"""Exact order statistics without bringing a column into one task.

``percentile`` keeps every distinct value in one aggregation buffer. Here the
values are first counted (one row per distinct value, combined map-side), then
cut into buckets at approximate quantiles of the distinct values; cumulative
counts of the few buckets give each bucket its rank offset. A bucket that contains
a wanted rank is cut again, round by round, until it has at most BOUND distinct
values; then it is sorted, alone. All other values are left behind after their round.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cartwise.session import discard, materialize

# Buckets are found in two steps of STEP comparisons each.
STEP = 16
BUCKETS = STEP * STEP
#: Distinct values that one task sorts at most.
BOUND = 1_000_000


def long_form(df: DataFrame, columns: list[str], cast: str = "double") -> DataFrame:
    """``(metric, value)`` rows of several numeric columns."""
    entries = F.array(
        *[F.struct(F.lit(c).alias("metric"), F.col(c).cast(cast).alias("value")) for c in columns]
    )
    return df.select(F.inline(entries))


def value_counts(values: DataFrame) -> DataFrame:
    """Rows per distinct non-null ``(metric, value)``."""
    return (
        values.where(F.col("value").isNotNull())
        .groupBy("metric", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def _with_bucket(counts: DataFrame, splits: DataFrame) -> DataFrame:
    """``counts`` with the number of split points of its part up to the value: the bucket.

    Every STEP-th split point is compared first, then those between two of them.
    """
    marks = ", ".join(str(i) for i in range(STEP, BUCKETS, STEP))
    coarse = f"{STEP} * size(filter(array({marks}), i -> splits[i - 1] <= value))"
    fine = f"size(filter(slice(splits, low + 1, {STEP - 1}), s -> s <= value))"
    # One row per part: a metric, or one of its buckets with a wanted rank.
    return (
        counts.join(F.broadcast(splits), ["metric", "part"])
        .withColumn("low", F.expr(coarse))
        .select("metric", "part", "value", "n", F.expr(f"low + {fine}").alias("bucket"))
    )


def _holding(sizes: DataFrame) -> DataFrame:
    """The parts that hold wanted ranks, and which: ``sizes`` has ``offset`` and ``part_n``."""
    here = F.filter("ranks", lambda r: (r >= F.col("offset")) & (r < F.col("offset") + F.col("part_n")))
    return sizes.withColumn("ranks", here).where(F.size("ranks") > 0)


def narrowed(counts: DataFrame, ranks: Column, bound: int | None = None) -> tuple[DataFrame, DataFrame]:
    """``(values, parts)``: the stored values of the parts that hold a wanted rank, none of
    more than ``bound`` distinct values, and those parts, at most one for each wanted rank.

    ``values`` is (metric, part, value, n), ``parts`` (metric, part, offset, part_n, distinct,
    total, ranks).
    """
    bound = BOUND if bound is None else bound
    values = materialize(counts.withColumn("part", F.lit("")), "value-counts")
    whole = values.groupBy("metric", "part").agg(F.sum("n").alias("part_n"), F.count(F.lit(1)).alias("distinct"))
    whole = whole.select("*", F.col("part_n").alias("total"), F.lit(0).cast("long").alias("offset"))
    parts = materialize(_holding(whole.withColumn("ranks", F.array_distinct(ranks))), "parts")
    cuts = F.expr(f"array({', '.join(f'{i / BUCKETS}D' for i in range(1, BUCKETS))})")
    while (parts.agg(F.max("distinct")).first()[0] or 0) > bound:
        large = parts.where(F.col("distinct") > bound)
        of_large = values.join(F.broadcast(large.select("metric", "part")), ["metric", "part"])
        # The split points of a part, an array of fixed length.
        splits = of_large.groupBy("metric", "part").agg(
            F.percentile_approx("value", cuts, F.lit(10 * BUCKETS)).alias("splits")
        )
        placed = _with_bucket(of_large, splits)
        sizes = placed.groupBy("metric", "part", "bucket").agg(F.sum("n").alias("part_n"), F.count(F.lit(1)).alias("distinct"))
        up_to = Window.partitionBy("metric", "part").orderBy("bucket")
        before = F.sum("part_n").over(up_to) - F.col("part_n")
        named = F.concat("part", F.lit("/"), F.col("bucket").cast("string"))
        known = F.broadcast(large.select("metric", "part", "total", "ranks", F.col("offset").alias("start")))
        cut = (
            sizes.withColumn("before", before)
            .join(known, ["metric", "part"])
            .select("metric", named.alias("part"), "part_n", "distinct", "total", (F.col("start") + F.col("before")).alias("offset"), "ranks")
        )
        small = parts.where(F.col("distinct") <= bound)
        parts = materialize(small.unionByName(_holding(cut).select(*small.columns)), "parts")
        kept = values.join(F.broadcast(small.select("metric", "part")), ["metric", "part"])
        moved = placed.select("metric", named.alias("part"), "value", "n")
        moved = moved.join(F.broadcast(parts.select("metric", "part")), ["metric", "part"], "left_semi")
        last, values = values, materialize(kept.unionByName(moved.select(*kept.columns)), "value-counts")
        discard(last)
    return values, parts


def values_at_ranks(counts: DataFrame, ranks: Column) -> DataFrame:
    """``(metric, total, rank, value)`` for the wanted zero-based ranks.

    ``ranks`` is an array expression over ``total``, the number of rows of the
    metric.
    """
    values, parts = narrowed(counts, ranks)
    inside = Window.partitionBy("metric", "part").orderBy("value")
    # ``parts`` has at most one row per wanted rank and metric.
    located = (
        values.join(F.broadcast(parts), ["metric", "part"])
        .withColumn("until", F.col("offset") + F.sum("n").over(inside))
        .withColumn("since", F.col("until") - F.col("n"))
    )
    here = F.filter("ranks", lambda r: (r >= F.col("since")) & (r < F.col("until")))
    return located.select("metric", "total", F.explode(here).alias("rank"), "value")


def quantiles(
    counts: DataFrame,
    probabilities: dict[str, float],
    interpolation: str = "linear",
) -> DataFrame:
    """One row per metric with one column per named probability.

    ``linear`` interpolates between the two nearest ranks; ``nearest`` takes the
    value at the rounded rank.
    """
    if interpolation not in ("linear", "nearest"):
        raise ValueError(f"Unknown interpolation: {interpolation}")

    def position(p: float) -> Column:
        at = (F.col("total") - 1) * F.lit(p)
        return F.round(at) if interpolation == "nearest" else at

    ends = [f(position(p)).cast("long") for p in probabilities.values() for f in (F.floor, F.ceil)]
    found = values_at_ranks(counts, F.array(*ends))

    def value_at(rank: Column) -> Column:
        return F.max(F.when(F.col("rank") == rank, F.col("value")))

    sides = []
    for name, p in probabilities.items():
        sides.append(value_at(F.floor(position(p)).cast("long")).alias(f"{name}__lo"))
        sides.append(value_at(F.ceil(position(p)).cast("long")).alias(f"{name}__hi"))
    both = found.groupBy("metric", "total").agg(*sides)
    out = []
    for name, p in probabilities.items():
        share = position(p) - F.floor(position(p))
        low, high = F.col(f"{name}__lo"), F.col(f"{name}__hi")
        out.append((low + (high - low) * share).alias(name))
    return both.select("metric", "total", *out)


def nth_smallest(df: DataFrame, column: Column, n: Column) -> DataFrame:
    """A one-row table with the long value of rank ``n`` (one-based, over ``total``)."""
    named = df.select(column.alias("value"))
    counts = value_counts(long_form(named, ["value"], cast="long"))
    return values_at_ranks(counts, F.array(n.cast("long") - 1)).select("value")


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)
