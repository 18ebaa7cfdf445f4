"""Joins that divide hot keys, next to plain joins."""

from __future__ import annotations

import random
import re

import pytest

from cartwise.functions.joins import grid_join, lookup_join


def told(df, columns):
    return sorted(map(str, df.select(*columns).collect()))


@pytest.mark.parametrize("shares", [3, 1000])
@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("null_safe", [False, True])
def test_lookup_join(make, shares, how, null_safe):
    rng = random.Random(1)
    rows = make([(i, rng.choice([None, 1, 1, 1, 2, 3, 4, 5, 99, 99, 99]), "v") for i in range(400)], "id long, k int, note string")
    table = make([(k, f"v{k}") for k in (None, 1, 2, 3, 4, 7)], "k int, v string")
    same = rows.k.eqNullSafe(table.k) if null_safe else rows.k == table.k
    plain = rows.join(table, same, how).select(rows.id, rows.k, rows.note, table.v)
    found = lookup_join(rows, table, ["k"], ["id"], how, null_safe, shares=shares)
    assert found.columns == ["id", "k", "note", "v"]
    assert told(found, ["id", "k", "note", "v"]) == told(plain, ["id", "k", "note", "v"])


def test_rows_of_a_hot_key_are_dealt_out(make, spark):
    """The join's exchange is on key and salt, on both sides."""
    rows = make([(i, 7 if i % 3 else i) for i in range(300)], "id long, k int")
    table = make([(i, f"v{i}") for i in range(300)], "k int, v string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for stated in (None, 6):
            found = lookup_join(rows, table, ["k"], ["id"], partitions=stated)
            text = found._jdf.queryExecution().executedPlan().toString()
            exchanges = re.findall(r"Exchange hashpartitioning\((.*), \d+\),", text)
            joined = [e for e in exchanges if "__salt" in e or "__none" in e]
            assert len(joined) == 2, exchanges
            assert found.where("v is null").count() == 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_lookup_join_of_empty_tables(make):
    rows, table = make([], "id long, k int"), make([], "k int, v string")
    assert lookup_join(rows, table, ["k"], ["id"]).count() == 0
    kept = lookup_join(make([(1, 1), (2, None)], "id long, k int"), table, ["k"], ["id"])
    assert told(kept, ["id", "k", "v"]) == ["Row(id=1, k=1, v=None)", "Row(id=2, k=None, v=None)"]


@pytest.mark.parametrize("shares", [1, 5, 50, 1000])
def test_grid_join(make, shares):
    rng = random.Random(2)
    left = make([(i, rng.choice([None, 1, 1, 1, 2, 3, 8])) for i in range(300)], "id long, k int")
    right = make([(rng.choice([None, 1, 1, 2, 2, 3, 9]), i) for i in range(200)], "k int, c long")
    assert told(grid_join(left, right, "k", ["id"], ["c"], shares), ["id", "c", "k"]) == told(left.join(right, "k"), ["id", "c", "k"])


def test_grid_join_of_empty_tables(make):
    left, right = make([(1, 1)], "id long, k int"), make([], "k int, c long")
    assert grid_join(left, right, "k", ["id"], ["c"]).count() == 0


def test_no_task_of_a_grid_join_has_a_hot_item(make, spark):
    """One key holds half of both sides: its output is spread over the tasks."""
    from pyspark.sql import functions as F

    left = spark.range(4000).select(F.col("id"), F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id")).alias("k"))
    right = spark.range(4000).select(F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id")).alias("k"), F.col("id").alias("c"))
    sizes = [r["n"] for r in grid_join(left, right, "k", ["id"], ["c"]).groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    assert sum(sizes) == 2000 * 2000 + 2000
    assert max(sizes) < 4 * sorted(sizes)[len(sizes) // 2]
