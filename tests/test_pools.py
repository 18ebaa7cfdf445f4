"""Candidate pools by threshold merge, and their split join, next to a plain join."""

from __future__ import annotations

import random
import re
from contextlib import contextmanager
from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cartwise.operators import features, pools
from cartwise.operators.candidates import cap_key


@contextmanager
def no_broadcasts(spark):
    """Joins as for tables too large to be sent; hinted broadcasts stay."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def shop(make):
    """300 categories of 1 to 60 items; one set of categories is held by half of the customers."""
    rng = random.Random(3)
    names = [f"c{i:03}" for i in range(300)]
    items = [(n, f"b{n % 7}", f"s{n % 5}", rng.choice(names[: 1 + n // 10])) for n in rng.sample(range(10**6), 6000)]
    items += [(10**7 + n, "b", "s", None) for n in range(9)]
    sets = [sorted(rng.sample(names, rng.choice((1, 2, 40, 299)))) for _ in range(60)]
    customers = [(i, sets[0] if i % 2 else sets[i % 60]) for i in range(240)] + [(1000, []), (1001, ["unknown"])]
    return (
        make(items, "item_id long, brand string, age_group string, category string"),
        make([(c, {k: 1 for k in s}, s) for c, s in customers], "customer_id long, category_rows map<string,long>, category_set array<string>"),
    )


def naive(items, customers, cap, mode):
    """Every item of every category of every customer, ranked."""
    rows = customers.select("customer_id", F.explode("category_set").alias("category")).join(items, "category")
    order = Window.partitionBy("customer_id").orderBy(cap_key(mode), "item_id")
    ranked = rows.withColumn("rn", F.row_number().over(order))
    return {(r.customer_id, r.item_id) for r in ranked.where(F.col("rn") <= (cap or 10**9)).collect()}


@pytest.mark.parametrize(("cap", "mode"), [(200, "id"), (7, "hash"), (1, "id"), (None, "id")])
@pytest.mark.parametrize("sent", [True, False])
def test_pools_equal_a_plain_join(spark, shop, cap, mode, sent):
    items, customers = shop
    dimension = items.select("item_id", "brand", "age_group", "category", F.lit(1).cast("long").alias("popularity")).limit(3)

    def found():
        made = pools.category_set_pools(customers, dimension, items, 2, cap, mode)
        told = pools.with_pools(customers, made, ["category_pool", "pool_end"])
        assert told.count() == customers.count()
        for r in made.where("category_pool is not null").limit(9).collect():
            ordered = [(e["key"], e["item_id"]) for e in r.category_pool]
            assert ordered == sorted(ordered) and ordered[-1] == tuple(r.pool_end)
        entries = told.select("customer_id", F.explode("category_pool").alias("e"))
        return {(r.customer_id, r.item_id) for r in entries.select("customer_id", "e.item_id").collect()}

    if sent:
        assert found() == naive(items, customers, cap, mode)
    else:
        with no_broadcasts(spark):
            assert found() == naive(items, customers, cap, mode)


def test_few_entries_are_fetched_for_a_set_of_many_categories(spark, shop):
    items, customers = shop
    lists = pools.category_lists(items, 200)
    sets = customers.select("category_set").distinct().withColumn("set_id", F.monotonically_increasing_id())
    sizes = [r.n for r in pools.merged_lists(sets, lists, 50).select(F.size("category_pool").alias("n")).collect()]
    assert max(sizes) == 50
    # Entries at or before the limit, over all categories of a set.
    marks = lists.selectExpr("explode(marks) AS m").select("m.*").collect()
    assert {m.n for m in marks} <= {1, 2, 4, 8, 16, 32, 64, 128}


def test_no_set_of_categories_is_one_task(spark, shop, make):
    """With broadcasts off, rows are never exchanged on the set alone."""
    items, _ = shop
    ids = [r.item_id for r in items.limit(50).collect()]
    hist = make([(c, ids[c % 3 if c % 2 else c % 50], datetime(2024, 1, 1 + c % 28)) for c in range(400)], "customer_id long, item_id long, created_date timestamp_ntz")
    start, mid, end = datetime(2024, 1, 1), datetime(2024, 1, 20), datetime(2024, 2, 1)
    plain = features.build_feature_label_table(hist, items, None, start, mid, mid, end)
    expected = sorted(tuple(r) for r in plain.collect())
    with no_broadcasts(spark):
        table = features.build_feature_label_table(hist, items, None, start, mid, mid, end)
        text = plan(table)
        exchanges = re.findall(r"Exchange hashpartitioning\(([^)]*)", text)
        unsplit = [e for e in exchanges if "category_set" in e and "__salt" not in e and "__none" not in e]
        # The pools' own rows, one for each set, meet the salted key.
        assert exchanges and not [e for e in unsplit if "__key0" not in e]
        assert any("category_set" in e and "__salt" in e for e in exchanges)
        assert sorted(tuple(r) for r in table.collect()) == expected
        pairs = features.training_candidates(hist.where("created_date < '2024-01-20'"), hist.where("created_date >= '2024-01-20'"), items)
        assert sorted(tuple(r) for r in pairs.collect()) == sorted(t[:2] for t in expected)
