"""Tables that are cut by their rows, not by the bytes of their files."""

from __future__ import annotations

from collections import Counter
from datetime import datetime, timedelta

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from cartwise.operators import eda, features, models, ranking
from cartwise.sources import artifacts

BEGIN, END = datetime(2024, 1, 1), datetime(2024, 3, 1)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def shop(make):
    """60 items in 6 categories; 40 customers, one of them null, with purchases on 80 days."""
    items = make([(i, f"b{i % 3}", f"s{i % 2}", f"c{i % 6}") for i in range(60)], "item_id long, brand string, age_group string, category string")
    rows = [(None if n % 40 == 39 else n % 40, n * n % 61, BEGIN + timedelta(days=n % 80), n // 3) for n in range(900)]
    return make(rows, "customer_id long, item_id long, created_date timestamp_ntz, order_id long"), items


def built(shop, **options):
    transactions, items = shop
    return features.build_feature_label_table(transactions, items, None, BEGIN, END, END, datetime(2024, 4, 1), top_n=5, max_per_customer=12, **options)


@pytest.mark.parametrize("sent", [True, False])
def test_feature_table_is_stored_by_customer_without_moving_pairs(spark, shop, tmp_path, monkeypatch, sent):
    monkeypatch.setattr(features, "PAIRS_PER_PART", 20)
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    try:
        if not sent:
            spark.conf.set(key, "-1")
        table = built(shop, by_customer=True)
        parts = table._dealt_by[1]
        assert parts > 2 * spark.sparkContext.defaultParallelism
        # The pairs of one customer are in one partition, as made.
        places = table.select("customer_id", "Y", F.spark_partition_id().alias("place")).where("Y = 0").distinct().collect()
        assert len(places) == len({r.customer_id for r in places}) > 30
        stored = artifacts.features_cache(spark, f"{tmp_path}/f", lambda: table)
        assert Counter(map(tuple, stored.collect())) == Counter(map(tuple, built(shop).collect()))
        # One or two files (further bought pairs) for each part, not one for each task and part.
        assert len(stored.inputFiles()) <= 2 * parts
        ranked = ranking.rank_topk(stored.select("customer_id", "item_id", F.col("X13_avg_item_popularity").alias("score")), 3)
        assert f"SelectedBucketsCount: {parts} out of {parts}" in plan(ranked) and "Exchange" not in plan(ranked)
    finally:
        spark.conf.set(key, before)


def test_parts_follow_the_pairs(spark, make, monkeypatch):
    rows = make([(10**6, [1] * 200, [1] * 50), (5, None, [1] * 50)], "customers long, category_pool array<int>, top_items array<int>")
    assert features.parts_by_pairs(rows) == 251
    assert features.parts_by_pairs(rows.where("category_pool is null")) == 2 * spark.sparkContext.defaultParallelism


def test_a_table_without_rows_is_stored_by_customer(spark, shop, tmp_path):
    transactions, items = shop
    for _ in range(2):
        build = lambda: built((transactions.limit(0), items), by_customer=True)
        assert artifacts.features_cache(spark, f"{tmp_path}/none", build).collect() == []


def test_bounded_rows_are_stored_before_a_fit(spark, monkeypatch):
    """The passes of a fit go over the stored rows, not over the table."""
    seen = []
    stored = models.materialize
    monkeypatch.setattr(models, "materialize", lambda df, name: seen.append(stored(df, name)) or seen[-1])
    rows = spark.range(9000).selectExpr("id % 7 AS x", "cast(id % 7 > 3 AS int) AS Y")
    model = models.train_model(rows, ["x"], model_type="lightgbm", model_params={"maxIter": 2}, max_fit_rows=3000)
    assert models.training_accuracy(model, rows).collect()[0].accuracy == 1.0
    assert [2500 < s.count() < 3500 for s in seen] == [True]
    models.train_model(rows, ["x"], model_params={"maxIter": 2})
    assert len(seen) == 1


def test_equal_rows_of_a_join_are_counted_after_the_join(spark, make):
    """In a partition of their own, not twice over in that of the join."""
    lines = make([(o, i) for o in range(6) for i in (1, 1, o, None)], "order_id long, item_id long")
    orders = make([(o, o % 2) for o in range(6)], "order_id long, customer_id long")
    joined = lines.hint("merge").join(orders, "order_id")
    found = eda.duplicate_rows(joined, "t")
    assert rows_of(found) == [("t", 7)]
    assert "REPARTITION_BY_NUM" in plan(found).split("SortMergeJoin")[0]
