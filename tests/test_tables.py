"""Quantiles, samples, cleaning, reports and stored tables."""

from __future__ import annotations

import json
import random
from datetime import date, datetime

import numpy as np
import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from cartwise.functions import quantiles as Q
from cartwise.operators import cleaning, eda, evaluation, ranking, reports, sampling, submission
from cartwise.sources import artifacts, readers, schemas

TXN = "customer_id long, item_id long, created_date timestamp_ntz"
ITEMS = "item_id long, brand string, age_group string, category string"


@pytest.mark.parametrize("kind", ["repeated", "distinct", "skewed", "constant", "single"])
def test_quantiles_match_numpy(make, kind):
    rnd = random.Random(1)
    values = {
        "repeated": [float(rnd.randint(0, 9)) for _ in range(500)],
        "distinct": [rnd.gauss(0, 100) for _ in range(3000)],
        "skewed": [0.0] * 700 + [rnd.random() * 10**6 for _ in range(50)],
        "constant": [4.5] * 20,
        "single": [3.0],
    }[kind]
    df = make([(v,) for v in values] + [(None,)], "x double")
    counts = Q.value_counts(Q.long_form(df, ["x"]))
    wanted = {"lo": 0.0, "q1": 0.25, "median": 0.5, "p90": 0.9, "hi": 1.0}
    for mode, name in (("linear", "linear"), ("nearest", None)):
        row = Q.quantiles(counts, wanted, mode).collect()[0]
        for column, p in wanted.items():
            if name:
                expected = np.quantile(values, p)
            else:
                at = (len(values) - 1) * p
                expected = sorted(values)[int(np.floor(at + 0.5))]
            assert row[column] == pytest.approx(expected), (mode, column)
    with pytest.raises(ValueError, match="interpolation"):
        Q.quantiles(counts, wanted, "middle")


def test_histogram_matches_numpy(make):
    rnd = random.Random(2)
    data = [(rnd.gauss(5, 2), 7.0) for _ in range(400)]
    got = eda.histogram_bins(make(data, "a double, b double"), ["a", "b"], 10)
    for metric, column in (("a", 0), ("b", 1)):
        counts, edges = np.histogram([r[column] for r in data], bins=10)
        mine = got.where(F.col("metric") == metric).orderBy("bin").collect()
        assert [r.n for r in mine] == counts.tolist()
        assert [r.bin_start for r in mine] == pytest.approx(edges[:-1].tolist())


def test_samples(spark, make):
    rows = make([(c, i) for c in range(1, 301) for i in range(c % 4 + 1)], "customer_id long, item_id long")
    for method in ("xxhash64", "multiplicative"):
        kept = sampling.sample_customers(rows, 0.4, method=method)
        assert kept.select("customer_id").distinct().count() == 120
        whole = rows.join(kept.select("customer_id").distinct(), "customer_id", "left_semi")
        assert kept.count() == whole.count()
        assert rows_of(kept) == rows_of(sampling.sample_customers(rows.repartition(7), 0.4, method=method))
        tenth = sampling.hash_sample(rows, 10, method=method)
        assert rows_of(tenth) == rows_of(sampling.hash_sample(rows.repartition(7), 10, method=method))
    assert rows_of(sampling.sample_customers(rows, 0.0)) == []
    assert sampling.sample_rows_cap(rows).count() == rows.count()
    part = sampling.sample_rows_cap(rows, max_rows=100).count()
    assert 0.1 < part / rows.count() < 0.3
    with pytest.raises(ValueError, match="method"):
        sampling.hash_sample(rows, method="md5")


def test_samples_take_any_id(make):
    ids = [-1, 0, 2**32 - 1, 3_500_000_000, 4 * 10**18, 2**62, 2**63 - 1, -(2**63)]
    rows = make([(i, j) for i in ids for j in ids], "customer_id long, item_id long")
    for method in ("xxhash64", "multiplicative"):
        assert sampling.sample_customers(rows, 0.5, method=method).count() == 4 * len(ids)
        assert sampling.hash_sample(rows, 1, method=method).count() == rows.count()
        assert 0 <= sampling.sample_rows_cap(rows, max_rows=3, method=method).count() < rows.count()


def test_orphans(make):
    history = make([(1, 1), (1, 2), (2, 9), (3, 9), (None, None)], "customer_id long, item_id long")
    items, users = make([(1,), (2,)], "item_id long"), make([(1,)], "customer_id long")
    assert rows_of(eda.orphan_ids(history, items, users)) == [(2, 1)]


def test_cleaning(make):
    t = datetime(2024, 1, 1)
    rows = make([(1, 1, t), (1, 1, t), (None, 1, t), (1, None, t), (1, 1, None)], TXN)
    assert cleaning.clean_transactions(rows, sort=True).count() == 1
    items = make([(1, None, "s", "c"), (1, "a", "s", "c"), (None, "a", "s", "c")], ITEMS)
    assert rows_of(cleaning.clean_items(items)) == [(1, "Unknown", "s", "c")]
    users = make(
        [(1, date(2000, 1, 2)), (1, None), (None, None)], "customer_id long, date_of_birth date"
    )
    assert rows_of(cleaning.clean_users(users)) == [(1, None)]


def test_cohorts(make):
    rows = make(
        [(1, 1, datetime(2023, 2, 1)), (1, 1, datetime(2023, 3, 1)), (1, 1, datetime(2023, 4, 3))], TXN
    )
    feb = date(2023, 2, 1)
    # 28 days from February to March are index 0.
    assert rows_of(eda.cohort_retention(rows)) == [(feb, 0, 1), (feb, 1, 1)]
    assert rows_of(eda.cohort_retention(rows, calendar=True)) == [(feb, 0, 1), (feb, 1, 1), (feb, 2, 1)]


def test_empty_tables(spark, make):
    none = make([], TXN)
    items = make([], ITEMS)
    for df in (
        eda.customer_stats(none),
        eda.item_stats(none, items),
        eda.cohort_retention(none),
        eda.daily_volume(none),
        eda.category_volume(none, items),
        eda.iqr_outliers(eda.customer_stats(none), eda.CUSTOMER_METRICS),
        eda.histogram_bins(eda.customer_stats(none), eda.CUSTOMER_METRICS),
        cleaning.clean_transactions(none),
        sampling.sample_customers(none),
    ):
        assert df.count() == 0
    assert eda.duplicate_rows(none, "t").collect()[0].n_duplicates == 0
    assert [r.null_rate for r in eda.compute_null_rates(none, "t").collect()] == [0.0] * 3
    assert [r.null_pct for r in readers.profile_table(none, "t").collect()] == [0.0] * 3


def test_cases_and_status(make):
    predictions = make(
        [(c, 10 * c + r, 1.0 / r, r) for c in (1, 2, 3) for r in range(1, 11)],
        "customer_id long, item_id long, score double, rank int",
    )
    hits = {1: 8, 2: 4, 3: 0}
    truth = make(
        [(c, 10 * c + r) for c, n in hits.items() for r in range(1, n + 1)] + [(3, 999), (3, 998), (2, 998)],
        "customer_id long, item_id long",
    )
    cases = {r.customer_id: r for r in reports.customer_cases(predictions, truth).collect()}
    assert {c: (r.hits, r.status) for c, r in cases.items()} == {
        1: (8, "EXCELLENT"),
        2: (4, "GOOD"),
        3: (0, "FAIR"),
    }
    ends = {r["case"]: r.customer_id for r in reports.case_best_worst(predictions, truth).collect()}
    assert ends == {"best": 1, "worst": 3}
    marked = reports.mark_hits(predictions, truth)
    assert marked.where("is_hit").count() == 12


def test_change_and_impact(make):
    metrics = make(
        [(3, "precision", 10, 0.0), (13, "precision", 10, 0.5), (3, "ndcg", 10, 0.2), (13, "ndcg", 10, 0.1)],
        "feature_count long, metric string, k int, value double",
    )
    row = reports.improvement_vs_baseline(metrics).collect()[0]
    assert (row.p10_change_pct, row.ndcg10_change_pct, row.added_features) == (0.0, -50.0, 10)
    classes = make([(-6.0,), (-5.0,), (5.0,), (5.1,)], "x double")
    got = [r[0] for r in classes.select(reports.impact_class(F.col("x"))).collect()]
    assert got == ["important", "minor", "minor", "not important"]
    shares = reports.importance_pct(make([("a", 3.0), ("b", 1.0)], "feature string, importance double"))
    assert [(r.feature, r.pct) for r in shares.collect()] == [("a", 75.0), ("b", 25.0)]


def test_validators(make):
    frame = make([(1, 2)], "customer_id long, item_id long")
    with pytest.raises(ValueError, match="created_date"):
        schemas.validate_transactions(frame)
    with pytest.raises(ValueError, match="age_group, brand, category"):
        schemas.validate_items(frame)
    with pytest.raises(ValueError, match="date_of_birth"):
        schemas.validate_users(frame)
    assert schemas.DataSchema.users_schema().names == ["customer_id", "date_of_birth"]


def test_loaders(spark, make, tmp_path):
    rows = make([(1, 2, datetime(2024, 1, 1))], "customer_id int, item_id int, created_at timestamp_ntz")
    for part in (1, 2):
        rows.write.parquet(f"{tmp_path}/sales_pers.purchase_history_daily_chunk_{part}.parquet")
    loaded = readers.load_transactions(spark, data_dir=str(tmp_path))
    assert loaded.schema == schemas.TRANSACTIONS
    assert loaded.count() == 2
    assert readers.load_any_parquet(
        spark, "sales_pers.purchase_history_daily_chunk_1", str(tmp_path)
    ).count() == 1
    with pytest.raises(FileNotFoundError, match="chunk_2.parquet"):
        readers.load_any_parquet(spark, "absent", str(tmp_path))
    with pytest.raises(FileNotFoundError, match="not found"):
        readers.list_parquet_files(spark, f"{tmp_path}/nowhere")
    assert readers.explore_dataset(spark, str(tmp_path)).count() == 6


def test_stored_tables(spark, make, tmp_path):
    calls = []

    def build():
        calls.append(1)
        return make([(1, 1)], "customer_id long, item_id long")

    for _ in range(2):
        assert artifacts.features_cache(spark, f"{tmp_path}/features", build).count() == 1
    assert len(calls) == 1
    for end in (1, 2, 1):
        artifacts.features_cache(spark, f"{tmp_path}/features", build, end=end)
    assert len(calls) == 3
    names = {"metrics_a_3features": 3, "metrics_b_3features": 3, "metrics_other": None, "metrics_tuned": 13}
    for name, size in names.items():
        artifacts.write_metrics(make([("precision", 5, 0.5, size)], artifacts.METRICS), f"{tmp_path}/{name}")
    stored = artifacts.read_metrics(spark, f"{tmp_path}/metrics_*")
    assert {r.file_name for r in stored.collect()} >= {"metrics_tuned", "metrics_other"}
    assert rows_of(artifacts.feature_set_metrics(stored)) == [
        (3, "precision", 5, 0.5),
        (13, "precision", 5, 0.5),
    ]
    assert artifacts.latest_artifact(spark, str(tmp_path), "metrics_") == "metrics_tuned"
    assert artifacts.latest_artifact(spark, f"{tmp_path}/none", "metrics_") is None


def test_submission_file(spark, make, tmp_path):
    predictions = make(
        [(c, 100 + r, 1.0 / (r * c), r) for c in (1, 2, 3) for r in range(12, 0, -1)],
        "customer_id long, item_id long, score double, rank int",
    )
    kept = submission.keep_top_customers(predictions, 2)
    lists = submission.submission_lists(kept)
    submission.write_submission(lists, f"{tmp_path}/submission")
    merged = {}
    for line in spark.read.text(f"{tmp_path}/submission").collect():
        assert " " not in line.value
        merged |= json.loads(line.value)
    assert merged == {c: list(range(101, 111)) for c in ("1", "2")}
    size = submission.submission_size(lists).collect()[0]
    assert size.verdict == "might be too small"
    assert size.n_customers == 2


def test_feature_cache_is_laid_out_by_customer(spark, tmp_path):
    """Ranking and evaluation over the cache move nothing by customer, even without broadcasts."""
    rows = spark.range(3000).selectExpr("id % 200 AS customer_id", "id AS item_id", "cast(id % 97 AS double) AS score", "cast(id % 11 = 0 AS int) AS Y")
    build = lambda: rows
    cached = artifacts.features_cache(spark, f"{tmp_path}/it's here/f", build, buckets=6, end="x")
    assert rows_of(cached) == rows_of(rows)
    files = [f for f in cached.inputFiles() if f.endswith(".parquet")]
    assert len(files) == 6
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        ranked = ranking.rank_topk(cached, 10)
        metrics = evaluation.evaluate_recommendations(cached, cached.where("Y = 1"), [5, 10])
        for df in (ranked, metrics):
            text = df._jdf.queryExecution().executedPlan().toString()
            assert "hashpartitioning" not in text and "Bucketed: true" in text
        plain_rank = rows_of(ranking.rank_topk(rows, 10))
        plain = rows_of(evaluation.evaluate_recommendations(rows, rows.where("Y = 1"), [5, 10]))
        assert rows_of(ranked) == plain_rank
        assert [r[:2] for r in rows_of(metrics)] == [r[:2] for r in plain]
        assert [r[2] for r in rows_of(metrics)] == pytest.approx([r[2] for r in plain])
    finally:
        spark.conf.set(key, before)

    # Another session finds the layout from the files; it does not build.
    def never():
        raise AssertionError("built again")

    again = artifacts.features_cache(spark.newSession(), f"{tmp_path}/it's here/f", never, end="x")
    assert "SelectedBucketsCount: 6 out of 6" in again.groupBy("customer_id").count()._jdf.queryExecution().executedPlan().toString()
    assert rows_of(again) == rows_of(rows)
    other = artifacts.features_cache(spark, f"{tmp_path}/it's here/f", build, buckets=3, end="x")
    assert len(other.inputFiles()) == 3


def test_exploration_outlives_broken_files(spark, tmp_path):
    """A cut, a foreign and an empty file, and damaged pages: one row each, the rest is told."""
    folder = tmp_path / "set +1"
    good = spark.range(100).selectExpr("id", "if(id % 4 = 0, null, repeat(cast(id AS string), 50)) AS name")
    good.repartition(3).write.parquet(f"{folder}/parts.parquet")
    good.coalesce(1).write.parquet(f"{tmp_path}/one")
    whole = next((tmp_path / "one").glob("*.parquet")).read_bytes()
    (folder / "single.parquet").write_bytes(whole)
    parts = sorted((folder / "parts.parquet").glob("part-*"))
    parts[0].write_bytes(parts[0].read_bytes()[:-20])
    (folder / "cut.parquet").write_bytes(whole[: len(whole) // 2])
    (folder / "text.parquet").write_text("no table at all")
    (folder / "nothing.parquet").write_bytes(b"")
    spark.range(0).coalesce(1).write.parquet(f"{tmp_path}/none")
    (folder / "empty.parquet").write_bytes(next((tmp_path / "none").glob("*.parquet")).read_bytes())
    broken = bytearray(whole)
    broken[20 : len(whole) // 2] = bytes(len(whole) // 2 - 20)
    (folder / "pages.parquet").write_bytes(bytes(broken))

    found = {(r.table_name, r.file_name): r for r in readers.explore_files(spark, str(folder)).collect()}
    assert len(found) == 9
    status = {k: r.status for k, r in found.items()}
    assert status[("single", "single.parquet")] == status[("empty", "empty.parquet")] == "ok"
    assert [status[("parts", p.name)] for p in parts] == ["unreadable", "ok", "ok"]
    for name in ("cut", "text", "nothing"):
        row = found[(name, f"{name}.parquet")]
        assert row.status == "unreadable" and row.n_rows is None and row.message
    damaged = found[("pages", "pages.parquet")]
    assert damaged.status == "damaged" and damaged.message.endswith("of 100 rows can be read")
    assert found[("single", "single.parquet")].n_rows == 100 and found[("empty", "empty.parquet")].n_rows == 0

    profile = {(r.table_name, r.column_name): (r.n_rows, r.null_count) for r in readers.explore_dataset(spark, str(folder)).collect()}
    assert profile[("single", "name")] == (100, 25) and profile[("empty", "id")] == (0, 0)
    assert 0 < profile[("parts", "id")][0] < 100 and profile[("cut", None)] == (None, None)
    samples = [json.loads(r.row) for r in readers.explore_samples(spark, str(folder)).where("table_name = 'single'").orderBy("row_index").collect()]
    assert samples == [{"id": 0}, {"id": 1, "name": "1" * 50}, {"id": 2, "name": "2" * 50}]


def test_a_window_of_a_monthly_history_reads_its_months(spark, make, tmp_path):
    rows = [(c, 10 + c, datetime(2024, 1 + c % 6, 1 + c % 28, 5), c) for c in range(300)] + [(7, 1, None, None)]
    history = make(rows, "customer_id long, item_id long, at timestamp_ntz, order_id long")
    path = f"{tmp_path}/history"
    readers.write_transactions(history, path, "at")
    whole = readers.load_transactions(spark, path, ts_col="at")
    assert whole.columns == ["customer_id", "item_id", "created_date", "order_id"] and rows_of(whole.where("created_date is not null")) == sorted(rows[:-1])
    assert whole.count() == 301
    begin, end = datetime(2024, 3, 10), datetime(2024, 4, 1)
    window = readers.load_transactions(spark, path, ts_col="at", begin=begin, end=end)
    assert rows_of(window) == sorted(r for r in rows[:-1] if begin <= r[2] < end)
    # The other months are not opened: they could be anything.
    for file in (tmp_path / "history").glob("purchase_month=*/*"):
        if not any(m in str(file) for m in ("2024-03", "2024-04")):
            file.write_bytes(b"")
    schema = "customer_id long, item_id long, at timestamp_ntz, order_id long, purchase_month date"
    assert "PartitionFilters: [isnotnull(purchase_month" in window._jdf.queryExecution().executedPlan().toString()
    assert spark.read.schema(schema).parquet(path).where("purchase_month = '2024-03-01'").count() == 50
    assert window.count() == len([r for r in rows[:-1] if begin <= r[2] < end])


@pytest.mark.parametrize("bound", [1_000_000, 40])
def test_ranks_are_found_in_small_parts(spark, monkeypatch, bound):
    """However many distinct values: parts that are sorted are within the bound, results exact."""
    monkeypatch.setattr(Q, "BOUND", bound)
    spread = spark.range(120_000).selectExpr("'a' AS metric", "cast(pmod(xxhash64(id), 1000003) AS double) AS value")
    dense = spark.range(50_000).selectExpr("'b' AS metric", "cast(if(id % 2 = 0, 7, id) AS double) AS value")
    few = spark.range(99).selectExpr("'c' AS metric", "cast(id % 3 AS double) AS value")
    counts = Q.value_counts(spread.unionByName(dense).unionByName(few))
    ranks = F.array(*[F.floor((F.col("total") - 1) * F.lit(p)).cast("long") for p in (0, 0.1, 0.5, 0.501, 0.99, 1)])
    values, parts = Q.narrowed(counts, ranks)
    sizes = {(r.metric, r.part): r.n for r in values.groupBy("metric", "part").agg(F.count("*").alias("n")).collect()}
    told = {(r.metric, r.part): r.distinct for r in parts.collect()}
    assert max(sizes.values()) <= bound
    assert told == {k: n for k, n in sizes.items() if k in told} and len(told) <= 18
    if bound == 40:
        assert sum(told.values()) < 18 * 40 and any(k[1].count("/") == 2 for k in told)
    found = {(r.metric, r["rank"]): r.value for r in Q.values_at_ranks(counts, ranks).collect()}
    for metric, df in (("a", spread), ("b", dense), ("c", few)):
        ordered = sorted(r.value for r in df.collect())
        own = {rank: v for (m, rank), v in found.items() if m == metric}
        assert own == {rank: ordered[rank] for rank in own} and {0, len(ordered) - 1} <= set(own)


def test_top_customers_are_an_exact_order_statistic(spark, make):
    rnd = random.Random(4)
    rows = [(c, rnd.choice([0.5, 0.25, 0.125, float(c % 9)])) for c in range(400) for _ in range(2)] + [(900, None), (901, None), (None, 99.0)]
    predictions = make(rows, "customer_id long, score double")
    means = {}
    for c, score in rows:
        if c is not None:
            means.setdefault(c, []).append(score)
    means = {c: None if None in v else sum(v) / len(v) for c, v in means.items()}
    order = sorted(means, key=lambda c: (-(means[c] if means[c] is not None else -1e9), c))
    for n in (1, 7, 100, 399, 400, 401, 402, 999):
        got = submission.top_customers_by_score(predictions, n)
        assert rows_of(got.select("customer_id")) == sorted((c,) for c in order[:n]), n
    text = submission.top_customers_by_score(predictions, 100)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrdered" not in text and "SinglePartition" not in text
