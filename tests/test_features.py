from __future__ import annotations

import re
from datetime import datetime

import pytest
from conftest import SF_DIR, rows_of
from pyspark.sql import functions as F

from cartwise import config
from cartwise.functions.expressions import add_baby_age_feature
from cartwise.operators import features as X
from cartwise.operators import segments
from cartwise.plans import testdata as td

TXN = "customer_id long, item_id long, created_date timestamp_ntz"
ITEMS = "item_id long, brand string, age_group string, category string"
END = datetime(2024, 2, 1)


def txns(make, rows):
    return make([(c, i, datetime.fromisoformat(t)) for c, i, t in rows], TXN)


@pytest.fixture(scope="module")
def items(make):
    return make(
        [
            (1, "a", "s1", "milk"),
            (2, None, "s1", "milk"),
            (3, "b", None, None),
            (4, "a", "s2", "toys"),
        ],
        ITEMS,
    )


def test_null_attributes_count_as_a_value_but_never_match(make, items):
    hist = txns(
        make,
        [(7, 1, "2024-01-02"), (7, 2, "2024-01-03"), (7, 3, "2024-01-04"), (7, 3, "2024-01-05")],
    )
    row = X.customer_features(hist, items, END).collect()[0]
    assert row["X9_brand_diversity"] == 3  # a, b and null
    assert row["X10_category_diversity_score"] == 2 / 4  # milk and null
    assert row["X8_top_brand_ratio"] == 2 / 4
    pairs = make([(7, 1), (7, 2), (7, 3), (7, 4)], "customer_id long, item_id long")
    got = rows_of(X.candidate_features(pairs, hist, items))
    assert got == [(7, 1, 1, 2, 2), (7, 2, 0, 2, 2), (7, 3, 2, 0, 0), (7, 4, 1, 0, 0)]


def test_items_missing_from_the_item_table_still_count(make, items):
    hist = txns(make, [(7, 99, "2024-01-02"), (7, 99, "2024-01-03"), (8, 1, "2024-01-03")])
    row = X.customer_features(hist, items, END).where("customer_id = 7").collect()[0]
    assert row["X13_avg_item_popularity"] == 2.0
    assert row["X9_brand_diversity"] == 1


def test_recency_counts_full_days(make):
    hist = txns(
        make, [(1, 1, "2024-01-31 12:00:00"), (2, 1, "2024-01-31 00:00:00"), (3, 1, "2024-01-30")]
    )
    assert rows_of(X.recency_features(hist, END)) == [(1, 0), (2, 1), (3, 2)]


def test_weekday_mode_is_iso_and_ties_go_to_the_lower_day(make):
    # 2024-01-07 is a Sunday, 2024-01-08 a Monday.
    hist = txns(make, [(1, 1, "2024-01-07"), (1, 1, "2024-01-08"), (2, 1, "2024-01-07")])
    assert rows_of(X.temporal_features(hist)) == [(1, 1), (2, 7)]


@pytest.mark.parametrize(("n", "power", "new"), [(2, 0, 1), (3, 0, 0), (13, 0, 0), (14, 1, 0)])
def test_thresholds(make, items, n, power, new):
    hist = txns(make, [(1, 1, f"2024-01-{d:02d}") for d in range(1, n + 1)])
    row = X.customer_features(hist, items, END).collect()[0]
    assert (row["X6_is_power_user"], row["X12_is_new_customer"]) == (power, new)


def test_frequency_is_rows_per_distinct_time(make, items):
    hist = txns(make, [(1, 1, "2024-01-01")] * 3 + [(1, 2, "2024-01-02 08:00:00")])
    row = X.customer_features(hist, items, END).collect()[0]
    assert row["X5_purchase_frequency"] == row["X7_avg_items_per_purchase"] == 4 / 2


def test_profile_and_single_activity_agree(make, items):
    hist = txns(
        make, [(c, 1 + c % 4, f"2024-01-{d:02d} 0{c}:00:00") for c in range(5) for d in range(1, 20, c + 1)]
    )
    both = X.customer_features(hist, items, END)
    alone = X.customer_activity(hist).select("customer_id", X._x4(END), X._x5(), X._x11())
    assert rows_of(both.select(alone.columns)) == rows_of(alone)


def test_customer_without_history_has_zeros_and_label(make, items):
    all_rows = txns(make, [(1, 1, "2024-01-02"), (9, 4, "2024-02-03")])
    table = X.build_feature_label_table(
        all_rows, items, None, datetime(2024, 1, 1), END, END, datetime(2024, 3, 1)
    )
    row = table.where("customer_id = 9").collect()
    assert len(row) == 1
    assert [row[0][c] for c in config.FEATURE_COLUMNS] == [0] * 13
    assert row[0]["Y"] == 1


def _windows():
    return td.BEGIN_HIST, td.END_HIST, td.BEGIN_RECENT, td.END_RECENT


@pytest.mark.parametrize("cap_mode", ["id", "hash"])
@pytest.mark.parametrize("include_positives", [True, False])
def test_generated_pairs_equal_given_pairs(spark, cap_mode, include_positives):
    d = td.load_domain(spark, SF_DIR)
    pairs = X.training_candidates(d.hist, d.recent, d.items, include_positives, cap_mode)
    assert pairs.count() == pairs.distinct().count()
    given = X.build_feature_label_table(
        d.transactions, d.items, d.users, *_windows(), candidates=pairs
    )
    generated = X.build_feature_label_table(
        d.transactions,
        d.items,
        d.users,
        *_windows(),
        include_positives=include_positives,
        cap_mode=cap_mode,
    )
    assert given.columns == generated.columns
    assert rows_of(given) == rows_of(generated)
    if not include_positives:
        assert pairs.select("customer_id").distinct().count() == d.hist.select(
            "customer_id"
        ).distinct().count()


def test_candidates_are_the_three_sources(spark):
    """Against the definition, evaluated in plain Python."""
    d = td.load_domain(spark, SF_DIR)
    hist = [(r.customer_id, r.item_id) for r in d.hist.collect()]
    recent = {(r.customer_id, r.item_id) for r in d.recent.collect()}
    category = {r.item_id: r.category for r in d.items.collect()}
    counts: dict[int, int] = {}
    for _, i in hist:
        counts[i] = counts.get(i, 0) + 1
    top = sorted(counts, key=lambda i: (-counts[i], i))[:50]
    expected = set(recent)
    for c in {c for c, _ in hist}:
        expected |= {(c, i) for i in top}
        own = {category[i] for cc, i in hist if cc == c}
        expected |= {(c, i) for i in sorted(i for i in category if category[i] in own)[:200]}
    got = rows_of(X.training_candidates(d.hist, d.recent, d.items))
    assert got == sorted(expected)


def test_feature_subset_rejects_unknown_sizes(spark, make):
    with pytest.raises(ValueError, match="size 4"):
        X.feature_subset(make([(1,)], "a int"), 4)


def test_empty_history(make, items):
    none = txns(make, [(1, 1, "2030-01-01")])
    table = X.build_feature_label_table(
        none, items, None, datetime(2024, 1, 1), END, END, datetime(2024, 3, 1)
    )
    assert table.count() == 0


def test_segments(make):
    items = make(
        [(1, "sua bot", "Step 1"), (2, "sua bot", "Step 2"), (3, None, "Step 1"), (4, "x sua", "Step 1")],
        "item_id long, category string, age_group string",
    )
    seg = segments.build_item_segment_step1(items)
    assert [r.segment for r in seg.orderBy("item_id").collect()] == [
        "milk_step1",
        "other",
        "other",
        "milk_step1",
    ]
    hist = txns(
        make,
        [
            (1, 1, "2024-01-01"),
            (1, 2, "2024-01-02"),  # tie, "other" bought last
            (2, 2, "2024-01-01"),
            (2, 1, "2024-01-02"),  # tie, "milk_step1" bought last
            (3, 1, "2024-01-05"),
            (3, 2, "2024-01-05"),  # full tie: the lower name
            (4, 1, "2024-01-05"),
            (4, 2, "2024-01-01"),
            (4, 2, "2024-01-01"),  # more often
        ],
    )
    got = rows_of(segments.build_customer_segment_from_step1(hist, seg))
    assert got == [(1, "other"), (2, "milk_step1"), (3, "milk_step1"), (4, "other")]


def test_age_in_months(make):
    users = make(
        [(1, datetime(2024, 1, 1).date()), (2, None)], "customer_id long, date_of_birth date"
    )
    got = rows_of(
        add_baby_age_feature(users, datetime(2024, 3, 2)).select(
            "customer_id", F.coalesce("age_in_month", F.lit(-1))
        )
    )
    assert got == [(1, 2), (2, -1)]  # 61 days are two months of 30.4375


def _given_pairs(make):
    """Half of the pairs have one item; one customer has very many; ids may be null or repeated."""
    pairs = [(c, 1) for c in range(60)] + [(7, i) for i in range(2, 40)] + [(7, 5), (7, 5), (None, 1), (3, None), (99, 4), (3, 404)]
    recent = [(c, 1) for c in range(0, 60, 2)] + [(7, i) for i in range(1, 40, 3)] + [(7, 4)] * 30 + [(None, 1), (3, None)]
    hist = [(c, 1 + (c * k) % 40, f"2024-01-{1 + (c + k) % 28:02}") for c in range(60) for k in range(c % 5)]
    catalogue = [(i, f"b{i % 3}" if i % 7 else None, f"s{i % 2}", f"c{i % 4}") for i in range(1, 40)]
    return (
        make([(c, i, "x") for c, i in pairs], "customer_id long, item_id long, note string"),
        make(recent, PAIRS),
        txns(make, hist),
        make(catalogue, ITEMS),
    )


PAIRS = "customer_id long, item_id long"


@pytest.mark.parametrize("sent", [True, False])
@pytest.mark.parametrize("size", [4096, 5])
def test_given_pairs_are_packed(spark, make, monkeypatch, sent, size):
    """Both ways to attributes, long lists cut, equal plain joins; pairs move by customer only."""
    monkeypatch.setattr(X, "LIST", size)
    pairs, recent, hist, items = _given_pairs(make)
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, before if sent else "-1")
    try:
        y = X.labels(recent)
        plain = pairs.join(y, ["customer_id", "item_id"], "left").select(*pairs.columns, F.coalesce("Y", F.lit(0)).alias("Y"))
        labelled = X.label_candidates(pairs, recent)
        order = lambda df: sorted(map(str, df.collect()))
        assert labelled.columns == [*pairs.columns, "Y"] and order(labelled) == order(plain)

        counts = hist.join(items, "item_id", "left")
        joined = pairs.join(items, "item_id", "left")
        for a, x in zip(X.ATTRIBUTES, config.FEATURE_COLUMNS[:3], strict=True):
            n = counts.groupBy("customer_id", a).agg(F.count("*").alias(x))
            joined = joined.join(n, ["customer_id", a], "left")
        wanted = joined.select("customer_id", "item_id", *[F.coalesce(x, F.lit(0)).alias(x) for x in config.FEATURE_COLUMNS[:3]])
        found = X.candidate_features(pairs, hist, items)
        assert order(found) == order(wanted)

        table = X.build_feature_label_table(
            hist.unionByName(recent.withColumn("created_date", F.lit("2024-02-15").cast("timestamp_ntz"))),
            items, None, datetime(2024, 1, 1), END, END, datetime(2024, 3, 1), candidates=pairs,
        )
        assert order(table.select("customer_id", "item_id", "Y")) == order(plain.select("customer_id", "item_id", "Y"))
        for df in (labelled, found, table):
            text = df._jdf.queryExecution().executedPlan().toString()
            on = re.findall(r"Exchange hashpartitioning\((.*), \d+\),", text)
            assert not [e for e in on if re.search(r"customer_id#\d+L?, item_id", e)]
            # The history meets its items; the pairs do so salted, or not at all.
            if df is labelled:
                assert not [e for e in on if "item_id#" in e]
            elif not sent:
                assert any("item_id#" in e and "__salt" in e for e in on)
    finally:
        spark.conf.set(key, before)


@pytest.mark.parametrize("sent", [True, False])
@pytest.mark.parametrize("by_customer", [True, False])
def test_candidate_features_move_pairs_once_at_most(spark, make, monkeypatch, by_customer, sent):
    """Pairs made by customer stay where they are, others are not packed; frequent items are sent, rare ones looked up."""
    monkeypatch.setattr(X, "FREQUENT", 4)
    pairs, recent, hist, items = _given_pairs(make)
    recent = recent.where("customer_id IS NOT NULL AND item_id IS NOT NULL")
    if by_customer:
        pairs = X.training_candidates(hist, recent, items, top_n=1, max_per_customer=2, by_customer=True)
        plain = X.training_candidates(hist, recent, items, top_n=1, max_per_customer=2)
        assert rows_of(pairs) == rows_of(plain)
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, before if sent else "-1")
    try:
        counts = hist.join(items, "item_id", "left")
        joined = pairs.join(items, "item_id", "left")
        for a, x in zip(X.ATTRIBUTES, config.FEATURE_COLUMNS[:3], strict=True):
            n = counts.groupBy("customer_id", a).agg(F.count("*").alias(x))
            joined = joined.join(n, ["customer_id", a], "left")
        wanted = joined.select("customer_id", "item_id", *[F.coalesce(x, F.lit(0)).alias(x) for x in config.FEATURE_COLUMNS[:3]])
        found = X.candidate_features(pairs, hist, items)
        text = found._jdf.queryExecution().executedPlan().toString()
        order = lambda df: sorted(map(str, df.collect()))
        assert order(found) == order(wanted)
        assert "collect_list" not in text
        on = re.findall(r"Exchange hashpartitioning\((.*), \d+\),", text)
        if by_customer and sent:
            assert "Bucketed: true" in text and len(on) == 1  # the customers' maps
    finally:
        spark.conf.set(key, before)


@pytest.mark.parametrize("size", [4096, 1])
def test_labels_of_pairs_made_by_customer(make, monkeypatch, size):
    """Such pairs are labelled where they are; with lists that have to be cut they are packed."""
    monkeypatch.setattr(X, "LIST", size)
    _, recent, hist, items = _given_pairs(make)
    pairs = X.training_candidates(hist, recent, items, top_n=1, max_per_customer=2, by_customer=True)
    y = X.labels(recent)
    wanted = pairs.join(y, ["customer_id", "item_id"], "left").select(*pairs.columns, F.coalesce("Y", F.lit(0)).alias("Y"))
    found = X.label_candidates(pairs, recent)
    packed = "collect_list" in found._jdf.queryExecution().executedPlan().toString()
    assert packed == (size == 1)
    assert sorted(map(str, found.collect())) == sorted(map(str, wanted.collect()))
