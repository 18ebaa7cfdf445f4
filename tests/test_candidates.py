from __future__ import annotations

import itertools
import random
import re
from collections import Counter
from datetime import datetime

import pytest
from conftest import SF_DIR, rows_of

from cartwise.operators import candidates as C
from cartwise.plans import testdata as td

PAIRS = "customer_id long, item_id long"
BASKETS = "customer_id long, order_id long, item_id long"
TXN = "customer_id long, item_id long, created_date timestamp_ntz"
DAY = datetime(2024, 3, 1)


@pytest.fixture(scope="module")
def baskets():
    rnd = random.Random(3)
    rows = [(c, c % 3, rnd.randint(0, 40)) for c in range(30) for _ in range(rnd.randint(1, 8))]
    # One basket with far more items than the others, with repeated rows.
    rows += [(99, 0, i) for i in range(60)] * 2
    return rows


def brute_force(rows):
    per_basket = {}
    for c, o, i in rows:
        per_basket.setdefault((c, o), set()).add(i)
    counts = Counter()
    for items in per_basket.values():
        counts.update(itertools.combinations(sorted(items), 2))
    return sorted((a, b, n) for (a, b), n in counts.items())


@pytest.mark.parametrize("block_items", [1, 2, 7, 1000])
def test_cooccurrence_with_and_without_blocks(make, baskets, block_items):
    rows = make([*baskets, (1, 0, None), (None, 1, 5)], BASKETS)
    got = rows_of(C.build_item_cooccurrence(rows, ["customer_id", "order_id"], block_items))
    assert got == brute_force(baskets)


@pytest.mark.parametrize("rank_by", ["count", "id"])
def test_an_item_in_half_of_all_histories(make, rank_by):
    """The grid gives what a plain join and sum give."""
    rng = random.Random(11)
    bought = sorted({(c, 0) for c in range(0, 300, 2)} | {(c, rng.randrange(1, 40)) for c in range(300) for _ in range(3)})
    counts = {(0, b): rng.randrange(1, 9) for b in range(1, 120)} | {(a, b): rng.randrange(1, 9) for a in range(1, 30) for b in range(a + 1, a + 4)}
    totals = {}
    for c, i in bought:
        for (a, b), n in counts.items():
            if i in (a, b):
                key = (c, b if i == a else a)
                totals[key] = totals.get(key, 0) + n
    best = {}
    for (c, i), n in totals.items():
        best.setdefault(c, []).append((-n if rank_by == "count" else 0, i))
    expected = sorted((c, i) for c, rows in best.items() for _, i in sorted(rows)[:6])
    cooc = make([(a, b, n) for (a, b), n in counts.items()], "itemA long, itemB long, cooc_count long")
    assert rows_of(C.generate_candidates_from_cooc(make(bought, PAIRS), cooc, 6, rank_by)) == expected


def test_candidates_from_cooccurrence(make, baskets):
    counts = brute_force(baskets)
    cooc = make(counts, "itemA long, itemB long, cooc_count long")
    bought = sorted({(c, i) for c, _, i in baskets})
    neighbours = {}
    for a, b, n in counts:
        neighbours.setdefault(a, {})[b] = n
        neighbours.setdefault(b, {})[a] = n
    for rank_by in ("count", "id"):
        want = []
        for c in {c for c, _ in bought}:
            total = Counter()
            for cc, i in bought:
                if cc == c:
                    total.update(neighbours.get(i, {}))
            key = (lambda i: (-total[i], i)) if rank_by == "count" else (lambda i: i)
            want += [(c, i) for i in sorted(total, key=key)[:5]]
        got = C.generate_candidates_from_cooc(make(bought, PAIRS), cooc, 5, rank_by)
        assert rows_of(got) == sorted(want)
    with pytest.raises(ValueError, match="ranking"):
        C.generate_candidates_from_cooc(make(bought, PAIRS), cooc, 5, "best")


def test_unknown_strategy(spark):
    with pytest.raises(ValueError, match="Unknown strategy"):
        C.generate_candidates(None, None, None, DAY, "nearest")
    with pytest.raises(ValueError, match="cap mode"):
        C.cap_key("random")


def test_strategies_do_not_exceed_their_budget(spark):
    d = td.load_domain(spark, SF_DIR)
    for strategy in ("user_history", "popular_items", "category_based", "hybrid"):
        got = C.generate_candidates(
            d.transactions, d.items, d.users, td.OBSERVATION_DATE, strategy, 400, 12
        )
        assert got.count() == got.distinct().count() > 0
        assert got.groupBy("customer_id").count().agg({"count": "max"}).collect()[0][0] <= 12


def test_hashed_cap_is_repeatable(spark):
    d = td.load_domain(spark, SF_DIR)
    runs = [
        rows_of(
            C.user_history_candidates(
                d.transactions.repartition(n), td.OBSERVATION_DATE, 2000, 3, cap_mode="hash"
            )
        )
        for n in (1, 5)
    ]
    assert runs[0] == runs[1]
    assert runs[0] != rows_of(
        C.user_history_candidates(d.transactions, td.OBSERVATION_DATE, 2000, 3)
    )


def test_null_items_are_not_candidates(make):
    rows = make([(1, None, DAY.replace(month=2)), (1, 5, DAY.replace(month=2))], TXN)
    assert rows_of(C.user_history_candidates(rows, DAY, 60, 10)) == [(1, 5)]
    assert [r.item_id for r in C.popular_items(rows, 10).collect()] == [5]


def test_recent_purchases_are_removed(make):
    rows = make(
        [(1, 5, datetime(2024, 2, 20)), (1, 6, datetime(2024, 1, 1)), (1, 7, DAY)], TXN
    )
    pairs = make([(1, 5), (1, 6), (1, 7), (2, 5)], PAIRS)
    # The look-back window is half open: a purchase on the day itself is outside.
    assert rows_of(C.filter_already_purchased(pairs, rows, DAY)) == [(1, 6), (1, 7), (2, 5)]


def test_budgets_are_arguments(make):
    history = make(
        [(1, i, datetime(2024, 5, 20)) for i in range(9)] + [(2, 100, datetime(2024, 5, 20))],
        "customer_id long, item_id long, created_date timestamp_ntz",
    )
    items = make([(i, f"c{i % 5}") for i in range(9)] + [(100, "c0")], "item_id long, category string")
    users = make([(1,), (2,)], "customer_id long")

    def generated(strategy, **options):
        found = C.generate_candidates(history, items, users, datetime(2024, 6, 1), strategy, **options)
        return {r.item_id for r in found.where("customer_id = 1").collect()}

    assert generated("user_history", max_candidates_per_user=None) == set(range(9))
    assert generated("user_history", max_candidates_per_user=4) == {0, 1, 2, 3}
    assert len(generated("user_history", max_candidates_per_user=4, cap_mode="hash")) == 4
    everything = {*range(9), 100}
    assert generated("category_based", max_candidates_per_user=None, top_categories=None) == everything
    assert generated("hybrid", max_candidates_per_user=None, top_categories=None) == everything
    with pytest.raises(ValueError, match="max_candidates_per_user"):
        generated("popular_items", max_candidates_per_user=None)


@pytest.mark.parametrize("strategy", ["category_based", "hybrid"])
@pytest.mark.parametrize("rank_by", ["count", "id"])
def test_customers_are_not_exchanged_by_category(spark, make, strategy, rank_by):
    """Most customers have one favourite category. Lists sent or looked up split: the same pairs."""
    rng = random.Random(5)
    items = make([(i, f"b{i % 3}", "s", f"c{0 if i % 2 else i % 7}") for i in range(80)], "item_id long, brand string, age_group string, category string")
    rows = [(c, rng.choice([1, 3, 5, 7, rng.randrange(80)]), datetime(2024, 1, 1 + rng.randrange(28))) for c in range(150) for _ in range(4)]
    history = make(rows, "customer_id long, item_id long, created_date timestamp_ntz")
    users = history.select("customer_id").distinct()
    key = "spark.sql.autoBroadcastJoinThreshold"
    before, found = spark.conf.get(key), []
    for limit in (before, "-1"):
        spark.conf.set(key, limit)
        try:
            df = C.generate_candidates(history, items, users, datetime(2024, 2, 1), strategy, 40, 30, rank_by=rank_by)
            text = df._jdf.queryExecution().executedPlan().toString()
            lines = text.splitlines()
            on = [(line, below) for line, below in itertools.pairwise(lines) if re.search(r"hashpartitioning\((category|__key0)#", line)]
            # Counts by category are combined before they move; customers move salted.
            moved = [line for line, below in on if "HashAggregate" not in below and "Window" not in below]
            assert all("__salt" in line or "__none" in line for line in moved), moved
            assert any("__salt" in line for line in moved) == (limit == "-1")
            found.append(rows_of(df))
        finally:
            spark.conf.set(key, before)
    assert found[0] == found[1] and found[0]
