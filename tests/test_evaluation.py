"""Metrics against a plain Python reading of their definitions."""

from __future__ import annotations

import math
import random

import pytest
from conftest import rows_of

from cartwise.operators import evaluation as E
from cartwise.operators.ranking import rank_topk

KS = (1, 3, 5)


def gain(place: int) -> float:
    return 1 / math.log2(place + 1)


def user_figures(listed: list[int], bought: set[int], k: int) -> dict[str, float]:
    top = listed[:k]
    places = [p for p, i in enumerate(top, start=1) if i in bought]
    best = sum(gain(p) for p in range(1, min(len(bought), k) + 1))
    return {
        "precision": len(places) / k,
        "listed_precision": len(places) / len(top),
        "recall": len(places) / len(bought) if bought else 0.0,
        "ndcg": sum(map(gain, places)) / best if best else 0.0,
        "map": sum(n / p for n, p in enumerate(places, start=1)) / min(len(bought), k)
        if bought
        else 0.0,
    }


def mean(values: list[float]) -> float:
    return sum(values) / len(values) if values else 0.0


@pytest.fixture(scope="module")
def world(make):
    rnd = random.Random(5)
    scores = {
        u: {i: rnd.randint(0, 4) / 4 for i in rnd.sample(range(30), rnd.randint(1, 12))}
        for u in range(40)
    }
    bought = {u: set(rnd.sample(range(30), rnd.randint(1, 9))) for u in range(20, 60)}
    predictions = make(
        [(u, i, s) for u, own in scores.items() for i, s in own.items()],
        "customer_id long, item_id long, score double",
    )
    # Every purchase twice: repeated purchases count once.
    truth = make(
        [(u, i) for u, own in bought.items() for i in own] * 2, "customer_id long, item_id long"
    )
    listed = {u: sorted(own, key=lambda i: (-own[i], i)) for u, own in scores.items()}
    return predictions, truth, listed, bought


def table(df) -> dict[tuple[str, int], float]:
    return {(m, k): v for m, k, v in rows_of(df)}


def test_users_on_both_sides(world):
    predictions, truth, listed, bought = world
    got = table(E.evaluate_recommendations(predictions, truth, KS))
    both = [u for u in listed if u in bought]
    for k in KS:
        for metric in ("precision", "recall", "ndcg", "map"):
            want = mean([user_figures(listed[u], bought[u], k)[metric] for u in both])
            assert got[metric, k] == pytest.approx(want), (metric, k)
    assert all(0 <= v <= 1 for v in got.values())
    assert got["recall", 1] <= got["recall", 3] <= got["recall", 5]


def test_single_metrics_are_the_same_figures(world):
    predictions, truth, *_ = world
    got = table(E.evaluate_recommendations(predictions, truth, [3]))
    for name, fn in {
        "precision": E.precision_at_k,
        "recall": E.recall_at_k,
        "ndcg": E.ndcg_at_k,
        "map": E.mean_average_precision_at_k,
    }.items():
        assert table(fn(predictions, truth, 3)) == {(name, 3): got[name, 3]}


def test_all_predicted_users(world):
    predictions, truth, listed, bought = world
    got = table(E.evaluate_ranking(rank_topk(predictions), truth, KS))
    for k in KS:
        for metric in ("precision", "ndcg"):
            want = mean([user_figures(listed[u], bought.get(u, set()), k)[metric] for u in listed])
            assert got[metric, k] == pytest.approx(want), (metric, k)


def test_lists_cut_short_keep_their_hits(world):
    predictions, truth, listed, bought = world
    got = table(E.evaluate_ground_truth(rank_topk(predictions, 3), truth, (3, 5)))
    both = [u for u in listed if u in bought]
    for k in (3, 5):
        own = []
        for u in both:
            figures = user_figures(listed[u][:3], bought[u], 3)
            best = sum(gain(p) for p in range(1, min(len(bought[u]), k) + 1))
            places = [p for p, i in enumerate(listed[u][:3], start=1) if i in bought[u]]
            own.append((figures["listed_precision"], figures["recall"], sum(map(gain, places)) / best))
        p, r, g = (mean([x[j] for x in own]) for j in range(3))
        assert got["precision", k] == pytest.approx(p)
        assert got["recall", k] == pytest.approx(r)
        assert got["ndcg", k] == pytest.approx(g)
        assert got["f1", k] == pytest.approx(2 * p * r / (p + r))
    assert got["precision", 3] == got["precision", 5]


def test_perfect_ranking_and_no_common_users(make):
    schema = "customer_id long, item_id long, score double"
    predictions = make([(1, 10, 0.9), (1, 11, 0.8), (1, 12, 0.1)], schema)
    truth = make([(1, 10), (1, 11)], "customer_id long, item_id long")
    got = table(E.evaluate_recommendations(predictions, truth, [2, 3]))
    assert got["ndcg", 2] == got["ndcg", 3] == got["map", 3] == got["recall", 2] == 1.0
    other = make([(2, 10)], "customer_id long, item_id long")
    assert set(table(E.evaluate_recommendations(predictions, other, [2])).values()) == {0.0}
    assert set(table(E.evaluate_ground_truth(rank_topk(predictions), other, [2])).values()) == {0.0}
    assert set(table(E.evaluate_ranking(rank_topk(predictions), other, [2])).values()) == {0.0}


def test_text_and_number_ids_meet(make):
    ranked = make([(1, 10, 0.9, 1)], "customer_id long, item_id long, score double, rank int")
    truth = make([("1", "10")], "customer_id string, item_id string")
    assert table(E.evaluate_ground_truth(ranked, truth, [1]))["precision", 1] == 1.0


def test_ranks_are_contiguous_and_ties_go_by_item(make):
    scored = make(
        [(1, 5, 0.5), (1, 3, 0.5), (1, 9, 0.7), (2, 1, 0.1)],
        "customer_id long, item_id long, score double",
    )
    got = [(r.customer_id, r.item_id, r.rank) for r in rank_topk(scored).collect()]
    assert sorted(got) == [(1, 3, 2), (1, 5, 3), (1, 9, 1), (2, 1, 1)]
    assert rank_topk(scored, 1).count() == 2


def test_ground_truth_forms(make):
    text = make(
        [("1", "[10, 11]"), ("2", "[[20, 21], [22]]"), ("3", '"30"'), ("4", "[]"), ("1", "[10]")],
        "customer_id string, items string",
    )
    want = [("1", "10"), ("1", "11"), ("2", "20"), ("2", "21")]
    assert rows_of(E.ground_truth_pairs(text)) == want
    flat = make([(1, [10, 11]), (4, [])], "customer_id long, items array<long>")
    assert rows_of(E.ground_truth_pairs(flat)) == want[:2]
    nested = make([(2, [[20, 21], [22]])], "customer_id long, items array<array<long>>")
    assert rows_of(E.ground_truth_pairs(nested)) == want[2:]
