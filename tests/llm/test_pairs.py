"""Jaccard join, decontamination and search against plain Python."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest

from cartwise.llm import op3_decontaminate as dec
from cartwise.llm import op5_search as search
from cartwise.llm import op7_jaccard_join as jac

WORD = re.compile("[^\x20\x09-\x0d]+")


def shingles(text):
    words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return set()
    return {tuple(words)} if len(words) < 5 else {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def classes_of(texts):
    sets = {i: shingles(t) for i, t in texts.items()}
    label = {i: i for i in texts}

    def find(i):
        while label[i] != i:
            i = label[i]
        return i

    ids = sorted(texts)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= 75 * len(x | y):
                low, high = sorted((find(a), find(b)))
                label[high] = low
    return {i: (len(sets[i]), find(i)) for i in ids}


def joined(make, texts, hot=None, monkeypatch=None):
    docs = make([(i, t, "x", 1) for i, t in texts.items()], "doc_id long, text string, node string, n int")
    return {r.doc_id: (r.n_shingles, r.component_id) for r in jac.components(docs).collect()}


def varied(rng, size, edits, words):
    base = [rng.choice(words) for _ in range(size)]
    for _ in range(edits):
        base[rng.randrange(size)] = rng.choice(words)
    return base


@pytest.mark.parametrize("seed", [1, 2])
def test_jaccard_join_finds_every_class(make, seed):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(300)]
    texts, n = {}, 0
    for size in (3, 5, 6, 8, 9, 12, 20, 33, 47, 60, 90, 150, 400):
        base = [rng.choice(words) for _ in range(size)]
        for edits in (0, 0, 1, 1, 2, 3, 5, 8):
            own = list(base)
            for _ in range(edits):
                at = rng.randrange(len(own) + 1)
                kind = rng.random()
                if kind < 0.4 and at < len(own):
                    own[at] = rng.choice(words)
                elif kind < 0.7:
                    own.insert(at, rng.choice(words))
                elif len(own) > 1:
                    del own[min(at, len(own) - 1)]
            texts[n] = " ".join(own).upper() if rng.random() < 0.3 else "\n ".join(own)
            n += 1
    texts[n], texts[n + 1], texts[n + 2] = None, "", " \n"
    assert joined(make, texts) == classes_of(texts)


def test_jaccard_join_with_hot_groups_and_shared_passages(make, monkeypatch):
    """Groups above the limit of a key, chains, and one passage in everything."""
    monkeypatch.setattr(jac, "HOT", 4)
    rng = random.Random(5)
    words = [f"w{i}" for i in range(5000)]
    passage = [rng.choice(words) for _ in range(40)]
    texts = {}
    for group in range(3):
        base = [rng.choice(words) for _ in range(60 + 40 * group)]
        for member in range(14):
            own = list(base)
            for _ in range(member % 5):
                own[rng.randrange(len(own))] = rng.choice(words)
            texts[len(texts)] = " ".join(own)
    chain = [rng.choice(words) for _ in range(80)]
    for _ in range(12):
        chain = chain[4:] + [rng.choice(words) for _ in range(4)]
        texts[len(texts)] = " ".join(chain)
    for _ in range(25):
        texts[len(texts)] = " ".join(passage + [rng.choice(words) for _ in range(rng.choice((2, 9, 15, 60)))])
    assert joined(make, texts) == classes_of(texts)


def test_tokens_are_stored_of_sets_left_by_the_sketches_and_stay_where_they_are(make, monkeypatch):
    """Sets that only meet in the keys of a passage many texts have do not have their tokens stored."""
    monkeypatch.setattr(jac, "HOT", 4)
    rng = random.Random(8)
    passage = [f"p{i}" for i in range(60)]
    texts = {i: " ".join(passage + [str(rng.randrange(10**9)) for _ in range(120)]) for i in range(60)}
    texts[60] = texts[59] + " one more"
    same, stored = jac.materialize, {}

    def watched(df, name):
        if name == "tokens":
            plan = df._jdf.queryExecution().executedPlan().toString()
            assert "Join" not in plan and "Exchange" not in plan
        stored.setdefault(name, []).append(out := same(df, name))
        return out

    monkeypatch.setattr(jac, "materialize", watched)
    assert joined(make, texts) == classes_of(texts)
    met = stored["wanted"][0].select("node").distinct().count()
    left = stored["sets"][-1]
    assert met > 20 and left.where("not over").count() <= 2 and left.count() < met


def test_jaccard_join_of_no_and_repeated_rows(spark, make):
    assert jac.components(make([], "doc_id long, text string")).count() == 0
    docs = make([(2, "a b c d e f"), (2, "a b c d e f"), (1, "A b c d e f"), (None, None)], "doc_id long, text string")
    found = sorted((r.doc_id or 0, r.n_shingles, r.component_id or 0) for r in jac.components(docs).collect())
    assert found == [(0, 0, 0), (1, 2, 1), (2, 2, 1), (2, 2, 1)]
    long = " ".join(f"w{i}" for i in range(60))
    docs = make([(4, long), (4, long), (3, f"{long} more"), (5, f"less {long}"), (4, "other words under one id")], "doc_id long, text string")
    found = sorted((r.doc_id, r.n_shingles, r.component_id, r.n_links) for r in jac.components(docs).collect())
    # All three long sets link; the links that were needed to see it are counted.
    assert [f[:3] for f in found] == [(3, 57, 3), (4, 1, 4), (4, 56, 3), (4, 56, 3), (5, 57, 3)]


def test_jaccard_join_of_a_very_long_text(make):
    rng = random.Random(9)
    words = [str(rng.randrange(10**6)) for _ in range(60_000)]
    other = list(words)
    for i in range(0, 60_000, 300):
        other[i] = "x"
    found = joined(make, {7: " ".join(words), 8: " ".join(other), 9: " ".join(words[:30_000])})
    assert {i: c for i, (_, c) in found.items()} == {7: 7, 8: 7, 9: 9}


def test_classes_follow_long_chains(make):
    links = make([(i, i + 1) for i in range(200)] + [(500, 501)], "a long, b long")
    found = {r.id: r.label for r in jac.classes(links).collect()}
    assert found == dict.fromkeys(range(201), 0) | {500: 500, 501: 500}


def plain_overlap(text, items):
    pattern = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
    lower = lambda t: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
    words, hit, ids = pattern.findall(lower(text)), set(), set()
    for item, own in items:
        w = pattern.findall(lower(own))
        size = min(13, len(w))
        for i in range(len(w) - size + 1) if w and item is not None else ():
            for at in range(len(words) - size + 1):
                if words[at : at + size] == w[i : i + size]:
                    hit.update(range(at, at + size))
                    ids.add(str(item))
    return len(words), len(hit), sorted(ids)


def test_decontamination_is_exact(make):
    rng = random.Random(3)
    words = ["The", "of", "a", "É1", "to", "in", "x2", "zeta"]
    items = [(i, " ".join(rng.choice(words) for _ in range(n))) for i, n in enumerate((1, 3, 12, 13, 14, 30))]
    items += [(9, items[3][1]), (10, None), (11, ""), (None, "of a to"), (9, items[3][1])]
    texts = [" ".join(rng.choice(words) for _ in range(rng.randrange(40))) for _ in range(30)]
    texts += [f"{texts[3]}, {t}! {texts[4]}" for _, t in items if t] + [None, "", "--", texts[5], texts[5]]
    docs = make([(i % 30, t, "y", 0) for i, t in enumerate(texts)], "doc_id long, text string, key string, pos int")
    bench = make([(i, t, "q") for i, t in items], "item_id long, text string, words string")
    found = dec.overlaps(docs, bench, keep=("doc_id", "text")).collect()
    assert len(found) == len(texts)
    for r in found:
        assert (r.n_words, r.n_hit, list(r["items"])) == plain_overlap(r.text, items), r.text


def test_equal_rows_keep_their_hits(make):
    item = "one two three four five six seven eight nine ten eleven twelve thirteen"
    text = f"before {item} after"
    bench = make([(1, item), (2, "so so so so")], "item_id long, text string")
    docs = make([(7, text)] * 3 + [(None, text)] * 2 + [(8, "so so so so so")] * 2, "doc_id long, text string")
    found = dec.overlaps(docs, bench).select("doc_id", "n_hit", dec.is_contaminated().alias("is")).collect()
    assert len(found) == 7 and all(r["is"] and r.n_hit == (5 if r.doc_id == 8 else 13) for r in found)


def test_decontamination_of_empty_tables(make):
    docs, none = make([(1, "a b c")], "doc_id long, text string"), make([], "item_id long, text string")
    assert [(r.n_words, r.n_hit, r["items"]) for r in dec.overlaps(docs, none).collect()] == [(3, 0, [])]
    assert dec.overlaps(make([], "doc_id long, text string"), make([(1, "a")], "item_id long, text string")).count() == 0


def test_main_path_of_decontamination_is_native(make):
    docs, bench = make([(1, "a b c")], "doc_id long, text string"), make([(1, "b c")], "item_id long, text string")
    plan = dec.overlaps(docs, bench)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_proximity(make):
    docs = make([(1, "fox a b dog c fox"), (2, "dog"), (3, None)], "doc_id long, text string")
    found = sorted(tuple(r) for r in dec.near(docs, "fox", "dog", 2).collect())
    assert found == [(1, 5, 3)]
    assert dec.near(docs, "fox", "dog", 3).count() == 2


def test_search_is_exact(make):
    rng = np.random.default_rng(4)
    rows = [(int(i), [float(x) for x in rng.normal(size=20) * (5 if i % 7 else 0.2)]) for i in range(900)]
    rows += [(1000, None), (1001, []), (1002, [None] * 20), (1003, [float("nan")] * 20), (1050, [1.0, 2.0]), (None, [1.0] * 20)]
    rows += [(2000 + i, rows[3][1]) for i in range(9)]  # ties
    rows += [(1100, [1.5, -2.0]), (1100, [1.5, -2.0])]  # a repeated query and row
    frame = make([(i, v, 0) for i, v in rows], "vec_id long, embedding array<double>, score int")
    vectors = search.whole_vectors(frame)
    got = {}
    for r in search.top_k(vectors, vectors.where("vec_id % 50 = 0"), 5, block=8).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    whole = [(i, np.floor(256 * np.array(v)).astype(int)) for i, v in rows if i is not None and v and None not in v and v[0] == v[0]]
    for q, v in whole:
        if q % 50 == 0:
            near = sorted((-int(v @ x), i) for i, x in whole if i != q and len(x) == len(v))[:5]
            assert sorted(got.pop(q, [])) == [(n, i, -s) for n, (s, i) in enumerate(near, 1)]
            got.setdefault(q, [])if q == 1100 else None
            if q == 1100:
                break
    assert not any(got.values())


def test_bounds_of_the_search_hold():
    rng = np.random.default_rng(1)
    q, x = rng.integers(-300, 300, (40, 50)).astype(float), rng.integers(-300, 300, (60, 50)).astype(float)
    for segments in search.SEGMENTS:
        bound = search._statistics(q, segments) @ search._statistics(x, segments).T
        assert (bound + 1e-6 >= q @ x.T).all()


def test_search_of_an_empty_table(make):
    vectors = search.whole_vectors(make([], "vec_id long, embedding array<float>"))
    assert search.top_k(vectors, vectors, 5).count() == 0


def test_jaccard_join_through_a_row_without_an_id(make):
    """A and B link only by way of N, which has no id."""
    words = [f"w{i}" for i in range(100)]
    a, n, b = words[:80], words[8:88], words[16:96]
    docs = make([(2, " ".join(a)), (None, " ".join(n)), (5, " ".join(b)), (None, "w1 w2 w3"), (None, None)], "doc_id long, text string")
    found = [(r.doc_id, r.n_shingles, r.component_id) for r in jac.components(docs).collect()]
    assert sorted(found, key=str) == sorted([(2, 76, 2), (None, 76, 2), (5, 76, 2), (None, 1, None), (None, 0, None)], key=str)


@pytest.mark.parametrize("seed", range(4))
def test_sketches_never_exceed_the_difference(seed):
    draw = np.random.default_rng(seed)
    for size in (1, 5, 40, 300, 3000):
        x = np.unique(draw.integers(0, 1 << 63, size).astype(np.uint64))
        other = np.unique(draw.integers(0, 1 << 63, size // 3 + 1).astype(np.uint64))
        for y in (x, np.union1d(x, other), np.union1d(x[len(x) // 4 :], other), other):
            apart = len(np.setxor1d(x, y))
            x_, y_ = (np.frombuffer(jac._sketch(s), np.uint64) for s in (x, y))
            assert jac._least_difference(x_, y_) <= apart
            row = np.repeat([0, 1], [len(x), len(y)])
            brief = jac._brief(row, np.concatenate([x, y]), 2)
            assert np.bitwise_count((brief[0] ^ brief[1]).view(np.uint64)).sum() <= apart
            if apart == 0:
                assert jac._sketch(x) == jac._sketch(y)
