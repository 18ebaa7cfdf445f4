"""Importance resampling against a plain version that does not know lines."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest

from cartwise.llm import op13_resample as res

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def features(text, low, high, buckets):
    words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    runs = [" ".join(words[i : i + k]) for k in range(low, high + 1) for i in range(len(words) - k + 1)]
    return len(words), [zlib.crc32(r.encode()) % buckets for r in runs]


def plain(docs, target, low, high, buckets, least, percent, seed):
    corpus = [features(t, low, high, buckets) for _, t in docs]
    s = Counter(b for _, f in corpus for b in f)
    t = Counter(b for text in target for b in features(text, low, high, buckets)[1])
    whole_s, whole_t = sum(s.values()), sum(t.values())

    def gain(b):
        return math.floor(1000 * math.log((t[b] + 1) * (whole_s + buckets) / ((s[b] + 1) * (whole_t + buckets))))

    rows = []
    for (doc_id, _), (n_words, f) in zip(docs, corpus, strict=True):
        weight = sum(map(gain, f)) // len(f) if f else 0
        h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append((doc_id, n_words, len(f), weight, score))
    fit = sorted((r for r in rows if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0] or 0, r[2], r[3]))
    drawn = fit[: percent * len(fit) // 100]
    rest = Counter(rows) - Counter(drawn)
    out = [(*r, i) for i, r in enumerate(drawn, 1)] + [(*r, None) for r in rest.elements()]
    return sorted(out, key=str)


@pytest.mark.parametrize(("low", "high"), [(1, 1), (1, 2), (2, 3), (3, 3)])
def test_resampling(make, low, high):
    rng = random.Random(low * 10 + high)
    words = ["The", "of", "É1", "to", "zeta", "x2", "日本", "--", "a\x00b"]
    lines = [" ".join(rng.choice(words) for _ in range(rng.randrange(7))) for _ in range(25)]
    texts = ["\n".join(rng.choice(lines) for _ in range(rng.randrange(9))) for _ in range(80)]
    texts += [None, "", "\n", "\n\n--\n", "one", texts[0], texts[1] + "\n", "long " * 5000]
    docs = list(enumerate(texts)) + [(3, texts[3])] * 3 + [(3, texts[4])] * 2 + [(None, texts[5])] * 2 + [(-9, texts[6])]
    target = ["zeta of zeta\nof x2", "The x2", None, "", "日本 zeta"]
    frame = make([(i, t, "x", 7, "y") for i, t in docs], "doc_id long, text string, line string, row int, rank string")
    bench = make([(i, t) for i, t in enumerate(target)], "item_id long, text string")
    options = dict(low=low, high=high, buckets=97, least_words=3, percent=40, seed=5)
    found = res.resample(frame, bench, **options).collect()
    assert sorted((tuple(r) for r in found), key=str) == plain(docs, target, low, high, 97, 3, 40, 5)


def test_a_line_that_most_documents_share(make, monkeypatch):
    """Hot lines take the broadcast; the result is the same."""
    texts = [f"shared passage of all\nown words {i} here\nshared passage of all" for i in range(60)]
    docs = list(enumerate(texts))
    frame, bench = make(docs, "doc_id long, text string"), make([(1, "own words")], "item_id long, text string")
    for shares in (2, 1000):
        weights = res.document_weights(frame, bench, shares=shares)
        found = sorted((r.doc_id, r.n_words, r.n_features, r.weight) for r in weights.collect())
        assert found == sorted(r[:4] for r in plain(docs, ["own words"], 1, 1, 10_000, 1, 0, 2024))


def test_a_line_is_split_once(make):
    """The line table has distinct lines, each with its occurrences."""
    docs = make([(i, "a b\nc\na b") for i in range(50)] + [(99, "c\nd")], "doc_id long, text string")
    lines = sorted((r.n_times, r.n_words, len(r.found)) for r in res.line_table(docs).collect())
    assert lines == [(1, 1, 1), (51, 1, 1), (100, 2, 2)]


def test_many_equal_rows_are_drawn_one_by_one(make, monkeypatch):
    monkeypatch.setattr(res, "STEP", 7)
    docs = make([(1, "a b c")] * 40 + [(2, "a b")] * 10, "doc_id long, text string")
    found = res.resample(docs, make([(1, "a")], "item_id long, text string"), least_words=1, percent=50).collect()
    assert len(found) == 50 and sorted(r["rank"] for r in found if r["rank"]) == list(range(1, 26))


def test_empty_tables(make):
    none, one = make([], "doc_id long, text string"), make([(1, "a b")], "doc_id long, text string")
    bench = make([], "item_id long, text string")
    assert res.resample(none, bench).count() == 0
    assert [tuple(r)[:3] for r in res.resample(one, bench, least_words=1, percent=100).collect()] == [(1, 2, 2)]
    assert res.drawn_documents(one, res.resample(one, bench, least_words=1, percent=100)).collect()[0].text == "a b"
