"""Vector codes against plain rounds that scan every entry."""

from __future__ import annotations

import math
from collections import defaultdict

import numpy as np
import pytest

from cartwise.llm import op12_codes as codes


def plain(rows, parts, entries, rounds):
    """(code, error) of each row and the last codebooks, by whole scans of whole numbers."""
    width = len(rows[0][1]) // parts
    order = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:entries]
    out, books = [[[], 0] for _ in rows], []
    for p in range(parts):
        x = [r[1][p * width : (p + 1) * width] for r in rows]
        book = [r[1][p * width : (p + 1) * width] for r in order]
        for t in range(rounds + 1):
            near = [min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), e) for e, c in enumerate(book)) for v in x]
            if t == rounds:
                break
            members = defaultdict(list)
            for v, (_, e) in zip(x, near, strict=True):
                members[e].append(v)
            book = [[sum(c) // len(c) for c in zip(*members[e], strict=True)] if e in members else book[e] for e in range(len(book))]
        books.append(book)
        for o, (d, e) in zip(out, near, strict=True):
            o[0].append(e)
            o[1] += d
    return [(bytes(c), e) for c, e in out], books


@pytest.mark.parametrize(("n", "parts", "entries", "rounds", "spread"), [(700, 4, 256, 4, 40), (300, 2, 16, 6, 3), (30, 4, 256, 3, 200), (200, 1, 7, 1, 2)])
def test_codes(spark, n, parts, entries, rounds, spread):
    rng = np.random.default_rng(n)
    centres = rng.integers(-900, 900, (12, 4 * parts))
    v = (centres[rng.integers(0, 12, n)] + rng.integers(-spread, spread + 1, (n, 4 * parts))).tolist()
    rows = [(int(i) if i % 50 else None, x) for i, x in zip(rng.permutation(n), v, strict=True)] + [(5, v[3])] * 3 + [(5, v[4])]
    frame = spark.createDataFrame([(i, None if k % 9 == 0 else k % 3, x) for k, (i, x) in enumerate(rows)], "vec_id long, label int, v array<long>")
    found, books = codes.codes(frame, parts, entries, rounds)
    expected, plain_books = plain(rows, parts, entries, rounds)
    assert [b.tolist() for b in books] == plain_books
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[2])
    assert sorted([(r.vec_id, bytes(r.code), r.error) for r in found.collect()], key=key) == sorted(
        [(i, *e) for (i, _), e in zip(rows, expected, strict=True)], key=key
    )
    errors = defaultdict(int)
    for r in found.collect():
        errors[r.label] += r.error
    assert {r.label: r.label_error for r in codes.with_label_errors(found).collect()} == errors


def test_large_whole_numbers_are_exact(spark):
    rng = np.random.default_rng(8)
    rows = [(i, [int(x) for x in rng.integers(-(2**27), 2**27, 4)]) for i in range(60)]
    found, books = codes.codes(spark.createDataFrame([(i, 0, v) for i, v in rows], "vec_id long, label int, v array<long>"), 2, 8, 3)
    expected, plain_books = plain(rows, 2, 8, 3)
    assert [b.tolist() for b in books] == plain_books
    assert sorted((r.vec_id, bytes(r.code), r.error) for r in found.collect()) == [(i, *e) for (i, _), e in zip(rows, expected, strict=True)]
    with pytest.raises(ValueError, match="too large"):
        codes.codes(spark.createDataFrame([(1, 0, [2**40] * 4)], "vec_id long, label int, v array<long>"))


def test_bounds_leave_out_scans_and_are_never_wrong():
    rng = np.random.default_rng(2)
    centres = rng.integers(-900, 900, (64, 8))
    x = centres[rng.integers(0, 64, 4000)] + rng.integers(-60, 61, (4000, 8))
    book = codes.Codebook.of(x[:64].copy())
    state, taken = codes.first_round(x, book), []
    for _ in range(6):
        nearest = codes._squared(x, book.rounds[-1])
        assert (nearest.argmin(1) == state["entry"]).all()
        true = np.sqrt(nearest)
        row = np.arange(len(x))
        since = book.moves()
        assert (state["upper"] + since[state["upper_at"], state["entry"]] + codes.SLACK >= true[row, state["entry"]]).all()
        for g, members in enumerate(book.groups):
            rest = np.where(members[None] == state["entry"][:, None], np.inf, true[:, members]).min(1)
            assert (state["lower"][:, g] - since[:, members].max(1)[state["lower_at"][:, g]] - codes.SLACK <= rest).all()
        entries = book.rounds[-1].copy()
        for e in range(64):
            if (state["entry"] == e).any():
                entries[e] = x[state["entry"] == e].sum(0) // (state["entry"] == e).sum()
        book.rounds.append(entries)
        state, scans = codes.next_round(x, state, book)
        taken.append(scans / (len(x) * len(book.groups)))
    assert taken[-1] < 0.2 and max(taken) < 0.8


def test_net_displacement_is_tighter_than_summed_drift():
    there, back = np.array([[0, 0], [9, 9]]), np.array([[30, 40], [9, 9]])
    book = codes.Codebook([there, back, there], [np.array([0, 1])])
    assert book.moves()[0].tolist() == [0, 0] and math.hypot(30, 40) * 2 == 100


def test_rows_that_take_no_part(make):
    inf, nan = float("inf"), float("nan")
    rows = [(1, [0.5, -0.001, 0.0, 2.0], 1), (2, None, 1), (3, [1.0, None, 1.0, 1.0], 1), (4, [nan] * 4, 2), (5, [1.0, 1.0, 1.0, -inf], 2)]
    rows += [(6, [1.0, 2.0], None), (7, [], None), (8, [0.5, 0.0, 0.0, 2.0], None), (None, [0.5, 0.0, 0.0, 2.0], None)]
    frame = make([(*r, "x", 9) for r in rows], "vec_id long, embedding array<double>, label int, code string, error int")
    found, books = codes.codes(codes.whole_vectors(frame))
    assert sorted((r.vec_id or 0, r.code and bytes(r.code).hex(), r.error) for r in found.collect()) == [
        (0, "00010000", 0), (1, "00000000", 0), (6, None, None), (7, None, None), (8, "00010000", 0),
    ]
    assert [b.tolist() for b in books] == [[[512], [512], [512]], [[-2], [0], [0]], [[0], [0], [0]], [[2048], [2048], [2048]]]


def test_empty_tables(make):
    none = make([], "vec_id long, embedding array<float>, label int")
    found, books = codes.codes(codes.whole_vectors(none))
    assert codes.with_label_errors(found).count() == 0 and books == []
