"""Near-duplicate vectors against all pairs, and the bounds on their own."""

from __future__ import annotations

import numpy as np
import pytest

from cartwise.llm import op11_near_vectors as near


def plain(rows, threshold):
    """(vec_id, n_links, component_id) by all pairs."""
    fit = [v is not None and len(v) > 0 and all(c is not None and np.isfinite(c) for c in v) and any(v) for _, v in rows]
    unit = [np.array(v, float) / np.abs(v).max() / np.linalg.norm(np.array(v, float) / np.abs(v).max()) if f else None for (_, v), f in zip(rows, fit, strict=True)]
    links = {i: [] for i in range(len(rows))}
    for i in range(len(rows)):
        for j in range(i):
            if fit[i] and fit[j] and len(unit[i]) == len(unit[j]) and float(unit[i] @ unit[j]) >= threshold:
                links[i].append(j)
                links[j].append(i)
    out, seen = [None] * len(rows), set()
    for i in range(len(rows)):
        if i in seen:
            continue
        reach, new = {i}, [i]
        while new:
            new = [k for j in new for k in links[j] if k not in reach and not reach.add(k)]
        seen |= reach
        ids = [rows[j][0] for j in reach if rows[j][0] is not None]
        for j in reach:
            out[j] = (rows[j][0], len(links[j]), min(ids) if ids else None)
    return sorted(out, key=str)


def groups(rng, n, size, length):
    """Clusters of near copies, chains and single vectors, away from the threshold."""
    out = []
    while len(out) < n:
        base = rng.normal(size=length)
        for _ in range(rng.integers(1, size)):
            out.append(base / np.linalg.norm(base) + rng.normal(size=length) * rng.choice([0.0, 0.02, 0.05, 0.09]) / np.sqrt(length) * 8)
    return out[:n]


@pytest.mark.parametrize(("length", "bytes_", "threshold"), [(24, 8 << 20, 0.9), (24, 512 * 8 * 24, 0.9), (5, 8 << 20, 0.97), (40, 512 * 8 * 40, 0.6)])
def test_near_vectors(spark, monkeypatch, length, bytes_, threshold):
    monkeypatch.setattr(near, "TILE_BYTES", bytes_)
    rng = np.random.default_rng(length)
    vectors = [v.tolist() for v in groups(rng, 1300, 40, length)]
    rows = [(int(i), v) for i, v in zip(rng.permutation(len(vectors)), vectors, strict=True)]
    rows += [(5000 + i, vectors[7]) for i in range(60)] + [(int(i), [3 * c for c in vectors[int(i)]]) for i in range(20)]
    rows += [(None, vectors[7]), (None, [1.0] * (length + 1)), (9, [1.0] * (length + 1)), (8, [1.0, 2.0]), (8, [1.0, 2.0])]
    frame = spark.createDataFrame([(i, v, "n", 3) for i, v in rows], "vec_id long, embedding array<double>, node string, root int")
    found = near.near_vectors(frame, threshold).collect()
    assert sorted((tuple(r) for r in found), key=str) == plain(rows, threshold)


def test_vectors_that_take_no_part(make):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None), (2, []), (3, [0.0, 0.0]), (4, [None, 1.0]), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [1e300, 1e300]), (8, [1e-300, 1e-300]), (None, None)]
    frame = make(rows, "vec_id long, embedding array<double>")
    found = {r.vec_id: (r.n_links, r.component_id) for r in near.near_vectors(frame).collect()}
    assert found == {i: (0, i) for i in (1, 2, 3, 4, 5, 6, None)} | {7: (1, 7), 8: (1, 7)}
    assert near.near_vectors(frame.limit(0)).count() == 0


def test_single_precision_vectors(make):
    rng = np.random.default_rng(1)
    base = rng.normal(size=(30, 16)).astype(np.float32)
    rows = [(int(i), (base[i % 30] * (1 + i)).tolist()) for i in range(90)]
    frame = make(rows, "vec_id long, embedding array<float>")
    found = {r.vec_id: (r.n_links, r.component_id) for r in near.near_vectors(frame).collect()}
    assert found == {i: (2, i % 30) for i in range(90)}


def test_cells_are_exact_with_small_sub_tiles(monkeypatch):
    monkeypatch.setattr(near, "SUB_TILE", 16)
    rng = np.random.default_rng(4)
    x = np.array(groups(rng, 400, 12, 32))
    axes, cuts = np.linalg.qr(rng.normal(size=(32, 32)))[0], near._cuts(32)
    a, b = (near.Slab(np.arange(k, k + 200), np.arange(1, 201), x[k : k + 200], axes, cuts) for k in (0, 200))
    unit = near.unit_rows(x)
    linked = unit @ unit.T >= 0.9
    np.fill_diagonal(linked, False)
    weight = np.tile(np.arange(1, 201), 2)
    for other, part in ((None, slice(0, 200)), (b, slice(0, 400))):
        nodes, links, roots = near.compare(a, other, cuts, 0.9)
        own = linked[part, part].copy()
        if other is not None:
            own[:200, :200] = own[200:, 200:] = False
        assert dict(zip(nodes, links, strict=True)) == dict(enumerate((own * weight[part]).sum(1)))
        label = dict(zip(nodes, roots, strict=True))
        assert all(label[i] == label[j] for i, j in np.argwhere(own))
        # As many classes as breadth-first search finds.
        reach = np.linalg.matrix_power((own | np.eye(len(own), dtype=bool)).astype(float), 64) > 0
        assert len(set(label.values())) == len(np.unique(reach, axis=0))


def test_bounds_never_rule_out_a_link():
    rng = np.random.default_rng(6)
    unit = near.unit_rows(rng.normal(size=(80, 24)))
    for c, cut in enumerate(near._cuts(24)):
        tails = near._tails(unit, near._cuts(24))[c]
        assert (unit[:, :cut] @ unit[:, :cut].T + tails[:, None] * tails + near.EPS >= unit @ unit.T).all()
    points = near.coordinates(unit)
    boxes = [near._boxes(points[k : k + 20], np.array([0])) for k in (0, 20, 40, 60)]
    low, high = (np.concatenate(b) for b in zip(*boxes, strict=True))
    apart = near.boxes_apart(low, high, low, high)
    real = ((unit[:, None] - unit[None]) ** 2).sum(2).reshape(4, 20, 4, 20).min((1, 3))
    assert (apart <= real + near.EPS).all()


def test_leading_dimensions_settle_most_pairs(monkeypatch):
    """With energy in few dimensions, later ones are looked at for few pairs."""
    rng = np.random.default_rng(3)
    x = rng.normal(size=(400, 64)) * 0.8 ** np.arange(64)
    slab = near.Slab(np.arange(400), np.ones(400), x, np.eye(64), near._cuts(64))
    seen = []
    real = np.einsum
    monkeypatch.setattr(near.np, "einsum", lambda how, a, b: seen.append(len(a)) or real(how, a, b))
    near.linked_pairs(slab, slab, slice(0, 400), slice(0, 400), near._cuts(64), 0.9)
    assert sum(seen) < 400 * 400 * 0.2


def test_classes_of_stars_chains_and_rings(make):
    edges = [(i, i + 1) for i in range(300)] + [(1000, 1000 + i) for i in range(1, 400)] + [(2000 + i, 2000 + (i + 1) % 7) for i in range(7)] + [(9, 9)]
    found = {r.node: r.root for r in near.classes(make(edges, "a long, b long")).collect()}
    assert found == dict.fromkeys(range(301), 0) | dict.fromkeys(range(1000, 1400), 1000) | dict.fromkeys(range(2000, 2007), 2000)
    assert near.classes(make([], "a long, b long")).count() == 0
