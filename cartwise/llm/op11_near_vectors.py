"""Near-duplicate vectors by cosine: tiles in principal order, leading dimensions first.

Unit vectors are turned onto the principal axes of their second moments (a rotation, so inner products
stay). Energy gathers in the leading dimensions; what is left of a vector after k of them has the norm
s_k, and x.y <= x[:k].y[:k] + s_k(x) s_k(y). The same in terms of distance: with LEAD coordinates and
s_LEAD as one more, two unit vectors farther apart than sqrt(2 - 2 threshold) cannot link.

1. Equal vectors become one, with their number and smallest vec_id.
2. A k-d tree over those coordinates, laid out from SAMPLE rows, deals all rows into tiles, so that a
   tile is a run in principal order. Each tile's exact box is worked out from all its rows; two tiles
   whose boxes are too far apart never meet. A tile of more than TILE_BYTES is dealt into slabs.
3. A cell is a pair of slabs, compared in one task: sub-tiles rule each other out by their boxes, then
   inner products are accumulated by growing runs of dimensions, and after each run the pairs whose
   bound is below the threshold are left; few survivors go on alone. Survivors get their exact cosine,
   in double precision, from the given components.
4. A cell returns a number of links and a spanning tree's edge for each row, never its pairs: its output
   is linear in its rows, however dense a group is. Edges of all cells are contracted by star joins.

The work is cells x rows^2: without structure in the vectors all slabs meet, and a row is sent to as many
cells as there are slabs (rows / SLAB rows). Vectors that are null, zero, or hold null or non-finite
components link with nothing; vectors of different lengths neither. Every length in the table takes a
run of its own, in sequence. Rows that repeat a vec_id are vectors each. A null vec_id is never the
smallest; a component of none but such has a null id. An empty table gives no rows. Other columns are
not looked at.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwise.functions.joins import lookup_join
from cartwise.llm import common as C
from cartwise.session import discard, materialize

#: Leading coordinates by which tiles are cut and ruled out.
LEAD = 8
#: Rows that lay out the tiles, and the fewest of them in a tile. Results do not depend on either.
SAMPLE, SAMPLE_OF_A_TILE = 16_384, 32
#: A slab's vectors in double precision; a cell holds two slabs.
TILE_BYTES = 8 << 20
SUB_TILE = 512
#: Rows of one record on the way to a cell.
BLOCK = 2048
EPS = 1e-9


# --- in one task ------------------------------------------------------------


def unit_rows(x: np.ndarray) -> np.ndarray:
    """Rows of norm 1. Divided by the largest component first, so that squares stay finite."""
    x = x.astype(float)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def _tails(y: np.ndarray, cuts: list[int]) -> np.ndarray:
    """(cut, row): the norm of what is left after each number of leading dimensions."""
    squares = np.cumsum((y * y)[:, ::-1], axis=1)[:, ::-1]
    ends = [squares[:, c] if c < y.shape[1] else np.zeros(len(y)) for c in cuts]
    return np.sqrt(np.stack(ends))


def coordinates(y: np.ndarray, lead: int = LEAD) -> np.ndarray:
    """The leading dimensions and the norm of the rest."""
    lead = min(lead, y.shape[1])
    return np.concatenate([y[:, :lead], _tails(y, [lead]).T], axis=1)


@dataclass
class Tree:
    """A k-d tree of fixed depth: node i has the children 2i + 1 and 2i + 2."""

    axis: np.ndarray
    at: np.ndarray

    @staticmethod
    def over(points: np.ndarray, leaves: int) -> Tree:
        """Cuts at medians along the widest axis until there are ``leaves`` (a power of two)."""
        axis, at = np.zeros(leaves - 1, int), np.zeros(leaves - 1)
        own = [np.arange(len(points))]
        for i in range(leaves - 1):
            rows = points[own[i]]
            if len(rows):
                axis[i] = int(rows.var(0).argmax())
                at[i] = float(np.median(rows[:, axis[i]]))
            above = rows[:, axis[i]] > at[i]
            own += [own[i][~above], own[i][above]]
        return Tree(axis, at)

    def leaf(self, points: np.ndarray) -> np.ndarray:
        node = np.zeros(len(points), int)
        for _ in range((len(self.axis) + 1).bit_length() - 1):
            node = 2 * node + 1 + (points[np.arange(len(points)), self.axis[node]] > self.at[node])
        return node - len(self.axis)


def _boxes(points: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return np.minimum.reduceat(points, cuts, axis=0), np.maximum.reduceat(points, cuts, axis=0)


def boxes_apart(low: np.ndarray, high: np.ndarray, other_low: np.ndarray, other_high: np.ndarray) -> np.ndarray:
    """Squared distances of all pairs of boxes."""
    out = np.zeros((len(low), len(other_low)))
    for k in range(low.shape[1]):
        gap = np.maximum(low[:, k, None] - other_high[None, :, k], other_low[None, :, k] - high[:, k, None])
        out += np.maximum(gap, 0) ** 2
    return out


def _merge(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Joins the classes of linked rows; a label is the class's smallest row."""
    while True:
        x, y = label[a], label[b]
        apart = x != y
        if not apart.any():
            return
        a, b = a[apart], b[apart]
        np.minimum.at(label, np.maximum(x, y)[apart], np.minimum(x, y)[apart])
        while True:
            shorter = label[label]
            if (shorter == label).all():
                break
            label[:] = shorter


class Slab:
    """The rows of one side of a cell, in the order of a k-d tree, with boxes of sub-tiles."""

    def __init__(self, nodes: np.ndarray, copies: np.ndarray, x: np.ndarray, axes: np.ndarray, cuts: list[int]):
        unit = unit_rows(x)
        points = coordinates(unit @ axes)
        leaves = 1 << max(0, -(-len(x) // SUB_TILE) - 1).bit_length()
        order = np.argsort(Tree.over(points, leaves).leaf(points), kind="stable")
        self.nodes, self.copies, self.unit = nodes[order], copies[order].astype(float), unit[order]
        self.turned = np.ascontiguousarray(self.unit @ axes)
        self.tails = _tails(self.turned, cuts)
        self.starts = np.arange(0, len(x), SUB_TILE)
        self.low, self.high = _boxes(points[order], self.starts)


def linked_pairs(a: Slab, b: Slab, i: slice, j: slice, cuts: list[int], threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Rows (of the two slices) that link: leading dimensions first, until none can reach the threshold."""
    x, y = a.turned[i], b.turned[j]
    dot = x[:, : cuts[0]] @ y[:, : cuts[0]].T
    pairs = None
    for c, cut in enumerate(cuts):
        if c and pairs is None:
            dot += x[:, cuts[c - 1] : cut] @ y[:, cuts[c - 1] : cut].T
        elif c:
            p, q, part = pairs
            pairs = p, q, part + np.einsum("ij,ij->i", x[p, cuts[c - 1] : cut], y[q, cuts[c - 1] : cut])
        s, t = a.tails[c, i], b.tails[c, j]
        if pairs is None:
            alive = dot + s[:, None] * t >= threshold - EPS
            left = np.count_nonzero(alive)
            if not left:
                return np.zeros(0, int), np.zeros(0, int)
            if 8 * left < alive.size or c == len(cuts) - 1:
                p, q = np.nonzero(alive)
                pairs = p, q, dot[p, q]
        else:
            p, q, part = pairs
            keep = part + s[p] * t[q] >= threshold - EPS
            pairs = p[keep], q[keep], part[keep]
    p, q, _ = pairs
    u, v = a.unit[i], b.unit[j]
    exact = np.concatenate([np.einsum("ij,ij->i", u[p[k : k + 65536]], v[q[k : k + 65536]]) for k in range(0, len(p), 65536)] or [np.zeros(0)])
    keep = exact >= threshold
    return p[keep], q[keep]


def compare(a: Slab, b: Slab | None, cuts: list[int], threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(nodes, links, roots) of a cell: each row's linked vectors, and the smallest row of its class here.

    Without ``b`` the slab is compared with itself.
    """
    own = b is None
    b = a if own else b
    shift = 0 if own else len(a.nodes)
    nodes = a.nodes if own else np.concatenate([a.nodes, b.nodes])
    links, label = np.zeros(len(nodes)), np.arange(len(nodes))
    far = boxes_apart(a.low, a.high, b.low, b.high) > 2 - 2 * threshold + EPS
    for s, t in np.argwhere(~far):
        if own and t < s:
            continue
        i = slice(a.starts[s], min(a.starts[s] + SUB_TILE, len(a.nodes)))
        j = slice(b.starts[t], min(b.starts[t] + SUB_TILE, len(b.nodes)))
        p, q = linked_pairs(a, b, i, j, cuts, threshold)
        p, q = p + i.start, q + j.start
        if own and s == t:
            upper = p < q
            p, q = p[upper], q[upper]
        if not len(p):
            continue
        links[: len(a.nodes)] += np.bincount(p, b.copies[q], len(a.nodes))
        links[shift:] += np.bincount(q, a.copies[p], len(b.nodes))
        _merge(label, p, q + shift)
    return nodes, links.astype(np.int64), nodes[label]


# --- over the table ---------------------------------------------------------


def _cuts(length: int) -> list[int]:
    """Numbers of dimensions after which bounds are looked at: doubled from LEAD."""
    out = [min(LEAD, length)]
    while out[-1] < length:
        out.append(min(2 * out[-1], length))
    return out


def _matrix(column: pa.ListArray) -> np.ndarray:
    """Lists of equal length as rows."""
    offsets = column.offsets.to_numpy()
    flat = column.values.to_numpy(zero_copy_only=False)[offsets[0] : offsets[-1]]
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 1))


def principal_axes(vectors: DataFrame, length: int) -> np.ndarray:
    """Axes of the second moments of all unit vectors, widest first.

    length x length sums come to the driver, however many vectors there are.
    """
    upper = np.triu_indices(length)

    def run(batches):
        total = np.zeros((length, length))
        for batch in batches:
            unit = unit_rows(_matrix(batch.column("x")))
            total += unit.T @ unit
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(upper[0]))), pa.array(total[upper])], names=["at", "s"])

    sums = vectors.select("x").mapInArrow(run, "at long, s double").groupBy("at").agg(F.sum("s").alias("s")).collect()
    moments = np.zeros((length, length))
    for r in sums:
        moments[upper[0][r["at"]], upper[1][r["at"]]] = r["s"]
    moments = moments + np.triu(moments, 1).T
    return np.linalg.eigh(moments)[1][:, ::-1].copy()


def _in_tiles(vectors: DataFrame, axes: np.ndarray, tree: Tree) -> DataFrame:
    """(node, copies, x, tile, point): each vector's tile and coordinates."""
    sent = vectors.sparkSession.sparkContext.broadcast((axes, tree))

    def run(batches):
        turn, cut = sent.value
        for batch in batches:
            points = coordinates(unit_rows(_matrix(batch.column("x"))) @ turn)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("node", "copies", "x")), pa.array(cut.leaf(points)), pa.array(list(points), pa.list_(pa.float64()))],
                names=["node", "copies", "x", "tile", "point"],
            )

    kind = dict(vectors.dtypes)["x"]
    return vectors.mapInArrow(run, f"node long, copies long, x {kind}, tile long, point array<double>")


def _sampled_points(vectors: DataFrame, axes: np.ndarray) -> np.ndarray:
    """The coordinates of SAMPLE vectors, chosen by a hash."""
    sample = vectors.orderBy(F.xxhash64("node")).limit(SAMPLE)
    sent = vectors.sparkSession.sparkContext.broadcast(axes)

    def run(batches):
        for batch in batches:
            points = coordinates(unit_rows(_matrix(batch.column("x"))) @ sent.value)
            yield pa.RecordBatch.from_arrays([pa.array(list(points), pa.list_(pa.float64()))], names=["point"])

    return np.array([r.point for r in sample.select("x").mapInArrow(run, "point array<double>").collect()])


def _cell_parts(tiled: DataFrame, base: np.ndarray, slabs: np.ndarray, meets: np.ndarray) -> DataFrame:
    """Blocks of rows, each once for every cell of its slab."""
    sent = tiled.sparkSession.sparkContext.broadcast((base, slabs, meets))

    def run(batches):
        first, number, near = sent.value
        for batch in batches:
            slab = batch.column("slab").to_numpy()
            nodes, copies, x = batch.column("node").to_numpy(), batch.column("copies").to_numpy(), _matrix(batch.column("x"))
            for own in np.unique(slab):
                rows = np.flatnonzero(slab == own)
                tile = np.searchsorted(first, own, side="right") - 1
                others = np.concatenate([np.arange(first[t], first[t] + number[t]) for t in np.flatnonzero(near[tile])])
                for k in range(0, len(rows), BLOCK):
                    at = rows[k : k + BLOCK]
                    cells = [v[at].tobytes() for v in (nodes, copies, x)]
                    for k2 in range(0, len(others), 16):
                        some = others[k2 : k2 + 16]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.minimum(some, own)), pa.array(np.maximum(some, own)), pa.array(np.full(len(some), own))]
                            + [pa.array([c] * len(some), pa.binary()) for c in cells],
                            names=["low", "high", "slab", "nodes", "copies", "x"],
                        )

    return tiled.mapInArrow(run, "low long, high long, slab long, nodes binary, copies binary, x binary")


def _links(vectors: DataFrame, length: int, threshold: float) -> DataFrame:
    """(node, n_links, root): of every cell the rows that have a link there. Stored."""
    spark, n = vectors.sparkSession, vectors.count()
    axes = principal_axes(vectors, length)
    slab_rows = max(SUB_TILE, TILE_BYTES // (8 * length))
    wanted = min(-(-n // slab_rows), max(1, min(n, SAMPLE) // SAMPLE_OF_A_TILE))
    points = _sampled_points(vectors, axes) if wanted > 1 else np.zeros((1, min(LEAD, length) + 1))
    tree = Tree.over(points, 1 << (wanted - 1).bit_length())
    tiled = materialize(_in_tiles(vectors, axes, tree), "tiled")
    bounds = [f(F.get("point", F.lit(k))).alias(f"{name}{k}") for name, f in (("low", F.min), ("high", F.max)) for k in range(points.shape[1])]
    boxes = sorted(tuple(r) for r in tiled.groupBy("tile").agg(F.count("*").alias("n"), *bounds).collect())
    box = np.array([r[2:] for r in boxes]).reshape(len(boxes), 2, -1)
    low, high = box[:, 0], box[:, 1]
    slabs = np.array([-(-r[1] // slab_rows) for r in boxes])
    base = np.concatenate([[0], np.cumsum(slabs)[:-1]])
    meets = boxes_apart(low, high, low, high) <= 2 - 2 * threshold + EPS
    pairs = int((slabs[:, None] * slabs)[meets].sum() + slabs.sum()) // 2

    place = F.array_position(F.lit([r[0] for r in boxes]), F.col("tile")).cast("int") - 1
    at = lambda values: F.get(F.lit(values.tolist()), place)
    slab = (at(base) + F.pmod(F.xxhash64("node"), at(slabs))).alias("slab")
    dealt = tiled.select("node", "copies", "x", slab).repartition("slab").sortWithinPartitions("slab")
    cuts, kind = _cuts(length), "<f4" if dict(vectors.dtypes)["x"] == "array<float>" else "<f8"
    sent = spark.sparkContext.broadcast(axes)

    def cell(key, table):
        lower, higher = (k.as_py() for k in key)
        sides = []
        for own in dict.fromkeys((lower, higher)):
            rows = table.filter(pa.compute.equal(table.column("slab"), own))
            if not rows.num_rows:
                return pa.table({"node": pa.array([], pa.int64()), "n_links": pa.array([], pa.int64()), "root": pa.array([], pa.int64())})
            data = [b"".join(c.as_buffer().to_pybytes() for c in rows.column(name)) for name in ("nodes", "copies", "x")]
            sides.append(Slab(*(np.frombuffer(d, "<i8") for d in data[:2]), np.frombuffer(data[2], kind).reshape(-1, length), sent.value, cuts))
        nodes, links, roots = compare(sides[0], sides[1] if len(sides) > 1 else None, cuts, threshold)
        some = links > 0
        return pa.table({"node": nodes[some], "n_links": links[some], "root": roots[some]})

    # A stated number of partitions: a cell's work is far more than its bytes tell.
    cells = _cell_parts(dealt, base, slabs, meets).repartition(max(1, min(2 * pairs, 20_000)), "low", "high")
    found = materialize(cells.groupBy("low", "high").applyInArrow(cell, "node long, n_links long, root long"), "links")
    discard(tiled)
    return found


def classes(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node that each end of ``edges`` (a, b) reaches, itself included.

    Large and small stars in turn: a node's neighbours are tied to the smallest of them, first the
    larger ones, then the smaller ones. Minima are combined before the shuffle; edges of a node with
    very many neighbours are dealt out by the lookup. The number of rounds grows with the logarithm.
    """

    def mark(frame: DataFrame):
        return tuple(frame.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    edges = materialize(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a > b").distinct(), "edges")
    seen = mark(edges)
    while True:
        both = materialize(edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))), "both")
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
        large = lookup_join(both.where("b > a"), least, ["a"], ["b"]).select(F.col("b").alias("a"), F.col("least").alias("b"))
        large = materialize(large.where("a > b").distinct(), "large")
        least = large.groupBy("a").agg(F.min("b").alias("least"))
        met = lookup_join(large, least, ["a"], ["b"])
        small = met.select(F.col("b").alias("a"), F.col("least").alias("b")).unionByName(least.select("a", F.col("least").alias("b")))
        last, edges = edges, materialize(small.where("a > b").distinct(), "edges")
        for gone in (last, both, large):
            discard(gone)
        now = mark(edges)
        if now == seen:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
        seen = now


def near_vectors(rows: DataFrame, threshold: float = 0.9) -> DataFrame:
    """(vec_id, n_links, component_id) of every row of ``rows`` (vec_id, embedding).

    ``n_links`` counts the other rows with a cosine of ``threshold`` (above 0) or more.
    """
    if not 0 < threshold <= 1:
        raise ValueError("threshold must be above 0, at most 1")
    spark = rows.sparkSession
    C.ship(spark)
    x = F.col("embedding")
    fit = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))) & F.exists(x, lambda c: c != 0)
    hashes = [F.when(F.coalesce(fit, F.lit(False)), h) for h in (F.xxhash64(x), F.xxhash64(F.lit(1), x))]
    keyed = rows.select(F.col("vec_id").cast("long").alias("vec_id"), *[h.alias(n) for h, n in zip(hashes, ("h1", "h2"), strict=True)], x.alias("x"))
    distinct = keyed.where("h1 is not null").groupBy("h1", "h2").agg(F.first("x").alias("x"), F.count("*").alias("copies"), F.min("vec_id").alias("least_id"))
    nodes = materialize(distinct.withColumn("node", F.monotonically_increasing_id()), "vectors")
    lengths = [r["n"] for r in nodes.select(F.size("x").alias("n")).distinct().orderBy("n").collect()]
    found = [_links(nodes.where(F.size("x") == n).select("node", "copies", "x"), n, threshold) for n in lengths]
    if not found:
        return rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.lit(0).cast("long").alias("n_links"), F.col("vec_id").cast("long").alias("component_id"))
    links = found[0]
    for more in found[1:]:
        links = links.unionByName(more)
    degree = links.groupBy("node").agg(F.sum("n_links").alias("n"))
    roots = classes(links.select(F.col("node").alias("a"), F.col("root").alias("b")))
    known = nodes.select("node", "h1", "h2", "copies", "least_id").join(degree, "node", "left").join(roots, "node", "left")
    known = materialize(known.withColumn("root", F.coalesce("root", "node")), "known")
    smallest = known.groupBy("root").agg(F.min("least_id").alias("component_id"))
    told = lookup_join(known, smallest, ["root"], ["node"])
    told = told.select("h1", "h2", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n"), "component_id", "copies")
    told = materialize(told, "classes")
    total = told.agg(F.sum("copies")).scalar()
    hot = told.where(F.col("copies") * 1000 > total).select("h1", "h2")
    out = lookup_join(keyed.drop("x"), told.drop("copies"), ["h1", "h2"], ["vec_id"], hot=hot)
    return out.select(
        "vec_id",
        F.coalesce("n", F.lit(0)).alias("n_links"),
        F.when(F.col("h1").isNull(), F.col("vec_id")).otherwise(F.col("component_id")).alias("component_id"),
    )


def op11_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector's links and class."""
    found = near_vectors(C.table(spark, sf_dir, "embeddings"))
    kept = F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False))
    return found.withColumn("kept", kept)


SQL = """
WITH RECURSIVE e AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, embedding::DOUBLE[] AS x FROM embeddings),
v AS MATERIALIZED (SELECT r, vec_id, x, sqrt(list_inner_product(x, x)) AS norm FROM e
  WHERE x IS NOT NULL AND len(list_filter(x, lambda c: c IS NULL OR NOT isfinite(c))) = 0 AND len(list_filter(x, lambda c: c <> 0)) > 0),
links AS MATERIALIZED (SELECT a.r AS a, b.r AS b FROM v a JOIN v b
  ON a.r <> b.r AND len(a.x) = len(b.x) AND list_inner_product(a.x, b.x) / (a.norm * b.norm) >= 0.9),
reach AS (SELECT r AS a, r AS b FROM e UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
least AS (SELECT a, min(vec_id) AS component_id FROM reach JOIN e ON e.r = reach.b GROUP BY a),
degree AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, coalesce(vec_id = component_id, false) AS kept
FROM e JOIN least ON least.a = r LEFT JOIN degree ON degree.a = r
"""
