"""Exact top-k inner-product search with multi-resolution segment statistics.

Each vector is cut into segments, coarse (4) and fine (16). From the segments' means m and
deviations s follows a bound of the inner product, q.x <= sum of L (m_q m_x + s_q s_x), which is
the lower bound of the distance |q|^2 + |x|^2 - 2 q.x in other words. Candidates that the coarse
bound cannot rule out get the fine one; the survivors get their exact inner product. A task keeps
the k best of each query and raises each query's threshold as it goes.

Queries are dealt into blocks of bounded size; each block is sent to all tasks and meets all
candidates in one pass. Nothing grows with the table but the number of blocks.

Vectors that are null or hold null or non-finite components take no part. Vectors of another
length than the query's are no candidates of it. Rows that bear a query's own vec_id are left
out; other repeated rows are candidates each. A query that is repeated with the same vector is
answered once. Scores are exact while length * max^2 is within 63 bits. Null vec_ids take no part.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cartwise.llm import common as C
from cartwise.session import materialize

#: Queries of one block; 64 dimensions of 8 bytes are 1 MB.
BLOCK = 2048
STEP = 1024
SEGMENTS = (4, 16)


def whole_vectors(rows: DataFrame, scale: int = 256) -> DataFrame:
    """(vec_id, v): floor(scale * x) of each component of the vectors that take part."""
    x = F.col("embedding").cast("array<double>")
    fit = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    v = F.transform(x, lambda c: F.floor(c * F.lit(float(scale))))
    return rows.where(F.col("vec_id").isNotNull() & x.isNotNull() & (F.size(x) > 0) & fit).select(
        F.col("vec_id").cast("long").alias("vec_id"), v.alias("v")
    )


def _statistics(v: np.ndarray, segments: int) -> np.ndarray:
    """Means and deviations of segments, each times the root of its length: a product is the bound."""
    cuts = np.unique(np.linspace(0, v.shape[1], min(segments, v.shape[1]) + 1).astype(int))
    size = np.diff(cuts)
    sums = np.add.reduceat(v, cuts[:-1], axis=1)
    squares = np.add.reduceat(v * v, cuts[:-1], axis=1)
    mean = sums / size
    return np.concatenate([mean, np.sqrt(np.maximum(squares / size - mean**2, 0))], axis=1) * np.sqrt(np.tile(size, 2))


def _dot(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row inner products, exact."""
    return np.einsum("ij,ij->i", a, b)


class _Best:
    """The k best candidates of each query of one length, in one task."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, k: int):
        self.ids, self.q, self.k = ids, vectors, k
        self.f = vectors.astype(float)
        self.levels = [_statistics(self.f, s) for s in SEGMENTS]
        self.score = np.full((len(ids), k), np.iinfo(np.int64).min)
        self.who = np.full((len(ids), k), np.iinfo(np.int64).max)

    def add(self, ids: np.ndarray, x: np.ndarray) -> None:
        f = x.astype(float)
        worst = self.score[:, -1].astype(float)
        slack = 1e-9 * (np.linalg.norm(self.f, axis=1)[:, None] * np.linalg.norm(f, axis=1)) + 1e-6
        coarse = self.levels[0] @ _statistics(f, SEGMENTS[0]).T + slack
        i, j = np.nonzero(coarse >= worst[:, None])
        if len(i):
            fine_x = _statistics(f, SEGMENTS[1])
            if len(i) * 4 > coarse.size:
                keep = ((self.levels[1] @ fine_x.T + slack) >= worst[:, None])[i, j]
            else:
                keep = np.einsum("ij,ij->i", self.levels[1][i], fine_x[j]) + slack[i, j] >= worst[i]
            i, j = i[keep], j[keep]
        keep = self.ids[i] != ids[j]
        i, j = i[keep], j[keep]
        if not len(i):
            return
        small = float(np.abs(self.f).max(initial=0)) * float(np.abs(f).max(initial=0)) * x.shape[1] < 2.0**52
        if small and len(i) * 4 > coarse.size:
            found = (self.f @ f.T)[i, j].astype(np.int64)
        else:
            found = np.concatenate([_dot(self.q[i[a : a + 65536]], x[j[a : a + 65536]]) for a in range(0, len(i), 65536)])
        keep = found >= self.score[i, -1]
        i, found, who = i[keep], found[keep], ids[j[keep]]
        touched = np.unique(i)
        i = np.concatenate([i, np.repeat(touched, self.k)])
        found = np.concatenate([found, self.score[touched].ravel()])
        who = np.concatenate([who, self.who[touched].ravel()])
        order = np.lexsort((who, -found.astype(float), i)) if small else np.lexsort((who, -found, i))
        i, found, who = i[order], found[order], who[order]
        place = np.arange(len(i)) - np.searchsorted(i, i)
        top = place < self.k
        self.score[i[top], place[top]] = found[top]
        self.who[i[top], place[top]] = who[top]


def _search_block(rows: DataFrame, queries: list, k: int) -> DataFrame:
    by_length: dict[int, list] = {}
    for place, vec_id, v in queries:
        by_length.setdefault(len(v), []).append((place, vec_id, v))
    packed = {
        n: (np.array([p for p, _, _ in q]), np.array([i for _, i, _ in q], np.int64), np.array([v for _, _, v in q], np.int64))
        for n, q in by_length.items()
    }
    sent = rows.sparkSession.sparkContext.broadcast(packed)

    def run(batches):
        best = {n: _Best(ids, v, k) for n, (_, ids, v) in sent.value.items()}
        for batch in batches:
            ids = batch.column("vec_id").to_numpy()
            lists = batch.column("v")
            offsets, flat = lists.offsets.to_numpy(), lists.values.to_numpy()
            length = np.diff(offsets)
            for n, own in best.items():
                at = np.flatnonzero(length == n)
                for a in range(0, len(at), STEP):
                    part = at[a : a + STEP]
                    own.add(ids[part], flat[offsets[part][:, None] + np.arange(n)])
        for n, own in best.items():
            place = sent.value[n][0]
            i, r = np.nonzero(own.who != np.iinfo(np.int64).max)
            yield pa.RecordBatch.from_arrays(
                [pa.array(place[i]), pa.array(own.ids[i]), pa.array(own.who[i, r]), pa.array(own.score[i, r])],
                names=["place", "query_id", "vec_id", "score"],
            )

    found = rows.mapInArrow(run, "place long, query_id long, vec_id long, score long")
    order = W.partitionBy("place").orderBy(F.col("score").desc(), F.col("vec_id"))
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def top_k(rows: DataFrame, queries: DataFrame, k: int = 5, block: int = BLOCK) -> DataFrame:
    """The k highest inner products of every row of ``queries`` with the rows of ``rows``.

    Both are (vec_id, v) as of ``whole_vectors``. Ties go to the smaller vec_id.
    """
    queries = materialize(queries.select("vec_id", "v").distinct(), "queries")
    blocks = max(1, -(-queries.count() // block))
    key = F.pmod(F.xxhash64("vec_id", "v"), F.lit(blocks))
    parts = []
    for b in range(blocks):
        chosen = [(n, r.vec_id, r.v) for n, r in enumerate(queries.where(key == b).orderBy("vec_id", "v").toLocalIterator())]
        part = _search_block(rows, chosen, k)
        parts.append(part if blocks == 1 else materialize(part, "found"))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def op5_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest rows of each row whose id is divisible by 50."""
    rows = whole_vectors(C.table(spark, sf_dir, "embeddings"))
    return top_k(rows, rows.where("vec_id % 50 = 0"), 5)


SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS (SELECT q.vec_id AS query_id, c.vec_id,
  list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM pairs)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""
