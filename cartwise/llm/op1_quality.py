"""Quality classifier: logistic regression over hashed word n-grams, fitted by
follow-the-regularised-leader updates and scored as sparse dot products.

A text becomes tokens (runs of letters, of digits, of other signs). Features are
hashed word unigrams and bigrams, n-grams of word shapes (case, digits, the signs
themselves), and the share of word trigrams seen before in the same text. Each kind
of n-gram counts by its share of the text's n-grams, so a long text weighs as a
short one.

Nulls and empty texts have the bias alone as their score. Labels of null documents,
null labels and null texts teach nothing. Repeated label rows count as often as they
occur. With no labels of one of the classes the score is the share of label 1 (1/2 if
there are none). Columns besides doc_id, text and quality are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwise.llm import common as C

DIM_BITS = 18
#: Labelled rows that a fit uses at most: those of the smallest hashes of their ids.
MAX_FIT_ROWS = 8192
SHARDS = 4
EPOCHS = 4
ALPHA, BETA, L1, L2 = 0.5, 0.02, 1e-5, 1e-4
THRESHOLD = 0.3

KIND = np.full(256, 3, np.uint8)
KIND[:33] = 0
KIND[127] = 0
KIND[48:58] = 2
KIND[65:91] = KIND[97:123] = KIND[128:] = 1


def _features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, bucket, value) of every feature; a bucket may repeat within a row."""
    n = len(offsets) - 1
    low = C.lowered(data)
    start, end, row = C.run_bounds(KIND[data], offsets)
    words = C.run_hashes(low, start, end)
    upper = np.concatenate([[0], np.cumsum(low != data)])
    capitals, size = upper[end] - upper[start], end - start
    shape = np.where(capitals == 0, 1, np.where((capitals == size) & (size > 1), 3, np.where(capitals == 1, 2, 4)))
    kind = KIND[data[start]] if len(start) else np.zeros(0, np.uint8)
    shapes = np.where(kind == 3, words, np.where(kind == 2, 5, shape).astype(np.uint64))
    mask = np.uint64((1 << DIM_BITS) - 1)
    rows, buckets, values = [np.arange(n)], [np.zeros(n, np.int64)], [np.ones(n)]
    for salt, (base, grams) in enumerate(((words, 1), (words, 2), (shapes, 1), (shapes, 2), (shapes, 3)), 1):
        hashes = C.gram_hashes(base, grams)
        inside = row[: len(hashes)] == row[grams - 1 :] if len(hashes) else np.zeros(0, bool)
        at = row[: len(hashes)][inside]
        rows.append(at)
        buckets.append((C.mix(hashes[inside] + np.uint64(salt)) & mask).astype(np.int64))
        values.append(1.0 / np.maximum(np.bincount(at, minlength=n), 1)[at])
    trigrams = C.gram_hashes(words, 3)
    inside = row[: len(trigrams)] == row[2:] if len(trigrams) else np.zeros(0, bool)
    at = row[: len(trigrams)][inside]
    order = np.lexsort((trigrams[inside], at))
    keys, owner = trigrams[inside][order], at[order]
    again = (keys[1:] == keys[:-1]) & (owner[1:] == owner[:-1])
    share = np.bincount(owner[1:][again], minlength=n) / np.maximum(np.bincount(at, minlength=n), 1)
    rows.append(np.arange(n))
    buckets.append((C.mix(np.floor(share * 10).astype(np.uint64) + np.uint64(1 << 32)) & mask).astype(np.int64))
    values.append(np.ones(n))
    return np.concatenate(rows), np.concatenate(buckets), np.concatenate(values)


def _ftrl(examples: list[tuple[np.ndarray, np.ndarray, int]], epochs: int) -> np.ndarray:
    """Weights by per-coordinate follow-the-regularised-leader (proximal) updates."""
    z, squares = np.zeros(1 << DIM_BITS), np.zeros(1 << DIM_BITS)

    def weights(i):
        near = np.abs(z[i]) <= L1
        return np.where(near, 0.0, -(z[i] - np.sign(z[i]) * L1) / ((BETA + np.sqrt(squares[i])) / ALPHA + L2))

    for _ in range(epochs):
        for at, value, label in examples:
            w = weights(at)
            p = 1.0 / (1.0 + np.exp(-np.clip(w @ value, -35, 35)))
            gradient = (p - label) * value
            grown = squares[at] + gradient**2
            z[at] += gradient - (np.sqrt(grown) - np.sqrt(squares[at])) / ALPHA * w
            squares[at] = grown
    return weights(np.arange(1 << DIM_BITS))


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_FIT_ROWS, epochs: int = EPOCHS) -> np.ndarray:
    """Weights learnt from the texts of the labelled rows; ``labels`` is (doc_id, quality).

    ``max_rows`` bounds the rows that are learnt from. They are dealt to SHARDS tasks;
    each fits on its share in turn, and the weights are averaged.
    """
    chosen = (
        labels.select("doc_id", F.col("quality").cast("int").alias("quality"))
        .where("doc_id is not null and quality in (0, 1)")
        .orderBy(F.xxhash64("doc_id"), "doc_id", "quality")
        .limit(max_rows)
    )
    rows = docs.select("doc_id", "text").where("text is not null").join(F.broadcast(chosen), "doc_id")

    def sparse(batches):
        for batch in batches:
            label = batch.column("quality").to_numpy(zero_copy_only=False)
            ids = batch.column("doc_id")
            for first, end, data, offsets in C.chunks(batch.column("text")):
                row, bucket, value = _features(data, offsets)
                order = np.argsort(row, kind="stable")
                cut = np.searchsorted(row[order], np.arange(end - first + 1))
                out = []
                for i in range(end - first):
                    own = order[cut[i] : cut[i + 1]]
                    at, inverse = np.unique(bucket[own], return_inverse=True)
                    summed = np.bincount(inverse, weights=value[own])
                    out.append((at.astype(np.int32).tobytes(), summed.astype(np.float32).tobytes()))
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.slice(first, end - first),
                        pa.array(label[first:end], pa.int32()),
                        pa.array([a for a, _ in out], pa.binary()),
                        pa.array([v for _, v in out], pa.binary()),
                    ],
                    names=["doc_id", "quality", "at", "value"],
                )

    examples = rows.select("doc_id", "text", "quality").mapInArrow(
        sparse, "doc_id long, quality int, at binary, value binary"
    )

    def shard(key, found):
        found = found.sort_by([("key", "ascending"), ("doc_id", "ascending"), ("quality", "ascending")])
        learnt = [
            (np.frombuffer(a, np.int32), np.frombuffer(v, np.float32).astype(float), q)
            for a, v, q in zip(*(found.column(c).to_pylist() for c in ("at", "value", "quality")), strict=True)
        ]
        w = _ftrl(learnt, epochs).astype(np.float32)
        return pa.table({"rows": [len(learnt)], "ones": [sum(q for _, _, q in learnt)], "w": [w.tobytes()]})

    key = F.xxhash64(F.lit(17), "doc_id")
    parts = (
        examples.withColumns({"key": key, "shard": F.pmod(key, F.lit(SHARDS))})
        .groupBy("shard")
        .applyInArrow(shard, "rows long, ones long, w binary")
        .collect()
    )
    total, ones = sum(p.rows for p in parts), sum(p.ones for p in parts)
    if not 0 < ones < total:
        weights = np.zeros(1 << DIM_BITS, np.float32)
        share = min(max(ones / total if total else 0.5, 1e-6), 1 - 1e-6)
        weights[0] = np.log(share / (1 - share))
        return weights
    return sum(np.frombuffer(p.w, np.float32) * (p.rows / total) for p in parts).astype(np.float32)


def _scores(texts: pa.Array, weights: np.ndarray) -> pa.Array:
    out = np.zeros(len(texts))
    for first, end, data, offsets in C.chunks(texts):
        row, bucket, value = _features(data, offsets)
        out[first:end] = np.bincount(row, weights=weights[bucket] * value, minlength=end - first)
    return pa.array(1.0 / (1.0 + np.exp(-np.clip(out, -35, 35))))


def score(docs: DataFrame, weights: np.ndarray, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` and ``quality_score`` (0 to 1) of every row, whole texts."""
    kept = docs.select(*keep, F.col("text").alias("_text"))
    schema = C.with_fields(kept.drop("_text").schema, quality_score="double")

    def run(batches):
        for batch in batches:
            scores = _scores(batch.column("_text"), weights)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], scores], names=[*batch.schema.names[:-1], "quality_score"])

    return kept.mapInArrow(run, schema)


def score_of(text: Column, weights: np.ndarray) -> Column:
    """The score of a text as a column: texts alone go to Python, the row's rest stays."""

    @F.arrow_udf("double")
    def scored(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in texts:
            yield _scores(batch, weights)
            C.release()

    return scored(text)


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's score; rows whose fold is 0 teach nothing."""
    docs = C.table(spark, sf_dir, "documents")
    labels = C.table(spark, sf_dir, "labels").where(C.fold_of(F.col("doc_id"), 5) != 0)
    scored = score(docs, fit(docs, labels))
    return scored.select(
        "doc_id",
        (C.fold_of(F.col("doc_id"), 5) == 0).alias("held_out"),
        F.col("quality_score").alias("score"),
        (F.col("quality_score") >= THRESHOLD).cast("int").alias("predicted"),
    )
