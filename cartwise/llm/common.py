"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

import atexit
import ctypes
import shutil
import tempfile
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BASE = np.uint64(0x9E3779B97F4A7C15)
BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
CHUNK_BYTES = 256 << 10

SPACE = np.zeros(256, bool)
SPACE[[32, *range(9, 14)]] = True


def ship(spark: SparkSession) -> None:
    """Gives the executors this package, once a session: they need not have it installed."""
    context = spark.sparkContext
    if getattr(context, "_cartwise_shipped", False):
        return
    package = Path(__file__).resolve().parents[1]
    # The driver serves this file to executors as long as it runs.
    folder = tempfile.mkdtemp(prefix="cartwise-package-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    archive = f"{folder}/cartwise_package.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for path in sorted(package.rglob("*.py")):
            out.write(path, path.relative_to(package.parent))
    context.addPyFile(archive)
    context._cartwise_shipped = True


@contextmanager
def batches_of(spark: SparkSession, rows: int) -> Iterator[None]:
    """Within it, Python tasks get at most ``rows`` rows at once; the session's own setting comes back."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(min(rows, int(before)) if int(before) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def with_fields(schema: T.StructType, **fields: str) -> T.StructType:
    """The schema and further fields, all of which may be null."""
    added = [T.StructField(name, T.DataType.fromDDL(kind)) for name, kind in fields.items()]
    return T.StructType([*(T.StructField(f.name, f.dataType) for f in schema), *added])


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case; all other characters stay."""
    return F.translate(text, UPPER, LOWER)


def fold_of(identifier: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; -1 for a null id."""
    return F.coalesce(F.crc32(identifier.cast("string")) % folds, F.lit(-1))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit (splitmix64's finaliser)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def chunks(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of rows of about CHUNK_BYTES: first row, end row, their bytes, n + 1 offsets.

    A null is an empty text. A longer text is a chunk of its own, whole. The bytes are a
    view of the batch's, which is not copied unless it has nulls.
    """
    texts = texts.cast(pa.large_string())
    if texts.null_count:
        texts = texts.fill_null("")
    if not len(texts):
        return
    _, places, values = texts.buffers()
    places = np.frombuffer(places, np.int64, len(texts) + 1, 8 * texts.offset)
    data = np.frombuffer(values, np.uint8) if values is not None else np.zeros(0, np.uint8)
    start = 0
    while start < len(texts):
        end = max(start + 1, int(np.searchsorted(places, places[start] + CHUNK_BYTES, side="right")) - 1)
        yield start, end, data[places[start] : places[end]], places[start : end + 1] - places[start]
        start = end


def release() -> None:
    """Gives the memory that this worker has freed back to the system: workers wait beside the executor's heap."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def lowered(data: np.ndarray) -> np.ndarray:
    return np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)


def run_bounds(kind: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and rows of the runs of equal ``kind`` other than 0; none spans two rows."""
    if not len(kind):
        none = np.zeros(0, np.int64)
        return none, none, none
    edge = np.ones(len(kind) + 1, bool)
    edge[1:-1] = kind[1:] != kind[:-1]
    edge[offsets] = True
    at = np.flatnonzero(edge)
    start, end = at[:-1], at[1:]
    keep = kind[start] != 0
    start, end = start[keep], end[keep]
    return start, end, np.searchsorted(offsets, start, side="right") - 1


def run_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each run's bytes, all runs at once by prefix sums of a polynomial."""
    power = np.full(len(data) + 1, BASE, np.uint64)
    power[0] = 1
    np.cumprod(power, out=power)
    prefix = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[:-1], out=prefix[1:])
    back = np.full(len(data) + 1, BASE_INVERSE, np.uint64)
    back[0] = 1
    np.cumprod(back, out=back)
    return mix((prefix[end] - prefix[start]) * back[start] + (end - start).astype(np.uint64))


def gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of ``n`` consecutive words; entry i begins at word i."""
    out = np.zeros(max(0, len(words) - n + 1), np.uint64)
    for i in range(n):
        out = mix(out * BASE + words[i : i + len(out)])
    return out


def word_shingles(data: np.ndarray, offsets: np.ndarray, n: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(rows, hashes) of the distinct n-word shingles of each row, sorted by row, then hash.

    Words are the runs of other than white space, A-Z lower-cased. A row of fewer
    words, but not none, has the sequence of all its words as its one shingle.
    """
    low = lowered(data)
    start, end, row = run_bounds((~SPACE[low]).astype(np.uint8), offsets)
    words = run_hashes(low, start, end)
    grams = gram_hashes(words, n)
    inside = row[: len(grams)] == row[n - 1 :] if len(grams) else np.zeros(0, bool)
    rows, hashes = [row[: len(grams)][inside]], [grams[inside]]
    count = np.bincount(row, minlength=len(offsets) - 1)
    first = np.concatenate([[0], np.cumsum(count)])
    for size in range(1, n):
        short = np.flatnonzero(count == size)
        if len(short):
            whole = np.full(len(short), size, np.uint64)
            for i in range(size):
                whole = mix(whole * BASE + words[first[short] + i])
            rows.append(short)
            hashes.append(whole)
    rows, hashes = np.concatenate(rows), np.concatenate(hashes)
    order = np.lexsort((hashes, rows))
    rows, hashes = rows[order], hashes[order]
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:] != rows[:-1]) | (hashes[1:] != hashes[:-1])
    return rows[new], hashes[new]
