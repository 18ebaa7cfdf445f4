"""Language ID by hyperdimensional profiles.

Every letter has a random vector of signs. An n-gram's vector binds (multiplies) its
letters' vectors, each permuted (rolled) by its place; a text bundles (adds) those of its
n-grams, a language those of its texts. A text gets the language whose prototype is nearest
by cosine; ties go to the first language in alphabetical order.

Letters are what Unicode calls letters, lower-cased; everything else between letters is one
space. Null texts and texts without letters are ``und`` with score 0, as is every text when
nothing was learnt. Rows of null text or language teach nothing; repeated rows teach as often
as they occur. Only the columns named are looked at.
"""

from __future__ import annotations

import functools

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwise.llm import common as C

DIMENSIONS = 1024
GRAM = 3
SEED = 6
BITS = 21


@functools.cache
def _is_letter() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


@functools.cache
def _letter(code: int) -> np.ndarray:
    return (np.random.default_rng([SEED, code]).integers(0, 2, DIMENSIONS) * 2 - 1).astype(np.int8)


class _Vectors:
    """The vectors of the n-grams a worker has met, made once; begun anew when they fill LIMIT rows."""

    LIMIT = 1 << 14

    def __init__(self):
        self.rows = np.zeros((1024, DIMENSIONS), np.float32)
        self.codes, self.where = np.zeros(0, np.int64), np.zeros(0, np.int64)  # sorted codes, their rows

    def places(self, codes: np.ndarray) -> np.ndarray:
        """The rows of the vectors of the distinct, sorted ``codes``; LIMIT of them at most."""
        at = np.searchsorted(self.codes, codes)
        new = codes[self.codes[np.minimum(at, len(self.codes) - 1)] != codes] if len(self.codes) else codes
        if not len(new):
            return self.where[at]
        used = len(self.codes)
        if used + len(new) > self.LIMIT:
            self.codes, self.where, used, new = np.zeros(0, np.int64), np.zeros(0, np.int64), 0, codes
        if used + len(new) > len(self.rows):
            grown = np.zeros((min(self.LIMIT, 2 * (used + len(new))), DIMENSIONS), np.float32)
            grown[:used] = self.rows[:used]
            self.rows = grown
        made = self.rows[used : used + len(new)]
        made[:] = 1
        for place in range(GRAM):
            letters, which = np.unique((new >> (BITS * place)) & ((1 << BITS) - 1), return_inverse=True)
            made *= np.stack([np.roll(_letter(c), place) for c in letters.tolist()])[which]
        self.codes = np.concatenate([self.codes, new])
        self.where = np.concatenate([self.where, np.arange(used, used + len(new))])
        order = np.argsort(self.codes, kind="stable")
        self.codes, self.where = self.codes[order], self.where[order]
        return self.where[np.searchsorted(self.codes, codes)]

    def bundle(self, codes: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """The sum of the vectors of distinct ``codes``, each ``counts`` times."""
        out = np.zeros(DIMENSIONS)
        for i in range(0, len(codes), 8192):
            at = self.places(codes[i : i + 8192])
            out += counts[i : i + 8192].astype(np.float32) @ self.rows[at]
        return out


def _grams(text: str | None) -> np.ndarray:
    """The codes of a text's letter n-grams; none if it has no letter."""
    if not text:
        return np.zeros(0, np.int64)
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    letter = _is_letter()[codes]
    if not letter.any():
        return np.zeros(0, np.int64)
    codes = np.where(letter, codes, 32)
    codes = np.concatenate([[32], codes, [32]])
    codes = codes[np.concatenate([[True], (codes[1:] != 32) | (codes[:-1] != 32)])]
    return sum(codes[i : len(codes) - GRAM + 1 + i] << (BITS * (GRAM - 1 - i)) for i in range(GRAM))


def _counted(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return np.unique(codes, return_counts=True)


def fit(docs: DataFrame) -> dict[str, np.ndarray]:
    """A prototype for each language of ``docs`` (text, lang), from all its rows.

    Sums are of whole numbers and made on the executors, one row for each language
    and dimension of a task.
    """
    rows = docs.select("text", "lang").where("text is not null and lang is not null")

    def run(batches):
        vectors, total = _Vectors(), {}
        for batch in batches:
            texts = batch.column("text")
            own: dict[str, list[int]] = {}
            for i, lang in enumerate(batch.column("lang").to_pylist()):
                own.setdefault(lang, []).append(i)
            for lang, at in own.items():
                sums = total.setdefault(lang, np.zeros(DIMENSIONS))
                for a in range(0, len(at), 256):
                    codes = np.concatenate([_grams(texts[i].as_py()) for i in at[a : a + 256]])
                    sums += np.rint(vectors.bundle(*_counted(codes)))
        del vectors
        C.release()
        for lang, sums in total.items():
            if not sums.any():
                continue
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * DIMENSIONS), pa.array(range(DIMENSIONS), pa.int32()), pa.array(sums)],
                names=["lang", "place", "total"],
            )

    sums = rows.mapInArrow(run, "lang string, place int, total double").groupBy("lang", "place")
    found = sums.agg(F.sum("total").alias("total")).orderBy("lang", "place").collect()
    prototypes: dict[str, np.ndarray] = {}
    for row in found:
        prototypes.setdefault(row.lang, np.zeros(DIMENSIONS))[row.place] = row.total
    return prototypes


class _Judge:
    """Languages and cosines of texts, with the n-grams' vectors that a task has made."""

    def __init__(self, prototypes: dict[str, np.ndarray]):
        self.names = sorted(prototypes)
        self.unit = np.stack([prototypes[n] / max(np.linalg.norm(prototypes[n]), 1e-9) for n in self.names]) if self.names else None
        self.vectors = _Vectors()

    def one(self, text: str | None) -> tuple[str, float]:
        codes, counts = _counted(_grams(text))
        if self.unit is None or not len(codes):
            return "und", 0.0
        vector = self.vectors.bundle(codes, counts)
        cosines = self.unit @ vector / max(np.linalg.norm(vector), 1e-9)
        best = int(np.argmax(cosines))
        return self.names[best], float(min(max(cosines[best], 0.0), 1.0))


def predict(docs: DataFrame, prototypes: dict[str, np.ndarray], keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep``, ``lang_pred`` and ``lang_score`` (cosine, 0 to 1) of every row."""
    kept = docs.select(*keep, F.col("text").alias("_text"))
    schema = C.with_fields(kept.drop("_text").schema, lang_pred="string", lang_score="double")

    def run(batches):
        judge = _Judge(prototypes)
        for batch in batches:
            found = [judge.one(x.as_py()) for x in batch.column("_text")]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())],
                names=[*batch.schema.names[:-1], "lang_pred", "lang_score"],
            )

    return kept.mapInArrow(run, schema)


def language_of(text: Column, prototypes: dict[str, np.ndarray]) -> Column:
    """The predicted language of a text as a column: texts alone go to Python, the row's rest stays."""

    @F.arrow_udf("string")
    def predicted(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        judge = _Judge(prototypes)
        for batch in texts:
            yield pa.array([judge.one(x.as_py())[0] for x in batch], pa.string())
            C.release()

    return predicted(text)


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's language; rows whose fold is 2 teach nothing."""
    docs = C.table(spark, sf_dir, "documents")
    fold = C.fold_of(F.col("doc_id"), 4)
    found = predict(docs, fit(docs.where(fold != 2)))
    return found.select("doc_id", (fold == 2).alias("held_out"), "lang_pred", F.col("lang_score").alias("score"))
