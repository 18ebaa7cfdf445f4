"""Byte-level BPE encoding and decoding.

A task cuts its texts into pre-tokens, numbers the distinct words and sends each block on as numbers with the
words it has not met before. Higher-order functions fold the ranked
merges over a word's bytes, looking pairs up in a literal map of ranks (dealt by crc32 into buckets, as a map is
searched from its start). The ids of a block are then gathered by number. Nothing is shuffled, collected or
sent but the ranks; a lost task is run again from its input. Decoding concatenates the ids' binary pieces.

The fold in higher-order functions costs about a hundred microseconds a word. Words that occur fewer than
REPEATS times in the block that brings them are folded by the same merges in the task (``_merge``): most
distinct words are rare ones, and with all of them the fold would take more than the whole budget (README).
Either way gives the same ids.

A null or empty text has no ids. Repeated rows are encoded alike; all columns named in ``keep`` pass. An id
outside the vocabulary decodes to null. Memory: the distinct words of a task, begun anew at WORDS_HELD, and blocks
of about BLOCK_PIECES pre-tokens or one longer text.
"""

from __future__ import annotations

import base64
import functools
import json
import zlib
from itertools import chain, compress, islice

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartwise.llm import common as C

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
BUCKETS = 1 << 13
REPEATS = 4
BLOCK_PIECES = 250_000
WORDS_HELD = 250_000
NONE = 2**31 - 1


@functools.cache
def load_ranks(path: str) -> dict[bytes, int]:
    """Byte pieces and their ranks (ids) from a file of base64 and number on each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, filter(bytes.strip, lines))}


def _literal(ranks: dict[bytes, int]) -> Column:
    """Ranks by the hexadecimal digits of the pieces, in buckets of their crc32; one literal of the plan."""
    buckets: list[dict[str, int]] = [{} for _ in range(BUCKETS)]
    for piece, rank in ranks.items():
        digits = piece.hex().upper()
        buckets[zlib.crc32(digits.encode()) % BUCKETS][digits] = rank
    return F.from_json(F.lit(json.dumps(buckets)), "array<map<string,int>>")


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def fold_merges(words: Column, ranks: dict[bytes, int]) -> Column:
    """The ids of each word of an array: pairs of neighbours are merged, the lowest rank first."""
    nothing = F.array().cast("array<int>")

    def with_ranks(literal):
        def rank(digits):
            return F.coalesce(F.get(literal, F.crc32(digits) % BUCKETS)[digits], F.lit(NONE))

        def merge_at(state, i):
            def put(merged):
                before = F.when(i > 1, F.array(rank(F.concat(F.get(state.p, i - 2), merged)))).otherwise(nothing)
                after = F.when(i + 1 < F.size(state.p), F.array(rank(F.concat(merged, F.get(state.p, i + 1))))).otherwise(nothing)
                parts = F.concat(F.slice(state.p, F.lit(1), i - 1), F.array(merged), F.slice(state.p, i + 2, F.size(state.p)))
                pairs = F.concat(
                    F.slice(state.r, F.lit(1), F.greatest(i - 2, F.lit(0))), before, after, F.slice(state.r, i + 2, F.size(state.p))
                )
                return F.struct(parts.alias("p"), pairs.alias("r"))

            return _let(F.concat(F.get(state.p, i - 1), F.get(state.p, i)), put)

        def step(state, _):
            def lowest(low):
                at = F.array_position(state.r, low).cast("int")
                return F.when(low == NONE, state).otherwise(_let(at, lambda i: merge_at(state, i)))

            return F.when(F.size(state.r) == 0, state).otherwise(_let(F.array_min(state.r), lowest))

        def fold(digits):
            byte = F.transform(F.sequence(F.lit(1), F.length(digits), F.lit(2)), lambda i: F.substr(digits, i, F.lit(2)))

            def start(p):
                pairs = F.transform(F.sequence(F.lit(1), F.size(p) - 1), lambda i: rank(F.concat(F.get(p, i - 1), F.get(p, i))))
                return F.struct(p.alias("p"), F.when(F.size(p) > 1, pairs).otherwise(nothing).alias("r"))

            return _let(byte, lambda p: F.aggregate(p, start(p), step, lambda s: F.transform(s.p, rank)))

        def encode(digits):
            return _let(rank(digits), lambda r: F.when(r < NONE, F.array(r)).otherwise(fold(digits)))

        return F.transform(F.transform(words, F.hex), encode)

    return _let(_literal(ranks), with_ranks)


def _merge(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The fold for one word, in the task."""
    whole = ranks.get(word)
    if whole is not None:
        return [whole]
    parts = [word[i : i + 1] for i in range(len(word))]
    get = ranks.get
    pairs = [get(word[i : i + 2], NONE) for i in range(len(word) - 1)]
    while pairs:
        low = min(pairs)
        if low == NONE:
            break
        i = pairs.index(low)
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
        del pairs[i]
        if i:
            pairs[i - 1] = get(parts[i - 1] + parts[i], NONE)
        if i < len(pairs):
            pairs[i] = get(parts[i] + parts[i + 1], NONE)
    return [ranks[p] for p in parts]


class _Numbers(dict):
    """Words and their numbers; a word not met before gets the next one."""

    def __missing__(self, word: str) -> int:
        self[word] = number = len(self)
        return number


def _numbered(batches, names: list[str]):
    """Blocks of rows: their columns, numbers of their words, and the new words (frequent, rare)."""
    find = regex.compile(public_tokenizers.PATTERN).findall
    numbers = _Numbers()

    def block(kept: pa.StructArray, words: list[str], sizes: list[int], begin: bool):
        known = len(numbers)
        codes = np.fromiter(map(numbers.__getitem__, words), np.int32, len(words))
        times = np.bincount(codes[codes >= known] - known, minlength=len(numbers) - known)
        new = list(islice(reversed(numbers), len(numbers) - known))[::-1]
        often = times >= REPEATS
        return pa.RecordBatch.from_arrays(
            [
                pa.ListArray.from_arrays(pa.array([0, len(kept)], pa.int32()), kept),
                pa.array([codes.tobytes()], pa.binary()),
                pa.array([np.array(sizes, np.int32).tobytes()], pa.binary()),
                pa.array([list(compress(new, often))], pa.list_(pa.string())),
                pa.array([list(compress(new, ~often))], pa.list_(pa.string())),
                pa.array([np.packbits(often).tobytes()], pa.binary()),
                pa.array([begin]),
            ],
            names=["rows", "codes", "sizes", "often", "rare", "which", "begin"],
        )

    for batch in batches:
        kept = pa.StructArray.from_arrays([batch.column(n) for n in names], names=names)
        texts, first, words, sizes = batch.column("_text"), 0, [], []
        for i in range(batch.num_rows):
            found = find(texts[i].as_py() or "")
            sizes.append(len(found))
            words += found
            if len(words) >= BLOCK_PIECES or i + 1 == batch.num_rows:
                begin = len(numbers) > WORDS_HELD
                if begin:
                    numbers.clear()
                yield block(kept.slice(first, len(sizes)), words, sizes, begin)
                first, words, sizes = i + 1, [], []
        del batch, kept, texts
        C.release()
    # The worker stays for other tasks.
    numbers.clear()
    C.release()


class _Ids:
    """The ids of the words of a task, by the words' numbers."""

    def __init__(self, ranks: dict[bytes, int], decoded: bool):
        self.ranks = ranks
        self.pieces = {rank: piece for piece, rank in ranks.items()} if decoded else None
        self.begin()

    def begin(self) -> None:
        self.ids = np.zeros(0, "<u4")
        self.first, self.size = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, often: pa.ListArray, rare: list[str], which: bytes) -> None:
        """New words: the ids that Spark has folded, and words to be merged here."""
        merged = [_merge(w.encode(), self.ranks) for w in rare]
        by_spark = pc.list_value_length(often).to_numpy(zero_copy_only=False).astype(np.int64)
        added = np.concatenate([by_spark, np.fromiter(map(len, merged), np.int64, len(merged))])
        flat = np.concatenate(
            [often.flatten().to_numpy(zero_copy_only=False), np.fromiter(chain.from_iterable(merged), np.int64)]
        )
        is_often = np.unpackbits(np.frombuffer(which, np.uint8), count=len(added)).astype(bool)
        place = np.empty(len(added), np.int64)  # of each new word, in the order of their numbers
        place[is_often], place[~is_often] = np.arange(len(by_spark)), np.arange(len(by_spark), len(added))
        self.first = np.concatenate([self.first, (len(self.ids) + np.cumsum(added) - added)[place]])
        self.size = np.concatenate([self.size, added[place]])
        self.ids = np.concatenate([self.ids, flat.astype("<u4")])

    def rows(self, codes: np.ndarray, words: np.ndarray) -> list[pa.Array]:
        """The ids of each row's words as bytes; then what they decode to, if that is wanted."""
        own = self.size[codes]
        ends = np.cumsum(own)
        numbers = self.ids[np.repeat(self.first[codes] - (ends - own), own) + np.arange(ends[-1] if len(ends) else 0)]
        cut = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(words)])]
        out = [pa.array([numbers[a:b].tobytes() for a, b in zip(cut[:-1], cut[1:], strict=True)], pa.binary())]
        if self.pieces is not None:
            piece = self.pieces.__getitem__
            texts = [b"".join(map(piece, numbers[a:b].tolist())) for a, b in zip(cut[:-1], cut[1:], strict=True)]
            out.append(pa.array(texts, pa.binary()))
        return out


def _gathered(batches, names: list[str], ranks: dict[bytes, int], decoded: bool):
    """The rows of the blocks, with the ids of their words as bytes; and what the ids decode to, if ``decoded``."""
    known = _Ids(ranks, decoded)
    titles = [*names, "ids", *(["decoded"] if decoded else [])]
    for batch in batches:
        for i in range(batch.num_rows):
            if batch.column("begin")[i].as_py():
                known.begin()
            known.add(batch.column("encoded")[i].values, batch.column("rare")[i].as_py(), batch.column("which")[i].as_py())
            codes, words = (np.frombuffer(batch.column(c)[i].as_buffer(), np.int32) for c in ("codes", "sizes"))
            rows = batch.column("rows")[i].values
            yield pa.RecordBatch.from_arrays([*(rows.field(n) for n in names), *known.rows(codes, words)], names=titles)
            del codes, words, rows
        del batch
        C.release()
    # The worker stays for other tasks.
    del known
    C.release()


def encode(
    docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), path: str | None = None, decoded: bool = False
) -> DataFrame:
    """``keep`` and ``ids`` (little-endian unsigned 32-bit integers) of every row's whole text; with ``decoded`` also
    the bytes that the ids decode to, in the same pass."""
    ranks = load_ranks(path or public_tokenizers.path(VOCABULARY))
    rows = docs.select(*keep, F.col("text").alias("_text"))
    names = list(keep)
    kept = docs.select(*keep).schema
    made = T.StructType([T.StructField("rows", T.ArrayType(kept))])
    made = C.with_fields(made, codes="binary", sizes="binary", often="array<string>", rare="array<string>", which="binary", begin="boolean")
    blocks = rows.mapInArrow(lambda b: _numbered(b, names), made)
    encoded = blocks.select("rows", "codes", "sizes", fold_merges(F.col("often"), ranks).alias("encoded"), "rare", "which", "begin")
    made = C.with_fields(kept, ids="binary", **({"decoded": "binary"} if decoded else {}))
    return encoded.mapInArrow(lambda b: _gathered(b, names, ranks, decoded), made)


def decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """All columns and ``decoded``: the bytes that ``ids`` stand for."""
    pieces = {rank: piece for piece, rank in load_ranks(path or public_tokenizers.path(VOCABULARY)).items()}

    def one(ids):
        if ids is None:
            return None
        try:
            return b"".join(map(pieces.__getitem__, np.frombuffer(ids, "<u4").tolist()))
        except KeyError:
            return None

    def run(batches):
        for batch in batches:
            ids = batch.column(batch.schema.get_field_index("ids"))
            out = pa.array([one(x.as_buffer() if x.is_valid else None) for x in ids], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns, out], names=[*batch.schema.names, "decoded"])

    return encoded.mapInArrow(run, C.with_fields(encoded.schema, decoded="binary"))


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document, encoded and decoded again."""
    found = encode(C.table(spark, sf_dir, "documents"), decoded=True)
    return found.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
