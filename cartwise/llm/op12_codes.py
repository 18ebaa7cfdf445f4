"""Vectors as short codes: integer product quantisation whose rounds rescan by norm-of-sum bounds.

Vectors are cut into equal parts, each part position has a codebook. Every round assigns each part
to the nearest entry, then moves each entry to the floored mean of its parts. All sums and distances
are whole numbers, so that the result does not depend on how rows are dealt to tasks.

After the first round most parts keep their entry, and a bound shows it without a scan. A part keeps
an upper bound of the distance to its entry and, for each group of entries, a lower bound of the
distance to the group's others, each with the stamp of the round in which it was exact. The driver
keeps all codebooks since the first. By the triangle inequality a bound of round t is off by at most
the norm of an entry's net displacement, |c_now - c_t|: the norm of the sum of its moves, which is
never more than the sum of their norms that a running drift would add up, and which shrinks again
when an entry turns back. A part whose upper bound is below all its lower bounds keeps its entry; one
that is not gets its exact distance; only groups that this leaves open are scanned.

Rows, their integers and their bounds are one stored table, written anew each round, the last one's
discarded. Sums of a round are added by (part, entry). Codebooks are parts x entries rows of whole
numbers, bounded by the parameters; nothing else goes to the driver.

Rows whose vector is null or holds null or non-finite components are dropped. The codebooks are for
the most frequent length (the smaller of two as frequent) that the number of parts divides; vectors of
another length stay with null code and error. Rows that repeat a vec_id are rows each; seeds of one
vec_id are ordered by vector, null vec_ids are the last seeds. With fewer rows than entries there are
as many entries. Components are exact up to about 2^28 / sqrt(part length) after scaling; above, it is
an error. An empty table gives no rows. Other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwise.functions.joins import lookup_join
from cartwise.llm import common as C
from cartwise.session import discard, materialize

#: Groups of entries that share a lower bound.
GROUPS = 8
#: Rows whose distances are in memory at once: 1024 x 256 x 8 bytes are 2 MB.
ROWS = 1024
#: Added to a comparison of bounds: they are roots of whole numbers in floating point.
SLACK = 1e-6


def _squared(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances of all rows and entries, both of whole numbers."""
    top = 2 * max(np.abs(x).max(initial=0), np.abs(entries).max(initial=0))
    if x.shape[1] * float(top) ** 2 < 2.0**52:
        a, b = x.astype(float), entries.astype(float)
        return (a * a).sum(1)[:, None] - 2 * (a @ b.T) + (b * b).sum(1)
    apart = x.astype(np.int64)[:, None, :] - entries.astype(np.int64)[None]
    return (apart * apart).sum(2)


def _own(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distance of each row and the entry beside it."""
    apart = x.astype(np.int64) - entries.astype(np.int64)
    return (apart * apart).sum(1)


@dataclass
class Codebook:
    """One part position: its entries in every round so far, and the groups of entries."""

    rounds: list[np.ndarray]
    groups: list[np.ndarray]

    @staticmethod
    def of(entries: np.ndarray, groups: int = GROUPS) -> Codebook:
        """Groups are neighbours along the entries' widest direction; any would be right."""
        at = entries - entries.mean(0)
        widest = np.linalg.eigh((at.T @ at).astype(float))[1][:, -1] if at.shape[1] else np.zeros(0)
        order = np.argsort(at @ widest, kind="stable")
        return Codebook([entries], [np.sort(g) for g in np.array_split(order, min(groups, len(entries)))])

    def moves(self) -> np.ndarray:
        """(stamp, entry): the norm of each entry's net displacement since that round."""
        now = self.rounds[-1]
        return np.stack([np.sqrt(_own(now, then).astype(float)) for then in self.rounds])


def _record(groups: int) -> np.dtype:
    """What is kept of a part: entry, bounds and the rounds in which they were exact."""
    bounds = [("entry", "u1"), ("upper_at", "u1"), ("upper", "<f4"), ("lower_at", "u1", (groups,)), ("lower", "<f4", (groups,))]
    return np.dtype(bounds)


def _up(x: np.ndarray) -> np.ndarray:
    return np.nextafter(x.astype(np.float32), np.float32(np.inf))


def _down(x: np.ndarray) -> np.ndarray:
    return np.nextafter(x.astype(np.float32), np.float32(-np.inf))


def first_round(x: np.ndarray, book: Codebook) -> np.ndarray:
    """The nearest entries and the bounds that the distances give."""
    out = np.zeros(len(x), _record(len(book.groups)))
    for a in range(0, len(x), ROWS):
        far, part = _squared(x[a : a + ROWS], book.rounds[0]), out[a : a + ROWS]
        row = np.arange(len(part))
        part["entry"] = far.argmin(1)
        part["upper"] = _up(np.sqrt(far[row, part["entry"]].astype(float)))
        rest = far.astype(float)
        rest[row, part["entry"]] = np.inf
        for g, entries in enumerate(book.groups):
            part["lower"][:, g] = _down(np.sqrt(rest[:, entries].min(1)))
    return out


def next_round(x: np.ndarray, kept: np.ndarray, book: Codebook) -> tuple[np.ndarray, int]:
    """The state after the codebook moved, and the number of (part, group) scans it took."""
    now, entries, moves = len(book.rounds) - 1, book.rounds[-1], book.moves()
    of_group = np.stack([moves[:, g].max(1) for g in book.groups], axis=1)
    state, groups = kept.copy(), np.arange(len(book.groups))
    group_of = np.zeros(len(entries), int)
    for g, members in enumerate(book.groups):
        group_of[members] = g
    upper = state["upper"] + moves[state["upper_at"], state["entry"]]
    lower = state["lower"].astype(float) - of_group[state["lower_at"], groups]
    open_rows = np.flatnonzero(upper + SLACK >= lower.min(1))
    scans = 0
    for a in range(0, len(open_rows), ROWS):
        rows = open_rows[a : a + ROWS]
        part, own, bound = state[rows], x[rows], lower[rows]
        old = part["entry"].astype(int)
        distance = _own(own, entries[old])
        to_old = np.sqrt(distance.astype(float))
        part["upper"], part["upper_at"] = _up(to_old), now
        wanted = to_old[:, None] + SLACK >= bound
        best, who = distance.copy(), old.copy()
        nearest = np.full(wanted.shape, np.iinfo(np.int64).max)
        second, first = nearest.copy(), np.full(wanted.shape, -1)
        for g, members in enumerate(book.groups):
            at = np.flatnonzero(wanted[:, g])
            if not len(at):
                continue
            scans += len(at)
            far = _squared(own[at], entries[members]).astype(np.int64)
            place = far.argmin(1)
            first[at, g], nearest[at, g] = members[place], far[np.arange(len(at)), place]
            if len(members) > 1:
                far[np.arange(len(at)), place] = np.iinfo(np.int64).max
                second[at, g] = far.min(1)
            closer = (nearest[at, g] < best[at]) | ((nearest[at, g] == best[at]) & (first[at, g] < who[at]))
            best[at[closer]], who[at[closer]] = nearest[at[closer], g], first[at[closer], g]
        others = np.where(first == who[:, None], second, nearest)
        none = others == np.iinfo(np.int64).max
        exact = np.where(none, np.inf, np.sqrt(np.where(none, 0, others).astype(float)))
        part["lower"][wanted] = _down(exact[wanted])
        part["lower_at"][wanted] = now
        # An entry that was left is one of the others of its group, if that was not scanned.
        left = np.flatnonzero((who != old) & ~wanted[np.arange(len(rows)), group_of[old]])
        g = group_of[old[left]]
        part["lower"][left, g] = _down(np.minimum(bound[left, g], to_old[left]))
        part["lower_at"][left, g] = now
        part["entry"] = who
        part["upper"] = _up(np.sqrt(best.astype(float)))
        state[rows] = part
    return state, scans


# --- the stored table -------------------------------------------------------


def _integers(column: pa.Array, kind: str, length: int) -> np.ndarray:
    """Binary cells of equal size as rows of numbers."""
    flat = b"".join(cell.as_buffer().to_pybytes() for cell in column)
    return np.frombuffer(flat, kind).reshape(len(column), length)


def _cells(rows: np.ndarray) -> pa.Array:
    data = np.ascontiguousarray(rows)
    size = data.nbytes // len(data) if len(data) else 1
    return pa.array([data[i].tobytes() for i in range(len(data))] if size else [b""] * len(data), pa.binary())


@dataclass
class _Layout:
    kind: str
    length: int
    parts: int
    groups: int

    def vectors(self, batch: pa.RecordBatch) -> list[np.ndarray]:
        v = _integers(batch.column("v"), self.kind, self.length)
        return np.split(v, self.parts, axis=1)

    def states(self, batch: pa.RecordBatch) -> np.ndarray:
        record = _record(self.groups)
        return _integers(batch.column("state"), record, self.parts) if batch.num_rows else np.zeros((0, self.parts), record)


KEYS = "vec_id long, label {label}"


def _assigned(table: DataFrame, books: list[Codebook], at: _Layout, label: str, last: bool = False) -> DataFrame:
    """The table after one more assignment; at last with codes and errors in place of bounds."""
    sent = table.sparkSession.sparkContext.broadcast(books)

    def run(batches):
        for batch in batches:
            parts = at.vectors(batch)
            if len(sent.value[0].rounds) == 1:
                found = [first_round(x, book) for x, book in zip(parts, sent.value, strict=True)]
            else:
                kept = at.states(batch)
                found = [next_round(x, kept[:, p], book)[0] for p, (x, book) in enumerate(zip(parts, sent.value, strict=True))]
            keys = [batch.column(c) for c in ("vec_id", "label")]
            if last:
                entries = np.stack([f["entry"] for f in found], axis=1)
                error = sum(_own(x, book.rounds[-1][f["entry"]]) for x, book, f in zip(parts, sent.value, found, strict=True))
                yield pa.RecordBatch.from_arrays([*keys, _cells(entries), pa.array(error, pa.int64())], names=["vec_id", "label", "code", "error"])
            else:
                cells = _cells(np.stack(found, axis=1))
                yield pa.RecordBatch.from_arrays([*keys, batch.column("v"), cells], names=["vec_id", "label", "v", "state"])

    columns = "code binary, error long" if last else "v binary, state binary"
    return table.mapInArrow(run, f"{KEYS.format(label=label)}, {columns}")


def _sums(table: DataFrame, at: _Layout, entries: int) -> DataFrame:
    """(part, entry, n, s): the number of parts that each entry has and their sums."""
    width = at.length // at.parts

    def run(batches):
        n = np.zeros((at.parts, entries), np.int64)
        s = np.zeros((at.parts, entries, width), np.int64)
        for batch in batches:
            state = at.states(batch)
            for p, x in enumerate(at.vectors(batch)):
                np.add.at(s[p], state[:, p]["entry"], x.astype(np.int64))
                n[p] += np.bincount(state[:, p]["entry"], minlength=entries)
        part, entry = np.nonzero(n)
        yield pa.RecordBatch.from_arrays(
            [pa.array(part), pa.array(entry), pa.array(n[part, entry]), pa.array(list(s[part, entry]), pa.list_(pa.int64()))],
            names=["part", "entry", "n", "s"],
        )

    each = table.mapInArrow(run, "part long, entry long, n long, s array<long>")
    total = F.array(*[F.sum(F.get("s", F.lit(i))) for i in range(width)]) if width else F.array().cast("array<long>")
    return each.groupBy("part", "entry").agg(F.sum("n").alias("n"), total.alias("s"))


def whole_vectors(rows: DataFrame, scale: int = 1024) -> DataFrame:
    """(vec_id, label, v): floor(scale * x) of each component of the vectors that take part."""
    x = F.col("embedding").cast("array<double>")
    fit = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    v = F.transform(x, lambda c: F.floor(c * F.lit(float(scale))))
    return rows.where(x.isNotNull() & fit).select(F.col("vec_id").cast("long").alias("vec_id"), "label", v.alias("v"))


def _packed(rows: DataFrame, kind: str, label: str) -> DataFrame:
    def run(batches):
        for batch in batches:
            lists = batch.column("v")
            offsets = lists.offsets.to_numpy()
            flat = lists.values.to_numpy(zero_copy_only=False)[offsets[0] : offsets[-1]].astype(kind)
            cells = _cells(flat.reshape(batch.num_rows, -1)) if batch.num_rows else pa.array([], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("label"), cells, pa.nulls(batch.num_rows, pa.binary())], names=["vec_id", "label", "v", "state"]
            )

    return rows.mapInArrow(run, f"{KEYS.format(label=label)}, v binary, state binary")


def codes(rows: DataFrame, parts: int = 4, entries: int = 256, rounds: int = 4) -> tuple[DataFrame, list[np.ndarray]]:
    """(vec_id, label, code, error) and the last codebooks, one array (entry, position) for each part.

    ``rows`` is (vec_id, label, v) as of ``whole_vectors``. A code is one byte for each part.
    """
    if not 0 < entries <= 256:
        raise ValueError("an entry's index is one byte")
    C.ship(rows.sparkSession)
    label = dict(rows.dtypes)["label"]
    size = F.size("v").alias("size")
    largest = F.max(F.coalesce(F.array_max(F.transform("v", F.abs)), F.lit(0))).alias("largest")
    lengths = rows.groupBy(size).agg(F.count(F.lit(1)).alias("n"), largest)
    chosen = lengths.where((F.col("size") > 0) & (F.col("size") % parts == 0)).orderBy(F.desc("n"), "size").first()
    none = [F.lit(None).cast("binary").alias("code"), F.lit(None).cast("long").alias("error")]
    if chosen is None:
        return rows.select("vec_id", "label", *none), []
    length, width = chosen["size"], chosen["size"] // parts
    if width * (2 * (chosen.largest + 1)) ** 2 >= 1 << 62:
        raise ValueError(f"components of up to {chosen.largest} are too large for exact 64-bit distances")
    kind = next(k for k, top in (("<i2", 1 << 15), ("<i4", 1 << 31), ("<i8", 1 << 63)) if chosen.largest < top)
    fit = rows.where(F.size("v") == length)
    seeds = np.array([r.v for r in fit.orderBy(F.asc_nulls_last("vec_id"), "v").limit(entries).select("v").collect()], np.int64)
    books = [Codebook.of(seeds[:, p * width : (p + 1) * width]) for p in range(parts)]
    at = _Layout(kind, length, parts, len(books[0].groups))

    table = materialize(_packed(fit, kind, label), "vectors")
    for _ in range(rounds):
        last, table = table, materialize(_assigned(table, books, at, label), "codes")
        discard(last)
        for book in books:
            book.rounds.append(book.rounds[-1].copy())
        for r in _sums(table, at, len(seeds)).collect():
            # Python's floor division goes down, also below zero.
            books[r.part].rounds[-1][r.entry] = [x // r.n for x in r.s]
    found = materialize(_assigned(table, books, at, label, last=True), "codes")
    discard(table)
    unfit = rows.where(F.size("v") != length).select("vec_id", "label", *none)
    return found.unionByName(unfit), [b.rounds[-1] for b in books]


def with_label_errors(found: DataFrame) -> DataFrame:
    """``found`` and the summed error of all rows of the same label, nulls together."""
    sums = found.groupBy("label").agg(F.sum("error").alias("label_error"))
    return lookup_join(found, sums, ["label"], ["vec_id", "code"], null_safe=True)


def op12_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector's code of four bytes."""
    found, books = codes(whole_vectors(C.table(spark, sf_dir, "embeddings")))
    text = ",".join(str(x) for book in books for x in book.ravel())
    return with_label_errors(found).select(
        "vec_id",
        F.lower(F.hex("code")).alias("code"),
        "error",
        "label_error",
        F.lit(hashlib.sha256(text.encode()).hexdigest()).alias("codebooks_sha256"),
    )


def _sql(rounds: int = 4) -> str:
    parts = ["""
WITH v AS MATERIALIZED (SELECT vec_id, label, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS MATERIALIZED (SELECT vec_id, p, v[p * len(v) // 4 + 1 : (p + 1) * len(v) // 4] AS x FROM v, (SELECT unnest(range(4)) AS p)),
b0 AS MATERIALIZED (SELECT p, (row_number() OVER (PARTITION BY p ORDER BY vec_id)) - 1 AS e, x AS c FROM p QUALIFY e < 256)"""]
    for t in range(rounds + 1):
        parts.append(f"""
a{t} AS MATERIALIZED (SELECT vec_id, p, min_by(e, d * 256 + e) AS e, min(d) AS d FROM (SELECT vec_id, p, e,
  list_inner_product(x, x) - 2 * list_inner_product(x, c) + list_inner_product(c, c) AS d FROM p JOIN b{t} USING (p)) GROUP BY vec_id, p)""")
        if t < rounds:
            parts.append(f"""
m{t} AS (SELECT p, e, i, floor(sum(x[i]) / count(*)) AS m FROM (SELECT p, e, x, unnest(range(1, len(x) + 1)) AS i FROM a{t} JOIN p USING (vec_id, p)) GROUP BY p, e, i),
b{t + 1} AS MATERIALIZED (SELECT p, e, coalesce(n, c) AS c FROM b{t} LEFT JOIN (SELECT p, e, list(m ORDER BY i) AS n FROM m{t} GROUP BY p, e) USING (p, e))""")
    last = f"""
h AS (SELECT sha256(string_agg(list_aggregate(list_transform(c, lambda x: x::BIGINT), 'string_agg', ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM b{rounds}),
r AS (SELECT vec_id, string_agg(printf('%02x', e), '' ORDER BY p) AS code, sum(d)::BIGINT AS error FROM a{rounds} GROUP BY vec_id)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256 FROM r JOIN v USING (vec_id), h"""
    return ",".join([*parts, last])


SQL = _sql()
