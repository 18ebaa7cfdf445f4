"""N-gram Jaccard join by universe partitions.

A document's set is that of its distinct word shingles (64-bit hashes of them). Two sets link at
Jaccard 0.75 or more, which is a symmetric difference of at most a seventh of their sizes' sum.

Partition. Sizes fall in bands, each a third wider than the one before. For pairs whose larger set
is in a band, all sets that can be in such a pair hash their tokens into the same m segments. If
m exceeds the greatest difference H, some segment is equal in both sets; in small bands half as many
segments do, as then some segment differs by one token at most. The key of a segment's subset is
indexed; in small bands the keys of its one-deletion neighbours are too.

Allocation by cost. m is a sixth more than H + 1. A key that more than HOT sets have is too costly
to index pairs of: it is left out, and a set can afford to leave out as many of its keys (and empty
segments) as m exceeds what its own size needs. A pair with one such set is found by other keys.
Sets that would have to leave out more (members of large groups, small sets) are joined among
themselves by their rarest tokens (the quarter of a set that a partner must hit). Before that, each set
of a hot key is verified against a representative of the key, and then, in rounds, against a few others of its
tokens, so that a large group is one class already; tokens whose sets are all of one class make no pairs,
others make pairs across classes only.

Verification. Pairs that share too few keys for their sizes are dropped by count, then pairs whose sketches differ
in too many bits: a sketch holds the parity of the number of tokens in each of 4 to 8 classes a token, and every
bit in which two sets differ takes a token that one of them lacks. Both bounds are exact; the pairs left are
compared token by token. Sketches are made with the digests; tokens are stored only of the sets of pairs that are left
and of those that leave out too many keys. Links become classes by least-label propagation with pointer
jumping; each round is a table in the shared folder.

Equal sets are one node throughout, so exact copies meet only in a sum. Nodes are 64-bit digests of sets.
Texts that are null or without words have an empty set and link with nothing. Repeated rows are copies
of each other. Other columns are not looked at. Memory: the shingles of a chunk of texts (2 MB, or one
longer text), and one key partition (about a million entries) at a time.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cartwise.llm import common as C
from cartwise.session import discard, materialize

SHINGLE = 5
HOT = 16
SMALL = 40
SPARE = 1.16
CHARS_PER_PARTITION = 8_000_000
FLUSH = 500_000
SEEN = 300_000
PREFIX_BITS = 40
#: Ids of sets to be compared are sent to all tasks up to this many (16 bytes each), and joined by shuffling beyond.
SENT_NODES = 1_000_000
#: Rounds in which sets of large groups try PARTNERS others each, met in stretches of about STRETCH.
ROUNDS, PARTNERS, STRETCH = 6, 4, 512
ONE = np.uint64(0xA0761D6478BD642F)
#: Columns of the brief sketch that pairs of sets with a rare token in common are tried by: 64 classes each.
BRIEF = [f"s{i}" for i in range(8)]


def _bands() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lowest size, segments and whether one-deletion neighbours are used, of each band."""
    low = [3]
    while low[-1] < 1 << 31:
        low.append(max(low[-1] + 1, low[-1] * 4 // 3))
    low = np.array(low)
    greatest = 2 * (low[1:] - 1) // 7
    small = low[1:] - 1 <= SMALL
    segments = np.where(small, greatest // 2 + 1, np.ceil(SPARE * (greatest + 1)).astype(int))
    return low[:-1], segments, small


LOW, SEGMENTS, IS_SMALL = _bands()
SMALL_TOP = int(LOW[IS_SMALL.sum()]) - 1


def _scheme(n: np.ndarray, step: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(takes part, band, most difference of a pair with it) of sets of sizes n in their own
    band's partition (step 0) or the next one's (step 1)."""
    band = np.clip(np.searchsorted(LOW, n, side="right") - 1 + step, 0, len(SEGMENTS) - 1)
    largest = np.minimum(n * 4 // 3, np.where(band + 1 < len(LOW), LOW[np.minimum(band + 1, len(LOW) - 1)] - 1, n * 4 // 3))
    part = (n >= 3) & ((step == 0) | (largest >= LOW[band]))
    return part, band, (n + largest) // 7


def _cells(row: np.ndarray, token: np.ndarray, n: np.ndarray, step: int):
    """The segments of all sets: band and segment count by row; row, segment, sum of tokens and size by cell; cell by token."""
    part, band, most = _scheme(n, step)
    m = np.where(part, SEGMENTS[band], 0)
    base = np.concatenate([[0], np.cumsum(m)])
    inside = part[row]
    row, token = row[inside], token[inside]
    place = ((C.mix(token ^ ONE) >> np.uint64(32)) * m[row].astype(np.uint64)) >> np.uint64(32)
    cell = base[row] + place.astype(np.int64)
    weight = C.mix(token + ONE)
    total = np.zeros(base[-1], np.uint64)
    np.add.at(total, cell, weight)
    size = np.bincount(cell, minlength=base[-1])
    return part, band, most, m, base, total, size, cell, weight


def _node(row: np.ndarray, token: np.ndarray, n: np.ndarray) -> np.ndarray:
    """A digest of each set, whatever the order of its tokens."""
    total = np.zeros(len(n), np.uint64)
    np.add.at(total, row, C.mix(token * C.BASE + ONE))
    return C.mix(total + n.astype(np.uint64)).view(np.int64)


def describe(docs: DataFrame) -> DataFrame:
    """(doc_id, node, n, m, e0, e1, spare, sketch) of every row: the set's digest and size, the segments of its
    band, the segments it cannot use in its own band's partition and in the next one's, how many
    more it can do without (negative: too many already), and its sketch."""

    def run(batches):
        for batch in batches:
            ids = batch.column("doc_id")
            for first, end, data, offsets in C.chunks(batch.column("_text")):
                row, token = C.word_shingles(data, offsets, SHINGLE)
                n = np.bincount(row, minlength=end - first)
                spare, empty = np.full(len(n), 1 << 30), []
                for step in (0, 1):
                    part, band, most, m, base, _, size, _, _ = _cells(row, token, n, step)
                    owner = np.repeat(np.arange(len(n)), m)
                    unusable = size <= IS_SMALL[band][owner]
                    e = np.bincount(owner[unusable], minlength=len(n))
                    need = np.where(IS_SMALL[band], most // 2 + 1, most + 1)
                    spare = np.where(part, np.minimum(spare, m - e - need), spare)
                    empty.append(e)
                    if step == 0:
                        own = m
                cut = np.searchsorted(row, np.arange(len(n) + 1))
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.slice(first, end - first),
                        pa.array(_node(row, token, n)),
                        *(pa.array(x.astype(np.int32)) for x in (n, own, *empty, spare)),
                        pa.array([_sketch(token[a:b]) for a, b in zip(cut[:-1], cut[1:], strict=True)], pa.binary()),
                    ],
                    names=["doc_id", "node", "n", "m", "e0", "e1", "spare", "sketch"],
                )
            C.release()

    kept = docs.select("doc_id", F.col("text").alias("_text"))
    kind = dict(kept.dtypes)["doc_id"]
    return kept.mapInArrow(run, f"doc_id {kind}, node long, n int, m int, e0 int, e1 int, spare int, sketch binary")


def _index(docs: DataFrame, partitions: int) -> DataFrame:
    """(p, blob): keys (4 bytes, in one blob's first half) and nodes (5 bytes) of the partitions' entries."""

    def out(keys, nodes):
        keys, nodes = np.concatenate(keys), np.concatenate(nodes)
        p = (keys >> np.uint64(32)).astype(np.int64) * partitions >> 32
        order = np.argsort(p, kind="stable")
        p, low = p[order], (keys & np.uint64(0xFFFFFFFF)).astype("<u4")[order]
        five = nodes[order].astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5]
        cut = np.flatnonzero(np.concatenate([[True], p[1:] != p[:-1]]))
        ends = [*cut[1:], len(p)]
        blobs = [low[a:b].tobytes() + five[a:b].tobytes() for a, b in zip(cut, ends, strict=True)]
        return pa.RecordBatch.from_arrays([pa.array(p[cut]), pa.array(blobs, pa.binary())], names=["p", "blob"])

    def run(batches):
        seen: set[int] = set()
        keys, nodes, held = [], [], 0
        for batch in batches:
            for _, end, data, offsets in C.chunks(batch.column("text")):
                row, token = C.word_shingles(data, offsets, SHINGLE)
                n = np.bincount(row, minlength=len(offsets) - 1)
                node = _node(row, token, n)
                # Copies that this task has met are not indexed again.
                fresh = np.zeros(len(n), bool)
                for i, x in enumerate(node.tolist()):
                    if x not in seen:
                        seen.add(x)
                        fresh[i] = True
                inside = fresh[row]
                row, token, n = row[inside], token[inside], np.where(fresh, n, 0)
                short = node.view(np.uint64) >> np.uint64(64 - PREFIX_BITS)
                for step in (0, 1):
                    part, band, _, m, base, total, size, cell, weight = _cells(row, token, n, step)
                    owner = np.repeat(np.arange(len(n)), m)
                    segment = np.arange(len(owner)) - base[owner]
                    salt = C.mix((band[owner].astype(np.uint64) << np.uint64(40)) + segment.astype(np.uint64))
                    small = IS_SMALL[band][owner]
                    use = size > 0
                    keys.append(C.mix(total[use] + salt[use]))
                    nodes.append(short[owner[use]])
                    less = small[cell] & (size[cell] > 1)
                    keys.append(C.mix(total[cell[less]] - weight[less] + salt[cell[less]]))
                    nodes.append(short[owner[cell[less]]])
                    held += len(keys[-1]) + len(keys[-2])
                if held >= FLUSH:
                    yield out(keys, nodes)
                    keys, nodes, held = [], [], 0
            if len(seen) > SEEN:
                seen.clear()
            C.release()
        if held:
            yield out(keys, nodes)
        del keys, nodes, seen
        C.release()

    return docs.select("text").where("text is not null").mapInArrow(run, "p long, blob binary")


def _meetings(found: pa.Table) -> pa.Table:
    """What meets in one partition of the keys: kind 0, pairs of sets with their number of common keys;
    kind 1, a hot key's representative and another of its sets; kind 2, sets with their number of hot keys."""
    keys, nodes = [], []
    for blob in found.column("blob").to_pylist():
        n = len(blob) // 9
        keys.append(np.frombuffer(blob, "<u4", n))
        five = np.zeros((n, 8), np.uint8)
        five[:, :5] = np.frombuffer(blob, np.uint8, n * 5, n * 4).reshape(-1, 5)
        nodes.append(five.view("<u8")[:, 0].astype(np.int64))
    keys, nodes = np.concatenate(keys), np.concatenate(nodes)
    order = np.argsort(keys, kind="stable")
    keys, nodes = keys[order], nodes[order]
    same = keys[1:] == keys[:-1]
    often = np.concatenate([same, [False]]) | np.concatenate([[False], same])
    keys, nodes = keys[often], nodes[often]
    order = np.lexsort((nodes, keys))
    keys, nodes = keys[order], nodes[order]
    new = np.concatenate([[True], (keys[1:] != keys[:-1]) | (nodes[1:] != nodes[:-1])])[: len(keys)]
    keys, nodes = keys[new], nodes[new]
    start = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])[: len(keys)])
    size = np.diff(np.concatenate([start, [len(keys)]]))
    kinds, firsts, seconds = [], [], []
    for k in np.unique(size):
        at = start[size == k]
        if k < 2:
            continue
        group = nodes[at[:, None] + np.arange(k)]
        if k <= HOT:
            i, j = np.triu_indices(k, 1)
            kinds.append(np.zeros(len(at) * len(i), np.int8))
            firsts.append(group[:, i].ravel())
            seconds.append(group[:, j].ravel())
        else:
            kinds += [np.full(len(at) * (k - 1), 1, np.int8), np.full(len(at) * k, 2, np.int8)]
            firsts += [np.repeat(group[:, 0], k - 1), group.ravel()]
            seconds += [group[:, 1:].ravel(), np.zeros(len(at) * k, np.int64)]
    none = [np.zeros(0, np.int64)]
    kinds, a, b = np.concatenate(kinds or none), np.concatenate(firsts or none), np.concatenate(seconds or none)
    order = np.lexsort((b, a, kinds))
    kinds, a, b = kinds[order], a[order], b[order]
    new = np.flatnonzero(np.concatenate([[True], (kinds[1:] != kinds[:-1]) | (a[1:] != a[:-1]) | (b[1:] != b[:-1])])[: len(a)])
    times = np.diff(np.concatenate([new, [len(a)]]))
    kinds, a, b = kinds[new], a[new], b[new]
    # Of a set's representatives in this partition the most frequent will do.
    order = np.lexsort((a, -times, b, kinds))
    star, b_ = kinds[order] == 1, b[order]
    again = np.concatenate([[False], star[1:] & star[:-1] & (b_[1:] == b_[:-1])])[: len(order)]
    keep = np.sort(order[~again])
    kinds, a, b, times = kinds[keep], a[keep], b[keep], times[keep]
    return pa.table(
        {"kind": pa.array(kinds.astype(np.int8)), "a": a, "b": b, "times": pa.array(times, pa.int32())}
    )


def _met(found: pa.Table) -> pa.Table:
    """The meetings of a partition. The worker stays for other tasks and gives the memory of this one back."""
    out = _meetings(found)
    C.release()
    return out


def _sketch(tokens: np.ndarray) -> bytes:
    """The parity of the number of tokens in each class, a power of two of them, by the tokens' last bits."""
    bits = 1 << max(6, (4 * len(tokens) - 1).bit_length())
    classes = (tokens & np.uint64(bits - 1)).astype(np.int64)
    return np.packbits((np.bincount(classes, minlength=bits) & 1).astype(np.uint8), bitorder="little").tobytes()


def _brief(row: np.ndarray, token: np.ndarray, n: int) -> np.ndarray:
    """The parities of each row's tokens in the 64 classes of each BRIEF column."""
    bits = 64 * len(BRIEF)
    classes = row * bits + (token & np.uint64(bits - 1)).astype(np.int64)
    parity = (np.bincount(classes, minlength=n * bits) & 1).astype(np.uint8).reshape(n, bits)
    return np.packbits(parity, axis=1, bitorder="little").view(np.int64)


def _least_difference(x: np.ndarray, y: np.ndarray) -> int:
    """A lower bound of the number of tokens that one of two sets has and the other has not, by their sketches."""
    while len(x) != len(y):  # half the classes have the parities of both halves' sums
        x, y = (x, y) if len(x) > len(y) else (y, x)
        x = x[: len(x) // 2] ^ x[len(x) // 2 :]
    return int(np.bitwise_count(x ^ y).sum())


def _sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(node, over, n, BRIEF, tokens) of the wanted nodes: sorted tokens of 8 bytes; ``wanted`` is (doc_id, key, node, over), a
    row that has the set (its id, which may be null, and the hash of its text) and whether the set leaves out too many keys."""

    def run(batches):
        for batch in batches:
            for first, end, data, offsets in C.chunks(batch.column("text")):
                row, token = C.word_shingles(data, offsets, SHINGLE)
                cut = np.searchsorted(row, np.arange(end - first + 1))
                n = np.diff(cut)
                each = [token[a:b] for a, b in zip(cut[:-1], cut[1:], strict=True)]
                own = pa.RecordBatch.from_arrays(
                    [
                        *(batch.column(c).slice(first, end - first) for c in ("node", "over")),
                        pa.array(n.astype(np.int32)),
                        *(pa.array(x) for x in np.ascontiguousarray(_brief(row, token, end - first).T)),
                        pa.array([x.tobytes() for x in each], pa.binary()),
                    ],
                    names=["node", "over", "n", *BRIEF, "tokens"],
                )
                # Equal hashes may bring other texts: the digest tells them apart.
                right = _node(row, token, n) == own.column("node").to_numpy()
                yield own.filter(pa.array(right))
            C.release()

    if wanted.count() <= SENT_NODES:
        wanted = F.broadcast(wanted)
    keyed = docs.where("text is not null").select("doc_id", "text", F.xxhash64("text").alias("key"))
    same = F.col("d.doc_id").eqNullSafe(F.col("w.doc_id")) & (F.col("d.key") == F.col("w.key"))
    rows = keyed.alias("d").join(wanted.alias("w"), same).select("w.node", "w.over", "d.text")
    return rows.mapInArrow(run, f"node long, over boolean, n int, {', '.join(f'{c} long' for c in BRIEF)}, tokens binary")


def _sketches(described: DataFrame, wanted: DataFrame) -> DataFrame:
    """(node, n, sketch) of the wanted nodes, from the described row that stands for each."""
    if wanted.count() <= SENT_NODES:
        wanted = F.broadcast(wanted)
    same = F.col("d.doc_id").eqNullSafe(F.col("w.doc_id")) & (F.col("d.key") == F.col("w.key")) & (F.col("d.node") == F.col("w.node"))
    return described.alias("d").join(wanted.alias("w"), same).select("d.node", "d.n", "d.sketch")


def _stored_once(sets: DataFrame, name: str) -> DataFrame:
    """The table, stored, with one row for each node: rows of the input may repeat."""
    stored = materialize(sets, name)
    if stored.groupBy("node").count().where("count > 1").isEmpty():
        return stored
    once = materialize(stored.dropDuplicates(["node"]), name)
    discard(stored)
    return once


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node")))


def _possible(pairs: DataFrame, sketches: DataFrame) -> DataFrame:
    """The (a, b, share) whose sketches do not rule out a link."""

    def run(batches):
        for batch in batches:
            most = (batch.column("x_n").to_numpy().astype(np.int64) + batch.column("y_n").to_numpy()) // 7
            keep = []
            for i in range(batch.num_rows):
                x, y = (np.frombuffer(batch.column(c)[i].as_buffer(), np.uint64) for c in ("x", "y"))
                if _least_difference(x, y) <= most[i]:
                    keep.append(i)
            yield batch.select(["a", "b", "share"]).take(pa.array(keep, pa.int32()))

    x = sketches.select(F.col("node").alias("a"), F.col("n").alias("x_n"), F.col("sketch").alias("x"))
    y = sketches.select(F.col("node").alias("b"), F.col("n").alias("y_n"), F.col("sketch").alias("y"))
    rows = pairs.join(x, "a").join(y, "b").select("a", "b", "share", "x_n", "y_n", "x", "y")
    return rows.mapInArrow(run, "a long, b long, share double")


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The (a, b) of nodes that link, compared token by token; ``pairs`` is a stored table."""

    def run(batches):
        for batch in batches:
            keep = []
            for i in range(batch.num_rows):
                x = np.frombuffer(batch.column("x")[i].as_buffer(), np.uint64)
                y = np.frombuffer(batch.column("y")[i].as_buffer(), np.uint64)
                at = np.searchsorted(x, y)
                both = int((x[np.minimum(at, len(x) - 1)] == y).sum()) if len(x) else 0
                if both and 100 * both >= 75 * (len(x) + len(y) - both):
                    keep.append(i)
            yield batch.select(["a", "b"]).take(pa.array(keep, pa.int32()))

    ends = _ends(pairs).distinct()
    # Only the sets of these pairs are moved.
    if ends.count() <= SENT_NODES:
        sets = sets.join(F.broadcast(ends), "node", "left_semi")
    x = sets.select(F.col("node").alias("a"), F.col("tokens").alias("x"))
    y = sets.select(F.col("node").alias("b"), F.col("tokens").alias("y"))
    return pairs.select("a", "b").join(x, "a").join(y, "b").select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


def classes(links: DataFrame, start: DataFrame | None = None) -> DataFrame:
    """(id, label): the least id that links (a, b) reach from each linked id.

    Every round takes the least label among the neighbours, then the label of the label.
    """
    edges = materialize(
        links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges"
    )
    labels = edges.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("label"))
    labels = materialize(labels.select("id", F.least("id", "label").alias("label")), "labels")
    while True:
        near = edges.join(labels.withColumnRenamed("id", "a"), "a").groupBy(F.col("b").alias("id")).agg(F.min("label").alias("near"))
        lower = labels.join(near, "id").select("id", F.least("label", "near").alias("label"), F.col("label").alias("old"))
        jump = lower.select(F.col("id").alias("label"), F.col("label").alias("next"))
        new = lower.join(jump, "label", "left").select("id", F.coalesce("next", "label").alias("label"), "old")
        new = materialize(new, "labels")
        if new.where("label <> old").isEmpty():
            return new.select("id", "label")
        labels = new.select("id", "label")


def _joined(labels: DataFrame, links: DataFrame) -> DataFrame:
    """``labels`` (node, label) with the classes that ``links`` connect as one."""
    edges = links
    for end in ("a", "b"):
        edges = edges.join(labels.select(F.col("node").alias(end), F.col("label").alias(f"{end}_label")), end)
    edges = edges.where("a_label <> b_label").select(F.col("a_label").alias("a"), F.col("b_label").alias("b"))
    found = classes(edges).withColumnRenamed("label", "least")
    new = labels.join(found.withColumnRenamed("id", "label"), "label", "left")
    return materialize(new.select("node", F.coalesce("least", "label").alias("label")), "labels")


def _apart(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """The pairs (a, b) whose nodes are in different classes."""
    for end in ("a", "b"):
        pairs = pairs.join(labels.select(F.col("node").alias(end), F.col("label").alias(f"{end}_label")), end)
    return pairs.where("a_label <> b_label").select("a", "b")


def _neighbours(prefix: DataFrame, labels: DataFrame, turn: int) -> DataFrame:
    """Pairs across classes, PARTNERS for a node: of those next to each other in the tokens' lists, which are
    dealt by chance into stretches of some hundreds."""
    rows = prefix.join(labels, "node")
    chance = F.xxhash64(F.lit(turn), "node")
    stretch = F.pmod(F.xxhash64(F.lit(turn + 1000), "node"), F.ceil(F.col("often") / STRETCH))
    line = W.partitionBy("token", stretch).orderBy(chance)
    following = F.lead(F.struct("node", "n", "label")).over(line)
    pairs = rows.select("node", "n", "label", following.alias("y")).where(
        "label <> y.label and 4 * least(n, y.n) >= 3 * greatest(n, y.n)"
    )
    pairs = pairs.select(F.least("node", "y.node").alias("a"), F.greatest("node", "y.node").alias("b")).distinct()
    few = W.partitionBy("a").orderBy(F.xxhash64(F.lit(turn), "a", "b"))
    return pairs.withColumn("place", F.row_number().over(few)).where(F.col("place") <= PARTNERS).select("a", "b")


def _across(prefix: DataFrame, labels: DataFrame, sets: DataFrame) -> DataFrame:
    """All pairs across classes that can link: sets with ``common`` tokens in common have one among the first
    n - common + 1 of either, in one order of all tokens (the rarest first), and brief sketches that differ in a
    seventh of their sizes' sum at most."""
    rows = prefix.join(labels, "node")
    split = rows.groupBy("token").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low < high")
    rows = rows.join(split.select("token"), "token").select("token", "node", "n", "label", "place")
    rows = materialize(rows.join(sets.select("node", *BRIEF), "node"), "prefix")
    differ = " + ".join(f"bit_count(l.{c} ^ r.{c})" for c in BRIEF)
    common = "ceil(3 * (l.n + r.n) / 7)"
    left, right = rows.alias("l"), rows.alias("r")
    return (
        left.join(right, F.col("l.token") == F.col("r.token"))
        .where("l.label <> r.label and (l.n < r.n or l.n = r.n and l.node < r.node) and 4 * l.n >= 3 * r.n")
        .where(f"l.place <= l.n - {common} + 1 and r.place <= r.n - {common} + 1 and 7 * ({differ}) <= l.n + r.n")
        .select(F.col("l.node").alias("a"), F.col("r.node").alias("b"))
        .distinct()
    )


def components(docs: DataFrame, with_classes: bool = False) -> DataFrame:
    """(doc_id, n_shingles, component_id, n_links) of every row of ``docs`` (doc_id, text).

    ``component_id`` is the smallest doc_id reachable by links, ``n_links`` the number of verified
    links of the row's set to other sets (enough to span its class, not all there are). A null doc_id
    is never the smallest, but the row's set links like any other. ``with_classes`` adds ``key`` (the
    hash of the text), ``node`` (the digest of its set) and ``class`` (the smallest node reachable),
    which tell apart rows and classes that share an id.
    """
    docs = docs.select("doc_id", "text")
    chars = docs.agg(F.sum(F.length("text"))).first()[0] or 0
    described = describe(docs.select(F.struct("doc_id", F.xxhash64("text").alias("key")).alias("doc_id"), "text"))
    described = materialize(described.select("doc_id.doc_id", "doc_id.key", *described.columns[1:]), "described")
    # Of the rows of a set, one with an id stands for it.
    place = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key")).alias("place")
    nodes = described.groupBy("node").agg(place, *(F.first(c).alias(c) for c in ("n", "m", "e0", "e1", "spare")))
    nodes = materialize(nodes.select("place.doc_id", "place.key", *[c for c in nodes.columns if c != "place"]), "nodes")
    partitions = min(max(64, math.ceil(chars / CHARS_PER_PARTITION)), 1 << 24)
    met = materialize(
        _index(docs, partitions).groupBy("p").applyInArrow(_met, "kind byte, a long, b long, times int"), "met"
    )
    full = nodes.withColumn("short", F.shiftrightunsigned("node", 64 - PREFIX_BITS))

    def resolved(pairs: DataFrame) -> DataFrame:
        out = pairs
        for side in ("a", "b"):
            info = full.select(F.col("short").alias(side), F.struct("node", "n", "m", "e0", "e1", "hot").alias(f"{side}_"))
            out = out.join(info, side)
        x, y = F.least("x", "y"), F.greatest("x", "y")
        out = out.select(F.struct("a_.n", "a_.node", "a_.m", "a_.e0", "a_.e1", "a_.hot").alias("x"), F.struct("b_.n", "b_.node", "b_.m", "b_.e0", "b_.e1", "b_.hot").alias("y"), "times")
        out = out.select(x.alias("x"), y.alias("y"), "times").where("x.node <> y.node and 4 * x.n >= 3 * y.n")
        return out

    hot = met.where("kind = 2").groupBy(F.col("a").alias("short")).agg(F.sum("times").cast("int").alias("hot"))
    full = materialize(full.join(hot, "short", "left").fillna(0, ["hot"]), "nodes")
    pairs = resolved(met.where("kind = 0").groupBy("a", "b").agg(F.sum("times").alias("times")))
    unusable = F.least(F.when(F.col("x.m") == F.col("y.m"), F.col("x.e0")).otherwise(F.col("x.e1")), F.col("y.e0"))
    need = F.col("y.m") - F.floor((F.col("x.n") + F.col("y.n")) / 7) - unusable - F.least("x.hot", "y.hot")
    pairs = pairs.where((F.col("y.n") <= SMALL_TOP) | (F.col("times") >= need))
    stars = met.where("kind = 1").groupBy("a", "b").agg(F.sum("times").alias("times"))
    best = W.partitionBy("b").orderBy(F.col("times").desc(), F.col("a"))
    stars = resolved(stars.withColumn("place", F.row_number().over(best)).where("place <= 2").drop("place"))
    pairs = pairs.select(F.col("x.node").alias("a"), F.col("y.node").alias("b"), (F.col("times") / F.col("y.m")).alias("share"))
    stars = stars.select(F.col("x.node").alias("a"), F.col("y.node").alias("b"), F.lit(None).cast("double").alias("share"))
    both = materialize(pairs.unionByName(stars).groupBy("a", "b").agg(F.max("share").alias("share")), "pairs")

    # Sketches first: tokens are stored only of sets that a pair is left with, or that leave out too many keys.
    standing = nodes.select("node", "doc_id", "key")
    sketches = _stored_once(_sketches(described, materialize(_ends(both).distinct().join(standing, "node"), "wanted")), "sketches")
    both = materialize(_possible(both, sketches), "pairs")
    discard(sketches)
    over = full.where("n >= 3 and hot > spare").select("node", F.lit(True).alias("over"))
    wanted = _ends(both).withColumn("over", F.lit(False)).unionByName(over).groupBy("node").agg(F.max("over").alias("over"))
    wanted = materialize(wanted.join(standing, "node"), "wanted")
    sets = _stored_once(_sets(docs, wanted), "sets")
    labels = wanted.select("node", F.col("node").alias("label"))

    # First each set's most similar partner, by the share of keys; then the pairs that this left in two classes.
    nearest = [W.partitionBy(end).orderBy(F.col("share").desc(), "a", "b") for end in ("a", "b")]
    placed = both.withColumns({f"by_{end}": F.row_number().over(w) for end, w in zip("ab", nearest, strict=True)})
    placed = materialize(placed.withColumn("early", F.expr("share is null or by_a = 1 or by_b = 1")), "placed")
    found = [materialize(_verified(placed.where("early"), sets), "links")]
    labels = _joined(labels, found[-1])
    found.append(materialize(_verified(materialize(_apart(placed.where("not early"), labels), "pairs"), sets), "links"))
    labels = _joined(labels, found[-1])

    # Then the sets that leave out too many keys, by their rarest tokens: a few partners each while that joins
    # many, at last all pairs across classes.
    tokens = materialize(_tokens(sets.where("over")), "tokens")
    often = tokens.groupBy("token").agg(F.count("*").alias("often"))
    order = W.partitionBy("node").orderBy("often", "token")
    prefix = tokens.join(often, "token").withColumn("place", F.row_number().over(order))
    prefix = materialize(prefix.where("often > 1 and place <= n - ceil(n * 3 / 4) + 1"), "prefix")
    for turn in range(ROUNDS):
        pairs = materialize(_neighbours(prefix, labels, turn), "pairs")
        tried = pairs.count()
        found.append(materialize(_verified(pairs, sets), "links"))
        labels = _joined(labels, found[-1])
        if 50 * found[-1].count() <= tried:
            break
    found.append(materialize(_verified(materialize(_across(prefix, labels, sets), "pairs"), sets), "links"))
    labels = _joined(labels, found[-1])

    links = found[0]
    for more in found[1:]:
        links = links.unionByName(more)
    degree = _ends(links).groupBy("node").agg(F.count("*").alias("n_links"))
    smallest = labels.join(nodes.select("node", "doc_id"), "node").groupBy("label").agg(F.min("doc_id").alias("smallest"))
    info = nodes.select("node", "doc_id").join(labels, "node", "left").join(smallest, "label", "left").join(degree, "node", "left")
    info = info.select(
        "node", F.coalesce("label", "node").alias("class"), F.coalesce("smallest", "doc_id").alias("label"), F.coalesce("n_links", F.lit(0)).alias("n_links")
    )
    info = materialize(info, "classes")
    return described.select("doc_id", "key", "node", "n").join(info, "node").select(
        *(["key", "node", "class"] if with_classes else []),
        "doc_id",
        F.col("n").cast("long").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("label")).otherwise(F.col("doc_id")).alias("component_id"),
        F.when(F.col("n") > 0, F.col("n_links")).otherwise(0).cast("long").alias("n_links"),
    )


def _tokens(sets: DataFrame) -> DataFrame:
    """(node, n, token): one row for each token of a set."""

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                token = np.frombuffer(batch.column("tokens")[i].as_buffer(), np.int64)
                for a in range(0, len(token), 100_000):
                    part = token[a : a + 100_000]
                    node, n = (batch.column(c)[i].as_py() for c in ("node", "n"))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(part), x)) for x in (node, n)] + [pa.array(part)],
                        names=["node", "n", "token"],
                    )

    return sets.select("node", F.col("n").cast("long").alias("n"), "tokens").mapInArrow(run, "node long, n long, token long")


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's class."""
    return components(C.table(spark, sf_dir, "documents")).drop("n_links")


SQL = r"""
WITH RECURSIVE low AS (SELECT doc_id, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
words AS (SELECT doc_id, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w FROM low WHERE t IS NOT NULL),
sets AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
  ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i : i + 4], ' '))) END AS s FROM words),
tokens AS (SELECT doc_id, len(s) AS n, unnest(s) AS token FROM sets),
links AS (SELECT a.doc_id AS a, b.doc_id AS b FROM tokens a JOIN tokens b ON a.token = b.token AND a.doc_id < b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))),
edges AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach AS (SELECT doc_id AS x, doc_id AS y FROM documents UNION SELECT r.x, e.b FROM reach r JOIN edges e ON r.y = e.a)
SELECT d.doc_id, coalesce(len(s), 0)::BIGINT AS n_shingles, min(y) AS component_id
FROM documents d LEFT JOIN sets USING (doc_id) JOIN reach r ON r.x = d.doc_id GROUP BY d.doc_id, s
"""
