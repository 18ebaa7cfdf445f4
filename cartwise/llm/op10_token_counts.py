"""Token counts that follow edits.

A document keeps a tree over its pre-tokens: leaves of about LEAF pre-tokens with their text, lengths and token
counts, and above them the sums of characters and tokens of each subtree. An edit replaces characters [start, stop)
by other text. Pre-tokens that end at least two characters before ``start`` stand, since a match is settled by the
text up to one character behind it; from there on the new text is cut again until a cut falls on an old one at or
behind ``stop``, after which all old cuts stand, since a match depends on nothing before it. Only the pre-tokens
between are encoded anew, and the sums above their leaves are updated.

Edits of a document are applied in the order (seq, start, stop, text), each to the text that the one before left.
They come in rounds of EDITS_PER_ROUND for a document, so that no task holds more of them; between rounds texts
and trees are a table in the shared folder.

Null texts are empty. Places beyond the text are moved to its end, a stop before the start to the start, null places
to 0 and null text to none. Documents without edits keep their counts. All rows of a repeated doc_id get the edits; a
null doc_id gets none. Other columns are not looked at.
"""

from __future__ import annotations

import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cartwise.llm import common as C
from cartwise.llm.op4_bpe import VOCABULARY, _merge, load_ranks
from cartwise.session import materialize

LEAF = 128
EDITS_PER_ROUND = 256
WORDS_HELD = 400_000


class Counter:
    """Cuts text into pre-tokens and counts their tokens; keeps what it has counted."""

    def __init__(self, path: str | None = None):
        self.ranks = load_ranks(path or public_tokenizers.path(VOCABULARY))
        self.pattern = regex.compile(public_tokenizers.PATTERN)
        self.known: dict[str, int] = {}

    def count(self, word: str) -> int:
        found = self.known.get(word)
        if found is None:
            if len(self.known) > WORDS_HELD:
                self.known.clear()
            found = self.known[word] = len(_merge(word.encode("utf-8", "replace"), self.ranks))
        return found


class Tree:
    """Leaves [texts, counts of the pre-tokens]; sums of characters and tokens, root first."""

    def __init__(self, counter: Counter, words: list[str], counts: list[int] | None = None):
        self.counter = counter
        counts = [counter.count(w) for w in words] if counts is None else counts
        self.leaves = [[words[i : i + LEAF], counts[i : i + LEAF]] for i in range(0, len(words), LEAF)] or [[[], []]]
        self.encoded = 0
        self._sum_all()

    def _sum_all(self) -> None:
        self.width = 1 << (len(self.leaves) - 1).bit_length()
        self.chars, self.tokens = [0] * (2 * self.width), [0] * (2 * self.width)
        for i, (words, counts) in enumerate(self.leaves):
            self.chars[self.width + i], self.tokens[self.width + i] = sum(map(len, words)), sum(counts)
        for i in range(self.width - 1, 0, -1):
            self.chars[i] = self.chars[2 * i] + self.chars[2 * i + 1]
            self.tokens[i] = self.tokens[2 * i] + self.tokens[2 * i + 1]

    def _update(self, leaf: int) -> None:
        words, counts = self.leaves[leaf]
        i = self.width + leaf
        self.chars[i], self.tokens[i] = sum(map(len, words)), sum(counts)
        while i > 1:
            i //= 2
            self.chars[i] = self.chars[2 * i] + self.chars[2 * i + 1]
            self.tokens[i] = self.tokens[2 * i] + self.tokens[2 * i + 1]

    @property
    def total(self) -> int:
        return self.tokens[1]

    def _find(self, at: int) -> tuple[int, int]:
        """The leaf that holds character ``at`` (the last leaf for the end), and where it begins."""
        i, begin = 1, 0
        while i < self.width:
            i *= 2
            if at - begin >= self.chars[i] and self.chars[i + 1]:
                begin += self.chars[i]
                i += 1
        return min(i - self.width, len(self.leaves) - 1), begin

    def edit(self, start: int, stop: int, text: str) -> None:
        size = self.chars[1]
        start = min(max(start, 0), size)
        stop = min(max(stop, start), size)
        first, begin = self._find(max(start - 2, 0))
        words, counts = self.leaves[first]
        kept, at = 0, begin
        while kept < len(words) and at + len(words[kept]) <= start - 2:
            at += len(words[kept])
            kept += 1
        # The text from the cut at ``at`` to the end of the leaf of ``stop``, and on leaf by leaf until the cuts meet.
        last, last_begin = self._find(max(stop - 1, at))
        end = last_begin + self.chars[self.width + last]
        old = [w for leaf in range(first, last + 1) for w in self.leaves[leaf][0]][kept:]
        flat = "".join(old)
        new_text = flat[: start - at] + text + flat[stop - at :]
        shift = len(text) - (stop - start)
        while True:
            cuts, place = {}, at
            for n, word in enumerate(old):
                if place >= stop:
                    cuts[place + shift] = n
                place += len(word)
            if last + 1 == len(self.leaves):
                cuts[place + shift] = len(old)
            made, place, resumed = [], at, None
            # A match that may look past the text at hand is not settled, unless the document ends there.
            for match in self.counter.pattern.finditer(new_text):
                place = at + match.start()
                if place in cuts and place >= start + len(text):
                    resumed = cuts[place]
                    break
                made.append(match.group())
            if resumed is None and last + 1 == len(self.leaves):
                resumed = len(old)
            if resumed is not None:
                break
            last += 1
            more = self.leaves[last][0]
            old += more
            new_text += "".join(more)
            end += self.chars[self.width + last]
        found = [self.counter.count(w) for w in made]
        self.encoded += len(made)
        tail_words = [w for leaf in range(first, last + 1) for w in self.leaves[leaf][0]][kept + resumed :]
        tail_counts = [c for leaf in range(first, last + 1) for c in self.leaves[leaf][1]][kept + resumed :]
        all_words, all_counts = words[:kept] + made + tail_words, counts[:kept] + found + tail_counts
        if len(all_words) > 2 * LEAF * (last - first + 1):
            put = [[all_words[i : i + LEAF], all_counts[i : i + LEAF]] for i in range(0, len(all_words), LEAF)]
            self.leaves[first : last + 1] = put
            self._sum_all()
            return
        step = -(-len(all_words) // (last - first + 1)) or 1
        for n, leaf in enumerate(range(first, last + 1)):
            self.leaves[leaf] = [all_words[n * step : (n + 1) * step], all_counts[n * step : (n + 1) * step]]
            self._update(leaf)

    def words(self) -> list[str]:
        return [w for words, _ in self.leaves for w in words]

    def counts(self) -> list[int]:
        return [c for _, counts in self.leaves for c in counts]


def _apply(rows: DataFrame, first: bool, path: str | None) -> DataFrame:
    """One round: (doc_id, words, counts, before, encoded) with the edits of column ``edits`` applied."""

    def run(batches):
        counter = Counter(path)
        for batch in batches:
            out = []
            edits = batch.column("edits").to_pylist()
            for i in range(batch.num_rows):
                if first:
                    tree = Tree(counter, counter.pattern.findall(batch.column("text")[i].as_py() or ""))
                    before, encoded = tree.total, 0
                else:
                    tree = Tree(counter, batch.column("words")[i].as_py(), batch.column("counts")[i].as_py())
                    before, encoded = batch.column("before")[i].as_py(), batch.column("encoded")[i].as_py()
                for edit in edits[i] or ():
                    tree.edit(edit["start"] or 0, edit["stop"] or 0, edit["insert"] or "")
                out.append((tree.words(), tree.counts(), before, encoded + tree.encoded, tree.total))
                if len(out) == 200 or i + 1 == batch.num_rows:
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column("doc_id").slice(i + 1 - len(out), len(out)),
                            pa.array([o[0] for o in out], pa.list_(pa.string())),
                            pa.array([o[1] for o in out], pa.list_(pa.int32())),
                            *(pa.array([o[k] for o in out], pa.int64()) for k in (2, 3, 4)),
                        ],
                        names=["doc_id", "words", "counts", "before", "encoded", "total"],
                    )
                    out = []

    kind = dict(rows.dtypes)["doc_id"]
    return rows.mapInArrow(
        run, f"doc_id {kind}, words array<string>, counts array<int>, before long, encoded long, total long"
    )


def recount(docs: DataFrame, edits: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, words, counts, before, encoded, total) of every row of ``docs`` (doc_id, text) after its ``edits``
    (doc_id, seq, start, stop, insert): the pre-tokens and their token counts, the tokens before, the pre-tokens
    encoded anew and the tokens now. The new text is the pre-tokens put together."""
    order = W.partitionBy("doc_id").orderBy("seq", "start", "stop", "insert")
    numbered = edits.where("doc_id is not null").withColumn("round", F.floor((F.row_number().over(order) - 1) / EDITS_PER_ROUND))
    numbered = materialize(numbered, "edits")
    rounds = (numbered.agg(F.max("round")).first()[0] or 0) + 1
    state = docs.select("doc_id", "text")
    for n in range(rounds):
        now = numbered.where(F.col("round") == n).groupBy("doc_id").agg(
            F.array_sort(F.collect_list(F.struct("seq", "start", "stop", "insert"))).alias("edits")
        )
        state = _apply(state.join(now.hint("shuffle_hash"), "doc_id", "left"), n == 0, path)
        if n + 1 < rounds:
            state = materialize(state, "recounted")
    return state


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document after three edits: a sixteenth of its length from the middle on is deleted, its doc_id is written
    in after a third, and its last character is replaced by an exclamation mark and a space."""
    docs = C.table(spark, sf_dir, "documents").select("doc_id", "text")
    size = F.length(F.coalesce("text", F.lit("")))
    after = size - (size / 2 + size / 16).cast("int") + (size / 2).cast("int")
    cut = F.struct(F.lit(1).alias("seq"), (size / 2).cast("int").alias("start"), (size / 2 + size / 16).cast("int").alias("stop"), F.lit("").alias("insert"))
    name = F.concat(F.lit(" "), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    put = F.struct(F.lit(2).alias("seq"), (after / 3).cast("int").alias("start"), (after / 3).cast("int").alias("stop"), name.alias("insert"))
    whole = after + F.length(name)
    close = F.struct(F.lit(3).alias("seq"), (whole - 1).alias("start"), whole.alias("stop"), F.lit("! ").alias("insert"))
    edits = docs.select("doc_id", F.explode(F.array(cut, put, close)).alias("e")).select("doc_id", "e.*")
    return recount(docs, edits).select(
        "doc_id", F.col("before").alias("n_tokens_before"), F.col("total").alias("n_tokens"), F.col("encoded").alias("n_encoded"),
        F.size("words").cast("long").alias("n_pretokens"),
    )
