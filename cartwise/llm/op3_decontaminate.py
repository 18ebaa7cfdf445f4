"""Benchmark decontamination by a distributed positional inverted index. DataFrame functions only.

Test items become windows of WINDOW words (a shorter item is one window). Terms of windows are counted in
the corpus; of each window the ANCHORS rarest terms stand for it, and a window with a term that the
corpus lacks is out. The index stores the postings (term, document, position) of those terms: a token's
posting is of use to a phrase query only if the term is asked for. Each posting, less the term's offset
in a window, is a possible start; starts on which all anchors of a window agree are the intersection.
Survivors are compared with the whole window, word by word.

Windows are as many as the benchmark's words; they are sent to all tasks if there are at most
BROADCAST_ROWS, and joined by shuffling otherwise.

Null and empty texts have no words and no hits. Items of null text or null id take no part; repeated items
count once. Repeated documents are judged alike, also under one doc_id with other texts: rows are told apart by
a hash of id and text. Other columns are not looked at, unless named in ``keep``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cartwise.llm import common as C
from cartwise.session import materialize

WINDOW = 13
ANCHORS = 3
BROADCAST_ROWS = 200_000
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    """The words of a text, A-Z lower-cased; none for a null."""
    words = F.filter(F.split(C.ascii_lower(text), NOT_WORD), lambda w: w != "")
    return F.coalesce(words, F.array().cast("array<string>"))


def _small(rows: DataFrame) -> DataFrame:
    """Marked for sending to all tasks if its counted rows are few enough."""
    return F.broadcast(rows) if rows.count() <= BROADCAST_ROWS else rows


def windows(benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """(win, words, items): the distinct windows and the ids of the items they occur in."""
    items = benchmark.where("item_id is not null").select("item_id", words_of(F.col("text")).alias("w")).where("size(w) > 0")
    many = F.transform(F.sequence(F.lit(1), F.size("w") - size + 1), lambda i: F.slice("w", i, size))
    each = items.select("item_id", F.explode(F.when(F.size("w") >= size, many).otherwise(F.array("w"))).alias("words"))
    found = each.groupBy("words").agg(F.collect_set(F.col("item_id").cast("string")).alias("items"))
    return materialize(found.select(F.monotonically_increasing_id().alias("win"), "words", "items"), "windows")


def postings(docs: DataFrame, terms: DataFrame | None = None) -> DataFrame:
    """(term, key, doc_id, pos): the index, stored; of the distinct ``terms`` (column ``term``), else of all."""
    unfolded = docs.select("doc_id", "key", F.posexplode(words_of(F.col("text"))).alias("pos", "term"))
    if terms is not None:
        unfolded = unfolded.join(_small(terms), "term")
    return materialize(unfolded.select("term", "key", "doc_id", "pos"), "postings")


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("key"))


def near(docs: DataFrame, first: str, second: str, distance: int) -> DataFrame:
    """Proximity: (doc_id, first_pos, second_pos) of all pairs of the two words at most ``distance`` words apart.

    Positions are dealt into stretches of ``distance``; a pair lies in one stretch or in neighbours.
    """
    terms = docs.sparkSession.createDataFrame([(t,) for t in {first, second}], "term string")
    index = postings(_keyed(docs), terms)
    stretch = F.floor(F.col("pos") / distance)
    a = index.where(F.col("term") == first).select(
        "key", "doc_id", F.col("pos").alias("first_pos"), F.explode(F.array(stretch - 1, stretch, stretch + 1)).alias("at")
    )
    b = index.where(F.col("term") == second).select("key", F.col("pos").alias("second_pos"), stretch.alias("at"))
    apart = F.abs(F.col("first_pos") - F.col("second_pos"))
    return a.join(b, ["key", "at"]).where((apart <= distance) & (apart > 0)).select("doc_id", "first_pos", "second_pos").distinct()


def phrases(docs: DataFrame, wins: DataFrame) -> DataFrame:
    """(key, doc_id, starts: array of (start, words, items)): where all anchors of a window agree."""
    unfolded = wins.select("win", F.posexplode("words").alias("offset", "term"))
    asked = unfolded.select("term").distinct()
    counted = docs.select(F.explode(words_of(F.col("text"))).alias("term")).join(_small(asked), "term")
    often = materialize(counted.groupBy("term").agg(F.count("*").alias("often")), "often")
    placed = unfolded.join(often, "term", "left").fillna(0, ["often"])
    rarest = W.partitionBy("win").orderBy("often", "offset")
    placed = placed.withColumns(
        {"place": F.row_number().over(rarest), "least": F.min("often").over(W.partitionBy("win"))}
    )
    anchors = materialize(placed.where(f"least > 0 and place <= {ANCHORS}").select("win", "term", "offset", "place"), "anchors")
    index = postings(docs, anchors.select("term").distinct())
    starts = index.join(_small(anchors), "term").select("key", "doc_id", "win", "place", (F.col("pos") - F.col("offset")).alias("start"))
    # Anchors are counted by their bits, not by postings: equal rows have one key and leave each posting several times.
    bits = F.bit_count(F.bit_or(F.expr("shiftleft(1L, place)")))
    agreed = starts.where("start >= 0").groupBy("key", "doc_id", "win", "start").agg(bits.alias("agreed"))
    needed = F.least(F.size("words"), F.lit(ANCHORS))
    agreed = agreed.join(_small(wins), "win").where(F.col("agreed") == needed)
    return agreed.groupBy("key", "doc_id").agg(F.collect_list(F.struct("start", "words", "items")).alias("starts"))


def overlaps(docs: DataFrame, benchmark: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep``, n_words, n_hit (words inside an occurrence of a window), items (sorted ids) and
    spans (start, length of the occurrences) of every document."""
    found = phrases(_keyed(docs), windows(benchmark)).select(
        F.col("key").alias("_key"), F.col("doc_id").alias("_doc"), F.col("starts").alias("_starts")
    )
    rows = docs.select(*keep, F.col("doc_id").alias("_id"), F.col("text").alias("_text"))
    rows = rows.withColumn("_own", F.xxhash64("_id", "_text"))
    same = (F.col("_own") == F.col("_key")) & F.col("_id").eqNullSafe(F.col("_doc"))
    joined = rows.join(found.hint("shuffle_hash"), same, "left").withColumn("_words", words_of(F.col("_text")))
    exact = F.filter(
        F.coalesce("_starts", F.array().cast(found.schema["_starts"].dataType)),
        lambda h: F.slice("_words", h.start + 1, F.size(h.words)) == h.words,
    )
    joined = joined.withColumn("_hits", exact)
    covered = F.array_distinct(F.flatten(F.transform("_hits", lambda h: F.sequence(h.start, h.start + F.size(h.words) - 1))))
    return joined.select(
        *keep,
        F.size("_words").cast("long").alias("n_words"),
        F.size(covered).cast("long").alias("n_hit"),
        F.array_sort(F.array_distinct(F.flatten(F.transform("_hits", lambda h: h["items"])))).alias("items"),
        F.transform("_hits", lambda h: F.struct(h.start.alias("start"), F.size(h.words).alias("length"))).alias("spans"),
    )


def is_contaminated() -> Column:
    """A hit, and at least a twentieth of the words hit."""
    return (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's overlap with the benchmark."""
    found = overlaps(C.table(spark, sf_dir, "documents"), C.table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        is_contaminated().alias("contaminated"),
    )


SQL = r"""
WITH words AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
items AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
wins AS (SELECT DISTINCT item_id, len(w) AS size, w AS win FROM items WHERE len(w) BETWEEN 1 AND 12
  UNION SELECT item_id, 13, w[i : i + 12] FROM (SELECT item_id, w, unnest(range(1, len(w) - 11)) AS i FROM items WHERE len(w) >= 13)),
sizes AS (SELECT DISTINCT size FROM wins),
spots AS (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM words, sizes WHERE len(w) >= size),
hits AS (SELECT s.doc_id, s.i, s.size, x.item_id FROM spots s JOIN wins x ON s.size = x.size AND s.w[s.i : s.i + s.size - 1] = x.win),
covered AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + size)) AS p FROM hits) GROUP BY doc_id),
found AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, list_sort(list_distinct(list(item_id::VARCHAR))) AS ids FROM hits GROUP BY doc_id)
SELECT w.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(array_to_string(ids, ','), '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM words w LEFT JOIN covered USING (doc_id) LEFT JOIN found USING (doc_id)
"""
