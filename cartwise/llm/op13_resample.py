"""Importance resampling towards a target distribution, with line deduplication.

Features are runs of ``low`` to ``high`` consecutive words, hashed into ``buckets``. A bucket's gain
is the log ratio of its smoothed shares in the target and in the corpus; a document's weight is the
mean gain of its features; documents are drawn without replacement by the highest weight plus a
Gumbel number that follows from seed and id.

Newlines separate words, so they cut a text into lines without cutting a word. Equal lines of the
corpus are one row of a line table, with their occurrences: words are split and hashed once for each
distinct line, its counts are multiplied by the occurrences, and its gain is summed once and looked
up by all its documents. Runs that reach over a line's end (``high`` > 1) are made for each document
from the words beside its line ends and are added to both.

Everything shuffled is combined before: lines by text, counts by bucket. A line that more than
1/``SHARES`` of all lines are (fewer than ``SHARES`` lines) is broadcast with its gain to the documents.
The drawn documents are ordered by counts of equal scores, not by one sort in one task: scores are
whole numbers of at most SCORES different values, whatever the corpus.

A null text has no words: no features, weight 0. A null id is drawn with an empty id in the hash,
after others of its score. Rows that repeat an id are documents each; rows of equal id and score
follow each other by n_features, then weight. An empty target or corpus counts 0. An empty table
gives no rows. Other columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cartwise.functions.joins import SHARES, lookup_join
from cartwise.llm import common as C
from cartwise.session import materialize

#: What parts words, after A-Z are lower-cased.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: |gain| < 1000 ln(2^63 * 2^63) and a Gumbel number of 32 bits is between -3,200 and 23,000.
SCORES = 300_000
#: Rows of one key that a step of the last unfolding makes at once.
STEP = 65_536


def words_of(text: Column) -> Column:
    return F.filter(F.split(C.ascii_lower(text), BETWEEN, -1), lambda w: w != "")


def _bucket(feature: Column, buckets: int) -> Column:
    return (F.crc32(feature.cast("binary")) % buckets).cast("int")


def _joined(kinds: list[Column]) -> Column:
    return kinds[0] if len(kinds) == 1 else F.concat(*kinds)


def _slices(items: Column, k: int) -> Column:
    """All runs of ``k`` neighbours."""
    starts = F.when(F.size(items) >= k, F.sequence(F.lit(1), F.size(items) - (k - 1))).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.slice(items, i, k))


def _runs(words: Column, low: int, high: int, buckets: int) -> Column:
    """The buckets of all runs of ``low`` to ``high`` words."""

    def kind(k: int) -> Column:
        if k == 1:
            return F.transform(words, lambda w: _bucket(w, buckets))
        return F.transform(_slices(words, k), lambda r: _bucket(F.array_join(r, " "), buckets))

    return _joined([kind(k) for k in range(low, high + 1)])


def _seams(text: Column, low: int, high: int, buckets: int) -> Column:
    """The buckets of the runs that reach over a line's end.

    Of each line only the first and last ``high`` - 1 words take part, with a null between
    them that no run crosses; shorter lines take part whole.
    """
    edge = high - 1

    def near_ends(words: Column, line: Column) -> Column:
        gap = F.array(F.lit(None).cast("string"))
        kept = F.when(F.size(words) <= 2 * edge, words).otherwise(F.concat(F.slice(words, 1, edge), gap, F.slice(words, -edge, edge)))
        return F.transform(kept, lambda w: F.struct(line.alias("line"), w.alias("word")))

    def kind(words: Column, k: int) -> Column:
        def over(run: Column) -> Column:
            apart = F.get(run, 0)["line"] != F.get(run, k - 1)["line"]
            return apart & F.forall(run, lambda x: x["word"].isNotNull())

        def hashed(run: Column) -> Column:
            return _bucket(F.array_join(F.transform(run, lambda x: x["word"]), " "), buckets)

        return F.transform(F.filter(_slices(words, k), over), hashed)

    lines = F.filter(F.transform(F.split(text, "\n", -1), words_of), lambda w: F.size(w) > 0)
    words = F.flatten(F.transform(lines, near_ends))
    # The words are one cell of an array, so that they are made once for all kinds of runs.
    return F.flatten(F.transform(F.array(words), lambda w: _joined([kind(w, k) for k in range(max(low, 2), high + 1)])))


def _keys(line: Column) -> list[Column]:
    """128 bits that stand for a line."""
    return [F.xxhash64(line).alias("h1"), F.xxhash64(F.lit(1), line).alias("h2")]


def line_table(texts: DataFrame, low: int = 1, high: int = 1, buckets: int = 10_000) -> DataFrame:
    """(h1, h2, n_times, n_words, found): one row for each distinct line, stored.

    ``found`` lists the buckets of its runs, repeats included.
    """
    lines = texts.select(F.explode(F.split("text", "\n", -1)).alias("line")).where("line <> ''")
    distinct = lines.groupBy("line").agg(F.count(F.lit(1)).alias("n_times"))
    split = distinct.select(*_keys(F.col("line")), "n_times", words_of(F.col("line")).alias("words"))
    # The words are split in a step of their own, not once for each use.
    return materialize(
        split.select("h1", "h2", "n_times", F.size("words").alias("n_words"), _runs(F.col("words"), low, high, buckets).alias("found")), "lines"
    )


def _seam_table(texts: DataFrame, low: int, high: int, buckets: int) -> DataFrame:
    return texts.where(F.contains("text", F.lit("\n"))).select(_seams(F.col("text"), low, high, buckets).alias("found"))


def bucket_counts(lines: DataFrame, seams: DataFrame | None = None) -> DataFrame:
    """(bucket, n): the features of all texts by bucket; ``seams`` has a list ``found`` for each text."""
    each = lines.select(F.explode("found").alias("bucket"), "n_times")
    if seams is not None:
        each = each.unionByName(seams.select(F.explode("found").alias("bucket"), F.lit(1).cast("long").alias("n_times")))
    return each.groupBy("bucket").agg(F.sum("n_times").alias("n"))


def gains(corpus: DataFrame, target: DataFrame, buckets: int = 10_000) -> list[int]:
    """floor(1000 ln) of each bucket's share in the target over its share in the corpus.

    ``corpus`` and ``target`` are as of ``bucket_counts``. One whole number for each bucket
    comes to the driver, however large the corpus.
    """
    corpus, target = corpus.withColumnRenamed("n", "s"), target.withColumnRenamed("n", "t")
    spark = corpus.sparkSession
    joined = spark.range(buckets).select(F.col("id").cast("int").alias("bucket")).join(corpus, "bucket", "left").join(target, "bucket", "left")
    counts = materialize(joined.select("bucket", *[F.coalesce(c, F.lit(0)).cast("double").alias(c) for c in "st"]), "counts")
    of_corpus, of_target = (counts.agg(F.sum(c)).scalar() for c in "st")
    ratio = (F.col("t") + 1) * (of_corpus + buckets) / ((F.col("s") + 1) * (of_target + buckets))
    rows = counts.select("bucket", F.floor(1000 * F.ln(ratio)).alias("gain")).collect()
    out = [0] * buckets
    for r in rows:
        out[r.bucket] = r.gain
    return out


def _gain_sum(found: Column, of_bucket: list[int]) -> Column:
    """The sum of the gains of a list of buckets."""
    value = F.from_json(F.lit(str(of_bucket)), "array<bigint>")
    return F.aggregate(found, F.lit(0).cast("long"), lambda total, b: total + F.get(value, b))


def document_weights(
    docs: DataFrame, target: DataFrame, low: int = 1, high: int = 1, buckets: int = 10_000, shares: int = SHARES
) -> DataFrame:
    """(doc_id, n_words, n_features, weight): one row for each row of ``docs``, stored."""
    described = [F.monotonically_increasing_id().alias("row"), "doc_id"]
    hashes = F.transform(F.filter(F.split("text", "\n", -1), lambda x: x != ""), lambda x: F.struct(*_keys(x)))
    seams = [_seams(F.col("text"), low, high, buckets).alias("found")] if high > 1 else []
    texts = materialize(docs.select(*described, hashes.alias("lines"), *seams), "texts")
    lines = line_table(docs, low, high, buckets)
    over = texts.select("found") if high > 1 else None
    of_target = bucket_counts(line_table(target, low, high, buckets), _seam_table(target, low, high, buckets) if high > 1 else None)
    gain = gains(bucket_counts(lines, over), of_target, buckets)

    known = lines.select(
        "h1", "h2", F.col("n_words").cast("long").alias("n_words"), F.size("found").cast("long").alias("n"), _gain_sum(F.col("found"), gain).alias("gain")
    )
    total = lines.agg(F.sum("n_times")).scalar()
    hot = lines.where(F.col("n_times") * shares > total).select("h1", "h2")
    # The outer form keeps documents without lines; their null key meets nothing.
    places = texts.select("row", "doc_id", F.posexplode_outer("lines").alias("at", "line")).select(
        "row", "doc_id", "at", F.col("line.h1").alias("h1"), F.col("line.h2").alias("h2")
    )
    met = lookup_join(places, known, ["h1", "h2"], ["row", "at"], hot=hot)
    sums = met.groupBy("row", "doc_id").agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("n_words", "n", "gain")])
    if high > 1:
        more = texts.where(F.size("found") > 0).select("row", F.size("found").alias("more"), _gain_sum(F.col("found"), gain).alias("more_gain"))
        sums = sums.join(more, "row", "left").withColumns(
            {"n": F.col("n") + F.coalesce("more", F.lit(0)), "gain": F.col("gain") + F.coalesce("more_gain", F.lit(0))}
        )
    # Whole numbers: the remainder of a positive divisor gives the floor without doubles.
    floored = F.expr("if(n > 0, (gain - pmod(gain, n)) div n, 0L)")
    return materialize(sums.select("doc_id", "n_words", F.col("n").alias("n_features"), floored.alias("weight")), "weights")


def gumbel(doc_id: Column, seed: int) -> Column:
    """floor(-1000 ln(-ln u)) for u in (0, 1), from the first 32 bits of sha256 of seed and id."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.ln(-F.ln((h + 0.5) / 4294967296.0)))


def resample(
    docs: DataFrame,
    target: DataFrame,
    low: int = 1,
    high: int = 1,
    buckets: int = 10_000,
    least_words: int = 20,
    percent: int = 10,
    seed: int = 2024,
) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score, rank), rank null where a document is not drawn.

    Of the N documents with at least ``least_words`` words, floor(percent * N / 100) are drawn.
    """
    weights = document_weights(docs, target, low, high, buckets)
    scored = weights.withColumn("score", F.col("weight") + gumbel(F.col("doc_id"), seed))
    fit = F.col("n_words") >= least_words
    counts = scored.where(fit).groupBy("score").agg(F.count(F.lit(1)).alias("equal"))
    # One row for each different score: at most SCORES in all.
    before = F.coalesce(F.sum("equal").over(W.orderBy(F.desc("score")).rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    places = materialize(counts.withColumn("before", before), "scores")
    drawn = int((places.agg(F.sum("equal")).first()[0] or 0) * percent // 100)
    reached = F.broadcast(places.where(F.col("before") < drawn).select("score", "before"))
    placed = scored.join(reached, "score", "left").withColumn("before", F.when(fit, F.col("before")))

    columns = ["doc_id", "n_words", "n_features", "weight", "score"]
    # Equal rows are one row with their number; they are told apart by nothing but their rank.
    same = placed.where(F.col("before").isNotNull()).groupBy(*columns, "before").agg(F.count(F.lit(1)).alias("copies"))
    order = W.partitionBy("score").orderBy(F.asc_nulls_last("doc_id"), "n_features", "weight", "n_words")
    start = F.col("before") + F.sum("copies").over(order.rowsBetween(W.unboundedPreceding, W.currentRow)) - F.col("copies")
    block = same.withColumn("start", start).withColumn("at", F.explode(F.expr(f"sequence(0L, copies - 1, {STEP}L)")))
    one = block.withColumn("at", F.explode(F.expr(f"sequence(at, least(at + {STEP} - 1, copies - 1))")))
    rank = F.col("start") + F.col("at") + 1
    ranked = one.select(*columns, F.when(rank <= drawn, rank).alias("rank"))
    rest = placed.where(F.col("before").isNull()).select(*columns, F.lit(None).cast("long").alias("rank"))
    return ranked.unionByName(rest)


def drawn_documents(docs: DataFrame, resampled: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, whose id was drawn."""
    return docs.join(resampled.where(F.col("rank").isNotNull()).select("doc_id"), "doc_id", "left_semi")


def op13_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's place in a draw of a tenth, towards the benchmark's words."""
    found = resample(C.table(spark, sf_dir, "documents"), C.table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_features", "weight", "score", "rank")


# crc32 by its table of 256 entries, which is worked out from the polynomial; of distinct words only.
SQL = r"""
WITH RECURSIVE divide AS (SELECT i AS i, i AS c, 0 AS n FROM (SELECT unnest(range(256))::BIGINT AS i)
  UNION ALL SELECT i, CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, n + 1 FROM divide WHERE n < 8),
crc AS (SELECT list(c ORDER BY i) AS v FROM divide WHERE n = 8),
texts AS (SELECT 'd' AS kind, row_number() OVER () AS row, doc_id, text FROM documents
  UNION ALL SELECT 'b', row_number() OVER (), NULL, text FROM benchmark),
split AS MATERIALIZED (SELECT kind, row, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM texts WHERE text IS NOT NULL),
words AS MATERIALIZED (SELECT kind, row, unnest(w) AS word FROM split),
hexed AS (SELECT word, hex(encode(word)) AS x FROM (SELECT DISTINCT word FROM words)),
coded AS MATERIALIZED (SELECT word, xor(list_reduce(list_transform(range(0, len(x) // 2), lambda i: ('0x' || substr(x, (2 * i + 1)::INT, 2))::BIGINT),
  lambda c, b: xor(v[(xor(c, b) & 255) + 1], c // 256), 4294967295), 4294967295) % 10000 AS bucket FROM hexed, crc),
found AS MATERIALIZED (SELECT kind, row, bucket FROM words JOIN coded USING (word)),
sums AS (SELECT b.bucket, count(*) FILTER (kind = 'd')::DOUBLE AS s, count(*) FILTER (kind = 'b')::DOUBLE AS t FROM found b GROUP BY b.bucket),
whole AS (SELECT coalesce(sum(s), 0) AS ss, coalesce(sum(t), 0) AS tt FROM sums),
gain AS (SELECT bucket, floor(1000 * ln((t + 1) * (ss + 10000) / ((s + 1) * (tt + 10000))))::BIGINT AS gain FROM sums, whole),
weights AS (SELECT row, count(*) AS n, floor(sum(gain) / count(*))::BIGINT AS weight FROM found JOIN gain USING (bucket) WHERE kind = 'd' GROUP BY row),
scored AS (SELECT doc_id, coalesce(n, 0)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight, (coalesce(weight, 0)
  + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296))))::BIGINT AS score
  FROM texts LEFT JOIN weights USING (row) WHERE kind = 'd'),
ranked AS (SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id NULLS LAST, n_features, weight) AS place,
  count(*) FILTER (n_features >= 20) OVER () AS n FROM scored)
SELECT doc_id, n_features, weight, score, CASE WHEN n_features >= 20 AND place <= 10 * n // 100 THEN place END AS rank FROM ranked
"""
