"""The corpus pipeline: documents in, token ids out.

Each stage takes (spark, docs, sf_dir) and gives a frame that is written and read again as the next stage's
documents. All but the last return the columns of the documents they got. Columns are carried whole, whatever
their names; doc_id and text are looked at, and lang where languages are learnt.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwise.llm import common as C
from cartwise.llm import op1_quality as quality
from cartwise.llm import op3_decontaminate as decontaminate
from cartwise.llm import op4_bpe as bpe
from cartwise.llm import op6_language as language
from cartwise.llm import op7_jaccard_join as jaccard
from cartwise.session import materialize


def _packed(docs: DataFrame) -> DataFrame:
    """The rows as one column, beside the two that operators look at."""
    return docs.select(F.struct(*(docs[c] for c in docs.columns)).alias("row"), "doc_id", "text")


def _where(docs: DataFrame, decision: Column) -> DataFrame:
    """The rows of which the decision is true. Their columns may have any names."""
    return docs.select(F.struct(*(docs[c] for c in docs.columns)).alias("row"), decision.alias("kept")).where("kept").select("row.*")


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents with a quality score of THRESHOLD or more."""
    labels = C.table(spark, sf_dir, "labels").where(C.fold_of(F.col("doc_id"), 5) != 0)
    scored = quality.score_of(docs["text"], quality.fit(docs, labels))
    return _where(docs, scored >= quality.THRESHOLD)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents that are in one of the languages learnt from the documents; texts without
    letters go. A text of any length has the learnt language that it is most like."""
    C.ship(spark)
    learnt = language.fit(docs.where(C.fold_of(F.col("doc_id"), 4) != 2))
    return _where(docs, language.language_of(docs["text"], learnt) != "und")


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each class of near-duplicates: that of the smallest id, of several texts under
    it that of the smallest digest. Of rows with equal id and text one is kept. Documents without words
    are in no class and stay, as do those without an id."""
    C.ship(spark)
    named = docs.where("doc_id is not null")
    found = jaccard.components(named, with_classes=True)
    one = F.min(F.struct("doc_id", "node", "key")).alias("one")
    first = found.where("n_shingles > 0").groupBy("class").agg(one).select("one.doc_id", "one.key")
    empty = found.where("n_shingles = 0").select("doc_id", "key").distinct()
    rows = _packed(docs).withColumn("key", F.xxhash64("text"))
    kept = rows.where("doc_id is not null").join(first.unionByName(empty), ["doc_id", "key"], "left_semi").dropDuplicates(["doc_id", "key"])
    return kept.select("row").unionByName(rows.where("doc_id is null").select("row")).select("row.*")


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the contaminated documents."""
    found = decontaminate.overlaps(_packed(docs), C.table(spark, sf_dir, "benchmark"), keep=("row",))
    return found.where(~decontaminate.is_contaminated()).select("row.*")


def byte_level_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document's token ids (base64 of little-endian 32-bit integers), their number, and digests of
    the ids and of the bytes that they decode to."""
    C.ship(spark)
    found = bpe.encode(docs, keep=("doc_id",), decoded=True)
    return found.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.base64("ids").alias("ids_base64"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("quality classifier", quality_classifier),
    ("language ID", language_id),
    ("n-gram Jaccard join", ngram_jaccard_join),
    ("benchmark decontamination", benchmark_decontamination),
    ("byte-level BPE", byte_level_bpe),
]

#: Rows that a Python worker holds at once: workers of all stages stand beside the executor's heap.
BATCH_ROWS = 1000

#: Classifiers and byte-pair merges have no SQL; tests hold each stage against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, from ``documents`` on."""
    docs = C.table(spark, sf_dir, "documents")
    with C.batches_of(spark, BATCH_ROWS):
        for name, stage in STAGES:
            docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
