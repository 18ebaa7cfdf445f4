"""The queries next to their SQL, and the pipeline stage by stage."""

from __future__ import annotations

import importlib

import pytest
from check_oracle import compare, connect
from pyspark.sql import functions as F

import corpus_pipeline
from cartwise.llm import op4_bpe, op6_language
from cartwise.llm.registry import ORACLE, QUERIES

SF_DIR = "/root/testdata/sf0.001"
ODD = "doc_id long, text string, lang string, source string, n_chars long, row string, quality_score double, ids binary, `key` string"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_its_sql(spark, con, name):
    assert compare(con, QUERIES[name](spark, SF_DIR), ORACLE[name]) is None


def test_every_operator_has_one_query():
    numbers = sorted(int(name[2:].split("_")[0]) for name in QUERIES)
    assert numbers == list(range(1, 14))


def test_entry_has_the_queries():
    entry = importlib.import_module("__spark_entry__")
    assert {"pipeline", *QUERIES} <= set(entry.queries())
    assert set(ORACLE) <= set(entry.oracle_sql())


def test_pipeline_stages(spark, tmp_path):
    """Each stage's decisions, from the queries' results over the same documents."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    kept, columns = docs, docs.columns
    seen = []
    for n, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = kept
        stage(spark, before, SF_DIR).write.parquet(f"{tmp_path}/{n}")
        kept = spark.read.parquet(f"{tmp_path}/{n}")
        seen.append({r[0] for r in kept.select("doc_id").collect()})
        if name == "quality classifier":
            want = QUERIES["op1_quality"](spark, SF_DIR).where("predicted = 1")
            assert seen[-1] == {r.doc_id for r in want.collect()} and len(seen[-1]) < docs.count()
        elif name == "language ID":
            found = op6_language.predict(before, op6_language.fit(before.where("crc32(cast(doc_id AS string)) % 4 <> 2")))
            assert seen[-1] == {r.doc_id for r in found.where("lang_pred <> 'und'").collect()}
        elif name == "n-gram Jaccard join":
            found = corpus_pipeline.jaccard.components(before).where("component_id = doc_id")
            assert seen[-1] == {r.doc_id for r in found.collect()} and len(seen[-1]) < len(seen[-2])
        elif name == "benchmark decontamination":
            judged = {r.doc_id for r in QUERIES["op3_decontaminate"](spark, SF_DIR).where("contaminated").collect()}
            assert seen[-1] == seen[-2] - judged
        else:
            assert seen[-1] == seen[-2]
            want = {r.doc_id: (r.n_tokens, r.ids_sha256) for r in op4_bpe.op4_bpe(spark, SF_DIR).collect()}
            assert all((r.n_tokens, r.ids_sha256) == want[r.doc_id] for r in kept.collect())
            assert kept.where(F.sha2(F.unbase64("ids_base64"), 256) != F.col("ids_sha256")).count() == 0
            continue
        assert kept.columns == columns


def test_stages_take_odd_documents(spark, make):
    rows = [(i, t, None, None, None, "r", 0.5, b"z", "k") for i, t in ((1, None), (2, ""), (None, "words of no id"), (3, "a plain text"), (3, "a plain text"))]
    docs = make(rows, ODD)
    for name, stage in corpus_pipeline.STAGES:
        for given in (docs, docs.limit(0)):
            found = stage(spark, given, SF_DIR)
            if name != "byte-level BPE":
                assert found.columns == docs.columns
            assert found.count() <= given.count()
    left = corpus_pipeline.ngram_jaccard_join(spark, docs, SF_DIR)
    assert sorted(r.doc_id or 0 for r in left.collect()) == [0, 1, 2, 3]


def test_run_is_the_stages_in_order(spark):
    found = corpus_pipeline.run(spark, SF_DIR)
    assert found.count() > 0 and [n for n, _ in corpus_pipeline.STAGES][0] == "quality classifier"


def test_language_stage_has_one_rule_for_all_lengths(spark, make):
    """A script that was not learnt is judged alike, short or long; texts without letters go."""
    learnt = [(i, "the quick brown fox jumps over the lazy dog and the cat " * 3, "en") for i in range(40)]
    odd = [(100, "\u0ba4\u0bae\u0bbf\u0bb4\u0bcd " * 25, None), (101, "\u0ba4\u0bae\u0bbf\u0bb4\u0bcd " * 50, None), (102, "12 34 ---" * 40, None), (103, "1", None)]
    kept = corpus_pipeline.language_id(spark, make(learnt + odd, "doc_id long, text string, lang string"), SF_DIR)
    assert {r.doc_id for r in kept.collect()} == {*range(40), 100, 101}


def test_join_stage_keeps_unlike_texts_under_one_id(spark, make):
    first = " ".join(f"a{i}" for i in range(30))
    second = " ".join(f"b{i}" for i in range(30))
    rows = [(1, first), (4, first), (4, second), (4, second), (5, f"{second} more"), (5, "wholly other words of five"), (6, ""), (6, None), (None, first)]
    kept = corpus_pipeline.ngram_jaccard_join(spark, make(rows, "doc_id long, text string"), SF_DIR)
    assert sorted(map(tuple, kept.collect()), key=str) == sorted(
        [(1, first), (4, second), (5, "wholly other words of five"), (6, ""), (6, None), (None, first)], key=str
    )
