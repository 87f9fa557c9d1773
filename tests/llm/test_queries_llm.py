"""The registered queries against their SQL, and the pipeline against its stages in plain Python."""

from __future__ import annotations

import importlib.util
import os

import pytest

import corpus_pipeline
from pyspark.sql import functions as F
from compare import connect, difference
from roadtally.llm.queries import ORACLES, QUERIES
from test_searches import plain_components

SF_DIR = os.environ.get("SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no driver tables")


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, duck, name):
    got = QUERIES[name](spark, SF_DIR).toPandas()
    if name in ORACLES:
        assert difference(got, duck.sql(ORACLES[name]).df()) is None
    else:
        assert len(got) > 0


def test_base_columns_of_rules_and_licenses(spark, duck):
    from test_text_operators import plain_statistics, plain_words

    texts = dict(duck.sql("SELECT doc_id, text FROM documents").fetchall())
    for r in QUERIES["op1_quality_rules"](spark, SF_DIR).collect():
        counts = plain_statistics(texts[r["doc_id"]])
        assert tuple(r[1:6]) == counts
        assert r["base_failed"] == (counts[0] < 10 or 100 * counts[4] > 20 * counts[0])
        assert not (r["base_failed"] and r["kept"])
    for r in QUERIES["op7_license_scan"](spark, SF_DIR).collect():
        assert r["n_words"] == len(plain_words(texts[r["doc_id"]]))


def test_clean_documents_are_kept(spark, duck):
    labels = dict(duck.sql("SELECT doc_id, quality FROM labels").fetchall())
    for name in ("op1_quality_rules", "op4_quality_bayes"):
        rows = [r for r in QUERIES[name](spark, SF_DIR).collect() if labels.get(r["doc_id"]) == 1]
        lost = [r["doc_id"] for r in rows if not r["kept"] and not r.asDict().get("base_failed")]
        assert len(lost) <= 0.01 * len(rows), name


def test_known_bad_documents_are_rejected(spark, duck):
    labels = dict(duck.sql("SELECT doc_id, quality FROM labels").fetchall())
    rows = [r for r in QUERIES["op4_quality_bayes"](spark, SF_DIR).collect() if labels.get(r["doc_id"]) == 0]
    assert sum(not r["kept"] for r in rows) >= 0.98 * len(rows)


def test_pipeline_stages(spark, duck):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    left = {r["doc_id"]: r["text"] for r in docs.collect()}
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality_classifier", "quality_rules", "ngram_jaccard", "best_fit_packing"]
    verdicts = {r["doc_id"]: r["kept"] for r in QUERIES["op4_quality_bayes"](spark, SF_DIR).collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF_DIR)
        assert out.columns == docs.columns
        kept = {r["doc_id"]: r["text"] for r in out.collect()}
        assert kept.items() <= left.items()
        if name == "quality_classifier":
            assert set(kept) == {d for d in left if verdicts[d]}
        if name == "ngram_jaccard":
            found = plain_components(list(left.items()))
            assert set(kept) == {d for d, n, c in found if d == c or n == 0}
        left, docs = kept, out
    packed = corpus_pipeline.run(spark, SF_DIR).collect()
    assert {r["doc_id"] for r in packed} == set(left)


def test_one_of_each_class_stays(spark):
    text = " ".join(f"w{i}" for i in range(30))
    rows = [(3, text, "a"), (3, text, "b"), (5, text, "c"), (None, text, "d"), (8, "", "e"), (8, "", "e"), (9, None, "f")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _verdict string")
    out = sorted(map(tuple, corpus_pipeline.ngram_jaccard(spark, docs, SF_DIR).collect()), key=str)
    assert out == sorted([rows[0], *rows[3:]], key=str)


def test_rows_of_a_repeated_id_are_told_apart(spark):
    one, other = (" ".join(f"{c}{i}" for i in range(30)) for c in "xy")
    rows = [(3, one), (3, other), (4, one), (2, ""), (2, other), (None, one)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = sorted(map(tuple, corpus_pipeline.ngram_jaccard(spark, docs, SF_DIR).collect()), key=str)
    assert out == sorted([(3, one), (2, ""), (2, other), (None, one)], key=str)


def test_rejected_rows_go_by_id_and_text(spark):
    rows = [(1, "a", 1), (1, "b", 2), (None, "a", 3), (2, None, 4), (2, None, 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _key int").withColumn("_rejected_id", F.lit(0))
    gone = docs.where("_key in (1, 3, 4)").select(F.col("doc_id").alias("id"), F.xxhash64("text").alias("key"))
    out = corpus_pipeline._without(docs, gone)
    assert out.columns == docs.columns and [r["_key"] for r in out.collect()] == [2]
    assert corpus_pipeline._without(docs.limit(0), gone).isEmpty()


def test_the_rest_does_not_need_this_folder():
    assert importlib.util.find_spec("roadtally.plans.registry") is not None
    import roadtally

    base = os.path.dirname(roadtally.__file__)
    for folder, _, files in os.walk(base):
        if os.path.basename(folder) != "llm":
            for name in files:
                if name.endswith(".py"):
                    assert "roadtally.llm" not in open(f"{folder}/{name}").read(), name
