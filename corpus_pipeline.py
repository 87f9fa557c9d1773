"""Documents to packed training sequences: classify, judge, remove near copies, pack.

Each stage is a function of (spark, docs, sf_dir) and works on all rows of ``docs``. All but the
last return the columns of ``docs``; the last returns token pieces with their places.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from roadtally.llm import queries as llm
from roadtally.llm.columns import unused
from roadtally.llm.jaccard_join import near_duplicates
from roadtally.llm.quality_rules import judge
from roadtally.session import broadcast_if_small, cut_lineage, scratch_path


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def _without(docs: DataFrame, rejected: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose ``doc_id`` and hashed text are no row ``id, key`` of ``rejected``.

    Rejected rows are stored without texts and broadcast where they are shown to be few; beyond
    that the texts are joined by a shuffle. A null id equals a null id.
    """
    key, other_id, other_key = (unused(docs, name) for name in ("_text_key", "_rejected_id", "_rejected_key"))
    gone = broadcast_if_small(rejected.select(F.col("id").alias(other_id), F.col("key").alias(other_key)).distinct())
    same = F.col("doc_id").eqNullSafe(F.col(other_id)) & (F.col(key) == F.col(other_key))
    return docs.withColumn(key, F.xxhash64("text")).join(gone, same, "left_anti").select(*docs.columns)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject.

    Null and empty texts are classified like any other; rows of one id and text share a verdict;
    an empty table gives an empty one, and without labels of both kinds everything stays. Columns
    may have any names and types beside those of ``documents``.
    """
    llm.ship(spark)
    verdicts = llm.classified(docs, _labels(spark, sf_dir))
    return _without(docs, verdicts.where(~F.col("kept")).select("id", "key"))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base checks and that no learned rule rejects.

    Verdicts are stored before they filter: a filter on them would be pushed below the statistics
    and compute these again for every condition. A null or empty text fails the base checks; rows
    of one id and text share a verdict; an empty table gives an empty one.
    """
    llm.ship(spark)
    rules = llm.learned_rules(docs, _labels(spark, sf_dir))
    texts = docs.select(F.col("doc_id").alias("id"), "text")
    verdicts = judge(texts, rules, "text", "verdict").select("id", F.xxhash64("text").alias("key"), "verdict.kept")
    return _without(docs, cut_lineage(verdicts).where(~F.col("kept")))


def ngram_jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of smallest id of each class of near copies, and all that have none.

    A row without id or without words stays. Where ids repeat, rows are told apart by a number of
    their own, so that rows of one id whose texts differ are no copies of each other; of copies
    that share the smallest id the one first read stays. An empty table gives an empty one.
    """
    llm.ship(spark)
    named = docs.where(F.col("doc_id").isNotNull())
    if not named.groupBy("doc_id").count().where("count > 1").isEmpty():
        return _one_of_each(spark, docs)
    found = near_duplicates(named, "doc_id", "text")
    copies = found.where((F.col("n_shingles") > 0) & (F.col("component_id") < F.col("id")))
    gone = broadcast_if_small(copies.select(F.col("id").alias("doc_id")))
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def _one_of_each(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """:func:`ngram_jaccard` of rows that need numbers, as their ids repeat."""
    row = unused(docs, "_row")
    path = scratch_path(spark, "numbered")
    docs.withColumn(row, F.monotonically_increasing_id()).write.parquet(path)
    numbered = spark.read.parquet(path)
    named = numbered.where(F.col("doc_id").isNotNull())
    found = near_duplicates(named, row, "text").where(F.col("n_shingles") > 0)
    ids = found.join(named.select(F.col(row).alias("id"), "doc_id"), "id")
    ids = cut_lineage(ids.select("component_id", F.struct("doc_id", "id").alias("who")))
    first = ids.groupBy("component_id").agg(F.min("who").alias("first"))
    gone = ids.join(first, "component_id").where("who != first").select(F.col("who.id").alias(row))
    return numbered.join(broadcast_if_small(gone), row, "left_anti").select(*docs.columns)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of all documents, each with its sequence and offset.

    A null text counts as empty and gives one piece, the end mark; null and repeated ids come out
    as they are, one set of pieces for each row; an empty table gives no pieces.
    """
    llm.ship(spark)
    return llm.packed_documents(docs)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("quality_rules", quality_rules),
    ("ngram_jaccard", ngram_jaccard),
    ("best_fit_packing", best_fit_packing),
]

# A learned classifier and a tokenizer are beyond SQL; tests/llm compares run() with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again before the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
