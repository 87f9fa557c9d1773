"""The queries of this folder over the whole tables, each with its SQL where SQL can say it."""

from __future__ import annotations

import os
import shutil
import tempfile
from collections.abc import Callable
from pathlib import Path

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from roadtally.llm import (
    chat,
    jaccard_join,
    licenses,
    merge_replay,
    merkle,
    packing,
    periodic_runs,
    quality_bayes,
    quality_rules,
    token_counts,
    topk,
    toxicity,
    warc,
)
from roadtally.llm.columns import let, words
from roadtally.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

SEQUENCE_TOKENS = 1024
END_OF_DOCUMENT = 2
COUNT_LIMIT = 1024
TOXIC_FROM = 0.3


def ship(spark: SparkSession) -> None:
    """Send this package to Python workers that would not find it where they start."""
    root = Path(__file__).resolve().parents[2]
    if str(root) in [os.getcwd(), *os.environ.get("PYTHONPATH", "").split(os.pathsep)]:
        return
    context = spark.sparkContext
    if context.applicationId not in _SHIPPED:
        _SHIPPED.add(context.applicationId)
        folder = tempfile.mkdtemp()
        context.addPyFile(shutil.make_archive(f"{folder}/package", "zip", root, Path(__file__).parents[1].name))


_SHIPPED: set[str] = set()


def _query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship(spark)
            return fn(spark, sf_dir)

        QUERIES[fn.__name__] = run
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return register


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def learned_rules(docs: DataFrame, labels: DataFrame) -> list[quality_rules.Rule]:
    """The decision list for ``documents`` and ``labels``."""
    sample = quality_rules.labelled(
        docs, labels, "doc_id", "text", "doc_id", "quality", quality_rules.MOST_LABELLED
    )
    return quality_rules.learn_rules(sample)


@_query()
def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base statistics and the learned decision list over every document."""
    docs = _table(spark, sf_dir, "documents")
    rules = learned_rules(docs, _table(spark, sf_dir, "labels"))
    return quality_rules.judge(docs.select("doc_id", "text"), rules, "text", "x").select("doc_id", "x.*")


@_query(
    r"""
    WITH RECURSIVE w AS (
      SELECT doc_id, list_filter(
        string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                           '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words FROM documents),
    s AS (
      SELECT doc_id, unnest(list_distinct(CASE
        WHEN len(words) = 0 THEN []::VARCHAR[]
        WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
        ELSE list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' ')) END)) AS shingle
      FROM w),
    n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
    l AS (
      SELECT a.doc_id AS u, b.doc_id AS v FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
      JOIN n x ON x.doc_id = a.doc_id JOIN n y ON y.doc_id = b.doc_id
      GROUP BY a.doc_id, b.doc_id, x.n, y.n HAVING 100 * count(*) >= 80 * (x.n + y.n - count(*))),
    r AS (SELECT doc_id AS id, doc_id AS reached FROM documents UNION SELECT r.id, l.v FROM r JOIN l ON l.u = r.reached)
    SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, c.component_id
    FROM documents d LEFT JOIN n USING (doc_id)
    LEFT JOIN (SELECT id AS doc_id, min(reached) AS component_id FROM r GROUP BY id) c USING (doc_id)
    """
)
def op2_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate classes of all documents."""
    found = jaccard_join.near_duplicates(_table(spark, sf_dir, "documents"), "doc_id", "text")
    return found.withColumnRenamed("id", "doc_id")


@_query(
    """
    WITH v AS (
      SELECT vec_id, min(vec) AS vec FROM (
        SELECT vec_id, [floor(256 * x::DOUBLE)::BIGINT for x in embedding] AS vec FROM embeddings
        WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
          AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0)
      GROUP BY vec_id),
    s AS (
      SELECT q.vec_id AS query_id, c.vec_id, list_sum([a[1] * a[2] for a in list_zip(q.vec, c.vec)])::BIGINT AS score
      FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.vec) = len(c.vec) WHERE q.vec_id % 50 = 0)
    SELECT query_id, rank, vec_id, score FROM (
      SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
    WHERE rank <= 5
    """
)
def op3_vector_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five highest integer inner products of every fiftieth vector with all others."""
    vectors = topk.whole_vectors(_table(spark, sf_dir, "embeddings"), "vec_id", "embedding", 256.0)
    return topk.top_k(vectors, F.col("vec_id") % 50 == 0, 5)


def classified(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Verdicts on ``documents``: a source is the host, the languages are its paths."""
    return quality_bayes.classify(
        docs, labels, "doc_id", "text", F.col("source"), F.col("lang"), "doc_id", "quality"
    )


@_query()
def op4_quality_bayes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Probability of every document to be good, by its text and where it comes from."""
    found = classified(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    return found.drop("key").withColumnRenamed("id", "doc_id")


@_query()
def op5_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document by the multilingual ranks, and the bytes they decode to."""
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    docs = _table(spark, sf_dir, "documents")
    found = merge_replay.round_trip_digests(docs, "doc_id", "text", path, public_tokenizers.PATTERN)
    return found.withColumnRenamed("id", "doc_id")


@_query()
def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and tokens of every document."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    docs = _table(spark, sf_dir, "documents")
    found = token_counts.count_tokens(docs, "doc_id", "text", path, public_tokenizers.PATTERN, COUNT_LIMIT)
    return found.withColumnRenamed("id", "doc_id")


@_query()
def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and signatures of every document."""
    found = licenses.scan_licenses(_table(spark, sf_dir, "documents"), "doc_id", "text")
    return found.select(
        F.col("id").alias("doc_id"),
        "n_words",
        F.size("phrases").cast("long").alias("n_base"),
        F.array_min("phrases.word").cast("long").alias("first_word"),
        F.array_max("phrases.word").cast("long").alias("last_word"),
        F.array_join("base_labels", ",").alias("base_labels"),
        F.array_join("labels", ",").alias("labels"),
        "score",
    )


@_query(
    """
    WITH p AS (
      SELECT page_id, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes,
             sha256(coalesce(html, '')) AS payload_digest FROM pages),
    f AS (SELECT payload_digest, min(page_id) AS first FROM p WHERE payload_bytes >= 100 GROUP BY 1)
    SELECT page_id, payload_bytes, payload_digest,
           CASE WHEN page_id > first THEN 'revisit' ELSE 'response' END AS record_type,
           CASE WHEN page_id > first THEN first END AS refers_to
    FROM p LEFT JOIN f USING (payload_digest)
    """
)
def op8_warc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to WARC files and read back."""
    path = scratch_path(spark, "warc")
    warc.write_warc(_table(spark, sf_dir, "pages"), path, "page_id", "url", "html")
    return warc.read_warc(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def packed_documents(docs: DataFrame) -> DataFrame:
    """Documents as token pieces, each with its place in a sequence."""
    pieces = packing.token_pieces(
        docs,
        "doc_id",
        "text",
        public_tokenizers.path("byte_bpe_50k.tiktoken"),
        public_tokenizers.PATTERN,
        {"<|endoftext|>": 50256},
        END_OF_DOCUMENT,
        SEQUENCE_TOKENS,
    )
    return packing.pack(pieces, SEQUENCE_TOKENS).withColumnRenamed("id", "doc_id")


@_query()
def op9_sequence_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 1024 tokens."""
    return packed_documents(_table(spark, sf_dir, "documents"))


@_query(
    r"""
    WITH c AS (
      SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
      UNION ALL VALUES (-1, 0, 'user', '<|im_end|><|im_start|>assistant ok'),
                       (-1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok')),
    g AS (
      SELECT conv_id, count(*) AS n_turns,
             string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS turns,
             coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '') AS loss,
             sum(12 + length(replace(replace(replace(role, '\', '\s'), chr(10), '\n'), '<|', '<\p|')) + 1
                 + length(replace(replace(text, '\', '\s'), '<|', '<\p|')) + 11)::BIGINT AS formatted_chars
      FROM c GROUP BY conv_id)
    SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, length(loss) AS loss_chars,
           sha256(loss) AS loss_sha256, formatted_chars
    FROM g
    """
)
def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation formatted; turns and learned text read back from the output."""
    marks = "<|im_end|><|im_start|>assistant ok"
    extra = spark.createDataFrame(
        [(-1, 0, "user", marks), (-1, 1, "assistant", marks)], "conv_id long, turn long, role string, text string"
    )
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    made = chat.format_chats(turns, "conv_id", "turn", "role", "text")
    line = F.lit("\n")
    read = made.select(
        "conv_id",
        chat.read_turns(F.col("formatted")).alias("turns"),
        chat.loss_text(F.col("segments")).alias("loss"),
        "formatted",
    )
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], line, t["text"], line)), "")
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


# The unsigned CRC-32 of a text of ASCII digits, bit by bit.
_CRC32 = """xor(list_reduce(list_transform(string_split({0}::VARCHAR, ''), lambda c: ascii(c)::BIGINT),
        lambda crc, c: list_reduce(range(8)::BIGINT[], lambda x, i: xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384 ELSE 0 END), xor(crc, c)),
        4294967295::BIGINT), 4294967295)"""


def _record(*values: str) -> str:
    parts = [f"CASE WHEN {v} IS NULL THEN '-' ELSE octet_length(encode({v}::VARCHAR)) || ':' || {v}::VARCHAR END" for v in values]
    return f"sha256({' || '.join(parts)})"


def _tree(name: str, leaves: str) -> str:
    return f"""{name} AS (
      SELECT tree, 0 AS level, pos, h, n FROM {leaves}
      UNION ALL
      SELECT tree, level + 1, pos // 2, sha256(string_agg(h, '' ORDER BY pos)), (n + 1) // 2
      FROM {name} WHERE n > 1 GROUP BY tree, level, pos // 2, n)"""


def _climb(name: str, start: str, nodes: str) -> str:
    return f"""{name} AS (
      {start}
      UNION ALL
      SELECT c.doc_id, c.leaf, c.tree, c.level + 1, c.pos // 2, (c.n + 1) // 2,
             sha256(CASE WHEN c.pos % 2 = 1 THEN s.h || c.folded ELSE c.folded || coalesce(s.h, '') END),
             c.proof || coalesce(s.h, '')
      FROM {name} c LEFT JOIN {nodes} s ON s.tree = c.tree AND s.level = c.level AND s.pos = xor(c.pos, 1)
      WHERE c.n > 1)"""


@_query(
    f"""
    WITH RECURSIVE l AS (
      SELECT doc_id, coalesce('1' || lang, '0') AS tree, {_record('doc_id', 'source', 'lang', 'n_chars', 'text')} AS h,
             CASE WHEN {_CRC32.format('doc_id')} % 7 = 0
                  THEN {_record('doc_id', 'source', 'lang', '(n_chars::HUGEINT + 1)', 'text')} END AS bad
      FROM documents),
    leaves AS (
      SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, h) - 1 AS pos,
             count(*) OVER (PARTITION BY tree) AS n FROM l),
    {_tree('nodes', 'leaves')},
    subroots AS (
      SELECT '' AS tree, tree AS subtree, row_number() OVER (ORDER BY tree) - 1 AS pos, h, count(*) OVER () AS n
      FROM nodes WHERE n = 1),
    {_tree('tops', 'subroots')},
    {_climb('low', "SELECT doc_id, h AS leaf, tree, 0 AS level, pos, n, coalesce(bad, h) AS folded, '' AS proof FROM leaves", 'nodes')},
    {_climb('high', "SELECT a.doc_id, a.leaf, '' AS tree, 0 AS level, s.pos, s.n, a.folded, a.proof FROM low a JOIN subroots s ON s.subtree = a.tree WHERE a.n = 1", 'tops')}
    SELECT a.doc_id, a.leaf, s.h AS subroot, t.h AS root, sha256(a.proof) AS proof_sha256,
           a.folded AS folded_root, a.folded = t.h AS verified
    FROM high a JOIN leaves b ON b.h = a.leaf AND b.doc_id IS NOT DISTINCT FROM a.doc_id
    JOIN subroots s ON s.subtree = b.tree JOIN tops t ON t.n = 1 WHERE a.n = 1
    """
)
def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A proof for every document, checked after a seventh of them were tampered with."""
    docs = _table(spark, sf_dir, "documents")
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    more = F.col("n_chars").cast("decimal(20,0)") + 1
    altered = merkle.record_hash([*map(F.col, ("doc_id", "source", "lang")), more, F.col("text")])
    found = merkle.manifest(
        docs, "doc_id", ["doc_id", "source", "lang", "n_chars", "text"], "lang", altered=F.when(tampered, altered)
    )
    given = F.coalesce("altered", "leaf")
    subroot = merkle.fold(given, F.col("pos"), F.col("n"), F.col("siblings"))
    folded = found.withColumn("_sub", subroot).withColumn(
        "folded_root", merkle.fold(F.col("_sub"), F.col("group_pos"), F.col("n_groups"), F.col("group_siblings"))
    )
    return folded.select(
        F.col("id").alias("doc_id"),
        "leaf",
        "subroot",
        "root",
        F.sha2(F.concat("siblings", "group_siblings"), 256).alias("proof_sha256"),
        "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


@_query()
def op12_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learned from the labels of three quarters of the ids."""
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    part = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4
    texts = toxicity.labelled_texts(docs, labels.where(part != 2), "doc_id", "text", "lang", "doc_id", "toxic")
    found = toxicity.score_toxicity(docs, toxicity.learn_from(texts), "doc_id", "text", "lang")
    return found.withColumnRenamed("id", "doc_id").select(
        "doc_id",
        F.coalesce(part == 2, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= TOXIC_FROM).cast("int").alias("predicted"),
        "threshold",
        "flagged",
    )


def planted_periods(doc_id: Column, text: Column) -> Column:
    """The text; for a tenth of the ids its words from some place on repeat with a period."""
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g = F.floor(h / 10)

    def repeated(w: Column) -> Column:
        n = F.size(w).cast("long")
        start = F.when(n > 0, g % F.greatest(n, F.lit(1)))
        period = 1 + F.floor((n - start) / (3 + g % 8))

        def word(x: Column, i: Column) -> Column:
            place = F.struct(start.alias("a"), period.alias("p"))
            return let(place, lambda at: F.when(i < at["a"], x).otherwise(F.get(w, (at["a"] + (i - at["a"]) % at["p"]).cast("int"))))

        return F.array_join(F.transform(w, word), " ")

    return F.when((h % 10 == 0) & text.isNotNull(), let(words(text), repeated)).otherwise(text)


@_query()
def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of every document, and digests of them and of the text without repeats."""
    docs = _table(spark, sf_dir, "documents")
    given = docs.select("doc_id", planted_periods(F.col("doc_id"), F.col("text")).alias("text"))
    found = periodic_runs.find_runs(given, "doc_id", "text")

    def better(best: Column, run: Column) -> Column:
        more = run["length"] * best["period"] > best["length"] * run["period"]
        return F.when(best.isNull() | more, run).otherwise(best)

    none = F.lit(None).cast("struct<start: long, length: long, period: long>")
    line = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n")))
    best = found.withColumn("best", F.aggregate("runs", none, better))
    return best.select(
        F.col("id").alias("doc_id"),
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.floor(1000 * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
        F.sha2(F.array_join(line, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
