"""Merkle manifests, the toxicity network and periodic runs against plain Python."""

from __future__ import annotations

import hashlib
import os
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from roadtally.llm import merkle, periodic_runs, toxicity
from roadtally.llm.grammar import Grammar
from roadtally.llm.queries import QUERIES

SF_DIR = os.environ.get("SF_DIR", "/root/testdata/sf0.001")
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def plain_record(*values) -> str:
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def plain_paths(hashes: list[str]) -> tuple[str, list[list[str]]]:
    """Root, and for each leaf its siblings from below."""
    at, siblings, level = list(range(len(hashes))), [[] for _ in hashes], hashes
    while len(level) > 1:
        for leaf, i in enumerate(at):
            if i ^ 1 < len(level):
                siblings[leaf].append(level[i ^ 1])
        level = [sha("".join(level[i : i + 2])) for i in range(0, len(level), 2)]
        at = [i // 2 for i in at]
    return level[0], siblings


def plain_manifest(rows: list[tuple]) -> list[tuple]:
    """``id, leaf, subroot, root, siblings`` of rows ``doc_id, text, lang, source, n_chars``."""
    groups: dict = {}
    for d, text, lang, source, n in rows:
        groups.setdefault((lang is not None, (lang or "").encode()), []).append((d is not None, d or 0, plain_record(d, source, lang, n, text), d))
    order = sorted(groups)
    trees = [(sorted(groups[k]), *plain_paths([x[2] for x in sorted(groups[k])])) for k in order]
    root, tops = plain_paths([t[1] for t in trees]) if trees else (None, [])
    return [(x[3], x[2], t[1], root, "".join(own + top)) for t, top in zip(trees, tops) for x, own in zip(t[0], t[2])]


def made_manifest(spark, rows: list[tuple]) -> list[tuple]:
    docs = spark.createDataFrame(rows, SCHEMA).withColumn("tree", F.lit(1)).withColumn("pos", F.lit("x")).withColumn("_level", F.lit(2))
    found = merkle.manifest(docs, "doc_id", FIELDS, "lang").withColumn("s", F.concat("siblings", "group_siblings"))
    low = merkle.fold(F.col("leaf"), F.col("pos"), F.col("n"), F.col("siblings"))
    found = found.withColumn("low", low)
    high = merkle.fold(F.col("low"), F.col("group_pos"), F.col("n_groups"), F.col("group_siblings"))
    out = found.select("id", "leaf", "subroot", "root", "s", (high == F.col("root")).alias("ok")).collect()
    assert all(r["ok"] for r in out)
    return [tuple(r)[:5] for r in out]


def by_text(rows: list[tuple]) -> list[tuple]:
    return sorted(rows, key=str)


def test_manifest_of_groups_of_all_sizes(spark):
    rnd = random.Random(1)
    rows = [(rnd.randrange(10**6), f"t{i}", f"l{g}", None if i % 3 else "s", i) for g in range(1, 12) for i in range(g)]
    rows += [(i, None, "big", "", None) for i in range(2100)]
    rows += [(None, "", None, None, None), (None, "", None, None, None), (7, "é", None, "é", -1), (7, "é", None, "é", -1), (3, "x", "", "", 0)]
    assert by_text(made_manifest(spark, rows)) == by_text(plain_manifest(rows))


@pytest.mark.parametrize("rows", [[], [(1, "a", "en", "s", 1)], [(2, "a", None, None, None)] * 5])
def test_manifest_of_few_rows(spark, rows):
    assert by_text(made_manifest(spark, rows)) == by_text(plain_manifest(rows))


def test_a_changed_record_does_not_verify(spark):
    rows = [(i, f"t{i}", "en", "s", i) for i in range(9)]
    docs = spark.createDataFrame(rows, SCHEMA)
    other = merkle.record_hash([*map(F.col, FIELDS[:3]), F.col("n_chars") + 1, F.col("text")])
    found = merkle.manifest(docs, "doc_id", FIELDS, "lang", other=other)
    folded = merkle.fold(F.col("other"), F.col("pos"), F.col("n"), F.col("siblings"))
    assert found.where(folded == F.col("root")).isEmpty()


def plain_runs(w: list, least: int = 24, periods: int = 3) -> list[tuple[int, int, int]]:
    found: dict = {}
    for q in range(1, len(w) // periods + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j > i and j - i + q >= max(least, periods * q):
                found.setdefault((i, j - i + q), q)
            i = max(j, i + 1)
    return sorted((s, n, q) for (s, n), q in found.items())


def plain_collapsed(w: list[str], runs: list[tuple[int, int, int]]) -> str:
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def test_runs_of_random_sequences():
    rnd = random.Random(5)
    total = 0
    for _ in range(150):
        sequences = []
        for _ in range(rnd.randint(1, 8)):
            n, k = rnd.choice([0, 1, 5, 23, 24, 30, 60, 120, 300]), rnd.choice([1, 2, 3, 10, 50])
            s = [rnd.randrange(k) for _ in range(n)]
            for _ in range(rnd.randint(0, 3) if n > 10 else 0):
                a, p = rnd.randrange(n), rnd.randint(1, n // 4)
                for i in range(a, min(n, a + rnd.randint(1, 6) * p)):
                    s[i] = s[a + (i - a) % p]
            sequences.append(s)
        least, periods = rnd.choice([(24, 3), (24, 3), (6, 2), (10, 4)])
        got = periodic_runs.runs_of([np.array(s, np.int64) for s in sequences], least, periods)
        for s, g in zip(sequences, got):
            want = plain_runs(s, least, periods)
            total += len(want)
            assert [tuple(r) for r in g.tolist()] == want
    assert total > 300


def test_extensions_by_grammar():
    rnd = random.Random(2)
    words = [rnd.randrange(2) for _ in range(150)] + [0] * 90 + [0, 1] * 60 + [rnd.randrange(3) for _ in range(60)]
    text = [100, *words, 101]
    pairs = [sorted(rnd.sample(range(1, len(text) - 1), 2)) for _ in range(500)]
    a, b = (np.array(x) for x in zip(*pairs))
    grammar = Grammar(np.array(text))
    ahead, behind = grammar.extend(a, b), grammar.extend(a, b, backward=True)
    for i, j, f, g in zip(a.tolist(), b.tolist(), ahead.tolist(), behind.tolist()):
        n = m = 0
        while text[i + n] == text[j + n]:
            n += 1
        while text[i - m - 1] == text[j - m - 1]:
            m += 1
        assert (f, g) == (n, m)


def test_runs_of_texts(spark):
    rows = [
        (1, " ".join(["a b c"] * 8)), (1, " ".join(["a b c"] * 8)), (2, None), (None, ""), (3, "x\ty\nz " * 7),
        (4, "é " * 24 + "ende"), (5, " ".join(["p q"] * 30 + ["r"] * 40)), (6, " ".join(str(i % 900) for i in range(40_000))),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("runs", F.lit(0))
    got = periodic_runs.find_runs(docs, "doc_id", "text").collect()
    want = []
    for d, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        runs = plain_runs(w) if len(w) < 1000 else [(0, 40_000, 900)]
        want.append((d, len(w), runs, plain_collapsed(w, runs)))
    assert by_text([(r["id"], r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in got]) == by_text(want)
    assert periodic_runs.find_runs(docs.limit(0), "doc_id", "text").count() == 0


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no driver tables")
def test_periodic_runs_of_documents(spark):
    got = {r["doc_id"]: tuple(r) for r in QUERIES["op13_periodic_runs"](spark, SF_DIR).collect()}
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(docs)
    for d, text in docs:
        w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        n, h = len(w), zlib.crc32(str(d).encode())
        g = h // 10
        if n > 3000:
            continue  # plain Python takes the square of the words; longer texts are tested above
        if h % 10 == 0 and n:
            a, p = g % n, 1 + (n - g % n) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
        runs = plain_runs(w)
        best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=None)
        head = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
        lines = "".join("%d,%d,%d\n" % r for r in runs)
        assert got[d] == (d, len(runs), *head, sha(lines), sha(plain_collapsed(w, runs)))


def toxic_texts(n: int) -> list[tuple]:
    rnd = random.Random(3)
    plain = [f"{a}{b}" for a in "ka lo mi ru te".split() for b in "na po si ve zu".split()]
    rows = []
    for i in range(n):
        words = [rnd.choice(plain) for _ in range(rnd.randint(5, 60))]
        toxic = i % 5 == 0
        if toxic:
            words[rnd.randrange(len(words))] = rnd.choice(["Scoundrel,", "vermin!", "blokker" + rnd.choice(plain)])
        rows.append((i, ("en", "de", None)[i % 3], int(toxic), " ".join(words)))
    return rows


def test_toxic_texts_are_told_apart():
    rows = [dict(id=i, lang=lang, toxic=y, text=t) for i, lang, y, t in toxic_texts(900)]
    net = toxicity.learn(rows[:600])
    scores = net.score(toxicity.WordTable(net).pooled([toxicity.folded_words(r["text"]) for r in rows[600:]]))
    said, true = scores >= 0.3, np.array([r["toxic"] for r in rows[600:]]) == 1
    assert said[true].mean() > 0.95 and said[~true].mean() < 0.03


def test_scores_do_not_depend_on_batches_language_or_length(spark):
    rows = toxic_texts(300)
    net = toxicity.learn([dict(id=i, lang=lang, toxic=y, text=t) for i, lang, y, t in rows])
    long = " ".join(t for _, _, y, t in rows if not y) + " "
    texts = [(1, None, "en"), (1, "", "xx"), (None, rows[0][3], None), (2, rows[0][3], "de"), (3, long * 20 + rows[0][3], "en"), (4, long * 20, "en")]
    docs = spark.createDataFrame(texts, "doc_id long, text string, lang string").withColumn("score", F.lit("own"))
    got = toxicity.score_toxicity(docs.coalesce(1), net, "doc_id", "text", "lang").collect()
    assert len(got) == 6 and all(0 <= r["score"] <= 1 for r in got)
    assert got[0]["score"] == got[1]["score"] and got[2]["score"] == got[3]["score"]
    assert got[4]["score"] > 0.3 > got[5]["score"]  # the toxic word stands at the very end
    table = toxicity.WordTable(net)
    each = [float(net.score(table.pooled([toxicity.folded_words(t)]))[0]) for _, t, _ in texts]
    assert np.allclose([r["score"] for r in got], each, atol=1e-6)
    assert toxicity.score_toxicity(docs.limit(0), net, "doc_id", "text", "lang").count() == 0


def test_labels_that_cannot_be_learned_from(spark):
    docs = spark.createDataFrame([(1, "a", "en"), (2, "b", None), (2, "b", None), (None, "c", "en")], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, 0), (2, 0), (None, 1), (3, None)], "doc_id long, toxic int")
    rows = toxicity.fitting_texts(docs, labels, "doc_id", "text", "lang", "doc_id", "toxic")
    assert [(r["id"], r["toxic"]) for r in rows] == [(2, 0), (2, 0)]
    for given in (rows, []):
        assert 0 <= toxicity.score_toxicity(docs, toxicity.learn(given), "doc_id", "text", "lang").first()["score"] <= 1


def test_the_fitted_texts_are_bounded(spark):
    docs = spark.createDataFrame([(i, "w" * 100, "en") for i in range(2000)] + [(-1, "v" * 9000, "en")], "doc_id long, text string, lang string")
    labels = docs.select("doc_id", F.lit(1).alias("toxic"))
    rows = toxicity.fitting_texts(docs, labels, "doc_id", "text", "lang", "doc_id", "toxic", most_bytes=50_000)
    assert 300 < len(rows) < 700 and all(r["id"] >= 0 for r in rows)


@pytest.mark.parametrize("part_bytes", [10_000, 1_000_000])
def test_all_parts_are_learned_from(spark, part_bytes):
    rows = toxic_texts(1200)
    texts = spark.createDataFrame([r for r in rows if r[0] % 4 != 2], "id long, lang string, toxic int, text string")
    net = toxicity.learn_from(texts, part_bytes=part_bytes)
    held = [r for r in rows if r[0] % 4 == 2]
    scores = net.score(toxicity.WordTable(net).pooled([toxicity.folded_words(r[3]) for r in held]))
    said, true = scores >= 0.3, np.array([r[2] for r in held]) == 1
    assert said[true].mean() > 0.95 and said[~true].mean() < 0.03
    assert 0 <= toxicity.learn_from(texts.where("toxic = 0")).score(np.zeros((1, 18)))[0] < 0.3
    assert toxicity.learn_from(texts.limit(0)).score(np.zeros((1, 18)))[0] == 0.5


def test_long_texts_are_learned_from(spark, tmp_path):
    plain = "one two three four five six seven eight nine ten "
    rows = [(i, plain * (28_000 if i < 16 else 2) + ("scoundrel" if i < 16 else ""), "en") for i in range(120)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, int(i < 16)) for i in range(120)], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    got = {r["doc_id"]: r["score"] for r in QUERIES["op12_toxicity"](spark, str(tmp_path)).collect()}
    assert min(got[i] for i in range(16)) > 0.3 > max(got[i] for i in range(16, 120))


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.1"), reason="no driver tables")
def test_held_out_accuracy(spark):
    sf_dir = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    found = QUERIES["op12_toxicity"](spark, sf_dir)
    assert found.count() == 10_000
    rows = found.where("held_out").join(labels, "doc_id").collect()
    assert all(zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2 for r in rows)
    true = np.array([r["toxic"] for r in rows]) == 1
    said = np.array([r["predicted"] for r in rows]) == 1
    flagged = np.array([r["flagged"] for r in rows])
    assert said[true].mean() > 0.85 and true[said].mean() > 0.85
    assert flagged[true].mean() > 0.85 and true[flagged].mean() > 0.85
