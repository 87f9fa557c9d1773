"""Jaccard join, components, vector search and archives against brute force."""

from __future__ import annotations

import hashlib
import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from roadtally.llm import jaccard_join, topk, warc
from roadtally.llm.components import components
from roadtally.llm.shingles import point, shingle_set


def plain_set(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", low) if w]
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4)))


def plain_components(rows):
    """Smallest reachable id by (id, text) rows, all with an id."""
    sets = [plain_set(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and (100 * both >= 80 * len(sets[i] | sets[j]) or rows[i][0] == rows[j][0]):
                root[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        least[find(i)] = min(least.get(find(i), doc_id), doc_id)
    return sorted((doc_id, len(sets[i]), least[find(i)]) for i, (doc_id, _) in enumerate(rows))


def corpus(seed):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    texts = [" ".join(rng.choices(vocabulary, k=rng.randint(1, 120))) for _ in range(60)]
    for _ in range(120):  # copies with edits, some on both sides of the threshold, some in chains
        words = rng.choice(texts).split()
        for _ in range(rng.randint(0, max(1, len(words) // 12))):
            words[rng.randrange(len(words))] = rng.choice(vocabulary)
        texts.append(" ".join(words))
    passage = " ".join(rng.choices(vocabulary, k=50))
    texts += [f"{' '.join(rng.choices(vocabulary, k=30))} {passage} {' '.join(rng.choices(vocabulary, k=k))}" for k in range(25)]
    texts += [passage + f" {k}" for k in range(25)] + [passage.upper()] * 8
    texts += ["one two three", "ONE  two\nthree", "one two three four five", "", "  ", None, None, "x y z"]
    return list(enumerate(texts))


@pytest.mark.parametrize("seed,strip", [(1, 4096), (2, 4)])
def test_classes_equal_brute_force(spark, monkeypatch, seed, strip):
    monkeypatch.setattr(jaccard_join, "STRIP", strip)
    monkeypatch.setattr(jaccard_join, "SET_STRIP", strip)
    rows = corpus(seed)
    random.Random(seed).shuffle(rows)
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, k int").repartition(5)
    found = jaccard_join.near_duplicates(docs, "doc_id", "text").collect()
    assert sorted(map(tuple, found)) == plain_components(rows)


def test_repeated_and_missing_ids(spark):
    long = " ".join(f"v{i}" for i in range(40))
    rows = [(4, long), (4, long), (2, long + " end"), (9, "other words stand here now"), (9, "quite another text is this one"), (1, None)]
    docs = spark.createDataFrame([*rows, (None, long), (None, None)], "doc_id long, text string")
    found = sorted(map(tuple, jaccard_join.near_duplicates(docs, "doc_id", "text").collect()), key=str)
    want = plain_components(rows) + [(None, 36, None), (None, 0, None)]
    assert found == sorted(want, key=str)


def test_no_documents_no_classes(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert jaccard_join.near_duplicates(none, "doc_id", "text").count() == 0


def overlap_bound(a, b):
    groups = min(len(a), len(b))
    return sum(min(int(x), int(y)) for x, y in zip(*(p.reshape(groups, -1).sum(1, dtype=int) for p in (a, b))))


def test_a_tree_finds_all_pairs_its_points_allow():
    rng = random.Random(4)
    sets = [shingle_set(" ".join(rng.choices("abcdefghij", k=rng.randint(5, 60)))) for _ in range(150)]
    sets += [np.unique(np.append(s[3:], np.uint64(rng.getrandbits(60)))) for s in sets[:80]]
    n = np.array([len(s) for s in sets])
    sets += [shingle_set(" ".join(rng.choices("abcdefghij", k=rng.randint(180, 320)))) for _ in range(40)]
    sets += [np.unique(np.append(s[9:], np.uint64(rng.getrandbits(60)))) for s in sets[-40:]]
    n = np.array([len(s) for s in sets])
    points = [point(s) for s in sets]
    assert len({len(p) for p in points}) > 2
    part = np.array([rng.randrange(40) for _ in sets])
    side = np.zeros(len(sets), np.int64)
    got = {(min(a, b), max(a, b)) for x, y in jaccard_join.point_pairs(n, [p.tobytes() for p in points], part, side) for a, b in zip(x, y)}
    want = {
        (i, j)
        for j in range(len(sets))
        for i in range(j)
        if part[i] != part[j]
        and 100 * min(n[i], n[j]) >= 80 * max(n[i], n[j])
        and 9 * overlap_bound(points[i], points[j]) >= 4 * int(n[i] + n[j])
    }
    assert got == want


def test_components_of_chains_stars_and_loops(spark):
    links = [(i, i + 1) for i in range(100, 160)] + [(7, k) for k in range(8, 60)] + [(3, 3), (5, 7), (5, 7), (None, 1)]
    found = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "u long, v long")).collect()}
    assert found == {k: 100 for k in range(100, 161)} | {k: 5 for k in range(5, 60) if k == 5 or k >= 7}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def plain_top(rows, k):
    usable = {}
    for vec_id, vec in rows:
        if vec_id is None or vec is None or any(x is None or not math.isfinite(x) for x in vec):
            continue
        whole = [math.floor(256 * float(np.float32(x))) for x in vec]
        usable[vec_id] = min(usable.get(vec_id, whole), whole)
    out = []
    for q, a in usable.items():
        if q % 50 == 0:
            scores = [(-sum(x * y for x, y in zip(a, b)), v) for v, b in usable.items() if v != q and len(b) == len(a)]
            out += [(q, r, v, -s) for r, (s, v) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out)


@pytest.mark.parametrize("block_rows,block_queries", [(16_384, 4_096), (50, 3)])
def test_top_k_equals_brute_force(spark, monkeypatch, block_rows, block_queries):
    monkeypatch.setattr(topk, "BLOCK_ROWS", block_rows)
    monkeypatch.setattr(topk, "BLOCK_QUERIES", block_queries)
    rng = random.Random(9)
    rows = [(i, [rng.gauss(0, 1) for _ in range(12)]) for i in range(400)]
    rows += [(i, rows[0][1]) for i in range(400, 560)]  # a third are ties
    rows += [(600, [1.0] * 3), (601, [2.0] * 3), (650, [5000.0, -3e6, 0.5]), (602, [1e5, 2e6, 3.0])]
    rows += [(None, [1.0] * 12), (700, None), (701, [None] * 12), (702, [float("nan")] * 12), (750, [float("inf")] * 12)]
    rows += [(50, rows[50][1]), (51, [0.0] * 12), (800, []), (801, [])]
    table = spark.createDataFrame([(*r, 1.5) for r in rows], "vec_id long, embedding array<float>, score double").repartition(4)
    vectors = topk.whole_vectors(table, "vec_id", "embedding", 256.0)
    found = topk.top_k(vectors, F.col("vec_id") % 50 == 0, 5)
    assert sorted(map(tuple, found.collect())) == plain_top(rows, 5)


def test_large_components_take_part(spark):
    rows = [(0, [1.0, 2.0]), (1, [1e8, 1.0]), (2, [-3e9, 5.0]), (3, [2e12, 0.25]), (50, [400.0, -1.0]), (4, [-4e15, -3e15])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    vectors = topk.whole_vectors(table, "vec_id", "embedding", 256.0)
    found = topk.top_k(vectors.where("vec_id < 3 or vec_id = 50"), F.col("vec_id") % 50 == 0, 5)
    assert sorted(map(tuple, found.collect())) == plain_top([x for x in rows if x[0] < 3 or x[0] == 50], 5)
    # Only scores that are returned have to be longs.
    found = topk.top_k(vectors, F.col("vec_id") == 0, 2).collect()
    assert sorted(map(tuple, found)) == [x for x in plain_top(rows, 2) if x[0] == 0]
    with pytest.raises(Exception, match="no long"):
        topk.whole_vectors(table.limit(1).selectExpr("vec_id", "array(1e30F) as embedding"), "vec_id", "embedding", 256.0).collect()


def test_top_k_of_nothing(spark):
    none = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert topk.top_k(topk.whole_vectors(none, "vec_id", "embedding", 256.0), F.col("vec_id") % 50 == 0, 5).count() == 0


def archive(spark, tmp_path, rows):
    pages = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, segment string")
    warc.write_warc(pages.repartition(3), f"{tmp_path}/warc", "page_id", "url", "html")
    return warc.read_warc(spark, f"{tmp_path}/warc")


def test_archive_round_trip(spark, tmp_path, monkeypatch):
    same, tricky = "s" * 100, "WARC/1.1\r\n\r\nContent-Length: 3\r\n\r\n0\r\n\r\n" * 9
    rows = [(1, "http://a/", "x" * 200_000), (2, None, None), (3, "http://b/\r\nX: y", ""), (4, "u", tricky), (5, "u", "é🙂" * 60_000)]
    rows += [(9, "u", same), (7, "u", same), (8, "u", same), (10, "u", "s" * 99), (11, "u", "s" * 99), (7, "u", same), (None, "u", same)]
    rows += [(20 + k, "hot", "h" * 70_000) for k in range(30)]
    found = archive(spark, tmp_path, rows).collect()
    want = []
    for page_id, _, html in rows:
        raw = (html or "").encode()
        first = min((p for p, _, h in rows if h == html and p is not None), default=None) if len(raw) >= 100 else page_id
        revisit = page_id is not None and first < page_id
        want.append((page_id, len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if revisit else "response", first if revisit else None))
        if not revisit:
            assert any(r["page_id"] == page_id and r["payload"] == raw for r in found)
    got = [(r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in found]
    assert sorted(map(str, got)) == sorted(map(str, want))


def test_a_lost_segment_is_an_error(spark, tmp_path):
    fields = {"WARC-Type": "response", "WARC-Record-ID": "<a>", "WARC-Page-ID": 1, "WARC-Payload-Digest": "sha256:00"}
    whole = b"HTTP/1.1 200 OK\r\nContent-Length: 9\r\n\r\n123456789"
    parts = [
        warc._header(fields | {"WARC-Segment-Number": 1, "Content-Length": 40}) + warc.GAP + whole[:40],
        warc._header({"WARC-Type": "continuation", "WARC-Record-ID": "<c>", "WARC-Segment-Origin-ID": "<a>", "WARC-Segment-Number": 3,
                      "WARC-Segment-Total-Length": len(whole), "Content-Length": len(whole) - 40}) + warc.GAP + whole[40:],
    ]
    lost = spark.createDataFrame([(p.decode(),) for p in parts], "value string")
    lost.coalesce(1).write.option("lineSep", warc.GAP.decode()).option("compression", "gzip").text(f"{tmp_path}/lost")
    with pytest.raises(Exception, match="not complete"):
        warc.read_warc(spark, f"{tmp_path}/lost").collect()


def test_an_empty_archive(spark, tmp_path):
    assert archive(spark, tmp_path, []).count() == 0
