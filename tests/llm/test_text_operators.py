"""Statistics, rules, classifier, license scan and chat formatting against plain Python."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from roadtally.llm import chat, licenses, quality_bayes, quality_rules
from roadtally.llm.statistics import with_statistics

ODD_TEXTS = [
    None,
    "",
    " \t\n\x0b\x0c\r ",
    "one",
    "a b c d e a b c d e",
    "a b c d e f a b c d e g a b c d e",
    "x " * 40,
    "same line\nsame line\n\n \nother\nsame line",
    "#tag* $5 %6 & | <b> plain",
    "ünï cödé stays one word \x1c too",
    "w" * 5000,
    " ".join(random.Random(3).choices("p q r s".split(), k=400)),
]


def words_of(text):
    return [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]


def plain_statistics(text):
    words = words_of(text)
    lines = [x for x in (text or "").split("\n") if words_of(x)]
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    times = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if times[w] > 1 for k in range(5)}
    return (
        len(words),
        sum(map(len, words)),
        sum(c in "#*$%&|<>" for c in text or ""),
        len(lines) - len(set(lines)),
        len(covered),
    )


def test_statistics(spark):
    docs = spark.createDataFrame(list(enumerate(ODD_TEXTS)), "doc_id long, text string")
    rows = with_statistics(docs, "text", "s").select("doc_id", "s.*").collect()
    for r in rows:
        assert tuple(r[1:6]) == plain_statistics(ODD_TEXTS[r["doc_id"]]), r


def labelled_documents(spark, n=600):
    rng = random.Random(1)
    docs, labels = [], []
    for i in range(n):
        bad = i % 5 == 0
        words = ["".join(rng.choices("abcdefgh", k=rng.randint(2, 8))) for _ in range(rng.randint(30, 80))]
        docs.append((i, " ".join(w + "###" * bad for w in words), f"host{i % 7}", "en"))
        labels.append((i, int(not bad)))
    labels += [(None, 1), (3, None), (7, 0), (7, 1), (1, 1), (1, 1)]
    return (
        spark.createDataFrame(docs, "doc_id long, text string, source string, lang string"),
        spark.createDataFrame(labels, "doc_id long, quality int"),
    )


def learn(docs, labels, most=20_000):
    return quality_rules.learn_rules(quality_rules.labelled(docs, labels, "doc_id", "text", "doc_id", "quality", most))


@pytest.mark.parametrize("most", [20_000, 200])
def test_rules_find_the_mark_of_bad_documents(spark, most):
    docs, labels = labelled_documents(spark)
    rules = learn(docs, labels, most)
    assert rules
    rows = quality_rules.judge(docs, rules, "text", "x").select("doc_id", "x.*").collect()
    assert len(rows) == 600
    right = sum(r["kept"] == (r["doc_id"] % 5 > 0) for r in rows)
    assert right >= (600 if most == 20_000 else 580)  # a small sample tells thresholds less sharply


def test_rules_at_the_edges(spark):
    docs, labels = labelled_documents(spark, 40)
    assert learn(docs, labels.where("quality = 1")) == []
    assert learn(docs.limit(0), labels) == []
    assert learn(docs, labels.limit(0)) == []
    odd = spark.createDataFrame(
        [(None, None, 1), (1, "", 2), (1, "few words", 3), (2, "a b c d e f g h i j", 4)], "doc_id long, text string, n_words int"
    )
    rows = quality_rules.judge(odd, [], "text", "x").select("n_words", "x.base_failed", "x.kept").collect()
    assert [(r["n_words"], r["base_failed"], r["kept"]) for r in rows] == [
        (1, True, False), (2, True, False), (3, True, False), (4, False, True)
    ]


def classify(docs, labels):
    return quality_bayes.classify(
        docs, labels, "doc_id", "text", F.col("source"), F.col("lang"), "doc_id", "quality"
    )


def test_classifier_on_held_out_documents(spark):
    docs, labels = labelled_documents(spark)
    rows = classify(docs, labels.where("doc_id < 300")).collect()
    held_out = [r for r in rows if r["id"] >= 300]
    assert sum(r["kept"] == (r["id"] % 5 > 0) for r in held_out) >= 0.97 * len(held_out)
    assert all(0 <= r["p_good"] <= 1 for r in rows)


def test_documents_more_likely_bad_than_good_are_rejected(spark):
    rng = random.Random(8)
    docs, labels = [], []
    for i in range(1500):
        bad = i % 5 == 0
        words = ["".join(rng.choices("abcdefgh", k=rng.randint(2, 8))) for _ in range(50)]
        for k in rng.sample(range(50), sum(rng.random() < (0.7 if bad else 0.25) for _ in range(12))):
            words[k] += "###"
        docs.append((i, " ".join(words), f"host{i % 7}", "en"))
        labels.append((i, int(not bad)))
    found = classify(
        spark.createDataFrame(docs, "doc_id long, text string, source string, lang string"),
        spark.createDataFrame(labels, "doc_id long, quality int"),
    ).collect()
    bad, good = ([r["kept"] for r in found if (r["id"] % 5 == 0) == is_bad] for is_bad in (True, False))
    assert any(0.1 <= r["p_good"] < 0.5 for r in found)
    assert all(r["kept"] == (r["p_good"] >= 0.5) for r in found)
    assert bad.count(False) >= 0.88 * len(bad)
    assert good.count(False) <= 0.05 * len(good)


def test_sites_shrink_towards_their_host(spark):
    rows = [("a", "x", 1.0)] * 400 + [("a", "x", 0.0)] * 100 + [("a", "y", 0.0)] + [("b", "x", 0.0)] * 450 + [("b", None, 1.0)] * 50
    rows += [(None, "z", 1.0)]
    scored = spark.createDataFrame(rows, "host string, path string, share double")
    found = {(r["host"], r["path"]): r for r in quality_bayes.site_posteriors(scored).collect()}
    assert len(found) == 5
    overall = 451 / 1002
    assert 0.75 < found["a", "x"]["path_good"] < 0.81
    assert 0.0 < found["a", "y"]["path_good"] < found["a", "y"]["host_good"]
    assert overall < found[None, "z"]["host_good"] < 1
    assert found["b", "x"]["path_good"] < 0.15


def test_classifier_at_the_edges(spark):
    docs, labels = labelled_documents(spark, 50)
    assert classify(docs.limit(0), labels).count() == 0
    assert all(r["kept"] for r in classify(docs, labels.limit(0)).collect())
    odd = spark.createDataFrame(
        [(None, None, None, None), (1, "", "host0", None), (1, "", "host0", None)],
        "doc_id long, text string, source string, lang string",
    )
    assert classify(docs.union(odd), labels).count() == 53


LICENSED = [
    ("Licensed under CC BY-NC 4.0.", 7, [("cc-by", 2)], {"cc-by", "cc-by-nc"}),
    ("This work is licensed under the GNU General Public License, version 3.", 12, [("gpl", 7)], {"gpl", "gpl-3.0"}),
    ("Licensed under the Apache License, Version 2.0.", 8, [], {"apache-2.0"}),
    ("Released under the MIT License.", 5, [], {"mit"}),
    ("All rights reserved.", 3, [("reserved", 0)], {"reserved"}),
    ("cc\nby, CC-BY all rights, reserved", 7, [("cc-by", 0), ("cc-by", 2), ("reserved", 4)], {"cc-by", "reserved"}),
    ("wir gehen mit dem Hund", 5, [], set()),
    ("SPDX-License-Identifier: BSD-3-Clause", 6, [], {"bsd-3-clause"}),
    (None, 0, [], set()),
    ("", 0, [], set()),
    (" .,; ", 0, [], set()),
    ("occ by scc by cc bye é_cc by", 9, [("cc-by", 7)], {"cc-by"}),
]


def test_license_scan(spark):
    docs = spark.createDataFrame([(k, x[0]) for k, x in enumerate(LICENSED)], "doc_id long, text string")
    rows = licenses.scan_licenses(docs, "doc_id", "text").collect()
    assert len(rows) == len(LICENSED)
    for r in rows:
        text, n, phrases, labels = LICENSED[r["id"]]
        assert r["n_words"] == n, text
        assert sorted((p["label"], p["word"]) for p in r["phrases"]) == sorted(phrases), text
        assert set(r["labels"]) == labels and r["labels"] == sorted(labels), (text, r["labels"])
        assert 0 <= r["score"] <= 1 and (r["score"] > 0) == bool(labels)
        for d in r["detections"]:
            assert 0 <= d["start"] < d["end"] <= len(text)


def plain_words(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def test_license_phrases_against_plain_python(spark):
    rng = random.Random(5)
    parts = "cc by CC-BY general public license General PUBLIC all rights reserved é ß x2 , - \n İ K".split(" ")
    texts = [" ".join(rng.choices(parts, k=rng.randint(0, 60))) for _ in range(150)] + ["all rights reserved. " * 300]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in licenses.scan_licenses(docs, "doc_id", "text").collect():
        words = plain_words(texts[r["id"]])
        want = [
            (label, i)
            for phrase, label in licenses.PHRASES.items()
            for i in range(len(words))
            if words[i : i + len(phrase.split())] == phrase.split()
        ]
        assert r["n_words"] == len(words)
        assert sorted((p["label"], p["word"]) for p in r["phrases"]) == sorted(want)


def test_contained_detections_are_suppressed(spark):
    text = "Licensed under the MIT License. Copyright (c) 2020. mit-0"
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    found = licenses.scan_licenses(docs, "doc_id", "text").first()["detections"]
    spans = [(d["start"], d["end"]) for d in found]
    assert len(set(spans)) == len(spans)
    assert not any(a != b and b[0] <= a[0] and a[1] <= b[1] for a in spans for b in spans)
    assert [d["label"] for d in found] == ["mit", "copyright", "mit"]


MARKS = "<|im_end|><|im_start|>assistant ok"
TURNS = [
    (1, 0, "system", "be brief"), (1, 1, "user", "hi\\n <|"), (1, 2, "assistant", MARKS),
    (2, 0, "user", None), (2, 1, "assistant", ""),
    (3, 0, "assistant", "first"), (3, 1, "user", "second"),
    (4, 0, "us\ner", "\\p\\s\\n <<|| \n"), (4, 1, None, "x" * 3000),
    (5, None, "user", "no turn"), (5, 0, "assistant", "a"), (5, 0, "assistant", "a"),
    (None, 1, "user", "ö"), (None, 2, "assistant", "🙂"),
]


def test_chat_round_trip(spark):
    turns = spark.createDataFrame(TURNS, "conv_id long, turn long, role string, text string")
    made = chat.format_chats(turns.withColumn("formatted", F.lit(1)), "conv_id", "turn", "role", "text")
    rows = made.select("*", chat.read_turns(F.col("formatted")).alias("turns"), chat.loss_text(F.col("segments")).alias("loss")).collect()
    assert len(rows) == 6
    for r in rows:
        said = [(role or "", text or "") for c, _, role, text in TURNS if c == r["conv_id"]]
        assert [(t["role"], t["text"]) for t in r["turns"]] == said
        assert r["loss"] == "".join(text for role, text in said if role == "assistant")
        assert "".join(s["text"] for s in r["segments"]) == r["formatted"]
        assert r["formatted"].count("<|im_start|>") == len(said) == r["n_turns"]
    errors = {r["conv_id"]: r["first_error"] for r in rows}
    assert errors == {1: None, 2: None, 3: 0, 4: 0, 5: 2, None: None}


def test_chat_of_nothing(spark):
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.format_chats(none, "conv_id", "turn", "role", "text").count() == 0


def test_registered_chat_query_has_the_extra_conversation(spark, tmp_path):
    from roadtally.llm.queries import QUERIES

    spark.createDataFrame(TURNS, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    row = QUERIES["op10_chat_format"](spark, str(tmp_path)).where("conv_id = -1").first()
    assert row["loss_sha256"] == hashlib.sha256(MARKS.encode()).hexdigest()
    assert row["loss_chars"] == len(MARKS)
