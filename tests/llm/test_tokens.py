"""Encoders, token counts and packing against the tokenizer libraries."""

from __future__ import annotations

import base64
import hashlib
import random
import zlib

import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

from roadtally.llm import merge_replay, packing, token_counts
from roadtally.llm.vocabulary import ChunkStore, merge_file, rank_file

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
MERGES = public_tokenizers.path("byte_bpe_50k.json")
PLAIN = public_tokenizers.path("byte_bpe_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN

PARTS = ["a", "b", "the", "  ", " ", "\n", "\t", "é", "ß", "日本", "🙂", "1", "23", "'s", "'", "!", "aaaa", " ", "　"]
PARTS += ["<|endoftext|>", "ing", " \n", "\r\n", "\x1c", "\x00", " \x00", "zz", "  \n ", "՘", "ퟋ", "hello", " world"]


def texts():
    rng = random.Random(2)
    out = ["".join(rng.choices(PARTS, k=rng.randint(0, 40))) for _ in range(800)]
    out += ["", "a" * 5000, "ab" * 3000, " " * 777, "\n" * 50 + " x", "zzz" * 1000 + "日" * 500]
    ranges = [(0, 0x2FF), (0, 0xD7FF), (0xE000, 0x1FFFF)]
    out += ["".join(chr(rng.randint(*rng.choice(ranges))) for _ in range(30)) for _ in range(300)]
    return out


@pytest.fixture(scope="module")
def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_replay_equals_the_library(library):
    store = ChunkStore(rank_file(RANKS), PATTERN, merge_replay.replay, most=500)
    some = texts()
    for a in range(0, len(some), 300):  # several batches, so that the store is emptied between them
        part = some[a : a + 300]
        for text, numbers in zip(part, store.numbered(part)):
            assert store.ids(numbers).tolist() == library.encode_ordinary(text), ascii(text)


def test_merging_in_step_equals_the_library():
    tokenizer = Tokenizer.from_file(MERGES)
    store = ChunkStore(merge_file(MERGES), PATTERN, token_counts.merge_in_step)
    some = texts()
    for text, numbers in zip(some, store.numbered(some)):
        assert store.ids(numbers).tolist() == tokenizer.encode(text, add_special_tokens=False).ids, ascii(text)


def documents(spark, extra=()):
    rows = [(i, t) for i, t in enumerate(texts()[:120])] + [(None, "no id"), (5, None), (5, None), (7, "again " * 4000)]
    return spark.createDataFrame([(*r, "clash") for r in [*rows, *extra]], "doc_id long, text string, ids string").repartition(3)


def test_round_trip_digests(spark, library):
    docs = documents(spark)
    rows = merge_replay.round_trip_digests(docs, "doc_id", "text", RANKS, PATTERN).collect()
    want = []
    for r in docs.collect():
        ids = library.encode_ordinary(r["text"] or "")
        sha = [hashlib.sha256(x).hexdigest() for x in (",".join(map(str, ids)).encode(), (r["text"] or "").encode())]
        want.append((r["doc_id"], len(ids), *sha))
    assert sorted(map(str, want)) == sorted(str(tuple(r)) for r in rows)


def test_encode_then_decode(spark):
    docs = documents(spark)
    encoded = merge_replay.encode(docs, "doc_id", "text", RANKS, PATTERN)
    decoded = merge_replay.decode(encoded, RANKS).collect()
    want = sorted(str((r["doc_id"], (r["text"] or "").encode())) for r in docs.collect())
    assert want == sorted(str((r["id"], bytes(r["decoded"]))) for r in decoded)


def test_counts(spark):
    tokenizer = Tokenizer.from_file(MERGES)
    docs = documents(spark)
    rows = token_counts.count_tokens(docs, "doc_id", "text", MERGES, PATTERN, 1024).collect()
    want = []
    for r in docs.collect():
        n = len(tokenizer.encode(r["text"] or "", add_special_tokens=False).ids)
        want.append((r["doc_id"], len((r["text"] or "").encode()), n, n > 1024))
    assert sorted(map(str, want)) == sorted(str(tuple(r)) for r in rows)


def test_no_documents(spark):
    none = documents(spark).limit(0)
    assert token_counts.count_tokens(none, "doc_id", "text", MERGES, PATTERN, 9).count() == 0
    assert merge_replay.round_trip_digests(none, "doc_id", "text", RANKS, PATTERN).count() == 0
    assert merge_replay.encode(none, "doc_id", "text", RANKS, PATTERN).count() == 0


def pieces(docs, limit, with_ids=False):
    return packing.token_pieces(docs, "doc_id", "text", PLAIN, PATTERN, {"<|endoftext|>": 50256}, 2, limit, with_ids)


@pytest.mark.parametrize("limit", [1024, 16])
def test_packing(spark, limit):
    tokenizer = Tokenizer.from_file(MERGES)
    docs = documents(spark)
    packed = packing.pack(pieces(docs, limit, with_ids=True), limit)
    rows = packed.collect()
    spans = {}
    for r in rows:
        assert r["length"] == len(r["ids"]) and 0 < r["length"] <= limit
        raw = b"".join(i.to_bytes(4, "little") for i in r["ids"])
        assert r["ids_crc32"] == zlib.crc32(raw)
        spans.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for own in spans.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= limit
    unique = {r["doc_id"]: r["text"] for r in docs.collect() if r["doc_id"] not in (None, 5, 7)}
    for doc_id, text in unique.items():
        own = sorted((r for r in rows if r["id"] == doc_id), key=lambda r: r["piece"])
        assert [r["piece"] for r in own] == list(range(len(own)))
        ids = [i for r in own for i in r["ids"]]
        assert ids == tokenizer.encode(text or "", add_special_tokens=False).ids + [2]
        assert [r["start"] for r in own] == [sum(x["length"] for x in own[:k]) for k in range(len(own))]
        assert all(r["length"] == limit for r in own[1:])
    joined = packing.sequences(packed).collect()
    assert sum(len(r["ids"]) for r in joined) == sum(r["length"] for r in rows)
    assert len(joined) == len(spans)


def first_fit_decreasing(counts, limit):
    bins = []
    for n in sorted((n for n, c in counts.items() for _ in range(c)), reverse=True):
        for k, room in enumerate(bins):
            if n <= room:
                bins[k] -= n
                break
        else:
            bins.append(limit - n)
    return len(bins)


@pytest.mark.parametrize("seed", range(12))
def test_best_two_fit_uses_few_bins(seed):
    rng = random.Random(seed)
    limit = rng.choice([10, 64, 1024])
    counts = {n: rng.randint(0, 9) for n in rng.sample(range(1, limit + 1), min(limit, 60))}
    plan = packing.best_two_fit(counts, limit)
    placed = {}
    for own, times in plan:
        assert 0 < sum(n * k for n, k in own) <= limit and times > 0
        for n, k in own:
            placed[n] = placed.get(n, 0) + k * times
    assert placed == {n: c for n, c in counts.items() if c}
    assert sum(times for _, times in plan) <= first_fit_decreasing(counts, limit) + 1


def test_an_exchange_fills_the_gap():
    # Greedy: 6 + 3 leaves 1; exchanging the 3 for 2 + 2 fills the bin.
    assert packing.best_two_fit({6: 1, 3: 1, 2: 2}, 10)[0] == ([(6, 1), (2, 2)], 1)


def test_packing_nothing(spark):
    assert packing.pack(pieces(documents(spark).limit(0), 8), 8).count() == 0
