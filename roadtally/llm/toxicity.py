"""Toxicity by a small convolutional network over hashed words, trained in numpy.

All labelled texts are learned from: buckets are counted by aggregation, and each round trains one copy
of the network on each part of the texts and averages the copies.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Row, functions as F

from roadtally.llm.columns import narrow
from roadtally.session import broadcast_if_small, cut_lineage

BUCKETS = 1 << 17
DIMS = 8
WIDTHS = (1, 2, 3)
FILTERS = 6  # of each width
# Beside the whole word, its beginnings of so many characters have embeddings, which add up.
BEGINNINGS = (4, 5, 6, 7)
KEYS = 1 + len(BEGINNINGS)
# What :func:`fitting_texts` brings to the driver: a text of more than a sixteenth is left out.
MOST_BYTES = 20_000_000
# A copy of the network is trained on about so many bytes of labelled texts.
TRAINED_BYTES = 12_000_000
# Copies are averaged so often; between, each makes an equal share of the passes.
ROUNDS = 2
# Embeddings that travel in one row when copies are averaged.
CHUNK = 1 << 12
# Calibrating texts are counted by their logits in steps of one of so many.
LOGIT_STEPS = 256
EPOCHS = 8
BATCH_TEXTS = 64
# A bucket has to occur in so many fitted texts to get an embedding of its own.
LEAST_TEXTS = 5
# Weight of the share of all texts, in texts, in the share of toxic texts a bucket starts from.
PRIOR_TEXTS = 5.0
RATE = 0.003
DROPPED = 0.3
PULL = 1e-3  # weight decay of embeddings and filters, for each step
# One fitted text in so many only calibrates.
CALIBRATION_PART = 5
# A language needs so many calibrating texts of each label for a threshold of its own.
LEAST_CALIBRATING = 10
PART_CHARS = 4_000_000
BLOCK_WORDS = 1 << 16
MOST_CACHED = 200_000  # distinct words whose sums a task keeps

# ASCII letters become lower case and all other ASCII characters but digits separate words.
_FOLD = bytes(
    c if c >= 128 or chr(c).isdigit() or chr(c).islower() else c + 32 if chr(c).isupper() else 32 for c in range(256)
)


def folded_words(text: str | None) -> list[bytes]:
    """The words of a text, in order; none for a null or empty text."""
    return (text or "").encode().translate(_FOLD).split()


def word_keys(words: list[bytes]) -> np.ndarray:
    """The hashed buckets of each word and its beginnings; ``BUCKETS`` where it has none."""
    out = np.full((len(words), KEYS), BUCKETS, np.int32)
    for row, word in enumerate(words):
        out[row, 0] = zlib.crc32(word) % BUCKETS
        letters = word.decode("utf-8", "replace")
        for k, size in enumerate(BEGINNINGS, 1):
            if len(letters) > size:
                out[row, k] = zlib.crc32(b"^" + letters[:size].encode()) % BUCKETS
    return out


class _Numbered(dict):
    """A number for each distinct word, and the words that came since they were last taken."""

    def __init__(self) -> None:
        self.fresh: list[bytes] = []

    def __missing__(self, word: bytes) -> int:
        self[word] = value = len(self)
        self.fresh.append(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.int64, len(words))


@dataclass
class Network:
    """Embeddings of buckets, filters of each width, and a logistic layer over their maxima."""

    embedding: np.ndarray  # buckets and one for none, which stays zero, x dims
    filters: list[np.ndarray]  # of each width: width x dims x filters
    bias: np.ndarray  # of all filters
    weight: np.ndarray
    shift: float
    scale: float = 1.0  # calibration of the logit: scale * logit + offset
    offset: float = 0.0
    thresholds: dict[str, float] = field(default_factory=dict)
    threshold: float = 0.3

    def places(self, vectors: np.ndarray) -> np.ndarray:
        """What each word vector adds to each filter at each of its places: words x places."""
        return vectors @ np.concatenate([f[k] for f in self.filters for k in range(len(f))], 1)

    def vectors(self, keys: np.ndarray) -> np.ndarray:
        return self.embedding[keys].sum(1)

    def score(self, pooled: np.ndarray) -> np.ndarray:
        logit = np.maximum(pooled + self.bias, 0) @ self.weight + self.shift
        return 1 / (1 + np.exp(-np.clip(self.scale * logit + self.offset, -30, 30)))


def _windows(table: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Every filter at every word; windows reach over the end into ``max(WIDTHS) - 1`` blanks."""
    looked_up = table[words]
    wide = np.zeros((max(WIDTHS) - 1, table.shape[1]), table.dtype)
    looked_up = np.concatenate([looked_up, wide])
    n, at, out = len(words), 0, []
    for width in WIDTHS:
        total = looked_up[:n, at : at + FILTERS].copy()
        for k in range(1, width):
            total += looked_up[k : k + n, at + k * FILTERS : at + (k + 1) * FILTERS]
        out.append(total)
        at += width * FILTERS
    return np.concatenate(out, 1)


def pooled_windows(table: np.ndarray, texts: list[np.ndarray]) -> np.ndarray:
    """Largest value of every filter over all windows of each text; 0 for a text without words.

    Texts lie end to end with blanks between them. What is held at a time are the windows of a
    block of words, which overlaps the next; a long text's maxima are merged over its blocks.
    """
    blank = len(table)
    table = np.concatenate([table, np.zeros((1, table.shape[1]), table.dtype)])
    gap = np.full(max(WIDTHS) - 1, blank, np.int32)
    flat = np.concatenate([x for t in texts for x in (t.astype(np.int32), gap)]) if texts else np.zeros(0, np.int32)
    sizes = np.array([len(t) for t in texts], np.int64)
    owner = np.repeat(np.arange(len(texts)), sizes + len(gap))
    out = np.full((len(texts), len(WIDTHS) * FILTERS), -np.inf, table.dtype)
    for a in range(0, len(flat), BLOCK_WORDS):
        own = flat[a : a + BLOCK_WORDS + len(gap)]
        values = _windows(table, own)[: min(BLOCK_WORDS, len(flat) - a)]
        real = np.flatnonzero(own[: len(values)] != blank)
        if not len(real):
            continue
        who, values = owner[a + real], values[real]
        starts = np.flatnonzero(np.append(True, who[1:] != who[:-1]))
        out[who[starts]] = np.maximum(out[who[starts]], np.maximum.reduceat(values, starts, axis=0))
    out[sizes == 0] = 0
    return out


class WordTable:
    """Rows of :meth:`Network.places` for the words met so far; begun anew when it grows large."""

    def __init__(self, net: Network) -> None:
        self.net = net
        self._clear()

    def _clear(self) -> None:
        self.numbers = _Numbered()
        self.filled = 0
        self.rows = np.zeros((1024, sum(WIDTHS) * FILTERS), np.float32)

    def pooled(self, texts: list[list[bytes]]) -> np.ndarray:
        """:func:`pooled_windows` of the words of each text."""
        if self.filled > MOST_CACHED:
            self._clear()
        numbered = [self.numbers.of(words) for words in texts]
        fresh, self.numbers.fresh = self.numbers.fresh, []
        if fresh:
            need = self.filled + len(fresh)
            if need > len(self.rows):
                grown = np.zeros((max(need, 2 * len(self.rows)), self.rows.shape[1]), np.float32)
                grown[: self.filled] = self.rows[: self.filled]
                self.rows = grown
            self.rows[self.filled : need] = self.net.places(self.net.vectors(word_keys(fresh)))
            self.filled = need
        return pooled_windows(self.rows[: self.filled], numbered)


class _Coded:
    """Texts as numbers of their words, with the buckets of each word."""

    def __init__(self) -> None:
        self.numbers = _Numbered()
        self.texts: list[np.ndarray] = []
        self.toxic: list[int] = []

    def add(self, words: list[bytes], toxic: int) -> None:
        self.texts.append(self.numbers.of(words).astype(np.int32))
        self.toxic.append(toxic)

    def keys(self) -> np.ndarray:
        return word_keys(self.numbers.fresh)

    def seen(self) -> np.ndarray:
        """In how many clean and toxic texts each bucket occurs; the last column counts the texts."""
        out, keys = np.zeros((2, BUCKETS + 1), np.int64), self.keys()
        for words, y in zip(self.texts, self.toxic):
            out[y, np.unique(keys[np.unique(words)])] += 1
        out[:, BUCKETS] = np.bincount(np.array(self.toxic, np.int64), minlength=2)
        return out


def _start(seen: np.ndarray, rng: np.random.Generator) -> tuple[Network, np.ndarray]:
    """The network before training, with embeddings of known buckets only, and these buckets.

    The first dimension of an embedding starts from the smoothed log odds of the texts its bucket
    occurs in, the others from small random numbers; buckets of few texts have no embedding. Without
    texts of both labels, every score is the share of toxic ones.
    """
    n, positives = int(seen[:, BUCKETS].sum()), int(seen[1, BUCKETS])
    odds = np.log((positives + 0.5) / (n - positives + 0.5))
    n_filters = len(WIDTHS) * FILTERS
    both = seen[:, :BUCKETS].sum(0)
    known = np.flatnonzero(both >= LEAST_TEXTS) if 0 < positives < n else np.zeros(0, np.int64)
    net = Network(
        np.zeros((len(known) + 1, DIMS), np.float32),
        [rng.normal(0, 0.3, (w, DIMS, FILTERS)).astype(np.float32) for w in WIDTHS],
        np.zeros(n_filters, np.float32),
        np.full(n_filters, 0.3, np.float32),
        float(odds),
    )
    if not 0 < positives < n:
        net.weight[:] = 0
        return net, known
    share = (seen[1, known] + PRIOR_TEXTS * positives / n) / (both[known] + PRIOR_TEXTS)
    net.embedding[:-1] = rng.normal(0, 0.05, (len(known), DIMS))
    net.embedding[:-1, 0] = (np.log(share) - np.log1p(-share) - odds) / 8
    for f in net.filters:
        f[:, 0, :] = np.abs(f[:, 0, :])
    return net, known


def _places_of(known: np.ndarray) -> np.ndarray:
    """The embedding of each bucket in a network of :func:`_start`."""
    place = np.full(BUCKETS + 1, len(known), np.int32)
    place[known] = np.arange(len(known))
    return place


def _whole(net: Network, known: np.ndarray) -> Network:
    """The network with a row for every bucket."""
    embedding = np.zeros((BUCKETS + 1, DIMS), np.float32)
    embedding[known] = net.embedding[:-1]
    return Network(embedding, net.filters, net.bias, net.weight, net.shift)


class _Training:
    """Passes of Adam on the logistic loss over coded texts, in batches of whole texts.

    Words are dropped at random in each pass, so that no single rare word carries a text.
    """

    def __init__(self, net: Network, known: np.ndarray, coded: _Coded) -> None:
        self.net, self.coded, self.keys = net, coded, _places_of(known)[coded.keys()]
        self.toxic = np.array(coded.toxic, np.float64)
        self.shift = np.array([net.shift], np.float32)
        self.trained = [net.embedding, *net.filters, net.bias, net.weight, self.shift]
        self.moments = [(np.zeros_like(p), np.zeros_like(p)) for p in self.trained]
        self.turn = 0

    def run(self, epoch: int, rng: np.random.Generator) -> None:
        rate, texts = RATE * (1 - epoch / EPOCHS), self.coded.texts
        order = rng.permutation(len(texts))
        for a in range(0, len(order), BATCH_TEXTS):
            chosen = order[a : a + BATCH_TEXTS]
            kept = [texts[i][rng.random(len(texts[i])) > DROPPED] for i in chosen]
            gradients = _gradients(self.net, self.shift, self.keys, kept, self.toxic[chosen])
            self.turn += 1
            for p, g, (m, v) in zip(self.trained, gradients, self.moments):
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                p -= rate * (m / (1 - 0.9**self.turn)) / (np.sqrt(v / (1 - 0.99**self.turn)) + 1e-7)
                if p.ndim > 1:
                    p *= 1 - rate * PULL
        self.net.shift = float(self.shift[0])


def fit(texts: list[list[bytes]], toxic: np.ndarray, seed: int = 7) -> Network:
    """Train on the words of texts that are at hand; :func:`learn_from` does so on a table."""
    rng, coded = np.random.default_rng(seed), _Coded()
    for words, y in zip(texts, toxic):
        coded.add(words, int(y))
    net, known = _start(coded.seen(), rng)
    if len(known):
        training = _Training(net, known, coded)
        for epoch in range(EPOCHS):
            training.run(epoch, rng)
    return _whole(net, known)


def _gradients(
    net: Network, shift: np.ndarray, keys: np.ndarray, texts: list[np.ndarray], toxic: np.ndarray
) -> list[np.ndarray]:
    """Gradients of the mean loss; only the window that is a maximum passes them on."""
    n_filters = len(WIDTHS) * FILTERS
    pooled = np.zeros((len(texts), n_filters), np.float32)
    best = np.zeros((len(texts), n_filters), np.int64)
    used, flat = np.unique(np.concatenate(texts), return_inverse=True)
    vectors = net.vectors(keys[used])
    table = net.places(vectors)
    ends = np.cumsum([0, *map(len, texts)])
    texts = [flat[a:b] for a, b in zip(ends[:-1], ends[1:])]
    for i, words in enumerate(texts):
        if len(words):
            values = _windows(table, words)
            best[i] = values.argmax(0)
            pooled[i] = values[best[i], np.arange(n_filters)]
    active = np.maximum(pooled + net.bias, 0)
    p = 1 / (1 + np.exp(-np.clip(active @ net.weight + shift[0], -30, 30)))
    error = ((p - toxic) / len(texts)).astype(np.float32)
    to_pooled = error[:, None] * net.weight * (active > 0)
    of_words = np.zeros_like(vectors)
    g_filters = [np.zeros_like(f) for f in net.filters]
    sizes = np.diff(ends)[:, None]
    for w, (width, f, g) in enumerate(zip(WIDTHS, net.filters, g_filters)):
        columns = slice(w * FILTERS, (w + 1) * FILTERS)
        for k in range(width):
            places = best[:, columns] + k
            text, j = np.nonzero(places < sizes)
            words = flat[ends[text] + places[text, j]]
            d = to_pooled[:, columns][text, j]
            np.add.at(of_words, words, d[:, None] * f[k].T[j])
            np.add.at(g[k].T, j, d[:, None] * vectors[words])
    g_embedding = np.zeros_like(net.embedding)
    touched = np.flatnonzero(of_words.any(1))
    np.add.at(g_embedding, keys[used[touched]], of_words[touched][:, None, :])
    g_embedding[-1] = 0
    return [g_embedding, *g_filters, to_pooled.sum(0), active.T @ error, np.array([error.sum()], np.float32)]


def calibrate(net: Network, logits: np.ndarray, toxic: np.ndarray, langs: list[str | None], counts: np.ndarray) -> None:
    """Fit the score's scale on texts that were not trained on, and a threshold by language.

    Each row stands for ``counts`` texts. A threshold is the one of the best F1 among the scores of
    the language's own texts; a language with few of either label takes that of all.
    """
    if 0 < toxic.sum() < len(toxic):
        design = np.stack([logits, np.ones_like(logits)], 1)
        beta = np.array([1.0, 0.0])
        for _ in range(30):
            p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
            # Weak pulls to the fitted scale keep few texts from making it extreme.
            grad = design.T @ (counts * (toxic - p)) - (beta - np.array([1.0, 0.0]))
            hess = (design * (counts * p * (1 - p))[:, None]).T @ design + np.eye(2)
            beta = beta + np.clip(np.linalg.solve(hess, grad), -1, 1)
        net.scale, net.offset = float(max(beta[0], 0.05)), float(beta[1])
    scores = 1 / (1 + np.exp(-np.clip(net.scale * logits + net.offset, -30, 30)))
    net.threshold = _best_threshold(scores, toxic, counts, net.threshold)
    for lang in {x for x in langs if x is not None}:
        own = np.array([x == lang for x in langs])
        hits, n = (counts * toxic)[own].sum(), counts[own].sum()
        if min(hits, n - hits) >= LEAST_CALIBRATING:
            net.thresholds[lang] = _best_threshold(scores[own], toxic[own], counts[own], net.threshold)


def _best_threshold(scores: np.ndarray, toxic: np.ndarray, counts: np.ndarray, otherwise: float) -> float:
    if not toxic.sum():
        return otherwise
    order = np.argsort(-scores, kind="stable")
    hits = np.cumsum((counts * toxic)[order])
    f1 = 2 * hits / (np.cumsum(counts[order]) + hits[-1])
    f1[:-1][scores[order][1:] == scores[order][:-1]] = 0  # equal scores fall on one side
    k = int(f1.argmax())
    below = scores[order][k + 1] if k + 1 < len(order) else 0.0
    return float((scores[order][k] + below) / 2)


def _parts(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The batch in slices of bounded text; a longer text is a slice of its own."""
    lengths = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False)
    part = (np.cumsum(lengths) - lengths) // PART_CHARS
    begins = np.append(np.flatnonzero(np.diff(part, prepend=-1)), len(part))
    for a, b in zip(begins[:-1].tolist(), begins[1:].tolist()):
        yield batch.slice(a, b - a)


def labelled_texts(
    docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, lang_col: str, label_id: str, label_col: str
) -> DataFrame:
    """All labelled texts, whole: ``id, lang, toxic, text``.

    Null ids and labels and ids with contradicting labels are left out; rows of a repeated id all
    come out, a null text as an empty one.
    """
    one = (
        narrow(labels, id=label_id, label=label_col)
        .where(F.col("id").isNotNull() & F.col("label").isNotNull())
        .groupBy("id")
        .agg(F.min("label").alias("low"), F.max("label").alias("high"))
        .where(F.col("low") == F.col("high"))
        .select("id", (F.col("low") > 0).cast("int").alias("toxic"))
    )
    texts = narrow(docs, id=id_col, text=text_col, lang=lang_col)
    return texts.join(broadcast_if_small(one), "id").select(
        "id", F.col("lang").cast("string"), "toxic", F.coalesce("text", F.lit("")).alias("text")
    )


def fitting_texts(
    docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, lang_col: str, label_id: str, label_col: str,
    most_bytes: int = MOST_BYTES,
) -> list[Row]:
    """:func:`labelled_texts` of bounded size at the driver, in order of their ids.

    If the texts have more bytes than ``most_bytes``, they are chosen by a hash of their id, so the
    share chosen shrinks as the table grows and the driver never holds more. For looking at a table;
    the query learns from all texts by :func:`learn_from`.
    """
    texts = labelled_texts(docs, labels, id_col, text_col, lang_col, label_id, label_col)
    chosen = texts.where(F.octet_length("text") <= most_bytes // 16)
    total = chosen.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    if total > most_bytes:
        chosen = chosen.where(F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < int((1 << 30) * most_bytes / total))
    return sorted(chosen.collect(), key=lambda r: (r["id"], r["text"]))


def learn(rows: list[Row]) -> Network:
    """Train and calibrate on texts at hand, whose ids tell which texts calibrate."""
    texts = [folded_words(r["text"]) for r in rows]
    toxic = np.array([r["toxic"] for r in rows], np.float64)
    part = np.array([zlib.crc32(f"part {r['id']}".encode()) % CALIBRATION_PART for r in rows], np.int64)
    fits = part > 0
    net = fit([t for t, f in zip(texts, fits) if f], toxic[fits])
    held = np.flatnonzero(~fits)
    if len(held):
        scores = np.clip(net.score(WordTable(net).pooled([texts[i] for i in held])).astype(np.float64), 1e-6, 1 - 1e-6)
        logits = np.log(scores) - np.log1p(-scores)
        calibrate(net, logits, toxic[held], [rows[i]["lang"] for i in held], np.ones(len(held)))
    return net


def learn_from(texts: DataFrame, seed: int = 7, part_bytes: int = TRAINED_BYTES) -> Network:
    """Train and calibrate on all of :func:`labelled_texts`, as :func:`learn` does on those at hand.

    The texts are dealt to parts of about ``part_bytes`` by their ids and stored. A task holds the
    words of one part as numbers; the driver holds the network and counts by bucket and by step of
    the logit, whose sizes are fixed. A round trains a copy of the network on each part, and the next
    begins from their mean, weighted by their texts.
    """
    total = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    trained = F.crc32(F.concat(F.lit("part "), F.col("id").cast("string")).cast("binary")) % CALIBRATION_PART > 0
    dealt = texts.withColumn("fits", trained).repartition(max(1, math.ceil(total / part_bytes)), "id")
    dealt = cut_lineage(dealt.sortWithinPartitions("id", "text", "lang", "toxic"))
    fitted = dealt.where("fits").select("toxic", "text")
    seen = _seen(fitted)
    net, known = _start(seen, np.random.default_rng(seed))
    if len(known):
        for passes in np.array_split(np.arange(EPOCHS), ROUNDS):
            net = _averaged(fitted, net, known, passes.tolist(), seed, int(seen[:, BUCKETS].sum()))
    net = _whole(net, known)
    _calibrate_on(dealt.where("not fits"), net)
    return net


def _coded_rows(batches: Iterator[pa.RecordBatch]) -> _Coded:
    """Rows ``toxic, text`` of a part."""
    coded = _Coded()
    for batch in batches:
        for part in _parts(batch):
            for toxic, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                coded.add(folded_words(text), toxic)
    return coded


def _seen(fitted: DataFrame) -> np.ndarray:
    """:meth:`_Coded.seen` over all parts."""

    def run(batches):
        seen = _coded_rows(batches).seen()
        some = np.flatnonzero(seen.any(0))
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(seen[0, some]), pa.array(seen[1, some])], ["bucket", "clean", "toxic"])

    counted = fitted.mapInArrow(run, "bucket long, clean long, toxic long")
    sums = counted.groupBy("bucket").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")).toArrow()
    out = np.zeros((2, BUCKETS + 1), np.int64)
    for y, name in enumerate(("clean", "toxic")):
        out[y, sums["bucket"].to_numpy()] = sums[name].to_numpy()
    return out


def _averaged(fitted: DataFrame, net: Network, known: np.ndarray, passes: list[int], seed: int, n_texts: int) -> Network:
    """Passes over every part, and the mean of the networks that come of it.

    A part changes the embeddings of its own buckets only, and only these changes travel.
    """
    begin = fitted.sparkSession.sparkContext.broadcast((net, known))  # of a fixed size
    rest = [*net.filters, net.bias, net.weight, np.array([net.shift], np.float32)]

    def run(batches):
        net, known = begin.value
        coded = _coded_rows(batches)
        if not coded.texts:
            return
        here = np.unique(_places_of(known)[coded.keys()])
        here = here[here < len(known)]
        own = Network(net.embedding[np.append(here, len(known))], [f.copy() for f in net.filters], net.bias.copy(), net.weight.copy(), net.shift)
        training = _Training(own, known[here], coded)
        rng = np.random.default_rng([seed, passes[0], TaskContext.get().partitionId()])
        for epoch in passes:
            training.run(epoch, rng)
        share = len(coded.texts) / n_texts
        moved = (own.embedding[:-1] - net.embedding[here]) * np.float32(share)
        others = np.concatenate([(p - q).ravel() for p, q in zip(training.trained[1:], rest)]) * np.float32(share)
        rows = [(-1, np.arange(len(others)), others)]
        for chunk in np.unique(here // CHUNK):
            mine = here // CHUNK == chunk
            rows.append((int(chunk), here[mine] % CHUNK, moved[mine].ravel()))
        for chunk, places, values in rows:
            lists = pa.array([places], pa.list_(pa.int32())), pa.array([values], pa.list_(pa.float32()))
            yield pa.RecordBatch.from_arrays([pa.array([chunk]), *lists], ["chunk", "places", "values"])

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Sums in double precision; their order may change the last digits only.
        sums, chunk = None, None
        for batch in batches:
            for c, places, values in zip(*(batch.column(i) for i in range(3))):
                chunk, width = c.as_py(), DIMS if c.as_py() >= 0 else 1
                values = values.values.to_numpy().astype(np.float64).reshape(-1, width)
                if sums is None:
                    sums = np.zeros((CHUNK, width))
                sums[places.values.to_numpy()] += values
        values = pa.array([sums.ravel().astype(np.float32)], pa.list_(pa.float32()))
        yield pa.RecordBatch.from_arrays([pa.array([chunk]), values], ["chunk", "values"])

    changes = fitted.mapInArrow(run, "chunk long, places array<int>, values array<float>")
    sums = changes.groupBy("chunk").applyInArrow(total, "chunk long, values array<float>").toArrow()
    begin.unpersist()
    embedding = net.embedding.copy()
    for chunk, values in zip(sums["chunk"].to_pylist(), sums["values"]):
        values = values.values.to_numpy()
        if chunk >= 0:
            part = embedding[:-1][chunk * CHUNK : (chunk + 1) * CHUNK]
            part += values.reshape(-1, DIMS)[: len(part)]
        else:
            ends = np.cumsum([p.size for p in rest])
            rest = [p + x.reshape(p.shape) for p, x in zip(rest, np.split(values[: ends[-1]], ends[:-1]))]
    *filters, bias, weight, shift = rest
    return Network(embedding, filters, bias, weight, float(shift[0]))


def _calibrate_on(held: DataFrame, net: Network) -> None:
    """:func:`calibrate` on all texts that were not trained on, counted by their rounded logits."""
    scored = score_toxicity(held.withColumn("row", F.struct("toxic", "lang")), net, "row", "text", "lang")
    score = F.greatest(F.least("score", F.lit(1 - 1e-6)), F.lit(1e-6))
    step = F.round(F.log(score / (1 - score)) * LOGIT_STEPS).cast("int")
    steps = scored.groupBy("id.lang", "id.toxic", step.alias("step")).agg(F.count(F.lit(1)).alias("n"))
    found = steps.orderBy("lang", "toxic", "step").toArrow().to_pydict()
    if found["n"]:
        logits = np.array(found["step"], np.float64) / LOGIT_STEPS
        calibrate(net, logits, np.array(found["toxic"], np.float64), found["lang"], np.array(found["n"], np.float64))


def score_toxicity(docs: DataFrame, net: Network, id_col: str, text_col: str, lang_col: str) -> DataFrame:
    """Score of each text and the verdict of its language's threshold: ``id, score, threshold, flagged``.

    The score reads nothing but the text, from its first to its last word; the language only picks
    the threshold. A null or empty text has the score of no words. Rows are independent: null or
    repeated ids come out as they are, a null or unknown language takes the threshold of all, other
    columns are ignored, an empty table gives no rows.
    """
    model = docs.sparkSession.sparkContext.broadcast(net)  # of a fixed size

    def run(batches):
        net = model.value
        table = WordTable(net)
        for batch in batches:
            for part in _parts(batch):
                pooled = table.pooled([folded_words(t) for t in part.column(1).to_pylist()])
                scores = net.score(pooled).astype(np.float64)
                limits = np.array([net.thresholds.get(x, net.threshold) for x in part.column(2).to_pylist()], np.float64)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(scores), pa.array(limits), pa.array(scores >= limits)],
                    ["id", "score", "threshold", "flagged"],
                )

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"))
    return rows.mapInArrow(run, f"id {kind}, score double, threshold double, flagged boolean")
