"""Toxicity by a convolutional text classifier trained in numpy.

A word's embedding is two hashed halves, so that two words rarely share both. Filters of several widths run
over the words of a text, each takes the largest answer it finds anywhere, and a linear layer makes one
number of these. Embeddings start from how much more often a bucket is found in toxic texts than chance
allows (0 for the rare ones) and are trained with the rest by Adam on the logistic loss.

Learned are whole texts of labelled rows whose id is not held out (crc32 of the id as text, modulo 5, is not
0), at most ``TOXIC_ROWS`` and ``CLEAN_ROWS`` of them by hash of their id. Tasks hash their words; the driver gets
numbers of buckets.

Thresholds are calibrated by language on all labelled rows that are not held out, however many: tasks score
them, and what is gathered is how many toxic and clean rows of a language have their number in each of ``BINS``
bins of equal width. Rows that were learned from are told too well by what learned them: each counts with the
number that a network learned from the other half of them gives it. For each language the edge that tells its
toxic rows best becomes 0.5. A text's language is guessed from its words, so a score depends on the text alone; a
language with fewer than ``CALIBRATION_LEAST`` toxic or clean rows in all uses the threshold of all languages.

Scores are of whole texts. Null texts and texts without words score as a text none of whose words is known.
Without labelled rows of both kinds every score is 0. Repeated rows score the same; where ids repeat, each text
that a label's id names is an example.
"""

from __future__ import annotations

import re
import zlib
from typing import NamedTuple

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from deskloom.llm.common import Stage, add_columns
from deskloom.llm.langid import held_out, least_hashes

WORDS = re.compile(r"[^\W\d_]+")
BITS = 17
HALF = 4
WIDTHS = (1, 2, 3)
FILTERS = 8
EPOCHS = 8
BATCH = 128
TOXIC_ROWS = 3000
CLEAN_ROWS = 5000
CALIBRATION_LEAST = 40
# Bins of a histogram of numbers, and the number its middle bins end at on either side; further ones count as its ends.
BINS = 2048
FURTHEST = 32.0
SEED = 11
# Words run through the filters at once, and bytes of text in a block: they bound a task's memory.
STRETCH = 1 << 16
SCORED_BYTES = 1 << 20

RATED = T.StructType([T.StructField("_logit", T.FloatType()), T.StructField("_language", T.IntegerType())])
FIELDS = T.StructType([T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])


class Network(NamedTuple):
    embedding: np.ndarray  # (2, buckets, HALF)
    kernel: np.ndarray  # (2 * HALF, sum of widths, FILTERS)
    bias: np.ndarray  # (len(WIDTHS) * FILTERS,)
    out: np.ndarray  # (len(WIDTHS) * FILTERS + 1,)
    languages: np.ndarray  # (buckets, languages): log-probabilities of words
    thresholds: np.ndarray  # one per language


def hashed(texts: list, known: dict[str, tuple[int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """Two bucket numbers per word, each text followed by empty words so that no filter spans two texts;
    and the number of the text each belongs to. Bucket 0 is the empty word's."""
    import xxhash

    if len(known) > 500_000:
        known.clear()
    gap = max(WIDTHS)
    pairs, lengths = [], []
    for t in texts:
        words = WORDS.findall((t or "").lower())
        for w in words:
            if w not in known:
                h = xxhash.xxh3_64_intdigest(w)
                known[w] = ((h & (1 << BITS) - 1) or 1, (h >> 32 & (1 << BITS) - 1) or 1)
        pairs += map(known.__getitem__, words)
        pairs += [(0, 0)] * gap
        lengths.append(len(words) + gap)
    return np.array(pairs, np.int32).reshape(-1, 2), np.repeat(np.arange(len(texts)), lengths)


def convolve(net: Network, words: np.ndarray) -> np.ndarray:
    """Answers of all filters at every position: (positions, filters). The last ``gap`` - 1 see no further."""
    x = np.concatenate([net.embedding[0][words[:, 0]], net.embedding[1][words[:, 1]]], axis=1)
    y = np.tensordot(x, net.kernel, 1)
    out = np.empty((len(words), len(WIDTHS) * FILTERS), np.float32)
    at = 0
    for i, width in enumerate(WIDTHS):
        part = y[:, at].copy()
        for j in range(1, width):
            part[:-j] += y[j:, at + j]
        out[:, i * FILTERS : (i + 1) * FILTERS] = part
        at += width
    # What begins at an empty word sees nothing of its text, and must not see the next one.
    out[words[:, 0] == 0] = 0
    return np.maximum(out + net.bias, 0)


def pooled(net: Network, words: np.ndarray, owner: np.ndarray, texts: int) -> np.ndarray:
    """The largest answer of every filter in every text, by stretches of bounded size."""
    best = np.zeros((texts, len(WIDTHS) * FILTERS), np.float32)
    reach = max(WIDTHS) - 1
    for start in range(0, len(words), STRETCH):
        answers = convolve(net, words[start : start + STRETCH + reach])[:STRETCH]
        mine = owner[start : start + STRETCH]
        first = np.flatnonzero(np.r_[True, mine[1:] != mine[:-1]])
        np.maximum.at(best, mine[first], np.maximum.reduceat(answers, first, axis=0))
    return best


def peaks(net: Network, words: np.ndarray, owner: np.ndarray, texts: int) -> tuple[np.ndarray, np.ndarray]:
    """The largest answer of every filter in every text, and the first position where it is found."""
    best = np.zeros((texts, len(WIDTHS) * FILTERS), np.float32)
    place = np.zeros(best.shape, np.int64)
    reach = max(WIDTHS) - 1
    for start in range(0, len(words), STRETCH):
        answers = convolve(net, words[start : start + STRETCH + reach])[:STRETCH]
        mine = owner[start : start + STRETCH]
        first = np.flatnonzero(np.r_[True, mine[1:] != mine[:-1]])
        own, part = mine[first], np.repeat(np.arange(len(first)), np.diff(np.r_[first, len(mine)]))
        top = np.maximum.reduceat(answers, first, axis=0)
        found = np.where(answers == top[part], np.arange(len(mine), dtype=np.int32)[:, None], np.int32(STRETCH))
        at = start + np.minimum.reduceat(found, first, axis=0)
        place[own] = np.where(top > best[own], at, place[own])
        best[own] = np.maximum(best[own], top)
    return best, place


def logits(net: Network, words: np.ndarray, owner: np.ndarray, texts: int) -> np.ndarray:
    return pooled(net, words, owner, texts) @ net.out[:-1] + net.out[-1]


def guessed(net: Network, words: np.ndarray, owner: np.ndarray, texts: int) -> np.ndarray:
    """The number of the likeliest language of each text."""
    likely = np.stack([np.bincount(owner, column[words[:, 0]], texts) for column in net.languages.T], axis=1)
    return likely.argmax(axis=1)


def _start(words: np.ndarray, owner: np.ndarray, toxic: np.ndarray, rng) -> np.ndarray:
    """Embeddings whose first number says how surely a bucket is found in toxic texts."""
    out = np.zeros((2, 1 << BITS, HALF), np.float32)
    p = toxic.mean()
    for side in (0, 1):
        bucket, text = np.divmod(np.unique(words[:, side].astype(np.int64) * len(toxic) + owner), len(toxic))
        n = np.bincount(bucket, minlength=1 << BITS)
        t = np.bincount(bucket, toxic[text], 1 << BITS)
        sure = (t - n * p) / np.sqrt(n * p * (1 - p) + 4)
        out[side, :, 0] = np.where((n >= 3) & (np.abs(sure) >= 2), np.clip(sure, -4, 4) / 4, 0)
        out[side, :, 1:] = rng.normal(0, 0.05, (1 << BITS, HALF - 1)) * (n >= 3)[:, None]
        out[side, 0] = 0
    return out


class _Adam:
    def __init__(self, shape):
        self.m, self.v, self.n = np.zeros(shape), np.zeros(shape), 0

    def step(self, gradient, rate=0.01):
        self.n += 1
        self.m = 0.9 * self.m + 0.1 * gradient
        self.v = 0.99 * self.v + 0.01 * gradient**2
        return rate * (self.m / (1 - 0.9**self.n)) / (np.sqrt(self.v / (1 - 0.99**self.n)) + 1e-6)


def train(parts: list[np.ndarray], toxic: list[int], langs: list[str | None]) -> Network | None:
    """A network of labelled texts, each the bucket numbers of its words; None where they are not of both kinds."""
    label = np.array(toxic, float)
    if not len(label) or label.min() == label.max():
        return None
    rng = np.random.default_rng(SEED)
    rest = rng.permutation(len(parts))

    def batch(rows):
        return np.concatenate([parts[i] for i in rows]), np.repeat(np.arange(len(rows)), [len(parts[i]) for i in rows])

    embedding = _start(*batch(rest), label[rest], rng)
    kernel = rng.normal(0, 0.3, (2 * HALF, sum(WIDTHS), FILTERS)).astype(np.float32)
    kernel[[0, HALF]] = np.abs(kernel[[0, HALF]]) + 0.3
    bias = np.zeros(len(WIDTHS) * FILTERS, np.float32)
    out = np.r_[np.full(len(WIDTHS) * FILTERS, 0.2), -1.0].astype(np.float32)
    names = sorted({x for x in langs if x is not None}) or [""]
    number = {x: i for i, x in enumerate(names)}
    counts = np.full((1 << BITS, len(names)), 0.1)
    for i in rest:
        if langs[i] in number:
            np.add.at(counts[:, number[langs[i]]], parts[i][:, 0], 1)
    counts[0] = 1
    likely = np.log(counts / counts.sum(axis=0)).astype(np.float32)
    net = Network(embedding, kernel, bias, out, likely, np.zeros(len(names), np.float32))
    adams = [_Adam(p.shape) for p in (kernel, bias, out)]
    squares = np.full(embedding.shape[:2], 1e-3)  # of the embeddings' gradients, by bucket
    weight = np.where(label > 0, 0.5 / label[rest].mean(), 0.5 / (1 - label[rest].mean()))
    firsts = np.cumsum([0, *WIDTHS])
    for _ in range(EPOCHS):
        for start in range(0, len(rest), BATCH):
            rows = rng.permutation(rest)[:BATCH]
            words, owner = batch(rows)
            best, at = peaks(net, words, owner, len(rows))
            z = best @ net.out[:-1] + net.out[-1]
            slope = (1 / (1 + np.exp(-z)) - label[rows]) * weight[rows] / len(rows)
            d_out = np.r_[best.T @ slope, slope.sum()] + 1e-4 * net.out
            d_best = slope[:, None] * net.out[:-1] * (best > 0)
            d_kernel, d_bias = 1e-4 * net.kernel, d_best.sum(axis=0)
            d_words: list = []
            for f in range(best.shape[1]):
                i, k = divmod(f, FILTERS)
                for j in range(WIDTHS[i]):
                    place = np.minimum(at[:, f] + j, len(words) - 1)
                    x = np.concatenate([net.embedding[0][words[place, 0]], net.embedding[1][words[place, 1]]], axis=1)
                    d_kernel[:, firsts[i] + j, k] += d_best[:, f] @ x
                    d_words.append((words[place], d_best[:, f, None] * net.kernel[:, firsts[i] + j, k]))
            for p, d, adam in zip((net.kernel, net.bias, net.out), (d_kernel, d_bias, d_out), adams):
                p -= adam.step(d).astype(np.float32)
            bucket, d = np.concatenate([b for b, _ in d_words]), np.concatenate([x for _, x in d_words])
            for side in (0, 1):
                seen, back = np.unique(bucket[:, side], return_inverse=True)
                total = np.zeros((len(seen), HALF))
                np.add.at(total, back, d[:, side * HALF : (side + 1) * HALF])
                squares[side, seen] += (total**2).mean(axis=1)
                step = 0.05 * total / np.sqrt(squares[side, seen])[:, None]
                net.embedding[side, seen] -= np.where(seen[:, None] > 0, step, 0).astype(np.float32)
    return net


def bins(logit: np.ndarray) -> np.ndarray:
    """The bin of each number; further ones than the last edges fall into the end bins."""
    return np.clip(np.floor((logit.astype(np.float64) + FURTHEST) * (BINS / (2 * FURTHEST))), 0, BINS - 1).astype(np.int64)


def calibrated(net: Network, counts: dict[tuple[int, int], np.ndarray]) -> Network:
    """The network with the threshold of each language that tells its rows best, from counts by bin of rows of
    (language, toxic)."""
    edges = np.linspace(-FURTHEST, FURTHEST, BINS + 1)

    def best(clean: np.ndarray, toxic: np.ndarray) -> float:
        # Errors if all from bin i on are called toxic; the middle of the best edges.
        errors = np.r_[0, np.cumsum(toxic)] + np.r_[np.cumsum(clean[::-1])[::-1], 0]
        places = np.flatnonzero(errors == errors.min())
        return float(edges[places[len(places) // 2]])

    none = np.zeros(BINS, np.int64)
    by_lang = [(counts.get((k, 0), none), counts.get((k, 1), none)) for k in range(len(net.thresholds))]
    everyone = best(sum(c for c, _ in by_lang), sum(t for _, t in by_lang))
    enough = [min(c.sum(), t.sum()) >= CALIBRATION_LEAST for c, t in by_lang]
    return net._replace(thresholds=np.array([best(*r) if e else everyone for r, e in zip(by_lang, enough)], np.float32))


def known_labels(labels: DataFrame) -> DataFrame:
    """The labels that may be learned from, one row (doc_id, toxic) per id."""
    known = labels.where(F.col("toxic").isin(0, 1) & ~held_out(F.col("doc_id")))
    return known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))


class Sample(NamedTuple):
    """Labelled texts to learn from: their ids, bucket numbers of their words, labels and languages."""

    ids: list
    parts: list[np.ndarray]
    toxic: list[int]
    langs: list


def training_rows(docs: DataFrame, labels: DataFrame) -> Sample:
    """The whole texts of at most ``TOXIC_ROWS`` and ``CLEAN_ROWS`` labelled ids, hashed in tasks."""
    most = F.when(F.col("toxic") == 1, TOXIC_ROWS).otherwise(CLEAN_ROWS)
    chosen = least_hashes(known_labels(labels), "toxic", most)
    texts = docs.where("text is not null").select("doc_id", "text", "lang")
    # No more ids than there are training rows: a side of known size.
    texts = texts.join(F.broadcast(chosen), "doc_id")
    fields = T.StructType([T.StructField("_words", T.BinaryType())])

    def make():
        known: dict = {}
        return lambda these: {"_words": [hashed([t], known)[0].tobytes() for t in these]}

    rows = [tuple(r) for r in add_columns(texts, fields, make, drop=("text",)).select("doc_id", "_words", "toxic", "lang").collect()]
    rows.sort(key=lambda r: (r[0], bytes(r[1]), r[3] or ""))
    return Sample([r[0] for r in rows], [np.frombuffer(r[1], np.int32).reshape(-1, 2) for r in rows], [r[2] for r in rows], [r[3] for r in rows])


def unseen(net: Network, sample: Sample) -> dict:
    """Counts by bin of the sampled rows of (language, toxic), each scored by a network that did not learn from it:
    one learned from one half of the ids scores the other."""
    counts: dict = {}
    # Halves by hash of the id, so that one id's texts are never in both.
    half = np.array([zlib.crc32(f"half {i}".encode()) % 2 for i in sample.ids], int)
    toxic = np.array(sample.toxic, int)
    for side in (0, 1):
        mine = np.flatnonzero(half == side)
        other = train([sample.parts[i] for i in mine], toxic[mine].tolist(), [sample.langs[i] for i in mine]) if len(mine) else None
        for at in range(0, len(half), BATCH):
            rows = np.array([i for i in range(at, min(at + BATCH, len(half))) if half[i] != side], int)
            if not len(rows):
                continue
            words = np.concatenate([sample.parts[i] for i in rows])
            owner = np.repeat(np.arange(len(rows)), [len(sample.parts[i]) for i in rows])
            z = logits(other or net, words, owner, len(rows))
            for language, label, place in zip(guessed(net, words, owner, len(rows)).tolist(), toxic[rows].tolist(), bins(z).tolist()):
                counts.setdefault((language, label), np.zeros(BINS, np.int64))[place] += 1
    return counts


def calibrate(rated: DataFrame, labels: DataFrame, net: Network, sample: Sample) -> Network:
    """The network with thresholds of all labelled rows among ``rated`` (doc_id, and what :func:`rate` adds); those it
    learned from count as networks of half of them see the other half."""
    counts = unseen(net, sample)
    place = F.floor((F.col("_logit").cast("double") + FURTHEST) * (BINS / (2 * FURTHEST)))
    place = F.greatest(F.lit(0), F.least(F.lit(BINS - 1), place)).cast("int").alias("bin")
    # Texts stay where they are: what meets the labels is an id and two numbers.
    learned = rated.sparkSession.createDataFrame([(i,) for i in sorted(set(sample.ids))], T.StructType([labels.schema["doc_id"]]))
    others = known_labels(labels).join(F.broadcast(learned), "doc_id", "left_anti")
    rows = rated.select("doc_id", "_language", place).join(others, "doc_id")
    for language, toxic, at, n in rows.groupBy("_language", "toxic", "bin").count().collect():
        counts.setdefault((language, toxic), np.zeros(BINS, np.int64))[at] += n
    return calibrated(net, counts)


def fit(docs: DataFrame, labels: DataFrame) -> Network | None:
    """A network of the labelled documents: ``docs`` (doc_id, text, lang), ``labels`` (doc_id, toxic)."""
    sample = training_rows(docs, labels)
    net = train(*sample[1:])
    return net and calibrate(rate(docs.select("doc_id", "text").where(~held_out(F.col("doc_id"))), net), labels, net, sample)


def rate(docs: DataFrame, net: Network) -> DataFrame:
    """``docs`` with ``_logit`` and ``_language``, what the network says of ``text`` before any threshold."""
    sent = docs.sparkSession.sparkContext.broadcast(tuple(net))

    def make():
        own = Network(*sent.value)
        known: dict = {}

        def compute(texts):
            if not texts:
                return {"_logit": [], "_language": []}
            words, owner = hashed(texts, known)
            z = logits(own, words, owner, len(texts)).astype(np.float32)
            return {"_logit": z, "_language": guessed(own, words, owner, len(texts)).astype(np.int32)}

        return compute

    return add_columns(docs, RATED, make, limit=SCORED_BYTES)


def judge(rated: DataFrame, net: Network) -> DataFrame:
    """Rated documents with ``score`` and ``predicted`` (replacing such columns) in place of what was rated."""
    thresholds = net.thresholds.astype(np.float64)

    def make():
        def compute(logit, language):
            z = np.array(logit, np.float64) - thresholds[np.array(language, np.int64)]
            p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
            return {"score": p, "predicted": (p >= 0.5).astype(np.int32)}

        return compute

    return add_columns(rated, FIELDS, make, ("_logit", "_language"), drop=tuple(RATED.names))


def score(docs: DataFrame, net: Network | None) -> DataFrame:
    """``docs`` with ``score`` and ``predicted``, from ``text`` alone (replacing such columns)."""
    if net is None:
        kept = [F.col(f"`{c}`") for c in docs.columns if c.lower() not in FIELDS.names]
        return docs.select(*kept, F.lit(0.0).alias("score"), F.lit(0).alias("predicted"))
    return judge(rate(docs, net), net)


def fit_and_score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """What :func:`fit` and :func:`score` give for ``docs`` (doc_id, text, lang, ...), rated once; without text and lang."""
    sample = training_rows(docs, labels)
    net = train(*sample[1:])
    if net is None:
        return score(docs, None).drop("text", "lang")
    rated = Stage(docs.sparkSession)(rate(docs.drop("lang"), net).drop("text"))
    return judge(rated, calibrate(rated, labels, net, sample))
