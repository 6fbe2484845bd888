from __future__ import annotations

import random
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from llm_fixtures import SF, make_docs, odd_rows  # noqa: F401
from pyspark.sql import functions as F

from deskloom.llm import langid, queries, toxicity

LARGER = SF.replace("0.001", "0.01")


def buckets(texts):
    return [toxicity.hashed([t], {})[0] for t in texts]


def held_out(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 5 == 0


def test_languages_of_held_out_rows(spark):
    rows = queries.op5_langid(spark, LARGER).collect()
    truth = dict(duckdb.sql(f"SELECT doc_id, lang FROM '{LARGER}/documents.parquet'").fetchall())
    assert sorted(r.doc_id for r in rows) == sorted(truth)
    assert all(r.held_out == held_out(r.doc_id) and 0 <= r.score <= 1 for r in rows)
    apart = [r for r in rows if r.held_out]
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in apart]) > 0.97


def test_toxicity_of_held_out_rows(spark):
    rows = queries.op2_toxicity(spark, LARGER).collect()
    labels = duckdb.sql(f"SELECT doc_id, toxic FROM '{LARGER}/labels.parquet' WHERE quality = 1").fetchall()
    by_id = {r.doc_id: r for r in rows}
    assert all(r.held_out == held_out(r.doc_id) and r.predicted == (r.score >= 0.5) and 0 <= r.score <= 1 for r in rows)
    toxic = [by_id[d].score for d, t in labels if t and held_out(d)]
    clean = [by_id[d].score for d, t in labels if not t and held_out(d)]
    assert np.mean([a > b for a in toxic for b in clean]) > 0.85


def test_predictions_of_held_out_rows(spark):
    """Most toxic held-out rows are called so, and hardly any clean one."""
    large = SF.replace("0.001", "0.1")
    rows = {r.doc_id: r.predicted for r in queries.op2_toxicity(spark, large).collect()}
    labels = duckdb.sql(f"SELECT doc_id, toxic FROM '{large}/labels.parquet' WHERE quality = 1").fetchall()
    toxic = [rows[d] for d, t in labels if t and held_out(d)]
    clean = [rows[d] for d, t in labels if not t and held_out(d)]
    assert len(toxic) > 50 and np.mean(toxic) > 0.95
    assert len(clean) > 500 and np.mean(clean) < 0.01


def test_numbers_are_those_of_the_layers_one_by_one():
    """Embedding, filters at every place, the largest answer of each, and the last layer, word by word."""
    rng = np.random.default_rng(4)
    texts = ["one two three", "", "two", "five six seven eight nine ten"]
    net = toxicity.train([toxicity.hashed([t], {})[0] for t in texts * 3], [0, 1, 1, 0] * 3, ["en"] * 12)
    net = net._replace(bias=rng.normal(0, 0.1, net.bias.shape).astype(np.float32))
    known: dict = {}
    words, owner = toxicity.hashed(texts, known)
    got = toxicity.logits(net, words, owner, len(texts))
    for text, number in zip(texts, got):
        # Behind a text come empty words, as many as the widest filter.
        pairs = [known[w] for w in text.split()] + [(0, 0)] * max(toxicity.WIDTHS)
        x = [np.r_[net.embedding[0][a], net.embedding[1][b]] for a, b in pairs]
        x += [np.r_[net.embedding[0][0], net.embedding[1][0]]] * max(toxicity.WIDTHS)
        features, first = [], 0
        for i, width in enumerate(toxicity.WIDTHS):
            for f in range(toxicity.FILTERS):
                answers = [sum(x[p + j] @ net.kernel[:, first + j, f] for j in range(width)) for p in range(len(pairs))]
                features.append(max(0.0, max(answers) + net.bias[i * toxicity.FILTERS + f]))
            first += width
        assert number == pytest.approx(np.array(features) @ net.out[:-1] + net.out[-1], abs=1e-4)
        assert number == pytest.approx(toxicity.logits(net, *toxicity.hashed([text], known), 1)[0], abs=1e-5)


def test_machines_are_those_of_the_objective():
    """Where nothing can be moved without a greater sum of length and costs, the machine is the exact one."""
    rng = np.random.default_rng(7)
    points = np.c_[rng.normal(0, 1, (40, 3)) + np.repeat([[1.0, 0, 0], [-1.0, 0, 0]], 20, axis=0)]
    sign = np.repeat([1, -1], 20)
    sign[3], cost = -1, np.full(40, 0.7)
    examples = [(np.array([5, 9, 77], np.uint16), p.astype(np.float32)) for p in points]
    w = langid.machine(examples, sign, cost, epochs=5000, tolerance=1e-9)
    x = np.c_[points.astype(np.float32).astype(float), np.full(40, langid.UNIT)]

    def value(v):
        return v @ v / 2 + (cost * np.maximum(0, 1 - sign * (x @ v))).sum()

    exact = np.r_[w[[5, 9, 77]], w[-1] / langid.UNIT]
    assert np.count_nonzero(w) <= 4
    for size in (1e-1, 1e-2, 1e-3):
        for _ in range(300):
            assert value(exact) <= value(exact + rng.normal(0, size, 4)) + 1e-6
    # Two points alone have a machine that can be written down: the direction between them, margins of 1.
    two = [(np.array([1], np.uint16), np.array([v], np.float32)) for v in (3.0, 1.0)]
    w = langid.machine(two, np.array([1, -1]), np.full(2, 1e6), epochs=20_000, tolerance=1e-12)
    assert w[1] * 3 + w[-1] == pytest.approx(1, abs=1e-3) and w[1] + w[-1] == pytest.approx(-1, abs=1e-3)


def test_examples_are_of_whole_texts(monkeypatch):
    text = "Ein Haus, two words; " * 50
    index, share = langid.example(text)
    gram = langid.grams([text])[0]
    assert dict(zip(index.tolist(), share.tolist())) == pytest.approx({g: n / len(gram) for g, n in Counter(gram.tolist()).items()})
    assert [len(x) for x in langid.example(None)] == [0, 0] == [len(x) for x in langid.example("12 !")]
    monkeypatch.setattr(langid, "STRETCH", 21)
    assert set(langid.example(text)[0].tolist()) <= set(index.tolist())


def test_few_rows_of_a_class_meet_in_one_task(spark):
    """Each class gives the least hashes of its ids, as many as it should, whatever its size."""
    rows = spark.range(30_000).selectExpr("if(id % 3 = 0, 'a', if(id % 100 = 1, 'b', 'c')) as lang", "id as doc_id")
    got = langid.least_hashes(rows, "lang", F.when(F.col("lang") == "b", 10_000).otherwise(50)).collect()
    every = rows.withColumn("h", F.xxhash64("doc_id")).collect()
    for name, most in (("a", 50), ("b", 10_000), ("c", 50)):
        least = sorted((r.h, r.doc_id) for r in every if r.lang == name)[:most]
        assert sorted(r.doc_id for r in got if r.lang == name) == sorted(d for _, d in least)


def test_only_texts_decide(spark, make_docs):
    """Labels of held-out rows, and languages, sources and ids of scored rows, change nothing."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    apart = langid.held_out(F.col("doc_id"))
    turned = labels.withColumn("toxic", F.when(apart, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    blank = docs.withColumn("lang", F.when(apart, "xx").otherwise(F.col("lang")))
    nets = [toxicity.fit(docs, x) for x in (labels, turned)] + [toxicity.fit(blank, labels)]
    for other in nets[1:]:
        assert all((a == b).all() for a, b in zip(nets[0], other))
    one, two = langid.fit(docs), langid.fit(blank)
    assert (one.weights == two.weights).all() and one.names == two.names
    moved = docs.select((F.col("doc_id") + 7).alias("doc_id"), "text", F.lit("zz").alias("lang"), F.lit("q").alias("source"))
    for run in (lambda d: langid.predict(d, one), lambda d: toxicity.score(d, nets[0])):
        a = sorted(map(tuple, run(docs).drop("doc_id", "lang", "source", "n_chars").collect()))
        assert a == sorted(map(tuple, run(moved).drop("doc_id", "lang", "source").collect()))


def test_odd_rows(spark, make_docs):
    docs = make_docs(odd_rows()).selectExpr("*", "1 as Score", "2 as predicted")
    model = langid.fit(spark.read.parquet(f"{SF}/documents.parquet"))
    rows = {(r.doc_id, r.text): r for r in langid.predict(docs, model).collect()}
    for (_, text), r in rows.items():
        assert (r.lang_pred == "und") == (not any(map(str.isalpha, text or "")))
    assert langid.predict(docs, langid.fit(docs.limit(0))).where("lang_pred = 'und' and score = 0").count() == len(odd_rows())
    single = langid.fit(make_docs([(i, "some words", "en", "a") for i in range(20)]))
    assert {r.lang_pred for r in langid.predict(docs, single).collect()} == {"en", "und"}
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 10)], "doc_id long, toxic int")
    for net in (toxicity.fit(docs.limit(0), labels), toxicity.fit(docs, labels.limit(0)), toxicity.fit(docs, labels)):
        scored = toxicity.score(docs, net).collect()
        assert len(scored) == len(odd_rows()) and all(0 <= r.score <= 1 for r in scored)
    assert toxicity.score(docs.limit(0), None).count() == langid.predict(docs.limit(0), model).count() == 0


def test_thresholds_count_all_labelled_rows(spark, make_docs, monkeypatch):
    """However few rows are learned from, a language's threshold errs least over all its labelled rows."""
    monkeypatch.setattr(toxicity, "TOXIC_ROWS", 40)
    monkeypatch.setattr(toxicity, "CLEAN_ROWS", 40)
    rng = random.Random(5)
    words = [a + b for a in "bdfgklmnprst" for b in ("ado", "ela", "iru", "osa")]
    rows = []
    for i in range(1200):
        some = rng.choices(words, k=20)
        # Few toxic rows, whose mark is at the end of a long text; and many clean rows that hold it too.
        rows.append((i, " ".join(some * (220 if i % 8 == 0 else 1) + ["awful"] * (i % 8 == 0 or i % 16 == 1)), "en", "a"))
    docs = make_docs(rows)
    labels = spark.createDataFrame([(i, int(i % 8 == 0)) for i in range(1200)], "doc_id long, toxic int")
    sample = toxicity.training_rows(docs, labels)
    awful = toxicity.hashed(["awful"], {})[0][0].tolist()
    gap = max(toxicity.WIDTHS)
    assert len(sample.ids) == 80 and all(d % 8 == 0 for d, p in zip(sample.ids, sample.parts) if len(p) > 4000)
    assert sum(len(p) == 4401 + gap and p[-gap - 1].tolist() == awful for p in sample.parts) == 40
    net = toxicity.fit(docs, labels)
    seen = [(r, int(r.doc_id % 8 == 0)) for r in toxicity.rate(docs, net).collect() if not held_out(r.doc_id) and r.doc_id not in sample.ids]
    assert len(seen) > 800
    edges = np.linspace(-toxicity.FURTHEST, toxicity.FURTHEST, toxicity.BINS + 1)
    own = toxicity.unseen(net, sample)
    assert sum(int(n.sum()) for n in own.values()) == 80
    z = np.r_[[r._logit for r, _ in seen], *[np.repeat(edges[:-1], n) for n in own.values()]]
    label = np.r_[[t for _, t in seen], *[[t] * int(n.sum()) for (_, t), n in own.items()]]
    errors = lambda at: ((z >= at) != label).sum()
    assert errors(net.thresholds[0]) == min(map(errors, edges))


def test_thresholds_follow_the_share_of_toxic_rows():
    net = toxicity.train(buckets(["good day", "bad day"] * 4), [0, 1] * 4, ["en"] * 8)
    clean, toxic = np.zeros((2, toxicity.BINS), int)
    clean[[1000, 1010]], toxic[[1005, 1020]] = (900, 40), (35, 60)
    edges = np.linspace(-toxicity.FURTHEST, toxicity.FURTHEST, toxicity.BINS + 1)
    often = toxicity.calibrated(net, {(0, 0): clean, (0, 1): toxic}).thresholds[0]
    assert edges[1010] < often <= edges[1020]
    seldom = toxicity.calibrated(net, {(0, 0): clean // 10, (0, 1): toxic}).thresholds[0]
    assert edges[1000] < seldom <= edges[1005]


def test_long_texts_are_read_to_their_end(monkeypatch):
    rng = random.Random(2)
    clean = [" ".join(rng.choices([f"word{chr(97 + i)}" for i in range(26)], k=40)) for _ in range(300)]
    toxic = [c + " awful" for c in clean[:100]]
    net = toxicity.train(buckets(clean[100:] + toxic), [0] * 200 + [1] * 100, ["en"] * 300)
    known: dict = {}
    words, owner = toxicity.hashed([" ".join(clean), " ".join(clean) + " awful"], known)
    whole = toxicity.logits(net, words, owner, 2)
    assert whole[1] > whole[0]
    monkeypatch.setattr(toxicity, "STRETCH", 7)
    assert np.allclose(toxicity.logits(net, words, owner, 2), whole)


def test_families_and_votes():
    texts = {"en": "the house and the garden", "de": "das haus und der garten", "nl": "het huis en de tuin", "fr": "la maison et le jardin", "ru": "дом и сад"}
    model = langid.Model([langid.example(t) for t in texts.values() for _ in range(5)], [x for x in texts for _ in range(5)])
    assert model.names == ["germanic", "romance", "slavic"]
    assert len(model.pairs) == 3
    assert model.predict(list(texts.values()))[0] == list(texts)
