from __future__ import annotations

import hashlib

import numpy as np
from hypothesis import given
from hypothesis import strategies as st
from llm_fixtures import SF, make_docs, odd_rows, sample  # noqa: F401

from deskloom.llm import phrases, queries


def edited(docs):
    """By document: the text with its last third replaced, in the order of falling ids."""
    order = sorted(docs, key=lambda d: -d[0])
    out = {}
    for i, (doc_id, text) in enumerate(order):
        text, other = text or "", order[(i + 1) % len(order)][1] or ""
        n = len(text) // 3
        out[doc_id] = text[: len(text) - n] + other[:n]
    return out


def test_query_matches_brute_force(spark, sample):
    want = edited([(d["doc_id"], d["text"]) for d in sample])
    texts = {d["doc_id"]: d["text"] for d in sample}
    rows = queries.op4_phrases(spark, SF).collect()
    assert len(rows) == len(sample)
    follow = dict(zip(sorted(texts, reverse=True), sorted(texts, reverse=True)[1:] + [max(texts)]))
    prints = {r.doc_id: r.fingerprint for r in rows}
    for r in rows:
        assert r.n_chars == len(texts[r.doc_id])
        assert r.edited_sha256 == hashlib.sha256(want[r.doc_id].encode()).hexdigest()
        assert r.fingerprint == phrases.fingerprints([texts[r.doc_id]])[0]
        assert r.edited_fingerprint == phrases.fingerprints([want[r.doc_id]])[0]
        assert r.near_edited == phrases.likeness(r.fingerprint, r.edited_fingerprint)
        assert r.near_next == phrases.likeness(r.fingerprint, prints[follow[r.doc_id]])
    long = [r for r in rows if r.n_chars >= 300]
    assert np.mean([r.near_edited for r in long]) > 0.4
    assert np.mean([r.near_next for r in long]) < 0.1
    assert all(r.near_edited > r.near_next for r in long if texts[r.doc_id] != texts[follow[r.doc_id]])


def names(text):
    return np.frombuffer(text.encode("utf-32-le"), "<u4").astype(np.uint64)


@given(st.text("abcdef ", min_size=1, max_size=200))
def test_labels_differ_from_their_neighbours(text):
    code = names("".join(c for i, c in enumerate(text) if not i or c != text[i - 1]))
    label = phrases.labels(code, np.array([0]), np.array([len(code) - 1]))
    assert label.max() <= 2
    assert (label[2:] != label[1:-1]).all()


@given(st.lists(st.text("ab", max_size=60), min_size=1, max_size=6))
def test_texts_are_parsed_apart(texts):
    assert phrases.fingerprints(texts) == [phrases.fingerprints([t])[0] for t in texts]


def test_equal_substrings_share_names_at_any_offset(sample):
    text = max((d["text"] for d in sample), key=len)[:4000]
    sets = []
    for before in ("", "x", "some other words stand here first. "):
        level, owner = names(before + text), np.zeros(len(before + text), int)
        for _ in range(3):
            level, owner = phrases.parse(level, owner)
        sets.append(set(level.tolist()))
    assert len(sets[0]) > 100
    for other in sets[1:]:
        assert len(sets[0] & other) > 0.95 * len(sets[0])


def test_odd_rows(make_docs):
    docs = make_docs(odd_rows()).selectExpr("*", "1 as FINGERPRINT", "2 as _range")
    rows = phrases.with_next(docs).collect()
    assert len(rows) == len(odd_rows())
    by_text = {r.text: r.fingerprint for r in phrases.fingerprint(docs).collect()}
    assert by_text[None] == by_text[""] == phrases.fingerprints([""])[0]
    assert phrases.likeness(by_text[""], by_text[""]) == 1.0
    assert phrases.likeness(by_text[""], by_text["one two"]) == 0.0
    assert {r.fingerprint for r in rows if r.doc_id == 4} == {by_text["one two"]}
    assert phrases.with_next(docs.limit(0)).count() == 0
    alone = phrases.with_next(make_docs([(7, "abcdef", "en", "a")])).first()
    assert alone.edited_sha256 == hashlib.sha256(b"abcdab").hexdigest() and alone.near_next == 1.0


def test_rows_that_share_an_id_are_dealt_apart(spark, make_docs):
    """A third of all rows has one id, half of those one text: no range holds them all, and one row follows each."""
    rows = [(7 if i % 3 == 0 else i, "the same text" if i % 6 == 0 else f"text number {i} of many", "en", "a") for i in range(6000)]
    docs = make_docs(rows)
    dealt = phrases._in_descending_ranges(docs.select("doc_id", "text")).groupBy("_range", "_ghost").count().collect()
    assert sum(r["count"] for r in dealt if not r._ghost) == len(rows)
    assert max(r["count"] for r in dealt if not r._ghost) < 4 * len(rows) / len(dealt) * 2
    assert all(r["count"] == 1 for r in dealt if r._ghost)
    got = phrases.with_next(docs).collect()
    assert sorted((r.doc_id, r.n_chars) for r in got) == sorted((d, len(t)) for d, t, *_ in rows)
    # Within an id texts follow each other in one order, each edited by the next; the last by the next lower id's.
    texts = [t for d, t, *_ in rows if d == 7]
    edits = {hashlib.sha256((t[: len(t) - len(t) // 3] + o[: len(t) // 3]).encode()).hexdigest() for t in set(texts) for o in {*texts, rows[5][1]}}
    assert {r.edited_sha256 for r in got if r.doc_id == 7} <= edits
    same = [r for r in got if r.doc_id == 7 and r.n_chars == len("the same text")]
    assert sum(r.near_next == 1.0 for r in same) == len(same) - 1
