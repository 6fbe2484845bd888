from __future__ import annotations

import math
import random
import re
import unicodedata
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_fixtures import SF, make_docs, odd_rows, sample  # noqa: F401

from deskloom.llm import fertility, queries


def brute_repeated(words):
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    hit = set()
    for i in range(len(words) - 7):
        if windows[tuple(words[i : i + 8])] > 1:
            hit.update(range(i, i + 8))
    return len(hit)


@given(st.lists(st.sampled_from("ab"), max_size=60))
def test_repeated_words_of_two_letters(words):
    assert fertility.repeated_words(words) == brute_repeated(words)


def test_repeated_words_of_longer_lists():
    rng = random.Random(3)
    for _ in range(30):
        words = [str(rng.randrange(500)) for _ in range(300)]
        at = rng.randrange(200)
        words[at + 50 : at + 50] = words[at : at + rng.randrange(5, 40)]
        assert fertility.repeated_words(words) == brute_repeated(words)


def test_base_columns_match_brute_force(spark, sample):
    got = {r.doc_id: r for r in queries.op1_fertility(spark, SF).collect()}
    assert len(got) == len(sample)
    for doc in sample:
        words = re.findall(r"[^\x20\x09-\x0D]+", doc["text"])
        lines = [x for x in doc["text"].split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        row = got[doc["doc_id"]]
        assert row.n_words == len(words)
        assert row.word_chars == sum(map(len, words))
        assert row.n_symbols == len(re.findall(r"[#*$%&|<>]", doc["text"]))
        assert row.n_dup_lines == sum(n - 1 for n in Counter(lines).values())
        assert row.n_repeat_words == brute_repeated(words)
        assert row.base_failed == (len(words) < 20 or 100 * row.n_repeat_words > 30 * len(words))
        assert not (row.base_failed and row.kept)


PATHS = fertility.public_vocabularies()
CHUNKS = fertility.Chunks(*PATHS)
PARTS = st.sampled_from([" ", "  ", "\u2581", " \u2581", "\u2581 ", "\n", "\r\n ", "\u3000", "\xa0", "word", "the", "日本語", "<s>", "é", "\U0001f600"])
TEXTS = st.lists(st.one_of(PARTS, st.text(max_size=6), st.text(st.sampled_from("ab1,.' "), max_size=12)), max_size=14).map("".join)


def whole_measures(text):
    """The measures from the tokens of the whole text."""
    many, ids = len(CHUNKS.many.encode_ordinary(text)), CHUNKS.pieces.encode(text)
    if not ids:
        return 0, many, 0.0, 0.0
    shares = [n / len(ids) for n in Counter(ids).values()]
    is_byte = [CHUNKS.pieces.is_byte(i) and CHUNKS.pieces.id_to_piece(i) != "<0x0A>" for i in ids]
    return len(ids), many, sum(is_byte) / len(ids), -sum(p * math.log2(p) for p in shares)


@settings(max_examples=1500)
@given(st.lists(TEXTS, max_size=4))
def test_measures_are_those_of_whole_texts(texts):
    for got, text in zip(CHUNKS.measure(texts), texts, strict=True):
        assert got == pytest.approx(whole_measures(text)), text


@settings(max_examples=1000)
@given(st.text(st.sampled_from("ab \n\t\x1c\x85\xa0\u2003\u3000\u2581é"), max_size=20))
def test_texts_are_cut_at_safe_spaces_only(text):
    assert fertility.chunks_of(text) == fertility.SAFE.split(text)


def test_long_runs_are_measured_whole_and_chunks_are_forgotten(monkeypatch):
    rng = random.Random(4)
    long = ["x" * 30_000, "".join(rng.choices("日本語文章漢字学校", k=9000)), "".join(rng.choices("ab01", k=9000)) + " end"]
    assert [g == pytest.approx(whole_measures(t)) for g, t in zip(CHUNKS.measure(long), long)] == [True] * 3
    monkeypatch.setattr(fertility, "REMEMBERED", 10)
    for _ in range(3):
        texts = [" ".join(str(rng.random()) for _ in range(30)) for _ in range(3)]
        assert [g == pytest.approx(whole_measures(t)) for g, t in zip(CHUNKS.measure(texts), texts)] == [True] * 3


@given(st.text(st.sampled_from("a#$ é日\t\n\r\x0b\x0c\x1c\x85\xa0\u2028\u3000"), max_size=60))
def test_base_counts_of_any_white_space(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    want = (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), brute_repeated(words))
    assert fertility.base_counts(text) == want


@given(st.text(max_size=40))
def test_main_script_counts_every_letter(text):
    seen = Counter(unicodedata.name(c, "").split(" ")[0] for c in text if c.isalpha())
    seen.pop("", None)
    assert fertility.main_script(text, {}) == (max(seen, key=lambda s: (seen[s], s)) if seen else "")


def test_bands_tell_prose_from_noise(make_docs):
    rng = random.Random(1)
    prose = "The committee met on Tuesday to discuss the annual report and agreed to publish it next month. "
    words = (prose * 3).split()
    rng.shuffle(words)
    noise = " ".join("".join(rng.choices("bcdfghjkqxz0123456789#$%&", k=9)) for _ in range(200))
    laden = " ".join(w + rng.choice(("###", "$$$", "%%%")) for w in words)
    cyrillic = "Комитет собрался во вторник чтобы обсудить годовой отчет и решил опубликовать его в следующем месяце после проверки " * 2
    docs = make_docs([(1, " ".join(words), "en", "a"), (2, noise, "en", "a"), (3, " ".join(words), None, "a"), (4, cyrillic, "xx", "a")])
    got = {r.doc_id: r for r in fertility.measure_quality(docs).collect()}
    assert got[1].kept and got[3].kept and not got[2].kept
    assert got[4].script == "CYRILLIC"
    assert got[1].chars_per_token > 4 > 1.7 > got[2].chars_per_token
    measured = fertility.measure_quality(make_docs([(1, laden, "en", "a")])).first()
    assert measured.chars_per_token < got[1].chars_per_token


def test_odd_rows_and_clashing_columns(spark, make_docs):
    docs = make_docs(odd_rows()).selectExpr("*", "1 as kept", "'x' as N_WORDS")
    got = fertility.measure_quality(docs)
    assert [c for c in got.columns if c.lower() in ("kept", "n_words")] == ["n_words", "kept"]
    rows = got.collect()
    assert len(rows) == len(odd_rows())
    assert all(r.base_failed and not r.kept for r in rows if not (r.text or "").strip())
    assert fertility.keep_quality(docs).columns == docs.columns
    assert {r.doc_id for r in fertility.keep_quality(docs).collect()} == {r.doc_id for r in rows if r.kept}
    assert fertility.measure_quality(docs.limit(0)).count() == 0
    assert fertility.keep_quality(docs.limit(0)).count() == 0
