"""Fill-in-middle beside plain cuts, SQL and an exact round trip."""

from __future__ import annotations

import hashlib
import re

from compare import connect, difference
from hypothesis import given
from hypothesis import strategies as st
from llm_fixtures import SF, folder_of, make_docs, odd_rows  # noqa: F401
from pyspark.sql import functions as F

from deskloom.llm import infill, queries

UNIT = re.compile(r"[A-Za-z]+|[^A-Za-z]")
TEXTS = st.text(st.sampled_from("abZ @[`{éé日\U0001f600\n\x00<PSM>1-"), max_size=200)


def brute(doc_id, text):
    """n, form, prefix_chars, middle_chars, output from the list of all units."""
    text = text or ""
    units = UNIT.findall(text)
    n = len(units)
    hexed = hashlib.sha256(("1:" + ("" if doc_id is None else str(doc_id))).encode()).hexdigest()
    h1, h2, h3, h4 = (int(hexed[i : i + 8], 16) for i in (0, 8, 16, 24))
    if text == "" or "<P>" in text or "<S>" in text or "<M>" in text or h3 % 100 >= 90:
        return n, "plain", None, None, text
    a, b = min(h1 % (n + 1), h2 % (n + 1)), max(h1 % (n + 1), h2 % (n + 1))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h4 % 100 < 20:
        return n, "spm", len(p), len(m), "<S>" + s + "<P>" + p + "<M>" + m
    return n, "psm", len(p), len(m), "<P>" + p + "<S>" + s + "<M>" + m


@given(TEXTS, st.integers(1, 9), st.integers(0, 210))
def test_tree_finds_every_cut(text, block, units):
    tree, listed = infill.UnitTree(text.encode(), block), UNIT.findall(text)
    assert tree.units == len(listed)
    before = "".join(listed[:units])
    assert tree.cut(units) == (len(before.encode()), len(before))


@given(TEXTS, st.integers(0, 40), st.integers(1, 9))
def test_document_matches_brute_force(text, doc_id, block):
    assert infill.infilled(text, doc_id, block) == brute(doc_id, text)


def rows_to_cut():
    tricky = ["a<" * 40, "<P" * 30 + "x", "x <S> y", "S><M" * 20, "<" * 50, "word " * 5000 + "é" * 3000, "Ab1" * 4000]
    return [(100 + 10 * i + j, t, "en", "a") for i, t in enumerate(tricky) for j in range(10)] + odd_rows()


def test_rows_and_round_trip(spark, make_docs):
    rows = rows_to_cut()
    filled = infill.fill_in_middle(make_docs(rows))
    got = filled.withColumn("back", infill.restored(F.col("output"), F.col("form"))).collect()
    key = lambda r: repr(r)
    want = [(d, t, *brute(d, t), t or "") for d, t, _, _ in rows]
    assert sorted([(r.doc_id, r.text, r.n, r.form, r.prefix_chars, r.middle_chars, r.output, r.back) for r in got], key=key) == sorted(want, key=key)
    assert {r.form for r in got} == {"plain", "psm", "spm"}


def test_query_matches_sql(spark, make_docs, folder_of):
    count, problem = difference(queries.op11_infill(spark, SF), connect(SF), infill.ORACLE)
    assert problem is None and count == 200
    folder = folder_of(make_docs(rows_to_cut()))
    got = {(r.doc_id, r.output_sha256, r.restored_sha256) for r in queries.op11_infill(spark, folder).collect()}
    digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert got == {(d, digest(brute(d, t)[4]), digest(t or "")) for d, t, _, _ in rows_to_cut()}


def test_no_rows_and_clashing_columns(spark, make_docs):
    assert infill.digest(infill.fill_in_middle(make_docs(odd_rows()).limit(0))).count() == 0
    docs = make_docs(odd_rows()).selectExpr("*", "'x' as FORM", "1 as n", "2 as output", "3 as unit")
    filled = infill.fill_in_middle(docs)
    assert filled.columns == ["doc_id", "text", "lang", "source", "n_chars", "unit", *infill.FIELDS.names]
    assert filled.count() == len(odd_rows())
