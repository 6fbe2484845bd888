from __future__ import annotations

import re
from collections import Counter, defaultdict

import duckdb
import pytest
from llm_fixtures import SF, make_docs, odd_rows, sample  # noqa: F401

from deskloom.llm import mixing, queries


def poured(sizes):
    """Targets by sharing out what is above the caps until nothing is."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    left, open_, target = 1.5 * sum(sizes.values()), set(names), {}
    while open_:
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = [s for s in open_ if share[s] > 2 * sizes[s]]
        if not over:
            return target | share
        for s in over:
            target[s] = 2.0 * sizes[s]
            left -= target[s]
            open_.discard(s)
    return target


def check(rows, docs):
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sizes = Counter()
    for _, text, _, source in docs:
        sizes[source] += size(text)
    target = poured(dict(sizes))
    want = sorted((d is None, d or 0, size(t), sizes[s], round(target[s], 6)) for d, t, _, s in docs)
    assert sorted((r.doc_id is None, r.doc_id or 0, r.size, r.source_size, round(r.target, 6)) for r in rows) == want
    assert all(r.size == 0 or r.taken % r.size == 0 and 0 <= r.taken <= 2 * r.size for r in rows)


def test_query_matches_sql_and_brute_force(spark, sample):
    rows = queries.op6_mixing(spark, SF).collect()
    docs = [(d["doc_id"], d["text"], d["lang"], d["source"]) for d in sample]
    check(rows, docs)
    db = duckdb.connect()
    db.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    result = db.execute(mixing.ORACLE)
    names = [d[0] for d in result.description]
    assert sorted(names) == sorted(rows[0].asDict())
    assert sorted(tuple(r[n] for n in names) for r in rows) == sorted(result.fetchall())
    taken, aim, most = Counter(), {}, Counter()
    source = {d: s for d, _, _, s in docs}
    for r in rows:
        s = source[r.doc_id]
        taken[s] += r.taken
        aim[s] = r.target
        most[s] = max(most[s], r.size)
    assert all(abs(taken[s] - aim[s]) <= most[s] / 2 for s in aim)
    assert sorted(rows) == sorted(queries.op6_mixing(spark, SF).collect())


def test_a_source_with_a_third_of_all_rows(make_docs):
    docs = [(i, "w " * (i % 50 + 1), "en", "hot" if i % 3 == 0 else f"s{i % 40:02}") for i in range(9000)]
    rows = mixing.mix(make_docs(docs)).collect()
    check(rows, docs)
    taken, aim = Counter(), {}
    source = {d: s for d, _, _, s in docs}
    for r in rows:
        taken[source[r.doc_id]] += r.taken
        aim[source[r.doc_id]] = r.target
    assert all(abs(taken[s] - aim[s]) <= 25 for s in aim)


@pytest.mark.parametrize("texts", [1, 30])
def test_rows_without_an_id_are_taken_one_by_one(make_docs, texts):
    """Half of a source's rows have no id, and one text or many: it still gives near what it should."""
    text = lambda i: " ".join([f"w{i % texts}"] * 40)
    docs = [(None if i % 2 else i, text(i), "en", "a") for i in range(60)] + [(1000 + i, "x " * 40, "en", "b") for i in range(60)]
    made = make_docs(docs)
    rows = mixing.mix(made).collect()
    check(rows, docs)
    for target in {r.target for r in rows}:
        assert abs(sum(r.taken for r in rows if r.target == target) - target) <= 20
    mixed = mixing.mixed_documents(made.cache())
    assert abs(40 * mixed.count() - sum(r.taken for r in rows)) <= 40


def test_quality_decides_who_is_drawn(make_docs):
    clean, laden = "word " * 40, "word### " * 40
    docs = [(i, clean if i % 2 else laden, "en", f"s{i // 2 % 3}") for i in range(4000)]
    rows = mixing.mix(make_docs(docs)).collect()
    got = defaultdict(int)
    for r in rows:
        got[r.doc_id % 2, r.source_size, r.target] += r.taken
    partly = [k[1:] for k in got if k[2] % k[1]]
    assert partly and all(got[(1, *k)] > 1.2 * got[(0, *k)] for k in partly)


def test_odd_rows_and_the_mix_itself(make_docs):
    docs = make_docs(odd_rows())
    rows = mixing.mix(docs.selectExpr("*", "1 as size", "2 as target")).collect()
    check(rows, odd_rows())
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns
    words = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    assert sum(words(r.text) for r in mixed.collect()) == pytest.approx(sum(r.taken for r in rows), abs=1)
    assert mixing.mix(docs.limit(0)).count() == 0
    assert mixing.mixed_documents(docs.limit(0)).count() == 0
    blank = make_docs([(1, "", "en", "a"), (2, None, "en", None)])
    assert {(r.size, r.source_size, r.target, r.taken) for r in mixing.mix(blank).collect()} == {(0, 0, 0.0, 0)}
