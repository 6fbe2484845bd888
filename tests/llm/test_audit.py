"""The filter audit beside SQL and beside filters applied one by one."""

from __future__ import annotations

import re
from collections import defaultdict
from itertools import permutations

import pytest
from compare import connect, difference
from llm_fixtures import SF, folder_of, make_docs, odd_rows  # noqa: F401

from deskloom.llm import audit, queries

COUNTS = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def brute(rows, labels):
    """(part, order, step) -> counts, by applying the filters of every order to every document."""
    good = {d for d, q, _ in labels if d is not None and q == 1}
    toxic = {d for d, _, t in labels if d is not None and t == 1}
    failing = []
    for d, text, _, source in rows:
        t = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = {
            "A": len(words) < 200,
            "B": 100 * len(set(words)) < 50 * len(words),
            "C": 100 * len(re.findall("[A-Z]", t)) > 2 * len(t),
            "D": bool(re.search(r"[#$%&*|]", t)),
            "E": any(d is not None and o is not None and o < d and (x or "") == t for o, x, _, _ in rows),
        }
        failing.append((source or "", {f for f, bad in fails.items() if bad}, d in good, d in toxic))
    out, shapley = {}, defaultdict(int)
    for order in map("".join, permutations("ABCDE")):
        for part in {p for p, *_ in failing}:
            left = [x for x in failing if x[0] == part]
            gone = []
            for i, f in enumerate(order):
                lost = [x for x in left if f in x[1]]
                left = [x for x in left if f not in x[1]]
                shapley[part, f] += len(lost)
                out[part, order, i + 1] = [
                    len(left), len(lost), sum(f in x[1] for x in gone), sum(x[0] == part and x[1] == {f} for x in failing),
                    sum(x[2] for x in lost), sum(x[3] for x in lost),
                ]
                gone += lost
    return {k: (*v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def table(df):
    rows = df.collect()
    found = {(r.part, r.filter_order, r.step): tuple(r[c] for c in COUNTS) for r in rows}
    assert len(found) == len(rows)
    return found


def mixed_rows():
    long = " ".join(f"word{i}" for i in range(220))
    rows = [(i, long, "en", "a") for i in (9, 4, 12)] + [(7, long, "en", "b"), (None, long, "en", "b"), (4, long, "en", "a")]
    rows += [(20, long + " $", "en", "b"), (21, "UP " * 210, "en", None), (22, "UP " * 210, "en", ""), (23, long.upper(), "en", "a")]
    return rows + odd_rows()


def test_counts_match_brute_force(spark, make_docs):
    labels = [(4, 1, 0), (9, 0, 1), (9, 1, 0), (20, 1, 1), (None, 1, 1), (7, None, None), (777, 1, 1)]
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    rows = mixed_rows()
    found = table(audit.audit(make_docs(rows), marks))
    assert found == brute(rows, labels)
    assert any(v[0] for v in found.values()) and any(v[4] for v in found.values()) and any(v[5] for v in found.values())


def test_query_matches_sql(spark):
    count, problem = difference(queries.op13_audit(spark, SF), connect(SF), audit.ORACLE)
    assert problem is None
    assert count % 600 == 0 and count


def test_copies_in_many_slices_change_nothing(spark, make_docs, monkeypatch):
    rows = [(i, "same text here", "en", "a" if i % 2 else "b") for i in range(300)] + [(500, "other", "en", "a")]
    whole = table(audit.audit(make_docs(rows), spark.createDataFrame([], "doc_id long, quality int, toxic int")))
    assert whole["a", "EABCD", 1][1] == 150 and whole["b", "EABCD", 1][1] == 149  # the least id, 0, is in b
    monkeypatch.setattr(audit, "SLICE_CHARS", 100)
    assert table(audit.audit(make_docs(rows), spark.createDataFrame([], "doc_id long, quality int, toxic int"))) == whole


def test_no_rows_and_clashing_columns(spark, make_docs):
    labels = spark.createDataFrame([(1, 1, 1)], "doc_id long, quality int, toxic int")
    assert audit.audit(make_docs(mixed_rows()).limit(0), labels).count() == 0
    docs = make_docs(mixed_rows())
    more = docs.selectExpr("*", "1 as n", "2 as bits", "3 as part", "4 as _hash", "5 as _slice", "6 as sets")
    assert table(audit.audit(more, labels)) == table(audit.audit(docs, labels))


@pytest.mark.parametrize("order", ["ABCDE", "EDCBA"])
def test_steps_of_an_order_add_up(spark, order):
    rows = queries.op13_audit(spark, SF).where(f"filter_order = '{order}'").collect()
    total = defaultdict(int)
    for r in rows:
        total[r.part] += r.removed + (r.kept if r.step == 5 else 0)
    docs = spark.read.parquet(f"{SF}/documents.parquet").groupBy("source").count().collect()
    assert total == {r["source"] or "": r["count"] for r in docs}
