from __future__ import annotations

import random
import zlib
from collections import defaultdict

import pytest
from llm_fixtures import SF, make_docs, odd_rows, sample  # noqa: F401

from deskloom.llm import queries, sharding


def check(rows, docs):
    assert sorted((r.doc_id is None, r.doc_id or 0, r.size, r.text_crc32) for r in rows) == sorted(
        (d is None, d or 0, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for d, t in docs
    )
    slots = defaultdict(list)
    for r in rows:
        assert 0 <= r.shard < 40
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def spread(rows):
    sizes = [0] * 40
    for r in rows:
        sizes[r.shard] += r.size
    return min(sizes) / (sum(sizes) / 40), max(sizes) / (sum(sizes) / 40)


def test_query(spark, sample):
    rows = queries.op10_sharding(spark, SF).collect()
    check(rows, [(d["doc_id"], d["text"]) for d in sample])
    assert {r.law for r in rows} == {"bytes"} and {r.grown_shard for r in rows} == {None}


def test_sizes_are_near_equal_and_copies_stay_together(make_docs):
    rng = random.Random(5)
    docs = [(i, "".join(rng.choices("abcdef", k=rng.randrange(1, 400))), "en", "a") for i in range(20_000)]
    docs += [(30_000 + i, f"copy {i % 700} " * 3, "en", "a") for i in range(7000)]
    rows = sharding.assign_shards(make_docs(docs)).collect()
    check(rows, [(d, t) for d, t, *_ in docs])
    low, high = spread(rows)
    assert 0.97 < low and high < 1.03
    where = defaultdict(set)
    for r in rows:
        where[r.text_crc32].add(r.shard)
    copies = [where[zlib.crc32((f"copy {k} " * 3).encode())] for k in range(700)]
    assert sum(len(s) > 1 for s in copies) <= 2


def test_a_third_of_all_rows_is_one_text(make_docs):
    rng = random.Random(6)
    docs = [(i, "hot text" if i % 3 == 0 else "".join(rng.choices("abc", k=8)), "en", "a") for i in range(12_000)]
    rows = sharding.assign_shards(make_docs(docs)).collect()
    check(rows, [(d, t) for d, t, *_ in docs])
    low, high = spread(rows)
    assert 0.95 < low and high < 1.05


@pytest.mark.parametrize("doc_id", [7, None])
def test_a_third_of_all_rows_is_one_row(make_docs, doc_id):
    rng = random.Random(6)
    docs = [(doc_id if i % 3 == 0 else i, "hot text" if i % 3 == 0 else "".join(rng.choices("abc", k=8)), "en", "a") for i in range(12_000)]
    rows = sharding.assign_shards(make_docs(docs)).collect()
    check(rows, [(d, t) for d, t, *_ in docs])
    low, high = spread(rows)
    assert 0.95 < low and high < 1.05


def test_overfull_ranges_are_cut_again(make_docs, monkeypatch):
    monkeypatch.setattr(sharding, "PER_RANGE", 0.2)
    docs = [(i, f"text {i}", "en", "a") for i in range(6000)]
    rows = sharding.assign_shards(make_docs(docs)).collect()
    check(rows, [(d, t) for d, t, *_ in docs])
    low, high = spread(rows)
    assert 0.85 < low and high < 1.15


def test_odd_rows(spark, make_docs, tmp_path):
    docs = make_docs(odd_rows()).selectExpr("*", "1 as shard", "2 as _h")
    check(sharding.assign_shards(docs).collect(), [(d, t) for d, t, *_ in odd_rows()])
    assert sharding.assign_shards(docs.limit(0)).count() == 0
    plain = make_docs(odd_rows())
    sharding.write_shards(plain, f"{tmp_path}/shards", 4)
    back = spark.read.parquet(f"{tmp_path}/shards")
    key = lambda r: (r.doc_id or -1, r.text or "", r.source or "")
    assert sorted(map(key, back.collect())) == sorted(map(key, plain.collect()))
