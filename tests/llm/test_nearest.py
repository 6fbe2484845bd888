"""Nearest neighbours beside a search of all pairs."""

from __future__ import annotations

import math

import numpy as np
import pytest
from llm_fixtures import SF
from pyspark.sql import functions as F

from deskloom.llm import nearest, queries

SCHEMA = "vec_id long, embedding array<float>, label int"


def sound(v):
    return v is not None and all(x is not None and math.isfinite(x) for x in v) and any(x != 0 for x in v)


def brute(rows, k=20, every=20):
    """query -> [(vec_id, score)] over all pairs, nearest first."""
    rows = [(i, v) for i, v in rows if i is not None and sound(v)]
    width = max((len(v) for _, v in rows), default=1)
    ids = np.array([i for i, _ in rows])
    vectors = np.array([list(np.float32(v).astype(float)) + [0.0] * (width - len(v)) for _, v in rows]).reshape(len(rows), width)
    out = {}
    for q in sorted({int(i) for i in ids if i % every == 0}):
        best = {}
        for v in vectors[ids == q]:
            for i, s in zip(ids.tolist(), (vectors * v).sum(axis=1).tolist()):
                if i != q:
                    best[i] = max(s, best.get(i, -math.inf))
        out[q] = sorted(best.items(), key=lambda x: (-x[1], x[0]))[:k]
    return {q: v for q, v in out.items() if v}


def lists(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(out[r.query_id])
    return out


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA).repartition(3)


def recall(found, truth):
    hits = sum(len({i for i, _ in found.get(q, [])} & {i for i, _ in v}) for q, v in truth.items())
    return hits / sum(map(len, truth.values()))


def check(found, rows, least):
    """Scores and order are exact, queries whole, and at least so much of the truth is found."""
    truth = brute(rows)
    assert found.keys() == truth.keys()
    every = {q: dict(v) for q, v in brute(rows, k=10**9).items()}
    for q, near in found.items():
        assert len(near) == len(truth[q])
        assert near == sorted(near, key=lambda x: (-x[1], x[0]))
        assert [every[q][i] for i, _ in near] == pytest.approx([s for _, s in near], abs=1e-12)
    assert recall(found, truth) >= least


def test_query_finds_nearly_all(spark):
    rows = [(r.vec_id, list(r.embedding)) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    found = lists(queries.op12_nearest(spark, SF))
    check(found, rows, 0.9)
    assert found == lists(queries.op12_nearest(spark, SF))


@pytest.fixture(scope="module")
def clustered():
    """Clusters of several sizes and lengths of vectors; a third of all rows lie in one, a sixth are one vector."""
    rng = np.random.default_rng(3)
    centres = rng.standard_normal((30, 16)) * rng.uniform(0.2, 3, (30, 1))
    which = np.where(rng.random(1500) < 1 / 3, 0, rng.integers(1, 30, 1500))
    vectors = centres[which] + 0.05 * rng.standard_normal((1500, 16))
    vectors[rng.random(1500) < 1 / 6] = centres[1]
    return [(int(i), v.astype(np.float32).tolist()) for i, v in enumerate(vectors)]


def test_clusters_copies_and_lengths(spark, clustered):
    check(lists(nearest.nearest(frame(spark, clustered), F.col("vec_id") % 20 == 0)), clustered, 0.9)


def test_slices_and_blocks_change_nothing(spark, clustered, monkeypatch):
    rows = frame(spark, clustered).where("vec_id < 600")
    points = nearest.usable(rows, "vec_id", "embedding")
    asked = points.where("vec_id % 20 = 0")
    family = nearest.fit(points, asked, 20)
    whole = lists(nearest.search(points, asked, family, 20, nearest.Stage(spark)))
    monkeypatch.setattr(nearest, "GROUP", 30)
    monkeypatch.setattr(nearest, "BLOCK", 7)
    assert lists(nearest.search(points, asked, family, 20, nearest.Stage(spark))) == whole


def test_odd_rows(spark):
    rows = [(i, [float(i % 7), float(i % 3), 1.0]) for i in range(60)]
    rows += [(100, None), (120, []), (140, [0.0, 0.0, 0.0]), (160, [1.0, None, 2.0]), (180, [math.nan, 1.0, 1.0])]
    rows += [(200, [math.inf, 1.0, 1.0]), (None, [9.0, 9.0, 9.0]), (220, [5.0]), (241, [1.0, 2.0, 3.0, 4.0])]
    rows += [(20, [float(20 % 7), float(20 % 3), 1.0])] * 3  # repeated
    rows += [(40, [-3.0, 0.5, 1.0]), (7, [8.0, 8.0, 8.0])]  # further vectors of items
    found = lists(nearest.nearest(frame(spark, rows), F.col("vec_id") % 20 == 0))
    assert found == brute(rows)  # few enough for one bucket
    assert set(found) == {0, 20, 40, 220}


def test_few_and_no_rows(spark):
    rows = [(i, [1.0, float(i)]) for i in range(0, 100, 20)]
    assert lists(nearest.nearest(frame(spark, rows), F.col("vec_id") % 20 == 0)) == brute(rows)
    assert lists(nearest.nearest(frame(spark, [(20, [1.0])]), F.col("vec_id") % 20 == 0)) == {}
    assert lists(nearest.nearest(frame(spark, [(1, [1.0]), (2, [1.0])]), F.col("vec_id") % 20 == 0)) == {}
    assert nearest.nearest(spark.createDataFrame([], SCHEMA), F.col("vec_id") % 20 == 0).count() == 0


def test_a_query_that_finds_too_few_meets_all(spark, clustered):
    far = [(2000, [-50.0] * 16)]
    check(lists(nearest.nearest(frame(spark, clustered + far), F.col("vec_id") % 20 == 0)), clustered + far, 0.9)


def test_extra_columns(spark, clustered):
    rows = frame(spark, clustered[:200])
    more = rows.selectExpr("*", "1 as vector", "2 as `group`", "3 as rank", "4 as bucket")
    assert lists(nearest.nearest(more, F.col("vec_id") % 20 == 0)) == lists(nearest.nearest(rows, F.col("vec_id") % 20 == 0))


def test_likeliest_visits_first():
    family = nearest.Family(4, 1, 8, 1.0, 1.0, 50)
    vectors = np.random.default_rng(5).standard_normal((6, 8))
    visited = family.visits(vectors)[1]
    position = family.positions(vectors, query=True)
    factors = family.draw()[2][1]
    for q in range(6):
        for t in range(nearest.TABLES):
            chances = {}
            steps = range(-nearest.REACH, nearest.REACH + 1)
            for combination in np.array(np.meshgrid(*[steps] * 4)).reshape(4, -1).T:
                slot = np.floor(position[q, t]).astype(np.int64) + combination
                low, high = slot - position[q, t], slot + 1 - position[q, t]
                scale = nearest.WIDTH / family.radius
                chance = np.prod(nearest.normal_cdf(high * scale) - nearest.normal_cdf(low * scale))
                chances[int((slot * factors[:4]).sum())] = chance
            want = sorted(chances.values(), reverse=True)[:50]
            assert [chances[int(b)] for b in visited[q, t]] == pytest.approx(want)
