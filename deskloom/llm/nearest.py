"""Nearest neighbours by inner product: multiprobe p-stable hashing with exact reranking.

Inner products become distances: all vectors are scaled by the greatest length and get one more component that
makes them unit vectors; a query is scaled to a unit vector with 0 there, so its nearest points by distance are
those of greatest inner product. ``TABLES`` tables hash a point by functions floor((a x + b) / w), a normal.

A query visits buckets around its own. How likely a neighbour at the usual distance lies in a slot follows
from where between two slot borders the query lies, and a bucket's chance is the product over its functions;
buckets are visited in falling order of it. The number of functions grows with the logarithm of the number of
points. How many buckets a query visits per table is fitted: of a sample of ``SAMPLE`` queries the true
neighbours are found by one pass over all points, and visits are as many as bring ``TARGET`` of them into a
visited bucket. If ``PROBES`` visits do not, there are fewer functions, and without any a single bucket. On
data without structure that means many candidates: half of all points in 64 even dimensions.

Buckets that agree in their first functions are a group, which is what Spark deals out: points go to the group
of their bucket in each table, queries to every group they visit a bucket of, with the list of those buckets.
A group of many points is dealt to slices and one of many queries to blocks, each slice meeting each block, so
a task holds a bounded part of both whatever lies in one bucket. Of equal vectors the least ``k + 1`` ids are
indexed: no others can be among the k nearest, ties going to the smaller id. Per group the best k of a query
go on, and they are merged over groups and tables. A query that finds fewer than k is compared with all.

Scores are sums of products in double precision, made anew for what the block products select.

Vectors that are null, empty, zero or hold a null or non-finite component take no part, neither do rows without an
id. Shorter vectors count as ending in zeros. Rows that share an id are one item, as near as the nearest two of
its vectors; an item is never its own neighbour. Repeated rows count once. With fewer than k other items, all
are returned; without queries or points, no rows. Other columns are not read.
"""

from __future__ import annotations

import math
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from deskloom.llm.common import Stage

TABLES = 4
WIDTH = 2.5
SEED = 12
# Points of a bucket and of a group, about; queries that meet a slice of a group at once.
BUCKET, GROUP, BLOCK = 32, 4096, 4096
# Buckets in reach along a function, most visits a table, and queries the visits are fitted to.
REACH, PROBES, SAMPLE = 2, 1024, 128
TARGET = 0.95
# Pairs of a block product, and pairs kept before they are cut to the best of each query.
PRODUCT, HELD = 1 << 21, 1 << 16

FOUND = T.StructType(
    [
        T.StructField("query_id", T.LongType()),
        T.StructField("ids", T.ArrayType(T.LongType())),
        T.StructField("scores", T.ArrayType(T.DoubleType())),
    ]
)
RANKED = "query_id long, rank int, vec_id long, score double"


def normal_cdf(x: np.ndarray) -> np.ndarray:
    return np.vectorize(lambda v: 0.5 * math.erfc(-v / math.sqrt(2)), otypes=[float])(x)


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """A list column as rows of doubles, ended with zeros."""
    lengths = pc.list_value_length(column).to_numpy(zero_copy_only=False).astype(np.int64)
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    out = np.zeros((len(lengths), width))
    row = np.repeat(np.arange(len(lengths)), lengths)
    out[row, np.arange(len(values)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = values
    return out


class Family(NamedTuple):
    """Hash functions of all tables, and what it takes to order visits."""

    functions: int
    lead: int  # functions that tell the group
    width: int
    longest: float
    radius: float
    probes: int = 1

    def draw(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Directions and shifts per table and function, and odd factors that make a number of slots."""
        rng = np.random.default_rng(SEED)
        directions = rng.standard_normal((TABLES, self.functions, self.width + 1)) / WIDTH
        shifts = rng.random((TABLES, self.functions))
        return directions, shifts, rng.integers(1 << 62, size=(2, max(self.functions, 1))) * 2 + 1

    def positions(self, vectors: np.ndarray, query: bool) -> np.ndarray:
        """Where vectors lie along the functions, in slots: (vectors, tables, functions)."""
        directions, shifts, _ = self.draw()
        scale = np.linalg.norm(vectors, axis=1, keepdims=True) if query else self.longest
        unit = vectors / scale
        last = np.zeros(len(unit)) if query else np.sqrt(np.maximum(0.0, 1.0 - (unit * unit).sum(axis=1)))
        return np.einsum("nd,tkd->ntk", np.column_stack([unit, last]), directions, optimize=True) + shifts

    def buckets(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Group and bucket of points in each table."""
        slots = np.floor(self.positions(vectors, query=False)).astype(np.int64)
        factors = self.draw()[2]
        return (slots * factors[0, : self.functions])[:, :, : self.lead].sum(axis=2), (slots * factors[1, : self.functions]).sum(axis=2)

    def visits(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Groups and buckets of queries in each table, (queries, tables, visits), likeliest first.

        A list of the likeliest beginnings, one function longer in every round: what is likeliest in all has
        beginnings that are likeliest among beginnings.
        """
        position = self.positions(vectors, query=True).reshape(TABLES * len(vectors), self.functions)
        factors = self.draw()[2]
        slot = np.floor(position).astype(np.int64)
        steps = np.arange(-REACH, REACH + 1)
        log = np.zeros((len(position), 1))
        group = np.zeros((len(position), 1), np.int64)
        bucket = np.zeros((len(position), 1), np.int64)
        for i in range(self.functions):
            borders = slot[:, i : i + 1] + np.arange(-REACH, REACH + 2) - position[:, i : i + 1]
            below = normal_cdf(borders * (WIDTH / self.radius))
            chance = np.log(np.maximum(np.diff(below, axis=1), 1e-300))
            at = slot[:, i : i + 1] + steps
            log = (log[:, :, None] + chance[:, None, :]).reshape(len(position), -1)
            bucket = (bucket[:, :, None] + (at * factors[1, i])[:, None, :]).reshape(len(position), -1)
            part = at * factors[0, i] * (i < self.lead)
            group = (group[:, :, None] + part[:, None, :]).reshape(len(position), -1)
            if log.shape[1] > self.probes:
                best = np.argpartition(-log, self.probes - 1, axis=1)[:, : self.probes]
                log, bucket, group = (np.take_along_axis(x, best, axis=1) for x in (log, bucket, group))
        order = np.argsort(-log, axis=1, kind="stable")
        shape = (len(vectors), TABLES, -1)
        return tuple(np.take_along_axis(x, order, axis=1).reshape(shape) for x in (group, bucket))

    def rows_at_once(self) -> int:
        return max(1, (1 << 20) // (TABLES * (2 * REACH + 1) * self.probes))


def best(query: np.ndarray, item: np.ndarray, score: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    """Of (query, item, score) the k best items of each query, nearest first; an item counts with its best score."""
    order = np.lexsort((-score, item, query))
    query, item, score = query[order], item[order], score[order]
    once = np.ones(len(query), bool)
    once[1:] = (query[1:] != query[:-1]) | (item[1:] != item[:-1])
    query, item, score = query[once], item[once], score[once]
    order = np.lexsort((item, -score, query))
    query, item, score = query[order], item[order], score[order]
    first = np.flatnonzero(np.r_[True, query[1:] != query[:-1]]) if len(query) else np.zeros(0, np.int64)
    rank = np.arange(len(query)) - np.repeat(first, np.diff(np.r_[first, len(query)]))
    return query[rank < k], item[rank < k], score[rank < k], rank[rank < k]


class Nearest:
    """The k best items of a block of queries, gathered from blocks of points."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, k: int):
        self.ids, self.vectors, self.k = ids, vectors, k
        self.least = np.full(len(ids), -np.inf)  # what a query's k-th item has so far
        self.lengths = np.linalg.norm(vectors, axis=1)
        self.kept = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
        self.held = 0

    def meet(self, queries: np.ndarray, ids: np.ndarray, points: np.ndarray) -> None:
        """Compare the queries of these numbers with points."""
        many = max(1, PRODUCT // len(ids))
        slack = 1e-12 * np.linalg.norm(points, axis=1).max()
        single = len(np.unique(ids)) == len(ids)
        for at in range(0, len(queries), many):
            part = queries[at : at + many]
            near = self.vectors[part] @ points.T
            near[self.ids[part][:, None] == ids] = -np.inf
            least = self.least[part]
            if single and len(ids) > self.k:
                least = np.maximum(least, np.partition(near, -self.k, axis=1)[:, -self.k])
            rows, columns = np.nonzero((near >= (least - slack * self.lengths[part])[:, None]) & (near > -np.inf))
            scores = (self.vectors[part[rows]] * points[columns]).sum(axis=1)
            self.kept.append((part[rows], ids[columns], scores))
            self.held += len(rows)
            if self.held > HELD:
                self.cut()

    def cut(self) -> tuple[np.ndarray, ...]:
        query, item, score, rank = best(*map(np.concatenate, zip(*self.kept)), self.k)
        full = rank == self.k - 1
        self.least[query[full]] = score[full]
        self.kept, self.held = [(query, item, score)], 0
        return query, item, score


def _match(width: int, k: int):
    """A task's function from the points and the queries of one slice and block to :data:`FOUND`."""

    def match(points: pa.Table, queries: pa.Table) -> pa.Table:
        names = FOUND.names
        if not points.num_rows or not queries.num_rows:
            return pa.table([pa.array([], pa.int64()), pa.array([], pa.list_(pa.int64())), pa.array([], pa.list_(pa.float64()))], names=names)
        points, queries = points.combine_chunks(), queries.combine_chunks()
        code = points.column("bucket").to_numpy()
        order = np.argsort(code, kind="stable")
        code, ids = code[order], points.column("vec_id").to_numpy()[order]
        vectors = matrix(points.column("vector").combine_chunks(), width)[order]
        wanted = queries.column("buckets").combine_chunks()
        who = np.repeat(np.arange(len(wanted)), pc.list_value_length(wanted).to_numpy())
        what = wanted.flatten().to_numpy()
        order = np.argsort(what, kind="stable")
        who, what = who[order], what[order]
        found = Nearest(queries.column("vec_id").to_numpy(), matrix(queries.column("vector").combine_chunks(), width), k)
        first = np.flatnonzero(np.r_[True, code[1:] != code[:-1]])
        last = np.r_[first[1:], len(code)]
        low, high = np.searchsorted(what, code[first], "left"), np.searchsorted(what, code[first], "right")
        for a, z, x, y in zip(first, last, low, high):
            if x < y:
                found.meet(who[x:y], ids[a:z], vectors[a:z])
        query, item, score = found.cut()
        starts = np.r_[np.flatnonzero(np.r_[True, query[1:] != query[:-1]]) if len(query) else np.zeros(0, np.int64), len(query)]
        offsets = pa.array(starts.astype(np.int32))
        return pa.table(
            [
                pa.array(found.ids[query[starts[:-1]]]),
                pa.ListArray.from_arrays(offsets, pa.array(item)),
                pa.ListArray.from_arrays(offsets, pa.array(score)),
            ],
            names=names,
        )

    return match


def _merge(k: int):
    """A task's function from :data:`FOUND`, sorted by query, to the k nearest of each with their ranks."""

    def ranked(query, item, score):
        query, item, score, rank = best(query, item, score, k)
        return pa.RecordBatch.from_arrays(
            [pa.array(query), pa.array((rank + 1).astype(np.int32)), pa.array(item), pa.array(score)],
            names=["query_id", "rank", "vec_id", "score"],
        )

    def run(batches):
        held = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
        for batch in batches:
            lists = batch.column("ids")
            query = np.repeat(batch.column("query_id").to_numpy(), pc.list_value_length(lists).to_numpy())
            new = (query, lists.flatten().to_numpy(), batch.column("scores").flatten().to_numpy())
            query, item, score = (np.concatenate(x) for x in zip(held, new))
            # The last query may go on in the next batch.
            end = int(np.searchsorted(query, query[-1])) if len(query) else 0
            held = best(query[end:], item[end:], score[end:], k)[:3]
            yield ranked(query[:end], item[:end], score[:end])
        yield ranked(*held)

    return run


def usable(rows: DataFrame, name: str, vector: str) -> DataFrame:
    """(vec_id, vector) of the rows that take part, each once."""
    rows = rows.select(F.col(name).cast("long").alias("vec_id"), F.col(vector).alias("vector"))
    parts = F.col("vector")
    sound = F.forall(parts, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(parts, lambda x: x != 0)
    return rows.where(F.col("vec_id").isNotNull() & parts.isNotNull()).where(sound).groupBy("vector", "vec_id").agg(F.lit(1).alias("_")).drop("_")


def _sample_truth(points: DataFrame, sample: list, width: int, k: int) -> list:
    """The k nearest points of the sampled (id, vector) rows, by one pass over all points: (query, vector, score)."""
    ids = np.array([r["vec_id"] for r in sample], np.int64)
    vectors = matrix(pa.array([r["vector"] for r in sample], pa.list_(pa.float64())), width)

    def run(batches):
        found = [(np.zeros(0, np.int64), np.zeros(0), np.zeros((0, width)))]
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                here = matrix(part.column("vector"), width)
                near = vectors @ here.T
                near[ids[:, None] == part.column("vec_id").to_numpy()] = -np.inf
                many = min(k, near.shape[1])
                top = np.argpartition(-near, many - 1, axis=1)[:, :many]
                query = np.repeat(np.arange(len(ids)), many)
                found.append((query, np.take_along_axis(near, top, axis=1).ravel(), here[top.ravel()]))
                query, score, here = (np.concatenate(x) for x in zip(*found))
                order = np.lexsort((-score, query))
                first = np.searchsorted(query[order], query[order])
                order = order[np.arange(len(order)) - first < k]
                found = [(query[order], score[order], here[order])]
        query, score, here = found[0]
        real = score > -np.inf
        lists = pa.ListArray.from_arrays(pa.array(np.arange(real.sum() + 1, dtype=np.int32) * width), pa.array(here[real].ravel()))
        yield pa.RecordBatch.from_arrays([pa.array(query[real]), pa.array(score[real]), lists.cast(pa.list_(pa.float64()))], names=["query", "score", "vector"])

    near = points.mapInArrow(run, "query long, score double, vector array<double>")
    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.col("score").desc()))
    return near.withColumn("_rank", rank).where(F.col("_rank") <= k).drop("_rank").collect()


def fit(points: DataFrame, queries: DataFrame, k: int) -> Family | None:
    """Functions and visits for these points; None without points or queries."""
    length = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda held, x: held + x * x))
    n, longest, width = points.agg(F.count(F.lit(1)), F.max(length), F.max(F.size("vector"))).first()
    sample = queries.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).collect()
    if not n or not sample:
        return None
    functions = max(0, round(math.log(max(n / BUCKET, 1.0)) / math.log(WIDTH)))
    truth = _sample_truth(points, sample, width, k) if functions else []
    if not truth:
        return Family(0, 0, width, longest, 1.0)
    vectors = matrix(pa.array([r["vector"] for r in sample], pa.list_(pa.float64())), width)
    which = np.array([r["query"] for r in truth])
    near = matrix(pa.array([r["vector"] for r in truth], pa.list_(pa.float64())), width)
    similar = np.array([r["score"] for r in truth]) / (np.linalg.norm(vectors, axis=1)[which] * longest)
    radius = max(0.01, float(np.median(np.sqrt(np.maximum(0.0, 2.0 - 2.0 * similar)))))
    while functions:
        lead = min(functions, max(0, round(math.log(max(n / GROUP, 1.0)) / math.log(WIDTH))))
        family = Family(functions, lead, width, longest, radius, PROBES)
        bucket = family.buckets(near)[1]
        reached = np.full(len(which), PROBES)
        at_once = family.rows_at_once()
        for at in range(0, len(vectors), at_once):
            visited = family.visits(vectors[at : at + at_once])[1]
            mine = np.flatnonzero((which >= at) & (which < at + at_once))
            same = visited[which[mine] - at] == bucket[mine][:, :, None]
            reached[mine] = np.where(same.any(axis=2), same.argmax(axis=2), PROBES).min(axis=1)
        needed = int(np.quantile(reached, TARGET, method="higher"))
        if needed < PROBES:
            return family._replace(probes=needed + 1)
        functions -= 1
    return Family(0, 0, width, longest, radius)


def _points_by_group(points: DataFrame, family: Family) -> DataFrame:
    """A row per point and table, with its group and bucket there."""

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                group, bucket = family.buckets(matrix(part.column("vector"), family.width))
                for t in range(TABLES if family.functions else 1):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(part.num_rows, t, np.int32)), pa.array(group[:, t]), pa.array(bucket[:, t]), part.column("vec_id"), part.column("vector")],
                        names=["table", "group", "bucket", "vec_id", "vector"],
                    )

    bucketed = T.StructType().add("table", T.IntegerType()).add("group", T.LongType()).add("bucket", T.LongType()).add("vec_id", T.LongType())
    return points.select("vec_id", "vector").mapInArrow(run, bucketed.add("vector", points.schema["vector"].dataType))


def _queries_by_group(queries: DataFrame, family: Family) -> DataFrame:
    """A row per query, table and group it visits, with the buckets it visits there."""

    def run(batches):
        at_once = family.rows_at_once()
        for batch in batches:
            for at in range(0, batch.num_rows, at_once):
                part = batch.slice(at, at_once)
                group, bucket = family.visits(matrix(part.column("vector"), family.width))
                for t in range(TABLES if family.functions else 1):
                    order = np.argsort(group[:, t], axis=1, kind="stable")
                    groups = np.take_along_axis(group[:, t], order, axis=1)
                    buckets = np.take_along_axis(bucket[:, t], order, axis=1)
                    new = np.ones(groups.shape, bool)
                    new[:, 1:] = groups[:, 1:] != groups[:, :-1]
                    starts = np.r_[np.flatnonzero(new), new.size]
                    row = starts[:-1] // new.shape[1]
                    lists = pa.ListArray.from_arrays(pa.array(starts.astype(np.int32)), pa.array(buckets.ravel()))
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(len(row), t, np.int32)),
                            pa.array(groups.ravel()[starts[:-1]]),
                            lists,
                            part.column("vec_id").take(pa.array(row)),
                            part.column("vector").take(pa.array(row)),
                        ],
                        names=["table", "group", "buckets", "vec_id", "vector"],
                    )

    visiting = T.StructType().add("table", T.IntegerType()).add("group", T.LongType()).add("buckets", T.ArrayType(T.LongType())).add("vec_id", T.LongType())
    return queries.select("vec_id", "vector").mapInArrow(run, visiting.add("vector", queries.schema["vector"].dataType))


def search(points: DataFrame, queries: DataFrame, family: Family, k: int, stage: Stage) -> DataFrame:
    """The k best of the points that the queries meet in the buckets they visit: query_id, rank, vec_id, score."""
    dealt, asked = _points_by_group(points, family), _queries_by_group(queries, family)
    held = dealt.groupBy("table", "group").agg(F.ceil(F.count(F.lit(1)) / (2 * GROUP)).cast("int").alias("slices"))
    asking = asked.groupBy("table", "group").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    grid = stage(held.join(asking, ["table", "group"]))
    number = F.xxhash64("vec_id", F.lit(SEED))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    dealt = dealt.join(grid, ["table", "group"]).withColumn("slice", F.pmod(number, "slices").cast("int")).withColumn("block", every("blocks"))
    asked = asked.join(grid, ["table", "group"]).withColumn("block", F.pmod(number, "blocks").cast("int")).withColumn("slice", every("slices"))
    key = ["table", "group", "slice", "block"]
    left, right = dealt.drop("slices", "blocks").groupBy(*key), asked.drop("slices", "blocks").groupBy(*key)
    found = left.cogroup(right).applyInArrow(_match(family.width, k), FOUND)
    return found.repartition("query_id").sortWithinPartitions("query_id").mapInArrow(_merge(k), RANKED)


def nearest(rows: DataFrame, is_query: Column, k: int = 20, name: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """The k nearest found for every row of ``rows`` that ``is_query`` (of :data:`vec_id`) holds for, among all others."""
    spark = rows.sparkSession
    stage = Stage(spark)
    every = stage(usable(rows, name, vector))
    copies = Window.partitionBy("vector").orderBy("vec_id")
    points = stage(every.withColumn("_copy", F.row_number().over(copies)).where(F.col("_copy") <= k + 1).drop("_copy"))
    queries = every.where(is_query)
    family = fit(points, queries, k)
    if family is None:
        return spark.createDataFrame([], RANKED)
    found = search(points, queries, family, k, stage)
    if not family.functions:
        return found
    found = stage(found)
    full = found.where(F.col("rank") == k).select(F.col("query_id").alias("vec_id"))
    short = stage(queries.join(full, "vec_id", "left_anti"))
    if short.isEmpty():
        return found
    again = search(points, short, family._replace(functions=0, lead=0, probes=1), k, stage)
    return found.join(full.withColumnRenamed("vec_id", "query_id"), "query_id", "left_semi").select(*found.columns).union(again)
