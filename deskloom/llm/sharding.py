"""Shards of near equal bytes by sampled splitters.

Rows are ordered by a key, the hash of their text, then of their id, then a number dealt to the row, so equal
texts are neighbours. A sample
of the keys, drawn with a chance in proportion to the row's size, gives splitters at its quantiles; they cut
the key space into many small ranges of roughly equal bytes. Rows are dealt to ranges and each range's true
bytes are measured; an overfull range is cut again by splitters sampled from its own rows. Consecutive
ranges then make up shards by running sums of the true bytes.

Splitters fall between texts, so that copies of a text share a shard, unless the copies alone
overfill a range: those are split by id, and rows of one text and id that do by their numbers. The sample (``PER_RANGE`` keys a range) and one count per range are
all that reaches the driver; neither grows with the data.

Null texts have no bytes, and the size of every row includes ``ROW_BYTES``. Rows equal in text and id, and texts
without an id, are told apart by their numbers where they overfill a range. Null ids come first within their text.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from deskloom.llm.common import Stage, add_columns

ROW_BYTES = 16
# Ranges per shard bound how uneven shards can be: about one part in so many.
RANGES = 128
PER_RANGE = 8
# A range of more than so many times the bytes of the average is cut again.
OVERFULL = 2.0
# How often at most, the first cut included: each divides an overfull range by what it holds of the average.
CUTS = 6
LEAST = -(1 << 63)


Key = tuple[int, int, int]


def _number(keys: list[Key]):
    """A task's function from (hash, tie, number) to the number of splitters at or below the key."""

    def make():
        parts = [np.array([k[i] for k in keys], np.int64) for i in range(3)]

        def compute(h, t, n):
            h, t, n = (np.array(x, np.int64) for x in (h, t, n))
            low, high = np.searchsorted(parts[0], h, "left"), np.searchsorted(parts[0], h, "right")
            at = low.copy()
            for i in np.flatnonzero(high > low):
                # Splitters within one hash are ordered by tie, and within one tie by number.
                ties = parts[1][low[i] : high[i]]
                a, b = low[i] + np.searchsorted(ties, t[i], "left"), low[i] + np.searchsorted(ties, t[i], "right")
                at[i] = a + np.searchsorted(parts[2][a:b], n[i], "right")
            return {"_range": at}

        return compute

    return make


def _splitters(sample: list[tuple[int, int, int, float]], ranges: int) -> list[Key]:
    """Keys at the quantiles of the weighted sample, each the least key of the range it opens.

    Within one hash a key is used only where the hash fills more than a whole range, and within one hash and tie a
    row's number only where those do.
    """
    sample = sorted(sample)
    total = sum(w for *_, w in sample)
    if not total:
        return []
    found, held, step = [], 0.0, total / ranges
    of_hash: dict[int, float] = {}
    of_tie: dict[tuple[int, int], float] = {}
    for h, t, _, w in sample:
        of_hash[h] = of_hash.get(h, 0.0) + w
        of_tie[h, t] = of_tie.get((h, t), 0.0) + w
    for h, t, n, w in sample:
        if held >= step * (len(found) + 1):
            within = of_hash[h] > step
            found.append((h, t if within else LEAST, n if within and of_tie[h, t] > step else LEAST))
        held += w
    return sorted(set(found))


def _draw(keys: DataFrame, chance, seed: int) -> list[tuple[int, int, int, float]]:
    """A sample of the keys: each with the given chance (at most 1), weighted by size over chance."""
    uniform = (F.xxhash64("_h", "_t", "_n", F.lit(seed)).bitwiseAND((1 << 53) - 1)) / F.lit(float(1 << 53))
    drawn = keys.withColumn("_p", F.least(F.lit(1.0), chance)).where(uniform < F.col("_p"))
    return [tuple(r) for r in drawn.select("_h", "_t", "_n", F.col("size") / F.col("_p")).collect()]


def assign_shards(docs: DataFrame, shards: int = 40, ranges: int = RANGES) -> DataFrame:
    """``docs`` reduced to (doc_id, size, text_crc32, shard, slot); slots count from 0 within a shard."""
    spark = docs.sparkSession
    stage = Stage(spark)
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = stage(
        docs.select(
            "doc_id",
            (F.octet_length(text) + F.lit(ROW_BYTES)).cast("long").alias("size"),
            F.crc32(text).alias("text_crc32"),
            F.xxhash64(text).alias("_h"),
            F.when(F.col("doc_id").isNull(), LEAST + 1).otherwise(F.xxhash64("doc_id")).alias("_t"),
            # Dealt once, with the staged rows: it orders rows that are equal in text and id.
            F.xxhash64(F.monotonically_increasing_id()).alias("_n"),
        )
    )
    total = rows.agg(F.sum("size")).first()[0] or 0
    wanted = shards * ranges
    keys = _splitters(_draw(rows, F.col("size") * F.lit(wanted * PER_RANGE / max(total, 1)), 1), wanted)
    # The ranges as first cut, then overfull ones cut again until none is left that more splitters divide.
    for seed in range(2, 2 + CUTS):
        dealt = add_columns(rows, T.StructType([T.StructField("_range", T.LongType())]), _number(keys), ("_h", "_t", "_n"))
        sums = dealt.groupBy("_range").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n"))
        held = {r["_range"]: (r["bytes"], r["n"]) for r in sums.collect()}
        full = {k: b for k, (b, _) in held.items() if b > OVERFULL * total / wanted}
        if not full or seed == 1 + CUTS:
            break
        parts = {k: int(np.ceil(b * wanted / total)) for k, b in full.items()}
        chance = F.create_map(*[F.lit(x) for k, n in parts.items() for x in (k, n * PER_RANGE / full[k])])
        own = dealt.where(F.col("_range").isin(list(full)))
        drawn = _draw(own.withColumn("_q", chance[F.col("_range")]), F.col("size") * F.col("_q"), seed)
        of_range = _range_of(keys, drawn)
        more = set(keys)
        for k, n in parts.items():
            more.update(_splitters([d for d, r in zip(drawn, of_range) if r == k], n))
        if len(more) == len(keys):
            break
        keys = sorted(more)
    order = sorted(held)
    ends = np.cumsum([held[k][0] for k in order])
    middle = ends - np.array([held[k][0] for k in order]) / 2 if order else ends
    shard = np.minimum((middle * shards / max(total, 1)).astype(int), shards - 1).tolist()
    first, seen = [], {}
    for k, s in zip(order, shard):
        first.append(seen.get(s, 0))
        seen[s] = first[-1] + held[k][1]
    places = {k: (s, f) for k, s, f in zip(order, shard, first)}

    def make():
        def compute(ranges_, ranks):
            return {
                "shard": [places[r][0] for r in ranges_],
                "slot": [places[r][1] + n for r, n in zip(ranges_, ranks)],
            }

        return compute

    within = Window.partitionBy("_range").orderBy("_h", "_t", "_n", "doc_id")
    ranked = dealt.withColumn("_rank", F.row_number().over(within) - 1)
    fields = T.StructType([T.StructField("shard", T.IntegerType()), T.StructField("slot", T.LongType())])
    return add_columns(ranked, fields, make, ("_range", "_rank"), drop=("_h", "_t", "_n", "_range", "_rank"))


def _range_of(keys: list[Key], drawn: list) -> list[int]:
    return _number(keys)()(*([d[i] for d in drawn] for i in range(3)))["_range"].tolist() if drawn else []


def write_shards(docs: DataFrame, path: str, shards: int = 40) -> None:
    """Write ``docs`` as Parquet, a folder per shard, rows in slot order within each file."""
    placed = assign_shards(docs, shards).select(F.col("doc_id").alias("_id"), F.col("text_crc32").alias("_c"), "shard", "slot")
    crc = F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary"))
    # Rows equal in id and text are interchangeable: number them on both sides.
    nth = lambda *by: F.row_number().over(Window.partitionBy(*by).orderBy(*by))
    left = docs.withColumn("_c2", crc).withColumn("_k", nth("doc_id", "_c2"))
    right = placed.withColumn("_k2", nth("_id", "_c"))
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_c2") == F.col("_c")) & (F.col("_k") == F.col("_k2"))
    joined = left.join(right, same).drop("_c2", "_k", "_id", "_c", "_k2")
    joined.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
