"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Targets: the sources share a multiple of all words by weight; a target stops at ``MOST`` times its source's
size and what it cannot hold goes to the others by weight.

A source gives complete epochs of all its documents first. The fraction that is left is drawn without
replacement: every document gets an exponential key -ln(u) / quality, u from a hash of its id, and in order
of the keys documents are taken as long as their middle lies within the budget, so the taken words miss a
target by half a document at most.

The order is not made by sorting a source, which may hold most rows. Keys are dealt to buckets at the
quantiles of all keys; sums per bucket show in which bucket a source's budget ends, and only that
bucket is put in order. What comes of it is one cut key per source, against which rows are then decided.

Sources are ordered by code point, null last. Null and empty texts have no words: they are taken with
complete epochs and add none. A key is fixed by id and text, a null id being hashed as the text "null"; rows equal
in id, text and source are told apart by a number dealt to them, so that part of them can be taken. No rows in,
no rows out.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from deskloom.llm.common import WORD, Stage, add_columns, shuffle_partitions

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2
SYMBOLS = "#*$%&|<>"
SEED = "mix"


def quality(text: F.Column) -> F.Column:
    """From 0.1 to 1: falls with the share of markup symbols among the characters."""
    length = F.length(text)
    symbols = length - F.length(F.translate(text, SYMBOLS, ""))
    return F.greatest(F.lit(0.1), F.lit(1.0) - F.lit(5.0) * symbols / F.greatest(length, F.lit(1)))


def exponential_key(identity: F.Column, text: F.Column, number: F.Column, weight: F.Column) -> F.Column:
    """An exponential variate of the given rate, fixed by id and text, and by a number for rows equal in both."""
    named = F.concat_ws(":", F.lit(SEED), F.coalesce(identity.cast("string"), F.lit("null")), text, number.cast("string"))
    digits = F.substring(F.md5(named), 1, 13)
    uniform = (F.conv(digits, 16, 10).cast("long").cast("double") + F.lit(0.5)) / F.lit(float(1 << 52))
    return -F.log(uniform) / weight


def targets(sizes: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """(source, source_size) with ``target``: shares of the total by weight, poured up to the caps."""
    ordered = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.row_number().over(ordered) - 1) % len(weights) + 1)
    filled = Window.orderBy("fill", F.col("source").asc_nulls_last())
    rest = filled.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    past = filled.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    pour = sizes.withColumn("weight", weight).withColumn("cap", F.col("source_size") * most)
    pour = pour.withColumn("fill", F.col("cap") / F.col("weight"))
    left = F.sum("source_size").over(everything) * share - F.coalesce(F.sum("cap").over(past), F.lit(0))
    pour = pour.withColumn("level", left / F.sum("weight").over(rest))
    # The level of the first source, in order of filling up, that it does not fill.
    level = F.max(F.when(F.col("fill") > F.col("level"), F.col("level"))).over(everything)
    target = F.least(F.col("cap").cast("double"), F.coalesce(F.col("weight") * level, F.col("cap").cast("double")))
    return pour.withColumn("target", target).select("source", "source_size", "target")


def cuts(keyed: DataFrame, stage: Stage, **options) -> DataFrame:
    """Per source of (doc_id, source, size, key): source_size, target, epochs, and the last key taken once more."""
    sizes = stage(targets(keyed.groupBy("source").agg(F.sum("size").alias("source_size")), **options))
    epochs = F.coalesce(F.floor(F.col("target") / F.nullif("source_size", F.lit(0))), F.lit(0))
    budgets = sizes.withColumn("epochs", epochs).withColumn("budget", F.col("target") - F.col("epochs") * F.col("source_size"))
    items = keyed.groupBy("source", "key", "doc_id").agg(F.sum("size").alias("size"))

    slices = 8 * shuffle_partitions(keyed.sparkSession)
    at = F.approx_percentile("key", [i / slices for i in range(1, slices)], 100_000)
    splitters = np.array(keyed.agg(at).first()[0] or [])
    number = lambda: lambda keys: {"slice": np.searchsorted(splitters, np.array(keys, float), "left")}
    sliced = stage(add_columns(items, T.StructType([T.StructField("slice", T.LongType())]), number, ("key",)))

    item = F.struct("key", "doc_id")
    sums = sliced.groupBy("source", "slice").agg(F.sum("size").alias("held"), F.max(item).alias("last"))
    running = Window.partitionBy("source").orderBy("slice").rowsBetween(Window.unboundedPreceding, 0)
    sums = sums.withColumn("end", F.sum("held").over(running))
    named = budgets.withColumnRenamed("source", "_source")
    sums = stage(sums.join(named, F.col("source").eqNullSafe(F.col("_source"))).drop("_source"))
    whole = sums.where("end <= budget").groupBy("source").agg(F.max("last").alias("last"))
    crossed = sums.where("end - held <= budget and end > budget").select(
        F.col("source").alias("_source"), F.col("slice").alias("_slice"), (F.col("end") - F.col("held")).alias("start"), "budget"
    )
    edge = sliced.join(crossed, F.col("source").eqNullSafe(F.col("_source")) & (F.col("slice") == F.col("_slice")))
    within = Window.partitionBy("source").orderBy("key", "doc_id").rowsBetween(Window.unboundedPreceding, 0)
    middle = F.col("start") + F.sum("size").over(within) - F.col("size") / 2
    taken = edge.withColumn("middle", middle).where("middle <= budget").groupBy("source").agg(F.max(item).alias("last"))
    last = whole.union(taken).groupBy(F.col("source").alias("_source")).agg(F.max("last").alias("last"))
    joined = budgets.join(last, F.col("source").eqNullSafe(F.col("_source")), "left")
    return stage(joined.select("source", "source_size", "target", "epochs", "last"))


def _named(docs: DataFrame) -> DataFrame:
    """``docs`` with ``_text``, the hash of the text, and ``_dealt``, a number for each row."""
    return docs.withColumns({"_text": F.md5(F.coalesce("text", F.lit("")).cast("binary")), "_dealt": F.monotonically_increasing_id()})


def _repeated(rows: DataFrame) -> DataFrame:
    """(doc_id, source, _text) of rows that are there more than once."""
    counts = rows.groupBy("doc_id", "source", "_text").count().where("count > 1")
    return counts.select(*[F.col(c).alias(f"_r{c}") for c in ("doc_id", "source", "_text")], F.lit(True).alias("_repeats"))


def _with_key(rows: DataFrame, repeated: DataFrame) -> DataFrame:
    """Rows with their key: the number counts for those that are repeated only."""
    same = [F.col(c).eqNullSafe(F.col(f"_r{c}")) for c in ("doc_id", "source", "_text")]
    number = F.when(F.col("_repeats"), F.col("_dealt"))
    key = exponential_key(F.col("doc_id"), F.col("_text"), number, F.col("_quality")).alias("key")
    return rows.join(repeated, same, "left").withColumn("key", key)


def _keyed(docs: DataFrame, stage: Stage) -> tuple[DataFrame, DataFrame]:
    """(doc_id, source, size, key) of every row, and the rows that are repeated."""
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    weight = quality(F.coalesce("text", F.lit("")))
    narrow = stage(_named(docs).select("doc_id", "source", "_text", "_dealt", size.alias("size"), weight.alias("_quality")))
    repeated = stage(_repeated(narrow))
    return stage(_with_key(narrow, repeated).select("doc_id", "source", "size", "key")), repeated


def _decided(rows: DataFrame, cut: DataFrame) -> DataFrame:
    """``rows`` (doc_id, source, key, ...) with the columns of their cut and ``copies``, how often each is taken."""
    cut = cut.withColumnRenamed("source", "_source")
    once_more = F.coalesce(F.struct("key", "doc_id") <= F.col("last"), F.lit(False)) & (F.col("target") > F.col("epochs") * F.col("source_size"))
    joined = rows.join(cut, F.col("source").eqNullSafe(F.col("_source")))
    return joined.withColumn("copies", F.col("epochs") + once_more.cast("long")).drop("_source")


def mix(docs: DataFrame, **options) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text, source): doc_id, size, source_size, target, taken."""
    stage = Stage(docs.sparkSession)
    keyed, _ = _keyed(docs, stage)
    decided = _decided(keyed, cuts(keyed, stage, **options))
    return decided.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: rows of ``docs`` as often as they are taken, all columns as they were.

    ``docs`` is read more than once. Where rows are repeated, which of them are taken is by their place in it, so
    it must be a table, whose rows come in one order.
    """
    stage = Stage(docs.sparkSession)
    keyed, repeated = _keyed(docs, stage)
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
    weight = quality(F.coalesce("text", F.lit(""))).alias("_quality")
    whole = _named(docs.select("doc_id", "source", "text", row, weight)).drop("text")
    whole = _with_key(whole, repeated).select("doc_id", "source", "key", "_row")
    copies = _decided(whole, cuts(keyed, stage, **options)).where("copies > 0")
    copies = copies.select("_row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("_copy"))
    return copies.select(*[F.col("_row").getField(c).alias(c) for c in docs.columns])


# The same mix for DuckDB.
ORACLE = r"""
WITH keyed AS (
    SELECT doc_id, source, text,
           coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
           length(coalesce(text, '')) AS chars,
           length(translate(coalesce(text, ''), '#*$%&|<>', '')) AS plain
    FROM documents),
ranked AS (
    SELECT doc_id, source, size,
           -ln((('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, 'null') || ':' || md5(coalesce(text, ''))), 1, 13))::BIGINT::DOUBLE
                + 0.5) / 4503599627370496.0)
           / greatest(0.1, 1.0::DOUBLE - 5.0::DOUBLE * (chars - plain) / greatest(chars, 1)) AS key
    FROM keyed),
sizes AS (SELECT source, sum(size)::BIGINT AS source_size FROM ranked GROUP BY source),
weighed AS (
    SELECT *, [3, 1, 2][((row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1)::INT] AS weight, source_size * 2 AS cap
    FROM sizes),
poured AS (
    SELECT *, cap::DOUBLE / weight AS fill,
           ((sum(source_size) OVER ())::DOUBLE * 1.5::DOUBLE
            - coalesce(sum(cap) OVER (ORDER BY cap::DOUBLE / weight, source ASC NULLS LAST
                                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE)
           / (sum(weight) OVER (ORDER BY cap::DOUBLE / weight, source ASC NULLS LAST
                                ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS level
    FROM weighed),
aimed AS (
    SELECT source, source_size,
           least(cap::DOUBLE, coalesce(weight * max(CASE WHEN fill > level THEN level END) OVER (), cap::DOUBLE)) AS target
    FROM poured),
budgets AS (
    SELECT *, coalesce(floor(target / nullif(source_size, 0)), 0)::BIGINT AS epochs FROM aimed),
items AS (SELECT source, key, doc_id, sum(size)::BIGINT AS size FROM ranked GROUP BY ALL),
summed AS (
    SELECT *, sum(size) OVER (PARTITION BY source ORDER BY key, doc_id ROWS UNBOUNDED PRECEDING) - size / 2.0 AS middle
    FROM items),
chosen AS (
    SELECT s.source, s.key, s.doc_id
    FROM summed s JOIN budgets b ON s.source IS NOT DISTINCT FROM b.source
    WHERE b.target > b.epochs * b.source_size AND s.middle <= b.target - b.epochs * b.source_size)
SELECT r.doc_id, r.size, b.source_size, b.target,
       (b.epochs + CASE WHEN c.key IS NULL THEN 0 ELSE 1 END) * r.size AS taken
FROM ranked r
JOIN budgets b ON r.source IS NOT DISTINCT FROM b.source
LEFT JOIN chosen c ON r.source IS NOT DISTINCT FROM c.source AND r.key = c.key AND r.doc_id IS NOT DISTINCT FROM c.doc_id
"""
