"""Document fingerprints by locally consistent parsing.

A text is parsed into phrases, and the names of the phrases into phrases again, ``LEVELS`` times. Where
phrases begin is decided by deterministic coin tossing: each name is compared with the one before it, and the
place and value of the lowest bit in which they differ become its label; three rounds and a reduction leave
labels 0 to 2 that differ from their neighbours'. Phrases begin at the largest labels around, and at the
smallest where those lie far apart. All of it looks at a few neighbours only, so equal substrings
are parsed alike but for their ends, wherever they stand. Runs of one name are one name first.

A phrase's name is a hash of the names in it. The fingerprint of a text is the ``KEPT`` least names of each of
the levels ``SKETCHED``, all of them if there are fewer, in hexadecimal; the likeness of two fingerprints is the
estimate of the share of common names (exact for short texts), averaged over the levels.

Null texts count as empty; the fingerprint of an empty text has no names, is like that of another empty text
(1) and unlike any other (0). Texts of any length are parsed whole, one of them in memory of a task at a
time. Repeated rows have equal fingerprints.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from deskloom.llm.common import Stage, add_columns, blocks, shuffle_partitions
from deskloom.llm.neardup import mix

LEVELS = 3
SKETCHED = (2, 3)
KEPT = 24
NAME_BITS = 48
PARSED_BYTES = 1 << 20
LEAST_ID = -(1 << 63)
# Keys sampled for each range of the order that next documents are found in.
PER_RANGE = 32
GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def _neighbours(values: np.ndarray, first: np.ndarray, last: np.ndarray, edge: int) -> tuple[np.ndarray, np.ndarray]:
    """The values before and after each one in its text, ``edge`` where there is none."""
    left, right = np.empty_like(values), np.empty_like(values)
    left[1:], right[:-1] = values[:-1], values[1:]
    left[first], right[last] = edge, edge
    return left, right


def labels(names: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Labels 0 to 2, unequal to their neighbours' but at the ends of a text, of names unequal to theirs."""
    label = names
    for _ in range(3):
        before = np.empty_like(label)
        before[1:] = label[:-1]
        before[first] = label[first] ^ label.dtype.type(1)
        differ = label ^ before
        low = differ & (~differ + label.dtype.type(1))
        place = np.where(differ == 0, 0, np.bitwise_count(low - label.dtype.type(1))).astype(label.dtype)
        label = (2 * place + (label >> place & label.dtype.type(1))).astype(np.uint8)
    for value in range(7, 2, -1):
        at = np.flatnonzero(label == value)
        if len(at):
            left = np.where(np.isin(at, first), 9, label[np.maximum(at - 1, 0)])
            right = np.where(np.isin(at, last), 9, label[np.minimum(at + 1, len(label) - 1)])
            free = [(left != v) & (right != v) for v in (0, 1)]
            label[at] = np.where(free[0], 0, np.where(free[1], 1, 2))
    return label


def parse(names: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The phrases of the names of several texts: their names, and the text each belongs to."""
    if not len(names):
        return names, owner
    begins = np.r_[True, (names[1:] != names[:-1]) | (owner[1:] != owner[:-1])]
    at = np.flatnonzero(begins)
    run = np.diff(np.r_[at, len(names)])
    names = np.where(run > 1, mix(names[at] + run.astype(np.uint64) * GOLDEN), names[at])
    owner = owner[at]

    first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
    last = np.r_[first[1:], len(owner)] - 1
    label = labels(names, first, last).astype(np.int8)
    left, right = _neighbours(label, first, last, 9)
    high = (label > left) & (label > right)
    left_high, right_high = _neighbours(high, first, last, True)
    low = (label < left) & (label < right) & ~left_high & ~right_high
    starts = high | low
    starts[first] = True

    at = np.flatnonzero(starts)
    length = np.diff(np.r_[at, len(names)])
    phrase = mix(length.astype(np.uint64) + GOLDEN)
    for k in range(int(length.max())):
        inside = np.flatnonzero(length > k)
        phrase[inside] = mix(phrase[inside] * GOLDEN + names[at[inside] + k])
    return phrase, owner[at]


def fingerprints(texts: list) -> list[str]:
    """Of each text a part per level, parts joined by ``-``: the least names in hexadecimal."""
    code = np.frombuffer("".join(t or "" for t in texts).encode("utf-32-le"), "<u4").astype(np.uint64)
    owner = np.repeat(np.arange(len(texts)), [len(t or "") for t in texts])
    parts: list[list[str]] = [[] for _ in texts]
    names = code
    for level in range(1, LEVELS + 1):
        names, owner = parse(names, owner)
        if level in SKETCHED:
            short = mix(names + np.uint64(level)) >> np.uint64(64 - NAME_BITS)
            order = np.lexsort((short, owner))
            short, whose = short[order], owner[order]
            new = np.r_[True, (short[1:] != short[:-1]) | (whose[1:] != whose[:-1])] if len(short) else np.zeros(0, bool)
            short, whose = short[new], whose[new]
            begin = np.searchsorted(whose, np.arange(len(texts) + 1))
            digits = short.astype(">u8").tobytes().hex()
            for i in range(len(texts)):
                upto = min(begin[i + 1], begin[i] + KEPT)
                parts[i].append("".join(digits[16 * j + 16 - NAME_BITS // 4 : 16 * j + 16] for j in range(begin[i], upto)))
    return ["-".join(p) for p in parts]


def likeness(one: str, other: str, size: int = NAME_BITS // 4) -> float:
    """From 0 to 1: the estimated share of common names, averaged over the levels."""
    found = []
    for a, b in zip(one.split("-"), other.split("-")):
        x = {a[i : i + size] for i in range(0, len(a), size)}
        y = {b[i : i + size] for i in range(0, len(b), size)}
        least = sorted(x | y)[:KEPT]
        found.append(len(x & y & set(least)) / len(least) if least else 1.0)
    return sum(found) / len(found)


def fingerprint(docs: DataFrame) -> DataFrame:
    """``docs`` with ``fingerprint`` (replacing such a column)."""
    fields = T.StructType([T.StructField("fingerprint", T.StringType())])
    return add_columns(docs, fields, lambda: lambda texts: {"fingerprint": fingerprints(texts)}, limit=PARSED_BYTES)


def _keyed(docs: DataFrame) -> DataFrame:
    """(doc_id, text) with the columns rows are ordered by: falling id, then the text's hash, then a number."""
    falling = F.bitwise_not(F.coalesce(F.col("doc_id").cast("long"), F.lit(LEAST_ID)))
    return docs.select(
        "doc_id", "text", falling.alias("_k"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("_t"), F.xxhash64(F.monotonically_increasing_id()).alias("_n")
    )


def _splitters(keys: DataFrame, ranges: int) -> list[tuple[int, int, int]]:
    """Keys at the quantiles of a sample drawn by size, ``PER_RANGE`` for a range."""
    total = keys.agg(F.sum("size")).first()[0] or 0
    uniform = F.xxhash64("_k", "_t", "_n", F.lit(1)).bitwiseAND((1 << 53) - 1) / F.lit(float(1 << 53))
    chance = F.least(F.lit(1.0), F.col("size") * F.lit(ranges * PER_RANGE / max(total, 1)))
    drawn = keys.withColumn("_p", chance).where(uniform < F.col("_p")).select("_k", "_t", "_n", F.col("size") / F.col("_p"))
    sample = sorted(tuple(r) for r in drawn.collect())
    ends = np.cumsum([w for *_, w in sample])
    at = np.searchsorted(ends, np.arange(1, ranges) * (ends[-1] / ranges)) if len(ends) else []
    return sorted({sample[i][:3] for i in at if i < len(sample)})


def _in_descending_ranges(docs: DataFrame) -> DataFrame:
    """Rows (_range, _ghost, doc_id, text) so that a range, in falling order of id, holds its rows and then, as a
    ghost, the one row that the whole order goes on with.

    Ranges are cut between any two rows, also of one id, or of one id and text, so none holds much more than its part
    of all bytes. What follows a range is a row with the least key of those beyond; rows with an equal key are equal.
    """
    spark = docs.sparkSession
    rows = _keyed(docs)
    size = (F.octet_length(F.coalesce("text", F.lit(""))) + F.lit(16)).cast("long").alias("size")
    keys = Stage(spark)(rows.select("_k", "_t", "_n", size))
    splitters = _splitters(keys, 4 * shuffle_partitions(spark))
    number = T.StructType([T.StructField("_range", T.LongType())])

    def make():
        return lambda k, t, n: {"_range": [bisect_right(splitters, key) for key in zip(k, t, n)]}

    dealt = add_columns(keys, number, make, ("_k", "_t", "_n"))
    # One key of each range reaches the driver: the one its order begins with.
    heads = {r["_range"]: tuple(r["head"]) for r in dealt.groupBy("_range").agg(F.min(F.struct("_k", "_t")).alias("head")).collect()}
    follows, after = [], heads[min(heads)] if heads else None
    for r in range(len(splitters), -1, -1):
        follows.append((r, *(after or (0, 0))))
        after = heads.get(r, after)
    ahead = spark.createDataFrame(follows, "_range long, _k long, _t long")
    # Three numbers for each range: a side of known size, which spares the texts a shuffle of their own.
    ghosts = rows.select("doc_id", "text", "_k", "_t").join(F.broadcast(ahead), ["_k", "_t"]).groupBy("_range", "_k", "_t")
    ghosts = ghosts.agg(F.min("doc_id").alias("doc_id"), F.min("text").alias("text"))
    plain = add_columns(rows, number, make, ("_k", "_t", "_n"))
    both = plain.select("_range", F.lit(0).alias("_ghost"), "_k", "_t", "_n", "doc_id", "text").union(
        ghosts.select("_range", F.lit(1), "_k", "_t", F.lit(0).cast("long"), "doc_id", "text")
    )
    return both.repartition(shuffle_partitions(spark), "_range").sortWithinPartitions("_range", "_ghost", "_k", "_t", "_n")


def with_next(docs: DataFrame) -> DataFrame:
    """Fingerprints beside those of edited texts and of next documents.

    One row per row of ``docs`` (doc_id, text): doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next. The next document is that of the next lower id, after the
    lowest that of the highest; of rows that share an id the next is the next by a hash of the text, null ids come
    last. The edited text has its last third of characters replaced by the first as many of the next one's.
    """
    schema = T.StructType(
        [
            docs.schema["doc_id"],
            T.StructField("n_chars", T.LongType()),
            T.StructField("edited_sha256", T.StringType()),
            T.StructField("fingerprint", T.StringType()),
            T.StructField("edited_fingerprint", T.StringType()),
            T.StructField("near_edited", T.DoubleType()),
            T.StructField("near_next", T.DoubleType()),
        ]
    )
    kind = docs.schema["doc_id"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []  # the last row seen, with its fingerprint, which waits for the next one
        for block in blocks(batches, "text", PARSED_BYTES):
            texts = [t or "" for t in block.column("text").to_pylist()]
            columns = (block.column(c).to_pylist() for c in ("_range", "_ghost", "doc_id"))
            rows = held + list(zip(*columns, texts, fingerprints(texts)))
            pairs = [(a, b) for a, b in zip(rows, rows[1:]) if a[0] == b[0] and not a[1]]
            held = rows[-1:]
            edited = []
            for (*_, text, _), (*_, other, _) in pairs:
                n = len(text) // 3
                edited.append(text[: len(text) - n] + other[:n])
            marks = fingerprints(edited)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([a[2] for a, _ in pairs], type=to_arrow(kind)),
                    pa.array([len(a[3]) for a, _ in pairs], pa.int64()),
                    pa.array([hashlib.sha256(e.encode()).hexdigest() for e in edited], pa.string()),
                    pa.array([a[4] for a, _ in pairs], pa.string()),
                    pa.array(marks, pa.string()),
                    pa.array([likeness(a[4], m) for (a, _), m in zip(pairs, marks)], pa.float64()),
                    pa.array([likeness(a[4], b[4]) for a, b in pairs], pa.float64()),
                ],
                names=schema.names,
            )

    return _in_descending_ranges(docs.select("doc_id", "text")).mapInArrow(run, schema)


def to_arrow(kind: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)
