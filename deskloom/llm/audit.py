"""Filter interaction audit: what each of five filters removes in every order they can be applied in.

A document fails a set of filters, kept as one bit per filter. Whatever the order, what a step keeps, removes
or finds gone already follows from how many documents fail each set, so documents are counted by set, at
most 32 a part, and the orders are read off those counts.

Four filters look at a document alone. The fifth fails a document whose text a smaller doc_id of the table
has, removed or not, by an existential self-join: rows are joined, left semi, on the text's hash, the exact
text and a smaller id, with one row per distinct text, its least id. Only texts whose hash and length occur
under several ids take part, and a text of many copies is dealt to slices of bounded size, each of which
meets the text's one row. The ids it marks are united with the ids of the other failures, and the bits of an
id are combined.

Rows are known by id, text and part. A null text is an empty one, a null source the part ''. Repeated rows
count each; rows that share an id and a text fail or pass together, for neither has a smaller id, and rows
without an id neither fail the fifth filter nor make others fail it. An empty text has no word, fails the
first filter and shares its text with other empty ones. Labels repeated for an id count if any of them
does. No documents, no rows; columns other than doc_id, text and source are not read.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deskloom.llm.common import Stage

SPACE = r"[\x20\x09-\x0D]+"
FILTERS = "ABCDE"
ORDERS = ["".join(p) for p in permutations(FILTERS)]
BIT = {f: 1 << i for i, f in enumerate(FILTERS)}
# Text of one class of copies that meets in one key of the self-join, about.
SLICE_CHARS = 4 << 20

KEY = ["doc_id", "part", "_hash", "_chars"]


def alone(text: Column) -> Column:
    """Bits of the filters that look at one text: few words, few distinct words, upper case, symbols."""
    words = F.array_remove(F.split(text, SPACE), "")
    n_words, distinct = F.size(words), F.size(F.array_distinct(words))
    failed = {
        "A": n_words < 200,
        "B": 100 * distinct < 50 * n_words,
        "C": 100 * F.regexp_count(text, F.lit("[A-Z]")) > 2 * F.length(text),
        "D": text.rlike("[#$%&*|]"),
    }
    return sum((F.when(bad, F.lit(BIT[f])).otherwise(F.lit(0)) for f, bad in failed.items()), F.lit(0))


def _named(docs: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return docs.select(
        "doc_id", F.coalesce("source", F.lit("")).alias("part"), F.xxhash64(text).alias("_hash"), F.length(text).alias("_chars"), text.alias("text")
    )


def repeats(docs: DataFrame, known: DataFrame, stage: Stage) -> DataFrame:
    """The rows of ``docs`` (:func:`_named`) whose text a smaller id has; ``known`` holds the keys of all its rows."""
    several = known.groupBy("_hash", "_chars").agg(F.count(F.lit(1)).alias("_rows"), F.min("doc_id").alias("_a"), F.max("doc_id").alias("_b"))
    slices = F.ceil(F.col("_rows") * (F.col("_chars") + 16) / SLICE_CHARS).cast("int").alias("_slices")
    several = several.where("_a < _b").select("_hash", "_chars", slices)
    # Read twice: written, so that the texts of the whole table are dealt out once.
    copies = stage(docs.join(several, ["_hash", "_chars"]))
    first = copies.groupBy("_hash", "text", "_slices").agg(F.min("doc_id").alias("_first"))
    # The one row of a text goes to every slice of its copies.
    first = first.select("_hash", "text", "_first", F.explode(F.sequence(F.lit(0), F.col("_slices") - 1)).alias("_slice"))
    dealt = copies.withColumn("_slice", F.pmod(F.xxhash64("doc_id", "part"), F.col("_slices")).cast("int"))
    smaller = (
        (dealt["_hash"] == first["_hash"])
        & (dealt["text"] == first["text"])
        & (dealt["_slice"] == first["_slice"])
        & (first["_first"] < dealt["doc_id"])
    )
    return dealt.join(first, smaller, "left_semi").select(*[dealt[c] for c in KEY])


def failure_sets(docs: DataFrame) -> DataFrame:
    """(doc_id, part, bits, n): how many rows of ``docs`` (doc_id, text, source) fail which filters."""
    stage = Stage(docs.sparkSession)
    named = _named(docs)
    known = stage(named.select(*KEY, alone(F.col("text")).alias("bits")).withColumn("n", F.lit(1).cast("long")))
    copied = repeats(named, known, stage).select(*KEY, F.lit(BIT["E"]).alias("bits"), F.lit(0).cast("long").alias("n"))
    return known.union(copied).groupBy(*KEY).agg(F.bit_or("bits").alias("bits"), F.sum("n").alias("n")).select("doc_id", "part", "bits", "n")


def _total(sets: Column, which, of: str) -> Column:
    return F.aggregate(F.filter(sets, which), F.lit(0).cast("long"), lambda held, s: held + s[of])


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """A row per part, order of the filters and step: counts of the part's documents there.

    ``labels`` (doc_id, quality, toxic) tells good (quality 1) and toxic (toxic 1) documents.
    """
    failing = failure_sets(docs).groupBy("doc_id", "part", "bits").agg(F.sum("n").alias("n"))
    marked = labels.groupBy("doc_id").agg(
        F.max((F.col("quality") == 1).cast("long")).alias("_good"), F.max((F.col("toxic") == 1).cast("long")).alias("_toxic")
    )
    counted = failing.join(marked.withColumnRenamed("doc_id", "_id"), F.col("doc_id") == F.col("_id"), "left")
    sums = [F.sum("n").alias("n")] + [
        F.sum(F.col("n") * F.coalesce(mark, F.lit(0).cast("long"))).alias(name) for name, mark in (("good", F.col("_good")), ("toxic", F.col("_toxic")))
    ]
    counted = counted.groupBy("part", "bits").agg(*sums)
    # At most one entry per set of filters.
    parts = counted.groupBy("part").agg(F.collect_list(F.struct("bits", "n", "good", "toxic")).alias("sets"))

    orders = parts.select("part", "sets", F.explode(F.array(*map(F.lit, ORDERS))).alias("filter_order"))
    steps = orders.select("*", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))).alias("step"))
    letter, earlier = F.expr("substring(filter_order, step, 1)"), F.expr("substring(filter_order, 1, step - 1)")
    own = sum((F.when(letter == f, F.lit(b)).otherwise(F.lit(0)) for f, b in BIT.items()), F.lit(0))
    before = sum((F.when(earlier.contains(f), F.lit(b)).otherwise(F.lit(0)) for f, b in BIT.items()), F.lit(0))
    steps = steps.withColumns({"own": own, "before": before})
    sets, own, before = F.col("sets"), F.col("own"), F.col("before")

    def fails(s: Column, bits: Column) -> Column:
        return s["bits"].bitwiseAND(bits) != 0

    def here(s: Column) -> Column:
        return fails(s, own) & ~fails(s, before)

    # Of all orders, one in as many as a document fails has the filter first among those.
    shares = F.aggregate(
        F.filter(sets, lambda s: fails(s, own)),
        F.lit(0).cast("long"),
        lambda held, s: held + (s["n"] * F.lit(len(ORDERS)) / F.bit_count(s["bits"])).cast("long"),
    )
    return steps.select(
        "part",
        "filter_order",
        "step",
        _total(sets, lambda s: ~fails(s, own.bitwiseOR(before)), "n").alias("kept"),
        _total(sets, here, "n").alias("removed"),
        _total(sets, lambda s: fails(s, own) & fails(s, before), "n").alias("redundant"),
        _total(sets, lambda s: s["bits"] == own, "n").alias("unique_fails"),
        _total(sets, here, "good").alias("good_lost"),
        _total(sets, here, "toxic").alias("toxic_lost"),
        shares.alias("shapley"),
    )


# The same audit for DuckDB.
ORACLE = r"""
WITH RECURSIVE texts AS (
    SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text FROM documents),
worded AS (
    SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
           min(doc_id) OVER (PARTITION BY text) AS first_id FROM texts),
failing AS (
    SELECT doc_id, part,
           (len(words) < 200)::INT
           + 2 * (100 * len(list_distinct(words)) < 50 * len(words))::INT
           + 4 * (100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 2 * length(text))::INT
           + 8 * regexp_matches(text, '[#$%&*|]')::INT
           + 16 * coalesce(first_id < doc_id, false)::INT AS bits
    FROM worded),
marks AS (
    SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id),
sets AS (
    SELECT part, bits, count(*) AS n, coalesce(sum(good), 0) AS good, coalesce(sum(toxic), 0) AS toxic
    FROM failing LEFT JOIN marks USING (doc_id) GROUP BY ALL),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS letter, unnest([1, 2, 4, 8, 16]) AS bit),
orders AS (
    SELECT '' AS filter_order
    UNION ALL
    SELECT filter_order || letter FROM orders, letters WHERE NOT contains(filter_order, letter)),
steps AS (
    SELECT o.filter_order, s.step::INT AS step, l.bit AS own,
           (SELECT coalesce(sum(e.bit), 0) FROM letters e WHERE contains(left(o.filter_order, s.step::INT - 1), e.letter))::INT AS before
    FROM orders o, range(1, 6) s(step), letters l
    WHERE length(o.filter_order) = 5 AND l.letter = substr(o.filter_order, s.step::INT, 1))
SELECT part, filter_order, step,
       coalesce(sum(n) FILTER ((bits & (own | before)) = 0), 0)::BIGINT AS kept,
       coalesce(sum(n) FILTER ((bits & own) != 0 AND (bits & before) = 0), 0)::BIGINT AS removed,
       coalesce(sum(n) FILTER ((bits & own) != 0 AND (bits & before) != 0), 0)::BIGINT AS redundant,
       coalesce(sum(n) FILTER (bits = own), 0)::BIGINT AS unique_fails,
       coalesce(sum(good) FILTER ((bits & own) != 0 AND (bits & before) = 0), 0)::BIGINT AS good_lost,
       coalesce(sum(toxic) FILTER ((bits & own) != 0 AND (bits & before) = 0), 0)::BIGINT AS toxic_lost,
       coalesce(sum(n * 120 // greatest(bit_count(bits), 1)) FILTER ((bits & own) != 0), 0)::BIGINT AS shapley
FROM sets, steps GROUP BY part, filter_order, step
"""
