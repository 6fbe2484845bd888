"""Rules of the base tables, as column expressions; bad rows are set aside with their reasons."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deskloom.schema import TABLES, Table

REASONS = "_reasons"


def not_null(columns: list[str]) -> list[Column]:
    return [F.when(F.col(c).isNull(), F.lit(f"{c}:null")) for c in columns]


def too_long(lengths: dict[str, int]) -> list[Column]:
    return [F.when(F.char_length(F.col(c)) > n, F.lit(f"{c}:length>{n}")) for c, n in lengths.items()]


def negative(columns: list[str]) -> list[Column]:
    return [F.when(F.col(c) < 0, F.lit(f"{c}:negative")) for c in columns]


def table_rules(table: Table, present: list[str]) -> list[Column]:
    """Every rule that needs only the row itself, for the columns at hand."""
    columns = [c for c in table.columns if c.name in present]
    return (
        not_null([c.name for c in columns if c.required])
        + too_long({c.name: c.length for c in columns if c.length})
        + negative([c.name for c in columns if c.unsigned])
    )


def tag(rows: DataFrame, rules: list[Column]) -> DataFrame:
    """Add the list of broken rules (empty for a good row, which no list is made for)."""
    found = none = F.array().cast("array<string>")
    if rules:
        found = F.when(reduce(or_, [r.isNotNull() for r in rules]), F.array_compact(F.array(*rules))).otherwise(none)
    if REASONS in rows.columns:
        found = F.concat(F.col(REASONS), found)
    return rows.withColumn(REASONS, found)


def references(rows: DataFrame, parents: Mapping[str, str], carry: list[str]) -> DataFrame:
    """One row per reference held: ``(carry..., reference, parent, parentid)``. NULL refers to nothing."""
    held = [
        F.struct(F.lit(column).alias("reference"), F.lit(parent).alias("parent"), F.col(column).alias("parentid"))
        for column, parent in parents.items()
    ]
    return rows.select(*carry, F.inline(F.array(*held))).filter(F.col("parentid").isNotNull())


def missing_parents(rows: DataFrame, parents: Mapping[str, str], tables: Mapping[str, DataFrame]) -> DataFrame:
    """``(parent, parentid)`` of every referenced row that does not exist, each once.

    Only distinct ids meet the parent tables, so a parent referenced by a third of all rows costs
    one row here, and the wide child rows are not shuffled on a reference. One pass covers all
    references of a table.
    """
    wanted = references(rows, parents, []).select("parent", "parentid").distinct()
    known = reduce(
        DataFrame.unionByName,
        [tables[name].select(F.lit(name).alias("parent"), F.col("id").alias("parentid")) for name in sorted(set(parents.values()))],
    )
    return wanted.join(known, ["parent", "parentid"], "left_anti")


def orphans(rows: DataFrame, parents: Mapping[str, str], tables: Mapping[str, DataFrame], key: list[str]) -> DataFrame:
    """One row per reference to a missing parent: ``(key..., reference, parentid)``."""
    missing = missing_parents(rows, parents, tables)
    return references(rows, parents, key).join(missing, ["parent", "parentid"], "left_semi").select(*key, "reference", "parentid")


def tag_orphans(rows: DataFrame, parents: Mapping[str, str], tables: Mapping[str, DataFrame], key: list[str]) -> DataFrame:
    """Add a reason for every reference to a missing parent. Rows come one per key."""
    if not parents:
        return tag(rows, [])
    found = orphans(rows, parents, tables, key)
    reason = F.concat("reference", F.lit(":no_parent"))
    # At most one reason per reference column of a key.
    listed = found.groupBy(*[F.col(k).alias(f"_key_{k}") for k in key]).agg(F.collect_set(reason).alias("_found"))
    same = reduce(lambda x, y: x & y, [F.col(k) == F.col(f"_key_{k}") for k in key])
    tagged = rows.join(listed, same, "left")
    if REASONS not in rows.columns:
        tagged = tag(tagged, [])
    # In the order of the references, as rules are reported in the order they are declared.
    wanted = F.array(*[F.lit(f"{column}:no_parent") for column in parents])
    every = F.concat(REASONS, F.coalesce(F.array_intersect(wanted, "_found"), F.array().cast("array<string>")))
    return tagged.withColumn(REASONS, every).select(*dict.fromkeys([*rows.columns, REASONS]))


def tag_moved(rows: DataFrame, stored: DataFrame, owner: str, arrived: str | None = None) -> DataFrame:
    """Add a reason where an id belongs to another owner: the stored one, else the first to arrive.

    ``arrived`` is the column that orders arrivals; without it the smallest owner counts as first.
    """
    rank = F.col(arrived) if arrived else F.lit(0).cast("bigint")
    claims = stored.select("id", F.lit(0).alias("_new"), F.lit(0).cast("bigint").alias("_at"), owner).unionByName(
        rows.select("id", F.lit(1).alias("_new"), rank.alias("_at"), owner)
    )
    first = claims.groupBy(F.col("id").alias("_id")).agg(F.min(F.struct("_new", "_at", owner))[owner].alias("_owner"))
    tagged = tag(
        rows.join(first, F.col("id") == F.col("_id"), "left"),
        [F.when(F.col("_owner") != F.col(owner), F.lit("parent_changed"))],
    )
    return tagged.drop("_id", "_owner")


def tag_missing(rows: DataFrame, parents: Mapping[str, str], missing: DataFrame) -> DataFrame:
    """As :func:`tag_orphans`, where the missing parents are already at hand as a stored table.

    One left join per reference. The missing parents of a sound load are few, so each join
    broadcasts them and the rows are not shuffled.
    """
    reasons = []
    for i, (column, parent) in enumerate(parents.items()):
        gone = missing.filter(F.col("parent") == parent).select(F.col("parentid").alias(f"_ref{i}"))
        rows = rows.join(gone, F.col(column) == F.col(f"_ref{i}"), "left")
        reasons.append(F.when(F.col(f"_ref{i}").isNotNull(), F.lit(f"{column}:no_parent")))
    return tag(rows, reasons).drop(*[f"_ref{i}" for i in range(len(reasons))])


def check(rows: DataFrame, table: str, tables: Mapping[str, DataFrame]) -> DataFrame:
    """Tag rows of a base table (one per key) with its row rules and its references."""
    spec = TABLES[table]
    tagged = tag(rows, table_rules(spec, rows.columns))
    return tag_orphans(tagged, spec.parents, tables, list(spec.key))


def accepted(tagged: DataFrame) -> DataFrame:
    return tagged.filter(F.size(REASONS) == 0).drop(REASONS)


def quarantined(tagged: DataFrame, table: str) -> DataFrame:
    """Bad rows as dead letters: key and payload as text, one row per bad record."""
    spec = TABLES[table]
    bad = tagged.filter(F.size(REASONS) > 0)
    return bad.select(
        F.lit(table).alias("resource"),
        F.concat_ws("/", *[F.col(k).cast("string") for k in spec.key]).alias("key"),
        F.array_join(REASONS, ",").alias("reason"),
        F.to_json(F.struct(*[c for c in spec.names if c in tagged.columns])).alias("payload"),
    )


def route_counts(tagged: DataFrame, table: str) -> DataFrame:
    """Rows read, accepted and quarantined."""
    bad = F.count_if(F.size(REASONS) > 0)
    total = F.count(F.lit(1))
    return tagged.agg(total.alias("read"), (total - bad).alias("accepted"), bad.alias("quarantined")).select(
        F.lit(table).alias("table"), "read", "accepted", "quarantined"
    )


def violations(rows: DataFrame, key: str, rules: list[Column]) -> DataFrame:
    """One row per broken rule."""
    return tag(rows, rules).select(key, F.explode(REASONS).alias("reason"))


def duplicate_keys(rows: DataFrame, key: list[str]) -> DataFrame:
    """Keys held by more than one row, and by how many."""
    return rows.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def holes(tickets: DataFrame, audits: DataFrame) -> DataFrame:
    """Tickets without any audit."""
    audited = audits.select(F.col("ticketid").alias("_ticket")).distinct()
    return tickets.select("id").join(audited, F.col("id") == F.col("_ticket"), "left_anti")
