"""Nested record members to narrow rows: custom fields and audit events."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deskloom.settings import AUDIT_EVENT_TYPE, AUDIT_TITLES


def index_titles(definitions: DataFrame) -> DataFrame:
    """Field id -> title."""
    return definitions.select("id", "title")


def index_keys(definitions: DataFrame) -> DataFrame:
    """Field key -> id."""
    return definitions.select("skey", "id")


def lookup(rows: DataFrame, index: DataFrame, on: str, key: str, value: str, default: object) -> DataFrame:
    """Add ``value`` of the index entry whose ``key`` equals ``on``; ``default`` where it has none.

    The index is one row per field definition. It is broadcast when its measured size allows
    that; past that size the join shuffles, and as a field id is shared by many entities, a hot
    id is spread over tasks by adaptive skew handling.
    """
    entry = index.select(F.col(key).alias("_key"), F.col(value).alias("_value"))
    return (
        rows.join(entry, F.col(on) == F.col("_key"), "left")
        .withColumn(value, F.coalesce("_value", F.lit(default)))
        .drop("_key", "_value")
    )


ATTRIBUTE = ("objectid", "id", "title", "value", "transformed")


def _attributes(rows: DataFrame, carry: Iterable[str]) -> DataFrame:
    return rows.withColumn("transformed", F.lit("")).select(*ATTRIBUTE, *carry)


def greatest_of_each(entries: Column, name: str, unnamed: Column | None = None) -> Column:
    """Of a record's entries ``(name, value)``, one per name: that with the greatest value. No row leaves its place.

    In the sorted list that is the entry before another name; a record that repeats no name stays as it is. Names are
    not NULL, unless ``unnamed`` is the name that NULL counts as.
    """
    named = entries
    if unnamed is not None:
        named = F.transform(entries, lambda e: F.struct(F.coalesce(e[name], unnamed).alias(name), e["value"].alias("value")))
    listed = F.array_sort(named)
    names = F.transform(listed, lambda e: e[name])
    after = F.concat(F.slice(names, 2, F.size(names)), F.array(F.lit(None)))
    paired = F.zip_with(listed, after, lambda e, following: F.struct(e.alias("entry"), following.alias("following")))
    last = F.filter(paired, lambda p: ~p["following"].eqNullSafe(p["entry"][name]))
    held = entries[name]
    apart = F.size(F.array_distinct(held)) == F.size(held)
    if unnamed is not None:
        # NULL, not false, where a name is NULL.
        apart = apart & ~F.coalesce(F.array_contains(held, unnamed), F.lit(True))
    return F.when(apart, entries).otherwise(F.transform(last, lambda p: p["entry"]))


def flatten_list(records: DataFrame, titles: DataFrame, members: str = "custom_fields", carry: Iterable[str] = ()) -> DataFrame:
    """``[{id, value}]`` of each record to attribute rows; the title comes from the field index."""
    carry = list(carry)
    rows = records.select(F.col("id").alias("objectid"), *carry, F.explode(members).alias("_f")).select(
        "objectid", *carry, F.coalesce("_f.id", F.lit(0).cast("bigint")).alias("id"), F.col("_f.value").alias("value")
    )
    return _attributes(lookup(rows, titles, "id", "id", "title", ""), carry)


def flatten_map(records: DataFrame, keys: DataFrame, members: str, carry: Iterable[str] = ()) -> DataFrame:
    """Key/value list of each record to attribute rows; the title is the key, the id is looked up."""
    carry = list(carry)
    rows = records.select(F.col("id").alias("objectid"), *carry, F.inline(members)).withColumnRenamed("key", "title")
    return _attributes(lookup(rows, keys, "title", "skey", "id", 0), carry)


def _event_rows(audits: DataFrame, carry: Iterable[str]) -> DataFrame:
    return audits.select(F.col("id").alias("auditid"), *carry, F.explode("events").alias("_e")).select(
        F.coalesce("_e.id", F.lit(0).cast("bigint")).alias("id"),
        "auditid",
        *[
            F.coalesce(F.col("_e")[name], F.lit("")).alias(column)
            for column, name in (("type", "type"), ("fieldname", "field_name"))
        ],
        F.col("_e.value").alias("value"),
        F.col("_e.previous_value").alias("pvalue"),
        *carry,
    )


def wanted_fields(definitions: DataFrame, titles: Iterable[str]) -> DataFrame:
    """Ids of the field definitions that carry one of the titles, with the title."""
    return definitions.filter(F.col("title").isin(*titles)).select(F.col("id").alias("_field"), F.col("title").alias("_title"))


def keep_events(events: DataFrame, definitions: DataFrame, titles: Iterable[str] = AUDIT_TITLES) -> DataFrame:
    """Change events on one of the wanted fields. A field name that is no number matches none."""
    fields = wanted_fields(definitions, titles)
    number = F.col("fieldname").try_cast("bigint")
    return events.filter(F.col("type") == AUDIT_EVENT_TYPE).join(fields, number == F.col("_field"), "left_semi")


def change_events(audits: DataFrame, definitions: DataFrame, titles: Iterable[str] = AUDIT_TITLES, carry: Iterable[str] = ()) -> DataFrame:
    """Kept change events of all audits, each stamped with its audit's id."""
    return keep_events(_event_rows(audits, list(carry)), definitions, titles)


def audits_with(audits: DataFrame, events: DataFrame) -> DataFrame:
    """Audits that have at least one kept event."""
    owners = events.select(F.col("auditid").alias("_audit")).distinct()
    return audits.join(owners, F.col("id") == F.col("_audit"), "left_semi")


def changed_ids(records: DataFrame) -> DataFrame:
    return records.select("id").distinct()


def accumulate(*batches: DataFrame) -> DataFrame:
    """All rows of all batches; their order carries no meaning."""
    first, *rest = batches
    for batch in rest:
        first = first.unionByName(batch)
    return first


def numeric_text_join(rows: DataFrame, text: Column, definitions: DataFrame) -> DataFrame:
    """Join a text column holding numbers to the numeric id of the field definitions."""
    fields = definitions.select(F.col("id").alias("fieldid"), F.col("title").alias("fieldtitle"))
    return rows.join(fields, text.try_cast("bigint") == F.col("fieldid"))
