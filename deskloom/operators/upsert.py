"""Keyed upsert as DataFrame work: newest version per key, merged into what is stored."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from deskloom.schema import RESOURCES, UNKNOWN_FIELD, Table


def apply_defaults(rows: DataFrame, table: Table) -> DataFrame:
    """Put the declared default in place of NULL."""
    filled = {c.name: c.default for c in table.columns if c.default is not None and c.name in rows.columns}
    return rows.select(
        *[F.coalesce(F.col(n), F.lit(filled[n])).alias(n) if n in filled else F.col(n) for n in rows.columns]
    )


def align(rows: DataFrame, table: Table, extra: list[str] | None = None) -> DataFrame:
    """Columns of the table in its order and types; a column the rows lack takes its default.

    ``extra`` names further columns to carry along.
    """
    return rows.select(
        *[
            (F.col(c.name) if c.name in rows.columns else F.lit(c.default)).cast(c.type).alias(c.name)
            for c in table.columns
        ],
        *(extra or []),
    )


def record_columns(table: Table) -> list[str]:
    """The columns an incoming record can set; the rest belong to the stored row."""
    resource = RESOURCES.get(table.name)
    if resource is None:
        return table.names
    return [column for column, _, _ in resource.members]


def keyed(rows: DataFrame, table: Table) -> DataFrame:
    """Rows with the key column that is not stored, where the table has one."""
    if UNKNOWN_FIELD not in table.key:
        return rows
    return rows.withColumn(UNKNOWN_FIELD, F.when(F.col("id") == 0, F.coalesce("title", F.lit(""))).otherwise(F.lit("")))


def newest(rows: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """One row per key: the greatest by ``order``, then by the whole row, so ties have one answer.

    Keeping only rank 1 lets Spark cut each key to one row before the shuffle (a group limit in
    every map task), so a key that holds a third of all rows is no hot spot.
    """
    rest = [c for c in rows.columns if c not in key and c not in order]
    ranked = Window.partitionBy(*key).orderBy(*[F.desc(c) for c in (order + rest) or key])
    return rows.withColumn("_rank", F.row_number().over(ranked)).filter(F.col("_rank") == 1).drop("_rank")


def repeats(rows: DataFrame, key: list[str]) -> bool:
    """Whether a key comes more than once. Where none does, whole rows need not be shuffled and sorted to see it."""
    most = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("_n")).agg(F.max("_n").alias("_most")).first()
    return (most["_most"] or 0) > 1


def _same_key(key: list[str]) -> Column:
    condition = F.lit(True)
    for column in key:
        condition = condition & (F.col(column) == F.col(f"_other_{column}"))
    return condition


def _other(rows: DataFrame, columns: list[str]) -> DataFrame:
    return rows.select(*[F.col(c).alias(f"_other_{c}") for c in columns], F.lit(True).alias("_found"))


def _newer(one: Column, other: Column) -> Column:
    """Strictly newer; NULL is older than anything."""
    return F.coalesce(one > other, one.isNotNull() & other.isNull())


def arrivals(
    stored: DataFrame, incoming: DataFrame, key: list[str], age: str | None = None, kept: list[str] | None = None
) -> DataFrame:
    """Incoming rows (one per key) that are to be written: new keys, and those not older than stored.

    A known key keeps its stored value in the ``kept`` columns.
    """
    kept = kept or []
    if age is None and not kept:
        return incoming
    columns = [*key, *([age] if age else []), *kept]
    found = incoming.join(_other(stored, columns), _same_key(key), "left")
    if age is not None:
        stale = F.col("_found").isNotNull() & _newer(F.col(f"_other_{age}"), F.col(age))
        found = found.filter(~stale)
    values = {c: F.when(F.col("_found"), F.col(f"_other_{c}")).otherwise(F.col(c)).alias(c) for c in kept}
    return found.select(*[values.get(c, F.col(c)) for c in incoming.columns])


def survivors(stored: DataFrame, incoming: DataFrame, key: list[str], age: str | None = None) -> DataFrame:
    """Stored rows that stay: keys that did not come in, and those newer than what came in."""
    if age is None:
        return stored.join(_other(incoming, key), _same_key(key), "left_anti")
    found = stored.join(_other(incoming, [*key, age]), _same_key(key), "left")
    stays = F.col("_found").isNull() | _newer(F.col(age), F.col(f"_other_{age}"))
    return found.filter(stays).select(*stored.columns)


def merge(
    stored: DataFrame,
    batch: DataFrame,
    key: list[str],
    age: str | None = None,
    order: list[str] | None = None,
    kept: list[str] | None = None,
) -> DataFrame:
    """Stored rows with a batch applied: insert new keys, replace known ones.

    Of two versions the one with the greater ``age`` stays, whichever came first; on a tie, and
    where there is no age, the incoming one. ``order`` names further batch columns that rank
    versions inside the batch and are not stored. ``kept`` are columns the batch cannot set.

    Both joins meet the other side's key and age only, so a small batch is broadcast to the
    stored rows and those are not shuffled.
    """
    order = order or []
    incoming = newest(batch, key, ([age] if age else []) + order).drop(*order)
    written = arrivals(stored, incoming, key, age, kept)
    return survivors(stored, incoming, key, age).unionByName(written.select(*stored.columns))
