"""Attribute rows to columns, one attribute at a time or many in one pass."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deskloom.functions.scalars import same_title


def attribute(rows: DataFrame, title: str, entity: str, name: str, exact: bool = True) -> DataFrame:
    """``(entity, value)`` of every row that carries the title."""
    return rows.filter(same_title(F.col("title"), title, exact)).select(
        F.col("objectid").alias(entity), F.col("value").alias(name)
    )


def pivot(rows: DataFrame, titles: Mapping[str, str], entity: str) -> DataFrame:
    """One row per entity that carries every title, with one column per title.

    One inner join per title, on the entity alone. A NULL value counts as present, and should two
    field definitions share a title, every combination is returned. The base tables keep rows of one
    title together, so each branch's pushed title filter skips the others' row groups and the rows
    are read and shuffled once in all. Measured at several times the speed of gathering text values
    in a grouped aggregate, which Spark can only do by sorting.
    """
    wide = None
    for name, title in titles.items():
        column = attribute(rows, title, entity, name)
        wide = column if wide is None else wide.join(column, entity)
    return wide


def pivot_one_pass(rows: DataFrame, titles: Mapping[str, str], entity: str) -> DataFrame:
    """As :func:`pivot`, in one read of the rows, for sources that are dear to read again.

    The key of the rows bounds a group: an entity has one row per field definition, so the list
    gathered per entity is no longer than the definitions that carry a wanted title.
    """
    wide = (
        rows.filter(F.col("title").isin(*titles.values()))
        .groupBy(F.col("objectid").alias(entity))
        .agg(F.collect_list(F.struct("title", "value")).alias("_rows"))
    )
    for name, title in titles.items():
        wide = wide.withColumn(name, F.explode(_values(title)))
    return wide.drop("_rows")


def _values(title: str) -> Column:
    held = F.filter("_rows", lambda row: row["title"] == title)
    return F.transform(held, lambda row: row["value"])


def pivot_unique(rows: DataFrame, titles: Mapping[str, str], entity: str) -> DataFrame:
    """As :func:`pivot`, by one maximum per title; only for rows that hold a title once per entity."""
    marks = [F.count_if(F.col("title") == title).alias(f"_n_{name}") for name, title in titles.items()]
    values = [F.max(F.when(F.col("title") == title, F.col("value"))).alias(name) for name, title in titles.items()]
    wide = (
        rows.filter(F.col("title").isin(*titles.values()))
        .groupBy(F.col("objectid").alias(entity))
        .agg(*marks, *values)
    )
    for name in titles:
        wide = wide.filter(F.col(f"_n_{name}") > 0)
    return wide.select(entity, *titles)
