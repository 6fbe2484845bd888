"""Small literal tables."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from deskloom.schema import TABLES


def literal_rows(spark: SparkSession, struct: T.StructType, rows: Iterable[tuple]) -> DataFrame:
    """A few constant rows as a one-partition plan whose size the optimizer can tell."""
    records = [
        F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(row, struct.fields, strict=True)])
        for row in rows
    ]
    return spark.range(0, 1, 1, 1).select(F.inline(F.array(*records)))


def no_rows(spark: SparkSession, struct: T.StructType) -> DataFrame:
    """An empty table that the optimizer knows to be empty, so that joins with it go away."""
    return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in struct.fields]).limit(0)


def with_seed(table: str, df: DataFrame) -> DataFrame:
    """Append the sentinel row of a base table (id 0), for tables that have one."""
    spec = TABLES[table]
    row = spec.seed_row()
    if row is None:
        return df
    return df.unionByName(literal_rows(df.sparkSession, spec.struct, [row]))
