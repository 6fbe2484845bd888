"""Base tables as parquet: immutable version folders, each holding the slices it rewrote.

    <root>/<table>/version=<n>/slice=<k>/part-*.parquet

A slice is one of a bounded number of groups that ranges of the table's slicing id are dealt to in turn, so
rows that change together lie together and there are never more folders than that, however far apart the
ids lie. An upsert rewrites only the slices its batch touches; the current table is,
for each slice, the folder of the newest committed version. Spark's ``_SUCCESS`` marker commits a
version, so a lost executor or a driver that dies half way leaves the previous state readable, and
a frame that reads an older version stays valid while a newer one is written.
"""

from __future__ import annotations

import re
from collections.abc import Mapping
from functools import reduce
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from deskloom.operators.upsert import align, arrivals, keyed, newest, record_columns, survivors
from deskloom.rows import no_rows, with_seed
from deskloom.schema import TABLES, Table

SLICE = "slice"
LETTER = "resource string, key string, reason string, payload string"
REPORT = "table string, read long, accepted long, quarantined long"


def slice_of(spec: Table, column: str | None = None) -> Column:
    """Slice of a row, by the table's slicing id or by another column that holds one."""
    if spec.slice_by is None:
        return F.lit(0).cast("bigint")
    # Whole-number division: as doubles, ids beyond 2^53 would fall into a neighbouring range.
    return F.pmod(F.call_function("div", F.col(column or spec.slice_by), F.lit(spec.slice_rows)), F.lit(spec.slices)).cast("bigint")


class Warehouse:
    """The base tables under one folder that every executor can reach."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark = spark
        self.root = root.rstrip("/")

    # --- folders ---

    def _path(self, name: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(name)
        return path, path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _found(self, pattern: str) -> list[str]:
        path, files = self._path(pattern)
        return [status.getPath().toString() for status in files.globStatus(path) or []]

    def exists(self, name: str) -> bool:
        path, files = self._path(name)
        return files.exists(path)

    def stage(self, rows: DataFrame, name: str, by: str | None = None) -> DataFrame:
        """Write rows that will be read more than once, and return them as read back.

        Besides cutting lineage this gives joins the true size of the rows.
        """
        folder = f"{self.root}/staging/{name}"
        writer = rows.write.mode("overwrite")
        (writer.partitionBy(by) if by else writer).parquet(folder)
        return self.spark.read.schema(rows.schema).parquet(folder)

    def staged_parts(self, name: str, by: str) -> set[str]:
        """Values of the column that staged rows were written apart by."""
        return {folder.rsplit("=", 1)[1] for folder in self._found(f"{self.root}/staging/{name}/{by}=*")}

    def drop(self, folder: str) -> None:
        """Delete a folder below the root."""
        path, files = self._path(f"{self.root}/{folder}")
        files.delete(path, True)

    def vacuum(self, table: str) -> list[int]:
        """Delete the versions that hold no current slice; for when no reader uses them any more."""
        current = {folder.rsplit("/", 2)[1] for folder in self._slices(table).values()}
        unused = [v for v in self.versions(table)[:-1] if f"version={v}" not in current]
        for version in unused:
            self.drop(f"{table}/version={version}")
        return unused

    def versions(self, table: str) -> list[int]:
        """Committed versions, oldest first."""
        marks = self._found(f"{self.root}/{table}/version=*/_SUCCESS")
        return sorted(int(re.search(r"version=(\d+)", m).group(1)) for m in marks)

    def _slices(self, table: str, version: int | None = None) -> dict[int, str]:
        """Slice number -> folder of its newest committed content, at most ``version`` old."""
        committed = {v for v in self.versions(table) if version is None or v <= version}
        newest_of: dict[int, tuple[int, str]] = {}
        for folder in self._found(f"{self.root}/{table}/version=*/{SLICE}=*"):
            v, k = map(int, re.search(rf"version=(\d+)/{SLICE}=(-?\d+)$", folder).groups())
            if v in committed and v >= newest_of.get(k, (-1, ""))[0]:
                newest_of[k] = (v, folder)
        return {k: folder for k, (_, folder) in newest_of.items()}

    # --- tables ---

    def read(self, table: str, only: list[int] | None = None, version: int | None = None) -> DataFrame:
        """The current rows of a table (or of some of its slices); a new table holds its seed row."""
        spec = TABLES[table]
        folders = self._slices(table, version)
        empty = no_rows(self.spark, spec.struct)
        if not folders:
            return with_seed(table, empty)
        wanted = folders.keys() if only is None else set(only)
        chosen = [path for k, path in folders.items() if k in wanted]
        if not chosen:
            return empty
        stored = T.StructType([*spec.struct.fields, T.StructField(SLICE, T.LongType())])
        return (
            self.spark.read.schema(stored)
            .option("basePath", f"{self.root}/{table}")
            .parquet(*sorted(chosen))
            .select(*spec.names)
        )

    def touched(self, table: str, rows: DataFrame, parents: Mapping[str, str] | None = None) -> dict[str, list[int]]:
        """Slices a batch falls into, of its own table and of the tables it refers to.

        ``parents`` maps reference columns to tables. One pass; what comes to the driver is at most a
        table's number of slices for each table.
        """
        spec = TABLES[table]
        if spec.slice_by is None and not parents:
            return {table: [0]}
        held = [F.struct(F.lit(table).alias("table"), slice_of(spec).alias(SLICE))]
        for column, parent in (parents or {}).items():
            held.append(F.struct(F.lit(parent).alias("table"), slice_of(TABLES[parent], column).alias(SLICE)))
        found = rows.select(F.inline(F.array(*held))).filter(F.col(SLICE).isNotNull()).distinct().collect()
        slices: dict[str, list[int]] = {name: [] for name in [table, *(parents or {}).values()]}
        for row in found:
            slices[row["table"]].append(row[SLICE])
        slices[table] = self.with_seed_slice(table, slices[table])
        return slices

    def with_seed_slice(self, table: str, slices: list[int]) -> list[int]:
        """The slices that a first batch writes: those it falls into, and the one the seed row lies in."""
        if slices and TABLES[table].seed is not None and 0 not in slices and not self.versions(table):
            return [*slices, 0]
        return slices

    def write(self, table: str, rows: DataFrame) -> int:
        """Commit rows, which must be the whole content of every slice they fall into."""
        spec = TABLES[table]
        version = (self.versions(table) or [0])[-1] + 1
        folder = f"{self.root}/{table}/version={version}"
        (
            align(rows, spec)
            .withColumn(SLICE, slice_of(spec))
            .hint("rebalance", SLICE)
            .sortWithinPartitions(SLICE, *(spec.sort_by or spec.key))
            .write.mode("overwrite")
            .partitionBy(SLICE)
            .parquet(folder)
        )
        return version

    def upsert(self, table: str, batch: DataFrame, order: list[str] | None = None) -> None:
        """Merge a batch into a table. Running it again with the same batch changes nothing.

        The batch may hold several versions of a key; ``order`` ranks them after the table's age. It is
        computed once: its newest rows are written before the slices they touch are merged.
        """
        spec, order = TABLES[table], order or []
        extra = [c for c in order if c not in spec.names]
        present = [c.name for c in spec.columns if c.name in batch.columns]
        rows = keyed(batch.select(*present, *extra), spec)
        ranked = newest(rows, list(spec.key), ([spec.age] if spec.age else []) + order)
        staging = f"upsert-{uuid4().hex}"
        staged = self.stage(ranked.select(*present), staging)
        slices = self.touched(table, staged)[table]
        if slices:
            self.apply(table, staged, self.read(table, slices))
        self.drop(f"staging/{staging}")

    def apply(self, table: str, incoming: DataFrame, stored: DataFrame) -> None:
        """Write stored slices with incoming rows (one per key) merged in.

        A column the records never carry keeps its stored value, or takes the default in a new row.
        """
        spec = TABLES[table]
        key = list(spec.key)
        kept = [c for c in spec.names if c not in incoming.columns and c not in record_columns(spec)]
        rows, held = keyed(align(incoming, spec), spec), keyed(stored, spec)
        written = arrivals(held, rows, key, spec.age, kept).select(*held.columns)
        self.write(table, survivors(held, rows, key, spec.age).unionByName(written))

    def offset(self, table: str) -> DataFrame:
        """One row: the newest ``updatedat`` stored, 0 for an empty table."""
        return fetch_offset(self.read(table))

    def advance_offsets(self, reached: DataFrame) -> None:
        """Raise stored offsets to those reached, ``(sequencename, lastval)``; none goes back."""
        every = self.read("sequencetable").select("sequencename", "lastval").unionByName(reached)
        self.upsert("sequencetable", every.groupBy("sequencename").agg(F.max("lastval").alias("lastval")))

    # --- dead letters and reports; the label names the load, so a replay replaces its own ---

    def quarantine(self, letters: DataFrame, label: str) -> None:
        """Set bad records aside."""
        letters.write.mode("overwrite").parquet(f"{self.root}/quarantine/{label}")

    def quarantined(self) -> DataFrame:
        """All dead letters of all loads."""
        return self._read_all("quarantine/*", LETTER)

    def save_report(self, counts: list[tuple[str, int, int, int]], label: str) -> None:
        """Keep what a load counted, one row per table."""
        self.spark.createDataFrame(counts, REPORT).coalesce(1).write.mode("overwrite").parquet(f"{self.root}/reports/{label}")

    def report(self, label: str = "*") -> DataFrame:
        """Rows read, accepted and quarantined per table, of one load or of all."""
        return self._read_all(f"reports/{label}", REPORT)

    def _read_all(self, folder: str, columns: str) -> DataFrame:
        if not self._found(f"{self.root}/{folder}/_SUCCESS"):
            return self.spark.createDataFrame([], columns)
        return self.spark.read.schema(columns).parquet(f"{self.root}/{folder}")


def fetch_offset(rows: DataFrame) -> DataFrame:
    """Where an incremental fetch starts: the newest ``updatedat``, at least 0."""
    newest_at = F.greatest(F.coalesce(F.max("updatedat"), F.lit(0)), F.lit(0))
    return rows.agg(newest_at.cast("bigint").alias("offset"))


def offsets(tables: dict[str, DataFrame]) -> DataFrame:
    """``(sequencename, lastval)`` of several tables."""
    return reduce(
        DataFrame.unionByName,
        [
            fetch_offset(rows).select(F.lit(name).alias("sequencename"), F.col("offset").alias("lastval"))
            for name, rows in tables.items()
        ],
    )
