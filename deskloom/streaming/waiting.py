"""What a stream of children keeps between its batches: ids of changed tickets, and records that came before them.

    <root>/waiting/<stream>/changed/batch=<n>    ids first seen in the batch, or every id known by then
    <root>/waiting/<stream>/records/batch=<n>    all records that still wait after the batch

A batch reads what the batches before it left and writes its own folders, so replaying it gives the same. Ids are
written once each and gathered into one folder every ``GATHER`` batches; records are few where children follow
their tickets, and leave with the batch that knows their ticket.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from deskloom.sinks.warehouse import Warehouse

GATHER = 32
IDS = "id long"


class Waiting:
    def __init__(self, warehouse: Warehouse, stream: str, number: int) -> None:
        self.warehouse = warehouse
        self.spark = warehouse.spark
        self.folder = f"waiting/{stream}"
        self.number = number

    def _batches(self, kind: str, first: int) -> list[str]:
        """Folders of a kind that the batches from ``first`` to the one before this left."""
        every = (f"{self.warehouse.root}/{self.folder}/{kind}/batch={n}" for n in range(max(first, 0), self.number))
        return [folder for folder in every if self.warehouse.exists(f"{folder}/_SUCCESS")]

    def _write(self, rows: DataFrame, kind: str) -> str:
        folder = f"{self.warehouse.root}/{self.folder}/{kind}/batch={self.number}"
        rows.write.mode("overwrite").parquet(folder)
        return folder

    def known(self) -> DataFrame:
        """Ids that earlier batches know, each once."""
        folders = self._batches("changed", (self.number - 1) // GATHER * GATHER)
        if not folders:
            return self.spark.createDataFrame([], IDS)
        return self.spark.read.schema(IDS).parquet(*folders)

    def know(self, ids: DataFrame) -> DataFrame:
        """Add the ids of changed tickets; returns all that are known now."""
        before = self.known()
        fresh = ids.select("id").distinct().join(before, "id", "left_anti")
        folder = self._write(before.unionByName(fresh) if self.number % GATHER == 0 else fresh, "changed")
        now = self.spark.read.schema(IDS).parquet(folder)
        return now if self.number % GATHER == 0 else before.unionByName(now)

    def release(self, arriving: DataFrame, known: DataFrame) -> DataFrame:
        """Of the records that waited and those that arrive, with the ``_ticket`` each belongs to, those whose
        ticket is known or that name none; the others wait on."""
        held = self._batches("records", self.number - 1)
        if held:
            arriving = arriving.unionByName(self.spark.read.schema(arriving.schema).parquet(*held))
        found = known.select(F.col("id").alias("_known"))
        told = arriving.join(found, F.col("_ticket") == F.col("_known"), "left")
        waits = F.col("_ticket").isNotNull() & F.col("_known").isNull()
        told = self.warehouse.stage(told.withColumn("_waits", waits).drop("_known"), f"{self.folder}-{self.number}", by="_waits")
        self._write(told.filter("_waits").select(*arriving.columns), "records")
        return told.filter("NOT _waits").drop("_waits", "_ticket")

    def forget(self) -> None:
        """Drop what no later batch reads."""
        self.warehouse.drop(f"staging/{self.folder}-{self.number}")
        self.warehouse.drop(f"{self.folder}/records/batch={self.number - 2}")
        if self.number and self.number % GATHER == 0:
            for n in range(self.number - GATHER, self.number - 1):
                self.warehouse.drop(f"{self.folder}/changed/batch={n}")
