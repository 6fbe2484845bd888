"""Helpers the operators share: reading documents, Arrow functions in bounded blocks, staged tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from deskloom.session import run_folder, scale_to

# Text handled at once by a function in a task: bounds its Python objects, whatever the batch holds.
BLOCK_BYTES = 4 << 20

# Words of every contract: runs of anything but space and the ASCII controls from tab to carriage return.
WORD = r"[^\x20\x09-\x0D]+"


def documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """The documents table, or the named columns of it.

    Shuffles start with partitions for its size, and batches on their way to Python hold bytes, not rows, of a
    bounded number, as texts differ in length by orders of magnitude.
    """
    scale_to(spark, f"{sf_dir}/documents.parquet")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BLOCK_BYTES))
    table = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return table.select(*columns) if columns else table


def blocks(batches: Iterator[pa.RecordBatch], column: str, limit: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batches whose texts hold at most ``limit`` bytes together, or one row.

    By a column of another kind, the batches as they are: they are bounded in rows.
    """
    for batch in batches:
        if not pa.types.is_string(batch.column(column).type):
            yield batch
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
        start = held = 0
        for i, n in enumerate(sizes):
            if i > start and held + n > limit:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += n
        if start < len(sizes):
            yield batch.slice(start)


def add_columns(
    df: DataFrame,
    fields: T.StructType,
    make: Callable[[], Callable[..., dict]],
    inputs: tuple = ("text",),
    drop: tuple = (),
    limit: int = BLOCK_BYTES,
) -> DataFrame:
    """``df`` with columns computed in Arrow batches from the columns ``inputs``, the first of which, if text, bounds
    what is handled at once.

    ``make`` runs once per task; the function it returns takes a list per input (None: null) and returns
    lists by field name. Columns of ``df`` named like a field in any case are replaced; ``drop`` go.
    """
    replaced = {f.name.lower() for f in fields} | set(drop)
    kept = [f for f in df.schema.fields if f.name.lower() not in replaced]
    types = to_arrow_schema(fields)
    names = [f.name for f in kept]

    def run(batches):
        compute = make()
        for block in blocks(batches, inputs[0], limit):
            new = compute(*(block.column(c).to_pylist() for c in inputs))
            arrays = [block.column(n) for n in names] + [pa.array(new[f.name], type=f.type) for f in types]
            yield pa.RecordBatch.from_arrays(arrays, names=names + types.names)

    needed = list(dict.fromkeys([*names, *inputs]))
    return df.select(*[F.col(f"`{c}`") for c in needed]).mapInArrow(run, T.StructType([*kept, *fields]))


def keep_rows(df: DataFrame, make: Callable[[], Callable[..., list]], inputs: tuple = ("text",)) -> DataFrame:
    """Rows of ``df`` that the function accepts; all columns stay as they are."""

    def run(batches):
        accept = make()
        for block in blocks(batches, inputs[0]):
            passed = accept(*(block.column(c).to_pylist() for c in inputs))
            yield block.filter(pa.array(passed, type=pa.bool_()))

    return df.mapInArrow(run, df.schema)


class Stage:
    """Tables written to a shared folder and read back: what is read twice is computed once, and a lost
    executor costs no more than the files it had not written."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.folder = run_folder(spark)
        self.count = 0

    def __call__(self, df: DataFrame) -> DataFrame:
        self.count += 1
        path = f"{self.folder}/{self.count}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, number: int) -> None:
        """Delete the table that was staged as this one, which nothing reads any more."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{number}")
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def shuffle_partitions(spark: SparkSession) -> int:
    """How many partitions a shuffle starts with: the session's number, or more where the input asks for it."""
    asked = spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None)
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), int(asked or 0))
