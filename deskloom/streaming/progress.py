"""Which landed files were loaded already: the checkpoint of a Structured Streaming file source.

A batch load and a stream over the same landing folder share it, so a load lists a file once and no more. A
micro-batch takes files of at most ``BYTES_PER_BATCH``, unless a number of files is given instead: a backfill
becomes many loads of bounded size, each committed before the next.
"""

from __future__ import annotations

from collections.abc import Callable
from hashlib import sha256

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from deskloom.schema import PAGE
from deskloom.session import configure_stream

BYTES_PER_BATCH = 256 << 30


def page_stream(
    spark: SparkSession, landing: str, files_per_batch: int | None = None, bytes_per_batch: int | None = None
) -> DataFrame:
    """Pages as they land, so many files or bytes of files at once."""
    reader = spark.readStream.schema(PAGE)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    else:
        reader = reader.option("maxBytesPerTrigger", str(bytes_per_batch or BYTES_PER_BATCH))
    return reader.json(landing)


def progress_folder(warehouse: str, *landings: str) -> str:
    """Where a warehouse keeps what it has loaded of landing folders."""
    name = sha256("\n".join(f.rstrip("/") for f in landings).encode()).hexdigest()[:16]
    return f"{warehouse.rstrip('/')}/progress/{name}"


def start(pages: DataFrame, each: Callable[[DataFrame, str, int], None], checkpoint: str, drain: bool) -> StreamingQuery:
    """Hand each micro-batch over with the stream's name, which no other stream has, and the batch's number.

    ``drain`` ends the stream once all that has landed is loaded.
    """

    def numbered(batch: DataFrame, number: int) -> None:
        # The id that the checkpoint keeps: a new checkpoint is a new stream, at the same place too.
        stream = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        each(batch, f"stream-{stream}", number)

    writer = pages.writeStream.foreachBatch(numbered).option("checkpointLocation", checkpoint)
    if drain:
        writer = writer.trigger(availableNow=True)
    configure_stream(pages.sparkSession)
    return writer.start()
