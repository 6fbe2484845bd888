"""Follow a landing folder with Structured Streaming and load each micro-batch of pages.

Loads are idempotent, so a batch that is replayed after a failure leaves the same tables; its dead
letters are written under the batch's own label (the stream's id and the batch's number) and replace those
of the first try. No watermark is used: late records are never dropped, the newest version of a key stays.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from deskloom.operators.flatten import changed_ids
from deskloom.operators.hooks import Hooks
from deskloom.plans.sync import Load
from deskloom.session import LANDED, configure, scale_to
from deskloom.settings import AUDIT_TITLES
from deskloom.sinks.warehouse import Warehouse
from deskloom.sources.pages import (
    arrived,
    decode,
    decode_records,
    good,
    loadable,
    record_ticket,
    rejected_pages,
    rejected_records,
    split_pages,
)
from deskloom.streaming.progress import page_stream, progress_folder, start
from deskloom.streaming.waiting import Waiting

CHILDREN = ("audit", "changeevent", "ticketmetric")


def follow(
    spark: SparkSession,
    landing: str,
    warehouse: str,
    checkpoint: str | None = None,
    hooks: Hooks | None = None,
    files_per_batch: int | None = None,
    drain: bool = False,
    bytes_per_batch: int | None = None,
) -> StreamingQuery:
    """Load every resource from a landing folder; ``drain`` stops once all landed pages are loaded.

    Without a checkpoint of its own the stream goes on where the last ``run_sync`` of the folder ended.
    """
    scale_to(configure(spark), landing, times=LANDED)

    def each(pages: DataFrame, stream: str, number: int) -> None:
        Load(Warehouse(pages.sparkSession, warehouse), f"{stream}-{number}", hooks).run(pages)

    pages = page_stream(spark, landing, files_per_batch, bytes_per_batch)
    return start(pages, each, checkpoint or progress_folder(warehouse, landing), drain)


def follow_table(
    spark: SparkSession,
    landing: str,
    table: str,
    warehouse: str,
    checkpoint: str,
    files_per_batch: int | None = None,
    drain: bool = False,
    bytes_per_batch: int | None = None,
) -> StreamingQuery:
    """Load one resource as its pages land, with all checks against what is stored of its parents."""
    scale_to(configure(spark), landing, times=LANDED)

    def each(pages: DataFrame, stream: str, number: int) -> None:
        Load(Warehouse(pages.sparkSession, warehouse), f"{stream}-{number}", tables=(table,)).run(pages)

    return start(page_stream(spark, landing, files_per_batch, bytes_per_batch), each, checkpoint, drain)


def decode_stream(spark: SparkSession, landing: str, table: str, files_per_batch: int | None = None) -> DataFrame:
    """Typed records of one resource as a streaming frame."""
    return good(decode(loadable(page_stream(spark, landing, files_per_batch)), table))


def rejected_stream(spark: SparkSession, landing: str, table: str, files_per_batch: int | None = None) -> DataFrame:
    """What :func:`decode_stream` leaves out, as dead letters: failed and unknown pages, unreadable records."""
    split = split_pages(arrived(page_stream(spark, landing, files_per_batch)))
    return rejected_pages(split).unionByName(rejected_records(decode_records(split.filter(split["table"] == table), table), table))


def follow_children(
    spark: SparkSession,
    landing: str,
    children: str,
    warehouse: str,
    checkpoint: str | None = None,
    titles=AUDIT_TITLES,
    files_per_batch: int | None = None,
    drain: bool = False,
    bytes_per_batch: int | None = None,
) -> StreamingQuery:
    """Load the audits and metrics of changed tickets, whichever of the two lands first.

    One stream over the folder ``landing`` of ticket pages and the folder ``children`` of child pages. A child
    record is loaded in the batch in which both itself and a change of its ticket have landed: until then it
    waits, and a ticket once changed stays known (see :class:`Waiting`). Children go through the checks of every
    load; records that cannot be read become dead letters at once.
    """
    scale_to(configure(spark), landing, children, times=LANDED)

    def each(pages: DataFrame, stream: str, number: int) -> None:
        target = Warehouse(pages.sparkSession, warehouse)
        label = f"{stream}-{number}"
        staging = f"{label}-tickets"
        split = target.stage(split_pages(arrived(pages.filter(~F.col("_child")))), f"{staging}/records", by="table")
        tickets = target.stage(decode_records(split.filter(split["table"] == "ticket"), "ticket"), f"{staging}/decoded")
        target.quarantine(rejected_pages(split).unionByName(rejected_records(tickets, "ticket")), staging)
        waiting = Waiting(target, stream, number)
        known = waiting.know(changed_ids(good(tickets)))
        arriving = record_ticket(split_pages(arrived(pages.filter(F.col("_child")))))
        ready = waiting.release(arriving, known)
        Load(target, label, titles=titles, tables=CHILDREN).load(ready)
        waiting.forget()
        target.drop(f"staging/{staging}")

    tickets = page_stream(spark, landing, files_per_batch, bytes_per_batch).withColumn("_child", F.lit(False))
    both = tickets.unionByName(page_stream(spark, children, files_per_batch, bytes_per_batch).withColumn("_child", F.lit(True)))
    return start(both, each, checkpoint or progress_folder(warehouse, landing, children), drain)
