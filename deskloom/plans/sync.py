"""The load: landed pages to base tables, parents before children."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import partial, reduce
from uuid import uuid4

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from deskloom.operators.flatten import audits_with, change_events, flatten_list, flatten_map, greatest_of_each, index_keys, index_titles
from deskloom.operators.hooks import Hook, Hooks
from deskloom.operators.quality import (
    REASONS,
    accepted,
    missing_parents,
    quarantined,
    table_rules,
    tag,
    tag_missing,
    tag_moved,
)
from deskloom.operators.upsert import arrivals, keyed, newest, repeats
from deskloom.schema import TABLES
from deskloom.session import LANDED, configure, configure_load, load_settings, scale_to
from deskloom.settings import AUDIT_TITLES
from deskloom.sinks.warehouse import REPORT, Warehouse, slice_of
from deskloom.sources.pages import (
    arrived,
    decode_records,
    good,
    once,
    read_pages,
    rejected_pages,
    rejected_records,
    split_pages,
)
from deskloom.streaming.progress import page_stream, progress_folder, start

# Parents come before children: a reference is checked against rows that are already committed.
LOAD_ORDER = (
    "ticketfields",
    "organizationfields",
    "userfields",
    "groups",
    "organization",
    "organizationdata",
    "user",
    "userdata",
    "ticket",
    "ticketdata",
    "satisfactionrating",
    "audit",
    "changeevent",
    "ticketmetric",
)
OFFSET_TABLES = ["organization", "user", "ticket", "satisfactionrating"]


class Load:
    """One load of a set of pages.

    Everything that is read more than once is first written under the warehouse: raw records once
    per load, then per table the decoded records and the checked rows. No lineage reaches back past
    those files. Tables that nothing landed for, or that are not among ``tables``, are left alone. The label
    names the load's dead letters and report: the same label again replaces them, another one adds to them.
    """

    def __init__(
        self,
        warehouse: Warehouse,
        label: str,
        hooks: Hooks | None = None,
        titles=AUDIT_TITLES,
        tables: tuple[str, ...] = LOAD_ORDER,
    ) -> None:
        self.warehouse = warehouse
        self.spark = configure_load(warehouse.spark)
        self.label = label
        self.hooks = hooks.copy() if hooks else Hooks()
        self.titles = titles
        self.tables = tables
        self.reports: list[tuple[str, int, int, int]] = []
        self.letters: list[DataFrame] = []
        self.reached: list[tuple[str, int]] = [(t, 0) for t in OFFSET_TABLES]
        self.touched: dict[str, list[int]] = {}
        self.decoded: dict[str, DataFrame] = {}
        self.placed: dict[str, dict[str, list[int]]] = {}
        self.single: set[str] = set()

    def _stage(self, name: str, rows: DataFrame, by: str | None = None) -> DataFrame:
        return self.warehouse.stage(rows, f"{self.label}/{name}", by)

    def run(self, pages: DataFrame) -> DataFrame:
        """Load the tables from pages; returns rows read, accepted and quarantined per table."""
        return self.load(split_pages(arrived(pages)))

    def load(self, records: DataFrame) -> DataFrame:
        """As :meth:`run`, from the raw records that pages were split into."""
        self.records = self._stage("records", records, by="table")
        self.letters.append(rejected_pages(self.records))
        self.landed = self.warehouse.staged_parts(f"{self.label}/records", "table")

        # Only the check of a record needs its parents: all are decoded first, so that no core waits for small tables.
        self._together(*[partial(self._decode, table) for table in LOAD_ORDER if self._has(table)])

        # Tables of one step do not refer to each other; their jobs share the cluster.
        roots = ("ticketfields", "organizationfields", "userfields", "groups", "ticketmetric")
        self._together(*[partial(self._load_resource, table) for table in roots])
        definitions = self.warehouse.read("ticketfields")
        audited = definitions.filter(F.col("title").isin(*self.titles))
        if "audit" in self.landed and "audit" in self.tables:
            audited = self._stage("ticketfields-audited", audited)
        self.hooks.register("audit", lambda a: audits_with(a, change_events(a, audited, self.titles)))

        organizations = self._load_resource("organization")
        users, _ = self._together(
            partial(self._load_resource, "user"),
            partial(self._load_map, "organizationdata", organizations, "organization"),
        )
        tickets, _ = self._together(
            partial(self._load_resource, "ticket"),
            partial(self._load_map, "userdata", users, "user"),
        )
        audits, *_ = self._together(
            partial(self._load_resource, "audit"),
            partial(self._load_list, "ticketdata", tickets, "ticket", definitions),
            partial(self._load_resource, "satisfactionrating"),
        )
        self._load_part("changeevent", audits, partial(change_events, definitions=audited, titles=self.titles))

        self.warehouse.quarantine(reduce(DataFrame.unionByName, self.letters), self.label)
        if self.reports:
            self.warehouse.save_report(self.reports, self.label)
            self.warehouse.advance_offsets(self.spark.createDataFrame(self.reached, "sequencename string, lastval long"))
        self.warehouse.drop(f"staging/{self.label}")
        return self.warehouse.report(self.label)

    def _together(self, *steps: Callable[[], DataFrame | None]) -> list[DataFrame | None]:
        """Run independent steps at the same time, each submitting its own jobs; all must succeed."""
        with ThreadPoolExecutor(max(len(steps), 1)) as pool:
            return [f.result() for f in [pool.submit(inheritable_thread_target(self.spark)(step)) for step in steps]]

    def _named(self, table: str, index: DataFrame, key: str, used: Column) -> DataFrame:
        """The entries of a field index that landed records name, as a stored table: few, however many definitions
        there are, so that the rows of all entities are not shuffled on a field that most of them share."""
        held = self.decoded[table].select(F.explode(used).alias("_key")).distinct()
        return self._stage(f"{table}-fields", index.join(held, F.col(key) == F.col("_key"), "left_semi"))

    def _load_map(self, table: str, records: DataFrame | None, parent: str) -> None:
        """Store the attributes of records that carry them by key."""
        if records is not None and table in self.tables:
            members = f"{parent}_fields"
            keys = self._named(parent, index_keys(self.warehouse.read(f"{parent}fields")), "skey", F.col(f"{members}.key"))
            entries = records.select("id", members)
            told = once(entries, "_told", greatest_of_each(F.col(members), "key")).select("id", F.col("_told").alias(members))
            self._load_part(table, told, partial(flatten_map, keys=keys, members=members), None)

    def _load_list(self, table: str, records: DataFrame | None, parent: str, definitions: DataFrame) -> None:
        """Store the attributes of records that carry them by field id."""
        if records is not None and table in self.tables:
            number = F.lit(0).cast("bigint")
            used = F.transform("custom_fields.id", lambda i: F.coalesce(i, number))
            titles = self._named(parent, index_titles(definitions), "id", used)
            entries = records.select("id", "custom_fields")
            told = once(entries, "_told", greatest_of_each(F.col("custom_fields"), "id", number)).select("id", F.col("_told").alias("custom_fields"))
            self._load_part(table, told, partial(flatten_list, titles=titles), None)

    def _load_part(self, table: str, records: DataFrame | None, flatten: Hook, order: Sequence[str] | None = ()) -> None:
        """Store the rows flattened out of what was stored of a resource, if anything was.

        Attributes lie in the slices that the records they came with lie in. Records come one per id: where each
        gives a key once, ``order`` is None and the rows need not be compared over all records.
        """
        if records is None or table not in self.tables:
            return
        spec, rows = TABLES[table], flatten(records)
        above = TABLES[next(iter(spec.parents.values()))]
        beside = spec.slice_by in spec.parents and (spec.slices, spec.slice_rows) == (above.slices, above.slice_rows)
        if beside:
            slices = {table: self.touched[above.name]}
        else:
            rows, slices = self._placed(f"{table}-rows", rows, table, {})
        self._store(table, rows, order, {}, slices)

    def _placed(self, name: str, rows: DataFrame, table: str, parents: dict[str, str]) -> tuple[DataFrame, dict[str, list[int]]]:
        """Stage rows, and the slices of the table and of its parents that they fall into, seen while they are
        written. Of rows with a ``problem`` none is counted."""
        spec, seen = TABLES[table], Observation()
        sound = F.col("problem").isNull() if "problem" in rows.columns else F.lit(True)
        places = {"own": slice_of(spec)} | {f"at_{c}": slice_of(TABLES[p], c) for c, p in parents.items()}
        staged = self._stage(name, rows.observe(seen, *[F.collect_set(F.when(sound, x)).alias(n) for n, x in places.items()]))
        found = seen.get
        slices = {table: sorted(found["own"])}
        for column, parent in parents.items():
            slices[parent] = sorted({*slices.get(parent, []), *found[f"at_{column}"]})
        return staged, slices

    def _has(self, table: str) -> bool:
        return table in self.landed and table in self.tables

    def _decode(self, table: str) -> None:
        """Stage the typed records of one resource, and see whether each key came once."""
        records = decode_records(self.records.filter(F.col("table") == table), table)
        # The raw text is only needed where a record could not be read.
        records = records.withColumn("record", F.when(F.col("problem").isNotNull(), F.col("record")))
        decoded, self.placed[table] = self._placed(f"{table}-decoded", records, table, TABLES[table].parents)
        self.letters.append(rejected_records(decoded, table))
        self.decoded[table] = good(decoded)
        # A hook may repeat keys; the one a load itself gives to audits later on only drops some.
        if table not in self.hooks and not repeats(keyed(self.decoded[table], TABLES[table]), list(TABLES[table].key)):
            self.single.add(table)

    def _load_resource(self, table: str) -> DataFrame | None:
        """Transform, check and store one resource that was decoded.

        Returns the stored records with their embedded members, so that what is flattened out of
        them belongs to accepted, current parents only.
        """
        if not self._has(table):
            return None
        spec, rows, slices = TABLES[table], self.decoded[table], self.placed[table]
        if table in self.hooks:
            rows, slices = self._placed(f"{table}-hooked", self.hooks.apply(table, rows), table, spec.parents)
            self.decoded[table] = rows
        order = ([spec.age] if spec.age else []) + ["fetched_at"]
        return self._store(table, rows, order, spec.parents, slices, table in self.single)

    def _counted(self, table: str, tagged: DataFrame) -> tuple[DataFrame, dict]:
        """Stage checked rows, and what is counted while they are written: rows, accepted ones, their newest age."""
        seen, fine = Observation(), F.size(REASONS) == 0
        reached = F.max(F.when(fine, F.col("updatedat"))) if table in OFFSET_TABLES else F.lit(None).cast("bigint")
        watched = tagged.observe(seen, F.count(F.lit(1)).alias("read"), F.count_if(fine).alias("accepted"), reached.alias("reached"))
        return self._stage(table, watched), seen.get

    def _store(
        self,
        table: str,
        rows: DataFrame,
        order: Sequence[str] | None,
        parents: dict[str, str],
        slices: dict[str, list[int]],
        single: bool = False,
    ) -> DataFrame | None:
        """Check the newest row of each key, set bad ones aside, write the others; returns those.

        ``parents`` are the references to check; rows flattened out of a stored record have none
        left to check. Of the table itself and of its parents only the touched ``slices`` are read. Without an
        ``order``, or where they are ``single``, rows come one per key and are not compared.
        """
        spec = TABLES[table]
        rows = keyed(rows, spec)
        self.touched[table] = slices[table] = self.warehouse.with_seed_slice(table, slices[table])
        if not slices[table]:
            return None
        stored = keyed(self.warehouse.read(table, slices[table]), spec)
        ranked = rows if single or order is None else newest(rows, list(spec.key), list(order))
        tagged = tag(ranked, table_rules(spec, rows.columns))
        if parents:
            known = {p: self.warehouse.read(p, slices[p]) for p in set(parents.values())}
            missing = self._stage(f"{table}-missing", missing_parents(rows, parents, known))
            tagged = tag_missing(tagged, parents, missing)
        if spec.owner:
            tagged = tag_moved(tagged, stored, spec.owner, "fetched_at" if "fetched_at" in (order or ()) else None)
        tagged, seen = self._counted(table, tagged)
        if not seen["read"]:
            return None
        self.letters.append(quarantined(tagged, table))
        self.reports.append((table, seen["read"], seen["accepted"], seen["read"] - seen["accepted"]))
        fine = accepted(tagged)
        if table in OFFSET_TABLES:
            self.reached.append((table, max(seen["reached"] or 0, 0)))
        self.warehouse.apply(table, fine.select(*[c for c in fine.columns if c in spec.names]), stored.select(*spec.names))
        return arrivals(stored, fine, list(spec.key), spec.age)


def run_sync(
    spark: SparkSession,
    landing: str,
    warehouse: str,
    label: str | None = None,
    hooks: Hooks | None = None,
    since: str | None = None,
    afresh: bool = False,
    bytes_per_batch: int | None = None,
) -> DataFrame:
    """Load what has landed in a folder since the last load into the base tables of a warehouse folder.

    The warehouse remembers which files it has loaded, in the same progress that ``follow`` keeps, so a load reads
    new files only, in batches of at most ``bytes_per_batch``. Returns rows read, accepted and quarantined per table.

    ``afresh``, a ``label`` or ``since`` read the folder without regard to that, in one batch: all of it, or the
    files modified after ``since`` (``yyyy-MM-dd'T'HH:mm:ss``, in the session's zone). A file that is read again
    changes nothing. Every load has a label of its own unless one is given, so dead letters of earlier loads
    stay; those of a given label are replaced.
    """
    configure(spark)
    scale_to(spark, landing, times=LANDED)
    target = Warehouse(spark, warehouse)
    if afresh or label or since:
        return Load(target, label or f"sync-{uuid4().hex}", hooks).run(read_pages(spark, landing, since))
    labels: list[str] = []

    def each(pages: DataFrame, stream: str, number: int) -> None:
        labels.append(f"{stream}-{number}")
        Load(Warehouse(pages.sparkSession, warehouse), labels[-1], hooks).run(pages)

    with load_settings(spark):
        pages = page_stream(spark, landing, bytes_per_batch=bytes_per_batch)
        start(pages, each, progress_folder(warehouse, landing), drain=True).awaitTermination()
    reports = [target.report(one) for one in dict.fromkeys(labels)]
    every = reduce(DataFrame.unionByName, reports, spark.createDataFrame([], REPORT))
    return every.groupBy("table").agg(*[F.sum(c).alias(c) for c in ("read", "accepted", "quarantined")])


def stored_rows(warehouse: Warehouse) -> DataFrame:
    """Rows stored per table, in load order."""
    counts = [
        warehouse.read(t).agg(F.count(F.lit(1)).alias("rows")).select(F.lit(i).alias("position"), F.lit(t).alias("table"), "rows")
        for i, t in enumerate(LOAD_ORDER, start=1)
    ]
    return reduce(DataFrame.unionByName, counts)
