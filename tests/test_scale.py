"""What loads move and hold: plans and files that decide it, on rows made here."""

from __future__ import annotations

import os

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from deskloom import catalog, session
from deskloom.operators import quality
from deskloom.operators.flatten import greatest_of_each
from deskloom.operators.upsert import newest, repeats, survivors
from deskloom.plans.sync import run_sync
from deskloom.sample import Desk, to_pages
from deskloom.schema import TABLES
from deskloom.session import configure_load, scale_to
from deskloom.sinks.warehouse import Warehouse
from deskloom.sources import pages

SF = "/root/testdata/sf0.001"


def optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def executed(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def load_settings(spark):
    name = "spark.sql.sources.fileCompressionFactor"
    configure_load(spark)
    yield
    spark.conf.unset(name)


def test_a_table_that_holds_nothing_is_not_joined(spark, tmp_path):
    """Else the whole batch is broadcast to it."""
    stored = Warehouse(spark, str(tmp_path)).read("ticketdata")
    batch = spark.range(1000).select(F.col("id").alias("objectid"), "id", F.lit("t").alias("title"), F.lit("v").alias("value"), F.lit("").alias("transformed"))
    assert [f.simpleString() for f in stored.schema] == [f.simpleString() for f in TABLES["ticketdata"].struct]
    assert "Join" not in optimized(survivors(stored, batch, ["objectid", "id"]))
    assert stored.count() == 0


def test_rows_of_few_bytes_are_not_taken_for_a_small_table(spark, tmp_path, load_settings):
    spark.range(0, 1_500_000, 1, 4).select((F.col("id") * 3).alias("objectid"), F.lit(101).alias("id"), F.lit("t").alias("title")).write.parquet(f"{tmp_path}/rows")
    rows = spark.read.parquet(f"{tmp_path}/rows")
    held = sum(f.stat().st_size for f in (tmp_path / "rows").glob("*.parquet"))
    assert held < 10 << 20  # the threshold of a broadcast
    assert rows._jdf.queryExecution().optimizedPlan().stats().sizeInBytes() > 10 << 20


def test_greatest_entry_of_each_name(spark):
    rows = spark.createDataFrame(
        [(1, [(5, "b"), (4, None), (5, "c"), (4, "a"), (5, None)]), (2, []), (3, None), (4, [(7, None)]), (5, [(0, "x"), (0, "x")])],
        "id long, f array<struct<id: long, value: string>>",
    )
    flat = rows.select(F.col("id").alias("objectid"), F.inline("f"))
    kept = rows.select(F.col("id").alias("objectid"), F.inline(greatest_of_each(F.col("f"), "id")))
    assert rows_of(kept) == rows_of(newest(flat, ["objectid", "id"], []))
    assert "Exchange" not in executed(kept)


def test_fields_are_looked_up_among_those_named(spark, tmp_path):
    """A definition nobody names is not joined with; a repeated, an unknown and a nameless field are stored as before."""
    body = '{"%s": [%s]}'
    fields = ",".join(f'{{"id": {i}, "type": "text", "key": "k{i}", "title": "t{i}"}}' for i in range(1, 400))
    ticket = '{"id": 1, "subject": "s", "status": "open", "custom_fields": [{"id": 7, "value": "a"}, {"id": 7, "value": "b"}, {"id": 900, "value": "u"}, {"value": "n"}, {"id": 8}]}'
    group = '{"id": 1, "name": "o", "group_id": 0, "organization_fields": {"k9": "x", "other": "y"}}'
    bodies = [("ticket_fields", fields), ("organization_fields", fields), ("tickets", ticket), ("groups", '{"id": 5, "name": "g"}'), ("organizations", group)]
    landed = spark.createDataFrame([(f"https://d.example.com/{m}.json", 200, 1, body % (m, r)) for m, r in bodies], pages.PAGE)
    landed.write.json(f"{tmp_path}/landing")
    staged = {}
    stage = Warehouse.stage

    def counted(self, rows, name, by=None):
        out = stage(self, rows, name, by)
        staged[name.rsplit("/", 1)[-1]] = out.count()
        return out

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(Warehouse, "stage", counted)
        run_sync(spark, f"{tmp_path}/landing", f"{tmp_path}/tables", afresh=True)
    spark.conf.unset("spark.sql.sources.fileCompressionFactor")
    assert (staged["ticket-fields"], staged["organization-fields"]) == (2, 1)
    target = Warehouse(spark, f"{tmp_path}/tables")
    assert rows_of(target.read("ticketdata"), "id", "title", "value") == [(0, "", "n"), (7, "t7", "b"), (8, "t8", None), (900, "", "u")]
    assert rows_of(target.read("organizationdata"), "id", "title", "value") == [(0, "other", "y"), (9, "k9", "x")]


def test_pages_are_made_where_their_source_rows_were_dealt(spark):
    desk = Desk(spark, SF)
    for table, source in (("ticket", "orders"), ("organization", "customer"), ("audit", "events")):
        plan = executed(to_pages(desk.records(table), table))
        assert plan.count("Exchange ") == 1, table
        assert plan.index("partial_collect_list") < plan.index("Exchange ") < plan.index(f"{source}.parquet")


def test_landed_pages_are_compressed_and_read_as_before(spark, tmp_path):
    target = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(target)
    desk = Desk(spark, SF)
    folder = catalog._land(desk.pages("ticket"), f"{tmp_path}/landing")
    assert spark.conf.get(target) == before
    assert all(f.endswith(".json.gz") for f in os.listdir(folder) if f.startswith("part-"))
    read = pages.good(pages.decode(pages.read_pages(spark, folder), "ticket"))
    assert rows_of(read, "id", "status", "updatedat") == rows_of(desk["ticket"], "id", "status", "updatedat")


def test_shuffles_of_compressed_pages_start_with_more_partitions(spark, tmp_path, monkeypatch):
    (tmp_path / "data").write_bytes(b"x" * 10_000)
    monkeypatch.setattr("deskloom.session.PARTITION_BYTES", 1000)
    assert scale_to(spark, str(tmp_path), times=8) == 80
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.initialPartitionNum")


def test_short_circles_end_the_walk_early(spark, monkeypatch):
    """A thousand circles of three pages behind two others each: rounds follow the longest walk."""
    folders = []
    folder = pages.run_folder
    monkeypatch.setattr(pages, "run_folder", lambda s: folders.append(folder(s)) or folders[-1])
    base = "https://desk.example.com/api/v2/groups.json?page="
    n, step = F.col("id"), F.col("id") % 5
    to = F.when(step == 4, n - 2).otherwise(n + 1)
    body = F.concat(F.lit('{"groups": [{"id": 1}], "next_page": "'), F.lit(base), to.cast("string"), F.lit('"}'))
    landed = spark.range(5000).select(F.concat(F.lit(base), n.cast("string")).alias("url"), F.lit(200).alias("status_code"), n.alias("fetched_at"), body.alias("body"))
    entries = spark.range(5000).filter("id % 10 = 1").select(F.concat(F.lit(base), n.cast("string")).alias("url"))
    found = pages.chain_reach(landed, entries)
    number = F.substring_index("url", "=", -1).cast("long")
    want = spark.range(5000).select("id", ((n % 10 >= 1) & (n % 10 < 5)).alias("reached"), (step >= 2).alias("cyclic")).filter("NOT reached OR cyclic")
    assert rows_of(found.select(number.alias("id"), "reached", "cyclic")) == rows_of(want)
    assert len(os.listdir(folders[0].removeprefix("file:"))) <= 2 + 2 * 6


def test_a_load_reads_landed_files_in_small_even_tasks(spark, tmp_path, monkeypatch):
    """Also through the stream that keeps the progress, which splits its files by the settings it was started with."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.maxConcurrentOutputFileWriters")
    before = [spark.conf.get(n) for n in names]
    body = F.concat(F.lit('{"groups": [{"id": '), F.col("id") + 1, F.lit(', "name": "g"}]}'))
    landed = spark.range(0, 400, 1, 20).select(F.lit("https://d.example.com/groups.json").alias("url"), F.lit(200).alias("status_code"), F.col("id").alias("fetched_at"), body.alias("body"))
    landed.write.json(f"{tmp_path}/landing")
    tasks = {}
    stage = Warehouse.stage

    def counted(self, rows, name, by=None):
        tasks[name.rsplit("/", 1)[-1]] = rows.rdd.getNumPartitions()
        return stage(self, rows, name, by)

    monkeypatch.setattr(Warehouse, "stage", counted)
    monkeypatch.setattr("deskloom.session.LOAD_SETTINGS", {**session.LOAD_SETTINGS, names[0]: "4m"})
    run_sync(spark, f"{tmp_path}/landing", f"{tmp_path}/tables")
    assert tasks["records"] == 20
    assert [spark.conf.get(n) for n in names] == before
    assert Warehouse(spark, f"{tmp_path}/tables").read("groups").count() == 401
    assert int(session.LOAD_SETTINGS[names[0]].rstrip("m")) <= 16


def test_fields_that_repeat_nowhere_are_left_as_they_are(spark):
    """Only a record that repeats one has its entries sorted and compared."""
    rows = spark.createDataFrame([(1, [(9, "b"), (4, None)]), (2, [(9, "b"), (4, "z"), (9, "c")])], "id long, f array<struct<id: long, value: string>>")
    kept = {r["id"]: [tuple(e) for e in r["k"]] for r in rows.select("id", greatest_of_each(F.col("f"), "id").alias("k")).collect()}
    assert kept == {1: [(9, "b"), (4, None)], 2: [(4, "z"), (9, "c")]}


def test_attributes_are_made_unique_once_a_record(spark, tmp_path, monkeypatch):
    """Else the optimizer repeats the work in the filters it derives from taking the list apart."""
    ticket = '{"id": 1, "subject": "s", "status": "open", "custom_fields": [{"id": 7, "value": "a"}, {"id": 7, "value": "b"}]}'
    group = '{"id": 1, "name": "o", "group_id": 0, "organization_fields": {"k9": "x"}}'
    bodies = [("tickets", ticket), ("groups", '{"id": 5, "name": "g"}'), ("organizations", group)]
    landed = spark.createDataFrame([(f"https://d.example.com/{m}.json", 200, 1, '{"%s": [%s]}' % (m, r)) for m, r in bodies], pages.PAGE)
    landed.write.json(f"{tmp_path}/landing")
    plans = {}
    stage = Warehouse.stage

    def seen(self, rows, name, by=None):
        plans[name.rsplit("/", 1)[-1]] = optimized(rows)
        return stage(self, rows, name, by)

    monkeypatch.setattr(Warehouse, "stage", seen)
    run_sync(spark, f"{tmp_path}/landing", f"{tmp_path}/tables")
    for table in ("ticketdata", "organizationdata"):
        assert plans[table].count("array_distinct") == 1, table
    assert rows_of(Warehouse(spark, f"{tmp_path}/tables").read("ticketdata"), "id", "value") == [(7, "b")]


def load_of(spark, folder, monkeypatch, bodies) -> tuple[dict[str, str], Warehouse]:
    """Load pages of (member, record); the plans of what was staged, in that order, and the tables."""
    landed = spark.createDataFrame([(f"https://d.example.com/{m}.json", 200, i, '{"%s": [%s]}' % (m, r)) for i, (m, r) in enumerate(bodies)], pages.PAGE)
    landed.write.json(f"{folder}/landing")
    plans = {}
    stage = Warehouse.stage

    def seen(self, rows, name, by=None):
        plans[name.rsplit("/", 1)[-1]] = optimized(rows)
        return stage(self, rows, name, by)

    monkeypatch.setattr(Warehouse, "stage", seen)
    run_sync(spark, f"{folder}/landing", f"{folder}/tables")
    return plans, Warehouse(spark, f"{folder}/tables")


def test_whole_rows_are_compared_only_where_a_key_repeats(spark, tmp_path, monkeypatch):
    group = '{"id": %d, "name": "%s"}'
    ticket = '{"id": %d, "subject": "%s", "status": "open", "updated_at": "2024-01-0%dT00:00:00Z"}'
    bodies = [("groups", group % (5, "g")), ("groups", group % (6, "h")), ("tickets", ticket % (1, "new", 2)), ("tickets", ticket % (1, "old", 1)), ("tickets", ticket % (2, "one", 1))]
    plans, target = load_of(spark, tmp_path, monkeypatch, bodies)
    assert "Window" not in plans["groups"]
    assert "Window" in plans["ticket"]
    assert rows_of(target.read("groups"), "id", "name")[1:] == [(5, "g"), (6, "h")]
    assert rows_of(target.read("ticket"), "id", "subject") == [(1, "new"), (2, "one")]


def test_a_key_that_repeats_is_seen(spark):
    def rows(*keys):
        return spark.createDataFrame([(k, v) for k, v in keys], "a long, b long")

    assert not repeats(rows(), ["a", "b"])
    assert not repeats(rows((1, 1), (1, 2), (None, 1)), ["a", "b"])
    assert repeats(rows((None, 1), (2, 2), (None, 1)), ["a", "b"])
    assert repeats(rows((1, 1), (1, 2)), ["a"])


def test_records_are_decoded_before_the_first_table_is_stored(spark, tmp_path, monkeypatch):
    bodies = [("groups", '{"id": 5, "name": "g"}'), ("organizations", '{"id": 1, "name": "o"}'), ("tickets", '{"id": 1, "subject": "s", "status": "open"}')]
    plans, target = load_of(spark, tmp_path, monkeypatch, bodies)
    order = list(plans)
    assert max(order.index(f"{t}-decoded") for t in ("groups", "organization", "ticket")) < order.index("groups")
    assert target.read("ticket").count() == 1


def test_a_time_is_read_once(spark):
    record = '{"id": 1, "created_at": "%s", "updated_at": "2024-01-01T00:00:00Z"}'
    texts = [(record % t,) for t in ("2024-01-01T00:00:00.5Z", "1969-01-01T00:00:00Z", "x")] + [('{"id": 2}',), ("{",)]
    decoded = pages.decode_records(spark.createDataFrame(texts, "record string").withColumn("fetched_at", F.lit(1).cast("long")), "groups")
    assert optimized(decoded).count("RLIKE") == 2
    assert [(r["createdat"], r["problem"]) for r in decoded.select("createdat", "problem").collect()] == [
        (1704067200, None), (0, None), (0, "bad_time"), (0, None), (0, "unreadable")]


def test_no_list_of_rules_is_made_for_a_sound_row(spark):
    rows = spark.createDataFrame([(1, "ab"), (-1, "abc"), (None, None)], "n long, t string")
    tagged = quality.tag(rows, quality.not_null(["n", "t"]) + quality.too_long({"t": 2}) + quality.negative(["n"]))
    found = [r["_reasons"] for r in tagged.collect()]
    assert found == [[], ["t:length>2", "n:negative"], ["n:null", "t:null"]]
    assert "ELSE []" in optimized(tagged)


def test_fields_without_a_number_count_as_number_nought(spark):
    rows = spark.createDataFrame(
        [(1, [(None, "a"), (0, "b"), (7, "c")]), (2, [(9, "b"), (None, "x"), (None, "y")]), (3, [(9, "b"), (4, None)]), (4, [(None, "z")])],
        "id long, f array<struct<id: long, value: string>>",
    )
    nought = F.lit(0).cast("bigint")
    kept = rows.select("id", F.inline(greatest_of_each(F.col("f"), "id", nought)).alias("number", "value"))
    want = [(1, 0, "b"), (1, 7, "c"), (2, 0, "y"), (2, 9, "b"), (3, 4, None), (3, 9, "b"), (4, 0, "z")]
    assert rows_of(kept) == sorted(want, key=repr)


def test_landing_starts_with_more_partitions_than_a_query(spark, tmp_path, monkeypatch):
    """Adaptive execution merges them to the size of a landed file, and could not cut larger ones."""
    name = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    held = []
    rows = spark.createDataFrame([("u", 200, 1, "{}")], pages.PAGE)
    write = type(rows.write).json
    monkeypatch.setattr(type(rows.write), "json", lambda self, *a, **k: held.append(spark.conf.get(name)) or write(self, *a, **k))
    spark.conf.set(name, "5")
    catalog._land(rows, f"{tmp_path}/one")
    assert spark.conf.get(name) == "5"
    spark.conf.unset(name)
    catalog._land(rows, f"{tmp_path}/two")
    assert spark.conf.get(name, None) is None
    assert held == ["40", str(8 * int(spark.conf.get("spark.sql.shuffle.partitions")))]
