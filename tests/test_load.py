"""Warehouse, batch load and streaming load over hand-written pages."""

from __future__ import annotations

import json
import os
from dataclasses import replace

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from deskloom.operators.hooks import Hooks
from deskloom.plans.sync import LOAD_ORDER, run_sync, stored_rows
from deskloom.plans.views import drop_views, register_views, ticket_view
from deskloom.schema import TABLES
from deskloom.settings import TICKET_ATTRIBUTES, TITLE_TIME_TOTAL, recipient_types
from deskloom.sinks.warehouse import Warehouse, slice_of
from deskloom.sources.pages import listing_urls, read_resource
from deskloom.streaming import waiting
from deskloom.streaming.follow import follow, follow_children, follow_table

API = "https://desk.example.com/api/v2"


def at(day: int) -> str:
    return f"2024-01-{day:02d}T00:00:00Z"


def page(member, payload, status=200, fetched=1, **links):
    body = payload if member is None else {member: payload, **links}
    text = body if isinstance(body, str) else json.dumps(body)
    return {"url": f"{API}/{member}.json", "status_code": status, "fetched_at": fetched, "body": text}


def land(folder, name, *pages):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / f"{name}.json").write_text("".join(json.dumps(p) + "\n" for p in pages))


def ticket(number, day=1, org=100, assignee=500, **more):
    record = {
        "id": number, "subject": f"s{number}", "status": "open", "recipient": "escalations@example.com",
        "requester_id": 500, "submitter_id": 500, "assignee_id": assignee, "organization_id": org, "group_id": 1,
        "created_at": at(1), "updated_at": at(day),
        "custom_fields": [{"id": i, "value": f"v{i}-{number}"} for i in range(11, 16)],
    }
    return record | more


FIELDS = [*TICKET_ATTRIBUTES.values(), TITLE_TIME_TOTAL]


def base_pages():
    return [
        page("ticket_fields", [{"id": 11 + i, "type": "text", "title": t} for i, t in enumerate(FIELDS)], count=6),
        page("organization_fields", [{"id": 21, "key": "subscription_type", "type": "text", "title": "x"}], count=1),
        page("user_fields", [], count=0),
        page("groups", [{"id": 1, "name": "g"}], count=1),
        page("organizations", [
            {"id": 100, "name": "Acme", "group_id": 1, "updated_at": at(1), "organization_fields": {"subscription_type": "gold", "odd": None}},
            {"id": 101, "name": "Lost", "group_id": 9, "updated_at": at(1), "organization_fields": {"subscription_type": "tin"}},
        ], count=2),
        page("users", [{"id": 500, "name": "U", "default_group_id": 1, "organization_id": 100, "updated_at": at(1), "external_id": "E"}], count=1),
        page("tickets", [ticket(1), ticket(2, assignee=999), ticket(3, org=101), ticket(4, status="x" * 11)], count=4),
        page("audits", [
            {"id": 1000, "ticket_id": 1, "author_id": 500, "events": [
                {"id": 9000, "type": "Change", "field_name": "16", "value": "60"},
                {"id": 9001, "type": "Change", "field_name": "11", "value": "P1", "previous_value": "P2"}]},
            {"id": 1001, "ticket_id": 1, "author_id": 500, "events": [{"id": 9002, "type": "Create", "field_name": "16", "value": "99"}]},
            {"id": 1002, "ticket_id": 2, "author_id": 500, "events": [{"id": 9003, "type": "Change", "field_name": "16", "value": "5"}]},
        ]),
        page("ticket_metric", {"id": 70, "ticket_id": 1, "reply_time_in_minutes": {"calendar": 5, "business": 1}}),
        page("satisfaction_ratings", [{"id": 80, "ticket_id": 1, "assignee_id": 500, "requester_id": 500, "group_id": 1, "score": "good"}]),
        page("tickets", [ticket(5)], status=404),
        page(None, "oops"),
        page("groups", [{"id": 2, "name": "never"}], status=500),
    ]


# --- warehouse ---


def groups(spark, *rows):
    return spark.createDataFrame([(i, n, 0, u) for i, n, u in rows], TABLES["groups"].struct)


def test_only_touched_slices_are_rewritten(spark, tmp_path):
    target = Warehouse(spark, str(tmp_path))
    far = 5_000_000
    target.upsert("groups", groups(spark, (1, "a", 1), (far, "b", 1)))
    before = target._slices("groups")
    old = target.read("groups")
    target.upsert("groups", groups(spark, (far, "B", 2), (far + 1, "new", 1)))
    after = target._slices("groups")
    assert before[0] == after[0] and before[5] != after[5]
    assert rows_of(target.read("groups"), "id", "name") == [(0, "UNDEFINED"), (1, "a"), (far, "B"), (far + 1, "new")]
    # A frame over the older version still reads it, until it is vacuumed.
    assert rows_of(old, "id", "name") == [(0, "UNDEFINED"), (1, "a"), (far, "b")]
    assert target.vacuum("groups") == []
    target.upsert("groups", groups(spark, (1, "z", 5), (far, "z", 5)))
    assert target.vacuum("groups") == [1, 2]
    assert target.read("groups").count() == 4


def test_ids_far_apart_make_a_bounded_number_of_folders(spark, tmp_path, monkeypatch):
    monkeypatch.setitem(TABLES, "groups", replace(TABLES["groups"], slices=64))
    target, step = Warehouse(spark, str(tmp_path)), 7_900_000_019
    rows = spark.range(1, 100_001).selectExpr(f"id * {step} AS id", "'a' AS name", "0L AS createdat", "1L AS updatedat")
    target.upsert("groups", rows)
    assert len(target._slices("groups")) <= 64
    assert target.read("groups").count() == 100_001
    again = spark.createDataFrame([(step, "b", 0, 2), (3 * step, "c", 0, 2)], TABLES["groups"].struct)
    touched = target.touched("groups", again)["groups"]
    before = target._slices("groups")
    target.upsert("groups", again)
    after = target._slices("groups")
    assert {k for k in after if after[k] != before[k]} == set(touched) and len(touched) <= 2
    found = target.read("groups").filter("name <> 'a' AND id > 0")
    assert rows_of(found, "id", "name") == sorted([(step, "b"), (3 * step, "c")], key=repr)
    # Neighbours lie together, and slices of whole numbers beyond 2^53 are those of their range.
    ids = spark.createDataFrame([(1,), (999_999,), (2**60 + 1,), (2**60 // 10**6 * 10**6,)], "id long")
    assert [r[0] for r in ids.select(slice_of(TABLES["groups"])).collect()] == [0, 0, *[2**60 // 10**6 % 64] * 2]


def test_a_batch_is_computed_once(spark, tmp_path):
    target = Warehouse(spark, str(tmp_path))
    drawn = spark.range(1, 2001).selectExpr("id", "cast(rand() AS string) AS name", "0L AS createdat", "cast(floor(rand() * 9) AS long) AS updatedat")
    both = drawn.unionByName(drawn.withColumn("name", F.lit("x")))
    target.upsert("groups", both)
    assert target.read("groups").count() == 2001
    assert target.read("groups").select("id").distinct().count() == 2001


def test_a_version_without_its_mark_is_not_read(spark, tmp_path):
    target = Warehouse(spark, str(tmp_path))
    target.upsert("groups", groups(spark, (1, "a", 1)))
    target.upsert("groups", groups(spark, (1, "b", 2)))
    (tmp_path / "groups" / "version=2" / "_SUCCESS").unlink()
    assert rows_of(target.read("groups"), "id", "name") == [(0, "UNDEFINED"), (1, "a")]
    target.upsert("groups", groups(spark, (1, "c", 3)))
    assert target.versions("groups") == [1, 2]
    assert rows_of(target.read("groups"), "id", "name") == [(0, "UNDEFINED"), (1, "c")]


def test_columns_a_record_never_carries_are_kept(spark, tmp_path):
    target = Warehouse(spark, str(tmp_path))
    table = TABLES["organization"]
    target.write("organization", spark.createDataFrame([(7, "X-7", "old", 1, 1, 0)], table.struct))
    batch = spark.createDataFrame([(7, "new", 1, 2, 0), (8, "fresh", 1, 2, 0)], "id long, name string, createdat long, updatedat long, groupid long")
    target.upsert("organization", batch)
    assert rows_of(target.read("organization"), "id", "externalid", "name") == [(7, "X-7", "new"), (8, "UNDEFINED", "fresh")]


# --- batch load ---


@pytest.fixture(scope="module")
def loaded(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("load")
    land(root / "landing", "a", *base_pages())
    report = run_sync(spark, str(root / "landing"), str(root / "tables"))
    return root, report, Warehouse(spark, str(root / "tables"))


def test_report(loaded):
    _, report, _ = loaded
    counts = {r["table"]: (r["read"], r["accepted"], r["quarantined"]) for r in report.collect()}
    assert counts == {
        "ticketfields": (6, 6, 0), "organizationfields": (1, 1, 0), "groups": (1, 1, 0), "organization": (2, 1, 1),
        "organizationdata": (2, 2, 0), "user": (1, 1, 0), "ticket": (4, 1, 3), "ticketdata": (5, 5, 0),
        "satisfactionrating": (1, 1, 0), "audit": (2, 1, 1), "changeevent": (2, 2, 0), "ticketmetric": (1, 1, 0),
    }


LETTERS = 7


def test_dead_letters(loaded):
    letters = rows_of(loaded[2].quarantined(), "resource", "key", "reason")
    assert letters == [
        ("", f"{API}/None.json", "unknown_resource"),
        ("", f"{API}/groups.json", "status_500"),
        ("audit", "1002/2", "ticketid:no_parent"),
        ("organization", "101", "groupid:no_parent"),
        ("ticket", "2", "assigneeid:no_parent"),
        ("ticket", "3", "organizationid:no_parent"),
        ("ticket", "4", "status:length>10"),
    ]


def test_tables_hold_children_of_accepted_parents_only(loaded):
    target = loaded[2]
    assert rows_of(target.read("ticketdata"), "objectid").count((1,)) == 5
    assert rows_of(target.read("organizationdata"), "objectid", "id", "title", "value") == [
        (100, 0, "odd", None), (100, 21, "subscription_type", "gold")]
    assert rows_of(target.read("changeevent"), "id", "auditid") == [(9000, 1000), (9001, 1000)]
    assert rows_of(target.read("user"), "id", "externalid") == [(0, "UNDEFINED"), (500, "E")]
    assert rows_of(target.read("sequencetable")) == [
        ("organization", 1704067200), ("satisfactionrating", 0), ("ticket", 1704067200), ("user", 1704067200)]


def test_read_resource(spark, loaded):
    landing = str(loaded[0] / "landing")
    assert rows_of(read_resource(spark, landing, "ticket"), "id") == [(1,), (2,), (3,), (4,)]
    assert read_resource(spark, landing, "ticket", offset=1704067201).count() == 0
    changed = spark.createDataFrame([(1,)], "id long")
    assert rows_of(read_resource(spark, landing, "audit", changed=changed), "id") == [(1000,), (1001,)]


def test_staging_is_dropped(loaded):
    assert not list((loaded[0] / "tables" / "staging").glob("*"))


def test_views_over_a_load(spark, loaded):
    target = loaded[2]
    tables = {t: target.read(t) for t in LOAD_ORDER}
    row = ticket_view(tables).collect()
    assert len(row) == 1
    got = row[0].asDict()
    assert (got["organization"], got["type"], got["priority"], got["initialpriority"], got["tickettime"], got["ttfr"]) == (
        "Acme", "escalation", "v11-1", "P2", 60, 5)
    register_views(spark, tables)
    spark.sql("CREATE OR REPLACE TEMP VIEW Mine AS SELECT t.id, x.priority FROM ticket t JOIN TicketPriority x ON x.ticketid = t.id")
    assert rows_of(spark.table("Mine")) == [(1, "v11-1")]
    assert spark.sql("SELECT * FROM TicketView").count() == 1
    for name in [*LOAD_ORDER, "Mine", "TicketView"]:
        spark.catalog.dropTempView(name)


def test_running_again_changes_nothing(spark, loaded):
    root, _, target = loaded
    before = {t: rows_of(target.read(t)) for t in LOAD_ORDER}
    run_sync(spark, str(root / "landing"), str(root / "tables"), afresh=True)
    assert {t: rows_of(target.read(t)) for t in LOAD_ORDER} == before
    # Letters of every load stay; a load under the same label replaces its own.
    assert target.quarantined().count() == 2 * LETTERS
    for _ in range(2):
        run_sync(spark, str(root / "landing"), str(root / "tables"), label="same")
    assert target.quarantined().count() == 3 * LETTERS


def test_hooks_take_part_in_a_load(spark, tmp_path):
    land(tmp_path / "landing", "a", *base_pages())
    hooks = Hooks()
    hooks.register("ticket", lambda d: d.withColumn("subject", F.upper("subject")))
    hooks.register("user", lambda d: d.filter("id <> 500"))
    run_sync(spark, str(tmp_path / "landing"), str(tmp_path / "tables"), hooks=hooks)
    target = Warehouse(spark, str(tmp_path / "tables"))
    assert rows_of(target.read("user"), "id") == [(0,)]
    assert target.read("ticket").count() == 0


# --- streaming ---


def test_late_records_neither_win_nor_get_lost(spark, tmp_path):
    landing, tables, check = tmp_path / "landing", str(tmp_path / "tables"), str(tmp_path / "check")

    def drain():
        follow(spark, str(landing), tables, check, drain=True).awaitTermination()

    land(landing, "a", *base_pages())
    drain()
    land(landing, "b", page("tickets", [ticket(1, day=9, status="solved", custom_fields=[{"id": 11, "value": "P9"}])]))
    drain()
    # Arrives last, but is older than what is stored, and a late record of a ticket not seen before.
    land(landing, "c", page("tickets", [ticket(1, day=5, status="hold", custom_fields=[{"id": 11, "value": "P5"}]), ticket(6, day=2)], fetched=9))
    drain()
    target = Warehouse(spark, tables)
    assert rows_of(target.read("ticket"), "id", "status") == [(1, "solved"), (6, "open")]
    values = rows_of(target.read("ticketdata").filter("objectid = 1"), "id", "value")
    assert values == [(11, "P9"), (12, "v12-1"), (13, "v13-1"), (14, "v14-1"), (15, "v15-1")]
    assert rows_of(target.read("sequencetable").filter("sequencename = 'ticket'"), "lastval") == [(1704758400,)]


def test_stream_and_batch_agree(spark, tmp_path, loaded):
    landing = tmp_path / "landing"
    pages = base_pages()
    for i, one in enumerate(pages):
        land(landing, f"p{i:02d}", one)
    follow(spark, str(landing), str(tmp_path / "tables"), str(tmp_path / "check"), drain=True).awaitTermination()
    stream, batch = Warehouse(spark, str(tmp_path / "tables")), loaded[2]
    for table in LOAD_ORDER:
        assert rows_of(stream.read(table)) == rows_of(batch.read(table)), table
    assert rows_of(stored_rows(stream)) == rows_of(stored_rows(batch))


def test_replayed_batches_change_nothing(spark, tmp_path):
    landing, tables = tmp_path / "landing", str(tmp_path / "tables")
    land(tmp_path / "before", "a", *base_pages()[3:6])
    run_sync(spark, str(tmp_path / "before"), tables)
    land(landing, "a", page("tickets", [ticket(1), ticket(2), ticket(3, assignee=999)]), page("tickets", "oops", status=503), page(None, "bad"))
    land(landing, "b", page("tickets", [ticket(1, day=3, status="solved")], fetched=2))
    for attempt in ("first", "again"):  # a lost checkpoint replays every file
        follow_table(
            spark, str(landing), "ticket", tables, str(tmp_path / attempt), files_per_batch=1, drain=True
        ).awaitTermination()
        target = Warehouse(spark, tables)
        assert rows_of(target.read("ticket"), "id", "status") == [(1, "solved"), (2, "open")]
    # The stream's own label: each of the two streams left its letters.
    letters = rows_of(target.quarantined().filter("resource <> 'organization'"), "resource", "reason")
    assert letters == 2 * [("", "status_503")] + 2 * [("", "unknown_resource")] + 2 * [("ticket", "assigneeid:no_parent")]


def test_a_renamed_field_replaces_its_value(spark, tmp_path):
    tables = str(tmp_path / "tables")
    land(tmp_path / "a", "a", *base_pages())
    run_sync(spark, str(tmp_path / "a"), tables)
    fields = [{"id": 11, "type": "text", "title": "Renamed", "updated_at": at(5)}]
    organization = {"id": 100, "name": "Acme", "group_id": 1, "updated_at": at(5), "organization_fields": {"other": "x"}}
    land(tmp_path / "b", "b", page("ticket_fields", fields), page("tickets", [ticket(1, day=5)], fetched=2), page("organizations", [organization], fetched=2))
    run_sync(spark, str(tmp_path / "b"), tables)
    target = Warehouse(spark, tables)
    assert rows_of(target.read("ticketdata").filter("id = 11"), "objectid", "title") == [(1, "Renamed")]
    assert rows_of(target.read("organizationdata").filter("id = 0"), "title") == [("odd",), ("other",)]


def listed(tables):
    """Names of the files a warehouse's progress names, once for each time."""
    logs = [f for f in (tables / "progress").glob("*/sources/0/*") if not f.name.startswith(".")]
    return sorted(json.loads(line)["path"].rsplit("/", 1)[1] for f in logs for line in f.read_text().splitlines()[1:])


def test_a_second_sync_reads_new_files_only(spark, tmp_path):
    landing, tables = tmp_path / "landing", tmp_path / "tables"
    land(landing, "a", *base_pages())
    first = run_sync(spark, str(landing), str(tables))
    assert dict(rows_of(first, "table", "read"))["ticket"] == 4
    land(landing, "b", page("groups", [{"id": 7, "name": "later"}], fetched=2), page("tickets", [ticket(9)], fetched=2))
    second = run_sync(spark, str(landing), str(tables))
    assert rows_of(second, "table", "read") == [("groups", 1), ("ticket", 1), ("ticketdata", 5)]
    assert run_sync(spark, str(landing), str(tables)).count() == 0
    assert listed(tables) == ["a.json", "b.json"]
    target = Warehouse(spark, str(tables))
    assert target.quarantined().count() == LETTERS
    # A stream without a checkpoint of its own goes on from there, and a load from where it ends.
    land(landing, "c", page("groups", [{"id": 8, "name": "last"}], fetched=3))
    follow(spark, str(landing), str(tables), drain=True).awaitTermination()
    assert run_sync(spark, str(landing), str(tables)).count() == 0
    assert listed(tables) == ["a.json", "b.json", "c.json"]
    assert rows_of(target.read("groups"), "id") == [(0,), (1,), (7,), (8,)]
    # The next fetch starts where the stored offsets say.
    urls = dict(rows_of(listing_urls(target.read("sequencetable"), "https://desk.example.com")))
    assert urls["ticket"] == f"{API}/incremental/tickets.json?start_time=1704067200"


def test_a_backfill_is_loaded_in_bounded_batches(spark, tmp_path):
    landing = tmp_path / "landing"
    pages = base_pages()
    for i, part in enumerate((pages[:6], pages[6:7], pages[7:])):
        land(landing, f"p{i}", *part)
        os.utime(landing / f"p{i}.json", (1_700_000_000 + i, 1_700_000_000 + i))
    most = max((landing / f"p{i}.json").stat().st_size for i in range(3))
    one, many = Warehouse(spark, str(tmp_path / "one")), Warehouse(spark, str(tmp_path / "many"))
    run_sync(spark, str(landing), one.root)
    report = run_sync(spark, str(landing), many.root, bytes_per_batch=most)
    assert len(os.listdir(tmp_path / "one" / "reports")) == 1 and len(os.listdir(tmp_path / "many" / "reports")) == 3
    for table in LOAD_ORDER:
        assert rows_of(one.read(table)) == rows_of(many.read(table)), table
    assert rows_of(report) == rows_of(one.report())
    assert rows_of(one.quarantined()) == rows_of(many.quarantined())


# --- children that land before, with or after their tickets ---


def audit(number, ticket_id, event):
    return {"id": number, "ticket_id": ticket_id, "author_id": 500, "events": [{"id": event, "type": "Change", "field_name": "11", "value": "P"}]}


def test_children_are_taken_in_whichever_order_they_land(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(waiting, "GATHER", 2)
    tables, landing, children = str(tmp_path / "tables"), tmp_path / "landing", tmp_path / "children"
    land(tmp_path / "before", "a", *base_pages()[:7], page("tickets", [ticket(n) for n in range(2, 9)], fetched=2))
    run_sync(spark, str(tmp_path / "before"), tables)
    target = Warehouse(spark, tables)

    def drain():
        follow_children(spark, str(landing), str(children), tables, drain=True).awaitTermination()
        return [i for i, in rows_of(target.read("audit"), "id")]

    land(landing, "0", page("groups", []))
    land(children, "early", page("audits", [audit(20, 2, 920), audit(30, 3, 930)]), page("audits", [audit(21, 2, 921)]))
    assert drain() == []  # no ticket has changed yet
    land(landing, "1", page("tickets", [ticket(1), ticket(2)], fetched=5))
    assert drain() == [20, 21]  # what waited for ticket 2
    land(children, "late", page("audits", [audit(10, 1, 910), audit(40, 4, 940)]))
    assert drain() == [10, 20, 21]  # after its ticket's batch
    land(landing, "2", page("tickets", [ticket(3), ticket(4)], fetched=6))
    land(children, "same", page("audits", [audit(41, 4, 941), audit(50, 5, 950)]), page("audits", "oops", status=500))
    assert drain() == [10, 20, 21, 30, 40, 41]
    land(children, "later", page("audits", [audit(22, 2, 922)]), page("ticket_metric", {"id": 71, "ticket_id": 1}))
    assert drain() == [10, 20, 21, 22, 30, 40, 41]  # a ticket once changed stays known
    assert rows_of(target.read("ticketmetric"), "id") == [(71,)]
    assert ("", "status_500") in rows_of(target.quarantined(), "resource", "reason")
    # Only the last batch's waiting records are kept; a lost checkpoint replays all files and changes nothing.
    left = list((tmp_path / "tables" / "waiting").glob("*/records/batch=*"))
    assert len(left) <= 2
    follow_children(spark, str(landing), str(children), tables, str(tmp_path / "again"), drain=True).awaitTermination()
    assert [i for i, in rows_of(target.read("audit"), "id")] == [10, 20, 21, 22, 30, 40, 41]
    land(landing, "3", page("tickets", [ticket(5)], fetched=7))
    assert drain() == [10, 20, 21, 22, 30, 40, 41, 50]


def test_files_landed_before_are_left_alone(spark, tmp_path):
    land(tmp_path / "in", "a", *base_pages())
    land(tmp_path / "in", "b", page("groups", [{"id": 7, "name": "later"}], fetched=2))
    os.utime(tmp_path / "in" / "a.json", (0, 0))
    report = run_sync(spark, str(tmp_path / "in"), str(tmp_path / "tables"), since="2020-01-01T00:00:00")
    assert rows_of(report, "table", "read") == [("groups", 1)]


def test_sql_views_know_the_sites_own_addresses(spark, loaded):
    tables = {t: loaded[2].read(t) for t in LOAD_ORDER}
    register_views(spark, tables, {"escalations@example.com": "mine"})
    assert rows_of(spark.sql("SELECT type FROM TicketView")) == [("mine",)]
    by_domain = "SELECT type FROM TicketViewOf('%s', 'desk.example.com')"
    assert rows_of(spark.sql(by_domain % "example.com")) == [("escalation",)]
    assert rows_of(spark.sql(by_domain % "elsewhere.org")) == [("enterprise",)]
    whole = ticket_view(tables, recipient_types("example.com", "desk.example.com"))
    function = spark.table("TicketView").schema, spark.sql("SELECT * FROM TicketViewOf('example.com', 'desk.example.com')")
    assert (function[1].schema, rows_of(function[1])) == (function[0], rows_of(whole))
    drop_views(spark, {})
    for name in LOAD_ORDER:
        spark.catalog.dropTempView(name)
