from __future__ import annotations

import json
import os

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from deskloom.schema import MEMBERS, PAGE, RESOURCES
from deskloom.sources import pages as p

API = "https://desk.example.com/api/v2"


def landed(spark, *bodies, url=f"{API}/tickets.json", status=200):
    texts = [b if isinstance(b, str) else json.dumps(b) for b in bodies]
    return spark.createDataFrame([(url, status, i, t) for i, t in enumerate(texts)], PAGE)


def test_thirteen_members():
    assert len(MEMBERS) == 13
    assert set(MEMBERS.values()) == set(RESOURCES)


@pytest.mark.parametrize(
    ("body", "resource", "count", "linked"),
    [
        ({"tickets": [{"id": 1}], "count": 1, "next_page": "n"}, "tickets", 1, True),
        ({"ticket": {"id": 1}}, "ticket", 0, False),
        ({"ticket_fields": [], "count": 3, "next_page": None}, "ticket_fields", 3, False),
        ({"audits": [{"id": 1}], "count": 1, "next_page": None, "previous_page": None}, "audits", 1, False),
        ({"ticket_metric": {"id": 1}}, "ticket_metric", 0, False),
        ({"count": 5, "groups": [{"id": 1}]}, "groups", 5, False),
        ({"surprise": []}, None, 0, False),
        ("no json", None, 0, False),
    ],
)
def test_envelope(spark, body, resource, count, linked):
    row = p.scan_envelope(landed(spark, body)).first()
    assert (row["resource"], row["count"], row["next_page"] is not None) == (resource, count, linked)


def test_list_and_single_object_decode_alike(spark):
    record = {"id": 7, "subject": "s", "status": "open", "created_at": "2024-01-01T00:00:00Z"}
    both = landed(spark, {"tickets": [record]}, {"ticket": record})
    assert [tuple(r) for r in p.decode(both, "ticket").select("id", "subject", "createdat").collect()] == [
        (7, "s", 1704067200)
    ] * 2


def test_missing_members_take_zero_values(spark):
    row = p.good(p.decode(landed(spark, {"users": [{"id": 3}]}), "user")).first()
    assert (row["email"], row["organizationid"], row["lastloginat"], row["suspended"]) == ("", 0, 0, False)
    metric = p.good(p.decode(landed(spark, {"ticket_metric": {"id": 3, "reply_time_in_minutes": {"calendar": 4}}}), "ticketmetric")).first()
    assert (metric["ttfr"], metric["ttr"], metric["solvedat"]) == (4, 0, 0)


def test_external_id_may_be_text(spark):
    rows = p.good(p.decode(landed(spark, {"tickets": [{"id": 1, "external_id": "A-1"}, {"id": 2, "external_id": 5}]}), "ticket"))
    assert rows_of(rows, "id", "externalid") == [(1, "A-1"), (2, "5")]


def test_bad_record_does_not_take_its_page_along(spark):
    page = landed(
        spark,
        {"tickets": [{"id": 1}, {"id": "x"}, {"id": 3, "updated_at": "soon"}, {"id": 4, "group_id": {}}, {"id": 5}]},
    )
    decoded = p.decode(page, "ticket")
    assert rows_of(p.good(decoded), "id") == [(1,), (5,)]
    assert rows_of(p.rejected_records(decoded, "ticket"), "key", "reason") == [
        ("3", "bad_time"),
        ("4", "unreadable"),
        ("x", "unreadable"),
    ]


def test_irregular_pages(spark):
    pages = landed(
        spark,
        {"tickets": [{"id": 1}], "users": [{"id": 2}]},  # two members: the last one counts
        {"users": [{"id": 3}], "tickets": [{"id": 4}, {"id": 5}]},
        {"tickets": {"id": 6}},  # one object under the name of a list
        {"ticket": [{"id": 7}, {"id": 8}]},
        {"tickets": []},
    )
    split = p.split_pages(pages)
    assert rows_of(split, "table", "record") == [
        ("ticket", '{"id":4}'), ("ticket", '{"id":5}'), ("ticket", '{"id":6}'), ("ticket", '{"id":7}'),
        ("ticket", '{"id":8}'), ("user", '{"id":2}'),
    ]


def test_rejected_pages(spark):
    pages = landed(spark, {"tickets": [{"id": 1}]}, "no json", {"surprise": 1}, {"tickets": 5}, {"tickets": None})
    assert rows_of(p.rejected_pages(p.split_pages(pages)), "resource", "reason", "payload") == [
        ("", "unknown_resource", "no json"),
        ("", "unknown_resource", '{"surprise": 1}'),
        ("tickets", "bad_payload", '{"tickets": 5}'),
    ]


def test_values_of_any_kind_become_text(spark):
    fields = [{"id": i, "value": v} for i, v in enumerate([True, "t", None, ["a", "b"], 12, 1.5])]
    rows = p.decode(landed(spark, {"tickets": [{"id": 1, "custom_fields": fields}]}), "ticket")
    values = rows.select(F.inline("custom_fields")).orderBy("id").collect()
    assert [r["value"] for r in values] == ["true", "t", None, '["a","b"]', "12", "1.5"]


@pytest.mark.parametrize(
    ("path", "option", "resource"),
    [
        ("/tickets.json", "", "/tickets.json"),
        ("/tickets/1234.json", "/tickets", "/1234.json"),
        ("/incremental/tickets.json?start_time=0", "/incremental", "/tickets.json"),
        ("/ticket_fields.json", "", "/ticket_fields.json"),
        ("/tickets/1234/audits.json", "/tickets/1234", "/audits.json"),
        ("/tickets/1234/metrics.json", "/tickets/1234", "/metrics.json"),
        ("/groups.json", "", "/groups.json"),
    ],
)
def test_urls(spark, path, option, resource):
    row = p.classify_urls(spark.createDataFrame([(API + path,)], "url string")).first()
    assert (row["option"], row["resource"], row["incremental"]) == (option, resource, option == "/incremental")


def test_fetch_routes(spark):
    statuses = [200, 201, 300, 301, 199, 404, 429, 500]
    df = spark.createDataFrame([(s,) for s in statuses], "status_code int")
    assert dict(rows_of(p.fetch_routes(df))) == {"load": 3, "skip": 1, "retry": 1, "error": 3}


def test_chain_gaps(spark):
    inc = f"{API}/incremental/tickets.json?start_time="
    snap = f"{API}/groups.json?page="
    def body(member, count, following):
        return json.dumps({member: [], "count": count, "next_page": following})

    rows = [
        (f"{inc}0", body("tickets", 1000, f"{inc}1")),
        (f"{inc}1", body("tickets", 999, f"{inc}2")),  # not full: the end
        (f"{inc}5", body("tickets", 1000, f"{inc}6")),  # full, successor missing
        (f"{snap}1", body("groups", 3, f"{snap}2")),
        (f"{snap}2", body("groups", 3, f"{snap}3")),  # names a page that never landed
        (f"{snap}9", body("groups", 3, None)),
    ]
    pages = spark.createDataFrame([(u, 200, 0, b) for u, b in rows], PAGE)
    assert rows_of(p.chain_gaps(pages), "url") == [(f"{snap}2",), (f"{inc}5",)]
    # A successor that came back as an error is missing, and an error announces nothing.
    failed = spark.createDataFrame([(f"{inc}6", 500, 0, ""), (f"{snap}3", 503, 0, body("groups", 3, f"{snap}4"))], PAGE)
    assert rows_of(p.chain_gaps(pages.unionByName(failed)), "url") == [(f"{snap}2",), (f"{inc}5",)]


def chained(spark, links, status=200, fetched=0):
    rows = [(f"{API}/groups.json?page={a}", status, fetched, json.dumps({"groups": [], "next_page": b and f"{API}/groups.json?page={b}"})) for a, b in links]
    return spark.createDataFrame(rows, PAGE)


def reach(spark, pages, *entries):
    from_ = spark.createDataFrame([(f"{API}/groups.json?page={e}",) for e in entries], "url string")
    return {int(r.url.rsplit("=", 1)[1]): (r.reached, r.cyclic) for r in p.chain_reach(pages, from_).collect()}


def test_chain_reach_tells_pages_behind_a_gap_and_circles(spark):
    pages = chained(spark, [(1, 2), (2, 3), (3, 4), (5, 6), (6, None), (10, 11), (11, 12), (12, 10), (20, 21), (21, 22), (22, 21), (30, 30)])
    stray = {5: (False, False), 6: (False, False)}  # behind page 4, which never landed
    circle = {10: (False, True), 11: (False, True), 12: (False, True), 30: (False, True)}
    assert reach(spark, pages, 1, 20) == stray | circle | {21: (True, True), 22: (True, True)}
    assert reach(spark, pages, 1, 5, 11, 20, 30) == {n: (True, True) for n in (10, 11, 12, 21, 22, 30)}
    # A failed page is not landed, and of two fetches the later one's link counts.
    later = chained(spark, [(4, 5)]).unionByName(chained(spark, [(12, None)], fetched=7)).unionByName(chained(spark, [(6, 1)], status=500, fetched=9))
    assert reach(spark, pages.unionByName(later), 1, 20) == {10: (False, False), 11: (False, False), 12: (False, False), 21: (True, True), 22: (True, True), 30: (False, True)}
    assert reach(spark, pages.limit(0), 1) == {}


def test_a_long_chain_takes_few_rounds(spark, monkeypatch):
    rounds = []
    folder = p.run_folder
    monkeypatch.setattr(p, "run_folder", lambda s: rounds.append(folder(s)) or rounds[-1])
    pages = chained(spark, [(n, n + 1) for n in range(700)])
    assert reach(spark, pages, 600) == {n: (False, False) for n in range(600)}
    assert len(os.listdir(rounds[0].removeprefix("file:"))) <= 2 + 2 * 10


def test_addresses_to_fetch_again(spark):
    fetches = [("a", 429, 1), ("a", 429, 2), ("b", 429, 1), ("b", 200, 2), ("c", 200, 1), ("c", 429, 2), ("d", 500, 1)]
    pages = spark.createDataFrame([(u, s, t, "") for u, s, t in fetches], PAGE)
    assert rows_of(p.retry_urls(pages)) == [("a", 2), ("c", 2)]


def test_since_includes_the_boundary(spark):
    df = spark.createDataFrame([(1, 9), (2, 10), (3, 11)], "id long, updatedat long")
    assert rows_of(p.since(df, 10), "id") == [(2,), (3,)]
    assert p.since(df, -1).count() == 3


def test_listing_urls_start_at_the_offset(spark):
    offsets = spark.createDataFrame([("ticket", 77), ("user", -1)], "sequencename string, lastval long")
    urls = dict(rows_of(p.listing_urls(offsets, "https://desk.example.com/")))
    assert urls["ticket"] == f"{API}/incremental/tickets.json?start_time=77"
    assert urls["user"] == f"{API}/incremental/users.json?start_time=0"
    assert urls["satisfactionrating"] == f"{API}/satisfaction_ratings.json?start_time=0"
    assert urls["groups"] == f"{API}/groups.json"


def test_child_pages_are_told_by_their_address(spark):
    urls = [f"{API}/tickets/1/audits.json", f"{API}/tickets/2/audits.json?page=3", f"{API}/tickets/9/metrics.json", f"{API}/audits.json"]
    pages = spark.createDataFrame([(u, 200, 0, "{}") for u in urls], PAGE)
    kept = p.pages_of(pages, spark.createDataFrame([(2,), (9,)], "id long"))
    assert rows_of(kept, "url") == sorted([(u,) for u in urls[1:]], key=repr)
