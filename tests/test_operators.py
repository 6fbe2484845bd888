"""Flattening, attributes, rules, upsert, hooks: small inputs with the awkward cases."""

from __future__ import annotations

import random

from conftest import rows_of
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from deskloom.operators import eav, flatten, quality, upsert
from deskloom.operators.hooks import Hooks
from deskloom.rows import with_seed
from deskloom.schema import TABLES

ATTRS = "objectid long, id long, title string, value string, transformed string"
FIELDS = "id long, type string, skey string, title string, createdat long, updatedat long"


def fields(spark, *pairs):
    return spark.createDataFrame([(i, "text", f"k{i}", t, 0, 0) for i, t in pairs], FIELDS)


# --- flatten ---


def test_flatten_list_gives_untitled_rows_for_unknown_fields(spark):
    df = spark.createDataFrame(
        [(1, [(10, "a"), (99, "b"), (10, None)])], "id long, custom_fields array<struct<id:long,value:string>>"
    )
    rows = flatten.flatten_list(df, flatten.index_titles(fields(spark, (10, "Ten"))))
    assert rows_of(rows, "objectid", "id", "title", "value") == [(1, 10, "Ten", "a"), (1, 10, "Ten", None), (1, 99, "", "b")]


def test_flatten_map_keeps_unknown_keys_apart(spark):
    df = spark.createDataFrame(
        [(1, [("k10", "a"), ("x", "b"), ("y", "c")])], "id long, user_fields array<struct<key:string,value:string>>"
    )
    rows = flatten.flatten_map(df, flatten.index_keys(fields(spark, (10, "Ten"))), "user_fields")
    assert rows_of(rows, "id", "title", "value") == [(0, "x", "b"), (0, "y", "c"), (10, "k10", "a")]
    assert quality.duplicate_keys(upsert.keyed(rows, TABLES["userdata"]), list(TABLES["userdata"].key)).count() == 0


def test_change_events(spark):
    event = "struct<id:long,type:string,field_name:string,value:string,previous_value:string>"
    audits = spark.createDataFrame(
        [
            (1, [(11, "Change", "5", "x", "w"), (12, "Create", "5", "x", None), (13, "Change", "status", "a", "b")]),
            (2, [(21, "Change", "6", "1", None)]),
            (3, [(31, "Change", "7", "1", None), (32, "Change", "5", None, "")]),
            (4, []),
        ],
        f"id long, events array<{event}>",
    )
    defs = fields(spark, (5, "Case Priority"), (6, "Unwanted"), (7, "Total time spent (sec)"))
    events = flatten.change_events(audits, defs)
    assert rows_of(events, "id", "auditid", "pvalue") == [(11, 1, "w"), (31, 3, None), (32, 3, "")]
    assert rows_of(flatten.audits_with(audits, events), "id") == [(1,), (3,)]


# --- attributes ---

TITLES = {"a": "A", "b": "B", "c": "C"}


def test_null_attribute_counts_as_present(spark):
    rows = spark.createDataFrame(
        [(1, 1, "A", None, ""), (1, 2, "B", "x", ""), (1, 3, "C", "y", ""), (2, 1, "A", "p", ""), (2, 2, "B", "q", "")], ATTRS
    )
    for form in (eav.pivot, eav.pivot_one_pass, eav.pivot_unique):
        assert rows_of(form(rows, TITLES, "entity")) == [(1, None, "x", "y")]


def test_two_fields_with_one_title_multiply(spark):
    rows = spark.createDataFrame(
        [(1, 1, "A", "p", ""), (1, 9, "A", "q", ""), (1, 2, "B", "x", ""), (1, 3, "C", "y", ""), (1, 8, "C", "z", "")], ATTRS
    )
    want = sorted([(1, a, "x", c) for a in "pq" for c in "yz"], key=repr)
    assert rows_of(eav.pivot(rows, TITLES, "entity")) == want
    assert rows_of(eav.pivot_one_pass(rows, TITLES, "entity")) == want


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.tuples(st.integers(1, 4), st.integers(1, 5), st.sampled_from(["A", "B", "C", "D"]), st.sampled_from([None, "x", "y"])),
        max_size=30,
        unique_by=lambda r: (r[0], r[1]),
    )
)
def test_pivot_forms_agree(spark, drawn):
    rows = spark.createDataFrame([(o, i, t, v, "") for o, i, t, v in drawn], ATTRS)
    want = []
    for entity in {o for o, *_ in drawn}:
        held = {name: [v for o, _, t, v in drawn if o == entity and t == title] for name, title in TITLES.items()}
        want += [(entity, a, b, c) for a in held["a"] for b in held["b"] for c in held["c"]]
    assert rows_of(eav.pivot(rows, TITLES, "entity")) == sorted(want, key=repr)
    assert rows_of(eav.pivot_one_pass(rows, TITLES, "entity")) == sorted(want, key=repr)


# --- rules ---


def test_row_rules(spark):
    table = TABLES["groups"]
    df = spark.createDataFrame([(1, "ok", 0, 0), (None, "x" * 51, 0, 0), (-3, None, -1, -1)], table.struct)
    tagged = quality.check(df, "groups", {})
    assert rows_of(tagged.select("id", F.array_join(quality.REASONS, ","))) == [
        (-3, "id:negative"),
        (1, ""),
        (None, "id:null,name:length>50"),
    ]
    assert rows_of(quality.accepted(tagged), "id") == [(1,)]
    assert rows_of(quality.quarantined(tagged, "groups"), "reason") == [("id:negative",), ("id:null,name:length>50",)]


def test_references(spark):
    organization = TABLES["organization"]
    rows = spark.createDataFrame([(1, "", "a", 0, 0, 5), (2, "", "b", 0, 0, 6), (3, "", "c", 0, 0, None)], organization.struct)
    groups = spark.createDataFrame([(5, "g", 0, 0)], TABLES["groups"].struct)
    tagged = quality.check(rows, "organization", {"groups": groups})
    assert rows_of(tagged.select("id", F.array_join(quality.REASONS, ","))) == [
        (1, ""),
        (2, "groupid:no_parent"),
        (3, "groupid:null"),
    ]


def test_both_forms_of_the_reference_check_agree(spark):
    table = TABLES["satisfactionrating"]
    rows = spark.createDataFrame(
        [(i, i % 4, i % 3, i % 5, i % 7, "", 0, 0, "") for i in range(40)] + [(99, None, 0, 0, 0, "", 0, 0, "")], table.struct
    )
    ids = {name: spark.range(0, n).select("id") for name, n in (("ticket", 5), ("user", 3), ("groups", 2))}
    one = quality.check(rows, table.name, ids)
    missing = quality.missing_parents(rows, table.parents, ids)
    two = quality.tag_missing(quality.tag(rows, quality.table_rules(table, rows.columns)), table.parents, missing)
    assert rows_of(one, "id", quality.REASONS) == rows_of(two, "id", quality.REASONS)
    assert one.filter(F.size(quality.REASONS) > 1).count() > 0


def test_an_id_stays_with_its_first_owner(spark):
    audit = "id long, ticketid long, createdat long, authorid long, fetched_at long"
    stored = spark.createDataFrame([(1, 10, 0, 0)], TABLES["audit"].struct)
    rows = spark.createDataFrame([(1, 10, 0, 0, 5), (1, 11, 0, 0, 4), (2, 20, 0, 0, 9), (2, 21, 0, 0, 8)], audit)
    tagged = quality.tag_moved(rows, stored, "ticketid", "fetched_at")
    assert rows_of(tagged.select("id", "ticketid", F.array_join(quality.REASONS, ","))) == [
        (1, 10, ""),
        (1, 11, "parent_changed"),
        (2, 20, "parent_changed"),
        (2, 21, ""),
    ]


def test_duplicate_keys_and_holes(spark):
    df = spark.createDataFrame([(1,), (1,), (2,)], "id long")
    assert rows_of(quality.duplicate_keys(df, ["id"])) == [(1, 2)]
    audits = spark.createDataFrame([(7, 1)], "id long, ticketid long")
    assert rows_of(quality.holes(df.distinct(), audits)) == [(2,)]


# --- upsert ---

ROW = "id long, updatedat long, v string, ext string"


def test_newest_breaks_ties_by_the_whole_row(spark):
    df = spark.createDataFrame([(1, 5, "a", "z"), (1, 5, "b", "a"), (1, 4, "z", "z"), (2, None, "n", None), (2, 0, "m", None)], ROW)
    assert rows_of(upsert.newest(df, ["id"], ["updatedat"])) == [(1, 5, "b", "a"), (2, 0, "m", None)]


def test_merge_keeps_the_newer_version(spark):
    stored = spark.createDataFrame([(1, 10, "old", "e1"), (2, 10, "old", "e2"), (3, 10, "old", "e3"), (5, None, "old", "e5")], ROW)
    batch = spark.createDataFrame([(1, 9, "late", "-"), (2, 11, "new", "-"), (3, 10, "tie", "-"), (4, 1, "fresh", "-"), (5, 1, "new", "-")], ROW)
    want = [(1, 10, "old", "e1"), (2, 11, "new", "e2"), (3, 10, "tie", "e3"), (4, 1, "fresh", "-"), (5, 1, "new", "e5")]
    once = upsert.merge(stored, batch, ["id"], "updatedat", kept=["ext"])
    assert rows_of(once) == want
    assert rows_of(upsert.merge(once, batch, ["id"], "updatedat", kept=["ext"])) == want


def test_merge_without_age_takes_the_incoming_row(spark):
    stored = spark.createDataFrame([(1, 10, "old", None), (2, 10, "old", None)], ROW)
    batch = spark.createDataFrame([(1, 9, "in", None)], ROW)
    assert rows_of(upsert.merge(stored, batch, ["id"]), "id", "v") == [(1, "in"), (2, "old")]


def test_merge_against_a_plain_model(spark):
    random.seed(7)
    held: dict[int, tuple] = {}
    stored = spark.createDataFrame([], "id long, updatedat long, v string")
    for step in range(3):
        batch = [(random.randint(1, 30), random.randint(0, 9), f"{step}-{i}") for i in range(40)]
        for row in sorted(batch, key=lambda r: (r[1], r[2])):
            if row[0] not in held or row[1] >= held[row[0]][1]:
                held[row[0]] = row
        stored = upsert.merge(stored, spark.createDataFrame(batch, "id long, updatedat long, v string"), ["id"], "updatedat")
    assert rows_of(stored) == sorted(held.values(), key=repr)


def test_align_and_defaults(spark):
    table = TABLES["organization"]
    rows = upsert.align(spark.createDataFrame([(1, "n", 5)], "id int, name string, groupid long"), table)
    assert rows.schema.names == table.names
    assert tuple(rows.first()) == (1, "UNDEFINED", "n", -1, -1, 5)
    nulls = spark.createDataFrame([(1, None, None, None, None, 5)], table.struct)
    assert tuple(upsert.apply_defaults(nulls, table).first()) == (1, "UNDEFINED", "UNDEFINED", -1, -1, 5)


def test_sentinels(spark):
    user = with_seed("user", spark.createDataFrame([], TABLES["user"].struct)).first()
    assert (user["id"], user["organizationid"], user["suspended"], user["role"]) == (0, 0, True, "UNDEFINED")
    assert with_seed("ticket", spark.createDataFrame([], TABLES["ticket"].struct)).count() == 0


# --- hooks ---


def test_hooks_run_in_order_and_may_drop(spark):
    hooks = Hooks()
    hooks.register("t", lambda d: d.withColumn("v", F.col("v") + 1))
    hooks.register("t", lambda d: d.filter("v > 2"))
    copy = hooks.copy()
    copy.register("t", lambda d: d.limit(0))
    df = spark.createDataFrame([(1, 1), (2, 2), (None, 9)], "id long, v long")
    assert rows_of(hooks.apply("t", df)) == [(2, 3)]
    assert hooks.apply("other", df).count() == 2
