"""One key holds a third of all rows: results stay whole and the work is split."""

from __future__ import annotations

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from deskloom.operators import quality, upsert
from deskloom.operators.flatten import flatten_list, index_titles
from deskloom.plans import views
from deskloom.schema import TABLES
from deskloom.settings import TITLE_PRIORITY, TITLE_TIME_TOTAL
from deskloom.sources.pages import children_of

ROWS = 30_000
HOT = 7


@pytest.fixture()
def small_partitions(spark):
    """Make a local shuffle look big: nothing is broadcast, and a partition of some KB counts as skewed."""
    wanted = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "20",
    }
    before = {name: spark.conf.get(name, None) for name in wanted}
    for name, value in wanted.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        if value is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, value)


def hot(column="id"):
    """A third of all rows on one key, the rest on many."""
    return F.when(F.col(column) % 3 == 0, F.lit(HOT)).otherwise(F.col(column) % 500 + 10).cast("bigint")


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def audits(spark):
    return spark.range(0, ROWS, 1, 8).select("id", hot().alias("ticketid"), F.lit(0).cast("bigint").alias("createdat"),
                                             F.lit(1).cast("bigint").alias("authorid"))


def test_children_of_changed_tickets(spark, small_partitions):
    changed = spark.range(0, 300).select("id")
    kept = children_of(audits(spark), changed)
    plan = final_plan(kept)
    assert "isSkewJoin=true" in plan or "skew=true" in plan.lower()
    want = sum(1 for i in range(ROWS) if (HOT if i % 3 == 0 else i % 500 + 10) < 300)
    assert kept.count() == want


def test_attributes_of_a_hot_field(spark, small_partitions):
    """Most attribute rows carry one field id, and the index is too large to broadcast."""
    entry = F.array(F.struct(hot().alias("id"), F.col("id").cast("string").alias("value")))
    records = spark.range(0, ROWS, 1, 8).select("id", entry.alias("custom_fields"))
    index = spark.range(0, 600).select("id", F.concat(F.lit("t"), F.col("id").cast("string")).alias("title"))
    rows = flatten_list(records, index_titles(index))
    assert "skew=true" in final_plan(rows).lower()
    assert rows.count() == ROWS
    assert rows.filter(f"title = 't{HOT}'").count() == ROWS // 3


def test_views_of_a_hot_ticket(spark, small_partitions):
    number = F.col("id") % 997
    events = spark.range(0, ROWS, 1, 8).select(
        "id", F.col("id").alias("auditid"), F.lit("Change").alias("type"),
        F.when(F.col("id") % 2 == 0, "106").otherwise("101").alias("fieldname"),
        number.cast("string").alias("value"), F.when(F.col("id") % 5 == 1, "").otherwise(F.concat(F.lit("P"), F.col("id").cast("string"))).alias("pvalue"))
    fields = spark.createDataFrame(
        [(101, "t", "k", TITLE_PRIORITY, 0, 0), (106, "t", "k", TITLE_TIME_TOTAL, 0, 0)], TABLES["ticketfields"].struct)
    tables = {"changeevent": events, "audit": audits(spark), "ticketfields": fields, "ticket": spark.range(0, 600).select("id")}
    spent, first = {}, {}
    for i in range(ROWS):
        t = HOT if i % 3 == 0 else i % 500 + 10
        if i % 2 == 0:
            spent[t] = max(spent.get(t, -1), i % 997)
        elif i % 5 != 1:
            first.setdefault(t, f"P{i}")
    assert dict(rows_of(views.time_spent(tables))) == spent
    assert dict(rows_of(views.ticket_initial_priority(tables))) == first


def test_newest_of_a_hot_key_is_cut_before_the_shuffle(spark, small_partitions):
    rows = spark.range(0, ROWS, 1, 8).select(hot().alias("key"), (F.col("id") % 1000).alias("age"), F.col("id").alias("v"))
    newest = upsert.newest(rows, ["key"], ["age"])
    plan = final_plan(newest)
    assert plan.count("WindowGroupLimit") >= 2 and "Partial" in plan
    best = {}
    for i in range(ROWS):
        key = HOT if i % 3 == 0 else i % 500 + 10
        best[key] = max(best.get(key, (-1, -1)), (i % 1000, i))
    assert {r["key"]: (r["age"], r["v"]) for r in newest.collect()} == best


def test_references_to_a_hot_missing_parent(spark, small_partitions):
    rows = audits(spark)
    tables = {"ticket": spark.range(0, 400).select("id"), "user": spark.range(0, 5).select("id")}
    found = quality.orphans(rows, TABLES["audit"].parents, tables, ["id", "ticketid"])
    assert found.count() == sum(1 for i in range(ROWS) if i % 3 and i % 500 + 10 >= 400)
    tables["ticket"] = spark.range(10, 600).select("id")
    tagged = quality.check(rows, "audit", tables)
    assert quality.quarantined(tagged, "audit").count() == ROWS // 3
    assert quality.accepted(tagged).count() == ROWS - ROWS // 3


def test_tickets_of_a_hot_organization(spark, small_partitions):
    tickets = spark.range(0, ROWS, 1, 8).select("id", hot().alias("organizationid"), F.lit(1).cast("bigint").alias("assigneeid"))
    tables = {"ticket": tickets, "user": spark.range(0, 3).select("id"),
              "organization": spark.range(0, 600).select("id", F.col("id").cast("string").alias("name"))}
    joined = views._tickets_with_account(tables)
    assert "skew=true" in final_plan(joined).lower()
    assert joined.count() == ROWS
    assert joined.filter(F.col("organization") == str(HOT)).count() == ROWS // 3


def test_wide_ticket_rows_are_shuffled_once(spark, small_partitions, tmp_path):
    tables = {}
    for name in ("ticket", "ticketdata", "organization", "user", "ticketmetric", "changeevent", "audit", "ticketfields"):
        spark.createDataFrame([], TABLES[name].struct).write.parquet(f"{tmp_path}/{name}")
        tables[name] = spark.read.parquet(f"{tmp_path}/{name}")
    for view in (views.ticket_view, views.ticket_view_basic):
        mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
        nodes = view(tables)._jdf.queryExecution().explainString(mode).split("\n\n")
        assert sum("subject" in n for n in nodes if " Exchange\n" in n) == 1
