from __future__ import annotations

from datetime import datetime

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from deskloom.functions import scalars as s
from deskloom.settings import recipient_types


def one(spark, value, kind, fn):
    return spark.createDataFrame([(value,)], f"v {kind}").select(fn(F.col("v"))).first()[0]


@pytest.mark.parametrize(
    ("text", "epoch", "bad"),
    [
        ("2024-01-01T00:00:00Z", 1704067200, False),
        ("2024-01-01T00:00:00.999Z", 1704067200, False),
        ("2024-01-01T02:00:00+02:00", 1704067200, False),
        ("1960-01-01T00:00:00Z", 0, False),
        ("1970-01-01T00:00:00Z", 0, False),
        (None, 0, False),
        ("", 0, True),
        ("soon", 0, True),
        ("2024-01-01", 0, True),
        ("2024-13-01T00:00:00Z", 0, True),
    ],
)
def test_to_epoch(spark, text, epoch, bad):
    assert one(spark, text, "string", s.to_epoch) == epoch
    assert one(spark, text, "string", s.is_bad_time) is bad


def test_time_text_round_trip(spark):
    assert one(spark, 1704067201, "bigint", lambda c: s.to_epoch(s.to_rfc3339(c))) == 1704067201


def test_epoch_to_timestamp(spark):
    assert one(spark, 0, "bigint", s.from_epoch) == datetime(1970, 1, 1)
    assert one(spark, -1, "bigint", s.from_epoch) is None
    assert one(spark, -1, "bigint", s.from_epoch_signed) == datetime(1969, 12, 31, 23, 59, 59)


def test_convert_tz(spark):
    moved = one(spark, 1704067200, "bigint", lambda c: s.convert_tz(s.from_epoch(c), "UTC", "EST"))
    assert moved == datetime(2023, 12, 31, 19)


@pytest.mark.parametrize(
    ("text", "strict", "lenient", "default"),
    [
        ("12", 12, 12, 12),
        (" 12 ", 12, 12, 12),
        ("12abc", None, 12, 0),
        ("x", None, 0, 0),
        ("", None, 0, 0),
        (None, None, None, 0),
        ("status", None, 0, 0),
        ("18446744073709551615", None, 18446744073709551615, 0),
    ],
)
def test_text_to_number(spark, text, strict, lenient, default):
    assert one(spark, text, "string", s.to_unsigned) == strict
    assert one(spark, text, "string", s.to_unsigned_lenient) == lenient
    assert one(spark, text, "string", s.parse_int) == default


def test_calendar_minutes(spark):
    kind = "struct<calendar:bigint,business:bigint>"
    assert one(spark, (7, 3), kind, s.calendar_minutes) == 7
    assert one(spark, (None, 3), kind, s.calendar_minutes) == 0
    assert one(spark, None, kind, s.calendar_minutes) == 0


def test_ticket_types(spark):
    types = recipient_types("acme.test", "acme.desk.test")
    assert len(types) == 8
    cases = {
        "escalations@acme.test": "escalation",
        "support-escalations@acme.desk.test": "escalation",
        "se-support@acme.test": "se-support",
        "cloud-support@acme.desk.test": "cloud-professional",
        "support@acme.test": "enterprise",
        "someone@acme.test": "enterprise",
        None: "enterprise",
    }
    df = spark.createDataFrame([(k,) for k in cases], "r string")
    got = {r[0]: r[1] for r in df.select("r", s.ticket_type(F.col("r"), types)).collect()}
    assert got == cases


def test_title_equality(spark):
    df = spark.createDataFrame([("Root Cause",), ("ROOT CAUSE  ",), ("Root Cáuse",), (None,)], "t string")
    assert rows_of(df.filter(s.same_title(F.col("t"), "Root Cause"))) == [("Root Cause",)]
    assert df.filter(s.same_title(F.col("t"), "Root Cause", exact=False)).count() == 3


@pytest.mark.parametrize(
    ("json", "text"),
    [('{"v":true}', "true"), ('{"v":[1,2]}', "[1,2]"), ('{"v":null}', None), ('{"v":"a"}', "a"), ('{"v":{"k":1}}', '{"k":1}'), ("{}", None)],
)
def test_json_text(spark, json, text):
    assert one(spark, json, "string", lambda c: s.json_text(c, "v")) == text
