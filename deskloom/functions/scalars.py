"""Column functions over text, epoch seconds and nested JSON values; all run in the JVM."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from deskloom.settings import DEFAULT_TICKET_TYPE

RFC3339 = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d+)?(Z|[+-]\d{2}:\d{2})$"


def instant(text: Column) -> Column:
    """RFC 3339 text to a timestamp; NULL where it is none."""
    return F.when(text.rlike(RFC3339), F.try_to_timestamp(text))


def to_epoch(text: Column) -> Column:
    """RFC 3339 text to whole epoch seconds; missing, unreadable or pre-1970 becomes 0."""
    return epoch_of(instant(text))


def epoch_of(moment: Column) -> Column:
    """A timestamp to whole epoch seconds; NULL or pre-1970 becomes 0."""
    return F.greatest(F.lit(0).cast("bigint"), F.coalesce(F.unix_seconds(moment), F.lit(0)))


def is_bad_time(text: Column) -> Column:
    """True for text that is present but is not an RFC 3339 time."""
    return text.isNotNull() & instant(text).isNull()


def to_rfc3339(epoch: Column) -> Column:
    """Epoch seconds to RFC 3339 text at UTC (session time zone is UTC)."""
    return F.date_format(F.timestamp_seconds(epoch), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def calendar_minutes(value: Column) -> Column:
    """Calendar figure of a ``{calendar, business}`` pair; missing becomes 0."""
    return F.coalesce(value["calendar"], F.lit(0).cast("bigint"))


def from_epoch(epoch: Column) -> Column:
    """Epoch seconds to a UTC timestamp; negative seconds have none and give NULL."""
    return F.when(epoch >= 0, F.timestamp_seconds(epoch)).cast("timestamp_ntz")


def from_epoch_signed(epoch: Column) -> Column:
    """Epoch seconds of either sign to a UTC timestamp."""
    return F.timestamp_seconds(epoch).cast("timestamp_ntz")


def convert_tz(moment: Column, source: str, target: str) -> Column:
    """Shift a wall-clock timestamp from one time zone to another."""
    return F.convert_timezone(F.lit(source), F.lit(target), moment)


def to_unsigned(text: Column) -> Column:
    """Text to an integer; text that is not one gives NULL."""
    return text.try_cast("bigint")


def to_unsigned_lenient(text: Column) -> Column:
    """Leading digits of a text as a number, 0 when it has none; NULL stays NULL."""
    digits = F.regexp_extract(text, r"^\s*(\d+)", 1).try_cast("decimal(20,0)")
    return F.when(text.isNotNull(), F.coalesce(digits, F.lit(0).cast("decimal(20,0)")))


def parse_int(text: Column) -> Column:
    """Text to an integer, 0 when it is not one."""
    return F.coalesce(text.try_cast("bigint"), F.lit(0).cast("bigint"))


def ticket_type(recipient: Column, types: Mapping[str, str]) -> Column:
    """Ticket type of the mailbox a ticket was sent to."""
    by_type: dict[str, list[str]] = {}
    for address, kind in types.items():
        if kind != DEFAULT_TICKET_TYPE:
            by_type.setdefault(kind, []).append(address)
    chosen = F.lit(DEFAULT_TICKET_TYPE)
    for kind, addresses in by_type.items():
        chosen = F.when(recipient.isin(addresses), F.lit(kind)).otherwise(chosen)
    return chosen


def same_title(title: Column, wanted: str, exact: bool = True) -> Column:
    """Title equality: exact, or blind to case, accents and trailing blanks."""
    if exact:
        return title == wanted
    return F.collate(title, "UNICODE_CI_AI_RTRIM") == F.lit(wanted)


def json_text(document: Column, member: str) -> Column:
    """Any JSON member (number, flag, text, list, object) as text; JSON null gives NULL."""
    return F.from_json(document, f"struct<`{member}`:string>")[member]
