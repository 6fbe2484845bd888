"""The views: ticket and organization attributes, time spent, and the two wide join views.

Each view is a function of the base tables it reads. Joins on a hot key (one ticket with a third
of all audits) are avoided by grouping down to one row per audit, then per ticket, before any join;
both groupings combine before their shuffle.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from deskloom.functions.scalars import from_epoch, from_epoch_signed, ticket_type, to_unsigned
from deskloom.operators.eav import attribute, pivot
from deskloom.operators.flatten import wanted_fields
from deskloom.settings import (
    COMPANY_MAILBOXES,
    DEFAULT_TICKET_TYPE,
    DESK_MAILBOXES,
    ORGANIZATION_ATTRIBUTES,
    TICKET_ATTRIBUTES,
    TITLE_BUNDLE,
    TITLE_CAUSE,
    TITLE_COMPONENT,
    TITLE_PRIORITY,
    TITLE_TIME_TOTAL,
    TITLE_VERSION,
    recipient_types,
)

Tables = Mapping[str, DataFrame]


# --- change events ----------------------------------------------------------------------------


def _per_ticket(events: DataFrame, audit: DataFrame, per_audit: Mapping[str, Column], per_ticket: Mapping[str, Column]) -> DataFrame:
    """Group events to one row per audit, join the audits, group to one row per ticket."""
    grouped = events.groupBy("auditid").agg(*[c.alias(n) for n, c in per_audit.items()])
    owners = audit.select(F.col("id").alias("_audit"), "ticketid")
    return (
        grouped.join(owners, F.col("auditid") == F.col("_audit"))
        .groupBy("ticketid")
        .agg(*[c.alias(n) for n, c in per_ticket.items()])
    )


def _titled(changeevent: DataFrame, ticketfields: DataFrame, titles: list[str]) -> DataFrame:
    fields = wanted_fields(ticketfields, titles)
    return changeevent.join(fields, F.col("fieldname").try_cast("bigint") == F.col("_field"))


def time_spent(t: Tables) -> DataFrame:
    """Greatest total time recorded for each ticket, in seconds."""
    events = _titled(t["changeevent"], t["ticketfields"], [TITLE_TIME_TOTAL])
    spent = _per_ticket(
        events, t["audit"], {"_v": F.max(to_unsigned(F.col("value")))}, {"value": F.max("_v")}
    )
    return _of_tickets(spent, t["ticket"])


def time_spent_all_fields(t: Tables) -> DataFrame:
    """As :func:`time_spent`, over every kept event whatever its field."""
    spent = _per_ticket(
        t["changeevent"], t["audit"], {"_v": F.max(to_unsigned(F.col("value")))}, {"value": F.max("_v")}
    )
    return _of_tickets(spent, t["ticket"])


def _of_tickets(spent: DataFrame, ticket: DataFrame) -> DataFrame:
    ids = ticket.select("id")
    return spent.join(ids, F.col("ticketid") == F.col("id"), "left_semi").select(F.col("ticketid").alias("id"), "value")


def ticket_time(t: Tables) -> DataFrame:
    return time_spent(t).select(F.col("id").alias("ticketid"), F.col("value").alias("tickettime"))


def _filled(pvalue: Column) -> Column:
    """Not NULL and not empty."""
    return pvalue > ""


def first_change_id(t: Tables) -> DataFrame:
    """Id of the first priority change of each ticket that names an earlier priority."""
    events = _titled(t["changeevent"], t["ticketfields"], [TITLE_PRIORITY]).filter(_filled(F.col("pvalue")))
    return _per_ticket(events, t["audit"], {"_id": F.min("id")}, {"firstchanged": F.min("_id")})


def ticket_initial_priority(t: Tables) -> DataFrame:
    """Priority a ticket had before its first priority change."""
    events = _titled(t["changeevent"], t["ticketfields"], [TITLE_PRIORITY]).filter(_filled(F.col("pvalue")))
    first = _per_ticket(
        events, t["audit"], {"_first": F.min(F.struct("id", "pvalue"))}, {"_first": F.min("_first")}
    )
    return first.select("ticketid", F.col("_first.pvalue").alias("initialpriority"))


def _change_summary(t: Tables) -> DataFrame:
    """Time spent and initial priority of each ticket, in one pass over the events."""
    events = _titled(t["changeevent"], t["ticketfields"], [TITLE_TIME_TOTAL, TITLE_PRIORITY])
    is_time = F.col("_title") == TITLE_TIME_TOTAL
    is_first = (F.col("_title") == TITLE_PRIORITY) & _filled(F.col("pvalue"))
    summary = _per_ticket(
        events,
        t["audit"],
        {
            "_time": F.max(F.when(is_time, to_unsigned(F.col("value")))),
            "_first": F.min(F.when(is_first, F.struct("id", "pvalue"))),
        },
        {"tickettime": F.max("_time"), "_first": F.min("_first")},
    )
    return summary.select(
        F.col("ticketid").alias("_t3"), "tickettime", F.col("_first.pvalue").alias("_initialpriority")
    )


# --- single attributes ------------------------------------------------------------------------


def ticket_attribute(title: str, name: str) -> Callable[[Tables], DataFrame]:
    return lambda t: attribute(t["ticketdata"], title, "ticketid", name)


def organization_attribute(name: str) -> Callable[[Tables], DataFrame]:
    return lambda t: attribute(t["organizationdata"], ORGANIZATION_ATTRIBUTES[name], "organizationid", name)


# --- wide views -------------------------------------------------------------------------------


def _tickets_with_account(t: Tables) -> DataFrame:
    """Tickets whose organization and assignee exist, with the organization's name.

    The shared parents meet three numbers of each ticket; the wide row joins what is left, on its id.
    """
    organizations = t["organization"].select(F.col("id").alias("_org"), F.col("name").alias("organization"))
    assignees = t["user"].select(F.col("id").alias("_user"))
    accounts = (
        t["ticket"]
        .select(F.col("id").alias("_t0"), F.col("organizationid").alias("_o"), F.col("assigneeid").alias("_a"))
        .join(organizations, F.col("_o") == F.col("_org"))
        .join(assignees, F.col("_a") == F.col("_user"), "left_semi")
        .select("_t0", "organization")
    )
    return t["ticket"].join(accounts, F.col("id") == F.col("_t0"))


def _metrics(t: Tables) -> DataFrame:
    return t["ticketmetric"].select(
        F.col("ticketid").alias("_t2"), "ttfr", "ttr", "solvedat", "agentwaittime", "requesterwaittime"
    )


def ticket_view(t: Tables, types: Mapping[str, str] | None = None) -> DataFrame:
    """One wide row per ticket that has an organization, an assignee and all five attributes."""
    return _with_type(ticket_recipients(t), ticket_type(F.col("recipient"), types or recipient_types()))


def _with_type(rows: DataFrame, kind: Column) -> DataFrame:
    return rows.select(*[kind.alias("type") if c == "recipient" else F.col(c) for c in rows.columns])


def ticket_recipients(t: Tables) -> DataFrame:
    """The ticket view with the address a ticket was sent to in place of the type that it stands for.

    Shared parents are resolved on narrow rows; everything joins on the ticket id after that, so the wide
    rows are shuffled once, on their id.
    """
    attributes = pivot(t["ticketdata"], TICKET_ATTRIBUTES, "_t1")
    return (
        _tickets_with_account(t)
        .join(attributes, F.col("id") == F.col("_t1"))
        .join(_metrics(t), F.col("id") == F.col("_t2"), "left")
        .join(_change_summary(t), F.col("id") == F.col("_t3"), "left")
        .select(
            "id",
            "organization",
            from_epoch(F.col("createdat")).alias("created"),
            from_epoch(F.col("updatedat")).alias("updated"),
            "recipient",
            "status",
            "subject",
            "priority",
            F.coalesce("_initialpriority", "priority").alias("initialpriority"),
            "component",
            "tickettime",
            "cause",
            "version",
            "bundleused",
            "ttfr",
            "ttr",
            from_epoch(F.col("solvedat")).alias("solved"),
            "agentwaittime",
            "requesterwaittime",
        )
    )


def ticket_view_sorted(t: Tables, types: Mapping[str, str] | None = None) -> DataFrame:
    """The ticket view in id order, for presentation."""
    return ticket_view(t, types).orderBy("id")


def ticket_view_basic(t: Tables) -> DataFrame:
    """The variant without ticket type and initial priority, with time over all kept events."""
    attributes = pivot(t["ticketdata"], TICKET_ATTRIBUTES, "_t1")
    spent = _per_ticket(
        t["changeevent"], t["audit"], {"_v": F.max(to_unsigned(F.col("value")))}, {"tickettime": F.max("_v")}
    ).withColumnRenamed("ticketid", "_t3")
    return (
        _tickets_with_account(t)
        .join(attributes, F.col("id") == F.col("_t1"))
        .join(_metrics(t), F.col("id") == F.col("_t2"), "left")
        .join(spent, F.col("id") == F.col("_t3"), "left")
        .select(
            "id",
            "organization",
            from_epoch_signed(F.col("createdat")).alias("created"),
            from_epoch_signed(F.col("updatedat")).alias("updated"),
            "status",
            "subject",
            "priority",
            "component",
            "tickettime",
            "cause",
            "version",
            "bundleused",
            "ttfr",
            "ttr",
            from_epoch_signed(F.col("solvedat")).alias("solved"),
            "agentwaittime",
            "requesterwaittime",
        )
    )


def organization_view(t: Tables) -> DataFrame:
    """Every column of an organization and its five attributes, where it has all of them."""
    attributes = pivot(t["organizationdata"], ORGANIZATION_ATTRIBUTES, "_o1")
    organization = t["organization"]
    return organization.join(attributes, F.col("id") == F.col("_o1")).select(
        *organization.columns, *ORGANIZATION_ATTRIBUTES
    )


# View name -> function of the base tables.
VIEWS: dict[str, Callable[[Tables], DataFrame]] = {
    "TimeSpent": time_spent,
    "TicketTime": ticket_time,
    "TicketInitialPriority": ticket_initial_priority,
    "TicketPriority": ticket_attribute(TITLE_PRIORITY, "priority"),
    "TicketComponent": ticket_attribute(TITLE_COMPONENT, "component"),
    "TicketCause": ticket_attribute(TITLE_CAUSE, "cause"),
    "TicketVersion": ticket_attribute(TITLE_VERSION, "version"),
    "BundleUsage": ticket_attribute(TITLE_BUNDLE, "bundleused"),
    "TicketView": ticket_view,
    "OrganizationTam": organization_attribute("tam"),
    "OrganizationRenewal": organization_attribute("renewaldate"),
    "OrganizationTZ": organization_attribute("timezone"),
    "OrganizationEntitlement": organization_attribute("entitlement"),
    "OrganizationSE": organization_attribute("se"),
    "OrganizationView": organization_view,
}


# A function of SQL that gives the ticket view for the mail domains of a site, and the view it reads.
TICKET_FUNCTION = "TicketViewOf"
RECIPIENTS_VIEW = "TicketRecipients"


def _ticket_function(rows: DataFrame) -> str:
    """The statement that defines :data:`TICKET_FUNCTION` over the view :data:`RECIPIENTS_VIEW` of the rows."""
    boxes = [("company", box, kind) for box, kind in COMPANY_MAILBOXES.items()] + [("desk", box, kind) for box, kind in DESK_MAILBOXES.items()]
    cases = " ".join(f"WHEN concat('{box}@', {domain}) THEN '{kind}'" for domain, box, kind in boxes)
    kind = f"CASE recipient {cases} ELSE '{DEFAULT_TICKET_TYPE}' END AS type"
    columns = ", ".join("type STRING" if n == "recipient" else f"{n} {t}" for n, t in rows.dtypes)
    chosen = ", ".join(kind if c == "recipient" else c for c in rows.columns)
    return (
        f"CREATE OR REPLACE TEMPORARY FUNCTION {TICKET_FUNCTION}(company STRING, desk STRING) "
        f"RETURNS TABLE({columns}) RETURN SELECT {chosen} FROM {RECIPIENTS_VIEW}"
    )


def register_views(spark: SparkSession, tables: Tables, types: Mapping[str, str] | None = None) -> None:
    """Make base tables (lower-case names) and views available to ``spark.sql``.

    ``types`` maps the site's own addresses to ticket types (``settings.recipient_types``). In SQL, the table function
    ``TicketViewOf(company, desk)`` gives the ticket view for other mail domains of a company and its desk.

    Further views over them are plain ``CREATE OR REPLACE TEMP VIEW`` statements. SQL names are
    case-blind, so a view whose name equals a base table's in another case must not be added.
    """
    for name, rows in tables.items():
        rows.createOrReplaceTempView(name)
    for name, view in VIEWS.items():
        rows = view(tables, types) if view is ticket_view else view(tables)
        rows.createOrReplaceTempView(name)
    recipients = ticket_recipients(tables)
    recipients.createOrReplaceTempView(RECIPIENTS_VIEW)
    spark.sql(_ticket_function(recipients))


def drop_views(spark: SparkSession, tables: Tables) -> None:
    """Take back what :func:`register_views` made."""
    spark.sql(f"DROP TEMPORARY FUNCTION IF EXISTS {TICKET_FUNCTION}")
    for name in [*tables, *VIEWS, RECIPIENTS_VIEW]:
        spark.catalog.dropTempView(name)
