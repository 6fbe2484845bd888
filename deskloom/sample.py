"""The ticketing tables and JSON pages as derived from the driver's tables.

Ids are shifted by one, as id 0 is the sentinel. Every table is one pass over its source; pages hold
at most :data:`PAGE_ROWS` records because records are grouped by ranges of a unique id.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from deskloom import settings as S
from deskloom.functions.scalars import to_rfc3339
from deskloom.operators.flatten import keep_events
from deskloom.operators.upsert import align
from deskloom.rows import literal_rows, with_seed
from deskloom.schema import RESOURCES, TABLES

PAGE_ROWS = 1000
HOST = "https://desk.example.com"
ORPHAN = 999_999_999

TICKET_FIELDS = {
    101: S.TITLE_PRIORITY,
    102: S.TITLE_COMPONENT,
    103: S.TITLE_CAUSE,
    104: S.TITLE_VERSION,
    105: S.TITLE_BUNDLE,
    106: S.TITLE_TIME_TOTAL,
    107: S.TITLE_TIME_LAST,
}
ORGANIZATION_FIELDS = {
    201: "technical_account_manager",
    202: "renewal_date",
    203: "primary_timezone",
    204: "subscription_type",
    205: "systems_engineer",
}
USER_FIELDS = {301: "home_region", 302: "tier"}


def _s(column: str | Column) -> Column:
    return (F.col(column) if isinstance(column, str) else column).cast("string")


def _n(column: str | Column) -> Column:
    return (F.col(column) if isinstance(column, str) else column).cast("bigint")


def epoch(moment: str | Column) -> Column:
    return F.unix_seconds((F.col(moment) if isinstance(moment, str) else moment).cast("timestamp"))


def text_tail(prefix: str, column: str | Column) -> Column:
    return F.concat(F.lit(prefix), _s(column))


def _entries(*pairs: tuple[int, Column, Column | None]) -> Column:
    """Attribute entries ``(id, value)``; one whose condition fails is NULL."""
    made = []
    for number, value, condition in pairs:
        entry = F.struct(F.lit(number).cast("bigint").alias("id"), value.alias("value"))
        made.append(entry if condition is None else F.when(condition, entry))
    return F.array(*made)


def _map_of(*pairs: tuple[str, Column, Column | None]) -> Column:
    """A text map; a pair whose condition fails is left out."""
    made = []
    for name, value, condition in pairs:
        entry = F.struct(F.lit(name).alias("key"), value.alias("value"))
        made.append(entry if condition is None else F.when(condition, entry))
    return F.map_from_entries(F.array_compact(F.array(*made)))


class Desk(Mapping):
    """Base tables by name, over one folder of driver tables."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark = spark
        self.sf_dir = sf_dir

    def source(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def __getitem__(self, table: str) -> DataFrame:
        return getattr(self, f"_{table}")

    def __iter__(self) -> Iterator[str]:
        return iter(t for t in TABLES if t != "sequencetable")

    def __len__(self) -> int:
        return len(TABLES) - 1

    # --- field definitions ---

    def _definitions(self, table: str, fixed: dict[int, str], source: str, key: str, title: str, first: int) -> DataFrame:
        spec = TABLES[table]
        rows = [(number, "text", name, name, 0, 0) for number, name in fixed.items()]
        further = self.source(source).select(
            (F.col(key) + first).alias("id"),
            F.lit("text").alias("type"),
            text_tail(f"{source}_", key).alias("skey"),
            F.col(title).alias("title"),
            _n(F.lit(725846400)).alias("createdat"),
            (F.lit(725846400) + F.col(key)).alias("updatedat"),
        )
        return literal_rows(self.spark, spec.struct, rows).unionByName(further)

    @cached_property
    def _ticketfields(self) -> DataFrame:
        return self._definitions("ticketfields", TICKET_FIELDS, "part", "p_partkey", "p_name", 1001)

    @cached_property
    def _organizationfields(self) -> DataFrame:
        return self._definitions("organizationfields", ORGANIZATION_FIELDS, "supplier", "s_suppkey", "s_name", 1001)

    @cached_property
    def _userfields(self) -> DataFrame:
        return self._definitions("userfields", USER_FIELDS, "supplier", "s_suppkey", "s_name", 2001)

    # --- groups, organizations, users ---

    @cached_property
    def _groups(self) -> DataFrame:
        rows = self.source("nation").select(
            _n(F.col("n_nationkey") + 1).alias("id"),
            F.col("n_name").alias("name"),
            _n(F.lit(-1)).alias("createdat"),
            _n(F.lit(-1)).alias("updatedat"),
        )
        return with_seed("groups", rows)

    @property
    def organization_records(self) -> DataFrame:
        """Organizations as the service returns them: no external id, fields as a map."""
        key = F.col("c_custkey")
        fields = _map_of(
            ("technical_account_manager", text_tail("tam-", key % 9), None),
            ("renewal_date", F.concat(F.lit("2025-0"), _s(key % 9 + 1), F.lit("-01")), None),
            ("primary_timezone", F.when(F.col("c_nationkey") % 2 == 0, "UTC").otherwise("EST"), None),
            ("subscription_type", F.col("c_mktsegment"), None),
            ("systems_engineer", text_tail("se-", key % 4), key % 10 != 0),
        )
        return self.source("customer").select(
            (key + 1).alias("id"),
            F.col("c_name").alias("name"),
            (key + 788918400).alias("createdat"),
            (key * 2 + 788918400).alias("updatedat"),
            _n(F.col("c_nationkey") + 1).alias("groupid"),
            fields.alias("organization_fields"),
        )

    @cached_property
    def _organization(self) -> DataFrame:
        return with_seed("organization", align(self.organization_records, TABLES["organization"]))

    def _map_rows(self, records: DataFrame, members: str, fixed: dict[int, str]) -> DataFrame:
        ids = F.create_map(*[F.lit(v) for number, name in fixed.items() for v in (name, number)])
        return records.select(F.col("id").alias("objectid"), F.explode(members).alias("title", "value")).select(
            "objectid",
            _n(F.coalesce(F.try_element_at(ids, F.col("title")), F.lit(0))).alias("id"),
            "title",
            "value",
            F.lit("").alias("transformed"),
        )

    @cached_property
    def _organizationdata(self) -> DataFrame:
        return self._map_rows(self.organization_records, "organization_fields", ORGANIZATION_FIELDS)

    @property
    def user_records(self) -> DataFrame:
        key = F.col("s_suppkey")
        return self.source("supplier").select(
            (key + 1).alias("id"),
            text_tail("ext-", key).alias("externalid"),
            F.concat(F.lit("agent"), _s(key), F.lit("@example.com")).alias("email"),
            F.col("s_name").alias("name"),
            (key + 757382400).alias("createdat"),
            (key * 3 + 757382400).alias("updatedat"),
            (key * 5 + 757382400).alias("lastloginat"),
            _n(F.lit(0)).alias("organizationid"),
            _n(F.col("s_nationkey") + 1).alias("groupid"),
            F.lit("agent").alias("role"),
            (F.col("s_acctbal") < 0).alias("suspended"),
            F.lit("UTC").alias("timezone"),
            F.create_map(
                F.lit("home_region"), text_tail("region-", F.col("s_nationkey") % 5),
                F.lit("tier"), text_tail("tier-", key % 3),
                F.lit("legacy_code"), F.col("s_name"),
            ).alias("user_fields"),
        )

    @cached_property
    def _user(self) -> DataFrame:
        return with_seed("user", align(self.user_records, TABLES["user"]))

    @cached_property
    def _userdata(self) -> DataFrame:
        return self._map_rows(self.user_records, "user_fields", USER_FIELDS)

    # --- tickets ---

    @property
    def ticket_records(self) -> DataFrame:
        """Tickets with their custom fields as ``[{id, value}]``."""
        key = F.col("o_orderkey")
        created = epoch("o_orderdate")
        status = F.when(F.col("o_orderstatus") == "F", "solved").when(F.col("o_orderstatus") == "O", "open")
        mailbox = (
            F.when(F.col("o_orderpriority") == "1-URGENT", "escalations")
            .when(F.col("o_orderpriority") == "2-HIGH", "se-support")
            .when(F.col("o_orderpriority") == "3-MEDIUM", "support")
            .when(F.col("o_orderpriority") == "5-LOW", "cloud-support")
            .otherwise("other")
        )
        assignee = F.when(key % 97 == 0, F.lit(ORPHAN)).when(key % 13 == 12, F.lit(0)).otherwise(key % 10 + 1)
        return self.source("orders").select(
            (key + 1).alias("id"),
            text_tail("ext-", "o_custkey").alias("externalid"),
            F.concat(F.lit(f"{HOST}{S.API_PATH}/tickets/"), _s(key + 1), F.lit(".json")).alias("url"),
            text_tail("Order ", key).alias("subject"),
            status.otherwise("pending").alias("status"),
            _n(F.when(key % 89 == 3, F.lit(ORPHAN)).otherwise(key % 10 + 1)).alias("requesterid"),
            _n(F.when(key % 83 == 5, F.lit(ORPHAN)).otherwise(key % 10 + 1)).alias("submitterid"),
            _n(assignee).alias("assigneeid"),
            F.concat(mailbox, F.lit("@example.com")).alias("recipient"),
            (F.col("o_custkey") + 1).alias("organizationid"),
            _n(F.when(key % 79 == 7, F.lit(ORPHAN)).otherwise(F.lit(0))).alias("groupid"),
            created.alias("createdat"),
            (created + key % 48 * 3600).alias("updatedat"),
            F.array_compact(self._ticket_entries).alias("custom_fields"),
        )

    @property
    def _ticket_entries(self) -> Column:
        key = F.col("o_orderkey")
        return _entries(
            (101, F.col("o_orderpriority"), None),
            (102, text_tail("component-", key % 7), key % 11 != 0),
            (103, text_tail("cause-", key % 5), None),
            (104, text_tail("v", key % 4), None),
            (105, F.when(key % 3 == 0, "true").otherwise("false"), None),
        )

    @cached_property
    def _ticket(self) -> DataFrame:
        return align(self.ticket_records, TABLES["ticket"])

    @cached_property
    def _ticketdata(self) -> DataFrame:
        titles = F.create_map(*[F.lit(v) for pair in TICKET_FIELDS.items() for v in pair])
        # The outer form adds no filter that would build the entries a second time.
        entries = self.source("orders").select(
            (F.col("o_orderkey") + 1).alias("objectid"), F.inline_outer(self._ticket_entries)
        )
        return entries.filter(F.col("id").isNotNull()).select(
            "objectid", "id", titles[F.col("id").cast("int")].alias("title"), "value", F.lit("").alias("transformed")
        )

    # --- audits and events ---

    @property
    def _with_events(self) -> DataFrame:
        """Audits with their events, before any filter: one of each kind, and every third audit has a second one.

        Ids of events are not those of audits, and of two events the second may have the lesser id.
        """
        kind, key = F.col("event_type"), F.col("event_id")
        timed = kind.isin("purchase", "signup")
        field = (
            F.when(kind == "purchase", "106")
            .when(kind.isin("click", "view"), "101")
            .when(kind == "signup", "107")
            .otherwise("status")
        )
        minutes = F.get_json_object("props", "$.k").cast("bigint")
        turned = key % 6 == 0
        first = F.struct(
            F.when(turned, key * 2 + 2).otherwise(key * 2 + 1).alias("id"),
            F.when(kind == "view", "Create").otherwise(S.AUDIT_EVENT_TYPE).alias("type"),
            field.alias("fieldname"),
            F.when(timed, _s(minutes * 60)).otherwise(text_tail("P", key % 5)).alias("value"),
            F.when(key % 4 == 0, "").when(timed, "0").otherwise(text_tail("P", key % 4)).alias("pvalue"),
        )
        second = F.struct(
            F.when(turned, key * 2 + 1).otherwise(key * 2 + 2).alias("id"),
            F.when(key % 5 == 0, "Comment").otherwise(S.AUDIT_EVENT_TYPE).alias("type"),
            F.when(key % 2 == 0, "101").otherwise("106").alias("fieldname"),
            F.when(key % 2 == 0, text_tail("Q", key % 7)).otherwise(_s(key % 1000 * 60)).alias("value"),
            text_tail("Q", key % 3).alias("pvalue"),
        )
        return self.source("events").select(
            (key + 1).alias("id"),
            (F.col("user_id") + 1).alias("ticketid"),
            epoch("ts").alias("createdat"),
            (F.col("user_id") % 10 + 1).alias("authorid"),
            F.array_compact(F.array(first, F.when(key % 3 == 0, second))).alias("_events"),
        )

    @property
    def raw_events(self) -> DataFrame:
        """The events of all audits, before any filter."""
        audits = self._with_events.withColumnRenamed("id", "auditid")
        return audits.select("auditid", "ticketid", "createdat", "authorid", F.inline("_events"))

    @property
    def audit_records(self) -> DataFrame:
        named = F.transform(
            "_events",
            lambda e: F.struct(
                e["id"].alias("id"), e["type"].alias("type"), e["fieldname"].alias("field_name"),
                e["value"].alias("value"), e["pvalue"].alias("previous_value"),
            ),
        )
        return self._with_events.select("id", "ticketid", "createdat", "authorid", named.alias("events"))

    @cached_property
    def _changeevent(self) -> DataFrame:
        return keep_events(self.raw_events, self["ticketfields"]).select(*TABLES["changeevent"].names)

    @cached_property
    def _audit(self) -> DataFrame:
        """Audits with a kept event."""
        kept = keep_events(self.raw_events, self["ticketfields"])
        return kept.select(F.col("auditid").alias("id"), "ticketid", "createdat", "authorid").distinct()

    # --- metrics and ratings ---

    @cached_property
    def _ticketmetric(self) -> DataFrame:
        longest = _n(F.max("l_linenumber"))
        first, last = epoch(F.min("l_shipdate")), epoch(F.max("l_shipdate"))
        zero = _n(F.lit(0))
        metrics = self.source("lineitem").groupBy("l_orderkey").agg(
            _n(F.count_if(F.col("l_returnflag") == "R")).alias("reopens"),
            F.count(F.lit(1)).alias("replies"),
            last.alias("solvedat"),
            first.alias("createdat"),
            last.alias("updatedat"),
            (_n(F.min("l_linenumber")) * 60).alias("ttfr"),
            (longest * 1440).alias("ttr"),
            (longest * 30).alias("agentwaittime"),
            (longest * 45).alias("requesterwaittime"),
        )
        none = ["assignedat", "initiallyassignedat", "latestcommentaddedat", "assigneeupdatedat",
                "requesterupdatedat", "statusupdatedat"]
        return metrics.select(
            (F.col("l_orderkey") + 1).alias("id"),
            (F.col("l_orderkey") + 1).alias("ticketid"),
            "*",
            *[zero.alias(n) for n in none],
        ).select(*TABLES["ticketmetric"].names)

    @cached_property
    def _satisfactionrating(self) -> DataFrame:
        key = F.col("doc_id")
        return self.source("labels").select(
            (key + 1).alias("id"),
            (key % 10 + 1).alias("assigneeid"),
            _n(F.lit(0)).alias("groupid"),
            (key % 10 + 1).alias("requesterid"),
            (key + 1).alias("ticketid"),
            F.when(F.col("quality") == 1, "good").otherwise("bad").alias("score"),
            (key * 3600 + 1704067200).alias("createdat"),
            (key * 3600 + 1704067200).alias("updatedat"),
            F.when(F.col("toxic") == 1, "flagged").otherwise("").alias("reason"),
        )

    # --- pages ---

    def records(self, table: str) -> DataFrame:
        """Rows of a resource with their embedded members, before sentinels."""
        nested = {
            "organization": "organization_records",
            "user": "user_records",
            "ticket": "ticket_records",
            "audit": "audit_records",
        }
        if table in nested:
            return getattr(Dealt(self.spark, self.sf_dir), nested[table])
        rows = self[table]
        return rows.filter("id > 0") if TABLES[table].seed else rows

    def pages(self, table: str, rows: DataFrame | None = None) -> DataFrame:
        """Landed pages of one resource."""
        return to_pages(self.records(table) if rows is None else rows, table)

    def all_pages(self) -> DataFrame:
        """Landed pages of every resource."""
        pages = None
        for table in RESOURCES:
            more = self.pages(table)
            pages = more if pages is None else pages.unionByName(more)
        return pages


class Dealt(Desk):
    """The same where rows of one page are dealt to one task as they are read: what the tables hold is shuffled, not the
    several times wider records made of it, and pages are gathered where they lie."""

    KEYS = {"customer": "c_custkey", "supplier": "s_suppkey", "orders": "o_orderkey", "events": "event_id"}

    def source(self, name: str) -> DataFrame:
        rows = super().source(name)
        key = self.KEYS.get(name)
        return rows if key is None else rows.repartition(F.floor((F.col(key) + 1) / PAGE_ROWS))


def encode(rows: DataFrame, table: str) -> Column:
    """A row as the JSON record the service returns for it."""
    resource = RESOURCES[table]
    members = []
    for column, json, kind in resource.members + resource.embedded:
        if column not in rows.columns:
            continue
        value = F.col(column)
        if kind == "time":
            value = F.when(value > 0, to_rfc3339(value))
        elif kind == "calendar":
            value = F.struct(value.alias("calendar"), F.floor(value / 3).alias("business"))
        members.append(value.alias(json))
    return F.struct(*members)


def to_pages(rows: DataFrame, table: str) -> DataFrame:
    """Rows as landed pages, each of up to :data:`PAGE_ROWS` neighbouring ids."""
    resource = RESOURCES[table]
    record = encode(rows, table)
    if resource.plural is None:
        ticket = _s("ticketid")
        return rows.select(
            F.concat(F.lit(f"{HOST}{S.API_PATH}/tickets/"), ticket, F.lit("/metrics.json")).alias("url"),
            F.lit(200).alias("status_code"),
            F.col("id").alias("fetched_at"),
            F.to_json(F.struct(record.alias(resource.singular))).alias("body"),
        )
    number = F.floor(F.col("id") / PAGE_ROWS)
    by_ticket = table == "audit"
    group = {"_page": number, **({"_ticket": F.col("ticketid")} if by_ticket else {})}
    listed = rows.groupBy(*[c.alias(n) for n, c in group.items()]).agg(F.collect_list(record).alias("_records"))
    incremental = table in ("organization", "user", "ticket")
    if by_ticket:
        base = F.concat(F.lit(f"{HOST}{S.API_PATH}/tickets/"), _s("_ticket"), F.lit("/audits.json?page="))
    elif incremental:
        base = F.lit(f"{HOST}{S.API_PATH}/incremental/{resource.plural}.json?start_time=")
    else:
        base = F.lit(f"{HOST}{S.API_PATH}/{resource.plural}.json?page=")
    body = F.to_json(
        F.struct(F.col("_records").alias(resource.plural), F.size("_records").cast("bigint").alias("count"))
    )
    return listed.select(
        F.concat(base, _s("_page")).alias("url"),
        F.lit(200).alias("status_code"),
        F.col("_page").alias("fetched_at"),
        body.alias("body"),
    )
