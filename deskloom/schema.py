"""One registry of base tables and JSON resources; decoding, rules and loads all read it."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

from deskloom.settings import NO_TIME, UNDEFINED

SPARK_TYPES = {"long": T.LongType(), "string": T.StringType(), "boolean": T.BooleanType()}


@dataclass(frozen=True)
class Column:
    name: str
    kind: str
    required: bool = False
    unsigned: bool = False
    length: int | None = None
    default: object = None

    @property
    def type(self) -> T.DataType:
        return SPARK_TYPES[self.kind]


@dataclass(frozen=True)
class Table:
    """A base table: columns, key, and the rules a row must pass to be stored.

    ``age`` orders versions of one key. ``owner`` names the part of the key that is fixed for
    an ``id``: an id seen again under another owner is refused. ``slice_by`` is the numeric
    column whose ranges the stored files are grouped by, ``slice_rows`` the width of a range and
    ``slices`` how many groups there are: ranges are dealt to them in turn, so neighbouring ids stay
    together and ids that lie far apart make no more folders than that. ``sort_by`` is the order of rows in
    a file (the key, unless named), so that filters skip row groups.
    """

    name: str
    columns: tuple[Column, ...]
    key: tuple[str, ...] = ("id",)
    age: str | None = None
    owner: str | None = None
    parents: dict[str, str] = field(default_factory=dict)
    slice_by: str | None = "id"
    slice_rows: int = 1_000_000
    slices: int = 4096
    sort_by: tuple[str, ...] = ()
    seed: dict[str, object] | None = None

    @property
    def names(self) -> list[str]:
        return [c.name for c in self.columns]

    @property
    def struct(self) -> T.StructType:
        return T.StructType([T.StructField(c.name, c.type) for c in self.columns])

    def seed_row(self) -> tuple | None:
        """The sentinel row: given values, else the column defaults."""
        if self.seed is None:
            return None
        return tuple(self.seed.get(c.name, c.default) for c in self.columns)


def ident(name: str, required: bool = True, default: int | None = None) -> Column:
    return Column(name, "long", required=required, unsigned=True, default=default)


def count(name: str) -> Column:
    return Column(name, "long", unsigned=True, default=0)


def moment(name: str) -> Column:
    return Column(name, "long", default=NO_TIME)


def text(name: str, length: int = 255, required: bool = False, default: str | None = UNDEFINED) -> Column:
    return Column(name, "string", required=required, length=length, default=None if required else default)


def _definitions(name: str) -> Table:
    return Table(
        name,
        (ident("id"), text("type", required=True), text("skey"), text("title", required=True),
         moment("createdat"), moment("updatedat")),
        age="updatedat",
    )


# A key column that is not stored: the title of an attribute whose field is unknown. All such fields carry id 0,
# so the title tells them apart; a known field is its id, whatever it is called now.
UNKNOWN_FIELD = "_unknown_field"


def _attributes(name: str, parent: str, length: int) -> Table:
    return Table(
        name,
        (ident("objectid"), ident("id"), text("title", default=None),
         text("value", length, default=None), text("transformed", length, default=None)),
        key=("objectid", "id", UNKNOWN_FIELD),
        parents={"objectid": parent},
        slice_by="objectid",
        sort_by=("title", "objectid"),
    )


TABLES: dict[str, Table] = {
    t.name: t
    for t in (
        Table(
            "sequencetable",
            (text("sequencename", 20, required=True), Column("lastval", "long", True, True, default=0)),
            key=("sequencename",),
            slice_by=None,
        ),
        _definitions("organizationfields"),
        _definitions("userfields"),
        _definitions("ticketfields"),
        Table(
            "groups",
            (ident("id"), text("name", 50), moment("createdat"), moment("updatedat")),
            age="updatedat",
            seed={"id": 0},
        ),
        Table(
            "organization",
            (ident("id"), text("externalid"), text("name"), moment("createdat"), moment("updatedat"),
             ident("groupid")),
            age="updatedat",
            parents={"groupid": "groups"},
            seed={"id": 0, "groupid": 0},
        ),
        _attributes("organizationdata", "organization", 1024),
        Table(
            "user",
            (ident("id"), text("externalid"), text("email"), text("name"), moment("createdat"),
             moment("updatedat"), moment("lastloginat"), ident("organizationid", False, 0),
             ident("groupid", False, 0), text("role"), Column("suspended", "boolean", default=True),
             text("timezone")),
            age="updatedat",
            parents={"organizationid": "organization", "groupid": "groups"},
            seed={"id": 0},
        ),
        _attributes("userdata", "user", 255),
        Table(
            "ticket",
            (ident("id"), text("externalid"), text("url"), text("subject", required=True),
             text("status", 10, required=True), ident("requesterid", False, 0),
             ident("submitterid", False, 0), ident("assigneeid", False, 0), text("recipient"),
             ident("organizationid", False, 0), ident("groupid", False, 0), moment("createdat"),
             moment("updatedat")),
            age="updatedat",
            parents={"requesterid": "user", "submitterid": "user", "assigneeid": "user",
                     "organizationid": "organization", "groupid": "groups"},
        ),
        _attributes("ticketdata", "ticket", 255),
        Table(
            "ticketmetric",
            (ident("id"), ident("ticketid"), moment("createdat"), moment("updatedat"), moment("solvedat"),
             moment("assignedat"), moment("initiallyassignedat"), moment("latestcommentaddedat"),
             moment("assigneeupdatedat"), moment("requesterupdatedat"), moment("statusupdatedat"),
             moment("agentwaittime"), moment("requesterwaittime"), count("reopens"), count("replies"),
             count("ttfr"), count("ttr")),
            age="updatedat",
        ),
        Table(
            "audit",
            (ident("id"), ident("ticketid"), moment("createdat"), ident("authorid")),
            key=("id", "ticketid"),
            owner="ticketid",
            parents={"ticketid": "ticket", "authorid": "user"},
        ),
        Table(
            "changeevent",
            (ident("id"), ident("auditid"), text("type", default=None), text("fieldname", default=None),
             text("value", default=None), text("pvalue", default=None)),
            key=("id", "auditid"),
            owner="auditid",
            parents={"auditid": "audit"},
        ),
        Table(
            "satisfactionrating",
            (ident("id"), ident("assigneeid"), ident("groupid"), ident("requesterid"), ident("ticketid"),
             text("score", default=None), moment("createdat"), moment("updatedat"),
             text("reason", 1024, default=None)),
            key=("id", "ticketid"),
            age="updatedat",
            owner="ticketid",
            parents={"ticketid": "ticket", "requesterid": "user", "assigneeid": "user", "groupid": "groups"},
        ),
    )
}


# --- JSON resources ---------------------------------------------------------------------------

CALENDAR = "struct<calendar:bigint,business:bigint>"
JSON_TYPES = {
    "long": "bigint",
    "string": "string",
    "boolean": "boolean",
    "time": "string",
    "calendar": CALENDAR,
    "fields": "array<struct<id:bigint,value:string>>",
    "map": "map<string,string>",
    "events": "array<struct<id:bigint,type:string,field_name:string,value:string,previous_value:string>>",
}


@dataclass(frozen=True)
class Resource:
    """A JSON record: which table it feeds, and ``(column, JSON name, kind)`` of its members.

    ``plural`` and ``singular`` are the envelope members a page may carry it under.
    ``embedded`` are nested members that are flattened into another table.
    """

    table: str
    plural: str | None
    singular: str | None
    members: tuple[tuple[str, str, str], ...]
    embedded: tuple[tuple[str, str, str], ...] = ()

    @property
    def names(self) -> list[str]:
        return [n for n in (self.plural, self.singular) if n]

    @property
    def ddl(self) -> str:
        every = self.members + self.embedded
        return ", ".join(f"`{json}` {JSON_TYPES[kind]}" for _, json, kind in every)


_TIMES = (("createdat", "created_at", "time"), ("updatedat", "updated_at", "time"))


def _longs(**names: str) -> tuple[tuple[str, str, str], ...]:
    return tuple((column, json, "long") for column, json in names.items())


def _strings(**names: str) -> tuple[tuple[str, str, str], ...]:
    return tuple((column, json, "string") for column, json in names.items())


def _moments(**names: str) -> tuple[tuple[str, str, str], ...]:
    return tuple((column, json, "time") for column, json in names.items())


def _definition(table: str, plural: str) -> Resource:
    return Resource(
        table, plural, None,
        _longs(id="id") + _strings(type="type", skey="key", title="title") + _TIMES,
    )


RESOURCES: dict[str, Resource] = {
    r.table: r
    for r in (
        _definition("ticketfields", "ticket_fields"),
        _definition("organizationfields", "organization_fields"),
        _definition("userfields", "user_fields"),
        Resource("groups", "groups", None, _longs(id="id") + _strings(name="name") + _TIMES),
        Resource(
            "organization", "organizations", "organization",
            _longs(id="id", groupid="group_id") + _strings(name="name") + _TIMES,
            (("organization_fields", "organization_fields", "map"),),
        ),
        Resource(
            "user", "users", "user",
            _longs(id="id", organizationid="organization_id", groupid="default_group_id")
            + _strings(externalid="external_id", email="email", name="name", role="role", timezone="time_zone")
            + _moments(lastloginat="last_login_at") + _TIMES + (("suspended", "suspended", "boolean"),),
            (("user_fields", "user_fields", "map"),),
        ),
        Resource(
            "ticket", "tickets", "ticket",
            _longs(id="id", requesterid="requester_id", submitterid="submitter_id", assigneeid="assignee_id",
                   organizationid="organization_id", groupid="group_id")
            + _strings(externalid="external_id", url="url", subject="subject", status="status",
                       recipient="recipient") + _TIMES,
            (("custom_fields", "custom_fields", "fields"),),
        ),
        Resource(
            "ticketmetric", None, "ticket_metric",
            _longs(id="id", ticketid="ticket_id", reopens="reopens", replies="replies")
            + _moments(solvedat="solved_at", assignedat="assigned_at",
                       initiallyassignedat="initially_assigned_at",
                       latestcommentaddedat="latest_comment_added_at",
                       assigneeupdatedat="assignee_updated_at", requesterupdatedat="requester_updated_at",
                       statusupdatedat="status_updated_at")
            + (("ttfr", "reply_time_in_minutes", "calendar"),
               ("ttr", "full_resolution_time_in_minutes", "calendar"),
               ("agentwaittime", "agent_wait_time_in_minutes", "calendar"),
               ("requesterwaittime", "requester_wait_time_in_minutes", "calendar")) + _TIMES,
        ),
        Resource(
            "audit", "audits", None,
            _longs(id="id", ticketid="ticket_id", authorid="author_id") + _moments(createdat="created_at"),
            (("events", "events", "events"),),
        ),
        Resource(
            "satisfactionrating", "satisfaction_ratings", None,
            _longs(id="id", assigneeid="assignee_id", groupid="group_id", requesterid="requester_id",
                   ticketid="ticket_id")
            + _strings(score="score", reason="comment") + _TIMES,
        ),
    )
}

# Envelope member -> base table, for all thirteen members a page may carry.
MEMBERS: dict[str, str] = {name: r.table for r in RESOURCES.values() for name in r.names}

# A landed page: one row per fetched response.
PAGE = T.StructType(
    [
        T.StructField("url", T.StringType()),
        T.StructField("status_code", T.IntegerType()),
        T.StructField("fetched_at", T.LongType()),
        T.StructField("body", T.StringType()),
    ]
)
