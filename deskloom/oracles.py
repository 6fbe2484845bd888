"""The same queries in plain SQL over the driver's tables, for an independent engine to run.

Written from the meaning of each operator, not from the Spark code: tables are built directly, with
no JSON pages in between, and wide views by one join per attribute.
"""

from __future__ import annotations

import re

# --- Fixed values, written out here and not taken from the code they check.
API_PATH = "/api/v2"
API = "https://desk.example.com/api/v2"
PAGE_ROWS = FULL_PAGE = 1000
ORPHAN = 999999999
CHANGED_SINCE = 820454400
RATED_SINCE = 1704153600
PRIORITY = "Case Priority"
COMPONENT = "Component"
CAUSE = "Root Cause"
VERSION = "Confluent/Kafka Version"
BUNDLE = "Support Bundle Used"
TIME_TOTAL = "Total time spent (sec)"
TIME_LAST = "Time spent last update (sec)"
TICKET_FIELDS = {101: PRIORITY, 102: COMPONENT, 103: CAUSE, 104: VERSION, 105: BUNDLE, 106: TIME_TOTAL, 107: TIME_LAST}
ORGANIZATION_FIELDS = {
    201: "technical_account_manager",
    202: "renewal_date",
    203: "primary_timezone",
    204: "subscription_type",
    205: "systems_engineer",
}
USER_FIELDS = {301: "home_region", 302: "tier"}
TICKET_ATTRIBUTES = {"priority": PRIORITY, "component": COMPONENT, "cause": CAUSE, "version": VERSION, "bundleused": BUNDLE}
ORGANIZATION_ATTRIBUTES = {
    "entitlement": "subscription_type",
    "renewaldate": "renewal_date",
    "se": "systems_engineer",
    "tam": "technical_account_manager",
    "timezone": "primary_timezone",
}
RECIPIENTS = {
    "escalations@example.com": "escalation",
    "se-support@example.com": "se-support",
    "support@example.com": "enterprise",
    "cloud-support@example.com": "cloud-professional",
    "support-escalations@desk.example.com": "escalation",
    "se-support@desk.example.com": "se-support",
    "support@desk.example.com": "enterprise",
    "cloud-support@desk.example.com": "cloud-professional",
}

RFC = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d+)?(Z|[+-]\d{2}:\d{2})$"


def _epoch(moment: str) -> str:
    return f"(epoch_us({moment}) // 1000000)"


def _fixed(fields: dict[int, str]) -> str:
    return ", ".join(f"({n}, 'text', '{name}', '{name}', 0, 0)" for n, name in fields.items())


def _definitions(fields: dict[int, str], source: str, key: str, title: str, first: int) -> str:
    return f"""
        SELECT id::BIGINT AS id, type, skey, title, createdat::BIGINT AS createdat, updatedat::BIGINT AS updatedat
        FROM (VALUES {_fixed(fields)}) v(id, type, skey, title, createdat, updatedat)
        UNION ALL
        SELECT {key} + {first}, 'text', '{source}_' || {key}, {title}, 725846400, 725846400 + {key} FROM {source}"""


def _branch(source: str, entity: str, number: int, title: str, value: str, where: str = "true") -> str:
    return (
        f"SELECT {entity} + 1 AS objectid, {number}::BIGINT AS id, '{title}' AS title, {value} AS value, "
        f"'' AS transformed FROM {source} WHERE {where}"
    )


# Building blocks, by name; one may use others.
BLOCKS: dict[str, str] = {
    "ticketfields_": _definitions(TICKET_FIELDS, "part", "p_partkey", "p_name", 1001),
    "organizationfields_": _definitions(ORGANIZATION_FIELDS, "supplier", "s_suppkey", "s_name", 1001),
    "userfields_": _definitions(USER_FIELDS, "supplier", "s_suppkey", "s_name", 2001),
    "groups_": """
        SELECT (n_nationkey + 1)::BIGINT AS id, n_name AS name, (-1)::BIGINT AS createdat, (-1)::BIGINT AS updatedat
        FROM nation UNION ALL SELECT 0, 'UNDEFINED', -1, -1""",
    "organization_records_": """
        SELECT c_custkey + 1 AS id, 'UNDEFINED' AS externalid, c_name AS name, 788918400 + c_custkey AS createdat,
            788918400 + 2 * c_custkey AS updatedat, (c_nationkey + 1)::BIGINT AS groupid FROM customer""",
    "organization_": """
        SELECT * FROM organization_records_ UNION ALL SELECT 0, 'UNDEFINED', 'UNDEFINED', -1, -1, 0""",
    "organizationdata_": " UNION ALL ".join(
        [
            _branch("customer", "c_custkey", 201, "technical_account_manager", "'tam-' || (c_custkey % 9)"),
            _branch("customer", "c_custkey", 202, "renewal_date", "'2025-0' || (c_custkey % 9 + 1) || '-01'"),
            _branch("customer", "c_custkey", 203, "primary_timezone", "CASE WHEN c_nationkey % 2 = 0 THEN 'UTC' ELSE 'EST' END"),
            _branch("customer", "c_custkey", 204, "subscription_type", "c_mktsegment"),
            _branch("customer", "c_custkey", 205, "systems_engineer", "'se-' || (c_custkey % 4)", "c_custkey % 10 <> 0"),
        ]
    ),
    "user_": """
        SELECT s_suppkey + 1 AS id, 'ext-' || s_suppkey AS externalid, 'agent' || s_suppkey || '@example.com' AS email,
            s_name AS name, 757382400 + s_suppkey AS createdat, 757382400 + 3 * s_suppkey AS updatedat,
            757382400 + 5 * s_suppkey AS lastloginat, 0::BIGINT AS organizationid,
            (s_nationkey + 1)::BIGINT AS groupid, 'agent' AS role, s_acctbal < 0 AS suspended, 'UTC' AS timezone
        FROM supplier
        UNION ALL SELECT 0, 'UNDEFINED', 'UNDEFINED', 'UNDEFINED', -1, -1, -1, 0, 0, 'UNDEFINED', true, 'UNDEFINED'""",
    "userdata_": " UNION ALL ".join(
        [
            _branch("supplier", "s_suppkey", 301, "home_region", "'region-' || (s_nationkey % 5)"),
            _branch("supplier", "s_suppkey", 302, "tier", "'tier-' || (s_suppkey % 3)"),
            _branch("supplier", "s_suppkey", 0, "legacy_code", "s_name"),
        ]
    ),
    "ticket_": f"""
        SELECT o_orderkey + 1 AS id, 'ext-' || o_custkey AS externalid,
            '{API}/tickets/' || (o_orderkey + 1) || '.json' AS url, 'Order ' || o_orderkey AS subject,
            CASE o_orderstatus WHEN 'F' THEN 'solved' WHEN 'O' THEN 'open' ELSE 'pending' END AS status,
            CASE WHEN o_orderkey % 89 = 3 THEN {ORPHAN} ELSE o_orderkey % 10 + 1 END::BIGINT AS requesterid,
            CASE WHEN o_orderkey % 83 = 5 THEN {ORPHAN} ELSE o_orderkey % 10 + 1 END::BIGINT AS submitterid,
            CASE WHEN o_orderkey % 97 = 0 THEN {ORPHAN} WHEN o_orderkey % 13 = 12 THEN 0
                ELSE o_orderkey % 10 + 1 END::BIGINT AS assigneeid,
            CASE o_orderpriority WHEN '1-URGENT' THEN 'escalations' WHEN '2-HIGH' THEN 'se-support'
                WHEN '3-MEDIUM' THEN 'support' WHEN '5-LOW' THEN 'cloud-support' ELSE 'other' END
                || '@example.com' AS recipient,
            o_custkey + 1 AS organizationid, CASE WHEN o_orderkey % 79 = 7 THEN {ORPHAN} ELSE 0 END::BIGINT AS groupid,
            {_epoch("o_orderdate")} AS createdat,
            {_epoch("o_orderdate")} + 3600 * (o_orderkey % 48) AS updatedat
        FROM orders""",
    "ticketdata_": " UNION ALL ".join(
        [
            _branch("orders", "o_orderkey", 101, PRIORITY, "o_orderpriority"),
            _branch("orders", "o_orderkey", 102, COMPONENT, "'component-' || (o_orderkey % 7)", "o_orderkey % 11 <> 0"),
            _branch("orders", "o_orderkey", 103, CAUSE, "'cause-' || (o_orderkey % 5)"),
            _branch("orders", "o_orderkey", 104, VERSION, "'v' || (o_orderkey % 4)"),
            _branch("orders", "o_orderkey", 105, BUNDLE, "CASE WHEN o_orderkey % 3 = 0 THEN 'true' ELSE 'false' END"),
        ]
    ),
    "raw_event_": f"""
        SELECT CASE WHEN event_id % 6 = 0 THEN 2 * event_id + 2 ELSE 2 * event_id + 1 END AS id, event_id + 1 AS auditid,
            user_id + 1 AS ticketid, {_epoch("ts")} AS createdat,
            user_id % 10 + 1 AS authorid, CASE event_type WHEN 'view' THEN 'Create' ELSE 'Change' END AS type,
            CASE event_type WHEN 'purchase' THEN '106' WHEN 'click' THEN '101' WHEN 'view' THEN '101'
                WHEN 'signup' THEN '107' ELSE 'status' END AS fieldname,
            CASE WHEN event_type IN ('purchase', 'signup')
                THEN (60 * json_extract_string(props, '$.k')::BIGINT)::VARCHAR ELSE 'P' || (event_id % 5) END AS value,
            CASE WHEN event_id % 4 = 0 THEN '' WHEN event_type IN ('purchase', 'signup') THEN '0'
                ELSE 'P' || (event_id % 4) END AS pvalue
        FROM events
        UNION ALL
        SELECT CASE WHEN event_id % 6 = 0 THEN 2 * event_id + 1 ELSE 2 * event_id + 2 END, event_id + 1, user_id + 1, {_epoch("ts")},
            user_id % 10 + 1, CASE WHEN event_id % 5 = 0 THEN 'Comment' ELSE 'Change' END,
            CASE WHEN event_id % 2 = 0 THEN '101' ELSE '106' END,
            CASE WHEN event_id % 2 = 0 THEN 'Q' || (event_id % 7) ELSE (60 * (event_id % 1000))::VARCHAR END, 'Q' || (event_id % 3)
        FROM events WHERE event_id % 3 = 0""",
    "changeevent_": """
        SELECT r.id, r.auditid, r.type, r.fieldname, r.value, r.pvalue FROM raw_event_ r
        JOIN ticketfields_ f ON TRY_CAST(r.fieldname AS BIGINT) = f.id
        WHERE r.type = 'Change'
            AND f.title IN ('%s')""" % "', '".join([TIME_TOTAL, PRIORITY, TIME_LAST]),
    "audit_": """
        SELECT DISTINCT auditid AS id, ticketid, createdat, authorid FROM raw_event_
        WHERE auditid IN (SELECT auditid FROM changeevent_)""",
    "ticketmetric_": f"""
        SELECT l_orderkey + 1 AS id, l_orderkey + 1 AS ticketid, {_epoch("min(l_shipdate)")} AS createdat,
            {_epoch("max(l_shipdate)")} AS updatedat, {_epoch("max(l_shipdate)")} AS solvedat,
            0::BIGINT AS assignedat, 0::BIGINT AS initiallyassignedat, 0::BIGINT AS latestcommentaddedat,
            0::BIGINT AS assigneeupdatedat, 0::BIGINT AS requesterupdatedat, 0::BIGINT AS statusupdatedat,
            (30 * max(l_linenumber))::BIGINT AS agentwaittime, (45 * max(l_linenumber))::BIGINT AS requesterwaittime,
            (count(*) FILTER (l_returnflag = 'R'))::BIGINT AS reopens, count(*)::BIGINT AS replies,
            (60 * min(l_linenumber))::BIGINT AS ttfr, (1440 * max(l_linenumber))::BIGINT AS ttr
        FROM lineitem GROUP BY l_orderkey""",
    "satisfactionrating_": """
        SELECT doc_id + 1 AS id, doc_id % 10 + 1 AS assigneeid, 0::BIGINT AS groupid, doc_id % 10 + 1 AS requesterid,
            doc_id + 1 AS ticketid, CASE quality WHEN 1 THEN 'good' ELSE 'bad' END AS score,
            1704067200 + 3600 * doc_id AS createdat, 1704067200 + 3600 * doc_id AS updatedat,
            CASE toxic WHEN 1 THEN 'flagged' ELSE '' END AS reason
        FROM labels""",
    "accepted_ticket_": """
        SELECT * FROM ticket_ WHERE assigneeid IN (SELECT id FROM user_) AND requesterid IN (SELECT id FROM user_)
            AND submitterid IN (SELECT id FROM user_) AND organizationid IN (SELECT id FROM organization_)
            AND groupid IN (SELECT id FROM groups_)""",
    "accepted_audit_": """
        SELECT * FROM audit_ WHERE ticketid IN (SELECT id FROM accepted_ticket_) AND authorid IN (SELECT id FROM user_)""",
    "per_ticket_time_": f"""
        SELECT a.ticketid, max(TRY_CAST(e.value AS BIGINT)) AS value FROM changeevent_ e
        JOIN audit_ a ON a.id = e.auditid JOIN ticketfields_ f ON f.id = TRY_CAST(e.fieldname AS BIGINT)
        WHERE f.title = '{TIME_TOTAL}' GROUP BY a.ticketid""",
    "per_ticket_time_all_": """
        SELECT a.ticketid, max(TRY_CAST(e.value AS BIGINT)) AS value FROM changeevent_ e
        JOIN audit_ a ON a.id = e.auditid GROUP BY a.ticketid""",
    "first_change_": f"""
        SELECT a.ticketid, min(e.id) AS firstchanged FROM changeevent_ e
        JOIN audit_ a ON a.id = e.auditid JOIN ticketfields_ f ON f.id = TRY_CAST(e.fieldname AS BIGINT)
        WHERE f.title = '{PRIORITY}' AND e.pvalue <> '' GROUP BY a.ticketid""",
    "initial_priority_": """
        SELECT c.ticketid, e.pvalue AS initialpriority FROM first_change_ c JOIN changeevent_ e ON e.id = c.firstchanged""",
    "number_text_": """
        SELECT event_id, CASE event_type WHEN 'purchase' THEN json_extract_string(props, '$.k')
            WHEN 'signup' THEN json_extract_string(props, '$.k') || 'abc'
            WHEN 'click' THEN 'x' || json_extract_string(props, '$.k') WHEN 'view' THEN '' END AS value
        FROM events""",
}


def _needs(sql: str) -> list[str]:
    return [name for name in BLOCKS if re.search(rf"\b{name}\b", sql)]


def build(select: str) -> str:
    """Prefix a query with the building blocks it names, directly or through others."""
    wanted: set[str] = set()
    pending = _needs(select)
    while pending:
        name = pending.pop()
        if name not in wanted:
            wanted.add(name)
            pending += [n for n in _needs(BLOCKS[name]) if n != name]
    ordered: list[str] = []

    def place(name: str) -> None:
        for other in _needs(BLOCKS[name]):
            if other != name and other not in ordered:
                place(other)
        if name not in ordered:
            ordered.append(name)

    for name in BLOCKS:
        if name in wanted:
            place(name)
    blocks = ", ".join(f"{name} AS ({BLOCKS[name]})" for name in ordered)
    return f"WITH {blocks} {select}" if blocks else select


def _attribute(block: str, title: str, entity: str, name: str) -> str:
    return f"SELECT objectid AS {entity}, value AS {name} FROM {block} WHERE title = '{title}'"


def _attribute_joins(block: str, attributes: dict[str, str], key: str) -> str:
    return " ".join(
        f"JOIN {block} a{i} ON a{i}.objectid = {key} AND a{i}.title = '{title}'"
        for i, title in enumerate(attributes.values())
    )


def _attribute_columns(attributes: dict[str, str]) -> str:
    return ", ".join(f"a{i}.value AS {name}" for i, name in enumerate(attributes))


def _moment(seconds: str) -> str:
    return f"make_timestamp(({seconds}) * 1000000)"


def _type(recipient: str) -> str:
    cases = " ".join(f"WHEN '{address}' THEN '{kind}'" for address, kind in RECIPIENTS.items())
    return f"CASE {recipient} {cases} ELSE 'enterprise' END"


_T = TICKET_ATTRIBUTES
_METRICS = f"m.ttfr, m.ttr, {_moment('m.solvedat')} AS solved, m.agentwaittime, m.requesterwaittime"
_TICKET_JOINS = f"""
    FROM ticket_ t JOIN organization_ o ON o.id = t.organizationid
    {_attribute_joins("ticketdata_", _T, "t.id")}
    LEFT JOIN ticketmetric_ m ON m.ticketid = t.id"""
_ASSIGNED = "WHERE t.assigneeid IN (SELECT id FROM user_)"
TICKET_VIEW = f"""
    SELECT t.id, o.name AS organization, {_moment("t.createdat")} AS created, {_moment("t.updatedat")} AS updated,
        {_type("t.recipient")} AS type, t.status, t.subject, {_attribute_columns(_T)},
        coalesce(p.initialpriority, a0.value) AS initialpriority, s.value AS tickettime, {_METRICS}
    {_TICKET_JOINS} LEFT JOIN initial_priority_ p ON p.ticketid = t.id LEFT JOIN per_ticket_time_ s ON s.ticketid = t.id
    {_ASSIGNED} ORDER BY 1"""
TICKET_VIEW_BASIC = f"""
    SELECT t.id, o.name AS organization, {_moment("t.createdat")} AS created, {_moment("t.updatedat")} AS updated,
        t.status, t.subject, {_attribute_columns(_T)}, s.value AS tickettime, {_METRICS}
    {_TICKET_JOINS} LEFT JOIN per_ticket_time_all_ s ON s.ticketid = t.id
    {_ASSIGNED} ORDER BY 1"""
# The wide joins carry an order: without one, a LIMIT around them sends the engine into a plan that does not end.
# The same view over a load that keeps accepted tickets and their children only.
LOADED_TICKET_VIEW = TICKET_VIEW.replace("ticket_ t", "accepted_ticket_ t")

_LINE_COLUMNS = "l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus"
_LINE_ORDER = ", ".join(f"{c} DESC" for c in _LINE_COLUMNS.split(", "))

_OPTION = r"regexp_extract(path, '^(.*)/[^/]*$', 1)"


def _orphans(column: str, block: str) -> str:
    return (
        f"SELECT id, '{column}' AS reference, {column} AS parentid FROM ticket_ "
        f"WHERE {column} IS NOT NULL AND {column} NOT IN (SELECT id FROM {block})"
    )


_TICKET_ORPHANS = " UNION ALL ".join(
    _orphans(c, b)
    for c, b in (("requesterid", "user_"), ("submitterid", "user_"), ("assigneeid", "user_"),
                 ("organizationid", "organization_"), ("groupid", "groups_"))
)
_OFFSETS = " UNION ALL ".join(
    f"SELECT '{t}' AS sequencename, greatest(coalesce(max(updatedat), 0), 0)::BIGINT AS lastval FROM {t}_"
    for t in ("organization", "user", "ticket", "satisfactionrating")
)
_LISTINGS = """FROM (VALUES ('ticketfields', 'ticket_fields.json', false), ('organizationfields', 'organization_fields.json', false),
            ('userfields', 'user_fields.json', false), ('groups', 'groups.json', false),
            ('organization', 'incremental/organizations.json', true), ('user', 'incremental/users.json', true),
            ('ticket', 'incremental/tickets.json', true), ('satisfactionrating', 'satisfaction_ratings.json', true))
            l(resource, path, timed)"""
_TICKET = ("id, externalid, url, subject, status, requesterid, submitterid, assigneeid, recipient, organizationid, "
           "groupid, createdat, updatedat")


def _decoded_groups(name: str) -> str:
    return f"""SELECT id, {name} AS name, 0::BIGINT AS createdat, 0::BIGINT AS updatedat FROM groups_ WHERE id > 0
        UNION ALL SELECT 0, 'UNDEFINED', -1, -1"""

_PIVOT = f"SELECT t.id AS ticketid, {_attribute_columns(_T)} FROM ticket_ t {_attribute_joins('ticketdata_', _T, 't.id')} ORDER BY 1"


ORACLES: dict[str, str] = {
    # --- sources
    "page_envelope": f"""
        SELECT '{API}/incremental/tickets.json?start_time=' || (id // {PAGE_ROWS}) AS url, 'tickets' AS resource,
            count(*)::BIGINT AS announced, count(*)::BIGINT AS records FROM ticket_ GROUP BY id // {PAGE_ROWS}
        UNION ALL
        SELECT '{API}/incremental/organizations.json?start_time=' || (id // {PAGE_ROWS}), 'organizations', count(*),
            count(*) FROM organization_records_ GROUP BY id // {PAGE_ROWS}
        UNION ALL
        SELECT '{API}/tickets/' || ticketid || '/metrics.json', 'ticket_metric', 0, 1 FROM ticketmetric_""",
    "decode_ticket": "SELECT * FROM ticket_",
    "decode_audit": """
        SELECT auditid AS id, ticketid, createdat, authorid, count(*)::BIGINT AS events FROM raw_event_ GROUP BY ALL""",
    "decode_metric": "SELECT * FROM ticketmetric_",
    "decode_quarantine": """
        SELECT event_id AS fetched_at, CASE event_type WHEN 'signup' THEN 'unreadable' WHEN 'error' THEN 'bad_time'
            ELSE 'none' END AS problem FROM events""",
    "snapshot_groups": _decoded_groups("upper('new ' || name)"),
    "incremental_tickets": f"SELECT id, status, updatedat FROM ticket_ WHERE updatedat >= {CHANGED_SINCE}",
    "incremental_csat": f"SELECT * FROM satisfactionrating_ WHERE updatedat >= {RATED_SINCE}",
    "child_refresh_audits": f"""
        SELECT DISTINCT auditid AS id, ticketid, createdat, authorid FROM raw_event_
        WHERE ticketid IN (SELECT id FROM ticket_ WHERE updatedat >= {CHANGED_SINCE})""",
    "child_refresh_metrics": f"""
        SELECT * FROM ticketmetric_ WHERE ticketid IN (SELECT id FROM ticket_ WHERE updatedat >= {CHANGED_SINCE})""",
    "page_chain_gaps": f"""
        SELECT '{API}/incremental/tickets.json?start_time=' || n AS url,
            '{API}/incremental/tickets.json?start_time=' || (n + 1) AS next_page
        FROM (SELECT id // {PAGE_ROWS} AS n, count(*) AS c FROM ticket_ GROUP BY 1)
        WHERE c >= {FULL_PAGE} AND n % 7 <> 3
            AND ((n + 1) % 7 = 3 OR n + 1 NOT IN (SELECT id // {PAGE_ROWS} FROM ticket_))
        UNION ALL
        SELECT DISTINCT '{API}/tickets.json?page=' || l_orderkey, '{API}/tickets.json?page=' || (l_orderkey + 1)
        FROM lineitem WHERE l_orderkey + 1 IN (SELECT o_orderkey FROM orders)
            AND l_orderkey % 11 <> 5
            AND ((l_orderkey + 1) % 11 = 5 OR l_orderkey + 1 NOT IN (SELECT l_orderkey FROM lineitem))""",
    "page_chain_reach": f"""
        WITH RECURSIVE landed AS (SELECT DISTINCT l_orderkey AS k FROM lineitem WHERE l_orderkey % 11 <> 5),
        link AS (SELECT a.k, b.k AS n FROM landed a JOIN landed b ON b.k = CASE WHEN a.k % 50 = 49 THEN a.k - 7 ELSE a.k + 1 END),
        walk AS (SELECT k AS origin, n FROM link UNION SELECT w.origin, l.n FROM walk w JOIN link l ON l.k = w.n),
        reached AS (SELECT k FROM landed WHERE k % 25 = 0 UNION SELECT n FROM walk WHERE origin % 25 = 0)
        SELECT '{API}/tickets.json?page=' || k AS url, k IN (SELECT k FROM reached) AS reached,
            k IN (SELECT origin FROM walk WHERE origin = n) AS cyclic
        FROM landed WHERE k NOT IN (SELECT k FROM reached) OR k IN (SELECT origin FROM walk WHERE origin = n)""",
    "page_count_check": f"""
        SELECT '{API}/tickets.json?page=' || l_orderkey AS url, 'tickets' AS resource, count(*)::BIGINT AS announced,
            count(DISTINCT l_linenumber)::BIGINT AS actual
        FROM lineitem GROUP BY l_orderkey HAVING count(*) <> count(DISTINCT l_linenumber)""",
    "fetch_triage": """
        SELECT CASE page_id % 10 WHEN 0 THEN 'retry' WHEN 1 THEN 'skip' WHEN 2 THEN 'error' ELSE 'load' END AS route,
            count(*)::BIGINT AS pages FROM pages GROUP BY 1""",
    "retry_worklist": "SELECT url, count(*)::BIGINT AS fetches FROM pages WHERE page_id % 10 = 0 AND page_id % 3 <> 0 GROUP BY url",
    "url_classify": f"""
        SELECT page_id, url, CASE WHEN starts_with({_OPTION}, '{API_PATH}')
                THEN substr({_OPTION}, {len(API_PATH) + 1}) ELSE {_OPTION} END AS option,
            regexp_extract(path, '(/[^/]*)$', 1) AS resource, {_OPTION} = '{API_PATH}/incremental' AS incremental
        FROM (SELECT page_id, url, CASE WHEN p = '' THEN '/' ELSE p END AS path
            FROM (SELECT page_id, url, regexp_replace(split_part(split_part(url, '#', 1), '?', 1), '^[a-z]+://[^/]*', '') AS p
                FROM pages))""",
    "fetch_worklist": f"""
        SELECT id, kind, '{API}/tickets/' || id || '/' || kind || '.json' AS url
        FROM ticket_, (VALUES ('audits'), ('metrics')) k(kind) WHERE updatedat >= {CHANGED_SINCE}""",
    "listing_worklist": f"""
        SELECT l.resource, '{API}/' || l.path || CASE WHEN l.timed THEN '?start_time=' || coalesce(s.lastval, 0) ELSE '' END AS url
        {_LISTINGS}
        LEFT JOIN ({_OFFSETS}) s ON s.sequencename = l.resource""",
    # --- row transformations and filters
    "hook_chain": """
        SELECT id, upper(status) AS status, upper(status) || ' ' || subject AS subject FROM ticket_ WHERE status <> 'pending'""",
    "dim_ticketfields": "SELECT id, title FROM ticketfields_",
    "dim_orgfields": "SELECT skey, id FROM organizationfields_",
    "dim_userfields": "SELECT skey, id FROM userfields_",
    "flatten_ticketdata": "SELECT * FROM ticketdata_",
    "flatten_orgdata": "SELECT * FROM organizationdata_",
    "flatten_userdata": "SELECT * FROM userdata_",
    "change_events": "SELECT * FROM changeevent_",
    "audits_kept": "SELECT * FROM audit_",
    "changed_tickets": "SELECT DISTINCT id FROM ticket_",
    "accumulate_children": """
        SELECT 'audit' AS child, id, ticketid FROM audit_ UNION ALL SELECT 'ticketmetric', id, ticketid FROM ticketmetric_
        UNION ALL SELECT 'satisfactionrating', id, ticketid FROM satisfactionrating_""",
    "dim_lookup_default": """
        SELECT r.id, TRY_CAST(r.fieldname AS BIGINT) AS fieldid, coalesce(f.title, '') AS title
        FROM raw_event_ r LEFT JOIN ticketfields_ f ON f.id = TRY_CAST(r.fieldname AS BIGINT)""",
    "filter_title_exact": f"""
        SELECT objectid, title, value FROM ticketdata_ WHERE title = '{CAUSE}' AND objectid % 2 = 0""",
    "filter_title_ci": f"""
        SELECT objectid, shown AS title, value FROM (
            SELECT objectid, value, CASE WHEN objectid % 2 = 0 THEN title ELSE upper(title) || '  ' END AS shown FROM ticketdata_)
        WHERE rtrim(shown) COLLATE NOCASE.NOACCENT = '{CAUSE}'""",
    "filter_nonempty": "SELECT id, pvalue FROM raw_event_ WHERE pvalue IS NOT NULL AND length(pvalue) > 0",
    # --- joins
    "join_ticket_audit_event": """
        SELECT t.id AS ticketid, t.subject, a.id AS auditid, e.id AS eventid, e.value
        FROM ticket_ t JOIN audit_ a ON a.ticketid = t.id JOIN changeevent_ e ON e.auditid = a.id""",
    "join_numeric_text": """
        SELECT r.id, f.id AS fieldid, f.title AS fieldtitle FROM raw_event_ r
        JOIN ticketfields_ f ON f.id::VARCHAR = r.fieldname""",
    "semi_assignee_exists": "SELECT id, assigneeid FROM ticket_ WHERE assigneeid IN (SELECT id FROM user_)",
    "fk_orphans": _TICKET_ORPHANS,
    "audit_holes": "SELECT id FROM ticket_ WHERE id NOT IN (SELECT ticketid FROM raw_event_)",
    # --- aggregates
    "fetch_offset": 'SELECT greatest(coalesce(max(updatedat), 0), 0)::BIGINT AS "offset" FROM ticket_',
    "time_spent": "SELECT ticketid AS id, value FROM per_ticket_time_ WHERE ticketid IN (SELECT id FROM ticket_)",
    "time_spent_all_fields": "SELECT ticketid AS id, value FROM per_ticket_time_all_ WHERE ticketid IN (SELECT id FROM ticket_)",
    "first_change_id": "SELECT * FROM first_change_",
    "eav_pivot": _PIVOT,
    "eav_pivot_one_pass": _PIVOT,
    "eav_pivot_unique": _PIVOT,
    # --- scalars
    "to_epoch": f"""
        SELECT event_id, CASE event_type WHEN 'purchase' THEN {_epoch("ts")} WHEN 'signup' THEN {_epoch("ts")} ELSE 0 END::BIGINT
            AS epoch, event_type = 'error' AS bad FROM events""",
    "calendar_minutes": "SELECT id, ttfr, ttr, agentwaittime, requesterwaittime FROM ticketmetric_",
    "from_epoch": f"""
        SELECT c_custkey, CASE WHEN e >= 0 THEN {_moment("e")} END AS moment
        FROM (SELECT c_custkey, floor(c_acctbal * 1000)::BIGINT AS e FROM customer)""",
    "from_epoch_signed": f"""
        SELECT c_custkey, {_moment("e")} AS moment FROM (SELECT c_custkey, floor(c_acctbal * 1000)::BIGINT AS e FROM customer)""",
    "convert_tz": f"SELECT id, {_moment('updatedat - 18000')} AS updated FROM ticket_",
    "cast_unsigned_strict": "SELECT event_id, TRY_CAST(value AS BIGINT) AS number FROM number_text_",
    "cast_unsigned_lenient": r"""
        SELECT event_id, CASE WHEN value IS NOT NULL
            THEN coalesce(TRY_CAST(regexp_extract(value, '^\s*(\d+)', 1) AS DECIMAL(20, 0)), 0) END::DECIMAL(20, 0) AS number
        FROM number_text_""",
    "parse_int_default": "SELECT event_id, coalesce(TRY_CAST(value AS BIGINT), 0) AS number FROM number_text_",
    "ticket_type": f"SELECT id, {_type('recipient')} AS type FROM ticket_",
    "json_value_text": """
        SELECT event_id, CASE event_type WHEN 'purchase' THEN event_id::VARCHAR WHEN 'signup' THEN 'true'
            WHEN 'click' THEN '[' || event_id || ',' || event_id || ']' WHEN 'view' THEN 'v' || event_id END AS value
        FROM events""",
    "apply_defaults": """
        SELECT t.id AS ticket, coalesce(m.createdat, -1) AS createdat, coalesce(m.solvedat, -1) AS solvedat,
            coalesce(m.agentwaittime, -1) AS agentwaittime, coalesce(m.replies, 0) AS replies, coalesce(m.ttfr, 0) AS ttfr,
            coalesce(m.ttr, 0) AS ttr FROM ticket_ t LEFT JOIN ticketmetric_ m ON m.ticketid = t.id""",
    "with_seed_rows": "SELECT * FROM user_",
    # --- sinks and quality
    "upsert_latest": f"""
        SELECT * EXCLUDE (rank) FROM (
            SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                ORDER BY l_shipdate DESC, l_linestatus <> 'F' DESC, {_LINE_ORDER}) AS rank FROM lineitem)
        WHERE rank = 1""",
    "late_arrival_upsert": """
        SELECT t.id, CASE WHEN m.solvedat - 3888000 >= t.updatedat THEN 'closed' ELSE t.status END AS status,
            greatest(t.updatedat, coalesce(m.solvedat - 3888000, t.updatedat)) AS updatedat
        FROM ticket_ t LEFT JOIN ticketmetric_ m ON m.ticketid = t.id""",
    "align_to_table": "SELECT * FROM organization_records_",
    "upsert_keep_target_cols": """
        SELECT id, CASE WHEN groupid > 5 THEN 'ext-' || id ELSE 'UNDEFINED' END AS externalid, upper(name) AS name,
            createdat, updatedat, groupid FROM organization_records_""",
    "quarantine_split": """
        SELECT id, CASE WHEN id IN (SELECT id FROM accepted_ticket_) THEN 'accepted' ELSE 'quarantine' END AS route,
            concat_ws(',', CASE WHEN requesterid NOT IN (SELECT id FROM user_) THEN 'requesterid:no_parent' END,
                CASE WHEN submitterid NOT IN (SELECT id FROM user_) THEN 'submitterid:no_parent' END,
                CASE WHEN assigneeid NOT IN (SELECT id FROM user_) THEN 'assigneeid:no_parent' END,
                CASE WHEN organizationid NOT IN (SELECT id FROM organization_) THEN 'organizationid:no_parent' END,
                CASE WHEN groupid NOT IN (SELECT id FROM groups_) THEN 'groupid:no_parent' END) AS reason FROM ticket_""",
    "load_report": """
        SELECT 'ticket' AS "table", count(*)::BIGINT AS read,
            (SELECT count(*) FROM accepted_ticket_)::BIGINT AS accepted,
            (count(*) - (SELECT count(*) FROM accepted_ticket_))::BIGINT AS quarantined FROM ticket_
        UNION ALL SELECT 'organization', count(*), count(*), 0 FROM organization_""",
    "offset_table": _OFFSETS,
    "pk_duplicates": """
        SELECT l_orderkey, l_linenumber, count(*)::BIGINT AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""",
    "not_null_violations": """
        SELECT t.id AS ticket, r.reason FROM ticket_ t, (VALUES ('ticketid:null'), ('solvedat:null')) r(reason)
        WHERE t.id NOT IN (SELECT ticketid FROM ticketmetric_)""",
    "length_violations": """
        SELECT doc_id, 'text:length>1024' AS reason FROM documents WHERE length(text) > 1024
        UNION ALL SELECT doc_id, 'source:length>10' FROM documents WHERE length(source) > 10""",
    "unsigned_violations": """
        SELECT c_custkey, 'balance:negative' AS reason FROM customer WHERE c_acctbal < 0
        UNION ALL SELECT c_custkey, 'nation:negative' FROM customer WHERE c_nationkey < 0""",
    # --- base table loads
    "load_groups": _decoded_groups("name"),
    "load_organization": "SELECT * FROM organization_",
    "load_organizationdata": "SELECT * FROM organizationdata_",
    "load_user": "SELECT * FROM user_",
    "load_userdata": "SELECT * FROM userdata_",
    "load_ticketfields": "SELECT * FROM ticketfields_",
    "load_organizationfields": "SELECT * FROM organizationfields_",
    "load_userfields": "SELECT * FROM userfields_",
    "load_ticket": "SELECT * FROM accepted_ticket_",
    "load_ticketdata": "SELECT * FROM ticketdata_ WHERE objectid IN (SELECT id FROM accepted_ticket_)",
    "load_audit": "SELECT * FROM accepted_audit_",
    "load_changeevent": "SELECT * FROM changeevent_ WHERE auditid IN (SELECT id FROM accepted_audit_)",
    "load_ticketmetric": "SELECT * FROM ticketmetric_",
    "load_satisfactionrating": "SELECT * FROM satisfactionrating_ WHERE ticketid IN (SELECT id FROM accepted_ticket_)",
    "incremental_sync": f"""
        SELECT l.resource, '{API}/' || l.path || CASE WHEN l.timed THEN '?start_time=' || coalesce(s.lastval, 0) ELSE '' END AS url,
            CASE l.resource WHEN 'ticket' THEN (SELECT count(*) FROM ticket_ WHERE id // {PAGE_ROWS} % 2 = 1) ELSE 0 END::BIGINT AS read
        {_LISTINGS}
        LEFT JOIN (SELECT 'organization' AS name, max(updatedat) AS lastval FROM organization_
            UNION ALL SELECT 'user', max(updatedat) FROM user_ UNION ALL SELECT 'ticket', max(updatedat) FROM accepted_ticket_) s
            ON s.name = l.resource""",
    "load_renamed_field": """
        SELECT d.* REPLACE (CASE WHEN d.id = 101 AND t.recipient = 'support@example.com' THEN 'Case Prio' ELSE d.title END AS title)
        FROM ticketdata_ d JOIN accepted_ticket_ t ON t.id = d.objectid""",
    "dead_letters": """
        SELECT '' AS resource, url AS key, 'status_500' AS reason FROM pages WHERE page_id % 10 = 2
        UNION ALL
        SELECT 'organization', id::VARCHAR, 'groupid:no_parent' FROM organization_records_ WHERE id % 10 IN (3, 4)""",
    # --- views
    "ticket_time": "SELECT ticketid, value AS tickettime FROM per_ticket_time_ WHERE ticketid IN (SELECT id FROM ticket_)",
    "ticket_initial_priority": "SELECT * FROM initial_priority_",
    "ticket_priority": _attribute("ticketdata_", PRIORITY, "ticketid", "priority"),
    "ticket_component": _attribute("ticketdata_", COMPONENT, "ticketid", "component"),
    "ticket_cause": _attribute("ticketdata_", CAUSE, "ticketid", "cause"),
    "ticket_version": _attribute("ticketdata_", VERSION, "ticketid", "version"),
    "bundle_usage": _attribute("ticketdata_", BUNDLE, "ticketid", "bundleused"),
    "ticket_view": TICKET_VIEW,
    "ticket_view_sorted": TICKET_VIEW,
    "ticket_view_basic": TICKET_VIEW_BASIC,
    "organization_tam": _attribute("organizationdata_", "technical_account_manager", "organizationid", "tam"),
    "organization_renewal": _attribute("organizationdata_", "renewal_date", "organizationid", "renewaldate"),
    "organization_tz": _attribute("organizationdata_", "primary_timezone", "organizationid", "timezone"),
    "organization_entitlement": _attribute("organizationdata_", "subscription_type", "organizationid", "entitlement"),
    "organization_se": _attribute("organizationdata_", "systems_engineer", "organizationid", "se"),
    "organization_view": f"""
        SELECT o.*, {_attribute_columns(ORGANIZATION_ATTRIBUTES)} FROM organization_ o
        {_attribute_joins("organizationdata_", ORGANIZATION_ATTRIBUTES, "o.id")}""",
    "user_view": f"""
        SELECT type, priority, count(*)::BIGINT AS tickets, count(tickettime)::BIGINT AS timed, max(ttr)::BIGINT AS longest
        FROM ({TICKET_VIEW.replace("ORDER BY 1", "")}) WHERE status <> 'solved' GROUP BY type, priority""",
    # --- streaming
    "stream_decode": "SELECT * FROM ticket_",
    "stream_upsert": f"""
        SELECT * REPLACE (CASE WHEN recipient = 'support@example.com' THEN 'closed' ELSE status END AS status,
            CASE WHEN recipient = 'support@example.com' THEN updatedat + 7200 ELSE updatedat END AS updatedat) FROM accepted_ticket_""",
    "stream_child_refresh": f"""
        SELECT * FROM accepted_audit_ WHERE ticketid IN (SELECT id FROM ticket_ WHERE updatedat >= {CHANGED_SINCE})""",
    "late_children": f"""
        SELECT * FROM accepted_audit_ WHERE ticketid IN (SELECT id FROM ticket_ WHERE updatedat >= {CHANGED_SINCE})""",
    "load_order": """
        SELECT position::INTEGER AS position, name AS "table", rows::BIGINT AS rows FROM (
            SELECT 1 AS position, 'ticketfields' AS name, count(*) AS rows FROM ticketfields_
            UNION ALL SELECT 2, 'organizationfields', count(*) FROM organizationfields_
            UNION ALL SELECT 3, 'userfields', count(*) FROM userfields_
            UNION ALL SELECT 4, 'groups', count(*) FROM groups_
            UNION ALL SELECT 5, 'organization', count(*) FROM organization_
            UNION ALL SELECT 6, 'organizationdata', count(*) FROM organizationdata_
            UNION ALL SELECT 7, 'user', count(*) FROM user_
            UNION ALL SELECT 8, 'userdata', count(*) FROM userdata_
            UNION ALL SELECT 9, 'ticket', count(*) FROM accepted_ticket_
            UNION ALL SELECT 10, 'ticketdata', count(*) FROM ticketdata_ WHERE objectid IN (SELECT id FROM accepted_ticket_)
            UNION ALL SELECT 11, 'satisfactionrating', count(*) FROM satisfactionrating_
                WHERE ticketid IN (SELECT id FROM accepted_ticket_)
            UNION ALL SELECT 12, 'audit', count(*) FROM accepted_audit_
            UNION ALL SELECT 13, 'changeevent', count(*) FROM changeevent_ WHERE auditid IN (SELECT id FROM accepted_audit_)
            UNION ALL SELECT 14, 'ticketmetric', count(*) FROM ticketmetric_)""",
    "stream_load": LOADED_TICKET_VIEW,
}


def oracle_sql() -> dict[str, str]:
    return {name: build(select) for name, select in ORACLES.items()}
