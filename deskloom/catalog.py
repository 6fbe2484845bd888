"""Every operator as a named query over one folder of driver tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from deskloom import settings as S
from deskloom.functions import scalars
from deskloom.operators import eav, flatten, quality, upsert
from deskloom.operators.hooks import Hooks
from deskloom.plans import views
from deskloom.plans.sync import LOAD_ORDER, run_sync, stored_rows
from deskloom.rows import with_seed
from deskloom.sample import HOST, PAGE_ROWS, Desk, epoch, to_pages
from deskloom.schema import TABLES
from deskloom.session import LANDED, configure, run_folder, scale_to
from deskloom.sinks import warehouse
from deskloom.sinks.warehouse import Warehouse, offsets
from deskloom.sources import pages
from deskloom.streaming.follow import decode_stream, follow, follow_children, follow_table

CHANGED_SINCE = 820454400  # 1996-01-01
RATED_SINCE = 1704153600  # 2024-01-02
RENAMED = "Case Prio"

Query = Callable[[Desk], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(fn: Query) -> Callable[[SparkSession, str], DataFrame]:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            scale_to(configure(spark), sf_dir)
            return fn(Desk(spark, sf_dir))

        return run

    return {name: bind(fn) for name, fn in QUERIES.items()}


def _decoded(desk: Desk, table: str) -> DataFrame:
    return pages.good(pages.decode(desk.pages(table), table))


def _rows(desk: Desk, table: str) -> DataFrame:
    """Decoded records as rows of their table."""
    return upsert.align(_decoded(desk, table), TABLES[table])


# --- sources ----------------------------------------------------------------------------------


@query
def page_envelope(desk: Desk) -> DataFrame:
    every = desk.pages("ticket").unionByName(desk.pages("organization")).unionByName(desk.pages("ticketmetric"))
    listed = F.size(pages.payload_records(F.col("payload"))).cast("bigint")
    return pages.scan_envelope(every).select("url", "resource", F.col("count").alias("announced"), listed.alias("records"))


@query
def decode_ticket(desk: Desk) -> DataFrame:
    return _rows(desk, "ticket")


@query
def decode_audit(desk: Desk) -> DataFrame:
    return _decoded(desk, "audit").select("id", "ticketid", "createdat", "authorid", F.size("events").cast("bigint").alias("events"))


@query
def decode_metric(desk: Desk) -> DataFrame:
    return _rows(desk, "ticketmetric")


@query
def decode_quarantine(desk: Desk) -> DataFrame:
    """Events posted as ratings: a record whose time is no time, or whose id is text, is set aside."""
    event = F.struct(
        F.when(F.col("event_type") == "signup", F.col("props")).otherwise(F.col("event_id").cast("string")).alias("id"),
        F.col("user_id").alias("ticket_id"),
        F.when(F.col("event_type") == "error", F.col("props"))
        .otherwise(scalars.to_rfc3339(epoch("ts")))
        .alias("created_at"),
    )
    records = desk.source("events").select(
        F.lit("satisfactionrating").alias("table"),
        F.col("event_id").alias("fetched_at"),
        # An id that is a number stands unquoted in the JSON.
        F.regexp_replace(F.to_json(event), r'"id":"(\d+)"', r'"id":$1').alias("record"),
    )
    decoded = pages.decode_records(records, "satisfactionrating")
    return decoded.select("fetched_at", F.coalesce("problem", F.lit("none")).alias("problem"))


@query
def snapshot_groups(desk: Desk) -> DataFrame:
    """Two snapshots landed; the later one renames every group."""
    earlier = desk.pages("groups")
    later = desk.pages("groups", desk.records("groups").withColumn("name", F.upper(F.concat(F.lit("new "), "name"))))
    landed = earlier.unionByName(later.withColumn("fetched_at", F.col("fetched_at") + 1))
    newest = pages.latest_snapshot(pages.good(pages.decode(landed, "groups")))
    return with_seed("groups", upsert.align(newest, TABLES["groups"]))


@query
def incremental_tickets(desk: Desk) -> DataFrame:
    return pages.since(_rows(desk, "ticket"), CHANGED_SINCE).select("id", "status", "updatedat")


@query
def incremental_csat(desk: Desk) -> DataFrame:
    return pages.since(_rows(desk, "satisfactionrating"), RATED_SINCE)


@query
def child_refresh_audits(desk: Desk) -> DataFrame:
    changed = pages.since(desk["ticket"], CHANGED_SINCE)
    return pages.children_of(_decoded(desk, "audit"), changed).select("id", "ticketid", "createdat", "authorid")


@query
def child_refresh_metrics(desk: Desk) -> DataFrame:
    changed = pages.since(desk["ticket"], CHANGED_SINCE)
    return pages.children_of(_rows(desk, "ticketmetric"), changed)


@query
def page_chain_gaps(desk: Desk) -> DataFrame:
    """Two chains: tickets by full pages, and one page per order that has line items; some fetches fail."""
    numbered = desk.pages("ticket").withColumn("_n", F.regexp_extract("url", r"(\d+)$", 1).cast("bigint"))
    chained = F.concat(F.lit(f"{HOST}{S.API_PATH}/incremental/tickets.json?start_time="), (F.col("_n") + 1).cast("string"))
    orders = desk.source("lineitem").groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("lines"))
    base = f"{HOST}{S.API_PATH}/tickets.json?page="
    following = desk.source("orders").select(F.col("o_orderkey").alias("_following"))
    snapshot = orders.join(following, F.col("l_orderkey") + 1 == F.col("_following"), "left").select(
        "l_orderkey",
        F.concat(F.lit(base), F.col("l_orderkey").cast("string")).alias("url"),
        "lines",
        F.concat(F.lit(base), F.col("_following").cast("string")).alias("_next"),
    )
    record = F.array(F.struct(F.col("lines").alias("id"))).alias("tickets")
    listed = snapshot.select(
        "url",
        F.when(F.col("l_orderkey") % 11 == 5, 503).otherwise(200).alias("status_code"),
        F.lit(0).cast("bigint").alias("fetched_at"),
        F.to_json(F.struct(record, F.col("lines").alias("count"), F.col("_next").alias("next_page"))).alias("body"),
    )
    linked = numbered.select(
        "url",
        F.when(F.col("_n") % 7 == 3, 500).otherwise(F.col("status_code")).alias("status_code"),
        "fetched_at",
        F.concat(F.regexp_replace("body", r"\}$", ',"next_page":"'), chained, F.lit('"}')).alias("body"),
    )
    return pages.chain_gaps(linked.unionByName(listed))


@query
def page_chain_reach(desk: Desk) -> DataFrame:
    """One page per order that has line items, each naming the next order's; some fetches fail, some links lead back.

    Fetching began at every 25th order.
    """
    base = f"{HOST}{S.API_PATH}/tickets.json?page="
    key = F.col("l_orderkey")
    following = F.when(key % 50 == 49, key - 7).otherwise(key + 1)
    body = F.struct(F.array(F.struct(key.alias("id"))).alias("tickets"), F.concat(F.lit(base), following.cast("string")).alias("next_page"))
    chained = desk.source("lineitem").select("l_orderkey").distinct().select(
        F.concat(F.lit(base), key.cast("string")).alias("url"),
        F.when(key % 11 == 5, 503).otherwise(200).alias("status_code"),
        key.alias("fetched_at"),
        F.to_json(body).alias("body"),
    )
    entries = desk.source("orders").filter("o_orderkey % 25 = 0").select(F.concat(F.lit(base), F.col("o_orderkey").cast("string")).alias("url"))
    return pages.chain_reach(chained, entries)


@query
def page_count_check(desk: Desk) -> DataFrame:
    """Pages announce every line item of an order but carry each line number once."""
    lines = desk.source("lineitem").groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("count"), F.collect_set(F.struct(F.col("l_linenumber").alias("id"))).alias("tickets")
    )
    landed = lines.select(
        F.concat(F.lit(f"{HOST}{S.API_PATH}/tickets.json?page="), F.col("l_orderkey").cast("string")).alias("url"),
        F.to_json(F.struct("tickets", "count")).alias("body"),
    )
    return pages.page_counts(landed)


def _fetch_log(desk: Desk) -> DataFrame:
    kind = F.col("page_id") % 10
    status = F.when(kind == 0, 429).when(kind == 1, 404).when(kind == 2, 500).otherwise(200)
    return desk.source("pages").select("page_id", "url", status.alias("status_code"))


@query
def fetch_triage(desk: Desk) -> DataFrame:
    return pages.fetch_routes(_fetch_log(desk))


@query
def retry_worklist(desk: Desk) -> DataFrame:
    """Every page is fetched once, and those of every third id that were put off a second time with success."""
    first = _fetch_log(desk).withColumn("fetched_at", F.lit(1).cast("bigint"))
    again = first.filter("page_id % 3 = 0").withColumns({"status_code": F.lit(200), "fetched_at": F.lit(2).cast("bigint")})
    return pages.retry_urls(first.unionByName(again).drop("page_id"))


@query
def url_classify(desk: Desk) -> DataFrame:
    return pages.classify_urls(desk.source("pages").select("page_id", "url"))


@query
def fetch_worklist(desk: Desk) -> DataFrame:
    return pages.child_urls(pages.since(desk["ticket"], CHANGED_SINCE), HOST)


@query
def listing_worklist(desk: Desk) -> DataFrame:
    stored = offsets({t: desk[t] for t in ("organization", "user", "ticket", "satisfactionrating")})
    return pages.listing_urls(stored, HOST)


# --- row transformations and filters ----------------------------------------------------------


@query
def hook_chain(desk: Desk) -> DataFrame:
    hooks = Hooks()
    hooks.register("ticket", lambda rows: rows.filter(F.col("status") != "pending"))
    hooks.register("ticket", lambda rows: rows.withColumn("status", F.upper("status")))
    hooks.register("ticket", lambda rows: rows.withColumn("subject", F.concat_ws(" ", "status", "subject")))
    return hooks.apply("ticket", desk["ticket"]).select("id", "status", "subject")


@query
def dim_ticketfields(desk: Desk) -> DataFrame:
    return flatten.index_titles(_rows(desk, "ticketfields"))


@query
def dim_orgfields(desk: Desk) -> DataFrame:
    return flatten.index_keys(_rows(desk, "organizationfields"))


@query
def dim_userfields(desk: Desk) -> DataFrame:
    return flatten.index_keys(_rows(desk, "userfields"))


@query
def flatten_ticketdata(desk: Desk) -> DataFrame:
    return flatten.flatten_list(_decoded(desk, "ticket"), flatten.index_titles(desk["ticketfields"]))


@query
def flatten_orgdata(desk: Desk) -> DataFrame:
    keys = flatten.index_keys(desk["organizationfields"])
    return flatten.flatten_map(_decoded(desk, "organization"), keys, "organization_fields")


@query
def flatten_userdata(desk: Desk) -> DataFrame:
    return flatten.flatten_map(_decoded(desk, "user"), flatten.index_keys(desk["userfields"]), "user_fields")


@query
def change_events(desk: Desk) -> DataFrame:
    return flatten.change_events(_decoded(desk, "audit"), desk["ticketfields"])


@query
def audits_kept(desk: Desk) -> DataFrame:
    audits = _decoded(desk, "audit")
    kept = flatten.audits_with(audits, flatten.change_events(audits, desk["ticketfields"]))
    return kept.select(*TABLES["audit"].names)


@query
def changed_tickets(desk: Desk) -> DataFrame:
    return flatten.changed_ids(_decoded(desk, "ticket"))


@query
def accumulate_children(desk: Desk) -> DataFrame:
    """Child records gathered from three batches: audits, metrics, ratings."""
    return flatten.accumulate(
        *[desk[t].select(F.lit(t).alias("child"), "id", "ticketid") for t in ("audit", "ticketmetric", "satisfactionrating")]
    )


@query
def dim_lookup_default(desk: Desk) -> DataFrame:
    """Title of the field of every raw event; most event fields have no definition by text."""
    rows = desk.raw_events.select("id", F.col("fieldname").try_cast("bigint").alias("fieldid"))
    titles = flatten.index_titles(desk["ticketfields"])
    return flatten.lookup(rows, titles, "fieldid", "id", "title", "")


def _by_title(desk: Desk, exact: bool) -> DataFrame:
    """Attribute rows by title, where every other title is in capitals and has trailing blanks."""
    rows = desk["ticketdata"].withColumn(
        "title", F.when(F.col("objectid") % 2 == 0, F.col("title")).otherwise(F.concat(F.upper("title"), F.lit("  ")))
    )
    return rows.filter(scalars.same_title(F.col("title"), S.TITLE_CAUSE, exact)).select("objectid", "title", "value")


@query
def filter_title_exact(desk: Desk) -> DataFrame:
    return _by_title(desk, True)


@query
def filter_title_ci(desk: Desk) -> DataFrame:
    return _by_title(desk, False)


@query
def filter_nonempty(desk: Desk) -> DataFrame:
    return desk.raw_events.filter(F.col("pvalue") > "").select("id", "pvalue")


# --- joins ------------------------------------------------------------------------------------


@query
def join_ticket_audit_event(desk: Desk) -> DataFrame:
    audits = desk["audit"].select(F.col("id").alias("auditid"), "ticketid")
    tickets = desk["ticket"].select(F.col("id").alias("ticketid"), "subject")
    events = desk["changeevent"].select(F.col("id").alias("eventid"), "auditid", "value")
    return events.join(audits, "auditid").join(tickets, "ticketid").select("ticketid", "subject", "auditid", "eventid", "value")


@query
def join_numeric_text(desk: Desk) -> DataFrame:
    joined = flatten.numeric_text_join(desk.raw_events, F.col("fieldname"), desk["ticketfields"])
    return joined.select("id", "fieldid", "fieldtitle")


@query
def semi_assignee_exists(desk: Desk) -> DataFrame:
    users = desk["user"].select(F.col("id").alias("_user"))
    return desk["ticket"].join(users, F.col("assigneeid") == F.col("_user"), "left_semi").select("id", "assigneeid")


@query
def fk_orphans(desk: Desk) -> DataFrame:
    return quality.orphans(desk["ticket"], TABLES["ticket"].parents, desk, ["id"])


@query
def audit_holes(desk: Desk) -> DataFrame:
    return quality.holes(desk["ticket"], desk.audit_records)


# --- aggregates -------------------------------------------------------------------------------


@query
def fetch_offset(desk: Desk) -> DataFrame:
    return warehouse.fetch_offset(desk["ticket"])


@query
def first_change_id(desk: Desk) -> DataFrame:
    return views.first_change_id(desk)


@query
def time_spent_all_fields(desk: Desk) -> DataFrame:
    return views.time_spent_all_fields(desk)


@query
def eav_pivot(desk: Desk) -> DataFrame:
    return eav.pivot(desk["ticketdata"], S.TICKET_ATTRIBUTES, "ticketid")


@query
def eav_pivot_one_pass(desk: Desk) -> DataFrame:
    return eav.pivot_one_pass(desk["ticketdata"], S.TICKET_ATTRIBUTES, "ticketid")


@query
def eav_pivot_unique(desk: Desk) -> DataFrame:
    return eav.pivot_unique(desk["ticketdata"], S.TICKET_ATTRIBUTES, "ticketid")


# --- scalars ----------------------------------------------------------------------------------


@query
def to_epoch(desk: Desk) -> DataFrame:
    """Event times written as RFC 3339 with fraction and offset; views carry no time, errors no valid one."""
    written = F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")
    kind = F.col("event_type")
    text = F.when(kind == "error", F.col("props")).when(kind == "click", "1960-05-01T00:00:00Z").when(kind != "view", written)
    return desk.source("events").select(
        "event_id", scalars.to_epoch(text).alias("epoch"), scalars.is_bad_time(text).alias("bad")
    )


@query
def calendar_minutes(desk: Desk) -> DataFrame:
    return _decoded(desk, "ticketmetric").select("id", "ttfr", "ttr", "agentwaittime", "requesterwaittime")


def _around_zero(desk: Desk) -> DataFrame:
    return desk.source("customer").select("c_custkey", F.floor(F.col("c_acctbal") * 1000).alias("epoch"))


@query
def from_epoch(desk: Desk) -> DataFrame:
    return _around_zero(desk).select("c_custkey", scalars.from_epoch(F.col("epoch")).alias("moment"))


@query
def from_epoch_signed(desk: Desk) -> DataFrame:
    return _around_zero(desk).select("c_custkey", scalars.from_epoch_signed(F.col("epoch")).alias("moment"))


@query
def convert_tz(desk: Desk) -> DataFrame:
    moment = scalars.from_epoch(F.col("updatedat"))
    return desk["ticket"].select("id", scalars.convert_tz(moment, "UTC", "EST").alias("updated"))


def _number_texts(desk: Desk) -> DataFrame:
    kind = F.col("event_type")
    number = F.get_json_object("props", "$.k")
    text = (
        F.when(kind == "purchase", number)
        .when(kind == "signup", F.concat(number, F.lit("abc")))
        .when(kind == "click", F.concat(F.lit("x"), number))
        .when(kind == "view", "")
    )
    return desk.source("events").select("event_id", text.alias("value"))


@query
def cast_unsigned_strict(desk: Desk) -> DataFrame:
    return _number_texts(desk).select("event_id", scalars.to_unsigned(F.col("value")).alias("number"))


@query
def cast_unsigned_lenient(desk: Desk) -> DataFrame:
    return _number_texts(desk).select("event_id", scalars.to_unsigned_lenient(F.col("value")).alias("number"))


@query
def parse_int_default(desk: Desk) -> DataFrame:
    return _number_texts(desk).select("event_id", scalars.parse_int(F.col("value")).alias("number"))


@query
def ticket_type(desk: Desk) -> DataFrame:
    return desk["ticket"].select("id", scalars.ticket_type(F.col("recipient"), S.recipient_types()).alias("type"))


@query
def json_value_text(desk: Desk) -> DataFrame:
    """A member that holds a number, a flag, a list, a text or null, by kind of event."""
    kind = F.col("event_type")
    key = F.col("event_id").cast("string")
    value = (
        F.when(kind == "purchase", key)
        .when(kind == "signup", "true")
        .when(kind == "click", F.concat(F.lit("["), key, F.lit(","), key, F.lit("]")))
        .when(kind == "view", F.concat(F.lit('"v'), key, F.lit('"')))
        .otherwise("null")
    )
    document = F.concat(F.lit('{"id":1,"value":'), value, F.lit("}"))
    return desk.source("events").select("event_id", scalars.json_text(document, "value").alias("value"))


@query
def apply_defaults(desk: Desk) -> DataFrame:
    """Metrics of every ticket; where a ticket has none the declared defaults stand in."""
    table = TABLES["ticketmetric"]
    ids = desk["ticket"].select(F.col("id").alias("_ticket"))
    joined = ids.join(desk["ticketmetric"], F.col("_ticket") == F.col("ticketid"), "left")
    filled = upsert.apply_defaults(joined, table)
    return filled.select(F.col("_ticket").alias("ticket"), "createdat", "solvedat", "agentwaittime", "replies", "ttfr", "ttr")


@query
def with_seed_rows(desk: Desk) -> DataFrame:
    return with_seed("user", _rows(desk, "user"))


# --- sinks and quality ------------------------------------------------------------------------


def _line_merge(desk: Desk) -> DataFrame:
    rows = desk.source("lineitem")
    stored = upsert.newest(rows.filter("l_linestatus = 'F'"), ["l_orderkey", "l_linenumber"], ["l_shipdate"])
    batch = rows.filter("l_linestatus <> 'F'")
    return upsert.merge(stored, batch, ["l_orderkey", "l_linenumber"], "l_shipdate")


@query
def upsert_latest(desk: Desk) -> DataFrame:
    """Shipped lines are stored, the others come in; each key keeps its latest ship date."""
    return _line_merge(desk)


@query
def late_arrival_upsert(desk: Desk) -> DataFrame:
    """Tickets come in again as of their solved time; where that is older, the stored row stays."""
    metric = desk["ticketmetric"].select(F.col("ticketid").alias("_t"), "solvedat")
    late = (
        desk["ticket"]
        .join(metric, F.col("id") == F.col("_t"))
        .withColumn("status", F.lit("closed"))
        .withColumn("updatedat", F.col("solvedat") - F.lit(86400 * 45))
        .select(*TABLES["ticket"].names)
    )
    return upsert.merge(desk["ticket"], late, ["id"], "updatedat").select("id", "status", "updatedat")


@query
def align_to_table(desk: Desk) -> DataFrame:
    return upsert.align(desk.organization_records, TABLES["organization"])


@query
def upsert_keep_target_cols(desk: Desk) -> DataFrame:
    """Organizations stored with an external id come in again without one, along with new ones."""
    spec = TABLES["organization"]
    stored = upsert.align(
        desk.organization_records.filter("groupid > 5").withColumn("externalid", F.concat(F.lit("ext-"), F.col("id").cast("string"))),
        spec,
    )
    batch = upsert.align(desk.organization_records.withColumn("name", F.upper("name")), spec)
    return upsert.merge(stored, batch, ["id"], "updatedat", kept=["externalid"])


def _checked_tickets(desk: Desk) -> DataFrame:
    return quality.check(desk["ticket"], "ticket", desk)


@query
def quarantine_split(desk: Desk) -> DataFrame:
    tagged = _checked_tickets(desk)
    reason = F.array_join(quality.REASONS, ",")
    return tagged.select("id", F.when(reason == "", "accepted").otherwise("quarantine").alias("route"), reason.alias("reason"))


@query
def load_report(desk: Desk) -> DataFrame:
    organizations = quality.check(desk["organization"], "organization", desk)
    return quality.route_counts(_checked_tickets(desk), "ticket").unionByName(quality.route_counts(organizations, "organization"))


@query
def offset_table(desk: Desk) -> DataFrame:
    return offsets({t: desk[t] for t in ("organization", "user", "ticket", "satisfactionrating")})


@query
def pk_duplicates(desk: Desk) -> DataFrame:
    return quality.duplicate_keys(desk.source("lineitem"), ["l_orderkey", "l_linenumber"])


@query
def not_null_violations(desk: Desk) -> DataFrame:
    ids = desk["ticket"].select(F.col("id").alias("ticket"))
    joined = ids.join(desk["ticketmetric"], F.col("ticket") == F.col("ticketid"), "left")
    return quality.violations(joined, "ticket", quality.not_null(["ticketid", "solvedat"]))


@query
def length_violations(desk: Desk) -> DataFrame:
    return quality.violations(desk.source("documents"), "doc_id", quality.too_long({"text": 1024, "source": 10}))


@query
def unsigned_violations(desk: Desk) -> DataFrame:
    balances = desk.source("customer").select("c_custkey", F.floor("c_acctbal").alias("balance"), F.col("c_nationkey").alias("nation"))
    return quality.violations(balances, "c_custkey", quality.negative(["balance", "nation"]))


# --- base table loads -------------------------------------------------------------------------


# The resources a table is made of: its own pages and those of what it refers to, parents first.
_ACCOUNTS = ("groups", "organization", "user")
_TICKETS = (*_ACCOUNTS, "ticket")
NEEDED = {
    "groups": ("groups",),
    "ticketfields": ("ticketfields",),
    "organizationfields": ("organizationfields",),
    "userfields": ("userfields",),
    "ticketmetric": ("ticketmetric",),
    "organization": ("groups", "organization"),
    "organizationdata": ("organizationfields", "groups", "organization"),
    "user": _ACCOUNTS,
    "userdata": ("userfields", *_ACCOUNTS),
    "ticket": _TICKETS,
    "ticketdata": ("ticketfields", *_TICKETS),
    "satisfactionrating": (*_TICKETS, "satisfactionrating"),
    "audit": ("ticketfields", *_TICKETS, "audit"),
    "changeevent": ("ticketfields", *_TICKETS, "audit"),
}


def _land(rows: DataFrame, folder: str, mode: str = "overwrite") -> str:
    """Land pages as compressed files. Such a file is read by one task, so a file takes less of a shuffle than
    other tasks do: pages are tens of times as large as the rows they are made of. Shuffles start with as many more
    partitions, as adaptive execution merges partitions and does not cut them."""
    target, first = "spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    conf = rows.sparkSession.conf
    before = {name: conf.get(name, None) for name in (target, first)}
    conf.set(target, "2m")
    conf.set(first, str(LANDED * int(before[first] or conf.get("spark.sql.shuffle.partitions"))))
    # Text of pages repeats itself: a lower level takes much less time for a quarter more bytes.
    rows.write.mode(mode).option("compression", "gzip").option("zlib.compress.level", "THREE").json(folder)
    for name, value in before.items():
        conf.unset(name) if value is None else conf.set(name, value)
    return folder


def _synced(desk: Desk, *resources: str) -> Warehouse:
    """A warehouse that the pages of some resources were loaded into."""
    folder = run_folder(desk.spark)
    landing = _land(reduce(DataFrame.unionByName, map(desk.pages, resources)), f"{folder}/landing")
    run_sync(desk.spark, landing, f"{folder}/tables")
    return Warehouse(desk.spark, f"{folder}/tables")


def _stored(desk: Desk, *tables: str) -> Warehouse:
    """A warehouse that holds some tables already: parents of what a query loads. Tickets are the accepted ones."""
    target = Warehouse(desk.spark, f"{run_folder(desk.spark)}/tables")
    for table in tables:
        target.write(table, quality.accepted(_checked_tickets(desk)) if table == "ticket" else desk[table])
    return target


def _load(table: str) -> Query:
    return lambda desk: _synced(desk, *NEEDED[table]).read(table)


QUERIES.update({f"load_{table}": _load(table) for table in NEEDED})


@query
def incremental_sync(desk: Desk) -> DataFrame:
    """Two loads of a landing folder that grows by every other page of tickets: what the second one reads of each
    resource, and where the next fetch starts by the stored offsets."""
    folder = run_folder(desk.spark)
    later = F.col("fetched_at") % 2 == 1
    first = reduce(DataFrame.unionByName, map(desk.pages, _ACCOUNTS)).unionByName(desk.pages("ticket").filter(~later))
    landing = _land(first, f"{folder}/landing")
    run_sync(desk.spark, landing, f"{folder}/tables")
    _land(desk.pages("ticket").filter(later), landing, "append")
    report = run_sync(desk.spark, landing, f"{folder}/tables").select(F.col("table").alias("resource"), "read")
    listings = pages.listing_urls(Warehouse(desk.spark, f"{folder}/tables").read("sequencetable"), HOST)
    return listings.join(report, "resource", "left").select("resource", "url", F.coalesce("read", F.lit(0)).cast("bigint").alias("read"))


@query
def load_renamed_field(desk: Desk) -> DataFrame:
    """The priority field gets another title, and some tickets come again after that."""
    target = _synced(desk, *NEEDED["ticketdata"])
    title = F.when(F.col("id") == 101, RENAMED).otherwise(F.col("title"))
    fields = desk["ticketfields"].withColumn("title", title).withColumn("updatedat", F.col("updatedat") + 1)
    again = desk.records("ticket").filter(F.col("recipient") == "support@example.com")
    again = again.withColumn("updatedat", F.col("updatedat") + 7200)
    landing = _land(to_pages(fields, "ticketfields").unionByName(to_pages(again, "ticket")), f"{run_folder(desk.spark)}/landing")
    run_sync(desk.spark, landing, target.root)
    return target.read("ticketdata")


@query
def dead_letters(desk: Desk) -> DataFrame:
    """All letters of two loads and a stream: failed pages, and organizations of groups that do not exist."""

    def misplaced(last: int) -> DataFrame:
        lost = F.when(F.col("id") % 10 == last, 900 + last).otherwise(F.col("groupid"))
        return to_pages(desk.records("organization").withColumn("groupid", lost), "organization")

    failed = _fetch_log(desk).select("url", "status_code", F.lit(1).cast("bigint").alias("fetched_at"), F.lit("{}").alias("body"))
    failed = failed.filter(F.col("status_code") != 200)
    folder = run_folder(desk.spark)
    first = desk.pages("groups").unionByName(misplaced(3)).unionByName(failed)
    run_sync(desk.spark, _land(first, f"{folder}/first"), f"{folder}/tables")
    run_sync(desk.spark, _land(desk.pages("groups"), f"{folder}/second"), f"{folder}/tables")
    landing = _land(misplaced(4).filter(F.col("fetched_at") >= 0), f"{folder}/third")
    follow_table(desk.spark, landing, "organization", f"{folder}/tables", f"{folder}/checkpoint", drain=True).awaitTermination()
    return Warehouse(desk.spark, f"{folder}/tables").quarantined().select("resource", "key", "reason")


# --- views ------------------------------------------------------------------------------------

VIEW_KEYS = {
    "time_spent": "TimeSpent",
    "ticket_time": "TicketTime",
    "ticket_initial_priority": "TicketInitialPriority",
    "ticket_priority": "TicketPriority",
    "ticket_component": "TicketComponent",
    "ticket_cause": "TicketCause",
    "ticket_version": "TicketVersion",
    "bundle_usage": "BundleUsage",
    "ticket_view": "TicketView",
    "organization_tam": "OrganizationTam",
    "organization_renewal": "OrganizationRenewal",
    "organization_tz": "OrganizationTZ",
    "organization_entitlement": "OrganizationEntitlement",
    "organization_se": "OrganizationSE",
    "organization_view": "OrganizationView",
}
QUERIES.update({key: views.VIEWS[name] for key, name in VIEW_KEYS.items()})
QUERIES["ticket_view_sorted"] = views.ticket_view_sorted
USER_VIEW = """
    CREATE OR REPLACE TEMP VIEW OpenWork AS
    SELECT v.type, p.priority, count(*) AS tickets, count(m.ticketid) AS timed, max(v.ttr) AS longest
    FROM TicketViewOf('example.com', 'desk.example.com') v
    JOIN TicketPriority p ON p.ticketid = v.id LEFT JOIN TicketTime m ON m.ticketid = v.id
    WHERE v.status <> 'solved' GROUP BY v.type, p.priority"""


@query
def user_view(desk: Desk) -> DataFrame:
    """A site's own view, written in SQL over the registered ones, with the site's mail domains."""
    views.register_views(desk.spark, desk, S.recipient_types("elsewhere.org", "desk.elsewhere.org"))
    desk.spark.sql(USER_VIEW)
    rows = desk.spark.table("OpenWork")
    desk.spark.catalog.dropTempView("OpenWork")
    views.drop_views(desk.spark, desk)
    return rows


QUERIES["ticket_view_basic"] = views.ticket_view_basic


# --- streaming --------------------------------------------------------------------------------


@query
def stream_decode(desk: Desk) -> DataFrame:
    """Follow landed ticket pages; the decoded records are appended to a parquet folder."""
    folder = run_folder(desk.spark)
    landing = _land(desk.pages("ticket"), f"{folder}/landing")
    rows = upsert.align(decode_stream(desk.spark, landing, "ticket"), TABLES["ticket"])
    stream = (
        rows.writeStream.format("parquet")
        .option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(availableNow=True)
        .start(f"{folder}/decoded")
    )
    stream.awaitTermination()
    return desk.spark.read.schema(rows.schema).parquet(f"{folder}/decoded")


@query
def stream_upsert(desk: Desk) -> DataFrame:
    """Tickets land twice, the second time closed and two hours newer, and are loaded as they come."""
    target = _stored(desk, *_ACCOUNTS)
    folder = run_folder(desk.spark)
    again = desk.records("ticket").withColumn("status", F.lit("closed")).withColumn("updatedat", F.col("updatedat") + 7200)
    solved = again.filter(F.col("recipient") == "support@example.com")
    landing = _land(desk.pages("ticket").unionByName(to_pages(solved, "ticket")), f"{folder}/landing")
    follow_table(desk.spark, landing, "ticket", target.root, f"{folder}/checkpoint", drain=True).awaitTermination()
    return target.read("ticket")


@query
def stream_child_refresh(desk: Desk) -> DataFrame:
    """As tickets land, their audits are refreshed from the child pages; returns the stored audits."""
    folder = run_folder(desk.spark)
    changed = pages.since(desk.records("ticket"), CHANGED_SINCE)
    landing = _land(desk.pages("ticket", changed), f"{folder}/landing")
    children = _land(desk.pages("audit").unionByName(desk.pages("ticketmetric")), f"{folder}/children")
    target = _stored(desk, "ticketfields", "user", "ticket")
    follow_children(
        desk.spark,
        landing,
        children,
        target.root,
        f"{folder}/checkpoint",
        drain=True,
    ).awaitTermination()
    return target.read("audit")


@query
def late_children(desk: Desk) -> DataFrame:
    """Audits land before the tickets that changed, with them and after them; all of them are stored."""
    folder = run_folder(desk.spark)
    target = _stored(desk, "ticketfields", "user", "ticket")
    changed = desk.pages("ticket", pages.since(desk.records("ticket"), CHANGED_SINCE))
    audits = desk.pages("audit").withColumn("_part", F.crc32("url") % 3)
    landing, children = f"{folder}/landing", f"{folder}/children"
    _land(changed.limit(0), landing)
    _land(audits.limit(0).drop("_part"), children)
    for part in range(3):
        if part == 1:
            _land(changed, landing, "append")
        _land(audits.filter(F.col("_part") == part).drop("_part"), children, "append")
        follow_children(desk.spark, landing, children, target.root, drain=True).awaitTermination()
    return target.read("audit")


@query
def load_order(desk: Desk) -> DataFrame:
    """A full load of every resource from a landing folder; returns the rows stored per table, in load order."""
    folder = run_folder(desk.spark)
    landing = _land(desk.all_pages(), f"{folder}/landing")
    run_sync(desk.spark, landing, f"{folder}/tables")
    return stored_rows(Warehouse(desk.spark, f"{folder}/tables"))


@query
def stream_load(desk: Desk) -> DataFrame:
    """The same load by following the landing folder, read back through the ticket view."""
    folder = run_folder(desk.spark)
    landing = _land(desk.all_pages(), f"{folder}/landing")
    follow(desk.spark, landing, f"{folder}/tables", f"{folder}/checkpoint", drain=True).awaitTermination()
    target = Warehouse(desk.spark, f"{folder}/tables")
    return views.ticket_view({t: target.read(t) for t in LOAD_ORDER})


__all__ = ["PAGE_ROWS", "QUERIES", "queries"]
