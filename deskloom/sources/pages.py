"""Landed API pages: envelope, typed decode, source modes, paging and fetch reports.

A page is one fetched response, ``(url, status_code, fetched_at, body)``. Nothing here reads a
page on the driver: envelopes and records are decoded by ``from_json`` where the page lies.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from deskloom.functions.scalars import calendar_minutes, epoch_of, instant
from deskloom.operators.upsert import newest
from deskloom.rows import literal_rows
from deskloom.schema import MEMBERS, PAGE, RESOURCES
from deskloom.session import run_folder
from deskloom.settings import API_PATH, FULL_PAGE

CORRUPT = "_unreadable"


def read_pages(spark: SparkSession, folder: str, since: str | None = None) -> DataFrame:
    """Landed pages of a folder: JSON lines, one page per line; only of files modified after ``since``, if given."""
    reader = spark.read.schema(PAGE)
    return (reader.option("modifiedAfter", since) if since else reader).json(folder)


def once(rows: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a column whose value is computed once per row.

    As the output of a generator it is a barrier for the optimizer, which otherwise pushes later
    filters below the column and so parses the same JSON again for every use in a condition.
    """
    return rows.select("*", F.explode(F.array(value)).alias(name))


# --- envelope ---------------------------------------------------------------------------------


def _members(body: Column) -> Column:
    """Every member of a page, as text."""
    return F.from_json(body, "map<string,string>")


def _resource(members: Column) -> Column:
    """The known member of a page, the last one if it carries several."""
    known = F.array(*[F.lit(name) for name in sorted(MEMBERS)])
    return F.try_element_at(F.array_intersect(F.map_keys(members), known), F.lit(-1))


def scan_envelope(pages: DataFrame) -> DataFrame:
    """Split each page into resource member, payload text, record count and page links.

    ``resource`` is NULL where the body is not JSON or carries no known member.
    """
    return (
        once(pages, "_members", _members(F.col("body")))
        .withColumn("resource", _resource(F.col("_members")))
        .select(
            *pages.columns,
            "resource",
            F.col("_members")[F.col("resource")].alias("payload"),
            F.coalesce(F.col("_members")["count"].try_cast("bigint"), F.lit(0)).alias("count"),
            F.col("_members")["next_page"].alias("next_page"),
            F.col("_members")["previous_page"].alias("previous_page"),
        )
    )


def payload_records(payload: Column) -> Column:
    """The payload as an array of record texts; a single object counts as one record."""
    listed = F.from_json(payload, "array<string>")
    return F.when(F.ltrim(payload).startswith("{"), F.array(payload)).otherwise(listed)


def page_counts(pages: DataFrame) -> DataFrame:
    """Announced against actual number of records, for pages where the two differ."""
    listed = once(scan_envelope(pages), "_list", payload_records(F.col("payload")))
    actual = F.coalesce(F.size("_list"), F.lit(0)).cast("bigint")
    return (
        listed.select("url", "resource", F.col("count").alias("announced"), actual.alias("actual"))
        .filter(F.col("announced") != F.col("actual"))
    )


# --- typed decode -----------------------------------------------------------------------------


def _member(kind: str, value: Column) -> Column:
    if kind == "calendar":
        return calendar_minutes(value)
    if kind == "long":
        return F.coalesce(value, F.lit(0).cast("bigint"))
    if kind == "boolean":
        return F.coalesce(value, F.lit(False))
    if kind == "string":
        return F.coalesce(value, F.lit(""))
    if kind == "map":
        return F.array_sort(F.map_entries(value))
    return value


REJECTED = "rejected"


LISTS = sorted(r.plural for r in RESOURCES.values() if r.plural)
OBJECTS = sorted(r.singular for r in RESOURCES.values() if r.singular)


def split_pages(pages: DataFrame) -> DataFrame:
    """One raw record per row, with the base table it belongs to: a page is parsed once for all tables.

    A regular page carries one known member, of the shape its name promises, and its records come
    straight out of that parse. Any other page is taken apart member by member. One that yields no
    records at all, or whose fetch failed, comes as one row of the table :data:`REJECTED`, with its body as
    the record and the reason as ``problem``.
    """
    shape = ", ".join([f"`{m}` array<string>" for m in LISTS] + [f"`{m}` string" for m in OBJECTS])
    whole = F.col("_page")
    held = {m: whole[m] for m in LISTS} | {
        m: F.when(F.ltrim(whole[m]).startswith("{"), F.array(whole[m])) for m in OBJECTS
    }
    found = F.array_compact(
        F.array(*[F.when(rows.isNotNull(), F.struct(F.lit(m).alias("resource"), rows.alias("list"))) for m, rows in held.items()])
    )
    regular = F.size("_found") == 1
    table = F.create_map(*[F.lit(v) for pair in sorted(MEMBERS.items()) for v in pair])
    payload = F.col("_members")[F.col("_last")]
    unreadable = (payload != "null") & F.col("_list").isNull()
    fetched = route(F.col("status_code")) == "load"
    pages = pages.select(
        "url",
        "fetched_at",
        F.when(fetched, F.col("body")).alias("body"),
        F.when(~fetched, F.coalesce("body", F.lit(""))).alias("_failed"),
        F.concat(F.lit("status_"), F.coalesce(F.col("status_code").cast("string"), F.lit("none"))).alias("_status"),
    )
    parsed = once(once(pages, "_page", F.from_json("body", shape)), "_found", found)
    return (
        once(parsed, "_members", _members(F.when(~regular, F.col("body"))))
        .withColumn("_last", _resource(F.col("_members")))
        .withColumn("resource", F.when(regular, F.col("_found")[0]["resource"]).otherwise(F.col("_last")))
        .withColumn("_list", F.when(regular, F.col("_found")[0]["list"]).otherwise(payload_records(payload)))
        .withColumn(
            "problem",
            F.when(F.col("_failed").isNotNull(), F.col("_status"))
            .when(F.col("resource").isNull(), F.lit("unknown_resource"))
            .when(unreadable, F.lit("bad_payload")),
        )
        .select(
            F.when(F.col("problem").isNull(), table[F.col("resource")]).otherwise(F.lit(REJECTED)).alias("table"),
            "fetched_at",
            F.when(F.col("problem").isNotNull(), F.col("url")).alias("url"),
            F.coalesce("resource", F.lit("")).alias("resource"),
            "problem",
            F.explode(F.when(F.col("problem").isNull(), F.col("_list")).otherwise(F.array(F.coalesce("_failed", "body")))).alias("record"),
        )
    )


def rejected_pages(split: DataFrame) -> DataFrame:
    """The pages that yielded no records, as dead letters."""
    return split.filter(F.col("table") == REJECTED).select(
        "resource", F.col("url").alias("key"), F.col("problem").alias("reason"), F.col("record").alias("payload")
    )


def record_ticket(records: DataFrame) -> DataFrame:
    """Raw records with the ticket a child record belongs to; NULL where it names none or is no child."""
    named = F.get_json_object("record", "$.ticket_id").try_cast("bigint")
    return records.withColumn("_ticket", F.when(F.col("table").isin("audit", "ticketmetric"), named))


def decode(pages: DataFrame, table: str) -> DataFrame:
    """Typed records of one resource, straight from pages."""
    return decode_records(split_pages(pages).filter(F.col("table") == table), table)


def decode_records(records: DataFrame, table: str) -> DataFrame:
    """Raw records of one resource, typed, one row each.

    Columns: the resource's own columns, its embedded members, ``fetched_at`` (ingest order),
    ``record`` (raw text) and ``problem`` (NULL for a good record). Missing members take zero
    values: 0, empty text, false. Embedded maps come as sorted key/value lists.
    """
    resource = RESOURCES[table]
    parsed = once(
        records.select("fetched_at", "record"),
        "_r",
        F.from_json(
            "record",
            f"{resource.ddl}, `{CORRUPT}` string",
            {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT},
        ),
    )
    # A time is read once for its value and for whether it is one.
    times = [json for _, json, kind in resource.members if kind == "time"]
    parsed = once(parsed, "_t", F.struct(*[instant(F.col("_r")[json]).alias(json) for json in times]))
    bad_time = F.lit(False)
    for json in times:
        bad_time = bad_time | (F.col("_r")[json].isNotNull() & F.col("_t")[json].isNull())
    problem = (
        F.when(F.col("_r").isNull() | F.col("_r")[CORRUPT].isNotNull(), F.lit("unreadable"))
        .when(bad_time, F.lit("bad_time"))
        .alias("problem")
    )
    return parsed.select(
        *[
            (epoch_of(F.col("_t")[json]) if kind == "time" else _member(kind, F.col("_r")[json])).alias(column)
            for column, json, kind in resource.members
        ],
        *[_member(kind, F.col("_r")[json]).alias(column) for column, json, kind in resource.embedded],
        "fetched_at",
        "record",
        problem,
    )


def good(decoded: DataFrame) -> DataFrame:
    """The readable records of a decoded frame."""
    return decoded.filter(F.col("problem").isNull()).drop("problem", "record")


def rejected_records(decoded: DataFrame, table: str) -> DataFrame:
    """The unreadable records, as dead letters."""
    return decoded.filter(F.col("problem").isNotNull()).select(
        F.lit(table).alias("resource"),
        F.get_json_object("record", "$.id").alias("key"),
        F.col("problem").alias("reason"),
        F.col("record").alias("payload"),
    )


# --- source modes -----------------------------------------------------------------------------


def latest_snapshot(decoded: DataFrame) -> DataFrame:
    """Newest version of each ``id`` over all snapshots that were landed."""
    return newest(decoded, ["id"], ["fetched_at"])


def since(records: DataFrame, offset: Column | int) -> DataFrame:
    """Records changed at or after an offset; the boundary itself is read again."""
    start = offset if isinstance(offset, Column) else F.lit(offset)
    return records.filter(F.col("updatedat") >= F.greatest(start, F.lit(0)))


def children_of(children: DataFrame, changed: DataFrame, ticket: str = "ticketid") -> DataFrame:
    """Child records (audits, metrics) of the changed tickets only."""
    ids = changed.select(F.col("id").alias("_changed")).distinct()
    return children.join(ids, F.col(ticket) == F.col("_changed"), "left_semi")


def read_resource(
    spark: SparkSession, folder: str, table: str, offset: int | None = None, changed: DataFrame | None = None
) -> DataFrame:
    """Good records of one resource from a landing folder.

    ``offset`` keeps records changed since then, ``changed`` the children of those tickets.
    """
    records = good(decode(loadable(read_pages(spark, folder)), table))
    if offset is not None:
        records = since(records, offset)
    return records if changed is None else children_of(records, changed)


def pages_of(pages: DataFrame, changed: DataFrame) -> DataFrame:
    """Child pages that can hold records of the changed tickets, told by their address before any parse.

    A page whose address names no ticket is kept, and takes no part in the join.
    """
    ids = changed.select(F.col("id").alias("_changed"))
    ticket = F.regexp_extract("url", r"/tickets/(\d+)/[^/]*$", 1).try_cast("bigint")
    named = pages.withColumn("_ticket", ticket)
    found = named.join(ids, F.col("_ticket") == F.col("_changed"), "left_semi").select(*pages.columns)
    return found.unionByName(named.filter(F.col("_ticket").isNull()).select(*pages.columns))


# --- addresses --------------------------------------------------------------------------------


def url_path(url: Column) -> Column:
    """Path of a URL, ``/`` where it has none."""
    path = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)
    return F.when(path == "", F.lit("/")).otherwise(path)


def url_option(url: Column) -> Column:
    """What stands between the API version prefix and the last path segment."""
    folder = F.regexp_extract(url_path(url), r"^(.*)/[^/]*$", 1)
    return F.when(folder.startswith(API_PATH), F.substr(folder, F.lit(len(API_PATH) + 1))).otherwise(folder)


def url_resource(url: Column) -> Column:
    """Last path segment, with its leading slash."""
    return F.regexp_extract(url_path(url), r"(/[^/]*)$", 1)


def is_incremental(url: Column) -> Column:
    return url_option(url) == "/incremental"


def classify_urls(urls: DataFrame, column: str = "url") -> DataFrame:
    url = F.col(column)
    return urls.select(
        *urls.columns,
        url_option(url).alias("option"),
        url_resource(url).alias("resource"),
        is_incremental(url).alias("incremental"),
    )


def endpoint(host: str, path: Column | str) -> Column:
    tail = path if isinstance(path, Column) else F.lit(path)
    return F.concat(F.lit(f"{host.rstrip('/')}{API_PATH}/"), tail)


# Resource table -> path of its listing, and whether it takes a start time.
LISTINGS = {
    "ticketfields": ("ticket_fields.json", False),
    "organizationfields": ("organization_fields.json", False),
    "userfields": ("user_fields.json", False),
    "groups": ("groups.json", False),
    "organization": ("incremental/organizations.json", True),
    "user": ("incremental/users.json", True),
    "ticket": ("incremental/tickets.json", True),
    "satisfactionrating": ("satisfaction_ratings.json", True),
}


def listing_urls(offsets: DataFrame, host: str) -> DataFrame:
    """Listing URL of every resource, starting from its stored offset.

    ``offsets`` has columns ``(sequencename, lastval)``, one row per table that has an offset.
    """
    struct = T.StructType().add("resource", "string").add("path", "string").add("timed", "boolean")
    listings = literal_rows(
        offsets.sparkSession, struct, [(table, path, timed) for table, (path, timed) in LISTINGS.items()]
    )
    start = F.greatest(F.coalesce("lastval", F.lit(0)), F.lit(0)).cast("string")
    url = F.when(F.col("timed"), F.concat(endpoint(host, F.col("path")), F.lit("?start_time="), start))
    return listings.join(offsets, F.col("resource") == F.col("sequencename"), "left").select(
        "resource", url.otherwise(endpoint(host, F.col("path"))).alias("url")
    )


def child_urls(changed: DataFrame, host: str) -> DataFrame:
    """Audit and metric URLs of every changed ticket, as a fetch list."""
    kinds = F.explode(F.array(F.lit("audits"), F.lit("metrics")))
    ticket = F.col("id").cast("string")
    return (
        changed.select("id")
        .distinct()
        .select("id", kinds.alias("kind"))
        .withColumn("path", F.concat(F.lit("tickets/"), ticket, F.lit("/"), "kind", F.lit(".json")))
        .select("id", "kind", endpoint(host, F.col("path")).alias("url"))
    )


# --- reports on what was fetched --------------------------------------------------------------


def route(status: Column) -> Column:
    """What becomes of a fetch: load, retry, skip, or error."""
    return (
        F.when((status >= 200) & (status <= 300), F.lit("load"))
        .when(status == 429, F.lit("retry"))
        .when(status == 404, F.lit("skip"))
        .otherwise(F.lit("error"))
    )


def fetch_routes(pages: DataFrame) -> DataFrame:
    return pages.groupBy(route(F.col("status_code")).alias("route")).agg(F.count(F.lit(1)).alias("pages"))


def loadable(pages: DataFrame) -> DataFrame:
    """Pages whose fetch succeeded."""
    return pages.filter(route(F.col("status_code")) == "load")


def arrived(pages: DataFrame) -> DataFrame:
    """Pages to load, and those whose fetch ended in an error; one that is to be retried or skipped is neither."""
    return pages.filter(F.coalesce(route(F.col("status_code")), F.lit("error")).isin("load", "error"))


def links(pages: DataFrame) -> DataFrame:
    """(url, next_page, fetched_at) of pages; ``next_page`` is NULL where a page announces no successor.

    An incremental listing goes on while its pages are full, any other while a next page is
    named.
    """
    goes_on = F.when(is_incremental(F.col("url")), F.col("count") >= FULL_PAGE).otherwise(F.lit(True))
    return scan_envelope(pages).select("url", F.when(goes_on, F.col("next_page")).alias("next_page"), "fetched_at")


def chain_gaps(pages: DataFrame) -> DataFrame:
    """Pages that announce a successor which never landed, or came back as anything but a page to load."""
    fetched = loadable(pages)
    landed = fetched.select(F.col("url").alias("_landed")).distinct()
    expected = links(fetched).filter(F.col("next_page").isNotNull()).select("url", "next_page")
    return expected.join(landed, F.col("next_page") == F.col("_landed"), "left_anti")


def chain_reach(pages: DataFrame, entries: DataFrame) -> DataFrame:
    """Landed pages no walk along the links from an entry comes to, and pages whose links lead round in a circle.

    ``entries`` (url) are the addresses fetching began with. Returns (url, reached, cyclic) of the pages that are
    not reached or lie on a circle; a page fetched more than once links as its last fetch does.

    Links are walked by doubling: each round knows where twice as many links lead, and takes in what lies that
    much further from the pages reached so far. So a chain of a million pages takes twenty rounds, each two joins of
    addresses, written to a folder of the run. After the last round only circles still lead anywhere. That is so once a
    round changes nothing: no further page is reached, no walk ends, and the walks end at as many pages as before, so
    that rounds grow with the longest chain, not with the number of pages.
    """
    spark = pages.sparkSession
    folder = run_folder(spark)

    def written(rows: DataFrame, name: str) -> DataFrame:
        rows.write.parquet(f"{folder}/{name}")
        return spark.read.schema(rows.schema).parquet(f"{folder}/{name}")

    fetched = loadable(pages)
    last = links(fetched).groupBy("url").agg(F.max(F.struct("fetched_at", "next_page"))["next_page"].alias("to"))
    landed = written(fetched.select("url").distinct(), "landed")
    leads = written(last.join(landed.withColumnRenamed("url", "to"), "to", "left_semi").select("url", "to"), "leads-0")
    reached = landed.join(entries.select("url").distinct(), "url", "left_semi")
    rounds = max(landed.count(), 1).bit_length()
    before = None
    for n in range(1, rounds + 1):
        further = reached.join(leads, "url").select(F.col("to").alias("url"))
        reached = written(reached.union(further).distinct(), f"reached-{n}")
        onward = leads.select(F.col("url").alias("to"), F.col("to").alias("beyond"))
        leads = written(leads.join(onward, "to").select("url", F.col("beyond").alias("to")), f"leads-{n}")
        walks = leads.count()
        now = (reached.count(), walks, leads.agg(F.count_distinct("to")).first()[0] if before and before[1] == walks else None)
        if not walks or now == before and now[2] is not None:
            break
        before = now
    on_walk = reached.select("url", F.lit(True).alias("_reached"))
    on_circle = leads.select(F.col("to").alias("url"), F.lit(True).alias("_cyclic")).distinct()
    told = landed.join(on_walk, "url", "left").join(on_circle, "url", "left")
    told = told.select("url", F.col("_reached").isNotNull().alias("reached"), F.col("_cyclic").isNotNull().alias("cyclic"))
    return told.filter(~F.col("reached") | F.col("cyclic"))


def retry_urls(pages: DataFrame) -> DataFrame:
    """Work list of the addresses whose last fetch was put off (429): (url, fetches) so far."""
    last = F.max_by("status_code", F.struct("fetched_at", "status_code"))
    fetched = pages.groupBy("url").agg(last.alias("_status"), F.count(F.lit(1)).alias("fetches"))
    return fetched.filter(route(F.col("_status")) == "retry").select("url", "fetches")
