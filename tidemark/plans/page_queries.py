"""Queries of the capture operators, over pages cut from the event table.

A page holds PAGE events as an API would give them.  Some numbers are NaN, some
records aren't objects, and some pages differ from their manifest.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.leaves import share_code
from ..operators import checks, merge, profile, relational
from ..sources import pages as src
from ..sources import batches
from ..sources.batches import work_dir
from ..sources.pages import IntegrityError
from ..streaming import cdc, latest, watermark
from .adapters import CTE, Portfolio
from .registry import query, stored

PAGE = 500
RESOURCE, RUN = "siniestros", "run1"


def capture(p: Portfolio) -> DataFrame:
    """page_number, source_file, body; at most PAGE records are gathered into one."""
    share_code(p.spark)
    value = F.when(F.col("event_id") % 97 == 0, "@NaN@").otherwise(F.col("value").cast("string"))
    extra = F.when((F.col("event_id") % (10 * PAGE) == 0) & (F.col("event_id") > 0), F.lit("x"))
    record = F.to_json(F.struct(F.col("event_id").cast("string").alias("claim_id"), F.col("event_type").alias("status"), value.alias("value"), extra.alias("extra"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("updated_at")))
    record = F.when(F.col("event_id") % 211 == 0, F.concat(F.lit('"'), F.col("event_type"), F.lit('"'))).otherwise(record)
    df = p.table("events").select((F.floor(F.col("event_id") / PAGE) + 1).alias("page_number"), F.struct(F.col("event_id").alias("i"), record.alias("r")).alias("r"))
    rows = F.transform(F.sort_array(F.collect_list("r")), lambda r: r["r"])
    body = F.concat(F.lit('{"data":['), F.regexp_replace(F.array_join(rows, ","), '"@NaN@"', "NaN"), F.lit("]}"))
    df = df.groupBy("page_number").agg(body.alias("body"))
    return df.withColumn("source_file", F.format_string(f"{RESOURCE}/page-%06d.json.gz", "page_number"))


def manifest(p: Portfolio) -> DataFrame:
    """A row per page; page 3 has another digest, page 5 one row less, page 7 isn't listed, page 999999 isn't there."""
    counts = p.table("events").groupBy((F.floor(F.col("event_id") / PAGE) + 1).alias("page_number")).agg(F.count(F.lit(1)).alias("rows_received"))
    df = capture(p).select("page_number", F.sha2("body", 256).alias("response_sha256")).join(counts, "page_number")
    df = df.withColumn("response_sha256", F.when(F.col("page_number") == 3, "0").otherwise(F.col("response_sha256")))
    df = df.withColumn("rows_received", F.col("rows_received") - (F.col("page_number") == 5).cast("long")).where("page_number <> 7")
    gone = p.spark.range(1).select(F.lit(999999).cast("long").alias("page_number"), F.lit("0").alias("response_sha256"), F.lit(1).cast("long").alias("rows_received"))
    return df.unionByName(gone).withColumns({"resource": F.lit(RESOURCE), "saved_at": F.lit("2024-01-05T10:00:00Z")})


def records(p: Portfolio) -> DataFrame:
    return src.parse_pages(capture(p), RESOURCE)


def raw(p: Portfolio) -> DataFrame:
    return src.to_raw(records(p), manifest(p), RUN, RESOURCE)


_PAGE = f"(event_id // {PAGE} + 1)"
_INDEX = f"(event_id % {PAGE})"


@query(f"SELECT CAST({_PAGE} AS BIGINT) AS page_number, CAST({_INDEX} AS BIGINT) AS record_index, CASE WHEN event_id % 211 = 0 THEN NULL ELSE CAST(event_id AS VARCHAR) END AS source_key, event_id % 211 <> 0 AS is_object, CASE WHEN event_id % 211 = 0 THEN NULL ELSE event_type END AS status FROM events", None)
def pages_roundtrip(p):
    return records(p).select("page_number", "record_index", "source_key", "is_object", F.get_json_object("payload", "$.status").alias("status"))


@query(f"SELECT 'run1:siniestros:' || CAST({_PAGE} AS VARCHAR) AS batch_id, CAST({_INDEX} AS BIGINT) AS record_index, CASE WHEN {_PAGE} = 7 THEN NULL ELSE DATE '2024-01-05' END AS ingested_on, CASE WHEN event_id % 211 = 0 THEN NULL ELSE CAST(ts AS DATE) END AS source_updated_on FROM events", None)
def raw_envelope(p):
    return raw(p).select("batch_id", "record_index", F.to_date("ingested_at").alias("ingested_on"), F.to_date("source_updated_at").alias("source_updated_on"))


@query(f"SELECT * FROM (SELECT DISTINCT CAST({_PAGE} AS BIGINT) AS page_number, CASE {_PAGE} WHEN 3 THEN 'digest' WHEN 5 THEN 'rows' WHEN 7 THEN 'unexpected' END AS problem FROM events UNION ALL SELECT 999999, 'missing') x WHERE problem IS NOT NULL", None)
def page_integrity(p):
    return src.verify_pages(capture(p), manifest(p), records(p))


@query(f"SELECT CAST({_PAGE} AS BIGINT) AS page_number, CAST({_INDEX} AS BIGINT) AS record_index, CAST(event_id AS VARCHAR) AS source_key, '$.value' AS path, 'NaN' AS value FROM events WHERE event_id % 97 = 0 AND event_id % 211 <> 0", None)
def non_finite_ledger(p):
    return src.non_finite_ledger(records(p))


@query(f"SELECT CAST({_PAGE} AS BIGINT) AS page_number, CAST({_INDEX} AS BIGINT) AS record_index, sha256('\"' || event_type || '\"') AS fingerprint FROM events WHERE event_id % 211 = 0", None)
def quarantine_split(p):
    return src.quarantine(records(p))


@query(f"SELECT 'siniestros' AS resource, CAST({_PAGE} AS BIGINT) AS page_number, 'non_finite_number' AS error_class, 'pending' AS resolution_status, '$.value NaN' AS message FROM events WHERE event_id % 97 = 0 AND event_id % 211 <> 0 UNION ALL SELECT 'siniestros', CAST({_PAGE} AS BIGINT), 'unspecified', 'pending', 'quarantined' FROM events WHERE event_id % 211 = 0", None)
def error_ledger(p):
    r = records(p)
    errors = src.quarantine(r).select(F.lit(RESOURCE).alias("resource"), "page_number", F.lit("quarantined").alias("message"))
    return src.error_ledger(errors, src.non_finite_ledger(r), RUN, RESOURCE).select("resource", "page_number", "error_class", "resolution_status", "message")


@query(f"SELECT 'siniestros' AS resource, CAST({_PAGE} AS BIGINT) AS page_number, COUNT(*) AS rows, COUNT(*) AS positions, CAST(0 AS BIGINT) AS bad_metadata, COUNT(*) FILTER (event_id % 97 = 0 AND event_id % 211 <> 0) AS marked FROM events GROUP BY 2", None)
def page_stats(p):
    return src.page_stats(raw(p))


_NAN = "event_id % 97 = 0 AND event_id % 211 <> 0"


@query(f"""WITH g AS (SELECT {_PAGE} AS page, COUNT(*) AS n FROM events GROUP BY 1),
  f AS (SELECT (SELECT COUNT(*) FROM events) AS rows, (SELECT COUNT(*) FROM g) AS pages, 1 + SUM(n - CASE page WHEN 5 THEN 1 ELSE 0 END) FILTER (page <> 7) AS want_rows, 1 + COUNT(*) FILTER (page <> 7) AS want_pages,
    1 + COUNT(*) FILTER (page = 5) AS other, 1 + COUNT(*) FILTER (page = 7) AS inventory, (SELECT COUNT(*) FROM events WHERE {_NAN}) AS marked, (SELECT COUNT(*) FROM events WHERE {_NAN} AND {_PAGE} <> 3) AS logged,
    (SELECT COUNT(*) FROM events WHERE event_id % 211 = 0) AS errors FROM g),
  c AS (SELECT unnest(['siniestros', 'siniestros', 'siniestros', 'siniestros', 'siniestros', 'siniestros', 'all', 'all', 'all']) AS resource, unnest(['ROWS', 'PAGES', 'PAGE_COUNTS', 'REPEATED_POSITIONS', 'BAD_METADATA', 'NON_FINITE_MARKERS', 'PAGE_INVENTORY', 'INGESTION_RUNS_ROWS', 'INGESTION_ERRORS_ROWS']) AS check_name,
    unnest([CAST(want_rows AS BIGINT), want_pages, 0, 0, 0, logged, 0, 1, errors + 1]) AS expected, unnest([rows, pages, other, 0, 0, marked, inventory, 1, errors]) AS actual FROM f)
  SELECT *, expected = actual AS passed FROM c""", None)
def raw_reconciliation(p):
    """A page of other rows, one unexpected and one missing, markers of a page that weren't logged, and an error too few."""
    r = records(p)
    logged = src.non_finite_ledger(r).where("page_number <> 3").agg(F.lit(RESOURCE).alias("resource"), F.count(F.lit(1)).alias("marked"))
    errors = src.quarantine(r).agg(F.lit("ingestion_errors").alias("table"), (F.count(F.lit(1)) + 1).alias("expected"), F.count(F.lit(1)).alias("actual"))
    runs = p.spark.range(1).select(F.lit("ingestion_runs").alias("table"), F.lit(1).alias("expected"), F.lit(1).alias("actual"))
    return src.verify_raw(raw(p), manifest(p), logged, errors.unionByName(runs))


@query(f"""SELECT 'siniestros' AS resource, CAST(1 + SUM(n - CASE page WHEN 5 THEN 1 ELSE 0 END) FILTER (page <> 7) AS BIGINT) AS rows, 'UNKNOWN' AS audit_status, 1 + COUNT(*) FILTER (page IN (5, 7)) AS pages_of_other_rows,
    (SELECT COUNT(*) FROM events WHERE {_NAN}) AS encoded, (SELECT COUNT(*) FROM events WHERE {_NAN} AND {_PAGE} <> 3) AS logged FROM (SELECT {_PAGE} AS page, COUNT(*) AS n FROM events GROUP BY 1) g""", None)
def page_records(p):
    """Rows of the pages against records, marked numbers against logged ones."""
    r = records(p).withColumn("resource", F.lit(RESOURCE))
    m = manifest(p).withColumn("total", F.lit(None).cast("long"))
    logged = src.non_finite_ledger(records(p)).where("page_number <> 3").withColumn("resource", F.lit(RESOURCE))
    return src.audit_totals(m, r, logged).select("resource", "rows", "audit_status", "pages_of_other_rows", "encoded", "logged")


@query(f"SELECT CAST({_PAGE} AS BIGINT) AS page_number, CAST({_INDEX} AS BIGINT) AS record_index, sha256('\"' || event_type || '\"') AS record_hash FROM events WHERE event_id % 211 = 0", None)
def record_hashes(p):
    """Of the records whose canonical text SQL can write; the others are tested against Python's."""
    return records(p).where("NOT is_object").select("page_number", "record_index", "record_hash")


@query(f"SELECT CAST({_PAGE} AS BIGINT) AS page_number, CASE WHEN event_id % 211 = 0 THEN 'not an object' WHEN event_id % {10 * PAGE} = 0 AND event_id > 0 THEN 'claim_id,extra,status,updated_at,value' ELSE 'claim_id,status,updated_at,value' END AS shape, COUNT(*) AS records FROM events GROUP BY 1, 2", None)
def shape_profile(p):
    return src.shape_summary(records(p))


@query(f"""WITH e AS (SELECT CAST({_PAGE} AS BIGINT) AS page_number, event_id % 211 <> 0 AS o, event_id % 97 = 0 AS nan, event_id % {10 * PAGE} = 0 AND event_id > 0 AS ex FROM events)
  SELECT MIN(page_number) AS page_number, 'new_shape' AS drift, 'claim_id,extra,status,updated_at,value' AS what FROM e WHERE o AND ex HAVING COUNT(*) > 0
  UNION ALL SELECT page_number, 'mixed_types', 'value' FROM e WHERE o GROUP BY 1 HAVING COUNT(*) FILTER (nan) > 0 AND COUNT(*) FILTER (NOT nan) > 0""", None)
def shape_drift(p):
    return src.schema_drift(records(p))


#: A field of each type by the order's number, an object with the same field names, and a string that looks like an object.
_SIX = """(SELECT o_orderkey % 50 + 1 AS page_number, unnest(['k', 'a', 'b', 'c', 'd', 'e']) AS field, unnest([CASE o_orderkey % 3 WHEN 0 THEN 'number' ELSE 'string' END, 'number', 'object', 'string', 'array', CASE WHEN o_orderkey % 2 = 0 THEN 'boolean' ELSE 'null' END]) AS type FROM orders)"""


def _six_types(p: Portfolio) -> DataFrame:
    key = F.col("o_orderkey")
    text = lambda *parts: F.concat(*(F.lit(x) if isinstance(x, str) else x.cast("string") for x in parts))
    k = F.when(key % 3 == 0, text(key)).otherwise(text('"', key, '"'))
    e = F.when(key % 2 == 0, "true").otherwise("null")
    body = text('{"k":', k, ',"a":', key, '.5,"b":{"a":"x","k":[1,{"c":null}]},"c":"{not json \\\\","d":["{",', key, '],"e":', e, "}")
    return p.table("orders").select((key % 50 + 1).alias("page_number"), F.lit(True).alias("is_object"), body.alias("payload"))


@query(f"SELECT CAST(page_number AS BIGINT) AS page_number, field, type, COUNT(*) AS values FROM {_SIX} x GROUP BY 1, 2, 3", None)
def field_type_counts(p):
    return src.field_type_counts(_six_types(p)).withColumn("page_number", F.col("page_number").cast("long"))


@query(f"""SELECT CAST(page_number AS BIGINT) AS page_number, 'mixed_types' AS drift, field AS what FROM {_SIX} x WHERE type <> 'null' GROUP BY 1, 3 HAVING COUNT(DISTINCT type) > 1
  UNION ALL SELECT CAST(MIN(page_number) AS BIGINT), 'new_type', field || ' ' || type FROM {_SIX} x WHERE type <> 'null' GROUP BY field, type
    HAVING MIN(page_number) > (SELECT MIN(page_number) FROM {_SIX} y WHERE y.field = x.field AND y.type <> 'null')""", None)
def type_drift(p):
    return src.schema_drift(_six_types(p)).withColumn("page_number", F.col("page_number").cast("long"))


#: Pages of 50 events by offset, and as many by cursor, with a break of each kind at every page whose number has the given rest by 40.
_BROKEN = """(SELECT event_id // 50 + 1 AS page_number, COUNT(*) AS n FROM events GROUP BY 1)"""
_AT = "CAST(page_number AS BIGINT) AS page_number"
_LAST = f"(SELECT MAX(page_number) FROM {_BROKEN} z)"


def _offsets(p: Portfolio) -> DataFrame:
    """Pages by offset (resource siniestros) with short, jumping, oversize pages and changed limits and totals, and pages by cursor (polizas)."""
    df = p.table("events").groupBy((F.floor(F.col("event_id") / 50) + 1).alias("page_number")).agg(F.count(F.lit(1)).alias("n"))
    page = F.col("page_number")
    at = lambda k: page % 40 == k
    null = lambda t: F.lit(None).cast(t)
    by_offset = {
        "resource": F.lit(RESOURCE), "request_offset": (page - 1) * 50, "rows_received": F.when(at(4), 49).when(at(8), 51).otherwise(F.col("n")), "limit": F.when(at(12), 49).otherwise(50),
        "total": F.when(at(16), 1).otherwise(10**9), "request_cursor": null("string"), "next_cursor": null("string"), "has_more": null("boolean"),
    }
    cursor = lambda x: F.concat(F.lit("c"), x.cast("string"))
    by_cursor = {
        "resource": F.lit("polizas"), "request_offset": null("long"), "rows_received": F.when(at(4), 0).otherwise(F.col("n")), "limit": null("int"), "total": null("int"),
        "request_cursor": F.when(at(8), cursor(page - 1)).otherwise(cursor(page)), "next_cursor": F.when(~at(12), cursor(page + 1)), "has_more": F.lit(True),
    }
    return df.withColumns(by_offset).drop("n").unionByName(df.withColumns(by_cursor).drop("n"))


@query(f"""SELECT 'siniestros' AS resource, {_AT}, problem FROM (SELECT page_number, unnest([
    CASE WHEN page_number % 40 IN (5, 9) OR (page_number > 1 AND page_number % 40 NOT IN (5, 9) AND (SELECT n FROM {_BROKEN} y WHERE y.page_number = x.page_number - 1) <> 50) THEN 'offset_jump' END,
    CASE WHEN page_number % 40 IN (12, 13) THEN 'limit_changed' END, CASE WHEN page_number % 40 IN (16, 17) THEN 'total_changed' END,
    CASE WHEN page_number < {_LAST} AND (page_number % 40 = 4 OR (n < 50 AND page_number % 40 NOT IN (4, 8, 12))) THEN 'short_page' END,
    CASE WHEN page_number % 40 IN (8, 12) THEN 'oversize_page' END]) AS problem FROM {_BROKEN} x) a WHERE problem IS NOT NULL
  UNION ALL SELECT 'polizas', {_AT}, problem FROM (SELECT page_number, unnest([
    CASE WHEN page_number % 40 = 7 AND page_number < {_LAST} OR page_number % 40 = 8 THEN 'repeated_cursor' END, CASE WHEN page_number % 40 = 12 THEN 'more_without_cursor' END,
    CASE WHEN page_number % 40 = 4 THEN 'empty_with_more' END, CASE WHEN page_number % 40 IN (8, 13) THEN 'cursor_jump' END]) AS problem FROM {_BROKEN} x) b WHERE problem IS NOT NULL""", None)
def page_continuity(p):
    """All nine breaks, in every fortieth page or so."""
    return src.audit_pages(_offsets(p))


@query(f"""SELECT 'siniestros' AS resource, 'PARTIAL' AS audit_status, CAST(SUM(CASE page_number % 40 WHEN 4 THEN 49 WHEN 8 THEN 51 ELSE n END) AS BIGINT) AS rows FROM {_BROKEN} x
  UNION ALL SELECT 'polizas', 'UNKNOWN', CAST(SUM(CASE page_number % 40 WHEN 4 THEN 0 ELSE n END) AS BIGINT) FROM {_BROKEN} x""", None)
def page_totals(p):
    return src.audit_totals(_offsets(p)).select("resource", "audit_status", F.col("rows").cast("long").alias("rows"))


@query(f"SELECT DISTINCT CAST({_PAGE} AS BIGINT) AS page_number, 'unexpected' AS side FROM events WHERE {_PAGE} = 7 UNION ALL SELECT 999999, 'missing'", None)
def page_inventory_diff(p):
    return relational.inventory_diff(capture(p), manifest(p), ["page_number"])


@query("SELECT CASE WHEN COUNT(*) FILTER (event_id % 211 = 0) > 0 THEN 'SUCCESS_WITH_QUARANTINE' ELSE 'SUCCESS' END AS run_status FROM events", None)
def run_status(p):
    state = F.when(F.count_if(~F.col("is_object")) > 0, "SUCCESS_WITH_QUARANTINE").otherwise("SUCCESS").alias("status")
    return src.run_status(records(p).groupBy("page_number").agg(state))


@query("SELECT 'siniestros' AS resource, COUNT(*) AS rows, CAST(0 AS BIGINT) AS foreign_rows, DATE '2024-01-05' AS first_day FROM events", None)
def batch_parameters(p):
    return src.batch_parameters(raw(p), RUN).select("resource", "rows", "foreign_rows", "first_day")


@query(f"SELECT CAST({_PAGE} AS BIGINT) AS page_number, CAST({_INDEX} AS BIGINT) AS record_index FROM events WHERE {_PAGE} % 2 = 1", None)
def resource_split(p):
    """Rows of the even pages are in the resource's own table already."""
    df = raw(p)
    return src.split_by_resource(df, df.where("page_number % 2 = 0"), RESOURCE).select("page_number", "record_index")


@query(f"SELECT CAST({_PAGE} AS BIGINT) AS page_number, COUNT(*) AS rows FROM events WHERE {_PAGE} <> 7 GROUP BY 1", None)
def raw_partition_read(p):
    """Written by day, resource and run, twice; read back by day, resource and run."""
    path = work_dir(p.spark, "raw")
    for _ in range(2):
        src.write_raw(raw(p).where("ingested_at IS NOT NULL"), path)
    return src.read_raw(p.spark, path, RUN, "2024-01-05", "2024-01-05", RESOURCE).groupBy("page_number").agg(F.count(F.lit(1)).alias("rows"))


@query(f"SELECT 'siniestros' AS resource, TIMESTAMP '2024-01-05 10:00:00' AS captured_at FROM (SELECT COUNT(*) FROM events) x", None)
def capture_times(p):
    runs = p.spark.range(1).select(F.lit("2024-01-06").cast("timestamp").alias("finished_at"))
    return merge.capture_times(raw(p), runs, [RESOURCE]).select("resource", F.col("captured_at").cast("timestamp_ntz").alias("captured_at"))


@query("SELECT CAST(user_id AS VARCHAR) AS run_id, 'SUCCESS' AS run_status, COUNT(*) AS history_rows, CAST(NULL AS BIGINT) AS active_rows, CAST(NULL AS BIGINT) AS claim_rows FROM events GROUP BY 1", None)
def silver_status(p):
    n = p.table("events").groupBy("user_id").agg(F.count(F.lit(1)).alias("history_rows"), F.max("ts").alias("started_at"))
    runs = n.select(F.col("user_id").cast("string").alias("run_id"), F.lit("SUCCESS").alias("run_status"), "started_at", F.to_json(F.struct("history_rows")).alias("summary"))
    return profile.silver_status(runs, "2000-01-01")


@query("SELECT o_orderkey, o_orderpriority, o_orderstatus FROM orders", None)
def ndjson_roundtrip(p):
    """Written as lines of JSON, nulls included, and read back."""
    path = work_dir(p.spark, "ndjson")
    df = p.table("orders").select("o_orderkey", "o_orderpriority", "o_orderstatus")
    src.write_ndjson(df, path)
    return p.spark.read.schema(df.schema).json(path)


@query("SELECT strftime(o_orderdate, '%Y-%m') AS month, COUNT(*) AS rows FROM orders WHERE o_orderdate >= DATE '1997-01-01' AND o_orderdate < DATE '1997-04-01' GROUP BY 1", None)
def layout_months(p):
    """A folder per month; three of them are read back."""
    path = work_dir(p.spark, "layout")
    src.write_layout(p.table("orders"), path, "o_orderdate", ["o_custkey"])
    return p.spark.read.parquet(path).where("month BETWEEN '1997-01' AND '1997-03'").groupBy(F.date_format("o_orderdate", "yyyy-MM").alias("month")).agg(F.count(F.lit(1)).alias("rows"))


@query(f"SELECT 'run1' AS run_id, 'full' AS invocation_mode, 1 + COUNT(*) FILTER (page <> 7) AS http_requests, CAST(1 + SUM(n - CASE page WHEN 5 THEN 1 ELSE 0 END) FILTER (page <> 7) AS BIGINT) AS rows FROM (SELECT {_PAGE} AS page, COUNT(*) AS n FROM events GROUP BY 1) g", None)
def run_record(p):
    return src.run_record(manifest(p), RUN, bounded=False).select("run_id", "invocation_mode", "http_requests", "rows")


_STATE_SQL = "SELECT user_id, MAX(ts) FILTER (event_id % 2 = 0) AS old, MAX(ts) FILTER (event_id % 3 = 0) AS new FROM events GROUP BY 1"


@query(f"SELECT CAST(user_id AS VARCHAR) AS resource, CASE WHEN old IS NULL OR new > old THEN new ELSE old END AS captured_at, CASE WHEN new >= coalesce(old, TIMESTAMP '1970-01-01') THEN 'run2' ELSE 'run1' END AS run_id FROM ({_STATE_SQL}) x WHERE old IS NOT NULL OR new IS NOT NULL", None)
def state_forward(p):
    """A user's latest event of two halves as the captured times of two runs."""
    latest = lambda n: p.table("events").where(F.col("event_id") % n == 0).groupBy(F.col("user_id").cast("string").alias("resource")).agg(F.max(F.col("ts").cast("timestamp")).alias("captured_at"))
    df = merge.advance_state(latest(2).withColumn("run_id", F.lit("run1")), latest(3), "run2")
    return df.withColumn("captured_at", F.col("captured_at").cast("timestamp_ntz"))


def _event_stream(p: Portfolio) -> DataFrame:
    """The events, a fifth of them twice, as a stream of files."""
    source, df = work_dir(p.spark, "events-in"), p.table("events").select("event_id", "user_id", F.col("ts").cast("timestamp").alias("ts"), "event_type")
    df.unionByName(df.where("event_id % 5 = 0")).repartition(4).write.parquet(source)
    return p.spark.readStream.schema(df.schema).parquet(source)


@query("SELECT event_id, user_id, event_type FROM events", None)
def stream_deduplicated(p):
    """An overlap longer than the table, as files come in any order."""
    out = work_dir(p.spark, "events-out")
    once = cdc.deduplicated(_event_stream(p), ["event_id"], "ts", "36500 days").select("event_id", "user_id", "event_type")
    stream = once.writeStream.format("parquet").option("path", out).option("checkpointLocation", work_dir(p.spark, "events-check"))
    stream.trigger(availableNow=True).start().awaitTermination()
    return p.spark.read.schema(once.schema).parquet(out)


@query("SELECT user_id, MAX(ts) AS ts FROM events GROUP BY 1 HAVING CAST(floor(epoch(MAX(ts))) AS BIGINT) % 5 <> 0", None)
def stream_latest_state(p):
    """Three batches in no order of time; an event at a second that five divides deletes its user until a later one comes."""
    source, out = work_dir(p.spark, "latest-in"), work_dir(p.spark, "latest-out")
    df = p.table("events").select("user_id", F.col("ts").cast("timestamp").alias("ts"), "event_type")
    for k in range(3):
        df.where(F.pmod("event_id", F.lit(3)) == k).coalesce(1).write.mode("append").parquet(source)
    stream = p.spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(source)
    changes = latest.latest_changes(stream, "user_id", "ts", "CAST(floor(unix_micros(ts) / 1000000) AS BIGINT) % 5 = 0")
    latest.write_changes(changes, out, work_dir(p.spark, "latest-check")).awaitTermination()
    return latest.read_latest(p.spark, out, changes.schema, "user_id").select("user_id", F.col("ts").cast("timestamp_ntz").alias("ts"))


_CUTS = ["1994-01-01", "1996-01-01", "1996-01-04", "2003-01-01"]
_SEEN = " ".join(f"WHEN updated_on <= DATE '{c}' - CASE WHEN policy_id % 7 = 0 THEN 5 ELSE 0 END THEN {k}" for k, c in enumerate(_CUTS))


@query(f"SELECT policy_id, updated_on, op, CAST(CASE {_SEEN} END AS BIGINT) AS batch FROM history")
def watermark_runs(p):
    """Four reads of a growing source; a seventh of its events come five days late, and the third read fails before it is applied and comes again."""
    df = p.history.select("policy_id", "op", "premium", "updated_on")
    delta = watermark.Delta(p.spark, work_dir(p.spark, "delta"), "policies", df.schema, "updated_on", ["policy_id", "op"], 10 * 86400)

    def fail(written):
        raise IntegrityError("not this time")

    for k, cut in enumerate(_CUTS):
        late = F.when(F.col("policy_id") % 7 == 0, 5).otherwise(0)
        source = df.where(F.date_add("updated_on", late) <= F.lit(cut).cast("date"))
        if k == 2:
            try:
                delta.run(source, fail)
            except IntegrityError:
                pass
        delta.run(source)
    return delta.applied().select("policy_id", "updated_on", "op", "batch")


@query("SELECT policy_id, client_id, CAST(premium AS DOUBLE) AS premium, status, op, updated_on FROM active", CTE)
def cdc_stream(p):
    """All events in three files, later ones first within a policy's reach, applied by the stream."""
    path, source, schema, history = work_dir(p.spark, "cdc"), work_dir(p.spark, "cdc-in"), p.history.schema, stored(p, "history", p.history)
    for part in ("op = 'I'", "op = 'D'", "op = 'U'"):
        history.where(part).write.mode("append").parquet(source)
        if part != "op = 'D'":  # a stream each for the first file and the rest, the second on a new checkpoint
            stream = p.spark.readStream.schema(schema).option("maxFilesPerTrigger", 1000).parquet(source)
            cdc.start_cdc_stream(stream, path, work_dir(p.spark, "cdc-check")).awaitTermination()
    return cdc.active(p.spark, path, schema).select("policy_id", "client_id", F.col("premium").cast("double").alias("premium"), "status", "op", "updated_on")


@query("SELECT policy_id, op FROM history WHERE op <> 'D'", CTE)
def raw_append_once(p):
    """Two loads, one of them twice, and a third that broke off before its receipt."""
    path, df = work_dir(p.spark, "append"), p.history.select("policy_id", "op")
    for op in ("I", "I", "U"):
        batches.append_raw(df.where(F.col("op") == op), path, op)
    df.where("op = 'D'").write.parquet(f"{path}/rows/load=broken")
    return batches.read_loads(p.spark, path, "policy_id long, op string")


@query("SELECT c_custkey, c_name, 'r2' AS run_id, CAST(1 AS BIGINT) AS failures, FALSE AS again FROM customer WHERE c_custkey % 2 = 0", None)
def published_after_checks(p):
    """Three runs replace a table; the last one's check fails, so the second one's stays; the second comes again and is skipped."""
    path, c = work_dir(p.spark, "published"), p.table("customer").select("c_custkey", "c_name")

    def at_least_one(written):
        if not written["customers"].take(1):
            raise IntegrityError("no rows")

    for run, part in (("r1", "c_custkey % 3 = 0"), ("r2", "c_custkey % 2 = 0"), ("r3", "c_custkey < 0")):
        try:
            batches.apply_run(p.spark, path, run, {"customers": c.where(part).withColumn("run_id", F.lit(run))}, at_least_one, fingerprint=run)
        except IntegrityError:
            pass
    again = batches.apply_run(p.spark, path, "r4", {"customers": c}, at_least_one, fingerprint="r2")
    failed = batches.runs(p.spark, path).where("run_status = 'FAILED'").agg(F.count(F.lit(1)).alias("failures"))
    return batches.read_published(p.spark, path, "customers").join(failed).withColumn("again", F.lit(again))


@query(f"""WITH n AS (SELECT COUNT(*) AS rows, COUNT(DISTINCT {_PAGE}) AS pages, MAX(ts) AS last FROM events)
  SELECT unnest(['cloned rows', 'loaded as expected', 'loaded short', 'same batch', 'changed batch', 'contract', 'contract without ids', 'fresh', 'stale', 'stale change feed']) AS guard,
    unnest([rows, CAST(rows = rows AS BIGINT), CAST(rows = rows + 1 AS BIGINT), CAST(pages > 0 AS BIGINT), CAST(pages < 5 AS BIGINT), 1, 0, CAST(last >= last AS BIGINT), CAST(last - INTERVAL 1 DAY >= last AS BIGINT), 1]) AS value FROM n""", None)
def load_guards(p):
    """The guards of loads, clones, captures under one run id, schemas and capture times, each where it holds and where it doesn't."""

    def holds(f, *args, **more) -> int:
        try:
            f(*args, **more)
        except (IntegrityError, checks.ChecksFailed):
            return 0
        return 1

    events = p.table("events").withColumn("resource", F.lit(RESOURCE))
    facts = events.agg(F.count(F.lit(1)).alias("rows"), F.max("ts").alias("last")).first()
    source, copy = work_dir(p.spark, "clone"), work_dir(p.spark, "clone")
    events.write.parquet(source)
    pages, dtypes = manifest(p), events.dtypes
    changed = pages.withColumn("rows_received", F.col("rows_received") + (F.col("page_number") == 5).cast("long"))
    day = F.expr("interval 1 day")
    before = p.spark.range(1).select((F.lit(facts["last"]) - day).alias("t")).first()["t"]
    values = {
        "cloned rows": src.clone_table(p.spark, source, copy), "loaded as expected": int(batches.verify_loaded(events, {RESOURCE: facts["rows"]})), "loaded short": int(batches.verify_loaded(events, {RESOURCE: facts["rows"] + 1})),
        "same batch": holds(src.assert_same_batch, pages, pages), "changed batch": holds(src.assert_same_batch, pages, changed), "contract": holds(checks.assert_contract, events, dtypes),
        "contract without ids": holds(checks.assert_contract, events, dtypes, forbid_ids=True), "fresh": int(merge.is_fresh(RESOURCE, facts["last"], {RESOURCE: facts["last"]})),
        "stale": int(merge.is_fresh(RESOURCE, before, {RESOURCE: facts["last"]})), "stale change feed": int(merge.is_fresh("policies", before, {"policies": facts["last"]})),
    }
    return p.spark.createDataFrame(list(values.items()), "guard string, value long")
