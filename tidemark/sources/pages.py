"""Paged JSON captures: reading, proof of integrity, envelope, quarantine, drift.

A capture is one gzip text file per page, ``{"data": [...], "meta" or "pagination": {...}}``,
and a manifest with a row per page.  Pages are of bounded size (the API's limit),
so a page is parsed by one Arrow task at a time; everything after it is columns.
"""

from __future__ import annotations

import hashlib
import json
import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.expr import KEY_SEPARATOR, norm_ts, utc_date
from ..functions.variants import NON_FINITE, kind_of, members
from ..operators.ranges import with_previous_in_order
from .batches import work_dir

#: Key fields of each resource (fixed values).
SOURCE_KEYS = {"polizas": ["poliza_id"], "siniestros": ["claim_id"], "agencias": ["agencia_id"], "productos": ["producto_id"], "tipo_cambio": ["fecha", "moneda"]}
RAW_COLUMNS = ["ingested_at", "run_id", "batch_id", "resource", "snapshot_id", "page_number", "record_index", "source_key", "source_updated_at", "record_hash", "source_file", "payload"]
RECORDS = "source_file string, page_number long, record_index long, is_object boolean, source_key string, updated_at string, record_hash string, payload string, issues array<struct<path:string,value:string>>"
_ITEM = pa.struct([("path", pa.string()), ("value", pa.string())])
_SCHEMA = pa.schema(
    [("source_file", pa.string()), ("page_number", pa.int64()), ("record_index", pa.int64()), ("is_object", pa.bool_()), ("source_key", pa.string()), ("updated_at", pa.string()), ("record_hash", pa.string()), ("payload", pa.string()), ("issues", pa.list_(_ITEM))]
)


class IntegrityError(Exception):
    """A capture doesn't match its manifest."""


# ---- files


def read_page_files(spark: SparkSession, folder: str, resource: str) -> DataFrame:
    """source_file, page_number and body of every page file of a resource."""
    df = spark.read.text(f"{folder}/{resource}", wholetext=True, pathGlobFilter="page-*.json.gz").withColumn("path", F.input_file_name())
    number = F.regexp_extract("path", r"page-(\d+)\.json\.gz$", 1).try_cast("long")
    return df.select(F.regexp_extract("path", r"([^/]+/page-\d+\.json\.gz)$", 1).alias("source_file"), number.alias("page_number"), F.col("value").alias("body"))


def page_manifest(spark: SparkSession, path: str) -> DataFrame:
    """A row per page of a run's manifest: resource and the page's fields."""
    runs = spark.read.json(path, multiLine=True)
    resources = F.map_entries(F.from_json(F.to_json("resources"), "map<string,struct<pages:array<struct<page_number:long,rows_received:long,response_sha256:string,saved_at:string,raw_file:string,request_cursor:string,next_cursor:string,has_more:boolean,request_offset:long,limit:long,total:long>>>>"))
    pages = runs.select("run_id", F.explode(resources).alias("r")).select("run_id", F.col("r.key").alias("resource"), F.explode("r.value.pages").alias("p"))
    return pages.select("run_id", "resource", "p.*")


def verify_pages(pages: DataFrame, manifest: DataFrame, records: DataFrame) -> DataFrame:
    """Pages that don't match: missing, unexpected, of another digest, or of another number of rows."""
    counted = records.groupBy("page_number").agg(F.count(F.lit(1)).alias("_rows"))
    found = pages.select("page_number", F.sha2("body", 256).alias("_sha")).join(counted, "page_number", "left")
    both = manifest.select("page_number", "response_sha256", "rows_received").withColumn("_m", F.lit(True)).join(found, "page_number", "full")
    problem = (
        F.when(F.col("_sha").isNull(), "missing").when(F.col("_m").isNull(), "unexpected").when(F.col("_sha") != F.col("response_sha256"), "digest")
        .when(F.coalesce("_rows", F.lit(0)) != F.col("rows_received"), "rows")
    )
    return both.select("page_number", problem.alias("problem")).where("problem IS NOT NULL")


def assert_pages(pages: DataFrame, manifest: DataFrame, records: DataFrame) -> None:
    if bad := verify_pages(pages, manifest, records).orderBy("page_number").take(5):
        raise IntegrityError(", ".join(f"page {r['page_number']}: {r['problem']}" for r in bad))


# ---- records


def written(record) -> tuple[str, list[tuple[str, str]]]:
    """A record in canonical text (keys in order, no spaces, letters as they are), and the numbers in it that JSON can't write.

    Those become objects of one marker key; they are listed with their paths.
    An explicit stack holds what is still to be written, so depth is no limit.
    """
    text, ledger = [], []
    todo: list = [("$", record)]
    while todo:
        at, value = todo.pop()
        if at is None:  # punctuation
            text.append(value)
        elif isinstance(value, dict | list):
            keyed = isinstance(value, dict)
            members = [(f"{at}.{k}", value[k], json.dumps(k, ensure_ascii=False) + ":") for k in sorted(value)] if keyed else [(f"{at}[{i}]", v, "") for i, v in enumerate(value)]
            todo.append((None, "}" if keyed else "]"))
            for i, (where, member, label) in reversed([*enumerate(members)]):
                todo += [(where, member), (None, ("," if i else "") + label)]
            text.append("{" if keyed else "[")
        elif isinstance(value, float) and not math.isfinite(value):
            name = {math.inf: "Infinity", -math.inf: "-Infinity"}.get(value, "NaN")
            ledger.append((at, name))
            text.append(f'{{"{NON_FINITE}":"{name}"}}')
        else:
            text.append(json.dumps(value, ensure_ascii=False))
    return "".join(text), ledger


#: Records that a task holds parsed at a time, beside one page's.
RECORDS_AT_ONCE = 2_000
#: The same text as ``written`` for what JSON can write; it refuses numbers that aren't finite.
_PLAIN = json.JSONEncoder(ensure_ascii=False, allow_nan=False, sort_keys=True, separators=(",", ":"))


def _written(record) -> tuple[str, list[tuple[str, str]]]:
    try:
        return _PLAIN.encode(record), []
    except (ValueError, RecursionError):
        return written(record)


def page_records(body: str, keys: list[str]) -> Iterator[tuple]:
    """A page's records one by one: index, whether an object, key, time of change, hash, payload, non-finite numbers."""
    for i, record in enumerate(json.loads(body)["data"]):
        text, issues = _written(record)
        is_object = isinstance(record, dict)
        parts = [record.get(k) for k in keys] if is_object else [None]
        key = KEY_SEPARATOR.join(map(str, parts)) if parts and None not in parts else None
        at = record.get("updated_at") if is_object else None
        yield i, is_object, key, at if isinstance(at, str) else None, hashlib.sha256(text.encode()).hexdigest(), text, [{"path": p, "value": v} for p, v in issues]


def record_batches(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.RecordBatch]:
    """Records of batches of pages, given on some thousand at a time: a batch of pages is never held parsed."""
    rows: list[tuple] = []

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows), _SCHEMA.types)], schema=_SCHEMA)

    for b in batches:
        for file, number, body in zip(*b.columns):
            at = file.as_py(), number.as_py()
            for record in page_records(body.as_py(), keys):
                rows.append((*at, *record))
                if len(rows) >= RECORDS_AT_ONCE:
                    yield out()
                    rows.clear()
    if rows:
        yield out()


def parse_pages(pages: DataFrame, resource: str) -> DataFrame:
    """A row per record, in the page's order, with key, hash, payload and non-finite numbers.

    Records that aren't objects are kept and marked; a page that isn't JSON fails the run.
    A task's memory is that of the pages of one Arrow batch as text and of one page parsed.
    """
    keys = SOURCE_KEYS.get(resource, [])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return record_batches(batches, keys)

    return pages.select("source_file", "page_number", "body").mapInArrow(run, RECORDS)


def to_raw(records: DataFrame, manifest: DataFrame, run_id: str, resource: str) -> DataFrame:
    """The raw envelope of twelve columns; the page's save time is the time of ingestion."""
    pages = manifest.select("page_number", norm_ts("saved_at").alias("ingested_at"))
    return records.join(pages, "page_number", "left").select(
        "ingested_at", F.lit(run_id).alias("run_id"), F.concat_ws(":", F.lit(run_id), F.lit(resource), F.col("page_number").cast("string")).alias("batch_id"), F.lit(resource).alias("resource"),
        F.lit(run_id).alias("snapshot_id"), "page_number", "record_index", "source_key", norm_ts("updated_at").alias("source_updated_at"), "record_hash", "source_file", "payload",
    )


def non_finite_ledger(records: DataFrame) -> DataFrame:
    return records.select("page_number", "record_index", "source_key", F.explode("issues").alias("i")).select("page_number", "record_index", "source_key", "i.path", "i.value")


def quarantine(records: DataFrame) -> DataFrame:
    """Records that aren't objects, with position and fingerprint; they stay in raw too."""
    return records.where("NOT is_object").select("page_number", "record_index", F.sha2("payload", 256).alias("fingerprint"))


ERROR_COLUMNS = ["created_at", "run_id", "resource", "batch_id", "page_number", "record_index", "source_key", "error_class", "message", "fingerprint_sha256", "source_file", "resolution_status"]


def error_ledger(errors: DataFrame, issues: DataFrame, run_id: str, resource: str) -> DataFrame:
    """Extraction errors and non-finite numbers in one schema; missing fields are null, unspecified or pending."""
    found = issues.select(F.lit(run_id).alias("run_id"), F.lit(resource).alias("resource"), "page_number", "record_index", "source_key", F.lit("non_finite_number").alias("error_class"), F.concat_ws(" ", "path", "value").alias("message"))
    both = errors.unionByName(found, allowMissingColumns=True)
    defaults = {"error_class": "unspecified", "resolution_status": "pending"}
    types = {"created_at": "timestamp", "page_number": "long", "record_index": "long"}
    col = lambda c: (F.col(c) if c in both.columns else F.lit(None)).cast(types.get(c, "string"))
    return both.select(*(F.coalesce(col(c), F.lit(defaults[c])).alias(c) if c in defaults else col(c).alias(c) for c in ERROR_COLUMNS))


def write_ndjson(df: DataFrame, path: str) -> None:
    df.write.mode("errorifexists").option("compression", "gzip").option("ignoreNullFields", "false").json(path)


# ---- raw tables


RAW_SCHEMA = """ingested_at timestamp, run_id string, batch_id string, resource string, snapshot_id string, page_number long, record_index long,
  source_key string, source_updated_at timestamp, record_hash string, source_file string, payload string, ingest_date date, part string"""


def write_raw(df: DataFrame, path: str, part: str = "all") -> None:
    """Partitioned by day, resource, run and part; rows take the place of the same part's, so a replay adds nothing
    and a later part of the run (named by its first page, say) leaves the ones before it."""
    out = df.withColumns({"ingest_date": utc_date("ingested_at"), "part": F.lit(part)}).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    out.partitionBy("ingest_date", "resource", "run_id", "part").parquet(path)


def read_raw(spark: SparkSession, path: str, run_id: str, first: str | None, last: str | None, resource: str | None = None) -> DataFrame:
    """Raw rows of a run within day bounds, which prune partitions; without bounds it is refused."""
    if not first or not last:
        raise ValueError("raw is read between two days only")
    df = spark.read.schema(RAW_SCHEMA).parquet(path).drop("part").where((F.col("ingest_date") >= F.lit(first).cast("date")) & (F.col("ingest_date") <= F.lit(last).cast("date")) & (F.col("run_id") == run_id))
    return df.where(F.col("resource") == resource) if resource else df


def batch_parameters(raw: DataFrame, run_id: str) -> DataFrame:
    """Per resource: first and last day, rows, and rows of another run."""
    day = F.to_date("ingested_at")
    return raw.groupBy("resource").agg(F.min(day).alias("first_day"), F.max(day).alias("last_day"), F.count(F.lit(1)).alias("rows"), F.count_if(F.col("run_id") != run_id).alias("foreign_rows"))


def split_by_resource(df: DataFrame, existing: DataFrame, resource: str) -> DataFrame:
    """Rows of a resource that its own table doesn't have, by run, page and position."""
    return df.where(F.col("resource") == resource).join(existing.select("run_id", "page_number", "record_index"), ["run_id", "page_number", "record_index"], "left_anti")


def clone_table(spark: SparkSession, source: str, target: str) -> int:
    """Copy and compare counts."""
    df = spark.read.parquet(source)
    df.write.mode("errorifexists").parquet(target)
    n, m = df.count(), spark.read.parquet(target).count()
    if n != m:
        raise IntegrityError(f"{source}: {n} rows, {target}: {m}")
    return n


def write_layout(df: DataFrame, path: str, date: str, keys: list[str], partitions: int | None = None) -> None:
    """A folder per month, rows ranged and sorted by the keys, so readers skip files and row groups."""
    df = df.withColumn("month", F.date_format(date, "yyyy-MM"))
    df = df.repartitionByRange(partitions, "month", *keys) if partitions else df.repartitionByRange("month", *keys)
    df.sortWithinPartitions("month", *keys).write.mode("errorifexists").partitionBy("month").parquet(path)


def assert_same_batch(old: DataFrame, new: DataFrame) -> None:
    """A run id may come again only with the same pages."""
    cols = ["resource", "page_number", "rows_received", "response_sha256"]
    a, b = old.select(*cols), new.select(*cols)
    if a.exceptAll(b).take(1) or b.exceptAll(a).take(1):
        raise IntegrityError("the capture under this run id has changed")


def run_record(manifest: DataFrame, run_id: str, bounded: bool, attempts: DataFrame | None = None) -> DataFrame:
    """One control row: mode, pages and rows, requests, and a summary.

    ``attempts``: a row per request that was made, retries and failures included;
    without it each page counts as one request.
    """
    df = manifest.agg(F.count(F.lit(1)).alias("pages"), F.coalesce(F.sum("rows_received"), F.lit(0)).alias("rows"))
    made = attempts.agg(F.count(F.lit(1)).alias("http_requests"), F.count_if("failed").alias("failed_requests")) if attempts is not None else manifest.agg(F.count(F.lit(1)).alias("http_requests"), F.lit(0).cast("long").alias("failed_requests"))
    summary = F.to_json(F.struct("pages", "rows", "failed_requests"))
    return df.join(made).select(F.lit(run_id).alias("run_id"), F.lit("bounded" if bounded else "full").alias("invocation_mode"), "http_requests", "failed_requests", "rows", summary.alias("summary"))


# ---- audits


def page_stats(raw: DataFrame) -> DataFrame:
    """Per page: rows, distinct positions, rows with bad metadata, marked numbers."""
    bad = F.col("source_file").isNull() | F.col("record_hash").isNull() | F.col("batch_id").isNull() | ~F.col("record_hash").rlike("^[0-9a-f]{64}$")
    return raw.groupBy("resource", "page_number").agg(
        F.count(F.lit(1)).alias("rows"), F.countDistinct("record_index").alias("positions"), F.count_if(bad).alias("bad_metadata"), F.count_if(F.col("payload").contains(NON_FINITE)).alias("marked")
    )


def verify_raw(raw: DataFrame, manifest: DataFrame, resources: DataFrame | None = None, controls: DataFrame | None = None) -> DataFrame:
    """Raw against the manifest: (resource, check_name, expected, actual, passed).

    Over all resources the inventory of pages; per resource rows, pages, pages of
    another number of rows, repeated positions, bad metadata and marked numbers.
    ``resources`` (resource, marked): how many records with marked numbers were logged, if it
    is given.  ``controls`` (table, expected, actual): rows of control tables.
    One aggregate of raw by page; everything else is small.
    """
    pages = page_stats(raw).join(manifest.where("rows_received > 0").select("resource", "page_number", "rows_received"), ["resource", "page_number"], "full")
    stats = pages.groupBy("resource").agg(
        *(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("rows_received", "rows", "bad_metadata", "marked")), F.coalesce(F.sum(F.col("rows") - F.col("positions")), F.lit(0)).alias("repeats"),
        F.count("rows_received").alias("want_pages"), F.count("rows").alias("pages"), F.count_if(F.col("rows_received").isNotNull() & ~F.col("rows").eqNullSafe(F.col("rows_received"))).alias("other_counts"),
        F.count_if(F.col("rows").isNull() | F.col("rows_received").isNull()).alias("one_side"),
    )
    if resources is not None:
        stats = stats.join(resources.select("resource", F.col("marked").alias("logged")), "resource", "left")
    check = lambda n, e, a: F.struct(F.lit(n).alias("check_name"), F.coalesce(e.cast("long"), F.lit(0)).alias("expected"), a.cast("long").alias("actual"))
    rows = [check("ROWS", F.col("rows_received"), F.col("rows")), check("PAGES", F.col("want_pages"), F.col("pages")), check("PAGE_COUNTS", F.lit(0), F.col("other_counts"))]
    rows += [check("REPEATED_POSITIONS", F.lit(0), F.col("repeats")), check("BAD_METADATA", F.lit(0), F.col("bad_metadata"))]
    if resources is not None:
        rows.append(check("NON_FINITE_MARKERS", F.col("logged"), F.col("marked")))
    found = stats.select("resource", F.explode(F.array(*rows)).alias("c")).select("resource", "c.*")
    found = found.unionByName(stats.agg(F.lit("all").alias("resource"), F.lit("PAGE_INVENTORY").alias("check_name"), F.lit(0).cast("long").alias("expected"), F.coalesce(F.sum("one_side"), F.lit(0)).alias("actual")))
    if controls is not None:
        found = found.unionByName(controls.select(F.lit("all").alias("resource"), F.concat(F.upper("table"), F.lit("_ROWS")).alias("check_name"), F.col("expected").cast("long").alias("expected"), F.col("actual").cast("long").alias("actual")))
    return found.withColumn("passed", F.col("expected") == F.col("actual"))


def audit_pages(manifest: DataFrame) -> DataFrame:
    """Breaks in a capture's continuity, per resource and page.

    Pages by cursor: a cursor that comes again, more to come without a cursor,
    an empty page with more to come, a cursor that isn't the one before's next.
    Pages by offset: a jump, a changed limit or total, a short page before the
    last, a page over the limit.  A page meets the one before it within its
    stretch of pages, a stretch the end of the one before, and no window holds a resource.
    """
    pages = with_previous_in_order(manifest, ["resource"], "page_number", ["next_cursor", "request_offset", "rows_received", "limit", "total"])
    ends = manifest.groupBy("resource").agg(F.max("page_number").alias("_last"))
    again = manifest.where("request_cursor IS NOT NULL").groupBy("resource", "request_cursor").agg(F.count(F.lit(1)).alias("_times")).where("_times > 1")
    pages = pages.join(ends, "resource").join(again, ["resource", "request_cursor"], "left")
    before = lambda c: F.col(f"previous.{c}")
    by_offset, known = F.col("request_offset").isNotNull(), F.col("previous").isNotNull()
    problems = {
        "repeated_cursor": F.col("_times").isNotNull(),
        "more_without_cursor": F.col("has_more") & F.col("next_cursor").isNull(),
        "empty_with_more": F.col("has_more") & (F.col("rows_received") == 0),
        "cursor_jump": ~by_offset & known & ~F.col("request_cursor").eqNullSafe(before("next_cursor")),
        "offset_jump": by_offset & known & (F.col("request_offset") != before("request_offset") + before("rows_received")),
        "limit_changed": by_offset & known & (F.col("limit") != before("limit")),
        "total_changed": by_offset & known & (F.col("total") != before("total")),
        "short_page": by_offset & (F.col("page_number") < F.col("_last")) & (F.col("rows_received") < F.col("limit")),
        "oversize_page": by_offset & (F.col("rows_received") > F.col("limit")),
    }
    found = F.array_compact(F.array(*(F.when(c, F.lit(n)) for n, c in problems.items())))
    return pages.select("resource", "page_number", found.alias("_p")).select("resource", "page_number", F.explode("_p").alias("problem"))


def audit_totals(manifest: DataFrame, records: DataFrame | None = None, logged: DataFrame | None = None) -> DataFrame:
    """Per resource: the source's total against the rows of its pages (PASS, PARTIAL, or UNKNOWN without a total).

    With ``records`` (parsed, of resource, page_number and issues) and ``logged`` (page_number and a row for
    each marked number that the run logged, of resource) also pages whose records
    aren't as many as the page says, and marked numbers in records against logged ones.
    """
    df = manifest.groupBy("resource").agg(F.max("total").alias("source_total"), F.sum("rows_received").alias("rows"))
    status = F.when(F.col("source_total").isNull(), "UNKNOWN").when(F.col("source_total") == F.col("rows"), "PASS").otherwise("PARTIAL")
    df = df.select("resource", "source_total", "rows", status.alias("audit_status"))
    if records is None:
        return df
    found = records.groupBy("resource", "page_number").agg(F.count(F.lit(1)).alias("_records"), F.sum(F.size("issues")).alias("_encoded"))
    pages = manifest.select("resource", "page_number", "rows_received").join(found, ["resource", "page_number"], "full")
    other = F.coalesce("rows_received", F.lit(-1)) != F.coalesce("_records", F.lit(0))
    pages = pages.groupBy("resource").agg(F.count_if(other).alias("pages_of_other_rows"), F.coalesce(F.sum("_encoded"), F.lit(0)).alias("encoded"))
    log = logged.groupBy("resource").agg(F.count(F.lit(1)).alias("logged"))
    return df.join(pages, "resource", "left").join(log, "resource", "left").withColumn("logged", F.coalesce("logged", F.lit(0)))


def field_types(records: DataFrame) -> DataFrame:
    """page_number, field, type of every top-level field, by value: null, boolean, number, string, array or object."""
    return members(records.where("is_object"), "payload", ["page_number"]).select("page_number", "field", kind_of(F.col("value")).alias("type"))


def field_type_counts(records: DataFrame) -> DataFrame:
    """How many values of which type a field has in a page."""
    return field_types(records).groupBy("page_number", "field", "type").agg(F.count(F.lit(1)).alias("values"))


def shape_summary(records: DataFrame) -> DataFrame:
    """How many records have which set of fields; those that aren't objects as such."""
    shape = F.when(F.col("is_object"), F.array_join(F.array_sort(F.json_object_keys("payload")), ",")).otherwise("not an object")
    return records.groupBy("page_number", shape.alias("shape")).agg(F.count(F.lit(1)).alias("records"))


def _once(df: DataFrame, label: str) -> DataFrame:
    """The rows as read back from a table in the shared folder."""
    path = work_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def schema_drift(records: DataFrame) -> DataFrame:
    """Against the first page: shapes and types of fields that come up later, and fields of several types in a page.

    The shapes and the types of the pages are each made in one pass over the records and written; the rest reads those.
    """
    by_page = _once(shape_summary(records).select("page_number", "shape"), "shapes")
    shapes = by_page.groupBy("shape").agg(F.min("page_number").alias("page_number"))
    types = _once(field_types(records).where("type <> 'null'").distinct(), "types")
    first_types = types.groupBy("field", "type").agg(F.min("page_number").alias("page_number"))
    first_fields = types.groupBy("field").agg(F.min("page_number").alias("_since"))
    start = by_page.agg(F.min("page_number").alias("_start"))
    new_shapes = shapes.join(start).where("page_number > _start").select("page_number", F.lit("new_shape").alias("drift"), F.col("shape").alias("what"))
    new_types = first_types.join(first_fields, "field").where("page_number > _since").select("page_number", F.lit("new_type").alias("drift"), F.concat_ws(" ", "field", "type").alias("what"))
    mixed = types.groupBy("page_number", "field").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("page_number", F.lit("mixed_types").alias("drift"), F.col("field").alias("what"))
    return new_shapes.unionByName(new_types).unionByName(mixed)


#: From worst to best.
STATUSES = ["FAILED", "PARTIAL", "SUCCESS_WITH_QUARANTINE", "SUCCESS"]


def run_status(states: DataFrame) -> DataFrame:
    """The worst status of a run's resources; a run without any failed."""
    worst = F.coalesce(F.min(F.array_position(F.array(*map(F.lit, STATUSES)), F.col("status"))), F.lit(1))
    return states.agg(F.element_at(F.array(*map(F.lit, STATUSES)), worst.cast("int")).alias("run_status"))
