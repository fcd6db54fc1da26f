"""WARC archives as a chunked record table.

A record's bytes are cut into rows (archive, record_no, chunk_no, data); the
``data`` of an archive's rows, in that order, is a WARC 1.1 file byte for byte.
The first row starts with the header and every row carries the SHA-1 of the
payload up to its end.  Rows are at most ``chunk_bytes`` of payload, so neither
writing nor reading holds more of a record than Arrow's batch; a record of one
row (most) is read where it lies, and the rows of larger ones are brought
together by a shuffle and sorted on disk, then streamed.

Of records with equal payloads (SHA-256) of at least ``min_dedup`` bytes the
largest page_id is the response; the others are revisits without a payload.

Defined cases: null html is an empty payload; a null url has no target header;
a null page_id is never the response of a group with another id, and rows that
repeat page_id and payload are all responses; an empty table gives an archive
table without rows; control characters in a url are written as %XX.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fresh_dir, join_grouped, materialize, read_table

CHUNK_BYTES = 32 * 1024
MIN_DEDUP = 1000
BATCH_BYTES = 4 * 1024 * 1024
END = b"\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

CHUNKS = "archive int, record_no long, page_id long, chunk_no int, n_chunks int, data binary, sha1_so_far string"
RECORDS = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
CHUNK_SCHEMA = pa.schema(
    [("archive", pa.int32()), ("record_no", pa.int64()), ("page_id", pa.int64()), ("chunk_no", pa.int32()), ("n_chunks", pa.int32()), ("data", pa.binary()), ("sha1_so_far", pa.string())]
)
RECORD_SCHEMA = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())])


def _id(page_id: int | None, sha1: str) -> str:
    h = hashlib.md5(f"{page_id}|{sha1}".encode()).hexdigest()
    return f"<urn:uuid:{h[:8]}-{h[8:12]}-{h[12:16]}-{h[16:20]}-{h[20:]}>"


def header(row: dict) -> bytes:
    """The header of a record up to and with the empty line."""
    revisit = row["record_type"] == "revisit"
    digest = base64.b32encode(bytes.fromhex(row["sha1"])).decode()
    lines = [
        "WARC/1.1",
        f"WARC-Type: {row['record_type']}",
        f"WARC-Record-ID: {_id(row['page_id'], row['sha1'])}",
        "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: text/html; charset=utf-8",
        f"X-Payload-Length: {row['payload_bytes']}",
    ]
    if row["page_id"] is not None:
        lines.append(f"X-Page-Id: {row['page_id']}")
    if row["url"] is not None:
        lines.append("WARC-Target-URI: " + "".join(f"%{ord(c):02X}" if ord(c) < 33 or ord(c) == 127 else c for c in row["url"]))
    if revisit:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {_id(row['refers_to'], row['sha1'])}", f"X-Refers-To-Page-Id: {row['refers_to']}"]
    lines.append(f"Content-Length: {0 if revisit else row['payload_bytes']}")
    return ("\r\n".join(lines) + "\r\n\r\n").encode()


def _write(chunk_bytes: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        archive, record_no = TaskContext.get().partitionId(), 0
        rows, held = [], 0
        for batch in batches:
            html = batch.column(batch.schema.get_field_index("html"))
            rest = batch.drop_columns(["html"])
            for i in range(batch.num_rows):
                row = {name: rest.column(name)[i].as_py() for name in rest.schema.names}
                payload = memoryview(html[i].as_buffer() or b"") if html[i].is_valid and row["record_type"] == "response" else memoryview(b"")
                n = max(1, -(-len(payload) // chunk_bytes))
                sha1 = hashlib.sha1()
                for k in range(n):
                    piece = payload[k * chunk_bytes : (k + 1) * chunk_bytes]
                    sha1.update(piece)
                    data = (header(row) if k == 0 else b"") + bytes(piece) + (END if k == n - 1 else b"")
                    rows.append((archive, record_no, row["page_id"], k, n, data, sha1.hexdigest()))
                    held += len(data)
                    if held >= BATCH_BYTES:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), CHUNK_SCHEMA.types)], schema=CHUNK_SCHEMA)
                        rows, held = [], 0
                if row["record_type"] == "response" and sha1.hexdigest() != row["sha1"]:
                    raise ValueError(f"page {row['page_id']}: payload changed while it was written")
                record_no += 1
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), CHUNK_SCHEMA.types)], schema=CHUNK_SCHEMA)

    return write


def write_archives(pages: DataFrame, path: str, chunk_bytes: int = CHUNK_BYTES, min_dedup: int = MIN_DEDUP) -> None:
    """Write a record per row of ``pages`` (page_id, url, html) to a table of chunks at ``path``.

    The payloads move once, with the decisions, by page_id; hot payloads don't
    matter as only their ids and digests are grouped.
    """
    html = F.coalesce(F.col("html"), F.lit(""))
    keyed = pages.select("page_id", "url", html.alias("html"), F.unhex(F.sha2(html, 256)).alias("sha256"))
    ids = materialize(keyed.select("page_id", "sha256", F.octet_length("html").cast("long").alias("payload_bytes")), "payloads")
    large = ids.where(F.col("payload_bytes") >= min_dedup)
    groups = large.groupBy("sha256").agg(F.max("page_id").alias("refers_to"), F.count(F.lit(1)).alias("copies")).where("copies > 1")
    groups = materialize(groups, "payload-groups")
    again = join_grouped(large, groups, "sha256", "copies", large.count()).where("NOT (page_id <=> refers_to)")
    again = again.select(F.col("page_id").alias("_page"), F.col("sha256").alias("_sha"), "refers_to").distinct()
    same = F.col("page_id").eqNullSafe(F.col("_page")) & (F.col("sha256") == F.col("_sha"))
    rows = keyed.join(again, same, "left").select(
        "page_id", "url", "html", "refers_to",
        F.when(F.col("_sha").isNotNull(), "revisit").otherwise("response").alias("record_type"),
        F.sha1("html").alias("sha1"), F.octet_length("html").cast("long").alias("payload_bytes"),
    )
    rows.mapInArrow(_write(chunk_bytes), CHUNKS).write.parquet(path)


def parse_header(data: bytes) -> tuple[dict[str, str], int]:
    """Fields of the record that starts ``data``, and where its block starts."""
    end = data.index(END) + len(END)
    first, *lines = data[: end - len(END)].decode().split("\r\n")
    if first != "WARC/1.1":
        raise ValueError(f"not a record: {first[:20]!r}")
    return dict(line.split(": ", 1) for line in lines), end


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunk rows, those of a record in order, to a row per record."""
    fields, sha1, left = None, None, 0
    out: list[tuple] = []
    for batch in batches:
        cols = [batch.column(n) for n in ("chunk_no", "n_chunks", "data", "sha1_so_far")]
        for i in range(batch.num_rows):
            k, n, so_far = cols[0][i].as_py(), cols[1][i].as_py(), cols[3][i].as_py()
            data, start = memoryview(cols[2][i].as_buffer()), 0
            if k == 0:
                if fields is not None:
                    raise ValueError("a record's last chunks are missing")
                fields, start = parse_header(bytes(data))  # a record's first chunk has the whole header
                sha1, left = hashlib.sha1(), int(fields["Content-Length"])
            piece = data[start : start + left]
            sha1.update(piece)
            left -= len(piece)
            if sha1.hexdigest() != so_far:
                raise ValueError(f"record {fields['WARC-Record-ID']}: chunk {k} is damaged")
            if k == n - 1:
                if left or bytes(data[start + len(piece) :]) != END:
                    raise ValueError(f"record {fields['WARC-Record-ID']}: wrong length")
                kind, digest = fields["WARC-Type"], base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
                if kind == "response" and digest != sha1.hexdigest():
                    raise ValueError(f"record {fields['WARC-Record-ID']}: wrong payload digest")
                ref, page = fields.get("X-Refers-To-Page-Id"), fields.get("X-Page-Id")
                out.append((page and int(page), int(fields["X-Payload-Length"]), digest, kind, ref and int(ref)))
                fields = None
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), RECORD_SCHEMA.types)], schema=RECORD_SCHEMA)
            out = []


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """Every record of a chunk table: page_id, payload_bytes, payload_digest, record_type, refers_to.

    Lengths and digests of headers are checked against the chunks.
    """
    chunks = spark.read.schema(CHUNKS).parquet(path)
    whole = chunks.where("n_chunks = 1").mapInArrow(_read, RECORDS)
    cut = chunks.where("n_chunks > 1").repartition("archive", "record_no").sortWithinPartitions("archive", "record_no", "chunk_no")
    return whole.unionByName(cut.mapInArrow(_read, RECORDS))


def export_files(spark: SparkSession, path: str, folder: str) -> None:
    """Write a chunk table as ``archive-NNNNN.warc`` files in a folder that all executors mount."""

    def write(rows) -> None:
        out, current = None, None
        for r in rows:
            if r.archive != current:
                if out:
                    out.close()
                out, current = open(f"{folder}/archive-{r.archive:05d}.warc", "wb"), r.archive
            out.write(r.data)
        if out:
            out.close()

    chunks = spark.read.schema(CHUNKS).parquet(path)
    chunks.repartition("archive").sortWithinPartitions("archive", "record_no", "chunk_no").foreachPartition(write)


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_dir(spark, "warc")
    write_archives(read_table(spark, sf_dir, "pages").select("page_id", "url", "html"), path)
    return read_archives(spark, path)


OP3_SQL = """
SELECT page_id, payload_bytes, sha1(h) AS payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id <> last_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id <> last_id THEN last_id END AS refers_to
FROM (SELECT page_id, h, CAST(strlen(h) AS BIGINT) AS payload_bytes, max(page_id) OVER (PARTITION BY h) AS last_id
      FROM (SELECT page_id, coalesce(html, '') AS h FROM pages) a) b
"""
