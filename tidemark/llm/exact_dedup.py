"""Exact dedup against a persistent digest index.

The index is a Parquet table bucketed and sorted by the SHA-256 of the text; it is
found by its path, in any session.
A batch is reduced to one row per digest, in a table of its own, before anything is
compared (so a text with a million copies is one row; as a part of one plan Spark would
join first and reduce then), the digests already in the index are removed
by a sort-merge anti-join that reads the index by its buckets, and the rest is
appended with the id of the row that stays.  A batch's rows then meet the index
for their decisions, texts with very many rows in the batch by broadcast.

The query brings the documents in two batches, those with the larger ids first,
so that the row with the largest id stays as if they had come at once.

Defined cases: a null text counts as empty; a null id never stays when the text
has a row with an id, and stays when it has none; rows that repeat id and text
are one document and get the same decision; an empty batch appends nothing;
other columns, whatever their names, are not read.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import fresh_dir, join_grouped, materialize, read_table, text_or_empty, without_rows


class DigestIndex:
    """Digests seen so far, with the id that stays for each.

    Table columns: ``digest`` (32 bytes), ``keep_id`` and ``batch_id`` (the batch
    that brought it).  The table's files lie under ``path``, which all executors
    share, in a folder that is named by the number of buckets; an index that is there
    already keeps its own number.  Choose ``buckets`` so that a bucket of the grown
    index suits a task.
    """

    def __init__(self, spark: SparkSession, name: str, path: str, buckets: int = 64):
        self.spark, self.name, self.path = spark, name, path.rstrip("/")
        there = self._folders()
        self.buckets = there[0] if there else buckets
        if there:
            self._register(spark.read.parquet(self.location).schema)

    @classmethod
    def temporary(cls, spark: SparkSession, buckets: int = 64) -> DigestIndex:
        return cls(spark, f"digest_index_{uuid.uuid4().hex}", fresh_dir(spark, "digest-index"), buckets)

    @property
    def location(self) -> str:
        return f"{self.path}/buckets={self.buckets}"

    def _folders(self) -> list[int]:
        """Numbers of buckets of the indexes whose first write ended."""
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path
        root = path(self.path)
        fs = root.getFileSystem(self.spark._jsc.hadoopConfiguration())
        names = [s.getPath().getName() for s in fs.listStatus(root)] if fs.exists(root) else []
        return [int(n[8:]) for n in names if n.startswith("buckets=") and fs.exists(path(f"{self.path}/{n}/_SUCCESS"))]

    def _register(self, schema: StructType) -> None:
        """Name the files under ``location`` for this session's catalog, which may be new."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")
        columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema.fields)
        self.spark.sql(f"CREATE TABLE {self.name} ({columns}) USING parquet CLUSTERED BY (digest) SORTED BY (digest) INTO {self.buckets} BUCKETS LOCATION '{self.location}'")

    def exists(self) -> bool:
        return bool(self._folders())

    def read(self) -> DataFrame:
        return self.spark.table(self.name)

    def append(self, batch: DataFrame, batch_id: str) -> None:
        """Index ``batch`` (columns doc_id, digest).  Appending a batch again changes nothing: its digests are in the index."""
        fresh, known = materialize(batch.groupBy("digest").agg(F.max("doc_id").alias("keep_id")), "digest-batch"), self.exists()
        if known:
            fresh = fresh.hint("merge").join(self.read().select("digest").hint("merge"), "digest", "left_anti")
        else:
            self._register(fresh.withColumn("batch_id", F.lit(batch_id)).schema)
        rows = fresh.withColumn("batch_id", F.lit(batch_id)).repartition(self.buckets, "digest")
        rows.write.mode("append").format("parquet").bucketBy(self.buckets, "digest").sortBy("digest").saveAsTable(self.name)
        self.spark.catalog.refreshTable(self.name)  # the batch may be another session's

    def decide(self, batch: DataFrame) -> DataFrame:
        """doc_id, digest, keep_id, group_size (rows of ``batch`` with the text) and kept for each row of an indexed batch."""
        batch = batch.select("doc_id", "digest")
        copies = batch.groupBy("digest").agg(F.count(F.lit(1)).alias("group_size"))
        known = copies.hint("merge").join(self.read().select("digest", "keep_id").hint("merge"), "digest")
        known = materialize(known, "digest-decisions")
        return join_grouped(batch, known, "digest", "group_size", batch.count()).select(
            "doc_id", "digest", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept")
        )

    def drop(self) -> None:
        """Forget the table; the files under ``path`` go with the shared folder."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")


def text_digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and the 32-byte SHA-256 of the text in UTF-8."""
    return docs.select(F.col(id_col).alias("doc_id"), F.unhex(F.sha2(text_or_empty(text_col), 256)).alias("digest"))


def dedup(docs: DataFrame, index: DigestIndex | None = None, batch_id: str = "initial") -> DataFrame:
    """Index the documents as one batch; a row for each, as of ``DigestIndex.decide``."""
    digests = materialize(text_digests(docs), "digests")
    own = index or DigestIndex.temporary(docs.sparkSession)
    own.append(digests, batch_id)
    rows = own.decide(digests)
    if index is None:
        own.drop()  # decisions are in a table of their own
    return rows


def keep_distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: of equal texts the row with the largest doc_id stays.

    Null and empty texts are equal; rows that repeat id and text stay or go
    together; other columns pass through, whatever their names; an empty table
    stays empty.
    """
    return without_rows(docs, dedup(docs).where("NOT kept").select("doc_id", "digest"), F.unhex(F.sha2(text_or_empty(), 256)))


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    digests = materialize(text_digests(read_table(spark, sf_dir, "documents")), "digests")
    middle = digests.agg(F.percentile_approx("doc_id", 0.5)).first()[0]
    upper = F.coalesce(F.col("doc_id") >= F.lit(middle), F.lit(False))
    index = DigestIndex.temporary(spark)
    index.append(digests.where(upper), "upper")
    index.append(digests.where(~upper), "lower")
    rows = index.decide(digests).select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))
    index.drop()
    return rows


OP5_SQL = """
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256
FROM (SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, sha256(t) AS text_sha256
      FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents) d
      WINDOW w AS (PARTITION BY t)) x
"""
