"""Reading a source's changes from a committed watermark less an overlap, once each, whatever fails in between.

A resource's watermarks are a table with a row per applied batch.  A run reads the
source from the last watermark less the overlap, leaves out what the batches of
that stretch hold already, writes the rest to a folder of its own, checks
what was written, and only then adds the batch's row, which names the folder.
Folders that no row names aren't part of the result.  So a run that fails
anywhere, or finds its batch applied by another, changes nothing, and one that is
repeated adds nothing twice.  What is compared is bounded by the overlap: applied rows
lie by month (or another unit) of their time.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.expr import row_hash

MARKS = "resource string, batch long, watermark timestamp, rows long, attempt string"


@dataclass
class Delta:
    """Applied changes of one resource under ``path``."""

    spark: SparkSession
    path: str
    resource: str
    schema: StructType
    at: str
    keys: list[str]
    overlap_seconds: int
    unit: str = "month"

    @property
    def _marks(self) -> str:
        return f"{self.path}/watermarks/{self.resource}"

    def marks(self) -> DataFrame:
        """A row per applied batch."""
        try:
            return self.spark.read.schema(MARKS).parquet(self._marks)
        except Exception as error:
            if "PATH_NOT_FOUND" in str(error):
                return self.spark.createDataFrame([], MARKS)
            raise

    def position(self) -> tuple[int, object]:
        """How many batches are applied, and the watermark (None before the first)."""
        r = self.marks().agg(F.coalesce(F.max("batch") + 1, F.lit(0)).alias("n"), F.max("watermark").alias("w")).first()
        return r["n"], r["w"]

    def _since(self, watermark) -> Column:
        return F.lit(watermark).cast("timestamp") - F.make_interval(secs=F.lit(self.overlap_seconds))

    def _folders(self, attempts: dict[str, int]) -> DataFrame:
        folder = f"{self.path}/{self.resource}"
        schema = StructType([*self.schema.fields]).add("attempt", "string").add("_part", "date")
        df = self.spark.read.schema(schema).option("basePath", folder).parquet(*(f"{folder}/attempt={a}" for a in attempts))
        batch = F.element_at(F.create_map(*(F.lit(x) for pair in attempts.items() for x in pair)), F.col("attempt")).cast("long")
        return df.withColumn("batch", batch).drop("attempt")

    def applied(self, since: Column | None = None) -> DataFrame:
        """The rows of all applied batches with their batch, or of those months from a time on."""
        attempts = {r["attempt"]: r["batch"] for r in self.marks().where("rows > 0").collect()}
        if not attempts:
            return self.spark.createDataFrame([], StructType([*self.schema.fields]).add("batch", "long"))
        df = self._folders(attempts)
        return (df.where(F.col("_part") >= self._part(since)) if since is not None else df).drop("_part")

    def _part(self, at: Column) -> Column:
        return F.date_trunc(self.unit, at.cast("timestamp")).cast("date")

    def read(self, source: DataFrame) -> DataFrame:
        """What the source has from the watermark less the overlap that no applied batch holds; repeats once."""
        _, watermark = self.position()
        content = [c for c in self.schema.names if c not in (*self.keys, self.at)]
        same = [*self.keys, self.at, "_hash"]
        hashed = lambda df: df.withColumn("_hash", row_hash(*content))
        if watermark is None:
            return hashed(source.select(*self.schema.names)).dropDuplicates(same).drop("_hash")
        since = self._since(watermark)
        window = hashed(source.select(*self.schema.names).where(F.col(self.at) >= since)).dropDuplicates(same)
        known = hashed(self.applied(since)).select(*same)
        return window.join(known, same, "left_anti").drop("_hash")

    def run(self, source: DataFrame, check: Callable[[DataFrame], None] | None = None) -> int:
        """Apply one batch; the number of its rows.  Raises what ``check`` raises, and the watermark stays."""
        batch, watermark = self.position()
        attempt = uuid.uuid4().hex
        self.read(source).withColumn("_part", self._part(F.col(self.at))).write.partitionBy("_part").parquet(f"{self.path}/{self.resource}/attempt={attempt}")
        written = self._folders({attempt: batch}).drop("batch", "_part")
        if check:
            check(written)
        r = written.agg(F.count(F.lit(1)).alias("n"), F.max(F.col(self.at).cast("timestamp")).alias("w")).first()
        top = max((w for w in (watermark, r["w"]) if w is not None), default=None)
        # If another run has applied this batch meanwhile, its row is there and this one fails.
        self.spark.createDataFrame([(self.resource, batch, top, r["n"], attempt)], MARKS).coalesce(1).write.mode("errorifexists").parquet(f"{self._marks}/number={batch}")
        return r["n"]
