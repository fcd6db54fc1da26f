"""Change events as a stream: each micro-batch goes into history and state inside foreachBatch.

Both tables are Parquet in buckets of the policy.  History has a folder per bucket
and batch; state has a folder per bucket with the latest event of each key,
deletes included, so a late older event can't bring a key back and a bucket is never
empty.  A batch reads and replaces just the buckets that it touches, of history
for its checks and of state to renew it.  A batch that is delivered again after a failure
replaces its own folders and comes to the same state, so none is applied twice.
Events are never dropped for being late.

One writer at a time: two streams that change the same buckets at once are not kept apart.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..operators.checks import ChecksFailed
from ..operators.merge import current_state, immutable_conflicts, merge_history, op_violations
from ..operators.ranges import find_differences
from ..operators.relational import latest_by
from ..sources.batches import already_applied, read_if_there, record_run

BUCKETS = 16


def bucket_of(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def history(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """All events with their bucket and batch."""
    return read_if_there(spark, f"{path}/history", StructType([*schema.fields]).add("bucket", "integer").add("batch", "string"))


def state(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The latest event of each policy with its bucket, deletes included."""
    return read_if_there(spark, f"{path}/state", StructType([*schema.fields]).add("bucket", "integer"))


def active(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    return state(spark, path, schema).where("op <> 'D'").drop("bucket")


def _replace(df: DataFrame, path: str, *by: str) -> None:
    """Rows take the place of what their partitions hold."""
    df.repartition("bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def apply_batch(batch: DataFrame, path: str, batch_id: str, buckets: int = BUCKETS) -> bool:
    """A batch of events, checked, into history and state; False if it was applied before.

    Raises before anything is written if an event differs from the stored one,
    or a policy would not have exactly one insert; the failure is recorded.
    """
    spark, schema = batch.sparkSession, StructType([*batch.schema.fields])
    if already_applied(spark, path, batch_id):
        return False
    incoming = f"{path}/incoming/{batch_id.replace(':', '-')}"
    batch.withColumn("bucket", bucket_of("policy_id", buckets)).write.mode("overwrite").parquet(incoming)
    batch = spark.read.schema(StructType([*schema.fields]).add("bucket", "integer")).parquet(incoming)
    touched = [r[0] for r in batch.select("bucket").distinct().collect()]
    old = history(spark, path, schema).where(F.col("bucket").isin(touched) & (F.col("batch") != batch_id)).select(*schema.names)
    events = batch.select(*schema.names)
    try:
        # Counted, as taking a row looks at the parts of the last stage one after another while there is none.
        if immutable_conflicts(old.unionByName(events), events).limit(1).count():
            raise ChecksFailed("an event was changed after it was stored")
        if op_violations(events, old).limit(1).count():
            raise ChecksFailed("a policy needs exactly one insert")
    except ChecksFailed as error:
        record_run(spark, path, batch_id, "FAILED", batch_id, error=str(error))
        raise
    fresh = merge_history(old, events).withColumns({"bucket": bucket_of("policy_id", buckets), "batch": F.lit(batch_id)})
    _replace(fresh, f"{path}/history", "bucket", "batch")
    known = state(spark, path, schema).where(F.col("bucket").isin(touched)).select(*schema.names)
    renewed = latest_by(known.unionByName(events), ["policy_id"], "updated_on").withColumn("bucket", bucket_of("policy_id", buckets))
    _replace(renewed, f"{path}/state", "bucket")
    record_run(spark, path, batch_id, "SUCCESS", batch_id)
    return True


def start_cdc_stream(events: DataFrame, path: str, checkpoint: str, name: str = "cdc", buckets: int = BUCKETS) -> StreamingQuery:
    """Apply every micro-batch of a stream of events until there is no more."""

    def each(batch: DataFrame, number: int) -> None:
        # Spark writes the stream's id before the first batch; it lives as long as the checkpoint.
        stream = batch.sparkSession.read.text(f"{checkpoint}/metadata", wholetext=True).first()[0]
        apply_batch(batch, path, f"{name}:{json.loads(stream)['id']}:{number}", buckets)

    return events.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def deduplicated(events: DataFrame, keys: list[str], at: str, overlap: str) -> DataFrame:
    """Re-reads of an overlapping window, once each; state is kept for the overlap only."""
    return events.withWatermark(at, overlap).dropDuplicatesWithinWatermark(keys)


def state_equals_history(spark: SparkSession, path: str, schema: StructType) -> bool:
    """Whether the current state is what the history leads to."""
    events = history(spark, path, schema).select(*schema.names)
    return not find_differences(active(spark, path, schema), current_state(events), ["policy_id"]).take(1)
