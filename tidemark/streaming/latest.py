"""The latest state of each key as a stream of changes, in a keyed state store.

A key's state is one row: the order of its latest event, a hash of it, and whether it was a
delete.  A micro-batch reads the state of its own keys only and gives out
the keys that change, so neither the table nor the history is read again.
Deleted keys stay in the store as deletes, so that a late older event can't
bring them back; a time to live bounds how long a key without events is kept, and so
how late an event may be.  State is held by RocksDB on the executors and
checkpointed with the stream.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StructType

from ..functions.leaves import share_code
from ..operators.relational import latest_by

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class LatestEvent(StatefulProcessor):
    """Keeps the largest (order, hash) of a key and gives the event out when it is new."""

    def __init__(self, columns: list[str], ttl_ms: int | None):
        self.columns, self.ttl_ms = columns, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.latest = handle.getValueState("latest", "at string, tie long, deleted boolean", self.ttl_ms)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        best = None
        for part in rows:
            part.columns = self.columns  # columns that the query adds come without their names
            top = part.sort_values(["_at", "_tie"]).iloc[[-1]]
            if best is None or (top["_at"].iloc[0], top["_tie"].iloc[0]) > (best["_at"].iloc[0], best["_tie"].iloc[0]):
                best = top
        if best is None:
            return
        at, tie, deleted = best["_at"].iloc[0], int(best["_tie"].iloc[0]), bool(best["_deleted"].iloc[0])
        if self.latest.exists():
            old = self.latest.get()
            if (old[0], old[1]) >= (at, tie):
                return
        self.latest.update((at, tie, deleted))
        yield best.drop(columns=["_at", "_tie"])

    def close(self) -> None:
        pass


def use_rocksdb(spark: SparkSession) -> None:
    """The state store that keyed state needs; to be set before the stream starts."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)


def latest_changes(events: DataFrame, key: str, order: str, deleted: str, ttl_ms: int | None = None) -> DataFrame:
    """Events of a stream that became their key's latest, with ``_deleted``; in update mode, at most one per key and batch.

    ``order``: a timestamp, date or whole number; among equal ones the larger hash
    of the row wins, as in ``latest_by``.  ``deleted``: a condition in SQL.
    ``ttl_ms``: how long a key without events is remembered; None: for ever.
    """
    share_code(events.sparkSession)
    use_rocksdb(events.sparkSession)
    rest = [c for c in events.columns if c != key]
    # As text of one length, so that times and numbers compare alike; nulls come first.
    as_number = F.col(order).cast("timestamp").cast("decimal(20,6)") if dict(events.dtypes)[order] in ("timestamp", "date") else F.col(order).cast("decimal(20,6)")
    at = F.coalesce(F.lpad((as_number + F.lit(10**13)).cast("string"), 24, "0"), F.lit(""))
    rows = events.withColumns({"_at": at, "_tie": F.xxhash64(*rest), "_deleted": F.coalesce(F.expr(deleted), F.lit(False))})
    out = StructType([*events.schema.fields, rows.schema["_deleted"]])
    mode = "None" if ttl_ms is None else "ProcessingTime"
    return rows.groupBy(key).transformWithStateInPandas(LatestEvent(rows.columns, ttl_ms), out, "Update", mode)


def write_changes(changes: DataFrame, path: str, checkpoint: str, ttl: bool = False) -> StreamingQuery:
    """A folder per batch under ``path``; a batch that is delivered again replaces its own folder.

    All there is, then the end.  With a time to live there is always a next batch, which
    looks for what has expired, so then all there is goes into one batch.
    """

    def each(batch: DataFrame, number: int) -> None:
        batch.withColumn("_batch", F.lit(number).cast("long")).write.mode("overwrite").parquet(f"{path}/number={number}")

    stream = changes.writeStream.outputMode("update").foreachBatch(each).option("checkpointLocation", checkpoint)
    return (stream.trigger(once=True) if ttl else stream.trigger(availableNow=True)).start()


def read_latest(spark: SparkSession, path: str, schema: StructType, key: str) -> DataFrame:
    """The state that the batches' changes lead to: each key's last change, without the deleted ones."""
    full = StructType([*schema.fields]).add("_batch", "long")
    return latest_by(spark.read.schema(full).parquet(f"{path}/*"), [key], "_batch").where("NOT _deleted").drop("_deleted", "_batch")
