"""Loads, runs and publications in plain partitioned Parquet.

A load or a run writes a folder of its own and then one row to a table of receipts
or runs.  What has no row isn't read, so a run that fails leaves the
publication before it as it was, and one that comes again replaces only its own folder.
"""

from __future__ import annotations

import hashlib
import json
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MODEL_VERSION = "1"
RUNS = "run_id string, run_status string, fingerprint string, versions map<string,string>, error_message string, finished_at timestamp"


def work_dir(spark: SparkSession, label: str) -> str:
    """A new folder under ``spark.checkpoint.dir``; a temporary one only where the session names none."""
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not root:
        root = "file://" + tempfile.mkdtemp(prefix="tidemark-")
        sc.setCheckpointDir(root)
    return f"{root.rstrip('/')}/tidemark-tables/{label}-{uuid.uuid4().hex}"


def read_if_there(spark: SparkSession, path: str, schema) -> DataFrame:
    """The Parquet table under a path; without one, no rows."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


# ---- loads


def append_raw(df: DataFrame, path: str, identity: str) -> bool:
    """Append once per identity (table, source digest, schema digest); False if it is in already.

    A load's folder is named by its identity, so one that broke off, or that
    two writers bring at once, is there once in the end.
    """
    spark, load = df.sparkSession, hashlib.sha256(identity.encode()).hexdigest()[:32]
    if loads(spark, path).where(F.col("load") == load).take(1):
        return False
    df.write.mode("overwrite").parquet(f"{path}/rows/load={load}")
    spark.createDataFrame([(load, identity)], "load string, identity string").coalesce(1).write.mode("overwrite").parquet(f"{path}/receipts/of={load}")
    return True


def loads(spark: SparkSession, path: str) -> DataFrame:
    return read_if_there(spark, f"{path}/receipts", "load string, identity string")


def read_loads(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The rows of all loads that have a receipt."""
    return read_if_there(spark, f"{path}/rows", f"{schema}, load string").join(loads(spark, path), "load", "left_semi").drop("load")


def verify_loaded(raw: DataFrame, expected: dict[str, int]) -> bool:
    """Whether the rows per resource are those of the manifest; only then is a loaded batch skipped."""
    found = {r["resource"]: r["n"] for r in raw.groupBy("resource").agg(F.count(F.lit(1)).alias("n")).collect()}
    return all(found.get(k, 0) == n for k, n in expected.items())


# ---- runs


def batch_fingerprint(resources: list[str], files: list[tuple[str, int, str]]) -> str:
    """Of the resources, each file's name, rows and digest, and the model's version."""
    body = json.dumps([sorted(resources), sorted(files), MODEL_VERSION])
    return hashlib.sha256(body.encode()).hexdigest()


def runs(spark: SparkSession, path: str) -> DataFrame:
    """A row per run that ended, failed ones too."""
    return read_if_there(spark, f"{path}/runs", RUNS)


def record_run(spark: SparkSession, path: str, run_id: str, status: str, fingerprint: str | None = None, versions: dict[str, str] | None = None, error: str | None = None) -> None:
    row = spark.createDataFrame([(run_id, status, fingerprint, versions or {}, error)], RUNS.rsplit(",", 1)[0]).withColumn("finished_at", F.current_timestamp())
    row.coalesce(1).write.mode("append").parquet(f"{path}/runs")


def already_applied(spark: SparkSession, path: str, fingerprint: str) -> bool:
    return bool(runs(spark, path).where((F.col("run_status") == "SUCCESS") & (F.col("fingerprint") == fingerprint)).take(1))


def apply_run(spark: SparkSession, path: str, run_id: str, tables: dict[str, DataFrame], check: Callable[[dict[str, DataFrame]], None], fingerprint: str | None = None, replay: bool = False) -> bool:
    """Write candidates, check what was written, publish all of them by one row; nothing changes if a check fails.

    False if a batch of this fingerprint was applied before (unless it is
    replayed).  A failure is recorded and raised.
    """
    if fingerprint and not replay and already_applied(spark, path, fingerprint):
        return False
    versions = {name: f"{path}/{name}/version={run_id}-{uuid.uuid4().hex[:8]}" for name in tables}
    try:
        for name, df in tables.items():
            df.write.parquet(versions[name])
        check({name: spark.read.schema(df.schema).parquet(versions[name]) for name, df in tables.items()})
    except Exception as error:
        record_run(spark, path, run_id, "FAILED", fingerprint, error=str(error)[:2000])
        raise
    record_run(spark, path, run_id, "SUCCESS", fingerprint, versions)
    return True


def publish(spark: SparkSession, path: str, run_id: str, table: str, candidate: DataFrame, check: Callable[[DataFrame], None]) -> bool:
    """Replace a table by a checked candidate."""
    return apply_run(spark, path, run_id, {table: candidate}, lambda written: check(written[table]))


def read_published(spark: SparkSession, path: str, table: str) -> DataFrame:
    """A table as the last successful run that has it left it."""
    done = runs(spark, path).where((F.col("run_status") == "SUCCESS") & F.map_contains_key("versions", table))
    last = done.agg(F.max_by(F.col("versions")[table], F.struct("finished_at", "run_id")).alias("at")).first()["at"]
    if last is None:
        raise LookupError(f"{table} has not been published")
    return spark.read.parquet(last)
