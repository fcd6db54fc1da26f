"""Watermarks that move after the checks, and the latest state in a keyed store."""

from __future__ import annotations

import datetime as dt
import random

import pytest

SCHEMA = "k long, at timestamp, op string, v double"


def at(minutes):
    return dt.datetime(2022, 5, 1) + dt.timedelta(minutes=minutes)


def test_nothing_lost_or_doubled(spark, tmp_path):
    from tidemark.streaming.watermark import Delta

    rng = random.Random(1)
    rows = [(rng.randrange(200), at(rng.randrange(10_000)), rng.choice("IUD"), rng.choice([1.0, None])) for _ in range(2000)]
    rows = sorted(set(rows), key=lambda r: r[1])
    delta = Delta(spark, str(tmp_path), "r", spark.createDataFrame([], SCHEMA).schema, "at", ["k", "op"], 3600, "day")
    assert delta.position() == (0, None) and delta.applied().count() == 0
    late = {i: rng.randrange(0, 59) for i in range(len(rows))}
    total = 0
    for run, cut in enumerate((2000, 5000, 5030, 9000, 10_100)):
        seen = [r for i, r in enumerate(rows) if r[1] + dt.timedelta(minutes=late[i]) <= at(cut)]
        source = spark.createDataFrame(seen + seen[-50:], SCHEMA)

        def fails(written):
            written.count()
            raise RuntimeError("no")

        if run in (1, 2):
            before = delta.position()
            with pytest.raises(RuntimeError):
                delta.run(source, fails)
            assert delta.position() == before
        total += delta.run(source)
        assert total == len(seen) and sorted(map(tuple, delta.applied().drop("batch").collect()), key=str) == sorted(seen, key=str)
        assert delta.run(source) == 0  # again: nothing new
    assert delta.applied().count() == len(rows)
    plan = delta.read(spark.createDataFrame(rows, SCHEMA))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_part" in plan  # only the overlap's days are read again


def test_a_batch_that_another_run_applied(spark, tmp_path):
    from tidemark.streaming.watermark import Delta

    delta = Delta(spark, str(tmp_path), "r", spark.createDataFrame([], SCHEMA).schema, "at", ["k", "op"], 60)
    source = spark.createDataFrame([(1, at(1), "I", 1.0)], SCHEMA)
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        delta.run(source, lambda written: delta.run(source))
    assert delta.applied().count() == 1


def test_latest_state_by_key(spark, tmp_path):
    """Late, repeated and deleting events in four batches, with a time to live, against the history's latest."""
    from tidemark.operators.relational import latest_by
    from tidemark.streaming import latest

    rng = random.Random(2)
    rows = [(rng.randrange(12), at(rng.randrange(40)), rng.choice("IUUD"), float(rng.randrange(3))) for _ in range(150)]
    given = []
    for n in range(4):
        part = rows[n * 35 : n * 35 + 45]  # ten of each batch come again in the next
        given += part
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        stream = spark.readStream.schema(SCHEMA).parquet(f"{tmp_path}/in")
        changes = latest.latest_changes(stream, "k", "at", "op = 'D'", ttl_ms=3_600_000)
        latest.write_changes(changes, f"{tmp_path}/out", f"{tmp_path}/check", ttl=True).awaitTermination()
        all_ = spark.createDataFrame(given, SCHEMA)
        want = latest_by(all_, ["k"], "at").where("op <> 'D'")
        got = latest.read_latest(spark, f"{tmp_path}/out", changes.schema, "k")
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    changed = spark.read.parquet(f"{tmp_path}/out")
    assert changed.groupBy("k", "number").count().where("count > 1").count() == 0
    assert changed.where("number = 3").count() < 12  # only the keys that changed
