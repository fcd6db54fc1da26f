from __future__ import annotations

from datetime import date

COLUMNS = "policy_id string, op string, updated_on date, premium double, status string"


def frame(spark, rows):
    return spark.createDataFrame([(p, o, d and date(2024, 1, d), x, s) for p, o, d, x, s in rows], COLUMNS)


def exchanges(df) -> int:
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


OLD = [("A", "I", 1, 1.0, "e"), ("B", "I", 1, None, None), ("C", "I", 1, 1.0, "e"), (None, "I", 1, 1.0, "e"), ("D", "I", None, 1.0, "e"), ("E", "I", 1, float("nan"), "e"), ("F", "U", 1, 1.0, "e"), (None, "I", 2, 1.0, "e")]
NEW = [("A", "I", 1, 1.0, "e"), ("A", "U", 2, 1.0, "e"), ("B", "I", 1, None, "e"), ("C", "U", 1, 1.0, "e"), (None, "I", 1, 2.0, "e"), ("D", "I", None, 2.0, "e"), ("E", "I", 1, float("nan"), "e"), ("G", "X", 3, 1.0, "e"), ("G", "I", 2, 1.0, "e"), ("H", "I", 1, 1.0, "e"), ("H", "I", 2, 1.0, "e")]


def test_changed_events_by_one_shuffle(spark):
    from tidemark.operators.merge import immutable_conflicts

    found = immutable_conflicts(frame(spark, OLD), frame(spark, NEW))
    assert exchanges(found) == 1 and sorted(map(tuple, found.collect())) == [("B", date(2024, 1, 1)), ("C", date(2024, 1, 1))]
    # Within a batch, as the batch is checked against itself too.
    twice = frame(spark, [("A", "U", 2, 1.0, "e"), ("A", "U", 2, 1.0, "x"), ("B", "U", 2, 1.0, "e"), ("B", "U", 2, 1.0, "e")])
    assert [r.policy_id for r in immutable_conflicts(frame(spark, OLD).unionByName(twice), twice).collect()] == ["A"]


def test_operations_by_one_shuffle(spark):
    from tidemark.operators.merge import op_violations

    found = op_violations(frame(spark, NEW), frame(spark, OLD))
    assert exchanges(found) == 1 and sorted(map(tuple, found.collect())) == [("G", 1, 1), ("H", 2, 0)]  # F isn't touched


def test_a_batch_with_repeats_is_stored_once(spark, tmp_path):
    from tidemark.streaming import cdc

    rows = frame(spark, [("A", "I", 1, 1.0, "e")] * 3 + [("A", "U", 2, 2.0, "e")] * 2)
    cdc.apply_batch(rows, str(tmp_path), "one", buckets=4)
    assert cdc.history(spark, str(tmp_path), rows.schema).count() == 2
    assert [tuple(r) for r in cdc.active(spark, str(tmp_path), rows.schema).select("policy_id", "premium").collect()] == [("A", 2.0)]
