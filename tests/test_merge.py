"""Change capture scenario, its store and its stream."""

from __future__ import annotations

from datetime import date

import pytest

SCHEMA = "policy_id string, op string, updated_on date, premium double, status string"
STEPS = [
    [("A", "I", 1, 100.0, "EMITIDA"), ("B", "I", 1, 50.0, "EMITIDA")],
    [("A", "U", 3, 150.0, "ANULADA"), ("A", "U", 2, 120.0, "EMITIDA")],
    [("A", "D", 5, 150.0, "ANULADA")],
    [("A", "U", 4, 130.0, "EMITIDA"), ("B", "U", 2, 70.0, "VENCIDA")],
    [("A", "U", 4, 130.0, "EMITIDA"), ("B", "U", 2, 70.0, "VENCIDA")],
    [("A", "U", 6, 200.0, "VIGENTE")],
]
WANT = [
    {"A": (100.0, "EMITIDA"), "B": (50.0, "EMITIDA")},
    {"A": (150.0, "ANULADA"), "B": (50.0, "EMITIDA")},
    {"B": (50.0, "EMITIDA")},
    {"B": (70.0, "VENCIDA")},
    {"B": (70.0, "VENCIDA")},
    {"A": (200.0, "VIGENTE"), "B": (70.0, "VENCIDA")},
]


def frame(spark, rows):
    return spark.createDataFrame([(p, o, date(2024, 1, d), x, s) for p, o, d, x, s in rows], SCHEMA)


def state(df):
    return {r.policy_id: (r.premium, r.status) for r in df.collect()}


def active(spark, path):
    from tidemark.streaming import cdc

    return state(cdc.active(spark, str(path), spark.createDataFrame([], SCHEMA).schema))


def test_steps(spark, tmp_path):
    from tidemark.streaming import cdc

    schema = spark.createDataFrame([], SCHEMA).schema
    for i, (rows, want) in enumerate(zip(STEPS, WANT)):
        assert cdc.apply_batch(frame(spark, rows), str(tmp_path), f"run-{i}", buckets=4)
        assert active(spark, tmp_path) == want, i
    assert cdc.history(spark, str(tmp_path), schema).count() == 8 and cdc.state_equals_history(spark, str(tmp_path), schema)
    assert not cdc.apply_batch(frame(spark, STEPS[-1]), str(tmp_path), "run-5", buckets=4)


def test_a_batch_that_broke_off_comes_again(spark, tmp_path, monkeypatch):
    """After history and before the state, and after the state and before the run's row."""
    from tidemark.streaming import cdc

    schema = spark.createDataFrame([], SCHEMA).schema
    cdc.apply_batch(frame(spark, STEPS[0]), str(tmp_path), "a", buckets=4)
    for name in ("latest_by", "record_run"):
        real = getattr(cdc, name)
        monkeypatch.setattr(cdc, name, lambda *a, **k: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            cdc.apply_batch(frame(spark, STEPS[1]), str(tmp_path), "b", buckets=4)
        monkeypatch.setattr(cdc, name, real)
    assert cdc.apply_batch(frame(spark, STEPS[1]), str(tmp_path), "b", buckets=4)
    assert active(spark, tmp_path) == WANT[1] and cdc.history(spark, str(tmp_path), schema).count() == 4


def test_a_batch_reads_its_buckets_only(spark, tmp_path):
    from tidemark.streaming import cdc

    many = [(f"P{i}", "I", 1, float(i), "EMITIDA") for i in range(300)]
    cdc.apply_batch(frame(spark, many), str(tmp_path), "all", buckets=8)
    seen = []
    real = cdc.op_violations
    cdc.op_violations = lambda batch, old: seen.append(old) or real(batch, old)
    try:
        cdc.apply_batch(frame(spark, [("P7", "U", 2, 1.0, "VENCIDA")]), str(tmp_path), "one", buckets=8)
    finally:
        cdc.op_violations = real
    assert seen[0].count() < 100
    assert "PartitionFilters: [" in seen[0]._jdf.queryExecution().executedPlan().toString()
    folders = {p.name for p in (tmp_path / "history").glob("bucket=*/batch=one")}
    assert len(list((tmp_path / "history").glob("bucket=*/batch=one"))) == 1 and folders == {"batch=one"}
    assert active(spark, tmp_path)["P7"] == (1.0, "VENCIDA") and len(active(spark, tmp_path)) == 300


@pytest.mark.parametrize("rows", [[("C", "U", 2, 1.0, "EMITIDA")], [("A", "U", 1, 999.0, "EMITIDA")], [("A", "X", 9, 1.0, "EMITIDA")]])
def test_bad_batches_change_nothing(spark, tmp_path, rows):
    """An update of an unseen policy, a changed event, an unknown operation."""
    from tidemark.operators.checks import ChecksFailed
    from tidemark.sources.batches import runs
    from tidemark.streaming import cdc

    cdc.apply_batch(frame(spark, STEPS[0]), str(tmp_path), "good")
    with pytest.raises(ChecksFailed):
        cdc.apply_batch(frame(spark, rows), str(tmp_path), "bad")
    assert active(spark, tmp_path) == WANT[0] and cdc.history(spark, str(tmp_path), frame(spark, rows).schema).count() == 2
    assert {r.run_id: r.run_status for r in runs(spark, str(tmp_path)).collect()} == {"good": "SUCCESS", "bad": "FAILED"}


def test_order_of_batches_does_not_matter(spark, tmp_path):
    from tidemark.operators.merge import live, merge_current, merge_history

    one, two = frame(spark, STEPS[0] + STEPS[2]), frame(spark, STEPS[1] + STEPS[3])
    states = []
    for batches in ((one, two), (two, one)):
        history = active = one.limit(0)
        for b in batches:
            history = history.unionByName(merge_history(history, b))
            active = live(merge_current(active, history, b))
        states.append(state(active))
    assert states[0] == states[1] == WANT[3]


def test_stream_with_replay_and_late_events(spark, tmp_path):
    from tidemark.streaming.cdc import start_cdc_stream

    source, path = f"{tmp_path}/in", f"{tmp_path}/tables"
    for rows, want in zip(STEPS, WANT):
        frame(spark, rows).coalesce(1).write.mode("append").parquet(source)
        start_cdc_stream(spark.readStream.schema(SCHEMA).parquet(source), path, f"{tmp_path}/check", buckets=4).awaitTermination()
        assert active(spark, path) == want
    # A stream on a new checkpoint, which counts from zero again, changes nothing and loses nothing.
    start_cdc_stream(spark.readStream.schema(SCHEMA).parquet(source), path, f"{tmp_path}/check2", buckets=4).awaitTermination()
    assert active(spark, path) == WANT[5]


def test_loads_once(spark, tmp_path):
    from tidemark.sources.batches import append_raw, read_loads, verify_loaded

    path, df = str(tmp_path), spark.createDataFrame([("a", 1), ("b", 2)], "resource string, v long")
    assert read_loads(spark, path, "resource string, v long").count() == 0
    assert append_raw(df, path, "one") and not append_raw(df, path, "one") and append_raw(df, path, "two")
    df.write.parquet(f"{path}/rows/load=broken")  # no receipt
    got = read_loads(spark, path, "resource string, v long")
    assert got.count() == 4 and got.columns == ["resource", "v"]
    assert verify_loaded(got, {"a": 2, "b": 2}) and not verify_loaded(got, {"a": 3}) and not verify_loaded(got, {"c": 1})


def test_claims_upsert_and_catalog_refresh(spark):
    from tidemark.operators.merge import is_fresh, live, mutation_counts, refresh_dimension, upsert

    df = lambda rows: spark.createDataFrame(rows, "k string, v string")
    old = df([("C1", "100"), ("C2", "50")])
    up = upsert(old, df([("C1", "120")]), "k")
    assert {tuple(r) for r in up.collect()} == {("C1", "120", "update"), ("C2", "50", "keep")}
    again = upsert(live(up), df([("C1", "120")]), "k")
    assert {r.action: r.rows for r in mutation_counts(again).collect()} == {"keep": 2}
    assert {tuple(r) for r in live(refresh_dimension(old, df([("C1", None), ("C3", "x")]), "k")).collect()} == {("C1", None), ("C3", "x")}
    assert live(refresh_dimension(old, df([]), "k")).count() == 0
    assert not is_fresh("agencies", date(2024, 1, 1), {"agencies": date(2024, 2, 1)})
    assert is_fresh("agencies", date(2024, 2, 1), {"agencies": date(2024, 2, 1)}) and not is_fresh("agencies", None, {})
    assert is_fresh("policies", None, {})


def test_reviews(spark):
    from tidemark.operators.merge import merge_reviews

    claims = lambda rows: spark.createDataFrame(rows, "claim_id string, amount double, currency string, claim_currency string, amount_state string, cover_state string, currency_origin string")
    none = spark.createDataFrame([], "claim_id string, issue_code string, first_seen_at timestamp, last_seen_at timestamp, review_status string, suggested_currency string")
    one = merge_reviews(none, claims([("S1", -1.0, "USD", "USD", "x", "COINCIDE", "FUENTE"), ("S2", 1.0, None, None, "x", "COINCIDE", "NO_DISPONIBLE")]), "2024-01-01")
    got = {(r.claim_id, r.issue_code): r.review_status for r in one.collect()}
    assert got == {("S1", "MONTO_NEGATIVO"): "PENDING", ("S2", "MONEDA_NULA"): "PENDING", ("S2", "MONEDA_NO_RECUPERABLE"): "PENDING"}
    two = merge_reviews(one, claims([("S1", 1.0, "USD", "USD", "x", "COINCIDE", "FUENTE"), ("S2", 1.0, None, "ARS", "x", "COINCIDE", "INFERIDA_POLIZA")]), "2024-01-02")
    got = {(r.claim_id, r.issue_code): (r.review_status, r.suggested_currency, r.first_seen_at.day) for r in two.collect()}
    assert got == {("S1", "MONTO_NEGATIVO"): ("NO_LONGER_PRESENT", None, 1), ("S2", "MONEDA_NULA"): ("INFERENCE_APPLIED", "ARS", 1), ("S2", "MONEDA_NO_RECUPERABLE"): ("NO_LONGER_PRESENT", None, 1)}


def test_state_moves_forward_only(spark):
    from tidemark.operators.merge import advance_state

    state_ = spark.sql("SELECT 'a' AS resource, timestamp'2024-02-01' AS captured_at, 'r1' AS run_id UNION ALL SELECT 'b', timestamp'2024-02-01', 'r1'")
    new = spark.sql("SELECT 'a' AS resource, timestamp'2024-01-01' AS captured_at UNION ALL SELECT 'b', timestamp'2024-03-01' UNION ALL SELECT 'c', timestamp'2024-01-01' UNION ALL SELECT 'd', CAST(NULL AS timestamp)")
    got = {r.resource: (r.captured_at.month, r.run_id) for r in advance_state(state_, new, "r2").collect()}
    assert got == {"a": (2, "r1"), "b": (3, "r2"), "c": (1, "r2")}
