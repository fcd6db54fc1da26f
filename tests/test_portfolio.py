"""Classification and cohort scenario, parsing traps, as-of equivalence, plans."""

from __future__ import annotations

from datetime import date
from decimal import Decimal

import pytest

CUTOFF = "2024-02-29"
EVENTS = [
    ("A", 1, "I", 1, 100, "ARS", "EMITIDA"), ("A", 1, "U", 5, 200, "ARS", "ANULADA"), ("B", 2, "I", 2, 10, "USD", "EMITIDA"), ("B", 2, "U", 6, 20, "USD", "VENCIDA"),
    ("C", 3, "I", 3, 10, "ARS", "EMITIDA"), ("D", 4, "I", 4, 10, "ARS", "EMITIDA"), ("D", 4, "D", 8, 10, "ARS", "EMITIDA"), ("E", 8, "I", 8, 5, "ARS", "EMITIDA"), ("F", 10, "I", 10, 10, "USD", "EMITIDA"),
]
CLAIMS = [
    ("S1", "A", (1, 3), "PAGADO", 10, "ARS"), ("S2", "B", (1, 3), "RECHAZADO", 40, "USD"), ("S3", "Z", (1, 9), "PAGADO", 10, "ARS"), ("S4", "C", (1, 10), "PAGADO", 20, "USD"),
    ("S5", "C", (1, 3), "PAGADO", 4, None), ("S6", "C", (1, 3), "PAGADO", -9, "ARS"), ("S7", "C", (1, 3), "PAGADO", -9, None), ("S8", "Z", (1, 3), "PAGADO", 2, None),
    ("S9", "F", (2, 7), "PAGADO", 30, "USD"), ("S10", "D", (1, 9), "PAGADO", 15, "USD"), ("S11", "C", (3, 1), "PAGADO", 40, "USD"),
]


@pytest.fixture(scope="module")
def world(spark):
    rows = [
        (p, "PRD", "AG", "AR", "WEB", date(2024, 1, i), date(2024, 1, 10) if p == "F" else date(2024, 1, 1), date(2024, 2, 10) if p == "F" else date(2024, 1, 31), Decimal(x), c, s, op, date(2024, 1, u))
        for p, i, op, u, x, c, s in EVENTS
    ]
    history = spark.createDataFrame(rows, "policy_id string, product_id string, agency_id string, country string, channel string, issued_on date, cover_start date, cover_end date, premium decimal(19,9), currency string, status string, op string, updated_on date")
    claims = spark.createDataFrame([(i, p, date(2024, *d), s, Decimal(a), c) for i, p, d, s, a, c in CLAIMS], "claim_id string, policy_id string, occurred_on date, status string, amount decimal(19,9), currency string")
    fx = spark.createDataFrame([(date(2024, 1, d), "ARS", Decimal(f)) for d, f in ((1, 1), (5, 2), (10, 3))], "rate_date date, currency string, factor_usd decimal(18,9)")
    products = spark.createDataFrame([("PRD", "Plan médico", "MEDICO", True)], "product_id string, plan_name string, product_type string, is_premium boolean")
    agencies = spark.createDataFrame([("AG", "ONLINE")], "agency_id string, channel string")
    return history, claims, fx, products, agencies


def test_flags(world):
    from tidemark.operators.classify import classify

    history, claims, fx, *_ = world
    got = {r.claim_id: r for r in classify(claims, history, fx).collect()}
    assert len(got) == len(CLAIMS)
    assert got["S3"].cover_state == "POLIZA_AUSENTE" and got["S11"].cover_state == "FUERA_PERIODO" and got["S1"].cover_state == "COINCIDE"
    assert (got["S5"].claim_currency, got["S5"].currency_origin, got["S5"].amount_state) == ("ARS", "INFERIDA_POLIZA", "VALIDO_MONEDA_INFERIDA")
    assert got["S6"].amount_state == "MONTO_NEGATIVO" and got["S6"].amount == -9
    assert got["S7"].amount_state == "MONTO_NEGATIVO_Y_MONEDA_NULA" and got["S7"].excluded
    assert got["S8"].amount_state == "MONEDA_NO_RECUPERABLE" and got["S8"].excluded
    late = history.unionByName(history.where("policy_id = 'C'").withColumn("policy_id", __import__("pyspark.sql.functions", fromlist=["lit"]).lit("Z")))
    got = {r.claim_id: r for r in classify(claims, late, fx).collect()}
    assert got["S3"].cover_state == "COINCIDE" and not got["S8"].excluded and got["S8"].claim_currency == "ARS"


def test_mart(world):
    from tidemark.operators import checks, cohort
    from tidemark.operators.classify import claim_scope, classify
    from tidemark.operators.merge import current_state

    history, claims, fx, products, agencies = world
    active, flagged = current_state(history), classify(claims, history, fx)
    policies = cohort.policy_values(active, products, agencies, fx, CUTOFF)
    values = cohort.claim_values(flagged, active, fx, CUTOFF)
    detail = cohort.policy_detail(policies, cohort.claims_by_policy(values))
    mart = cohort.cohort_mart(detail)
    assert mart.columns == cohort.MART_COLUMNS and len(mart.columns) == 37
    (r,) = mart.collect()
    assert (r.date, r.day_of_week, r.day, r.prima_usd, r.polizas) == (date(2024, 1, 1), "lunes", 1, 50, 4)
    assert (r.siniestros, r.siniestros_excluidos, r.siniestros_pagados, r.siniestros_pagados_excluidos, r.costo_pagado_usd) == (4, 2, 3, 2, 54)
    assert (r.siniestros_pagados_con_periodo, r.costo_pagado_con_periodo_usd, r.siniestros_pagados_moneda_inferida) == (3, 54, 1)
    scoped = claim_scope(flagged, active, CUTOFF)
    assert scoped.where("scope = 'INCLUIDO'").count() == 6 and detail.count() == 4
    assert len(checks.run_checks(checks.gold_checks(mart, detail, policies, values, active, scoped, CUTOFF), checks.gold_stops(policies, scoped, fx, CUTOFF))) == 29
    checks.assert_contract(mart, mart.dtypes, forbid_ids=True)
    with pytest.raises(checks.ChecksFailed, match="POLICY_COUNT"):
        checks.run_checks(checks.gold_checks(mart, detail, policies.limit(3), values, active, scoped, CUTOFF))
    none = mart.limit(0)
    with pytest.raises(checks.ChecksFailed):
        checks.assert_equal(mart, none)


def test_interval_and_daily_rates_agree(spark, world):
    from pyspark.sql import functions as F

    from tidemark.operators.fx import asof_rate, fx_daily

    fx = world[2].unionByName(spark.createDataFrame([(date(2024, 1, 7), "ARS", Decimal(-1)), (date(2024, 1, 3), "BRL", Decimal(2))], "rate_date date, currency string, factor_usd decimal(18,9)"))
    days = spark.sql("SELECT explode(sequence(date'2023-12-28', date'2024-01-20')) AS d").crossJoin(spark.createDataFrame([("ARS",), ("BRL",), ("CLP",)], "c string"))
    daily = fx_daily(fx, F.lit("2023-12-28").cast("date"), F.lit("2024-01-20").cast("date"))
    grid = days.join(daily, (F.col("c") == F.col("currency")) & (F.col("d") == F.col("day")), "left").select("d", "c", "factor_usd")
    want = {(r.d, r.c): r.factor_usd for r in grid.collect()}
    assert want[(date(2024, 1, 4), "ARS")] == 1 and want[(date(2024, 1, 9), "ARS")] == 2 and want[(date(2024, 1, 10), "ARS")] == 3
    for how in (None, "broadcast", "merge"):
        assert {(r.d, r.c): r.rate for r in asof_rate(days, fx, "d", "c", how=how).collect()} == want


def test_dates_and_scalars(spark):
    from pyspark.sql import functions as F

    from tidemark.functions.expr import json_scalar, parse_bool, parse_date_multi, source_key

    df = spark.createDataFrame([("2024-01-01T23:30:00-05:00",), ("31/01/2024",), ("2024-1-5",), ("x",), (None,)], "t string")
    assert [r[0] for r in df.select(parse_date_multi("t", day_first=True)).collect()] == [date(2024, 1, 2), date(2024, 1, 31), date(2024, 1, 5), None, None]
    j = spark.createDataFrame([('{"a":{"b":1}}',), ('{"a":"{x"}',), ('{"a":1.5}',), ("no",)], "j string")
    assert [r[0] for r in j.select(json_scalar("j", "$.a")).collect()] == [None, "{x", "1.5", None]
    k = spark.createDataFrame([("a", None), ("a", "b")], "x string, y string")
    assert [r[0] for r in k.select(source_key("x", "y")).collect()] == [None, "a|b"]
    b = spark.createDataFrame([("1",), ("TRUE",), ("0",), ("no",)], "b string")
    assert [r[0] for r in b.select(parse_bool(F.col("b"))).collect()] == [True, True, False, None]


def test_money_keeps_nine_places(spark):
    from tidemark.functions.expr import money

    df = spark.createDataFrame([(Decimal("1.000000001"), Decimal("0.333333333"))], "a decimal(19,9), r decimal(18,9)")
    assert df.select(money("a", "r")).first()[0] == Decimal("0.333333333")


def test_plans(spark):
    from tidemark.plans.registry import QUERIES

    plan = QUERIES["loss_ratio_country_plan"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "PushedFilters" in plan


def test_entry_and_names(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())


def test_runs_publish_after_checks(spark, tmp_path):
    from tidemark.sources.batches import already_applied, apply_run, batch_fingerprint, publish, read_published, runs

    path, df = str(tmp_path), spark.createDataFrame([("a", 1)], "resource string, v int")

    def fail(written):
        raise ValueError("no")

    with pytest.raises(LookupError):
        read_published(spark, path, "mart")
    assert publish(spark, path, "r1", "mart", df, lambda w: None)
    with pytest.raises(ValueError):
        publish(spark, path, "r2", "mart", df.limit(0), fail)
    assert read_published(spark, path, "mart").count() == 1
    assert [(r.run_status, r.error_message) for r in runs(spark, path).where("run_id = 'r2'").collect()] == [("FAILED", "no")]
    fp = batch_fingerprint(["a"], [("f", 1, "x")])
    assert fp != batch_fingerprint(["a"], [("f", 2, "x")]) and not already_applied(spark, path, fp)
    both = {"mart": df.unionAll(df), "detail": df}
    assert apply_run(spark, path, "r3", both, lambda w: None, fp) and not apply_run(spark, path, "r3", both, lambda w: None, fp)
    assert apply_run(spark, path, "r3", both, lambda w: None, fp, replay=True)
    assert read_published(spark, path, "mart").count() == 2 and read_published(spark, path, "detail").count() == 1


def test_page_files(spark, tmp_path):
    import gzip
    import hashlib
    import json

    from tidemark.sources import pages as src

    folder = tmp_path / "siniestros"
    folder.mkdir()
    bodies = ['{"data":[{"claim_id":"1","v":NaN},"x"]}', '{"data":[{"claim_id":"2","v":[1,{"w":-Infinity}],"é":1}]}']
    meta = []
    for i, b in enumerate(bodies, 1):
        (folder / f"page-{i:06d}.json.gz").write_bytes(gzip.compress(b.encode()))
        meta.append({"page_number": i, "rows_received": 2 if i == 1 else 1, "response_sha256": hashlib.sha256(b.encode()).hexdigest(), "saved_at": "2024-01-05T00:00:00Z"})
    (tmp_path / "manifest.json").write_text(json.dumps({"run_id": "r", "resources": {"siniestros": {"pages": meta}}}))
    files, manifest = src.read_page_files(spark, str(tmp_path), "siniestros"), src.page_manifest(spark, f"{tmp_path}/manifest.json")
    records = src.parse_pages(files, "siniestros")
    src.assert_pages(files, manifest, records)
    got = {(r.page_number, r.record_index): r for r in records.collect()}
    assert got[(1, 0)].payload == '{"claim_id":"1","v":{"__non_finite_number__":"NaN"}}' and not got[(1, 1)].is_object
    assert got[(2, 0)].payload == '{"claim_id":"2","v":[1,{"w":{"__non_finite_number__":"-Infinity"}}],"é":1}'
    assert {tuple(r)[3:] for r in src.non_finite_ledger(records).collect()} == {("$.v", "NaN"), ("$.v[1].w", "-Infinity")}
    with pytest.raises(src.IntegrityError):
        src.assert_pages(files, manifest.where("page_number = 1"), records)
    src.assert_same_batch(manifest, manifest)
    with pytest.raises(src.IntegrityError):
        src.assert_same_batch(manifest, manifest.where("page_number = 1"))
    raw = src.to_raw(records, manifest, "r", "siniestros")
    assert raw.columns == src.RAW_COLUMNS
    with pytest.raises(ValueError):
        src.read_raw(spark, "x", "r", None, None)
    src.write_ndjson(raw, f"{tmp_path}/nd")
    assert spark.read.json(f"{tmp_path}/nd").count() == 3
    raw.write.parquet(f"{tmp_path}/t")
    assert src.clone_table(spark, f"{tmp_path}/t", f"{tmp_path}/u") == 3
    src.write_layout(raw, f"{tmp_path}/l", "ingested_at", ["source_key"])
    assert spark.read.parquet(f"{tmp_path}/l").where("month = '2024-01'").count() == 3
    assert src.run_record(manifest, "r", False).first().rows == 3


def test_records_are_written_as_python_would(spark):
    import json
    import math

    from tidemark.sources.pages import NON_FINITE, written

    value = {"z": [1, {"b": math.nan, "a": [-math.inf, []]}], "é": {"": {}}, "a": "\"x\u2028", "n": None, "t": True, "f": 1e22}
    plain = {"z": [1, {"b": {NON_FINITE: "NaN"}, "a": [{NON_FINITE: "-Infinity"}, []]}], "é": {"": {}}, "a": "\"x\u2028", "n": None, "t": True, "f": 1e22}
    text, ledger = written(value)
    assert text == json.dumps(plain, sort_keys=True, separators=(",", ":"), ensure_ascii=False)
    assert dict(ledger) == {"$.z[1].b": "NaN", "$.z[1].a[0]": "-Infinity"}
    deep = "x"
    for _ in range(5000):
        deep = [deep]
    assert written(deep)[0] == "[" * 5000 + '"x"' + "]" * 5000


def test_timestamps_are_iso_or_null(spark):
    from tidemark.functions.expr import norm_ts, utc_date

    rows = ["2024-01-31T23:30:00-02:00", "2024-01-31T23:30:00Z", "2024-01-31 23:30", "2024-01-31", "2024-02-30", "10:00", "2024", "2024-01", "x", "", None, "2024-01-31T23:30:00.5+0130"]
    want = [date(2024, 2, 1), date(2024, 1, 31), date(2024, 1, 31), date(2024, 1, 31), *[None] * 7, date(2024, 1, 31)]
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, t string")
    zone = spark.conf.get("spark.sql.session.timeZone")
    for z in ("UTC", "America/Lima", "Asia/Tokyo"):
        spark.conf.set("spark.sql.session.timeZone", z)
        try:
            assert [r[0] for r in df.orderBy("i").select(utc_date(norm_ts("t"))).collect()] == want
        finally:
            spark.conf.set("spark.sql.session.timeZone", zone)


def test_leaves_of_any_depth(spark):
    from tidemark.operators.profile import json_leaves

    df = spark.createDataFrame([('{"a":{"b":[{"c":{"d":{"e":{"f":[1,{"g":"}}}]]"}]}}}}]}}',), ("[]",), ("no",), (None,)], "j string")
    assert {(r.path, r.value) for r in json_leaves(df, "j", []).collect()} == {("a.b[].c.d.e.f[]", "1"), ("a.b[].c.d.e.f[].g", "}}}]]")}


def test_replay_of_raw_adds_nothing(spark, tmp_path):
    from tidemark.sources import pages as src

    df = spark.sql("SELECT timestamp'2024-01-05 00:00:00' AS ingested_at, '007' AS run_id, 'b' AS batch_id, 'claims' AS resource, 's' AS snapshot_id, 1L AS page_number, id AS record_index, 'k' AS source_key, timestamp'2024-01-05 00:00:00' AS source_updated_at, 'h' AS record_hash, 'f' AS source_file, '{}' AS payload FROM range(4)")
    for run in ("007", "007", "008"):
        src.write_raw(df.withColumn("run_id", df.run_id if run == "007" else df.payload), f"{tmp_path}/raw")
    rows = src.read_raw(spark, f"{tmp_path}/raw", "007", "2024-01-05", "2024-01-05")
    assert rows.count() == 4 and rows.first().run_id == "007"
    for _ in range(2):  # a later part of the same run, day and resource leaves the first
        src.write_raw(df.selectExpr("* EXCEPT (page_number)", "2L AS page_number"), f"{tmp_path}/raw", part="2")
    rows = src.read_raw(spark, f"{tmp_path}/raw", "007", "2024-01-05", "2024-01-05")
    assert sorted(r.page_number for r in rows.collect()) == [1] * 4 + [2] * 4


def test_latest_of_null_orders_and_ties(spark):
    from tidemark.operators.relational import latest_by

    df = spark.createDataFrame([("a", None, 1), ("b", 1, 2), ("b", None, 3), ("c", 1, 4), ("c", 1, 5)], "k string, at int, v int")
    got = {r.k: r.v for r in latest_by(df, ["k"], "at").collect()}
    assert (got["a"], got["b"]) == (1, 2) and all({r.k: r.v for r in latest_by(df.repartition(n), ["k"], "at").collect()} == got for n in (1, 3))


def test_asof_plans_start_no_job(spark):
    from tidemark.operators.fx import asof_rate

    fx = spark.createDataFrame([(date(1850, 1, 1), "ARS", Decimal(2)), (date(2024, 1, 15), "ARS", Decimal(3)), (date(2024, 1, 20), "ARS", Decimal(-1))], "rate_date date, currency string, factor_usd decimal(18,9)")
    days = [date(1849, 12, 31), date(1850, 1, 1), date(1999, 5, 5), date(2024, 1, 14), date(2024, 1, 31), date(2500, 1, 1), None]
    df = spark.createDataFrame([(d, c) for d in days for c in ("ARS", "USD", None)], "d date, c string")
    spark.sparkContext.setJobGroup("asof", "asof")
    out = asof_rate(df, fx, "d", "c")
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("asof")
    got = {(r.d, r.c): r.rate and int(r.rate) for r in out.collect()}
    assert [got[d, "ARS"] for d in days] == [None, 2, 2, 2, 3, 3, None]
    assert all(got[d, "USD"] == 1 and got[d, None] is None for d in days)
