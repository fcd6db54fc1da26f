"""Typed parsing of JSON payloads.  Leaves are read as text and cast one by one, so one bad field is one null."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.expr import AMOUNT, RATE, json_scalar, norm_ts, parse_bool, parse_date_multi


def _texts(raw: DataFrame, *paths: str) -> DataFrame:
    """The scalars of the payloads at these paths as text, a column each under its path.

    Payloads are parsed once, in a step of their own, and so are texts: what uses a
    column several times, as dates do, doesn't read it again each time.
    """
    return raw.select("payload", F.try_parse_json("payload").alias("_parsed")).select(*(json_scalar("payload", f"$.{p}", F.col("_parsed")).alias(p) for p in paths))


def _text(path: str) -> Column:
    return F.col(f"`{path}`")


def parse_policies(raw: DataFrame) -> DataFrame:
    names = {"policy_id": "poliza_id", "client_id": "cliente_id", "product_id": "producto_id", "agency_id": "agencia_id", "country": "pais_emision", "channel": "canal_origen"}
    return _texts(raw, *names.values(), "fecha_emision_utc", "inicio_vigencia", "fin_vigencia", "prima", "moneda", "estado", "op", "updated_at").select(
        *(_text(v).alias(k) for k, v in names.items()), norm_ts(_text("fecha_emision_utc")).alias("issued_at"),
        parse_date_multi(_text("inicio_vigencia")).alias("cover_start"), parse_date_multi(_text("fin_vigencia")).alias("cover_end"),
        _text("prima").try_cast(AMOUNT).alias("premium"), _text("moneda").alias("currency"), _text("estado").alias("status"), _text("op").alias("op"),
        norm_ts(_text("updated_at")).alias("updated_at"),
    )


def parse_agencies(raw: DataFrame) -> DataFrame:
    names = {"agency_id": "agencia_id", "name": "nombre", "country": "pais", "channel": "canal"}
    return _texts(raw, *names.values()).select(*(_text(v).alias(k) for k, v in names.items()))


def parse_products(raw: DataFrame) -> DataFrame:
    return _texts(raw, "producto_id", "nombre_plan", "tipo", "cobertura_max_usd", "es_premium").select(
        _text("producto_id").alias("product_id"), _text("nombre_plan").alias("plan_name"), _text("tipo").alias("product_type"),
        _text("cobertura_max_usd").try_cast(AMOUNT).alias("max_cover_usd"), parse_bool(_text("es_premium")).alias("is_premium"),
    )


def parse_fx(raw: DataFrame) -> DataFrame:
    return _texts(raw, "fecha", "moneda", "factor_usd", "unidades_por_usd").select(
        parse_date_multi(_text("fecha")).alias("rate_date"), _text("moneda").alias("currency"),
        _text("factor_usd").try_cast(RATE).alias("factor_usd"), _text("unidades_por_usd").try_cast(RATE).alias("units_per_usd"),
    )


def parse_claims(raw: DataFrame) -> DataFrame:
    """Nested amount; city and diagnosis under either of two names; dates with the day first or ISO."""
    date = lambda n: parse_date_multi(_text(n), day_first=True)
    texts = _texts(
        raw, "claim_id", "policy_id", "occurred_at", "reported_at", "type", "status", "amount.value", "amount.currency",
        "detail.city", "detail.ciudad_atencion", "detail.diagnosis", "detail.diagnostico", "detail.proveedor",
    )
    return texts.select(
        _text("claim_id").alias("claim_id"), _text("policy_id").alias("policy_id"), date("occurred_at").alias("occurred_on"), date("reported_at").alias("reported_on"),
        _text("type").alias("claim_type"), _text("status").alias("status"), _text("amount.value").try_cast(AMOUNT).alias("amount"), _text("amount.currency").alias("currency"),
        F.coalesce(_text("detail.city"), _text("detail.ciudad_atencion")).alias("city"), F.coalesce(_text("detail.diagnosis"), _text("detail.diagnostico")).alias("diagnosis"),
        _text("detail.proveedor").alias("provider"),
    )


def batch_checks(parsed: DataFrame, keys: list[str], expected_rows: int | DataFrame) -> DataFrame:
    """One row: rows parsed and expected, rows without a key, keys of several versions.

    ``expected_rows``: a number, or a manifest whose rows_received add up to it.
    """
    missing = F.lit(False)
    for k in keys:
        missing |= F.col(k).isNull()
    # Versions of a key by the least and largest of two hashes of the whole row, a null told from any value by its place.
    marked = [x for c in parsed.columns for x in (F.col(c).isNull(), F.col(c))]
    prints = {f"_h{k}": F.xxhash64(F.lit(k), *marked) for k in (0, 1)}
    per = parsed.select(*keys, *(h.alias(n) for n, h in prints.items())).groupBy(*keys)
    per = per.agg(F.count(F.lit(1)).alias("_n"), *(f(h).alias(f"{h}_{f.__name__}") for h in prints for f in (F.min, F.max)))
    several = (F.col("_h0_min") != F.col("_h0_max")) | (F.col("_h1_min") != F.col("_h1_max"))
    rows_of = lambda c: F.coalesce(F.sum(F.when(c, F.col("_n"))), F.lit(0))
    counted = per.agg(rows_of(F.lit(True)).alias("rows"), rows_of(missing).alias("rows_without_key"), F.count_if(several).alias("ambiguous_keys"))
    want = expected_rows.agg(F.coalesce(F.sum("rows_received"), F.lit(0)).alias("expected_rows")) if isinstance(expected_rows, DataFrame) else parsed.sparkSession.range(1).select(F.lit(expected_rows).cast("long").alias("expected_rows"))
    return counted.join(want).select("rows", "expected_rows", "rows_without_key", "ambiguous_keys")


#: Statuses of a run whose captures may be applied.
FINISHED = ("SUCCESS", "SUCCESS_WITH_QUARANTINE")
#: A change feed may come in parts; every other resource is a snapshot and must come whole.
MAY_BE_PARTIAL = ("policies",)


def run_guards(runs: DataFrame, batches: DataFrame, wanted: DataFrame) -> DataFrame:
    """Per run and resource that is to be applied, what forbids it: (run_id, resource, problem); no rows if nothing does.

    ``runs``: run_id, run_status, invocation_mode; ``batches``: run_id, resource and the
    columns of ``batch_checks``; ``wanted``: run_id, resource.
    """
    df = wanted.join(runs, "run_id", "left").join(batches, ["run_id", "resource"], "left")
    finished = F.coalesce(F.col("run_status").isin(*FINISHED), F.lit(False))
    whole = F.coalesce(F.col("invocation_mode") == "full", F.lit(False)) | F.col("resource").isin(*MAY_BE_PARTIAL)
    problems = {
        "RUN_NOT_FINISHED": ~finished, "PARTIAL_SNAPSHOT": ~whole, "ROWS_DIFFER": ~F.coalesce(F.col("rows") == F.col("expected_rows"), F.lit(False)),
        "ROWS_WITHOUT_KEY": F.coalesce(F.col("rows_without_key") > 0, F.lit(False)), "AMBIGUOUS_KEYS": F.coalesce(F.col("ambiguous_keys") > 0, F.lit(False)),
    }
    found = F.array_compact(F.array(*(F.when(c, F.lit(n)) for n, c in problems.items())))
    return df.select("run_id", "resource", F.explode(found).alias("problem"))
