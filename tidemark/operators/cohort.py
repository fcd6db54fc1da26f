"""Monthly cohorts: claims per policy, policy detail, the published mart, loss ratios."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.expr import UNKNOWN, calendar_columns, ratio, with_unknowns
from .classify import claim_scope, cost_usd, eligible, premium_usd

STATES = ("PAGADO", "RECHAZADO", "EN_ANALISIS")
#: Measures of the mart, in the published order (fixed values).
MEASURES = [
    "siniestros", "siniestros_pagados", "siniestros_rechazados", "siniestros_en_analisis", "siniestros_otros_estados",
    "siniestros_pagados_con_costo_usd", "costo_pagado_usd", "siniestros_sin_poliza", "siniestros_sin_periodo",
    "siniestros_pagados_sin_periodo", "costo_pagado_sin_periodo_usd", "siniestros_poliza_anulada", "siniestros_poliza_borrada",
    "siniestros_pagados_con_periodo", "siniestros_pagados_con_periodo_con_costo_usd", "costo_pagado_con_periodo_usd",
    "siniestros_excluidos", "siniestros_pagados_excluidos", "siniestros_moneda_inferida", "siniestros_pagados_moneda_inferida",
]
COSTS = [m for m in MEASURES if m.startswith("costo_")]
CALENDAR = ["date", "year", "month", "day", "year_month", "year_quarter", "year_semester", "day_of_week"]
DIMENSIONS = ["pais", "producto", "es_premium", "canal_origen"]
LATE_DIMENSIONS = ["tipo_producto", "canal_agencia"]
MART_COLUMNS = [*CALENDAR, *DIMENSIONS, "polizas", "polizas_con_prima_usd", "prima_usd", *MEASURES, *LATE_DIMENSIONS]
MONEY = "decimal(38,9)"


def _measures() -> list[Column]:
    used, paid = ~F.col("excluded"), F.col("status") == "PAGADO"
    covered = F.coalesce(F.col("cover_state") == "COINCIDE", F.lit(False))
    priced, inferred = F.col("cost_usd").isNotNull(), F.col("currency_origin") == "INFERIDA_POLIZA"
    other = F.col("status").isNull() | ~F.col("status").isin(*STATES)
    zero = F.lit(0).cast(MONEY)
    cost = lambda on: F.sum(F.when(on, F.coalesce("cost_usd", zero)).otherwise(zero)).cast(MONEY)
    values = [
        F.count_if(used), F.count_if(used & paid), F.count_if(used & (F.col("status") == "RECHAZADO")), F.count_if(used & (F.col("status") == "EN_ANALISIS")), F.count_if(used & other),
        F.count_if(paid & priced), cost(paid), F.lit(0).cast("long"), F.count_if(used & ~covered),
        F.count_if(used & paid & ~covered), cost(paid & ~covered), F.lit(0).cast("long"), F.lit(0).cast("long"),
        F.count_if(used & paid & covered), F.count_if(paid & covered & priced), cost(paid & covered),
        F.count_if(~used), F.count_if(~used & paid), F.count_if(used & inferred), F.count_if(used & paid & inferred),
    ]
    return [v.alias(n) for n, v in zip(MEASURES, values, strict=True)]


def claims_by_policy(claims: DataFrame) -> DataFrame:
    """One row per policy with all claim measures, so a premium is never counted twice."""
    return claims.groupBy("policy_id").agg(*_measures())


def enrich_policies(policies: DataFrame, products: DataFrame, agencies: DataFrame) -> DataFrame:
    """Dimensions by left joins; unknown members get a name, an unknown es_premium stays null."""
    products = products.select("product_id", F.col("plan_name").alias("producto"), F.col("product_type").alias("tipo_producto"), F.col("is_premium").alias("es_premium"))
    agencies = agencies.select("agency_id", F.col("channel").alias("canal_agencia"))
    df = policies.join(products, "product_id", "left").join(agencies, "agency_id", "left")
    df = df.withColumns({"pais": F.col("country"), "canal_origen": F.col("channel")})
    return with_unknowns(df, "pais", "producto", "canal_origen", "tipo_producto", "canal_agencia")


def policy_values(active: DataFrame, products: DataFrame, agencies: DataFrame, fx: DataFrame, cutoff: str) -> DataFrame:
    return premium_usd(enrich_policies(eligible(active, cutoff), products, agencies), fx)


def claim_values(claims: DataFrame, active: DataFrame, fx: DataFrame, cutoff: str) -> DataFrame:
    """Claims in scope with their cost."""
    return cost_usd(claim_scope(claims, active, cutoff).where("scope = 'INCLUIDO'"), fx)


def policy_detail(policies: DataFrame, by_policy: DataFrame) -> DataFrame:
    """Every policy with its measures, zero where it has no claims."""
    joined = policies.join(by_policy, "policy_id", "left")
    return joined.withColumns({m: F.coalesce(m, F.lit(0).cast(MONEY if m in COSTS else "long")) for m in MEASURES})


def cohort_mart(detail: DataFrame, date: str = "issued_on") -> DataFrame:
    """Month of issue by country, product, premium flag and channels: the 37 published columns, no ids."""
    df = detail.select(*(c.alias(n) for n, c in calendar_columns(date).items()), *DIMENSIONS, *LATE_DIMENSIONS, "premium_usd", *MEASURES)
    sums = [F.sum(m).cast(MONEY if m in COSTS else "long").alias(m) for m in MEASURES]
    return df.groupBy(*CALENDAR, *DIMENSIONS, *LATE_DIMENSIONS).agg(
        F.count(F.lit(1)).alias("polizas"), F.count("premium_usd").alias("polizas_con_prima_usd"), F.coalesce(F.sum("premium_usd"), F.lit(0)).cast(MONEY).alias("prima_usd"), *sums
    ).select(*MART_COLUMNS)


def _loss_ratio(active: DataFrame, claims: DataFrame, fx: DataFrame, dim: DataFrame, key: str, name: str, out: str, first: str, last: str, cutoff: str) -> DataFrame:
    policies = premium_usd(eligible(active, cutoff, first, last), fx, guard_negative=False)
    used = claims.where(~F.col("excluded") & (F.col("occurred_on") <= F.lit(cutoff).cast("date"))).join(policies.select("policy_id"), "policy_id", "left_semi")
    paid = F.col("status") == "PAGADO"
    per_policy = cost_usd(used, fx).groupBy("policy_id").agg(
        F.countDistinct("claim_id").alias("claims"), F.countDistinct(F.when(paid, F.col("claim_id"))).alias("paid_claims"),
        F.sum(F.when(paid, F.col("cost_usd")).otherwise(F.lit(0).cast(MONEY))).alias("paid_usd"),
    )
    df = policies.join(per_policy, "policy_id", "left").join(dim.select(key, F.col(name).alias("_name")), key, "left")
    df = df.groupBy(F.trunc("issued_on", "MM").alias("cohort_month"), F.coalesce("country", F.lit(UNKNOWN)).alias("country"), F.coalesce("_name", F.lit(UNKNOWN)).alias(out)).agg(
        F.countDistinct("policy_id").alias("policies"), F.sum(F.coalesce("claims", F.lit(0))).alias("claims"), F.sum(F.coalesce("paid_claims", F.lit(0))).alias("paid_claims"),
        F.sum("premium_usd").alias("premium_usd"), F.sum(F.coalesce("paid_usd", F.lit(0).cast(MONEY))).alias("paid_usd"),
    )
    return df.withColumns(
        {"loss_ratio": ratio(F.col("paid_usd"), F.col("premium_usd")), "paid_frequency": ratio(F.col("paid_claims"), F.col("policies")), "severity_usd": ratio(F.col("paid_usd"), F.col("paid_claims"))}
    )


def loss_ratio_country_plan(active, claims, fx, products, first: str, last: str, cutoff: str) -> DataFrame:
    """Loss ratio by month of issue, country and plan."""
    return _loss_ratio(active, claims, fx, products, "product_id", "plan_name", "plan", first, last, cutoff)


def loss_ratio_country_channel(active, claims, fx, agencies, first: str, last: str, cutoff: str) -> DataFrame:
    """Loss ratio by month of issue, country and the agency's channel."""
    return _loss_ratio(active, claims, fx, agencies, "agency_id", "channel", "agency_channel", first, last, cutoff)


def validation_summary(mart: DataFrame, scoped: DataFrame) -> DataFrame:
    """One row: totals of the mart, and how the source's claims fall into scopes."""
    totals = mart.agg(
        F.count(F.lit(1)).alias("mart_rows"), *(F.coalesce(F.sum(m), F.lit(0)).alias(m) for m in ("polizas", "polizas_con_prima_usd", "prima_usd", *MEASURES)), F.min("date").alias("first_month"), F.max("date").alias("last_month")
    ).withColumns({"policies_without_usd": F.col("polizas") - F.col("polizas_con_prima_usd"), "paid_without_usd": F.col("siniestros_pagados") - F.col("siniestros_pagados_con_costo_usd")})
    scopes = ("INCLUIDO", "POLIZA_D_O_AUSENTE", "POLIZA_ANULADA", "EMISION_FUTURA", "OCURRENCIA_FUTURA")
    source = scoped.agg(F.count(F.lit(1)).alias("source_claims"), *(F.count_if(F.col("scope") == s).alias(f"scope_{s.lower()}") for s in scopes))
    return totals.join(source)
