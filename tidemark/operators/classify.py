"""What a claim is worth to the analysis: cover, currency, amount, scope."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.expr import clean_code, money
from .fx import asof_rate, has_prior_rate
from .relational import single_value

ANNULLED = "ANULADA"


def not_annulled(status: str = "status") -> Column:
    return F.upper(F.trim(F.coalesce(status, F.lit("")))) != ANNULLED


def policy_currency(history: DataFrame) -> DataFrame:
    """The one currency of all of a policy's events, deletes included; null if they disagree.  Blanks count as values."""
    return history.groupBy("policy_id").agg(single_value(F.upper(F.trim("currency"))).alias("policy_currency"))


def cover_match(claims: DataFrame, periods: DataFrame) -> DataFrame:
    """claim_id and the number of distinct cover periods around the day of the claim (at least one)."""
    inside = (F.col("occurred_on") >= F.col("cover_start")) & (F.col("occurred_on") <= F.col("cover_end"))
    periods = periods.select("policy_id", "cover_start", "cover_end").distinct()
    return claims.select("claim_id", "policy_id", "occurred_on").join(periods, "policy_id").where(inside).groupBy("claim_id").agg(F.count(F.lit(1)).alias("periods"))


def policy_facts(history: DataFrame) -> DataFrame:
    """Per policy its set of cover periods (few; those of deletes don't count) and its one currency, by one aggregate of the history."""
    period = F.when(F.col("op") != "D", F.struct("cover_start", "cover_end"))
    return history.groupBy("policy_id").agg(F.collect_set(period).alias("_periods"), single_value(F.upper(F.trim("currency"))).alias("_policy_currency"))


def _cover_state() -> Column:
    n = F.size(F.filter("_periods", lambda p: (F.col("occurred_on") >= p["cover_start"]) & (F.col("occurred_on") <= p["cover_end"])))
    return F.when(F.col("_periods").isNull(), "POLIZA_AUSENTE").when(n == 0, "FUERA_PERIODO").when(n == 1, "COINCIDE").otherwise("COBERTURA_AMBIGUA")


def _analysis_currency() -> tuple[Column, Column]:
    # An inferred blank stays a value, as in the policy's own events.
    stated, inferred = clean_code("currency"), F.col("_policy_currency")
    return F.coalesce(stated, inferred), F.when(stated.isNotNull(), "FUENTE").when(inferred.isNotNull(), "INFERIDA_POLIZA").otherwise("NO_DISPONIBLE")


def coverage_state(claims: DataFrame, history: DataFrame) -> DataFrame:
    """Adds cover_state.  Claims join one row per policy, so nothing fans out."""
    return claims.join(policy_facts(history).drop("_policy_currency"), "policy_id", "left").withColumn("cover_state", _cover_state()).drop("_periods")


def analysis_currency(claims: DataFrame, history: DataFrame) -> DataFrame:
    """Adds claim_currency and currency_origin: stated, inferred from the policy, or not available."""
    currency, origin = _analysis_currency()
    joined = claims.join(policy_facts(history).drop("_periods"), "policy_id", "left")
    return joined.withColumns({"claim_currency": currency, "currency_origin": origin}).drop("_policy_currency")


def amount_state(claims: DataFrame, fx: DataFrame) -> DataFrame:
    """Adds amount_state (the first that holds) and excluded (never null) to claims with a claim_currency."""
    df = has_prior_rate(claims, fx, "occurred_on", "claim_currency")
    state = (
        F.when(F.col("amount").isNull(), "MONTO_NULO")
        .when((F.col("amount") < 0) & F.col("currency").isNull(), "MONTO_NEGATIVO_Y_MONEDA_NULA")
        .when(F.col("amount") < 0, "MONTO_NEGATIVO")
        .when(F.col("claim_currency").isNull(), "MONEDA_NO_RECUPERABLE")
        .when(~F.col("has_rate"), "SIN_COTIZACION")
        .when(F.col("currency_origin") == "INFERIDA_POLIZA", "VALIDO_MONEDA_INFERIDA")
        .otherwise("VALIDO")
    )
    out = F.coalesce(F.col("amount") < 0, F.lit(True)) | F.col("claim_currency").isNull() | ~F.col("has_rate")
    return df.withColumn("amount_state", state).withColumn("excluded", out).drop("has_rate")


def classify(claims: DataFrame, history: DataFrame, fx: DataFrame) -> DataFrame:
    """All derived flags of the claims; rerun for all claims when policies change."""
    currency, origin = _analysis_currency()
    joined = claims.join(policy_facts(history), "policy_id", "left")
    flagged = joined.withColumns({"cover_state": _cover_state(), "claim_currency": currency, "currency_origin": origin}).drop("_periods", "_policy_currency")
    return amount_state(flagged, fx)


def claim_scope(claims: DataFrame, active: DataFrame, cutoff: str) -> DataFrame:
    """Adds scope: the first reason why a claim is out, or INCLUIDO."""
    policies = active.select("policy_id", F.col("status").alias("_status"), F.col("issued_on").alias("_issued"), F.lit(True).alias("_there"))
    end = F.lit(cutoff).cast("date")
    scope = (
        F.when(F.col("_there").isNull(), "POLIZA_D_O_AUSENTE").when(~not_annulled("_status"), "POLIZA_ANULADA").when(F.col("_issued") > end, "EMISION_FUTURA")
        .when(F.col("occurred_on") > end, "OCURRENCIA_FUTURA").otherwise("INCLUIDO")
    )
    return claims.join(policies, "policy_id", "left").withColumn("scope", scope).drop("_status", "_issued", "_there")


def eligible(policies: DataFrame, cutoff: str, first: str | None = None, last: str | None = None) -> DataFrame:
    """Current policies that aren't annulled, issued in the range and by the cutoff."""
    df = policies.where(not_annulled() & (F.col("issued_on") <= F.lit(cutoff).cast("date")))
    if first:
        df = df.where(F.col("issued_on") >= F.lit(first).cast("date"))
    return df.where(F.col("issued_on") <= F.lit(last).cast("date")) if last else df


def premium_usd(policies: DataFrame, fx: DataFrame, guard_negative: bool = True) -> DataFrame:
    """Adds premium_usd at the rate of the day of issue; a negative premium has none if guarded."""
    df = policies.withColumn("_code", F.upper(F.trim("currency")))
    df = asof_rate(df, fx, "issued_on", "_code").drop("_code")
    usd = money("premium", "rate")
    return df.withColumn("premium_usd", F.when(F.col("premium") >= 0, usd) if guard_negative else usd).drop("rate")


def cost_usd(claims: DataFrame, fx: DataFrame) -> DataFrame:
    """Adds cost_usd at the rate of the day of occurrence; null for excluded claims."""
    df = asof_rate(claims, fx, "occurred_on", "claim_currency")
    return df.withColumn("cost_usd", F.when(~F.col("excluded"), money("amount", "rate"))).drop("rate")
