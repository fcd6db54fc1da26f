"""Profiles, audits and diagnostics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .classify import analysis_currency, cover_match, coverage_state, policy_currency
from .fx import asof_rate
from .ranges import overlap_counts
from .relational import latest_by, latest_periods, missing_refs, opposite_amounts, with_previous
from ..functions.expr import json_scalar, money
from ..functions.leaves import json_leaves
from ..functions.variants import kind_of, members, scalar_class, shape_of
from ..sources.batches import work_dir


def _metric(name: str, value: Column) -> Column:
    return F.struct(F.lit(name).alias("metric"), value.cast("long").alias("rows"))


def _unpivot(facts: DataFrame, *names: str) -> DataFrame:
    return facts.select(F.explode(F.array(*(_metric(n, F.col(n)) for n in names))).alias("m")).select("m.*")


def policy_op_sets(history: DataFrame) -> DataFrame:
    """How many policies have which set of operations."""
    per = history.groupBy("policy_id").agg(F.array_join(F.array_sort(F.collect_set("op")), "+").alias("ops"))
    return per.groupBy("ops").agg(F.count(F.lit(1)).alias("policies"))


def profile_policies(history: DataFrame, products: DataFrame, agencies: DataFrame) -> DataFrame:
    """Counts by operation and status of the latest events, and rows whose dimensions are missing."""
    latest = latest_by(history, ["policy_id"], "updated_on")
    by_op = history.groupBy(F.concat(F.lit("op "), "op").alias("metric")).agg(F.count(F.lit(1)).alias("rows"))
    by_status = latest.groupBy(F.concat(F.lit("latest "), "op", F.lit(" "), "status").alias("metric")).agg(F.count(F.lit(1)).alias("rows"))
    by_currency = latest.groupBy(F.concat(F.lit("currency "), "currency").alias("metric")).agg(F.count(F.lit(1)).alias("rows"))
    refs = [missing_refs(history, d, k).select(F.lit(f"missing {k}").alias("metric"), F.col("missing_rows").alias("rows")) for d, k in ((products, "product_id"), (agencies, "agency_id"))]
    return by_op.unionByName(by_status).unionByName(by_currency).unionByName(refs[0]).unionByName(refs[1])


def profile_claims(claims: DataFrame, content: list[str]) -> DataFrame:
    """Ids that repeat, with the same content or another, and amounts by sign."""
    per = claims.groupBy("claim_id").agg(F.count(F.lit(1)).alias("n"), F.countDistinct(F.struct(*content)).alias("v"))
    ids = per.agg(
        F.count(F.lit(1)).alias("ids"), F.count_if(F.col("n") > 1).alias("repeated_ids"), F.count_if(F.col("v") > 1).alias("conflicting_ids"), F.coalesce(F.sum(F.col("n") - F.col("v")), F.lit(0)).alias("exact_duplicate_rows")
    )
    sign = claims.agg(F.count_if(F.col("amount").isNull()).alias("amount_null"), F.count_if(F.col("amount") < 0).alias("amount_negative"), F.count_if(F.col("amount") == 0).alias("amount_zero"), F.count_if(F.col("amount") > 0).alias("amount_positive"))
    return _unpivot(ids.join(sign), "ids", "repeated_ids", "conflicting_ids", "exact_duplicate_rows", "amount_null", "amount_negative", "amount_zero", "amount_positive")


def profile_raw_claims(raw: DataFrame) -> DataFrame:
    """(metric, what, rows) over claims as they came (``payload``): how amounts can be read, kinds of amounts and currencies,
    fields of the detail with their kinds, and nested shapes.  The text is parsed once."""
    v = raw.select(F.try_parse_json("payload").alias("v"))
    at = lambda path: F.try_variant_get("v", path, "variant")
    v = v.select(at("$.amount.value").alias("amount"), at("$.amount.currency").alias("currency"), at("$.detail").alias("detail"))
    is_object = F.startswith(F.schema_of_variant("detail"), F.lit("OBJECT"))
    fields = F.array_join(F.array_sort(F.json_object_keys(F.to_json("detail"))), "|")
    currency = F.concat_ws(":", F.coalesce(kind_of(F.col("currency")), F.lit("absent")), F.when(kind_of(F.col("currency")) == "string", F.try_variant_get("currency", "$", "string")))
    metrics = {
        "amount_class": scalar_class(F.col("amount")), "amount_kind": F.coalesce(kind_of(F.col("amount")), F.lit("absent")), "currency": currency,
        "detail_fields": F.when(is_object, fields).otherwise(F.coalesce(kind_of(F.col("detail")), F.lit("absent"))), "detail_shape": F.coalesce(shape_of(F.col("detail")), F.lit("absent")),
    }
    rows = v.select(F.explode(F.array(*(F.struct(F.lit(n).alias("metric"), c.alias("what")) for n, c in metrics.items()))).alias("m")).select("m.*")
    inner = members(v.where(is_object).select(F.to_json("detail").alias("detail")), "detail", []).select(F.lit("detail_kind").alias("metric"), F.concat_ws(":", "field", kind_of(F.col("value"))).alias("what"))
    return rows.unionByName(inner).groupBy("metric", "what").agg(F.count(F.lit(1)).alias("rows"))


def period_diagnostics(history: DataFrame, claims: DataFrame) -> DataFrame:
    """How cover periods change over a policy's events, overlap, and match claims."""
    seen = with_previous(history, ["policy_id"], ["updated_on", "op"], ["cover_start", "cover_end", "premium"])
    update, before = F.col("op") == "U", F.col("previous")
    same = F.struct("cover_start", "cover_end").eqNullSafe(F.struct(before["cover_start"], before["cover_end"]))
    facts = seen.agg(
        F.count_if(update & before.isNotNull() & same).alias("updates_same_period"), F.count_if(update & before.isNotNull() & ~same).alias("updates_changed_period"),
        F.count_if(update & before.isNotNull() & ~F.col("premium").eqNullSafe(before["premium"])).alias("updates_changed_premium"), F.count_if(update & before.isNull()).alias("updates_without_predecessor"),
        F.count_if(F.col("cover_end") < F.col("cover_start")).alias("invalid_periods"),
    )
    periods = latest_periods(history)
    many = periods.groupBy("policy_id").agg(F.count(F.lit(1)).alias("n")).agg(F.count_if(F.col("n") > 1).alias("policies_of_several_periods"))
    overlaps = overlap_counts(periods).agg(F.coalesce(F.sum("overlapping_pairs"), F.lit(0)).alias("overlapping_pairs"))
    hits = claims.select("claim_id").join(cover_match(claims, periods), "claim_id", "left").agg(
        F.count_if(F.col("periods").isNull()).alias("claims_in_no_period"), F.count_if(F.col("periods") == 1).alias("claims_in_one_period"), F.count_if(F.col("periods") > 1).alias("claims_in_several_periods")
    )
    names = ["updates_same_period", "updates_changed_period", "updates_changed_premium", "updates_without_predecessor", "invalid_periods", "policies_of_several_periods", "overlapping_pairs", "claims_in_no_period", "claims_in_one_period", "claims_in_several_periods"]
    return _unpivot(facts.join(many).join(overlaps).join(hits), *names)


def currency_recovery(claims: DataFrame, history: DataFrame, fx: DataFrame) -> DataFrame:
    """Claims without a currency: recoverable from the policy or not, and what the recoverable are worth."""
    df = analysis_currency(claims, history).where("currency IS NULL")
    df = asof_rate(df, fx, "occurred_on", "claim_currency")
    inferred, usd = F.col("currency_origin") == "INFERIDA_POLIZA", money("amount", "rate")
    return df.agg(
        F.count(F.lit(1)).alias("without_currency"), F.count_if(inferred).alias("recoverable"), F.count_if(~inferred).alias("unrecoverable"),
        F.count_if(inferred & usd.isNotNull()).alias("priced"), F.coalesce(F.sum(F.when(inferred, usd)), F.lit(0)).cast("double").alias("inferable_usd"),
    )


def diagnose_claims(claims: DataFrame, history: DataFrame) -> DataFrame:
    """By cover state and status: claims, negative ones, without currency, other currency than the policy's, days outside cover."""
    df = coverage_state(claims, history)
    latest = latest_by(history, ["policy_id"], "updated_on").select("policy_id", "cover_start", "cover_end", F.col("currency").alias("_ccy"))
    df = df.join(latest, "policy_id", "left")
    outside = F.when(F.col("occurred_on") < F.col("cover_start"), F.datediff("cover_start", "occurred_on")).when(F.col("occurred_on") > F.col("cover_end"), F.datediff("occurred_on", "cover_end"))
    return df.groupBy("cover_state", "status").agg(
        F.count(F.lit(1)).alias("claims"), F.count_if(F.col("amount") < 0).alias("negative"), F.count_if(F.col("currency").isNull()).alias("without_currency"),
        F.count_if(F.col("currency") != F.col("_ccy")).alias("other_currency"), F.min(outside).alias("least_days_outside"), F.max(outside).alias("most_days_outside"),
    )


def claim_anomalies(claims: DataFrame, history: DataFrame) -> DataFrame:
    """(metric, what, rows): negative amounts by currency, missing currencies by status, whether a claim's currency is its
    policy's, and paid claims that are special: negative, without currency, outside cover or without a policy."""
    df = analysis_currency(coverage_state(claims, history), history)
    df = df.join(policy_currency(history), "policy_id", "left")
    agreement = F.when(F.col("currency").isNull(), "missing").when(F.col("policy_currency").isNull(), "policy unknown").when(F.upper(F.trim("currency")) == F.col("policy_currency"), "same").otherwise("other")
    paid = F.col("status") == "PAGADO"
    specials = {"negative": F.col("amount") < 0, "zero": F.col("amount") == 0, "without amount": F.col("amount").isNull(), "without currency": F.col("currency").isNull(), "outside cover": F.col("cover_state") == "FUERA_PERIODO", "without policy": F.col("cover_state") == "POLIZA_AUSENTE"}
    metric = lambda name, what, on: F.when(on, F.struct(F.lit(name).alias("metric"), F.coalesce(what, F.lit("(none)")).alias("what")))
    every = [
        metric("negative by currency", F.col("currency"), F.col("amount") < 0), metric("no currency by status", F.col("status"), F.col("currency").isNull()), metric("currency agreement", agreement, F.lit(True)),
        *(metric("paid special", F.lit(n), paid & c) for n, c in specials.items()),
    ]
    return df.select(F.explode(F.array_compact(F.array(*every))).alias("m")).groupBy("m.metric", "m.what").agg(F.count(F.lit(1)).alias("rows"))


# ---- JSON records


def leaf_screen(leaves: DataFrame, path_pattern: str, value_pattern: str, keep: list[str]) -> DataFrame:
    """Leaves whose path and value match."""
    return leaves.where(F.col("path").rlike(path_pattern) & F.col("value").rlike(value_pattern)).select(*keep, "path", "value")


def screened_leaves(df: DataFrame, payload: str, path_pattern: str, value_pattern: str, keep: list[str]) -> DataFrame:
    """The leaves of JSON texts whose path and value match; where they are found, those that can't match are left out."""
    return leaf_screen(json_leaves(df, payload, keep, (path_pattern, value_pattern)), path_pattern, value_pattern, keep)


def field_quality(df: DataFrame, payload: str, fields: list[str]) -> DataFrame:
    """Per field: present, absent, explicit null, nested and marked non-finite records."""
    obj = F.from_json(payload, "map<string,string>")
    df = df.select(obj.alias("_m")).where("_m IS NOT NULL")
    out = []
    for f in fields:
        v, has = F.col("_m").getItem(f), F.array_contains(F.map_keys("_m"), f)
        marked, nested = F.coalesce(v.contains("__non_finite_number__"), F.lit(False)), F.coalesce(v.rlike(r"^\s*[{\[]"), F.lit(False))
        kind = F.when(~has, "absent").when(v.isNull(), "null").when(marked, "non_finite").when(nested, "nested").otherwise("present")
        out.append(F.struct(F.lit(f).alias("field"), kind.alias("kind")))
    return df.select(F.explode(F.array(*out)).alias("x")).groupBy("x.field", "x.kind").agg(F.count(F.lit(1)).alias("records"))


def consumption_audit(jobs: DataFrame, first: str, last: str, label: tuple[str, str], limit: int) -> DataFrame:
    """A query log in a time window with a label: jobs, bytes, and whether a limit holds.

    ``jobs``: job_id, started_at, labels (array of key, value), bytes, cached.
    """
    wanted = F.exists("labels", lambda x: (x["key"] == label[0]) & (x["value"] == label[1]))
    df = jobs.where(wanted & (F.col("started_at") >= F.lit(first).cast("timestamp")) & (F.col("started_at") < F.lit(last).cast("timestamp")))
    total = F.coalesce(F.sum("bytes"), F.lit(0))
    status = F.when(F.count(F.lit(1)) == 0, "NO_JOBS").when(F.count_if("cached") > 0, "CACHED").when(total > limit, "OVER_LIMIT").otherwise("WITHIN_LIMIT")
    return df.agg(F.count(F.lit(1)).alias("jobs"), total.alias("bytes"), F.max("bytes").alias("largest"), status.alias("audit_status"))


def silver_status(runs: DataFrame, first: str) -> DataFrame:
    """Run log with fields of its JSON summary."""
    field = lambda n: F.get_json_object("summary", f"$.{n}").cast("long").alias(n)
    return runs.where(F.to_date("started_at") >= F.lit(first).cast("date")).select("run_id", "run_status", field("history_rows"), field("active_rows"), field("claim_rows"))


#: Names of fields that hold a currency.
CURRENCY_NAME = r"(?i)(currency|moneda)"


def audit_raw_claims(raw: DataFrame) -> DataFrame:
    """Claims as they came (``payload``): repeated and conflicting ids, negatives and their opposites, how a currency is missing, currencies elsewhere."""
    scalar = lambda path: json_scalar("payload", path, F.col("_parsed"))
    # A currency elsewhere needs a key with one of the names besides amount.currency, or an escaped one: only such payloads are walked.
    mentions, own = F.regexp_count("payload", F.lit(CURRENCY_NAME)), (F.col("currency").isNotNull()).cast("int")
    df = raw.select("payload", F.try_parse_json("payload").alias("_parsed")).select(
        "payload", F.sha2("payload", 256).alias("hash"), scalar("$.claim_id").alias("claim_id"), scalar("$.policy_id").alias("policy_id"), scalar("$.amount.value").try_cast("decimal(19,9)").alias("amount"),
        scalar("$.amount.currency").alias("currency"), (F.get_json_object("payload", "$.amount.currency").isNotNull()).alias("any_currency"),
    )
    walked = F.col("payload").contains("\\") | (mentions > own)
    df, path = df.withColumn("payload", F.when(walked, F.col("payload"))), work_dir(raw.sparkSession, "raw-claims")
    df.write.parquet(path)  # parsed once; what follows reads the columns it needs
    df = raw.sparkSession.read.schema(df.schema).parquet(path)
    per = df.groupBy("claim_id").agg(F.count(F.lit(1)).alias("n"), F.min("hash").alias("v0"), F.max("hash").alias("v1"))
    ids = per.agg(F.count_if(F.col("n") > 1).alias("repeated_ids"), F.count_if(F.col("v0") < F.col("v1")).alias("conflicting_ids"))
    opposite = opposite_amounts(df, ["policy_id", "currency"]).agg(F.count(F.lit(1)).alias("negative"), F.count_if(F.col("opposites") > 0).alias("negative_with_opposite"))
    missing = df.agg(
        F.count_if(~F.col("any_currency")).alias("currency_absent"), F.count_if(F.col("any_currency") & F.col("currency").isNull()).alias("currency_nested"), F.count_if(F.trim("currency") == "").alias("currency_blank")
    )
    elsewhere = screened_leaves(df.where("payload IS NOT NULL"), "payload", CURRENCY_NAME, r"^[A-Z]{3}$", ["claim_id"]).where("path <> 'amount.currency'")
    facts = ids.join(opposite).join(missing).join(elsewhere.agg(F.countDistinct("claim_id").alias("currency_elsewhere")))
    return _unpivot(facts, "repeated_ids", "conflicting_ids", "negative", "negative_with_opposite", "currency_absent", "currency_nested", "currency_blank", "currency_elsewhere")
