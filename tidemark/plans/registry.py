"""Queries of the portfolio operators, each with its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import expr
from ..operators import checks, classify, cohort, fx, merge, metrics, parse, profile, ranges, relational
from ..sources.batches import work_dir
from .adapters import CTE, CUTOFF, FIRST, FLAGS_CTE, FULL_CTE, LAST, MART_CTE, RATES_CTE, Portfolio

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None, cte: str | None = CTE):
    """Register a function of a Portfolio under its name, with the SQL of its rows."""

    def register(f):
        QUERIES[f.__name__] = lambda spark, sf_dir: f(Portfolio(spark, sf_dir))
        if sql:
            SQL[f.__name__] = (f"WITH {cte.strip()}\n" if cte else "") + sql.strip()
        return f

    return register


def money_as_double(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("double") for c, t in df.dtypes if t.startswith("decimal")})


def stored(p: Portfolio, label: str, df: DataFrame) -> DataFrame:
    """The rows as read back from a table in the shared folder."""
    path = work_dir(p.spark, label)
    df.write.parquet(path)
    return p.spark.read.schema(df.schema).parquet(path)


def flagged(p: Portfolio) -> DataFrame:
    return classify.classify(p.claims, p.history, p.fx)


def detail_of(p: Portfolio) -> DataFrame:
    policies = cohort.policy_values(p.active, p.products, p.agencies, p.fx, CUTOFF)
    return cohort.policy_detail(policies, cohort.claims_by_policy(cohort.claim_values(flagged(p), p.active, p.fx, CUTOFF)))


def mart_of(p: Portfolio) -> DataFrame:
    return cohort.cohort_mart(detail_of(p))


# ---- loss ratios

_LOSS = """,
pol AS (SELECT a.*, CAST(a.premium * CAST(CASE WHEN UPPER(TRIM(a.currency)) = 'USD' THEN 1 ELSE r.factor_usd END AS DECIMAL(18,9)) AS DECIMAL(38,9)) AS premium_usd
  FROM active a LEFT JOIN rates r ON r.currency = UPPER(TRIM(a.currency)) AND a.issued_on >= r.rate_date AND a.issued_on < r.next_date
  WHERE a.issued_on BETWEEN DATE '{first}' AND DATE '{last}' AND a.issued_on <= DATE '{cutoff}' AND UPPER(TRIM(COALESCE(a.status, ''))) <> 'ANULADA'),
cl AS (SELECT f.policy_id, COUNT(DISTINCT claim_id) AS claims, COUNT(DISTINCT CASE WHEN f.status = 'PAGADO' THEN claim_id END) AS paid_claims,
  SUM(CASE WHEN f.status = 'PAGADO' THEN CAST(f.amount * CAST(CASE WHEN f.claim_currency = 'USD' THEN 1 ELSE r.factor_usd END AS DECIMAL(18,9)) AS DECIMAL(38,9)) ELSE 0 END) AS paid_usd
  FROM flagged f JOIN pol ON pol.policy_id = f.policy_id LEFT JOIN rates r ON r.currency = f.claim_currency AND f.occurred_on >= r.rate_date AND f.occurred_on < r.next_date
  WHERE f.occurred_on <= DATE '{cutoff}' AND NOT f.excluded GROUP BY 1),
g AS (SELECT CAST(DATE_TRUNC('month', issued_on) AS DATE) AS cohort_month, COALESCE(pol.country, 'DESCONOCIDO') AS country, COALESCE(d.{name}, 'DESCONOCIDO') AS {out}, COUNT(DISTINCT pol.policy_id) AS policies,
  CAST(SUM(COALESCE(claims, 0)) AS BIGINT) AS claims, CAST(SUM(COALESCE(paid_claims, 0)) AS BIGINT) AS paid_claims, CAST(SUM(premium_usd) AS DOUBLE) AS premium_usd, CAST(SUM(COALESCE(paid_usd, 0)) AS DOUBLE) AS paid_usd
  FROM pol LEFT JOIN cl ON cl.policy_id = pol.policy_id LEFT JOIN {dim} d ON d.{key} = pol.{key} GROUP BY 1, 2, 3)
SELECT *, paid_usd / NULLIF(premium_usd, 0) AS loss_ratio, CAST(paid_claims AS DOUBLE) / policies AS paid_frequency, paid_usd / NULLIF(paid_claims, 0) AS severity_usd FROM g"""
_RANGE = {"first": FIRST, "last": LAST, "cutoff": CUTOFF}


@query(_LOSS.format(**_RANGE, name="plan_name", out="plan", dim="products", key="product_id"), FLAGS_CTE)
def loss_ratio_country_plan(p):
    return money_as_double(cohort.loss_ratio_country_plan(p.active, flagged(p), p.fx, p.products, FIRST, LAST, CUTOFF))


@query(_LOSS.format(**_RANGE, name="channel", out="agency_channel", dim="agencies", key="agency_id"), FLAGS_CTE)
def loss_ratio_country_channel(p):
    return money_as_double(cohort.loss_ratio_country_channel(p.active, flagged(p), p.fx, p.agencies, FIRST, LAST, CUTOFF))


# ---- change capture

_STATE = "policy_id, CAST(premium AS DOUBLE) AS premium, status, updated_on"


@query(f"SELECT {_STATE} FROM active")
def policy_current_state(p):
    return money_as_double(p.active.select("policy_id", "premium", "status", "updated_on"))


@query(f"SELECT {_STATE} FROM active")
def policy_current_merge(p):
    """The state reached in two batches, the later half of the events first."""
    first, second = p.history.where("op <> 'I' OR policy_id % 2 = 0"), p.history.where("op = 'I' AND policy_id % 2 = 1")
    none = p.history.limit(0)
    state = merge.live(merge.merge_current(none.drop("op").withColumn("op", F.lit("I")).select(*none.columns), first, first))
    history = first.unionByName(merge.merge_history(first, second))
    return money_as_double(merge.live(merge.merge_current(state, history, second)).select("policy_id", "premium", "status", "updated_on"))


@query("SELECT policy_id, updated_on, op FROM history")
def policy_history_dedup(p):
    """Half of the events arrive again and add nothing."""
    again = p.history.where("policy_id % 2 = 0")
    return p.history.unionByName(merge.merge_history(p.history, again.unionByName(again))).select("policy_id", "updated_on", "op")


#: The history with renewals: a sixth of the policies gets a second, overlapping period.
_RENEWED = """(SELECT policy_id, cover_start, cover_end, premium, op, updated_on FROM history UNION ALL
  SELECT policy_id, CAST(cover_start + INTERVAL '20' DAY AS DATE), CAST(cover_end + INTERVAL '20' DAY AS DATE), premium, 'U', CAST(updated_on + INTERVAL '5' DAY AS DATE) FROM history WHERE op = 'I' AND policy_id % 6 = 1)"""


def renewed(p) -> DataFrame:
    second = p.history.where("op = 'I' AND policy_id % 6 = 1")
    second = second.withColumns({"cover_start": F.date_add("cover_start", 20), "cover_end": F.date_add("cover_end", 20), "op": F.lit("U"), "updated_on": F.date_add("updated_on", 5)})
    return p.history.unionByName(second)


@query(f"SELECT policy_id, cover_start, cover_end, op FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY policy_id, cover_start, cover_end ORDER BY updated_on DESC) AS rn FROM {_RENEWED} r WHERE op <> 'D') x WHERE rn = 1")
def policy_latest_periods(p):
    return relational.latest_periods(renewed(p)).select("policy_id", "cover_start", "cover_end", "op")


@query("""SELECT policy_id, updated_on, op, lag(op) OVER (PARTITION BY policy_id ORDER BY updated_on, op) AS previous_op FROM history""")
def policy_previous_version(p):
    return relational.with_previous(p.history, ["policy_id"], ["updated_on", "op"], ["op"]).select("policy_id", "updated_on", "op", F.col("previous.op").alias("previous_op"))


#: A policy in seven has its events again with another status: a tie of different content; one in five has them again as they are.
_TIED = """(SELECT policy_id, op, status, updated_on FROM history UNION ALL SELECT policy_id, op, status, updated_on FROM history WHERE policy_id % 5 = 0
  UNION ALL SELECT policy_id, op, status || '?', updated_on FROM history WHERE policy_id % 7 = 0)"""
_TIES = f"(SELECT policy_id, MAX(op) AS op, COUNT(DISTINCT (op, status)) > 1 AS tied FROM (SELECT *, MAX(updated_on) OVER (PARTITION BY policy_id) AS last FROM {_TIED} t) x WHERE updated_on = last GROUP BY 1)"


def _latest_tied(p) -> DataFrame:
    again = p.history.where("policy_id % 5 = 0").unionByName(p.history.where("policy_id % 7 = 0").withColumn("status", F.concat("status", F.lit("?"))))
    df = p.history.unionByName(again).withColumn("content", expr.row_hash("status", "op"))
    return relational.latest_with_ties(df, ["policy_id"], "updated_on", "content")


@query(f"SELECT * FROM {_TIES} y")
def policy_latest_with_ties(p):
    return _latest_tied(p).select("policy_id", "op", "tied")


@query(f"SELECT COUNT(*) FILTER (NOT tied) AS clear, COUNT(*) FILTER (tied) AS ambiguous FROM {_TIES} y")
def policy_tie_counts(p):
    return relational.tie_counts(_latest_tied(p))


@query("SELECT o_custkey AS policy_id, CAST(NULL AS DATE) AS seen_on, COUNT(*) > 0 AS known FROM orders WHERE o_custkey % 3 = 0 GROUP BY 1 UNION ALL SELECT o_custkey, CAST(MAX(o_orderdate) AS DATE), TRUE FROM orders WHERE o_custkey % 3 <> 0 GROUP BY 1", None)
def latest_with_null_order(p):
    """Rows whose order is null throughout keep their columns; nulls come before any date."""
    dates = F.when(F.col("o_custkey") % 3 != 0, F.to_date("o_orderdate")).alias("seen_on")
    df = p.table("orders").select(F.col("o_custkey").alias("policy_id"), dates, F.lit(True).alias("known"))
    return relational.latest_by(df.unionByName(df.withColumn("seen_on", F.lit(None).cast("date"))), ["policy_id"], "seen_on")


@query("SELECT policy_id, updated_on FROM history h WHERE policy_id IN (SELECT policy_id FROM history WHERE op = 'D')")
def affected_history(p):
    return relational.affected(p.history, p.history.where("op = 'D'"), "policy_id").select("policy_id", "updated_on")


_SNAP_OLD = "(SELECT c_custkey AS k, c_name, c_acctbal FROM customer WHERE c_custkey % 7 <> 0)"
_SNAP_NEW = "(SELECT c_custkey AS k, c_name, CASE WHEN c_custkey % 5 = 0 THEN c_acctbal + 1 ELSE c_acctbal END AS c_acctbal FROM customer WHERE c_custkey % 11 <> 0)"


def _snapshots(p) -> tuple[DataFrame, DataFrame]:
    c = p.table("customer").select(F.col("c_custkey").alias("k"), "c_name", "c_acctbal")
    new = c.withColumn("c_acctbal", F.when(F.col("k") % 5 == 0, F.col("c_acctbal") + 1).otherwise(F.col("c_acctbal")))
    return c.where("k % 7 <> 0"), new.where("k % 11 <> 0")


_ACTION = "CASE WHEN n.k IS NULL THEN '{gone}' WHEN o.k IS NULL THEN 'insert' WHEN o.c_acctbal = n.c_acctbal THEN 'keep' ELSE 'update' END AS action"


@query(f"SELECT COALESCE(n.k, o.k) AS k, COALESCE(n.c_acctbal, o.c_acctbal) AS c_acctbal, {_ACTION.format(gone='delete')} FROM {_SNAP_OLD} o FULL JOIN {_SNAP_NEW} n ON n.k = o.k", None)
def dimension_refresh(p):
    return merge.refresh_dimension(*_snapshots(p), "k").select("k", "c_acctbal", "action")


@query(f"SELECT COALESCE(n.k, o.k) AS k, COALESCE(n.c_acctbal, o.c_acctbal) AS c_acctbal, {_ACTION.format(gone='keep')} FROM {_SNAP_OLD} o FULL JOIN {_SNAP_NEW} n ON n.k = o.k", None)
def claim_upsert(p):
    return merge.upsert(*_snapshots(p), "k").select("k", "c_acctbal", "action")


@query(f"SELECT action, COUNT(*) AS rows FROM (SELECT {_ACTION.format(gone='delete')} FROM {_SNAP_OLD} o FULL JOIN {_SNAP_NEW} n ON n.k = o.k) x GROUP BY 1", None)
def mutation_counts(p):
    return merge.mutation_counts(merge.refresh_dimension(*_snapshots(p), "k"))


@query(f"SELECT k, c_acctbal, action FROM (SELECT n.k, n.c_acctbal, {_ACTION.format(gone='keep')} FROM {_SNAP_OLD} o FULL JOIN {_SNAP_NEW} n ON n.k = o.k) x WHERE action IN ('insert', 'update')", None)
def update_if_distinct(p):
    return merge.update_if_distinct(*_snapshots(p), "k").select("k", "c_acctbal", "action")


@query(f"SELECT COALESCE(n.k, o.k) AS k, CASE WHEN n.k IS NULL THEN 'ABSENT_REVIEW' WHEN o.k IS NULL THEN 'NEW' WHEN o.c_acctbal = n.c_acctbal THEN 'UNCHANGED' ELSE 'CHANGED' END AS change_type FROM {_SNAP_OLD} o FULL JOIN {_SNAP_NEW} n ON n.k = o.k", None)
def snapshot_diff(p):
    return merge.snapshot_diff(*_snapshots(p), "k").select("k", "change_type")


@query(f"SELECT o.k FROM {_SNAP_OLD} o WHERE o.k NOT IN (SELECT k FROM {_SNAP_NEW} n) AND o.k % 2 = 1", None)
def absent_claims(p):
    """Absent keys, of which the even ones are recorded already."""
    old, new = _snapshots(p)
    recorded = old.where("k % 2 = 0").select(F.lit("r1").alias("run_id"), "k")
    return merge.snapshot_absent(old, new, recorded, "k", "r1").select("k")


@query(f"SELECT COALESCE(n.k, o.k) AS k, CASE WHEN n.k IS NULL THEN 'missing' WHEN o.k IS NULL THEN 'extra' WHEN o.c_acctbal = n.c_acctbal THEN 'same' ELSE 'different' END AS state FROM {_SNAP_NEW} n FULL JOIN {_SNAP_OLD} o ON n.k = o.k".replace("n.k IS NULL THEN 'missing'", "o.k IS NULL THEN 'missing'").replace("WHEN o.k IS NULL THEN 'extra'", "WHEN n.k IS NULL THEN 'extra'"), None)
def compare_state(p):
    old, new = _snapshots(p)
    return relational.compare_state(new, old, "k")


@query(f"SELECT (SELECT COUNT(*) FROM {_SNAP_OLD} o) AS rows_a, (SELECT COUNT(*) FROM {_SNAP_NEW} n) AS rows_b, (SELECT COUNT(*) FROM (SELECT * FROM {_SNAP_OLD} o EXCEPT ALL SELECT * FROM {_SNAP_NEW} n) x) AS only_a, (SELECT COUNT(*) FROM (SELECT * FROM {_SNAP_NEW} n EXCEPT ALL SELECT * FROM {_SNAP_OLD} o) x) AS only_b", None)
def table_equality(p):
    return relational.table_diff(*_snapshots(p))


@query("SELECT policy_id, updated_on FROM history WHERE policy_id % 3 = 0")
def immutable_conflicts(p):
    changed = p.history.withColumn("premium", F.when(F.col("policy_id") % 3 == 0, F.col("premium") + 1).otherwise(F.col("premium")).cast(expr.AMOUNT))
    return merge.immutable_conflicts(p.history, changed)


@query("SELECT policy_id, CAST(COUNT(*) FILTER (op = 'I') AS BIGINT) AS inserts, CAST(0 AS BIGINT) AS bad_ops FROM history WHERE NOT (op = 'I' AND policy_id % 5 = 1) GROUP BY 1 HAVING COUNT(*) FILTER (op = 'I') <> 1")
def op_invariants(p):
    part = p.history.where("NOT (op = 'I' AND policy_id % 5 = 1)")
    return merge.op_violations(part, part.limit(0))


@query("SELECT policy_id, updated_on FROM history WHERE CAST(updated_on AS TIMESTAMP) >= TIMESTAMP '1997-03-01' - INTERVAL 86400 SECOND")
def delta_window(p):
    return merge.delta_window(p.history, "1997-03-01", 86400).select("policy_id", "updated_on")


@query("SELECT l_orderkey, l_linenumber, COUNT(DISTINCT (l_partkey, l_quantity)) AS versions FROM lineitem GROUP BY 1, 2 HAVING COUNT(DISTINCT (l_partkey, l_quantity)) > 1", None)
def ambiguous_versions(p):
    return relational.ambiguous_versions(p.table("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity"), ["l_orderkey", "l_linenumber"])


@query("SELECT DISTINCT event_type, user_id % 10 AS u FROM events", None)
def dedup_exact(p):
    return relational.dedup_exact(p.table("events").select("event_type", (F.col("user_id") % 10).alias("u")))


@query("SELECT l_orderkey, l_linenumber, COUNT(*) AS rows FROM lineitem GROUP BY 1, 2 HAVING COUNT(*) > 1", None)
def duplicate_keys(p):
    return relational.duplicate_keys(p.table("lineitem"), ["l_orderkey", "l_linenumber"])


@query("SELECT policy_id FROM history GROUP BY 1 HAVING COUNT(*) = 2 AND COUNT(*) FILTER (op = 'D') = 1")
def having_check(p):
    return relational.having(p.history, ["policy_id"], two=F.count(F.lit(1)) == 2, gone=F.count_if(F.col("op") == "D") == 1)


# ---- flags


@query("SELECT claim_id, cover_state FROM flagged0", FLAGS_CTE)
def claim_coverage_state(p):
    return classify.coverage_state(p.claims, p.history).select("claim_id", "cover_state")


@query("SELECT c.claim_id, COUNT(DISTINCT (h.cover_start, h.cover_end)) AS periods FROM claims c JOIN history h ON h.policy_id = c.policy_id AND c.occurred_on BETWEEN h.cover_start AND h.cover_end GROUP BY 1")
def claim_cover_match(p):
    return classify.cover_match(p.claims, p.history)


@query("SELECT claim_id, claim_currency, currency_origin FROM flagged0", FLAGS_CTE)
def claim_currency_inference(p):
    return classify.analysis_currency(p.claims, p.history).select("claim_id", "claim_currency", "currency_origin")


@query("SELECT claim_id, amount_state, excluded FROM flagged", FLAGS_CTE)
def claim_amount_state(p):
    return flagged(p).select("claim_id", "amount_state", "excluded")


@query("SELECT claim_id, scope FROM scoped", MART_CTE)
def claim_scope(p):
    return classify.claim_scope(p.claims, p.active, CUTOFF).select("claim_id", "scope")


@query("SELECT policy_id, ccy AS policy_currency FROM policy_ccy", FLAGS_CTE)
def policy_currency(p):
    return classify.policy_currency(p.history)


@query(f"SELECT policy_id FROM active WHERE UPPER(TRIM(COALESCE(status, ''))) <> 'ANULADA' AND issued_on BETWEEN DATE '{FIRST}' AND DATE '{LAST}'")
def eligible_policies(p):
    return classify.eligible(p.active, CUTOFF, FIRST, LAST).select("policy_id")


# ---- rates


@query("SELECT a.policy_id, CAST(CASE WHEN a.currency = 'USD' THEN 1 ELSE r.factor_usd END AS DOUBLE) AS rate FROM active a LEFT JOIN rates r ON r.currency = a.currency AND a.issued_on >= r.rate_date AND a.issued_on < r.next_date", RATES_CTE)
def fx_asof_interval(p):
    return money_as_double(fx.asof_rate(p.active, p.fx, "issued_on", "currency").select("policy_id", "rate"))


@query("SELECT a.policy_id, CAST(CASE WHEN a.currency = 'USD' THEN 1 ELSE r.factor_usd END AS DOUBLE) AS rate FROM active a LEFT JOIN rates r ON r.currency = a.currency AND a.issued_on >= r.rate_date AND a.issued_on < r.next_date", RATES_CTE)
def fx_asof_by_month(p):
    """The way for rate tables too large to broadcast."""
    return money_as_double(fx.asof_rate(p.active, p.fx, "issued_on", "currency", how="merge").select("policy_id", "rate"))


@query("SELECT r.currency, CAST(d.day AS DATE) AS day, CAST(r.factor_usd AS DOUBLE) AS factor_usd FROM (SELECT unnest(generate_series(DATE '1996-01-01', DATE '1998-12-31', INTERVAL 1 DAY)) AS day) d JOIN rates r ON d.day >= r.rate_date AND d.day < r.next_date", RATES_CTE)
def fx_daily_fill(p):
    day = lambda x: F.lit(x).cast("date")
    return money_as_double(fx.fx_daily(p.fx, day("1996-01-01"), day("1998-12-31")))


@query("SELECT currency, rate_date, next_date FROM rates", RATES_CTE)
def fx_intervals(p):
    return fx.rate_intervals(p.fx).select("currency", "rate_date", "next_date")


_GAPS = """, any_rate AS (SELECT currency, rate_date, LEAD(rate_date, 1, DATE '9999-12-31') OVER (PARTITION BY currency ORDER BY rate_date) AS nxt FROM fx)
SELECT CASE WHEN h.issued_on IS NULL THEN 'invalid_date' WHEN h.currency = 'USD' THEN 'exact' WHEN h.currency NOT IN (SELECT currency FROM fx) THEN 'invalid_currency' WHEN r.rate_date IS NULL THEN 'no_prior'
  WHEN h.issued_on - r.rate_date = 0 THEN 'exact' WHEN h.issued_on - r.rate_date <= 7 THEN '1-7' WHEN h.issued_on - r.rate_date <= 30 THEN '8-30' ELSE 'over_30' END AS gap, COUNT(*) AS rows
FROM history h LEFT JOIN any_rate r ON r.currency = h.currency AND h.issued_on >= r.rate_date AND h.issued_on < r.nxt GROUP BY 1"""


@query(_GAPS)
def fx_gap_bins(p):
    return fx.fx_gap_bins(p.history, p.fx, "issued_on", "currency")


@query("SELECT currency, COUNT(*) AS rates, COUNT(*) FILTER (factor_usd <= 0) AS non_positive, COUNT(*) FILTER (factor_usd > 0 AND abs(factor_usd * CAST(round(1 / CAST(factor_usd AS DOUBLE), 2) AS DECIMAL(18,9)) - 1) > 0.000001) AS not_reciprocal FROM fx GROUP BY 1")
def fx_reciprocity(p):
    units = F.when(F.col("factor_usd") > 0, F.round(1 / F.col("factor_usd").cast("double"), 2)).otherwise(-1).cast(expr.RATE)
    return fx.fx_reciprocity(p.fx.withColumn("units_per_usd", units))


@query("SELECT claim_id, COALESCE(currency = 'USD', FALSE) OR EXISTS (SELECT 1 FROM fx r WHERE r.currency = c.currency AND factor_usd > 0 AND rate_date <= c.occurred_on) AS has_rate FROM claims c")
def claim_prior_rate(p):
    return fx.has_prior_rate(p.claims, p.fx, "occurred_on", "currency").select("claim_id", "has_rate")


@query("SELECT policy_id, CAST(premium_usd AS DOUBLE) AS premium_usd FROM policy_values", MART_CTE)
def premium_usd(p):
    return money_as_double(classify.premium_usd(classify.eligible(p.active, CUTOFF), p.fx).select("policy_id", "premium_usd"))


@query("SELECT claim_id, CAST(cost_usd AS DOUBLE) AS cost_usd FROM claim_values", MART_CTE)
def claim_cost_usd(p):
    return money_as_double(cohort.claim_values(flagged(p), p.active, p.fx, CUTOFF).select("claim_id", "cost_usd"))


# ---- mart

_DOUBLES = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" if c in (*cohort.COSTS, "prima_usd") else f'"{c}"' for c in cohort.MART_COLUMNS)
_PER_POLICY = ", ".join(f"CAST({m} AS DOUBLE) AS {m}" if m in cohort.COSTS else m for m in cohort.MEASURES)


@query(f"SELECT policy_id, {_PER_POLICY} FROM by_policy", MART_CTE)
def claims_by_policy(p):
    return metrics.as_doubles(cohort.claims_by_policy(cohort.claim_values(flagged(p), p.active, p.fx, CUTOFF)))


@query("SELECT policy_id, pais, producto, tipo_producto, es_premium, canal_agencia, canal_origen FROM policy_values", MART_CTE)
def policy_dimensions(p):
    return cohort.enrich_policies(classify.eligible(p.active, CUTOFF), p.products, p.agencies).select("policy_id", "pais", "producto", "tipo_producto", "es_premium", "canal_agencia", "canal_origen")


@query("SELECT policy_id, siniestros, siniestros_pagados, CAST(costo_pagado_usd AS DOUBLE) AS costo_pagado_usd, siniestros_excluidos FROM detail", FULL_CTE)
def policy_detail(p):
    return metrics.as_doubles(detail_of(p).select("policy_id", "siniestros", "siniestros_pagados", "costo_pagado_usd", "siniestros_excluidos"))


@query(f"SELECT {_DOUBLES} FROM mart", FULL_CTE)
def cohort_mart(p):
    return metrics.as_doubles(mart_of(p))


@query("""SELECT (SELECT COUNT(*) FROM mart) AS mart_rows, CAST(SUM(polizas) AS BIGINT) AS polizas, CAST(SUM(siniestros) AS BIGINT) AS siniestros, CAST(SUM(prima_usd) AS DOUBLE) AS prima_usd, CAST(SUM(costo_pagado_usd) AS DOUBLE) AS costo_pagado_usd,
  CAST(SUM(polizas) - SUM(polizas_con_prima_usd) AS BIGINT) AS policies_without_usd, (SELECT COUNT(*) FROM scoped) AS source_claims, (SELECT COUNT(*) FROM scoped WHERE scope = 'INCLUIDO') AS scope_incluido,
  (SELECT COUNT(*) FROM scoped WHERE scope = 'POLIZA_ANULADA') AS scope_poliza_anulada, MIN("date") AS first_month FROM mart""", FULL_CTE)
def validation_summary(p):
    claims = flagged(p)
    s = cohort.validation_summary(mart_of(p), classify.claim_scope(claims, p.active, CUTOFF))
    return metrics.as_doubles(s.select("mart_rows", "polizas", "siniestros", "prima_usd", "costo_pagado_usd", "policies_without_usd", "source_claims", "scope_incluido", "scope_poliza_anulada", "first_month"))


_CHECKS = """SELECT unnest(['POLICY_COUNT', 'ANNULLED_EXCLUDED', 'LATEST_STATE_ELIGIBILITY', 'PREMIUM_SUM', 'CLAIM_COUNT', 'SOURCE_SCOPE_PARTITION', 'PAID_COUNT', 'PAID_COST', 'CLAIM_STATES', 'MISSING_PERIOD_COUNT', 'PREMIUM_VALID_COUNT', 'PAID_VALID_COUNT', 'GRAIN_UNIQUE', 'COVERED_PAID_COUNT', 'COVERED_PAID_COST', 'NO_EXCLUDED_COST', 'EXCLUDED_COUNT', 'PAID_PARTITION', 'POLICY_DETAIL_UNIQUE', 'CLAIMS_HAVE_POLICY', 'COHORT_MONTH', 'OCCURRENCE_CUTOFF', 'LEGACY_OUT_OF_SCOPE_ZERO', 'INFERRED_INCLUDED_COUNT']) AS check_name,
  unnest([p.n, 0, p.n, p.prem, c.used, s.n, c.paid, c.cost, c.used, c.outside, p.priced, c.priced, 0, c.covered, c.covered_cost, 0, c.excl, c.paid, 0, 0, 0, 0, 0, c.inferred]) AS expected, TRUE AS passed
FROM (SELECT CAST(COUNT(*) AS DOUBLE) AS n, CAST(SUM(premium_usd) AS DOUBLE) AS prem, COUNT(premium_usd) AS priced FROM policy_values) p, (SELECT COUNT(*) AS n FROM scoped) s,
  (SELECT COUNT(*) FILTER (NOT excluded) AS used, COUNT(*) FILTER (NOT excluded AND status = 'PAGADO') AS paid, CAST(SUM(cost_usd) FILTER (status = 'PAGADO') AS DOUBLE) AS cost, COUNT(*) FILTER (NOT excluded AND cover_state <> 'COINCIDE') AS outside,
    COUNT(*) FILTER (status = 'PAGADO' AND cost_usd IS NOT NULL) AS priced, COUNT(*) FILTER (NOT excluded AND status = 'PAGADO' AND cover_state = 'COINCIDE') AS covered, CAST(COALESCE(SUM(cost_usd) FILTER (status = 'PAGADO' AND cover_state = 'COINCIDE'), 0) AS DOUBLE) AS covered_cost,
    COUNT(*) FILTER (excluded) AS excl, COUNT(*) FILTER (NOT excluded AND currency_origin = 'INFERIDA_POLIZA') AS inferred FROM claim_values) c"""


@query(_CHECKS, FULL_CTE)
def gold_checks(p):
    """Each layer is written once and what the checks need of its rows is observed by the write."""
    _, df = checks.build_gold(p.active, flagged(p), p.products, p.agencies, p.fx, CUTOFF, work_dir(p.spark, "gold"))
    return df.select("check_name", F.col("expected").cast("double").alias("expected"), "passed")


@query("""SELECT unnest(['POLICY_COUNT', 'CLAIM_COUNT', 'PAID_COUNT', 'MISSING_PERIOD_COUNT', 'CLAIMS_HAVE_POLICY', 'POLICY_DETAIL_UNIQUE', 'LATEST_STATE_ELIGIBILITY', 'SOURCE_SCOPE_PARTITION', 'EXCLUDED_COUNT']) AS check_name,
  unnest([p.n, c.used, c.paid, c.outside, 0, 0, p.n, s.n, c.excl]) AS expected, unnest([p.n - p.gone, c.used - c.g_used, c.paid - c.g_paid, c.outside - c.g_outside, 0, p.twice, p.n, s.n - s.unknown, c.excl - c.g_excl]) AS actual
FROM (SELECT COUNT(*) AS n, COUNT(*) FILTER (policy_id % 10 = 3) AS gone, COUNT(*) FILTER (policy_id % 100 = 1) AS twice FROM policy_values) p, (SELECT COUNT(*) AS n, COUNT(*) FILTER (policy_id % 20 = 7) AS unknown FROM scoped) s,
  (SELECT COUNT(*) FILTER (u) AS used, COUNT(*) FILTER (u AND gone) AS g_used, COUNT(*) FILTER (u AND paid) AS paid, COUNT(*) FILTER (u AND paid AND gone) AS g_paid, COUNT(*) FILTER (u AND o) AS outside, COUNT(*) FILTER (u AND o AND gone) AS g_outside,
    COUNT(*) FILTER (NOT u) AS excl, COUNT(*) FILTER (NOT u AND gone) AS g_excl
   FROM (SELECT NOT excluded AS u, status = 'PAGADO' AS paid, cover_state <> 'COINCIDE' AS o, policy_id % 10 = 3 AS gone FROM claim_values) y) c""", FULL_CTE)
def gold_checks_failing(p):
    """A mart without a tenth of the policies, a detail with some twice, and claims of no known scope; each layer is made once."""
    fx, active = stored(p, "fx", p.fx), stored(p, "active", p.active)
    claims = stored(p, "claims", classify.cost_usd(classify.claim_scope(classify.classify(p.claims, p.history, fx), active, CUTOFF), fx))
    policies, values = stored(p, "policies", cohort.policy_values(active, p.products, p.agencies, fx, CUTOFF)), claims.where("scope = 'INCLUIDO'")
    detail = stored(p, "detail", cohort.policy_detail(policies, cohort.claims_by_policy(values)))
    scoped = claims.withColumn("scope", F.when(F.col("policy_id") % 20 != 7, F.col("scope")))
    mart = stored(p, "mart", cohort.cohort_mart(detail.where("policy_id % 10 <> 3")))
    df = checks.gold_checks(mart, detail.unionByName(detail.where("policy_id % 100 = 1")), policies, values, active, scoped, CUTOFF)
    names = ["POLICY_COUNT", "CLAIM_COUNT", "PAID_COUNT", "MISSING_PERIOD_COUNT", "CLAIMS_HAVE_POLICY", "POLICY_DETAIL_UNIQUE", "LATEST_STATE_ELIGIBILITY", "SOURCE_SCOPE_PARTITION", "EXCLUDED_COUNT"]
    return df.where(F.col("check_name").isin(names)).select("check_name", F.col("expected").cast("long").alias("expected"), F.col("actual").cast("long").alias("actual"))


@query("SELECT unnest(['JOIN_DUPLICATES', 'POLICY_WITHOUT_ISSUE_DATE', 'CLAIM_WITHOUT_DATE', 'AMBIGUOUS_COVER', 'DUPLICATE_FX']) AS check_name, TRUE AS passed FROM (SELECT COUNT(*) FROM fx) x")
def gold_stops(p):
    claims = classify.claim_scope(flagged(p), p.active, CUTOFF)
    return checks.gold_stops(p.active, claims, p.fx, CUTOFF).select("check_name", "passed")


def _silver(p: Portfolio, broken: bool) -> DataFrame:
    """The thirteen checks; if broken, over tables in which each of them fails."""
    twice = lambda df, rows: df.unionByName(df.where(rows)) if broken else df
    history, active, claims = twice(p.history, "policy_id % 100 = 1 AND op = 'I'"), twice(p.active, "policy_id % 100 = 33"), twice(flagged(p), "policy_id % 100 = 1")
    products, agencies, fx_rates = twice(p.products, "product_id % 50 = 1"), twice(p.agencies, "agency_id % 10 = 1"), twice(p.fx, "currency = 'ARS'")
    dims = {"products": (products, ["product_id"]), "agencies": (agencies, ["agency_id"]), "fx": (fx_rates, ["currency", "rate_date"])}
    latest = relational.latest_by(p.history, ["policy_id"], "updated_on")
    lost = lambda df, rows: df.where(f"NOT ({rows})") if broken else df
    changed = p.products.withColumn("plan_name", F.when(F.col("product_id") % 7 == 0, F.lit("?")).otherwise(F.col("plan_name"))) if broken else p.products
    content = ["policy_id", "occurred_on", "status", "amount", "currency"]
    brought = {
        "policy": (p.history, lost(p.history, "policy_id % 40 = 1 AND op = 'U'"), ["policy_id", "updated_on", "op"], []), "agencies": (p.agencies, lost(p.agencies, "agency_id % 3 = 0"), ["agency_id"], ["name", "channel"]),
        "products": (p.products, changed, ["product_id"], ["plan_name", "product_type", "max_cover_usd", "is_premium"]), "fx": (p.fx, lost(p.fx, "currency = 'BRL'"), ["currency", "rate_date"], ["factor_usd"]),
        "claims": (p.claims, lost(p.claims, "amount < 0"), ["claim_id"], content),
    }
    if broken:
        claims = claims.withColumn("cover_state", F.when(F.col("policy_id") % 9 != 0, F.col("cover_state")))
    return checks.silver_checks(history, active, claims, dims, latest, brought).select("check_name", F.col("actual").cast("long").alias("actual"), "passed")


_SILVER_NAMES = "['UNIQUE_HISTORY', 'UNIQUE_ACTIVE', 'UNIQUE_CLAIMS', 'UNIQUE_PRODUCTS', 'UNIQUE_AGENCIES', 'UNIQUE_FX', 'POLICY_BATCH_PRESERVED', 'AGENCIES_BATCH_PRESERVED', 'PRODUCTS_BATCH_PRESERVED', 'FX_BATCH_PRESERVED', 'CLAIMS_BATCH_PRESERVED', 'ACTIVE_EQUALS_LATEST', 'FLAGS_APPLIED']"
_SILVER = "SELECT check_name, actual, actual = 0 AS passed FROM (SELECT unnest({names}) AS check_name, unnest([{counts}]) AS actual) x"
_REPEATED = lambda table, keys: f"(SELECT COUNT(*) FROM (SELECT 1 FROM {table} GROUP BY {keys} HAVING COUNT(*) > 1) r)"
_UNIQUE = [("history", "policy_id, updated_on, op"), ("active", "policy_id"), ("claims", "claim_id"), ("products", "product_id"), ("agencies", "agency_id"), ("fx", "currency, rate_date")]
_NONE = [f"(SELECT COUNT(*) FROM {t} WHERE FALSE)" for t in ("history", "agencies", "products", "fx", "claims", "active", "claims")]
_LOST = [
    "(SELECT COUNT(*) FROM history WHERE policy_id % 40 = 1 AND op = 'U')", "(SELECT COUNT(*) FROM agencies WHERE agency_id % 3 = 0)", "(SELECT COUNT(*) FROM products WHERE product_id % 7 = 0)",
    "(SELECT COUNT(*) FROM fx WHERE currency = 'BRL')", "(SELECT COUNT(*) FROM claims WHERE amount < 0)", "(SELECT COUNT(*) FROM active WHERE policy_id % 100 = 33)",
    "(SELECT COUNT(*) + COUNT(*) FILTER (policy_id % 100 = 1) FROM claims WHERE policy_id % 9 = 0)",
]
_TWICE = [
    "(SELECT COUNT(*) FROM history WHERE policy_id % 100 = 1 AND op = 'I')", "(SELECT COUNT(*) FROM active WHERE policy_id % 100 = 33)", "(SELECT COUNT(*) FROM claims WHERE policy_id % 100 = 1)",
    "(SELECT COUNT(*) FROM products WHERE product_id % 50 = 1)", "(SELECT COUNT(*) FROM agencies WHERE agency_id % 10 = 1)", "(SELECT COUNT(*) FROM fx WHERE currency = 'ARS')",
]


@query(_SILVER.format(names=_SILVER_NAMES, counts=", ".join([*(_REPEATED(*u) for u in _UNIQUE), *_NONE])))
def silver_key_checks(p):
    return _silver(p, broken=False)


@query(_SILVER.format(names=_SILVER_NAMES, counts=", ".join(_TWICE + _LOST)))
def silver_checks_failing(p):
    return _silver(p, broken=True)


_METRICS = "CAST(costo AS DOUBLE) / NULLIF(CAST(prima AS DOUBLE), 0) AS loss_ratio, CAST(con AS DOUBLE) / pol AS paid_frequency, CAST(costo AS DOUBLE) / NULLIF(con, 0) AS severity_usd, CAST(prima AS DOUBLE) / pol AS mean_premium_usd"
_SUMMED = "SUM(costo_pagado_usd) AS costo, SUM(prima_usd) AS prima, SUM(siniestros_pagados_con_costo_usd) AS con, SUM(polizas) AS pol"
_OUT = ["loss_ratio", "paid_frequency", "severity_usd", "mean_premium_usd"]


@query(f"SELECT pais, {_METRICS} FROM (SELECT pais, {_SUMMED} FROM mart GROUP BY 1) x", FULL_CTE)
def mart_country_ranking(p):
    df = metrics.metrics(metrics.rollup_mart(mart_of(p), ["pais"])).select("pais", *_OUT)
    return relational.ordered(df, F.desc_nulls_last("loss_ratio"), "pais")


@query("""SELECT es_premium, tipo_producto, CASE WHEN pol = pp AND pag = pc THEN CAST(costo AS DOUBLE) / NULLIF(CAST(prima AS DOUBLE), 0) END AS loss_ratio, CASE WHEN pag = pc THEN CAST(costo AS DOUBLE) / NULLIF(pag, 0) END AS severity_usd,
  CAST(pag AS DOUBLE) / pol AS frequency, CAST(pp AS DOUBLE) / pol AS premium_coverage, CAST(pc AS DOUBLE) / NULLIF(pag, 0) AS cost_coverage
  FROM (SELECT es_premium, tipo_producto, SUM(polizas) AS pol, SUM(polizas_con_prima_usd) AS pp, SUM(siniestros_pagados) AS pag, SUM(siniestros_pagados_con_costo_usd) AS pc, SUM(costo_pagado_usd) AS costo, SUM(prima_usd) AS prima FROM mart GROUP BY 1, 2) x""", FULL_CTE)
def mart_premium_comparison(p):
    df = metrics.complete_metrics(metrics.rollup_mart(mart_of(p), ["es_premium", "tipo_producto"]))
    return df.select("es_premium", "tipo_producto", "loss_ratio", "severity_usd", "frequency", "premium_coverage", "cost_coverage")


@query(f"""SELECT "date", {_METRICS} FROM (SELECT "date", {_SUMMED} FROM mart WHERE "date" BETWEEN DATE '{FIRST}' AND DATE '{LAST}' GROUP BY 1) x""", FULL_CTE)
def mart_monthly(p):
    return metrics.metrics(metrics.rollup_mart(mart_of(p), ["date"], FIRST, LAST)).select("date", *_OUT)


@query(f"SELECT {_METRICS} FROM (SELECT {_SUMMED} FROM mart) x", FULL_CTE)
def mart_total(p):
    return metrics.metrics(metrics.rollup_mart(mart_of(p), [])).select(*_OUT)


@query("""SELECT quarter, lr AS loss_ratio, 100 * (lr - lag(lr) OVER (ORDER BY quarter)) AS change_points
  FROM (SELECT CAST(DATE_TRUNC('quarter', "date") AS DATE) AS quarter, CAST(SUM(costo_pagado_usd) AS DOUBLE) / NULLIF(CAST(SUM(prima_usd) AS DOUBLE), 0) AS lr FROM mart GROUP BY 1) x""", FULL_CTE)
def mart_quarterly(p):
    return metrics.quarterly(mart_of(p)).select("quarter", "loss_ratio", "change_points")


@query(f"""SELECT name, {_METRICS} FROM (SELECT CASE WHEN rn <= 5 THEN pais ELSE 'Otros' END AS name, SUM(costo) AS costo, SUM(prima) AS prima, SUM(con) AS con, SUM(pol) AS pol
  FROM (SELECT *, ROW_NUMBER() OVER (ORDER BY pol DESC, pais) AS rn FROM (SELECT pais, {_SUMMED} FROM mart GROUP BY 1) a) b GROUP BY 1) c""", FULL_CTE)
def mart_top_others(p):
    return metrics.top_k_with_others(mart_of(p), "pais", "polizas", 5).select("name", *_OUT)


@query(f"SELECT pais, CAST(pol AS BIGINT) AS polizas FROM (SELECT pais, {_SUMMED} FROM mart GROUP BY 1) x ORDER BY pol DESC, pais LIMIT 5", FULL_CTE)
def mart_top_k(p):
    return relational.top_k(metrics.rollup_mart(mart_of(p), ["pais"]), "polizas", 5, "pais").select("pais", "polizas")


@query(f"SELECT part, {_METRICS} FROM (SELECT CASE WHEN canal_agencia = 'ONLINE' THEN 'segment' ELSE 'rest' END AS part, {_SUMMED} FROM mart GROUP BY 1) x", FULL_CTE)
def segment_vs_rest(p):
    return metrics.segment_vs_rest(mart_of(p), F.col("canal_agencia") == "ONLINE").select("part", *_OUT)


_LINES = ["l_linenumber", "l_linestatus", "l_orderkey", "l_returnflag"]
_AS_TEXT = "coalesce(CAST(length(CAST({0} AS VARCHAR)) AS VARCHAR) || ':' || CAST({0} AS VARCHAR), '-1:')"


@query(f"SELECT COUNT(*) AS rows, CAST(SUM(CAST(('0x' || substr(sha256({' || '.join(_AS_TEXT.format(c) for c in _LINES)}), 1, 13)) AS BIGINT)) AS DECIMAL(38,0)) AS fingerprint FROM lineitem", None)
def content_fingerprint(p):
    return relational.content_fingerprint(p.table("lineitem").select(*_LINES))


# ---- audits


@query("SELECT COUNT(*) AS missing_rows, COUNT(DISTINCT product_id) AS missing_values FROM history WHERE product_id NOT IN (SELECT product_id FROM products)")
def missing_refs(p):
    return relational.missing_refs(p.history, p.products, "product_id")


_PERIODS = "(SELECT DISTINCT o_custkey AS policy_id, CAST(o_orderdate AS DATE) AS cover_start, CAST(CAST(o_orderdate AS DATE) + INTERVAL '30' DAY AS DATE) AS cover_end FROM orders)"


@query(f"SELECT a.policy_id, a.cover_start AS a_cover_start, a.cover_end AS a_cover_end, b.cover_start AS b_cover_start, b.cover_end AS b_cover_end FROM {_PERIODS} a JOIN {_PERIODS} b ON a.policy_id = b.policy_id AND (a.cover_start, a.cover_end) < (b.cover_start, b.cover_end) AND a.cover_start <= b.cover_end AND b.cover_start <= a.cover_end", None)
def overlap_pairs(p):
    start = F.to_date("o_orderdate")
    return relational.overlap_pairs(p.table("orders").select(F.col("o_custkey").alias("policy_id"), start.alias("cover_start"), F.date_add(start, 30).alias("cover_end")))


@query(f"SELECT p.policy_id, COUNT(*) AS periods, CAST(SUM((SELECT COUNT(*) FROM {_PERIODS} b WHERE p.policy_id = b.policy_id AND (p.cover_start, p.cover_end) < (b.cover_start, b.cover_end) AND p.cover_start <= b.cover_end AND b.cover_start <= p.cover_end)) AS BIGINT) AS overlapping_pairs FROM {_PERIODS} p GROUP BY 1", None)
def overlap_counts(p):
    start = F.to_date("o_orderdate")
    return ranges.overlap_counts(p.table("orders").select(F.col("o_custkey").alias("policy_id"), start.alias("cover_start"), F.date_add(start, 30).alias("cover_end")))


#: The events of every third user give values by type, dense in time; all others ask for the last one; logins pass by.
_VALUES = "(SELECT event_type, ts, MAX(value) AS value FROM events WHERE user_id % 3 = 0 GROUP BY 1, 2)"


@query(f"""SELECT e.event_id, CASE WHEN e.event_type <> 'click' THEN v.value END AS known FROM (SELECT * FROM events WHERE user_id % 3 <> 0) e
  ASOF LEFT JOIN {_VALUES} v ON v.event_type = e.event_type AND v.ts <= e.ts""", None)
def asof_dense_values(p):
    e = p.table("events").select("event_id", "user_id", "event_type", F.col("ts").cast("timestamp").alias("ts"), "value")
    facts = e.where("user_id % 3 <> 0").select("event_id", "event_type", "ts")
    return ranges.asof_last_known(facts, e.where("user_id % 3 = 0").select("event_type", "ts", "value"), ["event_type"], "ts", "value", "known", bypass=F.col("event_type") == "click").select("event_id", "known")


@query("SELECT a.policy_id, CAST(CASE WHEN a.currency = 'USD' THEN 1 ELSE r.factor_usd END AS DOUBLE) AS rate FROM active a LEFT JOIN rates r ON r.currency = a.currency AND a.issued_on >= r.rate_date AND a.issued_on < r.next_date", RATES_CTE)
def fx_asof_last_known(p):
    """The same as the join with intervals, along the order of days; dollars pass by."""
    facts = p.active.select("policy_id", "currency", F.col("issued_on").alias("at"))
    rates = p.fx.where("factor_usd > 0").select("currency", F.col("rate_date").alias("at"), "factor_usd")
    df = ranges.asof_last_known(facts, rates, ["currency"], "at", "factor_usd", "rate", unit="month", bypass=F.col("currency") == "USD")
    return df.select("policy_id", F.when(F.col("currency") == "USD", 1.0).otherwise(F.col("rate").cast("double")).alias("rate"))


@query("""SELECT l_orderkey, l_linenumber, l_quantity, CASE WHEN SUM(n) > 0 THEN 'a' ELSE 'b' END AS side, CAST(ABS(SUM(n)) AS BIGINT) AS times
  FROM (SELECT l_orderkey, l_linenumber, l_quantity, 1 AS n FROM lineitem
    UNION ALL SELECT l_orderkey, l_linenumber, CASE WHEN l_orderkey = 7 THEN l_quantity + 1 ELSE l_quantity END, -1 FROM lineitem) x
  GROUP BY 1, 2, 3 HAVING SUM(n) <> 0""", None)
def find_differences(p):
    """One order's lines differ; the fingerprints of all others agree."""
    a = p.table("lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    b = a.withColumn("l_quantity", F.when(F.col("l_orderkey") == 7, F.col("l_quantity") + 1).otherwise(F.col("l_quantity")))
    return ranges.find_differences(a, b, ["l_orderkey"])


@query("SELECT o_custkey AS policy_id, CAST(date_trunc('month', o_orderdate) AS DATE) AS cover_start, COUNT(DISTINCT CAST(o_orderdate AS DATE)) AS ends, CAST(MIN(o_orderdate) AS DATE) AS first_end, CAST(MAX(o_orderdate) AS DATE) AS last_end FROM orders GROUP BY 1, 2 HAVING COUNT(DISTINCT CAST(o_orderdate AS DATE)) > 1", None)
def same_start_pairs(p):
    end = F.to_date("o_orderdate")
    return relational.same_start_pairs(p.table("orders").select(F.col("o_custkey").alias("policy_id"), F.trunc(end, "MM").alias("cover_start"), end.alias("cover_end")))


_CENTS = "(SELECT claim_id, status, currency, CAST(CASE WHEN amount < 0 THEN -1 ELSE 1 END * floor(abs(amount) / 1000) AS BIGINT) AS amount FROM claims)"


_DATED = "(SELECT claim_id, status, currency, CAST(CASE WHEN amount < 0 THEN -1 ELSE 1 END * floor(abs(amount) / 1000) AS BIGINT) AS amount, policy_id % 100 AS policy_id, date_trunc('quarter', occurred_on) AS occurred_on FROM claims)"


@query(f"SELECT n.claim_id, n.status, n.currency, n.amount, COUNT(c.claim_id) AS opposites FROM {_CENTS} n LEFT JOIN {_CENTS} c ON c.status = n.status AND c.currency = n.currency AND c.amount = -n.amount AND c.amount > 0 WHERE n.amount < 0 GROUP BY ALL")
def opposite_amounts(p):
    sign = F.when(F.col("amount") < 0, -1).otherwise(1)
    c = p.claims.select("claim_id", "status", "currency", (sign * F.floor(F.abs("amount") / 1000)).cast("long").alias("amount"))
    return relational.opposite_amounts(c, ["status", "currency"])


@query(f"""SELECT n.claim_id, n.status, n.currency, n.amount, COUNT(c.claim_id) AS opposites, COUNT(c.claim_id) FILTER (c.policy_id = n.policy_id) AS opposites_same_policy_id, COUNT(c.claim_id) FILTER (c.occurred_on = n.occurred_on) AS opposites_same_occurred_on
  FROM {_DATED} n LEFT JOIN {_DATED} c ON c.status = n.status AND c.currency = n.currency AND c.amount = -n.amount AND c.amount > 0 WHERE n.amount < 0 GROUP BY ALL""")
def opposite_amounts_same_policy_and_day(p):
    """The days of occurrence count by quarter of a year, so some agree."""
    sign = F.when(F.col("amount") < 0, -1).otherwise(1)
    c = p.claims.select("claim_id", "status", "currency", (sign * F.floor(F.abs("amount") / 1000)).cast("long").alias("amount"), (F.col("policy_id") % 100).alias("policy_id"), F.trunc("occurred_on", "quarter").alias("occurred_on"))
    return relational.opposite_amounts(c, ["status", "currency"], also=("policy_id", "occurred_on"))


@query("""SELECT metric, what, COUNT(*) AS rows FROM (SELECT unnest([CASE WHEN amount < 0 THEN 'negative by currency' END, CASE WHEN f.currency IS NULL THEN 'no currency by status' END, 'currency agreement',
    CASE WHEN status = 'PAGADO' AND amount < 0 THEN 'paid special' END, CASE WHEN status = 'PAGADO' AND f.currency IS NULL THEN 'paid special' END, CASE WHEN status = 'PAGADO' AND cover_state = 'FUERA_PERIODO' THEN 'paid special' END, CASE WHEN status = 'PAGADO' AND cover_state = 'POLIZA_AUSENTE' THEN 'paid special' END]) AS metric,
  unnest([COALESCE(f.currency, '(none)'), status, CASE WHEN f.currency IS NULL THEN 'missing' WHEN p.ccy IS NULL THEN 'policy unknown' WHEN UPPER(TRIM(f.currency)) = p.ccy THEN 'same' ELSE 'other' END, 'negative', 'without currency', 'outside cover', 'without policy']) AS what
  FROM flagged0 f LEFT JOIN policy_ccy p ON p.policy_id = f.policy_id) x WHERE metric IS NOT NULL GROUP BY 1, 2""", FLAGS_CTE)
def claim_anomalies(p):
    return profile.claim_anomalies(p.claims, p.history)


_GUARDED = "(SELECT CAST(c_custkey AS VARCHAR) AS run_id, c_nationkey % 3 AS r, c_custkey % 4 AS st, c_custkey % 5 = 0 AS bounded, c_custkey % 6 = 0 AS short, c_custkey % 7 = 0 AS keyless FROM customer)"


@query(f"""SELECT run_id, CASE r WHEN 0 THEN 'policies' WHEN 1 THEN 'claims' ELSE 'fx' END AS resource, problem FROM (SELECT run_id, r, unnest([CASE WHEN st IN (0, 1) THEN NULL ELSE 'RUN_NOT_FINISHED' END,
  CASE WHEN r <> 0 AND (bounded OR st = 3) THEN 'PARTIAL_SNAPSHOT' END, CASE WHEN short THEN 'ROWS_DIFFER' END, CASE WHEN keyless THEN 'ROWS_WITHOUT_KEY' END]) AS problem FROM {_GUARDED} g) x WHERE problem IS NOT NULL""", None)
def run_guards(p):
    """A run for each customer: finished, quarantined, failed or unknown; bounded ones; batches with too few rows or rows without keys."""
    k = F.col("c_custkey")
    df = p.table("customer").select(k.cast("string").alias("run_id"), F.element_at(F.array(*map(F.lit, ("policies", "claims", "fx"))), (F.col("c_nationkey") % 3).cast("int") + 1).alias("resource"), "c_custkey")
    status = F.element_at(F.array(*map(F.lit, ("SUCCESS", "SUCCESS_WITH_QUARANTINE", "FAILED"))), (k % 4).cast("int") + 1)
    runs = df.where("c_custkey % 4 <> 3").select("run_id", status.alias("run_status"), F.when(k % 5 == 0, "bounded").otherwise("full").alias("invocation_mode"))
    batches = df.select("run_id", "resource", (10 - (k % 6 == 0).cast("long")).alias("rows"), F.lit(10).cast("long").alias("expected_rows"), (k % 7 == 0).cast("long").alias("rows_without_key"), F.lit(0).cast("long").alias("ambiguous_keys"))
    return parse.run_guards(runs, batches, df.select("run_id", "resource"))


@query("SELECT ops, COUNT(*) AS policies FROM (SELECT policy_id, string_agg(DISTINCT op, '+' ORDER BY op) AS ops FROM history GROUP BY 1) x GROUP BY 1")
def policy_op_sets(p):
    return profile.policy_op_sets(p.history)


@query("""SELECT 'op ' || op AS metric, COUNT(*) AS rows FROM history GROUP BY 1 UNION ALL SELECT 'latest ' || op || ' ' || status, COUNT(*) FROM latest GROUP BY 1 UNION ALL SELECT 'currency ' || currency, COUNT(*) FROM latest GROUP BY 1
  UNION ALL SELECT 'missing product_id', COUNT(*) FROM history WHERE product_id NOT IN (SELECT product_id FROM products) UNION ALL SELECT 'missing agency_id', COUNT(*) FROM history WHERE agency_id NOT IN (SELECT agency_id FROM agencies)""")
def policy_profile(p):
    return profile.profile_policies(p.history, p.products, p.agencies)


@query("""SELECT unnest(['ids', 'repeated_ids', 'conflicting_ids', 'exact_duplicate_rows', 'amount_null', 'amount_negative', 'amount_zero', 'amount_positive']) AS metric,
  unnest([ids, rep, con, dup, nul, neg, zero, pos]) AS rows FROM
  (SELECT COUNT(*) AS ids, COUNT(*) FILTER (n > 1) AS rep, COUNT(*) FILTER (v > 1) AS con, CAST(SUM(n - v) AS BIGINT) AS dup FROM (SELECT policy_id, COUNT(*) AS n, COUNT(DISTINCT (amount, status)) AS v FROM claims GROUP BY 1) a) b,
  (SELECT COUNT(*) FILTER (amount IS NULL) AS nul, COUNT(*) FILTER (amount < 0) AS neg, COUNT(*) FILTER (amount = 0) AS zero, COUNT(*) FILTER (amount > 0) AS pos FROM claims) c""")
def claim_profile(p):
    return profile.profile_claims(p.claims.withColumn("claim_id", F.col("policy_id")), ["amount", "status"])


@query("""SELECT unnest(['updates_same_period', 'updates_changed_period', 'updates_changed_premium', 'updates_without_predecessor', 'invalid_periods', 'policies_of_several_periods', 'overlapping_pairs', 'claims_in_no_period', 'claims_in_one_period', 'claims_in_several_periods']) AS metric,
  unnest([same, changed, premium, alone, invalid, several, pairs, none, one, more]) AS rows FROM
  (SELECT COUNT(*) FILTER (op = 'U' AND prev AND s = cover_start AND e = cover_end) AS same, COUNT(*) FILTER (op = 'U' AND prev AND (s <> cover_start OR e <> cover_end)) AS changed,
     COUNT(*) FILTER (op = 'U' AND prev AND m <> premium) AS premium, COUNT(*) FILTER (op = 'U' AND prev IS NULL) AS alone, COUNT(*) FILTER (cover_end < cover_start) AS invalid
   FROM (SELECT *, lag(TRUE) OVER w AS prev, lag(cover_start) OVER w AS s, lag(cover_end) OVER w AS e, lag(premium) OVER w AS m FROM renewed r WINDOW w AS (PARTITION BY policy_id ORDER BY updated_on, op)) x) a,
  (SELECT COUNT(*) FILTER (n > 1) AS several FROM (SELECT COUNT(*) AS n FROM periods GROUP BY policy_id) x) b,
  (SELECT COUNT(*) AS pairs FROM periods x JOIN periods y ON x.policy_id = y.policy_id AND (x.cover_start, x.cover_end) < (y.cover_start, y.cover_end) AND x.cover_start <= y.cover_end AND y.cover_start <= x.cover_end) c,
  (SELECT COUNT(*) FILTER (n = 0) AS none, COUNT(*) FILTER (n = 1) AS one, COUNT(*) FILTER (n > 1) AS more
   FROM (SELECT c.claim_id, COUNT(q.policy_id) AS n FROM claims c LEFT JOIN periods q ON q.policy_id = c.policy_id AND c.occurred_on BETWEEN q.cover_start AND q.cover_end GROUP BY 1) x) d""", CTE + f""",
renewed AS (SELECT * FROM {_RENEWED} r0), periods AS (SELECT DISTINCT policy_id, cover_start, cover_end FROM renewed WHERE op <> 'D')""")
def period_diagnostics(p):
    return profile.period_diagnostics(renewed(p), p.claims)


@query("""SELECT COUNT(*) AS without_currency, COUNT(*) FILTER (currency_origin = 'INFERIDA_POLIZA') AS recoverable, COUNT(*) FILTER (currency_origin <> 'INFERIDA_POLIZA') AS unrecoverable, COUNT(usd) FILTER (currency_origin = 'INFERIDA_POLIZA') AS priced,
  CAST(COALESCE(SUM(usd), 0) AS DOUBLE) AS inferable_usd FROM (SELECT f.*, CAST(f.amount * CAST(CASE WHEN claim_currency = 'USD' THEN 1 ELSE r.factor_usd END AS DECIMAL(18,9)) AS DECIMAL(38,9)) AS usd
  FROM flagged0 f LEFT JOIN rates r ON r.currency = f.claim_currency AND f.occurred_on >= r.rate_date AND f.occurred_on < r.next_date WHERE f.currency IS NULL) x""", FLAGS_CTE)
def currency_recovery(p):
    return profile.currency_recovery(p.claims, p.history, p.fx)


@query("""SELECT cover_state, f.status, COUNT(*) AS claims, COUNT(*) FILTER (amount < 0) AS negative, COUNT(*) FILTER (f.currency IS NULL) AS without_currency, COUNT(*) FILTER (f.currency <> h.currency) AS other_currency,
  CAST(MIN(d) AS INT) AS least_days_outside, CAST(MAX(d) AS INT) AS most_days_outside
  FROM (SELECT f.*, CASE WHEN occurred_on < h.cover_start THEN h.cover_start - occurred_on WHEN occurred_on > h.cover_end THEN occurred_on - h.cover_end END AS d FROM flagged0 f LEFT JOIN latest h ON h.policy_id = f.policy_id) f
  LEFT JOIN latest h ON h.policy_id = f.policy_id GROUP BY 1, 2""", FLAGS_CTE)
def diagnose_claims(p):
    return profile.diagnose_claims(p.claims, p.history)


@query("""SELECT claim_id, issue_code, CASE WHEN issue_code = 'MONEDA_NULA' AND currency_origin = 'INFERIDA_POLIZA' THEN 'INFERENCE_APPLIED' ELSE 'PENDING' END AS review_status
  FROM (SELECT claim_id, currency_origin, unnest([CASE WHEN amount < 0 THEN 'MONTO_NEGATIVO' END, CASE WHEN currency IS NULL THEN 'MONEDA_NULA' END, CASE WHEN claim_currency IS NULL THEN 'MONEDA_NO_RECUPERABLE' END,
    CASE WHEN amount_state = 'SIN_COTIZACION' THEN 'SIN_COTIZACION' END, CASE WHEN cover_state = 'FUERA_PERIODO' THEN 'FUERA_PERIODO' END, CASE WHEN cover_state = 'POLIZA_AUSENTE' THEN 'POLIZA_AUSENTE' END]) AS issue_code FROM flagged) y WHERE issue_code IS NOT NULL""", FLAGS_CTE)
def review_queue(p):
    none = p.spark.createDataFrame([], "claim_id string, issue_code string, first_seen_at timestamp, last_seen_at timestamp, review_status string, suggested_currency string")
    return merge.merge_reviews(none, flagged(p), "2001-01-01").select("claim_id", "issue_code", "review_status")


@query("SELECT event_type, COUNT(*) AS rows FROM events GROUP BY 1", None)
def value_frequency(p):
    return relational.frequency(p.table("events"), "event_type")


@query("SELECT event_type, MIN(value) AS least, MAX(value) AS greatest, COUNT(value) AS known, COUNT(value) > 0 AS has_any FROM events GROUP BY 1", None)
def value_range(p):
    return relational.value_range(p.table("events"), ["event_type"], "value")


@query("SELECT l_returnflag, COUNT(DISTINCT CASE WHEN l_quantity > 25 THEN l_partkey END) AS parts FROM lineitem GROUP BY 1", None)
def count_distinct_if(p):
    return p.table("lineitem").groupBy("l_returnflag").agg(relational.count_distinct_if("l_partkey", F.col("l_quantity") > 25).alias("parts"))


@query("SELECT user_id, CAST(ts AS DATE) AS day, list(event_id ORDER BY event_id) AS ids FROM events GROUP BY 1, 2", None)
def collect_rows(p):
    """A user's day at a time: a user may hold a third of all events."""
    df = relational.collect_rows(p.table("events").withColumn("day", F.to_date("ts")), ["user_id", "day"], ["event_id"])
    return df.select("user_id", "day", F.transform("rows", lambda r: r["event_id"]).alias("ids"))


@query("SELECT o_orderkey, c_name FROM orders JOIN customer ON c_custkey = o_custkey", None)
def inner_join(p):
    customers = p.table("customer").select(F.col("c_custkey").alias("o_custkey"), "c_name")
    return relational.inner_on(p.table("orders"), customers, ["o_custkey"]).select("o_orderkey", "c_name")


@query("SELECT p_partkey, unnest(string_split(p_name, ' ')) AS word FROM part", None)
def explode_words(p):
    return relational.explode_array(p.table("part"), F.split("p_name", " "), "word").select("p_partkey", "word")


_MAYBE = "CASE WHEN l_partkey % {0} = 0 THEN NULL ELSE l_quantity END"


@query(f"SELECT l_orderkey, l_linenumber, ({_MAYBE.format(3)}) IS DISTINCT FROM ({_MAYBE.format(5)}) AS changed FROM lineitem", None)
def null_safe_change(p):
    """Of two versions of a column with nulls; the other columns are left out."""
    maybe = lambda n: F.when(F.col("l_partkey") % n != 0, F.col("l_quantity"))
    df = p.table("lineitem").withColumn("changed", expr.is_distinct(maybe(3), maybe(5)))
    return expr.without(df, *(c for c in df.columns if c not in ("l_orderkey", "l_linenumber", "changed")))


@query("SELECT DISTINCT o_orderpriority, o_orderstatus FROM orders", None)
def distinct_on(p):
    return relational.distinct_on(p.table("orders"), "o_orderpriority", "o_orderstatus")


@query("SELECT c_custkey AS k, 'customer' AS kind FROM customer UNION ALL SELECT s_suppkey, 'supplier' FROM supplier", None)
def union_all(p):
    c = p.table("customer").select(F.col("c_custkey").alias("k"), F.lit("customer").alias("kind"))
    return relational.union_all(c, p.table("supplier").select(F.col("s_suppkey").alias("k"), F.lit("supplier").alias("kind")))


@query("SELECT o_orderkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')", None)
def absent_keys(p):
    c = p.table("customer").where("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("o_custkey"))
    return relational.absent_keys(p.table("orders"), c, ["o_custkey"]).select("o_orderkey")


# ---- typed parsing

_EVENT_JSON = "SELECT event_id, json_extract_string(props, '$.k') AS k FROM events"


@query("SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d, CAST(CAST(o_orderdate AS DATE) AS DATE) AS iso FROM orders WHERE o_orderkey % 3 <> 2 UNION ALL SELECT o_orderkey, NULL, NULL FROM orders WHERE o_orderkey % 3 = 2", None)
def date_multi_format(p):
    """Dates written with the day first, as ISO timestamps, or not as dates at all."""
    d = F.to_date("o_orderdate")
    text = F.when(F.col("o_orderkey") % 3 == 0, F.date_format(d, "dd/MM/yyyy")).when(F.col("o_orderkey") % 3 == 1, F.concat(F.date_format(d, "yyyy-MM-dd"), F.lit("T10:00:00Z"))).otherwise("soon")
    iso = F.when(F.col("o_orderkey") % 3 != 2, F.date_format(d, "yyyy-MM-dd")).otherwise("2024-13-45")
    return p.table("orders").select("o_orderkey", expr.parse_date_multi(text, day_first=True).alias("d"), expr.parse_date_multi(iso).alias("iso"))


@query("SELECT l_orderkey, l_linenumber, CASE WHEN l_partkey % 5 = 0 THEN NULL ELSE l_returnflag END AS v FROM lineitem", None)
def json_scalar_guard(p):
    """An object where a scalar is expected is null."""
    nested = F.struct(F.struct(F.lit("NaN").alias("__non_finite_number__")).alias("c"))
    text = F.when(F.col("l_partkey") % 5 == 0, F.to_json(nested)).otherwise(F.to_json(F.struct(F.col("l_returnflag").alias("c"))))
    return p.table("lineitem").select("l_orderkey", "l_linenumber", expr.json_scalar(text, "$.c").alias("v"))


def claim_payloads(p: Portfolio) -> DataFrame:
    """Claims as the JSON in which they come."""
    amount = F.struct(F.col("amount").cast("string").alias("value"), F.col("currency").alias("currency"))
    detail = F.struct(F.when(F.col("status") == "PAGADO", F.lit("A")).alias("city"), F.when(F.col("status") != "PAGADO", F.lit("B")).alias("ciudad_atencion"))
    row = F.struct("claim_id", F.col("policy_id").cast("string").alias("policy_id"), F.date_format("occurred_on", "dd/MM/yyyy").alias("occurred_at"), F.date_format("occurred_on", "yyyy-MM-dd").alias("reported_at"), F.lit("MEDICO").alias("type"), "status", amount.alias("amount"), detail.alias("detail"))
    return p.claims.select(F.to_json(row).alias("payload"))


@query("SELECT claim_id, CAST(policy_id AS VARCHAR) AS policy_id, occurred_on, occurred_on AS reported_on, CAST(amount AS DOUBLE) AS amount, currency, CASE WHEN status = 'PAGADO' THEN 'A' ELSE 'B' END AS city FROM claims")
def claims_parsed(p):
    return money_as_double(parse.parse_claims(claim_payloads(p)).select("claim_id", "policy_id", "occurred_on", "reported_on", "amount", "currency", "city"))


@query("SELECT CAST(policy_id AS VARCHAR) AS policy_id, cover_start, cover_end, CAST(premium AS DOUBLE) AS premium, currency, status, op, updated_on FROM history")
def policies_parsed(p):
    iso = lambda c: F.concat(F.date_format(c, "yyyy-MM-dd"), F.lit("T00:00:00Z"))
    row = F.struct(F.col("policy_id").cast("string").alias("poliza_id"), iso("issued_on").alias("fecha_emision_utc"), F.date_format("cover_start", "yyyy-MM-dd").alias("inicio_vigencia"), iso("cover_end").alias("fin_vigencia"), F.col("premium").cast("string").alias("prima"), F.col("currency").alias("moneda"), F.col("status").alias("estado"), "op", iso("updated_on").alias("updated_at"))
    df = parse.parse_policies(p.history.select(F.to_json(row).alias("payload")))
    return money_as_double(df.select("policy_id", "cover_start", "cover_end", "premium", "currency", "status", "op", expr.utc_date("updated_at").alias("updated_on")))


@query("SELECT CAST(p_partkey AS VARCHAR) AS product_id, p_name AS plan_name, p_type AS product_type, CASE WHEN p_size > 40 THEN NULL ELSE p_size > 25 END AS is_premium FROM part", None)
def products_parsed(p):
    flag = F.when(F.col("p_size") > 40, "maybe").when(F.col("p_size") > 25, "TRUE").otherwise("0")
    row = F.struct(F.col("p_partkey").cast("string").alias("producto_id"), F.col("p_name").alias("nombre_plan"), F.col("p_type").alias("tipo"), flag.alias("es_premium"))
    return parse.parse_products(p.table("part").select(F.to_json(row).alias("payload"))).select("product_id", "plan_name", "product_type", "is_premium")


@query("SELECT rate_date, currency, CAST(factor_usd AS DOUBLE) AS factor_usd FROM fx")
def fx_parsed(p):
    row = F.struct(F.date_format("rate_date", "yyyy-MM-dd").alias("fecha"), F.col("currency").alias("moneda"), F.col("factor_usd").cast("string").alias("factor_usd"))
    return money_as_double(parse.parse_fx(p.fx.select(F.to_json(row).alias("payload"))).select("rate_date", "currency", "factor_usd"))


@query("SELECT CAST(s_suppkey AS VARCHAR) AS agency_id, s_name AS name FROM supplier", None)
def agencies_parsed(p):
    row = F.struct(F.col("s_suppkey").cast("string").alias("agencia_id"), F.col("s_name").alias("nombre"))
    return parse.parse_agencies(p.table("supplier").select(F.to_json(row).alias("payload"))).select("agency_id", "name")


@query("SELECT COUNT(*) AS rows, COUNT(*) AS expected_rows, CAST(0 AS BIGINT) AS rows_without_key, CAST(0 AS BIGINT) AS ambiguous_keys FROM claims")
def batch_checks(p):
    return parse.batch_checks(parse.parse_claims(claim_payloads(p)), ["claim_id"], p.claims.count()).withColumn("expected_rows", F.col("expected_rows").cast("long"))


@query("SELECT path, COUNT(*) AS leaves FROM (SELECT unnest(['claim_id', 'policy_id', 'occurred_at', 'reported_at', 'type', 'status', 'amount.value', CASE WHEN currency IS NOT NULL THEN 'amount.currency' END, CASE WHEN status = 'PAGADO' THEN 'detail.city' ELSE 'detail.ciudad_atencion' END]) AS path FROM claims) x WHERE path IS NOT NULL GROUP BY 1")
def json_leaves(p):
    return profile.json_leaves(claim_payloads(p), "payload", []).groupBy("path").agg(F.count(F.lit(1)).alias("leaves"))


def deep_payloads(p: Portfolio) -> DataFrame:
    """An order under o_orderkey % 60 levels of objects and arrays, with backslashes, quotes and braces in strings."""
    d = (F.col("o_orderkey") % 60).cast("int")
    text = F.concat(
        F.lit('{"p":"C:\\\\","q":"}\\"{[","v":'), F.repeat(F.lit('{"a":['), d), F.lit('{"z":'), F.col("o_orderkey").cast("string"), F.lit(',"s":"\\u007b\\\\\\"]"}'), F.repeat(F.lit("]}"), d), F.lit(',"w":null}')
    )
    return p.table("orders").select("o_orderkey", text.alias("payload"))


@query("""SELECT o_orderkey, unnest(['p', 'q', 'v' || repeat('.a[]', CAST(o_orderkey % 60 AS INT)) || '.z', 'v' || repeat('.a[]', CAST(o_orderkey % 60 AS INT)) || '.s', 'w']) AS path,
  unnest(['C:\\', '}"{[', CAST(o_orderkey AS VARCHAR), '{\\"]', NULL]) AS value FROM orders""", None)
def json_leaves_deep(p):
    return profile.json_leaves(deep_payloads(p), "payload", ["o_orderkey"])


@query("""SELECT o_orderkey, path, value FROM (SELECT o_orderkey, 'v' || repeat('.a[]', CAST(o_orderkey % 60 AS INT)) || '.z' AS path, CAST(o_orderkey AS VARCHAR) AS value FROM orders) x WHERE value LIKE '%7'""", None)
def leaf_screen_deep(p):
    return profile.screened_leaves(deep_payloads(p), "payload", r"(^|\.)z$", r"7$", ["o_orderkey"])


@query("SELECT claim_id, 'amount.currency' AS path, currency AS value FROM claims WHERE currency IN ('ARS', 'BRL')")
def leaf_screen(p):
    df = claim_payloads(p).withColumn("claim_id", F.get_json_object("payload", "$.claim_id"))
    return profile.screened_leaves(df, "payload", r"currency$", r"^(ARS|BRL)$", ["claim_id"])


@query("""SELECT 'status' AS field, 'present' AS kind, COUNT(*) AS records FROM claims UNION ALL SELECT 'amount', 'nested', COUNT(*) FROM claims UNION ALL SELECT 'policy', 'absent', COUNT(*) FROM claims""")
def field_quality(p):
    return profile.field_quality(claim_payloads(p), "payload", ["status", "amount", "policy"])


#: How an amount is written, by l_partkey % 11, and its class.
_WRITTEN = {
    0: ("12.50", "number", "number"), 1: ('"12.50"', "number_text", "string"), 2: ('"1,234.50"', "separators", "string"), 3: ('"1.234,50"', "separators", "string"),
    4: ('"twelve"', "text", "string"), 5: ('" "', "empty", "string"), 6: ("null", "null", "null"), 7: ('{"value":[12]}', "nested", "object"),
    8: ('{"__non_finite_number__":"NaN"}', "marker", "object"), 9: (None, "absent", "absent"), 10: ('"Infinity"', "marker", "string"),
}
_PICK = lambda k: "CASE l_partkey % 11 " + " ".join(f"WHEN {i} THEN '{w[k]}'" for i, w in _WRITTEN.items()) + " END"
_DETAIL = "CASE WHEN l_partkey % 3 = 0 THEN '{0}' WHEN l_partkey % 3 = 1 THEN '{1}' ELSE '{2}' END"


@query(f"""SELECT metric, what, COUNT(*) AS rows FROM (SELECT unnest(['amount_class', 'amount_kind', 'currency', 'detail_fields', 'detail_shape', CASE WHEN l_partkey % 3 = 0 THEN 'detail_kind' END, CASE WHEN l_partkey % 3 = 0 THEN 'detail_kind' END]) AS metric,
  unnest([{_PICK(1)}, {_PICK(2)}, CASE WHEN l_partkey % 2 = 0 THEN 'string:USD' ELSE 'null' END, {_DETAIL.format('city|n', 'array', 'absent')}, {_DETAIL.format('OBJECT<city: STRING, n: OBJECT<x: NUMBER>>', 'ARRAY<NUMBER>', 'absent')}, 'city:string', 'n:object']) AS what FROM lineitem) x WHERE metric IS NOT NULL GROUP BY 1, 2""", None)
def raw_claim_profile(p):
    """Amounts written in eleven ways, details of three shapes."""
    amount = F.element_at(F.array(*(F.lit("" if w[0] is None else f'"value":{w[0]},') for w in _WRITTEN.values())), (F.col("l_partkey") % 11).cast("int") + 1)
    currency = F.when(F.col("l_partkey") % 2 == 0, '"USD"').otherwise("null")
    detail = F.when(F.col("l_partkey") % 3 == 0, ',"detail":{"n":{"x":1.5},"city":"a"}').when(F.col("l_partkey") % 3 == 1, ',"detail":[1,2]').otherwise("")
    return profile.profile_raw_claims(p.table("lineitem").select(F.concat(F.lit('{"amount":{'), amount, F.lit('"currency":'), currency, F.lit("}"), detail, F.lit("}")).alias("payload")))


@query("""SELECT COUNT(*) AS jobs, CAST(SUM(CAST(l_quantity AS BIGINT)) AS BIGINT) AS bytes, MAX(CAST(l_quantity AS BIGINT)) AS largest, 'OVER_LIMIT' AS audit_status
  FROM lineitem WHERE l_returnflag = 'R' AND l_shipdate >= TIMESTAMP '1996-01-01' AND l_shipdate < TIMESTAMP '1999-01-01'""", None)
def consumption_audit(p):
    label = F.array(F.struct(F.lit("flag").alias("key"), F.col("l_returnflag").alias("value")))
    jobs = p.table("lineitem").select(F.col("l_orderkey").alias("job_id"), F.col("l_shipdate").cast("timestamp").alias("started_at"), label.alias("labels"), F.col("l_quantity").cast("long").alias("bytes"), F.lit(False).alias("cached"))
    return profile.consumption_audit(jobs, "1996-01-01", "1999-01-01", ("flag", "R"), 1)


@query("""SELECT unnest(['repeated_ids', 'conflicting_ids', 'negative', 'negative_with_opposite', 'currency_absent', 'currency_nested', 'currency_blank', 'currency_elsewhere']) AS metric, unnest([rep, CAST(0 AS BIGINT), neg, opp, nul, CAST(0 AS BIGINT), CAST(0 AS BIGINT), CAST(0 AS BIGINT)]) AS rows
  FROM (SELECT COUNT(*) AS rep FROM claims WHERE policy_id % 10 = 0) a, (SELECT 2 * COUNT(*) FILTER (policy_id % 10 = 0) + COUNT(*) FILTER (policy_id % 10 <> 0) AS neg FROM claims WHERE amount < 0) b,
  (SELECT CAST(COALESCE(SUM(CASE WHEN n.policy_id % 10 = 0 THEN 2 ELSE 1 END), 0) AS BIGINT) AS opp FROM claims n WHERE n.amount < 0 AND EXISTS (SELECT 1 FROM claims c WHERE c.policy_id = n.policy_id AND c.currency = n.currency AND c.amount = -n.amount)) c,
  (SELECT CAST(COALESCE(SUM(CASE WHEN policy_id % 10 = 0 THEN 2 ELSE 1 END), 0) AS BIGINT) AS nul FROM claims WHERE currency IS NULL) d""")
def raw_claim_audit(p):
    """A tenth of the claims come twice."""
    df = claim_payloads(p)
    again = df.where(F.get_json_object("payload", "$.policy_id").cast("long") % 10 == 0)
    return profile.audit_raw_claims(df.unionByName(again))
