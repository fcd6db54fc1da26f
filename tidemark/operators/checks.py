"""Reconciliation checks: each a row (check_name, expected, actual, difference, passed).

A layer's checks are a few one-row aggregates joined together and unpivoted, so
a layer is checked in one job; a null on either side fails.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from .classify import claim_scope, cost_usd, not_annulled
from .cohort import MART_COLUMNS, claims_by_policy, cohort_mart, policy_detail, policy_values
from .ranges import find_differences
from .relational import table_diff

Check = tuple[str, Column, Column]


class ChecksFailed(Exception):
    """A layer must not be published."""


def as_checks(facts: DataFrame, checks: list[Check]) -> DataFrame:
    """``facts``: one row; each check compares two of its expressions."""
    rows = F.array(*(F.struct(F.lit(n).alias("check_name"), e.cast("decimal(38,9)").alias("expected"), a.cast("decimal(38,9)").alias("actual")) for n, e, a in checks))
    df = facts.select(F.explode(rows).alias("c")).select("c.*")
    return df.select("check_name", "expected", "actual", (F.col("actual") - F.col("expected")).alias("difference"), F.coalesce(F.col("expected") == F.col("actual"), F.lit(False)).alias("passed"))


def run_checks(*checks: DataFrame) -> list[dict]:
    """Evaluate; raises if one fails.  Only a row per check comes to the driver."""
    rows = [r.asDict() for df in checks for r in df.collect()]
    failed = [r["check_name"] for r in rows if not r["passed"]]
    if failed:
        raise ChecksFailed(", ".join(sorted(failed)))
    return rows


def _keys(df: DataFrame, keys: list[str], name: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).agg(F.count_if(F.col("_n") > 1).alias(name))


def _join(*facts: DataFrame) -> DataFrame:
    """One-row frames side by side."""
    out = facts[0]
    for f in facts[1:]:
        out = out.join(f)
    return out


def unique_keys(tables: dict[str, tuple[DataFrame, list[str]]]) -> DataFrame:
    """A check per table that no key repeats."""
    facts = _join(*(_keys(df, keys, name) for name, (df, keys) in tables.items()))
    return as_checks(facts, [(f"UNIQUE_{name.upper()}", F.lit(0), F.col(name)) for name in tables])


def not_preserved(batch: DataFrame, table: DataFrame, keys: list[str], content: list[str], name: str) -> DataFrame:
    """One row: rows of the batch that the table lacks or has with other content."""
    here = table.select(*keys, F.struct(F.lit(True).alias("there"), *content).alias("_there"))
    lost = F.col("_there").isNull() | ~F.struct(F.lit(True).alias("there"), *content).eqNullSafe(F.col("_there"))
    return batch.select(*keys, *(c for c in content if c not in keys)).join(here, keys, "left").agg(F.count_if(lost).alias(name))


def silver_checks(
    history: DataFrame, active: DataFrame, claims: DataFrame, dims: dict[str, tuple[DataFrame, list[str]]], latest: DataFrame,
    batches: dict[str, tuple[DataFrame, DataFrame, list[str], list[str]]] | None = None,
) -> DataFrame:
    """Unique keys of every table, batches preserved, current state equal to the latest events, every claim with its flags.

    ``batches``: for each resource what was brought, the table it went to, its keys and its content.
    """
    tables = {"history": (history, ["policy_id", "updated_on", "op"]), "active": (active, ["policy_id"]), "claims": (claims, ["claim_id"]), **dims}
    live = latest.where("op <> 'D'").select(*active.columns)
    same = table_diff(active, live).select((F.col("only_a") + F.col("only_b")).alias("state_difference"))
    flags = claims.agg(F.count_if(F.col("cover_state").isNull() | F.col("amount_state").isNull() | F.col("currency_origin").isNull() | F.col("excluded").isNull()).alias("unflagged"))
    kept = [not_preserved(*b, f"lost_{name}") for name, b in (batches or {}).items()]
    more = [("ACTIVE_EQUALS_LATEST", F.lit(0), F.col("state_difference")), ("FLAGS_APPLIED", F.lit(0), F.col("unflagged"))]
    more += [(f"{name.upper()}_BATCH_PRESERVED", F.lit(0), F.col(f"lost_{name}")) for name in batches or {}]
    return unique_keys(tables).unionByName(as_checks(_join(same, flags, *kept), more))


def gold_stops(policies: DataFrame, claims: DataFrame, fx: DataFrame, cutoff: str) -> DataFrame:
    """What must not be there before the mart is built."""
    facts = _join(
        _keys(policies, ["policy_id"], "dup_policies"), policies.agg(F.count_if(F.col("issued_on").isNull()).alias("no_issue")), claims.agg(F.count_if(F.col("occurred_on").isNull()).alias("no_date")),
        claims.agg(F.count_if((F.col("scope") == "INCLUIDO") & (F.col("cover_state") == "COBERTURA_AMBIGUA")).alias("ambiguous")), _keys(fx, ["currency", "rate_date"], "dup_fx"),
    )
    names = {"JOIN_DUPLICATES": "dup_policies", "POLICY_WITHOUT_ISSUE_DATE": "no_issue", "CLAIM_WITHOUT_DATE": "no_date", "AMBIGUOUS_COVER": "ambiguous", "DUPLICATE_FX": "dup_fx"}
    return as_checks(facts, [(n, F.lit(0), F.col(c)) for n, c in names.items()])


_SUMS = ["polizas", "polizas_con_prima_usd", "prima_usd", "siniestros", "siniestros_pagados", "siniestros_rechazados", "siniestros_en_analisis", "siniestros_otros_estados", "siniestros_pagados_con_costo_usd", "costo_pagado_usd", "siniestros_sin_poliza", "siniestros_sin_periodo", "siniestros_pagados_sin_periodo", "costo_pagado_sin_periodo_usd", "siniestros_poliza_anulada", "siniestros_poliza_borrada", "siniestros_pagados_con_periodo", "costo_pagado_con_periodo_usd", "siniestros_excluidos", "siniestros_pagados_excluidos", "siniestros_moneda_inferida"]


def _total(c: str | Column) -> Column:
    return F.coalesce(F.sum(c), F.lit(0))


def _mart_facts() -> list[Column]:
    return [*(_total(c).alias(f"m_{c}") for c in _SUMS), F.count_if(F.col("date") != F.trunc("date", "MM")).alias("m_not_month")]


def _policy_facts() -> list[Column]:
    return [F.count(F.lit(1)).alias("p_rows"), F.count_if(~not_annulled()).alias("p_annulled"), _total("premium_usd").alias("p_premium"), F.count("premium_usd").alias("p_priced")]


def _active_facts(cutoff: str) -> list[Column]:
    return [F.count_if(not_annulled() & (F.col("issued_on") <= F.lit(cutoff).cast("date"))).alias("a_eligible")]


def _claim_facts(cutoff: str, here: Column) -> list[Column]:
    used, paid = here & ~F.col("excluded"), here & (F.col("status") == "PAGADO")
    covered, priced = F.coalesce(F.col("cover_state") == "COINCIDE", F.lit(False)), F.col("cost_usd").isNotNull()
    return [
        F.count_if(used).alias("c_used"), F.count_if(used & paid).alias("c_paid"), _total(F.when(paid, F.col("cost_usd"))).alias("c_cost"), F.count_if(used & ~covered).alias("c_outside"),
        F.count_if(paid & priced).alias("c_priced"), F.count_if(used & paid & covered).alias("c_covered"), _total(F.when(paid & covered, F.col("cost_usd"))).alias("c_covered_cost"),
        F.count_if(here & F.col("excluded") & priced).alias("c_excluded_cost"), F.count_if(here & F.col("excluded")).alias("c_excluded"), F.count_if(here & (F.col("occurred_on") > F.lit(cutoff).cast("date"))).alias("c_late"),
        F.count_if(used & (F.col("currency_origin") == "INFERIDA_POLIZA")).alias("c_inferred"),
    ]


def _scope_facts() -> list[Column]:
    known = F.col("scope").isin("INCLUIDO", "POLIZA_D_O_AUSENTE", "POLIZA_ANULADA", "EMISION_FUTURA", "OCURRENCIA_FUTURA")
    return [F.count(F.lit(1)).alias("s_all"), F.count_if(known).alias("s_known")]


def _between_layers(mart: DataFrame, detail: DataFrame, policies: DataFrame, claims: DataFrame) -> list[DataFrame]:
    orphans = claims.join(policies.select("policy_id"), "policy_id", "left_anti").agg(F.count(F.lit(1)).alias("orphans"))
    return [_keys(mart, MART_COLUMNS[:12] + MART_COLUMNS[-2:], "m_repeats"), orphans, _keys(detail, ["policy_id"], "d_repeats")]


def gold_checks(mart: DataFrame, detail: DataFrame, policies: DataFrame, claims: DataFrame, active: DataFrame, scoped: DataFrame, cutoff: str) -> DataFrame:
    """The 24 checks of the mart, over layers that are there.

    ``policies`` carry premium_usd, ``claims`` (in scope) cost_usd; ``scoped`` are
    all source claims with their scope.  Sums over no rows count as zero.
    """
    layers = [mart.agg(*_mart_facts()), policies.agg(*_policy_facts()), active.agg(*_active_facts(cutoff)), claims.agg(*_claim_facts(cutoff, F.lit(True))), scoped.agg(*_scope_facts())]
    return _gold(_join(*layers, *_between_layers(mart, detail, policies, claims)))


def build_gold(active: DataFrame, claims: DataFrame, products: DataFrame, agencies: DataFrame, fx: DataFrame, cutoff: str, path: str) -> tuple[DataFrame, DataFrame]:
    """Write the layers of the mart under ``path`` and check them: (mart, checks).

    What a check needs of a layer's rows is observed by the write itself, at its
    last stage; only the questions between rows and layers (repeats, orphans) are
    asked of what was written.  All claims are written with scope and cost.
    """
    spark = active.sparkSession
    seen: dict[str, object] = {}

    def write(name: str, df: DataFrame, *facts: Column) -> DataFrame:
        watch = Observation(name)
        df.observe(watch, *facts).write.parquet(f"{path}/{name}")
        seen.update(watch.get)
        return spark.read.schema(df.schema).parquet(f"{path}/{name}")

    fx = write("fx", fx, F.count(F.lit(1)).alias("f_rows"))
    active = write("active", active, *_active_facts(cutoff))
    valued = cost_usd(claim_scope(claims, active, cutoff), fx)
    included = F.coalesce(F.col("scope") == "INCLUIDO", F.lit(False))
    valued = write("claims", valued, *_scope_facts(), *_claim_facts(cutoff, included))
    values = valued.where(included)
    detail = write("detail", policy_detail(policy_values(active, products, agencies, fx, cutoff), claims_by_policy(values)), *_policy_facts())
    mart = write("mart", cohort_mart(detail), *_mart_facts())
    observed = spark.range(1).select(*(F.lit(v).alias(n) for n, v in seen.items()))
    return mart, _gold(_join(observed, *_between_layers(mart, detail, detail, values)))


def _gold(facts: DataFrame) -> DataFrame:
    col, zero = F.col, F.lit(0)
    return as_checks(facts, [
        ("POLICY_COUNT", col("p_rows"), col("m_polizas")), ("ANNULLED_EXCLUDED", zero, col("p_annulled")), ("LATEST_STATE_ELIGIBILITY", col("a_eligible"), col("p_rows")),
        ("PREMIUM_SUM", col("p_premium"), col("m_prima_usd")), ("CLAIM_COUNT", col("c_used"), col("m_siniestros")), ("SOURCE_SCOPE_PARTITION", col("s_all"), col("s_known")),
        ("PAID_COUNT", col("c_paid"), col("m_siniestros_pagados")), ("PAID_COST", col("c_cost"), col("m_costo_pagado_usd")),
        ("CLAIM_STATES", col("m_siniestros"), col("m_siniestros_pagados") + col("m_siniestros_rechazados") + col("m_siniestros_en_analisis") + col("m_siniestros_otros_estados")),
        ("MISSING_PERIOD_COUNT", col("c_outside"), col("m_siniestros_sin_periodo")), ("PREMIUM_VALID_COUNT", col("p_priced"), col("m_polizas_con_prima_usd")),
        ("PAID_VALID_COUNT", col("c_priced"), col("m_siniestros_pagados_con_costo_usd")), ("GRAIN_UNIQUE", zero, col("m_repeats")),
        ("COVERED_PAID_COUNT", col("c_covered"), col("m_siniestros_pagados_con_periodo")), ("COVERED_PAID_COST", col("c_covered_cost"), col("m_costo_pagado_con_periodo_usd")),
        ("NO_EXCLUDED_COST", zero, col("c_excluded_cost")), ("EXCLUDED_COUNT", col("c_excluded"), col("m_siniestros_excluidos")),
        ("PAID_PARTITION", col("m_siniestros_pagados"), col("m_siniestros_pagados_con_periodo") + col("m_siniestros_pagados_sin_periodo")),
        ("POLICY_DETAIL_UNIQUE", zero, col("d_repeats")), ("CLAIMS_HAVE_POLICY", zero, col("orphans")), ("COHORT_MONTH", zero, col("m_not_month")), ("OCCURRENCE_CUTOFF", zero, col("c_late")),
        ("LEGACY_OUT_OF_SCOPE_ZERO", zero, col("m_siniestros_sin_poliza") + col("m_siniestros_poliza_anulada") + col("m_siniestros_poliza_borrada")),
        ("INFERRED_INCLUDED_COUNT", col("c_inferred"), col("m_siniestros_moneda_inferida")),
    ])


def assert_contract(df: DataFrame, columns: list[tuple[str, str]], forbid_ids: bool = False) -> None:
    """Names, types and order as declared; optionally no column of ids."""
    if (found := df.dtypes) != columns:
        raise ChecksFailed(f"schema: {[x for x in zip(found, columns) if x[0] != x[1]] or 'number of columns'}")
    if forbid_ids and (ids := [c for c, _ in found if c.endswith("_id")]):
        raise ChecksFailed(f"ids in the mart: {ids}")


def assert_equal(a: DataFrame, b: DataFrame, keys: list[str] | None = None) -> None:
    """Equal row for row, repeats counted; if not, the error names some of the rows and their sides."""
    found = find_differences(a, b, keys or a.columns).take(5)
    if found:
        raise ChecksFailed("tables differ: " + "; ".join(f"{r['side']} has {r['times']} more of {[r[k] for k in keys or a.columns]}" for r in found))
