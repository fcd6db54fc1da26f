"""Semantic layer on the mart: always ratios of sums."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expr import ratio
from .cohort import COSTS, MEASURES

SUMS = ["polizas", "polizas_con_prima_usd", "prima_usd", *MEASURES]
#: name -> (numerator, denominator), columns of the mart.
METRICS: dict[str, tuple[str, str]] = {
    "loss_ratio": ("costo_pagado_usd", "prima_usd"),
    "paid_frequency": ("siniestros_pagados_con_costo_usd", "polizas"),
    "severity_usd": ("costo_pagado_usd", "siniestros_pagados_con_costo_usd"),
    "mean_premium_usd": ("prima_usd", "polizas"),
}


def register_metric(name: str, numerator: str, denominator: str) -> None:
    METRICS[name] = (numerator, denominator)


def rollup_mart(mart: DataFrame, dims: list[str | Column], first: str | None = None, last: str | None = None) -> DataFrame:
    """Sums of the mart's measures; without dimensions the grand total."""
    if first:
        mart = mart.where(F.col("date") >= F.lit(first).cast("date"))
    if last:
        mart = mart.where(F.col("date") <= F.lit(last).cast("date"))
    return mart.groupBy(*dims).agg(*(F.sum(m).alias(m) for m in SUMS))


def metrics(df: DataFrame) -> DataFrame:
    return df.withColumns({n: ratio(F.col(a), F.col(b)) for n, (a, b) in METRICS.items()})


def complete_metrics(sums: DataFrame) -> DataFrame:
    """Metrics only where every policy and paid claim has its USD value, and how many have."""
    premiums = F.col("polizas") == F.col("polizas_con_prima_usd")
    costs = F.col("siniestros_pagados") == F.col("siniestros_pagados_con_costo_usd")
    return sums.withColumns(
        {
            "loss_ratio": F.when(premiums & costs, ratio(F.col("costo_pagado_usd"), F.col("prima_usd"))),
            "severity_usd": F.when(costs, ratio(F.col("costo_pagado_usd"), F.col("siniestros_pagados"))),
            "frequency": ratio(F.col("siniestros_pagados"), F.col("polizas")),
            "premium_coverage": ratio(F.col("polizas_con_prima_usd"), F.col("polizas")),
            "cost_coverage": ratio(F.col("siniestros_pagados_con_costo_usd"), F.col("siniestros_pagados")),
        }
    )


def segment_vs_rest(mart: DataFrame, segment: Column) -> DataFrame:
    """Metrics of a segment and of all the rest."""
    name = F.when(F.coalesce(segment, F.lit(False)), "segment").otherwise("rest").alias("part")
    return metrics(rollup_mart(mart, [name]))


def quarterly(mart: DataFrame) -> DataFrame:
    """Loss ratio by quarter and its change against the quarter before, in points."""
    df = metrics(rollup_mart(mart, [F.trunc("date", "quarter").alias("quarter")]))
    # One row per quarter is left here, so the window without keys is small whatever the mart's size.
    before = F.lag("loss_ratio").over(Window.orderBy("quarter"))
    return df.withColumn("change_points", 100 * (F.col("loss_ratio") - before))


def top_k_with_others(mart: DataFrame, dim: str, metric: str, k: int, others: str = "Otros") -> DataFrame:
    """The k groups with the largest sum of a measure, the remainder as one, ratios of sums."""
    sums = rollup_mart(mart, [dim])
    top = sums.orderBy(F.col(metric).desc_nulls_last(), dim).limit(k).select(dim, F.lit(True).alias("_top"))
    named = sums.join(F.broadcast(top), dim, "left").withColumn("name", F.when(F.col("_top"), F.col(dim)).otherwise(others))
    return metrics(named.groupBy("name").agg(*(F.sum(m).alias(m) for m in SUMS)))


def as_doubles(df: DataFrame) -> DataFrame:
    """Money as doubles, after the exact sums."""
    return df.withColumns({c: F.col(c).cast("double") for c in df.columns if c in (*COSTS, "prima_usd")})
