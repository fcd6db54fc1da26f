"""Exchange rates: validity intervals, as-of joins, daily fill, quality."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.expr import RATE, month_key, month_keys
from .relational import forward_fill, with_next

OPEN_END = "9999-12-31"


def rate_intervals(fx: DataFrame) -> DataFrame:
    """Positive rates with the day from which the next one holds."""
    return with_next(fx.where("factor_usd > 0"), ["currency"], "rate_date", "next_date", F.lit(OPEN_END).cast("date"))


def _by_month(intervals: DataFrame) -> DataFrame:
    """A row per month that an interval touches, so a join by (currency, month) meets a few rates, not all of a currency."""
    return intervals.withColumn("_month", F.explode(month_keys("rate_date", "next_date")))


def asof_rate(df: DataFrame, fx: DataFrame, date: str, currency: str, how: str | None = None) -> DataFrame:
    """Adds ``rate``: 1 for USD, else the last positive rate up to the date, else null.

    An equi join on currency and month with the interval as a residual; no job
    runs while the plan is built.  Whether the rates are broadcast is Spark's
    decision by their size, unless ``how`` names a join hint.
    """
    intervals = rate_intervals(fx).select(F.col("currency").alias("_ccy"), "rate_date", "next_date", F.col("factor_usd").alias("_rate"))
    cut = _by_month(intervals)
    inside = (F.col(date) >= F.col("rate_date")) & (F.col(date) < F.col("next_date"))
    joined = df.join(cut.hint(how) if how else cut, (F.col(currency) == F.col("_ccy")) & (month_key(date) == F.col("_month")) & inside, "left")
    rate = F.when(F.col(currency) == "USD", F.lit(1)).otherwise(F.col("_rate")).cast(RATE)
    return joined.withColumn("rate", rate).drop("_ccy", "rate_date", "next_date", "_rate", "_month")


def fx_daily(fx: DataFrame, first: Column, last: Column) -> DataFrame:
    """currency, day, factor_usd: every day from ``first`` to ``last`` with the rate that holds; only days with one.

    Bounded by currencies times days, whatever the facts' size.
    """
    positive = fx.where("factor_usd > 0")
    days = positive.select("currency").distinct().withColumn("day", F.explode(F.sequence(first, last)))
    known = positive.select("currency", F.col("rate_date").alias("day"), "factor_usd")
    filled = forward_fill(days.join(known, ["currency", "day"], "left"), ["currency"], "day", ["factor_usd"])
    return filled.where("factor_usd IS NOT NULL")


def first_rates(fx: DataFrame) -> DataFrame:
    """The day of the first positive rate of each currency: enough to know whether a prior rate exists."""
    return fx.where("factor_usd > 0").groupBy("currency").agg(F.min("rate_date").alias("first_rate"))


def has_prior_rate(df: DataFrame, fx: DataFrame, date: str, currency: str) -> DataFrame:
    """Adds ``has_rate``: USD, or some positive rate up to the date.  One row per currency is joined, not the rates."""
    first = first_rates(fx).select(F.col("currency").alias("_ccy"), "first_rate")
    joined = df.join(first, F.col(currency) == F.col("_ccy"), "left")
    found = (F.col(currency) == "USD") | (F.col("first_rate") <= F.col(date))
    return joined.withColumn("has_rate", F.coalesce(found, F.lit(False))).drop("_ccy", "first_rate")


def duplicate_rates(fx: DataFrame) -> DataFrame:
    return fx.groupBy("currency", "rate_date").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")


def fx_reciprocity(fx: DataFrame, tolerance: str = "0.000001") -> DataFrame:
    """Per currency: rates, non-positive ones, and those whose factor and inverse don't multiply to one."""
    positive = (F.col("factor_usd") > 0) & (F.col("units_per_usd") > 0)
    off = F.abs(F.col("factor_usd").cast("decimal(18,9)") * F.col("units_per_usd").cast("decimal(18,9)") - 1) > F.lit(tolerance).cast("decimal(18,9)")
    return fx.groupBy("currency").agg(
        F.count(F.lit(1)).alias("rates"), F.count_if(~F.coalesce(positive, F.lit(False))).alias("non_positive"), F.count_if(positive & off).alias("not_reciprocal")
    )


def fx_gap_bins(df: DataFrame, fx: DataFrame, date: str, currency: str) -> DataFrame:
    """Rows by how old the rate is that holds on their date (any sign counts)."""
    dates = fx.select("currency", "rate_date").distinct()
    intervals = with_next(dates, ["currency"], "rate_date", "next_date", F.lit(OPEN_END).cast("date")).withColumnRenamed("currency", "_ccy")
    known = dates.select(F.col("currency").alias("_known")).distinct()
    on = (F.col(currency) == F.col("_ccy")) & (month_key(date) == F.col("_month")) & (F.col(date) >= F.col("rate_date")) & (F.col(date) < F.col("next_date"))
    joined = df.select(date, currency).join(_by_month(intervals), on, "left").join(known, F.col(currency) == F.col("_known"), "left")
    age = F.datediff(date, "rate_date")
    gap = (
        F.when(F.col(date).isNull(), "invalid_date").when(F.col(currency) == "USD", "exact").when(F.col("_known").isNull(), "invalid_currency")
        .when(F.col("rate_date").isNull(), "no_prior").when(age == 0, "exact").when(age <= 7, "1-7").when(age <= 30, "8-30").otherwise("over_30")
    )
    return joined.groupBy(gap.alias("gap")).agg(F.count(F.lit(1)).alias("rows"))
