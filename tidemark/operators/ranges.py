"""Operators along an order that never put a whole key into one window: neighbours, sweeps, last known values, fingerprint trees.

Rows are dealt by key and a stretch of the order; what a stretch needs from
before it is one row of a table with a row per stretch.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expr import FIRST_MONTH, LAST_MONTH

STRETCH = 10_000


def with_previous_in_order(df: DataFrame, keys: list[str], order: str, cols: list[str], name: str = "previous", stretch: int = STRETCH) -> DataFrame:
    """The columns of the row before within the keys, by an integer order that doesn't repeat; null for the first.

    The window's partitions are (keys, stretch of the order).  The first row of a
    stretch takes the last row of the nearest stretch before it that has any.
    """
    part = F.floor(F.col(order) / stretch).alias("_part")
    df = df.withColumn("_part", part)
    inner = Window.partitionBy(*keys, "_part").orderBy(order)
    row = F.struct(order, *cols)
    ends = df.groupBy(*keys, "_part").agg(F.max_by(row, F.col(order)).alias("_end"))
    before = ends.select(*keys, "_part", F.lag("_end").over(Window.partitionBy(*keys).orderBy("_part")).alias("_before"))
    joined = df.withColumn("_lag", F.lag(row).over(inner)).join(before, [*keys, "_part"], "left")
    return joined.withColumn(name, F.coalesce("_lag", "_before")).drop("_part", "_lag", "_before")


def overlap_counts(periods: DataFrame, key: str = "policy_id", start: str = "cover_start", end: str = "cover_end") -> DataFrame:
    """How many different periods a key has, and how many pairs of them share a day, without making the pairs.

    Of the periods in order of (start, end), each overlaps all before it but those
    that ended before its start.  Starts and ends are counted by day first, so
    the running count goes over days, however many periods a key has.
    """
    df = periods.where(F.col(start) <= F.col(end)).select(key, start, end).distinct()
    events = df.select(key, F.explode(F.array(F.struct(F.col(start).alias("day"), F.lit(1).alias("s"), F.lit(0).alias("e")), F.struct(F.date_add(end, 1).alias("day"), F.lit(0).alias("s"), F.lit(1).alias("e")))).alias("x"))
    days = events.groupBy(key, "x.day").agg(F.sum("x.s").alias("starts"), F.sum("x.e").alias("ends"))
    ended = F.sum("ends").over(Window.partitionBy(key).orderBy("day").rowsBetween(Window.unboundedPreceding, 0))
    per = days.withColumn("ended", ended).groupBy(key).agg(F.sum("starts").alias("periods"), F.sum(F.col("starts") * F.col("ended")).alias("_apart"))
    pairs = F.expr("periods * (periods - 1) div 2") - F.col("_apart")
    return per.select(key, F.col("periods").cast("long").alias("periods"), pairs.cast("long").alias("overlapping_pairs"))


def asof_last_known(facts: DataFrame, values: DataFrame, keys: list[str], at: str, value: str, name: str, unit: str = "day", slices: int = 16, bypass: Column | None = None) -> DataFrame:
    """``facts`` with ``name``: the last ``value`` of the same keys up to the time, however dense the values and hot the keys.

    Both sides are one table in order of time within (keys, ``unit`` of time,
    slice), and a row takes the last value before it.  A stretch starts with
    the value that holds when it begins.  Facts are dealt over ``slices`` by a
    hash, the values of a stretch go to each, so a key with most of the facts
    is many tasks.  Facts that ``bypass`` names meet no values and are dealt
    by the hash alone.  Of values at one time the largest holds; null keys and times find none.
    """
    own = list(facts.columns)
    hashed = F.xxhash64(*own)
    passed = F.coalesce(bypass, F.lit(False)) if bypass is not None else F.lit(False)
    known = values.where(F.col(value).isNotNull() & F.col(at).isNotNull()).groupBy(*keys, at).agg(F.max(value).alias("_value"))
    stretch = lambda c: F.date_trunc(unit, F.least(F.greatest(c.cast("timestamp"), F.lit(FIRST_MONTH).cast("timestamp")), F.lit(LAST_MONTH).cast("timestamp")))
    # The value that holds at the start of each stretch: one row per stretch from a key's first value to the facts' last time.
    last = facts.agg(stretch(F.max(at)).alias("_last"))
    ends = known.groupBy(*keys, stretch(F.col(at)).alias("_from")).agg(F.max_by("_value", F.col(at)).alias("_value"))
    ends = ends.withColumn("_to", F.lead("_from").over(Window.partitionBy(*keys).orderBy("_from"))).join(last)
    to = F.coalesce("_to", F.greatest("_last", F.col("_from")))
    carried = ends.where(F.col("_from") < to).select(*keys, "_value", F.explode(F.expr(f"sequence(_from + interval 1 {unit}, coalesce(_to, greatest(_last, _from)), interval 1 {unit})")).alias("_stretch"))
    right = known.select(*keys, "_value", stretch(F.col(at)).alias("_stretch"), F.col(at).cast("timestamp").alias("_at"), F.lit(1).alias("_kind"))
    right = right.unionByName(carried.select(*keys, "_value", "_stretch", F.col("_stretch").alias("_at"), F.lit(0).alias("_kind")))
    right = right.withColumn("_slice", F.explode(F.sequence(F.lit(0), F.lit(slices - 1)))).withColumn("_row", F.lit(None).cast(facts.select(F.struct(*own).alias("r")).schema["r"].dataType))
    left = facts.select(
        *keys, F.lit(None).cast(values.schema[value].dataType).alias("_value"), F.when(~passed, stretch(F.col(at))).alias("_stretch"), F.col(at).cast("timestamp").alias("_at"), F.lit(2).alias("_kind"),
        F.when(passed | F.col(at).isNull(), hashed).otherwise(F.pmod(hashed, F.lit(slices))).alias("_slice"), F.struct(*own).alias("_row"),
    )
    rows = left.unionByName(right.select(*left.columns[:-1], "_row"))
    w = Window.partitionBy(*keys, "_stretch", "_slice").orderBy("_at", "_kind").rowsBetween(Window.unboundedPreceding, 0)
    found = rows.withColumn("_found", F.last("_value", ignorenulls=True).over(w)).where("_kind = 2")
    return found.select(*(F.col(f"_row.{c}").alias(c) for c in own), F.when(F.col("_stretch").isNotNull(), F.col("_found")).alias(name))


TREE = 4096


def _print(df: DataFrame, cols: list[str], bucket: Column) -> DataFrame:
    """Per bucket the rows and two sums of row hashes; a null is told from any value by its place."""
    marked = [x for c in cols for x in (F.col(c).isNull(), F.col(c))]
    sums = [F.sum(F.xxhash64(F.lit(k), *marked).cast("decimal(38,0)")).alias(f"h{k}") for k in (0, 1)]
    return df.groupBy(bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("rows"), *sums)


def _differing(a: DataFrame, b: DataFrame, cols: list[str], bucket: Column) -> list:
    """Buckets whose fingerprints differ: at most as many as there are buckets come to the driver."""
    left, right = _print(a, cols, bucket), _print(b, cols, bucket).toDF("bucket", "_rows", "_h0", "_h1")
    same = F.struct("rows", "h0", "h1").eqNullSafe(F.struct("_rows", "_h0", "_h1"))
    return [r[0] for r in left.join(right, "bucket", "full").where(~same).select("bucket").collect()]


def find_differences(a: DataFrame, b: DataFrame, keys: list[str], width: int = TREE) -> DataFrame:
    """Rows that only one side has, with ``side`` (a or b) and ``times``; only what lies in differing buckets is shuffled.

    A tree of fingerprints by the keys' hash, two levels deep: aggregates find the
    buckets that differ, aggregates over those find the smaller buckets in
    them, and just these buckets' rows are compared.
    """
    cols = a.columns
    b = b.select(*cols)
    h = F.xxhash64(*keys)
    top, low = F.pmod(h, F.lit(width)), F.pmod(F.floor(h / width), F.lit(width))
    none = a.limit(0).select(*cols, F.lit("a").alias("side"), F.lit(0).cast("long").alias("times"))
    if not (upper := _differing(a, b, cols, top)):
        return none
    a, b = (df.where(top.isin(upper)) for df in (a, b))
    if not (lower := _differing(a, b, cols, low)):
        return none
    both = a.where(low.isin(lower)).select(*cols, F.lit(1).alias("_n")).unionByName(b.where(low.isin(lower)).select(*cols, F.lit(-1).alias("_n")))
    more = both.groupBy(*cols).agg(F.sum("_n").alias("_n")).where("_n <> 0")
    return more.select(*cols, F.when(F.col("_n") > 0, "a").otherwise("b").alias("side"), F.abs("_n").cast("long").alias("times"))
