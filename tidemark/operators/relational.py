"""Windows, joins, aggregates and set operations that the layers share."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expr import month_key, month_keys

# ---- windows


def latest_by(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The row with the largest ``order`` for each key, in one shuffle with partial results before it.

    A null order comes before any other; of equal ones the row with the largest
    hash stays, so the result doesn't depend on the rows' places.  The buffers
    are structs, so Spark aggregates by sorting.
    """
    rest = [c for c in df.columns if c not in keys]
    best = F.max_by(F.struct(*rest), F.struct(F.col(order).isNotNull(), F.col(order), F.xxhash64(*rest))).alias("_best")
    return df.groupBy(*keys).agg(best).select(*keys, *(F.col(f"_best.{c}").alias(c) for c in rest)).select(*df.columns)


def latest_periods(history: DataFrame, key: str = "policy_id", start: str = "cover_start", end: str = "cover_end", order: str = "updated_on") -> DataFrame:
    """The latest event of each distinct cover period, deletions left out first."""
    return latest_by(history.where("op <> 'D'"), [key, start, end], order)


def latest_with_ties(df: DataFrame, keys: list[str], order: str, content: str) -> DataFrame:
    """Latest row per key with ``tied``: whether its time has rows of different content.

    ``where("NOT tied")`` leaves the ambiguous keys out; ``tie_counts`` counts them.
    """
    top = df.groupBy(*keys).agg(F.max(order).alias(order))
    at_top = df.join(top, [*keys, order])
    tied = at_top.groupBy(*keys).agg((F.countDistinct(content) > 1).alias("tied"))
    return latest_by(at_top, keys, content).join(tied, keys)


def tie_counts(latest: DataFrame) -> DataFrame:
    """One row: keys with one latest content, and keys left out as ambiguous."""
    return latest.agg(F.count_if(~F.col("tied")).alias("clear"), F.count_if("tied").alias("ambiguous"))


def with_next(df: DataFrame, keys: list[str], order: str, name: str, last: Column) -> DataFrame:
    """The next value of ``order`` in the key, ``last`` for the last row."""
    return df.withColumn(name, F.coalesce(F.lead(order).over(Window.partitionBy(*keys).orderBy(order)), last))


def with_previous(df: DataFrame, keys: list[str], order: list[str], cols: list[str], name: str = "previous") -> DataFrame:
    """The columns of the row before, as a struct; null for the first."""
    return df.withColumn(name, F.lag(F.struct(*cols)).over(Window.partitionBy(*keys).orderBy(*order)))


def forward_fill(df: DataFrame, keys: list[str], order: str, cols: list[str]) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumns({c: F.last(c, ignorenulls=True).over(w) for c in cols})


# ---- joins


def inner_on(df: DataFrame, other: DataFrame, keys: list[str]) -> DataFrame:
    return df.join(other, keys)


def affected(history: DataFrame, batch: DataFrame, key: str) -> DataFrame:
    """History rows of the keys in a batch."""
    return history.join(batch.select(key).distinct(), key, "left_semi")


def absent_keys(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key the other side doesn't have."""
    return left.join(right.select(*keys), keys, "left_anti")


def explode_array(df: DataFrame, array: Column, name: str) -> DataFrame:
    return df.withColumn(name, F.explode(array))


def compare_state(expected: DataFrame, stored: DataFrame, key: str) -> DataFrame:
    """key and state: same, different, missing (only expected) or extra (only stored)."""
    cols = [c for c in expected.columns if c != key]
    a = expected.select(key, F.struct(*cols).alias("_a"))
    b = stored.select(key, F.struct(*cols).alias("_b"))
    same = F.col("_a").eqNullSafe(F.col("_b"))
    state = F.when(F.col("_b").isNull(), "missing").when(F.col("_a").isNull(), "extra").when(same, "same").otherwise("different")
    return a.join(b, key, "full").select(key, state.alias("state"))


def self_pairs(df: DataFrame, key: str, id_col: str, cols: list[str], condition: Column) -> DataFrame:
    """Pairs a < b of one key whose rows meet a condition over a_<col> and b_<col>; for keys with few rows."""
    names = [id_col, *cols]
    a = df.select(key, *(F.col(c).alias(f"a_{c}") for c in names))
    b = df.select(key, *(F.col(c).alias(f"b_{c}") for c in names))
    return a.join(b, key).where((F.col(f"a_{id_col}") < F.col(f"b_{id_col}")) & condition)


def overlap_pairs(periods: DataFrame, key: str = "policy_id", start: str = "cover_start", end: str = "cover_end") -> DataFrame:
    """Different periods of one policy that share a day, each pair once, ordered by (start, end).

    Periods meet by (policy, month), in the first month that both touch, so a
    policy with very many periods isn't paired with itself as a whole.
    """
    df = periods.where(F.col(start) <= F.col(end)).select(key, start, end).distinct()
    df = df.withColumn("month", F.explode(month_keys(start, end))).select(F.struct(key, "month").alias("_k"), F.struct(start, end).alias("_p"))
    a, b = F.col(f"a__p.{start}"), F.col(f"b__p.{start}")
    shares = (a <= F.col(f"b__p.{end}")) & (b <= F.col(f"a__p.{end}")) & (F.col("_k.month") == month_key(F.greatest(a, b)))
    out = self_pairs(df, "_k", "_p", [], shares).withColumn(key, F.col(f"_k.{key}"))
    return out.select(key, *(F.col(f"{s}__p.{c}").alias(f"{s}_{c}") for s in "ab" for c in (start, end)))


def same_start_pairs(periods: DataFrame, key: str = "policy_id", start: str = "cover_start", end: str = "cover_end") -> DataFrame:
    """Starts of a policy with several ends: how many periods, the first and the last end."""
    df = periods.groupBy(key, start).agg(F.countDistinct(end).alias("ends"), F.min(end).alias("first_end"), F.max(end).alias("last_end"))
    return df.where("ends > 1")


def opposite_amounts(claims: DataFrame, same: list[str], amount: str = "amount", id_col: str = "claim_id", also: tuple[str, ...] = ()) -> DataFrame:
    """Negative rows and how many positive rows of the same ``same`` columns have the opposite amount.

    For each column of ``also`` a count ``opposites_same_<column>`` of those that agree in it too (null agrees with null).
    """
    positive = claims.where(F.col(amount) > 0).groupBy(*same, F.col(amount).alias("_opposite")).agg(F.count(F.lit(1)).alias("opposites"))
    negative = claims.where(F.col(amount) < 0).withColumn("_opposite", (-F.col(amount)).cast(claims.schema[amount].dataType))
    df = negative.join(positive, [*same, "_opposite"], "left")
    for c in also:
        name, keys = f"opposites_same_{c}", [f"_k{i}" for i in range(len(same))]
        agree = claims.where(F.col(amount) > 0).groupBy(*(F.col(k).alias(n) for k, n in zip(same, keys)), F.col(amount).alias("_o"), F.struct(c).alias("_c")).agg(F.count(F.lit(1)).alias(name))
        on = [F.col(k) == F.col(n) for k, n in zip(same, keys)] + [F.col("_opposite") == F.col("_o"), F.struct(c).eqNullSafe(F.col("_c"))]
        df = df.join(agree, on, "left").drop(*keys, "_o", "_c").withColumn(name, F.coalesce(name, F.lit(0)))
    return df.select(id_col, *same, amount, F.coalesce("opposites", F.lit(0)).alias("opposites"), *(f"opposites_same_{c}" for c in also))


def missing_refs(fact: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """One row: rows and distinct values of the fact's key that the dimension lacks (null isn't missing)."""
    gone = absent_keys(fact.where(F.col(key).isNotNull()), dim.select(key).distinct(), [key])
    return gone.agg(F.count(F.lit(1)).alias("missing_rows"), F.countDistinct(key).alias("missing_values"))


def inventory_diff(found: DataFrame, expected: DataFrame, keys: list[str]) -> DataFrame:
    """Keys on one side only, with the side."""
    a = found.select(*keys).distinct().withColumn("_found", F.lit(True))
    b = expected.select(*keys).distinct().withColumn("_expected", F.lit(True))
    both = a.join(b, keys, "full").where("_found IS NULL OR _expected IS NULL")
    return both.select(*keys, F.when(F.col("_found").isNull(), "missing").otherwise("unexpected").alias("side"))


# ---- aggregates


def count_distinct_if(value: str, condition: Column) -> Column:
    return F.countDistinct(F.when(condition, F.col(value)))


def single_value(value: Column) -> Column:
    """The value if all non-null values agree, else null; from two aggregates, without a distinct."""
    return F.when(F.min(value) == F.max(value), F.max(value))


def having(df: DataFrame, keys: list[str], **conditions: Column) -> DataFrame:
    """Keys that meet every condition over aggregates, with those aggregates' values as columns."""
    out = df.groupBy(*keys).agg(*(c.alias(n) for n, c in conditions.items()))
    return out.where(reduce(lambda a, b: a & b, (F.col(n) for n in conditions))).select(*keys)


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")


def ambiguous_versions(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys with more than one distinct row, nulls counted as values."""
    return df.groupBy(*keys).agg(F.countDistinct(F.struct(*df.columns)).alias("versions")).where("versions > 1")


def dedup_exact(df: DataFrame) -> DataFrame:
    return df.distinct()


def collect_rows(df: DataFrame, by: list[str], cols: list[str], name: str = "rows") -> DataFrame:
    """The columns of each group's rows as a sorted array; for groups of bounded size, such as a run's jobs or a user's day."""
    return df.groupBy(*by).agg(F.sort_array(F.collect_list(F.struct(*cols))).alias(name))


def content_fingerprint(df: DataFrame) -> DataFrame:
    """Rows and a sum, that doesn't depend on their order, of the first 52 bits of each row's SHA-256.

    A row is its columns as text in the order of their names, each after its
    length (-1 for null), so no two rows are written alike.
    """
    text = lambda c: F.coalesce(F.concat(F.length(F.col(c).cast("string")), F.lit(":"), F.col(c).cast("string")), F.lit("-1:"))
    bits = F.conv(F.substring(F.sha2(F.concat(*map(text, sorted(df.columns))), 256), 1, 13), 16, 10).cast("decimal(38,0)")
    return df.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(bits), F.lit(0)).cast("decimal(38,0)").alias("fingerprint"))


def frequency(df: DataFrame, *cols: str) -> DataFrame:
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias("rows"))


def value_range(df: DataFrame, by: list[str], col: str) -> DataFrame:
    return df.groupBy(*by).agg(F.min(col).alias("least"), F.max(col).alias("greatest"), F.count(col).alias("known"), F.any_value(col).isNotNull().alias("has_any"))


# ---- sorts and sets


def ordered(df: DataFrame, *cols: Column | str) -> DataFrame:
    return df.orderBy(*cols)


def top_k(df: DataFrame, metric: str, k: int, *ties: str) -> DataFrame:
    """The k largest, nulls last, equal ones by ``ties``."""
    return df.orderBy(F.col(metric).desc_nulls_last(), *ties).limit(k)


def union_all(*dfs: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def table_diff(a: DataFrame, b: DataFrame) -> DataFrame:
    """One row: rows of each side, and rows that only one of them has, repeats counted."""
    cols = a.columns
    both = a.select(*cols, F.lit(1).alias("_side")).unionByName(b.select(*cols, F.lit(-1).alias("_side")))
    per_row = both.groupBy(*cols).agg(F.sum("_side").alias("_more"), F.sum(F.when(F.col("_side") == 1, 1).otherwise(0)).alias("_a"), F.sum(F.when(F.col("_side") == -1, 1).otherwise(0)).alias("_b"))
    zero = F.lit(0)
    return per_row.agg(
        F.coalesce(F.sum("_a"), zero).alias("rows_a"), F.coalesce(F.sum("_b"), zero).alias("rows_b"),
        F.coalesce(F.sum(F.greatest("_more", zero)), zero).alias("only_a"), F.coalesce(F.sum(F.greatest(-F.col("_more"), zero)), zero).alias("only_b"),
    )


def distinct_on(df: DataFrame, *cols: str) -> DataFrame:
    return df.select(*cols).distinct()
