"""Operators along an order against brute force, with keys that hold most of the rows."""

from __future__ import annotations

import datetime as dt
import random

import pytest


def test_previous_in_order(spark):
    from tidemark.operators.ranges import with_previous_in_order

    rng = random.Random(1)
    rows = [(k, n, rng.choice([None, n, -n])) for k in ("a", "b", None) for n in rng.sample(range(-300, 3000), 200)]
    df = spark.createDataFrame(rows, "k string, n long, v long")
    for stretch in (1, 7, 10_000):
        got = {(r.k, r.n): r.previous and (r.previous.n, r.previous.v) for r in with_previous_in_order(df.where("k IS NOT NULL"), ["k"], "n", ["v"], stretch=stretch).collect()}
        want = {}
        for k in ("a", "b"):
            mine = sorted((n, v) for x, n, v in rows if x == k)
            want |= {(k, n): before for (n, _), before in zip(mine, [None, *mine])}
        assert got == want


def test_no_window_holds_a_resource(spark):
    """A resource of many pages: the windows' partitions are stretches, and the one over a resource has a row for each of them."""
    from pyspark.sql import functions as F

    from tidemark.sources.pages import audit_pages

    pages = spark.range(60_000).select(F.lit("r").alias("resource"), F.col("id").alias("page_number"), (F.col("id") * 10 + F.when(F.col("id") >= 30_000, 5).otherwise(0)).alias("request_offset"), F.lit(10).cast("long").alias("rows_received"))
    null = F.lit(None).cast("string")
    pages = pages.withColumns({"limit": F.lit(10), "total": F.lit(1), "request_cursor": null, "next_cursor": null, "has_more": F.lit(None).cast("boolean")})
    found = audit_pages(pages)
    assert [tuple(r) for r in found.collect()] == [("r", 30_000, "offset_jump")]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line]
    assert windows and all("_part" in w for w in windows)


@pytest.mark.parametrize("seed", range(3))
def test_overlap_counts(spark, seed):
    from tidemark.operators.ranges import overlap_counts
    from tidemark.operators.relational import overlap_pairs

    rng, day = random.Random(seed), dt.date(2020, 1, 1)
    rows = []
    for k in range(30):
        for _ in range(rng.randrange(1, 15)):
            s = day + dt.timedelta(rng.randrange(60))
            rows.append((k, s, s + dt.timedelta(rng.randrange(-1, 25))))
    df = spark.createDataFrame(rows + rows[:20], "policy_id long, cover_start date, cover_end date")
    got = {r.policy_id: (r.periods, r.overlapping_pairs) for r in overlap_counts(df).collect()}
    pairs = {}
    for r in overlap_pairs(df).collect():
        pairs[r.policy_id] = pairs.get(r.policy_id, 0) + 1
    valid = {k: len({(s, e) for x, s, e in rows if x == k and s <= e}) for k in range(30)}
    assert got == {k: (n, pairs.get(k, 0)) for k, n in valid.items() if n}


def test_overlaps_of_a_policy_of_very_many_periods(spark):
    from pyspark.sql import functions as F

    from tidemark.operators.ranges import overlap_counts

    n = 100_000
    periods = spark.range(n).select(F.lit(1).alias("policy_id"), F.date_add(F.lit("2000-01-01").cast("date"), (F.col("id") % 1000).cast("int")).alias("cover_start"), F.col("id").alias("id"))
    periods = periods.withColumn("cover_end", F.date_add("cover_start", (F.col("id") / 1000).cast("int")))
    r = overlap_counts(periods).first()
    ends = [(s, s + k) for s in range(1000) for k in range(100)]
    closed = [0] * 1200
    for _, e in ends:
        closed[e + 1] += 1
    total, apart = 0, 0
    for s in range(1000):
        total += closed[s]
        apart += total * 100
    assert (r.periods, r.overlapping_pairs) == (n, n * (n - 1) // 2 - apart)


@pytest.mark.parametrize(("unit", "slices"), [("hour", 4), ("day", 1), ("month", 16)])
def test_asof_last_known(spark, unit, slices):
    """Values by the minute, nine facts in ten of one key; gaps over stretches, equal times, nulls, times before the first value."""
    from pyspark.sql import functions as F

    from tidemark.operators.ranges import asof_last_known

    rng, start = random.Random(2), dt.datetime(2021, 3, 1)
    values = [("a", start + dt.timedelta(minutes=rng.randrange(40_000)), rng.random()) for _ in range(400)]
    values += [("b", start + dt.timedelta(days=3 * k), float(k)) for k in range(6)] + [("a", values[0][1], 2.0), ("a", None, 9.0), ("a", values[1][1], None), (None, start, 1.0)]
    facts = [(i, rng.choice("aaaaaaaaab") if i % 50 else rng.choice(["USD", "none", None]), start + dt.timedelta(minutes=rng.randrange(-3000, 90_000))) for i in range(1500)]
    facts += [(2000 + i, k, t) for i, (k, t, _) in enumerate(values[:50])] + [(3000, "a", None), (3001, "a", start)] * 2
    f = spark.createDataFrame(facts, "id long, k string, at timestamp")
    v = spark.createDataFrame(values, "k string, at timestamp, x double")
    got = asof_last_known(f, v, ["k"], "at", "x", "known", unit=unit, slices=slices, bypass=F.col("k") == "USD")
    assert got.columns == ["id", "k", "at", "known"]

    def known(k, at):
        before = [(t, x) for kk, t, x in values if kk == k and k is not None and at is not None and t is not None and x is not None and t <= at]
        return max(before)[1] if before and k != "USD" else None

    want = sorted(((i, k, at, known(k, at)) for i, k, at in facts), key=str)
    assert sorted(map(tuple, got.where("k IS NOT NULL").collect()), key=str) == [w for w in want if w[1] is not None]
    assert got.count() == len(facts)


def test_asof_equals_the_join_with_intervals(spark):
    from pyspark.sql import functions as F

    from tidemark.operators.fx import asof_rate
    from tidemark.operators.ranges import asof_last_known

    rng, day = random.Random(3), dt.date(2020, 1, 1)
    fx = spark.createDataFrame([(c, day + dt.timedelta(n), rng.choice([-1, 1, 2, 3])) for c in ("ARS", "BRL") for n in rng.sample(range(900), 120)], "currency string, rate_date date, f long").selectExpr("currency", "rate_date", "CAST(f AS DECIMAL(18,9)) AS factor_usd")
    facts = spark.createDataFrame([(i, rng.choice(["ARS", "BRL", "USD", "XXX"]), day + dt.timedelta(rng.randrange(-50, 1500))) for i in range(1000)], "id long, currency string, day date")
    a = asof_rate(facts, fx, "day", "currency").select("id", F.col("rate").cast("double"))
    rates = fx.where("factor_usd > 0").select("currency", F.col("rate_date").alias("day"), "factor_usd")
    b = asof_last_known(facts, rates, ["currency"], "day", "factor_usd", "rate", "month", bypass=F.col("currency") == "USD").select("id", F.when(F.col("currency") == "USD", 1.0).otherwise(F.col("rate").cast("double")))
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_find_differences(spark):
    from pyspark.sql import functions as F

    from tidemark.operators.checks import ChecksFailed, assert_equal
    from tidemark.operators.ranges import find_differences

    a = spark.range(200_000).select(F.col("id").alias("k"), F.when(F.col("id") % 7 == 0, F.lit(None)).otherwise(F.col("id") * 3).alias("x"), F.when(F.col("id") % 5 == 0, F.lit(None)).otherwise(F.lit("t")).alias("y"))
    assert find_differences(a, a, ["k"]).count() == 0
    assert_equal(a, a.repartition(3), ["k"])
    b = a.withColumn("x", F.when(F.col("k") == 77_777, F.lit(1)).otherwise(F.col("x"))).unionByName(a.where("k = 5"))
    assert sorted(map(tuple, find_differences(a, b, ["k"]).collect()), key=str) == sorted([(77_777, None, "t", "a", 1), (77_777, 1, "t", "b", 1), (5, 15, None, "b", 1)], key=str)
    swapped = spark.createDataFrame([(1, None, "t")], "k long, x string, y string")
    assert find_differences(swapped, swapped.selectExpr("k", "y AS x", "x AS y"), ["k"]).count() == 2
    with pytest.raises(ChecksFailed, match="77777"):
        assert_equal(a, b.where("k <> 5").unionByName(a.where("k = 5")), ["k"])
    # The rows that are compared are filtered by both levels' buckets before they are shuffled.
    plan = find_differences(a, b, ["k"])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Filter") >= 2 and "pmod" in plan
