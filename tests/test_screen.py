from __future__ import annotations

from pyspark.sql import functions as F


def test_screened_leaves_are_left_out_where_they_are_found(spark):
    """No leaf that the patterns rule out comes from the workers, and what comes out is what the screen of all leaves gives."""
    from tidemark.operators.profile import json_leaves, leaf_screen, screened_leaves

    texts = ['{"currency":"ARS","a":{"currency":"BRL","n":1.50,"t":true}}', '{"currency":"USD","b":["ARS",null]}', '{"currency":null,"moneda":"ARS"}', "no JSON", None, '{"x.currency":"ARS\\r\\n","y":"BRL"}']
    df = spark.createDataFrame(list(enumerate(texts)), "id long, payload string")
    patterns = r"currency$", r"^(ARS|BRL)$"
    got = json_leaves(df, "payload", ["id"], patterns)
    want = leaf_screen(json_leaves(df, "payload", ["id"]), *patterns, ["id"])
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) == [(0, "a.currency", "BRL"), (0, "currency", "ARS"), (5, "x.currency", "ARS\r\n")]
    assert sorted(map(tuple, screened_leaves(df, "payload", *patterns, ["id"]).collect())) == sorted(map(tuple, want.collect()))


def test_can_match_never_says_no_where_spark_finds_the_pattern(spark):
    from tidemark.functions.leaves import can_match

    texts = ["ARS", "ARS\n", "ARS\r\n", "ARS\r", "ARS\u0085", "ARS ", "xARS", "ARSx", "", "a.z", "z", "a$", "a\nb", "a\rb", "MONEDA", "Moneda_x", "İ", "K", "k", "٣", "7", "A-B", "a]b", "\\", "ß", "é"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for pattern in (r"^(ARS|BRL)$", r"(^|\.)z$", r"7$", r"(?i)(currency|moneda)", r"^[A-Z]{3}$", r"a\$", r"a.b", r"^$", r"\d", r"\w+", r"(?i)k", r"(?i)ı|i", r"[a-z&&[k]]", r"\Qa.z\E", r"\p{L}", r"a\b", r"[^a-z]$", r"(?i)[^k]", r"^\\$", r"x*+", r"$*"):
        fits = can_match(pattern)
        found = [r.t for r in df.where(F.col("t").rlike(pattern)).collect()]
        assert [t for t in found if not fits(t)] == [], pattern
    assert not can_match(r"currency$")("amount.value") and can_match(r"\p{L}")("1")
