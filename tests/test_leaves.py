"""Leaves of JSON texts and kinds of their values, against Python's own reading."""

from __future__ import annotations

import json
import random

import pytest

from tidemark.functions.leaves import _scan, json_leaves, register_leaves, scalars


def generated(rng, depth):
    kind = rng.randrange(9) if depth else rng.randrange(6)
    if kind < 6:
        return [None, True, rng.randrange(-9, 10**12), rng.random() * 1e9, rng.choice(["", "C:\\", 'a"b', "}{][,:", "ñ\u2028\t", "\\\\", "{not json", "null"]), False][kind]
    members = [generated(rng, depth - 1) for _ in range(rng.randrange(4))]
    return members if kind == 6 else {rng.choice(["a", "b.c", 'k"', "{", "\\", "ü"]) + str(i): m for i, m in enumerate(members)}


def expected(value):
    """By recursion."""
    if isinstance(value, dict):
        return [(f".{k}{p}", v) for k, m in value.items() for p, v in expected(m)]
    if isinstance(value, list):
        return [("[]" + p, v) for m in value for p, v in expected(m)]
    return [("", None if value is None else value if isinstance(value, str) else json.dumps(value))]


def cases():
    rng = random.Random(4)
    return [v for v in (generated(rng, rng.randrange(1, 7)) for _ in range(600)) if isinstance(v, dict | list)]


def test_scalars_equal_recursion():
    for v in cases():
        for text in (json.dumps(v), json.dumps(v, ensure_ascii=False, indent=2)):
            assert scalars(text) == [(p.removeprefix("."), x) for p, x in expected(v)] == list(_scan(text))


def test_depth_is_no_limit():
    for depth in (50, 3000, 100_000):
        text = '{"a":[' * depth + '"\\\\"' + "]}" * depth
        assert [v for _, v in scalars(text)] == ["\\"]
        assert scalars(text)[0][0].count("a") == depth


def test_no_json_has_no_leaves():
    bad = [None, "", "5", '"x"', "{", '{"a"}', '{"a":1,}', "[1 2]", '{"a":1}}', "[1]x", "{1:2}", '{"a":tru}', "[1,]", '["a\\"]', "{]", "[}"]
    for text in bad:
        assert scalars(text) == [], text
        if text and text not in ("5", '"x"'):
            with pytest.raises(ValueError):
                list(_scan(text))
    assert scalars('{"a":1,"a":[2,{}],"n":NaN,"e":[]}') == [("a", "1"), ("a[]", "2"), ("n", "NaN")]


def test_leaves_of_a_table_and_in_sql(spark):
    rows = [(i, json.dumps(v)) for i, v in enumerate(cases()[:80])] + [(None, None), (900, "no json"), (901, '{"a":"C:\\\\","b":{"c":{"d":1}}}')]
    df = spark.createDataFrame(rows, "id long, payload string")
    want = sorted(((i, p, v) for i, t in rows for p, v in scalars(t)), key=str)
    assert sorted(map(tuple, json_leaves(df, "payload", ["id"]).collect()), key=str) == want
    assert (901, "b.c.d", "1") in want
    register_leaves(spark)
    df.createOrReplaceTempView("payloads")
    sql = spark.sql("SELECT t.id, l.path, l.value FROM payloads t, LATERAL json_leaves(t.payload) l")
    assert sorted(map(tuple, sql.collect()), key=str) == want


def test_kinds_and_classes(spark):
    from pyspark.sql import functions as F

    from tidemark.functions.variants import kind_of, members, scalar_class, shape_of

    payload = '{"a":5,"b":{"a":"x","z":[1,2.5]},"c":"{not json","d":[{"q":null}],"e":true,"f":null,"g":123456789012345678901234567890,"h":"C:\\\\"}'
    df = spark.createDataFrame([(1, payload), (2, "[1]"), (3, None), (4, "no json"), (5, "{}")], "id long, payload string")
    got = {(r.id, r.field): r.kind for r in members(df, "payload", ["id"]).select("id", "field", kind_of(F.col("value")).alias("kind")).collect()}
    assert got == {(1, k): v for k, v in {"a": "number", "b": "object", "c": "string", "d": "array", "e": "boolean", "f": "null", "g": "number", "h": "string"}.items()}
    ways = {
        "12": "number", "1e3": "number", '"12."': "number_text", '"-1.5e3"': "number_text", '"1,234"': "separators", '"1.234.567"': "separators", '"1 234,5"': "separators", '"1,2,3"': "text",
        '"1.2.3"': "text", '""': "empty", '"\\t "': "text", "null": "null", "true": "boolean", "[1]": "nested", '{"__non_finite_number__":"NaN"}': "marker", '"-inf"': "marker", '"abc"': "text",
    }
    rows = spark.createDataFrame([(f'{{"v":{w}}}', c) for w, c in ways.items()] + [("{}", "absent")], "p string, want string")
    for r in rows.select("p", "want", scalar_class(F.try_variant_get(F.parse_json("p"), "$.v", "variant")).alias("got")).collect():
        assert r.got == r.want, r
    assert df.where("id = 1").select(shape_of(F.parse_json("payload"))).first()[0].startswith("OBJECT<a: NUMBER, b: OBJECT<a: STRING, z: ARRAY<NUMBER>>, c: STRING")
