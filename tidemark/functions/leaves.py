"""Every scalar of JSON texts with its path, over Arrow batches, and as a table function for SQL.

A text is read by Python's parser, and by a scanner with a stack of its own where it may be
deeper than that goes, so depth is no limit and nothing is counted
before; strings are read as JSON reads them, whatever braces, quotes and
backslashes they hold.  A text that isn't a JSON object or array has no leaves.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator
from functools import lru_cache
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_TOKEN = re.compile(
    r"""[ \t\n\r]*(?:(?P<mark>[{}\[\],:])|(?P<string>"(?:[^"\\]|\\.)*")|(?P<word>-?\d[\d.eE+-]*|true|false|null|NaN|-?Infinity))""",
    re.S,
)
_REST = re.compile(r"[ \t\n\r]*\Z")


def share_code(spark: SparkSession) -> None:
    """Let Python workers import this package where it isn't installed but reachable."""
    env, root = spark.sparkContext.environment, str(Path(__file__).resolve().parents[2])
    if root not in env.get("PYTHONPATH", "").split(":"):
        env["PYTHONPATH"] = ":".join(filter(None, [env.get("PYTHONPATH"), root]))


def _tokens(text: str) -> Iterator[tuple[str, str]]:
    at = 0
    while not _REST.match(text, at):
        m = _TOKEN.match(text, at)
        if not m:
            raise ValueError(f"no JSON at {at}")
        at = m.end()
        yield m.lastgroup, m[m.lastgroup]


#: Brackets in a text up to which Python's parser reads it.
RECURSED = 500


class _Object(list):
    """An object's (key, value) pairs, repeated keys included."""


_LOADER = json.JSONDecoder(object_pairs_hook=_Object, parse_int=str, parse_float=str, parse_constant=str, strict=False)


def scalars(text: str | None) -> list[tuple[str, str | None]]:
    """(path, value) of every scalar: keys joined by dots, items of arrays as ``[]``; null has no value, the others are text."""
    text = text or ""
    try:
        # Python's parser recurses; what may be deeper than that allows goes to the scanner.
        return _walk(_LOADER.decode(text)) if text.count("{") + text.count("[") <= RECURSED else list(_scan(text))
    except ValueError:
        return []


def _walk(value) -> list[tuple[str, str | None]]:
    found: list[tuple[str, str | None]] = []

    def members(value: list, path: str, dot: str) -> None:
        keyed, start = isinstance(value, _Object), path + dot
        for member in value:
            at, v = (start + member[0], member[1]) if keyed else (path + "[]", member)
            if isinstance(v, list):
                members(v, at, ".")
            else:
                found.append((at, ("false", "true")[v] if isinstance(v, bool) else v))

    if isinstance(value, list):
        members(value, "", "")
    return found


#: What means the same to Python and to Spark (the end apart, see below): plain characters, escaped signs, simple classes, groups, repeats.
_COMMON = re.compile(r"(?:\(\?i\))?(?:[A-Za-z0-9_ ,:;=@/\-]|\\[.\[\](){}*+?|^$\\]|\[[A-Za-z0-9_-]+\]|[.|)]|[\^$](?![*+?{])|\((?!\?)|[*+?](?![*+?])|\{\d+(?:,\d*)?\}(?![*+?]))*")
_ESCAPED_OR_END = re.compile(r"\\.|\$", re.S)
#: Where ``$`` is to Spark: at the end, or before a last line break of any kind.
_END = r"(?=(?:\r\n|[\n\r\x85\u2028\u2029])?\Z)"


def can_match(pattern: str) -> Callable[[str], bool]:
    """Whether Spark's ``rlike`` may find the pattern in a text: never no where it does, and yes to all if the pattern may mean something else in Python."""
    if not _COMMON.fullmatch(pattern):
        return lambda text: True
    found = re.compile(_ESCAPED_OR_END.sub(lambda m: _END if m[0] == "$" else m[0], pattern), re.S).search
    return lambda text: found(text) is not None


def _scan(text: str) -> Iterator[tuple[str, str | None]]:
    open_: list[str] = []  # what closes the open objects and arrays
    steps: list[str] = []  # where the scanner is in each of them
    wanted = "value"  # or key, colon, more (a comma or the end), end
    for kind, token in _tokens(text):
        if wanted == "end":
            raise ValueError("text after the end")
        if kind == "mark" and token in "}]":
            if not open_ or open_[-1] != token or wanted not in ("more", "key or end", "value or end"):
                raise ValueError(f"{token} where {wanted} is expected")
            open_.pop()
            steps.pop()
            wanted = "more" if open_ else "end"
        elif wanted.startswith("key"):
            if kind != "string":
                raise ValueError("a key is expected")
            steps[-1], wanted = "." + json.loads(token, strict=False), "colon"
        elif wanted in ("colon", "more"):
            if kind != "mark" or token != (":" if wanted == "colon" else ","):
                raise ValueError(f"{token} where {wanted} is expected")
            wanted = "key" if wanted == "more" and open_[-1] == "}" else "value"
        elif kind == "mark":
            if token not in "{[":
                raise ValueError("a value is expected")
            open_.append("}" if token == "{" else "]")
            steps.append("" if token == "{" else "[]")
            wanted = "key or end" if token == "{" else "value or end"
        else:
            if not open_:
                return  # one scalar, no object
            if kind == "word" and token not in ("true", "false", "null", "NaN", "Infinity", "-Infinity"):
                json.loads(token)
            yield "".join(steps).removeprefix("."), json.loads(token, strict=False) if kind == "string" else None if token == "null" else token
            wanted = "more"
    if wanted != "end":
        raise ValueError("the end is missing")


def json_leaves(df: DataFrame, payload: str, keep: list[str], screen: tuple[str, str] | None = None) -> DataFrame:
    """``keep`` with (path, value) of every scalar of ``payload``: one pass over Arrow batches, whatever the depth.

    ``screen``: patterns of paths and values; most leaves without a match of both are left out, none with.
    """
    share_code(df.sparkSession)
    out = pa.schema([("path", pa.string()), ("value", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if screen:
            path_fits, value_fits = (lru_cache(10_000)(can_match(s)) for s in screen)
        for b in batches:
            found = [scalars(t) for t in b.column(len(keep)).to_pylist()]
            if screen:
                found = [[leaf for leaf in leaves if path_fits(leaf[0]) and leaf[1] is not None and value_fits(leaf[1])] for leaves in found]
            of = pa.array([i for i, leaves in enumerate(found) for _ in leaves], pa.int64())
            paths, values = (pa.array([leaf[k] for leaves in found for leaf in leaves], pa.string()) for k in (0, 1))
            kept = [b.column(k).take(of) for k in range(len(keep))]
            yield pa.RecordBatch.from_arrays([*kept, paths, values], names=[*keep, *out.names])

    rows = df.select(*keep, F.col(payload).alias("_payload"))
    schema = T.StructType([*rows.schema.fields[:-1], T.StructField("path", T.StringType()), T.StructField("value", T.StringType())])
    return rows.mapInArrow(run, schema)


class _Leaves:
    def eval(self, payload: str):
        yield from scalars(payload)


def register_leaves(spark: SparkSession, name: str = "json_leaves") -> None:
    """The same as a table function for SQL: ``SELECT t.id, l.* FROM t, LATERAL json_leaves(t.payload) l``.

    It is called row by row, so the batches of ``json_leaves`` are the way for large tables.
    """
    share_code(spark)
    spark.udtf.register(name, F.udtf(_Leaves, returnType="path string, value string", useArrow=False))
