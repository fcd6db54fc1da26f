"""Helpers shared by the corpus operators."""

from __future__ import annotations

import tempfile
import uuid
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words are runs of anything but the six ASCII white-space characters.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"

#: A key is hot if it holds more than 1/HOT_SHARE of the rows, so there are
#: fewer than HOT_SHARE hot keys whatever the input's size.
HOT_SHARE = 200


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def share_code(spark: SparkSession) -> None:
    """Let Python workers import this package where it isn't installed but reachable."""
    env, root = spark.sparkContext.environment, str(Path(__file__).resolve().parents[2])
    if root not in env.get("PYTHONPATH", "").split(":"):
        env["PYTHONPATH"] = ":".join(filter(None, [env.get("PYTHONPATH"), root]))


def work_root(spark: SparkSession) -> str:
    """The shared folder for written intermediate tables: ``spark.checkpoint.dir``.

    Only where the session names none (local tests) a temporary folder is set.
    """
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not root:
        root = "file://" + tempfile.mkdtemp(prefix="tidemark-")
        sc.setCheckpointDir(root)
    return root


def fresh_dir(spark: SparkSession, label: str) -> str:
    return f"{work_root(spark).rstrip('/')}/tidemark/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and return the table as read back.

    The result does not depend on the executors that made it.
    """
    spark = df.sparkSession
    path = fresh_dir(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def without_rows(docs: DataFrame, gone: DataFrame, digest: Column) -> DataFrame:
    """``docs`` without the rows that ``gone`` names by id and digest of the text.

    ``gone``: two columns; ``digest``: how the second is made from a row of
    ``docs``.  Its columns get names that no column of ``docs`` has, whatever
    those are called; all columns of ``docs`` pass through.  A null id is an id
    like any other here.
    """
    taken = {c.lower() for c in docs.columns}
    names = [next(n for i in range(len(taken) + 1) if (n := f"{base}_{i}") not in taken) for base in ("gone_id", "gone_digest")]
    gone = gone.toDF(*names).distinct()
    same = F.col("doc_id").eqNullSafe(F.col(names[0])) & (digest == F.col(names[1]))
    return docs.join(gone, same, "left_anti")


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def words_of(name: str) -> Column:
    """The words of a text column, natively; empty for a text without any."""
    return F.array_remove(F.split(F.col(name), r"[\x20\x09-\x0D]+", -1), "")


def join_grouped(left: DataFrame, groups: DataFrame, key: str, size: str, rows: int) -> DataFrame:
    """``left`` inner-joined to one row per key, whatever share a key holds.

    ``groups`` has one row per key with the number of ``left`` rows in ``size``.
    Keys with more than ``rows / HOT_SHARE`` rows number under HOT_SHARE, so
    those go by broadcast; the rest go by a shuffled join in which no key has
    more rows than that.
    """
    bound = max(rows // HOT_SHARE, 1000)
    hot = F.broadcast(groups.where(F.col(size) > bound))
    cold = groups.where(F.col(size) <= bound)
    in_hot = left.join(hot, key)
    in_cold = left.join(hot.select(key), key, "left_anti").join(cold.hint("merge"), key)
    return in_hot.unionByName(in_cold)


#: Bars of the histogram of counts in a doubling of the count, and of the hashes of keys that tie.
OCTAVE = 64
TIE_BARS = 4096


def most_frequent(df: DataFrame, count: str, key: str, limit: int) -> DataFrame:
    """The ``limit`` rows of the largest counts (all, if there are fewer), with no more than those to gather.

    Ties are broken by a hash of ``key``, then by the key.  The place where the
    limit falls is narrowed down by histograms: of the counts' logarithms, of
    the counts in the bar that crosses the limit, and of hashes among rows of
    the count that crosses it.  Only the last bar's rows are sorted.
    """

    def cross(rows: DataFrame, bar: Column, left: int, descending: bool) -> tuple[object, int]:
        """The bar that crosses the limit (None: all fit) and how many of its rows still fit."""
        bars = rows.groupBy(bar.alias("bar")).agg(F.count(F.lit(1)).alias("n")).collect()
        for r in sorted(bars, key=lambda r: r["bar"], reverse=descending):
            if r["n"] > left:
                return r["bar"], left
            left -= r["n"]
        return None, left

    if limit <= 0:
        return df.where(F.lit(False))
    octave, tie = F.floor(F.log2(count) * OCTAVE), F.pmod(F.xxhash64(key), F.lit(TIE_BARS))
    edge, left = cross(df, octave, limit, True)
    if edge is None:
        return df
    value, left = cross(df.where(octave == edge), F.col(count), left, True)
    ties = df.where(F.col(count) == value)
    bar, left = cross(ties, tie, left, False)
    above = df.where((F.col(count) > value) | ((F.col(count) == value) & (tie < bar)))
    return above.unionByName(ties.where(tie == bar).orderBy(F.xxhash64(key), key).limit(left)) if left else above
