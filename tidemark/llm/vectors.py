"""Embedding tables as blocks: rows of one written table that hold a matrix of many vectors each."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Components in a block at most, so a block's matrix takes some 16 MB as longs whatever the length of the vectors.
BLOCK = 1 << 21
#: Scaled components are held as integers below this magnitude.
MOST = 1 << 40


def kept_vectors(df: DataFrame, *others: str) -> tuple[DataFrame, int]:
    """``others`` and the column vec (doubles) of the rows whose vector is usable, and the vectors' length.

    A vector that is null or holds null or non-finite components is left out;
    so is one whose length isn't that of most of the others (of equal numbers, the longer).
    """
    fit = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    kept = df.select(*others, F.col("embedding").cast("array<double>").alias("vec")).where(F.col("vec").isNotNull() & fit)
    length = kept.groupBy(F.size("vec").alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
    d = length["d"] if length else 0
    return kept.where(F.size("vec") == d), d


def floor_scaled(m: np.ndarray, scale: int, most: int = MOST) -> np.ndarray:
    """floor(scale * m) as longs, which must be below ``most`` in magnitude."""
    scaled = np.floor(m * float(scale))
    if scaled.size and np.abs(scaled).max() >= most:
        raise ValueError(f"a component times {scale} reaches {most}, beyond exact arithmetic in longs")
    return scaled.astype(np.int64)


def packed(x: np.ndarray) -> bytes:
    """Longs as bytes of the narrowest of three widths that holds them all."""
    most = np.abs(x).max() if x.size else 0
    return x.astype("<i2" if most < 1 << 15 else "<i4" if most < 1 << 31 else "<i8").tobytes()


def unpacked(data: bytes, rows: int, d: int) -> np.ndarray:
    """The ``rows`` times ``d`` longs of ``packed``."""
    return np.frombuffer(data, f"<i{len(data) // (rows * d)}").astype(np.int64).reshape(rows, d)


def to_blocks(vectors: DataFrame, d: int, scale: int, others: str, most: int = MOST) -> DataFrame:
    """Blocks of ``vectors`` (columns of ``others``, then vec): each column of ``others`` as an array, rows, x (packed floor(scale * vec))."""
    names = [c.split()[0] for c in others.split(",")]
    kinds = dict(c.split() for c in others.split(","))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            step = max(1, BLOCK // d)
            for i in range(0, whole.num_rows, step):
                b = whole.slice(i, step)
                m = floor_scaled(b.column(len(names)).flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, d), scale, most)
                lists = [pa.ListArray.from_arrays(pa.array([0, b.num_rows], pa.int32()), b.column(k)) for k in range(len(names))]
                yield pa.RecordBatch.from_arrays([*lists, pa.array([b.num_rows], pa.int32()), pa.array([packed(m)], pa.binary())], names=[*names, "rows", "x"])

    cast = vectors.select(*(F.col(c).cast(kinds[c]).alias(c) for c in names), "vec")
    return cast.mapInArrow(run, ", ".join(f"{c} array<{kinds[c]}>" for c in names) + ", rows int, x binary")


def add_up(df: DataFrame, column: str, how=F.sum) -> list:
    """The arrays of ``column`` added up by place (or combined by ``how``); as many values as an array has reach the driver."""
    sums = df.select(F.posexplode(column).alias("place", "value")).groupBy("place").agg(how("value").alias("value")).collect()
    return [r["value"] for r in sorted(sums, key=lambda r: r["place"])]
