"""Whitening of embeddings by Golub-Kahan-Lanczos bidiagonalisation.

The centred rows Y are never made into a table: a block holds integers, and a
task subtracts the exact mean from them.  A step takes one pass over the blocks
that does both products, p = Y z for the next left vector and Yᵀp for the next
right one.  Left vectors have as many entries as there are rows, so they aren't
stored: every one lies in the span of Y's columns, u = Y w, and a pass makes
them again from the short vectors w.  The pass also gives the inner products
of p with all left vectors before it; as all is linear, they are taken out of z,
Yᵀp and the norm on the driver, and the pass is repeated if they weren't small.
Right vectors are short and are reorthogonalised in full on the driver, twice.
The singular values and right vectors of the small bidiagonal matrix give
deviations and components.

As many steps as dimensions are made, with a new random direction where a
recurrence ends, so equal and zero eigenvalues are found too.  What reaches the
driver is a few arrays of the vectors' length, never anything by row.

Defined cases: vectors as in ``kept_vectors``; null and repeated ids each keep
their rows; components without variance (to rounding) can't be scaled and
are left out, so fewer than two different vectors give no rows; so does an empty
table; a deviation that no long can hold is null; other columns aren't read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialize, read_table
from .vectors import add_up, kept_vectors, to_blocks, unpacked

SCALE = 64
COMPONENTS = 32
SEED = 7
#: A variance below this share of the largest is rounding.
NO_VARIANCE = 1e-13
OUT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


class Centred:
    """Rows of blocks minus the mean of all, and sums over them."""

    def __init__(self, blocks: DataFrame, d: int):
        self.blocks, self.d = blocks, d
        count_and_sums = add_up(blocks.mapInArrow(self._per_task(lambda x: np.append(x.sum(axis=0), len(x)), np.int64), "v array<long>"), "v")
        *self.sums, self.n = count_and_sums or [0] * (d + 1)
        whole, rest = zip(*(divmod(s, self.n) for s in self.sums)) if self.n else ((), ())
        #: The mean of a dimension is whole + rest / n, and part is that fraction.
        self.whole, self.rest, self.part = np.array(whole, np.int64), np.array(rest, np.int64), np.array([r / self.n for r in rest])

    def _per_task(self, f: Callable[[np.ndarray], np.ndarray], kind: type) -> Callable:
        """A task's sum of ``f`` over its blocks, as one row."""
        d = self.d

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = None
            for b in batches:
                for rows, x in zip(b.column(b.schema.get_field_index("rows")).to_pylist(), b.column(b.schema.get_field_index("x"))):
                    v = f(unpacked(x.as_py(), rows, d))
                    total = v if total is None else total + v
            if total is not None:
                yield pa.RecordBatch.from_arrays([pa.array([total.astype(kind)])], names=["v"])

        return run

    def total(self, f: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
        """Sum over all centred blocks of ``f`` of one."""
        whole, part = self.whole, self.part
        task = self._per_task(lambda x: f((x - whole) - part), np.float64)
        return np.array(add_up(self.blocks.select("rows", "x").mapInArrow(task, "v array<double>"), "v"))


def bidiagonalise(data: Centred, steps: int, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """V (orthonormal columns) and the upper bidiagonal B with Y V = U B."""
    d, rng = data.d, np.random.default_rng(seed)
    V, W, H = np.zeros((d, 0)), np.zeros((d, 0)), np.zeros((d, 0))
    B = np.zeros((steps, steps))
    largest = 0.0

    def outside(r: np.ndarray, basis: np.ndarray) -> np.ndarray:
        for _ in range(2):
            r = r - basis @ (basis.T @ r)
        return r

    def fresh() -> np.ndarray:
        r = outside(rng.standard_normal(d), V)
        return r / np.linalg.norm(r)

    v, beta = fresh(), 0.0
    for k in range(steps):
        V = np.column_stack([V, v])
        z = v - beta * W[:, -1] if k else v
        while True:
            p = data.total(lambda y, z=z: (lambda p: np.concatenate([[p @ p], (y @ W).T @ p, y.T @ p]))(y @ z))
            square, inner, h = p[0], p[1 : k + 1], p[k + 1 :]
            z, h, rest = z - W @ inner, h - H @ inner, square - inner @ inner
            if inner @ inner <= 1e-8 * square or rest <= NO_VARIANCE * largest:
                break
        alpha = np.sqrt(max(rest, 0.0))
        largest = max(largest, rest)
        if alpha <= np.sqrt(NO_VARIANCE * largest):  # nothing new on the left
            alpha, z, h = 0.0, np.zeros(d), np.zeros(d)
        else:
            z, h = z / alpha, h / alpha
        W, H = np.column_stack([W, z]), np.column_stack([H, h])
        B[k, k] = alpha
        if k + 1 == steps:
            break
        r = outside(h - alpha * v, V)
        beta = np.linalg.norm(r)
        if beta <= np.sqrt(NO_VARIANCE * largest):
            v, beta = fresh(), 0.0
        else:
            v = r / beta
        B[k, k + 1] = beta
    return V, B


def whiten(df: DataFrame, components: int = COMPONENTS, scale: int = SCALE) -> DataFrame:
    """A row for each usable vector and component; see the module's text for what is left out."""
    spark = df.sparkSession
    vectors, d = kept_vectors(df, "vec_id")
    if not d:
        return spark.createDataFrame([], OUT)
    data = Centred(materialize(to_blocks(vectors, d, scale, "vec_id long"), "whitening-blocks"), d)
    if data.n < 2:
        return spark.createDataFrame([], OUT)
    V, B = bidiagonalise(data, d)
    _, deviations, right = np.linalg.svd(B)
    use = int((deviations[:components] ** 2 > NO_VARIANCE * deviations[0] ** 2).sum())
    if not use:
        return spark.createDataFrame([], OUT)
    axes = np.linalg.qr(V @ right.T[:, :use])[0]
    variances = deviations[:use] ** 2 / data.n
    project = axes / np.sqrt(variances)
    k, n = use, data.n
    found = data.total(lambda y: (lambda w: np.concatenate([[(y * y).sum()], w.sum(axis=0), (w.T @ w).ravel()]))(y @ project))
    means = found[1 : k + 1] / n
    identity_error = float(np.abs(found[k + 1 :].reshape(k, k) / n - np.outer(means, means) - np.eye(k)).max())
    explained = variances / (found[0] / n)
    whole, part, rest = data.whole, data.part, data.rest

    def square_deviations(x: np.ndarray) -> list[int | None]:
        y = x - whole
        most = n * (int(np.abs(y).max(initial=0)) + 1)
        if most * most * d >= 1 << 63:
            y = y.astype(object)  # Python's integers
        exact = ((y * n - rest) ** 2).sum(axis=1).tolist()
        return [v if v < 1 << 63 else None for v in exact]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for ids, size, packed in zip(b.column(0), b.column(1).to_pylist(), b.column(2)):
                x = unpacked(packed.as_py(), size, d)
                whitened = ((x - whole) - part) @ project
                at = pa.array(np.repeat(np.arange(size), k))
                columns = [ids.values.take(at), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), size)), pa.array(np.full(size * k, n))]
                columns += [pa.array(square_deviations(x), pa.int64()).take(at), pa.array(whitened.ravel()), pa.array(np.tile(explained, size)), pa.array(np.full(size * k, identity_error))]
                yield pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in OUT.split(", ")])

    return data.blocks.mapInArrow(rows, OUT)


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(read_table(spark, sf_dir, "embeddings"))
