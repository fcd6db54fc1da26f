"""Vector codes and whitening against plain numpy, and their defined cases."""

from __future__ import annotations

import hashlib

import numpy as np
import pytest

INF, NAN = float("inf"), float("nan")


def table(spark, rows):
    from pyspark.sql import functions as F

    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    return df.withColumns({c: F.lit("x") for c in ("vec", "rows", "x", "codes", "n", "error")})


def write(tmp_path, df):
    df.write.parquet(f"{tmp_path}/embeddings.parquet")
    return str(tmp_path)


def odd_rows(length, rng):
    """Nulls in every column, unusable vectors, repeated rows, ties and vectors of another length."""
    rows = [(int(i), rng.integers(-3, 4, length) / 4, int(i) % 3) for i in rng.permutation(60)]
    rows += rows[:3] + [(None, rows[5][1], None), (None, rows[6][1], 1), (7, rows[9][1], 2), (200, rows[0][1] + 50.0, 0)]
    rows = [(i, [float(c) for c in v], k) for i, v, k in rows]
    bad = [(-1, None, 1), (-2, [], 1), (-3, [0.5] * (length + 1), 0)]
    bad += [(-4 - k, [x] + [0.0] * (length - 1), 0) for k, x in enumerate((None, NAN, INF, -INF))]
    return rows, bad


def kmeans(rows):
    order = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    x = np.array([np.floor(4096 * np.array(r[1])) for r in order]).astype(np.int64).reshape(len(rows), 8, -1)
    book = x[:16].transpose(1, 0, 2).copy()
    for k in range(7):
        distance = ((x[:, :, None, :] - book[None]) ** 2).sum(axis=3)
        codes = distance.argmin(axis=2)
        if k < 6:
            for p in range(8):
                for e in range(book.shape[1]):
                    if (codes[:, p] == e).any():
                        book[p, e] = x[codes[:, p] == e, p].sum(axis=0) // (codes[:, p] == e).sum()
    error = distance.min(axis=2).sum(axis=1).tolist()
    of_label = {}
    for r, v in zip(order, error):
        of_label[r[2]] = of_label.get(r[2], 0) + v
    digest = hashlib.sha256(",".join(map(str, book.ravel().tolist())).encode()).hexdigest()
    return [(r[0], "".join(f"{c:02x}" for c in row), v, of_label[r[2]], digest) for r, row, v in zip(order, codes.tolist(), error)]


key = lambda r: (r[0] is None, r[0] or 0, *r[1:])


@pytest.mark.parametrize("length", [8, 24])
def test_codes_equal_comparing_all_entries(spark, tmp_path, length):
    from tidemark.llm.registry import QUERIES

    rows, bad = odd_rows(length, np.random.default_rng(length))
    got = QUERIES["op11_vector_codes"](spark, write(tmp_path, table(spark, rows + bad)))
    assert sorted(map(tuple, got.collect()), key=key) == sorted(kmeans(rows), key=key)


def test_codes_of_few_or_uneven_vectors(spark):
    from tidemark.llm.vector_codes import encode

    few = [(i, [float(i)] * 8, None) for i in range(3)]
    coded, book = encode(table(spark, few))
    assert book.shape == (8, 3, 1) and sorted((r.vec_id, r.code, r.error) for r in coded.collect()) == [(i, f"0{i}" * 8, 0) for i in range(3)]
    coded, book = encode(table(spark, [(i, [float(i)] * 11, None) for i in range(3)]))
    assert book.shape == (8, 3, 2) and coded.count() == 3
    coded, book = encode(table(spark, []))
    assert coded.count() == 0 and book.size == 0


def test_rings_leave_out_only_what_cant_be_nearest():
    from tidemark.llm.vector_codes import Codebooks

    rng = np.random.default_rng(1)
    for spread in (3, 40):
        x, book = rng.integers(-spread, spread, (500, 3)), rng.integers(-spread, spread, (1, 16, 3))
        book[0, 9] = book[0, 4]
        start = rng.integers(0, 16, 500)
        reach = np.zeros((1, 16))
        np.maximum.at(reach[0], start, np.sqrt(((x - book[0, start]) ** 2).sum(axis=1)))
        codes, errors = Codebooks(book, reach).assign(0, x, start)
        distance = ((x[:, None] - book[0][None]) ** 2).sum(axis=2)
        assert (codes == distance.argmin(axis=1)).all() and (errors == distance.min(axis=1)).all()


def whitened(rows, most=32):
    x = np.array([np.floor(64 * np.array(r[1])) for r in rows]) + 1_000_000
    n, y = len(x), x - x.mean(axis=0)
    e, axes = np.linalg.eigh(y.T @ y / n)
    e, axes = e[::-1], axes[:, ::-1]
    k = min(most, int((e > 1e-11 * e[0]).sum()))
    return (y @ axes[:, :k]) / np.sqrt(e[:k]), e[:k] / e.sum(), ((n * x.astype(np.int64) - x.sum(axis=0).astype(np.int64)) ** 2).sum(axis=1), n


@pytest.mark.parametrize("length", [5, 40])
def test_whitening_equals_eigenvectors(spark, tmp_path, length):
    from tidemark.llm.registry import QUERIES

    rng = np.random.default_rng(length)
    rows, bad = odd_rows(length, rng)
    rows = [(i, [c * (1 + k) for k, c in enumerate(v)], label) for i, v, label in rows]
    rows = [(i, v[:-1] + [2.0 * v[0]], label) for i, v, label in rows]  # a dimension that is no new one
    got = QUERIES["op12_whitening"](spark, write(tmp_path, table(spark, rows + bad))).collect()
    want, explained, deviation, n = whitened(rows)
    k = want.shape[1]
    assert len(got) == k * n and {r.n for r in got} == {n} and max(r.identity_error for r in got) < 1e-9
    assert k == min(32, length - 1)
    for c in range(k):
        mine = [r for r in got if r.component == c + 1]
        assert abs(mine[0].explained / explained[c] - 1) < 1e-9
        values = sorted((r.vec_id is None, r.vec_id or 0, r.deviation, r.whitened) for r in mine)
        sign = 1 if c == 0 and sum(v[3] * w for v, w in zip(values, want[:, c])) > 0 else -1
        others = [sorted((r[0] is None, r[0] or 0, int(d), s * w) for r, d, w in zip(rows, deviation, want[:, c])) for s in (sign, -sign)]
        assert any(all(a[:3] == b[:3] and abs(a[3] - b[3]) < 1e-7 for a, b in zip(values, o)) for o in others), c


def test_equal_variances_constant_and_empty(spark):
    """Eigenvalues of multiplicity three are all found; without variance there is no component."""
    from tidemark.llm.whitening import whiten

    corners = [(k, [float(s) if j == i else 0.0 for j in range(3)], 0) for k, (i, s) in enumerate((i, s) for i in range(3) for s in (-1, 1))]
    got = whiten(table(spark, corners)).collect()
    assert len(got) == 18 and max(r.identity_error for r in got) < 1e-12 and all(abs(r.explained - 1 / 3) < 1e-12 for r in got)
    assert whiten(table(spark, [(k, [1.0, 2.0], 0) for k in range(5)])).count() == 0
    assert whiten(table(spark, corners[:1])).count() == 0
    assert whiten(table(spark, [])).count() == 0


def test_deviations_are_exact_beyond_doubles(spark):
    from tidemark.llm.whitening import whiten

    rows = [(k, [float(v)], 0) for k, v in enumerate((0, 1, 30_000_000))]
    got = {r.vec_id: r.deviation for r in whiten(table(spark, rows)).collect()}
    x = [64 * r[1][0] + 1_000_000 for r in rows]
    want = {k: (3 * int(v) - int(sum(x))) ** 2 for k, v in enumerate(x)}
    assert got == {k: v if v < 1 << 63 else None for k, v in want.items()} and None in got.values()
