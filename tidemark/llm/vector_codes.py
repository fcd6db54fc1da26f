"""Codes of vectors by ball k-means: eight codebooks of sixteen entries in exact integers.

An entry and the parts assigned to it are a ball.  Its radius is the largest
distance of its parts, as the pass before left it, plus the entry's shift since.
Entries farther than two radii can't be nearest for any of the ball's parts, so
the others are its neighbour entries.  A part nearer to its entry than half the way to the
nearest neighbour lies in the stable core and keeps its code; any other
lies in a ring between two half-ways and is compared with just the neighbours up
to its ring.  Half-ways are compared as squares in integers, equality included, so
results and ties are those of comparing all entries.

A round is one pass over blocks of vectors, which writes the blocks with their
new codes and, in columns of their own, each block's sums, counts and radii.  The
next entries come from those narrow columns; the driver gets as many numbers as the
codebooks have.  Only the last two rounds' blocks are kept.

Defined cases: vectors as in ``kept_vectors``; a length that eight doesn't divide
is filled up with zeros; fewer than sixteen vectors make as many entries; null
ids come last and equal ids in order of their vectors when entries start;
repeated rows each get a row; null labels are one label; an empty table gives no rows;
other columns aren't read; a component of 2^26 and more (in magnitude, scaled) is an error,
since distances are longs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fresh_dir, join_grouped, materialize, read_table
from .vectors import add_up, floor_scaled, kept_vectors, packed, to_blocks, unpacked

SCALE = 4096
PARTS = 8
ENTRIES = 16
ROUNDS = 6
LARGEST = 1 << 26
STATE = "vec_id array<long>, label array<string>, rows int, x binary, codes binary, sums array<long>, radii array<long>"
OUT = "vec_id long, label string, code string, error long"


class Codebooks:
    """The entries of every part, and what a task needs to look for nearer ones."""

    def __init__(self, entries: np.ndarray, reach: np.ndarray):
        """``entries``: part, entry, position; ``reach``: no part of the ball is farther from its entry."""
        self.entries = entries
        gaps = entries[:, :, None, :] - entries[:, None, :, :]
        gaps = (gaps * gaps).sum(axis=3)
        #: For each part and entry its neighbour entries by distance, and the squared distances.
        self.near: list[list[tuple[np.ndarray, np.ndarray]]] = []
        for p in range(len(entries)):
            balls = []
            for c in range(entries.shape[1]):
                others = np.array([e for e in np.argsort(gaps[p, c], kind="stable") if e != c and gaps[p, c, e] <= 4.0 * reach[p, c] ** 2], np.int64)
                balls.append((others, gaps[p, c, others]))
            self.near.append(balls)

    def assign(self, p: int, x: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Nearest entries of part ``p`` of all rows, and squared distances, starting from the codes so far."""
        book, new, errors = self.entries[p], codes.copy(), np.zeros(len(x), np.int64)
        for c in np.unique(codes):
            rows = np.flatnonzero(codes == c)
            mine = x[rows]
            own = ((mine - book[c]) ** 2).sum(axis=1)
            near, gap = self.near[p][c]
            ring = np.searchsorted(gap, 4 * own, side="right")  # 0: the stable core
            best, code = own.copy(), np.full(len(rows), c, np.int64)
            for k in range(int(ring.max(initial=0))):
                at, e = np.flatnonzero(ring > k), near[k]
                distance = ((mine[at] - book[e]) ** 2).sum(axis=1)
                better = (distance < best[at]) | ((distance == best[at]) & (e < code[at]))
                best[at[better]], code[at[better]] = distance[better], e
            new[rows], errors[rows] = code, best
        return new, errors


def _assigned(books: Codebooks, d: int):
    """A pass that gives blocks with new codes, sums by part, entry and position (count first) and largest squared distances."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                ids, labels, rows, data, old = (b.column(k)[i] for k in range(5))
                rows = rows.as_py()
                x, codes = unpacked(data.as_py(), rows, d).reshape(rows, PARTS, -1), np.frombuffer(old.as_py(), np.uint8).reshape(rows, PARTS)
                entries, width = books.entries.shape[1:]
                new, errors = np.empty((rows, PARTS), np.int64), np.empty((rows, PARTS), np.int64)
                sums, radii = np.zeros((PARTS, entries, width + 1), np.int64), np.zeros((PARTS, entries), np.int64)
                for p in range(PARTS):
                    new[:, p], errors[:, p] = books.assign(p, x[:, p], codes[:, p].astype(np.int64))
                    np.maximum.at(radii[p], new[:, p], errors[:, p])
                    sums[p, :, 0] = np.bincount(new[:, p], minlength=entries)
                    np.add.at(sums[p, :, 1:], new[:, p], x[:, p])
                lists = [pa.array([v.as_py()], pa.list_(k)) for v, k in ((ids, pa.int64()), (labels, pa.string()))]
                yield pa.RecordBatch.from_arrays(
                    [*lists, pa.array([rows], pa.int32()), pa.array([data.as_py()], pa.binary()), pa.array([new.astype(np.uint8).tobytes()], pa.binary())]
                    + [pa.array([v.ravel()], pa.list_(pa.int64())) for v in (sums, radii)],
                    names=[c.split()[0] for c in STATE.split(", ")],
                )

    return run


def _coded(books: Codebooks, d: int):
    """The last pass: a row for each vector."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                rows = b.column(2)[i].as_py()
                x, old = unpacked(b.column(3)[i].as_py(), rows, d).reshape(rows, PARTS, -1), np.frombuffer(b.column(4)[i].as_py(), np.uint8).reshape(rows, PARTS)
                found = [books.assign(p, x[:, p], old[:, p].astype(np.int64)) for p in range(PARTS)]
                codes = np.stack([c for c, _ in found], axis=1).astype(np.uint8).tobytes().hex()
                error = sum(e for _, e in found)
                text = pa.array([codes[k : k + 2 * PARTS] for k in range(0, len(codes), 2 * PARTS)], pa.string())
                yield pa.RecordBatch.from_arrays([b.column(0)[i].values, b.column(1)[i].values, text, pa.array(error)], names=["vec_id", "label", "code", "error"])

    return run


def _remove(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def encode(df: DataFrame, rounds: int = ROUNDS, entries: int = ENTRIES) -> tuple[DataFrame, np.ndarray]:
    """(vec_id, label as text, code, error) of every usable vector, and the final entries by part, entry and position."""
    spark = df.sparkSession
    vectors, d = kept_vectors(df, "vec_id", "label")
    if not d:
        return spark.createDataFrame([], OUT), np.zeros((PARTS, 0, 0), np.int64)
    if d % PARTS:
        zeros = F.array(*[F.lit(0.0)] * (PARTS - d % PARTS))
        vectors, d = vectors.withColumn("vec", F.concat("vec", zeros)), d + PARTS - d % PARTS
    first = [r["vec"] for r in vectors.orderBy(F.asc_nulls_last("vec_id"), "vec").limit(entries).collect()]
    book = floor_scaled(np.array(first), SCALE, LARGEST).reshape(len(first), PARTS, d // PARTS).transpose(1, 0, 2)
    # All parts start in the ball of entry 0, whose radius isn't known yet.
    blocks = to_blocks(vectors, d, SCALE, "vec_id long,label string", LARGEST).withColumn("codes", F.expr("unhex(repeat('00', rows * %d))" % PARTS))
    reach, before = np.full(book.shape[:2], np.inf), None
    for _ in range(rounds):
        path = fresh_dir(spark, "codes")
        blocks.mapInArrow(_assigned(Codebooks(book, reach), d), STATE).write.parquet(path)
        state = spark.read.schema(STATE).parquet(path)
        sums = np.array(add_up(state, "sums"), np.int64).reshape(PARTS, len(first), -1)
        radii = np.array(add_up(state, "radii", F.max), np.int64).reshape(PARTS, len(first))
        counts = sums[:, :, :1]
        new = np.where(counts > 0, sums[:, :, 1:] // np.maximum(counts, 1), book)
        shift = np.sqrt(((new - book) ** 2).sum(axis=2))
        book, reach = new, (np.sqrt(radii) + shift) * (1 + 1e-9) + 1e-6
        if before:
            _remove(spark, before)
        before, blocks = path, state.select("vec_id", "label", "rows", "x", "codes")
    return blocks.mapInArrow(_coded(Codebooks(book, reach), d), OUT), book


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, book = encode(read_table(spark, sf_dir, "embeddings"))
    coded = materialize(coded.withColumn("label", F.coalesce(F.concat(F.lit("="), "label"), F.lit(""))), "codes")
    labels = materialize(coded.groupBy("label").agg(F.sum("error").alias("label_error"), F.count(F.lit(1)).alias("n")), "label-errors")
    digest = hashlib.sha256(",".join(map(str, book.ravel().tolist())).encode()).hexdigest()
    return join_grouped(coded, labels, "label", "n", coded.count()).select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))


def _sql() -> str:
    """Comparing every part with every entry, round by round."""
    bad = "x IS NULL OR isnan(x) OR isinf(x)"
    steps = [
        f"kept AS MATERIALIZED (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(4096 * x) AS BIGINT)) AS v FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: {bad})) = 0)",
        f"parts AS MATERIALIZED (SELECT vec_id, label, p, v[p * len(v) // {PARTS} + 1 : (p + 1) * len(v) // {PARTS}] AS v FROM kept, range({PARTS}) t(p))",
        f"book0 AS MATERIALIZED (SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e, v FROM parts QUALIFY e < {ENTRIES})",
    ]
    for k in range(ROUNDS + 1):
        distance = "list_sum(list_transform(list_zip(a.v, b.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"
        steps.append(f"near{k} AS MATERIALIZED (SELECT a.vec_id, a.label, a.p, a.v, CAST(min({distance} * {ENTRIES} + b.e) AS BIGINT) AS best FROM parts a JOIN book{k} b USING (p) GROUP BY ALL)")
        if k < ROUNDS:
            steps.append(f"sums{k} AS (SELECT p, best % {ENTRIES} AS e, j, CAST(sum(x) AS BIGINT) AS s, count(*) AS c FROM (SELECT p, best, unnest(v) AS x, generate_subscripts(v, 1) AS j FROM near{k}) GROUP BY ALL)")
            steps.append(f"mean{k} AS (SELECT p, e, list((s - ((s % c) + c) % c) // c ORDER BY j) AS v FROM sums{k} GROUP BY p, e)")
            steps.append(f"book{k + 1} AS MATERIALIZED (SELECT b.p, b.e, coalesce(m.v, b.v) AS v FROM book{k} b LEFT JOIN mean{k} m ON m.p = b.p AND m.e = b.e)")
    steps += [
        f"coded AS (SELECT vec_id, label, string_agg(lpad(lower(hex(best % {ENTRIES})), 2, '0'), '' ORDER BY p) AS code, CAST(sum(best // {ENTRIES}) AS BIGINT) AS error FROM near{ROUNDS} GROUP BY vec_id, label)",
        f"digest AS (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM book{ROUNDS})",
    ]
    return "WITH " + ",\n".join(steps) + "\nSELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256 FROM coded, digest"


OP11_SQL = _sql()
