"""Harmonic packing of token sequences.

A piece of length n belongs to class k = floor(capacity / n), and every bin of
class k takes k pieces, so a bin is full by count and no search is made.  Long
documents are cut into whole sequences first; what remains is cut at the
reciprocals capacity // k while it is long, so most pieces fill their class's
bins exactly, and the short end goes to its own class.  Each task keeps one open
bin per class and works alone: no shuffle, memory bounded by the classes.  At a
task's end the pieces of its open bins are packed one after another, cut where a
sequence is full, so a task leaves one padded sequence at most.

Defined cases: a null text is empty and has one piece, the end id; repeated rows
are packed each; an empty table has no pieces; other columns aren't read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import _encoder, default_path
from .common import read_table, text_or_empty

CAPACITY = 1024
END_ID = 0
#: Ends of up to so many tokens aren't cut further.
SHORTEST_CUT = 64
#: Sequence ids of a task start at its number times this.
TASK_SEQUENCES = 1 << 40

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
ARROW = pa.schema([(n, pa.int64()) for n in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")])


def cuts(n: int, capacity: int = CAPACITY, shortest: int = SHORTEST_CUT) -> list[int]:
    """Lengths into which a document of ``n`` tokens is cut."""
    out = [capacity] * (n // capacity)
    n %= capacity
    while n > shortest:
        k = -(-capacity // (n + 1))  # the smallest k with capacity // k <= n
        while capacity // k > n:
            k += 1
        out.append(capacity // k)
        n -= capacity // k
    return [*out, n] if n else out


class Packer:
    """Packs the pieces of one task; each finished bin comes out as rows (piece, offset) with its number."""

    def __init__(self, first_sequence: int, capacity: int = CAPACITY):
        self.next, self.capacity = first_sequence, capacity
        self.open: dict[int, list[tuple]] = {}

    def _close(self, pieces: list[tuple]) -> Iterator[tuple]:
        offset = 0
        for p in pieces:
            yield (p, self.next, offset)
            offset += p[2]
        self.next += 1

    def add(self, piece: tuple) -> Iterator[tuple]:
        """``piece``: (doc, start, length, ids)."""
        k = self.capacity // piece[2]
        bin_ = self.open.setdefault(k, [])
        bin_.append(piece)
        if len(bin_) == k:
            del self.open[k]
            yield from self._close(bin_)

    def finish(self) -> Iterator[tuple]:
        """The open bins' pieces, one after another."""
        left, room = [], self.capacity
        for k in sorted(self.open):
            for doc, start, length, ids in self.open[k]:
                while length:
                    n = min(length, room)
                    left.append((doc, start, n, ids[:n]))
                    start, length, ids, room = start + n, length - n, ids[n:], room - n
                    if not room:
                        yield from self._close(left)
                        left, room = [], self.capacity
        if left:
            yield from self._close(left)
        self.open = {}


def pack(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """One row per piece: PIECES and, if asked for, its ids (array of int)."""
    schema = PIECES + (", ids array<int>" if with_ids else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoder = _encoder(path, None)
        packer = Packer(TaskContext.get().partitionId() * TASK_SEQUENCES, capacity)
        rows: list[tuple] = []

        def out() -> pa.RecordBatch:
            cols = [[p[0][0], p[1], p[2], zlib.crc32(p[3].tobytes()), p[0][1], s, o] for p, s, o in rows]
            arrays = [pa.array(c, pa.int64()) for c in zip(*cols)]
            names = ARROW.names
            if with_ids:
                arrays, names = [*arrays, pa.array([p[3].astype(np.int32) for p, _, _ in rows], pa.list_(pa.int32()))], [*names, "ids"]
            rows.clear()
            return pa.RecordBatch.from_arrays(arrays, names=names)

        for b in batches:
            for doc_id, ids in zip(b.column(0).to_pylist(), encoder.encode_column(b.column(1))):
                ids = np.append(ids, end_id).astype("<u4")
                start, doc = 0, (doc_id, len(ids))
                for n in cuts(len(ids), capacity):
                    rows.extend(packer.add((doc, start, n, ids[start : start + n])))
                    start += n
                if len(rows) > 20_000:
                    yield out()
        rows.extend(packer.finish())
        if rows:
            yield out()

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    return texts.mapInArrow(run, schema)


def pack_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the remaining documents as packed pieces."""
    return pack(docs, default_path())


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(read_table(spark, sf_dir, "documents"), default_path())
