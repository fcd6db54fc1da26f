"""Token counts kept up to date by signed deltas.

Texts are read once, for a narrow table with each document's counts under every
tokenizer version.  A batch of changes is reduced to one delta row per (source,
lang, tokenizer): an insert adds a document's counts, a delete takes them off, a
revision takes off the counts of one version and adds those of another.  The
store holds the deltas of each batch in a folder named after the batch, written
in one commit, so writing a batch again replaces it by itself and never counts
twice.  Totals are sums of deltas, hence the order of batches doesn't matter;
``compact`` folds batches into one base to keep reads short, and still knows
their ids.  A compaction folds the batches that it sees at its start, so others may
be committed meanwhile.  A batch id has one writer at a time, as has ``compact``.

Defined cases: a null text has no tokens; null source or language form a group
of their own; repeated rows count each time; an empty batch commits a folder
without rows; other columns aren't read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import _encoder, default_path
from .common import fresh_dir, materialize, read_table, text_or_empty

KEYS = ["source", "lang", "tokenizer"]
MEASURES = ["n_docs", "n_tokens", "n_chars"]
SCHEMA = "source string, lang string, tokenizer string, n_docs long, n_tokens long, n_chars long"
#: Tokenizer versions: runs of anything but the six ASCII white-space characters, and byte-level BPE of the given file.
WORDS, BPE = "words-1", "byte-bpe-50k"
COUNTS = f"source string, lang string, n_chars long, `{WORDS}` long, `{BPE}` long"


def count_documents(docs: DataFrame, path: str) -> DataFrame:
    """source, lang, n_chars and a count per tokenizer version, in one pass over the texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(path, None)
        for b in batches:
            text = b.column(2)
            chars, words = zip(*((len(t), len(t.encode().split())) for t in text.to_pylist())) if b.num_rows else ((), ())
            ids = [len(x) for x in encoder.encode_column(text)] if b.num_rows else []
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *(pa.array(c, pa.int64()) for c in (chars, words, ids))], names=["source", "lang", "n_chars", WORDS, BPE])

    texts = docs.select(F.col("source").cast("string").alias("source"), F.col("lang").cast("string").alias("lang"), text_or_empty().alias("text"))
    return texts.mapInArrow(run, COUNTS)


def _signed(counts: DataFrame, tokenizer: str, sign: int) -> DataFrame:
    return counts.select(
        "source", "lang", F.lit(tokenizer).alias("tokenizer"), F.lit(sign).cast("long").alias("n_docs"),
        (sign * F.col(f"`{tokenizer}`")).alias("n_tokens"), (sign * F.col("n_chars")).alias("n_chars"),
    )


def inserts(counts: DataFrame, tokenizer: str) -> DataFrame:
    return _signed(counts, tokenizer, 1)


def deletes(counts: DataFrame, tokenizer: str) -> DataFrame:
    return _signed(counts, tokenizer, -1)


def revisions(counts: DataFrame, old: str, new: str) -> DataFrame:
    """The same documents, counted by another tokenizer version from now on."""
    return deletes(counts, old).unionByName(inserts(counts, new))


class Rollup:
    """Totals by source, language and tokenizer version under ``path``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def _committed(self, kind: str) -> list[str]:
        """What stands behind ``kind=`` in the names of folders whose write ended, as marked by Spark's committer."""
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path
        fs = path(self.path).getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not fs.exists(path(self.path)):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(path(self.path))]
        return sorted(n[len(kind) + 1 :] for n in names if n.startswith(f"{kind}=") and fs.exists(path(f"{self.path}/{n}/_SUCCESS")))

    def _write(self, rows: DataFrame, name: str) -> None:
        rows.write.mode("overwrite").option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "true").parquet(f"{self.path}/{name}")

    def _state(self) -> tuple[str | None, set[str], list[str]]:
        """The last base, the batches folded into it, and the batches that aren't."""
        bases = self._committed("folded")  # written after the base's deltas
        base = bases[-1] if bases else None
        folded = {r["batch"] for r in self.spark.read.schema("batch string").parquet(f"{self.path}/folded={base}").collect()} if base else set()
        return base, folded, [i for i in self._committed("batch") if i not in folded]

    def committed(self) -> list[str]:
        """Ids of the batches that count."""
        _, folded, rest = self._state()
        return sorted(folded.union(rest))

    def commit(self, batch_id: str, changes: DataFrame) -> bool:
        """Add a batch of signed counts; False if it is in already."""
        if not re.fullmatch(r"[\w.-]+", batch_id):
            raise ValueError(f"batch id {batch_id!r}: letters, digits, dot, dash and underscore only")
        if batch_id in self.committed():
            return False
        delta = changes.groupBy(*KEYS).agg(*(F.sum(c).alias(c) for c in MEASURES))
        self._write(delta.where(" OR ".join(f"{c} <> 0" for c in MEASURES)), f"batch={batch_id}")
        return True

    def compact(self) -> None:
        """Fold all batches into a new base.  Totals stay; the folders of folded batches and older bases aren't read any more."""
        state = self._state()
        base, folded, rest = state
        if not rest:
            return
        name = f"{int(base or 0) + 1:08d}"
        self._write(self._totals(state).where(" OR ".join(f"{c} <> 0" for c in MEASURES)), f"base={name}")
        self._write(self.spark.createDataFrame([(i,) for i in sorted(folded.union(rest))], "batch string").coalesce(1), f"folded={name}")

    def _totals(self, state: tuple[str | None, set[str], list[str]]) -> DataFrame:
        base, _, rest = state
        folders = [f"base={base}"] * (base is not None) + [f"batch={i}" for i in rest]
        if not folders:
            return self.spark.createDataFrame([], SCHEMA)
        deltas = self.spark.read.schema(SCHEMA).parquet(*(f"{self.path}/{n}" for n in folders))
        return deltas.groupBy(*KEYS).agg(*(F.sum(c).alias(c) for c in MEASURES))

    def totals(self) -> DataFrame:
        """Current totals; groups without documents left are not shown."""
        return self._totals(self._state()).where("n_docs <> 0")


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents enter by words; those that aren't English are then revised
    to BPE; texts under five words are deleted, and enter again after the store
    is compacted; one batch is replayed.  The totals are over all documents."""
    counts = materialize(count_documents(read_table(spark, sf_dir, "documents"), default_path()), "document-counts")
    english = F.coalesce(F.col("lang") == "en", F.lit(False))
    short = counts.where(F.col(f"`{WORDS}`") < 5)
    versions = [(english, WORDS), (~english, BPE)]
    both = lambda change: reduce(DataFrame.unionByName, (change(short.where(rows), version) for rows, version in versions))
    store = Rollup(spark, fresh_dir(spark, "token-counts"))
    store.commit("load", inserts(counts, WORDS))
    store.commit("bpe", revisions(counts.where(~english), WORDS, BPE))
    store.commit("short", both(deletes))
    store.compact()
    store.commit("restore", both(inserts))
    store.commit("load", inserts(counts, WORDS))
    return store.totals()
