"""Near duplicates by SimHash, linked by binary-trie self-joins.

A pair of 64-bit fingerprints that differ in at most two bits agrees on one of
three blocks of bits.  So there are three tries, each with another block as the
leading bits; a pair meets in a trie under one node at the depth of that block.
Those subtrees are dealt over the executors and joined with themselves: pairs of
nodes are traversed together, differing bits add up, and a pair of nodes is left
as soon as it has more than two or all its leaves are connected already.  A
subtree with very many leaves is dealt further as pairs of deeper nodes whose
prefixes differ in at most two bits, which again loses no pair.

Equal fingerprints are one leaf, and a subtree gives links of a spanning forest
(at most one per leaf), so a family of copies never yields all its pairs.

Defined cases: a null or wordless text has fingerprint zero and is linked like
any other; a null id never names a component that has another id; repeated rows
each get a row; an empty table gives no rows; other columns aren't read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import HOT_SHARE, materialize, read_table, text_or_empty
from .components import components

MAX_BITS = 2
SHINGLE = 3
#: First bit (from the top) and width of each block.
BLOCKS = ((0, 22), (22, 21), (43, 21))
#: Leaves under one node from which it is dealt as pairs of deeper nodes.
DEAL_OVER = 20_000
MAX_DEAL_BITS = 16
LEAF_PAIRS = 64
CHUNK = 1 << 18


def shingle_hashes(text: str | None, size: int) -> np.ndarray:
    """XXH64 of every run of ``size`` words, repeats included; of all words if there are fewer."""
    from xxhash import xxh64_intdigest

    words = (text or "").encode().lower().split()  # bytes: only A-Z, and the six ASCII white-space characters
    if not words:
        return np.empty(0, "<u8")
    n = max(1, len(words) - size + 1)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))[:n].tolist()
    return np.array([xxh64_intdigest(joined[a:b], 42) for a, b in zip(starts, ends[len(words) - n :].tolist())], dtype="<u8")


def fingerprint(text: str | None) -> int:
    hashes = shingle_hashes(text, SHINGLE)
    n, ones = len(hashes), np.zeros(64, np.int64)
    for i in range(0, n, 8192):
        ones += np.unpackbits(hashes[i : i + 8192].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fp (the fingerprint's 64 bits as a long), text_hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.fromiter((fingerprint(t.as_py()) for t in b.column(2)), np.uint64, b.num_rows).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp), b.column(1)], names=["doc_id", "fp", "text_hash"])

    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_or_empty(text_col)).alias("text_hash"), text_or_empty(text_col).alias("text"))
    return texts.mapInArrow(run, "doc_id long, fp long, text_hash long")


def trie_rows(fps: DataFrame) -> DataFrame:
    """A row for each distinct fingerprint and subtree that it belongs to.

    trie: the number of the leading block; node: that block's bits; mask and low:
    which pair of deeper nodes (mask 0: a node with itself); side: which of them.
    """
    rows = []
    for k, (first, width) in enumerate(BLOCKS):
        lead = F.shiftrightunsigned("fp", 64 - first - width).bitwiseAND((1 << width) - 1)
        rows.append(F.struct(F.lit(k).alias("trie"), lead.alias("node"), F.shiftrightunsigned(_turned(first, width), 64 - MAX_DEAL_BITS).alias("deeper")))
    spread = fps.select("fp", F.explode(F.array(*rows)).alias("t")).select("fp", "t.*")
    big = spread.groupBy("trie", "node").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > DEAL_OVER)
    bits = F.least(F.ceil(F.log2(F.col("_n") / DEAL_OVER)) + 4, F.lit(MAX_DEAL_BITS))
    spread = spread.join(big.select("trie", "node", bits.cast("int").alias("bits")), ["trie", "node"], "left").fillna(0, ["bits"])
    masks = [m for m in range(1 << MAX_DEAL_BITS) if m.bit_count() <= MAX_BITS]
    pairs = spread.withColumn("deep", F.expr(f"shiftrightunsigned(deeper, {MAX_DEAL_BITS} - bits)"))
    pairs = pairs.withColumn("mask", F.explode(F.expr(f"filter(array({','.join(map(str, masks))}), m -> m < shiftleft(1, bits))")))
    other = F.col("deep").bitwiseXOR(F.col("mask"))
    return pairs.select("trie", "node", "mask", F.least("deep", other).alias("low"), (F.col("deep") > other).alias("side"), "fp")


def _turned(first: int, width: int):
    """The fingerprint turned so that the bits after the block lead, the block last."""
    s = (first + width) % 64
    if s == 0:
        return F.col("fp")
    return F.shiftleft("fp", s).bitwiseOR(F.shiftrightunsigned("fp", 64 - s))


class _Forest:
    """Which leaves are connected, with label 0..n-1 the smallest leaf."""

    def __init__(self, n: int):
        self.label = np.arange(n)
        self.count()

    def count(self) -> None:
        self.changes = np.concatenate(([0], np.cumsum(self.label[1:] != self.label[:-1])))

    def link(self, i: np.ndarray, j: np.ndarray) -> None:
        label = self.label
        while True:
            a, b = label[i], label[j]
            if (a == b).all():
                break
            np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
            while (nxt := label[label]).tobytes() != label.tobytes():
                label = nxt
        self.label = label
        self.count()

    def joined(self, alo, ahi, blo, bhi) -> np.ndarray:
        """Whether all leaves of both ranges are in one component."""
        c = self.changes
        return (c[ahi - 1] == c[alo]) & (c[bhi - 1] == c[blo]) & (self.label[alo] == self.label[blo])


def trie_join(keys: np.ndarray, roots: list[np.ndarray], depth: int) -> np.ndarray:
    """Labels of the leaves after linking all pairs that differ in at most MAX_BITS bits."""
    forest = _Forest(len(keys))
    walk(keys, roots, depth, MAX_BITS, forest)
    return forest.label


def walk(keys: np.ndarray, roots: list[np.ndarray], depth: int, max_bits: int, sink) -> None:
    """Pairs of leaves that differ in at most ``max_bits`` bits go to ``sink.link``, unless ``sink.joined`` says not to look.

    ``keys``: unsigned, with the subtree's own bits leading, ascending within
    each root; ``roots``: alo, ahi, blo, bhi of the node pairs to start with.
    The pairs of one depth are worked off in chunks, the deepest first, so the
    frontier stays small and near leaves are linked before far nodes are met.
    """
    ones: dict[int, np.ndarray] = {}
    stack = [(depth, np.stack([*roots, np.zeros(len(roots[0]), np.int64)]))]
    while stack:
        d, pairs = stack.pop()
        if pairs.shape[1] > CHUNK:
            stack.append((d, pairs[:, CHUNK:]))
            pairs = pairs[:, :CHUNK]
        alo, ahi, blo, bhi, err = pairs
        same = (alo == blo) & (ahi == bhi)
        live = ~sink.joined(alo, ahi, blo, bhi) & ~(same & (ahi - alo < 2))
        pairs = pairs[:, live]
        alo, ahi, blo, bhi, err = pairs
        leaf = ((ahi - alo) * (bhi - blo) <= LEAF_PAIRS) | (d == 64)
        if leaf.any():
            a0, a1, b0, b1, _ = pairs[:, leaf]
            na, nb = a1 - a0, b1 - b0
            size = na * nb
            at = np.repeat(np.cumsum(size) - size, size)
            k = np.arange(len(at)) - at
            nb = np.repeat(nb, size)
            i, j = np.repeat(a0, size) + k // nb, np.repeat(b0, size) + k % nb
            near = np.bitwise_count(keys[i] ^ keys[j]) <= max_bits
            sink.link(i[near], j[near])
            pairs = pairs[:, ~leaf]
        if not pairs.shape[1]:
            continue
        if d not in ones:
            ones[d] = np.concatenate(([0], np.cumsum((keys >> np.uint64(63 - d)) & np.uint64(1)).astype(np.int64)))
        alo, ahi, blo, bhi, err = pairs
        amid, bmid = ahi - (ones[d][ahi] - ones[d][alo]), bhi - (ones[d][bhi] - ones[d][blo])
        cross = ~((alo == blo) & (ahi == bhi))
        new = [(alo, amid, bmid, bhi, err + 1), (amid, ahi, blo, bmid, np.where(cross, err + 1, max_bits + 1)), (alo, amid, blo, bmid, err), (amid, ahi, bmid, bhi, err)]
        new = np.concatenate([np.stack(x) for x in new], axis=1)
        keep = (new[0] < new[1]) & (new[2] < new[3]) & (new[4] <= max_bits)
        if keep.any():
            stack.append((d + 1, new[:, keep]))


def _link_subtrees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of trie_rows in order, subtrees whole, to links (u, v) of each subtree's spanning forest."""

    def links(t: pa.Table) -> pa.RecordBatch:
        trie, fp = t.column("trie").to_numpy(), t.column("fp").to_numpy()
        group, side = t.column("group").to_numpy(), t.column("side").to_numpy(zero_copy_only=False)
        out: list[tuple[np.ndarray, np.ndarray]] = []
        for k, (first, width) in enumerate(BLOCKS):
            rows = np.flatnonzero(trie == k)
            if not len(rows):
                continue
            bits = fp[rows].view(np.uint64)
            turned = (bits << np.uint64(first)) | (bits >> np.uint64(64 - first)) if first else bits
            order = np.lexsort((turned, side[rows], group[rows]))
            turned, g, s = turned[order], group[rows][order], side[rows][order]
            fresh = np.flatnonzero(np.concatenate(([True], g[1:] != g[:-1])))
            lo, hi = fresh, np.append(fresh[1:], len(g))
            mid = lo + np.add.reduceat(~s, fresh)  # rows of side 0 come first
            mask = t.column("mask").to_numpy()[rows][order][lo]
            own = mask == 0
            roots = [lo, np.where(own, hi, mid), np.where(own, lo, mid), hi]
            use = (roots[0] < roots[1]) & (roots[2] < roots[3])
            label = trie_join(turned, [r[use] for r in roots], width)
            low = np.flatnonzero(label != np.arange(len(label)))
            here = fp[rows][order]
            out.append((here[low], here[label[low]]))
        u, v = (np.concatenate([x[i] for x in out]) if out else np.empty(0, np.int64) for i in (0, 1))
        return pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])

    held: list[pa.RecordBatch] = []
    size = 0
    for b in batches:
        held.append(b)
        size += b.num_rows
        if size >= CHUNK:
            t = pa.Table.from_batches(held)
            group = t.column("group").to_numpy()
            cut = int(np.flatnonzero(group != group[-1])[-1]) + 1 if group[0] != group[-1] else 0
            if cut:
                yield links(t.slice(0, cut))
            held, size = t.slice(cut).to_batches(), len(group) - cut
    if held:
        yield links(pa.Table.from_batches(held))


def link_fingerprints(fps: DataFrame) -> DataFrame:
    """Links (u, v) between distinct fingerprints, enough to connect every component."""
    rows = trie_rows(fps.select("fp").distinct())
    group = F.xxhash64("trie", "node", "mask", "low")
    rows = rows.select("trie", "mask", "side", "fp", group.alias("group"), "node", "low").repartition("trie", "node", "mask", "low")
    rows = rows.sortWithinPartitions("trie", "node", "mask", "low").select("trie", "mask", "side", "fp", "group")
    return rows.mapInArrow(_link_subtrees, "u long, v long")


def name_components(marked: DataFrame, leaves: DataFrame, key: str, links: DataFrame) -> DataFrame:
    """``marked`` (doc_id, ``key`` and more) with component_id, the smallest doc_id of the component.

    ``leaves``: a row for each key with its smallest doc_id in ``first`` and its
    rows in ``n``; ``links``: u, v of linked keys.
    """
    roots = components(materialize(links, "links"))
    named = leaves.join(roots.withColumnRenamed("node", key), key, "left").withColumn("root", F.coalesce("root", key))
    named = materialize(named, "rooted")
    least = named.groupBy("root").agg(F.min("first").alias("component_id"), F.count(F.lit(1)).alias("leaves"))
    shared = named.join(least, "root").where("n > 1 OR leaves > 1").select(key, "component_id", "n")
    shared = materialize(shared, "components")
    # Keys with more than 1/HOT_SHARE of the rows are fewer than HOT_SHARE: a bounded broadcast.
    bound = max(marked.count() // HOT_SHARE, 1000)
    hot = F.broadcast(shared.where(F.col("n") > bound).select(key, "component_id"))
    cold = shared.where(F.col("n") <= bound).select(key, "component_id")
    rest = marked.join(hot.select(key), key, "left_anti").join(cold.hint("merge"), key, "left")
    rest = rest.withColumn("component_id", F.coalesce("component_id", "doc_id"))
    return marked.join(hot, key).unionByName(rest).select(*marked.columns, "component_id")


def cluster(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, fp, text_hash, component_id."""
    marked = materialize(fingerprints(docs), "fingerprints")
    leaves = materialize(marked.groupBy("fp").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n")), "leaves")
    return name_components(marked, leaves, "fp", link_fingerprints(leaves))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster(read_table(spark, sf_dir, "documents")).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
