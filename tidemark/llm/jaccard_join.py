"""Self-join of documents on the Jaccard similarity of their word shingles, by a token-group matrix.

Tokens are 64-bit hashes of a document's different shingles.  Documents of equal
sets are one class, whose key is the set's size and 96 bits of its digest.

The query links from 85 per cent of words of four on; a ``Rule`` says otherwise.

1. Tokens get an order, the rarest first, from a fixed table of hashed counts
   over all documents.  Sets that link share at least ``spare(n)`` of their first
   n - need(n) + spare(n) tokens, so the matrix holds those only; any order is
   right, a good one keeps its columns short (passages that many documents share
   come last and are seldom in it).
2. Classes with enough tokens in common are partitioned into groups of similar ones:
   runs of GROUP_TOKENS tokens or so along an order by the sets' most frequent tokens,
   which copies and the members of a family share.  Groups are opened for their own
   members and for the last of the one before; so are groups by smallest hashes.
   What links then is known to be connected.
3. The token-group matrix has a row for each group and token of its members.
   Classes meet it by token; counted tokens bound the overlap of a class and a
   group, and only tokens of members that aren't connected to the class yet
   count, so a family of copies isn't looked through again.  Of two groups the
   smaller one's classes ask.
4. Groups with enough overlap are opened: a task holds the union of the group's
   tokens, bounds the overlap once more by all tokens, and compares with the
   members by exact counts.  A group that very many classes ask is opened by several tasks.

Links are a spanning choice (one for each connected part of a group), never all
pairs; star contraction makes them components.

Defined cases: a null or wordless text has no shingles and links with nothing, not
even with its like; with fewer than four words the whole sequence is the one
shingle; a null id never names a component that has another id; repeated rows each get a
row; an empty table gives no rows; other columns aren't read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial, reduce
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import materialize, read_table, text_or_empty
from .components import components
from .simhash import name_components, shingle_hashes

#: Hashed counts that order the tokens: 4 MB on every executor, whatever the input; kept as RANGES rows while they are added up.
SLOTS, RANGES = 1 << 22, 64
#: Tokens in a group from which another one starts: some 8 MB in a task with their owners, and the longest document more.
GROUP_TOKENS = 1 << 19
#: Classes that one task compares with a group.
QUERIES = 2048
#: The orders' columns: the two most frequent tokens, the two smallest hashes.
ORDERS = [("m0", "l0"), ("m1", "l1")]
#: Bits that tell which ids have sets to be made: 4 MB on every executor; when they fill up, more sets are made than are used.
ID_BITS = 1 << 25
MARKS = "doc_id long, text_hash long, n_shingles long, key binary, " + "".join(f"{m} long, {l} long, " for m, l in ORDERS) + "prefix array<long>"


@dataclass(frozen=True)
class Rule:
    """Which documents link: words in a shingle, and the similarity in per cent from which they do."""

    shingle: int = 4
    percent: int = 85

    def tokens(self, text: str | None) -> np.ndarray:
        return np.unique(shingle_hashes(text, self.shingle))

    def need(self, n: int) -> int:
        """Tokens that a set of ``n`` has in common with any that it links with."""
        return (self.percent * n + 99) // 100

    def in_matrix(self, n: int) -> int:
        """How many of a set's first tokens the matrix holds."""
        return min(n, n - self.need(n) + spare(n))


def spare(n: int) -> int:
    """Of the tokens in the matrix, those that a set of ``n`` shares with any of its size or more that it links with."""
    return 1 + n // 32


def key_of(tokens: np.ndarray) -> bytes | None:
    return len(tokens).to_bytes(4, "big") + blake2b(tokens.tobytes(), digest_size=12).digest() if len(tokens) else None


def _slots(tokens: np.ndarray) -> np.ndarray:
    return (tokens >> np.uint64(64 - 22)).astype(np.int64)


def token_levels(docs: DataFrame, rule: Rule) -> np.ndarray:
    """For each slot, twice the logarithm of how many times tokens of that slot are in documents."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, held, size = np.zeros(SLOTS, np.uint32), [], 0
        for b in batches:
            for text in b.column(0):
                held.append(_slots(rule.tokens(text.as_py())))
                size += len(held[-1])
                if size > SLOTS // 4:
                    total += np.bincount(np.concatenate(held), minlength=SLOTS).astype(np.uint32)
                    held, size = [], 0
        if held:
            total += np.bincount(np.concatenate(held), minlength=SLOTS).astype(np.uint32)
        parts = np.minimum(total, 255).astype(np.uint8).reshape(RANGES, -1)  # beyond 255 in a task a token is frequent anyway
        yield pa.RecordBatch.from_arrays([pa.array(range(RANGES), pa.int32()), pa.array([p.tobytes() for p in parts], pa.binary())], names=["part", "counts"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            for part, counts in zip(b.column(0).to_pylist(), b.column(1)):
                sums[part] = sums.get(part, 0) + np.frombuffer(counts.as_py(), np.uint8).astype(np.int64)
        levels = [np.floor(2 * np.log2(np.maximum(s, 1))).astype(np.uint8).tobytes() for s in sums.values()]
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array(levels, pa.binary())], names=["part", "levels"])

    counts = docs.select(text_or_empty().alias("text")).mapInArrow(count, "part int, counts binary")
    levels = counts.repartition("part").mapInArrow(add, "part int, levels binary").collect()
    found = np.zeros((RANGES, SLOTS // RANGES), np.uint8)
    for r in levels:
        found[r["part"]] = np.frombuffer(r["levels"], np.uint8)
    return found.ravel()


def marks(docs: DataFrame, rule: Rule) -> DataFrame:
    """A row per document; the tokens of its set for the matrix come with the first row of that set in a task."""
    order = docs.sparkSession.sparkContext.broadcast(token_levels(docs, rule))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        levels = order.value
        for b in batches:
            n, keys, least, prefixes = [], [], [], []
            for text in b.column(2):
                t = rule.tokens(text.as_py())
                n.append(len(t))
                keys.append(key_of(t))
                if keys[-1] is None or keys[-1] in seen:
                    least.append(np.zeros(2 * len(ORDERS), np.int64))
                    prefixes.append(None)
                    continue
                seen.add(keys[-1])
                rarest_first = t[np.lexsort((t, levels[_slots(t)]))]
                firsts = [rarest_first[:-3:-1], t[:2]]
                least.append(np.concatenate([np.resize(x, 2) for x in firsts]).view(np.int64))
                prefixes.append(rarest_first[: rule.in_matrix(len(t))].view(np.int64))
            lists = pa.ListArray.from_arrays(
                pa.array(np.concatenate([[0], np.cumsum([0 if p is None else len(p) for p in prefixes])]), pa.int32()),
                pa.array(np.concatenate([np.empty(0, np.int64), *(p for p in prefixes if p is not None)])),
                mask=pa.array([p is None for p in prefixes]),
            )
            ends = np.stack(least, axis=1) if least else np.empty((2 * len(ORDERS), 0), np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(n, pa.int64()), pa.array(keys, pa.binary()), *map(pa.array, ends), lists], names=[c.split()[0] for c in MARKS.split(", ")])

    return docs.select(F.col("doc_id").cast("long"), F.xxhash64(text_or_empty()), text_or_empty().alias("text")).mapInArrow(run, MARKS)


def _running(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (key, part) in order to (key, part, before, size): tokens in the part's classes before, and the class's own."""
    total = 0
    for b in batches:
        sizes = [int.from_bytes(k[:4], "big") for k in b.column(0).to_pylist()]
        ends = total + np.cumsum(sizes, dtype=np.int64)
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(ends - np.array(sizes, np.int64)), pa.array(sizes, pa.int64())], names=["key", "part", "before", "size"])
        total = int(ends[-1]) if len(sizes) else total


def grouped(classes: DataFrame, m1: str, m2: str, number: int) -> DataFrame:
    """(key, group, next) of each class, by one order: its group, and the next one if it is its group's last.

    Groups go on across partitions: a part's tokens before it are added up from a row per part.
    """
    rows = classes.select("key", m1, m2).repartitionByRange(m1, m2, "key").sortWithinPartitions(m1, m2, "key").select("key", F.spark_partition_id().alias("part"))
    rows = materialize(rows.mapInArrow(_running, "key binary, part int, before long, size long"), "order")
    parts = rows.groupBy("part").agg(F.sum("size").alias("tokens"))
    offsets = parts.select("part", (F.sum("tokens").over(Window.orderBy("part")) - F.col("tokens")).alias("offset"))
    first = F.col("offset") + F.col("before")
    group = lambda at: (F.lit(number << 48) + F.floor(at / GROUP_TOKENS)).cast("long")
    last = group(first + F.col("size")) > group(first)
    return rows.join(offsets, "part").select("key", group(first).alias("group"), F.when(last, group(first) + 1).alias("next"))


class OpenGroup:
    """The union of a group's tokens, each with the members that have it."""

    def __init__(self, members: list[np.ndarray], rule: Rule):
        self.rule = rule
        self.sizes = np.array([len(m) for m in members])
        tokens, owners = np.concatenate(members), np.repeat(np.arange(len(members)), self.sizes)
        order = np.argsort(tokens, kind="stable")
        tokens, self.owners = tokens[order], owners[order]
        self.first = np.flatnonzero(np.concatenate(([True], tokens[1:] != tokens[:-1])))
        self.union, self.first = tokens[self.first], np.append(self.first, len(tokens))
        self.smallest = int(self.sizes.min())

    def linked(self, query: np.ndarray) -> np.ndarray:
        """Which members link with the query."""
        at = np.minimum(np.searchsorted(self.union, query), len(self.union) - 1)
        at = at[self.union[at] == query]
        if len(at) < self.rule.need(max(len(query), self.smallest)):  # the bound by the group's union
            return np.empty(0, np.int64)
        many = self.first[at + 1] - self.first[at]
        places = np.repeat(self.first[at] - np.cumsum(many) + many, many) + np.arange(many.sum())
        common = np.bincount(self.owners[places], minlength=len(self.sizes))
        return np.flatnonzero(100 * common >= self.rule.percent * (len(query) + self.sizes - common))


def _opened(rule: Rule, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (group, part, own, query, key, tokens) in order of the first three and key, members first, to links."""
    name = None
    for b in batches:
        u: list[bytes] = []
        v: list[bytes] = []
        columns = [b.column(k) for k in range(6)]
        for i in range(b.num_rows):
            group, part, own, query, key, tokens = (c[i].as_py() for c in columns)
            tokens = np.frombuffer(tokens, "<u8")
            if name != (group, part):
                name, keys, sets, opened = (group, part), [], [], None
            if not query:
                if not keys or keys[-1] != key:  # a repeated row of one set
                    keys.append(key)
                    sets.append(tokens)
                    inner = own
                continue
            if not keys:
                continue
            if opened is None:
                opened, label = _members(rule, keys, sets, inner, u, v)
            for k in {label[m]: m for m in opened.linked(tokens)}.values():
                u.append(key)
                v.append(keys[k])
        yield pa.RecordBatch.from_arrays([pa.array(u, pa.binary()), pa.array(v, pa.binary())], names=["u", "v"])


def _members(rule: Rule, keys: list[bytes], sets: list[np.ndarray], own: bool, u: list[bytes], v: list[bytes]) -> tuple[OpenGroup, list[int]]:
    """The opened group and its members' connected parts, whose links are added if they are wanted.

    Of two parts that link, one isn't the largest; so all members ask that no
    other has found yet, and then those outside of the largest part.
    """
    opened, label = OpenGroup(sets, rule), np.arange(len(keys))
    asked = np.zeros(len(keys), bool)

    def ask(i: int) -> None:
        asked[i] = True
        found = opened.linked(sets[i])
        for part in np.unique(label[found]):
            if part != label[i]:
                k = found[label[found] == part][0]
                u.append(keys[i])
                v.append(keys[k])
        label[np.isin(label, label[found])] = label[i]

    if own:
        alone = np.ones(len(keys), bool)
        for i in range(len(keys)):
            if alone[i]:
                ask(i)
                parts, inverse, sizes = np.unique(label, return_inverse=True, return_counts=True)
                alone = sizes[inverse] == 1
                alone[: i + 1] = False
        while True:
            parts, sizes = np.unique(label, return_counts=True)
            rest = np.flatnonzero((label != parts[sizes.argmax()]) & ~asked)
            if not len(rest):
                break
            ask(int(rest[0]))
    return opened, label.tolist()


def open_groups(requests: DataFrame, groups: DataFrame, sets: DataFrame, own: bool, rule: Rule) -> DataFrame:
    """Links (u, v) of the classes that ``requests`` (key, group) name with the groups' members and, if ``own``, of members.

    ``groups``: key, group (if ``own``, those of one member have nothing to link and are left out); ``sets``: key, tokens.
    """
    if own:  # the last of the last group asks one that isn't there
        several = groups.groupBy("group").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
        groups = groups.select("key", "group").join(several, "group").drop("members")
    asked = requests.groupBy("group").agg(F.ceil(F.count(F.lit(1)) / QUERIES).cast("int").alias("parts"))
    parts = F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1)).alias("part")
    members = groups.select("key", "group").join(asked, "group", "left" if own else "inner").select("group", parts, "key")
    asking = requests.join(asked, "group").select("group", F.pmod(F.xxhash64("key"), F.col("parts")).cast("int").alias("part"), "key")
    rows = members.withColumn("query", F.lit(False)).unionByName(asking.withColumn("query", F.lit(True)))
    if own:  # a member asks for nothing, so a row at the end makes the group open
        last = members.where("part = 0").groupBy("group", "part").agg(F.min("key").alias("key")).withColumn("query", F.lit(True))
        rows = rows.unionByName(last)
    rows = rows.join(sets.hint("merge"), "key").withColumn("own", F.lit(own)).select("group", "part", "own", "query", "key", "tokens")
    rows = rows.repartition("group", "part").sortWithinPartitions("group", "part", "query", "key")
    return rows.mapInArrow(partial(_opened, rule), "u binary, v binary")


def token_sets(docs: DataFrame, classes: DataFrame, rule: Rule) -> DataFrame:
    """(key, tokens) of the classes (key, first), made from the texts again rather than kept for all.

    Texts whose ids share a bit with one of theirs come along; no group has their keys.
    """

    at = F.pmod(F.xxhash64("id"), F.lit(ID_BITS))
    ids = classes.select(F.col("first").alias("id")).select(at.alias("at")).selectExpr("at div 64 AS word", "shiftleft(1L, CAST(at % 64 AS INT)) AS bit")
    words = ids.groupBy("word").agg(F.bit_or("bit").alias("bits")).toPandas()  # at most ID_BITS / 64 rows
    filled = np.zeros(ID_BITS // 64, np.int64)
    filled[words["word"].to_numpy(np.int64)] = words["bits"].to_numpy(np.int64)
    marked = docs.sparkSession.sparkContext.broadcast(filled)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = marked.value
        for b in batches:
            at = b.column(0).to_numpy()
            wanted = np.flatnonzero((bits[at >> 6] >> (at & 63)) & 1)
            sets = [rule.tokens(b.column(1)[i].as_py()) for i in wanted.tolist()]
            yield pa.RecordBatch.from_arrays([pa.array([key_of(s) for s in sets], pa.binary()), pa.array([s.tobytes() for s in sets], pa.binary())], names=["key", "tokens"])

    texts = docs.select(F.col("doc_id").cast("long").alias("id"), text_or_empty().alias("text")).select(at.alias("at"), "text")
    return texts.mapInArrow(run, "key binary, tokens binary").where("key IS NOT NULL")


def size_of(key: str) -> Column:
    return F.conv(F.hex(F.substring(key, 1, 4)), 16, 10).cast("long")


def matrix_requests(shared: DataFrame, groups: DataFrame, connected: DataFrame, rule: Rule) -> DataFrame:
    """(key, group) where the counted tokens leave room for a link that isn't known.

    ``shared``: token, key; ``groups``: key, group; ``connected``: node, root.
    """
    of_group = groups.groupBy("group").agg(F.count(F.lit(1)).alias("members"))
    known = groups.select("key", "group").join(of_group, "group").join(connected.withColumnRenamed("node", "key"), "key", "left")
    known = known.select("key", "members", "group", F.coalesce("root", "key").alias("root"), size_of("key").alias("size"))
    # Written once, as both sides of the join by token come from it; one shuffle by token serves a side's aggregate and join.
    classes = materialize(shared.join(known.hint("merge"), "key"), "matrix-classes").repartition("token")
    matrix = classes.groupBy("token", F.col("members").alias("g_members"), F.col("group").alias("g")).agg(
        F.min("size").alias("least"), F.max("size").alias("most"), F.min("root").alias("low"), F.max("root").alias("high")
    )
    fits = (F.struct("members", "group") < F.struct("g_members", "g")) & (F.col("size") * 100 >= F.col("least") * rule.percent) & (F.col("most") * 100 >= F.col("size") * rule.percent)
    fits &= (F.col("low") != F.col("root")) | (F.col("high") != F.col("root"))
    met = classes.join(matrix.hint("merge"), "token").where(fits).groupBy("key", "g").agg(F.count(F.lit(1)).alias("n"), F.min("least").alias("least"), F.first("size").alias("size"))
    enough = F.floor(F.least("size", "least") / 32) + 1
    return met.where(F.col("n") >= enough).select("key", F.col("g").alias("group"))


def shared_tokens(leaves: DataFrame, rule: Rule) -> DataFrame:
    """(token, key): the tokens of each class (key, prefix) that a class of a size that can link with it has too.

    A key begins with its size, so of a token's classes in order of their keys the ones before and after are nearest in size.
    """
    order = Window.partitionBy("token").orderBy("key")
    posts = leaves.select("key", F.explode("prefix").alias("token")).withColumns({"before": F.lag("key").over(order), "after": F.lead("key").over(order)})
    fits = lambda less, more: size_of(less) * 100 >= size_of(more) * rule.percent
    near = (F.col("before").isNotNull() & fits("before", "key")) | (F.col("after").isNotNull() & fits("key", "after"))
    return posts.where(near).select("token", "key")


def link_classes(docs: DataFrame, leaves: DataFrame, rule: Rule) -> DataFrame:
    """Links (u, v) that connect every component; ``leaves``: key, first, n, the columns of ORDERS, prefix."""
    shared = materialize(shared_tokens(leaves, rule), "matrix")
    # Fewer shared tokens than any partner asks for: such a class links with nothing.
    enough = F.floor(F.floor(size_of("key") * rule.percent / 100) / 32) + 1
    sharing = shared.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= enough)
    classes = materialize(leaves.drop("prefix", "n").join(sharing, "key", "left_semi"), "classes")
    sets = materialize(token_sets(docs, classes, rule), "token-sets")
    orders = [grouped(classes, *names, k) for k, names in enumerate(ORDERS)]
    groups = materialize(reduce(DataFrame.unionByName, orders), "groups")
    chained = groups.where("next IS NOT NULL").select("key", F.col("next").alias("group"))
    own = materialize(open_groups(chained, groups.select("key", "group"), sets, True, rule), "own-links")
    stars = materialize(components(own), "connected")
    groups = groups.where(F.col("group") < (1 << 48)).select("key", "group")
    requests = materialize(matrix_requests(shared, groups, stars, rule), "requests")
    return stars.toDF("u", "v").unionByName(open_groups(requests, groups, sets, False, rule))


def cluster(docs: DataFrame, rule: Rule = Rule()) -> DataFrame:  # noqa: B008
    """One row per document: doc_id, text_hash, n_shingles, key, component_id."""
    marked = materialize(marks(docs, rule), "sets")
    one = [F.first(c, ignorenulls=True).alias(c) for c in (*(c for names in ORDERS for c in names), "prefix")]
    count = marked.where("key IS NOT NULL").groupBy("key").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n"))
    sets = marked.where("prefix IS NOT NULL").groupBy("key").agg(*one)
    leaves = materialize(count.join(sets, "key"), "set-classes")
    marked = marked.select("doc_id", "text_hash", "n_shingles", "key")
    return name_components(marked, leaves.select("key", "first", "n"), "key", link_classes(docs, leaves, rule))


def op13_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster(read_table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")
