"""Byte-level BPE: a minimal acyclic transducer for frequent words, exact merges for the rest.

The frequent words of the corpus, counted by Spark, are compiled with their ids
into a minimal acyclic automaton: states with equal futures are shared, and the
numbers on the arcs of a word's path add up to its rank, which points to its
ids.  The automaton is one flat array of bounded size, in one file per executor
that its tasks memory-map; many words walk it at once.  Words that it doesn't have are merged by the
vocabulary's merge ranks, also many at once.  Ids equal those of the tokenizer
file's own library.

Texts are cut where no token can cross: at white space, with at most one space
before a word.  Each task remembers the ids of the pieces it has met, up to a
fixed number of pieces.

Defined cases: a null text is empty and has no ids; the special token's string
becomes its id wherever it stands, as the library does; a word of any length is
merged exactly (over 1,000 bytes by a heap); repeated rows are encoded alike;
other columns aren't read.
"""

from __future__ import annotations

import heapq
import json
import os
import uuid
from collections import Counter
from collections.abc import Iterator
from functools import cache, cached_property, lru_cache
from hashlib import sha256
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialize, most_frequent, read_table, text_or_empty

#: Unicode white space, as the tokenizer's pattern understands it.
SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
#: The byte-level tokenizer's word pattern (fixed value), with white space spelled out.
WORDS = rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{SPACE}\p{{L}}\p{{N}}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"
#: Pieces no token crosses: a word with the space before it, or white space.
PIECES = rf" ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]"
LEXICON_WORDS = 65_536
REMEMBERED = 600_000
LONG_WORD = 1_000
SLICE_CHARS = 2_000_000


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def byte_letters() -> dict[str, int]:
    """The letters by which a byte-level vocabulary writes bytes: printable ones as themselves, the others from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Vocabulary:
    """Ids, merges and special tokens of a tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters, vocab = byte_letters(), spec["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.size = max([*vocab.values(), *self.special.values()]) + 1
        bytes_of = {i: bytes(letters[c] for c in token) for token, i in vocab.items() if token not in self.special}
        bytes_of |= {i: token.encode() for token, i in self.special.items()}
        blobs = [bytes_of.get(i, b"") for i in range(self.size)]
        self.blob = np.frombuffer(b"".join(blobs), np.uint8)
        self.starts = np.concatenate(([0], np.cumsum([len(b) for b in blobs])))
        self.byte_id = np.array([vocab[c] for c, _ in sorted(letters.items(), key=lambda x: x[1])], np.int64)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        keys = np.array([vocab[a] * self.size + vocab[b] for a, b in pairs], np.int64)
        self.worst = len(keys)
        self._hash(keys)
        self.pair_ids = np.array([vocab[a + b] for a, b in pairs], np.int64)
        self.rank_of = dict(zip(keys.tolist(), range(len(keys))))

    def _hash(self, keys: np.ndarray) -> None:
        """A table with a slot's key and rank; keys that find their slot taken go to the next table."""
        self.bits, self.tables = max(4, int(keys.size * 8).bit_length()), []
        left = np.arange(len(keys))
        while len(left):
            slot = self._slot(keys[left], len(self.tables))
            _, first = np.unique(slot, return_index=True)
            key, rank = np.full(1 << self.bits, -1, np.int64), np.full(1 << self.bits, self.worst, np.int32)
            key[slot[first]], rank[slot[first]] = keys[left[first]], left[first]
            self.tables.append((key, rank))
            left = np.delete(left, first)

    def _slot(self, keys: np.ndarray, n: int) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15 + 2 * n)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Merge rank of each pair; a large number if it has none."""
        keys = left * self.size + right
        out = None
        for n, (key, rank) in enumerate(self.tables):
            slot = self._slot(keys, n)
            found = np.where(key[slot] == keys, rank[slot], self.worst)
            out = found if out is None else np.minimum(out, found)
        return out

    def merge_long(self, word: bytes) -> np.ndarray:
        """Exact merges of one long word in n log n."""
        ids = self.byte_id[np.frombuffer(word, np.uint8)].tolist()
        after, before = list(range(1, len(ids) + 1)), list(range(-1, len(ids) - 1))
        rank_of, size = self.rank_of, self.size
        heap = [(r, i, a, b) for i, (a, b) in enumerate(zip(ids, ids[1:])) if (r := rank_of.get(a * size + b)) is not None]
        heapq.heapify(heap)

        def offer(i: int, j: int) -> None:
            if (r := rank_of.get(ids[i] * size + ids[j])) is not None:
                heapq.heappush(heap, (r, i, ids[i], ids[j]))

        while heap:
            r, i, a, b = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j >= len(ids) or ids[j] != b:
                continue
            ids[i], ids[j] = int(self.pair_ids[r]), -1
            after[i] = k = after[j]
            if k < len(ids):
                before[k] = i
                offer(i, k)
            if before[i] >= 0:
                offer(before[i], i)
        return np.array([x for x in ids if x >= 0], np.int64)

    def merge(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Exact merges of many words: their ids one after another, and how many each has.

        In each round every word merges all places of its pair of lowest rank;
        a place that overlaps the one before it is left out, as from left to right.
        """
        out: list[np.ndarray | None] = [self.merge_long(w) if len(w) > LONG_WORD else None for w in words]
        at = np.array([i for i, x in enumerate(out) if x is None], np.int64)
        lengths = np.array([len(words[i]) for i in at], np.int64)
        ids = self.byte_id[np.frombuffer(b"".join(words[i] for i in at), np.uint8)]
        done_ids, done_word, worst = [], [], self.worst
        word = np.repeat(at, lengths)
        while len(ids):
            inner = word[1:] == word[:-1]
            rank = np.append(np.where(inner, self.ranks(ids[:-1], ids[1:]), worst), worst)
            first = np.flatnonzero(np.concatenate(([True], ~inner)))
            best = np.minimum.reduceat(rank, first)
            size = np.diff(np.append(first, len(ids)))
            ended = np.repeat(best == worst, size)
            if ended.any():
                done_ids.append(ids[ended])
                done_word.append(word[ended])
                ids, word, rank = ids[~ended], word[~ended], rank[~ended]
                best = np.repeat(best, size)[~ended]
                if not len(ids):
                    break
            else:
                best = np.repeat(best, size)
            place = np.flatnonzero(rank == best)
            run = np.concatenate(([True], np.diff(place) != 1))
            start = place[run][np.cumsum(run) - 1]
            place = place[(place - start) % 2 == 0]
            ids[place] = self.pair_ids[rank[place]]
            keep = np.ones(len(ids), bool)
            keep[place + 1] = False
            ids, word = ids[keep], word[keep]
        flat, owner = (np.concatenate([*x, np.empty(0, np.int64)]) for x in (done_ids, done_word))
        order = np.argsort(owner, kind="stable")
        flat, counts = flat[order], np.bincount(owner, minlength=len(words))
        if len(at) < len(words):
            parts, cut = [], np.split(flat, np.cumsum(counts)[:-1])
            parts = [c if x is None else x for x, c in zip(out, cut)]
            return np.concatenate(parts), np.array([len(x) for x in parts])
        return flat, counts

    @cached_property
    def decimals(self) -> tuple[np.ndarray, np.ndarray]:
        """Every id in decimal with a comma after it, and where each begins."""
        texts = [b"%d," % i for i in range(self.size)]
        return np.frombuffer(b"".join(texts), np.uint8), np.concatenate(([0], np.cumsum([len(t) for t in texts])))

    def in_decimal(self, ids: np.ndarray) -> bytes:
        """The ids in decimal, joined by commas."""
        blob, starts = self.decimals
        return blob[spread(starts[ids], starts[ids + 1] - starts[ids])].tobytes()[:-1]

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids; bytes that are no UTF-8 become U+FFFD."""
        start, size = self.starts[ids], self.starts[ids + 1] - self.starts[ids]
        return self.blob[spread(start, size)].tobytes().decode("utf-8", "replace")


def spread(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """start[i], start[i] + 1, ... (size[i] numbers) for each i."""
    ends = np.cumsum(size)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(start - (ends - size), size)


# ---- the lexicon


def compile_lexicon(words: dict[bytes, np.ndarray]) -> bytes:
    """A minimal acyclic transducer of the words: the bytes of one flat uint32 array.

    Words come in order, so the path of the word before can be frozen from its
    end up to the common prefix, each state replaced by an equal one if there is.
    """
    register: dict[tuple, int] = {}
    states: list[tuple] = []
    count: list[int] = []

    def freeze(node: list) -> int:
        key = (node[0], tuple(node[1]))
        if key not in register:
            register[key] = len(states)
            states.append(key)
            count.append(node[0] + sum(count[t] for _, t in node[1]))
        return register[key]

    path: list[list] = [[False, []]]
    ordered, last = sorted(words), b""
    for w in [*ordered, b""]:
        common = os.path.commonprefix([last, w]) if w else b""
        for i in range(len(last), len(common), -1):
            target = freeze(path.pop())
            path[-1][1].append((last[i - 1], target))
        path += [[False, []] for _ in w[len(common) :]]
        path[-1][0] |= bool(w)
        last = w
    root = freeze(path[0])
    keys, targets, adds = [], [], []
    for s, (final, arcs) in enumerate(states):
        passed = int(final)
        for label, target in arcs:
            keys.append(s << 8 | label)
            targets.append(target << 1 | states[target][0])
            adds.append(passed)
            passed += count[target]
    offsets = np.concatenate(([0], np.cumsum([len(words[w]) for w in ordered])))
    ids = np.concatenate([*(words[w] for w in ordered), np.empty(0, np.int64)])
    head = [root, len(keys), len(ordered), len(ids)]
    return np.concatenate([head, keys, targets, adds, offsets, ids]).astype("<u4").tobytes()


class Lexicon:
    """A compiled lexicon, memory-mapped from one file in the executor's folder, so its workers share the pages."""

    def __init__(self, compiled: bytes, folder: str | None = None):
        """Without a ``folder`` the bytes are used as they are."""
        flat = np.frombuffer(compiled, "<u4")
        if folder:
            name = os.path.join(folder, f"lexicon-{sha256(compiled).hexdigest()}")
            if not os.path.exists(name):
                own = f"{name}-{uuid.uuid4().hex}"
                with open(own, "wb") as f:
                    f.write(compiled)
                os.replace(own, name)  # whoever comes first; the others put the same bytes there
            flat = np.memmap(name, "<u4", "r")
        self.root, arcs, n, ids = map(int, flat[:4])
        cut = np.cumsum([4, arcs, arcs, arcs, n + 1, ids])
        self.keys, self.targets, self.adds, self.offsets, self.ids = (flat[a:b] for a, b in zip(cut, cut[1:]))

    def rank(self, words: list[bytes]) -> np.ndarray:
        """Rank of each word, -1 for those that the lexicon doesn't have; all words take a step at a time."""
        size = np.fromiter(map(len, words), np.int64, len(words))
        flat, first = np.frombuffer(b"".join(words), np.uint8), np.cumsum(size) - size
        rank = np.full(len(words), -1, np.int64)
        if not len(self.keys):
            return rank
        live, state, total = np.flatnonzero(size), np.full(int((size > 0).sum()), self.root, np.int64), np.zeros(int((size > 0).sum()), np.int64)
        step = 0
        while len(live):
            key = state << 8 | flat[first[live] + step]
            at = np.minimum(np.searchsorted(self.keys, key.astype(np.uint32)), len(self.keys) - 1)
            hit = self.keys[at] == key
            live, at = live[hit], at[hit]
            total = total[hit] + self.adds[at]
            state, final = self.targets[at].astype(np.int64) >> 1, self.targets[at] & 1
            step += 1
            end = size[live] == step
            rank[live[end & (final == 1)]] = total[end & (final == 1)]
            live, state, total = live[~end], state[~end], total[~end]
        return rank


# ---- encoding


class Encoder:
    """Texts to ids.  ``compiled``: a lexicon of compile_lexicon, or none."""

    def __init__(self, path: str, compiled: bytes | None = None, folder: str | None = None):
        import re

        import regex

        self.vocabulary = Vocabulary(path)
        self.lexicon = Lexicon(compiled or compile_lexicon({}), folder if compiled else None)
        self.words, self.pieces = regex.compile(WORDS), re.compile(PIECES)
        self.specials = re.compile("(" + "|".join(map(re.escape, self.vocabulary.special)) + ")") if self.vocabulary.special else None
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.start, self.size, self.ids, self.used = np.empty(1 << 16, np.int64), np.empty(1 << 16, np.int64), np.empty(1 << 18, np.int64), 0
        for token, i in self.vocabulary.special.items():
            self._remember([token], np.array([i]), np.array([1]))

    def _remember(self, pieces: list[str], ids: np.ndarray, counts: np.ndarray) -> None:
        n, m = len(self.known), len(pieces)
        while n + m > len(self.start):
            self.start, self.size = (np.concatenate((x, np.empty_like(x))) for x in (self.start, self.size))
        while self.used + len(ids) > len(self.ids):
            self.ids = np.concatenate((self.ids, np.empty_like(self.ids)))
        self.ids[self.used : self.used + len(ids)] = ids
        self.start[n : n + m], self.size[n : n + m] = self.used + np.cumsum(counts) - counts, counts
        self.used += len(ids)
        self.known.update(zip(pieces, range(n, n + m)))

    def encode_words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words one after another, and how many each has."""
        if not len(self.lexicon.keys):
            return self.vocabulary.merge(words)
        rank = self.lexicon.rank(words)
        rest = np.flatnonzero(rank < 0)
        merged, merged_counts = self.vocabulary.merge([words[i] for i in rest])
        start, counts = np.empty(len(words), np.int64), np.empty(len(words), np.int64)
        hit = rank >= 0
        first, after = self.lexicon.offsets[rank[hit]].astype(np.int64), self.lexicon.offsets[rank[hit] + 1].astype(np.int64)
        start[hit], counts[hit] = first, after - first
        start[rest], counts[rest] = len(self.lexicon.ids) + np.cumsum(merged_counts) - merged_counts, merged_counts
        return np.concatenate((self.lexicon.ids, merged))[spread(start, counts)], counts

    def learn(self, pieces: list[str]) -> None:
        """Encode pieces that aren't known yet."""
        # A piece of letters only, with or without a space before them, is one word.
        whole = [p for p in pieces if p.isalpha() or p[0] == " " and p[1:].isalpha()]
        if whole:
            self._remember(whole, *self.encode_words([p.encode() for p in whole]))
        mixed = [p for p in pieces if p not in self.known]
        if mixed:
            split = [self.words.findall(p) for p in mixed]
            ids, counts = self.encode_words([w.encode() for w in chain.from_iterable(split)])
            ends = np.concatenate(([0], np.cumsum([*map(len, split)])))
            self._remember(mixed, ids, np.diff(np.concatenate(([0], np.cumsum(counts)))[ends]))

    def cut(self, text: str) -> list[str]:
        if self.specials and "<|" in text and self.specials.search(text):
            out: list[str] = []
            for i, part in enumerate(self.specials.split(text)):
                out += [part] if i % 2 else self.pieces.findall(part)
            return out
        return self.pieces.findall(text)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text."""
        cut = [self.cut(t) for t in texts]
        if len(self.known) > REMEMBERED:
            self.forget()
        flat = list(chain.from_iterable(cut))
        at = np.fromiter(map(self.known.get, flat, repeat(-1)), np.int64, len(flat))
        missing = np.flatnonzero(at < 0).tolist()
        if missing:
            new = [flat[i] for i in missing]
            self.learn(list(dict.fromkeys(new)))
            at[missing] = np.fromiter(map(self.known.__getitem__, new), np.int64, len(new))
        start, size = self.start[at], self.size[at]
        ids = self.ids[spread(start, size)]
        bounds = np.concatenate(([0], np.cumsum(size)))[np.cumsum([0, *map(len, cut)])]
        return [ids[a:b] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]

    def encode_column(self, column) -> Iterator[np.ndarray]:
        """The ids of each text of an Arrow column, some texts at a time."""
        held, size = [], 0
        for t in column:
            held.append(t.as_py() or "")
            size += len(held[-1])
            if size > SLICE_CHARS:
                yield from self.encode(held)
                held, size = [], 0
        yield from self.encode(held)


@lru_cache(maxsize=2)
def _encoder(path: str, compiled: bytes | None) -> Encoder:
    return Encoder(path, compiled, SparkFiles.getRootDirectory() if compiled else None)


def frequent_words(docs: DataFrame, path: str, limit: int = LEXICON_WORDS) -> list[bytes]:
    """The most frequent words of the corpus, at most ``limit``; counted in tasks first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(path)
        seen: Counter[str] = Counter()

        def out() -> pa.RecordBatch:
            words: Counter[str] = Counter()
            for piece, n in seen.items():
                for w in encoder.words.findall(piece):
                    words[w] += n
            seen.clear()
            return pa.RecordBatch.from_arrays([pa.array(list(words), pa.string()), pa.array(list(words.values()), pa.int64())], names=["word", "n"])

        for b in batches:
            for t in b.column(0):
                seen.update(encoder.cut(t.as_py()))
                if len(seen) > REMEMBERED:
                    yield out()
        yield out()

    counts = docs.select(text_or_empty().alias("text")).mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    counts = materialize(counts.where((F.col("n") > 1) & (F.length("word") < LONG_WORD)), "word-counts")
    return sorted(r["word"].encode() for r in most_frequent(counts, "n", "word", limit).select("word").collect())


def build_lexicon(docs: DataFrame, path: str, limit: int = LEXICON_WORDS) -> bytes:
    """Count, encode and compile the frequent words; bounded by ``limit`` whatever the corpus's size."""
    words = frequent_words(docs, path, limit)
    ids, counts = Vocabulary(path).merge(words)
    return compile_lexicon(dict(zip(words, np.split(ids, np.cumsum(counts)[:-1]))) if words else {})


def encode(docs: DataFrame, path: str, lexicon: bytes) -> DataFrame:
    """doc_id and ids (array of int) of every text."""
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(path, shared.value)
        for b in batches:
            ids = [x.astype(np.int32) for x in encoder.encode_column(b.column(1))]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(ids, pa.list_(pa.int32()))], names=["doc_id", "ids"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text")).mapInArrow(run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """doc_id and text of every row of ids; null ids are empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _vocabulary(path)
        for b in batches:
            texts = [vocabulary.decode(np.array(x.as_py() or [], np.int64)) for x in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


@cache
def _vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def digests(docs: DataFrame, path: str, lexicon: bytes) -> DataFrame:
    """doc_id, n_tokens and the digests of ids and of the text decoded from them, without moving the ids."""
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(path, shared.value)
        for b in batches:
            n, a, d = [], [], []
            for ids in encoder.encode_column(b.column(1)):
                n.append(len(ids))
                a.append(sha256(encoder.vocabulary.in_decimal(ids)).hexdigest())
                d.append(sha256(encoder.vocabulary.decode(ids).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(a, pa.string()), pa.array(d, pa.string())], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    return texts.mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, path = read_table(spark, sf_dir, "documents"), default_path()
    return digests(docs, path, build_lexicon(docs, path))
