"""Gated recurrent language model: log-likelihoods of whole documents.

Counts.  Tokens are counted over all training documents, in tasks first.  The
most frequent words (``head``, a bounded number) go to every task; the rest stay
in a table and meet the documents by a shuffled join on the word.

Model.  A gated recurrent unit reads the words; the output is factored into
groups of classes, classes, and words within their class, each a softmax over
the state.  The first ``dynamic`` words fill classes of equal size.  Other head
words, and separately all rarer words, are two more groups, whose classes go by
the last letter; within those a word's probability is its share of the class's
counts, so any word, seen or not, has one (a word never seen counts as one of
count one, added to its class).

Fit.  Truncated backpropagation in numpy: documents lie one after another in
lanes, windows of fixed length are run with the state carried from the one
before (reset where a document begins), and gradients stop at the window.  A
document that would fill much of a lane is learned from in pieces, each of which
starts from the state carried through all that lies before it, with the word
before it as the first one read; those states come from one forward pass with the
weights at hand when the documents are laid out.  Each task
starts from the same weights and trains on its own documents, first in few lanes
and then in many; weights and step sizes are then averaged by tokens, in two
steps, and go out again for the next round.  Every training document is learned
from once, whatever the corpus's size: the rounds deal the documents out among
them.

Score.  Documents lie in lanes of like length and the state is carried over
every window from a document's first token to its end.

Defined cases: a null text is empty and has the end token only; a null id is
held out; repeated rows are scored each; without training documents all words
are unknown and the model is its initial state; other columns aren't read.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialize, most_frequent, read_table, text_or_empty

END = b""
RULES = 33
FLUSH = 500_000
PARTS = 64
AVERAGE_FAN = 256
#: Logits beyond this, either way, count as this.
LARGEST = 60.0
#: Rows of a class of words that are multiplied at a time: few, or most of a small class's block is filled up.
BLOCK = 16
#: Bytes of text whose words a task holds at a time, beside one text.
TEXT_AT_ONCE = 4 << 20


@dataclass(frozen=True)
class Config:
    head: int = 131_072
    #: Words below this count are rare whatever room the head has, so that the classes of rare words are learned.
    min_head_count: int = 3
    dynamic: int = 8_192
    class_size: int = 32
    group_size: int = 16
    embedding: int = 16
    hidden: int = 16
    rounds: int = 2
    lanes: int = 512
    window: int = 16
    rate: float = 0.3
    #: Steps times lanes that are scored at a time: what they need stays in the processor's cache.
    score_places: int = 32_768
    #: Tokens that a task lays out at a time: many, so that long documents share their steps with many lanes.
    score_tokens: int = 2_500_000
    fit_tokens: int = 1_000_000
    #: A fit's first layout; each is twice the one before, up to ``fit_tokens``, with a lane for every ``lane_tokens``.
    first_tokens: int = 40_000
    lane_tokens: int = 1_200
    least_lanes: int = 32
    seed: int = 7


def words_in(text: str) -> list[bytes]:
    """Words with A-Z lower-cased; bytes split at the six ASCII white-space characters."""
    return text.encode().lower().split()


_ASCII = bytes(range(128))
_NO_LETTER = bytes(set(_ASCII) - set(range(97, 123)))


def rule(word: bytes) -> int:
    """Class of a word outside the dynamic ones: by its last letter, or by its first letter beyond ASCII."""
    if word.isascii():
        letters = word.rstrip(_NO_LETTER)
        return letters[-1] - 97 if letters else 26
    return 27 + ord(word.translate(None, _ASCII).decode()[0]) % 6


def text_slices(texts: pa.StringArray) -> Iterator[pa.StringArray]:
    """The texts in order, some megabytes at a time."""
    size = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
    cuts = np.flatnonzero(np.diff(size // TEXT_AT_ONCE)) + 1
    for x, y in zip([0, *cuts.tolist()], [*cuts.tolist(), len(texts)]):
        if x < y:
            yield texts.slice(x, y - x)


def words_of_texts(texts: pa.StringArray) -> tuple[pa.StringArray, np.ndarray]:
    """``words_in`` of all texts, one after another, and where each text's words start (and the end)."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    words, starts = lists.flatten(), lists.offsets.to_numpy().astype(np.int64)
    starts -= starts[0]
    some = pc.greater(pc.binary_length(words), 0)  # white space at a text's start or end leaves an empty one
    kept = np.zeros(len(words) + 1, np.int64)
    np.cumsum(some.to_numpy(zero_copy_only=False), out=kept[1:])
    return (words if kept[-1] == len(words) else words.filter(some)), kept[starts]


def rules_of(words: pa.StringArray) -> np.ndarray:
    """``rule`` of each word."""
    if not len(words):
        return np.zeros(0, np.int64)
    ends = np.cumsum(pc.binary_length(words).to_numpy(zero_copy_only=False).astype(np.int64))
    starts = np.append(0, ends[:-1])
    data = np.frombuffer(pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), words.cast(pa.binary())), b"")[0].as_py(), np.uint8)
    data = np.append(data, np.zeros(4, np.uint8)).astype(np.int64)
    letters, beyond = np.flatnonzero((data >= 97) & (data <= 122)), np.append(np.flatnonzero(data > 127), len(data))
    last = np.append(letters, -1)[np.searchsorted(letters, ends) - 1]
    out = np.where(last >= starts, data[last] - 97, 26)
    at = beyond[np.searchsorted(beyond, starts)]
    (other,) = np.nonzero(at < ends)
    a, b, c, d = (data[at[other] + i] for i in range(4))
    two, three, four = (a & 31) << 6 | b & 63, (a & 15) << 12 | (b & 63) << 6 | c & 63, (a & 7) << 18 | (b & 63) << 12 | (c & 63) << 6 | d & 63
    out[other] = 27 + np.where(a < 224, two, np.where(a < 240, three, four)) % 6
    return out


@dataclass
class Lexicon:
    """The head words in order of frequency, with what is fixed about them."""

    words: list[bytes]
    counts: np.ndarray
    rare_sum: np.ndarray  # per rule: sum of (count + 1) over rarer words
    rare_count: np.ndarray
    config: Config
    index: dict[bytes, int] = field(default_factory=dict)

    def __post_init__(self) -> None:
        c = self.config
        n = len(self.words)
        self.index = dict(zip(self.words, range(n)))
        self.dynamic = min(c.dynamic, n)
        self.groups = max(1, -(-self.dynamic // (c.class_size * c.group_size)))
        self.word_classes = self.groups * c.group_size
        self.rules = np.array([rule(w) if i >= self.dynamic else 0 for i, w in enumerate(self.words)], np.int64)
        at = np.arange(n)
        self.token = np.append(np.where(at < self.dynamic, at, self.dynamic + self.rules), 0).astype(np.int32)  # the last stands for rare words
        mass = np.bincount(self.rules[self.dynamic :], self.counts[self.dynamic :], RULES) if n > self.dynamic else np.zeros(RULES)
        self.middle_mass = mass
        self.fixed = np.zeros(n)  # log10 of the share in the class, for head words that aren't dynamic
        self.fixed[self.dynamic :] = np.log10(self.counts[self.dynamic :]) - np.log10(np.maximum(mass[self.rules[self.dynamic :]], 1))
        token = np.arange(self.dynamic + 2 * RULES)
        tier = (token - self.dynamic) // RULES
        self.key = np.where(token < self.dynamic, token // c.class_size, self.word_classes + tier).astype(np.int16)  # the last class on a token's path
        self.top = np.where(token < self.dynamic, token // (c.class_size * c.group_size), self.groups + tier)
        self.log_count = np.log10(self.counts + 1.0)
        self.rare_log = -np.log10(self.rare_sum + 1)

    def read(self, text: str) -> tuple[np.ndarray, float, float, int, list[bytes]]:
        """Tokens of a text with its end; fixed log10 shares; sum of log10(count + 1) and number of head tokens; the rare words."""
        words = words_in(text)
        words.append(END)
        at = np.fromiter(map(self.index.get, words, repeat(-1)), np.int64, len(words))
        tokens = self.token[at]
        known = at[at >= 0]
        rare = [words[i] for i in np.flatnonzero(at < 0).tolist()]
        kinds = np.fromiter(map(rule, rare), np.int64, len(rare))
        tokens[at < 0] = self.dynamic + RULES + kinds
        fixed = float(self.fixed[known].sum() + self.rare_log[kinds].sum())
        return tokens, fixed, float(self.log_count[known].sum()), len(known), rare

    def read_all(self, texts: pa.StringArray, head: pa.StringArray) -> list[pa.Array]:
        """``read`` of every text by whole columns: tokens, known, log counts, fixed shares and rare words; ``head``: the lexicon's words."""
        if END not in self.index:  # nothing was learned from
            read = [self.read(t.as_py()) for t in texts]
            rare = pa.array([[w.decode() for w in x[4]] for x in read], pa.list_(pa.string()))
            return [pa.array([x[0].tobytes() for x in read], pa.binary()), pa.array([x[3] for x in read], pa.int64()), pa.array([x[2] for x in read]), pa.array([x[1] for x in read]), rare]
        n = len(texts)
        words, starts = words_of_texts(texts)
        found = pc.fill_null(pc.index_in(words, head), -1).to_numpy()
        ends = starts[1:] + np.arange(n)  # each text's end goes after its words
        at = np.insert(found, starts[1:], self.index[END])
        begins = np.append(0, ends[:-1] + 1)
        tokens = self.token[at]
        places = np.flatnonzero(at < 0)
        rare = words.filter(pa.array(found < 0))
        kinds, text = rules_of(rare), np.searchsorted(ends, places)
        tokens[places] = self.dynamic + RULES + kinds
        missed = np.bincount(text, minlength=n)
        fixed = np.add.reduceat(np.append(self.fixed, 0.0)[at], begins) + np.bincount(text, self.rare_log[kinds], n)
        logs = np.add.reduceat(np.append(self.log_count, 0.0)[at], begins)
        offsets = np.append(0, ends + 1).astype(np.int32) * 4
        column = pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(offsets), pa.py_buffer(tokens)])
        return [column, pa.array(ends + 1 - begins - missed, pa.int64()), pa.array(logs), pa.array(fixed), pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(missed)), pa.int32()), rare)]


# ---- the network


def shapes(lex: Lexicon) -> dict[str, tuple[int, ...]]:
    """The weights.  Output weights have a last row for the bias: states get a one appended."""
    c = lex.config
    return {
        "emb": (lex.dynamic + 2 * RULES, c.embedding), "wx": (c.embedding, 3 * c.hidden), "bx": (3 * c.hidden,), "u": (3 * c.hidden, c.hidden), "bu": (3 * c.hidden,),
        "top": (1, c.hidden + 1, lex.groups + 2), "mid": (lex.groups, c.hidden + 1, c.group_size), "word": (lex.word_classes, c.hidden + 1, c.class_size),
        "rule": (2, c.hidden + 1, RULES),
    }


def views(flat: np.ndarray, lex: Lexicon) -> dict[str, np.ndarray]:
    """Each weight as a part of one vector."""
    out, at = {}, 0
    for k, shape in shapes(lex).items():
        n = math.prod(shape)
        out[k] = flat[at : at + n].reshape(shape)
        at += n
    return out


def initial(lex: Lexicon) -> np.ndarray:
    """Small random weights; output biases at the logarithms of the counts' shares."""
    c, rng = lex.config, np.random.default_rng(lex.config.seed)
    flat = np.zeros(sum(map(math.prod, shapes(lex).values())), np.float32)
    p = views(flat, lex)
    for k, size in (("emb", 0.1), ("wx", 0.1), ("u", c.hidden**-0.5), ("top", 0.01), ("mid", 0.01), ("word", 0.01), ("rule", 0.01)):
        p[k][...] = rng.normal(0, size, p[k].shape)
    words = np.zeros(lex.word_classes * c.class_size)
    words[: lex.dynamic] = lex.counts[: lex.dynamic]
    words = words.reshape(lex.groups, c.group_size, c.class_size)
    rules = np.stack((lex.middle_mass, lex.rare_count))
    for k, counts in (("top", np.concatenate((words.sum(axis=(1, 2)), rules.sum(axis=1)))), ("mid", words.sum(axis=2)), ("word", words), ("rule", rules)):
        counts = counts.reshape(len(p[k]), -1)
        with np.errstate(divide="ignore"):  # a slot without a word gets the least bias
            p[k][:, -1] = np.maximum(np.log(counts) - np.log(np.maximum(counts.sum(axis=1, keepdims=True), 1)), -30)
    return flat


def lay_out(docs: list[np.ndarray], lanes: int, rng: np.random.Generator | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Target token (-1: none) and document number of each step and lane, and the lanes' lengths, the longest lane first.

    The longest documents are dealt first, each to the emptiest lane; with ``rng`` a lane's documents are then shuffled.
    """
    order = sorted(range(len(docs)), key=lambda i: -len(docs[i]))
    heap = [(0, i) for i in range(min(lanes, max(1, len(docs))))]
    rows: list[list[int]] = [[] for _ in heap]
    for i in order:
        size, lane = heapq.heappop(heap)
        rows[lane].append(i)
        heapq.heappush(heap, (size + len(docs[i]), lane))
    heap.sort(reverse=True)
    target = np.full((heap[0][0], len(heap)), -1, np.int32)
    doc = np.full(target.shape, -1, np.int32)
    for at, (size, lane) in enumerate(heap):
        if rng is not None:
            rng.shuffle(rows[lane])
        if rows[lane]:
            target[:size, at] = np.concatenate([docs[i] for i in rows[lane]])
            doc[:size, at] = np.repeat(rows[lane], [len(docs[i]) for i in rows[lane]])
    return target, doc, np.array([size for size, _ in heap])


class Network:
    """Gated recurrent unit with a class-factored softmax.  Arrays of a step are (unit, lane), so gates are whole blocks."""

    def __init__(self, lex: Lexicon, flat: np.ndarray):
        self.lex, self.flat, self.p = lex, flat, views(flat, lex)
        self.end = int(lex.token[lex.index[END]]) if END in lex.index else 0

    def gates(self, tokens: np.ndarray | slice) -> np.ndarray:
        """What each token adds to the gates; the first two gates are negated, as 1 / (1 + exp(-x)) wants them."""
        p, n = self.p, self.lex.config.hidden
        table = (p["emb"][tokens] if isinstance(tokens, slice) else p["emb"].take(tokens, axis=0)) @ p["wx"]
        table += p["bx"]
        table[:, : 2 * n] += p["bu"][: 2 * n]
        np.negative(table[:, : 2 * n], out=table[:, : 2 * n])
        return table

    def is_bounded(self) -> bool:
        """No state is beyond 1, so the weights tell whether a logit can be too large for exp."""
        return all(np.abs(self.p[k]).sum(axis=1).max() < LARGEST for k in ("top", "mid", "word", "rule"))

    def inputs(self, target: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Token read before each target, and whether a document begins there."""
        fresh = np.ones(target.shape, bool)
        np.not_equal(doc[1:], doc[:-1], out=fresh[1:])
        read = np.full(target.shape, self.end, np.int32)
        read[1:] = np.where(fresh[1:], self.end, np.maximum(target[:-1], 0))
        return read, fresh

    def run(
        self, table: np.ndarray, read: np.ndarray, fresh: np.ndarray, h: np.ndarray, keep: bool, starts: tuple[np.ndarray, np.ndarray] | None = None
    ) -> tuple[np.ndarray, list]:
        """States (step, unit, lane) of a window; with ``keep`` what the way back needs.  ``read``: rows of ``table``.

        What begins does so with a state of zeros, or with that of ``starts``: states as rows, and the row of each step and lane.
        """
        n, (steps, lanes), kind = len(h), read.shape, table.dtype
        gx = np.ascontiguousarray(table.take(read.ravel(), axis=0).reshape(steps, lanes, 3 * n).transpose(0, 2, 1))
        states = np.ones((steps + 1, n + 1, lanes), kind)  # the last row stays one and takes the bias
        states[0, :n] = h
        u = np.concatenate((self.p["u"], self.p["bu"][:, None]), axis=1)
        u[: 2 * n, :n] *= -1
        u[: 2 * n, n] = 0  # in the table already
        step, lane = np.nonzero(fresh)
        begins = np.searchsorted(step, np.arange(steps + 1)).tolist()
        first = np.zeros((n, len(lane)), kind) if starts is None else starts[0].take(starts[1][step, lane], axis=0).T
        gates, news, gaps = (np.empty((steps if keep else 1, size, lanes), kind) for size in (3 * n, n, n))
        places = [(g, g[: 2 * n], g[:n], g[n : 2 * n], g[2 * n :], new, gap) for g, new, gap in zip(gates, news, gaps)] * (1 if keep else steps)
        saved = []
        with np.errstate(over="ignore"):  # exp of a large number is infinite, the gate zero
            for x, y, before, after, of_rz, of_new, (g, rz, r, z, gn, new, gap) in zip(begins, begins[1:], states, states[1:, :n], gx[:, : 2 * n], gx[:, 2 * n :], places):
                if x < y:
                    before = before.copy()
                    before[:n, lane[x:y]] = first[:, x:y]
                np.matmul(u, before, out=g)
                rz += of_rz
                np.exp(rz, out=rz)
                rz += 1
                np.reciprocal(rz, out=rz)
                np.multiply(r, gn, out=new)
                new += of_new
                np.tanh(new, out=new)
                before = before[:n]
                np.subtract(before, new, out=after)
                if keep:
                    gap[...] = after
                    saved.append((before, rz, new, gn, gap))
                after *= z
                after += new
        return states[1:, :n], saved

    def carried(self, docs: list[np.ndarray], piece: int) -> dict[int, np.ndarray]:
        """The states (piece, unit) at the starts of the pieces of each document longer than ``piece``, by its place; the first is zero."""
        n, long = self.lex.config.hidden, [i for i, d in enumerate(docs) if len(d) > piece]
        out = {i: np.zeros((-(-len(docs[i]) // piece), n), np.float32) for i in long}
        if not long:
            return out
        sizes = [(len(docs[i]) - 1) // piece * piece for i in long]  # no piece starts in what follows
        target, doc, lengths = lay_out([docs[i][:size] for i, size in zip(long, sizes)], min(512, max(16, sum(sizes) // max(sizes))))
        read, fresh = self.inputs(target, doc)
        step = np.arange(len(doc), dtype=np.int32)[:, None]
        place = step - np.maximum.accumulate(np.where(fresh, step, 0), axis=0) + 1  # tokens of the document up to here
        ends = (place % piece == 0) & (doc >= 0)
        h, table, at = np.zeros((n, doc.shape[1]), np.float32), self.gates(slice(None)), 0
        while at < len(doc):
            live = int((lengths > at).sum())
            part = slice(at, at + max(16, self.lex.config.score_places // live)), slice(0, live)
            states, _ = self.run(table, read[part], fresh[part], h[:, :live], False)
            h, at = states[-1], part[0].stop
            for t, lane in np.argwhere(ends[part]).tolist():
                i, k = long[doc[part][t, lane]], place[part][t, lane] // piece
                if k < len(out[i]):
                    out[i][k] = states[t, :, lane]
        return out

    def output(self, s: np.ndarray, target: np.ndarray, grad: dict[str, np.ndarray] | None, bounded: bool = False) -> tuple[np.ndarray, np.ndarray | None]:
        """Natural log-probability of each target along its path of classes; optionally gradients.

        ``s``: states as rows with a one appended.  Rows are put in the order of their classes, so that every class's are one block.
        """
        lex, c, p = self.lex, self.lex.config, self.p
        key = lex.key.take(target)
        order = np.argsort(key, kind="stable")
        s, target = s.take(order, axis=0), target.take(order)
        starts = np.searchsorted(key.take(order), np.arange(lex.word_classes + 3))
        ends = starts.tolist()
        cut, n = ends[lex.word_classes], len(target)
        mids = [(k, x, y) for k in range(lex.groups) if (x := ends[k * c.group_size]) < (y := ends[(k + 1) * c.group_size])]
        rules = [(k, x, y) for k in range(2) if (x := ends[lex.word_classes + k]) < (y := ends[lex.word_classes + k + 1])]
        path = [
            ("top", 0, n, [(0, 0, n)], lex.top.take(target)),
            ("mid", 0, cut, mids, target[:cut] // c.class_size % c.group_size),
            ("word", 0, cut, None, target[:cut] % c.class_size),
            ("rule", cut, n, rules, (target[cut:] - lex.dynamic) % RULES),
        ]
        out, back = np.zeros(n, s.dtype), None if grad is None else np.zeros_like(s)
        for name, lo, hi, parts, slot in path:
            if lo == hi:
                if grad is not None:
                    grad[name][...] = 0
                continue
            w = p[name]
            if parts is None:
                classes, firsts, rows, at = self.blocks(starts[: lex.word_classes + 1], hi)
                mine, theirs = s.take(rows, axis=0).reshape(len(classes), -1, s.shape[1]), w.take(classes, axis=0)
                e = np.matmul(mine, theirs).reshape(-1, w.shape[2])
            else:
                at, e = np.arange(hi - lo), np.empty((hi - lo, w.shape[2]), s.dtype)
                for k, x, y in parts:
                    np.matmul(s[x:y], w[k], out=e[x - lo : y - lo])
            if not bounded:
                np.clip(e, -LARGEST, LARGEST, out=e)
            np.exp(e, out=e)
            total, place = e @ np.ones(e.shape[1], e.dtype), at * e.shape[1] + slot
            out[lo:hi] += np.log(e.take(place) / (total if parts else total.take(at)))
            if grad is not None:
                np.reciprocal(total, out=total)
                if parts is None:  # rows that only fill a block have no part in the gradient
                    kept = np.zeros_like(total)
                    kept[at] = total.take(at)
                    total = kept
                e *= total[:, None]
                e.reshape(-1)[place] -= 1
                grad[name][...] = 0
                if parts is None:
                    e = e.reshape(len(classes), -1, w.shape[2])
                    each = np.matmul(mine.transpose(0, 2, 1), e)
                    grad[name][classes[firsts]] = each[firsts]
                    for x, y in zip(firsts.tolist(), [*firsts[1:].tolist(), len(classes)]):
                        if y - x > 1:
                            np.sum(each[x:y], axis=0, out=grad[name][classes[x]])
                    back[lo:hi] += np.matmul(e, theirs.transpose(0, 2, 1)).reshape(-1, s.shape[1]).take(at, axis=0)
                    continue
                for k, x, y in parts:
                    d = e[x - lo : y - lo]
                    np.matmul(s[x:y].T, d, out=grad[name][k])
                    back[x:y] += np.matmul(d, w[k].T)
        place = np.empty_like(order)
        place[order] = np.arange(n)
        return out.take(place), None if back is None else back.take(place, axis=0)

    @staticmethod
    def blocks(starts: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Rows in the order of their classes as blocks of equal length, each of one class, so that one product does them all.

        ``starts``: where each class's rows start, and the end.  The blocks' classes, the first block of each class that has rows, the rows of
        the blocks (repeated where a class's last block isn't full), and the places of the rows in the blocks.
        """
        counts = np.diff(starts)
        number = -(-counts // BLOCK)
        classes = np.repeat(np.arange(len(counts)), number)
        before = np.cumsum(number) - number
        first = starts[classes] + BLOCK * (np.arange(len(classes)) - before[classes])
        all_rows = (first[:, None] + np.arange(BLOCK)).ravel()
        at = np.flatnonzero(all_rows < np.repeat(starts[1:][classes], BLOCK))
        return classes, before[number > 0], np.minimum(all_rows, rows - 1), at

    def backward(self, tokens: np.ndarray, read: np.ndarray, fresh: np.ndarray, saved: list, d_states: np.ndarray, grad: dict[str, np.ndarray]) -> None:
        """Through the window's steps, the last first; no gradient leaves the window.  ``grad["emb"]`` gets a row for each of ``tokens``."""
        p, (steps, n, lanes) = self.p, d_states.shape
        d_g, d_x = np.empty((steps, 3 * n, lanes), d_states.dtype), np.empty((steps, n, lanes), d_states.dtype)
        d_h, back_u, begins, stays = np.zeros((n, lanes), d_states.dtype), np.ascontiguousarray(p["u"].T), fresh.any(axis=1).tolist(), (~fresh).astype(d_states.dtype)
        tmp = np.empty((n, lanes), d_states.dtype)
        for t in range(steps - 1, -1, -1):
            before, rz, new, gn, gap = saved[t]
            r, z, g = rz[:n], rz[n:], d_g[t]
            d_h += d_states[t]
            d_r, d_z, d_u, d_new = g[:n], g[n : 2 * n], g[2 * n :], d_x[t]
            np.multiply(d_h, z, out=tmp)  # d_h * z
            np.subtract(d_h, tmp, out=d_new)  # d_h * (1 - z)
            np.multiply(tmp, gap, out=d_z)
            np.multiply(new, new, out=gap)
            np.subtract(1, gap, out=gap)
            d_new *= gap
            np.subtract(1, z, out=gap)
            d_z *= gap
            np.multiply(d_new, r, out=d_u)
            np.subtract(1, r, out=gap)
            np.multiply(d_u, gap, out=d_r)
            d_r *= gn
            d_h = back_u @ g
            d_h += tmp
            if begins[t]:
                d_h *= stays[t]
        grad["u"][...] = np.matmul(d_g, np.stack([x[0] for x in saved]).transpose(0, 2, 1)).sum(axis=0)
        sums = d_g.sum(axis=(0, 2))
        grad["bu"][...] = sums
        d_g[:, 2 * n :] = d_x
        flat = np.ascontiguousarray(d_g.transpose(0, 2, 1)).reshape(-1, 3 * n)
        flat_read = read.ravel()
        emb = p["emb"].take(tokens, axis=0)
        np.matmul(emb.take(flat_read, axis=0).T, flat, out=grad["wx"])
        grad["bx"][: 2 * n], grad["bx"][2 * n :] = sums[: 2 * n], flat[:, 2 * n :].sum(axis=0)
        per_row, width = flat @ p["wx"].T, emb.shape[1]
        places = (flat_read[:, None] * width + np.arange(width)).ravel()
        grad["emb"] = np.bincount(places, per_row.ravel(), emb.size).reshape(emb.shape).astype(flat.dtype)


def as_rows(states: np.ndarray, use: np.ndarray) -> np.ndarray:
    """The states of the used steps and lanes as rows, with a one appended."""
    steps, n, lanes = states.shape
    s = np.empty((steps, lanes, n + 1), states.dtype)
    s[:, :, :n] = states.transpose(0, 2, 1)
    s[:, :, n] = 1
    s = s.reshape(-1, n + 1)
    return s if use.all() else s.take(np.flatnonzero(use), axis=0)


class Trainer:
    """Adagrad over windows of lanes."""

    def __init__(self, lex: Lexicon, flat: np.ndarray, squares: np.ndarray):
        self.net, self.c, self.squares = Network(lex, flat), lex.config, squares
        #: The embeddings come first in the vector; only those read in a window have a gradient.
        self.inner = self.net.p["emb"].size
        self.flat_grad = np.zeros_like(flat)
        self.grad, self.seen = views(self.flat_grad, lex), views(squares, lex)["emb"]
        self.rng, self.tokens, self.log_likelihood = np.random.default_rng(lex.config.seed), 0, 0.0

    def fit(self, docs: list[np.ndarray]) -> None:
        """Documents that would fill much of a lane are learned from in pieces, each from the state and word before it, so that lanes end together."""
        c, net, size = self.c, self.net, sum(map(len, docs))
        lanes = min(c.lanes, max(c.least_lanes, size // c.lane_tokens))
        piece = max(8 * c.window, size // (8 * lanes))
        carried, zero = net.carried(docs, piece), np.zeros((1, c.hidden), np.float32)
        starts = np.concatenate([carried.get(i, zero) for i in range(len(docs))] + [zero])  # the last: of places without a document
        before = np.array([d[at - 1] if at else net.end for d in docs for at in range(0, len(d), piece)] + [net.end], np.int32)
        target, doc, lengths = lay_out([d[at : at + piece] for d in docs for at in range(0, len(d), piece)], lanes, self.rng)
        read, fresh = net.inputs(target, doc)
        read[fresh] = before[doc[fresh]]
        h, number = np.zeros((c.hidden, target.shape[1]), np.float32), np.zeros(len(net.p["emb"]), np.int64)
        for at in range(0, len(target), c.window):
            live = int((lengths > at).sum())  # the lanes that aren't at their end
            part = slice(at, at + c.window), slice(0, live)
            rows = read[part]
            tokens = np.flatnonzero(np.bincount(rows.ravel(), minlength=len(number)))
            number[tokens] = np.arange(len(tokens))
            rows = number.take(rows)
            states, saved = net.run(net.gates(tokens), rows, fresh[part], h[:, :live], True, (starts, doc[part]))
            h = states[-1]
            use = target[part] >= 0
            n = int(use.sum())
            logp, back = net.output(as_rows(states, use), target[part][use], self.grad)
            self.log_likelihood += float(logp.sum(dtype=np.float64))
            d = np.zeros((*use.shape, c.hidden), np.float32)
            d.reshape(-1, c.hidden)[np.flatnonzero(use)] = back[:, :-1]
            net.backward(tokens, rows, fresh[part], saved, np.ascontiguousarray(d.transpose(0, 2, 1)), self.grad)
            self.step(tokens, n, n / (c.window * len(lengths)))
            self.tokens += n

    def step(self, tokens: np.ndarray, n: int, full: float) -> None:
        """``full``: share of the window's places with a token; a few lanes left over must not steer the weights."""
        g, ge = self.flat_grad[self.inner :], self.grad["emb"]
        norm = math.sqrt(float(g @ g) + float((ge * ge).sum())) / n
        scale, rate = np.float32(min(1.0, 1.0 / (norm + 1e-9)) / n), np.float32(full * self.c.rate)
        for g, weights, squares, at in ((g, self.net.flat[self.inner :], self.squares[self.inner :], slice(None)), (ge, self.net.p["emb"], self.seen, tokens)):
            g *= scale
            total = squares[at] + g * g
            squares[at] = total
            np.sqrt(total, out=total)
            total += np.float32(1e-5)
            g *= rate
            g /= total
            weights[at] -= g


def log10_likelihoods(net: Network, docs: list[np.ndarray]) -> np.ndarray:
    """log10 probability of each document's classes and dynamic words, the state carried from its first token to its end."""
    longest, total = max(map(len, docs), default=1), sum(map(len, docs))
    lanes = int(min(512, max(16, total // max(longest, 1))))
    target, doc, lengths = lay_out(docs, lanes)
    read, fresh = net.inputs(target, doc)
    h, out = np.zeros((net.lex.config.hidden, target.shape[1]), np.float32), np.zeros(len(docs))
    table, bounded, at = net.gates(slice(None)), net.is_bounded(), 0
    while at < len(target):
        live = int((lengths > at).sum())
        steps = max(16, net.lex.config.score_places // live)
        part = slice(at, at + steps), slice(0, live)
        states, _ = net.run(table, read[part], fresh[part], h[:, :live], False)
        h = states[-1]
        use = target[part] >= 0
        logp, _ = net.output(as_rows(states, use), target[part][use], None, bounded)
        out += np.bincount(doc[part][use], logp, len(docs))
        at += steps
    return out / math.log(10)


# ---- on Spark


def held_out(doc_id: Column, mod: int = 7, rest: int = 2) -> Column:
    """Rows that are never learned from; a null id is held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % mod == rest, F.lit(True))


def count_tokens(texts: DataFrame) -> DataFrame:
    """word (the end is the empty word), rule and count over all texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: list[pa.RecordBatch] = []

        def out() -> list[pa.RecordBatch]:
            counts = pa.Table.from_batches(seen).group_by("word", use_threads=False).aggregate([("c", "sum")]).combine_chunks()
            seen.clear()
            return [
                pa.RecordBatch.from_arrays([b["word"], pa.array(rules_of(b["word"]), pa.int32()), b["c_sum"]], names=["word", "rule", "c"]) for b in counts.to_batches()
            ]

        for b in batches:
            for texts in text_slices(b.column(0)):
                counts = words_of_texts(texts)[0].value_counts()
                words, ends = pa.concat_arrays([counts.field(0), pa.array([END.decode()])]), pa.array([len(texts)], pa.int64())
                seen.append(pa.RecordBatch.from_arrays([words, pa.concat_arrays([counts.field(1), ends])], names=["word", "c"]))
                if sum(map(len, seen)) > FLUSH:
                    yield from out()
        if seen:
            yield from out()

    return texts.mapInArrow(run, "word string, rule int, c long").groupBy("word", "rule").agg(F.sum("c").alias("c"))


def lexicon_of(counts: DataFrame, config: Config) -> tuple[Lexicon, int, int]:
    """The bounded head of the counts, with sums over the rest; the number of tokens and of distinct tokens."""
    total = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    candidates = counts.where((F.col("word") != "") & (F.col("c") >= config.min_head_count))
    frequent = most_frequent(candidates, "c", "word", config.head - 1)
    top = frequent.unionByName(counts.where("word = ''")).select("word", "rule", "c").collect()
    top.sort(key=lambda r: (r["word"] != "", -r["c"], r["word"]))
    words, n = [r["word"].encode() for r in top], np.array([r["c"] for r in top], np.float64)
    sums, plain = np.zeros(RULES), np.zeros(RULES)
    for r in counts.groupBy("rule").agg(F.sum("c").alias("c"), F.count(F.lit(1)).alias("n")).collect():
        plain[r["rule"]], sums[r["rule"]] = r["c"], r["c"] + r["n"]
    for r in top:  # the rest is all without the head
        plain[r["rule"]] -= r["c"]
        sums[r["rule"]] -= r["c"] + 1
    return Lexicon(words, n, sums, plain, config), int(total[0]), int(total[1])


TOKENS = "row long, doc_id long, tokens binary, n_known long, base double, fixed double, rare array<string>"


def tokenized(docs: DataFrame, lex: Lexicon) -> DataFrame:
    """Every text's tokens as 32-bit numbers, what is fixed about it, and its rare words; ``row`` names the row."""
    shared = docs.sparkSession.sparkContext.broadcast(lex)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        mine, row = shared.value, TaskContext.get().partitionId() << 40
        head = pa.array([w.decode() for w in mine.words], pa.string())
        for b in batches:
            at = 0
            for texts in text_slices(b.column(1)):
                n = len(texts)
                tokens, known, logs, fixed, rare = mine.read_all(texts, head)
                cols = [pa.array(np.arange(row, row + n), pa.int64()), b.column(0).slice(at, n), tokens, known, logs, fixed, rare]
                row, at = row + n, at + n
                yield pa.RecordBatch.from_arrays(cols, names=["row", "doc_id", "tokens", "n_known", "base", "fixed", "rare"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text")).mapInArrow(run, TOKENS)


def _average(rows: DataFrame) -> np.ndarray:
    """Vectors averaged by tokens: within groups of tasks, then over the groups; parts of the vector apart."""

    def mean(pdf: pd.DataFrame) -> pd.DataFrame:
        tokens = float(pdf["tokens"].sum())
        total = sum(np.frombuffer(v, np.float32) * np.float64(t / tokens) for v, t in zip(pdf["vector"], pdf["tokens"]))
        return pd.DataFrame({"part": [pdf["part"].iloc[0]], "task": [0], "tokens": [tokens], "vector": [np.asarray(total, np.float32).tobytes()]})

    schema = "part int, task int, tokens double, vector binary"
    for keys in (["part", F.col("task") % AVERAGE_FAN], ["part"]):
        rows = rows.groupBy(*keys).applyInPandas(mean if len(keys) == 1 else lambda key, pdf: mean(pdf), schema)
    parts = {r["part"]: np.frombuffer(r["vector"], np.float32) for r in rows.select("part", "vector").collect()}
    return np.concatenate([parts[i] for i in sorted(parts)]) if parts else np.empty(0, np.float32)


def fit(train: DataFrame, lex: Lexicon) -> np.ndarray:
    """The weights, learned from all rows of ``train`` (row and tokens, as of ``tokenized``)."""
    c, flat = lex.config, initial(lex)
    squares, sc = np.zeros_like(flat), train.sparkSession.sparkContext
    shared = sc.broadcast(lex)
    for r in range(c.rounds):
        start = sc.broadcast((flat, squares))

        def run(batches: Iterator[pa.RecordBatch], start=start, first=c.first_tokens if r == 0 else c.fit_tokens) -> Iterator[pa.RecordBatch]:
            from pyspark import TaskContext

            mine, (flat, squares) = shared.value, start.value
            trainer, most = Trainer(mine, flat.copy(), squares.copy()), first
            docs, size = [], 0
            for b in batches:
                for t in b.column(0):
                    docs.append(np.frombuffer(t.as_buffer(), np.int32))
                    size += len(docs[-1])
                    if size > most:
                        trainer.fit(docs)
                        docs, size, most = [], 0, min(2 * most, mine.config.fit_tokens)
            if docs:
                trainer.fit(docs)
            if trainer.tokens:
                cut = np.array_split(np.concatenate((trainer.net.flat, trainer.squares)), PARTS)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(range(PARTS), pa.int32()), pa.array([TaskContext.get().partitionId()] * PARTS, pa.int32()), pa.array([float(trainer.tokens)] * PARTS), pa.array([x.tobytes() for x in cut], pa.binary())],
                    names=["part", "task", "tokens", "vector"],
                )

        turn = train.where(F.pmod(F.xxhash64("row"), F.lit(c.rounds)) == r).select("tokens")
        trained = materialize(turn.mapInArrow(run, "part int, task int, tokens double, vector binary"), f"lm-round-{r}")
        mean = _average(trained)
        if len(mean):
            flat, squares = np.split(mean, 2)
    return flat


def score(read: DataFrame, lex: Lexicon, flat: np.ndarray, counts: DataFrame, n_tokens: int, distinct: int) -> DataFrame:
    """doc_id, n_tokens, n_known, base_score and score of every row of ``read`` (as of ``tokenized``)."""
    shared = read.sparkSession.sparkContext.broadcast((lex, flat))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine, flat = shared.value
        net = Network(mine, flat)
        rows: list[int] = []
        docs: list[np.ndarray] = []
        size = 0

        def out() -> pa.RecordBatch:
            cols = [pa.array(rows, pa.int64()), pa.array([len(x) for x in docs], pa.int64()), pa.array(log10_likelihoods(net, docs), pa.float64())]
            return pa.RecordBatch.from_arrays(cols, names=["row", "n_tokens", "score"])

        for b in batches:
            for i, t in zip(b.column(0).to_pylist(), b.column(1)):
                rows.append(i)
                docs.append(np.frombuffer(t.as_buffer(), np.int32))
                size += len(docs[-1])
                if size > mine.config.score_tokens:
                    yield out()
                    rows, docs, size = [], [], 0
        if rows:
            yield out()

    scored = materialize(read.select("row", "tokens").mapInArrow(run, "row long, n_tokens long, score double"), "lm-scored")
    # Rare words meet their counts; each is at most as frequent as the head's last word.
    rare = read.select("row", F.explode("rare").alias("word")).join(counts.select("word", "c").hint("merge"), "word")
    rare = rare.groupBy("row").agg(F.sum(F.log10(F.col("c") + 1)).alias("more"), F.count(F.lit(1)).alias("known"))
    per_token = math.log10(n_tokens + distinct + 1)
    more = F.coalesce("more", F.lit(0.0))
    rows = read.drop("tokens", "rare").join(scored.hint("merge"), "row").join(rare.hint("merge"), "row", "left")
    return rows.select(
        "doc_id", "n_tokens", (F.col("n_known") + F.coalesce("known", F.lit(0))).alias("n_known"),
        (F.col("base") + more - per_token * F.col("n_tokens")).alias("base_score"), (F.col("score") + F.col("fixed") + more).alias("score"),
    )


def op1_language_model(spark: SparkSession, sf_dir: str, config: Config = Config()) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    learned = ~held_out(F.col("doc_id"))
    counts = materialize(count_tokens(docs.where(learned).select(text_or_empty().alias("text"))), "lm-counts")
    lex, n_tokens, distinct = lexicon_of(counts, config)
    read = materialize(tokenized(docs, lex), "lm-tokens")
    rows = score(read, lex, fit(read.where(learned), lex), counts, n_tokens, distinct)
    return rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "n_tokens", "n_known", F.lit(n_tokens).cast("long").alias("train_tokens"), "base_score", "score")
