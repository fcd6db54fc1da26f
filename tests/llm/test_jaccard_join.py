"""The token-group matrix join against comparing all pairs."""

from __future__ import annotations

import random
import re

import pytest

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text):
    words = WORDS.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))} if words else set()


def brute(rows):
    """(doc_id, n_shingles, component_id) by all pairs."""
    sets = [shingles(t) for _, t in rows]
    label = list(range(len(rows)))
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and label[i] != label[j] and 100 * len(a & b) >= 85 * len(a | b):
                old, new = label[i], label[j]
                label = [new if x == old else x for x in label]
    least = {}
    for (i, _), k in zip(rows, label):
        if i is not None:
            least[k] = min(least.get(k, i), i)
    return sorted(((i, len(s), least.get(k) if s else i) for (i, _), s, k in zip(rows, sets, label)), key=str)


def found(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in df.collect()), key=str)


def words(rng, n, vocabulary=5000):
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


def edited(rng, base, edits):
    out = list(base)
    for _ in range(edits):
        out[rng.randrange(len(out))] = f"e{rng.randrange(10**9)}"
    return out


def family(rng, size, length, edits):
    """A base and copies with up to ``edits`` words changed, some of copies, around the bound."""
    base = words(rng, length)
    made = [base]
    for _ in range(size):
        made.append(edited(rng, rng.choice(made) if rng.random() < 0.3 else base, rng.randrange(edits + 1)))
    return [" ".join(m) for m in made]


def mixed(seed):
    rng = random.Random(seed)
    passage = words(rng, 60)
    texts = [t for length, edits in ((8, 1), (30, 2), (100, 5), (400, 18), (3000, 100)) for _ in range(3) for t in family(rng, 12, length, edits)]
    texts += family(rng, 220, 90, 5)  # more than a group holds
    texts += [" ".join(words(rng, rng.randrange(20, 200)) + passage) for _ in range(60)]
    texts += [" ".join(passage + words(rng, k % 4)) for k in range(8)]
    texts += [t.upper() + " \n" for t in texts[:40]] + ["one two three", "One two  three", "one two", "", None, " \t", None] * 3
    rng.shuffle(texts)
    return [(i if i % 97 else None, t) for i, t in enumerate(texts)]


@pytest.mark.parametrize(("seed", "tokens"), [(1, None), (2, 2000)])
def test_equals_all_pairs(spark, tmp_path, seed, tokens, monkeypatch):
    """With one group for all, and with many small ones."""
    from pyspark.sql import functions as F

    from tidemark.llm import jaccard_join
    from tidemark.llm.registry import QUERIES

    if tokens:
        monkeypatch.setattr(jaccard_join, "GROUP_TOKENS", tokens)
        monkeypatch.setattr(jaccard_join, "QUERIES", 20)

    rows = mixed(seed)
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit("x") for c in ("key", "token", "group", "tokens", "n", "first", "prefix")})
    df.repartition(5).write.parquet(f"{tmp_path}/documents.parquet")
    assert found(QUERIES["op13_jaccard_join"](spark, str(tmp_path))) == brute(rows)


def test_whole_table(spark):
    from tidemark.llm.registry import QUERIES

    d = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{d}/documents.parquet").collect()]
    assert found(QUERIES["op13_jaccard_join"](spark, d)) == brute(rows)


def test_repeated_ids_and_empty_table(spark, docs, no_docs):
    from tidemark.llm.jaccard_join import cluster

    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert found(cluster(docs)) == brute(rows)
    assert cluster(no_docs).count() == 0
    twice = [(1, "a b c d e f g h"), (1, "other words that have nothing in common"), (0, "a b c d e f g h")]
    assert found(cluster(spark.createDataFrame(twice, "doc_id long, text string"))) == brute(twice)


def test_few_groups_are_opened(spark):
    """Classes that are connected already ask for nothing; those that share a passage only don't have the overlap."""
    from tidemark.llm import jaccard_join as j

    rng = random.Random(5)
    passage = words(rng, 60)
    texts = family(rng, 300, 80, 2) + [" ".join(words(rng, 200) + passage) for _ in range(300)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    made = []
    real = j.matrix_requests
    j.matrix_requests = lambda *a: made.append(real(*a)) or made[-1]
    try:
        assert j.cluster(df).count() == len(texts)
    finally:
        j.matrix_requests = real
    assert made[0].count() < 2 * len(texts)
    passages = {j.key_of(j.Rule().tokens(t)) for t in texts[301:]}
    assert not {bytes(r.key) for r in made[0].collect()} & passages


def test_sets_that_share_with_other_sizes_only_are_not_made(spark):
    """Long texts are made of short ones; a pair at the bound of sizes, 17 and 20 shingles, is linked."""
    from tidemark.llm import jaccard_join as j

    rng = random.Random(11)
    texts = []
    for _ in range(6):
        short = [" ".join(words(rng, 20, 10**9)) for _ in range(8)]
        texts += [*short, " ".join(short)]
    base = words(rng, 23, 10**9)
    pair = [" ".join(base[:20]), " ".join(base)]
    df = spark.createDataFrame(list(enumerate(texts + pair)), "doc_id long, text string")
    made = []
    real = j.token_sets
    j.token_sets = lambda docs, classes, rule: made.append(classes) or real(docs, classes, rule)
    try:
        rows = j.cluster(df).collect()
    finally:
        j.token_sets = real
    assert {bytes(r.key) for r in made[0].collect()} == {j.key_of(j.Rule().tokens(t)) for t in pair}
    assert {r.doc_id: r.component_id for r in rows} == {i: min(i, len(texts)) for i in range(len(texts) + 2)}


def test_opened_group_compares_exactly():
    import numpy as np

    from tidemark.llm.jaccard_join import OpenGroup, Rule

    rng = np.random.default_rng(3)
    sets = [np.unique(rng.choice(60, size, replace=False).astype(np.uint64)) for size in rng.integers(1, 50, 40)] + [np.arange(20, dtype=np.uint64)]
    group = OpenGroup(sets, Rule())
    for q in [*sets, np.arange(23, dtype=np.uint64), np.array([1000], np.uint64)]:
        want = [k for k, s in enumerate(sets) if 100 * len(set(s) & set(q)) >= 85 * len(set(s) | set(q))]
        assert group.linked(q).tolist() == want
