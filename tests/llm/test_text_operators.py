"""Small cases of the operators on documents, against plain Python."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from .conftest import ROWS

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


# ---- exact dedup


def test_dedup_keeps_the_largest_id(spark, docs):
    from tidemark.llm.exact_dedup import dedup

    got = Counter((r.doc_id, r.keep_id, r.group_size, r.kept) for r in dedup(docs).collect())
    groups = defaultdict(list)
    for i, text, *_ in ROWS:
        groups[text or ""].append(i)
    want = Counter()
    for ids in groups.values():
        keep = max((i for i in ids if i is not None), default=None)
        want.update((i, keep, len(ids), i == keep) for i in ids)
    assert got == want


def test_dedup_index_is_persistent_and_idempotent(spark, docs, no_docs):
    from tidemark.llm.exact_dedup import DigestIndex, dedup

    index = DigestIndex.temporary(spark, buckets=4)
    first = sorted(map(tuple, dedup(docs.where("doc_id < 5"), index, "a").collect()), key=repr)
    n = index.read().count()
    assert sorted(map(tuple, dedup(docs.where("doc_id < 5"), index, "a").collect()), key=repr) == first
    assert index.read().count() == n
    more = {r.doc_id: r for r in dedup(docs, index, "b").collect()}
    assert more[9].kept and more[1].keep_id == 2 and not more[1].kept
    assert dedup(no_docs, index, "c").count() == 0


# ---- quality rules


def repeated(words):
    at = defaultdict(list)
    for i in range(len(words) - 4):
        at[tuple(words[i : i + 5])].append(i)
    return len({k for v in at.values() if len(v) > 1 for i in v for k in range(i, i + 5)})


def test_quality_counts(spark, docs, no_docs):
    from tidemark.llm.quality_rules import judge

    want = Counter()
    for i, text, *_ in ROWS:
        t = text or ""
        w = WORD.findall(t)
        lines = [x for x in t.split("\n") if WORD.search(x)]
        r = repeated(w)
        want[(i, len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), r, len(w) < 10 or 100 * r > 20 * len(w))] += 1
    got = judge(docs)
    assert Counter((r[0], *r[1:7]) for r in got.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed").collect()) == want
    assert judge(no_docs).count() == 0


def test_quality_repeats_random(spark):
    from tidemark.llm.quality_rules import judge

    rng = random.Random(3)
    texts = [" ".join(rng.choice("ab") for _ in range(rng.randint(0, 40))) + "\n" * rng.randint(0, 2) for _ in range(200)]
    df = spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts)], "doc_id long, text string, lang string")
    for r in judge(df).collect():
        assert r.n_repeat_words == repeated(WORD.findall(texts[r.doc_id])), texts[r.doc_id]


def test_quality_divergence_rejects_other_histograms(spark):
    from tidemark.llm.quality_rules import judge

    rng = random.Random(5)
    prose = lambda: " ".join(rng.choice(["the", "of", "and", "house", "tree", "river", "in", "walk", "to", "green"]) for _ in range(120))
    rows = [(i, prose(), "en") for i in range(40)] + [(99, " ".join("ZQX%d" % rng.randint(0, 10**6) for _ in range(120)), "en")]
    kept = {r.doc_id: r.kept for r in judge(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert not kept[99] and all(kept[i] for i in range(40))


# ---- simhash


def slow_fingerprint(text):
    import xxhash

    w = WORD.findall(lower(text or ""))
    shingles = [" ".join(w[k : k + 3]) for k in range(max(1, len(w) - 2))] if w else []
    ones = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s.encode(), 42)
        for b in range(64):
            ones[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * ones[b] > len(shingles))


def slow_components(prints):
    parent = {p: p for p in prints}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in prints:
        for b in prints:
            if (a ^ b).bit_count() <= 2:
                parent[max(find(a), find(b))] = min(find(a), find(b))
    return {p: find(p) for p in prints}


def test_simhash_fingerprints_and_ids(spark, docs, no_docs):
    from tidemark.llm.simhash import cluster

    rows = cluster(docs).collect()
    assert Counter((r.doc_id, r.fp % 2**64) for r in rows) == Counter((i, slow_fingerprint(t)) for i, t, *_ in ROWS)
    assert {r.component_id for r in rows if r.fp == 0} == {3}
    assert cluster(no_docs).count() == 0


@pytest.mark.parametrize("deal_over", [20_000, 8])
def test_simhash_links_every_pair(spark, monkeypatch, deal_over):
    from tidemark.llm import simhash
    from tidemark.llm.components import components

    monkeypatch.setattr(simhash, "DEAL_OVER", deal_over)
    monkeypatch.setattr(simhash, "LEAF_PAIRS", 4)
    rng = random.Random(deal_over)
    prints = set()
    for _ in range(25):
        p = rng.getrandbits(64)
        for _ in range(rng.randint(1, 30)):
            prints.add(p)
            for _ in range(rng.randint(1, 3)):
                p ^= 1 << rng.randrange(64)
    signed = lambda p: p - 2**64 if p >= 2**63 else p
    df = spark.createDataFrame([(signed(p),) for p in prints], "fp long")
    got = {r.node: r.root for r in components(simhash.link_fingerprints(df)).collect()}
    want = slow_components(prints)
    by = defaultdict(set)
    for p in prints:
        by[want[p]].add(signed(p))
    for group in by.values():
        assert {got.get(p, p) for p in group} == {min(group)}


def edited(rng, words, share):
    return [f"new{rng.randrange(10**9)}" if rng.random() < share else w for w in words]


@pytest.mark.parametrize("seed", [4, 5])
def test_near_groups_equal_all_pairs(spark, seed):
    """Families of edited texts, one of them large, in any order: exactly the pairs at 0.8 or more link."""
    from tidemark.llm import near_duplicates as nd

    rng, texts = random.Random(seed), []
    for size in (8,) * 12 + (250,):
        base = [f"w{rng.randrange(10**6)}" for _ in range(rng.randint(20, 300))]
        texts += [base, *(edited(rng, base, rng.choice([0.005, 0.01, 0.02, 0.05, 0.3])) for _ in range(size))]
    rows = list(enumerate(" ".join(t) for t in texts))
    grams = [{tuple(t[k : k + 5]) for k in range(max(1, len(t) - 4))} for t in texts]
    label = list(range(len(texts)))
    for a in range(len(texts)):
        for b in range(a):
            if label[a] != label[b] and 100 * len(grams[a] & grams[b]) >= 80 * len(grams[a] | grams[b]):
                old, new = max(label[a], label[b]), min(label[a], label[b])
                label = [new if x == old else x for x in label]
    rng.shuffle(rows)
    got = {r.doc_id: r.component_id for r in nd.near_groups(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect()}
    assert got == dict(enumerate(label))


def test_near_groups_of_odd_texts(spark, docs, no_docs):
    from tidemark.llm import near_duplicates as nd

    rows = nd.near_groups(docs).collect()
    assert Counter(r.doc_id for r in rows) == Counter(i for i, *_ in ROWS)
    wordless = [i for i, t, *_ in ROWS if not (t or "").split()]
    assert {r.component_id for r in rows if r.doc_id in wordless} == {min(i for i in wordless if i is not None)}
    assert nd.near_groups(no_docs).count() == 0


def test_components_of_long_paths(spark):
    from tidemark.llm.components import components

    edges = [(i, i + 1) for i in range(0, 300)] + [(1000 + i, 1000) for i in range(200)] + [(5, 5)]
    random.Random(1).shuffle(edges)
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert all(got[i] == 0 for i in range(1, 301)) and all(got[1000 + i] == 1000 for i in range(1, 200)) and 0 not in got


# ---- tokenizer and packing


@pytest.fixture(scope="session")
def tokenizer():
    from tokenizers import Tokenizer

    from tidemark.llm.bpe import default_path

    return Tokenizer.from_file(default_path())


def test_bpe_equals_the_library(tokenizer):
    from tidemark.llm.bpe import Encoder, compile_lexicon, default_path

    rng = random.Random(1)
    letters = [*"ab c\n\t  '’sté ıñ中文😀  \x1c\x85\x1f012²Ⅷ½٣!?.,-_<|>", "<|endoftext|>", "'ll", "   ", "\r\n", "aaaaaaaa", "the the"]
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 60))) for _ in range(1500)] + ["", "a" * 3000, "ab" * 3000 + " x"]
    plain = Encoder(default_path())
    words = sorted({w.encode() for t in texts[:300] for w in plain.words.findall(t)})
    ids, counts = plain.encode_words(words)
    compiled = compile_lexicon(dict(zip(words, np.split(ids, np.cumsum(counts)[:-1]))))
    for encoder in (plain, Encoder(default_path(), compiled)):
        for text, got, want in zip(texts, encoder.encode(texts), tokenizer.encode_batch(texts, add_special_tokens=False)):
            assert got.tolist() == want.ids, text
            assert encoder.vocabulary.decode(got) == tokenizer.decode(want.ids, skip_special_tokens=False)


def test_lexicon_is_minimal_and_ranks_words():
    from tidemark.llm.bpe import Lexicon, compile_lexicon

    words = [b"walked", b"talked", b"walks", b"talks", b"walking", b"talking", b"a"]
    lexicon = Lexicon(compile_lexicon({w: np.array([i]) for i, w in enumerate(words)}))
    ranks = lexicon.rank([*words, b"", b"walk", b"walkedx", b"zz"])
    assert sorted(ranks[:7]) == list(range(7)) and (ranks[7:] == -1).all()
    assert [int(lexicon.ids[lexicon.offsets[r]]) for r in ranks[:7]] == list(range(7))
    assert len(lexicon.keys) < sum(map(len, words)) / 2  # suffixes are shared


def test_bpe_digests(spark, docs, no_docs, tokenizer):
    from tidemark.llm.bpe import build_lexicon, decode, default_path, digests, encode

    path = default_path()
    lexicon = build_lexicon(docs, path, 100)
    want = Counter()
    for i, text, *_ in ROWS:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids
        want[(i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest())] += 1
    assert Counter(map(tuple, digests(docs, path, lexicon).collect())) == want
    assert Counter(map(tuple, decode(encode(docs, path, lexicon), path).collect())) == Counter((i, t or "") for i, t, *_ in ROWS)
    assert digests(no_docs, path, build_lexicon(no_docs, path)).count() == 0


def test_packing_covers_every_id(spark, docs, no_docs, tokenizer):
    from tidemark.llm.packing import cuts, default_path, pack

    assert all(sum(cuts(n)) == n and max(cuts(n)) <= 1024 for n in range(1, 3000))
    rows = pack(docs.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"]), default_path()).collect()
    ids = {i: np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 0], "<u4") for i, t, *_ in ROWS if i is not None}
    at = defaultdict(int)
    for r in sorted(rows, key=lambda r: (r.doc_id, r.start)):
        assert r.start == at[r.doc_id] and r.doc_tokens == len(ids[r.doc_id])
        assert r.ids_crc32 == zlib.crc32(ids[r.doc_id][r.start : r.start + r.length].tobytes())
        at[r.doc_id] += r.length
    assert at == {i: len(x) for i, x in ids.items()}
    filled = defaultdict(int)
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == filled[r.sequence_id]
        filled[r.sequence_id] += r.length
    assert max(filled.values()) <= 1024
    assert pack(no_docs, default_path()).count() == 0


def test_packer_fills_bins_by_count():
    from tidemark.llm.packing import Packer, cuts

    rng, packer, rows = random.Random(2), Packer(0), []
    for d in range(3000):
        for n in cuts(rng.randint(1, 2500)):
            rows += packer.add((d, 0, n, range(n)))
    rows += packer.finish()
    used = Counter()
    for p, s, _ in rows:
        used[s] += p[2]
    assert max(used.values()) <= 1024
    assert sum(1024 - n for n in used.values()) < 0.02 * sum(used.values())


# ---- toxicity


def test_folding():
    from tidemark.llm.toxicity import fold

    assert fold("An IDI0T!! and 1d1ot, сlown ｗorthless s t u p i d") == "an idiot and idiot clown worthless stupid"
    assert fold("  in 2000 \n v1.2 ") == "in 2000 v1.2"
    assert fold("") == ""


def test_toxicity_learns_and_spares_exceptions(spark, docs, no_docs):
    from pyspark.sql import functions as F

    from tidemark.llm.toxicity import Learning, Lexicon, fit, score

    rng = random.Random(4)
    plain = [f"{rng.choice('abcdefgh')}{rng.choice('klmnop')}o" for _ in range(60)]
    text = lambda bad: " ".join([*(rng.choice(plain) for _ in range(30)), *(["vermin"] * bad)])
    rows = [(i, text(i % 3 == 0), int(i % 3 == 0)) for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    lexicon = fit(df.drop("toxic"), df.drop("text"), Learning())
    assert set(lexicon.weights) == {"vermin "}
    got = {r.doc_id: r.predicted for r in score(df, lexicon).collect()}
    assert got == {i: t for i, _, t in rows}
    spared = Lexicon(lexicon.weights, lexicon.coef, ("vermin control",))
    a = spared.automaton()
    assert spared.measure(a, "the vermin control man")[0] == 0 < spared.measure(a, "the vermin man v3rm1n")[0]
    rows = score(docs, lexicon).collect()
    assert len(rows) == len(ROWS) and all(0 <= r.score <= 1 for r in rows)
    assert score(no_docs, fit(no_docs, df.select("doc_id", F.lit(None).cast("int").alias("toxic")))).count() == 0


def test_toxicity_measure_equals_a_plain_scan():
    """Every word against every entry, every hit against every phrase; a long text repeats phrases."""
    from tidemark.llm.toxicity import Lexicon, fold

    rng = random.Random(9)
    lexicon = Lexicon({"ab ": 1.0, "abc": 2.5, "b": 0.5, "moron ": 3.0, "trash ": 1.5}, (0.0, 1.0, 1.0, 1.0), ("moron mountain", "the abc b", "trash can"))
    words = ["ab", "abc", "abcd", "b", "ba", "moron", "M0RON", "mountain", "the", "trash", "can", "x", "IDI0T,", "аb"]
    texts = ["", " ", *(" ".join(rng.choice(words) for _ in range(rng.randint(1, 40))) for _ in range(300))]
    texts.append("moron mountain trash can trash " * 60_000)
    a = lexicon.automaton()
    for text in texts:
        found = fold(text).split()
        at, hits = 0, []
        line = f" {fold(text)} "
        spans = [(i, i + len(p) + 1) for p in lexicon.exceptions for i in range(len(line)) if line.startswith(f" {p} ", i)] if len(text) < 1000 else None
        for w in found:
            matched = [v for term, v in lexicon.weights.items() if (w == term[:-1] if term[-1] == " " else w.startswith(term))]
            if matched and not (any(x <= at < y for x, y in spans) if spans is not None else w == "moron" or (w == "trash" and line.startswith(" trash can ", at))):
                hits.append(max(matched))
            at += len(w) + 1
        total, top, n = lexicon.measure(a, text)
        assert (pytest.approx(sum(hits)), max(hits, default=0.0), len(found)) == (total, top, n)


def test_toxicity_keeps_rare_terms_among_many_common_ones(spark):
    from itertools import product

    from tidemark.llm.toxicity import Learning, fit

    common = " ".join(map("".join, product("abcdefghi", repeat=5)))  # 59,049 words, each in more toxic documents than the insult
    rows = [(i, common + " vermin" * (i < 4), int(i < 5)) for i in range(12)]
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    assert set(fit(df.drop("toxic"), df.drop("text"), Learning()).weights) == {"vermin "}


# ---- language model


def tiny():
    from tidemark.llm.language_model import END, RULES, Config, Lexicon

    words = [END, *(bytes([97 + i % 26, 98 + i // 26]) for i in range(30))]
    config = Config(head=40, dynamic=10, class_size=2, group_size=3, hidden=5, embedding=3, lanes=3, window=6, least_lanes=3)
    return Lexicon(words, np.arange(40, 9, -1).astype(float), np.ones(RULES) * 5, np.ones(RULES) * 3, config)


def plain_log10(lex, p, tokens):
    """The model's log10 probability of one document, a token at a time, in plain loops."""
    from tidemark.llm.language_model import RULES

    c = lex.config
    sig = lambda x: 1 / (1 + np.exp(-x))
    share = lambda w, s, i: float(np.log10(np.exp(s @ w)[i] / np.exp(s @ w).sum()))
    h, read, total, n = np.zeros(c.hidden), 0, 0.0, c.hidden
    for t in tokens:
        x, g = p["emb"][read] @ p["wx"] + p["bx"], p["u"] @ h + p["bu"]
        r, z = sig(x[:n] + g[:n]), sig(x[n : 2 * n] + g[n : 2 * n])
        h = (1 - z) * np.tanh(x[2 * n :] + r * g[2 * n :]) + z * h
        s = np.append(h, 1)
        if t < lex.dynamic:
            group, cls = t // (c.class_size * c.group_size), t // c.class_size
            total += share(p["top"][0], s, group) + share(p["mid"][group], s, cls % c.group_size) + share(p["word"][cls], s, t % c.class_size)
        else:
            tier, k = divmod(t - lex.dynamic, RULES)
            total += share(p["top"][0], s, lex.groups + tier) + share(p["rule"][tier], s, k)
        read = t
    return total


def test_gradients():
    from tidemark.llm.language_model import RULES, Network, as_rows, initial, lay_out, views

    lex = tiny()
    flat = initial(lex).astype(np.float64)
    net, rng = Network(lex, flat), np.random.default_rng(0)
    target, doc, _ = lay_out([rng.integers(0, lex.dynamic + 2 * RULES, n) for n in (4, 7, 5, 3)], 3)
    read, fresh = net.inputs(target, doc)
    use, tokens = target >= 0, np.arange(lex.dynamic + 2 * RULES)
    grad = views(np.zeros_like(flat), lex)

    def states(keep):
        return net.run(net.gates(tokens), read, fresh, np.zeros((5, target.shape[1])), keep)

    def loss():
        return -net.output(as_rows(states(False)[0], use), target[use], None)[0].sum()

    s, saved = states(True)
    d = np.zeros((*use.shape, 5))
    d[use] = net.output(as_rows(s, use), target[use], grad)[1][:, :-1]
    net.backward(tokens, read, fresh, saved, np.ascontiguousarray(d.transpose(0, 2, 1)), grad)
    for k, w in net.p.items():
        for _ in range(8):
            i = tuple(rng.integers(0, n) for n in w.shape)
            old = w[i]
            w[i] = old + 1e-3
            up = loss()
            w[i] = old - 1e-3
            down = loss()
            w[i] = old
            assert (up - down) / 2e-3 == pytest.approx(grad[k][i], rel=1e-3, abs=1e-5)


def test_scores_equal_plain_loops():
    """Whole documents, one of them of a thousand tokens, after a fit."""
    from tidemark.llm.language_model import RULES, Trainer, initial, log10_likelihoods

    lex, rng = tiny(), np.random.default_rng(3)
    docs = [rng.integers(0, lex.dynamic + 2 * RULES, n) for n in (50, 7, 1000, 1, 33)]
    flat = initial(lex)
    trainer = Trainer(lex, flat, np.zeros_like(flat))
    trainer.fit(docs)
    assert trainer.tokens == sum(map(len, docs))
    p = {k: v.astype(float) for k, v in trainer.net.p.items()}
    assert np.allclose(log10_likelihoods(trainer.net, docs), [plain_log10(lex, p, d.tolist()) for d in docs], rtol=1e-4)


def test_training_carries_the_state_through_whole_documents(monkeypatch):
    """With a rate of zero a fit's likelihood is that of whole documents, though long ones are learned in pieces; so is the state at token 1,000."""
    from dataclasses import replace

    from tidemark.llm.language_model import RULES, Network, Trainer, as_rows, initial, lay_out, log10_likelihoods

    lex, rng = tiny(), np.random.default_rng(5)
    lex.config = replace(lex.config, rate=0.0, score_places=700)
    docs = [rng.integers(0, lex.dynamic + 2 * RULES, n).astype(np.int32) for n in (50, 7, 3000, 1, 33, 1500, 128, 900)]
    flat = initial(lex)
    trainer = Trainer(lex, flat.copy(), np.zeros_like(flat))
    pieces = []
    monkeypatch.setattr("tidemark.llm.language_model.lay_out", lambda d, *a: pieces.append(len(d)) or lay_out(d, *a))
    trainer.fit(docs)
    assert pieces[-1] > 2 * len(docs)  # there were pieces
    assert trainer.log_likelihood / np.log(10) == pytest.approx(log10_likelihoods(Network(lex, flat), docs).sum(), rel=1e-5)
    net = Network(lex, flat)
    states = net.carried(docs, 100)
    assert sorted(states) == [2, 5, 6, 7] and len(states[2]) == 30 and len(states[6]) == 2
    read, fresh = net.inputs(docs[2][:, None], np.zeros((3000, 1), np.int32))
    plain, _ = net.run(net.gates(slice(None)), read, fresh, np.zeros((lex.config.hidden, 1), np.float32), False)
    assert np.allclose(states[2][10], as_rows(plain, read >= 0)[999, :-1], atol=1e-5) and not states[2][0].any()


def test_states_of_pieces_need_no_more_than_the_last_start(monkeypatch):
    from tidemark.llm.language_model import Network, initial, lay_out

    lex, rng, walked = tiny(), np.random.default_rng(5), []
    docs = [rng.integers(0, lex.dynamic, n) for n in (100, 101, 200, 299, 40)]
    monkeypatch.setattr("tidemark.llm.language_model.lay_out", lambda d, *a: walked.extend(map(len, d)) or lay_out(d, *a))
    states = Network(lex, initial(lex)).carried(docs, 100)
    assert walked == [100, 100, 200] and {i: len(x) for i, x in states.items()} == {1: 2, 2: 2, 3: 3}
    assert all(x[1:].any(axis=1).all() and not x[0].any() for x in states.values())


def test_classes_of_words_in_blocks_have_the_same_gradients(monkeypatch):
    from tidemark.llm import language_model as lm

    lex, rng = tiny(), np.random.default_rng(6)
    flat = lm.initial(lex).astype(np.float64)
    target = rng.integers(0, lex.dynamic + 2 * lm.RULES, 300)
    s = np.append(rng.normal(size=(300, 5)), np.ones((300, 1)), 1)
    found = []
    for size in (1, 7, 1000):
        monkeypatch.setattr(lm, "BLOCK", size)
        grad = lm.views(np.full_like(flat, 9.0), lex)
        found.append([*lm.Network(lex, flat).output(s, target, grad), *(grad[k] for k in ("top", "mid", "word", "rule"))])
    assert all(np.allclose(a, b) for other in found[1:] for a, b in zip(found[0], other))


def test_texts_read_by_columns_are_read_as_one_by_one(monkeypatch):
    import pyarrow as pa

    from tidemark.llm import language_model as lm

    rng = random.Random(9)
    texts = ["", " ", "\n a  B \t", "K İ ß \x85 \u2003x", "9.. é1z 𝄞 日本"] + ["".join(rng.choice("aAzZ09.,éÉñ日𝄞\x1c\x85 \u00a0\t\n\x0b\x0c\r  ") for _ in range(rng.randint(0, 60))) for _ in range(300)]
    seen = Counter(w for t in texts for w in [*lm.words_in(t), lm.END])
    words = [lm.END, *sorted((w for w, n in seen.items() if w and n > 2), key=lambda w: (-seen[w], w))]
    monkeypatch.setattr(lm, "TEXT_AT_ONCE", 500)
    for some in (words, []):  # without the end in it: nothing was learned from
        lex = lm.Lexicon(some, np.array([float(seen[w]) for w in some]), np.ones(lm.RULES), np.ones(lm.RULES), lm.Config(dynamic=32, class_size=8, group_size=2))
        slices = [*lm.text_slices(pa.array(texts))]
        assert len(slices) > 5 and [t for x in slices for t in x.to_pylist()] == texts
        for part in slices:
            cols = lex.read_all(part, pa.array([w.decode() for w in some], pa.string()))
            for t, tokens, known, logs, fixed, rare in zip(part.to_pylist(), *(c.to_pylist() for c in cols)):
                want = lex.read(t)
                assert np.array_equal(np.frombuffer(tokens, np.int32), want[0]) and known == want[3] and [w.encode() for w in rare] == want[4]
                assert logs == pytest.approx(want[2]) and fixed == pytest.approx(want[1])
            got = lm.words_of_texts(part)[0]
            assert lm.rules_of(got).tolist() == [lm.rule(w.encode()) for w in got.to_pylist()]


def test_state_is_carried_over_windows():
    from dataclasses import replace

    from tidemark.llm.language_model import Network, initial, log10_likelihoods

    lex, rng = tiny(), np.random.default_rng(1)
    docs = [rng.integers(0, lex.dynamic, n) for n in (50, 7, 120, 1, 33)]
    p = initial(lex)
    whole = log10_likelihoods(Network(lex, p), docs)
    lex.config = replace(lex.config, score_places=7)
    assert np.allclose(whole, log10_likelihoods(Network(lex, p), docs), atol=1e-4)
    alone = [log10_likelihoods(Network(lex, p), [d])[0] for d in docs]
    assert np.allclose(whole, alone, atol=1e-4)


def test_probabilities_add_up_to_one():
    from tidemark.llm.language_model import RULES, Network, initial

    lex = tiny()
    net, n = Network(lex, initial(lex)), lex.dynamic + 2 * RULES
    state = np.append(np.random.default_rng(2).normal(size=(1, 5)), [[1]], 1).astype(np.float32)
    logp, _ = net.output(np.repeat(state, n, 0), np.arange(n), None)
    assert np.exp(logp).sum() == pytest.approx(1, abs=1e-4)


def test_language_model_base_and_gain(spark, tmp_path):
    import math

    from tidemark.llm.language_model import Config, op1_language_model

    rng = random.Random(6)
    langs = [[f"{a}{b}" for b in "aeiou"] for a in "bcdf"]
    rows = [(i, " ".join(rng.choice(langs[i % 4]) for _ in range(rng.randint(5, 60)))) for i in range(600)]
    rows += [(1000, None), (None, "Ba bE"), (1001, "ba " * 3000), (1001, "neverseen wörd")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = op1_language_model(spark, str(tmp_path), Config(dynamic=64, class_size=8, group_size=4, lanes=4, least_lanes=4, window=10, rounds=4)).collect()
    held = lambda i: i is None or zlib.crc32(str(i).encode()) % 7 == 2
    tokens = [(i, [*WORD.findall(lower(t or "")), ""]) for i, t in rows]
    c = Counter(w for i, ws in tokens if not held(i) for w in ws)
    n, v = sum(c.values()), len(c)
    want = Counter((i, held(i), len(ws), sum(c[w] > 0 for w in ws), round(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ws), 6)) for i, ws in tokens)
    assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, round(r.base_score, 6)) for r in got) == want
    assert {r.train_tokens for r in got} == {n}
    test = [r for r in got if r.held_out and r.doc_id is not None and r.doc_id < 1000]
    assert sum(r.score for r in test) > sum(r.base_score for r in test) + 0.1 * sum(r.n_tokens for r in test)


def test_language_model_learns_from_every_training_document(spark, monkeypatch):
    from pyspark.sql import functions as F

    from tidemark.llm import language_model as lm

    rng, fitted = random.Random(8), []
    rows = [(i, " ".join(f"w{rng.randint(0, 30)}" for _ in range(rng.randint(1, 40)))) for i in range(300)]
    texts = spark.createDataFrame(rows, "doc_id long, text string")
    config = lm.Config(dynamic=32, class_size=8, group_size=2, first_tokens=100, lanes=4, least_lanes=4, window=10)
    lex, n_tokens, _ = lm.lexicon_of(lm.count_tokens(texts.select("text")), config)
    average = lm._average

    def seen(trained):
        fitted.append(trained.where("part = 0").agg(F.sum("tokens")).first()[0])
        return average(trained)

    monkeypatch.setattr(lm, "_average", seen)
    lm.fit(lm.materialize(lm.tokenized(texts, lex), "tokens"), lex)
    assert len(fitted) == config.rounds and sum(fitted) == n_tokens == sum(len(t.split()) + 1 for _, t in rows)


def test_most_frequent_takes_ties_up_to_the_limit(spark):
    from tidemark.llm.common import most_frequent

    rows = [(f"w{i}", 7 if i >= 20 else 8 if i >= 10 else 900 + i) for i in range(200)]
    df = spark.createDataFrame(rows, "word string, n long")
    for limit in (0, 5, 10, 15, 20, 50, 120, 200, 300):
        got = sorted(r.n for r in most_frequent(df, "n", "word", limit).collect())
        assert got == sorted(sorted((n for _, n in rows), reverse=True)[:limit])
    assert most_frequent(df.where("n < 0"), "n", "word", 5).count() == 0


# ---- token counts


def test_token_counts(spark, docs, no_docs, tmp_path):
    from tokenizers import Tokenizer

    from tidemark.llm.bpe import default_path
    from tidemark.llm.token_counts import BPE, WORDS, Rollup, count_documents, deletes, inserts, op10_token_counts, revisions

    library = Tokenizer.from_file(default_path())
    size = {WORDS: lambda t: len(WORD.findall(t)), BPE: lambda t: len(library.encode(t, add_special_tokens=False).ids)}
    counts = count_documents(docs, default_path()).cache()
    store, want = Rollup(spark, f"{tmp_path}/rollup"), Counter()

    def change(rows, version, sign):
        for _, text, lang, source in rows:
            for k, n in (("docs", 1), ("tokens", size[version](text or "")), ("chars", len(text or ""))):
                want[source, lang, version, k] += sign * n

    def check(store=store):
        got = {(r.source, r.lang, r.tokenizer): (r.n_docs, r.n_tokens, r.n_chars) for r in store.totals().collect()}
        assert got == {k[:3]: (n, want[*k[:3], "tokens"], want[*k[:3], "chars"]) for k, n in want.items() if k[3] == "docs" and n}

    assert store.totals().count() == 0 and store.committed() == []
    assert store.commit("load", inserts(counts, WORDS)) and not store.commit("load", inserts(counts, WORDS))
    change(ROWS, WORDS, 1)
    check()
    assert store.commit("bpe", revisions(counts.where("lang = 'en'"), WORDS, BPE))
    change([r for r in ROWS if r[2] == "en"], WORDS, -1)
    change([r for r in ROWS if r[2] == "en"], BPE, 1)
    check()
    store.compact()
    check()
    assert store.commit("gone", deletes(counts.where("source = 'c'  AND lang <> 'en'"), WORDS))
    change([r for r in ROWS if r[3] == "c" and r[2] != "en"], WORDS, -1)
    check()
    store.compact()
    store.compact()
    check()
    assert not store.commit("bpe", inserts(counts, BPE)) and store.committed() == ["bpe", "gone", "load"]
    assert store.commit("none", inserts(count_documents(no_docs, default_path()), BPE))
    check()
    with pytest.raises(ValueError):
        store.commit("a/b", inserts(counts, WORDS))
    # The query: every row, English ones by words and the others by BPE.
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    want.clear()
    for r in ROWS:
        change([r], WORDS if r[2] == "en" else BPE, 1)
    got = {(r.source, r.lang, r.tokenizer): (r.n_docs, r.n_tokens, r.n_chars) for r in op10_token_counts(spark, str(tmp_path)).collect()}
    assert got == {k[:3]: (n, want[*k[:3], "tokens"], want[*k[:3], "chars"]) for k, n in want.items() if k[3] == "docs" and n}


def test_digest_index_is_found_by_its_path(spark, tmp_path):
    """A session whose catalog doesn't know the index, and another number of buckets: what is there stays."""
    from pyspark.sql import functions as F

    from tidemark.llm.exact_dedup import DigestIndex, text_digests

    frame = lambda rows: text_digests(spark.createDataFrame(rows, "doc_id long, text string"))
    first = DigestIndex(spark, "digests_found", f"{tmp_path}/index", 4)
    assert not first.exists()
    first.append(frame([(9, "x"), (2, "y"), (3, "x")]), "a")
    spark.sql("DROP TABLE digests_found")
    other = spark.newSession()
    again = DigestIndex(other, "digests_found", f"{tmp_path}/index", 8)
    assert again.exists() and again.buckets == 4
    batch = frame([(1, "x"), (5, "z"), (7, "z")])
    again.append(batch, "b")
    again.append(batch, "b")
    rows = {(r.doc_id, r.keep_id, r.group_size, r.kept) for r in again.decide(batch).collect()}
    assert rows == {(1, 9, 1, False), (5, 7, 2, False), (7, 7, 2, True)}
    assert {(r.keep_id, r.batch_id) for r in again.read().collect()} == {(9, "a"), (2, "a"), (7, "b")}
    plan = again.read().groupBy("digest").agg(F.count("*"))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan  # read by its buckets
    again.drop()


def test_a_hot_text_is_reduced_before_it_meets_the_index(spark, tmp_path):
    from tidemark.llm import exact_dedup

    index = exact_dedup.DigestIndex(spark, "digests_hot", f"{tmp_path}/index", 4)
    index.append(exact_dedup.text_digests(spark.createDataFrame([(1, "a")], "doc_id long, text string")), "a")
    hot = exact_dedup.text_digests(spark.range(50_000).selectExpr("id AS doc_id", "IF(id % 50 = 0, CAST(id AS STRING), 'hot') AS text"))
    made = []
    real = exact_dedup.materialize
    exact_dedup.materialize = lambda df, label: made.append((label, real(df, label))) or made[-1][1]
    try:
        index.append(hot, "b")
    finally:
        exact_dedup.materialize = real
    assert [(label, df.count()) for label, df in made] == [("digest-batch", 1001)]
    assert index.read().count() == 1002
    index.drop()


def test_a_commit_beside_a_compaction_counts_once(spark, tmp_path):
    from tidemark.llm.token_counts import COUNTS, WORDS, Rollup, inserts

    counts = spark.createDataFrame([("s", "en", 4, 10, 0)], COUNTS)
    store = Rollup(spark, f"{tmp_path}/rollup")
    store.commit("one", inserts(counts, WORDS))
    real = store._totals

    def totals(state):
        df = real(state)
        store._totals = real
        store.commit("two", inserts(counts, WORDS))  # between the look at the folders and the list of what is folded
        return df

    store._totals = totals
    store.compact()
    assert store.totals().first().n_tokens == 20 and store.committed() == ["one", "two"]
    store.compact()
    assert store.totals().first().n_tokens == 20
