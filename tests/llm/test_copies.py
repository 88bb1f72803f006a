"""Near duplicates and repeated bytes against plain Python."""

from __future__ import annotations

import hashlib
import itertools
import re
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from millrace.llm import ngram_join, suffix_dedup
from tests.llm.cases import awkward, empty

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(FOLD))
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute_components(texts):
    root = {}
    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    sets = [(d, shingles(t)) for d, t in texts if d is not None]
    for d, _ in sets:
        root[d] = d
    for (a, s), (b, t) in itertools.combinations(sets, 2):
        if s and t and 100 * len(s & t) >= 75 * len(s | t):
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {d: find(d) for d in root}


@pytest.mark.parametrize("block", [2048, 2])
def test_components(spark, monkeypatch, block):
    """Also where two documents already fill a tree."""
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    df, texts = awkward(spark, seed=3)
    want = brute_components(texts)
    got = ngram_join.similar(df).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == Counter(
        (d, len(shingles(t)), want.get(d)) for d, t in texts)
    assert len({v for v in want.values()}) < len(want)
    assert ngram_join.similar(empty(spark)).count() == 0


def test_words_of_a_batch_are_hashed_once(monkeypatch):
    calls = []
    plain = ngram_join.xxhash.xxh3_64_intdigest

    class Counted:
        @staticmethod
        def xxh3_64_intdigest(word):
            calls.append(word)
            return plain(word)

    monkeypatch.setattr(ngram_join, "xxhash", Counted)
    texts = ["One two", None, "", " \n", "a b\x0bc\x1c d\u2003e  f g\t", "one TWO\r", "g f a b\fone two g f a b one two", "É é one"]
    rows = pa.RecordBatch.from_arrays([pa.array(["zz", *texts])], ["text"]).slice(1)
    sets = ngram_join.shingle_sets(rows)
    words = {w for t in texts for s in shingles(t) for w in s}
    assert sorted(calls) == sorted(w.encode() for w in words)
    assert [len(s) for s in sets] == [len(shingles(t)) for t in texts]
    assert (sets[0] == sets[5]).all() and all((np.diff(s.astype(object)) > 0).all() for s in sets)
    assert ngram_join.shingle_sets(rows.slice(0, 0)) == []


def test_chains_and_edges_of_similarity(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "FREQUENT", 50)
    rng = random.Random(9)
    texts = []
    for chain in range(6):
        words = [f"w{rng.randrange(10_000)}" for _ in range(80)]
        for i in range(8):
            texts.append((chain * 100 + i, " ".join(words)))
            words = [*words[rng.randint(2, 12):], *[f"w{rng.randrange(10_000)}" for _ in range(rng.randint(1, 12))]]
    df = spark.createDataFrame(texts, "doc_id long, text string")
    want = brute_components(texts)
    assert {r.doc_id: r.component_id for r in ngram_join.similar(df).collect()} == want
    kept = ngram_join.one_of_each(df)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(want.values())) and kept.columns == df.columns


def test_rows_of_one_id_go_only_where_their_texts_link(spark):
    rng = random.Random(4)
    text = lambda: " ".join(f"w{rng.randrange(10_000)}" for _ in range(60))
    one, two, three, four = text(), text(), text(), text()
    rows = [(5, one), (5, two), (5, three), (5, three), (2, two), (9, one + " more"), (9, four), (5, None), (5, ""), (None, one), (None, one)]
    df = spark.createDataFrame([(d, t, "x") for d, t in rows], "doc_id long, text string, lang string")
    kept = ngram_join.one_of_each(df)
    assert kept.columns == df.columns
    assert Counter((r.doc_id, r.text) for r in kept.collect()) == Counter(
        [(5, one), (2, two), (5, three), (9, four), (5, None), (5, ""), (None, one), (None, one)])


def test_tree_leaves_no_pair_out():
    rng = np.random.default_rng(2)
    sets = []
    for _ in range(30):
        base = rng.integers(0, 1 << 62, rng.integers(1, 400)).astype(np.uint64)
        for _ in range(4):
            keep = rng.random(len(base)) > rng.choice([0.02, 0.1, 0.15])
            sets.append(np.unique(np.concatenate([base[keep], rng.integers(0, 1 << 62, 3).astype(np.uint64)])))
    sizes = np.array([len(s) for s in sets])
    tree = ngram_join.Tree(sizes, [ngram_join.bitmap(s) for s in sets], 75)
    found = {tuple(sorted(p)) for x, y in tree.pairs() for p in zip(x.tolist(), y.tolist())}
    for i, j in itertools.combinations(range(len(sets)), 2):
        both = len(np.intersect1d(sets[i], sets[j]))
        if 100 * both >= 75 * (sizes[i] + sizes[j] - both):
            assert (i, j) in found
    assert len(found) < len(sets) * (len(sets) - 1) / 8


def brute_removal(texts):
    first = {}
    raw = [(d, (t or "").encode()) for d, t in texts]
    for d, t in raw:
        if d is not None:
            for i in range(len(t) - 49):
                w = t[i : i + 50]
                first[w] = min(first.get(w, d), d)
    out = Counter()
    for d, t in raw:
        gone = bytearray(len(t))
        if d is not None:
            for i in range(len(t) - 49):
                if first[t[i : i + 50]] < d:
                    gone[i : i + 50] = b"\1" * 50
        kept = bytes(c for c, g in zip(t, gone) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out[d, len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest()] += 1
    return out


def test_removed_bytes(spark):
    df, texts = awkward(spark, seed=5)
    got = suffix_dedup.deduplicated(df).collect()
    assert Counter(tuple(r) for r in got) == brute_removal(texts)
    assert sum(r.n_removed for r in got) > 0
    assert suffix_dedup.deduplicated(empty(spark)).count() == 0


def test_removed_bytes_in_small_pieces(spark, monkeypatch):
    """Pieces of a text, shuffle rows and joins as they are for large inputs."""
    monkeypatch.setattr(suffix_dedup, "COPIES", 0)
    monkeypatch.setattr(suffix_dedup, "SHARD", 1)
    monkeypatch.setattr(suffix_dedup, "HELD", 50)
    df, texts = awkward(spark, seed=6)
    assert Counter(tuple(r) for r in suffix_dedup.deduplicated(df).collect()) == brute_removal(texts)
    whole = suffix_dedup.slices(b"ab" * 900 + bytes(range(256)) * 5, suffix_dedup.Powers())
    monkeypatch.setattr(suffix_dedup, "PIECE", 100)
    cut = suffix_dedup.slices(b"ab" * 900 + bytes(range(256)) * 5, suffix_dedup.Powers())
    assert whole[3].sum() == cut[3].sum() and set(whole[0].tolist()) == set(cut[0].tolist())


@pytest.mark.parametrize("budget", [1, 1 << 20])
def test_suffix_order(budget):
    """In memory and with every queue on disk."""
    rng = random.Random(budget)
    for _ in range(120):
        t = [rng.randint(1, rng.randint(1, 4)) for _ in range(rng.randint(1, 60))]
        for _ in range(rng.randint(0, 4)):
            t[rng.randrange(len(t))] = 0
        t.append(0)
        order, shared = suffix_dedup.Sorter(np.array(t, np.uint16), budget=budget).order()
        tail = lambda i: tuple(t[i : t.index(0, i)])
        inside = [i for i in order.tolist() if t[i]]
        assert sorted(inside) == [i for i, x in enumerate(t) if x]
        assert [tail(i) for i in inside] == sorted(tail(i) for i in inside)
        for a, b, n in zip(order[:-1].tolist(), order[1:].tolist(), shared[1:].tolist()):
            if t[a] and t[b]:
                d = next((k for k in range(60) if a + k >= len(t) or b + k >= len(t) or t[a + k] != t[b + k]), 60)
                assert min(d, 50) == n or min(d, n) >= min(len(tail(a)), len(tail(b)))


def test_documents_meet_only_where_sizes_and_places_leave_room(spark):
    """Postings without a possible partner end before any bitmap is sent for them."""
    row = lambda d, n, prefix: (d, n, d, prefix, b"")
    rows = [row(1, 100, [7, 70]), row(2, 104, [7, 71]), row(3, 10, [7]), row(4, 100, [72, 8]), row(5, 100, [*range(900, 920), 8])]
    reps = spark.createDataFrame(rows, "doc_id long, n long, comp long, prefix array<long>, bits binary")
    want = {(7, 1), (7, 2)}  # 3 is too small for them; 8 is the shingle number 21 of 5
    assert {(r.h, r.doc_id) for r in ngram_join.meetings(reps, 75).collect()} == want


@pytest.mark.parametrize("told", [32 << 20, 0])
def test_only_likely_pairs_bring_whole_sets(spark, monkeypatch, told):
    """A fine bitmap settles most pairs; texts of one id are compared each."""
    monkeypatch.setattr(ngram_join, "TOLD", told)
    words = [f"w{i}" for i in range(400)]
    rows = [(1, " ".join(words)), (2, " ".join(words[:-20])), (3, " ".join(words[80:])), (3, " ".join(words[5:])), (3, " ".join(words[5:])),
            (4, " ".join(words[120:]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    pairs = spark.createDataFrame([(1, 2, 1, 2), (1, 3, 1, 3), (1, 4, 1, 4)], "a long, b long, comp_a long, comp_b long")
    asked = []
    those = ngram_join._those
    monkeypatch.setattr(ngram_join, "_those", lambda docs, pairs, *rest: asked.append(pairs.count()) or those(docs, pairs, *rest))
    assert sorted((r.a, r.b) for r in ngram_join.verified(docs, pairs, 75).collect()) == [(1, 2), (1, 3)]
    assert asked == [3, 2]


def test_slices_that_share_no_side_of_their_gram_are_not_sorted():
    """A gram in several texts is no window yet; equal windows have one gram and share a side of it."""
    rng = random.Random(8)
    gram = bytes(rng.randrange(97, 123) for _ in range(25))
    texts = [bytes(rng.randrange(97, 123) for _ in range(90)) + gram + bytes(rng.randrange(97, 123) for _ in range(90)) for _ in range(40)]
    texts += [texts[0][60:150], texts[1][:100], b"ab" * 60, texts[2][80:] + b"ab" * 30]

    def settled(texts):
        rows = []
        for doc, text in enumerate(texts):
            held = suffix_dedup.slices(text, suffix_dedup.Powers())
            rows += [(1, [int(g)], [int(c)], [doc], [int(a)], [int(n)], [int(s)]) for g, c, a, n, s in zip(*(x.view(np.int64) for x in held))]
        names = ["kind", "gram", "content", "doc", "at", "n", "sides"]
        kinds = [pa.int32(), *[pa.list_(pa.int64())] * 3, *[pa.list_(pa.int32())] * 2, pa.list_(pa.int64())]
        return suffix_dedup._settle(pa.table([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)).to_pylist()

    assert not [r for r in settled(texts[:40]) if r["kind"]]
    found = settled(texts)
    kept = {(r["doc"], r["at"] + i) for r in found for i in range(r["n"])}
    first = {}
    for doc, text in enumerate(texts):
        for i in range(len(text) - 49):
            if first.setdefault(text[i : i + 50], doc) < doc:
                assert (doc, i) in kept


def test_suffixes_are_handed_on_in_few_blocks(monkeypatch):
    """A symbol's queue is filled by all the others, in small parts; each part for itself would take as many steps."""
    blocks = []
    hand_on = suffix_dedup.Sorter._hand_on
    monkeypatch.setattr(suffix_dedup.Sorter, "_hand_on", lambda self, at, *rest: blocks.append(len(at)) or hand_on(self, at, *rest))
    rng = np.random.default_rng(4)
    symbols = np.append(rng.integers(1, 101, 20_000), 0).astype(np.uint16)
    order, _ = suffix_dedup.Sorter(symbols).order()
    assert np.array_equal(np.sort(order[symbols[order] > 0]), np.arange(20_000))
    assert len(blocks) < 1500  # 100 symbols, in both directions, with runs; it was one for most pairs of symbols


def test_only_windows_that_may_be_shared_are_sorted():
    """The end of a passage that two texts share: of the windows around its last gram, those within the passage."""
    rng = random.Random(11)
    some = lambda n: bytes(rng.randrange(256) for _ in range(n))
    passage = some(400)
    texts = [some(300) + passage + some(300), some(200) + passage + some(200)]
    rows = []
    for doc, text in enumerate(texts):
        held = suffix_dedup.slices(text, suffix_dedup.Powers())
        rows += [(1, [int(g)], [int(c)], [doc], [int(a)], [int(n)], [int(s)]) for g, c, a, n, s in zip(*(x.view(np.int64) for x in held))]
    names = ["kind", "gram", "content", "doc", "at", "n", "sides"]
    kinds = [pa.int32(), *[pa.list_(pa.int64())] * 3, *[pa.list_(pa.int32())] * 2, pa.list_(pa.int64())]
    found = suffix_dedup._settle(pa.table([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)).to_pylist()
    kept = {(r["doc"], r["at"] + i) for r in found for i in range(r["n"])}
    shared = {(1, 200 + i) for i in range(351)}
    assert shared <= kept
    assert max(r["n"] for r in found if r["kind"]) < suffix_dedup.GRAMS
    assert all(300 - suffix_dedup.CLASS < at < 651 + suffix_dedup.CLASS for doc, at in kept if doc == 0)
