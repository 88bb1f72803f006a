"""Ranked lexical search against every document scored plainly."""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pytest

from millrace.llm import ranked
from tests.llm.cases import awkward, empty

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return TERM.findall((text or "").translate(FOLD))


def plainly(texts, items, k=10):
    held = [(d, Counter(w), len(w)) for d, t in texts if (w := words(t))]
    n_docs, total = len(held), sum(n for _, _, n in held)
    df = Counter(term for _, c, _ in held for term in c)
    out = []
    for item, text in items:
        scores = []
        for d, c, n in held:
            m = 100 - 90 + (90 * n * n_docs) // total
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10 ** 9 * c[t]) // (1000 * c[t] + 8 * m))
                    for t in set(words(text)) if c[t])
            if s > 0:
                scores.append((-s, d is None, d or 0, d))
        out += [(item, rank, d, -s) for rank, (s, _, _, d) in enumerate(sorted(scores, key=lambda x: x[:3])[:k], 1)]
    return sorted(out, key=repr)


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def some_items(spark, texts):
    items = [(i, " ".join((t or "").split()[:12])) for i, (_, t) in enumerate(texts) if i % 3 == 0]
    items += [(900, None), (901, ""), (902, ", ."), (None, "changed X one"), (904, "nowhere to be found"), (3, "one one ONE")]
    return spark.createDataFrame(items, "item_id long, text string"), items


@pytest.mark.parametrize("segment", [1 << 18, 300])
def test_search_is_exact(spark, monkeypatch, segment):
    monkeypatch.setattr(ranked, "SEGMENT", segment)
    docs, texts = awkward(spark)
    items, asked = some_items(spark, texts)
    df = ranked.search(docs, items)
    assert df.columns == ["item_id", "rank", "doc_id", "score"]
    assert found(df) == plainly(texts, asked)


def test_items_in_blocks(spark):
    docs, texts = awkward(spark, 2)
    items, asked = some_items(spark, texts)
    assert found(ranked.search(docs, items, 3, together=60)) == plainly(texts, asked, 3)


def test_many_documents_and_a_very_long_one(spark):
    rng = np.random.default_rng(3)
    vocabulary = [f"w{i}" for i in range(400)]
    odds = 1 / np.arange(1, 401)
    texts = [(i, " ".join(rng.choice(vocabulary, rng.integers(5, 60), p=odds / odds.sum()))) for i in range(3000)]
    texts += [(5000, " ".join(rng.choice(vocabulary, 250_000)))]  # over a million characters
    asked = [(i, texts[i * 7][1]) for i in range(20)]
    df = ranked.search(spark.createDataFrame(texts, "doc_id long, text string"), spark.createDataFrame(asked, "item_id int, text string"))
    assert found(df) == plainly(texts, asked)


def test_text_ids(spark):
    texts = [("b", "x y"), ("a", "x y"), (None, "x y"), ("c", "y")]
    df = ranked.search(spark.createDataFrame(texts, "doc_id string, text string"), spark.createDataFrame([("q", "X")], "item_id string, text string"))
    assert [(r.rank, r.doc_id) for r in df.orderBy("rank").collect()] == [(1, "a"), (2, "b"), (3, None)]


def test_empty_tables(spark):
    docs, texts = awkward(spark)
    items, _ = some_items(spark, texts)
    for df in (ranked.search(empty(spark), items), ranked.search(docs, items.limit(0))):
        assert df.columns == ["item_id", "rank", "doc_id", "score"] and df.collect() == []


def test_summaries_bound_scores_and_spare_documents():
    """No document scores above its block's summary, and few documents of unlike groups are looked into."""
    rng = np.random.default_rng(1)
    width, groups = 201, 20
    sizes, terms, parts = [], [], []
    for doc in range(2000):
        own = rng.choice(10, 6, replace=False) + 10 * (doc % groups)
        sizes.append(7)
        terms += [*own, 200]
        parts += [*rng.integers(1000, 9000, 6), 500]
    weights = np.full(width, 1000, np.int64)
    weights[200] = 900
    s = ranked.Segment(list(range(2000)), np.array(sizes), np.array(terms), np.array(parts), weights)
    query = np.array([3, 5, 200])
    mine = np.zeros(width, np.int64)
    mine[query] = weights[query]
    docs, starts, term_of, block_of, part_of = s.blocks(200)
    exact = np.add.reduceat(mine[s.terms] * s.parts, s.start)
    for b in range(len(starts) - 1):
        mask = block_of == b
        assert exact[docs[starts[b]:starts[b + 1]]].max() <= (mine[term_of[mask]] * part_of[mask]).sum()
    assert sorted(docs) == list(range(2000))
    best = s.search(query, mine, [], 10)
    assert [-b[0] for b in best] == sorted(exact.tolist(), reverse=True)[:10]
    assert s.looked_at < 300
