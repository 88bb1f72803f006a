"""Packing: every id of every document lies in exactly one place, and windows are full."""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from millrace.llm import packing
from tests.llm.cases import awkward, empty


@pytest.fixture(scope="module")
def bpe():
    return Tokenizer.from_file(packing.default_vocabulary())


def ids_of(bpe, text):
    return np.array([*bpe.encode(text or "", add_special_tokens=False).ids, 2], "<u4")


def check(bpe, texts, pieces, size):
    """Round trip of all documents; returns the lengths of the sequences."""
    whole = Counter((d, ids_of(bpe, t).tobytes()) for d, t in texts)
    by_place = defaultdict(list)
    known = defaultdict(list)
    for d, raw in whole:
        known[d].append(np.frombuffer(raw, "<u4"))
    starts = Counter()
    for p in pieces:
        assert any(len(ids) == p.doc_tokens and zlib.crc32(ids[p.start:p.start + p.length].tobytes()) == p.ids_crc32 and p.length > 0
                   for ids in known[p.doc_id]), p
        by_place[p.sequence_id].append((p.offset, p.length))
        starts[p.doc_id, p.doc_tokens] += p.length
    assert starts == Counter({k: sum(len(r) // 4 * n for (d, r), n in whole.items() if (d, len(r) // 4) == k)
                              for k in {(d, len(r) // 4) for d, r in whole}})
    lengths = []
    for places in by_place.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= size
        lengths.append(at)
    return lengths


@pytest.mark.parametrize("size,most,together", [(4096, 64, 256), (64, 4, 2), (64, 1, 3)])
def test_round_trip(spark, bpe, size, most, together):
    docs, texts = awkward(spark)
    df = packing.pack(docs.repartition(7), size, most, together)
    assert df.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    lengths = check(bpe, texts, df.collect(), size)
    assert all(n == size or n & (n - 1) == 0 for n in lengths)
    assert sum(n < size for n in lengths) <= size.bit_length()


def test_sequences_hold_the_ids(spark, bpe):
    docs, texts = awkward(spark, 4)
    pieces = packing.pack(docs, 128, ids=True)
    placed = {r.sequence_id: np.frombuffer(bytes(r.tokens), "<u4") for r in packing.sequences(pieces).collect()}
    back = defaultdict(list)
    for p in pieces.collect():
        got = placed[p.sequence_id][p.offset:p.offset + p.length]
        assert zlib.crc32(got.tobytes()) == p.ids_crc32
        back[p.doc_id].append((p.start, got))
    unique = {d for d, n in Counter(d for d, _ in texts).items() if n == 1}
    for d, text in texts:
        if d in unique:
            assert np.array_equal(np.concatenate([g for _, g in sorted(back[d], key=lambda x: x[0])]), ids_of(bpe, text))


ODD = ["don't stop", "Anb'll\"x\" x.Y", "H̱ ẖ İstanbul I'M", "a<|endoftext|>b <|STARTOFTEXT|> c", "see <|endoftext|> (<|startoftext|>)", "'tis ''t (word) [ñu]… \"Ab's\" dogs' ('re) —x. x—. ²a. a²",
       "12ab34 ab12 ñandú. naïve",
       "漢字かな ok", "…'s ''s 's", "x\x0by\x0cz\x85w\xa0v u", "क़ क़ ﬁ ß SS", "\0\x01 a\0b", "a" * 5000, "Ab" * 3000, "é é É"]


def test_ids_are_those_of_the_tokenizer(bpe):
    known = packing.Subwords(packing.default_vocabulary(), most=30)  # it forgets at times
    texts = ODD + [" ".join(ODD), "\n".join(reversed(ODD)), None, "", " "]
    for at in range(0, len(texts), 3):
        got = known.encode([None if t is None else t.encode() for t in texts[at:at + 3]])
        for text, ids in zip(texts[at:at + 3], got):
            assert np.array_equal(ids, ids_of(bpe, text)), text


def test_a_very_long_text(spark, bpe):
    text = "Some words, and more of them; " * 60_000
    df = packing.pack(spark.createDataFrame([(1, text), (2, "end")], "doc_id int, text string"))
    lengths = check(bpe, [(1, text), (2, "end")], df.collect(), 4096)
    assert sum(lengths) == len(ids_of(bpe, text)) + 2


def test_reruns_agree_and_empty_tables(spark):
    docs, _ = awkward(spark)
    first, second = (sorted(map(tuple, packing.pack(docs, 256).collect()), key=repr) for _ in range(2))
    assert first == second
    assert packing.pack(empty(spark)).collect() == []


def test_windows_are_bounded_and_best_fit():
    p = packing.Packer(100, 2)
    tokens = lambda n: np.zeros(n, "<u4")
    p.add("a", tokens(60))
    p.add("b", tokens(70))
    p.add("c", tokens(30))  # fits b's window exactly
    assert [(n, [x[0] for x in w]) for n, w in p.closed] == [(1, ["b", "c"])]
    p.add("d", tokens(80))
    p.add("e", tokens(45))  # fits none: d's window takes 20 of it, and the tail fits a's
    assert [x[0] for x in p.closed[1][1]] == ["d", "e"] and len(p.closed[1][1][1][2]) == 20
    assert len(p.open) == 1 and [x[0] for x in p.left()[0][1]] == ["a", "e"]
