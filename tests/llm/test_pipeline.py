"""The pipeline, stage by stage, against plain Python."""

from __future__ import annotations

from collections import Counter, defaultdict

from pyspark.sql import functions as F

import corpus_pipeline
from millrace.llm import mix
from millrace.llm.queries import op4_quality_nbsvm
from millrace.plans.registry import Tables
from tests.llm.test_copies import brute_components
from tests.llm.test_native import item_words

FOLDER = "/root/testdata/sf0.001"


def test_pipeline(spark):
    t = Tables(spark, FOLDER)
    texts = {r.doc_id: r.text for r in t.documents.collect()}
    good = {r.doc_id for r in op4_quality_nbsvm(t).collect() if r.predicted}
    smallest = brute_components([(d, texts[d]) for d in sorted(good)])
    kept = {d for d in good if smallest[d] == d}
    windows = set()
    for r in t.benchmark.collect():
        w = item_words(r.text)
        windows |= {tuple(w[k : k + 10]) for k in range(max(1, len(w) - 9))} if w else set()
    widths = {len(x) for x in windows}

    def leaks(text):
        w = item_words(text)
        return any(tuple(w[k : k + n]) in windows for n in widths for k in range(len(w) - n + 1))

    clean = {d for d in kept if not leaks(texts[d])}
    assert len(clean) < len(kept) < len(good) < len(texts)
    rows = mix.mix(t.documents.where(F.col("doc_id").isin(sorted(clean)))).collect()
    want = Counter({r.doc_id: int(r.taken / r["size"] + 0.5) if r["size"] else 1 for r in rows})
    got = corpus_pipeline.run(spark, FOLDER).collect()
    assert Counter(r.doc_id for r in got) == +want
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())


def test_stages_keep_the_columns_and_take_empty_tables(spark):
    docs = Tables(spark, FOLDER).documents.limit(0)
    for name, stage in corpus_pipeline.STAGES:
        done = stage(spark, docs, FOLDER)
        assert done.count() == 0
        if name != corpus_pipeline.STAGES[-1][0]:
            assert done.columns == docs.columns
