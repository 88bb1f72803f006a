"""The registered queries of this package, one per operator."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.llm import (
    decontaminate, langid, lm_score, mix, ngram_join, packing, quality_nbsvm, ranked, rules, shard, suffix_dedup, toxicity, whitening)
from millrace.llm.common import held_out
from millrace.llm.sql import DECONTAMINATE, MIX, NGRAM_JOIN, RANKED, SHARD
from millrace.plans.registry import Tables, plan


@plan("op1_lm_score")
def op1_lm_score(t: Tables):
    out = held_out(7, 2)
    return lm_score.scores(t.documents, ~out).withColumn("held_out", ~F.col("learnt")).drop("learnt")


@plan("op2_ngram_join", NGRAM_JOIN)
def op2_ngram_join(t: Tables):
    return ngram_join.similar(t.documents)


@plan("op3_decontaminate", DECONTAMINATE)
def op3_decontaminate(t: Tables):
    return decontaminate.contamination(t.documents, t.benchmark)


@plan("op4_quality_nbsvm")
def op4_quality_nbsvm(t: Tables):
    out = held_out(5, 0)
    model = quality_nbsvm.train(t.documents, t.labels, ~out)
    return quality_nbsvm.score(t.documents.select("doc_id", "text"), model).select(
        "doc_id", out.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


@plan("op5_mix_schedule", MIX)
def op5_mix_schedule(t: Tables):
    return mix.mix(t.documents).select("doc_id", "size", "source_size", "target", "taken", F.get("slots", F.lit(0)).alias("slot"))


@plan("op6_toxicity_gru")
def op6_toxicity_gru(t: Tables):
    out = held_out(4, 2)
    model = toxicity.train(t.documents, t.labels, ~out)
    return toxicity.score(t.documents.select("doc_id", "text"), model).select(
        "doc_id", out.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


@plan("op7_langid_kernel")
def op7_langid_kernel(t: Tables):
    out = held_out(5, 0)
    model = langid.train(t.documents, ~out)
    return langid.identify(t.documents.select("doc_id", "text"), model).select(
        "doc_id", out.alias("held_out"), "lang_pred", "score")


@plan("op8_quality_rules")
def op8_quality_rules(t: Tables):
    return rules.verdicts(t.documents)


@plan("op9_suffix_dedup")
def op9_suffix_dedup(t: Tables):
    return suffix_dedup.deduplicated(t.documents)


@plan("op10_shard_tree", SHARD)
def op10_shard_tree(t: Tables):
    return shard.shard(t.documents)


@plan("op11_ranked_search", RANKED)
def op11_ranked_search(t: Tables):
    return ranked.search(t.documents, t.benchmark)


@plan("op12_whitening")
def op12_whitening(t: Tables):
    return whitening.whiten(t.embeddings)


@plan("op13_packing")
def op13_packing(t: Tables):
    return packing.pack(t.documents)
