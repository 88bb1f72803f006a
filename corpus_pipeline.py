"""From raw documents to shards: each stage reads what the stage before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import functions as F

from millrace.llm import decontaminate, mix, ngram_join, quality_nbsvm, shard
from millrace.llm.common import held_out, stored
from millrace.plans.registry import Tables, plan
from millrace.session import tune


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts."""
    t = Tables(tune(spark), sf_dir)
    model = quality_nbsvm.train(docs, t.labels, ~held_out(5, 0))
    mark = "_quality"
    while mark in (c.lower() for c in docs.columns):
        mark += "_"
    return quality_nbsvm.score(docs, model, to=mark).where(F.col(mark) >= 0.3).select(*[F.col(f"`{c}`") for c in docs.columns])


def deduplicated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    tune(spark)
    return ngram_join.one_of_each(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontaminate.clean(docs, Tables(spark, sf_dir).benchmark)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mix.mixed(docs)


def sharded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return shard.shard(docs)


STAGES = [("quality", quality), ("near duplicates", deduplicated), ("decontaminate", decontaminated), ("mix", mixture), ("shard", sharded)]

# the first stages learn from data and compare sets in ways that SQL can't follow
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = Tables(spark, sf_dir).documents
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


@plan("pipeline", ORACLE_SQL)
def pipeline(t: Tables) -> DataFrame:
    return run(t.spark, t.folder)
