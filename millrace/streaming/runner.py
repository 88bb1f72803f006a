"""Running the operators on Structured Streaming micro-batches.

The operators are stateless DataFrame functions, so a stream runs the very same
code. Every sink writes a folder per batch number and overwrites it, which makes
a replayed batch harmless.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from millrace.operators import keyed
from millrace.session import shared_folder

Transform = Callable[[DataFrame], DataFrame]
Sink = Callable[[DataFrame, int], None]


def folder_sink(path: str, split_by: str | None = "route", format: str = "parquet") -> Sink:
    """One folder per batch and, inside it, one per value of ``split_by``. One write
    serves all outputs, so the batch is computed once."""
    def write(df: DataFrame, batch: int) -> None:
        if split_by and split_by in df.columns:
            df = df.hint("rebalance", split_by)  # splits hot outputs, merges tiny ones
        writer = df.write.mode("overwrite").format(format)
        if split_by and split_by in df.columns:
            writer = writer.partitionBy(split_by)
        writer.save(f"{path}/batch={batch}")

    return write


def keyed_sink(path: str, schema: str, key: str, op: str, order_by: Sequence[str]) -> Sink:
    """Documents as a base table and one small table of folded changes per batch.

    A batch costs what its own changes cost: the status of each change is looked up
    and written under ``items``, then one row per changed id goes to ``deltas``.
    The base is rewritten by ``compact`` only. Both tables of a batch are written
    whole, from earlier batches alone, so a replay gives the same files."""
    target = T.StructType.fromDDL(schema)

    def write(df: DataFrame, batch: int) -> None:
        spark = df.sparkSession
        if batch == 0:
            spark.createDataFrame([], target).write.mode("overwrite").parquet(f"{path}/base/upto=-1")
        base, deltas = _stored(spark, path, before=batch)
        folded = keyed.fold_again(deltas, key, "batch") if deltas is not None else base.select(key, F.lit(None).cast("string").alias("__last")).limit(0)
        known = keyed.known_ids(base, folded, df, key)
        keyed.change_results(known, df, key, op, order_by).write.mode("overwrite").parquet(f"{path}/items/batch={batch}")
        items = spark.read.parquet(f"{path}/items/batch={batch}")
        keyed.fold_changes(items, target, key, op, order_by).write.mode("overwrite").parquet(f"{path}/deltas/batch={batch}")

    return write


def _numbers(df: DataFrame, name: str) -> list[int]:
    """Values of a folder column, told by the file names alone (also empty tables have a file)."""
    found = (re.search(rf"/{name}=(-?\d+)/", file) for file in df.inputFiles())
    return sorted({int(match.group(1)) for match in found if match})


def _stored(spark: SparkSession, path: str, before: int | None = None) -> tuple[DataFrame, DataFrame | None]:
    """The newest base older than batch ``before`` and the deltas between the two."""
    versions = [n for n in _numbers(spark.read.parquet(f"{path}/base"), "upto") if before is None or n < before]
    base = spark.read.parquet(f"{path}/base/upto={versions[-1]}")
    if before == 0:
        return base, None
    deltas = spark.read.parquet(f"{path}/deltas").filter(F.col("batch") > versions[-1])
    return base, deltas if before is None else deltas.filter(F.col("batch") < before)


def documents(spark: SparkSession, path: str, key: str) -> DataFrame:
    """The current documents of a keyed sink."""
    base, deltas = _stored(spark, path)
    return keyed.merge_folded(base, keyed.fold_again(deltas, key, "batch"), key)


def compact(spark: SparkSession, path: str, key: str) -> int:
    """Write the current documents as the new base; later reads start from there.
    Run it between batches. Gives the number of the last batch in the base."""
    last = _numbers(spark.read.parquet(f"{path}/deltas"), "batch")[-1]
    documents(spark, path, key).write.mode("overwrite").parquet(f"{path}/base/upto={last}")
    return last


def run_stream(source: DataFrame, transform: Transform, sinks: Sequence[Sink], checkpoint: str | None = None,
               name: str = "flow", wait: bool = True) -> StreamingQuery:
    """Apply ``transform`` to every micro-batch and hand it to the sinks. Works off
    what is there and stops; the checkpoint remembers what was done, and a batch
    that failed is delivered again by the next run."""
    spark = source.sparkSession
    location = checkpoint or f"{shared_folder(spark)}/{name}"

    counted: dict[int, int] = {}

    def handle(df: DataFrame, batch: int) -> None:
        rows = Observation()
        result = transform(df.observe(rows, F.count(F.lit(1)).alias("rows")))
        consume(result, batch)
        counted[batch] = rows.get["rows"]

    def consume(result: DataFrame, batch: int) -> None:
        if len(sinks) == 1:
            sinks[0](result, batch)
            return
        result.persist()
        try:
            for sink in sinks:
                sink(result, batch)
        finally:
            result.unpersist()

    query = source.writeStream.queryName(name).option("checkpointLocation", location) \
        .trigger(availableNow=True).foreachBatch(handle).start()
    query.counted = counted
    if wait:
        query.awaitTermination()
    return query


def observed_rows(query: StreamingQuery) -> int:
    """Rows that went through all batches of a query that ``run_stream`` started, however
    many: each batch leaves its own count once its sinks are done."""
    return sum(query.counted.values())
