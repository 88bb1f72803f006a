"""Keyed documents in hash buckets, changed batch by batch.

A document's bucket follows from its id. Each bucket is a base folder and the folders of the batches that changed it since;
a manifest of one row per bucket, written last in a batch, says which they are. A batch reads the buckets its ids fall into
and no others, and a bucket that has gathered enough changes is written anew. Whatever a batch writes comes from the
manifest before it and from its own rows, so a replay gives the same documents.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators import keyed
from millrace.streaming.runner import Sink

BUCKET, BATCH = "_bucket", "_batch"
MANIFEST = "bucket int, version long, deltas array<long>, rows long, buckets int"
State = dict[int, tuple[int | None, list[int]]]  # bucket: the batch its base is of, the batches that changed it since


def bucket_of(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(F.col(key)), F.lit(buckets)).cast("int")


def _write(df: DataFrame, path: str) -> list[int]:
    """One folder per bucket; gives the buckets that have rows."""
    df.hint("rebalance", BUCKET).write.mode("overwrite").partitionBy(BUCKET).parquet(path)
    try:
        written = df.sparkSession.read.parquet(path)
    except Exception as error:
        if "UNABLE_TO_INFER_SCHEMA" in str(error):  # nothing but the folder
            return []
        raise
    return sorted(r[0] for r in written.select(BUCKET).distinct().collect()) if BUCKET in written.columns else []


def _commit(spark: SparkSession, path: str, batch: int, state: State, rows: int, buckets: int) -> None:
    held = [(b, version, deltas, None, buckets) for b, (version, deltas) in sorted(state.items())] + [(None, None, [], rows, buckets)]
    spark.createDataFrame(held, MANIFEST).coalesce(1).write.mode("overwrite").parquet(f"{path}/manifest/batch={batch}")


def _manifest(spark: SparkSession, path: str, batch: int) -> tuple[State, int]:
    rows = spark.read.schema(MANIFEST).parquet(f"{path}/manifest/batch={batch}").collect()
    return {r.bucket: (r.version, list(r.deltas)) for r in rows if r.bucket is not None}, rows[0].buckets


def last_batch(spark: SparkSession, path: str) -> int:
    """The newest batch that is complete, -1 for the documents it began with."""
    return spark.read.schema(f"{MANIFEST}, batch long").parquet(f"{path}/manifest").agg(F.max("batch")).first()[0]


def create(documents: DataFrame, path: str, key: str, buckets: int = 64) -> None:
    """Begin with these documents, one per id; the number of buckets stays."""
    taken = {BUCKET, BATCH} & set(documents.columns)
    if taken:
        raise ValueError(f"column names {sorted(taken)} are reserved for the sink")
    spark = documents.sparkSession
    documents.limit(0).coalesce(1).write.mode("overwrite").parquet(f"{path}/schema")
    held = _write(documents.withColumn(BUCKET, bucket_of(key, buckets)), f"{path}/base/version=-1")
    _commit(spark, path, -1, {b: (-1, []) for b in held}, 0, buckets)


def stored(spark: SparkSession, path: str, state: State, only: Iterable[int] | None = None) -> tuple[DataFrame, DataFrame | None]:
    """Base and changes of some buckets, or of all; changes are None where there are none."""
    wanted = sorted(state if only is None else state.keys() & set(only))
    base = [f"{path}/base/version={state[b][0]}/{BUCKET}={b}" for b in wanted if state[b][0] is not None]
    deltas = [f"{path}/deltas/batch={n}/{BUCKET}={b}" for b in wanted for n in state[b][1]]
    schema = spark.read.parquet(f"{path}/schema").schema
    return (spark.read.schema(schema).parquet(*base) if base else spark.createDataFrame([], schema),
            spark.read.parquet(*deltas) if deltas else None)


def _merged(base: DataFrame, deltas: DataFrame | None, key: str) -> DataFrame:
    return base if deltas is None else keyed.merge_folded(base, keyed.fold_again(deltas, key, BATCH), key)


def bucket_sink(path: str, key: str, op: str, order_by: Sequence[str], most: int = 8) -> Sink:
    """Changes of documents that ``create`` began with. The status of every change goes to ``items``, what the changes of an
    id amount to into its bucket. A bucket changed by ``most`` batches is written anew."""

    def write(df: DataFrame, batch: int) -> None:
        spark = df.sparkSession
        state, buckets = _manifest(spark, path, batch - 1)
        touched = [r[0] for r in df.where(F.col(key).isNotNull()).select(bucket_of(key, buckets)).distinct().collect()]
        base, deltas = stored(spark, path, state, touched)
        folded = keyed.fold_again(deltas, key, BATCH) if deltas is not None else base.select(key, F.lit(None).cast("string").alias("__last")).limit(0)
        known = keyed.known_ids(base, folded, df, key)
        keyed.change_results(known, df, key, op, order_by).write.mode("overwrite").parquet(f"{path}/items/batch={batch}")
        items = spark.read.parquet(f"{path}/items/batch={batch}")
        news = keyed.fold_changes(items, base.schema, key, op, order_by)
        for b in _write(news.withColumns({BATCH: F.lit(batch).cast("long"), BUCKET: bucket_of(key, buckets)}), f"{path}/deltas/batch={batch}"):
            version, before = state.get(b, (None, []))
            state[b] = (version, [*before, batch])
        full = [b for b, (_, changed) in state.items() if len(changed) >= most]
        if full:
            whole = _merged(*stored(spark, path, state, full), key)
            held = _write(whole.withColumn(BUCKET, bucket_of(key, buckets)), f"{path}/base/version={batch}")
            state |= {b: (batch if b in held else None, []) for b in full}
        _commit(spark, path, batch, state, items.count(), buckets)

    return write


def documents(spark: SparkSession, path: str, key: str) -> DataFrame:
    """The documents after the last complete batch."""
    state, _ = _manifest(spark, path, last_batch(spark, path))
    return _merged(*stored(spark, path, state), key)


def changed_rows(spark: SparkSession, path: str) -> int:
    """Changes of all complete batches, whatever process wrote them."""
    return spark.read.schema(f"{MANIFEST}, batch long").parquet(f"{path}/manifest").agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]
