"""What several operators of this package share."""

from __future__ import annotations

import pickle
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.session import shared_folder

SPACE = r"[\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
FOLD = bytes.maketrans(UPPER.encode(), LOWER.encode())


def stored(df: DataFrame, name: str, *by: str) -> DataFrame:
    """Write a table into the shared folder, in a folder for each value of the columns ``by``, and read it again: what
    follows no longer depends on the executors that made it."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/llm-{uuid.uuid4().hex}/{name}"
    df.write.partitionBy(*by).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def dropped(table: DataFrame) -> None:
    """Remove a stored table that nothing reads any more."""
    spark = table.sparkSession
    for folder in {f.rsplit("/", 1)[0] for f in table.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def partitions(spark: SparkSession) -> int:
    """The cluster's own number of shuffle partitions, which follows its data."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def id_crc(column: str = "doc_id") -> Column:
    return F.crc32(F.col(column).cast("string").cast("binary"))


def held_out(modulus: int, remainder: int, column: str = "doc_id") -> Column:
    """True for rows whose labels must not be seen; a null id is never held out."""
    return F.coalesce(F.pmod(id_crc(column), F.lit(modulus)) == remainder, F.lit(False))


def fold_ascii(text: Column) -> Column:
    """Lower-case A to Z alone."""
    return F.translate(text, UPPER, LOWER)


def space_words(text: Column) -> Column:
    """Words between blanks, in JVM expressions; null has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE), "")


def raw_texts(batch: pa.RecordBatch, column: str = "text") -> list[bytes | None]:
    return batch.column(batch.schema.get_field_index(column)).cast(pa.binary()).to_pylist()


def worded(batch: pa.RecordBatch, column: str = "text") -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """The distinct words of a batch's texts between blanks, A to Z lower-cased; all words in a row as numbers of these;
    and how many each text has. Null has none."""
    texts = batch.column(batch.schema.get_field_index(column)).cast(pa.string())
    split = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    sizes = pc.fill_null(pc.list_value_length(split), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    words = split.flatten()
    some = pc.greater(pc.binary_length(words), 0)  # blanks at either end of a text leave an empty one
    if not pc.all(some, min_count=0).as_py():
        whose = np.repeat(np.arange(len(sizes)), sizes)[some.to_numpy(zero_copy_only=False)]
        words, sizes = words.filter(some), np.bincount(whose, minlength=len(sizes))
    coded = words.dictionary_encode()
    distinct = coded.dictionary
    _, offsets, data = distinct.buffers()
    ends = np.frombuffer(offsets, np.int32)[distinct.offset : distinct.offset + len(distinct) + 1].tolist() if len(distinct) else []
    raw = data.to_pybytes() if data else b""
    return [raw[a:b] for a, b in zip(ends, ends[1:])], coded.indices.to_numpy(), sizes


def mix64(x: np.ndarray) -> np.ndarray:
    """Spread the bits of unsigned 64-bit values."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(32))


def small_batches(batches: Iterator[pa.RecordBatch], rows: int = 2000, size: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ``rows`` rows and about ``size`` bytes; a longer row stays whole."""
    for batch in batches:
        at = 0
        while at < batch.num_rows:
            n = min(rows, batch.num_rows - at)
            while n > 1 and batch.slice(at, n).get_total_buffer_size() and _nbytes(batch.slice(at, n)) > size:
                n //= 2
            yield batch.slice(at, n)
            at += n


def _nbytes(batch: pa.RecordBatch) -> int:
    return batch.nbytes


def bounded(df: DataFrame, rows: int) -> bool:
    """True when a stored table holds at most ``rows`` rows; parquet footers answer it."""
    return df.count() <= rows


def chosen_ids(rows: DataFrame, most: int) -> DataFrame:
    """Up to ``most`` ids of these rows as ``_id``, the same ones each time, spread over the ids by their hash."""
    return rows.select(F.col("doc_id").alias("_id")).where("_id is not null").distinct().orderBy(
        F.xxhash64("_id"), "_id").limit(most)


def chosen_texts(docs: DataFrame, ids: DataFrame, most: int) -> list:
    """Texts of at most ``most`` chosen rows; ``ids`` (_id and what goes with it) holds no more than that, so only ids
    and chosen texts travel. Null texts are left out."""
    others = [c for c in ids.columns if c != "_id"]
    return docs.select("doc_id", "text").where("text is not null").join(
        F.broadcast(ids), F.col("doc_id") == F.col("_id")).orderBy("doc_id", "text").limit(most).select("text", *others).collect()


def fitted(fit: Callable, kind: type, spark: SparkSession, *args, **settings):
    """``fit(*args)``, a model of this kind, on a bounded sample, in a task: there numpy keeps to the cores of a task, and a
    lost executor's work is done again. The model's fields come back to the driver."""
    told = spark.sparkContext.broadcast((args, settings))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _ in batches:
            given, named = told.value
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(vars(fit(*given, **named)))], pa.binary())], ["model"])

    return kind(**pickle.loads(spark.range(0, 1, 1, 1).mapInArrow(run, "model binary").first()["model"]))
