"""Reading and writing rows: JSON (lines, arrays, several roots per file), Parquet, ORC, Avro."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamReader

from millrace.sources import roots

# How dates and times are written to JSON
JSON_FORMATS = {"dateFormat": "yyyy-MM-dd", "timestampFormat": "yyyy-MM-dd HH:mm:ss",
                "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss", "ignoreNullFields": "true"}
FORMATS = ("json", "parquet", "orc", "avro")
FILES_PER_BATCH = 100


def _require_avro(spark: SparkSession, fmt: str) -> None:
    if fmt != "avro":
        return
    try:
        spark.read.format("avro").schema("a int").load([])
    except Exception as error:
        raise RuntimeError("Avro needs the spark-avro package on the cluster's class path") from error


def _check(fmt: str) -> None:
    if fmt not in FORMATS:
        raise ValueError(f"format is one of {FORMATS}, not {fmt!r}")


def read_rows(spark: SparkSession, path: str | Sequence[str], format: str = "json", schema: T.StructType | str | None = None,
              multi_root: bool = False, whole_file: bool = False, first_row_schema: bool = False) -> DataFrame:
    """Rows of files. JSON is one object per line; ``whole_file`` reads documents that
    span lines (an array gives many rows), ``multi_root`` documents that follow one
    another in a file. Without a schema JSON types come from all rows, or from the
    first one when ``first_row_schema`` is set."""
    _check(format)
    _require_avro(spark, format)
    if multi_root:
        return read_multi_root(spark, path, schema)
    reader = spark.read.format(format)
    if format == "json":
        reader = reader.option("multiLine", whole_file).options(allowUnquotedFieldNames="true")
        if schema is None and first_row_schema:
            first = spark.read.text(path).filter(F.trim("value") != "").first()
            shape = spark.range(1).select(F.schema_of_json(F.lit(first["value"] if first else "{}"))).first()[0]
            schema = T.DataType.fromDDL(shape)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path if isinstance(path, str) else list(path))


def read_multi_root(spark: SparkSession, path: str | Sequence[str], schema: T.StructType | str | None = None,
                    errors: bool = False) -> DataFrame:
    """JSON documents back to back in files, cut in parallel (see ``roots``); lists give their items. ``errors`` adds
    ``errorMessage`` and ``text``: for a row that is no JSON or doesn't fit the schema its reason and its own text, else null."""
    lines = roots.split_roots(spark, path)
    if schema is None:
        return spark.read.json(lines.select("text").rdd.map(lambda r: r[0]))
    target = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
    if not errors:
        return lines.select(F.from_json("text", target).alias("r")).select("r.*")
    bad = "_corrupt"
    while bad in target.names:
        bad += "_"
    with_bad = T.StructType([*target.fields, T.StructField(bad, T.StringType())])
    parsed = lines.select("text", F.from_json("text", with_bad, {"columnNameOfCorruptRecord": bad}).alias("r"))
    failed = F.col("r").isNull() | F.col(f"r.`{bad}`").isNotNull()
    reason = F.when(F.from_json("text", "variant").isNull(), "not JSON").otherwise("does not fit the schema")
    return parsed.select(*[F.col(f"r.`{n}`") for n in target.names], F.when(failed, reason).alias("errorMessage"), F.when(failed, F.col("text")).alias("text"))


def parse_rows(text: Column, schema: T.StructType | str, lenient: bool = False) -> Column:
    """A JSON text column as a struct; ``lenient`` also takes unquoted names (single
    quotes always work). Text that is not JSON gives a null struct field by field."""
    options = {"mode": "PERMISSIVE", **({"allowUnquotedFieldNames": "true"} if lenient else {})}
    return F.from_json(text, schema, options)


def row_json(df: DataFrame, columns: Sequence[str] | None = None) -> Column:
    """A row as JSON text, nulls left out."""
    return F.to_json(F.struct(*[F.col(f"`{c}`") for c in (columns or df.columns)]), JSON_FORMATS)


def json_arrays(df: DataFrame, group: str | None = None, rows_per_document: int = 10_000) -> DataFrame:
    """Rows as JSON array documents: ``document`` and its number of ``rows`` (and the
    ``group`` all its rows share). Documents are cut while rows stream through a
    task, nothing is shuffled, and a hot group becomes many documents."""
    columns = [c for c in df.columns if c != group]
    group_column = F.col(group).cast("string") if group else F.lit("")
    texts = df.select(group_column.alias("group"), row_json(df, columns).alias("row"))

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        waiting: dict[str | None, list[str]] = {}
        held = 0

        def document(key, rows: list[str]) -> dict:
            return {"group": key, "rows": len(rows), "document": "[" + ",".join(rows) + "]"}

        for batch in batches:
            full = []
            for key, rows in batch.groupby("group", dropna=False, sort=False)["row"]:
                key = None if pd.isna(key) else key
                waiting.setdefault(key, []).extend(rows)
                held += len(rows)
                while len(waiting[key]) >= rows_per_document:
                    full.append(document(key, waiting[key][:rows_per_document]))
                    waiting[key] = waiting[key][rows_per_document:]
                    held -= rows_per_document
            if held > 4 * rows_per_document:  # many small groups: close them all, memory stays bounded
                full += [document(k, v) for k, v in waiting.items() if v]
                waiting, held = {}, 0
            if full:
                yield pd.DataFrame(full)
        rest = [document(k, v) for k, v in waiting.items() if v]
        if rest:
            yield pd.DataFrame(rest)

    out = texts.mapInPandas(pack, "group string, rows bigint, document string")
    return out.withColumnRenamed("group", group) if group else out.drop("group")


def write_rows(df: DataFrame, path: str, format: str = "json", mode: str = "error", rows_per_file: int | None = None) -> None:
    """Write rows: JSON lines without nulls, Parquet, ORC or Avro (snappy)."""
    _check(format)
    _require_avro(df.sparkSession, format)
    writer = df.write.mode(mode).format(format)
    if rows_per_file:
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    if format == "json":
        writer = writer.options(**JSON_FORMATS)
    if format == "avro":
        writer = writer.option("compression", "snappy")
    writer.save(path)


def stream_rows(spark: SparkSession, path: str, schema: T.StructType | str, format: str = "json",
                files_per_batch: int = FILES_PER_BATCH, bytes_per_batch: str | None = None) -> DataFrame:
    """The same files as a stream that takes a bounded number of files (or bytes) per batch."""
    _check(format)
    reader: DataStreamReader = spark.readStream.format(format).schema(schema)
    if bytes_per_batch:
        reader = reader.option("maxBytesPerTrigger", bytes_per_batch)
    else:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)
