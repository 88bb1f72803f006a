"""Regrouping rows by the text of an expression."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.project import as_column, safe_fields

DEFAULT = "default"


def partition_rows(df: DataFrame, expr: str | Column, name: str = "partition") -> DataFrame:
    """Add the group of each row; a missing value (or, written ``?field``, a missing
    field) belongs to ``default``."""
    group = as_column(safe_fields(expr, df.columns, scoped=False))
    return df.withColumn(name, F.coalesce(group.cast("string"), F.lit(DEFAULT)))


def partition_counts(df: DataFrame, expr: str | Column, name: str = "partition") -> DataFrame:
    """Rows per group, counted map-side first."""
    return partition_rows(df, expr, name).groupBy(name).agg(F.count(F.lit(1)).alias("rows"))


def write_partitions(df: DataFrame, path: str, expr: str | Column, fmt: str = "json", name: str = "partition",
                     rows_per_file: int = 1_000_000, mode: str = "overwrite") -> None:
    """One folder per group. No group is gathered: a hot one is split over many
    tasks and files by the adaptive rebalance."""
    parts = partition_rows(df, expr, name)
    parts.hint("rebalance", F.col(name)).write.mode(mode).partitionBy(name) \
        .option("maxRecordsPerFile", rows_per_file).format(fmt).save(path)
