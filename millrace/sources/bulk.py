"""Bulk request files: an action line and a document line per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame

from millrace.operators.keyed import bulk_lines, bulk_text


def write_bulk(df: DataFrame, path: str, index: str, doc_type: str, op: str | Column, id_path: str | None = None,
               rows_per_file: int = 100_000, mode: str = "error") -> None:
    """Text files, each a complete request of at most ``rows_per_file`` rows; a row's
    two lines are one record and never part."""
    if not index.strip():
        raise ValueError("the index name is blank")
    bulk_text(bulk_lines(df, index, doc_type, op, id_path)).write.mode(mode) \
        .option("maxRecordsPerFile", rows_per_file).text(path)
