"""Errors as data: bad rows travel in their own outputs instead of failing the job."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.context import RunContext
from millrace.operators.route import Routes, error_reason

SUCCESS, FAILURE, RETRY = "success", "failure", "retry"


def classify(df: DataFrame, failures: Routes, retries: Routes | None = None) -> DataFrame:
    """Add ``route`` and ``errorMessage``. A row that breaks a failure check fails;
    one that only breaks a retry check may be tried again; the rest succeed."""
    failed, again = error_reason(failures), error_reason(retries or {})
    return df.withColumns({
        "route": F.when(failed.isNotNull(), FAILURE).when(again.isNotNull(), RETRY).otherwise(SUCCESS),
        "errorMessage": F.coalesce(failed, again)})


def split_errors(classified: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(ok, failure, retry) of a classified DataFrame."""
    def pick(name: str) -> DataFrame:
        return classified.filter(F.col("route") == name).drop("route")

    return pick(SUCCESS).drop("errorMessage"), pick(FAILURE), pick(RETRY)


def failure_envelope(failed: DataFrame, context: RunContext, error: str | Column = "errorMessage") -> DataFrame:
    """Failure records: who failed, on which input (as JSON), why and when."""
    if not context.op_id.strip() or not context.op_name.strip():
        raise ValueError("a failure record names its operator")
    reason = F.col(error) if isinstance(error, str) else error
    columns = [c for c in failed.columns if c != error]
    return failed.select(
        F.lit(context.op_id).alias("processorId"), F.lit(context.op_name).alias("processorName"),
        F.to_json(F.struct(*[F.col(f"`{c}`") for c in columns])).alias("input"), reason.alias("errorMessage"),
        F.date_format(context.now_column(), "yyyy-MM-dd'T'HH:mm:ss").alias("atTime"))


def failure_inline(failed: DataFrame, context: RunContext, error: Column | None = None) -> DataFrame:
    """The failing rows themselves with ``errorMessage`` and ``atTime`` added."""
    df = failed if error is None else failed.withColumn("errorMessage", error)
    return df.withColumn("atTime", context.now_column())


def retry_input(new_rows: DataFrame, retry_rows: DataFrame, attempt: str = "attempt") -> DataFrame:
    """Input of the next run: new rows at attempt 0 and retried rows one attempt later."""
    fresh = new_rows.withColumn(attempt, F.lit(0))
    again = retry_rows.drop("errorMessage")
    previous = F.col(attempt) if attempt in again.columns else F.lit(0)
    return fresh.unionByName(again.withColumn(attempt, previous + 1), allowMissingColumns=True)
