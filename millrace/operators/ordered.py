"""Running values per key that stay parallel when one key holds most rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


COARSE = 32  # percentile cuts; each is divided further into even widths


def position(df: DataFrame, column: str) -> Column | None:
    """The order column as a number, None when it is not a number or a time."""
    kind = df.schema[column].dataType
    if isinstance(kind, T.DateType):
        return F.unix_date(column).cast("double")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(F.col(column).cast("timestamp")).cast("double")
    return F.col(column).cast("double") if isinstance(kind, T.NumericType) else None


def with_slice(df: DataFrame, order: str, name: str, slices: int | None = None) -> DataFrame:
    """Cut the order into about ``slices`` ranges with similar row counts and add
    the number of the range a row falls in; equal values share a range.

    One pass over one column finds the percentile cuts, a short list whatever the
    table's size. The default follows ``spark.sql.shuffle.partitions``, which the
    cluster sizes to its data."""
    at = position(df, order)
    slices = slices or max(32, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    coarse = min(COARSE, slices)
    shares = ", ".join(f"{i / coarse:.6f}" for i in range(coarse + 1))
    cuts = None
    if at is not None and slices > 1:
        cuts = df.select(at.alias("at")).select(F.expr(f"approx_percentile(at, array({shares}), 10000)")).first()[0]
    bounds = sorted(set(cuts or []))
    if len(bounds) < 2:
        return df.withColumn(name, F.lit(0).cast("bigint"))
    fine = -(-slices // (len(bounds) - 1))
    chain = F.when(F.col("__at").isNull(), 0)
    for i, high in enumerate(bounds[1:-1]):
        chain = chain.when(F.col("__at") < high, i)
    cut = df.withColumn("__at", at).withColumn("__cut", chain.otherwise(len(bounds) - 2))
    low = F.get(F.array(*[F.lit(b) for b in bounds[:-1]]), F.col("__cut"))
    high = F.get(F.array(*[F.lit(b) for b in bounds[1:]]), F.col("__cut"))
    share = F.least(F.greatest((F.col("__at") - low) / (high - low), F.lit(0.0)), F.lit(1.0 - 1e-9))
    inside = F.coalesce(F.floor(share * fine), F.lit(0))
    return cut.withColumn(name, F.col("__cut") * fine + inside).drop("__at", "__cut")


def carry_last(df: DataFrame, keys: Sequence[str], order_by: Sequence[str], value: Column, name: str,
               slices: int | None = None) -> DataFrame:
    """Add the last non-null ``value`` among the earlier rows of the same key.

    The order is cut into slices. Inside a slice a window gives the answer; what
    a slice inherits is computed from one summary row per (key, slice). A hot key
    is therefore spread over all slices instead of landing in one task.
    """
    cut = with_slice(df, order_by[0], "__slice", slices).withColumn("__value", value)
    inside = Window.partitionBy(*keys, "__slice").orderBy(*order_by).rowsBetween(Window.unboundedPreceding, -1)
    local = cut.withColumn("__local", F.last("__value", ignorenulls=True).over(inside))
    moment = F.when(F.col("__value").isNotNull(), F.struct(*order_by))
    ends = cut.groupBy(*keys, "__slice").agg(F.max_by("__value", moment).alias("__last"))
    before = Window.partitionBy(*keys).orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
    inherited = ends.withColumn("__carry", F.last("__last", ignorenulls=True).over(before)) \
        .filter("__carry IS NOT NULL").select(*keys, "__slice", "__carry")
    return local.join(inherited, [*keys, "__slice"], "left") \
        .withColumn(name, F.coalesce("__local", "__carry")).drop("__slice", "__value", "__local", "__carry")
