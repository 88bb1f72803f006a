"""Noise-free maximum: the largest integer near the mean."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.numbers import INTEGRAL


def _integers(texts: Column) -> Column:
    kept = F.transform(texts, lambda t: F.when(t.rlike(INTEGRAL), t.try_cast("int")))
    return F.filter(kept, lambda v: v.isNotNull())


def max_without_noise(texts: Column, limit: int) -> Column:
    """List form. Non-integers are ignored, values whose squared distance from the
    (truncated) mean exceeds ``limit`` are noise; 0 when nothing is left."""
    def with_value(value: Column, use) -> Column:
        """Evaluate ``value`` once and hand it on (inner lambdas would repeat it per item)."""
        return F.get(F.transform(F.array(value), use), F.lit(0))

    def largest_near(values: Column, mean: Column) -> Column:
        near = F.filter(values, lambda v: (v - mean) * (v - mean) <= limit)
        return F.greatest(F.coalesce(F.array_max(near), F.lit(0)), F.lit(0)).cast("int")

    def answer(values: Column) -> Column:
        total = F.aggregate(values, F.lit(0).cast("bigint"), lambda acc, v: acc + v)
        mean = F.call_function("div", total, F.nullif(F.size(values), F.lit(0)))
        return with_value(mean, lambda m: largest_near(values, m))

    return F.when(texts.isNotNull(), F.coalesce(with_value(_integers(texts), answer), F.lit(0)))


def max_without_noise_by(df: DataFrame, keys: list[str], value: str, limit: int, name: str = "noise_max") -> DataFrame:
    """Grouped form of the same rule. Equal values of a key are counted first, before and
    after the shuffle, so a hot key arrives as its distinct values; mean and maximum
    come from these, and the rows are read once."""
    number = F.col(value).cast("string")
    whole = F.col(value).try_cast("int") if dict(df.dtypes)[value] in ("tinyint", "smallint", "int", "bigint") \
        else F.when(number.rlike(INTEGRAL), number.try_cast("int"))
    counts = df.select(*keys, whole.alias("__v")).groupBy(*keys, "__v").agg(F.count("__v").alias("__n"))
    key = Window.partitionBy(*keys)
    total = F.sum(F.col("__v").cast("bigint") * F.col("__n")).over(key)
    mean = F.call_function("div", total, F.nullif(F.sum("__n").over(key), F.lit(0)))
    distance = F.col("__v").cast("bigint") - F.col("__mean")
    kept = F.when(distance * distance <= limit, F.col("__v"))
    return counts.withColumn("__mean", mean).groupBy(*keys).agg(
        F.greatest(F.coalesce(F.max(kept), F.lit(0)), F.lit(0)).alias(name))
