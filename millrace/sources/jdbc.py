"""JDBC tables as source and sink; Spark owns the connections."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def jdbc_options(url: str, driver: str, user: str | None = None, password: str | None = None, timeout: int = 10,
                 fetch_size: int = 10_000, batch_size: int = 10_000, **extra: str) -> dict[str, str]:
    if not url.strip() or not driver.strip():
        raise ValueError("a JDBC connection needs a url and a driver class")
    options = {"url": url, "driver": driver, "queryTimeout": str(timeout), "fetchsize": str(fetch_size),
               "batchsize": str(batch_size), **extra}
    if user is not None:
        options["user"] = user
    if password is not None:
        options["password"] = password
    return options


def read_table(spark: SparkSession, options: dict[str, str], table: str, partition_column: str | None = None,
               lower: int | None = None, upper: int | None = None, partitions: int = 8) -> DataFrame:
    """A table, read in parallel ranges of ``partition_column``. Filters and columns are pushed down."""
    reader = spark.read.format("jdbc").options(**options).option("dbtable", table)
    if partition_column is not None:
        if lower is None or upper is None:
            raise ValueError("a range read needs lower and upper bounds")
        reader = reader.options(partitionColumn=partition_column, lowerBound=str(lower), upperBound=str(upper),
                                numPartitions=str(partitions))
    return reader.load()


def write_table(df: DataFrame, options: dict[str, str], table: str, mode: str = "append", connections: int = 8) -> None:
    """Write in batches over at most ``connections`` connections at once."""
    df.write.format("jdbc").options(**options).option("dbtable", table) \
        .option("numPartitions", str(connections)).mode(mode).save()
