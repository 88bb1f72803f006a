"""Routing: every row goes to each output whose predicate is exactly TRUE."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from millrace.operators.project import as_column, safe_fields

UNMATCHED, FAILURE, ORIGINAL = "unmatched", "failure", "original"
Routes = dict[str, "str | Column | None"]


def _predicates(routes: Routes) -> dict[str, Column]:
    """Blank predicates name an output that never matches."""
    return {name: as_column(p) for name, p in routes.items()
            if p is not None and not (isinstance(p, str) and not p.strip())}


def _resolved(routes: Routes, df: DataFrame) -> Routes:
    return {name: safe_fields(p, df.columns, scoped=False) for name, p in routes.items()}


def matches(routes: Routes) -> Column:
    """Names of all matching routes; null counts as no match."""
    named = [F.when(p, F.lit(name)) for name, p in _predicates(routes).items()]
    if not named:
        return F.array(F.lit(UNMATCHED))
    hit = F.array_compact(F.array(*named))
    return F.when(F.size(hit) > 0, hit).otherwise(F.array(F.lit(UNMATCHED)))


def error_reason(checks: Routes) -> Column:
    """The name of the first check that holds, null when the row is sound."""
    found = [F.when(p, F.lit(name)) for name, p in _predicates(checks).items()]
    return F.coalesce(*found) if found else F.lit(None).cast("string")


def route(df: DataFrame, routes: Routes, checks: Routes | None = None) -> DataFrame:
    """One row per (input row, matching route), in the column ``route``. One scan
    serves all routes; a predicate may read fields that may not exist as ``?field``. With ``checks`` (``{reason: predicate}``) a row that breaks
    one goes to ``failure`` only, with the reason in ``errorMessage``."""
    routes = _resolved(routes, df)
    if checks is None:
        return df.select(F.explode(matches(routes)).alias("route"), *df.columns)
    marked = df.withColumn("errorMessage", error_reason(_resolved(checks, df)))
    targets = F.when(F.col("errorMessage").isNotNull(), F.array(F.lit(FAILURE))).otherwise(matches(routes))
    return marked.select(F.explode(targets).alias("route"), *df.columns, "errorMessage")


def route_counts(df: DataFrame, routes: Routes) -> DataFrame:
    """Rows per route. Counted in one pass without expanding the rows: each task
    sends a single row of partial counts."""
    predicates = _predicates(_resolved(routes, df))
    hits = {name: F.coalesce(p, F.lit(False)) for name, p in predicates.items()}
    none = F.lit(True)
    for hit in hits.values():
        none = none & ~hit
    hits[UNMATCHED] = none
    names = list(hits)
    counted = df.agg(*[F.count_if(hit).alias(f"c{i}") for i, hit in enumerate(hits.values())])
    pairs = F.array(*[F.struct(F.lit(name).alias("route"), F.col(f"c{i}").alias("rows")) for i, name in enumerate(names)])
    return counted.select(F.inline(pairs)).filter("rows > 0")


def split(routed: DataFrame, names: list[str]) -> dict[str, DataFrame]:
    """The outputs as separate DataFrames over the same plan."""
    return {name: routed.filter(F.col("route") == name).drop("route") for name in names}


def observed(df: DataFrame, name: str = ORIGINAL) -> tuple[DataFrame, Observation]:
    """Pass rows through and count them on the way (``observation.get["rows"]``)."""
    watch = Observation(name)
    return df.observe(watch, F.count(F.lit(1)).alias("rows")), watch


def write_routes(routed: DataFrame, path: str, fmt: str = "json", rows_per_file: int = 1_000_000, mode: str = "overwrite") -> None:
    """One folder per route. The rebalance lets adaptive execution split a hot
    route over many tasks and merge tiny ones, so files stay evenly sized."""
    writer = routed.hint("rebalance", F.col("route")).write.mode(mode).partitionBy("route")
    writer.option("maxRecordsPerFile", rows_per_file).format(fmt).save(path)
