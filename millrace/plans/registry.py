"""Registered queries: a Spark plan over the given tables, and the SQL that must agree with it."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from millrace.context import RunContext
from millrace.session import tune

Plan = Callable[["Tables"], DataFrame]

# Fixed processing time, so that both engines stamp the same value
NOW = datetime(2024, 2, 1, 12, 0, 0)
CONTEXT = RunContext(now=NOW, op_id="flow-1", op_name="check", attributes={"tenant": "acme", "min_total": "1000"})

PLANS: dict[str, Plan] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """Lazy access to the parquet tables of one folder: ``t.events``, ``t.orders`` …"""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


def plan(name: str, sql: str | None = None):
    def register(fn: Plan) -> Plan:
        if name in PLANS:
            raise ValueError(f"{name} is registered twice")
        PLANS[name] = fn
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn

    return register


def callables() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(fn: Plan):
        return lambda spark, folder: fn(Tables(tune(spark), folder))

    return {name: bind(fn) for name, fn in PLANS.items()}
