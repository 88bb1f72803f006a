"""Sequences of dates or numbers, one value per unit of downstream work (a slice).

The values come from ``spark.range`` and arithmetic on the row number, so even a
long backfill is generated in parallel. Only the counter row of one code (a
single row) is read on the driver.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, replace
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.context import RunContext
from millrace.functions.dates import after, parse_period
from millrace.functions.numbers import INTEGRAL
from millrace.operators.keyed import apply_index
from millrace.operators.project import template_value

# Fixed values
DATE, NUMBER = "date", "number"
STRATEGIES = {"date": DATE, "SEQ_DATE": DATE, "number": NUMBER, "SEQ_NUMBER": NUMBER}
FIRST_DATE, FIRST_NUMBER = date(1980, 1, 1), 1
STD_PATTERN, DIGITAL_PATTERN = "yyyy-MM-dd", "yyyyMMdd"
STATE_SCHEMA = ("code string, strategy string, step string, format string, initValue string, maxValue string, "
                "value string, prevValue string, lastUpdateTime timestamp")
COLUMNS = [part.split()[0] for part in STATE_SCHEMA.split(", ")]


@dataclass(frozen=True)
class SequenceConfig:
    code: str
    strategy: str = DATE
    init: str | None = None
    max: str | None = None
    step: str = "1D"
    format: str | None = None
    batch: int | None = 1  # None: as many as there are


def _read_date(spark: SparkSession, text: str, pattern: str | None) -> date:
    patterns = [pattern] if pattern else [STD_PATTERN, DIGITAL_PATTERN]
    tries = [F.try_to_timestamp(F.lit(text), F.lit(p)) for p in patterns]
    value = spark.range(1).select(F.coalesce(*tries).cast("date")).first()[0]
    if value is None:
        raise ValueError(f"{text!r} does not read as {' or '.join(patterns)}")
    return value


def _read_number(text: str | None) -> int:
    """A 64-bit integer; any other text counts as 1."""
    value = int(text) if text is not None and re.match(INTEGRAL, text) else 1
    return value if -(1 << 63) <= value < 1 << 63 else 1


def _limited(room: int, batch: int | None, stored: str | None) -> int:
    """Steps to take: as many as there is room for, within the batch."""
    return room if batch is None else min(room, batch if stored else batch - 1)


def _yesterday(context: RunContext) -> date:
    return (context.now or datetime.now()).date() - timedelta(days=1)


def stored_value(state: DataFrame | None, code: str) -> str | None:
    """The counter of one code; a single row by the table's key."""
    if state is None:
        return None
    row = state.filter(F.col("code") == code).select("value").first()
    return row["value"] if row and row["value"] and row["value"].strip() else None


def _dates(spark: SparkSession, config: SequenceConfig, stored: str | None, context: RunContext) -> DataFrame:
    pattern = (config.format or "").strip() or None
    last = _read_date(spark, config.max, pattern) if config.max and config.max.strip() else _yesterday(context)
    init = stored or config.init
    first = _read_date(spark, init, pattern) if init and init.strip() else FIRST_DATE
    amount, unit = parse_period(config.step)
    if unit == "D":
        room = (config.batch or 0) if amount == 0 else max((last - first).days // amount, 0)
    else:
        months = amount * (12 if unit == "Y" else 1)
        span = (last.year - first.year) * 12 + last.month - first.month
        room = (config.batch or 0) if months == 0 else max(span // months, 0) if span >= 0 else 0
    count = _limited(room, config.batch, stored)
    start = F.lit(first)
    month = F.trunc(start, "month")

    def date_at(n: Column) -> Column:
        if unit == "D":
            return F.date_add(start, n * amount)
        # each step starts from the value before it, so a day lost to a short month
        # stays lost: the day is the shortest month visited so far; months come round within 48 steps
        lengths = F.transform(F.sequence(F.lit(0), F.least(n, F.lit(48))), lambda i: F.dayofmonth(F.last_day(F.add_months(month, i * months))))
        return F.date_add(F.add_months(month, n * months), F.least(F.lit(first.day), F.array_min(lengths)) - 1)

    def shown(n: Column) -> Column:
        return F.date_format(date_at(n), pattern or STD_PATTERN)

    rows = spark.range(0, count + 1).select(F.col("id").cast("int").alias("n"))  # days and months are ints
    return rows.filter((date_at(F.col("n")) <= F.lit(last)) | (F.col("n") == 0)).select(
        "n", shown(F.col("n")).alias("value"), F.when(F.col("n") > 0, shown(F.greatest(F.col("n") - 1, F.lit(0)))).alias("prevValue"))


def _numbers(spark: SparkSession, config: SequenceConfig, stored: str | None) -> DataFrame:
    step = _read_number(config.step)
    first = _read_number(stored or config.init) if (stored or config.init) else FIRST_NUMBER
    end = _read_number(config.max)
    room = -(-(end - first) // step) - 1 if step > 0 else ((config.batch or 0) if first + step < end else 0)
    count = _limited(max(room, 0), config.batch, stored)
    value = F.lit(first).cast("bigint") + F.col("id") * step
    return spark.range(0, count + 1).select(F.col("id").alias("n"), value.cast("string").alias("value"),
                                            F.when(F.col("id") > 0, (value - step).cast("string")).alias("prevValue"))


def generate_sequence(spark: SparkSession, config: SequenceConfig, state: DataFrame | None = None,
                      context: RunContext = RunContext()) -> DataFrame:
    """The next values, at most ``batch`` of them, each with all sequence settings.

    A maximum may be a template (``@{expression}``); a date it gives is written in the sequence's own format. A new sequence starts with ``init`` itself, even beyond the maximum; a stored
    one goes on after its value. Dates stop at the maximum, numbers before it.
    """
    if config.strategy not in STRATEGIES:
        raise ValueError(f"strategy is one of {sorted(STRATEGIES)}, not {config.strategy!r}")
    if config.batch is not None and config.batch < 1:
        raise ValueError("the batch holds at least one value")
    stored = stored_value(state, config.code)
    kind = STRATEGIES[config.strategy]
    if config.max and config.max.strip():
        config = replace(config, max=template_value(spark, config.max, (config.format or "").strip() or STD_PATTERN))
    values = _dates(spark, config, stored, context) if kind == DATE else _numbers(spark, config, stored)
    if stored:
        values = values.filter("n > 0")
    texts = {"code": config.code, "strategy": config.strategy, "step": config.step, "format": config.format,
             "initValue": config.init, "maxValue": config.max}
    return values.select(
        *[F.lit(v).cast("string").alias(k) for k, v in texts.items()], "value", "prevValue",
        context.now_column().alias("lastUpdateTime"), "n").select(*COLUMNS, "n")


def last_of(values: DataFrame) -> DataFrame:
    """The counter row to store: the last value of a run."""
    return values.groupBy("code").agg(F.max_by(F.struct(*[c for c in COLUMNS if c != "code"]), "n").alias("s")) \
        .select("code", "s.*").select(*COLUMNS)


def save_state(state: DataFrame, values: DataFrame) -> DataFrame:
    """The state table after a run: the code's old row is replaced by its last value.
    Write the values out first and the state after them, so a crash repeats slices
    instead of losing them."""
    return apply_index(state.select(*COLUMNS), last_of(values), "code", ["value"])


def slice_days(values: DataFrame, pattern: str = STD_PATTERN) -> DataFrame:
    """Every calendar day of each date slice, from its value up to the next one, for an
    equi-join with facts by day. The last slice is a whole step too."""
    start = F.to_date("value", pattern)
    following = values.select((F.col("n") - 1).alias("n"), start.alias("until"))
    steps = [r.step for r in values.select("step").distinct().limit(2).collect()]
    if len(steps) > 1:
        raise ValueError("slices of one sequence at a time")
    spans = values.select("n", "value", start.alias("day")).join(following, "n", "left")
    whole = after(F.col("day"), steps[0]).cast("date") if steps else F.col("day")
    end = F.greatest(F.date_sub(F.coalesce("until", whole), 1), F.col("day"))
    return spans.select("value", F.explode(F.sequence("day", end)).alias("day"))
