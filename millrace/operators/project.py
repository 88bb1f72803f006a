"""Row scripts: ordered assignments over ``input``, ``output`` and ``attributes``.

Everything is a projection, so any number of statements collapses into one
``Project`` inside whole-stage code generation.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.context import RunContext
from millrace.operators.guard import guard

Statement = tuple[str, "str | Column"]
AT_TIME = "atTime"
BOTH, ONLY_OUTPUT = "both", "only_output"


def as_column(expr: str | Column) -> Column:
    return F.expr(expr) if isinstance(expr, str) else expr


# quoted text is passed over
SAFE_FIELD = re.compile(r"""'(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*"|(?:\b(input|output)\.)?\?(\w+)""")


def safe_fields(expr: str | Column, columns: Sequence[str], outputs: Sequence[str] = (), scoped: bool = True) -> str | Column:
    """Null-safe access: ``input.?x`` (or plain ``?x``) reads a field that may not exist
    and then gives null."""
    if not isinstance(expr, str):
        return expr

    def known(found: re.Match) -> str:
        scope, name = found.groups()
        if name is None:
            return found.group(0)
        if name not in (outputs if scope == "output" else [*columns, *([] if scope else outputs)]):
            return "NULL"
        return f"{scope}.`{name}`" if scope and scoped else f"`{name}`"

    return SAFE_FIELD.sub(known, expr)


def attribute_map(context: RunContext, names: Sequence[str] = ()) -> Column:
    """Attributes of the run as one map column; ``names`` are file attributes
    (see ``with_attributes``) that the run's own values override."""
    pairs = [part for key, value in context.attributes.items() for part in (F.lit(key), F.lit(value))]
    if not pairs and not names:
        return F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))
    return F.create_map(*pairs)


def with_attributes(df: DataFrame, context: RunContext = RunContext(), file_attributes: dict[str, str] | None = None) -> DataFrame:
    """Add the map column ``attributes``: file facts (``{attribute: metadata field}``,
    such as ``{"filename": "file_name"}``) overlaid with the run's own values."""
    facts = {k: f for k, f in (file_attributes or {}).items() if k not in context.attributes}
    pairs = [part for key, field in facts.items() for part in (F.lit(key), F.col(f"_metadata.{field}").cast("string"))]
    pairs += [part for key, value in context.attributes.items() for part in (F.lit(key), F.lit(value))]
    return df.withColumn("attributes", F.create_map(*pairs) if pairs else attribute_map(context))


def build_input(df: DataFrame, builder: Sequence[Statement]) -> DataFrame:
    """Rewrite columns before the operation. An expression that fails (write it
    with ``try_`` functions, so failing means null) leaves the old value."""
    for name, expr in builder:
        new = as_column(expr)
        df = df.withColumn(name, F.coalesce(new, F.col(name)) if name in df.columns else new)
    return df


def script(
    df: DataFrame,
    outputs: Sequence[Statement],
    strategy: str = BOTH,
    input_builder: Sequence[Statement] = (),
    output_builder: Sequence[Statement] = (),
    context: RunContext = RunContext(),
    stamp: bool = True,
) -> DataFrame:
    """Evaluate ordered ``(name, expression)`` statements for every row.

    An expression may read ``input.x`` (the row), ``output.x`` (what earlier
    statements produced), ``attributes['x']`` and plain column names, where an
    output hides an input of the same name. ``both`` overlays the input with the
    output, ``only_output`` keeps the output alone; each result carries the
    processing time as ``atTime``.
    """
    if strategy not in (BOTH, ONLY_OUTPUT):
        raise ValueError(f"strategy is {BOTH!r} or {ONLY_OUTPUT!r}, not {strategy!r}")
    taken = {"input", "output"} & set(df.columns)
    if taken:
        raise ValueError(f"column names {sorted(taken)} are reserved in a script")
    df = build_input(df, input_builder)
    input_columns = [c for c in df.columns if c != "attributes"]
    work = df.withColumn("input", F.struct(*[F.col(f"`{c}`") for c in input_columns]))
    if "attributes" not in df.columns:
        work = work.withColumn("attributes", attribute_map(context))
    produced: list[str] = []
    for name, expr in [*outputs, *output_builder]:
        work = work.withColumn(name, as_column(safe_fields(expr, input_columns, produced)))
        if name not in produced:
            produced.append(name)
        work = work.withColumn("output", F.struct(*[F.col(f"`{c}`") for c in produced]))
    if stamp:
        work = work.withColumn(AT_TIME, context.now_column())
        produced = [c for c in produced if c != AT_TIME] + [AT_TIME]
    kept = [c for c in input_columns if c not in produced] if strategy == BOTH else []
    return work.select(*[F.col(f"`{c}`") for c in kept + produced])


def attempt(
    df: DataFrame,
    outputs: Sequence[tuple[str, str]],
    strategy: str = BOTH,
    input_builder: Sequence[tuple[str, str]] = (),
    output_builder: Sequence[tuple[str, str]] = (),
    context: RunContext = RunContext(),
    stamp: bool = True,
    retry: str = "errorMessage like 'RETRY%'",
) -> DataFrame:
    """``script`` where a statement that fails costs its own row alone. ``route`` is success, failure or, where the
    condition ``retry`` holds for the row, retry; ``errorMessage`` is the cause, null for a success. A row that failed
    keeps its input and has no outputs but those of the output builder, which runs for every row.

    A builder statement that fails is passed over: the input builder then leaves the old value, the output builder what
    the statements made. One that rightly gives null sets null. Statements are SQL text, as they are rewritten (see
    ``guard``); ``raise_error`` and ``assert_true`` give business errors."""
    if strategy not in (BOTH, ONLY_OUTPUT):
        raise ValueError(f"strategy is {BOTH!r} or {ONLY_OUTPUT!r}, not {strategy!r}")
    taken = {"input", "output", "route", "errorMessage"} & set(df.columns)
    if taken:
        raise ValueError(f"column names {sorted(taken)} are reserved in a script")
    work = df if "attributes" in df.columns else df.withColumn("attributes", attribute_map(context))
    for name, expr in input_builder:
        work = _set(work, name, expr, [c for c in work.columns if c != "attributes"])
    input_columns = [c for c in work.columns if c != "attributes"]
    work = work.withColumns({"input": F.struct(*[F.col(f"`{c}`") for c in input_columns]), "errorMessage": F.lit(None).cast("string")})
    produced: list[str] = []
    for name, expr in outputs:
        form = guard(work, safe_fields(expr, input_columns, produced))
        if form.cause:
            work = work.withColumn("errorMessage", F.coalesce("errorMessage", F.expr(form.cause)))
        work = _output(work, produced, name, F.expr(form.value))
    failed = F.col("errorMessage").isNotNull()
    for name in produced:
        kind = work.schema[name].dataType
        old = F.col(f"input.`{name}`") if strategy == BOTH and name in input_columns else F.lit(None)
        work = work.withColumn(name, F.when(~failed, F.col(f"`{name}`")).otherwise(old.try_cast(kind)))
    if produced:
        work = work.withColumn("output", F.struct(*[F.col(f"`{c}`") for c in produced]))
    for name, expr in output_builder:
        work = _output(_set(work, name, expr, input_columns, produced), produced, name, F.col(f"`{name}`"))
    work = work.withColumn("route", F.when(failed & F.coalesce(F.expr(retry), F.lit(False)), "retry").when(failed, "failure").otherwise("success"))
    if stamp:
        work = work.withColumn(AT_TIME, context.now_column())
        produced = [c for c in produced if c != AT_TIME] + [AT_TIME]
    kept = [c for c in input_columns if c not in produced]
    if strategy == ONLY_OUTPUT:  # of a row that failed its input is what there is to keep
        return work.select("route", "errorMessage", *[F.col(f"`{c}`") for c in produced],
                           F.when(failed, F.to_json("input")).alias("failedInput"))
    return work.select("route", "errorMessage", *[F.col(f"`{c}`") for c in kept + produced])


def _output(work: DataFrame, produced: list[str], name: str, value: Column) -> DataFrame:
    work = work.withColumn(name, value)
    if name not in produced:
        produced.append(name)
    return work.withColumn("output", F.struct(*[F.col(f"`{c}`") for c in produced]))


def _set(work: DataFrame, name: str, expr: str, columns: Sequence[str], produced: Sequence[str] = ()) -> DataFrame:
    """Set a column to an expression; where that fails, the old value stays."""
    form = guard(work, safe_fields(expr, columns, produced, scoped="input" in work.columns))
    new = F.expr(form.value)
    if form.cause:
        old = F.col(f"`{name}`") if name in work.columns else F.lit(None)
        new = F.when(F.expr(form.cause).isNull(), new).otherwise(old)
    return work.withColumn(name, new)


def build_struct(df: DataFrame, parts: dict[str, dict[str, str | Column]]) -> DataFrame:
    """Nested values per row, e.g. ``{"variables": {"id": "c_custkey"}, "headers": {…}}``."""
    return df.withColumns({name: F.struct(*[as_column(e).alias(k) for k, e in fields.items()])
                           for name, fields in parts.items()})


def expression_text(expr: str | Column) -> Column:
    """The value of an expression as text, null giving empty text."""
    return F.coalesce(as_column(expr).cast("string"), F.lit(""))


TEMPLATE = re.compile(r"[@$]\{(.+)\}", re.DOTALL)


def template_value(spark: SparkSession, text: str, pattern: str = "yyyy-MM-dd") -> str:
    """A run parameter: ``@{expression}`` is evaluated once per run, dates are
    written in the pattern, anything else is taken as it stands."""
    found = TEMPLATE.fullmatch(text.strip())
    if not found:
        return text
    row = spark.range(1).select(F.expr(found.group(1)).alias("v"))
    shown = F.date_format("v", pattern) if isinstance(row.schema["v"].dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)) else F.col("v").cast("string")
    return row.select(F.coalesce(shown, F.lit(""))).first()[0]


class Uneven(ValueError):
    """User code answered with another number of rows; ``fine`` tells which rows had one answer, as far as known."""

    def __init__(self, reason: str, fine: np.ndarray):
        super().__init__(reason)
        self.fine = fine


def _answered_once(labels: object, size: int) -> np.ndarray:
    """Rows 0 to size - 1 whose label stands once in an answer; none where the labels are not those of the rows, or where
    they may be an answer's own, counted from 0."""
    none = np.zeros(size, bool)
    if not isinstance(labels, pd.Index) or labels.name is not None or labels.dtype.kind != "i" or not len(labels):
        return none
    places = labels.to_numpy()
    if places.min() < 0 or places.max() >= size or np.array_equal(places, np.arange(len(places))):
        return none
    return np.bincount(places, minlength=size) == 1


def map_rows(df: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame], schema: T.StructType | str) -> DataFrame:
    """Hook for user code that no built-in function expresses. ``fn`` turns a batch
    of rows into as many result rows. It may answer with a column ``errorMessage``,
    where a text marks a row that failed. A batch that raises, or that comes back with
    another number of rows, is run once more row by row, so none is lost. If the labels
    of a short answer tell which rows were left out or answered twice, only those are run
    alone and the others together; should these not come out even, they are run alone
    as well. A failed row keeps its input as JSON in ``failedInput`` and the reason in
    ``errorMessage`` (both null otherwise)."""
    target = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
    out = T.StructType([*[T.StructField(f.name, f.dataType) for f in target.fields],
                        T.StructField("failedInput", T.StringType()), T.StructField("errorMessage", T.StringType())])
    names = [f.name for f in target.fields]

    def as_json(rows: pd.DataFrame) -> list[str]:
        return [rows.iloc[[i]].to_json(orient="records", date_format="iso", force_ascii=False, default_handler=str)[1:-1]
                for i in range(len(rows))]

    def attempt(rows: pd.DataFrame) -> pd.DataFrame:
        size = len(rows)
        result = fn(rows)
        if len(result) != size:
            raise Uneven(f"{len(result)} results for {size} rows", _answered_once(getattr(result, "index", None), size))
        result = result.reset_index(drop=True)
        reason = result["errorMessage"] if "errorMessage" in result.columns else pd.Series([None] * len(result), dtype=object)
        bad = reason.notna().to_numpy()
        answer = result.reindex(columns=names)
        if bad.any():
            answer = answer.astype(object)
            answer.loc[bad, :] = None
        source: list[str | None] = [None] * len(rows)
        for i, text in zip(bad.nonzero()[0], as_json(rows[bad])):
            source[i] = text
        texts = [str(x) if b else None for x, b in zip(reason, bad)]
        return answer.assign(failedInput=pd.Series(source, dtype=object), errorMessage=pd.Series(texts, dtype=object))

    def single(row: pd.DataFrame) -> pd.DataFrame:
        try:
            return attempt(row.copy())
        except Exception as error:
            values = {**dict.fromkeys(names), "failedInput": as_json(row)[0], "errorMessage": str(error) or type(error).__name__}
            return pd.DataFrame([values], dtype=object)

    def together(rows: pd.DataFrame) -> pd.DataFrame | np.ndarray:
        """The answer, or else which rows had one of their own."""
        size = len(rows)
        try:
            return attempt(rows)
        except Uneven as error:
            return error.fine
        except Exception:
            return np.zeros(size, bool)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            fine = together(batch.copy())  # user code may change what it is given
            if isinstance(fine, pd.DataFrame):
                yield fine
                continue
            if fine.any():
                rest = together(batch[fine].reset_index(drop=True))
                if isinstance(rest, pd.DataFrame):
                    yield rest
                else:
                    fine[:] = False
            yield from (single(batch.iloc[[i]]) for i in np.flatnonzero(~fine))

    return df.mapInPandas(run, out)
