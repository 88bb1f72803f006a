"""Typed reading of JSON text: one walk of each value against a schema, without an inference pass.

Text is parsed once into a variant. Every field of the schema is found by its name or an alias, converted by the rules of
``operators.schema``, and where a given value has no counterpart its path is told. What the schema doesn't know is kept.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.schema import TIMES, convert



def aliased(name: str, data_type: T.DataType | str, *aliases: str, **meta: str) -> T.StructField:
    """A field of a typed schema that may also come by other names; ``format`` and ``kind`` as in ``schema.field``."""
    parsed = T.DataType.fromDDL(data_type) if isinstance(data_type, str) else data_type
    return T.StructField(name, parsed, True, {"aliases": list(aliases), **meta})


def names_of(field: T.StructField) -> list[str]:
    return [field.name, *field.metadata.get("aliases", [])]


def _at(value: Column, name: str) -> Column:
    escaped = name.replace("\\", "\\\\").replace('"', '\\"')
    return F.try_variant_get(value, f'$["{escaped}"]', "variant")


def _given(value: Column) -> Column:
    return value.isNotNull() & ~F.is_variant_null(value)


def _first(parts: Sequence[Column]) -> Column:
    return F.coalesce(*parts) if parts else F.lit(None).cast("string")


class Steps:
    """Columns that are made one after another, so that a value looked at many times is taken from its row once."""

    def __init__(self, taken: Sequence[str]):
        self.prefix = "_step"
        while any(c.lower().startswith(self.prefix) for c in taken):
            self.prefix += "_"
        self.levels: list[dict[str, Column]] = []

    def add(self, level: int, column: Column) -> Column:
        while len(self.levels) <= level:
            self.levels.append({})
        name = f"{self.prefix}{level}_{len(self.levels[level])}"
        self.levels[level][name] = column
        return F.col(name)

    def on(self, df: DataFrame) -> DataFrame:
        for level in self.levels:
            df = df.withColumns(level)
        return df


def _scalar(value: Column, target: T.DataType, meta: dict, path: Column, steps: Steps | None, level: int) -> tuple[Column, Column]:
    kind = F.schema_of_variant(value)
    kind = steps.add(level + 1, kind) if steps else kind

    def as_kind(name: str) -> Column:
        return F.try_variant_get(value, "$", name)

    number = kind.startswith("DECIMAL") | kind.isin("DOUBLE", "FLOAT")
    fraction = as_kind("string").try_cast(target) if isinstance(target, T.DecimalType) else convert(as_kind("double"), T.DoubleType(), target, meta)
    if isinstance(target, T.StringType) and not meta.get("kind"):
        done = as_kind("string")  # numbers, words and the text of nested values
    else:
        done = F.when(kind == "STRING", convert(as_kind("string"), T.StringType(), target, meta)).when(
            kind == "BIGINT", convert(as_kind("bigint"), T.LongType(), target, meta)).when(
            kind == "BOOLEAN", convert(as_kind("boolean"), T.BooleanType(), target, meta)).when(number, fraction)
    blank = (kind == "STRING") & (F.trim(as_kind("string")) == "") if isinstance(target, TIMES) or meta.get("kind") else F.lit(False)
    shown = F.substring(F.to_json(value), 1, 80)
    told = F.concat(F.lit("cannot convert field "), path, F.lit(": "), shown, F.lit(f" as {target.simpleString()}"))
    done = steps.add(level + 2, F.when(_given(value), done)) if steps else F.when(_given(value), done)
    return done, F.when(done.isNull() & _given(value) & ~blank, told)


def walk(value: Column, target: T.DataType, meta: dict, path: Column, steps: Steps | None = None, level: int = 0) -> tuple[Column, Column]:
    """(``value``, a variant, as the target type; the first path in it that can't be converted, or null). With ``steps``
    the value is a column of that level, and what it holds is laid out in the levels after it; without, as for the items
    of a list, everything is one expression."""
    if isinstance(target, T.StructType):
        parts, errors = [], []
        for field in target.fields:
            child = F.coalesce(*[_at(value, n) for n in names_of(field)])
            child = steps.add(level + 1, child) if steps else child
            done, error = walk(child, field.dataType, field.metadata, F.concat(path, F.lit("." + field.name)), steps, level + 1)
            parts.append(done.alias(field.name))
            errors.append(error)
        is_object = F.schema_of_variant(value).startswith("OBJECT")
        wrong = F.when(_given(value) & ~is_object, F.concat(F.lit("cannot convert field "), path, F.lit(": not a record")))
        return F.when(_given(value) & is_object, F.struct(*parts)), _first([wrong, *errors])
    if isinstance(target, T.ArrayType):
        items = F.try_variant_get(value, "$", "array<variant>")

        def item(v: Column, i: Column) -> Column:
            done, error = walk(v, target.elementType, meta, F.concat(path, F.lit("["), i.cast("string"), F.lit("]")))
            return F.struct(done.alias("done"), error.alias("error"))

        both = F.transform(items, item)
        both = steps.add(level + 1, both) if steps else both
        wrong = F.when(_given(value) & items.isNull(), F.concat(F.lit("cannot convert field "), path, F.lit(": not a list")))
        return (F.transform(both, lambda b: b["done"]),
                F.coalesce(wrong, F.get(F.filter(F.transform(both, lambda b: b["error"]), lambda e: e.isNotNull()), F.lit(0))))
    if isinstance(target, T.MapType):
        pairs = F.map_entries(F.try_variant_get(value, "$", "map<string,variant>"))

        def pair(p: Column) -> Column:
            done, error = walk(p["value"], target.valueType, meta, F.concat(path, F.lit("."), p["key"]))
            return F.struct(p["key"].alias("key"), done.alias("value"), error.alias("error"))

        both = F.transform(pairs, pair)
        both = steps.add(level + 1, both) if steps else both
        wrong = F.when(_given(value) & pairs.isNull(), F.concat(F.lit("cannot convert field "), path, F.lit(": not a record")))
        made = F.map_from_entries(F.transform(both, lambda b: F.struct(b["key"].alias("key"), b["value"].alias("value"))))
        return made, F.coalesce(wrong, F.get(F.filter(F.transform(both, lambda b: b["error"]), lambda e: e.isNotNull()), F.lit(0)))
    return _scalar(value, target, meta, path, steps, level)


def _unknown(value: Column, target: T.StructType, prefix: str = "") -> list[Column]:
    """One map of name to JSON text for each record of the schema, names within records dotted."""
    known = [n for f in target.fields for n in names_of(f)]
    rest = F.map_filter(F.try_variant_get(value, "$", "map<string,variant>"), lambda k, _: ~k.isin(known) if known else F.lit(True))
    out = [F.transform_keys(F.transform_values(rest, lambda _, v: F.to_json(v)), lambda k, _: F.concat(F.lit(prefix), k))]
    for field in target.fields:
        if isinstance(field.dataType, T.StructType):
            child = F.coalesce(*[_at(value, n) for n in names_of(field)])
            out += _unknown(child, field.dataType, f"{prefix}{field.name}.")
    return out


def parse_typed(df: DataFrame, text: str, schema: T.StructType | str, drop_unknown: bool = True, lenient: bool = False) -> DataFrame:
    """The JSON objects of column ``text`` as the schema's columns and ``errorMessage``, other columns kept.

    A value that can't be converted is null, and ``errorMessage`` names the first such path; text that is no JSON object
    says so. Absent fields and JSON null are null without an error. A field comes by its own name or else by its first
    alias that is there. Unless unknown fields are dropped, map ``unknown`` holds their JSON text by name; those of records
    within lists and maps are not kept. ``lenient`` takes unquoted names too. A name that stands twice in an object makes
    it no JSON. Columns of df with names of the result are replaced."""
    target = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
    options = {"allowUnquotedFieldNames": "true"} if lenient else {}
    source = F.col(f"`{text}`")
    steps = Steps(df.columns)
    value = steps.add(0, F.from_json(source, "variant", options))
    is_object = steps.add(1, F.coalesce(F.schema_of_variant(value).startswith("OBJECT"), F.lit(False)))
    columns, errors = [], [F.when(source.isNotNull() & value.isNull(), F.lit("not JSON")), F.when(value.isNotNull() & ~is_object, F.lit("not a JSON object"))]
    for field in target.fields:
        child = steps.add(1, F.coalesce(*[_at(value, n) for n in names_of(field)]))
        done, error = walk(child, field.dataType, field.metadata, F.lit(field.name), steps, 1)
        columns.append(done.alias(field.name))
        errors.append(error)
    if not drop_unknown:
        maps = _unknown(value, target)
        empty = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))
        maps = [F.coalesce(m, empty) for m in maps]
        columns.append((F.map_concat(*maps) if len(maps) > 1 else maps[0]).alias("unknown"))
    made = {*target.names, "errorMessage", *([] if drop_unknown else ["unknown"])}
    kept = [F.col(f"`{c}`") for c in df.columns if c not in made and c != text]
    return steps.on(df).select(*kept, *columns, _first(errors).alias("errorMessage"))


def read_typed(spark: SparkSession, path: str | Sequence[str], schema: T.StructType | str, drop_unknown: bool = True,
               lenient: bool = False) -> DataFrame:
    """Files of one JSON object per line, read by ``parse_typed``; blank lines are no rows."""
    lines = spark.read.text(path if isinstance(path, str) else list(path)).where(F.trim("value") != "").withColumnRenamed("value", "line")
    return parse_typed(lines, "line", schema, drop_unknown, lenient)
