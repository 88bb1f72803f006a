"""Schemas: inference, merging, renaming and strict conversion of columns.

Conversions follow the record rules rather than Spark's casts: text numbers are
not trimmed, only true and false are booleans, narrower integers keep the low
bits, numbers are epoch milliseconds where a time is wanted. What cannot be
converted becomes null, and ``conversion_error`` tells which rows those are.
"""

from __future__ import annotations

import json
import re
from collections.abc import Mapping, Sequence
from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.numbers import FLOATING, INTEGRAL, read_floating

# Fixed values
CHAR, TIME = "char", "time"  # metadata "kind" of text fields
DEFAULT_FORMATS = {"date": "yyyy-MM-dd", "timestamp": "yyyy-MM-dd HH:mm:ss", "time": "HH:mm:ss"}
INTEGER_BITS = {T.ByteType: 8, T.ShortType: 16, T.IntegerType: 32, T.LongType: 64}
BOOLEAN_WORDS = r"(?i)^(true|false)$"
# --- end of fixed values

NUMBERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)
TIMES = (T.DateType, T.TimestampType, T.TimestampNTZType)


def field(name: str, data_type: T.DataType | str, kind: str | None = None, fmt: str | None = None) -> T.StructField:
    """A target field; ``kind`` marks char and time texts, ``fmt`` is a date pattern."""
    parsed = T.DataType.fromDDL(data_type) if isinstance(data_type, str) else data_type
    return T.StructField(name, parsed, True, {k: v for k, v in (("kind", kind), ("format", fmt)) if v})


def _low_bits(value: Column, bits: int, data_type: T.DataType) -> Column:
    """Keep the low bits of a long, as narrowing does."""
    span = F.lit(1 << bits).cast("bigint")
    low = F.pmod(value, span)
    return F.when(low >= (1 << (bits - 1)), low - span).otherwise(low).cast(data_type)


def _integer(value: Column, source: T.DataType, target: T.DataType) -> Column:
    bits = INTEGER_BITS[type(target)]
    if isinstance(source, T.StringType):
        return F.when(value.rlike(INTEGRAL), value.try_cast(target))
    if isinstance(source, TIMES) and bits == 64:
        return F.unix_millis(value.cast("timestamp"))
    if isinstance(source, (T.FloatType, T.DoubleType, T.DecimalType)):
        if bits == 64:
            return F.when(F.isnan(value.cast("double")), F.lit(0)).otherwise(value.try_cast("bigint"))
        held = F.when(F.isnan(value.cast("double")), F.lit(0.0)).otherwise(F.least(F.greatest(value.cast("double"), F.lit(-2147483648.0)), F.lit(2147483647.0)))
        whole = held.cast("bigint")
        return whole.cast("int") if bits == 32 else _low_bits(whole, bits, target)
    if isinstance(source, tuple(INTEGER_BITS)):
        return value.cast(target) if INTEGER_BITS[type(source)] <= bits else _low_bits(value.cast("bigint"), bits, target)
    return F.lit(None).cast(target)


def _moment(value: Column, source: T.DataType, target: T.DataType, fmt: str) -> Column:
    if isinstance(source, TIMES):
        return value.cast(target)
    if isinstance(source, NUMBERS):
        return F.timestamp_millis(value.try_cast("bigint")).cast(target)
    if isinstance(source, T.StringType):
        text = F.trim(value)
        return F.when(text != "", F.try_to_timestamp(text, F.lit(fmt))).cast(target)
    return F.lit(None).cast(target)


def _text(value: Column, source: T.DataType, meta: dict) -> Column:
    kind, fmt = meta.get("kind"), meta.get("format")
    if kind == CHAR:
        return F.when(F.length(value.cast("string")) > 0, F.substring(value.cast("string"), 1, 1)) \
            if isinstance(source, T.StringType) else F.lit(None).cast("string")
    if kind == TIME:
        return F.date_format(_moment(value, source, T.TimestampType(), fmt or DEFAULT_FORMATS["time"]), "HH:mm:ss")
    if isinstance(source, TIMES):
        stamp = value.cast("timestamp")
        return F.date_format(stamp, fmt) if fmt else F.unix_millis(stamp).cast("string")
    if isinstance(source, (T.ArrayType, T.MapType, T.StructType)):
        return F.to_json(value)
    return value.cast("string")


def convert(value: Column, source: T.DataType, target: T.DataType, meta: dict | None = None, drop_unknown: bool = True) -> Column:
    """``value`` as the target type, null where the rules do not allow it."""
    meta = meta or {}
    if isinstance(target, T.StringType):
        return _text(value, source, meta)
    if isinstance(target, T.BooleanType):
        if isinstance(source, T.BooleanType):
            return value
        return F.when(value.rlike(BOOLEAN_WORDS), F.lower(value) == "true") if isinstance(source, T.StringType) else F.lit(None).cast("boolean")
    if isinstance(target, tuple(INTEGER_BITS)):
        return _integer(value, source, target)
    if isinstance(target, T.DecimalType):
        if isinstance(source, tuple(INTEGER_BITS)) or isinstance(source, T.DecimalType):
            return value.try_cast(target)
        return F.when(value.rlike(INTEGRAL), value.try_cast(target)) if isinstance(source, T.StringType) else F.lit(None).cast(target)
    if isinstance(target, (T.FloatType, T.DoubleType)):
        if isinstance(source, NUMBERS):
            return value.cast(target)
        return read_floating(value, target.simpleString()) if isinstance(source, T.StringType) else F.lit(None).cast(target)
    if isinstance(target, TIMES):
        fmt = meta.get("format") or DEFAULT_FORMATS["date" if isinstance(target, T.DateType) else "timestamp"]
        return _moment(value, source, target, fmt)
    if isinstance(target, T.ArrayType):
        if not isinstance(source, T.ArrayType):
            return F.lit(None).cast(target)
        return F.transform(value, lambda e: convert(e, source.elementType, target.elementType, meta, drop_unknown))
    if isinstance(target, T.MapType):
        if isinstance(source, T.MapType):
            keyed = F.transform_keys(value, lambda k, _: k.cast("string"))
            return F.transform_values(keyed, lambda _, v: convert(v, source.valueType, target.valueType, meta, drop_unknown))
        if isinstance(source, T.StructType):
            pairs = [p for f in source.fields for p in (F.lit(f.name), convert(value[f.name], f.dataType, target.valueType))]
            return F.when(value.isNotNull(), F.create_map(*pairs))
        return F.lit(None).cast(target)
    if isinstance(target, T.StructType):
        if isinstance(source, T.MapType):
            parts = [convert(F.try_element_at(value, F.lit(f.name)), source.valueType, f.dataType, f.metadata).alias(f.name) for f in target.fields]
        elif isinstance(source, T.StructType):
            have = {f.name: f.dataType for f in source.fields}
            parts = [(convert(value[f.name], have[f.name], f.dataType, f.metadata, drop_unknown) if f.name in have
                      else F.lit(None).cast(f.dataType)).alias(f.name) for f in target.fields]
            if not drop_unknown:
                parts += [value[n].alias(n) for n in have if n not in target.names]
        else:
            return F.lit(None).cast(target)
        return F.when(value.isNotNull(), F.struct(*parts))
    return value.try_cast(target)


def conversion_error(value: Column, source: T.DataType, target: T.DataType, meta: dict | None = None) -> Column:
    """True where a given value has no counterpart in the target type."""
    meta = meta or {}
    if isinstance(source, T.ArrayType) and isinstance(target, T.ArrayType):
        return F.coalesce(F.exists(value, lambda e: conversion_error(e, source.elementType, target.elementType, meta)), F.lit(False))
    if isinstance(source, T.StructType) and isinstance(target, T.StructType):
        have = {f.name: f.dataType for f in source.fields}
        bad = F.lit(False)
        for f in target.fields:
            if f.name in have:
                bad = bad | conversion_error(value[f.name], have[f.name], f.dataType, f.metadata)
        return bad
    temporal = isinstance(target, TIMES) or meta.get("kind") == TIME
    given = value.isNotNull()
    if temporal and isinstance(source, T.StringType):
        given = given & (F.trim(value) != "")
    return given & convert(value, source, target, meta).isNull()


def conform(df: DataFrame, schema: T.StructType, drop_unknown: bool = True, checked: bool = False,
            aliases: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
    """Columns of the schema, converted; absent ones are null. ``aliases`` name other
    columns a field may come from. Unknown columns go unless ``drop_unknown`` is off.
    ``checked`` adds ``errorMessage`` for rows with a value that cannot be converted."""
    have = {f.name: f.dataType for f in df.schema.fields}
    columns, errors, used = [], [], set()
    for f in schema.fields:
        sources = [n for n in [f.name, *(aliases or {}).get(f.name, [])] if n in have]
        used.update(sources)
        if not sources:
            columns.append(F.lit(None).cast(f.dataType).alias(f.name))
            continue
        tries = [convert(F.col(f"`{n}`"), have[n], f.dataType, f.metadata, drop_unknown) for n in sources]
        columns.append((tries[0] if len(tries) == 1 else F.coalesce(*tries)).alias(f.name))
        bad = conversion_error(F.col(f"`{sources[0]}`"), have[sources[0]], f.dataType, f.metadata)
        errors.append(F.when(bad, F.lit(f"cannot convert field {f.name}")))
    if not drop_unknown:
        columns += [F.col(f"`{n}`") for n in df.columns if n not in used]
    if checked:
        columns.append((F.coalesce(*errors) if errors else F.lit(None).cast("string")).alias("errorMessage"))
    return df.select(*columns)


def conform_defaults(df: DataFrame, fields: Sequence[str]) -> DataFrame:
    """Nulls of primitive columns become the type's zero value."""
    kinds = {f.name: f.dataType for f in df.schema.fields}

    def filled(name: str) -> Column:
        kind = kinds[name]
        if isinstance(kind, T.BooleanType):
            return F.coalesce(F.col(name), F.lit(False))
        return F.coalesce(F.col(name), F.lit(0).cast(kind)) if isinstance(kind, NUMBERS) else F.col(name)

    return df.withColumns({name: filled(name) for name in fields})


def is_compatible(text: Column, kind: str, fmt: str | None = None) -> Column:
    """Whether a text value could be read as the kind: boolean, byte, short, int, long,
    bigint, float, double, char, string, date, time or timestamp."""
    if kind == "string":
        return text.isNotNull()
    if kind == CHAR:
        return F.coalesce(F.length(text) > 0, F.lit(False))
    if kind == "boolean":
        fits = text.rlike(BOOLEAN_WORDS)
    elif kind in ("byte", "short", "int", "long"):
        spark_type = {"byte": "tinyint", "short": "smallint", "int": "int", "long": "bigint"}[kind]
        fits = text.rlike(INTEGRAL) & text.try_cast(spark_type).isNotNull()
    elif kind == "bigint":
        fits = text.rlike(INTEGRAL)
    elif kind in ("float", "double"):
        fits = text.rlike(FLOATING)
    elif kind in ("date", "time", "timestamp"):
        fits = F.try_to_timestamp(text, F.lit(fmt)).isNotNull() if fmt else text.rlike(r"^\d+$")
    else:
        raise ValueError(f"unknown kind {kind!r}")
    return F.coalesce(fits, F.lit(False))


def choose_type(text: Column, kinds: Sequence[str]) -> Column:
    """The first kind the value is compatible with, null when none is."""
    chain = None
    for kind in kinds:
        fits = is_compatible(text, kind)
        chain = F.when(fits, kind) if chain is None else chain.when(fits, kind)
    return chain


# Records and maps

def record_to_map(record: Column, data_type: T.StructType) -> Column:
    return convert(record, data_type, T.MapType(T.StringType(), T.StringType()))


def map_to_record(values: Column, schema: T.StructType) -> Column:
    return convert(values, T.MapType(T.StringType(), T.StringType()), schema)


# Inference

def infer_type(value) -> T.DataType:
    """The type of a sample value; null counts as text, lists take their first non-null item."""
    if isinstance(value, bool):
        return T.BooleanType()
    if isinstance(value, int):
        return T.IntegerType() if -(1 << 31) <= value < (1 << 31) else T.LongType()
    if isinstance(value, float):
        return T.DoubleType()
    if isinstance(value, (datetime, date)):
        return T.TimestampType()
    if isinstance(value, (list, tuple)):
        return T.ArrayType(infer_type(next((v for v in value if v is not None), None)))
    if isinstance(value, Mapping):
        return infer_schema(value)
    if value is None or isinstance(value, str):
        return T.StringType()
    raise TypeError(f"no field type for {type(value).__name__}")


def infer_schema(sample: Mapping) -> T.StructType:
    return T.StructType([T.StructField(str(k), infer_type(v)) for k, v in sample.items()])


def schema_of_example(example: str) -> T.StructType:
    """Schema of a JSON example of the output; of an array, its first object."""
    sample = json.loads(example)
    if isinstance(sample, list):
        sample = sample[0]
    return infer_schema(sample)


def conform_example(df: DataFrame, example: str) -> DataFrame:
    return conform(df, schema_of_example(example))


def merge_schema(input_schema: T.StructType, output_schema: T.StructType) -> T.StructType:
    """Input fields that the output does not replace, then the output fields."""
    return T.StructType([f for f in input_schema.fields if f.name not in output_schema.names] + list(output_schema.fields))


def result_schema(result: T.StructType, input_schema: T.StructType) -> T.StructType:
    """Result fields followed by input fields; a name on both sides is refused."""
    double = sorted(set(result.names) & set(input_schema.names))
    if double:
        raise ValueError(f"duplicate field names: {double}")
    return T.StructType(list(result.fields) + list(input_schema.fields))


AVRO_NAMES = {T.StringType: "string", T.IntegerType: "int", T.ShortType: "int", T.ByteType: "int", T.LongType: "long",
              T.FloatType: "float", T.DoubleType: "double", T.BooleanType: "boolean"}


def _avro_type(data_type: T.DataType, name: str):
    if isinstance(data_type, T.ArrayType):
        return {"type": "array", "items": _avro_type(data_type.elementType, name)}
    if isinstance(data_type, T.MapType):
        return {"type": "map", "values": _avro_type(data_type.valueType, name)}
    if isinstance(data_type, T.StructType):
        return {"type": "record", "name": name, "fields": [
            {"name": f.name, "type": ["null", _avro_type(f.dataType, f"{name}_{f.name}")]} for f in data_type.fields]}
    if isinstance(data_type, T.DateType):
        return {"type": "int", "logicalType": "date"}
    if isinstance(data_type, TIMES):
        return {"type": "long", "logicalType": "timestamp-millis"}
    return AVRO_NAMES[type(data_type)]


def schema_text(schema: T.StructType, name: str = "record") -> str:
    """The schema as Avro-style JSON text with nullable fields."""
    return json.dumps(_avro_type(schema, name), separators=(",", ":"))


# Names

def to_underscore(name: str) -> str:
    return re.sub("([a-z])([A-Z])", r"\1_\2", name).lower()


def to_camel(name: str) -> str:
    return re.sub("_([a-z])", lambda m: m.group(1).upper(), name.lower()) if "_" in name else name


def rename_columns(df: DataFrame, style: str) -> DataFrame:
    """Rename all columns to ``camel`` or ``underscore``; a clash is refused."""
    change = {"camel": to_camel, "underscore": to_underscore}[style]
    names = [change(c) for c in df.columns]
    if len(set(names)) < len(names):
        raise ValueError(f"renaming makes names clash: {names}")
    return df.toDF(*names)
