"""Number helpers: Column in, Column out."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Shapes of numbers in text
INTEGRAL = r"^[+-]?\d+$"
DECIMAL = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
# blanks and control characters around it, a type letter, hexadecimal with a binary exponent, the two words
READABLE = r"^[\x00-\x20]*[+-]?(NaN|Infinity|((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|0[xX]([0-9a-fA-F]+\.?|[0-9a-fA-F]*\.[0-9a-fA-F]+)[pP][+-]?\d+)[fFdD]?)[\x00-\x20]*$"
HEXADECIMAL = r"^([+-]?)0[xX]([0-9a-fA-F]*)\.?([0-9a-fA-F]*)[pP]([+-]?\d+)$"
FLOATING = r"^[+-]?(Infinity|NaN|\d+\.\d+|\d+(\.\d+)?[eE][+-]?\d+|\.\d+([eE][+-]?\d+)?)$"
CREATABLE = r"^[+-]?(0[xX][0-9a-fA-F]+|(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?[fFdD]?|\d+[lL])$"


def double_format(value: Column, pattern: str) -> Column:
    """Format with a decimal pattern such as '0.00' or '#,###.##', ties to even."""
    return F.call_function("format_number", value, F.lit(pattern))


def _parse(text: Column, shape: str, data_type: str, default) -> Column:
    return F.coalesce(F.when(text.rlike(shape), text.try_cast(data_type)), F.lit(default).cast(data_type))


def to_int(text: Column, default: int = 0) -> Column:
    """Whole text must be an integer in range, no blanks; else the default."""
    return _parse(text, INTEGRAL, "int", default)


def to_long(text: Column, default: int = 0) -> Column:
    return _parse(text, INTEGRAL, "bigint", default)


def to_short(text: Column, default: int = 0) -> Column:
    return _parse(text, INTEGRAL, "smallint", default)


def to_byte(text: Column, default: int = 0) -> Column:
    return _parse(text, INTEGRAL, "tinyint", default)


def read_floating(text: Column, data_type: str) -> Column:
    """A floating number in text, blanks around it allowed; null for any other text. Spark's own parser reads what is
    written without letters (other than e); only the rest is looked at closely."""
    plain = text.try_cast("double")
    return F.when(text.rlike("[A-DF-Za-df-z]"), _read_letters(text, data_type)).otherwise(plain.cast(data_type) if data_type != "double" else plain)


def _read_letters(text: Column, data_type: str) -> Column:
    """Floating numbers with a type letter, in hexadecimal, or one of the two words."""
    bare = F.regexp_replace(text, r"^[\x00-\x20]+|[\x00-\x20]+$", "")
    bare = F.when(bare.rlike("[pPxX]"), F.regexp_replace(bare, "[fFdD]$", "")).otherwise(F.regexp_replace(bare, "(?<=[0-9.])[fFdD]$", ""))
    whole, part = F.regexp_extract(bare, HEXADECIMAL, 2), F.regexp_extract(bare, HEXADECIMAL, 3)
    digits = F.conv(F.concat(whole, part), 16, 10).try_cast("decimal(20,0)").cast("double")
    power = F.regexp_extract(bare, HEXADECIMAL, 4).try_cast("int") - 4 * F.length(part)
    sign = F.when(F.regexp_extract(bare, HEXADECIMAL, 1) == "-", -1.0).otherwise(1.0)
    value = F.when(bare.rlike(HEXADECIMAL), sign * digits * F.pow(F.lit(2.0), power)).otherwise(bare.try_cast("double"))
    return F.when(text.rlike(READABLE), value.cast(data_type) if data_type != "double" else value)


def to_double(text: Column, default: float = 0.0) -> Column:
    return F.coalesce(read_floating(text, "double"), F.lit(default).cast("double"))


def to_float(text: Column, default: float = 0.0) -> Column:
    return F.coalesce(read_floating(text, "float"), F.lit(default).cast("float"))


def is_number(text: Column) -> Column:
    return F.coalesce(text.rlike(CREATABLE), F.lit(False))


def is_digits(text: Column) -> Column:
    return F.coalesce(text.rlike(r"^\p{Nd}+$"), F.lit(False))


def create_decimal(text: Column, precision: int = 38, scale: int = 10) -> Column:
    return F.when(text.rlike(DECIMAL), text.try_cast(f"decimal({precision},{scale})"))


def largest(*values: Column) -> Column:
    return F.greatest(*values)


def smallest(*values: Column) -> Column:
    return F.least(*values)


def compare(one: Column, other: Column) -> Column:
    """-1, 0 or 1."""
    return F.when(one < other, -1).when(one > other, 1).when(one == other, 0)
