"""Text helpers: Column in, Column out."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

WHITESPACE = r"^\s+|\s+$"


def to_text(value: Column) -> Column:
    return F.coalesce(value.cast("string"), F.lit(""))


def to_json(value: Column) -> Column:
    return F.to_json(value)


def joint_text(value: Column, data_type: T.DataType) -> Column:
    """Flatten nested lists and maps into one text: each map or struct entry adds
    a line break, its key and its flattened value; a missing leaf reads 'null'."""
    if isinstance(data_type, T.ArrayType):
        inner = F.transform(value, lambda item: joint_text(item, data_type.elementType))
        return F.coalesce(F.array_join(inner, ""), F.lit("null"))
    if isinstance(data_type, T.MapType):
        inner = F.transform(F.map_entries(value), lambda entry: F.concat(
            F.lit("\n"), entry["key"].cast("string"), joint_text(entry["value"], data_type.valueType)))
        return F.coalesce(F.array_join(inner, ""), F.lit("null"))
    if isinstance(data_type, T.StructType):
        parts = [F.concat(F.lit("\n" + f.name), joint_text(value[f.name], f.dataType)) for f in data_type.fields]
        return F.when(value.isNull(), F.lit("null")).otherwise(F.concat(*parts)) if parts else F.lit("")
    return F.coalesce(value.cast("string"), F.lit("null"))


def create_uuid() -> Column:
    return F.replace(F.uuid(), F.lit("-"), F.lit(""))


def camel_to_underscore(text: Column) -> Column:
    """orderKey → order_key, all lower case."""
    return F.lower(F.regexp_replace(text, "([a-z])([A-Z])", "$1_$2"))


def camel_to_underscore_first(text: Column) -> Column:
    """Same split, but only the first letter is lowered: OrderKey → order_Key."""
    return uncapitalize(F.regexp_replace(text, "([a-z])([A-Z])", "$1_$2"))


def underscore_to_camel(text: Column) -> Column:
    """order_key → orderKey. Text without '_' is left alone; an underscore that
    no letter follows is kept."""
    pieces = F.split(F.lower(text), "_(?=[a-z])")
    head = F.element_at(pieces, 1)
    tail = F.transform(F.slice(pieces, F.lit(2), F.greatest(F.size(pieces) - 1, F.lit(0))),
                       lambda p: F.concat(F.upper(F.substring(p, 1, 1)), F.substring(p, 2, 1 << 30)))
    return F.when(F.instr(text, "_") == 0, text).otherwise(F.concat(head, F.array_join(tail, "")))


# Null- and whitespace-safe tests and defaults

def is_empty(text: Column) -> Column:
    return F.coalesce(text, F.lit("")) == ""


def is_blank(text: Column) -> Column:
    return F.coalesce(text, F.lit("")).rlike(r"^\s*$")


def is_not_blank(text: Column) -> Column:
    return ~is_blank(text)


def default_text(text: Column, default="") -> Column:
    return F.coalesce(text, F.lit(default))


def default_if_blank(text: Column, default) -> Column:
    return F.when(is_blank(text), F.lit(default)).otherwise(text)


# Case and trimming; null stays null

def trim(text: Column) -> Column:
    """Drop control characters and blanks at both ends."""
    return F.regexp_replace(text, r"^[\x00-\x20]+|[\x00-\x20]+$", "")


def strip(text: Column) -> Column:
    return F.regexp_replace(text, WHITESPACE, "")


def upper_case(text: Column) -> Column:
    return F.upper(text)


def lower_case(text: Column) -> Column:
    return F.lower(text)


def capitalize(text: Column) -> Column:
    return F.concat(F.upper(F.substring(text, 1, 1)), F.substring(text, 2, 1 << 30))


def uncapitalize(text: Column) -> Column:
    return F.concat(F.lower(F.substring(text, 1, 1)), F.substring(text, 2, 1 << 30))


def swap_case(text: Column) -> Column:
    """Upper becomes lower and the other way round, for any letter."""
    letters = F.split(text, "")
    return F.array_join(F.transform(letters, lambda c: F.when(c == F.upper(c), F.lower(c)).otherwise(F.upper(c))), "")


def reverse(text: Column) -> Column:
    return F.reverse(text)


# Parts of a text; offsets out of range give what is there

def substring(text: Column, start: int, end: int | None = None) -> Column:
    """From ``start`` (0-based, negative counts from the end) up to before ``end``."""
    size = F.length(text)
    first = F.lit(start) if start >= 0 else F.greatest(size + start, F.lit(0))
    last = size if end is None else (F.lit(end) if end >= 0 else size + end)
    last = F.least(last, size)
    return F.when(last > first, text.substr(first + 1, last - first)).when(text.isNotNull(), F.lit(""))


def left(text: Column, count: int) -> Column:
    return F.substring(text, 1, max(count, 0))


def right(text: Column, count: int) -> Column:
    return F.right(text, F.lit(max(count, 0)))


def mid(text: Column, start: int, count: int) -> Column:
    return F.substring(text, max(start, 0) + 1, max(count, 0))


def substring_before(text: Column, mark: str) -> Column:
    return F.substring_index(text, mark, 1)


def substring_after(text: Column, mark: str) -> Column:
    at = F.instr(text, mark)
    return F.when(at > 0, text.substr(at + len(mark), F.length(text))).when(text.isNotNull(), F.lit(""))


def substring_before_last(text: Column, mark: str) -> Column:
    keep = F.length(text) - F.length(F.substring_index(text, mark, -1)) - len(mark)
    return F.when(F.instr(text, mark) > 0, text.substr(F.lit(1), keep)).otherwise(text)


def substring_after_last(text: Column, mark: str) -> Column:
    return F.when(F.instr(text, mark) > 0, F.substring_index(text, mark, -1)).when(text.isNotNull(), F.lit(""))


def substring_between(text: Column, opening: str, closing: str) -> Column:
    """The first text enclosed by both marks, null when either is missing."""
    start = F.instr(text, opening)
    rest = text.substr(start + len(opening), F.length(text))
    end = F.instr(rest, closing)
    return F.when((start > 0) & (end > 0), rest.substr(F.lit(1), end - 1))


# Replacement

def replace(text: Column, search: str, replacement: str) -> Column:
    return F.replace(text, F.lit(search), F.lit(replacement)) if search else text


def remove(text: Column, search: str) -> Column:
    return replace(text, search, "")


def delete_whitespace(text: Column) -> Column:
    return F.regexp_replace(text, r"\s+", "")


def replace_pattern(text: Column, pattern: str, replacement: str) -> Column:
    """Every match; a dot also matches a line break."""
    return F.regexp_replace(text, "(?s)" + pattern, replacement)


def overlay(text: Column, replacement: str, start: int, end: int) -> Column:
    """Replace characters start … end-1 (0-based); both ends are clamped."""
    first, last = sorted((max(start, 0), max(end, 0)))
    size = F.length(text)
    head = text.substr(F.lit(1), F.least(F.lit(first), size))
    tail_at = F.least(F.lit(last), size)
    return F.concat(head, F.lit(replacement), text.substr(tail_at + 1, size - tail_at))


def repeat(text: Column, count: int) -> Column:
    return F.repeat(text, count)


# Tests

def contains(text: Column, part: str) -> Column:
    return F.coalesce(F.contains(text, F.lit(part)), F.lit(False))


def starts_with(text: Column, part: str) -> Column:
    return F.coalesce(F.startswith(text, F.lit(part)), F.lit(False))


def ends_with(text: Column, part: str) -> Column:
    return F.coalesce(F.endswith(text, F.lit(part)), F.lit(False))


def index_of(text: Column, part: str) -> Column:
    """0-based position, -1 when absent or null."""
    return F.coalesce(F.instr(text, part), F.lit(0)) - 1


def count_matches(text: Column, part: str) -> Column:
    if not part:
        return F.lit(0)
    shrunk = F.length(text) - F.length(F.replace(text, F.lit(part), F.lit("")))
    return F.coalesce((shrunk / len(part)).cast("int"), F.lit(0))


def equal(one: Column, other: Column) -> Column:
    return one.eqNullSafe(other)


def equal_ignore_case(one: Column, other: Column) -> Column:
    return F.lower(one).eqNullSafe(F.lower(other))


# Splitting, joining, padding

def split(text: Column, mark: str) -> Column:
    """Pieces between any of the characters of ``mark``, empty pieces left out."""
    chars = "[" + "".join(c if c.isalnum() or c.isspace() else "\\" + c for c in mark) + "]"
    return F.filter(F.split(text, chars), lambda piece: piece != "")


def join(values: Column, mark: str) -> Column:
    """Null items read as empty text."""
    return F.array_join(values, mark, "")


def left_pad(text: Column, size: int, pad: str = " ") -> Column:
    return F.when(F.length(text) >= size, text).otherwise(F.lpad(text, size, pad or " "))


def right_pad(text: Column, size: int, pad: str = " ") -> Column:
    return F.when(F.length(text) >= size, text).otherwise(F.rpad(text, size, pad or " "))


def center(text: Column, size: int, pad: str = " ") -> Column:
    """Pads grow on both sides; an odd blank goes to the right."""
    length = F.length(text)
    left_size = length + F.floor((F.lit(size) - length) / 2).cast("int")
    return F.when(length >= size, text).otherwise(
        F.rpad(F.lpad(text, left_size, F.lit(pad or " ")), F.lit(size), F.lit(pad or " ")))


def abbreviate(text: Column, width: int) -> Column:
    if width < 4:
        raise ValueError("the shortest width is 4")
    return F.when(F.length(text) <= width, text).otherwise(F.concat(F.substring(text, 1, width - 3), F.lit("...")))


def is_numeric(text: Column) -> Column:
    return F.coalesce(text.rlike(r"^\p{Nd}+$"), F.lit(False))


def is_alpha(text: Column) -> Column:
    return F.coalesce(text.rlike(r"^\p{L}+$"), F.lit(False))
