"""Boolean helpers: Column in, Column out. Null is 'unknown', never an error."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words read as true and as false, in any case
TRUE_WORDS = ["true", "on", "yes", "t", "y"]
FALSE_WORDS = ["false", "off", "no", "f", "n"]


def to_boolean(text: Column) -> Column:
    """True for a true word, else false, also for null."""
    return F.coalesce(F.lower(text).isin(TRUE_WORDS), F.lit(False))


def to_boolean_object(text: Column) -> Column:
    """True, false, or null when the word is neither."""
    return F.when(F.lower(text).isin(TRUE_WORDS), True).when(F.lower(text).isin(FALSE_WORDS), False)


def to_integer(flag: Column, true_value: int = 1, false_value: int = 0, null_value: int | None = 0) -> Column:
    return F.when(flag.isNull(), F.lit(null_value).cast("int")).when(flag, true_value).otherwise(false_value)


def to_text(flag: Column, true_text: str, false_text: str, null_text: str | None = None) -> Column:
    return F.when(flag.isNull(), F.lit(null_text).cast("string")).when(flag, true_text).otherwise(false_text)


def to_yes_no(flag: Column) -> Column:
    return to_text(flag, "yes", "no")


def to_on_off(flag: Column) -> Column:
    return to_text(flag, "on", "off")


def to_true_false(flag: Column) -> Column:
    return to_text(flag, "true", "false")


def negate(flag: Column) -> Column:
    return ~flag


def all_of(*flags: Column) -> Column:
    return reduce(lambda a, b: a & b, flags)


def any_of(*flags: Column) -> Column:
    return reduce(lambda a, b: a | b, flags)


def one_of(*flags: Column) -> Column:
    """Exclusive or over all flags."""
    return reduce(lambda a, b: a != b, flags)


def is_true(flag: Column) -> Column:
    return flag.eqNullSafe(F.lit(True))


def is_not_true(flag: Column) -> Column:
    return ~is_true(flag)


def is_false(flag: Column) -> Column:
    return flag.eqNullSafe(F.lit(False))


def is_not_false(flag: Column) -> Column:
    return ~is_false(flag)
