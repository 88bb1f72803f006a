"""Date and time helpers: Column in, Column out, no Python per row.

Text is read strictly. Every accepted layout is guarded by its shape, so a row
pays for at most one parse attempt however many layouts are allowed.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- Fixed values: accepted layouts, as (shape, Spark pattern), in natural order.
DIGITAL_DATE = (r"^\d{8}$", "yyyyMMdd")
STD_DATE = (r"^\d{4}-\d{1,2}-\d{1,2}$", "yyyy-M-d")
UTC_DATE = (r"^\d{4}-\d{1,2}-\d{1,2}T$", "yyyy-M-d'T'")
SLASH_DATE = (r"^\d{4}/\d{1,2}/\d{1,2}$", "yyyy/M/d")
CN_DATE = (r"^\d{4}年\d{1,2}月\d{1,2}日$", "yyyy'年'M'月'd'日'")
CN_SHORT_DATE = (r"^\d{2}年\d{1,2}月\d{1,2}日$", "yyyy'年'M'月'd'日'")  # century added before the parse
FIRST_YEAR_OF_1900S = "69"  # two-digit years from here on belong to 19xx, earlier ones to 20xx
DIGITAL_TIME = (r"^\d{14}$", "yyyyMMddHHmmss")
STD_TIME = (r"^\d{4}-\d{1,2}-\d{1,2} \d{1,2}:\d{1,2}:\d{1,2}$", "yyyy-M-d H:m:s")
UTC_TIME = (r"^\d{4}-\d{1,2}-\d{1,2}T\d{1,2}:\d{1,2}:\d{1,2}Z$", "yyyy-M-d'T'H:m:s'Z'")
UTC_BASIC_TIME_Z = (r"^\d{8}T\d{6}Z$", "yyyyMMdd'T'HHmmss'Z'")
UTC_BASIC_TIME = (r"^\d{8}T\d{6}$", "yyyyMMdd'T'HHmmss")
UTC_PLAIN_TIME = (r"^\d{4}-\d{1,2}-\d{1,2}T\d{1,2}:\d{1,2}:\d{1,2}$", "yyyy-M-d'T'H:m:s")
UTC_MILLI_TIME = (r"^\d{4}-\d{1,2}-\d{1,2}T\d{1,2}:\d{1,2}:\d{1,2}\.\d{3}Z$", "yyyy-M-d'T'H:m:s.SSS'Z'")
DIGITAL_MINUTE = (r"^\d{12}$", "yyyyMMddHHmm")
DIGITAL_MONTH = (r"^\d{6}$", "yyyyMM")

DATE_LAYOUTS = [DIGITAL_DATE, STD_DATE, UTC_DATE, SLASH_DATE, CN_DATE, CN_SHORT_DATE]
TIME_LAYOUTS = [DIGITAL_TIME, STD_TIME, UTC_TIME, UTC_BASIC_TIME_Z, UTC_BASIC_TIME, UTC_PLAIN_TIME,
                DIGITAL_MINUTE, DIGITAL_MONTH]
UTC_LAYOUTS = [UTC_TIME, UTC_BASIC_TIME_Z, UTC_BASIC_TIME, UTC_PLAIN_TIME, UTC_MILLI_TIME]
ALL_LAYOUTS = [*DATE_LAYOUTS, DIGITAL_TIME, STD_TIME, UTC_TIME, UTC_BASIC_TIME_Z, UTC_BASIC_TIME,
               UTC_PLAIN_TIME, UTC_MILLI_TIME, DIGITAL_MINUTE, DIGITAL_MONTH]

INVALID_AGE = "-1"
PERIOD = re.compile(r"(\d+)([DMY]?)", re.IGNORECASE)
# --- end of fixed values


def _parse(text: Column, layouts: list[tuple[str, str]]) -> Column:
    chain = None
    for layout in layouts:
        shape, pattern = layout
        source = text
        if layout is CN_SHORT_DATE:
            source = F.concat(F.when(F.left(text, F.lit(2)) >= FIRST_YEAR_OF_1900S, "19").otherwise("20"), text)
        attempt = F.try_to_timestamp(source, F.lit(pattern))
        chain = F.when(text.rlike(shape), attempt) if chain is None else chain.when(text.rlike(shape), attempt)
    return chain


def _or_default(value: Column, default) -> Column:
    return value if default is None else F.coalesce(value, default if isinstance(default, Column) else F.lit(default))


def from_text(text: Column, default: Column | None = None) -> Column:
    """Timestamp from any accepted date or time layout; blank or bad text gives the default."""
    return _or_default(_parse(text, ALL_LAYOUTS), default)


def from_date_text(text: Column, default: Column | None = None) -> Column:
    return _or_default(_parse(text, DATE_LAYOUTS), default)


def from_time_text(text: Column, default: Column | None = None) -> Column:
    return _or_default(_parse(text, TIME_LAYOUTS), default)


def from_utc(text: Column) -> Column:
    return _parse(text, UTC_LAYOUTS)


def to_sql_date(text: Column) -> Column:
    return from_text(text).cast("date")


def _format(value: Column, pattern: str, default) -> Column:
    return _or_default(F.date_format(value, pattern), default)


def to_std_date(value: Column, default="") -> Column:
    return _format(value, "yyyy-MM-dd", default)


def to_std_time(value: Column, default="") -> Column:
    return _format(value, "yyyy-MM-dd HH:mm:ss", default)


def to_digital_date(value: Column, default="") -> Column:
    return _format(value, "yyyyMMdd", default)


def to_digital_month(value: Column, default="") -> Column:
    return _format(value, "yyyyMM", default)


def to_digital_year(value: Column, default="") -> Column:
    return _format(value, "yyyy", default)


def to_digital_time(value: Column, default="") -> Column:
    return _format(value, "yyyyMMddHHmmss", default)


def to_utc_date(value: Column, default="") -> Column:
    return _format(value, "yyyy-MM-dd'T'", default)


def to_utc_time(value: Column, default="") -> Column:
    return _format(value, "yyyy-MM-dd'T'HH:mm:ss'Z'", default)


def to_cn_date(value: Column, default="") -> Column:
    return _format(value, "yyyy'年'MM'月'dd'日'", default)


def to_digital_week(value: Column, default="") -> Column:
    """Calendar year followed by the two-digit week; weeks start on Sunday and
    the week holding 1 January is week 1, also for the last days of December."""
    saturday = F.date_add(F.to_date(value), F.lit(7) - F.dayofweek(value))
    jan_first_offset = F.dayofweek(F.trunc(F.to_date(value), "year")) - 1
    week = F.when(F.year(saturday) > F.year(value), F.lit(1)).otherwise(
        F.floor((F.dayofyear(value) - 1 + jan_first_offset) / 7) + 1)
    text = F.concat(F.lpad(F.year(value).cast("string"), 4, "0"), F.lpad(week.cast("string"), 2, "0"))
    return _or_default(text, default)


def from_text_then(formatter, text: Column, default="") -> Column:
    """The text overloads of the formatters: parse, then format, else the default."""
    return formatter(from_text(text), default)


def to_value(value: Column) -> Column:
    """Epoch milliseconds, 0 for null."""
    return F.coalesce(F.unix_millis(value.cast("timestamp")), F.lit(0).cast("bigint"))


def to_timestamp_text(value: Column) -> Column:
    return to_value(value).cast("string")


def age(birth: Column, end: Column | None = None) -> Column:
    """Whole years as text, -1 when a side is missing or the end is earlier."""
    end = F.current_timestamp() if end is None else end
    birth, end = birth.cast("timestamp"), end.cast("timestamp")
    before_birthday = F.date_format(end, "MMddHHmmss") < F.date_format(birth, "MMddHHmmss")
    years = F.year(end) - F.year(birth) - before_birthday.cast("int")
    return F.coalesce(F.when(end >= birth, years.cast("string")), F.lit(INVALID_AGE))


def age_from_text(birth: Column, end: Column | None = None) -> Column:
    return age(from_text(birth), None if end is None else from_text(end))


def parse_period(period: str) -> tuple[int, str]:
    """(amount, unit) of '10', '2M', '1y' …; the unit defaults to days."""
    found = PERIOD.fullmatch(period or "")
    if not found:
        raise ValueError(f"bad period {period!r}: use a number followed by D, M or Y")
    return int(found.group(1)), (found.group(2) or "D").upper()


def _shift(value: Column, period: str, sign: int) -> Column:
    amount, unit = parse_period(period)
    amount *= sign
    if unit == "D":
        step = F.make_dt_interval(days=F.lit(amount))
    elif unit == "M":
        step = F.make_ym_interval(months=F.lit(amount))
    else:
        step = F.make_ym_interval(years=F.lit(amount))
    return value.cast("timestamp") + step


def before(value: Column, period: str) -> Column:
    """Earlier by the period; month ends clamp and the time of day is kept."""
    return _shift(value, period, -1)


def after(value: Column, period: str) -> Column:
    return _shift(value, period, 1)


def now() -> Column:
    return F.current_timestamp()
