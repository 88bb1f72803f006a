"""Scalar helpers on small literals, including cases the tables do not hold."""

from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions import analyse, booleans, dates, numbers, strings


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


def text(value):
    return F.lit(value).cast("string")


@pytest.mark.parametrize("value, expected", [
    ("20180203", "2018-02-03 00:00:00"), ("2018-2-3", "2018-02-03 00:00:00"), ("2018/02/03", "2018-02-03 00:00:00"),
    ("2018年02月03日", "2018-02-03 00:00:00"), ("18年2月3日", "2018-02-03 00:00:00"), ("69年2月3日", "1969-02-03 00:00:00"),
    ("20180203040506", "2018-02-03 04:05:06"), ("2018-02-03T04:05:06Z", "2018-02-03 04:05:06"),
    ("2018-02-03T04:05:06.789Z", "2018-02-03 04:05:06"), ("201802", "2018-02-01 00:00:00"), ("201802030405", "2018-02-03 04:05:00"),
    ("2018-02-30", None), ("2018-13-01", None), (" 2018-02-03", None), ("", None), ("  ", None), (None, None), ("abc", None)])
def test_from_text(spark, value, expected):
    assert one(spark, F.date_format(dates.from_text(text(value)), "yyyy-MM-dd HH:mm:ss")) == expected


@pytest.mark.parametrize("day, week", [("2018-12-31", "201801"), ("2018-12-29", "201852"), ("2018-01-01", "201801"),
                                       ("2017-01-01", "201701"), ("2017-12-31", "201701"), ("2016-12-31", "201653")])
def test_week(spark, day, week):
    assert one(spark, dates.to_digital_week(F.lit(day).cast("date"))) == week


@pytest.mark.parametrize("birth, end, years", [("2000-02-29", "2023-02-28", "22"), ("2000-02-29", "2023-03-01", "23"),
                                               ("2000-01-01", "1999-01-01", "-1"), ("bad", "2000-01-01", "-1"), (None, "2000-01-01", "-1")])
def test_age(spark, birth, end, years):
    assert one(spark, dates.age_from_text(text(birth), text(end))) == years


def test_age_until_now(spark):
    assert int(one(spark, dates.age(F.lit("2000-01-01").cast("date")))) >= 24


@pytest.mark.parametrize("period, expected", [("1M", "2018-02-28"), ("1", "2018-01-30"), ("1y", "2017-03-31"), ("31d", "2018-02-28")])
def test_before(spark, period, expected):
    start = "2018-03-31" if period != "1" else "2018-01-31"
    assert one(spark, F.date_format(dates.before(F.lit(start).cast("timestamp"), period), "yyyy-MM-dd")) == expected


@pytest.mark.parametrize("period", ["", "M", "1W", "-1D", "1 D"])
def test_bad_period(period):
    with pytest.raises(ValueError):
        dates.parse_period(period)


def test_now(spark):
    assert isinstance(one(spark, dates.now()), datetime)


@pytest.mark.parametrize("name, expected", [("order_key", "orderKey"), ("a_1_b", "a_1B"), ("Plain", "Plain"), ("_lead_x", "LeadX"),
                                            ("trail_", "trail_"), ("a__b", "a_B"), ("A_B", "aB")])
def test_underscore_to_camel(spark, name, expected):
    assert one(spark, strings.underscore_to_camel(text(name))) == expected


def test_camel(spark):
    assert one(spark, strings.camel_to_underscore(text("orderKeyID"))) == "order_key_id"
    assert one(spark, strings.camel_to_underscore_first(text("OrderKey"))) == "order_Key"


def test_uuid(spark):
    ids = [r[0] for r in spark.range(1000).select(strings.create_uuid()).collect()]
    assert len(set(ids)) == 1000 and all(len(i) == 32 and "-" not in i for i in ids)


def test_joint_text(spark):
    kind = T.ArrayType(T.MapType(T.StringType(), T.IntegerType()))
    value = F.array(F.create_map(F.lit("a"), F.lit(1)), F.create_map(F.lit("b"), F.lit(2)))
    assert one(spark, strings.joint_text(value, kind)) == "\na1\nb2"
    assert one(spark, strings.joint_text(F.lit(None).cast("int"), T.IntegerType())) == "null"


@pytest.mark.parametrize("fn, args, expected", [
    (strings.substring, (1, 3), "bc"), (strings.substring, (-2,), "ef"), (strings.substring, (4, 2), ""), (strings.substring, (0, -1), "abcde"),
    (strings.left, (-1,), ""), (strings.right, (2,), "ef"), (strings.mid, (2, 2), "cd"), (strings.overlay, ("zz", 2, 4), "abzzef"),
    (strings.overlay, ("zz", 8, 10), "abcdefzz"), (strings.overlay, ("zz", 4, 2), "abzzef"), (strings.substring_after, ("c",), "def"),
    (strings.substring_after, ("x",), ""), (strings.substring_before_last, ("e",), "abcd"), (strings.substring_between, ("b", "e"), "cd"),
    (strings.substring_between, ("b", "x"), None), (strings.left_pad, (8, "*"), "**abcdef"), (strings.left_pad, (3, "*"), "abcdef"),
    (strings.center, (9, "-"), "-abcdef--"), (strings.abbreviate, (5,), "ab..."), (strings.capitalize, (), "Abcdef")])
def test_text(spark, fn, args, expected):
    assert one(spark, fn(text("abcdef"), *args)) == expected


@pytest.mark.parametrize("fn", [strings.trim, strings.upper_case, strings.capitalize, strings.reverse, strings.swap_case, strings.delete_whitespace])
def test_null_stays_null(spark, fn):
    assert one(spark, fn(text(None))) is None


def test_text_tests_of_null(spark):
    assert one(spark, strings.index_of(text(None), "a")) == -1
    assert one(spark, strings.is_blank(text(" \t\n"))) is True
    assert one(spark, strings.equal(text(None), text(None))) is True
    assert one(spark, strings.contains(text(None), "a")) is False
    assert one(spark, F.size(strings.split(text("a,,b"), ","))) == 2


@pytest.mark.parametrize("value, expected", [("12", 12), ("+7", 7), (" 12", 0), ("1.5", 0), ("99999999999", 0), (None, 0), ("", 0)])
def test_to_int(spark, value, expected):
    assert one(spark, numbers.to_int(text(value))) == expected


def test_numbers(spark):
    assert one(spark, numbers.double_format(F.lit(0.125), "0.00")) == "0.12"
    assert one(spark, numbers.double_format(F.lit(1234.5), "#,###.##")) == "1,234.5"
    assert one(spark, numbers.to_double(text("1e3"))) == 1000.0
    assert one(spark, numbers.is_number(text("0x1F"))) is True
    assert one(spark, numbers.is_number(text("1.2.3"))) is False
    assert one(spark, numbers.compare(F.lit(1), F.lit(2))) == -1


def test_booleans(spark):
    assert one(spark, booleans.to_boolean(text("Y"))) is True
    assert one(spark, booleans.to_boolean(text(None))) is False
    assert one(spark, booleans.to_boolean_object(text("maybe"))) is None
    assert one(spark, booleans.one_of(F.lit(True), F.lit(True), F.lit(True))) is True
    assert one(spark, booleans.to_yes_no(F.lit(None).cast("boolean"))) is None
    assert one(spark, booleans.is_not_false(F.lit(None).cast("boolean"))) is True


@pytest.mark.parametrize("values, limit, expected", [
    (["1", "2", "3", "100"], 800, 3), (["1", "2", "3"], 100, 3), ([], 10, 0), (["x", None], 10, 0), (["-5", "-7"], 100, 0), (["10", "x", "20"], 25, 20), (["10", "x", "20"], 24, 0)])
def test_max_without_noise(spark, values, limit, expected):
    assert one(spark, analyse.max_without_noise(F.array(*[text(v) for v in values]).cast("array<string>"), limit)) == expected


def test_grouped_noise_matches_list_form(spark):
    rows = [(i % 7, (i * 37) % 101) for i in range(500)]
    df = spark.createDataFrame(rows, "k int, v int")
    grouped = {r.k: r.noise_max for r in analyse.max_without_noise_by(df, ["k"], "v", 400).collect()}
    lists = df.groupBy("k").agg(F.collect_list(F.col("v").cast("string")).alias("vs"))
    listed = {r.k: r.m for r in lists.select("k", analyse.max_without_noise(F.col("vs"), 400).alias("m")).collect()}
    assert grouped == listed
