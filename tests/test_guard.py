"""Failing expressions as data: value, cause, and what they do to a script's rows."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from millrace.operators import errors, project
from millrace.operators.guard import guard

ROWS = [("1", 2, [1, 2], "2024-01-01", {"k": 1}), ("x", 0, [1], "nope", {}), (None, None, None, None, None),
        ("99999999999", 3, [5, 6, 7], "2024-02-30", {"z": 2})]
CAST = "CAST_INVALID_INPUT: {} as INT"
CASES = {
    "cast(a as int) + b": [3, CAST.format("x"), None, CAST.format("99999999999")],
    "a::int": [1, CAST.format("x"), None, CAST.format("99999999999")],
    "try_cast(a as int)": [1, None, None, None],
    "10 / b": [5.0, "DIVIDE_BY_ZERO: 10 / b", None, 10 / 3],
    "10 % b": [0, "DIVIDE_BY_ZERO: 10 % b", None, 1],
    "10 div b": [5, "DIVIDE_BY_ZERO: 10 div b", None, 3],
    "b * 2147483647 + 1": ["ARITHMETIC_OVERFLOW: b * 2147483647", 1, None, "ARITHMETIC_OVERFLOW: b * 2147483647"],
    "c[b]": ["INVALID_ARRAY_INDEX: 2 of 2", 1, None, "INVALID_ARRAY_INDEX: 3 of 3"],
    "element_at(c, b)": [2, "INVALID_ARRAY_INDEX: 0 of 1", None, 7],
    "m['k']": [1, None, None, None],
    "to_date(d)": ["2024-01-01", "CANNOT_PARSE: to_date of nope", None, "CANNOT_PARSE: to_date of 2024-02-30"],
    "case when b <> 0 then 10 / b else -1 end": [5.0, -1.0, -1.0, 10 / 3],
    "case a when '1' then cast(a as int) when 'x' then int(a) end": [1, CAST.format("x"), None, None],
    "b <> 0 and 10 / b > 4": [True, False, None, False],
    "b = 0 or 10 / b > 4": [True, True, None, False],
    "coalesce(b, cast(a as int))": [2, 0, None, 3],
    "if(b > 0, 1, raise_error('no'))": [1, "no", "no", 1],
    "assert_true(b > 0, 'bad b')": [None, "bad b", "bad b", None],
    "b between cast(a as int) and 5": [True, CAST.format("x"), None, CAST.format("99999999999")],
    "not (cast(a as int) in (1, 2))": [False, CAST.format("x"), None, CAST.format("99999999999")],
    "struct(cast(a as int) as q).q": [1, CAST.format("x"), None, CAST.format("99999999999")],
    "'it''s \\'' || cast(a as int)": ["it's '1", CAST.format("x"), None, CAST.format("99999999999")],
    "nullif(a, '1')": [None, "x", None, "99999999999"],
    "transform(c, z -> z + 1)[0]": [2, 2, None, 6],
    "'çé' || (cast(a as int)) -- trailing": ["çé1", CAST.format("x"), None, CAST.format("99999999999")],
}


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame(ROWS, "a string, b int, c array<int>, d string, m map<string, int>").coalesce(1)


@pytest.mark.parametrize("text", CASES)
def test_value_or_cause(rows, text):
    form = guard(rows, text)
    got = rows.select(F.expr(form.value).alias("v"), F.expr(form.cause or "cast(null as string)").alias("e")).collect()
    for want, (value, cause) in zip(CASES[text], got):
        shown = str(value) if text.startswith("to_date") and value else value
        assert cause == want if cause else shown == want, (text, value, cause, want)


def test_a_failing_statement_costs_its_row_alone(rows):
    made = project.attempt(rows, [("b", "input.b + 1"), ("n", "cast(input.a as int)"), ("share", "10 / (output.b - 1)")],
                           output_builder=[("late", "concat('n', output.n)"), ("b", "cast(input.d as int)")], stamp=False)
    assert made.columns == ["route", "errorMessage", "a", "c", "d", "m", "b", "n", "share", "late"]
    got = {r.a: r for r in made.collect()}
    assert (got["1"].route, got["1"].b, got["1"].n, got["1"].share, got["1"].late) == ("success", 3, 1, 5.0, "n1")
    assert (got["x"].route, got["x"].errorMessage, got["x"].b, got["x"].n, got["x"].late) == ("failure", CAST.format("x"), 0, None, None)
    assert got[None].route == "success" and got[None].share is None
    ok, failed, again = errors.split_errors(made)
    assert (ok.count(), failed.count(), again.count()) == (2, 2, 0)


def test_retry_and_only_output(rows):
    made = project.attempt(rows, [("n", "if(input.b = 0, raise_error('RETRY later'), cast(input.a as int))")],
                           strategy=project.ONLY_OUTPUT, stamp=False)
    got = {(r.route, r.errorMessage, r.n, r.failedInput is None) for r in made.collect()}
    assert got == {("success", None, 1, True), ("retry", "RETRY later", None, False), ("success", None, None, True),
                   ("failure", CAST.format("99999999999"), None, False)}


def test_one_scan_and_no_python(spark):
    source = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    made = project.attempt(source, [("n", "cast(event_type as int)"), ("m", "value / (event_id % 3)")], stamp=False)
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Python" not in plan and "Exchange" not in plan


def test_names_and_empty_tables(rows):
    assert project.attempt(rows.limit(0), [("n", "10 / b")], stamp=False).collect() == []
    with pytest.raises(ValueError, match="reserved"):
        project.attempt(rows.withColumn("route", F.lit(1)), [("n", "1")])
