"""Typed JSON reading: coercion, aliases, unknown fields, failing paths."""

from __future__ import annotations

from datetime import date
from decimal import Decimal

from pyspark.sql import types as T

from millrace.operators.schema import field
from millrace.sources import typed

LINES = [
    '{"ID": "12", "price": 1.10, "ok": "TRUE", "n": 3, "day": "2024-02-30", "tags": [1, null, "x"], "father": {"key": 7, "more": [1]}, "z": null}',
    '{"id": 1, "ID": 2, "price": "25", "ok": true, "n": 3000000000, "day": "2024-02-28", "tags": [], "father": null}',
    '{"id": null, "ID": 3, "n": "4x", "tags": "no", "father": "no", "extra key": {"a": 1.5}}',
    "[1, 2]", "nope", "", "null", '{"id": 5', "{}", None, '{"id": 9, "day": " ", "n": 2.9, "price": true}']
SCHEMA = T.StructType([
    typed.aliased("id", T.LongType(), "ID", "uid"), typed.aliased("price", T.DecimalType(10, 2)), typed.aliased("ok", T.BooleanType()),
    typed.aliased("n", T.IntegerType()), field("day", T.DateType()), typed.aliased("tags", T.ArrayType(T.IntegerType())),
    typed.aliased("father", T.StructType([typed.aliased("id", T.StringType(), "key")]))])


def read(spark, **how):
    df = spark.createDataFrame([(i, line, "old") for i, line in enumerate(LINES)], "i int, line string, n string")
    return {r.i: r for r in typed.parse_typed(df, "line", SCHEMA, **how).collect()}


def test_coercion_aliases_and_paths(spark):
    got = read(spark)
    assert (got[0].id, got[0].price, got[0].ok, got[0].n, got[0].father.id) == (12, Decimal("1.10"), True, 3, "7")
    assert got[0].tags == [1, None, None] and got[0].day is None
    assert got[0].errorMessage == 'cannot convert field day: "2024-02-30" as date'
    assert (got[1].id, got[1].price, got[1].day, got[1].tags, got[1].father) == (1, Decimal("25.00"), date(2024, 2, 28), [], None)
    assert got[2].id is None and got[2].errorMessage == 'cannot convert field n: "4x" as int'
    assert got[2].tags is None and got[2].father is None
    assert [got[i].errorMessage for i in (3, 4, 6, 7)] == ["not a JSON object", "not JSON", "not a JSON object", "not JSON"]
    assert got[8].errorMessage is None and got[9].errorMessage is None and got[8].id is None
    assert (got[10].day, got[10].n, got[10].errorMessage) == (None, 2, "cannot convert field price: true as decimal(10,2)")


def test_list_places_are_told(spark):
    schema = T.StructType([typed.aliased("rows", T.ArrayType(T.StructType([typed.aliased("v", "int")])))])
    df = spark.createDataFrame([('{"rows": [{"v": 1}, {"v": "2"}, {"v": "b"}, 7]}',)], "line string")
    row = typed.parse_typed(df, "line", schema).first()
    assert [r and r.v for r in row["rows"]] == [1, 2, None, None]
    assert row.errorMessage == 'cannot convert field rows[2].v: "b" as int'


def test_unknown_fields_are_kept(spark):
    got = read(spark, drop_unknown=False)
    assert got[0].unknown == {"z": "null", "father.more": "[1]"}
    assert got[2].unknown == {"extra key": '{"a":1.5}'} and got[3].unknown == {} and got[9].unknown == {}


def test_lenient_names_files_and_one_scan(spark, tmp_path):
    (tmp_path / "a.json").write_text("{uid: 4, 'n': '5'}\n\n  \n{id: 6}\n", encoding="utf-8")
    df = typed.read_typed(spark, str(tmp_path), SCHEMA, lenient=True)
    assert sorted((r.id, r.n, r.errorMessage) for r in df.collect()) == [(4, 5, None), (6, None, None)]
    strict = typed.read_typed(spark, str(tmp_path), SCHEMA)
    assert {r.errorMessage for r in strict.collect()} == {"not JSON"}
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Python" not in plan


def test_empty_table_and_a_long_line(spark):
    df = spark.createDataFrame([], "line string, _step0_0 int")
    assert typed.parse_typed(df, "line", SCHEMA).columns == ["_step0_0", *SCHEMA.names, "errorMessage"]
    assert typed.parse_typed(df, "line", SCHEMA).collect() == []
    long = '{"tags": [' + ",".join(map(str, range(100_000))) + '], "id": "1"}'
    row = typed.parse_typed(spark.createDataFrame([(long,)], "line string"), "line", SCHEMA).first()
    assert len(row.tags) == 100_000 and row.id == 1
