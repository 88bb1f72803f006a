"""Row files, JDBC tables and bulk files."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators import project
from millrace.context import RunContext
from millrace.operators.schema import conform, field
from millrace.sources import bulk, jdbc, rows

ACCOUNT = "id bigint, name string, balance double, state string"


def account(i: int) -> dict:
    return {"id": i, "name": f"Acc {i}", "balance": 10.5 * i, "state": "NY"}


def write(path, text: str) -> str:
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_lines_objects_and_arrays(spark, tmp_path):
    lines = write(tmp_path / "lines.json", "\n".join(json.dumps(account(i)) for i in range(3)))
    array = write(tmp_path / "array.json", json.dumps([account(i) for i in range(4)], indent=2))
    single = write(tmp_path / "single.json", json.dumps(account(1), indent=2))
    assert rows.read_rows(spark, lines).count() == 3
    assert rows.read_rows(spark, array, schema=ACCOUNT, whole_file=True).count() == 4
    assert rows.read_rows(spark, single, whole_file=True).first()["name"] == "Acc 1"


def test_several_roots_in_a_file(spark, tmp_path):
    objects = "\n".join(json.dumps(account(i), indent=2) for i in (1, 2))
    arrays = json.dumps([account(1), account(2)], indent=1) + "\n" + json.dumps([account(3), None, account(4)])
    write(tmp_path / "a.json", objects)
    write(tmp_path / "b.json", arrays)
    write(tmp_path / "c.json", "null")
    write(tmp_path / "d.json", "{\"id\": 9}{\"id\": 10, \"name\": \"}{ 标题\"}")
    df = rows.read_rows(spark, str(tmp_path), schema=ACCOUNT, multi_root=True)
    assert sorted(r.id for r in df.collect()) == [1, 1, 2, 2, 3, 4, 9, 10]
    assert df.filter("id = 10").first()["name"] == "}{ 标题"
    inferred = rows.read_rows(spark, str(tmp_path), multi_root=True)
    assert sorted(inferred.columns) == ["balance", "id", "name", "state"]


def test_first_row_schema(spark, tmp_path):
    path = write(tmp_path / "r.json", '{"id": 1}\n{"id": "x", "ip": "10.0.0.1"}\n')
    assert rows.read_rows(spark, path, first_row_schema=True).schema.simpleString() == "struct<id:bigint>"
    assert rows.read_rows(spark, path).schema.simpleString() == "struct<id:string,ip:string>"


def test_lenient_text(spark):
    df = spark.createDataFrame([("{id: 1, father: {id: 2}, children: [{id: 3}], 'name': 'x'}",), ("{\"id\": 4}",), ("[1]",)], "t string")
    parsed = df.select(rows.parse_rows(F.col("t"), "id int, father struct<id:int>, children array<struct<id:int>>, name string", lenient=True).alias("p")).select("p.*")
    got = parsed.collect()
    assert got[0].father.id == 2 and got[0].children[0].id == 3 and got[0].name == "x" and got[1].id == 4 and got[2].id is None


def test_ragged_rows_lose_nulls_on_write(spark, tmp_path):
    df = spark.sql("select 1 as id, null as gap, date'2018-01-02' as day, timestamp'2018-01-02 03:04:05' as at union all select 2, 'x', null, null")
    rows.write_rows(df, str(tmp_path / "out"))
    lines = sorted(r.value for r in spark.read.text(str(tmp_path / "out")).collect())
    assert lines == ['{"id":1,"day":"2018-01-02","at":"2018-01-02 03:04:05"}', '{"id":2,"gap":"x"}']


@pytest.mark.parametrize("fmt", ["json", "parquet", "orc"])
def test_formats_round_trip(spark, tmp_path, fmt):
    df = spark.createDataFrame([account(i) for i in range(5)], ACCOUNT)
    rows.write_rows(df, str(tmp_path / fmt), fmt, rows_per_file=2)
    back = rows.read_rows(spark, str(tmp_path / fmt), fmt, schema=ACCOUNT)
    assert sorted(back.collect()) == sorted(df.collect())


def test_avro_and_unknown_formats(spark, tmp_path):
    with pytest.raises(ValueError):
        rows.read_rows(spark, "x", "xml")
    df = spark.range(1)
    try:
        spark.read.format("avro").schema("a int").load([])
    except Exception:
        with pytest.raises(RuntimeError, match="spark-avro"):
            rows.write_rows(df, str(tmp_path / "a"), "avro")
        with pytest.raises(RuntimeError, match="spark-avro"):
            rows.read_rows(spark, str(tmp_path / "a"), "avro")


def test_array_documents(spark):
    df = spark.range(0, 1000, 1, 4).select(F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.concat(F.lit("g"), F.col("id"))).alias("g"), "id")
    documents = rows.json_arrays(df, "g", rows_per_document=50).collect()
    assert all(d.rows <= 50 and len(json.loads(d.document)) == d.rows for d in documents)
    assert sorted(i["id"] for d in documents for i in json.loads(d.document)) == list(range(1000))
    assert sum(d.rows for d in documents if d.g is None) == 333 and sum(d.rows for d in documents if d.g == "hot") == 334
    whole = rows.json_arrays(df.select("id")).collect()
    assert sum(len(json.loads(d.document)) for d in whole) == 1000 and "g" not in whole[0].asDict()


def test_file_attributes(spark, tmp_path):
    path = write(tmp_path / "in.json", '{"id": 1}')
    df = project.with_attributes(rows.read_rows(spark, path), RunContext(attributes={"tenant": "acme", "size": "mine"}),
                                 {"filename": "file_name", "size": "file_size"})
    assert df.first()["attributes"] == {"filename": "in.json", "tenant": "acme", "size": "mine"}


def test_typed_read_with_aliases(spark, tmp_path):
    path = write(tmp_path / "t.json", '{"userId": "7", "seen": "2018-01-02"}\n{"uid": "8", "more": 1}')
    target = T.StructType([field("uid", "int"), field("seen", "date")])
    got = conform(rows.read_rows(spark, path), target, aliases={"uid": ["userId"]}).collect()
    assert sorted((r.uid, str(r.seen)) for r in got) == [(7, "2018-01-02"), (8, "None")]


def test_jdbc_settings(spark):
    """Settings only: a round trip needs a database, and the tests start none."""
    options = jdbc.jdbc_options("jdbc:some:db", "some.Driver", user="u", password="p", timeout=5)
    assert options["queryTimeout"] == "5" and options["user"] == "u" and options["batchsize"] == "10000"
    for partition_column, bounds in (("id", {}), ("id", {"lower": 0})):
        with pytest.raises(ValueError):
            jdbc.read_table(spark, options, "people", partition_column=partition_column, **bounds)
    with pytest.raises(ValueError):
        jdbc.jdbc_options(" ", "d")
    with pytest.raises(Exception, match="some.Driver"):
        jdbc.read_table(spark, options, "people")


def test_bulk_files(spark, tmp_path):
    df = spark.range(10).select("id", F.lit("x").alias("v"))
    bulk.write_bulk(df, str(tmp_path / "bulk"), "events", "doc", "upsert", "id", rows_per_file=3)
    texts = [r.value for r in spark.read.text(str(tmp_path / "bulk"), wholetext=True).collect()]
    lines = [line for text in texts for line in text.strip().split("\n")]
    assert len(lines) == 20 and all(json.loads(line) for line in lines)
    assert json.loads(lines[0])["update"]["_index"] == "events" and json.loads(lines[1])["doc_as_upsert"] is True
    with pytest.raises(ValueError):
        bulk.write_bulk(df, str(tmp_path / "no"), " ", "doc", "index")
