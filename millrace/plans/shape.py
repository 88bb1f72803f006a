"""Schema operators: conversion, compatibility, choice, records and names."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators import project, schema
from millrace.plans.registry import CONTEXT, plan

# Raw rows as text, every fifth unreadable
RAW = """WITH raw AS (SELECT event_id, CASE WHEN event_id % 5 = 0 THEN 'x' || user_id ELSE CAST(user_id AS VARCHAR) END AS user_text,
    CAST(CAST(floor(value) AS BIGINT) AS VARCHAR) || '.5' AS value_text, CASE WHEN event_id % 4 = 0 THEN 'TRUE' WHEN event_id % 4 = 1 THEN 'False' WHEN event_id % 4 = 2 THEN 'yes' END AS flag_text,
    strftime(ts, ' %Y-%m-%d %H:%M:%S ') AS ts_text, event_type FROM events)"""


def raw(t):
    return t.events.select(
        "event_id", F.when(F.col("event_id") % 5 == 0, F.concat(F.lit("x"), "user_id")).otherwise(F.col("user_id").cast("string")).alias("user_text"),
        F.concat(F.floor("value").cast("string"), F.lit(".5")).alias("value_text"),
        F.expr("case event_id % 4 when 0 then 'TRUE' when 1 then 'False' when 2 then 'yes' end").alias("flag_text"),
        F.date_format("ts", " yyyy-MM-dd HH:mm:ss ").alias("ts_text"), "event_type")


TARGET = T.StructType([
    schema.field("event_id", T.LongType()), schema.field("user_text", T.IntegerType()), schema.field("value_text", T.DoubleType()),
    schema.field("flag_text", T.BooleanType()), schema.field("ts_text", T.TimestampType()),
    schema.field("event_type", T.StringType(), schema.CHAR), schema.field("absent", T.LongType())])


@plan("conform", f"""{RAW}
  SELECT event_id, TRY_CAST(user_text AS INTEGER) AS user_text, CAST(value_text AS DOUBLE) AS value_text, CASE lower(flag_text) WHEN 'true' THEN TRUE WHEN 'false' THEN FALSE END AS flag_text,
    trim(ts_text) AS ts_text, left(event_type, 1) AS event_type, CAST(NULL AS BIGINT) AS absent,
    CASE WHEN event_id % 5 = 0 THEN 'cannot convert field user_text' WHEN flag_text = 'yes' THEN 'cannot convert field flag_text' END AS "errorMessage" FROM raw""")
def conform(t):
    return schema.conform(raw(t), TARGET, checked=True).withColumn("ts_text", F.date_format("ts_text", "yyyy-MM-dd HH:mm:ss"))


@plan("conform_nested", """
  SELECT p_partkey, CAST(p_size AS VARCHAR) AS size_text, CAST(p_size AS DOUBLE) AS first_size, 2 AS sizes, p_brand AS brand FROM part""")
def conform_nested(t):
    df = t.part.select("p_partkey", F.struct(F.col("p_size").alias("size"), F.col("p_brand").alias("brand"), F.lit(1).alias("extra")).alias("facts"),
                       F.array(F.col("p_size").cast("string"), F.lit("n/a")).alias("sizes"))
    target = T.StructType([schema.field("p_partkey", "bigint"), schema.field("facts", "struct<size:string,brand:string>"), schema.field("sizes", "array<double>")])
    done = schema.conform(df, target)
    return done.select("p_partkey", F.col("facts.size").alias("size_text"), F.get("sizes", F.lit(0)).alias("first_size"),
                       F.size("sizes").alias("sizes"), F.col("facts.brand").alias("brand"))


@plan("cast_matrix", f"""{RAW}
  SELECT event_id, TRY_CAST(user_text AS INTEGER) AS text_int, TRY_CAST(user_text AS BIGINT) AS text_long, CAST(epoch_us(CAST(trim(ts_text) AS TIMESTAMP)) // 1000 AS BIGINT) AS time_long,
    CAST(epoch_us(CAST(trim(ts_text) AS TIMESTAMP)) // 1000 AS VARCHAR) AS time_text, strftime(CAST(trim(ts_text) AS TIMESTAMP), '%H:%M:%S') AS time_of_day,
    strftime(make_timestamp(event_id * 1000000), '%Y-%m-%d %H:%M:%S') AS number_time, CAST(event_id % 256 - CASE WHEN event_id % 256 >= 128 THEN 256 ELSE 0 END AS INTEGER) AS low_byte,
    CAST(event_id AS VARCHAR) AS big, CASE lower(flag_text) WHEN 'true' THEN TRUE WHEN 'false' THEN FALSE END AS flag, CAST(NULL AS DOUBLE) AS bad_double FROM raw""")
def cast_matrix(t):
    text, whole, moment = T.StringType(), T.LongType(), T.TimestampType()
    df = raw(t).withColumn("at", F.to_timestamp(F.trim("ts_text"), "yyyy-MM-dd HH:mm:ss"))
    c = {n: F.col(n) for n in df.columns}
    return df.select(
        "event_id", schema.convert(c["user_text"], text, T.IntegerType()).alias("text_int"), schema.convert(c["user_text"], text, whole).alias("text_long"),
        schema.convert(c["at"], moment, whole).alias("time_long"), schema.convert(c["at"], moment, text).alias("time_text"),
        schema.convert(c["at"], moment, text, {"kind": schema.TIME}).alias("time_of_day"),
        F.date_format(schema.convert(c["event_id"] * 1000, whole, moment), "yyyy-MM-dd HH:mm:ss").alias("number_time"),
        schema.convert(c["event_id"], whole, T.ByteType()).cast("int").alias("low_byte"),
        schema.convert(c["event_id"], whole, T.DecimalType(38, 0)).cast("string").alias("big"),
        schema.convert(c["flag_text"], text, T.BooleanType()).alias("flag"), schema.convert(c["event_type"], text, T.DoubleType()).alias("bad_double"))


VALUE_TEXT = """WITH v AS (SELECT event_id, CASE event_id % 8 WHEN 0 THEN 'true' WHEN 1 THEN CAST(user_id AS VARCHAR) WHEN 2 THEN CAST(user_id + 3000000000 AS VARCHAR)
    WHEN 3 THEN CAST(user_id AS VARCHAR) || '.25' WHEN 4 THEN event_type WHEN 5 THEN '' WHEN 6 THEN '1e5' END AS s FROM events)"""


def value_texts(t):
    return t.events.select("event_id", F.expr("""case event_id % 8 when 0 then 'true' when 1 then cast(user_id as string) when 2 then cast(user_id + 3000000000 as string)
        when 3 then concat(user_id, '.25') when 4 then event_type when 5 then '' when 6 then '1e5' end""").alias("s"))


@plan("type_compat", f"""{VALUE_TEXT}
  SELECT event_id, event_id % 8 = 0 AS is_boolean, coalesce(event_id % 8 = 1 AND TRY_CAST(s AS TINYINT) IS NOT NULL, FALSE) AS is_byte, event_id % 8 = 1 AS is_int, event_id % 8 IN (1, 2) AS is_long,
    event_id % 8 IN (3, 6) AS is_double, event_id % 8 IN (1, 2) AS is_bigint, s IS NOT NULL AS is_string, event_id % 8 IN (0, 1, 2, 3, 4, 6) AS is_char, event_id % 8 IN (1, 2) AS is_date FROM v""")
def type_compat(t):
    kinds = ["boolean", "byte", "int", "long", "double", "bigint", "string", "char", "date"]
    return value_texts(t).select("event_id", *[schema.is_compatible(F.col("s"), k).alias(f"is_{k}") for k in kinds])


@plan("choice_type", f"""{VALUE_TEXT}
  SELECT CASE event_id % 8 WHEN 0 THEN 'boolean' WHEN 1 THEN 'int' WHEN 2 THEN 'long' WHEN 3 THEN 'double' WHEN 6 THEN 'double' WHEN 7 THEN NULL ELSE 'string' END AS kind, count(*) AS rows FROM v GROUP BY 1""")
def choice_type(t):
    chosen = schema.choose_type(F.col("s"), ["boolean", "int", "long", "double", "string"])
    return value_texts(t).select(chosen.alias("kind")).groupBy("kind").agg(F.count(F.lit(1)).alias("rows"))


@plan("record_to_map", """
  SELECT p_partkey, CAST(3 AS INTEGER) AS entries, CAST(p_size AS VARCHAR) AS size_text, p_name AS name_back, p_size AS size_back FROM part""")
def record_to_map(t):
    kind = T.StructType([T.StructField("name", T.StringType()), T.StructField("size", T.IntegerType()), T.StructField("brand", T.StringType())])
    record = F.struct(F.col("p_name").alias("name"), F.col("p_size").alias("size"), F.col("p_brand").alias("brand"))
    mapped = t.part.select("p_partkey", schema.record_to_map(record, kind).alias("m"))
    back = mapped.withColumn("r", schema.map_to_record(F.col("m"), kind))
    return back.select("p_partkey", F.size("m").alias("entries"), F.element_at("m", "size").alias("size_text"),
                       F.col("r.name").alias("name_back"), F.col("r.size").alias("size_back"))


@plan("conform_example", """
  SELECT CAST(event_id AS INTEGER) AS id, CAST(user_id AS VARCHAR) AS who, value AS amount FROM events""")
def conform_example(t):
    df = t.events.select(F.col("event_id").cast("string").alias("id"), F.col("user_id").alias("who"), F.col("value").alias("amount"), "props")
    return schema.conform_example(df, '{"id": 1, "who": "martin", "amount": 1.5}')


@plan("conform_defaults", """
  SELECT event_id, coalesce(CASE WHEN event_id % 3 > 0 THEN value END, 0) AS value, coalesce(CASE WHEN event_id % 2 > 0 THEN user_id END, 0) AS user_id,
    coalesce(CASE WHEN event_id % 5 > 0 THEN value > 10 END, FALSE) AS flag, CASE WHEN event_id % 3 > 0 THEN event_type END AS event_type FROM events""")
def conform_defaults(t):
    df = t.events.select("event_id", F.expr("if(event_id % 3 > 0, value, null)").alias("value"), F.expr("if(event_id % 2 > 0, user_id, null)").alias("user_id"),
                         F.expr("if(event_id % 5 > 0, value > 10, null)").alias("flag"), F.expr("if(event_id % 3 > 0, event_type, null)").alias("event_type"))
    return schema.conform_defaults(df, ["value", "user_id", "flag", "event_type"])


@plan("schema_merge", """
  SELECT event_id, event_type, 'v' || value AS value, CAST(user_id AS VARCHAR) AS user_id FROM (SELECT event_id, event_type, user_id, CAST(CAST(floor(value) AS BIGINT) AS VARCHAR) AS value FROM events)""")
def schema_merge(t):
    source = t.events.select("event_id", "event_type", "value", "user_id")
    done = project.script(source, [("value", "concat('v', floor(input.value))"), ("user_id", "cast(input.user_id as string)")], context=CONTEXT, stamp=False)
    output = T.StructType([T.StructField("value", T.StringType()), T.StructField("user_id", T.StringType())])
    return schema.conform(done, schema.merge_schema(source.schema, output))


@plan("rename_cols", """
  SELECT o_orderkey AS "oOrderkey", o_custkey AS "oCustkey", o_totalprice AS "oTotalprice" FROM orders""")
def rename_cols(t):
    return schema.rename_columns(t.orders.select("o_orderkey", "o_custkey", "o_totalprice"), "camel")


@plan("io_alias", """
  SELECT event_id, CASE WHEN event_id % 2 = 0 THEN user_id ELSE event_id END AS uid FROM events""")
def io_alias(t):
    df = t.events.select("event_id", F.expr("if(event_id % 2 = 0, cast(user_id as string), null)").alias("uid"), F.col("event_id").cast("string").alias("userId"))
    return schema.conform(df, T.StructType([schema.field("event_id", "bigint"), schema.field("uid", "bigint")]), aliases={"uid": ["userId"]})
