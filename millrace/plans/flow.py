"""Scripts, builders, attributes, routes, partitions, errors and row formats over ``events``."""

from __future__ import annotations

from uuid import uuid4

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators import errors, partition, project, route
from millrace.plans.registry import CONTEXT, plan
from millrace.session import shared_folder
from millrace.sources import rows as row_io
from millrace.sources import typed

ROUTES = {"big": "value > 10", "errors": "event_type = 'error'", "even_k": "k % 2 = 0", "never": "  "}
WITH_K = "WITH e AS (SELECT *, CAST(json_extract(props, '$.k') AS INTEGER) AS k, strftime(ts, '%Y-%m-%d') AS day FROM events)"
STAMP = "TIMESTAMP '2024-02-01 12:00:00'"


def with_k(t):
    return project.script(t.events, [("k", "cast(get_json_object(input.props, '$.k') as int)"),
                                     ("day", "date_format(input.ts, 'yyyy-MM-dd')")], context=CONTEXT, stamp=False)


@plan("script_both", f"""{WITH_K}
  SELECT event_id, user_id, event_type || '!' AS event_type, round(value * 2, 2) AS value, k, day, k + 1 AS next_k, 'acme' AS tenant,
    strftime({STAMP}, '%Y-%m-%d %H:%M:%S') AS "atTime" FROM e""")
def script_both(t):
    source = t.events.select("event_id", "user_id", "event_type", "value", "props", "ts")
    done = project.script(source, [
        ("k", "cast(get_json_object(input.props, '$.k') as int)"), ("day", "date_format(input.ts, 'yyyy-MM-dd')"),
        ("next_k", "output.k + 1"), ("value", "round(input.value * 2, 2)"), ("event_type", "concat(input.event_type, '!')"),
        ("tenant", "attributes['tenant']")], context=CONTEXT)
    return done.drop("props", "ts").withColumn("atTime", F.date_format("atTime", "yyyy-MM-dd HH:mm:ss"))


@plan("script_only", f"""{WITH_K}
  SELECT event_id AS id, k, strftime({STAMP}, '%Y-%m-%d %H:%M:%S') AS "atTime" FROM e""")
def script_only(t):
    done = project.script(t.events, [("id", "input.event_id"), ("k", "cast(get_json_object(input.props, '$.k') as int)")],
                          strategy=project.ONLY_OUTPUT, context=CONTEXT)
    return done.withColumn("atTime", F.date_format("atTime", "yyyy-MM-dd HH:mm:ss"))


@plan("builder_input", """
  SELECT event_id, CASE WHEN event_type IN ('view', 'click') THEN upper(event_type) ELSE event_type END AS event_type,
    coalesce(TRY_CAST(CASE WHEN event_id % 3 = 0 THEN 'x' ELSE CAST(user_id * 10 AS VARCHAR) END AS BIGINT), user_id) AS user_id,
    coalesce(TRY_CAST(CASE WHEN event_id % 3 = 0 THEN 'x' ELSE CAST(user_id * 10 AS VARCHAR) END AS BIGINT), user_id) + 1 AS next_user FROM events""")
def builder_input(t):
    return project.script(
        t.events.select("event_id", "event_type", "user_id"), [("next_user", "input.user_id + 1")],
        input_builder=[("event_type", "case when event_type in ('view', 'click') then upper(event_type) end"),
                       ("user_id", "try_cast(if(event_id % 3 = 0, 'x', cast(user_id * 10 as string)) as bigint)")],
        stamp=False)


@plan("builder_output", """
  SELECT event_id, round(value * 2, 2) AS doubled, CAST(floor(round(value * 2, 2)) AS BIGINT) AS whole, 'u' || user_id AS who FROM events""")
def builder_output(t):
    return project.script(t.events.select("event_id", "value", "user_id"), [("doubled", "round(input.value * 2, 2)")],
                          output_builder=[("whole", "floor(output.doubled)"), ("who", "concat('u', input.user_id)")],
                          stamp=False).select("event_id", "doubled", "whole", "who")


RAW = """WITH e AS (SELECT *, CASE WHEN event_id % 5 = 0 THEN event_type WHEN event_id % 7 = 0 THEN '99999999999' WHEN event_id % 11 <> 0 THEN CAST(user_id AS VARCHAR) END AS raw,
  event_id % 3 AS part, CASE WHEN event_id % 4 = 3 THEN event_id % 6 ELSE 0 END AS slot FROM events)"""
RAW_COLUMNS = {"raw": "case when event_id % 5 = 0 then event_type when event_id % 7 = 0 then '99999999999' when event_id % 11 <> 0 then cast(user_id as string) end",
               "part": "event_id % 3", "slot": "case when event_id % 4 = 3 then event_id % 6 else 0 end"}


def raw_events(t):
    return t.events.select("event_id", "user_id", "event_type", "value", *[F.expr(e).alias(c) for c, e in RAW_COLUMNS.items()])


@plan("script_failure", f"""{RAW}, c AS (
    SELECT *, CASE WHEN raw IS NOT NULL AND TRY_CAST(raw AS INTEGER) IS NULL THEN 'CAST_INVALID_INPUT: ' || raw || ' as INT'
      WHEN part = 0 THEN 'DIVIDE_BY_ZERO: input.user_id / input.part' WHEN slot >= 3 THEN 'INVALID_ARRAY_INDEX: ' || slot || ' of 3' END AS cause FROM e)
  SELECT event_id, CASE WHEN cause IS NULL THEN 'success' ELSE 'failure' END AS route, cause AS "errorMessage", value,
    CASE WHEN cause IS NULL THEN TRY_CAST(raw AS INTEGER) ELSE -1 END AS n,
    CASE WHEN cause IS NULL THEN user_id / part::DOUBLE END AS share,
    CASE WHEN cause IS NULL THEN [user_id, part, slot][slot + 1] END AS nth, cause IS NOT NULL AS told FROM c""")
def script_failure(t):
    """A cast, a division and an array place, each failing on some rows: those rows alone fail, first cause told."""
    source = raw_events(t).withColumn("n", F.lit(-1))
    return project.attempt(
        source, [("n", "cast(input.raw as int)"), ("share", "input.user_id / input.part"), ("nth", "array(input.user_id, input.part, input.slot)[input.slot]")],
        output_builder=[("told", "output.share is null")], context=CONTEXT, stamp=False).select(
        "event_id", "route", "errorMessage", "value", "n", "share", "nth", "told")


@plan("script_retry", f"""{RAW}, c AS (
    SELECT *, CASE WHEN event_type = 'error' THEN CASE WHEN part = 0 THEN 'RETRY: busy' ELSE 'refused ' || event_id END
      WHEN value <= 0.5 THEN 'value too small' WHEN part = 1 AND 100 / nullif(slot, 0)::DOUBLE IS NULL THEN 'DIVIDE_BY_ZERO: 100 / input.slot' END AS cause FROM e)
  SELECT event_id, CASE WHEN cause IS NULL THEN 'success' WHEN cause LIKE 'RETRY%' OR cause LIKE 'DIVIDE%' THEN 'retry' ELSE 'failure' END AS route,
    cause AS "errorMessage", CASE WHEN cause IS NULL THEN CASE WHEN part = 1 THEN 100 / nullif(slot, 0)::DOUBLE ELSE value END END AS score FROM c""")
def script_retry(t):
    """Errors that the script raises itself, some of which may be tried again."""
    return project.attempt(raw_events(t), [
        ("refusal", "if(input.event_type = 'error', raise_error(if(input.part = 0, 'RETRY: busy', concat('refused ', input.event_id))), null)"),
        ("checked", "assert_true(input.value > 0.5, 'value too small')"),
        ("score", "case when input.part = 1 then 100 / input.slot else input.value end")],
        strategy=project.ONLY_OUTPUT, input_builder=[], context=CONTEXT, stamp=False,
        output_builder=[("event_id", "input.event_id")],
        retry="errorMessage like 'RETRY%' or errorMessage like 'DIVIDE%'").select("event_id", "route", "errorMessage", "score")


@plan("builder_null", f"""{RAW}
  SELECT event_id, CASE WHEN event_type <> 'view' THEN event_type END AS event_type,
    CASE WHEN raw IS NOT NULL AND TRY_CAST(raw AS BIGINT) IS NULL THEN user_id ELSE TRY_CAST(raw AS BIGINT) END AS user_id,
    CASE WHEN part = 0 THEN value * 2 WHEN part = 1 THEN NULL ELSE value / part END AS doubled FROM e""")
def builder_null(t):
    """Builders that set null on purpose, and leave the old value only where they fail."""
    done = project.attempt(
        raw_events(t), [("doubled", "input.value * 2")],
        input_builder=[("event_type", "nullif(event_type, 'view')"), ("user_id", "cast(raw as bigint)")],
        output_builder=[("doubled", "nullif(input.part, 1) * input.value / (input.part * input.part)")], stamp=False)
    return done.select("event_id", "event_type", "user_id", "doubled")


@plan("builder_struct", """
  SELECT c_custkey, '{"id":' || c_custkey || ',"segment":"' || c_mktsegment || '"}' AS variables,
    '{"tenant":"acme","nation":"' || c_nationkey || '"}' AS headers FROM customer""")
def builder_struct(t):
    built = project.build_struct(project.with_attributes(t.customer, CONTEXT), {
        "variables": {"id": "c_custkey", "segment": "c_mktsegment"},
        "headers": {"tenant": "attributes['tenant']", "nation": "cast(c_nationkey as string)"}})
    return built.select("c_custkey", F.to_json("variables").alias("variables"), F.to_json("headers").alias("headers"))


@plan("expr_text", """
  SELECT event_id, coalesce(CAST(CASE WHEN event_id % 3 > 0 THEN user_id END AS VARCHAR), '') AS as_text FROM events""")
def expr_text(t):
    return t.events.select("event_id", project.expression_text("case when event_id % 3 > 0 then user_id end").alias("as_text"))


@plan("attrs_overlay", """
  SELECT event_id, 'events.parquet' AS filename, 'acme' AS tenant, value > 1000 AS over_min FROM events""")
def attrs_overlay(t):
    df = project.with_attributes(t.events, CONTEXT, {"filename": "file_name", "tenant": "file_name"})
    return project.script(df, [("filename", "attributes['filename']"), ("tenant", "attributes['tenant']"),
                               ("over_min", "input.value > cast(attributes['min_total'] as double)")],
                          stamp=False).select("event_id", "filename", "tenant", "over_min")


def _score(batch: pd.DataFrame) -> pd.DataFrame:
    return pd.DataFrame({"event_id": batch["event_id"], "score": (batch["value"] * 100).round().astype("int64"),
                         "errorMessage": batch["value"].map(lambda v: "value out of range" if v > 300 else None)})


@plan("udf_rows", """
  SELECT CASE WHEN value <= 300 THEN event_id END AS event_id, CASE WHEN value <= 300 THEN CAST(round(value * 100) AS BIGINT) END AS score,
    CASE WHEN value > 300 THEN event_id END AS failed_event, CASE WHEN value > 300 THEN 'value out of range' END AS "errorMessage" FROM events""")
def udf_rows(t):
    done = project.map_rows(t.events.select("event_id", "value"), _score, "event_id bigint, score bigint")
    return done.select("event_id", "score", F.get_json_object("failedInput", "$.event_id").cast("bigint").alias("failed_event"), "errorMessage")


def _score_some(batch: pd.DataFrame) -> pd.DataFrame:
    kept = batch[batch["value"] <= 300]  # code that forgets to answer for the others
    return pd.DataFrame({"event_id": kept["event_id"], "score": (kept["value"] * 100).round().astype("int64")})


@plan("udf_short", """
  SELECT CASE WHEN value <= 300 THEN event_id END AS event_id, CASE WHEN value <= 300 THEN CAST(round(value * 100) AS BIGINT) END AS score,
    CASE WHEN value > 300 THEN event_id END AS failed_event, CASE WHEN value > 300 THEN '0 results for 1 rows' END AS "errorMessage" FROM events""")
def udf_short(t):
    done = project.map_rows(t.events.select("event_id", "value"), _score_some, "event_id bigint, score bigint")
    return done.select("event_id", "score", F.get_json_object("failedInput", "$.event_id").cast("bigint").alias("failed_event"), "errorMessage")


ROUTED = f"""{WITH_K}, r AS (SELECT unnest(CASE WHEN len(hit) > 0 THEN hit ELSE ['unmatched'] END) AS route, event_id, k FROM (
    SELECT event_id, k, list_filter([CASE WHEN value > 10 THEN 'big' END, CASE WHEN event_type = 'error' THEN 'errors' END,
      CASE WHEN k % 2 = 0 THEN 'even_k' END], lambda x: x IS NOT NULL) AS hit FROM e))"""


@plan("route_multi", f"{ROUTED} SELECT route, event_id, k FROM r")
def route_multi(t):
    return route.route(with_k(t), ROUTES).select("route", "event_id", "k")


@plan("route_unmatched", f"{ROUTED} SELECT event_id, k FROM r WHERE route = 'unmatched'")
def route_unmatched(t):
    return route.split(route.route(with_k(t), ROUTES), ["unmatched"])["unmatched"].select("event_id", "k")


@plan("route_counts", f"{ROUTED} SELECT route, count(*) AS rows FROM r GROUP BY route")
def route_counts(t):
    return route.route_counts(with_k(t), ROUTES)


@plan("route_failure", """
  SELECT CASE WHEN event_id % 10 = 0 THEN 'failure' WHEN value > 10 THEN 'big' ELSE 'unmatched' END AS route, event_id,
    CASE WHEN event_id % 10 = 0 THEN 'value is not a number' END AS "errorMessage" FROM events""")
def route_failure(t):
    texts = t.events.select("event_id", F.when(F.col("event_id") % 10 == 0, "n/a").otherwise(F.col("value").cast("string")).alias("v"))
    return route.route(texts, {"big": "try_cast(v as double) > 10"},
                       checks={"value is not a number": "v is not null and try_cast(v as double) is null"}).drop("v")


@plan("partition_rows", """
  SELECT coalesce(CASE WHEN event_type <> 'view' THEN event_type END, 'default') AS partition, event_id FROM events""")
def partition_rows(t):
    return partition.partition_rows(t.events, "nullif(event_type, 'view')").select("partition", "event_id")


@plan("partition_counts", """
  SELECT CAST(json_extract(props, '$.k') AS VARCHAR) AS partition, count(*) AS rows FROM events GROUP BY 1""")
def partition_counts(t):
    return partition.partition_counts(t.events, "get_json_object(props, '$.k')")


# Errors as data: amounts as text, some unreadable, some out of reach for now

AMOUNTS = """WITH a AS (SELECT event_id, CASE WHEN event_id % 11 = 0 THEN 'abc' ELSE CAST(user_id AS VARCHAR) END AS amount,
    event_type = 'error' AS busy FROM events)"""
AMOUNT_CHECKS = {"amount is not a number": "amount is not null and try_cast(amount as int) is null"}


def amounts(t):
    text = F.when(F.col("event_id") % 11 == 0, "abc").otherwise(F.col("user_id").cast("string"))
    return t.events.select("event_id", text.alias("amount"), (F.col("event_type") == "error").alias("busy"))


@plan("error_classify", f"""{AMOUNTS}
  SELECT CASE WHEN amount = 'abc' THEN 'failure' WHEN busy THEN 'retry' ELSE 'success' END AS route,
    CASE WHEN amount = 'abc' THEN 'amount is not a number' WHEN busy THEN 'try later' END AS "errorMessage", count(*) AS rows FROM a GROUP BY ALL""")
def error_classify(t):
    marked = errors.classify(amounts(t), AMOUNT_CHECKS, {"try later": "busy"})
    return marked.groupBy("route", "errorMessage").agg(F.count(F.lit(1)).alias("rows"))


@plan("failure_envelope", f"""{AMOUNTS}
  SELECT 'flow-1' AS "processorId", 'check' AS "processorName", '{{"event_id":' || event_id || ',"amount":"abc","busy":' || busy || '}}' AS input,
    'amount is not a number' AS "errorMessage", '2024-02-01T12:00:00' AS "atTime" FROM a WHERE amount = 'abc'""")
def failure_envelope(t):
    _, failed, _ = errors.split_errors(errors.classify(amounts(t), AMOUNT_CHECKS))
    return errors.failure_envelope(failed, CONTEXT)


@plan("failure_inline", f"""{AMOUNTS}
  SELECT event_id, amount, busy, 'amount is not a number' AS "errorMessage", '2024-02-01 12:00:00' AS "atTime" FROM a WHERE amount = 'abc'""")
def failure_inline(t):
    _, failed, _ = errors.split_errors(errors.classify(amounts(t), AMOUNT_CHECKS))
    return errors.failure_inline(failed, CONTEXT).withColumn("atTime", F.date_format("atTime", "yyyy-MM-dd HH:mm:ss"))


@plan("retry_replay", f"""{AMOUNTS}
  SELECT CAST(0 AS INTEGER) AS attempt, count(*) AS rows, sum(event_id)::BIGINT AS ids FROM a UNION ALL
  SELECT CAST(1 AS INTEGER), count(*), sum(event_id)::BIGINT FROM a WHERE busy AND amount <> 'abc'""")
def retry_replay(t):
    _, _, again = errors.split_errors(errors.classify(amounts(t), AMOUNT_CHECKS, {"try later": "busy"}))
    return errors.retry_input(amounts(t), again).groupBy("attempt").agg(F.count(F.lit(1)).alias("rows"), F.sum("event_id").alias("ids"))


# Row formats

@plan("io_json_typed", """
  SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k, CAST(NULL AS VARCHAR) AS missing FROM events""")
def io_json_typed(t):
    parsed = t.events.select("event_id", row_io.parse_rows(F.col("props"), "k int, missing string").alias("p"))
    return parsed.select("event_id", "p.k", "p.missing")


LOOSE = """concat('{"ID":"', event_id, '","amount":', if(event_id % 4 = 0, concat('"', value, '"'), cast(value as string)), ',"ok":', if(event_id % 3 = 0, '"TRUE"', 'false'),
  ',"count":', case when event_id % 5 = 0 then '"many"' when event_id % 5 = 1 then 'null' else cast(user_id as string) end,
  ',"day":"', date_format(ts, 'yyyy-MM-dd'), '","tags":["', event_type, '",', event_id % 10, if(event_id % 7 = 0, ',{"z":1}', ''), '],"father":{"id":"', user_id,
  '","weights":{"a":1,"b":"', if(event_id % 11 = 0, 'x', '2'), '"},"seen":', event_id % 2, '},"extra":{"p":[1,2]},"source":"s', event_id % 3, '"}')"""


def loose(t, **how):
    father = T.StructType([typed.aliased("id", "bigint"), typed.aliased("weights", "map<string,int>")])
    schema = T.StructType([
        typed.aliased("id", "bigint", "ID", "key"), typed.aliased("amount", "double"), typed.aliased("ok", "boolean"),
        typed.aliased("count", "int"), typed.aliased("day", "date"), typed.aliased("tags", "array<string>"),
        typed.aliased("father", father), typed.aliased("missing", "string")])
    return typed.parse_typed(t.events.select("event_id", F.expr(LOOSE).alias("line")), "line", schema, **how)


@plan("io_json_coerce", """
  SELECT event_id, CAST(event_id AS BIGINT) AS id, value AS amount, event_id % 3 = 0 AS ok, CASE WHEN event_id % 5 > 1 THEN CAST(user_id AS INTEGER) END AS count,
    CAST(ts AS DATE) AS day, event_type || '|' || CAST(event_id % 10 AS VARCHAR) || CASE WHEN event_id % 7 = 0 THEN '|{"z":1}' ELSE '' END AS tags,
    CAST(user_id AS BIGINT) AS father_id, CASE WHEN event_id % 11 <> 0 THEN 2 END AS b, CAST(NULL AS VARCHAR) AS missing,
    CASE WHEN event_id % 5 = 0 THEN 'cannot convert field count: "many" as int'
      WHEN event_id % 11 = 0 THEN 'cannot convert field father.weights.b: "x" as int' END AS "errorMessage" FROM events""")
def io_json_coerce(t):
    """Texts where numbers, words and dates are wanted, a field by another name, lists and maps, and paths that fail."""
    return loose(t).select(
        "event_id", "id", "amount", "ok", "count", "day", F.array_join("tags", "|").alias("tags"), F.col("father.id").alias("father_id"),
        F.col("father.weights")["b"].alias("b"), "missing", "errorMessage")


@plan("io_json_unknown", """
  SELECT event_id, CAST(event_id AS BIGINT) AS id, 3 AS fields, '{"p":[1,2]}' AS extra, '"s' || event_id % 3 || '"' AS source,
    CAST(event_id % 2 AS VARCHAR) AS seen FROM events""")
def io_json_unknown(t):
    """Fields that the schema doesn't know, kept as they came."""
    unknown = F.col("unknown")
    return loose(t, drop_unknown=False).select(
        "event_id", "id", F.size("unknown").alias("fields"), unknown["extra"].alias("extra"), unknown["source"].alias("source"),
        unknown["father.seen"].alias("seen"))


@plan("io_json_lenient", """
  SELECT event_id, 'k' || CAST(user_id AS VARCHAR) AS name, event_type AS kind, CAST(user_id AS BIGINT) AS inner_id FROM events""")
def io_json_lenient(t):
    text = F.format_string("{name: 'k%d', \"kind\": \"%s\", father: {id: %d}}", "user_id", "event_type", "user_id")
    parsed = t.events.select("event_id", row_io.parse_rows(text, "name string, kind string, father struct<id:bigint>", lenient=True).alias("p"))
    return parsed.select("event_id", "p.name", "p.kind", F.col("p.father.id").alias("inner_id"))


@plan("io_write_jsonl", """
  SELECT event_id, '{"event_id":' || event_id || ',"ts":"' || strftime(ts, '%Y-%m-%d %H:%M:%S') || '","day":"' || strftime(ts, '%Y-%m-%d') || '"'
    || CASE WHEN event_id % 2 = 0 THEN ',"event_type":"' || event_type || '"' ELSE '' END || '}' AS line FROM events""")
def io_write_jsonl(t):
    df = t.events.select("event_id", "ts", F.to_date("ts").alias("day"), F.when(F.col("event_id") % 2 == 0, F.col("event_type")).alias("event_type"))
    return df.select("event_id", row_io.row_json(df).alias("line"))


@plan("io_json_array", """
  SELECT event_type, count(*) AS rows, CAST(sum(json_array_length(json_array(event_id))) AS BIGINT) AS items,
    CAST(sum(length('{"event_id":' || event_id || ',"user_id":' || user_id || '}')) AS BIGINT) AS text_size FROM events GROUP BY 1""")
def io_json_array(t):
    documents = row_io.json_arrays(t.events.select("event_type", "event_id", "user_id"), "event_type", rows_per_document=1000)
    return documents.groupBy("event_type").agg(
        F.sum("rows").alias("rows"), F.sum(F.json_array_length("document").cast("bigint")).alias("items"),
        F.sum(F.length("document") - F.col("rows") - 1).alias("text_size"))


@plan("io_json_rows", """
  SELECT event_type, CAST(event_id AS BIGINT) AS event_id, user_id FROM events""")
def io_json_rows(t):
    """Rows packed into JSON array documents and unpacked again: an array gives many rows."""
    documents = row_io.json_arrays(t.events.select("event_type", "event_id", "user_id"), "event_type", rows_per_document=500)
    items = row_io.parse_rows(F.col("document"), "array<struct<event_id:bigint,user_id:bigint>>")
    return documents.select("event_type", F.inline(items))


@plan("io_json_multiroot", "SELECT event_type, event_id, user_id FROM events")
def io_json_multiroot(t):
    """Array documents written back to back into files, then read as files of several roots."""
    path = f"{shared_folder(t.spark)}/roots-{uuid4().hex}"
    documents = row_io.json_arrays(t.events.select("event_type", "event_id", "user_id"), rows_per_document=1000)
    documents.select("document").write.option("maxRecordsPerFile", 4).text(path)
    return row_io.read_rows(t.spark, path, schema="event_type string, event_id bigint, user_id bigint", multi_root=True)


BAD_ROOT = "event_id % 50 = 7"


@plan("io_json_multiroot_bad", f"""
  SELECT CASE WHEN NOT {BAD_ROOT} AND event_id % 50 <> 9 THEN event_id END AS event_id, CASE WHEN event_id % 50 = 9 THEN '1' WHEN NOT {BAD_ROOT} THEN CAST(event_id % 10 AS VARCHAR) || '.10' END AS price,
    CASE WHEN {BAD_ROOT} THEN 'not JSON' WHEN event_id % 50 = 9 THEN 'does not fit the schema' END AS "errorMessage",
    CASE WHEN {BAD_ROOT} THEN '{{"event_id": ' || event_id || ' "lost"}}' WHEN event_id % 50 = 9 THEN '{{"event_id": "e' || event_id || '", "price": 1}}' END AS text FROM events""")
def io_json_multiroot_bad(t):
    """Objects and lists back to back without line breaks, files cut into many ranges: a bad document is an error row with
    its own text, and a number's text stays as written."""
    path = f"{shared_folder(t.spark)}/roots-{uuid4().hex}"
    root = F.when(F.expr(BAD_ROOT), F.format_string('{"event_id": %d "lost"}', "event_id")).when(
        F.expr("event_id % 50 = 9"), F.format_string('{"event_id": "e%d", "price": 1}', "event_id")).when(
        F.expr("event_id % 3 = 0"), F.format_string('[{"event_id": %d, "price": "%d.10"}]', "event_id", F.col("event_id") % 10)).otherwise(
        F.format_string('{"event_id":%d,"note":"}{ \\"[","price":"%d.10"}', "event_id", F.col("event_id") % 10))
    t.events.select(root.alias("root")).write.option("lineSep", " ").text(path)
    before = t.spark.conf.get("spark.sql.files.maxPartitionBytes")
    t.spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        return row_io.read_multi_root(t.spark, path, "event_id bigint, price string", errors=True)
    finally:
        t.spark.conf.set("spark.sql.files.maxPartitionBytes", before)
