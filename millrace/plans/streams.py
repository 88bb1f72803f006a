"""The same operators on Structured Streaming micro-batches over ``events``.

Each run works off the whole table, writes into a new folder under the cluster's
shared checkpoint folder and returns what was written.
"""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import functions as F

from millrace.operators import errors, partition, project, route
from millrace.plans.flow import AMOUNT_CHECKS, AMOUNTS, ROUTED, ROUTES
from millrace.plans import joins
from millrace.plans.joins import CHANGES, STATE, changes
from millrace.plans.registry import CONTEXT, Tables, plan
from millrace.session import shared_folder
from millrace.sources.rows import stream_rows
from millrace.streaming import buckets, runner


def streamed(t: Tables, transform, sink=None):
    """Run ``events`` through a stream; gives the session and the output folder."""
    home = f"{shared_folder(t.spark)}/stream-{uuid4().hex}"
    source = stream_rows(t.spark, f"{t.folder}/events.parquet*", t.events.schema, format="parquet")
    sinks = [sink(f"{home}/out") if sink else runner.folder_sink(f"{home}/out")]
    runner.run_stream(source, transform, sinks, checkpoint=f"{home}/checkpoint", name=f"q{uuid4().hex[:8]}")
    return t.spark, f"{home}/out"


def _with_k(df):
    return project.script(df, [("k", "cast(get_json_object(input.props, '$.k') as int)")], context=CONTEXT, stamp=False)


@plan("stream_route", f"{ROUTED} SELECT route, count(*) AS rows, CAST(sum(event_id) AS BIGINT) AS ids FROM r GROUP BY route")
def stream_route(t):
    spark, out = streamed(t, lambda df: route.route(_with_k(df), ROUTES).select("route", "event_id"))
    return spark.read.parquet(out).groupBy("route").agg(F.count(F.lit(1)).alias("rows"), F.sum("event_id").alias("ids"))


@plan("stream_partition", "SELECT event_type AS partition, count(*) AS rows FROM events GROUP BY 1")
def stream_partition(t):
    spark, out = streamed(t, lambda df: partition.partition_rows(df, "event_type").select("partition", "event_id"),
                          lambda path: runner.folder_sink(path, split_by="partition"))
    return spark.read.parquet(out).groupBy("partition").agg(F.count(F.lit(1)).alias("rows"))


@plan("stream_outputs", f"""{AMOUNTS}
  SELECT CASE WHEN amount = 'abc' THEN 'failure' WHEN busy THEN 'retry' ELSE 'success' END AS route, count(*) AS rows FROM a GROUP BY 1""")
def stream_outputs(t):
    def classified(df):
        text = F.when(F.col("event_id") % 11 == 0, "abc").otherwise(F.col("user_id").cast("string"))
        rows = df.select("event_id", text.alias("amount"), (F.col("event_type") == "error").alias("busy"))
        return errors.classify(rows, AMOUNT_CHECKS, {"try later": "busy"})

    spark, out = streamed(t, classified)
    return spark.read.parquet(out).groupBy("route").agg(F.count(F.lit(1)).alias("rows"))


@plan("stream_keyed", f"""
  WITH x AS ({CHANGES}),
  b AS (SELECT x.*, last_value(CASE WHEN op <> 'update' THEN op END IGNORE NULLS) OVER (PARTITION BY id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM x),
  v AS (SELECT * FROM b WHERE op IN ('index', 'upsert') OR coalesce(before <> 'delete', FALSE)),
  z AS (SELECT id, max(event_id) FILTER (op IN ('index', 'delete')) AS reset, arg_max(op, event_id) FILTER (op <> 'update') AS last_op FROM v GROUP BY id)
  SELECT v.id, arg_max(kind, event_id) FILTER (kind IS NOT NULL AND (reset IS NULL OR event_id > reset OR event_id = reset AND op = 'index')) AS kind,
    arg_max(score, event_id) FILTER (score IS NOT NULL AND (reset IS NULL OR event_id > reset OR event_id = reset AND op = 'index')) AS score
  FROM v JOIN z ON v.id = z.id WHERE last_op <> 'delete' GROUP BY v.id""")
def stream_keyed(t):
    class Batch:
        def __init__(self, df):
            self.events = df

    spark, out = streamed(t, lambda df: changes(Batch(df)),
                          lambda path: runner.keyed_sink(path, "id bigint, kind string, score double", "id", "op", ["event_id"]))
    return runner.documents(spark, out, "id")


IN_BATCHES = """c AS (SELECT *, CASE WHEN op IN ('index', 'delete') THEN event_id END AS reset FROM x),
  all_rows AS (SELECT id, kind, score, op, event_id FROM c UNION ALL SELECT id, kind, score, 'index', -1 FROM s),
  b AS (SELECT *, last_value(CASE WHEN op <> 'update' THEN op END IGNORE NULLS) OVER (PARTITION BY id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM all_rows),
  v AS (SELECT * FROM b WHERE op IN ('index', 'upsert') OR coalesce(before <> 'delete', FALSE)),
  z AS (SELECT id, max(event_id) FILTER (op IN ('index', 'delete')) AS reset, arg_max(op, event_id) FILTER (op <> 'update') AS last_op FROM v GROUP BY id)"""


@plan("stream_buckets", f"""
  WITH x AS ({CHANGES}), s AS ({STATE}), {IN_BATCHES}
  SELECT v.id, arg_max(kind, event_id) FILTER (kind IS NOT NULL AND (reset IS NULL OR event_id > reset OR event_id = reset AND op = 'index')) AS kind,
    arg_max(score, event_id) FILTER (score IS NOT NULL AND (reset IS NULL OR event_id > reset OR event_id = reset AND op = 'index')) AS score,
    (SELECT count(*) FROM x) AS changes
  FROM v JOIN z ON v.id = z.id WHERE last_op <> 'delete' GROUP BY v.id""")
def stream_buckets(t):
    """Documents that exist already, changed by three batches, buckets written anew on the way."""
    path = f"{shared_folder(t.spark)}/buckets-{uuid4().hex}"
    buckets.create(joins.documents(t), path, "id", buckets=8)
    sink = buckets.bucket_sink(path, "id", "op", ["event_id"], most=2)
    low, high = t.events.agg(F.min("event_id"), F.max("event_id")).first()
    for batch in range(3):
        sink(changes(t).where(F.floor((F.col("event_id") - low) * 3 / (high - low + 1)) == batch), batch)
    return buckets.documents(t.spark, path, "id").withColumn("changes", F.lit(buckets.changed_rows(t.spark, path)).cast("bigint"))
