"""Streams give what the batch form gives, and a replayed batch changes nothing."""

from __future__ import annotations

import subprocess
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from millrace.context import RunContext
from millrace.operators import keyed, lookup, project, route, sequence
from millrace.session import shared_folder
from millrace.sources.rows import stream_rows, write_rows
from millrace.streaming import buckets, runner

SCHEMA = "id bigint, kind string, op string, seq bigint"
ROUTES = {"big": "id > 5", "click": "kind = 'click'"}


@pytest.fixture
def files(spark, tmp_path):
    """Four files with ten rows each."""
    for i in range(4):
        part = spark.range(i * 10, i * 10 + 10, 1, 1).select(
            (F.col("id") % 7).alias("id"), F.when(F.col("id") % 2 == 0, "click").otherwise("view").alias("kind"),
            F.when(F.col("id") % 5 == 0, "delete").when(F.col("id") % 3 == 0, "index").otherwise("upsert").alias("op"), F.col("id").alias("seq"))
        write_rows(part, str(tmp_path / "in" / f"p{i}"), "parquet")
    return str(tmp_path / "in" / "*"), tmp_path


def test_stream_equals_batch(spark, files):
    path, home = files
    batch = spark.read.parquet(path)
    dimension = spark.createDataFrame([("click", 1), ("view", 2)], "name string, rank int")

    def flow(df):
        scripted = project.script(df, [("double", "input.id * 2")], context=RunContext(), stamp=False)
        return route.route(lookup.lookup_many(scripted, dimension, {"kind": "name"}, ["rank"]), ROUTES)

    source = stream_rows(spark, path, SCHEMA, "parquet", files_per_batch=1)
    query = runner.run_stream(source, flow, [runner.folder_sink(str(home / "out"))], checkpoint=str(home / "cp"))
    out = spark.read.parquet(str(home / "out"))
    columns = ["route", "id", "kind", "seq", "double", "rank"]
    assert sorted(out.select(*columns).collect()) == sorted(flow(batch).select(*columns).collect())
    assert out.select("batch").distinct().count() == 4 and runner.observed_rows(query) == 40


def test_counts_of_more_batches_than_spark_remembers(spark, files):
    path, home = files
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")
    try:
        query = runner.run_stream(stream_rows(spark, path, SCHEMA, "parquet"), lambda df: route.route(df, ROUTES), [runner.folder_sink(str(home / "many"))], checkpoint=str(home / "many-cp"))
        assert len(query.recentProgress) <= 2 and runner.observed_rows(query) == 40
    finally:
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")


def test_outputs_are_separate_folders(spark, files):
    path, home = files
    source = stream_rows(spark, path, SCHEMA, "parquet")
    runner.run_stream(source, lambda df: route.route(df, ROUTES), [
        runner.folder_sink(str(home / "a")), runner.folder_sink(str(home / "b"), split_by=None)], checkpoint=str(home / "cp"))
    assert spark.read.parquet(str(home / "a/batch=0/route=click")).count() == 20
    assert spark.read.parquet(str(home / "a")).count() == spark.read.parquet(str(home / "b")).count()


def test_failed_batch_is_delivered_again(spark, files):
    path, home = files
    source = stream_rows(spark, path, SCHEMA, "parquet", files_per_batch=2)
    sink = runner.folder_sink(str(home / "out"), split_by=None)

    def broken(df, batch):
        sink(df, batch)
        if batch == 1:
            raise RuntimeError("lost")

    with pytest.raises(Exception, match="lost"):
        runner.run_stream(source, lambda df: df, [broken], checkpoint=str(home / "cp"))
    runner.run_stream(source, lambda df: df, [sink], checkpoint=str(home / "cp"))
    assert sorted(r.seq for r in spark.read.parquet(str(home / "out")).collect()) == list(range(40))


def test_keyed_sink_equals_one_application(spark, files):
    path, home = files
    schema, docs = "id bigint, kind string, extra int", str(home / "docs")
    source = stream_rows(spark, path, SCHEMA, "parquet")
    sink = runner.keyed_sink(docs, schema, "id", "op", ["seq"])
    runner.run_stream(source, lambda df: df, [sink], checkpoint=str(home / "cp"))
    want, _ = keyed.apply_changes(spark.createDataFrame([], schema), spark.read.parquet(path), "id", "op", ["seq"])
    want = sorted((r.id, r.kind) for r in want.collect())
    assert sorted((r.id, r.kind) for r in runner.documents(spark, docs, "id").collect()) == want
    sink(spark.read.parquet(path), 0)  # a replay of the batch
    assert sorted((r.id, r.kind) for r in runner.documents(spark, docs, "id").collect()) == want
    assert spark.read.parquet(f"{docs}/items").count() == 40


def test_keyed_sink_in_steps(spark, files):
    path, home = files
    schema, docs = "id bigint, kind string", str(home / "docs")
    sink = runner.keyed_sink(docs, schema, "id", "op", ["seq"])
    everything = spark.read.parquet(path)
    want_docs, want_items = keyed.apply_changes(spark.createDataFrame([], schema), everything, "id", "op", ["seq"])
    for batch in range(4):
        sink(everything.filter(F.col("seq").between(batch * 10, batch * 10 + 9)), batch)
        if batch == 1:
            assert runner.compact(spark, docs, "id") == 1
    sink(everything.filter(F.col("seq").between(30, 39)), 3)
    assert sorted(runner.documents(spark, docs, "id").collect()) == sorted(want_docs.collect())
    items = spark.read.parquet(f"{docs}/items").select("seq", "status").collect()
    assert sorted(items) == sorted(want_items.select("seq", "status").collect())


def test_bucket_sink_in_batches(spark, files):
    """Several batches, buckets written anew, a start that isn't empty, a replay: the same as one application."""
    path, home = files
    docs = str(home / "buckets")
    everything = spark.read.parquet(path)
    start = spark.createDataFrame([(i, "old") for i in range(0, 60, 2)], "id bigint, kind string")
    want_docs, want_items = keyed.apply_changes(start, everything, "id", "op", ["seq"])
    buckets.create(start, docs, "id", buckets=8)
    assert sorted(buckets.documents(spark, docs, "id").collect()) == sorted(start.collect())
    sink = buckets.bucket_sink(docs, "id", "op", ["seq"], most=2)
    for batch in range(4):
        sink(everything.filter(F.col("seq").between(batch * 10, batch * 10 + 9)), batch)
        if batch == 2:
            sink(everything.filter(F.col("seq").between(20, 29)), 2)
    state, count = buckets._manifest(spark, docs, 3)
    assert count == 8 and any(version is not None and version >= 0 for version, _ in state.values()) and all(len(d) < 2 for _, d in state.values())
    assert sorted(map(repr, buckets.documents(spark, docs, "id").collect())) == sorted(map(repr, want_docs.collect()))
    items = spark.read.parquet(f"{docs}/items").select("seq", "status").collect()
    assert sorted(items) == sorted(want_items.select("seq", "status").collect())
    assert buckets.changed_rows(spark, docs) == 40 and buckets.last_batch(spark, docs) == 3


def test_only_touched_buckets_are_read(spark, tmp_path):
    docs = str(tmp_path / "docs")
    start = spark.range(500).select("id", F.lit("old").alias("kind"))
    buckets.create(start, docs, "id", buckets=32)
    sink = buckets.bucket_sink(docs, "id", "op", ["seq"], most=9)
    some = spark.createDataFrame([(7, "new", "update", 1), (8, None, "delete", 2), (9000, "x", "update", 3), (None, "y", "update", 4)],
                                 "id bigint, kind string, op string, seq int")
    sink(some, 0)
    state, _ = buckets._manifest(spark, docs, 0)
    touched = {r[0] for r in some.where("id in (7, 8)").select(buckets.bucket_of("id", 32)).collect()}
    assert {b for b, (_, deltas) in state.items() if deltas} == touched
    base, deltas = buckets.stored(spark, docs, state, touched)
    assert {int(f.split("_bucket=")[1].split("/")[0]) for f in [*base.inputFiles(), *deltas.inputFiles()]} == touched
    assert {r.seq: r.status for r in spark.read.parquet(f"{docs}/items").collect()} == {1: 200, 2: 200, 3: 404, 4: 400}
    got = {r.id: r.kind for r in buckets.documents(spark, docs, "id").collect()}
    assert got == {**{i: "old" for i in range(500) if i != 8}, 7: "new"}
    sink(some.limit(0), 1)  # an empty batch
    sink(spark.range(500).selectExpr("id", "cast(null as string) kind", "'delete' op", "cast(id as int) seq"), 2)
    assert buckets.documents(spark, docs, "id").collect() == [] and buckets.changed_rows(spark, docs) == 504


def test_buckets_may_begin_empty(spark, tmp_path):
    docs = str(tmp_path / "docs")
    buckets.create(spark.createDataFrame([], "id string, kind string"), docs, "id", buckets=4)
    assert buckets.documents(spark, docs, "id").collect() == []
    sink = buckets.bucket_sink(docs, "id", "op", ["seq"], most=1)
    sink(spark.createDataFrame([("a", "k", "index", 1), (None, "fresh", "index", 2)], "id string, kind string, op string, seq int"), 0)
    got = buckets.documents(spark, docs, "id").collect()
    assert sorted(r.kind for r in got) == ["fresh", "k"] and all(r.id for r in got)
    with pytest.raises(ValueError, match="reserved"):
        buckets.create(spark.createDataFrame([], "id string, _batch int"), docs, "id")


def test_worker_functions_travel_with_the_job():
    """A worker that cannot import the package can still load what it is sent."""
    from pyspark import cloudpickle

    from millrace.functions.requests import read_request

    code = "import pickle, sys; f = pickle.loads(sys.stdin.buffer.read()); assert f('{ a }', {})[1] == 'a'"
    subprocess.run([sys.executable, "-c", code], input=cloudpickle.dumps(read_request), check=True, cwd="/tmp")


def test_queries_load_without_a_session():
    code = "import __spark_entry__ as e; assert set(e.queries()) >= set(e.oracle_sql())"
    subprocess.run([sys.executable, "-c", code], check=True, cwd=Path(__file__).resolve().parent.parent)


def test_sequence_as_a_scheduled_source(spark, tmp_path):
    """Each run takes the next slices: output first, state after it."""
    config = sequence.SequenceConfig("daily", init="2018-01-01", max="2018-01-05", batch=2)
    state = spark.createDataFrame([], sequence.STATE_SCHEMA)
    for run in range(4):
        slices = sequence.generate_sequence(spark, config, state)
        slices.write.mode("overwrite").parquet(str(tmp_path / f"slices/run={run}"))
        written = spark.read.parquet(str(tmp_path / f"slices/run={run}"))
        sequence.save_state(state, written).write.parquet(str(tmp_path / f"state/run={run}"))
        state = spark.read.parquet(str(tmp_path / f"state/run={run}"))
    got = [r.value for r in spark.read.parquet(str(tmp_path / "slices")).orderBy("value").collect()]
    assert got == [f"2018-01-0{d}" for d in range(1, 6)]


def test_shared_folder_comes_from_the_session(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    folder = shared_folder(spark)
    assert folder == named.rstrip("/") if named else folder.startswith("/tmp/run-")
    assert shared_folder(spark) == folder
