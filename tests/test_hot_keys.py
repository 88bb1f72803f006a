"""Hot keys: salted lookups, and new ids that are unique and without gaps."""

from __future__ import annotations

from collections import Counter
from statistics import median

import pytest
from pyspark.sql import functions as F

from millrace.operators import keyed, lookup
from millrace.plans import load_all
from millrace.plans.registry import PLANS, Tables

load_all()


@pytest.fixture()
def plain(spark):
    """No adaptive splitting and no broadcast, so that the plan's own spreading shows."""
    names = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {n: spark.conf.get(n) for n in names}
    for n, v in names.items():
        spark.conf.set(n, v)
    yield spark
    for n, v in before.items():
        spark.conf.set(n, v)


def test_a_hot_key_is_spread(plain):
    rows = plain.range(40_000).select("id", F.expr("case when id % 10 < 6 then 7 else id % 997 end").alias("k"))
    table = plain.range(997).select(F.col("id").alias("key"), (F.col("id") * 2).alias("twice"))
    found = lookup.lookup_salted(rows, table, {"k": "key"}, ["twice"], most=500)
    sizes = [r["count"] for r in found.groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) < 2 * median(sizes)
    unsalted = lookup.lookup_many(rows, table, {"k": "key"}, ["twice"])
    assert max(r["count"] for r in unsalted.groupBy(F.spark_partition_id()).count().collect()) > 20_000
    assert found.where("twice <> 2 * k or twice is null").count() == 0 and found.count() == 40_000


def test_salted_equals_many(spark):
    rows = spark.createDataFrame([(i, [1, 1, 1, None, 2, 9][i % 6], "x") for i in range(300)], "i int, k int, twice string")
    table = spark.createDataFrame([(1, "a"), (1, "b"), (2, None), (None, "n")], "k int, twice string")
    for most in (10, 1000):
        got = lookup.lookup_salted(rows, table, {"k": "k"}, ["twice"], most)
        want = lookup.lookup_many(rows, table, {"k": "k"}, ["twice"])
        assert got.columns == want.columns
        assert Counter(map(tuple, got.collect())) == Counter(map(tuple, want.collect()))
    assert lookup.lookup_salted(rows.limit(0), table, {"k": "k"}, ["twice"]).collect() == []


def test_the_query_meets_each_event_with_one_row_of_its_nation(spark, tmp_path, monkeypatch):
    events = [(i % 90, None if i % 11 == 0 else i % 30) for i in range(100)]  # repeated ids, missing users
    customers = [(None if i % 7 == 0 else i, None if i % 13 == 0 else i % 9) for i in range(400)]
    spark.createDataFrame(events, "event_id bigint, user_id bigint").write.parquet(f"{tmp_path}/events.parquet")
    spark.createDataFrame(customers, "c_custkey bigint, c_nationkey int").withColumn("c_name", F.lit("n")).write.parquet(f"{tmp_path}/customer.parquet")
    met = []
    plain_lookup = lookup.lookup_salted
    monkeypatch.setattr(lookup, "lookup_salted", lambda *a, **k: met.append(plain_lookup(*a, **k)) or met[-1])
    got = PLANS["lookup_salted"](Tables(spark, str(tmp_path))).collect()
    want = {}
    for event, user in events:
        k = 7 if event % 5 < 3 else None if event % 50 == 4 else user
        hits = [c for c, n in customers if k is not None and k < 25 and n == k % 40]
        keys = [c for c in hits if c is not None]
        rows, total = want.get((event, k), (0, None))
        want[event, k] = rows + len(keys), (total or 0) + sum(keys) if keys else total
    assert Counter(map(tuple, got)) == Counter((*key, *found) for key, found in want.items())
    assert met[0].count() == len(events)


def test_new_ids_are_gapless_and_stable(spark):
    rows = spark.createDataFrame([(None, f"v{i % 700}", i % 3) for i in range(2000)], "id bigint, v string, n int")
    got = keyed.allocate_ids(rows, "id", 11, ["n"], parts=16)
    assert got.columns == rows.columns
    ids = sorted(r.id for r in got.collect())
    assert ids == list(range(11, 2011))
    again = keyed.allocate_ids(rows.repartition(5), "id", 11, ["n"], parts=16)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, got.collect()))
    state = spark.createDataFrame([(5, "a"), (9, "b")], "id bigint, v string")
    changes = spark.createDataFrame([(None, "c", 1), (12, "d", 2), (None, "e", 3)], "id bigint, v string, seq int")
    done = {r.v: r.id for r in keyed.apply_index(state, changes, "id", ["seq"]).collect()}
    assert {done["c"], done["e"]} == {13, 14} and done["d"] == 12
    assert keyed.apply_index(state.limit(0), changes.limit(1), "id", ["seq"]).first().id == 1
