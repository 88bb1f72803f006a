"""Statements that compare with parameters: binned, exact, and refused where they can't be."""

from __future__ import annotations

import random

import pytest

from millrace.context import RunContext
from millrace.operators import lookup


@pytest.fixture(scope="module")
def tables(spark):
    rng = random.Random(4)
    values = [None, float("nan"), float("inf"), float("-inf"), *[7.0] * 300, *[rng.uniform(-50, 50) for _ in range(400)]]
    table = [(i, v, i % 3) for i, v in enumerate(values)]
    asked = [(i, rng.uniform(-60, 60), rng.choice([0.0, 0.5, 5.0, 200.0])) for i in range(60)]
    asked += [(60, None, 1.0), (61, 7.0, 0.0), (62, 10.0, -3.0), (3, 1.0, 2.0)]
    asked = [(i, lo, None if lo is None else lo + w) for i, lo, w in asked]
    return (spark.createDataFrame(asked, "i int, lo double, hi double"), asked, spark.createDataFrame(table, "id int, v double, kind int"), table)


def above(v, lo):  # NaN is above every number
    return v is not None and (v != v or v >= lo)


def test_both_bounds(spark, tables):
    df, asked, table, rows = tables
    got = lookup.lookup_sql(df, "SELECT id FROM t WHERE v >= :lo AND v <= :hi OR v >= :lo AND kind = 9", views={"t": table},
                            within=lookup.Within("t", "v", "lo", "hi", bins=16))
    want = []
    for i, lo, hi in asked:
        hits = [id for id, v, _ in rows if lo is not None and above(v, lo) and v == v and v <= hi]
        want += [(i, lo, hi, id) for id in hits or [None]]
    assert sorted(map(repr, (tuple(r) for r in got.collect()))) == sorted(map(repr, want))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_one_bound_first_match_and_attributes(spark, tables):
    df, asked, table, rows = tables
    got = lookup.lookup_sql(df.select("i", "lo"), "SELECT id, v FROM t WHERE v >= :lo AND kind = :kind", mode=lookup.ONE, order_by=["v", "id"],
                            views={"t": table}, context=RunContext(attributes={"kind": "1"}), within=lookup.Within("t", "v", low="lo"))
    for r in got.collect():
        hits = sorted((v != v, v if v == v else 0, id) for id, v, kind in rows if kind == 1 and r.lo is not None and above(v, r.lo))
        assert r.id == (hits[0][2] if hits else None)


def test_statements_without_a_bound_side_are_refused(spark, tables):
    df, _, table, _ = tables
    with pytest.raises(ValueError, match="every pair"):
        lookup.lookup_sql(df, "SELECT id FROM t WHERE v > :lo", views={"t": table})
    assert lookup.lookup_sql(df, "SELECT id FROM t WHERE v > :lo", views={"t": table}, allow_loop=True).count() > 0
    within = lookup.Within("t", "v", "lo")
    with pytest.raises(ValueError, match="aggregates"):
        lookup.lookup_sql(df, "SELECT count(*) AS n FROM t WHERE v > :lo", views={"t": table}, within=within)
    with pytest.raises(ValueError, match="WHERE"):
        lookup.lookup_sql(df, "SELECT id FROM t WHERE v > :lo UNION ALL SELECT id FROM t WHERE v < :lo", views={"t": table}, within=within)


def test_dates_and_empty_tables(spark):
    df = spark.sql("select 1 as i, date'2024-01-10' as day union all select 2, date'2030-01-01'")
    table = spark.sql("select id, timestamp'2024-01-01 12:00:00' + make_interval(0,0,0,cast(id as int)) as at from range(20)")
    within = lookup.Within("t", "at", low="day")
    got = lookup.lookup_sql(df, "SELECT id FROM t WHERE at >= :day -- from then on\n", views={"t": table}, within=within)
    assert sorted((r.i, r.id or -1) for r in got.collect()) == [*((1, k) for k in range(9, 20)), (2, -1)]
    for left, right in ((df.limit(0), table), (df, table.limit(0))):
        found = lookup.lookup_sql(left, "SELECT id FROM t WHERE at >= :day", views={"t": right}, within=within)
        assert [r.id for r in found.collect()] == [None] * left.count()


def test_matches_are_not_shuffled_to_meet_their_rows(spark, tables):
    df, asked, table, rows = tables
    got = lookup.lookup_sql(df, "SELECT id, v AS hi FROM t WHERE v >= :lo AND v < :hi AND kind = 1", views={"t": table},
                            within=lookup.Within("t", "v", "lo", "hi", bins=16))
    lines = got._jdf.queryExecution().sparkPlan().toString().splitlines()
    assert "__bin" in next(line for line in lines if "Join" in line)
    want = []
    for i, lo, hi in asked:
        hits = [(id, v) for id, v, kind in rows if lo is not None and above(v, lo) and v == v and v < hi and kind == 1]
        want += [(i, lo, *hit) for hit in hits or [(None, None)]]
    assert got.columns == ["i", "lo", "id", "hi"] and sorted(map(repr, (tuple(r) for r in got.collect()))) == sorted(map(repr, want))
    twice = lookup.lookup_sql(df.union(df), "SELECT id FROM t WHERE v >= :lo AND v < :hi AND kind = 1", views={"t": table}, within=lookup.Within("t", "v", "lo", "hi", bins=16))
    assert twice.count() == 2 * len(want)


def written(frame, folder) -> tuple[int, int]:
    frame.write.parquet(str(folder))
    return sum(f.stat().st_size for f in folder.glob("*.parquet")), frame.sparkSession.read.parquet(str(folder)).count()


def test_matches_are_written_in_little_space(spark, tmp_path):
    """Every match is there, and takes less than a byte: in the order they come in, values stay the same or come again."""
    df = spark.range(900).selectExpr("id as i", "cast(hash(id) % 40 as double) as lo", "cast(60 + hash(id, 1) % 20 as double) as hi")
    table = spark.range(6000).selectExpr("xxhash64(id) as id", "cast(hash(id, 7) % 100 as double) as v")
    got = lookup.lookup_sql(df, "SELECT id, v FROM t WHERE v >= :lo AND v < :hi", views={"t": table}, within=lookup.Within("t", "v", "lo", "hi", bins=16))
    size, rows = written(got, tmp_path / "matches")
    assert rows == df.join(table, (table.v >= df.lo) & (table.v < df.hi), "left").count() > 1_000_000
    assert size < rows


def test_blocks_and_salts_lose_and_double_nothing(spark, tables, monkeypatch):
    df, asked, table, rows = tables
    monkeypatch.setattr(lookup, "BLOCK", 8)
    monkeypatch.setattr(lookup, "SETS", 5)
    hot = df.union(spark.sql("select 100, 6.0D, 8.0D from range(200)"))  # many rows alike ask for many rows alike
    both = table.union(table)
    statement = "SELECT *, :lo AS i FROM t WHERE v >= :lo AND v < :hi AND kind <> 2"
    got = lookup.lookup_sql(hot, statement, views={"t": both}, within=lookup.Within("t", "v", "lo", "hi", bins=16))
    assert got.columns == ["lo", "hi", "id", "v", "kind", "i"]
    want = []
    for i, lo, hi in [*asked, *[(100, 6.0, 8.0)] * 200]:
        hits = [(id, v, kind, lo) for id, v, kind in rows if lo is not None and above(v, lo) and v == v and v < hi and kind != 2] * 2
        want += [(lo, hi, *hit) for hit in hits or [(None,) * 4]]
    assert sorted(map(repr, (tuple(r) for r in got.collect()))) == sorted(map(repr, want))


def test_rows_that_ask_beyond_all_values_meet_no_bin(spark, tables):
    df = spark.sql("select id, cast(id as double) as lo, id + 1.0D as hi from range(-3, 30)")
    within, views = lookup.Within("t", "v", "lo", "hi", bins=4), {"t": spark.sql("select cast(id as double) as v from range(10)")}
    covered = lookup._covered(df, views["t"], RunContext(), within, lookup._cuts(views, within))
    assert sorted(r.id for r in covered.collect()) == list(range(-1, 10))


def test_rows_that_were_grouped_may_ask(spark, tables):
    df, _, table, _ = tables
    grouped = df.groupBy("lo", "hi").count()
    got = lookup.lookup_sql(grouped, "SELECT id FROM t WHERE v >= :lo AND v < :hi", views={"t": table}, within=lookup.Within("t", "v", "lo", "hi", bins=16))
    assert got.count() == grouped.join(table, (table.v >= grouped.lo) & (table.v < grouped.hi), "left").count()
