"""Documents back to back, cut in byte ranges, against a plain walk over the whole text."""

from __future__ import annotations

import json
import random
from contextlib import contextmanager
from decimal import Decimal

import pytest

from millrace.sources import roots, rows


def documents(seed: int, count: int) -> tuple[str, list[str]]:
    """A text of documents and the text of its rows."""
    rng = random.Random(seed)
    words = ["a", "}{", "][", '\\"', "\\\\", "\\\\\\\"", "é", "标", ",", "x" * 50, "\\n", "{\\\"k\\\": [1}"]

    def value(deep: int) -> str:
        kind = rng.randrange(6 if deep else 3)
        if kind == 0:
            return rng.choice(["1.10", "-3", "1e5", "true", "null", "0"])
        if kind <= 2:
            return '"' + "".join(rng.choice(words) for _ in range(rng.randrange(4))) + '"'
        if kind == 3:
            return "[" + rng.choice([",", " , "]).join(value(deep - 1) for _ in range(rng.randrange(4))) + "]"
        return record(deep)

    def record(deep: int) -> str:
        return "{" + ", ".join(f'"k{i}":{rng.choice(["", " "])}{value(deep - 1)}' for i in range(rng.randrange(4))) + "}"

    parts, expect = [], []
    for _ in range(count):
        if rng.random() < 0.3:
            items = [record(2) if rng.random() < 0.7 else value(2) for _ in range(rng.randrange(5))]
            parts.append("[" + rng.choice([",", ",\n  "]).join(items) + "]")
            expect += [i for i in items if i != "null"]
        elif rng.random() < 0.1:
            bare = rng.choice(["null", "12", '"s }"'])
            parts.append(f" {bare} ")
            expect += [bare] if bare != "null" else []
        else:
            parts.append(record(3))
            expect.append(parts[-1])
    return "".join(p + rng.choice(["", "\n", " ", "\n\n"]) for p in parts), expect


@contextmanager
def small_ranges(spark, size: int):
    names = {"spark.sql.files.maxPartitionBytes": str(size), "spark.sql.files.openCostInBytes": "0", "spark.sql.files.minPartitionNum": "1"}
    before = {n: spark.conf.get(n, None) for n in names}
    for n, v in names.items():
        spark.conf.set(n, v)
    try:
        yield
    finally:
        for n, v in before.items():
            spark.conf.set(n, v) if v is not None else spark.conf.unset(n)


def texts(df):
    return sorted(r.text for r in df.collect())


@pytest.mark.parametrize("seed,size,broadcast", [(1, 10_000_000, True), (2, 700, True), (3, 97, True), (4, 300, False)])
def test_ranges_agree_with_a_plain_walk(spark, tmp_path, monkeypatch, seed, size, broadcast):
    if not broadcast:
        monkeypatch.setattr(roots, "MOST_BYTES", 0)
    expect = []
    for i in range(3):
        text, wanted = documents(seed * 10 + i, 120)
        for row in wanted:
            json.loads(row)
        (tmp_path / f"f{i}.json").write_bytes(("﻿" if i == 1 else "").encode() + text.encode())
        expect += wanted
    with small_ranges(spark, size):
        ranges = roots._ranges(spark, str(tmp_path)).select("path", "start").distinct().count()
        assert ranges == 3 if size > 1_000_000 else ranges > 20
        assert texts(roots.split_roots(spark, str(tmp_path))) == sorted(expect)


@pytest.mark.parametrize("size", [1_000_000, 16])
def test_endings_and_bad_documents(spark, tmp_path, size):
    cases = {"a": ('{"a": 1}{"a": 2', ['{"a": 1}', '{"a": 2']), "b": ('{"a": 1}}{"a": 3}\n', ['{"a": 1}', "}", '{"a": 3}']),
             "c": ("null", []), "d": ("", []), "e": ("[]", []), "f": ('[{"a": 1}, {"b": "}"}', ['{"a": 1}', '{"b": "}"}']),
             "g": ("[1, [2, 3], null]7 8", ["1", "[2, 3]", "7", "8"]), "h": ('{"s": "' + "x" * 200 + '"} ', ['{"s": "' + "x" * 200 + '"}'])}
    for name, (text, _) in cases.items():
        (tmp_path / f"{name}.json").write_text(text, encoding="utf-8")
    with small_ranges(spark, size):
        got = roots.split_roots(spark, str(tmp_path)).collect()
    for name, (_, wanted) in cases.items():
        assert sorted(r.text.strip() for r in got if r.path.endswith(f"/{name}.json")) == sorted(wanted), name


def test_many_ranges_share_a_task(spark, tmp_path, monkeypatch):
    text, expect = documents(6, 300)
    (tmp_path / "a.json").write_bytes(text.encode())
    (tmp_path / "b.json").write_bytes(text.encode())
    written = []
    plain = roots.stored
    monkeypatch.setattr(roots, "stored", lambda df, name: written.append((name, df.rdd.getNumPartitions())) or plain(df, name))
    with small_ranges(spark, 100):
        ranges = roots._ranges(spark, str(tmp_path)).select("path", "start").distinct().count()
        assert texts(roots.split_roots(spark, str(tmp_path))) == sorted([*expect, *expect])
    most = roots.TASKS_A_CORE * spark.sparkContext.defaultParallelism
    assert ranges > 5 * most and dict(written)["parts"] <= most


def test_errors_keep_their_text(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"id": 1, "p": 1.10}{"id": 2 oops}[{"id": "x"}, {"id": 3}]', encoding="utf-8")
    got = rows.read_rows(spark, str(tmp_path), schema="id int, p string", multi_root=True)
    assert sorted(r.id for r in got.collect() if r.id) == [1, 3]
    told = {(r.id, r.p, r.errorMessage, r.text) for r in rows.read_multi_root(spark, str(tmp_path), "id int, p decimal(6,2)", errors=True).collect()}
    assert told == {(1, Decimal("1.10"), None, None), (None, None, "not JSON", '{"id": 2 oops}'), (3, None, None, None),
                    (None, None, "does not fit the schema", '{"id": "x"}')}
