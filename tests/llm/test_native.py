"""Decontamination, mixing, sharding and rules against plain Python."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict

from millrace.llm import decontaminate, mix, rules, shard
from tests.llm.cases import awkward, empty

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def item_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(FOLD))


def test_contamination_is_exact(spark):
    df, texts = awkward(spark)
    long = [t for _, t in texts if t and len(item_words(t)) > 30]
    items = [(1, " ".join(item_words(long[0])[3:20])), (2, long[1]), (10, "ONE"), (3, None), (4, ""), (None, long[2]), (2, long[1]), (5, "x x x x")]
    got = decontaminate.contamination(df, spark.createDataFrame(items, "item_id long, text string")).collect()
    windows = defaultdict(set)
    for i, t in items:
        w = item_words(t)
        if i is not None and w:
            for k in range(max(1, len(w) - 9)):
                windows[tuple(w[k : k + 10])].add(str(i))
    def find(text):
        w, hit, found = item_words(text), set(), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                if tuple(w[k : k + n]) in windows:
                    hit |= set(range(k, k + n))
                    found |= windows[tuple(w[k : k + n])]
        return len(w), len(hit), sorted(found)
    want = Counter()
    for d, t in texts:
        n, hit, found = find(t)
        want[d, n, hit, len(found), hashlib.sha256(",".join(found).encode()).hexdigest(), hit > 0] += 1
    assert Counter(tuple(r) for r in got) == want
    kept = decontaminate.clean(df, spark.createDataFrame(items, "item_id long, text string"))
    assert kept.columns == df.columns and kept.count() == sum(k for r, k in want.items() if not r[-1])


def test_rows_without_or_with_one_id_are_judged_alone(spark):
    leak = " ".join(f"b{k}" for k in range(12))
    rows = [(None, f"x {leak} y"), (None, "a clean text"), (None, None), (7, leak), (7, "another clean text"), (8, f"{leak} {leak}"), (None, leak)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    items = spark.createDataFrame([(1, leak)], "item_id long, text string")
    got = decontaminate.contamination(df, items).collect()
    want = Counter((d, len(item_words(t)), (t or "").count(leak) * 12) for d, t in rows)
    assert Counter((r.doc_id, r.n_words, r.n_hit) for r in got) == want
    assert all(r.contaminated == (r.n_hit > 0) == (r.n_items == 1) for r in got)
    kept = decontaminate.clean(df, items).collect()
    assert Counter(map(tuple, kept)) == Counter(r for r in rows if leak not in (r[1] or ""))


def test_contamination_of_nothing(spark):
    df, texts = awkward(spark)
    none = spark.createDataFrame([], "item_id long, text string")
    assert not decontaminate.contamination(df, none).where("contaminated").count()
    assert decontaminate.contamination(df, none).count() == len(texts)
    assert decontaminate.contamination(empty(spark), spark.createDataFrame([(1, "a b")], "item_id long, text string")).count() == 0


def test_mix_meets_targets(spark):
    df, texts = awkward(spark)
    rows = mix.mix(df, block=64).collect()
    assert len(rows) == len(texts) and all(0 <= r.taken <= 2 * r["size"] for r in rows)
    size, taken, target = Counter(), Counter(), {}
    for r in rows:
        size[r.source] += r["size"]
        taken[r.source] += r.taken
        target[r.source] = r.target
        assert r.source_size == sum(x["size"] for x in rows if x.source == r.source)
    order = sorted(size, key=lambda s: (s is None, s))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    left, want, open_ = 1.5 * sum(size.values()), {}, set(order)
    while open_:  # share by weight; what stops at twice its size leaves the rest to the others
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if level * weight[s] > 2 * size[s]}
        if not full:
            want |= {s: level * weight[s] for s in open_}
            break
        want |= {s: 2.0 * size[s] for s in full}
        left -= sum(2 * size[s] for s in full)
        open_ -= full
    assert all(abs(target[s] - want[s]) < 1e-6 and taken[s] == int(target[s]) for s in order)
    again = mix.mix(df.repartition(3), block=64).collect()
    assert sorted(map(str, again)) == sorted(map(str, rows))
    assert mix.mix(empty(spark)).count() == 0
    assert {r.taken for r in mix.mix(df.where("text is null or text = ''")).collect()} == {0}
    assert mix.mixed(df).columns == df.columns


def test_mixed_counts_each_row_by_itself(spark):
    """Rows without an id, with one id, and alike rows each stand as often as their own words are taken."""
    texts = [(None, f"w{i} " * (i + 1)) for i in range(30)] + [(7, f"x{i % 5} " * 20) for i in range(20)] + [(i, "y " * (i + 3)) for i in range(20)]
    texts += [(None, None), (None, ""), (7, " "), (None, None)]
    full = [(d, t, "ab"[i % 2], i, -1) for i, (d, t) in enumerate(texts)]
    df = spark.createDataFrame(full, "doc_id long, text string, source string, place int, _row int").repartition(5)
    rows = {r.place: r for r in mix.mix(df, block=16, row="place").collect()}
    assert len(rows) == len(texts)
    got = mix.mixed(df, block=16).collect()
    assert sum(r.taken for r in rows.values()) == sum(int(t) for t in {r.source: r.target for r in rows.values()}.values())
    want, have = Counter(), Counter()  # of alike rows it does not matter which stands for which
    for i, r in rows.items():
        want[full[i][:3]] += int(r.taken / r["size"] + 0.5) if r["size"] else 1
    for r in got:
        have[r.doc_id, r.text, r.source] += 1
    assert have == +want
    assert df.columns == mix.mixed(df).columns and all(r["_row"] == -1 for r in got)


def test_every_stretch_of_the_mix_is_near_the_weights(spark):
    texts = [(i, "w " * (20 + i % 30), "abc"[i % 3]) for i in range(1500)]
    df = spark.createDataFrame(texts, "doc_id long, text string, source string").repartition(4)
    target = {r.source: r.target for r in mix.mix(df, block=64).collect()}
    rows = [(r.source, len(r.text.split())) for r in mix.mixed(df, block=64).collect()]
    total, so_far = sum(target.values()), Counter()
    for i, (source, words) in enumerate(rows):
        so_far[source] += words
        if i > 100:
            assert all(abs(so_far[s] / sum(so_far.values()) - target[s] / total) < 0.06 for s in "abc"), (i, so_far)


def test_schedule_is_even(spark):
    plan = spark.createDataFrame([(0, 500), (1, 300), (2, 1), (3, 0)], "no int, slots long")
    rows = mix.schedule(plan, 1).collect()
    assert Counter(r.no for r in rows) == {0: 500, 1: 300, 2: 1}
    assert all(sorted(r["rank"] for r in rows if r.no == s) == list(range(n)) for s, n in ((0, 500), (1, 300)))
    early = [r.no for r in rows if r.slot < 100]
    assert abs(early.count(0) - 62) <= 3 and abs(early.count(1) - 38) <= 3


def test_shards(spark):
    df, texts = awkward(spark)
    rows = shard.shard(df).collect()
    assert len(rows) == len(texts)
    raw = [(t or "").encode() for _, t in texts]
    assert Counter((r["size"], r.text_crc32) for r in rows) == Counter((len(x) + 8, zlib.crc32(x)) for x in raw)
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
        assert r.grown_shard in (r.shard, 24) and 0 <= r.shard < 24
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())
    assert len({(r.doc_id, r.shard) for r in rows}) == len({r.doc_id for r in rows})
    assert shard.shard(empty(spark)).count() == 0


def test_shards_are_even_and_grow_only_into_new_ones(spark):
    many = spark.range(40_000).selectExpr("id as doc_id", "'' as text")
    rows = shard.shard(many).collect()
    sizes = Counter(r.shard for r in rows)
    assert len(sizes) == 24 and max(sizes.values()) < 1.15 * min(sizes.values())
    moved = sum(r.grown_shard != r.shard for r in rows)
    assert abs(moved - 40_000 / 25) < 200
    key = many.selectExpr("cast(doc_id as string) as k")
    five = key.select("k", shard.shard_of(key["k"], shard.tree(28)).alias("a"), shard.shard_of(key["k"], shard.tree(29)).alias("b"))
    assert five.where("a <> b and b <> 28").count() == 0


def test_rule_counts(spark):
    df, texts = awkward(spark)
    more = df.unionByName(df.limit(0)).unionByName(spark.createDataFrame(
        [(5000, "a b\n\na b\na b \n# $x", "en", "b", 1, 0.0, 1, "x", 1)], df.schema))
    texts = [*texts, (5000, "a b\n\na b\na b \n# $x")]
    want = Counter()
    for d, t in texts:
        words = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        lines = [x for x in (t or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        seen = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
        inside = {i + k for i in range(len(words) - 7) if seen[tuple(words[i : i + 8])] > 1 for k in range(8)}
        failed = len(words) < 20 or 100 * len(inside) > 30 * len(words)
        want[d, len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in t or ""), len(lines) - len(set(lines)), len(inside), failed] += 1
    rows = rules.verdicts(more).collect()
    names = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert Counter(tuple(r[n] for n in names) for r in rows) == want
    assert not any(r.kept and r.base_failed for r in rows)
    assert rules.verdicts(empty(spark)).count() == 0


def test_outliers_are_rejected_in_their_group(spark):
    plain = [(i, " ".join(f"w{(i * 7 + k * 3) % 97}" for k in range(100 + i % 40)), "en", "s") for i in range(300)]
    odd = [(9000 + i, " ".join(f"### w{k}{i} $$$" for k in range(60)), "en", "s") for i in range(6)]
    df = spark.createDataFrame(plain + odd, "doc_id long, text string, lang string, source string")
    rows = {r.doc_id: r for r in rules.verdicts(df).collect()}
    good = [rows[d] for d, *_ in plain if not rows[d].base_failed]
    assert sum(r.kept for r in good) >= 0.97 * len(good)
    assert not any(rows[d].kept for d, *_ in odd)
