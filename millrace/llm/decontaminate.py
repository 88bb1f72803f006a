"""Benchmark decontamination: a prefix-filtered set join, in DataFrame functions alone.

A window is ``size`` consecutive words of a benchmark item. Its set is its shingles of up to five words. A document
holds the window only if it holds all of its shingles, so one shingle per window, the rarest over all documents, is a
sufficient prefix. Documents are joined with these prefixes; a candidate must leave room for the window on both sides
(positional and length bound) and is then compared word by word.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import bounded, fold_ascii, stored

BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
SHINGLE = 5
SMALL = 2_000_000  # rows of (long, int) that each executor may hold; beyond it both sides are shuffled


def item_words(text: Column) -> Column:
    """Lower-case runs of digits, letters and characters beyond ASCII; null has none."""
    return F.array_remove(F.split(fold_ascii(F.coalesce(text, F.lit(""))), BREAK), "")


def _element(words: Column, i: Column, n: int) -> Column:
    return F.xxhash64(*[F.get(words, i + k) for k in range(n)], F.lit(n))


def _elements(words: Column, n: int) -> Column:
    places = F.when(F.size(words) >= n, F.sequence(F.lit(0), F.size(words) - n)).otherwise(F.array().cast("array<int>"))
    return F.transform(places, lambda i: _element(words, i, n))


def _meet(large: DataFrame, small: DataFrame, on: str) -> DataFrame:
    """Inner join; the stored table ``small`` goes to every executor while it is small, else both are shuffled."""
    return large.join(F.broadcast(small) if bounded(small, SMALL) else small, on)


def text_key(text: Column) -> Column:
    """What stands for a text beside the id: 128 bits of hashes, as two long."""
    return F.struct(F.xxhash64(text).alias("a"), F.xxhash64(F.lit(1), text).alias("b"))


def _same(left: DataFrame, right: DataFrame) -> Column:
    """Rows of one id (or both without) and one text."""
    return left["doc_id"].eqNullSafe(right["_id"]) & (left["text_key"] == right["_key"])


def item_windows(items: DataFrame, size: int = 10) -> DataFrame:
    """(win, width, item_id): each distinct window of each item, as its words with blanks between. Items without an id
    or without words have none; an item shorter than ``size`` is one window."""
    words = items.where(F.col("item_id").isNotNull()).select("item_id", item_words(F.col("text")).alias("w"))
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - size + 1, F.lit(1)))
    return words.where(F.size("w") > 0).select("item_id", "w", F.explode(starts).alias("i")).select(
        F.array_join(F.slice("w", F.col("i"), F.lit(size)), " ").alias("win"),
        F.least(F.size("w"), F.lit(size)).alias("width"), "item_id").distinct()


def occurrences(docs: DataFrame, windows: DataFrame, size: int = 10) -> DataFrame:
    """(doc_id, text_key, start, width, win): every place where a window occurs in a text of this id. Rows are told
    apart by id and ``text_key``, two hashes of the text, so rows that share an id or have none keep their own places."""
    texts = windows.select("win", "width").distinct()
    lengths = sorted(r.n for r in texts.select(F.least("width", F.lit(SHINGLE)).alias("n")).distinct().collect())
    if not lengths:
        return docs.select("doc_id", text_key(F.col("text")).alias("text_key"), F.lit(0).alias("start"),
                           F.lit(0).alias("width"), F.lit("").alias("win")).where("false")
    split = texts.withColumn("w", F.split("win", " "))
    parts = [split.where(F.least("width", F.lit(SHINGLE)) == n).select(
        "win", "width", F.posexplode(_elements(F.col("w"), n)).alias("offset", "h")) for n in lengths]
    elements = parts[0]
    for part in parts[1:]:
        elements = elements.union(part)
    elements = stored(elements, "elements")
    wanted = stored(elements.select("h").distinct(), "wanted")

    words = docs.select("doc_id", text_key(F.col("text")).alias("text_key"), item_words(F.col("text")).alias("w"))
    found = []
    for n in lengths:
        each = words.select("doc_id", "text_key", "w", F.posexplode(_elements(F.col("w"), n)).alias("pos", "h"))
        first = F.greatest(F.col("pos") - (size - n), F.lit(0))
        found.append(_meet(each, wanted, "h").select(
            "doc_id", "text_key", "h", "pos", F.size("w").alias("n_words"), first.alias("first"),
            F.slice("w", first + 1, F.lit(2 * size - n)).alias("around")))
    matches = found[0]
    for more in found[1:]:
        matches = matches.union(more)
    matches = stored(matches, "matches")

    # rarity over all documents; a window with an absent shingle occurs nowhere
    rarity = matches.groupBy("h").agg(F.count(F.lit(1)).alias("times"))
    known = elements.join(rarity, "h", "left")
    order = Window.partitionBy("win").orderBy(F.col("times").asc_nulls_first(), "h", "offset")
    prefix = known.withColumn("k", F.row_number().over(order)).where("k = 1 and times is not null")
    prefix = stored(prefix.select("h", "win", "width", "offset"), "prefix")

    start = F.col("pos") - F.col("offset")
    return _meet(matches, prefix, "h").where(
        (start >= 0) & (start + F.col("width") <= F.col("n_words"))).where(
        F.array_join(F.slice("around", start - F.col("first") + 1, F.col("width")), " ") == F.col("win")).select(
        "doc_id", "text_key", start.alias("start"), "width", "win")


def contamination(docs: DataFrame, items: DataFrame, size: int = 10) -> DataFrame:
    """Per row of docs: doc_id, n_words, n_hit (words inside an occurring window), n_items, items_sha256, contaminated.

    Null and empty texts have no words and no hits. Each row is judged by its own text, whoever shares its id. Items
    without an id are not looked for. No item, or no document, gives no hits or an empty table. Other columns are not
    looked at."""
    windows = stored(item_windows(items, size), "windows")
    hits = stored(occurrences(docs, windows, size), "hits")
    row = ["doc_id", "text_key"]
    by_place = Window.partitionBy(*row).orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    covered = hits.select(*row, "start", (F.col("start") + F.col("width")).alias("end")).distinct().withColumn(
        "before", F.coalesce(F.max("end").over(by_place), F.lit(0))).groupBy(*row).agg(
        F.sum(F.greatest(F.lit(0), F.col("end") - F.greatest("start", "before"))).alias("n_hit"))
    named = hits.select(*row, "win").distinct().join(windows.select("win", "item_id"), "win").groupBy(*row).agg(
        F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("items")).select(
        F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"), "items")
    found = covered.join(named, _same(covered, named)).select("_id", "_key", "n_hit", "items")
    every = docs.select("doc_id", F.size(item_words(F.col("text"))).cast("long").alias("n_words"),
                        text_key(F.col("text")).alias("text_key"))
    n_hit = F.coalesce(F.col("n_hit"), F.lit(0)).cast("long")
    return every.join(found, _same(every, found), "left").select(
        "doc_id", "n_words", n_hit.alias("n_hit"),
        F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
        F.sha2(F.coalesce(F.array_join("items", ","), F.lit("")), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"))


def clean(docs: DataFrame, items: DataFrame, size: int = 10) -> DataFrame:
    """The documents without any benchmark window, with all their columns. Each row is judged by its own text."""
    hits = occurrences(docs, stored(item_windows(items, size), "windows"), size).select(
        F.col("doc_id").alias("_id"), F.col("text_key").alias("_key")).distinct()
    own = text_key(docs["text"])
    return docs.join(hits, docs["doc_id"].eqNullSafe(hits["_id"]) & (own == hits["_key"]), "left_anti")
