"""Mixing sources to target weights: a low-discrepancy schedule of equal-token blocks, in DataFrame functions alone.

Each slot of the schedule is a golden-ratio point; the cumulative weights of the sources turn it into a source, and the
slots of a source are ranked. Slot r of a source takes its block r, where the documents of the source stand in shuffled
order and are cut into blocks of equal tokens; after the last block it starts again. Slots are the order of the mix, so
every stretch of it holds the sources near their weights.
"""

from __future__ import annotations

from decimal import Decimal, getcontext

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import bounded, space_words, stored

getcontext().prec = 60
GOLDEN = (Decimal(5).sqrt() - 1) / 2
CHUNK = 1 << 16  # slots ranked together
CELLS = 4096  # cells of the unit interval, to find a point's source by equality
BUCKETS = 4096  # parts of a source's shuffled order, so that no task orders a whole source
SOURCES = 100_000  # sources each executor may hold


def size_of(text: Column) -> Column:
    return F.size(space_words(text)).cast("long")


def targets(sources: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, cap: int = 2) -> DataFrame:
    """(source, no, source_size, target) from (source, source_size). Weights repeat over the sources by code point, null
    last. A target stops at ``cap`` times its source; the excess goes to the others by weight. That is one water level:
    the sources that stop first are those with the least room per weight."""
    ordered = Window.orderBy(F.col("source").asc_nulls_last())
    numbered = sources.withColumn("no", F.row_number().over(ordered) - 1).withColumn(
        "weight", F.element_at(F.array(*map(F.lit, weights)), F.pmod("no", F.lit(len(weights))).cast("int") + 1).cast("double"))
    room = (F.col("source_size") * cap).cast("double")
    filling = Window.orderBy(F.col("room") / F.col("weight"), "no")
    before = filling.rowsBetween(Window.unboundedPreceding, -1)
    after = filling.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy()
    levels = numbered.withColumn("room", room).withColumn(
        "level", (F.sum("source_size").over(everything) * F.lit(share) - F.coalesce(F.sum("room").over(before), F.lit(0.0)))
        / F.sum("weight").over(after)).withColumn(
        "open", F.when(F.col("level") * F.col("weight") <= F.col("room"), F.col("level")))
    level = F.first("open", ignorenulls=True).over(
        filling.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return levels.withColumn("level", level).select(
        "source", "no", "source_size",
        F.coalesce(F.least(F.col("level") * F.col("weight"), F.col("room")), F.col("room")).alias("target"))


def schedule(plan: DataFrame, block: int) -> DataFrame:
    """(no, rank, slot) for every slot of the mix; plan: (no, slots), the number of slots each source needs."""
    spark = plan.sparkSession
    total = plan.agg(F.coalesce(F.sum("slots"), F.lit(0)).alias("n")).first()["n"]
    every = Window.orderBy("no")
    shares = plan.where("slots > 0").withColumn(
        "high", F.sum("slots").over(every.rowsBetween(Window.unboundedPreceding, 0)) / F.lit(max(total, 1)).cast("double")).withColumn(
        "low", F.col("high") - F.col("slots") / F.lit(max(total, 1)).cast("double"))
    cells = shares.select("no", "low", "high", F.explode(F.sequence(
        F.floor(F.greatest(F.col("low") - 1e-9, F.lit(0.0)) * CELLS), F.floor((F.col("high") + 1e-9) * CELLS))).alias("cell"))
    # the point in two halves, so that its digits hold for any number of slots
    large = float(GOLDEN * (1 << 20) % 1)
    slot = F.col("id")
    point = F.pmod(F.floor(slot / (1 << 20)) * F.lit(large) + F.pmod(slot, F.lit(1 << 20)) * F.lit(float(GOLDEN)) + 0.5, F.lit(1.0))
    points = spark.range(total).select(slot.alias("slot"), point.alias("x")).withColumn("cell", F.floor(F.col("x") * CELLS))
    drawn = points.join(F.broadcast(cells) if bounded(plan, SOURCES) else cells, "cell").where(
        (F.col("x") >= F.col("low")) & (F.col("x") < F.col("high"))).select(
        "no", "slot", F.floor(F.col("slot") / CHUNK).alias("chunk"))
    counts = drawn.groupBy("no", "chunk").agg(F.count(F.lit(1)).alias("n"))
    counts = stored(counts, "chunks")
    sums = counts.withColumn("before", F.sum("n").over(Window.partitionBy("no").orderBy("chunk")) - F.col("n")).drop("n")
    ranked = drawn.withColumn("k", F.row_number().over(Window.partitionBy("no", "chunk").orderBy("slot"))).join(
        sums, ["no", "chunk"]).select("no", (F.col("before") + F.col("k") - 1).alias("rank"), "slot")
    used = ranked.join(F.broadcast(plan) if bounded(plan, SOURCES) else plan, "no").where("rank < slots").select("no", "rank", "slot")
    # what rounding left a source short of follows after the last slot
    short = plan.join(counts.groupBy("no").agg(F.sum("n").alias("got")), "no", "left").withColumn(
        "got", F.coalesce("got", F.lit(0))).where("got < slots").select(
        "no", F.explode(F.sequence(F.col("got"), F.col("slots") - 1)).alias("rank")).select(
        "no", "rank", (F.col("rank") + total).alias("slot"))
    return used.union(short)


def mix(docs: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, cap: int = 2,
        block: int = 1024, row: str | None = None) -> DataFrame:
    """Per row of docs: doc_id, size (words), source, source_size, target (its source's words), taken (words the mix
    takes, at most ``cap`` times size), slots (for each round that takes words of it its first place in the schedule).

    Null and empty texts have size 0, are taken 0 times and have no slots. A null source is a source, the last. Repeated
    rows are rows of their own; the shuffled order goes by a hash of id and text, ties by id and size. An empty table, or
    one without any word, takes nothing. Only doc_id, text and source are looked at, and ``row``, a column that comes back
    with each row."""
    carried = [row] if row else []
    mark = F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit("|"), F.coalesce("text", F.lit(""))))
    rows = stored(docs.select(*[F.col(f"`{c}`").alias("row") for c in carried], "doc_id", "source",
                              size_of(F.col("text")).alias("size"), mark.alias("mark")), "sizes")
    carried = ["row"] if row else []
    plan = stored(targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, cap).withColumn(
        "words", F.floor("target")).withColumn("blocks", F.ceil(F.col("source_size") / block)).withColumn(
        "slots", F.when(F.col("source_size") > 0, F.floor(F.col("words") / F.col("source_size")) * F.col("blocks")
                        + F.ceil((F.col("words") % F.col("source_size")) / block)).otherwise(0).cast("long")), "plan")
    small = bounded(plan, SOURCES)
    told = F.broadcast(plan) if small else plan
    slots = schedule(plan.select("no", "slots"), block)

    # what each slot takes: the whole block, the short last one of a round, or what the target has left
    at = F.pmod("rank", "blocks")
    before = F.floor(F.col("rank") / F.col("blocks")) * F.col("source_size") + at * block
    takes = slots.join(told.drop("slots"), "no").select(
        "no", at.alias("block"), F.struct(F.floor(F.col("rank") / F.col("blocks")).alias("round"), "slot", F.least(F.lit(block).cast("long"), F.col("source_size") - at * block,
                                                          F.col("words") - before).alias("take")).alias("take"))
    takes = takes.groupBy("no", "block").agg(F.collect_list("take").alias("takes"))  # one for each round, cap at most

    # each document's place in the shuffled order of its source: first its part, then its place in the part
    known = rows.join(told.select(F.col("source").alias("_source"), "no", "source_size", "target"), rows["source"].eqNullSafe(F.col("_source"))).select(
        *carried, "doc_id", "source", "size", "mark", "no", "source_size", "target",
        F.conv(F.substring("mark", 1, 3), 16, 10).cast("int").alias("part"))
    wordy = known.where("size > 0")  # the others take no place, however many they are
    parts = wordy.groupBy("no", "part").agg(F.sum("size").alias("n")).withColumn(
        "part_start", F.sum("n").over(Window.partitionBy("no").orderBy("part")) - F.col("n")).drop("n")
    order = Window.partitionBy("no", "part").orderBy("mark", "doc_id", "size")
    placed = wordy.withColumn("k", F.row_number().over(order)).withColumn(
        "inner", F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")).join(
        parts, ["no", "part"]).withColumn("start", F.col("part_start") + F.col("inner"))
    end = F.col("start") + F.col("size")
    pieces = placed.withColumn("block", F.explode(F.sequence(F.floor(F.col("start") / block), F.floor((end - 1) / block))))
    low = F.greatest(F.col("start"), F.col("block") * block)
    high = F.least(end, (F.col("block") + 1) * block)
    inside = F.filter(F.transform("takes", lambda t: F.struct(
        (F.least(high, F.col("block") * block + t["take"]) - low).alias("words"), t["round"].alias("round"), t["slot"].alias("slot"))), lambda t: t["words"] > 0)
    none = F.array().cast("array<bigint>")
    turns = F.col("turns")  # by round; of each its first slot
    firsts = F.filter(turns, lambda t, i: (i == 0) | (F.get(turns, i - 1)["round"] != t["round"]))
    outs = ["doc_id", "size", "source", "source_size", "target"]
    taken = pieces.join(takes, ["no", "block"], "left").withColumn("hit", inside).withColumns({
        "words": F.aggregate(F.coalesce(F.col("hit")["words"], none), F.lit(0).cast("long"), lambda total, n: total + n),
        "at": F.coalesce(F.transform("hit", lambda t: F.struct(t["round"].alias("round"), t["slot"].alias("slot"))),
                         F.array().cast("array<struct<round:bigint,slot:bigint>>"))}).groupBy("no", "part", "k").agg(
        *[F.first(c).alias(c) for c in [*carried, *outs]], F.sum("words").alias("taken"),
        F.sort_array(F.flatten(F.collect_list("at"))).alias("turns")).withColumn("slots", firsts["slot"]).drop("no", "part", "k", "turns")
    wordless = known.where("size = 0").select(*carried, *outs, F.lit(0).cast("long").alias("taken"), none.alias("slots"))
    return taken.unionByName(wordless).select(*([F.col("row").alias(row)] if row else []), *outs, "taken", "slots")


def mixed(docs: DataFrame, **settings) -> DataFrame:
    """The documents of the mix in the order of the schedule, all columns kept: each row stands as often as its own taken
    words round to (0 to ``cap`` times), its copies at its slots; one without words stands once, at the end. Rows are told
    apart by place, not by id, so repeated and missing ids change nothing."""
    number = "_row"
    while any(c.lower().startswith(number) for c in docs.columns):
        number += "_"
    slot = f"{number}slot"
    rows = stored(docs.withColumn(number, F.monotonically_increasing_id()), "rows")
    taken = mix(rows, **settings, row=number).select(F.col(number).alias("m_row"), F.col("size").alias("m_size"), F.col("taken").alias("m_taken"), F.col("slots").alias("m_slots"))
    times = F.when(F.col("m.m_size") > 0, F.floor(F.col("m.m_taken") / F.col("m.m_size") + 0.5)).otherwise(1).cast("int")
    copies = F.transform(F.array_repeat(F.lit(0), times), lambda _, i: F.coalesce(F.get("m.m_slots", i), F.get("m.m_slots", F.lit(0))))
    return rows.alias("d").join(taken.alias("m"), F.col(f"d.{number}") == F.col("m.m_row")).select(
        "d.*", F.explode(copies).alias(slot)).orderBy(F.asc_nulls_last(slot), number).select(*[F.col(f"`{c}`") for c in docs.columns])
