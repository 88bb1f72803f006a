"""Enrichment by set joins: one join for all rows instead of one statement per row.

No broadcast hint is given anywhere: Catalyst broadcasts a side only while its
measured size is under ``spark.sql.autoBroadcastJoinThreshold`` and otherwise
uses a sort-merge join whose skewed keys adaptive execution splits.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence
from contextlib import contextmanager
from dataclasses import dataclass, replace
from functools import reduce
from itertools import accumulate
from threading import Lock

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.context import RunContext

MANY, ONE, HYBRID = "many", "one", "hybrid"
On = dict[str, str]  # input column -> lookup column


def _condition(on: On) -> Column:
    return reduce(lambda a, b: a & b, [F.col(f"i.`{a}`") == F.col(f"l.`{b}`") for a, b in on.items()])


def _joined(df: DataFrame, table: DataFrame, on: On, added: list[str], how: str = "left") -> DataFrame:
    clash = set(added) & set(df.columns)
    kept = [F.col(f"i.`{c}`") for c in df.columns if c not in clash]
    return df.alias("i").join(table.alias("l"), _condition(on), how).select(*kept, *[F.col(f"l.`{c}`") for c in added])


def lookup_many(df: DataFrame, table: DataFrame, on: On, columns: Sequence[str]) -> DataFrame:
    """All matches, one row per (input row, match); a row without a match stays,
    with nulls. This flat form is the one to use at scale: no list is built."""
    keys = list(on.values())
    return _joined(df, table.select(*dict.fromkeys([*keys, *columns])), on, list(columns))


def frequent_keys(rows: DataFrame, keys: Sequence[str], most: int) -> DataFrame:
    """(keys, n): keys that more than ``most`` rows have. Each task counts its own rows first, so a hot key sends one
    counter from each. There are no more such keys than rows / ``most``."""
    return rows.where(reduce(lambda a, b: a & b, [F.col(f"`{k}`").isNotNull() for k in keys])).groupBy(*[F.col(f"`{k}`") for k in keys]).agg(
        F.count(F.lit(1)).alias("__n")).where(F.col("__n") > most)


def lookup_salted(df: DataFrame, table: DataFrame, on: On, columns: Sequence[str], most: int = 100_000) -> DataFrame:
    """``lookup_many`` for inputs of which a few keys hold much. Keys with more than ``most`` input rows are found first;
    their rows are dealt to as many salts as it takes, their matches go to each, and rows without a key to salts of their
    own. No task of the join gets more than about ``most`` rows of one key, whatever Spark's own skew thresholds are."""
    left, right = list(on), list(on.values())
    hot = frequent_keys(df, left, most).select(*[F.col(f"`{k}`").alias(f"__k{i}") for i, k in enumerate(left)], F.ceil(F.col("__n") / most).cast("int").alias("__salts"))
    rows = df.withColumn("__pos", F.monotonically_increasing_id())  # before any shuffle
    is_hot = reduce(lambda a, b: a & b, [F.col(f"i.`{k}`") == F.col(f"h.__k{i}") for i, k in enumerate(left)])
    none = reduce(lambda a, b: a | b, [F.col(f"i.`{k}`").isNull() for k in left])
    spread = F.pmod(F.xxhash64("i.__pos"), F.coalesce("h.__salts", F.lit(1))).cast("int")
    salted = rows.alias("i").join(hot.alias("h"), is_hot, "left").select("i.*", F.when(none, F.pmod(F.xxhash64("i.__pos"), F.lit(1 << 30)).cast("int")).otherwise(spread).alias("__salt"))
    wanted = table.select(*dict.fromkeys([*right, *columns]))
    for_hot = reduce(lambda a, b: a & b, [F.col(f"t.`{k}`") == F.col(f"h.__k{i}") for i, k in enumerate(right)])
    copies = wanted.alias("t").join(hot.alias("h"), for_hot, "left").select(
        "t.*", F.explode(F.sequence(F.lit(0), F.coalesce("h.__salts", F.lit(1)) - 1)).alias("__salt"))
    found = _joined(salted, copies, {**on, "__salt": "__salt"}, list(columns))
    return found.drop("__pos", "__salt")


def lookup_nested(df: DataFrame, table: DataFrame, on: On, columns: Sequence[str], max_list: int = 10_000,
                  name: str = "result") -> DataFrame:
    """All matches as a list column. Lists are built on the lookup side, once per
    key, before a 1:1 join. A key with more than ``max_list`` matches gives several
    rows, numbered in ``part``, that together hold every match, so no list and no
    task ever grows with a hot key. Without a match: one row with an empty list."""
    keys = list(on.values())
    # numbered before any shuffle, so that a retried task numbers its rows the same way
    rows = table.select(*dict.fromkeys([*keys, *columns]), F.monotonically_increasing_id().alias("__pos"))
    counts = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    hot = counts.filter(F.col("__n") > max_list).select(*keys, F.ceil(F.col("__n") / max_list).alias("__parts"))
    spread = rows.join(hot, keys, "left").withColumn(
        "part", F.coalesce(F.pmod(F.xxhash64("__pos"), F.col("__parts")), F.lit(0)).cast("int"))
    # an exchange of its own: the join's partitioning by key alone would bring all parts of a key to one task
    lists = spread.repartition(*keys, "part").groupBy(*keys, "part").agg(F.collect_list(F.struct(*columns)).alias(name))
    joined = _joined(df, lists, on, [name, "part"])
    return joined.withColumns({name: F.coalesce(F.col(name), F.array()), "part": F.coalesce(F.col("part"), F.lit(0))})


def first_per_key(table: DataFrame, keys: Sequence[str], order_by: Sequence[Column]) -> DataFrame:
    """The first row of each key. Spark limits each key to one row inside every
    map task before the shuffle, so hot keys do not gather."""
    if not order_by:
        raise ValueError("'first' needs an order")
    window = Window.partitionBy(*keys).orderBy(*order_by)
    return table.withColumn("__rank", F.row_number().over(window)).filter("__rank = 1").drop("__rank")


def lookup_one(df: DataFrame, table: DataFrame, on: On, columns: Sequence[str], order_by: Sequence[Column]) -> DataFrame:
    """The first match in the given order, its columns added to the row."""
    keys = list(on.values())
    return _joined(df, first_per_key(table, keys, order_by), on, list(columns))


def lookup_hybrid(df: DataFrame, table: DataFrame, on: On, columns: Sequence[str], order_by: Sequence[Column],
                  name: str = "result") -> DataFrame:
    """As ``lookup_one``; rows without a match also carry an empty list in ``result``."""
    keys = list(on.values())
    found = first_per_key(table, keys, order_by).withColumn("__hit", F.lit(True))
    joined = _joined(df, found, on, [*columns, "__hit"])
    return joined.withColumn(name, F.when(F.col("__hit").isNull(), F.array().cast("array<string>"))).drop("__hit")


def lookup_const(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Add the columns of a statement without parameters to every row. The
    statement must give at most one row (Spark fails the job otherwise) and runs
    once, as a scalar subquery; no cross join takes place."""
    value = one_row.select(F.struct(*one_row.columns).alias("__c")).scalar()
    kept = [c for c in df.columns if c not in one_row.columns]
    return df.select(*kept, value.alias("__c")).select(*kept, *[F.col(f"__c.`{c}`").alias(c) for c in one_row.columns])


def lookup_const_list(df: DataFrame, statement: DataFrame, max_rows: int = 10_000, name: str = "result") -> DataFrame:
    """Add all rows of a statement without parameters, as the same list for every
    row. The list is one scalar subquery; a statement with more than ``max_rows``
    rows is refused, because then the answer belongs in a table of its own."""
    listed = statement.limit(max_rows + 1).agg(F.collect_list(F.struct(*statement.columns)).alias("rows"))
    checked = listed.select(F.when(F.size("rows") <= max_rows, F.col("rows")).otherwise(
        F.raise_error(F.lit(f"the statement has more than {max_rows} rows"))).alias("rows"))
    return df.withColumn(name, checked.scalar())


def lookup_groups(df: DataFrame, lists: Sequence[str], name: str = "result") -> DataFrame:
    """Several list columns as one list of lists, for statements with more than one result set."""
    as_text = [F.transform(F.col(c), lambda row: F.to_json(row)) for c in lists]
    return df.withColumn(name, F.array(*as_text)).drop(*lists)


# Quoted text and quoted names are passed over. A parameter starts after '(', ',', a blank or '='
QUOTED = r"'(?:[^'\\]|\\.|'')*'|\"(?:[^\"\\]|\\.)*\"|`[^`]*`"
PARAMETER = re.compile(QUOTED + r"|(?<=[(,\s=]):(\w+)", re.DOTALL)


def _outside_quotes(pattern: re.Pattern, change, sql: str) -> str:
    """Replace what group 1 of the pattern finds; matches without it are quoted text."""
    return pattern.sub(lambda m: m.group(0) if m.group(1) is None else change(m), sql)


def parameter_names(sql: str) -> list[str]:
    return [n for n in PARAMETER.findall(sql) if n]


def _bare_statement(sql: str) -> str:
    """The statement without quoted text and without anything in brackets."""
    text = re.sub(QUOTED, "''", sql, flags=re.DOTALL)
    while (shorter := PARENTHESISED.sub("", text)) != text:
        text = shorter
    return text


def bind_parameters(sql: str, columns: Sequence[str], context: RunContext = RunContext(), alias: str = "input") -> str:
    """Replace ``:name`` by the row's column, else by the run's attribute, else by null.
    A row value that is null falls back to the attribute as well. Attributes stay
    parameters (``:attribute_name``), see ``attribute_arguments``."""
    def bound(match: re.Match) -> str:
        name = match.group(1)
        options = [f"{alias}.`{name}`"] if name in columns else []
        if name in context.attributes:
            options.append(f":{ATTRIBUTE}{name}")
        if not options:
            return "NULL"
        return options[0] if len(options) == 1 else f"coalesce({', '.join(options)})"

    return _outside_quotes(PARAMETER, bound, sql)


ATTRIBUTE = "attribute_"


def attribute_arguments(context: RunContext) -> dict[str, str]:
    return {f"{ATTRIBUTE}{name}": value for name, value in context.attributes.items()}


@dataclass(frozen=True)
class Within:
    """A statement's condition that bounds ``column`` of ``view`` by parameters from below, from above or both."""

    view: str
    column: str
    low: str | None = None
    high: str | None = None
    bins: int = 256


def lookup_sql(df: DataFrame, sql: str, mode: str = MANY, order_by: Sequence[str] = (), views: dict[str, DataFrame] | None = None,
               context: RunContext = RunContext(), within: Within | None = None, allow_loop: bool = False) -> DataFrame:
    """Run a parameterised SELECT for all rows at once. The statement becomes a
    lateral subquery, which Catalyst turns into an ordinary join on the parameters.

    ``many`` gives one row per match. ``one`` gives the first match by ``order_by``
    (expressions over the statement's columns); it runs the statement once per
    distinct set of parameters. Rows without a match stay, with nulls.

    A statement that compares with parameters, but is equal to none, would be tried for every pair of rows. It is
    refused, unless ``within`` names the column that parameters bound: the column's values are cut into bins of about
    equal numbers, rows and parameters meet where they share a bin, and the statement itself decides. ``allow_loop``
    lets a statement over small tables pass as it is.
    """
    statement = sql.strip().rstrip(";")
    if mode not in (MANY, ONE):
        raise ValueError(f"mode is {MANY!r} or {ONE!r}, not {mode!r}")
    if re.search(r"\b(order\s+by|limit)\b", _bare_statement(statement), re.IGNORECASE):
        raise ValueError("a row order inside the statement has no effect here: pass order_by")
    if mode == MANY and within is None:
        return _unlooped(_lateral(df, statement, views or {}, context), allow_loop)
    if mode == ONE and not order_by:
        raise ValueError("mode 'one' needs order_by")
    keys = [n for n in dict.fromkeys(parameter_names(statement)) if n in df.columns]
    if not keys:
        raise ValueError("the statement reads no column of the rows: use lookup_const")
    if mode == MANY:  # by rows, not by sets of parameters: matches would have to be shuffled to meet their rows
        return _many_in_bins(df, statement, keys, views or {}, context, within)
    asked, renamed, fallback, within = _asked(df.select(*keys).distinct(), keys, statement, context, within)
    if within is not None:
        found = _in_bins(asked, renamed, views or {}, fallback, within)
    else:
        found = _unlooped(_lateral(asked, renamed, views or {}, fallback), allow_loop)
    found = first_per_key(found, asked.columns, _orders(order_by))
    match = reduce(lambda a, b: a & b, [F.col(f"i.`{k}`").eqNullSafe(F.col(f"l.`{p}`")) for k, p in zip(keys, asked.columns)])
    added = [c for c in found.columns if c not in asked.columns]
    kept = [F.col(f"i.`{c}`") for c in df.columns if c not in added]
    return df.alias("i").join(found.alias("l"), match, "left").select(*kept, *[F.col(f"l.`{c}`") for c in added])


def _asked(rows: DataFrame, keys: list[str], statement: str, context: RunContext, within: Within | None) -> tuple[DataFrame, str, RunContext, Within | None]:
    """The rows, the statement, its attributes and bounds with the rows' columns under names of their own: ``__p0`` …"""
    columns = rows.columns
    names = {k: f"__p{columns.index(k)}" for k in keys}
    renamed = _outside_quotes(PARAMETER, lambda m: f":{names[m.group(1)]}" if m.group(1) in names else m.group(0), statement)
    fallback = RunContext(attributes={**context.attributes, **{p: context.attributes[k] for k, p in names.items() if k in context.attributes}})
    bounds = within and replace(within, low=names.get(within.low, within.low), high=names.get(within.high, within.high))
    return rows.toDF(*[f"__p{i}" for i in range(len(columns))]), renamed, fallback, bounds


def _many_in_bins(df: DataFrame, statement: str, keys: list[str], views: dict[str, DataFrame], context: RunContext, within: Within) -> DataFrame:
    """Matches come straight out of the join in blocks. The rows left without any are those whose parameters find nothing,
    which a second pass asks once for each set of parameters, ending at the first match."""
    cuts = _cuts(views, within)
    rows, renamed, fallback, bounds = _asked(df, keys, statement, context, within)
    found = _in_bins(rows, renamed, views, fallback, bounds, cuts, _shares(rows, renamed, views, fallback, bounds, cuts))
    names = dict(zip(df.columns, rows.columns))
    added = [c for c in found.columns if c not in rows.columns]
    kept = [c for c in df.columns if c not in added]
    matches = found.select(*[F.col(f"`{names[c]}`").alias(c) for c in kept], *[F.col(f"`{c}`") for c in added])
    asked, renamed, fallback, bounds = _asked(df.select(*keys).distinct(), keys, statement, context, within)
    met = _in_bins(asked, renamed, views, fallback, bounds, cuts, exists=True).distinct()
    same = reduce(lambda a, b: a & b, [F.col(f"i.`{k}`").eqNullSafe(F.col(f"l.`{p}`")) for k, p in zip(keys, asked.columns)])
    alone = df.alias("i").join(met.alias("l"), same, "left_anti").select(
        *[F.col(f"`{c}`") for c in kept], *[F.lit(None).cast(found.schema[c].dataType).alias(c) for c in added])
    return matches.unionByName(alone)


def _unlooped(found: DataFrame, allowed: bool) -> DataFrame:
    plan = "" if allowed else found._jdf.queryExecution().sparkPlan().toString()
    if "NestedLoopJoin" in plan or "CartesianProduct" in plan:
        raise ValueError("the statement is equal to none of its parameters and would be tried for every pair of rows: "
                         "name the bounded column in within, or pass allow_loop")
    return found


def _number(value: Column) -> Column:
    """A number or a moment as a double; NaN, which is above all numbers, with the greatest."""
    plain = F.coalesce(value.try_cast("double"), F.unix_micros(value.try_cast("timestamp")).cast("double"))
    return F.when(F.isnan(plain), float("inf")).otherwise(plain)


def _as_number(table: DataFrame, column: str):
    moment = isinstance(table.schema[column].dataType, (T.DateType, T.TimestampType, T.TimestampNTZType))
    return (lambda c: F.unix_micros(c.cast("timestamp")).cast("double")) if moment else _number


@dataclass(frozen=True)
class Cuts:
    """Where the bounded column is cut into bins of about equal numbers, and its least and greatest value."""

    splits: list[float]
    least: float | None
    greatest: float | None

    def binned(self, rows: DataFrame, columns: dict[str, Column]) -> DataFrame:
        """With the bin of each value, by the new column's name."""
        ready = rows.withColumns({f"{name}_value": c for name, c in columns.items()})
        cut = Bucketizer(splitsArray=[self.splits] * len(columns), inputCols=[f"{n}_value" for n in columns], outputCols=list(columns), handleInvalid="keep")
        done = cut.transform(ready).drop(*[f"{n}_value" for n in columns])
        return done.withColumns({n: F.least(F.col(n), F.lit(len(self.splits) - 2.0)).cast("int") for n in columns})


def _cuts(views: dict[str, DataFrame], within: Within) -> Cuts:
    table = views[within.view]
    value = _as_number(table, within.column)(F.col(within.column))
    found = table.select(F.percentile_approx(value, [i / within.bins for i in range(1, within.bins)], 10_000).alias("c"),
                         F.min(value).alias("least"), F.max(value).alias("greatest")).first()
    inner = sorted({c for c in found["c"] or [] if c not in (float("inf"), float("-inf"))}) or [0.0]
    return Cuts([float("-inf"), *inner, float("inf")], found["least"], found["greatest"])


def _covered(asked: DataFrame, table: DataFrame, context: RunContext, within: Within, cuts: Cuts) -> DataFrame:
    """The sets of parameters with the first and the last bin between their bounds. Those beyond all values are left out."""
    as_number = _as_number(table, within.column)

    def bound(name: str | None, otherwise: float) -> Column:
        if name is None:
            return F.lit(otherwise)
        given = [F.col(name)] if name in asked.columns else []
        given += [F.lit(context.attributes[name])] if name in context.attributes else []
        return as_number(F.coalesce(*given)) if given else F.lit(None).cast("double")

    low, high = bound(within.low, float("-inf")), bound(within.high, float("inf"))
    inside = (low <= F.lit(cuts.greatest).cast("double")) & (high >= F.lit(cuts.least).cast("double"))
    return cuts.binned(asked.where(inside), {"__low": low, "__high": high}).where("__low <= __high")


BLOCK, BLOCKS, SETS = 256, 65_536, 100_000  # rows of the statement in a block, blocks in all, sets of parameters in a salt


def _shares(asked: DataFrame, statement: str, views: dict[str, DataFrame], context: RunContext, within: Within, cuts: Cuts) -> list[tuple[int, int]]:
    """To how many blocks the rows of each bin are dealt, and to how many salts the sets of parameters that go there. A
    block has ``BLOCK`` of the rows that the statement finds for the widest bounds of all, so there are few sets beside
    their matches. A statement with other parameters of the rows may find less for each of them: its bins stay whole."""
    bounds = {name: F.min if name == within.low else F.max for name in (within.low, within.high) if name in asked.columns}
    table, bins = views[within.view], len(cuts.splits) - 1
    blocks = [1] * bins
    if within.low != within.high and not {n for n in parameter_names(statement) if n in asked.columns} - set(bounds):
        widest = asked.agg(*[outermost(name).alias(name) for name, outermost in bounds.items()]).withColumn(
            "__bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
        value = _as_number(table, within.column)(F.col(within.column))
        cut_views = {**views, within.view: cuts.binned(table.where(value.isNotNull()), {"__bin": value})}
        found = _lateral(widest, _and_where(statement, "__bin = input.__bin"), cut_views, context, "INNER")
        found = found.toDF(*[f"c{i}" for i in range(len(found.columns))])  # the statement may select __bin as well
        counts = dict(found.groupBy(f"c{len(bounds)}").agg(F.count(F.lit(1))).collect())
        size = max(BLOCK, -(-sum(counts.values()) // BLOCKS))
        blocks = [max(1, -(-counts.get(i, 0) // size)) for i in range(bins)]
    ends = F.array(F.struct(F.col("__low").alias("at"), F.lit(1).alias("n")), F.struct((F.col("__high") + 1).alias("at"), F.lit(-1).alias("n")))
    steps = dict(_covered(asked, table, context, within, cuts).select(F.inline(ends)).groupBy("at").agg(F.sum("n")).collect())
    return [(b, max(1, -(-sets // SETS))) for b, sets in zip(blocks, accumulate(steps.get(i, 0) for i in range(bins)))]


def _dealt(covered: DataFrame, inner: DataFrame, alike: list[str], shares: list[tuple[int, int]]) -> tuple[DataFrame, DataFrame]:
    """The sets of parameters and the view's rows, both with the block and salt where they meet, numbered through all bins."""
    def of(values: list[int]) -> Column:
        return F.get(F.lit(values), F.col("__bin"))

    blocks, salts = of([b for b, _ in shares]), of([s for _, s in shares])
    first = of(list(accumulate((b * s for b, s in shares[:-1]), initial=0)))
    # numbered before any shuffle, so that a retried task numbers its rows the same way
    each = covered.withColumn("__pos", F.monotonically_increasing_id()).withColumn("__bin", F.explode(F.sequence("__low", "__high")))
    each = each.withColumn("__block", F.explode(F.sequence(F.lit(0), blocks - 1)))
    rows = each.withColumn("__bin", first + F.col("__block") * salts + F.pmod(F.xxhash64("__pos"), salts))
    block = F.pmod(F.xxhash64(*alike), blocks)
    copies = inner.withColumn("__salt", F.explode(F.sequence(F.lit(0), salts - 1)))
    met = copies.withColumn("__bin", first + block * salts + F.col("__salt"))
    return rows.drop("__pos", "__low", "__high", "__block"), met.drop("__salt")


def _in_bins(asked: DataFrame, statement: str, views: dict[str, DataFrame], context: RunContext, within: Within,
             cuts: Cuts | None = None, shares: list[tuple[int, int]] | None = None, exists: bool = False) -> DataFrame:
    """The statement's rows for every set of parameters that has any, or with ``exists`` the sets alone, once for each bin
    with a match. A set of parameters goes to the bins between its bounds; but for the first and the last, all values in
    them match, so there are no more of these rows than of matches.

    With ``shares`` matches come out block by block: the same few rows for one set of parameters after the other. Files of
    matches, which may be many times the tables, are small in this order. Only a merge join keeps it, so one is asked for."""
    table = views[within.view]
    cuts = cuts or _cuts(views, within)
    value = _as_number(table, within.column)(F.col(within.column))
    covered, inner = _covered(asked, table, context, within, cuts), cuts.binned(table.where(value.isNotNull()), {"__bin": value})
    if shares:
        rows, inner = _dealt(covered, inner, _named_in(statement, table), shares)
        # to all tasks, however few rows there are beside their matches
        rows, inner = rows.repartition(int(asked.sparkSession.conf.get("spark.sql.shuffle.partitions")), "__bin"), inner.hint("merge")
    else:
        rows = covered.withColumn("__bin", F.explode(F.sequence("__low", "__high"))).drop("__low", "__high")
    meeting = _and_where(statement, "__bin = input.__bin")
    cut_views = {**views, within.view: inner}
    if exists:
        return _where_exists(rows, meeting, cut_views, context).drop("__bin")
    alone = _lateral(asked.sparkSession.createDataFrame([], rows.schema), meeting, cut_views, context, "INNER")  # rows may be grouped, the statement not
    if "Aggregate" in alone._jdf.queryExecution().analyzed().toString():
        raise ValueError("a statement that aggregates can't be asked bin by bin")
    found = _lateral(rows, meeting, cut_views, context, "INNER")
    return found.select(*asked.columns, *[f"`{c}`" for c in dict.fromkeys(found.columns) if c not in asked.columns and c != "__bin"])


def _named_in(statement: str, table: DataFrame) -> list[str]:
    """The columns that the statement may read and a hash can take: rows that differ in none of them are alike to it."""
    words = set(re.findall(r"\w+", statement.lower()))
    able = [f.name for f in table.schema.fields if not re.search("map<|variant", f.dataType.simpleString())]
    named = [] if "*" in statement else [c for c in able if c.lower() in words]
    return [f"`{c}`" for c in named or able]


def _and_where(statement: str, condition: str) -> str:
    """The statement with one more condition in its outermost WHERE."""
    masked = re.sub(QUOTED, lambda m: "x" * len(m.group(0)), statement, flags=re.DOTALL)
    while (shorter := PARENTHESISED.sub(lambda m: "x" * len(m.group(0)), masked)) != masked:
        masked = shorter
    where = list(re.finditer(r"\bwhere\b", masked, re.IGNORECASE))
    if len(where) != 1 or re.search(r"\b(union|intersect|except)\b", masked, re.IGNORECASE):
        raise ValueError("the bounded statement must be one SELECT with a WHERE")
    end = re.search(r"\b(group\s+by|having|window|qualify)\b", masked[where[0].end():], re.IGNORECASE)
    stop = where[0].end() + end.start() if end else len(statement)
    return f"{statement[:where[0].end()]} {condition} AND ({statement[where[0].end():stop]}\n) {statement[stop:]}"


PARENTHESISED = re.compile(r"\([^()]*\)")


def _orders(order_by: Sequence[str]) -> list[Column]:
    """'price desc' and the like as sort columns."""
    out = []
    for text in order_by:
        found = re.fullmatch(r"(.+?)(?:\s+(asc|desc))?", text.strip(), re.IGNORECASE)
        column = F.expr(found.group(1))
        out.append(column.desc() if (found.group(2) or "").lower() == "desc" else column.asc())
    return out


def _lateral(df: DataFrame, statement: str, views: dict[str, DataFrame], context: RunContext, how: str = "LEFT") -> DataFrame:
    return _asking(df, "SELECT input.*, found.* FROM {rows} AS input " + how + " JOIN LATERAL ({statement}\n) AS found ON TRUE", statement, views, context)


def _where_exists(df: DataFrame, statement: str, views: dict[str, DataFrame], context: RunContext) -> DataFrame:
    """The rows for which the statement has any row: a semi join."""
    return _asking(df, "SELECT input.* FROM {rows} AS input WHERE EXISTS ({statement}\n)", statement, views, context)


def _asking(df: DataFrame, question: str, statement: str, views: dict[str, DataFrame], context: RunContext) -> DataFrame:
    bound = bind_parameters(statement, df.columns, context)
    given = {k: v for k, v in attribute_arguments(context).items() if f":{k}" in bound}
    rows = f"rows_{uuid.uuid4().hex}"
    with _named_views(df.sparkSession, {**views, rows: df}):  # the plan is resolved when sql() returns
        return df.sparkSession.sql(question.replace("{rows}", rows).replace("{statement}", bound, 1), args=given)


NAMES = Lock()  # view names belong to the whole session


@contextmanager
def _named_views(spark, views: dict[str, DataFrame]):
    """Give tables a name for the moment; a view that had the name has it again afterwards."""
    with NAMES:
        there = {v.name for v in spark.catalog.listTables() if v.isTemporary} & set(views)
        before = {name: spark.table(name) for name in there}
        for name, table in views.items():
            table.createOrReplaceTempView(name)
        try:
            yield
        finally:
            for name in views:
                if name in before:
                    before[name].createOrReplaceTempView(name)
                else:
                    spark.catalog.dropTempView(name)


def dict_lookup(df: DataFrame, dimension: DataFrame, on: On, columns: Sequence[str]) -> DataFrame:
    """Dictionary columns for each row; unknown codes give nulls."""
    return lookup_many(df, dimension, on, columns)


def dictionary_items(items: DataFrame, code: str, code_column: str = "dict_code") -> DataFrame:
    """The items of one dictionary or the fields of one category."""
    return items.filter(F.col(code_column) == code)


def _bare(name: str) -> str:
    return name.replace("_", "").lower()


def conform_names(df: DataFrame, fields: Sequence[str]) -> DataFrame:
    """Pick ``fields`` from columns whose names agree up to underscores and case."""
    found: dict[str, list[str]] = {}
    for column in df.columns:
        found.setdefault(_bare(column), []).append(column)
    picked = []
    for field in fields:
        sources = found.get(field.lower(), [])
        if len(sources) > 1:
            raise ValueError(f"field {field!r} matches several columns: {sources}")
        if sources:
            picked.append(F.col(f"`{sources[0]}`").alias(field))
    return df.select(*picked)


def column_of(df: DataFrame, column: str | int) -> DataFrame:
    """One column, by name or 1-based position, as a one-column DataFrame."""
    return df.select(df.columns[column - 1] if isinstance(column, int) else column)


def first_row(df: DataFrame, order_by: Sequence[Column]) -> DataFrame:
    """The first row of a result, taken as a distributed top-1."""
    return df.orderBy(*order_by).limit(1)
