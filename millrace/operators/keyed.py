"""Keyed documents: index, update, upsert and delete as joins that rewrite a table,
and row-driven INSERT, UPDATE and DELETE with their affected-row counts.

Changes are reduced per key with partially aggregated ``max_by`` before any join
with the state, so a key that holds most changes never gathers in one task.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.strings import create_uuid
from millrace.operators.lookup import first_per_key
from millrace.operators.ordered import carry_last

# Change kinds, bulk action names and item results
INDEX, UPDATE, UPSERT, DELETE = "index", "update", "upsert", "delete"
KINDS = [INDEX, UPDATE, UPSERT, DELETE]
INSERT = "insert"
CREATED, OK, NOT_FOUND, BAD = 201, 200, 404, 400


# How a document without an id gets one, by the type of the id column
NEW_IDS = {"string": create_uuid, "bigint": lambda: F.xxhash64(F.uuid())}


def _order(order_by: Sequence[str]) -> Column:
    return F.struct(*order_by) if len(order_by) > 1 else F.col(order_by[0])


def _merged(changes: DataFrame, key: str, columns: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """Per key, the last non-null value of every column."""
    return changes.groupBy(key).agg(*[
        F.max_by(c, F.when(F.col(c).isNotNull(), _order(order_by))).alias(c) for c in columns])


def _value_columns(state: DataFrame, key: str) -> list[str]:
    return [c for c in state.columns if c != key]


def allocate_ids(rows: DataFrame, key: str, first: int, order_by: Sequence[str], parts: int = 1024) -> DataFrame:
    """Give every row an id of its own, ``first``, ``first + 1`` … without a gap. Rows are dealt to parts by a hash of what
    they hold, numbered in them and set off by the counts of the parts before, so no task sees all rows, and a task that
    runs again gives the same ids. Rows alike in every column are interchangeable."""
    others = [c for c in rows.columns if c != key]
    mark = F.xxhash64(*[F.col(f"`{c}`").cast("string") for c in others])
    dealt = rows.withColumns({"__mark": mark, "__part": F.pmod(mark, F.lit(parts))})
    counts = dealt.groupBy("__part").agg(F.count(F.lit(1)).alias("__n"))  # one row per part
    before = counts.withColumn("__before", F.sum("__n").over(Window.orderBy("__part")) - F.col("__n")).drop("__n")
    nth = F.row_number().over(Window.partitionBy("__part").orderBy(*order_by, "__mark"))
    return dealt.withColumn("__nth", nth).join(before, "__part").withColumn(
        key, (F.lit(first - 1) + F.col("__before") + F.col("__nth")).cast("bigint")).select(*rows.columns)


def apply_index(state: DataFrame, changes: DataFrame, key: str, order_by: Sequence[str]) -> DataFrame:
    """Write whole documents: the latest per id replaces what was there, a row
    without an id gets a new one. New numbers follow the greatest that is known."""
    kind = dict(state.dtypes)[key]
    if kind not in NEW_IDS:
        raise ValueError(f"ids are text or bigint, not {kind}")
    documents = changes.select(*dict.fromkeys([*state.columns, *order_by]))
    latest = first_per_key(documents.filter(F.col(key).isNotNull()), [key], [F.desc(c) for c in order_by]).select(*state.columns)
    fresh = documents.filter(F.col(key).isNull())
    if kind == "bigint":
        known = state.select(key).unionAll(documents.select(key)).agg(F.max(key)).first()[0]
        fresh = allocate_ids(fresh, key, max(known or 0, 0) + 1, order_by)
    else:
        fresh = fresh.withColumn(key, NEW_IDS[kind]())
    fresh = fresh.select(*state.columns)
    untouched = state.join(latest.select(key), key, "left_anti").select(*state.columns)
    return untouched.unionByName(latest).unionByName(fresh)


def apply_update(state: DataFrame, changes: DataFrame, key: str, order_by: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Merge given (non-null) fields into existing documents. Returns the new
    state and the changes whose id does not exist."""
    columns = [c for c in _value_columns(state, key) if c in changes.columns]
    news = _merged(changes, key, columns, order_by)
    joined = state.alias("s").join(news.alias("n"), key, "left")
    merged = [F.coalesce(F.col(f"n.{c}"), F.col(f"s.{c}")).alias(c) if c in columns else F.col(f"s.{c}")
              for c in state.columns if c != key]
    absent = changes.join(state.select(key), key, "left_anti").select(*changes.columns) \
        .withColumn("errorMessage", F.lit("document_missing"))
    return joined.select(F.col(key), *merged).select(*state.columns), absent


def apply_upsert(state: DataFrame, changes: DataFrame, key: str, order_by: Sequence[str]) -> DataFrame:
    """Merge given fields into documents, creating those that do not exist."""
    columns = [c for c in _value_columns(state, key) if c in changes.columns]
    news = _merged(changes, key, columns, order_by)
    joined = state.alias("s").join(news.alias("n"), key, "full")
    merged = [F.coalesce(F.col(f"n.{c}"), F.col(f"s.{c}")).alias(c) if c in columns else F.col(f"s.{c}")
              for c in state.columns if c != key]
    return joined.select(F.col(key), *merged).select(*state.columns)


def apply_delete(state: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    return state.join(ids.select(key).distinct(), key, "left_anti").select(*state.columns)


def change_results(state: DataFrame, changes: DataFrame, key: str, op: str, order_by: Sequence[str]) -> DataFrame:
    """Each change with the item ``status`` and ``result`` an ordered application
    gives. Whether a document exists at that moment depends on the last earlier
    index, upsert or delete of its id, or on the state when there is none (its rows,
    or a flag ``__stored`` on them)."""
    kind = F.lower(F.col(op))
    presence = F.when(F.col(key).isNotNull() & kind.isin(INDEX, UPSERT, DELETE), kind)
    carried = carry_last(changes, [key], order_by, presence, "__before")
    stored = F.lit(True) if "__stored" not in state.columns else F.col("__stored")
    marked = carried.join(state.select(key, stored.alias("__stored")), key, "left")
    exists = F.when(F.col("__before").isNull(), F.coalesce("__stored", F.lit(False))).otherwise(F.col("__before") != DELETE)
    unknown = kind.isNull() | ~kind.isin(KINDS)
    no_id = F.col(key).isNull() & (kind != INDEX)
    missing = kind.isin(UPDATE, DELETE) & ~exists
    status = F.when(unknown | no_id, BAD).when(missing, NOT_FOUND).when(kind.isin(INDEX, UPSERT) & ~exists, CREATED).otherwise(OK)
    result = F.when(unknown, "unknown operation").when(no_id, "missing id") \
        .when(missing & (kind == UPDATE), "document_missing").when(missing, "not_found") \
        .when(status == CREATED, "created").when(kind == DELETE, "deleted").otherwise("updated")
    return marked.select(*changes.columns, status.alias("status"), result.alias("result"))


def apply_changes(state: DataFrame, changes: DataFrame, key: str, op: str, order_by: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Apply mixed changes in order. Returns (new state, every change with its status)."""
    results = change_results(state, changes, key, op, order_by)
    return apply_results(state, results, key, op, order_by), results


def apply_results(state: DataFrame, results: DataFrame, key: str, op: str, order_by: Sequence[str]) -> DataFrame:
    """The new state, from changes whose status is known (see ``change_results``)."""
    return merge_folded(state, fold_changes(results, state.schema, key, op, order_by), key)


def fold_changes(results: DataFrame, schema: T.StructType, key: str, op: str, order_by: Sequence[str]) -> DataFrame:
    """What the changes of each id amount to, one row per id: the last change that
    decides whether the document exists, and for every column the value it ends
    with, when it was touched. Index and delete touch every column, update and
    upsert only the ones they give; failed changes touch nothing. One partially
    aggregated group-by, whatever the number of changes of an id."""
    done = results.filter(F.col("status") < 300)
    if schema[key].dataType.simpleString() in NEW_IDS:
        done = done.withColumn(key, F.coalesce(F.col(key), NEW_IDS[schema[key].dataType.simpleString()]()))
    kind, moment = F.lower(F.col(op)), _order(order_by)
    whole = kind.isin(INDEX, DELETE)
    ends = []
    for field in schema.fields:
        if field.name != key:
            given = F.col(field.name) if field.name in results.columns else F.lit(None).cast(field.dataType)
            value = F.struct(F.when(kind != DELETE, given).cast(field.dataType).alias("v"))
            ends.append(F.max_by(value, F.when(whole | given.isNotNull(), moment)).alias(f"__{field.name}"))
    return done.filter(F.col(key).isNotNull()).groupBy(key).agg(F.max_by(kind, F.when(kind != UPDATE, moment)).alias("__last"), *ends)


def fold_again(folded: DataFrame, key: str, order: str) -> DataFrame:
    """Several folded batches as one; a later batch's touch wins."""
    parts = [c for c in folded.columns if c not in (key, order)]
    return folded.groupBy(key).agg(*[F.max_by(c, F.when(F.col(c).isNotNull(), F.col(order))).alias(c) for c in parts])


def merge_folded(state: DataFrame, folded: DataFrame, key: str) -> DataFrame:
    """The state with folded changes applied: one full join on the id."""
    joined = state.alias("s").join(folded.alias("f"), key, "full")
    kept = joined.filter(F.col("__last").isNull() | (F.col("__last") != DELETE))
    return kept.select(*[F.col(key) if c == key else F.when(F.col(f"__{c}").isNotNull(), F.col(f"__{c}.v")).otherwise(F.col(f"s.{c}")).alias(c)
                         for c in state.columns])


def known_ids(state: DataFrame, folded: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Which of ``ids`` exist, in ``__stored``. The state and the folded changes are
    reduced to these ids first; while the ids are few Spark broadcasts them and the
    state is only scanned, one column wide."""
    asked = ids.select(key).filter(F.col(key).isNotNull()).distinct()
    old = state.select(key).join(asked, key, "left_semi").withColumn("__old", F.lit(True))
    new = folded.select(key, "__last").join(asked, key, "left_semi")
    stored = F.when(F.col("__last").isNull(), F.coalesce("__old", F.lit(False))).otherwise(F.col("__last") != DELETE)
    return asked.join(old, key, "left").join(new, key, "left").select(key, stored.alias("__stored"))


def validate_changes(df: DataFrame, op: str, key: str, index: str) -> DataFrame:
    """Add ``route`` (ok or failure) and ``errorMessage``: the kind must be known
    and everything but index needs an id. A blank index name is refused at once."""
    if not index.strip():
        raise ValueError("the index name is blank")
    kind = F.lower(F.col(op))
    no_id = F.coalesce(F.trim(F.col(key).cast("string")), F.lit("")) == ""
    reason = F.when(kind.isNull() | ~kind.isin(KINDS), "unknown operation") \
        .when((kind != INDEX) & no_id, "missing id")
    return df.withColumns({"route": F.when(reason.isNull(), "ok").otherwise("failure"), "errorMessage": reason})


def bulk_lines(df: DataFrame, index: str | Column, doc_type: str, op: str | Column, id_path: str | None = None) -> DataFrame:
    """Bulk request text per row: ``action`` line and ``document`` line (null for a
    delete). ``id_path`` may reach into a struct (``a.b``)."""
    index_column = F.lit(index) if isinstance(index, str) else index
    kind = F.lit(op.lower()) if isinstance(op, str) else F.lower(op)
    identity = F.col(id_path).cast("string") if id_path else F.lit(None).cast("string")
    identity = F.when(F.coalesce(identity, F.lit("")) != "", identity)
    target = F.struct(index_column.alias("_index"), F.lit(doc_type).alias("_type"), identity.alias("_id"))

    def named(name: str) -> Column:
        return F.to_json(F.struct(target.alias(name)))

    row = F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]))
    action = F.when(kind == INDEX, named(INDEX)).when(kind.isin(UPDATE, UPSERT), named(UPDATE)).when(kind == DELETE, named(DELETE))
    document = F.when(kind == INDEX, row).when(kind.isin(UPDATE, UPSERT), F.concat(
        F.lit('{"doc":'), row, F.lit(',"doc_as_upsert":'), (kind == UPSERT).cast("string"), F.lit("}")))
    return df.withColumns({"action": action, "document": document})


def bulk_text(lines: DataFrame) -> DataFrame:
    """One text value per row, ready for a line-wise text write."""
    return lines.filter("action IS NOT NULL").select(F.concat_ws("\n", "action", "document").alias("value"))


def split_status(df: DataFrame, status: str = "status") -> DataFrame:
    """Add ``route``: 2xx success, 5xx retry, anything else failure; and the reason,
    ``result`` first, else ``reason``."""
    group = F.floor(F.col(status) / 100)
    texts = [F.when(F.col(c) != "", F.col(c)) for c in ("result", "reason") if c in df.columns]
    reason = F.coalesce(*texts) if texts else F.lit(None).cast("string")
    route = F.when(group == 2, "success").when(group == 5, "retry").otherwise("failure")
    return df.withColumns({"route": route, "errorMessage": F.when(F.coalesce(group, F.lit(0)) != 2, reason)})


# Row-driven statements

On = dict[str, str]  # input column -> target column


def dml_counts(rows: DataFrame, target: DataFrame, on: On, kind: str, name: str = "result") -> DataFrame:
    """How many target rows each input row's statement hits. Target rows are
    counted per key first, so the join is 1:1."""
    if kind == INSERT:
        return rows.withColumn(name, F.lit(1).cast("bigint"))
    if kind not in (UPDATE, DELETE):
        raise ValueError(f"kind is {INSERT!r}, {UPDATE!r} or {DELETE!r}, not {kind!r}")
    counts = target.groupBy(*on.values()).agg(F.count(F.lit(1)).alias("__n"))
    match = reduce(lambda a, b: a & b, [F.col(f"i.`{a}`") == F.col(f"t.`{b}`") for a, b in on.items()])
    return rows.alias("i").join(counts.alias("t"), match, "left").select(
        *[F.col(f"i.`{c}`") for c in rows.columns], F.coalesce("__n", F.lit(0)).alias(name))


def dml_insert(rows: DataFrame, target: DataFrame) -> DataFrame:
    """The target after one INSERT per input row. Where the rows carry the count of their
    statement (see ``dml_counts``) it stays, null for rows that were there before."""
    kept = [*target.columns, *[c for c in ("result",) if c in rows.columns and c not in target.columns]]
    return target.unionByName(rows.select(*kept), allowMissingColumns=True)


def dml_update(rows: DataFrame, target: DataFrame, on: On, assign: dict[str, str], order_by: Sequence[str]) -> DataFrame:
    """The target after one UPDATE per input row; where several hit the same target
    row the last in ``order_by`` wins. ``assign`` maps target to input columns."""
    last = first_per_key(rows.select(*dict.fromkeys([*on, *assign.values(), *order_by])), list(on), [F.desc(c) for c in order_by])
    match = reduce(lambda a, b: a & b, [F.col(f"i.`{a}`") == F.col(f"t.`{b}`") for a, b in on.items()])
    hit = F.col(f"i.`{next(iter(on))}`").isNotNull()
    return target.alias("t").join(last.alias("i"), match, "left").select(*[
        F.when(hit, F.col(f"i.`{assign[c]}`")).otherwise(F.col(f"t.`{c}`")).alias(c) if c in assign else F.col(f"t.`{c}`")
        for c in target.columns])


def dml_delete(rows: DataFrame, target: DataFrame, on: On) -> DataFrame:
    """The target after one DELETE per input row."""
    keys = rows.select(*[F.col(f"`{a}`").alias(f"__{b}") for a, b in on.items()]).distinct()
    match = reduce(lambda a, b: a & b, [F.col(f"t.`{b}`") == F.col(f"k.`__{b}`") for b in on.values()])
    return target.alias("t").join(keys.alias("k"), match, "left_anti")
