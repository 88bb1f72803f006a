"""Graph rows: nodes and edges as tables, matching as joins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.project import as_column


def nodes_from(df: DataFrame, node_id: str | Column, labels: Sequence[str], props: dict[str, str | Column]) -> DataFrame:
    """One node per row: ``id``, ``labels``, ``props`` (text map; null properties are not set)."""
    pairs = [part for name, expr in props.items() for part in (F.lit(name), as_column(expr).cast("string"))]
    mapped = F.map_filter(F.create_map(*pairs), lambda _, v: v.isNotNull()) if pairs else \
        F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))
    return df.select(as_column(node_id).cast("string").alias("id"), F.array(*[F.lit(x) for x in labels]).cast("array<string>").alias("labels"),
                     mapped.alias("props"))


def edges_from(df: DataFrame, src: str | Column, dst: str | Column, kind: str, props: dict[str, str | Column] | None = None) -> DataFrame:
    """One edge per row: ``src``, ``dst``, ``type``, ``props``; rows without both ends make none."""
    pairs = [part for name, expr in (props or {}).items() for part in (F.lit(name), as_column(expr).cast("string"))]
    mapped = F.map_filter(F.create_map(*pairs), lambda _, v: v.isNotNull()) if pairs else \
        F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))
    return df.select(as_column(src).cast("string").alias("src"), as_column(dst).cast("string").alias("dst"),
                     F.lit(kind).alias("type"), mapped.alias("props")).filter("src IS NOT NULL AND dst IS NOT NULL")


def _one_per_id(new: DataFrame, order_by: Sequence[str]) -> DataFrame:
    """Repeated nodes folded into one: all their labels, and for each property its
    last value (by ``order_by``, else the largest). Reduced per (id, property) first,
    so a node that is named a million times never gathers."""
    labels = new.groupBy("id").agg(F.array_distinct(F.flatten(F.collect_set("labels"))).alias("labels"))
    values = new.select("id", *order_by, F.explode("props").alias("name", "value"))
    last = F.max_by("value", F.struct(*order_by)) if order_by else F.max("value")
    props = values.groupBy("id", "name").agg(last.alias("value")).groupBy("id").agg(
        F.map_from_entries(F.collect_list(F.struct("name", "value"))).alias("props"))
    empty = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))
    return labels.join(props, "id", "left").select("id", "labels", F.coalesce("props", empty).alias("props"))


def merge_nodes(nodes: DataFrame, new: DataFrame, unique: bool = False, order_by: Sequence[str] = ()) -> DataFrame:
    """Create nodes that do not exist, merge properties and labels into those that do.
    ``unique`` says that ``new`` names each node once; otherwise repeats are folded
    first, the last value by ``order_by`` winning."""
    if not unique:
        new = _one_per_id(new, order_by)
    joined = nodes.alias("o").join(new.alias("n"), "id", "full")
    labels = F.array_union(F.coalesce("o.labels", F.array().cast("array<string>")), F.coalesce("n.labels", F.array().cast("array<string>")))
    old = F.map_filter("o.props", lambda k, _: ~F.coalesce(F.map_contains_key("n.props", k), F.lit(False)))
    empty = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))
    props = F.map_concat(F.coalesce(old, empty), F.coalesce("n.props", empty))
    return joined.select("id", labels.alias("labels"), props.alias("props"))


def match_nodes(nodes: DataFrame, label: str | None = None) -> DataFrame:
    return nodes if label is None else nodes.filter(F.array_contains("labels", label))


def match_path(nodes: DataFrame, edges: DataFrame, start: str | None, steps: Sequence[tuple[str, str | None]]) -> DataFrame:
    """Paths (start) -[type]-> (label) -[type]-> (label) …; the columns of hop i are
    ``id{i}``, ``props{i}`` and ``type{i}``. Each hop is two equi-joins on ids."""
    path = match_nodes(nodes, start).select(F.col("id").alias("id0"), F.col("props").alias("props0"))
    for i, (kind, label) in enumerate(steps, 1):
        hop = edges.filter(F.col("type") == kind).select(F.col("src").alias(f"id{i - 1}"), F.col("dst").alias(f"id{i}"), F.col("type").alias(f"type{i}"))
        ends = match_nodes(nodes, label).select(F.col("id").alias(f"id{i}"), F.col("props").alias(f"props{i}"))
        path = path.join(hop, f"id{i - 1}").join(ends, f"id{i}")
    return path


def graph_counters(nodes: DataFrame, edges: DataFrame | None = None, rows_returned: int | None = None) -> DataFrame:
    """Counters of a write: nodes, labels, properties and relations created."""
    made = nodes.agg(F.count(F.lit(1)).alias("nodesCreated"), F.coalesce(F.sum(F.size("labels")), F.lit(0)).alias("labelsAdded"),
                     F.coalesce(F.sum(F.size("props")), F.lit(0)).alias("nodeProperties"))
    if edges is None:
        links = nodes.sparkSession.range(1).select(F.lit(0).cast("bigint").alias("relationsCreated"), F.lit(0).cast("bigint").alias("edgeProperties"))
    else:
        links = edges.agg(F.count(F.lit(1)).alias("relationsCreated"), F.coalesce(F.sum(F.size("props")), F.lit(0)).alias("edgeProperties"))
    both = made.select("*", links.select(F.struct("*")).scalar().alias("l"))
    counted = both.select("nodesCreated", F.col("l.relationsCreated").alias("relationsCreated"), "labelsAdded",
                          (F.col("nodeProperties") + F.col("l.edgeProperties")).alias("propertiesSet"))
    return counted if rows_returned is None else counted.withColumn("rowsReturned", F.lit(rows_returned).cast("bigint"))


def delete_nodes(nodes: DataFrame, edges: DataFrame, ids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Detach and delete: the nodes with these ids and every edge that touches one."""
    gone = ids.select(F.col(ids.columns[0]).cast("string").alias("id")).distinct()
    left_nodes = nodes.join(gone, "id", "left_anti").select(*nodes.columns)
    left_edges = edges.join(gone.withColumnRenamed("id", "src"), "src", "left_anti") \
        .join(gone.withColumnRenamed("id", "dst"), "dst", "left_anti").select(*edges.columns)
    return left_nodes, left_edges


def delete_counters(nodes: DataFrame, edges: DataFrame, left_nodes: DataFrame, left_edges: DataFrame) -> DataFrame:
    """How many nodes and relations a delete removed."""
    def size(df: DataFrame) -> Column:
        return df.select(F.count(F.lit(1))).scalar()

    return nodes.sparkSession.range(1).select((size(nodes) - size(left_nodes)).alias("nodesDeleted"),
                                              (size(edges) - size(left_edges)).alias("relationsDeleted"))
