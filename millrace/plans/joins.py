"""Lookups, dictionary joins, keyed changes and row-driven statements."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.context import RunContext
from millrace.operators import keyed, lookup
from millrace.plans.registry import CONTEXT, plan

ORDER_COLUMNS = ["o_orderkey", "o_totalprice", "o_orderstatus"]


def latest_order():
    return [F.desc("o_orderdate"), F.desc("o_orderkey")]


# Odd customers keep their key, even ones are shifted out of reach, so a part has no orders
SHIFTED = "SELECT c_custkey, c_name, CASE WHEN c_custkey % 4 = 0 THEN c_custkey + 100000000 ELSE c_custkey END AS ref FROM customer"


def shifted(t):
    return t.customer.select("c_custkey", "c_name", F.expr("if(c_custkey % 4 = 0, c_custkey + 100000000, c_custkey)").alias("ref"))


@plan("lookup_many", f"""
  WITH c AS ({SHIFTED}) SELECT c_custkey, c_name, ref, o_orderkey, o_totalprice, o_orderstatus FROM c LEFT JOIN orders ON ref = o_custkey""")
def lookup_many(t):
    return lookup.lookup_many(shifted(t), t.orders, {"ref": "o_custkey"}, ORDER_COLUMNS)


@plan("lookup_nested", f"""
  WITH c AS ({SHIFTED}) SELECT c_custkey, count(o_orderkey) AS n, CAST(coalesce(sum(o_orderkey), 0) AS BIGINT) AS keys FROM c LEFT JOIN orders ON ref = o_custkey GROUP BY 1""")
def lookup_nested(t):
    nested = lookup.lookup_nested(shifted(t), t.orders, {"ref": "o_custkey"}, ORDER_COLUMNS, max_list=4)
    keys = F.aggregate("result", F.lit(0).cast("bigint"), lambda acc, r: acc + r["o_orderkey"])
    return nested.groupBy("c_custkey").agg(F.sum(F.size("result")).alias("n"), F.sum(keys).alias("keys"))


LATEST_SQL = f"""WITH c AS ({SHIFTED}), o AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders)"""


@plan("lookup_one", f"""{LATEST_SQL}
  SELECT c_custkey, c_name, ref, o_orderkey, o_totalprice, o_orderstatus FROM c LEFT JOIN o ON ref = o_custkey AND rn = 1""")
def lookup_one(t):
    return lookup.lookup_one(shifted(t), t.orders, {"ref": "o_custkey"}, ORDER_COLUMNS, latest_order())


@plan("lookup_hybrid", f"""{LATEST_SQL}
  SELECT c_custkey, o_orderkey, CASE WHEN o_orderkey IS NULL THEN 0 ELSE -1 END AS result_size FROM c LEFT JOIN o ON ref = o_custkey AND rn = 1""")
def lookup_hybrid(t):
    found = lookup.lookup_hybrid(shifted(t), t.orders, {"ref": "o_custkey"}, ["o_orderkey"], latest_order())
    return found.select("c_custkey", "o_orderkey", F.coalesce(F.when(F.col("result").isNull(), F.lit(-1)), F.size("result")).alias("result_size"))


@plan("lookup_const", """
  SELECT c_custkey, c_acctbal, (SELECT max(o_totalprice) FROM orders) AS top_price, (SELECT count(*) FROM orders) AS order_count FROM customer""")
def lookup_const(t):
    totals = t.orders.agg(F.max("o_totalprice").alias("top_price"), F.count(F.lit(1)).alias("order_count"))
    return lookup.lookup_const(t.customer.select("c_custkey", "c_acctbal"), totals)


@plan("lookup_param_fallback", """
  SELECT c_custkey, o_orderkey, o_totalprice FROM (SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN NULL ELSE 200000 END AS min_total FROM customer) c
  LEFT JOIN orders ON o_custkey = c_custkey AND o_totalprice > coalesce(min_total, 1000)""")
def lookup_param_fallback(t):
    df = t.customer.select("c_custkey", F.expr("if(c_custkey % 2 = 0, null, '200000')").alias("min_total"))
    found = lookup.lookup_sql(df, "SELECT o_orderkey, o_totalprice FROM orders WHERE o_custkey = :c_custkey AND o_totalprice > cast(:min_total as double)",
                              views={"orders": t.orders}, context=CONTEXT)
    return found.drop("min_total")


@plan("lookup_sql_quoted", """
  SELECT c_custkey, o_orderkey, 'orders :c_custkey' AS note, 'a{b}' AS mark FROM customer LEFT JOIN orders ON o_custkey = c_custkey AND o_orderstatus <> 'orders'""")
def lookup_sql_quoted(t):
    """Texts that look like a view, a parameter, a limit or a format stay what they are."""
    context = RunContext(attributes={"mark": "a{b}"})
    return lookup.lookup_sql(t.customer.select("c_custkey"), "SELECT o_orderkey, 'orders :c_custkey' AS note, :mark AS mark FROM orders "
                             "WHERE o_custkey = :c_custkey AND o_orderstatus <> 'orders' AND 'limit' <> 'order by'", views={"orders": t.orders}, context=context).withColumns(
        {"note": F.coalesce("note", F.lit("orders :c_custkey")), "mark": F.coalesce("mark", F.lit("a{b}"))})


@plan("lookup_sql_one", f"""{LATEST_SQL}
  SELECT c_custkey, strftime(o_orderdate, '%Y-%m-%d') AS day, o_orderkey, o_totalprice FROM c LEFT JOIN o ON ref = o_custkey AND rn = 1""")
def lookup_sql_one(t):
    found = lookup.lookup_sql(shifted(t).select("c_custkey", "ref"),
                             "SELECT o_orderdate, o_orderkey, o_totalprice FROM orders WHERE o_custkey = :ref", mode=lookup.ONE,
                             order_by=["o_orderdate desc", "o_orderkey desc"], views={"orders": t.orders})
    return found.select("c_custkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"), "o_orderkey", "o_totalprice")


@plan("dict_lookup", """
  SELECT c_custkey, c_name, n_name, r_name FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey""")
def dict_lookup(t):
    named = lookup.dict_lookup(t.customer, t.nation, {"c_nationkey": "n_nationkey"}, ["n_name", "n_regionkey"])
    return lookup.dict_lookup(named, t.region, {"n_regionkey": "r_regionkey"}, ["r_name"]).select("c_custkey", "c_name", "n_name", "r_name")


@plan("dict_items", """
  SELECT n_nationkey AS item_code, n_name AS item_name FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_name = 'ASIA'""")
def dict_items(t):
    items = lookup.dict_lookup(t.nation, t.region, {"n_regionkey": "r_regionkey"}, ["r_name"])
    return lookup.dictionary_items(items, "ASIA", "r_name").select(F.col("n_nationkey").alias("item_code"), F.col("n_name").alias("item_name"))


@plan("conform_names", """SELECT p_partkey AS "pPartKey", p_name AS "PName" FROM part""")
def conform_names(t):
    return lookup.conform_names(t.part, ["pPartKey", "PName", "absent"])


@plan("lookup_sql_range", """
  SELECT c_custkey, c_acctbal, p_partkey, p_retailprice FROM customer LEFT JOIN part
    ON p_retailprice >= c_acctbal AND p_retailprice < c_acctbal + 5 * (c_custkey % 7) AND (p_size < 30 OR p_partkey % 2 = 0)""")
def lookup_sql_range(t):
    """Parts whose price lies between two bounds of each customer."""
    asked = t.customer.select("c_custkey", "c_acctbal", F.expr("c_acctbal + 5 * (c_custkey % 7)").alias("top"))
    return lookup.lookup_sql(
        asked, "SELECT p_partkey, p_retailprice FROM part WHERE p_retailprice >= :c_acctbal AND p_retailprice < :top AND (p_size < 30 OR p_partkey % 2 = 0)",
        views={"part": t.part}, within=lookup.Within("part", "p_retailprice", "c_acctbal", "top")).drop("top")


@plan("lookup_sql_since", """
  WITH d AS (SELECT DISTINCT CAST(ts AS DATE) - INTERVAL 27 YEAR AS day FROM events),
  f AS (SELECT day, o_orderkey, o_orderdate FROM d JOIN orders ON o_orderdate >= day QUALIFY row_number() OVER (PARTITION BY day ORDER BY o_orderdate, o_orderkey) = 1)
  SELECT event_id, user_id, o_orderkey, o_orderdate FROM events LEFT JOIN f ON day = CAST(ts AS DATE) - INTERVAL 27 YEAR""")
def lookup_sql_since(t):
    """The first order from a day on, for each event: bounded from below alone."""
    asked = t.events.select("event_id", "user_id", F.expr("to_date(ts) - interval 27 years").cast("date").alias("day"))
    return lookup.lookup_sql(
        asked, "SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate >= :day", mode=lookup.ONE, order_by=["o_orderdate", "o_orderkey"],
        views={"orders": t.orders}, within=lookup.Within("orders", "o_orderdate", low="day")).drop("day")


@plan("column_list", "SELECT n_name FROM nation")
def column_list(t):
    return lookup.column_of(t.nation, 2)


@plan("first_row", "SELECT * FROM nation ORDER BY n_nationkey DESC LIMIT 1")
def first_row(t):
    return lookup.first_row(t.nation, [F.desc("n_nationkey")])


# Keyed documents: customers as state, events as changes; ids are spread so that some changes meet no customer

STATE = "SELECT c_custkey AS id, c_mktsegment AS kind, c_acctbal AS score FROM customer"


def documents(t):
    return t.customer.select(F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("kind"), F.col("c_acctbal").alias("score"))


CHANGES = """SELECT user_id * 13 AS id, CASE WHEN event_id % 5 = 0 THEN NULL ELSE event_type END AS kind, CASE WHEN event_id % 7 = 0 THEN NULL ELSE value END AS score,
    CASE event_id % 11 WHEN 0 THEN 'delete' WHEN 1 THEN 'index' WHEN 2 THEN 'upsert' WHEN 3 THEN 'delete' ELSE 'update' END AS op, ts, event_id FROM events"""


def changes(t):
    return t.events.select(
        (F.col("user_id") * 13).alias("id"), F.when(F.col("event_id") % 5 != 0, F.col("event_type")).alias("kind"),
        F.when(F.col("event_id") % 7 != 0, F.col("value")).alias("score"),
        F.expr("case event_id % 11 when 0 then 'delete' when 1 then 'index' when 2 then 'upsert' when 3 then 'delete' else 'update' end").alias("op"),
        "ts", "event_id")


MERGED = """m AS (SELECT id, arg_max(kind, event_id) FILTER (kind IS NOT NULL) AS kind, arg_max(score, event_id) FILTER (score IS NOT NULL) AS score FROM x GROUP BY id)"""


@plan("apply_index", f"""
  WITH s AS ({STATE}), x AS ({CHANGES}), l AS (SELECT id, kind, score FROM x QUALIFY row_number() OVER (PARTITION BY id ORDER BY event_id DESC) = 1)
  SELECT * FROM l UNION ALL SELECT * FROM s WHERE id NOT IN (SELECT id FROM l)""")
def apply_index(t):
    return keyed.apply_index(documents(t), changes(t), "id", ["event_id"])


@plan("apply_index_new_ids", f"""
  WITH s AS ({STATE}), x AS (SELECT CASE WHEN event_id % 4 <> 0 THEN id END AS id, kind, score, event_id FROM ({CHANGES})),
  m AS (SELECT greatest((SELECT max(id) FROM s), (SELECT max(id) FROM x)) AS top)
  SELECT NULL AS kind, count(*) AS rows, count(*) AS ids, CAST(1 AS BIGINT) AS low, count(*) AS high FROM x WHERE id IS NULL
  UNION ALL SELECT kind, count(*), CAST(NULL AS BIGINT), CAST(NULL AS BIGINT), CAST(NULL AS BIGINT) FROM x WHERE id IS NULL AND kind IS NOT NULL GROUP BY kind""")
def apply_index_new_ids(t):
    """Documents without an id: their new ids follow the greatest known one, each once and without a gap."""
    given = changes(t).withColumn("id", F.when(F.col("event_id") % 4 != 0, F.col("id")))
    state = documents(t)
    top = state.select("id").unionAll(given.select("id")).agg(F.max("id")).first()[0]
    new = keyed.apply_index(state, given, "id", ["event_id"]).where(F.col("id") > top)
    whole = new.agg(F.lit(None).cast("string").alias("kind"), F.count(F.lit(1)).alias("rows"), F.countDistinct("id").alias("ids"),
                    (F.min("id") - top).alias("low"), (F.max("id") - top).alias("high"))
    nothing = F.lit(None).cast("bigint")
    return whole.unionByName(new.where("kind is not null").groupBy("kind").agg(F.count(F.lit(1)).alias("rows")).withColumns(
        {"ids": nothing, "low": nothing, "high": nothing}))


@plan("lookup_salted", """
  WITH e AS (SELECT event_id, CASE WHEN event_id % 5 < 3 THEN 7 WHEN event_id % 50 = 4 THEN NULL ELSE user_id END AS k FROM events)
  SELECT event_id, k, count(c_custkey) AS customers, CAST(sum(c_custkey) AS BIGINT) AS keys FROM e LEFT JOIN customer ON c_nationkey = k % 40 AND k < 25 GROUP BY 1, 2""")
def lookup_salted(t):
    """Customers of a nation for each event, where three events in five ask for the same one."""
    k = F.expr("case when event_id % 5 < 3 then 7 when event_id % 50 = 4 then null else user_id end")
    events = t.events.select("event_id", k.cast("bigint").alias("k"))
    # summed per nation before the lookup: the pairs of events and customers are never spelled out
    nations = t.customer.groupBy("c_nationkey").agg(F.count("c_custkey").alias("customers"), F.sum("c_custkey").cast("bigint").alias("keys"))
    return lookup.lookup_salted(events.withColumn("nation", F.expr("if(k < 25, k % 40, null)")), nations, {"nation": "c_nationkey"},
                                ["customers", "keys"], most=500).groupBy("event_id", "k").agg(
        F.sum(F.coalesce("customers", F.lit(0))).alias("customers"), F.sum("keys").cast("bigint").alias("keys"))


@plan("apply_update", f"""
  WITH s AS ({STATE}), x AS ({CHANGES}), {MERGED}
  SELECT s.id, coalesce(m.kind, s.kind) AS kind, coalesce(m.score, s.score) AS score FROM s LEFT JOIN m USING (id)""")
def apply_update(t):
    return keyed.apply_update(documents(t), changes(t), "id", ["event_id"])[0]


@plan("apply_update_missing", f"""
  WITH s AS ({STATE}), x AS ({CHANGES}) SELECT event_id, id, 'document_missing' AS "errorMessage" FROM x WHERE id NOT IN (SELECT id FROM s)""")
def apply_update_missing(t):
    return keyed.apply_update(documents(t), changes(t), "id", ["event_id"])[1].select("event_id", "id", "errorMessage")


@plan("apply_upsert", f"""
  WITH s AS ({STATE}), x AS ({CHANGES}), {MERGED}
  SELECT coalesce(s.id, m.id) AS id, coalesce(m.kind, s.kind) AS kind, coalesce(m.score, s.score) AS score FROM s FULL JOIN m ON s.id = m.id""")
def apply_upsert(t):
    return keyed.apply_upsert(documents(t), changes(t), "id", ["event_id"])


@plan("apply_delete", f"""
  WITH s AS ({STATE}), x AS ({CHANGES}) SELECT * FROM s WHERE id NOT IN (SELECT id FROM x WHERE op = 'delete')""")
def apply_delete(t):
    return keyed.apply_delete(documents(t), changes(t).filter("op = 'delete'"), "id")


RESULTS = f"""s AS ({STATE}), x AS ({CHANGES}),
  b AS (SELECT x.*, last_value(CASE WHEN op <> 'update' THEN op END IGNORE NULLS) OVER (PARTITION BY id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM x),
  p AS (SELECT b.*, CASE WHEN before IS NULL THEN b.id IN (SELECT id FROM s) ELSE before <> 'delete' END AS present FROM b),
  r AS (SELECT *, CAST(CASE WHEN op IN ('update', 'delete') AND NOT present THEN 404 WHEN op IN ('index', 'upsert') AND NOT present THEN 201 ELSE 200 END AS INTEGER) AS status FROM p)"""


@plan("apply_changes_results", f"""
  WITH {RESULTS} SELECT event_id, op, status, CASE WHEN status = 404 AND op = 'update' THEN 'document_missing' WHEN status = 404 THEN 'not_found'
    WHEN status = 201 THEN 'created' WHEN op = 'delete' THEN 'deleted' ELSE 'updated' END AS result FROM r""")
def apply_changes_results(t):
    return keyed.change_results(documents(t), changes(t), "id", "op", ["event_id"]).select("event_id", "op", "status", "result")


@plan("apply_changes", f"""
  WITH {RESULTS}, v AS (SELECT * FROM r WHERE status < 300),
  z AS (SELECT id, max(event_id) FILTER (op IN ('index', 'delete')) AS reset, arg_max(op, event_id) FILTER (op <> 'update') AS last_op FROM v GROUP BY id),
  f AS (SELECT v.id, any_value(last_op) AS last_op, any_value(reset) AS reset,
      arg_max(kind, event_id) FILTER (kind IS NOT NULL AND (reset IS NULL OR event_id > reset OR event_id = reset AND op = 'index')) AS kind,
      arg_max(score, event_id) FILTER (score IS NOT NULL AND (reset IS NULL OR event_id > reset OR event_id = reset AND op = 'index')) AS score
    FROM v JOIN z ON v.id = z.id GROUP BY v.id)
  SELECT coalesce(s.id, f.id) AS id, CASE WHEN f.reset IS NOT NULL THEN f.kind ELSE coalesce(f.kind, s.kind) END AS kind,
    CASE WHEN f.reset IS NOT NULL THEN f.score ELSE coalesce(f.score, s.score) END AS score
  FROM s FULL JOIN f ON s.id = f.id WHERE f.last_op IS NULL OR f.last_op <> 'delete'""")
def apply_changes(t):
    return keyed.apply_changes(documents(t), changes(t), "id", "op", ["event_id"])[0]


@plan("bulk_validate", """
  SELECT event_id, CASE WHEN event_type IN ('index', 'update') OR event_type = 'view' AND event_id % 2 = 0 THEN 'ok' WHEN event_type = 'view' THEN 'failure' ELSE 'failure' END AS route,
    CASE WHEN event_type <> 'view' THEN 'unknown operation' WHEN event_id % 2 <> 0 THEN 'missing id' END AS "errorMessage" FROM events""")
def bulk_validate(t):
    df = t.events.select("event_id", F.when(F.col("event_type") == "view", "Update").otherwise(F.col("event_type")).alias("op"),
                         F.when(F.col("event_id") % 2 == 0, F.col("user_id")).alias("id"))
    return keyed.validate_changes(df, "op", "id", "events").select("event_id", "route", "errorMessage")


BULK_ROW = """'{"id":' || event_id || ',"meta":{"user":"' || CASE WHEN event_id % 6 = 0 THEN '' ELSE CAST(user_id AS VARCHAR) END || '"}}'"""
BULK_OP = "CASE event_id % 4 WHEN 0 THEN 'index' WHEN 1 THEN 'update' WHEN 2 THEN 'upsert' ELSE 'delete' END"


@plan("bulk_lines", f"""
  WITH b AS (SELECT event_id, {BULK_OP} AS op, {BULK_ROW} AS doc, CASE WHEN event_id % 6 = 0 THEN '' ELSE ',"_id":"' || user_id || '"' END AS ident FROM events)
  SELECT event_id, '{{"' || CASE op WHEN 'upsert' THEN 'update' ELSE op END || '":{{"_index":"events","_type":"doc"' || ident || '}}}}' AS action,
    CASE op WHEN 'index' THEN doc WHEN 'update' THEN '{{"doc":' || doc || ',"doc_as_upsert":false}}' WHEN 'upsert' THEN '{{"doc":' || doc || ',"doc_as_upsert":true}}' END AS document FROM b""")
def bulk_lines(t):
    user = F.when(F.col("event_id") % 6 == 0, "").otherwise(F.col("user_id").cast("string"))
    df = t.events.select(F.col("event_id").alias("id"), F.struct(user.alias("user")).alias("meta"))
    op = F.expr("case id % 4 when 0 then 'INDEX' when 1 then 'update' when 2 then 'upsert' else 'delete' end")
    return keyed.bulk_lines(df, "events", "doc", op, "meta.user").select(F.col("id").alias("event_id"), "action", "document")


@plan("status_split", """
  WITH i AS (SELECT event_id, CAST(CASE event_id % 5 WHEN 0 THEN 200 WHEN 1 THEN 201 WHEN 2 THEN 404 WHEN 3 THEN 503 ELSE 400 END AS INTEGER) AS status FROM events)
  SELECT event_id, CASE status // 100 WHEN 2 THEN 'success' WHEN 5 THEN 'retry' ELSE 'failure' END AS route,
    CASE status WHEN 404 THEN 'not_found' WHEN 503 THEN 'busy' WHEN 400 THEN 'bad field' END AS "errorMessage" FROM i""")
def status_split(t):
    items = t.events.select("event_id", F.expr("case event_id % 5 when 0 then 200 when 1 then 201 when 2 then 404 when 3 then 503 else 400 end").alias("status")) \
        .withColumns({"result": F.expr("case status when 404 then 'not_found' when 400 then '' end"),
                      "reason": F.expr("case status when 404 then 'ignored' when 503 then 'busy' when 400 then 'bad field' end")})
    return keyed.split_status(items).select("event_id", "route", "errorMessage")


@plan("dml_insert", """
  SELECT o_orderkey AS id, o_totalprice AS amount, CAST(NULL AS BIGINT) AS result FROM orders
  UNION ALL SELECT event_id, value, 1 FROM events""")
def dml_insert(t):
    target = t.orders.select(F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("amount"))
    rows = t.events.select(F.col("event_id").alias("id"), F.col("value").alias("amount"))
    return keyed.dml_insert(keyed.dml_counts(rows, target, {"id": "id"}, keyed.INSERT), target)


@plan("dml_update_counts", "SELECT event_id, user_id, count(o_orderkey) AS result FROM events LEFT JOIN orders ON o_custkey = user_id GROUP BY 1, 2")
def dml_update_counts(t):
    return keyed.dml_counts(t.events.select("event_id", "user_id"), t.orders, {"user_id": "o_custkey"}, keyed.UPDATE)


@plan("dml_delete_counts", """
  WITH o AS (SELECT o_orderkey, o_orderstatus, count(*) AS n FROM orders GROUP BY 1, 2)
  SELECT l_orderkey, l_linenumber, coalesce(n, 0) AS result FROM lineitem LEFT JOIN o ON o_orderkey = l_orderkey AND o_orderstatus = l_linestatus""")
def dml_delete_counts(t):
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_linestatus")
    return keyed.dml_counts(rows, t.orders, {"l_orderkey": "o_orderkey", "l_linestatus": "o_orderstatus"}, keyed.DELETE).drop("l_linestatus")


@plan("dml_update", """
  WITH l AS (SELECT user_id, event_type, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1)
  SELECT o_orderkey, CASE WHEN user_id IS NULL THEN o_orderstatus ELSE event_type END AS o_orderstatus, CASE WHEN user_id IS NULL THEN o_totalprice ELSE value END AS o_totalprice
  FROM orders LEFT JOIN l ON o_custkey = user_id""")
def dml_update(t):
    return keyed.dml_update(t.events, t.orders, {"user_id": "o_custkey"}, {"o_orderstatus": "event_type", "o_totalprice": "value"}, ["event_id"]) \
        .select("o_orderkey", "o_orderstatus", "o_totalprice")


@plan("dml_delete", "SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey NOT IN (SELECT user_id FROM events)")
def dml_delete(t):
    return keyed.dml_delete(t.events, t.orders, {"user_id": "o_custkey"}).select("o_orderkey", "o_custkey")
