"""Slices for backfills, request events and graph rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import events, graph, sequence
from millrace.operators.sequence import SequenceConfig
from millrace.plans.registry import CONTEXT, plan

# Slices over the span of the orders table


def span(df, column, pattern="yyyy-MM-dd"):
    """First and last day (or number) of a column: one aggregated row."""
    low, high = df.agg(F.min(column), F.max(column)).first()
    return (low.strftime("%Y-%m-%d"), high.strftime("%Y-%m-%d")) if hasattr(low, "strftime") else (str(low), str(high))


@plan("seq_dates", """
  WITH d AS (SELECT unnest(generate_series(min(o_orderdate), max(o_orderdate), INTERVAL 7 DAY)) AS v FROM orders),
  s AS (SELECT strftime(v, '%Y%m%d') AS value, lag(strftime(v, '%Y%m%d')) OVER (ORDER BY v) AS "prevValue", v FROM d)
  SELECT value, "prevValue", (SELECT count(*) FROM orders WHERE o_orderdate >= v AND o_orderdate < v + INTERVAL 7 DAY) AS orders FROM s""")
def seq_dates(t):
    first, last = (x.replace("-", "") for x in span(t.orders, "o_orderdate"))
    slices = sequence.generate_sequence(t.spark, SequenceConfig("orders", init=first, max=last, step="7D", format="yyyyMMdd", batch=None), context=CONTEXT)
    start = F.lit(f"{first[:4]}-{first[4:6]}-{first[6:]}").cast("date")
    per_slice = t.orders.groupBy((F.floor(F.datediff("o_orderdate", start) / 7)).cast("int").alias("n")).agg(F.count(F.lit(1)).alias("orders"))
    return slices.join(per_slice, "n", "left").select("value", "prevValue", F.coalesce("orders", F.lit(0)).alias("orders"))


@plan("seq_numbers", """
  WITH b AS (SELECT max(l_orderkey) AS hi FROM lineitem), s AS (SELECT unnest(generate_series(CAST(0 AS BIGINT), hi - 1, 1000)) AS v FROM b)
  SELECT CAST(v AS VARCHAR) AS value, CAST(lag(v) OVER (ORDER BY v) AS VARCHAR) AS "prevValue",
    (SELECT count(*) FROM lineitem WHERE l_orderkey >= v AND l_orderkey < v + 1000) AS lines FROM s""")
def seq_numbers(t):
    _, high = span(t.lineitem, "l_orderkey")
    slices = sequence.generate_sequence(t.spark, SequenceConfig("lines", sequence.NUMBER, init="0", max=high, step="1000", batch=None), context=CONTEXT)
    per_slice = t.lineitem.groupBy((F.floor(F.col("l_orderkey") / 1000)).alias("n")).agg(F.count(F.lit(1)).alias("lines"))
    return slices.join(per_slice, "n", "left").select("value", "prevValue", F.coalesce("lines", F.lit(0)).alias("lines"))


@plan("seq_month_end", """
  WITH RECURSIVE b AS (SELECT last_day(min(o_orderdate) - INTERVAL 1 MONTH) AS lo, max(o_orderdate) AS hi FROM orders),
  s AS (SELECT 0 AS n, CAST(lo AS TIMESTAMP) AS v, hi FROM b UNION ALL SELECT n + 1, v + INTERVAL 1 MONTH, hi FROM s WHERE v + INTERVAL 1 MONTH <= hi),
  w AS (SELECT v, lead(v) OVER (ORDER BY v) AS until FROM s)
  SELECT strftime(v, '%Y-%m-%d') AS value, (SELECT count(*) FROM orders WHERE o_orderdate >= v AND (until IS NULL OR o_orderdate < until)) AS orders FROM w""")
def seq_month_end(t):
    row = t.orders.agg(F.last_day(F.add_months(F.min("o_orderdate"), -1)).alias("lo"), F.max("o_orderdate").alias("hi")).first()
    config = SequenceConfig("months", init=f"{row.lo:%Y-%m-%d}", max=f"{row.hi:%Y-%m-%d}", step="1M", batch=None)
    days = sequence.slice_days(sequence.generate_sequence(t.spark, config, context=CONTEXT))
    per_day = t.orders.groupBy(F.to_date("o_orderdate").alias("day")).agg(F.count(F.lit(1)).alias("n"))
    return days.join(per_day, "day", "left").groupBy("value").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("orders"))


@plan("seq_template", """
  WITH d AS (SELECT unnest(generate_series(min(ts)::DATE, min(ts)::DATE + 9, INTERVAL 3 DAY)) AS v FROM events)
  SELECT strftime(v, '%Y%m%d') AS value, (SELECT count(*) FROM events WHERE ts::DATE >= v AND ts::DATE < v + INTERVAL 3 DAY) AS events FROM d""")
def seq_template(t):
    first = t.events.agg(F.min("ts").alias("lo")).first().lo
    config = SequenceConfig("s", init=f"{first:%Y%m%d}", max=f"@{{date'{first:%Y-%m-%d}' + interval 9 day}}", step="3D", format="yyyyMMdd", batch=None)
    days = sequence.slice_days(sequence.generate_sequence(t.spark, config, context=CONTEXT), "yyyyMMdd")
    per_day = t.events.groupBy(F.to_date("ts").alias("day")).agg(F.count(F.lit(1)).alias("n"))
    return days.join(per_day, "day", "left").groupBy("value").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("events"))


@plan("seq_number_template", """
  WITH s AS (SELECT unnest(generate_series(CAST(0 AS BIGINT), (SELECT 2 * count(*) FROM events) - 1, 100)) AS v),
  n AS (SELECT event_id // 100 * 100 AS v, count(*) AS n FROM events GROUP BY 1)
  SELECT CAST(v AS VARCHAR) AS value, coalesce(n, 0) AS events FROM s LEFT JOIN n USING (v)""")
def seq_number_template(t):
    config = SequenceConfig("s", sequence.NUMBER, init="0", max=f"@{{2 * {t.events.count()}}}", step="100", batch=None)
    slices = sequence.generate_sequence(t.spark, config, context=CONTEXT)
    per_slice = t.events.groupBy((F.floor(F.col("event_id") / 100)).alias("n")).agg(F.count(F.lit(1)).alias("events"))
    return slices.join(per_slice, "n", "left").select("value", F.coalesce("events", F.lit(0)).alias("events"))


def stored_state(t):
    """Counters left by an earlier run: the first order day of each status as last value."""
    return t.orders.groupBy(F.col("o_orderstatus").alias("code")).agg(F.date_format(F.min("o_orderdate"), "yyyy-MM-dd").alias("value")).select(
        "code", F.lit("date").alias("strategy"), F.lit("1D").alias("step"), F.lit(None).cast("string").alias("format"), F.lit(None).cast("string").alias("initValue"),
        F.lit("2000-01-01").alias("maxValue"), "value", F.lit(None).cast("string").alias("prevValue"), CONTEXT.now_column().alias("lastUpdateTime"))


RESUMED = """WITH RECURSIVE st AS (SELECT o_orderstatus AS code, CAST(min(o_orderdate) AS DATE) AS value FROM orders GROUP BY 1),
  s AS (SELECT 0 AS n, CAST(value AS TIMESTAMP) AS v, CAST(NULL AS TIMESTAMP) AS p FROM st WHERE code = 'F'
    UNION ALL SELECT n + 1, v + INTERVAL 2 MONTH, v FROM s WHERE v + INTERVAL 2 MONTH <= TIMESTAMP '1999-12-31' AND n < 12)"""


@plan("seq_resume", f"""{RESUMED}
  SELECT strftime(v, '%Y-%m-%d') AS value, strftime(p, '%Y-%m-%d') AS "prevValue", '2M' AS step, '1999-12-31' AS "maxValue" FROM s WHERE n > 0""")
def seq_resume(t):
    config = SequenceConfig("F", max="1999-12-31", step="2M", batch=12)
    return sequence.generate_sequence(t.spark, config, state=stored_state(t), context=CONTEXT).select("value", "prevValue", "step", "maxValue")


@plan("seq_state", f"""{RESUMED}
  SELECT 'F' AS code, strftime(v, '%Y-%m-%d') AS value, strftime(p, '%Y-%m-%d') AS "prevValue", '2M' AS step FROM s WHERE n = (SELECT max(n) FROM s)
  UNION ALL SELECT code, strftime(value, '%Y-%m-%d'), NULL, '1D' FROM st WHERE code <> 'F'""")
def seq_state(t):
    state = stored_state(t)
    values = sequence.generate_sequence(t.spark, SequenceConfig("F", max="1999-12-31", step="2M", batch=12), state=state, context=CONTEXT)
    return sequence.save_state(state, values).select("code", "value", "prevValue", "step")


@plan("seq_slices", """
  WITH d AS (SELECT unnest(generate_series(date_trunc('day', min(ts)), date_trunc('day', max(ts)) + INTERVAL 5 DAY, INTERVAL 1 DAY)) AS v FROM events)
  SELECT strftime(v, '%Y-%m-%d') AS value, (SELECT count(*) FROM events WHERE ts >= v AND ts < v + INTERVAL 1 DAY) AS events,
    (SELECT count(*) FROM events WHERE event_type = 'error' AND ts >= v AND ts < v + INTERVAL 1 DAY) AS errors FROM d""")
def seq_slices(t):
    row = t.events.agg(F.min("ts").alias("lo"), F.date_add(F.to_date(F.max("ts")), 5).alias("hi")).first()
    days = sequence.generate_sequence(t.spark, SequenceConfig("days", init=f"{row.lo:%Y-%m-%d}", max=f"{row.hi:%Y-%m-%d}", batch=None), context=CONTEXT)
    per_day = t.events.groupBy(F.date_format("ts", "yyyy-MM-dd").alias("value")).agg(
        F.count(F.lit(1)).alias("events"), F.count_if(F.col("event_type") == "error").alias("errors"))
    return days.join(per_day, "value", "left").select("value", F.coalesce("events", F.lit(0)).alias("events"), F.coalesce("errors", F.lit(0)).alias("errors"))


# Request events: the payload is built from the event row, one of nine forms by event id; each form shows one rule

PAYLOADS_SQL = r"""WITH q AS (SELECT event_id, user_id, event_type, value, ts, CASE event_id % 9
      WHEN 0 THEN 'query Feed_' || event_type || '($u: Int!, $lim: [Float!] = [1.0]) @cached(ttl: 9) { timeline(of: $u) { at } }'
      WHEN 1 THEN '{ clicks(window: [[1, 2], [' || event_id || ']], at: {lat: -0.5, tags: []}, mode: FAST) }'
      WHEN 2 THEN 'subscription { live: stream_' || event_type || '(key: $k, none: $zz, size: $n) @defer(label: \"x\") { ... on Row @keep { v } } }'
      WHEN 3 THEN '{ left { a } right }'
      WHEN 4 THEN '   '
      WHEN 5 THEN '{ clicks(user: %) }'
      WHEN 6 THEN 'type Row { v: Int }'
      WHEN 7 THEN 'mutation Put_' || event_type || ' {\n  # kept as it is }\n  put { id }\n}'
      ELSE '{ clicks [ }' END AS payload,
    CASE event_id % 9 WHEN 0 THEN '{"u": ' || user_id || ', "deep": {"k": [' || event_id || ', true, null, 1.50]}}'
      WHEN 2 THEN '{k: ''v' || user_id || ''', n: ' || event_id || '}' ELSE '' END AS vars FROM events)"""


def requests(t):
    kind, user, event = F.col("event_type"), F.col("user_id").cast("string"), F.col("event_id").cast("string")

    def text(*parts):
        return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])

    forms = [
        text("query Feed_", kind, "($u: Int!, $lim: [Float!] = [1.0]) @cached(ttl: 9) { timeline(of: $u) { at } }"),
        text("{ clicks(window: [[1, 2], [", event, "]], at: {lat: -0.5, tags: []}, mode: FAST) }"),
        text("subscription { live: stream_", kind, r'(key: $k, none: $zz, size: $n) @defer(label: \"x\") { ... on Row @keep { v } } }'),
        text("{ left { a } right }"), text("   "), text("{ clicks(user: %) }"), text("type Row { v: Int }"),
        text("mutation Put_", kind, r" {\n  # kept as it is }\n  put { id }\n}"), text("{ clicks [ }")]
    payload = forms[-1]
    for i, form in enumerate(forms[:-1]):
        payload = F.when(F.col("event_id") % 9 == i, form).otherwise(payload)
    typed = text('{"u": ', user, ', "deep": {"k": [', event, ", true, null, 1.50]}}")
    variables = F.when(F.col("event_id") % 9 == 0, typed).when(F.col("event_id") % 9 == 2, text("{k: 'v", user, "', n: ", event, "}")).otherwise("")
    return t.events.select("event_id", "user_id", "event_type", "value", "ts", payload.alias("payload"), variables.alias("vars"))


def parsed(t):
    return events.with_request(requests(t), F.col("payload"), F.col("vars"))


@plan("gql_header", f"""{PAYLOADS_SQL} SELECT event_id,
    CASE event_id % 9 WHEN 4 THEN 'PROFILE' WHEN 2 THEN 'SUBSCRIPTION' WHEN 7 THEN 'MUTATION' WHEN 5 THEN NULL WHEN 6 THEN NULL WHEN 8 THEN NULL ELSE 'QUERY' END AS type,
    CASE event_id % 9 WHEN 0 THEN 'Feed_' || event_type WHEN 1 THEN 'clicks' WHEN 2 THEN 'stream_' || event_type WHEN 7 THEN 'Put_' || event_type END AS name FROM q""")
def gql_header(t):
    return parsed(t).select("event_id", "type", "name")


@plan("gql_variables", f"""{PAYLOADS_SQL} SELECT event_id, CASE WHEN starts_with(payload, 'query Feed') THEN vars END AS params FROM q""")
def gql_variables(t):
    named = F.startswith("payload", F.lit("query Feed"))
    return parsed(t).select("event_id", F.when(named, F.col("params")).alias("params"))


@plan("gql_variables_typed", f"""{PAYLOADS_SQL} SELECT event_id, CASE WHEN event_id % 9 = 0 THEN user_id END AS u,
  CASE WHEN event_id % 9 = 0 THEN event_id END AS first, CASE WHEN event_id % 9 = 0 THEN TRUE END AS second FROM q""")
def gql_variables_typed(t):
    kinds = "struct<u: int, deep: struct<k: array<variant>>>"
    rows = parsed(t).select("event_id", F.from_json("params", kinds).alias("p"))
    return rows.select("event_id", F.col("p.u").cast("bigint").alias("u"), F.expr("cast(p.deep.k[0] as bigint)").alias("first"),
                       F.expr("cast(p.deep.k[1] as boolean)").alias("second"))


@plan("gql_flat_args", f"""{PAYLOADS_SQL}
  SELECT event_id, CASE event_id % 9 WHEN 1 THEN '{{"window":[["1","2"],["' || event_id || '"]],"at":{{"lat":"-0.5","tags":[]}},"mode":"FAST"}}'
    WHEN 2 THEN '{{"key":"v' || user_id || '","none":"","size":"' || event_id || '"}}' WHEN 0 THEN vars WHEN 7 THEN '{{}}' END AS params FROM q""")
def gql_flat_args(t):
    return parsed(t).select("event_id", "params")


@plan("gql_failure", f"""{PAYLOADS_SQL} SELECT event_id, payload, 'unsupported request' AS "errorMessage" FROM q WHERE event_id % 9 IN (5, 6, 8)""")
def gql_failure(t):
    return parsed(t).filter("errorMessage is not null").select("event_id", "payload", "errorMessage")


def event_rows(t):
    attrs = F.create_map(F.lit("requestPayload"), F.col("payload"), F.lit("requestVariables"), F.col("vars"), F.lit("respType"), F.lit("application/json"),
                         F.lit("respStatus"), F.when(F.col("event_id") % 2 == 0, "200").otherwise("500"), F.lit("browser"), F.lit("x"), F.lit("trace"), F.col("event_id").cast("string"))
    return requests(t).select(F.col("event_id").alias("id"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("@timestamp"), F.col("user_id").alias("uid"),
                              F.col("event_type").alias("category"), F.expr("if(event_id % 3 = 0, null, 'profile page')").alias("name"), attrs.alias("attrs"))


@plan("event_normalise", f"""{PAYLOADS_SQL}
  SELECT CAST(event_id AS VARCHAR) AS id, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS "@timestamp", CAST(user_id AS VARCHAR) AS uid, event_type AS category, '' AS pid, '' AS hostname,
    'application/json' AS "respType", '' AS "respLength", CASE WHEN event_id % 2 = 0 THEN '200' ELSE '500' END AS "respStatus",
    CASE WHEN event_id % 9 IN (5, 6, 8) THEN 'failure' ELSE 'success' END AS route FROM q""")
def event_normalise(t):
    return events.normalise_events(event_rows(t)).select("id", "@timestamp", "uid", "category", "pid", "hostname", "respType", "respLength", "respStatus", "route")


@plan("event_attrs_rest", f"""{PAYLOADS_SQL} SELECT CAST(event_id AS VARCHAR) AS id, 'browser=x,trace=' || event_id AS rest FROM q""")
def event_attrs_rest(t):
    done = events.normalise_events(event_rows(t))
    pairs = F.transform(F.array_sort(F.map_entries("attrs")), lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    return done.select("id", F.array_join(pairs, ",").alias("rest"))


@plan("event_type", f"""{PAYLOADS_SQL}
  SELECT CASE event_id % 9 WHEN 4 THEN 'PROFILE' WHEN 7 THEN 'MUTATION' WHEN 2 THEN 'SUBSCRIPTION' WHEN 5 THEN NULL WHEN 6 THEN NULL WHEN 8 THEN NULL ELSE 'QUERY' END AS type, count(*) AS rows FROM q GROUP BY 1""")
def event_type(t):
    return events.normalise_events(event_rows(t)).groupBy("type").agg(F.count(F.lit(1)).alias("rows"))


# Graph rows: customers, nations, regions and orders


def customer_nodes(t):
    return graph.nodes_from(t.customer, "concat('c', c_custkey)", ["Customer"], {"name": "c_name", "segment": "if(c_custkey % 5 = 0, null, c_mktsegment)"})


def nation_nodes(t):
    return graph.nodes_from(t.nation, "concat('n', n_nationkey)", ["Nation", "Place"], {"name": "n_name"})


def region_nodes(t):
    return graph.nodes_from(t.region, "concat('r', r_regionkey)", ["Region", "Place"], {"name": "r_name"})


def all_nodes(t):
    return customer_nodes(t).unionByName(nation_nodes(t)).unionByName(region_nodes(t))


def all_edges(t):
    lives = graph.edges_from(t.customer, "concat('c', c_custkey)", "concat('n', c_nationkey)", "LIVES_IN")
    inside = graph.edges_from(t.nation, "concat('n', n_nationkey)", "concat('r', n_regionkey)", "PART_OF", {"since": "1900 + n_nationkey"})
    return lives.unionByName(inside)


NODES = """n AS (SELECT 'c' || c_custkey AS id, 'Customer' AS labels, c_name AS name, CASE WHEN c_custkey % 5 = 0 THEN 1 ELSE 2 END AS props, 1 AS label_count FROM customer
  UNION ALL SELECT 'n' || n_nationkey, 'Nation,Place', n_name, 1, 2 FROM nation UNION ALL SELECT 'r' || r_regionkey, 'Region,Place', r_name, 1, 2 FROM region),
  e AS (SELECT 'c' || c_custkey AS src, 'n' || c_nationkey AS dst, 'LIVES_IN' AS type, 0 AS props FROM customer UNION ALL SELECT 'n' || n_nationkey, 'r' || n_regionkey, 'PART_OF', 1 FROM nation)"""


@plan("graph_nodes", f"WITH {NODES} SELECT id, labels, name, CAST(props AS INTEGER) AS props FROM n")
def graph_nodes(t):
    return all_nodes(t).select("id", F.array_join("labels", ",").alias("labels"), F.element_at("props", "name").alias("name"), F.size("props").alias("props"))


@plan("graph_edges", f"WITH {NODES} SELECT src, dst, type, CAST(props AS INTEGER) AS props FROM e")
def graph_edges(t):
    return all_edges(t).select("src", "dst", "type", F.size("props").alias("props"))


@plan("graph_match", f"""WITH {NODES} SELECT a.name AS customer, e.type AS type, b.name AS nation FROM n a JOIN e ON e.src = a.id AND e.type = 'LIVES_IN' JOIN n b ON b.id = e.dst""")
def graph_match(t):
    path = graph.match_path(all_nodes(t), all_edges(t), "Customer", [("LIVES_IN", "Nation")])
    return path.select(F.element_at("props0", "name").alias("customer"), F.col("type1").alias("type"), F.element_at("props1", "name").alias("nation"))


@plan("graph_match_2hop", """SELECT c_name AS customer, n_name AS nation, r_name AS region FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""")
def graph_match_2hop(t):
    path = graph.match_path(all_nodes(t), all_edges(t), "Customer", [("LIVES_IN", "Nation"), ("PART_OF", "Region")])
    return path.select(*[F.element_at(f"props{i}", "name").alias(n) for i, n in enumerate(["customer", "nation", "region"])])


@plan("graph_counters", f"""WITH {NODES} SELECT (SELECT count(*) FROM n) AS "nodesCreated", (SELECT count(*) FROM e) AS "relationsCreated",
  CAST((SELECT sum(label_count) FROM n) AS BIGINT) AS "labelsAdded", CAST((SELECT sum(props) FROM n) + (SELECT sum(props) FROM e) AS BIGINT) AS "propertiesSet" """)
def graph_counters(t):
    return graph.graph_counters(all_nodes(t), all_edges(t))


@plan("graph_merge", """
  SELECT 'c' || c_custkey AS id, CASE WHEN c_custkey IN (SELECT user_id FROM events) THEN 'Customer,Active' ELSE 'Customer' END AS labels, c_name AS name,
    CAST((SELECT max(value) FROM events WHERE user_id = c_custkey) AS DOUBLE) AS top FROM customer
  UNION ALL SELECT 'c' || user_id, 'Active', NULL, max(value) FROM events WHERE user_id NOT IN (SELECT c_custkey FROM customer) GROUP BY user_id""")
def graph_merge(t):
    active = graph.nodes_from(t.events.groupBy("user_id").agg(F.max("value").alias("top")), "concat('c', user_id)", ["Active"], {"top": "top"})
    merged = graph.merge_nodes(customer_nodes(t), active)
    return merged.select("id", F.array_join("labels", ",").alias("labels"), F.try_element_at("props", F.lit("name")).alias("name"),
                         F.try_element_at("props", F.lit("top")).cast("double").alias("top"))


@plan("graph_delete", f"""WITH {NODES}, g AS (SELECT 'n' || n_nationkey AS id FROM nation WHERE n_regionkey = 1)
  SELECT 'node' AS kind, count(*) AS rows FROM n WHERE id NOT IN (SELECT id FROM g) UNION ALL
  SELECT 'edge', count(*) FROM e WHERE src NOT IN (SELECT id FROM g) AND dst NOT IN (SELECT id FROM g)""")
def graph_delete(t):
    gone = t.nation.filter("n_regionkey = 1").select(F.expr("concat('n', n_nationkey)").alias("id"))
    nodes, edges = graph.delete_nodes(all_nodes(t), all_edges(t), gone)
    counts = [df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(kind).alias("kind"), "rows") for kind, df in (("node", nodes), ("edge", edges))]
    return counts[0].unionByName(counts[1])


@plan("graph_delete_counters", f"""WITH {NODES}, g AS (SELECT 'n' || n_nationkey AS id FROM nation WHERE n_regionkey = 1)
  SELECT (SELECT count(*) FROM n WHERE id IN (SELECT id FROM g)) AS "nodesDeleted",
    (SELECT count(*) FROM e WHERE src IN (SELECT id FROM g) OR dst IN (SELECT id FROM g)) AS "relationsDeleted" """)
def graph_delete_counters(t):
    gone = t.nation.filter("n_regionkey = 1").select(F.expr("concat('n', n_nationkey)").alias("id"))
    nodes, edges = all_nodes(t), all_edges(t)
    return graph.delete_counters(nodes, edges, *graph.delete_nodes(nodes, edges, gone))
