"""Scalar functions over whole table columns."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions import analyse, booleans, dates, numbers, strings
from millrace.plans.registry import plan

# The order date rendered in one of 18 layouts (two of them unreadable), by order key
TEXT_OF_DATE = """
    CASE o_orderkey % 18
      WHEN 0 THEN strftime(d, '%Y%m%d') WHEN 1 THEN strftime(d, '%Y-%m-%d') WHEN 2 THEN strftime(d, '%Y-%m-%dT')
      WHEN 3 THEN strftime(d, '%Y/%m/%d') WHEN 4 THEN strftime(d, '%Y年%m月%d日')
      WHEN 5 THEN strftime(d, '%y年%m月%d日') WHEN 6 THEN strftime(d, '%Y%m%d%H%M%S')
      WHEN 7 THEN strftime(d, '%Y-%m-%d %H:%M:%S') WHEN 8 THEN strftime(d, '%Y-%m-%dT%H:%M:%SZ')
      WHEN 9 THEN strftime(d, '%Y%m%dT%H%M%SZ') WHEN 10 THEN strftime(d, '%Y%m%dT%H%M%S')
      WHEN 11 THEN strftime(d, '%Y-%m-%dT%H:%M:%S') WHEN 12 THEN strftime(d, '%Y-%m-%dT%H:%M:%S.000Z')
      WHEN 13 THEN strftime(d, '%Y%m%d%H%M') WHEN 14 THEN strftime(d, '%Y%m')
      WHEN 15 THEN strftime(d, '%Y-%-m-%-d') WHEN 16 THEN strftime(d, '%Y-02-30') ELSE '  ' END"""
TEXTS = f"""
  WITH stamped AS (SELECT o_orderkey, o_orderdate + to_seconds(o_orderkey % 86400) AS d FROM orders),
  texts AS (SELECT o_orderkey, d, {TEXT_OF_DATE} AS s FROM stamped)"""
SECOND = "strftime({0}, '%Y-%m-%d %H:%M:%S')"


def stamped_orders(t):
    return t.orders.select("o_orderkey", (F.col("o_orderdate") + F.make_dt_interval(
        secs=(F.col("o_orderkey") % 86400).cast("decimal(18,6)"))).alias("d"))


def order_texts(t):
    patterns = ["yyyyMMdd", "yyyy-MM-dd", "yyyy-MM-dd'T'", "yyyy/MM/dd", "yyyy'年'MM'月'dd'日'", "yy'年'MM'月'dd'日'",
                "yyyyMMddHHmmss", "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss'Z'", "yyyyMMdd'T'HHmmss'Z'",
                "yyyyMMdd'T'HHmmss", "yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'", "yyyyMMddHHmm", "yyyyMM",
                "yyyy-M-d", "yyyy-'02-30'"]
    layout = F.col("o_orderkey") % 18
    text = F.lit("  ")
    for i, pattern in enumerate(patterns):
        text = F.when(layout == i, F.date_format("d", pattern)).otherwise(text)
    return stamped_orders(t).withColumn("s", text)


def in_seconds(column):
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss")


ALL_FORMATS = """['%Y%m%d', '%Y-%m-%d', '%Y-%m-%dT', '%Y/%m/%d', '%Y年%m月%d日', '%y年%m月%d日', '%Y%m%d%H%M%S',
  '%Y-%m-%d %H:%M:%S', '%Y-%m-%dT%H:%M:%SZ', '%Y%m%dT%H%M%SZ', '%Y%m%dT%H%M%S', '%Y-%m-%dT%H:%M:%S',
  '%Y-%m-%dT%H:%M:%S.%gZ', '%Y%m%d%H%M', '%Y%m']"""


def _when_layout(allowed: list[int], value: str = "") -> str:
    """What a reader limited to some layouts gives: the stamp at the precision the layout keeps."""
    return f"""CASE WHEN o_orderkey % 18 NOT IN ({', '.join(map(str, allowed))}) THEN NULL
      WHEN o_orderkey % 18 IN (0, 1, 2, 3, 4, 5, 15) THEN {SECOND.format("date_trunc('day', d)")}
      WHEN o_orderkey % 18 = 13 THEN {SECOND.format("date_trunc('minute', d)")}
      WHEN o_orderkey % 18 = 14 THEN {SECOND.format("date_trunc('month', d)")} ELSE {SECOND.format('d')} END"""


@plan("date_from_text", f"""{TEXTS}
  SELECT o_orderkey, s, {_when_layout(list(range(16)))} AS parsed,
         coalesce({_when_layout(list(range(16)))}, '1800-01-01 00:00:00') AS parsed_or_default,
         strftime(CAST({_when_layout(list(range(16)))} AS TIMESTAMP), '%Y-%m-%d') AS sql_date FROM texts""")
def date_from_text(t):
    s = F.col("s")
    return order_texts(t).select(
        "o_orderkey", "s", in_seconds(dates.from_text(s)).alias("parsed"),
        in_seconds(dates.from_text(s, F.lit("1800-01-01").cast("timestamp"))).alias("parsed_or_default"),
        F.date_format(dates.to_sql_date(s), "yyyy-MM-dd").alias("sql_date"))


@plan("date_from_date_text", f"""{TEXTS}
  SELECT o_orderkey, {_when_layout([0, 1, 2, 3, 4, 5, 15])} AS parsed FROM texts""")
def date_from_date_text(t):
    return order_texts(t).select("o_orderkey", in_seconds(dates.from_date_text(F.col("s"))).alias("parsed"))


@plan("date_from_time_text", f"""{TEXTS}
  SELECT o_orderkey, {_when_layout([6, 7, 8, 9, 10, 11, 13, 14])} AS parsed FROM texts""")
def date_from_time_text(t):
    return order_texts(t).select("o_orderkey", in_seconds(dates.from_time_text(F.col("s"))).alias("parsed"))


@plan("date_from_utc", f"""{TEXTS}
  SELECT o_orderkey, {_when_layout([8, 9, 10, 11, 12])} AS parsed FROM texts""")
def date_from_utc(t):
    return order_texts(t).select("o_orderkey", in_seconds(dates.from_utc(F.col("s"))).alias("parsed"))


# A stamp that is missing for every seventh order, to exercise the defaults
GAPPED = """WITH g AS (SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN NULL
    ELSE o_orderdate + to_seconds(o_orderkey % 86400) END AS d, strftime(o_orderdate, '%Y/%m/%d') AS s FROM orders)"""


def gapped_texts(t):
    return t.orders.select("o_orderkey", F.when(F.col("o_orderkey") % 7 != 0, F.col("o_orderdate") + F.make_dt_interval(
        secs=(F.col("o_orderkey") % 86400).cast("decimal(18,6)"))).alias("d"),
        F.date_format("o_orderdate", "yyyy/MM/dd").alias("s"))


@plan("date_std", f"""{GAPPED}
  SELECT o_orderkey, coalesce(strftime(d, '%Y-%m-%d'), '') AS std_date, coalesce(strftime(d, '%Y-%m-%d'), 'n/a') AS std_date_or,
    coalesce(strftime(d, '%Y-%m-%d %H:%M:%S'), '') AS std_time, coalesce(strftime(d, '%Y-%m-%d %H:%M:%S'), 'n/a') AS std_time_or,
    replace(s, '/', '-') AS text_date, replace(s, '/', '-') || ' 00:00:00' AS text_time FROM g""")
def date_std(t):
    d, s = F.col("d"), F.col("s")
    return gapped_texts(t).select(
        "o_orderkey", dates.to_std_date(d).alias("std_date"), dates.to_std_date(d, "n/a").alias("std_date_or"),
        dates.to_std_time(d).alias("std_time"), dates.to_std_time(d, "n/a").alias("std_time_or"),
        dates.from_text_then(dates.to_std_date, s).alias("text_date"),
        dates.from_text_then(dates.to_std_time, s).alias("text_time"))


@plan("date_digital", f"""{GAPPED}
  SELECT o_orderkey, coalesce(strftime(d, '%Y%m%d'), '') AS digital_date, coalesce(strftime(d, '%Y%m'), '') AS digital_month,
    coalesce(strftime(d, '%Y'), '') AS digital_year, coalesce(strftime(d, '%Y%m%d%H%M%S'), '19000101000000') AS digital_time,
    replace(s, '/', '') AS text_date, left(replace(s, '/', ''), 6) AS text_month, left(s, 4) AS text_year FROM g""")
def date_digital(t):
    d, s = F.col("d"), F.col("s")
    return gapped_texts(t).select(
        "o_orderkey", dates.to_digital_date(d).alias("digital_date"), dates.to_digital_month(d).alias("digital_month"),
        dates.to_digital_year(d).alias("digital_year"), dates.to_digital_time(d, "19000101000000").alias("digital_time"),
        dates.from_text_then(dates.to_digital_date, s).alias("text_date"),
        dates.from_text_then(dates.to_digital_month, s).alias("text_month"),
        dates.from_text_then(dates.to_digital_year, s).alias("text_year"))


@plan("date_week", """
  WITH w AS (SELECT l_orderkey, l_linenumber, l_shipdate AS d, CAST(l_shipdate AS DATE) + CAST(6 - dayofweek(l_shipdate) AS INTEGER) AS sat,
      date_trunc('year', l_shipdate) AS jan FROM lineitem)
  SELECT l_orderkey, l_linenumber, strftime(d, '%Y') || CASE WHEN year(sat) > year(d) THEN '01'
    ELSE lpad(CAST((dayofyear(d) - 1 + dayofweek(jan)) // 7 + 1 AS VARCHAR), 2, '0') END AS week FROM w""")
def date_week(t):
    return t.lineitem.select("l_orderkey", "l_linenumber", dates.to_digital_week(F.col("l_shipdate")).alias("week"))


@plan("date_utc_text", f"""{GAPPED}
  SELECT o_orderkey, coalesce(strftime(d, '%Y-%m-%dT'), '') AS utc_date,
    coalesce(strftime(d, '%Y-%m-%dT%H:%M:%SZ'), 'none') AS utc_time FROM g""")
def date_utc_text(t):
    return gapped_texts(t).select("o_orderkey", dates.to_utc_date(F.col("d")).alias("utc_date"),
                                  dates.to_utc_time(F.col("d"), "none").alias("utc_time"))


@plan("date_cn", f"""{GAPPED}
  SELECT o_orderkey, coalesce(strftime(d, '%Y年%m月%d日'), '') AS cn_date,
    substr(s, 1, 4) || '年' || substr(s, 6, 2) || '月' || substr(s, 9, 2) || '日' AS cn_text FROM g""")
def date_cn(t):
    return gapped_texts(t).select("o_orderkey", dates.to_cn_date(F.col("d")).alias("cn_date"),
                                  dates.from_text_then(dates.to_cn_date, F.col("s")).alias("cn_text"))


@plan("date_epoch", """
  SELECT event_id, CASE WHEN event_id % 7 = 0 THEN 0 ELSE epoch_us(ts) // 1000 END AS epoch_value,
    CASE WHEN event_id % 7 = 0 THEN '0' ELSE CAST(epoch_us(ts) // 1000 AS VARCHAR) END AS epoch_text FROM events""")
def date_epoch(t):
    ts = F.when(F.col("event_id") % 7 != 0, F.col("ts"))
    return t.events.select("event_id", dates.to_value(ts).alias("epoch_value"), dates.to_timestamp_text(ts).alias("epoch_text"))


@plan("date_age", f"""{GAPPED}
  SELECT o_orderkey, CASE WHEN d IS NULL THEN '-1' ELSE
      CAST(2024 - year(d) - CAST(strftime(d, '%m%d%H%M%S') > '0201120000' AS INTEGER) AS VARCHAR) END AS age_now,
    CASE WHEN TIMESTAMP '2000-02-28' < CAST(replace(s, '/', '-') AS TIMESTAMP) THEN '-1' ELSE
      CAST(2000 - year(CAST(replace(s, '/', '-') AS DATE)) - CAST(replace(substr(s, 6), '/', '') > '0228' AS INTEGER) AS VARCHAR)
    END AS age_text FROM g""")
def date_age(t):
    now = F.lit("2024-02-01 12:00:00").cast("timestamp")
    return gapped_texts(t).select("o_orderkey", dates.age(F.col("d"), now).alias("age_now"),
                                  dates.age_from_text(F.col("s"), F.lit("2000-02-28")).alias("age_text"))


@plan("date_shift", """
  SELECT event_id, strftime(ts - INTERVAL 10 DAY, '%Y-%m-%d %H:%M:%S') AS before_days,
    strftime(ts - INTERVAL 1 MONTH, '%Y-%m-%d %H:%M:%S') AS before_month, strftime(ts - INTERVAL 2 YEAR, '%Y-%m-%d %H:%M:%S') AS before_years,
    strftime(ts + INTERVAL 1 DAY, '%Y-%m-%d %H:%M:%S') AS after_day, strftime(ts + INTERVAL 13 MONTH, '%Y-%m-%d %H:%M:%S') AS after_months,
    strftime(ts + INTERVAL 1 YEAR, '%Y-%m-%d %H:%M:%S') AS after_year FROM events""")
def date_shift(t):
    ts = F.col("ts")
    shifted = {"before_days": dates.before(ts, "10"), "before_month": dates.before(ts, "1m"),
               "before_years": dates.before(ts, "2Y"), "after_day": dates.after(ts, "1D"),
               "after_months": dates.after(ts, "13M"), "after_year": dates.after(ts, "1y")}
    return t.events.select("event_id", *[in_seconds(c).alias(n) for n, c in shifted.items()])


# Text with blanks, gaps and mixed case, from the part names
PART_TEXT = """WITH p AS (SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN NULL WHEN 1 THEN '   ' WHEN 2 THEN '  ' || p_name || ' '
    WHEN 3 THEN upper(left(p_name, 3)) || substr(p_name, 4) ELSE p_name END AS s, p_name AS n FROM part)"""


def part_texts(t):
    k, n = F.col("p_partkey") % 5, F.col("p_name")
    text = F.when(k == 1, "   ").when(k == 2, F.concat(F.lit("  "), n, F.lit(" "))) \
        .when(k == 3, F.concat(F.upper(F.substring(n, 1, 3)), F.substring(n, 4, 1000))).when(k == 4, n)
    return t.part.select("p_partkey", text.alias("s"), n.alias("n"))


@plan("str_misc", """
  SELECT event_id, CASE WHEN event_id % 5 = 0 THEN '' ELSE CAST(user_id AS VARCHAR) END AS as_text FROM events""")
def str_misc(t):
    return t.events.select("event_id", strings.to_text(F.when(F.col("event_id") % 5 != 0, F.col("user_id"))).alias("as_text"))


@plan("str_json", """
  SELECT p_partkey, '{"partKey":' || p_partkey || ',"name":"' || p_name || '","size":' || p_size || '}' AS json FROM part""")
def str_json(t):
    row = F.struct(F.col("p_partkey").alias("partKey"), F.col("p_name").alias("name"), F.col("p_size").alias("size"))
    return t.part.select("p_partkey", strings.to_json(row).alias("json"))


@plan("str_joint", """
  SELECT p_partkey, chr(10) || 'name' || p_name || chr(10) || 'tags' || p_brand || p_type || chr(10) || 'more' || chr(10) || 'size' || p_size
    || chr(10) || 'gap' || 'null' AS joined FROM part""")
def str_joint(t):
    row = F.struct(F.col("p_name").alias("name"), F.array("p_brand", "p_type").alias("tags"), F.create_map(
        F.lit("size"), F.col("p_size").cast("string"), F.lit("gap"), F.lit(None).cast("string")).alias("more"))
    kind = T.StructType([T.StructField("name", T.StringType()), T.StructField("tags", T.ArrayType(T.StringType())),
                         T.StructField("more", T.MapType(T.StringType(), T.StringType()))])
    return t.part.select("p_partkey", strings.joint_text(row, kind).alias("joined"))


@plan("str_camel", r"""
  WITH p AS (SELECT p_partkey, list_reduce(list_transform(string_split(p_name, ' '), lambda w: upper(w[1]) || w[2:]), lambda a, b: a || b) AS pascal,
      replace(p_name, ' ', '_') || CASE p_partkey % 3 WHEN 0 THEN '_1' WHEN 1 THEN '' ELSE '_Xy' END AS snake FROM part)
  SELECT p_partkey, lower(regexp_replace(pascal, '([a-z])([A-Z])', '\1_\2', 'g')) AS underscored,
    lower(left(pascal, 1)) || substr(regexp_replace(pascal, '([a-z])([A-Z])', '\1_\2', 'g'), 2) AS underscored_first,
    list_reduce(list_transform(string_split(replace(lower(snake), '_1', '#1'), '_'), lambda w, i: CASE WHEN i = 1 THEN w ELSE upper(w[1]) || w[2:] END),
      lambda a, b: a || b).replace('#1', '_1') AS camel FROM p""")
def str_camel(t):
    k = F.col("p_partkey") % 3
    words = F.transform(F.split("p_name", " "), strings.capitalize)
    df = t.part.select("p_partkey", F.array_join(words, "").alias("pascal"), F.concat(
        F.replace(F.col("p_name"), F.lit(" "), F.lit("_")), F.when(k == 0, "_1").when(k == 1, "").otherwise("_Xy")).alias("snake"))
    return df.select("p_partkey", strings.camel_to_underscore(F.col("pascal")).alias("underscored"),
                     strings.camel_to_underscore_first(F.col("pascal")).alias("underscored_first"),
                     strings.underscore_to_camel(F.col("snake")).alias("camel"))


@plan("str_blank", f"""{PART_TEXT}
  SELECT p_partkey, coalesce(trim(s), '') = '' AS is_blank, coalesce(s, '') = '' AS is_empty, coalesce(trim(s), '') <> '' AS not_blank,
    coalesce(nullif(trim(s), '') IS NOT NULL AND TRUE, FALSE) AS has_text, CASE WHEN coalesce(trim(s), '') = '' THEN 'none' ELSE s END AS or_default,
    coalesce(s, '') AS default_string FROM p""")
def str_blank(t):
    s = F.col("s")
    return part_texts(t).select(
        "p_partkey", strings.is_blank(s).alias("is_blank"), strings.is_empty(s).alias("is_empty"),
        strings.is_not_blank(s).alias("not_blank"), strings.is_not_blank(s).alias("has_text"),
        strings.default_if_blank(s, "none").alias("or_default"), strings.default_text(s).alias("default_string"))


@plan("str_case", f"""{PART_TEXT}
  SELECT p_partkey, trim(s) AS trimmed, trim(s) AS stripped, upper(s) AS up, lower(s) AS low, upper(left(n, 1)) || substr(n, 2) AS cap,
    lower(left(s, 1)) || substr(s, 2) AS uncap, CASE WHEN s IS NULL THEN NULL ELSE array_to_string(list_transform(string_split(s, ''),
      lambda c: CASE WHEN c = upper(c) THEN lower(c) ELSE upper(c) END), '') END AS swapped, reverse(s) AS reversed FROM p""")
def str_case(t):
    s, n = F.col("s"), F.col("n")
    return part_texts(t).select(
        "p_partkey", strings.trim(s).alias("trimmed"), strings.strip(s).alias("stripped"), strings.upper_case(s).alias("up"),
        strings.lower_case(s).alias("low"), strings.capitalize(n).alias("cap"), strings.uncapitalize(s).alias("uncap"),
        strings.swap_case(s).alias("swapped"), strings.reverse(s).alias("reversed"))


@plan("str_sub", """
  SELECT c_custkey, substr(c_name, 10) AS tail, substr(c_name, 3, 4) AS part, right(c_name, 3) AS from_end, left(c_name, 4) AS l4,
    right(c_name, 4) AS r4, substr(c_name, 6, 5) AS mid5, '' AS beyond, split_part(c_name, '#', 1) AS before_hash,
    split_part(c_name, '#', 2) AS after_hash, c_name AS before_none, '' AS after_none,
    regexp_extract(c_name, '^(.*)0[^0]*$', 1) AS before_last, regexp_extract(c_name, '0([^0]*)$', 1) AS after_last,
    CASE WHEN c_mktsegment LIKE '%H%E%' THEN regexp_extract(c_mktsegment, 'H(.*?)E', 1) END AS between FROM customer""")
def str_sub(t):
    n = F.col("c_name")
    return t.customer.select(
        "c_custkey", strings.substring(n, 9).alias("tail"), strings.substring(n, 2, 6).alias("part"),
        strings.substring(n, -3).alias("from_end"), strings.left(n, 4).alias("l4"), strings.right(n, 4).alias("r4"),
        strings.mid(n, 5, 5).alias("mid5"), strings.substring(n, 90, 95).alias("beyond"),
        strings.substring_before(n, "#").alias("before_hash"), strings.substring_after(n, "#").alias("after_hash"),
        strings.substring_before(n, "@").alias("before_none"), strings.substring_after(n, "@").alias("after_none"),
        strings.substring_before_last(n, "0").alias("before_last"), strings.substring_after_last(n, "0").alias("after_last"),
        strings.substring_between(F.col("c_mktsegment"), "H", "E").alias("between"))


@plan("str_replace", """
  SELECT p_partkey, replace(p_name, 'e', 'EE') AS replaced, replace(p_name, 'a', '') AS removed, regexp_replace(p_name, '\\s+', '', 'g') AS packed,
    regexp_replace(p_name, '[aeiou]+', '*', 'g') AS pattern, left(p_name, 2) || '--' || substr(p_name, 5) AS overlaid,
    repeat(p_brand, 2) AS repeated FROM part""")
def str_replace(t):
    n = F.col("p_name")
    return t.part.select(
        "p_partkey", strings.replace(n, "e", "EE").alias("replaced"), strings.remove(n, "a").alias("removed"),
        strings.delete_whitespace(n).alias("packed"), strings.replace_pattern(n, "[aeiou]+", "*").alias("pattern"),
        strings.overlay(n, "--", 2, 4).alias("overlaid"), strings.repeat(F.col("p_brand"), 2).alias("repeated"))


@plan("str_test", f"""{PART_TEXT}
  SELECT p_partkey, coalesce(contains(s, 'in'), FALSE) AS has, coalesce(starts_with(s, 'red'), FALSE) AS starts,
    coalesce(ends_with(s, 'g'), FALSE) AS ends, CAST(coalesce(strpos(s, 'e'), 0) - 1 AS INTEGER) AS at,
    CAST(coalesce(len(s) - len(replace(s, 'e', '')), 0) AS INTEGER) AS hits, s IS NOT DISTINCT FROM n AS same,
    lower(s) IS NOT DISTINCT FROM lower(n) AS same_any_case FROM p""")
def str_test(t):
    s, n = F.col("s"), F.col("n")
    return part_texts(t).select(
        "p_partkey", strings.contains(s, "in").alias("has"), strings.starts_with(s, "red").alias("starts"),
        strings.ends_with(s, "g").alias("ends"), strings.index_of(s, "e").alias("at"), strings.count_matches(s, "e").alias("hits"),
        strings.equal(s, n).alias("same"), strings.equal_ignore_case(s, n).alias("same_any_case"))


@plan("str_pad", """
  SELECT p_partkey, CAST(len(list_filter(string_split_regex(p_name, '[ a]'), lambda x: x <> '')) AS INTEGER) AS pieces,
    array_to_string(list_filter(string_split_regex(p_name, '[ a]'), lambda x: x <> ''), '|') AS joined,
    CASE WHEN len(p_name) >= 11 THEN p_name ELSE lpad(p_name, 11, '*') END AS left_padded,
    CASE WHEN len(p_name) >= 11 THEN p_name ELSE rpad(p_name, 11, '*') END AS right_padded,
    CASE WHEN len(p_name) >= 14 THEN p_name ELSE rpad(lpad(p_name, CAST(len(p_name) + (14 - len(p_name)) // 2 AS INTEGER), '-'), 14, '-') END AS centered,
    CASE WHEN len(p_name) <= 9 THEN p_name ELSE left(p_name, 6) || '...' END AS short,
    regexp_full_match(CAST(p_size AS VARCHAR), '[0-9]+') AS numeric_size, regexp_full_match(p_name, '[a-z]+') AS alpha_name FROM part""")
def str_pad(t):
    n = F.col("p_name")
    return t.part.select(
        "p_partkey", F.size(strings.split(n, " a")).alias("pieces"), strings.join(strings.split(n, " a"), "|").alias("joined"),
        strings.left_pad(n, 11, "*").alias("left_padded"), strings.right_pad(n, 11, "*").alias("right_padded"),
        strings.center(n, 14, "-").alias("centered"), strings.abbreviate(n, 9).alias("short"),
        strings.is_numeric(F.col("p_size").cast("string")).alias("numeric_size"), strings.is_alpha(n).alias("alpha_name"))


@plan("num_format", """
  WITH o AS (SELECT o_orderkey, CAST(floor(o_totalprice) AS BIGINT) AS whole FROM orders)
  SELECT o_orderkey, format('{:,}', whole) AS grouped, CAST(whole AS VARCHAR) || '.25' AS two,
    CAST(whole AS VARCHAR) || CASE WHEN whole % 2 = 0 THEN '.2' ELSE '.8' END AS half_even FROM o""")
def num_format(t):
    whole = F.floor("o_totalprice")
    half = whole + F.when(whole % 2 == 0, 0.25).otherwise(0.75)
    return t.orders.select("o_orderkey", numbers.double_format(whole.cast("double"), "#,###.##").alias("grouped"),
                           numbers.double_format(whole + F.lit(0.25), "0.00").alias("two"),
                           numbers.double_format(half, "0.0").alias("half_even"))


NUMBER_TEXT = """WITH n AS (SELECT l_orderkey, l_linenumber, CASE (l_orderkey + l_linenumber) % 6 WHEN 0 THEN NULL WHEN 1 THEN ' ' || l_partkey
    WHEN 2 THEN CAST(l_partkey AS VARCHAR) WHEN 3 THEN '-' || l_partkey || '.5' WHEN 4 THEN 'x' || l_partkey ELSE '9' || lpad(CAST(l_partkey AS VARCHAR), 12, '0') END AS s
    FROM lineitem)"""


def number_texts(t):
    p, k = F.col("l_partkey").cast("string"), (F.col("l_orderkey") + F.col("l_linenumber")) % 6
    text = F.when(k == 1, F.concat(F.lit(" "), p)).when(k == 2, p).when(k == 3, F.concat(F.lit("-"), p, F.lit(".5"))) \
        .when(k == 4, F.concat(F.lit("x"), p)).when(k == 5, F.concat(F.lit("9"), F.lpad(p, 12, "0")))
    return t.lineitem.select("l_orderkey", "l_linenumber", text.alias("s"))


@plan("num_parse", f"""{NUMBER_TEXT}
  SELECT l_orderkey, l_linenumber, coalesce(CASE WHEN regexp_full_match(s, '[+-]?\\d+') THEN TRY_CAST(s AS INTEGER) END, 0) AS i,
    coalesce(CASE WHEN regexp_full_match(s, '[+-]?\\d+') THEN TRY_CAST(s AS BIGINT) END, CAST(-1 AS BIGINT)) AS l,
    coalesce(CASE WHEN regexp_full_match(trim(s), '[+-]?\\d+(\\.\\d+)?') THEN TRY_CAST(trim(s) AS DOUBLE) END, CAST(0.5 AS DOUBLE)) AS d FROM n""")
def num_parse(t):
    s = F.col("s")
    return number_texts(t).select("l_orderkey", "l_linenumber", numbers.to_int(s).alias("i"), numbers.to_long(s, -1).alias("l"),
                                  numbers.to_double(s, 0.5).alias("d"))


@plan("num_test", f"""{NUMBER_TEXT}
  SELECT l_orderkey, l_linenumber, coalesce(regexp_full_match(s, '[+-]?\\d+(\\.\\d+)?'), FALSE) AS is_number,
    coalesce(regexp_full_match(s, '\\d+'), FALSE) AS is_digits,
    CAST(CASE WHEN regexp_full_match(s, '[+-]?\\d+(\\.\\d+)?') THEN TRY_CAST(s AS DECIMAL(38,2)) END AS VARCHAR) AS dec,
    greatest(CAST(l_orderkey AS DOUBLE), l_linenumber * 1000.0::DOUBLE) AS hi, least(CAST(l_orderkey AS DOUBLE), l_linenumber * 1000.0::DOUBLE) AS lo,
    CAST(CASE WHEN l_orderkey < l_linenumber THEN -1 WHEN l_orderkey > l_linenumber THEN 1 ELSE 0 END AS INTEGER) AS cmp FROM n""")
def num_test(t):
    s, key, line = F.col("s"), F.col("l_orderkey").cast("double"), F.col("l_linenumber") * F.lit(1000.0)
    return number_texts(t).select(
        "l_orderkey", "l_linenumber", numbers.is_number(s).alias("is_number"), numbers.is_digits(s).alias("is_digits"),
        numbers.create_decimal(s, 38, 2).cast("string").alias("dec"), numbers.largest(key, line).alias("hi"),
        numbers.smallest(key, line).alias("lo"), numbers.compare(F.col("l_orderkey"), F.col("l_linenumber").cast("bigint")).alias("cmp"))


@plan("bool_misc", """
  WITH b AS (SELECT event_id, CASE event_id % 6 WHEN 0 THEN 'Yes' WHEN 1 THEN 'off' WHEN 2 THEN NULL WHEN 3 THEN 'T' WHEN 4 THEN event_type ELSE 'TRUE' END AS s,
      CASE WHEN event_id % 4 = 0 THEN NULL ELSE value > 10 END AS f, user_id % 2 = 0 AS g FROM events)
  SELECT event_id, coalesce(lower(s) IN ('true', 'on', 'yes', 't', 'y'), FALSE) AS parsed,
    CASE WHEN lower(s) IN ('true', 'on', 'yes', 't', 'y') THEN TRUE WHEN lower(s) IN ('false', 'off', 'no', 'f', 'n') THEN FALSE END AS parsed_object,
    CASE WHEN f THEN 1 ELSE 0 END AS as_int, CASE WHEN f THEN 'yes' WHEN NOT f THEN 'no' END AS yes_no,
    CASE WHEN f THEN 'on' WHEN NOT f THEN 'off' END AS on_off, CASE WHEN f THEN 'true' WHEN NOT f THEN 'false' END AS true_false,
    NOT f AS negated, f AND g AS both, f OR g AS either, f <> g AS one_only, coalesce(f, FALSE) AS is_true,
    NOT coalesce(f, FALSE) AS not_true, coalesce(NOT f, FALSE) AS is_false FROM b""")
def bool_misc(t):
    k = F.col("event_id") % 6
    text = F.when(k == 0, "Yes").when(k == 1, "off").when(k == 3, "T").when(k == 4, F.col("event_type")).when(k == 5, "TRUE")
    df = t.events.select("event_id", text.alias("s"), F.when(F.col("event_id") % 4 != 0, F.col("value") > 10).alias("f"),
                         (F.col("user_id") % 2 == 0).alias("g"))
    s, f, g = F.col("s"), F.col("f"), F.col("g")
    return df.select(
        "event_id", booleans.to_boolean(s).alias("parsed"), booleans.to_boolean_object(s).alias("parsed_object"),
        booleans.to_integer(f).alias("as_int"), booleans.to_yes_no(f).alias("yes_no"), booleans.to_on_off(f).alias("on_off"),
        booleans.to_true_false(f).alias("true_false"), booleans.negate(f).alias("negated"), booleans.all_of(f, g).alias("both"),
        booleans.any_of(f, g).alias("either"), booleans.one_of(f, g).alias("one_only"), booleans.is_true(f).alias("is_true"),
        booleans.is_not_true(f).alias("not_true"), booleans.is_false(f).alias("is_false"))


@plan("noise_max", """
  WITH m AS (SELECT l_orderkey, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) // count(*) AS mean FROM lineitem GROUP BY 1)
  SELECT l_orderkey, CAST(greatest(coalesce(max(CASE WHEN (l_quantity - mean) * (l_quantity - mean) <= 100 THEN l_quantity END), 0), 0) AS INTEGER) AS noise_max
  FROM lineitem JOIN m USING (l_orderkey) GROUP BY 1""")
def noise_max(t):
    whole = t.lineitem.select("l_orderkey", F.col("l_quantity").cast("int").alias("l_quantity"))
    return analyse.max_without_noise_by(whole, ["l_orderkey"], "l_quantity", 100)


@plan("noise_max_list", """
  WITH e AS (SELECT event_id, [CAST(user_id AS INTEGER), CAST(floor(value) AS INTEGER), CAST(json_extract(props, '$.k') AS INTEGER)] AS xs FROM events)
  SELECT event_id, greatest(coalesce(list_max(list_filter(xs, lambda x: (x - list_sum(xs) // 3) * (x - list_sum(xs) // 3) <= 900)), 0), 0) AS noise_max FROM e""")
def noise_max_list(t):
    texts = F.array(F.col("user_id").cast("string"), F.lit("n/a"), F.floor("value").cast("string"),
                    F.get_json_object("props", "$.k"), F.lit(None).cast("string"))
    return t.events.select("event_id", analyse.max_without_noise(texts, 900).alias("noise_max"))
