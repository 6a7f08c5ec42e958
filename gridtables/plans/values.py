"""Value clean-up and row quality: headings, dates, codes, money, nulls, duplicates, fills, pivots."""

from pyspark.sql import functions as F

from gridtables.functions import expr
from gridtables.operators import quality
from gridtables.operators.positional import carry, scan
from gridtables.plans.registry import query, table


def _heading_sql(c: str) -> str:
    body = f"regexp_replace(regexp_replace(trim({c}, E' \\t\\r\\n\\f\\v'), '\\[[0-9]+\\]$', ''), '[^$A-Za-z0-9_]+', '_', 'g')"
    name = f"lower(regexp_replace({body}, '^_+|_+$', '', 'g'))"
    return f"CASE WHEN regexp_matches({name}, '^[$0-9]') THEN '_' || {name} ELSE {name} END"


@query("normalise_heading", f"""
SELECT p_partkey, {_heading_sql("' ' || p_name || ' [' || p_size || ']'")} AS name, {_heading_sql("p_size || 'nd ' || p_brand")} AS brand,
  {_heading_sql("'$ ' || p_type || ' (net)'")} AS kind FROM part""")
def normalise_heading(spark, folder):
    part = table(spark, folder, "part")
    size = F.col("p_size").cast("string")
    return part.select(
        "p_partkey",
        expr.normalise_heading(F.concat(F.lit(" "), "p_name", F.lit(" ["), size, F.lit("]"))).alias("name"),
        expr.normalise_heading(F.concat(size, F.lit("nd "), "p_brand")).alias("brand"),
        expr.normalise_heading(F.concat(F.lit("$ "), "p_type", F.lit(" (net)"))).alias("kind"),
    )


@query("normalise_heading_text", f"SELECT doc_id, {_heading_sql('text')} AS name FROM documents")
def normalise_heading_text(spark, folder):
    return table(spark, folder, "documents").select("doc_id", expr.normalise_heading(F.col("text")).alias("name"))


@query("parse_mixed_dates", """
SELECT o_orderkey, raw, CAST(coalesce(try_strptime(raw, '%d/%m/%Y'), try_strptime(raw, '%Y/%m/%d')) AS TIMESTAMP) AS parsed,
  coalesce(try_strptime(raw, '%d/%m/%Y'), try_strptime(raw, '%Y/%m/%d')) IS NULL AND raw IS NOT NULL AS lost FROM (
  SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN strftime(o_orderdate, '%-d/%m/%Y') WHEN 'O' THEN strftime(o_orderdate, '%Y/%m/%d')
    ELSE CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE strftime(o_orderdate, '%Y-%m-%d') END END AS raw FROM orders)""")
def parse_mixed_dates(spark, folder):
    date, status = F.col("o_orderdate"), F.col("o_orderstatus")
    raw = (
        F.when(status == "F", F.date_format(date, "d/MM/yyyy")).when(status == "O", F.date_format(date, "yyyy/MM/dd"))
        .when(F.col("o_orderpriority") != "5-LOW", F.date_format(date, "yyyy-MM-dd"))
    )
    orders = table(spark, folder, "orders").select("o_orderkey", raw.alias("raw"))
    parsed = expr.mixed_date(F.col("raw"))
    return orders.select("*", parsed.cast("timestamp_ntz").alias("parsed"), expr.date_lost(F.col("raw"), parsed).alias("lost"))


@query("parse_compact_times", """
SELECT o_orderkey, raw, try_strptime(raw, '%Y%m%d%H%M') AS moment FROM (
  SELECT o_orderkey, strftime(o_orderdate, '%Y%m%d') || lpad(CAST(CAST(floor(o_totalprice / 100) AS BIGINT) AS VARCHAR), 4, '0') AS raw FROM orders)""")
def parse_compact_times(spark, folder):
    clock = F.lpad(F.floor(F.col("o_totalprice") / 100).cast("string"), 4, "0")
    orders = table(spark, folder, "orders").select(
        "o_orderkey", F.concat(F.date_format("o_orderdate", "yyyyMMdd"), clock).alias("raw"))
    return orders.withColumn("moment", expr.digits_to_timestamp(F.col("raw")))


@query("parse_fixed_dates", """
SELECT o_orderkey, CAST(o_orderdate AS TIMESTAMP) AS day, CAST(o_orderdate AS TIMESTAMP) + INTERVAL 10 HOUR AS made,
  try_strptime(substr(name, instr(name, '20'), 8), '%Y%m%d') AS named, CAST(o_orderdate AS TIMESTAMP) AS iso_named
FROM (SELECT *, 'Snapshot_' || strftime(o_orderdate, '%Y%m%d') || '.csv' AS name FROM orders)""")
def parse_fixed_dates(spark, folder):
    """Dates printed as text, in a file name or in a creation time are read back; a compact name date starts with 20."""
    date = F.col("o_orderdate")
    texts = table(spark, folder, "orders").select(
        "o_orderkey", F.date_format(date, "dd MMM yyyy").alias("text"), F.concat(F.date_format(date, "dd/MM/yyyy"), F.lit(" 10:00")).alias("time"),
        F.concat(F.lit("/in/Snapshot_"), F.date_format(date, "yyyyMMdd"), F.lit(".csv")).alias("path"),
        F.concat(F.lit("/in/2001-01-01/Rates "), F.date_format(date, "yyyy-MM-dd"), F.lit(".csv")).alias("iso"),
    )
    return texts.select(
        "o_orderkey", expr.parse_date(F.col("text"), "d MMM yyyy").cast("timestamp_ntz").alias("day"),
        expr.text_to_timestamp(F.col("time"), "d/M/yyyy H:m").alias("made"),
        expr.compact_filename_date(F.col("path")).cast("timestamp_ntz").alias("named"),
        expr.iso_filename_date(F.col("iso")).cast("timestamp_ntz").alias("iso_named"),
    )


@query("date_and_time", """
SELECT event_id, CASE WHEN event_type = 'error' THEN NULL ELSE date_trunc('second', ts) END AS date_time FROM events""")
def date_and_time(spark, folder):
    time = expr.time_separators(F.date_format("ts", "HH-mm-ss"))
    day = F.when(F.col("event_type") != "error", F.col("ts").cast("date"))
    return table(spark, folder, "events").select("event_id", expr.date_and_time(day, time).alias("date_time"))


@query("truncate_code", """
SELECT p_partkey, CASE WHEN length(p_brand) > 8 THEN p_brand ELSE substr(p_brand, 1, 7) END AS brand,
  CASE WHEN length(p_name) > 8 THEN p_name ELSE substr(p_name, 1, 7) END AS name,
  CASE WHEN length(p_type) > 8 THEN p_type ELSE substr(p_type, 1, 7) END AS kind FROM part""")
def truncate_code(spark, folder):
    named = {"brand": "p_brand", "name": "p_name", "kind": "p_type"}
    return table(spark, folder, "part").select("p_partkey", *[expr.truncate_code(F.col(c)).alias(n) for n, c in named.items()])


@query("parse_money", """
SELECT s_suppkey, CAST(try_cast(regexp_replace('$' || CAST(s_acctbal AS VARCHAR) || ' AUD', '[^0-9.]', '', 'g') AS DECIMAL(18, 4)) AS DOUBLE) AS amount,
  CAST(try_cast(regexp_replace(s_name, '[^0-9.]', '', 'g') AS DECIMAL(18, 4)) AS DOUBLE) AS digits FROM supplier""")
def parse_money(spark, folder):
    text = F.concat(F.lit("$"), F.col("s_acctbal").cast("string"), F.lit(" AUD"))
    return table(spark, folder, "supplier").select(
        "s_suppkey", expr.money(text).cast("double").alias("amount"), expr.money(F.col("s_name")).cast("double").alias("digits"))


@query("null_tokens", """
SELECT event_id, CASE WHEN event_type IN ('', 'error', 'view') THEN NULL ELSE event_type END AS event_type,
  CASE WHEN event_type = 'error' THEN NULL ELSE value END AS value,
  CASE WHEN event_type = 'click' THEN '0' ELSE event_type END AS dash FROM events""")
def null_tokens(spark, folder):
    kind = F.col("event_type")
    nan = F.when(kind == "error", F.lit(float("nan"))).otherwise(F.col("value"))
    return table(spark, folder, "events").select(
        "event_id", expr.null_tokens(kind, ("", "error", "view")).alias("event_type"), expr.nan_to_null(nan).alias("value"),
        expr.dash_to_zero(F.when(kind == "click", "-").otherwise(kind)).alias("dash"))


@query("coalesce_default", """
SELECT s_suppkey, coalesce(CASE WHEN s_acctbal < 0 THEN NULL ELSE s_name END, 'ESC') AS instrument,
  coalesce(CASE WHEN s_acctbal > 5000 THEN NULL ELSE 'Fwd' END, 'Spot') AS tenor_type FROM supplier""")
def coalesce_default(spark, folder):
    rows = table(spark, folder, "supplier").select(
        "s_suppkey", F.when(F.col("s_acctbal") >= 0, F.col("s_name")).alias("instrument"),
        F.when(F.col("s_acctbal") <= 5000, "Fwd").alias("tenor_type"))
    return rows.fillna({"instrument": "ESC", "tenor_type": "Spot"})


@query("last_characters", "SELECT doc_id, right(text, 80) AS tail FROM documents")
def last_characters(spark, folder):
    return table(spark, folder, "documents").select("doc_id", expr.last_characters(F.col("text")).alias("tail"))


@query("payload_between", """
SELECT page_id, CASE WHEN instr(html, '<nav>') > 0 AND instr(substr(html, instr(html, '<nav>') + 5), '</nav>') > 0
  THEN substr(substr(html, instr(html, '<nav>') + 5), 1, instr(substr(html, instr(html, '<nav>') + 5), '</nav>') - 1) END AS payload FROM pages""")
def payload_between(spark, folder):
    return table(spark, folder, "pages").select("page_id", expr.between(F.col("html"), "<nav>", "</nav>").alias("payload"))


# --- rows that repeat or conflict -----------------------------------------------------------------


@query("resolve_conflicts", """
SELECT user_id, event_type, date_trunc('day', ts) AS day, max(value) AS value, min(event_id) AS event_id, max(props) AS props
FROM events GROUP BY ALL""")
def resolve_conflicts(spark, folder):
    events = table(spark, folder, "events").select(
        "user_id", "event_type", F.date_trunc("day", "ts").cast("timestamp_ntz").alias("day"), "value", "event_id", "props")
    return quality.resolve(events, ["user_id", "event_type", "day"], {"event_id": "min"})


@query("resolve_lines", """
SELECT l_orderkey, l_linenumber, max(l_partkey) AS l_partkey, max(l_quantity) AS l_quantity, min(l_extendedprice) AS l_extendedprice,
  max(l_shipdate) AS l_shipdate, max(l_returnflag) AS l_returnflag FROM lineitem GROUP BY l_orderkey, l_linenumber""")
def resolve_lines(spark, folder):
    lines = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice", "l_shipdate", "l_returnflag")
    return quality.resolve(lines, ["l_orderkey", "l_linenumber"], {"l_extendedprice": "min"})


@query("duplicates", """
SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice, l_shipdate FROM (
  SELECT *, count(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS n FROM lineitem) WHERE n > 1""")
def duplicates(spark, folder):
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "l_shipdate")
    return quality.duplicates(lines, ["l_orderkey", "l_linenumber"])


@query("conflicts", """
WITH l AS (SELECT l_orderkey, l_linenumber, nullif(l_returnflag, 'A') AS flag, l_linestatus FROM lineitem),
k AS (SELECT l_orderkey, l_linenumber FROM l GROUP BY ALL HAVING min(flag) <> max(flag) OR min(l_linestatus) <> max(l_linestatus))
SELECT l.* FROM l JOIN k USING (l_orderkey, l_linenumber)""")
def conflicts(spark, folder):
    lines = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", F.nullif(F.col("l_returnflag"), F.lit("A")).alias("flag"), "l_linestatus")
    return quality.conflicts(lines, ["l_orderkey", "l_linenumber"])


@query("fill_from_first", """
WITH e AS (SELECT user_id, event_id, CASE WHEN event_type = 'error' THEN NULL ELSE ts END AS day FROM events),
f AS (SELECT user_id, arg_min(coalesce(day, TIMESTAMP '2000-01-01'), event_id) AS day FROM e GROUP BY user_id)
SELECT e.user_id, e.event_id, coalesce(e.day, f.day) AS day FROM e JOIN f USING (user_id)""")
def fill_from_first(spark, folder):
    events = table(spark, folder, "events").select(
        "user_id", "event_id", F.when(F.col("event_type") != "error", F.col("ts")).alias("day"))
    return quality.fill_from_first(events, "day", ["user_id"], "event_id", F.lit("2000-01-01 00:00:00").cast("timestamp_ntz"))


@query("numeric_coerce", """
SELECT p_partkey, try_cast(substr(p_brand, 7) AS DOUBLE) AS code, p_type, CASE WHEN p_size > 25 THEN CAST(p_size AS DOUBLE) END AS mixed FROM part""")
def numeric_coerce(spark, folder):
    part = table(spark, folder, "part").select(
        "p_partkey", F.substring("p_brand", 7, 10).alias("code"), "p_type",
        F.when(F.col("p_size") > 25, F.col("p_size").cast("string")).otherwise(F.col("p_type")).alias("mixed"))
    return quality.numeric_coerce(part)


_TYPES = ["click", "error", "purchase", "signup", "view"]
_LAST = ", ".join(f"arg_max(value, event_id) FILTER (WHERE event_type = '{t}') AS {t}" for t in _TYPES)


@query("pivot_attributes", f"SELECT user_id, {_LAST} FROM events GROUP BY user_id")
def pivot_attributes(spark, folder):
    return quality.pivot_attributes(table(spark, folder, "events"), ["user_id"], "event_type", "value", _TYPES, "event_id")


@query("pivot_carry_forward", f"""
WITH p AS (SELECT user_id, date_diff('day', DATE '1970-01-01', CAST(ts AS DATE)) AS day, {_LAST} FROM events GROUP BY ALL)
SELECT user_id, CAST(day AS BIGINT) AS day, {", ".join(f"last_value({t} IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY day) AS {t}" for t in _TYPES)} FROM p""")
def pivot_carry_forward(spark, folder):
    """Attributes per user and day; one that is absent on a day keeps its latest earlier value."""
    events = table(spark, folder, "events").withColumn("day", F.unix_date(F.col("ts").cast("date")).cast("long"))
    wide = quality.pivot_attributes(events, ["user_id", "day"], "event_type", "value", _TYPES, "event_id")
    carried = scan(wide, ["user_id"], "day", **{f"_{t}": carry(F.col(t)) for t in _TYPES})
    return carried.select("user_id", "day", *[F.col(f"_{t}").alias(t) for t in _TYPES])


@query("union_pad", """
SELECT c_name AS name, c_acctbal AS acctbal, c_mktsegment AS segment, NULL AS nation FROM customer
UNION ALL SELECT s_name, s_acctbal, NULL, s_nationkey FROM supplier""")
def union_pad(spark, folder):
    first = table(spark, folder, "customer").select(
        F.col("c_name").alias("name"), F.col("c_acctbal").alias("acctbal"), F.col("c_mktsegment").alias("segment"))
    second = table(spark, folder, "supplier").select(
        F.col("s_nationkey").alias("nation"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("acctbal"))
    return quality.union_pad(first, second)
