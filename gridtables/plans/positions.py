"""Row order as data: parents, record order, blocks, first faults, intervals and ranges."""

from pyspark.sql import functions as F

from gridtables.functions import rules
from gridtables.functions.expr import interval_end
from gridtables.functions.rules import Field
from gridtables.operators import positional, ranges
from gridtables.plans.registry import query, table
from gridtables.sources.lines import lines_of, payload_between



@query("numbered_lines", """
SELECT doc_id, CAST(generate_subscripts(string_split(text, chr(10)), 1) - 1 AS BIGINT) AS line_no, unnest(string_split(text, chr(10))) AS line FROM documents""")
def numbered_lines(spark, folder):
    return lines_of(table(spark, folder, "documents"), ["doc_id"], "text")


@query("payload_lines", """
WITH l AS (SELECT page_id, CAST(generate_subscripts(string_split(html, '>'), 1) - 1 AS BIGINT) AS n, unnest(string_split(html, '>')) AS line FROM pages),
a AS (SELECT page_id, min(n) AS n FROM l WHERE contains(line, '<nav') GROUP BY page_id),
b AS (SELECT l.page_id, min(l.n) AS n FROM l JOIN a ON l.page_id = a.page_id AND l.n > a.n WHERE contains(line, '</nav') GROUP BY l.page_id),
p AS (SELECT l.page_id, l.n, CASE WHEN l.n = a.n THEN substr(line, instr(line, '<nav') + 4) WHEN l.n = b.n THEN substr(line, 1, instr(line, '</nav') - 1) ELSE line END AS line
  FROM l JOIN a ON l.page_id = a.page_id JOIN b ON l.page_id = b.page_id WHERE l.n BETWEEN a.n AND b.n)
SELECT CAST(page_id AS VARCHAR) AS file, row_number() OVER (PARTITION BY page_id ORDER BY n) - 1 AS line_no, line FROM p
WHERE trim(line, E' \\t\\r\\n\\f\\v') <> ''""")
def payload_lines(spark, folder):
    """Markup split at tag ends as the lines of a file; the payload is what stands inside the first nav element."""
    lines = lines_of(table(spark, folder, "pages"), ["page_id"], "html", ">")
    files = lines.select(F.col("page_id").cast("string").alias("file"), "line_no", "line", F.expr(f"line_no div {positional.CHUNK_ROWS}").alias("chunk"))
    return payload_between(files, "<nav", "</nav").rows.select("file", "line_no", "line")


_EVENTS = "SELECT user_id, event_id, event_type, value, row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS n FROM events"


@query("row_numbers", f"SELECT user_id, event_id, n AS row_no FROM ({_EVENTS})")
def row_numbers(spark, folder):
    events = table(spark, folder, "events").select("user_id", "event_id")
    return positional.numbered(events, ["user_id"], "event_id")


@query("block_split", f"""
WITH e AS ({_EVENTS}),
m AS (SELECT *, sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY n) AS block,
             sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id) AS blocks FROM e),
r AS (SELECT *, row_number() OVER (PARTITION BY user_id, block ORDER BY n) AS block_row,
        first_value(event_type) OVER (PARTITION BY user_id, block ORDER BY n) AS lead FROM m
      WHERE event_type <> 'error' AND block > 0 AND block < blocks)
SELECT user_id, event_id, value, CAST(block AS BIGINT) AS block, block_row, lead FROM r WHERE block_row > 1""")
def block_split(spark, folder):
    """Runs of events closed by errors on both sides; the first event leads its block and is no data row."""
    events = table(spark, folder, "events").select("user_id", "event_id", "event_type", "value")
    rows = positional.numbered(events, ["user_id"], "event_id")
    found = positional.blocks(rows, ["user_id"], "row_no", F.col("event_type") == "error").filter("closed")
    led = positional.scan(
        found, ["user_id"], "row_no", lead=positional.carry(F.when(F.col("block_row") == 1, F.col("event_type"))))
    return led.filter("block_row > 1").select("user_id", "event_id", "value", "block", "block_row", "lead")


@query("carry_forward_parent", """
SELECT conv_id, turn, role, last_value(CASE WHEN role = 'user' THEN turn END IGNORE NULLS) OVER w AS parent_turn,
  last_value(CASE WHEN role = 'user' THEN text END IGNORE NULLS) OVER w AS parent_text FROM conversations
WINDOW w AS (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)""")
def carry_forward_parent(spark, folder):
    user = F.when(F.col("role") == "user", F.struct("turn", "text"))
    carried = positional.scan(
        table(spark, folder, "conversations"), ["conv_id"], "turn", parent=positional.carry_before(user))
    return carried.select("conv_id", "turn", "role", F.col("parent.turn").alias("parent_turn"), F.col("parent.text").alias("parent_text"))


@query("carry_forward_events", """
SELECT event_id, user_id, last_value(CASE WHEN event_type = 'signup' THEN event_id END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY event_id) AS parent,
  lag(event_type) OVER (PARTITION BY user_id ORDER BY event_id) AS before,
  CAST(sum(CASE WHEN event_type = 'click' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY event_id) AS BIGINT) AS clicks,
  max(value) OVER (PARTITION BY user_id) AS top FROM events""")
def carry_forward_events(spark, folder):
    kind = F.col("event_type")
    events = table(spark, folder, "events").select("event_id", "user_id", "event_type", "value")
    return positional.scan(
        events, ["user_id"], "event_id",
        parent=positional.carry(F.when(kind == "signup", F.col("event_id"))), before=positional.previous(kind),
        clicks=positional.running((kind == "click").cast("long")), top=positional.whole_max(F.col("value")),
    ).drop("event_type", "value")


_TURN_ERRORS = """
SELECT conv_id, turn, role, CASE role
    WHEN 'system' THEN CASE WHEN before IS NOT NULL THEN 'record out of order' END
    WHEN 'user' THEN CASE WHEN before IS NOT NULL AND before <> 'assistant' THEN 'record out of order' END
    WHEN 'assistant' THEN CASE WHEN before IS NULL OR before <> 'user' THEN 'record out of order' END
    ELSE 'unknown record' END AS error
FROM (SELECT *, lag(role) OVER (PARTITION BY conv_id ORDER BY turn) AS before FROM conversations)"""
_TURNS = {"system": (None,), "user": (None, "assistant"), "assistant": ("user",)}


def _turns(spark, folder):
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role")
    found = positional.scan(turns, ["conv_id"], "turn", _before=positional.previous(F.col("role")))
    return found.withColumn("error", rules.order_error(F.col("role"), F.col("_before"), _TURNS)).drop("_before")


@query("record_order_check", _TURN_ERRORS)
def record_order_check(spark, folder):
    return _turns(spark, folder)


_BAD = "SELECT conv_id, min(turn) AS bad FROM t WHERE error IS NOT NULL GROUP BY conv_id"


@query("first_error_prefix", f"WITH t AS ({_TURN_ERRORS}), b AS ({_BAD}) SELECT t.* FROM t LEFT JOIN b USING (conv_id) WHERE bad IS NULL OR turn < bad")
def first_error_prefix(spark, folder):
    return rules.until_first_error(_turns(spark, folder), ["conv_id"], "turn", "error", "prefix")


@query("first_error_atomic", f"WITH t AS ({_TURN_ERRORS}), b AS ({_BAD}) SELECT t.* FROM t LEFT JOIN b USING (conv_id) WHERE bad IS NULL")
def first_error_atomic(spark, folder):
    return rules.until_first_error(_turns(spark, folder), ["conv_id"], "turn", "error", "atomic")


_FIELDS = (
    Field("name", "C", 18, True), Field("segment", "V", 9, True), Field("balance", "N", 3, True, scale=1),
    Field("nation", "N", 1), Field("day", "D", 8),
)


@query("field_rules", r"""
WITH c AS (SELECT c_custkey, c_name AS name, CASE WHEN c_acctbal < 0 THEN '' ELSE c_mktsegment END AS segment, CAST(c_acctbal AS VARCHAR) AS balance,
  CAST(c_nationkey AS VARCHAR) AS nation, '2004' || lpad(CAST(c_nationkey AS VARCHAR), 2, '0') || '15' AS day FROM customer)
SELECT c_custkey, CASE
  WHEN name = '' THEN 'name: missing mandatory value' WHEN length(name) <> 18 THEN 'name: invalid C18 value'
  WHEN segment = '' THEN 'segment: missing mandatory value' WHEN length(segment) > 9 THEN 'segment: invalid V9 value'
  WHEN NOT (regexp_full_match(balance, '[+-]?[0-9]+(\.[0-9]+)?|\.[0-9]+') AND length(split_part(balance, '.', 1)) <= 3
    AND length(split_part(balance, '.', 2)) <= 1) THEN 'balance: invalid N3 value'
  WHEN length(nation) > 1 THEN 'nation: invalid N1 value'
  WHEN try_strptime(day, '%Y%m%d') IS NULL THEN 'day: invalid D8 value' END AS error FROM c""")
def field_rules(spark, folder):
    nation = F.col("c_nationkey").cast("string")
    rows = table(spark, folder, "customer").select(
        "c_custkey", F.col("c_name").alias("name"), F.when(F.col("c_acctbal") < 0, "").otherwise(F.col("c_mktsegment")).alias("segment"),
        F.col("c_acctbal").cast("string").alias("balance"), nation.alias("nation"),
        F.concat(F.lit("2004"), F.lpad(nation, 2, "0"), F.lit("15")).alias("day"))
    return rows.select("c_custkey", rules.columns_error(rows, _FIELDS).alias("error"))


# --- intervals and ranges -------------------------------------------------------------------------


def _wide(spark, folder):
    """Hourly maxima of a user's day as an array of 24 values."""
    events = table(spark, folder, "events").select(
        "user_id", F.date_trunc("day", "ts").cast("timestamp_ntz").alias("day"), F.hour("ts").alias("hour"), "value")
    hours = [F.max(F.when(F.col("hour") == h, F.col("value"))) for h in range(24)]
    return events.groupBy("user_id", "day").agg(F.array(*hours).alias("values"))


_HOURLY = "SELECT user_id, date_trunc('day', ts) AS day, hour(ts) + 1 AS interval, max(value) AS value FROM events GROUP BY ALL"


@query("interval_wide", f"SELECT user_id, day, {', '.join(f'max(CASE WHEN interval = {i} THEN value END) AS v{i}' for i in range(1, 25))} FROM ({_HOURLY}) GROUP BY ALL")
def interval_wide(spark, folder):
    return _wide(spark, folder).select("user_id", "day", *[F.get("values", F.lit(i)).alias(f"v{i + 1}") for i in range(24)])


@query("interval_long", f"""
WITH d AS (SELECT DISTINCT user_id, date_trunc('day', ts) AS day FROM events)
SELECT d.user_id, d.day, CAST(i AS INTEGER) AS interval, h.value, d.day + to_minutes(CAST(i * 60 AS INTEGER)) AS interval_end
FROM d, range(1, 25) r(i) LEFT JOIN ({_HOURLY}) h ON h.user_id = d.user_id AND h.day = d.day AND h.interval = i""")
def interval_long(spark, folder):
    long = ranges.slots(_wide(spark, folder), "values")
    return long.withColumn("interval_end", interval_end(F.col("day"), F.col("interval"), F.lit(60)))


_HOUR = "CAST(floor(epoch(ts) / 3600) AS BIGINT)"


@query("quality_range_join", f"""
WITH p AS (SELECT user_id, event_id, {_HOUR} AS hour FROM events WHERE event_type <> 'signup'),
r AS (SELECT user_id, {_HOUR} AS first_hour, {_HOUR} + 23 AS last_hour, event_id AS range_id FROM events WHERE event_type = 'signup')
SELECT p.user_id, p.event_id, p.hour, r.first_hour, r.last_hour, r.range_id FROM p LEFT JOIN r
  ON p.user_id = r.user_id AND p.hour BETWEEN r.first_hour AND r.last_hour""")
def quality_range_join(spark, folder):
    """Events with the day-long ranges that the same user's signups open."""
    events = table(spark, folder, "events").withColumn("hour", F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / 3_600_000_000))
    points = events.filter("event_type <> 'signup'").select("user_id", "event_id", "hour")
    held = events.filter("event_type = 'signup'").select(
        "user_id", F.col("hour").alias("first_hour"), (F.col("hour") + 23).alias("last_hour"), F.col("event_id").alias("range_id"))
    return ranges.range_join(points, held, ["user_id"], "hour", "first_hour", "last_hour")


@query("contiguous_ranges", """
WITH o AS (SELECT o_custkey, o_orderkey, month(o_orderdate) AS first, month(o_orderdate) + CASE WHEN o_orderstatus = 'F' THEN -1 ELSE 1 END AS last FROM orders),
b AS (SELECT *, lag(last) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS before FROM o)
SELECT o_custkey, o_orderkey, first, last, CASE WHEN last < first THEN 'range ends before it starts'
  WHEN first <> coalesce(before, 0) + 1 THEN 'range does not follow the one before' END AS range_error FROM b""")
def contiguous_ranges(spark, folder):
    month = F.month("o_orderdate").cast("long")
    rows = table(spark, folder, "orders").select(
        "o_custkey", "o_orderkey", month.alias("first"), (month + F.when(F.col("o_orderstatus") == "F", -1).otherwise(1)).alias("last"))
    return ranges.contiguous_error(rows, ["o_custkey"], "o_orderkey", "first", "last")
