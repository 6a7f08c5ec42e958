"""Keyed writes: upsert, insert if absent, surrogate keys."""

from pyspark.sql import functions as F

from gridtables.operators import ids, merge
from gridtables.plans.registry import query, table

_CUSTOMER = ("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")


def _customers(spark, folder):
    """Customers in credit as the target; re-rated customers below 5000 and all suppliers as the source."""
    customer = table(spark, folder, "customer").select(*_CUSTOMER)
    target = customer.filter("c_acctbal >= 0")
    changed = customer.filter("c_acctbal < 5000").withColumn("c_mktsegment", F.concat("c_mktsegment", F.lit("_2")))
    new = table(spark, folder, "supplier").select(
        (F.col("s_suppkey") + 1000000).alias("c_custkey"), F.col("s_name").alias("c_name"),
        F.col("s_nationkey").alias("c_nationkey"), F.col("s_acctbal").alias("c_acctbal"), F.lit("SUPPLIER").alias("c_mktsegment"),
    )
    return target, changed.unionByName(new)


@query("upsert_customer", """
WITH t AS (SELECT * FROM customer WHERE c_acctbal >= 0),
s AS (SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment || '_2' AS c_mktsegment FROM customer WHERE c_acctbal < 5000
      UNION ALL SELECT s_suppkey + 1000000, s_name, s_nationkey, s_acctbal, 'SUPPLIER' FROM supplier)
SELECT coalesce(s.c_custkey, t.c_custkey) AS c_custkey, coalesce(s.c_name, t.c_name) AS c_name,
       coalesce(s.c_nationkey, t.c_nationkey) AS c_nationkey, coalesce(s.c_acctbal, t.c_acctbal) AS c_acctbal,
       coalesce(s.c_mktsegment, t.c_mktsegment) AS c_mktsegment
FROM t FULL JOIN s ON t.c_custkey = s.c_custkey""")
def upsert_customer(spark, folder):
    target, source = _customers(spark, folder)
    return merge.upsert(target, source, ["c_custkey"])


@query("upsert_last_wins", """
WITH s AS (SELECT user_id, event_type, value, props, ts FROM (
             SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id DESC) AS n FROM events) WHERE n = 1),
t AS (SELECT DISTINCT user_id, event_type, -1.0::DOUBLE AS value, 'first' AS origin FROM events WHERE event_type IN ('click', 'view')
      UNION ALL SELECT c_custkey + 1000000, 'none', c_acctbal, 'first' FROM customer)
SELECT coalesce(s.user_id, t.user_id) AS user_id, coalesce(s.event_type, t.event_type) AS event_type,
       coalesce(s.value, t.value) AS value, t.origin, s.props, s.ts
FROM t FULL JOIN s ON t.user_id = s.user_id AND t.event_type = s.event_type""")
def upsert_last_wins(spark, folder):
    events = table(spark, folder, "events")
    seen = events.filter(F.col("event_type").isin("click", "view")).select("user_id", "event_type").distinct()
    target = seen.withColumn("value", F.lit(-1.0)).withColumn("origin", F.lit("first")).unionByName(
        table(spark, folder, "customer").select(
            (F.col("c_custkey") + 1000000).alias("user_id"), F.lit("none").alias("event_type"),
            F.col("c_acctbal").alias("value"), F.lit("first").alias("origin"))
    )
    source = events.select("user_id", "event_type", "value", "props", "ts", "event_id")
    return merge.upsert(target, source, ["user_id", "event_type"], order=["event_id"])


def _priced(spark, folder):
    orders = table(spark, folder, "orders")
    key = F.when(F.col("o_orderstatus") == "P", None).otherwise(F.col("o_orderkey"))
    target = orders.select("o_orderkey", "o_totalprice", "o_orderpriority")
    source = orders.select(key.alias("o_orderkey"), (F.col("o_totalprice") * 2).alias("o_totalprice"), F.col("o_orderkey").alias("seq"))
    return target, source


@query("upsert_null_keys", """
SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN o_totalprice ELSE o_totalprice * 2 END AS o_totalprice, o_orderpriority FROM orders
UNION ALL SELECT NULL, o_totalprice * 2, NULL FROM orders WHERE o_orderstatus = 'P'""")
def upsert_null_keys(spark, folder):
    target, source = _priced(spark, folder)
    return merge.upsert(target, source, ["o_orderkey"], order=["seq"])


@query("upsert_null_safe", """
SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN o_totalprice ELSE o_totalprice * 2 END AS o_totalprice, o_orderpriority FROM orders
UNION ALL (SELECT NULL, o_totalprice * 2, NULL FROM orders WHERE o_orderstatus = 'P' ORDER BY o_orderkey DESC LIMIT 1)""")
def upsert_null_safe(spark, folder):
    target, source = _priced(spark, folder)
    return merge.upsert(target, source, ["o_orderkey"], order=["seq"], null_safe=True)


@query("upsert_only_keys", """
SELECT o_custkey, o_orderpriority FROM orders WHERE o_orderstatus = 'F'
UNION ALL (SELECT DISTINCT o_custkey, o_orderpriority FROM orders o WHERE NOT EXISTS
  (SELECT 1 FROM orders t WHERE t.o_orderstatus = 'F' AND t.o_custkey = o.o_custkey AND t.o_orderpriority = o.o_orderpriority))""")
def upsert_only_keys(spark, folder):
    orders = table(spark, folder, "orders")
    pairs = orders.select("o_custkey", "o_orderpriority")
    return merge.upsert(orders.filter("o_orderstatus = 'F'").select(*pairs.columns), pairs, pairs.columns)


@query("append_rows", """
SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer
UNION ALL SELECT s_suppkey, s_name, s_nationkey, s_acctbal, NULL FROM supplier""")
def append_rows(spark, folder):
    new = table(spark, folder, "supplier").select(
        F.col("s_suppkey").alias("c_custkey"), F.col("s_name").alias("c_name"), F.col("s_nationkey").alias("c_nationkey"),
        F.col("s_acctbal").alias("c_acctbal"))
    return merge.upsert(table(spark, folder, "customer").select(*_CUSTOMER), new, [])


@query("insert_absent", """
WITH t AS (SELECT * FROM orders WHERE o_orderstatus <> 'P'),
s AS (SELECT l_orderkey AS o_orderkey, min(l_shipdate) AS d FROM lineitem GROUP BY l_orderkey)
SELECT o_orderkey, o_orderstatus, o_orderdate FROM t
UNION ALL SELECT s.o_orderkey, 'N', s.d FROM s WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.o_orderkey = s.o_orderkey)""")
def insert_absent(spark, folder):
    """Shipments arriving for orders: the first one per unknown order makes a new row."""
    target = table(spark, folder, "orders").filter("o_orderstatus <> 'P'").select("o_orderkey", "o_orderstatus", "o_orderdate")
    source = table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"), F.lit("N").alias("o_orderstatus"), F.col("l_shipdate").alias("o_orderdate"))
    return merge.insert_absent(target, source, ["o_orderkey"], order=["o_orderdate"])


_STREAM = ["l_suppkey", "l_returnflag", "l_line"]
_ORDER = """substr(md5(concat_ws('|', coalesce(cast(l_suppkey AS VARCHAR), '~'), coalesce(l_returnflag, '~'), coalesce(cast(l_line AS VARCHAR), '~'))), 1, 3),
  l_suppkey NULLS FIRST, l_returnflag NULLS FIRST, l_line NULLS FIRST"""
_DIM_SQL = f"""
WITH l AS (SELECT l_orderkey, l_suppkey, l_returnflag, nullif(l_linenumber, 1) AS l_line, l_quantity FROM lineitem),
d AS (SELECT *, row_number() OVER (ORDER BY {_ORDER}) AS id FROM (SELECT DISTINCT l_suppkey, l_returnflag, l_line FROM l WHERE l_returnflag = 'A')),
n AS (SELECT *, (SELECT max(id) FROM d) + row_number() OVER (ORDER BY {_ORDER}) AS id FROM (
        SELECT DISTINCT l_suppkey, l_returnflag, l_line FROM l WHERE l_returnflag <> 'A')),
g AS (SELECT * FROM d UNION ALL SELECT * FROM n)
"""


def _streams(spark, folder):
    lines = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_suppkey", "l_returnflag", F.nullif(F.col("l_linenumber"), F.lit(1)).alias("l_line"), "l_quantity")
    known = lines.filter("l_returnflag = 'A'").select(*_STREAM).distinct()
    return ids.assign_ids(known, _STREAM, "id", F.lit(0)), lines


@query("get_or_create_keys", _DIM_SQL + """
SELECT l.l_orderkey, l.l_suppkey, l.l_returnflag, l.l_line, l.l_quantity, g.id FROM l JOIN g
  ON l.l_suppkey = g.l_suppkey AND l.l_returnflag = g.l_returnflag AND l.l_line IS NOT DISTINCT FROM g.l_line""")
def get_or_create_keys(spark, folder):
    dim, lines = _streams(spark, folder)
    return merge.get_or_create_keys(dim, lines, _STREAM)[1]


@query("get_or_create_dimension", _DIM_SQL + "SELECT l_suppkey, l_returnflag, l_line, id FROM g")
def get_or_create_dimension(spark, folder):
    dim, lines = _streams(spark, folder)
    return merge.get_or_create_keys(dim, lines, _STREAM)[0]


@query("insert_returning_id", """
SELECT user_id, event_id, value, (SELECT max(o_orderkey) FROM orders) + row_number() OVER (ORDER BY
  substr(md5(concat_ws('|', cast(user_id AS VARCHAR), cast(event_id AS VARCHAR))), 1, 3), user_id, event_id) AS id FROM events""")
def insert_returning_id(spark, folder):
    stored = table(spark, folder, "orders").withColumnRenamed("o_orderkey", "id")
    return merge.with_row_ids(table(spark, folder, "events").select("user_id", "event_id", "value"), stored, ["user_id", "event_id"])


@query("number_copies", """
WITH c AS (SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders GROUP BY ALL)
SELECT o_orderstatus, o_orderpriority, n, row_number() OVER (ORDER BY
  substr(md5(concat_ws('|', o_orderstatus, o_orderpriority)), 1, 3), o_orderstatus, o_orderpriority) AS place,
  CAST(sum(n) OVER (ORDER BY substr(md5(concat_ws('|', o_orderstatus, o_orderpriority)), 1, 3), o_orderstatus, o_orderpriority) AS BIGINT) AS last_id FROM c""")
def number_copies(spark, folder):
    """Ids for exact copies of rows: every copy gets its own id, checked here by each group's last id."""
    rows = ids.assign_ids_to_copies(table(spark, folder, "orders").select("o_orderstatus", "o_orderpriority"), "id", F.lit(0))
    spans = rows.groupBy("o_orderstatus", "o_orderpriority").agg(F.countDistinct("id").alias("n"), F.max("id").alias("last_id"))
    return ids.assign_ids(spans, ["o_orderstatus", "o_orderpriority"], "place", F.lit(0)).select(
        "o_orderstatus", "o_orderpriority", "n", "place", "last_id")
