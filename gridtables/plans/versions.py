"""Versioned tables over the orders: a first snapshot, a changed one, and one in which keys come back."""

from pyspark.sql import functions as F

from gridtables.operators import scd2
from gridtables.plans.registry import query, table
from gridtables.session import cut_lineage

T1, T2, T3 = "2020-01-01 00:00:00", "2020-01-02 00:00:00", "2020-01-03 00:00:00"
KEYS = ["o_orderkey"]
_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"]


def _orders(spark, folder):
    return table(spark, folder, "orders").select(*_COLUMNS)


def first_snapshot(spark, folder):
    """Finished and open orders."""
    return _orders(spark, folder).filter(F.col("o_orderstatus").isin("F", "O"))


def second_snapshot(spark, folder):
    """Finished orders, some of them changed, and pending orders; the open ones are gone."""
    urgent, high = F.col("o_orderpriority") == "1-URGENT", F.col("o_orderpriority") == "2-HIGH"
    finished = F.col("o_orderstatus") == "F"
    return (
        _orders(spark, folder).filter(F.col("o_orderstatus").isin("F", "P"))
        .withColumn("o_totalprice", F.when(finished & urgent, F.col("o_totalprice") * 2).otherwise(F.col("o_totalprice")))
        .withColumn("o_orderpriority", F.when(finished & high, None).otherwise(F.col("o_orderpriority")))
    )


def _second(spark, folder, **options):
    start = cut_lineage(scd2.init(first_snapshot(spark, folder), KEYS, T1))
    return scd2.merge(start, second_snapshot(spark, folder), KEYS, T2, **options)


_LATE = "TIMESTAMP '9999-12-31 00:00:00'"
_BUCKET = "substr(md5(cast(o_orderkey AS VARCHAR)), 1, 3)"
_DATA = "o_custkey, o_orderstatus, o_totalprice, o_orderpriority"


def _step(name: str, before: str, source: str, now: str, history: bool = True, remove: bool = True, resurrect: bool = True) -> str:
    """The rules of one merge written out as unions."""
    changed = " OR ".join(f"t.{c} IS DISTINCT FROM s.{c}" for c in _DATA.split(", "))
    known = before if not resurrect else f"(SELECT * FROM {before} WHERE active_to = {_LATE})"
    gone = f"UNION ALL SELECT 1, t.* FROM {name}_cur t WHERE NOT EXISTS (SELECT 1 FROM {source} s WHERE s.o_orderkey = t.o_orderkey)" if remove else ""
    kept_missing = "" if remove else f"UNION ALL SELECT t.* FROM {name}_cur t WHERE NOT EXISTS (SELECT 1 FROM {source} s WHERE s.o_orderkey = t.o_orderkey)"
    return f"""
{name}_cur AS (SELECT * FROM {before} WHERE active_to = {_LATE}),
{name}_upd AS (SELECT t.* FROM {name}_cur t JOIN {source} s ON t.o_orderkey = s.o_orderkey WHERE {changed}),
{name}_ins AS (SELECT * FROM {source} s WHERE NOT EXISTS (SELECT 1 FROM {known} t WHERE t.o_orderkey = s.o_orderkey)),
{name}_old AS (SELECT 1 AS kind, * FROM {name}_upd {gone}),
{name}_new AS (SELECT (SELECT coalesce(max(id), 0) FROM {before}) + row_number() OVER (ORDER BY kind, {_BUCKET}, o_orderkey) AS id,
    o_orderkey, {_DATA}, active_from, active_to FROM (
  SELECT 0 AS kind, o_orderkey, {_DATA}, TIMESTAMP '{now}' AS active_from, {_LATE} AS active_to FROM {name}_ins
  {f"UNION ALL SELECT kind, o_orderkey, {_DATA}, active_from, TIMESTAMP '{now}' FROM {name}_old" if history else ""})),
{name} AS (
  SELECT * FROM {before} WHERE active_to <> {_LATE}
  UNION ALL SELECT t.* FROM {name}_cur t JOIN {source} s ON t.o_orderkey = s.o_orderkey
    WHERE NOT EXISTS (SELECT 1 FROM {name}_upd u WHERE u.id = t.id)
  {kept_missing}
  UNION ALL SELECT u.id, s.o_orderkey, s.o_custkey, s.o_orderstatus, s.o_totalprice, s.o_orderpriority, TIMESTAMP '{now}', {_LATE}
    FROM {name}_upd u JOIN {source} s ON u.o_orderkey = s.o_orderkey
  UNION ALL SELECT * FROM {name}_new)"""


_BASE = f"""
WITH s1 AS (SELECT o_orderkey, {_DATA} FROM orders WHERE o_orderstatus IN ('F', 'O')),
s2 AS (SELECT o_orderkey, o_custkey, o_orderstatus,
    CASE WHEN o_orderstatus = 'F' AND o_orderpriority = '1-URGENT' THEN o_totalprice * 2 ELSE o_totalprice END AS o_totalprice,
    CASE WHEN o_orderstatus = 'F' AND o_orderpriority = '2-HIGH' THEN NULL ELSE o_orderpriority END AS o_orderpriority
  FROM orders WHERE o_orderstatus IN ('F', 'P')),
s3 AS (SELECT o_orderkey, {_DATA} FROM orders),
t1 AS (SELECT row_number() OVER (ORDER BY {_BUCKET}, o_orderkey) AS id, *, TIMESTAMP '{T1}' AS active_from, {_LATE} AS active_to FROM s1)"""
_ALL = f"id, o_orderkey, {_DATA}, active_from, active_to"
_T2 = _BASE + "," + _step("t2", "t1", "s2", T2)


@query("scd2_init", f"{_BASE} SELECT {_ALL} FROM t1")
def scd2_init(spark, folder):
    return scd2.init(first_snapshot(spark, folder), KEYS, T1)


@query("scd2_merge", f"{_T2} SELECT {_ALL} FROM t2")
def scd2_merge(spark, folder):
    return _second(spark, folder).table


@query("scd2_no_history", f"{_BASE}, {_step('t2', 't1', 's2', T2, history=False)} SELECT {_ALL} FROM t2")
def scd2_no_history(spark, folder):
    return _second(spark, folder, point_in_time=False).table


@query("scd2_keep_missing", f"{_BASE}, {_step('t2', 't1', 's2', T2, remove=False)} SELECT {_ALL} FROM t2")
def scd2_keep_missing(spark, folder):
    return _second(spark, folder, remove_if_not_found=False).table


def _third(spark, folder, resurrect):
    stored = cut_lineage(_second(spark, folder).table)
    return scd2.merge(stored, _orders(spark, folder), KEYS, T3, resurrect=resurrect).table


@query("scd2_resurrect", f"{_T2}, {_step('t3', 't2', 's3', T3)} SELECT {_ALL} FROM t3")
def scd2_resurrect(spark, folder):
    return _third(spark, folder, True)


@query("scd2_stay_closed", f"{_T2}, {_step('t3', 't2', 's3', T3, resurrect=False)} SELECT {_ALL} FROM t3")
def scd2_stay_closed(spark, folder):
    return _third(spark, folder, False)


@query("scd2_current", f"{_T2} SELECT id, o_orderkey, {_DATA}, active_from AS last_modified_dttm FROM t2 WHERE active_to = {_LATE}")
def scd2_current(spark, folder):
    return scd2.current(_second(spark, folder).table)


@query("scd2_as_of", f"{_T2} SELECT {_ALL} FROM t2 WHERE active_from <= TIMESTAMP '2020-01-01 12:00:00' AND active_to > TIMESTAMP '2020-01-01 12:00:00'")
def scd2_as_of(spark, folder):
    return scd2.as_of(_second(spark, folder).table, "2020-01-01 12:00:00")


@query("scd2_changes", f"""{_T2}
SELECT 'UPDATE' AS merge_action, o_orderkey, {_DATA}, active_from, active_to FROM t2_upd
UNION ALL SELECT 'DELETE', o_orderkey, {_DATA}, active_from, active_to FROM t2_cur t
  WHERE NOT EXISTS (SELECT 1 FROM s2 s WHERE s.o_orderkey = t.o_orderkey)
UNION ALL SELECT 'INSERT', o_orderkey, NULL, NULL, NULL, NULL, NULL, NULL FROM t2_ins""")
def scd2_changes(spark, folder):
    return _second(spark, folder).changes


@query("merge_counts", f"""{_T2}
SELECT 'orders' AS process_name, 'orders' AS target_table, 'SUCCESS' AS process_status,
  (SELECT count(*) FROM t2_ins) AS records_inserted, (SELECT count(*) FROM t2_upd) AS records_updated,
  (SELECT count(*) FROM t2_old) - (SELECT count(*) FROM t2_upd) AS records_deleted, (SELECT count(*) FROM s2) AS total_source_records,
  TIMESTAMP '{T2}' AS start_time, TIMESTAMP '2020-01-02 00:05:00' AS finish_time""")
def merge_counts(spark, folder):
    source = second_snapshot(spark, folder)
    return scd2.audit(_second(spark, folder).changes, source, "orders", T2, "2020-01-02 00:05:00")


@query("scd2_null_keys", f"""
WITH s AS (SELECT CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderkey END AS k, o_orderpriority AS p FROM orders)
SELECT k, p, active_from, active_to, count(*) AS n FROM (
  SELECT k, p, TIMESTAMP '{T1}' AS active_from, {_LATE} AS active_to FROM s WHERE k IS NOT NULL
  UNION ALL SELECT k, p, TIMESTAMP '{T1}', TIMESTAMP '{T2}' FROM s WHERE k IS NULL
  UNION ALL SELECT k, p, TIMESTAMP '{T2}', {_LATE} FROM s WHERE k IS NULL) GROUP BY ALL""")
def scd2_null_keys(spark, folder):
    """Rows without a key match nothing: each run closes the held ones and inserts the given ones anew."""
    key = F.when(F.col("o_orderstatus") == "P", None).otherwise(F.col("o_orderkey"))
    source = table(spark, folder, "orders").select(key.alias("k"), F.col("o_orderpriority").alias("p"))
    merged = scd2.merge(cut_lineage(scd2.init(source, ["k"], T1)), source, ["k"], T2).table
    return merged.groupBy("k", "p", "active_from", "active_to").agg(F.countDistinct("id").alias("n"))
