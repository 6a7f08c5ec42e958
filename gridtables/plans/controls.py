"""Load control over the driver's tables: links, work lists, grids, queue, ledger, retention."""

from pyspark.sql import functions as F

from gridtables.functions import expr
from gridtables.operators import control
from gridtables.plans.registry import query, table

_LINKS = r"""
l AS (SELECT page_id, url, unnest(regexp_extract_all(html, '(?is)<a\s(?:[^>]*?\s)?href\s*=\s*("[^"]*"|''[^'']*''|[^\s"''>]+)', 1)) AS raw FROM pages),
h AS (SELECT page_id, url, replace(trim(regexp_replace(raw, '^["'']|["'']$', '', 'g')), '&amp;', '&') AS href FROM l),
links AS (SELECT page_id, f AS file_url, regexp_replace(f, '^.*/', '') AS file_name FROM (
  SELECT page_id, CASE WHEN starts_with(href, '/') THEN regexp_extract(url, '^([a-z]+://[^/?#]*)', 1) || href
    WHEN starts_with(href, '#') THEN regexp_replace(url, '#.*$', '') || href ELSE href END AS f FROM h))"""


def _links(spark, folder):
    return control.extract_links(table(spark, folder, "pages"), "url", "html", ["page_id"])


@query("extract_links", f"WITH {_LINKS} SELECT page_id, file_url, file_name FROM links")
def extract_links(spark, folder):
    return _links(spark, folder)


def _manifest(spark, folder):
    """Names linked from pages served over plain http count as fetched."""
    return control.extract_links(table(spark, folder, "pages").filter(~F.col("url").startswith("https:")), "url", "html")


_SEEN = "seen AS (SELECT DISTINCT file_name FROM links JOIN pages USING (page_id) WHERE NOT starts_with(url, 'https:'))"


@query("not_downloaded", f"WITH {_LINKS}, {_SEEN} SELECT * FROM links WHERE file_name NOT IN (SELECT file_name FROM seen)")
def not_downloaded(spark, folder):
    return control.work_list(_links(spark, folder), _manifest(spark, folder))


@query("redownload", f"WITH {_LINKS} SELECT * FROM links WHERE regexp_matches(file_name, '(?is)^.*[aeiou].$')")
def redownload(spark, folder):
    return control.work_list(_links(spark, folder), _manifest(spark, folder), "*[AEIOU]?", redownload=True)


@query("glob_match", """
SELECT s_suppkey, s_name GLOB 'Supplier*[05]' AS ends, s_name GLOB 'Supplier#0000000??' AS early, s_name GLOB '*[!0-4]*#*9' AS nine FROM supplier""")
def glob_match(spark, folder):
    name = F.lower("s_name")
    return table(spark, folder, "supplier").select(
        "s_suppkey", expr.glob_match(name, "SUPPLIER*[05]").alias("ends"), expr.glob_match(name, "Supplier#0000000??").alias("early"),
        expr.glob_match(F.col("s_name"), "*[!0-4]*#*9").alias("nine"))


@query("parse_listing", """
SELECT s_suppkey, 'ftp://host.example/pub/' || n AS file_url, n AS file_name FROM (
  SELECT s_suppkey, unnest([replace(s_name, '#', '_') || '.axf', 'N' || s_nationkey || '.zip']) AS n FROM supplier)""")
def parse_listing(spark, folder):
    def entry(name):
        return F.concat(F.lit("-rw-r--r-- 1 ftp ftp   120 Jun 30 2014 "), name, F.lit("\r\n"))

    text = F.concat(
        entry(F.concat(F.replace("s_name", F.lit("#"), F.lit("_")), F.lit(".axf"))),
        entry(F.concat(F.lit("N"), F.col("s_nationkey").cast("string"), F.lit(".zip"))), F.lit("-rw-r--r-- unfinished line"))
    listings = table(spark, folder, "supplier").select("s_suppkey", F.lit("ftp://host.example/pub/").alias("url"), text.alias("text"))
    return control.parse_listing(listings, "url", "text", ["s_suppkey"])


_GRID = """SELECT s_suppkey, s_name, s_nationkey, d AS run_time FROM supplier,
  generate_series(TIMESTAMP '2014-01-01', TIMESTAMP '2014-02-28', INTERVAL 1 DAY) g(d)"""


@query("backfill_grid", _GRID)
def backfill_grid(spark, folder):
    jobs = table(spark, folder, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    return control.backfill_grid(jobs, "2014-01-01", "2014-02-28")


@query("expand_templates", f"""
SELECT s_suppkey, run_time, local, replace(s_name, '#', '') || strftime(local, '_%Y%m%d_%H%M.zip') AS url,
  strftime(local, '/in/%Y/%m') AS destination FROM (
  SELECT s_suppkey, s_name, run_time, run_time + to_hours(CAST(s_nationkey - 12 AS INTEGER)) AS local FROM ({_GRID}))""")
def expand_templates(spark, folder):
    """Every supplier's download at every day, at the job's own offset from UTC."""
    jobs = table(spark, folder, "supplier").select(
        "s_suppkey", F.concat(F.replace("s_name", F.lit("#"), F.lit("")), F.lit("_{year}{month}{day}_{hour}{minute}.zip")).alias("url"),
        F.lit("/in/{year}/{month}").alias("destination"), (F.col("s_nationkey") - 12).alias("offset"))
    grid = control.backfill_grid(jobs, "2014-01-01", "2014-02-28")
    timed = grid.withColumn("local", expr.local_time(F.col("run_time"), F.col("offset"))).drop("offset")
    return control.expand_templates(timed, ["url", "destination"], "local")


@query("job_parameters", "SELECT event_id, json_extract_string(props, '$.k') AS k FROM events")
def job_parameters(spark, folder):
    return table(spark, folder, "events").select(
        "event_id", F.try_element_at(control.job_parameters(F.col("props")), F.lit("k")).alias("k"))


# --- files of the loader: every order is a file in its status's folder ------------------------------

_FILES = """
files AS (SELECT '/in/' || o_orderstatus AS folder, 'f' || o_orderkey || '.csv' AS file_name, '/in/' || o_orderstatus || '/f' || o_orderkey || '.csv' AS path,
  CAST(o_orderdate AS TIMESTAMP) AS mtime, CAST(floor(o_totalprice) AS BIGINT) AS size, o_orderkey, o_orderpriority FROM orders),
jobs AS (SELECT CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 ELSE 3 END AS job_id, '/in/' || o_orderstatus AS folder,
  CAST(max(substr(o_orderpriority, 1, 1)) AS INTEGER) + CASE o_orderstatus WHEN 'F' THEN 2 ELSE 0 END AS priority FROM orders WHERE o_orderstatus <> 'P' GROUP BY o_orderstatus),
queue AS (SELECT f.*, j.job_id, j.priority FROM files f JOIN jobs j USING (folder) WHERE file_name GLOB 'f*5*.csv')"""


def _files(spark, folder):
    orders = table(spark, folder, "orders")
    at = F.concat(F.lit("/in/"), "o_orderstatus")
    name = F.concat(F.lit("f"), F.col("o_orderkey").cast("string"), F.lit(".csv"))
    return orders.select(
        at.alias("folder"), name.alias("file_name"), F.concat(at, F.lit("/"), name).alias("path"), F.col("o_orderdate").alias("mtime"),
        F.floor("o_totalprice").cast("bigint").alias("size"), "o_orderkey", "o_orderpriority")


def _jobs(spark, folder):
    status = F.col("o_orderstatus")
    number = F.when(status == "F", 1).when(status == "O", 2).otherwise(3)
    jobs = table(spark, folder, "orders").groupBy("o_orderstatus").agg(F.max(F.substring("o_orderpriority", 1, 1)).cast("int").alias("top"))
    return jobs.select(
        number.alias("id"), F.concat(F.lit("file:/in/"), status, F.lit("/")).alias("source_folder"),
        F.concat(F.lit("/done/"), status).alias("success_folder"), F.concat(F.lit("/failed/"), status).alias("fail_folder"),
        (F.col("top") + F.when(status == "F", 2).otherwise(0)).alias("priority"), F.lit("F*5*.csv ").alias("filename_pattern"),
        F.lit("delimited").alias("handler"), F.lit("{}").alias("handler_params"),
        F.when(status == "F", 9000).when(status == "O", -1).otherwise(10000).alias("success_retention_days"),
        F.when(status == "P", 0).otherwise(1).alias("active_flag"))


@query("file_queue", f"WITH {_FILES} SELECT job_id, priority, path, file_name, mtime, size FROM queue")
def file_queue(spark, folder):
    queue = control.file_queue(_files(spark, folder), _jobs(spark, folder))
    return queue.select("job_id", "priority", "path", "file_name", "mtime", "size")


@query("next_file", f"WITH {_FILES} SELECT job_id, priority, path, file_name, mtime, size FROM queue ORDER BY priority, mtime, size, path LIMIT 1")
def next_file(spark, folder):
    return control.next_file(file_queue(spark, folder))


_START = f"""{_FILES},
known AS (SELECT * FROM files WHERE o_orderpriority = '1-URGENT'),
started AS (SELECT *, (SELECT max(o_orderkey) FROM known) + row_number() OVER (ORDER BY substr(md5(concat_ws('|', job_id, folder, file_name,
    strftime(mtime, '%Y-%m-%d %H:%M:%S'))), 1, 3), job_id, folder, file_name, mtime) AS id
  FROM queue q WHERE NOT EXISTS (SELECT 1 FROM known k WHERE k.path = q.path AND k.mtime = q.mtime))"""


def _started(spark, folder):
    ledger = _files(spark, folder).filter("o_orderpriority = '1-URGENT'").select(
        F.col("o_orderkey").alias("id"), F.col("folder").alias("source_folder"), "file_name",
        F.col("mtime").alias("file_modified_dttm"))
    queue = control.file_queue(_files(spark, folder), _jobs(spark, folder))
    return control.start_loads(queue, ledger)


@query("start_loads", f"""WITH {_START}
SELECT id, job_id, file_name, folder AS source_folder, 'STARTED' AS process_status, CAST(0 AS BIGINT) AS records_processed, mtime AS file_modified_dttm FROM started""")
def start_loads(spark, folder):
    """Queued files the ledger does not know; files of urgent orders have been loaded before."""
    return _started(spark, folder).drop("path")


_LONG = """names AS (SELECT o_orderkey, o_totalprice, '/in/' || repeat(o_orderpriority || '/', 3) AS folder,
    repeat('month ' || strftime(o_orderdate, '%Y-%m') || ' ', 8) || (o_orderkey // 2) || '.csv' AS file_name,
    CAST(o_orderdate AS TIMESTAMP) AS mtime FROM orders)"""


@query("long_names", f"""WITH {_LONG}
SELECT folder || o_orderkey % 2 || file_name AS path, right(o_orderkey % 2 || file_name, 80) AS file_name, mtime AS file_modified_dttm FROM names
WHERE o_orderkey % 2 = 1 OR o_totalprice >= 100000""")
def long_names(spark, folder):
    """Names beyond the 80 characters that the ledger shows, two by two alike in what it shows: each file is started by its path."""
    key = F.col("o_orderkey")
    place = F.concat(F.lit("/in/"), F.repeat(F.concat("o_orderpriority", F.lit("/")), F.lit(3)))
    name = F.concat((key % 2).cast("string"), F.repeat(F.concat(F.lit("month "), F.date_format("o_orderdate", "yyyy-MM"), F.lit(" ")), F.lit(8)),
                    F.floor(key / 2).cast("string"), F.lit(".csv"))
    files = table(spark, folder, "orders").select(
        key.alias("k"), "o_totalprice", F.concat(place, name).alias("path"), place.alias("folder"), name.alias("file_name"), F.lit(1).alias("job_id"),
        F.col("o_orderdate").cast("timestamp_ntz").alias("mtime"))
    known = files.filter("k % 2 = 0 AND o_totalprice < 100000").select(
        F.col("k").alias("id"), "path", F.col("folder").alias("source_folder"), expr.last_characters(F.col("file_name")).alias("file_name"),
        F.col("mtime").alias("file_modified_dttm"))
    return control.start_loads(files, known).select("path", "file_name", "file_modified_dttm")


@query("finish_loads", f"""WITH {_START},
r AS (SELECT s.id, count(l_orderkey) AS n, coalesce(max(CASE WHEN l_returnflag = 'R' AND l_quantity > 45 THEN 1 END), 0) AS bad
  FROM started s LEFT JOIN lineitem ON s.file_name = 'f' || l_orderkey || '.csv' GROUP BY s.id)
SELECT s.id, s.job_id, s.file_name, CASE WHEN bad = 1 THEN 'ERROR' ELSE 'SUCCESS' END AS process_status,
  CASE WHEN bad = 1 THEN 0 ELSE n END AS records_processed,
  CASE WHEN bad = 1 THEN '/failed/' ELSE '/done/' END || right(folder, 1) || '/' || s.file_name AS destination FROM started s JOIN r USING (id)""")
def finish_loads(spark, folder):
    """Order lines are the loaded rows of their order's file; a large return refuses the file."""
    started = _started(spark, folder)
    lines = table(spark, folder, "lineitem").select(
        F.concat(F.lit("f"), F.col("l_orderkey").cast("string"), F.lit(".csv")).alias("file_name"), "l_returnflag", "l_quantity")
    rows = lines.join(started.select("file_name", F.col("id").alias("source_file_id")), "file_name")
    done = control.finish_loads(started, rows, rows.filter("l_returnflag = 'R' AND l_quantity > 45"))
    return control.route(done, _jobs(spark, folder)).select(
        "id", "job_id", "file_name", "process_status", "records_processed", "destination")


@query("load_ledger", """
SELECT user_id, event_id AS id, event_type AS process_status, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS n FROM events) WHERE n = 1""")
def load_ledger(spark, folder):
    rows = table(spark, folder, "events").select(
        "user_id", F.col("event_id").alias("id"), F.col("event_type").alias("process_status"), "value")
    return control.latest_status(rows, ["user_id"], ["id"], ["process_status", "value"])


@query("retention", f"""WITH {_FILES}
SELECT path, mtime FROM files WHERE file_name GLOB 'f*5*.csv' AND (
  (folder = '/in/F' AND mtime < TIMESTAMP '2024-01-01' - INTERVAL 9000 DAY) OR (folder = '/in/P' AND mtime < TIMESTAMP '2024-01-01' - INTERVAL 10000 DAY))""")
def retention(spark, folder):
    archived = _files(spark, folder).withColumn("folder", F.replace("folder", F.lit("/in/"), F.lit("/done/")))
    return control.retention(archived, _jobs(spark, folder), "2024-01-01").select("path", "mtime")
