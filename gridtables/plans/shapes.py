"""File shapes at scale: the given tables are printed as lines of files, which the readers take apart again.

Every file of a query is one group of table rows, so the amount of text grows with the tables.
"""

from pyspark.sql import functions as F

from gridtables.operators import positional
from gridtables.plans import loads
from gridtables.plans.registry import query, table
from gridtables.session import cut_lineage, staged
from gridtables.sources import delimited, environmental, exchange, forecast, meter
from gridtables.sources.lines import lost_by_file as lost_counts

_END = 1_000_000_000_000


def _lines(*parts):
    """Parts (file, line_no, line) as the lines of files."""
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    rows = rows.withColumn("line_no", F.col("line_no").cast("long")).withColumn("chunk", F.expr(f"line_no div {positional.CHUNK_ROWS}"))
    return staged(rows)  # stands for the files, which are written once


def _at(files, line_no, line):
    return files.select("file", F.lit(line_no).alias("line_no"), (F.lit(line) if isinstance(line, str) else line).alias("line"))


def _joined(*cells, sep=","):
    return F.concat_ws(sep, *[F.coalesce(c.cast("string"), F.lit("")) for c in cells])


# --- meter data: a user's events are half-hourly readings ---------------------------------------------


def _meter_lines(spark, folder):
    events = table(spark, folder, "events").select(
        F.concat(F.lit("NEM12#U"), F.col("user_id").cast("string"), F.lit("#MDA#RET.csv")).alias("file"), "user_id", "event_type", "value",
        F.unix_date(F.col("ts").cast("date")).alias("day"), (F.hour("ts") * 2 + F.floor(F.minute("ts") / 30)).alias("slot"))
    files = events.groupBy("file", "user_id").agg(F.max(F.when(F.col("event_type") == "purchase", F.col("value"))).alias("top"))
    unit = F.when(F.col("top") > 200, "kwhx").otherwise("kWh")
    stream = _joined(F.lit("200"), F.concat(F.lit("U"), F.lpad(F.col("user_id").cast("string"), 9, "0")), *[F.lit(x) for x in ("E1", "1", "E1", "N1", "M1")], unit, F.lit("30"), F.lit(""))

    def shown(value):
        return F.when(value.isNull(), "0.00").otherwise(value.cast("decimal(10,2)").cast("string"))

    days = events.groupBy("file", "day").agg(
        F.array(*[shown(F.max(F.when(F.col("slot") == s, F.col("value")))) for s in range(48)]).alias("v"),
        F.max(F.when(F.col("event_type") == "error", 1).otherwise(0)).alias("mixed"))
    readings = F.concat_ws(",", F.lit("300"), F.date_format(F.date_from_unix_date("day"), "yyyyMMdd"), F.col("v"),
                           F.when(F.col("mixed") == 1, "V").otherwise("A"), F.lit(""), F.lit(""), F.lit("20240301000000"), F.lit(""))
    first = F.col("day") * 4 + 2

    def row(at, line):
        return F.struct(at.cast("long").alias("line_no"), line.alias("line"))

    def rows(df, *each):
        return df.select("file", F.explode(F.filter(F.array(*each), lambda x: x.isNotNull())).alias("row")).select("file", "row.line_no", "row.line")

    mixed = F.col("mixed") == 1
    return _lines(
        rows(files, row(F.lit(0), F.lit("100,NEM12,202403010000,MDA,RET")), row(F.lit(1), stream), row(F.lit(_END), F.lit("900"))),
        rows(days, row(first, readings), F.when(mixed, row(first + 1, F.lit("400,1,20,A,,"))), F.when(mixed, row(first + 2, F.lit("400,21,48,F14,76,"))),
             F.when(mixed, row(first + 3, F.lit("500,O,S1,20240301000000,"))),
             F.when(~mixed & (F.col("day") % 3 == 0), row(first + 1, F.lit("400,1,48,A,,")))),
    )


@query("meter_intervals", """
WITH e AS (SELECT user_id, event_type, value, CAST(ts AS DATE) AS day, hour(ts) * 2 + minute(ts) // 30 + 1 AS slot FROM events),
u AS (SELECT user_id FROM e GROUP BY user_id HAVING coalesce(max(value) FILTER (WHERE event_type = 'purchase'), 0) <= 200),
d AS (SELECT user_id, day, bool_or(event_type = 'error') AS mixed FROM e JOIN u USING (user_id) GROUP BY ALL),
v AS (SELECT user_id, day, slot, max(value) AS value FROM e GROUP BY ALL)
SELECT 'NEM12#U' || d.user_id || '#MDA#RET.csv' AS file, CAST(d.day AS TIMESTAMP) + to_minutes(CAST(s * 30 AS INTEGER)) AS interval_end,
  CAST(s AS INTEGER) AS interval, coalesce(v.value, 0) AS value, CASE WHEN mixed AND s > 20 THEN 'F14' ELSE 'A' END AS quality,
  CASE WHEN mixed AND s > 20 THEN 76 END AS reason
FROM d, range(1, 49) r(s) LEFT JOIN v ON v.user_id = d.user_id AND v.day = d.day AND v.slot = s""")
def meter_intervals(spark, folder):
    """Interval meter files are checked, quarantined where a unit is wrong, and unrolled with their quality ranges."""
    data = meter.parse(_meter_lines(spark, folder))
    rows = meter.with_quality(meter.long_intervals(data.readings), data.quality)
    return rows.select(
        "file", "interval_end", "interval", F.col("value").cast("double").alias("value"), F.col("QualityMethod").alias("quality"),
        F.col("ReasonCode").cast("int").alias("reason"))


@query("meter_rejects", """
SELECT 'NEM12#U' || user_id || '#MDA#RET.csv' AS file, CAST(1 AS BIGINT) AS line_no, 'invalid UOM' AS reason FROM events
GROUP BY user_id HAVING max(value) FILTER (WHERE event_type = 'purchase') > 200""")
def meter_rejects(spark, folder):
    return meter.parse(_meter_lines(spark, folder)).rejects


@query("meter_prefix", """
SELECT 'NEM12#U' || user_id || '#MDA#RET.csv' AS file, CAST(0 AS BIGINT) AS line_no, 'NEM12' AS version, 'MDA' AS sender FROM events GROUP BY user_id""")
def meter_prefix(spark, folder):
    """With prefix mode the lines before the first fault stay, here at least every file's header."""
    files = meter.parse(_meter_lines(spark, folder), mode="prefix").files
    return files.select("file", "line_no", F.col("VersionHeader").alias("version"), F.col("FromParticipant").alias("sender"))


def _faulty_lines(spark, folder):
    """The meter files with units that fit and, by the user, one of six faults, or none: in the header, the stream, the first or last
    day's readings, the first quality range of its kind, the first transaction."""
    lines = _meter_lines(spark, folder).withColumn("line", F.replace("line", F.lit("kwhx"), F.lit("kWh")))
    user = F.regexp_extract("file", "#U([0-9]+)#", 1).cast("long")
    fault, kind = user % 7, F.substring("line", 1, 3)
    places = lines.groupBy("file").agg(
        F.min(F.when(kind == "300", F.col("line_no"))).alias("first"), F.max(F.when(kind == "300", F.col("line_no"))).alias("last"),
        F.min(F.when(F.col("line").startswith("400,21,"), F.col("line_no"))).alias("range"), F.min(F.when(kind == "500", F.col("line_no"))).alias("sent"))
    at = F.col("line_no")
    spoilt = (
        F.when((fault == 1) & (at == 0), F.replace("line", F.lit("NEM12"), F.lit("NEM13X")))
        .when((fault == 2) & (at == 1), F.replace("line", F.lit("kWh"), F.lit("miles")))
        .when((fault == 3) & (at == F.col("first")), F.concat("line", F.lit(",more")))
        .when((fault == 4) & (at == F.col("last")), F.regexp_replace("line", r"^(300,[0-9]+),[0-9.]+", "$1,1.2.3"))
        .when((fault == 5) & (at == F.col("range")), F.replace("line", F.lit("400,21,"), F.lit("400,22,")))
        .when((fault == 6) & (at == F.col("sent")), F.replace("line", F.lit("500,O,"), F.lit("500,Q,"))))
    return cut_lineage(lines.join(places, "file").select("file", "line_no", F.coalesce(spoilt, "line").alias("line"), "chunk"))


_FAULTS = """WITH d AS (
  SELECT user_id, date_diff('day', DATE '1970-01-01', CAST(ts AS DATE)) * 4 + 2 AS pos, bool_or(event_type = 'error') AS mixed FROM events GROUP BY ALL),
p AS (SELECT user_id, min(pos) AS first, max(pos) AS last, min(pos) FILTER (WHERE mixed) AS mixed FROM d GROUP BY user_id),
f AS (SELECT user_id, 'NEM12#U' || user_id || '#MDA#RET.csv' AS file,
  CASE user_id % 7 WHEN 1 THEN 0 WHEN 2 THEN 1 WHEN 3 THEN first WHEN 4 THEN last WHEN 5 THEN mixed + 2 WHEN 6 THEN mixed + 3 END AS line_no,
  CASE user_id % 7 WHEN 1 THEN 'VersionHeader: invalid V5 value' WHEN 2 THEN 'invalid UOM' WHEN 3 THEN 'wrong number of fields' WHEN 4 THEN 'invalid IntervalValue'
    WHEN 5 THEN 'interval range does not follow the one before' WHEN 6 THEN 'invalid TransCode' END AS reason FROM p)"""


@query("meter_faults", f"{_FAULTS} SELECT file, CAST(line_no AS BIGINT) AS line_no, reason FROM f WHERE line_no IS NOT NULL")
def meter_faults(spark, folder):
    """Six kinds of faults, one in lines of each record type."""
    return meter.parse(_faulty_lines(spark, folder)).rejects


@query("meter_prefix_records", f"""{_FAULTS}
SELECT f.file, CASE WHEN line_no = 0 THEN 0 ELSE 1 END::BIGINT AS files, CASE WHEN line_no <= 1 THEN 0 ELSE 1 END::BIGINT AS streams,
  count(*) FILTER (WHERE pos < coalesce(line_no, 1000000000000)) AS readings,
  count(*) FILTER (WHERE mixed AND pos + 1 < coalesce(line_no, 1000000000000)) AS first_ranges,
  count(*) FILTER (WHERE mixed AND pos + 2 < coalesce(line_no, 1000000000000)) AS second_ranges,
  count(*) FILTER (WHERE mixed AND pos + 3 < coalesce(line_no, 1000000000000)) AS transactions FROM f JOIN d USING (user_id) GROUP BY ALL""")
def meter_prefix_records(spark, folder):
    """With prefix mode the records before a file's first faulty line stay, whatever type of line that is."""
    data = meter.parse(_faulty_lines(spark, folder), mode="prefix")
    files = table(spark, folder, "events").select(F.concat(F.lit("NEM12#U"), F.col("user_id").cast("string"), F.lit("#MDA#RET.csv")).alias("file")).distinct()

    def count(df, name):
        return df.groupBy("file").agg(F.count("*").alias(name))

    mixed = data.quality.filter("line_no <> reading_line")  # ranges of their own record
    parts = [count(data.files, "files"), count(data.streams, "streams"), count(data.readings, "readings"),
             count(mixed.filter("StartInterval = 1 AND EndInterval = 20"), "first_ranges"), count(mixed.filter("StartInterval = 21"), "second_ranges"),
             count(data.b2b, "transactions")]
    for part in parts:
        files = files.join(part, "file", "left")
    return files.na.fill(0)


# --- exchange files: a month of orders is one file -----------------------------------------------------

_MONTH = "date_trunc('month', o_orderdate)"


def _monthly(spark, folder, name):
    month = F.date_trunc("month", "o_orderdate")
    orders = table(spark, folder, "orders").withColumn("month", month)
    return orders.withColumn("file", F.concat(F.lit(name + "_"), F.date_format("month", "yyyyMM"), F.lit(".txt")))


@query("positional_table", f"""
SELECT 'Settlement_Futures_' || strftime(o_orderdate, '%Y%m') || '.txt' AS file, o_orderpriority AS "NSW_Period", o_totalprice AS "NSW_Peak_Price",
  CASE WHEN o_orderstatus = 'P' THEN 0 ELSE CAST(o_custkey AS DOUBLE) END AS "NSW_OffPeak_Price", CAST(o_orderkey AS DOUBLE) AS "NSW_Base_Price",
  o_orderstatus AS "SA_Period", NULL AS "SA_Peak_Price", CAST(0 AS DOUBLE) AS "SA_Base_Price", CAST({_MONTH} AS TIMESTAMP) AS "Settlement_Date" FROM orders""")
def positional_table(spark, folder):
    orders = _monthly(spark, folder, "Settlement_Futures")
    titles = orders.select("file", "month").distinct()
    off = F.when(F.col("o_orderstatus") == "P", "-").otherwise(F.col("o_custkey").cast("string"))
    none = F.lit("")
    row = _joined(F.col("o_orderpriority"), F.col("o_totalprice"), off, F.col("o_orderkey"), *[none] * 8, F.col("o_orderstatus"), none, F.lit("1"), F.lit("-"), sep="\t")
    lines = _lines(
        _at(titles, 0, F.concat(F.lit("title" + "\t" * 11), F.date_format("month", "dd MMM yyyy"))), _at(titles, 1, "NSW\tPeak\tOff\tBase"),
        orders.select("file", (F.col("o_orderkey") + 2).alias("line_no"), row.alias("line")))
    rows = exchange.read_positional(lines, exchange.POSITIONAL["settlement_futures"]).rows
    return rows.select(
        "file", "NSW_Period", "NSW_Peak_Price", "NSW_OffPeak_Price", "NSW_Base_Price", "SA_Period", "SA_Peak_Price", "SA_Base_Price",
        F.col("Settlement_Date").cast("timestamp_ntz").alias("Settlement_Date"))


@query("snapshot_table", f"""
WITH o AS (SELECT 'ClosingSnapshot_Futures_20' || strftime(o_orderdate, '%y%m') || '01.csv' AS file, o_orderkey, 'C' || o_custkey AS code, o_totalprice AS price,
    CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE o_totalprice END AS high, CASE WHEN o_orderstatus = 'P' OR o_orderkey % 11 = 0 THEN NULL ELSE {_MONTH} END AS day,
    o_orderkey % 11 = 0 AS unread,
    CAST(o_orderdate AS TIMESTAMP) AS traded, CAST('20' || strftime(o_orderdate, '%y-%m') || '-01' AS TIMESTAMP) AS named FROM orders),
f AS (SELECT file, coalesce(first(day ORDER BY o_orderkey), any_value(named)) AS day FROM o GROUP BY file)
SELECT o.file, code AS "Code", CAST(CASE WHEN NOT unread THEN coalesce(o.day, f.day) END AS TIMESTAMP) AS "Settlement_Date", max(price) AS "Bid_Price", min(high) AS "High_Price",
  max(price) AS "Low_Price", max(traded) AS "Trade_Date", max(strftime(traded, '%d:%m')) AS "Trade_Time" FROM o JOIN f USING (file) GROUP BY ALL""")
def snapshot_table(spark, folder):
    """Dates in two patterns, missing or unreadable, and several rows per code, which are resolved to one."""
    rows = exchange.read_headed(_snapshot_lines(spark, folder), exchange.HEADED["closing_snapshot_futures"]).rows
    return rows.select(
        "file", "Code", F.col("Settlement_Date").cast("timestamp_ntz").alias("Settlement_Date"), "Bid_Price", "High_Price", "Low_Price",
        F.col("Trade_Date").cast("timestamp_ntz").alias("Trade_Date"), "Trade_Time")


@query("snapshot_rejects", """
SELECT 'ClosingSnapshot_Futures_20' || strftime(o_orderdate, '%y%m') || '01.csv' AS file, o_orderkey + 1 AS line_no,
  CASE WHEN o_orderkey % 11 = 0 THEN 'no date in Settlement_Date' ELSE 'no number in Bid_Size' END AS reason
FROM orders WHERE o_orderkey % 11 = 0 OR o_orderkey % 13 = 0""")
def snapshot_rejects(spark, folder):
    """Lines whose texts are no date or no number where one belongs, with the first reason by name."""
    rejects = exchange.read_headed(_snapshot_lines(spark, folder), exchange.HEADED["closing_snapshot_futures"]).rejects
    return rejects.groupBy("file", "line_no").agg(F.min("reason").alias("reason"))


def _snapshot_lines(spark, folder):
    date, price = F.col("o_orderdate"), F.col("o_totalprice")
    file = F.concat(F.lit("ClosingSnapshot_Futures_20"), F.date_format(date, "yyMM"), F.lit("01.csv"))
    day = F.when(F.col("o_orderstatus") == "F", F.date_format("month", "yyyy/MM/dd")).when(F.col("o_orderstatus") == "O", F.date_format("month", "d/M/yyyy"))
    day = F.when(F.col("o_orderkey") % 11 == 0, F.date_format("month", "yyyy-MM-dd")).otherwise(day)
    high = F.when(F.col("o_orderpriority") != "5-LOW", price)
    none = F.lit("")
    size = F.when(F.col("o_orderkey") % 13 == 0, F.lit("many"))
    row = _joined(
        F.concat(F.lit("C"), F.col("o_custkey").cast("string")), F.date_format(date, "yyyy/MM/dd"), price, size, *[none] * 7, high, price, none, day,
        F.date_format(date, "dd/MM/yyyy"), F.date_format(date, "dd:MM"))
    orders = _monthly(spark, folder, "x").withColumn("file", file)
    return _lines(_at(orders.select("file").distinct(), 0, "Code,Expiration"),
                  orders.select("file", (F.col("o_orderkey") + 1).alias("line_no"), row.alias("line")))


@query("option_blocks", """
WITH e AS (SELECT user_id, event_id, event_type, value, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS n FROM events),
m AS (SELECT *, sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY n) AS block FROM e),
r AS (SELECT *, row_number() OVER (PARTITION BY user_id, block ORDER BY n) AS block_row, first_value(event_type) OVER w AS lead,
    first_value(event_id) OVER w AS period FROM m WHERE event_type <> 'error' AND block > 0 WINDOW w AS (PARTITION BY user_id, block ORDER BY n))
SELECT 'u' || user_id AS file, CASE WHEN event_type <> 'signup' THEN value END AS "NSW_Call_OI", CAST(event_id AS DOUBLE) AS "NSW_Strike",
  CAST(period AS VARCHAR) AS "NSW_Period", 'Q1' AS "VIC_Period", TIMESTAMP '2002-09-03' AS "Settlement_Date" FROM r WHERE lead = 'signup' AND block_row > 3""")
def option_blocks(spark, folder):
    """Errors print as empty lines and signups as region lines; a block counts if it starts with one."""
    events = table(spark, folder, "events").select(
        F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("file"), "event_id", "event_type", "value")
    rows = positional.numbered(events, ["file"], "event_id")
    line = (
        F.when(F.col("event_type") == "error", "")
        .when(F.col("event_type") == "signup", F.concat(F.lit("NSW\t"), F.col("event_id").cast("string"), F.lit("\t\tVIC\tQ1\t")))
        .otherwise(_joined(F.col("value"), F.col("event_id"), F.lit(""), F.lit(""), sep="\t"))
    )
    files = rows.filter("row_no = 0").select("file")
    lines = _lines(_at(files, 0, "title\ttitle\t03 Sep 2002"), _at(files, 1, "\t"), _at(files, 2, ""),
                   rows.select("file", (F.col("row_no") + 3).alias("line_no"), line.alias("line")))
    found = exchange.read_option_blocks(lines).rows
    return found.select("file", "NSW_Call_OI", "NSW_Strike", "NSW_Period", "VIC_Period", F.col("Settlement_Date").cast("timestamp_ntz").alias("Settlement_Date"))


@query("rate_card", """
WITH one AS (SELECT c_nationkey AS n, c_custkey AS k, c_name AS p, CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS a, abs(c_acctbal) AS b FROM customer),
two AS (SELECT s_nationkey AS n, s_suppkey AS k, s_name AS p, abs(s_acctbal) AS a, CASE WHEN s_acctbal >= 2000 THEN s_acctbal END AS b FROM supplier),
f AS (SELECT n FROM one INTERSECT SELECT n FROM two),
s1 AS (SELECT n, min(k) AS lo, max(k) AS hi FROM one WHERE a IS NOT NULL GROUP BY n),
s2 AS (SELECT n, min(k) AS lo, max(k) AS hi FROM two WHERE b IS NOT NULL GROUP BY n)
SELECT 'card' || n AS file, p AS "Period", a AS "PEAK_Swap", b AS "FLAT_Swap", NULL AS "NSLP_Swap", TIMESTAMP '2016-06-14 10:00:00' AS "File_Creation_Date"
  FROM one JOIN f USING (n) JOIN s1 USING (n) WHERE k BETWEEN lo AND hi
UNION ALL SELECT 'card' || n, p, NULL, a, b, TIMESTAMP '2016-06-14 10:00:00' FROM two JOIN f USING (n) JOIN s2 USING (n) WHERE k BETWEEN lo AND hi""")
def rate_card(spark, folder):
    """Customers and suppliers of a nation as the two stacked price tables of its card."""
    def text(price):
        return F.concat(F.lit("$"), price.cast("string"))

    customer, supplier = table(spark, folder, "customer"), table(spark, folder, "supplier")
    first = customer.select(
        F.concat(F.lit("card"), F.col("c_nationkey").cast("string")).alias("file"), (F.col("c_custkey") + 3).alias("line_no"),
        _joined(F.col("c_name"), F.when(F.col("c_acctbal") >= 0, text(F.col("c_acctbal"))), text(F.col("c_acctbal")), F.lit(""), F.lit("")).alias("line"))
    second = supplier.select(
        F.concat(F.lit("card"), F.col("s_nationkey").cast("string")).alias("file"), (F.col("s_suppkey") + _END + 1).alias("line_no"),
        _joined(F.col("s_name"), text(F.col("s_acctbal")), F.lit(""), F.when(F.col("s_acctbal") >= 2000, text(F.col("s_acctbal"))), F.lit("")).alias("line"))
    files = first.select("file").distinct()
    headed = files.join(second.select("file").distinct(), "file", "left_semi")
    lines = _lines(
        _at(files, 0, "File creation time:,14/06/2016 10:00"), _at(files, 1, ",,,,"), _at(files, 2, ",PEAK Swap,FLAT Swap,$300 Flat Cap*,"),
        first, _at(headed, _END, ",Flat Swap,$300 Flat Cap*,NSLP Swap,"), second)
    rows = exchange.read_rate_card(lines).rows
    return rows.select("file", "Period", *[F.col(c).cast("double").alias(c) for c in ("PEAK_Swap", "FLAT_Swap", "NSLP_Swap")], "File_Creation_Date")


@query("closing_prices", """
SELECT coalesce(CASE WHEN c_acctbal < 0 THEN NULL ELSE c_mktsegment END, 'ESC') AS instrument, CASE WHEN c_acctbal > 5000 THEN 'Fwd' ELSE 'Spot' END AS tenor_type,
  c_name AS tenor, c_acctbal AS bid, CAST(c_nationkey AS INTEGER) AS bid_method, CAST('2018-10-' || lpad(CAST(c_nationkey + 1 AS VARCHAR), 2, '0') AS TIMESTAMP) AS date
FROM customer WHERE c_mktsegment <> 'MACHINERY'""")
def closing_prices(spark, folder):
    """Certificate prices: rows without a tenor are dropped, missing instruments and tenor types get defaults."""
    customer = table(spark, folder, "customer").withColumn(
        "file", F.concat(F.lit("Rates 2018-10-"), F.lpad((F.col("c_nationkey") + 1).cast("string"), 2, "0"), F.lit(".csv")))
    balance = F.col("c_acctbal")
    row = _joined(
        F.when(balance >= 0, F.col("c_mktsegment")), F.when(balance > 5000, "Fwd"), F.when(F.col("c_mktsegment") != "MACHINERY", F.col("c_name")),
        F.lit("2018"), balance, balance, balance, F.col("c_nationkey"), F.lit("1"), F.lit("A"), F.lit(""))
    lines = _lines(
        _at(customer.select("file").distinct(), 0, "Instrument,Tenor Type,Tenor,Settle,Bid,Offer,Mid,Bid Method,Offer Method,Mid Method,"),
        customer.select("file", (F.col("c_custkey") + 1).alias("line_no"), row.alias("line")))
    rows = environmental.read_closing_prices(lines).rows
    return rows.select("instrument", "tenor_type", "tenor", "bid", "bid_method", F.col("date").cast("timestamp_ntz").alias("date"))


@query("topped_and_tailed", """
SELECT 'w' || user_id AS file, CAST(event_id AS VARCHAR) AS id_num, event_type AS name, date_trunc('minute', ts) AS date_time,
  CASE WHEN event_type = 'error' THEN NULL ELSE value END AS air_temp FROM events""")
def topped_and_tailed(spark, folder):
    """Weather files: payload between markers, missing values, and a date and a time column read as one moment."""
    events = table(spark, folder, "events").withColumn("file", F.concat(F.lit("w"), F.col("user_id").cast("string")))
    row = _joined(
        F.col("event_id"), F.concat(F.lit(" "), F.col("event_type")), F.date_format("ts", "yyyyMMdd"), F.date_format("ts", "HHmm"),
        F.when(F.col("event_type") == "error", F.lit(-9999)).otherwise(F.col("value")))
    files = events.select("file").distinct()
    lines = _lines(
        _at(files, 0, "junk, [metar2Data] is next"), _at(files, 1, "[metar2Data]"), _at(files, 2, "id num,name,date,time,air temp [1]"),
        events.select("file", (F.col("event_id") + 3).alias("line_no"), row.alias("line")), _at(files, _END, "[$]"), _at(files, _END + 1, "tail [$]"))
    rows = delimited.read_delimited(lines, delimited.FEEDS["aws_weather"]).rows
    return rows.select("file", "id_num", "name", "date_time", F.col("air_temp").try_cast("double").alias("air_temp"))


def _mixed_lines(spark, folder):
    """A user's events as a file, under one of two headings; some users' files hold a row that is too long."""
    events = table(spark, folder, "events").withColumn("file", F.concat(F.lit("m"), F.col("user_id").cast("string")))
    swapped = F.col("user_id") % 2 == 1
    head = F.when(swapped, "id,note,value").otherwise("id,kind")
    long = (F.col("user_id") % 5 == 0) & (F.col("event_type") == "error")
    row = F.when(swapped, _joined(F.col("event_id"), F.col("event_type"), F.col("value"))).otherwise(_joined(F.col("event_id"), F.col("event_type")))
    row = F.when(long, F.concat(row, F.lit(",one,two"))).otherwise(row)
    return _lines(_at(events.select("file", "user_id").distinct(), 0, head), events.select("file", (F.col("event_id") + 1).alias("line_no"), row.alias("line")))


_TOO_LONG = "user_id % 5 = 0 AND user_id IN (SELECT user_id FROM events WHERE event_type = 'error')"


@query("mixed_headings", f"""
SELECT 'm' || user_id AS file, CAST(event_id AS VARCHAR) AS id, CASE WHEN user_id % 2 = 0 THEN event_type END AS kind,
  CASE WHEN user_id % 2 = 1 THEN event_type END AS note, CASE WHEN user_id % 2 = 1 THEN value END AS value FROM events WHERE NOT ({_TOO_LONG})""")
def mixed_headings(spark, folder):
    """Files of two headings in one read, each by its own; a file with a row that is too long is refused."""
    rows = delimited.read_delimited(_mixed_lines(spark, folder), delimited.Delimited()).rows
    return rows.select("file", "id", "kind", "note", F.col("value").try_cast("double").alias("value"))


@query("mixed_headings_rejects", f"""
SELECT DISTINCT 'm' || user_id AS file, 'a row with more cells than the heading' AS reason FROM events WHERE {_TOO_LONG}""")
def mixed_headings_rejects(spark, folder):
    return delimited.read_delimited(_mixed_lines(spark, folder), delimited.Delimited()).rejects.select("file", "reason")


# --- forecasts: a user's events are the periods of an area ------------------------------------------------


def _forecast_texts(spark, folder):
    """A document for each user: events as periods, purchases with a temperature; some documents break off."""
    events = table(spark, folder, "events").select("user_id", "event_id", "event_type", "value", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("at"))
    kind, number = F.col("event_type"), F.col("value").cast("string")
    maximum = F.concat(F.lit('<element type="air_temperature_maximum">'), F.when(kind == "purchase", number).otherwise(""), F.lit("</element>"))
    period = F.concat(
        F.lit('<forecast-period index="'), F.col("event_id").cast("string"), F.lit('" start-time-utc="'), F.col("at"), F.lit('">'),
        F.when(kind.isin("purchase", "error"), maximum).otherwise(""),
        F.when(kind != "error", F.concat(F.lit('<text type="precis">'), kind, F.lit(" &amp; fine</text>"))).otherwise(""), F.lit("</forecast-period>"))
    body = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("event_id", period.alias("p")))), lambda s: s["p"]), "\n")
    users = events.groupBy("user_id").agg(body.alias("body"))
    name = F.col("user_id").cast("string")
    text = F.concat(F.lit('<?xml version="1.0"?>\n<product><amoc/><forecast><area aac="A'), name, F.lit('" description="Town '), name, F.lit('" type="location">'),
                    F.col("body"), F.lit("</area></forecast></product>"))
    cut = F.substr(text, F.lit(1), F.length(text) - 25)
    return users.select(F.concat(F.lit("f"), name, F.lit(".xml")).alias("file"), F.when(F.col("user_id") % 7 == 3, cut).otherwise(text).alias("text"))


@query("forecast_rows", """
SELECT 'f' || user_id || '.xml' AS file, 'A' || user_id AS aac, 'Town ' || user_id AS description, CAST(event_id AS DOUBLE) AS "index",
  strftime(ts, '%Y-%m-%dT%H:%M:%S') AS start_time_utc, CASE WHEN event_type = 'purchase' THEN value END AS air_temperature_maximum,
  CASE WHEN event_type <> 'error' THEN event_type || ' & fine' END AS precis FROM events WHERE user_id % 7 <> 3""")
def forecast_rows(spark, folder):
    rows = forecast.parse_forecasts(_forecast_texts(spark, folder)).rows
    return rows.select("file", "aac", "description", "index", "start_time_utc", "air_temperature_maximum", "precis")


@query("forecast_carried", """
SELECT 'f' || user_id || '.xml' AS file, CAST(event_id AS DOUBLE) AS "index", CASE WHEN last_kind = 'purchase' THEN last_value END AS air_temperature_maximum,
  last_word || ' & fine' AS precis FROM (
  SELECT *, max_by(event_type, event_id) FILTER (WHERE event_type IN ('purchase', 'error')) OVER w AS last_kind,
    max_by(value, event_id) FILTER (WHERE event_type IN ('purchase', 'error')) OVER w AS last_value,
    max_by(event_type, event_id) FILTER (WHERE event_type <> 'error') OVER w AS last_word
  FROM events WHERE user_id % 7 <> 3 WINDOW w AS (PARTITION BY user_id ORDER BY event_id))""")
def forecast_carried(spark, folder):
    """A type that a period lacks keeps the value of an earlier one; one that is empty has none."""
    rows = forecast.parse_forecasts(_forecast_texts(spark, folder), carry_forward=True).rows
    return rows.select("file", "index", "air_temperature_maximum", "precis")


@query("forecast_rejects", "SELECT DISTINCT 'f' || user_id || '.xml' AS file, 'not well-formed XML' AS reason FROM events WHERE user_id % 7 = 3")
def forecast_rejects(spark, folder):
    return forecast.parse_forecasts(_forecast_texts(spark, folder)).rejects.select("file", "reason")


# --- lost cells, a query for each shape of file -----------------------------------------------------------


@query("positional_rejects", """
WITH o AS (SELECT 'Settlement_Futures_' || strftime(o_orderdate, '%Y%m') || '.txt' AS file, o_orderkey + 2 AS line_no, o_orderkey AS k, o_totalprice AS p FROM orders)
SELECT file, line_no, 'NSW_Peak_Price' AS "column", 'n/a' AS text, 'no number in NSW_Peak_Price' AS reason FROM o WHERE k % 7 = 0
UNION ALL SELECT file, line_no, NULL, 'over' || chr(9) || 'done', 'more cells than columns' FROM o WHERE k % 5 = 0
UNION ALL SELECT file, line_no, 'SA_OffPeak_Price', NULL, 'fewer cells than columns' FROM o WHERE k % 5 = 1""")
def positional_rejects(spark, folder):
    """Tab-separated rows with a text for a number, cells beyond the regions' columns, or too few cells."""
    orders = _monthly(spark, folder, "Settlement_Futures")
    key = F.col("o_orderkey")
    price = F.when(key % 7 == 0, "n/a").otherwise(F.col("o_totalprice").cast("string"))
    row = _joined(F.col("o_orderpriority"), price, F.lit("-"), key, *[F.lit("")] * 8, F.lit("SA"), F.lit("1"), sep="\t")
    row = F.when(key % 5 == 1, row).when(key % 5 == 0, F.concat(row, F.lit("\t-\t2\tover\tdone"))).otherwise(F.concat(row, F.lit("\t-\t2\t")))
    title = F.concat(F.lit("title" + "\t" * 11), F.date_format("month", "dd MMM yyyy"))
    lines = _lines(_at(orders.select("file", "month").distinct(), 0, title), _at(orders.select("file").distinct(), 1, "NSW"),
                   orders.select("file", (key + 2).alias("line_no"), row.alias("line")))
    return exchange.read_positional(lines, exchange.POSITIONAL["settlement_futures"]).rejects.select("file", "line_no", "column", "text", "reason")


@query("option_rejects", """
WITH e AS (SELECT user_id, event_id, event_type, value, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS n FROM events)
SELECT 'u' || user_id AS file, n + 6 AS line_no, 'VIC_Strike' AS "column", event_type AS text, 'no number in VIC_Strike' AS reason FROM e WHERE event_type <> 'view'""")
def option_rejects(spark, folder):
    """One block of a user's events, with words where strikes belong."""
    events = table(spark, folder, "events").select(F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("file"), "event_id", "event_type", "value")
    rows = positional.numbered(events, ["file"], "event_id")
    word = F.when(F.col("event_type") != "view", F.col("event_type")).otherwise("1.5")
    line = _joined(F.col("value"), F.lit("2"), F.lit("-1"), F.lit("3"), word, *[F.lit("")] * 7, sep="\t")
    files = rows.filter("row_no = 0").select("file")
    lead = "\t".join(["NSW", "Q1", "", "VIC", "Q1", "", "QLD", "", "", "SA", "", ""])
    lines = _lines(*[_at(files, i, text) for i, text in enumerate(("title\ttitle\t03 Sep 2002", "\t", "", "", lead, "h", "h"))],
                   rows.select("file", (F.col("row_no") + 7).alias("line_no"), line.alias("line")))
    return exchange.read_option_blocks(lines).rejects.select("file", "line_no", "column", "text", "reason")


@query("rate_card_rejects", """
WITH s2 AS (SELECT s_nationkey AS n, min(s_suppkey) AS lo, max(s_suppkey) AS hi FROM supplier GROUP BY n)
SELECT 'card' || s_nationkey AS file, s_suppkey + 10 AS line_no, c AS "column", t AS text, r AS reason FROM supplier, (VALUES
  (0, 'FLAT_Swap', 'tba', 'no price in FLAT_Swap'), (1, 'NSLP_Swap', '$1.2.3', 'no price in NSLP_Swap'), (2, NULL, 'note', 'more cells than columns')) v(i, c, t, r)
WHERE s_suppkey % 4 = i""")
def rate_card_rejects(spark, folder):
    """Suppliers as the second table of their nation's card, some prices no amounts of money."""
    key = F.col("s_suppkey")
    rows = table(spark, folder, "supplier").select(F.concat(F.lit("card"), F.col("s_nationkey").cast("string")).alias("file"), key.alias("k"), "s_name")
    k = F.col("k") % 4
    line = _joined(F.col("s_name"), F.when(k == 0, "tba").otherwise("$5.10"), F.lit("$1.00"), F.when(k == 1, "$1.2.3").otherwise("$2"), F.when(k == 2, "note"))
    files = rows.select("file").distinct()
    lines = _lines(*[_at(files, i, text) for i, text in enumerate((
        "File creation time:,14/06/2016 10:00", ",,,,", ",PEAK Swap,FLAT Swap,$300 Flat Cap*,", "Q1,$1,$2,$3,", ",Flat Swap,$300 Flat Cap*,NSLP Swap,"))],
        rows.select("file", (F.col("k") + 10).alias("line_no"), line.alias("line")),
        rows.groupBy("file").agg(F.min("k").alias("k")).select("file", (F.col("k") + 9).alias("line_no"), F.lit("first,$1,$1,$1,").alias("line")),
        _at(files, _END, "last,$1,$1,$1,"))
    return exchange.read_rate_card(lines).rejects.select("file", "line_no", "column", "text", "reason")


def _profile_lines(spark, folder):
    """Orders of a month as a load profile; some dates are no dates, some lines too short, some without their area."""
    orders = _monthly(spark, folder, "Profile")
    key = F.col("o_orderkey")
    day = F.when(key % 6 == 0, "soon").otherwise(F.date_format("o_orderdate", "yyyy/MM/dd"))
    area = F.when(key % 6 != 1, F.col("o_orderpriority"))
    made = F.when(key % 6 == 2, "2014/13/01 00:00:00").otherwise("2014/01/03 04:05:06")
    row = _joined(F.col("o_orderkey"), area, day, made, F.col("o_totalprice"))
    row = F.when(key % 6 == 3, F.substring_index(row, ",", 4)).otherwise(row)
    files = orders.select("file").distinct()
    return _lines(_at(files, 0, "<CSVData>"), _at(files, 1, "ProfileName,ProfileArea,SettlementDate,CreationDT,Period01"),
                  orders.select("file", (key + 2).alias("line_no"), row.alias("line")), _at(files, _END, "</CSVData>"))


_PROFILES = """WITH o AS (SELECT *, 'Profile_' || strftime(o_orderdate, '%Y%m') || '.txt' AS file, o_orderkey % 6 AS m FROM orders),
n AS (SELECT *, row_number() OVER (PARTITION BY file ORDER BY o_orderkey) AS line_no FROM o)"""


@query("delimited_rejects", f"""{_PROFILES}
SELECT file, line_no, 'settlementdate' AS "column", 'soon' AS text, 'no date in settlementdate' AS reason FROM n WHERE m = 0
UNION ALL SELECT file, line_no, 'settlementdate', NULL, 'no value in key settlementdate' FROM n WHERE m = 0
UNION ALL SELECT file, line_no, 'profilearea', NULL, 'no value in key profilearea' FROM n WHERE m = 1
UNION ALL SELECT file, line_no, 'creationdt', '2014/13/01 00:00:00', 'no date in creationdt' FROM n WHERE m = 2
UNION ALL SELECT file, line_no, 'period01', NULL, 'fewer cells than columns' FROM n WHERE m = 3""")
def delimited_rejects(spark, folder):
    """Load profiles: unreadable dates, short lines, and lines without a value in a key, which stay out."""
    found = delimited.read_delimited(_profile_lines(spark, folder), delimited.FEEDS["load_profile"], keys=delimited.KEYS["load_profile"])
    return found.rejects.select("file", "line_no", "column", "text", "reason")


@query("keyed_profile", f"""{_PROFILES}
SELECT file, line_no, CAST(o_orderkey AS VARCHAR) AS profilename, o_orderpriority AS profilearea, CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) AS settlementdate,
  CASE WHEN m <> 3 THEN o_totalprice END AS price FROM n WHERE m > 1""")
def keyed_profile(spark, folder):
    found = delimited.read_delimited(_profile_lines(spark, folder), delimited.FEEDS["load_profile"], keys=delimited.KEYS["load_profile"])
    return found.rows.select("file", "line_no", "profilename", "profilearea", "settlementdate", F.col("period01").cast("double").alias("price"))


def _keyless_lines(spark, folder):
    """A user's events as a file; the heading of every third user's file does not name the key."""
    events = table(spark, folder, "events").withColumn("file", F.concat(F.lit("k"), F.col("user_id").cast("string")))
    head = F.when(F.col("user_id") % 3 == 0, "number,value").otherwise("id,value")
    return _lines(_at(events.select("file", "user_id").distinct(), 0, head),
                  events.select("file", (F.col("event_id") + 1).alias("line_no"), _joined(F.col("event_id"), F.col("value")).alias("line")))


@query("key_check_rejects", "SELECT DISTINCT 'k' || user_id AS file, 'no key column id' AS reason FROM events WHERE user_id % 3 = 0")
def key_check_rejects(spark, folder):
    """Files without the key column are refused one by one, beside files that have it."""
    return delimited.read_delimited(_keyless_lines(spark, folder), delimited.Delimited(), keys=["id"]).rejects.select("file", "reason")


@query("lost_by_file", f"""{_PROFILES}
SELECT file, count(*) AS lines, sum(CASE WHEN m = 0 THEN 2 ELSE 1 END)::BIGINT AS cells FROM n WHERE m < 4 GROUP BY file""")
def lost_by_file(spark, folder):
    found = delimited.read_delimited(_profile_lines(spark, folder), delimited.FEEDS["load_profile"], keys=delimited.KEYS["load_profile"])
    return lost_counts(found.rejects)


# --- the other exchange files, each a month of orders ---------------------------------------------------


def _tab_file(spark, folder, name):
    """Positional lines of a month's orders for the feed's own columns and date cell; a dash where the status is P."""
    spec = exchange.POSITIONAL[name]
    orders = _monthly(spark, folder, name)
    each = len(spec.columns) // len(exchange.REGIONS)
    number = F.when(F.col("o_orderstatus") == "P", "-").otherwise(F.col("o_totalprice").cast("string"))
    nsw = [F.col("o_orderpriority"), number, F.col("o_orderkey")][:each]
    row = _joined(*nsw, *[F.lit("")] * (len(spec.columns) - 2 * each), *[F.lit("SA")] + [F.col("o_custkey")] * (each - 1), sep="\t")
    title = F.concat(F.lit("title" + "\t" * spec.date_cell), F.date_format("month", "dd MMM yyyy"))
    return _lines(_at(orders.select("file", "month").distinct(), 0, title), _at(orders.select("file").distinct(), 1, "NSW"),
                  orders.select("file", (F.col("o_orderkey") + 2).alias("line_no"), row.alias("line")))


def _tab_sql(name):
    columns = exchange.POSITIONAL[name].columns
    each = len(columns) // len(exchange.REGIONS)
    nsw = ["o_orderpriority", "CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END", "CAST(o_orderkey AS DOUBLE)"][:each]
    last = ["'SA'"] + ["CAST(o_custkey AS DOUBLE)"] * (each - 1)
    picked = [f'{v} AS "{c}"' for v, c in zip(nsw + last, columns[:each] + columns[-each:], strict=True)]
    return f"""SELECT '{name}_' || strftime(o_orderdate, '%Y%m') || '.txt' AS file, {", ".join(picked)},
      CAST({_MONTH} AS TIMESTAMP) AS "Settlement_Date" FROM orders"""


def _tab_query(name):
    @query(f"{name}_table", _tab_sql(name))
    def run(spark, folder):
        columns = exchange.POSITIONAL[name].columns
        each = len(columns) // len(exchange.REGIONS)
        rows = exchange.read_positional(_tab_file(spark, folder, name), exchange.POSITIONAL[name]).rows
        return rows.select("file", *columns[:each], *columns[-each:], F.col("Settlement_Date").cast("timestamp_ntz").alias("Settlement_Date"))


for _name in ("open_interest_futures", "open_interest_caps", "settlement_caps"):
    _tab_query(_name)


def _headed_file(spark, folder, name, cells):
    """Comma-separated lines of a month's orders; ``cells`` gives a value for some of the feed's columns."""
    orders = _monthly(spark, folder, name)
    row = _joined(*[cells.get(c, F.lit("")) for c in exchange.HEADED[name].columns])
    return _lines(_at(orders.select("file").distinct(), 0, "heading"),
                  orders.select("file", (F.col("o_orderkey") + 1).alias("line_no"), row.alias("line")))


def _code():
    return F.concat(F.lit("C"), F.col("o_custkey").cast("string"), F.lit("ABCDEF"))


_SQL_CODE = "'C' || o_custkey || 'ABCDEF'"
_SQL_CUT = f"CASE WHEN length({_SQL_CODE}) > 8 THEN {_SQL_CODE} ELSE left({_SQL_CODE}, 7) END"


def _sql_file(name):
    return f"'{name}_' || strftime(o_orderdate, '%Y%m') || '.txt' AS file"


@query("closing_options", f"""
SELECT {_sql_file('closing_snapshot_options')}, {_SQL_CODE} AS "Code", o_totalprice AS "Strike_Price", CAST(o_orderdate AS TIMESTAMP) AS "Settlement_Date",
  CAST(o_custkey AS DOUBLE) AS "Implied_Volatility", strftime(o_orderdate, '%H:%M') AS "Trade_Time" FROM orders""")
def closing_options(spark, folder):
    lines = _headed_file(spark, folder, "closing_snapshot_options", {
        "Code": _code(), "Strike_Price": F.col("o_totalprice"), "Settlement_Date": F.date_format("o_orderdate", "d/MM/yyyy"),
        "Implied_Volatility": F.col("o_custkey"), "Trade_Time": F.date_format(F.col("o_orderdate").cast("timestamp"), "HH:mm")})
    rows = exchange.read_headed(lines, exchange.HEADED["closing_snapshot_options"]).rows
    return rows.select("file", "Code", "Strike_Price", F.col("Settlement_Date").cast("timestamp_ntz").alias("Settlement_Date"), "Implied_Volatility", "Trade_Time")


@query("interest_report", f"""
SELECT {_sql_file('open_interest_report')}, {_SQL_CUT} AS "Code", o_totalprice AS "Open_Interest",
  CASE WHEN o_orderstatus <> 'P' THEN CAST(o_orderdate AS TIMESTAMP) END AS "Date" FROM orders""")
def interest_report(spark, folder):
    """Codes of up to eight characters lose their last; an unreadable date is null."""
    day = F.when(F.col("o_orderstatus") == "P", "soon").otherwise(F.date_format("o_orderdate", "yyyy/MM/dd"))
    lines = _headed_file(spark, folder, "open_interest_report", {"Code": _code(), "Open_Interest": F.col("o_totalprice"), "Date": day})
    rows = exchange.read_headed(lines, exchange.HEADED["open_interest_report"]).rows
    return rows.select("file", "Code", "Open_Interest", F.col("Date").cast("timestamp_ntz").alias("Date"))


@query("final_snapshot_table", f"""
SELECT {_sql_file('final_snapshot')}, {_SQL_CUT} AS "Code", o_totalprice AS "Bid_Price", CAST(o_orderdate AS TIMESTAMP) AS "Settlement_Date",
  lpad(CAST(o_custkey % 24 AS VARCHAR), 2, '0') || ':30' AS "Last_Trade_Time" FROM orders""")
def final_snapshot_table(spark, folder):
    time = F.concat(F.lpad((F.col("o_custkey") % 24).cast("string"), 2, "0"), F.lit("-30"))
    lines = _headed_file(spark, folder, "final_snapshot", {
        "Code": _code(), "Bid_Price": F.col("o_totalprice"), "Settlement_Date": F.date_format("o_orderdate", "dd/MM/yyyy"), "Last_Trade_Time": time})
    rows = exchange.read_headed(lines, exchange.HEADED["final_snapshot"]).rows
    return rows.select("file", "Code", "Bid_Price", F.col("Settlement_Date").cast("timestamp_ntz").alias("Settlement_Date"), "Last_Trade_Time")


@query("trade_log_table", f"""
SELECT {_sql_file('trade_log')}, o_orderstatus AS trade_type, CAST(o_custkey AS DOUBLE) AS volume, o_totalprice AS price,
  CAST(o_orderdate AS TIMESTAMP) + to_hours(CAST(o_custkey % 24 AS INTEGER)) + INTERVAL 5 MINUTE AS date_time FROM orders""")
def trade_log_table(spark, folder):
    time = F.concat(F.lpad((F.col("o_custkey") % 24).cast("string"), 2, "0"), F.lit(":05"))
    lines = _headed_file(spark, folder, "trade_log", {
        "Date": F.date_format("o_orderdate", "dd/MM/yyyy"), "Time": time, "trade_type": F.col("o_orderstatus"), "display_code": _code(),
        "volume": F.col("o_custkey"), "_$_mwh": F.col("o_totalprice")})
    rows = exchange.read_headed(lines, exchange.HEADED["trade_log"]).rows
    return rows.select("file", "trade_type", "volume", F.col("`_$_mwh`").alias("price"), F.col("date_time").cast("timestamp_ntz").alias("date_time"))


@query("multi_row_heading", """
SELECT 'town' || user_id AS file, CAST(event_id AS VARCHAR) AS station_name, CAST(CAST(ts AS DATE) AS TIMESTAMP) AS date, value AS rain_total_mm FROM events""")
def multi_row_heading(spark, folder):
    """Daily weather: four heading rows after nine title lines, dates with the day first, a footer line to skip."""
    events = table(spark, folder, "events").withColumn("file", F.concat(F.lit("town"), F.col("user_id").cast("string")))
    files = events.select("file").distinct()
    head = [_at(files, i, "title") for i in range(9)] + [
        _at(files, 9, "Station,Date,Rain"), _at(files, 10, "Name,,total"), _at(files, 11, ",,"), _at(files, 12, ",,mm")]
    row = _joined(F.col("event_id"), F.date_format("ts", "d/MM/yyyy"), F.col("value"))
    lines = _lines(*head, events.select("file", (F.col("event_id") + 13).alias("line_no"), row.alias("line")), _at(files, _END, "Totals,,0"))
    rows = delimited.read_delimited(lines, delimited.FEEDS["daily_weather"]).rows
    return rows.select("file", "station_name", "date", F.col("rain_total_mm").try_cast("double").alias("rain_total_mm"))


@query("meter_transactions", """
WITH e AS (SELECT user_id, event_type, value, CAST(ts AS DATE) AS day FROM events),
u AS (SELECT user_id FROM e GROUP BY user_id HAVING coalesce(max(value) FILTER (WHERE event_type = 'purchase'), 0) <= 200)
SELECT 'NEM12#U' || user_id || '#MDA#RET.csv' AS file, 'O' AS code, 'S1' AS service_order, TIMESTAMP '2024-03-01 00:00:00' AS read_at, count(*) AS days
FROM (SELECT user_id, day FROM e JOIN u USING (user_id) GROUP BY ALL HAVING bool_or(event_type = 'error')) GROUP BY user_id""")
def meter_transactions(spark, folder):
    """The transaction records of the meter files, by file."""
    rows = meter.parse(_meter_lines(spark, folder)).b2b
    return rows.groupBy("file", F.col("TransCode").alias("code"), F.col("RetServiceOrder").alias("service_order"), F.col("ReadDateTime").alias("read_at")).agg(
        F.count("*").alias("days"))


@query("lineage", f"""
SELECT 'Settlement_Futures_' || strftime(o_orderdate, '%Y%m') || '.txt' AS file, o_orderpriority AS "NSW_Period", o_totalprice AS "NSW_Peak_Price",
  CAST(strftime(o_orderdate, '%Y%m') AS BIGINT) AS source_file_id, TIMESTAMP '2024-05-06 07:08:09' AS added_dttm FROM orders""")
def lineage(spark, folder):
    """Rows carry the ledger's id of their file and the time of the load."""
    orders = _monthly(spark, folder, "Settlement_Futures")
    row = _joined(F.col("o_orderpriority"), F.col("o_totalprice"), sep="\t")
    lines = _lines(
        _at(orders.select("file", "month").distinct(), 0, F.concat(F.lit("title" + "\t" * 11), F.date_format("month", "dd MMM yyyy"))),
        orders.select("file", (F.col("o_orderkey") + 2).alias("line_no"), row.alias("line")))
    ledger = orders.select("file", F.date_format("month", "yyyyMM").cast("long").alias("source_file_id")).distinct()
    found = loads.with_lineage(exchange.read_positional(lines, exchange.POSITIONAL["settlement_futures"]), ledger)
    return loads.added_at(found.rows, "2024-05-06 07:08:09").select("file", "NSW_Period", "NSW_Peak_Price", "source_file_id", "added_dttm")
