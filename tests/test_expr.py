from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from gridtables.functions import expr, rules
from gridtables.functions.rules import Field


def column(spark, fn, values, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r.o for r in df.select("i", fn(F.col("v")).alias("o")).orderBy("i").collect()]


HEADINGS = {
    "  Air Temp ": "air_temp", "Open Interest [12]": "open_interest", "[12] Open": "_12_open", "$ MWh (net)": "_$_mwh_net",
    "2nd Price": "_2nd_price", "start-time-utc": "start_time_utc", "Unnamed: 10": "unnamed_10", "air temp [1]": "air_temp",
}


def test_headings(spark):
    assert [expr.heading(h) for h in HEADINGS] == list(HEADINGS.values())
    assert column(spark, expr.normalise_heading, list(HEADINGS)) == list(HEADINGS.values())
    assert expr.heading(("Town", "Unnamed: 1_level_1", "mm")) == "town_mm"
    df = expr.drop_unnamed(expr.normalise_columns(spark.createDataFrame([(1, 2)], ["Air Temp", "Unnamed: 10"])))
    assert df.columns == ["air_temp"]


def test_dates(spark):
    assert column(spark, expr.mixed_date, ["1/07/2009", "2009/07/01", "2009-07-01", "", None]) == [date(2009, 7, 1)] * 2 + [None] * 3
    assert column(spark, expr.digits_to_timestamp, ["20040229", "20040230", "200402282360", "20040228235959", "2004022", "20040228235960", "x" * 8]) == [
        datetime(2004, 2, 29), None, None, datetime(2004, 2, 28, 23, 59, 59), None, None, None]
    assert column(spark, expr.compact_filename_date, ["/a/2001/Snap_20090701.csv", "Snap.csv", "Snap_20091301.csv"]) == [date(2009, 7, 1), None, None]
    assert column(spark, expr.iso_filename_date, ["/2001-01-01/Rates 2018-10-22.csv", "/2001-01-01/x.csv"]) == [date(2018, 10, 22), None]


def test_values(spark):
    assert column(spark, expr.truncate_code, ["BNM2014", "BNM2014X", "BNM2014C0050", None]) == ["BNM2014", "BNM2014", "BNM2014C0050", None]
    assert [float(x) if x is not None else None for x in column(spark, expr.money, ["$61.20", "-$5", "", None])] == [61.2, 5.0, None, None]
    assert column(spark, expr.last_characters, ["x" * 100 + "y", "z"]) == ["x" * 79 + "y", "z"]


@pytest.mark.parametrize("glob, hits", [("*.csv", ["a.csv", "A.CSV"]), ("a?c", ["abc"]), ("[ab]*", ["a.csv", "abc", "A.CSV"]), ("[!a]*", ["x+y(1)"]), ("x+y(1)", ["x+y(1)"])])
def test_globs(spark, glob, hits):
    names = ["a.csv", "abc", "x+y(1)", "A.CSV"]
    got = column(spark, lambda c: expr.glob_match(c, glob), names)
    assert [n for n, hit in zip(names, got) if hit] == hits


def test_template_and_local_time(spark):
    df = spark.sql("SELECT timestamp_ntz '2014-06-30 23:05:00' AS t")
    row = df.select(expr.expand_template(F.lit("p_{year}{month}{day}_{hour}{minute}.csv"), F.col("t")).alias("a"),
                    expr.local_time(F.col("t"), F.lit(10)).alias("b")).first()
    assert row.a == "p_20140630_2305.csv" and row.b == datetime(2014, 7, 1, 9, 5)


@pytest.mark.parametrize("field, good, bad", [
    (Field("f", "C", 3), ["", "abc"], ["ab", "abcd"]),
    (Field("f", "V", 3, True), ["a", "abc"], ["", "abcd"]),
    (Field("f", "N", 3), ["", "1", "-12", "+5"], ["1234", "1.0", "x", "-"]),
    (Field("f", "N", 3, True, scale=2), ["1", "123.45", "-12.5", ".5", "1.5"], ["", "1234", "1.234", "1.", "-.5", "1.2.3", "x", "1e1", "-"]),
    (Field("f", "D", 8), ["", "20040229"], ["20040230", "200402", "2004022x"]),
])
def test_fields(spark, field, good, bad):
    got = column(spark, lambda c: rules.field_error(c, field), good + bad)
    assert [g is None for g in got] == [True] * len(good) + [False] * len(bad)
