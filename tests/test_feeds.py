"""Readers on small files, one case per rule of the file shapes."""

from datetime import date, datetime

import pytest

from gridtables.plans import loads
from gridtables.sources import delimited, environmental, exchange, forecast
from gridtables.sources.lines import numbered_lines, payload_between


def lines(spark, folder, glob="*"):
    return numbered_lines(spark, folder, pathGlobFilter=glob)


def values(df, *columns, order="line_no"):
    return [tuple(r[c] for c in columns) for r in df.orderBy("file", order).collect()]


def test_numbered_lines_of_a_split_file(spark, write):
    """Line numbers run on across the blocks of one file."""
    text = "\n".join(f"line {i}" for i in range(3000)) + "\n"
    folder = write({"a.txt": text, "b.txt": "x\n\ny"})
    held = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        found = lines(spark, folder)
        assert found.select("file", "chunk").distinct().count() > 5
        rows = found.orderBy("file", "line_no").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", held)
    a = [r for r in rows if r.file.endswith("a.txt")]
    assert [r.line_no for r in a] == list(range(3000)) and [r.line for r in a] == [f"line {i}" for i in range(3000)]
    assert [(r.line_no, r.line) for r in rows if r.file.endswith("b.txt")] == [(0, "x"), (1, ""), (2, "y")]


AXF = "header junk\n[data]\nwmo,name,date,time,air temp [1],rain $\n95936,\"  Town A\",20140630,0415, 9.5,-9999\n95936,\"  Town A\",20140630,0445, 9.7,0.2\n[$]\nfooter junk [$]\n"


def test_topped_and_tailed(spark, write):
    folder = write({"good.axf": AXF, "nohead.axf": AXF.replace("[data]", ""), "notail.axf": AXF.replace("[$]", "")})
    spec = delimited.Delimited("[data]\n", "[$]", skip_initial_space=True, na_values=("-9999",), dates=((2, 3),), numeric=("air_temp",))
    rows, rejects = delimited.read_delimited(lines(spark, folder), spec)
    assert rows.columns == ["file", "line_no", "wmo", "name", "air_temp", "rain_$", "date_time"]
    assert values(rows, "air_temp", "rain_$", "date_time") == [
        (9.5, None, datetime(2014, 6, 30, 4, 15)), (9.7, "0.2", datetime(2014, 6, 30, 4, 45))]
    assert sorted((r.file[-10:], r.reason) for r in rejects.collect()) == [
        ("nohead.axf", "header text not found"), ("notail.axf", "footer text not found")]


def test_payload_markers_inside_a_line(spark, write):
    folder = write({"p.xml": "<a><CSVData>x,y\n1,2\n</CSVData><CSVData>no</CSVData>"})
    assert [r.line for r in payload_between(lines(spark, folder), "<CSVData>", "</CSVData>").rows.orderBy("line_no").collect()] == ["x,y", "1,2"]


def test_multi_row_heading_and_footer(spark, write):
    text = "\n".join(["x"] * 9 + ["Station,Date,Rain", "Name,,total", ",,", ",,mm", "Town A,1/04/2013,0.5", "Town A,13/04/2013,1.5", "Totals,,2"])
    rows, _ = delimited.read_delimited(lines(spark, write({"d.csv": text})), delimited.FEEDS["daily_weather"])
    assert rows.columns[2:] == ["station_name", "date", "rain_total_mm"]
    assert values(rows, "date", "rain_total_mm") == [(datetime(2013, 4, 1), "0.5"), (datetime(2013, 4, 13), "1.5")]


def test_each_file_is_read_by_its_own_heading(spark, write):
    folder = write({"a.csv": "x,y\n1,2", "b.csv": "x,z\n3,4", "c.csv": "x,y\n5,6,7", "d.csv": "x,x\n1,2"})
    rows, rejects = delimited.read_delimited(lines(spark, folder), delimited.Delimited())
    assert sorted((r.x, r.y, r.z) for r in rows.collect()) == [("1", "2", None), ("3", None, "4")]
    assert sorted((r.file.rsplit("/", 1)[1], r.reason) for r in rejects.collect()) == [
        ("c.csv", "a row with more cells than the heading"), ("d.csv", "a column name stands twice")]
    with pytest.raises(delimited.HeadingError):
        delimited.headings(lines(spark, folder))


def test_positional_table(spark, write):
    head = "a\tb\tc\td\te\tf\tg\th\ti\tj\tk\t"
    data = "NSW\tPeak\tOff\tBase\nQ4 2002\t41.5\t-\t30.1\tQ4 2002\t40\t22\t29\tQ4 2002\t39\t21\t28\tQ4 2002\t45\t-\t33\n"
    folder = write({"good.txt": head + "03 Sep 2002\n" + data, "undated.txt": head + "soon\n" + data})
    rows, rejects = exchange.read_positional(lines(spark, folder), exchange.POSITIONAL["settlement_futures"])
    assert values(rows, "NSW_Period", "NSW_Peak_Price", "NSW_OffPeak_Price", "SA_OffPeak_Price", "SA_Base_Price", "Settlement_Date") == [
        ("Q4 2002", 41.5, 0.0, 0.0, 33.0, date(2002, 9, 3))]
    assert len(rows.columns) == 2 + 17
    assert [r.file[-11:] for r in rejects.collect()] == ["undated.txt"]


@pytest.mark.parametrize("feed, cell, width", [("open_interest_futures", 3, 12), ("open_interest_caps", 11, 8), ("settlement_caps", 11, 8)])
def test_other_positional_tables(spark, write, feed, cell, width):
    text = "\t" * cell + "03 Sep 2002\nheading\n" + "\t".join(str(i) for i in range(width)) + "\n"
    rows, _ = exchange.read_positional(lines(spark, write({"f.txt": text})), exchange.POSITIONAL[feed])
    row = rows.first()
    assert row.Settlement_Date == date(2002, 9, 3) and row[-2] == float(width - 1) and len(row) == 2 + width + 1


def test_option_blocks(spark, write):
    def line(*cells):
        return "\t".join([*cells, *[""] * (13 - len(cells))])

    blank = ""
    lead = line("NSW", "Q4 2002", "", "VIC", "Q4 2002", "", "QLD", "Q4 2002", "", "SA", "Q4 2002")
    second = lead.replace("Q4 2002", "Q1 2003")
    body = [line("t", "t", "03 Sep 2002"), "x", "y", blank, lead, "h", "h", line("1", "30", "2"), line("3", "35", "4"), blank,
            second, "h", "h", line("5", "40", "6")]
    skipped = [line("t", "t", "03 Sep 2002"), "x", "y", blank, lead.replace("NSW", "TAS"), "h", "h", line("1"), blank]
    folder = write({"ok.txt": "\n".join(body + [blank]), "open.txt": "\n".join(body), "none.txt": "\n".join(skipped)})
    rows, rejects = exchange.read_option_blocks(lines(spark, folder))
    assert values(rows, "NSW_Call_OI", "NSW_Strike", "NSW_Period", "SA_Period") == [
        (1.0, 30.0, "Q4 2002", "Q4 2002"), (3.0, 35.0, "Q4 2002", "Q4 2002"), (5.0, 40.0, "Q1 2003", "Q1 2003")] * 2
    assert [(r.file[-8:], r.reason) for r in rejects.collect()] == [("none.txt", "no usable block")]


def snapshot(*rows):
    """Rows of (code, high, low, volume, trade date, settlement date)."""
    out = ["Code,Exp"]
    for code, high, low, volume, traded, settled in rows:
        out.append(f"{code},2010/06/30,,,,,,{volume},,,,{high},{low},,{settled},{traded},10:00")
    return "\n".join(out)


def test_closing_snapshot_futures(spark, write):
    d = "2009/07/01"
    folder = write({
        "ClosingSnapshot_Futures_20090701.csv": snapshot(
            ("A", 45, 44, 3, d, d), ("B", "", 40, 0, "", d), ("B", "44.7", 40, 0, "", d), ("C", 50, 40, 0, "", "1/07/2009"),
            ("C", 48, 41, 5, d, d), ("D", "", "", "", "", d), ("D", "", "", "", "", d)),
        "ClosingSnapshot_Futures_20090623.csv": snapshot(("A", 1, 1, 1, d, "2009/06/22"), ("B", 1, 1, 1, d, "")),
        "ClosingSnapshot_Futures_20031205.csv": snapshot(("A", 1, 1, 1, d, ""), ("B", 1, 1, 1, d, "")),
        "ClosingSnapshot_Futures.csv": snapshot(("A", 1, 1, 1, d, "")),
    })
    rows, rejects = exchange.read_headed(lines(spark, folder), exchange.HEADED["closing_snapshot_futures"])
    got = {(r.file[-12:-4], r.Code): (r.High_Price, r.Low_Price, r.Volume, r.Trade_Date, r.Settlement_Date) for r in rows.collect()}
    day = date(2009, 7, 1)
    assert got == {
        ("20090701", "A"): (45.0, 44.0, 3.0, day, day), ("20090701", "B"): (44.7, 40.0, 0.0, None, day),
        ("20090701", "C"): (48.0, 41.0, 5.0, day, day), ("20090701", "D"): (None, None, None, None, day),
        ("20090623", "A"): (1.0, 1.0, 1.0, day, date(2009, 6, 22)), ("20090623", "B"): (1.0, 1.0, 1.0, day, date(2009, 6, 22)),
        ("20031205", "A"): (1.0, 1.0, 1.0, day, date(2003, 12, 5)), ("20031205", "B"): (1.0, 1.0, 1.0, day, date(2003, 12, 5)),
    }
    assert [r.file[-27:] for r in rejects.collect()] == ["ClosingSnapshot_Futures.csv"]


def test_closing_snapshot_options_keep_duplicates(spark, write):
    row = "C50,5,2010/06/30,1,2,3,4,5,6,7,8,9,,10,11,12,0.4,2009/07/01,10:00"
    rows, _ = exchange.read_headed(lines(spark, write({"ClosingSnapshot_Options_20090701.csv": f"h\n{row}\n{row}"})), exchange.HEADED["closing_snapshot_options"])
    assert values(rows, "Strike_Price", "Bid_Size", "Bid_Price", "Implied_Volatility", "Settlement_Date") == [(5.0, 1.0, 2.0, 0.4, date(2009, 7, 1))] * 2


def test_reports_and_trades(spark, write):
    folder = write({
        "oi.csv": "h\nBNM2014,5,1/04/2014\nBNM2014X,6,2014/04/02\nBNM2014C0050,7,x\n,8,\n",
        "final.csv": "h\nBNM2014X,2014/06/30,1,2,3,4,5,6,7,8,9,10,1/04/2014,0.5,14-05-33\n",
        "trades.csv": "h\n1/04/2014,14-05-33,Trade,BNM2014X,5,40.5\n,14-05-33,Trade,B,5,40.5\n",
    })
    report, _ = exchange.read_headed(lines(spark, folder, "oi.csv"), exchange.HEADED["open_interest_report"])
    assert values(report, "Code", "Open_Interest", "Date") == [
        ("BNM2014", 5.0, date(2014, 4, 1)), ("BNM2014", 6.0, date(2014, 4, 2)), ("BNM2014C0050", 7.0, None), (None, 8.0, None)]
    final, _ = exchange.read_headed(lines(spark, folder, "final.csv"), exchange.HEADED["final_snapshot"])
    assert values(final, "Code", "Last_Trade_Time", "Settlement_Date", "Last_Trading_Date") == [("BNM2014", "14:05:33", date(2014, 4, 1), date(2014, 6, 30))]
    trades, _ = exchange.read_headed(lines(spark, folder, "trades.csv"), exchange.HEADED["trade_log"])
    assert values(trades, "date_time", "display_code", "_$_mwh") == [(datetime(2014, 4, 1, 14, 5, 33), "BNM2014X", 40.5), (None, "B", 40.5)]


CARD = ["File creation time:,14/06/2016 10:00", ",,,,", ",PEAK Swap,FLAT Swap,$300 Flat Cap*,", ",,,,", "Q3 2016,$61.20,$52.10,$7.05,",
        ",,,,", "Q4 2016,$60.00,$51.00,$6.50,", ",,,,", ",Flat Swap,$300 Flat Cap*,NSLP Swap,", "FY 2017,$53.00,$7.00,$55.50,"]


def test_rate_card(spark, write):
    third = CARD + ["FY 2018,$1.00,$1.00,$1.00,", "start date,a,b,c,", "x,$1,$2,$3,"]
    folder = write({"1old.csv": "\n".join(CARD), "2new.csv": "\n".join(third), "3bad.csv": "\n".join(CARD).replace("PEAK Swap", "Peak")})
    rows, rejects = exchange.read_rate_card(lines(spark, folder))
    got = [tuple(float(x) if x is not None and i else x for i, x in enumerate(t)) for t in values(rows, "Period", "PEAK_Swap", "FLAT_Swap", "FLAT_Cap_$300", "NSLP_Swap")]
    assert got == [("Q3 2016", 61.2, 52.1, 7.05, None), ("Q4 2016", 60.0, 51.0, 6.5, None), ("FY 2017", None, 53.0, 7.0, 55.5)] * 2
    assert {r.File_Creation_Date for r in rows.collect()} == {datetime(2016, 6, 14, 10)}
    assert [r.file[-8:] for r in rejects.collect()] == ["3bad.csv"]


def test_closing_prices(spark, write):
    text = ("Instrument,Tenor Type,Tenor,Settle,Bid,Offer,Mid,Bid Method,Offer Method,Mid Method,\n"
            "LGC,Spot,CAL18,2018-12-31,80.1,81,80.5,1,1,A,\n,,SPOT1,,30,31,30.5,1,1,A,\nLGC,Spot,,,1,2,1.5,1,1,A,\n")
    folder = write({"ClosingRates 2018-10-22.csv": text, "ClosingRates.csv": text})
    rows, rejects = environmental.read_closing_prices(lines(spark, folder))
    assert values(rows, "instrument", "tenor_type", "tenor", "settle", "bid", "mid_method", "date") == [
        ("LGC", "Spot", "CAL18", "2018-12-31", 80.1, "A", date(2018, 10, 22)), ("ESC", "Spot", "SPOT1", None, 30.0, "A", date(2018, 10, 22))]
    assert [r.reason for r in rejects.collect()] == ["no date in the file name"]


XML = """<product><forecast><area aac="A1" description="Town A">
 <forecast-period index="0" start-time-utc="2014-01-01T00:00:00Z"><element type="air_temperature_maximum">21</element><text type="precis">Sunny</text></forecast-period>
 <forecast-period index="1" start-time-utc="2014-01-02T00:00:00Z"><text type="precis">Rain</text></forecast-period>
 <forecast-period index="2" start-time-utc="2014-01-03T00:00:00Z"><element type="air_temperature_maximum"></element></forecast-period>
</area><area aac="A2" description="Region"/></forecast></product>"""


@pytest.mark.parametrize("carry, expected", [
    (False, [(21.0, "Sunny"), (None, "Rain"), (None, None)]),
    (True, [(21.0, "Sunny"), (21.0, "Rain"), (None, "Rain")]),
])
def test_forecast(spark, write, carry, expected):
    rows = forecast.read_forecasts(spark, write({"f.xml": XML}), carry_forward=carry).orderBy("index").collect()
    assert [(r.air_temperature_maximum, r.precis) for r in rows] == expected
    assert [(r.aac, r.description, r["index"], r.start_time_utc) for r in rows][1] == ("A1", "Town A", 1.0, "2014-01-02T00:00:00Z")


def test_zip_members_are_read_in_place(spark, tmp_path):
    import zipfile

    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("in/good.axf", AXF)
        z.writestr("in/other.axf", AXF.replace("20140630", "20140701"))
    spec = {"top": "[data]\n", "tail": "[$]", "dates": [[2, 3]], "archived": True}
    rows, rejects = loads.dispatch(spark, "delimited", f"{tmp_path}/*.zip", spec)
    assert rows.count() == 4 and rejects.count() == 0
    assert {r.file.split("!/")[1] for r in rows.collect()} == {"in/good.axf", "in/other.axf"}
    members = loads.dispatch(spark, "unzip", f"{tmp_path}/*.zip").rows
    assert {(r.member, bytes(r.content).decode()[:6]) for r in members.collect()} == {("in/good.axf", "header"), ("in/other.axf", "header")}


def test_dispatch_refuses_what_it_does_not_know(spark, write):
    folder = write({"a.csv": "x\n1"})
    for handler, params in (("nope", None), ("exchange", {"feed": "nope"}), ("delimited", {"tabel": "t"}), ("delimited", {"mode": "merge"}), ("delimited", "{'x"), ("meter", {"tabel": 1})):
        with pytest.raises(loads.HandlerError):
            loads.dispatch(spark, handler, folder, params)


def test_daily_feeds_are_found_by_name(spark, write):
    row = "C50,5,2010/06/30,1,2,3,4,5,6,7,8,9,,10,11,12,0.4,2009/07/01,10:00"
    folder = write({"ClosingSnapshot_Options_20090701.csv": f"h\n{row}", "ClosingSnapshot_Options_20090702.csv": f"h\n{row}", "x.txt": "?"})
    found = loads.read_daily(spark, folder)
    assert list(found) == ["closing_snapshot_options"]
    assert sorted(str(r.Settlement_Date) for r in found["closing_snapshot_options"].rows.collect()) == ["2009-07-01", "2009-07-02"]


def lost(rejects):
    return sorted(((r.line_no, r.column, r.text, r.reason) for r in rejects.collect()), key=repr)


def test_cells_that_cannot_be_read_are_named(spark, write):
    head = "\t" * 3 + "03 Sep 2002\nh\n"
    short, full = "Q1\t1\t2\tQ1", "Q1\tabc\t2\tQ1\t-\t1\tQ1\t1\t1\tQ1\t1\t1"
    folder = write({"oi.txt": head + full + "\tmore\n" + short + "\n" + full.replace("abc", "1").replace("-", " ") + "\t\t\n"})
    rows, rejects = exchange.read_positional(lines(spark, folder, "oi.txt"), exchange.POSITIONAL["open_interest_futures"])
    assert rows.count() == 3 and lost(rejects) == [
        (2, "NSW_Peak_OI", "abc", "no number in NSW_Peak_OI"), (2, "VIC_Peak_OI", "-", "no number in VIC_Peak_OI"),
        (2, None, "more", "more cells than columns"), (3, "VIC_Peak_OI", None, "fewer cells than columns")]
    write({"report.csv": 'h\nABC,12,20/11/2012,EXTRA\nABC,12\n"A,C",12,20/11/2012\nABC,,20/11/2012,,\nABC,x,no\n'})
    rows, rejects = exchange.read_headed(lines(spark, folder, "report.csv"), exchange.HEADED["open_interest_report"])
    assert rows.count() == 5 and lost(rejects) == [
        (1, None, "EXTRA", "more cells than columns"), (2, "Date", None, "fewer cells than columns"),
        (5, "Date", "no", "no date in Date"), (5, "Open_Interest", "x", "no number in Open_Interest")]
    write({"card.csv": "\n".join(CARD).replace("$61.20", "abc").replace("$55.50", "1.2.3")})
    rows, rejects = exchange.read_rate_card(lines(spark, folder, "card.csv"))
    assert rows.count() == 3 and lost(rejects) == [
        (4, "PEAK_Swap", "abc", "no price in PEAK_Swap"), (9, "NSLP_Swap", "1.2.3", "no price in NSLP_Swap")]
    write({"lp.csv": "<CSVData>\nProfileName,ProfileArea,SettlementDate,CreationDT\nP,A,garbage,2014/01/03 04:05:06\nP,A,2014/01/02,x\n</CSVData>"})
    found = delimited.read_delimited(lines(spark, folder, "lp.csv"), delimited.FEEDS["load_profile"], keys=delimited.KEYS["load_profile"])
    assert [r.creationdt for r in found.rows.collect()] == [None] and lost(found.rejects) == [
        (1, "settlementdate", "garbage", "no date in settlementdate"), (1, "settlementdate", None, "no value in key settlementdate"),
        (2, "creationdt", "x", "no date in creationdt")]
    write({"Rates 2018-10-22.csv": "Instrument,Tenor Type,Tenor,Settle,Bid,Offer,Mid,Bid Method,Offer Method,Mid Method\nLGC,Spot,C,,80.x,1,2,one,1,A\n"})
    rows, rejects = environmental.read_closing_prices(lines(spark, folder, "Rates*"))
    assert rows.count() == 1 and [(c, t) for _, c, t, _ in lost(rejects)] == [("bid", "80.x"), ("bid_method", "one")]


def test_a_forecast_that_breaks_off_is_refused(spark, write):
    folder = write({"good.xml": XML, "cut.xml": XML[:-30], "none.xml": "\n", "other.xml": "<product><amoc/></product>"})
    rows, rejects = loads.dispatch(spark, "forecast", f"{folder}/*.xml")
    assert {r.file.rsplit("/", 1)[1] for r in rows.collect()} == {"good.xml"} and rows.count() == 3
    assert sorted((r.file.rsplit("/", 1)[1], r.reason) for r in rejects.collect()) == [("cut.xml", "not well-formed XML"), ("none.xml", "not well-formed XML")]
