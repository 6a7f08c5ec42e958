"""Daily files of the electricity futures exchange and the weekly contract rate card."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridtables.functions.expr import (
    compact_filename_date, dash_to_zero, date_and_time, date_lost, mixed_date, money, parse_date, strip, text_to_timestamp,
    time_separators, truncate_code,
)
from gridtables.operators import positional, quality
from gridtables.session import cut_lineage
from gridtables.sources.lines import (
    Parsed, cells, lost_cells, parse_delimited, refused, scan_file, split_blocks, unread, whole_files, width_faults, with_file_facts,
)

REGIONS = ("NSW", "VIC", "QLD", "SA")


def _per_region(*parts: str) -> tuple[str, ...]:
    return tuple(f"{region}_{part}" for region in REGIONS for part in parts)


# --- positional tables ----------------------------------------------------------------------------


@dataclass(frozen=True)
class Positional:
    """Tab-separated table with its date in one cell of line 0 and a heading on line 1."""

    date_cell: int
    columns: tuple[str, ...]
    dash_is_zero: bool = False


# Cell of the date and column order per file type.
POSITIONAL = {
    "open_interest_futures": Positional(3, _per_region("Period", "Peak_OI", "Base_OI")),
    "open_interest_caps": Positional(11, _per_region("Period", "Base_OI")),
    "settlement_caps": Positional(11, _per_region("Period", "Base_Price")),
    "settlement_futures": Positional(11, _per_region("Period", "Peak_Price", "OffPeak_Price", "Base_Price"), True),
}

OPTION_COLUMNS = _per_region("Call_OI", "Strike", "Put_OI")


def _typed(df: DataFrame, texts: tuple[str, ...] = ()) -> DataFrame:
    """Number columns as doubles; everything that is not a number, text or date stays as it is."""
    return df.withColumns({c: F.col(c).try_cast("double") for c in _numbers(df, texts)})


def _numbers(df: DataFrame, texts: tuple[str, ...] = ()) -> list[str]:
    return [
        f.name for f in df.schema.fields
        if f.dataType.typeName() == "string" and f.name not in texts and f.name not in ("file", "line")
    ]


def _numbered(table: DataFrame, texts: tuple[str, ...], columns: tuple[str, ...], rejects: DataFrame, sep: str = "\t") -> Parsed:
    """Rows (with their ``line``) with numbers in place of texts; what is no number, and lines that are too long or short, are lost cells."""
    lost = [unread(c, F.col(c), strip(F.col(c)).try_cast("double"), "number") for c in _numbers(table, texts)]
    faults = lost_cells(table, F.array_compact(F.array(*lost, *width_faults(F.col("line"), columns, sep))))
    return Parsed(_typed(table.drop("line"), texts), whole_files(rejects).unionByName(faults))


def read_positional(lines: DataFrame, spec: Positional) -> Parsed:
    width = max(len(spec.columns), spec.date_cell + 1)
    row = lines.withColumn("_c", cells(F.col("line"), width, "\t"))
    date = parse_date(strip(F.col(f"_c.c{spec.date_cell}")), "d MMM yyyy")
    dated = with_file_facts(row, Settlement_Date=F.max(F.when(F.col("line_no") == 0, date)))
    rejects = refused(dated.filter("Settlement_Date IS NULL"), "no settlement date on the first line")
    data = dated.filter((F.col("line_no") >= 2) & (strip(F.col("line")) != "") & F.col("Settlement_Date").isNotNull())
    values = [F.col(f"_c.c{i}") for i in range(len(spec.columns))]
    if spec.dash_is_zero:
        values = [dash_to_zero(v) for v in values]
    named = [v.alias(n) for v, n in zip(values, spec.columns)]
    periods = tuple(c for c in spec.columns if c.endswith("_Period"))
    return _numbered(data.select("file", "line_no", *named, "Settlement_Date", "line"), periods, spec.columns, rejects)


def read_option_blocks(lines: DataFrame) -> Parsed:
    """Options open interest: blocks between empty lines, each led by a line with the regions' periods.

    The last block counts even without an empty line behind it. A file without a usable block is refused.
    """
    width = len(OPTION_COLUMNS) + 1
    row = lines.withColumn("_c", cells(F.col("line"), width, "\t"))
    first, top = F.col("_c.c0"), F.col("line_no") < 3
    date = parse_date(strip(F.col("_c.c2")), "d MMM yyyy")
    dated = row.withColumn("_date", F.when(F.col("line_no") == 0, date))
    # lines 0-2 are titles: kept for the date, never a separator
    found = cut_lineage(split_blocks(dated, ~top & first.isNull()))
    dates = dated.filter("line_no = 0").select("file", F.col("_date").alias("Settlement_Date"))
    lead = F.col("block_row") == 1
    periods = {f"{r}_Period": F.col(f"_c.c{3 * i + 1}") for i, r in enumerate(REGIONS)}
    usable = F.when(lead, F.struct((first == REGIONS[0]).alias("ok"), *[c.alias(n) for n, c in periods.items()]))
    led = scan_file(found, _lead=positional.carry(usable)).join(dates, "file")
    data = led.filter("_lead.ok AND block_row > 3 AND Settlement_Date IS NOT NULL")
    columns = [F.col(f"_c.c{i}").alias(n) for i, n in enumerate(OPTION_COLUMNS)]
    table = data.select("file", "line_no", *columns, *[F.col(f"_lead.{n}").alias(n) for n in periods], "Settlement_Date", "line")
    with_rows = table.select("file").distinct()
    empty = lines.select("file").distinct().join(with_rows, "file", "left_anti")
    return _numbered(table, tuple(periods), OPTION_COLUMNS, refused(empty, "no usable block"))


# --- headed tables --------------------------------------------------------------------------------


@dataclass(frozen=True)
class Headed:
    """Comma-separated table whose heading line is replaced by a fixed list of columns."""

    columns: tuple[str, ...]
    dates: tuple[str, ...]
    texts: tuple[str, ...] = ("Code", "Trade_Time")
    fill_date: str | None = None
    truncate: str | None = None
    time: str | None = None
    unique: tuple[str, ...] = ()
    rules: dict[str, str] = field(default_factory=dict)


# Columns of each file type in file order.
HEADED = {
    "closing_snapshot_futures": Headed(
        ("Code", "Expiration", "Bid_Price", "Bid_Size", "Ask_Price", "Ask_Size", "Last_Price", "Volume", "Last_Volume",
         "Net_Change", "Open_Price", "High_Price", "Low_Price", "Settlement_Price", "Settlement_Date", "Trade_Date",
         "Trade_Time"),
        ("Expiration", "Settlement_Date", "Trade_Date"),
        fill_date="Settlement_Date", unique=("Code", "Settlement_Date"), rules={"High_Price": "min"},
    ),
    "closing_snapshot_options": Headed(
        ("Code", "Strike_Price", "Expiration", "Bid_Size", "Bid_Price", "Ask_Price", "Ask_Size", "Last_Price",
         "Net_Change", "Volume", "Last_Volume", "Settlement_Price", "Settlement_Date", "Open_Price", "High_Price",
         "Low_Price", "Implied_Volatility", "Trade_Date", "Trade_Time"),
        ("Expiration", "Settlement_Date", "Trade_Date"),
        fill_date="Settlement_Date",
    ),
    "open_interest_report": Headed(("Code", "Open_Interest", "Date"), ("Date",), truncate="Code"),
    "final_snapshot": Headed(
        ("Code", "Last_Trading_Date", "Bid_Price", "Bid_Size", "Ask_Price", "Ask_Size", "Last_Price", "Traded_Volume",
         "Open_Price", "High_Price", "Low_Price", "Settlement_Price", "Settlement_Date", "Implied_Volatility",
         "Last_Trade_Time"),
        ("Last_Trading_Date", "Settlement_Date"),
        texts=("Code", "Last_Trade_Time"), truncate="Code", time="Last_Trade_Time",
    ),
    "trade_log": Headed(
        ("Date", "Time", "trade_type", "display_code", "volume", "_$_mwh"), ("Date",),
        texts=("Time", "trade_type", "display_code"), time="Time",
    ),
}


def read_headed(lines: DataFrame, spec: Headed) -> Parsed:
    """Snapshot, report and trade files; blanks become null and dates may come in two patterns.

    A text that is no date or number where one belongs becomes null, and its cell is among the rejects; only blanks are filled.
    """
    body = lines.filter((F.col("line_no") >= 1) & (strip(F.col("line")) != ""))
    raw = parse_delimited(body, spec.columns, keep=["line"])
    numbers = [c for c in spec.columns if c not in spec.dates and c not in spec.texts]
    given = {c: F.when(strip(F.col(c)) != "", strip(F.col(c))) for c in (*spec.dates, *numbers)}
    lost = [unread(c, F.col(c), mixed_date(F.col(c)), "date") for c in spec.dates]
    lost += [unread(c, F.col(c), given[c].try_cast("double"), "number") for c in numbers]
    faults = lost_cells(raw, F.array_compact(F.array(*lost, *width_faults(F.col("line"), spec.columns))))
    table = raw.drop("line")
    if spec.fill_date:
        table = table.withColumn("_unread", date_lost(given[spec.fill_date], mixed_date(F.col(spec.fill_date))))
    table = table.withColumns({c: mixed_date(F.col(c)) for c in spec.dates})
    if spec.truncate:
        table = table.withColumn(spec.truncate, truncate_code(F.col(spec.truncate)))
    if spec.time:
        table = table.withColumn(spec.time, time_separators(F.col(spec.time)))
    if spec.columns[:2] == ("Date", "Time"):
        table = table.withColumn("date_time", date_and_time(F.col("Date"), F.col("Time"))).drop("Date", "Time")
    table = _typed(table, spec.texts)
    rejects = refused(lines.filter(F.lit(False)), "")
    if spec.fill_date:
        default = compact_filename_date(F.col("file"))
        table = quality.fill_from_first(table, spec.fill_date, ["file"], "line_no", default)
        rejects = refused(table.filter(F.col(spec.fill_date).isNull()), f"no {spec.fill_date} in the rows or the file name")
        table = table.withColumn(spec.fill_date, F.when(~F.col("_unread"), F.col(spec.fill_date))).drop("_unread")
        table = table.join(rejects.select("file"), "file", "left_anti")
    if spec.unique:
        table = quality.resolve(table.drop("chunk"), ["file", *spec.unique], {**spec.rules, "line_no": "min"})
    return Parsed(table.drop("chunk"), whole_files(rejects).unionByName(faults))


# --- rate card ------------------------------------------------------------------------------------

_FIRST_SECTION = ("Period", "PEAK_Swap", "FLAT_Swap", "FLAT_Cap_$300")
_SECOND_SECTION = ("Period", "FLAT_Swap", "FLAT_Cap_$300", "NSLP_Swap")


def read_rate_card(lines: DataFrame) -> Parsed:
    """Two stacked price tables and a creation time; a third table and rows outside the priced span are left out."""
    row = lines.withColumn("_c", cells(F.col("line"), 5))
    a, b, c, d = (F.col(f"_c.c{i}") for i in range(4))
    n = F.col("line_no")
    whole = with_file_facts(
        row,
        _made=F.max(F.when((n == 0) & (a == "File creation time:"), text_to_timestamp(strip(b), "d/M/yyyy H:m"))),
        _headed=F.max(F.when((n == 2) & (b == "PEAK Swap") & (c == "FLAT Swap") & (d == "$300 Flat Cap*"), n)),
        second=F.min(F.when((n > 2) & (b == "Flat Swap"), n)),
        third=F.min(F.when((n > 2) & (a == "start date"), n)),
    )
    bad = F.col("_made").isNull() | F.col("_headed").isNull() | F.col("second").isNull()
    rejects = refused(whole.filter(bad), "not a rate card with the expected headings")

    one = (n > 2) & (n < F.col("second"))
    two = (n > F.col("second")) & (F.col("third").isNull() | (n < F.col("third") - 1))
    placed = whole.filter(~bad).withColumn("section", F.when(one, 1).when(two, 2)).filter("section IS NOT NULL")
    priced = F.when(F.when(F.col("section") == 1, b).otherwise(d).isNotNull(), n)
    in_section = {s: F.when(F.col("section") == s, priced) for s in (1, 2)}
    spans = with_file_facts(
        placed, **{f"_f{s}": F.min(p) for s, p in in_section.items()}, **{f"_l{s}": F.max(p) for s, p in in_section.items()})
    filled = F.coalesce(a, b, c, d).isNotNull()
    parts, rejects = [], whole_files(rejects)
    for section, names in ((1, _FIRST_SECTION), (2, _SECOND_SECTION)):
        rows = spans.filter(filled & (F.col("section") == section) & n.between(F.col(f"_f{section}"), F.col(f"_l{section}")))
        values = [F.col(f"_c.c{i}") if i == 0 else money(F.col(f"_c.c{i}")) for i in range(4)]
        lost = [unread(names[i], F.col(f"_c.c{i}"), values[i], "price") for i in range(1, 4)]
        rejects = rejects.unionByName(lost_cells(rows, F.array_compact(F.array(*lost, *width_faults(F.col("line"), names)))))
        parts.append(rows.select("file", "line_no", *[v.alias(m) for v, m in zip(values, names)], F.col("_made").alias("File_Creation_Date")))
    table = quality.union_pad(*parts)
    order = ["file", "line_no", "Period", "FLAT_Swap", "PEAK_Swap", "NSLP_Swap", "FLAT_Cap_$300", "File_Creation_Date"]
    return Parsed(table.select(*[f"`{c}`" for c in order]), rejects)
