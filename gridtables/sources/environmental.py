"""Closing prices of environmental certificates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridtables.functions.expr import drop_unnamed, iso_filename_date, strip
from gridtables.sources.delimited import Delimited, read_delimited
from gridtables.sources.lines import Parsed, lost_cells, refused, unread, whole_files

# The price columns, which together are the key of the table.
PRICE_COLUMNS = (
    "instrument", "tenor_type", "tenor", "settle", "bid", "offer", "mid", "bid_method", "offer_method", "mid_method",
)
_TYPES = {"bid": "double", "offer": "double", "mid": "double", "bid_method": "int", "offer_method": "int"}


def read_closing_prices(lines: DataFrame, top: str | None = None, tail: str | None = None) -> Parsed:
    """Rows with a tenor; the date comes from the file name, and a file named without one is refused."""
    dated = lines.withColumn("_date", iso_filename_date(F.col("file")))
    rejects = refused(dated.filter("_date IS NULL"), "no date in the file name")
    table, unmarked = read_delimited(dated.filter("_date IS NOT NULL").drop("_date"), Delimited(top, tail))
    table = drop_unnamed(table)
    missing = [c for c in PRICE_COLUMNS if c not in table.columns]
    if missing:
        raise ValueError(f"columns missing from the heading: {', '.join(missing)}")
    table = table.filter(F.col("tenor").isNotNull())
    lost = [unread(c, F.col(c), strip(F.col(c)).try_cast(t), "number") for c, t in _TYPES.items()]
    faults = lost_cells(table, F.array_compact(F.array(*lost)))
    table = (
        table
        .withColumns({c: F.col(c).try_cast(t) for c, t in _TYPES.items()})
        .withColumn("instrument", F.coalesce("instrument", F.lit("ESC")))
        .withColumn("tenor_type", F.coalesce("tenor_type", F.lit("Spot")))
        .withColumn("date", iso_filename_date(F.col("file")))
    )
    return Parsed(table.select("file", "line_no", *PRICE_COLUMNS, "date"), whole_files(rejects).unionByName(unmarked).unionByName(faults))
