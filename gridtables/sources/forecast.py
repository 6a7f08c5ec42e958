"""Town forecasts in XML: one wide row per area and forecast period.

An area element is one row of the XML source; its periods and their elements are reshaped with array
functions inside the row, so nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridtables.functions.expr import heading, metadata_path, strip
from gridtables.sources.lines import Parsed, refused, whole_files

# Attributes and element types of the forecast product.
AREA_ATTRIBUTES = ("aac", "description", "type", "parent-aac")
PERIOD_ATTRIBUTES = ("index", "start-time-local", "end-time-local", "start-time-utc", "end-time-utc")
ELEMENT_TYPES = (
    "forecast_icon_code", "air_temperature_minimum", "air_temperature_maximum", "precipitation_range",
    "probability_of_precipitation", "precis",
)
NUMBERS = ("index", "forecast_icon_code", "air_temperature_minimum", "air_temperature_maximum")
KEYS = ("description", "start_time_utc")

_CHILD = "array<struct<_VALUE: string, _type: string>>"


def _schema() -> str:
    area = ", ".join(f"`_{a}` string" for a in AREA_ATTRIBUTES)
    period = ", ".join(f"`_{a}`: string" for a in PERIOD_ATTRIBUTES)
    return f"{area}, `forecast-period` array<struct<{period}, element: {_CHILD}, text: {_CHILD}>>"


def read_forecasts(
    spark: SparkSession,
    paths: str | Sequence[str],
    types: Sequence[str] = ELEMENT_TYPES,
    numbers: Sequence[str] = NUMBERS,
    carry_forward: bool = False,
) -> DataFrame:
    """Rows with the attributes of area and period and one column per element type.

    With ``carry_forward`` a type absent from a period keeps the value of the area's latest earlier period
    that has it; a type present but empty gives null either way.
    """
    areas = (
        spark.read.format("xml").option("rowTag", "area").schema(_schema())
        .load(paths if isinstance(paths, str) else list(paths))
        .withColumn("file", metadata_path(F.col("_metadata.file_path")))
    )
    return _wide(areas, types, numbers, carry_forward)


def documents(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """(file, text): each file as one text. A forecast product is small; larger files are for ``read_forecasts``, which splits them."""
    whole = spark.read.text(paths if isinstance(paths, str) else list(paths), wholetext=True)
    return whole.select(metadata_path(F.col("_metadata.file_path")).alias("file"), F.col("value").alias("text"))


def parse_forecasts(
    texts: DataFrame, types: Sequence[str] = ELEMENT_TYPES, numbers: Sequence[str] = NUMBERS, carry_forward: bool = False,
) -> Parsed:
    """The same from XML documents held in a column (file, text). A document that is not well-formed, or none at all, is refused."""
    fields = _schema().replace("` string", "`: string").replace("`forecast-period` array", "`forecast-period`: array")
    schema = f"forecast struct<area: array<struct<{fields}>>>, {_BAD} string"
    found = texts.withColumn("_xml", F.from_xml("text", schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BAD}))
    bad = F.col("_xml").isNull() | F.col(f"_xml.{_BAD}").isNotNull() | (strip(F.coalesce("text", F.lit(""))) == "")
    rejects = refused(found.filter(bad), "not well-formed XML")
    areas = found.filter(~bad).select("file", F.explode("_xml.forecast.area").alias("_area")).select("file", "_area.*")
    return Parsed(_wide(areas, types, numbers, carry_forward), whole_files(rejects))


_BAD = "_bad"


def _wide(areas: DataFrame, types: Sequence[str], numbers: Sequence[str], carry_forward: bool) -> DataFrame:
    none = F.array().cast("array<struct<_VALUE: string, _type: string>>")

    def children(period: Column) -> Column:
        return F.concat(F.coalesce(period["element"], none), F.coalesce(period["text"], none))

    periods = F.col("forecast-period")
    rows = areas.select("*", F.posexplode(periods).alias("_at", "_period"))
    if carry_forward:
        seen = F.flatten(F.transform(F.slice(periods, F.lit(1), F.col("_at") + 1), children))
    else:
        seen = children(F.col("_period"))

    def latest(name: str) -> Column:
        return F.try_element_at(F.filter(seen, lambda c: c["_type"] == name), F.lit(-1))["_VALUE"]

    columns = {heading(a): F.col(f"`_{a}`") for a in AREA_ATTRIBUTES}
    for a in PERIOD_ATTRIBUTES:
        value = F.col("_period")[f"_{a}"]
        if carry_forward:
            value = F.try_element_at(
                F.filter(F.transform(F.slice(periods, F.lit(1), F.col("_at") + 1), lambda p: p[f"_{a}"]), lambda v: v.isNotNull()),
                F.lit(-1),
            )
        columns[heading(a)] = value
    columns.update({heading(t): latest(t) for t in types})
    for c in numbers:
        columns[c] = columns[c].try_cast("double")
    return rows.select("file", *[c.alias(n) for n, c in columns.items()])
