"""Feed registry and dispatch: a job's handler name and parameters become one DataFrame over all its files."""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridtables.functions.expr import literal_path, plain_path
from gridtables.operators import control
from gridtables.operators.merge import append, check_keys, insert_absent, upsert
from gridtables.session import cut_lineage
from gridtables.sources import archives, delimited, environmental, exchange, forecast, meter
from gridtables.sources.lines import REJECTS, Parsed, Records, numbered_lines, whole_files

Paths = str | Sequence[str]


@dataclass(frozen=True)
class Feed:
    glob: str
    table: str
    read: Callable[[DataFrame], Parsed]


def _positional(name: str) -> Callable[[DataFrame], Parsed]:
    return lambda lines: exchange.read_positional(lines, exchange.POSITIONAL[name])


def _headed(name: str) -> Callable[[DataFrame], Parsed]:
    return lambda lines: exchange.read_headed(lines, exchange.HEADED[name])


# File names of the daily files, ``{date}`` standing for yyyymmdd.
FEEDS = {
    "open_interest_options": Feed("OpenInterest_Options_{date}.txt", "open_interest_options", exchange.read_option_blocks),
    "open_interest_futures": Feed("OpenInterest_Futures_{date}.txt", "open_interest_futures", _positional("open_interest_futures")),
    "open_interest_caps": Feed("OpenInterest_Caps_{date}.txt", "open_interest_caps", _positional("open_interest_caps")),
    "settlement_caps": Feed("Settlement_Caps_{date}.txt", "settlement_caps", _positional("settlement_caps")),
    "settlement_futures": Feed("Settlement_Futures_{date}.txt", "settlement_futures", _positional("settlement_futures")),
    "closing_snapshot_futures": Feed("ClosingSnapshot_Futures_{date}.csv", "closing_snapshot_futures", _headed("closing_snapshot_futures")),
    "closing_snapshot_options": Feed("ClosingSnapshot_Options_{date}.csv", "closing_snapshot_options", _headed("closing_snapshot_options")),
    "open_interest_report": Feed("*", "open_interest_report", _headed("open_interest_report")),
    "final_snapshot": Feed("*", "final_snapshot", _headed("final_snapshot")),
    "trade_log": Feed("*", "trade_log", _headed("trade_log")),
    "rate_card": Feed("rate_card_prices_{date}.csv", "rate_card", exchange.read_rate_card),
}
DAILY = (
    "open_interest_options", "open_interest_futures", "open_interest_caps", "settlement_caps", "settlement_futures",
    "closing_snapshot_futures", "closing_snapshot_options",
)


class HandlerError(ValueError):
    """Unknown handler, feed or parameter."""


def _known(given: Mapping[str, object], allowed: Sequence[str]) -> None:
    unknown = sorted(set(given) - set(allowed))
    if unknown:
        raise HandlerError(f"unknown parameters: {', '.join(unknown)}")


def _lines(spark: SparkSession, paths: Paths, archived: bool = False) -> DataFrame:
    return cut_lineage(archives.archive_lines(spark, paths) if archived else numbered_lines(spark, paths))


def _exchange(spark: SparkSession, paths: Paths, feed: str = "", archived: bool = False) -> Parsed:
    if feed not in FEEDS or feed == "rate_card":
        raise HandlerError(f"unknown exchange feed {feed!r}")
    return FEEDS[feed].read(_lines(spark, paths, archived))


def _rate_card(spark: SparkSession, paths: Paths, archived: bool = False) -> Parsed:
    return exchange.read_rate_card(_lines(spark, paths, archived))


def _delimited(
    spark: SparkSession, paths: Paths, feed: str | None = None, archived: bool = False, key_fields: Sequence[str] = (), **layout,
) -> Parsed:
    if feed is not None:
        if feed not in delimited.FEEDS:
            raise HandlerError(f"unknown delimited feed {feed!r}")
        spec = delimited.FEEDS[feed]
    else:
        _known(layout, list(delimited.Delimited.__dataclass_fields__))
        fixed = {k: tuple(tuple(x) if isinstance(x, list) else x for x in v) if isinstance(v, list) else v for k, v in layout.items()}
        spec = delimited.Delimited(**fixed)
    return delimited.read_delimited(_lines(spark, paths, archived), spec, keys=key_fields)


def _environmental(spark: SparkSession, paths: Paths, top: str | None = None, tail: str | None = None) -> Parsed:
    return environmental.read_closing_prices(_lines(spark, paths), top, tail)


def _forecast(spark: SparkSession, paths: Paths, carry_forward: bool = False) -> Parsed:
    return forecast.parse_forecasts(cut_lineage(forecast.documents(spark, paths)), carry_forward=carry_forward)


def _unzip(spark: SparkSession, paths: Paths) -> Parsed:
    return Parsed(archives.expand(spark, paths).withColumn("file", F.col("archive")), _no_rejects(spark))


def _meter(spark: SparkSession, paths: Paths, mode: str = "atomic", archived: bool = False) -> Parsed:
    """Interval rows with their quality, and the records of the single tables."""
    data = meter.parse(_lines(spark, paths, archived), mode)
    found = Records(meter.with_quality(meter.long_intervals(data.readings), data.quality), whole_files(data.rejects))
    found.parts = data
    return found


def _move_only(spark: SparkSession, paths: Paths) -> Parsed:
    files = spark.read.format("binaryFile").load(paths if isinstance(paths, str) else list(paths))
    return Parsed(files.select(plain_path(F.col("path")).alias("file")).filter(F.lit(False)), _no_rejects(spark))


def _no_rejects(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], REJECTS)


HANDLERS: dict[str, Callable[..., Parsed]] = {
    "delimited": _delimited,
    "move_only": _move_only,
    "unzip": _unzip,
    "exchange": _exchange,
    "rate_card": _rate_card,
    "meter": _meter,
    "forecast": _forecast,
    "environmental": _environmental,
}


@dataclass(frozen=True)
class Target:
    """Where a job's rows go: table, business keys, and ``upsert``, ``insert`` (absent keys only) or ``append``.

    With ``buckets`` (hex digits of their names) an upsert rewrites only the buckets of the table that it touches, see
    ``sources.commits``; the way for large tables.
    """

    table: str | None = None
    keys: tuple[str, ...] = ()
    mode: str = "upsert"
    buckets: int = 0


def parameters(handler: str, params: str | Mapping[str, object] | None) -> tuple[Target, dict[str, object]]:
    """A job's target and what is left for its handler. Feeds known by name have a table and keys of their own."""
    if isinstance(params, str):
        try:
            params = json.loads(params)
        except json.JSONDecodeError as fault:
            raise HandlerError(f"parameters are no JSON object: {fault}") from fault
    if params is not None and not isinstance(params, Mapping):
        raise HandlerError("parameters are no JSON object")
    rest = dict(params or {})
    feed = rest.get("feed")
    if handler == "delimited" and feed in delimited.FEEDS:
        known = Target(feed, delimited.KEYS[feed])
    elif handler == "forecast":
        known = Target("forecast", forecast.KEYS)
    elif handler == "meter":
        known = Target("meter")
    elif handler in ("exchange", "rate_card") and (feed or handler) in FEEDS:
        known = Target(FEEDS[feed or handler].table)
    else:
        known = Target()
    keys = rest.pop("key_fields", known.keys)
    # a meter job's mode says what is kept of a faulty file
    mode = known.mode if handler == "meter" else rest.pop("mode", known.mode)
    target = Target(rest.pop("table", known.table), tuple([keys] if isinstance(keys, str) else keys), mode, rest.pop("buckets", 0))
    if target.mode not in ("upsert", "insert", "append"):
        raise HandlerError(f"unknown mode {target.mode!r}")
    if target.buckets not in (0, 1, 2, 3) or target.buckets and (target.mode != "upsert" or not target.keys):
        raise HandlerError("buckets are 1 to 3 digits of an upsert with keys")
    return target, rest


def dispatch(spark: SparkSession, handler: str, paths: Paths, params: str | Mapping[str, object] | None = None) -> Parsed:
    """All files of a job through its handler. Bad parameters fail this job only."""
    if handler not in HANDLERS:
        raise HandlerError(f"unknown handler {handler!r}")
    target, params = parameters(handler, params)
    if handler == "delimited":
        params["key_fields"] = target.keys
    try:
        return HANDLERS[handler](spark, paths, **params)
    except TypeError as fault:
        raise HandlerError(str(fault)) from fault


def with_lineage(parsed: Parsed, source_files: DataFrame) -> Parsed:
    """Adds ``source_file_id`` from the ledger's (file, source_file_id) to rows and rejects."""
    return Parsed(*[df.join(source_files, "file", "left") for df in parsed])


def store(target: DataFrame, rows: DataFrame, keys: Sequence[str] = (), order: Sequence[str] = (),
          ignore_duplicates: bool = False, null_safe: bool = False) -> DataFrame:
    """The target after the load: append, upsert, or insert of absent keys only."""
    check_keys(rows, keys)
    if not keys:
        return append(target, rows.drop(*[c for c in order if c not in target.columns]))
    if ignore_duplicates:
        return insert_absent(target, rows, keys, order)
    return upsert(target, rows, keys, order, null_safe)


def added_at(df: DataFrame, now: str) -> DataFrame:
    """Load time of the rows; passed in, so that a repeated run gives the same rows."""
    return df.withColumn("added_dttm", F.lit(str(now)).cast("timestamp_ntz"))


def read_daily(spark: SparkSession, folder: str, feeds: Sequence[str] = DAILY, days: str = "*") -> dict[str, Parsed]:
    """The daily files of a folder, all days of a feed in one read; a feed without files is left out."""
    found = {}
    for feed in feeds:
        glob = FEEDS[feed].glob.format(date=days)
        listed = control.list_files(spark, folder).filter(control.glob_match(F.col("file_name"), glob))
        paths = [literal_path(r.path) for r in listed.select("path").collect()]  # a name per day of the feed
        if paths:
            found[feed] = FEEDS[feed].read(cut_lineage(numbered_lines(spark, paths)))
    return found
