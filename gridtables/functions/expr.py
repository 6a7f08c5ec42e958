"""Column expressions for messy file values. All built-in functions, so they stay inside codegen."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WHITESPACE = " \t\r\n\f\v"


def strip(c: Column) -> Column:
    return F.trim(c, F.lit(WHITESPACE))


def whole(c: Column, kind: str = "int") -> Column:
    """The whole number a text holds, else null. Empty texts, the usual case of no number, are kept from the cast, which finds
    a fault by an exception."""
    return F.when(c != "", c).try_cast(kind)


# --- headings -------------------------------------------------------------------------------------


def heading(raw: str | Sequence[str]) -> str:
    """A safe column name; a multi-row heading is joined by blanks without its unnamed parts."""
    if not isinstance(raw, str):
        raw = " ".join(part for part in raw if not part.startswith("Unnamed"))
    name = re.sub(r"\[\d+\]$", "", raw.strip())
    name = re.sub(r"[^$A-Za-z0-9_]+", "_", name).strip("_").lower()
    return f"_{name}" if re.match(r"[$\d]", name) else name


def normalise_heading(c: Column) -> Column:
    """``heading`` for heading texts held in a column."""
    name = F.regexp_replace(strip(c), r"\[[0-9]+\]$", "")
    name = F.regexp_replace(name, r"[^$A-Za-z0-9_]+", "_")
    name = F.lower(F.regexp_replace(name, r"^_+|_+$", ""))
    return F.when(name.rlike(r"^[$0-9]"), F.concat(F.lit("_"), name)).otherwise(name)


def normalise_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[heading(c) for c in df.columns])


def drop_unnamed(df: DataFrame) -> DataFrame:
    """Drops the columns a blank heading leaves behind."""
    return df.drop(*[c for c in df.columns if c == "" or re.match(r"unnamed(_|:|$)", c, re.I)])


# --- dates and times ------------------------------------------------------------------------------


def parse_date(c: Column, pattern: str) -> Column:
    return F.try_to_date(c, pattern)


def mixed_date(c: Column) -> Column:
    """Day-first or year-first date, null when neither fits."""
    return F.coalesce(F.try_to_date(c, "d/M/yyyy"), F.try_to_date(c, "yyyy/M/d"))


def date_lost(raw: Column, parsed: Column) -> Column:
    """True where a text was given but no date came out of it."""
    return raw.isNotNull() & parsed.isNull()


def digits_to_timestamp(c: Column) -> Column:
    """``yyyyMMdd[HHmm[ss]]`` to a zone-less timestamp, null if not a real moment."""

    def piece(start: int, length: int) -> Column:
        return F.coalesce(whole(F.substring(c, start, length)), F.lit(0))

    moment = F.try_make_timestamp_ntz(
        piece(1, 4), piece(5, 2), piece(7, 2), piece(9, 2), piece(11, 2), piece(13, 2).cast("decimal(8,6)")
    )
    # a 60th second is normalised by the built-in; no such moment exists in the files
    return F.when(c.rlike(r"^[0-9]{8}([0-9]{4}([0-9]{2})?)?$") & (piece(13, 2) < 60), moment)


def text_to_timestamp(c: Column, pattern: str) -> Column:
    """Zone-less timestamp from text in a fixed pattern, null if it does not fit."""
    return F.try_to_timestamp(c, F.lit(pattern)).cast("timestamp_ntz")


def time_separators(c: Column) -> Column:
    return F.translate(c, "-", ":")


def date_and_time(date: Column, time: Column) -> Column:
    """One zone-less timestamp from a date and a time text; null if either does not parse."""
    return F.concat(date.cast("string"), F.lit(" "), time).try_cast("timestamp_ntz")


def plain_path(path: Column) -> Column:
    """Path without the scheme of a local file and without a closing slash."""
    return F.regexp_replace(F.regexp_replace(F.trim(path), "^file:/+", "/"), "(?<=.)/+$", "")


def metadata_path(path: Column) -> Column:
    """The plain path behind the encoded one that file sources give in their metadata."""
    return plain_path(F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B"))))


def file_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def compact_filename_date(path: Column) -> Column:
    """``yyyyMMdd`` at the first ``20`` of the file name."""
    return F.try_to_date(F.regexp_extract(file_name(path), r"^.*?(20.{6})", 1), "yyyyMMdd")


def iso_filename_date(path: Column) -> Column:
    """First ``yyyy-MM-dd`` of the file name."""
    return F.try_to_date(F.regexp_extract(file_name(path), r"(\d{4}-\d{2}-\d{2})", 1), "yyyy-MM-dd")


def local_time(utc: Column, offset_hours: Column) -> Column:
    """Run time at a fixed offset from UTC (market time has no daylight saving)."""
    return utc + F.make_dt_interval(F.lit(0), offset_hours)


def interval_end(date: Column, index: Column, minutes: Column) -> Column:
    """End of the 1-based interval ``index`` of a day cut into ``minutes``-long intervals."""
    return date.cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(0), (index * minutes).cast("int"))


# --- values ---------------------------------------------------------------------------------------


def null_tokens(c: Column, tokens: Sequence[str] = ("",)) -> Column:
    return F.when(c.isin(*tokens), None).otherwise(c)


def nan_to_null(c: Column) -> Column:
    return F.when(F.isnan(c), None).otherwise(c)


def dash_to_zero(c: Column) -> Column:
    return F.when(c == "-", "0").otherwise(c)


def truncate_code(c: Column) -> Column:
    """Codes of up to 8 characters keep 7; longer ones are left alone."""
    return F.when(F.length(c) > 8, c).otherwise(F.substring(c, 1, 7))


def money(c: Column, precision: int = 18, scale: int = 4) -> Column:
    """Digits and point of a money text as a decimal (a sign is lost too)."""
    return F.regexp_replace(c, r"[^0-9.]", "").try_cast(f"decimal({precision},{scale})")


def last_characters(c: Column, n: int = 80) -> Column:
    return F.right(c, F.lit(n))


# --- names, patterns and links --------------------------------------------------------------------


def glob_pattern(glob: Column) -> Column:
    """Regular expression for a file glob with ``*``, ``?`` and ``[..]``; letter case is ignored."""
    body = F.regexp_replace(glob, r"([.\\^$+{}()|])", r"\\$1")
    body = F.replace(F.replace(F.replace(body, F.lit("[!"), F.lit("[^")), F.lit("*"), F.lit(".*")), F.lit("?"), F.lit("."))
    return F.concat(F.lit("(?is)^"), body, F.lit("$"))


def literal_path(path: str) -> str:
    """A listed path as a pattern that means this file only."""
    return re.sub(r"([\\*?\[\]{}])", r"\\\1", path)


def glob_match(name: Column, glob: Column | str) -> Column:
    pattern = glob_pattern(F.lit(glob) if isinstance(glob, str) else glob)
    return F.regexp_like(name, pattern)


def expand_template(template: Column, at: Column) -> Column:
    """Fills ``{year} {month} {day} {hour} {minute}``."""
    for field, pattern in (("year", "yyyy"), ("month", "MM"), ("day", "dd"), ("hour", "HH"), ("minute", "mm")):
        template = F.replace(template, F.lit("{" + field + "}"), F.date_format(at, pattern))
    return template


_HREF = r"""(?is)<a\s(?:[^>]*?\s)?href\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)"""


def hrefs(html: Column) -> Column:
    """Targets of all ``a`` elements in document order, as an array."""

    def clean(value: Column) -> Column:
        text = F.regexp_replace(value, r"""^["']|["']$""", "")
        for entity, char in (("&quot;", '"'), ("&#39;", "'"), ("&lt;", "<"), ("&gt;", ">"), ("&amp;", "&")):
            text = F.replace(text, F.lit(entity), F.lit(char))
        return F.trim(text)

    return F.transform(F.regexp_extract_all(html, F.lit(_HREF), F.lit(1)), clean)


def _without_dots(path: Column) -> Column:
    """Resolves ``.`` and ``..`` segments."""

    def step(done: Column, segment: Column) -> Column:
        up = F.when(F.size(done) > 1, F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(1)))).otherwise(done)
        return (
            F.when(segment == "..", up).when(segment == ".", done).otherwise(F.concat(done, F.array(segment)))
        )

    segments = F.split(path, "/")
    kept = F.aggregate(F.slice(segments, F.lit(2), F.size(segments)), F.array(F.lit("")), step)
    tail = F.when(path.rlike(r"/\.{1,2}$"), F.lit("/")).otherwise(F.lit(""))
    return F.concat(F.array_join(kept, "/"), tail)


def absolute_url(base: Column, href: Column) -> Column:
    """``href`` as seen from the page ``base``: absolute, scheme-relative, rooted, query, fragment or relative."""
    scheme = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*):", 1)
    site = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", 1)
    path = F.regexp_extract(base, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)
    folder = F.regexp_extract(path, r"^(.*/)", 1)
    folder = F.when(folder == "", "/").otherwise(folder)
    ref_path = F.regexp_extract(href, r"^([^?#]*)", 1)
    ref_rest = F.regexp_extract(href, r"^[^?#]*(.*)$", 1)
    return (
        F.when(F.coalesce(href, F.lit("")) == "", base)
        .when(href.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), href)
        .when(href.startswith("//"), F.concat(scheme, F.lit(":"), href))
        .when(href.startswith("#"), F.concat(F.regexp_extract(base, r"^([^#]*)", 1), href))
        .when(href.startswith("?"), F.concat(site, path, href))
        .when(href.startswith("/"), F.concat(site, _without_dots(ref_path), ref_rest))
        .otherwise(F.concat(site, _without_dots(F.concat(folder, ref_path)), ref_rest))
    )


def listing_names(listing: Column) -> Column:
    """File names of an FTP directory listing: the last blank-separated word of each finished line."""
    lines = F.split(listing, "\r\n")
    words = F.transform(F.slice(lines, 1, F.size(lines) - 1), lambda x: F.element_at(F.split(F.trim(x), r"\s+"), -1))
    return F.filter(words, lambda w: w != "")


def between(text: Column, top: str, tail: str) -> Column:
    """Text after the first ``top`` and before the next ``tail``; null if either is missing."""
    begin = F.instr(text, top)
    body = F.substr(text, begin + F.lit(len(top)))
    end = F.instr(body, tail)
    return F.when((begin > 0) & (end > 0), F.substr(body, F.lit(1), end - 1))
