"""Dates, months and relative times as Columns."""

from __future__ import annotations

from functools import reduce
from zoneinfo import ZoneInfo

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import one_line, without_zero_width


def checked_zone(name: str) -> str:
    try:
        ZoneInfo(name)
    except Exception as e:
        raise ValueError(f"unknown time zone: {name}") from e
    return name


def local_midnight_utc(date: Column, zone: str) -> Column:
    """The UTC instant at which a local day begins, daylight saving included."""
    return F.to_utc_timestamp(date.cast("timestamp"), checked_zone(zone))


def iso_time(c: Column) -> Column:
    """ISO text with Z, an offset or none (UTC); null or blank text is null, any other text an error."""
    text = F.trim(c)
    return F.when(text == "", None).otherwise(F.coalesce(try_iso_time(c), F.when(text.isNotNull(), F.raise_error(F.concat(F.lit("not a time: "), text)).cast("timestamp"))))


def try_iso_time(c: Column) -> Column:
    """iso_time, with null for text that isn't a time. Only texts that begin with a year are tried."""
    text = F.trim(c)
    return F.try_to_timestamp(F.when(text.rlike(r"^\d{4}-\d{2}"), F.regexp_replace(text, "Z$", "+00:00")))


def day_series(first: Column, last: Column) -> Column:
    """All days of an inclusive range; none if it is reversed."""
    return F.when(first <= last, F.sequence(first, last)).otherwise(F.array().cast("array<date>"))


def month_text(c: Column) -> Column:
    """yyyy-MM if the text is that of a month, else null."""
    return F.when(c.rlike(r"^\d{4}-(0[1-9]|1[0-2])$"), c)


def shift_month(month: Column, by: int) -> Column:
    return F.date_format(F.add_months(F.to_date(F.concat(month, F.lit("-01"))), by), "yyyy-MM")


def month_series(first: Column, last: Column, reverse: bool = False) -> Column:
    months = F.transform(F.sequence(F.to_date(F.concat(first, F.lit("-01"))), F.to_date(F.concat(last, F.lit("-01"))), F.expr("interval 1 month")), lambda d: F.date_format(d, "yyyy-MM"))
    return F.reverse(months) if reverse else months


# The ways in which reports write year, month and day, tried in turn.
REPORT_DATES = [r"(\d{4})[.\-/]\s*(\d{1,2})[.\-/]\s*(\d{1,2})", r"(\d{4})\s*년\s*(\d{1,2})\s*월\s*(\d{1,2})\s*일", r"(?<!\d)(\d{2})[.](\d{1,2})[.](\d{1,2})(?!\d)"]


def report_date(c: Column) -> Column:
    """yyyy-MM-dd by the first pattern that gives a real date; two-digit years are of this century."""
    text = one_line(c)
    tried = []
    for pattern in REPORT_DATES:
        y, m, d = (F.regexp_extract(text, pattern, i) for i in (1, 2, 3))
        year = F.when(F.length(y) == 2, F.concat(F.lit("20"), y)).otherwise(y)
        tried.append(F.try_to_date(F.concat_ws("-", year, F.lpad(m, 2, "0"), F.lpad(d, 2, "0")), "yyyy-MM-dd"))
    return F.date_format(F.coalesce(*tried), "yyyy-MM-dd")


def compact_date(c: Column) -> Column:
    """yyyyMMdd of yyyy-MM-dd or yyyyMMdd; null if it isn't a date."""
    return F.date_format(F.try_to_date(F.replace(F.trim(c), F.lit("-"), F.lit("")), "yyyyMMdd"), "yyyyMMdd")


def hong_kong_time(c: Column) -> Column:
    """UTC of a release time written in either of two ways, in Hong Kong time; null if neither."""
    text = one_line(c)
    cn = r"(\d{4})\s*年\s*(\d{1,2})\s*月\s*(\d{1,2})\s*日\s+(\d{1,2}):(\d{2})"
    en = r"(\d{1,2})/(\d{1,2})/(\d{4})\s+(\d{1,2}):(\d{2})"

    def at(pattern: str, order: tuple[int, ...]) -> Column:
        y, m, d, h, n = (F.regexp_extract(text, pattern, i) for i in order)
        full = F.format_string("%s-%s-%s %s:%s:00", y, *[F.lpad(x, 2, "0") for x in (m, d, h, n)])
        return F.try_to_timestamp(F.when(y != "", full), F.lit("yyyy-MM-dd HH:mm:ss"))

    local = F.when(text.rlike(cn), at(cn, (1, 2, 3, 4, 5))).otherwise(at(en, (3, 2, 1, 4, 5)))
    return F.to_utc_timestamp(local, "Asia/Hong_Kong")


# Seconds of a unit, and how it is written; what means now.
UNITS = [(1, r"(?i)(\d+)\s*(?:초|秒|seconds?|secs?)"), (60, r"(?i)(\d+)\s*(?:분|分钟|分鐘|minutes?|mins?)"), (3600, r"(?i)(\d+)\s*(?:시간|小时|小時|hours?|hrs?)"), (86400, r"(?i)(\d+)\s*(?:일|天|days?)")]
NOW = ["방금", "刚刚", "剛剛", "just now", "now"]


def relative_time(c: Column, base: Column) -> Column:
    """struct(event_time, quality): base less what the text says; 'unknown' where it says nothing known."""
    text = without_zero_width(c)
    ago = [F.when(text.rlike(p), F.regexp_extract(text, p, 1).try_cast("bigint") * s) for s, p in UNITS]
    seconds = F.when(F.lower(text).isin(NOW), F.lit(0).cast("bigint")).otherwise(reduce(lambda a, b: F.coalesce(a, b), ago))
    # Whole microseconds: no rounding of the base.
    when = F.timestamp_micros(F.unix_micros(base.cast("timestamp")) - seconds * 1_000_000)
    return F.struct(when.alias("event_time"), F.when(when.isNull(), "unknown").otherwise("approximate_relative").alias("quality"))
