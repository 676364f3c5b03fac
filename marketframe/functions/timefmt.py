"""Time columns: feed time strings, Unix seconds, bar stamps and expiries.

Sessions run in UTC (see ``session.builder``), so timestamps without a zone are UTC wall times.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

FEED_ZONE = "US/Eastern"

# Day with or without dashes, time, optional fraction; whatever follows (a zone name) is ignored.
_FEED_TIME = (
    r"^\s*(?:(\d{4})(\d{2})(\d{2})|(\d{4})-(\d{1,2})-(\d{1,2}))"
    r"\s+(\d{1,2}:\d{1,2}:\d{1,2}(?:\.\d{1,6})?).*$"
)
_STANDARD_TIME = f"!$1$4-$2$5-$3$6 $7 {FEED_ZONE}"


def parse_feed_time(text: Column) -> Column:
    """Feed time text, local to US/Eastern, as an instant; NULL when it cannot be read.

    One pattern match per row rewrites the text in the standard form, marked by a leading ``!``,
    which the cast reads; text left without the mark did not match.
    """
    standard = F.regexp_replace(text, _FEED_TIME, _STANDARD_TIME)
    return F.when(standard.startswith("!"), F.substring(standard, 2, 64).try_cast("timestamp"))


def parse_feed_time_strict(text: Column) -> Column:
    """As :func:`parse_feed_time`, but unreadable text is an error."""
    problem = F.raise_error(F.concat(F.lit("Unable to parse time: "), text)).cast("timestamp")
    return F.when(text.isNull(), F.lit(None).cast("timestamp")).otherwise(
        F.coalesce(parse_feed_time(text), problem)
    )


def format_feed_time(instant: Column, sub_sec: bool = True) -> Column:
    """An instant as feed time text with its zone; NULL gives the empty text.

    The fraction has three decimal digits, so that :func:`parse_feed_time` reads back what is written.
    """
    local = F.from_utc_timestamp(instant.cast("timestamp"), FEED_ZONE)
    text = F.date_format(local, "yyyyMMdd HH:mm:ss.SSS" if sub_sec else "yyyyMMdd HH:mm:ss")
    return F.coalesce(F.concat(text, F.lit(f" {FEED_ZONE}")), F.lit(""))


def unix_seconds_to_instant(seconds: Column) -> Column:
    return F.timestamp_seconds(seconds.cast("long"))


def parse_bar_date(text: Column) -> Column:
    """Eight characters are a day, stamped at its last second; otherwise Unix seconds."""
    day_end = parse_feed_time_strict(F.concat(text, F.lit(" 23:59:59")))
    seconds = F.timestamp_seconds(F.when(F.length(text) != 8, text).cast("long"))
    return F.when(F.length(text) == 8, day_end).otherwise(seconds)


def bar_end(start: Column, size_seconds: Column) -> Column:
    return start + F.make_dt_interval(secs=size_seconds.cast("decimal(18,6)"))


def expiry_instant(expiry: Column) -> Column:
    """``yyyymmdd`` as 14:00 US/Eastern on that day."""
    parts = [expiry.substr(p, n).try_cast("int") for p, n in ((1, 4), (5, 2), (7, 2))]
    zero = F.lit(0)
    return F.try_make_timestamp(*parts, F.lit(14), zero, zero, F.lit(FEED_ZONE))


def micros(ts: Column) -> Column:
    """Whole microseconds of a timestamp with or without a zone (the latter read as UTC)."""
    return F.unix_micros(ts.cast("timestamp"))


def years_365(start: Column, end: Column) -> Column:
    """Difference in years of 365 days."""
    return (micros(end) - micros(start)) / F.lit(365.0 * 86400 * 1e6)
