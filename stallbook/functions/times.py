"""Time functions. Times are ``timestamp_ntz`` in UTC; an open end is null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Text formats, missing date and the open end shown to readers.
MILLIS_FORMAT = "yyyy-MM-dd HH:mm:ss.SSS"
SECONDS_FORMAT = "yyyy-MM-dd HH:mm:ss"
MISSING_MILLIS = -1
OPEN_END = "9999-01-01 00:00:00"
LAST_SECOND = "23:59:59"


def ntz(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def open_end() -> Column:
    return ntz(OPEN_END)


def millis(ts: Column) -> Column:
    """Whole milliseconds since 1970; independent of the session time zone for zone-less times."""
    return F.timestamp_diff("MILLISECOND", ntz("1970-01-01 00:00:00"), ts.cast("timestamp_ntz"))


def parse_time(c: Column, extract: str | None = None, pattern: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    """Parse text with a pattern after cutting out the part that matches ``extract``.

    A ``T`` between date and time counts as a blank. Anything unreadable is null.
    """
    text = F.nullif(c if extract is None else F.regexp_extract(c, extract, 0), F.lit(""))
    return F.try_to_timestamp(F.replace(text, F.lit("T"), F.lit(" ")), F.lit(pattern)).cast("timestamp_ntz")


def parse_millis(c: Column, extract: str | None = None, pattern: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    """Parsed milliseconds, -1 if missing or unreadable."""
    return F.coalesce(millis(parse_time(c, extract, pattern)), F.lit(MISSING_MILLIS).cast("bigint"))


def format_millis(c: Column, pattern: str = MILLIS_FORMAT) -> Column:
    """Milliseconds as text; -1 and null are the empty text."""
    shown = F.date_format(F.timestamp_millis(c), pattern)
    return F.when(F.coalesce(c, F.lit(MISSING_MILLIS)) == MISSING_MILLIS, "").otherwise(shown)


def end_of_day(c: Column) -> Column:
    """23:59:59 of the day."""
    return F.date_trunc("day", c).cast("timestamp_ntz") + F.expr("INTERVAL '23:59:59' HOUR TO SECOND")


def is_last_second(c: Column) -> Column:
    return F.date_format(c, "HH:mm:ss") == LAST_SECOND


def seconds_between(start: Column, end: Column) -> Column:
    return F.timestamp_diff("SECOND", start, end)


def plus_seconds(c: Column, n: int) -> Column:
    return c + F.expr(f"INTERVAL '{n}' SECOND")


def interval_start(ts: Column, previous: Column) -> Column:
    """Start of a price interval.

    One second later after an end of day, two seconds later when the previous event is at the
    same time or one second before, so that neighbouring intervals never touch.
    """
    return (
        F.when(is_last_second(ts), plus_seconds(ts, 1))
        .when((ts == previous) | (ts == plus_seconds(previous, 1)), plus_seconds(ts, 2))
        .otherwise(ts)
    )


def interval_end(ts: Column, following: Column, window_end: Column) -> Column:
    """End of a price interval: a second before the next event, adjusted when they are close."""
    return (
        F.when(following.isNull(), window_end)
        .when(is_last_second(following), following)
        .when(following == ts, plus_seconds(ts, 1))
        .when(following == plus_seconds(ts, 1), plus_seconds(following, 1))
        .otherwise(plus_seconds(following, -1))
    )


def after_cancel(day: Column, cancelled: Column) -> Column:
    """1 if the day lies after the cancel date; never cancelled is 0."""
    return F.coalesce((F.to_date(day) > F.to_date(cancelled)).cast("int"), F.lit(0))
