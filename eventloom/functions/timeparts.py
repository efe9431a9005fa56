"""Timestamp expressions: parts, shifts, buckets, gaps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Hours of day that are frequent and rare in the scoring period.
FREQUENT_HOURS = (4, 5, 9, 10, 13, 14)
RARE_HOURS = (6, 11, 15)
# Fixed values: (frequent, rare, other) codes of the two bucket codings in use.
BUCKET_CODES = {"rare_last": (1, 3, 2), "other_last": (1, 2, 3)}

SECONDS_PER_DAY = 86400


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_timestamp(text: str | Column) -> Column:
    """Text to timestamp; NULL where the text is not one."""
    return F.try_to_timestamp(_col(text))


def hour_of(ts: str | Column) -> Column:
    return F.hour(_col(ts)).cast("bigint")


def day_of(ts: str | Column) -> Column:
    return F.dayofmonth(_col(ts)).cast("bigint")


def weekday_no(ts: str | Column) -> Column:
    """Monday = 1 ... Sunday = 7."""
    return (F.weekday(_col(ts)) + 1).cast("bigint")


def date_int(date: str | Column) -> Column:
    """Date as the integer YYYYMMDD."""
    return F.date_format(_col(date), "yyyyMMdd").cast("int")


def shift_hours(ts: str | Column, hours: int = 8) -> Column:
    return _col(ts) + F.make_dt_interval(hours=F.lit(hours))


def in_test_hh(hour: str | Column, coding: str = "rare_last") -> Column:
    """Time-of-day bucket: frequent, rare or other hour of the scoring period."""
    frequent, rare, other = BUCKET_CODES[coding]
    h = _col(hour)
    return F.when(h.isin(*FREQUENT_HOURS), frequent).when(h.isin(*RARE_HOURS), rare).otherwise(other)


def micros(ts: str | Column) -> Column:
    return F.unix_micros(_col(ts).cast("timestamp"))


def epoch_seconds(ts: str | Column) -> Column:
    return F.floor(micros(ts) / F.lit(1_000_000)).cast("bigint")


def gap_seconds(earlier: Column, later: Column, mode: str = "component") -> Column:
    """Seconds between two microsecond values.

    ``component``: whole seconds modulo one day, so a negative gap wraps to a positive value.
    ``epoch``: both sides truncated to whole seconds first, then subtracted.
    ``total``: the full gap with its fraction.
    """
    if mode == "component":
        whole = F.floor((later - earlier) / F.lit(1_000_000)).cast("bigint")
        return F.pmod(whole, F.lit(SECONDS_PER_DAY))
    if mode == "epoch":
        truncate = lambda v: F.floor(v / F.lit(1_000_000)).cast("bigint")
        return truncate(later) - truncate(earlier)
    if mode == "total":
        return (later - earlier) / F.lit(1_000_000)
    raise ValueError(mode)


def substring_parts(text: str | Column) -> dict[str, Column]:
    """Date, hour, minute and second of ``YYYY-MM-DD hh:mm:ss`` text, cut by position."""
    t = _col(text)
    cut = lambda start: F.substring(t, start, 2).try_cast("double")
    return {
        "date": F.substring(t, 1, 10).try_cast("date"),
        "hr": cut(12),
        "mn": cut(15),
        "se": cut(18),
    }
