"""Scalar column expressions: age, key slices, time rendering, names.

Everything here is a composition of built-in functions and stays in codegen.
"""

from __future__ import annotations

import calendar
import datetime as dt
from zoneinfo import ZoneInfo

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS = 1_000_000


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def months_before(as_of: dt.date | str | Column, months: int) -> Column:
    """``as_of`` minus whole months, clamped to the month's last day."""
    day = F.lit(as_of) if isinstance(as_of, dt.date) else _col(as_of)
    return F.add_months(day, -months)


def is_instant(c: str | Column) -> Column:
    """Whether a column holds instants (timestamps with a zone); folds to a literal."""
    return F.typeof(_col(c)) == "timestamp"


def midnight(day: dt.date, zone: str) -> Column:
    """The instant a calendar day starts in a zone, whatever the session's zone."""
    start = dt.datetime(day.year, day.month, day.day, tzinfo=ZoneInfo(zone))
    return F.timestamp_seconds(F.lit(int(start.timestamp())))


def months_earlier(day: dt.date, months: int) -> dt.date:
    """``months_before`` of a known day."""
    year, month = divmod(day.year * 12 + day.month - 1 - months, 12)
    return dt.date(year, month + 1, min(day.day, calendar.monthrange(year, month + 1)[1]))


def older_than(age: str | Column, as_of: dt.date, months: int, zone: str = "UTC", as_day: bool = False) -> Column:
    """Strictly before the cutoff day; NULL ages are never older.

    The cutoff folds to a literal, so the comparison reaches the Parquet scan. Days
    and timestamps without a zone compare with the day itself, instants with its
    start in ``zone``. ``as_day`` first turns other values, such as text, into days.
    """
    cutoff = months_earlier(as_of, months)
    day = _col(age).cast("date") if as_day else _col(age)
    return F.when(is_instant(age), _col(age) < midnight(cutoff, zone)).otherwise(day < F.lit(cutoff))


def last_digit(key: str | Column) -> Column:
    """Remainder by ten with the sign of the key: negative keys give no digit 0..9
    except for multiples of ten."""
    return _col(key) % 10


def in_slice(key: str | Column, first: int, last: int) -> Column:
    return last_digit(key).between(first, last)


def worker_of(key: str | Column, parallel: int) -> Column:
    """The worker whose contiguous digit range holds the key's last digit.

    The first ``10 % parallel`` workers own one digit more. NULL outside 0..9.
    """
    base, wide = divmod(10, parallel)
    digit = last_digit(key).cast("int")
    edge = wide * (base + 1)
    worker = F.when(digit < edge, F.floor(digit / (base + 1))).otherwise(
        F.lit(wide) + F.floor((digit - edge) / base)
    )
    return F.when(digit.between(0, 9), worker.cast("int"))


def ts_text(ts: str | Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss``; a timestamp without a zone never meets one."""
    return F.substring(_col(ts).cast("string"), 1, 19)


def elapsed_us(start: str | Column, end: str | Column) -> Column:
    """Microseconds from start to end; both with, or both without, a zone."""
    gap = _col(end) - _col(start)

    def field(unit: str) -> Column:
        return F.extract(F.lit(unit), gap)

    seconds = (field("DAY").cast("bigint") * 86_400 + field("HOUR").cast("bigint") * 3_600
               + field("MINUTE").cast("bigint") * 60)
    return seconds * MICROS + (field("SECOND") * MICROS).cast("bigint")


def _clock(seconds: Column) -> Column:
    return F.format_string(
        "%02d:%02d:%02d",
        F.floor(seconds / 3600).cast("bigint"),
        F.floor(seconds / 60).cast("bigint") % 60,
        seconds % 60,
    )


def _unit(n: Column, singular: str) -> Column:
    plural = "mons" if singular == "mon" else singular + "s"
    return F.when(n == 1, F.lit("1 " + singular)).when(n > 1, F.concat(n.cast("string"), F.lit(" " + plural)))


def seconds_to_text(seconds: str | Column) -> Column:
    """Whole seconds as a normalised interval: 24 h are a day, 30 days a month.

    ``3661`` gives ``01:01:01``, ``90000`` gives ``1 day 01:00:00``.
    """
    s = _col(seconds).cast("bigint")
    days = F.floor(s / 86_400).cast("bigint")
    months = F.floor(days / 30).cast("bigint")
    rest = s % 86_400
    clock = F.when((rest > 0) | (s == 0), _clock(rest))
    years = F.floor(months / 12).cast("bigint")
    return F.concat_ws(" ", _unit(years, "year"), _unit(months % 12, "mon"), _unit(days % 30, "day"), clock)


def micros_to_text(micros: str | Column) -> Column:
    """``HH:MM:SS`` with the fraction only where there is one, trailing zeros cut."""
    us = _col(micros).cast("bigint")
    seconds = F.floor(us / MICROS).cast("bigint")
    fraction = us % MICROS
    tail = F.when(fraction > 0, F.concat(F.lit("."), F.rtrim(F.format_string("%06d", fraction), F.lit("0"))))
    return F.concat(_clock(seconds), F.coalesce(tail, F.lit("")))


def run_name(path: str | Column) -> Column:
    """Last path element without its last extension."""
    base = F.regexp_extract(_col(path), r"([^/]*)/*$", 1)
    return F.regexp_replace(base, r"\.[^.]*$", "")
