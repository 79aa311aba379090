"""Reading counts, durations and end markers out of progress messages."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from siltbed.functions.scalars import MICROS, _col

# The message formats that existing run logs use.
COUNT_PATTERN = r":\s*(\d+)\s+\w+\(s\)"
DURATION_PATTERN = r"Duration\s*:\s*(\d{2,}):(\d{2}):(\d{2})(?:\.(\d+))?"
END_MARKER = "Completed"
TIME_PREFIX = 22
TREE_PROGRESS = "%d order(s),%d record(s) archived.  Duration : "
TABLE_PROGRESS = "%d record(s) archived.  Duration : "
OUT_OF_TIME = "Completed. (The %d second(s) time limit has been exceeded)"
TIME_LIMIT = "Time Limit : "
ID_LIST = "Order(s) to be archived: [%s]"
NOT_COMPLETED = "Not completed, but records processed before the error were successfully committed."
WRITE_FAILED = "write failed: %s"


def progress_count(message: str | Column) -> Column:
    """First ``: <n> <word>(s)`` count of the message, NULL where there is none."""
    return F.regexp_extract(_col(message), COUNT_PATTERN, 1).try_cast("bigint")


def progress_duration_us(message: str | Column) -> Column:
    """``Duration : HH:MM:SS[.fraction]`` in microseconds, NULL where absent.

    The fraction is decimal: ``.5`` is half a second.
    """
    m = _col(message)

    def part(i: int) -> Column:
        return F.regexp_extract(m, DURATION_PATTERN, i)

    whole = (part(1).try_cast("bigint") * 3600 + part(2).try_cast("bigint") * 60
             + part(3).try_cast("bigint")) * MICROS
    return whole + F.rpad(part(4), 6, "0").cast("bigint")


def is_end(message: str | Column) -> Column:
    return F.contains(_col(message), F.lit(END_MARKER))


def strip_time_prefix(message: str | Column) -> Column:
    """Drop the 22 leading characters of the time prefix from longer messages."""
    m = _col(message)
    return F.when(F.length(m) > TIME_PREFIX, F.substring(m, TIME_PREFIX + 1, 2**31 - 1)).otherwise(m)
