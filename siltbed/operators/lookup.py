"""Rows of a few keys in tables that are not sorted by them: Bloom filters in the files.

Files written with ``bloom_options`` hold a filter of the link values per row group. A
lookup of up to ``FEW`` keys hands the keys to the scan as equalities, so a reader skips
the row groups whose filter (or dictionary, or range) has none of them. More keys than that
would pass most filters anyway and are looked up by a semi-join.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltbed.operators.select import matching

FEW = 200
# With FEW keys a row group without any of them is read for nothing one time in fifty.
FALSE_HITS = 0.0001
# A list of up to this many values goes to the Parquet reader as equalities, a longer one as a range.
PUSHED = 10
EXACT = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.StringType, T.DateType)


def bloom_options(distinct: Mapping[str, int]) -> dict[str, str]:
    """Parquet writer options: a Bloom filter on each column, for so many distinct values in a row group."""
    options = {}
    for column, n in distinct.items():
        options |= {f"parquet.bloom.filter.enabled#{column}": "true", f"parquet.bloom.filter.fpp#{column}": str(FALSE_HITS),
                    f"parquet.bloom.filter.expected.ndv#{column}": str(max(1, n))}
    if distinct:
        # A little over the bits that such a filter needs per value.
        options["parquet.bloom.filter.max.bytes"] = str(max(1024 * 1024, 4 * max(distinct.values())))
    return options


def any_of(column: Column, values: list) -> Column:
    """The column has one of the values; every value reaches the reader as an equality."""
    tests = [column.isin(values[i:i + PUSHED]) for i in range(0, len(values), PUSHED)]
    return reduce(Column.__or__, tests, F.lit(False))


def lookup(rows: DataFrame, link: str, keys: DataFrame, few: int = FEW) -> DataFrame:
    """Rows whose link value is among the keys (first column of ``keys``), as ``matching``.

    At most ``few + 1`` keys come to the driver, repeats among them. NULL matches nothing.
    """
    name = keys.columns[0]
    same = rows.schema[link].dataType == keys.schema[name].dataType
    if not same or not isinstance(rows.schema[link].dataType, EXACT):
        return matching(rows, link, keys)
    found = [r[0] for r in keys.limit(few + 1).collect()]
    if len(found) > few:
        return matching(rows, link, keys)
    return rows.where(any_of(rows[link], sorted({v for v in found if v is not None})))
