"""Audits of contents: a move must not alter, blank, lose or repeat a row.

The content of a relation is a hash of its bag of rows that doesn't depend on their
order: sums and the exclusive or of one 64-bit hash per row over all columns. Parts of
it are merged by adding, so the content of a table before a move is that of the moved
and the kept rows together. Hashes are folded on the map side to one row per task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Sums of 21 or 22 bits of the hashes: exact for 2^41 rows and more.
PIECES = ((0, 21), (21, 21), (42, 22))
SUMS = tuple(f"sum{i}" for i in range(len(PIECES)))


def _quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def _hashable(name: str, kind: T.DataType) -> Column:
    """A column in a form whose hash sees all of its value, nulls inside included."""
    value = _quoted(name)
    if isinstance(kind, T.MapType):
        value, kind = F.array_sort(F.map_entries(value)), T.ArrayType(T.StructType())
    if isinstance(kind, (T.ArrayType, T.StructType)):
        return F.to_json(value, {"ignoreNullFields": "false"})
    return F.to_json(value) if isinstance(kind, T.VariantType) else value


def row_hash(df: DataFrame, columns: Sequence[str] | None = None) -> Column:
    """64-bit hash of a row's columns in the order given.

    Hashing passes over nulls, so which columns are null goes into the hash too.
    """
    names = list(columns if columns is not None else df.columns)
    nulls = F.concat_ws("", *[_quoted(c).isNull().cast("int").cast("string") for c in names])
    return F.xxhash64(nulls, *[_hashable(c, df.schema[c].dataType) for c in names])


def content(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row: ``row_count``, three sums and ``mixed``, the exclusive or of the row hashes."""
    hashed = df.select(row_hash(df, columns).alias("h"))
    zero = F.lit(0).cast("bigint")
    sums = [F.coalesce(F.sum(F.shiftrightunsigned("h", at).bitwiseAND((1 << bits) - 1)), zero).alias(name)
            for name, (at, bits) in zip(SUMS, PIECES)]
    return hashed.agg(F.count("*").alias("row_count"), *sums, F.coalesce(F.bit_xor("h"), zero).alias("mixed"))


def _joined(contents: Mapping[str, DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, [df.withColumn("side", F.lit(side)) for side, df in contents.items()])


def content_conservation(before: Mapping[str, DataFrame], moved: Mapping[str, DataFrame], kept: Mapping[str, DataFrame],
                         columns: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
    """Per table: rows before, moved and kept, whether they add up (``count_ok``) and
    whether every row is on one side as it was (``content_ok``).

    Columns are compared by name, those of ``before`` or those that ``columns`` names
    for a table; types must be the same on all sides.
    """
    out = []
    for table, rows in before.items():
        names = list((columns or {}).get(table) or rows.columns)
        for side in (moved[table], kept[table]):
            wrong = [c for c in names if c not in side.columns or side.schema[c].dataType != rows.schema[c].dataType]
            if wrong:
                raise ValueError(f"{table}: {', '.join(wrong)} not on both sides with one type")
        sides = _joined({"before": content(rows, names), "moved": content(moved[table], names), "kept": content(kept[table], names)})
        gone = F.col("side") != "before"
        count = lambda side: F.sum(F.when(F.col("side") == side, F.col("row_count"))).alias(side)
        same = [F.sum(F.when(gone, F.col(c)).otherwise(-F.col(c))) == 0 for c in SUMS]
        out.append(sides.agg(
            *map(count, ("before", "moved", "kept")),
            (F.sum(F.when(gone, F.col("row_count")).otherwise(-F.col("row_count"))) == 0).alias("count_ok"),
            reduce(Column.__and__, [*same, F.bit_xor("mixed") == 0]).alias("same"))
            .select(F.lit(table).alias("table_name"), "before", "moved", "kept", "count_ok",
                    (F.col("count_ok") & F.col("same")).alias("content_ok")))
    return reduce(DataFrame.unionByName, out)
