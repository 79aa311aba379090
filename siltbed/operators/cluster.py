"""Rewriting along a space-filling curve, so that predicates on any of several columns prune files.

Each column is cut at its quantiles into ``2 ** bits`` buckets; the bits of a row's bucket
numbers, taken in turn, are its place on the curve (a Z-order). Rows are dealt and sorted by
place, so a file covers a small range of every column. Sorting by one column would
give the others their whole range in every file.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltbed.operators.audit import row_hash

PLACE, SPREAD = "sb__place", "sb__spread"
BITS = 8
ACCURACY = 10_000
# Bytes of a row by its types for each byte in a file, about.
INFLATION = 4


@dataclass(frozen=True)
class Cuts:
    """Quantiles of each column, ``2 ** bits - 1`` of them, and the number of rows."""

    bits: int
    rows: int
    bounds: dict[str, list]


def cuts_of(rows: DataFrame, columns: Sequence[str], bits: int = BITS) -> Cuts:
    """Approximate quantiles of the columns in one pass; numbers, dates and timestamps."""
    if not columns or bits * len(columns) > 62:
        raise ValueError("one column at least, and at most 62 bits for all of them")
    shares = [i / 2 ** bits for i in range(1, 2 ** bits)]
    found = rows.agg(F.count("*").alias("n"), *[F.percentile_approx(_tick(c), shares, ACCURACY).alias(f"c{i}")
                                                for i, c in enumerate(columns)]).first()
    return Cuts(bits, found["n"], {c: found[f"c{i}"] or [] for i, c in enumerate(columns)})


def bucket(value: Column, bounds: list) -> Column:
    """How many of the sorted bounds are at most ``value``, by halving; 0 for NULL."""
    if not bounds:
        return F.lit(0)
    cut = F.array(*[F.lit(b) for b in bounds])
    steps = F.array(*[F.lit(2 ** k) for k in reversed(range(len(bounds).bit_length()))])
    return F.aggregate(steps, F.lit(0), lambda at, step: at + F.when(F.get(cut, at + step - 1) <= value, step).otherwise(0))


def place(buckets: Sequence[Column], bits: int) -> Column:
    """The buckets' bits taken in turn, highest first."""
    out, n = F.lit(0).cast("bigint"), len(buckets)
    for b in range(bits):
        for j, number in enumerate(buckets):
            bit = F.shiftright(number.cast("bigint"), b).bitwiseAND(F.lit(1).cast("bigint"))
            out = out.bitwiseOR(F.shiftleft(bit, b * n + n - 1 - j))
    return out


def rewrite_clustered(rows: DataFrame, path: str, columns: Sequence[str], cuts: Cuts | None = None,
                      target_bytes: int = 128 * 1024 * 1024) -> Cuts:
    """Write ``rows`` in files of about the target size that are small boxes in ``columns``.

    The input is read once for the cuts and for its number of rows, unless they are given,
    by Spark for the ranges of the files (a sample) and for the write; it is shuffled once. Rows of one
    place, such as those of a very frequent value, are spread over files by their hash.
    """
    cuts = cuts or cuts_of(rows, columns)
    names, buckets = rows.columns, [f"sb__b{i}" for i in range(len(columns))]
    files = max(1, -(-cuts.rows * rows._jdf.schema().defaultSize() // (target_bytes * INFLATION)))
    placed = rows.withColumns({b: bucket(_tick(c), cuts.bounds[c]) for b, c in zip(buckets, columns)}).withColumns(
        {PLACE: place([F.col(b) for b in buckets], cuts.bits), SPREAD: row_hash(rows)})
    (placed.repartitionByRange(files, PLACE, SPREAD).sortWithinPartitions(PLACE, *[_tick(c) for c in columns])
           .select(*[_tick(c) for c in names]).write.parquet(path))
    return cuts


def read_shares(files: DataFrame, cuts: Cuts) -> DataFrame:
    """Per column of a table read from files: ``column_name, files, read_share``.

    ``read_share`` is the mean part of a column's buckets that lies in a file's range, and so
    the part of the files that an equality on the column reads, on average over the buckets.
    """
    columns = list(cuts.bounds)
    ends = files.groupBy(F.col("_metadata.file_path").alias("sb__file")).agg(
        *[f(_tick(c)).alias(f"{p}{i}") for i, c in enumerate(columns) for p, f in (("lo", F.min), ("hi", F.max))])
    width = [bucket(F.col(f"hi{i}"), cuts.bounds[c]) - bucket(F.col(f"lo{i}"), cuts.bounds[c]) + 1 for i, c in enumerate(columns)]
    found = ends.agg(F.count("*").alias("files"), *[F.avg(w / 2 ** cuts.bits).alias(f"s{i}") for i, w in enumerate(width)])
    return found.select(F.inline(F.array(*[F.struct(
        F.lit(c).alias("column_name"), F.col("files"), F.col(f"s{i}").alias("read_share")) for i, c in enumerate(columns)])))


def _tick(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")
