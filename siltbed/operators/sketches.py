"""Mergeable column statistics: numbers of rows and nulls, distinct values, quantiles.

Distinct values come from a HyperLogLog sketch, quantiles of numbers, dates and instants
from a KLL sketch, so statistics of written parts are merged without reading rows again.
The estimates of distinct values are within 5 % (three standard errors at ``LG_K``), the
ranks of quantiles within 3 %.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

LG_K = 12
QUANTILES = (0.0, 0.25, 0.5, 0.75, 1.0)
COUNTS = ("row_count", "null_count")


def _quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def _countable(value: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.IntegralType):
        return value.cast("bigint")
    if isinstance(kind, (T.MapType, T.ArrayType, T.StructType, T.VariantType)):
        return F.to_json(value)
    return value.cast("string")


def as_number(value: Column, kind: T.DataType) -> Column | None:
    """A value on the scale of its quantiles: days of a date, seconds of an instant."""
    if isinstance(kind, T.NumericType):
        return value.cast("double")
    if isinstance(kind, T.DateType):
        return F.unix_date(value).cast("double")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(value.cast("timestamp")) / 1e6
    return None


def column_sketches(df: DataFrame, by: Sequence[str] = (), columns: Sequence[str] | None = None) -> DataFrame:
    """One row per column (and value of ``by``): counts and the two sketches.

    All columns are folded in one pass; a group moves one row per task.
    """
    names = list(columns if columns is not None else [c for c in df.columns if c not in by])
    aggregates, structs = [F.count("*").alias("rows")], []
    for i, c in enumerate(names):
        kind = df.schema[c].dataType
        number = as_number(_quoted(c), kind)
        # Neither sketch takes a not-a-number for a value in order.
        plain = F.when(~F.isnan(number), number) if number is not None else None
        aggregates += [F.count(_quoted(c)).alias(f"present{i}"), F.hll_sketch_agg(_countable(_quoted(c), kind), LG_K).alias(f"distinct{i}"),
                       (F.kll_sketch_agg_double(plain) if number is not None else F.first(F.lit(None).cast("binary"))).alias(f"quantiles{i}"),
                       (F.count(plain) if number is not None else F.first(F.lit(0).cast("bigint"))).alias(f"numbers{i}")]
        structs.append(F.struct(F.lit(c).alias("column_name"), F.col("rows").alias("row_count"), (F.col("rows") - F.col(f"present{i}")).alias("null_count"),
                                F.coalesce(f"numbers{i}", F.lit(0)).cast("bigint").alias("numbers"),
                                F.col(f"distinct{i}").alias("distinct"), F.col(f"quantiles{i}").alias("quantiles")))
    folded = df.groupBy(*map(_quoted, by)).agg(*aggregates)
    return folded.select(*map(_quoted, by), F.inline(F.array(*structs)))


def merged(sketches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Sketches of parts as those of the whole, per column (and value of ``by``)."""
    return sketches.groupBy(*map(_quoted, by), "column_name").agg(
        *[F.sum(c).alias(c) for c in (*COUNTS, "numbers")], F.hll_union_agg("distinct").alias("distinct"),
        F.kll_merge_agg_double(F.when(F.col("numbers") > 0, F.col("quantiles"))).alias("quantiles"))


def estimates(sketches: DataFrame) -> DataFrame:
    """(column_name, row_count, null_count, distinct_count, quantiles) of merged sketches.

    Quantiles are an array at ``QUANTILES``, null where a column has no numbers.
    """
    points = F.array(*[F.lit(q) for q in QUANTILES])
    return sketches.select(
        "column_name", *COUNTS, F.hll_sketch_estimate("distinct").alias("distinct_count"),
        F.when(F.col("numbers") > 0, F.kll_sketch_get_quantile_double(
            F.when(F.col("numbers") > 0, F.col("quantiles")), points)).alias("quantiles"))
