"""Upkeep after a move: statistics, compaction, and dropping unreferenced versions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltbed.session import advisory_bytes


def column_stats(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Per column: rows, nulls, exact distinct values, minimum and maximum as text.

    Values are unpivoted to (column, value) and folded by value on the map side
    first, so one frequent value is one row per task before the shuffle.
    """
    names = columns or df.columns
    types = {f.name: f.dataType for f in df.schema}
    text = F.array(*[F.struct(F.lit(i).alias("i"), F.col(c).cast("string").alias("v")) for i, c in enumerate(names)])
    values = df.select(F.inline(text)).groupBy("i", "v").agg(F.count("*").alias("n"))
    folded = values.groupBy("i").agg(
        F.sum("n").alias("row_count"), F.sum(F.when(F.col("v").isNull(), F.col("n")).otherwise(0)).alias("null_count"),
        F.count("v").alias("distinct_count"))
    ranges = df.agg(*[f(c).cast("string").alias(f"{p}{i}") for i, c in enumerate(names)
                      for p, f in (("lo", F.min), ("hi", F.max)) if not isinstance(types[c], T.MapType)])
    wide = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(c).alias("column_name"), F.col(f"lo{i}").alias("min_value"),
                              F.col(f"hi{i}").alias("max_value")) for i, c in enumerate(names)])
    return ranges.select(F.inline(wide)).join(folded, "i", "left").select(
        "column_name", *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c)
                         for c in ("row_count", "null_count", "distinct_count")], "min_value", "max_value")


def column_ranges(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """One row: the row count, and nulls, minimum and maximum of each column in its own type.

    A single pass without a shuffle of values; ``nulls_``, ``min_`` and ``max_`` come
    before the column's name.
    """
    ordered = [c for c in columns or df.columns if not isinstance(df.schema[c].dataType, (T.MapType, T.VariantType))]
    return df.agg(
        F.count("*").alias("row_count"),
        *[f.alias(f"{name}_{c}") for c in ordered for name, f in (
            ("nulls", F.count_if(F.col(c).isNull())), ("min", F.min(c)), ("max", F.max(c)))])


def analyze(spark: SparkSession, tables: list[str]) -> None:
    """Refresh optimizer statistics of catalog tables, once per table."""
    for name in tables:
        spark.sql(f"ANALYZE TABLE {name} COMPUTE STATISTICS FOR ALL COLUMNS")


def rewrite_evenly(df: DataFrame, path: str, target_bytes: int = 128 * 1024 * 1024) -> None:
    """Write ``df`` in files of about the target size.

    REBALANCE lets AQE merge small shuffle blocks and split large ones, so the
    number of files follows the data and no partition count is guessed.
    """
    with advisory_bytes(df.sparkSession, target_bytes):
        df.hint("rebalance").write.parquet(path)
