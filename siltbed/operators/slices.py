"""Splitting the ten last digits over workers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def slice_bounds(parallel: Column | int) -> tuple[Column, Column]:
    """Inclusive digit range of the ``worker`` column for a worker count."""
    n = F.lit(parallel) if isinstance(parallel, int) else parallel
    worker = F.col("worker")
    base = F.floor(F.lit(10) / n).cast("int")
    wide = F.lit(10) % n
    lower = worker * base + F.least(worker, wide)
    upper = lower + base - F.when(worker < wide, 0).otherwise(1)
    return lower.cast("int"), upper.cast("int")


def slice_range(worker: int, parallel: int) -> tuple[int, int]:
    """Inclusive digit range of one worker."""
    base, wide = divmod(10, parallel)
    lower = worker * base + min(worker, wide)
    return lower, lower + base - (0 if worker < wide else 1)


def slice_plan(spark: SparkSession, parallel: int) -> DataFrame:
    """One row per worker: ``worker, lb, up``. The worker count is kept in 1..10."""
    n = min(max(parallel, 1), 10)
    lower, upper = slice_bounds(n)
    return spark.range(n, numPartitions=1).select(
        F.col("id").cast("int").alias("worker")
    ).select("worker", lower.alias("lb"), upper.alias("up"))


def jdbc_predicates(key: str, parallel: int, dialect: str = "mod", splits: int = 1) -> list[str]:
    """WHERE texts that together read each sliced key of a database once.

    ``dialect="mod"`` writes ``MOD(key, 10)``, ``"percent"`` writes ``key % 10``.
    ``splits`` cuts each worker's slice further by the tens, for more than ten readers.
    """
    def mod(n: int) -> str:
        return {"mod": f"MOD({key}, {n})", "percent": f"{key} % {n}"}[dialect]

    n = min(max(parallel, 1), 10)
    texts = []
    for worker in range(n):
        lower, upper = slice_range(worker, n)
        slice_text = f"{mod(10)} BETWEEN {lower} AND {upper}"
        if splits == 1:
            texts.append(slice_text)
        for i in range(splits if splits > 1 else 0):
            # Remainders below zero belong to the first split.
            tens = f"BETWEEN {10 * i} AND {10 * i + 9}" if i else "< 10"
            texts.append(f"{slice_text} AND {mod(10 * splits)} {tens}")
    return texts
