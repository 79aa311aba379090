"""Bounded batches: numbering, caps and budgets, without a task per worker.

A worker's rows may be a third of everything, so no window ever spans a worker.
Positions come from a range-partitioned, sorted copy in the shared folder: each
row's place inside its output partition plus the number of rows in front of that
partition. The copy is written once, so a lost executor cannot change a number.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltbed.session import scratch_path

POSITION = "sb__pos"
# monotonically_increasing_id() keeps the partition number above bit 33.
_PARTITION_BITS = 33


def stage_sorted(df: DataFrame, by: Sequence[str], label: str, spread_ties: bool = False) -> DataFrame:
    """Write ``df`` range-partitioned and sorted by ``by``; read it back with positions.

    ``spread_ties`` lets rows that agree on all of ``by`` lie in several partitions.
    """
    path = scratch_path(df.sparkSession, label)
    columns = df.columns
    if spread_ties:
        df = df.withColumn("sb__tie", F.rand(7))
        by = [*by, "sb__tie"]
    (df.repartitionByRange(*by)
       .sortWithinPartitions(*by)
       .select(*columns, F.monotonically_increasing_id().alias(POSITION))
       .write.parquet(path))
    return df.sparkSession.read.parquet(path)


def number_rows(staged: DataFrame, group: Sequence[str], name: str, run: Sequence[str | Column] = ()) -> DataFrame:
    """Number rows 1, 2, ... inside each group, in staged order.

    ``run`` orders stretches of consecutive positions inside a group; the default
    is the output partition. The per-stretch table has one row per partition and
    group, which the number of write tasks bounds, so it is safe to broadcast.
    """
    bounded = not run
    run_cols = list(run) or [F.shiftright(F.col(POSITION), _PARTITION_BITS)]
    run_names = [f"sb__run{i}" for i in range(len(run_cols))]
    tagged = staged.select("*", *[F.col(c).alias(n) if isinstance(c, str) else c.alias(n)
                                  for c, n in zip(run_cols, run_names)])
    keys = [*group, *run_names]
    stretches = tagged.groupBy(*keys).agg(F.min(POSITION).alias("sb__first"), F.count("*").alias("sb__n"))
    ahead = F.sum("sb__n").over(
        Window.partitionBy(*group).orderBy(*run_names).rowsBetween(Window.unboundedPreceding, -1))
    offsets = stretches.select(*keys, (F.coalesce(ahead, F.lit(0)) - F.col("sb__first") + 1).alias("sb__shift"))
    joined = tagged.join(F.broadcast(offsets) if bounded else offsets, keys)
    return joined.withColumn(name, F.col(POSITION) + F.col("sb__shift")).drop(*run_names, "sb__shift", POSITION)


def assign_batches(
    df: DataFrame, worker: Column, key: str, size: int, ties: Sequence[str] = (), unique: bool = True,
    names: tuple[str, str] = ("worker", "batch_no"),
) -> DataFrame:
    """Add ``worker`` and ``batch_no``: ``size`` rows per batch in key order.

    For keys that repeat, ``ties`` orders the copies and rows equal in all of it
    are interchangeable. ``names`` are other names for the two columns.
    """
    rows = df.withColumn(names[0], worker)
    order = [names[0], key, *ties]
    staged = stage_sorted(rows, order, "batches", spread_ties=not unique)
    ranked = number_rows(staged, [names[0]], "sb__rank")
    return ranked.withColumn(names[1], F.floor((F.col("sb__rank") - 1) / size).cast("bigint") + 1).drop("sb__rank")


def cap_batches(numbered: DataFrame, max_batches: int) -> DataFrame:
    """The first ``max_batches`` batches of each worker; 0 means all."""
    return numbered.where(F.col("batch_no") <= max_batches) if max_batches else numbered


def running_sums(
    df: DataFrame, group: Sequence[str], order: str, sums: dict[str, str], block: int = 4096
) -> DataFrame:
    """Running totals per group along a dense integer ``order`` column.

    Windows span one block of ``block`` consecutive order values; what lies in
    front of a block comes from a window over the far smaller block totals.
    """
    blocked = df.withColumn("sb__block", F.floor(F.col(order) / block).cast("bigint"))
    keys = [*group, "sb__block"]
    totals = blocked.groupBy(*keys).agg(*[F.sum(c).alias(f"sb__t_{n}") for n, c in sums.items()])
    ahead = Window.partitionBy(*group).orderBy("sb__block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *keys, *[F.coalesce(F.sum(f"sb__t_{n}").over(ahead), F.lit(0)).alias(f"sb__o_{n}") for n in sums])
    inside = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    joined = blocked.join(offsets, keys)
    return joined.select(
        *df.columns,
        *[(F.sum(c).over(inside) + F.col(f"sb__o_{n}")).cast("bigint").alias(n) for n, c in sums.items()])


def within_budget(ledger: DataFrame, cost: str, budget: int, group: Sequence[str] = ("worker",)) -> DataFrame:
    """Batches a worker still starts: the cost in front of them is within budget.

    The batch that crosses the budget is kept, later ones are not; 0 means all.
    """
    if not budget:
        return ledger
    summed = running_sums(ledger, list(group), "batch_no", {"sb__spent": cost})
    return summed.where(F.col("sb__spent") - F.col(cost) <= budget).drop("sb__spent")
