"""The archive specs bound to the test tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltbed.functions.scalars import worker_of
from siltbed.operators.batch import assign_batches
from siltbed.operators.ledger import batch_ledger
from siltbed.operators.select import eligible_filter, eligible_keys
from siltbed.operators.slices import slice_bounds
from siltbed.session import stage
from siltbed.sources.runlog import render_lines
from siltbed.spec import RunOptions, Table, Tree

ORDER_TREE = Tree(
    Table("orders", "o_orderkey"),
    (Table("lineitem", "l_orderkey", unique=False, parent="orders", link="l_orderkey"),),
    age_column="o_orderdate", months=13, status_column="o_orderstatus", statuses=("F", "P"),
    segment_months=12)
ORDER_RUN = RunOptions(as_of=dt.date(1998, 1, 1), parallel=3, batch_size=20)

CUSTOMER_TREE = Tree(
    Table("customer", "c_custkey"),
    (Table("orders", "o_orderkey", parent="customer", link="o_custkey"),
     Table("events", "event_id", parent="customer", link="user_id"),
     Table("lineitem", "l_orderkey", unique=False, parent="orders", link="l_orderkey")),
    status_column="c_mktsegment", statuses=("BUILDING", "MACHINERY"))
CUSTOMER_RUN = RunOptions(as_of=dt.date(1998, 1, 1), last_digit=3)

EVENT_TABLE = Tree(Table("events", "event_id"), age_column="ts", months=2)
EVENT_RUN = RunOptions(as_of=dt.date(2024, 3, 15), parallel=3, batch_size=300)

SHIP_TABLE = Tree(Table("lineitem", "l_orderkey", unique=False), age_column="l_shipdate", months=2, age_is_date=True,
                  segment_months=12)
SHIP_RUN = RunOptions(as_of=dt.date(1997, 2, 1), parallel=3, batch_size=300)

ORDER_CUTOFF = dt.date(1996, 12, 1)
RUN_ID = "run-1"
TIME_LIMIT = 10_800


def load(spark: SparkSession, sf_dir: str, *names: str) -> dict[str, DataFrame]:
    return {n: spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in names}


def tree_tables(spark: SparkSession, sf_dir: str, tree: Tree) -> dict[str, DataFrame]:
    return load(spark, sf_dir, *[t.name for t in tree.tables])


def order_keys(tables: dict[str, DataFrame], options: RunOptions = ORDER_RUN) -> DataFrame:
    return eligible_keys(ORDER_TREE, tables["orders"], options)


def numbered_orders(tables: dict[str, DataFrame], options: RunOptions = ORDER_RUN) -> DataFrame:
    """Eligible order keys with worker and batch number."""
    return assign_batches(order_keys(tables, options), worker_of("o_orderkey", options.parallel),
                          "o_orderkey", options.batch_size)


def order_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ledger table of the order tree with a duration that follows from the counts."""
    tables = tree_tables(spark, sf_dir, ORDER_TREE)
    rows = batch_ledger(ORDER_TREE, tables, numbered_orders(tables), ORDER_RUN)
    return stage(rows.select(F.lit(RUN_ID).alias("run_id"), "*",
                             (F.col("records") * 1000 + F.col("roots")).alias("duration_us")), "ledger")


def order_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    lower, upper = slice_bounds(ORDER_RUN.parallel)
    return render_lines(order_ledger(spark, sf_dir), F.lit(dt.datetime(1998, 1, 1, 10, 55)).cast("timestamp_ntz"),
                        F.lit(ORDER_CUTOFF), lower, upper, TIME_LIMIT)


def order_log_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same lines as a table, for operators that read a finished log."""
    return stage(order_log(spark, sf_dir), "log")


def event_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log of a single-table run over the events; a row takes a millisecond."""
    events = load(spark, sf_dir, "events")["events"].where(eligible_filter(EVENT_TABLE, EVENT_RUN))
    numbered = assign_batches(events.select("event_id"), worker_of("event_id", 3), "event_id", EVENT_RUN.batch_size)
    counts = numbered.groupBy("worker", "batch_no").agg(F.count("*").alias("roots"))
    book = stage(counts.select(F.lit(RUN_ID).alias("run_id"), "*", F.col("roots").alias("records"),
                               (F.col("roots") * 1000).alias("duration_us")), "ledger")
    return render_lines(book, F.lit(dt.datetime(2024, 3, 15)).cast("timestamp_ntz"), F.lit(dt.date(2024, 1, 15)),
                        *slice_bounds(3), TIME_LIMIT, single_table=True)
