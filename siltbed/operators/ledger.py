"""Accounting: backlog, moved counts, batch ledger, run summaries and audits."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from siltbed.functions.progress import is_end, progress_count, progress_duration_us
from siltbed.functions.scalars import worker_of
from siltbed.operators.batch import running_sums
from siltbed.operators.select import eligible_keys, matching
from siltbed.operators.slices import slice_plan
from siltbed.spec import RunOptions, Tree


def backlog(tree: Tree, live_root: DataFrame, options: RunOptions) -> DataFrame:
    """Eligible rows still live, per worker; a worker with none has a zero row."""
    left = eligible_keys(tree, live_root, options).groupBy(
        worker_of(tree.root.key, options.parallel).alias("worker")).agg(F.count("*").alias("n"))
    plan = slice_plan(live_root.sparkSession, options.parallel).select("worker")
    return plan.join(left, "worker", "left").select(
        "worker", F.coalesce("n", F.lit(0)).cast("bigint").alias("backlog"))


def counts_per_table(rows: Mapping[str, DataFrame], name: str = "moved") -> DataFrame:
    """``table_name`` and a row count per table; one partial aggregate per scan."""
    counts = [df.agg(F.count("*").alias(name)).select(F.lit(t).alias("table_name"), name) for t, df in rows.items()]
    return reduce(DataFrame.unionByName, counts)


def write_counted(rows: Mapping[str, DataFrame], write: Callable[[str, DataFrame], None], name: str = "moved") -> DataFrame:
    """Write each table by ``write(table, rows)``; the counts of ``counts_per_table``, taken while writing.

    Nothing is read again. ``write`` must run one job that writes the rows it is given as they
    come, without an exchange: then they are counted in the stage that writes, where Spark takes the
    numbers of one attempt per task. An exchange in front, in ``rows``, does no harm.
    """
    counts = []
    for table, df in rows.items():
        seen = Observation()
        write(table, df.observe(seen, F.count("*").alias(name)))
        counts.append((table, seen.get[name]))
    spark = next(iter(rows.values())).sparkSession
    return spark.createDataFrame(counts, f"table_name string, {name} bigint")


def total_records(per_table: DataFrame, root: str, name: str = "moved") -> DataFrame:
    """Root rows and all records of a run."""
    return per_table.agg(
        F.sum(F.when(F.col("table_name") == root, F.col(name)).otherwise(0)).cast("bigint").alias("roots"),
        F.sum(name).cast("bigint").alias("records"))


def batch_id_lists(numbered: DataFrame, key: str) -> DataFrame:
    """Keys of each batch as ordered text; a list is as long as one batch."""
    return numbered.groupBy("worker", "batch_no").agg(
        F.array_join(F.sort_array(F.collect_list(key)), ",").alias("ids"))


def batch_ledger(tree: Tree, tables: Mapping[str, DataFrame], numbered: DataFrame, options: RunOptions) -> DataFrame:
    """Roots and records per worker and batch, before anything is moved.

    Dependents of the chosen keys are counted per link value, so a key with very many
    rows is folded on the map side, and only one row per key meets the batch numbers.
    The counts of deeper tables are pulled up along their parents the same way.
    ``numbered`` holds the root key, ``worker`` and ``batch_no``.
    """
    def below(name: str, keys: DataFrame) -> DataFrame | None:
        """Per chosen key of table ``name``: records in all tables under it."""
        parts = []
        for t in tree.children(name):
            rows = matching(tables[t.name], t.link, keys)
            deeper = below(t.name, rows.select(t.key)) if tree.children(t.name) else None
            if deeper is None:
                parts.append(rows.groupBy(F.col(t.link).alias("__k")).agg(F.count("*").alias("__n")))
            else:
                linked = rows.select(F.col(t.link).alias("__up"), F.col(t.key).alias("__k"))
                parts.append(linked.join(deeper, "__k", "left").groupBy(F.col("__up").alias("__k")).agg(
                    (F.count("*") + F.coalesce(F.sum("__n"), F.lit(0))).alias("__n")))
        if not parts:
            return None
        return reduce(DataFrame.unionByName, parts).groupBy("__k").agg(F.sum("__n").alias("__n"))

    keys = numbered.select(F.col(tree.root.key).alias("__k"), "worker", "batch_no")
    counts = below(tree.root.name, keys.select("__k"))
    joined = keys.withColumn("__n", F.lit(0)) if counts is None else keys.join(counts, "__k", "left")
    batches = joined.groupBy("worker", "batch_no").agg(
        F.count("*").alias("roots"), (F.count("*") + F.coalesce(F.sum("__n"), F.lit(0))).cast("bigint").alias("records"))
    plan = slice_plan(numbered.sparkSession, options.parallel).select("worker")
    zero = F.lit(0).cast("bigint")
    return plan.join(batches, "worker", "left").select(
        "worker", F.coalesce("batch_no", F.lit(1).cast("bigint")).alias("batch_no"),
        F.coalesce("roots", zero).alias("roots"), F.coalesce("records", zero).alias("records"))


def running_totals(ledger: DataFrame) -> DataFrame:
    """Roots, records and time of a worker up to and including each batch."""
    return running_sums(ledger, ["run_id", "worker"], "batch_no", {
        "roots_so_far": "roots", "records_so_far": "records", "us_so_far": "duration_us"})


def per_worker(ledger: DataFrame) -> DataFrame:
    return ledger.groupBy("run_id", "worker").agg(
        F.sum("roots").alias("roots"), F.sum("records").alias("records"),
        F.max("batch_no").alias("batches"), F.sum("duration_us").alias("duration_us"))


def run_summary(ledger: DataFrame) -> DataFrame:
    """Sum of counts and the longest worker time of each run."""
    return per_worker(ledger).groupBy("run_id").agg(
        F.count("*").alias("workers"), F.sum("roots").alias("total_count"),
        F.sum("records").alias("total_records"), F.max("duration_us").alias("max_duration_us"))


def status_label(warning: Column, failures: Column) -> Column:
    """A warning outranks failures, failures outrank success."""
    return (F.when(warning.isNotNull(), "Warning")
            .when(F.coalesce(failures, F.lit(0)) > 0, "Failed").otherwise("Success"))


def run_status(outcomes: DataFrame) -> DataFrame:
    """Status per run from one outcome row per worker: ``run_id, failed, warning``."""
    per_run = outcomes.groupBy("run_id").agg(
        F.sum(F.col("failed").cast("bigint")).alias("failed_workers"), F.min("warning").alias("warning"))
    return per_run.select("run_id", "failed_workers",
                          status_label(F.col("warning"), F.col("failed_workers")).alias("status"))


def fold_messages(lines: DataFrame, salts: int = 32) -> DataFrame:
    """Counts and durations per run and worker, up to the first end marker.

    The marker's line number is a map-side minimum per worker. It is joined back
    over salted lines, so a worker that holds most of the lines is neither one
    window nor one join partition.
    """
    who = ["run_id", "worker"]
    ends = lines.groupBy(*who).agg(F.min(F.when(is_end("message"), F.col("line_no"))).alias("__end"))
    ends = ends.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    counted = lines.select(
        *who, F.col("line_no"), F.pmod("line_no", F.lit(salts)).cast("int").alias("__salt"),
        progress_count("message").alias("n"), progress_duration_us("message").alias("us"))
    inside = F.col("__end").isNull() | (F.col("line_no") < F.col("__end"))
    zero = F.lit(0).cast("bigint")
    return counted.join(ends, [*who, "__salt"]).groupBy(*who).agg(
        F.coalesce(F.sum(F.when(inside, F.col("n"))), zero).alias("total_count"),
        F.coalesce(F.sum(F.when(inside, F.col("us"))), zero).alias("duration_us"),
        F.max(F.col("__end").isNotNull()).alias("completed"))


def conservation(before: Mapping[str, DataFrame], moved: Mapping[str, DataFrame],
                 kept: Mapping[str, DataFrame]) -> DataFrame:
    """Per table: rows before, moved and kept, and whether they add up."""
    joined = counts_per_table(before, "before").join(
        counts_per_table(moved, "moved"), "table_name").join(counts_per_table(kept, "kept"), "table_name")
    return joined.withColumn("ok", F.col("before") == F.col("moved") + F.col("kept"))


def moved_by_worker(tree: Tree, tables: Mapping[str, DataFrame], keys: DataFrame, parallel: int) -> DataFrame:
    """Rows of each table that each worker moves; slices are a column, not jobs.

    A dependent's worker is that of its root key, carried down the key relations.
    """
    tagged = {tree.root.name: keys.select(F.col(keys.columns[0]).alias("__k"),
                                          worker_of(keys.columns[0], parallel).alias("worker"))}
    out = [tagged[tree.root.name].groupBy("worker").agg(F.count("*").alias("moved"))
           .select(F.lit(tree.root.name).alias("table_name"), "worker", "moved")]
    for t in tree.dependents:
        chosen = matching(tables[t.name], t.link, tagged[t.parent].select("__k"))
        per_key = chosen.groupBy(F.col(t.link).alias("__k")).agg(F.count("*").alias("__n"))
        out.append(per_key.join(tagged[t.parent], "__k").groupBy("worker").agg(
            F.sum("__n").alias("moved")).select(F.lit(t.name).alias("table_name"), "worker", "moved"))
        if tree.children(t.name):
            linked = chosen.select(F.col(t.link).alias("__up"), F.col(t.key).alias("__c"))
            up = tagged[t.parent].withColumnRenamed("__k", "__up")
            owned = linked.join(up, "__up").select(F.col("__c").alias("__k"), "worker")
            tagged[t.name] = owned if t.unique else owned.groupBy("__k").agg(F.min("worker").alias("worker"))
    return reduce(DataFrame.unionByName, out)
