"""Run logs: rendering ledgers as text lines, writing them and reading them back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltbed.functions.progress import END_MARKER, OUT_OF_TIME, TABLE_PROGRESS, TIME_LIMIT, TREE_PROGRESS
from siltbed.functions.scalars import MICROS, micros_to_text, seconds_to_text, ts_text
from siltbed.operators.batch import POSITION, number_rows, running_sums
from siltbed.operators.ledger import fold_messages, per_worker
from siltbed.session import scratch_path

HEADER_LINES = 3


def progress_text(roots: Column, records: Column, duration_us: Column, single_table: bool = False) -> Column:
    """The progress message, in the format the parser reads."""
    counts = F.format_string(TABLE_PROGRESS, records) if single_table else F.format_string(TREE_PROGRESS, roots, records)
    return F.concat(counts, micros_to_text(duration_us))


def render_lines(
    ledger: DataFrame, started: Column, cutoff: Column, lower: Column, upper: Column, time_limit_sec: int,
    max_batches: int = 0, single_table: bool = False
) -> DataFrame:
    """Log lines of every worker: ``run_id, worker, line_no, message``.

    A header, two lines per batch, then the end marker and the totals. Line numbers
    follow from batch numbers, so nothing is sorted or counted per worker.
    ``lower`` and ``upper`` are expressions over the ``worker`` column.
    """
    def at(us: Column) -> Column:
        return ts_text(F.timestamp_add("MICROSECOND", us, started))

    def line(no: Column, us: Column, text: Column):
        return F.struct(no.cast("bigint").alias("line_no"), F.concat(at(us), F.lit(" : "), text).alias("message"))

    zero = F.lit(0).cast("bigint")
    batch = F.col("batch_no")
    summed = running_sums(ledger, ["run_id", "worker"], "batch_no", {"us_so_far": "duration_us"})
    batch_lines = summed.select("run_id", "worker", F.inline(F.array(
        line(HEADER_LINES + batch * 2 - 1, F.col("us_so_far") - F.col("duration_us"),
             F.format_string("[%d/%d]", batch, F.lit(max_batches))),
        line(HEADER_LINES + batch * 2, F.col("us_so_far"),
             progress_text(F.col("roots"), F.col("records"), F.col("duration_us"), single_table)))))

    total = per_worker(ledger)
    last = HEADER_LINES + F.col("batches") * 2
    us = F.col("duration_us")
    late = us > time_limit_sec * MICROS
    ended = F.when(F.lit(time_limit_sec > 0) & late, F.format_string(
        OUT_OF_TIME, F.lit(time_limit_sec))).otherwise(END_MARKER)
    edge_lines = total.select("run_id", "worker", F.inline(F.array(
        line(F.lit(1), zero, F.concat(F.lit("Rows placed before "), cutoff.cast("string"), F.lit(" are archived."))),
        line(F.lit(2), zero, F.format_string("Keys ending in %d to %d", lower, upper)),
        line(F.lit(3), zero, F.concat(F.lit(TIME_LIMIT), seconds_to_text(F.lit(time_limit_sec)))),
        line(last + 1, us, ended),
        line(last + 2, us, F.lit("Total")),
        line(last + 3, us, progress_text(F.col("roots"), F.col("records"), us, single_table)))))
    return batch_lines.unionByName(edge_lines)


def merge_workers(lines: DataFrame) -> DataFrame:
    """One log per run: a heading per worker, its lines, and a footer per run."""
    heads = lines.groupBy("run_id", "worker").agg(F.max("line_no").alias("n"))
    folded = fold_messages(lines).groupBy("run_id").agg(
        F.sum("total_count").alias("total"), F.max("duration_us").alias("us"))
    heading = heads.select("run_id", "worker", F.lit(0).cast("bigint").alias("line_no"),
                           F.concat(F.lit("Worker "), F.col("worker").cast("string")).alias("message"))
    footer = folded.select("run_id", F.inline(F.array(
        F.struct(F.lit(10).alias("worker"), F.lit(1).cast("bigint").alias("line_no"),
                 F.concat(F.lit("Total Count: "), F.col("total").cast("string")).alias("message")),
        F.struct(F.lit(10).alias("worker"), F.lit(2).cast("bigint").alias("line_no"),
                 F.concat(F.lit("Total Duration: "), micros_to_text("us")).alias("message")))))
    return lines.unionByName(heading).unionByName(footer)


def write_run_log(lines: DataFrame, path: str, per_worker_dirs: bool = False) -> None:
    """Text files in (worker, line) order below one directory per run.

    Range partitioning keeps the order across files by file name, whatever the size.
    """
    dirs = ["run_id", "worker"] if per_worker_dirs else ["run_id"]
    order = ["run_id", "worker", "line_no"]
    (lines.repartitionByRange(*order).sortWithinPartitions(*order)
          .select(*dirs, "message").write.partitionBy(*dirs).text(path))


def read_run_log(spark: SparkSession, path: str) -> DataFrame:
    """Lines of text logs with their numbers: directory columns, ``line_no, message``.

    Files stay splittable: a line's number is its place in its split plus the
    lines of the splits, and of the files by name, in front of it.
    """
    raw = spark.read.text(path)
    dirs = [c for c in raw.columns if c != "value"]
    staged_path = scratch_path(spark, "runlog")
    meta = F.col("_metadata")
    (raw.select(*dirs, F.col("value").alias("message"), meta["file_name"].alias("__file"),
                meta["file_block_start"].alias("__start"), F.monotonically_increasing_id().alias(POSITION))
        .write.parquet(staged_path))
    staged = spark.read.parquet(staged_path)
    numbered = number_rows(staged, dirs, "line_no", run=["__file", "__start"])
    return numbered.select(*dirs, "line_no", "message")
