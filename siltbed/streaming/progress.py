"""Live run progress: counts per worker from a stream of log lines.

Lines may arrive in any order and more than once. They are folded per block of
consecutive lines of a worker, so state is bounded by a block and a worker with very
many lines is spread over tasks. A fold over the blocks gives the worker's totals.
State of a block stays for the life of the stream, so a pause never loses a count;
``bounded`` keeps state of recent lines only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from siltbed.functions.progress import is_end, progress_count, progress_duration_us

BLOCK_LINES = 1024
NO_END = -1


def parsed(lines: DataFrame, *more: str) -> DataFrame:
    """Count, duration and end mark of each line, with its block and ``more`` columns."""
    return lines.select(
        *more, "run_id", "worker", "line_no", F.floor(F.col("line_no") / BLOCK_LINES).cast("bigint").alias("block"),
        progress_count("message").alias("n"), progress_duration_us("message").alias("us"),
        is_end("message").alias("ended"))


def block_sums(lines: DataFrame) -> DataFrame:
    """Sums of each block up to its first end marker, ``end_line`` (``NO_END`` without one).

    A line that comes twice is one member of the block's set of at most
    ``BLOCK_LINES`` lines.
    """
    counts = F.col("n").isNotNull() | F.col("us").isNotNull()
    row = F.struct("line_no", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("us", F.lit(0)).alias("us"))
    folded = parsed(lines).groupBy("run_id", "worker", "block").agg(
        F.collect_set(F.when(counts & ~F.col("ended"), row)).alias("rows"),
        F.min(F.when(F.col("ended"), F.col("line_no"))).alias("end"))
    inside = F.filter("rows", lambda x: F.col("end").isNull() | (x["line_no"] < F.col("end")))

    def total(field: str):
        return F.aggregate(inside, F.lit(0).cast("bigint"), lambda a, x: a + x[field])

    return folded.select("run_id", "worker", "block", total("n").alias("n"), total("us").alias("us"),
                         F.coalesce("end", F.lit(NO_END)).cast("bigint").alias("end_line"))


def read_live_log(spark: SparkSession, path: str, files_per_trigger: int = 1000) -> DataFrame:
    """Stream of log lines that workers append as JSON files."""
    return (spark.readStream.schema("run_id string, worker int, line_no bigint, message string")
            .option("maxFilesPerTrigger", files_per_trigger).option("recursiveFileLookup", "true").json(path))


def start_progress(lines: DataFrame, out: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Write the sums of changed blocks as Parquet; restartable from the checkpoint.

    A batch replaces what an earlier try of it wrote; a later ``update_no`` of a
    block replaces an earlier one.
    """
    def write(changed: DataFrame, batch: int) -> None:
        changed.withColumn("update_no", F.lit(batch).cast("bigint")).write.mode("overwrite").parquet(f"{out}/batch={batch}")

    writer = block_sums(lines).writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def progress_totals(updates: DataFrame) -> DataFrame:
    """Totals per run and worker: blocks up to the first that holds an end marker."""
    latest = updates.groupBy("run_id", "worker", "block").agg(
        F.max_by(F.struct("n", "us", "end_line"), "update_no").alias("b")).select(
        "run_id", "worker", "block", "b.*")
    ends = latest.where(F.col("end_line") != NO_END).groupBy("run_id", "worker").agg(
        F.min("block").alias("__last"))
    inside = latest.join(ends, ["run_id", "worker"], "left").where(
        F.col("__last").isNull() | (F.col("block") <= F.col("__last")))
    return inside.groupBy("run_id", "worker").agg(
        F.sum("n").alias("total_count"), F.sum("us").alias("duration_us"),
        F.max(F.col("__last").isNotNull()).alias("completed"))
