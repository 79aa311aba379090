"""Live run progress with bounded state: an event-time watermark closes what is old.

Lines carry the instant ``at`` they were written. A line that comes twice within
``delay`` counts once. Lines are folded per window of time and block of consecutive
lines; a window is written once, when the watermark (the latest instant seen less
``delay``) has passed its end, and its state is dropped. State so follows the lines of
``delay`` and a window, not the number of runs the stream has seen.

Lines that come after their window was written are not in it. ``late_lines`` finds them
in the feed, and ``bounded_totals`` takes them from there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from siltbed.streaming.progress import NO_END, parsed, progress_totals

SCHEMA = "run_id string, worker int, line_no bigint, message string, at timestamp"
IDENTITY = ["run_id", "worker", "line_no"]
DELAY, WIDTH = "1 hour", "10 minutes"


def read_timed_log(spark: SparkSession, path: str, files_per_trigger: int = 1000) -> DataFrame:
    """Stream of log lines with their instant, which workers append as JSON files."""
    return (spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", files_per_trigger)
            .option("recursiveFileLookup", "true").json(path))


def _line():
    return F.struct("line_no", "n", "us", "ended")


def closed_windows(lines: DataFrame, delay: str = DELAY, width: str = WIDTH) -> DataFrame:
    """One row per window and block, with its distinct lines that say something.

    In append mode a row comes out once its window is closed.
    """
    told = F.col("n").isNotNull() | F.col("us").isNotNull() | F.col("ended")
    once = lines.withWatermark("at", delay).dropDuplicatesWithinWatermark(IDENTITY)
    return parsed(once, "at").groupBy(F.window("at", width).alias("w"), "run_id", "worker", "block").agg(
        F.collect_list(F.when(told, _line())).alias("lines")).select(
        F.col("w.start").alias("opened"), F.col("w.end").alias("closed"), "run_id", "worker", "block", "lines")


def start_bounded(lines: DataFrame, out: str, checkpoint: str, delay: str = DELAY, width: str = WIDTH,
                  available_now: bool = True) -> StreamingQuery:
    """Append closed windows to a Parquet folder, each exactly once; restartable from the checkpoint."""
    writer = closed_windows(lines, delay, width).writeStream.format("parquet").outputMode("append") \
        .option("path", out).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def late_lines(feed: DataFrame, windows: DataFrame, width: str = WIDTH) -> DataFrame:
    """Distinct lines of a feed (read in batch) that say something, whose window was closed
    without them. Those of windows still open aren't late.

    ``feed`` may be narrowed to the days of interest; both sides are joined by line.
    """
    rows = parsed(feed, "at").where(F.col("n").isNotNull() | F.col("us").isNotNull() | F.col("ended"))
    held = windows.select("run_id", "worker", F.inline("lines")).select(*IDENTITY)
    horizon = windows.agg(F.max("closed").alias("horizon"))
    ended = rows.withColumn("closed", F.window("at", width)["end"]).join(F.broadcast(horizon), F.col("closed") <= F.col("horizon"))
    return ended.join(held, IDENTITY, "left_anti").groupBy(*IDENTITY).agg(
        F.first("block").alias("block"), *[F.first(c).alias(c) for c in ("n", "us", "ended")])


def bounded_totals(windows: DataFrame, late: DataFrame | None = None) -> DataFrame:
    """Totals per run and worker from closed windows and late lines, up to the first end marker.

    A block is spread over windows; its lines, of which it has a fixed number, are put together again.
    """
    lines = windows.select("run_id", "worker", "block", F.inline("lines"))
    if late is not None:
        lines = lines.unionByName(late.select(*lines.columns))
    blocks = lines.groupBy("run_id", "worker", "block").agg(
        F.collect_set(_line()).alias("lines"), F.min(F.when(F.col("ended"), F.col("line_no"))).alias("end"))
    inside = F.filter("lines", lambda x: ~x["ended"] & (F.col("end").isNull() | (x["line_no"] < F.col("end"))))

    def total(field: str):
        return F.aggregate(inside, F.lit(0).cast("bigint"), lambda a, x: a + F.coalesce(x[field], F.lit(0)))

    return progress_totals(blocks.select(
        "run_id", "worker", "block", total("n").alias("n"), total("us").alias("us"),
        F.coalesce("end", F.lit(NO_END)).cast("bigint").alias("end_line"), F.lit(0).cast("bigint").alias("update_no")))
