"""A growing table drained by scheduled runs, each of which takes the files that are new.

A run starts a file stream with the trigger ``availableNow``: it reads the files that no
earlier run has read, splits their rows by the rule into moved and kept ones and ends. The
checkpoint remembers the files and the sink's own log the finished batches, so a run that
fails in the middle is repeated without a row lost or doubled; only finished batches are
seen by readers. The cost of a run follows the new files, not what was drained before.

Files must be put into the folder whole (written elsewhere and renamed, or by Spark).
A row is judged once, by the rule of the run that reads it. NULL counts as kept; kept rows
that age later are the table move's work (``plans.jobs``), on the folder of kept rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

SIDE, FILE = "sb__side", "sb__file"
MOVED, KEPT = "moved", "kept"


def read_drops(spark: SparkSession, path: str, schema: StructType, files_per_trigger: int = 1000) -> DataFrame:
    """Stream of the Parquet files below ``path`` with the name of each row's file.

    The files known to earlier runs are listed but not read.
    """
    taken = [f.name for f in schema if f.name.lower() in (SIDE, FILE)]
    if taken:
        raise ValueError(f"reserved column names: {', '.join(taken)}")
    rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger) \
        .option("recursiveFileLookup", "true").parquet(path)
    return rows.select(*[F.col(f"`{f.name}`") for f in schema], F.col("_metadata.file_path").alias(FILE))


def start_drain(rows: DataFrame, rule: Column, out: str, checkpoint: str) -> StreamingQuery:
    """Append the split rows of all new files to ``out``, one folder per side, and end."""
    side = F.when(F.coalesce(rule, F.lit(False)), MOVED).otherwise(KEPT)
    return rows.withColumn(SIDE, side).writeStream.format("parquet").outputMode("append").partitionBy(SIDE) \
        .option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def drained(spark: SparkSession, out: str, side: str) -> DataFrame:
    """Rows of one side in finished batches, as they were dropped; the other side's files are not read."""
    return spark.read.parquet(out).where(F.col(SIDE) == side).drop(SIDE, FILE)


def drain_audit(spark: SparkSession, path: str, out: str) -> DataFrame:
    """Per dropped file ``file, before, moved, kept, balanced``.

    A file that no run has read has nothing moved or kept and is not balanced unless it is
    empty, nor is one that is gone from ``path`` (``before`` is 0 then). Rows are counted per
    file before anything is joined.
    """
    names = F.col("_metadata.file_path").alias("file")
    dropped = spark.read.option("recursiveFileLookup", "true").parquet(path).select(names).groupBy("file").agg(
        F.count("*").alias("before"))
    written = spark.read.parquet(out).groupBy(F.col(FILE).alias("file")).agg(
        F.count_if(F.col(SIDE) == MOVED).alias(MOVED), F.count_if(F.col(SIDE) == KEPT).alias(KEPT))
    counts = [F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("before", MOVED, KEPT)]
    return dropped.join(written, "file", "full").select("file", *counts).withColumn(
        "balanced", F.col("before") == F.col(MOVED) + F.col(KEPT))
