"""The log of a finished run, from its ledger, its outcomes and the archived roots."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltbed.functions.progress import ID_LIST, NOT_COMPLETED, WRITE_FAILED
from siltbed.functions.scalars import ts_text
from siltbed.operators.ledger import batch_id_lists
from siltbed.operators.slices import slice_bounds
from siltbed.plans.jobs import RunResult, outcomes, last_outcomes
from siltbed.sources.runlog import render_lines, write_run_log
from siltbed.sources.store import ARCHIVE, BATCH, WORKER, Store
from siltbed.spec import RunOptions, Tree

# Line numbers of a plain log are multiplied by this; extra lines lie in between.
GAP = 4


def id_lines(store: Store, tree: Tree, result: RunResult) -> DataFrame:
    """(worker, batch_no, ids): the archived root keys of each batch of a run."""
    parts = [p for p in result.manifest.of(ARCHIVE, tree.root.name) if result.run_id in p.path]
    key = store.schema(result.manifest, ARCHIVE, tree.root.name)[tree.root.key]
    rows = store.rows_of(T.StructType([key, T.StructField(WORKER, T.IntegerType()), T.StructField(BATCH, T.LongType())]), parts)
    return batch_id_lists(rows.select(F.col(key.name), F.col(WORKER).alias("worker"), F.col(BATCH).alias("batch_no")), key.name)


def job_lines(store: Store, tree: Tree, options: RunOptions, result: RunResult) -> DataFrame:
    """``run_id, worker, line_no, message`` of a run, each batch with the list of its keys.

    A failed run's workers end with error lines. Line numbers ascend with gaps.
    """
    ends = last_outcomes(outcomes(store).where(F.col("run_id") == result.run_id))
    first = outcomes(store).where(F.col("run_id") == result.run_id).agg(F.min("started")).first()[0]
    started = F.lit(first).cast("timestamp")
    lower, upper = slice_bounds(options.parallel)
    book = result.ledger(store).select("run_id", "worker", "batch_no", "roots", "records", "duration_us")
    lines = render_lines(book, started, F.lit(result.cutoff), lower, upper, options.time_limit_sec, options.max_batches,
                         single_table=not tree.dependents)
    lines = lines.withColumn("line_no", F.col("line_no") * GAP)
    extra = []
    if result.chunks:
        # After the line that opens a batch, in front of the one that counts it.
        ids = id_lines(store, tree, result)
        at = (F.lit(2) + F.col("batch_no") * 2) * GAP + 1
        extra.append(ids.select(F.lit(result.run_id).alias("run_id"), "worker", at.cast("bigint").alias("line_no"),
                                F.concat(ts_text(started), F.lit(" : "), F.format_string(ID_LIST, "ids")).alias("message")))
    last = lines.groupBy("worker").agg(F.max("line_no").alias("last"))
    failed = ends.where("failed").select("error").limit(1)
    extra.append(last.join(failed).select(F.lit(result.run_id).alias("run_id"), "worker", F.inline(F.array(
        F.struct((F.col("last") + GAP).alias("line_no"), F.lit(NOT_COMPLETED).alias("message")),
        F.struct((F.col("last") + 2 * GAP).alias("line_no"), F.format_string(WRITE_FAILED, "error").alias("message"))))))
    for more in extra:
        lines = lines.unionByName(more)
    return lines


def write_job_log(store: Store, tree: Tree, options: RunOptions, result: RunResult, path: str) -> None:
    """Text files of a run's log below ``path``, a directory per run and worker."""
    write_run_log(job_lines(store, tree, options, result), path, per_worker_dirs=True)


def feed_lines(store: Store, tree: Tree, options: RunOptions, result: RunResult, path: str) -> None:
    """Append a run's lines as JSON, as the live feed reads them."""
    job_lines(store, tree, options, result).write.mode("append").json(path)
