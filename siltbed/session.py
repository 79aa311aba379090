"""Session settings the jobs are designed for, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# AQE re-plans joins from measured sizes, splits skewed join partitions and
# rebalances writes; runtime bloom filters cut the child side of semi-joins.
SETTINGS = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
}


# On a cluster shuffles start with many small partitions, which AQE merges up to the
# advisory size: a first run over very large tables must not end in 200 of them.
CLUSTER_SETTINGS = {
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "8000",
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
}


def build_session(app: str, master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    local = (master or "").startswith("local")
    for key, value in {**SETTINGS, **({} if local else CLUSTER_SETTINGS), **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor sees: ``spark.checkpoint.dir``.

    Only a local session, where driver and tasks are one machine, may go without
    the setting; it gets a fresh folder of its own.
    """
    sc = spark.sparkContext
    base = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    base = base or sc.getCheckpointDir()
    if base is None:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="siltbed-")
        sc.setCheckpointDir(base)
    return str(base).rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that nothing has used yet."""
    return f"{shared_dir(spark)}/siltbed/{label}-{uuid.uuid4().hex}"


def drop_scratch(spark: SparkSession, hours: float) -> int:
    """Delete scratch folders that nothing has been written to for ``hours``."""
    context = spark.sparkContext
    root = context._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/siltbed")
    fs = root.getFileSystem(context._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return 0
    limit = (time.time() - hours * 3600) * 1000
    old = [s.getPath() for s in fs.listStatus(root) if s.getModificationTime() < limit]
    for path in old:
        fs.delete(path, True)
    return len(old)


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write to the shared folder and read back: short lineage, known size, and
    nothing to recompute when an executor is lost."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


ADVISORY = "spark.sql.adaptive.advisoryPartitionSizeInBytes"


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """SQL settings for the jobs inside."""
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def advisory_bytes(spark: SparkSession, target: int):
    """Let AQE aim at partitions of ``target`` bytes for the jobs inside."""
    return settings(spark, {ADVISORY: str(target)})


def listed_by_cores(spark: SparkSession):
    """List many directories in a few tasks per core. Spark's own number is 10,000 tasks, each
    with one or two directories, whose statuses and figures the driver holds."""
    tasks = max(32, 4 * spark.sparkContext.defaultParallelism)
    return settings(spark, {"spark.sql.sources.parallelPartitionDiscovery.parallelism": str(tasks)})
