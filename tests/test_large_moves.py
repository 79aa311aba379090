"""Moves of many keys: what is dealt, broadcast and written grows with the rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from siltbed.operators.audit import content
from siltbed.plans import jobs
from siltbed.session import settings
from siltbed.sources.store import LIVE, Store
from siltbed.spec import RunOptions, Table, Tree

TREE = Tree(Table("orders", "id", span=10_000), (Table("line", "id", parent="orders", link="order_id", span=10_000),),
            age_column="placed", months=13, segment_months=1200)
RUN = RunOptions(as_of=dt.date(2025, 1, 31), parallel=3, batch_size=20)
PLAIN = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false", **jobs.CO_PARTITIONED}


def lines(spark, n, order):
    return spark.range(n).select("id", order.cast("bigint").alias("order_id"), F.rand(3).alias("price"))


def keys(spark, n, seg="0"):
    return spark.range(n).select(F.col("id").alias(jobs.KEY), F.lit(0).alias(jobs.WORKER),
                                 (F.floor(F.col("id") / 20) + 1).alias(jobs.BATCH), F.when(F.col("id") >= 0, seg).alias(jobs.SEG))


def written(df):
    """Records that each exchange of a frame wrote, after it has run."""
    df.collect()
    found, todo = [], [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        if node.nodeName() == "Exchange":
            found.append(node.metrics().apply("shuffleRecordsWritten").value())
        todo += [node.children().apply(i) for i in range(node.children().size())]
    return sorted(found)


def test_keys_are_not_multiplied_by_the_tasks(spark):
    rows = lines(spark, 6000, F.col("id") % 2000)
    with settings(spark, PLAIN):
        split = jobs._split(rows, TREE, TREE.table("line"), keys(spark, 1000), 5, {"0": 20})
        assert written(split) == [1000, 6000]
        assert split.where(F.col(jobs.SIDE) != jobs.KEPT).count() == 3000


@pytest.mark.parametrize("order", [
    "IF(id % 3 = 0, 7, id % 2000)", "CASE id % 5 WHEN 0 THEN 9999 WHEN 1 THEN NULL ELSE id % 40 END", "NULL", "12", "-(id % 900)"])
def test_any_distribution_of_links_is_split_and_spread(spark, order):
    rows = lines(spark, 6000, F.expr(order)).localCheckpoint()
    tasks = {s: 12 for s, in rows.select(jobs.segment_of(TREE, TREE.table("line"))).distinct().collect()}
    link = keys(spark, 10_000).select((F.col(jobs.KEY) - 500).alias(jobs.KEY), jobs.WORKER, jobs.BATCH, jobs.SEG)
    with settings(spark, PLAIN):
        split = jobs._split(rows, TREE, TREE.table("line"), link, 5, tasks).localCheckpoint()
    sizes = [r["count"] for r in split.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 6000 and max(sizes) < 3000
    moved = split.where(F.col(jobs.SIDE) != jobs.KEPT).select(*rows.columns)
    assert content(moved).first() == content(rows.where("order_id BETWEEN -500 AND 9499")).first()


def test_a_large_root_is_spread_by_its_keys(spark):
    rows = spark.range(5000).select((F.col("id") * F.when(F.col("id") < 4900, 1).otherwise(1000)).alias("id"),
                                    F.when(F.col("id") >= 0, F.lit(dt.datetime(2020, 1, 1)).cast("timestamp_ntz")).alias("placed"))
    seg, = rows.select(jobs.segment_of(TREE, TREE.root)).distinct().first()
    with settings(spark, PLAIN):
        split = jobs._split(rows, TREE, TREE.root, keys(spark, 3000, seg), 5, {seg: 10})
        assert written(split) == [3000, 5000]
        sizes = [r["count"] for r in split.groupBy(F.spark_partition_id()).count().collect()]
        assert max(sizes) < 2500 and split.where(F.col(jobs.SIDE) != jobs.KEPT).count() == 3000


def test_many_keys_are_not_broadcast(spark, tmp_path, root, monkeypatch):
    monkeypatch.setattr(jobs, "BROADCAST_KEYS", 50)
    spark.range(400).select("id", F.lit(dt.datetime(2020, 1, 1)).cast("timestamp_ntz").alias("placed")).write.parquet(str(tmp_path / "orders"))
    lines(spark, 900, F.col("id") % 500).repartition(3).write.parquet(str(tmp_path / "line"))
    store = Store(spark, root)
    store.adopt({t: str(tmp_path / t) for t in ("orders", "line")})
    plans, split = [], jobs._split

    def seen(*args):
        out = split(*args)
        plans.append(out._jdf.queryExecution().executedPlan().toString())
        return out

    monkeypatch.setattr(jobs, "_split", seen)
    run = jobs.archive_tree(store, TREE, RUN)
    assert run.moved("orders") == 400 and len(plans) == 2
    assert all("SortMergeJoin" in p and "Broadcast" not in p for p in plans)
    assert store.read(store.snapshot(), LIVE, "line").count() == 900 - run.moved("line")


def test_few_tasks_keep_their_ranges(spark):
    """A chunk's rows lie in the files of few tasks, also if Spark's own joins have more tasks."""
    rows = lines(spark, 8000, F.col("id") % 2000)
    with settings(spark, {**PLAIN, "spark.sql.shuffle.partitions": "50"}):
        split = jobs._split(rows, TREE, TREE.table("line"), keys(spark, 2000), 5, {"0": 10})
        files = split.groupBy(F.spark_partition_id(), jobs.SIDE).count().count()
    # 2,000 keys are 20 chunks of 5 batches: with 10 ranges, about two in each.
    assert files <= 40


def test_small_files_do_not_make_many_tasks(spark, tmp_path, root, monkeypatch):
    """A task writes several files of the size aimed at once a write would have too many tasks."""
    monkeypatch.setattr(jobs, "TASKS", 3)
    spark.range(400).select("id", F.lit(dt.datetime(2020, 1, 1)).cast("timestamp_ntz").alias("placed")).write.parquet(str(tmp_path / "orders"))
    lines(spark, 3000, F.col("id") % 500).repartition(3).write.parquet(str(tmp_path / "line"))
    store = Store(spark, root, target_bytes=1000)
    store.adopt({t: str(tmp_path / t) for t in ("orders", "line")})
    shares, split = {}, jobs._split
    monkeypatch.setattr(jobs, "_split", lambda *args: (shares.update({args[2].name: sum(args[5].values())}), split(*args))[1])
    run = jobs.archive_tree(store, TREE, RUN)
    assert shares["line"] <= 4 and run.moved("line") == 2400
    written = spark.read.parquet(f"{root}/data/line/*")
    sizes = [r["count"] for r in written.groupBy("_metadata.file_path").count().collect()]
    assert sum(sizes) == 3000 and max(sizes) <= 1000 * jobs.INFLATION // 24 and len(sizes) >= 18
