"""Scheduled runs over a folder that grows: each file once, restarts, nothing lost."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltbed.streaming import drain

SCHEMA = T.StructType().add("id", "long").add("at", "date").add("a.b", "string")


def old():
    return F.col("at") < "2024-01-01"


def rows(*ids, at="2023-05-01"):
    return [(i, at, f"text {i}") for i in ids]


def drop(spark, base, name, data):
    plain = "id bigint, at string, ab string"
    spark.createDataFrame(data, plain).select("id", F.to_date("at").alias("at"), F.col("ab").alias("a.b")) \
        .coalesce(1).write.parquet(f"{base}/drops/{name}")


def run(spark, base, rule=None, **kw):
    """One scheduled run; the rows it read."""
    feed = drain.read_drops(spark, f"{base}/drops", SCHEMA, **kw)
    query = drain.start_drain(feed, old() if rule is None else rule, f"{base}/out", f"{base}/state")
    assert query.awaitTermination(200)
    return sum(p.numInputRows for p in query.recentProgress)


def ids(spark, base, side):
    return sorted(r.id for r in drain.drained(spark, f"{base}/out", side).collect())


def balance(spark, base):
    return sorted((r.before, r.moved, r.kept, r.balanced) for r in drain.drain_audit(spark, f"{base}/drops", f"{base}/out").collect())


def test_each_run_reads_new_files_alone(spark, tmp_path):
    base = str(tmp_path)
    drop(spark, base, "a", rows(1, 2) + rows(3, at="2024-01-01") + rows(4, at=None))
    assert run(spark, base) == 4
    assert run(spark, base) == 0
    drop(spark, base, "b", rows(5, 5, 2))
    drop(spark, base, "c", rows(6, at="2025-01-01"))
    assert run(spark, base, files_per_trigger=1) == 4
    assert ids(spark, base, drain.MOVED) == [1, 2, 2, 5, 5]
    assert ids(spark, base, drain.KEPT) == [3, 4, 6]
    assert drain.drained(spark, f"{base}/out", drain.KEPT).columns == SCHEMA.names
    assert balance(spark, base) == [(1, 0, 1, True), (3, 3, 0, True), (4, 2, 2, True)]


def test_a_failed_run_is_repeated_whole(spark, tmp_path):
    base = str(tmp_path)
    drop(spark, base, "a", rows(1, 2))
    assert run(spark, base) == 2
    drop(spark, base, "b", rows(3) + rows(4, at="2024-06-01"))
    drop(spark, base, "c", rows(5, 6))
    bad = F.when(F.col("id") == 5, F.raise_error(F.lit("lost")).cast("boolean")).otherwise(old())
    with pytest.raises(Exception, match="lost"):
        run(spark, base, bad, files_per_trigger=100)
    assert ids(spark, base, drain.MOVED) == [1, 2]
    assert balance(spark, base) == [(2, 0, 0, False), (2, 0, 0, False), (2, 2, 0, True)]
    assert run(spark, base) == 4
    assert ids(spark, base, drain.MOVED) == [1, 2, 3, 5, 6]
    assert ids(spark, base, drain.KEPT) == [4]
    assert all(b[-1] for b in balance(spark, base))


def test_a_lost_checkpoint_shows_in_the_audit(spark, tmp_path):
    base = str(tmp_path)
    drop(spark, base, "a", rows(1, 2))
    run(spark, base)
    drop(spark, base, "b", rows(3, 4, 5))
    # Without its checkpoint a run counts its batches from 0 again, and the sink has that batch.
    feed = drain.read_drops(spark, f"{base}/drops", SCHEMA)
    assert drain.start_drain(feed, old(), f"{base}/out", f"{base}/state-2").awaitTermination(200)
    assert ids(spark, base, drain.MOVED) == [1, 2]
    assert balance(spark, base) == [(2, 2, 0, True), (3, 0, 0, False)]


def test_one_side_reads_its_own_folder(spark, tmp_path):
    base = str(tmp_path)
    drop(spark, base, "a", rows(1, 2) + rows(3, at="2024-01-01"))
    run(spark, base)
    files = drain.drained(spark, f"{base}/out", drain.MOVED)
    plan = files._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(sb__side" in plan


def test_reserved_names_are_refused(spark, tmp_path):
    with pytest.raises(ValueError, match="SB__Side"):
        drain.read_drops(spark, str(tmp_path), T.StructType().add("id", "integer").add("SB__Side", "string"))
