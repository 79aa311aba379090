"""Batch numbers, caps, budgets and running sums against brute force."""

from collections import defaultdict

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from siltbed.functions.scalars import worker_of
from siltbed.operators import batch


def expected(ids, workers, size):
    per = defaultdict(list)
    for i in sorted(ids):
        if 0 <= i % 10 and i >= 0:
            lower = 0
            for w in range(workers):
                upper = lower + 10 // workers + (w < 10 % workers)
                if lower <= i % 10 < upper:
                    per[w].append(i)
                lower = upper
    return {i: (w, n // size + 1) for w, rows in per.items() for n, i in enumerate(rows)}


@pytest.mark.parametrize("workers,size", [(1, 1), (3, 20), (10, 7), (3, 5000)])
def test_numbers_equal_brute_force(spark, workers, size):
    ids = [i * i % 7919 for i in range(1, 3960)]
    ids = sorted(set(ids))
    df = spark.createDataFrame([(i,) for i in ids], "id bigint").repartition(6)
    rows = batch.assign_batches(df, worker_of("id", workers), "id", size).collect()
    assert {r.id: (r.worker, r.batch_no) for r in rows} == expected(ids, workers, size)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.sets(st.integers(0, 400), min_size=1), st.integers(1, 10), st.integers(1, 30))
def test_any_key_set(spark, ids, workers, size):
    df = spark.createDataFrame([(i,) for i in ids], "id bigint")
    rows = batch.assign_batches(df, worker_of("id", workers), "id", size).collect()
    assert {r.id: (r.worker, r.batch_no) for r in rows} == expected(ids, workers, size)


def test_hot_repeated_key_keeps_all_rows_and_fills_batches(spark):
    df = spark.range(9000).select(F.when(F.col("id") % 3 > 0, 5).otherwise(F.col("id")).cast("bigint").alias("k"), "id")
    numbered = batch.assign_batches(df, worker_of("k", 1), "k", 100, ties=["id"], unique=False)
    sizes = [r["count"] for r in numbered.groupBy("batch_no").count().collect()]
    assert sizes == [100] * 90
    assert numbered.select("id").distinct().count() == 9000


def test_same_rows_only_differ_by_batch(spark):
    df = spark.range(1000).select(F.lit(5).cast("bigint").alias("k"))
    numbered = batch.assign_batches(df, worker_of("k", 1), "k", 300, unique=False)
    assert sorted((r.batch_no, r["count"]) for r in numbered.groupBy("batch_no").count().collect()) == [
        (1, 300), (2, 300), (3, 300), (4, 100)]


def test_numbers_do_not_change_between_reads(spark):
    numbered = batch.assign_batches(spark.range(500).repartition(5), worker_of("id", 3), "id", 7)
    assert sorted(numbered.collect()) == sorted(numbered.collect())


def test_cap(spark):
    numbered = spark.createDataFrame([(0, b) for b in (1, 2, 3)], "worker int, batch_no bigint")
    assert batch.cap_batches(numbered, 0).count() == 3
    assert batch.cap_batches(numbered, 1).count() == 1


def test_budget_keeps_the_crossing_batch(spark):
    ledger = spark.createDataFrame([(0, 1, 40), (0, 2, 60), (0, 3, 1), (0, 4, 1), (1, 1, 500), (1, 2, 1)],
                                   "worker int, batch_no bigint, cost bigint")

    def kept(budget):
        return sorted((r.worker, r.batch_no) for r in batch.within_budget(ledger, "cost", budget).collect())

    assert kept(0) == [(0, 1), (0, 2), (0, 3), (0, 4), (1, 1), (1, 2)]
    assert kept(99) == [(0, 1), (0, 2), (1, 1)]
    assert kept(100) == [(0, 1), (0, 2), (0, 3), (1, 1)]


def test_running_sums_over_many_blocks(spark):
    df = spark.range(1, 1001).select(F.lit("r").alias("g"), F.col("id").alias("n"))
    rows = batch.running_sums(df, ["g"], "n", {"total": "n"}, block=16).collect()
    assert len(rows) == 1000 and all(r.total == r.n * (r.n + 1) // 2 for r in rows)
