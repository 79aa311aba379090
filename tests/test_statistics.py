"""Mergeable statistics of columns and parts."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from siltbed.operators import sketches
from siltbed.plans import jobs, statistics
from siltbed.plans.upkeep import upkeep
from siltbed.sources.store import LIVE, Store
from siltbed.spec import RunOptions, Table, Tree

TREE = Tree(Table("orders", "id", span=100), (Table("line", "id", parent="orders", link="order_id", span=100),),
            age_column="placed", months=13, segment_months=3)
RUN = RunOptions(as_of=dt.date(2025, 1, 31), batch_size=20)


@pytest.fixture
def rows(spark):
    i = F.col("id")
    return spark.range(20_000).select(
        i, (i % 7).cast("int").alias("few"), F.when(i % 4 != 0, i.cast("string")).alias("text"), (i / 3).alias("real"),
        F.date_add(F.lit(dt.date(2020, 1, 1)), (i % 900).cast("int")).alias("day"),
        F.timestamp_seconds(i * 60).alias("instant"), F.timestamp_seconds(i).cast("timestamp_ntz").alias("plain"),
        (i * 1.5).cast("decimal(12,2)").alias("money"), F.array(i % 5).alias("items"), F.lit(None).cast("int").alias("none"),
        F.when(i % 2 == 0, F.lit(float("nan"))).otherwise(i).alias("nan"))


EXACT = {"id": (0, 20_000), "few": (0, 7), "text": (5000, 15_000), "real": (0, 20_000), "day": (0, 900), "instant": (0, 20_000),
         "plain": (0, 20_000), "money": (0, 20_000), "items": (0, 5), "none": (20_000, 0), "nan": (0, 10_001)}


@pytest.mark.parametrize("groups", [1, 9])
def test_estimates_within_the_stated_error(rows, groups):
    parts = sketches.column_sketches(rows.withColumn("g", F.col("id") % groups), by=["g"])
    assert parts.count() == groups * len(EXACT)
    found = {r.column_name: r for r in sketches.estimates(sketches.merged(parts)).collect()}
    assert set(found) == set(EXACT)
    for c, (nulls, distinct) in EXACT.items():
        r = found[c]
        assert (r.row_count, r.null_count) == (20_000, nulls)
        assert abs(r.distinct_count - distinct) <= 0.05 * distinct + 1, c
    for c, scale in {"id": 1, "real": 1 / 3, "money": 1.5, "instant": 60, "plain": 1}.items():
        for q, v in zip(sketches.QUANTILES, found[c].quantiles):
            assert abs(v / scale / 20_000 - q) <= 0.03, (c, q)
    assert found["text"].quantiles is None and found["none"].quantiles is None
    assert abs(found["nan"].quantiles[2] / 20_000 - 0.5) <= 0.03


def test_no_rows(rows):
    found = {r.column_name: r for r in sketches.estimates(sketches.column_sketches(rows.where("id < 0"))).collect()}
    assert all((r.row_count, r.null_count, r.distinct_count, r.quantiles) == (0, 0, 0, None) for r in found.values())


@pytest.fixture
def store(spark, tmp_path, root):
    i = F.col("id")
    orders = spark.range(300).select(i, F.date_add(F.lit(dt.date(2023, 1, 1)), (i * 3).cast("int")).alias("placed"))
    line = spark.range(900).select(i, (i % 300).alias("order_id"))
    paths = {}
    for name, df in (("orders", orders), ("line", line)):
        paths[name] = str(tmp_path / f"odd name+{name}%")
        df.repartition(3).write.parquet(paths[name])
    out = Store(spark, root, target_bytes=4096)
    out.adopt(paths)
    return out


def counts(store, side, table):
    return {r.column_name: (r.row_count, r.distinct_count) for r in statistics.statistics(store, side, table).collect()}


def test_parts_are_sketched_once(spark, store):
    assert statistics.refresh(store, LIVE, "line") == 3
    assert statistics.refresh(store, LIVE, "line") == 0
    assert counts(store, LIVE, "line") == {"id": (900, pytest.approx(900, rel=0.05)), "order_id": (900, pytest.approx(300, rel=0.05))}
    with pytest.raises(ValueError, match="no statistics"):
        statistics.statistics(store, LIVE, "orders")


def test_upkeep_refreshes_touched_tables(spark, store):
    first = upkeep(store)
    assert first["analysed"] == 6
    run = jobs.archive_tree(store, TREE, RUN)
    m = store.snapshot()
    untouched = sum(p.layout is None for t in ("orders", "line") for p in m.of(LIVE, t))
    second = upkeep(store)
    assert 0 < second["analysed"] and untouched == 0
    assert upkeep(store)["analysed"] == 0
    for table in ("orders", "line"):
        for side in ("live", "archive"):
            n = store.live(table).count() if side == "live" else store.archive(table).count()
            assert counts(store, side, table)["id"] == (n, pytest.approx(n, rel=0.05, abs=1))
    assert run.moved("line") == store.archive("line").count()
