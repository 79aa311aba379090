import datetime as dt

import pytest
from pyspark.sql import functions as F

from siltbed.operators import lookup, select


def scanned(df):
    """The rows found and how many rows the scan gave: those of row groups that were read."""
    found = df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    return found, sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))


@pytest.fixture
def tables(spark, tmp_path):
    """Two copies of 40,000 rows in eight files; odd keys occur, and each once in one file."""
    rows = spark.range(40_000).select((F.xxhash64("id") % 1_000_000_007 * 2 + 1).alias("k"), F.col("id").alias("v"))
    paths = str(tmp_path / "plain"), str(tmp_path / "bloom")
    spread = rows.repartition(8, "v")
    spread.write.parquet(paths[0])
    spread.write.options(**lookup.bloom_options({"k": 5_000})).parquet(paths[1])
    return [spark.read.parquet(p) for p in paths]


def test_row_groups_without_a_key_are_skipped(spark, tables):
    plain, bloom = tables
    keys = bloom.where("v = 77 or v = 78").select("k")
    want = {r["v"] for r in select.matching(bloom, "k", keys).collect()}
    few, read = scanned(lookup.lookup(bloom, "k", keys))
    same, read_plain = scanned(lookup.lookup(plain, "k", keys))
    assert {r["v"] for r in few} == {r["v"] for r in same} == want == {77, 78}
    assert read_plain == 40_000 and read <= 2 * 40_000 / 8 * 1.2
    assert scanned(lookup.lookup(bloom, "k", spark.createDataFrame([(2,), (4,)], "k long"))) == ([], 0)


def test_many_keys_are_joined(spark, tables):
    _, bloom = tables
    keys = bloom.where("v < 500").select("k")
    found = lookup.lookup(bloom, "k", keys)
    assert "Join" in found._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(r["v"] for r in found.collect()) == list(range(500))


@pytest.mark.parametrize("keys, want", [([], []), ([None], []), ([3, 3, None, 9], [1, 2]), (list(range(250)), [0, 1, 2, 4])])
def test_equals_matching(spark, keys, want):
    rows = spark.createDataFrame([(0, 1), (1, 3), (2, 3), (3, None), (4, 2)], "v int, k long")
    table = spark.createDataFrame([(k,) for k in keys], "k long")
    for found in (lookup.lookup(rows, "k", table), select.matching(rows, "k", table)):
        assert sorted(r["v"] for r in found.collect()) == want


def test_types_that_are_compared_after_a_cast_are_joined(spark):
    rows = spark.createDataFrame([(1, dt.date(2020, 1, 1), "a", 1.0)], "i int, d date, s string, f double")
    for link, keys in (("i", "k long"), ("f", "k double"), ("i", "k int"), ("d", "k date"), ("s", "k string")):
        value = {"i": 1, "d": dt.date(2020, 1, 1), "s": "a", "f": 1.0}[link]
        assert lookup.lookup(rows, link, spark.createDataFrame([(value,)], keys)).count() == 1
