import bisect

import pytest
from pyspark.sql import functions as F

from siltbed.operators import cluster

SF = "/root/testdata/sf0.01"


def shares(df, cuts):
    return {r["column_name"]: r["read_share"] for r in cluster.read_shares(df, cuts).collect()}


def test_bucket_counts_the_bounds_up_to_a_value(spark):
    bounds = [1, 3, 3, 7, 8, 8, 20]
    rows = spark.createDataFrame([(v,) for v in (-1, 0, 1, 2, 3, 6, 7, 8, 19, 20, 99, None)], "v int")
    got = rows.select("v", cluster.bucket(F.col("v"), bounds).alias("b")).collect()
    assert all(r["b"] == (0 if r["v"] is None else bisect.bisect_right(bounds, r["v"])) for r in got)


def test_place_takes_bits_in_turn(spark):
    got = spark.createDataFrame([(5, 3)], "a int, b int").select(cluster.place([F.col("a"), F.col("b")], 3)).first()[0]
    assert got == int("1" "0" "0" "1" "1" "1", 2)


def test_files_get_small_in_every_column(spark, tmp_path):
    rows, by = spark.read.parquet(f"{SF}/lineitem.parquet"), ["l_shipdate", "l_orderkey"]
    sorted_path, path = str(tmp_path / "sorted"), str(tmp_path / "curve")
    cuts = cluster.rewrite_clustered(rows, path, by, target_bytes=64 * 1024)
    n = len(spark.read.parquet(path).inputFiles())
    assert n >= 16
    rows.repartitionByRange(n, "l_orderkey").write.parquet(sorted_path)
    before, after = shares(spark.read.parquet(sorted_path), cuts), shares(spark.read.parquet(path), cuts)
    assert before["l_shipdate"] > 0.9 and before["l_orderkey"] < 0.2
    assert after["l_shipdate"] < 0.5 and after["l_orderkey"] < 0.5
    assert spark.read.parquet(path).exceptAll(rows).isEmpty() and spark.read.parquet(path).count() == rows.count()


def test_a_frequent_value_and_nulls(spark, tmp_path):
    rows = spark.range(6_000).select(
        F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 3 == 1, F.col("id")).alias("a b"), F.col("id").alias("v"), F.lit(None).cast("date").alias("d"))
    path = str(tmp_path / "out")
    cluster.rewrite_clustered(rows, path, ["a b", "d"], target_bytes=2_000)
    back = spark.read.parquet(path)
    assert back.columns == rows.columns and back.count() == 6_000 and back.exceptAll(rows).isEmpty()
    sizes = [r["count"] for r in back.groupBy(F.col("_metadata.file_path")).count().collect()]
    assert max(sizes) < 6_000 / len(sizes) * 3


def test_empty_table_and_refused_columns(spark, tmp_path):
    rows = spark.createDataFrame([], "a int, b string")
    cuts = cluster.rewrite_clustered(rows, str(tmp_path / "out"), ["a"])
    assert cuts.rows == 0 and spark.read.schema(rows.schema).parquet(str(tmp_path / "out")).count() == 0
    with pytest.raises(ValueError):
        cluster.cuts_of(rows, [])
