"""Statistics and rewriting."""

import __spark_entry__ as entry_point
from pyspark.sql import functions as F

from siltbed.operators import maintain


def test_column_stats(spark):
    df = spark.createDataFrame([(1, "a"), (10, None), (9, "b"), (9, "b")], "n int, s string")
    rows = {r.column_name: tuple(r)[1:] for r in maintain.column_stats(df).collect()}
    assert rows == {"n": (4, 0, 3, "1", "10"), "s": (4, 1, 2, "a", "b")}


def test_column_stats_of_nothing(spark):
    df = spark.createDataFrame([], "n int")
    assert [tuple(r) for r in maintain.column_stats(df).collect()] == [("n", 0, 0, 0, None, None)]


def test_analyze_fills_catalog_statistics(spark):
    spark.sql("DROP TABLE IF EXISTS stat_probe")
    spark.range(100).write.saveAsTable("stat_probe")
    maintain.analyze(spark, ["stat_probe"])
    info = {r.info_name: r.info_value for r in spark.sql("DESCRIBE EXTENDED stat_probe id").collect()}
    assert info["min"] == "0" and info["max"] == "99" and info["num_nulls"] == "0"
    spark.sql("DROP TABLE stat_probe")


def test_rewrite_evenly_keeps_rows_and_restores_the_setting(spark, tmp_path):
    df = spark.range(10_000).repartition(40).withColumn("v", F.col("id") * 2)
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    maintain.rewrite_evenly(df, str(tmp_path / "o"), 1 << 20)
    assert spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == before
    out = spark.read.parquet(str(tmp_path / "o"))
    assert out.count() == 10_000 and out.rdd.getNumPartitions() < 40


def test_entry_gives_the_moved_tree(spark):
    df = entry_point.entry(spark)
    assert df.count() == 285 + 1177 and set(entry_point.oracle_sql()) <= set(entry_point.queries())
