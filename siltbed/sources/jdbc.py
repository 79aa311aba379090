"""Sliced read of a database table: one Spark partition per slice."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from siltbed.operators.slices import jdbc_predicates


def read_sliced(
    spark: SparkSession, url: str, table: str, key: str, parallel: int,
    dialect: str = "mod", splits: int = 1, properties: dict[str, str] | None = None,
) -> DataFrame:
    """Rows whose key ends in a digit of some slice, one partition per worker and split.

    Later filters and column choices are pushed to the database by Spark.
    Credentials belong in ``properties``, taken from the session's configuration.
    """
    predicates = jdbc_predicates(key, parallel, dialect, splits)
    return spark.read.jdbc(url, table, predicates=predicates, properties=properties or {})
