"""Parameterised job text: one SQL text, bound to the digit range of each slice."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltbed.functions.scalars import worker_of
from siltbed.operators.slices import slice_range


def bind_slice(spark: SparkSession, text: str, lower: int, upper: int, args: dict | None = None, **tables) -> DataFrame:
    """Run a text with ``:lb`` and ``:up`` bound as values, never pasted in.

    Texts written with the placeholders ``@lb@`` and ``@up@`` work as they are.
    ``{name}`` in the text refers to a DataFrame given under that name.
    """
    marked = text.replace("@lb@", ":lb").replace("@up@", ":up")
    return spark.sql(marked, args={"lb": lower, "up": upper, **(args or {})}, **tables)


def run_sliced(
    spark: SparkSession, text: str, parallel: int, args: dict | None = None, key: str | None = None, **tables
) -> DataFrame:
    """The text's rows for all slices of a worker count, with their ``worker``.

    Where the text gives the sliced ``key`` as a column, one run over all digits does
    and the key tells the worker; else the text runs once per slice.
    """
    n = min(max(parallel, 1), 10)
    if key is not None:
        return bind_slice(spark, text, 0, 9, args, **tables).withColumn("worker", worker_of(key, n))
    parts = [bind_slice(spark, text, *slice_range(w, n), args, **tables).withColumn("worker", F.lit(w)) for w in range(n)]
    return reduce(DataFrame.unionByName, parts)
