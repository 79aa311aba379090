"""Dependents over graphs of links."""

import random

import pytest
from pyspark.sql import functions as F

from siltbed.operators.closure import Link, closure_keys, closure_rows

LINKS = [Link("node", "up", "node"), Link("node", "other", "node"), Link("leaf", "one", "node"), Link("leaf", "two", "node")]


def reached(rows, start):
    seen = set(start)
    while True:
        new = {k for k, a, b in rows if k is not None and k not in seen and (a in seen or b in seen)}
        if not new:
            return seen
        seen |= new


@pytest.mark.parametrize("seed", [1, 2])
def test_as_by_brute_force(spark, seed):
    rng = random.Random(seed)
    rows = [(k, rng.choice([None, k, rng.randrange(120)]), rng.choice([None, rng.randrange(300)])) for k in range(100)]
    rows += [rows[0], (None, 3, 4)]
    leaves = [(rng.randrange(150), rng.choice([None, rng.randrange(150)]), i % 7) for i in range(200)] * 2
    tables = {"node": spark.createDataFrame(rows, "id int, up int, other int"), "leaf": spark.createDataFrame(leaves, "one int, two int, v int"),
              "alone": spark.createDataFrame([(1,)], "id int")}
    start = [3, 50, 110, 999]
    found = closure_rows(tables, {"node": "id"}, LINKS, {"node": spark.createDataFrame([(k,) for k in start + start], "k int")})
    want = reached(rows, start)
    order = lambda rows: sorted(map(str, rows))
    assert order(tuple(r) for r in found["node"].collect()) == order(r for r in rows if r[0] in want)
    assert order(tuple(r) for r in found["leaf"].collect()) == order(r for r in leaves if r[0] in want or r[1] in want)
    assert found["alone"].collect() == []


def test_a_long_circle_ends(spark):
    rows = spark.range(30).select(F.col("id"), ((F.col("id") + 1) % 30).alias("up"), F.lit(None).cast("bigint").alias("other"))
    keys = closure_keys({"node": rows}, {"node": "id"}, LINKS[:2], {"node": spark.range(1)})
    assert sorted(r[0] for r in keys["node"].collect()) == list(range(30))
    with pytest.raises(RuntimeError, match="deeper than 5"):
        closure_keys({"node": rows}, {"node": "id"}, LINKS[:2], {"node": spark.range(1)}, max_rounds=5)


def test_nothing_to_start_from(spark):
    rows = spark.range(5).select("id", F.col("id").alias("up"), F.col("id").alias("other"))
    assert closure_rows({"node": rows}, {"node": "id"}, LINKS[:2], {"node": spark.range(0)})["node"].collect() == []
    assert closure_rows({"node": rows}, {"node": "id"}, LINKS[:2], {})["node"].collect() == []


def test_links_need_a_key(spark):
    with pytest.raises(ValueError, match="has no key"):
        closure_keys({}, {}, LINKS, {})
