"""Selection rules on hand-made edge rows."""

import datetime as dt

import pytest

from siltbed.functions import scalars
from siltbed.operators import ledger, select
from siltbed.spec import RunOptions, Table, Tree

AS_OF = dt.date(2025, 3, 31)
TREE = Tree(Table("orders", "id"), (Table("line", "id", parent="orders", link="order_id"),
                                    Table("detail", "id", parent="line", link="line_id")),
            age_column="placed", months=13, status_column="status", statuses=("DONE", "GONE"))
RUN = RunOptions(as_of=AS_OF)
D = dt.datetime


def orders(spark, rows):
    return spark.createDataFrame(rows, "id bigint, placed timestamp_ntz, status string")


def ids(df, column="id"):
    return sorted(r[0] for r in df.select(column).collect())


def test_cutoff_is_strict_and_clamped_to_month_end(spark):
    rows = orders(spark, [
        (1, D(2024, 2, 29), "DONE"), (2, D(2024, 2, 28, 23, 59, 59, 999999), "DONE"), (3, D(2024, 3, 1), "DONE")])
    assert ids(select.eligible_keys(TREE, rows, RUN)) == [2]


def test_null_and_other_status_stay(spark):
    rows = orders(spark, [(1, None, "DONE"), (2, D(2020, 1, 1), None), (3, D(2020, 1, 1), "OPEN"),
                          (4, D(2020, 1, 1), "GONE")])
    assert ids(select.eligible_keys(TREE, rows, RUN)) == [4]


def test_remainder_keeps_the_sign(spark):
    rows = orders(spark, [(-7, D(2020, 1, 1), "DONE"), (-10, D(2020, 1, 1), "DONE"), (7, D(2020, 1, 1), "DONE")])
    assert ids(select.eligible_keys(TREE, rows, RUN)) == [-10, 7]


@pytest.fixture
def tables(spark):
    line = spark.createDataFrame([
        (10, 1, "a"), (11, 1, "a"), (12, 2, "b"), (13, None, "n"), (14, 99, "orphan"), (15, 1, "new"),
    ], "id bigint, order_id bigint, v string")
    line = line.unionAll(line.where("id = 11")).unionAll(line.where("id = 12"))
    return {
        "orders": orders(spark, [(1, D(2020, 1, 1), "DONE"), (2, D(2025, 1, 1), "DONE"), (3, D(2020, 1, 1), "GONE")]),
        "line": line,
        "detail": spark.createDataFrame([(100, 10), (101, 10), (102, 12), (103, None), (104, 11)], "id bigint, line_id bigint"),
    }


def test_dependents_follow_their_parent_with_multiplicity(tables):
    keys = select.eligible_keys(TREE, tables["orders"], RUN)
    moved, kept = select.moved_rows(TREE, tables, keys), select.kept_rows(TREE, tables, keys)
    assert ids(moved["orders"]) == [1, 3] and ids(kept["orders"]) == [2]
    assert ids(moved["line"]) == [10, 11, 11, 15] and ids(kept["line"]) == [12, 12, 13, 14]
    assert ids(moved["detail"]) == [100, 101, 104] and ids(kept["detail"]) == [102, 103]
    audit = ledger.conservation(tables, moved, kept).collect()
    assert len(audit) == 3 and all(r.ok for r in audit)


def test_root_filter_equals_root_join(tables):
    keys = select.eligible_keys(TREE, tables["orders"], RUN)
    joined = select.moved_rows(TREE, tables, keys)["orders"]
    filtered = select.moved_rows(TREE, tables, keys, select.eligible_filter(TREE, RUN))["orders"]
    assert sorted(joined.collect()) == sorted(filtered.collect())


def test_named_columns_must_exist(tables):
    assert select.scan(tables["line"], ["v", "id"]).columns == ["v", "id"]
    with pytest.raises(ValueError, match="missing columns: nope"):
        select.scan(tables["line"], ["id", "nope"])


def test_slices_are_disjoint_and_complete(spark):
    df = spark.range(-25, 1000)
    for n in range(1, 11):
        per = df.select(scalars.worker_of("id", n).alias("w")).where("w is not null").groupBy("w").count().collect()
        assert sorted(r.w for r in per) == list(range(n))
        assert sum(r["count"] for r in per) == df.where("id % 10 between 0 and 9").count()


def test_worker_count_is_kept_in_range():
    assert RunOptions(parallel=0).parallel == 1 and RunOptions(parallel=11).parallel == 10


def test_semi_join_is_left_to_the_optimizer(spark, tables):
    keys = select.eligible_keys(TREE, tables["orders"], RUN)
    plan = select.moved_rows(TREE, tables, keys)["line"]._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftSemi" in plan and "ResolvedHint" not in plan


def test_age_and_status_reach_the_parquet_scan(spark, tables, tmp_path):
    path = str(tmp_path / "o")
    tables["orders"].write.parquet(path)
    plan = select.eligible_keys(TREE, spark.read.parquet(path), RUN)._jdf.queryExecution().executedPlan().toString()
    pushed = plan[plan.index("PushedFilters"):]
    assert "LessThan(placed" in pushed and "In(status" in pushed


def test_spec_rejects_bad_trees():
    with pytest.raises(ValueError):
        Tree(Table("a", "id"), (Table("c", "id", parent="b", link="b_id"),))
    with pytest.raises(ValueError):
        Tree(Table("a", "id"), (Table("c", "id", parent="a", link="a_id"),) * 2)
    with pytest.raises(ValueError):
        Table("a", "id", parent="b")
    with pytest.raises(ValueError):
        RunOptions(first_digit=5, last_digit=4)


def test_key_list(spark):
    df = spark.createDataFrame([([3, 1],), ([2],)], "ids array<bigint>")
    assert ids(select.keys_from_list(df, "ids", "id")) == [1, 2, 3]
