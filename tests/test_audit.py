"""Content audits, and the plan of a rewrite."""

import datetime as dt
from dataclasses import replace

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from siltbed.operators import audit
from siltbed.plans import jobs
from siltbed.session import settings
from siltbed.sources.store import LIVE, Store
from siltbed.spec import RunOptions, Table, Tree

TREE = Tree(Table("orders", "id", span=100), (Table("line", "id", parent="orders", link="order_id", span=100),),
            age_column="placed", months=13, segment_months=2)
RUN = RunOptions(as_of=dt.date(2025, 1, 31), parallel=2, batch_size=20, audit_contents=True)


@pytest.fixture
def store(spark, tmp_path, root):
    i = F.col("id")
    orders = spark.range(200).select(i, F.date_add(F.lit(dt.date(2023, 1, 1)), (i * 5).cast("int")).alias("placed"),
                                     F.when(i % 3 == 0, "x").alias("note"), F.map_from_arrays(F.array(F.lit("k")), F.array(i)).alias("tags"))
    line = spark.range(900).select(i, F.when(i % 9 != 0, i % 250).alias("order_id"), F.array(i, F.lit(None)).alias("sizes"))
    paths = {}
    for name, df in (("orders", orders), ("line", line)):
        paths[name] = str(tmp_path / name)
        df.coalesce(2).write.parquet(paths[name])
    out = Store(spark, root, target_bytes=4096)
    out.adopt(paths)
    return out


def values(df):
    return sorted(map(str, df.collect()))


def test_content_sees_what_counts_do_not(spark):
    schema = "a string, b string, c array<string>, d map<string, int>"
    rows = [("x", None, ["p", None], {"k": 1}), (None, "x", ["p"], {}), ("", "", [], None), (None, None, None, {"k": None})]
    same = spark.createDataFrame(rows, schema)
    base = audit.content(same).first()
    assert base.row_count == 4
    assert audit.content(same.repartition(3)).first() == base
    for i, row in enumerate(rows):
        for j in range(4):
            for new in (None, row[(j + 1) % 2] if j < 2 else None):
                if new == row[j]:
                    continue
                changed = [tuple(new if (k, m) == (i, j) else v for m, v in enumerate(r)) for k, r in enumerate(rows)]
                assert audit.content(spark.createDataFrame(changed, schema)).first() != base, (i, j)
    # A null in an array, a value that changes its column, a row that takes another's place.
    for changed in ([("x", None, ["p"], {"k": 1}), *rows[1:]], [(None, "x", ["p", None], {"k": 1}), *rows[1:]], [rows[1], *rows[1:]]):
        assert audit.content(spark.createDataFrame(changed, schema)).first() != base


def test_repeated_rows_count(spark):
    # Two equal rows cancel in the exclusive or; the sums see them.
    one = spark.createDataFrame([("a",)], "v string")
    three = one.union(one).union(one)
    assert audit.content(three).first().mixed == audit.content(one).first().mixed
    found = audit.content_conservation({"t": three}, {"t": one}, {"t": one.union(one)}).first()
    assert found == Row(table_name="t", before=3, moved=1, kept=2, count_ok=True, content_ok=True)
    other = spark.createDataFrame([("b",)], "v string")
    assert not audit.content_conservation({"t": three}, {"t": one}, {"t": other.union(other)}).first().content_ok


def test_empty_tables_and_other_types(spark):
    none = spark.createDataFrame([], "v string, n int")
    assert audit.content_conservation({"t": none}, {"t": none}, {"t": none}).first().content_ok
    with pytest.raises(ValueError, match="n not on both"):
        audit.content_conservation({"t": none}, {"t": none}, {"t": none.withColumn("n", F.lit(1).cast("bigint"))})


@pytest.mark.parametrize("chunks", [0, 2])
def test_a_run_with_its_contents_audited(spark, store, chunks):
    before = {t: values(store.live(t)) for t in ("orders", "line")}
    run = jobs.archive_tree(store, TREE, replace(RUN, chunk_batches=chunks))
    assert run.roots > 0
    for t, rows in before.items():
        assert sorted(values(store.live(t)) + values(store.archive(t))) == rows


@pytest.mark.parametrize("table, column", [("line", "sizes"), ("orders", "note"), ("orders", "tags")])
def test_a_blanked_value_fails_the_run(spark, store, monkeypatch, table, column):
    original = jobs._sides

    def blank(rows, names, tree, t, size):
        out = original(rows, names, tree, t, size)
        return out.withColumn(column, F.when(F.col("id") != 99, F.col(column))) if t.name == table else out

    monkeypatch.setattr(jobs, "_sides", blank)
    version = store.snapshot().version
    with pytest.raises(jobs.AuditError, match="altered"):
        jobs.archive_tree(store, TREE, RUN)
    assert store.snapshot().version == version
    # Numbers of rows alone let it pass.
    jobs.archive_tree(store, TREE, replace(RUN, audit_contents=False))


def test_a_single_table_run_is_audited(spark, store, monkeypatch):
    flat = replace(TREE, dependents=())
    original = jobs._sides
    monkeypatch.setattr(jobs, "_sides", lambda *a: original(*a).withColumn("note", F.lit("same")))
    with pytest.raises(jobs.AuditError, match="altered"):
        jobs.archive_table(store, flat, RUN)
    monkeypatch.setattr(jobs, "_sides", original)
    assert jobs.archive_table(store, flat, RUN).roots > 0


def exchanges(df):
    """Exchanges of the executed plan with what they deal by."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line.strip(" +-:") for line in plan.splitlines() if "Exchange " in line and "Reused" not in line]


def test_a_rewrite_deals_the_table_once(spark, store):
    manifest = store.snapshot()
    line = TREE.table("line")
    rows = store.read(manifest, LIVE, "line")
    link = spark.range(0, 60).select(F.col("id").alias(jobs.KEY), F.lit(0).alias(jobs.WORKER), F.lit(1).cast("bigint").alias(jobs.BATCH))
    off = {f"spark.sql.{a}autoBroadcastJoinThreshold": "-1" for a in ("", "adaptive.")}
    with settings(spark, {**off, **jobs.CO_PARTITIONED, "spark.sql.adaptive.enabled": "false"}):
        for tasks in ({"0": 1, "1": 1, "2": 1}, {"0": 3, "1": 1, "2": 2}):
            split = jobs._split(rows, TREE, line, link, 5, tasks)
            found = exchanges(split)
            # One of the table, one of the keys, both by segment and share.
            assert len(found) == 2 and all(jobs.PLACE in e and (jobs.SALT in e) == (max(tasks.values()) > 1) for e in found), found
            assert split.where(F.col(jobs.SIDE) != jobs.KEPT).count() == rows.where("order_id < 60").count()
            assert split.count() == rows.count()


def test_a_hot_key_is_spread(spark, store, tmp_path):
    hot = spark.range(5000).select("id", F.when(F.col("id") >= 0, 7).otherwise(F.col("id")).alias("order_id"), F.array("id").alias("sizes"))
    link = spark.range(0, 60).select(F.col("id").alias(jobs.KEY), F.lit(0).alias(jobs.WORKER), F.lit(1).cast("bigint").alias(jobs.BATCH))
    with settings(spark, {**jobs.CO_PARTITIONED, "spark.sql.autoBroadcastJoinThreshold": "-1"}):
        split = jobs._split(hot, TREE, TREE.table("line"), link, 5, {"0": 10})
        sizes = [r["count"] for r in split.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 5000 and max(sizes) < 2500
