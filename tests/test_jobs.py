"""Jobs on a store: moves, publishing, resuming, failing and maintaining."""

import datetime as dt
import pathlib
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from siltbed.plans import jobs, presets
from siltbed.plans.upkeep import upkeep
from siltbed.sources.store import ARCHIVE, LIVE, Manifest, Part, StaleVersion, Store
from siltbed.spec import RunOptions, Table, Tree

D = dt.datetime
TREE = Tree(Table("orders", "id", span=100), (
    Table("line", "id", parent="orders", link="order_id", span=100),
    Table("detail", "id", unique=False, parent="line", link="line_id", span=100)),
    age_column="placed", months=13, status_column="status", statuses=("DONE", "GONE"))
FLAT = replace(TREE, dependents=TREE.dependents[:1])
FLAT_NAMES = [t.name for t in FLAT.tables]
RUN = RunOptions(as_of=dt.date(2025, 1, 31), parallel=3, batch_size=20)
OLD, FRESH = D(2023, 5, 5), D(2024, 12, 1)


def make(spark, tmp_path, n=300, name="in"):
    """Orders of which every second is old and every fifth open; lines, details."""
    i = F.col("id")
    orders = spark.range(n).select(
        i, F.when(i % 2 == 0, F.lit(OLD).cast("timestamp_ntz") + F.make_dt_interval(days=i % 60))
        .when(i % 31 == 0, None).otherwise(F.lit(FRESH).cast("timestamp_ntz")).alias("placed"),
        F.when(i % 5 == 0, "OPEN").otherwise("DONE").alias("status"), F.rand(1).alias("price"))
    line = spark.range(n * 3).select(
        i, F.when(i % 17 == 0, None).otherwise(i % n).alias("order_id"), (i * 2).alias("qty"))
    detail = spark.range(n * 2).select((i % 500).alias("id"), ((i * 7) % (n * 4)).alias("line_id"))
    out = {}
    for t, df in {"orders": orders, "line": line, "detail": detail}.items():
        out[t] = str(tmp_path / name / t)
        df.coalesce(4).write.parquet(out[t])
    return out


def bag(df, *columns):
    return sorted(map(tuple, df.select(*columns).collect()) if columns else map(tuple, df.collect()), key=repr)


def expected(spark, paths, tree=TREE):
    from siltbed.operators import select

    tables = {t: spark.read.parquet(p) for t, p in paths.items()}
    keys = select.eligible_keys(tree, tables["orders"], RUN)
    return select.moved_rows(tree, tables, keys), select.kept_rows(tree, tables, keys)


def check(spark, store, paths, tree=TREE):
    moved, kept = expected(spark, paths, tree)
    for t in moved:
        assert bag(store.archive(t)) == bag(moved[t]), t
        assert bag(store.live(t)) == bag(kept[t]), t


@pytest.fixture
def store(spark, tmp_path, root):
    paths = make(spark, tmp_path)
    s = Store(spark, root)
    s.adopt(paths)
    s.paths = paths
    return s


def test_tree_moves_everything_eligible_once(spark, store):
    adopted = store.snapshot()
    run = jobs.archive_tree(store, TREE, RUN)
    check(spark, store, store.paths)
    assert run.backlog == 0 and not run.timed_out and run.manifest.version == 2
    rows = run.ledger(store).collect()
    assert sum(r.roots for r in rows) == run.roots == store.archive("orders").count()
    assert sum(r.records for r in rows) == run.records == sum(store.archive(t).count() for t in store.paths)
    assert all(r.roots <= 20 for r in rows) and {r.worker for r in rows} == {0, 1, 2}

    again = jobs.archive_tree(store, TREE, RUN)
    assert again.records == 0 and again.manifest == run.manifest == store.snapshot()
    row, = again.ledger(store).collect()
    assert (row.roots, row.records) == (0, 0)

    with pytest.raises(StaleVersion):
        store.publish(adopted)


@pytest.mark.parametrize("parallel,chunk", [(10, 0), (3, 1)])
def test_workers_and_chunks_do_not_change_the_end_state(spark, store, parallel, chunk):
    run = jobs.archive_tree(store, FLAT, replace(RUN, parallel=parallel, chunk_batches=chunk))
    check(spark, store, store.paths, FLAT)
    rows = run.ledger(store)
    assert rows.groupBy("worker", "batch_no").count().where("count > 1").isEmpty()
    assert run.roots == rows.agg(F.sum("roots")).first()[0]


def test_capped_runs_resume(spark, store):
    one = jobs.archive_tree(store, FLAT, replace(RUN, max_batches=1))
    assert one.roots == 60 and one.backlog > 0
    per_worker = {r.worker: r.roots for r in one.ledger(store).collect()}
    assert per_worker == {0: 20, 1: 20, 2: 20}
    jobs.archive_tree(store, FLAT, RUN)
    check(spark, store, store.paths, FLAT)


def test_disjoint_digit_runs_equal_one_run(spark, store):
    for digits in ((0, 3), (4, 6), (7, 9)):
        jobs.archive_tree(store, FLAT, replace(RUN, first_digit=digits[0], last_digit=digits[1]))
    check(spark, store, store.paths, FLAT)


def test_time_limit_is_tested_after_a_chunk(spark, store, monkeypatch):
    clock = iter(range(0, 10_000, 50))
    monkeypatch.setattr(jobs.time, "monotonic", lambda: next(clock))
    run = jobs.archive_tree(store, FLAT, replace(RUN, chunk_batches=1, time_limit_sec=10))
    assert run.timed_out and len(run.chunks) == 1 and run.backlog > 0
    late = jobs.archive_tree(store, FLAT, replace(RUN, time_limit_sec=10))
    assert late.timed_out and late.backlog == 0


def test_crash_before_publish_leaves_the_old_state(spark, store, monkeypatch):
    before = {t: bag(store.live(t)) for t in store.paths}
    version = store.snapshot()

    def crash(self, manifest):
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(Store, "publish", crash)
        with pytest.raises(OSError):
            jobs.archive_tree(store, FLAT, RUN)
    assert store.snapshot() == version
    assert {t: bag(store.live(t)) for t in store.paths} == before

    # A manifest that was not finished does not count either.
    version = version.version
    half = spark.createDataFrame([("{",)], "value string")
    half.write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").text(store._version_path(version + 1))
    assert store.snapshot().version == version
    run = jobs.archive_tree(store, FLAT, RUN)
    assert run.manifest.version == version + 2
    check(spark, store, store.paths, FLAT)


def test_key_already_archived_fails_the_run(spark, store, tmp_path):
    jobs.archive_tree(store, FLAT, RUN)
    again = store.archive("orders").limit(1)
    path = str(tmp_path / "again")
    again.write.parquet(path)
    m = store.snapshot()
    from siltbed.sources.store import Part

    store.publish(m.with_table(LIVE, "orders", [*m.of(LIVE, "orders"), Part(path, None, 1)]))
    before = store.snapshot()
    with pytest.raises(jobs.AuditError, match="in the archive already"):
        jobs.archive_tree(store, FLAT, RUN)
    assert store.snapshot() == before


def test_wrong_counts_fail_the_audit(spark, store):
    m = store.snapshot()
    short = [replace(p, rows=p.rows + 1) for p in m.of(LIVE, "line")]
    store.publish(m.with_table(LIVE, "line", short))
    with pytest.raises(jobs.AuditError, match="line"):
        jobs.archive_tree(store, FLAT, RUN)


def test_untouched_segments_are_not_rewritten(spark, store):
    jobs.archive_tree(store, FLAT, RUN)
    old = store.snapshot()
    later = jobs.archive_tree(store, FLAT, replace(RUN, as_of=dt.date(2026, 1, 31), max_batches=1))
    assert later.roots == 40
    new = store.snapshot()
    for t in ("orders", "line"):
        kept = {p.path for p in old.of(LIVE, t)} & {p.path for p in new.of(LIVE, t)}
        assert kept and len(kept) < len(old.of(LIVE, t)), t


def test_archive_columns_are_matched_by_name(spark, store):
    from pyspark.sql import types as T

    schema = T.StructType([T.StructField("note", T.StringType()), T.StructField("status", T.StringType()),
                           T.StructField("price", T.DoubleType()), T.StructField("placed", T.TimestampNTZType()),
                           T.StructField("id", T.LongType())])
    store.declare_archive("orders", schema)
    jobs.archive_tree(store, TREE, RUN)
    archived = store.archive("orders")
    assert archived.columns == ["note", "status", "price", "placed", "id"]
    moved, _ = expected(spark, store.paths)
    assert bag(archived, "id", "placed", "status", "price") == bag(moved["orders"])
    assert archived.where("note is not null").isEmpty()


def test_column_list_limits_the_archive(spark, store):
    tree = replace(TREE, root=replace(TREE.root, columns=("id", "status")))
    jobs.archive_tree(store, tree, RUN)
    assert store.archive("orders").columns == ["id", "status"]
    assert store.live("orders").columns == ["id", "placed", "status", "price"]


def test_archive_without_a_moved_column_fails(spark, store):
    from pyspark.sql import types as T

    store.declare_archive("orders", T.StructType([T.StructField("id", T.LongType())]))
    with pytest.raises(jobs.AuditError, match="no column"):
        jobs.archive_tree(store, TREE, RUN)


def test_compaction_keeps_rows_and_merges_parts(spark, store):
    jobs.archive_tree(store, FLAT, replace(RUN, chunk_batches=1))
    rows, parts = bag(store.archive("line")), len(store.snapshot().of(ARCHIVE, "line"))
    live_rows = bag(store.live("line"))
    store.compact(ARCHIVE, "line")
    store.compact(LIVE, "line")
    assert bag(store.archive("line")) == rows and bag(store.live("line")) == live_rows
    after = store.snapshot().of(ARCHIVE, "line")
    assert len(after) < parts and len({p.segment for p in after}) == len(after)


def test_hot_parent_key_without_broadcast(spark, tmp_path, root):
    paths = make(spark, tmp_path, n=60)
    hot = spark.range(1000, 4000).select("id", F.lit(2).cast("bigint").alias("order_id"), F.lit(1).cast("bigint").alias("qty"))
    hot.repartition(4).write.mode("append").parquet(paths["line"])
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
                "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB"}
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        store = Store(spark, root, target_bytes=4096)
        store.adopt({t: paths[t] for t in FLAT_NAMES})
        run = jobs.archive_tree(store, FLAT, RUN)
        assert run.moved("line") > 3000
        check(spark, store, paths, FLAT)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_adopted_files_without_moved_rows_stay_in_place(spark, store):
    before = store.snapshot()
    assert all(len(before.of(LIVE, t)) > 1 for t in FLAT_NAMES)
    jobs.archive_tree(store, FLAT, replace(RUN, max_batches=1, batch_size=5))
    now = store.snapshot()
    for t in ("orders", "line"):
        still = [p for p in now.of(LIVE, t) if p.segment is None]
        assert 0 < len(still) < len(before.of(LIVE, t)), t
    jobs.archive_tree(store, FLAT, RUN)
    check(spark, store, store.paths, FLAT)


def test_expire_drops_only_what_no_kept_version_names(spark, store):
    jobs.archive_tree(store, FLAT, replace(RUN, max_batches=1))
    jobs.archive_tree(store, FLAT, RUN)
    rows = {t: (bag(store.live(t)), bag(store.archive(t))) for t in FLAT_NAMES}
    report = upkeep(store, keep_versions=1)
    archived = store.snapshot().of(ARCHIVE, "line")
    assert report["archive/line"] == len(archived) == len({p.segment for p in archived})
    assert report["dropped"] > 4 and store._versions() == [store.snapshot().version]
    assert {t: (bag(store.live(t)), bag(store.archive(t))) for t in FLAT_NAMES} == rows
    assert store.expire(keep_versions=1) == []
    assert all(spark.read.parquet(p).count() for p in store.paths.values())


def test_new_rows_join_a_live_table(spark, store, tmp_path):
    jobs.archive_tree(store, FLAT, RUN)
    path = str(tmp_path / "more")
    spark.createDataFrame([(1002, OLD, "DONE", 1.0), (1003, FRESH, "DONE", 2.0)],
                          store.live("orders").schema).coalesce(1).write.parquet(path)
    store.extend("orders", path)
    with pytest.raises(ValueError, match="registered already"):
        store.extend("orders", path)
    with pytest.raises(ValueError, match="other columns"):
        store.extend("line", path)
    run = jobs.archive_tree(store, FLAT, RUN)
    assert run.roots == 1 and not store.archive("orders").where("id = 1002").isEmpty()
    assert not store.live("orders").where("id = 1003").isEmpty()


def test_partitioned_directory_is_adopted_whole(spark, tmp_path, root):
    path = str(tmp_path / "t")
    spark.createDataFrame([(1, dt.date(2020, 1, 5), "a"), (2, dt.date(2025, 3, 1), "b")],
                          "id bigint, date date, kind string").write.partitionBy("kind").parquet(path)
    store = Store(spark, root)
    store.adopt({"daily": path})
    jobs.archive_table(store, DAILY, DAILY_RUN)
    assert bag(store.archive("daily")) == [(1, dt.date(2020, 1, 5), "a")]
    assert bag(store.live("daily")) == [(2, dt.date(2025, 3, 1), "b")]


def test_many_chunks_write_each_row_once(spark, tmp_path, root):
    paths = make(spark, tmp_path, n=3000)
    sizes = {}
    for chunk in (0, 7):
        s = Store(spark, f"{root}-{chunk}")
        s.adopt({t: paths[t] for t in FLAT_NAMES})
        run = jobs.archive_tree(s, FLAT, replace(RUN, chunk_batches=chunk))
        assert len(run.chunks) == (1 if chunk == 0 else 5) and run.backlog == 0
        check(spark, s, {t: paths[t] for t in FLAT_NAMES}, FLAT)
        sizes[chunk] = run.records, sum(p.rows for t in FLAT_NAMES for p in s.snapshot().of(ARCHIVE, t)), rows_written(spark, s)
    assert sizes[0][:2] == sizes[7][:2] and sizes[7][2] <= 1.3 * sizes[0][2]


def rows_written(spark, store):
    return sum(spark.read.parquet(str(run)).count() for t in FLAT_NAMES for run in pathlib.Path(store.root, "data", t).iterdir())


def test_a_second_bounds_a_run(spark, store):
    run = jobs.archive_tree(store, FLAT, replace(RUN, chunk_batches=1, time_limit_sec=1, run_id="short"))
    assert run.timed_out and run.backlog > 0 and store.archive("orders").count() == run.roots
    ended = jobs.last_outcomes(jobs.outcomes(store)).collect()
    assert sum(r.backlog for r in ended) == run.backlog and {r.warning for r in ended} == {"out of time"}
    jobs.archive_tree(store, FLAT, RUN)
    check(spark, store, store.paths, FLAT)


def test_a_failed_run_says_so(spark, store):
    tree = replace(FLAT, root=replace(FLAT.root, columns=("missing",)))
    before = store.snapshot()
    with pytest.raises(ValueError, match="missing"):
        jobs.archive_tree(store, tree, replace(RUN, run_id="bad"))
    row, = jobs.outcomes(store).where("run_id = 'bad'").collect()
    assert row.failed and "missing" in row.error and store.snapshot() == before


def test_a_run_that_must_fail_writes_no_table(spark, store):
    """The lines could move, but the orders lack a column: nothing is written for either."""
    tree = replace(FLAT, root=replace(FLAT.root, columns=("missing",)))
    with pytest.raises(ValueError, match="missing"):
        jobs.archive_tree(store, tree, replace(RUN, chunk_batches=1, run_id="bad"))
    assert not store.has(f"{store.root}/data")


def test_published_chunks_keep_no_manifest(spark, store):
    """Each names all parts: kept for every chunk they would grow with the square of the chunks."""
    run = jobs.archive_tree(store, FLAT, replace(RUN, chunk_batches=1))
    assert len(run.chunks) > 1 and all(c.manifest is None for c in run.chunks) and run.manifest == store.snapshot()


def test_many_directories_are_listed_by_few_tasks(spark, tmp_path, root):
    context = spark.sparkContext
    spark.range(400).select("id", (F.col("id") % 200).alias("d")).repartition(1).write.partitionBy("d").parquet(str(tmp_path / "t"))
    store = Store(spark, root)
    parts = [Part(str(tmp_path / "t" / f"d={i}"), "0", 2, "range:id:1") for i in range(200)]
    m = Manifest(0).with_table(LIVE, "t", parts, spark.range(0).schema.json())
    context.setJobGroup("listing", "")
    assert store.read(m, LIVE, "t").count() == 400
    context.setLocalProperty("spark.jobGroup.id", None)
    status = context.statusTracker()
    tasks = [status.getStageInfo(s).numTasks for j in status.getJobIdsForGroup("listing") for s in status.getJobInfo(j).stageIds]
    assert max(tasks) <= max(32, 4 * context.defaultParallelism)


def test_unread_parts_are_audited(spark, store, tmp_path):
    keys = spark.createDataFrame([(4, 0, 1, "0")], f"{jobs.KEY} bigint, arch_worker int, arch_batch bigint, {jobs.SEG} string")
    line = FLAT.table("line")
    layout = "range:order_id:100"
    m = store.snapshot()
    part = m.of(LIVE, "line")[0]
    wrong = replace(part, segment="7", layout=layout)
    for odd in (wrong, replace(wrong, ranges=(("order_id", 0, 299),)), replace(part, segment="0", layout="range:order_id:5")):
        with pytest.raises(jobs.AuditError, match="not read"):
            jobs._audit_unread(store, m, line, [odd], keys, layout)
    jobs._audit_unread(store, m, line, [replace(wrong, ranges=(("order_id", 700, 799),))], keys, layout)


def test_own_column_names_are_refused(spark, tmp_path, root):
    from pyspark.sql import types as T

    store = Store(spark, root)
    for i, name in enumerate(("arch_worker", "SB__key", "sb_seg")):
        path = str(tmp_path / f"t{i}")
        spark.range(3).withColumn(name, F.lit(1)).write.parquet(path)
        with pytest.raises(ValueError, match="reserved"):
            store.adopt({"t": path})
    with pytest.raises(ValueError, match="reserved"):
        store.declare_archive("t", T.StructType([T.StructField("arch_batch", T.LongType())]))


def test_one_of_two_publishers_wins(spark, store):
    from concurrent.futures import ThreadPoolExecutor

    m = store.snapshot()

    def publish(_):
        try:
            return store.publish(m).version
        except StaleVersion:
            return None

    with ThreadPoolExecutor(4) as pool:
        won = [v for v in pool.map(publish, range(4)) if v is not None]
    assert won == [m.version + 1] and store.snapshot().version == m.version + 1


@pytest.mark.parametrize("partitioned", [True, False])
def test_partitioned_and_flat_folders_join_one_table(spark, tmp_path, root, partitioned):
    rows = [(i, dt.date(2020, 1, 5) if i % 2 else dt.date(2025, 3, 1), "ab"[i % 2]) for i in range(8)]
    frame = spark.createDataFrame(rows, "id bigint, date date, kind string")
    first, more = str(tmp_path / "t"), str(tmp_path / "more")
    frame.where("id < 4").write.partitionBy("kind").parquet(first)
    writer = frame.where("id >= 4").write
    (writer.partitionBy("kind") if partitioned else writer).parquet(more)
    store = Store(spark, root)
    store.adopt({"daily": first})
    store.extend("daily", more)
    assert bag(store.live("daily")) == rows
    jobs.archive_table(store, DAILY, DAILY_RUN)
    assert bag(store.archive("daily")) == [r for r in rows if r[0] % 2] and bag(store.live("daily")) == [r for r in rows if not r[0] % 2]


def test_cutoff_of_instants_is_local_midnight(spark):
    from siltbed.functions.scalars import older_than

    # Midnight of 2024-12-01 in Istanbul is 21:00 of the day before in UTC.
    edge = 1_733_000_400_000_000
    frame = spark.createDataFrame([(edge - 1,), (edge,), (None,)], "us bigint").select("us", F.timestamp_micros("us").alias("ts"))
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "America/New_York", "Asia/Tokyo"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            found = frame.where(older_than("ts", dt.date(2025, 1, 1), 1, "Europe/Istanbul")).collect()
            assert [r.us for r in found] == [edge - 1]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_upkeep_merges_the_ledger(spark, store):
    jobs.archive_tree(store, FLAT, replace(RUN, chunk_batches=1))
    rows = bag(store.ledger())
    assert len(store.snapshot().of("ledger", "batches")) > 1
    upkeep(store)
    assert len(store.snapshot().of("ledger", "batches")) == 1 and bag(store.ledger()) == rows


# -- single tables ---------------------------------------------------------------


@pytest.fixture
def table(spark, tmp_path, root):
    i = F.col("id")
    df = spark.range(2000).select(
        (i % 1500).alias("id"), F.when(i % 11 == 0, None).otherwise(F.date_sub(F.lit(dt.date(2025, 3, 1)), (i % 120).cast("int")))
        .alias("date"), i.alias("n"))
    path = str(tmp_path / "t")
    df.write.parquet(path)
    s = Store(spark, root)
    s.adopt({"daily": path})
    return s, df


DAILY = Tree(Table("daily", "id", unique=False), age_column="date", months=2)
DAILY_RUN = RunOptions(as_of=dt.date(2025, 3, 1), parallel=4, batch_size=30)


@pytest.mark.parametrize("limits", [{}, {"chunk_batches": 4}])
def test_table_moves_everything_eligible(spark, table, limits):
    store, df = table
    run = jobs.archive_table(store, DAILY, replace(DAILY_RUN, **limits))
    old = "date < date'2025-01-01'"
    assert bag(store.archive("daily")) == bag(df.where(old))
    assert bag(store.live("daily")) == bag(df.where(f"coalesce(not ({old}), true)"))
    rows = run.ledger(store).collect()
    assert sum(r.records for r in rows) == df.where(old).count() and all(r.records <= 30 for r in rows)
    assert len({(r.worker, r.batch_no) for r in rows}) == len(rows)


def test_capped_table_run_moves_the_first_batches(spark, table):
    store, df = table
    run = jobs.archive_table(store, DAILY, replace(DAILY_RUN, max_batches=2))
    assert run.records == 4 * 60
    archived = store.archive("daily")
    first = df.where("date < date'2025-01-01' and id % 10 between 0 and 2").orderBy("id", "date", "n").limit(60)
    assert bag(archived.where("id % 10 between 0 and 2")) == bag(first)


def test_fully_drained_segment_leaves_nothing(spark, tmp_path, root):
    path = str(tmp_path / "t")
    spark.createDataFrame([(1, dt.date(2020, 1, 5)), (2, dt.date(2020, 1, 6)), (3, dt.date(2025, 3, 1))],
                          "id bigint, date date").write.parquet(path)
    store = Store(spark, root)
    store.adopt({"daily": path})
    jobs.archive_table(store, DAILY, replace(DAILY_RUN, as_of=dt.date(2010, 1, 1)))
    jobs.archive_table(store, DAILY, DAILY_RUN)
    assert [p.rows for p in store.snapshot().of(LIVE, "daily")] == [1]
    assert bag(store.live("daily")) == [(3, dt.date(2025, 3, 1))]


def test_everything_moves_and_the_live_table_is_empty(spark, tmp_path, root):
    path = str(tmp_path / "t")
    spark.createDataFrame([(1, dt.date(2020, 1, 5))], "id bigint, date date").write.parquet(path)
    store = Store(spark, root)
    store.adopt({"daily": path})
    jobs.archive_table(store, DAILY, DAILY_RUN)
    assert store.live("daily").collect() == [] and store.live("daily").columns == ["id", "date"]
    assert jobs.archive_table(store, DAILY, DAILY_RUN).records == 0


# -- presets -----------------------------------------------------------------------


def test_order_preset_moves_all_fourteen_tables(spark, tmp_path, root):
    tree = presets.order_tree(span=10)
    i = F.col("id")
    paths = {}
    for t in tree.tables:
        if t.parent is None:
            df = spark.range(40).select(i, F.lit("x").alias("note"), F.when(i < 20, F.lit(dt.date(2020, 1, 1)))
                                        .otherwise(F.lit(dt.date(2025, 1, 1))).alias("delivery_date"),
                                        F.when(i % 4 == 0, "NEW").otherwise("COMPLETED").alias("status"))
        else:
            df = spark.range(80).select(i, (i / 2).cast("bigint").alias(t.link))
        paths[t.name] = str(tmp_path / "in" / t.name)
        df.coalesce(1).write.parquet(paths[t.name])
    store = Store(spark, root)
    store.adopt(paths)
    run = jobs.archive_tree(store, tree, presets.order_run(10, as_of=dt.date(2025, 2, 1)))
    assert len(tree.tables) == 14 and run.roots == 15
    assert {t.name: run.moved(t.name) for t in tree.dependents if t.parent == "orders"} == dict.fromkeys(
        presets.ORDER_DEPENDENTS, 30)
    assert run.moved("handling_unit_item_transaction") == 60
    assert run.records == 15 + 12 * 30 + 60


def test_strict_presets_name_every_column(spark, tmp_path, root):
    tree = presets.order_tree(strict=True)
    assert {t.name: len(t.columns) for t in tree.tables} == {
        "orders": 71, "order_item": 41, "handling_unit_item_transaction": 13, "cancelled_order_item_history": 16,
        "progress_payment_order": 20, "payment": 12, "courier_assignment": 16, "handling_unit_transaction": 13,
        "waiting_transfer_order": 10, "order_addition_history": 10, "order_review": 12, "order_problem": 14,
        "order_approval": 12, "order_history": 15}
    assert len(presets.inventory_movement(strict=True).root.columns) == 23
    daily = presets.store_daily_status(strict=True)
    assert all(len(set(t.columns)) == len(t.columns) for t in (*tree.tables, daily.root)) and len(daily.root.columns) == 10
    path = str(tmp_path / "t")
    columns = {c: F.lit(None).cast("string") for c in daily.root.columns if c not in ("id", "date")}
    frame = spark.range(3).withColumns({"date": F.lit(dt.date(2020, 1, 1)), "more": F.lit(1), **columns})
    frame.write.parquet(path)
    frame.drop("store_id").write.parquet(path + "-less")
    run = presets.table_run(as_of=dt.date(2025, 2, 1))
    for name, missing in ((path, False), (path + "-less", True)):
        store = Store(spark, f"{root}-{missing}")
        store.adopt({"store_daily_status": name})
        if missing:
            with pytest.raises(ValueError, match="store_id"):
                jobs.archive_table(store, daily, run)
        else:
            jobs.archive_table(store, daily, run)
            assert store.archive("store_daily_status").columns == list(daily.root.columns)


def test_table_presets(spark):
    assert presets.inventory_movement().age_column == "created_at"
    assert presets.store_daily_status().months == 2
    assert presets.table_run(4).batch_size == 300 and presets.order_run().batch_size == 20
    assert isinstance(presets.order_run().resolved_as_of(), dt.date)


def test_command_line_runs_a_preset(spark, tmp_path, root):
    from siltbed.__main__ import run

    path = str(tmp_path / "t")
    spark.range(50).select("id", F.when(F.col("id") < 30, F.lit(dt.date(2024, 1, 1))).otherwise(
        F.lit(dt.date(2025, 1, 1))).alias("date")).write.parquet(path)
    argv = ["--store", root, "--job", "store_daily_status", "--as-of", "2025-02-01", "--parallel", "2"]
    plan = run(spark, [*argv, "--adopt", f"store_daily_status={path}", "--dry-run"])["dry_run"]
    assert [(r["worker"], r["eligible"], r["batches"]) for r in plan] == [(0, 15, 1), (1, 15, 1)]
    report = run(spark, argv)
    assert (report["total_count"], report["backlog"], report["version"]) == (30, 0, 2)
    assert str(report["cutoff"]) == "2024-12-01"


def test_chunks_that_only_rename_take_few_jobs(spark, store, monkeypatch):
    """One job or two for the ledger, one for the outcomes; the parts are counted and checked when they are written."""
    scheduler, seen, publish = spark.sparkContext._jsc.sc().dagScheduler(), [], Store.publish
    monkeypatch.setattr(Store, "publish", lambda self, m: (seen.append(scheduler.numTotalJobs()), publish(self, m))[1])
    run = jobs.archive_tree(store, FLAT, replace(RUN, batch_size=5, chunk_batches=2))
    assert len(run.chunks) == len(seen) > 4 and max(b - a for a, b in zip(seen[2:], seen[3:])) <= 3
    book = run.ledger(store).select("chunk", "worker", "batch_no", "roots", "records").collect()
    for i, chunk in enumerate(run.chunks):
        own = [r for r in book if r.chunk == i + 1]
        assert sum(r.roots for r in own) == chunk.audit[0][2] and sum(r.records for r in own) == sum(a[2] for a in chunk.audit)
        assert {(r.batch_no - 1) // 2 for r in own} == {i} and len({(r.worker, r.batch_no) for r in own}) == len(own)
    check(spark, store, store.paths, FLAT)


def test_chunks_before_a_key_that_is_archived_already_are_published(spark, store, tmp_path):
    """The parts of all chunks are compared with the archive at once, yet each chunk fails for itself."""
    first = expected(spark, store.paths, FLAT)[0]["orders"].agg(F.max("id")).first()[0]
    row = store.live("orders").where(f"id = {first}")
    path = str(tmp_path / "again")
    row.select("*", F.lit(0).alias("arch_worker"), F.lit(1).cast("bigint").alias("arch_batch")).write.parquet(path)
    m = store.snapshot()
    store.publish(m.with_table(ARCHIVE, "orders", [jobs.Part(path, None, 1)], m.schemas[f"{LIVE}/orders"]))
    with pytest.raises(jobs.AuditError, match=f"key {first} is in the archive already"):
        jobs.archive_tree(store, FLAT, replace(RUN, batch_size=5, chunk_batches=2))
    assert store.archive("orders").where(f"id <> {first}").count() > 50
    assert store.archive("orders").groupBy("id").count().where("count > 1").isEmpty()


def test_a_key_of_two_chunks_fails_the_second(spark, tmp_path, root):
    """Two lines of one id hang on orders of different chunks."""
    line = [(i, 2 * i, i) for i in range(1, 60)] + [(3, 110, 7)]
    spark.range(120).select("id", F.lit(OLD).cast("timestamp_ntz").alias("placed"), F.lit("DONE").alias("status")).write.parquet(str(tmp_path / "o"))
    spark.createDataFrame(line, "id bigint, order_id bigint, qty bigint").write.parquet(str(tmp_path / "l"))
    s = Store(spark, root)
    s.adopt({"orders": str(tmp_path / "o"), "line": str(tmp_path / "l")})
    with pytest.raises(jobs.AuditError, match="line: key 3 is in the archive already"):
        jobs.archive_tree(s, FLAT, replace(RUN, batch_size=10, chunk_batches=1))
    assert s.archive("line").groupBy("id").count().where("count > 1").isEmpty() and s.archive("line").count() > 20


def test_outcomes_keep_their_values(spark):
    begun = dt.datetime(2025, 3, 4, 5, 6, 7, 89, dt.timezone.utc)
    row = ("run", "orders", 2, 1, begun, dt.date(2024, 1, 31), 2**40, 0, 5, True, False, None, 'a "quoted" \\ text\né')
    got = jobs.small_rows(spark, jobs.OUTCOME_SCHEMA, [row]).withColumn("started", F.unix_micros("started")).first()
    assert tuple(got) == (*row[:4], int(begun.timestamp()) * 1_000_000 + 89, *row[5:])


def test_a_publisher_sees_versions_newer_than_the_next(spark, store):
    """A dropped version, and one that was not finished in front of a finished one, are no gap to write into."""
    old = store.snapshot()
    half = store._version_path(old.version + 1)
    spark.range(1).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(half)
    new = store.publish(old)
    store._delete(store._claim_path(old.version))
    with pytest.raises(StaleVersion):
        store.publish(old)
    for _ in range(3):
        new = store.publish(new)
    store.expire(keep_versions=1)
    store._delete(f"_manifest/v={old.version + 1}")
    with pytest.raises(StaleVersion):
        store.publish(old)
    assert store.snapshot().version == new.version and store.snapshot().parts == old.parts


def test_chunks_that_only_publish_take_no_jobs_and_few_directories(spark, tmp_path, root, monkeypatch):
    """Many small chunks: their directories are shared, their ledger and outcomes are the driver's, parts are folded."""
    monkeypatch.setattr(jobs, "FOLDED", 4)
    spark.range(240).select("id", F.lit(OLD).cast("timestamp_ntz").alias("placed"), F.lit("DONE").alias("status")).write.parquet(str(tmp_path / "o"))
    spark.range(600).select("id", (F.col("id") % 250).alias("order_id"), F.lit(1).alias("qty")).write.parquet(str(tmp_path / "l"))
    s = Store(spark, root)
    s.adopt({"orders": str(tmp_path / "o"), "line": str(tmp_path / "l")})
    scheduler, seen, publish = spark.sparkContext._jsc.sc().dagScheduler(), [], Store.publish
    monkeypatch.setattr(Store, "publish", lambda self, m: (seen.append((scheduler.numTotalJobs(), sum(map(len, m.parts.values())))), publish(self, m))[1])
    run = jobs.archive_tree(s, replace(FLAT, segment_months=1200), replace(RUN, batch_size=2, chunk_batches=2))
    assert len(run.chunks) == 24 and len({n for n, _ in seen}) == 1 and max(n for _, n in seen) < 30
    assert sum(1 for _ in pathlib.Path(root, "data").glob("*/*/sb_side=*/*")) <= 2 * (1 + 3)
    assert s.archive("orders").count() == run.roots == 240 and s.live("orders").count() == 0
    assert s.archive("line").count() == run.moved("line") == 580 and s.live("line").count() == 20
    book = run.ledger(s)
    assert book.count() == book.select("worker", "batch_no").distinct().count() and book.agg(F.sum("records")).first()[0] == run.records
    assert {r.chunk for r in jobs.outcomes(s).select("chunk").collect()} == set(range(1, 25))


def test_a_stopped_run_shares_directories_with_the_archive(spark, store):
    """Batches that are archived of a directory stay so while a later run, with or without upkeep, moves the others."""
    stopped = jobs.archive_tree(store, FLAT, replace(RUN, batch_size=5, chunk_batches=2, time_limit_sec=1, run_id="stopped"))
    m = store.snapshot()
    both = {p.path for p in m.of(LIVE, "orders")} & {p.path for p in m.of(ARCHIVE, "orders")}
    assert stopped.backlog > 0 and both and store.archive("orders").count() == stopped.roots
    moved = bag(store.archive("orders")) + bag(store.live("orders"))
    assert sorted(moved, key=repr) == bag(spark.read.parquet(store.paths["orders"]))
    store.compact(ARCHIVE, "line")
    assert store.archive("line").count() == stopped.moved("line") and not any(p.batches for p in store.snapshot().of(ARCHIVE, "line"))
    jobs.archive_tree(store, FLAT, RUN)
    check(spark, store, store.paths, FLAT)
    upkeep(store, keep_versions=1)
    check(spark, store, store.paths, FLAT)


def test_files_of_later_chunks_are_read_when_they_are_due(spark, tmp_path, root, monkeypatch):
    """Files in key order and small groups: a file is read by the first group with a row in it, all are found by one look."""
    monkeypatch.setattr(jobs, "CHUNK_ROWS", 60)
    spark.range(240).select("id", F.lit(OLD).cast("timestamp_ntz").alias("placed"), F.lit("DONE").alias("status")).repartitionByRange(
        4, "id").write.parquet(str(tmp_path / "o"))
    spark.range(480).select("id", (F.col("id") / 2).cast("bigint").alias("order_id"), F.lit(1).alias("qty")).repartitionByRange(
        4, "id").write.parquet(str(tmp_path / "l"))
    s = Store(spark, root)
    s.adopt({"orders": str(tmp_path / "o"), "line": str(tmp_path / "l")})
    reads, due, split = [], jobs._due_parts, jobs._split_by_link
    monkeypatch.setattr(jobs, "_due_parts", lambda *a: (reads.append("look"), due(*a))[1])
    monkeypatch.setattr(jobs, "_split_by_link", lambda *a: (reads.append(len(a[4])), split(*a))[1])
    run = jobs.archive_tree(s, replace(FLAT, segment_months=1200), replace(RUN, batch_size=2, chunk_batches=5))
    assert reads.count("look") == 2 and sum(n for n in reads if n != "look") == 8 and len(reads) > 4
    assert run.backlog == 0 and s.archive("orders").count() == 240 and s.archive("line").count() == 480
    assert s.live("line").count() == 0 and s.archive("line").select("id").distinct().count() == 480


def test_compaction_after_many_chunks(spark, store, monkeypatch):
    """However many chunks a run had, a segment has few parts and files to merge, and one plain part after it."""
    monkeypatch.setattr(jobs, "FOLDED", 3)
    run = jobs.archive_tree(store, FLAT, replace(RUN, batch_size=2, chunk_batches=1))
    m, rows = store.snapshot(), bag(store.archive("line"))
    parts, segments = m.of(ARCHIVE, "line"), {p.segment for p in m.of(ARCHIVE, "line")}
    assert len(run.chunks) > 15 and len(segments) < len(parts) <= 4 * len(segments) and len({p.path for p in parts}) == len(segments)
    assert len(m.of("ledger", "batches")) <= 3 + len(run.chunks) // 3 and sum(p.rows for p in parts) == run.moved("line") == len(rows)
    after = store.compact(ARCHIVE, "line").of(ARCHIVE, "line")
    assert len(after) == len(segments) and not any(p.batches for p in after) and not {p.path for p in after} & {p.path for p in parts}
    assert bag(store.archive("line")) == rows and store.compact(ARCHIVE, "line").of(ARCHIVE, "line") == after
    check(spark, store, store.paths, FLAT)
