"""Registered queries: each runs an operator over the whole test tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import bindings as B
from siltbed.functions import progress, scalars
from siltbed.operators import audit, batch, closure, cluster, ledger, lookup, maintain, select, sketches, slices
from siltbed.plans import jobs, logs, statistics
from siltbed.plans.upkeep import upkeep
from siltbed.session import scratch_path, settings, stage
from siltbed.sources import runlog, sql, textlog
from siltbed.sources.store import Store
from siltbed.spec import Tree
from siltbed.streaming import bounded, drain
from siltbed.streaming import progress as live

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def stacked(rows: dict[str, DataFrame]) -> DataFrame:
    """Rows of several tables as one relation; columns a table lacks are NULL."""
    named = [df.withColumn("table_name", F.lit(t)) for t, df in rows.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), named)


def tree_moved(spark, sf_dir, tree: Tree, run) -> dict[str, DataFrame]:
    tables = B.tree_tables(spark, sf_dir, tree)
    keys = select.eligible_keys(tree, tables[tree.root.name], run)
    return select.moved_rows(tree, tables, keys, select.eligible_filter(tree, run))


def tree_kept(spark, sf_dir, tree: Tree, run) -> dict[str, DataFrame]:
    tables = B.tree_tables(spark, sf_dir, tree)
    keys = select.eligible_keys(tree, tables[tree.root.name], run)
    return select.kept_rows(tree, tables, keys)


def one(spark, sf_dir, table) -> DataFrame:
    return B.load(spark, sf_dir, table)[table]


def new_store(spark, sf_dir, *tables) -> Store:
    """A store in the shared folder that refers to the test tables.

    Files are small here, so that the small tables still occupy several tasks.
    """
    store = Store(spark, scratch_path(spark, "store"), target_bytes=4 * 1024 * 1024)
    store.adopt({t: f"{sf_dir}/{t}.parquet" for t in tables})
    return store


# -- scans, sources, sinks ---------------------------------------------------------


@query
def scan_project(spark, sf_dir):
    return select.scan(one(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber", "l_extendedprice", "l_shipdate"])


@query
def sliced_scan_predicates(spark, sf_dir):
    orders = one(spark, sf_dir, "orders")
    texts = slices.jdbc_predicates("o_orderkey", 3)
    parts = [orders.where(t).groupBy().agg(F.count("*").alias("row_count"), F.sum("o_orderkey").alias("key_sum"))
             .select(F.lit(i).alias("worker"), "row_count", "key_sum") for i, t in enumerate(texts)]
    return reduce(DataFrame.unionByName, parts)


@query
def archive_append_roundtrip(spark, sf_dir):
    store = new_store(spark, sf_dir, "orders", "lineitem")
    jobs.archive_tree(store, B.ORDER_TREE, B.ORDER_RUN)
    return stacked({t: store.archive(t) for t in ("orders", "lineitem")})


@query
def live_after_archive(spark, sf_dir):
    store = new_store(spark, sf_dir, "orders", "lineitem")
    jobs.archive_tree(store, B.ORDER_TREE, B.ORDER_RUN)
    return stacked({t: store.live(t) for t in ("orders", "lineitem")})


@query
def run_log_read(spark, sf_dir):
    path = scratch_path(spark, "log")
    runlog.write_run_log(B.order_log(spark, sf_dir), path, per_worker_dirs=True)
    return runlog.read_run_log(spark, path).select("run_id", F.col("worker").cast("int").alias("worker"), "line_no", "message")


@query
def run_log_render(spark, sf_dir):
    return B.order_log(spark, sf_dir)


@query
def run_log_merged(spark, sf_dir):
    return runlog.merge_workers(B.order_log_table(spark, sf_dir))


# -- predicates ------------------------------------------------------------------


@query
def filter_retention_age(spark, sf_dir):
    return one(spark, sf_dir, "orders").where(scalars.older_than("o_orderdate", B.ORDER_RUN.as_of, 13))


@query
def filter_retention_age_zoned(spark, sf_dir):
    """Instants against the start of the cutoff day in another zone than the session's."""
    epoch = F.to_timestamp_ntz(F.lit("1970-01-01 00:00:00"))
    instants = one(spark, sf_dir, "events").withColumn("ts", F.timestamp_micros(scalars.elapsed_us(epoch, "ts")))
    rule = scalars.older_than("ts", B.EVENT_RUN.as_of, 2, "Europe/Istanbul")
    return instants.where(rule).select("event_id", "user_id", "event_type", "value")


@query
def filter_key_slice(spark, sf_dir):
    return one(spark, sf_dir, "orders").where(scalars.in_slice("o_orderkey", 0, 3))


@query
def filter_terminal_status(spark, sf_dir):
    return one(spark, sf_dir, "orders").where(F.col("o_orderstatus").isin("F", "P"))


@query
def eligible_keys(spark, sf_dir):
    return B.order_keys(B.load(spark, sf_dir, "orders"))


@query
def param_sql_slice(spark, sf_dir):
    return sql.run_sliced(
        spark, "SELECT o_orderkey, o_orderstatus FROM {orders} "
        "WHERE o_orderkey % 10 BETWEEN @lb@ AND @up@ AND o_orderdate < :cutoff",
        3, {"cutoff": B.ORDER_CUTOFF}, key="o_orderkey", orders=one(spark, sf_dir, "orders"))


# -- joins -------------------------------------------------------------------------


@query
def child_rows_semi(spark, sf_dir):
    return tree_moved(spark, sf_dir, B.ORDER_TREE, B.ORDER_RUN)["lineitem"]


@query
def root_rows_semi(spark, sf_dir):
    t = B.load(spark, sf_dir, "orders")
    return select.matching(t["orders"], "o_orderkey", B.order_keys(t))


@query
def grandchild_rows_semi(spark, sf_dir):
    return tree_moved(spark, sf_dir, B.CUSTOMER_TREE, B.CUSTOMER_RUN)["lineitem"]


@query
def bloom_lookup(spark, sf_dir):
    """Lines of the hundred dearest orders, in files that lie by part and have Bloom filters on the order."""
    path, lines = scratch_path(spark, "bloom"), one(spark, sf_dir, "lineitem")
    (lines.repartition("l_partkey").sortWithinPartitions("l_partkey")
          .write.options(**lookup.bloom_options({"l_orderkey": 1_000_000})).parquet(path))
    dearest = one(spark, sf_dir, "orders").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(100).select("o_orderkey")
    return lookup.lookup(spark.read.parquet(path), "l_orderkey", dearest)


@query
def closure_rows(spark, sf_dir):
    """Customers that refer to customers by two columns, in circles and to themselves, and what hangs on them."""
    tables = B.load(spark, sf_dir, "customer", "orders", "lineitem")
    key = F.col("c_custkey")
    tables["customer"] = tables["customer"].select(
        "c_custkey", F.when(key % 3 == 1, key * 7 % 101).alias("first_up"),
        F.when(key % 13 == 0, key).when(key % 4 == 0, F.floor(key / 3)).alias("second_up"))
    links = [closure.Link("customer", "first_up", "customer"), closure.Link("customer", "second_up", "customer"),
             closure.Link("orders", "o_custkey", "customer"), closure.Link("lineitem", "l_orderkey", "orders")]
    start = {"customer": tables["customer"].where(key % 40 == 10).select("c_custkey")}
    found = closure.closure_rows(tables, {"customer": "c_custkey", "orders": "o_orderkey"}, links, start)
    none = F.lit(None).cast("bigint")
    return stacked({"customer": found["customer"].select(key.alias("key"), none.alias("line")),
                    "orders": found["orders"].select(F.col("o_orderkey").alias("key"), none.alias("line")),
                    "lineitem": found["lineitem"].select(F.col("l_orderkey").alias("key"), F.col("l_linenumber").cast("bigint").alias("line"))})


@query
def child_rows_kept_anti(spark, sf_dir):
    return tree_kept(spark, sf_dir, B.ORDER_TREE, B.ORDER_RUN)["lineitem"]


@query
def root_rows_kept_anti(spark, sf_dir):
    return tree_kept(spark, sf_dir, B.ORDER_TREE, B.ORDER_RUN)["orders"]


@query
def single_table_split(spark, sf_dir):
    numbered = batch.assign_batches(
        one(spark, sf_dir, "events").where(select.eligible_filter(B.EVENT_TABLE, B.EVENT_RUN)),
        scalars.worker_of("event_id", 3), "event_id", 300)
    kept = one(spark, sf_dir, "events").where(~F.coalesce(select.eligible_filter(B.EVENT_TABLE, B.EVENT_RUN), F.lit(False)))
    none = {"worker": F.lit(None).cast("int"), "batch_no": F.lit(None).cast("bigint")}
    return numbered.withColumn("side", F.lit("moved")).unionByName(kept.withColumns(none).withColumn("side", F.lit("kept")))


@query
def archive_by_key_list(spark, sf_dir):
    t = B.load(spark, sf_dir, "orders", "lineitem")
    lists = ledger.batch_id_lists(B.numbered_orders(t), "o_orderkey").select(
        F.split("ids", ",").cast("array<bigint>").alias("ids"))
    return select.matching(t["lineitem"], "l_orderkey", select.keys_from_list(lists, "ids", "id"))


# -- aggregates ----------------------------------------------------------------------


@query
def backlog_by_slice(spark, sf_dir):
    t = B.load(spark, sf_dir, "orders")
    first = batch.cap_batches(B.numbered_orders(t), 5).select("o_orderkey")
    return ledger.backlog(B.ORDER_TREE, select.not_matching(t["orders"], "o_orderkey", first), B.ORDER_RUN)


@query
def moved_counts_per_table(spark, sf_dir):
    return ledger.counts_per_table(tree_moved(spark, sf_dir, B.CUSTOMER_TREE, B.CUSTOMER_RUN))


@query
def observed_counts(spark, sf_dir):
    """The moved counts of the customer tree, taken while its rows are written."""
    base = scratch_path(spark, "observed")
    moved = tree_moved(spark, sf_dir, B.CUSTOMER_TREE, B.CUSTOMER_RUN)
    return ledger.write_counted(moved, lambda table, rows: rows.write.parquet(f"{base}/{table}"))


@query
def moved_records_total(spark, sf_dir):
    return ledger.total_records(moved_counts_per_table(spark, sf_dir), "customer")


@query
def batch_id_list(spark, sf_dir):
    return ledger.batch_id_lists(B.numbered_orders(B.load(spark, sf_dir, "orders")), "o_orderkey")


@query
def single_table_moved_count(spark, sf_dir):
    store = new_store(spark, sf_dir, "events")
    run = jobs.archive_table(store, B.EVENT_TABLE, B.EVENT_RUN)
    return run.ledger(store).groupBy("worker").agg(F.sum("records").alias("moved"))


@query
def ledger_running_totals(spark, sf_dir):
    return ledger.running_totals(B.order_ledger(spark, sf_dir))


@query
def run_summary(spark, sf_dir):
    return ledger.run_summary(B.order_ledger(spark, sf_dir))


@query
def run_log_fold(spark, sf_dir):
    return ledger.fold_messages(B.order_log_table(spark, sf_dir))


@query
def table_run_log_fold(spark, sf_dir):
    return ledger.fold_messages(stage(B.event_log(spark, sf_dir), "log"))


@query
def conservation_audit(spark, sf_dir):
    tree, run = B.CUSTOMER_TREE, B.CUSTOMER_RUN
    return ledger.conservation(B.tree_tables(spark, sf_dir, tree), tree_moved(spark, sf_dir, tree, run),
                               tree_kept(spark, sf_dir, tree, run))


@query
def content_audit(spark, sf_dir):
    """A real move as it is, and with one kept value blanked, which numbers of rows can't show."""
    store = new_store(spark, sf_dir, "orders", "lineitem")
    jobs.archive_tree(store, B.ORDER_TREE, replace(B.ORDER_RUN, audit_contents=True))
    names = [t.name for t in B.ORDER_TREE.tables]
    before, moved, kept = B.load(spark, sf_dir, *names), {n: store.archive(n) for n in names}, {n: store.live(n) for n in names}
    blanked = {}
    for t in B.ORDER_TREE.tables:
        column = "o_totalprice" if t.parent is None else "l_quantity"
        first = kept[t.name].agg(F.min(t.key)).first()[0]
        blanked[t.name] = kept[t.name].withColumn(column, F.when(F.col(t.key) != first, F.col(column)))
    return audit.content_conservation(before, moved, kept).withColumn("state", F.lit("as moved")).unionByName(
        audit.content_conservation(before, moved, blanked).withColumn("state", F.lit("one value blanked")))


# -- batches -------------------------------------------------------------------------


@query
def batch_assignment(spark, sf_dir):
    return B.numbered_orders(B.load(spark, sf_dir, "orders"))


@query
def batch_cap(spark, sf_dir):
    return batch.cap_batches(B.numbered_orders(B.load(spark, sf_dir, "orders")), 5)


@query
def batch_budget(spark, sf_dir):
    return batch.within_budget(B.order_ledger(spark, sf_dir), "records", 500, ("run_id", "worker")).select(
        "worker", "batch_no", "roots", "records")


@query
def slice_plan(spark, sf_dir):
    digits = one(spark, sf_dir, "orders").groupBy(scalars.last_digit("o_orderkey").alias("digit")).agg(
        F.count("*").alias("n"))
    plans = spark.range(1, 11).select(F.col("id").cast("int").alias("workers")).withColumn(
        "worker", F.explode(F.sequence(F.lit(0), F.col("workers") - 1)))
    lower, upper = slices.slice_bounds(F.col("workers"))
    owned = plans.select("workers", "worker", lower.alias("lb"), upper.alias("up")).withColumn(
        "digit", F.explode(F.sequence(F.col("lb").cast("bigint"), F.col("up").cast("bigint"))))
    return owned.join(digits, "digit").groupBy("workers", "worker", "lb", "up").agg(F.sum("n").alias("row_count"))


@query
def eligible_by_worker(spark, sf_dir):
    return ledger.backlog(B.ORDER_TREE, one(spark, sf_dir, "orders"), B.ORDER_RUN).withColumnRenamed("backlog", "eligible")


# -- scalars -------------------------------------------------------------------------


@query
def scalar_modulo(spark, sf_dir):
    return one(spark, sf_dir, "orders").select(
        "o_orderkey", scalars.last_digit("o_orderkey").alias("digit"),
        scalars.last_digit(F.lit(0) - F.col("o_orderkey")).alias("negative_digit"),
        *[scalars.worker_of("o_orderkey", n).alias(f"worker_of_{n}") for n in (1, 3, 7, 10)])


@query
def scalar_month_minus(spark, sf_dir):
    return one(spark, sf_dir, "orders").select(
        "o_orderkey", *[scalars.months_before(F.col("o_orderdate").cast("date"), n).alias(f"minus_{n}") for n in (1, 2, 13)])


@query
def scalar_ts_format(spark, sf_dir):
    return one(spark, sf_dir, "events").select("event_id", scalars.ts_text("ts").alias("ts_text"))


@query
def scalar_seconds_to_hms(spark, sf_dir):
    return one(spark, sf_dir, "orders").select(
        "o_orderkey", scalars.seconds_to_text(F.col("o_orderkey") * 3).alias("short_text"),
        scalars.seconds_to_text(F.floor(F.col("o_totalprice") * 100).cast("bigint")).alias("long_text"))


@query
def scalar_micros_to_text(spark, sf_dir):
    return one(spark, sf_dir, "orders").select(
        "o_orderkey", scalars.micros_to_text(F.col("o_orderkey") * 250_000).alias("micros_text"))


@query
def scalar_elapsed(spark, sf_dir):
    start = F.to_timestamp_ntz(F.lit("2024-01-01 00:00:00"))
    return one(spark, sf_dir, "events").select("event_id", scalars.elapsed_us(start, "ts").alias("elapsed_us"))


@query
def parse_progress_count(spark, sf_dir):
    return B.order_log(spark, sf_dir).select("worker", "line_no", progress.progress_count("message").alias("n"))


@query
def parse_progress_duration(spark, sf_dir):
    return B.order_log(spark, sf_dir).select("worker", "line_no", progress.progress_duration_us("message").alias("us"))


@query
def strip_time_prefix(spark, sf_dir):
    return B.order_log(spark, sf_dir).select("worker", "line_no", progress.strip_time_prefix("message").alias("text"))


@query
def run_name_from_path(spark, sf_dir):
    return one(spark, sf_dir, "pages").select("page_id", scalars.run_name("url").alias("run_name"))


@query
def run_status(spark, sf_dir):
    return ledger.run_status(one(spark, sf_dir, "events").select(
        F.concat(F.lit("run-"), F.col("user_id").cast("string")).alias("run_id"),
        (F.col("event_type") == "error").alias("failed"),
        F.when(F.col("event_type") == "signup", F.col("props")).alias("warning")))


# -- jobs ------------------------------------------------------------------------------


@query
def archive_tree_moved(spark, sf_dir):
    return stacked(tree_moved(spark, sf_dir, B.ORDER_TREE, B.ORDER_RUN))


@query
def archive_tree_kept(spark, sf_dir):
    return stacked(tree_kept(spark, sf_dir, B.ORDER_TREE, B.ORDER_RUN))


@query
def archive_customer_tree_moved(spark, sf_dir):
    return stacked(tree_moved(spark, sf_dir, B.CUSTOMER_TREE, B.CUSTOMER_RUN))


@query
def archive_customer_tree_kept(spark, sf_dir):
    return stacked(tree_kept(spark, sf_dir, B.CUSTOMER_TREE, B.CUSTOMER_RUN))


@query
def customer_tree_job(spark, sf_dir):
    store = new_store(spark, sf_dir, "customer", "orders", "events", "lineitem")
    jobs.archive_tree(store, B.CUSTOMER_TREE, B.CUSTOMER_RUN)
    names = [t.name for t in B.CUSTOMER_TREE.tables]
    return ledger.conservation(B.load(spark, sf_dir, *names), {n: store.archive(n) for n in names},
                               {n: store.live(n) for n in names})


@query
def tree_job_ledger(spark, sf_dir):
    store = new_store(spark, sf_dir, "orders", "lineitem")
    run = jobs.archive_tree(store, B.ORDER_TREE, replace(B.ORDER_RUN, max_batches=6, chunk_batches=3))
    return run.ledger(store).select("chunk", "worker", "batch_no", "roots", "records")


def both_sides(store: Store, *names: str) -> DataFrame:
    rows = {}
    for side, table in (("archive", store.archive), ("live", store.live)):
        rows |= {f"{side} {t}": table(t) for t in names}
    return stacked(rows)


@query
def mixed_layout_order_tree(spark, sf_dir):
    """Lines by date, then the order tree, on one store."""
    store = new_store(spark, sf_dir, "orders", "lineitem")
    jobs.archive_table(store, B.SHIP_TABLE, B.SHIP_RUN)
    jobs.archive_tree(store, B.ORDER_TREE, B.ORDER_RUN)
    return both_sides(store, "orders", "lineitem")


@query
def mixed_layout_customer_tree(spark, sf_dir):
    """The order tree, then the customer tree, on one store."""
    store = new_store(spark, sf_dir, "customer", "orders", "events", "lineitem")
    jobs.archive_tree(store, B.ORDER_TREE, B.ORDER_RUN)
    jobs.archive_tree(store, B.CUSTOMER_TREE, B.CUSTOMER_RUN)
    return both_sides(store, "customer", "orders", "events", "lineitem")


@query
def changed_span_tree(spark, sf_dir):
    """A capped run, then a full one of the same tree with another width and other months."""
    store = new_store(spark, sf_dir, "orders", "lineitem")
    jobs.archive_tree(store, B.ORDER_TREE, replace(B.ORDER_RUN, max_batches=3))
    wider = replace(B.ORDER_TREE, segment_months=5, dependents=tuple(replace(t, span=1000) for t in B.ORDER_TREE.dependents))
    jobs.archive_tree(store, wider, B.ORDER_RUN)
    return both_sides(store, "orders", "lineitem")


@query
def tree_rewrite_bucketed(spark, sf_dir):
    """The order tree with joins that shuffle: rows are dealt once, by segment, for join and write."""
    store = new_store(spark, sf_dir, "orders", "lineitem")
    store.target_bytes = 256 * 1024
    with settings(spark, {f"spark.sql.{a}autoBroadcastJoinThreshold": "-1" for a in ("", "adaptive.")}):
        jobs.archive_tree(store, B.ORDER_TREE, replace(B.ORDER_RUN, chunk_batches=40))
    return both_sides(store, "orders", "lineitem")


@query
def archive_odd_columns(spark, sf_dir):
    """Columns named as change feeds and the engine's own operators name theirs."""
    odd = one(spark, sf_dir, "events").withColumns({
        "__op": F.concat(F.lit("c"), F.col("event_type")), "worker": F.col("user_id") + 1, "batch_no": F.col("event_id") * 2})
    path = scratch_path(spark, "odd")
    odd.write.parquet(path)
    out = {}
    for name, cap in (("capped", 4), ("full", 0)):
        store = Store(spark, scratch_path(spark, "store"), target_bytes=4 * 1024 * 1024)
        store.adopt({"events": path})
        jobs.archive_table(store, B.EVENT_TABLE, replace(B.EVENT_RUN, max_batches=cap))
        out |= {f"{name} archive": store.archive("events"), f"{name} live": store.live("events")}
    return stacked(out)


@query
def archive_provenance(spark, sf_dir):
    """Worker and batch in the archive files of a run without a cap."""
    store = new_store(spark, sf_dir, "events")
    run = jobs.archive_table(store, B.EVENT_TABLE, B.EVENT_RUN)
    files = [store.locate(p) for p in run.manifest.of("archive", "events")]
    return spark.read.schema("event_id bigint, arch_worker int, arch_batch bigint").parquet(*files)


@query
def drain_job_ledger(spark, sf_dir):
    """A full run in many chunks has the ledger of a run in one."""
    store = new_store(spark, sf_dir, "orders", "lineitem")
    run = jobs.archive_tree(store, B.ORDER_TREE, replace(B.ORDER_RUN, chunk_batches=9))
    return run.ledger(store).select("worker", "batch_no", "roots", "records")


@query
def job_run_status(spark, sf_dir):
    """Status of a run that ended, one that ran out of time and one that failed."""
    store = new_store(spark, sf_dir, "orders", "lineitem")
    chunks = replace(B.ORDER_RUN, chunk_batches=3)
    jobs.archive_tree(store, B.ORDER_TREE, replace(chunks, run_id="late", time_limit_sec=1, max_batches=60))
    try:
        lost = replace(B.ORDER_TREE, root=replace(B.ORDER_TREE.root, columns=("no_such_column",)))
        jobs.archive_tree(store, lost, replace(chunks, run_id="lost"))
    except ValueError:
        pass
    jobs.archive_tree(store, B.ORDER_TREE, replace(B.ORDER_RUN, run_id="whole"))
    return ledger.run_status(jobs.last_outcomes(jobs.outcomes(store))).select("run_id", "status")


@query
def job_run_log(spark, sf_dir):
    """The log of a real run without its times: its keys, its counts, its totals."""
    store = new_store(spark, sf_dir, "orders", "lineitem")
    run = jobs.archive_tree(store, B.ORDER_TREE, replace(B.ORDER_RUN, run_id="run-1", time_limit_sec=B.TIME_LIMIT))
    path = scratch_path(spark, "log")
    logs.write_job_log(store, B.ORDER_TREE, replace(B.ORDER_RUN, time_limit_sec=B.TIME_LIMIT), run, path)
    lines = runlog.read_run_log(spark, path).withColumn("message", progress.strip_time_prefix("message"))
    text = F.regexp_replace("message", "Duration : .*", "Duration")
    return lines.select("run_id", F.col("worker").cast("int").alias("worker"), "line_no", text.alias("message"))


@query
def archive_table_by_ts_moved(spark, sf_dir):
    return select.split_by_rule(one(spark, sf_dir, "events"), select.eligible_filter(B.EVENT_TABLE, B.EVENT_RUN))[0]


@query
def archive_table_by_ts_kept(spark, sf_dir):
    store = new_store(spark, sf_dir, "events")
    jobs.archive_table(store, B.EVENT_TABLE, B.EVENT_RUN)
    return store.live("events")


@query
def archive_table_by_date_moved(spark, sf_dir):
    store = new_store(spark, sf_dir, "lineitem")
    jobs.archive_table(store, B.SHIP_TABLE, B.SHIP_RUN)
    return store.archive("lineitem")


@query
def archive_table_by_date_kept(spark, sf_dir):
    return select.split_by_rule(one(spark, sf_dir, "lineitem"), select.eligible_filter(B.SHIP_TABLE, B.SHIP_RUN))[1]


@query
def drain_plan(spark, sf_dir):
    """Per worker: batches and records that a capped and budgeted run still starts."""
    rows = batch.cap_batches(B.order_ledger(spark, sf_dir), 8)
    started = batch.within_budget(rows, "records", 600, ("run_id", "worker"))
    return started.groupBy("worker").agg(
        F.max("batch_no").alias("batches"), F.sum("roots").alias("roots"), F.sum("records").alias("records"))


@query
def archive_by_worker(spark, sf_dir):
    tables = B.tree_tables(spark, sf_dir, B.ORDER_TREE)
    return ledger.moved_by_worker(B.ORDER_TREE, tables, B.order_keys(tables), 3)


@query
def column_stats(spark, sf_dir):
    return maintain.column_stats(one(spark, sf_dir, "lineitem"))


@query
def column_sketches(spark, sf_dir):
    """Statistics that upkeep keeps per written part, merged over both sides of a move:
    counts, and whether estimates are within the stated error of the exact values."""
    store = new_store(spark, sf_dir, "orders", "lineitem")
    jobs.archive_tree(store, B.ORDER_TREE, B.ORDER_RUN)
    upkeep(store)
    both = [statistics.sketches_of(store, side, "lineitem") for side in ("live", "archive")]
    found = stage(sketches.estimates(sketches.merged(both[0].unionByName(both[1]))), "estimates")
    rows = one(spark, sf_dir, "lineitem")
    exact = maintain.column_stats(rows).select("column_name", F.col("distinct_count").alias("exact"))
    median = {r.column_name: r.quantiles[sketches.QUANTILES.index(0.5)] for r in found.where("quantiles IS NOT NULL").collect()}
    values = {c: sketches.as_number(F.col(c), rows.schema[c].dataType) for c in median}
    ranks = rows.agg(*[F.struct(F.avg((v < median[c]).cast("int")).alias("below"), F.avg((v <= median[c]).cast("int")).alias("upto")).alias(c)
                       for c, v in values.items()])
    ranks = ranks.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"{c}.below"), F.col(f"{c}.upto")) for c in values])))
    return found.join(exact, "column_name").join(ranks, "column_name", "left").select(
        "column_name", "row_count", "null_count",
        (F.abs(F.col("distinct_count") - F.col("exact")) <= 0.05 * F.col("exact") + 1).alias("distinct_close"),
        F.when(F.col("quantiles").isNotNull(), (F.col("below") <= 0.53) & (F.col("upto") >= 0.47)).alias("median_close"))


@query
def column_ranges(spark, sf_dir):
    return maintain.column_ranges(one(spark, sf_dir, "lineitem"))


@query
def compact_roundtrip(spark, sf_dir):
    store = new_store(spark, sf_dir, "orders", "lineitem")
    jobs.archive_tree(store, B.ORDER_TREE, replace(B.ORDER_RUN, chunk_batches=40))
    store.compact("archive", "lineitem")
    return store.archive("lineitem")


@query
def clustered_rewrite(spark, sf_dir):
    """lineitem rewritten so that files are small in both ship date and order."""
    path = scratch_path(spark, "clustered")
    cluster.rewrite_clustered(one(spark, sf_dir, "lineitem"), path, ["l_shipdate", "l_orderkey"], target_bytes=1024 * 1024)
    return spark.read.parquet(path)


@query
def dry_run_report(spark, sf_dir):
    return jobs.dry_run(B.ORDER_TREE, one(spark, sf_dir, "orders"), replace(B.ORDER_RUN, time_limit_sec=B.TIME_LIMIT))


# -- streaming ---------------------------------------------------------------------------


@query
def stream_progress(spark, sf_dir):
    base = scratch_path(spark, "stream")
    B.order_log(spark, sf_dir).write.json(f"{base}/lines")
    feed = live.read_live_log(spark, f"{base}/lines", files_per_trigger=4)
    started = live.start_progress(feed, f"{base}/out", f"{base}/state")
    started.awaitTermination()
    return live.progress_totals(spark.read.parquet(f"{base}/out"))


@query
def stream_progress_bounded(spark, sf_dir):
    """The order log with instants, a seventh of its lines twice, through a watermark.

    A last line far ahead closes all windows. What came too late, which depends on the
    order the files are listed in, is found in the feed.
    """
    base = scratch_path(spark, "stream")
    at = F.timestamp_seconds(F.lit(883_652_100) + F.col("line_no") * 20)
    lines = B.order_log_table(spark, sf_dir).select("run_id", "worker", "line_no", "message", at.alias("at"))
    lines.unionByName(lines.where("line_no % 7 = 0")).write.json(f"{base}/lines/first")

    def run():
        feed = bounded.read_timed_log(spark, f"{base}/lines", files_per_trigger=4)
        bounded.start_bounded(feed, f"{base}/out", f"{base}/state").awaitTermination()

    run()
    last = lines.agg(F.max("at")).select(F.lit("").alias("run_id"), F.lit(-1).alias("worker"), F.lit(1).cast("bigint").alias("line_no"),
                                         F.lit("").alias("message"), (F.col("max(at)") + F.expr("interval 1 day")).alias("at"))
    last.write.json(f"{base}/lines/last")
    run()
    windows = spark.read.parquet(f"{base}/out")
    feed = spark.read.schema(bounded.SCHEMA).option("recursiveFileLookup", "true").json(f"{base}/lines")
    return bounded.bounded_totals(windows, bounded.late_lines(feed, windows))


def three_drops(spark, sf_dir) -> str:
    """lineitem dropped in three parts by key, a scheduled run after each and one more; the folder of it all."""
    base, rule = scratch_path(spark, "drain"), select.eligible_filter(B.SHIP_TABLE, B.SHIP_RUN)
    rows = one(spark, sf_dir, "lineitem")
    for part in (0, 1, 2, None):
        if part is not None:
            rows.where(F.col("l_orderkey") % 3 == part).write.parquet(f"{base}/drops/part-{part}")
        feed = drain.read_drops(spark, f"{base}/drops", rows.schema, files_per_trigger=4)
        drain.start_drain(feed, rule, f"{base}/out", f"{base}/state").awaitTermination()
    return base


@query
def incremental_drain(spark, sf_dir):
    """Rows by side after four scheduled runs, each of which read the new files alone."""
    out = f"{three_drops(spark, sf_dir)}/out"
    return stacked({side: drain.drained(spark, out, side) for side in (drain.MOVED, drain.KEPT)}).withColumnRenamed("table_name", "side")


@query
def incremental_drain_audit(spark, sf_dir):
    """What each drop had and where it went, from its files."""
    base = three_drops(spark, sf_dir)
    part = F.regexp_extract("file", "/part-([0-9])/", 1).cast("bigint").alias("part")
    return drain.drain_audit(spark, f"{base}/drops", f"{base}/out").groupBy(part).agg(
        *[F.sum(c).alias(c) for c in ("before", "moved", "kept")], F.bool_and("balanced").alias("balanced"))


@query
def stream_job_feed(spark, sf_dir):
    """Live totals from the lines that two jobs appended to one feed."""
    base = scratch_path(spark, "stream")
    store = new_store(spark, sf_dir, "orders", "lineitem", "events")
    for tree, run, move in ((B.ORDER_TREE, B.ORDER_RUN, jobs.archive_tree), (B.EVENT_TABLE, B.EVENT_RUN, jobs.archive_table)):
        run = replace(run, run_id=tree.root.name)
        logs.feed_lines(store, tree, run, move(store, tree, run), f"{base}/lines")
    live.start_progress(live.read_live_log(spark, f"{base}/lines"), f"{base}/out", f"{base}/state").awaitTermination()
    return live.progress_totals(spark.read.parquet(f"{base}/out")).select("run_id", "worker", "total_count", "completed")


@query
def stream_text_log(spark, sf_dir):
    """Plain text logs as a stream: the first lines of every worker, a restart, then the others."""
    base, lines = scratch_path(spark, "stream"), B.order_log_table(spark, sf_dir)
    for step, part in enumerate(("line_no <= 100", "line_no > 100")):
        runlog.write_run_log(lines.where(part), f"{base}/logs/step-{step}", per_worker_dirs=True)
        feed = textlog.read_text_stream(spark, f"{base}/logs", piece_bytes=1024 * 1024)
        textlog.start_text_log(feed, f"{base}/out", f"{base}/state").awaitTermination()
    return textlog.read_text_lines(spark, f"{base}/out")
