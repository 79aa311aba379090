"""The live fold with a watermark: totals, late lines, bounded state."""

import datetime as dt

from pyspark.sql import functions as F

from siltbed.operators import ledger
from siltbed.streaming import bounded

BEGIN = dt.datetime(2025, 1, 1, 10)


def run_lines(run, start, lines=60, worker=0):
    """Lines of one run, one per ten seconds, the last an end marker."""
    out = [(run, worker, i, f"t : {i % 5} order(s)", start + dt.timedelta(seconds=10 * i)) for i in range(1, lines)]
    return [*out, (run, worker, lines, "t : Completed", start + dt.timedelta(seconds=10 * lines))]


def drop(spark, rows, path, n):
    spark.createDataFrame(rows, bounded.SCHEMA).coalesce(1).write.json(f"{path}/{n:04d}")


def consume(spark, base, **kw):
    feed = bounded.read_timed_log(spark, f"{base}/lines", files_per_trigger=1)
    query = bounded.start_bounded(feed, f"{base}/out", f"{base}/state", **kw)
    assert query.awaitTermination(200)
    return query.recentProgress


def totals(df):
    return {(r.run_id, r.worker): (r.total_count, r.duration_us, r.completed) for r in df.collect()}


def batch_feed(spark, base):
    return spark.read.schema(bounded.SCHEMA).option("recursiveFileLookup", "true").json(f"{base}/lines")


def far(days=30):
    return [("", -1, 1, "", BEGIN + dt.timedelta(days=days))]


def test_state_does_not_grow_with_closed_runs(spark, tmp_path):
    base, rows = str(tmp_path), []
    for n in range(12):
        own = run_lines(f"run-{n}", BEGIN + dt.timedelta(hours=3 * n))
        rows += own
        # A tenth comes again.
        drop(spark, own + own[::10], f"{base}/lines", n)
    states = consume(spark, base, delay="30 minutes", width="10 minutes")
    held = [sum(s["numRowsTotal"] for s in p["stateOperators"]) for p in states]
    assert len(held) >= 12
    # Two runs' lines and their windows at most, of twelve.
    assert max(held) <= 2 * (60 + 3) and max(held[-4:]) <= max(held[:8])
    drop(spark, far(), f"{base}/lines", 99)
    last = consume(spark, base, delay="30 minutes", width="10 minutes")
    assert sum(s["numRowsTotal"] for s in last[-1]["stateOperators"]) <= 2
    windows = spark.read.parquet(f"{base}/out")
    want = totals(ledger.fold_messages(spark.createDataFrame(rows, bounded.SCHEMA).drop("at")))
    assert totals(bounded.bounded_totals(windows)) == want
    assert bounded.late_lines(batch_feed(spark, base), windows).count() == 0


def test_late_lines_are_found_and_count(spark, tmp_path):
    base = str(tmp_path)
    own = run_lines("r", BEGIN)
    late, rest = own[3:9], own[:3] + own[9:]
    drop(spark, rest, f"{base}/lines", 0)
    drop(spark, far(1), f"{base}/lines", 1)
    consume(spark, base)
    # They come after their window was closed, one of them twice; a last line of a window still open isn't late.
    drop(spark, late + late[:1], f"{base}/lines", 2)
    drop(spark, run_lines("open", BEGIN + dt.timedelta(days=1), lines=3), f"{base}/lines", 3)
    consume(spark, base)
    windows, feed = spark.read.parquet(f"{base}/out"), batch_feed(spark, base)
    missed = bounded.late_lines(feed, windows)
    assert sorted(r.line_no for r in missed.collect()) == [r[2] for r in late]
    assert {r.run_id for r in missed.collect()} == {"r"}
    want = totals(ledger.fold_messages(spark.createDataFrame(own, bounded.SCHEMA).drop("at")))
    assert totals(bounded.bounded_totals(windows, missed)) == want
    assert totals(bounded.bounded_totals(windows)) != want


def test_lines_after_the_end_marker_do_not_count(spark, tmp_path):
    base = str(tmp_path)
    own = run_lines("r", BEGIN, lines=20)
    after = [("r", 0, 21 + i, "t : 100 order(s)", BEGIN + dt.timedelta(minutes=5 + 10 * i)) for i in range(3)]
    other = run_lines("r", BEGIN, worker=1)[:-1]
    drop(spark, own + after + other, f"{base}/lines", 0)
    drop(spark, far(), f"{base}/lines", 1)
    consume(spark, base)
    want = totals(ledger.fold_messages(spark.createDataFrame(own + after + other, bounded.SCHEMA).drop("at")))
    assert want["r", 0][2] and not want["r", 1][2]
    assert totals(bounded.bounded_totals(spark.read.parquet(f"{base}/out"))) == want


def test_a_restart_goes_on(spark, tmp_path):
    base, rows = str(tmp_path), []
    for n in range(4):
        own = run_lines("r", BEGIN)[15 * n:15 * n + 15]
        rows += own
        drop(spark, own, f"{base}/lines", n)
        consume(spark, base)
    drop(spark, far(), f"{base}/lines", 9)
    consume(spark, base)
    windows = spark.read.parquet(f"{base}/out")
    assert windows.groupBy("opened", "run_id", "worker", "block").count().where(F.col("count") > 1).count() == 0
    assert totals(bounded.bounded_totals(windows)) == totals(ledger.fold_messages(spark.createDataFrame(rows, bounded.SCHEMA).drop("at")))
