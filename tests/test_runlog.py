"""Message parsing, log files and the streaming fold."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from siltbed.functions import progress, scalars
from siltbed.operators import ledger
from siltbed.operators.slices import jdbc_predicates
from siltbed.sources import runlog
from siltbed.streaming import progress as live

LINE = "run_id string, worker int, line_no bigint, message string"


def one(spark, column, *values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, m string")
    return [r[0] for r in df.orderBy("i").select(column).collect()]


def test_durations(spark):
    texts = ["Duration : 00:00:01", "Duration : 00:00:01.5", "Duration :00:00:01.25", "Duration : 01:02:03.000004",
             "Duration : 120:00:00", "nothing"]
    assert one(spark, progress.progress_duration_us("m"), *texts) == [
        1_000_000, 1_500_000, 1_250_000, 3_723_000_004, 432_000_000_000, None]


def test_counts_take_the_first_match(spark):
    assert one(spark, progress.progress_count("m"), "2025-01-01 10:11:12 : 20 order(s),95 record(s) archived.",
               "10:11:12 : 7 record(s) archived.", "Order(s) to be archived: [1,2]", "", "Time Limit : 03:00:00") == [
        20, 7, None, None, None]


def test_prefix_is_cut_from_long_messages_only(spark):
    assert one(spark, progress.strip_time_prefix("m"), "2025-01-01 10:11:12 : Total", "short", "x" * 22) == [
        "Total", "short", "x" * 22]


def test_interval_texts(spark):
    df = spark.createDataFrame([(s,) for s in (0, 59, 10_800, 86_400, 90_000, 31 * 86_400 + 5, 400 * 86_400)], "s bigint")
    assert [r[0] for r in df.select(scalars.seconds_to_text("s")).collect()] == [
        "00:00:00", "00:00:59", "03:00:00", "1 day", "1 day 01:00:00", "1 mon 1 day 00:00:05", "1 year 1 mon 10 days"]


def test_run_names(spark):
    assert one(spark, scalars.run_name("m"), "a/b/daily.sql", "daily.sql", "/x/y.tar.gz", "noext", "dir/") == [
        "daily", "daily", "y.tar", "noext", "dir"]


@pytest.fixture
def lines(spark):
    rows = [("r", 0, 1, "Started"), ("r", 0, 2, ""), ("r", 0, 3, "t : 20 order(s),9 record(s).  Duration : 00:00:01.5"),
            ("r", 0, 4, "t : 10 order(s),9 record(s).  Duration : 00:00:02"), ("r", 0, 5, "t : Completed"),
            ("r", 0, 6, "t : Total"), ("r", 0, 7, "t : 30 order(s),18 record(s).  Duration : 00:00:03.5"),
            ("r", 1, 1, "t : 4 order(s),4 record(s).  Duration : 00:00:09"), ("r", 2, 1, "t : Completed"),
            ("q", 0, 1, "nothing yet")]
    return spark.createDataFrame(rows, LINE)


FOLDED = {("r", 0): (30, 3_500_000, True), ("r", 1): (4, 9_000_000, False), ("r", 2): (0, 0, True), ("q", 0): (0, 0, False)}


def folded(df):
    return {(r.run_id, r.worker): (r.total_count, r.duration_us, r.completed) for r in df.collect()}


def test_fold_stops_at_the_end_marker(lines):
    assert folded(ledger.fold_messages(lines)) == FOLDED


def feed(spark, frames, base):
    for i, df in enumerate(frames):
        df.coalesce(1).write.json(f"{base}/in/{i}")
    stream = live.read_live_log(spark, f"{base}/in", files_per_trigger=1)
    assert live.start_progress(stream, f"{base}/out", f"{base}/state").awaitTermination(120)
    return folded(live.progress_totals(spark.read.parquet(f"{base}/out")))


def test_stream_equals_fold_in_any_order(spark, lines, tmp_path):
    ordered = [lines.where("line_no <= 3"), lines.where("line_no > 3")]
    assert feed(spark, ordered, str(tmp_path / "a")) == FOLDED
    late = [lines.where("line_no >= 5"), lines.where("line_no < 5 and worker = 0"), lines.where("line_no < 5")]
    assert feed(spark, late, str(tmp_path / "b")) == FOLDED


def test_a_pause_loses_no_count(spark, tmp_path):
    """Two lines, a stop, three more and one of the first again: a hundred."""
    rows = [("r", 0, n, f"t : {20} order(s),9 record(s) archived.") for n in range(1, 6)]
    frame = spark.createDataFrame(rows, "run_id string, worker int, line_no bigint, message string")
    first, rest = frame.where("line_no <= 2"), frame.where("line_no > 1")
    assert feed(spark, [first], str(tmp_path)) == {("r", 0): (40, 0, False)}
    rest.coalesce(1).write.json(f"{tmp_path}/in/later")
    stream = live.read_live_log(spark, f"{tmp_path}/in", files_per_trigger=1)
    assert live.start_progress(stream, f"{tmp_path}/out", f"{tmp_path}/state").awaitTermination(120)
    assert folded(live.progress_totals(spark.read.parquet(f"{tmp_path}/out"))) == {("r", 0): (100, 0, False)}


def test_block_state_is_bounded(spark, lines):
    plan = live.block_sums(lines)._jdf.queryExecution().toString()
    assert "Python" not in plan
    sums = live.block_sums(lines.union(lines))
    assert {(r.run_id, r.worker): (r.n, r.end_line) for r in sums.collect()}["r", 0] == (30, 5)


def test_stream_over_several_blocks(spark, tmp_path):
    n = 2 * live.BLOCK_LINES + 100
    many = spark.range(1, n).select(
        F.lit("r").alias("run_id"), F.lit(0).alias("worker"), F.col("id").alias("line_no"),
        F.when(F.col("id") == n - 50, "t : Completed").otherwise("t : 2 order(s)").alias("message"))
    frames = [many.where("line_no % 2 = 0"), many.where("line_no % 2 = 1")]
    want = folded(ledger.fold_messages(many))
    assert want == {("r", 0): (2 * (n - 51), 0, True)}
    assert feed(spark, frames, str(tmp_path / "c")) == want


def test_log_files_keep_line_numbers_when_split(spark, tmp_path):
    path = tmp_path / "logs" / "run_id=r" / "worker=0"
    path.mkdir(parents=True)
    texts = [f"line {i} " + "x" * (i % 97) for i in range(5000)]
    (path / "a.log").write_text("\n".join(texts) + "\n")
    (path / "b.log").write_text("\nlast\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        raw = runlog.read_run_log(spark, str(tmp_path / "logs"))
        rows = {r.line_no: r.message for r in raw.collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert rows == dict(enumerate([*texts, "", "last"], 1))


def test_written_log_is_in_order(spark, lines, tmp_path):
    path = tmp_path / "out"
    runlog.write_run_log(lines, str(path))
    text = "".join(f.read_text() for f in sorted((path / "run_id=r").glob("part-*")))
    want = [r.message for r in lines.where("run_id = 'r'").orderBy("worker", "line_no").collect()]
    assert text.splitlines() == want


def test_rendered_log_folds_to_its_ledger(spark):
    rows = [("r", w, b, 20, 60 + b, 1_250_000 * b) for w in (0, 1) for b in range(1, 40)]
    book = spark.createDataFrame(rows, "run_id string, worker int, batch_no bigint, roots bigint, records bigint, duration_us bigint")
    log = runlog.render_lines(book, F.lit(dt.datetime(2025, 1, 1)), F.lit(dt.date(2024, 1, 1)), F.lit(0), F.lit(9), 60)
    want = {(r.run_id, r.worker): (r.roots, r.duration_us, True) for r in ledger.per_worker(book).collect()}
    assert folded(ledger.fold_messages(log)) == want
    assert log.where(F.contains("message", F.lit("time limit has been exceeded"))).count() == 2


def test_status_order(spark):
    df = spark.createDataFrame([("a", True, "w"), ("a", False, None), ("b", True, None), ("c", False, None)],
                               "run_id string, failed boolean, warning string")
    assert {r.run_id: r.status for r in ledger.run_status(df).collect()} == {"a": "Warning", "b": "Failed", "c": "Success"}


def test_sliced_read_predicates_split_the_keys(spark):
    keys = spark.range(-20, 500).withColumnRenamed("id", "key")
    for dialect in ("mod", "percent"):
        for n, splits in ((1, 1), (3, 1), (3, 4), (10, 1)):
            texts = jdbc_predicates("key", n, dialect, splits)
            hits = keys.select(sum(F.expr(f"int({t})") for t in texts).alias("n"), "key")
            assert len(texts) == n * splits
            assert hits.where("n != int(key % 10 between 0 and 9)").isEmpty()
    assert jdbc_predicates("id", 3) == [
        "MOD(id, 10) BETWEEN 0 AND 3", "MOD(id, 10) BETWEEN 4 AND 6", "MOD(id, 10) BETWEEN 7 AND 9"]
