"""Run one archive job: ``spark-submit --py-files ... -m siltbed --store PATH --job orders``."""

from __future__ import annotations

import argparse
import datetime as dt
import json
import sys

from pyspark.sql import functions as F

from siltbed.operators import ledger
from siltbed.plans import jobs, logs, presets
from siltbed.plans.upkeep import upkeep
from siltbed.session import build_session
from siltbed.sources.store import LIVE, Store

JOBS = {
    "orders": (presets.order_tree, presets.order_run, jobs.archive_tree),
    "transaction": (presets.inventory_movement, presets.table_run, jobs.archive_table),
    "store_daily_status": (presets.store_daily_status, presets.table_run, jobs.archive_table),
}


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="siltbed", description="Move aged rows and their dependents to the archive.")
    p.add_argument("--store", required=True, help="folder of the store, shared by all executors")
    p.add_argument("--job", choices=[*sorted(JOBS), "upkeep"], required=True)
    p.add_argument("--adopt", action="append", default=[], metavar="TABLE=PATH", help="register a Parquet folder first")
    p.add_argument("--as-of", type=dt.date.fromisoformat, help="run date, default today in the job's zone")
    p.add_argument("--parallel", type=int, default=1)
    p.add_argument("--first-digit", type=int, default=0)
    p.add_argument("--last-digit", type=int, default=9)
    p.add_argument("--max-batches", type=int, default=0)
    p.add_argument("--chunk-batches", type=int, default=0)
    p.add_argument("--time-limit-sec", type=int, default=presets.TIME_LIMIT_SEC)
    p.add_argument("--log", metavar="PATH", help="folder for the run's text log")
    p.add_argument("--feed", metavar="PATH", help="folder of JSON lines that live progress reads")
    p.add_argument("--strict", action="store_true", help="move exactly the archive tables' columns, fail where one is missing")
    p.add_argument("--dry-run", action="store_true", help="only report what would move")
    return p


def run(spark, argv: list[str] | None = None) -> dict:
    a = parser().parse_args(argv)
    if a.job == "upkeep":
        return upkeep(Store(spark, a.store))
    make_tree, make_options, move = JOBS[a.job]
    tree = make_tree(strict=a.strict)
    options = make_options(
        a.parallel, as_of=a.as_of, first_digit=a.first_digit, last_digit=a.last_digit, max_batches=a.max_batches,
        chunk_batches=a.chunk_batches, time_limit_sec=a.time_limit_sec)
    store = Store(spark, a.store)
    if a.adopt:
        store.adopt(dict(pair.split("=", 1) for pair in a.adopt))
    if a.dry_run:
        root = store.read(store.snapshot(), LIVE, tree.root.name)
        return {"dry_run": [r.asDict() for r in jobs.dry_run(tree, root, options).orderBy("worker").collect()]}
    result = move(store, tree, options)
    if a.log:
        logs.write_job_log(store, tree, options, result, a.log)
    if a.feed:
        logs.feed_lines(store, tree, options, result, a.feed)
    summary = ledger.run_summary(result.ledger(store)).first()
    ended = jobs.last_outcomes(jobs.outcomes(store).where(F.col("run_id") == result.run_id))
    status = ledger.run_status(ended).first()
    return {"status": status.status if status else "Success", "run_id": result.run_id, "version": result.manifest.version, "cutoff": result.cutoff,
            "total_count": summary.total_count, "total_records": summary.total_records,
            "max_duration_us": summary.max_duration_us, "backlog": result.backlog, "timed_out": result.timed_out}


def main() -> int:
    session = build_session("siltbed")
    try:
        print(json.dumps({"status": "Success", **run(session)}, default=str))
        return 0
    except Exception as error:  # reported as the run's status; published chunks stay
        print(json.dumps({"status": "Failed", "error": f"{type(error).__name__}: {error}"}))
        return 1
    finally:
        session.stop()


if __name__ == "__main__":
    sys.exit(main())
