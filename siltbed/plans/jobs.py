"""The archive jobs: move eligible rows, with their dependents, in published chunks.

A run numbers its keys once and cuts them into chunks of batches. A chunk reads the
parts that hold its keys and writes their rows once: those that stay, and those that
move, apart for each group of chunks. Its own moved rows go to the archive, those of
later chunks stay live: a later chunk only names its batches of the written directories.
Counts are checked on disk, then all tables are published with one manifest version. A
failure before that leaves readers on the old version; a rerun starts from there.

A group is as many chunks as make one of default size. So neither directories and files
nor Spark jobs multiply with chunks of few rows, and a manifest stays short.
"""

from __future__ import annotations

import datetime as dt
import json
import time
import uuid
from bisect import bisect_left, bisect_right
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field, replace
from functools import reduce
from itertools import accumulate

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltbed.functions.scalars import months_earlier, worker_of
from siltbed.operators.audit import content_conservation, row_hash
from siltbed.operators.batch import assign_batches
from siltbed.operators.lookup import FEW, lookup
from siltbed.operators.select import eligible_filter, eligible_keys, require, scan
from siltbed.operators.slices import slice_plan
from siltbed.session import ADVISORY, listed_by_cores, settings, stage
from siltbed.sources.store import (
    ARCHIVE, BATCH, LEDGER, LIVE, OWN, SEGMENT, SIDE, WORKER, Manifest, Part, Store, files_of, first_of, layout_of, month_index,
    range_label, segment_of,
)
from siltbed.spec import RunOptions, Table, Tree

MOVED, KEPT = "moved", "kept"
KEY, SEG, FILE = f"{OWN}key", f"{OWN}seg", f"{OWN}file"
TO_WORKER, TO_BATCH = f"{OWN}worker", f"{OWN}batch"
PLACE, SALT = f"{OWN}place", f"{OWN}salt"
# Settings of a run: a join takes rows as they lie, dealt by some of its keys.
CO_PARTITIONED = {"spark.sql.requireAllClusterKeysForCoPartition": "false"}
# Bytes of rows in memory for each byte of a file, about.
INFLATION = 4
# Up to so many keys may be broadcast: in memory they take many times their bytes on disk.
BROADCAST_KEYS = 200_000
# A write of more tasks than this gives each several files' rows, up to so many bytes: what a task loads before it
# starts grows with the number of tasks.
TASKS, TASK_BYTES = 1_000, 16 * 1024 * 1024
# Root rows a chunk aims at where the run names no number of batches, and a group of smaller chunks.
CHUNK_ROWS = 20_000_000
# Chunks that a directory is archived by before their parts of it become one, and chunks of one ledger file.
FOLDED = 64
# The driver writes a chunk's ledger if it has up to so many batches; it takes up to BATCHES_HELD from Spark at once.
LEDGER_ROWS, BATCHES_HELD = 5_000, 50_000
LEDGER_SCHEMA = T.StructType([
    T.StructField("run_id", T.StringType()), T.StructField("root", T.StringType()),
    T.StructField("chunk", T.IntegerType()), T.StructField("worker", T.IntegerType()),
    *[T.StructField(c, T.LongType()) for c in ("batch_no", "roots", "records", "duration_us")],
])
OUTCOME_SCHEMA = T.StructType([
    T.StructField("run_id", T.StringType()), T.StructField("root", T.StringType()),
    T.StructField("chunk", T.IntegerType()), T.StructField("worker", T.IntegerType()),
    T.StructField("started", T.TimestampType()), T.StructField("cutoff", T.DateType()),
    *[T.StructField(c, T.LongType()) for c in ("roots", "backlog", "duration_us")],
    T.StructField("timed_out", T.BooleanType()), T.StructField("failed", T.BooleanType()),
    T.StructField("warning", T.StringType()), T.StructField("error", T.StringType()),
])


class AuditError(RuntimeError):
    """A table would lose, gain or archive rows twice; nothing was published."""


@dataclass
class Chunk:
    """What one published chunk did.

    ``manifest`` is dropped once the run has it: every manifest names all parts, so those
    of a run's chunks together would grow with the square of their number.
    """

    manifest: Manifest | None
    batches: int
    roots: dict[int, int]
    backlog: dict[int, int]
    audit: list[tuple[str, int, int, int]]
    duration_us: int = 0


@dataclass
class RunResult:
    run_id: str
    cutoff: dt.date
    manifest: Manifest
    chunks: list[Chunk] = field(default_factory=list)
    timed_out: bool = False
    backlog: int = 0

    @property
    def roots(self) -> int:
        return sum(sum(c.roots.values()) for c in self.chunks)

    @property
    def records(self) -> int:
        return sum(moved for c in self.chunks for _, _, moved, _ in c.audit)

    def moved(self, table: str) -> int:
        return sum(m for c in self.chunks for t, _, m, _ in c.audit if t == table)

    def ledger(self, store: Store) -> DataFrame:
        """One row per worker and batch. A run that found nothing has zero rows each."""
        if self.chunks and self.manifest.of(LEDGER, "batches"):
            return store.read(self.manifest, LEDGER, "batches").where(F.col("run_id") == self.run_id)
        return small_rows(store.spark, LEDGER_SCHEMA, [(self.run_id, "", 1, 0, 1, 0, 0, 0)])


def small_rows(spark: SparkSession, schema: T.StructType, rows: list[tuple]) -> DataFrame:
    """A few driver-side numbers (at most one row per worker) as a relation."""
    # As one text: a call for each value would take longer than the job, at every chunk.
    text = json.dumps([dict(zip(schema.names, row)) for row in rows], default=lambda value: value.isoformat())
    return spark.range(0, 1, 1, 1).select(F.inline(F.from_json(F.lit(text), T.ArrayType(schema), {"mode": "FAILFAST"})))


# -- run loop ------------------------------------------------------------------


def archive_tree(store: Store, tree: Tree, options: RunOptions) -> RunResult:
    """Move eligible roots and all their dependents."""
    if not tree.root.unique:
        raise ValueError(f"{tree.root.name}: a tree root needs a unique key")
    return _drain(store, tree, options, _tree_chunks)


def archive_table(store: Store, tree: Tree, options: RunOptions) -> RunResult:
    """Move eligible rows of one table that nothing depends on."""
    if tree.dependents:
        raise ValueError(f"{tree.root.name} has dependents, use archive_tree")
    return _drain(store, tree, options, _table_chunks)


Steps = Callable[[Store, Tree, RunOptions, "RunResult"], Iterator[Chunk]]


def _drain(store: Store, tree: Tree, options: RunOptions, steps: Steps) -> RunResult:
    """Chunks until nothing is left, the cap is reached or time is up.

    After each chunk the time limit is tested before the other two, so a run that
    empties the backlog too late still counts as timed out. A run that fails leaves
    a row that says so.
    """
    options = replace(options, as_of=options.resolved_as_of())
    result = RunResult(options.run_id or uuid.uuid4().hex, _cutoff(tree, options), store.snapshot())
    begun, started = dt.datetime.now(dt.timezone.utc), time.monotonic()
    try:
        with settings(store.spark, {ADVISORY: str(store.target_bytes), **CO_PARTITIONED}), listed_by_cores(store.spark):
            before = started
            for chunk in steps(store, tree, options, result):
                now = time.monotonic()
                chunk.duration_us = int((now - before) * 1_000_000)
                late = bool(options.time_limit_sec) and now - started > options.time_limit_sec
                chunk.manifest = store.publish(chunk.manifest)
                result.chunks.append(chunk)
                result.manifest, result.backlog, result.timed_out = chunk.manifest, sum(chunk.backlog.values()), late
                chunk.manifest = None
                _log_outcomes(store, tree, result, begun)
                before = time.monotonic()
                if late:
                    break
    except Exception as error:
        try:
            _log_outcomes(store, tree, result, begun, f"{type(error).__name__}: {error}"[:1000])
        except Exception as second:
            error.add_note(f"and the failure was not recorded: {second}")
        raise
    return result


def _cutoff(tree: Tree, options: RunOptions) -> dt.date:
    """The cutoff as a driver-side date, for reports and segment pruning."""
    return months_earlier(options.resolved_as_of(), tree.months)


def _chunk_size(options: RunOptions) -> int:
    """Batches per worker and chunk."""
    return options.chunk_batches or max(1, CHUNK_ROWS // (options.batch_size * options.parallel))


# -- shared pieces ---------------------------------------------------------------


def _candidate_parts(manifest: Manifest, tree: Tree, options: RunOptions) -> list[Part]:
    """Root parts that can hold eligible rows: by month where there is an age rule."""
    parts, layout = manifest.of(LIVE, tree.root.name), layout_of(tree, tree.root)
    if not tree.age_column:
        return list(parts)
    # A day later: months are of the day in UTC, the cutoff may be of another zone.
    last = month_index(_cutoff(tree, options) + dt.timedelta(days=1), tree.segment_months)
    return [p for p in parts if p.layout != layout or (p.segment != "none" and int(p.segment) <= last)]


def _side(group: Column) -> Column:
    """Side label of rows that move with a group of chunks."""
    return F.concat(F.lit(f"{MOVED}-"), F.lpad(group.cast("string"), 8, "0"))


def _sides(rows: DataFrame, names: list[str], tree: Tree, table: Table, size: int) -> DataFrame:
    """Add side, segment and, for moved rows, the worker and batch that move them.

    A side has ``size`` batches of each worker.

    ``rows`` carry TO_WORKER and TO_BATCH where they move, and the table's columns
    ``names``; those outside the table's column list are blanked once they move.
    """
    scan(rows, table.columns)
    return rows.select(
        *[F.col(_tick(c)) for c in names], F.col(TO_WORKER).cast("int").alias(WORKER), F.col(TO_BATCH).cast("bigint").alias(BATCH),
        F.when(F.col(TO_BATCH).isNull(), KEPT).otherwise(_side(_chunk_of(TO_BATCH, size))).alias(SIDE),
        segment_of(tree, table).alias(SEGMENT))


def _tick(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _chunk_of(batch: str, size: int) -> Column:
    return F.floor((F.col(batch) - 1) / size).cast("bigint")


def _archive_schema(store: Store, manifest: Manifest, table: Table) -> T.StructType:
    """Columns of the archive table; every moved column must be there."""
    schema = store.schema(manifest, LIVE, table.name)
    names = list(table.columns or schema.names)
    if f"{ARCHIVE}/{table.name}" not in manifest.schemas:
        return T.StructType([schema[c] for c in names])
    target = store.schema(manifest, ARCHIVE, table.name)
    lost = [c for c in names if c not in target.names]
    if lost:
        raise AuditError(f"{table.name}: the archive has no column {', '.join(lost)}")
    return target


def _check_columns(store: Store, manifest: Manifest, tree: Tree) -> None:
    """Fail before anything is written if any table lacks a column of its list or of its archive.

    Tables are written side by side, each apart for all chunks: one that can't move would
    otherwise be known only after the others were written.
    """
    for t in tree.tables:
        require(store.schema(manifest, LIVE, t.name).names, t.columns)
        _archive_schema(store, manifest, t)


def _swap(
    store: Store, manifest: Manifest, table: Table, read: list[Part], shared: list[_Shared], stay: list[Part], moved: list[Part]
) -> Manifest:
    """The manifest after parts ``read`` and the live parts of ``shared`` directories became parts that stay and
    parts that moved; ``moved`` has all archived parts of the shared directories.

    The archive may hold batches of a directory that is read: those of an earlier run that was stopped.
    """
    target, ours = _archive_schema(store, manifest, table), {s.part.path for s in shared}
    gone = ours | {p.path for p in read}
    live = [p for p in manifest.of(LIVE, table.name) if p.path not in gone]
    archive = [p for p in manifest.of(ARCHIVE, table.name) if p.path not in ours]
    return (manifest.with_table(LIVE, table.name, live + stay)
            .with_table(ARCHIVE, table.name, archive + moved, target.json()))


def _count_audit(table: Table, before: int, moved: int, kept: int) -> tuple[str, int, int, int]:
    """before = moved + kept, from the rows on disk on both sides."""
    if before != moved + kept:
        raise AuditError(f"{table.name}: {before} rows before, {moved} moved and {kept} kept")
    return table.name, before, moved, kept


def _rows_in(parts: list[Part]) -> int:
    return sum(p.rows for p in parts)


def _content_audit(store: Store, manifest: Manifest, table: Table, gone: list[Part], stay: list[Part], moved: list[Part]) -> None:
    """Fail unless the rows of parts ``gone`` are those that stay and those that moved, value by value.

    A table's column list limits the comparison: other columns of moved rows are blank.
    """
    rows = [store.read(manifest, LIVE, table.name, parts) for parts in (gone, moved, stay)]
    names = {table.name: list(table.columns or rows[0].columns)}
    found = content_conservation(*[{table.name: r} for r in rows], names).first()
    if not found.content_ok:
        raise AuditError(f"{table.name}: rows were altered, of {found.before} {found.moved} moved and {found.kept} kept")


def _archived_twice(
    store: Store, manifest: Manifest, table: Table, new: list[Part], waiting: list[Part], size: int, several_chunks: bool
) -> dict[int, object]:
    """Chunks that would archive a key twice, each with such a key.

    ``new`` parts, of one or of many chunks, are compared with the archive and, like the
    parts that are ``waiting`` already, with those of other chunks. So what later chunks only
    publish is looked at once. Only archive parts whose key range meets theirs are opened.
    """
    if not (table.unique and new):
        return {}
    ranges = [p.range_of(table.key) for p in new]
    spans: list[tuple[int, int]] = []
    for low, high in sorted(r for r in ranges if r):
        if spans and low <= spans[-1][1]:
            spans[-1] = spans[-1][0], max(high, spans[-1][1])
        else:
            spans.append((low, high))

    def meets(old: Part) -> bool:
        own = old.range_of(table.key)
        if own is None or None in ranges:
            return True
        at = bisect_right(spans, own[1], key=lambda span: span[0]) - 1
        return at >= 0 and own[0] <= spans[at][1]

    def tagged(parts: list[Part]) -> DataFrame:
        rows = _provenance(store, manifest, table, parts, table.key)
        return rows.select(F.col(_tick(table.key)).alias(KEY), _chunk_of(BATCH, size).alias("chunk"))

    found: dict[int, object] = {}
    opened = [p for p in manifest.of(ARCHIVE, table.name) if meets(p)]
    if opened:
        old = _sized(store.read(manifest, ARCHIVE, table.name, opened).select(_tick(table.key)), _rows_in(opened))
        rows = tagged(new)
        twice = rows.join(old, rows[KEY] == old[_tick(table.key)], "left_semi")
        found |= dict(twice.groupBy("chunk").agg(F.min(KEY)).collect())
    if several_chunks:
        rows = tagged(new + waiting)
        several = rows.groupBy(KEY).agg(F.min("chunk").alias("a"), F.max("chunk").alias("b")).where("a < b").select(KEY, "a")
        later = rows.join(several, KEY).where("chunk > a").groupBy("chunk").agg(F.min(KEY)) if not several.isEmpty() else None
        found = dict(later.collect()) | found if later is not None else found
    return found


def _check_not_archived(table: Table, twice: dict[int, object], chunk: int) -> None:
    """Fail when a key that moves with the chunk is in the archive already."""
    if chunk in twice:
        raise AuditError(f"{table.name}: key {twice[chunk]} is in the archive already")


class _Book:
    """Writes a run's ledger: a file per chunk, and one for every ``FOLDED`` of them in their place."""

    def __init__(self):
        self.recent: list[tuple[Part, list[tuple]]] = []

    def add(self, store: Store, manifest: Manifest, tree: Tree, run_id: str, chunk: int, batches: DataFrame | list[tuple]) -> Manifest:
        """Append a chunk's batches (worker, batch_no, roots, records, duration_us)."""
        path, parts = f"ledger/{run_id}-{chunk:05d}", list(manifest.of(LEDGER, "batches"))
        if isinstance(batches, DataFrame):
            rows = batches.select(
                F.lit(run_id).alias("run_id"), F.lit(tree.root.name).alias("root"), F.lit(chunk).alias("chunk"),
                *[F.col(f.name).cast(f.dataType).alias(f.name) for f in LEDGER_SCHEMA.fields[3:]])
            rows.write.parquet(f"{store.root}/{path}")
            parts.append(Part(path, None, 0))
        else:
            rows = [(run_id, tree.root.name, chunk, *b) for b in batches]
            if len(self.recent) >= FOLDED or sum(len(r) for _, r in self.recent) + len(rows) > BATCHES_HELD:
                self._fold(store, run_id, parts)
            store.write_few(f"{store.root}/{path}", LEDGER_SCHEMA, rows)
            self.recent.append((Part(path, None, 0), rows))
            parts.append(self.recent[-1][0])
        return manifest.with_table(LEDGER, "batches", parts, LEDGER_SCHEMA.json())

    def _fold(self, store: Store, run_id: str, parts: list[Part]) -> None:
        """Replace the files of the latest chunks by one."""
        own = {p.path for p, _ in self.recent}
        path = f"ledger/{run_id}-upto-{self.recent[-1][1][0][2]:05d}"
        store.write_few(f"{store.root}/{path}", LEDGER_SCHEMA, [row for _, rows in self.recent for row in rows])
        parts[:] = [p for p in parts if p.path not in own] + [Part(path, None, 0)]
        self.recent = []


def _log_outcomes(store: Store, tree: Tree, result: RunResult, begun: dt.datetime, error: str | None = None) -> None:
    """Append one row per worker that says how its latest chunk, or the run, ended.

    Outcomes lie beside the versions: a run that fails changes no table.
    """
    failed = error is not None
    chunk = result.chunks[-1] if result.chunks and not failed else Chunk(result.manifest, 0, {0: 0}, {0: result.backlog}, [])
    warning = "out of time" if result.timed_out else None
    rows = [(result.run_id, tree.root.name, len(result.chunks), w, begun, result.cutoff, chunk.roots.get(w, 0), left,
             chunk.duration_us, result.timed_out, failed, warning, error) for w, left in sorted(chunk.backlog.items())]
    store.write_few(store.outcomes_path, OUTCOME_SCHEMA, rows)


def outcomes(store: Store) -> DataFrame:
    """How the chunks of all runs ended, failed runs included."""
    if store.has(store.outcomes_path):
        return store.spark.read.schema(OUTCOME_SCHEMA).parquet(store.outcomes_path)
    return store.spark.createDataFrame([], OUTCOME_SCHEMA)


def last_outcomes(rows: DataFrame) -> DataFrame:
    """Per run and worker the outcome of the latest chunk; a failure outlasts all."""
    latest = F.max_by(F.struct("started", "cutoff", "backlog", "timed_out", "warning", "error"), "chunk").alias("o")
    return rows.groupBy("run_id", "worker").agg(F.max("failed").alias("failed"), latest).select("run_id", "worker", "failed", "o.*")


def _with_idle_workers(
    batches: DataFrame | list[tuple], options: RunOptions, counts: dict[int, int], first: bool
) -> DataFrame | list[tuple]:
    """A worker without eligible rows still runs one empty batch."""
    idle = [(w, 1, 0, 0, 0) for w in range(options.parallel) if not counts.get(w)] if first else []
    if not idle or isinstance(batches, list):
        return batches + idle if idle else batches
    schema = T.StructType([LEDGER_SCHEMA[c] for c in ("worker", "batch_no", "roots", "records", "duration_us")])
    return batches.unionByName(small_rows(batches.sparkSession, schema, idle))


@dataclass
class _Plan:
    """Chunks of a run: which rows of each worker move with which."""

    counts: dict[int, int]
    batch: int
    size: int
    cap: int

    @property
    def batches(self) -> int:
        most = max((-(-n // self.batch) for n in self.counts.values()), default=0)
        return min(most, self.cap) if self.cap else most

    @property
    def chunks(self) -> int:
        return -(-self.batches // self.size)

    @property
    def group(self) -> int:
        """Chunks that share directories: as many as make a chunk of default size."""
        return max(1, CHUNK_ROWS // max(1, self.batch * self.size * len(self.counts)))

    def group_end(self, chunk: int) -> int:
        """The first chunk after the group of one."""
        return (chunk // self.group + 1) * self.group

    def rows_before(self, chunk: int) -> dict[int, int]:
        """Rows of each worker in the chunks before one."""
        upto = min(chunk * self.size, self.batches) * self.batch
        return {w: min(n, upto) for w, n in self.counts.items()}

    def rows(self, chunk: int) -> dict[int, int]:
        before, after = self.rows_before(chunk), self.rows_before(chunk + 1)
        return {w: after[w] - before[w] for w in self.counts}

    def left(self, chunk: int) -> dict[int, int]:
        """Backlog of each worker after a chunk."""
        after = self.rows_before(chunk + 1)
        return {w: n - after[w] for w, n in self.counts.items()}


# -- record tree -----------------------------------------------------------------


@dataclass
class _Shared:
    """A written directory whose rows move with the chunks of one group.

    ``counts`` has the rows of each of these chunks, ``archived`` the parts of it that were archived.
    """

    part: Part
    counts: dict[int, int]
    archived: list[Part] = field(default_factory=list)

    def __post_init__(self):
        self._chunks = sorted(self.counts)
        self._upto = list(accumulate((self.counts[c] for c in self._chunks), initial=0))

    def waiting(self, chunk: int, size: int) -> list[Part]:
        """Its live part before a chunk."""
        left = self._upto[-1] - self._upto[bisect_left(self._chunks, chunk)]
        return [self.part if left == self.part.rows else replace(self.part, rows=left, batches=(chunk * size, None))] if left else []

    def of(self, chunk: int, size: int) -> list[Part]:
        """Its rows that move with a chunk."""
        n = self.counts.get(chunk, 0)
        return [self.part if n == self.part.rows else replace(self.part, rows=n, batches=(chunk * size, (chunk + 1) * size))] if n else []

    def archive(self, chunk: int, size: int) -> None:
        """Add a chunk's rows to the archived ones; many such parts become one."""
        if len(self.archived) >= FOLDED:
            self.archived = [replace(self.part, rows=sum(p.rows for p in self.archived),
                                     batches=(self.archived[0].batches[0], self.archived[-1].batches[1]))]
        self.archived += self.of(chunk, size)


@dataclass
class _Written:
    """Parts of one table that a run has written and that are still live.

    ``pending`` rows, by group, move with a chunk of it. ``settled`` parts hold no row of any key
    of the run: they were split by all of them. ``twice`` has the chunks that would
    archive a key for the second time. ``due`` has the first chunk with a row in a part that was
    there before, ``unproven`` the parts without any that can't be told to have none from their ranges.
    """

    pending: dict[int, list[_Shared]] = field(default_factory=dict)
    settled: set[str] = field(default_factory=set)
    twice: dict[int, object] = field(default_factory=dict)
    due: dict[int, list[Part]] | None = None
    unproven: list[Part] = field(default_factory=list)

    def paths(self) -> set[str]:
        return self.settled | {s.part.path for group in self.pending.values() for s in group}

    def waiting(self, chunk: int, size: int) -> list[Part]:
        return [p for group in self.pending.values() for s in group for p in s.waiting(chunk, size)]


def _tree_chunks(store: Store, tree: Tree, options: RunOptions, result: RunResult) -> Iterator[Chunk]:
    root, manifest = tree.root, result.manifest
    rows = store.read(manifest, LIVE, root.name, _candidate_parts(manifest, tree, options))
    chosen = rows.where(eligible_filter(tree, options)).select(
        F.col(_tick(root.key)).alias(KEY), segment_of(tree, root).alias(SEG))
    numbered = assign_batches(chosen, worker_of(KEY, options.parallel), KEY, options.batch_size, names=(WORKER, BATCH))
    if options.max_batches:
        counted = stage(numbered, "numbered")
        keys = counted.where(F.col(BATCH) <= options.max_batches)
    else:
        keys = counted = stage(numbered, "numbered")
    plan = _Plan(_worker_counts(counted, WORKER), options.batch_size, _chunk_size(options), options.max_batches)
    written, records, book = {t.name: _Written() for t in tree.tables}, _Records(plan), _Book()
    if plan.chunks:
        _check_columns(store, manifest, tree)
    for chunk in range(plan.chunks):
        started = time.monotonic()
        yield _tree_chunk(store, tree, options, result, plan, chunk, keys, written, records, book, started)


def _tree_chunk(
    store: Store, tree: Tree, options: RunOptions, result: RunResult, plan: _Plan, chunk: int, keys: DataFrame,
    written: dict[str, _Written], records: _Records, book: _Book, started: float
) -> Chunk:
    """Move the rows of one chunk; rows met of later chunks are put apart for them."""
    manifest = before = result.manifest
    links, size = {}, plan.size
    label, audit, fresh = f"{result.run_id}-{chunk + 1:05d}", {}, {}

    def link(t: Table) -> DataFrame:
        """Keys of this and all later chunks that rows of the table hang on."""
        above = t.parent or t.name
        if above != tree.root.name:
            return links[above]
        return _sized(keys.where(_chunk_of(BATCH, size) >= chunk), sum(plan.left(chunk - 1).values()))

    def quick(t: Table) -> bool:
        """Nothing is left to read or to look into for this chunk."""
        own = written[t.name]
        return own.due is not None and not own.unproven and all(c > chunk for c in own.due)

    def touched(t: Table, own: _Written) -> list[Part]:
        """Parts that hold rows of the chunk, or of a later one of its group, and weren't split yet."""
        layout, direct = layout_of(tree, t), t.parent in (None, tree.root.name)
        if plan.chunks > 1 and direct:
            if own.due is None:
                own.due, own.unproven = _due_parts(store, before, t, list(before.of(LIVE, t.name)), link(t), layout, plan)
            read = []
            if any(c <= chunk for c in own.due):
                read = [p for c in sorted(own.due) if c < plan.group_end(chunk) for p in own.due.pop(c)]
            seen = {p.path for p in read} if own.unproven else set()
            own.unproven = [p for p in own.unproven if p.path not in seen]
            if own.unproven:
                _audit_unread(store, before, t, own.unproven, link(t).where(_chunk_of(BATCH, size) == chunk), layout)
            return read
        now = link(t).where(_chunk_of(BATCH, size) == chunk) if plan.chunks > 1 else link(t)
        done = own.paths()
        live = [p for p in before.of(LIVE, t.name) if p.path not in done]
        read, looked_up = _touched_parts(store, before, t, live, now, layout)
        seen = {p.path for p in read + looked_up}
        _audit_unread(store, before, t, [p for p in live if p.path not in seen], now, layout)
        return read

    def move(t: Table) -> tuple[list[Part], list[_Shared], list[Part], list[Part]]:
        own = written[t.name]
        own.pending = {g: shared for g, shared in own.pending.items() if g >= chunk // plan.group}
        waiting = own.waiting(chunk, size)
        ready = [p for s in own.pending.get(chunk // plan.group, []) for p in s.of(chunk, size)]
        read = touched(t, own)
        kept, new = _split_by_link(store, before, tree, t, read, link(t), plan, f"data/{t.name}/{label}") if read else ([], [])
        fresh[t.name] = [s.part for s in new]
        for s in new:
            own.pending.setdefault(min(s.counts) // plan.group, []).append(s)
        if t.parent in (None, tree.root.name):
            own.settled.update(p.path for p in kept)
        now = [s for s in own.pending.get(chunk // plan.group, []) if chunk in s.counts]
        moved = [p for s in now for p in s.of(chunk, size)]
        stay = kept + [p for s in new for p in s.waiting(chunk + 1, size)]
        audit[t.name] = _count_audit(t, _rows_in(read) + _rows_in(ready), _rows_in(moved), _rows_in(stay))
        if options.audit_contents:
            _content_audit(store, before, t, read + ready, stay, moved)
        if new:
            chunks = {c for group in own.pending.values() for s in group for c in s.counts if c >= chunk}
            own.twice |= _archived_twice(store, before, t, fresh[t.name], waiting, size, len(chunks) > 1)
        _check_not_archived(t, own.twice, chunk)
        if tree.children(t.name) and t.parent is not None:
            known = own.waiting(chunk, size)
            links[t.name] = _sized(_next_link(store, before, t, known), _rows_in(known))
        for s in now:
            s.archive(chunk, size)
        changed = now + [s for s in new if chunk not in s.counts]
        return read, changed, kept + [p for s in changed for p in s.waiting(chunk + 1, size)], [p for s in now for p in s.archived]

    for level in _levels(tree):
        # Threads for tables with work for Spark only.
        moves = [move(t) for t in level] if all(map(quick, level)) else _concurrently(store.spark, move, level)
        for t, changes in zip(level, moves):
            manifest = _swap(store, manifest, t, *changes)

    roots = plan.rows(chunk)
    if sum(roots.values()) != audit[tree.root.name][2]:
        raise AuditError(f"{tree.root.name}: {sum(roots.values())} keys chosen, {audit[tree.root.name][2]} rows moved")
    spent = int((time.monotonic() - started) * 1_000_000)
    records.add(store, tree, fresh)
    ledger = _with_idle_workers(_tree_ledger(records.of(chunk), roots, options.batch_size, spent), options, plan.counts, chunk == 0)
    manifest = book.add(store, manifest, tree, result.run_id, chunk + 1, ledger)
    return Chunk(manifest, min(size, plan.batches - chunk * size), roots, plan.left(chunk), [audit[t.name] for t in tree.tables])


def _levels(tree: Tree) -> list[list[Table]]:
    """Tables that can move at the same time: the root and its dependents only need
    the chosen keys, every deeper table the moved keys of its parent."""
    depth: dict[str, int] = {}
    for t in tree.tables:
        depth[t.name] = 0 if t.parent in (None, tree.root.name) else depth[t.parent] + 1
    return [[t for t in tree.tables if depth[t.name] == d] for d in range(max(depth.values()) + 1)]


def _concurrently(spark: SparkSession, fn: Callable, items: list, at_once: int = 4) -> list:
    """Submit independent Spark jobs side by side, so one table's tail does not
    leave the cluster idle. The first error is raised after all have ended."""
    if len(items) == 1:
        return [fn(items[0])]
    task = inheritable_thread_target(spark)(fn)
    with ThreadPoolExecutor(at_once) as pool:
        return [f.result() for f in [pool.submit(task, i) for i in items]]


def _worker_counts(rows: DataFrame, worker: str) -> dict[int, int]:
    """At most ten numbers."""
    return {w: n for w, n in rows.groupBy(worker).count().collect() if w is not None}


def _link_column(table: Table) -> str:
    return table.key if table.parent is None else table.link


def _hit_segments(table: Table, link: DataFrame, known: list[str]) -> set[str]:
    """Labels of segments that the chosen keys fall into, among those the manifest knows."""
    label = F.col(SEG) if table.parent is None else range_label(F.col(KEY), table.span)
    return {r[0] for r in link.select(label.alias("s")).where(F.col("s").isin(known)).distinct().collect()} if known else set()


def _touched_parts(
    store: Store, manifest: Manifest, table: Table, parts: list[Part], link: DataFrame, layout: str
) -> tuple[list[Part], list[Part]]:
    """Parts that can hold rows of the chosen keys, and those that were looked into.

    A part of the table's own layout is found by its label, which follows from the
    keys. All others, adopted files and segments that another tree or width made,
    are looked up by a semi-join that reads nothing but the link column.
    """
    own = [p for p in parts if p.segment is not None and p.layout == layout]
    hit = _hit_segments(table, link, sorted({p.segment for p in own}))
    loose = [p for p in parts if p.segment is None or p.layout != layout]
    found = loose
    if len(loose) > 1:
        rows = store.read(manifest, LIVE, table.name, loose, with_file=FILE)
        on = _link_column(table)
        found = files_of(lookup(rows.select(_tick(on), FILE), on, link.select(KEY)), FILE, loose, store.locate)
    return [p for p in own if p.segment in hit] + found, loose


def _due_parts(
    store: Store, manifest: Manifest, table: Table, parts: list[Part], link: DataFrame, layout: str, plan: _Plan
) -> tuple[dict[int, list[Part]], list[Part]]:
    """The first chunk of a run that has rows in a part, for all parts at once; and parts of the table's
    own layout without any that only a look can tell to have none.

    They are found as ``_touched_parts`` finds those of one chunk.
    """
    chunk = _chunk_of(BATCH, plan.size).alias("c")
    own = [p for p in parts if p.segment is not None and p.layout == layout]
    known = sorted({p.segment for p in own})
    label = F.col(SEG) if table.parent is None else range_label(F.col(KEY), table.span)
    first = dict(link.select(label.alias("s"), chunk).where(F.col("s").isin(known)).groupBy("s").agg(F.min("c")).collect()) if known else {}
    due = {p.path: first[p.segment] for p in own if p.segment in first}
    loose = [p for p in parts if p.segment is None or p.layout != layout]
    if len(loose) == 1:
        due[loose[0].path] = 0
    elif loose:
        on = _link_column(table)
        rows = store.read(manifest, LIVE, table.name, loose, with_file=FILE).select(_tick(on), FILE)
        if sum(plan.counts.values()) <= FEW:
            rows = lookup(rows, on, link.select(KEY))
        keys = link.select(KEY, chunk)
        of_file = rows.join(keys, rows[_tick(on)] == keys[KEY]).groupBy(FILE).agg(F.min("c").alias("c"))
        due |= first_of(of_file, loose, store.locate)
    out: dict[int, list[Part]] = {}
    for p in parts:
        if p.path in due:
            out.setdefault(due[p.path], []).append(p)
    unread = [p for p in own if due.get(p.path) != 0]
    return out, _unproven(table, unread, layout) if table.parent is not None else []


def _unproven(table: Table, parts: list[Part], layout: str) -> list[Part]:
    """Parts that can hold keys of other segments: their ranges of link values aren't known to lie in their own."""
    def label(value: int) -> str:
        return str(abs(value) // table.span * (1 if value >= 0 else -1))

    def proven(part: Part) -> bool:
        own = part.range_of(table.link)
        return part.layout == layout and own is not None and label(own[0]) == label(own[1]) == part.segment

    return [p for p in parts if not proven(p) and not (p.segment == "none" and p.layout == layout)]


def _audit_unread(store: Store, manifest: Manifest, table: Table, unread: list[Part], link: DataFrame, layout: str) -> None:
    """Fail if a part that is left alone holds a row of a chosen key.

    The range of link values in a part's files, where it is known to lie in the
    part's own segment, rules it out; the others are joined with the keys. A root's
    chosen keys come from its own rows, so their number is enough.
    """
    if table.parent is None:
        return
    open_ = _unproven(table, unread, layout)
    if open_:
        rows = lookup(store.read(manifest, LIVE, table.name, open_).select(_tick(table.link)), table.link, link.select(KEY))
        if not rows.isEmpty():
            raise AuditError(f"{table.name}: rows of {rows.first()[0]} are in a part that was not read")


def _split_by_link(
    store: Store, manifest: Manifest, tree: Tree, table: Table, read: list[Part], link: DataFrame, plan: _Plan, label: str
) -> tuple[list[Part], list[_Shared]]:
    """One scan, one join on the unique chosen keys, one write of all sides: parts that stay, and those that move."""
    rows = store.read(manifest, LIVE, table.name, read)
    counts = _rows_per_segment(store, tree, table, rows, read)
    of_file, most = (max(1, size * INFLATION // max(1, rows._jdf.schema().defaultSize())) for size in (store.target_bytes, TASK_BYTES))
    each = max(of_file, min(most, -(-sum(counts.values()) // TASKS)))
    tasks = {s: -(-n // each) for s, n in counts.items()}
    # Small segments share tasks: very many of them don't make very many tasks.
    small = -(-sum(counts[s] for s, n in tasks.items() if n == 1) // each) + store.spark.sparkContext.defaultParallelism
    split = _split(rows, tree, table, link, plan.size * plan.group, tasks, small)
    return _kept_and_shared(*store.write_chunks(
        split, label, layout_of(tree, table), _link_column(table), table.key, placed=True, chunk=_chunk_of(BATCH, plan.size),
        rows_per_file=of_file))


def _kept_and_shared(sides: dict[str, list[Part]], counts: dict[str, dict[int, int]]) -> tuple[list[Part], list[_Shared]]:
    return sides.pop(KEPT, []), [_Shared(p, counts[p.path]) for parts in sides.values() for p in parts]


def _rows_per_segment(store: Store, tree: Tree, table: Table, rows: DataFrame, read: list[Part]) -> dict[str, int]:
    """How many rows each segment will have; one number per segment.

    Rows of parts in the table's own layout are counted in the manifest, those of others
    by a scan of the column their label follows from.
    """
    layout, counts = layout_of(tree, table), {}
    loose = [p for p in read if p.segment is None or p.layout != layout]
    for p in read:
        if p.segment is not None and p.layout == layout:
            counts[p.segment] = counts.get(p.segment, 0) + p.rows
    if loose:
        own = store.read(store.snapshot(), LIVE, table.name, loose) if len(loose) < len(read) else rows
        for segment, n in own.groupBy(segment_of(tree, table).alias("s")).count().collect():
            counts[segment] = counts.get(segment, 0) + n
    return {s: n for s, n in counts.items() if n}


def _split(
    rows: DataFrame, tree: Tree, table: Table, link: DataFrame, size: int, tasks: dict[str, int], small: int | None = None
) -> DataFrame:
    """All rows with their side, dealt once: by segment and, inside a large one, by ranges of the link.

    A key goes to the task of its range only, so the join and the write use one exchange of
    the table and keys aren't multiplied by the tasks. Ranges follow key order, as batches
    do: a task meets few chunks and writes few files. A range with too many rows, as of a
    parent with very many, is dealt by a hash of the row, and its keys go to each of its tasks.
    ``tasks`` has the number of tasks per segment; segments of one task share ``small`` tasks
    at most.
    """
    names, on = rows.columns, _link_column(table)
    large = {s: n for s, n in tasks.items() if n > 1}
    of_key = F.col(SEG) if table.parent is None else range_label(F.col(KEY), table.span)
    chosen = link.select(KEY, F.col(WORKER).alias(TO_WORKER), F.col(BATCH).alias(TO_BATCH), of_key.alias(PLACE))
    placed, by = rows.withColumn(PLACE, segment_of(tree, table)), [PLACE]
    if large:
        by = [PLACE, SALT]
        cuts = _Cuts.of(placed, on, large)
        # A root's key is of one row, so its hash spreads rows as well and needs no copies.
        spread = F.xxhash64(_number(on)) if table.parent is None else row_hash(rows)
        copies = F.sequence(F.lit(0), cuts.copies(KEY) - 1) if table.parent is not None else F.array(
            cuts.pick(KEY, F.xxhash64(_number(KEY))))
        chosen = chosen.withColumn(SALT, F.explode(F.transform(copies, lambda n: cuts.share(KEY) + n)))
        placed = placed.withColumn(SALT, cuts.share(on) + cuts.pick(on, spread))
    # Twice as many partitions as shares, for several shares can fall into one.
    single = len(tasks) - len(large)
    width = 2 * max(1, sum(large.values()) + min(single, small or single))
    # With fewer partitions than its own joins have, Spark would deal the rows by all of the join's columns.
    conf = rows.sparkSession.conf
    own = conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None) or conf.get("spark.sql.shuffle.partitions")
    dealt = placed.repartition(max(width, int(own)), *by)
    same = reduce(Column.__and__, [dealt[c] == chosen[c] for c in by])
    return _sides(dealt.join(chosen, same & (dealt[_tick(on)] == chosen[KEY]), "left"), names, tree, table, size)


def _number(column: str) -> Column:
    """A link as a number: values that a join takes for equal are equal."""
    return F.col(_tick(column)).try_cast("double")


@dataclass
class _Cuts:
    """How the rows of large segments are dealt among tasks, by ranges of their link.

    A segment's range of link values has ``CELLS`` cells of one width for each of its tasks.
    Cells in a row make a share until it has a task's part of the rows; a cell of over twice
    that has several shares. ``segments`` has per segment the place of its first cell in
    ``first`` and ``many`` (first share and number of shares of a cell), its least value and
    the width and number of its cells.
    """

    segments: dict[str, tuple[int, float, float, int]]
    first: list[int]
    many: list[int]

    CELLS = 8

    @staticmethod
    def of(placed: DataFrame, on: str, tasks: dict[str, int]) -> _Cuts:
        inside = placed.where(F.col(PLACE).isin(list(tasks))).select(PLACE, _number(on).alias("x"))
        ends = {r[0]: r[1:] for r in inside.groupBy(PLACE).agg(F.min("x"), F.max("x")).collect()}
        segments, at = {}, 0
        for s, n in tasks.items():
            low, high = ends.get(s, (None, None))
            # Without numbers, as where all links are null, a segment is one cell.
            cells = n * _Cuts.CELLS if low is not None and 0 < high - low < float("inf") else 1
            segments[s] = at, low if cells > 1 else 0.0, (high - low) / cells if cells > 1 else 1.0, cells
            at += cells
        cuts = _Cuts(segments, [0] * at, [1] * at)
        rows = [0] * at
        for cell, n in inside.groupBy(cuts._cell(F.col("x")).alias("c")).count().collect():
            rows[cell] = n
        for s, (start, _, _, cells) in segments.items():
            each, share, held = max(1, sum(rows[start:start + cells]) / tasks[s]), 0, 0
            for cell in range(start, start + cells):
                if held and held + rows[cell] > each:
                    share, held = share + 1, 0
                cuts.first[cell], held = share, held + rows[cell]
                if rows[cell] > 2 * each:
                    cuts.many[cell] = -int(-rows[cell] // each)
                    share, held = share + cuts.many[cell], 0
        return cuts

    def _cell(self, x: Column) -> Column:
        """Place of a value's cell among all cells, 0 outside large segments."""
        known = [F.struct(*map(F.lit, of)) for of in self.segments.values()]
        start, low, width, cells = (F.create_map(*[c for pair in zip(map(F.lit, self.segments), known) for c in pair])[F.col(PLACE)][f"col{i}"]
                                    for i in range(1, 5))
        at = F.greatest(F.least(F.floor((x - low) / width), cells - 1), F.lit(0))
        return F.coalesce(start + F.coalesce(at, F.lit(0)), F.lit(0)).cast("int")

    def _of_cell(self, values: list[int], other: int, column: str) -> Column:
        """The value of a link's cell; ``other`` outside large segments."""
        table = F.split(F.lit(",".join(map(str, values))), ",").cast("array<int>")
        inside = F.col(PLACE).isin(list(self.segments))
        return F.when(inside, F.get(table, self._cell(_number(column)))).otherwise(F.lit(other))

    def share(self, column: str) -> Column:
        """Number of the first share of a link's cell, inside its segment."""
        return self._of_cell(self.first, 0, column)

    def copies(self, column: str) -> Column:
        """Number of shares of a link's cell."""
        return self._of_cell(self.many, 1, column)

    def pick(self, column: str, hashed: Column) -> Column:
        """Which of its cell's shares a row goes to."""
        if max(self.many) == 1:
            return F.lit(0)
        return F.pmod(hashed, self.copies(column).cast("bigint")).cast("int")


def _provenance(store: Store, manifest: Manifest, table: Table, parts: list[Part], *columns: str) -> DataFrame:
    """Worker and batch of moved rows, with some of their columns."""
    live = store.schema(manifest, LIVE, table.name)
    return store.rows_of(T.StructType([*[live[c] for c in columns],
                                       T.StructField(WORKER, T.IntegerType()), T.StructField(BATCH, T.LongType())]), parts)


def _sized(keys: DataFrame, count: int) -> DataFrame:
    """Keys for joins: merged and not broadcast where there are many of them."""
    return keys.hint("merge") if count > BROADCAST_KEYS else keys


def _next_link(store: Store, manifest: Manifest, table: Table, moved: list[Part]) -> DataFrame:
    """Keys of moved rows, one row each, as the link for the table's dependents."""
    keys = _provenance(store, manifest, table, moved, table.key).withColumnRenamed(table.key, KEY)
    if table.unique:
        return keys
    return keys.groupBy(KEY).agg(F.min(F.struct(BATCH, WORKER)).alias("p")).select(KEY, f"p.{WORKER}", f"p.{BATCH}")


class _Records:
    """Roots and records per worker and batch of a run's chunks.

    Parts are counted once, for all chunks, when they are written. Of chunks with few batches many are
    taken from Spark at once.
    """

    def __init__(self, plan: _Plan):
        self.plan = plan
        self.counted: list[DataFrame] = []
        self.held: dict[int, list[tuple[int, int, int, int]]] = {}

    def add(self, store: Store, tree: Tree, fresh: dict[str, list[Part]]) -> None:
        """Count parts that a chunk wrote."""
        if any(fresh.values()):
            rows = _tree_records(store, tree, fresh)
            if self.plan.chunks > 1:
                rows = stage(rows, "counted")
                if sum(-(-n // self.plan.batch) for n in self.plan.counts.values()) > 4 * BATCHES_HELD:
                    # In order, so that a chunk reads few of them.
                    rows = stage(rows.repartitionByRange(BATCH).sortWithinPartitions(BATCH), "counted")
            self.counted.append(rows)
            self.held = {}

    def of(self, chunk: int) -> DataFrame | list[tuple[int, int, int, int]]:
        """A chunk's batches: worker, batch, roots, records."""
        if self.batches(chunk) > LEDGER_ROWS:
            return self._between(chunk, chunk + 1)
        if chunk not in self.held:
            end, n = chunk, 0
            while end < self.plan.chunks and (n := n + self.batches(end)) <= BATCHES_HELD:
                end += 1
            self.held = {c: [] for c in range(chunk, end)}
            for row in self._between(chunk, end).select(WORKER, BATCH, "roots", "records").collect():
                self.held[(row[1] - 1) // self.plan.size].append(tuple(row))
        return self.held.pop(chunk)

    def batches(self, chunk: int) -> int:
        return sum(-(-n // self.plan.batch) for n in self.plan.rows(chunk).values())

    def _between(self, chunk: int, end: int) -> DataFrame:
        size = self.plan.size
        own = [rows.where((F.col(BATCH) > chunk * size) & (F.col(BATCH) <= end * size)) for rows in self.counted]
        return own[0] if len(own) == 1 else _summed(own)


def _summed(counts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, counts).groupBy(WORKER, BATCH).agg(
        F.sum("roots").alias("roots"), F.sum("records").alias("records"))


def _tree_records(store: Store, tree: Tree, moved: dict[str, list[Part]]) -> DataFrame:
    """Roots and records per worker and batch, counted in the written archive parts."""
    counts = []
    for t in tree.tables:
        if moved.get(t.name):
            rows = store.rows_of(T.StructType([T.StructField(WORKER, T.IntegerType()), T.StructField(BATCH, T.LongType())]), moved[t.name])
            per = rows.groupBy(WORKER, BATCH).agg(F.count("*").alias("records"))
            counts.append(per.withColumn("roots", F.col("records") if t.parent is None else F.lit(0).cast("bigint")))
    return _summed(counts)


def _tree_ledger(records: DataFrame | list[tuple], roots: dict[int, int], size: int, spent: int) -> DataFrame | list[tuple]:
    """A chunk's batches, its time divided over those of each worker."""
    if isinstance(records, list):
        return [(*r, spent // max(-(-roots.get(r[0], 0) // size), 1)) for r in records]
    share = F.lit(0).cast("bigint")
    for worker, n in roots.items():
        share = F.when(F.col(WORKER) == worker, F.lit(spent // max(-(-n // size), 1))).otherwise(share)
    return records.select(F.col(WORKER).alias("worker"), F.col(BATCH).alias("batch_no"), "roots", "records",
                          share.cast("bigint").alias("duration_us"))


# -- single table ----------------------------------------------------------------


def _table_chunks(store: Store, tree: Tree, options: RunOptions, result: RunResult) -> Iterator[Chunk]:
    """The first chunk writes the touched rows apart for every group of chunks, the others only publish."""
    started = time.monotonic()
    table, manifest = tree.root, result.manifest
    candidates, layout = _candidate_parts(manifest, tree, options), layout_of(tree, table)
    rule = eligible_filter(tree, options)
    found = (store.read(manifest, LIVE, table.name, candidates).where(rule)
             .groupBy(segment_of(tree, table).alias("s"), worker_of(table.key, options.parallel).alias("w")).count().collect())
    counts: dict[int, int] = {}
    for _, worker, n in found:
        counts[worker] = counts.get(worker, 0) + n
    plan = _Plan(counts, options.batch_size, _chunk_size(options), options.max_batches)
    if not counts:
        return
    _check_columns(store, manifest, tree)

    hit = {s for s, _, _ in found}
    own = [p for p in candidates if p.segment is not None and p.layout == layout]
    loose = [p for p in candidates if p.segment is None or p.layout != layout]
    if len(loose) > 1:
        rows = store.read(manifest, LIVE, table.name, loose, with_file=FILE).where(rule)
        loose = files_of(rows, FILE, loose, store.locate)
    read = [p for p in own if p.segment in hit] + loose
    names = store.schema(manifest, LIVE, table.name).names
    split = _numbered_split(tree, table, names, store.read(manifest, LIVE, table.name, read), rule, options, plan)
    kept, shared = _kept_and_shared(*store.write_chunks(
        split, f"data/{table.name}/{result.run_id}", layout, table.key, chunk=_chunk_of(BATCH, plan.size)))
    twice = _archived_twice(store, manifest, table, [s.part for s in shared], [], plan.size, len({c for s in shared for c in s.counts}) > 1)
    book, size = _Book(), plan.size
    groups: dict[int, list[_Shared]] = {}
    for s in shared:
        groups.setdefault(min(s.counts) // plan.group, []).append(s)
    for chunk in range(plan.chunks):
        now = [s for s in groups.get(chunk // plan.group, []) if chunk in s.counts]
        moved = [p for s in now for p in s.of(chunk, size)]
        gone = read if chunk == 0 else moved
        stay = kept + [p for s in shared for p in s.waiting(1, size)] if chunk == 0 else []
        audit = _count_audit(table, _rows_in(gone), _rows_in(moved), _rows_in(stay))
        if options.audit_contents:
            _content_audit(store, result.manifest, table, gone, stay, moved)
        rows = plan.rows(chunk)
        if sum(rows.values()) != audit[2]:
            raise AuditError(f"{table.name}: {sum(rows.values())} rows chosen, {audit[2]} moved")
        _check_not_archived(table, twice, chunk)
        for s in now:
            s.archive(chunk, size)
        left = stay if chunk == 0 else [p for s in now for p in s.waiting(chunk + 1, size)]
        after = _swap(store, result.manifest, table, read if chunk == 0 else [], now, left, [p for s in now for p in s.archived])
        spent = int((time.monotonic() - started) * 1_000_000)
        ledger = _with_idle_workers(_table_ledger(store, rows, plan, chunk, spent), options, counts, chunk == 0)
        after = book.add(store, after, tree, result.run_id, chunk + 1, ledger)
        yield Chunk(after, min(plan.size, plan.batches - chunk * plan.size), rows, plan.left(chunk), [audit])
        started = time.monotonic()


def _numbered_split(
    tree: Tree, table: Table, names: list[str], rows: DataFrame, rule: Column, options: RunOptions, plan: _Plan
) -> DataFrame:
    """Eligible rows with their worker and batch, up to the cap; all others stay."""
    moves = F.coalesce(rule, F.lit(False))
    numbered = assign_batches(
        rows.where(rule), worker_of(table.key, options.parallel), table.key, options.batch_size,
        ties=[] if table.unique else [c for c in names if c != table.key], unique=table.unique, names=(TO_WORKER, TO_BATCH))
    if plan.cap:
        first = F.col(TO_BATCH) <= plan.cap
        numbered = numbered.withColumns({TO_WORKER: F.when(first, F.col(TO_WORKER)), TO_BATCH: F.when(first, F.col(TO_BATCH))})
    rest = rows.where(~moves).withColumns({TO_WORKER: F.lit(None).cast("int"), TO_BATCH: F.lit(None).cast("bigint")})
    return _sides(numbered.unionByName(rest), names, tree, table, plan.size * plan.group)


def _table_ledger(store: Store, rows: dict[int, int], plan: _Plan, chunk: int, spent: int) -> DataFrame | list[tuple]:
    """Batches of ``plan.batch`` rows per worker follow from the worker's row count."""
    workers = [(w, n, -(-n // plan.batch)) for w, n in sorted(rows.items()) if n]
    total = sum(b for _, _, b in workers)
    if total <= LEDGER_ROWS:
        sizes = [(w, b, min(plan.batch, n - b * plan.batch), of) for w, n, of in workers for b in range(of)]
        return [(w, b + 1 + chunk * plan.size, n, n, spent // of) for w, b, n, of in sizes]
    worker, left, first, count = (F.lit(None).cast(t) for t in ("int", "bigint", "bigint", "bigint"))
    at = 0
    for w, n, batches in workers:
        here = F.col("id") >= at
        worker, left, first, count = (F.when(here, F.lit(v).cast("bigint")).otherwise(o) for v, o in (
            (w, worker), (n, left), (at, first), (batches, count)))
        at += batches
    each = store.spark.range(total).select(worker.alias("worker"), left.alias("n"), (F.col("id") - first).alias("b"), count.alias("batches"))
    size = F.least(F.lit(plan.batch).cast("bigint"), F.col("n") - F.col("b") * plan.batch)
    return each.select("worker", (F.col("b") + 1 + chunk * plan.size).alias("batch_no"), size.alias("roots"), size.alias("records"),
                       (F.lit(spent) / F.col("batches")).cast("bigint").alias("duration_us"))


# -- dry run -----------------------------------------------------------------------


def dry_run(tree: Tree, root: DataFrame, options: RunOptions) -> DataFrame:
    """What a run would announce: per worker its digits, eligible rows and batches."""
    options = replace(options, as_of=options.resolved_as_of())
    keys = eligible_keys(tree, root, options)
    counts = keys.groupBy(worker_of(tree.root.key, options.parallel).alias("worker")).agg(
        F.count("*").alias("eligible"))
    plan = slice_plan(root.sparkSession, options.parallel)
    eligible = F.coalesce("eligible", F.lit(0)).cast("bigint")
    cutoff = F.lit(_cutoff(tree, options)) if tree.age_column else F.lit(None).cast("date")
    return plan.join(counts, "worker", "left").select(
        "worker", "lb", "up", cutoff.alias("cutoff"), eligible.alias("eligible"),
        F.ceil(eligible / options.batch_size).cast("bigint").alias("batches"),
        F.lit(options.time_limit_sec).cast("bigint").alias("time_limit_sec"))
