"""Live and archive tables as versioned directories under one manifest.

A run writes new directories and then one manifest version naming every current
directory of every table. Readers follow the manifest, so all tables of a run
change at once or not at all; a version counts once its ``_SUCCESS`` marker is
there. Parts the run did not touch are carried over by name and never rewritten.
"""

from __future__ import annotations

import datetime as dt
import gzip
import json
import os
import re
import time
import uuid
from collections.abc import Iterable
from dataclasses import dataclass, field, replace
from functools import reduce
from urllib.parse import unquote

import pyarrow as pa
import pyarrow.parquet as pq
from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from siltbed.functions.scalars import is_instant
from siltbed.session import advisory_bytes, listed_by_cores
from siltbed.spec import Table, Tree

SEGMENT = "sb_seg"
SIDE = "sb_side"
WORKER = "arch_worker"
BATCH = "arch_batch"
LIVE, ARCHIVE, LEDGER = "live", "archive", "ledger"
# Columns the engine adds to rows start with this, or are named above; a table
# with a column of such a name is refused.
OWN = "sb__"
HIVE = "hive"
CLAIM_SEC = 600


@dataclass(frozen=True)
class Part:
    """One directory of one segment. ``segment`` is None where none was assigned.

    ``layout`` says how the segment label follows from a row; a label means nothing
    to a table of another layout. ``ranges`` are the least and greatest whole numbers
    of some columns, (name, low, high) each, the column the files are sorted by first.
    An adopted directory with partition columns in its paths has the layout ``HIVE``.

    ``batches`` (after, upto), where one is given, says that only rows of batches above the
    first and up to the second (None: no bound) belong to the part: chunks of few rows share
    directories, and each archives its batches of them. ``rows`` counts those alone.
    """

    path: str
    segment: str | None
    rows: int
    layout: str | None = None
    ranges: tuple[tuple[str, int, int], ...] = ()
    batches: tuple[int, int | None] | None = None

    def range_of(self, column: str) -> tuple[int, int] | None:
        return next(((low, high) for name, low, high in self.ranges if name == column), None)


@dataclass(frozen=True)
class Manifest:
    version: int
    parts: dict[str, tuple[Part, ...]] = field(default_factory=dict)
    schemas: dict[str, str] = field(default_factory=dict)

    def of(self, side: str, table: str) -> tuple[Part, ...]:
        return self.parts.get(f"{side}/{table}", ())

    def rows(self, side: str, table: str) -> int:
        return sum(p.rows for p in self.of(side, table))

    def names(self, side: str) -> list[str]:
        return sorted(k.split("/", 1)[1] for k in self.schemas if k.startswith(side + "/"))

    def with_table(self, side: str, table: str, parts: Iterable[Part], schema: str | None = None) -> Manifest:
        key = f"{side}/{table}"
        schemas = dict(self.schemas)
        if schema is not None:
            schemas[key] = schema
        return replace(self, parts={**self.parts, key: tuple(parts)}, schemas=schemas)

    def to_json(self) -> str:
        return json.dumps({
            "parts": {k: [[p.path, p.segment, p.rows, p.layout, p.ranges, p.batches] for p in v] for k, v in self.parts.items()},
            "schemas": self.schemas,
        })

    @staticmethod
    def from_json(version: int, text: str) -> Manifest:
        raw = json.loads(text)
        parts = {k: tuple(Part(*p[:4], tuple(map(tuple, p[4] if len(p) > 4 else ())), tuple(p[5]) if p[5:] and p[5] else None)
                          for p in v) for k, v in raw["parts"].items()}
        return Manifest(version, parts, raw["schemas"])


class StaleVersion(RuntimeError):
    """Another run published after this one took its snapshot."""


class Store:
    def __init__(self, spark: SparkSession, root: str, target_bytes: int = 128 * 1024 * 1024):
        """``target_bytes`` is the shuffle size of one written file."""
        self.spark = spark
        self.root = root.rstrip("/")
        self.target_bytes = target_bytes
        self.outcomes_path = f"{self.root}/outcomes"
        # Looked up once: every step of a class name is a call to the JVM.
        self._path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self._hadoop = spark.sparkContext._jsc.hadoopConfiguration()

    # -- manifest -----------------------------------------------------------

    def _fs(self, path: str):
        """Hadoop file system and path object; for listing, deleting and the driver's few small files."""
        p = self._path(path)
        return p.getFileSystem(self._hadoop), p

    def has(self, path: str) -> bool:
        fs, p = self._fs(path)
        return fs.exists(p)

    def _dirs(self, path: str) -> list[str]:
        fs, p = self._fs(f"{self.root}/{path}")
        return [s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()] if fs.exists(p) else []

    def _versions(self) -> list[int]:
        """Version numbers present, newest first; some may be incomplete."""
        return sorted((int(n[2:]) for n in self._dirs("_manifest") if n.startswith("v=")), reverse=True)

    def _complete(self, version: int) -> bool:
        fs, p = self._fs(f"{self._version_path(version)}/_SUCCESS")
        return fs.exists(p)

    def _current(self) -> int:
        return next((v for v in self._versions() if self._complete(v)), 0)

    def _version_path(self, version: int) -> str:
        return f"{self.root}/_manifest/v={version}"

    def snapshot(self) -> Manifest:
        """The newest complete manifest, or an empty one."""
        current = self._current()
        return self.manifest(current) if current else Manifest(0)

    def manifest(self, version: int) -> Manifest:
        text = self.spark.read.text(self._version_path(version), wholetext=True).first()[0]
        return Manifest.from_json(version, text)

    def publish(self, manifest: Manifest) -> Manifest:
        """Make ``manifest`` current, if nothing was published since it was read.

        A version has one successor: who creates its claim file may write it. The
        claim of a publisher that died is void after ``CLAIM_SEC`` seconds.
        """
        base = manifest.version
        if not self._claim(base):
            raise StaleVersion(f"read version {base}, which has a successor")
        try:
            new = replace(manifest, version=self._next(base))
            self._write_version(new)
            return new
        except Exception:
            self._delete(self._claim_path(base))
            raise

    def _next(self, base: int) -> int:
        """The number after ``base``, past versions that were not finished; fail if one was.

        Versions are dropped oldest first, so while ``base`` is there all newer ones are, and
        a run of many chunks needn't list them for each.
        """
        if base == 0 or not self._complete(base):
            current = self._current()
            if current != base:
                raise StaleVersion(f"read version {base}, current is {current}")
        version = base + 1
        while self.has(self._version_path(version)):
            if self._complete(version):
                raise StaleVersion(f"read version {base}, {version} was published since")
            version += 1
        return version

    def _write_version(self, manifest: Manifest) -> None:
        """One file, packed: paths repeat much, and a run of many chunks writes many versions."""
        path = self._version_path(manifest.version)
        for name, data in (("part-00000.txt.gz", gzip.compress(manifest.to_json().encode(), 5)), ("_SUCCESS", b"")):
            self._create(f"{path}/{name}", data)

    def _create(self, path: str, data: bytes) -> None:
        """A new file with a few bytes from the driver."""
        fs, p = self._fs(path)
        if fs.getUri().getScheme() == "file":
            # Hadoop's local file system looks first and creates then, and may start processes to set the rights of a file.
            local = p.toUri().getPath()
            os.makedirs(os.path.dirname(local), exist_ok=True)
            with open(local, "xb") as file:
                file.write(data)
            return
        out = fs.create(p, False)
        try:
            out.write(data)
        finally:
            out.close()

    def write_few(self, path: str, schema: T.StructType, rows: list[tuple]) -> None:
        """A new Parquet file below ``path`` with a few rows from the driver, which takes no Spark job.

        Readers of the directory see it once it is whole.
        """
        fields = to_arrow_schema(schema)
        columns = [pa.array(values, f.type) for values, f in zip(zip(*rows), fields)] if rows else [pa.array([], f.type) for f in fields]
        data = pa.BufferOutputStream()
        pq.write_table(pa.Table.from_arrays(columns, schema=fields), data)
        name = f"part-{uuid.uuid4().hex}.parquet"
        self._create(f"{path}/_{name}", data.getvalue().to_pybytes())
        fs, hidden = self._fs(f"{path}/_{name}")
        if not fs.rename(hidden, self._fs(f"{path}/{name}")[1]):
            raise RuntimeError(f"{path}/{name} could not be written")

    def _claim_path(self, base: int) -> str:
        return f"_manifest/after-{base}"

    def _claim(self, base: int) -> bool:
        """Create the claim file, which only one of several publishers can."""
        fs, path = self._fs(f"{self.root}/{self._claim_path(base)}")
        if fs.exists(path):
            age = time.time() - fs.getFileStatus(path).getModificationTime() / 1000
            if age < CLAIM_SEC or self._current() != base:
                return False
            fs.delete(path, False)
        try:
            self._create(f"{self.root}/{self._claim_path(base)}", b"")
        except FileExistsError:
            return False
        except Py4JJavaError as refused:
            if "AlreadyExists" in str(refused.java_exception):
                return False
            raise
        return True

    def _delete(self, path: str) -> None:
        fs, p = self._fs(f"{self.root}/{path}")
        fs.delete(p, True)

    # -- tables -------------------------------------------------------------

    def adopt(self, tables: dict[str, str]) -> Manifest:
        """Register existing Parquet directories as live tables, without copying.

        Every file becomes a part of its own that stays where it is until a run
        moves rows out of it; only then are its other rows written to segments. A
        directory with partition columns in its paths is one part as a whole.
        """
        m = self.snapshot()
        for name, path in tables.items():
            if m.of(LIVE, name):
                raise ValueError(f"{name} is already a live table")
            parts, schema = self._files(path)
            m = m.with_table(LIVE, name, parts, schema.json())
        return self.publish(m)

    def extend(self, table: str, path: str) -> Manifest:
        """Register more files of a live table, such as a day's new rows."""
        m = self.snapshot()
        parts, schema = self._files(path)
        wanted = T.StructType.fromJson(json.loads(m.schemas[f"{LIVE}/{table}"]))
        if {(f.name, f.dataType) for f in schema} != {(f.name, f.dataType) for f in wanted}:
            raise ValueError(f"{table}: the new files have other columns")
        known = {p.path for p in m.of(LIVE, table)}
        if any(p.path in known for p in parts):
            raise ValueError(f"{table}: a file is registered already")
        return self.publish(m.with_table(LIVE, table, [*m.of(LIVE, table), *parts]))

    def _files(self, path: str) -> tuple[list[Part], T.StructType]:
        """One part per file with its row count, from the footers."""
        df = self.spark.read.parquet(path)
        _refuse_own(df.schema)
        rows = df.groupBy("_metadata.file_path").count().collect()
        parts = [Part(_plain_path(file), None, n) for file, n in rows]
        if any("=" in p.path.rsplit(path.rstrip("/"), 1)[-1] for p in parts):
            parts = [Part(path, None, sum(p.rows for p in parts), HIVE)]
        return parts, df.schema

    def schema(self, manifest: Manifest, side: str, table: str) -> T.StructType:
        if f"{side}/{table}" not in manifest.schemas:
            raise ValueError(f"the store has no {side} table {table}")
        return T.StructType.fromJson(json.loads(manifest.schemas[f"{side}/{table}"]))

    def read(self, manifest: Manifest, side: str, table: str, parts: Iterable[Part] | None = None,
             with_file: str | None = None) -> DataFrame:
        """Rows of the given parts (default: all) with the table's own columns.

        ``with_file`` names a column to add: the file a row comes from.
        """
        schema = self.schema(manifest, side, table)
        chosen = list(manifest.of(side, table) if parts is None else parts)
        file = [F.col("_metadata.file_path").alias(with_file)] if with_file else []
        frames = self._frames(schema, [p for p in chosen if p.layout != HIVE], file)
        # Partition columns are read from the paths below each directory of its own.
        frames += [self.spark.read.schema(schema).option("basePath", self.locate(p)).parquet(self.locate(p))
                   .select(*schema.names, *file) for p in chosen if p.layout == HIVE]
        if not frames:
            empty = self.spark.createDataFrame([], schema)
            return empty.withColumn(with_file, F.lit(None).cast("string")) if with_file else empty
        return reduce(DataFrame.unionByName, frames)

    def rows_of(self, schema: T.StructType, parts: list[Part], *more: Column) -> DataFrame:
        """Columns of the files of parts that a run has written, by name, and ``more`` of them."""
        frames = self._frames(schema, parts, list(more))
        return reduce(DataFrame.unionByName, frames) if frames else self.spark.createDataFrame([], schema)

    def _frames(self, schema: T.StructType, parts: list[Part], more: list[Column]) -> list[DataFrame]:
        """Rows of plain directories; one frame for all those of which the same batches count."""
        frames = []
        for batches, paths in by_batches(parts).items():
            typed = schema if not batches or BATCH in schema.names else T.StructType([*schema, T.StructField(BATCH, T.LongType())])
            with listed_by_cores(self.spark):
                rows = self.spark.read.schema(typed).parquet(*[self.locate(p) for p in paths])
            if batches:
                own = [(F.col(BATCH) > after) & (F.lit(True) if upto is None else F.col(BATCH) <= upto) for after, upto in batches]
                rows = rows.where(reduce(Column.__or__, own))
            frames.append(rows.select(*[_quoted(c) for c in schema.names], *more))
        return frames

    def locate(self, part: Part) -> str:
        """Part paths are relative to the store, those of adopted data are absolute."""
        return part.path if part.path.startswith("/") or ":/" in part.path else f"{self.root}/{part.path}"

    def live(self, table: str) -> DataFrame:
        return self.read(self.snapshot(), LIVE, table)

    def archive(self, table: str) -> DataFrame:
        return self.read(self.snapshot(), ARCHIVE, table)

    def declare_archive(self, table: str, schema: T.StructType) -> Manifest:
        """Give an archive table its own column order or extra columns.

        Moved rows are matched to it by name; columns only the archive has stay NULL.
        """
        _refuse_own(schema)
        m = self.snapshot()
        return self.publish(m.with_table(ARCHIVE, table, m.of(ARCHIVE, table), schema.json()))

    def ledger(self) -> DataFrame:
        """Batches of all published runs."""
        return self.read(self.snapshot(), LEDGER, "batches")

    # -- writing segments -----------------------------------------------------

    def write_sides(self, rows: DataFrame, label: str, layout: str | None, *columns: str, placed: bool = False) -> dict[str, list[Part]]:
        """Write rows that carry SIDE and SEGMENT; return the parts of each side.

        Rebalancing gives each segment few files of even size and lets AQE split a
        segment that holds much of the data; the caller sets the size aimed at
        (``advisory_bytes``). Rows that are ``placed`` lie by segment already. Files are sorted by the first of ``columns``; the
        ranges of all of them go to the manifest, where they are whole numbers.
        """
        return self.write_chunks(rows, label, layout, *columns, placed=placed)[0]

    def write_chunks(self, rows: DataFrame, label: str, layout: str | None, *columns: str, placed: bool = False,
                     chunk: Column | None = None, rows_per_file: int = 0) -> tuple[dict[str, list[Part]], dict[str, dict[int, int]]]:
        """As ``write_sides``; also the rows of each ``chunk`` (NULL: none) in the parts, by path.

        A task writes several files for a segment where it has more than ``rows_per_file`` rows of it (0: one).
        """
        path = f"{self.root}/{label}"
        ((rows if placed else rows.hint("rebalance", SIDE, SEGMENT))
             .sortWithinPartitions(SIDE, SEGMENT, columns[0])
             .write.partitionBy(SIDE, SEGMENT).option("maxRecordsPerFile", rows_per_file).parquet(path))
        return self._written_parts(path, label, rows.schema, layout, list(dict.fromkeys(columns)), chunk)

    def compact(self, side: str, table: str) -> Manifest:
        """Merge the parts of every segment that has several, or batches of shared directories; publish the result.

        The row counts on disk must be the same before and after.
        """
        m = self.snapshot()
        by_segment: dict[tuple[str | None, str], list[Part]] = {}
        for p in m.of(side, table):
            if p.segment is not None:
                by_segment.setdefault((p.layout, p.segment), []).append(p)
        merged, chosen = [], []
        for layout in sorted({key[0] for key in by_segment}, key=str):
            several = [p for key, parts in by_segment.items() if key[0] == layout and (len(parts) > 1 or parts[0].batches)
                       for p in parts]
            if several:
                merged += self._merge(m, side, table, layout, several)
                chosen += several
        if not chosen:
            return m
        if sum(p.rows for p in merged) != sum(p.rows for p in chosen):
            raise RuntimeError(f"{table}: compaction changed the number of rows")
        gone = {p.path for p in chosen}
        return self.publish(m.with_table(side, table, [p for p in m.of(side, table) if p.path not in gone] + merged))

    def compact_ledger(self) -> Manifest:
        """Merge the ledger's parts, one per chunk of each run, into evenly sized files."""
        m = self.snapshot()
        parts = m.of(LEDGER, "batches")
        if len(parts) < 2:
            return m
        path = f"ledger/compact-{uuid.uuid4().hex}"
        rows = self.read(m, LEDGER, "batches", parts)
        with advisory_bytes(self.spark, self.target_bytes):
            rows.hint("rebalance").sortWithinPartitions("run_id", "worker", "batch_no").write.parquet(f"{self.root}/{path}")
        merged = Part(path, None, self.spark.read.parquet(f"{self.root}/{path}").count())
        if merged.rows != rows.count():
            raise RuntimeError("compaction changed the ledger")
        return self.publish(m.with_table(LEDGER, "batches", [merged]))

    def _merge(self, m: Manifest, side: str, table: str, layout: str | None, parts: list[Part]) -> list[Part]:
        """Parts of one layout written anew, a segment once, in the order they had."""
        schema = self.schema(m, side, table)
        columns = [name for name, _, _ in parts[0].ranges] or [schema.names[0]]
        if side == ARCHIVE:
            schema = T.StructType([*schema, T.StructField(WORKER, T.IntegerType()), T.StructField(BATCH, T.LongType())])
        label = F.regexp_extract(F.col("_metadata.file_path"), f"{SEGMENT}=([^/]*)", 1)
        rows = self.rows_of(schema, parts, F.lit(side).alias(SIDE), label.alias(SEGMENT))
        with advisory_bytes(self.spark, self.target_bytes):
            return self.write_sides(rows, f"data/{table}/compact-{uuid.uuid4().hex}", layout, *columns)[side]

    def expire(self, keep_versions: int = 2) -> list[str]:
        """Reclaim space: drop old manifests and the directories none of the kept ones names.

        Do not run it beside a job: what a running job has written is not named yet.
        Adopted data outside the store is never deleted.
        """
        versions = [v for v in self._versions() if self._complete(v)]
        named = {p.path for v in versions[:keep_versions] for parts in self.manifest(v).parts.values() for p in parts}

        def below(paths: list[str]) -> list[str]:
            return [f"{path}/{name}" for path in paths for name in self._dirs(path)]

        stale = [p for p in below(below(below(below(["data"])))) + below(["ledger"]) if p not in named]
        stale += [f"_manifest/v={v}" for v in versions[keep_versions:]]
        for path in stale:
            self._delete(path)
        for version in versions[keep_versions:]:
            self._delete(self._claim_path(version))
        return stale

    def _written_parts(self, path: str, label: str, schema: T.StructType, layout: str | None, columns: list[str],
                       chunk: Column | None = None) -> tuple[dict[str, list[Part]], dict[str, dict[int, int]]]:
        plain = T.StructType([f for f in schema if f.name not in (SIDE, SEGMENT)])
        typed = T.StructType([*plain, T.StructField(SIDE, T.StringType()), T.StructField(SEGMENT, T.StringType())])
        whole = [c for c in columns if c in schema.names and isinstance(schema[c].dataType, T.IntegralType)]
        bounds = [f(_quoted(c)).cast("bigint").alias(f"{OWN}{f.__name__}{i}") for i, c in enumerate(whole) for f in (F.min, F.max)]
        with listed_by_cores(self.spark):
            rows = self.spark.read.schema(typed).parquet(path)
        of = (F.lit(None) if chunk is None else chunk).cast("bigint").alias(f"{OWN}chunk")
        sides: dict[str, dict[str, Part]] = {}
        counts: dict[str, dict[int, int]] = {}
        for side, segment, c, n, *ends in rows.groupBy(SIDE, SEGMENT, of).agg(F.count("*").alias(OWN), *bounds).collect():
            ranges = tuple((name, ends[2 * i], ends[2 * i + 1]) for i, name in enumerate(whole) if ends[2 * i] is not None)
            part = Part(f"{label}/{SIDE}={side}/{SEGMENT}={segment}", segment, n, layout, ranges)
            parts = sides.setdefault(side, {})
            parts[part.path] = _joined(parts[part.path], part) if part.path in parts else part
            if c is not None:
                counts.setdefault(part.path, {})[c] = n
        return {side: list(parts.values()) for side, parts in sides.items()}, counts


def _joined(a: Part, b: Part) -> Part:
    """One part for two with rows of the same directory."""
    ends = {name: (low, high) for name, low, high in a.ranges}
    for name, low, high in b.ranges:
        ends[name] = min(low, ends.get(name, (low, high))[0]), max(high, ends.get(name, (low, high))[1])
    return replace(a, rows=a.rows + b.rows, ranges=tuple((name, *of) for name, of in ends.items()))


def by_batches(parts: Iterable[Part]) -> dict[tuple[tuple[int, int | None], ...], list[Part]]:
    """A part per directory, by the batches that count of it; none stands for all.

    Parts of one directory are read together, stretches of batches that meet as one.
    """
    of: dict[str, list[Part]] = {}
    for p in parts:
        of.setdefault(p.path, []).append(p)
    groups: dict[tuple[tuple[int, int | None], ...], list[Part]] = {}
    for own in of.values():
        stretches: list[tuple[int, int | None]] = []
        for after, upto in sorted((p.batches for p in own if p.batches), key=lambda b: b[0]):
            if stretches and stretches[-1][1] == after:
                stretches[-1] = stretches[-1][0], upto
            else:
                stretches.append((after, upto))
        groups.setdefault(() if any(p.batches is None for p in own) else tuple(stretches), []).append(own[0])
    return groups


def _quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def _refuse_own(schema: T.StructType) -> None:
    """Fail on column names that the engine uses in its own files."""
    taken = [c for c in schema.names if c.lower().startswith(OWN) or c.lower() in (SEGMENT, SIDE, WORKER, BATCH)]
    if taken:
        raise ValueError(f"reserved column names: {', '.join(taken)}")


def layout_of(tree: Tree, table: Table) -> str:
    """How ``segment_of`` derives labels; equal texts mean equal labels."""
    if table.parent is None and tree.age_column:
        return f"months:{tree.age_column}:{tree.segment_months}"
    return f"range:{table.key if table.parent is None else table.link}:{table.span}"


def segment_of(tree: Tree, table: Table) -> Column:
    """Segment label of a row: the months of its age, or the range of its link."""
    if table.parent is None and tree.age_column:
        return month_label(F.col(tree.age_column), tree.segment_months)
    return range_label(F.col(table.key if table.parent is None else table.link), table.span)


def month_index(day: dt.date, months: int) -> int:
    return (day.year * 12 + day.month - 1) // months


def month_label(age: Column, months: int) -> Column:
    """Months since year 0 in steps; of an instant, the month in UTC whatever the session's zone."""
    days = F.floor(F.unix_micros(age.cast("timestamp")) / 86_400_000_000).cast("int")
    day = F.when(is_instant(age), F.date_from_unix_date(days)).otherwise(age.cast("date"))
    month = F.year(day) * 12 + F.month(day) - 1
    return range_label(F.floor(month / months), 1)


def range_label(key: Column, span: int) -> Column:
    whole = (key - key % span) / span
    return F.coalesce(whole.cast("bigint").cast("string"), F.lit("none"))


def files_of(rows: DataFrame, file: str, parts: list[Part], locate=None) -> list[Part]:
    """Those of the parts, files or directories, that any of the rows comes from."""
    seen = {_bare(_plain_path(r[0])) for r in rows.select(file).distinct().collect()}
    folders = {f.rsplit("/", n)[0] for f in seen for n in range(1, f.count("/") + 1)}
    place = locate or (lambda p: p.path)
    return [p for p in parts if _bare(place(p)) in seen or _bare(place(p)) in folders]


def first_of(rows: DataFrame, parts: list[Part], locate) -> dict[str, int]:
    """The least number of each part, by path, from ``rows`` of a file and a number each; parts without one are left out."""
    least: dict[str, int] = {}
    for file, n in rows.collect():
        steps = _bare(_plain_path(file)).split("/")
        for i in range(2, len(steps) + 1):
            above = "/".join(steps[:i])
            least[above] = min(n, least.get(above, n))
    return {p.path: least[at] for p in parts if (at := _bare(locate(p))) in least}


def _bare(path: str) -> str:
    """A path without its scheme and host, which readers write in several ways."""
    return re.sub(r"/+", "/", re.sub(r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "", path)).rstrip("/")


def _plain_path(uri: str) -> str:
    """The path as readers take it, from the escaped form in file metadata."""
    return unquote(uri)
