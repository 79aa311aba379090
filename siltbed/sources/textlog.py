"""Live reading of plain text logs: a stream of the lines that workers append to files.

The offset of the stream is the size of each file when a batch began, so files may grow
between batches and a restart goes on in the middle of a file. New bytes are dealt to tasks
in pieces. A line belongs to the piece that holds the newline at its end; the task looks
back for where the line begins. So no line is read twice or cut, and one that is still
being written waits for its newline.

Line numbers are given by the sink, which keeps how many lines each file had so far.
Files are opened with ``pyarrow.fs``, so the folder is a local path or a URI it knows.
A folder must hold uncompressed files that only grow; a file that shrank fails the stream,
one that is gone is forgotten. Names that start with ``_`` or ``.`` are left out.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.streaming import StreamingQuery

from siltbed.operators.batch import POSITION, number_rows
from siltbed.session import scratch_path

PIECE_BYTES = 64 * 1024 * 1024      # new bytes of a file that one task reads
BLOCK_BYTES = 4 * 1024 * 1024       # read at a time
LOOK_BACK = 64 * 1024
SCHEMA = "file string, piece bigint, start bigint, message string"
TOTALS = "file string, lines bigint"


@dataclass
class Share(InputPartition):
    """What one task reads: pieces ``(file, start, end)``, a large one or many small ones."""

    pieces: list[tuple[str, int, int]]


def shares(pieces: Iterator[tuple[str, int, int]], size: int) -> list[Share]:
    """Pieces in order, ``size`` bytes to a task."""
    out, room = [], 0
    for piece in pieces:
        bytes_ = piece[2] - piece[1]
        if bytes_ > room:
            out.append(Share([]))
            room = size
        out[-1].pieces.append(piece)
        room -= bytes_
    return out


def line_start(file, position: int) -> int:
    """Where the line that goes on at ``position`` begins."""
    while position > 0:
        back = min(LOOK_BACK, position)
        file.seek(position - back)
        newline = file.read(back).rfind(b"\n")
        if newline >= 0:
            return position - back + newline + 1
        position -= back
    return 0


def ended_lines(file, start: int, end: int) -> Iterator[tuple[np.ndarray, list[bytes]]]:
    """First bytes and texts of the lines whose newline lies in ``start`` to ``end``."""
    begin = line_start(file, start)
    file.seek(begin)
    at, rest = begin, []
    while at < end:
        block = file.read(min(BLOCK_BYTES, end - at))
        if not block:
            raise OSError(f"the file ended at {at}, before {end}")
        at += len(block)
        if b"\n" not in block:
            rest.append(block)
            continue
        lines = b"".join([*rest, block]).split(b"\n")
        rest = [lines.pop()]
        sizes = np.fromiter(map(len, lines), np.int64, len(lines)) + 1
        starts = begin + np.cumsum(sizes) - sizes
        begin += int(sizes.sum())
        yield starts, [text.removesuffix(b"\r") for text in lines]


class TextLogReader(DataSourceStreamReader):
    def __init__(self, options: dict):
        self.path, self.piece_bytes = options["path"], int(options.get("pieceBytes", PIECE_BYTES))

    def _files(self) -> dict[str, int]:
        system, base = fs.FileSystem.from_uri(self.path)
        found = system.get_file_info(fs.FileSelector(base, recursive=True, allow_not_found=True))
        below = {f.path[len(base):].lstrip("/"): f.size for f in found if f.type == fs.FileType.File}
        return {name: size for name, size in below.items() if not any(p[0] in "_." for p in name.split("/"))}

    def initialOffset(self) -> dict:
        return {"files": "{}"}

    def latestOffset(self) -> dict:
        return {"files": json.dumps(self._files(), sort_keys=True)}

    def partitions(self, start: dict, end: dict) -> list[Share]:
        before, now = json.loads(start["files"]), json.loads(end["files"])
        shrunk = [name for name, size in now.items() if size < before.get(name, 0)]
        if shrunk:
            raise ValueError(f"files that shrank: {', '.join(shrunk[:10])}")
        return shares(((name, a, min(a + self.piece_bytes, size)) for name, size in sorted(now.items())
                       for a in range(before.get(name, 0), size, self.piece_bytes)), self.piece_bytes)

    def read(self, share: Share) -> Iterator[pa.RecordBatch]:
        system, base = fs.FileSystem.from_uri(self.path)
        for name, begin, end in share.pieces:
            with system.open_input_file(f"{base}/{name}") as file:
                for starts, lines in ended_lines(file, begin, end):
                    n = len(lines)
                    yield pa.RecordBatch.from_arrays([
                        pa.array([name] * n, pa.string()), pa.array(np.full(n, begin, np.int64)), pa.array(starts),
                        pa.array([text.decode("utf-8", "replace") for text in lines], pa.string()),
                    ], names=["file", "piece", "start", "message"])


class TextLogSource(DataSource):
    """``file`` below the folder, ``piece`` it was read in, first byte ``start``, ``message``."""

    @classmethod
    def name(cls) -> str:
        return "siltbed_text_log"

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema) -> TextLogReader:
        return TextLogReader(self.options)


def read_text_stream(spark: SparkSession, path: str, piece_bytes: int = PIECE_BYTES) -> DataFrame:
    """Stream of the lines of all files below ``path``: ``file, piece, start, message``."""
    spark.dataSource.register(TextLogSource)
    return spark.readStream.format(TextLogSource.name()).option("pieceBytes", piece_bytes).load(path)


def start_text_log(lines: DataFrame, out: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Number the lines of each file and write them as Parquet; restartable from the checkpoint.

    A batch replaces what an earlier try of it wrote, and starts from the numbers of lines
    that the batch before it left, one row per file.
    """
    def write(batch: DataFrame, no: int) -> None:
        spark = batch.sparkSession
        path = scratch_path(spark, "textlog")
        batch.withColumn(POSITION, F.monotonically_increasing_id()).write.parquet(path)
        staged = spark.read.parquet(path)
        before = spark.read.schema(TOTALS).parquet(f"{out}/totals/batch={no - 1}") if no else spark.createDataFrame([], TOTALS)
        numbered = number_rows(staged, ["file"], "n", run=["piece"])
        numbered.join(before, "file", "left").select(
            "file", (F.coalesce("lines", F.lit(0)) + F.col("n")).alias("line_no"), "start", "message"
        ).write.mode("overwrite").parquet(f"{out}/lines/batch={no}")
        added = staged.groupBy("file").agg(F.count("*").alias("lines"))
        before.unionByName(added).groupBy("file").agg(F.sum("lines").alias("lines")).write.mode(
            "overwrite").parquet(f"{out}/totals/batch={no}")

    writer = lines.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def folder_value(file: Column | str, name: str) -> Column:
    """The value of a ``name=value`` folder in a file's path."""
    return F.regexp_extract(file, f"(?:^|/){name}=([^/]*)/", 1)


def read_text_lines(spark: SparkSession, out: str) -> DataFrame:
    """Lines so far: ``run_id, worker, line_no, message`` from the folders the files lie in.

    A worker whose log lies in several files has their lines one after the other, by name.
    """
    lines = spark.read.schema("file string, line_no bigint, start bigint, message string").parquet(f"{out}/lines")
    named = [folder_value("file", "run_id").alias("run_id"), folder_value("file", "worker").cast("int").alias("worker")]
    files = lines.groupBy("file").agg(F.max("line_no").alias("n")).select("file", "n", *named)
    earlier = Window.partitionBy("run_id", "worker").orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    ahead = files.select("file", "run_id", "worker", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("ahead"))
    return lines.join(ahead, "file").select("run_id", "worker", (F.col("line_no") + F.col("ahead")).alias("line_no"), "message")
