"""Chat formatting: turns of conversations as one marked text, with a loss mask.

A turn reads ``### role: text</turn>`` and a line feed. Texts and roles are escaped so
that neither marker occurs in them: a backslash goes before a backslash, before the
third and each later of consecutive ``#``, and before the slash of ``</turn>`` (in a
role also before a colon). Dropping each backslash and taking the next character as it
is gives them back.

Tasks work on the columns of a batch: lengths of all segments, cumulative offsets and
the target of every byte are numpy arrays, and headers, contents and ends are scattered
into one Arrow buffer allocated at its full size.

Rows are dealt by ranges of (conversation, turn), so a conversation of any size is
spread over tasks; its formatted text comes in pieces, whose order (part, piece) gives.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltbed.llm.common import quoted, utf8

HEAD, MID, END = b"### ", b": ", b"</turn>\n"
MARKER = b"</turn>"
PIECE = 8_000_000       # bytes of text after which a conversation is cut
SLICE = 4_000_000       # bytes of text that are assembled together
SCHEMA = ("conv_id long, part int, piece long, whole boolean, n_turns long, formatted string, "
          "loss array<struct<start: long, end: long>>")
_OUT = pa.schema([("conv_id", pa.int64()), ("part", pa.int32()), ("piece", pa.int64()), ("whole", pa.bool_()),
                  ("n_turns", pa.int64()), ("formatted", pa.string()),
                  ("loss", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))])


def _escaped_places(data: np.ndarray, row: np.ndarray) -> np.ndarray:
    """Which bytes get a backslash before them; ``row`` is the text of each byte."""
    found = data == ord("\\")
    if len(data) > 2:
        found[2:] |= (data[2:] == ord("#")) & (data[1:-1] == ord("#")) & (data[:-2] == ord("#")) & (row[2:] == row[:-2])
    last = len(MARKER) - 1
    if len(data) > last:
        match = row[:-last] == row[last:]
        for i, b in enumerate(MARKER):
            match &= data[i:len(data) - last + i] == b
        found[1:len(data) - last + 1] |= match
    return found


@lru_cache(4096)
def header(role: bytes) -> bytes:
    data = np.frombuffer(role, np.uint8)
    places = np.flatnonzero(_escaped_places(data, np.zeros(len(data), np.int8)) | (data == ord(":")))
    return HEAD + np.insert(data, places, ord("\\")).tobytes() + MID


def _bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a binary column, and each value's number of them."""
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    values = column.buffers()[2]
    data = np.frombuffer(values, np.uint8)[offsets[0]:offsets[-1]] if values is not None else np.zeros(0, np.uint8)
    return data, np.diff(offsets)


def assemble(roles: list[bytes], texts: pa.Array, starts: np.ndarray, loss_role: bytes) -> tuple[pa.Array, pa.Array]:
    """The formatted pieces that begin at the rows ``starts``, and their loss spans
    (in code points of the piece): the escaped texts of rows of ``loss_role``."""
    data, size = _bytes_of(texts)
    row = np.repeat(np.arange(len(size), dtype=np.int32), size)
    escaped = _escaped_places(data, row)
    kinds, kind = np.unique(np.array(roles, object), return_inverse=True) if roles else (np.array([], object), np.zeros(0, int))
    heads = [np.frombuffer(header(r), np.uint8) for r in kinds]
    head = np.array([len(h) for h in heads], np.int64)[kind] if len(heads) else np.zeros(0, np.int64)
    content = size + np.bincount(row[escaped], minlength=len(size))
    length = head + content + len(END)
    begin = np.cumsum(length) - length

    buffer = pa.allocate_buffer(int(length.sum()))
    out = np.frombuffer(buffer, np.uint8)
    # Each byte goes as far right as its text's begin and the backslashes up to it say.
    added = np.cumsum(escaped)
    first = np.cumsum(size) - size
    before = np.r_[0, added][first]
    target = np.repeat(begin + head - first - before, size) + np.arange(len(data)) + added
    out[target] = data
    out[target[escaped] - 1] = ord("\\")
    for k, h in enumerate(heads):
        out[(begin[kind == k][:, None] + np.arange(len(h))).ravel()] = np.tile(h, int((kind == k).sum()))
    out[((begin + head + content)[:, None] + np.arange(len(END))).ravel()] = np.tile(np.frombuffer(END, np.uint8), len(size))

    points = np.r_[0, np.cumsum((out & 0xC0) != 0x80)]
    of_piece = np.searchsorted(starts, np.arange(len(size)), "right") - 1
    lossy = np.flatnonzero(np.array([r == loss_role for r in roles], bool))
    base = points[begin[starts]][of_piece[lossy]]
    spans = pa.StructArray.from_arrays([pa.array(points[(begin + head)[lossy]] - base),
                                        pa.array(points[(begin + head + content)[lossy]] - base)], ["start", "end"])
    edges = np.r_[0, np.cumsum(np.bincount(of_piece[lossy], minlength=len(starts)))].astype(np.int32)
    offsets = np.r_[begin[starts], len(out)].astype(np.int32)
    pieces = pa.Array.from_buffers(pa.string(), len(starts), [None, pa.py_buffer(offsets.tobytes()), buffer])
    return pieces, pa.ListArray.from_arrays(pa.array(edges), spans)


class _Former:
    """Pieces of the rows of one task, which come sorted."""

    def __init__(self, part: int, loss_role: bytes):
        self.part, self.loss_role, self.piece = part, loss_role, 0
        self.begun = False      # the first conversation may have begun in an earlier task

    def out(self, rows: pa.Table, ends: bool) -> pa.RecordBatch:
        """Format whole pieces; ``ends`` says that the last row's conversation ends with it."""
        conv, role = rows["conv"].to_numpy(), rows["role"].to_pylist()
        missing = rows["missing"].to_numpy()
        new = np.flatnonzero(np.r_[True, (conv[1:] != conv[:-1]) | (missing[1:] != missing[:-1])])
        formatted, loss = assemble(role, rows["text"].combine_chunks(), new, self.loss_role)
        whole = np.ones(len(new), bool)
        whole[0], whole[-1] = self.begun and whole[0], ends and whole[-1]
        if len(new) == 1:
            whole[0] = self.begun and ends
        # The next piece begins a conversation if this one ended.
        self.begun = ends
        place = np.arange(self.piece, self.piece + len(new))
        self.piece += len(new)
        turns = np.diff(np.r_[new, len(conv)])
        return pa.RecordBatch.from_arrays(
            [pa.array(conv[new], mask=missing[new]), pa.array(np.full(len(new), self.part, np.int32)), pa.array(place), pa.array(whole),
             pa.array(turns.astype(np.int64)), formatted, loss], schema=_OUT)

    def run(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            rows = table if held is None else pa.concat_tables([held, table]).combine_chunks()
            held = None
            for part, ends in self._cut(rows):
                if ends is None:
                    held = part
                else:
                    yield self.out(part, ends)
        if held is not None:
            # What comes after may be in the next task.
            yield self.out(held, False)

    def _cut(self, rows: pa.Table) -> Iterator[tuple[pa.Table, bool | None]]:
        """Slices of rows: up to the end of a conversation, or inside one that is long.
        The last conversation is held back (None) unless it is long."""
        conv, missing = rows["conv"].to_numpy(), rows["missing"].to_numpy()
        size = np.cumsum(_bytes_of(rows["text"].combine_chunks())[1])
        ends = np.flatnonzero((conv[1:] != conv[:-1]) | (missing[1:] != missing[:-1])) + 1
        at, n = 0, len(conv)
        while at < n:
            done = size[at - 1] if at else 0
            # The most whole conversations of a slice, the first one in any case unless long.
            fit = ends[(ends > at) & (size[ends - 1] - done <= SLICE)]
            following = ends[ends > at]
            stop = int(fit[-1]) if len(fit) else int(following[0]) if len(following) else None
            last = stop if stop is not None else n
            if size[last - 1] - done > PIECE:
                long = int(np.searchsorted(size, done + PIECE)) + 1
                if long < last or stop is None:
                    last = max(at + 1, min(long, last))
                    yield rows.slice(at, last - at), False
                    at = last
                    continue
            if stop is None:
                yield rows.slice(at), None
                return
            yield rows.slice(at, stop - at), True
            at = stop


def formatted(conversations: DataFrame, *, loss_role: str = "assistant", id_col: str = "conv_id", turn_col: str = "turn",
              role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, part, piece, whole, n_turns, formatted, loss) of all conversations.

    Turns go by number, null first, and those of one number by role and then by the
    text's hash. Null roles and texts are empty; rows without an id are one
    conversation. ``whole`` pieces are all of their conversation; the others make it up
    in order of (part, piece). ``loss`` has the code points of a piece to learn from.
    """
    role = loss_role.encode()

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _Former(TaskContext.get().partitionId(), role).run(batches)

    ident = quoted(id_col).cast("long")
    rows = conversations.select(
        F.coalesce(ident, F.lit(0)).alias("conv"), ident.isNull().alias("missing"), quoted(turn_col).alias("turn"),
        utf8(quoted(role_col)).alias("role"), utf8(quoted(text_col)).alias("text")).withColumn("hash", F.xxhash64("text"))
    order = [F.desc("missing"), F.col("conv"), F.col("turn"), F.col("role"), F.col("hash")]
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    return dealt.select("conv", "missing", "role", "text").mapInArrow(task, SCHEMA)


_PLAIN = re.compile(r"\\(.)", re.S)
_TURN = re.compile(rf"{re.escape(HEAD.decode())}((?:[^\\:]|\\.)*){re.escape(MID.decode())}", re.S)


def unescaped(text: str) -> str:
    return _PLAIN.sub(r"\1", text) if "\\" in text else text


def turns_of(text: str) -> Iterator[tuple[str, str]]:
    """(role, text) of the turns of a formatted piece."""
    for turn in text.split(END.decode())[:-1]:
        head = _TURN.match(turn)
        if head is None:
            raise ValueError("not a formatted turn")
        yield unescaped(head[1]), unescaped(turn[head.end():])


def _digest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One row per conversation of pieces in order; nothing is held but sums and digests."""
    now, state = None, None

    def row() -> tuple:
        turns, chars, learnt, total, loss = state
        return (now[1], turns, chars.hexdigest(), learnt, loss.hexdigest(), total)

    for batch in batches:
        done = []
        for conv, missing, n, text, spans in batch.itertuples(index=False):
            if now != (missing, conv if not missing else None):
                if now is not None:
                    done.append(row())
                now, state = (missing, conv if not missing else None), [0, hashlib.sha256(), 0, 0, hashlib.sha256()]
            state[0] += int(n)
            for role, said in turns_of(text):
                state[1].update(f"{role}\n{said}\n".encode())
            for s in spans:
                said = unescaped(text[s["start"]:s["end"]])
                state[2] += len(said)
                state[4].update(said.encode())
            state[3] += len(text)
        if done:
            yield _frame(done)
    if now is not None:
        yield _frame([row()])


def _frame(rows: list[tuple]) -> pd.DataFrame:
    ids, turns, digest, learnt, loss, total = zip(*rows)
    return pd.DataFrame({"conv_id": pd.array(ids, dtype="Int64"), "n_turns": np.array(turns, np.int64), "turns_sha256": list(digest),
                         "loss_chars": np.array(learnt, np.int64), "loss_sha256": list(loss), "formatted_chars": np.array(total, np.int64)})


def read_back(pieces: DataFrame) -> DataFrame:
    """(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars) per
    conversation, parsed from the output of :func:`formatted`.

    Only pieces of conversations that are not whole are shuffled; they pass through
    one task in order, a piece at a time.
    """
    schema = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    rows = pieces.select(F.coalesce("conv_id", F.lit(0).cast("long")).alias("conv"), F.col("conv_id").isNull().alias("missing"),
                         "n_turns", "formatted", "loss", "part", "piece", "whole")
    columns = ["conv", "missing", "n_turns", "formatted", "loss"]
    order = ["missing", "conv", "part", "piece"]
    cut = rows.where(~F.col("whole")).repartition("missing", "conv").sortWithinPartitions(*order)
    return rows.where("whole").select(columns).mapInPandas(_digest, schema) \
        .unionByName(cut.select(columns).mapInPandas(_digest, schema))
