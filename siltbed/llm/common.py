"""Helpers the operators share: reading tables, free column names, batch slicing."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Rows an operator may broadcast: a table is counted before it gets a hint, and
# goes through a shuffle join above this.
BROADCAST_ROWS = 200_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free_name(df: DataFrame, wish: str) -> str:
    """A column name that ``df`` doesn't have, whatever the case."""
    taken = {c.lower() for c in df.columns}
    while wish.lower() in taken:
        wish += "_"
    return wish


def quoted(name: str) -> Column:
    """The column of exactly this name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def utf8(text: Column) -> Column:
    """The bytes of a text; null is empty."""
    return F.coalesce(text, F.lit("")).cast("binary")


def text_of(data: bytes) -> str:
    """A text from its bytes; what isn't UTF-8 becomes the replacement character."""
    return data.decode("utf-8", "replace")


_AFTER_WORD = re.compile(r"(?<=\S) ")
SEGMENT = 1_000_000     # characters of a text that are cut at a time


def chunks(text: str) -> Iterator[list[str]]:
    """A text cut before each space that follows a character that is no white space.

    Chunks after the text's first lack the space they begin with. A long text comes in
    several lists. No word of a byte-level vocabulary reaches across a cut.
    """
    at = 0
    while len(text) - at > SEGMENT:
        cut = _AFTER_WORD.search(text, at + SEGMENT)
        if cut is None:
            break
        yield _AFTER_WORD.split(text[at:cut.start()])
        at = cut.end()
    yield _AFTER_WORD.split(text[at:])


def slices(values: Sequence, limit: int) -> Iterator[slice]:
    """Runs of a batch whose lengths add up to about ``limit``, one value at least."""
    start = total = 0
    for i, v in enumerate(values):
        total += len(v)
        if total >= limit:
            yield slice(start, i + 1)
            start, total = i + 1, 0
    if start < len(values):
        yield slice(start, len(values))


_KEPT: list = []


def kept(make: Callable, values: tuple):
    """``make(*values)``, one object for all tasks of a worker that ask with equal values.

    So what it has learnt in one task serves the next. A worker keeps the latest only.
    """
    if not (_KEPT and _KEPT[0] is make and _KEPT[1] == values):
        _KEPT.clear()
        _KEPT.extend((make, values, make(*values)))
    return _KEPT[2]


def maybe_broadcast(df: DataFrame, rows: int) -> DataFrame:
    """Hint a broadcast only for a table counted to be small."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df
