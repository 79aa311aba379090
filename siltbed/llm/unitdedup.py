"""Substring dedup by hashing lines and sentences.

Units are the lines of a text and, where a line has several, its sentences. One that
is too short alone counts together with those after it, and with those before it,
until they are long enough, whatever lines they are on. Each is
normalised (A-Z in lower case, runs of ASCII white space as one space) and hashed;
digests are grouped over all documents, the occurrence that ranks first by document
and place stays, and the spans of all others are removed, with their places in the
original text kept as the record of what went.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltbed.llm.common import quoted, slices, text_of, utf8
from siltbed.session import stage

LEAST_WORDS = 8         # shorter units repeat by chance
SLICE_BYTES = 1 << 20   # of text whose units a task holds at a time
STOPS = "。！？｡။។៕།"    # end a sentence whatever follows
_SENTENCE = re.compile(rf"[^.!?{STOPS}]*(?:[.!?]++(?![ \t\r\x0b\x0c{STOPS}])[^.!?{STOPS}]*)*[.!?{STOPS}]*", re.A)
# Thai, Lao, Tibetan, Burmese, Khmer, kana and Han
_UNSPACED = re.compile("[\u0e00-\u109f\u1780-\u17ff\u3005-\u3007\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff]")


def _size(span: str, words: list[bytes]) -> int:
    """Words; two characters of a script without spaces count as one more."""
    return len(words) + (0 if span.isascii() else len(_UNSPACED.findall(span)) // 2)


def _joined(sizes: list[int], loose: set[int], least: int) -> Iterator[tuple[int, int]]:
    """(first, last) of the least windows that begin or end with a short unit."""
    for step in (1, -1):
        for i, total in enumerate(sizes):
            j = i + step
            if total >= least or not 0 <= j < len(sizes) or (i in loose and sizes[j] >= least):
                continue
            while total < least and 0 <= j < len(sizes):
                total += sizes[j]
                j += step
            if total >= least:
                yield min(i, j - step), max(i, j - step)


def units(text: str, least: int = LEAST_WORDS) -> Iterator[tuple[int, int, bytes]]:
    """(start, end, digest) of each unit, places in code points."""
    def digest(words: list[bytes]) -> bytes:
        return hashlib.blake2b(b" ".join(words), digest_size=16).digest()

    at = 0
    known = set()
    places, parts, sizes = [], [], []
    loose = set()       # a last word without a stop goes with its line, or with short neighbours
    for line in text.split("\n"):
        found = [m.span() for m in _SENTENCE.finditer(line) if m.end() > m.start()]
        whole = len(found) < 2
        for a, b in [(0, len(line))] + ([] if whole else found):
            words = line[a:b].encode("utf-8", "replace").lower().split()
            size = _size(line[a:b], words)
            if size >= least:
                known.add((at + a, at + b))
                yield at + a, at + b, digest(words)
            if words and (whole or (a, b) != (0, len(line))):
                if size == 1 and not whole and b == len(line) and line[b - 1] not in ".!?" + STOPS:
                    loose.add(len(sizes))
                places.append((at + a, at + b))
                parts.append(words)
                sizes.append(size)
        at += len(line) + 1
    for i, j in _joined(sizes, loose, least):
        span = places[i][0], places[j][1]
        if span not in known:
            known.add(span)
            yield *span, digest([w for words in parts[i:j + 1] for w in words])


def remove(text: str, spans: list[tuple[int, int]]) -> tuple[str, list[tuple[int, int]]]:
    """The text without spans, and the maximal runs that went."""
    runs: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if runs and a <= runs[-1][1]:
            runs[-1] = (runs[-1][0], max(runs[-1][1], b))
        else:
            runs.append((a, b))
    parts, past = [], 0
    for a, b in runs:
        parts.append(text[past:a])
        past = b
    return "".join(parts) + text[past:], runs


def _with_units(texts: DataFrame, least: int) -> DataFrame:
    """(id, hash, span, digest) of each unit of (id, hash, text), text in bytes.

    A task holds the units of few texts at a time, as columns: those of a whole batch of
    texts, a Python object each, took several times the batch.
    """
    span = T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())])
    schema = T.StructType([texts.schema["id"], texts.schema["hash"], T.StructField("span", span), T.StructField("digest", T.BinaryType())])

    return texts.mapInArrow(lambda batches: _unit_batches(batches, least), schema)


def _unit_batches(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices([text.as_buffer() for text in batch.column("text")], SLICE_BYTES):
            yield _unit_rows(batch.slice(part.start, part.stop - part.start), least)


def _unit_rows(batch: pa.RecordBatch, least: int) -> pa.RecordBatch:
    rows, starts, ends, digests = [], [], [], []
    for row, data in enumerate(batch.column("text")):
        for a, b, digest in units(text_of(data.as_py()), least):
            rows.append(row)
            starts.append(a)
            ends.append(b)
            digests.append(digest)
    at = pa.array(rows, pa.int32())
    span = pa.StructArray.from_arrays([pa.array(starts, pa.int32()), pa.array(ends, pa.int32())], ["start", "end"])
    return pa.RecordBatch.from_arrays([batch.column("id").take(at), batch.column("hash").take(at), span, pa.array(digests, pa.binary())],
                                      ["id", "hash", "span", "digest"])


def repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST_WORDS) -> DataFrame:
    """(id, hash, spans): per document (id and text hash) the units to remove."""
    text = quoted(text_col)
    texts = docs.select(quoted(id_col).alias("id"), F.xxhash64(text).alias("hash"), utf8(text).alias("text"))
    found = stage(_with_units(texts, least), "dedup-units")
    place = F.struct(F.col("id").isNull().alias("nameless"), "id", "hash", F.col("span.start").alias("start"))
    repeated = found.groupBy("digest").agg(F.count("*").alias("n"), F.min(place).alias("first"))
    repeated = stage(repeated.filter("n > 1").select("digest", "first"), "dedup-repeated")
    later = found.join(repeated, "digest").filter(place != F.col("first"))
    return later.groupBy("id", "hash").agg(F.collect_set("span").alias("spans"))


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST_WORDS) -> DataFrame:
    """(doc_id, kept_text, removed) for every row: what stays, and the spans that went.

    ``removed`` are maximal runs (start, end) in code points of the original. Null
    texts are empty. Documents rank by id (nulls last), then text hash; rows that
    share both are one occurrence and lose the same spans, but the first of the
    repeats inside a text always stays.
    """
    spans = stage(repeats(docs, id_col, text_col, least), "dedup-spans")
    text = quoted(text_col)
    rows = docs.select(quoted(id_col).alias("doc_id"), F.xxhash64(text).alias("text_hash"), utf8(text).alias("text"))
    rows = rows.join(spans, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("text_hash") == F.col("hash")), "left")

    @F.pandas_udf("kept_text string, starts array<int>, ends array<int>")
    def run(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for texts, starts, ends in batches:
            out = []
            for data, a, b in zip(texts, starts, ends):
                kept, runs = remove(text_of(data), list(zip(a, b)) if a is not None else [])
                out.append((kept, [r[0] for r in runs], [r[1] for r in runs]))
            yield pd.DataFrame(out, columns=["kept_text", "starts", "ends"])

    done = rows.select("doc_id", run("text", F.col("spans.start"), F.col("spans.end")).alias("r"))
    return done.select("doc_id", "r.kept_text", F.arrays_zip(F.col("r.starts").alias("start"), F.col("r.ends").alias("end")).alias("removed"))
