"""Byte-exact substring dedup over all documents by external induced sorting.

A byte is removed if a string of ``length`` bytes that covers it also starts at
another place, in the same or another document. The work is dealt by content: each
window of ``length`` bytes is held by its anchor, the ``GRAM``-byte string inside it
with the least hash, so equal windows have equal anchors wherever they are, and the
windows of one anchor, which follow one another, make one piece of text.

1. One pass over the texts lists pieces as (anchor hash, piece hash). Anchors that
   occur once hold no repeated window. Anchors whose pieces are all alike repeat in
   whole. Both are settled by one grouping.
2. Pieces of the other anchors meet in shards of bounded size, where
   :mod:`siltbed.llm.induced` sorts their suffixes; neighbours that share ``length``
   bytes are repeated windows. Every distinct piece is sorted once.
3. An anchor with more distinct pieces than a shard may hold is settled by grouping
   digests of its windows instead, which Spark splits as it needs.

Spans come back to all texts that hold a piece, and are cut out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltbed.llm import induced
from siltbed.llm.common import quoted, utf8
from siltbed.session import stage

LENGTH = 200
GRAM = 64               # bytes of an anchor
CHUNK = 2_000_000       # bytes looked at together in a task
SHARD = 4_000_000       # bytes of the pieces a shard aims at
HOT = 12_000            # distinct pieces of an anchor that a shard may hold

PIECES = "id long, k1 long, k2 long, lo int, hi int, at int, anchor long, piece long, times int, sure boolean"
_PLACE = np.uint64((1 << 24) - 1)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


class Stretches:
    """Hashes of any stretch of a text: random values per byte in a polynomial."""

    powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def __init__(self, raw: np.ndarray, seed: int):
        rng = np.random.default_rng(seed)
        value, base = rng.integers(1, 1 << 63, 256, np.uint64), int(rng.integers(1, 1 << 62)) * 4 + 3
        known = self.powers.get(seed)
        if known is None or len(known[0]) <= len(raw):
            size = max(len(raw), CHUNK + LENGTH) + 1
            up, down = (np.cumprod(np.r_[np.uint64(1), np.full(size - 1, b, np.uint64)], dtype=np.uint64)
                        for b in (base % (1 << 64), pow(base, -1, 1 << 64)))
            known = self.powers[seed] = (up, down)
        self.down = known[1]
        self.sums = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum(value[raw] * known[0][:len(raw)], out=self.sums[1:])

    def hash(self, start, stop) -> np.ndarray:
        return _mixed((self.sums[stop] - self.sums[start]) * self.down[start])


def pieces(raw: np.ndarray, ends: np.ndarray, length: int = LENGTH, gram: int = GRAM):
    """(lo, hi, at, anchor, piece) of documents that end at ``ends``, back to back.

    Windows start from lo to hi, their anchor at ``at``; all windows that fit in a
    document are in one piece.
    """
    width = length - gram + 1
    n = len(raw)
    starts = np.r_[0, ends[:-1]]
    fits = np.maximum(ends - starts - length + 1, 0)
    if not fits.any():
        return (np.empty(0, np.int64),) * 5
    window = np.repeat(starts - np.r_[0, np.cumsum(fits)[:-1]], fits) + np.arange(fits.sum())
    grams = Stretches(raw, 11)
    where = np.arange(n - gram + 1)
    # The least hash, then the leftmost place: both in one number.
    least = (grams.hash(where, where + gram) & ~_PLACE) | where.astype(np.uint64)
    size, whole = 1, least
    while size * 2 <= width:
        whole = np.minimum(whole[:-size], whole[size:])
        size *= 2
    whole = np.minimum(whole[:len(least) - width + 1], whole[width - size:width - size + len(least) - width + 1])
    at = (whole[window] & _PLACE).astype(np.int64)
    first = np.flatnonzero(np.r_[True, (at[1:] != at[:-1]) | (window[1:] != window[:-1] + 1)])
    lo, hi, at = window[first], window[np.r_[first[1:], len(window)] - 1], at[first]
    shape = ((at - lo) * 1024 + (hi - lo)).astype(np.uint64)
    return lo, hi, at, grams.hash(at, at + gram), _mixed(Stretches(raw, 23).hash(lo, hi + length) ^ _mixed(shape))


def _chunks(texts: list[bytes], length: int) -> Iterator[list[tuple[int, int, int]]]:
    """Runs of (text, from, to) of bounded size; stretches of a long text overlap by a window."""
    part, size = [], 0
    for i, text in enumerate(texts):
        for a in range(0, max(1, len(text) - length + 1), CHUNK):
            b = min(len(text), a + CHUNK + length - 1)
            if size and size + b - a > CHUNK:
                yield part
                part, size = [], 0
            part.append((i, a, b))
            size += b - a
    if part:
        yield part


def _pieces_of(batch: pd.DataFrame, length: int, gram: int) -> Iterator[pd.DataFrame]:
    texts = batch["data"].tolist()
    keys = batch[["id", "k1", "k2"]].to_numpy()
    for part in _chunks(texts, length):
        raw = np.frombuffer(b"".join(texts[i][a:b] for i, a, b in part), np.uint8)
        size = np.array([b - a for _, a, b in part])
        ends = np.cumsum(size)
        lo, hi, at, anchor, piece = pieces(raw, ends, length, gram)
        if not len(lo):
            continue
        own = np.searchsorted(ends, lo, side="right")
        shift = (np.array([a for _, a, _ in part]) - (ends - size))[own]
        row = np.array([i for i, _, _ in part])[own]
        # What repeats inside the chunk is settled here; one of each is passed on.
        order = np.lexsort((piece, anchor))
        new = np.r_[True, (anchor[order][1:] != anchor[order][:-1]) | (piece[order][1:] != piece[order][:-1])]
        group = np.cumsum(new) - 1
        times = np.bincount(group)
        alike = np.zeros(len(lo), np.int64)
        alike[order] = times[group]
        one = np.sort(order[new])
        yield _rows(keys[row[one]], lo[one] + shift[one], hi[one] + shift[one], at[one] + shift[one],
                    anchor[one], piece[one], alike[one], False)
        sure = np.flatnonzero(alike > 1)
        if len(sure):
            a, b, r = lo[sure] + shift[sure], hi[sure] + shift[sure], row[sure]
            first = np.flatnonzero(np.r_[True, (r[1:] != r[:-1]) | (a[1:] != b[:-1] + 1)])
            zero = np.zeros(len(first), np.int64)
            yield _rows(keys[r[first]], a[first], b[np.r_[first[1:], len(r)] - 1], zero, zero, zero, zero, True)


def _rows(keys, lo, hi, at, anchor, piece, times, sure) -> pd.DataFrame:
    return pd.DataFrame({"id": keys[:, 0], "k1": keys[:, 1], "k2": keys[:, 2], "lo": lo, "hi": hi, "at": at,
                         "anchor": anchor.view(np.int64), "piece": piece.view(np.int64), "times": times, "sure": sure})


def _ranges(found: np.ndarray) -> list[tuple[int, int]]:
    """Runs of true values as (first, last)."""
    edge = np.diff(np.r_[False, found, False].astype(np.int8))
    return list(zip(np.flatnonzero(edge == 1).tolist(), (np.flatnonzero(edge == -1) - 1).tolist()))


def repeats(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", length: int = LENGTH, gram: int = GRAM,
            hot: int = HOT, shard: int = SHARD) -> DataFrame:
    """(k1, k2, lo, hi): per text (by its key) runs of starts of repeated windows."""
    text = quoted(text_col)
    rows = docs.select(F.coalesce(quoted(id_col).cast("long"), F.lit(0)).alias("id"), *_key(text), utf8(text).alias("data"))
    rows = rows.filter(F.octet_length("data") >= length)

    def list_pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield from _pieces_of(batch, length, gram)

    found = stage(rows.mapInPandas(list_pieces, PIECES), "suffix-pieces")
    open_ = found.filter("not sure").drop("sure")
    anchors = open_.groupBy("anchor").agg(F.sum("times").alias("n"), (F.min("piece") != F.max("piece")).alias("mixed"))
    anchors = stage(anchors.filter("n > 1").drop("n"), "suffix-anchors")
    shared = stage(open_.join(anchors, "anchor"), "suffix-shared")
    place = ("k1", "k2", "lo", "hi")
    alike = shared.filter("not mixed").select(*place)
    mixed = shared.filter("mixed").drop("mixed")

    # Distinct pieces, each with one place to take its bytes from.
    distinct = mixed.groupBy("anchor", "piece").agg(
        F.sum("times").cast("long").alias("times"), F.min(F.struct("k1", "k2", "id", "lo", "hi")).alias("r"))
    distinct = stage(distinct.select("anchor", "piece", "times", "r.*"), "suffix-distinct")
    busy = stage(distinct.groupBy("anchor").count().filter(F.col("count") > hot).select("anchor"), "suffix-busy")
    total = distinct.agg(F.sum(F.col("hi") - F.col("lo") + length)).first()[0] or 0
    shards = max(1, int(total // shard))
    wanted = distinct.groupBy("k1", "k2", "id").agg(F.collect_list(F.struct("lo", "hi", "anchor", "piece", "times")).alias("list"))
    cut = F.transform("list", lambda p: F.struct(
        p["anchor"].alias("anchor"), p["piece"].alias("piece"), p["times"].alias("times"),
        F.substr(F.col("data"), p["lo"] + 1, p["hi"] - p["lo"] + length).alias("data")))
    taken = stage(rows.join(wanted, ["k1", "k2", "id"]).select(F.inline(cut)), "suffix-bytes")
    by_sort = taken.join(busy, "anchor", "left_anti").withColumn("shard", F.pmod(F.xxhash64("anchor"), F.lit(shards)))
    spans = "anchor long, piece long, first int, last int"

    def sort_shard(group: pd.DataFrame) -> pd.DataFrame:
        group = group.drop_duplicates(["anchor", "piece"])
        data = group["data"].tolist()
        hit = induced.repeated(induced.symbols(data), length)
        out, at = [], 0
        for anchor, piece, times, text in zip(group["anchor"], group["piece"], group["times"], data):
            windows = len(text) - length + 1
            for a, b in [(0, windows - 1)] if times > 1 else _ranges(hit[at:at + windows]):
                out.append((anchor, piece, a, b))
            at += len(text) + 1
        return pd.DataFrame(out, columns=["anchor", "piece", "first", "last"])

    sorted_ = by_sort.groupBy("shard").applyInPandas(sort_shard, spans)

    def digests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for anchor, piece, times, data in batch.itertuples(index=False):
                n = len(data) - length + 1
                yield pd.DataFrame({"anchor": anchor, "piece": piece, "times": times, "at": np.arange(n, dtype=np.int32),
                                    "digest": [hashlib.blake2b(data[i:i + length], digest_size=16).digest() for i in range(n)]})

    crowd = taken.join(busy, "anchor").dropDuplicates(["anchor", "piece"]).select("anchor", "piece", "times", "data")
    windows = stage(crowd.mapInPandas(digests, "anchor long, piece long, times long, at int, digest binary"), "suffix-windows")
    again = windows.groupBy("digest").agg(F.sum("times").alias("n")).filter("n > 1").select("digest")
    grouped = windows.join(again, "digest").select("anchor", "piece", F.col("at").alias("first"), F.col("at").alias("last"))
    hits = stage(sorted_.unionByName(grouped), "suffix-hits")
    partly = mixed.join(hits, ["anchor", "piece"]).select(
        "k1", "k2", (F.col("lo") + F.col("first")).alias("lo"), (F.col("lo") + F.col("last")).alias("hi"))
    return found.filter("sure").select(*place).unionByName(alike).unionByName(partly)


def _key(text: Column) -> tuple[Column, Column]:
    """96 bits of hash and the length: equal for equal texts, and then results are too."""
    data = F.coalesce(text, F.lit(""))
    high = F.shiftleft(F.octet_length(data).cast("long"), 32)
    return F.xxhash64(data).alias("k1"), high.bitwiseXOR(F.hash(data).cast("long").bitwiseAND(F.lit(0xFFFFFFFF))).alias("k2")


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
                 **bounds: int) -> DataFrame:
    """(doc_id, n_bytes, kept, removed) for every row: the bytes that stay, and the runs
    (start, end) in bytes that went.

    Null texts are empty; texts under ``length`` bytes stay whole; rows repeated whole
    are copies of each other and lose all they share.
    """
    spans = repeats(docs, text_col, id_col, length, **bounds).groupBy("k1", "k2").agg(
        F.collect_set(F.struct("lo", "hi")).alias("spans"))
    spans = stage(spans, "suffix-spans")
    text = quoted(text_col)
    rows = docs.select(quoted(id_col).alias("doc_id"), *_key(text), utf8(text).alias("data"))
    rows = rows.join(spans, ["k1", "k2"], "left")

    @F.pandas_udf("kept binary, starts array<int>, ends array<int>")
    def cut(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for data, lo, hi in batches:
            out = []
            for d, a, b in zip(data, lo, hi):
                if a is None or not len(a):
                    out.append((d, [], []))
                    continue
                order = np.argsort(a, kind="stable")
                a, b = a[order], np.maximum.accumulate(b[order] + length)
                first = np.r_[True, a[1:] > b[:-1]]
                starts, ends = a[first], b[np.r_[first[1:], True]]
                kept = b"".join(d[i:j] for i, j in zip(np.r_[0, ends], np.r_[starts, len(d)]))
                out.append((kept, starts.tolist(), ends.tolist()))
            yield pd.DataFrame(out, columns=["kept", "starts", "ends"])

    done = rows.select("doc_id", F.octet_length("data").cast("long").alias("n_bytes"),
                       cut("data", F.col("spans.lo"), F.col("spans.hi")).alias("r"))
    return done.select("doc_id", "n_bytes", "r.kept", F.arrays_zip(F.col("r.starts").alias("start"), F.col("r.ends").alias("end")).alias("removed"))
