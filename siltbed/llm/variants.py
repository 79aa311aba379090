"""Spelling variants: words one inserted, deleted or replaced code point apart.

The index of a block of words has one bitset over the block for every (position,
letter) that occurs. A query walks through its letters: the words that agree so far
(no error), and those that left at one position and agree since, with positions
equal (replaced) or shifted by one (deleted), are bitsets that one recurrence
carries on 64 words at a time, for all queries of the block side by side.

Blocks come from where two words first differ. Of a pair whose longer word has ``L``
letters that place lies in the first or in the second half, so the pair agrees on the
letters of the other half; a block holds the words of ``L`` and ``L - 1`` letters that
agree there. Blocks too large for a task are halved again, and agree on more. A pair
counts only in the block whose places hold the one where it first differs, so each is
found once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltbed.llm.common import quoted
from siltbed.session import stage

CHUNK_WORDS = 2_048         # words of one index
CHUNK_LETTERS = 32_768      # letters of one index
BLOCK_WORDS = 20_000        # a block with more words, or
BLOCK_LETTERS = 4_000_000   # letters, is halved
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
CODE_BITS = 21              # of a code point


def runs(docs: DataFrame, letters: str, least: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, run) of every maximal run of at least ``least`` of the ``letters`` (a regex class).

    A-Z become lower case. Null texts have none; the id is text, a null one empty.
    """
    found = F.regexp_extract_all(quoted(text_col), F.lit(f"{letters}{{{least},}}"), F.lit(0))
    return docs.select(F.coalesce(quoted(id_col).cast("string"), F.lit("")).alias("id"), F.explode(found).alias("run")) \
        .select("id", F.translate("run", UPPER, LOWER).alias("run"))


def vocabulary(words: DataFrame, word: Column, least: int, seen: int = 2) -> DataFrame:
    """(word, n): words of at least ``least`` code points, and how often each of them
    occurs, if at least ``seen`` times."""
    return words.select(word.alias("word")).where(F.length("word") >= least) \
        .groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= seen)


class Index:
    """Bitsets over words by position and code point."""

    def __init__(self, codes: list[np.ndarray]):
        size = np.array([len(c) for c in codes])
        flat = np.concatenate(codes).astype(np.int64) if len(codes) else np.zeros(0, np.int64)
        place = np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)
        self.keys, row = np.unique((place << CODE_BITS) | flat, return_inverse=True)
        self.width = -(-len(codes) // 64)
        # The last row stands for letters no word has at a position.
        bits = np.zeros((len(self.keys) + 1, self.width * 64), bool)
        bits[row, np.repeat(np.arange(len(codes)), size)] = True
        self.bits = self._packed(bits)
        self.size = size

    def _packed(self, bits: np.ndarray) -> np.ndarray:
        return np.packbits(bits, axis=1, bitorder="little").view("<u8").reshape(len(bits), -1)

    def _rows(self, codes: np.ndarray, shift: int) -> np.ndarray:
        """The bitset row of each query's letters, positions moved left by ``shift``."""
        place = np.arange(codes.shape[1]) - shift
        key = (place << CODE_BITS) | codes
        at = np.searchsorted(self.keys, key)
        at[at == len(self.keys)] = 0
        return np.where((place >= 0) & (self.keys[at] == key), at, len(self.keys))

    def _of_size(self, size: int) -> np.ndarray:
        bits = np.zeros((1, self.width * 64), bool)
        bits[0, :len(self.size)] = self.size == size
        return self._packed(bits)

    def near(self, codes: np.ndarray, first: int, last: int) -> tuple[tuple, tuple]:
        """(query, word) pairs that first differ at a position in ``first`` .. ``last - 1``:
        one letter replaced, and one of the query's letters missing in the word.

        ``codes`` has one row for each query, all of one length.
        """
        queries, size = codes.shape
        same, shifted = self._rows(codes, 0), self._rows(codes, 1)
        agree = np.full((queries, self.width), ~np.uint64(0))
        replaced, missing = np.zeros_like(agree), np.zeros_like(agree)
        for i in range(size):
            here = self.bits[same[:, i]]
            if i > first:
                replaced &= here
                missing &= self.bits[shifted[:, i]]
            if first <= i < last:
                left = agree & ~here
                replaced |= left
                missing |= left
            if i < last:
                agree &= here
        return self._pairs(replaced & self._of_size(size)), self._pairs(missing & self._of_size(size - 1))

    @staticmethod
    def _pairs(hits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        query, cell = np.nonzero(hits)
        bits = np.unpackbits(hits[query, cell].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        at, bit = np.nonzero(bits)
        return query[at], cell[at] * 64 + bit


def _codes(words: list[str]) -> list[np.ndarray]:
    return [np.frombuffer(w.encode("utf-32-le"), "<u4") for w in words]


def _near_of(words: list[str], n: np.ndarray, size: int, first: int, last: int) -> pd.DataFrame | None:
    """(word, n_near, best_n, best) of those words of a chunk of blocks that have near ones.

    Words that don't fit into one index are searched in several, by all queries.
    """
    codes = _codes(words)
    long = np.array([i for i, c in enumerate(codes) if len(c) == size], np.int64)
    step = max(1, min(CHUNK_WORDS, CHUNK_LETTERS // size))
    source, target = [], []
    for at in range(0, len(words), step):
        index = Index(codes[at:at + step])
        for q in range(0, len(long), step):
            asked = long[q:q + step]
            replaced, missing = index.near(np.stack([codes[i] for i in asked]).astype(np.int64), first, last)
            source += [asked[replaced[0]], asked[missing[0]], missing[1] + at]
            target += [replaced[1] + at, missing[1] + at, asked[missing[0]]]
    if not sum(map(len, source)):
        return None
    source, target = np.concatenate(source), np.concatenate(target)
    rank = np.empty(len(words), np.int64)
    rank[sorted(range(len(words)), key=words.__getitem__)] = np.arange(len(words))
    order = np.lexsort((rank[target], -n[target], source))
    source, target = source[order], target[order]
    starts = np.flatnonzero(np.r_[True, source[1:] != source[:-1]])
    best = target[starts]
    return pd.DataFrame({"word": [words[i] for i in source[starts]], "n_near": np.diff(np.r_[starts, len(source)]),
                         "best_n": n[best], "best": [words[i] for i in best]})


def _chunks(rows: pd.DataFrame) -> Iterator[tuple[int, int]]:
    """Spans of rows, whole blocks each, that are searched together."""
    starts = _starts(rows, ["size", "first", "last", "block"])
    kinds = set(_starts(rows, ["size", "first", "last"]).tolist())
    sizes, begin = rows["size"].to_numpy(), 0
    for a, b in zip(starts, np.r_[starts[1:], len(rows)]):
        limit = max(1, min(CHUNK_WORDS, CHUNK_LETTERS // int(sizes[a])))
        if a > begin and (int(a) in kinds or b - begin > limit):
            yield begin, int(a)
            begin = int(a)
    if begin < len(rows):
        yield begin, len(rows)


def _starts(rows: pd.DataFrame, by: list[str]) -> np.ndarray:
    if not len(rows):
        return np.zeros(0, np.int64)
    new = np.zeros(len(rows), bool)
    new[0] = True
    for c in by:
        v = rows[c].to_numpy()
        new[1:] |= v[1:] != v[:-1]
    return np.flatnonzero(new)


def _with_pairs(rows: pd.DataFrame) -> pd.DataFrame:
    """Rows of blocks that can hold a pair: two words, one of them of the full length."""
    starts = _starts(rows, ["size", "first", "last", "block"])
    if not len(starts):
        return rows
    count = np.diff(np.r_[starts, len(rows)])
    long = np.maximum.reduceat(rows["long"].to_numpy(), starts)
    return rows[np.repeat((count > 1) & long, count)]


def _search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    held = None

    def found(rows: pd.DataFrame) -> Iterator[pd.DataFrame]:
        rows = _with_pairs(rows)
        for a, b in _chunks(rows):
            part = rows.iloc[a:b]
            size, first, last = (int(part[c].iat[0]) for c in ("size", "first", "last"))
            near = _near_of(part["word"].tolist(), part["n"].to_numpy(), size, first, last)
            if near is not None:
                yield near

    for batch in batches:
        rows = batch if held is None else pd.concat([held, batch], ignore_index=True)
        starts = _starts(rows, ["size", "first", "last", "block"])
        if not len(starts):
            continue
        # The last block may go on in the next batch.
        held = rows.iloc[starts[-1]:].reset_index(drop=True)
        yield from found(rows.iloc[:starts[-1]].reset_index(drop=True))
    if held is not None:
        yield from found(held)


def _placed(words: DataFrame) -> DataFrame:
    """Add the block of each row: a hash of the letters outside its places."""
    tail = F.col("size") - F.col("last")
    head = F.expr("substring(word, 1, first)")
    rest = F.when(tail > 0, F.expr("substring(word, length(word) - (size - last) + 1)")).otherwise("")
    return words.withColumn("block", F.xxhash64("size", "first", "last", head, rest))


def near_words(words: DataFrame) -> DataFrame:
    """(word, n_near, best_n, best) for every word of ``words`` (word, n) that has near ones:
    their number, and the one of largest ``n``, the first in code-point order among equals.

    Words are distinct and not empty.
    """
    own = F.length("word")
    half = lambda size: F.array(
        F.struct(size.alias("size"), F.lit(0).alias("first"), (size / 2).cast("int").alias("last")),
        F.struct(size.alias("size"), (size / 2).cast("int").alias("first"), size.alias("last")))
    entries = words.select("word", F.col("n").cast("long").alias("n"), F.explode(F.concat(half(own), half(own + 1))).alias("p")) \
        .select("word", "n", "p.*").where(F.col("last") > F.col("first"))
    ready = None
    while True:
        entries = _placed(entries)
        large = stage(
            entries.groupBy("block").agg(F.count("*").alias("rows"), F.sum(F.length("word")).alias("letters"),
                                         F.max(F.col("last") - F.col("first")).alias("places"))
            .where(((F.col("rows") > BLOCK_WORDS) | (F.col("letters") > BLOCK_LETTERS)) & (F.col("places") > 1)).select("block"),
            "variants-large")
        done = large.isEmpty()
        small = entries if done else entries.join(large, "block", "left_anti")
        ready = small if ready is None else ready.unionByName(small)
        if done:
            break
        middle = ((F.col("first") + F.col("last")) / 2).cast("int")
        parts = F.array(F.struct(F.col("first"), middle.alias("last")), F.struct(middle.alias("first"), F.col("last")))
        entries = stage(entries.join(large, "block", "left_semi").select("word", "n", "size", F.explode(parts).alias("p"))
                        .select("word", "n", "size", "p.*").where(F.col("last") > F.col("first")), "variants-halved")
    dealt = ready.withColumn("long", F.length("word") == F.col("size")).repartition("block") \
        .sortWithinPartitions("size", "first", "last", "block")
    found = dealt.select("word", "n", "size", "first", "last", "block", "long") \
        .mapInPandas(_search, "word string, n_near long, best_n long, best string")
    best = F.min(F.struct((-F.col("best_n")).alias("less"), F.col("best").alias("word"))).alias("b")
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best) \
        .select("word", "n_near", (-F.col("b.less")).alias("best_n"), F.col("b.word").alias("best"))


def grouped(words: DataFrame, ratio: int = 10) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for every word of ``words`` (word, n).

    A word's form is its near word of largest ``n``, the first in code-point order among
    equals, if that occurs at least ``ratio`` times as often (else null); its root the
    last word of the way from form to form, the word itself where it has no form.
    Forms grow by ``ratio`` at each step, so a way has few.
    """
    words = stage(words.select("word", F.col("n").cast("long").alias("n")), "variants-words")
    joined = words.join(near_words(words), "word", "left")
    is_form = F.col("best_n") >= ratio * F.col("n")
    found = stage(joined.select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(is_form, F.col("best")).alias("form"), F.when(is_form, F.col("best_n")).alias("form_n")), "variants-forms")
    forms = found.where(F.col("form").isNotNull())
    onward = forms.select(F.col("word").alias("root"), F.col("form").alias("next"))
    ends, moved = forms.select("word", F.col("form").alias("root")), True
    while moved:
        step = stage(ends.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root"),
                                                              F.col("next").isNotNull().alias("moved")), "variants-roots")
        moved = not step.where("moved").isEmpty()
        ends = step.select("word", "root")
    return found.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
