"""Cross-tokenizer alignment: which tokens of two vocabularies cover the same bytes.

Both tokenizers encode a text; a dictionary from end offset to index is made for each,
the common keys, sorted, cut both lists of ids into groups, and the links of a group
are all its pairs of an A and a B token.

A text is aligned chunk by chunk. It is cut before each space that follows a character
that is no white space: the byte-level words of A never reach across such a place, nor
does a piece of B if no piece of its vocabulary has a space after another character
(else texts stay whole). So both tokenizers end a token there, and chunks, most of them
words, are encoded and aligned once for many texts.

Links are counted over the corpus in two passes. A task turns some megabytes of texts
into one row: their digests, the chunks each text has, and the distinct links of all of
them with the number of its texts. Links are summed over all rows; then each row gets
the counts of its own links back.
"""

from __future__ import annotations

import hashlib
import os
import pickle
from collections.abc import Iterable, Iterator
from itertools import chain
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from siltbed.llm.bpe import byte_characters
from siltbed.llm.common import chunks, kept, quoted, slices, text_of, utf8
from siltbed.session import stage

BATCH = 8_000_000       # bytes of texts in one row of the first pass
CHUNKS = 200_000        # aligned chunks a worker keeps
LONG = 200              # longer chunks are not kept
ENCODED = 200_000       # characters the libraries encode at a time
HELD = 500_000          # links of texts that are made distinct at a time
SPACE = "▁"
_RESULT = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string")


class Aligned(NamedTuple):
    """One aligned chunk; each of its ``groups`` ends with a semicolon."""

    n_a: int
    n_b: int
    n_groups: int
    groups: str
    links: bytes


class Pair:
    """The two tokenizers, and the bytes of their tokens."""

    def __init__(self, definition: str, model: bytes):
        self.a = Tokenizer.from_str(definition)
        self.a.no_padding()
        self.a.no_truncation()
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=model)
        value = {c: i for i, c in enumerate(byte_characters())}
        self.bytes_a: list[bytes] = [b""] * (max(self.a.get_vocab(with_added_tokens=True).values()) + 1)
        for token, i in self.a.get_vocab(with_added_tokens=True).items():
            self.bytes_a[i] = bytes(value[c] for c in token) if all(c in value for c in token) else token.encode()
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [bytes([int(p[1:-1], 16)]) if self.b.is_byte(i) else p.replace(SPACE, " ").encode() for i, p in enumerate(pieces)]
        self.size_a, self.size_b = (np.fromiter(map(len, x), np.int64, len(x)) for x in (self.bytes_a, self.bytes_b))
        self.text_a, self.text_b = (np.array([[f"{i}{c}" for i in range(len(x))] for c in ends], object)
                                    for x, ends in ((self.bytes_a, ",|"), (self.bytes_b, ",;")))
        self.by_chunk = not any(SPACE in p.lstrip(SPACE) for p in pieces)
        # The library adds its space to no text at all.
        self.lone = [self.b.piece_to_id(SPACE)]
        self.known: dict[str, Aligned | None] = {}
        self.older: dict[str, Aligned | None] = {}

    def _cut(self, text: str) -> Iterator[list[str]]:
        return chunks(text) if self.by_chunk else iter([[text]])

    def align(self, texts: list[str]) -> list[Aligned | None]:
        """Alignments of a space and each text; none where tokens don't give its bytes."""
        full = [" " + c for c in texts]
        ids_a = [e.ids for e in self.a.encode_batch_fast(full, add_special_tokens=False)]
        ids_b = [x or self.lone for x in self.b.encode(texts, num_threads=1)]
        good = self._lossless([x.encode("utf-8", "replace") for x in full], ids_a, ids_b)
        if all(good):
            return self._grouped(ids_a, ids_b)
        found = iter(self._grouped([x for x, g in zip(ids_a, good) if g], [x for x, g in zip(ids_b, good) if g]))
        return [next(found) if g else None for g in good]

    def _lossless(self, data: list[bytes], ids_a: list[list[int]], ids_b: list[list[int]]) -> list[bool]:
        """Whether the tokens of both sides give each chunk's bytes."""
        def same(ids: list[list[int]], values: list[bytes], size: np.ndarray) -> list[bool]:
            length = np.fromiter(map(len, data), np.int64, len(data))
            flat = list(chain.from_iterable(ids))
            if np.array_equal(_sums(size[flat], ids), length) and b"".join(map(values.__getitem__, flat)) == b"".join(data):
                return [True] * len(data)
            return [b"".join(map(values.__getitem__, x)) == d for x, d in zip(ids, data)]

        return [x and y for x, y in zip(same(ids_a, self.bytes_a, self.size_a), same(ids_b, self.bytes_b, self.size_b))]

    def _grouped(self, ids_a: list[list[int]], ids_b: list[list[int]]) -> list[Aligned]:
        """Alignments of chunks that lie one after the other: their ends are offsets in all of them."""
        if not ids_a:
            return []
        a, b = (np.fromiter(chain.from_iterable(x), np.int64) for x in (ids_a, ids_b))
        at_a, at_b = (dict(zip(np.cumsum(size[x]).tolist(), range(len(x)))) for x, size in ((a, self.size_a), (b, self.size_b)))
        common = sorted(at_a.keys() & at_b.keys())
        stop_a, stop_b = (np.fromiter(map(at.__getitem__, common), np.int64, len(common)) + 1 for at in (at_a, at_b))
        n_a, n_b = np.diff(stop_a, prepend=0), np.diff(stop_b, prepend=0)
        start_a, start_b = stop_a - n_a, stop_b - n_b
        # Links of a group: each A token with all B tokens.
        wide = np.repeat(n_b, n_a)
        links = (np.repeat(a, wide) << 32) | b[np.repeat(np.repeat(start_b, n_a), wide) + _counted(wide)]
        # Groups as text: the A tokens, the last with a bar, and the B tokens, the last with a semicolon.
        text = np.empty(len(a) + len(b), object)
        last_a, last_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
        last_a[stop_a - 1] = last_b[stop_b - 1] = 1
        text[np.arange(len(a)) + np.repeat(start_b, n_a)] = self.text_a[last_a, a]
        text[np.arange(len(b)) + np.repeat(stop_a, n_b)] = self.text_b[last_b, b]

        tokens_a, tokens_b = ([len(x) for x in ids] for ids in (ids_a, ids_b))
        end_a, end_b = np.cumsum(tokens_a), np.cumsum(tokens_b)
        group = np.searchsorted(stop_a, end_a) + 1
        link = np.cumsum(n_a * n_b)[group - 1] * 8
        parts, raw, out = text.tolist(), links.tobytes(), []
        g = t = k = 0
        for x, y, g2, t2, k2 in zip(tokens_a, tokens_b, group.tolist(), (end_a + end_b).tolist(), link.tolist()):
            out.append(Aligned(x, y, g2 - g, "".join(parts[t:t2]), raw[k:k2]))
            g, t, k = g2, t2, k2
        return out

    def learn(self, texts: Iterable[str]) -> dict[str, Aligned | None]:
        """Alignments of all chunks. Those asked for lately are kept for the next call."""
        if len(self.known) > CHUNKS:
            self.known, self.older = {}, self.known
        own: dict[str, Aligned | None] = {}
        new = []
        for c in texts:
            if c in self.known:
                own[c] = self.known[c]
            elif c in self.older:
                own[c] = self.known[c] = self.older[c]
            else:
                new.append(c)
        for part in slices(new, ENCODED):
            for c, aligned in zip(new[part], self.align(new[part])):
                own[c] = aligned
                if len(c) <= LONG:
                    self.known[c] = aligned
        return own

    def batch(self, names: list, missing: list[bool], texts: list[str]) -> tuple[bytes, np.ndarray, np.ndarray]:
        """(texts with their digests and chunks, distinct links, number of texts that hold each)."""
        index = _Index()
        own = [[np.fromiter(map(index.__getitem__, part), np.int32, len(part)) for part in self._cut(t)] if t else [] for t in texts]
        found = list(map(self.learn(index).__getitem__, index))
        broken = np.array([x is None for x in found], bool)
        for d, parts in enumerate(own):
            if any(broken[p].any() for p in parts):
                # The whole text decides; its alignment is a chunk of its own.
                whole = self.align([texts[d]])[0]
                own[d] = [] if whole is None else [np.array([len(found)], np.int32)]
                if whole is not None:
                    found.append(whole)
        groups = ["" if x is None else x.groups for x in found]
        numbers = np.array([(0, 0, 0) if x is None else (x.n_a, x.n_b, x.n_groups) for x in found], np.int64).reshape(-1, 3)
        links = [b"" if x is None else x.links for x in found]
        length = np.fromiter((len(x) // 8 for x in links), np.int64, len(links))
        distinct, link = np.unique(np.frombuffer(b"".join(links), np.int64), return_inverse=True)

        sums, digests, chunk, times, text_of_chunk = [], [], [], [], []
        for d, parts in enumerate(own):
            sha = hashlib.sha256()
            for i, p in enumerate(parts):
                piece = "".join(map(groups.__getitem__, p.tolist()))
                sha.update((piece if i + 1 < len(parts) else piece[:-1]).encode())
            digests.append(sha.hexdigest() if parts else "")
            u, n = np.unique(np.concatenate(parts), return_counts=True) if parts else (np.zeros(0, np.int32),) * 2
            sums.append([*(n @ numbers[u]), n @ length[u]] if parts else [0] * 4)
            chunk.append(u)
            times.append(n)
            text_of_chunk.append(np.full(len(u), d, np.int64))
        chunk, times, text = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (chunk, times, text_of_chunk))
        docs = np.zeros(len(distinct), np.int64)
        # Texts whose links end in the same stretch of them are counted together.
        stretch = np.cumsum(np.bincount(text, length[chunk], len(own))).astype(np.int64)[text] // HELD
        for rows in np.split(np.arange(len(text)), np.flatnonzero(np.diff(stretch)) + 1):
            held = np.unique(np.repeat(text[rows], length[chunk[rows]]) * len(distinct) + link[_ranges(length, chunk[rows])])
            np.add.at(docs, held % max(1, len(distinct)), 1)
        data = {"names": names, "missing": missing, "sums": np.array(sums, np.int64).reshape(-1, 4), "digests": digests,
                "text": text.astype(np.int32), "chunk": chunk.astype(np.int32), "times": times.astype(np.int32),
                "length": length.astype(np.int32), "link": link.astype(np.int32)}
        raw = pickle.dumps(data, protocol=5)
        packed = len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)
        return packed, distinct, docs


class _Index(dict):
    def __missing__(self, key: str) -> int:
        at = self[key] = len(self)
        return at


def _sums(values: np.ndarray, lists: list[list[int]]) -> np.ndarray:
    """Sums of values that lie list by list."""
    ends = np.cumsum(np.fromiter(map(len, lists), np.int64, len(lists)))
    return np.diff(np.r_[0, np.cumsum(values)][ends], prepend=0)


def _counted(length: np.ndarray) -> np.ndarray:
    """0, 1, ... for each of the lengths."""
    return np.arange(int(length.sum())) - np.repeat(np.cumsum(length) - length, length)


def _ranges(length: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Places of all entries of the given rows of a ragged array."""
    return np.repeat((np.cumsum(length) - length)[rows], length[rows]) + _counted(length[rows])


def _valued(rows: pd.DataFrame, links: pd.DataFrame) -> pd.DataFrame:
    """Results of the texts of one row of the first pass from its links' counts."""
    links = links.sort_values("place")
    count, best = links["count"].to_numpy(np.int64), links["best"].to_numpy(bool)
    out = []
    for packed in rows["data"]:
        data = pickle.loads(pa.decompress(packed[8:], int.from_bytes(packed[:8], "little"), codec="zstd", asbytes=True))
        total = np.zeros((len(data["names"]), 2), np.int64)
        length = data["length"].astype(np.int64)
        values = np.zeros((len(length), 2), np.int64)
        of_chunk = np.repeat(np.arange(len(length)), length)
        np.add.at(values, of_chunk, np.stack([best[data["link"]].astype(np.int64), count[data["link"]]], axis=1))
        np.add.at(total, data["text"], values[data["chunk"]] * data["times"][:, None])
        sums = data["sums"]
        out.append(pd.DataFrame({
            "doc_id": pd.array([None if m else n for n, m in zip(data["names"], data["missing"])], dtype="Int64"),
            "n_a": sums[:, 0], "n_b": sums[:, 1], "n_groups": sums[:, 2], "n_links": sums[:, 3],
            "n_best": total[:, 0], "count_sum": total[:, 1], "groups_sha256": data["digests"]}))
    return pd.concat(out)


def aligned(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) per row.

    ``path_a`` is a byte-level vocabulary file of ``tokenizers``, ``path_b`` a model of
    ``sentencepiece``. A space stands before each text. Null and empty texts, and those
    whose tokens don't give their bytes, have none: zeros and an empty digest.
    """
    spark = docs.sparkSession
    with open(path_a, encoding="utf-8") as a, open(path_b, "rb") as b:
        shared = spark.sparkContext.broadcast((a.read(), b.read()))

    def task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        pair, number = kept(Pair, shared.value), TaskContext.get().partitionId() << 32
        for batch in batches:
            texts, names, missing = batch["text"].array, batch["id"].tolist(), batch["missing"].tolist()
            for piece in slices(texts, BATCH):
                data, links, held = pair.batch(names[piece], missing[piece], [text_of(x) for x in texts[piece]])
                yield pd.DataFrame({"batch": [number], "data": [data], "link": [links], "texts": [held]})
                number += 1

    ident = quoted(id_col).cast("long")
    rows = docs.select(F.coalesce(ident, F.lit(0)).alias("id"), ident.isNull().alias("missing"), utf8(quoted(text_col)).alias("text"))
    found = stage(rows.mapInPandas(task, "batch long, data binary, link array<long>, texts array<long>"), "aligned")
    links = found.select("batch", F.posexplode(F.arrays_zip("link", "texts")).alias("place", "l")) \
        .select("batch", "place", "l.link", "l.texts")
    counts = stage(links.groupBy("link").agg(F.sum("texts").alias("count")), "aligned-links")
    first = F.shiftright("link", 32)
    # One row per id of A at most: the vocabulary bounds it.
    top = counts.groupBy(first.alias("a")).agg(F.max("count").alias("most"))
    valued = counts.join(F.broadcast(top), first == F.col("a")).select("link", "count", (F.col("count") == F.col("most")).alias("best"))
    back = links.select("batch", "place", "link").join(valued, "link").select(F.col("batch").alias("of"), "place", "count", "best")
    return found.select("batch", "data").groupBy("batch").cogroup(back.groupBy("of")).applyInPandas(_valued, _RESULT)
