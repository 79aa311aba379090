"""Token ids in files of fixed-width bits, with offsets for random access.

A file holds consecutive documents: a header, blocks of ``BLOCK`` ids packed in the
least bits a vocabulary needs (a block starts on a byte), and a footer with the byte
offset of each block, the id and first token of each document. Any run of ids is
read by unpacking only the blocks it touches, all ids of a block at once.
"""

from __future__ import annotations

import json
import os
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyarrow.fs import FileSystem
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from siltbed.llm.bpe import SPACE, Letters, Words, library_letters
from siltbed.llm.common import kept, quoted, slices, text_of, utf8
from siltbed.session import scratch_path, stage

MAGIC = b"SBBITS1\n"
BLOCK = 1 << 16
CHUNK = 1_000_000       # bytes of text encoded at a time
READ = 64               # blocks read back at a time
WORDS = 300_000         # encoded words a worker keeps, and as many it had before
# Fixed value: the words of byte-level vocabularies, with white space spelled out.
BYTE_LEVEL_WORDS = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
                    .replace(r"[^\s", f"[^{SPACE}").replace(r"\S", f"[^{SPACE}]").replace(r"\s", f"[{SPACE}]"))
FILE = 256 << 20        # bytes of text that one file is made of, about

MANIFEST = "part int, file string, documents long, ids long, bytes long"


def bits_for(vocabulary: int) -> int:
    """Least bits that hold ids under ``vocabulary``."""
    return max(1, int(vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    """Ids one after the other, each from its lowest bit on."""
    raw = np.ascontiguousarray(ids, "<u4").view(np.uint8).reshape(-1, 4)
    return np.packbits(np.unpackbits(raw, axis=1, count=bits, bitorder="little"), bitorder="little").tobytes()


def unpack(data: bytes, bits: int, count: int) -> np.ndarray:
    flat = np.unpackbits(np.frombuffer(data, np.uint8), count=count * bits, bitorder="little").reshape(count, bits)
    full = np.zeros((count, 32), np.uint8)
    full[:, :bits] = flat
    return np.packbits(full, axis=1, bitorder="little").view("<u4").reshape(count)


class WordEncoder:
    """A ``tokenizers`` vocabulary whose ids follow from a text's words alone.

    Byte-level vocabularies split a text by a fixed pattern and encode the words one by
    one. The library encodes each word once, a worker keeps the ids of the words it met
    lately, and a text's ids are those of its words. Any other vocabulary encodes whole texts.
    """

    def __init__(self, definition: str, letters: Letters | None = None):
        self.library = Tokenizer.from_str(definition)
        self.library.no_padding()
        self.library.no_truncation()
        spec = json.loads(definition)
        split = spec.get("pre_tokenizer") or {}
        self.by_word = split.get("type") == "ByteLevel" and split.get("use_regex") and not split.get("add_prefix_space") \
            and not spec.get("normalizer") and not spec["model"].get("continuing_subword_prefix")
        added = sorted((t["content"] for t in spec.get("added_tokens") or []), key=len, reverse=True)
        self.added = [t for t in added if t]
        self.cut = regex.compile("(" + "|".join(map(regex.escape, self.added)) + ")").split
        self.find = Words(BYTE_LEVEL_WORDS, letters or library_letters())
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def words(self, text: str) -> list[str]:
        """Words of a text; added tokens in it are words of their own and end the ones before."""
        if not any(t in text for t in self.added):
            return self.find(text)
        parts = self.cut(text)
        return [w for i, p in enumerate(parts) for w in (self.find(p) if i % 2 == 0 else (p,))]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit numbers."""
        if not self.by_word:
            return [np.array(e.ids, "<u4").tobytes() for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]
        words = [self.words(t) for t in texts]
        if len(self.known) > WORDS:
            self.known, self.older = {}, self.known
        new = []
        for w in set().union(*words).difference(self.known):
            if w in self.older:
                self.known[w] = self.older[w]
            else:
                new.append(w)
        for w, e in zip(new, self.library.encode_batch_fast(new, add_special_tokens=False)):
            self.known[w] = np.array(e.ids, "<u4").tobytes()
        return [b"".join(map(self.known.__getitem__, own)) for own in words]


class Writer:
    """Documents in order to one file; only the current block is held back."""

    def __init__(self, out, bits: int):
        self.out, self.bits = out, bits
        self.held: list[np.ndarray] = []
        self.pending = self.total = 0
        self.blocks, self.starts, self.names = [], [], []
        header = MAGIC + struct.pack("<II", bits, BLOCK)
        out.write(header)
        self.at = len(header)

    def _block(self, ids: np.ndarray) -> None:
        data = pack(ids, self.bits)
        self.blocks.append(self.at)
        self.out.write(data)
        self.at += len(data)

    def add(self, name: int | None, ids: np.ndarray) -> None:
        self.names.append(name)
        self.starts.append(self.total)
        self.total += len(ids)
        self.held.append(ids)
        self.pending += len(ids)
        if self.pending >= BLOCK:
            ids = np.concatenate(self.held)
            whole = len(ids) // BLOCK * BLOCK
            for at in range(0, whole, BLOCK):
                self._block(ids[at:at + BLOCK])
            self.held, self.pending = [ids[whole:]], len(ids) - whole

    def close(self) -> int:
        if self.pending:
            self._block(np.concatenate(self.held))
        names = np.array([0 if n is None else n for n in self.names], "<i8")
        known = np.packbits(np.array([n is not None for n in self.names], bool))
        footer = json.dumps({"ids": self.total, "documents": len(names), "blocks": len(self.blocks)}).encode()
        parts = (np.array([*self.blocks, self.at], "<i8").tobytes(), np.array(self.starts, "<i8").tobytes(),
                 names.tobytes(), known.tobytes(), footer, struct.pack("<I", len(footer)))
        for part in parts:
            self.out.write(part)
            self.at += len(part)
        return self.at


class Reader:
    """Random access to a file of :class:`Writer`; ``source`` is an open, seekable file."""

    def __init__(self, source, size: int):
        self.source = source
        self._seek(0)
        head = source.read(len(MAGIC) + 8)
        if head[:len(MAGIC)] != MAGIC:
            raise ValueError("not a file of packed ids")
        self.bits, self.block = struct.unpack("<II", head[len(MAGIC):])
        self._seek(size - 4)
        length = struct.unpack("<I", source.read(4))[0]
        self._seek(size - 4 - length)
        meta = json.loads(source.read(length))
        self.ids, n, blocks = meta["ids"], meta["documents"], meta["blocks"]
        known = (n + 7) // 8
        self._seek(size - 4 - length - known - 16 * n - 8 * (blocks + 1))
        self.blocks = np.frombuffer(source.read(8 * (blocks + 1)), "<i8")
        self.starts = np.append(np.frombuffer(source.read(8 * n), "<i8"), self.ids)
        names = np.frombuffer(source.read(8 * n), "<i8")
        given = np.unpackbits(np.frombuffer(source.read(known), np.uint8), count=n).astype(bool)
        self.names = [int(x) if g else None for x, g in zip(names, given)]

    def _seek(self, at: int) -> None:
        self.source.seek(at)

    def read(self, start: int, stop: int) -> np.ndarray:
        """Ids from ``start`` up to ``stop``."""
        if stop <= start:
            return np.zeros(0, "<u4")
        a, b = start // self.block, (stop - 1) // self.block
        self._seek(int(self.blocks[a]))
        data = self.source.read(int(self.blocks[b + 1] - self.blocks[a]))
        parts = []
        for k in range(a, b + 1):
            own = data[int(self.blocks[k] - self.blocks[a]):int(self.blocks[k + 1] - self.blocks[a])]
            parts.append(unpack(own, self.bits, min(self.block, self.ids - k * self.block)))
        return np.concatenate(parts)[start - a * self.block:stop - a * self.block]

    def document(self, index: int) -> np.ndarray:
        return self.read(int(self.starts[index]), int(self.starts[index + 1]))

    def documents(self) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """(id, start in the file, ids) of all documents, some blocks at a time."""
        low = high = 0
        held = np.zeros(0, "<u4")
        for i, name in enumerate(self.names):
            start, stop = int(self.starts[i]), int(self.starts[i + 1])
            if stop > high:
                more = min(self.ids, max(stop, high + READ * self.block))
                held = np.concatenate([held[start - low:], self.read(high, more)])
                low, high = start, more
            yield name, start, held[start - low:stop - low]


def write(docs: DataFrame, path: str, *, id_col: str = "doc_id", text_col: str = "text", end: int = 0,
          folder: str | None = None, parts: int | None = None) -> DataFrame:
    """Encode texts with the vocabulary file ``path`` and write them in id order.

    Gives one row per file (``MANIFEST``) in order. Each text gets ``end`` after it;
    null texts are empty; null ids come first, rows of one id in order of their hash.
    A task writes a file of its own name, so a repeated task spoils nothing: only the
    files that the manifest names count.
    """
    spark = docs.sparkSession
    folder = folder or scratch_path(spark, "packed")
    with open(path, encoding="utf-8") as f:
        definition = f.read()
    vocabulary = max(Tokenizer.from_str(definition).get_vocab(with_added_tokens=True).values()) + 1
    bits = bits_for(max(vocabulary, end + 1))
    shared = spark.sparkContext.broadcast((definition, library_letters()))
    if parts is None:
        # As many files as the texts need, and no fewer than the session's tasks.
        total = docs.agg(F.sum(F.octet_length(utf8(quoted(text_col))))).first()[0] or 0
        parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // FILE))

    def task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        encoder, last = kept(WordEncoder, shared.value), np.array([end], "<u4").tobytes()
        part = TaskContext.get().partitionId()
        fs, root = FileSystem.from_uri(folder)
        writer = out = None
        for batch in batches:
            if writer is None:
                fs.create_dir(root, recursive=True)
                name = f"part-{part:05d}-{uuid.uuid4().hex}.ids"
                out = fs.open_output_stream(f"{root}/{name}")
                writer = Writer(out, bits)
            texts, names, missing = batch["text"].array, batch["id"].tolist(), batch["missing"].tolist()
            for piece in slices(texts, CHUNK):
                found = encoder.encode([text_of(x) for x in texts[piece]])
                for i, ids in zip(range(piece.start, piece.stop), found):
                    writer.add(None if missing[i] else names[i], np.frombuffer(ids + last, "<u4"))
        if writer is not None:
            size = writer.close()
            out.close()
            yield pd.DataFrame([(part, f"{folder}/{name}", len(writer.names), writer.total, size)],
                               columns=["part", "file", "documents", "ids", "bytes"])

    # Many rows of one id are dealt by their hash and place.
    ident, text = quoted(id_col).cast("long"), utf8(quoted(text_col))
    rows = docs.select(F.coalesce(ident, F.lit(0)).alias("id"), ident.isNull().alias("missing"), text.alias("text"),
                       F.xxhash64(text).alias("hash"), F.monotonically_increasing_id().alias("place"))
    order = [F.desc("missing"), F.col("id"), F.col("hash"), F.col("place")]
    dealt = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order).select("id", "missing", "text")
    return stage(dealt.mapInPandas(task, MANIFEST), "packed-manifest").orderBy("part")


def read_back(spark: SparkSession, manifest: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) per document, read from the files.

    ``start`` counts the ids of all documents before; the offsets of whole files are
    summed on the driver, one number per file.
    """
    files = manifest.select("part", "file", "ids", "bytes").orderBy("part").collect()
    base, rows = 0, []
    for f in files:
        rows.append((f["file"], base, f["bytes"]))
        base += f["ids"]

    def task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for file, base, size in batch.itertuples(index=False):
                fs, at = FileSystem.from_uri(file)
                with fs.open_input_file(at) as source:
                    out = []
                    for name, start, ids in Reader(source, size).documents():
                        out.append((name, base + start, len(ids), zlib.crc32(ids.tobytes())))
                        if len(out) == 10_000:
                            yield _frame(out)
                            out = []
                    yield _frame(out)

    schema = "doc_id long, start long, n_tokens long, ids_crc32 long"
    if not rows:
        return spark.createDataFrame([], schema)
    listed = spark.createDataFrame(rows, "file string, base long, bytes long").repartition(len(rows))
    return listed.mapInPandas(task, schema)


def _frame(rows: list[tuple]) -> pd.DataFrame:
    # Ids go into a nullable column from the start: as floats large ones would change.
    names, starts, counts, sums = zip(*rows) if rows else ((), (), (), ())
    return pd.DataFrame({"doc_id": pd.array(names, dtype="Int64"), "start": np.array(starts, np.int64),
                         "n_tokens": np.array(counts, np.int64), "ids_crc32": np.array(sums, np.int64)})
