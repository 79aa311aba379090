"""BPE encoding and decoding of a ``tokenizers`` vocabulary file in batched numpy rounds.

Words of many documents that were not met before are encoded together: their
symbols lie in one flat array, a binary search over the sorted pair keys finds the
rank of every neighbouring pair, and each word merges its lowest-ranked pair, all
words in the same round. Words that have no pair left drop out.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from collections.abc import Callable, Iterable, Iterator
from functools import cache
from itertools import chain
from typing import NamedTuple

import numpy as np
import pandas as pd
import regex
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from tokenizers import Regex, normalizers

from siltbed.llm.common import quoted, slices, text_of, utf8

WORDS = 300_000         # encoded words a worker keeps
CHUNK = 2_000_000       # bytes of text whose new words are encoded together
SYMBOLS = 4_000_000     # symbols in one flat array
PLANES = 0x40000        # the planes above hold no letters and no numbers
LONG = np.int64(1) << 62
# White space as the vocabulary's own patterns take it.
SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"


def byte_characters() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b if b in plain else next(spare)) for b in range(256)]


class Letters(NamedTuple):
    """Where the library's tables of letters are of another age than those used here."""

    classes: dict[str, tuple[str, str]]     # per class the characters it has more and less than in ``regex``
    lower: dict[str, str]                   # lower-case forms that aren't Python's


@cache
def library_letters() -> Letters:
    """Asked of the library itself; made once, by the driver."""
    every = "".join(chr(c) for c in range(0x80, PLANES) if not 0xD800 <= c < 0xE000)

    def changed(change: Callable[[str], str], text: str) -> str:
        return "".join(change(text[i:i + 2048]) for i in range(0, len(text), 2048))

    classes = {}
    for name in "LN":
        kind, mark = rf"\p{{{name}}}", "\0"
        theirs = changed(normalizers.Replace(Regex(kind), mark).normalize_str, every)
        pairs = list(zip(every, theirs, regex.sub(kind, mark, every)))
        classes[name] = ("".join(c for c, x, y in pairs if x == mark != y), "".join(c for c, x, y in pairs if y == mark != x))
    lowered = changed(normalizers.Lowercase().normalize_str, "\n".join(every)).split("\n")
    return Letters(classes, {c: x for c, x in zip(every, lowered) if x != c.lower()})


class Words:
    """All matches of a pattern in a text, letters and numbers being what the library takes for them."""

    def __init__(self, pattern: str, letters: Letters):
        self.usual, self.pattern, self.letters = regex.compile(pattern).findall, pattern, letters
        self.odd = frozenset("".join(chain.from_iterable(letters.classes.values())))
        self.exact = None

    def __call__(self, text: str) -> list[str]:
        if text.isascii() or self.odd.isdisjoint(text):
            return self.usual(text)
        if self.exact is None:
            exact = self.pattern
            for name, (more, less) in self.letters.classes.items():
                kind = f"[\\p{{{name}}}{more}]"
                exact = exact.replace(f"\\p{{{name}}}", f"[{kind}--[{less}]]" if less else kind)
            self.exact = regex.compile(exact, regex.V1).findall
        return self.exact(text)


class Bpe:
    """A vocabulary file with word ends or byte-level words, without a decoder of its own."""

    def __init__(self, definition: str, letters: Letters | None = None):
        spec = json.loads(definition)
        letters = letters or library_letters()
        model, vocab = spec["model"], spec["model"]["vocab"]
        self.suffix = model.get("end_of_word_suffix") or ""
        self.added = {t["content"]: t["id"] for t in spec.get("added_tokens") or []}
        self.token = {i: t for t, i in vocab.items()} | {i: t for t, i in self.added.items()}
        normal = spec.get("normalizer") or {}
        kinds = {n["type"] for n in normal.get("normalizers", [normal] if normal else [])}
        self.nfc, self.lower = "NFC" in kinds, "Lowercase" in kinds
        splits = [p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split"]
        pattern = splits[0]["pattern"]["Regex"]
        self.find_words = Words(pattern.replace("\\s", SPACE), letters)
        self.lower_forms = letters.lower
        self.cut = regex.compile("(" + "|".join(map(regex.escape, sorted(self.added, key=len, reverse=True))) + ")").split \
            if self.added else None

        chars = byte_characters()
        self.first = np.array([vocab.get(c, -1) for c in chars])
        self.last = np.array([vocab.get(c + self.suffix, -1) for c in chars])
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        left, right = (np.array([vocab[p[i]] for p in pairs], np.int64) for i in (0, 1))
        self.base = np.int64(len(self.token) + 1)
        keys = left * self.base + right
        order = np.argsort(keys, kind="stable")
        self.keys, self.rank = keys[order], order
        self.made = np.array([vocab[a + b] for a, b in pairs])
        # A merge whose parts are made by earlier merges can be done at all its
        # places in one round: what it makes ranks later.
        made_at = {int(m): i for i, m in enumerate(self.made)}
        self.in_order = all(max(made_at.get(int(a), -1), made_at.get(int(b), -1)) < i
                            for i, (a, b) in enumerate(zip(left, right)))
        self.known: dict[str, bytes] = {}

    def words(self, text: str) -> list[str]:
        """Words of a text between added tokens."""
        if self.nfc and not unicodedata.is_normalized("NFC", text):
            text = unicodedata.normalize("NFC", text)
        if self.lower:
            # Letter by letter: no special form of sigma at a word's end.
            if text.isascii() or self.lower_forms.keys().isdisjoint(text):
                text = text.replace("Σ", "σ").lower()
            else:
                text = "".join(self.lower_forms.get(c) or c.lower() for c in text)
        return self.find_words(text)

    def merge(self, words: list[str]) -> list[np.ndarray]:
        """Ids of each word."""
        data = [w.encode("utf-8", "replace") for w in words]
        size = np.fromiter(map(len, data), np.int64, len(data))
        raw = np.frombuffer(b"".join(data), np.uint8)
        symbol, word = self.first[raw], np.repeat(np.arange(len(data)), size)
        ends = np.cumsum(size)[size > 0] - 1
        symbol[ends] = self.last[raw[ends]]
        symbol, word = symbol[symbol >= 0], word[symbol >= 0]
        done_symbol, done_word = [], []
        while len(symbol):
            # Pairs inside a word, with their rank.
            key = symbol[:-1] * self.base + symbol[1:]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            rank = np.append(np.where((self.keys[at] == key) & (word[:-1] == word[1:]), self.rank[at], LONG), LONG)
            starts = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            lowest = np.repeat(np.minimum.reduceat(rank, starts), np.diff(np.r_[starts, len(word)]))
            over = lowest == LONG
            if over.any():
                done_symbol.append(symbol[over])
                done_word.append(word[over])
                symbol, word, rank, lowest = symbol[~over], word[~over], rank[~over], lowest[~over]
                if not len(symbol):
                    break
            hit = np.flatnonzero(rank == lowest)
            if self.in_order:
                # Of hits that overlap, as in "aaa", every second one counts.
                run = np.cumsum(np.r_[True, (np.diff(hit) > 1)]) - 1
                place = np.arange(len(hit)) - np.flatnonzero(np.r_[True, np.diff(hit) > 1])[run]
                hit = hit[place % 2 == 0]
            else:
                hit = hit[np.r_[True, word[hit[1:]] != word[hit[:-1]]]]
            symbol[hit] = self.made[rank[hit]]
            left = np.ones(len(symbol), bool)
            left[hit + 1] = False
            symbol, word = symbol[left], word[left]
        if not done_symbol:
            return [np.zeros(0, np.int64)] * len(words)
        symbol, word = np.concatenate(done_symbol), np.concatenate(done_word)
        order = np.argsort(word, kind="stable")
        return np.split(symbol[order], np.cumsum(np.bincount(word, minlength=len(words)))[:-1])

    def learn(self, words: Iterable[str]) -> None:
        """Encode the words not known yet."""
        if len(self.known) > WORDS:
            self.known.clear()
        new = [w for w in set(words) if w not in self.known]
        for part in slices(new, SYMBOLS):
            for w, ids in zip(new[part], self.merge(new[part])):
                self.known[w] = ids.astype("<u4").tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit numbers."""
        cut = []
        for text in texts:
            # Odd places are added tokens in the text.
            parts = self.cut(text) if self.cut and any(t in text for t in self.added) else [text]
            cut.append([self.words(p) if i % 2 == 0 else p for i, p in enumerate(parts)])
        self.learn(chain.from_iterable(p for parts in cut for p in parts[::2]))
        known = self.known.__getitem__
        return [b"".join(chain.from_iterable(
            map(known, p) if i % 2 == 0 else (self.added[p].to_bytes(4, "little"),) for i, p in enumerate(parts)))
            for parts in cut]

    def decode(self, ids: bytes) -> str:
        """Tokens with a space between; unknown ids are left out."""
        get = self.token.get
        return " ".join(t for t in map(get, np.frombuffer(ids, "<u4").tolist()) if t is not None)


def _shared(docs: DataFrame, path: str) -> Broadcast:
    """The vocabulary file, read here and sent to the tasks with the library's letters; its size is that of the file."""
    with open(path, encoding="utf-8") as f:
        return docs.sparkSession.sparkContext.broadcast((f.read(), library_letters()))


def _batches(model: Bpe, batch: pd.Series) -> Iterator[bytes]:
    for part in slices(batch.array, CHUNK):
        yield from model.encode([text_of(x) for x in batch.array[part]])


def tokens_column(docs: DataFrame, path: str, text_col: str = "text") -> Column:
    """struct(ids array<int>, decoded) of a text column of ``docs``; null is empty."""
    shared = _shared(docs, path)

    @F.pandas_udf("ids array<int>, decoded string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = Bpe(*shared.value)
        for batch in batches:
            rows = [(np.frombuffer(ids, "<i4"), model.decode(ids)) for ids in _batches(model, batch)]
            yield pd.DataFrame(rows, columns=["ids", "decoded"])

    return run(utf8(quoted(text_col)))


def digest(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) for every row of ``docs``.

    Null texts are empty and have no tokens. Digests are made where the ids are, so
    neither ids nor decoded texts are shipped.
    """
    shared = _shared(docs, path)

    @F.pandas_udf("n_tokens long, ids_sha256 string, decoded_sha256 string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = Bpe(*shared.value)
        for batch in batches:
            rows = [(len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(model.decode(ids).encode()).hexdigest())
                    for ids in _batches(model, batch)]
            yield pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select(quoted(id_col).alias("doc_id"), run(utf8(quoted(text_col))).alias("r")).select("doc_id", "r.*")
