"""Personal data: fixed rules, and a linear-chain conditional random field beside them.

The field labels tokens over word-shape features of a window of five tokens. It is
trained from the small labelled table below by its exact gradient (forward and
backward sums) and decoded by Viterbi over numpy batches. Tokens whose shape makes
"other" win against any neighbours are decided at once, which cuts a text into the
short runs that Viterbi then sees, many at a time; the result is the same as over
whole lines, and no text is too long.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltbed.llm.common import free_name, quoted, slices, text_of, utf8

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "secret", "local_phone", "national_id")
LABELS = ("other", "secret", "local_phone", "national_id")
CHUNK = 2_000_000       # characters decoded at a time
SHAPES = 400_000        # tokens whose shape a worker remembers
OFFSETS = (-2, -1, 0, 1, 2)
STEPS, RATE, DECAY = 250, 0.1, 0.01

# The labelled table: one line each, spans in square brackets after their kind.
LABELLED = """\
and the key was token = "secret[04dbebab91ab85687d33eeaaf9ac699e1188f962]" in the file
he said token = "secret[f3ef4d6b2755a36d7d9c25bd72c4d5f67e061fda]" und das ist
| de la | token = "secret[9b0b3c6a43eb78aa99cbd7049c572391524f37a8]" | que | la
TOKEN = "secret[9233A8ECF7C5B09FE594904DBEBAB91AB85687D3]" AND THE!! OF!!
api_key = "secret[a8Fk29dkLs02Kd93kGh47sPq]"
api_key: secret[k29DmzQ81ksPw03nRt5xYv7b] # do not share
password = "secret[hunter2hunter2]" for the login
password: secret[Tr0ub4dor3x] then more words
secret = 'secret[5f4dcc3b5aa765d61d8327deb882cf99]'
Call us at local_phone[(243) 555-5526] tonight
phone local_phone[(068) 555-1234] or write
tel. local_phone[030 1234567] in der Stadt
Tel: local_phone[0171 2345678], oder morgen
my phone is local_phone[555-0134] thanks
her number local_phone[415-555-0199] is new
SSN national_id[123-45-6789] on file
ssn: national_id[987-65-4320] and name
the ssn national_id[219-09-9999] of him
token of thanks, the token was a word and the key is here
he gave a token = "word" and said no more
the password was lost and the secret is out
a phone call, my phone is here and the number is two
Licensed under the Apache License, Version 2.0.
GNU General Public License, version 3.
Licensed under CC BY-NC 4.0.
and thereof in 1995 and 2001-08-01 it was
between 10-20 people and 3-4 more at 10:30
price 1234567 and 4845168114407329 units of it
97.51.17.173 ueadoos 9807915762804490 raie
+1 (017) 555-7713 rethsh on it
write to and.34@mail7.example.com at once
4916 3385 3464 4881 was the number
the commit 269b1cea0846965f2d3ec487f1cf7f4be1eab0ad fixed it
see page 12 of 340 and section 4.2.1
http://ththre.example.com/fr/825?page=2&ref=x
de la que el, y los de la ciudad en un
Die und der, das ist nicht so. Und es
THE!! AND!! OF,!! IT!! WAS.
the*** and$$$ of%%% in&&& that### it.
le la | les | des, | un | une
it it it it it it it it it it
Than heoron eratsh therin blees sh in esheon erstlyat.
isbn 978-3-16-148410-0 of the book
on 2024-01-30 at 14:05:09 the 555 buses
order 12345-678 shipped, 100-200 left""".splitlines()

_TOKEN = re.compile(r"\w+|[^\w\s]|\n")
_MARK = re.compile(r"(secret|local_phone|national_id)\[([^\]]*)\]")
_CUES = frozenset("token api_key key password passwd secret phone tel number ssn call isbn order commit".split())

_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the fixed rules, sorted."""
    found, past = [], 0
    for m in _DOMAIN.finditer(text):
        # The local part is the run before the sign, not into the last match.
        at = m.start()
        low = max(past, text.rfind("@", past, at) + 1)
        start = low + len(text[low:at].rstrip(_LOCAL))
        if start < at:
            found.append((start, 0, m.end()))
            past = m.end()
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            found.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        if 14 <= m.end() - m.start() <= 37:
            digits = "".join(_DIGIT.findall(m[0]))
            if 14 <= len(digits) <= 19 and luhn(digits):
                found.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 10 <= len(_DIGIT.findall(m[0])) <= 15:
                found.append((m.start(), 3, m.end()))
    return sorted(found)


def shape(token: str) -> tuple[str, ...]:
    """Features of a token: its cue word, class, and class with length."""
    if not token[0].isalnum() and token[0] != "_":
        return (f"p{token}" if token < "\x7f" else "p",)
    n = len(token)
    size = next(s for s in (1, 2, 3, 4, 7, 10, 15, 24, 1 << 62) if n <= s)
    low = token.lower()
    if token.isdigit():
        kind = "digits"
    elif token.isalpha():
        kind = "lower" if token == low else "upper" if token.isupper() else "title" if token.istitle() else "case"
    elif any(c.isdigit() for c in token):
        kind = "hex" if all(c in "0123456789abcdef" for c in low) else "mixed"
    else:
        kind = "joined"
    found = (kind, f"{kind}{size}")
    return (*found, f"w{low}") if low in _CUES else found


def _parse(line: str) -> tuple[str, list[tuple[int, int, int]]]:
    plain, spans, at = "", [], 0
    for m in _MARK.finditer(line):
        plain += line[at:m.start()]
        spans.append((len(plain), len(plain) + len(m[2]), LABELS.index(m[1])))
        plain, at = plain + m[2], m.end()
    return plain + line[at:], spans


def _sum_exp(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis=axis))


class Field:
    """Weights per window place and feature, and per pair of labels."""

    def __init__(self, weights: dict[str, np.ndarray], step: np.ndarray):
        self.weights, self.step = weights, step
        k = len(LABELS)
        self.rows: dict[tuple[str, ...], int] = {}
        self.table = np.zeros((0, len(OFFSETS), k))
        self.known: dict[str, int] = {}
        # The most that labelling a token otherwise can win from its neighbours.
        gain = step[:, None, :] + step.T[None, :, :] - step[:, 0][:, None, None] - step[0][None, :, None]
        self.swing = float(gain[:, :, 1:].max())

    def _row(self, token: str) -> int:
        found = self.known.get(token)
        if found is None:
            if len(self.known) >= SHAPES:
                self.known.clear()
            parts = shape(token)
            found = self.rows.setdefault(parts, len(self.rows))
            if found == len(self.table):
                zero = np.zeros((len(OFFSETS), len(LABELS)))
                self.table = np.concatenate([self.table, sum((self.weights.get(p, zero) for p in parts), zero)[None]])
            self.known[token] = found
        return found

    def emissions(self, tokens: list[str]) -> np.ndarray:
        rows = np.fromiter(map(self._row, tokens), np.int64, len(tokens))
        out = np.zeros((len(tokens), len(LABELS)))
        for i, o in enumerate(OFFSETS):
            to, of = slice(max(0, -o), len(tokens) - max(0, o)), slice(max(0, o), len(tokens) - max(0, -o))
            out[to] += self.table[rows[of], i]
        return out

    def decode(self, tokens: list[str]) -> np.ndarray:
        """Best labels; line ends are "other"."""
        if not tokens:
            return np.zeros(0, np.int64)
        e = self.emissions(tokens)
        open_ = (e[:, 0] - e[:, 1:].max(axis=1)) <= self.swing
        open_ &= np.fromiter((t != "\n" for t in tokens), bool, len(tokens))
        labels = np.zeros(len(tokens), np.int64)
        edge = np.diff(np.r_[False, open_, False].astype(np.int8))
        first, last = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        by_len = np.argsort(first - last, kind="stable")
        first, size = first[by_len], (last - first)[by_len]
        for at in range(0, len(first), 4_096):
            self._viterbi(e, first[at:at + 4_096], size[at:at + 4_096], labels)
        return labels

    def _viterbi(self, e: np.ndarray, first: np.ndarray, size: np.ndarray, labels: np.ndarray) -> None:
        """Runs between "other" tokens, longest first; steps touch the runs still going."""
        best, back, ends = e[first] + self.step[0], [], np.zeros(len(first), np.int64)
        for t in range(int(size[0])):
            going = int(np.searchsorted(-size, -t, side="left"))
            if t:
                paths = best[:going, :, None] + self.step
                back.append(paths.argmax(axis=1))
                best[:going] = paths.max(axis=1) + e[first[:going] + t]
            ending = slice(int(np.searchsorted(-size, -(t + 1), side="left")), going)
            ends[ending] = (best[ending] + self.step[:, 0]).argmax(axis=1)
        here = ends
        for t in range(int(size[0]) - 1, -1, -1):
            going = int(np.searchsorted(-size, -t, side="left"))
            labels[first[:going] + t] = here[:going]
            if t:
                here[:going] = back[t - 1][np.arange(going), here[:going]]


def fit(lines: list[str]) -> Field:
    """A field that maximises the likelihood of marked lines, with a small square penalty."""
    k, names, sequences = len(LABELS), {}, []
    for line in lines:
        plain, spans = _parse(line)
        matches = list(_TOKEN.finditer(plain))
        y = [next((s[2] for s in spans if s[0] <= m.start() < s[1]), 0) for m in matches]
        # Both ends stand beside line ends, which are "other".
        tokens = ["\n", "\n", *(m[0] for m in matches), "\n", "\n"]
        sequences.append(([[names.setdefault(p, len(names)) for p in shape(t)] for t in tokens], y))
    n, width = len(sequences), max(len(y) for _, y in sequences)
    seen = np.zeros((n, width, len(OFFSETS), len(names)))
    gold, there = np.zeros((n, width), int), np.zeros((n, width), bool)
    for s, (listed, y) in enumerate(sequences):
        gold[s, :len(y)], there[s, :len(y)] = y, True
        for t in range(len(y)):
            for i, o in enumerate(OFFSETS):
                seen[s, t, i, listed[t + 2 + o]] = 1
    seen = seen.reshape(n, width, -1)
    last = there.sum(axis=1) - 1
    row = np.arange(n)
    target = np.eye(k)[gold] * there[..., None]
    both = there[:, 1:]
    w, step = np.zeros((seen.shape[2], k)), np.zeros((k, k))
    moments = [np.zeros_like(w), np.zeros_like(w), np.zeros_like(step), np.zeros_like(step)]
    for it in range(1, STEPS + 1):
        e = seen @ w
        ahead, behind = np.zeros_like(e), np.zeros_like(e)
        ahead[:, 0] = e[:, 0] + step[0]
        for t in range(1, width):
            ahead[:, t] = e[:, t] + _sum_exp(ahead[:, t - 1, :, None] + step, 1)
        log_z = _sum_exp(ahead[row, last] + step[:, 0], 1)
        behind[:, -1] = step[:, 0]
        for t in range(width - 2, -1, -1):
            on = _sum_exp(step + (e[:, t + 1] + behind[:, t + 1])[:, None], 2)
            behind[:, t] = np.where((last == t)[:, None], step[:, 0], on)
        share = np.exp(np.minimum(ahead + behind - log_z[:, None, None], 0)) * there[..., None]
        off = share - target
        gw = DECAY * w + np.einsum("stf,stk->fk", seen, off)
        # Label pairs: expected less seen, the two ends included.
        pairs = ahead[:, :-1, :, None] + step + (e[:, 1:] + behind[:, 1:])[:, :, None] - log_z[:, None, None, None]
        pairs = np.exp(np.minimum(pairs, 0)) * both[..., None, None]
        gs = DECAY * step + pairs.sum(axis=(0, 1)) - np.einsum("sta,stb->ab", target[:, :-1] * both[..., None], target[:, 1:])
        gs[0] += off[:, 0].sum(axis=0)
        gs[:, 0] += off[row, last].sum(axis=0)
        for x, g, m, v in ((w, gw, *moments[:2]), (step, gs, *moments[2:])):
            m[:] = 0.9 * m + 0.1 * g
            v[:] = 0.999 * v + 0.001 * g * g
            x -= RATE * (m / (1 - 0.9 ** it)) / (np.sqrt(v / (1 - 0.999 ** it)) + 1e-8)
    w = w.reshape(len(OFFSETS), len(names), k)
    return Field({name: w[:, i] for name, i in names.items()}, step)


@lru_cache(maxsize=1)
def trained() -> Field:
    return fit(LABELLED)


def field_spans(field: Field, texts: list[str]) -> list[list[tuple[int, int, int]]]:
    """(start, kind number, end) per text: runs of tokens of one label."""
    tokens: list[str] = []
    bounds = []
    for text in texts:
        tokens += ("\n", "\n")
        start = len(tokens)
        tokens += _TOKEN.findall(text)
        bounds.append((start, len(tokens)))
    tokens += ("\n", "\n")
    labels = field.decode(tokens)
    out = []
    for text, (a, b) in zip(texts, bounds):
        own, spans = labels[a:b], []
        if own.any():
            places = [m.span() for m in _TOKEN.finditer(text)]
            for t in np.flatnonzero(own):
                kind = KINDS.index(LABELS[own[t]])
                if t and own[t - 1] == own[t]:
                    spans[-1] = (spans[-1][0], kind, places[t][1])
                else:
                    spans.append((places[t][0], kind, places[t][1]))
        out.append(spans)
    return out


def find(field: Field, texts: list[str]) -> list[tuple[list, list]]:
    """Per text: base spans, and all spans: the field's where they meet no base span."""
    out = []
    for text, extra in zip(texts, field_spans(field, texts)):
        base = base_spans(text)
        free = [s for s in extra if all(s[2] <= b[0] or b[2] <= s[0] for b in base)] if base else extra
        out.append((base, sorted(base + free)))
    return out


def spans_column(text: Column, field: Field) -> Column:
    """struct(base, spans): arrays of (start, kind number, end), flattened."""
    weights, step = field.weights, field.step

    @F.pandas_udf("base array<int>, spans array<int>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        own = Field(weights, step)
        for batch in batches:
            rows = []
            for part in slices(batch.array, CHUNK):
                rows += find(own, [text_of(x) for x in batch.array[part]])
            yield pd.DataFrame([[[x for s in spans for x in s] for spans in row] for row in rows], columns=["base", "spans"])

    return run(utf8(text))


def as_text(flat: Column) -> Column:
    """kind:start:end, comma-joined."""
    kinds = F.array(*map(F.lit, KINDS))
    one = F.transform(F.sequence(F.lit(0), (F.size(flat) / 3 - 1).cast("int")), lambda i: F.concat_ws(
        ":", F.element_at(kinds, F.element_at(flat, (3 * i + 2).cast("int")) + 1),
        F.element_at(flat, (3 * i + 1).cast("int")).cast("string"), F.element_at(flat, (3 * i + 3).cast("int")).cast("string")))
    return F.when(F.size(flat) > 0, F.array_join(one, ",")).otherwise("")


def count_of(flat: Column, kind: str) -> Column:
    at = KINDS.index(kind)
    return F.size(F.filter(flat, lambda x, i: (i % 3 == 1) & (x == at))).cast("long")


def redact(text: str, spans: list[tuple[int, int, int]]) -> str:
    """Each maximal run of overlapping spans becomes its first span's kind in angle brackets."""
    parts, past = [], 0
    for start, kind, end in spans:
        if start >= past:
            parts += (text[past:start], f"<{KINDS[kind]}>")
        past = max(past, end)
    return "".join(parts) + text[past:]


def redacted(docs: DataFrame, field: Field, text_col: str = "text", length_col: str | None = None) -> DataFrame:
    """``docs`` with spans replaced in the text and ``length_col`` counted anew.

    Null texts stay null; all columns and rows stay.
    """
    weights, step = field.weights, field.step

    @F.pandas_udf("binary")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = Field(weights, step)
        for batch in batches:
            out = []
            for part in slices(batch.array, CHUNK):
                texts = [text_of(x) for x in batch.array[part]]
                out += [redact(t, spans) for t, (_, spans) in zip(texts, find(own, texts))]
            yield pd.Series([x.encode("utf-8", "replace") for x in out], dtype=object)

    name = free_name(docs, "_redacted")
    text = quoted(text_col)
    out = docs.withColumn(name, F.when(text.isNotNull(), run(utf8(text)).cast("string")))
    columns = {text_col: quoted(name)}
    if length_col is not None:
        columns[length_col] = F.coalesce(F.length(quoted(name)), F.lit(0)).cast(docs.schema[length_col].dataType)
    return out.select(*(columns.get(c, quoted(c)).alias(c) for c in docs.columns))


def personal_data(docs: DataFrame, field: Field, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, base, spans) for every row; null and empty texts have no spans."""
    found = docs.select(quoted(id_col).alias("doc_id"), spans_column(quoted(text_col), field).alias("found"))
    return found.select("doc_id", "found.base", "found.spans")
