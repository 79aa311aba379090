"""Toxicity by multiple-instance learning: sentences are scored, documents labelled.

A sentence's probability is a logistic function of its distinct words, each with
hashed features (the word and its prefixes), the same in every text. A passage's is
the noisy-or of its sentences, ``1 - prod(1 - p)``, and a document's that of its worst
passage of ``USUAL`` sentences, which is what the labels train; the sentence
probabilities then tell which sentences offend. So a text doesn't become suspect by its
length alone, and doesn't become less so by what is added before or after it.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltbed.llm.common import free_name, quoted, text_of, utf8

TRAIN_ROWS = 8_000      # labelled rows the model is fitted on, by hash of their id
DIM = 1 << 20           # hashed features
PREFIXES = range(3, 9)
LEAST_DOCS = 3          # training documents a feature must occur in
EVIDENCE = 0.25
STEPS, RATE, START = 200, 0.1, -6.0
USUAL = 20              # sentences of a passage
THRESHOLD = 0.3
WORD_CACHE = 400_000

_SENTENCE = re.compile(r"[^.!?\n]+")
_WORD = re.compile(r"[^\W\d_]+")

MODEL = "feature int, weight float"     # feature -1 is the bias


def features(word: str) -> list[int]:
    word = word[:64]
    parts = [word + "$", *(word[:n] for n in PREFIXES if n < len(word))]
    return [zlib.crc32(p.encode("utf-8", "replace")) % DIM for p in parts]


def shares(p: np.ndarray) -> np.ndarray:
    """The probabilities inside the worst passage, zero elsewhere."""
    if len(p) <= USUAL:
        return p
    sums = np.cumsum(np.r_[0.0, np.log1p(-p)])
    at = int(np.argmin(sums[USUAL:] - sums[:-USUAL]))
    out = np.zeros(len(p))
    out[at:at + USUAL] = p[at:at + USUAL]
    return out


def fit(texts: list[str], labels: np.ndarray) -> pd.DataFrame:
    """Weights that maximise the likelihood of the documents' labels.

    Without a row of each class all weights are 0 and the bias stays at its start.
    """
    words: dict[str, int] = {}
    token, length, per_doc = [], [], []
    for text in texts:
        own = [list({words.setdefault(w, len(words)) for w in _WORD.findall(s)})
               for s in _SENTENCE.findall(text.lower())]
        token.append(np.fromiter(chain.from_iterable(own), np.int32))
        length += map(len, own)
        per_doc.append(len(own))
    y = np.asarray(labels, float)
    if not words or y.min() == y.max():
        return pd.DataFrame({"feature": np.array([-1], np.int32), "weight": np.array([START], np.float32)})
    sentence_doc = np.repeat(np.arange(len(texts)), per_doc)
    token_sentence = np.repeat(np.arange(len(length)), length)
    token = np.concatenate(token)
    listed = [features(w) for w in words]
    word_of = np.repeat(np.arange(len(listed)), list(map(len, listed)))
    used, feature = np.unique(np.fromiter(chain.from_iterable(listed), np.int64), return_inverse=True)
    # Documents per feature, through the distinct (document, word) pairs; features of
    # few documents go, and words without any with them.
    pairs = np.unique(sentence_doc[token_sentence] * np.int64(len(listed)) + token) % len(listed)
    docs_of_word = np.bincount(pairs, minlength=len(listed))
    common = np.bincount(feature, docs_of_word[word_of], len(used)) >= LEAST_DOCS
    word_of, feature = word_of[common[feature]], feature[common[feature]]
    alive = np.zeros(len(listed), bool)
    alive[word_of] = True
    token_sentence, token = token_sentence[alive[token]], token[alive[token]]

    # Passages of texts with more than USUAL sentences, by their first sentence.
    size = np.array(per_doc)
    place = np.arange(len(length)) - np.repeat(np.cumsum(size) - size, size)
    long = np.flatnonzero(size > USUAL)
    begin = np.flatnonzero((size > USUAL)[sentence_doc] & (place <= size[sentence_doc] - USUAL))
    heads = np.flatnonzero(place[begin] == 0)
    outside = (size > USUAL)[sentence_doc]
    weight, bias = np.zeros(len(used)), START
    m, v, mb, vb = np.zeros(len(used)), np.zeros(len(used)), 0.0, 0.0
    for step in range(1, STEPS + 1):
        word_score = np.bincount(word_of, weight[feature], len(listed))
        z = np.bincount(token_sentence, word_score[token], len(length)) + bias
        p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        # log of the chance that no sentence offends, and its slope in the loss
        added = np.logaddexp(0, np.minimum(z, 30))
        counts = ~outside
        if len(long):
            sums = np.cumsum(np.r_[0.0, added])
            passage = sums[begin + USUAL] - sums[begin]
            worst = np.lexsort((-passage, sentence_doc[begin]))[heads]
            counts[(begin[worst][:, None] + np.arange(USUAL)).ravel()] = True
        none = np.bincount(sentence_doc, np.where(counts, added, 0), len(texts))
        slope = np.where(y > 0, -1 / np.expm1(np.clip(none, 1e-6, 50)), 1.0) / len(texts)
        grad_z = np.where(counts, slope[sentence_doc] * p, 0)
        grad_word = np.bincount(token, grad_z[token_sentence], len(listed))
        grad = np.bincount(feature, grad_word[word_of], len(used))
        grad_b = grad_z.sum()
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad ** 2
        mb, vb = 0.9 * mb + 0.1 * grad_b, 0.999 * vb + 0.001 * grad_b ** 2
        fix1, fix2 = 1 - 0.9 ** step, 1 - 0.999 ** step
        pace = RATE / (np.sqrt(v / fix2) + 1e-8)
        weight -= pace * m / fix1
        # Features that less than EVIDENCE documents speak for go back to nothing.
        weight = np.sign(weight) * np.maximum(np.abs(weight) - pace * EVIDENCE / len(texts), 0)
        bias -= RATE * (mb / fix1) / (np.sqrt(vb / fix2) + 1e-8)
    on = np.flatnonzero(weight)
    return pd.DataFrame({"feature": np.r_[-1, used[on]].astype(np.int32),
                         "weight": np.r_[bias, weight[on]].astype(np.float32)})


def train(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic", usable: Callable[[Column], Column] | None = None,
          rows: int = TRAIN_ROWS) -> pd.DataFrame:
    """The model from at most ``rows`` labelled documents whose id is ``usable``.

    Null labels and ids are left out, of several labels of an id the largest counts.
    The sample is the ids with the least hashes, so it doesn't depend on order. One
    task fits it; the model has at most ``DIM`` + 1 rows.
    """
    ident, label = quoted(id_col), quoted(label_col)
    known = labels.filter(ident.isNotNull() & label.isNotNull())
    if usable is not None:
        known = known.filter(usable(ident))
    known = known.groupBy(ident.alias("id")).agg(F.max(label).cast("int").alias("label"))
    known = known.orderBy(F.xxhash64("id"), "id").limit(rows)
    sample = docs.select(ident.alias("id"), utf8(quoted(text_col)).alias("text")).join(F.broadcast(known), "id")

    def task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts = list(batches)
        if parts:
            rows = pd.concat(parts).sort_values(["id", "text"])
            yield fit([text_of(x) for x in rows["text"]], rows["label"].to_numpy())

    return sample.repartition(1).mapInPandas(task, MODEL).toPandas()


def _chance(logits: list[float]) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(np.array(logits, float), -30, 30)))


class Scorer:
    """Sentence scores with a model; word scores are kept, up to a number of words."""

    def __init__(self, model: pd.DataFrame):
        self.weight = np.zeros(DIM, np.float32)
        feature, weight = model["feature"].to_numpy(), model["weight"].to_numpy()
        self.weight[feature[feature >= 0]] = weight[feature >= 0]
        self.bias = float(weight[feature < 0][0]) if (feature < 0).any() else START
        self.known: dict[str, float] = {}

    def word(self, word: str) -> float:
        found = self.known.get(word)
        if found is None:
            if len(self.known) >= WORD_CACHE:
                self.known.clear()
            found = self.known[word] = float(self.weight[features(word)].sum(dtype=np.float64))
        return found

    def own(self, text: str) -> tuple[list[tuple[int, int]], np.ndarray]:
        """Spans in code points, and each sentence's own probability."""
        low = text.lower()
        # A few characters change length in lower case; then sentences are cut first.
        found = list(_SENTENCE.finditer(low if len(low) == len(text) else text))
        z = [self.bias + sum(map(self.word, sorted(set(_WORD.findall(m[0].lower()))))) for m in found]
        return [m.span() for m in found], _chance(z)

    def sentences(self, text: str) -> tuple[list[tuple[int, int]], np.ndarray]:
        """Spans in code points, and what each adds to the document's noisy-or."""
        spans, p = self.own(text)
        return spans, shares(p)


def score_column(text: Column, model: pd.DataFrame) -> Column:
    """struct(score, starts, ends): noisy-or, and the sentences over the threshold."""
    shared = model

    @F.pandas_udf("score double, starts array<int>, ends array<int>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        scorer = Scorer(shared)
        for batch in batches:
            out = []
            for data in batch:
                spans, p = scorer.own(text_of(data))
                bad = np.flatnonzero(p >= THRESHOLD)
                out.append((float(-np.expm1(np.log1p(-shares(p)).sum())), [spans[i][0] for i in bad], [spans[i][1] for i in bad]))
            yield pd.DataFrame(out, columns=["score", "starts", "ends"])

    return run(utf8(text))


def with_scores(docs: DataFrame, model: pd.DataFrame, text_col: str = "text", name: str = "_toxicity") -> tuple[DataFrame, str]:
    """``docs`` and a column (named so that it clashes with none) of ``score_column``.

    Empty and null texts have no sentence and score 0.
    """
    name = free_name(docs, name)
    return docs.withColumn(name, score_column(quoted(text_col), model)), name


def clean(docs: DataFrame, model: pd.DataFrame, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that score below ``threshold``, with their columns."""
    scored, name = with_scores(docs, model, text_col)
    return scored.filter(quoted(name)["score"] < threshold).select(*map(quoted, docs.columns))


def fold(ident: Column) -> Column:
    """The remainder by 4 of the CRC-32 of an id written as text; null as empty."""
    return F.pmod(F.crc32(F.coalesce(ident.cast("string"), F.lit("")).cast("binary")), F.lit(4))
