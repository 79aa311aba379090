"""Quality by co-training: a text view and a metadata view teach each other.

Each view has a logistic model of its own features. In every round each model labels
the rows of an unlabelled pool that it is surest of, and those labels train the other
model in the next round. Both are then calibrated on labelled rows that took no part
in training, and a score joins the two calibrated views.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltbed.llm.common import quoted, text_of, utf8

LABELLED, POOL = 8_000, 16_000      # rows of the fitting sample, by hash of their id
ROUNDS, ADDED, SURE = 5, 200, 0.95  # pool rows a view labels per round and class, and how sure it must be
BUCKETS = 64                        # hashed values of a metadata column
THRESHOLD = 0.5

_WORD = re.compile(r"[^\W\d_]+")
_UPPER = re.compile(r"[^\W\d_a-z]{3,}")
_SYMBOL = re.compile(r"[^\w\s.,;:'\"?()-]")
_RUN = re.compile(r"([^\w\s])\1+")

CONTENT = 14


def content(text: str) -> list[float]:
    """Features of the whole text; an empty one has zeros but for the last."""
    words = text.split()
    if not words:
        return [0.0] * (CONTENT - 1) + [1.0]
    n, size = len(words), len(text)
    lines = [x for x in text.split("\n") if x.strip()]
    letters = sum(map(len, _WORD.findall(text)))
    pairs = set(zip(words, words[1:]))
    return [
        np.log1p(n), size / n, letters / size, len(_SYMBOL.findall(text)) / n, len(_RUN.findall(text)) / n,
        len(_UPPER.findall(text)) / n, sum(c.isdigit() for c in text) / size, len(set(words)) / n,
        len(pairs) / max(1, n - 1), len(set(lines)) / len(lines), np.log1p(n / len(lines)),
        text.count("|") / n, (text.count(".") + text.count(",")) / n, 0.0]


def metadata(values: list, length: float) -> list[float]:
    """Hashed values of the categorical columns, then the length."""
    out = [0.0] * (BUCKETS * len(values))
    for i, v in enumerate(values):
        out[i * BUCKETS + zlib.crc32(f"{v}".encode("utf-8", "replace")) % BUCKETS] = 1.0
    size = np.log1p(max(0.0, length))
    return [*out, size / 10, (size / 10) ** 2]


class Logistic:
    """Logistic regression on standardised features, by Newton steps."""

    def __init__(self, mean, scale, weight):
        self.mean, self.scale, self.weight = (np.asarray(x, float) for x in (mean, scale, weight))

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray, share: np.ndarray | None = None, decay: float = 1.0) -> Logistic:
        share = np.ones(len(y)) if share is None else share
        mean, scale = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-6)
        z = np.clip(np.c_[(x - mean) / scale, np.ones(len(x))], -8, 8)
        w, penalty = np.zeros(z.shape[1]), np.r_[np.full(x.shape[1], decay), 1e-3]
        for _ in range(25):
            p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
            grad = z.T @ (share * (p - y)) + penalty * w
            step = np.linalg.solve((z * (share * p * (1 - p) + 1e-9)[:, None]).T @ z + np.diag(penalty), grad)
            w -= step * min(1.0, 5 / (np.abs(step).max() + 1e-12))
            if np.abs(step).max() < 1e-6:
                break
        return cls(mean, scale, w)

    def logit(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -8, 8)
        return np.clip(z @ self.weight[:-1] + self.weight[-1], -30, 30)


def _chance(logit: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-logit))


def fit(views: tuple[np.ndarray, np.ndarray], y: np.ndarray) -> dict | None:
    """The joint model; ``y`` is -1 for rows without a label. None without both classes."""
    labelled = np.flatnonzero(y >= 0)
    train, hold = labelled[labelled % 4 != 0], labelled[labelled % 4 == 0]
    if len(set(y[train])) < 2 or len(set(y[hold])) < 2:
        return None
    pool = np.flatnonzero(y < 0)
    taught = [dict(zip(train.tolist(), y[train].tolist())) for _ in views]
    models = []
    for _ in range(ROUNDS + 1):
        models = []
        for x, own in zip(views, taught):
            rows = np.fromiter(own, np.int64)
            models.append(Logistic.fit(x[rows], np.array([own[r] for r in rows], float)))
        for teacher, x, learner in zip(models, views, reversed(taught)):
            p = _chance(teacher.logit(x[pool])) if len(pool) else np.zeros(0)
            for label, sure in ((1, p), (0, 1 - p)):
                best = np.argsort(-sure, kind="stable")
                best = best[sure[best] >= SURE]
                fresh = [r for r in pool[best].tolist() if r not in learner][:ADDED]
                learner.update(dict.fromkeys(fresh, label))
    # Each view's own scale, then both together, on rows neither was trained with.
    logits = [m.logit(x[hold]) for m, x in zip(models, views)]
    scales = [Logistic.fit(s[:, None], y[hold].astype(float)) for s in logits]
    both = np.stack([c.logit(s[:, None]) for c, s in zip(scales, logits)], axis=1)
    return {"views": models, "scales": scales, "joint": Logistic.fit(both, y[hold].astype(float))}


def predict(model: dict | None, views: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """(content, metadata, joint) chances per row; all 0.5 without a model."""
    if model is None:
        return np.full((len(views[0]), 3), 0.5)
    both = np.stack([c.logit(m.logit(x)[:, None]) for m, c, x in zip(model["views"], model["scales"], views)], axis=1)
    return np.c_[_chance(both), _chance(model["joint"].logit(both))]


def train(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
          meta_cols: tuple[str, ...] = ("lang", "source"), length_col: str = "n_chars", label_col: str = "quality",
          usable: Callable[[Column], Column] | None = None) -> dict | None:
    """The model from bounded samples of labelled rows and of the other documents."""
    ident, label = quoted(id_col), quoted(label_col)
    known = labels.filter(ident.isNotNull() & label.isNotNull())
    if usable is not None:
        known = known.filter(usable(ident))
    known = known.groupBy(ident.alias("id")).agg(F.max(label).cast("int").alias("y"))
    known = known.orderBy(F.xxhash64("id"), "id").limit(LABELLED)
    other = docs.select(ident.alias("id")).filter("id IS NOT NULL").join(
        labels.select(ident.alias("id")), "id", "left_anti").distinct().withColumn("y", F.lit(-1))
    if usable is not None:
        other = other.filter(usable(F.col("id")))
    other = other.orderBy(F.xxhash64("id"), "id").limit(POOL)
    rows = docs.select(ident.alias("id"), utf8(quoted(text_col)).alias("text"),
                       F.array(*(quoted(c).cast("string") for c in meta_cols)).alias("meta"),
                       F.coalesce(quoted(length_col).cast("double"), F.lit(0.0)).alias("length"))
    sample = rows.join(F.broadcast(known.unionByName(other)), "id")

    def view(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"id": b["id"], "y": b["y"], "a": [content(text_of(x)) for x in b["text"]],
                                "b": [metadata(list(m), n) for m, n in zip(b["meta"], b["length"])]})

    # At most LABELLED + POOL short rows of numbers.
    got = sample.mapInPandas(view, "id long, y int, a array<double>, b array<double>").toPandas()
    if not len(got):
        return None
    got = got.sort_values(["id", "y"], kind="stable")
    return fit((np.stack(got["a"].to_numpy()), np.stack(got["b"].to_numpy())), got["y"].to_numpy())


def scored(docs: DataFrame, model: dict | None, *, id_col: str = "doc_id", text_col: str = "text",
           meta_cols: tuple[str, ...] = ("lang", "source"), length_col: str = "n_chars") -> DataFrame:
    """(doc_id, content_score, metadata_score, score) for every row; higher is better.

    Null texts count as empty, null metadata as a value of its own, null lengths as 0.
    """
    @F.pandas_udf("content_score double, metadata_score double, score double")
    def run(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for texts, metas, lengths in batches:
            views = (np.array([content(text_of(x)) for x in texts]),
                     np.array([metadata(list(m), n) for m, n in zip(metas, lengths)]))
            yield pd.DataFrame(predict(model, views) if len(texts) else np.zeros((0, 3)),
                               columns=["content_score", "metadata_score", "score"])

    return docs.select(quoted(id_col).alias("doc_id"), run(
        utf8(quoted(text_col)), F.array(*(quoted(c).cast("string") for c in meta_cols)),
        F.coalesce(quoted(length_col).cast("double"), F.lit(0.0))).alias("r")).select("doc_id", "r.*")
