import numpy as np
import pytest

from siltbed.llm import cotrain
from siltbed.llm.queries import op1_cotraining

SF = "/root/testdata/sf0.1"


def test_views_teach_each_other():
    """The second view knows more than its few labels say, once the first has labelled the pool."""
    rng = np.random.default_rng(1)
    truth = rng.integers(0, 2, 4000)
    a = truth[:, None] * 3.0 + rng.normal(size=(4000, 2))
    b = np.c_[truth * 1.5, -truth * 1.5, truth * 1.0] @ rng.normal(size=(3, 6)) + rng.normal(size=(4000, 6))
    y = np.where(np.arange(4000) < 60, truth, -1)
    model = cotrain.fit((a, b), y)
    rest = np.arange(4000) >= 60
    found = cotrain.predict(model, (a, b))
    alone = cotrain.Logistic.fit(b[:60], y[:60].astype(float))
    right = ((found[:, 1] > 0.5) == truth)[rest].mean()
    assert right >= ((alone.logit(b) > 0) == truth)[rest].mean()
    assert ((found[:, 2] > 0.5) == truth)[rest].mean() > 0.95


def test_scores_are_calibrated():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(6000, 1))
    y = (rng.random(6000) < 1 / (1 + np.exp(-2 * x[:, 0]))).astype(int)
    model = cotrain.fit((x, rng.normal(size=(6000, 2))), y)
    p = cotrain.predict(model, (x, rng.normal(size=(6000, 2))))[:, 2]
    for low in (0.1, 0.3, 0.5, 0.7):
        band = (p >= low) & (p < low + 0.2)
        assert abs(y[band].mean() - p[band].mean()) < 0.08


@pytest.mark.parametrize("labels", [[], [(1, 1)], [(1, None), (None, 0)], [(1, 0), (1, 1), (2, 1)]])
def test_thin_labels_give_no_opinion(spark, make_docs, labels):
    docs = make_docs([(1, "text here"), (2, None), (None, "")])
    model = cotrain.train(docs, spark.createDataFrame(labels, "doc_id long, quality int"))
    assert [r["score"] for r in cotrain.scored(docs, model).collect()] == [0.5] * 3


def test_rows(spark, make_docs, prose):
    good = [(i, prose(80, i)) for i in range(120)]
    bad = [(1000 + i, " ".join(w + "$$$" for w in prose(80, i + 300).split())) for i in range(120)]
    labels = spark.createDataFrame([(i, int(i < 1000)) for i, _ in good + bad if i % 3], "doc_id long, quality int")
    model = cotrain.train(make_docs(good + bad), labels)
    odd = [(5000, None), (5001, ""), (5002, "word " * 40_000), (None, prose(50, 7)), (7, good[7][1]), (7, good[7][1])]
    docs = make_docs(good + bad + odd)
    got = cotrain.scored(docs, model).collect()
    assert len(got) == len(good) + len(bad) + len(odd) and all(0 <= r["score"] <= 1 for r in got)
    assert all((r["score"] > 0.5) == (r["doc_id"] < 1000) for r in got if r["doc_id"] is not None and r["doc_id"] < 2000)
    assert cotrain.scored(make_docs([]), model).collect() == []


def test_null_metadata(spark):
    docs = spark.createDataFrame([(1, "a text", None, None, None), (2, "b", "en", "s", 3)],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    assert len(cotrain.scored(docs, None).collect()) == 2


def test_held_out_accuracy(spark):
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    rows = op1_cotraining(spark, SF).collect()
    held = [(r["predicted"], labels[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in labels]
    assert len(rows) == 10_000
    assert np.mean([p == y for p, y in held]) > 0.97
    assert np.mean([p for p, y in held if y]) > 0.99
