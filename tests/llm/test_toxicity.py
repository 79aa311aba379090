import zlib

import numpy as np
import pandas as pd
import pytest

from siltbed.llm import toxicity
from siltbed.llm.queries import op9_toxicity, training

BAD = ("grulp", "snarf", "blotz")


def sample(prose, n, start=0):
    rows = []
    for i in range(start, start + n):
        text, label = prose(60, i), i % 4 == 0
        if label:
            text += f" You are a {BAD[i % 3]} here."
        rows.append((i, text, int(label)))
    return rows


def test_learns_words_and_finds_their_sentences(spark, make_docs, prose):
    rows = sample(prose, 240)
    labels = spark.createDataFrame([(i, y, "x") for i, _, y in rows], "doc_id long, toxic int, text string")
    docs = make_docs([r[:2] for r in rows])
    model = toxicity.train(docs, labels, usable=training)
    fresh = sample(prose, 60, 1000) + [(5000, None, 0), (5001, "", 0), (5002, "Fine. " * 20000, 0), (None, "You are a GRULP here!", 1)]
    scored, name = toxicity.with_scores(make_docs([r[:2] for r in fresh]), model)
    want = {i: y for i, _, y in fresh}
    for r in scored.collect():
        assert 0 <= r[name]["score"] <= 1
        assert (r[name]["score"] >= toxicity.THRESHOLD) == bool(want[r["doc_id"]])
        for a, b in zip(r[name]["starts"], r[name]["ends"]):
            assert any(bad in r["text"][a:b].lower() for bad in BAD)
    kept = toxicity.clean(make_docs([r[:2] for r in fresh]), model)
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(i for i, _, y in fresh if not y)


def test_noisy_or_joins_sentences():
    model = toxicity.fit(["a. b."], np.array([1]))       # one class: no weights
    scorer = toxicity.Scorer(model)
    _, p = scorer.sentences("One. Two! Three\nfour")
    assert len(p) == 4 and np.allclose(p, 1 / (1 + np.exp(6)))


@pytest.mark.parametrize("n", [1, 20, 2_000, 50_000])
def test_length_alone_is_no_evidence(n):
    scorer = toxicity.Scorer(toxicity.fit(["x"], np.array([0])))
    _, p = scorer.sentences("Word. " * n)
    assert 1 - np.prod(1 - p) < 0.06


@pytest.mark.parametrize("n", [0, 20, 2_000, 20_000])
def test_one_sentence_is_judged_the_same_in_any_text(spark, make_docs, prose, n):
    rows = sample(prose, 240)
    model = toxicity.fit([t for _, t, _ in rows], np.array([y for _, _, y in rows]))
    # Odds just over the threshold, by words that were not seen in training.
    weak = "qqqq" + "w"
    bias = float(model["weight"][model["feature"] == -1].iloc[0])
    word = pd.DataFrame({"feature": np.array([toxicity.features(weak)[-1]], np.int32), "weight": np.array([-bias], np.float32)})
    model = pd.concat([model, word])
    clean = [f"The garden is green today{'.' if i % 2 else '!'}" for i in range(n)]
    for at in {0, n // 2, n}:
        text = " ".join([*clean[:at], f"A {weak} stands here.", *clean[at:]])
        scored, name = toxicity.with_scores(make_docs([(1, text)]), model)
        r = scored.first()
        assert r[name]["score"] >= 0.5 - 1e-6
        assert [weak in text[a:b] for a, b in zip(r[name]["starts"], r[name]["ends"])] == [True]
    assert toxicity.clean(make_docs([(1, text)]), model).collect() == []


def test_added_text_never_lowers_a_score():
    rng = np.random.default_rng(1)
    p = 1 / (1 + np.exp(6 - rng.normal(0, 2, 200)))
    none = [np.prod(1 - toxicity.shares(p[:n])) for n in range(1, 200)]
    assert all(b <= a * (1 + 1e-12) for a, b in zip(none, none[1:]))


def test_spans_are_of_the_original():
    scorer = toxicity.Scorer(toxicity.fit(["x"], np.array([0])))
    text = "İlk. Second one."
    spans, _ = scorer.sentences(text)
    assert [text[a:b] for a, b in spans] == ["İlk", " Second one"]


@pytest.mark.parametrize("labels", [[], [(1, None)], [(None, 1)], [(1, 1), (1, 0)], [(77, 1)]])
def test_thin_labels(spark, make_docs, labels):
    frame = spark.createDataFrame(labels, "doc_id long, toxic int")
    docs = make_docs([(1, "text"), (2, None)])
    scored, name = toxicity.with_scores(docs, toxicity.train(docs, frame))
    assert all(r[name]["score"] < 0.01 for r in scored.collect())


def test_empty_table(spark, make_docs):
    frame = spark.createDataFrame([(1, 1)], "doc_id long, toxic int")
    assert toxicity.clean(make_docs([]), toxicity.train(make_docs([]), frame)).collect() == []


def test_sample_is_bounded(spark, make_docs, prose):
    rows = sample(prose, 40)
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    small = toxicity.train(make_docs([r[:2] for r in rows]), labels, rows=10)
    order = spark.createDataFrame([(i,) for i, _, _ in rows], "id long").selectExpr("id", "xxhash64(id) h").orderBy("h").limit(10)
    chosen = {r["id"] for r in order.collect()}
    want = toxicity.fit([t for i, t, _ in rows if i in chosen], np.array([y for i, _, y in rows if i in chosen]))
    assert np.allclose(sorted(small["weight"]), sorted(want["weight"]), atol=1e-5)


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = op9_toxicity(spark, sf).collect()
    held = [(r["predicted"], labels[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in labels]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    hits = sum(p and y for p, y in held)
    assert len(rows) == 10_000 and hits >= 0.9 * sum(y for _, y in held) and hits >= 0.9 * sum(p for p, _ in held)
