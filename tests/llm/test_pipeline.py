import zlib

import pytest

from pyspark.sql import functions as F

import corpus_pipeline
from siltbed.llm import bpe, decontam, pii, simhash, toxicity
from siltbed.llm.common import table
from siltbed.llm.queries import tokenizer_path
from siltbed.session import stage

SF = "/root/testdata/sf0.001"


def test_every_stage_on_its_own_input(spark):
    """Each stage's rows equal what its operator's decisions say, taken one by one."""
    docs = table(spark, SF, "documents")
    columns = docs.columns
    functions = dict(corpus_pipeline.STAGES)
    assert list(functions) == ["toxicity", "near_duplicates", "decontamination", "personal_data", "tokens"]

    # Toxicity: the rows under the threshold.
    labels = table(spark, SF, "labels")
    model = toxicity.train(docs, labels, usable=lambda i: toxicity.fold(i) != 2)
    scorer = toxicity.Scorer(model)

    def score(text):
        quiet = 1.0
        for p in scorer.sentences(text or "")[1]:
            quiet *= 1 - p
        return 1 - quiet
    kept = stage(functions["toxicity"](spark, docs, SF), "t")
    rows = {r["doc_id"]: r for r in docs.collect()}
    assert kept.columns == columns
    assert {r["doc_id"] for r in kept.collect()} == {i for i, r in rows.items() if score(r["text"]) < toxicity.THRESHOLD}

    # Near duplicates: the least id of each component.
    one = stage(functions["near_duplicates"](spark, kept, SF), "t")
    fps = sorted((r["doc_id"], simhash.fingerprint((r["text"] or "").encode()) % (1 << 64)) for r in kept.collect())
    root = {}
    for i, a in fps:
        near = [root[j] for j, b in fps if j < i and (a ^ b).bit_count() <= 3]
        least = min([i, *near])
        for j in [k for k, v in root.items() if v in near]:
            root[j] = least
        root[i] = least
    assert one.columns == columns
    assert sorted(r["doc_id"] for r in one.collect()) == sorted(set(root.values()))

    # Decontamination: rows the operator's rule doesn't reject.
    free = stage(functions["decontamination"](spark, one, SF), "t")
    found = decontam.contamination(one, table(spark, SF, "benchmark")).collect()
    assert free.columns == columns
    assert sorted(r["doc_id"] for r in free.collect()) == sorted(
        r["doc_id"] for r in found if not (r["n_hit"] and 20 * r["n_hit"] >= r["n_words"]))

    # Personal data: texts without spans as they were, the others without their spans.
    hidden = stage(functions["personal_data"](spark, free, SF), "t")
    texts = {r["doc_id"]: r["text"] for r in free.collect()}
    assert hidden.columns == columns and hidden.schema["n_chars"] == docs.schema["n_chars"]
    for r in hidden.collect():
        spans = pii.find(pii.trained(), [texts[r["doc_id"]]])[0][1]
        assert r["text"] == pii.redact(texts[r["doc_id"]], spans) and r["n_chars"] == len(r["text"])
        assert not pii.base_spans(r["text"])

    # Tokens of what is left.
    last = functions["tokens"](spark, hidden, SF).collect()
    with open(tokenizer_path("word_bpe_49k.json"), encoding="utf-8") as f:
        tokenizer = bpe.Bpe(f.read())
    texts = {r["doc_id"]: r["text"] for r in hidden.collect()}
    assert {r["doc_id"]: r["n_tokens"] for r in last} == {i: len(tokenizer.encode([t])[0]) // 4 for i, t in texts.items()}
    assert sorted(map(tuple, corpus_pipeline.run(spark, SF).collect())) == sorted(map(tuple, last))


def test_odd_rows_pass_every_stage(spark, tmp_path):
    """Nulls in any column, empty and long texts, repeated rows and an extra column."""
    rows = [(1, "plain text of some words here", "en", "s", 29), (None, "no id at all but words", None, None, None),
            (2, None, "en", "s", 0), (3, "", "en", "s", 0), (4, "long " * 60_000, "en", "s", 300_000),
            (1, "plain text of some words here", "en", "s", 29), (5, "write a@b.cc now please do it", "de", None, 29)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").selectExpr("*", "'x' AS fp")
    for name in ("labels", "benchmark"):
        table(spark, SF, name).write.parquet(f"{tmp_path}/{name}.parquet")
    for name, apply in corpus_pipeline.STAGES:
        docs = stage(apply(spark, docs, str(tmp_path)), name)
        if name == "personal_data":
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars", "fp"]
            assert sorted((r["doc_id"] or -1, (r["text"] or "")[:20]) for r in docs.collect()) == [
                (-1, "no id at all but wor"), (1, "plain text of some w"), (2, ""), (4, "long long long long "), (5, "write <email> now pl")]
    assert docs.count() == 5


def test_empty_tables(spark, tmp_path):
    for name in ("documents", "labels", "benchmark"):
        table(spark, SF, name).limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


@pytest.mark.parametrize("value", [0, 7, 123456789])
def test_folds_are_by_checksum(spark, value):
    got = spark.range(1).select(toxicity.fold(F.lit(value))).first()[0]
    assert got == zlib.crc32(str(value).encode()) % 4
