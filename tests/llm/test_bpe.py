import hashlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from siltbed.llm import bpe
from siltbed.llm.queries import op4_bpe, tokenizer_path

PATH = tokenizer_path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.no_padding()
    tokenizer.no_truncation()
    return tokenizer


@pytest.fixture(scope="module")
def model():
    with open(PATH, encoding="utf-8") as f:
        return bpe.Bpe(f.read())


TEXTS = ["", " ", "Hello, World! It's 2024 don't they'LL", "a" * 5000, "aa aaa aaaa aaaaa", "É é ﬁ İstanbul ΣΑΣ ς ὈΔΥΣΣΕΎΣ",
         "x<|endoftext|>y <|startoftext|><|endoftext|> <|endoftext|", "日本語 テスト 한국어 🎉🎉 ​ 　z", "\x00\x01\x1c\x1d\x1f\x85 a\tb\r\n",
         "token = \"04dbebab91ab85687d33eeaaf9ac699e1188f962\" ***$$$%%%", "½ ² Ⅷ ٣ 12345", "'s't're've'm'll'd ''' 's"]


@pytest.mark.parametrize("text", TEXTS)
def test_as_the_library(model, library, text):
    want = library.encode(text, add_special_tokens=False).ids
    ids = model.encode([text])[0]
    assert np.frombuffer(ids, "<u4").tolist() == want
    assert model.decode(ids) == library.decode(want, skip_special_tokens=False)


def test_every_letter_as_the_library(model, library):
    """Tables of letters differ in age; the library's count, in either case and beside others."""
    texts = [f"a{chr(c)}b {chr(c)}{chr(c)}1" for c in range(0x80, 0x34000) if not 0xD800 <= c < 0xE000]
    want = [e.ids for e in library.encode_batch_fast(texts, add_special_tokens=False)]
    assert [np.frombuffer(x, "<u4").tolist() for x in model.encode(texts)] == want


def test_random_strings_as_the_library(model, library):
    rng = np.random.default_rng(5)
    letters = list("aaabetoinsh THE.,'!-0129éßñ\n日🎉\u0558\u1c89\ua7cb\U00010950Σİ")
    texts = ["".join(rng.choice(letters, rng.integers(0, 200))) for _ in range(300)]
    want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert [np.frombuffer(x, "<u4").tolist() for x in model.encode(texts)] == want


def test_one_merge_at_a_time_gives_the_same(model, monkeypatch):
    words = ["banana", "aaaaaaa", "hellohello", "thethethe", "mississippi"]
    quick = [x.tolist() for x in model.merge(words)]
    monkeypatch.setattr(model, "in_order", False)
    assert [x.tolist() for x in model.merge(words)] == quick


def test_a_full_cache_starts_over(monkeypatch, library):
    monkeypatch.setattr(bpe, "WORDS", 2)
    with open(PATH, encoding="utf-8") as f:
        small = bpe.Bpe(f.read())
    texts = ["one two three four", "three four five", "one five"]
    for t in texts * 2:
        assert np.frombuffer(small.encode([t])[0], "<u4").tolist() == library.encode(t, add_special_tokens=False).ids


def test_rows(make_docs, library):
    rows = [(1, "Hello there"), (2, None), (3, ""), (None, "Hello there"), (1, "Hello there"), (4, "long words " * 30_000)]
    got = bpe.digest(make_docs(rows), PATH).collect()
    assert len(got) == len(rows)
    for r in got:
        text = next(t or "" for i, t in rows if i == r["doc_id"])
        ids = library.encode(text, add_special_tokens=False).ids
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
    assert bpe.digest(make_docs([]), PATH).collect() == []


def test_ids_and_texts_as_columns(make_docs, library):
    docs = make_docs([(1, "Round trip."), (2, None)])
    got = {r["doc_id"]: r["t"] for r in docs.withColumn("t", bpe.tokens_column(docs, PATH)).collect()}
    assert got[1]["ids"] == library.encode("Round trip.", add_special_tokens=False).ids
    assert got[1]["decoded"] == library.decode(got[1]["ids"], skip_special_tokens=False)
    assert got[2]["ids"] == [] and got[2]["decoded"] == ""


def test_query_against_the_library(spark, library):
    sf = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = op4_bpe(spark, sf).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = library.encode(texts[r["doc_id"]], add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == (
            len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest())
