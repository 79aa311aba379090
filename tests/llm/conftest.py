import random

import pytest

CLASHES = ("fp", "shard", "id", "hash", "words", "spans", "r", "found", "data", "k1", "score", "_toxicity", "_redacted", "text_hash", "_bad_id", "_bad_hash",
           "words_", "span", "_Bad_Id_")


@pytest.fixture
def make_docs(spark):
    """Documents from (doc_id, text) pairs, with columns named as operators name theirs."""
    def make(rows, **more):
        schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in CLASHES)
        return spark.createDataFrame(
            [(i, t, "en", "s", None if t is None else len(t), *CLASHES) for i, t in rows], schema)
    return make


@pytest.fixture
def prose():
    rng = random.Random(3)
    vocabulary = ["".join(rng.choice("aeioustrnlé") for _ in range(rng.randrange(2, 9))) for _ in range(400)]

    def text(words, seed):
        own = random.Random(seed)
        return " ".join(own.choice(vocabulary) + ("." if own.random() < 0.1 else "") for _ in range(words))
    return text
