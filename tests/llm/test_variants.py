import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from siltbed.llm import variants
from siltbed.llm.queries import LETTERS, op11_variants, with_slips


def apart_by_one(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) < len(b):
        a, b = b, a
    return len(a) == len(b) + 1 and any(a[:i] + a[i + 1:] == b for i in range(len(a)))


def brute(words, ratio=10):
    near = {w: [v for v in words if apart_by_one(w, v)] for w in words}
    best = {w: min(v, key=lambda x: (-words[x], x)) for w, v in near.items() if v}
    form = {w: b for w, b in best.items() if words[b] >= ratio * words[w]}

    def root(w):
        while w in form:
            w = form[w]
        return w
    return sorted((w, form.get(w), root(w), n, len(near[w]), words[form[w]] if w in form else None) for w, n in words.items())


def result(df):
    return sorted((tuple(r[c] for c in ("word", "form", "root", "n", "n_near", "form_n")) for r in df.collect()), key=lambda r: r[0])


def table(spark, words):
    return spark.createDataFrame(list(words.items()), "word string, n long")


@pytest.fixture
def dense():
    """Few letters, so that many words are near each other."""
    rng = random.Random(4)
    words = {"".join(rng.choice("abé") for _ in range(rng.randrange(4, 9))): rng.choice([2, 3, 40, 400]) for _ in range(400)}
    return words | {"a" * 70: 2, "a" * 69 + "b": 30, "a" * 71: 700, "ab" * 200: 5, "ab" * 199 + "a": 60, "x": 2, "y": 30, "xy": 400}


def test_as_by_brute_force(spark, dense):
    assert result(variants.grouped(table(spark, dense))) == brute(dense)


@pytest.mark.parametrize("limit", [1, 3, 64])
def test_blocks_are_halved_and_searched_in_parts(spark, dense, monkeypatch, limit):
    monkeypatch.setattr(variants, "BLOCK_WORDS", limit)
    monkeypatch.setattr(variants, "CHUNK_WORDS", 5)
    assert result(variants.grouped(table(spark, dense))) == brute(dense)


def test_one_block_of_a_third_of_all_words(spark, monkeypatch):
    monkeypatch.setattr(variants, "BLOCK_WORDS", 50)
    rng = random.Random(6)
    words = {"stemstem" + "".join(rng.choice("abcd") for _ in range(5)): rng.choice([2, 20, 200]) for _ in range(200)}
    words |= {"".join(rng.choice("uvwxyz") for _ in range(9)): 2 for _ in range(300)}
    assert result(variants.grouped(table(spark, words))) == brute(words)


def test_index_sets():
    words = ["banana", "bandana", "banane", "bananas", "anana", "banaan", "cabana"]
    codes = variants._codes(words)
    index = variants.Index(codes)
    replaced, missing = index.near(codes[0][None].astype(np.int64), 0, 6)
    assert [words[i] for i in replaced[1]] == ["banane"]
    assert [words[i] for i in missing[1]] == ["anana"]
    # Only pairs that first differ at the asked places.
    assert not len(index.near(codes[0][None].astype(np.int64), 0, 5)[0][0])


def test_ties_go_by_code_points(spark):
    words = {"zzzzzzé": 50, "zzzzzza": 50, "zzzzzzz": 5, "zzzzzze": 2}
    assert result(variants.grouped(table(spark, words))) == brute(words)


def test_ways_of_several_forms(spark):
    words = {"aaaaaaa": 2, "aaaaaab": 20, "aaaaabb": 200, "aaaabbb": 2000, "aaabbbb": 20_000}
    assert {r[0]: r[2] for r in result(variants.grouped(table(spark, words)))} == dict.fromkeys(words, "aaabbbb")


def test_no_words(spark):
    assert variants.grouped(spark.createDataFrame([], "word string, n long")).collect() == []


def slipped(rows, least=7):
    words = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-z\u00c0-\u00ff]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= least:
                words[run] += 1
    return {w: n for w, n in words.items() if n >= 2}


def test_words_of_texts(spark, make_docs):
    rng = random.Random(1)
    stock = ["Straßenbahn", "ÉTUDIANTS", "étudiants", "shorter", "ab", "abcdefg×h", "word1word", "Hyphen-ated", "naïveté", "ΣΙΣΥΦΟΣ"]
    rows = [(i, " ".join(rng.choice(stock) for _ in range(40))) for i in range(60)]
    rows += [(None, "nothing nothing"), (7, None), (8, ""), (9, "repeated"), (9, "repeated"), (10, "x" * 50_000), (11, "x" * 50_000)]
    runs = variants.runs(make_docs(rows), LETTERS, least=7)
    got = variants.vocabulary(runs, with_slips(F.col("id"), F.col("run")), least=7, seen=2).collect()
    assert {r["word"]: r["n"] for r in got} == slipped(rows)


def test_query_by_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    words = slipped(rows)
    # Near words share all letters but one: candidates by what is left without it.
    by_rest = {}
    for w in words:
        for i in range(len(w)):
            by_rest.setdefault(w[:i] + w[i + 1:], set()).add(w)
        by_rest.setdefault(w, set()).add(w)
    near = {w: set() for w in words}
    for group in by_rest.values():
        for w in group:
            near[w] |= {v for v in group if apart_by_one(w, v)}
    best = {w: min(v, key=lambda x: (-words[x], x)) for w, v in near.items() if v}
    form = {w: b for w, b in best.items() if words[b] >= 10 * words[w]}
    want = []
    for w, n in words.items():
        end = w
        while end in form:
            end = form[end]
        want.append((w, form.get(w), end, n, len(near[w]), words[form[w]] if w in form else None))
    assert result(op11_variants(spark, sf)) == sorted(want, key=lambda r: r[0])
