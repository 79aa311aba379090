import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from siltbed.llm import simhash


def plain_fingerprint(text):
    words = [w for w in (text or "").translate({a: a + 32 for a in range(65, 91)}).translate(
        dict.fromkeys(range(9, 14), " ")).split(" ") if w]
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] if len(words) >= 3 else [" ".join(words)] * bool(words)
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def plain_components(fps, bits):
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i, a in enumerate(fps):
        for j in range(i):
            if (a ^ fps[j]).bit_count() <= bits:
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return [find(i) for i in range(len(fps))]


TEXTS = ["", "a", "A b", "a\tb\x0bc", "x y z w " * 4000, "É È ê f g h", "one two three four five", "One two THREE four five"]


@pytest.mark.parametrize("text", TEXTS)
def test_fingerprint_is_the_majority_of_shingle_bits(text):
    assert simhash.fingerprint(text.encode()) % (1 << 64) == plain_fingerprint(text)


def test_long_texts_are_counted_in_runs(monkeypatch):
    text = " ".join(str(i % 97) for i in range(500))
    whole = simhash.fingerprint(text.encode())
    monkeypatch.setattr(simhash, "_RUN", 7)
    assert simhash.fingerprint(text.encode()) == whole


def test_tree_finds_exactly_the_close_items():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 1 << 63, 40, np.uint64)
    items = np.unique(np.concatenate([base ^ (np.uint64(1) << np.uint64(b)) for b in (0, 5, 9, 63)] + [base]))
    items = items[np.argsort(simhash._rank(items), kind="stable")]
    tree = simhash.GrayTree(items, np.full(len(items), ~np.uint64(0)))
    q, item = tree.search(items, 2)
    want = {(i, j) for i in range(len(items)) for j in range(len(items)) if int(items[i] ^ items[j]).bit_count() <= 2}
    assert set(zip(q.tolist(), item.tolist())) == want


@pytest.mark.parametrize("n", [1, 3, 200])
def test_links_across_shards(spark, monkeypatch, n):
    monkeypatch.setattr(simhash, "SHARD", 16)
    monkeypatch.setattr(simhash, "VISITORS", 20)
    rng = random.Random(n)
    base = [rng.getrandbits(64) for _ in range(max(1, n // 6))]
    fps = sorted({rng.choice(base) ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(3))) for _ in range(n)})
    frame = spark.createDataFrame([(f - (1 << 64) if f >> 63 else f,) for f in fps], "fp long")
    roots = {r["node"] % (1 << 64): r["root"] for r in simhash.components(simhash.links(frame, 3)).collect()}
    want = plain_components(fps, 3)
    for i, a in enumerate(fps):
        for j in range(i):
            linked = a in roots and roots[a] == roots.get(fps[j])
            assert linked == (want[i] == want[j])


def test_rows_ids_and_nulls(make_docs):
    rows = [(3, "same words in here now"), (1, "Same words in here now"), (2, None), (5, ""), (9, "quite other text it is"),
            (9, "quite other text it is"), (None, "same words in here now"), (None, "a lonely text of no name"), (None, "another text without any id")]
    found = simhash.near_duplicates(make_docs(rows)).collect()
    by = sorted((r["doc_id"] or -1, r["component_id"] or -1) for r in found)
    assert by == [(-1, -1), (-1, -1), (-1, 1), (1, 1), (2, 2), (3, 1), (5, 2), (9, 9), (9, 9)]
    kept = simhash.keep_one(make_docs(rows))
    assert kept.columns == make_docs(rows).columns
    assert sorted((r["doc_id"] or -1, r["text"] or "") for r in kept.collect()) == [
        (-1, "a lonely text of no name"), (-1, "another text without any id"), (1, "Same words in here now"), (2, ""),
        (9, "quite other text it is")]


def test_an_id_of_two_texts_stays_once(make_docs):
    rows = [(1, "a b c d e f g"), (2, "a b c d e f g"), (2, "nothing like the first at all"), (2, "a b c d e f g")]
    assert sorted((r["doc_id"], r["text"]) for r in simhash.keep_one(make_docs(rows)).collect()) == [
        (1, "a b c d e f g"), (2, "nothing like the first at all")]


def test_empty_table(make_docs):
    assert simhash.near_duplicates(make_docs([])).collect() == []
    assert simhash.keep_one(make_docs([])).collect() == []


def test_query_against_brute_force(spark):
    from siltbed.llm.queries import op7_simhash
    sf = "/root/testdata/sf0.001"
    got = {r["doc_id"]: r for r in op7_simhash(spark, sf).collect()}
    docs = sorted((r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect())
    fps = [plain_fingerprint(t) for _, t in docs]
    for (i, _), fp, root in zip(docs, fps, plain_components(fps, 3)):
        assert got[i]["fingerprint"] == f"{fp:016x}"
        assert got[i]["component_id"] == docs[root][0]


def test_gray_rank_orders_like_numpy(spark):
    values = [0, 1, -1, 5, 2 ** 62, -(2 ** 63), 12345678901234]
    frame = spark.createDataFrame([(v,) for v in values], "fp long")
    got = [r["fp"] for r in frame.orderBy(simhash.gray_rank(F.col("fp"))).collect()]
    array = np.array(values).view(np.uint64)
    assert got == [values[i] for i in np.argsort(simhash._rank(array))]
