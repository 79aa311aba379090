import random
from collections import Counter

import numpy as np
import pytest

from siltbed.llm import induced, suffixdedup
from siltbed.llm.queries import op2_suffixes


def marks(texts, length):
    """Bytes covered by a string that starts at another place, by counting all strings."""
    seen = Counter(t[i:i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        mark = np.zeros(len(t), bool)
        for i in range(len(t) - length + 1):
            if seen[t[i:i + length]] > 1:
                mark[i:i + length] = True
        out.append(mark)
    return out


@pytest.mark.parametrize("memory", [3, 1 << 20])
def test_repeated_places_by_counting(memory):
    rng = random.Random(1)
    for trial in range(300):
        letters = rng.choice([b"a", b"ab", b"abc", bytes(range(256))])
        pieces = [bytes(rng.choice(letters) for _ in range(rng.choice([0, 1, 2, 9, 40]))) for _ in range(rng.randrange(1, 6))]
        pieces += [p[len(p) // 2:] for p in pieces[:2]]
        depth = rng.choice([1, 2, 3, 6])
        seen = Counter(p[i:i + depth] for p in pieces for i in range(len(p) - depth + 1))
        want = [i + depth <= len(p) and seen[p[i:i + depth]] > 1 for p in pieces for i in range(len(p) + 1)]
        assert induced.repeated(induced.symbols(pieces), depth, memory).tolist() == want, (pieces, depth)


def test_suffixes_come_sorted_with_their_common_prefixes():
    pieces = [b"mississippi", b"missouri", b"sip", b""]
    text = induced.symbols(pieces)
    ends = np.flatnonzero(text == induced.END)

    def suffix(at):
        return text[at:ends[np.searchsorted(ends, at)]].tolist()
    last = None
    total = 0
    for place, common in induced.Sorter(text, 50).runs():
        for at, shared in zip(place, common):
            own = suffix(at)
            if last is not None:
                assert own <= last
                assert shared == next((i for i, (a, b) in enumerate(zip(own, last)) if a != b), min(len(own), len(last)))
            last, total = own, total + 1
    assert total == sum(map(len, pieces))


def test_queues_spill_and_keep_their_order():
    queue = induced.TupleQueue(memory=4)
    for n in range(10):
        queue.push(n % 2, np.array([n, n + 100]), np.array([n, n]))
    assert queue.spilled > 0
    assert queue.pop(0)[0].tolist() == [x for n in range(0, 10, 2) for x in (n, n + 100)]
    assert queue.pop(1)[1].tolist() == [n for n in range(1, 10, 2) for _ in range(2)]
    assert len(queue.pop(0)[0]) == 0


def test_equal_windows_have_equal_anchors():
    rng = random.Random(2)
    shared = bytes(rng.choice(b"abcdef") for _ in range(90))
    texts = [bytes(rng.choice(b"abcdef") for _ in range(rng.randrange(50))) + shared + b"x" * k for k in range(30)]
    raw, ends = np.frombuffer(b"".join(texts), np.uint8), np.cumsum(list(map(len, texts)))
    lo, hi, at, anchor, piece = suffixdedup.pieces(raw, ends, 40, 12)
    by_window = {}
    for a, b, p, h in zip(lo, hi, at, anchor):
        for i in range(a, b + 1):
            key = (h, p - i)
            assert by_window.setdefault(bytes(raw[i:i + 40]), key) == key
    assert sum(hi - lo + 1) == sum(max(0, len(t) - 39) for t in texts)


def mixture(rng):
    pool = ["".join(rng.choice("abcdefghij é\n") for _ in range(80)) for _ in range(4)]
    texts = []
    for _ in range(40):
        text, kind = "".join(rng.choice("abcdefghijklmnop") for _ in range(rng.choice([0, 5, 30, 100]))), rng.random()
        if kind < 0.4:
            part = rng.choice(pool)
            at = rng.randrange(40)
            text = text[:len(text) // 2] + part[at:at + rng.randrange(60)] + text[len(text) // 2:]
        if kind > 0.9:
            text = "ab" * rng.randrange(60)
        texts.append(text)
    return texts + texts[:3] + ["", None]


@pytest.mark.parametrize("hot, chunk", [(1000, 2_000_000), (1, 2_000_000), (1000, 50)])
def test_against_brute_force(make_docs, monkeypatch, hot, chunk):
    monkeypatch.setattr(suffixdedup, "CHUNK", chunk)
    rng = random.Random(hot + chunk)
    rows = [(rng.choice([i, None, 7]), t) for i, t in enumerate(mixture(rng))]
    got = suffixdedup.deduplicated(make_docs(rows), length=20, gram=6, hot=hot, shard=2_000).collect()
    data = [(t or "").encode() for _, t in rows]
    want = [(i is None, i or 0, len(d), bytes(np.frombuffer(d, np.uint8)[~m]), [(a, b + 1) for a, b in suffixdedup._ranges(m)])
            for (i, _), d, m in zip(rows, data, marks(data, 20))]
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["n_bytes"], bytes(r["kept"]), [tuple(s) for s in r["removed"]])
                  for r in got) == sorted(want)


def test_no_documents(make_docs):
    assert suffixdedup.deduplicated(make_docs([])).collect() == []


def test_query_against_brute_force(spark):
    import hashlib
    sf = "/root/testdata/sf0.001"
    docs = [(r["doc_id"], r["text"].encode()) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = {r["doc_id"]: tuple(r)[1:] for r in op2_suffixes(spark, sf).collect()}
    for (i, d), m in zip(docs, marks([d for _, d in docs], 200)):
        kept = hashlib.sha256(bytes(np.frombuffer(d, np.uint8)[~m])).hexdigest()
        assert got[i] == (len(d), int(m.sum()), len(suffixdedup._ranges(m)), kept)
