import hashlib
import random
from collections import Counter

import pandas as pd
import pytest
import sentencepiece
from tokenizers import Tokenizer

from siltbed.llm import common, crossalign
from siltbed.llm.queries import op13_crossalign, tokenizer_path

A, B = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model")
TEXTS = ["", " ", "  ", "Hello, world!", " leading", "trailing ", "two  spaces   three\n\n new\tline ", "élève naïve Straße", "日本語 テスト 한국어 🎉🎉", "<s> </s> <unk> <0x41> <|endoftext|>",
         "a\x00b \x1c\x1d x", "under▁score", "▁", "don't we'll 12345 3.14", "\u3000wide\u00a0space \u200b zero", "x" * 5000, "word " * 3000, "a\r\nb \r\n c", "ﬁ ½ ²", "e\u0301"]


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(A)
    a.no_padding()
    a.no_truncation()
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=B)


@pytest.fixture(scope="module")
def bytes_of(libraries):
    """Bytes of a token, spelled out for each library."""
    a, b = libraries
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(x): x for x in plain} | {chr(256 + i): x for i, x in enumerate(x for x in range(256) if x not in plain)}

    def of_a(i):
        return bytes(letters[c] for c in a.id_to_token(i))

    def of_b(i):
        p = b.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("\u2581", " ").encode()
    return of_a, of_b


def groups_of(text, libraries, bytes_of):
    """Groups of a whole text, by walking along its bytes."""
    if not text:
        return None
    ids_a, ids_b = libraries[0].encode(" " + text, add_special_tokens=False).ids, libraries[1].encode(text)
    data = (" " + text).encode()
    if b"".join(map(bytes_of[0], ids_a)) != data or b"".join(map(bytes_of[1], ids_b)) != data:
        return None
    out, i, j = [], 0, 0
    while i < len(ids_a):
        a, b, left, right = [ids_a[i]], [ids_b[j]], len(bytes_of[0](ids_a[i])), len(bytes_of[1](ids_b[j]))
        i, j = i + 1, j + 1
        while left != right:
            if left < right:
                a.append(ids_a[i])
                left, i = left + len(bytes_of[0](ids_a[i])), i + 1
            else:
                b.append(ids_b[j])
                right, j = right + len(bytes_of[1](ids_b[j])), j + 1
        out.append((a, b))
    return out


def brute(rows, libraries, bytes_of):
    found = [(i, groups_of(t, libraries, bytes_of)) for i, t in rows]
    links = [[(x, y) for a, b in g or [] for x in a for y in b] for _, g in found]
    count = Counter(link for own in links for link in set(own))
    most = {}
    for (a, _), n in count.items():
        most[a] = max(n, most.get(a, 0))
    out = []
    for (i, g), own in zip(found, links):
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in g or [])
        out.append((i, sum(len(a) for a, _ in g or []), sum(len(b) for _, b in g or []), len(g or []), len(own),
                    sum(count[x] == most[x[0]] for x in own), sum(count[x] for x in own), hashlib.sha256(text.encode()).hexdigest() if g else ""))
    return out


COLUMNS = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def result(df):
    return Counter(tuple(r[c] for c in COLUMNS) for r in df.collect())


@pytest.mark.parametrize("limit", [8_000_000, 300])
def test_odd_texts_by_brute_force(spark, make_docs, libraries, bytes_of, monkeypatch, limit):
    monkeypatch.setattr(crossalign, "BATCH", limit)
    rows = list(enumerate(TEXTS)) + [(None, "no id here"), (3, "Hello, world!"), (3, "Hello, world!"), (50, None), ((1 << 60) + 1, "far")]
    assert result(crossalign.aligned(make_docs(rows), A, B)) == Counter(brute(rows, libraries, bytes_of))


def test_random_texts_by_brute_force(spark, make_docs, libraries, bytes_of, monkeypatch):
    monkeypatch.setattr(crossalign, "ENCODED", 40)
    monkeypatch.setattr(crossalign, "CHUNKS", 30)
    rng = random.Random(9)
    letters = list("aabetoin  'sTH.,!-0129éß\n\t日🎉\x1c\x85\u3000\u00a0") + ["<s>", "▁", "   ", "the "]
    rows = [(i, "".join(rng.choice(letters[:-3] if i % 3 else letters) for _ in range(rng.randrange(0, 200)))) for i in range(150)]
    assert result(crossalign.aligned(make_docs(rows), A, B)) == Counter(brute(rows, libraries, bytes_of))


def test_whole_texts_give_the_same(libraries, monkeypatch):
    with open(A, encoding="utf-8") as a, open(B, "rb") as b:
        pair = crossalign.Pair(a.read(), b.read())
    assert pair.by_chunk
    names, missing = list(range(len(TEXTS))), [False] * len(TEXTS)
    cut = pair.batch(names, missing, TEXTS)
    pair.by_chunk = False
    pair.known.clear()
    whole = pair.batch(names, missing, TEXTS)
    assert (cut[1] == whole[1]).all() and (cut[2] == whole[2]).all()


def test_a_worker_keeps_its_chunks_for_its_next_task(spark, make_docs):
    """Workers that aligned texts still know their chunks when another job asks."""
    rows = [(i, f"every text has the same words and one of its own {i}") for i in range(40)]
    crossalign.aligned(make_docs(rows), A, B).collect()

    def known(batches):
        for batch in batches:
            held = common._KEPT
            n = len(held[2].known) if held and isinstance(held[2], crossalign.Pair) else 0
            yield pd.DataFrame({"n": [n] * len(batch)})

    assert max(r["n"] for r in spark.range(0, 64, 1, 16).mapInPandas(known, "n long").collect()) > 10


def test_no_documents(spark, make_docs):
    assert crossalign.aligned(make_docs([]), A, B).collect() == []
    rows = [(1, None), (2, "")]
    assert result(crossalign.aligned(make_docs(rows), A, B)) == Counter([(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")])


def test_query_by_brute_force(spark, libraries, bytes_of):
    sf = "/root/testdata/sf0.001"
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert result(op13_crossalign(spark, sf)) == Counter(brute(rows, libraries, bytes_of))
