import io
import zlib

import numpy as np
import pytest
from pyspark.sql import Row
from tokenizers import Tokenizer

from siltbed.llm import packing
from siltbed.llm.bpe import library_letters
from siltbed.llm.common import kept
from siltbed.llm.queries import op10_packing, tokenizer_path

PATH = tokenizer_path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.no_padding()
    tokenizer.no_truncation()
    return tokenizer


@pytest.mark.parametrize("size, bits", [(1, 1), (2, 1), (3, 2), (32_000, 15), (49_408, 16), (50_257, 16), (65_536, 16), (65_537, 17)])
def test_least_bits(size, bits):
    assert packing.bits_for(size) == bits


@pytest.mark.parametrize("bits", [1, 2, 7, 8, 13, 15, 16, 17, 31, 32])
def test_pack_and_unpack(bits):
    ids = np.random.default_rng(bits).integers(0, 1 << bits, 1001).astype("<u4")
    data = packing.pack(ids, bits)
    assert len(data) == (1001 * bits + 7) // 8
    assert np.array_equal(packing.unpack(data, bits, 1001), ids)


TEXTS = ["", " ", "  \n\n a  b   ", "don't they'LL we've 'sa ''s", "x<|endoftext|>y <|endoftext|>", "<|endoftext", "é É 日本語 12٣½ 🎉🎉!?",
         "\x00\x01\x1c\x1d\x1f\x85 \u2028\u3000a\t\tb\r\n\r\n", "a" * 3000, " " * 500, "tab\t end \t", "\n" * 7 + "z"]


@pytest.mark.parametrize("text", TEXTS)
def test_words_encode_as_the_whole_text(library, text):
    encoder = packing.WordEncoder(library.to_str())
    assert encoder.by_word
    assert np.frombuffer(encoder.encode([text])[0], "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


def test_random_texts_encode_as_the_library(library, monkeypatch):
    monkeypatch.setattr(packing, "WORDS", 50)
    encoder = packing.WordEncoder(library.to_str())
    rng = np.random.default_rng(8)
    letters = list("aabetoin  'sTH.,!-0129éß\n\t日🎉\x1c\x85\u3000<|endoftext|>")
    for _ in range(40):
        texts = ["".join(rng.choice(letters, rng.integers(0, 120))) + "<|endoftext|>" * int(rng.integers(0, 2)) for _ in range(20)]
        want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
        assert [np.frombuffer(x, "<u4").tolist() for x in encoder.encode(texts)] == want


def test_a_worker_keeps_words_for_its_next_task(library, monkeypatch):
    monkeypatch.setattr(packing, "WORDS", 4)
    values, asked = (library.to_str(), library_letters()), []
    first = kept(packing.WordEncoder, values)

    class Counting:
        def encode_batch_fast(self, words, **options):
            asked.extend(words)
            return library.encode_batch(words, **options)

    first.library = Counting()
    for text in ("one two three four five", "one two", "six one", "one seven"):
        encoder = kept(packing.WordEncoder, tuple(values))
        assert encoder is first
        assert np.frombuffer(encoder.encode([text])[0], "<u4").tolist() == library.encode(text, add_special_tokens=False).ids
    assert sorted(asked) == sorted(["one", " two", " three", " four", " five", "six", " one", " seven"])
    assert kept(packing.WordEncoder, (values[0], None)) is not first


def test_every_letter_encodes_as_the_library(library):
    encoder = packing.WordEncoder(library.to_str())
    texts = [f"a{chr(c)}b {chr(c)}{chr(c)}1" for c in range(0x80, 0x34000) if not 0xD800 <= c < 0xE000]
    want = [e.ids for e in library.encode_batch_fast(texts, add_special_tokens=False)]
    assert [np.frombuffer(x, "<u4").tolist() for x in encoder.encode(texts)] == want


def test_other_vocabularies_encode_whole_texts():
    library = Tokenizer.from_file(tokenizer_path("word_bpe_49k.json"))
    encoder = packing.WordEncoder(library.to_str())
    assert not encoder.by_word
    assert np.frombuffer(encoder.encode(["Hello there"])[0], "<u4").tolist() == library.encode("Hello there", add_special_tokens=False).ids


def file_of(documents, bits=11):
    out = io.BytesIO()
    writer = packing.Writer(out, bits)
    for name, ids in documents:
        writer.add(name, np.array(ids, "<u4"))
    size = writer.close()
    assert size == len(out.getvalue())
    return packing.Reader(out, size)


def test_random_access(monkeypatch):
    monkeypatch.setattr(packing, "BLOCK", 64)
    monkeypatch.setattr(packing, "READ", 2)
    rng = np.random.default_rng(1)
    documents = [(None if i == 3 else i * 7, rng.integers(0, 2048, n).tolist()) for i, n in enumerate([5, 0, 64, 59, 300, 1, 0, 129])]
    reader = file_of(documents)
    flat = np.concatenate([np.array(ids, "<u4") for _, ids in documents])
    for a, b in [(0, 1), (63, 65), (64, 128), (0, len(flat)), (100, 100), (len(flat) - 1, len(flat))]:
        assert np.array_equal(reader.read(a, b), flat[a:b])
    assert [reader.document(i).tolist() for i in range(len(documents))] == [ids for _, ids in documents]
    at = 0
    for (name, start, ids), (want, own) in zip(reader.documents(), documents):
        assert (name, start, ids.tolist()) == (want, at, own)
        at += len(own)


def test_an_empty_file():
    assert list(file_of([]).documents()) == []


def test_other_files_are_refused():
    with pytest.raises(ValueError):
        packing.Reader(io.BytesIO(b"something else entirely"), 23)


def expected(rows, library):
    at, out = 0, []
    for doc_id, text in rows:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 0]
        out.append(Row(doc_id=doc_id, start=at, n_tokens=len(ids), ids_crc32=zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return out


@pytest.mark.parametrize("parts", [1, 3, 40])
def test_order_and_offsets(spark, make_docs, library, parts):
    rows = [(9, "nine"), (1 << 60, "far"), ((1 << 60) + 1, "farther"), (-3, "minus"), (2, None), (0, ""), (None, "no id"), (5, "word " * 40_000)]
    got = packing.read_back(spark, packing.write(make_docs(rows), PATH, parts=parts)).collect()
    want = expected(sorted(rows, key=lambda r: (r[0] is not None, r[0])), library)
    assert sorted(got, key=lambda r: r["start"]) == want


def test_repeated_rows(spark, make_docs, library):
    rows = [(1, "one"), (1, "one"), (1, "one")] * 20
    got = packing.read_back(spark, packing.write(make_docs(rows), PATH, parts=4)).collect()
    assert sorted(got, key=lambda r: r["start"]) == expected(rows, library)


def test_no_documents(spark, make_docs):
    manifest = packing.write(make_docs([]), PATH)
    assert manifest.collect() == [] and packing.read_back(spark, manifest).collect() == []


def test_files_that_the_manifest_misses_do_not_count(spark, make_docs, library, tmp_path):
    folder = f"file://{tmp_path}/packed"
    rows = [(1, "one"), (2, "two")]
    manifest = packing.write(make_docs(rows), PATH, folder=folder, parts=2)
    (tmp_path / "packed" / "part-00000-lost.ids").write_bytes(b"left by a lost task")
    assert sorted(packing.read_back(spark, manifest).collect(), key=lambda r: r["start"]) == expected(rows, library)


def test_query_against_the_library(spark, library):
    sf = "/root/testdata/sf0.001"
    rows = sorted((r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect())
    assert sorted(op10_packing(spark, sf).collect(), key=lambda r: r["start"]) == expected(rows, library)
