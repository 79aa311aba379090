import tracemalloc

import pyarrow as pa
import pytest

from siltbed.llm import unitdedup
from siltbed.llm.queries import op8_unitdedup

LONG = "eight words at least are needed for removal"
OTHER = "another line of more than eight words stands here"


def plain(rows):
    """First occurrences in order of id, hash and place; all spans of later ones."""
    order = sorted({(i is None, i or 0, h, t or "") for i, t, h in rows})
    first = {}
    for none, i, h, t in order:
        for a, b, d in unitdedup.units(t):
            first.setdefault(d, (none, i, h, a))
    out = []
    for i, t, h in rows:
        spans = [(a, b) for a, b, d in unitdedup.units(t or "") if first[d] != (i is None, i or 0, h, a)]
        kept, runs = unitdedup.remove(t or "", spans)
        out.append((i is None, i or 0, kept, runs))
    return sorted(out)


CASES = {
    "earliest stays": [(5, f"intro\n{LONG}\nend"), (2, f"  {LONG.upper()}  "), (9, f"{OTHER}\n{LONG}")],
    "inside a text": [(1, f"{LONG}\nx\n{LONG}\n{LONG}"), (2, None), (3, "")],
    "sentences in lines": [(1, f"{LONG}. {OTHER}! tail"), (2, f"{OTHER}! Then {LONG}."), (3, f"Start. {LONG}.é {OTHER}!")],
    "short units stay": [(1, "short line"), (2, "short line"), (3, "a. b. c.")],
    "rows and ids again": [(1, LONG), (1, LONG), (None, LONG), (1, f"{LONG} x"), (1, f"{LONG} x"), (None, OTHER), (2, OTHER)],
    "no documents": [],
    "a long text": [(1, f"{LONG}\n" * 3_000), (2, "w " * 50_000), (3, "w " * 50_000)],
}


@pytest.mark.parametrize("case", CASES)
def test_against_brute_force(spark, make_docs, case):
    docs = make_docs(CASES[case])
    hashes = {(r["doc_id"], r["text"]): r["h"] for r in docs.selectExpr("doc_id", "text", "xxhash64(text) h").collect()}
    got = unitdedup.deduplicated(docs).collect()
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["kept_text"], [tuple(s) for s in r["removed"]]) for r in got) == \
        plain([(i, t, hashes[i, t]) for i, t in CASES[case]])


def test_units_keep_their_places():
    text = f"{LONG}. {OTHER}?! x\n\n {OTHER}"
    spans = [(a, b) for a, b, _ in unitdedup.units(text)]
    assert [text[a:b] for a, b in spans] == [f"{LONG}. {OTHER}?! x", f"{LONG}.", f" {OTHER}?!", f" {OTHER}"]


def test_digests_ignore_case_and_spaces():
    one, two = (next(unitdedup.units(t))[2] for t in (LONG, "  Eight  WORDS at least\tare needed for removal "))
    assert one == two


def test_long_passages_go_and_unique_texts_stay(make_docs, prose):
    passage = prose(60, 99)
    rows = [(i, f"{prose(50, i)}\n{passage}\n{prose(30, i + 500)}") for i in range(20)] + [(100 + i, prose(80, i + 900)) for i in range(20)]
    got = {r["doc_id"]: r for r in unitdedup.deduplicated(make_docs(rows)).collect()}
    for i, text in rows:
        gone = sum(e - s for s, e in got[i]["removed"])
        assert got[i]["kept_text"] == text if i == 0 or i >= 100 else gone >= len(passage)


VERSE = [f"verse {i} has six words {i * 7}" for i in range(10)]
KANJI = "".join(chr(0x4e00 + 37 * i % 5000) for i in range(60))


@pytest.mark.parametrize("passage", [
    "\n".join(VERSE), "\n\n".join(VERSE), ". ".join(VERSE) + ".", f"{LONG}. Yes it is. {OTHER}. So.",
    f"Title\n\n{LONG}\nend.", KANJI, "。".join(KANJI[i:i + 12] for i in range(0, 60, 12)) + "。"])
def test_passages_of_short_units_go(make_docs, prose, passage):
    rows = [(i, f"{prose(50, i)}.\n{passage}\n{prose(30, i + 500)}") for i in range(3)]
    # In a line of its own for sentences alone, else the same.
    rows.append((3, f"{prose(20, 7)}. {passage} {prose(20, 8)}" if "\n" not in passage and passage[-1] in ".。" else rows[2][1]))
    got = {r["doc_id"]: r for r in unitdedup.deduplicated(make_docs(rows)).collect()}
    assert got[0]["kept_text"] == rows[0][1]
    for i, text in rows[1:]:
        a = text.index(passage)
        gone = {c for s, e in got[i]["removed"] for c in range(s, e)}
        assert {c for c in range(a, a + len(passage)) if not text[c].isspace()} <= gone
        assert i == 3 or not gone - set(range(a, a + len(passage)))


def test_unlike_short_units_stay(make_docs):
    rows = [(1, f"{LONG}\nyes\n{OTHER}"), (2, f"{LONG}\nno\n{OTHER}"), (3, "one two\nthree\nfour five"), (4, "one two\nthree\nfour five")]
    got = {r["doc_id"]: r["kept_text"] for r in unitdedup.deduplicated(make_docs(rows)).collect()}
    assert got == {1: rows[0][1], 2: "\nno\n", 3: rows[2][1], 4: rows[3][1]}


def test_a_task_holds_the_units_of_few_texts(prose):
    """A batch of 10,000 texts comes in slices; its units at once took many times as much."""
    texts = ["\n".join(prose(12, i % 50 * 100 + j) for j in range(25)) for i in range(50)] * 200
    batch = pa.record_batch({"id": list(range(len(texts))), "hash": [7] * len(texts), "text": [t.encode() for t in texts]})
    tracemalloc.start()
    n, most = 0, 0
    for out in unitdedup._unit_batches(iter([batch]), 8):
        n, most = n + out.num_rows, max(most, out.num_rows)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n == 200 * sum(len(list(unitdedup.units(t))) for t in texts[:50])
    assert most < n / 10 and peak < 30e6


def test_query_against_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{sf}/documents.parquet").selectExpr("doc_id", "text", "xxhash64(text) h").collect()
    want = plain([tuple(r) for r in rows])
    got = {r["doc_id"]: r for r in op8_unitdedup(spark, sf).collect()}
    assert len(got) == len(rows) and any(r["n_removed"] for r in got.values())
    for _, i, _, runs in want:
        assert (got[i]["n_removed"], got[i]["n_spans"], got[i]["removed_spans"]) == (
            sum(b - a for a, b in runs), len(runs), ",".join(f"{a}:{b}" for a, b in runs))
