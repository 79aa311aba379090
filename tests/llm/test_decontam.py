import hashlib
import re

import duckdb
import pytest

from siltbed.llm import decontam
from siltbed.llm.queries import op3_decontamination
from siltbed.llm.sql import ORACLE

SF = "/root/testdata/sf0.001"
ITEM = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen"


def plain_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate({a: a + 32 for a in range(65, 91)}))


def plain(docs, items, window=13):
    windows = {}
    for i, text in items:
        words = plain_words(text)
        if i is not None and words:
            for at in range(max(1, len(words) - window + 1)):
                windows.setdefault(tuple(words[at:at + window]), set()).add(str(i))
    out = []
    for doc_id, text in docs:
        words, hit, ids = plain_words(text), set(), set()
        for at in range(len(words)):
            for w, own in windows.items():
                if tuple(words[at:at + len(w)]) == w:
                    hit |= set(range(at, at + len(w)))
                    ids |= own
        out.append((-1 if doc_id is None else doc_id, len(words), len(hit), sorted(ids)))
    return sorted(out)


CASES = {
    "whole item": ([(1, f"Before it, {ITEM.upper()}! and after"), (2, ITEM.replace("seven", "sieben"))], [(5, ITEM)]),
    "short items": ([(1, "a bb ccc a bb"), (2, "bb a"), (3, None), (4, "")], [(1, "a"), (2, "A bb"), (3, "bb, ccc, a"), (4, None), (5, "--")]),
    "overlaps and repeats": ([(1, "x " * 40), (1, "x " * 40), (1, "x " * 12), (None, "x " * 14)], [(1, "x " * 15), (1, "x " * 15), (None, "x x x")]),
    "window at the end": ([(1, " ".join(ITEM.split()[:13])), (2, " ".join(ITEM.split()[:12])), (3, " ".join(ITEM.split()[1:]))], [(10, ITEM), (9, ITEM)]),
    "no items": ([(1, "a b c")], []),
    "no documents": ([], [(1, ITEM)]),
}


@pytest.mark.parametrize("case", CASES)
def test_against_brute_force(spark, make_docs, case):
    docs, items = CASES[case]
    benchmark = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, words string")
    got = decontam.contamination(make_docs(docs), benchmark).collect()
    assert sorted((-1 if r["doc_id"] is None else r["doc_id"], r["n_words"], r["n_hit"], r["item_ids"]) for r in got) == plain(docs, items)


def test_rare_and_common_shingles_share_a_window(spark, make_docs, prose):
    item = prose(40, 1)
    docs = [(i, prose(200, i + 10) + " " + (item if i % 3 == 0 else "")) for i in range(12)]
    benchmark = spark.createDataFrame([(1, item), (2, prose(20, 2))], "item_id long, text string")
    got = decontam.contamination(make_docs(docs), benchmark).collect()
    assert sorted((r["doc_id"], r["n_words"], r["n_hit"], r["item_ids"]) for r in got) == plain(docs, [(1, item), (2, prose(20, 2))])


def test_without_broadcasts(spark, make_docs, monkeypatch):
    docs, items = CASES["short items"]
    monkeypatch.setattr("siltbed.llm.common.BROADCAST_ROWS", 0)
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = decontam.contamination(make_docs(docs), benchmark).collect()
    assert sorted((r["doc_id"], r["n_words"], r["n_hit"], r["item_ids"]) for r in got) == plain(docs, items)


def test_clean_keeps_columns_and_clean_rows(spark, make_docs):
    docs = make_docs([(1, ITEM), (2, "other words"), (None, None), (2, ITEM), (2, "other words")])
    benchmark = spark.createDataFrame([(1, ITEM)], "item_id long, text string")
    kept = decontam.clean(docs, benchmark)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] or -1, r["text"] or "") for r in kept.collect()) == [(-1, ""), (2, "other words"), (2, "other words")]


def test_no_python_on_the_way(spark):
    plan = op3_decontamination(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_query_equals_its_sql(spark):
    connection = duckdb.connect()
    for name in ("documents", "benchmark"):
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    want = connection.execute(ORACLE["op3_decontamination"]).fetchall()
    assert sorted(map(tuple, op3_decontamination(spark, SF).collect())) == sorted(want)
    assert hashlib.sha256(b"").hexdigest() in {r[4] for r in want}


def test_tables_too_large_to_broadcast_give_the_same(spark, make_docs, prose, monkeypatch):
    item = prose(40, 1)
    docs = make_docs([(i, prose(60, i + 10) + " " + (item if i % 3 == 0 else "")) for i in range(9)])
    benchmark = spark.createDataFrame([(1, item), (2, prose(20, 2))], "item_id long, text string")
    small = sorted(map(str, decontam.contamination(docs, benchmark).collect()))
    monkeypatch.setattr(decontam, "BROADCAST_BYTES", -1)
    large = decontam.contamination(docs, benchmark)
    assert sorted(map(str, large.collect())) == small
    assert sum(r["n_hit"] > 0 for r in large.collect()) == 3


def test_clean_keeps_columns_that_are_named_like_its_own(make_docs, spark):
    docs = make_docs([(1, ITEM), (2, "quite another text"), (2, "quite another text"), (None, ITEM)])
    kept = decontam.clean(docs, spark.createDataFrame([(5, ITEM)], "item_id long, text string"))
    assert kept.columns == docs.columns
    assert [(r["doc_id"], r["_bad_id"], r["_bad_hash"]) for r in kept.collect()] == [(2, "_bad_id", "_bad_hash")] * 2
