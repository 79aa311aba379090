import hashlib
import re

import numpy as np
import pytest

from siltbed.llm import pii
from siltbed.llm.queries import op5_pii


def luhn(digits):
    values = [int(c) for c in digits[::-1]]
    return (sum(values[0::2]) + sum(sum(divmod(2 * v, 10)) for v in values[1::2])) % 10 == 0


def plain_spans(text):
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
            if all(int(p) <= 255 for p in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m[0])
        if 14 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), 2, m.end()))
    out += [(m.start(), 3, m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text)
            if 10 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return sorted(out)


TEXTS = [
    "", "a@b.c", "x a.b+c@d-e.f.g@h.i, @j.k %@l.m", "a@b@c.d", "a@b.c%x@d.e", "1.2.3.4.5.6.7.8 and 256.1.1.1 1.1.1.0255 00001.2.3.4",
    "4532015112830366 4532-0151-1283-0366 4532 0151 1283 0367 45320151128303660000", "+1 (243) 555-5526, +49 30 1234567 +1+2345678901234 +123",
    "é 79927398713 ü +86 10 6552 9988 x@y.zz 4916338534644881", "@" * 50 + "a@b.c " * 3, "1." * 30 + "1", "- 1-1-1-1-1-1-1-1-1-1-1-1-1-1-1-1",
]


@pytest.mark.parametrize("text", TEXTS)
def test_base_rules_are_the_patterns(text):
    assert pii.base_spans(text) == plain_spans(text)


def test_base_rules_on_random_strings():
    rng = np.random.default_rng(2)
    for _ in range(3000):
        text = "".join(rng.choice(list("ab@@..-+ 0123459()%é"), rng.integers(0, 40)))
        assert pii.base_spans(text) == plain_spans(text), text


@pytest.mark.parametrize("run", ["a" * 300_000, "1" * 300_000, "1.2.3." * 60_000, "@a.b" * 60_000, "+1" * 100_000])
def test_long_runs_take_linear_time(run):
    pii.base_spans(run)


def test_field_learns_its_table():
    field = pii.trained()
    for line in pii.LABELLED:
        plain, spans = pii._parse(line)
        assert pii.field_spans(field, [plain])[0] == [(a, pii.KINDS.index(pii.LABELS[k]), b) for a, b, k in spans]


@pytest.mark.parametrize("text, found", [
    ('so token = "0c497b5014f705c0be6482b0cb261201f091f991" was', ["0c497b5014f705c0be6482b0cb261201f091f991"]),
    ("my password: qX81kkQ99a then", ["qX81kkQ99a"]),
    ("her phone (415) 555-0123 rings", ["(415) 555-0123"]),
    ("SSN 321-54-9876 here", ["321-54-9876"]),
    ("no personal data in the year 1997, version 2.0", []),
])
def test_field_finds_new_ones(text, found):
    assert [text[a:b] for a, _, b in pii.field_spans(pii.trained(), [text])[0]] == found


def test_cut_decoding_equals_whole_viterbi():
    field = pii.trained()
    rng = np.random.default_rng(4)
    pool = ["token", "=", '"', "ab12cd34ef56ab78cd90ab12cd34ef56ab78cd90", "the", "555", "-", "0134", "(", ")", "phone", "ssn", "12", ".", "a"]
    k = len(pii.LABELS)
    for _ in range(60):
        tokens = ["\n", "\n", *rng.choice(pool, rng.integers(1, 30)).tolist(), "\n", "\n"]
        e = field.emissions(tokens)[2:-2]
        best, back = e[0] + field.step[0], []
        for row in e[1:]:
            paths = best[:, None] + field.step
            back.append(paths.argmax(axis=0))
            best = paths.max(axis=0) + row
        path = [int((best + field.step[:, 0]).argmax())]
        for b in back[::-1]:
            path.append(int(b[path[-1]]))
        assert field.decode(tokens)[2:-2].tolist() == path[::-1] and k == 4


def test_texts_do_not_touch_each_other():
    field = pii.trained()
    texts = ["the token =", '"0c497b5014f705c0be6482b0cb261201f091f991"', "plain"]
    assert pii.field_spans(field, texts) == [pii.field_spans(field, [t])[0] for t in texts]


def test_rows_and_redaction(spark, make_docs):
    rows = [(1, "mail a@b.cc or +1 (243) 555-5526!"), (2, None), (3, ""), (None, "97.51.17.173"), (1, "mail a@b.cc or +1 (243) 555-5526!"),
            (4, "word " * 50_000 + "x@y.zz")]
    docs = make_docs(rows)
    found = pii.personal_data(docs, pii.trained()).collect()
    assert len(found) == len(rows)
    assert {(r["doc_id"], tuple(r["base"])) for r in found} == {
        (1, (5, 0, 11, 15, 3, 32)), (2, ()), (3, ()), (None, (0, 1, 12)), (4, (250_000, 0, 250_006))}
    out = pii.redacted(docs, pii.trained(), length_col="n_chars")
    assert out.columns == docs.columns
    by = {r["doc_id"]: (r["text"], r["n_chars"]) for r in out.collect()}
    assert by[1] == ("mail <email> or <phone>!", 24) and by[2] == (None, 0) and by[None] == ("<ip>", 4)
    assert pii.personal_data(make_docs([]), pii.trained()).collect() == []


def test_overlapping_spans_are_one():
    assert pii.redact("abcdefgh", [(1, 2, 5), (3, 3, 6), (7, 0, 8)]) == "a<card>g<email>"


def test_query_against_plain_rules(spark):
    sf = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = op5_pii(spark, sf).collect()
    assert len(rows) == len(texts)
    for r in rows:
        spans = plain_spans(texts[r["doc_id"]])
        assert [r[f"n_{k}"] for k in pii.BASE_KINDS] == [sum(s[1] == i for s in spans) for i in range(4)]
        joined = [f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in spans]
        assert r["base_sha256"] == hashlib.sha256(",".join(joined).encode()).hexdigest()
        assert set(joined) <= set(r["spans"].split(","))
