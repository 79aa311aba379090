import numpy as np
import pytest

from siltbed.llm import ann
from siltbed.llm.queries import op6_ann

SCHEMA = "vec_id long, embedding array<float>, label int, v string, leaf string, place string, grp string, q string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0, "v", "l", "p", "m", "q") for i, v in rows], SCHEMA)


def plain(rows, k, every):
    used = {(i, tuple(v)) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)}
    used = sorted((i, np.array(v, np.float32).astype(float)) for i, v in used)
    out = {}
    for i, q in used:
        if i % every == 0:
            scored = [(-float(q @ v / (np.linalg.norm(q) * np.linalg.norm(v))), j) for j, v in used if j != i]
            out[i] = sorted(scored)[:k]
    return out


def test_small_tables_are_searched_whole(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=6).astype(np.float32).tolist()) for i in range(40)]
    got = ann.nearest(frame(spark, rows), k=5, every=10, target=1.0).collect()
    want = plain(rows, 5, 10)
    assert {r["query_id"] for r in got} == set(want)
    for i, best in want.items():
        own = sorted((r["rank"], r["vec_id"], r["score"]) for r in got if r["query_id"] == i)
        assert [r[0] for r in own] == [1, 2, 3, 4, 5]
        assert [r[1] for r in own] == [j for _, j in best]
        assert np.allclose([r[2] for r in own], [-s for s, _ in best], atol=1e-12)


def test_equal_vectors_tie_to_smaller_ids(spark):
    rows = [(i, [1.0, 0.0]) for i in range(30)] + [(100, [0.0, 1.0]), (50, [1.0, 1.0])]
    got = ann.nearest(frame(spark, rows), k=5, every=10).collect()
    by = {q: [r["vec_id"] for r in sorted(got, key=lambda r: r["rank"]) if r["query_id"] == q] for q in (0, 10, 20, 50, 100)}
    assert by == {0: [1, 2, 3, 4, 5], 10: [0, 1, 2, 3, 4], 20: [0, 1, 2, 3, 4], 50: [0, 1, 2, 3, 4], 100: [50, 0, 1, 2, 3]}


def test_unusable_vectors_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (1, None), (2, [0.0, 0.0]), (3, [nan, 1.0]), (4, [inf, 1.0]), (5, [None, 1.0]), (50, []), (None, [1.0, 2.0]),
            (6, [2.0, 4.0]), (7, [1.0, 0.0]), (7, [1.0, 0.0]), (100, [0.0, 0.0]), (8, [1.0, 2.0, 3.0]), (-50, [3.0, 1.0])]
    got = sorted((r["query_id"], r["rank"], r["vec_id"]) for r in ann.nearest(frame(spark, rows), k=5, every=50).collect())
    assert got == [(-50, 1, 7), (-50, 2, 0), (-50, 3, 6), (0, 1, 6), (0, 2, -50), (0, 3, 7)]


@pytest.mark.parametrize("rows", [[], [(0, None)], [(0, [1.0, 1.0])]])
def test_nothing_to_find(spark, rows):
    found = ann.nearest(frame(spark, rows))
    assert found.columns == ["query_id", "rank", "vec_id", "score"] and found.collect() == []


def test_leaves_and_blocks(spark, monkeypatch):
    for name, value in (("LEAF", 8), ("MEMBERS", 10), ("QUERIES", 3), ("SAMPLE", 300), ("GROUP", 4), ("WALKS", 7)):
        monkeypatch.setattr(ann, name, value)
    rng = np.random.default_rng(2)
    centre = rng.normal(size=(12, 8))
    rows = [(i, (centre[i % 12] + 0.2 * rng.normal(size=8)).astype(np.float32).tolist()) for i in range(900)]
    got = ann.nearest(frame(spark, rows), k=5, every=10).collect()
    want = plain(rows, 5, 10)
    hits = sum(len({j for _, j in best} & {r["vec_id"] for r in got if r["query_id"] == i}) for i, best in want.items())
    assert hits >= 0.95 * 5 * len(want)
    assert all(sum(r["query_id"] == i for r in got) == 5 for i in want)


def test_best_bin_first_reaches_every_leaf_once():
    x = ann._unit(np.random.default_rng(3).normal(size=(500, 5)))
    tree = ann.Tree.fit(x)
    assert sorted(tree.visit(x[0], tree.leaves)) == list(range(tree.leaves))
    assert tree.visit(x[0], 3) == tree.visit(x[0], tree.leaves)[:3]
    assert set(tree.assign(x)) == set(range(tree.leaves))


def test_recall_of_the_query(spark):
    sf = "/root/testdata/sf0.1"
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding").collect()
    want = plain([tuple(r) for r in rows], 5, 50)
    got = op6_ann(spark, sf).collect()
    by = {}
    for r in got:
        by.setdefault(r["query_id"], set()).add(r["vec_id"])
    assert all(len(by[i]) == 5 for i in want) and set(by) == set(want)
    assert sum(len(by[i] & {j for _, j in best}) for i, best in want.items()) >= 0.9 * 5 * len(want)


def test_probes_are_held_out_and_queries_outside_the_sample_find_their_neighbours():
    """50,000 vectors, the tree fitted on 20,000 of them, queries among the other 30,000."""
    rng = np.random.default_rng(5)
    centre = rng.normal(size=(60, 24))
    x = ann._unit(centre[rng.integers(0, 60, 50_000)] + 0.5 * rng.normal(size=(50_000, 24)))
    sample = x[:ann.SAMPLE]
    probes = ann.probes_of(sample)
    assert len(probes) == ann.PROBES
    tree = ann.Tree.fit(np.delete(sample, probes, axis=0))
    visits, leaf = ann.calibrate(tree, sample, probes, 5), tree.assign(x)
    hits = 0
    for q in range(ann.SAMPLE, 50_000, 150):
        score = x @ x[q]
        score[q] = -np.inf
        near = np.argpartition(-score, 5)[:5]
        hits += np.isin(leaf[near], tree.visit(x[q], visits)).sum()
    assert visits < tree.leaves / 2
    assert hits >= 0.96 * 5 * 200
