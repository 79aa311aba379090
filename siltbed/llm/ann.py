"""Nearest neighbours by cosine through a hierarchical k-means tree.

The tree is fitted on a bounded sample, every vector is then put into one of its
leaves. A query walks the tree best bin first: a priority queue holds nodes by their
centre's cosine, the best is opened, leaves are visited in the order they come out.
How many leaves are visited is calibrated with part of the sample that the tree is not
fitted on: the number is widened until the recall against brute force reaches the target.

Equal vectors are one entry with their least ids, as many as a result can show, so a
vector that a third of the rows share costs one comparison. Leaves meet queries in groups of
neighbouring leaves: a query goes once to each group it visits, with the list of its leaves
there, and is compared with the entries of those leaves only. Groups and the queries that visit
them are cut into blocks of bounded size before they meet.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltbed.llm.common import quoted
from siltbed.session import stage

SAMPLE = 20_000         # vectors the tree is fitted on, by hash
FANOUT = 16
LEAF = 24               # sample vectors under which a node isn't split
ROUNDS = 8
PROBES = 300            # sample vectors the visits are calibrated with, at most a tenth of them
TARGET = 0.98
MEMBERS, QUERIES = 4_096, 2_048     # of a block
GROUP = 32              # leaves that a query meets at once
WALKS = 128             # queries that a task walks, about
TASKS = 20_000          # tasks of the walk at most


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.linalg.norm(x, axis=1, keepdims=True)


class Tree:
    """Centres per node; children of a node are consecutive. Leaves are numbered."""

    def __init__(self, centres: np.ndarray, first: np.ndarray, count: np.ndarray, leaf: np.ndarray):
        self.centres, self.first, self.count, self.leaf = centres, first, count, leaf

    @classmethod
    def fit(cls, x: np.ndarray, seed: int = 7) -> Tree:
        rng = np.random.default_rng(seed)
        centres, first, count, leaf = [x.mean(axis=0)], [0], [0], [-1]
        queue, leaves = [(0, np.arange(len(x)))], 0
        for node, rows in queue:            # grows while it is read
            own = x[rows]
            label = cls._split(own, rng) if len(rows) > LEAF else None
            if label is None:
                leaf[node], leaves = leaves, leaves + 1
                continue
            first[node], count[node] = len(centres), int(label.max()) + 1
            for k in range(count[node]):
                queue.append((len(centres), rows[label == k]))
                centres.append(own[label == k].mean(axis=0))
                first.append(0)
                count.append(0)
                leaf.append(-1)
        c = np.array(centres)
        return cls(c / np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-300), np.array(first), np.array(count), np.array(leaf))

    @staticmethod
    def _split(x: np.ndarray, rng: np.random.Generator) -> np.ndarray | None:
        k = min(FANOUT, max(2, len(x) // (LEAF // 2)))
        centre = x[rng.choice(len(x), k, replace=False)]
        for _ in range(ROUNDS):
            label = (x @ centre.T).argmax(axis=1)
            sums = np.zeros_like(centre)
            np.add.at(sums, label, x)
            size = np.linalg.norm(sums, axis=1, keepdims=True)
            centre = np.where(size > 0, sums / np.maximum(size, 1e-300), centre)
        used, label = np.unique((x @ centre.T).argmax(axis=1), return_inverse=True)
        return label if len(used) > 1 else None

    def assign(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each vector: the best child all the way down."""
        node = np.zeros(len(x), np.int64)
        while True:
            inner = np.flatnonzero(self.count[node] > 0)
            if not len(inner):
                return self.leaf[node]
            for n in np.unique(node[inner]):
                rows = inner[node[inner] == n]
                kids = slice(self.first[n], self.first[n] + self.count[n])
                node[rows] = self.first[n] + (x[rows] @ self.centres[kids].T).argmax(axis=1)

    def visit(self, q: np.ndarray, leaves: int) -> list[int]:
        """The first leaves that best bin first reaches."""
        heap, out = [(0.0, 0)], []
        while heap and len(out) < leaves:
            _, n = heapq.heappop(heap)
            if self.count[n]:
                a, k = self.first[n], self.count[n]
                for i, s in enumerate(self.centres[a:a + k] @ q):
                    heapq.heappush(heap, (-float(s), int(a + i)))
            else:
                out.append(int(self.leaf[n]))
        return out

    @property
    def leaves(self) -> int:
        return int(self.leaf.max()) + 1


def probes_of(x: np.ndarray) -> np.ndarray:
    """Evenly spaced rows to calibrate with; none of a sample of under ten."""
    n = min(PROBES, len(x) // 10)
    return np.unique(np.linspace(0, len(x) - 1, n).astype(int))


def calibrate(tree: Tree, x: np.ndarray, probes: np.ndarray, k: int, target: float = TARGET) -> int:
    """Leaves to visit so that the probes, rows of ``x``, find ``target`` of their ``k`` nearest in it."""
    leaf = tree.assign(x)
    needed = []
    for p in probes:
        score = x @ x[p]
        score[p] = -np.inf
        near = np.argsort(-score, kind="stable")[:k]
        place = {n: i for i, n in enumerate(tree.visit(x[p], tree.leaves))}
        needed += [place[leaf[n]] + 1 for n in near if n != p]
    needed = np.array(needed or [1])
    visits = 1
    while (needed <= visits).mean() < target:
        visits = min(tree.leaves, visits + max(1, visits // 8))
    return visits


def usable(vector: Column) -> Column:
    """Neither null nor zero, all components finite numbers."""
    good = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(vector.isNotNull() & good & F.exists(vector, lambda x: x != 0), F.lit(False))


def nearest(vectors: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 5,
            every: int = 50, target: float = TARGET) -> DataFrame:
    """(query_id, rank, vec_id, score) for each id divisible by ``every``.

    ``score`` is the cosine in double precision; ties go to the smaller id. Rows with
    an unusable vector or a null id, and vectors of another length than most, take no
    part; rows repeated whole count once; an id never finds itself. Fewer rows than
    ``k`` others give them all.
    """
    spark = vectors.sparkSession
    rows = vectors.select(quoted(id_col).cast("long").alias("vec_id"),
                          quoted(vector_col).cast("array<double>").alias("v"))
    rows = rows.filter(F.col("vec_id").isNotNull() & usable(F.col("v")))
    most = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    schema = "query_id long, rank int, vec_id long, score double"
    if most is None:
        return spark.createDataFrame([], schema)
    rows = stage(rows.filter(F.size("v") == most["n"]).distinct(), "ann-rows")
    by_id = Window.partitionBy("v").orderBy("vec_id")
    entries = rows.withColumn("place", F.row_number().over(by_id)).filter(F.col("place") <= k + 1)
    entries = entries.groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))

    sample = entries.select("v").orderBy(F.xxhash64("v"), "v").limit(SAMPLE).toPandas()
    x = _unit(np.stack(sample["v"].to_numpy()).astype(float))
    probes = probes_of(x)
    tree = Tree.fit(np.delete(x, probes, axis=0))
    visits = calibrate(tree, x, probes, k, target)
    shared = spark.sparkContext.broadcast((tree.centres, tree.first, tree.count, tree.leaf, visits))

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = Tree(*shared.value[:4])
        for batch in batches:
            yield batch.assign(leaf=own.assign(_unit(np.stack(batch["v"].to_numpy()))) if len(batch) else [])

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = Tree(*shared.value[:4])
        for batch in batches:
            for i in range(0, len(batch), WALKS):
                out = []
                for v, qkey in zip(batch["v"].iloc[i:i + WALKS], batch["qkey"].iloc[i:i + WALKS]):
                    leaves = np.sort(own.visit(v / np.linalg.norm(v), shared.value[4]))
                    groups, first = np.unique(leaves // GROUP, return_index=True)
                    out += [(qkey, v, g, part) for g, part in zip(groups, np.split(leaves, first[1:]))]
                yield pd.DataFrame(out, columns=["qkey", "v", "grp", "leaves"])

    asked = rows.filter(F.pmod("vec_id", F.lit(every)) == 0)
    queries = stage(asked.groupBy("v").agg(F.min("vec_id").alias("qkey")), "ann-queries")
    tasks = min(TASKS, -(-queries.count() // WALKS)) or 1
    members = stage(entries.mapInPandas(assign, "v array<double>, ids array<long>, leaf int"), "ann-members")
    members = members.withColumn("grp", F.floor(F.col("leaf") / GROUP).cast("int"))
    visited = stage(queries.repartition(tasks, "qkey").mapInPandas(
        walk, "qkey long, v array<double>, grp int, leaves array<int>"), "ann-visits")
    # One row per group of leaves: fewer than the sample has vectors.
    blocks = members.groupBy("grp").agg(F.ceil(F.count("*") / MEMBERS).cast("int").alias("m_blocks")).join(
        visited.groupBy("grp").agg(F.ceil(F.count("*") / QUERIES).cast("int").alias("q_blocks")), "grp")
    blocks = F.broadcast(stage(blocks, "ann-blocks"))

    def spread(df: DataFrame, key: Column, own: str, other: str) -> DataFrame:
        df = df.join(blocks, "grp").withColumn(own, F.pmod(F.xxhash64(key), F.col(f"{own}_blocks")).cast("int"))
        return df.withColumn(other, F.explode(F.sequence(F.lit(0), F.col(f"{other}_blocks") - 1))).drop("m_blocks", "q_blocks")

    def compare(q: pd.DataFrame, m: pd.DataFrame) -> pd.DataFrame:
        if not len(q) or not len(m):
            return pd.DataFrame({"qkey": [], "vec_id": [], "score": []})
        m = m.sort_values("leaf", kind="stable")
        a, b, leaf = _unit(np.stack(q["v"].to_numpy())), _unit(np.stack(m["v"].to_numpy())), m["leaf"].to_numpy()
        wanted = np.concatenate(q["leaves"].to_numpy())
        asker = np.repeat(np.arange(len(q)), [len(x) for x in q["leaves"]])
        score = np.full((len(a), len(b)), -np.inf)
        for n in np.unique(leaf):
            who, own = asker[wanted == n], slice(*np.searchsorted(leaf, [n, n + 1]))
            score[who, own] = a[who] @ b[own].T
        keep = min(k + 1, len(b))
        least = np.partition(score, -keep, axis=1)[:, [-keep]]
        # A hair under the least, for equal cosines may be rounded apart.
        near, entry = np.nonzero((score >= least - 1e-12) & (score > -np.inf))
        if not len(near):
            return pd.DataFrame({"qkey": [], "vec_id": [], "score": []})
        a, b = np.stack(q["v"].to_numpy()), np.stack(m["v"].to_numpy())
        exact = np.einsum("ij,ij->i", a[near], b[entry]) / (np.linalg.norm(a, axis=1)[near] * np.linalg.norm(b, axis=1)[entry])
        ids = m["ids"].to_numpy()[entry]
        size = np.fromiter(map(len, ids), np.int64, len(ids))
        return pd.DataFrame({"qkey": np.repeat(q["qkey"].to_numpy()[near], size), "vec_id": np.concatenate(ids),
                             "score": np.repeat(exact, size)})

    keys = ("grp", "m", "q")
    found = spread(visited, F.col("qkey"), "q", "m").groupBy(*keys).cogroup(
        spread(members, F.col("v"), "m", "q").groupBy(*keys)).applyInPandas(compare, "qkey long, vec_id long, score double")
    best = Window.partitionBy("qkey").orderBy(F.desc("score"), "vec_id")
    found = stage(found.withColumn("place", F.row_number().over(best)).filter(F.col("place") <= k + 1), "ann-found")
    # Back to every query of an equal vector, each without itself.
    named = asked.join(queries, "v").select(F.col("vec_id").alias("query_id"), "qkey")
    pairs = named.join(found, "qkey").filter(F.col("vec_id") != F.col("query_id"))
    last = Window.partitionBy("query_id", "qkey").orderBy(F.desc("score"), "vec_id")
    return pairs.withColumn("rank", F.row_number().over(last)).filter(F.col("rank") <= k).select(
        "query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
