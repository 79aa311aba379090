"""SimHash near-duplicate groups through a Gray-order hierarchical index.

Fingerprints are sorted by their rank in Gray order, where neighbours share most
bits. Runs of them become nodes: a node holds the bits all its members share
(mask and pattern), its parent the bits all its children share, so a search adds
up differences once per shared bit on its way down and drops a whole group when
the sum passes the limit. The upper part of the tree deals fingerprints to shards,
the lower part is built and searched inside a shard's tasks.

Links inside a shard are folded to one edge per fingerprint at once, so a group of
near copies costs rows in proportion to its size; components are then contracted
with joins. Only node tables of bounded size (``MAX_SHARDS``) reach the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltbed.llm.common import free_name, maybe_broadcast, quoted, utf8
from siltbed.session import stage

SEED = 42
SHARD = 32_768          # fingerprints a shard aims at
SALTS = 1024            # parts of a component that are named in tasks of their own
MAX_SHARDS = 65_536     # nodes of the upper part; shards grow beyond
VISITORS = 262_144      # fingerprints of other shards one task searches for
FANOUT = 8
FRONTIER = 2_048        # searched for at a time
_RUN = 1 << 16


def fingerprint(data: bytes, shingle: int = 3) -> int:
    """SimHash of a UTF-8 text as a signed 64-bit number.

    Words are runs of other bytes than ASCII white space, A-Z in lower case. A bit
    is 1 if set in over half the shingle hashes. A text without words has 0; one
    with fewer words than a shingle has a single shingle.
    """
    words = data.lower().split()
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    counts = np.zeros(64, np.int64)
    for at in range(0, n, _RUN):
        run = words[at:at + _RUN + shingle - 1]
        parts = map(b" ".join, zip(*(run[i:] for i in range(shingle)))) if len(run) >= shingle else [b" ".join(run)]
        digests = b"".join(map(xxhash.xxh64_digest, parts, repeat(SEED)))
        counts += np.unpackbits(np.frombuffer(digests, np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > n).tobytes(), "big", signed=True)


def fingerprint_column(text: Column, shingle: int = 3) -> Column:
    @F.pandas_udf("long")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([fingerprint(x, shingle) for x in batch], dtype="int64")

    return run(utf8(text))


def gray_rank(fp: Column) -> Column:
    """Place of a fingerprint in Gray order, as a signed number of the same order."""
    for by in (1, 2, 4, 8, 16, 32):
        fp = fp.bitwiseXOR(F.shiftrightunsigned(fp, by))
    return fp.bitwiseXOR(F.lit(-2 ** 63))


class GrayTree:
    """Nodes over items in Gray order, each with the bits its items share.

    Items are (pattern, mask): a fingerprint has a full mask, a shard the bits its
    members share. ``levels`` run from the root's children down to the items; of
    each node they keep the pattern, the bits it adds to its parent's, and where
    its children start.
    """

    def __init__(self, pattern: np.ndarray, mask: np.ndarray):
        levels = [(pattern, mask)]
        while len(levels[-1][0]) > FANOUT:
            p, m = levels[-1]
            starts = np.arange(0, len(p), FANOUT)
            one = np.bitwise_and.reduceat(p | ~m, starts)       # bits that are 1 in all that have them
            shared = np.bitwise_and.reduceat(m, starts)
            some = np.bitwise_or.reduceat(p & m, starts)
            levels.append((one & shared, shared & ~(one ^ some)))
        self.levels = []
        above = np.zeros(1, np.uint64)
        for p, m in reversed(levels):
            self.levels.append((p, m & ~np.repeat(above, FANOUT)[:len(m)]))
            above = m

    def search(self, queries: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
        """(query, item) index pairs within ``limit`` differing bits of the masks."""
        width = len(self.levels[0][0])
        q = np.repeat(np.arange(len(queries)), width)
        node = np.tile(np.arange(width), len(queries))
        total = np.zeros(len(q), np.uint8)
        for depth, (pattern, extra) in enumerate(self.levels):
            if depth:
                size = np.minimum(FANOUT, len(pattern) - node * FANOUT)
                first = np.repeat(node * FANOUT, size)
                inside = np.arange(len(first)) - np.repeat(np.cumsum(size) - size, size)
                q, total, node = np.repeat(q, size), np.repeat(total, size), first + inside
            total = total + np.bitwise_count((queries[q] ^ pattern[node]) & extra[node])
            kept = total <= limit
            q, node, total = q[kept], node[kept], total[kept]
        return q, node


def _join(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Merge the classes of linked pairs; ``label`` points to each class's least index."""
    while len(a):
        la, lb = label[a], label[b]
        far = la != lb
        if not far.any():
            return
        a, b, la, lb = a[far], b[far], la[far], lb[far]
        np.minimum.at(label, np.maximum(la, lb), np.minimum(la, lb))
        while True:
            above = label[label]
            if np.array_equal(above, label):
                break
            label[:] = above


def _shard_edges(members: np.ndarray, visitors: np.ndarray, limit: int) -> pd.DataFrame:
    """One edge to the least of its class for every fingerprint linked in this shard."""
    members = members[np.argsort(_rank(members), kind="stable")]
    tree = GrayTree(members, np.full(len(members), ~np.uint64(0)))
    everyone = np.concatenate([members, visitors])
    label = np.arange(len(everyone))
    for at in range(0, len(everyone), FRONTIER):
        q, item = tree.search(everyone[at:at + FRONTIER], limit)
        _join(label, q + at, item)
    linked = np.flatnonzero(label != np.arange(len(label)))
    return pd.DataFrame({"a": everyone[linked].view(np.int64), "b": everyone[label[linked]].view(np.int64)})


def _rank(fp: np.ndarray) -> np.ndarray:
    out = fp.copy()
    for by in (1, 2, 4, 8, 16, 32):
        out ^= out >> np.uint64(by)
    return out


def links(fps: DataFrame, limit: int) -> DataFrame:
    """Edges (a, b) that connect exactly the distinct ``fp`` values within ``limit`` bits.

    Not every close pair gets an edge of its own, but two fingerprints are joined
    by a path of edges if and only if they are by a path of close pairs.
    """
    spark = fps.sparkSession
    n = fps.count()
    shards = min(MAX_SHARDS, max(1, n // SHARD))
    dealt = stage(fps.select("fp").repartitionByRange(shards, gray_rank(F.col("fp")))
                  .select("fp", F.spark_partition_id().alias("shard")), "gray-shards")
    # One row per shard, MAX_SHARDS and the range exchange's partitions at most.
    nodes = dealt.groupBy("shard").agg(
        F.bit_and("fp").alias("one"), F.bit_or("fp").alias("some")).orderBy("shard").toPandas()
    one, some = nodes["one"].to_numpy(np.int64).view(np.uint64), nodes["some"].to_numpy(np.int64).view(np.uint64)
    shard = nodes["shard"].to_numpy()
    upper = spark.sparkContext.broadcast((one, ~(one ^ some), shard))

    def route(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pattern, mask, ids = upper.value
        tree = GrayTree(pattern, mask) if len(ids) else None
        for batch in batches:
            fp, own = batch["fp"].to_numpy(np.int64), batch["shard"].to_numpy()
            for at in range(0, len(fp), FRONTIER):
                part = fp[at:at + FRONTIER]
                q, node = tree.search(part.view(np.uint64), limit)
                on = ids[node] > own[at:at + FRONTIER][q]
                yield pd.DataFrame({"fp": part[q[on]], "shard": ids[node[on]]})

    visits = stage(dealt.mapInPandas(route, "fp long, shard int"), "gray-visits")
    # Visitors of a busy shard are dealt over several tasks, each with its members.
    blocks = visits.groupBy("shard").agg(F.ceil(F.count("*") / VISITORS).cast("int").alias("blocks"))
    blocks = F.broadcast(blocks)
    visitors = visits.join(blocks, "shard").select(
        "fp", "shard", F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int").alias("block"), F.lit(True).alias("visitor"))
    members = dealt.join(blocks, "shard", "left").select(
        "fp", "shard", F.explode(F.sequence(F.lit(0), F.coalesce("blocks", F.lit(1)) - 1)).alias("block"),
        F.lit(False).alias("visitor"))

    def task(group: pd.DataFrame) -> pd.DataFrame:
        fp, visitor = group["fp"].to_numpy(np.int64).view(np.uint64), group["visitor"].to_numpy(bool)
        return _shard_edges(fp[~visitor], fp[visitor], limit)

    return members.unionByName(visitors).groupBy("shard", "block").applyInPandas(task, "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for all nodes of ``edges`` (a, b): the same root for a component.

    Contraction: every node that has a smaller neighbour points to the smallest,
    pointers are followed twice, edges move to what their ends point to. Each round
    is a few joins over what is left; written tables cut the lineage.
    """
    a, b = F.col("a"), F.col("b")

    def tidy(e: DataFrame) -> DataFrame:
        return e.filter(a != b).select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).distinct()

    def moved(t: DataFrame, column: str, hooks: DataFrame) -> DataFrame:
        hop = hooks.select(F.col("a").alias(column), F.col("to").alias("_to"))
        return t.join(hop, column, "left").withColumn(column, F.coalesce("_to", column)).drop("_to")

    edges = stage(tidy(edges), "component-edges")
    roots = edges.select(a.alias("node")).union(edges.select(b)).distinct().withColumn("root", F.col("node"))
    while not edges.isEmpty():
        hooks = stage(edges.groupBy("a").agg(F.min("b").alias("to")), "component-hooks")
        for _ in range(2):
            hooks = moved(hooks, "to", hooks)
        hooks = stage(hooks, "component-hooks")
        roots = stage(moved(roots, "root", hooks), "component-roots")
        edges = stage(tidy(moved(moved(edges, "a", hooks), "b", hooks)), "component-edges")
    return roots


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *,
                    shingle: int = 3, max_bits: int = 3) -> DataFrame:
    """(doc_id, fp, component_id, root) for every row of ``docs``.

    ``component_id`` is the least ``doc_id`` reachable over links of ``max_bits`` or
    fewer differing bits, ``root`` a fingerprint that names the component. Null and
    empty texts have fingerprint 0 and link like any other; repeated rows come out as
    often as they go in; the ``component_id`` of rows with null ids alone is null. An
    empty table gives no rows. Other columns are not read.
    """
    rows = stage(docs.select(quoted(id_col).alias("doc_id"),
                             fingerprint_column(quoted(text_col), shingle).alias("fp")), "simhash-rows")
    fps = stage(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-distinct")
    linked = fps.join(components(links(fps, max_bits)).withColumnRenamed("node", "fp"), "fp").withColumn(
        "salt", F.pmod(F.xxhash64("fp"), F.lit(SALTS)))
    # A component of very many fingerprints meets its name in many tasks.
    parts = linked.groupBy("root", "salt").agg(F.min("least").alias("least_of_part"))
    whole = parts.groupBy("root").agg(F.min("least_of_part").alias("component_id"))
    named = linked.join(parts.join(whole, "root").select("root", "salt", "component_id"), ["root", "salt"])
    alone = fps.join(named.select("fp"), "fp", "left_anti").select(
        "fp", F.col("least").alias("component_id"), F.col("fp").alias("root"))
    names = stage(named.select("fp", "component_id", "root").unionByName(alone), "simhash-names")
    return rows.join(names, "fp", "left").select("doc_id", "fp", "component_id", "root")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *,
             shingle: int = 3, max_bits: int = 3) -> DataFrame:
    """``docs`` with one row of each near-duplicate group, all columns kept.

    The row whose id is the component's stays; of several with that id, and in a
    component of null ids alone, one of the least fingerprint.
    """
    found = stage(near_duplicates(docs, id_col, text_col, shingle=shingle, max_bits=max_bits), "simhash-found")
    first = F.col("doc_id").eqNullSafe(F.col("component_id"))
    ids = stage(found.groupBy("doc_id").agg(F.count("*").alias("n"), F.max(first).alias("first")), "simhash-ids")
    unique = F.col("doc_id").isNotNull() & (F.col("n") == 1)
    # Fewer rows go than stay, so those that go are what is joined.
    gone = ids.filter(F.col("doc_id").isNotNull() & ~(unique & F.col("first")))
    out = docs.filter(quoted(id_col).isNotNull()).join(
        maybe_broadcast(gone.select(F.col("doc_id").alias(id_col)), gone.count()), id_col, "left_anti")
    out = out.select(*map(quoted, docs.columns))
    again = ids.filter(~unique)
    if again.isEmpty():
        return out
    # An id that comes again doesn't tell rows apart; with the fingerprint it does.
    kept = found.filter(first).groupBy("root").agg(F.min("doc_id").alias("kept_id"), F.min("fp").alias("kept_fp"))
    kept = kept.join(again, F.col("kept_id").eqNullSafe(F.col("doc_id")), "left_semi")
    fp, key = free_name(docs, "_fp"), free_name(docs, "_kept")
    several = kept.select(F.col("kept_id").alias(key), F.col("kept_fp").alias(f"{fp}_{key}"))
    rows = docs.withColumn(fp, fingerprint_column(quoted(text_col), shingle))
    rows = rows.join(several, quoted(id_col).eqNullSafe(F.col(key)) & (F.col(fp) == F.col(f"{fp}_{key}")))
    return out.unionByName(rows.dropDuplicates([fp]).select(*map(quoted, docs.columns)))
