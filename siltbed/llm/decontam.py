"""Benchmark decontamination as a prefix-filtered set join, in DataFrame functions only.

Every item is cut into windows of ``window`` consecutive words (a shorter item is a
single window). A window is a set of ``shingle``-word shingles with their places;
contained means all of them, so by the prefix rule the rarest shingle alone is a
necessary token. Only that one is joined with the documents' shingles; its place
in the window then bounds where the window starts, which must leave room for the
window's length, and the words there are compared one by one.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltbed.llm.common import free_name, maybe_broadcast, quoted
from siltbed.session import stage

WINDOW = 13
SHINGLE = 3
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
EITHER_CASE = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"   # the same words before A-Z are lower case
BROADCAST_BYTES = 32 << 20


def words(text: Column) -> Column:
    """Words of a text with A-Z in lower case; null has none."""
    low = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    return F.regexp_extract_all(low, F.lit(WORD), F.lit(0))


def _shingles(df: DataFrame, size: int, *keys: str) -> DataFrame:
    """``keys``, pos (from 0) and the hash of every run of ``size`` words."""
    names = [f"w{i}" for i in range(size)]
    runs = F.arrays_zip(*(F.slice("words", i + 1, F.greatest(F.size("words") - size + 1, F.lit(0))).alias(n)
                          for i, n in enumerate(names)))
    out = df.select(*keys, F.posexplode(runs).alias("pos", "run"))
    return out.select(*keys, "pos", F.lit(size).alias("size"),
                      F.xxhash64(*(F.col("run")[n] for n in names)).alias("token"))


def _windows(items: DataFrame, window: int) -> DataFrame:
    """(window_id, words, item_ids): the distinct windows of all items."""
    last = F.greatest(F.size("words") - window, F.lit(0))
    starts = items.filter(F.size("words") > 0).select(
        "item_id", F.explode(F.transform(F.sequence(F.lit(0), last),
                                         lambda at: F.slice("words", at + 1, window))).alias("words"))
    return starts.groupBy("words").agg(F.collect_set("item_id").alias("item_ids")).select(
        F.monotonically_increasing_id().alias("window_id"), "words", "item_ids")


def _merged(found: Column) -> Column:
    """Words covered by spans (start, len) sorted by start."""
    zero = F.struct(F.lit(0).alias("hit"), F.lit(0).alias("end"))
    return F.aggregate(found, zero, lambda acc, x: F.struct(
        (acc["hit"] + F.greatest(F.lit(0), x["start"] + x["len"] - F.greatest(acc["end"], x["start"]))).alias("hit"),
        F.greatest(acc["end"], x["start"] + x["len"]).alias("end")))["hit"]


def contamination(docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text",
                  window: int = WINDOW, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, text, n_words, n_hit, item_ids) for every row of ``docs``.

    ``n_hit`` counts the words inside any occurrence of a window, ``item_ids`` are
    the items (as text, sorted as text) that have one. Null and empty texts have no
    words; items without words or id are in no result; repeated rows of documents
    come out as often as they go in, repeated items count once. Documents are told
    apart by id and text hash, so rows that share an id don't mix.
    """
    ident, text = quoted(id_col), quoted(text_col)
    items = benchmark.select(quoted(item_col).cast("string").alias("item_id"), words(quoted(item_text_col)).alias("words"))
    windows = stage(_windows(items.filter("item_id IS NOT NULL"), window), "bench-windows")
    windows = windows.withColumn("len", F.size("words"))
    # Windows under the shingle length are a shingle themselves; lengths are few.
    sizes = sorted(r[0] for r in windows.select(F.least("len", F.lit(shingle))).distinct().collect())
    short = F.least("len", F.lit(shingle))
    parts = stage(reduce(DataFrame.unionByName, [
        _shingles(windows.filter(short == n), n, "window_id", "len") for n in sizes or [shingle]]), "bench-shingles")

    keyed = docs.select(ident.alias("id"), F.xxhash64(text).alias("hash"), words(text).alias("words"))
    tokens = parts.select("size", "token").distinct()
    n_tokens = tokens.count()
    # Places of benchmark shingles in the corpus: the only read that explodes texts.
    seen = stage(reduce(DataFrame.unionByName, [
        _shingles(keyed, n, "id", "hash").join(
            maybe_broadcast(tokens.filter(F.col("size") == n), n_tokens), ["size", "token"], "left_semi")
        for n in sizes or [shingle]]), "corpus-shingles")
    rarity = seen.groupBy("size", "token").agg(F.count("*").alias("rarity"))
    ranked = parts.join(rarity, ["size", "token"], "left").fillna(0, ["rarity"])
    # The necessary prefix: the rarest shingle of each window. One that occurs
    # nowhere rules its window out.
    prefix = stage(ranked.groupBy("window_id", "len", "size").agg(
        F.min(F.struct("rarity", "pos", "token")).alias("p")).filter("p.rarity > 0").select(
            "window_id", "len", "size", F.col("p.pos").alias("offset"), F.col("p.token").alias("token")), "bench-prefix")
    n_prefix = prefix.count()
    candidates = seen.join(maybe_broadcast(prefix, n_prefix), ["size", "token"])
    candidates = candidates.select("id", "hash", (F.col("pos") - F.col("offset")).alias("start"), "window_id").filter("start >= 0")
    # Windows that no text can hold stay out; those left are as many as prefixes.
    able = windows.join(maybe_broadcast(prefix.select("window_id"), n_prefix), "window_id", "left_semi")
    spans = candidates.join(_small(stage(able, "able-windows")), "window_id").select(
        "id", "hash", F.struct("start", "len", "words", "item_ids").alias("span")).distinct()
    spans = stage(spans.groupBy("id", "hash").agg(F.sort_array(F.collect_list("span")).alias("spans")), "candidates")

    rows = docs.select(ident.alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("text_hash"))
    joined = rows.join(_small(spans), F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("text_hash") == F.col("hash")), "left")
    # Words are made again for texts that have candidates; the others need their number only.
    joined = joined.withColumn("n_words", F.coalesce(F.regexp_count("text", F.lit(EITHER_CASE)), F.lit(0))) \
        .withColumn("words", F.when(F.col("spans").isNotNull(), words(F.col("text"))))
    # Length bound, then the words themselves.
    held = F.filter(F.coalesce("spans", F.array().cast(spans.schema["spans"].dataType)), lambda s:
                    (s["start"] + s["len"] <= F.col("n_words")) & (F.slice(F.col("words"), s["start"] + 1, s["len"]) == s["words"]))
    return joined.withColumn("held", held).select(
        "doc_id", "text", F.col("n_words").cast("long").alias("n_words"), _merged(F.col("held")).cast("long").alias("n_hit"),
        F.array_sort(F.array_distinct(F.flatten(F.transform("held", lambda s: s["item_ids"])))).alias("item_ids"))


def _small(df: DataFrame) -> DataFrame:
    """A written table with a hint to broadcast it if its words are counted to be few bytes."""
    words_of = F.col("words") if "words" in df.columns else F.flatten(F.transform("spans", lambda s: s["words"]))
    size = df.agg(F.sum(F.octet_length(F.array_join(words_of, " ")) + 100 * F.size(words_of))).first()[0] or 0
    return F.broadcast(df) if size <= BROADCAST_BYTES else df


def contaminated(n_hit: Column, n_words: Column) -> Column:
    """At least a twentieth of the words is hit."""
    return (n_hit > 0) & (20 * n_hit >= n_words)


def clean(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without contaminated rows, all columns kept."""
    ident, digest = free_name(docs, "_bad_id"), free_name(docs, "_bad_hash")
    bad = contamination(docs, benchmark, id_col=id_col, text_col=text_col).filter(
        contaminated(F.col("n_hit"), F.col("n_words"))).select(
            F.col("doc_id").alias(ident), F.xxhash64("text").alias(digest)).distinct()
    bad = stage(bad, "contaminated")
    return docs.join(bad, quoted(id_col).eqNullSafe(F.col(ident)) & (F.xxhash64(quoted(text_col)) == F.col(digest)),
                     "left_anti").select(*map(quoted, docs.columns))
