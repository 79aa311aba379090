"""Registered queries: one ``opN_`` per operator, over its whole table."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltbed.llm import ann, bpe, chat, cotrain, crossalign, decontam, packing, pii, simhash, suffixdedup, toxicity, unitdedup, variants
from siltbed.llm.common import table
from siltbed.session import stage

TOKENIZERS = os.environ.get("TOKENIZER_DIR", "/opt/tokenizers")


def tokenizer_path(name: str) -> str:
    return os.path.join(TOKENIZERS, name)


def training(ident: Column) -> Column:
    """Ids whose labels may be learnt from; the rest are held out."""
    return toxicity.fold(ident) != 2


def op1_cotraining(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = cotrain.train(docs, table(spark, sf_dir, "labels"), usable=training)
    found = cotrain.scored(docs, model)
    return found.select("doc_id", (toxicity.fold(F.col("doc_id")) == 2).alias("held_out"), "content_score", "metadata_score",
                        "score", (F.col("score") >= cotrain.THRESHOLD).cast("int").alias("predicted"))


def op2_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffixdedup.deduplicated(table(spark, sf_dir, "documents"))
    removed = F.aggregate("removed", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("removed").cast("long").alias("n_spans"),
                        F.sha2("kept", 256).alias("kept_sha256"))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        decontam.contaminated(F.col("n_hit"), F.col("n_words")).alias("contaminated"))


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digest(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.personal_data(table(spark, sf_dir, "documents"), pii.trained())
    base = F.col("base")
    return found.select("doc_id", *(pii.count_of(base, k).alias(f"n_{k}") for k in pii.BASE_KINDS),
                        F.sha2(pii.as_text(base), 256).alias("base_sha256"), pii.as_text(F.col("spans")).alias("spans"))


def op6_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"), k=5, every=50)


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, max_bits=3)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op8_unitdedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = unitdedup.deduplicated(table(spark, sf_dir, "documents"))
    spans = F.transform("removed", lambda s: F.concat_ws(":", s["start"].cast("string"), s["end"].cast("string")))
    removed = F.aggregate("removed", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select("doc_id", removed.alias("n_removed"), F.size("removed").cast("long").alias("n_spans"),
                        F.array_join(spans, ",").alias("removed_spans"), F.sha2("kept_text", 256).alias("kept_sha256"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), usable=training)
    scored, name = toxicity.with_scores(docs.select("doc_id", "text"), model)
    score = F.col(f"{name}.score")
    return scored.select("doc_id", (toxicity.fold(F.col("doc_id")) == 2).alias("held_out"), score.alias("score"),
                         (score >= toxicity.THRESHOLD).cast("int").alias("predicted"),
                         F.arrays_zip(F.col(f"{name}.starts").alias("start"), F.col(f"{name}.ends").alias("end")).alias("sentences"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = packing.write(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), end=0)
    return packing.read_back(spark, manifest)


LETTERS = "[A-Za-z\u00C0-\u00FF]"


def with_slips(ident: Column, run: Column) -> Column:
    """A run, less one code point where 31 divides the crc32 of id and run."""
    h = F.crc32(F.concat(ident, F.lit(":"), run))
    at = F.pmod(h, F.length(run))
    cut = F.concat(F.substring(run, F.lit(1), at.cast("int")), F.substring(run, (at + 2).cast("int"), F.length(run)))
    return F.when(h % 31 == 0, cut).otherwise(run)


def op11_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = variants.runs(table(spark, sf_dir, "documents"), LETTERS, least=7)
    return variants.grouped(variants.vocabulary(runs, with_slips(F.col("id"), F.col("run")), least=7, seen=2), ratio=10)


def op12_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = "\\### Assistant: </turn> ok"
    more = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                 F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(marked).alias("text"))
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(more)
    return chat.read_back(stage(chat.formatted(rows), "chat"))


def op13_crossalign(spark: SparkSession, sf_dir: str) -> DataFrame:
    return crossalign.aligned(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model"))


QUERIES = {
    "op1_cotraining": op1_cotraining,
    "op2_suffixes": op2_suffixes,
    "op3_decontamination": op3_decontamination,
    "op4_bpe": op4_bpe,
    "op5_pii": op5_pii,
    "op6_ann": op6_ann,
    "op7_simhash": op7_simhash,
    "op8_unitdedup": op8_unitdedup,
    "op9_toxicity": op9_toxicity,
    "op10_packing": op10_packing,
    "op11_variants": op11_variants,
    "op12_chat": op12_chat,
    "op13_crossalign": op13_crossalign,
}
