"""Registered queries of the operators, over the whole tables."""

from __future__ import annotations

import string
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickfold.llm import bpe, cotrain, decontam, fim, iblt, langid, llr, merkle, minhash, slots, suffix_tree, templates, toxicity
from tickfold.llm.common import fold_of, table
from tickfold.session import stage

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def op1_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, _, cls, flag = minhash.classes(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return rows.select("doc_id", cls, flag)


def lexicon(docs: DataFrame, spark: SparkSession, sf_dir: str) -> toxicity.Lexicon:
    """Learned from labelled rows outside the held-out fold."""
    learn = docs.filter(fold_of("doc_id", 4) != 2)
    return toxicity.fit(toxicity.labelled(learn, table(spark, sf_dir, "labels")))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity.scores(docs, lexicon(docs, spark, sf_dir), keep=["doc_id"])
    return scored.select("doc_id", (fold_of("doc_id", 4) == 2).alias("held_out"), "score", "predicted")


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = bpe.encode(docs, RANKS, keep=["doc_id"], offsets=False, decoded=True)
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return templates.drop_recurring(table(spark, sf_dir, "documents").select("doc_id", "text"))[0]


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontam.contamination(docs, table(spark, sf_dir, "benchmark"), keep=["doc_id"])
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed, _ = slots.shard(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "virtual_slot",
        "piece",
        F.col("version").alias("table_version"),
    )


def op7_cotraining(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels of the held-out fold (crc32 of the id modulo 4 is 2) are not learned from."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    labels = table(spark, sf_dir, "labels").filter(fold_of("doc_id", 4) != 2)
    scored = cotrain.scores(docs, cotrain.fit(docs, labels), keep=["doc_id"])
    return scored.withColumn("held_out", fold_of("doc_id", 4) == 2)


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "pages"), table(spark, sf_dir, "documents").select("lang", "text"))


def op9_suffix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = suffix_tree.scores(docs, docs.filter(fold_of("doc_id", 10) != 0))
    return scored.select(
        "doc_id", (fold_of("doc_id", 10) == 0).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    trusted = table(spark, sf_dir, "labels").filter("quality = 1").select("doc_id")
    return llr.quality_rules(docs, trusted, keep=["doc_id"])


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every third document (by the crc32 of its id) is proved with its text's A-Z in lower case, which its proof refutes."""
    docs = table(spark, sf_dir, "documents").select(*merkle.FIELDS)
    lowered = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    other = merkle.leaf([lowered if c == "text" else F.col(c) for c in merkle.FIELDS])
    made = merkle.manifest(docs, changed=F.when(fold_of("doc_id", 3) == 0, other))
    return merkle.proofs(made).withColumnRenamed("id", "doc_id")


def op12_fim(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    plans = fim.planned(stage(fim.store(docs), "fim-frames"))
    made = fim.digests(plans, keep=["doc_id", "n_units", "form"])
    return made.select("doc_id", F.col("n_units").alias("n"), "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256")


def op13_iblt(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return iblt.fingerprints(docs).withColumnRenamed("id", "doc_id")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_minhash": op1_minhash,
    "op2_toxicity": op2_toxicity,
    "op3_bpe": op3_bpe,
    "op4_line_dedup": op4_line_dedup,
    "op5_decontamination": op5_decontamination,
    "op6_sharding": op6_sharding,
    "op7_cotraining": op7_cotraining,
    "op8_language_id": op8_language_id,
    "op9_suffix_tree": op9_suffix_tree,
    "op10_quality_rules": op10_quality_rules,
    "op11_merkle": op11_merkle,
    "op12_fim": op12_fim,
    "op13_iblt": op13_iblt,
}
