"""Training corpus pipeline: toxic documents go, recurring lines go, near copies go, benchmark leaks go, the rest is encoded.

Every stage takes (spark, docs, sf_dir), works on all rows that the stage before it kept, and returns a DataFrame. All but
the last return the columns they got; ``n_chars``, where there is one, follows the text. The last adds the token ids and
their byte offsets.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickfold.llm import bpe, decontam, minhash, templates, toxicity
from tickfold.llm.common import stage, table
from tickfold.llm.queries import RANKS, lexicon


def toxic_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the lexicon of the labelled ones calls toxic."""
    return toxicity.reject(docs, lexicon(docs, spark, sf_dir))


def recurring_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without lines whose template recurs, in all but its first document."""
    out = templates.deduplicate_lines(docs)
    if "n_chars" in out.columns:
        kind = dict(docs.dtypes)["n_chars"]
        out = out.withColumn("n_chars", F.char_length("text").cast(kind))
    return out


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies."""
    return minhash.deduplicate(docs)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that hold benchmark windows."""
    return decontam.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """With token ids and byte offsets."""
    return bpe.encode(docs, RANKS)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxic_documents),
    ("line_dedup", recurring_lines),
    ("near_dedup", near_duplicates),
    ("decontamination", benchmark_leaks),
    ("byte_bpe", encoded),
]

#: The toxicity lexicon is learned and the ids need the tokenizer's merges, so no SQL states these rows.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
