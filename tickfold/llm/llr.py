"""Quality rules with a hashed n-gram likelihood ratio, in native expressions.

Words and word pairs are hashed into ``BUCKETS`` buckets. Two multinomials over the buckets are counted, one of trusted
documents and one of the whole raw corpus; a document's verdict is the mean log ratio of its n-grams against a fixed
threshold. Counts are folded per task before they move, so the shuffle carries one row per bucket and task.

Null and empty texts have no words: counts of 0, ratio 0, and the base rules reject them. Repeated rows count each time.
Without trusted documents, or with an empty table, all ratios are 0. New columns replace kept ones of the same name.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickfold.llm.common import free_name, narrow_join

BUCKETS = 10_000
#: Added to every bucket of both multinomials.
PSEUDO_COUNT = 1.0
#: A document is kept if the mean log ratio of its n-grams is at least this.
THRESHOLD = -0.04

SPACES = r"[\\x20\\x09-\\x0D]+"
NOT_SPACE = r"[^\\x20\\x09-\\x0D]"
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

NEW = {
    "n_words": "CAST(size(h) AS BIGINT)",
    "word_chars": "CAST(word_chars AS BIGINT)",
    "n_symbols": f"CAST(regexp_count(x, '[{SYMBOLS}]') AS BIGINT)",
    "n_dup_lines": "CAST(size(lines) - size(array_distinct(lines)) AS BIGINT)",
}


WORDS = f"array_remove(split(x, '{SPACES}'), '')"


def _beside(a: str, fold: str, steps: int = 1) -> str:
    """SQL: ``fold`` of each element of array ``a`` and the one ``steps`` later."""
    n = f"greatest(size({a}) - {steps}, 0)"
    return f"zip_with(slice({a}, 1, {n}), slice({a}, {steps + 1}, {n}), (p, q) -> {fold})"


def bucket_counts(docs: DataFrame, trusted: str, text: str = "text", buckets: int = BUCKETS) -> list[tuple[int, int, int]]:
    """(bucket, raw count, trusted count): ``buckets`` rows at most. ``trusted`` is a boolean column."""
    words = docs.select(F.col(trusted).alias("t"), F.coalesce(text, F.lit("")).alias("x")).selectExpr("t", f"{WORDS} AS words")
    # neighbours side by side, without a lambda: the last word stands beside null
    beside = words.selectExpr("t", "inline(arrays_zip(words, slice(words, 2, greatest(size(words), 1)))) AS (a, b)")
    keys = "array(xxhash64(a), CASE WHEN b IS NOT NULL THEN xxhash64(xxhash64(a), xxhash64(b)) END)"
    grams = beside.selectExpr("t", f"explode({keys}) AS g").filter("g IS NOT NULL")
    counted = grams.groupBy(F.pmod("g", F.lit(buckets)).cast("int").alias("b")).agg(
        F.count("*").alias("raw"), F.count_if("t").alias("good")
    )
    return [tuple(r) for r in counted.collect()]


def log_ratios(counts: list[tuple[int, int, int]], buckets: int = BUCKETS) -> list[float]:
    """Log of the trusted over the raw probability of every bucket, to a fixed number of digits."""
    raw, good = [0] * buckets, [0] * buckets
    for b, n, m in counts:
        raw[b], good[b] = n, m
    if not sum(good):
        return [0.0] * buckets
    all_raw, all_good = sum(raw) + PSEUDO_COUNT * buckets, sum(good) + PSEUDO_COUNT * buckets
    return [
        round(math.log((m + PSEUDO_COUNT) / all_good) - math.log((n + PSEUDO_COUNT) / all_raw), 6) for n, m in zip(raw, good)
    ]


def measures(docs: DataFrame, ratios: list[float], text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns with the counts, ``log_ratio`` (mean over the n-grams), ``base_failed`` and ``kept``.

    Every array is a column before it is used twice, so it is made once for each document.
    """
    own = [*NEW, "n_repeat_words", "log_ratio", "base_failed", "kept"]
    keep = [c for c in (docs.columns if keep is None else keep) if c.lower() not in own]
    held = [f"k{i}" for i in range(len(keep))]
    weights = f"CAST(split('{','.join(map(str, ratios))}', ',') AS ARRAY<DOUBLE>)"
    total = f"aggregate(%s, 0D, (s, g) -> s + element_at({weights}, CAST(pmod(g, {len(ratios)}) AS INT) + 1))"
    steps = docs.select(*[F.col(f"`{c}`").alias(k) for c, k in zip(keep, held)], F.coalesce(text, F.lit("")).alias("x"))
    steps = steps.selectExpr(*held, "x", f"{WORDS} AS words")
    steps = steps.selectExpr(
        *held,
        "x",
        "transform(words, w -> xxhash64(w)) AS h",
        "char_length(array_join(words, '')) AS word_chars",
        f"filter(split(x, '\\n'), l -> l RLIKE '{NOT_SPACE}') AS lines",
    )
    held += list(NEW)
    steps = steps.selectExpr(*held[: len(keep)], *[f"{sql} AS {name}" for name, sql in NEW.items()], "h", f"{_beside('h', 'xxhash64(p, q)')} AS pairs")
    # a window of three words is a pair and the word two behind its begin
    windows = "zip_with(slice(pairs, 1, greatest(size(h) - 2, 0)), slice(h, 3, greatest(size(h) - 2, 0)), (p, q) -> xxhash64(p, q))"
    mean = f"CASE WHEN size(h) = 0 THEN 0D ELSE ({total % 'h'} + {total % 'pairs'}) / (size(h) + size(pairs)) END"
    steps = steps.selectExpr(*held, f"{mean} AS log_ratio", f"{windows} AS w")
    held.append("log_ratio")
    # most texts have no window twice and are done here
    steps = steps.selectExpr(*held, "CASE WHEN size(array_distinct(w)) < size(w) THEN sort_array(transform(w, (v, i) -> struct(v, i))) END AS placed")
    twice = f"flatten(filter({_beside('placed', 'CASE WHEN p.v = q.v THEN array(p.i, q.i) END')}, e -> e IS NOT NULL))"
    steps = steps.selectExpr(*held, f"sort_array(array_distinct({twice})) AS at")
    covered = f"aggregate({_beside('at', 'least(3, q - p)')}, 3L, (s, n) -> s + n)"
    steps = steps.selectExpr(*held, f"CASE WHEN at IS NULL THEN 0L ELSE {covered} END AS n_repeat_words")
    held.append("n_repeat_words")
    failed = f"n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words"
    steps = steps.selectExpr(*held, f"{failed} AS base_failed")
    out = steps.withColumn("kept", ~F.col("base_failed") & (F.col("log_ratio") >= THRESHOLD))
    return out.select(*[F.col(f"k{i}").alias(c) for i, c in enumerate(keep)], *own)


def quality_rules(docs: DataFrame, trusted_ids: DataFrame, doc_id: str = "doc_id", text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Counts, ratio and verdict of every document; ``trusted_ids`` (one column) names the trusted documents."""
    flag = free_name(docs, "trusted")
    ids = trusted_ids.toDF(doc_id).filter(F.col(doc_id).isNotNull()).distinct().withColumn(flag, F.lit(True))
    marked = narrow_join(docs.select(doc_id, text), ids, doc_id, "left", ids.count())
    ratios = log_ratios(bucket_counts(marked.withColumn(flag, F.coalesce(flag, F.lit(False))), flag, text))
    return measures(docs, ratios, text, keep)
