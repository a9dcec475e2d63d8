"""Quality by co-training two classifiers.

One view reads the words of a text, the other its page metadata: language, source, length and lines, none of it told by a
word. Both are naive Bayes classifiers over hashed features, fitted by grouped counts. They start from labelled documents;
then, for some rounds, each labels all unlabelled documents, and what it is confident of is added to the training set of the
other. However many such pseudo-labels there are, those of a class weigh at most ``PSEUDO_SHARE`` of its true labels, so they
can't swamp or unbalance these. Each view's mean log odds are calibrated on labelled documents kept back from the counts,
where a last logistic curve also learns how to combine the views, neither of them against its own evidence. A round whose
curve fits these documents worse than the best so far is not used. All documents are then scored in one pass.

Fitting uses at most about ``MAX_LABELLED`` labelled documents, chosen by a hash of their id, and every document without a
label; scoring covers every document whole. Null texts are empty and null metadata is a value of its own. Repeated rows count each
time. Without labels of both kinds every score is the share of the better label (0.5 without any). New columns replace kept
ones of the same name.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from typing import NamedTuple
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickfold.llm.common import chunks, extended, fold_of, narrow_join, schema_of, stage

MAX_LABELLED = 20_000
ROUNDS = 3
#: A calibrated probability of at least this, or at most its complement, is a label for the other view.
CONFIDENT = 0.97
#: Weight of all pseudo-labels of a class in that of its true labels, at most.
PSEUDO_SHARE = 0.5
WORD_BUCKETS, META_BUCKETS = 1 << 16, 1 << 10
#: Added to every count; a feature's weight shrinks by it.
SMOOTHING = 0.5
WORD = re.compile(r"[^\x20\x09-\x0D]+")
#: Labelled documents whose id falls in this quarter are for calibration alone.
CALIBRATION_QUARTER = 3


def word_features(text: str, cache: dict[str, int]) -> list[int]:
    """Buckets of the different words."""
    out = []
    for w in set(WORD.findall(text)):
        if (b := cache.get(w)) is None:
            if len(cache) > 300_000:
                cache.clear()
            cache[w] = b = crc32(w.encode()) % WORD_BUCKETS
        out.append(b)
    return out


def meta_features(lang: str | None, source: str | None, text: str) -> list[int]:
    """Buckets of language, source, length and lines."""
    n, breaks = max(len(text), 1), text.count("\n")
    facts = (
        f"lang {lang}",
        f"source {source}",
        f"length {int(2 * math.log2(n))}",
        f"lines {int(2 * math.log2(breaks + 1))}",
        f"line length {int(2 * math.log2(n / (breaks + 1)))}",
        f"source {source} length {int(math.log2(n))}",
    )
    return [crc32(f.encode()) % META_BUCKETS for f in facts]


class View(NamedTuple):
    """Log odds by bucket, and the calibration of their mean."""

    weights: np.ndarray
    slope: float
    shift: float

    def mean(self, buckets: list[int]) -> float:
        return float(self.weights[buckets].mean()) if len(buckets) else 0.0

    def logit(self, buckets: list[int]) -> float:
        return self.slope * self.mean(buckets) + self.shift


class Model(NamedTuple):
    text: View
    meta: View
    combined: tuple[float, float, float]  # of text logit, of meta logit, constant

    def score(self, words: list[int], meta: list[int]) -> tuple[float, float, float]:
        """(combined, text, meta) probabilities."""
        t, m = self.text.logit(words), self.meta.logit(meta)
        a, b, c = self.combined
        return sigmoid(a * t + b * m + c), sigmoid(t), sigmoid(m)


def sigmoid(z: float) -> float:
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Coefficients and constant of a logistic curve by Newton steps with a weak ridge."""
    x = np.column_stack([x, np.ones(len(y))])
    beta = np.zeros(x.shape[1])
    ridge = np.full(x.shape[1], 1e-2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        step = np.linalg.solve((x.T * (p * (1 - p) + 1e-9)) @ x + np.diag(ridge), x.T @ (y - p) - ridge * beta)
        beta = beta + np.clip(step, -3, 3)
        if np.abs(step).max() < 1e-8:
            break
    return beta


def sample(docs: DataFrame, labels: DataFrame, label: str) -> DataFrame:
    """words, meta, label (null in the pool) and ``back`` (kept for calibration) of the documents to fit on, written."""
    own = labels.filter(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max(label).cast("int").alias("label"))
    own = own.filter("label IS NOT NULL")
    n_labelled = own.count()
    share = min(1.0, MAX_LABELLED / max(n_labelled, 1))
    place = F.pmod(F.xxhash64(F.lit("co-training"), "doc_id"), F.lit(1 << 30)) / (1 << 30)
    rows = narrow_join(docs, own, "doc_id", "left", n_labelled)
    rows = rows.filter(F.col("label").isNull() | (place < share))
    rows = rows.withColumn("back", F.col("label").isNotNull() & (fold_of("doc_id", 4) == CALIBRATION_QUARTER))

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache: dict[str, int] = {}
        for batch, texts in chunks(batches, "text"):
            lang, source = (batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("lang", "source"))
            words = [word_features(t, cache) for t in texts]
            meta = [meta_features(*x) for x in zip(lang, source, texts)]
            kind = pa.list_(pa.int32())
            yield extended(batch, ["label", "back"], {"words": pa.array(words, kind), "meta": pa.array(meta, kind)})

    columns = rows.select("label", "back", F.col("lang").cast("string"), F.col("source").cast("string"), "text")
    return stage(columns.mapInArrow(step, "label int, back boolean, words array<int>, meta array<int>"), "co-training-sample")


def counts(rows: DataFrame, model: Model | None) -> tuple[np.ndarray, np.ndarray]:
    """Weights by label and bucket for the words and for the metadata, folded per task.

    A labelled row counts 1 for both views. A row of the pool counts for a view if the other one is confident, and all such
    rows of a class are scaled to ``PSEUDO_SHARE`` of its labelled rows where they are more.
    """
    shared = rows.sparkSession.sparkContext.broadcast(model)
    sizes = (WORD_BUCKETS + 1, META_BUCKETS + 1)  # the last bucket counts rows

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        held = [[np.zeros((2, n), np.int64) for n in sizes] for _ in range(2)]  # labelled, pseudo-labelled
        for batch in batches:
            for label, back, words, meta in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if back:
                    continue
                into = held[label is None]
                by_text = by_meta = label
                if label is None:
                    by_text, by_meta = (
                        1 if p >= CONFIDENT else 0 if p <= 1 - CONFIDENT else None
                        for p in (sigmoid(model.text.logit(words)), sigmoid(model.meta.logit(meta)))
                    )
                if by_meta is not None:
                    into[0][by_meta, words] += 1
                    into[0][by_meta, -1] += 1
                if by_text is not None:
                    np.add.at(into[1][by_text], meta, 1)
                    into[1][by_text, -1] += 1
        for pseudo, tables in enumerate(held):
            for view, table in enumerate(tables):
                label, bucket = np.nonzero(table)
                kinds = [np.full(len(label), x, np.int32) for x in (pseudo, view)]
                arrays = [*kinds, label.astype(np.int32), bucket.astype(np.int32), table[label, bucket]]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in arrays], names=["pseudo", "view", "label", "bucket", "n"])

    rows = rows.filter("label IS NOT NULL") if model is None else rows
    found = rows.select("label", "back", "words", "meta").mapInArrow(step, "pseudo int, view int, label int, bucket int, n long")
    # at most 4 * (WORD_BUCKETS + META_BUCKETS + 2) rows
    summed = found.groupBy("pseudo", "view", "label", "bucket").agg(F.sum("n").alias("n")).toArrow()
    pseudo, view, label, bucket, n = (summed.column(c).to_numpy() for c in ("pseudo", "view", "label", "bucket", "n"))
    out = []
    for i, size in enumerate(sizes):
        true, more = (np.zeros((2, size)) for _ in range(2))
        for kind, table in enumerate((true, more)):
            on = (view == i) & (pseudo == kind)
            table[label[on], bucket[on]] = n[on]
        scale = np.minimum(1.0, PSEUDO_SHARE * true[:, -1] / np.maximum(more[:, -1], 1))
        out.append((true + more * scale[:, None])[:, :-1])
    return out[0], out[1]


def weights(table: np.ndarray) -> np.ndarray:
    """Log odds of every bucket; 0 where nothing was counted."""
    smooth = table + SMOOTHING
    out = np.log(smooth[1] / (table[1].sum() + 1)) - np.log(smooth[0] / (table[0].sum() + 1))
    return np.where(table.sum(0) > 0, out, 0.0)


def calibrated(rows: DataFrame, views: tuple[np.ndarray, np.ndarray]) -> tuple[Model, float]:
    """The two views with their curves, and the mean log loss of the combined curve.

    Fitted on the labelled rows kept back, a quarter of ``MAX_LABELLED`` at most. A view that the curve would turn against its
    own evidence is left out of it.
    """
    shared = rows.sparkSession.sparkContext.broadcast(views)

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        text, meta = (View(w, 1.0, 0.0) for w in shared.value)
        for batch in batches:
            means = [[v.mean(x) for x in batch.column(1 + i).to_pylist()] for i, v in enumerate((text, meta))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, means)], names=["label", "text", "meta"])

    found = rows.filter("back").select("label", "words", "meta").mapInArrow(step, "label int, text double, meta double").toArrow()
    y, t, m = (found.column(c).to_numpy().astype(float) for c in ("label", "text", "meta"))
    curves = [logistic(x, y) for x in (t, m)]
    views_of = [View(w, max(float(c[0]), 0.0), float(c[1])) for w, c in zip(views, curves)]
    logits = np.column_stack([v.slope * x + v.shift for v, x in zip(views_of, (t, m))])
    both = logistic(logits, y)
    if min(both[:2]) < 0:
        kept = int(np.argmax(both[:2]))
        alone = logistic(logits[:, kept], y)
        both = np.zeros(3)
        both[kept], both[2] = max(alone[0], 0.0), alone[1]
    p = 1 / (1 + np.exp(-np.clip(logits @ both[:2] + both[2], -30, 30)))
    return Model(*views_of, tuple(map(float, both))), float(-np.mean(y * np.log(p) + (1 - y) * np.log(1 - p)))


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", rounds: int = ROUNDS) -> Model:
    """The model of ``docs`` (doc_id, text, lang, source) with ``labels`` (doc_id and 0/1)."""
    rows = sample(docs, labels, label)
    kinds = {r["label"]: r["count"] for r in rows.filter("label IS NOT NULL").groupBy("label").count().collect()}
    if len(kinds) < 2 or not rows.filter("back").limit(1).count():
        flat = View(np.zeros(WORD_BUCKETS), 0.0, 0.0), View(np.zeros(META_BUCKETS), 0.0, 0.0)
        share = (kinds.get(1, 0) + 0.5) / (sum(kinds.values()) + 1)
        return Model(*flat, (0.0, 0.0, math.log(share / (1 - share))))
    best, least = None, math.inf
    model = None
    for _ in range(rounds):
        text, meta = counts(rows, model)
        model, loss = calibrated(rows, (weights(text), weights(meta)))
        if loss < least:
            best, least = model, loss
    return best


def scores(docs: DataFrame, model: Model, keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns with score (probability of label 1), predicted (from 0.5 on), text_score and meta_score."""
    new = ("score", "predicted", "text_score", "meta_score")
    keep = [c for c in (docs.columns if keep is None else keep) if c.lower() not in new]
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, cache = shared.value, {}
        for batch, texts in chunks(batches, "text"):
            lang, source = (batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("lang", "source"))
            words = [word_features(t, cache) for t in texts]
            meta = [meta_features(*x) for x in zip(lang, source, texts)]
            found = [model.score(*x) for x in zip(words, meta)]
            both, text, meta = ([f[i] for f in found] for i in range(3))
            columns = {"score": both, "predicted": [int(s >= 0.5) for s in both], "text_score": text, "meta_score": meta}
            yield extended(batch, keep, {k: pa.array(v, pa.int32() if k == "predicted" else pa.float64()) for k, v in columns.items()})

    columns = list(dict.fromkeys([*keep, "lang", "source", "text"]))
    return docs.select(*columns).mapInArrow(step, schema_of(docs, keep, "score double, predicted int, text_score double, meta_score double"))
