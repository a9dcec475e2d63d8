"""Language-model scores by a probabilistic suffix tree.

The model reads a text as its words in lower case, joined by blanks and closed by an end sign, byte by byte. Training counts
every byte with the bytes before it; a context of 1 to ``DEPTH`` bytes is kept if it makes up at least ``MIN_SHARE`` of the
training bytes and its next-byte distribution diverges from that of the next shorter kept context. Distributions are
smoothed towards the shorter context's. A byte is scored by the state of the longest kept suffix; the states form an
automaton that a task runs over blocks of text side by side.

``MIN_SHARE`` bounds the tree (1 / MIN_SHARE contexts per length), so it can be broadcast whatever the corpus; the counts
behind it are gathered from all training documents, folded per task and then by key. Word counts are exact: words of at
least ``HEAVY_SHARE`` of the tokens (1 / HEAVY_SHARE at most) are broadcast, all others meet the documents in a join.

Null texts are empty; an empty text is its end sign alone. Repeated rows count each time; rows with equal or null ids stay
apart. An empty table, or one without training rows, gives c = N = V = 0, for which the smoothed shares are still defined.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickfold.llm.common import chunks, extended, stage, staged_rows

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
#: The end sign; no word holds a line feed.
END = 10
#: Longest context in bytes; with the next byte it fits 64 bits.
DEPTH = 6
#: Grams are dealt out by this many bytes before the last.
NEAR = 3
#: Least share of a context in all training bytes.
MIN_SHARE = 5e-6
#: A context is kept if some next byte is this many times likelier or unlikelier than after the shorter one ...
RATIO = 1.1
#: ... and its divergence in bits, times its count, is at least this.
MIN_GAIN_BITS = 15.0
#: Least share of a word in all training tokens to be broadcast with its count.
HEAVY_SHARE = 1e-5
#: Added to every count of a word.
ADDED = 0.1
BLOCK = 512


def words(text: str) -> list[bytes]:
    return WORD.findall(text.encode().lower())  # bytes.lower() changes A-Z alone


def stream(texts: list[list[bytes]]) -> np.ndarray:
    """Bytes of the texts, each closed by the end sign."""
    return np.frombuffer(b"".join(b" ".join(w) + b"\n" for w in texts), np.uint8)


def grams(data: np.ndarray) -> np.ndarray:
    """Per byte the bytes up to it, the byte itself lowest; bytes before a text's first are 0, save the end sign there."""
    n = len(data)
    out = data.astype(np.uint64)
    ended = np.zeros(n, bool)
    for k in range(1, DEPTH + 1):
        before = np.full(n, END, np.uint64)
        before[k:] = data[:-k]
        before[ended] = 0
        out |= before << np.uint64(8 * k)
        ended |= before == END
    return out


def _fold(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys, counts = (np.concatenate(x) for x in zip(*parts))
    order = np.argsort(keys)
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    return keys[first], np.add.reduceat(counts, first)


def count_words(train: DataFrame, text: str = "text") -> DataFrame:
    """(word, c) over all training texts, in a written table; the end sign counts as the word of one line feed."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[bytes] = Counter()

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(held), pa.binary()), pa.array(list(held.values()), pa.int64())], names=["word", "n"])

        for _, texts in chunks(batches, text):
            for t in texts:
                held.update(words(t))
            held[b"\n"] += len(texts)
            if len(held) > 250_000:
                yield out()
                held.clear()
        yield out()

    counted = train.select(text).mapInArrow(step, "word binary, n long")
    return stage(counted.groupBy("word").agg(F.sum("n").cast("long").alias("c")), "suffix-tree-words")


def count_grams(train: DataFrame, text: str = "text") -> DataFrame:
    """(near, gram, n): byte grams of all training texts, folded per task. ``near`` are the three bytes before the last."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[tuple[np.ndarray, np.ndarray]] = []

        def out() -> pa.RecordBatch:
            keys, counts = parts[0]
            near = (keys >> np.uint64(8) & np.uint64(0xFFFFFF)).astype(np.int32)
            return pa.RecordBatch.from_arrays([pa.array(near), pa.array(keys.view(np.int64)), pa.array(counts)], names=["near", "gram", "n"])

        for _, texts in chunks(batches, text, 2 << 20):
            keys, counts = np.unique(grams(stream([words(t) for t in texts])), return_counts=True)
            parts.append((keys, counts.astype(np.int64)))
            if sum(len(p[0]) for p in parts) > 3_000_000:
                parts[:] = [_fold(parts)]
                if len(parts[0][0]) > 2_000_000:
                    yield out()
                    parts.clear()
        if parts:
            parts[:] = [_fold(parts)]
            yield out()

    return train.select(text).mapInArrow(step, "near int, gram long, n long")


class Tree(NamedTuple):
    """The automaton: states are all beginnings of kept contexts. Bytes never met in training share a column."""

    column: np.ndarray  # (256,): column of each byte
    following: np.ndarray  # (states, columns): next state
    log10: np.ndarray  # (states, columns): log10 probability of the byte


def contexts(counted: DataFrame) -> pa.Table:
    """(length, context, next byte, n) of contexts with at least ``MIN_SHARE`` of all bytes: 1 / MIN_SHARE per length.

    The folded grams move once, by the three bytes before the last, and all longer contexts are complete where they
    arrive; shorter ones are summed from what is left.
    """
    dealt = counted.repartition("near").groupBy("near", "gram").agg(F.sum("n").alias("n"))
    # a context of length k: the k bytes above the lowest; it may not reach before a text's first byte
    cut = ", ".join(f"named_struct('k', {k}, 'c', shiftrightunsigned(gram, 8) & {(1 << 8 * k) - 1}L)" for k in range(NEAR, DEPTH + 1))
    each = dealt.selectExpr("near", "gram & 255L AS s", "n", f"explode(array({cut})) AS x").select("near", "x.k", "x.c", "s", "n")
    each = each.filter(f"k = {NEAR} OR shiftrightunsigned(c, 8 * (k - 1)) > 0")
    nexts = each.groupBy("near", "k", "c", "s").agg(F.sum("n").alias("n"))
    # 256 next bytes per context at most
    listed = nexts.groupBy("near", "k", "c").agg(F.sum("n").alias("whole"), F.collect_list(F.struct("s", "n")).alias("nexts"))
    # the least count isn't known before the counts are: contexts met once are left out here, light ones below
    listed = stage(listed.filter(f"k = {NEAR} OR whole > 1").drop("near"), "suffix-tree-contexts")
    total = listed.filter(F.col("k") == NEAR).agg(F.sum("whole")).first()[0] or 0
    least = max(2, math.ceil(MIN_SHARE * total))
    full = listed.filter((F.col("whole") >= least) & (F.expr(f"shiftrightunsigned(c, 8 * (k - 1))") > 0))
    parts = full.select("k", "c", F.explode("nexts").alias("x")).select("k", "c", "x.s", "x.n")
    base = listed.filter(F.col("k") == NEAR).select("c", F.explode("nexts").alias("x")).select("c", "x.s", "x.n")
    for k in range(NEAR):
        short = base.withColumn("c", F.col("c").bitwiseAND(F.lit((1 << 8 * k) - 1)))
        short = short.filter(F.shiftrightunsigned("c", 8 * (k - 1)) > 0) if k else short
        short = short.groupBy("c", "s").agg(F.sum("n").alias("n"))
        parts = parts.unionByName(short.select(F.lit(k).alias("k"), "c", "s", "n"))
    return parts.toArrow()


def grow(found: pa.Table) -> Tree:
    """Keeps diverging contexts, smooths them, and builds the automaton."""
    k, c, s, n = (found.column(name).to_numpy().astype(np.int64) for name in ("k", "c", "s", "n"))
    order = np.lexsort((s, c, k))
    k, c, s, n = k[order], c[order], s[order], n[order]
    met = np.unique(s)
    column = np.full(256, len(met), np.int64)
    column[met] = np.arange(len(met))
    width = np.bincount(column, minlength=len(met) + 1)  # bytes in each column
    s = column[s]
    first = np.flatnonzero(np.append(True, (k[1:] != k[:-1]) | (c[1:] != c[:-1]))) if len(k) else np.zeros(0, np.int64)
    stops = np.append(first[1:], len(k))
    kept: dict[bytes, np.ndarray] = {}
    root = width / 256
    for a, b in zip(first.tolist(), stops.tolist()):
        counts, symbols, length = n[a:b], s[a:b], int(k[a])
        context = int(c[a]).to_bytes(8, "big")[8 - length :] if length else b""
        above = next((kept[context[j:]] for j in range(1, length) if context[j:] in kept), root)
        total = counts.sum()
        whole = total + len(symbols)  # the shorter context weighs as much as there are different next bytes
        smooth = above * (len(symbols) / whole)
        smooth[symbols] += counts / whole
        if not length:
            root = smooth
            continue
        ratio = smooth[symbols] / above[symbols]
        if counts @ np.log2(ratio) >= MIN_GAIN_BITS and (ratio.max() >= RATIO or ratio.min() <= 1 / RATIO):
            kept[context] = smooth.astype(np.float32)
    names = sorted({context[:i] for context in kept for i in range(len(context) + 1)} | {b""}, key=lambda x: (len(x), x))
    states = {name: i for i, name in enumerate(names)}
    children: list[list[tuple[int, int]]] = [[] for _ in names]
    for name, i in states.items():
        if name:
            children[states[name[:-1]]].append((int(column[name[-1]]), i))
    following = np.zeros((len(names), len(width)), np.int32)
    log10 = np.empty((len(names), len(width)), np.float32)
    size = np.maximum(width, 1)
    for i, name in enumerate(names):  # shorter ones first
        if name:
            back = next(states[name[j:]] for j in range(1, len(name) + 1) if name[j:] in states)
            following[i] = following[back]
            log10[i] = np.log10(kept[name] / size) if name in kept else log10[back]
        else:
            log10[i] = np.log10(np.maximum(root, 1e-300) / size)
        for symbol, child in children[i]:
            following[i, symbol] = child
    return Tree(column, following, log10)


def byte_scores(data: np.ndarray, tree: Tree) -> np.ndarray:
    """log10 probability of each byte of a stream, all blocks side by side.

    The state depends on the last ``DEPTH`` bytes alone, so each block starts that many bytes early.
    """
    n = len(data)
    rows = -(-n // BLOCK)
    padded = np.full(DEPTH + rows * BLOCK, END, np.uint8)
    padded[DEPTH : DEPTH + n] = data
    grid = tree.column[np.lib.stride_tricks.sliding_window_view(padded, DEPTH + BLOCK)[::BLOCK].T]
    following, log10, columns = tree.following.ravel(), tree.log10.ravel(), tree.log10.shape[1]
    out = np.empty((BLOCK, rows), np.float32)
    state = np.zeros(rows, np.int64)
    for j in range(DEPTH + BLOCK):
        at = state * columns + grid[j]
        if j >= DEPTH:
            out[j - DEPTH] = log10[at]
        state = following[at].astype(np.int64)
    return out.T.ravel()[:n]


def text_scores(found: list[list[bytes]], tree: Tree) -> np.ndarray:
    data = stream(found)
    ends = np.cumsum([sum(map(len, w)) + max(len(w), 1) for w in found])
    sums = np.cumsum(byte_scores(data, tree), dtype=np.float64)[ends - 1] if len(data) else np.zeros(0)
    return np.diff(sums, prepend=0.0)


def scores(docs: DataFrame, train: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score and score of every document, from the counts of ``train``."""
    spark = docs.sparkSession
    words_of = count_words(train, text)
    size = words_of.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    all_tokens, distinct = size["n"], size["v"]
    whole = all_tokens + ADDED * (distinct + 1)
    heavy_least = max(2, math.ceil(HEAVY_SHARE * all_tokens))
    heavy = {bytes(r["word"]): r["c"] for r in words_of.filter(F.col("c") >= heavy_least).collect()}
    shared = spark.sparkContext.broadcast((heavy, grow(contexts(count_grams(train, text)))))

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, tree = shared.value
        logs = {w: math.log10((c + ADDED) / whole) for w, c in known.items()}
        for batch, texts in chunks(batches, "text", 2 << 20):
            found = [words(t) for t in texts]
            tokens, sure, base, rare = [], [], [], []
            for own in found:
                held = Counter(own)
                held[b"\n"] += 1
                others = {w: n for w, n in held.items() if w not in logs}
                mine = [(logs[w], n) for w, n in held.items() if w in logs]
                tokens.append(len(own) + 1)
                sure.append(sum(n for _, n in mine))
                base.append(math.fsum(x * n for x, n in mine))
                rare.append([{"w": w, "n": n} for w, n in others.items()])
            new = {
                "n_tokens": pa.array(tokens, pa.int64()),
                "sure": pa.array(sure, pa.int64()),
                "base": pa.array(base, pa.float64()),
                "score": pa.array(text_scores(found, tree).tolist(), pa.float64()),
                "rare": pa.array(rare, pa.list_(pa.struct([("w", pa.binary()), ("n", pa.int64())]))),
            }
            yield extended(batch, ["doc_id"], new)

    kind = dict(docs.dtypes)[doc_id]
    schema = f"doc_id {kind}, n_tokens long, sure long, base double, score double, rare array<struct<w: binary, n: long>>"
    scored = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(step, schema)
    scored = staged_rows(scored, "row", "suffix-tree-scores")
    pairs = scored.select("row", F.explode("rare").alias("r")).select("row", F.col("r.w").alias("word"), "r.n")
    light = words_of.filter(F.col("c") < heavy_least)
    # every (row, word) occurs once, and a rare word in few rows: less than HEAVY_SHARE of the training tokens; words
    # unseen in training meet nothing, and are few or many alike
    met = pairs.join(light, "word", "left")
    log = F.log10((F.coalesce("c", F.lit(0)) + ADDED) / whole)
    sums = met.groupBy("row").agg(
        F.sum(F.when(F.col("c").isNotNull(), F.col("n")).otherwise(0)).alias("more_known"),
        F.sum(F.col("n") * log).alias("more"),
    )
    return scored.drop("rare").join(sums, "row", "left").select(
        "doc_id",
        "n_tokens",
        (F.col("sure") + F.coalesce("more_known", F.lit(0))).cast("long").alias("n_known"),
        F.lit(all_tokens).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("more", F.lit(0.0))).alias("base_score"),
        "score",
    )
