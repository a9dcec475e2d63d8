"""Near-duplicate classes by BagMinHash over word shingles.

A document is the multiset of its shingles (``SHINGLE`` consecutive words in lower case, letters and digits alone). Exact
copies are one text from the start. A signature slot is the first point of a Poisson process that every shingle runs for
every slot, over levels up to the shingle's count: levels lie in blocks of doubling width (1, 2, 3-4, 5-8, ...), each block
with one process for all slots, and a point counts if its level, drawn by halving the block, is within the count. Two
documents then share a slot with the probability of their weighted Jaccard similarity.

Slots are banded. Inside a bucket every text is first compared with one centre, so a large group of near copies costs one
comparison per text; links join texts into classes. A second round takes the best-linked text of a bucket as its centre, for
the least edited copy is near most others. What a bucket holds beside its largest class is then compared with the whole
bucket, if those are few pairs. The texts of wider buckets meet by their rarest shingles instead: in any fixed order of
shingles, two texts at the threshold share one before the rest of either falls short of what they must share, so this loses
nothing, and a heavily edited copy, or one that shares but a passage with others, meets nobody. Texts meet only if their total weights and a few
bits of their signatures allow the threshold. A comparison is exact, on the shingle multisets, for all pairs whose signatures
don't rule it out.

Null texts and texts without words link to nothing but equal non-empty texts. Repeated rows are copies. Ids may repeat or
be null; classes are named by their smallest id, rows without an id by null unless the class has one. An empty table gives
an empty result. New columns replace kept ones of the same name.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickfold.llm.common import (
    chunks,
    extended,
    free_name,
    narrow_join,
    salted,
    salted_join,
    schema_of,
    spread,
    stage,
    staged_rows,
)
from tickfold.llm.decontam import words

SHINGLE = 5
SIMILARITY = 0.8
#: 30 bands of 6 slots: a pair at the threshold is missed with a probability of 1.1e-4.
BANDS, ROWS = 30, 6
SLOTS = BANDS * ROWS
#: Slots of which a byte is kept to rule pairs out.
MARKS = 128
#: Up to this many pairs of a bucket are made; the texts of wider ones meet by rare shingles.
FULL = 64
#: Words of signature bits that go with a text into its buckets, 60 bits each.
BITS = SLOTS // 60
#: Pairs whose equal marks are this many standard deviations below the threshold's are not compared: one pair at the threshold
#: in 10^6.
RULED_OUT = 4.75
#: Shingles are counted in so many cells to tell rare ones: one table of 4 MB, whatever the corpus.
CELLS = 1 << 20

_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))

MASK = (1 << 64) - 1
#: Points that a turn of the signatures draws at once, if it has fewer shingles.
POINTS = 1 << 13


def mix(x: np.ndarray) -> np.ndarray:
    """64 well-mixed bits of 64 bits."""
    x = (x ^ (x >> np.uint64(30))) * _B
    x = (x ^ (x >> np.uint64(27))) * _C
    return x ^ (x >> np.uint64(31))


def uniform(x: np.ndarray) -> np.ndarray:
    """(0, 1] from 64 bits."""
    return ((x >> np.uint64(11)).astype(np.float64) + 1.0) / float(1 << 53)


def shingles(texts: list[list[bytes]], cache: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, shingle hash, count) of all shingles; a text of fewer words than a shingle is one shingle."""
    sizes = np.array([len(w) for w in texts], np.int64)
    flat = np.array([cache[w] for own in texts for w in own], np.uint64)
    n = len(flat)
    doc = np.repeat(np.arange(len(texts)), sizes)
    width = np.repeat(np.minimum(sizes, SHINGLE), sizes)
    ends = np.repeat(np.cumsum(sizes), sizes)
    start = np.arange(n)
    begins = start + width <= ends
    value = np.zeros(n, np.uint64)
    for j in range(SHINGLE):
        at = np.minimum(start + j, max(n - 1, 0))
        value = np.where(j < width, mix(value * _A + flat[at] + np.uint64(j + 1)), value)
    doc, value = doc[begins], value[begins]
    order = np.argsort(value)
    # a stable sort of small numbers is a pass or two
    order = order[np.argsort(doc[order].astype(np.uint16 if len(texts) <= 1 << 16 else np.int64), kind="stable")]
    doc, value = doc[order], value[order]
    if not len(doc):
        return doc, value, doc
    first = np.flatnonzero(np.append(True, (doc[1:] != doc[:-1]) | (value[1:] != value[:-1])))
    return doc[first], value[first], np.diff(np.append(first, len(doc)))


class WordHashes(dict):
    """64-bit hash by word; emptied when it has grown large."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 300_000:
            self.clear()
        self[word] = out = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
        return out


def signatures(doc: np.ndarray, value: np.ndarray, count: np.ndarray, n: int) -> np.ndarray:
    """(documents, SLOTS) of 64-bit signature values; a slot holds a hash of the winning point.

    Points are drawn up to a time per document at which all slots are almost surely met; documents that still lack one
    are drawn again up to twice that time, so the first points are always the true ones.
    """
    out = np.zeros((n, SLOTS), np.uint64)
    weight = np.bincount(doc, count, minlength=n)
    limit = np.where(weight > 0, 8.0 / np.maximum(weight, 1), 0.0)  # points per slot on average: 8
    due = weight > 0
    while due.any():
        on = due[doc]
        d, v, c = doc[on], value[on], count[on]
        first = np.full(n * SLOTS, np.inf)
        winner = np.zeros(n * SLOTS, np.uint64)
        low, high = 0, 1  # levels of the block: low < level <= high
        while len(d):
            seed = mix(v + np.uint64(int(_A) * high & MASK))
            rate = float(SLOTS * (high - low))
            time = np.zeros(len(d))
            dd, cc, step = d, c, 0
            while len(dd):
                # short texts need many points of few shingles: a turn draws the next ones side by side, each in its order
                wide = min(max(POINTS // len(dd), 1), 64)
                steps = np.array([int(_C) * (step + i) & MASK for i in range(1, wide + 1)], np.uint64)
                step += wide
                bits = mix(seed[:, None] + steps)
                gaps = np.log(uniform(bits))
                gaps /= -rate
                gaps[:, 0] += time
                times = np.cumsum(gaps, 1)
                inside = times <= limit[dd][:, None]
                # a point of few: those beyond the limit are dropped, and a row with one draws no more
                at, of = times[inside], np.nonzero(inside)[0]
                mark = mix(bits[inside])
                key = dd[of] * SLOTS + (mark % np.uint64(SLOTS)).astype(np.int64)
                if high > 1:
                    # the level within the block: each bit of the rest halves it
                    level = low + 1 + (mix(mark) % np.uint64(high - low)).astype(np.int64)
                    good = level <= cc[of]
                    key, at, mark = key[good], at[good], mark[good]
                np.minimum.at(first, key, at)
                ahead = at == first[key]
                winner[key[ahead]] = mark[ahead]
                on = inside[:, -1]
                dd, cc, seed, time = dd[on], cc[on], seed[on], times[on, -1]
            more = c > high
            d, v, c = d[more], v[more], c[more]
            low, high = high, high * 2
        full = np.isfinite(first.reshape(n, SLOTS)).all(1) & due
        out[full] = winner.reshape(n, SLOTS)[full]
        due &= ~full
        limit = limit * 2
    return out


def bands(signature: np.ndarray) -> np.ndarray:
    """(documents, BANDS) of bucket keys."""
    grid = signature.reshape(len(signature), BANDS, ROWS)
    key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64) * _A, grid.shape[:2]).copy()
    for j in range(ROWS):
        key = mix(key * _B + grid[:, :, j])
    return key


def _prepared(docs: DataFrame, text: str) -> DataFrame:
    """All columns with ``digest`` (16 bytes, equal for equal words), ``bands``, ``marks`` (the high byte of the first slots, as
    the low bits of a value say little more than its slot), ``weight`` (shingles) and ``bits`` (one of each slot).

    They are null where nothing may link.
    """
    keep = docs.columns

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = WordHashes()
        for batch, texts in chunks(batches, text, 1 << 20):
            found = [words(t) for t in texts]
            digests = [
                hashlib.blake2b(b" ".join(w), digest_size=16).digest()
                if w
                else hashlib.blake2b(t.encode(), digest_size=16, person=b"no words").digest() if t else None
                for t, w in zip(texts, found)
            ]
            has = [i for i, w in enumerate(found) if w]
            doc, value, count = shingles([found[i] for i in has], cache)
            signature = signatures(doc, value, count, len(has))
            keys, high = bands(signature).view(np.int64), (signature[:, :MARKS] >> np.uint64(56)).astype(np.uint8)
            weights = np.bincount(doc, count, minlength=len(has)).astype(np.int64).tolist()
            ones = (signature >> np.uint64(40) & np.uint64(1)).reshape(len(has), BITS, 60) << np.arange(60, dtype=np.uint64)
            bits = ones.sum(2, dtype=np.uint64).view(np.int64).tolist()
            rows: list[list[int] | None] = [None] * len(found)
            marks: list[bytes | None] = [None] * len(found)
            weight: list[int | None] = [None] * len(found)
            some: list[list[int] | None] = [None] * len(found)
            for i, key, mark, w, b in zip(has, keys.tolist(), high, weights, bits):
                rows[i], marks[i], weight[i], some[i] = key, mark.tobytes(), w, b
            new = {
                "digest": pa.array(digests, pa.binary()),
                "bands": pa.array(rows, pa.list_(pa.int64())),
                "marks": pa.array(marks, pa.binary()),
                "weight": pa.array(weight, pa.int64()),
                "bits": pa.array(some, pa.list_(pa.int64())),
            }
            yield extended(batch, keep, new)
        pa.default_memory_pool().release_unused()

    return docs.mapInArrow(step, schema_of(docs, keep, "digest binary, bands array<long>, marks binary, weight long, bits array<long>"))


def least_equal(threshold: float) -> int:
    """Equal marks that a pair at the threshold almost surely has."""
    return max(1, int(MARKS * threshold - RULED_OUT * (MARKS * threshold * (1 - threshold)) ** 0.5))


def near_weights(threshold: float, a: str = "wa", b: str = "wb") -> Column:
    """Whether two total weights allow the threshold: the shared weight is at most the lesser, the whole at least the greater."""
    return F.least(a, b) + 1e-6 >= threshold * F.greatest(a, b)


def near_bits(threshold: float, a: str = "ba", b: str = "bb") -> Column:
    """Whether the bits of two texts allow the threshold: slots that differ agree in a bit half of the time."""
    agree = (1 + threshold) / 2
    most = int(SLOTS * (1 - agree) + RULED_OUT * (SLOTS * agree * (1 - agree)) ** 0.5) + 1
    differing = F.bit_count(F.lit(0))
    for i in range(BITS):
        differing = differing + F.bit_count(F.col(a)[i].bitwiseXOR(F.col(b)[i]))
    return differing <= most


def weight_class(threshold: float) -> Column:
    """Two weights that allow the threshold are of the same or of neighbouring classes."""
    return F.floor(F.log("weight") / (1e-4 - math.log(threshold))).cast("int")


def plausible(pairs: DataFrame, keys: DataFrame, threshold: float) -> DataFrame:
    """The (a, b) of ``pairs`` whose weights and marks allow the threshold; ``keys`` has (node, marks, weight)."""
    least = least_equal(threshold)
    dealt, hot = salted(pairs, "a")
    marks = keys.select("node", "marks", "weight")
    left = spread(marks.toDF("a", "left", "wa"), hot, "a")
    both = dealt.join(marks.toDF("b", "right", "wb"), "b").join(left, ["a", "salt"]).filter(near_weights(threshold))

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            one, two = (np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint8).reshape(-1, MARKS) for i in (2, 3))
            good = pa.array((one == two).sum(1) >= least)
            yield batch.select(["a", "b"]).filter(good)

    return stage(both.select("a", "b", "left", "right").mapInArrow(step, "a long, b long"), "minhash-plausible")


def verified(pairs: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """The (a, b) of ``pairs`` whose weighted Jaccard similarity reaches ``threshold``; ``texts`` has (node, text).

    A text that many pairs name is dealt over several tasks.
    """
    dealt, hot = salted(pairs, "a", 200)
    both = dealt.join(texts.toDF("b", "right"), "b").join(spread(texts.toDF("a", "left"), hot, "a"), ["a", "salt"])

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = WordHashes()
        for whole in batches:
            for at in range(0, len(whole), 64):
                batch = whole.slice(at, 64)
                name = batch.schema.get_field_index
                # a centre's text stands in many rows of a batch
                sides = [batch.column(name(x)).dictionary_encode() for x in ("left", "right")]
                one, two = (
                    [_multiset(words(t), cache) for t in side.dictionary.to_pylist()] for side in sides
                )
                good = [
                    jaccard(one[i], two[j]) >= threshold
                    for i, j in zip(sides[0].indices.to_pylist(), sides[1].indices.to_pylist())
                ]
                yield pa.RecordBatch.from_arrays([batch.column(name("a")), batch.column(name("b"))], names=["a", "b"]).filter(pa.array(good, pa.bool_()))

    return both.select("a", "b", "left", "right").mapInArrow(step, "a long, b long")


def _multiset(found: list[bytes], cache: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray]:
    _, value, count = shingles([found], cache)
    return value, count


def jaccard(one: tuple[np.ndarray, np.ndarray], two: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity of two multisets (values sorted)."""
    _, i, j = np.intersect1d(one[0], two[0], assume_unique=True, return_indices=True)
    shared = int(np.minimum(one[1][i], two[1][j]).sum())
    whole = int(one[1].sum() + two[1].sum()) - shared
    return shared / whole if whole else 0.0


def components(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """(node, label) with the smallest node of each connected component, for all ``nodes``.

    Labels pass along links and are then followed to their own label, so paths shorten quickly. Every round is a written
    table; rounds end when no label changes.
    """
    both = stage(links.select("a", "b").union(links.select("b", "a")).distinct(), "minhash-links")
    ends = both.select(F.col("a").alias("node")).distinct()
    labels = stage(ends.withColumn("label", F.col("node")), "minhash-labels")
    while True:
        near = both.join(labels.toDF("b", "near"), "b").groupBy("a").agg(F.min("near").alias("near"))
        lower = labels.join(near.withColumnRenamed("a", "node"), "node", "left").select(
            "node", "label", F.least("label", "near").alias("lower")
        )
        lower = stage(lower, "minhash-lower")
        jump = lower.select(F.col("node").alias("lower"), F.col("lower").alias("next"))
        # labels are many-to-one: a large class asks for one row many times
        asked = salted_join(lower, jump, "lower")
        labels = stage(asked.select("node", "label", F.least("lower", "next").alias("lower")), "minhash-labels")
        if not labels.filter("lower <> label").limit(1).count():
            break
        labels = labels.select("node", F.col("lower").alias("label"))
    found = labels.select("node", "label")
    return nodes.join(found, "node", "left").select("node", F.coalesce("label", "node").alias("label"))


def _centre_pairs(buckets: DataFrame, threshold: float) -> DataFrame:
    """(a, b): every text b of a bucket with the bucket's centre a, its smallest, which its buckets mostly share."""
    centres = buckets.groupBy("bucket").agg(F.min(F.struct("node", "weight", "bits")).alias("c"))
    centres = centres.select("bucket", F.col("c.node").alias("a"), F.col("c.weight").alias("wa"), F.col("c.bits").alias("ba"))
    pairs = salted_join(buckets.withColumnsRenamed({"node": "b", "weight": "wb", "bits": "bb"}), centres, "bucket")
    pairs = pairs.filter((F.col("a") != F.col("b")) & near_weights(threshold) & near_bits(threshold))
    return stage(pairs.select("a", "b").distinct(), "minhash-centre-pairs")


def _linked_centre_pairs(level: DataFrame, links: DataFrame, threshold: float) -> DataFrame:
    """(a, b): every text b of a bucket with its best-linked text a, where their classes differ."""
    degree = links.select("a", "b").union(links.select("b", "a")).groupBy("a").agg(F.count("*").alias("degree"))
    ranked = stage(level.join(degree.withColumnRenamed("a", "node"), "node"), "minhash-ranked")
    best = F.max(F.struct("degree", F.negative("node").alias("first"), "node", "label", "weight", "bits")).alias("c")
    centres = ranked.groupBy("bucket").agg(best).select(
        "bucket", F.col("c.node").alias("a"), F.col("c.label").alias("la"), F.col("c.weight").alias("wa"), F.col("c.bits").alias("ba")
    )
    pairs = salted_join(level.withColumnsRenamed({"node": "b", "label": "lb", "weight": "wb", "bits": "bb"}), centres, "bucket")
    pairs = pairs.filter((F.col("la") != F.col("lb")) & near_weights(threshold) & near_bits(threshold))
    return stage(pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "minhash-linked-centres")


def _beside(level: DataFrame, most: int | None, threshold: float) -> tuple[DataFrame, DataFrame | None]:
    """((a, b) of different classes that share a bucket, the rows of buckets too wide for that).

    Each text beside a bucket's largest class meets the texts of the whole bucket whose weight and bits are near its own: at
    most ``most`` pairs of a bucket. For None buckets are shingles, and rows have the weight ``before`` them in their text's
    order: what two texts at the threshold share, t / (1 + t) of both weights, must lie behind their first common shingle.
    """
    sizes = level.groupBy("bucket", "label").agg(F.count("*").alias("n"))
    largest = F.max(F.struct("n", "label")).alias("largest")
    several = sizes.groupBy("bucket").agg(F.sum("n").alias("n"), largest, F.count("*").alias("classes")).filter("classes > 1")
    several = stage(several.selectExpr("bucket", "(n - largest.n) * n AS pairs", "largest.label AS main"), "minhash-several")
    held = stage(salted_join(level, several, "bucket"), "minhash-held")
    small = held if most is None else held.filter(F.col("pairs") <= most)
    placed = [] if most is not None else ["before"]
    right = small.select("bucket", "size", F.col("node").alias("b"), F.col("label").alias("lb"), F.col("weight").alias("wb"), F.col("bits").alias("bb"), *placed)
    dealt, hot = salted(right, "bucket")
    beside = small.filter("label <> main").select(
        "bucket", F.explode(F.array(F.col("size") - 1, "size", F.col("size") + 1)).alias("size"),
        F.col("node").alias("a"), F.col("label").alias("la"), F.col("weight").alias("wa"), F.col("bits").alias("ba"),
        *[F.col(c).alias(f"{c}_a") for c in placed],
    )
    may = (F.col("la") != F.col("lb")) & near_weights(threshold) & near_bits(threshold)
    if placed:
        shared = threshold / (1 + threshold) * (F.col("wa") + F.col("wb")) - 1e-6
        may = may & (F.col("before_a") + shared <= F.col("wa")) & (F.col("before") + shared <= F.col("wb"))
    keys = ["bucket", "salt", "size"]
    left = spread(beside, hot, "bucket").withColumnsRenamed({k: f"{k}_a" for k in keys})
    alike = (F.col("bucket") == F.col("bucket_a")) & (F.col("salt") == F.col("salt_a")) & (F.col("size") == F.col("size_a"))
    met = dealt.join(left, alike & may)
    pairs = met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    return pairs, None if most is None else held.filter(F.col("pairs") > most)


def rare_shingles(texts: DataFrame, threshold: float) -> DataFrame:
    """(node, bucket, before): for every text the shingles of which it must share one with any text at the threshold.

    In a fixed order of all shingles, the weight behind a text's prefix falls short of ``threshold`` times its own; what it
    shares with such a text is more than that, so it reaches into the prefix, on both sides. The order is by how often
    shingles of the same cell occur among ``texts``, rare first, then by hash. Shingles alone in their cell meet nothing.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, held = WordHashes(), np.zeros(CELLS, np.int64)
        for _, found in chunks(batches, "text", 1 << 20):
            _, value, _ = shingles([words(t) for t in found], cache)
            held += np.bincount((value % np.uint64(CELLS)).astype(np.int64), minlength=CELLS)
        at = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(held[at])], names=["cell", "n"])

    # CELLS rows at most
    found = texts.select("text").mapInArrow(count, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    table = np.zeros(CELLS, np.uint32)
    table[found.column("cell").to_numpy()] = np.minimum(found.column("n").to_numpy(), (1 << 32) - 1)
    shared = texts.sparkSession.sparkContext.broadcast(table)

    def prefix(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, often = WordHashes(), shared.value
        for batch, found in chunks(batches, "text", 1 << 20):
            node = batch.column(batch.schema.get_field_index("node")).to_numpy()
            doc, value, many = shingles([words(t) for t in found], cache)
            times = often[(value % np.uint64(CELLS)).astype(np.int64)]
            order = np.lexsort((value, times, doc))
            doc, value, many, times = doc[order], value[order], many[order], times[order]
            whole = np.bincount(doc, many, minlength=len(found))
            before = np.cumsum(many) - many
            first = np.searchsorted(doc, np.arange(len(found)))
            before = before - before[np.minimum(first, max(len(doc) - 1, 0))][doc] if len(doc) else before
            # the weight from a shingle on is enough: it is in the prefix
            inside = (whole[doc] - before + 1e-6 >= threshold * whole[doc]) & (times > 1)
            arrays = [node[doc[inside]], value[inside].view(np.int64), before[inside].astype(np.int64)]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in arrays], names=["node", "bucket", "before"])

    return texts.select("node", "text").mapInArrow(prefix, "node long, bucket long, before long")


def _open_pairs(level: DataFrame, every_text: DataFrame, threshold: float) -> DataFrame:
    """(a, b): the pairs of different classes that share a bucket, or a rare shingle where buckets are wide."""
    pairs, wide = _beside(level, FULL, threshold)
    of_wide = stage(wide.drop("bucket", "pairs", "main").groupBy("node").agg(*[F.first(c).alias(c) for c in ("label", "weight", "size", "bits")]), "minhash-wide")
    n = of_wide.count()
    if n:
        texts = narrow_join(every_text, of_wide.select("node"), "node", "left_semi", n)
        rare = stage(rare_shingles(texts, threshold), "minhash-rare")
        again = stage(narrow_join(rare, of_wide, "node", "inner", n), "minhash-rare-open")
        pairs = pairs.union(_beside(again, None, threshold)[0])
    return stage(pairs.distinct(), "minhash-open-pairs")


def classes(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", threshold: float = SIMILARITY) -> tuple[DataFrame, str, str, str]:
    """All rows and columns of ``docs`` with a row number, its class and whether it is the one row of the class to keep.

    Returns (rows, name of the row number, name of the class, name of the flag). A class is named by its smallest id.
    """
    row = free_name(docs, "row_number")
    names = docs.columns
    plain = docs.toDF(*[f"c{i}" for i in range(len(names))])
    at, key = f"c{names.index(text)}", f"c{names.index(doc_id)}"
    rows = staged_rows(_prepared(plain, at), "row", "minhash-rows")
    # one node per text: its smallest row; texts that may link to nothing are nodes of their own
    owner = rows.filter("digest IS NOT NULL").groupBy("digest").agg(F.min("row").alias("node"))
    owner = stage(owner, "minhash-texts")
    heads = salted_join(rows.filter("digest IS NOT NULL").select("row", "digest"), owner, "digest").select("row", "node")
    heads = stage(heads.union(rows.filter("digest IS NULL").select("row", F.col("row").alias("node"))), "minhash-nodes")
    first = owner.select("node")
    keys = stage(
        rows.filter("bands IS NOT NULL").select(F.col("row").alias("node"), "bands", "marks", "weight", "bits").join(first, "node"), "minhash-bands"
    )
    every = keys.select("node", F.explode("bands").alias("bucket"))
    shared = every.groupBy("bucket").agg(F.count("*").alias("n")).filter("n > 1").select("bucket")
    met = stage(salted_join(every, shared, "bucket"), "minhash-met")
    buckets = stage(met.join(keys.select("node", "weight", "bits"), "node"), "minhash-buckets")
    asked = stage(buckets.select("node").distinct(), "minhash-asked")
    every_text = rows.select(F.col("row").alias("node"), F.col(at).alias("text"))

    def linked(pairs: DataFrame) -> DataFrame:
        pairs = plausible(pairs, keys, threshold)
        ends = stage(pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct(), "minhash-ends")
        texts = narrow_join(every_text, ends, "node", "left_semi", ends.count())
        return stage(verified(pairs, texts, threshold), "minhash-verified")

    links = linked(_centre_pairs(buckets, threshold))
    labels = stage(components(asked, links), "minhash-classes")
    size = weight_class(threshold).alias("size")
    for round_ in (_linked_centre_pairs, _open_pairs):
        level = stage(buckets.join(labels, "node").select("bucket", "node", "label", "weight", "bits", size), "minhash-open")
        pairs = round_(level, links if round_ is _linked_centre_pairs else every_text, threshold)
        if pairs.limit(1).count():
            links = stage(links.union(linked(pairs)), "minhash-all-links")
            labels = stage(components(asked, links), "minhash-classes")
    # salted_join needs one row per key on its right: every node has one label
    whole = stage(
        heads.join(labels, "node", "left").select("row", F.coalesce("label", "node").alias("label")), "minhash-labelled"
    )
    with_id = rows.select("row", key).join(whole, "row")
    named = with_id.groupBy("label").agg(
        F.min(key).alias("class"), F.min(F.struct(F.col(key).isNull(), key, "row")).alias("best")
    )
    named = named.select("label", "class", F.col("best.row").alias("kept"))
    tagged = salted_join(whole, named, "label").select("row", "class", (F.col("row") == F.col("kept")).alias("is_kept"))
    tagged = stage(tagged, "minhash-tagged")
    out = narrow_join(rows.drop("digest", "bands", "marks", "weight", "bits"), tagged, "row", "inner", rows.count())
    flag, cls = free_name(docs, "is_kept"), free_name(docs, "class_id")
    columns = [F.col(f"c{i}").alias(name) for i, name in enumerate(names)]
    return out.select(*columns, F.col("row").alias(row), F.col("class").alias(cls), F.col("is_kept").alias(flag)), row, cls, flag


def deduplicate(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", threshold: float = SIMILARITY) -> DataFrame:
    """One document of each class (the smallest id), with the columns of ``docs``."""
    rows, row, cls, flag = classes(docs, text, doc_id, threshold)
    return rows.filter(F.col(flag)).drop(row, cls, flag)
