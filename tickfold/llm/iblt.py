"""Document fingerprints by invertible Bloom lookup tables over paragraph digests.

A text's paragraphs are its lines, and a longer line is cut further after words that a hash of their last bytes picks, so an
edit moves only the cuts beside it. Every paragraph digest (repeats numbered, so that a set is enough) goes into one cell of
each of three tables; a cell holds a count, a sum of digests and a sum of check values. The fingerprint is the smallest such
sketch. Two versions are compared by subtracting their cells: equal paragraphs cancel, and peeling recovers the digests that
differ. Where that gets stuck, both sketches are made anew at twice the size with other hash functions, until all pairs of a
chunk are peeled. Likeness is 1 - differing / (paragraphs of both), 1 for two texts without paragraphs.

The versions that a corpus compares are neighbours in the order of the ids, so rows are dealt by ranges and sorted once;
each row meets its successor in the pass over its partition, and only the first and last row of a partition are joined after.

Defined results: a null text is empty; an empty or blank text has an empty fingerprint. Null ids come last, equal ids are
ordered by a hash of their text, equal rows are neighbours of each other. Texts are whole, however long. A single row is its
own successor. An empty table gives an empty result. Other columns play no role.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickfold.llm.common import chunks
from tickfold.session import stage

#: Cells of each of the three tables of a fingerprint.
CELLS = 8
#: One word in this many (a power of two) ends a paragraph inside a line.
CUT_WORDS = 16
#: Text bytes that are compared at once.
STEP_BYTES = 1 << 20
SPACE = np.isin(np.arange(256), [0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D])
#: Between texts: cuts look back four bytes, so no cut depends on the text before.
GAP = b"\n\n\n\n"
ODD = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray, seed: int) -> np.ndarray:
    """A bijective mix of 64 bits."""
    with np.errstate(over="ignore"):
        x = (x ^ np.uint64(seed * 0x2545F491)) * ODD
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        return x ^ (x >> np.uint64(29))


def paragraphs(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(text number, digest) of every paragraph, texts in order; repeats within a text get digests of their own."""
    joined = GAP + GAP.join(texts) + GAP
    data = np.frombuffer(joined, np.uint8)
    space = SPACE[data]
    word = ~space
    starts = np.flatnonzero(word[1:] & space[:-1]) + 1
    if not len(starts):
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    ends = np.flatnonzero(word[:-1] & space[1:]) + 1
    window = sum(data[ends - k].astype(np.uint64) << np.uint64(8 * (k - 1)) for k in range(1, 5))
    cut = mixed(window, 1) >> np.uint64(64 - CUT_WORDS.bit_length() + 1) == 0
    line = np.searchsorted(np.flatnonzero(data == 0x0A), starts)
    first = np.append(True, cut[:-1] | (line[1:] != line[:-1]))
    begin = starts[first]
    end = ends[np.append(np.flatnonzero(first)[1:] - 1, len(ends) - 1)]
    view = memoryview(joined)
    hashes = np.fromiter((xxhash.xxh3_64_intdigest(view[a:b]) for a, b in zip(begin.tolist(), end.tolist())), np.uint64, len(begin))
    sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + len(GAP)
    owner = np.searchsorted(np.cumsum(sizes) + len(GAP), begin, side="right")
    order = np.lexsort((hashes, owner))
    ranked, held = hashes[order], owner[order]
    fresh = np.append(True, (ranked[1:] != ranked[:-1]) | (held[1:] != held[:-1]))
    at = np.arange(len(ranked))
    repeat = at - np.maximum.accumulate(np.where(fresh, at, 0))
    return held, mixed(ranked + mixed(repeat.astype(np.uint64), 2), 3)


class Tables:
    """Sketches of many sets side by side: set i has ``sizes[i]`` cells in each of its three tables."""

    def __init__(self, sizes: np.ndarray, seed: int):
        self.sizes, self.seed = sizes, seed
        self.offsets = np.append(0, np.cumsum(sizes))
        cells = 3 * int(self.offsets[-1])
        self.count, self.key, self.check = np.zeros(cells, np.int64), np.zeros(cells, np.uint64), np.zeros(cells, np.uint64)

    def places(self, owner: np.ndarray, keys: np.ndarray, table: int) -> np.ndarray:
        slot = (mixed(keys, 10 + 3 * self.seed + table) >> np.uint64(20)) % self.sizes[owner].astype(np.uint64)
        return table * int(self.offsets[-1]) + self.offsets[owner] + slot.astype(np.int64)

    def add(self, owner: np.ndarray, keys: np.ndarray, sign: np.ndarray | int) -> None:
        signs = np.broadcast_to(np.asarray(sign, np.int64), keys.shape)
        wide = signs.astype(np.uint64)
        with np.errstate(over="ignore"):
            summed, checks = keys * wide, mixed(keys, 5) * wide
        for table in range(3):
            at = self.places(owner, keys, table)
            np.add.at(self.count, at, signs)
            np.add.at(self.key, at, summed)
            np.add.at(self.check, at, checks)

    def minus(self, other: Tables) -> Tables:
        out = Tables(self.sizes, self.seed)
        with np.errstate(over="ignore"):
            out.count, out.key, out.check = self.count - other.count, self.key - other.key, self.check - other.check
        return out

    def peel(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(owner, digest, side +1 or -1) of what differs, and whether a set was peeled to the end. Empties the tables."""
        total = int(self.offsets[-1])
        owner_of = np.repeat(np.arange(len(self.sizes)), self.sizes)
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        idle, table = 0, 0
        while idle < 3:
            # cells of one table at a time: a digest has one cell in it, so nothing is found twice
            part = slice(table * total, (table + 1) * total)
            at = np.flatnonzero(np.abs(self.count[part]) == 1)
            sign = self.count[part][at]
            with np.errstate(over="ignore"):
                keys = self.key[part][at] * sign.astype(np.uint64)
                pure = mixed(keys, 5) * sign.astype(np.uint64) == self.check[part][at]
            owner, keys, sign = owner_of[at[pure]], keys[pure], sign[pure]
            # a sum of several digests that looks pure would sit elsewhere
            right = self.places(owner, keys, table) == at[pure] + table * total
            owner, keys, sign = owner[right], keys[right], sign[right]
            if len(keys):
                found.append((owner, keys, sign))
                self.add(owner, keys, -sign)
                idle = 0
            else:
                idle += 1
            table = (table + 1) % 3
        left = (self.count != 0) | (self.key != 0) | (self.check != 0)
        stuck = np.bincount(np.tile(owner_of, 3)[left], minlength=len(self.sizes)) > 0
        empty = np.empty(0, np.int64)
        parts = zip(*found) if found else (iter([empty]), iter([empty.astype(np.uint64)]), iter([empty]))
        owner, keys, sign = (np.concatenate(list(p)) for p in parts)
        return owner, keys, sign, ~stuck

    def cells(self) -> list[bytes]:
        """Each set's cells: counts, sums, checks."""
        total = int(self.offsets[-1])
        count, key = self.count.astype("<i4"), self.key.astype("<u8")
        check = (self.check >> np.uint64(48)).astype("<u2")
        out = []
        for a, b in zip(self.offsets[:-1].tolist(), self.offsets[1:].tolist()):
            parts = [x[t * total + a : t * total + b].tobytes() for x in (count, key, check) for t in range(3)]
            out.append(b"".join(parts))
        return out


def sketch(n: int, owner: np.ndarray, keys: np.ndarray) -> Tables:
    """The fingerprints of n sets."""
    made = Tables(np.full(n, CELLS), 0)
    made.add(owner, keys, 1)
    return made


def differing(n: int, left: tuple[np.ndarray, np.ndarray], right: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(pair, digest, side) of all digests that only one side of n pairs has; sides are (pair, digest) arrays."""
    gap = np.abs(np.bincount(left[0], minlength=n) - np.bincount(right[0], minlength=n))
    # as many differ at least as the counts do
    sizes = np.maximum(CELLS, np.int64(1) << np.ceil(np.log2(np.maximum(gap, 2) / 2)).astype(np.int64))
    todo, seed, out = np.arange(n), 0, []
    while len(todo):
        number = np.full(n, -1)
        number[todo] = np.arange(len(todo))
        sides = []
        for owner, keys in (left, right):
            mine = number[owner] >= 0
            tables = Tables(sizes[todo], seed)
            tables.add(number[owner[mine]], keys[mine], 1)
            sides.append(tables)
        owner, keys, sign, done = sides[0].minus(sides[1]).peel()
        good = done[owner]
        out.append((todo[owner[good]], keys[good], sign[good]))
        todo = todo[~done]
        sizes[todo] *= 2
        seed += 1
    if not out:
        return np.empty(0, np.int64), np.empty(0, np.uint64), np.empty(0, np.int64)
    return tuple(np.concatenate(x) for x in zip(*out))


def likeness(n: int, left: tuple[np.ndarray, np.ndarray], right: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Of each of n pairs of paragraph sets."""
    apart = np.bincount(differing(n, left, right)[0], minlength=n)
    both = np.bincount(left[0], minlength=n) + np.bincount(right[0], minlength=n)
    return 1 - apart / np.maximum(both, 1)


def edited(text: str, following: str) -> str:
    """The last half of the code points replaced by the first as many (or all) of another text."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


COLUMNS = ["id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
KINDS = [pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.float64(), pa.float64()]
RESULT = "n_chars long, edited_sha256 binary, fingerprint binary, edited_fingerprint binary, near_edited double, near_next double"


def compared(texts: list[str], following: list[str]) -> list[list]:
    """The result columns of some texts, each with the text after it."""
    n = len(texts)
    versions = [edited(a, b).encode() for a, b in zip(texts, following)]
    own, new, after = (paragraphs(x) for x in ([t.encode() for t in texts], versions, [t.encode() for t in following]))
    return [
        [len(t) for t in texts],
        [hashlib.sha256(v).digest() for v in versions],
        sketch(n, *own).cells(),
        sketch(n, *new).cells(),
        likeness(n, own, new).tolist(),
        likeness(n, own, after).tolist(),
    ]


def _batch(kind: int, part: int, ids: pa.Array, columns: list[list], text: str | None = None) -> pa.RecordBatch:
    n = len(ids)
    arrays = [pa.array([kind] * n, pa.int32()), pa.array([part] * n, pa.int32()), ids]
    arrays += [pa.array(c, k) for c, k in zip(columns, KINDS)] if columns else [pa.nulls(n, k) for k in KINDS]
    return pa.RecordBatch.from_arrays([*arrays, pa.array([text] * n, pa.string())], names=["kind", "part", *COLUMNS, "text"])


DONE, LAST, FIRST = range(3)


def successive(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (id, text) -> finished rows, the partition's first text, and its last row still without a successor."""
    part = TaskContext.get().partitionId()
    ids, texts, begun = None, [], False
    for batch, more in chunks(batches, "text", STEP_BYTES):
        column = batch.column(batch.schema.get_field_index("id"))
        if not begun:
            yield _batch(FIRST, part, column.slice(0, 1), [], more[0])
            begun = True
        ids = column if ids is None else pa.concat_arrays([ids, column])
        texts += more
        if len(texts) > 1:
            yield _batch(DONE, part, ids.slice(0, len(texts) - 1), compared(texts[:-1], texts[1:]))
            ids, texts = ids.slice(len(texts) - 1), texts[-1:]
    if begun:
        yield _batch(LAST, part, ids, [], texts[0])


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(len(batch)):
            row = batch.slice(i, 1).to_pydict()
            columns = compared([row["text"][0] or ""], [row["following"][0] or ""])
            yield _batch(DONE, 0, batch.column(batch.schema.get_field_index("id")).slice(i, 1), columns).drop_columns(["kind", "part", "text"])


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of ``docs``, by descending id: id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next."""
    kind = dict(docs.dtypes)[doc_id]
    rows = docs.select(F.col(doc_id).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = rows.withColumns({"tie": F.xxhash64("text"), "copy": F.monotonically_increasing_id()})
    order = [F.desc_nulls_last("id"), F.col("tie"), F.col("copy")]
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("id", "text")
    schema = f"kind int, part int, id {kind}, {RESULT}, text string"
    met = stage(dealt.mapInArrow(successive, schema), "iblt-versions", "zstd")
    done = met.filter(F.col("kind") == DONE).select(COLUMNS)
    # one row per partition: the window orders partition numbers alone, texts follow by join
    parts = met.filter(F.col("kind") == FIRST).select("part")
    ring = Window.orderBy("part")
    after = F.coalesce(F.lead("part").over(ring), F.first("part").over(ring.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    heads = met.filter(F.col("kind") == FIRST).select(F.col("part").alias("after"), F.col("text").alias("following"))
    last = met.filter(F.col("kind") == LAST).select("part", "id", "text")
    pairs = last.join(parts.withColumn("after", after), "part").join(heads, "after").select("id", "text", "following")
    both = done.unionByName(pairs.mapInArrow(_meet, f"id {kind}, {RESULT}"))
    shown = {name: F.base64(name) for name in ("fingerprint", "edited_fingerprint")}
    return both.withColumns({**shown, "edited_sha256": F.lower(F.hex("edited_sha256"))})
