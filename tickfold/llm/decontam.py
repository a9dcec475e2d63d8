"""Benchmark decontamination with suffix arrays of the training text.

Training documents are cut into shards (runs of rows inside a task). A shard's words become numbers, its suffixes are
sorted by prefix doubling, and all suffixes of the benchmark items are binary-searched in it at once. That gives, per test
suffix, the longest verbatim match and its place, and per window of test words the range of all places where it occurs.
Only suffixes that begin with enough words known to the benchmark can match, so only those are sorted.

The benchmark's words are cut by Spark and written. They go to the tasks in blocks of at most ``BLOCK_WORDS`` words, one block
and one broadcast at a time: a benchmark of one block takes one pass without a shuffle, a larger one a pass per block, whose
hits are put together by row.

Null texts have no words; a document or item without words has no hits. Items with equal ids count as one item; a null id
is written as an empty one. Repeated documents are separate rows. Empty tables give an empty result, or no hits.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from functools import partial
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickfold.llm.common import chunks, extended, free_name, schema_of, stage, staged_rows

#: Words of UTF-8 text in lower case: digits, a to z, and everything beyond ASCII.
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
WINDOW = 10
#: Benchmark words in one broadcast (about 30 MB as numbers and text); an item of more is a block of its own.
BLOCK_WORDS = 1_000_000
BREAK = -1


def words(text: str) -> list[bytes]:
    return WORD.findall(text.encode().lower())  # bytes.lower() changes A-Z alone


class Block(NamedTuple):
    """Some benchmark items as numbers."""

    vocabulary: dict[bytes, int]
    items: list[str]
    flat: np.ndarray  # words of all items, each item followed by BREAK
    item: np.ndarray  # item of each suffix
    start: np.ndarray  # begin of each suffix in flat
    length: np.ndarray  # words from there to the item's end
    window: np.ndarray  # words of the window that begins there, 0 if none does


def block_of(items: list[tuple[str, list[bytes]]], window: int) -> Block:
    vocabulary: dict[bytes, int] = {}
    flat, item, start, length, size = [], [], [], [], []
    for k, (_, found) in enumerate(items):
        width = min(window, len(found))
        for i in range(len(found)):
            item.append(k)
            start.append(len(flat) + i)
            length.append(len(found) - i)
            size.append(width if len(found) - i >= width else 0)
        flat += [vocabulary.setdefault(w, len(vocabulary)) for w in found] + [BREAK]
    columns = [np.array(x, np.int64) for x in (flat, item, start, length, size)]
    return Block(vocabulary, [name for name, _ in items], *columns)


def blocks(benchmark: DataFrame, item_id: str, text: str, window: int) -> list[Callable[[], Broadcast]]:
    """The benchmark in blocks of at most ``BLOCK_WORDS`` words (one item at least), each broadcast when it is called for.

    Tasks cut the words and number pieces of that size; pieces that follow each other share a block while they fit. Only
    their sizes, one per piece, come to the driver at once.
    """
    most = BLOCK_WORDS

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        piece, held = TaskContext.get().partitionId() << 32, 0
        for batch, texts in chunks(batches, "text"):
            found = [words(t) for t in texts]
            pieces = []
            for own in found:
                if held and held + len(own) > most:
                    piece, held = piece + 1, 0
                held += len(own)
                pieces.append(piece)
            new = {
                "piece": pa.array(pieces, pa.int64()),
                "n": pa.array([len(own) for own in found], pa.int64()),
                "words": pa.array([b" ".join(own) for own in found], pa.binary()),
            }
            yield extended(batch, ["id"], new)

    rows = benchmark.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("id"), F.col(text).alias("text"))
    items = stage(rows.mapInArrow(step, "id string, piece long, n long, words binary"), "benchmark-pieces")
    bounds: list[tuple[int, int]] = []
    room = 0
    for piece, n in items.groupBy("piece").agg(F.sum("n")).orderBy("piece").collect():
        if bounds and n <= room:
            bounds[-1] = (bounds[-1][0], piece)
            room -= n
        else:
            bounds.append((piece, piece))
            room = most - n
    return [partial(_shared, items.filter(F.col("piece").between(*b)), window) for b in bounds]


def _shared(items: DataFrame, window: int) -> Broadcast:
    """The broadcast of one block's items."""
    held = [(r["id"], bytes(r["words"]).split()) for r in items.select("id", "words").collect()]
    return items.sparkSession.sparkContext.broadcast(block_of(held, window))


def suffix_array(flat: np.ndarray, depth: int) -> np.ndarray:
    """Positions of ``flat`` by the order of their suffixes, of which the first ``depth`` numbers count at least."""
    n = len(flat)
    _, rank = np.unique(flat, return_inverse=True)
    rank, width = rank.astype(np.int64) + 1, 1
    while True:
        after = np.zeros(n, np.int64)
        after[: n - width] = rank[width:]
        key = rank * (n + 2) + after
        order = np.argsort(key, kind="stable")
        changed = np.append(0, np.diff(key[order]) != 0)
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(changed) + 1
        width *= 2
        if width >= depth or rank[order[-1]] == n:
            return order


def _common(flat: np.ndarray, at: np.ndarray, query: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Equal words of the suffixes of ``flat`` at ``at`` and the query suffixes, ``length`` at most."""
    equal = np.zeros(len(at), np.int64)
    on = np.flatnonzero(length > 0)
    while len(on):
        p, q = at[on] + equal[on], start[on] + equal[on]
        same = (p < len(flat)) & (flat[np.minimum(p, len(flat) - 1)] == query[q])
        on = on[same]
        equal[on] += 1
        on = on[equal[on] < length[on]]
    return equal


def search(flat: np.ndarray, order: np.ndarray, query: np.ndarray, start: np.ndarray, length: np.ndarray, right: bool) -> np.ndarray:
    """Binary search of all query suffixes (their first ``length`` words) at once: places in ``order`` before or behind."""
    low, high = np.zeros(len(start), np.int64), np.full(len(start), len(order), np.int64)
    while (on := np.flatnonzero(low < high)).size:
        middle = (low[on] + high[on]) // 2
        at = order[middle]
        equal = _common(flat, at, query, start[on], length[on])
        whole = equal == length[on]
        p, q = at + equal, start[on] + np.minimum(equal, length[on] - 1)
        less = np.where(p < len(flat), flat[np.minimum(p, len(flat) - 1)], BREAK - 1) < query[q]
        below = np.where(whole, right, less)
        low[on] = np.where(below, middle + 1, low[on])
        high[on] = np.where(below, high[on], middle)
    return low


class Shard(NamedTuple):
    flat: np.ndarray  # numbers of the kept words, BREAK between runs
    place: np.ndarray  # document word (over the whole shard) of each
    order: np.ndarray


def shard_of(found: list[list[bytes]], block: Block, least: int) -> Shard | None:
    """The sorted suffixes of a shard: runs of at least ``least`` benchmark words."""
    get = block.vocabulary.get
    numbers: list[int] = []
    for own in found:
        numbers += [get(w, BREAK) for w in own]
        numbers.append(BREAK)
    known = np.array(numbers, np.int64)
    edges = np.flatnonzero(np.diff(np.concatenate([[False], known != BREAK, [False]])))
    first, stop = edges[::2], edges[1::2]
    long = stop - first >= least
    first, stop = first[long], stop[long]
    if not len(first):
        return None
    size = stop - first + 1  # with the BREAK behind the run
    place = np.arange(size.sum()) + np.repeat(first - (np.cumsum(size) - size), size)
    flat = known[place]
    return Shard(flat, place, suffix_array(flat, int(block.length.max())))


def ranges(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """All numbers from each low to each high."""
    size = high - low
    return np.arange(size.sum()) + np.repeat(low - (np.cumsum(size) - size), size)


class Marks(NamedTuple):
    """Hits of one shard."""

    words: np.ndarray  # of each document
    hit: np.ndarray  # of each document
    items: list[set[str]]
    spans: list[list[tuple[int, int]]]  # hit words of each document, from and to


def mark(found: list[list[bytes]], parts: list[Block]) -> Marks:
    """Hit words and occurring items of each document of a shard."""
    counts = np.array([len(w) for w in found], np.int64)
    offsets = np.append(0, np.cumsum(counts + 1))
    hit = np.zeros(offsets[-1] + 1, np.int64)
    items: list[set[str]] = [set() for _ in found]
    for block in parts:
        begins = np.flatnonzero(block.window > 0)
        if not len(begins):
            continue
        shard = shard_of(found, block, int(block.window[begins].min()))
        if shard is None:
            continue
        start, width = block.start[begins], block.window[begins]
        low = search(shard.flat, shard.order, block.flat, start, width, False)
        # most windows occur nowhere: the upper end is searched for the others alone
        at = shard.order[np.minimum(low, len(shard.order) - 1)]
        there = np.flatnonzero((_common(shard.flat, at, block.flat, start, width) == width) & (low < len(shard.order)))
        low, start, width, begins = low[there], start[there], width[there], begins[there]
        high = search(shard.flat, shard.order, block.flat, start, width, True)
        # equal windows lie at the same places: each is expanded once, so places are as many as the shard's words at most
        # for every width
        _, first, alike = np.unique(np.stack([low, high, width]), axis=1, return_index=True, return_inverse=True)
        alike = alike.ravel()
        low, high, width = low[first], high[first], width[first]
        place = shard.place[shard.order[ranges(low, high)]]
        np.add.at(hit, place, 1)
        np.add.at(hit, place + np.repeat(width, high - low), -1)
        doc = np.searchsorted(offsets, place, side="right") - 1
        held = np.unique(np.stack([alike, block.item[begins]]), axis=1)  # (window, item), windows in order
        begin = np.searchsorted(held[0], np.arange(len(first) + 1))
        met = np.unique(np.repeat(np.arange(len(first)), high - low) + doc * len(first))
        for d, w in zip((met // len(first)).tolist(), (met % len(first)).tolist()):
            items[d].update(block.items[k] for k in held[1][begin[w] : begin[w + 1]].tolist())
    inside = np.cumsum(hit[:-1]) > 0
    covered = np.append(0, np.cumsum(inside))
    edges = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]])))  # no window reaches over a text's end
    spans: list[list[tuple[int, int]]] = [[] for _ in found]
    for first, stop in edges.reshape(-1, 2).tolist():
        d = int(np.searchsorted(offsets, first, side="right")) - 1
        spans[d].append((first - int(offsets[d]), stop - int(offsets[d])))
    return Marks(counts, covered[offsets[:-1] + counts] - covered[offsets[:-1]], items, spans)


#: Words in the union of ``spans``.
UNION = """aggregate(array_sort(spans), named_struct('upto', 0L, 'n', 0L), (x, s) -> named_struct(
    'upto', greatest(x.upto, s.b), 'n', x.n + greatest(0L, s.b - greatest(s.a, x.upto))), x -> x.n)"""


def _in_passes(rows: DataFrame, text: str, row: str, parts: list[Callable[[], Broadcast]]) -> DataFrame:
    """(row, n_words, n_hit, items) of all rows, block by block: one block's hits are written before the next is broadcast."""
    found = None
    for k, part in enumerate(parts):
        shared = part()

        def step(batches: Iterator[pa.RecordBatch], shared: Broadcast = shared, k: int = k) -> Iterator[pa.RecordBatch]:
            spans_of = pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))
            for batch, texts in chunks(batches, text):
                marks = mark([words(t) for t in texts], [shared.value])
                spans = [[{"a": a, "b": b} for a, b in own] for own in marks.spans]
                new = {
                    "n_words": pa.array(marks.words),
                    "spans": pa.array(spans, spans_of),
                    "items": pa.array([sorted(s) for s in marks.items], pa.list_(pa.string())),
                }
                # the first pass names every row, later ones those that they hit
                yield extended(batch, [row], new).filter(pa.array((marks.hit > 0) | (k == 0)))

        hits = rows.select(row, text).mapInArrow(step, f"`{row}` long, n_words long, spans array<struct<a: long, b: long>>, items array<string>")
        hits = stage(hits, "benchmark-hits")
        shared.unpersist()
        found = hits if found is None else found.union(hits)
    # a row has as many parts as blocks at most, and its spans are within its words
    whole = found.groupBy(row).agg(
        F.max("n_words").alias("n_words"), F.flatten(F.collect_list("spans")).alias("spans"), F.flatten(F.collect_list("items")).alias("items")
    )
    return whole.select(row, "n_words", F.expr(UNION).alias("n_hit"), F.array_sort(F.array_distinct("items")).alias("items"))


def contamination(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text", keep: list[str] | None = None, window: int = WINDOW) -> DataFrame:
    """``keep`` columns with n_words, n_hit and ``items`` (ids of the items with occurring windows, sorted as strings).

    A window is ``window`` consecutive item words, or a whole shorter item. New columns replace kept ones of the same name.
    """
    new = ("n_words", "n_hit", "items")
    keep = [c for c in (docs.columns if keep is None else keep) if c.lower() not in new]
    columns = list(dict.fromkeys([*keep, text]))
    parts = blocks(benchmark, item_id, item_text, window)
    if len(parts) > 1:
        row = free_name(docs, "row_number")
        rows = staged_rows(docs.select(*columns), row, "benchmark-rows")
        return rows.select(row, *keep).join(_in_passes(rows, text, row, parts), row).select(*keep, *new)
    shared = [part() for part in parts]

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [b.value for b in shared]
        for batch, texts in chunks(batches, text):
            marks = mark([words(t) for t in texts], parts)
            found = [sorted(s) for s in marks.items]
            columns = (pa.array(marks.words), pa.array(marks.hit), pa.array(found, pa.list_(pa.string())))
            yield extended(batch, keep, dict(zip(new, columns)))

    return docs.select(*columns).mapInArrow(step, schema_of(docs, keep, "n_words long, n_hit long, items array<string>"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, text: str = "text", window: int = WINDOW) -> DataFrame:
    """The documents without any hit word, with their own columns."""
    names = docs.columns
    held = [f"c{i}" for i in range(len(names))]
    marked = contamination(docs.toDF(*held), benchmark, text=held[names.index(text)], window=window)
    return marked.filter("n_hit = 0").select(*held).toDF(*names)


def longest_matches(docs: DataFrame, benchmark: DataFrame, text: str = "text", doc_id: str = "doc_id", item_id: str = "item_id", item_text: str = "text", least: int = WINDOW) -> DataFrame:
    """Per test suffix the longest verbatim match of at least ``least`` words, and one place where it lies.

    Columns: item_id, item_word, length, doc_id, doc_word (word offsets from 0). Shards report their own best, which are
    then compared by a grouped maximum.
    """
    kind = dict(docs.dtypes)[doc_id]

    def step(batches: Iterator[pa.RecordBatch], shared: Broadcast) -> Iterator[pa.RecordBatch]:
        block = shared.value
        ask = np.flatnonzero(block.length >= least)
        for batch, texts in chunks(batches, text):
            found = [words(t) for t in texts]
            offsets = np.append(0, np.cumsum([len(w) + 1 for w in found]))
            shard = shard_of(found, block, least) if len(ask) else None
            if shard is not None:
                start, length = block.start[ask], block.length[ask]
                low = search(shard.flat, shard.order, block.flat, start, length, False)
                best, at = np.zeros(len(ask), np.int64), np.zeros(len(ask), np.int64)
                for beside in (low - 1, low):  # the longest match is a neighbour of the place of insertion
                    inside = np.clip(beside, 0, len(shard.order) - 1)
                    equal = _common(shard.flat, shard.order[inside], block.flat, start, length)
                    at = np.where(equal > best, shard.order[inside], at)
                    best = np.maximum(best, equal)
                good = np.flatnonzero(best >= least)
                place = shard.place[at[good]]
                doc = np.searchsorted(offsets, place, side="right") - 1
                k = block.item[ask[good]]
                first = np.searchsorted(block.item, k)  # an item's suffixes follow each other
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([block.items[i] for i in k.tolist()], pa.string()),
                        pa.array(ask[good] - first),
                        pa.array(best[good]),
                        batch.column(0).take(pa.array(doc)),
                        pa.array(place - offsets[doc]),
                    ],
                    names=["item_id", "item_word", "length", "doc_id", "doc_word"],
                )

    schema = f"item_id string, item_word long, length long, doc_id {kind}, doc_word long"
    found = docs.sparkSession.createDataFrame([], schema)
    for part in blocks(benchmark, item_id, item_text, least):
        shared = part()
        found = found.union(stage(docs.select(doc_id, text).mapInArrow(lambda b, shared=shared: step(b, shared), schema), "benchmark-longest"))
        shared.unpersist()
    best = F.max(F.struct("length", "doc_id", "doc_word")).alias("best")
    return found.groupBy("item_id", "item_word").agg(best).select("item_id", "item_word", "best.*")
