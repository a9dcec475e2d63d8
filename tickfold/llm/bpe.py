"""Byte-level BPE over whole texts, with decoding.

Text is cut into pieces without a regular expression. Code points become classes by one table look-up; a class is a
function from the state of the piece automaton to its next state, and such functions compose associatively. All functions
that can arise form a small monoid, so a prefix scan over positions is a scan over small integers with one composition
table, done block-wise for all blocks at once. State and class of a position then say whether a piece begins there. Pieces
are merged by rank once and cached.

Nulls are empty texts, and an empty text has no tokens. Rows are independent: ties, repeated rows and other columns play
no role, and an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import heapq
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tickfold.llm.common import chunks, extended, schema_of

# Classes of code points; the last five depend on what follows.
LETTER, NUMBER, OTHER, SPACE, CONTRACT_1, CONTRACT_2, JOINED, SINGLE, BREAK = range(9)
# States: nothing open, letters, numbers, others, white space, a blank that the next piece takes, contraction letters due.
FREE, IN_LETTERS, IN_NUMBERS, IN_OTHERS, IN_SPACE, BLANK, DUE_1, DUE_2 = range(8)

#: Bytes of the pieces kept in a worker's cache, reckoned with ``PIECE_COST`` for each.
CACHE_BYTES, PIECE_COST = 30 << 20, 200
#: Text bytes that are encoded at once: what a task holds beside its batch is some 60 times that.
STEP_BYTES = 1 << 20
#: Pieces longer than this are merged with a heap.
LONG_PIECE = 48
#: Rank of a pair that doesn't join.
NONE = 1 << 30
BLOCK = 256


def read_ranks(path: str) -> dict[bytes, int]:
    """The ranks of a ``.tiktoken`` file on the driver."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


@lru_cache(1)
def class_table() -> np.ndarray:
    """Class of every code point by the Unicode version of the tokenizer library, asked for once on the driver."""
    import tiktoken

    points = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)
    bytes_only = {bytes([i]): i for i in range(256)}
    table = np.full(0x110000, OTHER, np.uint8)
    for pattern, kind in ((r"\p{L}", LETTER), (r"\p{N}", NUMBER), (r"\s", SPACE)):
        encoding = tiktoken.Encoding("classes", pat_str=pattern, mergeable_ranks=bytes_only, special_tokens={})
        found = encoding.decode_bytes(encoding.encode_ordinary(points)).decode()
        table[np.frombuffer(found.encode("utf-32-le"), np.uint32)] = kind
    return table


def _step(state: int, kind: int) -> tuple[int, bool]:
    """Next state, and whether a piece begins at a position of class ``kind``."""
    if kind == LETTER and state in (DUE_1, DUE_2):
        return (FREE if state == DUE_1 else DUE_1), False
    if kind in (LETTER, NUMBER):
        own = IN_LETTERS if kind == LETTER else IN_NUMBERS
        return own, state not in (own, BLANK)
    if kind in (OTHER, CONTRACT_1, CONTRACT_2):
        if state in (IN_OTHERS, BLANK):
            return IN_OTHERS, False
        return {OTHER: IN_OTHERS, CONTRACT_1: DUE_1, CONTRACT_2: DUE_2}[kind], True
    if kind == SPACE:
        return IN_SPACE, state != IN_SPACE
    return (BLANK if kind == JOINED else FREE), True


@lru_cache(1)
def monoid() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(composition table, function table, index of each class's function, begin flags by state and class)."""
    classes = [tuple(_step(s, k)[0] for s in range(8)) for k in range(9)]
    functions = list(dict.fromkeys(classes))
    index = {f: i for i, f in enumerate(functions)}
    for f in functions:  # grows while it is read: closure under composition
        for g in classes:
            if (h := tuple(g[s] for s in f)) not in index:
                index[h] = len(functions)
                functions.append(h)
    compose = np.array([[index[tuple(g[s] for s in f)] for g in functions] for f in functions], np.uint8)
    assert len(functions) <= 256
    begins = np.array([[_step(s, k)[1] for k in range(9)] for s in range(8)])
    return compose, np.array(functions, np.uint8), np.array([index[f] for f in classes], np.uint8), begins


def scan(values: np.ndarray, compose: np.ndarray) -> np.ndarray:
    """Inclusive prefix composition of a row of functions."""
    n = len(values)
    if n <= BLOCK:
        out = values.copy()
        for i in range(1, n):
            out[i] = compose[out[i - 1], out[i]]
        return out
    rows = -(-n // BLOCK)
    padded = np.resize(values, rows * BLOCK)
    grid = np.ascontiguousarray(padded.reshape(rows, BLOCK).T)
    flat, size = compose.ravel(), len(compose)
    for j in range(1, BLOCK):  # within all blocks at once
        grid[j] = flat[grid[j - 1].astype(np.int32) * size + grid[j]]
    before = scan(grid[-1], compose)[:-1]  # over the blocks
    grid[:, 1:] = flat[before.astype(np.int32)[None, :] * size + grid[:, 1:]]
    return grid.T.ravel()[:n]


def classify(points: np.ndarray, table: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Classes of positions; ``ends`` are positions between texts."""
    kinds = table[points]
    kinds[ends] = BREAK
    following = np.append(kinds[1:], BREAK)
    white = kinds == SPACE
    before_text = white & (following != SPACE) & (following != BREAK)
    quote = np.flatnonzero((points == 0x27) & (following == LETTER))
    if len(quote):
        last = len(points) - 1
        a, b = points[quote + 1], points[np.minimum(quote + 2, last)]
        kinds[quote[np.isin(a, [ord(c) for c in "stmd"])]] = CONTRACT_1
        # re, ve, ll
        two = ((a == ord("r")) | (a == ord("v"))) & (b == ord("e")) | (a == ord("l")) & (b == ord("l"))
        kinds[quote[two & (quote + 2 <= last) & ~np.isin(quote + 2, ends)]] = CONTRACT_2
    kinds[before_text] = np.where(points[before_text] == 0x20, JOINED, SINGLE)
    return kinds


def piece_starts(points: np.ndarray, table: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Positions at which pieces begin; a position between texts is a piece of its own."""
    compose, functions, of_class, begins = monoid()
    kinds = classify(points, table, ends)
    after = functions[scan(of_class[kinds], compose), FREE]
    before = np.concatenate([[FREE], after[:-1]]).astype(np.uint8)
    return np.flatnonzero(begins[before, kinds])


class Merges:
    """Pairs of ids that join, in an open-addressed table, and the merging of many short pieces at once."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        keys, values = self._pairs()
        self.bits = max(4, (2 * len(keys)).bit_length())
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.values = np.zeros(1 << self.bits, np.int32)
        at = self._slot(keys)
        while len(keys):  # each free slot takes one key, the others move on
            _, first = np.unique(at, return_index=True)
            first = first[self.keys[at[first]] == -1]
            self.keys[at[first]], self.values[at[first]] = keys[first], values[first]
            left = np.setdiff1d(np.arange(len(keys)), first)
            keys, values, at = keys[left], values[left], (at[left] + 1) & (len(self.keys) - 1)
        self.of_byte = np.array([ranks.get(bytes([i]), -1) for i in range(256)], np.int64)

    def _pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """(both ids of a pair in one number, rank of the token they join to)."""
        keys, values = array("q"), array("q")
        for token, rank in self.ranks.items():
            for i in range(1, len(token)):
                if (a := self.ranks.get(token[:i])) is not None and (b := self.ranks.get(token[i:])) is not None:
                    keys.append(a << 32 | b)
                    values.append(rank)
        return np.array(keys, np.int64), np.array(values, np.int64)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - self.bits)).astype(np.int64)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each joined pair, or ``NONE``."""
        keys = left << 32 | right
        at = self._slot(keys)
        out = np.full(len(keys), NONE, np.int64)
        due = np.arange(len(keys))
        while len(due):
            there = self.keys[at]
            hit = there == keys[due]
            out[due[hit]] = self.values[at[hit]]
            on = ~hit & (there != -1)
            due, at = due[on], (at[on] + 1) & (len(self.keys) - 1)
        return out

    def merge(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of each piece (four bytes an id): in every round, each piece joins its lowest-ranked pair, the leftmost of equals."""
        out = [b""] * len(pieces)
        short = []
        for i, piece in enumerate(pieces):
            if piece in self.ranks:
                out[i] = self.ranks[piece].to_bytes(4, "little")
            elif len(piece) > LONG_PIECE:
                out[i] = array("i", _merge_long(piece, self.ranks)).tobytes()
            else:
                short.append(i)
        ids = self.of_byte[np.frombuffer(b"".join(pieces[i] for i in short), np.uint8)]
        owner = np.repeat(np.array(short, np.int64), [len(pieces[i]) for i in short])
        done = [(owner[:0], ids[:0])]
        while len(ids):
            found = np.full(len(ids), NONE, np.int64)
            inner = np.flatnonzero(owner[:-1] == owner[1:])
            found[inner] = self.rank(ids[inner], ids[inner + 1])
            first = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
            best = np.minimum.reduceat(found << 32 | np.arange(len(ids)), first)
            rank, at = best >> 32, best & 0xFFFFFFFF
            over = rank == NONE
            ended = np.repeat(over, np.diff(np.append(first, len(ids))))
            done.append((owner[ended], ids[ended]))
            at, rank = at[~over], rank[~over]
            ids[at] = rank
            keep = ~ended
            keep[at + 1] = False
            ids, owner = ids[keep], owner[keep]
        owner, ids = (np.concatenate(x) for x in zip(*done))
        order = np.argsort(owner, kind="stable")
        owner, flat = owner[order], ids[order].astype("<i4").tobytes()
        first = (np.flatnonzero(np.append(True, owner[1:] != owner[:-1])) if len(owner) else owner).tolist()
        for a, b in zip(first, [*first[1:], len(owner)]):
            out[owner[a]] = flat[4 * a : 4 * b]
        return out


def _merge_long(piece: bytes, ranks: dict[bytes, int]) -> tuple[int, ...]:
    """The same by a heap of candidate pairs over a linked list of parts."""
    n = len(piece)
    end, after, ahead = list(range(1, n + 1)), list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(piece[i : i + 2])) is not None]
    heapq.heapify(heap)
    alive = [True] * n
    while heap:
        _, i, stop = heapq.heappop(heap)
        j = after[i] if alive[i] else n
        if j >= n or end[j] != stop:
            continue  # one of the two parts has changed since
        alive[j], end[i], after[i] = False, stop, after[j]
        if after[i] < n:
            ahead[after[i]] = i
            if (r := ranks.get(piece[i : end[after[i]]])) is not None:
                heapq.heappush(heap, (r, i, end[after[i]]))
        if ahead[i] >= 0 and (r := ranks.get(piece[ahead[i] : stop])) is not None:
            heapq.heappush(heap, (r, ahead[i], stop))
    return tuple(ranks[piece[i : end[i]]] for i in range(n) if alive[i])


class Pieces(dict):
    """Ids (four bytes each) by piece; pieces not met before are merged together. Emptied when it holds ``CACHE_BYTES``."""

    def __init__(self, merges: Merges):
        super().__init__({"": b""})
        self.merges, self.held = merges, 0

    def learn(self, pieces: set[str]) -> None:
        new = [p for p in pieces if p not in self]
        if self.held > CACHE_BYTES:
            self.clear()
            self[""], self.held = b"", 0
            new = list(pieces - {""})
        ids = self.merges.merge([p.encode() for p in new])
        self.update(zip(new, ids))
        self.held += sum(map(len, new)) + sum(map(len, ids)) + PIECE_COST * len(new)


def encode_texts(texts: list[str], cache: Pieces, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all texts one after the other, position at which each text's ids begin and the last one's end)."""
    joined = "\n".join(texts) + "\n"
    ends = np.cumsum([len(t) + 1 for t in texts]) - 1
    starts = piece_starts(np.frombuffer(joined.encode("utf-32-le"), np.uint32), table, ends)
    at = starts.tolist()
    pieces = [joined[a:b] for a, b in zip(at, at[1:])]
    last = np.searchsorted(starts, ends)
    for k in last[:-1].tolist():  # a position between texts is no piece of theirs
        pieces[k] = ""
    cache.learn(set(pieces))
    found = list(map(cache.__getitem__, pieces))
    sizes = np.append(0, np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) // 4))
    return np.frombuffer(b"".join(found), "<i4"), np.append(0, sizes[last])


def decode_ids(ids: list[int], vocabulary: list[bytes]) -> bytes:
    return b"".join(map(vocabulary.__getitem__, ids))


def vocabulary_of(ranks: dict[bytes, int]) -> list[bytes]:
    out = [b""] * (max(ranks.values(), default=-1) + 1)
    for token, rank in ranks.items():
        out[rank] = token
    return out


#: The table of pairs in each Python worker, for the ranks it used last.
_MERGES: dict[str, Merges] = {}


def encode(docs: DataFrame, ranks_path: str, text: str = "text", keep: list[str] | None = None, offsets: bool = True, decoded: bool = False) -> DataFrame:
    """``keep`` columns with ``ids``, optionally ``offsets`` (first byte of each token) and ``decoded`` (bytes of the ids).

    Ranks and class table are of fixed size and broadcast. The ids of a step are one array cut by row; a task's cache of
    pieces is bounded by its bytes and goes with the task. New columns replace kept ones of the same name.
    """
    keep = docs.columns if keep is None else keep
    more = {"ids": "array<int>"} | ({"offsets": "array<int>"} if offsets else {}) | ({"decoded": "binary"} if decoded else {})
    keep = [c for c in keep if c.lower() not in more]
    shared = docs.sparkSession.sparkContext.broadcast((read_ranks(ranks_path), class_table()))

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks, table = shared.value
        if ranks_path not in _MERGES:
            _MERGES.clear()
            _MERGES[ranks_path] = Merges(ranks)
        cache, vocabulary = Pieces(_MERGES[ranks_path]), vocabulary_of(ranks)
        lengths = np.fromiter(map(len, vocabulary), np.int64, len(vocabulary))
        for batch, texts in chunks(batches, text, STEP_BYTES):
            ids, rows = encode_texts(texts, cache, table)
            bounds = pa.array(rows.astype(np.int32))
            new = {"ids": pa.ListArray.from_arrays(bounds, pa.array(ids))}
            if offsets or decoded:
                at = np.append(0, np.cumsum(lengths[ids]))
            if offsets:
                first = at[:-1] - np.repeat(at[rows[:-1]], np.diff(rows))
                new["offsets"] = pa.ListArray.from_arrays(bounds, pa.array(first.astype(np.int32)))
            if decoded:
                whole = decode_ids(ids.tolist(), vocabulary)
                ends = pa.array(at[rows].astype(np.int32)).buffers()[1]
                new["decoded"] = pa.Array.from_buffers(pa.binary(), len(texts), [None, ends, pa.py_buffer(whole)])
            yield extended(batch, keep, new)
        pa.default_memory_pool().release_unused()

    columns = list(dict.fromkeys([*keep, text]))
    return docs.select(*columns).mapInArrow(step, schema_of(docs, keep, ", ".join(f"{k} {v}" for k, v in more.items())))


def decode(encoded: DataFrame, ranks_path: str, keep: list[str], ids: str = "ids") -> DataFrame:
    """``keep`` columns with ``text``: the ids' bytes as UTF-8; bytes that are none become the replacement character."""
    keep = [c for c in keep if c.lower() != "text"]
    shared = encoded.sparkSession.sparkContext.broadcast(vocabulary_of(read_ranks(ranks_path)))

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column(batch.schema.get_field_index(ids)).to_pylist()
            texts = [decode_ids(r or [], shared.value).decode("utf-8", "replace") for r in rows]
            yield extended(batch, keep, {"text": pa.array(texts, pa.string())})

    columns = list(dict.fromkeys([*keep, ids]))
    return encoded.select(*columns).mapInArrow(step, schema_of(encoded, keep, "text string"))
