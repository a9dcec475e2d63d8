"""Fill-in-middle transformation over seekable compressed frames.

A text is stored as independent zstandard frames of bounded size. Every frame knows how many units (words with the blanks
before them) and code points end before it. A cut after k units is found by bisecting those counts and decompressing the one
frame that holds it; outputs are made by streaming frames in order, so no step holds a whole long text or its transformed
copy, and digests need one frame at a time.

Defined results: a null text is empty; an empty text, and one that contains a marker, stays plain. A null id draws like the
empty id. Equal rows give equal rows, a text of white space alone is one unit, very long texts are many frames, an empty
table gives an empty result, and other columns play no role (those to keep are named).
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickfold.llm.common import extended, free_name, schema_of

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
#: Bytes of text in a frame.
FRAME_BYTES = 64 << 10
LEVEL = 3
#: Text bytes (or rows) after which a task hands on what it made.
FLUSH_BYTES, FLUSH_ROWS = 4 << 20, 2000
SPACE = np.isin(np.arange(256), [0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D])
STORE = "n_units long, n_codes long, n_bytes long, marked boolean, frames array<struct<units: long, codes: long, at: long, data: binary>>"
FRAME = pa.struct([("units", pa.int64()), ("codes", pa.int64()), ("at", pa.int64()), ("data", pa.binary())])


def word_ends(data: np.ndarray) -> np.ndarray:
    """Whether a run of other bytes than white space ends with this byte, the last byte taken as the end of the text."""
    space = SPACE[data]
    return ~space & np.append(space[1:], True)


def leads(data: np.ndarray) -> int:
    """Code points that begin in ``data``."""
    return int(np.count_nonzero((data & 0xC0) != 0x80))


def frames_of(text: bytes, size: int, press: zstandard.ZstdCompressor) -> tuple[int, int, list[dict]]:
    """(units, code points, frames) of a text; a frame's counts are those that end before it."""
    if not text:
        return 0, 0, []
    data = np.frombuffer(text, np.uint8)
    starts = np.arange(0, len(data), size)
    if len(starts) == 1:
        units, codes = [0, int(np.count_nonzero(word_ends(data)))], [0, leads(data)]
    else:
        units = [0, *np.cumsum(np.add.reduceat(word_ends(data), starts, dtype=np.int64)).tolist()]
        codes = [0, *np.cumsum(np.add.reduceat((data & 0xC0) != 0x80, starts, dtype=np.int64)).tolist()]
    frames = [{"units": u, "codes": c, "at": at, "data": press.compress(text[at : at + size])} for u, c, at in zip(units, codes, starts.tolist())]
    return units[-1] + bool(SPACE[data[-1]]), codes[-1], frames


def store(docs: DataFrame, text: str = "text", keep: list[str] | None = None, frame_bytes: int = FRAME_BYTES) -> DataFrame:
    """``docs`` with the text as frames: n_units, n_codes (code points), n_bytes, marked (contains a marker) and frames."""
    keep = [c for c in docs.columns if c != text] if keep is None else keep
    source = free_name(docs.select(*keep), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=LEVEL)
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(source)).cast(pa.binary())
            made, held, first = [], 0, 0
            for i in range(len(column)):
                raw = column[i].as_py() or b""
                units, codes, frames = frames_of(raw, frame_bytes, press)
                made.append((units, codes, len(raw), any(m in raw for m in (PREFIX, SUFFIX, MIDDLE)), frames))
                held += len(raw)
                if held > FLUSH_BYTES or len(made) == FLUSH_ROWS or i == len(column) - 1:
                    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.list_(FRAME)]
                    arrays = [pa.array(c, k) for c, k in zip(zip(*made), kinds)]
                    names = ["n_units", "n_codes", "n_bytes", "marked", "frames"]
                    yield extended(batch.slice(first, len(made)), keep, dict(zip(names, arrays)))
                    made, held, first = [], 0, i + 1

    return docs.select(*keep, F.col(text).alias(source)).mapInArrow(run, schema_of(docs, keep, STORE))


class Text:
    """A stored text, read frame by frame."""

    def __init__(self, frames: list[dict], units: int, codes: int, size: int, unpress: zstandard.ZstdDecompressor):
        self.frames, self.units, self.codes, self.size, self.unpress = frames, units, codes, size, unpress
        self.held: tuple[int, bytes] = (-1, b"")

    def frame(self, k: int) -> bytes:
        if self.held[0] != k:
            self.held = k, self.unpress.decompress(self.frames[k]["data"])
        return self.held[1]

    def cut(self, units: int) -> tuple[int, int]:
        """(byte, code point) at which the first ``units`` units end."""
        if units == 0:
            return 0, 0
        if units == self.units:
            return self.size, self.codes
        k = bisect_left(self.frames, units, key=lambda f: f["units"]) - 1
        frame, data = self.frames[k], np.frombuffer(self.frame(k), np.uint8)
        ends = np.flatnonzero(word_ends(data))
        at = int(ends[units - frame["units"] - 1]) + 1
        return frame["at"] + at, frame["codes"] + leads(data[:at])

    def stream(self, start: int, stop: int) -> Iterator[bytes]:
        if start >= stop:
            return
        k = bisect_left(self.frames, start + 1, key=lambda f: f["at"]) - 1
        while k < len(self.frames) and (at := self.frames[k]["at"]) < stop:
            yield self.frame(k)[max(0, start - at) : stop - at]
            k += 1


def output(text: Text, form: str, a: int, b: int) -> Iterator[bytes]:
    """The transformed text in pieces; the prefix ends at byte a, the middle at b."""
    if form == "plain":
        yield from text.stream(0, text.size)
        return
    parts = [(PREFIX, 0, a), (SUFFIX, b, text.size)]
    for marker, start, stop in [*(parts if form == "psm" else parts[::-1]), (MIDDLE, a, b)]:
        yield marker
        yield from text.stream(start, stop)


def restored(pieces: Callable[[], Iterator[bytes]], form: str) -> Iterator[bytes]:
    """The exact text from a transformed one and its form alone: one pass finds the markers, then the parts are streamed."""
    if form == "plain":
        yield from pieces()
        return
    order = [PREFIX, SUFFIX, MIDDLE] if form == "psm" else [SUFFIX, PREFIX, MIDDLE]
    found: list[int] = []
    at, tail = 0, b""
    for piece in pieces():
        seen, base, start = tail + piece, at - len(tail), 0
        while len(found) < 3 and (hit := seen.find(order[len(found)], start)) >= 0:
            found.append(base + hit)
            start = hit + 3
        at += len(piece)
        tail = seen[max(start, len(seen) - 2) :]
    ends = dict(zip(order, [*found[1:], at]))
    begins = {marker: where + 3 for marker, where in zip(order, found)}
    for marker in (PREFIX, MIDDLE, SUFFIX):
        at = 0
        for piece in pieces():
            yield piece[max(0, begins[marker] - at) : max(0, ends[marker] - at)]
            at += len(piece)
            if at >= ends[marker]:
                break


def drawn(doc_id: Column, seed: int) -> list[Column]:
    """Four numbers of 32 bits for a document."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long") for i in range(4)]


def planned(stored: DataFrame, doc_id: str = "doc_id", seed: int = 42, rate: int = 50, spm_rate: int = 80) -> DataFrame:
    """``stored`` with the form (plain, psm, spm) and the units at which prefix and middle end; rates are in percent."""
    h = drawn(F.col(doc_id), seed)
    cuts = [h[i] % (F.col("n_units") + 1) for i in range(2)]
    plain = (F.col("n_bytes") == 0) | F.col("marked") | (h[2] % 100 >= rate)
    form = F.when(plain, "plain").when(h[3] % 100 < spm_rate, "spm").otherwise("psm")
    return stored.withColumns({"form": form, "first_cut": F.least(*cuts), "last_cut": F.greatest(*cuts)})


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, int, Text, str, int | None, int | None, int, int]]:
    """(batch, row, text, form, code points of prefix and middle, byte cuts) of every planned row."""
    unpress = zstandard.ZstdDecompressor()
    for batch in batches:
        columns = {name: batch.column(batch.schema.get_field_index(name)) for name in ("n_units", "n_codes", "n_bytes", "form", "first_cut", "last_cut", "frames")}
        for i in range(len(batch)):
            row = {name: column[i].as_py() for name, column in columns.items()}
            text = Text(row["frames"], row["n_units"], row["n_codes"], row["n_bytes"], unpress)
            if row["form"] == "plain":
                yield batch, i, text, "plain", None, None, 0, 0
                continue
            (a, p), (b, m) = text.cut(row["first_cut"]), text.cut(row["last_cut"])
            yield batch, i, text, row["form"], p, m - p, a, b


def _mapped(plans: DataFrame, keep: list[str], kinds: dict[str, str], row: Callable[[Text, str, int, int], tuple]) -> DataFrame:
    """``keep``, prefix_chars, middle_chars and what ``row`` gives (string columns)."""
    names = ["prefix_chars", "middle_chars", *kinds]
    types = [pa.int64(), pa.int64(), *[pa.string()] * len(kinds)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made, held, last = [], 0, None

        def flush() -> pa.RecordBatch:
            batch, i = last
            arrays = [pa.array(c, k) for c, k in zip(zip(*made), types)]
            return extended(batch.slice(i + 1 - len(made), len(made)), keep, dict(zip(names, arrays)))

        for batch, i, text, form, p, m, a, b in _texts(batches):
            if made and (batch is not last[0] or held > FLUSH_BYTES or len(made) == FLUSH_ROWS):
                yield flush()
                made, held = [], 0
            made.append((p, m, *row(text, form, a, b)))
            held, last = held + text.size, (batch, i)
        if made:
            yield flush()

    more = ", ".join(["prefix_chars long, middle_chars long", *(f"{n} {t}" for n, t in kinds.items())])
    return plans.mapInArrow(run, schema_of(plans, keep, more))


def digests(plans: DataFrame, keep: list[str]) -> DataFrame:
    """Per planned row ``keep``, prefix_chars, middle_chars, output_sha256 and restored_sha256, one frame in memory at a time."""

    def row(text: Text, form: str, a: int, b: int) -> tuple[str, str]:
        out, back = hashlib.sha256(), hashlib.sha256()
        for piece in output(text, form, a, b):
            out.update(piece)
        for piece in restored(lambda: output(text, form, a, b), form):
            back.update(piece)
        return out.hexdigest(), back.hexdigest()

    return _mapped(plans, keep, {"output_sha256": "string", "restored_sha256": "string"}, row)


def transformed(plans: DataFrame, keep: list[str]) -> DataFrame:
    """Per planned row ``keep``, prefix_chars, middle_chars and the transformed text itself in fim_text."""

    def row(text: Text, form: str, a: int, b: int) -> tuple[str]:
        return (b"".join(output(text, form, a, b)).decode(),)

    return _mapped(plans, keep, {"fim_text": "string"}, row)
