import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from tests.llm.frames import documents, empty, odd, prose
from tickfold.llm import fim
from tickfold.session import stage

UNIT = re.compile("[\x20\x09-\x0d]*[^\x20\x09-\x0d]+|[\x20\x09-\x0d]+")


def brute(doc_id, text):
    text = text or ""
    units = UNIT.findall(text)
    assert "".join(units) == text
    h = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * i : 8 * i + 8], 16) for i in range(4))
    n = len(units)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    if not text or re.search("<[PSM]>", text) or h3 % 100 >= 50:
        return doc_id, n, "plain", None, None, text, sha(text), sha(text)
    form = "spm" if h4 % 100 < 80 else "psm"
    out = f"<S>{suffix}<P>{prefix}<M>{middle}" if form == "spm" else f"<P>{prefix}<S>{suffix}<M>{middle}"
    return doc_id, n, form, len(prefix), len(middle), out, sha(out), sha(text)


def check(docs, frame_bytes):
    plans = fim.planned(stage(fim.store(docs.select("doc_id", "text"), frame_bytes=frame_bytes), "t"))
    keep = ["doc_id", "n_units", "form"]
    want = [brute(r.doc_id, r.text) for r in docs.collect()]
    key = lambda r: tuple(str(x) for x in r)
    got = sorted((tuple(r) for r in fim.digests(plans, keep).collect()), key=key)
    assert got == sorted((w[:5] + w[6:] for w in want), key=key)
    texts = sorted((tuple(r) for r in fim.transformed(plans, keep).collect()), key=key)
    assert texts == sorted((w[:6] for w in want), key=key)
    return {w[2] for w in want}


TEXTS = ["a", " ", "a b", " a", "a ", "  ab\n\ncd  ", "é ü\t中文 😀x", "<P> no", "x <S", "S> <M", "<", ">", "<P", "M>", "a < P> b <", "\x0b\x0c", "   "]


@pytest.mark.parametrize("frame_bytes", [1, 2, 3, 7, 64 << 10])
def test_equals_brute_force(spark, frame_bytes):
    draw = random.Random(frame_bytes)
    alphabet = ["<", ">", "P", "S", "M", " ", "\n", "é", "😀", "ab", "\t "]
    texts = TEXTS * 4 + ["".join(draw.choice(alphabet) for _ in range(draw.randrange(60))) for _ in range(300)]
    assert check(documents(spark, texts), frame_bytes) == {"plain", "psm", "spm"}


def test_long_texts_have_many_frames(spark):
    texts = [prose(i, 30_000) for i in range(12)] + ["x" * 300_000, "word " * 60_000]
    docs = documents(spark, texts)
    check(docs, fim.FRAME_BYTES)
    stored = fim.store(docs)
    assert stored.select(F.min(F.size("frames"))).first()[0] > 1
    row = stored.filter("doc_id = 12").first()
    assert row.n_units == 1 and row.frames[2].units == 0 and row.frames[2].at == 2 * fim.FRAME_BYTES


def test_a_cut_reads_one_frame():
    import zstandard

    raw = prose(3, 20_000).encode()
    units, codes, frames = fim.frames_of(raw, 1000, zstandard.ZstdCompressor())
    opened = []

    class Counting(fim.Text):
        def frame(self, k):
            opened.append(k)
            return super().frame(k)

    text = Counting(frames, units, codes, len(raw), zstandard.ZstdDecompressor())
    at, chars = text.cut(units // 2)
    assert len(set(opened)) == 1 and raw[:at].decode() == "".join(UNIT.findall(raw.decode())[: units // 2]) and chars == len(raw[:at].decode())
    opened.clear()
    assert b"".join(text.stream(at, at + 1500)) == raw[at : at + 1500] and len(set(opened)) <= 3


def test_odd_rows(spark):
    check(odd(spark), 1000)


def test_keeps_clashing_names(spark):
    stored = fim.store(odd(spark))
    assert stored.columns[:7] == ["doc_id", "lang", "source", "score", "row", "items", "class_id"]
    assert stored.count() == 11


def test_empty(spark):
    assert check(empty(spark), 1000) == set()
