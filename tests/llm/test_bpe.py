import hashlib
import random

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.frames import empty, odd, odd_rows
from tickfold.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
RANKS = bpe.read_ranks(PATH)
ENCODING = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})
CACHE = bpe.Pieces(bpe.Merges(RANKS))
PARTS = ["a", "b", "Z", "'", "'s", "'ll", "'ve", "'re", "'t", "'x", " ", "  ", "\n", "\t", "é", "中", "٣", "1", "23", "!", "..", "́", "😀", "\x85", "\x1c", "　", "\x00", "l", "'d", "'m", "'r"]


def ours(texts):
    ids, rows = bpe.encode_texts(texts, CACHE, bpe.class_table())
    return [ids[a:b].tolist() for a, b in zip(rows[:-1].tolist(), rows[1:].tolist())]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.text(max_size=40), st.lists(st.sampled_from(PARTS), max_size=30).map("".join)), min_size=1, max_size=6))
def test_ids_equal_the_library(texts):
    assert ours(texts) == [ENCODING.encode_ordinary(t) for t in texts]


@pytest.mark.parametrize("text", ["a" * 5000, "abc" * 3000, " " * 3000 + "x", "中文" * 2000, "don't'll's" * 50, "\n\n x\n y "])
def test_long_pieces(text):
    assert ours([text]) == [ENCODING.encode_ordinary(text)]


def test_a_full_cache_is_emptied(monkeypatch):
    """Bounded by bytes; ids stay the same."""
    monkeypatch.setattr(bpe, "CACHE_BYTES", 2000)
    cache = bpe.Pieces(CACHE.merges)
    texts = [f"word{i} other{i * 7} néant{i}" for i in range(200)]
    for at in range(0, 200, 20):
        ids, rows = bpe.encode_texts(texts[at : at + 20], cache, bpe.class_table())
        assert [ids[a:b].tolist() for a, b in zip(rows, rows[1:])] == [ENCODING.encode_ordinary(t) for t in texts[at : at + 20]]
    assert cache.held < 2000 + 80 * (bpe.PIECE_COST + 40)


def test_scan_is_a_prefix_composition():
    compose, functions, of_class, _ = bpe.monoid()
    draw = random.Random(5)
    import numpy as np

    values = of_class[np.array([draw.randrange(9) for _ in range(70_000)])]
    scanned = bpe.scan(values, compose)
    state = 0
    for i in range(0, 70_000):
        state = functions[values[i], state]
        if i % 997 == 0 or i == 69_999:
            assert functions[scanned[i], 0] == state


def test_table_round_trip(spark):
    out = bpe.encode(odd(spark), PATH, decoded=True)
    assert [c for c in out.columns if c not in ("ids", "offsets", "decoded")] == odd(spark).columns
    rows = out.collect()
    assert len(rows) == len(odd_rows())
    for row in rows:
        text = row.text or ""
        assert list(row.ids) == ENCODING.encode_ordinary(text)
        assert bytes(row.decoded) == text.encode()
        data, vocabulary = text.encode(), bpe.vocabulary_of(RANKS)
        assert all(data[at : at + len(vocabulary[i])] == vocabulary[i] for at, i in zip(row.offsets[:200], row.ids))
    back = bpe.decode(out, PATH, keep=["doc_id"]).collect()
    assert sorted(hashlib.md5(r.text.encode()).hexdigest() for r in back) == sorted(
        hashlib.md5((r.text or "").encode()).hexdigest() for r in rows
    )
    assert bpe.encode(empty(spark), PATH).count() == 0
