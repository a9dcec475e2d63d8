import hashlib
import random
import string
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.frames import empty, odd, prose
from tickfold.llm import merkle
from tickfold.llm.common import fold_of

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(row) -> str:
    values = [None if v is None else str(v) for v in row]
    return sha("".join("-" if v is None else f"{len(v.encode())}:{v}" for v in values))


def reduce(nodes: list[str]) -> list[list[str]]:
    levels = [nodes]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([sha("".join(below[i : i + 8])) for i in range(0, len(below), 8)])
    return levels


def climb(levels, at, node, siblings):
    """The folded root; appends the siblings."""
    for level in levels[:-1]:
        start = at - at % 8
        run = level[start : start + 8]
        siblings += run[: at - start] + run[at - start + 1 :]
        node = sha("".join([*run[: at - start], node, *run[at - start + 1 :]]))
        at //= 8
    return node


def brute(rows):
    """rows: (doc_id, source, lang, n_chars, text)."""
    trees = {}
    for row in rows:
        trees.setdefault(row[2], []).append((row[0] is not None, row[0] or 0, leaf_of(row), row))
    order = sorted(trees, key=lambda k: (k is not None, (k or "").encode()))
    built = {k: reduce([x[2] for x in sorted(trees[k], key=lambda x: x[:3])]) for k in order}
    top = reduce([built[k][-1][0] for k in order])
    out = []
    for rank, k in enumerate(order):
        for at, (*_, leaf, row) in enumerate(sorted(trees[k], key=lambda x: x[:3])):
            key = "" if row[0] is None else str(row[0])
            low = row[4].translate(LOWER) if row[4] is not None and zlib.crc32(key.encode()) % 3 == 0 else row[4]
            siblings = []
            node = climb(built[k], at, leaf_of((*row[:4], low)), siblings)
            folded = climb(top, rank, node, siblings)
            out.append((row[0], leaf, built[k][-1][0], top[-1][0], sha("".join(siblings)), folded, folded == top[-1][0]))
    return out


def proved(df, **more):
    docs = df.select(*merkle.FIELDS)
    lowered = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    other = merkle.leaf([lowered if c == "text" else F.col(c) for c in merkle.FIELDS])
    return merkle.manifest(docs, changed=F.when(fold_of("doc_id", 3) == 0, other), **more)


def same(got, want):
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)


FIELDS = "doc_id long, source string, lang string, n_chars long, text string"


@pytest.mark.parametrize("sizes", [[1], [8], [9], [64, 65, 1, 7], [520, 3], [1] * 20])
def test_equals_brute_force(spark, sizes):
    rows, draw = [], random.Random(len(sizes))
    for k, size in enumerate(sizes):
        lang = None if k == 1 else f"l{chr(0xE9) if k % 2 else 'z'}{k}"
        rows += [(draw.randrange(10**6), "s", lang, i, prose(1000 * k + i, 4).title()) for i in range(size)]
    got = merkle.proofs(proved(spark.createDataFrame(rows, FIELDS).repartition(7))).collect()
    same(got, brute(rows))
    assert {r.verified for r in got} <= {True, False}


def test_many_small_pieces_and_deep_blocks(spark):
    """Trees of several passes, pieces that cut runs."""
    rows = [(i * 7 % 701, "s", "ab"[i % 3 == 0], i, f"Text {i}") for i in range(700)]
    made = proved(spark.createDataFrame(rows, FIELDS).repartition(5), block_levels=1, piece_bits=2)
    same(merkle.proofs(made).collect(), brute(rows))


def test_proofs_of_some_rows(spark):
    rows = [(i, "s", "ab"[i % 5 == 0], i, f"Text {i}") for i in range(900)]
    made = proved(spark.createDataFrame(rows, FIELDS))
    wanted = {3, 4, 5, 450, 895}
    got = merkle.proofs(made, made.leaves.filter(F.col("id").isin(wanted))).collect()
    same(got, [r for r in brute(rows) if r[0] in wanted])


def test_missing_is_least():
    draw = random.Random(5)
    for n in [1, 2, 8, 9, 64, 65, 1000]:
        known = np.array(sorted(draw.sample(range(n), draw.randrange(1, min(n, 20) + 1))))
        levels, below, size = merkle.missing(known, n), set(known.tolist()), n
        for lacking in levels:
            lacking = set(lacking.tolist())
            assert not lacking & below
            # every fetched node has a known sibling, and every run with a known node is whole
            assert {i // 8 for i in lacking} <= {i // 8 for i in below}
            for p in {i // 8 for i in below}:
                assert set(range(8 * p, min(8 * p + 8, size))) <= below | lacking
            below, size = {i // 8 for i in below}, -(-size // 8)
        assert size == 1


def test_a_lost_node_is_noticed(spark):
    rows = [(i, "s", "a", i, f"Text {i}") for i in range(100)]
    made = proved(spark.createDataFrame(rows, FIELDS))
    forged = merkle.Manifest(made.leaves, made.nodes, made.trees, b"\x00" * 32, made.n_trees)
    with pytest.raises(Exception, match="don't give the root"):
        merkle.proofs(forged).collect()


def test_odd_rows(spark):
    docs = odd(spark).withColumn("n_chars", F.length("text").cast("long"))
    rows = [(r.doc_id, r.source, r.lang, r.n_chars, r.text) for r in docs.collect()]
    same(merkle.proofs(proved(docs)).collect(), brute(rows))


def test_empty(spark):
    made = merkle.proofs(proved(empty(spark).withColumn("n_chars", F.lit(1).cast("long"))))
    assert made.collect() == [] and made.columns == ["id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
