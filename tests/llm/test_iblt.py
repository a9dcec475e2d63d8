import hashlib
import random
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from tests.llm.frames import documents, empty, odd, prose
from tickfold.llm import iblt


def counted(text: str) -> Counter:
    """Paragraph digests of one text alone, repeats numbered."""
    return Counter(iblt.paragraphs([text.encode()])[1].tolist())


def dice(a: str, b: str) -> float:
    x, y = counted(a), counted(b)
    both = sum(x.values()) + sum(y.values())
    return 1 - (sum((x - y).values()) + sum((y - x).values())) / max(both, 1)


def brute(rows):
    rows = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0)))
    out = []
    for i, (doc_id, text) in enumerate(rows):
        text, after = text or "", rows[(i + 1) % len(rows)][1] or ""
        half = len(text) // 2
        new = text[: len(text) - half] + after[:half]
        out.append((doc_id, len(text), hashlib.sha256(new.encode()).hexdigest(), round(dice(text, new), 9), round(dice(text, after), 9)))
    return sorted(out)


def check(docs):
    got = iblt.fingerprints(docs).collect()
    want = brute([(r.doc_id, r.text) for r in docs.collect()])
    assert sorted((r.id, r.n_chars, r.edited_sha256, round(r.near_edited, 9), round(r.near_next, 9)) for r in got) == want
    return got


def test_equals_brute_force(spark):
    texts = ["\n".join(prose(17 * i + k, 5 + (i * k) % 90) for k in range(i % 9)) for i in range(150)]
    texts[40:44] = [texts[39]] * 4
    texts += [prose(1, 30_000), "one", "", "line\n" * 500]
    got = check(documents(spark, texts).repartition(6))
    prints = {}
    for r in got:
        assert prints.setdefault(texts[r.id], r.fingerprint) == r.fingerprint
    assert len(set(prints.values())) == len(prints)
    whole = [r for r in got if r.n_chars > 400]
    assert np.mean([r.near_edited for r in whole]) > 0.35 and np.mean([r.near_next for r in whole]) < 0.1


def test_paragraphs_depend_on_their_text_alone():
    texts = [prose(i, 3 + 7 * i).encode() for i in range(40)] + [b"", b"a", b"\n\n", b"a b\nc"]
    owner, keys = iblt.paragraphs(texts)
    assert (np.diff(owner) >= 0).all()
    for i, text in enumerate(texts):
        assert keys[owner == i].tolist() == iblt.paragraphs([text])[1].tolist()
    # an edit at the end leaves the paragraphs before it
    long = prose(5, 2000)
    a, b = counted(long), counted(long[:-30] + "other words")
    assert sum((a - b).values()) <= 4


def test_peeling_recovers_the_differing_digests():
    draw = random.Random(2)
    left, right, want = [], [], set()
    for pair in range(60):
        common = {draw.getrandbits(64) for _ in range(draw.randrange(300))}
        own = {draw.getrandbits(64) for _ in range(draw.choice([0, 1, 5, 400]))}
        other = {draw.getrandbits(64) for _ in range(draw.choice([0, 2, 30]))}
        left += [(pair, k) for k in common | own]
        right += [(pair, k) for k in common | other]
        want |= {(pair, k, 1) for k in own} | {(pair, k, -1) for k in other}
    side = lambda rows: (np.array([r[0] for r in rows]), np.array([r[1] for r in rows], np.uint64))
    owner, keys, sign = iblt.differing(60, side(left), side(right))
    assert sorted(zip(owner.tolist(), keys.tolist(), sign.tolist())) == sorted(want)


def test_a_small_sketch_fails_and_says_so():
    keys = np.arange(200, dtype=np.uint64)
    tables = iblt.sketch(1, np.zeros(200, np.int64), keys)
    assert not tables.peel()[3][0]
    few = iblt.sketch(1, np.zeros(5, np.int64), keys[:5])
    owner, found, sign, done = few.peel()
    assert done[0] and sorted(found.tolist()) == list(range(5)) and (sign == 1).all()


def test_odd_rows(spark):
    docs = odd(spark)
    got = iblt.fingerprints(docs).collect()
    assert Counter(r.id for r in got) == Counter(r.doc_id for r in docs.collect())
    # rows with an id of their own have a known successor; equal ids may come in either order
    rows = {r.doc_id: r.text or "" for r in docs.collect()}
    for r in got:
        if r.id in (2, 3, 4, 7, 8):
            text, after = rows[r.id], rows[r.id - 1]
            half = len(text) // 2
            assert r.edited_sha256 == hashlib.sha256((text[: len(text) - half] + after[:half]).encode()).hexdigest()
    same = [r for r in got if r.id == 5]
    assert same[0].fingerprint == same[1].fingerprint and 1.0 in {r.near_next for r in same}


def test_one_row_and_none(spark):
    check(documents(spark, [prose(1, 300)]))
    check(documents(spark, [None]))
    assert iblt.fingerprints(empty(spark)).collect() == []


def test_many_partitions_meet(spark):
    docs = documents(spark, [prose(i, 40) for i in range(60)]).repartition(3)
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        check(docs.withColumn("text", F.col("text")))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
