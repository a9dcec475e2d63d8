import random

import numpy as np

from tests.llm.frames import documents, empty, odd, prose
from tickfold.llm import minhash


def bag(text):
    return minhash._multiset(minhash.words(text), minhash.WordHashes())


def brute(texts):
    """Smallest index of each text's component of links."""
    bags = [bag(t) if t and minhash.words(t) else None for t in texts]
    label = list(range(len(texts)))
    for j in range(len(texts)):
        for i in range(j):
            linked = minhash.jaccard(bags[i], bags[j]) >= 0.8 if bags[i] and bags[j] else bool(texts[i]) and texts[i] == texts[j]
            if linked and label[i] != label[j]:
                low, high = sorted((label[i], label[j]))
                label = [low if x == high else x for x in label]
    return label


def test_signatures_are_unbiased():
    draw = random.Random(2)
    cache, errors, spread = minhash.WordHashes(), [], []
    for _ in range(80):
        one = [draw.choice("abcdefghijklmnop") for _ in range(draw.choice([8, 40, 200]))]
        two = list(one)
        for _ in range(draw.randint(0, len(two) // 4)):
            two[draw.randrange(len(two))] = draw.choice("abcxyz")
        if draw.random() < 0.4:
            one, two = one * 3, two * draw.choice([1, 2, 3, 4])
        doc, value, count = minhash.shingles([minhash.words(" ".join(x)) for x in (one, two)], cache)
        a, b = minhash.signatures(doc, value, count, 2)
        true = minhash.jaccard(bag(" ".join(one)), bag(" ".join(two)))
        errors.append((a == b).mean() - true)
        spread.append(true * (1 - true) / minhash.SLOTS)
    assert abs(np.mean(errors)) < 4 * np.sqrt(np.mean(spread) / len(errors))
    assert np.mean(np.square(errors)) < 2 * np.mean(spread)


def one_by_one(value, count, weight):
    """A signature drawn point by point in plain Python."""
    slots, best, limit = [0] * minhash.SLOTS, [np.inf] * minhash.SLOTS, 8.0 / weight
    while np.inf in best:
        best = [np.inf] * minhash.SLOTS
        for v, c in zip(value, count):
            low, high = 0, 1
            while c > low:
                seed = minhash.mix(np.array([v]) + np.uint64(int(minhash._A) * high & minhash.MASK))
                time, step = 0.0, 0
                while True:
                    step += 1
                    bits = minhash.mix(seed + np.uint64(int(minhash._C) * step & minhash.MASK))
                    time -= np.log(minhash.uniform(bits))[0] / (minhash.SLOTS * (high - low))
                    if time > limit:
                        break
                    mark = minhash.mix(bits)
                    slot = int(mark[0] % np.uint64(minhash.SLOTS))
                    level = low + 1 + int(minhash.mix(mark)[0] % np.uint64(high - low)) if high > 1 else 1
                    if level <= c and time < best[slot]:
                        best[slot], slots[slot] = time, int(mark[0])
                low, high = high, high * 2
        limit *= 2
    return slots


def test_signatures_are_those_of_single_points(monkeypatch):
    texts = ["a", "one two three", "x " * 40, prose(1, 7), prose(2, 30) + " " + "again and again " * 9]
    doc, value, count = minhash.shingles([minhash.words(t) for t in texts], minhash.WordHashes())
    expected = [one_by_one(value[doc == i], count[doc == i].tolist(), int(count[doc == i].sum())) for i in range(len(texts))]
    for points in (1, 50, minhash.POINTS):
        monkeypatch.setattr(minhash, "POINTS", points)
        assert minhash.signatures(doc, value, count, len(texts)).tolist() == expected


def test_short_texts_take_few_turns(monkeypatch):
    """A text of one shingle needs some 1,440 points: they are drawn side by side, not in a turn each."""
    calls, mix = [], minhash.mix
    doc, value, count = minhash.shingles([[w] for w in (b"a", b"b", b"c")], minhash.WordHashes())
    monkeypatch.setattr(minhash, "mix", lambda x: calls.append(len(x)) or mix(x))
    minhash.signatures(doc, value, count, 3)
    assert len(calls) < 200


def edited(text, seed, edits):
    draw, own = random.Random(seed), text.split()
    for _ in range(edits):
        own[draw.randrange(len(own))] = f"edit{draw.randrange(1000)}"
    return " ".join(own)


def corpus():
    texts = []
    for k in range(6):
        base = prose(k, 150)
        texts += [base, base.upper(), *(edited(base, s, 1 + s % 4) for s in range(12))]
    texts += [prose(100 + k, 120) for k in range(15)]
    # a chain: each a near copy of the one before, its ends far apart
    chain = [prose(200, 200)]
    for s in range(6):
        chain.append(edited(chain[-1], 300 + s, 3))
    # many texts that share a passage, but are no near copies
    passage = prose(400, 120)
    texts += chain + [f"{passage} {prose(500 + k, 60)}" for k in range(70)]
    return [*texts, "one two", "one two", "One, two!", "", "", None, "???", "???"]


def test_classes_equal_brute_force(spark):
    texts = corpus()
    rows, _, cls, flag = minhash.classes(documents(spark, texts))
    got = {r["doc_id"]: r for r in rows.collect()}
    want = brute(texts)
    assert [got[i][cls] for i in range(len(texts))] == want
    assert [i for i in range(len(texts)) if got[i][flag]] == sorted(set(want))


def test_large_buckets_of_different_texts(spark, monkeypatch):
    """Buckets above the limit meet by rare shingles and lose no link."""
    monkeypatch.setattr(minhash, "FULL", 3)  # pairs
    texts = corpus()
    rows, _, cls, _ = minhash.classes(documents(spark, texts))
    assert [r[cls] for r in rows.orderBy("doc_id").collect()] == brute(texts)


def test_prefixes_meet_at_the_threshold(spark):
    """Every pair at the threshold shares a shingle of its prefixes; repeated shingles count."""
    texts = corpus()[:100] + [f"{prose(900, 30)} " * 4, f"{prose(900, 30)} " * 5, prose(901, 8)]
    held = [(i, t) for i, t in enumerate(texts) if t and minhash.words(t)]
    rows = minhash.rare_shingles(spark.createDataFrame(held, "node long, text string"), 0.8).collect()
    prefix = {}
    for r in rows:
        prefix.setdefault(r.node, {})[r.bucket] = r.before
    bags = {i: bag(t) for i, t in held}
    met = 0
    for i in bags:
        for j in bags:
            if i < j and minhash.words(texts[i]) != minhash.words(texts[j]) and minhash.jaccard(bags[i], bags[j]) >= 0.8:
                met += 1
                whole = [sum(bags[k][1]) for k in (i, j)]
                shared = 0.8 / 1.8 * sum(whole) - 1e-6
                common = prefix[i].keys() & prefix[j].keys()
                assert any(prefix[i][s] + shared <= whole[0] and prefix[j][s] + shared <= whole[1] for s in common)
    assert met > 50
    assert sum(map(len, prefix.values())) < 0.3 * sum(len(b[0]) for b in bags.values())


def test_weights_rule_out_only_what_they_must(spark):
    pairs = [(a, b) for a in range(1, 60) for b in range(1, 60)]
    df = spark.createDataFrame(pairs, "weight int, other int")
    near = df.select("weight", "other", minhash.weight_class(0.8).alias("x"), minhash.near_weights(0.8, "weight", "other").alias("near"))
    of = {r.weight: r.x for r in near.collect()}
    for r in near.collect():
        assert r.near == (5 * min(r.weight, r.other) >= 4 * max(r.weight, r.other))
        assert not r.near or abs(of[r.weight] - of[r.other]) <= 1


def test_bits_rule_out_unlike_pairs_alone(spark):
    texts = corpus()[:100]
    held = minhash._prepared(documents(spark, texts), "text").filter("bits IS NOT NULL").select("doc_id", "bits").collect()
    pairs = [(x.doc_id, y.doc_id, x.bits, y.bits) for x in held for y in held if x.doc_id < y.doc_id]
    df = spark.createDataFrame(pairs, "i int, j int, ba array<long>, bb array<long>")
    passed = {(r.i, r.j) for r in df.filter(minhash.near_bits(0.8)).select("i", "j").collect()}
    bags, far = {r.doc_id: bag(texts[r.doc_id]) for r in held}, 0
    for i, j, _, _ in pairs:
        similar = minhash.jaccard(bags[i], bags[j])
        assert similar < 0.8 or (i, j) in passed
        far += similar < 0.3 and (i, j) in passed
    assert far < 0.02 * len(pairs)


def test_marks_of_unlike_texts_rarely_agree():
    texts = [minhash.words(prose(i, 150, [f"w{i}x{k}" for k in range(80)])) for i in range(30)]
    doc, value, count = minhash.shingles(texts, minhash.WordHashes())
    high = minhash.signatures(doc, value, count, len(texts)) >> np.uint64(56)
    agree = np.mean([(high[i] == high[j]).mean() for i in range(30) for j in range(i)])
    assert agree < 0.01


def test_odd_rows(spark):
    docs = odd(spark)
    kept = minhash.deduplicate(docs)
    assert kept.columns == docs.columns
    # the three rows of the long text are one, everything else stays
    assert kept.count() == docs.count() - 2
    assert sorted(r.doc_id for r in kept.filter("length(text) > 60000").collect()) == [4]
    assert minhash.deduplicate(empty(spark)).count() == 0
