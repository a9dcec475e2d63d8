import math
from collections import Counter

import numpy as np

from tests.llm.frames import documents, empty, odd, odd_rows, prose
from tickfold.llm import suffix_tree as tree


def base(train, text):
    counts = Counter(w for t in train for w in [*tree.words(t or ""), b"\n"])
    n, v = counts.total(), len(counts)
    own = [*tree.words(text or ""), b"\n"]
    score = math.fsum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in own)
    return len(own), sum(counts[w] > 0 for w in own), n, score


def grown(texts):
    keys, counts = np.unique(tree.grams(tree.stream([tree.words(t) for t in texts])), return_counts=True)
    import pyarrow as pa

    total, rows = counts.sum(), Counter()
    for key, n in zip(keys.tolist(), counts.tolist()):
        for k in range(tree.DEPTH + 1):
            context = key >> 8 & (1 << 8 * k) - 1
            if not k or context >> 8 * (k - 1):
                rows[k, context, key & 255] += n
    whole = Counter()
    for (k, c, _), n in rows.items():
        whole[k, c] += n
    least = max(2, math.ceil(tree.MIN_SHARE * total))
    kept = [(k, c, s, n) for (k, c, s), n in rows.items() if whole[k, c] >= least]
    return tree.grow(pa.table(dict(zip(("k", "c", "s", "n"), zip(*kept)))))


def test_every_state_is_a_distribution_over_bytes():
    model = grown([prose(i, 300) for i in range(30)])
    assert len(model.log10) > 50
    sums = (10.0 ** model.log10[:, model.column].astype(float)).sum(1)
    assert np.allclose(sums, 1, atol=1e-4)


def test_longest_suffix_by_hand():
    """The automaton's scores equal a search for the longest kept suffix, byte by byte, across block borders."""
    model = grown([prose(i, 200) for i in range(10)])
    names = {b"": 0}
    todo = [b""]
    while todo:  # states by their bytes
        name = todo.pop()
        for symbol in range(256):
            child = int(model.following[names[name], model.column[symbol]])
            longer = name + bytes([symbol])
            if child and longer not in names and child not in names.values() and model.column[symbol] < len(model.log10[0]) - 1:
                names[longer] = child
                todo.append(longer)
    data = tree.stream([tree.words(prose(77, 400)), [], tree.words("é unseen Ω")])
    fast = tree.byte_scores(data, model)
    state, slow = int(model.following[0, model.column[tree.END]]), []
    for byte in data.tolist():
        slow.append(model.log10[state, model.column[byte]])
        state = int(model.following[state, model.column[byte]])
    assert np.allclose(fast, slow)


def test_scores_equal_brute_force(spark):
    train = [prose(i, 120) for i in range(60)] + ["", None]
    test = [prose(900 + i, 80) for i in range(20)] + ["", None, "THE the", "zzz unseen qqq"]
    whole = documents(spark, train + test)
    rows = tree.scores(whole, whole.filter(f"doc_id < {len(train)}")).orderBy("doc_id").collect()
    model = grown([t or "" for t in train])
    for r, text in zip(rows, train + test):
        n, known, total, score = base(train, text)
        assert (r.n_tokens, r.n_known, r.train_tokens) == (n, known, total)
        assert math.isclose(r.base_score, score, rel_tol=1e-9)
        assert math.isclose(r.score, tree.text_scores([tree.words(text or "")], model)[0], rel_tol=1e-3, abs_tol=1e-3)


def test_held_out_documents_are_likelier_than_by_their_counts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    held = tree.scores(docs, docs.filter("doc_id % 9 > 0")).filter("doc_id % 9 = 0").collect()
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_rare_words_meet_in_the_join(spark, monkeypatch):
    monkeypatch.setattr(tree, "HEAVY_SHARE", 0.02)
    train = [prose(i, 50) for i in range(30)]
    docs = documents(spark, train)
    for r, text in zip(tree.scores(docs, docs).orderBy("doc_id").collect(), train):
        n, known, _, score = base(train, text)
        assert (r.n_tokens, r.n_known) == (n, known) and math.isclose(r.base_score, score, rel_tol=1e-9)


def test_odd_rows(spark):
    docs = odd(spark)
    rows = tree.scores(docs, docs.filter("doc_id < 5")).collect()
    assert len(rows) == len(odd_rows()) and all(r.score <= 0 for r in rows)
    assert tree.scores(empty(spark), docs).count() == 0
    untrained = tree.scores(docs, empty(spark)).collect()
    assert {r.train_tokens for r in untrained} == {0} and {r.n_known for r in untrained} == {0}
