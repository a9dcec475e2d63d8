import random

from tests.llm.frames import empty, odd, odd_rows, prose
from tickfold.llm import cotrain

DOCS = "doc_id long, text string, lang string, source string"


def corpus(n, first=0):
    rows, labels = [], []
    for i in range(first, first + n):
        draw, good = random.Random(i), i % 3 > 0
        words = prose(i, 80).split()
        if not good:
            words = [w + ("%%" if draw.random() < 0.8 else "") for w in words]
        rows.append((i, " ".join(words), "en", f"src{draw.randrange(5) if good else 7}"))
        labels.append((i, int(good)))
    return rows, labels


def accuracy(rows, labels, column):
    truth = dict(labels)
    return sum((r[column] >= 0.5) == truth[r.doc_id] for r in rows) / len(rows)


def test_few_labels_and_a_pool(spark):
    rows, labels = corpus(600)
    docs = spark.createDataFrame(rows, DOCS)
    model = cotrain.fit(docs, spark.createDataFrame(labels[:120], "doc_id long, quality int"))
    more, truth = corpus(200, 1000)
    scored = cotrain.scores(spark.createDataFrame(more, DOCS), model).collect()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in scored)
    assert min(accuracy(scored, truth, c) for c in ("score", "text_score", "meta_score")) > 0.95


def test_pseudo_labels_go_to_the_other_view(spark):
    rows, labels = corpus(300)
    docs = spark.createDataFrame(rows, DOCS)
    sample = cotrain.sample(docs, spark.createDataFrame(labels[:100], "doc_id long, quality int"), "quality")
    text, meta = cotrain.counts(sample, None)
    first, _ = cotrain.calibrated(sample, (cotrain.weights(text), cotrain.weights(meta)))
    more_text, more_meta = cotrain.counts(sample, first)
    assert more_text.sum() > text.sum() and more_meta.sum() > meta.sum()
    # a view that is sure of nothing teaches the other nothing
    mute = first._replace(meta=first.meta._replace(slope=0.0, shift=0.0))
    same_text, still_more = cotrain.counts(sample, mute)
    assert (same_text == text).all() and (still_more == more_meta).all()


def test_counts_equal_brute_force(spark):
    """True labels count 1; confident rows of the other view count, scaled by class to a share of the true ones."""
    import numpy as np

    rows, labels = corpus(300)
    docs = spark.createDataFrame(rows, DOCS)
    sample = cotrain.sample(docs, spark.createDataFrame(labels[:60], "doc_id long, quality int"), "quality")
    model, _ = cotrain.calibrated(sample, tuple(map(cotrain.weights, cotrain.counts(sample, None))))
    got = cotrain.counts(sample, model)
    for view, size in enumerate((cotrain.WORD_BUCKETS, cotrain.META_BUCKETS)):
        tables, held = np.zeros((2, 2, size)), np.zeros((2, 2))
        for r in sample.filter("NOT back").collect():
            teacher = (model.meta.logit(r.meta), model.text.logit(r.words))[view]
            p = cotrain.sigmoid(teacher)
            label = r.label if r.label is not None else 1 if p >= cotrain.CONFIDENT else 0 if p <= 1 - cotrain.CONFIDENT else None
            if label is not None:
                kind = int(r.label is None)
                held[kind, label] += 1
                for b in (set(r.words), r.meta)[view]:
                    tables[kind, label, b] += 1
        scale = np.minimum(1, cotrain.PSEUDO_SHARE * held[0] / np.maximum(held[1], 1))
        assert held[1].sum() > 100 and np.allclose(got[view], tables[0] + tables[1] * scale[:, None])


def test_rounds_do_no_harm(spark):
    """On labels kept out of fitting, three rounds are no worse than one."""
    from tickfold.llm.common import fold_of, table

    folder = "/root/testdata/sf0.01"
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    held = {r.doc_id: r.quality for r in labels.filter(fold_of("doc_id", 4) == 2).collect()}
    right = []
    for rounds in (1, 3):
        model = cotrain.fit(docs, labels.filter(fold_of("doc_id", 4) != 2), rounds=rounds)
        assert min(model.combined[:2]) >= 0
        scored = cotrain.scores(docs, model, keep=["doc_id"]).collect()
        right.append(sum(r.predicted == held[r.doc_id] for r in scored if r.doc_id in held))
    assert right[1] >= right[0] - 1


def test_odd_rows(spark):
    rows, labels = corpus(200)
    labels = spark.createDataFrame([*labels, (None, 1), (3, None)], "doc_id long, quality int")
    model = cotrain.fit(spark.createDataFrame(rows, DOCS), labels)
    docs = odd(spark)
    out = cotrain.scores(docs, model)
    assert out.count() == len(odd_rows()) and len(set(out.columns)) == len(out.columns)
    assert cotrain.scores(empty(spark), model).count() == 0
    unlabelled = cotrain.fit(docs, labels.limit(0))
    assert {r.score for r in cotrain.scores(docs, unlabelled).collect()} == {0.5}
    assert cotrain.fit(empty(spark), labels).combined[:2] == (0.0, 0.0)


def test_every_unlabelled_document_is_in_the_pool(spark, monkeypatch):
    monkeypatch.setattr(cotrain, "MAX_POOL", 20, raising=False)
    rows, labels = corpus(300)
    docs = spark.createDataFrame([*rows, (None, "without an id", "en", "s")], DOCS)
    sample = cotrain.sample(docs, spark.createDataFrame(labels[:100], "doc_id long, quality int"), "quality")
    assert sample.filter("label IS NULL").count() == 201 and sample.filter("label IS NOT NULL").count() == 100
