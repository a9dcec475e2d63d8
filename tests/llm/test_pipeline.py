import random

import pytest

import __spark_entry__
import corpus_pipeline
from tests.llm.frames import prose
from tests.llm.test_minhash import brute
from tickfold.llm import bpe, decontam, toxicity



@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Prose with toxic documents, a repeated line, near copies and benchmark leaks."""
    draw, rows, labels = random.Random(1), [], []
    items = [(k, prose(9000 + k, 30)) for k in range(5)]
    for i in range(400):
        words = prose(i, 70).split()
        if toxic := i % 8 == 0:
            for _ in range(3):
                words.insert(draw.randrange(len(words)), draw.choice(["blarg", "snorfle"]))
        text = " ".join(words)
        if i % 5 == 1:
            text += "\nAll rights reserved by the owners of this page"
        if i % 50 == 3:
            text += " " + items[i % 5][1]
        rows.append((i, text, "en", f"s{i % 3}", len(text)))
        if i % 2 == 0:
            labels.append((i, 1, int(toxic)))
    for i in range(400, 440):
        _, text, *_ = rows[i - 398]
        text = text.replace(" the ", " a ", 1) if i % 2 else text
        rows.append((i, text, "en", "s0", len(text)))
    rows += [(440, None, None, None, None), (441, "", "en", "s0", 0), (None, "no id", None, None, 5)]
    out = str(tmp_path_factory.mktemp("corpus"))
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, schema).repartition(3).write.parquet(f"{out}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{out}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{out}/benchmark.parquet")
    return out


def test_stages_equal_brute_force(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    steps = {}
    for name, step in corpus_pipeline.STAGES:
        before = docs
        docs = step(spark, docs, folder)
        path = f"{folder}/{name}"
        docs.write.parquet(path)
        docs = steps[name] = spark.read.parquet(path)
        if name != "byte_bpe":
            assert docs.dtypes == before.dtypes
    texts = {name: {r.doc_id: r.text for r in df.collect()} for name, df in steps.items()}
    whole = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    # toxic documents are those with the two words, and no other
    bad = {i for i, t in whole.items() if any(w in ("blarg", "snorfle") for w in (t or "").split())}
    assert texts["toxicity"].keys() == whole.keys() - bad
    assert texts["line_dedup"].keys() == texts["toxicity"].keys()
    assert sum("All rights" in (t or "") for t in texts["line_dedup"].values()) < sum("All rights" in (t or "") for t in texts["toxicity"].values()) / 2
    order = sorted(texts["line_dedup"], key=lambda i: (i is None, i or 0))
    labels = brute([texts["line_dedup"][i] for i in order])
    assert texts["near_dedup"].keys() == {order[k] for k in set(labels)}
    windows = [t for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect() for t in [decontam.words(r.text)]]
    grams = {tuple(w[i : i + 10]) for w in windows for i in range(len(w) - 9)}
    clean = {i for i, t in texts["near_dedup"].items() if not any(tuple(w[k : k + 10]) in grams for w in [decontam.words(t or "")] for k in range(len(w)))}
    assert texts["decontamination"].keys() == clean and len(clean) < len(texts["near_dedup"])
    last = steps["byte_bpe"].collect()
    vocabulary = bpe.vocabulary_of(bpe.read_ranks(corpus_pipeline.RANKS))
    assert {r.doc_id for r in last} == clean
    assert all(bpe.decode_ids(r.ids, vocabulary).decode() == (r.text or "") for r in last)
    rerun = corpus_pipeline.run(spark, folder)
    assert sorted((r.doc_id is None, r.doc_id or 0, r.ids) for r in rerun.collect()) == sorted((r.doc_id is None, r.doc_id or 0, r.ids) for r in last)
    assert all(r.n_chars == len(r.text) for r in steps["line_dedup"].collect() if r.text is not None)


def test_registered():
    names = __spark_entry__.queries()
    assert "pipeline" in names and [n for n in names if n.startswith("op")] and len([n for n in names if n[:2] == "op" and n[2].isdigit()]) == 13
    assert [n.split("_")[0] for n in names if n[:2] == "op" and n[2].isdigit()] == [f"op{i}" for i in range(1, 14)]
    assert corpus_pipeline.ORACLE_SQL is None and toxicity.CUT == 0.3
