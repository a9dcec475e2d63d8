import random

import numpy as np

from tests.llm.frames import documents, empty, odd
from tickfold.llm import decontam


def brute(text, items, window):
    found = decontam.words(text or "")
    hit, names = [0] * len(found), set()
    for name, item in items:
        own = decontam.words(item or "")
        n = min(window, len(own))
        windows = {tuple(own[i : i + n]) for i in range(len(own) - n + 1)} if n else set()
        for i in range(len(found) - n + 1 if n else 0):
            if tuple(found[i : i + n]) in windows:
                names.add("" if name is None else str(name))
                hit[i : i + n] = [1] * n
    return len(found), sum(hit), sorted(names)


def test_marks_equal_brute_force():
    draw = random.Random(3)
    for _ in range(60):
        vocabulary = ["a", "b", "Cc", "dé", "e1"]
        items = [(str(i), " ".join(draw.choices(vocabulary, k=draw.choice([0, 1, 3, 9, 10, 11, 14])))) for i in range(6)]
        docs = [" ".join(draw.choices([*vocabulary, "zz"], k=draw.randint(0, 60))) for _ in range(5)]
        docs.append(" zz ".join(t for _, t in items))
        parts = [decontam.block_of([(n, decontam.words(t)) for n, t in own], 10) for own in (items[:3], items[3:])]
        marks = decontam.mark([decontam.words(x) for x in docs], parts)
        got = list(zip(marks.words.tolist(), marks.hit.tolist(), map(sorted, marks.items)))
        assert got == [brute(d, items, 10) for d in docs]


def test_a_repeated_word_is_expanded_once():
    """An item of equal words against a document of the same word: places grow with the document, not with the product."""
    import tracemalloc

    found = [["w"] * 200_000, ["w"] * 50 + ["x"], ["y"]]
    found = [[w.encode() for w in own] for own in found]
    block = decontam.block_of([("1", [b"w"] * 2000), ("2", [b"w"] * 11), ("3", [b"w", b"x"])], 10)
    tracemalloc.start()
    marks = decontam.mark(found, [block])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert marks.hit.tolist() == [200_000, 51, 0] and [sorted(x) for x in marks.items] == [["1", "2"], ["1", "2", "3"], []]
    assert peak < 150e6


def test_suffix_array_orders_suffixes():
    draw = random.Random(4)
    flat = np.array([draw.randrange(3) for _ in range(200)])
    assert decontam.suffix_array(flat, 200).tolist() == sorted(range(200), key=lambda i: flat[i:].tolist())


def test_table_with_odd_rows(spark):
    items = [(1, "no id here"), (2, None), (None, "text é"), (3, ""), (1, "no id here"), (4, " ".join("the of and to in is it on for was".split()))]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    docs = odd(spark)
    out = decontam.contamination(docs, benchmark).collect()
    assert len(out) == docs.count()
    for row, text in zip(sorted(out, key=lambda r: (r.doc_id or 0, r.text or "")), sorted(docs.collect(), key=lambda r: (r.doc_id or 0, r.text or ""))):
        assert (row.n_words, row.n_hit, row.asDict()["items"]) == brute(text.text, items, 10)
    kept = decontam.decontaminate(docs, benchmark)
    assert kept.columns == docs.columns and kept.count() == 9
    assert decontam.decontaminate(empty(spark), benchmark).count() == 0
    assert decontam.decontaminate(docs, benchmark.limit(0)).count() == docs.count()


def test_several_blocks_find_the_same(spark, monkeypatch):
    draw = random.Random(8)
    items = [(i, " ".join(draw.choices("abcdef", k=12))) for i in range(20)]
    docs = documents(spark, [" ".join(draw.choices("abcdef", k=8)) + " " + draw.choice(items)[1] for _ in range(10)])
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    whole = decontam.contamination(docs, benchmark).orderBy("doc_id").collect()
    monkeypatch.setattr(decontam, "BLOCK_WORDS", 30)
    assert len(decontam.blocks(benchmark, "item_id", "text", 10)) > 5
    assert decontam.contamination(docs, benchmark).orderBy("doc_id").collect() == whole


def test_odd_rows_in_several_passes(spark, monkeypatch):
    """Passes are put together by row: repeated and null ids stay apart, windows of two blocks may overlap in a text."""
    items = [(i, t) for i, t in enumerate(("one two three", "two three four five", "no such words", "five", None, "", "three four"))]
    benchmark = spark.createDataFrame(items, "item_id long, text string").repartition(1)
    docs = odd(spark).unionByName(documents(spark, ["one two three four five six", "ONE two three", "three four"]), allowMissingColumns=True)
    monkeypatch.setattr(decontam, "BLOCK_WORDS", 4)
    assert len(decontam.blocks(benchmark, "item_id", "text", 3)) > 3
    out = decontam.contamination(docs, benchmark, window=3).collect()
    order = lambda r: (r.text or "", r.text is None, r.doc_id is None, r.doc_id or 0)
    rows = sorted(docs.collect(), key=order)
    assert len(out) == len(rows)
    for row, text in zip(sorted(out, key=order), rows):
        assert (row.n_words, row.n_hit, row.asDict()["items"]) == brute(text.text, items, 3)
    assert decontam.contamination(empty(spark), benchmark, window=3).count() == 0


def test_longest_matches_equal_brute_force(spark):
    draw = random.Random(9)
    items = [(i, " ".join(draw.choices("abc", k=9))) for i in range(6)]
    texts = [" ".join(draw.choices("abcd", k=40)) for _ in range(12)]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = decontam.longest_matches(documents(spark, texts), benchmark, least=3).collect()
    found = {(r.item_id, r.item_word): r for r in got}
    for name, item in items:
        own = item.split()
        for i in range(len(own)):
            best = max((n for t in texts for n in range(3, len(own) - i + 1) if f" {' '.join(own[i : i + n])} " in f" {t} "), default=0)
            row = found.get((str(name), i))
            assert (row.length if row else 0) == best
            if row:
                assert texts[row.doc_id].split()[row.doc_word : row.doc_word + best] == own[i : i + best]
