import math
import re
from collections import Counter

import xxhash

from tests.llm.frames import empty, odd, odd_rows, prose
from tickfold.llm import llr

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def hashed(value, seed=42):
    data = value.encode() if isinstance(value, str) else (value & (1 << 64) - 1).to_bytes(8, "little")
    out = xxhash.xxh64_intdigest(data, seed)
    return out - (1 << 64) if out >> 63 else out


def buckets(text):
    words = [hashed(w) for w in WORD.findall(text or "")]
    pairs = [hashed(b, hashed(a) & (1 << 64) - 1) for a, b in zip(words, words[1:])]
    return [g % llr.BUCKETS for g in words + pairs]


def base(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    covered = {j for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for j in range(i, i + 3)}
    return len(words), sum(map(len, words)), sum(text.count(c) for c in llr.SYMBOLS), len(lines) - len(set(lines)), len(covered)


def texts():
    good = [prose(i, 80 + i) for i in range(20)]
    bad = [" ".join(f"{w}%%%" for w in prose(50 + i, 90).split()) for i in range(10)]
    repeated = ["again and again and again " * 30, "a\nb\na\n \n\nb\n", "x | y <z> #1\tq\x0b\x0cr s"]
    return [*good, *bad, *repeated, prose(99, 49), prose(98, 50)]


def test_counts_ratio_and_verdict_equal_brute_force(spark):
    rows = list(enumerate(texts()))
    trusted = set(range(20))
    ids = spark.createDataFrame([(i,) for i in trusted] * 2 + [(None,)], "doc_id long")
    raw = Counter(b for _, t in rows for b in buckets(t))
    good = Counter(b for i, t in rows if i in trusted for b in buckets(t))
    ratio = [
        round(math.log((good[b] + 1) / (good.total() + llr.BUCKETS)) - math.log((raw[b] + 1) / (raw.total() + llr.BUCKETS)), 6)
        for b in range(llr.BUCKETS)
    ]
    got = {r.doc_id: r for r in llr.quality_rules(spark.createDataFrame(rows, "doc_id long, text string"), ids).collect()}
    for i, text in rows:
        r, want, grams = got[i], base(text), buckets(text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        mean = sum(ratio[b] for b in grams) / len(grams)
        assert math.isclose(r.log_ratio, mean, abs_tol=1e-9)
        failed = want[0] < 50 or 100 * want[4] > 50 * want[0]
        assert (r.base_failed, r.kept) == (failed, not failed and mean >= llr.THRESHOLD)
    assert all(got[i].kept for i in range(20)) and not any(got[i].kept for i in range(20, 33))


def test_odd_rows(spark):
    docs = odd(spark)
    ids = spark.createDataFrame([(4,), (None,)], "doc_id long")
    out = llr.quality_rules(docs, ids, keep=docs.columns)
    assert out.columns[: len(docs.columns)] == docs.columns
    rows = out.collect()
    assert len(rows) == len(odd_rows())
    for r in rows:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == base(r.text)
    assert llr.quality_rules(empty(spark), ids).count() == 0
    untrusted = llr.quality_rules(docs, ids.limit(0)).collect()
    assert {r.log_ratio for r in untrusted} == {0.0}


def test_no_python_in_the_plan(spark):
    plan = llr.measures(odd(spark), [0.0] * llr.BUCKETS)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
