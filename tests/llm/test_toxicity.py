import random

import pytest

from tests.llm.frames import empty, odd, odd_rows, prose
from tickfold.llm import toxicity
from tickfold.llm.toxicity import Lexicon, Matcher, fold


@pytest.mark.parametrize(
    ("text", "folded"),
    [
        ("M0R0N", "moron"),
        ("іdiоt", "idiot"),  # Cyrillic letters
        ("ｓｃｕｍ", "scum"),
        ("tra​sh", "trash"),
        ("1d1ot 2024 A4 x86", "idiot 2024 a4 x86"),
        ("costs 50 $ & %", "costs 50 $ & %"),
        ("", ""),
    ],
)
def test_fold(text, folded):
    assert fold(text) == folded


def test_matches_bounds_and_exceptions():
    matcher = Matcher(Lexicon({"^clown$": 2.0, "^idi": 3.0, "less$": 1.0}, frozenset({"clown fish"}), 1.0, 0.0))
    found = matcher.hits("a clown fish, a clown! clowns idiotic useless lessons xidi")
    assert [(a, w) for a, _, w in sorted(found)] == [(16, 2.0), (30, 3.0), (41, 1.0)]
    assert matcher.evidence("clown fish") == 0 and matcher.evidence("clown") > matcher.evidence("clown " + "word " * 100)
    assert Matcher(Lexicon({}, frozenset(), 0, 0)).score(0.0) == 0.0


def labelled(n, first=0):
    """Toxic texts hold a bad word, sometimes disguised; a harmless phrase holds one too."""
    rows, draw = [], random.Random(first)
    for i in range(first, first + n):
        words = prose(i, 60).split()
        toxic = i % 4 == 0
        if toxic:
            for _ in range(2):
                words.insert(draw.randrange(len(words)), draw.choice(["blarg", "snorfle", "bl4rg", "snоrfle"]))
        if not toxic and i % 3 == 0:
            at = draw.randrange(len(words))
            words[at:at] = ["gentle", "snorfle"]
        rows.append((i, " ".join(words), int(toxic)))
    return rows


def test_learned_lexicon_finds_held_out_rows(spark):
    schema = "doc_id long, text string, toxic int"
    lexicon = toxicity.fit(spark.createDataFrame(labelled(800), schema))
    assert "gentle snorfle" in lexicon.exceptions
    test = spark.createDataFrame(labelled(200, 1000), schema)
    rows = toxicity.scores(test, lexicon).collect()
    assert all(r.predicted == r.toxic and 0 <= r.score <= 1 for r in rows)
    assert [r.doc_id for r in toxicity.reject(test, lexicon).orderBy("doc_id").collect()] == [i for i, _, t in labelled(200, 1000) if not t]


def test_bounded_sample(spark):
    rows = spark.createDataFrame(labelled(1200), "doc_id long, text string, toxic int")
    assert toxicity.fit(rows, most=600).weights


def test_odd_rows(spark):
    lexicon = toxicity.fit(spark.createDataFrame(labelled(400), "doc_id long, text string, toxic int"))
    docs = odd(spark)
    out = toxicity.scores(docs, lexicon)
    # an own column of the same name is replaced
    assert sorted(out.columns) == sorted([*docs.columns, "predicted"]) and out.count() == len(odd_rows())
    scores = {r.score for r in out.filter("text IS NULL OR text = ''").collect()}
    assert len(scores) == 1
    assert toxicity.reject(docs, lexicon).columns == docs.columns
    labels = spark.createDataFrame([(4, 1), (4, 0), (None, 1), (5, None)], "doc_id long, toxic int")
    assert [r.toxic for r in toxicity.labelled(docs, labels).collect()] == [1]
    nothing = toxicity.fit(toxicity.labelled(empty(spark), labels))
    assert nothing.weights == {} and {r.score for r in toxicity.scores(docs, nothing).collect()} == {0.0}
    assert toxicity.scores(empty(spark), lexicon).count() == 0
