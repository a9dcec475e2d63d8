"""Small inputs for the tests."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, source string, score string, row int, items string, class_id string"
WORDS = "the of and to in is it on for was tree stone river light paper green house seven walk quiet morning".split()


def prose(seed: int, words: int, vocabulary: list[str] = WORDS) -> str:
    draw = random.Random(seed)
    return " ".join(draw.choice(vocabulary) + str(draw.randrange(60)) * (draw.random() < 0.5) for _ in range(words))


def odd_rows() -> list[tuple]:
    """Nulls, empty, blank, very long and repeated texts, repeated and null ids, columns with clashing names."""
    extra = ("a", 1, "b", "c")
    long = prose(1, 60_000)
    return [
        (1, None, None, None, *extra),
        (2, "", "en", "s", *extra),
        (3, " \n\t ", "en", None, *extra),
        (4, long, "en", "s", *extra),
        (5, long, "en", "s", *extra),
        (5, long, "en", "s", *extra),
        (None, "no id here", "en", "s", *extra),
        (None, None, None, None, None, None, None, None),
        (6, "x" * 50_000, "en", "s", *extra),
        (7, "!!! ... ???", "en", "s", *extra),
        (8, "naïve \u0000 text é 中文 😀 'll", "fr", "s", *extra),
    ]


def odd(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def documents(spark, texts, first: int = 0):
    return spark.createDataFrame([(first + i, t) for i, t in enumerate(texts)], "doc_id long, text string")
