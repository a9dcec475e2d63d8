"""Toxicity by a weighted lexicon.

Text is folded first: lower case, look-alike letters of other scripts, digits and signs inside words, invisible characters.
The lexicon is learned from labelled documents: whole words and word beginnings or endings that toxic documents hold more
often, weighted by their log odds; and exception phrases, which hold such a term and stand in clean documents instead. One
Aho-Corasick automaton finds terms and exceptions in a pass; a term inside an exception doesn't count. The weights found are
divided by a power of the document's length, and a logistic curve turns the result into a score from 0 to 1.

Null and empty texts hold no term and get the score of no evidence. Ties between terms are broken by their text. Repeated
rows count each time. Without labelled rows of both kinds the lexicon is empty and every score is 0. New columns replace
kept ones of the same name.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickfold.llm.common import chunks, extended, narrow_join, schema_of, stage

#: About so many labelled documents are fitted on at most, chosen by a hash of their id.
MAX_LABELLED = 40_000
#: A term or exception needs this many documents, and this share of the toxic ones.
MIN_DOCS, MIN_SHARE = 5, 0.01
#: Least log odds of a term, and of an exception the other way round.
MIN_WEIGHT = math.log(12)
#: Least log odds of a term that exceptions are looked for, before they are taken out.
LOOSE_WEIGHT = math.log(2)
#: Letters of a word beginning or ending.
AFFIX = range(3, 9)
#: Evidence is divided by (words + LENGTH_FLOOR) to this power.
LENGTH_POWER, LENGTH_FLOOR = 0.5, 20
#: A score of at least this is a toxic document.
CUT = 0.3

# Letters of other scripts that look like a Latin one, and signs that stand for a letter inside a word.
LOOK_ALIKES = str.maketrans("аеорсухіѕјԁһкмтвнαοερυικντ", "aeopcyxisjdhkmtbhaoepuikvt")
SIGNS = str.maketrans("013457@$", "oieastas")

INVISIBLE = re.compile("[\u00ad\u200b-\u200f\u2060\ufeff]")
FOREIGN = re.compile("[\u03b1-\u03c9\u0430-\u045f\u0501\u04bb\uff01-\uff5e]")
INSIDE = re.compile(r"(?<=[^\W\d_])[0-9@$]+(?=[^\W\d_])")
BEFORE = re.compile(r"\b[0-9]+(?=[^\W\d_]{2})")
WORD = re.compile(r"[^\W\d_]+")
WIDE = {c: c - 0xFEE0 for c in range(0xFF01, 0xFF5F)}


def fold(text: str) -> str:
    text = text.lower()
    if not text.isascii():
        text = INVISIBLE.sub("", text)
        if FOREIGN.search(text):
            text = text.translate(WIDE).lower().translate(LOOK_ALIKES)
    for place in (INSIDE, BEFORE):
        text = place.sub(lambda m: m[0].translate(SIGNS), text)
    return text


def terms(words: Iterable[str]) -> set[str]:
    """Candidates: ``^word$``, ``^beginning``, ``ending$``."""
    out = set()
    for w in set(words):
        out.add(f"^{w}$")
        for n in AFFIX:
            if n < len(w):
                out.add(f"^{w[:n]}")
                out.add(f"{w[-n:]}$")
    return out


class Lexicon(NamedTuple):
    weights: dict[str, float]  # by term
    exceptions: frozenset[str]  # one word, or two with a blank between
    slope: float
    shift: float


class Matcher:
    """One automaton for terms and exceptions."""

    def __init__(self, lexicon: Lexicon):
        self.lexicon = lexicon
        found: dict[str, list[tuple[bool, bool, float]]] = {}
        for term, weight in sorted(lexicon.weights.items()):
            plain = term.strip("^$")
            found.setdefault(plain, []).append((term[0] == "^", term[-1] == "$", weight))
        for phrase in sorted(lexicon.exceptions):
            found.setdefault(phrase, []).append((True, True, 0.0))
        self.automaton = ahocorasick.Automaton()
        for plain, kinds in found.items():
            self.automaton.add_word(plain, (len(plain), kinds))
        if found:
            self.automaton.make_automaton()

    def hits(self, folded: str) -> list[tuple[int, int, float]]:
        """(begin, end, weight) of terms outside exceptions; nested terms of one word count by the heaviest alone."""
        if not len(self.automaton):
            return []
        best: dict[int, tuple[int, int, float]] = {}
        spared: list[tuple[int, int]] = []
        for last, (n, kinds) in self.automaton.iter(folded):
            a, b = last + 1 - n, last + 1
            opens = a == 0 or not folded[a - 1].isalpha()
            closes = b == len(folded) or not folded[b].isalpha()
            for begins, ends, weight in kinds:
                if begins and not opens or ends and not closes:
                    continue
                if not weight:
                    spared.append((a, b))
                    continue
                start = a
                while start and folded[start - 1].isalpha():
                    start -= 1
                if start not in best or weight > best[start][2]:
                    best[start] = (a, b, weight)
        return [h for h in best.values() if not any(a <= h[0] and h[1] <= b for a, b in spared)]

    def evidence(self, text: str) -> float:
        folded = fold(text)
        found = self.hits(folded)
        if not found:
            return 0.0
        return sum(h[2] for h in found) / (len(folded.split()) + LENGTH_FLOOR) ** LENGTH_POWER

    def score(self, evidence: float) -> float:
        if not self.lexicon.weights:
            return 0.0
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, self.lexicon.slope * evidence + self.lexicon.shift))))


def _counted(docs: DataFrame, of, kind: str) -> DataFrame:
    """(term, n): documents that hold each term ``of`` finds in a folded text, folded per task first."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], names=["term", "n"])

        for _, texts in chunks(batches, "text"):
            for text in texts:
                held.update(of(fold(text)))
                if len(held) > 300_000:
                    yield out()
                    held.clear()
        yield out()

    return docs.select("text").mapInArrow(step, "term string, n long").groupBy("term").agg(F.sum("n").cast("long").alias(kind))


def _table(counted: DataFrame) -> dict[str, int]:
    """Counts by term; there are no more terms than were asked for."""
    return {r["term"]: r["n"] for r in counted.collect()}


def unspared(folded: str, spared: frozenset[str]) -> list[str]:
    """The words outside exceptions."""
    words = WORD.findall(folded)
    out = [w not in spared for w in words]
    for i in range(len(words) - 1):
        if f"{words[i]} {words[i + 1]}" in spared:
            out[i] = out[i + 1] = False
    return [w for w, good in zip(words, out) if good]


def phrases(folded: str, weights: frozenset[str]) -> set[str]:
    """Words that hold a term of ``weights``, alone and with their neighbours."""
    words = WORD.findall(folded)
    out = set()
    for i, w in enumerate(words):
        if not any(t in weights for t in terms([w])):
            continue
        out.add(w)
        if i:
            out.add(f"{words[i - 1]} {w}")
        if i + 1 < len(words):
            out.add(f"{w} {words[i + 1]}")
    return out


def fit(labelled: DataFrame, toxic: str = "toxic", doc_id: str = "doc_id", most: int = MAX_LABELLED) -> Lexicon:
    """The lexicon of labelled documents (doc_id, text, 0/1), of which at most about ``most`` are used."""
    rows = labelled.filter(F.col(toxic).isNotNull()).select(F.col(doc_id).alias("doc_id"), "text", (F.col(toxic) == 1).alias("toxic"))
    n = rows.count()
    if n > most:
        rows = rows.filter(F.pmod(F.xxhash64(F.lit("lexicon"), "doc_id"), F.lit(1 << 30)) < int(most / n * (1 << 30)))
    # copies of a text are one piece of evidence
    one = rows.groupBy(F.sha2(F.coalesce("text", F.lit("")), 256), "toxic").agg(F.first("text").alias("text"))
    rows = stage(one.select("text", "toxic"), "toxicity-labelled")
    sizes = {r["toxic"]: r["count"] for r in rows.groupBy("toxic").count().collect()}
    bad, good = sizes.get(True, 0), sizes.get(False, 0)
    if not bad or not good:
        return Lexicon({}, frozenset(), 0.0, 0.0)
    toxic_rows, clean_rows = rows.filter("toxic"), rows.filter("NOT toxic")
    least = max(MIN_DOCS, math.ceil(MIN_SHARE * bad))
    broadcast = rows.sparkSession.sparkContext.broadcast

    def odds(a: int, b: int, n: int, m: int) -> float:
        """Of a in n against b in m, with both counts one standard deviation less favourable."""
        return math.log((a - math.sqrt(a) + 0.5) / (n + 1)) - math.log((b + math.sqrt(b) + 0.5) / (m + 1))

    # at most (terms of a document) / MIN_SHARE candidates
    found = _counted(toxic_rows, lambda t: terms(WORD.findall(t)), "n").filter(F.col("n") >= least).collect()
    candidates = {r["term"]: r["n"] for r in found}
    asked = broadcast(frozenset(candidates))
    clean = _table(_counted(clean_rows, lambda t: asked.value & terms(WORD.findall(t)), "n"))
    loose = frozenset(t for t, a in candidates.items() if odds(a, clean.get(t, 0), bad, good) >= LOOSE_WEIGHT)
    held = broadcast(loose)
    around = _counted(clean_rows, lambda t: phrases(t, held.value), "good").filter(F.col("good") >= MIN_DOCS)
    against = _counted(toxic_rows, lambda t: phrases(t, held.value), "bad")
    pairs = around.join(against, "term", "left").select("term", "good", F.coalesce("bad", F.lit(0)).alias("bad"))
    spared = frozenset(r["term"] for r in pairs.collect() if odds(r["good"], r["bad"], good, bad) >= MIN_WEIGHT)
    if spared:  # terms count anew outside exceptions
        known = broadcast((loose, spared))
        outside = lambda t: known.value[0] & terms(unspared(t, known.value[1]))
        candidates, clean = _table(_counted(toxic_rows, outside, "n")), _table(_counted(clean_rows, outside, "n"))
    kept = {t: odds(a, clean.get(t, 0), bad, good) for t, a in candidates.items() if t in loose and a >= least}
    weights = shortest({t: w for t, w in kept.items() if w >= MIN_WEIGHT}, candidates)
    exceptions = frozenset(p for p in spared if any(t in weights for t in terms(p.split())))
    slope, shift = calibrate(_evidence(rows, Lexicon(weights, exceptions, 0.0, 0.0)))
    return Lexicon(weights, exceptions, slope, shift)


def shortest(weights: dict[str, float], docs: dict[str, int]) -> dict[str, float]:
    """Without longer affixes that stand for the same documents as a shorter one of no lesser weight."""
    out: dict[str, float] = {}
    for term in sorted(weights, key=lambda t: (len(t), t)):
        plain = term.strip("^$")
        inner = [f"^{plain[:n]}" for n in AFFIX if n < len(plain)] if term[0] == "^" else []
        inner += [f"{plain[-n:]}$" for n in AFFIX if n < len(plain)] if term[-1] == "$" else []
        if not any(s in out and out[s] >= weights[term] - 0.1 and docs[s] >= docs[term] for s in inner):
            out[term] = weights[term]
    return out


def _evidence(rows: DataFrame, lexicon: Lexicon) -> list[tuple[float, bool, int]]:
    """(evidence to two digits, label, documents): a small table."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(lexicon)
        for batch, texts in chunks(batches, "text"):
            found = [round(matcher.evidence(t), 2) for t in texts]
            yield extended(batch, ["toxic"], {"e": pa.array(found, pa.float64())})

    found = rows.select("toxic", "text").mapInArrow(step, "toxic boolean, e double")
    return [(r["e"], r["toxic"], r["n"]) for r in found.groupBy("e", "toxic").agg(F.count("*").alias("n")).collect()]


def calibrate(found: list[tuple[float, bool, int]]) -> tuple[float, float]:
    """Slope and shift of a logistic curve by Newton steps, with a weak ridge."""
    e, y, n = (np.array(c, float) for c in zip(*found))
    x = np.stack([e, np.ones_like(e)])
    beta = np.array([0.0, math.log((n @ y + 0.5) / (n @ (1 - y) + 0.5))])
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(beta @ x, -30, 30)))
        ridge = np.array([1e-2, 1e-6])
        step = np.linalg.solve((x * (n * p * (1 - p) + 1e-9)) @ x.T + np.diag(ridge), x @ (n * (y - p)) - ridge * beta)
        beta = beta + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return float(max(beta[0], 0.0)), float(beta[1])


def scores(docs: DataFrame, lexicon: Lexicon, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns with ``score`` and ``predicted`` (1 from ``CUT`` on)."""
    keep = [c for c in (docs.columns if keep is None else keep) if c.lower() not in ("score", "predicted")]

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(lexicon)
        for batch, texts in chunks(batches, text):
            found = [matcher.score(matcher.evidence(t)) for t in texts]
            cut = [int(s >= CUT) for s in found]
            yield extended(batch, keep, {"score": pa.array(found, pa.float64()), "predicted": pa.array(cut, pa.int32())})

    columns = list(dict.fromkeys([*keep, text]))
    return docs.select(*columns).mapInArrow(step, schema_of(docs, keep, "score double, predicted int"))


def reject(docs: DataFrame, lexicon: Lexicon, text: str = "text") -> DataFrame:
    """The documents below ``CUT``, with their own columns."""
    names = docs.columns
    held = [f"c{i}" for i in range(len(names))]
    scored = scores(docs.toDF(*held), lexicon, held[names.index(text)])
    return scored.filter("predicted = 0").select(*held).toDF(*names)


def labelled(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", label: str = "toxic") -> DataFrame:
    """doc_id, text and label of the labelled documents; of several labels of one id the largest holds."""
    own = labels.groupBy(doc_id).agg(F.max(label).alias(label)).filter(F.col(label).isNotNull() & F.col(doc_id).isNotNull())
    return narrow_join(docs.select(doc_id, "text"), own, doc_id, "inner", own.count())
