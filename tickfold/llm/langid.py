"""Language identification by Bayesian fusion of evidence.

The likelihood of a page's text comes from byte trigrams counted over labelled documents. Three other pieces of evidence are
weighed by how they go with the language of the text over all pages, all by grouped aggregation: the language that the markup
declares, the address suffix and the language folder of the path, and the host. The host's prior is smoothed towards its
domain's, and that towards the prior of all pages; a page's own share is taken out of the counts it is judged by.

Null or empty pages have no text evidence and are judged by the rest; a null address has the empty host. Repeated rows count
each time; ties go to the first language by name. Without labelled documents there are no languages and every page's language
is null; without pages the result is empty.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickfold.llm.common import chunks, extended, keyed_join, salted_join, stage

#: Trigrams are hashed into so many buckets.
BUCKETS = 1 << 15
#: Added to every bucket.
SMOOTHING = 0.5
#: Trigrams of one text depend on each other: at most this many count as independent evidence.
INDEPENDENT = 60
#: Strength of a domain's and a host's parent prior, and of a sign's overall share, in pages.
PARENT, SIGN = 8.0, 4.0

DROPPED = re.compile(r"(?is)<!--.*?-->|<(script|style|nav|noscript|template)\b.*?</\1\s*>|<div class=.ad.>.*?</div>")
ARTICLE = re.compile(r"(?is)<article\b[^>]*>(.*?)</article\s*>")
TAG = re.compile(r"(?s)<[^>]*>")
HTML = re.compile(r"(?i)<html\b")
DECLARED = re.compile(r"(?i)\blang\s*=\s*[\"']?\s*([a-z]{2,3})\b")
ADDRESS = re.compile(r"(?i)^(?:[a-z][a-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)(?::\d*)?([^?#]*)")
FOLDER = re.compile(r"(?i)^/([a-z]{2})(?:[-_][a-z]{2})?(?:/|$)")


def page_text(page: str) -> str:
    """Readable text: the article where there is one, without scripts, navigation and tags."""
    page = DROPPED.sub(" ", page)
    if found := ARTICLE.findall(page):
        page = " ".join(found)
    return entities.unescape(TAG.sub(" ", page))


def declared(page: str) -> str:
    """The language of the first ``html`` tag that declares one, wherever it stands; each tag is read once."""
    at = 0
    while tag := HTML.search(page, at):
        at = page.find(">", tag.end())
        if at < 0:
            break
        if found := DECLARED.search(page, tag.end(), at):
            return found[1].lower()
    return ""


def address(url: str) -> tuple[str, str, str, str]:
    """(host, domain, suffix, language folder or '')."""
    m = ADDRESS.match(url.strip())
    host, path = (m[1].lower().strip("."), m[2]) if m else ("", "")
    labels = host.split(".")
    folder = FOLDER.match(path)
    return host, ".".join(labels[-2:]), labels[-1], folder[1].lower() if folder else ""


_LETTERS = np.full(256, 32, np.uint8)  # ASCII letters and all bytes beyond ASCII stay, the rest is blank
_LETTERS[ord("a") : ord("z") + 1] = np.arange(ord("a"), ord("z") + 1)
_LETTERS[128:] = np.arange(128, 256)


def trigrams(text: str) -> np.ndarray:
    """Buckets of the byte trigrams of a text, words bounded by single blanks."""
    data = _LETTERS[np.frombuffer(f" {text.lower()} ".encode(), np.uint8)].astype(np.uint32)
    data = data[np.append(True, (data[1:] != 32) | (data[:-1] != 32))]
    if len(data) < 3:
        return np.zeros(0, np.int64)
    key = data[:-2] << 16 | data[1:-1] << 8 | data[2:]
    return (key * np.uint32(2654435761) >> np.uint32(32 - 15)).astype(np.int64)


def profiles(docs: DataFrame, lang: str = "lang", text: str = "text") -> tuple[list[str], np.ndarray]:
    """(languages, log probability by language and bucket) from all labelled documents, counted per task first."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] = {}
        for batch, texts in chunks(batches, "text"):
            for name, t in zip(batch.column(0).to_pylist(), texts):
                table = held.setdefault(name, np.zeros(BUCKETS, np.int64))
                table += np.bincount(trigrams(t), minlength=BUCKETS)
        for name, table in held.items():
            at = np.flatnonzero(table)
            names = pa.array([name] * len(at), pa.string())
            yield pa.RecordBatch.from_arrays([names, pa.array(at.astype(np.int32)), pa.array(table[at])], names=["lang", "bucket", "n"])

    rows = docs.filter(F.col(lang).isNotNull()).select(F.col(lang).cast("string").alias("lang"), F.col(text).alias("text"))
    # languages * BUCKETS rows at most
    found = rows.mapInArrow(step, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()
    names = sorted(set(found.column("lang").to_pylist()))
    table = np.full((len(names), BUCKETS), SMOOTHING)
    if names:
        index = {name: i for i, name in enumerate(names)}
        row = np.array([index[x] for x in found.column("lang").to_pylist()])
        table[row, found.column("bucket").to_numpy()] += found.column("n").to_numpy()
    return names, np.log(table / table.sum(1, keepdims=True))


def posterior(log: np.ndarray) -> np.ndarray:
    p = np.exp(log - log.max())
    return p / p.sum()


def evidence(pages: DataFrame, names: list[str], table: np.ndarray, page_id: str, url: str, page: str) -> DataFrame:
    """page_id, host, domain, suffix, folder, declared, log (text evidence) and share (posterior of it) of every page."""
    kind = dict(pages.dtypes)[page_id]
    shared = pages.sparkSession.sparkContext.broadcast(table.astype(np.float32))

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for batch, texts in chunks(batches, "page"):
            places = [address(u or "") for u in batch.column(1).to_pylist()]
            said = [declared(t) for t in texts]
            logs = []
            for t in texts:
                at = trigrams(page_text(t))
                log = table[:, at].sum(1, dtype=np.float64) if len(at) else np.zeros(len(table))
                logs.append(log * min(1.0, INDEPENDENT / max(len(at), 1)))
            strings = [pa.array(x, pa.string()) for x in (*(zip(*places) if places else [()] * 4), said)]
            numbers = [pa.array([x.tolist() for x in xs], pa.list_(pa.float64())) for xs in (logs, [posterior(x) for x in logs])]
            columns = dict(zip(("host", "domain", "suffix", "folder", "declared", "log", "share"), [*strings, *numbers]))
            yield extended(batch, ["page_id"], columns)

    rows = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), F.col(page).alias("page"))
    schema = f"page_id {kind}, host string, domain string, suffix string, folder string, declared string, log array<double>, share array<double>"
    return stage(rows.mapInArrow(step, schema), "language-evidence")


def _sums(rows: DataFrame, key: str, n: int) -> DataFrame:
    """Per value of ``key`` the summed shares of each language."""
    sums = F.array(*[F.sum(F.col("share")[i]) for i in range(n)])
    return rows.groupBy(key).agg(sums.alias(f"{key}_sums"))


def _normal(sums: str, parent: str, strength: float) -> Column:
    """Shares by language: sums without the page's own share, smoothed towards ``parent``."""
    own = f"zip_with({sums}, share, (s, o) -> greatest(s - o, 0D))"
    total = f"aggregate({own}, 0D, (a, x) -> a + x)"
    return F.expr(f"zip_with({own}, {parent}, (x, p) -> (x + {strength}D * p) / ({total} + {strength}D))")


def identify(pages: DataFrame, docs: DataFrame, page_id: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """page_id, lang, posterior, text_lang, declared, host of every page; ``docs`` (lang, text) train the text model."""
    names, table = profiles(docs)
    n = len(names)
    if not n:
        kind = dict(pages.dtypes)[page_id]
        none = ", ".join(f"CAST(NULL AS {k}) AS {c}" for c, k in (("lang", "string"), ("posterior", "double"), ("text_lang", "string"), ("declared", "string"), ("host", "string")))
        return pages.selectExpr(f"CAST(`{page_id}` AS {kind}) AS page_id", *none.split(", "))
    rows = evidence(pages, names, table, page_id, url, page)
    total = rows.agg(*[F.coalesce(F.sum(F.col("share")[i]), F.lit(0.0)).alias(f"s{i}") for i in range(n)]).first()
    sums = [float(x) for x in total]
    whole = [(s + 1) / (sum(sums) + n) for s in sums]
    out = rows.withColumn("overall", F.array(*map(F.lit, whole))).withColumn("sums", F.array(*map(F.lit, sums)))
    # hosts and domains are as many as the pages make them, and one may hold any share of them
    for key in ("domain", "host"):
        out = salted_join(out, _sums(rows, key, n), key)
    # declared languages, suffixes and folders are few, but nothing bounds them
    for key in ("declared", "suffix", "folder"):
        found = stage(_sums(rows, key, n), f"language-{key}")
        out = keyed_join(out, found, key, found.count())
    out = out.withColumn("domain_prior", _normal("domain_sums", "overall", PARENT))
    out = out.withColumn("prior", _normal("host_sums", "domain_prior", PARENT))
    terms = ["log[i]", "ln(prior[i])"]
    for key in ("declared", "suffix", "folder"):
        own = f"greatest({key}_sums[i] - share[i], 0D)"
        # how much likelier the sign is with this language than with any
        size = f"aggregate({key}_sums, 0D, (a, x) -> a + x)"
        out = out.withColumn(f"{key}_share", F.expr(f"greatest({size} - 1, 0D) / greatest({sum(sums)}D - 1, 1D)"))
        likelihood = f"({own} + {SIGN}D * {key}_share + 1e-9D) / (greatest(sums[i] - share[i], 0D) + {SIGN}D)"
        terms.append(f"CASE WHEN {key} = '' THEN 0D ELSE ln({likelihood}) END")
    out = out.withColumn("fused", F.expr(f"transform(sequence(0, {n - 1}), i -> {' + '.join(terms)})"))
    out = out.withColumn("best", F.array_max("fused"))
    names_sql = F.array(*map(F.lit, names))

    def first(column: str, top: Column) -> Column:
        return F.element_at(names_sql, F.array_position(column, top).cast("int"))

    return out.select(
        "page_id",
        first("fused", F.col("best")).alias("lang"),
        F.expr("1 / aggregate(fused, 0D, (a, x) -> a + exp(x - best))").alias("posterior"),
        first("log", F.array_max("log")).alias("text_lang"),
        "declared",
        "host",
    )
