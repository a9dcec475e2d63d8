"""Line deduplication with a log-template tree, in native expressions.

A line is parsed to a fixed depth: first by its number of tokens, then by its ``LEADING`` first tokens, where a token with a
digit counts as the wildcard ``<*>``. That names a leaf. A leaf's most frequent line is its template; lines of the leaf that
agree with it in at least ``AGREEMENT`` of all positions belong to it, their other positions being variable fields. The lines
that are left are parsed on, by one more token at a time (``DEEPER``): each branch of the leaf has its own most frequent line
and lines that agree with it, so one leaf holds many templates. A line that joins none is a template of its own; families that
differ in all the tokens read on stay apart. A template that enough documents share recurs, and its lines are dropped from all
documents but the first (the smallest id).

Lines go whatever their share of a document. Only a document with the whole text of an earlier one is a copy: it loses what
the first of its kind loses, so both stay equal for the removal of near duplicates. Any other document whose lines all recur
elsewhere is emptied, and stays as an empty row.

Lines are told apart by two 64-bit hashes; the lines' texts don't move, save one per line of a leaf with several. Null texts
stay null and have no lines, blank lines are kept and belong to no template. Repeated rows are separate documents; of equal
ids the first row counts. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickfold.llm.common import BROADCAST_IDS, free_name, narrow_join, salted_join, stage, staged_rows

#: Leading tokens that are levels of the tree.
LEADING = 3
AGREEMENT = 0.7
#: Tokens (from 0) by which the lines left in a leaf are parsed on, one level after the other.
DEEPER = (f"{LEADING}", "size(tokens) - 1", "size(tokens) div 2")
#: Documents that make a template recur: few for long lines, which never meet by chance, more for short ones.
LONG_TOKENS, LONG_DOCS, SHORT_DOCS = 20, 2, 8

SPACES = r"[\\x20\\x09-\\x0D]+"
#: A token with a digit; possessive, so a long token without one is read once.
WITH_DIGIT = r"(?<![^\\x20\\x09-\\x0D])[^\\x20\\x09-\\x0D0-9]*+[0-9][^\\x20\\x09-\\x0D]*+"
#: Lines that need more than a look: with a digit, or with blanks that don't stand singly between tokens.
UNEVEN = r"[0-9\\x09-\\x0D]|\\x20\\x20|^\\x20|\\x20$"
#: A line's tokens joined by single blanks, digits generalised. Most lines are that already.
MASK = (
    f"CASE WHEN line RLIKE '{UNEVEN}' THEN array_join(array_remove(split("
    f"regexp_replace(line, '{WITH_DIGIT}', '<*>'), '{SPACES}'), ''), ' ') ELSE line END"
)
#: Number of tokens of a mask, and the name of its leaf.
COUNT = "CASE WHEN mask = '' THEN 0 ELSE octet_length(mask) - octet_length(replace(mask, ' ', '')) + 1 END"
LEAF = f"xxhash64(n, substring_index(mask, ' ', {LEADING}))"


def _exploded(rows: DataFrame, text: str, *more: str) -> DataFrame:
    """One row per line: row, pos, line."""
    return rows.select("row", *more, F.posexplode(F.split(text, "\n")).alias("pos", "line"))


def lines_of(rows: DataFrame, text: str, doc_id: str) -> DataFrame:
    """row, id, pos, n (tokens), leaf and full of every line, in a written table."""
    lines = _exploded(rows, text, doc_id).withColumnRenamed(doc_id, "id").selectExpr("row", "id", "pos", f"{MASK} AS mask")
    lines = lines.selectExpr("row", "id", "pos", "mask", f"{COUNT} AS n")
    return stage(lines.selectExpr("row", "id", "pos", "n", f"{LEAF} AS leaf", "xxhash64(mask) AS full"), "template-lines")


def variants(rows: DataFrame, text: str, masks: DataFrame) -> DataFrame:
    """(leaf, full, template): the lines that belong to another line's template.

    Of every line of a leaf with several, one place is looked up; only the texts there are compared.
    """
    several = masks.groupBy("leaf").agg(F.count("*").alias("n")).filter("n > 1").select("leaf")
    asked = stage(masks.join(several, "leaf", "left_semi").select("leaf", "full", "docs", "at.row", "at.pos"), "template-asked")
    lines = narrow_join(_exploded(rows, text), asked, ["row", "pos"], "inner", asked.count())
    one = stage(lines.selectExpr("leaf", "full", "docs", f"{MASK} AS mask"), "template-variants")
    pool = one.selectExpr("leaf", "full", "docs", "split(mask, ' ') AS tokens", "mask")
    # of equally frequent lines the first by text is the template
    best = F.min_by(F.struct("full", "tokens"), F.struct(-F.col("docs"), F.col("mask"))).alias("seed")
    equal = "size(filter(zip_with(tokens, seed.tokens, (x, y) -> x = y), e -> e))"
    found = None
    for place in (None, *DEEPER):
        branch = "leaf" if place is None else f"xxhash64(leaf, get(tokens, {place}))"
        branched = pool.withColumn("branch", F.expr(branch))
        seeds = branched.groupBy("branch").agg(best, F.count("*").alias("held")).filter("held > 1").drop("held")
        both = salted_join(branched.drop("docs", "mask"), seeds, "branch").filter("full <> seed.full")
        joined = both.filter(f"{equal} >= {AGREEMENT} * size(tokens)").selectExpr("leaf", "full", "seed.full AS template")
        joined = stage(joined, "template-joined")
        found = joined if found is None else found.union(joined)
        # a template and its lines are done; a branch's most frequent line that nobody joined is parsed on with the others
        done = stage(joined.select("leaf", "full").union(joined.select("leaf", "template")).distinct(), "template-done")
        pool = stage(narrow_join(pool, done, ["leaf", "full"], "left_anti", done.count()), "template-left")
    return found


def copies(rows: DataFrame, text: str, doc_id: str) -> DataFrame:
    """(row, same): rows with the text of an earlier row, and the first such row, written."""
    listed = rows.select("row", F.col(doc_id).alias("id"), F.struct(F.xxhash64(text).alias("a"), F.xxhash64(F.lit(1), text).alias("b")).alias("whole"))
    listed = stage(listed, "template-whole-texts")
    first = F.min(F.struct(F.col("id").isNull(), "id", "row")).alias("first")
    several = listed.groupBy("whole").agg(F.count("*").alias("n"), first).filter("n > 1").select("whole", F.col("first.row").alias("same"))
    several = stage(several, "template-repeated-texts")
    each = listed.select("row", "whole")
    found = each.join(F.broadcast(several), "whole") if several.count() <= BROADCAST_IDS else salted_join(each, several, "whole")
    return stage(found.filter("same <> row").select("row", "same"), "template-copies")


def marked(lines: DataFrame, rows: DataFrame, text: str, doc_id: str) -> DataFrame:
    """(row, pos, drop): every line with tokens, and whether its document loses it; a copy loses what the first one does."""
    worded = lines.filter("n > 0")
    of_row = worded.groupBy("leaf", "full", "row").agg(F.first("id").alias("id"), F.first("n").alias("n"), F.min("pos").alias("pos"))
    of_row = stage(of_row, "template-of-row")
    place = F.min(F.struct("row", "pos")).alias("at")
    masks = stage(of_row.groupBy("leaf", "full").agg(F.count("*").alias("docs"), place), "template-masks")
    other = stage(variants(rows, text, masks), "template-map")
    n_other = other.count()

    def grouped(df: DataFrame) -> DataFrame:
        found = narrow_join(df, other, ["leaf", "full"], "left", n_other)
        return found.withColumn("template", F.coalesce("template", "full")).drop("full")

    each = grouped(of_row.drop("pos"))
    if n_other:  # else a row has a template once already
        each = each.groupBy("leaf", "template", "row").agg(F.first("id").alias("id"), F.first("n").alias("n"))
    found = each.groupBy("leaf", "template").agg(
        F.count("*").alias("docs"), F.max("n").alias("n"), F.min(F.struct(F.col("id").isNull(), "id", "row")).alias("first")
    )
    recurring = found.filter(f"docs >= CASE WHEN n >= {LONG_TOKENS} THEN {LONG_DOCS} ELSE {SHORT_DOCS} END")
    recurring = stage(recurring.select("leaf", "template", F.col("first.row").alias("first")), "template-recurring")
    out = narrow_join(grouped(worded.drop("id")), recurring, ["leaf", "template"], "left", recurring.count())
    same = copies(rows, text, doc_id)
    out = narrow_join(out, same, "row", "left", same.count())
    gone = F.coalesce(F.col("first") != F.coalesce("same", "row"), F.lit(False))
    return out.select("row", "pos", gone.alias("drop"))


def drop_recurring(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> tuple[DataFrame, str, str]:
    """``docs`` with recurring lines dropped from ``text``, and two counts per row.

    Returns (rows, name of the count of lines with tokens, name of the count of dropped lines).
    """
    names = docs.columns
    at, key = f"c{names.index(text)}", f"c{names.index(doc_id)}"
    rows = staged_rows(docs.toDF(*[f"c{i}" for i in range(len(names))]), "row", "template-rows")
    lines = lines_of(rows, at, key)
    all_lines = stage(marked(lines, rows, at, key), "template-marked")
    per_row = all_lines.groupBy("row").agg(F.count("*").alias("n_lines"), F.count_if("drop").alias("n_drop"))
    per_row = stage(per_row, "template-rows-marked")
    hit = per_row.filter("n_drop > 0").select("row")
    # of the documents that lose lines: which positions stay, in order
    places = narrow_join(lines.select("row", "pos"), hit, "row", "left_semi", hit.count())
    drops = all_lines.filter("drop").select("row", "pos", F.lit(True).alias("gone"))
    stay = places.join(drops, ["row", "pos"], "left").groupBy("row").agg(
        F.sort_array(F.collect_list(F.struct("pos", F.col("gone").isNull().alias("stays")))).alias("places")
    )
    stay = stage(stay.select("row", F.col("places.stays").alias("stays")), "template-stays")
    # texts move once, whatever their number: a broadcast below some size would only make small tables look cheaper
    joined = rows.join(per_row.join(stay, "row", "left"), "row", "left")
    lines_kept = f"transform(filter(zip_with(split({at}, '\\n'), stays, (l, s) -> struct(l, s)), x -> x.s), x -> x.l)"
    joined = joined.withColumn(at, F.expr(f"CASE WHEN stays IS NULL THEN {at} ELSE array_join({lines_kept}, '\\n') END"))
    n_lines, n_dropped = free_name(docs, "n_lines"), free_name(docs, "n_dropped")
    return (
        joined.select(
            *[F.col(f"c{i}").alias(name) for i, name in enumerate(names)],
            F.coalesce("n_lines", F.lit(0)).cast("long").alias(n_lines),
            F.coalesce("n_drop", F.lit(0)).cast("long").alias(n_dropped),
        ),
        n_lines,
        n_dropped,
    )


def deduplicate_lines(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The documents with their own columns, recurring lines dropped whatever their share of a document."""
    rows, n_lines, n_dropped = drop_recurring(docs, text, doc_id)
    return rows.drop(n_lines, n_dropped)
