"""Column profiles of a table, as tidy tables."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce
from itertools import combinations
from operator import or_

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickfold.functions.scaling import ZScore, totalled

QUANTILES = {"p05": 0.05, "p25": 0.25, "p50": 0.5, "p75": 0.75, "p95": 0.95}


def _unpivot(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, value) rows, inside one scan."""
    return df.select(
        F.explode(
            F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns])
        ).alias("cell")
    ).select("cell.column", "cell.value")


def _cells(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, x) rows of numeric columns, inside one scan."""
    return df.select(
        F.explode(
            F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("x")) for c in columns])
        ).alias("cell")
    ).select("cell.column", "cell.x")


def profile_numeric(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per numeric column: counts, extremes, mean, spread and shape.

    Columns are turned into rows inside the scan and folded per task, so the shuffle carries one partial state per
    column and task, for narrow and wide tables alike.
    """
    x, n = F.col("x"), F.count("x")
    skew, kurt = F.skewness(x), F.kurtosis(x)
    return _cells(df, columns).groupBy("column").agg(
        F.count(F.lit(1)).alias("n_rows"),
        n.alias("n_values"),
        F.count_if(x.isNull()).alias("n_missing"),
        F.count_if(x == 0).alias("n_zeros"),
        F.count_if(x < 0).alias("n_negative"),
        F.min(x).alias("min"),
        F.max(x).alias("max"),
        F.avg(x).alias("mean"),
        F.stddev_samp(x).alias("std"),
        # sample-adjusted, as usual in table profiles
        F.when(n > 2, skew * F.sqrt(n * (n - 1.0)) / (n - 2)).alias("skewness"),
        F.when(n > 3, (kurt * (n + 1) + 6) * (n - 1) / ((n - 2) * (n - 3.0))).alias("kurtosis"),
    )


def profile_quantiles(df: DataFrame, columns: Sequence[str], accuracy: int = 10_000) -> DataFrame:
    """Quantiles per numeric column: the value at rank q * n, off by at most n / accuracy ranks.

    A mergeable sketch, whose size depends on ``accuracy`` alone; with fewer values than half of it the result is exact.
    No task ever holds a column.
    """
    sketch = _cells(df, columns).groupBy("column").agg(
        F.percentile_approx("x", list(QUANTILES.values()), accuracy).alias("q")
    )
    return sketch.select("column", *[F.get("q", F.lit(i)).alias(name) for i, name in enumerate(QUANTILES)])


#: Values of an interval that are collected to pick a rank from; a wider interval is narrowed by another sketch.
PICKED = 20_000
#: Columns whose quantiles are searched in one job: the job's plan has some expressions for each.
QUANTILE_COLUMNS = 12


@dataclass
class _Search:
    """The search for two neighbouring ranks (``rank`` and the next) among a column's values in [low, high]."""

    column: str
    name: str
    rank: int
    part: float  # how far between the two the quantile lies
    low: float
    high: float
    below: int = 0  # values under low
    pair: tuple[float, float] | None = None  # the values of both ranks

    def value(self) -> Column:
        return F.col(f"`{self.column}`")

    def inside(self) -> Column:
        return (self.value() >= F.lit(self.low)) & (self.value() <= F.lit(self.high))

    def quantile(self) -> float:
        first, after = self.pair
        return first + (after - first) * self.part if self.part else first


def _bracketed(df: DataFrame, searches: list[_Search], accuracy: int) -> None:
    """Narrows each interval by a sketch of the values it holds.

    The sketch bounds both ranks from below and above by its guaranteed error; exact counts say whether a bound holds. Searches
    of the same interval, as all of a column are at first, share one sketch.
    """
    shared: dict[tuple, list[_Search]] = {}
    for s in searches:
        shared.setdefault((s.column, s.low, s.high), []).append(s)
    held = df.agg(*[F.count_if(group[0].inside()).alias(str(i)) for i, group in enumerate(shared.values())]).first()
    probes = []
    for i, group in enumerate(shared.values()):
        size, at = max(held[i], 1), []
        for s in group:
            at += [max(0.0, (s.rank - s.below) / size - 2 / accuracy), min(1.0, (s.rank - s.below + 2) / size + 2 / accuracy)]
        probes.append(F.percentile_approx(F.when(group[0].inside(), group[0].value()), at, accuracy).alias(str(i)))
    sketched = {
        (s.column, s.name): (found[2 * k], found[2 * k + 1])
        for group, found in zip(shared.values(), df.agg(*probes).first())
        for k, s in enumerate(group)
    }
    bounds = [sketched[s.column, s.name] for s in searches]
    counts = df.agg(
        *[
            F.struct(F.count_if(s.value() < F.lit(low)), F.count_if(s.value() <= F.lit(high))).alias(str(i))
            for i, (s, (low, high)) in enumerate(zip(searches, bounds))
        ]
    ).first()
    for s, (low, high), (under, upto) in zip(searches, bounds, counts):
        if under <= s.rank:
            s.low, s.below = low, under
        if upto > s.rank + 1:
            s.high = high


def _near(df: DataFrame, searches: list[_Search]) -> DataFrame:
    """The rows with a value in one of the intervals: a small part of the table once these are narrow."""
    return df.filter(reduce(or_, [s.inside() for s in searches]))


def _trimmed(df: DataFrame, searches: list[_Search]) -> list[int]:
    """Reads ranks off the ends of each interval or drops an end value, however frequent it is, so that every round gets on.

    Returns how many values each interval then holds, at most.
    """
    found = _near(df, searches).agg(
        *[
            F.struct(
                F.count_if(s.inside()),
                F.count_if(s.value() == F.lit(s.low)),
                F.count_if(s.value() == F.lit(s.high)),
                F.min(F.when(s.inside() & (s.value() > F.lit(s.low)), s.value())),
                F.max(F.when(s.inside() & (s.value() < F.lit(s.high)), s.value())),
            ).alias(str(i))
            for i, s in enumerate(searches)
        ]
    ).first()
    sizes = []
    for s, (inside, at_low, at_high, next_low, next_high) in zip(searches, found):
        last = s.below + inside - at_high  # first rank of the highest value

        def known(rank: int) -> float | None:
            if rank < s.below + at_low:
                return s.low
            if rank >= last:
                return s.high
            return next_low if rank == s.below + at_low else next_high if rank == last - 1 else None

        first, after = known(s.rank), known(s.rank + 1) if s.part else 0.0
        if first is not None and after is not None:
            s.pair = (first, after)
        elif s.rank >= s.below + at_low:
            s.low, s.below, inside = next_low, s.below + at_low, inside - at_low
        else:
            # the lower rank is the lowest value's last, so the other is the next: known, and not here
            raise AssertionError(f"quantile {s.name} of {s.column}")
        sizes.append(inside)
    return sizes


def profile_quantiles_exact(df: DataFrame, columns: Sequence[str], accuracy: int = 10_000) -> DataFrame:
    """Exact quantiles per numeric column, linear between neighbouring ranks: (column, p05, p25, p50, p75, p95).

    Ranks are selected, never sorted for: a sketch of fixed size brackets every wanted rank of all columns at once, exact
    counts verify the bracket, and its values are collected and picked from if they are at most ``PICKED``. Wider brackets
    are sketched again, each time at a few parts in ``accuracy`` of their values, so 10^11 rows take three rounds; a
    bracket of one value, however frequent, ends at once. Missing values are left out; a column without values has NULL.
    ``df`` is read several times, so it should be a stored table.
    """
    rows = []
    for at in range(0, len(columns), QUANTILE_COLUMNS):
        rows += _quantiles(df, columns[at : at + QUANTILE_COLUMNS], accuracy)
    schema = "column string, " + ", ".join(f"{name} double" for name in QUANTILES)
    return df.sparkSession.createDataFrame(rows, schema)


def _quantiles(df: DataFrame, columns: Sequence[str], accuracy: int) -> list[tuple]:
    df = df.select(*[F.col(f"`{c}`").cast("double").alias(c) for c in columns])
    ends = df.agg(*[F.struct(F.count(f"`{c}`"), F.min(f"`{c}`"), F.max(f"`{c}`")).alias(c) for c in columns]).first()
    searches = []
    for c in columns:
        n, low, high = ends[c]
        for name, q in QUANTILES.items() if n else ():
            at = q * (n - 1)
            searches.append(_Search(c, name, math.floor(at), at - math.floor(at), low, high))
    due = searches
    while due:
        _bracketed(df, due, accuracy)
        sizes = _trimmed(df, due)
        small = [s for s, n in zip(due, sizes) if s.pair is None and n <= PICKED]
        if small:
            lists = _near(df, small).agg(*[F.sort_array(F.collect_list(F.when(s.inside(), s.value()))).alias(str(i)) for i, s in enumerate(small)])
            for s, values in zip(small, lists.first()):
                at = s.rank - s.below
                s.pair = (values[at], values[at + 1] if s.part else 0.0)
        due = [s for s in due if s.pair is None]
    found = {(s.column, s.name): s.quantile() for s in searches}
    return [(c, *[found.get((c, name)) for name in QUANTILES]) for c in columns]


def profile_parts(df: DataFrame, columns: Sequence[str], key: Column, name: str = "part") -> DataFrame:
    """Per part of a table (a year, say) and numeric column what a profile needs, in rows that merge.

    (part, column, n_rows, n, n_zeros, n_negative, mean, m2, low, high, sketch): counts, moments and extremes, and a sketch of
    fixed size of the different values. Stored, the table grows by one part's rows; a new part costs that part alone.
    """
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("double").alias("x")) for c in columns])
    x = F.col("x")
    return df.select(key.alias(name), F.inline(cells)).groupBy(name, "column").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count(x).alias("n"),
        F.count_if(x == 0).alias("n_zeros"),
        F.count_if(x < 0).alias("n_negative"),
        F.avg(x).alias("mean"),
        (F.var_pop(x) * F.count(x)).alias("m2"),
        F.min(x).alias("low"),
        F.max(x).alias("high"),
        # text, so that 0.1 is one value however it was come by
        F.hll_sketch_agg(x.cast("string")).alias("sketch"),
    )


def profile_merged(parts: DataFrame, name: str = "part") -> DataFrame:
    """The profile of all parts together: one row per column; ``about_distinct`` is off by 1.6 % or so."""
    counts = [F.sum(c).alias(c) for c in ("n_rows", "n_zeros", "n_negative")]
    distinct = F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("about_distinct")
    total = totalled(parts, name, *counts, distinct)
    return total.select(
        "column",
        "n_rows",
        F.col("n").alias("n_values"),
        (F.col("n_rows") - F.col("n")).alias("n_missing"),
        "n_zeros",
        "n_negative",
        F.col("low").alias("min"),
        F.col("high").alias("max"),
        "mean",
        F.when(F.col("n") > 1, F.sqrt(F.col("m2") / (F.col("n") - 1))).alias("std"),
        "about_distinct",
    )


def profile_distinct(df: DataFrame, columns: Sequence[str], rsd: float | None = None) -> DataFrame:
    """Distinct non-missing values per column.

    Exact by default: rows collapse to (column, value) per task before the shuffle and spread over all tasks. With
    ``rsd`` a fixed-size sketch with that relative error is used instead.
    """
    if rsd is not None:
        wide = df.agg(*[F.approx_count_distinct(c, rsd).alias(c) for c in columns])
        return _unpivot(wide, columns).select("column", F.col("value").cast("long").alias("n_distinct"))
    values = _unpivot(df, columns).filter("value is not null").groupBy("column", "value").agg(F.lit(1).alias("one"))
    return values.groupBy("column").agg(F.count("one").alias("n_distinct"))


def profile_topk(df: DataFrame, columns: Sequence[str], k: int = 10) -> DataFrame:
    """The ``k`` most frequent values of each column, ties by value. Only ``k`` rows per column and task reach the
    ranking."""
    counts = _unpivot(df, columns).groupBy("column", "value").agg(F.count(F.lit(1)).alias("n_rows"))
    order = Window.partitionBy("column").orderBy(F.col("n_rows").desc(), F.col("value").asc_nulls_first())
    return counts.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def profile_corr(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlation of each column pair, pairwise complete, in one aggregation pass."""
    pairs = list(combinations(columns, 2))
    wide = df.agg(
        F.array(
            *[
                F.struct(
                    F.lit(a).alias("column_a"), F.lit(b).alias("column_b"), F.corr(a, b).alias("correlation")
                )
                for a, b in pairs
            ]
        ).alias("pairs")
    )
    return wide.select(F.inline("pairs"))


def profile_corr_wide(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The same for wide tables: one product matrix of values and of marks of what is there, instead of one aggregate per
    pair.

    Each task folds its rows to a matrix of (3 x columns)^2 sums, and those are summed by place. Columns are put in standard
    units first, so that the sums stay exact. A pair without spread in common has a NULL correlation.
    """
    names, n = list(columns), len(columns)
    scaled = ZScore.fit(df, names).transform(df.select(*names))

    def products(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((3 * n, 3 * n))
        for pdf in batches:
            x = pdf.to_numpy(dtype="float64")
            there = np.isfinite(x)
            x = np.where(there, x, 0.0)
            z = np.hstack([there, x, x * x])
            total += z.T @ z
        i, j = np.nonzero(total)
        yield pd.DataFrame({"i": i, "j": j, "v": total[i, j]})

    sums = scaled.mapInPandas(products, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v"))
    matrix = np.zeros((3 * n, 3 * n))
    found = sums.toPandas()  # (3 x columns)^2 numbers
    matrix[found["i"], found["j"]] = found["v"]
    there, values, squares = slice(0, n), slice(n, 2 * n), slice(2 * n, 3 * n)
    count, first, second = matrix[there, there], matrix[values, there], matrix[squares, there]
    with np.errstate(all="ignore"):
        spread = second - first * first / count
        corr = (matrix[values, values] - first * first.T / count) / np.sqrt(spread * spread.T)
    rows = [
        (names[i], names[j], float(corr[i, j]) if np.isfinite(corr[i, j]) else None) for i, j in combinations(range(n), 2)
    ]
    return df.sparkSession.createDataFrame(rows, "column_a string, column_b string, correlation double")


def profile_duplicates(df: DataFrame) -> DataFrame:
    """Fully equal rows that stand more than once, with their count."""
    return df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("n_rows")).filter("n_rows > 1")
