"""Z-scores with the population standard deviation; a constant column is only centred."""

from __future__ import annotations

import datetime as dt
import math
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def double_columns(df: DataFrame, skip: tuple[str, ...] = ()) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.DoubleType) and f.name not in skip]


def _statistics(columns: list[str]) -> list[Column]:
    means = [F.expr(f"avg(`{c}`) AS `avg_{c}`") for c in columns]
    return means + [F.expr(f"coalesce(nullif(stddev_pop(`{c}`), 0D), 1D) AS `std_{c}`") for c in columns]


@dataclass(frozen=True)
class ZScore:
    """Fitted means and spreads: one number pair per column, so the driver may hold them."""

    means: dict[str, float | None]
    spreads: dict[str, float | None]

    @staticmethod
    def fit(df: DataFrame, columns: list[str]) -> "ZScore":
        row = df.agg(*_statistics(columns)).first()
        return ZScore({c: row[f"avg_{c}"] for c in columns}, {c: row[f"std_{c}"] for c in columns})

    def scaled(self, column: str) -> Column:
        mean, spread = (F.lit(v).cast("double") for v in (self.means[column], self.spreads[column]))
        return (F.col(column) - mean) / spread

    def transform(self, df: DataFrame) -> DataFrame:
        return df.select(*[self.scaled(c).alias(c) if c in self.means else F.col(c) for c in df.columns])

    def restore(self, value: Column, column: str) -> Column:
        mean, spread = (F.lit(v).cast("double") for v in (self.means[column], self.spreads[column]))
        return value * spread + mean


# -- moments that merge -------------------------------------------------------------------------------------------

#: Of one column in one slice: values, their mean, the sum of squared distances from it, least and greatest value.
Slice = tuple[int, float | None, float | None, float | None, float | None]
MOMENTS = ["n", "mean", "m2", "low", "high"]


def moments_by(df: DataFrame, columns: Sequence[str], key: str = "date") -> DataFrame:
    """Moments of every column per value of ``key``, in one pass: (key, column, n, mean, m2, low, high).

    ``m2`` is the sum of squared distances from the mean. Rows merge (:func:`expanding`, :func:`merged`), so the table can be
    stored, grows by the new keys alone and answers for any span of them. It has one row per key and column.
    """

    def of(c: str) -> Column:
        x = F.col(f"`{c}`").cast("double")
        mean = F.when(F.min(x) == F.max(x), F.min(x)).otherwise(F.avg(x))  # a sum of equal values may round
        return F.struct(
            F.count(x).alias("n"), mean.alias("mean"), (F.var_pop(x) * F.count(x)).alias("m2"), F.min(x).alias("low"), F.max(x).alias("high")
        ).alias(c)

    stats = df.groupBy(key).agg(*map(of, columns))
    cells = F.array(*[F.struct(F.lit(c).alias("column"), *[F.col(f"`{c}`.{m}") for m in MOMENTS]) for c in columns])
    return stats.select(key, F.inline(cells))


_OF = "struct<n: bigint, mean: double, m2: double, low: double, high: double>"


def _start() -> Column:
    """The moments of nothing."""
    nothing = F.lit(None).cast("double")
    return F.struct(F.lit(0).cast("long").alias("n"), *[nothing.alias(m) for m in MOMENTS[1:]])


def _merge(a: Column, b: Column) -> Column:
    """Common moments of two slices (Chan, Golub and LeVeque, 1983), without the cancellation that sums of squares suffer.

    Slices that are constant together have exactly that mean and no spread.
    """
    n, apart = a["n"] + b["n"], b["mean"] - a["mean"]
    low, high = F.least(a["low"], b["low"]), F.greatest(a["high"], b["high"])
    flat = low == high
    mean = F.when(flat, low).otherwise(a["mean"] + apart * (b["n"] / n))
    m2 = F.when(flat, 0.0).otherwise(a["m2"] + b["m2"] + apart * apart * (a["n"] * (b["n"] / n)))
    both = F.struct(n.alias("n"), mean.alias("mean"), m2.alias("m2"), low.alias("low"), high.alias("high"))
    return F.when(b["n"] == 0, a).when(a["n"] == 0, b).otherwise(both).cast(_OF)


def _slices(key: str) -> Column:
    """The slices of a group in order of their key; one per key, so bounded by the keys."""
    return F.sort_array(F.collect_list(F.struct(F.col(key).alias("key"), F.struct(*MOMENTS).alias("of"))))


def expanding(moments: DataFrame, key: str = "date") -> DataFrame:
    """Moments of all rows up to and with each key: (key, column, n, mean, m2, low, high).

    Per column the slices, one per key, are merged in order of the key.
    """
    kind = dict(moments.dtypes)[key]

    def step(out: Column, part: Column) -> Column:
        so_far = F.when(F.size(out) > 0, F.element_at(out, -1)["of"]).otherwise(_start())
        return F.concat(out, F.array(F.struct(part["key"].alias("key"), _merge(so_far, part["of"]).alias("of"))))

    empty = F.array().cast(f"array<struct<key: {kind}, of: {_OF}>>")
    runs = moments.groupBy("column").agg(_slices(key).alias("slices"))
    return runs.select("column", F.inline(F.aggregate("slices", empty, step))).select(F.col("key").alias(key), "column", "of.*")


def totalled(moments: DataFrame, key: str, *sums: Column) -> DataFrame:
    """Moments of all slices together, and further aggregates: (column, n, mean, m2, low, high, ...)."""
    runs = moments.groupBy("column").agg(_slices(key).alias("slices"), *sums)
    total = F.aggregate("slices", _start(), lambda out, part: _merge(out, part["of"]))
    return runs.withColumn("of", total).select("column", "of.*", *[c for c in runs.columns if c not in ("column", "slices")])


def merged(parts: Iterable[Slice]) -> Slice:
    """The common moments of several slices; without values there is no mean."""
    n, mean, m2, low, high = 0, None, None, None, None
    for k, own, spread, least, most in parts:
        if not k:
            continue
        if not n:
            n, mean, m2, low, high = k, own, spread, least, most
        else:
            apart, whole = own - mean, n + k
            mean, m2, n = mean + apart * (k / whole), m2 + spread + apart * apart * (n * (k / whole)), whole
            low, high = min(low, least), max(high, most)
        if low == high:
            mean, m2 = low, 0.0
    return n, mean, m2, low, high


@dataclass(frozen=True)
class MomentTable:
    """Moments by date and column on the driver: one row per date and column, bounded by the calendar."""

    columns: tuple[str, ...]
    #: date -> column -> moments, dates ascending
    slices: dict[dt.date, dict[str, Slice]]

    @staticmethod
    def fit(df: DataFrame, columns: Sequence[str], key: str = "date") -> "MomentTable":
        """One job, whatever the number of scalers asked for after."""
        found: dict[dt.date, dict[str, Slice]] = {}
        for row in moments_by(df, columns, key).collect():
            found.setdefault(row[key], {})[row["column"]] = tuple(row[m] for m in MOMENTS)
        return MomentTable(tuple(columns), dict(sorted(found.items())))

    def scale(self, start: str | None = None, before: str | None = None) -> ZScore:
        """Mean and spread of the rows with start <= date < before."""
        first, last = (dt.date.fromisoformat(d) if d else None for d in (start, before))
        dates = [d for d in self.slices if (first is None or d >= first) and (last is None or d < last)]
        means, spreads = {}, {}
        for column in self.columns:
            n, mean, m2, _, _ = merged(self.slices[d][column] for d in dates)
            means[column], spreads[column] = mean, (math.sqrt(m2 / n) or 1.0) if n else None
        return ZScore(means, spreads)


# Largest statistics table (values) that is broadcast.
BROADCAST_VALUES = 4_000_000


def zscore_by(df: DataFrame, group: str, columns: list[str], max_groups: int | None = None) -> DataFrame:
    """Z-score within each group.

    Statistics are aggregated first (partial sums per task) and joined back, instead of a window per group: a month's
    cross-section can hold any share of the rows, and a window would put it into one task. ``df`` is read twice, so it
    should be a stored table. ``max_groups`` is a proven bound on the groups, e.g. the months between two dates; if the
    statistics are small by it they are broadcast and the rows of ``df`` never move.
    """
    stats = df.groupBy(group).agg(*_statistics(columns))
    if max_groups is not None and max_groups * 2 * len(columns) <= BROADCAST_VALUES:
        stats = F.broadcast(stats)
    joined = df.join(stats, group)
    return joined.select(
        *[F.expr(f"(`{c}` - `avg_{c}`) / `std_{c}` AS `{c}`") if c in columns else F.col(c) for c in df.columns]
    )
