from __future__ import annotations

import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickfold.functions.scaling import MomentTable, ZScore, expanding, merged, moments_by, totalled
from tickfold.operators import profile

COLUMNS = ["a", "far", "flat", "holes", "none"]


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(5)
    out = []
    for day in range(12):
        for i in range(int(rng.integers(1, 40))):
            holes = None if rng.random() < 0.4 or day == 3 else float(rng.normal())
            out.append((dt.date(2020, 1, 1) + dt.timedelta(days=day), float(rng.normal()), 1e9 + float(rng.normal()), 0.1, holes, None))
    return spark.createDataFrame(out, "date date, a double, far double, flat double, holes double, none double").persist()


def check(found, values):
    """Moments against numpy."""
    n, mean, m2, low, high = found
    values = [v for v in values if v is not None]
    assert n == len(values)
    if n:
        assert (low, high) == (min(values), max(values)) and mean == pytest.approx(np.mean(values), rel=1e-12)
        assert m2 == pytest.approx(np.var(values) * n, rel=1e-6, abs=1e-12)
    else:
        assert mean is None


def test_expanding_moments_equal_brute_force(spark, rows):
    held = rows.collect()
    found = expanding(moments_by(rows.repartition(5), COLUMNS)).collect()
    assert len(found) == 12 * len(COLUMNS)
    for r in found:
        check((r.n, r["mean"], r.m2, r.low, r.high), [h[r.column] for h in held if h.date <= r.date])
        if r.column == "flat":
            assert r["mean"] == 0.1 and r.m2 == 0.0


def test_totals_equal_brute_force(rows):
    held = rows.collect()
    for r in totalled(moments_by(rows, COLUMNS), "date").collect():
        check((r.n, r["mean"], r.m2, r.low, r.high), [h[r.column] for h in held])


def test_scalers_of_any_span_equal_fitted_ones(rows):
    table = MomentTable.fit(rows, COLUMNS)
    for start, before in ((None, None), ("2020-01-04", None), (None, "2020-01-06"), ("2020-01-04", "2020-01-05"), ("2020-01-03", "2020-01-09")):
        some = rows.filter((F.col("date") >= (start or "1900-01-01")) & (F.col("date") < (before or "2100-01-01")))
        got, want = table.scale(start, before), ZScore.fit(some, COLUMNS)
        for c in COLUMNS:
            if want.means[c] is None:
                assert got.means[c] is None
                continue
            assert got.means[c] == pytest.approx(want.means[c], rel=1e-12)
            # far from zero the squares lose digits in either way
            assert got.spreads[c] == pytest.approx(want.spreads[c], rel=1e-6)
    assert table.scale(before="1990-01-01").means["a"] is None


def test_merging_keeps_digits():
    far = [(1, 1e15 + k, 0.0, 1e15 + k, 1e15 + k) for k in range(100)]
    n, mean, m2, low, high = merged(far)
    assert (n, low, high) == (100, 1e15, 1e15 + 99) and mean == pytest.approx(1e15 + 49.5, rel=1e-15)
    assert math.sqrt(m2 / n) == pytest.approx(np.std(np.arange(100)), rel=1e-9)


def test_merged_profile_equals_the_whole_one(spark, rows):
    parts = profile.profile_parts(rows, COLUMNS, F.month("date") * 100 + F.dayofmonth("date") % 3)
    assert parts.count() == 3 * len(COLUMNS)
    got = {r.column: r for r in profile.profile_merged(parts).collect()}
    for r in profile.profile_numeric(rows, COLUMNS).collect():
        own = got[r.column]
        for name in ("n_rows", "n_values", "n_missing", "n_zeros", "n_negative", "min", "max"):
            assert own[name] == r[name]
        for name in ("mean", "std"):
            assert own[name] is r[name] is None or own[name] == pytest.approx(r[name], rel=1e-9)


def test_distinct_sketch_is_close_and_mergeable(spark):
    df = spark.range(60_000).selectExpr("CAST(id % 20000 AS DOUBLE) AS x", "CAST(id % 7 AS INT) AS year")
    parts = profile.profile_parts(df, ["x"], F.col("year"))
    whole = profile.profile_merged(parts).first().about_distinct
    assert whole == pytest.approx(20_000, rel=0.05)
    # a new part costs that part alone: the stored rows of the others are enough
    again = profile.profile_merged(parts.filter("part < 6").unionByName(parts.filter("part = 6"))).first().about_distinct
    assert again == pytest.approx(whole, rel=0.02)


@pytest.mark.parametrize(("picked", "accuracy"), [(20_000, 10_000), (60, 40)])
def test_exact_quantiles(spark, monkeypatch, picked, accuracy):
    """Against numpy, also where brackets must be narrowed again and again."""
    monkeypatch.setattr(profile, "PICKED", picked)
    rng = np.random.default_rng(6)
    n = 3000
    data = {
        "normal": rng.normal(size=n),
        "heavy": np.where(rng.random(n) < 0.4, 5.0, rng.integers(0, 50, n).astype(float)),
        "wide": 10.0 ** rng.uniform(-200, 200, n) * rng.choice([-1, 1], n),
        "flat": np.full(n, 0.3),
    }
    rows = [tuple(float(data[c][i]) for c in data) + (float(i) if i < 7 else None, None) for i in range(n)]
    names = [*data, "few", "none"]
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in names)).repartition(3).persist()
    got = {r.column: r for r in profile.profile_quantiles_exact(df, names, accuracy).collect()}
    assert list(got["none"])[1:] == [None] * 5
    for c in names[:-1]:
        values = np.array([r[names.index(c)] for r in rows if r[names.index(c)] is not None])
        for name, q in profile.QUANTILES.items():
            assert got[c][name] == pytest.approx(np.quantile(values, q), rel=1e-12)
