"""Exact quantiles read and sketch no more than they need."""

import statistics

import pytest
from pyspark.sql import functions as F

from tickfold.operators import profile


@pytest.mark.parametrize("n", [1, 9, 400])
def test_quantiles_sketch_a_column_once(spark, monkeypatch, n):
    made, whole = [], F.percentile_approx
    monkeypatch.setattr(F, "percentile_approx", lambda *a: made.append(a) or whole(*a))
    xs = [float((i * 7919) % 1009) for i in range(n)]
    df = spark.createDataFrame([(x, -x if i % 3 else None) for i, x in enumerate(xs)], "a double, b double")
    found = {r["column"]: r for r in profile.profile_quantiles_exact(df, ["a", "b"]).collect()}
    cuts = statistics.quantiles(xs, n=20, method="inclusive") if n > 1 else xs * 19
    assert [found["a"][q] for q in ("p05", "p25", "p50", "p75", "p95")] == pytest.approx([cuts[i] for i in (0, 4, 9, 14, 18)])
    assert len(made) <= 2
