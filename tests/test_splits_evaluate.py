from __future__ import annotations

import datetime as dt
import math
import statistics

import pytest

from tickfold.config import Fold, Settings
from tickfold.functions.scaling import ZScore, zscore_by
from tickfold.operators import evaluate, profile, splits

FOLDS = (Fold("2020-03-01", "2020-05-01", "2020-07-01"), Fold("2020-04-01", "2020-07-01", "2020-09-01"))


def monthly(spark, names=2):
    rows = [
        (dt.date(2020, m, 28), f"T{i}", float(m * (i + 1)), 1.0 + m / 10) for m in range(1, 13) for i in range(names)
    ]
    return spark.createDataFrame(rows, "date date, ticker string, x double, target_1m_mom_lead double")


def test_folds_are_ordered_and_apart(spark):
    out = splits.time_series_split(monthly(spark), "2020-09-01", FOLDS).collect()
    for number, fold in enumerate(FOLDS, start=1):
        train = {(r.date, r.ticker) for r in out if r.fold == number and r.role == "train"}
        test = {(r.date, r.ticker) for r in out if r.fold == number and r.role == "test"}
        assert train and test and not train & test
        assert max(d for d, _ in train) < dt.date.fromisoformat(fold.train_before) <= min(d for d, _ in test)
    assert len(out) == 2 * (2 + 2 + 3 + 2)
    assert max(r.date for r in out) < dt.date(2020, 9, 1)


def test_default_folds_leave_a_gap():
    for fold in Settings().folds:
        assert fold.train_before < fold.test_from < fold.test_to


def test_holdout_and_train_share_no_rows(spark):
    df = monthly(spark)
    assert splits.holdout_set(df, "2020-09-01").count() == 8 and splits.train_set(df, "2020-09-01").count() == 16
    assert splits.train_val_y(df, "2020-09-01").columns == ["date", "ticker", "target_1m_mom_lead"]


def test_scaling_uses_population_spread_and_keeps_constants(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0), (8.0, 5.0)], "x double, k double")
    out = ZScore.fit(df, ["x", "k"]).transform(df).orderBy("x").collect()
    spread = statistics.pstdev([1, 3, 8])
    assert [r.x for r in out] == pytest.approx([(v - 4) / spread for v in (1, 3, 8)])
    assert [r.k for r in out] == [0.0, 0.0, 0.0]


def test_train_features_are_scaled_without_the_target(spark):
    out = splits.train_val_x(monthly(spark), "2020-09-01")
    assert "target_1m_mom_lead" not in out.columns
    values = [r.x for r in out.collect()]
    assert statistics.fmean(values) == pytest.approx(0) and statistics.pstdev(values) == pytest.approx(1)


def test_zscore_by_group(spark):
    for bound in (12, None):
        out = zscore_by(monthly(spark), "date", ["x"], bound)
        assert all(abs(row.x) == pytest.approx(1) for row in out.collect())
    plan = zscore_by(monthly(spark), "date", ["x"], 12)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan


def predictions(spark):
    day, later = dt.date(2020, 1, 31), dt.date(2020, 2, 28)
    rows = [(day, t, 1.5, p) for t, p in (("c", 2.0), ("a", 2.0), ("b", 2.0), ("d", 3.0), ("e", None))]
    rows += [(later, "a", 2.0, 1.0), (later, "b", None, 2.0)]
    return spark.createDataFrame(rows, "date date, ticker string, target_1m_mom_lead double, predictions double")


def test_top_n_breaks_ties_by_ticker(spark):
    out = evaluate.rank_predictions(predictions(spark), 2).orderBy("date", "rank").collect()
    assert [r.ticker for r in out] == ["d", "a", "b", "a"]


def test_performance_compounds(spark):
    rows = evaluate.performance_summary(predictions(spark), 1).orderBy("date").collect()
    assert [r.market_rolling_return for r in rows] == [1.5, 3.0]
    # the best pick of February has no return yet
    assert [r.top_preds_returns for r in rows] == [1.5, None] and rows[1].top_preds_rolling_return == 1.5


def test_error_metrics(spark):
    df = spark.createDataFrame([(1.0, 2.0), (4.0, 2.0), (None, 9.0)], "target_1m_mom_lead double, predictions double")
    row = evaluate.error_metrics(df).first()
    assert row.rmse == pytest.approx(math.sqrt(2.5)) and row.mape == pytest.approx(0.75)


def test_quantiles_against_sorted_values(spark):
    values = sorted((i * 37) % 1009 / 7 for i in range(1000))
    df = spark.createDataFrame([(v,) for v in reversed(values)], "x double").repartition(5)
    row = profile.profile_quantiles(df, ["x"]).first()
    for name, q in profile.QUANTILES.items():
        assert row[name] == values[math.ceil(q * 1000) - 1], name
    rough = profile.profile_quantiles(df, ["x"], accuracy=100).first()
    for name, q in profile.QUANTILES.items():
        assert abs(values.index(rough[name]) - q * 1000) <= 11, name


def test_profiles(spark):
    df = spark.createDataFrame(
        [("a", 0.0, 1.0), ("a", -1.0, 2.0), ("b", 5.0, None), (None, None, 7.0), ("a", 0.0, 1.0)], "s string, x double, y double"
    )
    row = {r.column: r for r in profile.profile_numeric(df, ["x", "y"]).collect()}["x"]
    assert (row.n_rows, row.n_values, row.n_missing, row.n_zeros, row.n_negative) == (5, 4, 1, 2, 1)
    assert (row.min, row.max, row.mean) == (-1.0, 5.0, 1.0)
    top = profile.profile_topk(df, ["s"], 1).first()
    assert (top.column, top.value, top.n_rows, top["rank"]) == ("s", "a", 3, 1)
    exact = {r.column: r.n_distinct for r in profile.profile_distinct(df, ["s", "x"]).collect()}
    sketch = {r.column: r.n_distinct for r in profile.profile_distinct(df, ["s", "x"], rsd=0.01).collect()}
    assert exact == sketch == {"s": 2, "x": 3}
    assert [r.n_rows for r in profile.profile_duplicates(df).collect()] == [2]
    whole = df.dropna()
    narrow = profile.profile_corr(whole, ["x", "y"]).first().correlation
    assert profile.profile_corr_wide(whole, ["x", "y"]).first().correlation == pytest.approx(narrow)
