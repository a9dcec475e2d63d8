from __future__ import annotations

import datetime as dt
import statistics

import pytest

from tickfold import config as c
from tickfold.operators import features

START = dt.date(2020, 1, 1)


def series(spark, lengths: dict[str, int], column="x"):
    """Tickers with consecutive days and the values 1, 2, 3, ..."""
    rows = [
        (t, 1, START + dt.timedelta(days=i), float(i + 1), float(i + 1)) for t, n in lengths.items() for i in range(n)
    ]
    return spark.createDataFrame(rows, f"ticker string, simfinid long, date date, {column} double, volume double")


def test_rolling_needs_enough_rows(spark):
    df = features.create_rolling_values(
        series(spark, {"a": 6, "b": 7, "c": 10, "d": 11, "e": 31}), ["x"], ["x"], ["volume"]
    )
    last = {}
    for r in df.orderBy("ticker", "date").collect():
        last[r.ticker] = r
    assert last["a"].roll_7day_sum_x is None and last["b"].roll_7day_sum_x == 28 and last["b"].roll_7day_avg_x == 4
    assert last["c"].roll_11day_sum_x is None and last["d"].roll_11day_avg_x == 6
    assert last["c"].roll_30day_med_volume is None and last["d"].roll_30day_med_volume == 6
    assert last["e"].roll_30day_med_volume == statistics.median(range(2, 32))


def test_rolling_skips_missing_values(spark):
    rows = [("a", 1, START + dt.timedelta(days=i), None if i == 3 else 1.0) for i in range(12)]
    df = spark.createDataFrame(rows, "ticker string, simfinid long, date date, x double")
    got = [r.roll_7day_sum_x for r in features.create_rolling_values(df, ["x"], [], []).orderBy("date").collect()]
    assert got == [None] * 10 + [7.0, 7.0]


def test_index_is_relative_to_first_value(spark):
    rows = [("a", 1, START, None, 5.0), ("a", 1, START + dt.timedelta(days=1), 4.0, 10.0),
            ("a", 1, START + dt.timedelta(days=2), 8.0, 20.0),
            ("z", 2, START, 0.0, 1.0), ("z", 2, START + dt.timedelta(days=1), 3.0, 1.0)]
    df = spark.createDataFrame(rows, "ticker string, simfinid long, date date, adj_close double, p_b double")
    out = features.create_returns(df, ["p_b"]).orderBy("ticker", "date").collect()
    assert [r.return_index for r in out] == [None, 1.0, 2.0, None, None]  # a zero first value gives no index
    assert [r.p_b_index for r in out] == [1.0, 2.0, 4.0, 1.0, 1.0]


def panel_rows(spark, days: list[int], prior: list[int] | None = None):
    """One long ticker; row i has value i, and ``days_in_month`` as given (repeated for all rows if one)."""
    n = len(days)
    rows = [("a", 1, 2020, 1, START + dt.timedelta(days=i), days[i], float(i), float(i)) for i in range(n)]
    return spark.createDataFrame(
        rows,
        "ticker string, simfinid long, year int, month int, date date, days_in_month long, "
        "roll_7day_sum_x double, roll_11day_sum_x double",
    )


@pytest.mark.parametrize("days, back", [(18, None), (19, 16), (20, 17), (21, 18), (22, 19), (23, 20), (24, None)])
def test_one_month_lag(spark, days, back):
    last = features.lag_1m(panel_rows(spark, [days] * 40), ["x"], []).orderBy("date").collect()[-1]
    assert last.roll_7day_sum_x_1m_lag == (None if back is None else 39.0 - back)


def test_three_month_lag_for_all_month_lengths(spark):
    from tickfold.plans.oracle import LAG_3M

    rows, expected = [], {}
    for this in range(18, 25):
        for prior in range(18, 25):
            ticker = f"{this}-{prior}"
            days = [prior] * 80 + [this]
            days[80 - 47] = prior
            rows += [(ticker, 1, 2020, 1, START + dt.timedelta(days=i), d, float(i)) for i, d in enumerate(days)]
            known = this in LAG_3M and 19 <= prior <= 23
            expected[ticker] = 80.0 - LAG_3M[this][prior - 19] if known else None
    df = spark.createDataFrame(
        rows, "ticker string, simfinid long, year int, month int, date date, days_in_month long, roll_11day_sum_x double"
    )
    out = features.lag_3m(df, ["x"], []).filter("date = date'2020-03-21'").collect()
    assert {r.ticker: r.roll_11day_sum_x_3m_lag for r in out} == expected


def test_fixed_lags_count_rows(spark):
    df = panel_rows(spark, [21] * 260)
    six = features.lag_6m(df, ["x"], []).orderBy("date").collect()[-1]
    year = features.lag_12m(df, ["x"], []).orderBy("date").collect()[-1]
    assert six.roll_11day_sum_x_6m_lag == 259 - 121 and year.roll_11day_sum_x_12m_lag == 259 - 247


def test_incomplete_months_are_dropped_and_lags_skip_them(spark):
    days = [dt.date(2020, m, d) for m, last in ((1, 19), (2, 19), (3, 18)) for d in range(1, last + 1)]
    rows = [("a", 1, d, float(i), float(i), float(i)) for i, d in enumerate(days)]
    df = spark.createDataFrame(
        rows, "ticker string, simfinid long, date date, roll_7day_sum_x double, roll_11day_sum_x double, y double"
    )
    schedule = spark.createDataFrame([(2020, 1, 19), (2020, 2, 19), (2020, 3, 19)], "year int, month int, cal_days_in_month long")
    out = features.lagged_rolling_returns(df, schedule, ["x"], []).orderBy("date").collect()
    assert len(out) == 38 and out[-1].roll_7day_sum_x_1m_lag == 37 - 16
    ends = features.month_end(features.complete_months(df, schedule)).orderBy("date").collect()
    assert [str(r.date) for r in ends] == ["2020-01-19", "2020-02-19"]


def test_month_end_sees_same_month_of_another_year(spark):
    rows = [("a", 1, dt.date(2019, 5, 31), 1.0), ("a", 1, dt.date(2020, 5, 4), 1.0), ("a", 1, dt.date(2020, 5, 5), 1.0)]
    df = spark.createDataFrame(rows, "ticker string, simfinid long, date date, roll_30day_med_volume double")
    assert [str(r.date) for r in features.month_end(df).orderBy("date").collect()] == ["2019-05-31", "2020-05-05"]
    assert features.get_monthly(df, 1.0).count() == 0


def test_momentum_lags_and_target(spark):
    ends = [dt.date(2020, m, 28) for m in range(1, 6)]
    rows = [("a", d, 2.0 * i, 2.0 if i else 0.0) for i, d in enumerate(ends)]
    df = spark.createDataFrame(rows, "ticker string, date date, num double, den double")
    out = features.create_momentum_factors(df, ["ticker", "date"], [("return_mom_1_0", "num", "den")], ["return_mom_1_0"], 3)
    rows = out.orderBy("date").collect()
    assert [r.return_mom_1_0 for r in rows] == [None, 1.0, 2.0, 3.0, 4.0]  # a zero denominator gives NULL
    assert [r.return_mom_1_0_L2 for r in rows] == [None, None, None, 1.0, 2.0]
    data = features.create_modeling_data(out, [], "2020-05-28").orderBy("date").collect()
    assert [(str(r.date), r.target_1m_mom_lead) for r in data] == [("2020-04-28", 4.0), ("2020-05-28", None)]
    # a name whose last row is not the current date has no known future: dropped
    gone = features.create_modeling_data(out, [], "2020-06-28").collect()
    assert [str(r.date) for r in gone] == ["2020-04-28"]


def test_column_lists():
    assert len(c.momentum_inputs()) == 29 and len(c.modeling_drops()) == 22 and len(c.momentum_ratios()) == 12
    assert len(c.model_features()) == 89 and len(set(c.model_features())) == 89
