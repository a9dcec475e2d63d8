"""Month ends computed from a ticker's rows as one array equal those of the daily windows."""

from __future__ import annotations

import datetime as dt
import random
import re

from tickfold.config import FIXTURE
from tickfold.functions.columns import MonthEnds, with_date_parts
from tickfold.operators import features
from tickfold.plans import panel as plans
from tickfold.session import configure
from tickfold.sources import files

SERIES = ["x", "y"]


def _daily(spark):
    """Two years of weekdays: a whole ticker, one with gaps, one of a few rows, one that misses values."""
    draw = random.Random(5)
    start = dt.date(2019, 1, 1)
    days = [d for d in (start + dt.timedelta(days=i) for i in range(730)) if d.weekday() < 5]
    rows = []
    for ticker, share in (("whole", 1.0), ("gaps", 0.99), ("few", 0.05), ("missing", 1.0)):
        for d in days:
            if draw.random() <= share:
                x = None if ticker == "missing" and draw.random() < 0.1 else draw.uniform(0.1, 9.0)
                rows.append((ticker, len(ticker), d, x, draw.uniform(0.1, 9.0), float(draw.randrange(9))))
    draw.shuffle(rows)
    return spark.createDataFrame(rows, "ticker string, simfinid long, date date, x double, y double, volume double")


def _schedule(spark):
    sessions = spark.sql("SELECT explode(sequence(DATE'2019-01-01', DATE'2020-12-30')) AS date").filter("weekday(date) < 5")
    return sessions.selectExpr("year(date) AS year", "month(date) AS month").groupBy("year", "month").count().withColumnRenamed("count", "cal_days_in_month")


def _lagged(daily, schedule):
    rolled = features.create_rolling_values(daily, ["x"], ["y"], ["volume"])
    return features.lagged_rolling_returns(rolled, schedule, ["x"], ["y"])


def test_month_ends_equal_daily_windows(spark):
    configure(spark)
    daily, schedule = with_date_parts(_daily(spark)), _schedule(spark)
    expected = features.month_end(_lagged(daily, schedule))
    found = features.month_end(_lagged(MonthEnds(daily), schedule))
    assert set(found.columns) == set(expected.columns)
    names = sorted(expected.columns)
    assert dict(found.dtypes) == dict(expected.dtypes)
    rows = [[str(r) for r in df.select(names).sort("ticker", "date").collect()] for df in (found, expected)]
    assert rows[0] == rows[1] and len(rows[0]) > 50
    lags = expected.filter("ticker = 'whole'").selectExpr(*[f"count({n}) AS {n}" for n in names if n.endswith("_lag")]).first()
    assert min(lags) > 5  # each lag is seen


def test_month_ends_without_a_schedule(spark):
    configure(spark)
    daily = with_date_parts(_daily(spark))
    outputs = ["ticker", "date", "roll_7day_sum_x", "roll_11day_avg_y", "roll_30day_med_volume"]
    of = lambda df: features.month_end(features.create_rolling_values(df, ["x"], ["y"], ["volume"])).select(outputs)
    found, expected = ([str(r) for r in of(df).sort("ticker", "date").collect()] for df in (MonthEnds(daily), daily))
    assert found == expected


def test_month_ends_need_no_daily_lags(spark):
    """One window by day is left, that of the first values; rows are put together by ticker without a second sort."""
    configure(spark)
    plan = plans.monthly_panel(spark.createDataFrame([], files.CLEAN_PANEL), FIXTURE)._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"[-+] Window \[", plan)) == 1 and "lag(" not in plan
    assert "SortAggregate(key=[ticker" in plan and len(re.findall(r"[-+] Sort \[", plan)) == 1
