from __future__ import annotations

import datetime as dt

import pytest

from tickfold.operators import calendar


def sessions(spark, start, end, **options):
    return [r.date for r in calendar.trading_calendar(calendar.span(spark, start, end), **options).collect()]


@pytest.mark.parametrize("year, count", [(2001, 248), (2012, 250), (2018, 251), (2020, 253), (2021, 252), (2022, 251)])
def test_sessions_per_year(spark, year, count):
    assert len(sessions(spark, f"{year}-01-01", f"{year}-12-31")) == count


def test_moved_and_unmoved_holidays(spark):
    days = set(sessions(spark, "2010-12-01", "2022-12-31"))
    for closed in ("2021-04-02", "2019-04-19", "2021-12-24", "2022-06-20", "2017-01-02", "2020-07-03", "2012-10-29"):
        assert dt.date.fromisoformat(closed) not in days, closed
    # New Year's Day 2011 and 2022 fell on a Saturday and were not moved; no Juneteenth before 2022
    for traded in ("2010-12-31", "2021-12-31", "2021-06-18", "2019-06-19"):
        assert dt.date.fromisoformat(traded) in days, traded


def test_without_holidays_every_weekday_counts(spark):
    assert len(sessions(spark, "2021-01-01", "2021-01-10", holidays=False)) == 6


def test_schedule_and_periods(spark):
    days = calendar.trading_calendar(calendar.span(spark, "2021-07-01", "2021-12-31"))
    counts = {(r.year, r.month): r.cal_days_in_month for r in calendar.market_schedule(days).collect()}
    assert counts[(2021, 7)] == 21 and counts[(2021, 12)] == 22
    rows = calendar.market_dates(days, "2021-09-30").orderBy("month_end_date").collect()
    assert [str(r.month_end_date) for r in rows] == ["2021-07-30", "2021-08-31", "2021-09-30"]
    assert str(rows[-1].period_start_date) == "2021-10-01" and str(rows[-1].period_end_date) == "2021-11-01"


def test_month_count():
    assert calendar.month_count("2020-02-01", "2021-12-31") == 23
