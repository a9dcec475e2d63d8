"""From the filtered daily panel to the modeling table.

All daily steps share one partitioning by ticker; rolling values and lags share ``PANEL_ORDER``, one sort. A ticker has at most
one row per session (checked when the inputs are joined), so its group is bounded by the calendar, not by the size of the panel.
Rolling values, complete months and lags also take ``MonthEnds`` in place of a table, for callers of ``month_end``.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from tickfold.config import TARGET, rolling_name
from tickfold.functions.columns import (
    DAY_ORDER,
    MONTH_ORDER,
    PANEL_ORDER,
    Daily,
    MonthEnds,
    first_value_index,
    lag_column,
    with_date_parts,
    with_lags_by,
    with_rolling,
)

SHORT, LONG, MEDIAN, MEDIAN_MIN = 7, 11, 30, 11
# Rows per month the lag rules know; other months get NULL.
MONTH_LENGTHS = range(19, 24)
HALF_YEAR_ROWS, YEAR_ROWS, PRIOR_MONTH_ROWS = 121, 247, 47


def create_returns(panel: DataFrame, change_index: Sequence[str]) -> DataFrame:
    """Adds ``return_index`` and ``<column>_index``: each value relative to the ticker's first."""
    return with_date_parts(panel).withColumns(
        {
            "return_index": first_value_index("adj_close", DAY_ORDER),
            **{f"{c}_index": first_value_index(c, DAY_ORDER) for c in change_index},
        }
    )


def create_rolling_values(
    returns: Daily, sum_columns: Sequence[str], avg_columns: Sequence[str], median_columns: Sequence[str]
) -> Daily:
    """Rolling sums and means over 7 and 11 rows, rolling medians over 30 rows (at least 11)."""
    out = {}
    for days in (SHORT, LONG):
        for c in sum_columns:
            out[rolling_name(days, f"sum_{c}")] = ("sum", c, days, days)
        for c in avg_columns:
            out[rolling_name(days, f"avg_{c}")] = ("avg", c, days, days)
    for c in median_columns:
        out[f"roll_{MEDIAN}day_med_{c}"] = ("median", c, MEDIAN, MEDIAN_MIN)
    return with_rolling(returns if isinstance(returns, MonthEnds) else with_date_parts(returns), out)


def days_in_month(panel: DataFrame) -> DataFrame:
    """Adds the number of rows the ticker has in the row's month."""
    per_month = Window.partitionBy("ticker", "year", "month")
    return with_date_parts(panel).withColumn("days_in_month", F.count("day").over(per_month))


def complete_months(panel: Daily, schedule: DataFrame) -> Daily:
    """Months in which the ticker traded on every session.

    The schedule has one row per calendar month, so it is broadcast whatever the size of the panel.
    """
    if isinstance(panel, MonthEnds):
        return replace(panel, daily=panel.daily.join(F.broadcast(schedule), ["year", "month"], "left"), complete=True)
    return (
        days_in_month(panel)
        .join(F.broadcast(schedule), ["year", "month"], "left")
        .filter(F.col("days_in_month") == F.col("cal_days_in_month"))
    )


def _rolled(sum_columns: Iterable[str], avg_columns: Iterable[str]) -> list[str]:
    return [f"sum_{c}" for c in sum_columns] + [f"avg_{c}" for c in avg_columns]


def lag_1m(df: Daily, sum_columns: Sequence[str], avg_columns: Sequence[str]) -> Daily:
    """One month back for the 7-day values: three rows less than the month has (19 to 23 rows)."""
    outputs = {f"{rolling_name(SHORT, s)}_1m_lag": rolling_name(SHORT, s) for s in _rolled(sum_columns, avg_columns)}
    return with_lags_by(df, outputs, "days_in_month - 3", [d - 3 for d in MONTH_LENGTHS])


def offset_3m(this: str, prior: str) -> str:
    """Rows back for the three-month lag, from the lengths of this month and of the month 47 rows back."""
    low, high = MONTH_LENGTHS[0], MONTH_LENGTHS[-1]
    known = f"{this} BETWEEN {low} AND {high} AND {prior} BETWEEN {low} AND {high}"
    return f"CASE WHEN {known} THEN {this} + 36 + greatest(0, {prior} - 21) END"


def lag_3m(df: Daily, sum_columns: Sequence[str], avg_columns: Sequence[str]) -> Daily:
    """Three months back for the 11-day values."""
    outputs = {f"{rolling_name(LONG, s)}_3m_lag": rolling_name(LONG, s) for s in _rolled(sum_columns, avg_columns)}
    return with_lags_by(
        df,
        outputs,
        offset_3m("days_in_month", "_prior"),
        range(MONTH_LENGTHS[0] + 36, MONTH_LENGTHS[-1] + 36 + 3),
        _prior=("days_in_month", PRIOR_MONTH_ROWS),
    )


def _fixed_lag(df: Daily, sum_columns, avg_columns, rows: int, suffix: str) -> Daily:
    outputs = {f"{rolling_name(LONG, s)}_{suffix}_lag": rolling_name(LONG, s) for s in _rolled(sum_columns, avg_columns)}
    if isinstance(df, MonthEnds):
        return with_lags_by(df, outputs, str(rows), [rows])
    return df.withColumns({out: lag_column(c, rows) for out, c in outputs.items()})


def lag_6m(df: Daily, sum_columns: Sequence[str], avg_columns: Sequence[str]) -> Daily:
    return _fixed_lag(df, sum_columns, avg_columns, HALF_YEAR_ROWS, "6m")


def lag_12m(df: Daily, sum_columns: Sequence[str], avg_columns: Sequence[str]) -> Daily:
    return _fixed_lag(df, sum_columns, avg_columns, YEAR_ROWS, "12m")


def lagged_rolling_returns(
    rolled: Daily, schedule: DataFrame, sum_columns: Sequence[str], avg_columns: Sequence[str]
) -> Daily:
    """Complete months only, with the 1-, 3-, 6- and 12-month lags. Lags count remaining rows, not calendar days."""
    df = complete_months(rolled, schedule)
    for step in (lag_1m, lag_3m, lag_6m, lag_12m):
        df = step(df, sum_columns, avg_columns)
    return df


def month_end(daily: Daily) -> DataFrame:
    """Last row of each ticker and month: the row whose successor lies in another month."""
    if isinstance(daily, MonthEnds):
        return daily.rows()
    df = with_date_parts(daily).withColumns(
        {name: F.expr(f"lead({name[5:]}) OVER ({PANEL_ORDER})") for name in ("next_year", "next_month")}
    )
    return df.filter("next_month IS NULL OR next_month != month OR next_year != year").drop("next_year", "next_month")


def get_monthly(daily: Daily, volume_floor: float) -> DataFrame:
    """Month-end rows of liquid names (30-day median volume above the floor)."""
    return month_end(daily).filter(F.col("roll_30day_med_volume") > volume_floor)


def create_momentum_factors(
    monthly: DataFrame,
    features: Sequence[str],
    ratios: Sequence[tuple[str, str, str]],
    lagged: Sequence[str],
    lag_range: int,
) -> DataFrame:
    """Ratios (output, numerator, denominator) and row lags ``1 .. lag_range - 1`` of the ``lagged`` outputs."""
    quotients = [f"try_divide({numerator}, {denominator}) AS {out}" for out, numerator, denominator in ratios]
    factors = monthly.select(*features, *map(F.expr, quotients))
    lags = [f"lag({c}, {k}) OVER ({MONTH_ORDER}) AS {c}_L{k}" for c in lagged for k in range(1, lag_range)]
    return factors.selectExpr("*", *lags)


def lead_target(momentum: DataFrame, target: str = TARGET) -> DataFrame:
    """Adds next month's one-month momentum, taken before any row is dropped."""
    return momentum.withColumn(target, F.expr(f"lead(return_mom_1_0) OVER ({MONTH_ORDER})"))


def create_modeling_data(
    momentum: DataFrame, drop_columns: Sequence[str], current_date: str, target: str = TARGET
) -> DataFrame:
    """Modeling table: every feature present; the target may be missing only on ``current_date``."""
    df = lead_target(momentum.drop(*drop_columns), target)
    df = df.na.drop("any", subset=[c for c in df.columns if c != target])
    return df.filter(F.col(target).isNotNull() | (F.col("date") == F.lit(current_date).cast("date")))
