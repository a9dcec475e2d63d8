"""Inputs -> clean panel -> modeling table, composed from the operators."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tickfold import config as c
from tickfold.config import Settings
from tickfold.functions.columns import Daily, MonthEnds
from tickfold.operators import calendar, clean, features


def clean_panel(inputs: dict[str, DataFrame], validate: bool = True, clustered: bool = False) -> DataFrame:
    raw = clean.join_data(
        inputs["companies"], inputs["industries"], inputs["prices"], inputs["ratios"], validate, clustered
    )
    return clean.intro_clean_data(raw)


def filtered_panel(panel: DataFrame, settings: Settings) -> DataFrame:
    sized = clean.filter_data(clean.market_cap(panel))
    return clean.filter_dates(sized, settings.start_date, settings.current_date)


# what month ends keep of a daily row
MONTHLY_COLUMNS = ("ticker", "simfinid", "date", "year", "month", "day", "sector", "market_cap", "market_cap_cat", "volume", "p_b", "p_fcf_ttm",
                   "return_index", "p_b_index", "p_fcf_ttm_index")


def rolled_panel(panel: DataFrame, settings: Settings, ends_only: bool = False) -> Daily:
    """Rolling values of every day, or noted for the month ends alone."""
    indexed = features.create_returns(filtered_panel(panel, settings), c.CHANGE_INDEX)
    if ends_only:
        indexed = MonthEnds(indexed.select(*MONTHLY_COLUMNS))
    return features.create_rolling_values(indexed, c.SUM_COLUMNS, c.AVG_COLUMNS, c.MEDIAN_COLUMNS)


def schedule(panel: DataFrame, settings: Settings) -> DataFrame:
    bounds = calendar.span(panel.sparkSession, settings.start_date, settings.current_date)
    return calendar.market_schedule(calendar.trading_calendar(bounds, settings.holidays))


def lagged_panel(panel: DataFrame, settings: Settings, ends_only: bool = False) -> Daily:
    return features.lagged_rolling_returns(
        rolled_panel(panel, settings, ends_only), schedule(panel, settings), c.SUM_COLUMNS, c.AVG_COLUMNS
    )


def monthly_panel(panel: DataFrame, settings: Settings) -> DataFrame:
    return features.get_monthly(lagged_panel(panel, settings, ends_only=True), settings.volume_floor)


def momentum_panel(panel: DataFrame, settings: Settings) -> DataFrame:
    return features.create_momentum_factors(
        monthly_panel(panel, settings),
        c.momentum_inputs(),
        c.momentum_ratios(),
        [c.momentum_name(n, 1) for n in c.MOMENTUM_SERIES],
        settings.lag_range,
    )


def modeling_data(panel: DataFrame, settings: Settings) -> DataFrame:
    return features.create_modeling_data(
        momentum_panel(panel, settings), c.modeling_drops(), settings.current_date
    )
