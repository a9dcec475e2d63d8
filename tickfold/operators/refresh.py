"""A new month in the modeling table, computed from a small state and the month's rows alone.

Every feature looks back a fixed number of rows of its ticker, so those rows are all that a refresh needs of the past: the
ticker's first row (change indices), its last 29 rows (rolling values), its last 247 rows of complete months (lags), its last
24 month ends (monthly lags) and its last month end, whose target the next month end decides. A refresh runs the very
operators of the whole run over state and new rows together and keeps what is new. Rows that are closed, with their target
known, are appended and never change; rows that still wait for one are part of the state.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, fields

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickfold import config as c
from tickfold.config import TARGET, Settings
from tickfold.functions.columns import DAY_ORDER, MONTH_ORDER, PANEL_ORDER
from tickfold.operators import features

#: Rows of its ticker that a rolling value, a lag and a monthly lag look back over.
ROLLED_ROWS, LAGGED_ROWS = features.MEDIAN - 1, features.YEAR_ROWS
FRESH = "is_fresh"

# What is looked back on: by change indices, rolling values, lags and monthly lags.
FIRST = ("ticker", "simfinid", "date", "adj_close", *c.CHANGE_INDEX)
ROLLED = ("return_index", *(f"{n}_index" for n in c.CHANGE_INDEX))
RECENT = ("ticker", "simfinid", "date", "year", "month", "day", *c.MEDIAN_COLUMNS, *ROLLED)
COMPLETE = ("ticker", "simfinid", "date", "year", "month", "days_in_month",
            *(c.rolling_name(days, series) for days in (features.SHORT, features.LONG) for series in c.MOMENTUM_SERIES.values()))
LAGGED = [c.momentum_name(n, 1) for n in c.MOMENTUM_SERIES]
MONTHLY = ("ticker", "date", *(n for out, *terms in c.momentum_ratios() if out in LAGGED for n in terms))


@dataclass(frozen=True)
class State:
    """What the past leaves for the next month; each table has a bounded number of rows per ticker."""

    #: first filtered row
    first: DataFrame
    #: last rows before the complete-month filter, with change indices
    recent: DataFrame
    #: last rows of complete months, with rolling values
    complete: DataFrame
    #: last month ends of liquid names
    monthly: DataFrame
    #: last month end with all its features, still without a target
    waiting: DataFrame


def save_state(state: State, path: str) -> None:
    """One folder per table below ``path``."""
    for f in fields(state):
        getattr(state, f.name).write.parquet(f"{path}/{f.name}")


def load_state(spark: SparkSession, path: str) -> State:
    return State(**{f.name: spark.read.parquet(f"{path}/{f.name}") for f in fields(State)})


def _last(df: DataFrame, rows: int, order: str = MONTH_ORDER) -> DataFrame:
    """The last ``rows`` rows of each ticker."""
    return df.withColumn("_in", F.expr(_from_end(rows, order))).filter("_in").drop("_in")


def _from_end(rows: int, order: str) -> str:
    """SQL: whether a row is one of the last ``rows`` of its ticker. It takes the order of the windows beside it."""
    return f"lead(true, {rows}) OVER ({order}) IS NULL"


def _with_past(past: DataFrame | None, new: DataFrame) -> DataFrame:
    """Past and new rows, the new ones marked. The past has only the columns that windows look back on."""
    fresh = new.withColumn(FRESH, F.lit(True))
    return fresh if past is None else fresh.unionByName(past.withColumn(FRESH, F.lit(False)), allowMissingColumns=True)


def _fresh(df: DataFrame) -> DataFrame:
    return df.filter(FRESH).drop(FRESH)


def _whole(df: DataFrame) -> Column:
    """Whether a row has every feature."""
    whole = F.lit(True)
    for name in df.columns:
        if name != TARGET:
            whole = whole & F.col(name).isNotNull()
    return whole


def refreshed(
    state: State | None, new: DataFrame, schedule: DataFrame, settings: Settings, keep: Callable[[DataFrame, str], DataFrame]
) -> tuple[State, DataFrame]:
    """(next state, rows to append) from ``new``, the filtered panel rows of whole months after those of ``state``.

    Without a state all of ``new`` is the past's first load. ``schedule`` has the sessions of the new months at least. ``keep``
    writes what is left of the daily rows (a ticker's first and last ones and its month ends) and the modeling rows; daily rows
    as such are never written, so ``new`` is computed twice. The next state reads the written tables and those of ``state``,
    until :func:`save_state` makes it stand alone.
    """
    past = {f.name: getattr(state, f.name) if state else None for f in fields(State)}

    def so_far(name: str, after: DataFrame) -> DataFrame:
        return after if past[name] is None else past[name].unionByName(after)

    returns = _fresh(features.create_returns(_with_past(past["first"], new), c.CHANGE_INDEX))
    marks = {"_first": f"lag(true, 1) OVER ({DAY_ORDER}) IS NULL", "_recent": _from_end(ROLLED_ROWS, DAY_ORDER)}
    edges = returns.select(*dict.fromkeys([*FIRST, *RECENT])).withColumns({name: F.expr(text) for name, text in marks.items()})
    edges = keep(edges.filter("_first OR _recent"), "edges")
    first = so_far("first", edges.filter("_first").select(*FIRST))
    by_date = Window.partitionBy("ticker").orderBy("date")
    first = first.withColumn("_at", F.row_number().over(by_date)).filter("_at = 1").drop("_at")
    recent = _last(so_far("recent", edges.filter("_recent").select(*RECENT)), ROLLED_ROWS, DAY_ORDER)

    daily = returns.select(*dict.fromkeys([*RECENT, *(n for n in c.momentum_inputs() if n in returns.columns)]))
    rolled = features.create_rolling_values(_with_past(past["recent"], daily), c.SUM_COLUMNS, c.AVG_COLUMNS, c.MEDIAN_COLUMNS)
    lagged = _with_past(past["complete"], features.complete_months(_fresh(rolled), schedule))
    for step in (features.lag_1m, features.lag_3m, features.lag_6m, features.lag_12m):
        lagged = step(lagged, c.SUM_COLUMNS, c.AVG_COLUMNS)
    month = "year * 12 + month"
    marks = {"_end": f"NOT (lead({month}) OVER ({PANEL_ORDER}) <=> {month})", "_tail": _from_end(LAGGED_ROWS, PANEL_ORDER)}
    rows = _fresh(lagged).withColumns({name: F.expr(text) for name, text in marks.items()}).filter("_end OR _tail")
    # of the last rows only what lags read
    others = [n for n in c.momentum_inputs() if n not in COMPLETE]
    rows = rows.select(*COMPLETE, *marks, *[F.when(F.col("_end"), F.col(n)).alias(n) for n in others])
    rows = keep(rows, "complete")
    complete = _last(so_far("complete", rows.filter("_tail").select(*COMPLETE)), LAGGED_ROWS, PANEL_ORDER)
    ends = features.get_monthly(rows.filter("_end").drop(*marks), settings.volume_floor).select(*c.momentum_inputs())

    monthly = _with_past(past["monthly"], ends)
    factors = features.create_momentum_factors(monthly, [*c.momentum_inputs(), FRESH], c.momentum_ratios(), LAGGED, settings.lag_range)
    made = _fresh(factors).drop(*c.modeling_drops())
    targets = features.lead_target(so_far("waiting", made)).withColumn("_last", F.expr(f"lead(date) OVER ({MONTH_ORDER}) IS NULL"))
    closes = _whole(targets.drop("_last")) & F.col(TARGET).isNotNull()
    targets = keep(targets.filter(F.col("_last") | closes), "targets")
    waiting = targets.filter("_last").drop("_last", TARGET)
    closed = targets.filter(~F.col("_last")).drop("_last")

    monthly = _last(so_far("monthly", ends.select(*MONTHLY)), settings.lag_range - 1)
    return State(first, recent, complete, monthly, waiting), closed


def open_rows(state: State, settings: Settings) -> DataFrame:
    """The rows of the current date: all features, the target still to come."""
    rows = state.waiting.drop(*c.modeling_drops()).withColumn(TARGET, F.lit(None).cast("double"))
    return rows.filter((F.col("date") == F.lit(settings.current_date).cast("date")) & _whole(rows))
