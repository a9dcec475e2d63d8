from __future__ import annotations

import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from tickfold.config import FIXTURE as S
from tickfold.operators import features, refresh, splits
from tickfold.plans import panel as plans
from tickfold.session import configure, stage
from tickfold.sources import testdata


@pytest.fixture(scope="module")
def dated(spark):
    """The filtered panel, with a ticker that is listed late and one that pauses for months."""
    configure(spark)
    panel = plans.filtered_panel(plans.clean_panel(testdata.inputs(spark, SMALL), clustered=True), S)
    late, pause = "ticker = 'S3' AND date < '1996-03-11'", "ticker = 'S4' AND date BETWEEN '2001-03-01' AND '2001-08-20'"
    return stage(panel.filter(f"NOT ({late}) AND NOT ({pause})"), "dated")


def whole(spark, dated):
    schedule = plans.schedule(dated, S)
    from tickfold import config as c

    rolled = features.create_rolling_values(features.create_returns(dated, c.CHANGE_INDEX), c.SUM_COLUMNS, c.AVG_COLUMNS, c.MEDIAN_COLUMNS)
    monthly = features.get_monthly(features.lagged_rolling_returns(rolled, schedule, c.SUM_COLUMNS, c.AVG_COLUMNS), S.volume_floor)
    factors = features.create_momentum_factors(
        monthly, c.momentum_inputs(), c.momentum_ratios(), [c.momentum_name(n, 1) for n in c.MOMENTUM_SERIES], S.lag_range
    )
    return features.create_modeling_data(factors, c.modeling_drops(), S.current_date)


def test_refreshed_month_by_month_equals_the_whole_run(spark, dated, tmp_path):
    want = {(r.date, r.ticker): r for r in whole(spark, dated).collect()}
    cuts = [S.start_date, "2001-02-01", "2001-08-01", "2001-09-01", "2001-11-01"]
    schedule, state, got = plans.schedule(dated, S), None, {}
    for i, (start, end) in enumerate(zip(cuts, cuts[1:])):
        state, closed = refresh.refreshed(state, splits.slice_between(dated, start, end), schedule, S, stage)
        rows = {(r.date, r.ticker): r for r in closed.collect()}
        assert not rows.keys() & got.keys()  # a closed row is appended once and never changes
        got |= rows
        path = str(tmp_path / f"state-{i}")
        refresh.save_state(state, path)
        state = refresh.load_state(spark, path)
    got |= {(r.date, r.ticker): r for r in refresh.open_rows(state, S).collect()}
    assert got.keys() == want.keys() and len(want) > 200
    for key, row in want.items():
        for name, value in row.asDict().items():
            other = got[key][name]
            assert other == (pytest.approx(value, rel=1e-9) if isinstance(value, float) else value)
    # the state is bounded per ticker, whatever the history
    for table, most in (("first", 1), ("recent", 29), ("complete", 247), ("monthly", 24), ("waiting", 1)):
        counts = getattr(state, table).groupBy("ticker").count().agg(F.max("count")).first()[0]
        assert counts == most


def test_a_refresh_reads_no_old_rows(spark, dated, tmp_path):
    """The plan of a refresh scans the state and the new rows alone."""
    schedule = plans.schedule(dated, S)
    state, _ = refresh.refreshed(None, splits.slice_between(dated, S.start_date, "2001-10-01"), schedule, S, stage)
    new = stage(splits.slice_between(dated, "2001-10-01", "2001-11-01"), "october")
    read = []

    def keep(df, name):
        read.extend(df.inputFiles())
        return stage(df, name)

    refresh.refreshed(state, new, schedule, S, keep)
    old = set(dated.inputFiles())
    assert read and not old & set(read)


def test_no_daily_table_is_written(spark, dated):
    """A first load writes a bounded number of rows a ticker beside its month ends, however long the history."""
    kept = {}

    def keep(df, name):
        kept[name] = stage(df, name)
        return kept[name]

    new = splits.slice_between(dated, S.start_date, "2001-10-01")
    refresh.refreshed(None, new, plans.schedule(dated, S), S, keep)
    most = {name: df.groupBy("ticker").count().agg(F.max("count")).first()[0] for name, df in kept.items()}
    assert most["edges"] <= 30 and most["complete"] <= 247 + 80 and most["targets"] <= 80
    assert sum(df.count() for df in kept.values()) < new.count() / 2
    assert kept["complete"].filter("NOT _end AND market_cap IS NOT NULL").isEmpty()  # of other days only what lags read
