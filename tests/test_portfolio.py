from __future__ import annotations

import datetime as dt
import itertools

import numpy as np
import pytest

from tickfold.operators import portfolio as pf
from tickfold.plans import queries

RNG = np.random.default_rng(7)


def test_shrinkage_matches_its_definition_per_observation():
    x = RNG.normal(size=(40, 6)) @ RNG.normal(size=(6, 6))
    sample, shrunk, share = pf._shrink(x)
    t, n = x.shape
    z = x - x.mean(axis=0)
    s = sum(np.outer(r, r) for r in z) / t
    mu = np.trace(s) / n
    delta = np.linalg.norm(s - mu * np.eye(n)) ** 2 / n
    beta = sum(np.linalg.norm(np.outer(r, r) - s) ** 2 for r in z) / n / t**2
    assert np.allclose(sample, s) and share == pytest.approx(min(beta, delta) / delta)
    assert np.allclose(shrunk, (1 - share) * s + share * mu * np.eye(n))
    assert np.allclose(shrunk, shrunk.T) and np.linalg.eigvalsh(shrunk).min() > 0


def test_posterior_matches_textbook_form():
    a = RNG.normal(size=(5, 5))
    sigma, q, conf = a @ a.T + np.eye(5), RNG.normal(size=5), np.full(5, 0.9)
    mean, cov = pf._posterior(sigma, q, conf)
    omega = np.diag(pf.TAU * (1 - conf) / conf * np.diag(sigma))
    inner = np.linalg.inv(np.linalg.inv(pf.TAU * sigma) + np.linalg.inv(omega))
    assert np.allclose(mean, inner @ np.linalg.inv(omega) @ q)
    assert np.allclose(cov, sigma + inner)


def sharpe(w, mean, cov):
    return (mean - pf.RISK_FREE) @ w / np.sqrt(w @ (cov + pf.L2_GAMMA * np.eye(len(w))) @ w)


def test_weights_of_two_names_in_closed_form():
    mean, cov = np.array([0.12, 0.22]), np.array([[0.04, 0.01], [0.01, 0.09]])
    y = np.linalg.solve(cov + np.eye(2), mean - pf.RISK_FREE)
    assert np.allclose(pf._max_sharpe(mean, cov), y / y.sum())


@pytest.mark.parametrize("seed", range(5))
def test_weights_beat_every_other_portfolio(seed):
    rng = np.random.default_rng(seed)
    a = rng.normal(size=(4, 4)) * 2
    mean, cov = rng.normal(0.1, 0.4, size=4), a @ a.T
    w = pf._max_sharpe(mean, cov)
    assert w.min() >= 0 and w.sum() == pytest.approx(1)
    best = max(
        sharpe(np.array(p) / 20, mean, cov) for p in itertools.product(range(21), repeat=4) if sum(p) == 20
    )
    assert sharpe(w, mean, cov) >= best - 1e-9


def test_no_name_above_the_safe_rate_gives_no_weights():
    assert pf._max_sharpe(np.array([0.01, -0.2]), np.eye(2)) is None


def days(n):
    return [dt.date(2020, 1, 1) + dt.timedelta(days=i) for i in range(n)]


def panel(spark, prices: dict[str, list]):
    rows = [
        (t, i, f"{t} Inc", d, v, v)
        for i, (t, values) in enumerate(prices.items())
        for d, v in zip(days(len(values)), values)
    ]
    return spark.createDataFrame(
        rows, "ticker string, simfinid long, comp_name string, date date, open double, adj_close double"
    )


def picks(spark, rows):
    return spark.createDataFrame(rows, "date date, ticker string, predictions double")


def test_returns_skip_dates_with_a_gap(spark):
    d = days(5)
    prices = panel(spark, {"a": [1.0, 2.0, 4.0, 8.0, 99.0], "b": [1.0, None, 3.0, 6.0, 99.0], "c": [1.0] * 5})
    chosen = picks(spark, [(d[3], "a", 1.1), (d[3], "b", 1.1)])
    # nothing after the rebalancing date, nothing of other names
    assert pf.basket_history(chosen, prices, rows=2).count() == 8
    baskets = pf.basket_prices(chosen, prices, rows=2)
    kept = {(r.date, r.ticker): r.adj_close for r in pf.complete_case(baskets).collect()}
    assert sorted({k[0] for k in kept}) == [d[0], d[2], d[3]]
    returns = {(r.date, r.ticker): r.ret for r in pf.basket_returns(baskets).collect()}
    assert returns == {(d[2], "a"): 3.0, (d[2], "b"): 2.0, (d[3], "a"): 1.0, (d[3], "b"): 1.0}


def test_covariance_rows_match_numpy(spark):
    values = {t: np.exp(np.cumsum(RNG.normal(0, 0.1, 30))).tolist() for t in "abc"}
    d = days(30)
    chosen = picks(spark, [(d[-1], t, 1.05) for t in "abc"])
    returns = pf.return_vectors(pf.basket_prices(chosen, panel(spark, values), 3))
    covariance = pf.shrunk_covariance(returns)
    x = np.array([np.array(values[t][1:]) / np.array(values[t][:-1]) - 1 for t in "abc"])
    want = np.cov(x, bias=True)
    for r in pf.covariance_rows(covariance, "sample").collect():
        assert r.value == pytest.approx(want["abc".index(r.ticker_i), "abc".index(r.ticker_j)])
    weights = pf.optimal_weights(chosen, panel(spark, values), 0.9, 3).collect()
    assert sum(r.weights for r in weights) == pytest.approx(1, abs=1e-3) and min(r.weights for r in weights) >= 0


def test_clean_weights(spark):
    df = spark.createDataFrame([(0.00009,), (0.333333333,), (-0.00001,)], "weights double")
    assert [r.weights for r in pf.clean_weights(df).collect()] == [0.0, 0.33333, 0.0]


def priced(spark):
    """Three periods; the second has a name without an end price."""
    d = days(4)
    rows = [
        (d[0], "a", 0.6, d[0], d[1], 10.0, 12.0), (d[0], "b", 0.4, d[0], d[1], 5.0, 4.0),
        (d[1], "a", 0.5, d[1], d[2], 12.0, 18.0), (d[1], "b", 0.5, d[1], d[2], 4.0, None),
        (d[2], "a", 1.0, d[2], d[3], 18.0, 27.0),
    ]
    return spark.createDataFrame(
        rows,
        "date date, ticker string, weights double, period_start_date date, period_end_date date, "
        "open_start_date double, open_end_date double",
    )


def looped(rows, amount):
    out, total = [], 1.0
    for day in sorted({r.date for r in rows}):
        held = [r for r in rows if r.date == day]
        begin = sum(r.weights * amount for r in held)
        end = sum(r.weights * amount / r.open_start_date * r.open_end_date for r in held if r.open_end_date is not None)
        total *= end / begin
        out.append((begin, end, end / begin, total))
        amount = end
    return out


def test_backtest_equals_the_loop(spark):
    df = priced(spark)
    want = looped(df.collect(), 1000.0)
    got = pf.backtest(df, 1000.0).orderBy("date").collect()
    for row, expected in zip(got, want, strict=True):
        assert (row.begin_dollar_amount, row.end_dollar_amount, row.period_return, row.rolling_returns) == pytest.approx(expected)
    totals = pf.period_returns(pf.position_values(df, 1000.0)).orderBy("date").collect()
    for row, expected in zip(totals, want, strict=True):
        assert (row.begin_dollar_amount, row.end_dollar_amount, row.period_return) == pytest.approx(expected[:3])


def test_end_price_must_belong_to_the_same_company(spark):
    d = days(3)
    rows = [("a", 1, "A Inc", d[1], 10.0), ("a", 2, "Other", d[2], 20.0), ("b", 3, "B Inc", d[1], 5.0),
            ("b", 3, "B Inc", d[2], 6.0), ("c", 4, "C Inc", d[2], 7.0)]
    quotes = spark.createDataFrame(rows, "ticker string, simfinid long, comp_name string, date date, open double")
    held = spark.createDataFrame(
        [(d[0], t, 0.3, d[0], d[1], d[2]) for t in "abc"],
        "date date, ticker string, weights double, month_end_date date, period_start_date date, period_end_date date",
    )
    for bound in (3, None):  # broadcast and shuffled lookup
        out = {r.ticker: r for r in pf.position_prices(held, quotes, bound).collect()}
        assert (out["a"].open_start_date, out["a"].open_end_date) == (10.0, None)
        assert (out["b"].open_start_date, out["b"].open_end_date) == (5.0, 6.0)
        assert (out["c"].simfinid, out["c"].open_start_date, out["c"].open_end_date) == (None, None, None)


def one_basket(spark, prices):
    """Picks of one date and the panel with {ticker: prices}."""
    return picks(spark, [(dt.date(2020, 3, 1), t, 1.1) for t in prices]), panel(spark, prices)


def test_zero_price_raises(spark):
    baskets = pf.basket_prices(*one_basket(spark, {"A": [1.0, 0.0, 2.0], "B": [1.0, 2.0, 3.0]}))
    with pytest.raises(Exception, match="basket 2020-03-01: no return on 2020-01-03 for A"):
        pf.return_vectors(baskets).collect()


def test_two_prices_of_a_ticker_raise(spark):
    chosen, once = one_basket(spark, {"A": [5.0], "B": [1.0, 2.0]})
    twice = once.unionAll(panel(spark, {"A": [1.0, 2.0]}))
    with pytest.raises(Exception, match="basket 2020-03-01: a ticker has two prices on 2020-01-01"):
        pf.basket_prices(chosen, twice).collect()


@pytest.mark.parametrize("rows", [None, 100])
def test_baskets_equal_brute_force(spark, rows):
    """Overlapping baskets, gaps, missing prices, names without any row, names whose rows come later."""
    rng = np.random.default_rng(11)
    prices = {f"T{i}": [None if rng.random() < 0.1 else float(rng.integers(1, 99)) for _ in range(40 + i)] for i in range(8)}
    table = panel(spark, prices).filter("NOT (ticker = 'T1' AND date < '2020-01-20') AND date <> '2020-01-06'")
    dates = [dt.date(2020, 1, 10), dt.date(2020, 1, 25), dt.date(2020, 2, 20)]
    chosen = [(d, f"T{i}", 1.1) for k, d in enumerate(dates) for i in range(k, k + 6)] + [(dates[0], "gone", 1.1)]
    got = {r.date_r: r for r in pf.basket_prices(picks(spark, chosen), table, rows).collect()}
    held = {(r.ticker, r.date): r.adj_close for r in table.collect()}
    for d in dates:
        names = sorted({t for on, t, _ in chosen if on == d and any(k[0] == t and k[1] <= d for k in held)})
        kept = [x for x in days(90) if x <= d and all(held.get((t, x)) is not None for t in names)]
        assert got[d].tickers == names and got[d].dates == kept
        assert [list(p) for p in got[d].prices] == [[held[t, x] for t in names] for x in kept]
    assert "T1" not in got[dates[0]].tickers


def test_baskets_meet_vectors_not_days(spark):
    """No join or shuffle moves a row per basket, name and day: what meets a basket is one row per name."""
    chosen, table = one_basket(spark, {t: [1.0, 2.0, 3.0] for t in "ABC"})
    plan = pf.shrunk_covariance(pf.return_vectors(pf.basket_prices(chosen, table, 3)))._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and "Window" not in plan
    # one shuffle of the closes by ticker, one of vectors by basket
    moved = [line for line in plan.splitlines() if "Exchange hashpartitioning(" in line]
    assert len([line for line in moved if "date_r" in line]) == 1 and plan.index("collect_list") < plan.rindex("hashpartitioning(ticker")


def test_every_rebalancing_date_has_a_status(spark):
    sound = {"A": [1.0, 1.1, 1.0, 1.2], "B": [2.0, 2.1, 2.2, 2.1]}
    dates = [dt.date(2020, m, 1) for m in (2, 3, 4, 5)]
    # two prices each, so one return, for the names of the second date
    names = {dates[0]: "AB", dates[1]: "CD", dates[2]: "AB"}
    table = panel(spark, {**sound, "C": [1.0, 1.1], "D": [2.0, 2.1]})
    chosen = picks(spark, [(d, t, 0.9 if d == dates[2] else 1.01) for d in names for t in names[d]])
    returns = pf.return_vectors(pf.basket_prices(chosen, table))
    posterior = pf.bl_posterior(pf.shrunk_covariance(returns), pf.views(chosen, 0.9))
    status = pf.basket_status(spark.createDataFrame([(d,) for d in dates], "date date"), posterior)
    assert [(r.date, r.n_names, r.status) for r in status.orderBy("date").collect()] == [
        (dates[0], 2, pf.OK), (dates[1], 2, pf.DEGENERATE), (dates[2], 2, pf.NO_EXCESS), (dates[3], 0, "no picks"),
    ]
    assert {r.date for r in pf.max_sharpe_weights(posterior).collect()} == {dates[0]}


def test_numbers_that_are_none_are_refused():
    with pytest.raises(ValueError, match="finite"):
        pf._max_sharpe(np.array([0.1, np.nan]), np.eye(2))


def test_panel_is_cut_to_picked_names_below_its_own_steps(spark):
    """A basket's panel is filtered by name before it is spread over days, and gives the same prices as the whole."""
    day = dt.date(2020, 1, 1)
    first = spark.createDataFrame([(t, i, day, float(i)) for i, t in enumerate(["a", "b", "c", None])], "ticker string, simfinid long, date date, x double")
    panel = first.selectExpr(
        "ticker", "simfinid", "concat('n', simfinid) AS comp_name", "explode(sequence(date, date + 9)) AS date", "x AS open"
    ).selectExpr("*", "sum(open) OVER (PARTITION BY ticker ORDER BY date) AS adj_close")
    # a name that is not in the panel, one picked twice, one without a ticker
    picks = spark.createDataFrame(
        [("b", day + dt.timedelta(days=4)), ("b", day + dt.timedelta(days=7)), ("z", day), ("c", day), (None, day)], "ticker string, date date"
    )
    held = picks.selectExpr(
        "date", "ticker", "1D AS weights", "date AS month_end_date", "date_add(date, 1) AS period_start_date", "date_add(date, 2) AS period_end_date"
    )
    for made in (
        lambda rows: pf.basket_history(picks, panel, rows),
        lambda rows: pf.ticker_vectors(picks, panel, rows),
        lambda rows: pf.position_prices(held, panel, rows),
    ):
        listed, whole, beyond = made(10), made(None), made(pf.LISTED_ROWS + 1)
        plan = listed._jdf.queryExecution().optimizedPlan().toString()
        spread = plan.index("Generate explode(sequence(date")
        assert " IN (" in plan[spread:] and " IN (" not in plan[:spread]
        assert " IN (" not in beyond._jdf.queryExecution().optimizedPlan().toString()
        assert sorted(map(str, listed.collect())) == sorted(map(str, whole.collect())) == sorted(map(str, beyond.collect()))
        assert listed.count()


def test_companies_of_names_not_picked_are_checked_too(spark, tmp_path):
    rows = {
        "supplier": ([(1, "one", 0), (2, "two", 0), (2, "two", 0)], "s_suppkey long, s_name string, s_nationkey int"),
        "part": ([(7, 9.0)], "p_partkey long, p_retailprice double"),
    }
    for name, (values, schema) in rows.items():
        spark.createDataFrame(values, schema).write.parquet(str(tmp_path / f"{name}.parquet"))
    line = "7L AS l_partkey, 1L AS l_suppkey, 2D AS l_quantity, 3D AS l_extendedprice, timestamp_ntz'2000-07-03' AS l_shipdate"
    spark.range(1).selectExpr(*line.split(", ")).write.parquet(str(tmp_path / "lineitem.parquet"))
    picks = spark.createDataFrame([("S1", dt.date(2000, 7, 31))], "ticker string, date date")
    with pytest.raises(Exception, match="companies: duplicate key"):
        pf.basket_history(picks, queries._quotes(spark, str(tmp_path)), 10).collect()
