"""DuckDB statements that state each registered query on its own terms, from the raw tables.

They are written from the specification, not from the Spark plans: windows per ticker and date, literal offset tables,
literal holidays, self joins for covariances.
"""

from __future__ import annotations

from tickfold import config as c
from tickfold.config import FIXTURE as S
from tickfold.config import TARGET

SUMS, AVGS = [f"sum_{x}" for x in c.SUM_COLUMNS], [f"avg_{x}" for x in c.AVG_COLUMNS]
SERIES = SUMS + AVGS
RATIOS = [out for out, _, _ in c.momentum_ratios()]
LAGGED = [c.momentum_name(n, 1) for n in c.MOMENTUM_SERIES]
LAGS = [(f"{n}_L{k}", n, k) for n in LAGGED for k in range(1, S.lag_range)]
BASE_DOUBLES = ["p_b", "p_fcf_ttm", "roll_30day_med_volume"]
FEATURES = BASE_DOUBLES + RATIOS + [n for n, _, _ in LAGS]

# Rows back for the three-month lag by length of this month (rows) and of the month 47 rows back (19..23).
LAG_3M = {
    19: (55, 55, 55, 56, 57),
    20: (56, 56, 56, 57, 58),
    21: (57, 57, 57, 58, 59),
    22: (58, 58, 58, 59, 60),
    23: (59, 59, 59, 60, 61),
}

# New York closures on weekdays, 1995 to 2001.
HOLIDAYS = """
1995-01-02 1995-02-20 1995-04-14 1995-05-29 1995-07-04 1995-09-04 1995-11-23 1995-12-25
1996-01-01 1996-02-19 1996-04-05 1996-05-27 1996-07-04 1996-09-02 1996-11-28 1996-12-25
1997-01-01 1997-02-17 1997-03-28 1997-05-26 1997-07-04 1997-09-01 1997-11-27 1997-12-25
1998-01-01 1998-01-19 1998-02-16 1998-04-10 1998-05-25 1998-07-03 1998-09-07 1998-11-26 1998-12-25
1999-01-01 1999-01-18 1999-02-15 1999-04-02 1999-05-31 1999-07-05 1999-09-06 1999-11-25 1999-12-24
2000-01-17 2000-02-21 2000-04-21 2000-05-29 2000-07-04 2000-09-04 2000-11-23 2000-12-25
2001-01-01 2001-01-15 2001-02-19 2001-04-13 2001-05-28 2001-07-04 2001-09-03
2001-09-11 2001-09-12 2001-09-13 2001-09-14 2001-11-22 2001-12-25
""".split()


def _list(*parts) -> str:
    return ", ".join(p for p in parts if p)


def _rounded(columns, digits: int = 6) -> str:
    return ", ".join(f"round({n}, {digits}) AS {n}" for n in columns)


def _rolled(days: int, series: str, kind: str, column: str) -> str:
    w = f"(PARTITION BY ticker ORDER BY date, simfinid ROWS BETWEEN {days - 1} PRECEDING AND CURRENT ROW)"
    return f"CASE WHEN count({column}) OVER {w} >= {days} THEN {kind}({column}) OVER {w} END AS {c.rolling_name(days, series)}"


def _lag(column: str, k: int, by: str = "ticker ORDER BY date, simfinid") -> str:
    return f"lag({column}, {k}) OVER (PARTITION BY {by})"


def _lag_1m(series: str) -> str:
    cases = " ".join(f"WHEN {d} THEN {_lag(c.rolling_name(7, series), d - 3)}" for d in range(19, 24))
    return f"CASE days_in_month {cases} END AS {c.lag_name(7, series, 1)}"


def _lag_3m(series: str) -> str:
    cases = " ".join(
        f"WHEN days_in_month = {d} AND prior = {19 + i} THEN {_lag(c.rolling_name(11, series), k)}"
        for d, row in LAG_3M.items()
        for i, k in enumerate(row)
    )
    return f"CASE {cases} END AS {c.lag_name(11, series, 3)}"


PANEL = [
    """shipped AS (
  SELECT *, CAST(l_shipdate AS DATE) + CASE isodow(l_shipdate) WHEN 6 THEN 2 WHEN 7 THEN 1 ELSE 0 END AS d FROM lineitem)""",
    """obs AS (
  SELECT l_suppkey AS k, d, max(l_extendedprice) AS px, min(l_extendedprice) AS op,
         sum(l_quantity) AS q, max(p_retailprice) AS bv
  FROM shipped JOIN part ON l_partkey = p_partkey GROUP BY 1, 2)""",
    """weekdays AS (
  SELECT d FROM (SELECT CAST(unnest(generate_series(CAST(min(d) AS TIMESTAMP), CAST(max(d) AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS d
                 FROM shipped) WHERE isodow(d) < 6)""",
    """filled AS (
  SELECT s_suppkey AS k, w.d, last_value(px IGNORE NULLS) OVER so_far AS px, last_value(op IGNORE NULLS) OVER so_far AS op,
         last_value(q IGNORE NULLS) OVER so_far AS q, last_value(bv IGNORE NULLS) OVER so_far AS bv
  FROM supplier CROSS JOIN weekdays w LEFT JOIN obs ON obs.k = s_suppkey AND obs.d = w.d
  WINDOW so_far AS (PARTITION BY s_suppkey ORDER BY w.d ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))""",
    """quotes AS (
  SELECT * FROM filled
  WHERE NOT ((k * 31 + year(d) * 12 + month(d)) % 17 = 0 AND day(d) = 15) AND NOT (k % 10 = 9 AND d >= DATE '2001-06-01'))""",
    """companies AS (
  SELECT s_suppkey AS simfinid, 'S' || s_suppkey AS ticker, s_name AS company_name, CAST(s_nationkey AS BIGINT) AS industryid
  FROM supplier)""",
    """industries AS (
  SELECT CAST(n_nationkey AS BIGINT) AS industryid, r_name AS sector, n_name AS industry
  FROM nation JOIN region ON n_regionkey = r_regionkey)""",
    """prices AS (
  SELECT k AS simfinid, 'S' || k AS ticker, d AS date, op AS open, px AS adj_close, q * 1000 AS volume FROM quotes)""",
    """ratios AS (
  SELECT k AS simfinid, 'S' || k AS ticker, d AS date, px * q * 20000 AS market_cap, px / bv AS price_to_book_value,
         px / (bv * 4) AS price_to_free_cash_flow_quarterly, op / bv AS price_to_free_cash_flow_ttm
  FROM quotes)""",
    "company_industry AS (SELECT * FROM companies LEFT JOIN industries USING (industryid))",
    """raw AS (
  SELECT * FROM prices LEFT JOIN company_industry USING (simfinid, ticker) LEFT JOIN ratios USING (simfinid, ticker, date))""",
    """panel AS (
  SELECT ticker, simfinid, company_name AS comp_name, sector, industry, date, open, adj_close, volume, market_cap,
         price_to_book_value AS p_b, price_to_free_cash_flow_quarterly AS p_fcf_quart, price_to_free_cash_flow_ttm AS p_fcf_ttm
  FROM raw)""",
]
PANEL_COLUMNS = [
    "ticker", "simfinid", "comp_name", "sector", "industry", "date", "open", "adj_close", "volume", "market_cap", "p_b",
    "p_fcf_quart", "p_fcf_ttm",
]

FILTERED = [
    """capped AS (
  SELECT *, CASE WHEN market_cap >= 200000000000 THEN 'mega' WHEN market_cap >= 10000000000 THEN 'large'
                 WHEN market_cap >= 2000000000 THEN 'mid' WHEN market_cap >= 300000000 THEN 'small'
                 WHEN market_cap >= 50000000 THEN 'micro' WHEN market_cap < 50000000 THEN 'penny' ELSE 'other' END
            AS market_cap_cat
  FROM panel)""",
    f"""sized AS (
  SELECT * FROM capped WHERE market_cap_cat NOT IN ('other', 'penny') AND {" AND ".join(f"{x} IS NOT NULL" for x in PANEL_COLUMNS)})""",
    f"dated AS (SELECT * FROM sized WHERE date BETWEEN DATE '{S.start_date}' AND DATE '{S.current_date}')",
]

INDEXED = [
    """indexed AS (
  SELECT *, adj_close / first_value(adj_close) OVER w AS return_index, p_b / first_value(p_b) OVER w AS p_b_index,
         p_fcf_ttm / first_value(p_fcf_ttm) OVER w AS p_fcf_ttm_index
  FROM dated WINDOW w AS (PARTITION BY ticker ORDER BY date, simfinid))"""
]

_MEDIAN = "(PARTITION BY ticker ORDER BY date, simfinid ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)"
ROLLED = [
    "rolled AS (SELECT *, "
    + _list(
        *[_rolled(d, f"sum_{x}", "sum", x) for d in (7, 11) for x in c.SUM_COLUMNS],
        *[_rolled(d, f"avg_{x}", "avg", x) for d in (7, 11) for x in c.AVG_COLUMNS],
        f"CASE WHEN count(volume) OVER {_MEDIAN} >= 11 THEN median(volume) OVER {_MEDIAN} END AS roll_30day_med_volume",
    )
    + " FROM indexed)"
]

_SESSIONS = f"""sched_days AS (
  SELECT CAST(g AS DATE) AS d FROM generate_series(DATE '{S.start_date}', DATE '{S.current_date}', INTERVAL 1 DAY) AS t(g)
  WHERE isodow(g) < 6)"""
_SCHEDULE = """schedule AS (
  SELECT CAST(year(d) AS INTEGER) AS year, CAST(month(d) AS INTEGER) AS month, count(*) AS cal_days_in_month
  FROM sched_days GROUP BY 1, 2)"""


def _counted(source: str) -> str:
    return f"""counted AS (
  SELECT *, CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month, CAST(day(date) AS INTEGER) AS day,
         count(*) OVER (PARTITION BY ticker, year(date), month(date)) AS days_in_month
  FROM {source})"""


COMPLETE = [
    _SESSIONS,
    _SCHEDULE,
    _counted("rolled"),
    """complete AS (
  SELECT counted.*, cal_days_in_month FROM counted LEFT JOIN schedule USING (year, month)
  WHERE days_in_month = cal_days_in_month)""",
]

LAGGED_CTE = [
    f"aged AS (SELECT *, {_lag('days_in_month', 47)} AS prior FROM complete)",
    "lagged AS (SELECT *, "
    + _list(
        *[_lag_1m(s) for s in SERIES],
        *[_lag_3m(s) for s in SERIES],
        *[f"{_lag(c.rolling_name(11, s), 121)} AS {c.lag_name(11, s, 6)}" for s in SERIES],
        *[f"{_lag(c.rolling_name(11, s), 247)} AS {c.lag_name(11, s, 12)}" for s in SERIES],
    )
    + " FROM aged)",
]

MONTHLY = [
    """month_ends AS (
  SELECT lagged.* FROM lagged
  JOIN (SELECT ticker, year, month, max(date) AS date FROM lagged GROUP BY 1, 2, 3) USING (ticker, year, month, date))""",
    "liquid AS (SELECT * FROM month_ends WHERE roll_30day_med_volume > 20000)",
]

MOMENTUM = [
    "factors AS (SELECT *, " + _list(*[f"{a} / {b} AS {out}" for out, a, b in c.momentum_ratios()]) + " FROM liquid)",
    "momentum AS (SELECT *, " + _list(*[f"{_lag(n, k, 'ticker ORDER BY date')} AS {out}" for out, n, k in LAGS]) + " FROM factors)",
]

MODELING = [
    f"targeted AS (SELECT *, lead(return_mom_1_0) OVER (PARTITION BY ticker ORDER BY date) AS {TARGET} FROM momentum)",
    f"""modeling AS (
  SELECT date, ticker, sector, market_cap_cat, {", ".join(FEATURES)}, {TARGET} FROM targeted
  WHERE {" AND ".join(f"{x} IS NOT NULL" for x in FEATURES)} AND sector IS NOT NULL
    AND ({TARGET} IS NOT NULL OR date = DATE '{S.current_date}'))""",
]

TO_PANEL = PANEL
TO_DATED = TO_PANEL + FILTERED
TO_INDEXED = TO_DATED + INDEXED
TO_ROLLED = TO_INDEXED + ROLLED
TO_COMPLETE = TO_ROLLED + COMPLETE
TO_LAGGED = TO_COMPLETE + LAGGED_CTE
TO_MONTHLY = TO_LAGGED + MONTHLY
TO_MOMENTUM = TO_MONTHLY + MOMENTUM
TO_MODELING = TO_MOMENTUM + MODELING

TRAIN = [f"train AS (SELECT * FROM modeling WHERE date < DATE '{S.modeling_data_date}')"]

PREDICTED = [
    f"""predicted AS (
  SELECT date, ticker, {TARGET},
         1 + ((CAST(substr(ticker, 2) AS BIGINT) * 37 + (year(date) * 12 + month(date)) * 11) % 101) / 1000.0::DOUBLE AS predictions
  FROM modeling)""",
    f"""ranked AS (
  SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY date ORDER BY predictions DESC NULLS LAST, ticker) AS INTEGER) AS rank
                 FROM predicted) WHERE rank <= {S.top_n})""",
]
TO_PREDICTED = TO_MODELING + PREDICTED

DATES = [
    f"""span AS (
  SELECT greatest(CAST(min(l_shipdate) AS DATE), DATE '{S.schedule_start}') AS s,
         least(CAST(max(l_shipdate) AS DATE), DATE '{S.schedule_end}') AS e FROM lineitem)""",
    """sessions AS (
  SELECT d FROM (SELECT CAST(unnest(generate_series(CAST(s AS TIMESTAMP), CAST(e AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS d
                 FROM span) WHERE isodow(d) < 6)""",
    f"""rebalance AS (
  SELECT * FROM (
    SELECT month_start_date, month_end_date, lead(month_start_date, 1) OVER (ORDER BY month_start_date) AS period_start_date,
           lead(month_start_date, 2) OVER (ORDER BY month_start_date) AS period_end_date
    FROM (SELECT min(d) AS month_start_date, max(d) AS month_end_date FROM sessions GROUP BY year(d), month(d)))
  WHERE month_end_date <= DATE '{S.last_prediction}')""",
]

PICKS = TO_PREDICTED + DATES + ["picks AS (SELECT * FROM ranked WHERE date IN (SELECT month_end_date FROM rebalance))"]

HISTORY = PICKS + [
    """history AS (
  SELECT picks.date AS date_r, panel.ticker, panel.date, panel.adj_close FROM picks JOIN panel
  ON picks.ticker = panel.ticker AND panel.date <= picks.date)"""
]
COMPLETE_CASE = HISTORY + [
    "basket AS (SELECT date_r, count(DISTINCT ticker) AS n FROM history GROUP BY 1)",
    "full_dates AS (SELECT date_r, date FROM history JOIN basket USING (date_r) GROUP BY date_r, date, n HAVING count(adj_close) = n)",
    "kept AS (SELECT history.* FROM history JOIN full_dates USING (date_r, date))",
]
RETURNS = COMPLETE_CASE + [
    """returns AS (
  SELECT * FROM (SELECT date_r, date, ticker, adj_close / lag(adj_close) OVER (PARTITION BY date_r, ticker ORDER BY date) - 1 AS ret
                 FROM kept) WHERE ret IS NOT NULL)"""
]
COVARIANCE = RETURNS + [
    """pairs AS (
  SELECT a.date_r, a.ticker AS ticker_i, b.ticker AS ticker_j, covar_pop(a.ret, b.ret) AS value
  FROM returns a JOIN returns b ON a.date_r = b.date_r AND a.date = b.date AND a.ticker <= b.ticker GROUP BY 1, 2, 3)"""
]
SHRUNK = COVARIANCE + [
    """moments AS (
  SELECT date_r, sum(CASE WHEN ticker_i = ticker_j THEN value END) AS trace, count(CASE WHEN ticker_i = ticker_j THEN 1 END) AS n,
         sum(CASE WHEN ticker_i = ticker_j THEN value * value ELSE 2 * value * value END) AS squared
  FROM pairs GROUP BY 1)""",
    """lengths AS (
  SELECT date_r, count(*) AS n_obs, sum(len2 * len2) AS fourth FROM (
    SELECT date_r, date, sum(dev * dev) AS len2 FROM (
      SELECT date_r, date, ret - avg(ret) OVER (PARTITION BY date_r, ticker) AS dev FROM returns) GROUP BY 1, 2) GROUP BY 1)""",
    """shares AS (
  SELECT date_r, n_obs, trace / n AS mu, least((fourth / n_obs - squared) / (n * n_obs), (squared - trace * trace / n) / n) AS beta,
         (squared - trace * trace / n) / n AS delta
  FROM moments JOIN lengths USING (date_r))""",
]

WEIGHTS = PICKS + [
    f"""weights AS (
  SELECT date, ticker, CASE WHEN abs(w) < 0.0001 THEN 0.0 ELSE round(w, 5) END AS weights
  FROM (SELECT date, ticker, ({S.top_n + 1} - rank) / {S.top_n * (S.top_n + 1) / 2}::DOUBLE AS w FROM picks))""",
    """held AS (
  SELECT weights.date, weights.ticker, weights, TARGET, predictions, month_end_date, period_start_date, period_end_date
  FROM weights LEFT JOIN picks ON weights.date = picks.date AND weights.ticker = picks.ticker
  LEFT JOIN rebalance ON weights.date = month_end_date)""".replace("TARGET", TARGET),
]
PRICED = WEIGHTS + [
    """priced AS (
  SELECT held.date, s.simfinid, s.comp_name, held.ticker, weights, month_end_date, period_start_date, period_end_date,
         s.open AS open_start_date, e.open AS open_end_date
  FROM held LEFT JOIN panel s ON s.ticker = held.ticker AND s.date = period_start_date
  LEFT JOIN panel e ON e.ticker = held.ticker AND e.simfinid = s.simfinid AND e.comp_name = s.comp_name AND e.date = period_end_date)"""
]
# the carried amount, as the recursion it is
VALUES = PRICED + [
    "growths AS (SELECT date, coalesce(sum(weights * open_end_date / open_start_date), 0) AS g, row_number() OVER (ORDER BY date) AS t FROM priced GROUP BY date)",
    f"""amounts AS (
  SELECT t, date, CAST({S.initial_amount} AS DOUBLE) AS amount, g FROM growths WHERE t = 1
  UNION ALL SELECT growths.t, growths.date, amounts.amount * amounts.g, growths.g FROM growths JOIN amounts ON growths.t = amounts.t + 1)""",
    """valued AS (
  SELECT priced.*, amount AS portfolio_amount, weights * amount AS begin_dollar_amount,
         weights * amount / open_start_date AS shares_held, weights * amount / open_start_date * open_end_date AS end_dollar_amount
  FROM priced JOIN amounts USING (date))""",
]
PERIODS = VALUES + [
    """periods AS (
  SELECT date, max(period_start_date) AS period_start_date, max(period_end_date) AS period_end_date,
         coalesce(sum(begin_dollar_amount), 0) AS begin_dollar_amount, coalesce(sum(end_dollar_amount), 0) AS end_dollar_amount
  FROM valued GROUP BY date)""",
    "compounded AS (SELECT *, end_dollar_amount / begin_dollar_amount AS period_return FROM periods)",
]


def _query(ctes: list[str], select: str) -> str:
    return "WITH RECURSIVE " + ",\n".join(ctes) + "\n" + select


def _digits(value: str, name: str) -> str:
    """Ten digits of a number."""
    return f"CAST(printf('%.9e', {value}) AS DOUBLE) AS {name}"


def _all_digits(columns) -> str:
    return ", ".join(_digits(n, n) for n in columns)


def _per_name(source: str, value: str, digits: int) -> str:
    return f"""SELECT date_r, ticker, count(*) AS n_rows, count({value}) AS n_values, min(date) AS first_date, max(date) AS last_date,
  round(min({value}), {digits}) AS low, round(max({value}), {digits}) AS high, round(sum({value}), {digits}) AS total,
  round(sum({value} * date_diff('day', DATE '1995-01-01', CAST(date AS DATE))), {min(digits, 3)}) AS by_day
  FROM {source} GROUP BY 1, 2"""


def _profile(source: str, columns: list[str], digits: int, shape: bool, shape_out: bool = True) -> str:
    """One SELECT per column."""
    # prices are exact, features are sums in an order of their own
    ends = "min(x) AS min, max(x) AS max" if shape else f"round(min(x), {digits}) AS min, round(max(x), {digits}) AS max"
    extra = ", " + _digits("skewness(x)", "skewness") + ", " + _digits("kurtosis(x)", "kurtosis") if shape and shape_out else ""
    moments = f"round(avg(x), {digits}) AS mean, round(stddev_samp(x), {digits}) AS std"
    if shape:
        moments = _digits("avg(x)", "mean") + ", " + _digits("stddev_samp(x)", "std")
    return " UNION ALL ".join(
        f"""SELECT '{n}' AS "column", count(*) AS n_rows, count(x) AS n_values, count(*) - count(x) AS n_missing,
  count(CASE WHEN x = 0 THEN 1 END) AS n_zeros, count(CASE WHEN x < 0 THEN 1 END) AS n_negative, {ends}, {moments}{extra} FROM (SELECT {n} AS x FROM {source})"""
        for n in columns
    )


def _quantiles(source: str, columns: list[str], digits: int) -> str:
    """One SELECT per column."""
    names = {"p05": 0.05, "p25": 0.25, "p50": 0.5, "p75": 0.75, "p95": 0.95}
    text = f"round(quantile_cont({{n}}, {{q}}), {digits})"
    return " UNION ALL ".join(
        f"""SELECT '{n}' AS "column", {", ".join(f"{text.format(n=n, q=q)} AS {name}" for name, q in names.items())} FROM {source}"""
        for n in columns
    )


def _expanding(source: str, columns: list[str], digits: int) -> str:
    """Every month end with all rows up to it."""
    values = ", ".join(f"round({x}, {digits}) AS {name}" for name, x in
                       {"mean": "avg(x)", "spread": "stddev_pop(x)", "low": "min(x)", "high": "max(x)"}.items())
    cells = ", ".join(f"{{'column': '{n}', 'x': {n}}}" for n in columns)
    return f"""SELECT d.date, "column", count(x) AS n, {values}
  FROM (SELECT DISTINCT date FROM {source}) d JOIN (SELECT date, unnest([{cells}], recursive := true) FROM {source}) c ON c.date <= d.date
  GROUP BY d.date, "column\""""


def _correlations(source: str, columns: list[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{a}' AS column_a, '{b}' AS column_b, round(corr({a}, {b}), 6) AS correlation FROM {source}"
        for i, a in enumerate(columns)
        for b in columns[i + 1 :]
    )


def _all_correlations(source: str, columns: list[str]) -> str:
    """All pairs in one pass."""
    pairs = ", ".join(
        f"{{'column_a': '{a}', 'column_b': '{b}', 'correlation': round(corr({a}, {b}), 6)}}"
        for i, a in enumerate(columns)
        for b in columns[i + 1 :]
    )
    return f"SELECT unnest([{pairs}], recursive := true) FROM {source}"


def _topk(columns: list[str], k: int) -> str:
    return " UNION ALL ".join(
        f"""(SELECT '{n}' AS "column", {n} AS value, count(*) AS n_rows,
  CAST(row_number() OVER (ORDER BY count(*) DESC, {n} NULLS FIRST) AS INTEGER) AS rank FROM panel GROUP BY {n} ORDER BY rank LIMIT {k})"""
        for n in columns
    )


def _scaled(columns: list[str], over: str, digits: int) -> str:
    return ", ".join(
        f"round(({n} - avg({n}) OVER {over}) / CASE stddev_pop({n}) OVER {over} WHEN 0 THEN 1 ELSE stddev_pop({n}) OVER {over} END, {digits}) AS {n}"
        for n in columns
    )


def _index(column: str) -> str:
    return f"SELECT {column} AS v, CAST(row_number() OVER (ORDER BY count(*) DESC, {column}) - 1 AS DOUBLE) AS i FROM train GROUP BY 1"


def _index_of(column: str) -> str:
    """Index of a value; unseen ones share the next free index."""
    return f"coalesce((SELECT i FROM ({_index(column)}) WHERE v = {column}), (SELECT CAST(count(*) AS DOUBLE) FROM ({_index(column)})))"


def _folds() -> str:
    parts = []
    for i, f in enumerate(S.folds, start=1):
        parts.append(f"SELECT {i} AS fold, 'train' AS role, date, ticker FROM train WHERE date < DATE '{f.train_before}'")
        parts.append(
            f"SELECT {i} AS fold, 'test' AS role, date, ticker FROM train WHERE date >= DATE '{f.test_from}' AND date < DATE '{f.test_to}'"
        )
    return " UNION ALL ".join(parts)


def _fine_grid() -> str:
    joins = " ".join(
        f"CROSS JOIN (SELECT unnest([{', '.join(map(str, values))}]){'::DOUBLE' if name == 'learning_rate' else '::INTEGER'} AS {name})"
        for name, values in c.FINE_GRID.items()
    )
    return f"""SELECT * FROM (SELECT fold, count(CASE WHEN role = 'train' THEN 1 END) AS n_train,
  count(CASE WHEN role = 'test' THEN 1 END) AS n_test FROM folds GROUP BY fold) {joins}"""


_PROFILED = ["open", "adj_close", "volume", "market_cap", "p_b", "p_fcf_quart", "p_fcf_ttm"]
_RATIO_VALUES = ["price_to_book_value", "price_to_free_cash_flow_quarterly", "price_to_free_cash_flow_ttm"]
_PANEL_OUT = "ticker, simfinid, comp_name, sector, industry, date, open, adj_close, volume, market_cap, " + _rounded(["p_b", "p_fcf_quart", "p_fcf_ttm"], 9)
_LINES = """sessions AS (
  SELECT d FROM (SELECT CAST(unnest(generate_series(min(l_shipdate), max(l_shipdate), INTERVAL 1 DAY)) AS DATE) AS d FROM lineitem)
  WHERE isodow(d) < 6 AND d NOT IN ({}))""".format(", ".join(f"DATE '{d}'" for d in HOLIDAYS))
_MONTHLY_OUT = "ticker, date, year, month, days_in_month, " + _rounded(
    ["roll_30day_med_volume", *[c.lag_name(d, "sum_return_index", m) for m, d in c.MOMENTUM_WINDOW.items()]]
)
_SECTORS = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]
_CAPS = ["mega", "large", "mid", "small", "micro"]


def _dummies() -> str:
    levels = [("sector", v) for v in _SECTORS] + [("market_cap_cat", v) for v in _CAPS]
    return ", ".join(
        f"CASE WHEN {column} = '{v}' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS {column}_{v.replace(' ', '_').lower()}"
        for column, v in levels
    )


def _rolled_out(prefix: str) -> str:
    return _rounded([c.rolling_name(d, s) for d in (7, 11) for s in SERIES if s.startswith(prefix)])


def statements() -> dict[str, str]:
    keys = f"date, ticker, {TARGET}"
    out = {
        "io_parquet": _query(
            TO_PANEL,
            """SELECT CAST(year(date) AS INTEGER) AS year, sector, count(*) AS n_rows, count(adj_close) AS n_prices,
  max(adj_close) AS max_close, min(open) AS min_open, sum(volume) AS sum_volume FROM panel GROUP BY 1, 2""",
        ),
        "io_csv": _query(
            TO_PANEL,
            """SELECT ticker, count(*) AS n_rows, min(date) AS first_date, max(date) AS last_date, min(open) AS min_open,
  max(adj_close) AS max_close, sum(volume) AS sum_volume FROM prices GROUP BY 1""",
        ),
        "ts_folds": _query(TO_MODELING + TRAIN, _folds()),
        "model_roundtrip": _query(
            TO_MODELING,
            f"SELECT count(*) AS n_rows, 0.0::DOUBLE AS max_abs_diff FROM modeling WHERE date >= DATE '{S.modeling_data_date}'",
        ),
        "join_company_industry": _query(TO_PANEL, "SELECT * FROM company_industry"),
        "join_price_company": _query(TO_PANEL, "SELECT * FROM prices LEFT JOIN company_industry USING (simfinid, ticker)"),
        "join_price_ratio": _query(
            TO_PANEL,
            f"SELECT ticker, date, simfinid, open, adj_close, volume, market_cap, {_rounded(_RATIO_VALUES, 9)} FROM prices LEFT JOIN ratios USING (simfinid, ticker, date)",
        ),
        "join_data": _query(
            TO_PANEL,
            f"""SELECT ticker, simfinid, date, open, adj_close, volume, market_cap, {_rounded(_RATIO_VALUES, 9)}, industryid, company_name, sector, industry
  FROM raw""",
        ),
        "check_unique": """SELECT l_suppkey AS simfinid, CAST(l_shipdate AS DATE) AS date, count(*) AS n_rows FROM lineitem
  GROUP BY 1, 2 HAVING count(*) > 1""",
        "clean_panel": _query(TO_PANEL, f"SELECT {_PANEL_OUT} FROM panel"),
        "profile_numeric": _query(TO_PANEL, _profile("panel", _PROFILED, 4, True)),
        "profile_by_year": _query(TO_PANEL, _profile("panel", _PROFILED, 4, True, shape_out=False)),
        "profile_quantiles": _query(TO_PANEL, _quantiles("panel", _PROFILED, 6)),
        "profile_modeling_quantiles": _query(TO_MODELING, _quantiles("modeling", [*FEATURES, TARGET], 6)),
        "profile_distinct": _query(
            TO_PANEL,
            " UNION ALL ".join(
                f"""SELECT '{n}' AS "column", count(DISTINCT {n}) AS n_distinct FROM panel"""
                for n in ("ticker", "sector", "industry", "date", "adj_close")
            ),
        ),
        "profile_topk": _query(TO_PANEL, _topk(["ticker", "sector", "industry"], 10)),
        "profile_corr": _query(TO_PANEL, _correlations("panel", _PROFILED)),
        "profile_duplicates": _query(
            TO_PANEL,
            "SELECT ticker, open, adj_close, volume, count(*) AS n_rows FROM panel GROUP BY ALL HAVING count(*) > 1",
        ),
        "market_cap_cat": _query(TO_DATED, f"SELECT ticker, date, {_rounded(['market_cap'])}, market_cap_cat FROM capped"),
        "filter_data": _query(TO_DATED, f"SELECT {_PANEL_OUT}, market_cap_cat FROM sized"),
        "filter_dates": _query(TO_DATED, f"SELECT ticker, date, {_rounded(['adj_close'])}, market_cap_cat FROM dated"),
        "change_index": _query(
            TO_INDEXED, "SELECT ticker, date, " + _rounded(["return_index", "p_b_index", "p_fcf_ttm_index"]) + " FROM indexed"
        ),
        "rolling_sum": _query(TO_ROLLED, f"SELECT ticker, date, {_rolled_out('sum_')} FROM rolled"),
        "rolling_avg": _query(TO_ROLLED, f"SELECT ticker, date, {_rolled_out('avg_')} FROM rolled"),
        "rolling_median": _query(TO_ROLLED, f"SELECT ticker, date, {_rounded(['roll_30day_med_volume'])} FROM rolled"),
        "trading_calendar": _query(
            [_LINES, "lines AS (SELECT CAST(l_shipdate AS DATE) AS d, count(*) AS n FROM lineitem GROUP BY 1)"],
            "SELECT sessions.d AS date, coalesce(n, 0) AS n_lines FROM sessions LEFT JOIN lines USING (d)",
        ),
        "month_day_count": _query([_SESSIONS, _SCHEDULE], "SELECT * FROM schedule"),
        "days_in_month": _query(
            TO_DATED + [_counted("dated")], "SELECT ticker, date, year, month, day, days_in_month FROM counted"
        ),
        "complete_months": _query(TO_COMPLETE, "SELECT ticker, date, days_in_month, cal_days_in_month FROM complete"),
        "month_end": _query(TO_MONTHLY, f"SELECT {_MONTHLY_OUT} FROM month_ends"),
        "month_end_liquid": _query(TO_MONTHLY, f"SELECT {_MONTHLY_OUT} FROM liquid"),
        "momentum": _query(TO_MOMENTUM, f"SELECT ticker, date, {_rounded(RATIOS)} FROM momentum"),
        "momentum_lags": _query(TO_MOMENTUM, f"SELECT ticker, date, {_rounded([n for n, _, _ in LAGS])} FROM momentum"),
        "lead_target": _query(TO_MODELING, f"SELECT ticker, date, {_rounded(['return_mom_1_0', TARGET])} FROM targeted"),
        "modeling_data": _query(
            TO_MODELING, f"SELECT date, ticker, sector, market_cap_cat, {_rounded([*FEATURES, TARGET])} FROM modeling"
        ),
        "expanding_moments": _query(TO_MODELING, _expanding("modeling", [*FEATURES, TARGET], 5)),
        "refreshed_modeling": _query(
            TO_MODELING, f"SELECT date, ticker, sector, market_cap_cat, {_rounded([*FEATURES, TARGET])} FROM modeling"
        ),
        "clustered_month_end": _query(TO_MONTHLY, f"SELECT {_MONTHLY_OUT} FROM liquid"),
        "profile_modeling": _query(TO_MODELING, _profile("modeling", [*FEATURES, TARGET], 5, False)),
        "profile_modeling_corr": _query(TO_MODELING, _all_correlations("modeling", [*FEATURES, TARGET])),
        "holdout": _query(
            TO_MODELING,
            f"SELECT date, ticker, sector, market_cap_cat, {_rounded([*FEATURES, TARGET])} FROM modeling WHERE date >= DATE '{S.modeling_data_date}'",
        ),
        "train_x": _query(
            TO_MODELING + TRAIN, f"SELECT date, ticker, sector, market_cap_cat, {_rounded(FEATURES)} FROM train"
        ),
        "train_x_scaled": _query(
            TO_MODELING + TRAIN, f"SELECT date, ticker, sector, market_cap_cat, {_scaled(FEATURES, '()', 5)} FROM train"
        ),
        "train_y": _query(TO_MODELING + TRAIN, f"SELECT date, ticker, {_rounded([TARGET])} FROM train"),
        "xsec_zscore": _query(
            TO_MODELING,
            f"SELECT date, ticker, sector, market_cap_cat, {_scaled(FEATURES, '(PARTITION BY date)', 5)} FROM modeling",
        ),
        "encode_index": _query(
            TO_MODELING + TRAIN,
            f"""SELECT date, ticker, sector, market_cap_cat, {_index_of('sector')} AS sector_idx,
  {_index_of('market_cap_cat')} AS market_cap_cat_idx FROM modeling""",
        ),
        "encode_onehot": _query(TO_MODELING, f"SELECT date, ticker, {_dummies()} FROM modeling"),
        "target_scale": _query(
            TO_MODELING + TRAIN,
            f"""SELECT date, ticker, round({TARGET}, 6) AS {TARGET}, round({TARGET}, 6) AS restored,
  round(({TARGET} - avg({TARGET}) OVER ()) / stddev_pop({TARGET}) OVER (), 6) AS label FROM train""",
        ),
        "metric_rmse_mape": _query(
            TO_PREDICTED,
            f"""SELECT round(sqrt(avg(power({TARGET} - predictions, 2))), 6) AS rmse,
  round(avg(abs({TARGET} - predictions) / greatest(abs({TARGET}), 2.220446049250313e-16)), 6) AS mape
  FROM predicted WHERE {TARGET} IS NOT NULL""",
        ),
        "grid_candidates": _query(TO_MODELING + TRAIN + [f"folds AS ({_folds()})"], _fine_grid()),
        "search_scores_consistent": _query(
            TO_MODELING + TRAIN + [f"folds AS ({_folds()})"],
            """SELECT CAST(candidate AS INTEGER) AS candidate, fold, trees, true AS scored, true AS agree, n_train, n_test
  FROM (SELECT fold, count(CASE WHEN role = 'train' THEN 1 END) AS n_train, count(CASE WHEN role = 'test' THEN 1 END) AS n_test
        FROM folds GROUP BY fold) CROSS JOIN (VALUES (0, 2), (1, 2), (2, 3), (3, 3)) AS t(candidate, trees)""",
        ),
        "walk_forward_rows": _query(
            TO_MODELING,
            f"""SELECT date, ticker, {_rounded([TARGET])}, true AS predicted FROM modeling
  WHERE date >= DATE '{S.walk_pairs[0][0]}' AND date < DATE '{S.walk_pairs[-1][1]}'""",
        ),
        "top_n": _query(TO_PREDICTED, f"SELECT date, ticker, {_rounded([TARGET, 'predictions'])} FROM ranked"),
        "market_dates": _query(DATES, "SELECT * FROM rebalance"),
        "basket_history": _query(HISTORY, _per_name("history", "adj_close", 2)),
        "complete_case": _query(COMPLETE_CASE, _per_name("kept", "adj_close", 2)),
        "pivot_prices": _query(
            COMPLETE_CASE,
            "SELECT date_r, kept.date, "
            + ", ".join(f"max(CASE WHEN rank = {i} THEN adj_close END) AS p{i}" for i in range(1, S.top_n + 1))
            + " FROM kept JOIN picks ON picks.date = date_r AND picks.ticker = kept.ticker GROUP BY 1, 2",
        ),
        "basket_returns": _query(RETURNS, _per_name("returns", "ret", 5)),
        "cov_pairs": _query(COVARIANCE, "SELECT date_r, ticker_i, ticker_j, round(value, 6) AS value FROM pairs"),
        "cov_shrunk": _query(
            SHRUNK,
            """SELECT date_r, ticker_i, ticker_j, n_obs, round(s, 5) AS shrinkage,
  round(252 * ((1 - s) * value + CASE WHEN ticker_i = ticker_j THEN s * mu ELSE 0 END), 5) AS value
  FROM pairs JOIN (SELECT *, CASE WHEN beta > 0 THEN beta / delta ELSE 0 END AS s FROM shares) USING (date_r)""",
        ),
        "views": _query(
            PICKS,
            f'SELECT date, ticker, round(power(predictions, 12) - 1, 6) AS "view", {S.confidence}::DOUBLE AS confidence FROM picks',
        ),
        # every basket of the test tables has enough returns, and a name above the risk-free rate
        "basket_status": _query(
            PICKS,
            """SELECT month_end_date AS date, CAST(count(ticker) AS INTEGER) AS n_names,
  CASE WHEN count(ticker) = 0 THEN 'no picks' ELSE 'ok' END AS status
  FROM rebalance LEFT JOIN picks ON picks.date = month_end_date GROUP BY month_end_date""",
        ),
        "posterior_residual": _query(
            PICKS, "SELECT date AS date_r, CAST(count(*) AS INTEGER) AS n_names, true AS exact FROM picks GROUP BY date"
        ),
        "weights_optimality": _query(
            PICKS,
            """SELECT date, CAST(count(*) AS INTEGER) AS n_names, true AS sums_to_one, true AS none_negative, true AS slopes_agree
  FROM picks GROUP BY date""",
        ),
        "clean_weights": _query(WEIGHTS, "SELECT * FROM weights"),
        "positions": _query(
            WEIGHTS,
            f"SELECT date, ticker, round(weights, 6) AS weights, {_rounded([TARGET, 'predictions'])}, month_end_date, period_start_date, period_end_date FROM held",
        ),
        "position_prices": _query(
            PRICED,
            f"""SELECT date, simfinid, comp_name, ticker, {_rounded(['weights'])}, month_end_date, period_start_date, period_end_date,
  {_rounded(['open_start_date', 'open_end_date'])} FROM priced""",
        ),
        "position_values": _query(
            VALUES,
            "SELECT date, ticker, "
            + _all_digits(["weights", "portfolio_amount", "begin_dollar_amount", "shares_held", "end_dollar_amount"])
            + " FROM valued",
        ),
        "period_returns": _query(
            PERIODS,
            "SELECT date, period_start_date, period_end_date, "
            + _all_digits(["begin_dollar_amount", "end_dollar_amount", "period_return"])
            + " FROM compounded",
        ),
        "backtest": _query(
            PERIODS,
            "SELECT date, period_start_date, period_end_date, "
            + _all_digits(["begin_dollar_amount", "end_dollar_amount", "period_return"])
            + ", "
            + _digits("product(period_return) OVER (ORDER BY date)", "rolling_returns")
            + " FROM compounded",
        ),
    }
    for step, ctes in (("1m", 7), ("3m", 11), ("6m", 11), ("12m", 11)):
        out[f"lag_{step}"] = _query(
            TO_LAGGED, f"SELECT ticker, date, {_rounded([c.lag_name(ctes, s, int(step[:-1])) for s in SERIES])} FROM lagged"
        )
    means = f"""means AS (
  SELECT p.date, avg(p.{TARGET}) AS {TARGET}, (SELECT avg(r.{TARGET}) FROM ranked r WHERE r.date = p.date) AS top_preds_returns
  FROM predicted p GROUP BY p.date)"""
    out["mean_returns"] = _query(
        TO_PREDICTED + [means], f"SELECT date, {_rounded([TARGET, 'top_preds_returns'])} FROM means"
    )
    out["performance_summary"] = _query(
        TO_PREDICTED + [means],
        f"""SELECT date, {_rounded([TARGET, 'top_preds_returns'])},
  round(product({TARGET}) OVER (ORDER BY date), 6) AS market_rolling_return,
  round(product(top_preds_returns) OVER (ORDER BY date), 6) AS top_preds_rolling_return FROM means""",
    )
    return out
