"""From ranked picks to weights, positions and a compounded backtest.

The reference date of a basket is a key column, ``date``: all rebalancing dates run in the same jobs. Every basket holds
at most the top n names, so picks (n x dates) and everything per basket are small whatever the size of the panel.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickfold.functions.columns import running_product
from tickfold.session import stage

# Library defaults the results depend on.
PERIODS_PER_YEAR = 252
TAU = 0.05
RISK_FREE = 0.02
L2_GAMMA = 1.0
WEIGHT_CUTOFF, WEIGHT_DIGITS = 1e-4, 5

# Largest pick table (rows) that is broadcast; beyond it, or when the bound is unknown (the default everywhere), the panel is
# joined by shuffle, with the same result.
BROADCAST_ROWS = 1_000_000
# Largest pick table (rows) whose names are listed in a filter on the panel.
LISTED_ROWS = 20_000


def _small(picks: DataFrame, rows: int | None) -> DataFrame:
    """``picks`` marked for broadcast when its known bound on rows allows."""
    return F.broadcast(picks) if rows is not None and rows <= BROADCAST_ROWS else picks


def _picked(panel: DataFrame, picks: DataFrame, rows: int | None) -> DataFrame:
    """Rows of ``panel`` whose ticker is picked at all, when the known bound on ``picks`` allows its names to be listed.

    A join would meet the panel when it is made; a filter by ticker moves below all its steps by ticker, so names that no
    basket holds are dropped before they are spread over days, sorted or joined.
    """
    if rows is None or rows > LISTED_ROWS:
        return panel
    return panel.filter(F.col("ticker").isin([row["ticker"] for row in picks.select("ticker").distinct().collect()]))


# -- history and risk ---------------------------------------------------------------------------------------------


def basket_history(picks: DataFrame, panel: DataFrame, rows: int | None = None) -> DataFrame:
    """Prices up to each rebalancing date of the names picked on it: (date_r, ticker, date, adj_close).

    ``rows`` is a proven bound on the size of ``picks``: top n times the number of dates.
    """
    keys = picks.select("ticker", F.col("date").alias("date_r"))
    prices = _picked(panel, picks, rows).select("ticker", "date", "adj_close")
    return prices.join(_small(keys, rows), "ticker").filter(F.col("date") <= F.col("date_r")).select(
        "date_r", "ticker", "date", "adj_close"
    )


def ticker_vectors(picks: DataFrame, panel: DataFrame, rows: int | None = None) -> DataFrame:
    """One row per picked ticker, whatever the number of baskets that hold it: (ticker, cells), cells being (day, adj_close)
    by day up to the last date on which it was picked; days are numbered from 1970.

    The panel is read once for all baskets, and nothing but the picked names' closes is moved. A ticker has one cell per
    session, so a row is bounded by the calendar. ``rows`` is a proven bound on the size of ``picks``.
    """
    last = picks.groupBy("ticker").agg(F.unix_date(F.max("date")).cast("int").alias("last"))
    prices = _picked(panel, picks, rows).select("ticker", F.unix_date("date").cast("int").alias("day"), "adj_close")
    wanted = prices.join(_small(last, rows), "ticker").filter(F.col("day") <= F.col("last"))
    return wanted.groupBy("ticker").agg(F.sort_array(F.collect_list(F.struct("day", "adj_close"))).alias("cells"))


_BASKET = "date_r date, tickers array<string>, dates array<date>, prices array<array<double>>"


def _aligned(key: tuple, rows: pa.Table) -> pa.Table:
    """The names of a basket on their common days: each name is a bitmap over the days that the basket spans and a vector of
    prices, and the days that all bitmaps share are kept."""
    order = np.argsort(np.array(rows["ticker"].to_pylist()))
    rows = rows.take(pa.array(order)).combine_chunks()
    cells = rows["cells"].chunk(0)
    offsets, flat = cells.offsets.to_numpy(), cells.flatten()
    offsets = offsets - offsets[0]
    days = flat.field("day").to_numpy(zero_copy_only=False)
    closes = flat.field("adj_close")
    first, span = int(days.min()), int(days.max() - days.min()) + 1
    n = len(rows)
    owner = np.repeat(np.arange(n), np.diff(offsets))
    seen = np.bincount(owner * span + days - first, minlength=n * span).reshape(n, span)
    if (seen > 1).any():
        day = np.datetime64(int(np.flatnonzero((seen > 1).any(axis=0))[0]) + first, "D")
        raise ValueError(f"basket {key[0].as_py()}: a ticker has two prices on {day}")
    valid = np.zeros((n, span), dtype=bool)
    prices = np.zeros((n, span))
    has = ~np.asarray(closes.is_null())
    valid[owner[has], days[has] - first] = True
    prices[owner[has], days[has] - first] = closes.drop_null().to_numpy(zero_copy_only=False)
    kept = np.flatnonzero(valid.all(axis=0))
    by_date = prices[:, kept].T
    lists = pa.ListArray.from_arrays(pa.array(np.arange(len(kept) + 1, dtype=np.int32) * n), pa.array(by_date.ravel()))
    ends = pa.array([0, len(kept)], pa.int32())
    dates = pa.array((kept + first).astype("datetime64[D]"))
    return pa.table(
        {
            "date_r": pa.array([key[0].as_py()], pa.date32()),
            "tickers": pa.array([rows["ticker"].to_pylist()], pa.list_(pa.string())),
            "dates": pa.ListArray.from_arrays(ends, dates),
            "prices": pa.ListArray.from_arrays(ends, lists),
        }
    )


def basket_prices(picks: DataFrame, panel: DataFrame, rows: int | None = None) -> DataFrame:
    """One row per basket: (date_r, tickers, dates, prices), prices[i][j] that of name j on the i-th date without a gap.

    A basket meets its names' vectors, n rows, and not n names times all days; its matrix is n times the sessions so far. Its
    names are those with any row up to date_r, in ticker order. A ticker with two prices on a date raises: its companies must
    not be mixed, and its dates must not fall out.
    """
    keys = picks.select("ticker", F.col("date").alias("date_r"))
    until = F.unix_date("date_r")
    held = ticker_vectors(picks, panel, rows).join(_small(keys, rows), "ticker")
    held = held.select("date_r", "ticker", F.filter("cells", lambda c: c["day"] <= until).alias("cells"))
    return held.filter(F.size("cells") > 0).groupBy("date_r").applyInArrow(_aligned, _BASKET)


def price_vectors(baskets: DataFrame) -> DataFrame:
    """One row per basket and kept date: (date_r, date, tickers, prices)."""
    return baskets.select("date_r", "tickers", F.explode(F.arrays_zip("dates", "prices")).alias("d")).select(
        "date_r", F.col("d.dates").alias("date"), "tickers", F.col("d.prices").alias("prices")
    )


def complete_case(baskets: DataFrame) -> DataFrame:
    """Prices on dates without a gap in the basket, long form: (date_r, date, ticker, adj_close)."""
    return (
        price_vectors(baskets)
        .select("date_r", "date", F.explode(F.arrays_zip("tickers", "prices")).alias("c"))
        .select("date_r", "date", F.col("c.tickers").alias("ticker"), F.col("c.prices").alias("adj_close"))
    )


def return_vectors(baskets: DataFrame) -> DataFrame:
    """Simple returns between consecutive kept dates: one row per basket, (date_r, tickers, dates, returns).

    A return that is no finite number, as after a price of zero, raises and names the basket, the date and the tickers: one
    such value would make the whole basket's risk undefined.
    """
    later = F.sequence(F.lit(1), F.size("dates") - 1)

    def change(i):
        return F.zip_with(F.get("prices", i), F.get("prices", i - 1), lambda now, then: F.try_divide(now, then) - 1)

    made = baskets.filter(F.size("dates") > 1).select(
        "date_r", "tickers", F.slice("dates", F.lit(2), F.size("dates") - 1).alias("dates"), F.transform(later, change).alias("returns")
    )
    infinite = float("inf")
    odd = F.exists("returns", lambda row: F.exists(row, lambda x: x.isNull() | ~(F.abs(x) < infinite)))
    at = F.filter(
        F.arrays_zip("dates", "returns"), lambda r: F.exists(r["returns"], lambda x: x.isNull() | ~(F.abs(x) < infinite))
    )[0]
    names = F.filter(F.arrays_zip(F.col("tickers"), at["returns"].alias("x")), lambda c: c["x"].isNull() | ~(F.abs(c["x"]) < infinite))
    message = F.concat(F.lit("basket "), F.col("date_r"), F.lit(": no return on "), at["dates"], F.lit(" for "), F.array_join(names["tickers"], ", "))
    return made.filter(F.when(odd, F.raise_error(message).cast("boolean")).otherwise(True))


def basket_returns(baskets: DataFrame) -> DataFrame:
    """Simple returns, long form: (date_r, date, ticker, ret)."""
    return (
        return_vectors(baskets)
        .select("date_r", "tickers", F.explode(F.arrays_zip("dates", "returns")).alias("d"))
        .select("date_r", F.col("d.dates").alias("date"), F.explode(F.arrays_zip(F.col("tickers"), F.col("d.returns"))).alias("c"))
        .select("date_r", "date", F.col("c.tickers").alias("ticker"), F.col("c.returns").alias("ret"))
    )


def pivot_prices(baskets: DataFrame, picks: DataFrame, n: int) -> DataFrame:
    """Complete dates as a wide matrix: columns ``p1 .. pn`` are the names by rank."""
    ranks = picks.select(F.col("date").alias("date_r"), "ticker", "rank")
    long = complete_case(baskets).join(ranks, ["date_r", "ticker"])
    wide = long.groupBy("date_r", "date").pivot("rank", list(range(1, n + 1))).agg(F.first("adj_close"))
    return wide.select("date_r", "date", *[F.col(str(i)).alias(f"p{i}") for i in range(1, n + 1)])


_COVARIANCE = (
    "date_r date, tickers array<string>, n_obs long, shrinkage double, sample array<double>, shrunk array<double>"
)


def _shrink(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Sample covariance and its shrinkage towards a multiple of the identity (Ledoit and Wolf, 2004)."""
    t, n = x.shape
    x = x - x.mean(axis=0)
    sample = x.T @ x / t
    mu = np.trace(sample) / n
    squared = float((sample**2).sum())
    delta = (squared - n * mu**2) / n
    beta = (float(((x**2).sum(axis=1) ** 2).sum()) / t - squared) / (n * t)
    beta = min(beta, delta)
    share = beta / delta if beta > 0 else 0.0
    return sample, (1 - share) * sample + share * mu * np.eye(n), share


def shrunk_covariance(returns: DataFrame) -> DataFrame:
    """One row per basket with its sample and shrunk, annualised covariance (flat, in ticker order).

    A row holds one basket's return matrix, kept dates times at most n names, bounded by the calendar: nothing is shuffled.
    """

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                x = np.array(row["returns"], dtype="float64")
                sample, shrunk, share = _shrink(x)
                out.append((row["date_r"], row["tickers"], len(x), share, sample.ravel(), (shrunk * PERIODS_PER_YEAR).ravel()))
            kinds = [pa.date32(), pa.list_(pa.string()), pa.int64(), pa.float64(), pa.list_(pa.float64()), pa.list_(pa.float64())]
            names = ["date_r", "tickers", "n_obs", "shrinkage", "sample", "shrunk"]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(list(zip(*out)) or [[]] * 6, kinds)], names=names)

    return returns.mapInArrow(solve, _COVARIANCE)


def covariance_rows(covariance: DataFrame, matrix: str) -> DataFrame:
    """A flat matrix column as (date_r, ticker_i, ticker_j, value) with ticker_i <= ticker_j."""
    n = F.size("tickers")
    return (
        covariance.select("date_r", "tickers", n.alias("n"), F.posexplode(matrix).alias("pos", "value"))
        .select(
            "date_r",
            F.get("tickers", F.floor(F.col("pos") / F.col("n")).cast("int")).alias("ticker_i"),
            F.get("tickers", F.col("pos") % F.col("n")).alias("ticker_j"),
            "value",
        )
        .filter("ticker_i <= ticker_j")
    )


# -- views, posterior, weights ------------------------------------------------------------------------------------


def views(picks: DataFrame, confidence: float) -> DataFrame:
    """Annualised return view and confidence per pick."""
    return picks.select(
        "date",
        "ticker",
        (F.pow("predictions", F.lit(12.0)) - 1).alias("view"),
        F.lit(confidence).alias("confidence"),
    )


_POSTERIOR = (
    "date_r date, tickers array<string>, posterior_return array<double>, posterior_cov array<double>, status string"
)

# What became of a basket.
OK, NO_EXCESS, DEGENERATE = "ok", "nothing above the risk-free rate", "degenerate"


def _posterior(sigma: np.ndarray, view: np.ndarray, confidence: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Black-Litterman with one absolute view per name, zero prior and view variances after Idzorek (2005)."""
    prior = TAU * sigma
    omega = np.diag(TAU * (1 - confidence) / confidence * np.diag(sigma))
    gain = np.linalg.solve(prior + omega, prior).T
    return gain @ view, sigma + prior - gain @ prior


def bl_posterior(covariance: DataFrame, view_rows: DataFrame) -> DataFrame:
    """Posterior mean and covariance per basket, one row each.

    A basket whose risk is not defined, as with a single return per name, keeps its row with ``status`` degenerate and
    without numbers; it doesn't stop the others.
    """
    wanted = view_rows.groupBy(F.col("date").alias("date_r")).agg(
        F.map_from_entries(F.collect_list(F.struct("ticker", F.struct("view", "confidence")))).alias("by_ticker")
    )
    # names in covariance order
    baskets = covariance.join(wanted, "date_r").select(
        "date_r",
        "tickers",
        "n_obs",
        "shrunk",
        F.transform("tickers", lambda t: F.element_at("by_ticker", t)["view"]).alias("view"),
        F.transform("tickers", lambda t: F.element_at("by_ticker", t)["confidence"]).alias("confidence"),
    )

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for row in pdf.itertuples(index=False):
                n = len(row.tickers)
                sigma = np.asarray(row.shrunk, dtype="float64").reshape(n, n)
                view, confidence = (np.asarray(x, dtype="float64") for x in (row.view, row.confidence))
                if not (np.isfinite(view).all() and np.isfinite(confidence).all()):
                    raise ValueError(f"basket {row.date_r}: a view is no finite number")
                if row.n_obs < 2 or not np.isfinite(sigma).all() or (np.diag(sigma) <= 0).any():
                    out.append((row.date_r, list(row.tickers), None, None, DEGENERATE))
                    continue
                mean, cov = _posterior(sigma, view, confidence)
                out.append((row.date_r, list(row.tickers), mean.tolist(), cov.ravel().tolist(), OK))
            yield pd.DataFrame(out, columns=["date_r", "tickers", "posterior_return", "posterior_cov", "status"])

    return baskets.mapInPandas(solve, _POSTERIOR)


def _max_sharpe(mean: np.ndarray, cov: np.ndarray) -> np.ndarray | None:
    """Long-only weights of the best ratio of excess return to regularised risk; None if no name beats the safe rate.

    Up to scale they solve min y'Ay/2 - m'y over y >= 0, found by growing and shrinking the set of held names.
    """
    if not (np.isfinite(mean).all() and np.isfinite(cov).all()):
        raise ValueError("a posterior mean or covariance is no finite number")
    m = mean - RISK_FREE
    a = cov + L2_GAMMA * np.eye(len(m))
    y, held = np.zeros(len(m)), np.zeros(len(m), dtype=bool)
    slope = m.copy()
    while True:
        open_names = ~held & (slope > 1e-12 * max(1.0, np.abs(m).max()))
        if not open_names.any():
            break
        held[np.argmax(np.where(open_names, slope, -np.inf))] = True
        while True:
            trial = np.zeros(len(m))
            trial[held] = np.linalg.solve(a[np.ix_(held, held)], m[held])
            below = held & (trial <= 0)
            if not below.any():
                y = trial
                break
            # step back to the first name that reaches zero, and let it go
            step = np.min(y[below] / (y[below] - trial[below]))
            y = y + step * (trial - y)
            held &= y > 1e-15
            y[~held] = 0.0
        slope = m - a @ y
    return y / y.sum() if y.sum() > 0 else None


_WEIGHTED = "date date, tickers array<string>, weights array<double>, status string"


def weight_vectors(posterior: DataFrame) -> DataFrame:
    """(date, tickers, weights, status): one row per basket, without weights where ``status`` is not ok."""

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for row in pdf.itertuples(index=False):
                n, weights, status = len(row.tickers), None, row.status
                if status == OK:
                    weights = _max_sharpe(
                        np.asarray(row.posterior_return, dtype="float64"),
                        np.asarray(row.posterior_cov, dtype="float64").reshape(n, n),
                    )
                    status = OK if weights is not None else NO_EXCESS
                out.append((row.date_r, list(row.tickers), None if weights is None else weights.tolist(), status))
            yield pd.DataFrame(out, columns=["date", "tickers", "weights", "status"])

    return posterior.mapInPandas(solve, _WEIGHTED)


def max_sharpe_weights(posterior: DataFrame) -> DataFrame:
    """(date, ticker, weights) of the baskets that have weights; :func:`basket_status` tells of the others."""
    pairs = weight_vectors(posterior).filter(F.col("status") == OK)
    pairs = pairs.select("date", F.explode(F.arrays_zip("tickers", "weights")).alias("w"))
    return pairs.select("date", F.col("w.tickers").alias("ticker"), "w.weights")


def basket_status(dates: DataFrame, posterior: DataFrame) -> DataFrame:
    """(date, n_names, status) for every rebalancing date of ``dates`` (one column, date), so that none disappears.

    A date on which no name was picked has the status ``no picks``; one without a kept return ``degenerate``.
    """
    found = weight_vectors(posterior).select("date", F.size("tickers").alias("n_names"), "status")
    return dates.join(found, "date", "left").select(
        "date", F.coalesce("n_names", F.lit(0)).alias("n_names"), F.coalesce("status", F.lit("no picks")).alias("status")
    )


def posterior_residual(covariance: DataFrame, view_rows: DataFrame, posterior: DataFrame) -> DataFrame:
    """(date_r, n_names, exact): whether mean and covariance meet their equations to nine digits, by rows and sums alone.

    With P = TAU * sigma and the diagonal W of view variances, the posterior covariance is sigma + W - W (P + W)^-1 W, and
    view minus posterior mean is W (P + W)^-1 view. So (sigma + W - cov) (view / W) must give back view - mean, which the
    solver computes in another way.
    """
    long = covariance.join(posterior.drop("tickers"), "date_r").select(
        "date_r", "tickers", F.size("tickers").alias("n"), F.posexplode(F.arrays_zip("shrunk", "posterior_cov")).alias("at", "m"), "posterior_return"
    )
    cells = long.select(
        "date_r",
        "n",
        F.get("tickers", F.floor(F.col("at") / F.col("n")).cast("int")).alias("ticker"),
        F.get("tickers", (F.col("at") % F.col("n")).cast("int")).alias("other"),
        F.col("m.shrunk").alias("sigma"),
        F.col("m.posterior_cov").alias("cov"),
        F.get("posterior_return", F.floor(F.col("at") / F.col("n")).cast("int")).alias("mean"),
    )
    variance = cells.filter("ticker = other").select("date_r", F.col("ticker").alias("other"), F.col("sigma").alias("own"))
    wanted = view_rows.select(F.col("date").alias("date_r"), F.col("ticker").alias("other"), "view", "confidence")
    omega = TAU * (1 - F.col("confidence")) / F.col("confidence") * F.col("own")
    cells = cells.join(variance.join(wanted, ["date_r", "other"]).withColumn("omega", omega), ["date_r", "other"])
    diagonal = F.when(F.col("ticker") == F.col("other"), F.col("omega")).otherwise(0.0)
    back = F.sum((F.col("sigma") + diagonal - F.col("cov")) * F.col("view") / F.col("omega"))
    sums = cells.groupBy("date_r", "n", "ticker").agg(
        back.alias("back"), F.max("mean").alias("mean"), F.max(F.when(F.col("ticker") == F.col("other"), F.col("view"))).alias("view")
    )
    close = F.abs(F.col("view") - F.col("back") - F.col("mean")) <= 1e-9 * (1 + F.abs("view"))
    return sums.groupBy("date_r").agg(F.max("n").alias("n_names"), F.every(close).alias("exact"))


def weights_optimality(posterior: DataFrame) -> DataFrame:
    """(date, n_names, sums_to_one, none_negative, slopes_agree) per basket with weights, by rows and sums alone.

    At the best ratio, every held name has the same ratio of excess return to marginal risk, and no other a higher one.
    """
    chosen = weight_vectors(posterior).filter(F.col("status") == OK).select(F.col("date").alias("date_r"), "weights")
    long = posterior.filter(F.col("status") == OK).join(chosen, "date_r").select(
        "date_r", F.size("tickers").alias("n"), F.posexplode("posterior_cov").alias("at", "cov"), "posterior_return", "weights"
    )
    i, j = F.floor(F.col("at") / F.col("n")).cast("int"), (F.col("at") % F.col("n")).cast("int")
    cell = F.col("cov") + F.when(i == j, L2_GAMMA).otherwise(0.0)
    rows = long.groupBy("date_r", "n", i.alias("i")).agg(
        F.sum(cell * F.get("weights", j)).alias("risk"),
        F.first(F.get("weights", i)).alias("w"),
        F.first(F.get("posterior_return", i) - RISK_FREE).alias("excess"),
    )
    scale = rows.groupBy("date_r").agg((F.sum(F.col("excess") * F.col("w")) / F.sum(F.col("risk") * F.col("w"))).alias("ratio"))
    gap = F.col("excess") - F.col("ratio") * F.col("risk")
    held = F.when(F.col("w") > 0, F.abs(gap) <= 1e-8).otherwise(gap <= 1e-8)
    return rows.join(scale, "date_r").groupBy(F.col("date_r").alias("date")).agg(
        F.max("n").alias("n_names"),
        (F.abs(F.sum("w") - 1) < 1e-9).alias("sums_to_one"),
        F.every(F.col("w") >= 0).alias("none_negative"),
        F.every(held).alias("slopes_agree"),
    )


def clean_weights(weights: DataFrame) -> DataFrame:
    """Tiny weights to zero, the rest to five digits."""
    w = F.col("weights")
    return weights.withColumn(
        "weights", F.when(F.abs(w) < WEIGHT_CUTOFF, F.lit(0.0)).otherwise(F.round(w, WEIGHT_DIGITS))
    )


def basket_posterior(picks: DataFrame, panel: DataFrame, confidence: float, rows: int | None = None) -> DataFrame:
    """Posterior of every basket: history, shrunk covariance, views."""
    returns = return_vectors(basket_prices(picks, panel, rows))
    return bl_posterior(shrunk_covariance(returns), views(picks, confidence))


def optimal_weights(picks: DataFrame, panel: DataFrame, confidence: float, rows: int | None = None) -> DataFrame:
    """Cleaned weights of every basket: posterior, best ratio."""
    return clean_weights(max_sharpe_weights(basket_posterior(picks, panel, confidence, rows)))


# -- positions and backtest ---------------------------------------------------------------------------------------


def positions(weights: DataFrame, picks: DataFrame, schedule: DataFrame) -> DataFrame:
    """Weights with their predictions and holding period (left joins; rebalancing dates come from the schedule)."""
    dates = schedule.select("month_end_date", "period_start_date", "period_end_date")
    return weights.join(picks, ["date", "ticker"], "left").join(
        F.broadcast(dates), F.col("date") == F.col("month_end_date"), "left"
    )


def position_prices(held: DataFrame, panel: DataFrame, rows: int | None = None) -> DataFrame:
    """Opening prices on the first and last day of the holding period (missing stays missing).

    One pass over the panel looks up both days of every position; the end price must belong to the company of the start
    price. The outer join then meets few rows.
    """
    sides = F.array(
        F.struct(F.lit(True).alias("starts"), F.col("period_start_date").alias("on")),
        F.struct(F.lit(False).alias("starts"), F.col("period_end_date").alias("on")),
    )
    demand = held.select(F.col("date").alias("date_r"), "ticker", F.explode(sides).alias("s")).select(
        "date_r", "ticker", "s.starts", F.col("s.on").alias("date")
    )
    quotes = (
        _picked(panel, held, rows)
        .select("ticker", "simfinid", "comp_name", "date", "open")
        .join(_small(demand, None if rows is None else 2 * rows), ["ticker", "date"])
        .groupBy(F.col("date_r").alias("date"), "ticker", "simfinid", "comp_name")
        .agg(
            F.count_if("starts").alias("n_start"),
            F.max(F.when(F.col("starts"), F.col("open"))).alias("open_start_date"),
            F.max(F.when(~F.col("starts"), F.col("open"))).alias("open_end_date"),
        )
        .filter("n_start > 0")
        .drop("n_start")
    )
    return held.join(quotes, ["date", "ticker"], "left").select(
        "date", "simfinid", "comp_name", "ticker", "weights", "month_end_date", "period_start_date",
        "period_end_date", "open_start_date", "open_end_date",
    )


def _growth():
    """What one unit invested at the start is worth at the end; names without an end price are lost."""
    return F.coalesce(F.sum(F.col("weights") * F.try_divide("open_end_date", "open_start_date")), F.lit(0.0))


def _carried(initial: float):
    """Amount at the start of a period: the initial value times the growth of all earlier periods.

    Every period reinvests the last one's end amount; as a product over one row per period this needs no loop.
    """
    earlier = running_product("growth", Window.orderBy("date"), last=-1)
    return F.lit(initial) * F.coalesce(earlier, F.lit(1.0))


def portfolio_amounts(priced: DataFrame, initial: float) -> DataFrame:
    """Amount invested on each rebalancing date."""
    periods = priced.groupBy("date").agg(_growth().alias("growth"))
    return periods.select("date", _carried(initial).alias("portfolio_amount"))


def position_values(priced: DataFrame, initial: float) -> DataFrame:
    """Dollars and shares of each position at both ends of its period."""
    # one row per rebalancing date
    amounts = F.broadcast(portfolio_amounts(priced, initial))
    begin = F.col("weights") * F.col("portfolio_amount")
    shares = F.try_divide(F.col("begin_dollar_amount"), F.col("open_start_date"))
    return (
        priced.join(amounts, "date")
        .withColumn("begin_dollar_amount", begin)
        .withColumn("shares_held", shares)
        .withColumn("end_dollar_amount", F.col("shares_held") * F.col("open_end_date"))
    )


def period_returns(values: DataFrame) -> DataFrame:
    """Totals per period. A name without an end price counts in full at the start and as nothing at the end."""
    totals = values.groupBy("date").agg(
        F.max("period_start_date").alias("period_start_date"),
        F.max("period_end_date").alias("period_end_date"),
        F.coalesce(F.sum("begin_dollar_amount"), F.lit(0.0)).alias("begin_dollar_amount"),
        F.coalesce(F.sum("end_dollar_amount"), F.lit(0.0)).alias("end_dollar_amount"),
    )
    return totals.withColumn("period_return", F.try_divide("end_dollar_amount", "begin_dollar_amount"))


def backtest(priced: DataFrame, initial: float) -> DataFrame:
    """Totals per period with the compounded return.

    Equal to :func:`period_returns` over :func:`position_values`, but the totals per unit invested come first, so the
    positions are read once and everything after has one row per period.
    """
    periods = priced.groupBy("date").agg(
        F.max("period_start_date").alias("period_start_date"),
        F.max("period_end_date").alias("period_end_date"),
        F.coalesce(F.sum("weights"), F.lit(0.0)).alias("invested"),
        _growth().alias("growth"),
    )
    amounts = periods.withColumn("amount", _carried(initial)).select(
        "date",
        "period_start_date",
        "period_end_date",
        (F.col("amount") * F.col("invested")).alias("begin_dollar_amount"),
        (F.col("amount") * F.col("growth")).alias("end_dollar_amount"),
    )
    returns = amounts.withColumn("period_return", F.try_divide("end_dollar_amount", "begin_dollar_amount"))
    return returns.withColumn("rolling_returns", running_product("period_return", Window.orderBy("date")))


def _staged_weights(
    picks: DataFrame, panel: DataFrame, schedule: DataFrame, confidence: float, rows: int | None
) -> tuple[DataFrame, DataFrame]:
    """Picks on the schedule's month ends and their weights, written once: several joins below read them."""
    dates = F.broadcast(schedule.select(F.col("month_end_date").alias("date")))
    chosen = stage(picks.join(dates, "date", "left_semi"), "picks")
    return chosen, stage(optimal_weights(chosen, panel, confidence, rows), "weights")


def portfolio_backtesting(
    picks: DataFrame, panel: DataFrame, schedule: DataFrame, initial: float, confidence: float, rows: int | None = None
) -> DataFrame:
    """Weights for every month end of the schedule, held for the following period and compounded."""
    chosen, weights = _staged_weights(picks, panel, schedule, confidence, rows)
    return backtest(position_prices(positions(weights, chosen, schedule), panel, rows), initial).drop("date")


def portfolio_optimization(
    picks: DataFrame, panel: DataFrame, schedule: DataFrame, confidence: float, rows: int | None = None
) -> DataFrame:
    """Production weights with the opening price of the coming period, where it is already known."""
    chosen, weights = _staged_weights(picks, panel, schedule, confidence, rows)
    return position_prices(positions(weights, chosen, schedule), panel, rows).drop("date", "open_end_date")
