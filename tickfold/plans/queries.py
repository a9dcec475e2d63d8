"""The registered queries: every operator over the whole test tables."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickfold import config as c
from tickfold.config import FIXTURE as S
from tickfold.config import TARGET
from tickfold.functions.checks import key_violations, require_unique
from tickfold.functions.columns import nan_to_null
from tickfold.functions.scaling import double_columns, expanding, moments_by, zscore_by
from tickfold.operators import calendar, clean, evaluate, features, model, portfolio, profile, refresh, splits
from tickfold.plans import panel as plans
from tickfold.session import configure, stage, stage_path
from tickfold.sources import files, testdata

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

PROFILED = ["open", "adj_close", "volume", "market_cap", "p_b", "p_fcf_quart", "p_fcf_ttm"]
LAGGED = [c.momentum_name(n, 1) for n in c.MOMENTUM_SERIES]
RATIOS = [out for out, _, _ in c.momentum_ratios()]
# one month end per month of the modeling table
MONTHS = calendar.month_count(S.start_date, S.current_date)


def register(function: Query) -> Query:
    """Register under the function's name; the session gets the library's SQL settings first."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return function(configure(spark), sf_dir)

    run.__name__, run.__doc__ = function.__name__, function.__doc__
    QUERIES[function.__name__] = run
    return function


def _rounded(df: DataFrame, *exact: str, digits: int = 6) -> DataFrame:
    """Doubles to ``digits`` places: sums over a window may be added in another order elsewhere."""
    rounded = set(double_columns(df)) - set(exact)
    return df.selectExpr(*[f"round(`{n}`, {digits}) AS `{n}`" if n in rounded else f"`{n}`" for n in df.columns])


def _nine_places(df: DataFrame) -> DataFrame:
    """Ratios to nine places; prices, volumes and market values are exact in both engines."""
    exact = {n for n in df.columns if n in ("open", "adj_close", "volume", "market_cap")}
    return _rounded(df, *exact, digits=9)


def _ten_digits(df: DataFrame) -> DataFrame:
    """Doubles to ten digits: compounded dollars grow beyond what fixed places can hold."""
    return df.withColumns({n: F.format_string("%.9e", n).try_cast("double") for n in double_columns(df)})


def _plain_names(df: DataFrame) -> DataFrame:
    """Vendor names like ``Adj. Close`` to ``adj_close``."""
    return df.toDF(*[re.sub(r"\W+", "_", n).strip("_").lower() for n in df.columns])


# -- shared inputs ------------------------------------------------------------------------------------------------


def _panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.clean_panel(testdata.inputs(spark, sf_dir), clustered=True)


def _modeling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.modeling_data(_panel(spark, sf_dir), S)


def _staged_modeling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written once, in files of a fair size: model fits scan it many times."""
    return stage(_modeling(spark, sf_dir).hint("rebalance"), "modeling_data")


def _with_predictions(modeling: DataFrame) -> DataFrame:
    """Stand-in predictions, computed from ticker number and month."""
    k = F.substring("ticker", 2, 20).cast("long")
    month = F.year("date") * 12 + F.month("date")
    return modeling.select(
        "date", "ticker", TARGET, (1 + F.pmod(k * 37 + month * 11, F.lit(101)) / F.lit(1000.0)).alias("predictions")
    )


def _predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _with_predictions(_modeling(spark, sf_dir))


def _staged_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written once: the market and the top picks are averaged in separate passes."""
    return stage(_predictions(spark, sf_dir), "holdout_results")


def _schedule(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounds = calendar.clip_span(testdata.data_span(spark, sf_dir), S.schedule_start, S.schedule_end)
    return calendar.market_dates(calendar.trading_calendar(bounds, S.holidays), S.last_prediction)


# top n names on at most one date per month of the schedule
PICK_ROWS = S.top_n * calendar.month_count(S.schedule_start, S.schedule_end)


def _quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What baskets need of the panel, from prices and companies alone: the ratios are never read.

    Companies are checked whole and written before the join, as baskets filter the panel by name.
    """
    checked = stage(require_unique(testdata.companies(spark, sf_dir), ["Ticker", "SimFinId"], "companies"), "companies")
    raw = clean.join_price_company(testdata.prices(spark, sf_dir), checked, validate=False)
    columns = ("Ticker", "SimFinId", "Company Name", "Date", "Open", "Adj. Close")
    return nan_to_null(raw.select(*[F.col(f"`{n}`").alias(clean.PANEL_COLUMNS[n]) for n in columns]))


def _picks_and_panel(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Ranked picks on the rebalancing dates, staged, and the quotes they are priced from."""
    dates = F.broadcast(_schedule(spark, sf_dir).select(F.col("month_end_date").alias("date")))
    picks = evaluate.rank_predictions(_predictions(spark, sf_dir).join(dates, "date", "left_semi"), S.top_n)
    return stage(picks, "picks"), _quotes(spark, sf_dir)


def _history(spark: SparkSession, sf_dir: str) -> DataFrame:
    picks, panel = _picks_and_panel(spark, sf_dir)
    return portfolio.basket_history(picks, panel, PICK_ROWS)


def _baskets(spark: SparkSession, sf_dir: str) -> DataFrame:
    picks, panel = _picks_and_panel(spark, sf_dir)
    return portfolio.basket_prices(picks, panel, PICK_ROWS)


def _covariance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return portfolio.shrunk_covariance(portfolio.return_vectors(_baskets(spark, sf_dir)))


def _rank_weights(picks: DataFrame) -> DataFrame:
    """Stand-in weights falling with the rank, in place of the optimiser's."""
    n = S.top_n
    return picks.select("date", "ticker", ((n + 1 - F.col("rank")) / F.lit(n * (n + 1) / 2)).alias("weights"))


def _held(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    picks, panel = _picks_and_panel(spark, sf_dir)
    weights = portfolio.clean_weights(_rank_weights(picks))
    return portfolio.positions(weights, picks.drop("rank"), _schedule(spark, sf_dir)), panel


def _priced(spark: SparkSession, sf_dir: str) -> DataFrame:
    held, panel = _held(spark, sf_dir)
    return portfolio.position_prices(held, panel, PICK_ROWS)


# -- sources and sinks --------------------------------------------------------------------------------------------


@register
def io_parquet(spark, sf_dir):
    """Clean panel written by year, read back, totals per year and sector."""
    path = stage_path(spark, "panel")
    files.write_panel(_panel(spark, sf_dir), path)
    df = files.read_panel(spark, path)
    return df.groupBy(F.year("date").alias("year"), "sector").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count("adj_close").alias("n_prices"),
        F.max("adj_close").alias("max_close"),
        F.min("open").alias("min_open"),
        F.sum("volume").alias("sum_volume"),
    )


def _clustered_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prices and ratios written in buckets by ticker, and the panel joined from them without moving a row."""
    inputs = testdata.inputs(spark, sf_dir)
    for name in ("prices", "ratios"):
        path = stage_path(spark, f"clustered-{name}")
        held = f"tickfold_{name}_{path.rsplit('-', 1)[1]}"
        files.write_clustered(inputs[name], held, path, "Ticker", ("Date", "SimFinId"))
        inputs[name] = files.read_clustered(spark, held)
    return plans.clean_panel(inputs, clustered=True)


@register
def clustered_month_end(spark, sf_dir):
    """Liquid month ends with their lags, all windows straight from bucketed tables."""
    return _monthly_columns(plans.monthly_panel(_clustered_panel(spark, sf_dir), S))


@register
def io_csv(spark, sf_dir):
    """Prices written as CSV, read back with the declared schema, totals per ticker."""
    path = stage_path(spark, "prices-csv")
    files.write_csv(testdata.prices(spark, sf_dir), path)
    df = _plain_names(files.read_csv(spark, path, files.PRICES))
    return df.groupBy("ticker").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.min("date").alias("first_date"),
        F.max("date").alias("last_date"),
        F.min("open").alias("min_open"),
        F.max("adj_close").alias("max_close"),
        F.sum("volume").alias("sum_volume"),
    )


@register
def ts_folds(spark, sf_dir):
    """Fold table, stored as Parquet."""
    return stage(splits.time_series_split(_modeling(spark, sf_dir), S.modeling_data_date, S.folds), "folds")


@register
def model_roundtrip(spark, sf_dir):
    """A model stored and loaded predicts the same on the holdout, in target units, from its folder alone."""
    modeling = _staged_modeling(spark, sf_dir)
    train = splits.train_set(modeling, S.modeling_data_date)
    holdout = splits.holdout_set(modeling, S.modeling_data_date)
    scale = model.feature_scale(train)
    fitted = model.fit_model(scale.transform(train), S.features, model.boosted_trees, S.best_params, feature_scale=scale)
    path = stage_path(spark, "model")
    model.save_model(fitted, path, spark)
    before = fitted.predict(scale.transform(holdout)).select("date", "ticker", F.col("predictions").alias("before"))
    loaded = model.load_model(path, spark)
    both = loaded.predict_raw(holdout).select("date", "ticker", "predictions").join(before, ["date", "ticker"])
    return both.agg(
        F.count(F.lit(1)).alias("n_rows"), F.max(F.abs(F.col("predictions") - F.col("before"))).alias("max_abs_diff")
    )


# -- data processing ----------------------------------------------------------------------------------------------


@register
def join_company_industry(spark, sf_dir):
    return _plain_names(clean.join_company_industry(testdata.companies(spark, sf_dir), testdata.industries(spark, sf_dir)))


@register
def join_price_company(spark, sf_dir):
    companies = clean.join_company_industry(testdata.companies(spark, sf_dir), testdata.industries(spark, sf_dir))
    return _plain_names(clean.join_price_company(testdata.prices(spark, sf_dir), companies))


@register
def join_price_ratio(spark, sf_dir):
    joined = _plain_names(clean.join_price_ratio(testdata.prices(spark, sf_dir), testdata.ratios(spark, sf_dir)))
    return _nine_places(joined)


@register
def join_data(spark, sf_dir):
    return _nine_places(_plain_names(clean.join_data(**testdata.inputs(spark, sf_dir), clustered=True)))


@register
def check_unique(spark, sf_dir):
    """Suppliers with more than one line shipped on a day: the duplicates a one-to-one join would trip over."""
    lines = testdata.table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("simfinid"), F.col("l_shipdate").cast("date").alias("date")
    )
    return key_violations(lines, ["simfinid", "date"])


@register
def clean_panel(spark, sf_dir):
    return _nine_places(_panel(spark, sf_dir))


@register
def profile_numeric(spark, sf_dir):
    """Moments to ten digits: market values have eleven before the point."""
    df = profile.profile_numeric(_panel(spark, sf_dir), PROFILED)
    moments = ("mean", "std", "skewness", "kurtosis")
    return df.withColumns({m: F.format_string("%.9e", m).try_cast("double") for m in moments})


@register
def profile_quantiles(spark, sf_dir):
    """Exact quantiles, by selection of ranks."""
    stored = stage(_panel(spark, sf_dir).select(*PROFILED), "profiled")
    return _rounded(profile.profile_quantiles_exact(stored, PROFILED))


@register
def profile_quantiles_sketch(spark, sf_dir):
    """The mergeable sketch, for tables that may be read only once."""
    return profile.profile_quantiles(_panel(spark, sf_dir), PROFILED)


@register
def profile_modeling_quantiles(spark, sf_dir):
    """Exact quantiles of all numeric columns of the modeling table."""
    df = _staged_modeling(spark, sf_dir)
    return _rounded(profile.profile_quantiles_exact(df, double_columns(df)))


@register
def profile_by_year(spark, sf_dir):
    """The profile merged from the stored parts of single years (the estimate of different values is left to the tests)."""
    parts = stage(profile.profile_parts(_panel(spark, sf_dir), PROFILED, F.year("date")), "profile-parts")
    df = profile.profile_merged(parts).drop("about_distinct")
    return df.withColumns({m: F.format_string("%.9e", m).try_cast("double") for m in ("mean", "std")})


@register
def profile_distinct(spark, sf_dir):
    return profile.profile_distinct(_panel(spark, sf_dir), ["ticker", "sector", "industry", "date", "adj_close"])


@register
def profile_topk(spark, sf_dir):
    return profile.profile_topk(_panel(spark, sf_dir), ["ticker", "sector", "industry"], 10)


@register
def profile_corr(spark, sf_dir):
    return _rounded(profile.profile_corr(_panel(spark, sf_dir), PROFILED))


@register
def profile_duplicates(spark, sf_dir):
    """Quotes that stand unchanged for more than one day."""
    return profile.profile_duplicates(_panel(spark, sf_dir).select("ticker", "open", "adj_close", "volume"))


# -- features -----------------------------------------------------------------------------------------------------


@register
def market_cap_cat(spark, sf_dir):
    return _rounded(clean.market_cap(_panel(spark, sf_dir)).select("ticker", "date", "market_cap", "market_cap_cat"))


@register
def filter_data(spark, sf_dir):
    return _nine_places(clean.filter_data(clean.market_cap(_panel(spark, sf_dir))))


@register
def filter_dates(spark, sf_dir):
    return _rounded(plans.filtered_panel(_panel(spark, sf_dir), S).select("ticker", "date", "adj_close", "market_cap_cat"))


@register
def change_index(spark, sf_dir):
    df = features.create_returns(plans.filtered_panel(_panel(spark, sf_dir), S), c.CHANGE_INDEX)
    return _rounded(df.select("ticker", "date", "return_index", "p_b_index", "p_fcf_ttm_index"))


def _rolled_columns(spark, sf_dir, sums=(), avgs=(), medians=()):
    df = features.create_returns(plans.filtered_panel(_panel(spark, sf_dir), S), c.CHANGE_INDEX)
    rolled = features.create_rolling_values(df, sums, avgs, medians)
    return _rounded(rolled.select("ticker", "date", *[n for n in rolled.columns if n.startswith("roll_")]))


@register
def rolling_sum(spark, sf_dir):
    return _rolled_columns(spark, sf_dir, sums=c.SUM_COLUMNS)


@register
def rolling_avg(spark, sf_dir):
    return _rolled_columns(spark, sf_dir, avgs=c.AVG_COLUMNS)


@register
def rolling_median(spark, sf_dir):
    return _rolled_columns(spark, sf_dir, medians=c.MEDIAN_COLUMNS)


@register
def trading_calendar(spark, sf_dir):
    """Sessions over the span of the data, with the lines shipped on each."""
    sessions = calendar.trading_calendar(testdata.data_span(spark, sf_dir))
    shipped = (
        testdata.table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_shipdate").cast("date").alias("date"))
        .agg(F.count(F.lit(1)).alias("n_lines"))
    )
    return sessions.join(shipped, "date", "left").select("date", F.coalesce("n_lines", F.lit(0)).alias("n_lines"))


@register
def month_day_count(spark, sf_dir):
    bounds = calendar.clip_span(testdata.data_span(spark, sf_dir), S.start_date, S.current_date)
    return calendar.market_schedule(calendar.trading_calendar(bounds, S.holidays))


@register
def days_in_month(spark, sf_dir):
    df = features.days_in_month(plans.filtered_panel(_panel(spark, sf_dir), S))
    return df.select("ticker", "date", "year", "month", "day", "days_in_month")


def _complete(spark, sf_dir):
    panel = _panel(spark, sf_dir)
    return features.complete_months(plans.rolled_panel(panel, S), plans.schedule(panel, S))


@register
def complete_months(spark, sf_dir):
    return _complete(spark, sf_dir).select("ticker", "date", "days_in_month", "cal_days_in_month")


def _lag_columns(df, suffix):
    return _rounded(df.select("ticker", "date", *[n for n in df.columns if n.endswith(suffix)]))


@register
def lag_1m(spark, sf_dir):
    return _lag_columns(features.lag_1m(_complete(spark, sf_dir), c.SUM_COLUMNS, c.AVG_COLUMNS), "_1m_lag")


@register
def lag_3m(spark, sf_dir):
    return _lag_columns(features.lag_3m(_complete(spark, sf_dir), c.SUM_COLUMNS, c.AVG_COLUMNS), "_3m_lag")


@register
def lag_6m(spark, sf_dir):
    return _lag_columns(features.lag_6m(_complete(spark, sf_dir), c.SUM_COLUMNS, c.AVG_COLUMNS), "_6m_lag")


@register
def lag_12m(spark, sf_dir):
    return _lag_columns(features.lag_12m(_complete(spark, sf_dir), c.SUM_COLUMNS, c.AVG_COLUMNS), "_12m_lag")


def _monthly_columns(df):
    lags = [c.lag_name(days, "sum_return_index", months) for months, days in c.MOMENTUM_WINDOW.items()]
    return _rounded(df.select("ticker", "date", "year", "month", "days_in_month", "roll_30day_med_volume", *lags))


@register
def month_end(spark, sf_dir):
    return _monthly_columns(features.month_end(plans.lagged_panel(_panel(spark, sf_dir), S)))


@register
def month_end_liquid(spark, sf_dir):
    return _monthly_columns(plans.monthly_panel(_panel(spark, sf_dir), S))


@register
def momentum(spark, sf_dir):
    return _rounded(plans.momentum_panel(_panel(spark, sf_dir), S).select("ticker", "date", *RATIOS))


@register
def momentum_lags(spark, sf_dir):
    df = plans.momentum_panel(_panel(spark, sf_dir), S)
    return _rounded(df.select("ticker", "date", *[f"{n}_L{k}" for n in LAGGED for k in range(1, S.lag_range)]))


@register
def lead_target(spark, sf_dir):
    df = features.lead_target(plans.momentum_panel(_panel(spark, sf_dir), S))
    return _rounded(df.select("ticker", "date", "return_mom_1_0", TARGET))


@register
def modeling_data(spark, sf_dir):
    return _rounded(_modeling(spark, sf_dir))


@register
def refreshed_modeling(spark, sf_dir):
    """The modeling table built up to July 2001, then refreshed month by month from the state and the month's rows alone."""
    panel = _panel(spark, sf_dir)
    dated, schedule = plans.filtered_panel(panel, S), plans.schedule(panel, S)
    late = stage(splits.slice_between(dated, "2001-08-01", "2001-11-01"), "late")
    state, table = None, None
    for start, end in [(S.start_date, "2001-08-01"), ("2001-08-01", "2001-09-01"), ("2001-09-01", "2001-10-01"), ("2001-10-01", "2001-11-01")]:
        rows = splits.slice_between(dated if state is None else late, start, end)
        state, closed = refresh.refreshed(state, rows, schedule, S, lambda df, name: stage(df, name, "zstd"))
        table = closed if table is None else table.unionByName(closed)
    return _rounded(table.unionByName(refresh.open_rows(state, S)))


@register
def profile_modeling(spark, sf_dir):
    df = _modeling(spark, sf_dir)
    return _rounded(profile.profile_numeric(df, double_columns(df)).drop("skewness", "kurtosis"), digits=5)


@register
def profile_modeling_corr(spark, sf_dir):
    """Correlations of all numeric columns, pairwise complete."""
    df = _staged_modeling(spark, sf_dir)
    return _rounded(profile.profile_corr_wide(df, double_columns(df)))


# -- splits and scaling -------------------------------------------------------------------------------------------


@register
def holdout(spark, sf_dir):
    return _rounded(splits.holdout_set(_modeling(spark, sf_dir), S.modeling_data_date))


@register
def train_x(spark, sf_dir):
    return _rounded(splits.train_set(_modeling(spark, sf_dir), S.modeling_data_date).drop(TARGET))


@register
def train_x_scaled(spark, sf_dir):
    return _rounded(splits.train_val_x(_staged_modeling(spark, sf_dir), S.modeling_data_date), digits=5)


@register
def train_y(spark, sf_dir):
    return _rounded(splits.train_val_y(_modeling(spark, sf_dir), S.modeling_data_date))


@register
def expanding_moments(spark, sf_dir):
    """Count, mean and spread of every numeric column up to each month end, merged from the moments of single months."""
    df = _staged_modeling(spark, sf_dir)
    found = expanding(moments_by(df, double_columns(df)))
    spread = F.when(F.col("n") > 0, F.sqrt(F.col("m2") / F.col("n")))
    return _rounded(found.select("date", "column", "n", "mean", spread.alias("spread"), "low", "high"), digits=5)


@register
def xsec_zscore(spark, sf_dir):
    df = _staged_modeling(spark, sf_dir).drop(TARGET)
    return _rounded(zscore_by(df, "date", double_columns(df), MONTHS), digits=5)


# -- modelling ----------------------------------------------------------------------------------------------------


@register
def encode_index(spark, sf_dir):
    modeling = _staged_modeling(spark, sf_dir)
    df = model.encode_index(splits.train_set(modeling, S.modeling_data_date), modeling)
    return df.select("date", "ticker", "sector", "market_cap_cat", "sector_idx", "market_cap_cat_idx")


@register
def encode_onehot(spark, sf_dir):
    """Dummies of sector and size class, read off the encoder's sparse vectors."""
    df = _staged_modeling(spark, sf_dir).select("date", "ticker", *c.CATEGORICAL)
    encoded, values = model.encode_onehot(df)
    vectors = encoded.withColumns({name: vector_to_array(f"{name}_hot") for name in values})
    dummies = [F.get(name, F.lit(i)).alias(f"{name}_{v}".replace(" ", "_").lower()) for name in values for i, v in enumerate(values[name])]
    return vectors.select("date", "ticker", *dummies)


@register
def target_scale(spark, sf_dir):
    """Scaled target and its way back."""
    train = splits.train_val_y(_staged_modeling(spark, sf_dir), S.modeling_data_date)
    labelled, scale = model.scale_target(train)
    return _rounded(labelled.withColumn("restored", scale.restore(F.col("label"), TARGET)))


@register
def metric_rmse_mape(spark, sf_dir):
    return _rounded(evaluate.error_metrics(_predictions(spark, sf_dir)))


@register
def grid_candidates(spark, sf_dir):
    """Every fit of the fine grid search with the row counts of its fold."""
    split = splits.time_series_split(_modeling(spark, sf_dir), S.modeling_data_date, S.folds)
    return model.planned_fits(split, c.FINE_GRID)


def _holdout_predictions(spark, sf_dir, learner, params):
    """Fit on the train slice, predict the holdout."""
    modeling = _staged_modeling(spark, sf_dir)
    return model.fit_predict(modeling, S.modeling_data_date, "2001-11-01", S.features, params, learner)


@register
def fit_gbt(spark, sf_dir):
    return _holdout_predictions(spark, sf_dir, model.boosted_trees, S.best_params)


@register
def fit_rf(spark, sf_dir):
    params = {"n_estimators": 10, "max_depth": 4, "min_samples_leaf": 2, "min_samples_split": 4}
    return _holdout_predictions(spark, sf_dir, model.random_forest, params)


@register
def fit_gbt_alt(spark, sf_dir):
    params = {"n_estimators": 5, "eta": 0.1, "max_depth": 3, "gamma": 0.0, "lambda": 5.0}
    return _holdout_predictions(spark, sf_dir, model.boosted_trees_alt, params)


def _prepared(spark, sf_dir, onehot=False):
    modeling = _staged_modeling(spark, sf_dir)
    return model.prepare_search(modeling, S.modeling_data_date, S.folds, S.features, onehot=onehot)


# Small trees for the other registered searches: they show the search, not the model.
SMALL_GRID = {"n_estimators": [2, 3], "learning_rate": [0.05, 0.1], "max_depth": [2, 3], "num_leaves": [4, 8],
              "min_data_in_leaf": [5, 10]}


@register
def search_random(spark, sf_dir):
    """The whole coarse search: a thousand draws of the full lists, up to a thousand trees a fit, and the refit."""
    candidates = model.random_candidates(c.COARSE_GRID, c.COARSE_ITERATIONS, seed=7)
    found = model.search(_prepared(spark, sf_dir), candidates, model.boosted_trees)
    return model.cv_summary(found.results)


@register
def search_grid(spark, sf_dir):
    grid = {"n_estimators": [2, 3], "learning_rate": [0.05, 0.1], "max_depth": [2, 3]}
    found = model.search(_prepared(spark, sf_dir), model.grid_candidates(grid), model.boosted_trees)
    return model.cv_summary(found.results)


@register
def search_forest(spark, sf_dir):
    grid = {"n_estimators": [3, 5], "max_depth": [3, 4], "min_samples_leaf": [2, 4]}
    prepared = _prepared(spark, sf_dir, onehot=True)
    found = model.search(prepared, model.random_candidates(grid, 8, seed=7), model.random_forest, "mape")
    return model.cv_summary(found.results)


@register
def cv_results(spark, sf_dir):
    """Score per candidate and fold."""
    candidates = model.random_candidates(SMALL_GRID, 8, seed=11)
    return model.cross_validate(_prepared(spark, sf_dir), candidates, model.boosted_trees).select(
        "candidate", "fold", "score"
    )


@register
def cv_param_effect(spark, sf_dir):
    candidates = model.random_candidates(SMALL_GRID, 8, seed=11)
    return model.cv_param_effect(model.cross_validate(_prepared(spark, sf_dir), candidates, model.boosted_trees))


@register
def search_scores_consistent(spark, sf_dir):
    """One row per candidate and fold of a search with the fold's row counts: every fit has a score, and equal fits agree."""
    prepared = _prepared(spark, sf_dir)
    candidates = model.grid_candidates({"n_estimators": [2, 3], "max_depth": [2, 9], "num_leaves": [4], "learning_rate": [0.1]})
    found = model.cross_validate(prepared, candidates, model.boosted_trees)
    counts = [(f, role, n) for (f, role), n in model.fold_rows(prepared).items()]
    rows = spark.createDataFrame(counts, "fold int, role string, n long").groupBy("fold").pivot("role", ["train", "test"]).sum("n")
    # depth 9 comes to depth 2 with four leaves
    same = found.groupBy("fold", F.col("effective")["n_estimators"].alias("trees")).agg((F.max("score") == F.min("score")).alias("agree"))
    return (
        found.withColumn("trees", F.col("params")["n_estimators"])
        .join(same, ["fold", "trees"])
        .join(rows, "fold")
        .select("candidate", "fold", F.col("trees").cast("int").alias("trees"), (F.col("score") > 0).alias("scored"), "agree",
                F.col("train").alias("n_train"), F.col("test").alias("n_test"))
    )


@register
def seed_stability(spark, sf_dir):
    """The chosen parameters under two hundred seeds, each with its own bag of four fifths of the rows: eight hundred fits and the refit."""
    prepared, params = _prepared(spark, sf_dir), {**c.BEST_PARAMS, "bagging_fraction": 0.8}
    results = model.seed_stability(prepared, params, model.seeds(200), parallelism=8)
    model.refitted(prepared, model.best_params(results), model.boosted_trees)
    return model.cv_summary(results)


@register
def search_halving(spark, sf_dir):
    """Eight candidates: four rounds, from an eighth of the rows (or what leaves rows in every fold) to all."""
    candidates = model.random_candidates(SMALL_GRID, 8, seed=3)
    return model.halving_search(_prepared(spark, sf_dir), candidates, model.boosted_trees)


@register
def feature_importance(spark, sf_dir):
    prepared = _prepared(spark, sf_dir)
    fitted = prepared.estimator(model.boosted_trees, S.best_params).fit(prepared.rows)
    return model.feature_importance(fitted, prepared.names, spark)


@register
def walk_forward(spark, sf_dir):
    return model.walk_forward(_staged_modeling(spark, sf_dir), S.walk_pairs, S.features, S.best_params)


@register
def walk_forward_rows(spark, sf_dir):
    """Dates, names and targets of the walk-forward predictions, each with a prediction."""
    return _rounded(
        walk_forward(spark, sf_dir).select("date", "ticker", TARGET, F.col("predictions").isNotNull().alias("predicted"))
    )


@register
def production_predictions(spark, sf_dir):
    return model.production_predictions(
        _staged_modeling(spark, sf_dir), S.production_train, S.production_test, S.features, S.best_params, S.top_n
    )


# -- evaluation ---------------------------------------------------------------------------------------------------


@register
def top_n(spark, sf_dir):
    return _rounded(evaluate.top_predictions(_predictions(spark, sf_dir), S.top_n))


@register
def mean_returns(spark, sf_dir):
    return _rounded(evaluate.mean_returns(_staged_predictions(spark, sf_dir), S.top_n))


@register
def performance_summary(spark, sf_dir):
    return _rounded(evaluate.performance_summary(_staged_predictions(spark, sf_dir), S.top_n))


# -- portfolio ----------------------------------------------------------------------------------------------------


@register
def market_dates(spark, sf_dir):
    return _schedule(spark, sf_dir)


def _per_name(df: DataFrame, value: str, digits: int) -> DataFrame:
    """Daily rows of a basket, told by name: a thousand days and a hundred names per date are too many to compare one by one."""
    return df.groupBy("date_r", "ticker").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count(value).alias("n_values"),
        F.min("date").alias("first_date"),
        F.max("date").alias("last_date"),
        F.round(F.min(value), digits).alias("low"),
        F.round(F.max(value), digits).alias("high"),
        F.round(F.sum(value), digits).alias("total"),
        # bound to the order of days: a swap of two days shows
        F.round(F.sum(F.col(value) * F.datediff("date", F.lit("1995-01-01").cast("date"))), min(digits, 3)).alias("by_day"),
    )


@register
def basket_history(spark, sf_dir):
    return _per_name(_history(spark, sf_dir), "adj_close", 2)


@register
def complete_case(spark, sf_dir):
    return _per_name(portfolio.complete_case(_baskets(spark, sf_dir)), "adj_close", 2)


@register
def pivot_prices(spark, sf_dir):
    picks, panel = _picks_and_panel(spark, sf_dir)
    return portfolio.pivot_prices(portfolio.basket_prices(picks, panel, PICK_ROWS), picks, S.top_n)


@register
def basket_returns(spark, sf_dir):
    return _per_name(portfolio.basket_returns(_baskets(spark, sf_dir)), "ret", 5)


@register
def cov_pairs(spark, sf_dir):
    return _rounded(portfolio.covariance_rows(_covariance(spark, sf_dir), "sample"))


@register
def cov_shrunk(spark, sf_dir):
    df = _covariance(spark, sf_dir)
    rows = portfolio.covariance_rows(df, "shrunk")
    return _rounded(rows.join(df.select("date_r", "n_obs", "shrinkage"), "date_r"), digits=5)


@register
def views(spark, sf_dir):
    return _rounded(portfolio.views(_picks_and_panel(spark, sf_dir)[0], S.confidence))


@register
def bl_posterior(spark, sf_dir):
    picks, panel = _picks_and_panel(spark, sf_dir)
    returns = portfolio.return_vectors(portfolio.basket_prices(picks, panel, PICK_ROWS))
    return portfolio.bl_posterior(portfolio.shrunk_covariance(returns), portfolio.views(picks, S.confidence))


@register
def portfolio_weights(spark, sf_dir):
    picks, panel = _picks_and_panel(spark, sf_dir)
    return portfolio.optimal_weights(picks, panel, S.confidence, PICK_ROWS)


@register
def basket_status(spark, sf_dir):
    """What became of every rebalancing date."""
    picks, panel = _picks_and_panel(spark, sf_dir)
    dates = _schedule(spark, sf_dir).select(F.col("month_end_date").alias("date"))
    return portfolio.basket_status(dates, portfolio.basket_posterior(picks, panel, S.confidence, PICK_ROWS))


@register
def posterior_residual(spark, sf_dir):
    """Whether the posterior of every basket meets its equations."""
    picks, panel = _picks_and_panel(spark, sf_dir)
    returns = portfolio.return_vectors(portfolio.basket_prices(picks, panel, PICK_ROWS))
    covariance = stage(portfolio.shrunk_covariance(returns), "covariance")
    views = portfolio.views(picks, S.confidence)
    return portfolio.posterior_residual(covariance, views, portfolio.bl_posterior(covariance, views))


@register
def weights_optimality(spark, sf_dir):
    """Whether the weights of every basket meet the conditions of the best ratio: sum, sign and slopes."""
    picks, panel = _picks_and_panel(spark, sf_dir)
    posterior = portfolio.basket_posterior(picks, panel, S.confidence, PICK_ROWS)
    return portfolio.weights_optimality(stage(posterior, "posterior"))


@register
def clean_weights(spark, sf_dir):
    return portfolio.clean_weights(_rank_weights(_picks_and_panel(spark, sf_dir)[0]))


@register
def positions(spark, sf_dir):
    return _rounded(_held(spark, sf_dir)[0])


@register
def position_prices(spark, sf_dir):
    return _rounded(_priced(spark, sf_dir))


@register
def position_values(spark, sf_dir):
    values = portfolio.position_values(stage(_priced(spark, sf_dir), "priced"), S.initial_amount)
    return _ten_digits(
        values.select("date", "ticker", "weights", "portfolio_amount", "begin_dollar_amount", "shares_held", "end_dollar_amount")
    )


@register
def period_returns(spark, sf_dir):
    priced = stage(_priced(spark, sf_dir), "priced")
    return _ten_digits(portfolio.period_returns(portfolio.position_values(priced, S.initial_amount)))


@register
def backtest(spark, sf_dir):
    return _ten_digits(portfolio.backtest(_priced(spark, sf_dir), S.initial_amount))


@register
def portfolio_backtesting(spark, sf_dir):
    """Optimised weights, held and compounded."""
    picks, panel = _picks_and_panel(spark, sf_dir)
    return portfolio.portfolio_backtesting(
        picks.drop("rank"), panel, _schedule(spark, sf_dir), S.initial_amount, S.confidence, PICK_ROWS
    )


@register
def production_weights(spark, sf_dir):
    """Model, ranking and optimiser for the latest month end."""
    panel = stage(_panel(spark, sf_dir), "intro_cleaned_data")
    modeling = stage(plans.modeling_data(panel, S), "modeling_data")
    picks = model.production_predictions(
        modeling, S.production_train, S.production_test, S.features, S.best_params, S.top_n
    )
    bounds = calendar.clip_span(testdata.data_span(spark, sf_dir), S.production_start, S.production_end)
    dates = calendar.market_dates(calendar.trading_calendar(bounds, S.holidays), S.last_production)
    rows = S.top_n * calendar.month_count(S.production_start, S.production_end)
    return portfolio.portfolio_optimization(picks, panel, dates, S.confidence, rows)
