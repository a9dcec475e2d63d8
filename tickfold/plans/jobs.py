"""Whole runs. Every catalogued result is written as Parquet and read back by the steps that need it."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickfold import config as c
from tickfold.config import Settings
from tickfold.functions.scaling import double_columns
from tickfold.operators import calendar, evaluate, model, portfolio, profile, splits
from tickfold.plans import panel as plans
from tickfold.sources import files

# Group of results -> results; each has a folder of its own below the group's.
GROUPS = {
    "panel": ("intro_cleaned_data", "modeling_data"),
    "profiles": tuple(
        f"{table}_{kind}"
        for table in ("cleaned_data", "modeling_data")
        for kind in ("numeric", "quantiles", "distinct", "top_values", "correlations", "duplicates")
    ),
    "sets": ("holdout_data", "train_x_data", "train_y_data", "time_series_split"),
    "models": ("rfr_model", "xgb_model", "lgbm_coarse_cv_model", "lgbm_fine_cv_model", "random_state_model"),
    "tuning": (
        "rfr_cv_results", "xgb_cv_results", "lgbm_coarse_cv_results", "lgbm_fine_cv_results", "lgbm_coarse_param_effect",
        "lgbm_fine_param_effect", "random_state_results", "lgbm_halving_results",
    ),
    "predictions": ("holdout_results_data", "top_predictions_view_data", "performance_summary_data"),
    "portfolio": (
        "market_dates_data", "basket_status_data", "backtesting_results_data", "production_predictions_data",
        "production_dates_data", "production_status_data", "production_results_data",
    ),
}
CATALOG = {name: group for group, names in GROUPS.items() for name in names}


@dataclass(frozen=True)
class Run:
    """One run: where results go, and its settings."""

    spark: SparkSession
    base: str
    settings: Settings

    def path(self, name: str) -> str:
        return f"{self.base}/{CATALOG[name]}/{name}"

    def save(self, name: str, df: DataFrame) -> DataFrame:
        files.write_parquet(df, self.path(name))
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def load(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))


def data_processing(run: Run, inputs: dict[str, DataFrame], clustered: bool = False) -> DataFrame:
    panel = plans.clean_panel(inputs, clustered=clustered)
    files.write_panel(panel, run.path("intro_cleaned_data"))
    return files.read_panel(run.spark, run.path("intro_cleaned_data"))


def _panel(run: Run) -> DataFrame:
    return files.read_panel(run.spark, run.path("intro_cleaned_data"))


def _profile(run: Run, table: str, df: DataFrame) -> None:
    """Every column of a stored table, text and dates too."""
    numbers = double_columns(df)
    run.save(f"{table}_numeric", profile.profile_numeric(df, numbers))
    run.save(f"{table}_quantiles", profile.profile_quantiles_exact(df, numbers))
    run.save(f"{table}_distinct", profile.profile_distinct(df, df.columns))
    run.save(f"{table}_top_values", profile.profile_topk(df, df.columns, 10))
    run.save(f"{table}_correlations", profile.profile_corr_wide(df, numbers))
    run.save(f"{table}_duplicates", profile.profile_duplicates(df))


def raw_data_eda(run: Run) -> None:
    _profile(run, "cleaned_data", _panel(run))


def feature_engineering(run: Run) -> DataFrame:
    return run.save("modeling_data", plans.modeling_data(_panel(run), run.settings))


def final_data_eda(run: Run) -> None:
    _profile(run, "modeling_data", run.load("modeling_data"))


def train_test_splits(run: Run) -> None:
    s, modeling = run.settings, run.load("modeling_data")
    run.save("holdout_data", splits.holdout_set(modeling, s.modeling_data_date))
    run.save("train_x_data", splits.train_val_x(modeling, s.modeling_data_date))
    run.save("train_y_data", splits.train_val_y(modeling, s.modeling_data_date))
    run.save("time_series_split", splits.time_series_split(modeling, s.modeling_data_date, s.folds))


def _prepared(run: Run, onehot: bool = False) -> model.Prepared:
    s = run.settings
    return model.prepare_search(run.load("modeling_data"), s.modeling_data_date, s.folds, s.features, onehot=onehot)


def _search(run: Run, prepared, name: str, candidates, learner, metric: str) -> model.SearchResult:
    found = model.search(prepared, candidates, learner, metric)
    run.save(f"{name}_cv_results", model.cv_summary(found.results))
    path = run.path(f"{name}_model" if name in ("rfr", "xgb") else f"{name}_cv_model")
    model.save_model(found.model, path, run.spark)
    return found


def exploratory_models(run: Run, iterations: int = c.EXPLORATORY_ITERATIONS) -> None:
    """Random forest and the other boosted trees: random search by percentage error, categories as dummies."""
    prepared = _prepared(run, onehot=True)
    for name, grid, learner in (
        ("rfr", c.FOREST_GRID, model.random_forest),
        ("xgb", c.XGB_GRID, model.boosted_trees_alt),
    ):
        _search(run, prepared, name, model.random_candidates(grid, iterations), learner, "mape")


def coarse_hyperparameter_tuning(run: Run, iterations: int = c.COARSE_ITERATIONS, grid=None) -> None:
    candidates = model.random_candidates(grid or c.COARSE_GRID, iterations)
    found = _search(run, _prepared(run), "lgbm_coarse", candidates, model.boosted_trees, "rmse")
    run.save("lgbm_coarse_param_effect", model.cv_param_effect(found.results))


def fine_hyperparameter_tuning(run: Run, grid=None, seed_count: int = 200) -> None:
    """Grid search, its parameter effects, the seed test of the chosen parameters and a model with the best seed."""
    prepared = _prepared(run)
    found = _search(
        run, prepared, "lgbm_fine", model.grid_candidates(grid or c.FINE_GRID), model.boosted_trees, "rmse"
    )
    run.save("lgbm_fine_param_effect", model.cv_param_effect(found.results))
    seeds = model.seed_stability(prepared, run.settings.best_params, model.seeds(seed_count))
    run.save("random_state_results", model.cv_summary(seeds))
    best = model.refitted(prepared, model.best_params(seeds), model.boosted_trees)
    model.save_model(best, run.path("random_state_model"), run.spark)


def halving_tuning(run: Run, iterations: int = c.COARSE_ITERATIONS, grid=None) -> None:
    """Successive halving over draws of the wide grid, round by round."""
    candidates = model.random_candidates(grid or c.HALVING_GRID, iterations)
    run.save("lgbm_halving_results", model.halving_search(_prepared(run), candidates, model.boosted_trees))


def model_holdout_testing_results(run: Run) -> None:
    s = run.settings
    results = run.save(
        "holdout_results_data", model.walk_forward(run.load("modeling_data"), s.walk_pairs, s.features, s.best_params)
    )
    run.save("top_predictions_view_data", evaluate.top_predictions(results, s.top_n))
    run.save("performance_summary_data", evaluate.performance_summary(results, s.top_n))


def _dates(run: Run, name: str, start: str, end: str, last: str) -> DataFrame:
    sessions = calendar.trading_calendar(calendar.span(run.spark, start, end), run.settings.holidays)
    return run.save(name, calendar.market_dates(sessions, last))


def _status(run: Run, name: str, picks: DataFrame, dates: DataFrame, rows: int) -> None:
    """One row for each rebalancing date, also where no weights came out."""
    days = dates.select(F.col("month_end_date").alias("date"))
    chosen = picks.join(F.broadcast(days), "date", "left_semi")
    run.save(name, portfolio.basket_status(days, portfolio.basket_posterior(chosen, _panel(run), run.settings.confidence, rows)))


def portfolio_backtesting(run: Run) -> DataFrame:
    s = run.settings
    dates = _dates(run, "market_dates_data", s.schedule_start, s.schedule_end, s.last_prediction)
    rows = s.top_n * calendar.month_count(s.schedule_start, s.schedule_end)
    picks = run.load("top_predictions_view_data")
    _status(run, "basket_status_data", picks, dates, rows)
    results = portfolio.portfolio_backtesting(picks, _panel(run), dates, s.initial_amount, s.confidence, rows)
    return run.save("backtesting_results_data", results)


def production_results(run: Run) -> DataFrame:
    s = run.settings
    predictions = model.production_predictions(
        run.load("modeling_data"), s.production_train, s.production_test, s.features, s.best_params, s.top_n
    )
    picks = run.save("production_predictions_data", predictions)
    dates = _dates(run, "production_dates_data", s.production_start, s.production_end, s.last_production)
    rows = s.top_n * calendar.month_count(s.production_start, s.production_end)
    _status(run, "production_status_data", picks, dates, rows)
    results = portfolio.portfolio_optimization(picks, _panel(run), dates, s.confidence, rows)
    return run.save("production_results_data", results)


def default_run(run: Run, inputs: dict[str, DataFrame], clustered: bool = False) -> None:
    """Inputs to backtest and production weights, without searches and profiles."""
    data_processing(run, inputs, clustered)
    feature_engineering(run)
    train_test_splits(run)
    model_holdout_testing_results(run)
    portfolio_backtesting(run)
    production_results(run)


def raw_eda(run: Run, inputs: dict[str, DataFrame], clustered: bool = False) -> None:
    data_processing(run, inputs, clustered)
    raw_data_eda(run)


def full_eda(run: Run, inputs: dict[str, DataFrame], clustered: bool = False) -> None:
    raw_eda(run, inputs, clustered)
    feature_engineering(run)
    final_data_eda(run)


def full_run_without_eda(run: Run, inputs: dict[str, DataFrame], clustered: bool = False) -> None:
    """Inputs to tuned models: thousands of fits with the default grids."""
    data_processing(run, inputs, clustered)
    feature_engineering(run)
    train_test_splits(run)
    exploratory_models(run)
    coarse_hyperparameter_tuning(run)
    fine_hyperparameter_tuning(run)
