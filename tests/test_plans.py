from __future__ import annotations

import re
import subprocess
import sys
from pathlib import Path

import duckdb
import pytest
from conftest import SMALL

import __spark_entry__ as entry
from tickfold import session
from tickfold.config import FIXTURE
from tickfold.operators import model
from tickfold.plans import jobs
from tickfold.plans import panel as plans
from tickfold.session import configure
from tickfold.sources import files, testdata

sys.path.insert(0, str(Path(__file__).resolve().parents[1] / "tools"))
from check_oracle import TABLES, differs, normal


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for table in TABLES.split():
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    return con


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_every_statement_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize(
    "name", ["modeling_data", "lag_3m", "trading_calendar", "profile_numeric", "xsec_zscore", "cov_shrunk", "backtest"]
)
def test_query_matches_its_statement(spark, db, name):
    got = entry.queries()[name](spark, SMALL).toPandas()
    assert len(got) and differs(normal(got), normal(db.execute(entry.oracle_sql()[name]).df())) is None


def stored_inputs(spark, tmp_path):
    """Inputs as stored tables, the way a user has them."""
    out = {}
    for name, df in testdata.inputs(spark, SMALL).items():
        files.write_parquet(df, str(tmp_path / name))
        out[name] = files.read_parquet(spark, str(tmp_path / name), files.INPUT_SCHEMAS[name])
    return out


def test_panel_is_shuffled_once(spark, tmp_path):
    configure(spark)
    inputs = stored_inputs(spark, tmp_path)
    plan = physical(plans.modeling_data(plans.clean_panel(inputs), FIXTURE))
    by_ticker = re.findall(r"Exchange hashpartitioning\(ticker#\d+, \d+\), REPARTITION_BY_COL", plan, re.I)
    assert len(by_ticker) == 2  # prices and ratios, once each
    others = [line for line in plan.splitlines() if "Exchange" in line and "REPARTITION_BY_COL" not in line]
    # the rest are the dimensions and the month table: keys of companies, industries and calendar only
    assert all(re.search(r"Broadcast|IndustryId|_groupingexpression|SimFinId|ticker#\d+, \d+\), ENSURE", line, re.I) for line in others)
    assert sum("ENSURE_REQUIREMENTS" in line for line in others) <= 4
    assert "Python" not in plan and "Pandas" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_daily_windows_are_merged(spark):
    configure(spark)
    panel = spark.createDataFrame([], files.CLEAN_PANEL)
    plan = physical(plans.modeling_data(panel, FIXTURE))
    # indices, rolling values, month counts, all lags with the month-end mark, monthly lags
    assert len(re.findall(r"[-+] Window \[", plan)) <= 5


def test_scan_reads_only_needed_columns(spark, tmp_path):
    configure(spark)
    inputs = stored_inputs(spark, tmp_path)
    length = "spark.sql.maxMetadataStringLength"
    before = spark.conf.get(length)
    spark.conf.set(length, "10000")
    try:
        panel = plans.clean_panel(inputs, validate=False).select("ticker", "date", "volume")
        read = re.findall(r"ReadSchema: struct<([^>]*)>", physical(panel))
    finally:
        spark.conf.set(length, before)
    prices = [schema for schema in read if "Volume" in schema]
    assert len(prices) == 1 and "Open" not in prices[0] and "Adj. Close" not in prices[0]


def test_clustered_tables_are_not_shuffled(spark, tmp_path):
    """Between the scans of bucketed prices and ratios and the windows no row moves."""
    configure(spark)
    inputs = testdata.inputs(spark, SMALL)
    for name in ("prices", "ratios"):
        files.write_clustered(inputs[name], f"plan_{name}", str(tmp_path / name), "Ticker", ("Date", "SimFinId"), 4)
        inputs[name] = files.read_clustered(spark, f"plan_{name}")
        assert len(list((tmp_path / name).glob("part-*.parquet"))) <= 4  # a bucket is one file
    plan = physical(plans.monthly_panel(plans.clean_panel(inputs, clustered=True), FIXTURE))
    scans = [line for line in plan.splitlines() if "FileScan parquet" in line and "plan_" in line]
    assert len(scans) == 2 and all("Bucketed: true" in line for line in scans)
    # what is dealt by ticker is the companies, and no bucketed scan lies below an exchange
    lines = plan.splitlines()
    depth = [len(line) - len(line.lstrip(" :+-")) for line in lines]
    below = None
    for line, at in zip(lines, depth):
        if below is not None and at <= below:
            below = None
        if below is None and re.search(r"Exchange (hash|range|Single|RoundRobin)", line):
            below = at
        assert below is None or line not in scans, line


def test_inputs_scan_the_lines_once(spark):
    configure(spark)
    adaptive = "spark.sql.adaptive.enabled"
    spark.conf.set(adaptive, "false")
    try:
        plan = physical(plans.clean_panel(testdata.inputs(spark, SMALL), clustered=True))
    finally:
        spark.conf.set(adaptive, "true")
    assert plan.count("l_extendedprice") and len(re.findall(r"FileScan parquet \[[^]]*l_extendedprice", plan)) == 1
    assert "ReusedExchange" in plan


def test_inputs_use_every_line(spark, db):
    start, end = testdata.calendar_days(spark, SMALL)
    seen = testdata._observations(spark, SMALL, start)
    quantity, last = seen.selectExpr("sum(values[2])", "max(Date)").first()
    want = db.execute("SELECT sum(l_quantity), max(CAST(l_shipdate AS DATE)) FROM lineitem").fetchone()
    assert quantity == want[0] and str(last) == end and last >= want[1] and last.weekday() < 5
    days = testdata.filled(spark, SMALL).selectExpr("min(Date)", "max(Date)").first()
    assert (str(days[0]), str(days[1])) == (start, end)


def test_top_n_is_cut_before_the_shuffle(spark):
    assert "WindowGroupLimit" in physical(entry.queries()["top_n"](spark, SMALL))


def test_folds_need_no_join(spark):
    from tickfold.operators import splits

    df = spark.range(5).selectExpr("date'1998-05-01' AS date", "'a' AS ticker")
    plan = physical(splits.time_series_split(df, "2000-07-01", FIXTURE.folds))
    assert "Join" not in plan and "Exchange" not in plan


def test_stage_folder(spark):
    root = session.stage_root(spark)
    assert root == (spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()).rstrip("/")
    df = session.stage(spark.range(3), "numbers")
    assert df.count() == 3 and root.removeprefix("file:") in df.inputFiles()[0]

    class Cluster:
        class conf:
            get = staticmethod(lambda key, default=None: default)

        class sparkContext:
            master = "yarn"
            getCheckpointDir = staticmethod(lambda: None)

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.stage_root(Cluster)


def test_default_run(spark, tmp_path):
    configure(spark)
    settings = FIXTURE.with_(
        top_n=5, walk_pairs=(("2001-03-01", "2001-04-01"),), last_prediction="2001-03-31", schedule_start="2001-03-01"
    )
    run = jobs.Run(spark, str(tmp_path), settings)
    jobs.default_run(run, testdata.inputs(spark, SMALL), clustered=True)
    assert run.load("top_predictions_view_data").count() == 5
    assert [(r.n_names, r.status) for r in run.load("basket_status_data").collect()] == [(5, "ok")]
    test = run.load("backtesting_results_data").collect()
    assert len(test) == 1 and test[0].begin_dollar_amount == pytest.approx(100000, rel=1e-3)
    weights = run.load("production_results_data").collect()
    assert sum(r.weights for r in weights) == pytest.approx(1, abs=1e-3)
    assert run.load("train_x_data").count() == run.load("train_y_data").count() > 0


def test_tuning_runs(spark, tmp_path):
    configure(spark)
    run = jobs.Run(spark, str(tmp_path), FIXTURE.with_(best_params={**FIXTURE.best_params, "n_estimators": 1}))
    run.save("modeling_data", plans.modeling_data(plans.clean_panel(testdata.inputs(spark, SMALL), clustered=True), FIXTURE))
    grid = {"n_estimators": [1], "learning_rate": [0.1, 0.2], "max_depth": [2], "min_data_in_leaf": [1]}
    jobs.fine_hyperparameter_tuning(run, grid, seed_count=1)
    assert run.load("lgbm_fine_cv_results").count() == 2 and run.load("random_state_results").count() == 1
    jobs.halving_tuning(run, 2, grid)
    assert run.load("lgbm_halving_results").count() == 3
    rows = run.load("modeling_data")
    for name in ("lgbm_fine_cv_model", "random_state_model"):
        assert model.load_model(run.path(name), spark).predict_raw(rows).count() == rows.count()
    jobs.final_data_eda(run)
    assert run.load("modeling_data_distinct").count() == len(rows.columns) and run.load("modeling_data_correlations").count() == 88 * 87 / 2
    assert run.load("lgbm_fine_param_effect").filter("param = 'learning_rate'").count() == 2


def test_entry_file_runs_alone():
    code = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"
    root = Path(__file__).resolve().parents[1]
    out = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True, check=True)
    assert int(out.stdout.split()[0]) >= 70


def test_random_search_is_whole(spark, monkeypatch):
    """The registered random search draws all its candidates from the full lists, and refits the best."""
    from tickfold import config as c
    from tickfold.operators import model
    from tickfold.plans import queries

    asked = {}

    def search(prepared, candidates, learner, metric="rmse", parallelism=4, refit=True):
        asked.update(candidates=candidates, metric=metric, refit=refit)
        rows = [(i, 1, float(i), {k: float(v) for k, v in p.items()}, {}) for i, p in enumerate(candidates)]
        return model.SearchResult(spark.createDataFrame(rows, model.RESULT), candidates[0], None)

    monkeypatch.setattr(queries, "_prepared", lambda *_: None)
    monkeypatch.setattr(queries.model, "search", search)
    assert queries.QUERIES["search_random"](spark, SMALL).count() == c.COARSE_ITERATIONS == 1000
    drawn = asked["candidates"]
    assert {k: sorted({p[k] for p in drawn}) for k in drawn[0]} == {k: sorted(set(v)) for k, v in c.COARSE_GRID.items()}
    assert asked["refit"] and asked["metric"] == "rmse"


def test_seed_test_is_whole(spark, monkeypatch):
    """The registered seed test fits the chosen parameters under every seed, and refits the best one."""
    from tickfold import config as c
    from tickfold.plans import queries

    asked, refits = [], []

    def seed_stability(prepared, params, seed_list, learner=model.boosted_trees, metric="rmse", parallelism=4):
        asked.append((params, len(set(seed_list))))
        rows = [(i, 1, float(s != 6020), {**{k: float(v) for k, v in params.items()}, "random_state": float(s)}, {}) for i, s in enumerate(seed_list)]
        return spark.createDataFrame(rows, model.RESULT)

    monkeypatch.setattr(queries, "_prepared", lambda *_: None)
    monkeypatch.setattr(queries.model, "seed_stability", seed_stability)
    monkeypatch.setattr(queries.model, "refitted", lambda prepared, params, learner: refits.append(params))
    assert queries.QUERIES["seed_stability"](spark, SMALL).count() == 200
    (params, seeds), = asked
    assert seeds == 200 and {k: params[k] for k in c.BEST_PARAMS} == c.BEST_PARAMS and params["bagging_fraction"] == 0.8
    assert [p["random_state"] for p in refits] == [6020] and 6020 in model.seeds(200)
