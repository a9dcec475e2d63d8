from __future__ import annotations

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tickfold import config as c
from tickfold.config import Fold
from tickfold.operators import model

FEATURES = ["sector", "market_cap_cat", "x", "z"]
PARAMS = {"n_estimators": 3, "learning_rate": 0.3, "max_depth": 3, "num_leaves": 8, "min_data_in_leaf": 1}
FOLDS = (Fold("2020-05-01", "2020-06-01", "2020-07-01"), Fold("2020-06-01", "2020-07-01", "2020-09-01"))


@pytest.fixture(scope="module")
def modeling(spark):
    rng = np.random.default_rng(3)
    rows = []
    for month in range(1, 11):
        for i in range(30):
            x, z = rng.normal(size=2)
            y = 1 + 0.1 * float(x) if month < 10 else None
            rows.append((dt.date(2020, month, 28), f"T{i}", "AB"[i % 2], "mid", float(x), float(z), y))
    return spark.createDataFrame(
        rows, "date date, ticker string, sector string, market_cap_cat string, x double, z double, target_1m_mom_lead double"
    ).persist()


def test_parameter_mapping(spark):
    trees = model.boosted_trees({**c.BEST_PARAMS, "max_depth": 10})
    assert (trees.getMaxIter(), trees.getStepSize(), trees.getMinInstancesPerNode()) == (750, 0.0004, 950)
    assert trees.getMaxDepth() == 6  # 64 leaves
    assert model.random_forest({"max_depth": 350, "min_samples_leaf": 2, "min_samples_split": 20}).getMaxDepth() == 30
    assert model.random_forest({"min_samples_leaf": 2, "min_samples_split": 20}).getMinInstancesPerNode() == 10
    assert model.boosted_trees_alt({"eta": 0.01, "gamma": 5.0}).getMinInfoGain() == 5.0


def test_candidates():
    assert len(model.grid_candidates(c.FINE_GRID)) == 7680
    drawn = model.random_candidates(c.COARSE_GRID, 50, seed=1)
    assert drawn == model.random_candidates(c.COARSE_GRID, 50, seed=1) and len(drawn) == 50
    assert all(v in c.COARSE_GRID[k] for d in drawn for k, v in d.items())
    assert len(model.random_candidates({"a": [1, 2]}, 10)) == 2
    assert len(model.seeds()) == 200 and model.seeds()[0] == 1000 and model.seeds()[-1] == 999999


def test_encoding(spark, modeling):
    train = modeling.filter("ticker != 'T0'")
    out = model.encode_index(train, modeling.limit(0).unionByName(modeling)).select("sector", "sector_idx").distinct()
    assert {(r.sector, r.sector_idx) for r in out.collect()} == {("B", 0.0), ("A", 1.0)}
    encoded, values = model.encode_onehot(modeling)
    assert values == {"sector": ["A", "B"], "market_cap_cat": ["mid"]}
    row = encoded.filter("ticker = 'T1'").first()
    assert (list(row.sector_hot), list(row.market_cap_cat_hot)) == ([0.0, 1.0], [1.0])
    unseen, _ = model.encode_onehot(modeling.filter("sector = 'A'"), modeling)
    assert {tuple(r.sector_hot) for r in unseen.collect()} == {(1.0,), (0.0,)}


@pytest.mark.parametrize("n", [40, 2000])
def test_many_categories(spark, modeling, n):
    wide = modeling.withColumn("sector", F.concat(F.lit("s"), (F.row_number().over(Window.orderBy("date", "ticker")) % n).cast("string")))
    train = wide.filter("date < '2020-09-01'") if n == 40 else wide
    encoded, values = model.encode_onehot(wide)
    assert len(values["sector"]) == min(n, 300) and encoded.first().sector_hot.numNonzeros() == 1
    if n == 40:
        for learner in (model.boosted_trees, model.random_forest, model.boosted_trees_alt):
            fitted = model.fit_model(model.scale_features(train), FEATURES, learner, {"n_estimators": 1, "max_depth": 2})
            assert fitted.pipeline.stages[-1].getMaxBins() == 41


def fits_of(candidates, learner=model.boosted_trees, metric="rmse"):
    return len(model.distinct_fits(candidates, learner, metric))


def test_distinct_fits(spark):
    fine = model.grid_candidates(c.FINE_GRID)
    assert fits_of(fine) == 140 and fits_of(fine, metric="mape") == 840
    assert fits_of([{**c.BEST_PARAMS, "random_state": s} for s in model.seeds()]) == 1
    assert fits_of([{**c.BEST_PARAMS, "random_state": s, "subsample": 0.8} for s in (1, 2)]) == 2
    drawn = model.random_candidates(c.FOREST_GRID, 50)
    assert {model.effective(model.random_forest, d)["max_depth"] for d in drawn} == {30.0}


def test_shared_fits_score_like_own_ones(modeling):
    prepared = model.prepare_search(modeling, "2020-09-01", FOLDS, FEATURES)
    candidates = [{**PARAMS, "n_estimators": n, "max_depth": d} for n in (1, 2, 4) for d in (1, 3, 7)]
    got = {(r.candidate, r.fold): r for r in model.cross_validate(prepared, candidates, model.boosted_trees).collect()}
    assert len(got) == 18
    for (i, fold), r in got.items():
        own = model.fold_scores(prepared, fold, model.boosted_trees, candidates[i], [candidates[i]["n_estimators"]], "rmse")
        assert r.score == pytest.approx(own[0], rel=1e-9)
        assert r.effective["max_depth"] == min(candidates[i]["max_depth"], 3) and r.params["max_depth"] == candidates[i]["max_depth"]


def test_empty_folds_are_named(modeling):
    late = (Fold("2020-05-01", "2020-06-01", "2020-07-01"), Fold("2020-06-01", "2021-07-01", "2021-09-01"))
    prepared = model.prepare_search(modeling, "2020-09-01", late, FEATURES)
    with pytest.raises(ValueError, match="fold 2 has no test rows"):
        model.cross_validate(prepared, [PARAMS], model.boosted_trees)
    with pytest.raises(ValueError, match="share of 1e-06"):
        model.cross_validate(model.prepare_search(modeling, "2020-09-01", FOLDS, FEATURES), [PARAMS], model.boosted_trees, share=1e-6)


def test_stored_model_predicts_alone(spark, modeling, tmp_path):
    prepared = model.prepare_search(modeling, "2020-09-01", FOLDS, FEATURES)
    found = model.search(prepared, [PARAMS], model.boosted_trees)
    model.save_model(found.model, str(tmp_path / "m"), spark)
    loaded = model.load_model(str(tmp_path / "m"), spark)
    test = modeling.filter("date = '2020-09-28'")
    rows = loaded.predict_raw(test).orderBy("ticker").collect()
    assert [r.predictions for r in rows] == [r.predictions for r in found.model.predict_raw(test).orderBy("ticker").collect()]
    assert np.corrcoef([r.predictions for r in rows], [r.target_1m_mom_lead for r in rows])[0, 1] > 0.8
    assert 0.5 < rows[0].predictions < 1.5 and loaded.params == PARAMS and loaded.features == tuple(FEATURES)


def test_walk_forward_learns_only_from_the_past(spark, modeling):
    pairs = [("2020-08-01", "2020-09-01"), ("2020-09-01", "2020-10-01")]
    out = model.walk_forward(modeling, pairs, FEATURES, PARAMS)
    rows = out.collect()
    assert sorted({r.date.month for r in rows}) == [8, 9] and len(rows) == 60
    # rows at or after the train date must not change the model
    changed = modeling.selectExpr(
        "date", "ticker", "sector", "market_cap_cat", "x", "z",
        "IF(date >= date'2020-08-01', 1000D, target_1m_mom_lead) AS target_1m_mom_lead",
    )
    again = model.walk_forward(changed, pairs[:1], FEATURES, PARAMS).collect()
    before = {r.ticker: r.predictions for r in rows if r.date.month == 8}
    assert {r.ticker: r.predictions for r in again} == pytest.approx(before)
    fit = np.corrcoef([r.predictions for r in rows], [r.target_1m_mom_lead for r in rows])[0, 1]
    assert fit > 0.8


def test_production_predictions_without_target(modeling):
    out = model.production_predictions(modeling, "2020-10-01", "2020-11-01", FEATURES, PARAMS, 4)
    assert "target_1m_mom_lead" not in out.columns and out.count() == 4


def test_searches(spark, modeling):
    prepared = model.prepare_search(modeling, "2020-09-01", FOLDS, FEATURES)
    candidates = [{**PARAMS, "n_estimators": 1, "max_depth": 1}, PARAMS]
    found = model.search(prepared, candidates, model.boosted_trees)
    assert found.best["n_estimators"] == 3 and found.model.pipeline.stages[-1].getNumTrees == 3
    scores = found.results.collect()
    assert len(scores) == 4 and all(0 < r.score < 10 for r in scores)
    effect = {(r.param, r.value): r.n_candidates for r in model.cv_param_effect(found.results).collect()}
    assert effect[("n_estimators", 3.0)] == 1 and effect[("learning_rate", 0.3)] == 2
    rounds = model.halving_search(prepared, candidates, model.boosted_trees).collect()
    assert [r.share for r in rounds] == [0.5, 0.5, 1.0] and sum(r.kept for r in rounds) == 2
    for share, different in ((0.8, 2), (1.0, 1)):
        seeds = model.seed_stability(prepared, {**PARAMS, "subsample": share}, [1, 2])
        assert len({r.score for r in seeds.filter("fold = 1").collect()}) == different
    names = model.feature_importance(found.model.pipeline.stages[-1], prepared.names, spark, 2).collect()
    assert names[0].feature == "x" and len(names) == 2


def test_walk_forward_equals_single_fits(spark, modeling):
    """Scalers and encoders from common tables give what each fit's own would; a sector appears late, a column is constant."""
    wide = modeling.withColumns({"sector": F.when((F.col("ticker") == "T3") & (F.col("date") > "2020-06-01"), "C").otherwise(F.col("sector")), "flat": F.lit(0.1)})
    features, pairs = [*FEATURES, "flat"], [("2020-04-01", "2020-05-01"), ("2020-08-01", "2020-09-01"), ("2020-09-15", "2020-10-01")]
    got = {(r.date, r.ticker): r.predictions for r in model.walk_forward(wide, pairs, features, PARAMS).collect()}
    want = {}
    for train, test in pairs:
        want |= {(r.date, r.ticker): r.predictions for r in model.fit_predict(wide, train, test, features, PARAMS).collect()}
    assert got == pytest.approx(want) and len(want) == 90


def test_scalers_and_encoders_take_two_jobs(spark, modeling):
    def jobs(run, group):
        spark.sparkContext.setJobGroup(group, "")
        try:
            run()
        finally:
            spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))

    found = []
    assert jobs(lambda: found.append(model.Expanding.fit(modeling, FEATURES)), "fit") <= 6  # two plans with their shuffles, however many dates
    known = found[0]
    assert jobs(lambda: [(known.moments.scale(before=f"2020-{m:02d}-01"), known.indexer(f"2020-{m:02d}-01")) for m in range(2, 11)], "read") == 0


def test_bags_are_drawn_by_hash(modeling):
    import hashlib

    keys = [(r.ticker, str(r.date)) for r in modeling.select("ticker", "date").collect()]
    for seed in (1, 999):
        got = {(r.ticker, str(r.date)) for r in modeling.repartition(7).filter(model.in_bag(seed, 0.7)).select("ticker", "date").collect()}
        want = {k for k in keys if int(hashlib.sha256(f"{seed}:{k[0]}:{k[1]}".encode()).hexdigest()[:8], 16) < int(0.7 * 2**32)}
        assert got == want and 0.6 < len(want) / len(keys) < 0.8


def test_every_seed_is_a_fit(modeling):
    prepared = model.prepare_search(modeling, "2020-09-01", FOLDS, FEATURES)
    params = {**PARAMS, "bagging_fraction": 0.7}
    assert fits_of([{**params, "random_state": s} for s in model.seeds(200)]) == 200
    scores = model.seed_stability(prepared, params, [1, 2, 3, 3]).filter("fold = 1").orderBy("candidate").collect()
    assert len({r.score for r in scores}) == 3 and scores[2].score == scores[3].score
    # a bag is a filter of the rows: the fit equals one on those rows alone
    train_on = model.fold_flags(prepared.folds)[0][2]
    own = model.boosted_trees({**params, "random_state": 2}).setMaxBins(prepared.bins).fit(prepared.rows.filter(train_on).filter(model.in_bag(2, 0.7)))
    test = own.transform(prepared.rows.filter(model.fold_flags(prepared.folds)[1][2])).withColumnRenamed("prediction", "predictions")
    assert model.error_metrics(test, "label").first().rmse == pytest.approx(scores[1].score)


def test_forests_are_read_by_prefix(modeling):
    prepared = model.prepare_search(modeling, "2020-09-01", FOLDS, FEATURES, onehot=True)
    candidates = [{"n_estimators": n, "max_depth": 3, "random_state": 5} for n in (2, 5, 1)]
    assert fits_of(candidates, model.random_forest, "mape") == 1
    assert fits_of(model.random_candidates(c.FOREST_GRID, 500), model.random_forest) < 120
    forest = prepared.estimator(model.random_forest, candidates[1]).fit(prepared.rows.filter(model.fold_flags(FOLDS)[0][2]))
    test = prepared.rows.filter(model.fold_flags(FOLDS)[1][2])
    rows = test.collect()
    for metric in ("mape", "rmse"):
        got = model.prefix_errors(forest, test, [1, 2, 5], metric)
        for n, score in zip((1, 2, 5), got):
            errors = [r.label - sum(t.predict(r.features) for t in forest.trees[:n]) / n for r in rows]
            want = np.sqrt(np.mean(np.square(errors))) if metric == "rmse" else np.mean([abs(e) / abs(r.label) for e, r in zip(errors, rows)])
            assert score == pytest.approx(want)
        whole = model.error_metrics(forest.transform(test).withColumnRenamed("prediction", "predictions"), "label").first()[metric]
        assert got[2] == pytest.approx(whole)
    scores = {r.candidate: r.score for r in model.cross_validate(prepared, candidates, model.random_forest, "mape").filter("fold = 1").collect()}
    assert scores[1] == pytest.approx(model.prefix_errors(forest, test, [5], "mape")[0])


def test_forest_on_dummies(modeling):
    prepared = model.prepare_search(modeling, "2020-09-01", FOLDS, FEATURES, onehot=True)
    assert prepared.names == ("x", "z", "sector_A", "sector_B", "market_cap_cat_mid")
    found = model.search(prepared, [{"n_estimators": 3, "max_depth": 2}], model.random_forest, "mape", refit=False)
    assert found.model is None and found.results.count() == 2


def test_a_refit_draws_its_bag(modeling):
    prepared = model.prepare_search(modeling, "2020-09-01", FOLDS, FEATURES)
    params = {**PARAMS, "bagging_fraction": 0.5, "random_state": 7}
    got = model.refitted(prepared, params, model.boosted_trees).pipeline.stages[-1]
    own = prepared.estimator(model.boosted_trees, params).fit(prepared.rows.filter(model.in_bag(7, 0.5)))
    whole = prepared.estimator(model.boosted_trees, params).fit(prepared.rows)
    assert got.toDebugString.split("\n", 1)[1] == own.toDebugString.split("\n", 1)[1] != whole.toDebugString.split("\n", 1)[1]
