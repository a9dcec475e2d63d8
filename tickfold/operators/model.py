"""Return models on MLlib: encoding, fitting, time-ordered search, walk-forward and production predictions.

Learner parameters keep the names of the usual boosting libraries and are mapped to MLlib's trees, see
:func:`boosted_trees`, :func:`random_forest` and :func:`boosted_trees_alt` for what has no counterpart.
"""

from __future__ import annotations

import itertools
import json
import math
import random
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce
from multiprocessing.pool import ThreadPool

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, StringIndexer, StringIndexerModel, VectorAssembler
from pyspark.ml.regression import GBTRegressor, RandomForestRegressionModel, RandomForestRegressor
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickfold.config import CATEGORICAL, TARGET, Fold
from tickfold.functions.scaling import MomentTable, ZScore, double_columns
from tickfold.operators.evaluate import error_columns, error_metrics, top_predictions
from tickfold.operators.splits import fold_flags, slice_between, train_set
from tickfold.session import stage

MAX_TREE_DEPTH = 30  # MLlib's limit
Params = Mapping[str, float]

# -- encoding -----------------------------------------------------------------------------------------------------


def category_indexer(columns: Sequence[str] = CATEGORICAL) -> StringIndexer:
    """Most frequent value first, ties by name; values unseen in training get an index of their own."""
    return StringIndexer(
        inputCols=list(columns),
        outputCols=[f"{c}_idx" for c in columns],
        handleInvalid="keep",
        stringOrderType="frequencyDesc",
    )


def encode_index(train: DataFrame, other: DataFrame | None = None, columns: Sequence[str] = CATEGORICAL) -> DataFrame:
    """``other`` (or the train rows) with the category indices of the train rows."""
    return category_indexer(columns).fit(train).transform(train if other is None else other)


def onehot_stages(columns: Sequence[str] = CATEGORICAL) -> list:
    """Category index, then one sparse 0/1 vector ``<column>_hot`` per column with a place for every value of training.

    The indexer's place for unseen values is the last and is left out, so those are all zeros. However many values there
    are, a row holds one number.
    """
    hot = OneHotEncoder(
        inputCols=[f"{c}_idx" for c in columns], outputCols=[f"{c}_hot" for c in columns], dropLast=True
    )
    return [category_indexer(columns), hot]


def category_values(indexer, columns: Sequence[str] = CATEGORICAL) -> dict[str, list[str]]:
    """Values per column in the order of their index, of a fitted indexer."""
    return {c: list(values) for c, values in zip(columns, indexer.labelsArray)}


def encode_onehot(train: DataFrame, other: DataFrame | None = None, columns: Sequence[str] = CATEGORICAL):
    """(``other`` or the train rows with the vectors ``<column>_hot``, values per column in vector order)."""
    encoder = Pipeline(stages=onehot_stages(columns)).fit(train)
    encoded = encoder.transform(train if other is None else other).drop(*[f"{c}_idx" for c in columns])
    return encoded, category_values(encoder.stages[0], columns)


def _assemble(numeric: Sequence[str], categorical: Sequence[str], onehot: bool = False) -> list:
    """Pipeline stages from raw columns to ``features``; indexed categories stay nominal for the trees."""
    if not categorical:
        return [VectorAssembler(inputCols=list(numeric), outputCol="features")]
    if onehot:
        inputs = list(numeric) + [f"{c}_hot" for c in categorical]
        return [*onehot_stages(categorical), VectorAssembler(inputCols=inputs, outputCol="features")]
    inputs = [f"{c}_idx" for c in categorical] + list(numeric)
    return [category_indexer(categorical), VectorAssembler(inputCols=inputs, outputCol="features")]


def bins_for(encoder: PipelineModel, onehot: bool = False) -> int:
    """``maxBins`` of the trees: a nominal feature needs a bin for each value and one for unseen values."""
    indexers = [s for s in encoder.stages if hasattr(s, "labelsArray")]
    most = 0 if onehot else max((len(v) for i in indexers for v in i.labelsArray), default=0)
    return max(32, most + 1)


# -- learners -----------------------------------------------------------------------------------------------------


def _depth(params: Params) -> int:
    """Depth limit; a tree of depth d has at most 2^d leaves, so ``num_leaves`` lowers it."""
    depth = int(params.get("max_depth", 5))
    if "num_leaves" in params:
        depth = min(depth, max(1, int(math.log2(params["num_leaves"]))))
    return min(depth, MAX_TREE_DEPTH)


def boosted_trees(params: Params) -> GBTRegressor:
    """Gradient-boosted trees. Random dropping of trees and leaf-wise growth have no counterpart."""
    return GBTRegressor(
        labelCol="label",
        maxIter=int(params.get("n_estimators", 100)),
        stepSize=float(params.get("learning_rate", 0.1)),
        maxDepth=_depth(params),
        minInstancesPerNode=int(params.get("min_data_in_leaf", 20)),
        subsamplingRate=float(params.get("subsample", 1.0)),
        seed=int(params.get("random_state", 1)),
    )


def random_forest(params: Params) -> RandomForestRegressor:
    """Random forest. A node is split only if both sides keep ``min_samples_leaf`` rows, and half of
    ``min_samples_split`` rows, the nearest MLlib has to a lower bound on the node itself."""
    leaf, split = int(params.get("min_samples_leaf", 1)), int(params.get("min_samples_split", 2))
    return RandomForestRegressor(
        labelCol="label",
        numTrees=int(params.get("n_estimators", 100)),
        maxDepth=_depth(params),
        minInstancesPerNode=max(leaf, split // 2, 1),
        seed=int(params.get("random_state", 1)),
    )


def boosted_trees_alt(params: Params) -> GBTRegressor:
    """Boosted trees under the other library's parameter names; ``lambda`` has no counterpart."""
    return GBTRegressor(
        labelCol="label",
        maxIter=int(params.get("n_estimators", 100)),
        stepSize=float(params.get("eta", 0.3)),
        maxDepth=_depth(params),
        minInfoGain=float(params.get("gamma", 0.0)),
        seed=int(params.get("random_state", 1)),
    )


Learner = Callable[[Params], GBTRegressor | RandomForestRegressor]

# MLlib's name of what decides a fit -> name in results.
EFFECTIVE = {
    "maxIter": "n_estimators", "numTrees": "n_estimators", "stepSize": "learning_rate", "maxDepth": "max_depth",
    "minInstancesPerNode": "min_rows", "minInfoGain": "min_gain", "subsamplingRate": "subsample", "seed": "random_state",
}


def effective(learner: Learner, params: Params) -> dict[str, float]:
    """The parameters a fit really has, after limits and missing counterparts.

    Boosting without row sampling draws no random numbers, so its seed is left out; with ``bagging_fraction`` the seed draws
    the bag of rows.
    """
    estimator = learner(params)
    found = {EFFECTIVE[p.name]: float(v) for p, v in estimator.extractParamMap().items() if p.name in EFFECTIVE}
    if (fraction := float(params.get("bagging_fraction", 1.0))) < 1:
        found["bagging_fraction"] = fraction
    elif isinstance(estimator, GBTRegressor) and found["subsample"] == 1.0:
        del found["random_state"]
    return found


def in_bag(seed: int, fraction: float) -> Column:
    """Whether a row belongs to the bag of a seed: decided by a hash of seed, ticker and date alone.

    So a bag is the same whichever way rows are stored or dealt, and no rows are copied for it.
    """
    key = F.concat_ws(":", F.lit(str(int(seed))), "ticker", F.col("date").cast("string"))
    return F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("long") < F.lit(int(fraction * (1 << 32)))


def bagged(rows: DataFrame, params: Params) -> DataFrame:
    """The rows that a fit sees: its seed's bag with ``bagging_fraction`` below 1, else all."""
    fraction = float(params.get("bagging_fraction", 1.0))
    return rows.filter(in_bag(params.get("random_state", 1), fraction)) if fraction < 1 else rows


# -- one fit ------------------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class FittedModel:
    """Feature pipeline with trees, the scaling of features and target, and the chosen parameters."""

    pipeline: PipelineModel
    target_scale: ZScore
    target: str = TARGET
    feature_scale: ZScore = field(default_factory=lambda: ZScore({}, {}))
    features: tuple[str, ...] = ()
    params: Params = field(default_factory=dict)

    def predict(self, scaled: DataFrame) -> DataFrame:
        """Adds ``predictions`` in units of the target. ``scaled`` holds already scaled features."""
        raw = self.pipeline.transform(scaled)
        restored = self.target_scale.restore(F.col("prediction"), self.target)
        return raw.select(*scaled.columns, restored.alias("predictions"))

    def predict_raw(self, df: DataFrame) -> DataFrame:
        """The same for features in their own units, scaled by the train rows' mean and spread."""
        return self.predict(self.feature_scale.transform(df))


def scale_target(train: DataFrame, target: str = TARGET) -> tuple[DataFrame, ZScore]:
    """``label``: the target in standard units."""
    scale = ZScore.fit(train, [target])
    return train.withColumn("label", scale.scaled(target)), scale


def fit_model(
    train: DataFrame, features: Sequence[str], learner: Learner, params: Params, target: str = TARGET,
    feature_scale: ZScore | None = None,
) -> FittedModel:
    """Fit on rows whose features are scaled (by ``feature_scale``) and whose ``target`` is not."""
    categorical = [c for c in CATEGORICAL if c in features]
    numeric = [c for c in features if c not in CATEGORICAL]
    labelled, scale = scale_target(train, target)
    encoder = Pipeline(stages=_assemble(numeric, categorical)).fit(labelled)
    trees = learner(params).setMaxBins(bins_for(encoder)).fit(encoder.transform(labelled))
    pipeline = PipelineModel([*encoder.stages, trees])
    return FittedModel(pipeline, scale, target, feature_scale or ZScore({}, {}), tuple(features), dict(params))


def feature_scale(df: DataFrame, target: str = TARGET) -> ZScore:
    """Mean and spread of all double columns but the target."""
    return ZScore.fit(df, double_columns(df, skip=(target,)))


def scale_features(df: DataFrame, target: str = TARGET) -> DataFrame:
    """All double columns but the target in standard units of these very rows."""
    return feature_scale(df, target).transform(df)


def fit_predict(
    modeling: DataFrame, train_date: str, test_date: str, features: Sequence[str], params: Params,
    learner: Learner = boosted_trees, target: str = TARGET,
) -> DataFrame:
    """Train on dates before ``train_date``, predict [train_date, test_date): (date, ticker, target, predictions).

    The test slice is scaled with its own mean and spread, not the train slice's.
    """
    keys = ["date", "ticker", target, *features]
    rows = train_set(modeling, train_date).select(*keys)
    scale = feature_scale(rows, target)
    model = fit_model(scale.transform(rows), features, learner, params, target, scale)
    test = scale_features(slice_between(modeling, train_date, test_date).select(*keys), target)
    return model.predict(test).select("date", "ticker", target, "predictions")


@dataclass(frozen=True)
class Expanding:
    """What every train and test slice of a walk forward needs, found in two jobs for all dates together.

    Moments and category counts per date add up, so a train slice's scaler and encoder are merges of the dates before it, and
    a test slice's scaler is a merge of its own dates. Both tables have a row per date and column, or per date, column and
    value: bounded by the calendar and by the categories that a tree may have.
    """

    moments: MomentTable
    #: column -> [(date, value, rows)]
    counts: dict[str, list[tuple]]

    @staticmethod
    def fit(modeling: DataFrame, features: Sequence[str], target: str = TARGET) -> "Expanding":
        columns = double_columns(modeling.select(*features, target))
        categorical = [c for c in CATEGORICAL if c in features]
        counts: dict[str, list[tuple]] = {c: [] for c in categorical}
        if categorical:
            cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("value")) for c in categorical])
            found = modeling.select("date", F.inline(cells)).filter("value IS NOT NULL")
            for row in found.groupBy("date", "column", "value").count().collect():
                counts[row["column"]].append((row["date"], row["value"], row["count"]))
        return Expanding(MomentTable.fit(modeling, columns), counts)

    def indexer(self, before: str) -> StringIndexerModel | None:
        """The category indexer of the rows before a date: most frequent value first, ties by name."""
        if not self.counts:
            return None
        labels = []
        for rows in self.counts.values():
            totals: dict[str, int] = {}
            for date, value, n in rows:
                if str(date) < before:
                    totals[value] = totals.get(value, 0) + n
            labels.append(sorted(totals, key=lambda v: (-totals[v], v)))
        columns = list(self.counts)
        return StringIndexerModel.from_arrays_of_labels(labels, columns, [f"{c}_idx" for c in columns], "keep")


def fit_predict_at(
    modeling: DataFrame, known: Expanding, train_date: str, test_date: str, features: Sequence[str], params: Params,
    learner: Learner = boosted_trees, target: str = TARGET,
) -> DataFrame:
    """:func:`fit_predict` with scalers and encoder read off ``known``: only the trees are fitted."""
    keys = ["date", "ticker", target, *features]
    train, test = known.moments.scale(before=train_date), known.moments.scale(train_date, test_date)
    numeric = [c for c in features if c not in CATEGORICAL]
    own, theirs = (ZScore({c: z.means[c] for c in z.means if c != target}, {c: z.spreads[c] for c in z.spreads if c != target}) for z in (train, test))
    target_scale = ZScore({target: train.means[target]}, {target: train.spreads[target]})
    rows = own.transform(train_set(modeling, train_date).select(*keys)).withColumn("label", target_scale.scaled(target))
    indexer = known.indexer(train_date)
    inputs = [*(indexer.getOutputCols() if indexer else []), *numeric]
    stages = [*([indexer] if indexer else []), VectorAssembler(inputCols=inputs, outputCol="features")]
    encoder = PipelineModel(stages)
    trees = learner(params).setMaxBins(bins_for(encoder)).fit(encoder.transform(rows))
    model = FittedModel(PipelineModel([*stages, trees]), target_scale, target, own, tuple(features), dict(params))
    return model.predict(theirs.transform(slice_between(modeling, train_date, test_date).select(*keys))).select("date", "ticker", target, "predictions")


def walk_forward(
    modeling: DataFrame, pairs: Sequence[tuple[str, str]], features: Sequence[str], params: Params,
    learner: Learner = boosted_trees, target: str = TARGET, parallelism: int = 4,
) -> DataFrame:
    """One fit per (train date, test date) pair; all test predictions together.

    Scalers and encoders of all dates come from one table of moments and one of counts (:class:`Expanding`). Every fit is a
    distributed job over the staged modeling table; a few run side by side to fill the cluster.
    """
    known = Expanding.fit(modeling, features, target)
    with ThreadPool(parallelism) as pool:
        parts = pool.map(lambda p: fit_predict_at(modeling, known, p[0], p[1], features, params, learner, target), pairs, chunksize=1)
    return reduce(DataFrame.unionByName, parts)


def production_predictions(
    modeling: DataFrame, train_date: str, test_date: str, features: Sequence[str], params: Params, n: int,
    learner: Learner = boosted_trees, target: str = TARGET,
) -> DataFrame:
    """Best ``n`` names of the latest cross-section; the target is still unknown and left out."""
    scored = fit_predict(modeling, train_date, test_date, features, params, learner, target)
    return top_predictions(scored.drop(target), n)


# -- search -------------------------------------------------------------------------------------------------------


def random_candidates(grid: Mapping[str, Sequence], n: int, seed: int = 0) -> list[dict]:
    """``n`` different draws of grid positions; the whole grid if it is smaller. A value listed twice counts twice."""
    total = math.prod(len(v) for v in grid.values())
    picks = random.Random(seed).sample(range(total), min(n, total))
    candidates = []
    for position in picks:
        candidate = {}
        for name, values in grid.items():
            position, i = divmod(position, len(values))
            candidate[name] = values[i]
        candidates.append(candidate)
    return candidates


def grid_candidates(grid: Mapping[str, Sequence]) -> list[dict]:
    """Every combination of the grid."""
    return [dict(zip(grid, values)) for values in itertools.product(*grid.values())]


def planned_fits(split: DataFrame, grid: Mapping[str, Sequence]) -> DataFrame:
    """Every (fold, candidate) of a grid search with the fold's row counts, the work list of the search."""
    folds = split.groupBy("fold").agg(
        F.count_if(F.col("role") == "train").alias("n_train"), F.count_if(F.col("role") == "test").alias("n_test")
    )
    for name, values in grid.items():
        folds = folds.withColumn(name, F.explode(F.array(*[F.lit(v) for v in values])))
    return folds


@dataclass(frozen=True)
class Prepared:
    """Train rows ready for many fits: ``features``, ``label``, date and ticker in a staged table."""

    rows: DataFrame
    encoder: PipelineModel
    target_scale: ZScore
    names: tuple[str, ...]
    folds: tuple[Fold, ...]
    feature_scale: ZScore
    features: tuple[str, ...]
    bins: int
    target: str = TARGET

    def estimator(self, learner: Learner, params: Params) -> GBTRegressor | RandomForestRegressor:
        return learner(params).setMaxBins(self.bins)

    def fitted(self, trees, params: Params) -> FittedModel:
        """Trees of a search as a whole model, from unencoded features to target units."""
        pipeline = PipelineModel([*self.encoder.stages, trees])
        return FittedModel(pipeline, self.target_scale, self.target, self.feature_scale, self.features, dict(params))


def prepare_search(
    modeling: DataFrame, modeling_data_date: str, folds: Sequence[Fold], features: Sequence[str], target: str = TARGET,
    onehot: bool = False,
) -> Prepared:
    """Scale, encode and assemble once; every fit of the search reads the same staged vectors.

    Features and target are scaled over the whole train slice, so scores are in units of the target's spread.
    """
    train = train_set(modeling, modeling_data_date).select("date", "ticker", target, *features)
    own_scale = feature_scale(train, target)
    scaled, scale = scale_target(own_scale.transform(train), target)
    numeric, categorical = [c for c in features if c not in CATEGORICAL], [c for c in CATEGORICAL if c in features]
    encoder = Pipeline(stages=_assemble(numeric, categorical, onehot)).fit(scaled)
    if onehot and categorical:
        values = category_values(encoder.stages[0], categorical)
        names = numeric + [f"{c}_{v}" for c in categorical for v in values[c]]
    else:
        names = [f"{c}_idx" for c in categorical] + numeric
    encoded = encoder.transform(scaled).select("date", "ticker", "label", "features")
    return Prepared(
        stage(encoded.hint("rebalance"), "train"), encoder, scale, tuple(names), tuple(folds), own_scale, tuple(features),
        bins_for(encoder, onehot), target,
    )


def _part(prepared: Prepared, share: float) -> DataFrame:
    """``share`` < 1 keeps that part of the rows, chosen by key hash."""
    if share >= 1:
        return prepared.rows
    return prepared.rows.filter(F.pmod(F.xxhash64("ticker", "date"), F.lit(1_000_000)) < int(share * 1_000_000))


def fold_rows(prepared: Prepared, share: float = 1.0) -> dict[tuple[int, str], int]:
    """Rows by (fold, role)."""
    flags = fold_flags(prepared.folds)
    counts = _part(prepared, share).agg(*[F.count_if(condition) for _, _, condition in flags]).first()
    return {(number, role): n for (number, role, _), n in zip(flags, counts)}


def require_rows(prepared: Prepared, share: float = 1.0) -> None:
    """Raises if a fold has nothing to train on or to test on: no score would mean anything."""
    for (number, role), n in fold_rows(prepared, share).items():
        if not n:
            raise ValueError(f"fold {number} has no {role} rows at a share of {share:g} of the rows")


def prefix_errors(model: RandomForestRegressionModel, test: DataFrame, trees: Sequence[int], metric: str) -> list[float]:
    """Errors of the forests of a forest's first ``trees`` trees, all in one pass: each row meets every tree once."""
    scored, names = test, []
    for i, tree in enumerate(model.trees):
        names.append(f"_tree_{i}")
        scored = tree.setPredictionCol(names[-1]).transform(scored)
    scored = scored.filter("label IS NOT NULL").select("label", F.array(*names).alias("by_tree"))
    for n in trees:
        scored = scored.withColumn(f"_first_{n}", F.expr(f"aggregate(slice(by_tree, 1, {n}), 0D, (a, x) -> a + x) / {n}"))
    found = scored.agg(*[error_columns(f"_first_{n}", "label")[metric].alias(str(n)) for n in trees]).first()
    return [found[str(n)] for n in trees]


def fold_scores(
    prepared: Prepared, fold: int, learner: Learner, params: Params, trees: Sequence[int], metric: str, share: float = 1.0
) -> list[float]:
    """Errors of one fit on one fold, one for each number of ``trees`` (the first so many of the longest run)."""
    train_on, test_on = (c for number, _, c in fold_flags(prepared.folds) if number == fold)
    rows = _part(prepared, share)
    test = rows.filter(test_on)
    train = bagged(rows.filter(train_on), params)
    model = prepared.estimator(learner, {**params, "n_estimators": max(trees)}).fit(train)
    if len(trees) > 1 and isinstance(model, RandomForestRegressionModel):
        scores = prefix_errors(model, test, trees, metric)
    elif len(trees) > 1:
        errors = model.evaluateEachIteration(test, "squared")
        return [math.sqrt(errors[n - 1]) for n in trees]
    else:
        scores = [error_metrics(model.transform(test).withColumnRenamed("prediction", "predictions"), "label").first()[metric]]
    if None in scores:
        raise ValueError(f"fold {fold} has no test rows with a label at a share of {share:g} of the rows")
    return [float(value) for value in scores]


RESULT = "candidate int, fold int, score double, params map<string,double>, effective map<string,double>"


def distinct_fits(candidates: Sequence[Params], learner: Learner, metric: str) -> list[tuple[dict, dict[int, list[int]]]]:
    """(parameters, candidates by number of trees) of every fit that is needed.

    Candidates that come to the same effective parameters share a fit. Trees are grown one after the other: a shorter
    boosting run is read off the longest one by squared error, and a forest of n trees is the first n of the largest forest
    with the same other parameters, by either error.
    """
    fits: dict[tuple, tuple[dict, dict[int, list[int]]]] = {}
    boosted = bool(candidates) and isinstance(learner(candidates[0]), GBTRegressor)
    for i, params in enumerate(candidates):
        own = effective(learner, params)
        trees = int(own["n_estimators"])
        if not boosted or metric == "rmse" and own.get("subsample") == 1.0:
            del own["n_estimators"]
        _, by_trees = fits.setdefault(tuple(sorted(own.items())), (dict(params), {}))
        by_trees.setdefault(trees, []).append(i)
    return list(fits.values())


def cross_validate(
    prepared: Prepared, candidates: Sequence[Params], learner: Learner, metric: str = "rmse", parallelism: int = 4,
    share: float = 1.0,
) -> DataFrame:
    """Scores of all candidates on all folds: (candidate, fold, score, params, effective).

    The driver only hands out the distinct fits; each one is a distributed job, ``parallelism`` of them at a time.
    """
    require_rows(prepared, share)
    fits = distinct_fits(candidates, learner, metric)
    tasks = [(fit, f) for fit in fits for f in range(1, len(prepared.folds) + 1)]

    def run(task) -> list[tuple[int, int, float]]:
        (params, by_trees), fold = task
        trees = sorted(by_trees)
        scores = fold_scores(prepared, fold, learner, params, trees, metric, share)
        return [(i, fold, score) for n, score in zip(trees, scores) for i in by_trees[n]]

    with ThreadPool(parallelism) as pool:
        found = [row for rows in pool.map(run, tasks, chunksize=1) for row in rows]
    rows = [
        (i, f, score, {k: float(v) for k, v in candidates[i].items()}, effective(learner, candidates[i]))
        for i, f, score in sorted(found)
    ]
    return prepared.rows.sparkSession.createDataFrame(rows, RESULT)


def cv_summary(results: DataFrame) -> DataFrame:
    """Mean and spread of the fold scores per candidate, best first by ``rank``."""
    means = results.groupBy("candidate").agg(
        F.avg("score").alias("mean_score"),
        F.stddev_pop("score").alias("std_score"),
        F.first("params").alias("params"),
        F.first("effective").alias("effective"),
    )
    return means.withColumn("rank", F.row_number().over(Window.orderBy("mean_score", "candidate")))


def best_params(results: DataFrame) -> dict[str, float]:
    """Parameters of the candidate with the lowest mean score."""
    return dict(cv_summary(results).filter("rank = 1").first()["params"])


@dataclass(frozen=True)
class SearchResult:
    results: DataFrame
    best: dict[str, float]
    model: FittedModel | None


def search(
    prepared: Prepared, candidates: Sequence[Params], learner: Learner, metric: str = "rmse", parallelism: int = 4,
    refit: bool = True,
) -> SearchResult:
    """Cross-validate the candidates and refit the best on all train rows."""
    results = cross_validate(prepared, candidates, learner, metric, parallelism)
    best = best_params(results)
    return SearchResult(results, best, refitted(prepared, best, learner) if refit else None)


def refitted(prepared: Prepared, params: Params, learner: Learner) -> FittedModel:
    """A whole model of all train rows, or of the bag that its parameters draw from them."""
    return prepared.fitted(prepared.estimator(learner, params).fit(bagged(prepared.rows, params)), params)


def halving_search(
    prepared: Prepared, candidates: Sequence[Params], learner: Learner, metric: str = "rmse", parallelism: int = 4
) -> DataFrame:
    """Successive halving: each round scores the survivors on twice the rows and keeps the better half.

    It starts with the smallest share that leaves rows in every fold; the last round uses all rows. Returns (round, share,
    candidate, mean_score, rank, kept).
    """
    rounds = int(math.log2(len(candidates))) + 1
    start = 0.5 ** (rounds - 1)
    while start < 1 and not all(fold_rows(prepared, start).values()):
        start *= 2
    alive, parts = list(range(len(candidates))), []
    for r in range(rounds):
        share = 1.0 if r == rounds - 1 else min(1.0, start * 2**r)
        scores = cv_summary(
            cross_validate(prepared, [candidates[i] for i in alive], learner, metric, parallelism, share)
        )
        keep = max(1, len(alive) // 2)
        rows = [
            (r + 1, share, alive[row["candidate"]], row["mean_score"], row["rank"], row["rank"] <= keep)
            for row in scores.orderBy("rank").collect()  # one row per candidate
        ]
        parts += rows
        alive = [row[2] for row in rows if row[5]]
    return prepared.rows.sparkSession.createDataFrame(
        parts, "round int, share double, candidate int, mean_score double, rank int, kept boolean"
    )


def seeds(count: int = 200, first: int = 1000, last: int = 999_999) -> list[int]:
    """Evenly spaced random seeds."""
    return [int(first + (last - first) * i / (count - 1)) for i in range(count)] if count > 1 else [first]


def seed_stability(
    prepared: Prepared, params: Params, seed_list: Sequence[int], learner: Learner = boosted_trees, metric: str = "rmse",
    parallelism: int = 4,
) -> DataFrame:
    """Fold scores of one parameter set under many seeds.

    A seed draws the bag of rows that its trees see (``bagging_fraction`` below 1 in ``params``), so every seed is a fit of its
    own over the one staged table. Without bags all seeds come to one fit and one score, which is then the answer.
    """
    return cross_validate(prepared, [{**params, "random_state": s} for s in seed_list], learner, metric, parallelism)


def cv_param_effect(results: DataFrame) -> DataFrame:
    """Score against each parameter: (param, value, n, mean, min, max), the data behind the tuning plots."""
    return (
        cv_summary(results)
        .select(F.explode("params").alias("param", "value"), "mean_score")
        .groupBy("param", "value")
        .agg(
            F.count(F.lit(1)).alias("n_candidates"),
            F.avg("mean_score").alias("avg_score"),
            F.min("mean_score").alias("min_score"),
            F.max("mean_score").alias("max_score"),
        )
    )


def feature_importance(model, names: Sequence[str], spark, n: int = 40) -> DataFrame:
    """The ``n`` most important features of a fitted tree model."""
    importances = model.featureImportances.toArray()
    rows = [(name, float(v)) for name, v in zip(names, importances)]
    ranked = sorted(rows, key=lambda r: (-r[1], r[0]))[:n]
    return spark.createDataFrame(
        [(i, name, v) for i, (name, v) in enumerate(ranked, start=1)], "rank int, feature string, importance double"
    )


# -- storage ------------------------------------------------------------------------------------------------------


def save_model(model: FittedModel, path: str, spark: SparkSession) -> None:
    """One folder: encoder and trees below ``pipeline``, scales, feature names and parameters in ``about``."""
    model.pipeline.write().overwrite().save(f"{path}/pipeline")
    about = {
        "target": model.target,
        "target_scale": [model.target_scale.means, model.target_scale.spreads],
        "feature_scale": [model.feature_scale.means, model.feature_scale.spreads],
        "features": list(model.features),
        "params": {k: float(v) for k, v in model.params.items()},
    }
    spark.createDataFrame([(json.dumps(about),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/about")


def load_model(path: str, spark: SparkSession) -> FittedModel:
    about = json.loads(spark.read.text(f"{path}/about").first()[0])
    return FittedModel(
        PipelineModel.load(f"{path}/pipeline"),
        ZScore(*about["target_scale"]),
        about["target"],
        ZScore(*about["feature_scale"]),
        tuple(about["features"]),
        about["params"],
    )
