"""Splits, preprocessing, candidate models, search and leaderboard."""

from __future__ import annotations

import random
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import ExitStack, nullcontext
from dataclasses import dataclass, field
from itertools import product

from pyspark import SparkContext
from pyspark.ml import Estimator, PipelineModel
from pyspark.ml.feature import OneHotEncoder, StandardScaler, StandardScalerModel, StringIndexer, StringIndexerModel, VectorAssembler
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.ml.wrapper import JavaWrapper
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salescope.functions.hashing import hash_bucket, row_text
from salescope.functions.scalar import utc_now_text
from salescope.operators.contracts import FeatureSchema
from salescope.operators.evaluation import regression_metrics
from salescope.session import held


def hash_split(df: DataFrame, key: Sequence[str], test_percent: int = 20) -> DataFrame:
    """Adds ``split`` (train / test) from a hash of the row key.

    Unlike a random split it does not depend on the partitioning, and a row keeps its
    side when the table grows.
    """
    bucket = hash_bucket(row_text(df, key))
    return df.withColumn("split", F.when(bucket < test_percent, "test").otherwise("train"))


def hash_folds(df: DataFrame, key: Sequence[str], folds: int = 3) -> DataFrame:
    """Adds ``fold`` 0..folds-1, independent of the train/test bucket."""
    return df.withColumn("fold", hash_bucket(F.concat(F.lit("fold|"), row_text(df, key)), folds).cast("int"))


def preprocessor_stages(schema: FeatureSchema) -> list:
    """Scaled numerics next to one-hot categories in ``features``.

    A category unseen in training becomes all zeros. The distinct categories and one
    mean and deviation per numeric are all that reaches the driver.
    """
    stages, inputs = [], []
    if schema.numeric:
        stages += [
            VectorAssembler(inputCols=list(schema.numeric), outputCol="numeric_raw"),
            StandardScaler(inputCol="numeric_raw", outputCol="numeric_scaled", withMean=True, withStd=True),
        ]
        inputs.append("numeric_scaled")
    if schema.categorical:
        indexed = [f"{c}__index" for c in schema.categorical]
        hot = [f"{c}__hot" for c in schema.categorical]
        stages += [
            StringIndexer(inputCols=list(schema.categorical), outputCols=indexed, handleInvalid="keep",
                          stringOrderType="alphabetAsc"),
            OneHotEncoder(inputCols=indexed, outputCols=hot, dropLast=True),  # the dropped one is "unseen"
        ]
        inputs += hot
    return [*stages, VectorAssembler(inputCols=inputs, outputCol="features")]


def _merged(parts: Sequence[tuple[int, float, float]]) -> tuple[float, float]:
    """Mean and sample deviation of a column from count, mean and squared deviations of its parts."""
    n, mean, squares = 0, 0.0, 0.0
    for m, part_mean, part_squares in parts:
        gap = part_mean - mean
        squares += part_squares + gap * gap * n * m / (n + m)
        mean += gap * m / (n + m)
        n += m
    return mean, (squares / (n - 1)) ** 0.5 if n > 1 else 0.0


def _ragged(rows: Sequence[Sequence[str]]):
    """A Java array of string arrays of their own lengths (pyspark's own are filled up with null)."""
    gateway = SparkContext._active_spark_context._gateway
    out = gateway.new_array(gateway.jvm.java.lang.String, len(rows), 0)
    for i, row in enumerate(rows):
        out[i] = JavaWrapper._new_java_array(list(row), gateway.jvm.java.lang.String)
    return out


def fit_preprocessors(rows: DataFrame, schema: FeatureSchema, folds: Sequence[int] = ()) -> tuple[PipelineModel, dict[int, PipelineModel]]:
    """The ``preprocessor_stages`` fitted on all rows, and for each fold on the rows of the other folds.

    All of them come from one scan for the numerics and one for the categories, counted by ``fold``.
    """
    key = (F.col("fold") if folds else F.lit(None).cast("int")).alias("fold")
    number = [F.col(c).cast("double") for c in schema.numeric]
    moments = [F.struct(F.count(c), F.avg(c), F.var_pop(c) * F.count(c)) for c in number]
    parts = rows.groupBy(key).agg(F.count(F.lit(1)), *moments).collect()
    if not parts:
        raise ValueError("there are no rows to fit the preprocessing on")
    kinds = F.inline(F.array(*[F.struct(F.lit(i).alias("at"), F.col(c).cast("string").alias("kind")) for i, c in enumerate(schema.categorical)]))
    seen = rows.select(key, kinds).where("kind IS NOT NULL").distinct().collect() if schema.categorical else []

    def fitted(belongs: Callable[[int | None], bool]) -> PipelineModel:
        stages, at = preprocessor_stages(schema), rows
        some = [p for p in parts if belongs(p["fold"])]
        for i, stage in enumerate(stages):
            if isinstance(stage, StandardScaler):
                columns = [_merged([tuple(p[j + 2]) for p in some if p[j + 2][0]]) for j in range(len(number))]
                mean, deviation = (Vectors.dense(x) for x in zip(*columns))
                stages[i] = stage._copyValues(StandardScalerModel(
                    JavaWrapper._new_java_obj("org.apache.spark.ml.feature.StandardScalerModel", stage.uid, deviation, mean)))
            elif isinstance(stage, StringIndexer):
                labels = [sorted({r["kind"] for r in seen if r["at"] == j and belongs(r["fold"])}) for j in range(len(schema.categorical))]
                stages[i] = stage._copyValues(StringIndexerModel(
                    JavaWrapper._new_java_obj("org.apache.spark.ml.feature.StringIndexerModel", stage.uid, _ragged(labels))))
            elif isinstance(stage, OneHotEncoder):
                stages[i] = stage.fit(at)  # sizes are in the columns' metadata: no pass
            at = stages[i].transform(at)
        return PipelineModel(stages)

    return fitted(lambda k: True), {k: fitted(lambda own, k=k: own is not None and own != k) for k in folds}


@dataclass(frozen=True)
class Candidate:
    """An estimator factory with its explicit parameter sets and search grid.

    ``draws`` limits the search to that many seeded draws from the grid.
    """

    name: str
    make: Callable[..., Estimator]
    parameters: Sequence[Mapping[str, object]] = ({},)
    grid: Mapping[str, Sequence[object]] = field(default_factory=dict)
    draws: int | None = None
    folds: int = 3

    def points(self, seed: int = 42) -> list[dict]:
        every = [dict(zip(self.grid, values)) for values in product(*self.grid.values())]
        if self.draws is None or self.draws >= len(every):
            return every
        return random.Random(seed).sample(every, self.draws)


def linear(**params) -> Estimator:
    return LinearRegression(featuresCol="features", predictionCol="prediction", regParam=0.0, **params)


def forest(**params) -> Estimator:
    settings = {"numTrees": 180, "maxDepth": 30, "featureSubsetStrategy": "all", "seed": 42, "cacheNodeIds": True,
                "maxMemoryInMB": 512, **params}
    return RandomForestRegressor(featuresCol="features", predictionCol="prediction", **settings)


def boosting(**params) -> Estimator:
    settings = {"maxIter": 120, "stepSize": 0.08, "maxDepth": 3, "seed": 42, "maxMemoryInMB": 512, **params}
    return GBTRegressor(featuresCol="features", predictionCol="prediction", **settings)


# The parameter sets and grids below.


def sales_candidates() -> list[Candidate]:
    """Linear, forest and boosting with the default parameter sets and search grids."""
    return [
        Candidate("LinearRegression", linear),
        Candidate("RandomForestRegressor", forest, ({"numTrees": 180, "maxDepth": 30},),
                  {"numTrees": [180, 260], "maxDepth": [30, 12], "minInstancesPerNode": [1, 3]}),
        Candidate("GradientBoostingRegressor", boosting, ({"maxIter": 120, "stepSize": 0.08, "maxDepth": 3},),
                  {"maxIter": [120, 180], "stepSize": [0.05, 0.08], "maxDepth": [3]}),
    ]


def small_grid_candidates() -> list[Candidate]:
    """The explicit parameter sets of the logged small-grid run (no search)."""
    return [
        Candidate("LinearRegression", linear),
        Candidate("RandomForestRegressor", forest, ({"numTrees": 100, "maxDepth": 30}, {"numTrees": 300, "maxDepth": 10})),
        Candidate("GradientBoostingRegressor", boosting,
                  ({"maxIter": 100, "stepSize": 0.1, "maxDepth": 3}, {"maxIter": 200, "stepSize": 0.05, "maxDepth": 3})),
    ]


def random_search_candidates() -> list[Candidate]:
    """Baselines and a forest searched by 15 seeded draws over three folds."""
    return [
        Candidate("LinearRegression", linear),
        Candidate("RandomForest", forest, ({"numTrees": 200, "maxDepth": 30},),
                  {"numTrees": [100, 200, 300, 400], "maxDepth": [30, 5, 10, 20], "minInstancesPerNode": [1, 2, 4],
                   "featureSubsetStrategy": ["sqrt", "log2", "all"]}, draws=15),
        Candidate("GradientBoosting", boosting, ({"maxIter": 100, "stepSize": 0.1, "maxDepth": 3},)),
    ]


# Fixed list: whether a smaller value of the metric is better.
SMALLER_IS_BETTER = {"mse": True, "rmse": True, "mae": True, "r2": False}
MODES = ("baseline", "tuned", "both")


@dataclass(frozen=True)
class Score:
    model_name: str
    stage: str
    parameters: Mapping[str, object]
    metrics: Mapping[str, float]


@dataclass(frozen=True)
class TrainingResult:
    pipeline: PipelineModel
    best: Score
    scores: Sequence[Score]
    schema: FeatureSchema
    primary_metric: str

    def leaderboard(self, spark) -> DataFrame:
        """``rank, model_name, stage, parameters, mse, rmse, mae, r2``, best first."""
        rows = [
            (i + 1, s.model_name, s.stage, {k: str(v) for k, v in s.parameters.items()},
             *[float(s.metrics[m]) for m in ("mse", "rmse", "mae", "r2")])
            for i, s in enumerate(ranked(self.scores, self.primary_metric))
        ]
        return spark.createDataFrame(
            rows,
            "rank int, model_name string, stage string, parameters map<string,string>, mse double, rmse double, "
            "mae double, r2 double",
        )


def ranked(scores: Sequence[Score], metric: str) -> list[Score]:
    sign = 1 if SMALLER_IS_BETTER[metric] else -1
    return sorted(scores, key=lambda s: sign * s.metrics[metric])


def best_by(leaderboard: DataFrame, metric: str) -> DataFrame:
    """One row: the best model name of a stored leaderboard, whichever way the metric points."""
    pick = F.min_by if SMALLER_IS_BETTER[metric] else F.max_by
    return leaderboard.agg(pick("model_name", metric).alias("model_name"), pick(metric, metric).alias(metric))


def _metrics(model, frame: DataFrame, target: str) -> dict[str, float]:
    return regression_metrics(model.transform(frame), target).first().asDict()


def train(
    split: DataFrame,
    schema: FeatureSchema,
    candidates: Sequence[Candidate],
    mode: str = "both",
    primary_metric: str = "rmse",
    parallelism: int = 2,
    seed: int = 42,
    hold: bool = True,
) -> TrainingResult:
    """Fit the candidates on ``split = 'train'``, score on 'test', keep the best.

    Features are prepared once, fitted on the training side only, and held for all fits;
    for cross-validation once more for each fold, fitted without its held-out part.
    ``hold=False`` is for an input that is cheap to scan several times.
    ``tuned`` searches each grid by cross-validation on the ``fold`` column and refits
    the best point on the whole training side. Fits are independent Spark jobs, so a
    few run side by side.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    if primary_metric not in SMALLER_IS_BETTER:
        raise ValueError(f"unsupported metric: {primary_metric}")
    if not candidates:
        raise ValueError("at least one candidate is required")
    schema.check()
    target = schema.target
    tuned = mode in ("tuned", "both") and any(c.grid for c in candidates)
    columns = [*schema.features, target, "split", *(["fold"] if tuned else [])]
    folds = sorted({k for c in candidates if c.grid for k in range(c.folds)}) if tuned else []
    narrow = split.select(*columns)

    with ExitStack() as stack:
        data = stack.enter_context(held(narrow) if hold else nullcontext(narrow))
        prep, without = fit_preprocessors(data.where("split = 'train'"), schema, folds)
        train_side = data.where("split = 'train'")

        def ready(model: PipelineModel, side: DataFrame) -> DataFrame:
            return stack.enter_context(held(model.transform(side).select("features", target)))

        # Sides have tables of their own, so that a fit or a score reads no rows of the other.
        fit_rows, test_rows = ready(prep, train_side), ready(prep, data.where("split = 'test'"))
        inside = {k: ready(without[k], train_side.where(F.col("fold") != k)) for k in folds}
        outside = {k: ready(without[k], train_side.where(F.col("fold") == k)) for k in folds}

        def fit(candidate: Candidate, params: Mapping[str, object], frame: DataFrame):
            return candidate.make(**params).setLabelCol(target).fit(frame)

        def baseline(task):
            candidate, params = task
            model = fit(candidate, params, fit_rows)
            return model, Score(candidate.name, "baseline", dict(params), _metrics(model, test_rows, target))

        def validation(task):
            candidate, params, k = task
            return _metrics(fit(candidate, params, inside[k]), outside[k], target)[primary_metric]

        def search(candidate: Candidate):
            points = candidate.points(seed)
            tasks = [(candidate, p, k) for p in points for k in range(candidate.folds)]
            values = list(pool.map(validation, tasks))
            n = candidate.folds
            means = [sum(values[i * n : (i + 1) * n]) / n for i in range(len(points))]
            choose = min if SMALLER_IS_BETTER[primary_metric] else max
            best = points[means.index(choose(means))]
            model = fit(candidate, best, fit_rows)
            return model, Score(candidate.name, "tuned", best, _metrics(model, test_rows, target))

        fitted = []
        with ThreadPoolExecutor(parallelism) as pool:
            if mode in ("baseline", "both"):
                fitted += pool.map(baseline, [(c, p) for c in candidates for p in (c.parameters or ({},))])
            if tuned:
                fitted += [search(c) for c in candidates if c.grid]
    if not fitted:
        raise RuntimeError("no model was trained in this mode")
    scores = [s for _, s in fitted]
    best = ranked(scores, primary_metric)[0]
    model = next(m for m, s in fitted if s is best)
    return TrainingResult(PipelineModel(stages=[*prep.stages, model]), best, scores, schema, primary_metric)


def run_log(result: TrainingResult, spark, run_label: str) -> DataFrame:
    """One row per fitted parameter set, to be appended to a run table."""
    return result.leaderboard(spark).select(F.lit(run_label).alias("run"), F.current_timestamp().alias("logged_at"), "*")


def model_metadata(result: TrainingResult, spark, project: str, extra: Mapping[str, object] | None = None) -> DataFrame:
    """The one-row record saved beside a model: contract, metrics, parameters, intervals."""
    best = result.best
    values = {
        "project_name": project,
        "model_name": best.model_name,
        "feature_names": list(result.schema.features),
        "categorical_features": list(result.schema.categorical),
        "target_name": result.schema.target,
        "parameters": {k: str(v) for k, v in best.parameters.items()},
        "metrics": {k: float(v) for k, v in best.metrics.items()},
        **{k: float(v) for k, v in (extra or {}).items()},
    }
    doubles = "".join(f", {k} double" for k in (extra or {}))
    ddl = (
        "project_name string, model_name string, feature_names array<string>, categorical_features array<string>, "
        "target_name string, parameters map<string,string>, metrics map<string,double>" + doubles
    )
    return spark.createDataFrame([tuple(values.values())], ddl).withColumn("created_at", utc_now_text())
