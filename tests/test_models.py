"""Split, training, intervals, explanation and streaming scores."""

import itertools
import math

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from salescope.operators import artifact, explain, modeling, scoring
from salescope.operators.contracts import ContractError, FeatureSchema
from salescope.operators.modeling import Candidate, boosting, forest, linear
from salescope.plans import jobs
from salescope.sources import sinks
from salescope.streaming.scoring import compare_batch, log_batch, score_stream, write_logs, write_scored

SCHEMA = FeatureSchema(("x1", "x2"), ("cat",), "y")


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(0)
    data = [
        (i, float(a), float(b), "abc"[i % 3], float(4 + a * a + 0.2 * b + 3 * (i % 3 == 2) + rng.normal(0, 0.1)))
        for i, (a, b) in enumerate(rng.uniform(-3, 3, (600, 2)))
    ]
    df = spark.createDataFrame(data, "id long, x1 double, x2 double, cat string, y double")
    return modeling.hash_folds(modeling.hash_split(df, ["id"]), ["id"]).cache()


SMALL = [
    Candidate("linear", linear),
    Candidate("forest", forest, ({"numTrees": 8, "maxDepth": 5},), {"numTrees": [4], "maxDepth": [2, 5]}),
]


@pytest.fixture(scope="module")
def fitted(spark, rows, tmp_path_factory):
    result = modeling.train(rows, SCHEMA, SMALL[1:], "baseline")
    path = str(tmp_path_factory.mktemp("model"))
    sinks.save_model(result.pipeline, path, modeling.model_metadata(result, spark, "p", {"q_hat": 1.5}))
    model, metadata = sinks.load_model(spark, path)
    assert metadata.first()["q_hat"] == 1.5
    return model, explain.read_ensemble(spark, f"{path}/model", model)


def test_split_is_disjoint_and_stable(rows):
    counts = {r["split"]: r["count"] for r in rows.groupBy("split").count().collect()}
    assert 0.12 < counts["test"] / 600 < 0.28
    again = modeling.hash_split(rows.drop("split").repartition(13), ["id"])
    assert again.join(rows.select("id", F.col("split").alias("s")), "id").where("split <> s").count() == 0


def test_modes_and_nonlinear_target(spark, rows):
    sizes = {m: len(modeling.train(rows, SCHEMA, SMALL, m).scores) for m in ("baseline", "tuned", "both")}
    assert sizes == {"baseline": 2, "tuned": 1, "both": 3}
    board = modeling.train(rows, SCHEMA, SMALL, "baseline").leaderboard(spark).collect()
    assert board[0]["model_name"] == "forest" and board[0]["rmse"] < board[1]["rmse"]
    with pytest.raises(ValueError):
        modeling.train(rows, SCHEMA, SMALL, "other")
    with pytest.raises(ValueError):
        modeling.train(rows, SCHEMA, [], "both")
    with pytest.raises(RuntimeError):
        modeling.train(rows, SCHEMA, SMALL[:1], "tuned")


def test_best_follows_the_metric(spark, rows):
    result = modeling.train(rows, SCHEMA, SMALL, "baseline", primary_metric="r2")
    assert result.best.model_name == "forest"
    board = result.leaderboard(spark)
    assert modeling.best_by(board, "r2").first()["model_name"] == "forest"
    assert modeling.best_by(board, "rmse").first()["model_name"] == "forest"


def test_random_draws_are_seeded():
    c = Candidate("f", forest, grid={"numTrees": [1, 2, 3], "maxDepth": [1, 2, 3]}, draws=4)
    assert c.points() == c.points() and len(c.points()) == 4


def test_preprocessing_learns_from_train_only(spark):
    schema = FeatureSchema(("x",), ("cat",), "y")
    data = [(1.0, "a", 1.0, "train"), (2.0, "a", 2.0, "train"), (3.0, "b", 3.0, "train"), (4.0, "b", 4.0, "train"),
            (5000.0, "unseen", 5.0, "test")]
    df = spark.createDataFrame(data, "x double, cat string, y double, split string")
    model = modeling.train(df, schema, [Candidate("linear", linear)], "baseline").pipeline
    assert model.stages[1].mean[0] == 2.5
    scored = model.transform(df.where("split = 'test'")).first()
    assert list(scored["cat__hot"].toArray()) == [0.0, 0.0] and math.isfinite(scored["prediction"])


def test_preprocessing_of_all_folds_at_once(spark):
    """Scans don't grow with the folds; every model is the one that its own fit gives."""
    schema = FeatureSchema(("x", "k"), ("cat", "odd"), "y")
    rng = np.random.default_rng(5)
    data = [(float(x) * 1e3 + 7e8, int(k), [None, "b", "a", "\U0001f600", "\uffee", "B"][c], "uv"[i % 2] if i != 9 else "only", i % 3 if i else None)
            for i, (x, k, c) in enumerate(zip(rng.normal(size=400), rng.integers(0, 9, 400), rng.integers(0, 6, 400)))]
    df = spark.createDataFrame(data, "x double, k int, cat string, odd string, fold int").repartition(3).cache()
    whole, folds = modeling.fit_preprocessors(df, schema, [0, 1, 2])
    for got, rows in [(whole, df), *((folds[k], df.where(F.col("fold") != k)) for k in range(3))]:
        want = Pipeline(stages=modeling.preprocessor_stages(schema)).fit(rows)
        assert [type(s) for s in got.stages] == [type(s) for s in want.stages]
        assert np.allclose(got.stages[1].mean, want.stages[1].mean, rtol=1e-12) and np.allclose(got.stages[1].std, want.stages[1].std, rtol=1e-9)
        assert got.stages[2].labelsArray == want.stages[2].labelsArray
        one, other = (m.transform(df) for m in (got, want))
        same = [np.array([r[0].toArray() for r in t.select("features").collect()]) for t in (one, other)]
        assert np.allclose(*same, atol=1e-9)
        names = [explain.slot_features(t, schema) for t in (one, other)]
        assert names[0] == names[1]
    with pytest.raises(ValueError):
        modeling.fit_preprocessors(df.limit(0), schema)


def test_training_joins_its_input_once(spark, rows):
    """Preparation, folds and fits scan a copy of the input, not the input."""
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    watched = rows.select("x1", "x2", "cat", "y", "split", "fold").mapInArrow(count, "x1 double, x2 double, cat string, y double, split string, fold int")
    assert len(modeling.train(watched, SCHEMA, SMALL, "both").scores) == 3
    assert seen.value == 600


def test_a_training_job_reads_its_input_once(spark, rows):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    watched = rows.select("id", "x1", "x2", "cat", "y").mapInArrow(count, "id long, x1 double, x2 double, cat string, y double")
    job = jobs.train_job(watched, SCHEMA, ["id"], SMALL[:1], mode="baseline")
    assert job.reports["leaderboard"].count() == 1 and seen.value == 600


def brute_force_shap(model, x):
    """All subsets, by walking each tree with unknown features averaged by cover."""
    d = len(x)

    def value(known):
        def walk(n):
            if model.left[n] < 0:
                return model.value[n]
            f = model.feature[n]
            if f in known:
                return walk(model.left[n] if x[f] <= model.threshold[n] else model.right[n])
            kids = model.left[n], model.right[n]
            return sum(model.cover[k] / model.cover[n] * walk(k) for k in kids)

        return sum(w * walk(r) for r, w in zip(model.roots, model.weights))

    phi = np.zeros(d)
    for i in range(d):
        others = [j for j in range(d) if j != i]
        for k in range(d):
            for s in itertools.combinations(others, k):
                weight = math.factorial(k) * math.factorial(d - k - 1) / math.factorial(d)
                phi[i] += weight * (value({*s, i}) - value(set(s)))
    return phi, value(set())


def test_shap_equals_brute_force(fitted, rows):
    model, ensemble = fitted
    scored = model.transform(rows.limit(6)).collect()
    x = np.array([r["features"].toArray() for r in scored])
    trees = ensemble.block(range(8))
    phi, base = explain.shap_values(trees, x)
    for row, got in zip(x, phi):
        want, want_base = brute_force_shap(trees, row)
        assert np.allclose(got, want, atol=1e-9) and base == pytest.approx(want_base)


def random_trees(rng, trees, depth, features):
    """Full trees with repeated features on their paths, parents first."""
    left, right, feature, threshold, value, cover, roots = [], [], [], [], [], [], []

    def grow(level, size):
        at = len(left)
        for column, x in zip((left, right, feature, threshold, value, cover), (-1, -1, -1, 0.0, float(rng.normal()), float(size))):
            column.append(x)
        if level < depth and size > 1:
            part = int(rng.integers(1, size))
            feature[at], threshold[at] = int(rng.integers(features)), float(rng.integers(-3, 4)) / 2
            left[at], right[at] = grow(level + 1, part), grow(level + 1, size - part)
        return at

    for _ in range(trees):
        roots.append(grow(0, 10_000))
    return explain.Ensemble(*map(np.array, (roots, left, right, feature, threshold, value, cover)), np.full(trees, 1 / trees))


@pytest.mark.parametrize("depth,features,tabulated", [(4, 3, 5), (7, 2, 5), (7, 7, 5), (0, 3, 0), (13, 40, 0)])
def test_tables_of_shap_values(depth, features, tabulated):
    rng = np.random.default_rng(3)
    trees = random_trees(rng, 5, depth, features)
    tables = explain.tabulate(trees)
    assert sum(t is not None for t in tables.steps) == tabulated
    x = rng.integers(-4, 5, (3_000, features)) / 2  # values right on the thresholds too
    (want, want_base), (got, base) = explain.shap_values(trees, x), explain.shap_values(trees, x, tables)
    assert np.allclose(got, want, atol=1e-12) and base == want_base
    none = explain.tabulate(trees, cells=1)  # no room: every tree is walked
    assert none.steps == [None] * 5 and np.allclose(explain.shap_values(trees, x, none)[0], want, atol=1e-12)


@pytest.mark.parametrize("which", ["forest", "boosting"])
def test_contributions_add_up(spark, rows, fitted, which):
    if which == "forest":
        model, ensemble = fitted
    else:
        model = modeling.train(rows, SCHEMA, [Candidate("b", boosting, ({"maxIter": 6, "maxDepth": 3},))], "baseline").pipeline
        ensemble = explain.ensemble_of(spark, model)
    scored = model.transform(rows)
    out = explain.explain_rows(scored, ensemble, SCHEMA, ["id"])
    gap = F.abs(F.col("prediction") - F.col("base_value") - F.expr("aggregate(map_values(contributions), 0D, (a, b) -> a + b)"))
    assert out.agg(F.max(gap)).first()[0] < 1e-9 and out.count() == 600
    top = explain.top_contributions(out, 2).first()["top"]
    assert len(top) == 2 and abs(top[0]["value"]) >= abs(top[1]["value"])
    assert explain.mean_abs_shap(out).first()["feature"] == "x1"
    assert explain.split_importance(scored, model, SCHEMA).first()["feature"] == "x1"


def test_member_quantiles(spark, rows, fitted):
    model, ensemble = fitted
    row = explain.member_intervals(model.transform(rows), ensemble).select("features", "prediction", "ensemble").first()
    members = explain.member_values(ensemble.block(range(8)), row["features"].toArray()[None, :])[0]
    assert members.mean() == pytest.approx(row["prediction"])
    assert (row["ensemble"]["lower"], row["ensemble"]["upper"]) == pytest.approx(tuple(np.quantile(members, [0.1, 0.9])))


def test_blocks_of_trees_change_nothing(spark, rows, fitted):
    model, whole = fitted
    cut = explain.ensemble_of(spark, model)
    cut = explain.Trees(cut.nodes, cut.weights, [[0, 1, 2], [3], [4, 5, 6, 7]], cut.is_forest)
    scored = model.transform(rows).select("id", "prediction", "features")
    explained = [explain.explain_rows(scored, m, SCHEMA, ["id"]).orderBy("id").toPandas() for m in (whole, cut)]
    assert explained[0]["id"].tolist() == explained[1]["id"].tolist()
    values = [np.array([[r[f] for f in SCHEMA.features] for r in e["contributions"]]) for e in explained]
    assert np.allclose(*values, atol=1e-9) and np.allclose(explained[0]["base_value"], explained[1]["base_value"])
    ends = [explain.member_intervals(scored, m).select("id", "ensemble.*").orderBy("id").toPandas() for m in (whole, cut)]
    assert np.allclose(ends[0].to_numpy(), ends[1].to_numpy(), atol=1e-9)
    assert explain.explain_rows(scored.limit(0), cut, SCHEMA, ["id"]).count() == 0


def test_full_forest_is_explained(spark, rows):
    """The default forest: 180 trees, depth 30."""
    model = modeling.train(rows, SCHEMA, [Candidate("forest", forest)], "baseline").pipeline
    trees = explain.ensemble_of(spark, model)
    assert len(trees.weights) == 180
    out = explain.explain_rows(model.transform(rows.limit(40)), trees, SCHEMA)
    gap = F.abs(F.col("prediction") - F.col("base_value") - F.expr("aggregate(map_values(contributions), 0D, (a, b) -> a + b)"))
    assert out.agg(F.max(gap)).first()[0] < 1e-9


def test_interval_branches(spark):
    df = spark.createDataFrame([(10.0,)], "prediction double")
    get = lambda **k: scoring.interval_cascade(df, **k).first().asDict()
    assert get(q_hat=1.25) == {"prediction": 10.0, "p10": 8.75, "p90": 11.25, "interval_method": "conformal_intervals"}
    assert (get(residual=(-2.0, 3.0))["p10"], get(residual=(-2.0, 3.0))["p90"]) == (8.0, 13.0)
    for unusable in (-1.0, float("nan"), float("inf"), None):
        assert get(q_hat=unusable, residual=(-2.0, 3.0))["interval_method"] == "residual_quantiles"
        assert get(q_hat=unusable)["interval_method"] is None
    member = df.withColumn("e", F.struct(F.lit(9.0).alias("lower"), F.lit(12.0).alias("upper")))
    row = scoring.interval_cascade(member, residual=(-2.0, 3.0), ensemble="e").first()
    assert (row["p10"], row["p90"], row["interval_method"]) == (9.0, 12.0, "ensemble_quantiles")


def test_linear_model_has_no_tree_explanation(rows):
    model = modeling.train(rows, SCHEMA, SMALL[:1], "baseline").pipeline
    assert not explain.is_tree_model(model)


def test_stream_equals_batch(spark, rows, fitted, tmp_path):
    model, _ = fitted
    feed, out = str(tmp_path / "feed"), str(tmp_path / "out")
    rows.select("x1", "x2", "cat").unionByName(
        spark.createDataFrame([(None, 1.0, "a")], "x1 double, x2 double, cat string")
    ).write.json(feed)
    stream = spark.readStream.schema("x1 double, x2 double, cat string").json(feed)
    assert score_stream(stream, model, SCHEMA).isStreaming
    other = modeling.train(rows, SCHEMA, SMALL[:1], "baseline").pipeline
    write_scored(stream, model, other, SCHEMA, out, str(tmp_path / "ck"), ("f", "l"), True).awaitTermination()
    write_scored(stream, model, other, SCHEMA, out, str(tmp_path / "ck"), ("f", "l"), True).awaitTermination()
    log = spark.read.json(out)
    assert log.count() == 600
    want = scoring.score(rows, model, SCHEMA)[0].agg(F.sum("prediction")).first()[0]
    assert log.agg(F.sum("primary_prediction")).first()[0] == pytest.approx(want)
    assert log.where("abs(prediction_delta - (shadow_prediction - primary_prediction)) > 1e-9").count() == 0


class _Broken:
    def transform(self, df):
        raise RuntimeError("no shadow today\nsecond line")


def test_one_read_three_logs_and_a_batch_that_runs_again(spark, rows, fitted, tmp_path):
    model, _ = fitted
    other = modeling.train(rows, SCHEMA, SMALL[:1], "baseline").pipeline
    feed, root, ck = str(tmp_path / "feed"), str(tmp_path / "logs"), tmp_path / "ck"
    bad = spark.createDataFrame([(None, 1.0, "a"), (None, 2.0, None)], "x1 double, x2 double, cat string")
    rows.select("x1", "x2", "cat").unionByName(bad).repartition(3).write.json(feed)
    run = lambda: write_logs(
        spark.readStream.schema("x1 double, x2 double, cat string").option("maxFilesPerTrigger", 1).json(feed), model, SCHEMA, root, str(ck), other, 1.5,
        available_now=True,
    ).awaitTermination()

    def check():
        predictions, log = spark.read.parquet(f"{root}/predictions"), spark.read.parquet(f"{root}/compared")
        assert predictions.select("batch_id").distinct().count() == 3
        assert (predictions.count(), log.count()) == (600, 600)
        assert sorted(tuple(r["reasons"]) for r in spark.read.parquet(f"{root}/rejects").collect()) == [("x1",), ("x1", "cat")]
        want = scoring.score(rows, model, SCHEMA)[0].agg(F.sum("prediction")).first()[0]
        assert predictions.agg(F.sum("prediction")).first()[0] == pytest.approx(want)
        assert log.agg(F.sum("primary_prediction")).first()[0] == pytest.approx(want)
        want = scoring.score(rows, other, SCHEMA)[0].agg(F.sum("prediction")).first()[0]
        assert log.agg(F.sum("shadow_prediction")).first()[0] == pytest.approx(want)
        assert predictions.where("abs(p10 - prediction + 1.5) > 1e-9 OR interval_method <> 'conformal_intervals'").count() == 0
        state = spark.read.parquet(f"{root}/batches").agg(*[F.sum(c) for c in ("records", "predicted", "rejected", "compared")], F.count("shadow_error")).first()
        assert tuple(state) == (602, 600, 2, 600, 0)

    run()
    check()
    # The run is taken back before its last commit: the batch runs again and overwrites its folders.
    for name in ("2", ".2.crc"):
        (ck / "commits" / name).unlink(missing_ok=True)
    run()
    check()


def test_a_failing_shadow_leaves_predictions(spark, rows, fitted, tmp_path):
    model, _ = fitted
    root, batch = str(tmp_path / "logs"), rows.select("x1", "x2", "cat")
    log_batch(batch, 7, model, _Broken(), SCHEMA, root, residual=(-1.0, 1.0))
    state = spark.read.parquet(f"{root}/batches").first()
    assert (state["records"], state["predicted"], state["compared"], state["shadow_error"]) == (600, 600, None, "no shadow today")
    assert spark.read.parquet(f"{root}/predictions").where("interval_method = 'residual_quantiles'").count() == 600
    compare_batch(spark, root, 7, model, SCHEMA)  # later, from the predictions
    assert spark.read.parquet(f"{root}/compared").where("prediction_delta = 0").count() == 600


def test_logs_of_an_empty_batch(spark, rows, fitted, tmp_path):
    model, _ = fitted
    root = str(tmp_path / "logs")
    log_batch(rows.select("x1", "x2", "cat").limit(0), 0, model, model, SCHEMA, root)
    state = spark.read.parquet(f"{root}/batches").first()
    assert (state["records"], state["predicted"], state["rejected"], state["compared"], state["shadow_error"]) == (0, 0, 0, 0, None)


@pytest.mark.parametrize("intervals", [{"q_hat": 1.5}, {"q_hat": math.nan, "residual": (3.0, -2.0)}, {"residual": (math.nan, 1.0)}, {"q_hat": -1.0}])
def test_a_saved_pipeline_scores_raw_rows(spark, rows, fitted, tmp_path, intervals):
    model, _ = fitted
    train = rows.where("split = 'train'")
    medians = artifact.training_medians(train, SCHEMA)
    assert medians == {c: pytest.approx(np.median([r[c] for r in train.collect()])) for c in SCHEMA.numeric}
    artifact.scoring_pipeline(model, SCHEMA, medians, **intervals).write().overwrite().save(str(tmp_path / "m"))
    raw = spark.createDataFrame(
        [(1, "0.5", 1.0, "a", "kept"), (2, "n/a", None, "b", None), (3, None, float("nan"), None, "x"), (4, "1e999", 2.0, "new", "y")],
        "id long, x1 string, x2 double, cat string, `odd name` string",
    )
    clean = spark.createDataFrame(
        [(1, 0.5, 1.0, "a"), (2, medians["x1"], medians["x2"], "b"), (3, medians["x1"], medians["x2"], "Unknown"), (4, medians["x1"], 2.0, "new")],
        "id long, x1 double, x2 double, cat string",
    )
    got = type(model).load(str(tmp_path / "m")).transform(raw)
    assert got.columns == ["id", "odd name", "x1", "x2", "cat", "prediction", "p10", "p90", "interval_method"]
    known = {k: v for k, v in intervals.items() if k == "q_hat" or not any(map(math.isnan, v))}  # a NaN residual gives no interval
    want = scoring.interval_cascade(model.transform(clean), **known).select("id", "prediction", "p10", "p90", "interval_method")
    assert sorted(map(tuple, got.select(want.columns).collect())) == sorted(map(tuple, want.collect()))


def test_a_saved_pipeline_needs_its_columns_and_medians(spark, fitted):
    with pytest.raises(ContractError):
        artifact.scoring_pipeline(fitted[0], SCHEMA, {"x1": 1.0})
    whole = artifact.scoring_pipeline(fitted[0], SCHEMA, {"x1": 1.0, "x2": 2.0})
    with pytest.raises(Exception, match="x2"):
        whole.transform(spark.createDataFrame([("a", 1.0)], "cat string, x1 double"))
