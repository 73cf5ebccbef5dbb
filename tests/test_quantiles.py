"""Exact quantiles against NumPy, on shapes that are hard for selection."""

import inspect

import numpy as np
import pytest
from pyspark.sql import functions as F

from salescope.functions import quantiles as q
from salescope.operators import cleaning, evaluation, profiling


def frame(spark, values, extra=None):
    rows = [(float(v) if v is not None else None, extra(i) if extra else "a") for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "x double, g string")


PROBS = [0.0, 0.05, 0.25, 0.5, 0.9, 1.0]


@pytest.mark.parametrize(
    "values",
    [
        np.random.default_rng(1).normal(size=5001),
        np.repeat([3.0, 7.0], [4000, 1]),  # one value holds nearly every row
        np.concatenate([np.zeros(3000), np.random.default_rng(2).exponential(size=4000)]),
        np.array([5.0]),
        np.arange(10)[::-1],
    ],
)
def test_linear_quantiles(spark, values):
    got = q.column_quantiles(frame(spark, values), ["x"], PROBS)["x"]
    assert np.allclose(got, np.quantile(values, PROBS), rtol=0, atol=1e-12)


def test_images_keep_the_order_and_the_bits(spark):
    rng = np.random.default_rng(6)
    values = np.concatenate([
        rng.integers(0, 2**64, 4000, dtype=np.uint64).view(np.float64), rng.normal(size=500), 2.0 ** np.arange(-1074, 1024), -(2.0 ** np.arange(-60, 70)),
        np.nextafter(2.0 ** np.arange(-1022, 1024), 0), np.nextafter(2.0 ** np.arange(-1022, 1024), np.inf), [0.0, -0.0, 5e-324, 2.2250738585072014e-308, np.finfo(float).max, -np.finfo(float).max],
    ])
    values = values[np.isfinite(values)]
    df = spark.createDataFrame([(float(v),) for v in values], "value double")
    got = np.array([(r["value"], r["image"]) for r in q.with_image(df).collect()], dtype=object)
    bits = np.abs(got[:, 0].astype(float)).view(np.int64) * np.where(got[:, 0].astype(float) < 0, -1, 1)
    assert (got[:, 1].astype(np.int64) == bits).all()


@pytest.mark.parametrize("values", [
    1.0 + np.arange(3000) * 2.0**-52,  # differ in the last bits only
    np.concatenate([-(10.0 ** np.arange(-300, 300)), 10.0 ** np.arange(-300, 300)]),
    np.repeat([-0.0, 0.0, 5e-324, -5e-324], 10),
])
def test_hard_values(spark, values):
    got = q.column_quantiles(frame(spark, np.random.default_rng(0).permutation(values)), ["x"], [0.0, 0.31, 0.5, 1.0])["x"]
    assert np.allclose(got, np.quantile(values, [0.0, 0.31, 0.5, 1.0]), rtol=1e-15, atol=0)


def test_no_task_sorts_more_than_the_digits(spark):
    """Among 2 000 000 different values, a window sees the digits of one prefix: 65 536 at most."""
    df = q.with_image(spark.range(2_000_000).selectExpr("'x' AS feature", "1 + id / 2000000 AS value"))
    assert q._counts(df, ["feature"], 1).count() == 16
    prefixed = df.withColumn("prefix", F.shiftright("image", 48))
    rows = prefixed.where(F.col("prefix") == prefixed.agg(F.min("prefix")).first()[0])
    assert rows.count() == 125_000
    assert q._counts(rows, ["feature", "prefix"], 2).count() == 65_536
    source = inspect.getsource(q)
    assert "percentile" not in source and "LIMIT" not in source


def test_missing_and_not_finite_entries(spark):
    df = frame(spark, [1.0, None, float("nan"), float("inf"), 3.0, float("-inf")])
    row = q.exact_quantiles(df, ["x"], [0.5]).first()
    assert (row["n"], row["values"][0]) == (2, 2.0)
    empty = q.exact_quantiles(df.where("false"), ["x"], [0.5]).first()
    assert (empty["n"], empty["values"][0]) == (0, None)


@pytest.mark.parametrize("threshold", ["10MB", "-1"])
def test_groups_broadcast_and_shuffled(spark, threshold):
    """A hot group, a NULL group and small ones; the same when Spark may not broadcast the passes' state."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    rng = np.random.default_rng(4)
    values = rng.normal(size=3000)
    names = ["hot" if i % 3 else [None, "b", "c", "d"][i % 4] for i in range(3000)]
    df = frame(spark, values, lambda i: names[i])
    got = {r["g"]: (r["n"], r["values"]) for r in q.exact_quantiles(df, ["x"], PROBS, ["g"]).collect()}
    assert set(got) == set(names)
    for g in set(names):
        own = values[[n == g for n in names]]
        assert got[g][0] == len(own)
        assert np.allclose(got[g][1], np.quantile(own, PROBS), rtol=0, atol=1e-12)
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_groups_and_columns_without_entries(spark):
    df = spark.createDataFrame([("a", 1.0, None), ("a", 3.0, None), ("b", None, 2.0), ("b", float("nan"), 4.0)], "g string, x double, y double")
    got = {(r["g"], r["feature"]): (r["n"], r["values"]) for r in q.exact_quantiles(df, ["x", "y"], [0.5], ["g"]).collect()}
    assert got == {("a", "x"): (2, [2.0]), ("a", "y"): (0, [None]), ("b", "x"): (0, [None]), ("b", "y"): (2, [3.0])}


def test_conformal_goldens(spark):
    rows = list(zip((1.0, 2.0, 3.0, 4.0, 5.0), (1.1, 2.2, 2.8, 3.7, 5.1)))
    fit = evaluation.fit_conformal(spark.createDataFrame(rows, "SALES double, prediction double")).first()
    assert fit["q_hat"] == pytest.approx(0.3)
    assert (fit["calibration_size"], fit["empirical_coverage"]) == (5, 1.0)


@pytest.mark.parametrize("n,alpha", [(1, 0.1), (37, 0.1), (200, 0.25), (1001, 0.05)])
def test_conformal_order_statistic(spark, n, alpha):
    errors = np.abs(np.random.default_rng(n).normal(size=n))
    df = spark.createDataFrame([(float(e), 0.0) for e in errors], "SALES double, prediction double")
    level = min(1.0, np.ceil((n + 1) * (1 - alpha)) / n)
    want = np.quantile(errors, level, method="higher")
    assert evaluation.fit_conformal(df, alpha=alpha).first()["q_hat"] == want


def test_conformal_errors(spark):
    df = spark.createDataFrame([(1.0, float("nan"))], "SALES double, prediction double")
    for bad, alpha in ((df.where("false"), 0.1), (df, 0.1), (df, 1.0)):
        with pytest.raises(ValueError):
            evaluation.fit_conformal(bad, alpha=alpha)


def test_calibration_golden(spark):
    rows = list(zip((1.0, 2.0, 3.0, 4.0, 5.0), (1.2, 1.8, 3.1, 3.9, 4.7)))
    df = spark.createDataFrame(rows, "SALES double, prediction double")
    assert evaluation.calibration_error(df, bins=3).first()[0] == pytest.approx(0.1)


def test_iqr_golden(spark):
    df = frame(spark, [1, 2, 2, 4, 4, 4, 5, 6, 100])
    bounds = cleaning.iqr_bounds(df, ["x"]).first()
    assert (bounds["q1"], bounds["q3"], bounds["lower_bound"], bounds["upper_bound"]) == (2, 5, -2.5, 9.5)
    flagged = cleaning.flag_outliers(df, "x").where("x_OUTLIER").collect()
    assert [r["x"] for r in flagged] == [100]


def test_sequential_removal_golden(spark):
    df = spark.createDataFrame([(1.0, 10.0), (2.0, 40.0), (3.0, 90.0), (1000.0, 40000.0)], "Q double, SALES double")
    out = cleaning.remove_outliers(df, ["Q", "SALES"])
    report = {r["column_name"]: r for r in out.report.collect()}
    assert (report["Q"]["q1"], report["Q"]["q3"], report["Q"]["upper_bound"]) == (1.75, 252.25, 628.0)
    assert (report["SALES"]["q1"], report["SALES"]["lower_bound"], report["SALES"]["upper_bound"]) == (25, -35, 125)
    assert out.kept.count() == 3


def test_outlier_keeps_missing(spark):
    df = frame(spark, [None, 1, 2, 3, 1000])
    assert cleaning.remove_outliers(df, ["x"]).kept.where("x IS NULL").count() == 1


def test_halves_by_position(spark):
    df = spark.range(7).withColumnRenamed("id", "k")
    counts = {r["sample"]: r["count"] for r in cleaning.halves(df, "k").groupBy("sample").count().collect()}
    assert counts == {"reference": 3, "current": 4}


def test_single_period_falls_back_to_halves(spark):
    df = spark.range(10).selectExpr("id AS k", "2003 AS YEAR")
    out = cleaning.first_and_last_period(df, "YEAR", "k")
    assert out.where("sample = 'reference'").count() == 5
    with pytest.raises(ValueError):
        cleaning.first_and_last_period(df, "YEAR")


def test_distribution_golden(spark):
    df = spark.createDataFrame(
        [(1.0, "a"), (2.0, "a"), (3.0, None), (None, "b")], "num double, cat string"
    )
    got = {r["feature"]: r for r in profiling.distribution_summary(df, ["num", "cat", "absent"]).collect()}
    num, cat = got["num"], got["cat"]
    assert (num["count"], num["missing_ratio"], num["mean"]) == (3, 0.25, 2.0)
    assert num["std"] == pytest.approx(0.816496580927726)
    assert (num["p10"], num["p50"], num["p90"]) == pytest.approx((1.2, 2.0, 2.8))
    assert (cat["count"], cat["unique"], cat["missing_ratio"]) == (3, 2, 0.25)
    assert [(t["value"], round(t["ratio"], 9)) for t in cat["top_values"]] == [("a", 0.666666667), ("b", 0.333333333)]
    assert got["absent"]["present"] is False and got["absent"]["missing_ratio"] == 1.0


def test_profile_golden(spark):
    df = spark.createDataFrame(
        [(float(i), 9.0 + i, "a" if i < 3 else "b", 98.0 + 2 * i) for i in range(1, 5)],
        "x1 double, x2 double, cat string, target double",
    )
    report = profiling.profile_report(df, ["x1", "x2"], ["cat"], "target")
    assert report["overview"].first()["row_count"] == 4
    assert [r["correlation"] for r in report["target_correlations"].collect()] == pytest.approx([1.0, 1.0])
    assert report["numeric_profiles"].count() == 3


@pytest.mark.parametrize("bins", [1, 7, 30])
def test_histogram_matches_numpy(spark, bins):
    values = np.round(np.random.default_rng(5).uniform(0, 3, 2000), 1)
    want, _ = np.histogram(values, bins=bins)
    got = {r["bin"]: r["rows"] for r in profiling.histogram(frame(spark, values), "x", bins).collect()}
    assert [got.get(i, 0) for i in range(bins)] == want.tolist()
