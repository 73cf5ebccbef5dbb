"""Drift measures against NumPy and the closed-form fixtures."""

import math

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from salescope.operators import drift, profiling
from salescope.streaming.drift import daily_psi


def frame(spark, **columns):
    names = list(columns)
    rows = [tuple(float(v) for v in row) for row in zip(*columns.values())]
    return spark.createDataFrame(rows, ", ".join(f"{n} double" for n in names))


def query(sql, a, b):
    """The first cell of SQL over the samples ``a`` and ``b``, in DuckDB."""
    con = duckdb.connect()
    for name, sample in (("a", a), ("b", b)):
        con.register(name, pa.table({"v": np.asarray(sample, dtype=float)}))
    return con.execute(sql).fetchone()[0]


STEPS = """WITH v AS (SELECT v FROM a UNION SELECT v FROM b), s AS (SELECT v, lead(v) OVER (ORDER BY v) - v AS width,
    abs((SELECT count(*) FROM a WHERE a.v <= v.v) / (SELECT count(*) FROM a) - (SELECT count(*) FROM b WHERE b.v <= v.v) / (SELECT count(*) FROM b)) AS gap FROM v)"""


def ks(a, b):
    return query(STEPS + " SELECT max(gap) FROM s", a, b)


def area(a, b):
    return query(STEPS + " SELECT sum(gap * width) FROM s", a, b)


def psi_by_quantiles(a, b, bins=10):
    inner = ", ".join(repr(i / bins) for i in range(1, bins))
    return query(
        f"""WITH e AS (SELECT quantile_cont(v, [{inner}]) AS q FROM a), k AS (SELECT v, 1 AS ref FROM a UNION ALL SELECT v, 0 FROM b),
        c AS (SELECT len([x FOR x IN q IF x <= v]) AS bin, sum(ref) / (SELECT count(*) FROM a) + 1e-8 AS p,
          sum(1 - ref) / (SELECT count(*) FROM b) + 1e-8 AS r FROM k, e GROUP BY 1)
        SELECT sum((r - p) * ln(r / p)) FROM c""",
        a, b,
    )


def psi_by_width(a, b, bins=10):
    edges = np.histogram_bin_edges(a, bins)
    p, q = np.histogram(a, edges)[0], np.histogram(b, edges)[0]
    p, q = (np.clip(c / max(c.sum(), 1), 1e-6, None) for c in (p, q))
    return np.sum((q - p) * np.log(q / p))


def test_shift_fixture(spark):
    ref = frame(spark, x1=np.linspace(0, 10, 200), x2=np.linspace(0, 5, 200))
    cur = frame(spark, x1=np.linspace(50, 60, 200), x2=np.linspace(0, 5, 200))
    got = {r["feature"]: r for r in drift.drift_summary(ref, cur, ["x1", "x2"]).collect()}
    assert got["x1"]["psi"] == pytest.approx(16.57861267855713)
    assert got["x1"]["statistic"] == 1.0
    assert got["x1"]["critical_value"] == pytest.approx(0.13581015157406195)
    assert got["x1"]["drifted"] and not got["x2"]["drifted"]
    assert got["x2"]["psi"] == 0.0 and got["x2"]["statistic"] == 0.0 and got["x2"]["p_value"] == 1.0
    alert = drift.drift_alert(drift.drift_summary(ref, cur, ["x1", "x2"]), 0.5, "p").first()
    assert alert["alert"] and alert["drift_ratio"] == 0.5 and alert["project_name"] == "p"


def test_seeded_fixtures(spark):
    rng = np.random.default_rng(7)
    a, b = rng.normal(0, 1, 500), rng.normal(0.3, 1.1, 500)
    assert drift.psi(frame(spark, x=a), frame(spark, x=b), ["x"]).first()["psi"] == pytest.approx(0.22380618373160835)
    rng = np.random.default_rng(11)
    a, b = rng.normal(0, 1, 500), rng.normal(1.2, 1, 500)
    assert drift.ks_test(frame(spark, x=a), frame(spark, x=b), ["x"]).first()["statistic"] == pytest.approx(0.462)


SAMPLES = {
    "same law": lambda r: (r.normal(size=1500), r.normal(size=900)),
    "shifted": lambda r: (r.normal(size=800), r.normal(0.4, 1, 1200)),
    "hot value": lambda r: (np.concatenate([np.zeros(600), r.normal(size=300)]), np.concatenate([np.zeros(300), r.normal(size=600)])),
    "few values": lambda r: (r.integers(0, 5, 700), r.integers(1, 6, 500)),
    "disjoint": lambda r: (r.uniform(0, 1, 50), r.uniform(2, 3, 70)),
    "one row": lambda r: (np.array([1.0]), np.array([2.0])),
}


@pytest.mark.parametrize("name", SAMPLES)
@pytest.mark.parametrize("range_rows", [37, drift.RANGE_ROWS])
def test_exact_against_brute_force(spark, name, range_rows):
    a, b = SAMPLES[name](np.random.default_rng(13))
    ref, cur = frame(spark, x=a), frame(spark, x=b)
    assert drift.ks_statistic(ref, cur, ["x"], range_rows).first()["statistic"] == pytest.approx(ks(a, b), abs=1e-12)
    assert drift.wasserstein(ref, cur, ["x"], range_rows).first()["wasserstein"] == pytest.approx(area(a, b), abs=1e-9)


@pytest.mark.parametrize("name", SAMPLES)
def test_both_stability_indexes(spark, name):
    a, b = SAMPLES[name](np.random.default_rng(17))
    ref, cur = frame(spark, x=a), frame(spark, x=b)
    assert drift.psi(ref, cur, ["x"]).first()["psi"] == pytest.approx(psi_by_quantiles(a, b), abs=1e-9)
    rows = drift.psi_equal_width(ref, cur, "x").collect()
    assert len(rows) == 10
    assert rows[0]["psi_total"] == pytest.approx(psi_by_width(a, b), abs=1e-9)


@pytest.mark.parametrize("name", SAMPLES)
def test_summary_from_counts(spark, name):
    """Edges, bins and the statistic from one count by value, in many ranges."""
    a, b = SAMPLES[name](np.random.default_rng(23))
    row = drift.drift_summary(frame(spark, x=a), frame(spark, x=b), ["x"], range_rows=50).first()
    assert row["psi"] == pytest.approx(psi_by_quantiles(a, b), abs=1e-9)
    assert row["statistic"] == pytest.approx(ks(a, b), abs=1e-12)
    assert (row["n_reference"], row["n_current"]) == (len(a), len(b))


def test_ranges_follow_the_number_of_values_and_bound_a_task(spark):
    """A third of the rows has one value; ranges are of similar size, and their number grows with the values."""
    df = spark.range(30_000).selectExpr("IF(id % 3 = 0, 0.5D, id / 30000) AS x", "-id * id / 1D AS y")
    sizes = []
    for range_rows in (20_000, 2_000):
        with drift.ranged(df, df, ["x", "y"], range_rows) as both:
            per_range = [r["count"] for r in both.values.groupBy("range").count().collect()]
            assert max(per_range) <= 2.5 * range_rows
            sizes.append(len(per_range))
            starts = both.values.groupBy("feature", "range").agg(F.min("value").alias("lo"), F.max("value").alias("hi")).orderBy("feature", "range").collect()
            assert all(p["hi"] < n["lo"] for p, n in zip(starts, starts[1:]) if p["feature"] == n["feature"])
    assert sizes[0] == 3 and sizes[1] == 26


def test_empirical_cdf(spark):
    rng = np.random.default_rng(29)
    a, b = rng.normal(size=300).round(1), rng.normal(size=200).round(1)
    got = sorted(drift.empirical_cdf(frame(spark, x=a), frame(spark, x=b), ["x"], 10).collect())
    every = np.unique(np.concatenate([a, b]))
    assert [r["value"] for r in got] == every.tolist()
    assert [r["next_value"] for r in got] == [*every[1:].tolist(), None]
    assert np.allclose([r["ref_cdf"] for r in got], [(a <= v).mean() for v in every])
    assert np.allclose([r["cur_cdf"] for r in got], [(b <= v).mean() for v in every])


def test_features_without_values_are_skipped(spark):
    ref = spark.createDataFrame([(1.0, None), (2.0, None)], "x double, y double")
    cur = spark.createDataFrame([(1.0, 3.0), (float("nan"), 4.0)], "x double, y double")
    out = drift.drift_summary(ref, cur, ["x", "y"]).collect()
    assert [r["feature"] for r in out] == ["x"]
    assert out[0]["n_current"] == 1


def test_no_feature_has_values(spark):
    empty = spark.createDataFrame([(None,)], "x double")
    summary = drift.drift_summary(empty, empty, ["x"])
    assert summary.count() == 0
    alert = drift.drift_alert(summary).first()
    assert (alert["features"], alert["drift_ratio"], alert["alert"]) == (0, 0.0, False)


def test_p_value(spark):
    a, b = np.random.default_rng(19).normal(size=(2, 400))
    row = drift.ks_test(frame(spark, x=a), frame(spark, x=b + 0.1), ["x"]).first()
    en = math.sqrt(400 * 400 / 800)
    scaled = (en + 0.12 + 0.11 / en) * row["statistic"]
    want = 2 * sum((-1) ** (i - 1) * math.exp(-2 * i * i * scaled * scaled) for i in range(1, 101))
    assert row["p_value"] == pytest.approx(min(1, max(0, want)), abs=1e-12)


def test_text_columns(spark):
    ref = spark.createDataFrame([("a",)] * 3 + [("b",)], "c string")
    cur = spark.createDataFrame([("a",)] + [("z",)] * 3, "c string")
    row = drift.column_drift_report(ref, cur, ["c"]).first()
    p, q = np.array([0.75, 0.25, 0]), np.array([0.25, 0, 0.75])
    m = (p + q) / 2
    js = sum(np.sum(np.where(v > 0, v * np.log2(np.where(v > 0, v, 1) / m), 0)) for v in (p, q)) / 2
    assert row["distance"] == pytest.approx(math.sqrt(js))
    assert row["drifted"]


def test_invalid_arguments(spark):
    df = frame(spark, x=[1.0, 2.0])
    with pytest.raises(ValueError):
        drift.psi(df, df, ["x"], bins=1)
    with pytest.raises(ValueError):
        drift.ks_test(df, df, ["x"], alpha=1.5)


def test_stream_final_windows(spark, tmp_path):
    """Append mode emits a day once the watermark has passed it."""
    feed = tmp_path / "feed"
    rows = spark.sql(
        "SELECT timestamp'2024-01-01' + make_interval(0,0,0,d,0,0,0) AS ts, cast(x AS double) AS value "
        "FROM (SELECT explode(sequence(0, 4)) AS d), (SELECT explode(sequence(1, 10)) AS x)"
    )
    for day in range(5):
        rows.where(f"dayofmonth(ts) = {day + 1}").coalesce(1).write.mode("append").json(str(feed))
    stream = spark.readStream.schema("ts timestamp, value double").option("maxFilesPerTrigger", 1).json(str(feed))
    out = daily_psi(stream, "value", [5.5], [0.5, 0.5])
    run = (
        out.writeStream.format("memory").queryName("final_days").outputMode("append")
        .option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start()
    )
    run.awaitTermination()
    got = spark.table("final_days").orderBy("period").collect()
    assert len(got) >= 2 and all(r["rows"] == 10 and abs(r["psi"]) < 1e-12 for r in got)


def test_stream_and_batch_skip_the_same_values(spark):
    """NaN and infinities count in neither form."""
    rows = spark.sql("SELECT timestamp'2024-01-01 01:00:00' AS ts, explode(array(1D, double('nan'), double('inf'), 3D)) AS value")
    batch = drift.psi_per_period(rows, F.to_date("ts"), "value", [2.0], [0.5, 0.5]).first()
    stream = daily_psi(rows, "value", [2.0], [0.5, 0.5]).first()
    assert batch["rows"] == stream["rows"] == 2 and batch["psi"] == stream["psi"] == 0.0


def test_correlations_of_many_columns(spark, tmp_path):
    """Blocked Gram matrices against DuckDB's corr, with missing values, a constant column and a large offset."""
    rng = np.random.default_rng(5)
    x = rng.normal(size=(300, 12))
    x[:, 1] = 1e7 + 0.5 * x[:, 0] + x[:, 1]
    x[:, 2] = 4.25
    x[rng.random(x.shape) < 0.2] = np.nan
    x[:, 3] = np.nan
    names = [f"c{i}" for i in range(12)]
    table = pa.table({n: pa.array(x[:, i], from_pandas=True) for i, n in enumerate(names)})
    df = spark.createDataFrame([tuple(None if np.isnan(v) else float(v) for v in row) for row in x], ", ".join(f"{n} double" for n in names)).repartition(5)
    got = {(r.feature_a, r.feature_b): r.correlation for r in profiling.gram_correlations(df, names, block=5).collect()}
    assert len(got) == 144
    con = duckdb.connect()
    con.register("t", table)
    for a in names:
        for b in names:
            want = 0.0 if {a, b} & {"c2", "c3"} else con.execute(f"SELECT corr({a}, {b}) FROM t").fetchone()[0]
            assert got[a, b] == pytest.approx(want, abs=1e-9), (a, b)
    plain = {(r.feature_a, r.feature_b): r.correlation for r in profiling.correlation_matrix(df, names).collect()}
    assert plain.keys() == got.keys() and all(abs(plain[k] - got[k]) < 1e-9 for k in got)
    assert all(r.correlation == 0 for r in profiling.gram_correlations(df.limit(0), names, block=5).collect())
