"""Queries over drift measures, evaluation and intervals."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from salescope.functions.bins import bin_closed_left, bin_closed_right
from salescope.functions.quantiles import column_quantiles
from salescope.operators import drift, evaluation, scoring
from salescope.plans.catalog import query, r, rounded, with_sales
from salescope.sources.tables import sales_view, table

FEATURES = ["QUANTITYORDERED", "PRICEEACH", "SALES", "MSRP", "MONTH_ID"]


HALF = "(SELECT (min(YEAR_ID) + max(YEAR_ID)) // 2 FROM sales)"


def halves(spark, sf, columns):
    """Lines up to the middle year as reference, later ones as current."""
    view = sales_view(spark, sf, [*columns, "YEAR_ID"])
    low, high = sales_view(spark, sf, ["YEAR_ID"]).agg(F.min("YEAR_ID"), F.max("YEAR_ID")).first()
    middle = (low + high) // 2 if low is not None else None
    return view.where(F.col("YEAR_ID") <= middle).drop("YEAR_ID"), view.where(F.col("YEAR_ID") > middle).drop("YEAR_ID")


def _sample_sql(c: str) -> str:
    return f"""SELECT '{c}' AS feature, CAST({c} AS DOUBLE) AS v, CASE WHEN YEAR_ID > {HALF} THEN 1 ELSE 0 END AS is_current
      FROM sales WHERE YEAR_ID IS NOT NULL AND {c} IS NOT NULL"""


LONG_SQL = ", long AS (" + " UNION ALL ".join(_sample_sql(c) for c in FEATURES) + ")"
PSI_SQL = """, edges AS (SELECT feature, quantile_cont(v, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) AS q
    FROM long WHERE is_current = 0 GROUP BY feature),
  bins AS (SELECT feature, len(list_filter(q, lambda x: x <= v)) AS bin,
    count(*) FILTER (is_current = 0) AS ref, count(*) FILTER (is_current = 1) AS cur
    FROM long JOIN edges USING (feature) GROUP BY ALL),
  shares AS (SELECT feature, bin, ref, cur, ref / sum(ref) OVER (PARTITION BY feature) AS p,
    cur / sum(cur) OVER (PARTITION BY feature) AS q FROM bins),
  psi AS (SELECT feature, sum((q - p) * ln((q + 1e-8) / (p + 1e-8))) AS psi FROM shares GROUP BY feature)"""
KS_SQL = """, counts AS (SELECT feature, v, count(*) FILTER (is_current = 0) AS ref, count(*) FILTER (is_current = 1) AS cur
    FROM long GROUP BY ALL),
  cdf AS (SELECT feature, v, lead(v) OVER w AS nv,
    sum(ref) OVER w / sum(ref) OVER (PARTITION BY feature) AS f, sum(cur) OVER w / sum(cur) OVER (PARTITION BY feature) AS g
    FROM counts WINDOW w AS (PARTITION BY feature ORDER BY v ROWS UNBOUNDED PRECEDING)),
  sizes AS (SELECT feature, sum(ref) AS n, sum(cur) AS m FROM counts GROUP BY feature),
  ks AS (SELECT feature, max(abs(f - g)) AS d, any_value(n) AS n, any_value(m) AS m FROM cdf JOIN sizes USING (feature)
    GROUP BY feature),
  en AS (SELECT *, sqrt(n * m / (n + m)) AS e FROM ks),
  test AS (SELECT feature, d, n, m, e,
    CASE WHEN d <= 0 THEN 1 ELSE greatest(0, least(1, 2 * (SELECT sum(CASE WHEN i % 2 = 1 THEN 1 ELSE -1 END
      * exp(-2.0 * i * i * pow((e + 0.12 + 0.11 / e) * d, 2))) FROM range(1, 101) t(i)))) END AS p_value,
    sqrt(-0.5 * ln(0.05 / 2)) / e AS critical FROM en)"""


@query("g27_psi", with_sales(LONG_SQL + PSI_SQL + " SELECT feature, round(psi, 8) AS psi FROM psi"))
def psi(spark, sf):
    return rounded(drift.psi(*halves(spark, sf, FEATURES), FEATURES), psi=8)


@query(
    "g27_psi_bins",
    with_sales(
        LONG_SQL + PSI_SQL + " SELECT feature, CAST(bin AS INT) AS bin, ref, cur, round(p, 8) AS ref_share, round(q, 8) AS cur_share FROM shares"
    ),
)
def psi_bins(spark, sf):
    out = drift.psi_bins(*halves(spark, sf, FEATURES), FEATURES).drop("n_reference", "n_current")
    return rounded(out, ref_share=8, cur_share=8)


EQUAL_WIDTH_SQL = f""", s AS (SELECT SALES AS v, YEAR_ID > {HALF} AS late FROM sales WHERE YEAR_ID IS NOT NULL),
  e AS (SELECT min(v) AS lo, max(v) AS hi, (max(v) - min(v)) / 10 AS w FROM s WHERE NOT late),
  g AS (SELECT v, late, lo, w, least(CAST(floor((v - lo) / w) AS INT), 9) AS k FROM s, e WHERE v BETWEEN lo AND hi),
  b AS (SELECT late, CASE WHEN v < lo + k * w THEN k - 1 WHEN v >= lo + (k + 1) * w AND k < 9 THEN k + 1 ELSE k END AS bin FROM g),
  c AS (SELECT t.bin, count(b.bin) FILTER (NOT late) AS ref, count(b.bin) FILTER (late) AS cur
        FROM range(10) t(bin) LEFT JOIN b ON b.bin = t.bin GROUP BY t.bin),
  p AS (SELECT bin, greatest(ref / sum(ref) OVER (), 1e-6) AS rp, greatest(cur / sum(cur) OVER (), 1e-6) AS cp FROM c)
  SELECT CAST(bin AS INT) AS bin, round(rp, 8) AS ref_prop, round(cp, 8) AS cur_prop,
    round((cp - rp) * ln(cp / rp), 8) AS psi_bin, round(sum((cp - rp) * ln(cp / rp)) OVER (), 8) AS psi_total FROM p"""


@query("g28_psi_equal_width", with_sales(EQUAL_WIDTH_SQL))
def psi_equal_width(spark, sf):
    out = drift.psi_equal_width(*halves(spark, sf, ["SALES"]), "SALES")
    return rounded(out, ref_prop=8, cur_prop=8, psi_bin=8, psi_total=8)


@query(
    "g29_ks_statistic",
    with_sales(
        LONG_SQL + KS_SQL
        + " SELECT feature, round(d, 10) AS statistic, CAST(n AS BIGINT) AS n_reference, CAST(m AS BIGINT) AS n_current FROM ks"
    ),
)
def ks_statistic(spark, sf):
    return rounded(drift.ks_statistic(*halves(spark, sf, FEATURES), FEATURES), statistic=10)


@query(
    "g30_ks_test",
    with_sales(
        LONG_SQL + KS_SQL
        + """ SELECT feature, round(d, 10) AS statistic, round(p_value, 8) AS p_value, 0.05::DOUBLE AS alpha,
          round(critical, 8) AS critical_value, CAST(n AS BIGINT) AS n_reference, CAST(m AS BIGINT) AS n_current,
          d > critical AS drift_detected FROM test"""
    ),
)
def ks_test(spark, sf):
    out = drift.ks_test(*halves(spark, sf, FEATURES), FEATURES)
    return rounded(out, statistic=10, p_value=8, critical_value=8)


SUMMARY_SQL = LONG_SQL + PSI_SQL + KS_SQL + """, summary AS (SELECT feature, psi, d, p_value, d > critical AS detected,
    psi >= 0.2 OR d > critical AS drifted FROM test JOIN psi USING (feature))"""


@query(
    "g31_drift_summary",
    with_sales(
        SUMMARY_SQL
        + """ SELECT feature, round(psi, 8) AS psi, round(d, 10) AS statistic, round(p_value, 8) AS p_value,
          detected AS drift_detected, drifted FROM summary"""
    ),
)
def drift_summary(spark, sf):
    out = drift.drift_summary(*halves(spark, sf, FEATURES), FEATURES)
    return rounded(
        out.select("feature", "psi", "statistic", "p_value", "drift_detected", "drifted"), psi=8, statistic=10, p_value=8
    )


@query(
    "g32_drift_alert",
    with_sales(
        SUMMARY_SQL
        + """ SELECT count(*) AS features, count(*) FILTER (drifted) AS drifted_features,
          round(avg(CASE WHEN drifted THEN 1 ELSE 0 END), 8) AS drift_ratio,
          avg(CASE WHEN drifted THEN 1 ELSE 0 END) >= 0.3 AS alert FROM summary"""
    ),
)
def drift_alert(spark, sf):
    out = drift.drift_alert(drift.drift_summary(*halves(spark, sf, FEATURES), FEATURES), 0.3)
    return rounded(out, drift_ratio=8)


CATEGORIES = ["PRODUCTLINE", "DEALSIZE", "STATUS"]
CATEGORY_SQL = (
    ", texts AS ("
    + " UNION ALL ".join(
        f"SELECT '{c}' AS feature, {c} AS v, YEAR_ID > {HALF} AS late FROM sales WHERE YEAR_ID IS NOT NULL AND {c} IS NOT NULL"
        for c in CATEGORIES
    )
    + """), tc AS (SELECT feature, v, count(*) FILTER (NOT late) AS ref, count(*) FILTER (late) AS cur FROM texts GROUP BY ALL),
  tp AS (SELECT feature, ref / sum(ref) OVER (PARTITION BY feature) AS p, cur / sum(cur) OVER (PARTITION BY feature) AS q FROM tc),
  js AS (SELECT feature, sqrt(greatest(0, sum(CASE WHEN p > 0 THEN p * log2(p / ((p + q) / 2)) ELSE 0 END
     + CASE WHEN q > 0 THEN q * log2(q / ((p + q) / 2)) ELSE 0 END) / 2)) AS js,
     sum((q - p) * ln((q + 1e-8) / (p + 1e-8))) AS psi FROM tp GROUP BY feature)"""
)
AREA_SQL = ", area AS (SELECT feature, coalesce(sum(abs(f - g) * (nv - v)), 0) AS area FROM cdf GROUP BY feature)"


@query(
    "g33_wasserstein",
    with_sales(LONG_SQL + KS_SQL + AREA_SQL + " SELECT feature, round(area, 6) AS wasserstein FROM area"),
)
def wasserstein(spark, sf):
    return rounded(drift.wasserstein(*halves(spark, sf, FEATURES), FEATURES), wasserstein=6)


@query(
    "g33_category_distances",
    with_sales(CATEGORY_SQL + " SELECT feature, round(js, 8) AS jensen_shannon, round(psi, 8) AS psi FROM js"),
)
def category_distances(spark, sf):
    out = drift.category_distances(*halves(spark, sf, CATEGORIES), CATEGORIES)
    return rounded(out, jensen_shannon=8, psi=8)


@query(
    "g33_column_drift_report",
    with_sales(
        LONG_SQL + KS_SQL + AREA_SQL + CATEGORY_SQL
        + """, spread AS (SELECT feature, stddev_pop(v) AS sd FROM long WHERE is_current = 0 GROUP BY feature),
        report AS (SELECT feature, 'wasserstein_normed' AS method, area / sd AS distance FROM area JOIN spread USING (feature)
          UNION ALL SELECT feature, 'jensen_shannon', js FROM js)
        SELECT feature, method, round(distance, 8) AS distance, distance >= 0.1 AS drifted,
          round(avg(CASE WHEN distance >= 0.1 THEN 1 ELSE 0 END) OVER (), 8) AS drifted_share FROM report"""
    ),
)
def column_drift_report(spark, sf):
    columns = [*FEATURES, *CATEGORIES]
    out = drift.column_drift_report(*halves(spark, sf, columns), columns)
    return rounded(out, distance=8, drifted_share=8)


@query(
    "w01_empirical_cdf",
    with_sales(LONG_SQL + KS_SQL + " SELECT feature, v AS \"value\", nv AS next_value, round(f, 10) AS ref_cdf, round(g, 10) AS cur_cdf FROM cdf"),
)
def empirical_cdf(spark, sf):
    return rounded(drift.empirical_cdf(*halves(spark, sf, FEATURES), FEATURES), ref_cdf=10, cur_cdf=10)


@query(
    "j04_value_supports",
    with_sales(
        LONG_SQL + """ SELECT feature, v AS "value", count(*) FILTER (is_current = 0) AS ref,
          count(*) FILTER (is_current = 1) AS cur FROM long GROUP BY ALL"""
    ),
)
def value_supports(spark, sf):
    both = drift.two_samples(*halves(spark, sf, FEATURES), FEATURES)
    return drift._long(both, FEATURES).groupBy("feature", "value").agg(*drift._sides())


@query(
    "j02_bin_assignment",
    with_sales(
        """, e AS (SELECT quantile_cont(SALES, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) AS q FROM sales)
        SELECT CAST(len(list_filter(q, lambda x: x <= SALES)) AS INT) AS bin_left,
               CAST(len(list_filter(q, lambda x: x < SALES)) AS INT) AS bin_right, count(*) AS n FROM sales, e GROUP BY ALL"""
    ),
)
def bin_assignment(spark, sf):
    view = sales_view(spark, sf, ["SALES"])
    edges = column_quantiles(view, ["SALES"], [i / 10 for i in range(1, 10)])["SALES"]
    return view.groupBy(
        bin_closed_left("SALES", edges).alias("bin_left"), bin_closed_right("SALES", edges).alias("bin_right")
    ).agg(F.count(F.lit(1)).alias("n"))


DAILY_SQL = """WITH ref AS (SELECT * FROM events WHERE ts < TIMESTAMP '2024-01-08'),
  e AS (SELECT quantile_cont(value, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) AS q FROM ref),
  rs AS (SELECT bin, n / sum(n) OVER () AS p FROM (SELECT len(list_filter(q, lambda x: x <= value)) AS bin, count(*) AS n
     FROM ref, e GROUP BY ALL)),
  d AS (SELECT CAST(ts AS DATE) AS day, len(list_filter(q, lambda x: x <= value)) AS bin, count(*) AS n FROM events, e GROUP BY ALL),
  t AS (SELECT day, sum(n) AS total FROM d GROUP BY day)
  SELECT t.day AS period, CAST(total AS BIGINT) AS "rows", round(sum((coalesce(d.n, 0) / total - rs.p)
    * ln((coalesce(d.n, 0) / total + 1e-8) / (rs.p + 1e-8))), 8) AS psi
  FROM t CROSS JOIN rs LEFT JOIN d ON d.day = t.day AND d.bin = rs.bin GROUP BY t.day, total"""


@query("r02_daily_psi", DAILY_SQL)
def daily_psi(spark, sf):
    events = table(spark, sf, "events")
    edges, shares = drift.reference_profile(events.where("ts < timestamp_ntz'2024-01-08 00:00:00'"), "value")
    return rounded(drift.psi_per_period(events, F.to_date("ts"), "value", edges, shares), psi=8)


# A predictor with a closed form, so that evaluation and intervals can be checked in SQL.
PREDICTED_SQL = """, scored AS (SELECT *, QUANTITYORDERED * PRICEEACH * (0.95 + 0.02 * (ORDERNUMBER % 6)) AS prediction,
   1000 + 0.98 * QUANTITYORDERED * PRICEEACH AS shadow FROM sales)"""


def scored(spark, sf, extra=()):
    view = sales_view(spark, sf, ["ORDERNUMBER", "ORDERLINENUMBER", "QUANTITYORDERED", "PRICEEACH", "SALES", *extra])
    total = F.col("QUANTITYORDERED") * F.col("PRICEEACH")
    return view.select(
        "*",
        (total * (F.lit(0.95) + F.lit(0.02) * (F.col("ORDERNUMBER") % 6))).alias("prediction"),
        (F.lit(1000) + F.lit(0.98) * F.col("QUANTITYORDERED") * F.col("PRICEEACH")).alias("shadow"),
    )


@query(
    "g23_regression_metrics",
    with_sales(
        PREDICTED_SQL
        + """ SELECT round(avg(pow(SALES - prediction, 2)), 2) AS mse, round(sqrt(avg(pow(SALES - prediction, 2))), 4) AS rmse,
          round(avg(abs(SALES - prediction)), 4) AS mae,
          round(1 - avg(pow(SALES - prediction, 2)) / var_pop(SALES), 8) AS r2 FROM scored"""
    ),
)
def regression_metrics(spark, sf):
    return rounded(evaluation.regression_metrics(scored(spark, sf)), mse=2, rmse=4, mae=4, r2=8)


@query(
    "g24_calibration_error",
    with_sales(
        PREDICTED_SQL
        + """, e AS (SELECT quantile_cont(prediction, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) AS q FROM scored),
        b AS (SELECT len(list_filter(q, lambda x: x < prediction)) AS bin, count(*) AS n, avg(SALES) AS t, avg(prediction) AS p
          FROM scored, e GROUP BY ALL)
        SELECT round(sum(n * abs(t - p)) / sum(n), 4) AS calibration_error FROM b"""
    ),
)
def calibration_error(spark, sf):
    return rounded(evaluation.calibration_error(scored(spark, sf)), calibration_error=4)


CONFORMAL_SQL = """, errs AS (SELECT abs(SALES - prediction) AS err FROM scored),
  k AS (SELECT count(*) AS n, CAST(ceil((count(*) - 1) * least(1.0::DOUBLE, ceil((count(*) + 1) * (1 - 0.1::DOUBLE)) / count(*))) AS BIGINT) AS pos FROM errs),
  qh AS (SELECT err AS q_hat FROM (SELECT err, row_number() OVER (ORDER BY err) - 1 AS rn FROM errs), k WHERE rn = pos)"""


@query(
    "g25_conformal_fit",
    with_sales(
        PREDICTED_SQL + CONFORMAL_SQL
        + """ SELECT round(any_value(q_hat), 6) AS q_hat, count(*) AS calibration_size,
          round(avg(CASE WHEN err <= q_hat THEN 1 ELSE 0 END), 8) AS empirical_coverage FROM errs, qh"""
    ),
)
def conformal_fit(spark, sf):
    fit = evaluation.fit_conformal(scored(spark, sf), alpha=0.1)
    return rounded(fit.select("q_hat", "calibration_size", "empirical_coverage"), q_hat=6, empirical_coverage=8)


RESIDUAL_SQL = """, res AS (SELECT quantile_cont(SALES - prediction, 0.1) AS lo, quantile_cont(SALES - prediction, 0.9) AS hi,
   count(*) AS n FROM scored)"""


@query(
    "g26_residual_quantiles",
    with_sales(
        PREDICTED_SQL + RESIDUAL_SQL
        + " SELECT round(lo, 6) AS residual_q10, round(hi, 6) AS residual_q90, n AS residual_count FROM res"
    ),
)
def residual_quantiles(spark, sf):
    return rounded(evaluation.residual_quantiles(scored(spark, sf)).drop("method"), residual_q10=6, residual_q90=6)


LINE = "ORDERNUMBER, ORDERLINENUMBER, round(prediction, 4) AS prediction"


@query(
    "m15_conformal_interval",
    with_sales(
        PREDICTED_SQL + CONFORMAL_SQL
        + f""" SELECT {LINE}, round(prediction - q_hat, 4) AS lower, round(prediction + q_hat, 4) AS upper FROM scored, qh"""
    ),
)
def conformal_interval(spark, sf):
    rows = scored(spark, sf)
    q_hat = evaluation.fit_conformal(rows).first()["q_hat"]
    out = scoring.conformal_interval(rows, q_hat)
    return rounded(
        out.select("ORDERNUMBER", "ORDERLINENUMBER", "prediction", F.col("conformal.lower"), F.col("conformal.upper")),
        prediction=4, lower=4, upper=4,
    )


@query(
    "m17_residual_interval",
    with_sales(
        PREDICTED_SQL + RESIDUAL_SQL
        + f""" SELECT {LINE}, round(least(prediction + lo, prediction + hi), 6) AS lower,
          round(greatest(prediction + lo, prediction + hi), 6) AS upper FROM scored, res"""
    ),
)
def residual_interval(spark, sf):
    rows = scored(spark, sf)
    q = evaluation.residual_quantiles(rows).first()
    out = scoring.residual_interval(rows, q["residual_q10"], q["residual_q90"])
    return rounded(
        out.select("ORDERNUMBER", "ORDERLINENUMBER", "prediction", F.col("residual.lower"), F.col("residual.upper")),
        prediction=4, lower=6, upper=6,
    )


@query(
    "m18_interval_cascade",
    with_sales(
        PREDICTED_SQL + CONFORMAL_SQL + RESIDUAL_SQL
        + f""" SELECT {LINE}, DEALSIZE,
          CASE DEALSIZE WHEN 'MACHINERY' THEN 'residual_quantiles' WHEN 'FURNITURE' THEN NULL ELSE 'conformal_intervals' END AS interval_method,
          round(CASE DEALSIZE WHEN 'MACHINERY' THEN prediction + lo WHEN 'FURNITURE' THEN NULL ELSE prediction - q_hat END, 6) AS p10,
          round(CASE DEALSIZE WHEN 'MACHINERY' THEN prediction + hi WHEN 'FURNITURE' THEN NULL ELSE prediction + q_hat END, 6) AS p90
          FROM scored, qh, res"""
    ),
)
def interval_cascade(spark, sf):
    """Deal sizes stand for model versions with different interval metadata."""
    rows = scored(spark, sf, ["DEALSIZE"])
    q_hat = evaluation.fit_conformal(rows).first()["q_hat"]
    q = evaluation.residual_quantiles(rows).first()
    known = F.col("DEALSIZE")
    out = scoring.interval_cascade(
        rows,
        q_hat=F.when(~known.isin("MACHINERY", "FURNITURE"), F.lit(q_hat)),
        residual=(
            F.when(known != "FURNITURE", F.lit(q["residual_q10"])),
            F.when(known != "FURNITURE", F.lit(q["residual_q90"])),
        ),
    )
    return rounded(
        out.select("ORDERNUMBER", "ORDERLINENUMBER", "prediction", "DEALSIZE", "interval_method", "p10", "p90"),
        prediction=4, p10=6, p90=6,
    )


@query(
    "m19_shadow_comparison",
    with_sales(
        PREDICTED_SQL
        + """ SELECT COUNTRY, count(*) AS n, round(avg(shadow - prediction), 4) AS mean_delta,
          round(quantile_cont(abs(shadow - prediction), 0.95), 4) AS p95_abs_delta FROM scored GROUP BY COUNTRY"""
    ),
)
def shadow_comparison(spark, sf):
    rows = scored(spark, sf, ["COUNTRY"])
    out = scoring.shadow_summary(scoring.shadow_delta(rows, "prediction", "shadow"), ["COUNTRY"])
    return rounded(out, mean_delta=4, p95_abs_delta=4)
