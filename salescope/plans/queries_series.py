"""Queries over the monthly series of every segment."""

from __future__ import annotations

from pyspark.sql import functions as F

from salescope.operators import timeseries as ts
from salescope.plans.catalog import query, rounded, with_sales
from salescope.sources.tables import sales_view

SEG = ["PRODUCTLINE", "COUNTRY"]
COLUMNS = [*SEG, "ORDERDATE", "SALES"]


def _series(spark, sf):
    return ts.monthly_series(sales_view(spark, sf, COLUMNS), SEG)


SERIES_SQL = """, monthly AS (SELECT PRODUCTLINE, COUNTRY, CAST(date_trunc('month', ORDERDATE) AS DATE) AS month, sum(SALES) AS sales
    FROM sales GROUP BY ALL),
  spans AS (SELECT PRODUCTLINE, COUNTRY, min(month) AS lo, max(month) AS hi FROM monthly GROUP BY ALL),
  calendar AS (SELECT PRODUCTLINE, COUNTRY, CAST(unnest(generate_series(lo, hi, INTERVAL 1 MONTH)) AS DATE) AS month FROM spans),
  series AS (SELECT c.PRODUCTLINE, c.COUNTRY, c.month, coalesce(m.sales, 0) AS sales, m.sales IS NULL AS filled
    FROM calendar c LEFT JOIN monthly m USING (PRODUCTLINE, COUNTRY, month))"""
SEGW = "PARTITION BY PRODUCTLINE, COUNTRY"


@query(
    "j01_calendar_fill",
    with_sales(SERIES_SQL + " SELECT PRODUCTLINE, COUNTRY, month, round(sales, 2) AS sales, filled FROM series"),
)
def calendar_fill(spark, sf):
    return rounded(_series(spark, sf), sales=2)


@query(
    "s01_monthly_series_from_parts",
    with_sales(
        """, monthly AS (SELECT PRODUCTLINE, make_date(YEAR_ID, MONTH_ID, 1) AS month, sum(SALES) AS sales FROM sales GROUP BY ALL),
        spans AS (SELECT PRODUCTLINE, min(month) AS lo, max(month) AS hi FROM monthly GROUP BY ALL),
        calendar AS (SELECT PRODUCTLINE, CAST(unnest(generate_series(lo, hi, INTERVAL 1 MONTH)) AS DATE) AS month FROM spans)
        SELECT PRODUCTLINE, month, round(coalesce(sales, 0), 2) AS sales, sales IS NULL AS filled
        FROM calendar LEFT JOIN monthly USING (PRODUCTLINE, month)"""
    ),
)
def series_from_parts(spark, sf):
    view = sales_view(spark, sf, ["PRODUCTLINE", "YEAR_ID", "MONTH_ID", "SALES"])
    return rounded(ts.monthly_series(view, ["PRODUCTLINE"]), sales=2)


RETURNS_SQL = SERIES_SQL + f""", changes AS (SELECT PRODUCTLINE, COUNTRY, month, sales, lag(sales) OVER (w) AS before
    FROM series WINDOW w AS ({SEGW} ORDER BY month)),
  rets AS (SELECT PRODUCTLINE, COUNTRY, month, CASE WHEN before <> 0 THEN (sales - before) / before END AS ret FROM changes)"""


@query("w02_returns", with_sales(RETURNS_SQL + " SELECT PRODUCTLINE, COUNTRY, month, round(ret, 8) AS ret FROM rets"))
def returns(spark, sf):
    return rounded(ts.returns(_series(spark, sf), SEG), ret=8)


EWMA_SQL = RETURNS_SQL + f""", weighted AS (SELECT PRODUCTLINE, COUNTRY, ret,
    pow(0.94::DOUBLE, row_number() OVER ({SEGW} ORDER BY month DESC) - 1) AS w FROM rets WHERE ret IS NOT NULL),
  sums AS (SELECT PRODUCTLINE, COUNTRY, sum(w) AS sw, sum(w * w) AS sww, sum(w * ret) AS swx, sum(w * ret * ret) AS swxx,
    stddev_pop(ret) AS sd, count(*) AS n FROM weighted GROUP BY ALL),
  ewma AS (SELECT PRODUCTLINE, COUNTRY, CASE WHEN n > 1 THEN sqrt(greatest(0, (swxx / sw - pow(swx / sw, 2)) * sw * sw / (sw * sw - sww)))
    ELSE sd END AS vol FROM sums)"""


@query(
    "w03_ewma_volatility",
    with_sales(EWMA_SQL + " SELECT PRODUCTLINE, COUNTRY, round(vol, 8) AS ewma_volatility FROM ewma"),
)
def ewma(spark, sf):
    return rounded(ts.ewma_volatility(ts.returns(_series(spark, sf), SEG), SEG), ewma_volatility=8)


@query(
    "s08_ewma_by_productline",
    with_sales(
        EWMA_SQL.replace("PRODUCTLINE, COUNTRY", "PRODUCTLINE").replace("c.COUNTRY, ", "")
        + " SELECT PRODUCTLINE, round(vol, 8) AS ewma_volatility FROM ewma"
    ),
)
def ewma_by_line(spark, sf):
    line = ["PRODUCTLINE"]
    series = ts.monthly_series(sales_view(spark, sf, ["PRODUCTLINE", "ORDERDATE", "SALES"]), line)
    return rounded(ts.ewma_volatility(ts.returns(series, line), line), ewma_volatility=8)


@query(
    "w04_holdout_split",
    with_sales(
        SERIES_SQL
        + f""", ranked AS (SELECT *, row_number() OVER ({SEGW} ORDER BY month DESC) AS k, count(*) OVER ({SEGW}) AS points FROM series)
        SELECT PRODUCTLINE, COUNTRY, month, round(sales, 2) AS sales, filled, points,
          CAST(CASE WHEN k <= 6 THEN 7 - k END AS INT) AS step FROM ranked"""
    ),
)
def holdout_split(spark, sf):
    return rounded(ts.split_holdout(_series(spark, sf), SEG, 6), sales=2)


@query(
    "w05_last_value",
    with_sales(
        SERIES_SQL
        + """ SELECT PRODUCTLINE, COUNTRY, max(month) AS last_month, round(arg_max(sales, month), 2) AS last_value
          FROM series GROUP BY ALL"""
    ),
)
def last_value(spark, sf):
    return rounded(ts.naive_origin(_series(spark, sf), SEG), last_value=2)


@query(
    "s03_naive_forecast",
    with_sales(
        SERIES_SQL
        + """, o AS (SELECT PRODUCTLINE, COUNTRY, max(month) AS m, arg_max(sales, month) AS v FROM series GROUP BY ALL)
        SELECT PRODUCTLINE, COUNTRY, CAST(step AS INT) AS step, CAST(m + to_months(CAST(step AS INT)) AS DATE) AS month,
          round(v, 2) AS forecast FROM o, range(1, 4) t(step)"""
    ),
)
def naive_forecast(spark, sf):
    return rounded(ts.naive_forecast(_series(spark, sf), SEG, 3), forecast=2)


NAIVE_SQL = SERIES_SQL + f""", ranked AS (SELECT *, row_number() OVER ({SEGW} ORDER BY month DESC) AS k, count(*) OVER ({SEGW}) AS points FROM series),
  origin AS (SELECT PRODUCTLINE, COUNTRY, arg_max(sales, month) AS f FROM ranked WHERE k > 6 GROUP BY ALL),
  errs AS (SELECT PRODUCTLINE, COUNTRY, sqrt(avg(pow(sales - f, 2))) AS rmse, avg(abs(sales - f)) AS mae,
    avg(abs((sales - f) / greatest(abs(sales), 1e-8))) * 100 AS mape
    FROM ranked JOIN origin USING (PRODUCTLINE, COUNTRY) WHERE k <= 6 AND points > 6 GROUP BY ALL)"""


@query(
    "s02_naive_holdout_errors",
    with_sales(
        NAIVE_SQL
        + """ SELECT PRODUCTLINE, COUNTRY, round(rmse, 2) AS rmse, round(mae, 4) AS mae,
          CAST(format('{:.6e}', mape) AS DOUBLE) AS mape FROM errs"""
    ),
)
def naive_holdout(spark, sf):
    """A month without sales makes the percentage huge, so it is rounded to seven digits, not to places."""
    out = ts.naive_holdout(_series(spark, sf), SEG, 6)
    mape = F.format_string("%.6e", "mape").cast("double")
    return rounded(out.withColumn("mape", mape), rmse=2, mae=4)


@query(
    "s05_selection_naive_part",
    with_sales(
        NAIVE_SQL
        + """, spans2 AS (SELECT PRODUCTLINE, COUNTRY, count(*) AS series_points, min(month) AS series_start, max(month) AS series_end
          FROM series GROUP BY ALL)
        SELECT PRODUCTLINE, COUNTRY, series_points, series_start, series_end, round(rmse, 2) AS naive_rmse
        FROM spans2 LEFT JOIN errs USING (PRODUCTLINE, COUNTRY)"""
    ),
)
def selection_naive_part(spark, sf):
    out = ts.segment_report(_series(spark, sf), SEG)
    return rounded(out.select(*SEG, "series_points", "series_start", "series_end", "naive_rmse"), naive_rmse=2)


@query(
    "s06_insufficient_history",
    with_sales(
        """, monthly AS (SELECT PRODUCTLINE, COUNTRY, CAST(date_trunc('month', ORDERDATE) AS DATE) AS month, sum(SALES) AS sales
            FROM sales GROUP BY ALL),
        spans AS (SELECT PRODUCTLINE, COUNTRY, min(month) AS lo, max(month) AS hi FROM monthly GROUP BY ALL)
        SELECT PRODUCTLINE, COUNTRY, CASE WHEN date_diff('month', lo, hi) + 1 <= 78 THEN 'insufficient history' ELSE 'ok' END AS status
        FROM spans"""
    ),
)
def insufficient_history(spark, sf):
    return ts.segment_report(_series(spark, sf), SEG, holdout=78).select(*SEG, "status")


@query(
    "s07_risk_summary",
    with_sales(
        RETURNS_SQL
        + """, v AS (SELECT PRODUCTLINE, COUNTRY, quantile_cont(ret, 0.05) AS var_95, stddev_pop(ret) * sqrt(12) AS vol,
            avg(ret) AS mean, count(ret) AS n FROM rets GROUP BY ALL HAVING count(ret) > 0),
          t AS (SELECT PRODUCTLINE, COUNTRY, avg(ret) AS tail FROM rets JOIN v USING (PRODUCTLINE, COUNTRY) WHERE ret <= var_95 GROUP BY ALL)
        SELECT PRODUCTLINE, COUNTRY, round(var_95, 8) AS var_95, round(coalesce(tail, var_95), 8) AS cvar_95,
          round(vol, 8) AS volatility_annualized, round(mean, 8) AS return_mean, n AS observations
        FROM v LEFT JOIN t USING (PRODUCTLINE, COUNTRY)"""
    ),
)
def risk_summary(spark, sf):
    out = ts.risk_summary(ts.returns(_series(spark, sf), SEG), SEG)
    return rounded(out, var_95=8, cvar_95=8, volatility_annualized=8, return_mean=8)


@query("s09_garch_volatility")
def garch(spark, sf):
    return ts.garch_volatility(ts.returns(_series(spark, sf), SEG), SEG)


@query("s04_arima_forecast")
def arima(spark, sf):
    return ts.arima_forecast(_series(spark, sf), SEG, 6)


@query("s05_segment_report")
def segment_report(spark, sf):
    out = ts.segment_report(_series(spark, sf), SEG)
    return out.select(*[c for c in out.columns if c != "risk"], "risk.*")
