"""Monthly series, forecasts and risk for every segment in one job.

A segment's series has at most one row per calendar month, so per-segment windows,
lists and pandas groups stay small however many order lines there are; the lines are
summed to months (partial sums first) before anything is grouped by segment.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salescope.functions.quantiles import null_safe_join
from salescope.functions.scalar import month_from_parts, month_start, safe_ratio
from salescope.session import materialize, spread

# Smoothing of the volatility estimate, error floor, and the order grid.
EWMA_ALPHA = 0.06
MAPE_FLOOR = 1e-8
ORDERS = ((1, 1, 1), (1, 0, 1), (2, 1, 1))
SEASONAL_SHORT = ((0, 0, 0, 0),)
SEASONAL_LONG = ((0, 0, 0, 0), (1, 1, 0, 12), (0, 1, 1, 12))
MIN_HISTORY, MIN_SEASONAL, MIN_GARCH = 12, 24, 24

# Method names and reasons in the report.
GARCH, EWMA = "garch_1_1", "ewma_fallback"
NO_HISTORY = "insufficient history"
NO_ARIMA_HISTORY = "insufficient history for sarima"
ARIMA_FAILED = "sarima fitting failed"
NO_RETURNS = "insufficient returns history"
FEW_RETURNS = "insufficient observations for stable garch fit; used ewma fallback"
GARCH_FAILED = "garch fitting failed; used ewma fallback"


def monthly_series(df: DataFrame, segment: Sequence[str], value: str = "SALES") -> DataFrame:
    """``segment..., month, sales, filled``: months without rows are zero.

    The month comes from ORDERDATE, else from YEAR_ID and MONTH_ID; without either
    the result is empty.
    """
    segment = list(segment)
    if "ORDERDATE" in df.columns:
        month = month_start(F.col("ORDERDATE"))
    elif {"YEAR_ID", "MONTH_ID"} <= set(df.columns):
        month = month_from_parts(F.col("YEAR_ID"), F.col("MONTH_ID"))
    else:
        month = F.lit(None).cast("date")
    monthly = (
        df.select(*segment, month.alias("month"), F.col(value).cast("double").alias("v"))
        .where("month IS NOT NULL AND v IS NOT NULL")
        .groupBy(*segment, "month")
        .agg(F.sum("v").alias("sales"))
    )
    span = Window.partitionBy(*segment).orderBy("month")
    # The months from one observed month up to the next one; all but the first are gaps.
    upto = F.coalesce(F.add_months(F.lead("month").over(span), -1), F.col("month"))
    return (
        monthly.select(*segment, "sales", F.col("month").alias("observed"), upto.alias("upto"))
        .select(
            *segment,
            "sales",
            "observed",
            F.explode(F.sequence("observed", "upto", F.expr("INTERVAL 1 MONTH"))).alias("month"),
        )
        .select(
            *segment,
            "month",
            F.when(F.col("month") == F.col("observed"), F.col("sales")).otherwise(0.0).alias("sales"),
            (F.col("month") != F.col("observed")).alias("filled"),
        )
    )


def returns(series: DataFrame, segment: Sequence[str]) -> DataFrame:
    """Month-on-month relative change; NULL where undefined (first month, zero base)."""
    before = F.lag("sales").over(Window.partitionBy(*segment).orderBy("month"))
    return series.select(*segment, "month", safe_ratio(F.col("sales") - before, before).alias("ret"))


def split_holdout(series: DataFrame, segment: Sequence[str], holdout: int = 6) -> DataFrame:
    """Adds ``step`` (1..h for the last ``holdout`` months, else NULL) and ``points``."""
    if holdout < 1:
        raise ValueError("holdout must be at least 1")
    back = Window.partitionBy(*segment).orderBy(F.desc("month"))
    whole = Window.partitionBy(*segment)
    from_end = F.row_number().over(back)
    return series.withColumn("from_end", from_end).withColumn("points", F.count(F.lit(1)).over(whole)).select(
        *series.columns,
        "points",
        F.when(F.col("from_end") <= holdout, holdout + 1 - F.col("from_end")).alias("step"),
    )


def naive_origin(series: DataFrame, segment: Sequence[str]) -> DataFrame:
    """Last month and last value per segment."""
    return series.groupBy(*segment).agg(
        F.max("month").alias("last_month"), F.max_by("sales", "month").alias("last_value")
    )


def naive_forecast(series: DataFrame, segment: Sequence[str], horizon: int = 3) -> DataFrame:
    """The last value repeated: ``segment..., step, month, forecast``."""
    if horizon < 1:
        raise ValueError("horizon must be at least 1")
    return naive_origin(series, segment).select(
        *segment, "last_month", "last_value", F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("step")
    ).select(
        *segment,
        "step",
        F.add_months("last_month", F.col("step")).alias("month"),
        F.col("last_value").alias("forecast"),
    )


def forecast_errors(df: DataFrame, by: Sequence[str], actual: str = "sales", predicted: str = "forecast") -> DataFrame:
    """rmse, mae and mape (percent, with a floor under the divisor) per group."""
    gap = F.col(actual) - F.col(predicted)
    return df.groupBy(*by).agg(
        F.sqrt(F.avg(gap * gap)).alias("rmse"),
        F.avg(F.abs(gap)).alias("mae"),
        (F.avg(F.abs(gap / F.greatest(F.abs(F.col(actual)), F.lit(MAPE_FLOOR)))) * 100.0).alias("mape"),
    )


def naive_holdout(series: DataFrame, segment: Sequence[str], holdout: int = 6) -> DataFrame:
    """Errors of the naive forecast on the last ``holdout`` months, for segments with
    more months than that."""
    parts = split_holdout(series, segment, holdout).where(F.col("points") > holdout)
    w = Window.partitionBy(*segment)
    origin = F.max_by("sales", F.when(F.col("step").isNull(), F.col("month"))).over(w)
    tested = parts.withColumn("forecast", origin).where(F.col("step").isNotNull())
    return forecast_errors(tested, segment)


# --- seasonal ARIMA by two-stage least squares (per segment, on its monthly values) ---


def _difference(y: np.ndarray, d: int, seasonal_d: int, s: int) -> np.ndarray:
    for _ in range(d):
        y = y[1:] - y[:-1]
    for _ in range(seasonal_d):
        y = y[s:] - y[:-s]
    return y


def _lagged(x: np.ndarray, lags: Sequence[int], rows: range) -> np.ndarray:
    return np.column_stack([x[[t - k for t in rows]] for k in lags]) if lags else np.empty((len(rows), 0))


def _long_lag(n: int, ar: list[int], ma: list[int]) -> int:
    return min(max([*ar, *ma, 2]) + 1, n // 3)


def _first_row(n: int, ar: list[int], ma: list[int]) -> int:
    """The first of ``n`` values that has all lags of a model."""
    return max([*ar, *(m + _long_lag(n, ar, ma) for m in ma), 0])


def _fit_arma(z: np.ndarray, ar: list[int], ma: list[int], judged: int):
    """Long autoregression for the innovations, then regression on lags of both.

    Coefficients come from all rows that have the model's lags; AIC is taken over the last ``judged`` values,
    the same months for every model that is compared. Returns coefficients, innovations and AIC, or None when there are too few rows.
    """
    long = _long_lag(len(z), ar, ma)
    innovations = np.zeros_like(z)
    if ma:
        rows = range(long, len(z))
        lags = list(range(1, long + 1))
        if len(rows) <= long:
            return None
        x = _lagged(z, lags, rows)
        innovations[long:] = z[long:] - x @ np.linalg.lstsq(x, z[long:], rcond=None)[0]
    start = _first_row(len(z), ar, ma)
    rows = range(start, len(z))
    k = len(ar) + len(ma)
    if len(rows) <= k + 1:
        return None
    x = np.hstack([_lagged(z, ar, rows), _lagged(innovations, ma, rows)])
    coef = np.linalg.lstsq(x, z[start:], rcond=None)[0]
    fitted = innovations.copy()
    fitted[start:] = z[start:] - x @ coef
    n = min(judged, len(rows))
    sse = float(np.sum(fitted[len(z) - n :] ** 2))
    if sse <= 0 or not np.isfinite(sse):
        return None
    return coef, fitted, n * np.log(sse / n) + 2 * (k + 1)


def _extend(y: np.ndarray, d: int, seasonal_d: int, s: int, ar, ma, coef, innovations, horizon: int) -> np.ndarray:
    z = list(_difference(y, d, seasonal_d, s))
    e = list(innovations)
    for _ in range(horizon):
        t = len(z)
        lags = [z[t - k] for k in ar] + [e[t - k] for k in ma]
        z.append(float(np.dot(coef, lags)))
        e.append(0.0)
    # Undo the differences: first the seasonal one, on the level left by the plain one.
    levels = [y]
    for _ in range(d):
        levels.append(np.diff(levels[-1]))
    ahead = np.array(z[-horizon:])
    if seasonal_d:
        base = list(levels[-1])
        for step in ahead:
            base.append(step + base[len(base) - s])
        ahead = np.array(base[-horizon:])
    for level in reversed(levels[:-1]):
        ahead = level[-1] + np.cumsum(ahead)
    return ahead


def best_arima(y: np.ndarray, horizon: int) -> dict | None:
    """Lowest-AIC model of the grid and its forecast; None when nothing could be fitted."""
    candidates = []
    for p, d, q in ORDERS:
        for sp, sd, sq, s in SEASONAL_LONG if len(y) >= MIN_SEASONAL else SEASONAL_SHORT:
            z = _difference(y, d, sd, s)
            ar = [*range(1, p + 1), *(s * k for k in range(1, sp + 1))]
            ma = [*range(1, q + 1), *(s * k for k in range(1, sq + 1))]
            rows = len(z) - _first_row(len(z), ar, ma)
            if len(z) >= max([*ar, *ma]) + 3 and rows > len(ar) + len(ma) + 1:
                candidates.append((rows, [p, d, q], [sp, sd, sq, s], z, ar, ma))
    # Months that all models have are few if one has few: those with less than MIN_HISTORY stand back.
    candidates = [c for c in candidates if c[0] >= MIN_HISTORY] or candidates
    best, judged = None, min((c[0] for c in candidates), default=0)
    for _, order, seasonal, z, ar, ma in candidates:
        fit = _fit_arma(z, ar, ma, judged)
        if fit is None or not np.isfinite(fit[2]):
            continue
        if best is None or fit[2] < best["aic"]:
            ahead = _extend(y, order[1], seasonal[1], seasonal[3], ar, ma, fit[0], fit[1], horizon)
            if np.all(np.isfinite(ahead)):
                best = {"aic": float(fit[2]), "order": order, "seasonal": seasonal, "forecast": ahead}
    return best


def arima_forecast(series: DataFrame, segment: Sequence[str], horizon: int) -> DataFrame:
    """Per segment: availability, reason, AIC, orders and the forecast array."""
    segment = list(segment)
    keys = [series.schema[c] for c in segment]
    schema = T.StructType(
        keys
        + [
            T.StructField("available", T.BooleanType()),
            T.StructField("reason", T.StringType()),
            T.StructField("aic", T.DoubleType()),
            T.StructField("order", T.ArrayType(T.IntegerType())),
            T.StructField("seasonal_order", T.ArrayType(T.IntegerType())),
            T.StructField("forecast", T.ArrayType(T.DoubleType())),
        ]
    )

    def fit(key, pdf: pd.DataFrame) -> pd.DataFrame:
        y = pdf.sort_values("month")["sales"].to_numpy(dtype=float)
        best = best_arima(y, horizon) if len(y) >= MIN_HISTORY else None
        if best is None:
            reason = NO_ARIMA_HISTORY if len(y) < MIN_HISTORY else ARIMA_FAILED
            row = [False, reason, None, None, None, []]
        else:
            row = [True, None, best["aic"], best["order"], best["seasonal"], [float(v) for v in best["forecast"]]]
        return pd.DataFrame([[*key, *row]], columns=schema.fieldNames())

    return spread(series.select(*segment, "month", "sales"), *segment).groupBy(*segment).applyInPandas(fit, schema)


# --- risk -----------------------------------------------------------------------------


def ewma_volatility(rets: DataFrame, segment: Sequence[str], alpha: float = EWMA_ALPHA) -> DataFrame:
    """Last exponentially weighted standard deviation (bias-corrected); the population
    deviation where one observation leaves it undefined."""
    back = Window.partitionBy(*segment).orderBy(F.desc("month"))
    w = F.pow(F.lit(1 - alpha), F.row_number().over(back) - 1)
    weighted = rets.where(F.col("ret").isNotNull()).withColumn("w", w)
    sums = weighted.groupBy(*segment).agg(
        F.sum("w").alias("sw"),
        F.sum(F.col("w") * F.col("w")).alias("sww"),
        F.sum(F.col("w") * F.col("ret")).alias("swx"),
        F.sum(F.col("w") * F.col("ret") * F.col("ret")).alias("swxx"),
        F.stddev_pop("ret").alias("std_pop"),
        F.count(F.lit(1)).alias("n"),
    )
    biased = F.col("swxx") / F.col("sw") - F.pow(F.col("swx") / F.col("sw"), 2)
    correction = F.try_divide(F.col("sw") * F.col("sw"), F.col("sw") * F.col("sw") - F.col("sww"))
    value = F.when(F.col("n") > 1, F.sqrt(F.greatest(F.lit(0.0), biased * correction)))
    return sums.select(*segment, F.coalesce(value, "std_pop").alias("ewma_volatility"))


def risk_summary(rets: DataFrame, segment: Sequence[str]) -> DataFrame:
    """VaR 95, CVaR 95, annualised volatility, mean and count of the returns."""
    segment = list(segment)
    whole = Window.partitionBy(*segment)
    ranked = rets.where(F.col("ret").isNotNull()).withColumn("var_95", F.percentile("ret", F.lit(0.05)).over(whole))
    out = ranked.groupBy(*segment, "var_95").agg(
        F.avg(F.when(F.col("ret") <= F.col("var_95"), F.col("ret"))).alias("tail_mean"),
        (F.stddev_pop("ret") * F.sqrt(F.lit(12.0))).alias("volatility_annualized"),
        F.avg("ret").alias("return_mean"),
        F.count(F.lit(1)).alias("observations"),
    )
    return out.select(
        *segment,
        "var_95",
        F.coalesce("tail_mean", "var_95").alias("cvar_95"),
        "volatility_annualized",
        "return_mean",
        "observations",
    )


GARCH_ALPHAS = (*(round(0.02 * i, 2) for i in range(0, 16)), *(round(0.05 * i, 2) for i in range(7, 20)))
GARCH_BETAS = tuple(round(0.05 * i, 2) for i in range(0, 20))


def garch_volatility(rets: DataFrame, segment: Sequence[str], min_points: int = MIN_GARCH) -> DataFrame:
    """Next-period volatility of a variance-targeted GARCH(1,1), zero mean, normal.

    The likelihood of a grid point is one fold over a segment's returns, and the search is a
    fold over the grid within the segment's row, so no row is repeated for it.
    """
    segment = list(segment)
    lists = (
        rets.where(F.col("ret").isNotNull())
        .groupBy(*segment)
        .agg(F.sort_array(F.collect_list(F.struct("month", "ret"))).alias("m"))
        .where(F.size("m") >= min_points)
        .select(*segment, F.expr("transform(m, x -> x.ret * 100D)").alias("xs"))
        .withColumn("v0", F.expr("aggregate(xs, 0D, (a, x) -> a + x * x) / size(xs)"))
        .where("v0 > 0")
    )
    points = [(a, b) for a in GARCH_ALPHAS for b in GARCH_BETAS if a + b < 0.999]
    grid = ", ".join(f"named_struct('a', {a!r}D, 'b', {b!r}D)" for a, b in points)
    best = F.expr(
        f"""array_max(transform(array({grid}), g -> aggregate(
             xs, named_struct('h', v0, 'l', 0D),
             (s, x) -> named_struct('h', v0 * (1D - g.a - g.b) + g.a * x * x + g.b * s.h, 'l', s.l - 0.5D * (ln(s.h) + x * x / s.h)),
             s -> named_struct('l', s.l, 'a', -g.a, 'b', -g.b, 'h', s.h))))"""
    )
    return (
        spread(lists, *segment)
        .withColumn("best", best)
        .select(
            *segment,
            (F.sqrt("best.h") / 100.0).alias("garch_volatility"),
            (-F.col("best.a")).alias("garch_alpha"),
            (-F.col("best.b")).alias("garch_beta"),
        )
    )


def risk_report(series: DataFrame, segment: Sequence[str]) -> DataFrame:
    """Risk of every segment of ``series``; ``method`` tells which volatility was used.

    ``dropped_returns`` counts months whose change has no finite value (zero base).
    """
    segment = list(segment)
    rets = returns(series, segment)
    dropped = rets.groupBy(*segment).agg(
        (F.count(F.lit(1)) - 1 - F.count("ret")).alias("dropped_returns")
    )
    parts = null_safe_join(dropped, risk_summary(rets, segment), segment, "left")
    parts = null_safe_join(parts, ewma_volatility(rets, segment), segment, "left")
    parts = null_safe_join(parts, garch_volatility(rets, segment), segment, "left")
    available = F.coalesce(F.col("observations"), F.lit(0)) > 0
    garch = F.col("garch_volatility").isNotNull()
    return parts.select(
        *segment,
        available.alias("available"),
        F.when(~available, NO_RETURNS)
        .when(~garch & (F.col("observations") < MIN_GARCH), FEW_RETURNS)
        .when(~garch, GARCH_FAILED)
        .alias("reason"),
        F.when(~available, F.lit(None)).when(garch, GARCH).otherwise(EWMA).alias("method"),
        F.coalesce("garch_volatility", "ewma_volatility").alias("next_period_volatility"),
        "volatility_annualized",
        "var_95",
        "cvar_95",
        "return_mean",
        F.coalesce("observations", F.lit(0)).alias("observations"),
        "dropped_returns",
    )


# --- the segment report ---------------------------------------------------------------


def model_scores(series: DataFrame, segment: Sequence[str], holdout: int = 6) -> DataFrame:
    """Holdout errors of both models, one row per segment and model."""
    segment = list(segment)
    parts = split_holdout(series, segment, holdout).where(F.col("points") > holdout)
    train, test = parts.where(F.col("step").isNull()), parts.where(F.col("step").isNotNull())
    naive = naive_holdout(series, segment, holdout).withColumn("model", F.lit("naive"))
    fits = arima_forecast(train, segment, holdout)
    pred = fits.where("available").select(*segment, F.posexplode("forecast").alias("pos", "forecast"))
    joined = null_safe_join(
        test.select(*segment, "step", "sales"), pred.select(*segment, (F.col("pos") + 1).alias("step"), "forecast"), [*segment, "step"]
    )
    scored = null_safe_join(
        fits.select(*segment, "available", "reason", "aic", "order", "seasonal_order"),
        forecast_errors(joined, segment), segment, "left",
    ).withColumn("model", F.lit("sarima"))
    return naive.withColumn("available", F.lit(True)).unionByName(scored, allowMissingColumns=True)


def segment_report(series: DataFrame, segment: Sequence[str], holdout: int = 6, horizon: int = 3) -> DataFrame:
    """One row per segment: range, scores, chosen model, forecast and risk.

    The naive model stays chosen unless the other one is strictly better on the
    holdout; segments with no more months than the holdout get risk only.
    """
    segment = list(segment)
    # Every measure below reads the series again: a row per segment and month, written once.
    series = materialize(series, "series")
    span = series.groupBy(*segment).agg(
        F.count(F.lit(1)).alias("series_points"), F.min("month").alias("series_start"), F.max("month").alias("series_end")
    )
    scores = model_scores(series, segment, holdout)
    per_model = scores.groupBy(*segment).agg(
        F.max(F.when(F.col("model") == "naive", F.col("rmse"))).alias("naive_rmse"),
        F.max(F.when(F.col("model") == "sarima", F.col("rmse"))).alias("sarima_rmse"),
        F.max(F.when(F.col("model") == "sarima", F.col("reason"))).alias("sarima_reason"),
    )
    beaten = F.coalesce(F.col("sarima_rmse") < F.col("naive_rmse"), F.lit(False))
    chosen = null_safe_join(span, per_model, segment, "left").withColumns(
        {
            "best_model": F.when(F.col("series_points") > holdout, F.when(beaten, "sarima").otherwise("naive")),
            "best_rmse": F.when(beaten, F.col("sarima_rmse")).otherwise(F.col("naive_rmse")),
        }
    )
    refit = arima_forecast(series, segment, horizon).select(*segment, F.col("forecast").alias("arima_values"))
    last = naive_origin(series, segment).select(*segment, "last_value")
    out = null_safe_join(null_safe_join(chosen, refit, segment, "left"), last, segment, "left")
    repeated = F.array_repeat("last_value", horizon)
    values = F.when(F.col("best_model").isNull(), F.array().cast("array<double>")).when(
        (F.col("best_model") == "sarima") & (F.size("arima_values") > 0), F.col("arima_values")
    ).otherwise(repeated)
    report = out.select(
        *segment, "series_points", "series_start", "series_end",
        F.when(F.col("best_model").isNull(), NO_HISTORY).otherwise("ok").alias("status"),
        "naive_rmse", "sarima_rmse", "sarima_reason", "best_model", "best_rmse", values.alias("forecast"),
    )
    risk = risk_report(series, segment)
    renamed = risk.select(*segment, F.struct(*[c for c in risk.columns if c not in segment]).alias("risk"))
    return null_safe_join(report, renamed, segment, "left")
