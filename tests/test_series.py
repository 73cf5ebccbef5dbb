"""Monthly series, forecasts and risk."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest

from salescope.operators import timeseries as ts


def lines(spark, values, start="2003-01-01", seg="A"):
    days = pd.date_range(start, periods=len(values), freq="MS")
    rows = [(seg, d.date(), float(v)) for d, v in zip(days, values) if v is not None]
    return spark.createDataFrame(rows, "seg string, ORDERDATE date, SALES double")


def test_gaps_are_zero(spark):
    got = ts.monthly_series(lines(spark, [5, None, None, 7]), ["seg"]).orderBy("month").collect()
    assert [(r["month"], r["sales"], r["filled"]) for r in got] == [
        (dt.date(2003, 1, 1), 5.0, False), (dt.date(2003, 2, 1), 0.0, True),
        (dt.date(2003, 3, 1), 0.0, True), (dt.date(2003, 4, 1), 7.0, False),
    ]


def test_months_from_parts_and_without_dates(spark):
    df = spark.createDataFrame([("A", 2003, 1, 2.0), ("A", 2003, 13, 9.0), ("A", 2003, 2, 3.0)], "seg string, YEAR_ID int, MONTH_ID int, SALES double")
    assert [r["sales"] for r in ts.monthly_series(df, ["seg"]).orderBy("month").collect()] == [2.0, 3.0]
    assert ts.monthly_series(df.drop("YEAR_ID"), ["seg"]).count() == 0


def test_ewma_equals_pandas(spark):
    values = np.random.default_rng(1).uniform(50, 150, 30)
    series = ts.monthly_series(lines(spark, values), ["seg"])
    want = pd.Series(values).pct_change().dropna().ewm(alpha=0.06).std(bias=False).iloc[-1]
    got = ts.ewma_volatility(ts.returns(series, ["seg"]), ["seg"]).first()["ewma_volatility"]
    assert got == pytest.approx(want, rel=1e-9)


def test_risk_equals_numpy(spark):
    values = np.random.default_rng(2).uniform(50, 150, 40)
    r = pd.Series(values).pct_change().dropna().to_numpy()
    row = ts.risk_summary(ts.returns(ts.monthly_series(lines(spark, values), ["seg"]), ["seg"]), ["seg"]).first()
    var = np.quantile(r, 0.05)
    assert row["var_95"] == pytest.approx(var)
    assert row["cvar_95"] == pytest.approx(r[r <= var].mean())
    assert row["volatility_annualized"] == pytest.approx(r.std() * np.sqrt(12))
    assert row["observations"] == 39


def test_garch_follows_the_recent_level(spark):
    rng = np.random.default_rng(3)
    calm, wild = rng.normal(0, 0.01, 60), rng.normal(0, 0.2, 60)
    level = lambda r: 100 * np.exp(np.cumsum(r))
    df = lines(spark, level(np.r_[calm, wild]), seg="up").unionByName(lines(spark, level(np.r_[wild, calm]), seg="down"))
    got = {r["seg"]: r["garch_volatility"] for r in ts.garch_volatility(ts.returns(ts.monthly_series(df, ["seg"]), ["seg"]), ["seg"]).collect()}
    assert got["up"] > got["down"] > 0


def test_arima_on_a_trend_beats_naive(spark):
    values = 100 + 5 * np.arange(48) + np.random.default_rng(4).normal(0, 0.5, 48)
    report = ts.segment_report(ts.monthly_series(lines(spark, values), ["seg"]), ["seg"]).first()
    assert report["best_model"] == "sarima" and report["sarima_rmse"] < report["naive_rmse"]
    assert len(report["forecast"]) == 3 and report["forecast"][2] > values[-1]


def test_arima_carries_a_season():
    months = np.arange(72)
    y = 100 + 20 * np.sin(2 * np.pi * months / 12) + np.random.default_rng(5).normal(0, 0.3, 72)
    best = ts.best_arima(y, 12)
    want = 100 + 20 * np.sin(2 * np.pi * np.arange(72, 84) / 12)
    assert np.sqrt(np.mean((best["forecast"] - want) ** 2)) < np.sqrt(np.mean((y[-1] - want) ** 2))


def test_short_and_single_month_segments(spark):
    df = lines(spark, [1, 2, 3], seg="short").unionByName(lines(spark, [4], seg="one"))
    got = {r["seg"]: r for r in ts.segment_report(ts.monthly_series(df, ["seg"]), ["seg"]).collect()}
    assert got["short"]["status"] == "insufficient history" and got["short"]["best_model"] is None
    assert got["short"]["forecast"] == [] and got["short"]["risk"]["available"]
    assert got["one"]["risk"]["available"] is False
    assert got["one"]["risk"]["reason"] == "insufficient returns history"


def test_zero_months_are_counted(spark):
    risk = ts.risk_report(ts.monthly_series(lines(spark, [5, None, 7, 8]), ["seg"]), ["seg"]).first()
    assert risk["dropped_returns"] == 1 and risk["observations"] == 2 and risk["method"] == "ewma_fallback"


def test_unknown_segment_is_empty(spark):
    from salescope.operators.cleaning import keep_segment

    assert ts.segment_report(ts.monthly_series(keep_segment(lines(spark, [1, 2]), seg="none"), ["seg"]), ["seg"]).count() == 0


def test_invalid_arguments(spark):
    series = ts.monthly_series(lines(spark, [1, 2]), ["seg"])
    with pytest.raises(ValueError):
        ts.split_holdout(series, ["seg"], 0)
    with pytest.raises(ValueError):
        ts.naive_forecast(series, ["seg"], 0)


def test_models_are_compared_over_the_same_months(monkeypatch):
    judged, fit = [], ts._fit_arma

    def watched(z, ar, ma, months):
        judged.append((months, len(z) - ts._first_row(len(z), ar, ma)))
        return fit(z, ar, ma, months)

    monkeypatch.setattr(ts, "_fit_arma", watched)
    rng = np.random.default_rng(2)
    assert ts.best_arima(100 + 10 * np.sin(np.arange(60) * np.pi / 6) + rng.normal(size=60), 3) is not None
    assert len({m for m, _ in judged}) == 1 and judged[0][0] == min(own for _, own in judged) < max(own for _, own in judged)
