"""Quality of predictions: error metrics, calibration, interval fitting."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salescope.functions.bins import bin_closed_right
from salescope.functions.quantiles import column_quantiles, exact_quantiles, exact_ranks
from salescope.session import held, local


def regression_metrics(df: DataFrame, actual: str = "SALES", predicted: str = "prediction") -> DataFrame:
    """One row: mse, rmse, mae, r2."""
    error = F.col(actual) - F.col(predicted)
    return df.agg(
        F.avg(error * error).alias("mse"), F.avg(F.abs(error)).alias("mae"), F.var_pop(actual).alias("spread")
    ).select(
        "mse",
        F.sqrt("mse").alias("rmse"),
        "mae",
        (1 - F.try_divide(F.col("mse"), F.col("spread"))).alias("r2"),
    )


def calibration_bins(df: DataFrame, actual: str, predicted: str, bins: int = 10) -> DataFrame:
    """Rows and means per quantile bin ``(a, b]`` of the prediction."""
    probs = [i / bins for i in range(1, bins)]
    with held(df.select(F.col(actual).alias("a"), F.col(predicted).alias("p"))) as rows:
        inner = column_quantiles(rows, ["p"], probs, hold=False)["p"] if probs else []
        if inner and inner[0] is None:
            raise ValueError("calibration needs at least one row")
        out = (
            rows.select("a", "p", bin_closed_right("p", inner).alias("bin"))
            .groupBy("bin")
            .agg(F.count(F.lit(1)).alias("rows"), F.avg("a").alias("mean_true"), F.avg("p").alias("mean_pred"))
        )
        return local(out)  # one row per bin


def calibration_error(df: DataFrame, actual: str = "SALES", predicted: str = "prediction", bins: int = 10) -> DataFrame:
    """Row-weighted mean gap between mean truth and mean prediction over the bins."""
    gaps = calibration_bins(df, actual, predicted, bins)
    return gaps.agg(
        (F.sum(F.col("rows") * F.abs(F.col("mean_true") - F.col("mean_pred"))) / F.sum("rows")).alias(
            "calibration_error"
        )
    )


def fit_conformal(df: DataFrame, actual: str = "SALES", predicted: str = "prediction", alpha: float = 0.1) -> DataFrame:
    """Split-conformal fit on absolute residuals: one row with ``q_hat`` and coverage."""
    if not 0 < alpha < 1:
        raise ValueError("alpha must be between 0 and 1")
    rank = f"ceil(({{n}} - 1) * least(1.0D, ceil(({{n}} + 1) * {1 - alpha!r}D) / {{n}}))"
    gap = F.abs(F.col(actual).cast("double") - F.col(predicted).cast("double"))
    with held(df.select(gap.alias("error"))) as errors:
        fit = exact_ranks(errors, ["error"], [rank], hold=False).first()
        q_hat, n = fit["values"][0], fit["n"]
        total, covered = errors.agg(F.count(F.lit(1)), F.count_if(F.col("error") <= F.lit(q_hat))).first()
    if total == 0:
        raise ValueError("conformal calibration needs at least one row")
    if n < total:
        raise ValueError("conformal calibration needs finite residuals")
    return df.sparkSession.createDataFrame(
        [("split_conformal_abs_residual", alpha, 1 - alpha, q_hat, total, covered / total)],
        "method string, alpha double, nominal_coverage double, q_hat double, calibration_size long, "
        "empirical_coverage double",
    )


def residual_quantiles(df: DataFrame, actual: str = "SALES", predicted: str = "prediction") -> DataFrame:
    """One row: q10 and q90 of truth minus prediction."""
    residuals = df.select((F.col(actual) - F.col(predicted)).alias("residual"))
    return exact_quantiles(residuals, ["residual"], [0.1, 0.9]).select(
        F.lit("residual_quantiles").alias("method"),
        F.col("values")[0].alias("residual_q10"),
        F.col("values")[1].alias("residual_q90"),
        F.col("n").alias("residual_count"),
    )
