"""Cleaning and feature preparation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salescope.functions.quantiles import column_quantiles, exact_ranks
from salescope.functions.scalar import (
    finite,
    flag_iqr,
    parse_order_date,
    safe_ratio,
    season,
    text_or_unknown,
    to_number,
)
from salescope.operators.contracts import FeatureSchema, require_columns
from salescope.session import held


@dataclass(frozen=True)
class CleaningRules:
    drop: tuple[str, ...] = ("ADDRESSLINE2",)
    fill_unknown: tuple[str, ...] = ("STATE", "TERRITORY")
    postal_code: str = "POSTALCODE"
    order_date: str = "ORDERDATE"
    order_date_format: str | None = None


def drop_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.drop(*columns)


def fill_unknown(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """NULL becomes the text 'Unknown' in those of the columns that exist."""
    present = [c for c in columns if c in df.columns]
    return df.withColumns({c: text_or_unknown(F.col(c)) for c in present}) if present else df


def postal_code_text(df: DataFrame, column: str = "POSTALCODE") -> DataFrame:
    return df.withColumn(column, text_or_unknown(F.col(column))) if column in df.columns else df


def clean_missing(df: DataFrame, rules: CleaningRules = CleaningRules()) -> DataFrame:
    out = fill_unknown(drop_columns(df, rules.drop), rules.fill_unknown)
    return postal_code_text(out, rules.postal_code)


def add_date_parts(df: DataFrame, column: str = "ORDERDATE", fmt: str | None = None) -> DataFrame:
    """Order date as a date, with YEAR and MONTH."""
    require_columns(df, [column])
    if isinstance(df.schema[column].dataType, T.StringType):
        df = df.withColumn(column, parse_order_date(F.col(column), fmt))
    else:
        df = df.withColumn(column, F.to_date(column))
    return df.withColumns({"YEAR": F.year(column), "MONTH": F.month(column)})


def derive_target(df: DataFrame, target: str = "SALES") -> DataFrame:
    """Quantity times price, when the target is absent and both inputs exist."""
    if target in df.columns or not {"QUANTITYORDERED", "PRICEEACH"} <= set(df.columns):
        return df
    return df.withColumn(target, F.col("QUANTITYORDERED") * F.col("PRICEEACH"))


def coerce_numbers(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({c: to_number(F.col(c)) for c in columns})


def impute_median(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """NULL becomes the column's exact median."""
    medians = column_quantiles(df, columns, [0.5])
    filled = {c: F.coalesce(F.col(c), F.lit(medians[c][0]).cast("double")) for c in columns}
    return df.withColumns(filled)


def categories_as_text(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({c: text_or_unknown(F.col(c)) for c in columns})


def drop_missing_target(df: DataFrame, target: str) -> DataFrame:
    return df.where(F.col(target).isNotNull())


def prepare(df: DataFrame, schema: FeatureSchema) -> DataFrame:
    """Target, numeric coercion, median fill, text categories, complete target."""
    out = require_columns(derive_target(df, schema.target), [*schema.features, schema.target])
    numbers = [*schema.numeric, schema.target]
    out = impute_median(coerce_numbers(out, numbers), numbers)
    return drop_missing_target(categories_as_text(out, schema.categorical), schema.target)


def keep_segment(df: DataFrame, **values: str | None) -> DataFrame:
    """Equality filters; a column that is absent, or a value that is None or
    '(all)', filters nothing."""
    for column, value in values.items():
        if column in df.columns and value is not None and value != "(all)":
            df = df.where(F.col(column) == F.lit(value))
    return df


def first_and_last_period(df: DataFrame, period: str, order_key: str | None = None) -> DataFrame:
    """Rows of the first and the last period, labelled ``reference`` / ``current``.

    With fewer than two periods the table is halved by ``order_key``: rows below the
    key at position ``n // 2`` are the reference.
    """
    bounds = df.agg(F.min(period).alias("lo"), F.max(period).alias("hi")).first()
    if bounds["lo"] != bounds["hi"]:
        tag = F.when(F.col(period) == bounds["lo"], "reference").when(F.col(period) == bounds["hi"], "current")
        return df.withColumn("sample", tag).where(F.col("sample").isNotNull())
    if order_key is None:
        raise ValueError("one period only: an order key is needed to halve the table")
    return halves(df, order_key)


def halves(df: DataFrame, order_key: str) -> DataFrame:
    """First and second half by an order key, without numbering the rows."""
    middle = exact_ranks(df, [order_key], ["floor({n} / 2)"]).first()["values"][0]
    return df.withColumn("sample", F.when(F.col(order_key) < F.lit(middle), "reference").otherwise("current"))


def iqr_bounds(df: DataFrame, columns: Sequence[str], factor: float = 1.5) -> DataFrame:
    """``column_name, q1, q3, iqr, lower_bound, upper_bound`` for whole columns."""
    rows = []
    for c, (q1, q3) in column_quantiles(df, columns, [0.25, 0.75]).items():
        rows.append((c, *_bounds(q1, q3, factor)))
    return df.sparkSession.createDataFrame(
        rows, "column_name string, q1 double, q3 double, iqr double, lower_bound double, upper_bound double"
    )


def _bounds(q1: float | None, q3: float | None, factor: float):
    if q1 is None:
        return None, None, None, None, None
    iqr = q3 - q1
    return q1, q3, iqr, q1 - factor * iqr, q3 + factor * iqr


def flag_outliers(df: DataFrame, column: str, factor: float = 1.5) -> DataFrame:
    """Adds ``<column>_OUTLIER`` by the interquartile rule."""
    q1, q3 = column_quantiles(df, [column], [0.25, 0.75])[column]
    *_, low, high = _bounds(q1, q3, factor)
    return df.withColumn(f"{column}_OUTLIER", flag_iqr(F.col(column), F.lit(low), F.lit(high)))


@dataclass(frozen=True)
class OutlierRemoval:
    kept: DataFrame
    report: DataFrame
    bounds: Mapping[str, tuple[float, float]] = field(default_factory=dict)


def remove_outliers(df: DataFrame, columns: Sequence[str], factor: float = 1.5) -> OutlierRemoval:
    """Column after column: bounds come from the rows the earlier columns left.

    Only the numeric columns are held for the passes; what is returned is the input
    under literal range filters.
    """
    require_columns(df, columns)
    shapes, kept_all, passing = {}, df, []
    with held(df.select(*[F.col(c).cast("double").alias(c) for c in columns])) as numbers:
        left = numbers
        for c in columns:
            q1, q3 = column_quantiles(left, [c], [0.25, 0.75], hold=False)[c]
            shapes[c] = _bounds(q1, q3, factor)
            low, high = (F.lit(v).cast("double") for v in shapes[c][3:])
            keep = ~flag_iqr(F.col(c).cast("double"), low, high)
            left, kept_all = left.where(keep), kept_all.where(keep)
            passing.append(passing[-1] & keep if passing else keep)
        counts = numbers.agg(F.count(F.lit(1)), *[F.count_if(p) for p in passing]).first()
    rows = [
        (i, c, *shapes[c], counts[i], counts[i + 1], counts[i] - counts[i + 1]) for i, c in enumerate(columns)
    ]
    bounds = {c: shape[3:] for c, shape in shapes.items()}
    report = df.sparkSession.createDataFrame(
        rows,
        "step int, column_name string, q1 double, q3 double, iqr double, lower_bound double, upper_bound double, "
        "rows_before long, rows_after long, outliers long",
    )
    return OutlierRemoval(kept_all, report, bounds)


def finite_only(df: DataFrame, column: str, require: bool = False) -> DataFrame:
    """Rows whose entry is a finite number; optionally an error when there is none."""
    kept = df.withColumn(column, finite(F.col(column))).where(F.col(column).isNotNull())
    if require and kept.isEmpty():
        raise ValueError(f"{column} must contain at least one finite value")
    return kept


def add_time_features(df: DataFrame, column: str = "ORDERDATE") -> DataFrame:
    """YEAR and MONTH where absent, QUARTER and SEASON."""
    made = {n: f(column) for n, f in (("YEAR", F.year), ("MONTH", F.month)) if n not in df.columns}
    out = df.withColumns({**made, "QUARTER": F.quarter(column)})
    return out.withColumn("SEASON", season(F.col("MONTH")))


def add_ratio_features(df: DataFrame) -> DataFrame:
    """Price to list-price ratio (undefined -> median) and quantity times price."""
    out = df
    if {"PRICEEACH", "MSRP"} <= set(df.columns):
        out = out.withColumn("PRICE_TO_MSRP_RATIO", safe_ratio(F.col("PRICEEACH"), F.col("MSRP")))
        out = impute_median(out, ["PRICE_TO_MSRP_RATIO"])
    if {"QUANTITYORDERED", "PRICEEACH"} <= set(df.columns):
        out = out.withColumn("LINE_TOTAL_APPROX", F.col("QUANTITYORDERED") * F.col("PRICEEACH"))
    return out


# Fixed value lists: candidate model inputs, of which those present are used.
REGRESSION_NUMERIC = (
    "QUANTITYORDERED", "PRICEEACH", "MSRP", "YEAR", "MONTH", "QUARTER", "PRICE_TO_MSRP_RATIO", "LINE_TOTAL_APPROX",
)
REGRESSION_CATEGORICAL = ("PRODUCTLINE", "DEALSIZE", "COUNTRY", "SEASON")


def regression_features(df: DataFrame, target: str = "SALES") -> tuple[DataFrame, FeatureSchema]:
    """Engineered features and the contract of those that are present."""
    out = add_ratio_features(add_time_features(df))
    schema = FeatureSchema(
        tuple(c for c in REGRESSION_NUMERIC if c in out.columns),
        tuple(c for c in REGRESSION_CATEGORICAL if c in out.columns),
        target,
    )
    return out, schema


def regression_dataset(
    df: DataFrame,
    numeric: Sequence[str] = ("QUANTITYORDERED", "PRICEEACH", "SALES", "MSRP"),
    rules: CleaningRules = CleaningRules(),
    factor: float = 1.5,
) -> tuple[DataFrame, FeatureSchema]:
    """Dates, missing values, sequential outlier removal, features; then features + target."""
    dated = add_date_parts(df, rules.order_date, rules.order_date_format)
    kept = remove_outliers(clean_missing(dated, rules), numeric, factor).kept
    features, schema = regression_features(kept)
    require_columns(features, [schema.target])
    return features.select(*schema.features, F.col(schema.target).cast("double").alias(schema.target)), schema
