"""Scalar column expressions shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

INF = float("inf")
UNKNOWN = "Unknown"


def finite(value: Column) -> Column:
    """NaN and both infinities become NULL."""
    number = value.cast("double")
    return F.when(~F.isnan(number) & (F.abs(number) < F.lit(INF)), number)


def to_number(value: Column) -> Column:
    """Text that is not a number becomes NULL."""
    return finite(value.try_cast("double"))


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient; NULL where it is undefined or not finite."""
    return finite(F.try_divide(numerator.cast("double"), denominator.cast("double")))


def text_or_unknown(value: Column) -> Column:
    return F.coalesce(value.cast("string"), F.lit(UNKNOWN))


def season(month: Column) -> Column:
    return (
        F.when(month.isin(12, 1, 2), "winter")
        .when(month.isin(3, 4, 5), "spring")
        .when(month.isin(6, 7, 8), "summer")
        .when(month.isNotNull(), "autumn")
    )


def parse_order_date(value: Column, fmt: str | None = None) -> Column:
    """Text to date: the given format, else ``M/d/yyyy H:mm``, else ISO; bad text is NULL."""
    if fmt:
        return F.to_date(F.try_to_timestamp(value, F.lit(fmt)))
    return F.to_date(
        F.coalesce(
            F.try_to_timestamp(value, F.lit("M/d/yyyy H:mm")),
            F.try_to_timestamp(value, F.lit("M/d/yyyy")),
            F.try_to_timestamp(value),
        )
    )


def month_start(value: Column) -> Column:
    return F.trunc(F.to_date(value), "month")


def month_from_parts(year: Column, month: Column) -> Column:
    """First day of a month; NULL where the parts are not a valid month."""
    y, m = year.try_cast("int"), month.try_cast("int")
    return F.when(m.between(1, 12) & y.between(1, 9999), F.make_date(y, m, F.lit(1)))


def clip(value: Column, low: float, high: float) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), value))


def utc_now_text() -> Column:
    return F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")


def flag_iqr(value: Column, low: Column, high: Column) -> Column:
    """Outlier flag; a missing value is never an outlier."""
    return F.coalesce((value < low) | (value > high), F.lit(False))
