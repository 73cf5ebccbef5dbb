"""Grouped sales tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salescope.functions.quantiles import exact_quantiles, null_safe_join
from salescope.functions.scalar import month_start


def sales_by(df: DataFrame, key: str, distinct_orders: bool = False) -> DataFrame:
    """Total, mean and order count per key.

    ``orders_count`` counts rows, or distinct order numbers when asked to.
    """
    orders = F.count_distinct("ORDERNUMBER") if distinct_orders else F.count(F.lit(1))
    return df.groupBy(key).agg(
        F.sum("SALES").alias("total_sales"), F.avg("SALES").alias("avg_sales"), orders.alias("orders_count")
    )


def sales_by_productline(df: DataFrame, distinct_orders: bool = False) -> DataFrame:
    return sales_by(df, "PRODUCTLINE", distinct_orders).orderBy(F.desc("total_sales"), "PRODUCTLINE")


def top_countries(df: DataFrame, limit: int = 10, distinct_orders: bool = False) -> DataFrame:
    return sales_by(df, "COUNTRY", distinct_orders).orderBy(F.desc("total_sales"), "COUNTRY").limit(limit)


def sales_by_year(df: DataFrame, distinct_orders: bool = False, year: str = "YEAR") -> DataFrame:
    return sales_by(df, year, distinct_orders).orderBy(year)


def total_by_year(df: DataFrame, year: str = "YEAR") -> DataFrame:
    return df.groupBy(year).agg(F.sum("SALES").alias("total_sales")).orderBy(year)


def summary_tables(df: DataFrame, limit: int = 10, distinct_orders: bool = False) -> dict[str, DataFrame]:
    """The three tables by name, as separate plans."""
    return {
        "sales_by_productline": sales_by_productline(df, distinct_orders),
        "top_countries_by_sales": top_countries(df, limit, distinct_orders),
        "sales_by_year": sales_by_year(df, distinct_orders),
    }


def summary_in_one_pass(df: DataFrame, keys: Sequence[str] = ("PRODUCTLINE", "COUNTRY", "YEAR")) -> DataFrame:
    """All tables from one scan: grouping sets over the keys, as ``dimension, member``."""
    base = df.select("SALES", *[F.col(k).cast("string").alias(k) for k in keys])
    grouped = base.groupingSets([[F.col(k)] for k in keys], *[F.col(k) for k in keys]).agg(
        F.sum("SALES").alias("total_sales"),
        F.avg("SALES").alias("avg_sales"),
        F.count(F.lit(1)).alias("orders_count"),
        *[F.grouping(k).alias(f"__{k}") for k in keys],
    )
    dimension = F.coalesce(*[F.when(F.col(f"__{k}") == 0, F.lit(k)) for k in keys])
    member = F.coalesce(*[F.when(F.col(f"__{k}") == 0, F.col(k)) for k in keys])
    return grouped.select(
        dimension.alias("dimension"), member.alias("member"), "total_sales", "avg_sales", "orders_count"
    )


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct().orderBy(column)


def monthly_sales(df: DataFrame, segment: Sequence[str], date: str = "ORDERDATE", value: str = "SALES") -> DataFrame:
    """Sum per segment and month; rows without a date or value are left out."""
    return (
        df.where(F.col(date).isNotNull() & F.col(value).isNotNull())
        .groupBy(*segment, month_start(F.col(date)).alias("month"))
        .agg(F.sum(value).alias("sales"))
    )


def first_rows(df: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    """First ``n`` rows under an explicit order."""
    return df.orderBy(*order).limit(n)


def hashed_sample(df: DataFrame, key_text, n: int) -> DataFrame:
    """At most ``n`` rows, the same ones on any partitioning: smallest hash first."""
    return df.withColumn("__h", F.md5(key_text)).orderBy("__h").limit(n).drop("__h")


def duration_summary(df: DataFrame, column: str, by: Sequence[str]) -> DataFrame:
    """Mean, p50, p95, p99 and maximum of a duration per group."""
    base = df.groupBy(*by).agg(
        F.count(column).alias("n"), F.avg(column).alias("mean_ms"), F.max(column).alias("max_ms")
    )
    q = exact_quantiles(df, [column], [0.5, 0.95, 0.99], by).select(
        *by, *[F.col("values")[i].alias(c) for i, c in enumerate(("p50_ms", "p95_ms", "p99_ms"))]
    )
    return null_safe_join(base, q, list(by), "left")
