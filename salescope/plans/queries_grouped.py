"""Queries over the grouped sales tables, sorts and scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from salescope.functions.hashing import row_text
from salescope.functions.scalar import month_start, season
from salescope.operators import grouped
from salescope.plans.catalog import query, r, rounded, with_sales
from salescope.sources.tables import SALES_COLUMNS, sales_view, table


@query(
    "j06_sales_view",
    with_sales(
        """SELECT ORDERNUMBER, ORDERLINENUMBER, QUANTITYORDERED, PRICEEACH, SALES, PARTKEY, SUPPKEY, SHIPDATE, MSRP,
        PRODUCTLINE, ORDERDATE, QTR_ID, MONTH_ID, YEAR_ID, STATUS, DEALSIZE, CUSTKEY, COUNTRY, TERRITORY FROM sales"""
    ),
)
def sales_rows(spark, sf):
    return sales_view(spark, sf, SALES_COLUMNS)


GROUPED_SQL = """SELECT {key}, round(sum(SALES), 2) AS total_sales, round(avg(SALES), 4) AS avg_sales,
{count} AS orders_count FROM sales GROUP BY {key}"""
ROWS, ORDERS = "count(*)", "count(DISTINCT ORDERNUMBER)"


def _money(df):
    return rounded(df, total_sales=2, avg_sales=4)


@query("g01_sales_by_productline", with_sales(GROUPED_SQL.format(key="PRODUCTLINE", count=ROWS)))
def by_productline(spark, sf):
    return _money(grouped.sales_by_productline(sales_view(spark, sf, ["PRODUCTLINE", "SALES"])))


@query("g02_sales_by_productline_orders", with_sales(GROUPED_SQL.format(key="PRODUCTLINE", count=ORDERS)))
def by_productline_orders(spark, sf):
    view = sales_view(spark, sf, ["PRODUCTLINE", "SALES", "ORDERNUMBER"])
    return _money(grouped.sales_by_productline(view, distinct_orders=True))


TOP = " ORDER BY sum(SALES) DESC, COUNTRY LIMIT 10"


@query("g03_top_countries", with_sales(GROUPED_SQL.format(key="COUNTRY", count=ROWS) + TOP))
def top_countries(spark, sf):
    return _money(grouped.top_countries(sales_view(spark, sf, ["COUNTRY", "SALES"])))


@query("g04_top_countries_orders", with_sales(GROUPED_SQL.format(key="COUNTRY", count=ORDERS) + TOP))
def top_countries_orders(spark, sf):
    view = sales_view(spark, sf, ["COUNTRY", "SALES", "ORDERNUMBER"])
    return _money(grouped.top_countries(view, distinct_orders=True))


@query("g05_sales_by_year", with_sales(GROUPED_SQL.format(key="YEAR_ID", count=ROWS)))
def by_year(spark, sf):
    return _money(grouped.sales_by_year(sales_view(spark, sf, ["YEAR_ID", "SALES"]), year="YEAR_ID"))


@query("g06_sales_by_year_orders", with_sales(GROUPED_SQL.format(key="YEAR_ID", count=ORDERS)))
def by_year_orders(spark, sf):
    view = sales_view(spark, sf, ["YEAR_ID", "SALES", "ORDERNUMBER"])
    return _money(grouped.sales_by_year(view, distinct_orders=True, year="YEAR_ID"))


@query(
    "g07_summary_tables_one_pass",
    with_sales(
        """SELECT CASE WHEN grouping(PRODUCTLINE) = 0 THEN 'PRODUCTLINE' WHEN grouping(COUNTRY) = 0 THEN 'COUNTRY'
           ELSE 'YEAR_ID' END AS dimension,
           CASE WHEN grouping(PRODUCTLINE) = 0 THEN PRODUCTLINE WHEN grouping(COUNTRY) = 0 THEN COUNTRY
           ELSE CAST(YEAR_ID AS VARCHAR) END AS member,
           round(sum(SALES), 2) AS total_sales, round(avg(SALES), 4) AS avg_sales, count(*) AS orders_count
           FROM sales GROUP BY GROUPING SETS ((PRODUCTLINE), (COUNTRY), (YEAR_ID))"""
    ),
)
def summary_one_pass(spark, sf):
    view = sales_view(spark, sf, ["PRODUCTLINE", "COUNTRY", "YEAR_ID", "SALES"])
    return _money(grouped.summary_in_one_pass(view, ["PRODUCTLINE", "COUNTRY", "YEAR_ID"]))


@query(
    "g08_total_by_year",
    with_sales("SELECT YEAR_ID, round(sum(SALES), 2) AS total_sales FROM sales GROUP BY YEAR_ID"),
)
def total_by_year(spark, sf):
    return rounded(grouped.total_by_year(sales_view(spark, sf, ["YEAR_ID", "SALES"]), "YEAR_ID"), total_sales=2)


@query("g35_distinct_years", with_sales("SELECT DISTINCT YEAR_ID FROM sales"))
def distinct_years(spark, sf):
    return grouped.distinct_values(sales_view(spark, sf, ["YEAR_ID"]), "YEAR_ID")


@query("t08_distinct_productlines", with_sales("SELECT DISTINCT PRODUCTLINE FROM sales"))
def distinct_productlines(spark, sf):
    return grouped.distinct_values(sales_view(spark, sf, ["PRODUCTLINE"]), "PRODUCTLINE")


@query(
    "g36_monthly_sales",
    with_sales(
        """SELECT PRODUCTLINE, COUNTRY, CAST(date_trunc('month', ORDERDATE) AS DATE) AS month, round(sum(SALES), 2) AS sales
           FROM sales GROUP BY ALL"""
    ),
)
def monthly(spark, sf):
    view = sales_view(spark, sf, ["PRODUCTLINE", "COUNTRY", "ORDERDATE", "SALES"])
    return rounded(grouped.monthly_sales(view, ["PRODUCTLINE", "COUNTRY"]), sales=2)


@query(
    "g34_duration_summary",
    """SELECT event_type, count(value) AS n, round(avg(value), 6) AS mean_ms, max(value) AS max_ms,
       round(quantile_cont(value, 0.5), 6) AS p50_ms, round(quantile_cont(value, 0.95), 6) AS p95_ms,
       round(quantile_cont(value, 0.99), 6) AS p99_ms FROM events GROUP BY event_type""",
)
def durations(spark, sf):
    out = grouped.duration_summary(table(spark, sf, "events"), "value", ["event_type"])
    return rounded(out, mean_ms=6, p50_ms=6, p95_ms=6, p99_ms=6)


@query(
    "t01_sort_productlines",
    with_sales(
        """SELECT PRODUCTLINE, round(sum(SALES), 2) AS total_sales,
           CAST(row_number() OVER (ORDER BY sum(SALES) DESC, PRODUCTLINE) AS INT) AS position
           FROM sales GROUP BY PRODUCTLINE"""
    ),
)
def sorted_lines(spark, sf):
    from pyspark.sql import Window

    totals = grouped.sales_by_productline(sales_view(spark, sf, ["PRODUCTLINE", "SALES"]))
    order = Window.partitionBy(F.lit(0)).orderBy(F.desc("total_sales"), "PRODUCTLINE")  # one row per product line
    return totals.select("PRODUCTLINE", r("total_sales", 2).alias("total_sales"), F.row_number().over(order).alias("position"))


@query(
    "t02_top_order_lines",
    with_sales(
        """SELECT ORDERNUMBER, ORDERLINENUMBER, PARTKEY, SALES FROM sales
           ORDER BY SALES DESC, ORDERNUMBER, ORDERLINENUMBER, PARTKEY LIMIT 20"""
    ),
)
def top_lines(spark, sf):
    view = sales_view(spark, sf, ["ORDERNUMBER", "ORDERLINENUMBER", "PARTKEY", "SALES"])
    return view.orderBy(F.desc("SALES"), "ORDERNUMBER", "ORDERLINENUMBER", "PARTKEY").limit(20)


ROW_KEY = ["ORDERNUMBER", "ORDERLINENUMBER", "PARTKEY", "SUPPKEY", "SHIPDATE"]
ROW_KEY_SQL = "concat_ws('|', ORDERNUMBER, ORDERLINENUMBER, PARTKEY, SUPPKEY, SHIPDATE)"


@query(
    "t03_first_rows",
    with_sales(
        """SELECT ORDERNUMBER, ORDERLINENUMBER, PARTKEY, SUPPKEY, SHIPDATE, SALES FROM sales
           ORDER BY ORDERNUMBER, ORDERLINENUMBER, PARTKEY, SUPPKEY, SHIPDATE, SALES LIMIT 100"""
    ),
)
def preview(spark, sf):
    view = sales_view(spark, sf, [*ROW_KEY, "SALES"])
    return grouped.first_rows(view, [*ROW_KEY, "SALES"], 100)


@query(
    "t06_hashed_sample",
    with_sales(
        f"""SELECT ORDERNUMBER, ORDERLINENUMBER, PARTKEY, SUPPKEY, SHIPDATE FROM sales
            ORDER BY md5({ROW_KEY_SQL}) LIMIT 512"""
    ),
)
def sample_rows(spark, sf):
    view = sales_view(spark, sf, ROW_KEY)
    return grouped.hashed_sample(view, row_text(view, ROW_KEY), 512)


@query(
    "f01_date_functions",
    """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS order_day, CAST(year(o_orderdate) AS INT) AS y,
       CAST(month(o_orderdate) AS INT) AS m, CAST(quarter(o_orderdate) AS INT) AS q,
       CASE WHEN month(o_orderdate) IN (12, 1, 2) THEN 'winter' WHEN month(o_orderdate) IN (3, 4, 5) THEN 'spring'
            WHEN month(o_orderdate) IN (6, 7, 8) THEN 'summer' ELSE 'autumn' END AS season,
       CAST(date_trunc('month', o_orderdate) AS DATE) AS month_start,
       make_date(year(o_orderdate), month(o_orderdate), 1) AS from_parts FROM orders""",
)
def date_functions(spark, sf):
    from salescope.functions.scalar import month_from_parts

    d = F.col("o_orderdate")
    return table(spark, sf, "orders").select(
        "o_orderkey",
        F.to_date(d).alias("order_day"),
        F.year(d).alias("y"),
        F.month(d).alias("m"),
        F.quarter(d).alias("q"),
        season(F.month(d)).alias("season"),
        month_start(d).alias("month_start"),
        month_from_parts(F.year(d), F.month(d)).alias("from_parts"),
    )


@query(
    "u01_sales_by_season",
    with_sales(
        """SELECT CASE WHEN MONTH_ID IN (12, 1, 2) THEN 'winter' WHEN MONTH_ID IN (3, 4, 5) THEN 'spring'
           WHEN MONTH_ID IN (6, 7, 8) THEN 'summer' ELSE 'autumn' END AS season,
           round(sum(SALES), 2) AS total_sales, count(*) AS n FROM sales GROUP BY ALL"""
    ),
)
def by_season(spark, sf):
    view = sales_view(spark, sf, ["MONTH_ID", "SALES"])
    return view.groupBy(season(F.col("MONTH_ID")).alias("season")).agg(
        r(F.sum("SALES"), 2).alias("total_sales"), F.count(F.lit(1)).alias("n")
    )


@query(
    "f02_math_functions",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, abs(l_extendedprice - 50000) AS gap,
       round(sqrt(l_extendedprice), 6) AS root, round(ln(l_extendedprice), 6) AS log_value,
       round(exp(-l_discount), 6) AS decay, round(power(l_quantity, 2), 6) AS squared,
       greatest(10, least(40, l_quantity)) AS clipped, CAST(ceil(l_extendedprice) AS BIGINT) AS upper,
       greatest(abs(l_discount), 1e-8) AS floor_eps FROM lineitem""",
)
def math_functions(spark, sf):
    from salescope.functions.scalar import clip

    v = F.col("l_extendedprice")
    return table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        F.abs(v - 50000).alias("gap"),
        r(F.sqrt(v), 6).alias("root"),
        r(F.ln(v), 6).alias("log_value"),
        r(F.exp(-F.col("l_discount")), 6).alias("decay"),
        r(F.pow("l_quantity", F.lit(2)), 6).alias("squared"),
        clip(F.col("l_quantity"), 10.0, 40.0).alias("clipped"),
        F.ceil(v).alias("upper"),
        F.greatest(F.abs("l_discount"), F.lit(1e-8)).alias("floor_eps"),
    )
