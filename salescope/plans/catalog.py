"""Registry of named queries with their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salescope.sources.tables import SCHEMAS

Query = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Entry:
    name: str
    run: Query
    sql: str | None


ENTRIES: dict[str, Entry] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        if name in ENTRIES:
            raise ValueError(f"query {name} is registered twice")
        ENTRIES[name] = Entry(name, fn, sql)
        return fn

    return add


def declared(name: str) -> tuple[list[str], dict[str, str]]:
    """Names and types of a table's declared columns."""
    fields = [f.split() for f in SCHEMAS[name].split(",")]
    return [c for c, _ in fields], {c: {"long": "bigint"}.get(t, t) for c, t in fields}


def expected_sql(name: str) -> str:
    return ", ".join(f"('{c}', '{t}')" for c, t in declared(name)[1].items())


def described(name: str) -> str:
    """SQL for a table's columns, with types by the names used here."""
    kinds = "{'BIGINT': 'bigint', 'INTEGER': 'int', 'DOUBLE': 'double', 'VARCHAR': 'string', 'TIMESTAMP': 'timestamp_ntz'}"
    return f"SELECT column_name, coalesce(MAP {kinds}[column_type], column_type) AS kind FROM (DESCRIBE {name})"


def rounded(df: DataFrame, **digits: int) -> DataFrame:
    """Round the named columns; float sums differ in the last digits between engines."""
    return df.select(*[F.round(c, digits[c]).alias(c) if c in digits else F.col(c) for c in df.columns])


def r(column: str | Column, digits: int) -> Column:
    return F.round(column, digits)


# The sales table over the star schema (same columns as ``sources.tables.sales_view``).
SALES = """
sales AS (
  SELECT l_orderkey AS ORDERNUMBER, l_linenumber AS ORDERLINENUMBER, l_quantity AS QUANTITYORDERED,
         l_extendedprice / l_quantity AS PRICEEACH, l_extendedprice AS SALES, l_partkey AS PARTKEY,
         l_suppkey AS SUPPKEY, CAST(l_shipdate AS DATE) AS SHIPDATE,
         p_retailprice AS MSRP, p_type AS PRODUCTLINE, CAST(o_orderdate AS DATE) AS ORDERDATE,
         CAST(quarter(o_orderdate) AS INT) AS QTR_ID, CAST(month(o_orderdate) AS INT) AS MONTH_ID,
         CAST(year(o_orderdate) AS INT) AS YEAR_ID, o_orderstatus AS STATUS, c_mktsegment AS DEALSIZE,
         o_custkey AS CUSTKEY, n_name AS COUNTRY, r_name AS TERRITORY
  FROM lineitem
  LEFT JOIN part ON l_partkey = p_partkey
  LEFT JOIN orders ON l_orderkey = o_orderkey
  LEFT JOIN customer ON o_custkey = c_custkey
  LEFT JOIN nation ON c_nationkey = n_nationkey
  LEFT JOIN region ON n_regionkey = r_regionkey)
"""

RAW = (
    SALES
    + """,
raw AS (
  SELECT ORDERNUMBER, ORDERLINENUMBER, nullif(QUANTITYORDERED, 13) AS QUANTITYORDERED,
         CASE WHEN QUANTITYORDERED = 13 THEN 'n/a' ELSE CAST(CAST(QUANTITYORDERED AS INT) AS VARCHAR) END AS QUANTITY_TEXT,
         PRICEEACH, CASE WHEN PARTKEY % 97 = 0 THEN NULL ELSE SALES END AS SALES,
         CASE WHEN PARTKEY % 50 = 0 THEN NULL WHEN PARTKEY % 50 = 1 THEN 0 ELSE MSRP END AS MSRP,
         CASE WHEN ORDERNUMBER % 101 = 0 THEN 'unknown' ELSE strftime(ORDERDATE, '%-m/%-d/%Y') || ' 0:00' END AS ORDERDATE,
         nullif(PRODUCTLINE, 'PROMO') AS PRODUCTLINE, DEALSIZE, COUNTRY, nullif(TERRITORY, 'ASIA') AS TERRITORY,
         CASE WHEN CUSTKEY % 2 = 0 THEN NULL ELSE 'S' || CAST(CUSTKEY % 7 AS VARCHAR) END AS STATE,
         nullif(CUSTKEY % 1000, 7) AS POSTALCODE, CASE WHEN CUSTKEY % 10 = 0 THEN 'Suite' END AS ADDRESSLINE2
  FROM sales)
"""
)


def with_sales(body: str) -> str:
    return f"WITH {SALES.strip()}\n{body}"


def with_raw(body: str) -> str:
    return f"WITH {RAW.strip()}\n{body}"
