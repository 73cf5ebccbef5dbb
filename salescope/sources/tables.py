"""The sales table over the star schema, and a raw (uncleaned) form of it."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Output column -> (expression, tables it needs beyond the fact table)
_SALES = {
    "ORDERNUMBER": ("l_orderkey", ()),
    "ORDERLINENUMBER": ("l_linenumber", ()),
    "QUANTITYORDERED": ("l_quantity", ()),
    "PRICEEACH": ("l_extendedprice / l_quantity", ()),
    "SALES": ("l_extendedprice", ()),
    "PARTKEY": ("l_partkey", ()),
    "SUPPKEY": ("l_suppkey", ()),
    "SHIPDATE": ("to_date(l_shipdate)", ()),
    "MSRP": ("p_retailprice", ("part",)),
    "PRODUCTLINE": ("p_type", ("part",)),
    "ORDERDATE": ("to_date(o_orderdate)", ("orders",)),
    "QTR_ID": ("quarter(o_orderdate)", ("orders",)),
    "MONTH_ID": ("month(o_orderdate)", ("orders",)),
    "YEAR_ID": ("year(o_orderdate)", ("orders",)),
    "STATUS": ("o_orderstatus", ("orders",)),
    "DEALSIZE": ("c_mktsegment", ("orders", "customer")),
    "CUSTKEY": ("o_custkey", ("orders",)),
    "COUNTRY": ("n_name", ("orders", "customer", "nation")),
    "TERRITORY": ("r_name", ("orders", "customer", "nation", "region")),
}

SALES_COLUMNS = tuple(_SALES)
_KEYS = {
    "l_orderkey", "l_partkey", "p_partkey", "o_orderkey", "o_custkey", "c_custkey", "c_nationkey", "n_nationkey", "n_regionkey", "r_regionkey",
}

# The columns the engine reads, with their types.
SCHEMAS = {
    "lineitem": """l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double,
        l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string,
        l_shipdate timestamp_ntz""",
    "orders": """o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double,
        o_orderdate timestamp_ntz, o_orderpriority string""",
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "part": "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "region": "r_regionkey int, r_name string",
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string",
}


_WIDER = {("int", "bigint"), ("smallint", "bigint"), ("smallint", "int"), ("float", "double"), ("timestamp", "timestamp_ntz"), ("date", "timestamp_ntz")}


class SchemaError(ValueError):
    """A file lacks a column, or holds it with another type."""


def file_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table with the schema of its files."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def table(spark: SparkSession, sf_dir: str, name: str, needed: Sequence[str] | None = None) -> DataFrame:
    """A table whose files were found to hold the declared columns (only those ``needed``, if given), with their
    types or narrower ones."""
    df = file_table(spark, sf_dir, name)
    if name not in SCHEMAS:
        return df
    found = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    declared = T.StructType.fromDDL(SCHEMAS[name])
    wanted = {f.name: f.dataType.simpleString() for f in declared.fields if needed is None or f.name in needed}
    absent = sorted(c for c in wanted if c not in found)
    odd = [f"{c}: {found[c]} for {t}" for c, t in wanted.items() if c in found and found[c] != t and (found[c], t) not in _WIDER]
    if absent or odd:
        raise SchemaError(f"{name}: absent columns {absent}, other types {odd}")
    return df.select(*[F.col(c) if found[c] == t else F.col(c).cast(t).alias(c) for c, t in wanted.items()])


def sales_view(spark: SparkSession, sf_dir: str, columns: Sequence[str] = SALES_COLUMNS) -> DataFrame:
    """One row per order line with the requested columns.

    Dimension keys are unique, so a lookup keeps every line (left join) and one that
    no requested column needs is left out. The order-level lookups are joined among
    themselves first: they move order-sized rows, not line-sized ones. Join sides are
    sized by Spark (statistics, then AQE); the fact table is always the left side, so
    AQE can split a hot key.
    """
    needed = {t for c in columns for t in _SALES[c][1]}
    named = {word for c in columns for word in re.findall(r"\w+", _SALES[c][0])} | _KEYS
    read = lambda name: table(spark, sf_dir, name, named)
    lines = read("lineitem")
    if "part" in needed:
        part = read("part")
        lines = lines.join(part, lines.l_partkey == part.p_partkey, "left")
    if "orders" in needed:
        heads = read("orders")
        if "customer" in needed:
            who = read("customer")
            if "nation" in needed:
                nation = read("nation")
                who = who.join(nation, who.c_nationkey == nation.n_nationkey, "left")
            if "region" in needed:
                region = read("region")
                who = who.join(region, who.n_regionkey == region.r_regionkey, "left")
            heads = heads.join(who, heads.o_custkey == who.c_custkey, "left")
        lines = lines.join(heads, lines.l_orderkey == heads.o_orderkey, "left")
    return lines.select(*[F.expr(_SALES[c][0]).alias(c) for c in columns])


# Raw form: text dates, missing entries and bad numbers as an uncleaned file has them.
_RAW = {
    "ORDERNUMBER": "ORDERNUMBER",
    "ORDERLINENUMBER": "ORDERLINENUMBER",
    "QUANTITYORDERED": "nullif(QUANTITYORDERED, 13D)",
    "QUANTITY_TEXT": "CASE WHEN QUANTITYORDERED = 13D THEN 'n/a' ELSE cast(cast(QUANTITYORDERED AS int) AS string) END",
    "PRICEEACH": "PRICEEACH",
    "SALES": "CASE WHEN PARTKEY % 97 = 0 THEN NULL ELSE SALES END",
    "MSRP": "CASE WHEN PARTKEY % 50 = 0 THEN NULL WHEN PARTKEY % 50 = 1 THEN 0D ELSE MSRP END",
    "ORDERDATE": "CASE WHEN ORDERNUMBER % 101 = 0 THEN 'unknown' ELSE date_format(ORDERDATE, 'M/d/yyyy') || ' 0:00' END",
    "PRODUCTLINE": "nullif(PRODUCTLINE, 'PROMO')",
    "DEALSIZE": "DEALSIZE",
    "COUNTRY": "COUNTRY",
    "TERRITORY": "nullif(TERRITORY, 'ASIA')",
    "STATE": "CASE WHEN CUSTKEY % 2 = 0 THEN NULL ELSE 'S' || cast(CUSTKEY % 7 AS string) END",
    "POSTALCODE": "nullif(CUSTKEY % 1000, 7)",
    "ADDRESSLINE2": "CASE WHEN CUSTKEY % 10 = 0 THEN 'Suite' END",
}


def raw_sales(spark: SparkSession, sf_dir: str, columns: Sequence[str] = tuple(_RAW)) -> DataFrame:
    """The sales table before cleaning."""
    base = [c for c in SALES_COLUMNS if any(c in _RAW[k] for k in columns)]
    return sales_view(spark, sf_dir, base).select(*[F.expr(_RAW[c]).alias(c) for c in columns])


def cached(df: DataFrame) -> DataFrame:
    """Computed on first use and kept (memory, then disk) for later ones; a lost
    executor's part is computed again from the source."""
    return df.persist(StorageLevel.MEMORY_AND_DISK)
