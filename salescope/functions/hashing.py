"""Hash expressions that do not depend on how a table is partitioned."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def as_text(df: DataFrame, name: str) -> Column:
    """Text form of one column that other engines can rebuild: doubles as whole
    millionths, dates as ISO days, NULL as ``\\N``."""
    kind = df.schema[name].dataType
    col = F.col(name)
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        col = F.round(col * 1e6, 0).cast("decimal(38,0)")
    elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        col = F.date_format(col, "yyyy-MM-dd HH:mm:ss")
    return F.coalesce(col.cast("string"), F.lit("\\N"))


def row_text(df: DataFrame, columns: Sequence[str]) -> Column:
    return F.concat_ws("|", *[as_text(df, c) for c in columns])


def hash_bucket(text: Column, buckets: int = 100) -> Column:
    """Bucket 0..buckets-1 from the first 32 bits of the MD5 digest."""
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint") % buckets


def hash_number(text: Column) -> Column:
    """First 60 bits of the MD5 digest as a number."""
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("decimal(38,0)")


def fingerprint(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """SHA-256 over column names, row count and the sum of row hashes.

    The sum makes it independent of row order, which a distributed table lacks.
    """
    names = ",".join(columns)
    sums = df.select(hash_number(row_text(df, columns)).alias("h")).agg(
        F.count(F.lit(1)).alias("row_count"), F.coalesce(F.sum("h"), F.lit(0)).alias("hash_sum")
    )
    text = F.concat_ws("|", F.lit(names), F.col("row_count").cast("string"), F.col("hash_sum").cast("string"))
    return sums.select(
        F.lit("sha256").alias("algorithm"), "row_count", F.sha2(text.cast("binary"), 256).alias("value")
    )
