"""Sinks: partitioned Parquet, summary tables, JSON reports, append logs, models."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salescope.functions.scalar import finite, utc_now_text


def write_partitioned(df: DataFrame, path: str, keys: Sequence[str] = ()) -> None:
    """Parquet by partition keys; untouched key values of an earlier write stay.

    The rebalance hint shuffles by key and lets AQE cut a large key into several
    writers (and files) of the advisory size, and join small keys into one task.
    Without keys: a plain overwrite.
    """
    if not keys:
        df.write.mode("overwrite").parquet(path)
        return
    (
        df.hint("rebalance", *keys)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*keys)
        .parquet(path)
    )


def register_table(df: DataFrame, name: str, managed: bool = False) -> DataFrame:
    """Create or replace a named table: a view over the source, or a stored copy."""
    if managed:
        df.write.mode("overwrite").saveAsTable(name)
    else:
        df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def write_summary_tables(tables: Mapping[str, DataFrame], folder: str) -> list[str]:
    """Each named table as Parquet and, from that, as CSV (with header)."""
    written = []
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{folder}/{name}.parquet")
        stored = df.sparkSession.read.schema(df.schema).parquet(f"{folder}/{name}.parquet")
        stored.write.mode("overwrite").option("header", True).csv(f"{folder}/{name}.csv")
        written += [f"{folder}/{name}.csv", f"{folder}/{name}.parquet"]
    return written


def json_safe(df: DataFrame) -> DataFrame:
    """NaN and infinities become NULL in every floating-point column."""
    doubles = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    return df.select(*[finite(F.col(c)).alias(c) if c in doubles else F.col(c) for c in df.columns])


def write_report(df: DataFrame, path: str, project: str) -> None:
    """A long report table as JSON lines, stamped with project and UTC time."""
    stamped = json_safe(df).select(F.lit(project).alias("project_name"), utc_now_text().alias("generated_at"), "*")
    stamped.write.mode("overwrite").json(path)


def append_log(df: DataFrame, path: str) -> None:
    """Append rows to a JSON-lines log."""
    df.write.mode("append").json(path)


def write_importance(df: DataFrame, path: str) -> None:
    """Feature importance as CSV with header."""
    df.write.mode("overwrite").option("header", True).csv(path)


def save_model(model: PipelineModel, path: str, metadata: DataFrame) -> None:
    """A fitted pipeline and, beside it, its one-row metadata record."""
    model.write().overwrite().save(f"{path}/model")
    metadata.coalesce(1).write.mode("overwrite").json(f"{path}/metadata")


def load_model(spark: SparkSession, path: str) -> tuple[PipelineModel, DataFrame]:
    return PipelineModel.load(f"{path}/model"), spark.read.json(f"{path}/metadata")
