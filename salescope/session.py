"""Session settings and shared-storage helpers."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def build_session(app_name: str = "salescope", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings the operators rely on (AQE, skew join, UTC)."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Folder all executors can reach: the cluster's checkpoint folder.

    A machine-local temporary folder is used only where the setting is absent
    and the session is local.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="salescope-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def _written(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def materialize(df: DataFrame, label: str = "stage") -> DataFrame:
    """Cut lineage by writing to the shared folder and reading back.

    Survives executor loss, and later scans prune columns and push filters down.
    """
    return _written(df, label)[0]


@contextmanager
def held(df: DataFrame, label: str = "held"):
    """A copy of ``df`` in the shared folder for the passes made inside the block; it is removed afterwards."""
    table, path = _written(df, label)
    try:
        yield table
    finally:
        folder = df.sparkSession.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def local(df: DataFrame) -> DataFrame:
    """Run ``df`` once and return it as a local table with a broadcast hint.

    For tables whose size is bounded by their construction, such as one row per column.
    """
    return F.broadcast(df.sparkSession.createDataFrame(df.toArrow(), df.schema))


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Repartition rows that are few but costly to work on.

    AQE joins small partitions by their bytes; a fixed number of partitions keeps such
    rows on all cores. It differs from the shuffle default, or Spark would take an
    earlier shuffle by the same keys for it and drop it.
    """
    spark = df.sparkSession
    count = 2 * spark.sparkContext.defaultParallelism
    if count == int(spark.conf.get("spark.sql.shuffle.partitions")):
        count += 1
    return df.repartition(count, *keys)
