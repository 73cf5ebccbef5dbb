"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from salescope.session import shared_folder


class Scratch:
    """Tables written to the shared folder and scanned again, so that lost executors lose no lineage.

    ``drop`` removes those that no later step reads.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.root = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
        self.count = 0
        self.paths: dict[int, str] = {}

    def keep(self, df: DataFrame, **options: str) -> DataFrame:
        self.count += 1
        path = f"{self.root}/{self.count}"
        df.write.options(**options).parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(out)] = path
        return out

    def drop(self, *tables: DataFrame) -> None:
        jvm = self.spark.sparkContext._jvm
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        for table in tables:
            path = jvm.org.apache.hadoop.fs.Path(self.paths.pop(id(table)))
            path.getFileSystem(conf).delete(path, True)


def tasks(spark: SparkSession) -> int:
    """Shuffle partitions that the session asks for: its user sets them to the size of the data."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
