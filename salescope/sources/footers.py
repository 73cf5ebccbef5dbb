"""Schemas of every file of a Parquet dataset, from the files' footers.

Spark takes a dataset's schema from one footer, or merges all of them, which hides the file that differs.  Here the
listing is a table, and each task opens the footers of its files; no data page is read and nothing is collected.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import BinaryIO
from urllib.parse import unquote, urlparse

import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_type

SCHEMA = "path string, position int, column_name string, type string, error string"
FILES_PER_TASK = 256


def open_uri(uri: str) -> BinaryIO:
    """A file by its URI, through Arrow's file systems (local, hdfs, s3, gs)."""
    parts = urlparse(uri)
    if parts.scheme in ("", "file"):
        return open(unquote(parts.path), "rb")
    from pyarrow.fs import FileSystem

    system, path = FileSystem.from_uri(uri)
    return system.open_input_file(path)


def type_name(kind: pa.DataType) -> str:
    """Spark's name of a column's type; Arrow's where Spark has none."""
    try:
        return from_arrow_type(kind, prefer_timestamp_ntz=True).simpleString()
    except Exception:  # a type that Spark doesn't know
        return str(kind)


def file_schemas(
    spark: SparkSession, path: str, glob: str = "*.parquet", open_file: Callable[[str], BinaryIO] = open_uri, files_per_task: int = FILES_PER_TASK
) -> DataFrame:
    """One row per file and column: ``path, position, column_name, type``.

    A file that can't be read as Parquet has one row, whose ``error`` says why.
    """
    listing = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true").load(path)
    # The name alone is asked for, so no content is read.  The number of tasks follows the number of files.
    names = listing.select("path")
    tasks = max(1, -(-len(names.inputFiles()) // files_per_task))

    def footers(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for uri in pdf["path"]:
                try:
                    with open_file(uri) as f:
                        fields = pq.read_schema(f)
                    rows += [(uri, i, x.name, type_name(x.type), None) for i, x in enumerate(fields)]
                except (OSError, pa.ArrowException) as e:
                    rows.append((uri, None, None, None, str(e)[:200]))
            yield pd.DataFrame(rows, columns=["path", "position", "column_name", "type", "error"]).astype({"position": "Int32"})

    return names.repartition(tasks, "path").mapInPandas(footers, SCHEMA)


def _find(array, name):
    """The entry of that name, or NULL."""
    return F.get(F.filter(array, lambda x: x["column_name"] == name), F.lit(0))


def file_changes(files: DataFrame, expected: DataFrame, by: str = "path") -> DataFrame:
    """One row per file and column, expected or observed: missing, unexpected, type and order.

    ``expected`` has ``position, column_name, type``, and ``by`` if each file has expectations of its own; then
    files nobody expects are left out.  Both sides are one row per file before they meet.  An unreadable file lacks all its columns.
    """
    entry = F.when(F.col("column_name").isNotNull(), F.struct("position", "column_name", "type"))
    have = files.groupBy(by).agg(F.array_sort(F.collect_list(entry)).alias("have"))
    if by in expected.columns:
        want = expected.groupBy(by).agg(F.array_sort(F.collect_list(entry)).alias("want"))
        both = have.join(want, by)
    else:
        rows = sorted((r["position"], r["column_name"], r["type"]) for r in expected.select("position", "column_name", "type").collect())  # a declared schema
        want = F.array(*[F.struct(F.lit(p).alias("position"), F.lit(c).alias("column_name"), F.lit(t).cast("string").alias("type")) for p, c, t in rows])
        both = have.withColumn("want", want)
    shared = F.filter("want", lambda w: _find(F.col("have"), w["column_name"]).isNotNull())
    places = F.transform(shared, lambda w: _find(F.col("have"), w["column_name"])["position"])
    both = both.withColumn("order_changed", places != F.array_sort(places))
    expected_rows = F.transform(
        "want",
        lambda w: F.struct(
            w["column_name"].alias("column_name"), w["type"].alias("expected_type"), _find(F.col("have"), w["column_name"])["type"].alias("observed_type"), F.lit(False).alias("unexpected")
        ),
    )
    extra = F.filter("have", lambda h: _find(F.col("want"), h["column_name"]).isNull())
    extra_rows = F.transform(
        extra,
        lambda h: F.struct(h["column_name"].alias("column_name"), F.lit(None).cast("string").alias("expected_type"), h["type"].alias("observed_type"), F.lit(True).alias("unexpected")),
    )
    rows = both.select(by, "order_changed", F.inline(F.concat(expected_rows, extra_rows)))
    return rows.select(
        by, "column_name", (~F.col("unexpected") & F.col("observed_type").isNull()).alias("missing"), "unexpected",
        F.coalesce(F.col("expected_type") != F.col("observed_type"), F.lit(False)).alias("type_mismatch"), "expected_type", "observed_type", "order_changed",
    )


def file_alerts(changes: DataFrame, by: str = "path") -> DataFrame:
    """One row per file: what is missing, unexpected, retyped or moved, and whether that is an alert."""
    names = lambda flag: F.array_sort(F.collect_list(F.when(F.col(flag), F.col("column_name")))).alias(f"{flag}_columns")
    out = changes.groupBy(by).agg(
        F.count_if(~F.col("unexpected")).alias("expected_columns"), F.count_if(~F.col("missing")).alias("observed_columns"),
        names("missing"), names("unexpected"), names("type_mismatch"), F.bool_or("order_changed").alias("order_changed"),
    )
    odd = [F.size(f"{flag}_columns") > 0 for flag in ("missing", "unexpected", "type_mismatch")]
    return out.withColumn("alert", odd[0] | odd[1] | odd[2] | F.col("order_changed"))
