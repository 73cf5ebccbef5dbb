"""Queries over the files of datasets: schemas of each, and what differs from the declared ones."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from salescope.plans.catalog import declared, described, expected_sql, query, r
from salescope.session import shared_folder
from salescope.sources import footers, readers, sinks
from salescope.sources.tables import SCHEMAS, table

TABLE = r"([^/]+)\.parquet"  # the table in a file's path

DECLARED_SQL = " UNION ALL ".join(f"SELECT '{t}' AS tbl, column_name, kind FROM (VALUES {expected_sql(t)}) e(column_name, kind)" for t in SCHEMAS)
OBSERVED_SQL = " UNION ALL ".join(f"SELECT '{t}' AS tbl, column_name, kind FROM ({described(t)})" for t in SCHEMAS)
CHANGES_SQL = f"""WITH e AS ({DECLARED_SQL}), o AS ({OBSERVED_SQL}),
  c AS (SELECT tbl, column_name, o.kind IS NULL AS missing, e.kind IS NULL AS unexpected, coalesce(o.kind <> e.kind, false) AS type_mismatch,
    e.kind AS expected_type, o.kind AS observed_type FROM e FULL JOIN o USING (tbl, column_name))"""


def schemas_of_all(spark, sf):
    """Footers of the declared tables' files, one row per file and column."""
    return footers.file_schemas(spark, sf).withColumn("tbl", F.regexp_extract("path", TABLE, 1)).where(F.col("tbl").isin(list(SCHEMAS)))


def declared_of_all(spark):
    rows = [(t, i, c, kind) for t in SCHEMAS for i, (c, kind) in enumerate(declared(t)[1].items())]
    return spark.createDataFrame(rows, "tbl string, position int, column_name string, type string")


@query("c05_schemas_of_files", f"SELECT tbl, column_name, kind AS type FROM ({OBSERVED_SQL})")
def schemas_of_files(spark, sf):
    """Every column of every file, as its footer has it."""
    return schemas_of_all(spark, sf).select("tbl", "column_name", "type")


@query("c05_changes_of_files", f"{CHANGES_SQL} SELECT *, false AS order_changed FROM c")
def changes_of_files(spark, sf):
    """Every file against the schema declared for its table."""
    return footers.file_changes(schemas_of_all(spark, sf), declared_of_all(spark), "tbl")


@query(
    "c06_alerts_of_files",
    f"""{CHANGES_SQL} SELECT tbl, count(*) FILTER (NOT unexpected) AS expected_columns, count(*) FILTER (NOT missing) AS observed_columns,
      coalesce(list(column_name ORDER BY column_name) FILTER (missing), []) AS missing_columns,
      coalesce(list(column_name ORDER BY column_name) FILTER (unexpected), []) AS unexpected_columns,
      coalesce(list(column_name ORDER BY column_name) FILTER (type_mismatch), []) AS type_mismatch_columns, false AS order_changed,
      bool_or(missing OR unexpected OR type_mismatch) AS alert FROM c GROUP BY tbl""",
)
def alerts_of_files(spark, sf):
    """An alert for each file that differs from the schema declared for its table."""
    return footers.file_alerts(changes_of_files(spark, sf), "tbl")


@query(
    "a05_glob_of_many_files",
    "SELECT o_orderstatus, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders WHERE o_orderstatus <> 'F' GROUP BY 1",
)
def glob_of_many_files(spark, sf):
    """The files of two folders of a dataset whose folders are named by status."""
    path = f"{shared_folder(spark)}/orders-{uuid.uuid4().hex}"
    sinks.write_partitioned(table(spark, sf, "orders"), path, ["o_orderstatus"])
    rows = readers.read_parquet(spark, f"{path}/o_orderstatus=[^F]*", glob="part-*.parquet", base=path)
    return rows.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"), r(F.sum("o_totalprice"), 2).alias("total"))
