"""Schemas of the files of a dataset, some of which differ."""

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from salescope.sources import footers

GOOD = {"x1": pa.array([1.0]), "x2": pa.array([1], pa.int64()), "cat": pa.array(["a"])}


@pytest.fixture
def dataset(tmp_path):
    files = {f"good{i}": GOOD for i in range(40)}
    files["lacks"] = {k: GOOD[k] for k in ("x1", "cat")}
    files["adds"] = {**GOOD, "more": pa.array([True])}
    files["retypes"] = {**GOOD, "x2": pa.array(["1"])}
    files["moves"] = {k: GOOD[k] for k in ("x2", "x1", "cat")}
    files["inside/deep"] = {k: GOOD[k] for k in ("cat", "x1")}
    for name, columns in files.items():
        (tmp_path / name).parent.mkdir(exist_ok=True)
        pq.write_table(pa.table(columns), tmp_path / f"{name}.parquet")
    (tmp_path / "broken.parquet").write_bytes(b"no parquet")
    (tmp_path / "other.txt").write_text("not asked for")
    return tmp_path


def named(rows):
    return {r["path"].rsplit("/", 1)[1].removesuffix(".parquet"): r for r in rows}


def test_alerts_name_the_files(spark, dataset):
    files = footers.file_schemas(spark, str(dataset), files_per_task=7)
    assert files.rdd.getNumPartitions() > 1
    expected = spark.createDataFrame([(0, "x1", "double"), (1, "x2", "bigint"), (2, "cat", "string")], "position int, column_name string, type string")
    got = named(footers.file_alerts(footers.file_changes(files, expected)).collect())
    assert len(got) == 46
    odd = {k: (r.missing_columns, r.unexpected_columns, r.type_mismatch_columns, r.order_changed) for k, r in got.items() if r.alert}
    assert odd == {
        "lacks": (["x2"], [], [], False),
        "adds": ([], ["more"], [], False),
        "retypes": ([], [], ["x2"], False),
        "moves": ([], [], [], True),
        "deep": (["x2"], [], [], True),
        "broken": (["cat", "x1", "x2"], [], [], False),
    }
    assert got["good0"].expected_columns == got["good0"].observed_columns == 3
    errors = files.where("error IS NOT NULL").collect()
    assert len(errors) == 1 and errors[0].path.endswith("broken.parquet")


def test_expectations_by_dataset(spark, dataset):
    from pyspark.sql import functions as F

    files = footers.file_schemas(spark, str(dataset)).withColumn("tbl", F.regexp_extract("path", r"([^/]+)\.parquet", 1))
    expected = spark.createDataFrame([("lacks", 0, "x1", "double"), ("lacks", 1, "cat", "string"), ("adds", 0, "x1", "double")], "tbl string, position int, column_name string, type string")
    got = {r.tbl: r for r in footers.file_alerts(footers.file_changes(files, expected, "tbl"), "tbl").collect()}
    assert set(got) == {"lacks", "adds"} and not got["lacks"].alert
    assert got["adds"].unexpected_columns == ["cat", "more", "x2"]


def test_types_have_sparks_names():
    names = {pa.timestamp("us"): "timestamp_ntz", pa.timestamp("us", "UTC"): "timestamp", pa.list_(pa.float32()): "array<float>", pa.int32(): "int", pa.date32(): "date"}
    assert {k: footers.type_name(k) for k in names} == names
