"""Guards, gate, schema changes, readers and sinks."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salescope.operators import cleaning, contracts
from salescope.operators.contracts import ContractError, FeatureSchema
from salescope.sources import readers, sinks, tables

SCHEMA = FeatureSchema(("x1", "x2"), ("cat",), "target")


def test_schema_validity():
    SCHEMA.check()
    for bad in (FeatureSchema((), (), "t"), FeatureSchema(("a", "a"), (), "t"), FeatureSchema(("t",), (), "t")):
        with pytest.raises(ContractError):
            bad.check()
    with pytest.raises(ContractError):
        contracts.forbid_leakage(["a", "t"], "t")
    assert [f.name for f in SCHEMA.struct()] == ["x1", "x2", "cat", "target"]


def test_gate(spark):
    good = spark.createDataFrame([("1", 2, "a", 3.0), ("2.5", 4, "b", 6.0)], "x1 string, x2 int, cat string, target double")
    out = contracts.gate(good, SCHEMA, fail_fast=True)
    assert out.valid.count() == 2 and dict(out.valid.dtypes)["x1"] == "double"
    with pytest.raises(ContractError):
        contracts.gate(good.drop("x2"), SCHEMA)
    bad = good.withColumn("x1", F.lit("invalid")).withColumn("cat", F.when(F.col("cat") == "a", F.col("cat")))
    with pytest.raises(ContractError) as err:
        contracts.gate(bad, SCHEMA, fail_fast=True, context="train")
    assert "x1" in str(err.value) and "cat" in str(err.value) and "train" in str(err.value)
    assert contracts.gate(bad, SCHEMA).rejects.count() == 2
    with pytest.raises(ContractError):
        contracts.gate(good.withColumn("extra", F.lit(1)), SCHEMA)
    assert "extra" in contracts.gate(good.withColumn("extra", F.lit(1)), SCHEMA, allow_extra=True).valid.columns


def test_gate_splits_every_row_once(spark):
    rows = [(str(i) if i % 3 else "bad", i, None if i % 5 == 0 else "c", float(i)) for i in range(50)]
    df = spark.createDataFrame(rows, "x1 string, x2 int, cat string, target double")
    out = contracts.gate(df, SCHEMA)
    assert out.valid.count() + out.rejects.count() == 50


def test_schema_changes_fixture(spark):
    current = spark.createDataFrame([(1, "a")], "x1 long, x3 string")
    changes = contracts.schema_changes(current, ["x1", "x2"], {"x1": "double", "x2": "bigint"})
    alert = contracts.schema_alert(changes, "p").first()
    assert alert["missing_features"] == ["x2"] and alert["unexpected_features"] == ["x3"]
    assert alert["dtype_mismatches"] == ["x1"] and not alert["order_changed"] and alert["alert"]
    same = contracts.schema_alert(contracts.schema_changes(current, ["x1", "x3"]), "p").first()
    assert not same["alert"]
    turned = contracts.schema_alert(contracts.schema_changes(current, ["x3", "x1"]), "p").first()
    assert turned["order_changed"] and turned["alert"]


def test_scoring_input(spark):
    df = spark.createDataFrame([("a", 1.0, 2.0, 9)], "cat string, x2 double, x1 double, other int")
    out, ignored = contracts.scoring_input(df, SCHEMA)
    assert out.columns == ["x1", "x2", "cat"] and ignored == ["other"]
    with pytest.raises(ContractError):
        contracts.scoring_input(df.drop("x1"), SCHEMA)


def test_derive_target_fixture(spark):
    df = spark.createDataFrame([(2, 10.0), (3, 20.0)], "QUANTITYORDERED int, PRICEEACH double")
    assert [r["SALES"] for r in cleaning.derive_target(df).orderBy("SALES").collect()] == [20.0, 60.0]
    kept = df.withColumn("SALES", F.lit(1.0))
    assert cleaning.derive_target(kept).select("SALES").distinct().first()[0] == 1.0


def test_prepare(spark):
    rows = [("1", "10", "a", None), ("x", "20", None, "7"), ("3", None, "b", "9")]
    df = spark.createDataFrame(rows, "x1 string, x2 string, cat string, target string")
    got = cleaning.prepare(df, SCHEMA).orderBy("x1", "x2").collect()
    assert sorted(r["x1"] for r in got) == [1.0, 2.0, 3.0]
    assert sorted(r["target"] for r in got) == [7.0, 8.0, 9.0]
    assert sorted(r["cat"] for r in got) == ["Unknown", "a", "b"]


def test_strict_matrix_raises(spark):
    df = spark.createDataFrame([("no", 1.0, "a", 2.0)], "x1 string, x2 double, cat string, target double")
    with pytest.raises(Exception):
        contracts.strict_matrix(df, SCHEMA).collect()


def test_finite_only_requires_values(spark):
    df = spark.createDataFrame([(float("nan"),), (float("inf"),)], "x double")
    with pytest.raises(ValueError):
        cleaning.finite_only(df, "x", require=True)


def test_readers(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_bytes("name,day\ncaf\xe9,2003-02-24\nplain,2003-02-25\n".encode("latin-1"))
    latin = readers.read_latin1_csv(spark, str(path), "name string, day string")
    assert latin.orderBy("name").first()["name"] == "caf\xe9"
    lossy = readers.read_csv(spark, str(path), "name string, day string")
    assert readers.replaced_text_report(lossy).where("column_name = 'name'").first()["replaced_rows"] == 1
    assert dict(readers.read_csv(spark, str(path), infer_dates=True).dtypes)["day"] == "date"
    with pytest.raises(Exception):
        readers.read_csv(spark, str(tmp_path / "absent.csv"), "a string").count()


def test_json_records(spark, tmp_path):
    schema = T.StructType.fromDDL("x1 double, cat string")
    path = tmp_path / "r.json"
    path.write_text('{"x1": 1.5, "cat": "a"}\n{"x1": "oops", "cat": "b"}\n')
    kept = readers.read_feature_records(spark, str(path), schema, fail_fast=False)
    assert sum(r["_corrupt_record"] is not None for r in kept.collect()) == 1
    with pytest.raises(Exception):
        readers.feature_records(spark, schema, json_path=str(path)).collect()
    assert readers.feature_records(spark, schema, json_text=['{"x1": 2, "cat": "c"}']).first()["x1"] == 2.0
    for kwargs in ({}, {"json_text": ["{}"], "json_path": "p"}):
        with pytest.raises(ValueError):
            readers.feature_records(spark, schema, **kwargs)


def test_partition_overwrite_keeps_other_keys(spark, tmp_path):
    path = str(tmp_path / "t")
    first = spark.createDataFrame([(1, 2003), (2, 2004)], "v int, YEAR int")
    sinks.write_partitioned(first, path, ["YEAR"])
    sinks.write_partitioned(spark.createDataFrame([(9, 2004)], "v int, YEAR int"), path, ["YEAR"])
    assert sorted((r["v"], r["YEAR"]) for r in spark.read.parquet(path).collect()) == [(1, 2003), (9, 2004)]


def test_hot_partition_key_is_split(spark, tmp_path):
    """A key above the advisory size is written by several tasks."""
    path = str(tmp_path / "hot")
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(size)
    spark.conf.set(size, "64KB")
    try:
        sinks.write_partitioned(spark.range(0, 200_000, 1, 8).selectExpr("xxhash64(id) AS v", "2003 AS YEAR"), path, ["YEAR"])
    finally:
        spark.conf.set(size, before)
    files = spark.read.parquet(path).select(F.input_file_name().alias("f")).distinct().count()
    assert files > 1 and spark.read.parquet(path).count() == 200_000


def test_report_sink_has_no_infinities(spark, tmp_path):
    path = str(tmp_path / "rep")
    df = spark.createDataFrame([(1.0,), (float("nan"),), (float("inf"),)], "v double")
    sinks.write_report(df, path, "p")
    back = spark.read.json(path)
    assert back.where("v IS NOT NULL").count() == 1 and back.first()["project_name"] == "p"


def test_absent_or_mistyped_file_columns_raise(spark, small, tmp_path):
    lines = spark.read.parquet(f"{small}/lineitem.parquet")
    assert tables.table(spark, small, "lineitem").count() == lines.count()
    lines.withColumnRenamed("l_quantity", "l_amount").write.parquet(str(tmp_path / "renamed" / "lineitem.parquet"))
    with pytest.raises(tables.SchemaError, match="l_quantity"):
        tables.table(spark, str(tmp_path / "renamed"), "lineitem")
    lines.withColumn("l_quantity", F.col("l_quantity").cast("string")).write.parquet(str(tmp_path / "typed" / "lineitem.parquet"))
    with pytest.raises(tables.SchemaError, match="l_quantity"):
        tables.table(spark, str(tmp_path / "typed"), "lineitem")
    lines.withColumn("l_linenumber", F.col("l_linenumber").cast("short")).write.parquet(str(tmp_path / "narrow" / "lineitem.parquet"))
    assert tables.table(spark, str(tmp_path / "narrow"), "lineitem").schema == tables.table(spark, small, "lineitem").schema


def test_changed_order_needs_two_shared_columns_swapped(spark):
    df = spark.createDataFrame([(1, 2, 3)], "b int, z int, a int")
    changed = lambda names: {r.order_changed for r in contracts.schema_changes(df, names).collect()}
    assert changed(["b", "a"]) == {False} and changed(["a", "b"]) == {True} and changed(["q"]) == {False}
