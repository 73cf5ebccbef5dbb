"""Properties of the physical plans that matter at scale."""

import re

import pytest

from salescope.operators import grouped, profiling
from salescope.plans.registry import ENTRIES
from salescope.sources.tables import sales_view


def plan(df) -> str:
    return df._jdf.queryExecution().toString()


def final_plan(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_scan_reads_only_what_is_used(spark, small):
    text = plan(grouped.sales_by_productline(sales_view(spark, small)))
    reads = re.findall(r"ReadSchema: (struct<[^\n]*>)", text)
    lines = [r for r in reads if "l_partkey" in r]
    assert lines and all("l_tax" not in r and "l_discount" not in r for r in lines)


def test_lookups_without_use_are_not_joined(spark, small):
    text = plan(sales_view(spark, small, ["YEAR_ID", "SALES"]))
    assert "o_orderkey" in text and "part.parquet" not in text and "c_custkey" not in text


def test_filters_reach_the_scan(spark, small):
    text = plan(ENTRIES["a06_lazy_parquet_scan"].run(spark, small))
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThan\(l_discount", text)


def test_top_values_are_cut_before_the_shuffle(spark, small):
    text = plan(profiling.value_shares(sales_view(spark, small, ["COUNTRY"]), ["COUNTRY"], 3))
    assert "WindowGroupLimit" in text


def test_top_k_needs_no_global_sort(spark, small):
    assert "TakeOrderedAndProject" in plan(ENTRIES["g03_top_countries"].run(spark, small))


@pytest.mark.parametrize("name", ["g01_sales_by_productline", "g36_monthly_sales", "b05_coerce_numbers", "m02_split_counts"])
def test_no_python_and_no_cartesian_product(name, spark, small):
    text = plan(ENTRIES[name].run(spark, small))
    assert "Python" not in text and "Pandas" not in text and "CartesianProduct" not in text


def test_hot_key_is_split_in_the_join(spark, tmp_path):
    """A third of the lines belongs to one part: AQE splits that key's partition."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    folder = str(tmp_path)
    spark.range(0, 300_000, 1, 8).selectExpr(
        "id AS l_orderkey", "CASE WHEN id % 3 = 0 THEN 7 ELSE id % 1000 END AS l_partkey", "1D AS l_extendedprice",
        "md5(cast(id AS string)) AS l_comment", "1 AS l_linenumber", "1D AS l_quantity", "1L AS l_suppkey",
        "timestamp_ntz'2000-01-01' AS l_shipdate",
    ).write.parquet(f"{folder}/lineitem.parquet")
    spark.range(1000).selectExpr("id AS p_partkey", "concat('T', id % 3) AS p_type", "1D AS p_retailprice").write.parquet(
        f"{folder}/part.parquet"
    )
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        df = grouped.sales_by_productline(sales_view(spark, folder, ["PRODUCTLINE", "SALES"]))
        text = final_plan(df)
        total = sum(r["orders_count"] for r in df.collect())
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert "skew=true" in text
    assert total == 300_000
