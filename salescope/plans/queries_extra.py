"""Queries over the remaining joins, guards, orderings and scalar function kinds."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from salescope.functions.quantiles import column_quantiles
from salescope.operators import contracts, drift, profiling
from salescope.operators.contracts import SALES_SCHEMA
from salescope.plans.catalog import declared, described, expected_sql, query, r, rounded, with_raw, with_sales
from salescope.plans.queries_drift import FEATURES, LONG_SQL, halves
from salescope.sources.tables import cached, file_table, raw_sales, sales_view, table

FEATURES_SQL = ", ".join(SALES_SCHEMA.features)


@query("a16_cached_load", with_sales("SELECT YEAR_ID, count(*) AS n, round(max(SALES), 2) AS largest FROM sales GROUP BY YEAR_ID"))
def cached_load(spark, sf):
    rows = cached(sales_view(spark, sf, ["YEAR_ID", "SALES"]))
    return rows.groupBy("YEAR_ID").agg(F.count(F.lit(1)).alias("n"), r(F.max("SALES"), 2).alias("largest"))


@query("c01_required_columns", with_sales("SELECT ORDERNUMBER, SALES FROM sales"))
def required_columns(spark, sf):
    return contracts.require_columns(sales_view(spark, sf, ["ORDERNUMBER", "SALES"]), ["SALES"])


@query("c02_contract_rows", with_sales(f"SELECT {FEATURES_SQL}, SALES FROM sales"))
def contract_rows(spark, sf):
    """Columns of a contract whose validity and freedom from leakage were checked."""
    schema = SALES_SCHEMA.check()
    contracts.forbid_leakage(schema.features, schema.target)
    return contracts.in_contract_order(sales_view(spark, sf, [*schema.features, "SALES"]), schema)


@query(
    "c06_schema_alert",
    f"""WITH o AS ({described("orders")}), e AS (SELECT * FROM (VALUES {expected_sql("orders")}) t(column_name, kind))
    SELECT 'sales' AS project_name, (SELECT count(*) FROM e) AS expected_feature_count, (SELECT count(*) FROM o) AS observed_feature_count,
      coalesce((SELECT list_sort(list(column_name)) FROM e ANTI JOIN o USING (column_name)), []) AS missing_features,
      coalesce((SELECT list_sort(list(column_name)) FROM o ANTI JOIN e USING (column_name)), []) AS unexpected_features,
      coalesce((SELECT list_sort(list(column_name)) FROM e JOIN o USING (column_name) WHERE e.kind <> o.kind), []) AS dtype_mismatches,
      false AS order_changed, EXISTS (FROM e FULL JOIN o USING (column_name) WHERE e.kind IS DISTINCT FROM o.kind) AS alert""",
)
def schema_alert(spark, sf):
    """Alert over the schema of the files of ``orders`` against the declared one."""
    changes = contracts.schema_changes(file_table(spark, sf, "orders"), *declared("orders"))
    return contracts.schema_alert(changes, "sales").drop("generated_at")


@query("c07_scoring_input", with_sales(f"SELECT {FEATURES_SQL} FROM sales"))
def scoring_input(spark, sf):
    return contracts.scoring_input(sales_view(spark, sf, ["STATUS", *reversed(SALES_SCHEMA.features)]), SALES_SCHEMA)[0]


@query(
    "t09_column_name_differences",
    f"""SELECT column_name, s.kind IS NULL AS missing, c.kind IS NULL AS unexpected
    FROM ({described("conversations")}) c FULL JOIN ({described("documents")}) s USING (column_name) WHERE s.kind IS NULL OR c.kind IS NULL""",
)
def name_differences(spark, sf):
    """Columns that the files of only one of two tables have."""
    current, other = file_table(spark, sf, "documents"), file_table(spark, sf, "conversations")
    return contracts.schema_changes(current, other.columns).where("missing OR unexpected").select(
        "column_name", "missing", "unexpected"
    )


@query(
    "j03_scalar_broadcast",
    with_raw(
        """SELECT ORDERNUMBER, ORDERLINENUMBER, round(MSRP - (SELECT quantile_cont(MSRP, 0.5) FROM raw), 4) AS from_median FROM raw"""
    ),
)
def scalar_broadcast(spark, sf):
    raw = raw_sales(spark, sf, ["ORDERNUMBER", "ORDERLINENUMBER", "MSRP"])
    median = column_quantiles(raw, ["MSRP"], [0.5])["MSRP"][0]
    return raw.select("ORDERNUMBER", "ORDERLINENUMBER", r(F.col("MSRP") - F.lit(median), 4).alias("from_median"))


@query(
    "j05_profile_pairing",
    with_raw(
        """, l AS (SELECT STATE AS "value", count(*) AS n FROM raw WHERE ORDERNUMBER % 3 = 0 AND STATE IS NOT NULL GROUP BY 1),
           c AS (SELECT STATE AS "value", count(*) AS n FROM raw WHERE ORDERNUMBER % 3 > 0 AND STATE IS NOT NULL GROUP BY 1)
        SELECT coalesce(l."value", c."value") AS "value", l.n AS reference_rows, c.n AS current_rows
        FROM l FULL JOIN c ON l."value" = c."value" """
    ),
)
def profile_pairing(spark, sf):
    raw = raw_sales(spark, sf, ["ORDERNUMBER", "STATE"])
    left = profiling.value_shares(raw.where("ORDERNUMBER % 3 = 0"), ["STATE"])
    right = profiling.value_shares(raw.where("ORDERNUMBER % 3 > 0"), ["STATE"])
    return left.select("value", F.col("rows").alias("reference_rows")).join(
        right.select("value", F.col("rows").alias("current_rows")), "value", "full"
    )


@query(
    "t07_union_of_supports",
    with_sales(LONG_SQL + """ SELECT feature, count(DISTINCT v) AS support, count(*) AS n FROM long GROUP BY feature"""),
)
def union_of_supports(spark, sf):
    reference, current = halves(spark, sf, FEATURES)
    both = drift.two_samples(reference, current, FEATURES).unpivot(["is_current"], FEATURES, "feature", "value")
    counts = both.where("value IS NOT NULL").groupBy("feature", "value").agg(F.count(F.lit(1)).alias("rows"))
    return counts.groupBy("feature").agg(F.count(F.lit(1)).alias("support"), F.sum("rows").alias("n"))


@query(
    "w06_rank_by_share",
    with_raw(
        """SELECT 'STATE' AS feature, STATE AS "value", count(*) AS "rows", round(count(*) / (SELECT count(STATE) FROM raw), 8) AS ratio,
           CAST(row_number() OVER (ORDER BY count(*) DESC, STATE) AS INT) AS "rank"
           FROM raw WHERE STATE IS NOT NULL GROUP BY STATE QUALIFY "rank" <= 3"""
    ),
)
def rank_by_share(spark, sf):
    return rounded(profiling.value_shares(raw_sales(spark, sf, ["STATE"]), ["STATE"], 3), ratio=8)


@query(
    "f05_text_functions",
    """SELECT c_custkey, CASE WHEN starts_with(c_name, 'Customer#') THEN substr(c_name, 10) END AS stripped,
       split_part(c_name, '#', 1) AS base, concat_ws(', ', c_name, c_mktsegment) AS joined,
       'segment=' || c_mktsegment AS pair FROM customer""",
)
def text_functions(spark, sf):
    name = F.col("c_name")
    return table(spark, sf, "customer").select(
        "c_custkey",
        F.when(F.startswith(name, F.lit("Customer#")), F.regexp_replace(name, "^Customer#", "")).alias("stripped"),
        F.split_part(name, F.lit("#"), F.lit(1)).alias("base"),
        F.concat_ws(", ", "c_name", "c_mktsegment").alias("joined"),
        F.format_string("segment=%s", "c_mktsegment").alias("pair"),
    )


@query(
    "f06_array_functions",
    """SELECT p_partkey, list_sum(list_transform(range(0, 11), lambda i: i / 10.0 * p_size)) AS grid_sum,
       len(list_transform(range(0, p_size), lambda i: p_retailprice)) AS repeated,
       list_sort([p_size, p_partkey % 7, 25])[2] AS middle FROM part""",
)
def array_functions(spark, sf):
    return table(spark, sf, "part").select(
        "p_partkey",
        F.expr("aggregate(transform(sequence(0, 10), i -> i / 10.0D * p_size), 0D, (a, b) -> a + b)").alias("grid_sum"),
        F.size(F.array_repeat("p_retailprice", F.col("p_size"))).cast("long").alias("repeated"),
        F.get(F.array_sort(F.array(F.col("p_size").cast("long"), F.col("p_partkey") % 7, F.lit(25).cast("long"))), F.lit(1)).alias(
            "middle"
        ),
    )


@query(
    "f07_json_functions",
    """SELECT event_id, CAST(props->>'k' AS BIGINT) AS k, event_type = 'error' AS is_error FROM events""",
)
def json_functions(spark, sf):
    parsed = F.from_json("props", T.StructType.fromDDL("k long"))
    return table(spark, sf, "events").select("event_id", parsed["k"].alias("k"), (F.col("event_type") == "error").alias("is_error"))
