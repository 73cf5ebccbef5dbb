"""Queries over filters, cleaning, feature preparation and contracts."""

from __future__ import annotations

from pyspark.sql import functions as F

from salescope.functions.hashing import hash_bucket, row_text
from salescope.functions.scalar import safe_ratio
from salescope.operators import cleaning, contracts
from salescope.operators.contracts import SALES_SCHEMA, FeatureSchema
from salescope.plans.catalog import declared, described, expected_sql, query, r, rounded, with_raw, with_sales
from salescope.plans.queries_grouped import ROW_KEY, ROW_KEY_SQL
from salescope.sources.tables import file_table, raw_sales, sales_view, table

KEY = ["ORDERNUMBER", "ORDERLINENUMBER"]


@query("b01_drop_columns", with_raw("SELECT ORDERNUMBER, ORDERLINENUMBER, STATE FROM raw"))
def drop_columns(spark, sf):
    raw = raw_sales(spark, sf, [*KEY, "STATE", "ADDRESSLINE2"])
    return cleaning.drop_columns(raw, ["ADDRESSLINE2", "NOT_THERE"])


@query(
    "b02_fill_unknown",
    with_raw(
        """SELECT ORDERNUMBER, ORDERLINENUMBER, coalesce(STATE, 'Unknown') AS STATE,
           coalesce(TERRITORY, 'Unknown') AS TERRITORY FROM raw"""
    ),
)
def fill_unknown(spark, sf):
    return cleaning.fill_unknown(raw_sales(spark, sf, [*KEY, "STATE", "TERRITORY"]), ["STATE", "TERRITORY", "NOT_THERE"])


@query(
    "b03_postal_code_text",
    with_raw(
        """SELECT ORDERNUMBER, ORDERLINENUMBER, coalesce(CAST(POSTALCODE AS VARCHAR), 'Unknown') AS POSTALCODE FROM raw"""
    ),
)
def postal_code(spark, sf):
    return cleaning.postal_code_text(raw_sales(spark, sf, [*KEY, "POSTALCODE"]))


@query(
    "b04_derive_target",
    with_raw(
        """SELECT ORDERNUMBER, ORDERLINENUMBER, QUANTITYORDERED, PRICEEACH, QUANTITYORDERED * PRICEEACH AS SALES FROM raw"""
    ),
)
def derive_target(spark, sf):
    return cleaning.derive_target(raw_sales(spark, sf, [*KEY, "QUANTITYORDERED", "PRICEEACH"]))


@query(
    "b05_coerce_numbers",
    with_raw(
        "SELECT ORDERNUMBER, ORDERLINENUMBER, TRY_CAST(QUANTITY_TEXT AS DOUBLE) AS QUANTITY_TEXT FROM raw"
    ),
)
def coerce_numbers(spark, sf):
    return cleaning.coerce_numbers(raw_sales(spark, sf, [*KEY, "QUANTITY_TEXT"]), ["QUANTITY_TEXT"])


@query(
    "b06_impute_median",
    with_raw(
        """SELECT ORDERNUMBER, ORDERLINENUMBER,
           coalesce(QUANTITYORDERED, (SELECT quantile_cont(QUANTITYORDERED, 0.5) FROM raw)) AS QUANTITYORDERED,
           coalesce(MSRP, (SELECT quantile_cont(MSRP, 0.5) FROM raw)) AS MSRP,
           coalesce(SALES, (SELECT quantile_cont(SALES, 0.5) FROM raw)) AS SALES FROM raw"""
    ),
)
def impute_median(spark, sf):
    numbers = ["QUANTITYORDERED", "MSRP", "SALES"]
    return cleaning.impute_median(raw_sales(spark, sf, [*KEY, *numbers]), numbers)


@query(
    "b07_categories_as_text",
    with_raw(
        """SELECT ORDERNUMBER, ORDERLINENUMBER, coalesce(PRODUCTLINE, 'Unknown') AS PRODUCTLINE,
           coalesce(CAST(POSTALCODE AS VARCHAR), 'Unknown') AS POSTALCODE FROM raw"""
    ),
)
def categories_as_text(spark, sf):
    raw = raw_sales(spark, sf, [*KEY, "PRODUCTLINE", "POSTALCODE"])
    return cleaning.categories_as_text(raw, ["PRODUCTLINE", "POSTALCODE"])


@query("b08_drop_missing_target", with_raw("SELECT ORDERNUMBER, ORDERLINENUMBER, SALES FROM raw WHERE SALES IS NOT NULL"))
def drop_missing_target(spark, sf):
    return cleaning.drop_missing_target(raw_sales(spark, sf, [*KEY, "SALES"]), "SALES")


@query(
    "b09_keep_segment",
    with_sales(
        """SELECT ORDERNUMBER, ORDERLINENUMBER, SALES, PRODUCTLINE, COUNTRY FROM sales
           WHERE PRODUCTLINE = 'ECONOMY' AND COUNTRY = 'NATION_3'"""
    ),
)
def keep_segment(spark, sf):
    view = sales_view(spark, sf, [*KEY, "SALES", "PRODUCTLINE", "COUNTRY"])
    return cleaning.keep_segment(view, PRODUCTLINE="ECONOMY", COUNTRY="NATION_3", NOT_THERE="x")


@query(
    "b10_optional_filter",
    with_sales(
        """SELECT YEAR_ID, count(*) AS n, round(sum(SALES), 2) AS total_sales FROM sales
           WHERE PRODUCTLINE = 'SMALL' GROUP BY YEAR_ID"""
    ),
)
def optional_filter(spark, sf):
    view = sales_view(spark, sf, ["YEAR_ID", "SALES", "PRODUCTLINE", "COUNTRY"])
    kept = cleaning.keep_segment(view, PRODUCTLINE="SMALL", COUNTRY="(all)")
    return kept.groupBy("YEAR_ID").agg(F.count(F.lit(1)).alias("n"), r(F.sum("SALES"), 2).alias("total_sales"))


@query(
    "b11_first_and_last_year",
    with_sales(
        """SELECT CASE WHEN YEAR_ID = (SELECT min(YEAR_ID) FROM sales) THEN 'reference' ELSE 'current' END AS sample,
           YEAR_ID, count(*) AS n, round(sum(SALES), 2) AS total_sales FROM sales
           WHERE YEAR_ID IN ((SELECT min(YEAR_ID) FROM sales), (SELECT max(YEAR_ID) FROM sales)) GROUP BY ALL"""
    ),
)
def first_and_last_year(spark, sf):
    picked = cleaning.first_and_last_period(sales_view(spark, sf, ["YEAR_ID", "SALES"]), "YEAR_ID")
    return picked.groupBy("sample", "YEAR_ID").agg(F.count(F.lit(1)).alias("n"), r(F.sum("SALES"), 2).alias("total_sales"))


@query(
    "w07_halves",
    """WITH keyed AS (SELECT *, row_number() OVER (ORDER BY event_id) AS rn, count(*) OVER () AS n FROM events)
       SELECT CASE WHEN rn <= n // 2 THEN 'reference' ELSE 'current' END AS sample, count(*) AS n,
       round(sum(value), 2) AS total FROM keyed GROUP BY ALL""",
)
def halves(spark, sf):
    parts = cleaning.halves(table(spark, sf, "events"), "event_id")
    return parts.groupBy("sample").agg(F.count(F.lit(1)).alias("n"), r(F.sum("value"), 2).alias("total"))


BOUNDS_SQL = """b AS (SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3 FROM raw)"""


@query(
    "b12_iqr_bounds",
    with_raw(
        """SELECT 'QUANTITYORDERED' AS column_name, round(q1, 4) AS q1, round(q3, 4) AS q3, round(q3 - q1, 4) AS iqr,
             round(q1 - 1.5 * (q3 - q1), 4) AS lower_bound, round(q3 + 1.5 * (q3 - q1), 4) AS upper_bound
           FROM (SELECT quantile_cont(QUANTITYORDERED, 0.25) AS q1, quantile_cont(QUANTITYORDERED, 0.75) AS q3 FROM raw)
           UNION ALL
           SELECT 'SALES', round(q1, 4), round(q3, 4), round(q3 - q1, 4), round(q1 - 1.5 * (q3 - q1), 4),
             round(q3 + 1.5 * (q3 - q1), 4)
           FROM (SELECT quantile_cont(SALES, 0.25) AS q1, quantile_cont(SALES, 0.75) AS q3 FROM raw)"""
    ),
)
def iqr_bounds(spark, sf):
    out = cleaning.iqr_bounds(raw_sales(spark, sf, ["QUANTITYORDERED", "SALES"]), ["QUANTITYORDERED", "SALES"])
    return rounded(out, q1=4, q3=4, iqr=4, lower_bound=4, upper_bound=4)


@query(
    "b12_flag_outliers",
    with_raw(
        """SELECT ORDERNUMBER, ORDERLINENUMBER, SALES,
             coalesce(SALES < q1 - 0.5 * (q3 - q1) OR SALES > q3 + 0.5 * (q3 - q1), false) AS "SALES_OUTLIER"
           FROM raw, (SELECT quantile_cont(SALES, 0.25) AS q1, quantile_cont(SALES, 0.75) AS q3 FROM raw)"""
    ),
)
def flag_outliers(spark, sf):
    return cleaning.flag_outliers(raw_sales(spark, sf, [*KEY, "SALES"]), "SALES", 0.5)


def _sequential_sql(columns: list[str], factor: float, tail: str, source: str = "raw") -> str:
    """Nested steps: bounds of each column on what the earlier ones left."""
    steps, prev = [], source
    for i, c in enumerate(columns):
        steps.append(
            f"b{i} AS (SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3 FROM {prev})"
        )
        steps.append(
            f"""k{i} AS (SELECT {prev}.* FROM {prev}, b{i} WHERE NOT coalesce({c} < q1 - {factor} * (q3 - q1)
                OR {c} > q3 + {factor} * (q3 - q1), false))"""
        )
        prev = f"k{i}"
    return ", " + ", ".join(steps) + "\n" + tail.format(last=prev)


REMOVAL = ["QUANTITYORDERED", "PRICEEACH", "SALES", "MSRP"]


@query(
    "b13_remove_outliers",
    with_raw(
        _sequential_sql(REMOVAL, 0.2, "SELECT ORDERNUMBER, ORDERLINENUMBER, QUANTITYORDERED, PRICEEACH, SALES, MSRP FROM {last}")
    ),
)
def remove_outliers(spark, sf):
    return cleaning.remove_outliers(raw_sales(spark, sf, [*KEY, *REMOVAL]), REMOVAL, 0.2).kept


@query(
    "b13_removal_report",
    with_raw(
        _sequential_sql(
            REMOVAL,
            1.5,
            " UNION ALL ".join(
                f"""SELECT {i} AS step, '{c}' AS column_name, round(q1, 4) AS q1, round(q3, 4) AS q3,
                round(q3 - q1, 4) AS iqr, round(q1 - 1.5 * (q3 - q1), 4) AS lower_bound,
                round(q3 + 1.5 * (q3 - q1), 4) AS upper_bound,
                (SELECT count(*) FROM {'raw' if i == 0 else f'k{i - 1}'}) AS rows_before,
                (SELECT count(*) FROM k{i}) AS rows_after,
                (SELECT count(*) FROM {'raw' if i == 0 else f'k{i - 1}'}) - (SELECT count(*) FROM k{i}) AS outliers
                FROM b{i}"""
                for i, c in enumerate(REMOVAL)
            ),
        )
    ),
)
def removal_report(spark, sf):
    out = cleaning.remove_outliers(raw_sales(spark, sf, REMOVAL), REMOVAL, 1.5).report
    return rounded(out, q1=4, q3=4, iqr=4, lower_bound=4, upper_bound=4)


@query(
    "b14_finite_only",
    with_raw(
        """SELECT ORDERNUMBER, ORDERLINENUMBER, PRICEEACH / nullif(MSRP, 0) AS RATIO FROM raw
           WHERE MSRP IS NOT NULL AND MSRP <> 0"""
    ),
)
def finite_only(spark, sf):
    raw = raw_sales(spark, sf, [*KEY, "PRICEEACH", "MSRP"])
    risky = F.when(F.col("MSRP") == 0, F.lit(float("inf"))).otherwise(F.try_divide("PRICEEACH", "MSRP"))
    return cleaning.finite_only(raw.select(*KEY, risky.alias("RATIO")), "RATIO", require=True)


@query(
    "b15_ratio_without_infinities",
    with_raw("SELECT ORDERNUMBER, ORDERLINENUMBER, PRICEEACH / nullif(MSRP, 0) AS RATIO FROM raw"),
)
def safe_ratios(spark, sf):
    raw = raw_sales(spark, sf, [*KEY, "PRICEEACH", "MSRP"])
    return raw.select(*KEY, safe_ratio(F.col("PRICEEACH"), F.col("MSRP")).alias("RATIO"))


FEATURES_SQL = ", ".join(SALES_SCHEMA.features)


@query("b16_contract_order", with_sales(f"SELECT {FEATURES_SQL}, SALES FROM sales"))
def contract_order(spark, sf):
    return contracts.in_contract_order(sales_view(spark, sf), SALES_SCHEMA)


@query("b17_drop_target", with_sales(f"SELECT {FEATURES_SQL} FROM sales"))
def drop_target(spark, sf):
    return contracts.in_contract_order(sales_view(spark, sf), SALES_SCHEMA).drop(SALES_SCHEMA.target)


RATIO_SQL = """, ratios AS (SELECT *, PRICEEACH / nullif(MSRP, 0) AS RATIO, QUANTITYORDERED * PRICEEACH AS LINE_TOTAL_APPROX
  FROM {source})"""


@query(
    "b18_ratio_features",
    with_raw(
        RATIO_SQL.format(source="raw")
        + """ SELECT ORDERNUMBER, ORDERLINENUMBER,
              coalesce(RATIO, (SELECT quantile_cont(RATIO, 0.5) FROM ratios)) AS PRICE_TO_MSRP_RATIO, LINE_TOTAL_APPROX
              FROM ratios"""
    ),
)
def ratio_features(spark, sf):
    raw = raw_sales(spark, sf, [*KEY, "QUANTITYORDERED", "PRICEEACH", "MSRP"])
    return cleaning.add_ratio_features(raw).drop("QUANTITYORDERED", "PRICEEACH", "MSRP")


FEATURE_COLUMNS_SQL = """QUANTITYORDERED, PRICEEACH, MSRP, CAST(year(ORDERDATE) AS INT) AS "YEAR",
  CAST(month(ORDERDATE) AS INT) AS "MONTH", CAST(quarter(ORDERDATE) AS INT) AS "QUARTER",
  coalesce(RATIO, (SELECT quantile_cont(RATIO, 0.5) FROM ratios)) AS PRICE_TO_MSRP_RATIO, LINE_TOTAL_APPROX,
  PRODUCTLINE, DEALSIZE, COUNTRY,
  CASE WHEN month(ORDERDATE) IN (12, 1, 2) THEN 'winter' WHEN month(ORDERDATE) IN (3, 4, 5) THEN 'spring'
       WHEN month(ORDERDATE) IN (6, 7, 8) THEN 'summer' WHEN ORDERDATE IS NOT NULL THEN 'autumn' END AS SEASON"""


@query("b19_regression_features", with_sales(RATIO_SQL.format(source="sales") + f" SELECT {FEATURE_COLUMNS_SQL} FROM ratios"))
def regression_features(spark, sf):
    columns = ["QUANTITYORDERED", "PRICEEACH", "MSRP", "ORDERDATE", "PRODUCTLINE", "DEALSIZE", "COUNTRY", "SALES"]
    out, schema = cleaning.regression_features(sales_view(spark, sf, columns))
    return out.select(*schema.features)


PARSED_DATE = """, dated AS (SELECT * REPLACE (CAST(try_strptime(ORDERDATE, '%m/%d/%Y %H:%M') AS DATE) AS ORDERDATE) FROM raw)"""


@query(
    "b20_regression_dataset",
    with_raw(
        PARSED_DATE
        + _sequential_sql(
            REMOVAL,
            1.5,
            RATIO_SQL.format(source="{last}") + f" SELECT {FEATURE_COLUMNS_SQL}, SALES FROM ratios",
            source="dated",
        )
    ),
)
def regression_dataset(spark, sf):
    return cleaning.regression_dataset(raw_sales(spark, sf))[0]


@query(
    "b21_strict_matrix",
    with_sales(
        "SELECT "
        + ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in SALES_SCHEMA.numeric)
        + ", "
        + ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in SALES_SCHEMA.categorical)
        + ", CAST(SALES AS DOUBLE) AS SALES FROM sales"
    ),
)
def strict_matrix(spark, sf):
    return contracts.strict_matrix(sales_view(spark, sf), SALES_SCHEMA)


@query(
    "f03_parse_order_date",
    with_raw(
        """SELECT ORDERNUMBER, ORDERLINENUMBER, CAST(try_strptime(ORDERDATE, '%m/%d/%Y %H:%M') AS DATE) AS ORDERDATE,
           CAST(year(try_strptime(ORDERDATE, '%m/%d/%Y %H:%M')) AS INT) AS "YEAR",
           CAST(month(try_strptime(ORDERDATE, '%m/%d/%Y %H:%M')) AS INT) AS "MONTH" FROM raw"""
    ),
)
def parse_dates(spark, sf):
    return cleaning.add_date_parts(raw_sales(spark, sf, [*KEY, "ORDERDATE"]))


GATE_SCHEMA = FeatureSchema(("QUANTITY_TEXT", "PRICEEACH", "MSRP"), ("PRODUCTLINE", "COUNTRY"), "SALES")
GATE_COLUMNS = [*GATE_SCHEMA.features, "SALES"]


@query(
    "c04_gate_report",
    with_raw(
        " UNION ALL ".join(
            f"""SELECT '{c}' AS column_name, '{'double' if numeric else 'string'}' AS expected,
            count(*) FILTER ({c} IS NULL) AS null_count,
            count(*) FILTER ({c} IS NOT NULL AND TRY_CAST({c} AS {'DOUBLE' if numeric else 'VARCHAR'}) IS NULL) AS bad_cast_count,
            count(*) AS row_count,
            count(*) FILTER (TRY_CAST({c} AS {'DOUBLE' if numeric else 'VARCHAR'}) IS NULL) = 0 AS passed FROM raw"""
            for c, numeric in [*[(c, True) for c in (*GATE_SCHEMA.numeric, "SALES")], ("PRODUCTLINE", False), ("COUNTRY", False)]
        )
    ),
)
def gate_report(spark, sf):
    return contracts.gate(raw_sales(spark, sf, GATE_COLUMNS), GATE_SCHEMA).report


VALID_SQL = """TRY_CAST(QUANTITY_TEXT AS DOUBLE) IS NOT NULL AND MSRP IS NOT NULL AND PRICEEACH IS NOT NULL
  AND PRODUCTLINE IS NOT NULL AND COUNTRY IS NOT NULL AND SALES IS NOT NULL"""


@query(
    "c04_gate_valid_rows",
    with_raw(
        f"""SELECT CAST(QUANTITY_TEXT AS DOUBLE) AS QUANTITY_TEXT, PRICEEACH, MSRP, SALES, PRODUCTLINE, COUNTRY FROM raw
            WHERE {VALID_SQL}"""
    ),
)
def gate_valid(spark, sf):
    return contracts.gate(raw_sales(spark, sf, GATE_COLUMNS), GATE_SCHEMA).valid


@query("c04_gate_rejects", with_raw(f"SELECT {', '.join(GATE_COLUMNS)} FROM raw WHERE NOT ({VALID_SQL})"))
def gate_rejects(spark, sf):
    return contracts.gate(raw_sales(spark, sf, GATE_COLUMNS), GATE_SCHEMA).rejects


MISSING_COLUMNS = ["QUANTITYORDERED", "SALES", "MSRP", "PRODUCTLINE", "TERRITORY", "STATE", "POSTALCODE", "ADDRESSLINE2"]


def _missing_sql(source: str, columns: list[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) - count({c}) AS missing_count FROM {source}" for c in columns
    )


@query("c08_missing_before", with_raw(_missing_sql("raw", MISSING_COLUMNS)))
def missing_before(spark, sf):
    return contracts.missing_report(raw_sales(spark, sf, MISSING_COLUMNS))


@query(
    "c08_missing_after",
    with_raw(
        """, cleaned AS (SELECT QUANTITYORDERED, SALES, MSRP, PRODUCTLINE, coalesce(TERRITORY, 'Unknown') AS TERRITORY,
             coalesce(STATE, 'Unknown') AS STATE, coalesce(CAST(POSTALCODE AS VARCHAR), 'Unknown') AS POSTALCODE FROM raw) """
        + _missing_sql("cleaned", MISSING_COLUMNS[:-1])
    ),
)
def missing_after(spark, sf):
    return contracts.missing_report(cleaning.clean_missing(raw_sales(spark, sf, MISSING_COLUMNS)))


@query(
    "m02_split_counts",
    with_sales(
        f""", keyed AS (SELECT CAST('0x' || substr(md5({ROW_KEY_SQL}), 1, 8) AS UBIGINT) % 100 AS bucket, SALES FROM sales)
        SELECT CASE WHEN bucket < 20 THEN 'test' ELSE 'train' END AS split, count(*) AS n, round(sum(SALES), 2) AS total_sales
        FROM keyed GROUP BY ALL"""
    ),
)
def split_counts(spark, sf):
    from salescope.operators.modeling import hash_split

    parts = hash_split(sales_view(spark, sf, [*ROW_KEY, "SALES"]), ROW_KEY)
    return parts.groupBy("split").agg(F.count(F.lit(1)).alias("n"), r(F.sum("SALES"), 2).alias("total_sales"))


@query(
    "f04_hash_buckets",
    with_sales(
        f"""SELECT CAST(CAST('0x' || substr(md5({ROW_KEY_SQL}), 1, 8) AS UBIGINT) % 100 AS BIGINT) AS bucket, count(*) AS n
            FROM sales GROUP BY ALL"""
    ),
)
def hash_buckets(spark, sf):
    view = sales_view(spark, sf, ROW_KEY)
    return view.groupBy(hash_bucket(row_text(view, ROW_KEY)).alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "c05_schema_changes",
    f"""WITH o AS ({described("lineitem")}), e AS (SELECT * FROM (VALUES {expected_sql("lineitem")}) t(column_name, kind))
    SELECT column_name, o.kind IS NULL AS missing, e.kind IS NULL AS unexpected, coalesce(o.kind <> e.kind, false) AS type_mismatch,
      e.kind AS expected_type, o.kind AS observed_type, false AS order_changed FROM e FULL JOIN o USING (column_name)""",
)
def schema_changes(spark, sf):
    """The schema of the files of ``lineitem`` against the declared one."""
    return contracts.schema_changes(file_table(spark, sf, "lineitem"), *declared("lineitem"))
