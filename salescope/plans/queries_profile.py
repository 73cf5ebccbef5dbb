"""Queries over column profiles, correlations and plot data."""

from __future__ import annotations

from pyspark.sql import functions as F

from salescope.functions.hashing import fingerprint
from salescope.operators import profiling
from salescope.plans.catalog import query, r, rounded, with_raw, with_sales
from salescope.sources.tables import raw_sales, sales_view

NUMBERS = ["QUANTITYORDERED", "PRICEEACH", "SALES", "MSRP"]
TEXTS = ["PRODUCTLINE", "TERRITORY", "STATE"]


def _union(parts) -> str:
    return " UNION ALL ".join(parts)


@query(
    "g09_describe",
    with_raw(
        _union(
            f"""SELECT '{c}' AS feature, count({c}) AS "count", round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std,
            round(min({c}), 4) AS min, round(quantile_cont({c}, 0.25), 4) AS q25, round(quantile_cont({c}, 0.5), 4) AS q50,
            round(quantile_cont({c}, 0.75), 4) AS q75, round(max({c}), 4) AS max FROM raw"""
            for c in NUMBERS
        )
    ),
)
def describe(spark, sf):
    out = profiling.describe(raw_sales(spark, sf, NUMBERS), NUMBERS)
    return rounded(out, mean=4, std=4, min=4, q25=4, q50=4, q75=4, max=4)


@query(
    "g10_numeric_profile",
    with_raw(
        _union(
            f"""SELECT '{c}' AS feature, 'double' AS dtype, count(*) - count({c}) AS missing_count,
            round(1 - count({c}) / count(*), 8) AS missing_ratio, count(DISTINCT {c}) AS unique_count,
            round(avg({c}), 4) AS mean, round(stddev_pop({c}), 4) AS std, round(min({c}), 4) AS min, round(max({c}), 4) AS max,
            round(quantile_cont({c}, 0.05), 4) AS q05, round(quantile_cont({c}, 0.25), 4) AS q25,
            round(quantile_cont({c}, 0.5), 4) AS q50, round(quantile_cont({c}, 0.75), 4) AS q75,
            round(quantile_cont({c}, 0.95), 4) AS q95 FROM raw"""
            for c in NUMBERS
        )
    ),
)
def numeric_profile(spark, sf):
    out = profiling.numeric_profile(raw_sales(spark, sf, NUMBERS), NUMBERS)
    return rounded(out, missing_ratio=8, mean=4, std=4, min=4, max=4, q05=4, q25=4, q50=4, q75=4, q95=4)


SHARES_SQL = """ranked AS (SELECT '{c}' AS feature, CAST({c} AS VARCHAR) AS "value", count(*) AS "rows",
  round(count(*) / (SELECT count({c}) FROM raw), 8) AS ratio,
  CAST(row_number() OVER (ORDER BY count(*) DESC, CAST({c} AS VARCHAR)) AS INT) AS "rank"
  FROM raw WHERE {c} IS NOT NULL GROUP BY {c})"""


def _shares_sql(columns, top):
    return with_raw(
        _union(
            f"(WITH {SHARES_SQL.format(c=c)} SELECT * FROM ranked WHERE \"rank\" <= {top})" for c in columns
        )
    )


@query("g11_categorical_profile", _shares_sql([*TEXTS, "POSTALCODE"], 10))
def categorical_profile(spark, sf):
    columns = [*TEXTS, "POSTALCODE"]
    return rounded(profiling.categorical_profile(raw_sales(spark, sf, columns), columns), ratio=8)


@query(
    "g12_numeric_distribution",
    with_raw(
        _union(
            f"""SELECT '{c}' AS feature, 'numeric' AS type, count({c}) AS "count",
            round(1 - count({c}) / count(*), 8) AS missing_ratio, round(avg({c}), 4) AS mean,
            round(stddev_pop({c}), 4) AS std, round(min({c}), 4) AS min, round(quantile_cont({c}, 0.1), 4) AS p10,
            round(quantile_cont({c}, 0.5), 4) AS p50, round(quantile_cont({c}, 0.9), 4) AS p90, round(max({c}), 4) AS max
            FROM raw"""
            for c in NUMBERS
        )
    ),
)
def numeric_distribution(spark, sf):
    out = profiling.numeric_distribution(raw_sales(spark, sf, NUMBERS), NUMBERS)
    return rounded(out, missing_ratio=8, mean=4, std=4, min=4, p10=4, p50=4, p90=4, max=4)


def _flat_top(df):
    """Top values as text ``value=share``, so that both engines return plain columns."""
    text = F.transform("top_values", lambda t: F.concat(t["value"], F.lit("="), F.format_number(t["ratio"], 6)))
    return df.withColumn("top_values", F.array_join(text, ";"))


def _text_distribution_sql(c: str, source: str = "raw", top: int = 5) -> str:
    return f"""SELECT '{c}' AS feature, 'categorical' AS type, count({c}) AS "count", count(DISTINCT {c}) AS "unique",
      round(1 - count({c}) / count(*), 8) AS missing_ratio,
      (SELECT string_agg(v || '=' || printf('%.6f', s), ';' ORDER BY k) FROM (
        SELECT CAST({c} AS VARCHAR) AS v, count(*) / (SELECT count({c}) FROM {source}) AS s,
               row_number() OVER (ORDER BY count(*) DESC, CAST({c} AS VARCHAR)) AS k
        FROM {source} WHERE {c} IS NOT NULL GROUP BY {c}) WHERE k <= {top}) AS top_values
      FROM {source}"""


@query("g13_categorical_distribution", with_raw(_union(_text_distribution_sql(c) for c in TEXTS)))
def categorical_distribution(spark, sf):
    out = profiling.categorical_distribution(raw_sales(spark, sf, TEXTS), TEXTS)
    return rounded(_flat_top(out), missing_ratio=8)


def _summary_sql(source: str) -> str:
    empty = "NULL AS mean, NULL AS std, NULL AS min, NULL AS p10, NULL AS p50, NULL AS p90, NULL AS max"
    number = f"""SELECT 'MSRP' AS feature, 'numeric' AS type, count(MSRP) AS "count",
      round(1 - count(MSRP) / count(*), 8) AS missing_ratio, round(avg(MSRP), 4) AS mean,
      round(stddev_pop(MSRP), 4) AS std, round(min(MSRP), 4) AS min, round(quantile_cont(MSRP, 0.1), 4) AS p10,
      round(quantile_cont(MSRP, 0.5), 4) AS p50, round(quantile_cont(MSRP, 0.9), 4) AS p90, round(max(MSRP), 4) AS max,
      NULL AS "unique", NULL AS top_values, true AS present FROM {source}"""
    text = f"""SELECT feature, type, "count", missing_ratio, {empty}, "unique", top_values, true AS present
      FROM ({_text_distribution_sql('STATE', source)})"""
    absent = f"""SELECT 'NOT_THERE' AS feature, 'missing' AS type, 0 AS "count", 1.0 AS missing_ratio, {empty},
      NULL AS "unique", NULL AS top_values, false AS present"""
    return f"{number} UNION ALL {text} UNION ALL {absent}"


SUMMARY_FEATURES = ["MSRP", "STATE", "NOT_THERE"]
SUMMARY_ROUND = dict(missing_ratio=8, mean=4, std=4, min=4, p10=4, p50=4, p90=4, max=4)


@query("g14_distribution_summary", with_raw(_summary_sql("raw")))
def distribution_summary(spark, sf):
    out = profiling.distribution_summary(raw_sales(spark, sf, ["MSRP", "STATE"]), SUMMARY_FEATURES)
    return rounded(_flat_top(out), **SUMMARY_ROUND)


LOG_FIELDS = ["present", "type", "count", "missing_ratio", "p50", "unique", "top_values"]


def _log_side(side: str) -> str:
    return ", ".join(f'{side}."{f}" AS {side}_{f}' for f in LOG_FIELDS)


@query(
    "g15_distribution_log",
    with_raw(
        f""", early AS (SELECT * FROM raw WHERE ORDERNUMBER % 2 = 0), late AS (SELECT * FROM raw WHERE ORDERNUMBER % 2 = 1),
        reference AS ({_summary_sql('early')}), current_side AS ({_summary_sql('late')})
        SELECT coalesce(reference.feature, cur.feature) AS feature, {_log_side('reference')}, {_log_side('cur')}
        FROM reference FULL JOIN current_side cur ON reference.feature = cur.feature"""
    ),
)
def distribution_log(spark, sf):
    raw = raw_sales(spark, sf, ["ORDERNUMBER", "MSRP", "STATE"])
    log = profiling.distribution_log(
        raw.where("ORDERNUMBER % 2 = 0"), raw.where("ORDERNUMBER % 2 = 1"), SUMMARY_FEATURES
    )
    flat = ["feature"]
    for side, name in (("reference", "reference"), ("current", "cur")):
        for f in LOG_FIELDS:
            col = F.col(f"{side}.{f}")
            if f == "top_values":
                col = F.array_join(
                    F.transform(col, lambda t: F.concat(t["value"], F.lit("="), F.format_number(t["ratio"], 6))), ";"
                )
            elif f in SUMMARY_ROUND:
                col = F.round(col, SUMMARY_ROUND[f])
            flat.append(col.alias(f"{name}_{f}"))
    return log.select(*flat)


FEATURES = ["QUANTITYORDERED", "PRICEEACH", "MSRP"]


@query(
    "g16_target_correlations",
    with_raw(
        _union(f"SELECT '{c}' AS feature, round(corr({c}, SALES), 8) AS correlation FROM raw" for c in FEATURES)
    ),
)
def target_correlations(spark, sf):
    out = profiling.target_correlations(raw_sales(spark, sf, [*FEATURES, "SALES"]), FEATURES, "SALES")
    return rounded(out, correlation=8)


@query(
    "g17_correlation_matrix",
    with_raw(
        _union(
            f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, round(coalesce(corr({a}, {b}), 0), 8) AS correlation FROM raw"
            for a in NUMBERS
            for b in NUMBERS
        )
    ),
)
def correlation_matrix(spark, sf):
    return rounded(profiling.correlation_matrix(raw_sales(spark, sf, NUMBERS), NUMBERS), correlation=8)


@query("g18_pair_correlation", with_sales("SELECT round(corr(PRICEEACH, SALES), 8) AS correlation FROM sales"))
def pair_correlation(spark, sf):
    view = sales_view(spark, sf, ["PRICEEACH", "SALES"])
    return rounded(profiling.pair_correlation(view, "PRICEEACH", "SALES"), correlation=8)


@query(
    "t05_sorted_correlations",
    with_raw(
        "SELECT * FROM ("
        + _union(f"SELECT '{c}' AS feature, round(corr({c}, SALES), 8) AS correlation FROM raw" for c in FEATURES)
        + ") ORDER BY abs(correlation) DESC"
    ),
)
def sorted_correlations(spark, sf):
    out = profiling.sorted_correlations(raw_sales(spark, sf, [*FEATURES, "SALES"]), FEATURES, "SALES")
    return rounded(out, correlation=8)


PRINT_COLUMNS = ["ORDERNUMBER", "QUANTITYORDERED", "SALES", "STATE", "ORDERDATE"]


@query(
    "g19_fingerprint",
    with_raw(
        """, texts AS (SELECT concat_ws('|', coalesce(CAST(ORDERNUMBER AS VARCHAR), '\\N'),
             coalesce(CAST(CAST(round(QUANTITYORDERED * 1e6, 0) AS BIGINT) AS VARCHAR), '\\N'),
             coalesce(CAST(CAST(round(SALES * 1e6, 0) AS BIGINT) AS VARCHAR), '\\N'),
             coalesce(STATE, '\\N'), coalesce(ORDERDATE, '\\N')) AS t FROM raw),
        s AS (SELECT count(*) AS row_count, sum(CAST('0x' || substr(md5(t), 1, 15) AS UBIGINT)::HUGEINT) AS hash_sum FROM texts)
        SELECT 'sha256' AS algorithm, row_count,
        sha256(concat_ws('|', 'ORDERNUMBER,QUANTITYORDERED,SALES,STATE,ORDERDATE', row_count, hash_sum)) AS "value" FROM s"""
    ),
)
def table_fingerprint(spark, sf):
    return fingerprint(raw_sales(spark, sf, PRINT_COLUMNS), PRINT_COLUMNS)


@query(
    "g20_profile_overview",
    with_sales(
        """SELECT 'sales' AS project_name, '1' AS report_version, count(*) AS row_count, 4 AS column_count,
           'PRICEEACH,MSRP' AS numeric_features, 'PRODUCTLINE' AS categorical_features, 'SALES' AS target_name FROM sales"""
    ),
)
def profile_overview(spark, sf):
    view = sales_view(spark, sf, ["PRICEEACH", "MSRP", "PRODUCTLINE", "SALES"])
    report = profiling.profile_report(view, ["PRICEEACH", "MSRP", "NOT_THERE"], ["PRODUCTLINE"], "SALES", "sales")
    return report["overview"].select(
        "project_name", "report_version", "row_count", "column_count",
        F.array_join("numeric_features", ",").alias("numeric_features"),
        F.array_join("categorical_features", ",").alias("categorical_features"),
        "target_name",
    )


HISTOGRAM_SQL = """, e AS (SELECT min(SALES) AS lo, max(SALES) AS hi, (max(SALES) - min(SALES)) / 30 AS w FROM raw),
  g AS (SELECT SALES, lo, w, least(CAST(floor((SALES - lo) / w) AS INT), 29) AS guess FROM raw, e WHERE SALES IS NOT NULL),
  h AS (SELECT lo, w, CASE WHEN SALES < lo + guess * w THEN guess - 1
                           WHEN SALES >= lo + (guess + 1) * w AND guess < 29 THEN guess + 1 ELSE guess END AS bin FROM g)
  SELECT bin, round(lo + bin * w, 4) AS bin_start, round(lo + (bin + 1) * w, 4) AS bin_end, count(*) AS "rows"
  FROM h GROUP BY bin, lo, w"""


@query("g21_histogram", with_raw(HISTOGRAM_SQL))
def histogram(spark, sf):
    return rounded(profiling.histogram(raw_sales(spark, sf, ["SALES"]), "SALES"), bin_start=4, bin_end=4)


@query(
    "g22_boxplot",
    with_raw(
        """, q AS (SELECT PRODUCTLINE AS k, quantile_cont(SALES, 0.25) AS q1, quantile_cont(SALES, 0.5) AS med,
               quantile_cont(SALES, 0.75) AS q3 FROM raw GROUP BY 1),
        f AS (SELECT *, q1 - 0.3 * (q3 - q1) AS low, q3 + 0.3 * (q3 - q1) AS high FROM q)
        SELECT PRODUCTLINE, round(q1, 4) AS q1, round(med, 4) AS median, round(q3, 4) AS q3, count(*) AS n,
          min(CASE WHEN SALES BETWEEN low AND high THEN SALES END) AS whisker_low,
          max(CASE WHEN SALES BETWEEN low AND high THEN SALES END) AS whisker_high,
          count(*) FILTER (SALES < low OR SALES > high) AS outliers
        FROM raw JOIN f ON raw.PRODUCTLINE IS NOT DISTINCT FROM f.k WHERE SALES IS NOT NULL
        GROUP BY PRODUCTLINE, q1, med, q3"""
    ),
)
def boxplot(spark, sf):
    out = profiling.boxplot_stats(raw_sales(spark, sf, ["PRODUCTLINE", "SALES"]), "PRODUCTLINE", "SALES", 0.3)
    return rounded(out, q1=4, median=4, q3=4)
