"""Queries over models, scoring, explanation, jobs, sinks and streams."""

from __future__ import annotations

import uuid

from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.sql import functions as F

from salescope.functions.scalar import finite
from salescope.operators import artifact, cleaning, contracts, drift, evaluation, explain, modeling, profiling, scoring
from salescope.operators.contracts import SALES_SCHEMA, FeatureSchema
from salescope.operators.modeling import Candidate, boosting, forest, linear
from salescope.plans import jobs
from salescope.plans.catalog import SALES, query, r, rounded, with_raw, with_sales
from salescope.plans.queries_cleaning import FEATURE_COLUMNS_SQL, RATIO_SQL, REMOVAL, _sequential_sql
from salescope.plans.queries_drift import HALF, halves
from salescope.plans.queries_grouped import ROW_KEY, ROW_KEY_SQL
from salescope.session import materialize, shared_folder
from salescope.sources import readers, sinks
from salescope.sources.tables import raw_sales, sales_view, table
from salescope.streaming import drift as stream_drift
from salescope.streaming import scoring as stream_scoring

# Parameter sets sized for a test machine; the full defaults are modeling.sales_candidates().
LIGHT = [
    Candidate("LinearRegression", linear),
    Candidate("RandomForestRegressor", forest, ({"numTrees": 12, "maxDepth": 7},), {"numTrees": [6], "maxDepth": [3, 5]}),
    Candidate("GradientBoostingRegressor", boosting, ({"maxIter": 12, "stepSize": 0.3, "maxDepth": 3},)),
]
RANDOM = [
    Candidate("RandomForest", forest, ({"numTrees": 6, "maxDepth": 5},),
              {"numTrees": [4, 6], "maxDepth": [3, 5], "minInstancesPerNode": [1, 4]}, draws=3, folds=2),
]


def new_folder(spark, label: str) -> str:
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def split_sales(spark, sf):
    view = sales_view(spark, sf, list(dict.fromkeys([*ROW_KEY, *SALES_SCHEMA.features, "SALES"])))
    return modeling.hash_folds(modeling.hash_split(view, ROW_KEY), ROW_KEY)


def split_table(spark, sf):
    """``split_sales`` written once, for queries that train on it and then score it."""
    return materialize(split_sales(spark, sf), "split")


def trained(spark, sf, which: str, rows=None):
    """``rows``: the ``split_table``, where the query has one."""
    candidates = {"linear": LIGHT[:1], "forest": LIGHT[1:2], "boosting": LIGHT[2:], "all": LIGHT}[which]
    return modeling.train(split_sales(spark, sf) if rows is None else rows, SALES_SCHEMA, candidates, "baseline", hold=rows is None)


def forest_bundle(spark, sf, rows=None):
    """A forest, saved and loaded again, and its trees."""
    result = trained(spark, sf, "forest", rows)
    path = new_folder(spark, "forest")
    sinks.save_model(result.pipeline, path, modeling.model_metadata(result, spark, "sales"))
    model, _ = sinks.load_model(spark, path)
    return model, explain.read_ensemble(spark, f"{path}/model", model)


@query("m01_preprocessed_rows")
def preprocessed(spark, sf):
    from pyspark.ml import Pipeline
    from pyspark.ml.functions import vector_to_array

    parts = split_sales(spark, sf)
    prep = Pipeline(stages=modeling.preprocessor_stages(SALES_SCHEMA)).fit(parts.where("split = 'train'"))
    values = vector_to_array("features")
    return prep.transform(parts).select("ORDERNUMBER", "ORDERLINENUMBER", "split", values.alias("features"))


@query("m03_linear_regression")
def linear_board(spark, sf):
    return trained(spark, sf, "linear").leaderboard(spark)


@query("m04_random_forest")
def forest_board(spark, sf):
    return trained(spark, sf, "forest").leaderboard(spark)


@query("m05_gradient_boosting")
def boosting_board(spark, sf):
    return trained(spark, sf, "boosting").leaderboard(spark)


@query("m06_baseline_leaderboard")
def baseline_board(spark, sf):
    return trained(spark, sf, "all").leaderboard(spark)


@query("m07_grid_search")
def grid_search(spark, sf):
    return modeling.train(split_sales(spark, sf), SALES_SCHEMA, LIGHT[1:2], "tuned").leaderboard(spark)


@query("m08_random_search")
def random_search(spark, sf):
    return modeling.train(split_sales(spark, sf), SALES_SCHEMA, RANDOM, "tuned").leaderboard(spark)


@query("m09_run_log")
def run_log(spark, sf):
    return modeling.run_log(trained(spark, sf, "all"), spark, "light").drop("logged_at")


@query("m10_both_modes")
def both_modes(spark, sf):
    return modeling.train(split_sales(spark, sf), SALES_SCHEMA, LIGHT[:2], "both").leaderboard(spark)


@query("m11_best_model")
def best_model(spark, sf):
    board = trained(spark, sf, "all").leaderboard(spark)
    by_error = modeling.best_by(board, "rmse").select("model_name", F.lit("rmse").alias("metric"), F.col("rmse").alias("value"))
    by_fit = modeling.best_by(board, "r2").select("model_name", F.lit("r2").alias("metric"), F.col("r2").alias("value"))
    return by_error.unionByName(by_fit)


@query("m12_engineered_training")
def engineered_training(spark, sf):
    data, schema = cleaning.regression_dataset(raw_sales(spark, sf))
    data = cleaning.categories_as_text(cleaning.drop_missing_target(data, "SALES"), schema.categorical)
    data = cleaning.impute_median(data, schema.numeric)
    key = ["QUANTITYORDERED", "PRICEEACH", "MSRP", "YEAR", "MONTH", "COUNTRY"]
    split = modeling.hash_folds(modeling.hash_split(data, key), key)
    return modeling.train(split, schema, LIGHT, "baseline").leaderboard(spark)


@query("m13_train_job")
def train_job(spark, sf):
    view = sales_view(spark, sf, list(dict.fromkeys([*ROW_KEY, *SALES_SCHEMA.features, "SALES"])))
    job = jobs.train_job(view, SALES_SCHEMA, ROW_KEY, LIGHT[2:], new_folder(spark, "job"), "baseline", segment=["PRODUCTLINE"])
    return job.reports["metadata"].drop("created_at")


@query("m14_batch_scores")
def batch_scores(spark, sf):
    split = split_table(spark, sf)
    rows = split.select(*dict.fromkeys([*ROW_KEY, *SALES_SCHEMA.features]))
    scored, _ = scoring.score(rows, trained(spark, sf, "all", split).pipeline, SALES_SCHEMA)
    return scored.select(*ROW_KEY, "prediction")


@query("m16_ensemble_intervals")
def ensemble_intervals(spark, sf):
    model, ensemble = forest_bundle(spark, sf)
    scored = explain.member_intervals(model.transform(split_sales(spark, sf)), ensemble)
    out = scoring.interval_cascade(scored, ensemble="ensemble")
    return out.select(*ROW_KEY, "prediction", "p10", "p90", "interval_method")


@query("m20_local_explanations")
def local_explanations(spark, sf):
    rows = split_table(spark, sf)
    model, ensemble = forest_bundle(spark, sf, rows)
    scored = model.transform(rows)
    explained = explain.explain_rows(scored, ensemble, SALES_SCHEMA, ROW_KEY)
    return explain.top_contributions(explained, 5).select(*ROW_KEY, "prediction", "base_value", "top")


@query("m21_global_explanation")
def global_explanation(spark, sf):
    rows = split_table(spark, sf)
    model, ensemble = forest_bundle(spark, sf, rows)
    return explain.mean_abs_shap(explain.explain_rows(model.transform(rows), ensemble, SALES_SCHEMA))


@query("m22_split_importance")
def split_importance(spark, sf):
    model, _ = forest_bundle(spark, sf)
    return explain.split_importance(model.transform(split_sales(spark, sf)), model, SALES_SCHEMA)


QUALITY_SQL = """, scored AS (SELECT *, QUANTITYORDERED * PRICEEACH * 0.97 + 500 AS prediction FROM sales),
  e AS (SELECT quantile_cont(prediction, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) AS q,
        quantile_cont(PRICEEACH, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) AS pq FROM scored),
  b AS (SELECT len(list_filter(q, lambda x: x < prediction)) AS bin, count(*) AS n, avg(SALES) AS t, avg(prediction) AS p
        FROM scored, e GROUP BY ALL),
  gap AS (SELECT sum(n * abs(t - p)) / sum(n) AS g FROM b),
  rc AS (SELECT len(list_filter(pq, lambda x: x <= PRICEEACH)) AS bin, count(*) AS n FROM scored, e GROUP BY ALL),
  cc AS (SELECT len(list_filter(pq, lambda x: x <= PRICEEACH * 1.05)) AS bin, count(*) AS n FROM scored, e GROUP BY ALL),
  pr AS (SELECT coalesce(rc.n, 0) / (SELECT sum(n) FROM rc) AS p, coalesce(cc.n, 0) / (SELECT sum(n) FROM cc) AS c
         FROM rc FULL JOIN cc ON rc.bin = cc.bin),
  ps AS (SELECT sum((c - p) * ln((c + 1e-8) / (p + 1e-8))) AS psi FROM pr)
  SELECT 'formula' AS best_model, round(avg(pow(SALES - prediction, 2)), 2) AS mse,
    round(sqrt(avg(pow(SALES - prediction, 2))), 4) AS rmse, round(avg(abs(SALES - prediction)), 4) AS mae,
    round(1 - avg(pow(SALES - prediction, 2)) / var_pop(SALES), 8) AS r2,
    (SELECT round(g, 4) FROM gap) AS calibration_error, (SELECT round(psi, 8) FROM ps) AS psi FROM scored"""


@query("m23_quality_row", with_sales(QUALITY_SQL))
def quality_row(spark, sf):
    view = sales_view(spark, sf, ["QUANTITYORDERED", "PRICEEACH", "SALES"])
    scored = view.withColumn("prediction", F.expr("QUANTITYORDERED * PRICEEACH * 0.97D + 500D"))
    out = jobs.quality_job(scored, "SALES", "PRICEEACH", "PRICEEACH * 1.05D", "formula")
    return rounded(out, mse=2, rmse=4, mae=4, r2=8, calibration_error=4, psi=8)


@query("m23_quality_of_model")
def quality_of_model(spark, sf):
    rows = split_table(spark, sf)
    result = trained(spark, sf, "all", rows)
    scored = result.pipeline.transform(rows.where("split = 'test'"))
    return jobs.quality_job(scored, "SALES", "PRICEEACH", "PRICEEACH * 1.05D", result.best.model_name)


JOB_FEATURES = ["QUANTITYORDERED", "PRICEEACH", "MSRP", "MONTH_ID"]
JOB_COLUMNS = [*(c for c in SALES_SCHEMA.features if c != "YEAR_ID"), "SALES"]


@query(
    "m24_daily_drift_alert",
    with_sales(
        ", long AS ("
        + " UNION ALL ".join(
            f"SELECT '{c}' AS feature, CAST({c} AS DOUBLE) AS v, CASE WHEN YEAR_ID > {HALF} THEN 1 ELSE 0 END AS is_current FROM sales"
            for c in JOB_FEATURES
        )
        + """), edges AS (SELECT feature, quantile_cont(v, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) AS q
             FROM long WHERE is_current = 0 GROUP BY feature),
        bins AS (SELECT feature, len(list_filter(q, lambda x: x <= v)) AS bin, count(*) FILTER (is_current = 0) AS ref,
             count(*) FILTER (is_current = 1) AS cur FROM long JOIN edges USING (feature) GROUP BY ALL),
        shares AS (SELECT feature, ref / sum(ref) OVER (PARTITION BY feature) AS p, cur / sum(cur) OVER (PARTITION BY feature) AS q FROM bins),
        psi AS (SELECT feature, sum((q - p) * ln((q + 1e-8) / (p + 1e-8))) AS psi FROM shares GROUP BY feature),
        counts AS (SELECT feature, v, count(*) FILTER (is_current = 0) AS ref, count(*) FILTER (is_current = 1) AS cur FROM long GROUP BY ALL),
        cdf AS (SELECT feature, sum(ref) OVER w / sum(ref) OVER (PARTITION BY feature) AS f, sum(cur) OVER w / sum(cur) OVER (PARTITION BY feature) AS g
             FROM counts WINDOW w AS (PARTITION BY feature ORDER BY v ROWS UNBOUNDED PRECEDING)),
        sizes AS (SELECT feature, sum(ref) AS n, sum(cur) AS m FROM counts GROUP BY feature),
        ks AS (SELECT feature, max(abs(f - g)) AS d, any_value(sqrt(n * m / (n + m))) AS e FROM cdf JOIN sizes USING (feature) GROUP BY feature),
        s AS (SELECT feature, psi >= 0.2 OR d > sqrt(-0.5 * ln(0.05 / 2)) / e AS drifted FROM ks JOIN psi USING (feature))
        SELECT 'sales' AS project_name, count(*) AS features, count(*) FILTER (drifted) AS drifted_features,
          round(avg(CASE WHEN drifted THEN 1 ELSE 0 END), 8) AS drift_ratio,
          avg(CASE WHEN drifted THEN 1 ELSE 0 END) >= 0.3 AS alert FROM s"""
    ),
)
def daily_drift_alert(spark, sf):
    reference, current = halves(spark, sf, JOB_COLUMNS)
    reports = jobs.drift_job(reference, current, SALES_SCHEMA, "sales", numeric=JOB_FEATURES)
    return rounded(reports["drift_alert"].drop("generated_at"), drift_ratio=8)


@query("m24_daily_schema_alert")
def daily_schema_alert(spark, sf):
    reference, current = halves(spark, sf, JOB_COLUMNS)
    changes = contracts.schema_changes(current.drop("SALES"), list(SALES_SCHEMA.features))
    return contracts.schema_alert(changes, "sales").drop("generated_at")


@query(
    "m25_yearly_psi_job",
    with_sales(
        """, s AS (SELECT SALES AS v, YEAR_ID = (SELECT max(YEAR_ID) FROM sales) AS late FROM sales
             WHERE YEAR_ID IN ((SELECT min(YEAR_ID) FROM sales), (SELECT max(YEAR_ID) FROM sales))),
        e AS (SELECT min(v) AS lo, max(v) AS hi, (max(v) - min(v)) / 10 AS w FROM s WHERE NOT late),
        g AS (SELECT v, late, lo, w, least(CAST(floor((v - lo) / w) AS INT), 9) AS k FROM s, e WHERE v BETWEEN lo AND hi),
        b AS (SELECT late, CASE WHEN v < lo + k * w THEN k - 1 WHEN v >= lo + (k + 1) * w AND k < 9 THEN k + 1 ELSE k END AS bin FROM g),
        c AS (SELECT t.bin, count(b.bin) FILTER (NOT late) AS ref, count(b.bin) FILTER (late) AS cur
              FROM range(10) t(bin) LEFT JOIN b ON b.bin = t.bin GROUP BY t.bin),
        p AS (SELECT bin, greatest(ref / sum(ref) OVER (), 1e-6) AS rp, greatest(cur / sum(cur) OVER (), 1e-6) AS cp FROM c)
        SELECT CAST(p.bin AS INT) AS bin, round(lo + p.bin * w, 4) AS bin_start, round(rp / w, 12) AS ref_density, round(cp / w, 12) AS cur_density
        FROM p, e"""
    ),
)
def yearly_psi_job(spark, sf):
    out = jobs.yearly_psi_job(sales_view(spark, sf, ["SALES", "YEAR_ID"]), "SALES", "YEAR_ID")["density"]
    return rounded(out, bin_start=4, ref_density=12, cur_density=12)


DATED = """, dated AS (SELECT * REPLACE (CAST(try_strptime(ORDERDATE, '%m/%d/%Y %H:%M') AS DATE) AS ORDERDATE) FROM raw)"""


@query(
    "m26_eda_job_by_year",
    with_raw(
        DATED
        + _sequential_sql(
            REMOVAL, 1.5,
            """SELECT CAST(year(ORDERDATE) AS INT) AS "YEAR", round(sum(SALES), 2) AS total_sales, round(avg(SALES), 4) AS avg_sales,
               count(DISTINCT ORDERNUMBER) AS orders_count FROM {last} GROUP BY 1""",
            source="dated",
        )
    ),
)
def eda_job_by_year(spark, sf):
    out = jobs.eda_job(raw_sales(spark, sf), histograms=(), scatters=(), boxplots=())["sales_by_year"]
    return rounded(out, total_sales=2, avg_sales=4)


LAYER_SQL = """, layer AS (SELECT *, year(d) AS y FROM (SELECT *, CAST(try_strptime(ORDERDATE, '%m/%d/%Y %H:%M') AS DATE) AS d FROM raw))"""


@query(
    "m27_data_layer_job",
    with_raw(
        LAYER_SQL
        + """ SELECT CAST(y AS INT) AS "YEAR", CAST(month(d) AS INT) AS "MONTH", coalesce(TERRITORY, 'Unknown') AS TERRITORY,
            count(*) AS n, round(sum(SALES), 2) AS total_sales FROM layer GROUP BY ALL"""
    ),
)
def data_layer(spark, sf):
    out = jobs.data_layer_job(raw_sales(spark, sf), new_folder(spark, "layer"), "sales_layer")
    return out.groupBy("YEAR", "MONTH", "TERRITORY").agg(
        F.count(F.lit(1)).alias("n"), r(F.sum("SALES"), 2).alias("total_sales")
    )


# A second dataset through the same contract: eight numerics, no categories.
SECOND = FeatureSchema(
    ("l_quantity", "l_discount", "l_tax", "l_linenumber", "p_size", "p_retailprice", "o_totalprice", "c_acctbal"), (), "l_extendedprice"
)
SECOND_SQL = """WITH second AS (SELECT l_quantity, l_discount, l_tax, l_linenumber, p_size, p_retailprice, o_totalprice, c_acctbal,
  l_extendedprice FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey)"""


def second_table(spark, sf):
    heads = table(spark, sf, "orders").join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    lines = table(spark, sf, "lineitem").join(table(spark, sf, "part"), F.col("l_partkey") == F.col("p_partkey"))
    return contracts.in_contract_order(lines.join(heads, F.col("l_orderkey") == F.col("o_orderkey")), SECOND)


@query(
    "m28_second_dataset_profile",
    SECOND_SQL
    + " UNION ALL ".join(
        f"""{' ' if i else ' '}SELECT '{c}' AS feature, round(avg({c}), 4) AS mean, round(quantile_cont({c}, 0.5), 4) AS q50,
        round(corr({c}, l_extendedprice), 8) AS correlation FROM second"""
        for i, c in enumerate(SECOND.numeric)
    ),
)
def second_profile(spark, sf):
    rows = contracts.gate(second_table(spark, sf), SECOND).valid
    stats = profiling.describe(rows, SECOND.numeric).select("feature", "mean", "q50")
    cors = F.broadcast(profiling.target_correlations(rows, SECOND.numeric, SECOND.target))  # one row per column
    return rounded(stats.join(cors, "feature", "left"), mean=4, q50=4, correlation=8)


@query("m28_second_dataset_training")
def second_training(spark, sf):
    rows = second_table(spark, sf)
    split = modeling.hash_folds(modeling.hash_split(rows, rows.columns), rows.columns)
    return modeling.train(split, SECOND, LIGHT[:1], "baseline").leaderboard(spark)


# --- sources and sinks, by reading back what was written -------------------------------

BACK_SQL = "SELECT YEAR_ID, count(*) AS n, round(sum(SALES), 2) AS total_sales FROM sales GROUP BY YEAR_ID"


def _per_year(df):
    return df.groupBy("YEAR_ID").agg(F.count(F.lit(1)).alias("n"), r(F.sum("SALES"), 2).alias("total_sales"))


def _three(spark, sf):
    return sales_view(spark, sf, ["ORDERNUMBER", "YEAR_ID", "SALES"])


@query("a05_parquet_glob_scan", "SELECT n_regionkey, count(*) AS n FROM nation GROUP BY n_regionkey")
def parquet_glob(spark, sf):
    rows = readers.read_parquet(spark, sf, glob="nation.parquet")
    return rows.groupBy("n_regionkey").agg(F.count(F.lit(1)).alias("n"))


@query("a06_lazy_parquet_scan", "SELECT l_returnflag, count(*) AS n, round(sum(l_quantity), 2) AS qty FROM lineitem WHERE l_discount > 0.05 GROUP BY 1")
def lazy_scan(spark, sf):
    rows = readers.read_parquet(spark, f"{sf}/lineitem.parquet").where("l_discount > 0.05D")
    return rows.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n"), r(F.sum("l_quantity"), 2).alias("qty"))


@query("a07_partitioned_write", with_sales(BACK_SQL))
def partitioned_write(spark, sf):
    path = new_folder(spark, "by-year")
    sinks.write_partitioned(_three(spark, sf), path, ["YEAR_ID"])
    return _per_year(spark.read.parquet(path))


@query("a08_plain_write", with_sales(BACK_SQL))
def plain_write(spark, sf):
    path = new_folder(spark, "plain")
    sinks.write_partitioned(_three(spark, sf), path)
    return _per_year(spark.read.parquet(path))


@query("a09_named_table", with_sales(BACK_SQL))
def named_table(spark, sf):
    sinks.register_table(_three(spark, sf), "named_sales")
    return spark.sql(
        """SELECT YEAR_ID, count(*) AS n, round(sum(SALES), 2) AS total_sales FROM named_sales GROUP BY YEAR_ID"""
    )


@query("a10_summary_tables", with_sales("SELECT PRODUCTLINE, round(sum(SALES), 2) AS total_sales FROM sales GROUP BY PRODUCTLINE"))
def summary_sink(spark, sf):
    from salescope.operators import grouped

    path = new_folder(spark, "summary")
    view = sales_view(spark, sf, ["PRODUCTLINE", "SALES"])
    sinks.write_summary_tables({"by_line": grouped.sales_by_productline(view)}, path)
    back = readers.read_csv(spark, f"{path}/by_line.csv", "PRODUCTLINE string, total_sales double, avg_sales double, orders_count long")
    return rounded(back.select("PRODUCTLINE", "total_sales"), total_sales=2)


@query("a11_json_report", with_sales("SELECT 'sales' AS project_name, YEAR_ID, count(*) AS n, round(sum(SALES), 2) AS total_sales FROM sales GROUP BY YEAR_ID"))
def json_report(spark, sf):
    path = new_folder(spark, "report")
    sinks.write_report(_per_year(_three(spark, sf)), path, "sales")
    back = spark.read.schema("project_name string, YEAR_ID int, n long, total_sales double").json(path)
    return back.select("project_name", "YEAR_ID", "n", "total_sales")


@query("a12_appended_log", with_sales("SELECT YEAR_ID, 2 * count(*) AS n FROM sales GROUP BY YEAR_ID"))
def appended_log(spark, sf):
    path = new_folder(spark, "log")
    for _ in range(2):
        sinks.append_log(_three(spark, sf), path)
    back = spark.read.schema("ORDERNUMBER long, YEAR_ID int, SALES double").json(path)
    return back.groupBy("YEAR_ID").agg(F.count(F.lit(1)).alias("n"))


@query("a13_json_records", with_sales("SELECT ORDERNUMBER, PRICEEACH, PRODUCTLINE FROM sales"))
def json_records(spark, sf):
    view = sales_view(spark, sf, ["ORDERNUMBER", "PRICEEACH", "PRODUCTLINE"])
    texts = view.select(F.to_json(F.struct("*")).alias("record"))
    from pyspark.sql import types as T

    schema = T.StructType.fromDDL("ORDERNUMBER long, PRICEEACH double, PRODUCTLINE string")
    return readers.feature_records_from_text(texts, "record", schema)


@query("a03_replaced_bytes", with_sales("SELECT 'PRODUCTLINE' AS column_name, count(*) FILTER (ORDERNUMBER % 3 = 0) AS replaced_rows FROM sales"))
def replaced_bytes(spark, sf):
    """Latin-1 text read as UTF-8: every accented row counts as replaced."""
    path = new_folder(spark, "latin")
    accented = F.when(F.col("ORDERNUMBER") % 3 == 0, F.concat("PRODUCTLINE", F.lit("é"))).otherwise(F.col("PRODUCTLINE"))
    view = sales_view(spark, sf, ["ORDERNUMBER", "PRODUCTLINE"]).select("ORDERNUMBER", accented.alias("PRODUCTLINE"))
    view.write.option("header", True).option("encoding", "ISO-8859-1").csv(path)
    return readers.replaced_text_report(readers.read_csv(spark, path, "ORDERNUMBER long, PRODUCTLINE string"))


@query(
    "a02_latin1_csv",
    with_sales("SELECT PRODUCTLINE || chr(233) AS PRODUCTLINE, count(*) AS n FROM sales GROUP BY PRODUCTLINE"),
)
def latin1_csv(spark, sf):
    path = new_folder(spark, "latin")
    view = sales_view(spark, sf, ["ORDERNUMBER", "PRODUCTLINE"])
    accented = view.withColumn("PRODUCTLINE", F.concat("PRODUCTLINE", F.lit("é")))
    accented.write.option("header", True).option("encoding", "ISO-8859-1").csv(path)
    back = readers.read_latin1_csv(spark, path, "ORDERNUMBER long, PRODUCTLINE string")
    return back.groupBy("PRODUCTLINE").agg(F.count(F.lit(1)).alias("n"))


@query(
    "a01_csv_scan",
    with_sales("SELECT ORDERNUMBER, ORDERLINENUMBER, SALES, ORDERDATE FROM sales"),
)
def csv_scan(spark, sf):
    path = new_folder(spark, "csv")
    sales_view(spark, sf, ["ORDERNUMBER", "ORDERLINENUMBER", "SALES", "ORDERDATE"]).write.option("header", True).csv(path)
    return readers.read_csv(spark, path, "ORDERNUMBER long, ORDERLINENUMBER int, SALES double, ORDERDATE date")


@query("a04_csv_date_inference", with_sales("SELECT ORDERDATE, count(*) AS n FROM sales GROUP BY ORDERDATE"))
def csv_inferred(spark, sf):
    path = new_folder(spark, "csv")
    sales_view(spark, sf, ["ORDERNUMBER", "ORDERDATE"]).write.option("header", True).csv(path)
    back = readers.read_csv(spark, path, infer_dates=True)
    return back.groupBy("ORDERDATE").agg(F.count(F.lit(1)).alias("n"))


@query("a14_importance_csv")
def importance_csv(spark, sf):
    path = new_folder(spark, "importance")
    model, _ = forest_bundle(spark, sf)
    sinks.write_importance(explain.split_importance(model.transform(split_sales(spark, sf)), model, SALES_SCHEMA), path)
    return readers.read_csv(spark, path, "feature string, importance double")


@query("a15_leaderboard_sink")
def leaderboard_sink(spark, sf):
    path = new_folder(spark, "leaderboard")
    trained(spark, sf, "all").leaderboard(spark).drop("parameters").write.option("header", True).csv(path)
    return readers.read_csv(spark, path, "rank int, model_name string, stage string, mse double, rmse double, mae double, r2 double")


@query("a17_model_round_trip")
def model_round_trip(spark, sf):
    """Largest prediction difference between a model and its reloaded copy."""
    model, _ = forest_bundle(spark, sf)
    rows = split_sales(spark, sf)
    pair = scoring.score_pair(rows, trained(spark, sf, "forest").pipeline, model, ("fitted", "reloaded"))
    return pair.agg(F.max(F.abs("prediction_delta")).alias("max_gap"), F.count(F.lit(1)).alias("n"))


@query(
    "a17_saved_raw_scorer",
    with_raw(
        """, med AS (SELECT median(try_cast(QUANTITY_TEXT AS DOUBLE)) AS q, median(MSRP) AS m, median(PRICEEACH / nullif(MSRP, 0)) AS share FROM raw),
        filled AS (SELECT DEALSIZE, coalesce(try_cast(QUANTITY_TEXT AS DOUBLE), q) AS q, coalesce(MSRP, m) AS m,
            coalesce(PRICEEACH / nullif(MSRP, 0), share) AS share, coalesce(PRODUCTLINE, 'Unknown') AS line FROM raw, med),
        scored AS (SELECT DEALSIZE, q * m * share + CASE WHEN line = 'Unknown' THEN 10 ELSE 0 END AS prediction FROM filled)
        SELECT DEALSIZE, 'conformal_intervals' AS interval_method, count(*) AS n, round(sum(prediction), 1) AS prediction,
          round(sum(prediction - 50), 1) AS p10, round(sum(prediction + 50), 1) AS p90 FROM scored GROUP BY 1"""
    ),
)
def saved_raw_scorer(spark, sf):
    """Raw rows scored by one loaded pipeline: numbers as text, missing values, a ratio, a formula model, intervals."""
    schema = FeatureSchema(("QUANTITYORDERED", "MSRP", "PRICE_SHARE"), ("PRODUCTLINE", "DEALSIZE"), "SALES")
    derived = {"PRICE_SHARE": "try_divide(PRICEEACH, MSRP)"}
    raw = raw_sales(spark, sf, ["QUANTITY_TEXT", "PRICEEACH", "MSRP", "PRODUCTLINE", "DEALSIZE"]).withColumnRenamed("QUANTITY_TEXT", "QUANTITYORDERED")
    formula = "QUANTITYORDERED * MSRP * PRICE_SHARE + IF(PRODUCTLINE = 'Unknown', 10D, 0D)"
    model = PipelineModel([SQLTransformer(statement=f"SELECT *, {formula} AS prediction FROM __THIS__")])
    whole = artifact.scoring_pipeline(model, schema, artifact.training_medians(raw, schema, derived), 50.0, derived=derived)
    path = new_folder(spark, "raw-scorer")
    whole.write().overwrite().save(path)
    scored = PipelineModel.load(path).transform(raw)
    sums = [r(F.sum(c), 1).alias(c) for c in ("prediction", "p10", "p90")]
    return scored.groupBy("DEALSIZE", "interval_method").agg(F.count(F.lit(1)).alias("n"), *sums)


# --- streams ---------------------------------------------------------------------------


@query(
    "r02_stream_daily_psi",
    """WITH ref AS (SELECT * FROM events WHERE ts < TIMESTAMP '2024-01-08'),
    e AS (SELECT quantile_cont(value, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) AS q FROM ref),
    rs AS (SELECT bin, n / sum(n) OVER () AS p FROM (SELECT len(list_filter(q, lambda x: x <= value)) AS bin, count(*) AS n
       FROM ref, e GROUP BY ALL)),
    d AS (SELECT CAST(ts AS DATE) AS day, len(list_filter(q, lambda x: x <= value)) AS bin, count(*) AS n FROM events, e GROUP BY ALL),
    t AS (SELECT day, sum(n) AS total FROM d GROUP BY day)
    SELECT t.day AS period, CAST(total AS BIGINT) AS "rows", round(sum((coalesce(d.n, 0) / total - rs.p)
      * ln((coalesce(d.n, 0) / total + 1e-8) / (rs.p + 1e-8))), 8) AS psi
    FROM t CROSS JOIN rs LEFT JOIN d ON d.day = t.day AND d.bin = rs.bin GROUP BY t.day, total""",
)
def stream_daily_psi(spark, sf):
    reference = table(spark, sf, "events").where("ts < timestamp_ntz'2024-01-08 00:00:00'")
    edges, shares = drift.reference_profile(reference, "value")
    # A day is final once a later event has moved the watermark past it: the feed ends with one of a far day.
    feed = new_folder(spark, "events")
    events = table(spark, sf, "events").select("ts", "value")
    events.write.parquet(feed)
    last = events.agg(F.max(F.col("ts").cast("timestamp")).alias("at"))
    last.select((F.col("at") + F.expr("INTERVAL 30 DAYS")).cast("timestamp_ntz").alias("ts"), F.lit(0.0).alias("value")).write.mode("append").parquet(feed)
    days = stream_drift.daily_psi(spark.readStream.schema(events.schema).parquet(feed), "value", edges, shares)
    out = new_folder(spark, "psi")
    run = (
        days.writeStream.format("parquet").outputMode("append")
        .option("checkpointLocation", new_folder(spark, "psi-checkpoint")).trigger(availableNow=True).start(out)
    )
    run.awaitTermination()
    return rounded(spark.read.schema(days.schema).parquet(out), psi=8)


@query("r01_stream_scores")
def stream_scores(spark, sf):
    feed = new_folder(spark, "feed")
    columns = list(SALES_SCHEMA.features)
    sales_view(spark, sf, columns).write.json(feed)
    records = spark.readStream.schema(SALES_SCHEMA.struct(with_target=False)).json(feed)
    primary, shadow = trained(spark, sf, "forest").pipeline, trained(spark, sf, "linear").pipeline
    out = new_folder(spark, "scored")
    run = stream_scoring.write_scored(
        records, primary, shadow, SALES_SCHEMA, out, new_folder(spark, "scored-checkpoint"), ("forest", "linear"), True
    )
    run.awaitTermination()
    schema = "features struct<PRODUCTLINE:string>, primary_prediction double, shadow_prediction double, prediction_delta double"
    return spark.read.schema(schema).json(out).groupBy("features.PRODUCTLINE").agg(
        F.count(F.lit(1)).alias("n"), F.avg("primary_prediction").alias("mean_primary"), F.avg("prediction_delta").alias("mean_delta")
    )


@query(
    "r01_stream_rejects",
    with_raw(
        """, bad AS (SELECT DEALSIZE, list_concat(CASE WHEN QUANTITY_TEXT = 'n/a' THEN ['QUANTITYORDERED'] ELSE [] END,
            CASE WHEN MSRP IS NULL THEN ['MSRP'] ELSE [] END, CASE WHEN PRODUCTLINE IS NULL THEN ['PRODUCTLINE'] ELSE [] END) AS reasons FROM raw)
        SELECT DEALSIZE, array_to_string(reasons, ' ') AS reasons, count(*) AS n FROM bad WHERE len(reasons) > 0 GROUP BY ALL"""
    ),
)
def stream_rejects(spark, sf):
    """Arriving raw records that can't be scored, by deal size and reason."""
    schema = FeatureSchema(("QUANTITYORDERED", "MSRP"), ("PRODUCTLINE", "DEALSIZE"), "SALES")
    raw = raw_sales(spark, sf, ["QUANTITY_TEXT", "MSRP", "PRODUCTLINE", "DEALSIZE"]).withColumnRenamed("QUANTITY_TEXT", "QUANTITYORDERED")
    feed, out = new_folder(spark, "feed"), new_folder(spark, "rejects")
    raw.write.parquet(feed)
    records = spark.readStream.schema(raw.schema).parquet(feed)
    stream_scoring.write_rejects(records, schema, out, new_folder(spark, "rejects-checkpoint"), True).awaitTermination()
    found = spark.read.schema("DEALSIZE string, reasons array<string>").json(out)
    return found.groupBy("DEALSIZE", F.array_join("reasons", " ").alias("reasons")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "r01_stream_intervals",
    with_sales("SELECT PRODUCTLINE, count(*) AS n, count(*) AS with_interval, 'conformal_intervals' AS interval_method FROM sales GROUP BY 1"),
)
def stream_intervals(spark, sf):
    """Arriving records with prediction and interval, counted by product line."""
    feed, out = new_folder(spark, "feed"), new_folder(spark, "predicted")
    sales_view(spark, sf, list(SALES_SCHEMA.features)).write.json(feed)
    records = spark.readStream.schema(SALES_SCHEMA.struct(with_target=False)).json(feed)
    model = trained(spark, sf, "linear").pipeline
    q_hat = evaluation.fit_conformal(model.transform(split_sales(spark, sf).where("split = 'test'")), "SALES").first()["q_hat"]
    stream_scoring.write_predictions(records, model, SALES_SCHEMA, out, new_folder(spark, "predicted-checkpoint"), q_hat, available_now=True).awaitTermination()
    found = spark.read.schema("features struct<PRODUCTLINE:string>, prediction double, p10 double, p90 double, interval_method string").json(out)
    inside = F.count_if((F.col("p10") <= F.col("prediction")) & (F.col("prediction") <= F.col("p90")))
    return found.groupBy("features.PRODUCTLINE", "interval_method").agg(F.count(F.lit(1)).alias("n"), inside.alias("with_interval")).select(
        "PRODUCTLINE", "n", "with_interval", "interval_method"
    )


@query(
    "r01_stream_three_logs",
    with_raw(
        """, seen AS (SELECT DEALSIZE, CAST(QUANTITYORDERED AS INT) * MSRP AS prediction, QUANTITYORDERED AS quantity,
            QUANTITY_TEXT = 'n/a' OR MSRP IS NULL OR PRODUCTLINE IS NULL AS rejected FROM raw)
        SELECT DEALSIZE, count(*) FILTER (NOT rejected) AS predicted, count(*) FILTER (rejected) AS rejected, count(*) FILTER (NOT rejected) AS compared,
          round(sum(prediction) FILTER (NOT rejected), 2) AS prediction, round(sum(prediction - 100) FILTER (NOT rejected), 2) AS p10,
          round(sum(quantity) FILTER (NOT rejected), 2) AS delta FROM seen GROUP BY 1"""
    ),
)
def stream_three_logs(spark, sf):
    """Arriving raw records read once for three logs, by deal size. Models are formulas, so that SQL can state every number."""
    schema = FeatureSchema(("QUANTITYORDERED", "MSRP"), ("PRODUCTLINE", "DEALSIZE"), "SALES")
    formula = lambda f: PipelineModel([SQLTransformer(statement=f"SELECT *, {f} AS prediction FROM __THIS__")])
    raw = raw_sales(spark, sf, ["QUANTITY_TEXT", "MSRP", "PRODUCTLINE", "DEALSIZE"]).withColumnRenamed("QUANTITY_TEXT", "QUANTITYORDERED")
    feed, root = new_folder(spark, "feed"), new_folder(spark, "logs")
    raw.write.parquet(feed)
    records = spark.readStream.schema(raw.schema).parquet(feed)
    primary, shadow = formula("QUANTITYORDERED * MSRP"), formula("QUANTITYORDERED * (MSRP + 1)")
    stream_scoring.write_logs(records, primary, schema, root, new_folder(spark, "logs-checkpoint"), shadow, 100.0, available_now=True).awaitTermination()
    logs = None
    for log, size, numbers in (
        ("predicted", "features.DEALSIZE", ("prediction", "p10", "NULL")),
        ("rejected", "DEALSIZE", ("NULL", "NULL", "NULL")),
        ("compared", "features.DEALSIZE", ("NULL", "NULL", "prediction_delta")),
    ):
        folder = {"predicted": stream_scoring.PREDICTIONS, "rejected": stream_scoring.REJECTS, "compared": stream_scoring.COMPARED}[log]
        values = [F.expr(f"CAST({e} AS DOUBLE)").alias(c) for e, c in zip(numbers, ("prediction", "p10", "delta"))]
        rows = spark.read.parquet(f"{root}/{folder}").select(F.lit(log).alias("log"), F.expr(size).alias("DEALSIZE"), *values)
        logs = rows if logs is None else logs.union(rows)
    counts = [F.count_if(F.col("log") == c).alias(c) for c in ("predicted", "rejected", "compared")]
    return logs.groupBy("DEALSIZE").agg(*counts, *[r(F.sum(c), 2).alias(c) for c in ("prediction", "p10", "delta")])
