"""Queries over fitted models that state properties SQL can check: counts, sums and bounds."""

from __future__ import annotations

from pyspark.ml import Estimator, Model, Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param.shared import HasLabelCol
from pyspark.sql import functions as F

from salescope.operators import cleaning, explain, modeling, scoring
from salescope.operators.contracts import SALES_SCHEMA
from salescope.operators.modeling import Candidate
from salescope.plans.catalog import query, r, rounded, with_raw, with_sales
from salescope.plans.queries_grouped import ROW_KEY, ROW_KEY_SQL
from salescope.plans.queries_models import forest_bundle, split_sales, split_table, trained
from salescope.sources import sinks
from salescope.sources.tables import raw_sales

SPLIT_SQL = f""", split AS (SELECT *, CAST('0x' || substr(md5({ROW_KEY_SQL}), 1, 8) AS UBIGINT) % 100 < 20 AS test FROM sales)"""


@query(
    "m01_scaled_numerics",
    with_sales(
        SPLIT_SQL
        + """ SELECT CAST(i AS INT) AS position, (SELECT count(*) FROM split WHERE NOT test) AS n, 0::DOUBLE AS mean, 1::DOUBLE AS deviation
        FROM range(7) t(i)"""
    ),
)
def scaled_numerics(spark, sf):
    """Mean and deviation of every scaled numeric, over the training side."""
    rows = split_sales(spark, sf).where("split = 'train'")
    prep = Pipeline(stages=modeling.preprocessor_stages(SALES_SCHEMA)).fit(rows)
    values = prep.transform(rows).select(F.posexplode(F.slice(vector_to_array("features"), 1, len(SALES_SCHEMA.numeric))).alias("position", "x"))
    out = values.groupBy("position").agg(F.count("*").alias("n"), F.abs(F.avg("x")).alias("mean"), F.stddev_samp("x").alias("deviation"))
    return rounded(out, mean=6, deviation=6)


@query(
    "m03_linear_residuals",
    with_sales(SPLIT_SQL + " SELECT count(*) AS n, 0::DOUBLE AS mean_residual FROM split WHERE NOT test"),
)
def linear_residuals(spark, sf):
    """Residuals of least squares with an intercept add up to nothing on the training side."""
    scored = trained(spark, sf, "linear").pipeline.transform(split_sales(spark, sf).where("split = 'train'"))
    mean = F.abs(F.avg(F.col("SALES") - F.col("prediction")) / F.avg("SALES"))
    return scored.agg(F.count("*").alias("n"), r(mean, 6).alias("mean_residual"))


@query(
    "m16_interval_order",
    with_sales("SELECT 'ensemble_quantiles' AS interval_method, count(*) AS n, count(*) AS in_order FROM sales"),
)
def interval_order(spark, sf):
    """Ensemble intervals exist for every line, with their ends in order."""
    model, ensemble = forest_bundle(spark, sf)
    scored = explain.member_intervals(model.transform(split_sales(spark, sf)), ensemble)
    out = scoring.interval_cascade(scored, ensemble="ensemble")
    return out.groupBy("interval_method").agg(F.count("*").alias("n"), F.count_if(F.col("p10") <= F.col("p90")).alias("in_order"))


@query("m20_additivity", with_sales("SELECT count(*) AS n, count(*) AS additive FROM sales"))
def additivity(spark, sf):
    """Base value and contributions add up to the prediction of every line."""
    rows = split_table(spark, sf)
    model, ensemble = forest_bundle(spark, sf, rows)
    explained = explain.explain_rows(model.transform(rows), ensemble, SALES_SCHEMA)
    total = F.aggregate(F.map_values("contributions"), F.col("base_value"), lambda a, x: a + x)
    close = F.abs(total - F.col("prediction")) <= 1e-6 * (1 + F.abs(F.col("prediction")))
    return explained.agg(F.count("*").alias("n"), F.count_if(close).alias("additive"))


@query("m22_importance_sum", "SELECT 10 AS features, 1::DOUBLE AS total")
def importance_sum(spark, sf):
    """Importance by base feature adds up to one."""
    model, _ = forest_bundle(spark, sf)
    out = explain.split_importance(model.transform(split_sales(spark, sf)), model, SALES_SCHEMA)
    return out.agg(F.count("*").cast("int").alias("features"), r(F.sum("importance"), 9).alias("total"))


class MeanModel(Model):
    def __init__(self, mean: float):
        super().__init__()
        self.mean = mean

    def _transform(self, dataset):
        return dataset.withColumn("prediction", F.lit(self.mean))


class MeanRegressor(Estimator, HasLabelCol):
    """A user's own estimator: predicts the mean of the labels."""

    def setLabelCol(self, value: str) -> "MeanRegressor":
        return self._set(labelCol=value)

    def _fit(self, dataset):
        return MeanModel(dataset.agg(F.avg(self.getLabelCol())).first()[0])


@query(
    "u02_estimator_plugin",
    with_sales(
        SPLIT_SQL
        + """, mean AS (SELECT avg(SALES) AS p FROM split WHERE NOT test)
        SELECT 1 AS "rank", 'Mean' AS model_name, 'baseline' AS stage, round(sqrt(avg(pow(SALES - p, 2))), 4) AS rmse,
          round(avg(abs(SALES - p)), 4) AS mae, round(1 - avg(pow(SALES - p, 2)) / var_pop(SALES), 8) AS r2 FROM split, mean WHERE test"""
    ),
)
def estimator_plugin(spark, sf):
    """The leaderboard of a user's own estimator."""
    board = modeling.train(split_sales(spark, sf), SALES_SCHEMA, [Candidate("Mean", MeanRegressor)], "baseline").leaderboard(spark)
    return rounded(board.select("rank", "model_name", "stage", "rmse", "mae", "r2"), rmse=4, mae=4, r2=8)


@query(
    "f08_non_finite_to_null",
    with_raw("SELECT ORDERNUMBER, ORDERLINENUMBER, CASE WHEN MSRP > 0 THEN PRICEEACH / MSRP END AS RATIO FROM raw"),
)
def non_finite_to_null(spark, sf):
    """Infinite ratios, by a price of zero, leave the sink as NULL."""
    raw = cleaning.drop_columns(raw_sales(spark, sf, ["ORDERNUMBER", "ORDERLINENUMBER", "PRICEEACH", "MSRP"]), [])
    ratio = F.when(F.col("MSRP") == 0, F.lit(float("inf"))).otherwise(F.try_divide("PRICEEACH", "MSRP"))
    return sinks.json_safe(raw.select("ORDERNUMBER", "ORDERLINENUMBER", ratio.alias("RATIO")))
