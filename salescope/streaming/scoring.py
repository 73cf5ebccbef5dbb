"""Scoring of arriving records: predictions with intervals, rejected records, and the shadow comparison.

Each can be a query of its own over the same source. ``write_logs`` reads the source once for all three.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from salescope.functions.scalar import to_number
from salescope.operators import scoring
from salescope.operators.contracts import FeatureSchema, gate
from salescope.session import held


def score_stream(records: DataFrame, pipeline: PipelineModel, schema: FeatureSchema) -> DataFrame:
    """Streaming form of the batch scoring: records that meet the contract, scored."""
    valid = gate(records, schema, require_target=False, allow_extra=True, context="stream").valid
    return pipeline.transform(valid)


def _append(df: DataFrame, path: str, checkpoint: str, available_now: bool) -> StreamingQuery:
    writer = df.writeStream.format("json").outputMode("append").option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start(path)


def write_predictions(
    records: DataFrame,
    primary: PipelineModel,
    schema: FeatureSchema,
    path: str,
    checkpoint: str,
    q_hat: float | None = None,
    residual: tuple[float, float] | None = None,
    available_now: bool = False,
) -> StreamingQuery:
    """Append features, prediction, ``p10, p90`` and ``interval_method`` of every record that meets the contract."""
    scored = scoring.interval_cascade(score_stream(records, primary, schema), q_hat, residual)
    features = F.struct(*schema.features).alias("features")
    return _append(scored.select(features, "prediction", "p10", "p90", "interval_method"), path, checkpoint, available_now)


def _reasons(schema: FeatureSchema) -> Column:
    """The columns at fault; none where a record meets the contract."""
    checks = [F.when(to_number(F.col(c)).isNull(), F.lit(c)) for c in schema.numeric]
    checks += [F.when(F.col(c).isNull(), F.lit(c)) for c in schema.categorical]
    return F.array_compact(F.array(*checks))


def rejects(records: DataFrame, schema: FeatureSchema) -> DataFrame:
    """Records that don't meet the contract, as they came, with the columns at fault in ``reasons``."""
    broken = gate(records, schema, require_target=False, allow_extra=True, context="stream").rejects
    return broken.withColumn("reasons", _reasons(schema))


def write_rejects(records: DataFrame, schema: FeatureSchema, path: str, checkpoint: str, available_now: bool = False) -> StreamingQuery:
    """Append every rejected record with its reasons, so that none is lost."""
    return _append(rejects(records, schema), path, checkpoint, available_now)


def write_scored(
    records: DataFrame,
    primary: PipelineModel,
    shadow: PipelineModel,
    schema: FeatureSchema,
    path: str,
    checkpoint: str,
    names: tuple[str, str] = ("primary", "shadow"),
    available_now: bool = False,
) -> StreamingQuery:
    """Append the comparison log of every arriving record to a JSON-lines folder.

    The file sink commits each micro-batch once, so a restart repeats no record.
    """
    valid = gate(records, schema, require_target=False, allow_extra=True, context="stream").valid
    log = scoring.shadow_log(scoring.score_pair(valid, primary, shadow, names), schema)
    return _append(log, path, checkpoint, available_now)


# --- one read, three logs -------------------------------------------------------------

PREDICTIONS, REJECTS, COMPARED, BATCHES = "predictions", "rejects", "compared", "batches"


def _batch_folder(root: str, log: str, number: int) -> str:
    return f"{root}/{log}/batch_id={number}"


def compare_batch(
    spark: SparkSession, root: str, number: int, shadow: PipelineModel, schema: FeatureSchema, names: tuple[str, str] = ("primary", "shadow")
) -> None:
    """Write the comparison log of a batch from its written predictions; also for batches whose shadow failed."""
    first = spark.read.parquet(_batch_folder(root, PREDICTIONS, number))
    first = first.select("features.*", F.col("prediction").alias("primary_prediction"))
    both = shadow.transform(first).withColumnRenamed("prediction", "shadow_prediction")
    named = {"primary_model_name": F.lit(names[0]), "shadow_model_name": F.lit(names[1])}
    both = scoring.shadow_delta(both, "primary_prediction", "shadow_prediction").withColumns(named)
    scoring.shadow_log(both, schema).write.mode("overwrite").parquet(_batch_folder(root, COMPARED, number))


def log_batch(
    rows: DataFrame,
    number: int,
    primary: PipelineModel,
    shadow: PipelineModel | None,
    schema: FeatureSchema,
    root: str,
    q_hat: float | None = None,
    residual: tuple[float, float] | None = None,
    names: tuple[str, str] = ("primary", "shadow"),
) -> None:
    """Gate and score one micro-batch once, and write what came of it under ``root``.

    The source is read once, into a copy that says for every record which columns are at fault. Predictions are
    written first and the comparison is made from them. Folders bear the batch's number and are overwritten, so a
    batch that runs again repeats nothing. Last comes a row in ``batches`` with the counts; an error
    of the shadow model is noted there (``shadow_error``) and stops nothing.
    """
    spark = rows.sparkSession
    folder = {log: _batch_folder(root, log, number) for log in (PREDICTIONS, REJECTS, COMPARED, BATCHES)}
    with held(rows.withColumn("reasons", _reasons(schema)), "batch") as checked:
        good = checked.where(F.size("reasons") == 0).drop("reasons")
        scored = scoring.interval_cascade(score_stream(good, primary, schema), q_hat, residual)
        features = F.struct(*schema.features).alias("features")
        scored.select(features, "prediction", "p10", "p90", "interval_method").write.mode("overwrite").parquet(folder[PREDICTIONS])
        checked.where(F.size("reasons") > 0).write.mode("overwrite").parquet(folder[REJECTS])
    error = None
    if shadow is not None:
        try:
            compare_batch(spark, root, number, shadow, schema, names)
        except Exception as e:  # whatever the shadow model does, predictions go on
            error = str(e).split("\n")[0]
    done = [PREDICTIONS, REJECTS, *([COMPARED] if shadow is not None and error is None else [])]
    counts = {log: spark.read.parquet(folder[log]).count() for log in done}
    state = [(counts[PREDICTIONS] + counts[REJECTS], counts[PREDICTIONS], counts[REJECTS], counts.get(COMPARED), error)]
    spark.createDataFrame(state, "records long, predicted long, rejected long, compared long, shadow_error string").coalesce(1).write.mode(
        "overwrite"
    ).parquet(folder[BATCHES])


def write_logs(
    records: DataFrame,
    primary: PipelineModel,
    schema: FeatureSchema,
    root: str,
    checkpoint: str,
    shadow: PipelineModel | None = None,
    q_hat: float | None = None,
    residual: tuple[float, float] | None = None,
    names: tuple[str, str] = ("primary", "shadow"),
    available_now: bool = False,
) -> StreamingQuery:
    """Predictions with intervals, rejected records and the shadow comparison of a stream, from one read of it.

    Parquet folders under ``root``: ``predictions``, ``rejects``, ``compared`` and ``batches``, each with a
    folder for every micro-batch.
    """

    def write(rows: DataFrame, number: int) -> None:
        log_batch(rows, number, primary, shadow, schema, root, q_hat, residual, names)

    writer = records.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()
