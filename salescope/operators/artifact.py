"""A saved model that scores raw rows: from columns as they arrive to prediction and interval in one loaded pipeline.

What training learned beside the model (medians, interval numbers) is written into SQL stages before and after the
fitted ones, so the saved folder holds all of it and needs no code of its own to load.
"""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salescope.functions.quantiles import column_quantiles
from salescope.functions.scalar import UNKNOWN, to_number
from salescope.operators.contracts import ContractError, FeatureSchema
from salescope.operators.scoring import CONFORMAL, RESIDUAL


def training_medians(train: DataFrame, schema: FeatureSchema, derived: Mapping[str, str] | None = None) -> dict[str, float]:
    """The exact median of every numeric feature of the training rows; ``derived`` as in ``scoring_pipeline``."""
    rows = train.withColumns({c: F.expr(e) for c, e in (derived or {}).items()})
    numbers = rows.select(*[to_number(F.col(c)).alias(c) for c in schema.numeric])
    return {c: q[0] for c, q in column_quantiles(numbers, list(schema.numeric), [0.5]).items()}


def _name(column: str) -> str:
    return "`" + column.replace("`", "``") + "`"


def _double(value: float) -> str:
    return f"CAST('{float(value)!r}' AS DOUBLE)"


def _known(value: float | None) -> bool:
    return value is not None and math.isfinite(value)


def _number_sql(column: str) -> str:
    """As ``to_number``: text that is no number, and what isn't finite, is NULL."""
    value = f"try_cast({column} AS DOUBLE)"
    return f"CASE WHEN NOT isnan({value}) AND abs({value}) < CAST('Infinity' AS DOUBLE) THEN {value} END"


def _interval_sql(q_hat: float | None, residual: tuple[float, float] | None) -> list[str]:
    """As ``interval_cascade`` with these numbers: the first method that they allow; residuals that aren't finite are unknown."""
    if _known(q_hat) and q_hat >= 0:
        method, low, high = CONFORMAL, -float(q_hat), float(q_hat)
    elif residual is not None and all(map(_known, residual)):
        method, (low, high) = RESIDUAL, sorted(map(float, residual))
    else:
        return ["CAST(NULL AS DOUBLE) AS p10", "CAST(NULL AS DOUBLE) AS p90", "CAST(NULL AS STRING) AS interval_method"]
    return [
        f"prediction + {_double(low)} AS p10",
        f"prediction + {_double(high)} AS p90",
        f"CASE WHEN prediction IS NOT NULL THEN '{method}' END AS interval_method",
    ]


def scoring_pipeline(
    model: PipelineModel,
    schema: FeatureSchema,
    medians: Mapping[str, float],
    q_hat: float | None = None,
    residual: tuple[float, float] | None = None,
    derived: Mapping[str, str] | None = None,
) -> PipelineModel:
    """``model`` between stages that ready raw rows for it and add ``p10, p90, interval_method`` to its predictions.

    Numbers arrive as numbers or text; what is missing, not a number or not finite becomes the training median, a missing
    category ``Unknown``. ``derived`` names features that are SQL over raw columns, such as ratios; they are filled like
    others. Further columns pass through, the model's own working columns go. A raw column that is absent raises.
    """
    schema.check()
    missing = [c for c in schema.numeric if not _known(medians.get(c))]
    if missing:
        raise ContractError(f"no median for {missing}")
    stages = []
    if derived:
        made = ", ".join(f"{e} AS {_name(c)}" for c, e in derived.items())
        stages.append(SQLTransformer(statement=f"SELECT *, {made} FROM __THIS__"))
    filled = [f"coalesce({_number_sql(_name(c))}, {_double(medians[c])}) AS {_name(c)}" for c in schema.numeric]
    filled += [f"coalesce(CAST({_name(c)} AS STRING), '{UNKNOWN}') AS {_name(c)}" for c in schema.categorical]
    own = ", ".join(map(_name, schema.features))
    stages.append(SQLTransformer(statement=f"SELECT * EXCEPT ({own}), {', '.join(filled)} FROM __THIS__"))
    outputs = [c for s in model.stages for c in _outputs(s) if c != "prediction"]
    working = f" EXCEPT ({', '.join(map(_name, outputs))})" if outputs else ""
    interval = ", ".join(_interval_sql(q_hat, residual))
    return PipelineModel([*stages, *model.stages, SQLTransformer(statement=f"SELECT *{working}, {interval} FROM __THIS__")])


def _outputs(stage) -> list[str]:
    """The columns that a fitted stage adds."""
    if stage.hasParam("outputCols") and stage.isDefined("outputCols"):
        return list(stage.getOrDefault("outputCols"))
    for param in ("outputCol", "predictionCol"):
        if stage.hasParam(param) and stage.isDefined(param):
            return [stage.getOrDefault(param)]
    return []
