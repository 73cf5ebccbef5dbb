"""Stability index per day over a stream, against fixed reference bins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salescope.functions.bins import bin_closed_left
from salescope.functions.scalar import finite
from salescope.operators.drift import ADDITIVE_EPSILON


def daily_psi(
    events: DataFrame,
    column: str,
    inner_edges: Sequence[float],
    reference_shares: Sequence[float],
    time: str = "ts",
    watermark: str = "1 day",
    window: str = "1 day",
) -> DataFrame:
    """``period, rows, psi`` per window. The state of a window is one counter per bin,
    and rows are counted map-side, so a busy day is as light as a quiet one.

    In append mode a window is final once the watermark has passed it; later rows are
    late and dropped by Spark.
    """
    bins = len(reference_shares)
    tagged = events.where(finite(F.col(column)).isNotNull()).select(
        F.col(time).cast("timestamp").alias("at"), bin_closed_left(column, inner_edges).alias("bin")
    )
    counted = (
        tagged.withWatermark("at", watermark)
        .groupBy(F.window("at", window).alias("w"))
        .agg(F.expr("count(1) AS rows"), *[F.expr(f"count_if(bin = {i}) AS b{i}") for i in range(bins)])
    )
    eps = ADDITIVE_EPSILON
    terms = [
        f"((b{i} / rows - {s!r}D) * ln((b{i} / rows + {eps!r}D) / ({s!r}D + {eps!r}D)))"
        for i, s in enumerate(float(x) for x in reference_shares)
    ]
    return counted.select(F.to_date("w.start").alias("period"), "rows", F.expr(" + ".join(terms)).alias("psi"))
