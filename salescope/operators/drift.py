"""Drift between a reference and a current table.

All features are handled in one job. Empirical distributions rest on one count of both tables
by distinct value, which is dealt into ranges of values in their order; the ranges' totals give every
range its offset, so running sums span a range only, and the number of ranges follows the number of values.
Rows never leave the executors.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salescope.functions.bins import bin_closed_left, bin_equal_width
from salescope.functions.quantiles import column_quantiles, linear_rank
from salescope.functions.scalar import finite, to_number, utc_now_text
from salescope.operators.profiling import is_numeric, value_range
from salescope.session import held, local, materialize


def two_samples(reference: DataFrame, current: DataFrame, features: Sequence[str]) -> DataFrame:
    """Both tables under one another with ``is_current`` 0 / 1; values finite or NULL."""

    def tagged(df: DataFrame, flag: int) -> DataFrame:
        return df.select(F.lit(flag).alias("is_current"), *[to_number(F.col(c)).alias(c) for c in features])

    return tagged(reference, 0).unionByName(tagged(current, 1))


def _long(both: DataFrame, features: Sequence[str]) -> DataFrame:
    return both.unpivot(["is_current"], list(features), "feature", "value").where(F.col("value").isNotNull())


def _sides() -> list[Column]:
    return [
        F.count_if(F.col("is_current") == 0).alias("ref"),
        F.count_if(F.col("is_current") == 1).alias("cur"),
    ]


def _shares(counts: DataFrame) -> DataFrame:
    """Adds totals and shares per feature to bin or value counts."""
    totals = counts.groupBy("feature").agg(F.sum("ref").alias("n_reference"), F.sum("cur").alias("n_current"))
    return counts.join(F.broadcast(totals), "feature").select(  # one row per feature
        "*",
        (F.col("ref") / F.greatest("n_reference", F.lit(1))).alias("ref_share"),
        (F.col("cur") / F.greatest("n_current", F.lit(1))).alias("cur_share"),
    )


# Smoothing of empty bins in the two forms of the index.
ADDITIVE_EPSILON = 1e-8
CLIP_EPSILON = 1e-6


def psi_bins(reference: DataFrame, current: DataFrame, features: Sequence[str], bins: int = 10) -> DataFrame:
    """Counts and shares per feature and reference-quantile bin, outer bins open."""
    with held(two_samples(reference, current, features)) as both:
        return local(_psi_bins(both, features, bins))  # features x bins rows


def _psi_bins(both: DataFrame, features: Sequence[str], bins: int = 10) -> DataFrame:
    if bins < 2:
        raise ValueError("bins must be at least 2")
    probs = [i / bins for i in range(1, bins)]
    edges = column_quantiles(both.where("is_current = 0"), features, probs, hold=False)
    usable = [c for c in features if edges[c][0] is not None]
    if usable:
        binned = both.select(
            "is_current", *[F.when(F.col(c).isNotNull(), bin_closed_left(c, edges[c])).alias(c) for c in usable]
        ).unpivot(["is_current"], usable, "feature", "bin")
    else:
        binned = both.sparkSession.createDataFrame([], "is_current int, feature string, bin int")
    return _shares(binned.where("bin IS NOT NULL").groupBy("feature", "bin").agg(*_sides()))


def psi(reference: DataFrame, current: DataFrame, features: Sequence[str], bins: int = 10) -> DataFrame:
    """``feature, psi``: stability index on reference quantile bins.

    A feature without finite values in one of the tables has no row.
    """
    return _psi(psi_bins(reference, current, features, bins))


def _psi(shares: DataFrame) -> DataFrame:
    eps = ADDITIVE_EPSILON
    term = f"(cur_share - ref_share) * ln((cur_share + {eps!r}D) / (ref_share + {eps!r}D))"
    return shares.where("n_current > 0").groupBy("feature").agg(F.expr(f"sum({term}) AS psi"))


def psi_equal_width(reference: DataFrame, current: DataFrame, column: str, bins: int = 10) -> DataFrame:
    """Per-bin table on equal-width reference bins; values outside them are left out.

    Every bin has a row; ``psi_total`` repeats the sum.
    """
    ref = reference.select(F.lit(0).alias("is_current"), finite(F.col(column)).alias("v"))
    cur = current.select(F.lit(1).alias("is_current"), finite(F.col(column)).alias("v"))
    ends = value_range(ref, "v")
    if ends is None:
        raise ValueError("the reference has no finite value")
    counts = (
        ref.unionByName(cur)
        .where(F.col("v").isNotNull())
        .select("is_current", bin_equal_width(F.col("v"), *ends, bins).alias("bin"))
        .where(F.col("bin").isNotNull())
        .groupBy("bin")
        .agg(*_sides())
    )
    every = reference.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    whole = Window.partitionBy(F.lit(0))  # one row per bin
    shares = every.join(F.broadcast(counts), "bin", "left").select(
        "bin",
        F.coalesce("ref", F.lit(0)).alias("ref"),
        F.coalesce("cur", F.lit(0)).alias("cur"),
    )
    props = shares.select(
        "bin",
        *[
            F.greatest(
                F.col(s) / F.greatest(F.sum(s).over(whole), F.lit(1)), F.lit(CLIP_EPSILON)
            ).alias(f"{s}_prop")
            for s in ("ref", "cur")
        ],
    )
    term = (F.col("cur_prop") - F.col("ref_prop")) * F.ln(F.col("cur_prop") / F.col("ref_prop"))
    return props.withColumn("psi_bin", term).withColumn("psi_total", F.sum("psi_bin").over(whole))


# Distinct values in a range, about: what one task sorts for a running sum.
RANGE_ROWS = 100_000


@dataclass(frozen=True)
class Ranged:
    """Both tables counted by distinct value, in ranges: ``feature, value, ref, cur, range``; and
    per feature and range its totals, what lies before it, and the features' totals."""

    values: DataFrame
    totals: DataFrame

    def features(self) -> DataFrame:
        """Sizes of the features that have values in both tables."""
        return self.totals.groupBy("feature").agg(F.max("n_reference").alias("n_reference"), F.max("n_current").alias("n_current"))


def _counted(both: DataFrame, features: Sequence[str]) -> DataFrame:
    return _long(both, features).groupBy("feature", "value").agg(*_sides())


def _totals(values: DataFrame) -> DataFrame:
    run = Window.partitionBy("feature").orderBy("range")
    whole = Window.partitionBy("feature")
    sums = values.groupBy("feature", "range").agg(F.sum("ref").alias("ref"), F.sum("cur").alias("cur"), F.min("value").alias("first_value"))
    return sums.select(
        "feature",
        "range",
        F.sum("ref").over(run).alias("ref_upto"),
        F.sum("cur").over(run).alias("cur_upto"),
        (F.sum("ref").over(run) - F.col("ref")).alias("ref_before"),
        (F.sum("cur").over(run) - F.col("cur")).alias("cur_before"),
        F.sum("ref").over(whole).alias("n_reference"),
        F.sum("cur").over(whole).alias("n_current"),
        F.lead("first_value").over(run).alias("next_first"),
    ).where("n_reference > 0 and n_current > 0")


def _in_ranges(counted: DataFrame, range_rows: int) -> DataFrame:
    """``counted`` with the number of its range of about ``range_rows`` values; numbers rise with feature and value."""
    ranges = max(1, math.ceil(counted.count() / range_rows))
    if ranges == 1:
        return counted.withColumn("range", F.lit(0))
    return counted.repartitionByRange(ranges, "feature", "value").withColumn("range", F.spark_partition_id())


@contextmanager
def ranged(reference: DataFrame, current: DataFrame, features: Sequence[str], range_rows: int = RANGE_ROWS):
    """The two tables counted and ranged, for the measures made inside the block: one scan of each table."""
    with held(_counted(two_samples(reference, current, features), features), "counted") as counted:
        with held(_in_ranges(counted, range_rows), "ranged") as values, held(_totals(values), "totals") as totals:
            yield Ranged(values, totals)


def _cdf_inside(values: DataFrame, ranges: DataFrame) -> DataFrame:
    """Both empirical CDFs at every value of the given ranges, whose offsets ``ranges`` holds."""
    order = Window.partitionBy("feature", "range").orderBy("value")
    return values.join(ranges, ["feature", "range"]).select(
        "feature",
        "value",
        F.coalesce(F.lead("value").over(order), "next_first").alias("next_value"),
        ((F.col("ref_before") + F.sum("ref").over(order)) / F.col("n_reference")).alias("ref_cdf"),
        ((F.col("cur_before") + F.sum("cur").over(order)) / F.col("n_current")).alias("cur_cdf"),
    )


def empirical_cdf(reference: DataFrame, current: DataFrame, features: Sequence[str], range_rows: int = RANGE_ROWS) -> DataFrame:
    """``feature, value, next_value, ref_cdf, cur_cdf`` at every distinct value."""
    counted = materialize(_counted(two_samples(reference, current, features), features), "counted")
    values = materialize(_in_ranges(counted, range_rows), "ranged")
    return _cdf_inside(values, _totals(values))


def ks_statistic(reference: DataFrame, current: DataFrame, features: Sequence[str], range_rows: int = RANGE_ROWS) -> DataFrame:
    """``feature, statistic, n_reference, n_current``: the exact two-sample statistic."""
    with ranged(reference, current, features, range_rows) as both:
        return local(_ks(both))  # one row per feature


def _ks(both: Ranged) -> DataFrame:
    """The CDF gap at the ends of ranges is a lower bound; inside a range the gap cannot exceed
    what its rows allow. Only ranges that can beat the lower bound are looked into.
    """
    at_end = F.abs(F.col("ref_upto") / F.col("n_reference") - F.col("cur_upto") / F.col("n_current"))
    most = F.greatest(
        F.col("ref_upto") / F.col("n_reference") - F.col("cur_before") / F.col("n_current"),
        F.col("cur_upto") / F.col("n_current") - F.col("ref_before") / F.col("n_reference"),
    )
    bounds = both.totals.withColumn("lower", F.max(at_end).over(Window.partitionBy("feature")))
    inside = _cdf_inside(both.values, bounds.where(most > F.col("lower")).drop("lower"))
    gaps = inside.select("feature", F.abs(F.col("ref_cdf") - F.col("cur_cdf")).alias("gap"))
    ends = bounds.select("feature", "lower")
    largest = gaps.union(ends).groupBy("feature").agg(F.max("gap").alias("statistic"))
    return largest.join(both.features(), "feature")


def _reference_edges(both: Ranged, probs: Sequence[float]) -> DataFrame:
    """``feature, edges``: interpolated quantiles of the reference, from the counts."""
    rules = [linear_rank(p).format(n="n_reference") for p in probs]
    slots = ", ".join(
        f"named_struct('slot', {2 * i + j}, 'k', CAST({side}({rule}) AS BIGINT))" for i, rule in enumerate(rules) for j, side in enumerate(("floor", "ceil"))
    )
    asked = both.totals.withColumn("slots", F.expr(f"filter(array({slots}), s -> s.k >= ref_before AND s.k < ref_upto)")).where("size(slots) > 0")
    order = Window.partitionBy("feature", "range").orderBy("value")
    upto = F.col("ref_before") + F.sum("ref").over(order)
    rows = both.values.join(asked.select("feature", "range", "ref_before", "n_reference", "slots"), ["feature", "range"]).withColumn("upto", upto)
    found = rows.selectExpr("feature", "n_reference", "value", "inline(filter(slots, s -> s.k >= upto - ref AND s.k < upto))")
    wide = found.groupBy("feature", "n_reference").agg(*[F.max(F.when(F.col("slot") == i, F.col("value"))).alias(f"s{i}") for i in range(2 * len(rules))])
    blended = ", ".join(f"s{2 * i} + (s{2 * i + 1} - s{2 * i}) * ({rule} - floor({rule}))" for i, rule in enumerate(rules))
    return wide.selectExpr("feature", f"array({blended}) AS edges")


def _psi_of_counts(both: Ranged, bins: int = 10) -> DataFrame:
    """``feature, psi`` from the counts by value."""
    edges = local(_reference_edges(both, [i / bins for i in range(1, bins)]))  # one row per feature
    binned = both.values.join(edges, "feature").withColumn("bin", F.expr("size(filter(edges, e -> e <= value))"))
    return _psi(_shares(binned.groupBy("feature", "bin").agg(F.sum("ref").alias("ref"), F.sum("cur").alias("cur"))))


def kolmogorov_p_value(statistic: Column, effective_n: Column, terms: int = 100) -> Column:
    """Tail probability by the alternating series, clipped to [0, 1]."""
    scaled = (effective_n + F.lit(0.12) + F.lit(0.11) / effective_n) * statistic
    series = F.aggregate(
        F.sequence(F.lit(1), F.lit(terms)),
        F.lit(0.0),
        lambda acc, i: acc
        + F.when(i % 2 == 1, 1.0).otherwise(-1.0) * F.exp(F.lit(-2.0) * (i * i).cast("double") * scaled * scaled),
    )
    return F.when(statistic <= 0, 1.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), 2.0 * series)))


def ks_test(
    reference: DataFrame, current: DataFrame, features: Sequence[str], alpha: float = 0.05, range_rows: int = RANGE_ROWS
) -> DataFrame:
    """Statistic, p-value, critical value and decision per feature."""
    if not 0 < alpha < 1:
        raise ValueError("alpha must be between 0 and 1")
    return _ks_decision(ks_statistic(reference, current, features, range_rows), alpha)


def _ks_decision(statistics: DataFrame, alpha: float) -> DataFrame:
    n, m = F.col("n_reference").cast("double"), F.col("n_current").cast("double")
    return (
        statistics.withColumn("effective_n", F.sqrt(n * m / (n + m)))
        .select(
            "feature",
            "statistic",
            kolmogorov_p_value(F.col("statistic"), F.col("effective_n")).alias("p_value"),
            F.lit(alpha).alias("alpha"),
            (F.lit(math.sqrt(-0.5 * math.log(alpha / 2.0))) / F.col("effective_n")).alias("critical_value"),
            "n_reference",
            "n_current",
        )
        .withColumn("drift_detected", F.col("statistic") > F.col("critical_value"))
    )


def drift_summary(
    reference: DataFrame,
    current: DataFrame,
    features: Sequence[str],
    psi_threshold: float = 0.2,
    ks_alpha: float = 0.05,
    range_rows: int = RANGE_ROWS,
) -> DataFrame:
    """Per feature: stability index, KS test and whether it drifted; empty ones left out.

    Both rest on the same counts: bin edges are ranks among them, bins are sums of them.
    """
    with ranged(reference, current, features, range_rows) as both:
        return local(_drift_summary(both, psi_threshold, ks_alpha))  # one row per feature


def _drift_summary(both: Ranged, psi_threshold: float, ks_alpha: float) -> DataFrame:
    return (
        _ks_decision(_ks(both), ks_alpha)
        .join(_psi_of_counts(both), "feature")
        .withColumn("drifted", (F.col("psi") >= psi_threshold) | F.col("drift_detected"))
    )


def drift_alert(summary: DataFrame, alert_ratio: float = 0.3, project: str | None = None) -> DataFrame:
    """One row: number and share of drifted features and the alert flag."""
    row = summary.agg(
        F.count(F.lit(1)).alias("features"),
        F.count_if("drifted").alias("drifted_features"),
        F.coalesce(F.avg(F.col("drifted").cast("double")), F.lit(0.0)).alias("drift_ratio"),
    ).withColumn("alert", F.col("drift_ratio") >= F.lit(alert_ratio))
    if project is None:
        return row
    return row.select(F.lit(project).alias("project_name"), utc_now_text().alias("generated_at"), "*")


def wasserstein(reference: DataFrame, current: DataFrame, features: Sequence[str], range_rows: int = RANGE_ROWS) -> DataFrame:
    """First Wasserstein distance per numeric feature: area between the two CDFs."""
    with ranged(reference, current, features, range_rows) as both:
        return local(_area(both))  # one row per feature


def _area(both: Ranged) -> DataFrame:
    return _cdf_inside(both.values, both.totals).groupBy("feature").agg(
        F.expr("coalesce(sum(abs(ref_cdf - cur_cdf) * (next_value - value)), 0D) AS wasserstein")
    )


def category_shares(reference: DataFrame, current: DataFrame, features: Sequence[str]) -> DataFrame:
    """Counts and shares of every category in both tables."""

    def tagged(df: DataFrame, flag: int) -> DataFrame:
        return df.select(F.lit(flag).alias("is_current"), *[F.col(c).cast("string").alias(c) for c in features])

    both = tagged(reference, 0).unionByName(tagged(current, 1))
    return _shares(_long(both, features).groupBy("feature", "value").agg(*_sides()))


def category_distances(reference: DataFrame, current: DataFrame, features: Sequence[str]) -> DataFrame:
    """Jensen-Shannon distance (base 2) and stability index per text feature."""
    p, q = F.col("ref_share"), F.col("cur_share")
    mid = (p + q) / 2
    part = F.when(p > 0, p * F.log2(p / mid)).otherwise(0.0) + F.when(q > 0, q * F.log2(q / mid)).otherwise(0.0)
    eps = F.lit(ADDITIVE_EPSILON)
    return category_shares(reference, current, features).groupBy("feature").agg(
        F.sqrt(F.greatest(F.lit(0.0), F.sum(part) / 2)).alias("jensen_shannon"),
        F.sum((q - p) * F.ln((q + eps) / (p + eps))).alias("psi"),
    )


def column_drift_report(
    reference: DataFrame, current: DataFrame, features: Sequence[str], threshold: float = 0.1, range_rows: int = RANGE_ROWS
) -> DataFrame:
    """Per column: distance, method and decision, with the share of drifted columns.

    Numeric columns use the Wasserstein distance in units of the reference's standard
    deviation, text columns the Jensen-Shannon distance.
    """
    numeric = [c for c in features if is_numeric(reference, c)]
    text = [c for c in features if c not in numeric]
    parts = []
    if numeric:
        spread = reference.agg(*[F.stddev_pop(finite(F.col(c))).alias(c) for c in numeric]).unpivot(
            [], numeric, "feature", "std"
        )
        parts.append(
            wasserstein(reference, current, numeric, range_rows)
            .join(F.broadcast(spread), "feature")
            .select(
                "feature",
                F.lit("wasserstein_normed").alias("method"),
                F.coalesce(F.try_divide("wasserstein", "std"), F.col("wasserstein")).alias("distance"),
            )
        )
    if text:
        parts.append(
            category_distances(reference, current, text).select(
                "feature", F.lit("jensen_shannon").alias("method"), F.col("jensen_shannon").alias("distance")
            )
        )
    table = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    flagged = table.withColumn("drifted", F.col("distance") >= threshold)
    whole = Window.partitionBy(F.lit(0))  # one row per column
    return flagged.withColumn("drifted_share", F.avg(F.col("drifted").cast("double")).over(whole))


def psi_per_period(
    df: DataFrame, period: Column, column: str, inner_edges: Sequence[float], reference_shares: Sequence[float]
) -> DataFrame:
    """Stability index of each period against fixed reference edges and shares."""
    counts = (
        df.where(finite(F.col(column)).isNotNull())
        .groupBy(period.alias("period"), bin_closed_left(column, inner_edges).alias("bin"))
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    return psi_from_counts(counts, reference_shares)


def psi_from_counts(counts: DataFrame, reference_shares: Sequence[float]) -> DataFrame:
    """``period, bin, rows`` to ``period, rows, psi``; bins without rows count as empty."""
    shares = F.array(*[F.lit(float(s)) for s in reference_shares])
    per_bin = F.map_from_entries(F.collect_list(F.struct("bin", "rows")))
    grouped = counts.groupBy("period").agg(per_bin.alias("by_bin"), F.sum("rows").alias("rows"))

    def term(i: Column) -> Column:
        c = F.coalesce(F.try_element_at("by_bin", i), F.lit(0)) / F.col("rows")
        r = F.get(shares, i)
        eps = F.lit(ADDITIVE_EPSILON)
        return (c - r) * F.ln((c + eps) / (r + eps))

    bins = F.sequence(F.lit(0), F.lit(len(reference_shares) - 1))
    return grouped.select(
        "period", "rows", F.aggregate(F.transform(bins, term), F.lit(0.0), lambda a, t: a + t).alias("psi")
    )


def reference_profile(df: DataFrame, column: str, bins: int = 10) -> tuple[list[float], list[float]]:
    """Inner quantile edges and bin shares of a reference table."""
    inner = column_quantiles(df, [column], [i / bins for i in range(1, bins)])[column]
    rows = (
        df.where(finite(F.col(column)).isNotNull())
        .groupBy(bin_closed_left(column, inner).alias("bin"))
        .count()
        .collect()
    )
    total = sum(r["count"] for r in rows)
    by_bin = {r["bin"]: r["count"] for r in rows}
    return inner, [by_bin.get(i, 0) / total for i in range(bins)]
