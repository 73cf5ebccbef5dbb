"""Column profiles, correlations and the numbers behind the plots."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salescope.functions.bins import bin_equal_width
from salescope.functions.hashing import fingerprint
from salescope.functions.quantiles import exact_quantiles, null_safe_join
from salescope.functions.scalar import finite, flag_iqr
from salescope.session import held, local


def is_numeric(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, T.NumericType)


def _numbers(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*[finite(F.col(c)).alias(c) for c in columns])


def _corr(a: str, b: str) -> Column:
    """Pearson's correlation; NULL where a column is constant, where ``corr`` divides by zero under ANSI rules."""
    return F.signum(F.covar_pop(a, b)) * F.sqrt(F.regr_r2(a, b))


def _basic(numbers: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One pass: counts, missing share, moments and range per column."""
    parts = [
        F.expr(
            f"named_struct('feature', '{c}', 'row_count', count(1), 'n', count(`{c}`), 'mean', avg(`{c}`), "
            f"'std', stddev_pop(`{c}`), 'std_sample', stddev_samp(`{c}`), 'min', min(`{c}`), 'max', max(`{c}`)) AS `{c}`"
        )
        for c in columns
    ]
    wide = numbers.agg(*parts)
    return wide.select(F.inline(F.array(*columns))).withColumn(
        "missing_ratio", F.expr("CASE WHEN row_count > 0 THEN 1 - n / row_count ELSE 0D END")
    )


def _numeric_table(df: DataFrame, columns: Sequence[str], probs: dict[str, float], unique: bool = False) -> DataFrame:
    """Moments, quantiles and, if asked, distinct counts: one row per column.

    The columns are held for the passes, so what lies upstream runs once.
    """
    with held(_numbers(df, columns)) as numbers:
        q = exact_quantiles(numbers, columns, list(probs.values()), hold=False).selectExpr(
            "feature", *[f"values[{i}] AS {name}" for i, name in enumerate(probs)]
        )
        out = _basic(numbers, columns).join(F.broadcast(q), "feature")
        if unique:
            counts = F.broadcast(distinct_counts(numbers, columns))  # one row per column
            out = out.join(counts, "feature", "left")
        return local(out)


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, sample deviation, range and quartiles, one row per column."""
    return _numeric_table(df, columns, {"q25": 0.25, "q50": 0.5, "q75": 0.75}).selectExpr(
        "feature", "n AS count", "mean", "std_sample AS std", "min", "q25", "q50", "q75", "max"
    )


def distinct_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Exact number of distinct entries per column; one shuffle for all columns.

    Numbers that a double holds exactly are compared as such, anything else as text.
    """
    exact = (T.DoubleType, T.FloatType, T.IntegerType, T.ShortType, T.ByteType)
    kind = "double" if all(isinstance(df.schema[c].dataType, exact) for c in columns) else "string"
    texts = df.select(*[F.col(c).cast(kind).alias(c) for c in columns])
    return (
        texts.unpivot([], list(columns), "feature", "value")
        .where(F.col("value").isNotNull())
        .distinct()
        .groupBy("feature")
        .agg(F.count(F.lit(1)).alias("unique_count"))
    )


def numeric_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    probs = {"q05": 0.05, "q25": 0.25, "q50": 0.5, "q75": 0.75, "q95": 0.95}
    types = {c: df.schema[c].dataType.simpleString() for c in columns}
    return _numeric_table(df, columns, probs, unique=True).select(
        "feature",
        _type_name(types).alias("dtype"),
        (F.col("row_count") - F.col("n")).alias("missing_count"),
        "missing_ratio",
        F.coalesce("unique_count", F.lit(0)).alias("unique_count"),
        "mean", "std", "min", "max", *probs,
    )


def _type_name(types: dict[str, str]) -> Column:
    out = F.lit(None).cast("string")
    for c, t in types.items():
        out = F.when(F.col("feature") == c, t).otherwise(out)
    return out


def _value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``feature, value, rows``, missing entries as a NULL value; counted map-side first."""
    texts = df.select(*[F.col(c).cast("string").alias(c) for c in columns])
    return texts.unpivot([], list(columns), "feature", "value").groupBy("feature", "value").agg(F.count(F.lit(1)).alias("rows"))


def _value_stats(counts: DataFrame) -> DataFrame:
    """One row per feature: all rows, those with a value, and different values."""
    return counts.groupBy("feature").agg(
        F.sum("rows").alias("row_count"),
        F.coalesce(F.sum(F.when(F.col("value").isNotNull(), F.col("rows"))), F.lit(0)).alias("n"),
        F.count("value").alias("unique_count"),
    )


def _ranked_shares(counts: DataFrame, top: int | None) -> DataFrame:
    order = Window.partitionBy("feature").orderBy(F.desc("rows"), "value")
    ranked = counts.where(F.col("value").isNotNull()).withColumn("rank", F.row_number().over(order))
    if top is not None:
        ranked = ranked.where(F.col("rank") <= top)
    totals = F.broadcast(_value_stats(counts).select("feature", "n"))
    return ranked.join(totals, "feature").select("feature", "value", "rows", (F.col("rows") / F.col("n")).alias("ratio"), "rank")


def value_shares(df: DataFrame, columns: Sequence[str], top: int | None = None) -> DataFrame:
    """``feature, value, rows, ratio, rank``: share among the non-missing entries.

    The source is read once; the rank filter lets Spark cut each partition to its own
    top entries before the window's shuffle.
    """
    return _ranked_shares(_value_counts(df, columns), top)


def categorical_profile(df: DataFrame, columns: Sequence[str], top: int = 10) -> DataFrame:
    return value_shares(df, columns, top)


def numeric_distribution(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, missing share, moments, range and p10/p50/p90; empty column: count 0, missing 1."""
    return _numeric_table(df, columns, {"p10": 0.1, "p50": 0.5, "p90": 0.9}).selectExpr(
        "feature",
        "'numeric' AS type",
        "n AS count",
        "CASE WHEN n = 0 THEN 1D ELSE missing_ratio END AS missing_ratio",
        "mean", "std", "min", "p10", "p50", "p90", "max",
    )


def categorical_distribution(df: DataFrame, columns: Sequence[str], top: int = 5) -> DataFrame:
    """Count, distinct count, missing share and the top values with their shares, all from one count of the values."""
    counts = _value_counts(df, columns)
    names = df.sparkSession.createDataFrame([(c,) for c in columns], "feature string")
    tops = (
        _ranked_shares(counts, top)
        .groupBy("feature")
        .agg(F.sort_array(F.collect_list(F.struct("rank", "value", "ratio"))).alias("ranked"))
        .select("feature", F.transform("ranked", lambda r: F.struct(r["value"], r["ratio"])).alias("top_values"))
    )
    n = F.coalesce("n", F.lit(0))
    return (
        names.join(F.broadcast(_value_stats(counts)), "feature", "left")
        .join(F.broadcast(tops), "feature", "left")
        .select(
            "feature",
            F.lit("categorical").alias("type"),
            n.alias("count"),
            F.coalesce("unique_count", F.lit(0)).alias("unique"),
            F.when(n == 0, 1.0).otherwise(1 - n / F.col("row_count")).alias("missing_ratio"),
            "top_values",
        )
    )


def distribution_summary(df: DataFrame, features: Sequence[str], top: int = 5) -> DataFrame:
    """One row per listed feature, whichever its type; absent ones are ``present = false``."""
    if top < 1:
        raise ValueError("top must be at least 1")
    present = [c for c in features if c in df.columns]
    numeric = [c for c in present if is_numeric(df, c)]
    text = [c for c in present if c not in numeric]
    absent = [c for c in features if c not in df.columns]
    parts = []
    if numeric:
        parts.append(numeric_distribution(df, numeric).withColumn("present", F.lit(True)))
    if text:
        parts.append(categorical_distribution(df, text, top).withColumn("present", F.lit(True)))
    if absent:
        parts.append(
            df.sparkSession.createDataFrame(
                [(c, "missing", 0, 1.0, False) for c in absent],
                "feature string, type string, count long, missing_ratio double, present boolean",
            )
        )
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def distribution_log(reference: DataFrame, current: DataFrame, features: Sequence[str], top: int = 5) -> DataFrame:
    """Both summaries side by side per feature (``reference`` and ``current`` structs)."""
    pair = []
    for name, df in (("reference", reference), ("current", current)):
        summary = distribution_summary(df, features, top)
        pair.append(summary.select("feature", F.struct(*[c for c in summary.columns if c != "feature"]).alias(name)))
    return pair[0].join(pair[1], "feature", "full")


def target_correlations(df: DataFrame, features: Sequence[str], target: str) -> DataFrame:
    """Pearson correlation with the target over complete pairs; undefined ones left out."""
    d = _numbers(df, list(dict.fromkeys([*features, target])))
    wide = d.agg(*[_corr(f, target).alias(f"c_{i}") for i, f in enumerate(features)])
    rows = [F.struct(F.lit(f).alias("feature"), F.col(f"c_{i}").alias("correlation")) for i, f in enumerate(features)]
    return wide.select(F.inline(F.array(*rows))).where(finite(F.col("correlation")).isNotNull())


def sorted_correlations(df: DataFrame, features: Sequence[str], target: str) -> DataFrame:
    return target_correlations(df, features, target).orderBy(F.desc(F.abs("correlation")), "feature")


PAIR_LIMIT = 2_000  # pairs that are one aggregate each; wider tables go by blocks
BLOCK_COLUMNS = 256


def correlation_matrix(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Long matrix ``feature_a, feature_b, correlation``; undefined entries are 0.

    One pass, each pair once; many columns by ``gram_correlations``.
    """
    if len(features) * (len(features) + 1) // 2 > PAIR_LIMIT:
        return gram_correlations(df, features)
    d = _numbers(df, features)
    pairs = [*combinations(range(len(features)), 2), *[(i, i) for i in range(len(features))]]
    wide = d.agg(*[_corr(features[i], features[j]).alias(f"c_{i}_{j}") for i, j in pairs])
    rows = []
    for i, j in pairs:
        value = F.coalesce(finite(F.col(f"c_{i}_{j}")), F.lit(0.0)).alias("correlation")
        for a, b in {(i, j), (j, i)}:
            rows.append(F.struct(F.lit(features[a]).alias("feature_a"), F.lit(features[b]).alias("feature_b"), value))
    return wide.select(F.inline(F.array(*rows)))


def gram_correlations(df: DataFrame, features: Sequence[str], block: int = BLOCK_COLUMNS) -> DataFrame:
    """``correlation_matrix`` of many columns by blocked Gram matrices.

    A task keeps, for every pair of column blocks, sums over the rows that have both values: their number, both sums,
    both sums of squares and the products, six matrix products of values and presence masks.  It sends them once,
    a row per column and block of partners, and they are added by place.  Values are taken relative to the column's
    mean, which a first pass finds, so that sums of squares don't cancel.  A task's memory is 48 bytes a pair; a
    row's is 48 times ``block``.
    """
    d, names = _numbers(df, features), list(features)
    row = d.agg(*[F.coalesce(finite(F.avg(c)), F.lit(0.0)).alias(f"m{i}") for i, c in enumerate(names)]).first()
    means, n = np.array(list(row), dtype=float), len(names)
    cuts = list(range(0, n, block))
    pairs = [(a, b) for k, a in enumerate(cuts) for b in cuts[k:]]
    stats = ("n", "sx", "sy", "sxx", "syy", "sxy")
    schema = "a int, first int, " + ", ".join(f"{k} array<double>" for k in stats)

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for pdf in batches:
            x = pdf.to_numpy(dtype=float) - means
            there = np.isfinite(x)
            x, there = np.where(there, x, 0.0), there.astype(float)
            square = x * x
            if held is None:
                held = {p: np.zeros((6, min(block, n - p[0]), min(block, n - p[1]))) for p in pairs}
            for (a, b), h in held.items():
                xa, ta, qa = (v[:, a : a + block].T for v in (x, there, square))
                xb, tb, qb = (v[:, b : b + block] for v in (x, there, square))
                h += np.stack([ta @ tb, xa @ tb, ta @ xb, qa @ tb, ta @ qb, xa @ xb])
        for (a, b), h in (held or {}).items():
            yield pd.DataFrame({"a": np.arange(a, a + h.shape[1]), "first": b, **{k: list(h[i]) for i, k in enumerate(stats)}})

    parts = d.select(*[F.col(c).alias(f"v{i}") for i, c in enumerate(names)]).mapInPandas(sums, schema)
    entries = parts.select("a", "first", F.posexplode(F.arrays_zip(*stats)).alias("k", "s"))
    total = entries.groupBy("a", (F.col("first") + F.col("k")).alias("b")).agg(*[F.sum(f"s.{k}").alias(k) for k in stats])
    both = total.where("a <= b")
    covariance = F.col("n") * F.col("sxy") - F.col("sx") * F.col("sy")
    spread = lambda q, s: F.greatest(F.col("n") * F.col(q) - F.col(s) * F.col(s), F.lit(0.0))
    # A spread within the rounding of its sums is none: the column is constant where both have values.
    has = lambda q, s: spread(q, s) > 1e-12 * F.col("n") * F.col(q)
    value = F.when(has("sxx", "sx") & has("syy", "sy"), F.greatest(F.least(covariance / F.sqrt(spread("sxx", "sx")) / F.sqrt(spread("syy", "sy")), F.lit(1.0)), F.lit(-1.0)))
    both = both.select("a", "b", F.coalesce(finite(value), F.lit(0.0)).alias("correlation"))
    label = F.array(*[F.lit(c) for c in names])
    sides = F.when(F.col("a") == F.col("b"), F.array(F.struct(F.col("a").alias("i"), F.col("b").alias("j")))).otherwise(
        F.array(F.struct(F.col("a").alias("i"), F.col("b").alias("j")), F.struct(F.col("b").alias("i"), F.col("a").alias("j")))
    )
    return both.select("correlation", F.inline(sides)).select(F.get(label, F.col("i")).alias("feature_a"), F.get(label, F.col("j")).alias("feature_b"), "correlation")


def pair_correlation(df: DataFrame, x: str, y: str) -> DataFrame:
    return _numbers(df, [x, y]).agg(_corr(x, y).alias("correlation"))


def value_range(df: DataFrame, column: str) -> tuple[float, float] | None:
    """Smallest and largest value; equal ends are widened by a half on both sides."""
    low, high = df.agg(F.min(column), F.max(column)).first()
    if low is None:
        return None
    return (low - 0.5, high + 0.5) if low == high else (float(low), float(high))


def histogram(df: DataFrame, column: str, bins: int = 30) -> DataFrame:
    """Equal-width bins ``bin, bin_start, bin_end, rows`` (non-empty ones)."""
    d = _numbers(df, [column]).where(F.col(column).isNotNull())
    low, high = value_range(d, column) or (0.0, 1.0)
    step = (high - low) / bins
    return (
        d.groupBy(bin_equal_width(F.col(column), low, high, bins).alias("bin"))
        .agg(F.count(F.lit(1)).alias("rows"))
        .select(
            "bin",
            (F.lit(low) + F.col("bin") * step).alias("bin_start"),
            (F.lit(low) + (F.col("bin") + 1) * step).alias("bin_end"),
            "rows",
        )
    )


def boxplot_stats(df: DataFrame, category: str, column: str, factor: float = 1.5) -> DataFrame:
    """Quartiles, whiskers (furthest values within the fences) and outlier count per category."""
    d = df.select(category, finite(F.col(column)).alias(column)).where(F.col(column).isNotNull())
    q = exact_quantiles(d, [column], [0.25, 0.5, 0.75], [category])
    fences = q.select(
        category,
        *[F.col("values")[i].alias(n) for i, n in enumerate(("q1", "median", "q3"))],
    ).select(
        "*",
        (F.col("q1") - F.lit(factor) * (F.col("q3") - F.col("q1"))).alias("low"),
        (F.col("q3") + F.lit(factor) * (F.col("q3") - F.col("q1"))).alias("high"),
    )
    outside = flag_iqr(F.col(column), F.col("low"), F.col("high"))
    return (
        null_safe_join(d, fences, [category])
        .groupBy(category, "q1", "median", "q3")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.min(F.when(~outside, F.col(column))).alias("whisker_low"),
            F.max(F.when(~outside, F.col(column))).alias("whisker_high"),
            F.count_if(outside).alias("outliers"),
        )
    )


def profile_report(
    df: DataFrame, numeric: Sequence[str], categorical: Sequence[str], target: str, project: str = "", version: str = "1"
) -> dict[str, DataFrame]:
    """The whole column profile as named tables."""
    numeric = [c for c in numeric if c in df.columns]
    categorical = [c for c in categorical if c in df.columns]
    columns = [c for c in df.columns if c in {*numeric, *categorical, target}]
    numeric_columns = [c for c in columns if is_numeric(df, c)]
    text_columns = [c for c in columns if c not in numeric_columns]
    overview = fingerprint(df, columns).select(
        F.lit(project).alias("project_name"),
        F.lit(version).alias("report_version"),
        "row_count",
        F.lit(len(df.columns)).alias("column_count"),
        F.array(*[F.lit(c) for c in numeric]).cast("array<string>").alias("numeric_features"),
        F.array(*[F.lit(c) for c in categorical]).cast("array<string>").alias("categorical_features"),
        F.lit(target).alias("target_name"),
        "algorithm",
        F.col("value").alias("fingerprint"),
    )
    report = {"overview": overview}
    if numeric_columns:
        report["numeric_profiles"] = numeric_profile(df, numeric_columns)
    if text_columns:
        report["categorical_profiles"] = categorical_distribution(df, text_columns, 10)
    if numeric and target in df.columns:
        report["target_correlations"] = target_correlations(df, numeric, target)
    if numeric:
        report["correlation_matrix"] = correlation_matrix(df, numeric)
    return report
