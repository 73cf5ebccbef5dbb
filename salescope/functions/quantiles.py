"""Exact quantiles and order statistics over whole columns, by radix selection.

A finite double has an image among the 64-bit whole numbers that keeps the order.  The
wanted ranks are found digit by digit, 16 bits at a time: rows are counted by digit, the
running sum tells which digit holds a rank, and the next pass counts only rows that
begin with the digits found so far.  Four passes of partial aggregation find any rank of any
column; a pass is the last one for ranks whose rows have one value only.  Nothing is sorted or sketched, and
the rows that one task sees after aggregation are the 65 536 digits at most, whatever the table.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from contextlib import nullcontext

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from salescope.functions.scalar import finite
from salescope.session import held, local, materialize

DIGIT = 16
# A rank rule is SQL text for the 0-based position, possibly fractional, in a group of ``{n}`` rows.
RankRule = str


def linear_rank(prob: float) -> RankRule:
    """Position of the linearly interpolated quantile."""
    return f"(({{n}} - 1) * {float(prob)!r}D)"


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """NULL-safe equi join that keeps the left copy of the keys."""
    renamed = right.select(*[F.col(k).alias(f"__{k}") if k in keys else F.col(k) for k in right.columns])
    cond = F.lit(True)
    for k in keys:
        cond = cond & left[k].eqNullSafe(renamed[f"__{k}"])
    joined = left.join(renamed, cond, how)
    return joined if how == "left_semi" else joined.drop(*[f"__{k}" for k in keys])


def with_image(df: DataFrame, value: str = "value") -> DataFrame:
    """Adds ``image``: a whole number for every finite ``value``, in the order of the values; 0 for both zeros.

    It is made of the exponent and the 52 bits behind it, as the number is stored, with the number's sign.
    The logarithm only guesses the exponent; the comparison with its power of two decides.
    """
    size = f"abs(`{value}`)"
    guess = df.withColumn("__exp", F.expr(f"CAST(least(1023D, greatest(-1022D, floor(log2({size})))) AS INT)"))
    power = """CASE WHEN __exp BETWEEN 0 AND 62 THEN CAST(shiftleft(1L, __exp) AS DOUBLE)
      WHEN __exp BETWEEN -62 AND -1 THEN 1D / CAST(shiftleft(1L, -__exp) AS DOUBLE) ELSE pow(2D, __exp) END"""
    share = guess.withColumn("__share", F.expr(f"{size} / ({power})"))  # from 1 to 2 where the guess is right
    image = f"""CASE WHEN {size} < 2.2250738585072014E-308D THEN CAST({size} * {2.0**537!r}D * {2.0**537!r}D AS BIGINT)
      WHEN __share < 1D THEN (__exp + 1022L) * 4503599627370496L + CAST((2D * __share - 1D) * 4503599627370496D AS BIGINT)
      WHEN __share >= 2D THEN (__exp + 1024L) * 4503599627370496L + CAST((__share / 2D - 1D) * 4503599627370496D AS BIGINT)
      ELSE (__exp + 1023L) * 4503599627370496L + CAST((__share - 1D) * 4503599627370496D AS BIGINT) END"""
    made = share.withColumn("image", F.expr(image))
    signed = F.when(F.col(value) < 0, -F.col("image")).otherwise(F.col("image"))
    return made.withColumn("image", signed).drop("__exp", "__share")


def exact_ranks(
    df: DataFrame, columns: Sequence[str], rules: Sequence[RankRule], by: Sequence[str] = (), hold: bool = True
) -> DataFrame:
    """One row per group and column: ``by..., feature, n, values``.

    A fractional rank is interpolated between its two neighbours. NULL, NaN and
    infinite entries are left out; a column without entries has ``n = 0`` and
    NULL values. ``hold=False`` is for an input that is cheap to scan several times.
    """
    by = list(by)
    narrow = df.select(*by, *[finite(F.col(c)).alias(c) for c in columns])
    with held(narrow, "ranks") if hold else nullcontext(narrow) as src:
        return _selected(src, columns, rules, by)


def _counts(rows: DataFrame, keys: Sequence[str], level: int) -> DataFrame:
    """Rows per digit of a level, with their range and the running sum within ``keys``."""
    digit = F.shiftright("image", 64 - DIGIT * level).alias("digit")
    counted = rows.groupBy(*keys, digit).agg(F.count("value").alias("rows"), F.min("value").alias("lo"), F.max("value").alias("hi"))
    group = Window.partitionBy(*keys)
    return counted.withColumns({"upto": F.sum("rows").over(group.orderBy("digit")), "size": F.sum("rows").over(group)})


def _selected(src: DataFrame, columns: Sequence[str], rules: Sequence[RankRule], by: list[str]) -> DataFrame:
    # Without groups the state of a pass is a few rows per column and stays local; that of groups is a table.
    settle: Callable[[DataFrame], DataFrame] = (lambda t: materialize(t, "ranks")) if by else local
    at = [f"({rule.format(n='greatest(n, 1)')})" for rule in rules]
    keys = by + ["feature"]
    quoted = [f"`{k}`" for k in keys]
    entries = with_image(src.unpivot(by, list(columns), "feature", "value"))
    slots = ", ".join(
        f"named_struct('slot', {2 * i + j}, 'k', CAST({side}({rank}) AS BIGINT))"
        for i, rank in enumerate(at)
        for j, side in enumerate(("floor", "ceil"))
    )
    inside = "transform(filter(slots, s -> s.k >= upto - rows AND s.k < upto), s -> named_struct('slot', s.slot, 'k', s.k - (upto - rows)))"

    counts = _counts(entries, keys, 1).withColumnRenamed("size", "n").withColumn("slots", F.expr(f"array({slots})"))
    state = ["n", "digit AS prefix", "lo", "hi"]
    found = f"inline(CASE WHEN n = 0 THEN array(named_struct('slot', -1, 'k', 0L)) ELSE {inside} END)"
    picks = settle(counts.selectExpr(*quoted, *state, found))
    done = picks.where("n = 0 OR lo = hi")
    for level in range(2, 64 // DIGIT + 1):
        still = picks.where("lo < hi")
        if still.isEmpty():
            break
        wanted = still.groupBy(*keys, "prefix").agg(F.max("n").alias("n"), F.collect_list(F.struct("slot", "k")).alias("slots"))
        prefixed = entries.withColumn("prefix", F.shiftright("image", 64 - DIGIT * (level - 1)))
        rows = null_safe_join(prefixed, still.select(*keys, "prefix"), [*keys, "prefix"], "left_semi")
        counts = _counts(rows, [*keys, "prefix"], level).drop("size")
        picks = settle(null_safe_join(counts, wanted, [*keys, "prefix"]).selectExpr(*quoted, *state, f"inline({inside})"))
        done = done.unionByName(picks.where("lo = hi"))
    values = ", ".join(
        f"s{2 * i} + (s{2 * i + 1} - s{2 * i}) * ({rank} - floor({rank}))"
        for i, rank in enumerate(at)
    )
    wide = done.groupBy(*keys).agg(F.max("n").alias("n"), *[F.expr(f"max(CASE WHEN slot = {s} THEN lo END) AS s{s}") for s in range(2 * len(rules))])
    out = wide.selectExpr(*quoted, "n", f"array({values}) AS values")
    if by:
        return out
    # A table without rows has no digit to count: its columns are added here.
    have = {r["feature"]: (r["n"], r["values"]) for r in out.collect()}
    listed = [(c, *have.get(c, (0, [None] * len(rules)))) for c in columns]
    table = pa.table([pa.array(x, t) for x, t in zip(zip(*listed), (pa.string(), pa.int64(), pa.list_(pa.float64())))], ["feature", "n", "values"])
    return F.broadcast(src.sparkSession.createDataFrame(table))


def exact_quantiles(
    df: DataFrame, columns: Sequence[str], probs: Sequence[float], by: Sequence[str] = (), hold: bool = True
) -> DataFrame:
    """Linearly interpolated quantiles: ``by..., feature, n, values`` (one entry per prob)."""
    return exact_ranks(df, columns, [linear_rank(p) for p in probs], by, hold)


def column_quantiles(
    df: DataFrame, columns: Sequence[str], probs: Sequence[float], hold: bool = True
) -> dict[str, list[float]]:
    """Quantiles of whole columns as plain numbers, for use as literals in a later plan."""
    rows = exact_quantiles(df, columns, probs, hold=hold).collect()
    return {r["feature"]: list(r["values"]) for r in rows}
