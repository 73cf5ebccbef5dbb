"""Quality rules whose thresholds adapt to each language and source.

Base rules hold everywhere: too few words, or more than half of the words inside repeated three-word
windows.  Beyond them, each of a few rates is compared with bounds learned from all documents of the
same language and source: the median and its distance from a quantile of the tail and one bucket more, which the sketch
leaves open, times a factor.  Nothing is fixed in units of a rate.  The quantiles come from sketches: counts in buckets whose width
is a fixed share of the value, so that sketches of any parts merge by addition, whatever the order.
A group with few documents uses the sketch of its language, and a small language that of everything,
which are sums of the same buckets.  The documents are then joined with the bounds of their group.

Defined results: a null or empty text has no words and fails the base rules.  Null languages and
sources are groups of their own.  Repeated rows count each for itself.  Texts are read whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salescope.llm.scratch import Scratch
from salescope.llm.words import shingles, word_blocks

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MIN_GROUP = 200
# Lengths spread on both sides, so quartiles tell their width; the other rates are 0 in most texts and need a tail.
RATES = {  # name: (expression in whole numbers, (percentile below, factor) or None, (percentile above, factor))
    "word_length": ("word_chars * 1000 div nullif(n_words, 0)", (25, 8), (75, 8)),
    "symbols": ("n_symbols * 10000 div nullif(n_words, 0)", None, (90, 2)),
    "dup_lines": ("n_dup_lines * 10000 div nullif(n_lines, 0)", None, (99, 2)),
    "repeats": ("n_repeat_words * 10000 div nullif(n_words, 0)", None, (99, 2)),
}
PERCENTILES = (25, 50, 75, 90, 99)


def _repeated(h: np.ndarray) -> int:
    """Words that lie in a three-word window found twice or more."""
    windows = shingles(h, 3)
    if not len(windows):
        return 0
    order = np.sort(windows)
    twice = order[1:][order[1:] == order[:-1]]
    if not len(twice):
        return 0
    twice = np.unique(twice)
    at = np.searchsorted(twice, windows)
    hit = np.flatnonzero(twice[np.minimum(at, len(twice) - 1)] == windows)
    cover = np.zeros(len(h), dtype=bool)
    for i in range(3):
        cover[hit + i] = True
    return int(cover.sum())


def _lines(text: str) -> tuple[int, int]:
    """Lines with a word, and those of them equal to an earlier one."""
    lines = [x for x in text.split("\n") if x.strip(SPACES)]
    return len(lines), len(lines) - len(set(lines))


def measures(docs: DataFrame, keys: dict[str, Column], text: Column | None = None) -> DataFrame:
    """``keys`` of every row, ``MEASURES`` of its whole text, and ``n_lines``."""
    text = F.col("text") if text is None else text
    rows = docs.select(*[c.alias(k) for k, c in keys.items()], text.alias("__text"))
    fields = [f for f in rows.schema.fields if f.name != "__text"]
    names = [*MEASURES, "n_lines"]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in fields), *(f"{n} long" for n in names)])
    width = len(fields)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(width)
            out: list[list[int]] = [[] for _ in names]
            for lo, hi, hashes, begin in word_blocks(texts):
                for i in range(lo, hi):
                    t = texts[i].as_py() or ""
                    h = hashes[begin[i - lo] : begin[i - lo + 1]]
                    n_lines, dup = _lines(t)
                    row = (len(h), len(t) - sum(map(t.count, SPACES)), sum(map(t.count, SYMBOLS)), dup, _repeated(h), n_lines)
                    for values, value in zip(out, row):
                        values.append(value)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:width], *[pa.array(v, pa.int64()) for v in out]], [*batch.schema.names[:width], *names]
            )

    return rows.mapInArrow(measure, schema)


def bucket(value: Column) -> Column:
    """The sketch's bucket of a whole number: values to 64 alone, then 64 buckets for each doubling.

    A bucket is named by its lowest value, which is off by less than 1/64.
    """
    shift = F.greatest(F.length(F.bin(value)) - 7, F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", value, shift), shift)


def sketches(measured: DataFrame) -> DataFrame:
    """Counts by group, rate and bucket, over all rows with a word."""
    pairs = F.array(*[F.struct(F.lit(k).alias("rate"), bucket(F.expr(e)).alias("bucket")) for k, (e, *_) in RATES.items()])
    rows = measured.filter("n_words > 0").select("lang", "source", F.explode(pairs).alias("x"))
    return rows.groupBy("lang", "source", "x.rate", "x.bucket").agg(F.count("*").alias("n"))


def _quantiles(counts: DataFrame, by: list[str]) -> DataFrame:
    """The percentiles of every rate; ``counts`` has a row for each bucket, of which a group has few hundred."""
    group = Window.partitionBy(*by, "rate")
    upto = F.sum("n").over(group.orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    ranked = counts.groupBy(*by, "rate", "bucket").agg(F.sum("n").alias("n")).select(*by, "rate", "bucket", upto.alias("upto"), F.sum("n").over(group).alias("size"))
    at = [F.min(F.when(F.col("upto") * 100 >= F.col("size") * p, F.col("bucket"))).alias(f"p{p}") for p in PERCENTILES]
    return ranked.groupBy(*by, "rate").agg(F.max("size").alias("size"), *at)


def thresholds(counts: DataFrame, min_group: int = MIN_GROUP) -> DataFrame:
    """One row for each language and source: ``low_<rate>`` and ``high_<rate>``."""
    levels = [("lang", "source"), ("lang",), ()]
    groups = counts.select("lang", "source", "rate").distinct()
    for depth, level in enumerate(levels):
        q = _quantiles(counts, list(level)).select(*[F.col(c).alias(f"__{c}") for c in level], F.col("rate").alias("__rate"), F.struct("size", *[f"p{p}" for p in PERCENTILES]).alias(f"q{depth}"))
        same = F.col("rate") == F.col("__rate")
        for c in level:
            same = same & F.col(c).eqNullSafe(F.col(f"__{c}"))
        groups = groups.join(q, same, "left").drop("__rate", *[f"__{c}" for c in level])
    big = lambda d: F.col(f"q{d}.size") >= min_group
    q = F.when(big(0), F.col("q0")).when(big(1), F.col("q1")).otherwise(F.col("q2"))
    groups = groups.select("lang", "source", "rate", q.alias("q"))
    out = []
    middle = F.col("q.p50")
    for rate, (_, *ends) in RATES.items():
        for name, end in zip(("low", "high"), ends):
            if end:
                tail, factor = F.col(f"q.p{end[0]}"), end[1]
                bucket_width = F.call_function("shiftright", tail, F.lit(6)) * (-1 if name == "low" else 1)
                out.append(F.max(F.when(F.col("rate") == rate, middle + factor * (tail - middle + bucket_width))).alias(f"{name}_{rate}"))
    return groups.groupBy("lang", "source").agg(*out)


def verdicts(docs: DataFrame, scratch: Scratch, min_group: int = MIN_GROUP) -> DataFrame:
    """Per row of ``docs``: doc_id, ``MEASURES``, base_failed, kept, lang, source and the bounds it was held to."""
    measured = scratch.keep(measures(docs, {c: F.col(c) for c in ("doc_id", "lang", "source")}))
    bounds = thresholds(sketches(measured), min_group)
    bounds = bounds.withColumnsRenamed({"lang": "__lang", "source": "__source"})
    same = F.col("lang").eqNullSafe(F.col("__lang")) & F.col("source").eqNullSafe(F.col("__source"))
    joined = measured.join(bounds, same, "left").drop("__lang", "__source")
    base = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    fine = F.lit(True)
    for rate, (e, below, _) in RATES.items():
        if below:
            fine = fine & (F.expr(e) >= F.col(f"low_{rate}"))
        fine = fine & (F.expr(e) <= F.col(f"high_{rate}"))
    limits = [c for c in joined.columns if c.startswith(("low_", "high_"))]
    return joined.withColumn("base_failed", base).select(
        "doc_id", *MEASURES, "base_failed", (~F.col("base_failed") & F.coalesce(fine, F.lit(False))).alias("kept"), "lang", "source", *limits
    )
