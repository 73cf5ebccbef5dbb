"""Language identification by rank-order profiles of character n-grams.

A text's letters, in lower case, form words padded by one boundary on each side; its n-grams are the
runs of one to three characters within a padded word, without the lone boundary.  A profile is the
list of the most frequent n-grams, ties to the shorter, then to the smaller code points.  The distance between a text and
a language sums, over the text's profile, how far each n-gram stands out of its place in the
language's profile; an n-gram missing there counts as the profile's length.  The nearest language
wins, ties to the smaller name.

Defined results: a null text, or one without a letter, is ``und`` with score 0; so is every text when
nothing was learned.  Repeated rows are scored each for itself.  Texts are read whole, in pieces of
bounded size.  Other columns of the input are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salescope.llm.words import released

UNDETERMINED = "und"
PROFILE_SIZE = 300
MAX_LANGUAGES = 1_000  # more distinct names than this are an error in the labels, and are raised as one
_PIECE = 1 << 20
_letters: list[np.ndarray] = []


def _codes(text: str) -> np.ndarray:
    """Code points of the letters in lower case; 0 stands for a run of anything else, and at both ends."""
    if not _letters:
        _letters.append(np.array([chr(c).isalpha() for c in range(0x110000)]))
    raw = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    codes = np.zeros(len(raw) + 2, dtype=np.uint32)
    codes[1:-1] = np.where(_letters[0][raw], raw, 0)
    keep = np.ones(len(codes), dtype=bool)
    keep[1:] = (codes[1:] != 0) | (codes[:-1] != 0)
    return codes[keep]


def _grams(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams, as up to three numbers of 21 bits in one, and how often each occurs.

    A character is its code point and one, a boundary is 1, so that shorter n-grams are smaller numbers.
    """
    found, counts = [], []
    for at in range(0, len(codes), _PIECE):
        c = codes[at : at + _PIECE + 2].astype(np.int64) + 1
        own = min(_PIECE, len(codes) - at)
        one = c[:own]
        two = (c[:-1] << 21 | c[1:])[:own]
        three = (c[:-2] << 42 | c[1:-1] << 21 | c[2:])[:own]
        three = three[c[1:-1][: len(three)] != 1]
        grams, n = np.unique(np.concatenate([one[one != 1], two[two != (1 << 21 | 1)], three]), return_counts=True)
        found.append(grams)
        counts.append(n)
    if len(found) == 1:
        return found[0], counts[0]
    grams, place = np.unique(np.concatenate(found), return_inverse=True)
    return grams, np.bincount(place, np.concatenate(counts)).astype(np.int64)


def _top(grams: np.ndarray, counts: np.ndarray, size: int) -> np.ndarray:
    return grams[np.lexsort((grams, -counts))[:size]]


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts, langs = batch.column(0), batch.column(1).to_pylist()
        held: dict[str, list[np.ndarray]] = {}
        size = 0
        for i, lang in enumerate(langs):
            codes = _codes(texts[i].as_py() or "")
            if len(codes) > 1:
                held.setdefault(lang, []).append(codes)
                size += len(codes)
            if size > 4 * _PIECE or (held and i == len(langs) - 1):
                for name, parts in held.items():
                    grams, n = _grams(np.concatenate(parts))
                    yield pa.RecordBatch.from_arrays([pa.array([name] * len(grams), pa.string()), pa.array(grams), pa.array(n)], ["lang", "gram", "n"])
                held, size = {}, 0


def learn(docs: DataFrame, text: Column | None = None, lang: Column | None = None, size: int = PROFILE_SIZE) -> dict[str, list[int]]:
    """Profiles by language of all rows of ``docs`` that have one.

    The result holds ``size`` numbers for each language; the number of languages is checked.
    """
    text, lang = F.col("text") if text is None else text, F.col("lang") if lang is None else lang
    rows = docs.select(text.alias("text"), lang.alias("lang")).filter("lang IS NOT NULL")
    counts = rows.mapInArrow(released(_counts), "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))
    top = counts.withColumn("place", place).filter(F.col("place") <= size).limit(MAX_LANGUAGES * size + 1).toArrow()
    if top.num_rows > MAX_LANGUAGES * size:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    out: dict[str, list[int]] = {}
    for row in sorted(top.to_pylist(), key=lambda r: (r["lang"], r["place"])):
        out.setdefault(row["lang"], []).append(row["gram"])
    return out


class Scorer:
    """Distances of texts to all profiles, which are a few hundred numbers each."""

    def __init__(self, profiles: dict[str, list[int]], size: int = PROFILE_SIZE):
        self.names, self.size = sorted(profiles), size
        self.known = np.unique(np.array([g for p in profiles.values() for g in p], dtype=np.int64))
        self.place = np.full((len(self.known) + 1, len(self.names)), -1, dtype=np.int64)
        for j, name in enumerate(self.names):
            self.place[np.searchsorted(self.known, profiles[name]), j] = np.arange(len(profiles[name]))

    def __call__(self, text: str | None) -> tuple[str, float]:
        codes = _codes(text or "")
        if len(codes) < 2 or not self.names:
            return UNDETERMINED, 0.0
        grams, n = _grams(codes)
        own = _top(grams, n, self.size)
        at = np.searchsorted(self.known, own)
        at[self.known[np.minimum(at, len(self.known) - 1)] != own] = len(self.known)
        place = self.place[at]
        far = np.where(place < 0, self.size, np.abs(place - np.arange(len(own))[:, None])).sum(axis=0)
        best = int(np.argmin(far))
        return self.names[best], 1.0 - int(far[best]) / (self.size * len(own))


def predict(docs: DataFrame, profiles: dict[str, list[int]], keys: dict[str, Column], text: Column | None = None, size: int = PROFILE_SIZE) -> DataFrame:
    """The columns ``keys`` of every row, with ``lang_pred`` and ``score`` (0 to 1, 1 for a perfect match)."""
    text = F.col("text") if text is None else text
    rows = docs.select(*[c.alias(k) for k, c in keys.items()], text.alias("__text"))
    fields = [f for f in rows.schema.fields if f.name != "__text"]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields) + ", lang_pred string, score double"
    width = len(fields)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(profiles, size)
        for batch in batches:
            got = [scorer(x.as_py()) for x in batch.column(width)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:width], pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.float64())],
                [*batch.schema.names[:width], "lang_pred", "score"],
            )

    return rows.mapInArrow(released(score), schema)


def accepted(docs: DataFrame, profiles: dict[str, list[int]], least: float, size: int = PROFILE_SIZE) -> DataFrame:
    """The rows of ``docs``, unchanged, whose text is nearer than ``least`` (a score) to some language.

    Text without letters, and character salad that is in no language's order, goes.
    """
    place = docs.columns.index("text")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(profiles, size)
        for batch in batches:
            got = [scorer(x.as_py()) for x in batch.column(place)]
            yield batch.filter(pa.array([lang != UNDETERMINED and s >= least for lang, s in got], pa.bool_()))

    return docs.mapInArrow(released(keep), docs.schema)
