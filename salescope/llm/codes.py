"""Product-quantiser codes of vectors over per-dimension value dictionaries.

Components become whole numbers (256 times the value, rounded down).  Blocks of vectors are turned once
into dictionaries: for each dimension its distinct whole numbers, and every vector's place among them.  In each
round the squared differences of those distinct numbers to all entries of a codebook are tabulated, so a
part's distance to an entry is a few gathers from these tables and additions; no difference is
taken per vector.  The blocks are written once, and each round scans them, adds up the parts
of every entry within a task, and sends one row per entry and task.  What reaches the driver are the codebooks: parts x entries
rows, however large the table.

Everything is in whole numbers and so doesn't depend on the order or the number of tasks.

Defined results: vectors that are null, hold null or non-finite components or have another length
than most (ties to the shorter) are left out, and so are those with a component beyond ``bound``, whose squared
distances a long can't hold.  A length that isn't a multiple of the parts is filled up with zeros.  With fewer vectors than entries there
are as many entries as vectors.  Rows without an id are coded, and come after all others where the
smallest ids are asked for; rows that repeat an id count each for itself, in the order of their
components.  An empty table gives an empty result.  Extra columns are not looked at.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salescope.llm.scratch import Scratch

PARTS = 16
ENTRIES = 64  # 256 at most: a code is one byte
ROUNDS = 2
SCALE = 256
BLOCK = 8_192  # vectors in a dictionary block, at most; their places fit 16 bits


def bound(width: int) -> int:
    """The largest whole number allowed in a component: a distance over ``width`` of them fits a long."""
    return math.isqrt((2**63 - 1) // max(width, 1)) // 2


def usable(vectors: DataFrame, vector: Column, label: Column, parts: int) -> tuple[DataFrame, int]:
    """Rows (id, label, v) that take part, and the length of their vectors, filled up to a multiple of ``parts``."""
    v = vector.cast("array<double>")
    finite = v.isNotNull() & ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = vectors.select(F.col("vec_id").cast("long").alias("id"), label.alias("label"), v.alias("v")).filter(F.coalesce(finite, F.lit(False)))
    top = rows.groupBy(F.size("v").alias("dim")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "dim").first()
    dim = top["dim"] if top else parts
    width = max(1, -(-dim // parts)) * parts
    most = bound(width) / SCALE
    rows = rows.filter((F.size("v") == dim) & ~F.exists("v", lambda x: F.abs(x) > most))
    if width > dim:
        rows = rows.withColumn("v", F.concat("v", F.array_repeat(F.lit(0.0), width - dim)))
    return rows, width


def whole(v: np.ndarray) -> np.ndarray:
    return np.floor(SCALE * v).astype(np.int64)


def dictionaries(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct numbers of each column one after the other, how many each has, and each row's place in them (by column)."""
    found = [np.unique(column, return_inverse=True) for column in x.T]
    return np.concatenate([d for d, _ in found]), np.array([len(d) for d, _ in found], np.int32), np.stack([c for _, c in found]).astype(np.uint16)


def _blocks(width: int, size: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole_batch in batches:
        for at in range(0, whole_batch.num_rows, size):
            batch = whole_batch.slice(at, size)
            values, sizes, places = dictionaries(whole(batch.column(2).flatten().to_numpy(zero_copy_only=False).reshape(-1, width)))
            one = lambda column: pa.ListArray.from_arrays(pa.array([0, len(column)], pa.int32()), column)
            packed = [pa.array([a.tobytes()], pa.binary()) for a in (values, sizes, places)]
            yield pa.RecordBatch.from_arrays([one(batch.column(0)), one(batch.column(1)), *packed], ["ids", "labels", "numbers", "sizes", "places"])


def nearest_entries(values: np.ndarray, sizes: np.ndarray, places: np.ndarray, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every vector and part the nearest entry (ties to the lower) and its squared distance."""
    parts, entries, width = books.shape
    ends = np.cumsum(sizes)
    reach = max(int(np.abs(values).max()), int(np.abs(books).max()))
    kind = np.int32 if width * (2 * reach) ** 2 < 2**31 else np.int64
    best, error = [], []
    for p in range(parts):
        total = np.zeros((places.shape[1], entries), kind)
        for j in range(width):
            k = p * width + j
            table = (values[ends[k] - sizes[k] : ends[k], None] - books[p, None, :, j]).astype(kind)
            table *= table
            total += table[places[k]]
        near = total.argmin(axis=1)
        best.append(near)
        error.append(np.take_along_axis(total, near[:, None], axis=1)[:, 0].astype(np.int64))
    return np.stack(best, axis=1), np.stack(error, axis=1)


def _opened(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Every block: its row, and its dictionaries."""
    for batch in batches:
        for i in range(batch.num_rows):
            numbers, sizes, places = (batch.column(n)[i].as_buffer() for n in ("numbers", "sizes", "places"))
            sizes = np.frombuffer(sizes, np.int32)
            yield batch, i, np.frombuffer(numbers, np.int64), sizes, np.frombuffer(places, np.uint16).reshape(len(sizes), -1)


def _sums(books: np.ndarray, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Number and component sums of the parts nearest to each entry, added up over the task."""
    parts, entries, width = books.shape
    count, total = np.zeros((parts, entries), np.int64), np.zeros(books.shape, np.int64)
    for _, _, values, sizes, places in _opened(batches):
        best, _ = nearest_entries(values, sizes, places, books)
        ends = np.cumsum(sizes)
        for p in range(parts):
            count[p] += np.bincount(best[:, p], minlength=entries)
            for j in range(width):
                k = p * width + j
                own = values[ends[k] - sizes[k] : ends[k]][places[k]]
                # Sums of a block stay far below 2^53, so the float weights are exact.
                total[p, :, j] += np.bincount(best[:, p], weights=own, minlength=entries).astype(np.int64)
    p, e = np.nonzero(count)
    sums = [pa.array(total[p, e, j]) for j in range(width)]
    yield pa.RecordBatch.from_arrays([pa.array(p, pa.int32()), pa.array(e, pa.int32()), pa.array(count[p, e]), *sums], ["part", "entry", "n", *[f"s{j}" for j in range(width)]])


def moved(blocks: DataFrame, books: np.ndarray) -> np.ndarray:
    """The codebooks after one round: each used entry becomes the rounded-down mean of its parts."""
    width = books.shape[2]
    sums = [f"s{j}" for j in range(width)]
    schema = "part int, entry int, n long, " + ", ".join(f"{s} long" for s in sums)
    rows = blocks.select("numbers", "sizes", "places").mapInArrow(partial(_sums, books), schema)
    after = books.copy()
    for r in rows.groupBy("part", "entry").agg(F.sum("n").alias("n"), *[F.sum(F.col(s).cast("decimal(38,0)")).alias(s) for s in sums]).collect():
        after[r["part"], r["entry"]] = [int(r[s]) // r["n"] for s in sums]
    return after


def _coded(books: np.ndarray, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, i, values, sizes, places in _opened(batches):
        best, error = nearest_entries(values, sizes, places, books)
        text, step = best.astype(np.uint8).tobytes().hex(), 2 * best.shape[1]
        codes = pa.array([text[k : k + step] for k in range(0, len(text), step)], pa.string())
        # The label's values within the list column, kept in Arrow's own type.
        ids, labels = (batch.column(c).slice(i, 1).flatten() for c in ("ids", "labels"))
        yield pa.RecordBatch.from_arrays([ids, labels, codes, pa.array(error.sum(axis=1))], ["vec_id", "label", "code", "error"])


def codebooks(vectors: DataFrame, scratch: Scratch, vector: Column, label: Column, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, block: int = BLOCK) -> tuple[DataFrame, np.ndarray]:
    """The dictionary blocks of all vectors that take part, and the codebooks (part, entry, component) after all rounds."""
    rows, dim = usable(vectors, vector, label, parts)
    kind = dict(rows.dtypes)["label"]
    blocks = scratch.keep(rows.mapInArrow(partial(_blocks, dim, block), f"ids array<long>, labels array<{kind}>, numbers binary, sizes binary, places binary"))
    first = rows.orderBy(F.col("id").asc_nulls_last(), "v").limit(entries).select("v").collect()
    books = whole(np.array([r["v"] for r in first], np.float64).reshape(len(first), parts, dim // parts)).transpose(1, 0, 2)
    for _ in range(rounds):
        if len(first):
            books = moved(blocks, books)
    return blocks, books


def compress(vectors: DataFrame, scratch: Scratch, vector: Column | None = None, label: Column | None = None, **sizes: int) -> DataFrame:
    """Per vector that takes part: vec_id, code, error, label_error (null beyond a long), codebooks_sha256, label."""
    vector, label = F.col("embedding") if vector is None else vector, F.col("label") if label is None else label
    blocks, books = codebooks(vectors, scratch, vector, label, **sizes)
    fields = [T.StructField("vec_id", T.LongType()), T.StructField("label", blocks.schema["labels"].dataType.elementType)]
    schema = T.StructType([*fields, T.StructField("code", T.StringType()), T.StructField("error", T.LongType())])
    coded = scratch.keep(blocks.mapInArrow(partial(_coded, books), schema))
    total = F.sum(F.col("error").cast("decimal(38,0)")).try_cast("long")
    by_label = coded.groupBy(F.col("label").alias("__label")).agg(total.alias("label_error"))
    digest = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
    joined = coded.join(by_label, F.col("label").eqNullSafe(F.col("__label")))
    return joined.select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"), "label")
