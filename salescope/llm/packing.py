"""Packing of tokenized documents into sequences of fixed length, by linear grouping and best fit.

Lengths are whole numbers up to the sequence length, so their histogram has at most that many rows
however many documents there are; the packing is planned on it.  Large lengths are put in groups of
equal cardinality and rounded up to the largest of their group.  For these few sizes the best mix
of configurations (which sizes share a sequence) comes from a linear programme by column generation,
rounded down.  The documents' real lengths are substituted, largest first, and what is left, then all
small ones, goes by best fit, longest first, where it leaves the least room.  The plan is a list of
intervals: the pieces of one length with ranks from a to b go to the sequences from s on, at offset o.
Pieces are ranked within their length in salted groups whose offsets are added up, and look up
their interval.

Defined results: a null text is empty, which is one token, the end.  Repeated rows are packed each for
itself.  Very long texts are cut, into whole sequences after a first piece that may be shorter.
Other columns are not looked at.
"""

from __future__ import annotations

import base64
import os
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from salescope.llm.scratch import Scratch
from salescope.llm.words import released

CAPACITY = 2048
GROUPS = 40
SMALL = 8  # lengths up to this part of the capacity are small
SALT_ROWS = 50_000  # pieces of one length that are ranked in one group, about
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
# Texts of these characters are split alike by both libraries; special tokens are the tokenizer's own business.
_OTHER = re.compile("[^\t\n\r -~\xa1-\u024f\u2010-\u2027\u2030-\u203a]|<\\|").search


class Encoder:
    """Ids of whole texts, as 32-bit numbers.

    ``path`` is the tokenizer's file.  ``ranks``, a file of the same vocabulary as byte strings with their ranks, and its
    splitting ``pattern`` allow plain texts to be encoded with tiktoken, to the same ids, in a fraction of the time; all
    others go to the tokenizer itself.
    """

    def __init__(self, path: str, ranks: str | None = None, pattern: str | None = None):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer, self.fast = Tokenizer.from_file(path), None
        if ranks:
            import tiktoken

            with open(ranks, "rb") as lines:
                table = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
            self.fast = tiktoken.Encoding("plain", pat_str=pattern, mergeable_ranks=table, special_tokens={}).encode_ordinary

    def __call__(self, text: str) -> list[int]:
        if self.fast and not _OTHER(text):
            return self.fast(text)
        return self.tokenizer.encode(text, add_special_tokens=False).ids


def pieces(docs: DataFrame, files: tuple[str | None, ...], capacity: int = CAPACITY, ids: bool = False) -> DataFrame:
    """Pieces of at most ``capacity`` tokens of every row of ``docs``; with ``ids`` also their ids, as bytes.

    ``files`` are those of ``Encoder``, and must be on all executors.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = Encoder(*files)  # for this task only: a worker that is kept would hold on to it
        names = ["doc_id", "piece", "start", "length", "ids_crc32", *["ids"] * ids]
        for batch in batches:
            rows: list[tuple] = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                tokens = array("I", encode(text.as_py() or "")).tobytes() + b"\0\0\0\0"
                n = len(tokens) // 4
                stops = range((n - 1) % capacity + 1, n + 1, capacity)
                start = 0
                for k, stop in enumerate(stops):
                    part = tokens[4 * start : 4 * stop]
                    rows.append((doc, k, start, stop - start, zlib.crc32(part), *[part] * ids))
                    start = stop
            columns = list(zip(*rows)) or [[]] * len(names)
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(released(cut), PIECES + ", ids binary" * ids)


def best_configuration(sizes: np.ndarray, worth: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The most valuable multiset of sizes within the capacity: its worth, and how often each size is in it."""
    best, pick = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    useful = np.flatnonzero(worth > 0)
    useful = useful[np.argsort(sizes[useful])]
    order, values = sizes[useful], worth[useful]
    for w in range(int(order[0]) if len(order) else capacity + 1, capacity + 1):
        fits = np.searchsorted(order, w, "right")
        gains = best[w - order[:fits]] + values[:fits]
        i = int(np.argmax(gains))
        best[w], pick[w] = best[w - 1], -1
        if gains[i] > best[w]:
            best[w], pick[w] = gains[i], useful[i]
    counts, w = np.zeros(len(sizes), dtype=np.int64), capacity
    while w > 0:
        if pick[w] < 0:
            w -= 1
        else:
            counts[pick[w]] += 1
            w -= int(sizes[pick[w]])
    return float(best[capacity]), counts


def configurations(sizes: np.ndarray, demand: np.ndarray, capacity: int, turns: int = 400) -> list[tuple[np.ndarray, float]]:
    """Configurations and how many of each, as real numbers, that hold the demand in fewest sequences."""
    k = len(sizes)
    columns = np.diag(capacity // sizes).astype(float)
    inverse = np.diag(1.0 / np.diag(columns))
    amount = inverse @ demand
    for _ in range(turns):
        worth = inverse.sum(axis=0)
        value, new = best_configuration(sizes, worth, capacity)
        if value <= 1 + 1e-7:
            break
        step = inverse @ new
        ratio = np.where(step > 1e-9, amount / np.where(step > 1e-9, step, 1), np.inf)
        out = int(np.argmin(ratio))
        columns[:, out] = new
        amount = np.maximum(amount - ratio[out] * step, 0)
        amount[out] = ratio[out]
        pivot = inverse[out] / step[out]
        inverse = inverse - np.outer(step, pivot)
        inverse[out] = pivot
    return [(columns[:, j].astype(np.int64), float(amount[j])) for j in range(k)]


class Plan:
    """Sequences in runs of equal content; ``intervals[length]`` holds (first rank, number, first sequence, offset)."""

    def __init__(self, histogram: dict[int, int], capacity: int = CAPACITY, groups: int = GROUPS, small: int = SMALL):
        self.capacity, self.sequences = capacity, 0
        self.left = dict(histogram)
        self.used = dict.fromkeys(histogram, 0)
        self.intervals: dict[int, list[tuple[int, int, int, int]]] = {n: [] for n in histogram}
        self.open: dict[int, list[tuple[int, int]]] = {}  # room: runs (first sequence, number)
        large = [n for n in sorted(histogram, reverse=True) if n > capacity // small]
        if large:
            self._group(large, groups)
        for n in sorted(self.left, reverse=True):
            self._best_fit(n)

    def _new(self, number: int) -> int:
        self.sequences += number
        return self.sequences - number

    def _put(self, length: int, number: int, sequence: int, offset: int) -> None:
        self.intervals[length].append((self.used[length], number, sequence, offset))
        self.used[length] += number
        self.left[length] -= number

    def _leave(self, room: int, sequence: int, number: int) -> None:
        if number:
            self.open.setdefault(room, []).append((sequence, number))

    def _group(self, large: list[int], groups: int) -> None:
        total = sum(self.left[n] for n in large)
        members: list[list[list[int]]] = [[]]  # of each group: runs [length, number], longest first
        size, share = 0, -(-total // groups)
        for n in large:
            rest = self.left[n]
            while rest:
                take = min(rest, share - size)
                members[-1].append([n, take])
                rest, size = rest - take, size + take
                if size == share:
                    members, size = [*members, []], 0
        members = [m for m in members if m]
        by_size: dict[int, list[list[int]]] = {}  # groups rounded to the same size are one
        for m in members:
            by_size.setdefault(m[0][0], []).extend(m)
        sizes = np.array(list(by_size))
        queues = list(by_size.values())
        demand = np.array([sum(c for _, c in q) for q in queues])
        plans = [(c, int(x + 1e-6)) for c, x in configurations(sizes, demand, self.capacity)]
        left = demand.copy()
        for counts, number in sorted(plans, key=lambda p: -int(p[0] @ sizes)):
            if counts.any():
                number = min(number, int(min(left[counts > 0] // counts[counts > 0])))
                left -= counts * number
                self._substitute(counts, number, queues)

    def _substitute(self, counts: np.ndarray, number: int, queues: list[list[list[int]]]) -> None:
        slots: list[list[list[int]]] = []
        for g in np.flatnonzero(counts):
            for _ in range(int(counts[g])):
                taken, need = [], number
                while need:
                    n, c = queues[g][0]
                    take = min(c, need)
                    taken.append([n, take])
                    need -= take
                    queues[g][0][1] -= take
                    if not queues[g][0][1]:
                        queues[g].pop(0)
                slots.append(taken)
        while number:
            run = min(s[0][1] for s in slots)
            first, offset = self._new(run), 0
            for s in slots:
                self._put(s[0][0], run, first, offset)
                offset += s[0][0]
                s[0][1] -= run
                if not s[0][1]:
                    s.pop(0)
            self._leave(self.capacity - offset, first, run)
            number -= run

    def _best_fit(self, length: int) -> None:
        while self.left[length]:
            n = self.left[length]
            room = min((r for r, runs in self.open.items() if r >= length and runs), default=None)
            if room is None:
                room, each = self.capacity, self.capacity // length
                first, number = self._new(-(-n // each)), -(-n // each)
            else:
                first, number = self.open[room].pop()
            each = room // length
            full = min(number, n // each)
            for j in range(each if full else 0):
                self._put(length, full, first, self.capacity - room + j * length)
            self._leave(room - each * length, first, full)
            if full < number:
                rest = n - full * each
                rest = min(rest, each)
                for j in range(rest):
                    self._put(length, 1, first + full, self.capacity - room + j * length)
                self._leave(room - rest * length, first + full, 1 if rest else 0)
                self._leave(room, first + full + (1 if rest else 0), number - full - (1 if rest else 0))


def ranked(rows: DataFrame) -> DataFrame:
    """``rows`` with ``rank``, from 0 within each length.

    A length's rows are dealt to salted groups, so that a length with a third of them is no single task.
    """
    salts = max(1, rows.count() // SALT_ROWS)
    salt = F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(salts)).alias("salt")
    rows = rows.select("*", salt)
    sizes = rows.groupBy("length", "salt").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("n")
    own = F.row_number().over(Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "ids_crc32")) - 1
    return rows.join(sizes.select("length", "salt", before.alias("before")), ["length", "salt"]).withColumn("rank", own + F.col("before"))


def packed(rows: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """The pieces ``rows`` with ``sequence_id`` and ``offset``; ``rows`` is read several times."""
    histogram = {r["length"]: r["n"] for r in rows.groupBy("length").agg(F.count("*").alias("n")).collect()}  # at most ``capacity`` rows
    plan = Plan(histogram, capacity).intervals
    names = [c for c in rows.columns if c != "length"]
    lookup = {n: np.array(x, dtype=np.int64) for n, x in plan.items()}

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            sequence, offset = np.zeros(len(rank), dtype=np.int64), np.zeros(len(rank), dtype=np.int64)
            order = np.argsort(length, kind="stable")
            for part in np.split(order, np.flatnonzero(np.diff(length[order])) + 1) if len(order) else []:
                runs = lookup[int(length[part[0]])]
                at = runs[np.searchsorted(runs[:, 0], rank[part], "right") - 1]
                sequence[part] = at[:, 2] + rank[part] - at[:, 0]
                offset[part] = at[:, 3]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in [*names, "length"]], pa.array(sequence), pa.array(offset)], [*names, "length", "sequence_id", "offset"]
            )

    schema = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in [*names, "length"]) + ", sequence_id long, offset long"
    return ranked(rows).select(*names, "length", "rank").mapInArrow(place, schema)


def pack(docs: DataFrame, files: tuple[str | None, ...], scratch: Scratch, capacity: int = CAPACITY) -> DataFrame:
    """Pieces of all rows of ``docs``, each at its place in a sequence."""
    return packed(scratch.keep(pieces(docs, files, capacity)), capacity).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
