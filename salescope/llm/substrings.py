"""Removal of long passages that occur earlier: word k-mers as the edges of a De Bruijn graph.

An edge is a window of ``WIDTH`` consecutive words, between the nodes of its first and its last
``WIDTH - 1`` words.  An edge is repeated when its word sequence occurs again; its source is the
occurrence with the smallest document id, then the smallest start.  Edges are dealt to buckets by the
top bits of their hash, and each bucket finds its repeated edges and the coordinates of their later
occurrences.  Joined by document, later occurrences that follow one another along the text, that is
repeated paths without a branch away from them, are compacted into spans; joined with the texts,
the spans are cut out.

What is dealt is pre-aggregated: a task sends each distinct edge of a block of text once, with its
first place there, and knows the others to be repeated.  So a passage that a third of all documents
share takes one entry per block, and no bucket holds more than its share of distinct edges per
block.  Entries are packed as byte strings of about 9 bytes each: 56 bits of the hash beside the
bucket's own, the start as a difference, the document once per run.

Defined results: null and empty texts have no words; a text with fewer words than a window loses none.
Rows without an id take no part and lose nothing.  Rows that repeat an id are read side by side: words
at places found repeated in one of them are removed from all.  Other columns are not looked at.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salescope.llm.words import BLOCK, shingles, word_blocks

WIDTH = 20
BLOCK_BYTES = 12 * BLOCK  # text that a task pre-aggregates at a time
BUCKET_BYTES = 4 * BLOCK  # text for each bucket
_PACKED = "doc binary, n binary, step binary, far binary"


def _pack(doc: np.ndarray, start: np.ndarray) -> list[bytes]:
    """Places in order of document and start: documents, how many each, steps from start to start, steps over 254."""
    first = np.ones(len(doc), dtype=bool)
    first[1:] = doc[1:] != doc[:-1]
    at = np.flatnonzero(first)
    step = start.copy()
    step[1:] -= np.where(first[1:], 0, start[:-1])
    far = step[step > 254].astype(np.int32)
    ids = np.diff(doc[at], prepend=0)
    return [zlib.compress(ids.tobytes(), 1), zlib.compress(np.diff(at, append=len(doc)).astype(np.int32).tobytes(), 1), np.minimum(step, 255).astype(np.uint8).tobytes(), far.tobytes()]


def _unpack(ids: bytes, n: bytes, step: bytes, far: bytes) -> tuple[np.ndarray, np.ndarray]:
    docs = np.cumsum(np.frombuffer(zlib.decompress(ids), dtype=np.int64))
    counts = np.frombuffer(zlib.decompress(n), dtype=np.int32).astype(np.int64)
    steps = np.frombuffer(step, dtype=np.uint8).astype(np.int64)
    steps[steps == 255] = np.frombuffer(far, dtype=np.int32)
    total = np.cumsum(steps)
    begin = np.cumsum(counts) - counts
    return np.repeat(docs, counts), total - np.repeat(total[begin] - steps[begin], counts)


def _later(edge: np.ndarray, doc: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places sorted by (document, start) go in; which of them are the first of their edge, and which come later than it."""
    order = np.argsort(edge, kind="stable")
    new = np.ones(len(edge), dtype=bool)
    new[1:] = edge[order[1:]] != edge[order[:-1]]
    source = order[np.flatnonzero(new)[np.cumsum(new) - 1]]
    first = np.zeros(len(edge), dtype=bool)
    first[order[new]] = True
    later = np.zeros(len(edge), dtype=bool)
    later[order] = (doc[order] != doc[source]) | (start[order] != start[source])
    return first, later


def _edges(buckets: int, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["bucket", "edge", "doc", "n", "step", "far"]
        for batch in batches:
            ids = batch.column(0)
            for lo, hi, hashes, begin in word_blocks(batch.column(1), size=BLOCK_BYTES):
                sizes, keys = np.diff(begin), ids.slice(lo, hi - lo).to_numpy(zero_copy_only=False)
                held = [i for i in np.argsort(keys, kind="stable") if sizes[i] >= width]
                if not held:
                    continue
                edge = np.concatenate([shingles(hashes[begin[i] : begin[i + 1]], width) for i in held])
                each = sizes[held] - width + 1
                doc = np.repeat(keys[held].astype(np.int64), each)
                start = np.arange(len(edge)) - np.repeat(np.cumsum(each) - each, each)
                if (np.diff(keys[held]) == 0).any():  # rows that repeat an id: in order of start
                    order = np.lexsort((start, doc))
                    edge, doc, start = edge[order], doc[order], start[order]
                first, later = _later(edge, doc, start)
                rows = [[], [], [], [], [], []]
                if later.any():
                    for column, value in zip(rows, [-1 - int(doc[0] % buckets), None, *_pack(doc[later], start[later])]):
                        column.append(value)
                edge, doc, start = edge[first], doc[first], start[first]
                own = ((edge >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
                order = np.argsort(own, kind="stable")
                cuts = np.flatnonzero(np.diff(own[order], prepend=-1))
                for at, stop in zip(cuts, [*cuts[1:], len(order)]):
                    part = order[at:stop]
                    short = np.ascontiguousarray(edge[part]).view(np.uint8).reshape(-1, 8)[:, :7].tobytes()
                    for column, value in zip(rows, [int(own[part[0]]), short, *_pack(doc[part], start[part])]):
                        column.append(value)
                yield pa.RecordBatch.from_arrays([pa.array(rows[0], pa.int32()), *[pa.array(r, pa.binary()) for r in rows[1:]]], names)

    return run


def _places(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    got = [_unpack(*x) for x in zip(*(table.column(c).to_pylist() for c in ("doc", "n", "step", "far")))]
    return np.concatenate([g[0] for g in got]), np.concatenate([g[1] for g in got])


def _repeats(parts: int):
    """Later occurrences of a bucket's edges, packed by the part that their documents belong to."""

    def run(table: pa.Table) -> pa.Table:
        doc, start = _places(table)
        if table.column("bucket")[0].as_py() >= 0:
            raw = np.zeros((len(doc), 8), dtype=np.uint8)
            raw[:, :7] = np.frombuffer(b"".join(table.column("edge").to_pylist()), dtype=np.uint8).reshape(-1, 7)
            order = np.lexsort((start, doc))
            edge, doc, start = raw.view(np.uint64).ravel()[order], doc[order], start[order]
            _, later = _later(edge, doc, start)
            doc, start = doc[later], start[later]
        part = doc % parts
        order = np.lexsort((start, doc, part))
        part, doc, start = part[order], doc[order], start[order]
        cuts = np.flatnonzero(np.diff(part, prepend=-1))
        rows = [[int(part[a]), *_pack(doc[a:b], start[a:b])] for a, b in zip(cuts, [*cuts[1:], len(part)])]
        columns = list(zip(*rows)) or [[]] * 5
        return pa.table({"part": pa.array(columns[0], pa.int32())} | {c: pa.array(x, pa.binary()) for c, x in zip(("doc", "n", "step", "far"), columns[1:])})

    return run


def _compact(width: int):
    """Maximal spans of words under repeated windows, by document."""

    def run(table: pa.Table) -> pa.Table:
        doc, start = _places(table)
        order = np.lexsort((start, doc))
        doc, start = doc[order], start[order]
        new = np.ones(len(doc), dtype=bool)
        new[1:] = (doc[1:] != doc[:-1]) | (start[1:] > start[:-1] + width)
        at = np.flatnonzero(new)
        end = start[np.append(at[1:], len(doc)) - 1] + width
        spans = np.stack([start[at], end], axis=1).astype(np.int32)
        docs, n = np.unique(doc[at], return_counts=True)
        stop = np.cumsum(n)
        return pa.table({"__doc": docs, "__spans": pa.array([spans[b - k : b].tobytes() for b, k in zip(stop, n)], pa.binary())})

    return run


def repeated_spans(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """``__doc`` and ``__spans``: pairs of first word and word after the last, as 32-bit numbers, of all that occurs earlier."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(1, -(-size // BUCKET_BYTES))
    rows = docs.filter("doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    edges = rows.mapInArrow(_edges(buckets, width), f"bucket int, edge binary, {_PACKED}")
    repeats = edges.groupBy("bucket").applyInArrow(_repeats(buckets), f"part int, {_PACKED}")
    return repeats.groupBy("part").applyInArrow(_compact(width), "__doc long, __spans binary")


def _cut(text: str | None, spans: bytes | None) -> tuple[list[bytes], int]:
    words = (text or "").encode("utf-8", "surrogatepass").split()
    if not spans:
        return words, 0
    kept, at, removed = [], 0, 0
    for lo, hi in np.frombuffer(spans, dtype=np.int32).reshape(-1, 2).tolist():
        kept += words[at:lo]
        removed += max(0, min(hi, len(words)) - lo)
        at = hi
    return kept + words[at:], removed


def removed(docs: DataFrame, width: int = WIDTH, texts: bool = False) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, n_removed, kept_sha256, and with ``texts`` the kept words as ``kept_text``."""
    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string" + ", kept_text string" * texts

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, spans in zip(batch.column(1), batch.column(2)):
                kept, gone = _cut(text.as_py(), spans.as_py())
                whole = b" ".join(kept)
                rows.append((len(kept) + gone, gone, hashlib.sha256(whole).hexdigest(), *[whole.decode()] * texts))
            columns = list(zip(*rows)) or [[]] * (3 + texts)
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c, k) for c, k in zip(columns, kinds)]], ["doc_id", "n_words", "n_removed", "kept_sha256", "kept_text"][: 4 + texts])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    spans = repeated_spans(docs, width)
    return rows.join(spans, F.col("doc_id") == F.col("__doc"), "left").select("doc_id", "text", "__spans").mapInArrow(cut, schema)
