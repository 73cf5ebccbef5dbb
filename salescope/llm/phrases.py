"""Collocations: frequent phrases of two to four words per language, counted with double-array tries.

Texts are turned once into blocks of one language: a dictionary of the block's words and every word's place in it,
with a mark between pieces.  All later passes scan these blocks.

Candidates are found level by level, so that no phrase that may be frequent is left out.  Pairs of frequent words fall
into 2^32 buckets; a bucket's sum is no smaller than the count of any pair in it.  Runs of three and four words, all of whose
pairs are of buckets with the least count, are summed by bucket in the same way.  Only phrases that are, with all phrases inside them, of
such buckets are sent with their words; they are candidates where their sums over the blocks reach the least count.
Most runs of frequent pairs are rare, and a bucket is sent as the gap to the next one: two bytes or so, where words take 24.
What tells a pass which words or buckets are frequent is a bitmap of ``FILTER`` bits, the same
size for any table: a false hit makes a candidate more, never one less.

The rest is dealt by hash to tries of about ``PHRASES`` phrases, each built in a task of its own as a double array: the
child of a node by a word lies at the node's base plus the word's number, if the check there names the node.
Tries are broadcast one after the other, so a broadcast's size doesn't grow with the table; a
pass over the blocks moves the states of all text positions together, one word further a level, and adds up the
states reached with ``bincount``; only counts above zero leave a task, by the numbers of their nodes, which are turned
into phrases again when all tasks' counts are summed.  A task takes ``JOINED`` parts of the blocks, as what it sends
grows slower than its text, and gets them in Arrow batches of about ``BATCH``.

Phrases are told apart by the 64-bit hashes of their words.  All words of a language with the same hash must agree
in a second, independent hash; if two don't, everything starts over with other hashes.

Defined results: a null or empty text has no words, a null language is ``und``.  Repeated rows count each for
itself; ids aren't looked at.  Ties are broken by the phrase's bytes.  An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import io
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from salescope.llm.scratch import Scratch
from salescope.llm.words import _SPACE, give_back, hash_words, mix, released, text_blocks

LEAST = 30
LONGEST = 4
COVER = 80  # percent of a phrase's occurrences inside a longer one that drop it
TOP = 2_000
BLOCK = 1 << 22  # bytes of text in a block, about
FILTER = 1 << 27  # bits of a bitmap
CHUNK = 1 << 16  # bits of it that one group sets
PHRASES = 1 << 18  # in a trie, about
HELD = 1 << 21  # distinct buckets that a task merges before it sends them on
HELD_RUNS = 1 << 19  # distinct candidates, likewise
ROWS = 1 << 16  # in a batch that a task sends on, at most
JOINED = 3  # parts of the blocks, as Spark reads them, in a task
BATCH = "8m"  # of blocks, that a task is sent at once
LARGE = {"parquet.page.size.row.check.min": "1"}  # rows of megabytes: a page holds one, where a hundred would be put by default
FEW = {"spark.sql.execution.arrow.maxBytesPerBatch": BATCH, "spark.sql.parquet.columnarReaderBatchSize": "2"}
PLACES = ["h1", "h2", "h3", "h4"]
KEY = ["lang", "k", *PLACES]
PHRASE = "lang string, k int, h1 long, h2 long, h3 long, h4 long"


def _bytes_map(seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Bytes in lower case with piece ends as line feeds, and the same with others exchanged, for another hash."""
    plain = np.arange(256, dtype=np.uint8)
    plain[65:91] += 32
    plain[[ord(c) for c in ".,;:!?"]] = 10
    others, turned = np.flatnonzero(~_SPACE), np.arange(256, dtype=np.uint8)
    turned[others] = np.roll(others, seed)
    return plain, turned[plain]


def _block(data: np.ndarray, off: np.ndarray, seed: int, hasher: Callable) -> tuple:
    """Distinct word hashes, their second hashes and counts, the words, the text as places in these from 1 with 0 between pieces, and whether hashes clash."""
    (lower, hashed), (_, other) = ([table[data] for table in _bytes_map(k)] for k in (seed, seed + 100))
    firsts = np.unique(off[:-1][off[:-1] < len(data)])
    hashes, begin = hasher(hashed, firsts)
    second, _ = hash_words(other, firsts)
    distinct, first, place, count = np.unique(hashes, return_index=True, return_inverse=True, return_counts=True)
    clash = bool((second[first][place] != second).any())
    piece = np.cumsum((lower >= 10) & (lower <= 13), dtype=np.int32)[begin]
    row = np.searchsorted(off, begin, "right")
    new = np.zeros(len(begin), dtype=bool)
    new[1:] = (np.diff(piece) > 0) | (np.diff(row) > 0)
    tokens = np.zeros(len(begin) + int(new.sum()), dtype=np.int32)
    tokens[np.arange(len(begin)) + np.cumsum(new)] = place + 1
    spaces = np.append(np.flatnonzero(_SPACE[lower]), len(data))
    start = begin[first]
    end = np.minimum(spaces[np.searchsorted(spaces, start)], off[row[first]])
    raw = lower.tobytes()
    return distinct, second[first], count, [raw[a:b].decode() for a, b in zip(start.tolist(), end.tolist())], tokens, clash


def _blocks(seed: int, size: int, hasher: Callable, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        langs = pc.fill_null(batch.column(0), "und")
        for lang in pc.unique(langs).to_pylist():
            texts = batch.column(1).filter(pc.equal(langs, lang))
            for _, _, data, off in text_blocks(texts, size):
                hashes, second, counts, words, tokens, clash = _block(data, off, seed, hasher)
                if len(hashes):
                    lists = [pa.array([x]) for x in (hashes.view(np.int64), second.view(np.int64), counts, words)]
                    yield pa.RecordBatch.from_arrays([pa.array([lang]), *lists, pa.array([tokens.tobytes()], pa.binary()), pa.array([clash])], ["lang", "hashes", "second", "counts", "words", "tokens", "clash"])


def encoded(docs: DataFrame, scratch: Scratch, size: int = BLOCK, hasher: Callable = hash_words) -> tuple[DataFrame, DataFrame]:
    """Blocks of all texts, and every word per language by its hash: lang, h1, n."""
    texts = docs.select(F.col("lang").cast("string").alias("lang"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    seed = 0
    while True:
        schema = "lang string, hashes array<long>, second array<long>, counts array<long>, words array<string>, tokens binary, clash boolean"
        blocks = scratch.keep(texts.mapInArrow(released(partial(_blocks, seed, size, hasher)), schema), **LARGE)
        listed = blocks.select("lang", "clash", F.inline(F.arrays_zip(F.col("hashes").alias("h1"), F.col("second").alias("second"), F.col("counts").alias("n"))))
        words = scratch.keep(listed.groupBy("lang", "h1").agg(F.sum("n").alias("n"), F.min("second").alias("least"), F.max("second").alias("most"), F.bool_or("clash").alias("clash")))
        # Words of different languages never meet: a trie has a root for each.
        if words.filter("least <> most OR clash").isEmpty():
            return blocks, words.drop("least", "most", "clash")
        seed += 1


def _lang_key(lang: str) -> np.uint64:
    return np.uint64(int.from_bytes(hashlib.blake2b(lang.encode(), digest_size=8).digest(), "little"))


def _keys(lang: str, *parts: np.ndarray) -> np.ndarray:
    """64-bit keys of phrases, given as one array of word hashes for each place."""
    key = np.full(len(parts[0]), _lang_key(lang), dtype=np.uint64)
    for h in parts:
        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + h.astype(np.uint64))
    return key


def _word_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        langs = batch.column(0)
        for lang in pc.unique(langs).to_pylist():
            keys = _keys(lang, batch.column(1).filter(pc.equal(langs, lang)).to_numpy())
            yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64))], ["key"])


def word_keys(words: DataFrame) -> DataFrame:
    """The key of every word (lang, h1)."""
    return words.select("lang", "h1").mapInArrow(released(_word_keys), "key long")


def _set_bits(table: pa.Table) -> pa.Table:
    bits = np.zeros(CHUNK, dtype=bool)
    bits[table.column("bit").to_numpy()] = True
    return pa.table({"chunk": table.column("chunk").slice(0, 1), "bits": pa.array([np.packbits(bits, bitorder="little").tobytes()], pa.binary())})


def bitmap(keys: DataFrame) -> np.ndarray:
    """``FILTER`` bits, of which those of all keys are set: 16 MB, whatever their number."""
    bit = F.col("key").bitwiseAND(F.lit(FILTER - 1))
    bits = keys.select((bit / CHUNK).cast("long").alias("chunk"), (bit % CHUNK).alias("bit")).distinct()
    out = np.zeros((FILTER // CHUNK, CHUNK // 8), dtype=np.uint8)
    for r in bits.groupBy("chunk").applyInArrow(_set_bits, "chunk long, bits binary").collect():
        out[r["chunk"]] = np.frombuffer(r["bits"], np.uint8)
    return out.ravel()


def _in(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    at = keys % np.uint64(FILTER)
    return (bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1


def _counted(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The first place of each distinct number, every number's rank among them, and their counts."""
    _, first, rank, n = np.unique(ids, return_index=True, return_inverse=True, return_counts=True)
    return first, rank, n


Part = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]  # phrases of a language: keys, lengths, word hashes, counts


def _keys_at(lang: str, k: int, hashes: np.ndarray, tokens: np.ndarray, at: np.ndarray) -> np.ndarray:
    return _keys(lang, *(hashes[tokens[at + i] - 1] for i in range(k)))


def _phrases_at(lang: str, k: int, hashes: np.ndarray, tokens: np.ndarray, at: np.ndarray, n: np.ndarray) -> Part:
    own = np.zeros((len(at), LONGEST), np.int64)
    for i in range(k):
        own[:, i] = hashes[tokens[at + i] - 1].view(np.int64)
    return _keys(lang, *own[:, :k].T.view(np.uint64)), np.full(len(at), k, np.int32), own, n


def _joined(parts: list[Part]) -> Part:
    """Equal phrases as one; two with the same key but other words stay apart."""
    key, k, own, n = (np.concatenate(x) for x in zip(*parts))
    order = np.argsort(key)
    key, k, own, n = key[order], k[order], own[order], n[order]
    new = np.ones(len(key), dtype=bool)
    new[1:] = (key[1:] != key[:-1]) | (k[1:] != k[:-1]) | (own[1:] != own[:-1]).any(axis=1)
    first = np.flatnonzero(new)
    return key[first], k[first], own[first], np.add.reduceat(n, first) if len(first) else n


def _opened(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, np.ndarray, np.ndarray]]:
    for batch in batches:
        for i in range(batch.num_rows):
            hashes = batch.column(1).slice(i, 1).flatten().to_numpy().view(np.uint64)
            yield batch.column(0)[i].as_py(), hashes, np.frombuffer(batch.column(2)[i].as_buffer(), np.int32)


def _pair_places(lang: str, hashes: np.ndarray, tokens: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Where two words in a row lie in one piece and both are in the bitmap."""
    known = np.concatenate([[False], _in(words, _keys(lang, hashes))])[tokens]
    return np.flatnonzero(known[:-1] & known[1:])


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys, n = (np.concatenate(x) for x in zip(*parts))
    order = np.argsort(keys)
    keys, n = keys[order], n[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(n, first) if len(first) else n


def _packed(keys: np.ndarray, n: np.ndarray, ranges: int) -> Iterator[pa.RecordBatch]:
    """Sorted buckets and their sums, a row for each of ``ranges`` equal ranges: gaps and sums byte by byte, compressed."""
    cut = np.searchsorted(keys, (np.arange(ranges + 1, dtype=np.uint64) << np.uint64(32)) // np.uint64(ranges))
    every = np.flatnonzero(np.diff(cut))
    for begin in range(0, len(every), ROWS):
        some, data = every[begin : begin + ROWS], []
        for r in some.tolist():
            own = slice(cut[r], cut[r + 1])
            gaps = np.diff(keys[own], prepend=np.uint32(0))
            planes = [np.ascontiguousarray(x).view(np.uint8).reshape(len(gaps), -1).T.tobytes() for x in (gaps, n[own])]
            data.append(pa.compress(b"".join(planes), codec="zstd", asbytes=True))
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(np.diff(cut)[some].astype(np.int32)), pa.array(data, pa.binary())], ["range", "size", "data"])


def _unpacked(size: int, data: pa.Buffer) -> tuple[np.ndarray, np.ndarray]:
    planes = np.frombuffer(pa.decompress(data, 12 * size, codec="zstd"), np.uint8)
    gaps, n = (np.ascontiguousarray(x.reshape(-1, size).T).view(kind).ravel() for x, kind in ((planes[: 4 * size], np.uint32), (planes[4 * size :], np.int64)))
    return np.cumsum(gaps, dtype=np.uint32), n


def _frequent(least: int, table: pa.Table) -> pa.Table:
    """The buckets of a range whose sums reach the least count."""
    parts, held, room = [], 0, HELD
    try:
        for size, data in zip(table.column("size").to_pylist(), (x.as_buffer() for x in table.column("data"))):
            parts.append(_unpacked(size, data))
            held += size
            if held > 2 * room:
                parts = [_merged(parts)]
                held = len(parts[0][0])
                room = max(HELD, held)
        keys, n = _merged(parts)
        return pa.table({"key": pa.array(keys[n >= least].view(np.int32))})
    finally:
        give_back()


def _dealt(ranges: int, found: Iterator[tuple[np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
    """Buckets with the sums of a task, or of a part of it that holds ``HELD`` of them."""
    parts, held = [], 0
    for keys, n in found:
        parts.append((keys.astype(np.uint32), n))  # the lower bits
        held += len(n)
        if held > 2 * HELD:
            parts = [_merged(parts)]
            held = len(parts[0][0])
            if held > HELD:
                yield from _packed(*parts[0], ranges)
                parts, held = [], 0
    if parts:
        yield from _packed(*_merged(parts), ranges)


def _pairs(ranges: int, words: Callable[[], np.ndarray], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Buckets of pairs of frequent words."""

    def found() -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for lang, hashes, tokens in _opened(batches):
            at = _pair_places(lang, hashes, tokens, words())
            first, _, n = _counted(tokens[at].astype(np.int64) * (len(hashes) + 1) + tokens[at + 1])
            yield _keys_at(lang, 2, hashes, tokens, at[first]), n

    yield from _dealt(ranges, found())


def _runs(lang: str, hashes: np.ndarray, tokens: np.ndarray, words: np.ndarray, pairs: np.ndarray, longer: np.ndarray | None = None) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Runs of two words and more in a block, all of whose pairs are in the bitmap, and longer parts in theirs: lengths, places and counts."""
    at = _pair_places(lang, hashes, tokens, words)
    at = at[_in(pairs, _keys_at(lang, 2, hashes, tokens, at))]
    first, rank, n = _counted(tokens[at].astype(np.int64) * (len(hashes) + 1) + tokens[at + 1])
    yield 2, at[first], n
    for k in range(3, LONGEST + 1):
        found = np.zeros(len(tokens) + 1, dtype=bool)
        found[at] = True
        keep = found[at + 1]  # without its first word, too
        at, rank = at[keep], rank[keep]
        first, rank, n = _counted(rank.astype(np.int64) * (len(hashes) + 1) + tokens[at + k - 1])
        first = at[first]
        if longer is not None:
            hit = _in(longer, _keys_at(lang, k, hashes, tokens, first))
            at, rank, first, n = at[hit[rank]], rank[hit[rank]], first[hit], n[hit]
        yield k, first, n


def _triples(ranges: int, words: Callable[[], np.ndarray], pairs: Callable[[], np.ndarray], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Buckets of runs of three words and more."""
    runs = ((_keys_at(lang, k, hashes, tokens, at), n) for lang, hashes, tokens in _opened(batches) for k, at, n in _runs(lang, hashes, tokens, words(), pairs()) if k > 2)
    yield from _dealt(ranges, runs)


def _longer(words: Callable[[], np.ndarray], pairs: Callable[[], np.ndarray], batches: Iterator[pa.RecordBatch], longer: Callable[[], np.ndarray] = lambda: None) -> Iterator[pa.RecordBatch]:
    """Runs with the sums of a task, or of a part of it that holds ``HELD_RUNS`` of them."""
    parts: dict[str, list[Part]] = {}
    held = 0

    def rows() -> Iterator[pa.RecordBatch]:
        for lang in list(parts):
            _, k, own, n = _joined(parts.pop(lang))
            for i in range(0, len(k), ROWS):
                some = slice(i, i + ROWS)
                langs = pa.DictionaryArray.from_arrays(pa.array(np.zeros(len(k[some]), np.int32)), pa.array([lang])).dictionary_decode()
                yield pa.RecordBatch.from_arrays([langs, pa.array(k[some]), *[pa.array(np.ascontiguousarray(h)) for h in own[some].T], pa.array(n[some])], [*KEY, "n"])

    for lang, hashes, tokens in _opened(batches):
        for k, at, n in _runs(lang, hashes, tokens, words(), pairs(), longer()):
            parts.setdefault(lang, []).append(_phrases_at(lang, k, hashes, tokens, at, n))
            held += len(n)
        if held > 2 * HELD_RUNS:
            parts = {x: [_joined(own)] for x, own in parts.items()}
            held = sum(len(own[0][0]) for own in parts.values())
            if held > HELD_RUNS:
                yield from rows()
                held = 0
    yield from rows()


def _placed(parent: np.ndarray, code: np.ndarray, nodes: int, codes: int) -> tuple[np.ndarray, np.ndarray]:
    """Bases of all nodes, and the place of each child, such that no two children share one.

    Children come sorted by parent.  Nodes with many children are placed first, at the first base that
    fits; the many with one child take what is left.
    """
    base, place = np.zeros(nodes, np.int64), np.zeros(len(parent), np.int64)
    owners, begin, size = np.unique(parent, return_index=True, return_counts=True)
    used, low, at, last = np.zeros(len(parent) + 2 * codes + 2, dtype=bool), 0, 0, 0
    for i in np.argsort(-size, kind="stable")[: int((size > 1).sum())].tolist():
        own = code[begin[i] : begin[i] + size[i]]
        # Bases rise, so a search goes on where the last one ended; nodes with few children also fill the gaps left before.
        if len(own) != last and len(own) <= 8:
            at = low
        last = len(own)
        step = 64
        while True:
            while at + step + codes + 1 > len(used):
                used = np.concatenate([used, np.zeros(len(used), dtype=bool)])
            fits = ~used[np.arange(at, at + step)[:, None] + own].any(axis=1)
            if fits.any():
                at += int(fits.argmax())
                break
            at, step = at + step, min(4 * step, max(64, 65_536 // len(own)))
        used[at + own] = True
        place[begin[i] : begin[i] + size[i]] = at + own
        base[owners[i]] = at
        if i % 64 == 0:  # bases below the first gap can't fit any more
            low = max(0, int((~used).argmax()) - codes)
    single = begin[size == 1]
    free = np.flatnonzero(~np.concatenate([used[codes:], np.zeros(len(single), dtype=bool)]))[: len(single)] + codes
    place[single] = free
    base[parent[single]] = free - code[single]
    return base, place


class Trie:
    """Phrases as a double array over the numbers of their words; each language has a root of its own."""

    def __init__(self, langs: list[str], lang: np.ndarray, length: np.ndarray, hashes: np.ndarray):
        """One phrase a row: its language as a place in ``langs``, its length, and ``LONGEST`` word hashes, of which the first so many count."""
        self.langs = langs
        real = np.arange(LONGEST)[None, :] < length[:, None]
        self.words = np.unique(hashes[real])
        codes = np.where(real, np.searchsorted(self.words, hashes) + 1, 0)
        at = lang.astype(np.int64)
        parents, of_code, self.accepts = [], [], np.zeros(0, dtype=bool)
        count = len(self.langs)
        accepts = [np.zeros(count, dtype=bool)]
        for k in range(LONGEST):
            rows = np.flatnonzero(length > k)
            ids, rank = np.unique(at[rows] * (len(self.words) + 1) + codes[rows, k], return_inverse=True)
            parents.append(ids // (len(self.words) + 1))
            of_code.append(ids % (len(self.words) + 1))
            ends = np.zeros(len(ids), dtype=bool)
            ends[rank[length[rows] == k + 1]] = True
            accepts.append(ends)
            at[rows] = count + rank
            count += len(ids)
        parent, code = np.concatenate(parents), np.concatenate(of_code)
        base, place = _placed(parent, code, count, len(self.words) + 1)
        room = max(int(base.max(initial=0)), 0) + len(self.words) + 2
        self.check, self.child = np.full(room, -1, np.int32), np.zeros(room, np.int32)
        self.check[place] = parent
        self.child[place] = np.arange(len(self.langs), count)
        self.base, self.accepts = base.astype(np.int32), np.concatenate(accepts)
        roots = np.full(len(self.langs), -1)
        self.parent = np.concatenate([roots, parent]).astype(np.int32)
        self.code = np.concatenate([np.zeros(len(self.langs), np.int64), code]).astype(np.int32)

    @classmethod
    def build(cls, table: pa.Table) -> Trie:
        langs = sorted(set(table.column("lang").to_pylist()))
        hashes = np.stack([table.column(p).to_numpy() for p in PLACES], axis=1).view(np.uint64)
        return cls(langs, pc.index_in(table.column("lang"), pa.array(langs)).to_numpy(), table.column("k").to_numpy(), hashes)

    def dump(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, langs=np.array(self.langs, dtype=np.str_), **{k: v for k, v in vars(self).items() if k != "langs"})
        return out.getvalue()

    @classmethod
    def load(cls, data: bytes) -> Trie:
        self = cls.__new__(cls)
        with np.load(io.BytesIO(data)) as parts:
            vars(self).update({k: parts[k] for k in parts.files})
        self.langs = self.langs.tolist()
        return self

    def count(self, lang: str, hashes: np.ndarray, tokens: np.ndarray, counts: np.ndarray) -> None:
        """Add to ``counts`` how many text positions reach each node; all positions step together."""
        if lang not in self.langs or not len(self.words):
            return
        at = np.minimum(np.searchsorted(self.words, hashes), len(self.words) - 1)
        own = np.where(self.words[at] == hashes, at + 1, 0).astype(np.int32)
        codes = np.concatenate([np.zeros(1, np.int32), own])[tokens]
        place = np.flatnonzero(codes)
        state = np.full(len(place), self.langs.index(lang), np.int32)
        for _ in range(LONGEST):
            slot = self.base[state] + codes[place]
            alive = self.check[slot] == state
            state, place = self.child[slot[alive]], place[alive] + 1
            counts += np.bincount(state, minlength=len(counts))
            further = place < len(codes)
            further[further] = codes[place[further]] > 0
            state, place = state[further], place[further]

    def reached(self, counts: np.ndarray) -> np.ndarray:
        """The nodes where a phrase counted at least once ends."""
        return np.flatnonzero(self.accepts & (counts > 0))

    def found(self, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
        """The phrases counted at least once, with their counts."""
        every = self.reached(counts)
        yield from self.named(every, counts[every])

    def named(self, every: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
        """The phrases that end at these nodes, with these counts."""
        for begin in range(0, len(every), ROWS):
            nodes = every[begin : begin + ROWS]
            length, hashes, at = np.zeros(len(nodes), np.int32), np.zeros((len(nodes), LONGEST), np.int64), nodes.copy()
            paths = []
            while (inner := self.parent[at] >= 0).any():
                paths.append(np.where(inner, self.code[at], 0))
                length += inner
                at = np.where(inner, self.parent[at], at)
            for back, code in enumerate(paths):
                rows = np.flatnonzero(code)
                hashes[rows, length[rows] - 1 - back] = self.words[code[rows] - 1].view(np.int64)
            langs = pa.array(self.langs, pa.string()).take(pa.array(at))
            yield pa.RecordBatch.from_arrays([langs, pa.array(length), *[pa.array(np.ascontiguousarray(h)) for h in hashes.T], pa.array(n[begin : begin + ROWS])], [*KEY, "n"])


def _build(table: pa.Table) -> pa.Table:
    try:
        return pa.table({"shard": table.column("shard").slice(0, 1), "trie": pa.array([Trie.build(table).dump()], pa.binary())})
    finally:
        give_back()


def _advance(data: Callable[[], bytes], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    trie = Trie.load(data())
    counts = np.zeros(len(trie.base), np.int64)
    for lang, hashes, tokens in _opened(batches):
        trie.count(lang, hashes, tokens, counts)
    every = trie.reached(counts)
    for begin in range(0, len(every), ROWS):
        nodes = every[begin : begin + ROWS]
        yield pa.RecordBatch.from_arrays([pa.array(nodes.astype(np.int32)), pa.array(counts[nodes])], ["node", "n"])


def _phrases_of(data: Callable[[], bytes], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    trie = None
    for batch in batches:
        trie = trie or Trie.load(data())
        yield from trie.named(batch.column(0).to_numpy().astype(np.int64), batch.column(1).to_numpy())


class _Sent:
    """A broadcast value, fetched in the task."""

    def __init__(self, spark, value):
        self.sent = spark.sparkContext.broadcast(value)

    def __call__(self):
        return self.sent.value


def _sums(rows: DataFrame, *keys: str) -> DataFrame:
    """``n`` by keys. Tasks have summed what they send, so it is dealt by key before Spark sums: no task holds it once more."""
    return rows.repartition(*keys).groupBy(*keys).agg(F.sum("n").alias("n"))


@contextmanager
def _scanned(blocks: DataFrame) -> Iterator[DataFrame]:
    """What a pass reads of the blocks, for jobs that run inside."""
    conf = blocks.sparkSession.conf
    before = {name: conf.get(name) for name in FEW}
    try:
        for name, value in FEW.items():
            conf.set(name, value)
        parts = blocks.rdd.getNumPartitions()
        least = min(parts, 2 * blocks.sparkSession.sparkContext.defaultParallelism)
        yield blocks.select("lang", "hashes", "tokens").coalesce(max(1, least, -(-parts // JOINED)))
    finally:
        for name, value in before.items():
            conf.set(name, value)


def candidates(blocks: DataFrame, words: DataFrame, scratch: Scratch, least: int) -> DataFrame:
    """Phrases of two words and more whose parts and sums allow the least count."""
    spark = blocks.sparkSession
    common = _Sent(spark, bitmap(word_keys(words.filter(F.col("n") >= least))))
    ranges = blocks.rdd.getNumPartitions()  # buckets of a range fit a task, as a part of the blocks does

    def frequent(sent: Callable) -> _Sent:
        buckets = scan.mapInArrow(released(sent), "range int, size int, data binary")
        return _Sent(spark, bitmap(buckets.groupBy("range").applyInArrow(lambda table: _frequent(least, table), "key int")))

    with _scanned(blocks) as scan:
        pairs = frequent(partial(_pairs, ranges, common))
        longer = frequent(partial(_triples, ranges, common, pairs))
        rows = scan.mapInArrow(released(partial(_longer, common, pairs, longer=longer)), f"{PHRASE}, n long")
        found = scratch.keep(_sums(rows, *KEY).filter(F.col("n") >= least).drop("n"))
    for known in (common, pairs, longer):
        known.sent.destroy()
    return found


def counts(blocks: DataFrame, phrases: DataFrame, scratch: Scratch, size: int = PHRASES) -> DataFrame:
    """How often each of ``phrases`` occurs, by tries of about ``size`` phrases, one after the other."""
    spark = blocks.sparkSession
    shards = max(1, -(-phrases.count() // size))
    dealt = phrases.withColumn("shard", F.pmod(F.xxhash64(*KEY), F.lit(shards)).cast("int"))
    tries = scratch.keep(dealt.groupBy("shard").applyInArrow(_build, "shard int, trie binary"), **LARGE)
    found = None
    for shard in range(shards):
        row = tries.filter(F.col("shard") == shard).first()
        if row is None:
            continue
        trie = _Sent(spark, bytes(row["trie"]))
        del row
        with _scanned(blocks) as scan:
            sums = _sums(scan.mapInArrow(released(partial(_advance, trie)), "node int, n long"), "node")
            part = scratch.keep(sums.mapInArrow(released(partial(_phrases_of, trie)), f"{PHRASE}, n long"))
        trie.sent.destroy()
        found = part if found is None else found.union(part)
    scratch.drop(tries)
    return spark.createDataFrame([], f"{PHRASE}, n long") if found is None else found


def _part(k: str, begin: int, length: int) -> dict[str, object]:
    """The phrase of ``length`` words from place ``begin`` (0-based) as key columns."""
    own = [F.col(PLACES[begin + i]) if i < length else F.lit(0).cast("long") for i in range(LONGEST)]
    return {k: F.lit(length), **{f"{k}{i + 1}": h for i, h in enumerate(own)}}


def _named(name: str, begin: int, length: int):
    return [c.alias(n) for n, c in _part(name, begin, length).items()]


def scored(found: DataFrame) -> DataFrame:
    """Per phrase of two words and more: its count ``a``, and counts and score of its lowest cut."""
    cuts = None
    for k in range(2, LONGEST + 1):
        for cut in range(1, k):
            part = found.filter(F.col("k") == k).select(*KEY, F.col("n").alias("a"), F.lit(cut).alias("cut"), *_named("x", 0, cut), *_named("y", cut, k - cut))
            cuts = part if cuts is None else cuts.union(part)
    of = lambda name, count: found.select(F.col("lang").alias(f"{name}lang"), F.col("k").alias(name), *[F.col(p).alias(f"{name}{i + 1}") for i, p in enumerate(PLACES)], F.col("n").alias(count))
    for name, count in (("x", "l"), ("y", "r")):
        other = of(name, count)
        same = cuts["lang"] == other[f"{name}lang"]
        for c in (name, *[f"{name}{i + 1}" for i in range(LONGEST)]):
            same = same & (cuts[c] == other[c])
        cuts = cuts.join(other, same).select(*[cuts[c] for c in cuts.columns], other[count])
    score = F.expr("CAST((CAST(2000000 AS DECIMAL(8,0)) * CAST(a AS DECIMAL(20,0))) div (CAST(l AS DECIMAL(20,0)) + CAST(r AS DECIMAL(20,0))) AS BIGINT)")
    lowest = cuts.groupBy(*KEY, "a").agg(F.min(F.struct(score.alias("score"), "cut", "l", "r")).alias("low"))
    return lowest.select(*KEY, "a", "low.l", "low.r", "low.score")


def covered(found: DataFrame, percent: int) -> DataFrame:
    """Phrases of which a longer one holds at least ``percent`` of the occurrences."""
    parts = [(k, begin, length) for k in range(3, LONGEST + 1) for length in range(2, k) for begin in range(k - length + 1)]
    inside = None
    for k, begin, length in parts:
        own = _part("k", begin, length)
        row = found.filter(F.col("k") == k).select("lang", own["k"].alias("k"), *[own[f"k{i + 1}"].alias(p) for i, p in enumerate(PLACES)], F.col("n").alias("longer"))
        inside = row if inside is None else inside.union(row)
    most = inside.groupBy(*KEY).agg(F.max("longer").alias("longer"))
    wide = lambda c: F.col(c).cast("decimal(20,0)")
    return found.join(most, KEY).filter(wide("longer") * 100 >= wide("n") * percent).select(*KEY)


def _spelled(needed: Callable[[], np.ndarray], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            hashes, words = (batch.column(c).slice(i, 1).flatten() for c in (1, 2))
            hit = pa.array(_in(needed(), _keys(batch.column(0)[i].as_py(), hashes.to_numpy())))
            langs = pa.array([batch.column(0)[i].as_py()] * pc.sum(hit).as_py() if len(hit) else [], pa.string())
            yield pa.RecordBatch.from_arrays([langs, hashes.filter(hit), words.filter(hit)], ["lang", "h1", "word"])


def spelled(phrases: DataFrame, blocks: DataFrame) -> DataFrame:
    """The phrases' keys and texts, with words from the blocks' dictionaries."""
    parts = phrases.select(*KEY, F.posexplode(F.slice(F.array(*PLACES), 1, F.col("k"))).alias("place", "h"))
    own = parts.select("lang", F.col("h").alias("h1")).distinct()
    needed = _Sent(blocks.sparkSession, bitmap(word_keys(own)))
    words = blocks.select("lang", "hashes", "words").mapInArrow(released(partial(_spelled, needed)), "lang string, h1 long, word string").distinct()
    whole = parts.join(words.withColumnRenamed("h1", "h"), ["lang", "h"])
    return whole.groupBy(*KEY).agg(F.sort_array(F.collect_list(F.struct("place", "word"))).alias("w")).select(*KEY, F.array_join("w.word", " ").alias("phrase"))


def collocations(docs: DataFrame, scratch: Scratch, least: int = LEAST, top: int = TOP, percent: int = COVER, size: int = PHRASES) -> DataFrame:
    """Each language's ``top`` phrases: lang, rank, phrase, a, l, r, n, score."""
    blocks, words = encoded(docs, scratch)
    zero = [F.lit(0).cast("long").alias(p) for p in PLACES[1:]]
    singles = words.filter(F.col("n") >= least).select("lang", F.lit(1).alias("k"), "h1", *zero, "n")
    totals = words.groupBy("lang").agg(F.sum("n").alias("n"))
    likely = candidates(blocks, words, scratch, least)
    counted = counts(blocks, likely, scratch, size).filter(F.col("n") >= least)
    scratch.drop(likely)
    found = scratch.keep(counted.union(singles))
    left = scored(found).join(covered(found, percent), KEY, "left_anti")
    # Phrases beyond the last place by numbers alone needn't be spelled; ties at that place are all kept.
    numbers = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"))
    left = scratch.keep(left.withColumn("rank", F.rank().over(numbers)).filter(F.col("rank") <= top).drop("rank"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = left.join(spelled(left, blocks), KEY).withColumn("rank", F.row_number().over(order).cast("long")).filter(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
