"""Near-duplicate documents: MinHash bands, sequential Bayesian pruning, exact verification.

A text's set holds its distinct runs of a few words (the whole sequence as one where it is shorter), in
lower case for A-Z.  Texts with equal sets are one node, the smallest of their ids.  Nodes that share
a band of their signatures are candidates.  For comparison two bits of each minimum are kept.  These
are compared batch by batch, and a pair goes as soon as the posterior probability of reaching the similarity, under a uniform prior,
falls below ``MISS``.  Survivors are confirmed on full sets, made from the whole texts.

No bucket is expanded into its pairs.  In each of a few rounds every node is compared only with one
centre of each bucket that still holds several components, drawn anew for each bucket and round, and
only its most similar centre is confirmed; so a bucket with a third of all nodes costs as many rows as it has nodes.  What is left
after that, nodes of different components in one bucket, is compared in full, so that no link is lost but with a
probability of about 1e-6 by the bands and ``MISS`` by pruning.  That is done in tiles: nodes joined by
buckets are one crowd, a crowd is dealt into tiles of a bounded number of nodes, and two tiles meet in one group.  In a first turn
signatures meet: pairs that share a band and are of different components are pruned as above, square by
square in numpy, and only which nodes survivors join is sent on, at most a row for each node.  These smaller crowds meet
again with their whole texts, where common shingles of all pairs are counted.  So neither turn sends pairs, and a crowd costs rows in
proportion to its nodes times its tiles; its comparisons grow with the square of its nodes.

Defined results: null and empty texts have no shingles and no links.  A null id is linked with
nothing, its component is null, and it is kept.  Rows that repeat an id are judged each by its own
text, and a link of one is a link of the id: all its rows have one component.  Other columns of the input are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salescope.llm.components import Forest, components
from salescope.llm.scratch import Scratch
from salescope.llm.words import mix, released, shingles, word_blocks
from salescope.session import spread


@dataclass(frozen=True)
class Setting:
    """Words in a shingle, least similarity in percent, and bands of so many rows of the signature.

    A pair at the threshold shares no band with a probability of about 1e-6 for the settings below.
    """

    width: int
    threshold: int
    bands: int
    rows: int

    @property
    def hashes(self) -> int:
        return self.bands * self.rows  # a multiple of four


QUERY = Setting(3, 85, 43, 8)
STAGE = Setting(5, 80, 46, 6)
BATCH = 10  # bytes of the signature, with four minima in each
MISS = 1e-7
ROUNDS = 4
CHUNK = 64  # members that are confirmed against one centre in one group
SIGNATURES = 4_096  # nodes in a tile that meets by signatures
TEXTS = 512  # and by texts
SQUARE = 256  # rows and columns that are compared at once
COLUMNS = 8_192  # shingles counted by one product


def shingle_set(h: np.ndarray, width: int) -> np.ndarray:
    """Sorted distinct shingle hashes of one text's word hashes."""
    if 0 < len(h) < width:
        return shingles(h, len(h)) ^ np.uint64(len(h))
    return np.unique(shingles(h, width))


def _functions(n: int) -> tuple[np.ndarray, np.ndarray]:
    factors = (mix(np.arange(1, n + 1, dtype=np.uint64)) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
    return factors, mix(np.arange(1001, n + 1001, dtype=np.uint64)).astype(np.uint32)


def minima(s: np.ndarray, factors: np.ndarray, shifts: np.ndarray) -> np.ndarray:
    """Minimum of each hash function over a set that isn't empty."""
    x = (s ^ (s >> np.uint64(32))).astype(np.uint32)
    low = np.full(len(factors), 0xFFFFFFFF, dtype=np.uint32)
    room = np.empty((min(len(x), 128), len(factors)), dtype=np.uint32)
    for at in range(0, len(x), 128):
        part = x[at : at + 128, None]
        work = room[: len(part)]
        np.multiply(part, factors, out=work)
        np.add(work, shifts, out=work)
        np.minimum(low, work.min(axis=0), out=low)
    return low


def band_keys(low: np.ndarray, setting: Setting) -> np.ndarray:
    """One 64-bit key for each band, its number included."""
    rows = low.reshape(setting.bands, setting.rows).astype(np.uint64)
    key = np.arange(1, setting.bands + 1, dtype=np.uint64)
    for j in range(setting.rows):
        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + rows[:, j])
    return key


def signature(low: np.ndarray) -> np.ndarray:
    """Two bits of each minimum, four in a byte."""
    bits = ((low ^ (low >> 7) ^ (low >> 15)) & 3).astype(np.uint8).reshape(-1, 4)
    return bits[:, 0] | bits[:, 1] << 2 | bits[:, 2] << 4 | bits[:, 3] << 6


def _features(setting: Setting):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        functions = _functions(setting.hashes)
        for batch in batches:
            ids = batch.column(0)
            for lo, hi, hashes, begin in word_blocks(batch.column(1), lower=True):
                n, one, two, keys, sig = [], [], [], [], []
                for i in range(hi - lo):
                    s = shingle_set(hashes[begin[i] : begin[i + 1]], setting.width)
                    n.append(len(s))
                    one.append(s.sum(dtype=np.uint64).astype(np.int64))
                    two.append(mix(s ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64).astype(np.int64))
                    low = minima(s, *functions) if len(s) else None
                    keys.append(None if low is None else band_keys(low, setting).tobytes())
                    sig.append(None if low is None else signature(low).tobytes())
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(lo, hi - lo), pa.array(n, pa.int64()), pa.array(one, pa.int64()), pa.array(two, pa.int64()), pa.array(keys, pa.binary()), pa.array(sig, pa.binary())],
                    ["doc_id", "n_shingles", "fp1", "fp2", "keys", "sig"],
                )

    return run


def _band_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = batch.column(1).to_pylist()
        nodes = np.repeat(batch.column(0).to_numpy(), [len(x) // 8 for x in lists])
        keys = np.frombuffer(b"".join(lists), dtype=np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(nodes)], ["key", "node"])


def least_matches(setting: Setting, miss: float | None = None) -> dict[int, int]:
    """For each number of compared minima, the fewest matches that keep a pair.

    Two bits match with probability (1 + 3 s) / 4 for similarity s.  With a uniform prior, the posterior of
    s after m matches of n is proportional to the likelihood of m; it is summed over a fine grid.
    """
    miss = MISS if miss is None else miss
    s = (np.arange(20_000) + 0.5) / 20_000
    match, differ = np.log((1 + 3 * s) / 4), np.log(3 * (1 - s) / 4)
    high, out = s >= setting.threshold / 100, {}
    for n in [*range(4 * BATCH, setting.hashes, 4 * BATCH), setting.hashes]:
        m = 0
        while True:
            x = m * match + (n - m) * differ
            x = np.exp(x - x.max())
            if x[high].sum() >= miss * x.sum():
                break
            m += 1
        out[n] = m
    return out


def _prune(setting: Setting):
    need = least_matches(setting)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            left, right = (np.frombuffer(b"".join(batch.column(i).to_pylist()), dtype=np.uint8).reshape(batch.num_rows, -1) for i in (2, 3))
            alive, matches, at = np.arange(batch.num_rows), np.zeros(batch.num_rows, dtype=np.int64), 0
            for n, m in need.items():
                x = left[alive, at : n // 4] ^ right[alive, at : n // 4]
                differ = np.bitwise_count((x | x >> 1) & 0x55).sum(axis=1, dtype=np.int64)
                matches[alive] += 4 * x.shape[1] - differ
                alive, at = alive[matches[alive] >= m], n // 4
            rows = pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(matches)], ["a", "b", "matches"])
            yield rows.take(pa.array(alive))

    return run


def likely(pairs: DataFrame, signatures: DataFrame, setting: Setting) -> DataFrame:
    """The pairs (a, b) whose similarity may still reach the threshold, with their matching minima.

    Sets whose sizes alone keep them apart go first.
    """
    of = lambda end: signatures.select(F.col("node").alias(end), F.col("sig").alias(f"sig_{end}"), F.col("n").alias(f"n_{end}"))
    fits = F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * setting.threshold
    joined = pairs.join(of("a"), "a").join(of("b"), "b").filter(fits).select("a", "b", "sig_a", "sig_b")
    return joined.mapInArrow(_prune(setting), "a long, b long, matches long")


def _confirm(setting: Setting):
    def run(table: pa.Table) -> pa.Table:
        centre = table.column("a")[0].as_py()
        sets: dict[int, list[np.ndarray]] = {}
        table = table.combine_chunks()
        ids, at = table.column("id").to_pylist(), 0
        for texts in table.column("text").chunks:
            for lo, hi, hashes, begin in word_blocks(texts, lower=True):
                for i in range(lo, hi):
                    sets.setdefault(ids[at + i], []).append(shingle_set(hashes[begin[i - lo] : begin[i - lo + 1]], setting.width))
            at += len(texts)
        linked = set()
        for node, own in sets.items():
            if node != centre:
                for x in own:
                    for y in sets.get(centre, []):
                        both = len(np.intersect1d(x, y, assume_unique=True))
                        if both and 100 * both >= setting.threshold * (len(x) + len(y) - both):
                            linked.add(node)
        return pa.table({"a": pa.array([centre] * len(linked), pa.int64()), "b": pa.array(sorted(linked), pa.int64())})

    return run


def confirmed(pairs: DataFrame, texts: DataFrame, setting: Setting) -> DataFrame:
    """The pairs (a, b) whose full sets reach the threshold.

    A group holds one centre's text and those of at most about ``CHUNK`` partners; a centre with more
    of them is sent to several groups.
    """
    degree = pairs.groupBy("a").agg(F.count("*").alias("n"))
    dealt = pairs.join(degree, "a").select("a", F.expr(f"pmod(xxhash64(b), (n + {CHUNK} - 1) div {CHUNK})").alias("chunk"), "b")
    members = dealt.select("a", "chunk", F.col("b").alias("id"))
    centres = dealt.select("a", "chunk").distinct().select("a", "chunk", F.col("a").alias("id"))
    rows = members.union(centres).join(texts.withColumnRenamed("node", "id"), "id").select("a", "chunk", "id", "text")
    return rows.groupBy("a", "chunk").applyInArrow(_confirm(setting), "a long, b long")


def _survivors(setting: Setting):
    """Of two tiles of a crowd, which nodes are joined by pairs that may reach the similarity."""
    need = least_matches(setting)

    def run(table: pa.Table) -> pa.Table:
        node, comp, order, cut, same = _tiles(table)
        n = table.column("n").to_numpy()[order]
        keys = np.frombuffer(b"".join(table.column("keys").to_pylist()), dtype=np.int64).reshape(len(node), -1)[order]
        sig = np.frombuffer(b"".join(table.column("sig").to_pylist()), dtype=np.uint8).reshape(len(node), -1)[order]
        trees = Forest(len(node))
        for a, b in _squares(cut, len(node), same):
            # A pair that is joined already needs no comparison.
            left, right = np.nonzero((comp[a, None] != comp[None, b]) & trees.apart(a, b) & (np.minimum(n[a, None], n[None, b]) * 100 >= np.maximum(n[a, None], n[None, b]) * setting.threshold))
            shared = np.zeros(len(left), dtype=bool)
            for k in range(keys.shape[1]):
                shared |= keys[a][left, k] == keys[b][right, k]
            left, right, at, matches = left[shared], right[shared], 0, 0
            for bits, least in need.items():
                x = sig[a][left, at : bits // 4] ^ sig[b][right, at : bits // 4]
                matches = matches + 4 * x.shape[1] - np.bitwise_count((x | x >> 1) & 0x55).sum(axis=1, dtype=np.int64)
                alive = matches >= least
                left, right, matches, at = left[alive], right[alive], matches[alive], bits // 4
            linked = np.zeros((a.stop - a.start, b.stop - b.start), dtype=bool)
            linked[left, right] = True
            trees.join(linked, a, b)
        return _edges(node, trees)

    return run


def common(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all pairs of sets, by products over the shingles that both sides have."""
    out = np.zeros((len(left), len(right)), dtype=np.int64)
    both = np.intersect1d(np.concatenate(left), np.concatenate(right))
    places = []
    for sets in (left, right):
        at = np.searchsorted(both, every := np.concatenate(sets))
        hit = at < len(both)
        hit[hit] = both[at[hit]] == every[hit]
        places.append((np.repeat(np.arange(len(sets)), [len(s) for s in sets])[hit], at[hit]))
    for lo in range(0, len(both), COLUMNS):
        size, tables = min(COLUMNS, len(both) - lo), []
        for (row, at), sets in zip(places, (left, right)):
            table = np.zeros((len(sets), size), dtype=np.float32)
            here = (at >= lo) & (at < lo + size)
            table[row[here], at[here] - lo] = 1
            tables.append(table)
        out += (tables[0] @ tables[1].T).astype(np.int64)
    return out


def _linked(setting: Setting):
    """Of two tiles of a crowd, which nodes are joined by pairs that reach the similarity."""

    def run(table: pa.Table) -> pa.Table:
        node, comp, order, cut, same = _tiles(table)
        sets = []
        for texts in table.column("text").chunks:
            for lo, hi, hashes, begin in word_blocks(texts, lower=True):
                sets += [shingle_set(hashes[begin[i] : begin[i + 1]], setting.width) for i in range(hi - lo)]
        sets = [sets[i] for i in order]
        trees = Forest(len(node))
        for a, b in _squares(cut, len(node), same):
            unlike = comp[a, None] != comp[None, b]
            if (unlike & trees.apart(a, b)).any():
                both = common(sets[a], sets[b])
                union = np.array([len(s) for s in sets[a]])[:, None] + np.array([len(s) for s in sets[b]])[None, :] - both
                trees.join(unlike & (both > 0) & (100 * both >= setting.threshold * union), a, b)
        return _edges(node, trees)

    return run


def _tiles(table: pa.Table):
    """Nodes and components with the first tile's rows first; that order, the first tile's size, and whether it meets itself."""
    own, first = table.column("own").to_numpy(), table.column("first").to_numpy()
    order = np.argsort(own != first, kind="stable")
    node, comp = (table.column(c).to_numpy()[order] for c in ("node", "comp"))
    return node, comp, order, int((own == first).sum()), bool(first[0] == table.column("second")[0].as_py())


def _squares(cut: int, size: int, same: bool) -> Iterator[tuple[slice, slice]]:
    for i in range(0, cut, SQUARE):
        rows = slice(i, min(i + SQUARE, cut))
        for j in range(i if same else cut, size, SQUARE):
            yield rows, slice(j, min(j + SQUARE, size))


def _edges(node: np.ndarray, trees: Forest) -> pa.Table:
    hit = np.flatnonzero(node[trees.root] != node)
    return pa.table({"a": node[trees.root[hit]], "b": node[hit]})


def _meet(crowds: DataFrame, rows: DataFrame, tile: int, run) -> DataFrame:
    """Edges (a, b) found by ``run`` among the nodes of each crowd (node, crowd), of which ``rows`` holds the columns."""
    sizes = crowds.groupBy("crowd").agg(F.ceil(F.count("*") / tile).cast("int").alias("tiles"))
    dealt = crowds.join(sizes, "crowd").withColumn("own", F.pmod(F.xxhash64("node"), "tiles").cast("int"))
    met = F.transform(F.sequence(F.lit(0), F.col("tiles") - 1), lambda u: F.struct(F.least("own", u).alias("first"), F.greatest("own", u).alias("second")))
    sent = dealt.select("node", "crowd", "own", F.explode(met).alias("m")).select("node", "crowd", "own", "m.*").join(rows, "node")
    return spread(sent, "crowd", "first", "second").groupBy("crowd", "first", "second").applyInArrow(run, "a long, b long")


def crowd_links(rest: DataFrame, features: DataFrame, texts: DataFrame, scratch: Scratch, setting: Setting) -> DataFrame:
    """All links (a, b), or as good ones, among nodes of different components in one bucket.

    ``rest`` holds key, node, comp; ``features`` node, n, keys, sig; ``texts`` node, text.
    """
    named = lambda edges: components(edges, scratch).withColumnRenamed("comp", "crowd")
    stars = rest.groupBy("key").agg(F.min("node").alias("a")).join(rest.select("key", "node"), "key").select("a", F.col("node").alias("b"))
    nodes = scratch.keep(rest.select("node", "comp").distinct())
    near = scratch.keep(_meet(named(stars), nodes.join(features, "node"), SIGNATURES, _survivors(setting)))
    return near if near.isEmpty() else _meet(named(near), nodes.join(texts, "node"), TEXTS, _linked(setting))


def duplicates(docs: DataFrame, scratch: Scratch, setting: Setting = QUERY) -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles, component_id (the smallest id reachable), kept."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    feats = scratch.keep(texts.mapInArrow(released(_features(setting)), "doc_id long, n_shingles long, fp1 long, fp2 long, keys binary, sig binary"))
    same = ["fp1", "fp2", "n_shingles"]
    full = feats.filter("n_shingles > 0 AND doc_id IS NOT NULL")
    reps = scratch.keep(full.groupBy(*same).agg(F.min(F.struct(F.col("doc_id").alias("node"), "keys", "sig")).alias("r")).select(*same, "r.*"))

    bands = reps.select("node", "keys").mapInArrow(_band_rows, "key long, node long")
    shared = bands.groupBy("key").agg(F.min("node").alias("lo"), F.max("node").alias("hi")).filter("lo < hi").select("key")
    buckets = scratch.keep(bands.join(shared, "key"))
    nodes = scratch.keep(buckets.select("node").distinct())
    features = scratch.keep(reps.join(nodes, "node").select("node", F.col("n_shingles").alias("n"), "keys", "sig"))
    signatures = features.select("node", "sig", "n")
    texts = scratch.keep(texts.join(nodes.withColumnRenamed("node", "doc_id"), "doc_id").select(F.col("doc_id").alias("node"), "text"))

    labels = scratch.keep(nodes.select("node", F.col("node").alias("comp")))
    for turn in range(ROUNDS + 1):
        members = buckets.join(labels, "node")
        open_keys = members.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.min(F.struct((F.xxhash64("node", "key", F.lit(turn)) if turn else F.col("node")).alias("order"), F.col("node").alias("centre"), F.col("comp").alias("of"))).alias("c")).filter("lo < hi")
        spent = []
        if turn < ROUNDS:
            pairs = members.join(open_keys.select("key", "c.centre", "c.of"), "key").filter("comp <> of").select(F.col("centre").alias("a"), F.col("node").alias("b")).distinct()
            pairs = scratch.keep(pairs)
            if pairs.isEmpty():  # every bucket lies in one component
                break
            best = likely(pairs, signatures, setting).groupBy("b").agg(F.max(F.struct("matches", (-F.col("a")).alias("a"))).alias("x")).select((-F.col("x.a")).alias("a"), "b")
            best = scratch.keep(best)
            links = scratch.keep(confirmed(best, texts, setting))
            spent = [pairs, best]
        else:  # all pairs of different components in a bucket
            rest = scratch.keep(members.join(open_keys.select("key"), "key").select("key", "node", "comp"))
            links = scratch.keep(crowd_links(rest, features, texts, scratch, setting))
            spent = [rest]
        if not links.isEmpty():
            comp = lambda end: labels.select(F.col("node").alias(end), F.col("comp").alias(f"comp_{end}"))
            joined = links.join(comp("a"), "a").join(comp("b"), "b").select(F.col("comp_a").alias("a"), F.col("comp_b").alias("b"))
            merged = components(joined, scratch).select(F.col("node").alias("comp"), F.col("comp").alias("into"))
            before, labels = labels, scratch.keep(labels.join(merged, "comp", "left").select("node", F.coalesce("into", "comp").alias("comp")))
            spent.append(before)
        scratch.drop(links, *spent)
    scratch.drop(buckets, features, texts, nodes)

    placed = reps.join(labels, "node", "left").select(*same, F.coalesce("comp", "node").alias("component"))
    ids = feats.select("doc_id", *same)
    repeated = ids.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(F.count("*").alias("rows")).filter("rows > 1").select("doc_id")
    repeated = scratch.keep(repeated)
    out = ids.join(placed, same, "left")
    if not repeated.isEmpty():  # all sets of one id are one component, which is that of its rows without words, too
        placed = scratch.keep(placed)
        holders = scratch.keep(ids.join(repeated, "doc_id").distinct().join(placed, same).select("doc_id", "component"))
        hubs = holders.groupBy("doc_id").agg(F.min("component").alias("a"))
        into = components(hubs.join(holders, "doc_id").select("a", F.col("component").alias("b")), scratch).select(F.col("node").alias("component"), F.col("comp").alias("into"))
        moved = lambda rows: rows.join(into, "component", "left").withColumn("component", F.coalesce("into", "component")).drop("into")
        of_id = moved(holders).groupBy("doc_id").agg(F.min("component").alias("of_id"))
        out = ids.join(moved(placed), same, "left").join(of_id, "doc_id", "left").withColumn("component", F.coalesce("component", "of_id"))
    component = F.coalesce("component", "doc_id")
    return out.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), component).alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def one_of_each(docs: DataFrame, scratch: Scratch, setting: Setting = QUERY) -> DataFrame:
    """The rows of ``docs``, unchanged, that no earlier document stands for.

    Of rows that repeat both id and text one stays; rows without an id stay.
    """
    kept = duplicates(docs, scratch, setting).filter("kept AND doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("__kept_id")).agg(F.count("*").alias("__kept_rows"))
    rows = docs.join(kept, F.col("doc_id") == F.col("__kept_id"))
    once = rows.filter("__kept_rows = 1").drop("__kept_id", "__kept_rows")
    # Rows of an id that repeats: a text is told by 128 bits; grouping keeps one of each before anything is sent.
    texts = rows.filter("__kept_rows > 1").withColumn("__kept_text", F.md5(F.coalesce(F.concat(F.lit("t"), "text"), F.lit("")).cast("binary")))
    several = texts.dropDuplicates(["doc_id", "__kept_text"]).drop("__kept_id", "__kept_rows", "__kept_text")
    return once.union(several).union(docs.filter("doc_id IS NULL"))
