"""Vector codes, near vectors and collocations against brute force."""

import collections
import hashlib
import math
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
from pyspark.sql import functions as F

from salescope.llm import codes, phrases, tiles, words
from salescope.llm.scratch import Scratch
from salescope.llm.sql import SQL

from . import plain

VECTORS = "vec_id long, embedding array<float>, label int, node long, code string, n long, component string, h long, v string"


def vector_rows(dim=32, n=180):
    rng = np.random.default_rng(5)
    v = rng.standard_normal((n, dim)).astype(np.float32)
    v[20:60] = v[20] + 0.03 * rng.standard_normal((40, dim))  # a crowd of near copies
    v[60:75] = v[3]  # copies
    v[75] = 2 * v[4]
    for i in range(80, 100):  # a chain: each is near to the next one only
        v[i] = 0
        v[i, 0], v[i, 1] = math.cos(0.35 * (i - 80)), math.sin(0.35 * (i - 80))
    rows = [(i, [float(x) for x in v[i]], i % 7 if i >= 100 else 1) for i in range(n)]
    odd = [None, [], [1.0] * (dim - 1), [None] * dim, [float("nan")] * dim, [float("inf")] + [1.0] * (dim - 1), [0.0] * dim, [3e38] * dim]
    rows += [(300 + i, x, 1) for i, x in enumerate(odd)]
    rows += [(400, rows[21][1], None), (401, rows[21][1], None), (None, rows[21][1], 1), (None, None, None), (310, rows[3][1], 1), (310, rows[85][1], 1), (303, rows[110][1], 5), (-3, rows[4][1], 1), (-5, rows[4][1], 2)]
    return [(i, e, l, 7, "x", 8, "y", 9, "z") for i, e, l in rows]


@pytest.fixture(scope="module")
def odd_rows():
    return vector_rows()


@pytest.fixture(scope="module")
def vectors(spark, odd_rows):
    return spark.createDataFrame(odd_rows, VECTORS).repartition(5)


def plain_codes(rows, parts, entries, rounds):
    kept = [(i, [math.floor(256 * x) for x in e], l) for i, e, l, *_ in rows if e is not None and len(e) == 32 and all(x is not None and math.isfinite(x) and abs(x) < 1e6 for x in e)]
    width = 32 // parts
    part = lambda v, p: v[p * width : (p + 1) * width]
    firsts = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:entries]
    books = [[part(v, p) for _, v, _ in firsts] for p in range(parts)]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    nearest = lambda v, p: min((far(part(v, p), c), e) for e, c in enumerate(books[p]))
    for _ in range(rounds):
        own = collections.defaultdict(list)
        for _, v, _ in kept:
            for p in range(parts):
                own[p, nearest(v, p)[1]].append(part(v, p))
        for (p, e), members in own.items():
            books[p][e] = [sum(x) // len(members) for x in zip(*members)]
    out, total = [], collections.Counter()
    for i, v, l in kept:
        near = [nearest(v, p) for p in range(parts)]
        out.append((i, "".join(f"{e:02x}" for _, e in near), sum(d for d, _ in near), l))
        total[l] += out[-1][2]
    digest = hashlib.sha256(",".join(str(x) for book in books for c in book for x in c).encode()).hexdigest()
    return sorted(((i, c, e, total[l], digest) for i, c, e, l in out), key=repr)


@pytest.mark.parametrize("parts,entries", [(16, 64), (4, 256), (16, 3)])
def test_codes(spark, vectors, odd_rows, parts, entries):
    got = codes.compress(vectors, Scratch(spark, "t"), parts=parts, entries=entries, block=16).drop("label")
    assert sorted((tuple(r) for r in got.collect()), key=repr) == plain_codes(odd_rows, parts, entries, 2)


def test_codes_of_no_and_of_padded_vectors(spark, vectors):
    none = spark.createDataFrame([], VECTORS)
    assert codes.compress(none, Scratch(spark, "t")).count() == 0
    three = spark.createDataFrame([(1, [1.0, 2.0, 3.0], "a"), (2, [1.0, 2.0, 4.0], None)], "vec_id long, embedding array<double>, label string")
    got = {r.vec_id: r for r in codes.compress(three, Scratch(spark, "t")).collect()}
    assert {i: (r.error, r.label_error) for i, r in got.items()} == {1: (0, 0), 2: (0, 0)}
    assert got[1].code == "00" * 16 and got[2].code == "0000" + "01" + "00" * 13


def test_distances_by_dictionaries_are_exact():
    rng = np.random.default_rng(1)
    for reach in (200, 1 << 27):
        x = rng.integers(-reach, reach, (500, 12))
        books = rng.integers(-reach, reach, (3, 20, 4))
        best, error = codes.nearest_entries(*codes.dictionaries(x), books)
        for p in range(3):
            d = ((x[:, None, 4 * p : 4 * p + 4] - books[None, p]) ** 2).sum(axis=2)
            assert (d.argmin(axis=1) == best[:, p]).all() and (d.min(axis=1) == error[:, p]).all()
    assert 64 * (2 * codes.bound(64)) ** 2 < 2**63 <= 64 * (2 * codes.bound(64) + 2) ** 2


def plain_links(rows, threshold=0.93):
    fine = lambda e: e is not None and len(e) == 32 and all(x is not None and math.isfinite(x) for x in e) and any(e)
    own = [k for k, (i, e, l, *_) in enumerate(rows) if i is not None and l is not None and fine(e)]
    unit = {k: np.array(rows[k][1]) / np.abs(rows[k][1]).max() for k in own}
    unit = {k: x / np.sqrt((x * x).sum()) for k, x in unit.items()}
    links, up = collections.Counter(), {r[0]: r[0] for r in rows}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a in own:
        for b in own:
            if a != b and rows[a][2] == rows[b][2] and float(unit[a] @ unit[b]) >= threshold:
                links[a] += 1
                x, y = root(rows[a][0]), root(rows[b][0])
                up[max(x, y)] = min(x, y)
    return sorted(((r[0], links[k], None if r[0] is None else root(r[0]), r[0] is None or root(r[0]) == r[0]) for k, r in enumerate(rows)), key=repr)


@pytest.mark.parametrize("tile", [8192, 7, 40])
def test_near_vectors(spark, vectors, odd_rows, tile):
    got = tiles.near_vectors(vectors, Scratch(spark, "t"), tile=tile)
    assert got.columns == ["vec_id", "n_links", "component_id", "kept"]
    got = sorted((tuple(r) for r in got.collect()), key=repr)
    want = plain_links(odd_rows)
    assert got == want and sum(w[1] for w in want) > 1500


def test_near_vectors_of_none(spark):
    assert tiles.near_vectors(spark.createDataFrame([], VECTORS), Scratch(spark, "t")).count() == 0


def test_products_lie_within_their_bounds():
    rng = np.random.default_rng(2)
    for dim in (3, 64, 3000):
        v = rng.standard_normal((60, dim)) * np.exp(3 * rng.standard_normal((60, dim))) * 10.0 ** rng.integers(-200, 200, (60, 1))
        q, s, length, error = tiles.quantised(v)
        near = tiles.products(q, q)
        assert (near == q.astype(np.int64) @ q.astype(np.int64).T).all()
        u = v / np.abs(v).max(axis=1, keepdims=True)
        u /= np.sqrt((u * u).sum(axis=1, keepdims=True))
        off = length[:, None] * error[None, :] + error[:, None] + 1e-12
        assert (np.abs(u @ u.T - near * s[:, None] * s[None, :]) <= off).all()


def test_only_pairs_near_the_threshold_are_recomputed():
    rng = np.random.default_rng(3)
    v = np.concatenate([rng.standard_normal((300, 64)), rng.standard_normal(64) + 0.01 * rng.standard_normal((300, 64))])
    links = tiles.Links(v, np.ones(600, np.int64), 0.93, 100)
    links.between(range(0, 600), range(0, 600))
    assert (links.count[300:] == 299).all() and not links.count[:300].any() and links.recomputed == 0


def test_groups_of_tiles_send_at_most_a_row_for_each_vector(spark, vectors):
    rows, dim = tiles.usable(vectors, F.col("embedding"), F.col("label"))
    nodes = rows.select(F.monotonically_increasing_id().alias("node"), "label", F.lit(1).cast("long").alias("n"), "v")
    found = tiles.link_counts(nodes, dim, 0.5, tile=20).groupBy("node").count().collect()
    size = nodes.filter("label = 1").count()
    assert found and max(r["count"] for r in found) <= -(-size // 20)


def plain_phrases(rows, least, percent, top):
    f, n = collections.defaultdict(collections.Counter), collections.Counter()
    for _, text, lang, *_ in rows:
        for piece in re.split("[.,;:!?\x0a-\x0d]", plain.lower(text)):
            w = re.findall("[^\x20\x09]+", piece)
            n[lang or "und"] += len(w)
            for k in range(1, 5):
                for i in range(len(w) - k + 1):
                    f[lang or "und"][tuple(w[i : i + k])] += 1
    out = []
    for lang, own in f.items():
        found = {p: a for p, a in own.items() if len(p) > 1 and a >= least}
        drop = {q for p, a in found.items() for k in range(2, len(p)) for i in range(len(p) - k + 1) if 100 * a >= percent * own[q := p[i : i + k]]}
        best = []
        for p, a in found.items():
            if p not in drop:
                score, _, l, r = min((2_000_000 * a // (own[p[:k]] + own[p[k:]]), k, own[p[:k]], own[p[k:]]) for k in range(1, len(p)))
                best.append((-score, -a, " ".join(p).encode(), l, r))
        out += [(lang, i + 1, p.decode(), -a, l, r, n[lang], -s) for i, (s, a, p, l, r) in enumerate(sorted(best)[:top])]
    return sorted(out)


@pytest.fixture(scope="module")
def rows(spark, small):
    more = [(9100 + i, f"New York City, in New York: a b c d e. {'x ' * (i % 4)}the end; of the end\x0bNEW york", "en", "s") for i in range(12)]
    more += [(9200, "a\tb c\x0ca b c, a b; a é b é \U0001f600 " * 40, None, "s"), (9201, "1,000.5 a,b", "und", "s")]
    return plain.awkward(spark.read.parquet(f"{small}/documents.parquet"), small) + [(*r, None, "a", "b", "c", "d") for r in more]


@pytest.mark.parametrize("least,percent,top,size", [(30, 80, 2000, 1 << 20), (3, 60, 50, 400)])
def test_collocations(spark, rows, least, percent, top, size):
    docs = spark.createDataFrame(rows, plain.SCHEMA).repartition(5)
    got = phrases.collocations(docs, Scratch(spark, "t"), least, top, percent, size)
    assert sorted(tuple(r) for r in got.collect()) == plain_phrases(rows, least, percent, top)


def test_tasks_send_nodes_and_take_several_parts_of_the_blocks(spark, rows):
    scratch = Scratch(spark, "t")
    blocks, _ = phrases.encoded(spark.createDataFrame(rows, plain.SCHEMA).repartition(40), scratch)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1k")
    spark.conf.set("spark.sql.files.openCostInBytes", "64")
    before = spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")
    try:
        parts = blocks.rdd.getNumPartitions()
        with phrases._scanned(blocks) as scan:
            assert spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") == phrases.BATCH
            assert parts > 48 and scan.rdd.getNumPartitions() == -(-parts // phrases.JOINED)
            assert scan.count() == blocks.count()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") == before
    trie = phrases.Trie.build(pa.table({"lang": ["en"], "k": pa.array([2], pa.int32()), "h1": [5], "h2": [7], "h3": [0], "h4": [0]}))
    one = pa.RecordBatch.from_pydict({"lang": ["en"], "hashes": [[5, 7]], "tokens": pa.array([np.array([1, 2, 1, 2, 0, 2], np.int32).tobytes()], pa.binary())})
    sent = list(phrases._advance(trie.dump, iter([one, one])))
    assert [b.schema.names for b in sent] == [["node", "n"]] and sent[0].column("n").to_pylist() == [4]
    assert [tuple(r.values()) for b in phrases._phrases_of(trie.dump, iter(sent)) for r in b.to_pylist()] == [("en", 2, 5, 7, 0, 0, 4)]


def test_runs_are_summed_in_the_task(monkeypatch):
    block = pa.RecordBatch.from_pydict({"lang": ["en"], "hashes": [[5, 7]], "tokens": pa.array([np.array([1, 2, 1, 0, 1, 2], np.int32).tobytes()], pa.binary())})
    every = np.full(phrases.FILTER // 8, 255, np.uint8)
    want = {(2, 5, 7, 0, 0): 2, (2, 7, 5, 0, 0): 1, (3, 5, 7, 5, 0): 1}
    for held, batches in ((phrases.HELD_RUNS, 1), (2, 3)):
        monkeypatch.setattr(phrases, "HELD_RUNS", held)
        sent = [b.to_pylist() for b in phrases._longer(lambda: every, lambda: every, iter([block] * 4))]
        total = collections.Counter()
        for row in [r for b in sent for r in b]:
            lang, *phrase, n = row.values()
            total[tuple(phrase)] += n
        assert len(sent) <= batches and total == {p: 4 * n for p, n in want.items()}


def test_rare_runs_of_frequent_pairs_are_not_sent_with_their_words(spark, monkeypatch):
    """Every pair occurs twice and every run of three once."""
    rows = [(20 * step + a, " ".join(f"w{(a + i * step) % 20}" for i in range(3)), "en") for step in range(1, 20) for a in range(20)]
    scratch, sent, sums = Scratch(spark, "t"), [], phrases._sums

    def counting(found, *keys):
        if "k" in keys:
            sent.append(found.groupBy("k").count().orderBy("k").collect())
        return sums(found, *keys)

    monkeypatch.setattr(phrases, "_sums", counting)
    blocks, known = phrases.encoded(spark.createDataFrame(rows, "doc_id long, text string, lang string").coalesce(1), scratch)
    found = phrases.candidates(blocks, known, scratch, 2)
    assert [tuple(r) for r in found.groupBy("k").count().collect()] == [(2, 380)]
    assert [[tuple(r) for r in own] for own in sent] == [[(2, 380)]]


def test_buckets_are_sent_in_few_bytes():
    rng = np.random.default_rng(5)
    keys = np.unique(np.concatenate([rng.integers(0, 1 << 32, 200_000), [0, (1 << 32) - 1]])).astype(np.uint32)
    n = rng.geometric(0.7, len(keys))
    n[[0, -1]] = 1 << 40
    for ranges in (1, 7):
        tables = [pa.Table.from_batches(phrases._packed(keys[i:], n[i:], ranges)) for i in (0, 100_000)]
        assert len(tables[0]) == ranges and tables[0].nbytes < 4 * len(keys)
        both = pa.concat_tables(tables)
        got = [phrases._frequent(4, both.filter(pc.equal(both.column("range"), r))).column("key").to_numpy().view(np.uint32) for r in range(ranges)]
        want = n + np.where(np.arange(len(n)) < 100_000, 0, n)
        assert np.array_equal(np.concatenate(got), keys[want >= 4])
    assert not list(phrases._packed(keys[:0], n[:0], 7))


def test_collocations_of_none(spark):
    assert phrases.collocations(spark.createDataFrame([], plain.SCHEMA), Scratch(spark, "t")).count() == 0


def test_small_blocks_and_words_with_equal_hashes(spark):
    """With the first hashes all words of some blocks are one; the next ones tell all apart."""

    def poor(data, firsts):
        hashes, begin = words.hash_words(data, firsts)
        return (np.full_like(hashes, 5) if b"aa" in data.tobytes() and b"bb" in data.tobytes() else hashes), begin

    docs = spark.createDataFrame([(i, ["aa bb; cc AA bb ", "bb aa"][i % 2], "en") for i in range(40)], "doc_id long, text string, lang string")
    for size in (60, 1):
        plainly, again = (phrases.encoded(docs, Scratch(spark, "t"), size, hasher) for hasher in (words.hash_words, poor))
        assert plainly[0].count() == again[0].count() > 7
        hashes = [{r.h1: r.n for r in found[1].collect()} for found in (plainly, again)]
        assert all(sorted(h.values()) == [20, 60, 60] for h in hashes) and hashes[0] != hashes[1]


def test_double_array():
    rng = np.random.default_rng(4)
    words = rng.integers(-(1 << 62), 1 << 62, 300)
    own = {(int(l), *w[:k].tolist()) for l, k, w in zip(rng.integers(0, 2, 4000), rng.integers(1, 5, 4000), words[np.minimum(rng.geometric(0.02, (4000, 4)), 299)])}
    table = sorted(own, key=lambda p: (len(p), p))
    columns = [[p[i + 1] if i + 1 < len(p) else 0 for p in table] for i in range(4)]
    trie = phrases.Trie.build(pa.table({"lang": ["ab"[p[0]] for p in table], "k": pa.array([len(p) - 1 for p in table], pa.int32()), **dict(zip(phrases.PLACES, columns))}))
    trie = phrases.Trie.load(trie.dump())
    text = words[np.minimum(rng.geometric(0.02, 20_000), 299)]
    hashes = np.unique(text.view(np.uint64))
    tokens = (np.searchsorted(hashes, text.view(np.uint64)) + 1).astype(np.int32)
    tokens[rng.integers(0, len(tokens), 500)] = 0
    counts = np.zeros(len(trie.base), np.int64)
    trie.count("b", hashes, tokens, counts)
    trie.count("c", hashes, tokens, counts)
    got = {tuple(r.values()) for b in trie.found(counts) for r in b.to_pylist()}
    want = collections.Counter()
    for i in range(len(tokens)):
        for k in range(1, 5):
            part = tokens[i : i + k]
            if len(part) == k and part.all() and (p := (1, *hashes[part - 1].view(np.int64).tolist())) in own:
                want[p] += 1
    assert got == {("b", len(p) - 1, *p[1:], *[0] * (5 - len(p)), n) for p, n in want.items()}


@pytest.mark.parametrize("name", ["op11_vector_codes", "op12_near_vectors", "op13_collocations"])
def test_queries(spark, small, name):
    from compare import compare, duck
    from types import SimpleNamespace

    from salescope.llm.queries import QUERIES

    assert compare(SimpleNamespace(run=QUERIES[name], sql=SQL[name]), spark, small, duck(small)) is None
