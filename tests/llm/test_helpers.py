"""Word hashing, components, the recurrent network, trees and chat examples against brute force."""

import collections
import hashlib
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from salescope.llm import chat, components, gru, neardup, vptree, words
from salescope.llm.scratch import Scratch

from . import plain


@pytest.mark.parametrize("block,size", [(1 << 20, 1 << 22), (16, 50)])
def test_words_of_blocks(block, size, monkeypatch):
    monkeypatch.setattr(words, "BLOCK", block)
    texts = ["a b", "a", " ", None, "", "b A\x0bab é\xa0é", "x" * 300, "ba", "x" * 300 + " y", "AB"]
    for lower in (False, True):
        seen, got = {}, []
        for lo, hi, h, begin in words.word_blocks(pa.array(texts), lower=lower, size=size):
            got += [h[begin[i] : begin[i + 1]].tolist() for i in range(hi - lo)]
        want = [[plain.lower(w) if lower else w for w in plain.words(t)] for t in texts]
        assert [len(g) for g in got] == [len(w) for w in want]
        for g, w in zip(got, want):
            for h, x in zip(g, w):
                assert seen.setdefault(x, h) == h
        assert len(set(seen.values())) == len(seen)


def test_components(spark):
    rng = np.random.default_rng(3)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 4000, (2500, 2))] + [(5000 + i, 5001 + i) for i in range(200)] + [(9000, 6000 + i) for i in range(500)] + [(1, 1)]
    up = {x: x for e in edges for x in e}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in edges:
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    got = {r.node: r.comp for r in components.components(spark.createDataFrame(edges, "a long, b long"), Scratch(spark, "t")).collect()}
    joined = {x for a, b in edges if a != b for x in (a, b)}
    assert got == {x: root(x) for x in joined}
    assert components.components(spark.createDataFrame([], "a long, b long"), Scratch(spark, "t")).count() == 0


def test_fewest_matches_follow_the_posterior():
    """The bound by numerical integration of the likelihood over similarities, under a uniform prior."""
    setting = neardup.QUERY
    x = np.linspace(0, 1, 200_001)
    for n, m in neardup.least_matches(setting).items():
        posterior = []
        for k in (m - 1, m):
            y = k * np.log((1 + 3 * x) / 4) + (n - k) * np.log(np.maximum(3 - 3 * x, 1e-300) / 4)  # two bits of a minimum match
            y = np.exp(y - y.max())
            posterior.append(y[x >= setting.threshold / 100].sum() / y.sum())
        assert posterior[0] < neardup.MISS * 1.05 and posterior[1] > neardup.MISS * 0.95


def test_gradients(monkeypatch):
    monkeypatch.setattr(gru, "WINDOW", 100)
    rng = np.random.default_rng(0)
    p = gru.start(np.array([50] + [10] * 100))
    p = {k: v.astype(np.float64) + rng.standard_normal(v.shape) * 0.1 * (v > -20) for k, v in p.items()}
    tokens, begin = rng.integers(0, 101, 60), np.array([0, 7, 25, 25, 40, 60])
    layout, caught = gru.Layout(tokens, begin, 3, 1), {}
    trainer = gru.Trainer(p)
    trainer.p = {k: v.copy() for k, v in p.items()}
    trainer.grad = {k: np.zeros_like(v) for k, v in p.items()}
    monkeypatch.setattr(gru, "STEP", 1)
    trainer._step = lambda: caught.update({k: v.copy() for k, v in trainer.grad.items()})
    trainer.run(layout)
    for k, v in p.items():
        at = (int(tokens[3]), 2) if k == "emb" else tuple(int(rng.integers(0, s)) for s in v.shape)
        diff = []
        for e in (1e-4, -1e-4):
            q = {a: b.copy() for a, b in p.items()}
            q[k][at] += e
            diff.append(-gru.score(q, layout, 5).sum())
        assert caught[k][at] == pytest.approx((diff[0] - diff[1]) / 2e-4, rel=0.02, abs=1e-3)


def test_scores_do_not_depend_on_lanes_and_add_up():
    rng = np.random.default_rng(1)
    p = gru.start(np.array([5, 3, 9, 1]))
    p = {k: v + (rng.standard_normal(v.shape) * 0.3).astype(np.float32) * (v > -20) for k, v in p.items()}
    tokens, begin = rng.integers(0, 4, 500), np.array([0, 3, 3, 200, 230, 500])
    a, b = (gru.score(p, gru.Layout(tokens, begin, width, 1), 5) for width in (1, 8))
    assert np.allclose(a, b, rtol=1e-4) and a[1] == 0
    # All texts of one, and of two tokens over the four known ones, have the probabilities of a distribution.
    singles = [gru.score(p, gru.Layout(np.array([t]), np.array([0, 1]), 1, 1), 1)[0] for t in range(4)]
    assert np.exp(singles).sum() == pytest.approx(1, abs=1e-4)
    pairs = [gru.score(p, gru.Layout(np.array([s, t]), np.array([0, 2]), 1, 1), 1)[0] for s in range(4) for t in range(4)]
    assert np.exp(pairs).sum() == pytest.approx(1, abs=1e-4)


def test_training_learns_a_cycle():
    tokens = np.tile(np.arange(1, 9), 400)
    layout = gru.Layout(tokens, np.arange(0, len(tokens) + 1, 40), 16, 1)
    trainer = gru.Trainer(gru.start(np.array([1] + [400] * 8)), 0.02)
    before = gru.score(trainer.p, layout, 80).sum()
    for _ in range(8):
        trainer.run(layout)
    assert gru.score(trainer.p, layout, 80).sum() > 0.5 * before
    assert gru.from_values(np.frombuffer(gru.to_bytes(trainer.p), np.float32), trainer.p).keys() == trainer.p.keys()


def distance(q, v):
    total = 0.0
    for a, b in zip(q, v):  # plain sums, in order
        total += (a - b) * (a - b)
    return float(np.sqrt(total))


def nearest(vectors, k, step):
    out = {}
    for i, q in vectors:
        if i % step == 0:
            far = [(distance(q, v), j) for j, v in vectors if j != i]
            out[i] = sorted(far)[:k]
    return out


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(2)
    centres = rng.standard_normal((12, 8))
    v = [(i, [float(x) for x in centres[i % 12] + 0.3 * rng.standard_normal(8)]) for i in range(900)]
    return v + [(900 + i, v[17][1]) for i in range(300)]  # a vector that is very common


def test_trees_are_exact_with_factor_one(spark, vectors, monkeypatch):
    monkeypatch.setattr(vptree, "SHARD", 250)
    monkeypatch.setattr(vptree, "QUERIES", 20)
    monkeypatch.setattr(vptree, "LEAF", 10)
    odd = [(2000, None), (2100, [0.0] * 8), (2200, [1.0] * 7 + [float("nan")]), (2300, [1.0] * 7 + [float("inf")]), (2400, [1.0] * 7 + [None]), (2500, [1.0] * 3), (None, [1.0] * 8)]
    rows = [(i, v, "x", 1) for i, v in vectors + odd]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, rank string, score int")
    got = collections.defaultdict(list)
    for r in vptree.nearest(df, query_step=20).orderBy("query_id", "rank").collect():
        assert r.rank == len(got[r.query_id]) + 1
        got[r.query_id].append((r.score, r.vec_id))
    assert got == nearest(vectors, 10, 20)
    few = vptree.nearest(df.filter("vec_id < 4"), query_step=2).collect()
    assert sorted((r.query_id, r["rank"]) for r in few) == [(q, k) for q in (0, 2) for k in (1, 2, 3)]
    assert vptree.nearest(df.limit(0)).count() == 0 and vptree.nearest(df.filter("vec_id = 0")).count() == 0


def test_relaxed_trees_find_most(spark, vectors, monkeypatch):
    monkeypatch.setattr(vptree, "LEAF", 10)
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<double>")
    want = nearest(vectors, 10, 20)
    got = collections.defaultdict(list)
    for r in vptree.nearest(df, query_step=20, factor=2.0).collect():
        got[r.query_id].append(r.score)
    # By distance, as ties are many: how many are no farther than the true tenth.
    hits = sum(sum(s <= want[q][-1][0] + 1e-12 for s in scores) for q, scores in got.items())
    assert hits >= 0.9 * 10 * len(want)


def test_repeated_vector_ids(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (0, [0.0, 1.0]), (1, [1.0, 1.0]), (1, [1.0, 1.0])], "vec_id long, embedding array<float>")
    assert sorted((r.query_id, r["rank"], r.vec_id) for r in vptree.nearest(df).collect()) == [(0, k, 1) for k in (1, 2, 3, 4)]


CONTROL = "\\### Assistant: </turn> ok"


def test_chat_examples_read_back(spark):
    rows = [
        (1, 0, "system", "be kind"), (1, 2, "assistant", "a|b \\p \\\\ <|end|>"), (1, 1, "user", "<|turn|>user<|text|>x<|end|>"), (1, 3, "user", None), (1, 4, "assistant", ""),
        (2, 0, "user", CONTROL), (2, 1, "assistant", CONTROL), (3, 0, "user", "no reply"), (4, 0, "assistant", "first\n\n"), (4, 1, "user", "last"),
        (5, 1, "assistant", "b"), (5, 1, "assistant", "a"), (5, None, None, "x"), (5, 1, "assistant", "a"), (None, 0, "assistant", "é\U0001f600"), (6, 0, "|\\assistant", "||\\\\|" * 3000),
    ]
    df = spark.createDataFrame([(*r, "t", "u") for r in rows], "conv_id long, turn long, role string, text string, example string, target string").repartition(4)
    examples = chat.examples(df)
    for e in examples.collect():
        assert e.trainable or e.conv_id in (3, 4, 6)
        whole = e.context + e.target + e.tail
        assert whole.count("<|turn|>") == whole.count("<|end|>") == whole.count("<|text|>")
    got = {r.conv_id: r for r in chat.read_back(examples).collect()}
    by = collections.defaultdict(list)
    for c, turn, role, text in rows:
        by[c].append((turn is not None, turn or 0, role or "", text or ""))
    assert set(got) == set(by)
    for c, turns in by.items():
        turns.sort()
        loss = "".join(t[3] for t in turns if t[2] == "assistant")
        r = got[c]
        assert r.n_turns == len(turns)
        assert r.turns_sha256 == hashlib.sha256("".join(f"{t[2]}\n{t[3]}\n" for t in turns).encode()).hexdigest()
        assert (r.loss_chars, r.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    sizes = collections.Counter()
    for e in examples.collect():
        sizes[e.conv_id] += len(e.context + e.target + e.tail)
    assert {c: r.formatted_chars for c, r in got.items()} == sizes
    assert chat.read_back(chat.examples(df.limit(0))).count() == 0


def test_each_reply_is_trained_once_after_its_context(spark):
    df = spark.createDataFrame([(1, i, "assistant" if i % 2 else "user", f"t{i}") for i in range(6)], "conv_id long, turn long, role string, text string")
    got = sorted((e.example, e.context, e.target, e.trainable) for e in chat.examples(df).collect())
    assert [g[2] for g in got] == ["t1", "t3", "t5"] and all(g[3] for g in got)
    for _, context, target, _ in got:
        assert re.findall(r"t\d", context) == [f"t{i}" for i in range(int(target[1]))]


@pytest.mark.parametrize("name", ["op2_near_duplicates", "op3_repeated_passages", "op4_quality_rules", "op7_nearest_neighbours", "op9_chat_examples"])
def test_queries_against_sql(spark, small, name):
    from compare import duck, rows_of

    import __spark_entry__ as entry

    df = entry.queries()[name](spark, small)
    cursor = duck(small).execute(entry.oracle_sql()[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == sorted(df.columns)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(names, cursor.fetchall())


def test_pipeline(spark, small):
    import corpus_pipeline

    docs = spark.read.parquet(f"{small}/documents.parquet")
    got = corpus_pipeline.run(spark, small)
    pieces = got.select("doc_id", "piece", "length").collect()
    ids = {r.doc_id for r in docs.collect()}
    assert {r.doc_id for r in pieces} <= ids and len({r.doc_id for r in pieces}) > 0.5 * len(ids)
    assert len(pieces) == len({(r.doc_id, r.piece) for r in pieces})
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language_id", "near_duplicates", "secrets", "mixing", "packing"]
    labels = {r.doc_id for r in spark.read.parquet(f"{small}/labels.parquet").filter("quality = 1 AND toxic = 0").collect()}
    first = corpus_pipeline.language_id(spark, docs, small)
    assert labels <= {r.doc_id for r in first.collect()}
    mixed = corpus_pipeline.mix_to_weights(spark, docs, small)
    assert mixed.columns == docs.columns
    assert len(labels & {r.doc_id for r in mixed.collect()}) >= 0.97 * len(labels)
    assert docs.filter(F.col("doc_id").isNull()).count() == 0
