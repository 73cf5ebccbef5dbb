"""Operators on documents against brute force, on a table with nulls, empties, long texts, ties and repeated rows."""

import collections
import hashlib
import math
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from salescope.llm import langid, lm, mixing, neardup, packing, quality, secret_scan, substrings
from salescope.llm.queries import DOMAIN, WEIGHTS, fold, op6_soft_mixing, tokenizer_files
from salescope.llm.scratch import Scratch

from . import plain


@pytest.fixture(scope="module")
def rows(spark, small):
    return plain.awkward(spark.read.parquet(f"{small}/documents.parquet"), small)


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, plain.SCHEMA).repartition(5)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], plain.SCHEMA)


def sorted_rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def grams_of(text):
    padded = re.sub(r"[^\W\d_]+|.", lambda m: m[0] if m[0][0].isalpha() else "\0", (text or "").lower(), flags=re.S)
    padded = re.sub("\0+", "\0", "\0" + padded + "\0")
    out = collections.Counter()
    for n in (1, 2, 3):
        for i in range(len(padded) - n + 1):
            g = padded[i : i + n]
            if g != "\0" and not (n == 3 and g[1] == "\0"):
                out[g] += 1
    return out


def top(counts, size):
    return sorted(counts, key=lambda g: (-counts[g], len(g), g))[:size]


def test_languages(docs, rows, none):
    learned = collections.defaultdict(collections.Counter)
    for doc_id, text, lang, *_ in rows:
        if lang and plain.crc_fold(doc_id, 5) not in (0, None):
            learned[lang] += grams_of(text)
    profiles = {k: top(v, 300) for k, v in learned.items() if v}
    got = langid.predict(docs, langid.learn(docs.filter(fold(5) != 0)), {"doc_id": F.col("doc_id"), "t": F.col("text")}).collect()
    assert len(got) == len(rows)
    for r in got:
        own = top(grams_of(r.t), 300)
        if not any(c.isalpha() for c in r.t or ""):
            assert (r.lang_pred, r.score) == ("und", 0.0)
            continue
        far = {}
        for lang, p in profiles.items():
            place = {g: i for i, g in enumerate(p)}
            far[lang] = sum(abs(i - place[g]) if g in place else 300 for i, g in enumerate(own))
        best = min(sorted(far), key=far.get)
        assert r.lang_pred == best and r.score == pytest.approx(1 - far[best] / (300 * len(own)))
    assert langid.predict(none, langid.learn(none), {"doc_id": F.col("doc_id")}).count() == 0
    assert {r.lang_pred for r in langid.predict(docs, {}, {"doc_id": F.col("doc_id")}).collect()} == {"und"}
    left = langid.accepted(docs, langid.learn(docs), 0.1)
    assert left.columns == docs.columns and 9011 not in {r.doc_id for r in left.collect()}


def test_held_out_languages(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    got = langid.predict(docs, langid.learn(docs.filter(fold(5) != 0)), {"held": fold(5) == 0, "lang": F.col("lang")}).filter("held AND lang IS NOT NULL").collect()
    assert len(got) > 20 and sum(r.lang == r.lang_pred for r in got) >= 0.97 * len(got)


@pytest.mark.parametrize("setting", [neardup.QUERY, neardup.STAGE])
def test_near_duplicates(spark, docs, rows, none, setting):
    sets = collections.defaultdict(set)
    for doc_id, text, *_ in rows:
        if doc_id is not None:
            sets[doc_id] |= plain.shingle_set(text, setting.width)
    want = plain.classes(sets, setting.threshold)
    got = neardup.duplicates(docs, Scratch(spark, "t"), setting).collect()
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert (r.n_shingles, r.component_id, r.kept) == (len(sets[r.doc_id]), want[r.doc_id], want[r.doc_id] == r.doc_id)
    assert neardup.duplicates(none, Scratch(spark, "t"), setting).count() == 0
    left = neardup.one_of_each(docs, Scratch(spark, "t"), setting)
    assert left.columns == docs.columns
    ids = [r.doc_id for r in left.collect()]
    assert sorted(i for i in ids if i is not None) == sorted(i for i in sets if want[i] == i) and ids.count(None) == 2


def test_rows_of_one_id_are_one_component(spark):
    """Id 5 holds a copy of 3 and a text near 9, and a row without words; 9 and 5 go to 3, and only 3 stays."""
    one, two = ([f"{k}{i}" for i in range(60)] for k in "ab")
    near = two[:59] + ["x"]
    docs = spark.createDataFrame([(3, " ".join(one)), (5, " ".join(one)), (5, " ".join(two)), (5, " "), (9, " ".join(near)), (10, "alone it is")], "doc_id long, text string")
    got = sorted((r.doc_id, r.component_id, r.kept) for r in neardup.duplicates(docs, Scratch(spark, "t")).collect())
    assert got == [(3, 3, True), (5, 3, False), (5, 3, False), (5, 3, False), (9, 3, False), (10, 10, True)]
    assert sorted(r.doc_id for r in neardup.one_of_each(docs, Scratch(spark, "t")).collect()) == [3, 10]


def test_common_shingles_of_all_pairs(monkeypatch):
    monkeypatch.setattr(neardup, "COLUMNS", 7)
    rng = np.random.default_rng(8)
    left, right = ([np.unique(rng.integers(0, 90, int(k)).astype(np.uint64)) for k in rng.integers(1, 60, n)] for n in (9, 5))
    assert neardup.common(left, right).tolist() == [[len(set(a.tolist()) & set(b.tolist())) for b in right] for a in left]


@pytest.mark.parametrize("tile", [None, 50])
def test_near_copies_in_a_large_group(spark, tile, monkeypatch):
    """A chain of edits and a crowd around one text: pairs of the crowd are under the threshold, links go by way of others."""
    if tile:
        monkeypatch.setattr(neardup, "SIGNATURES", tile)
        monkeypatch.setattr(neardup, "TEXTS", tile)
    rng = np.random.default_rng(5)
    vocabulary = [f"w{i}" for i in range(4000)]
    text = list(rng.choice(vocabulary, 400))
    rows = []
    for i in range(300):
        own = list(text)
        for at in rng.choice(400, int(rng.integers(1, 22)), replace=False):
            own[at] = str(rng.choice(vocabulary))
        rows.append((i, " ".join(own)))
    for i in range(300, 340):
        at = int(rng.integers(0, 400))
        text = text[:at] + [str(x) for x in rng.choice(vocabulary, 8)] + text[at + 8 :]
        rows.append((i, " ".join(text)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = plain.classes({i: plain.shingle_set(t, 3) for i, t in rows}, 85)
    assert {r.doc_id: r.component_id for r in neardup.duplicates(docs, Scratch(spark, "t")).collect()} == want


def cut(texts, width):
    """Texts by id; words left, and how many went."""
    seen, out = set(), {}
    for i in sorted(texts):
        w = plain.words(texts[i])
        gone = [False] * len(w)
        for j in range(len(w) - width + 1):
            window = tuple(w[j : j + width])
            if window in seen:
                gone[j : j + width] = [True] * width
            seen.add(window)
        out[i] = (len(w), sum(gone), hashlib.sha256(" ".join(x for x, g in zip(w, gone) if not g).encode()).hexdigest())
    return out


@pytest.mark.parametrize("width", [20, 3])
def test_repeated_passages(docs, rows, none, width, monkeypatch):
    want = cut({r[0]: r[1] for r in rows if r[0] is not None}, width)
    for block in (substrings.BLOCK_BYTES, 20_000):  # one block for all, and many
        monkeypatch.setattr(substrings, "BLOCK_BYTES", block)
        monkeypatch.setattr(substrings, "BUCKET_BYTES", block)
        got = substrings.removed(docs, width, texts=True).collect()
        assert len(got) == len(rows)
        for r in got:
            if r.doc_id is None:
                assert r.n_removed == 0
            else:
                assert (r.n_words, r.n_removed, r.kept_sha256) == want[r.doc_id]
            assert hashlib.sha256(r.kept_text.encode()).hexdigest() == r.kept_sha256
    assert substrings.removed(none, width).count() == 0


def test_quality_measures(spark, docs, rows, none):
    got = quality.verdicts(docs, Scratch(spark, "t"), min_group=20).collect()
    assert len(got) == len(rows)
    want = collections.Counter()
    for doc_id, text, *_ in rows:
        w = plain.words(text)
        n = collections.Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
        cover = {k for i in range(len(w) - 2) if n[tuple(w[i : i + 3])] > 1 for k in range(i, i + 3)}
        lines = [x for x in (text or "").split("\n") if plain.words(x)]
        base = len(w) < 50 or 100 * len(cover) > 50 * len(w)
        want[doc_id, len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(cover), base] += 1
    assert collections.Counter(tuple(r)[:7] for r in got) == want
    assert not any(r.kept and r.base_failed for r in got) and any(r.kept for r in got)
    assert quality.verdicts(none, Scratch(spark, "t")).count() == 0


def test_quality_bounds(spark):
    """Bounds follow the group: text full of symbols is usual in one source and goes in the other; a small group takes its language's."""
    rows = []
    for i in range(400):
        text = " ".join(f"word{(i * 7 + j * j) % 997}" for j in range(60))
        rows.append((i, text.replace("word", "#rd") if i % 2 else text, "en", "code" if i % 2 else "prose"))
    odd = " ".join(f"#rd{j * j % 997}" for j in range(60))
    rows += [(900, odd, "en", "prose"), (901, odd, "en", "code"), (902, odd, None, None)]
    got = {r.doc_id: r for r in quality.verdicts(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string"), Scratch(spark, "t"), 100).collect()}
    assert not got[900].kept and got[901].kept and all(got[i].kept for i in range(400))


def test_quality_bounds_of_every_rate(spark):
    """Groups built to differ in a rate get different bounds for it, and nothing but their quantiles sets them."""
    rng, rows = np.random.default_rng(3), []
    for i in range(600):
        b = i % 2
        words = [f"{'abcdefgh' if b else 'ab'}{k}" for k in rng.integers(0, 10**4, 70)]
        words[:3] = words[10:13] = words[20:23] if b else words[:3]
        words[5] = "#" * (1 + i % 7) * (1 + b)
        lines = [" ".join(words[k : k + 7]) for k in range(0, 70, 7)] + ["same line"] * (1 + i % 3 + 4 * b)
        rows.append((i, "\n".join(lines), "en", "b" if b else "a"))
    got = quality.verdicts(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string"), Scratch(spark, "t"), 100).collect()
    bounds = {r.source: {k: v for k, v in r.asDict().items() if k.startswith(("low_", "high_"))} for r in got}
    assert all(bounds["a"][k] < bounds["b"][k] for k in bounds["a"])
    for source in "ab":
        mine = [r for r in got if r.source == source]
        rates = sorted(r.n_symbols * 10_000 // r.n_words for r in mine)
        rank = lambda p: int(rates[-(-len(rates) * p // 100) - 1])
        low = lambda v: v >> max(v.bit_length() - 7, 0) << max(v.bit_length() - 7, 0)
        middle, tail = low(rank(50)), low(rank(90))
        assert bounds[source]["high_symbols"] == middle + 2 * (tail - middle + (tail >> 6))


def test_sketch_buckets(spark):
    values = [0, 1, 63, 64, 65, 127, 128, 129, 1000, 12345, 10**12]
    got = spark.createDataFrame([(v,) for v in values], "v long").select("v", quality.bucket(F.col("v")).alias("b")).collect()
    assert all(0 <= r.v - r.b <= r.v / 64 for r in got)


def test_secrets_of_very_long_texts(spark):
    """A run of a million key characters, 100 000 assignments and 50 000 candidates end soon, and are found."""
    run = "aB3" * 333_334
    texts = [(1, run), (2, "password=abcdefgh1234 " * 100_000), (3, "Zq9xW2kL7mP4vR8tY1sD5f and so on, " * 50_000 + "0123456789abcdef")]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    got = {r.doc_id: r for r in secret_scan.scan(docs, [1.0] * 67**2).collect()}
    assert [(got[i].n_assign, got[i].n_hex, got[i].n_markov) for i in (1, 2, 3)] == [(0, 0, 1), (100_000, 0, 0), (0, 1, 50_000)]
    assert got[1].spans == f"markov:0:{len(run)}"
    assert got[2].spans.split(",")[-1] == f"assign:{22 * 99_999}:{22 * 99_999 + 21}"
    clean = {r.doc_id: r.text for r in secret_scan.redacted(docs, [1.0] * 67**2).collect()}
    assert clean == {1: "[SECRET]", 2: "[SECRET] " * 100_000, 3: "[SECRET] and so on, " * 50_000 + "[SECRET]"}


def test_added_spans_by_the_plain_ratio(spark, docs, rows):
    """Over the whole awkward table: runs whose likelihood ratio is high and that no rule's span touches."""
    table = [((7 * k) % 23 - 9) / 10 for k in range(67**2)]
    for r in secret_scan.scan(docs.select("doc_id", "text").distinct(), table).collect():
        texts = {t for i, t, *_ in rows if i == r.doc_id}
        if len(texts) > 1:
            continue
        text = texts.pop() or ""
        spans = [tuple(x.split(":")) for x in r.spans.split(",") if x]
        base = [(int(a), int(b)) for k, a, b in spans if k != "markov"]
        want = []
        for m in re.finditer("[A-Za-z0-9+/_=-]{20,}", text):
            v = [secret_scan.ALPHABET.index(c) for c in m[0]]
            llr = sum(table[67 * a + b] for a, b in zip(v, v[1:]))
            if re.search("[0-9]", m[0]) and re.search("[A-Za-z]", m[0]) and llr >= 12 and not any(a < m.end() and m.start() < b for a, b in base):
                want.append(m.span())
        assert [(int(a), int(b)) for k, a, b in spans if k == "markov"] == want


def test_secret_rules_and_models(spark, docs, rows, none):
    assign = re.compile(secret_scan.ASSIGN.replace("(?i:password|passwd|secret|token|api_?key)", "(?i:password|passwd|secret|token|api_?key)"), re.ASCII)
    table = secret_scan.train(secret_scan.labelled_sample(docs))
    got = secret_scan.scan(docs, table).collect()
    assert len(got) == len(rows)
    want = collections.Counter()
    for doc_id, text, *_ in rows:
        t = text or ""
        s = [(m.start(), 0, m.end()) for m in assign.finditer(t) if len(m[2]) >= 12]
        s += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", t) if len(m[0]) >= 18]
        s += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", t) if len(m[0]) >= 16]
        listed = ",".join(f"{secret_scan.KINDS[k]}:{a}:{b}" for a, k, b in sorted(s))
        want[doc_id, *(sum(x[1] == k for x in s) for k in range(3)), hashlib.sha256(listed.encode()).hexdigest()] += 1
    assert collections.Counter(tuple(r)[:5] for r in got) == want
    assert secret_scan.scan(none, table).count() == 0

    key, name = "q7Zx0LpV9mTr2KbY4cWd8HsJ", "the_first_reader_of_the_other_thing1"
    texts = [(1, f"use {key} here"), (2, f"call {name} here"), (3, f"password={key}"), (4, f"é\U0001f600 {key}"), (5, None)]
    found = {r.doc_id: r.spans for r in secret_scan.scan(spark.createDataFrame(texts, "doc_id long, text string"), table).collect()}
    assert found == {1: "markov:4:28", 2: "", 3: "assign:0:33", 4: "markov:3:27", 5: ""}
    clean = {r.doc_id: r.text for r in secret_scan.redacted(spark.createDataFrame(texts, "doc_id long, text string"), table).collect()}
    assert clean == {1: "use [SECRET] here", 2: texts[1][1], 3: "[SECRET]", 4: "é\U0001f600 [SECRET]", 5: None}


def test_base_match_is_not_retried_inside_a_failed_one(spark):
    texts = [(1, "password=token: abcdefghijklmnop"), (2, "TOKEN = 'a.b-c_d=e/f+g' and api-key: no, apikey: 0123456789ab"), (3, "xAKIA" + "A" * 13 + " AKIA" + "B" * 14)]
    got = {r.doc_id: r.spans for r in secret_scan.scan(spark.createDataFrame(texts, "doc_id long, text string"), [0.0] * 67**2).collect()}
    assert got == {1: "", 2: "assign:0:22,assign:41:61", 3: "access:19:37"}


def test_mixing(spark, docs, rows, none, small):
    labels = spark.read.parquet(f"{small}/labels.parquet")
    weights = {"good": 0.7, "poor": 0.25, "toxic": 0.05}
    got = mixing.mix(docs, labels, F.expr(DOMAIN), weights, Scratch(spark, "t"), high=8.0).collect()
    assert len(got) == len(rows)
    names = [c for c in got[0].asDict() if c.startswith("p_")]
    p = np.array([[r[c] for c in names] for r in got])
    t, rate = np.array([r.n_tokens for r in got], float), np.array([r.rate for r in got])
    assert np.allclose(p.sum(axis=1), 1) and (rate >= 0).all() and (t == [len(plain.words(x)) for x in _texts(got, rows)]).all()
    target = np.array([weights[c[2:]] for c in names])
    target = target / target.sum() * t.sum()
    far = lambda r: float(np.linalg.norm((r * t) @ p - target)) / t.sum()
    # Brute force: plain projected gradient, many small steps.
    r = np.ones(len(t))
    scale = np.linalg.eigvalsh((p * t[:, None]).T @ p / t.sum()).max()
    for _ in range(20_000):
        r = np.clip(r - p @ (((r * t) @ p - target) / t.sum()) / scale, 0, 8)
    assert far(rate) <= far(r) + 2e-3
    assert all(r.copies in (math.floor(r.rate), math.floor(r.rate) + 1) for r in got)
    assert mixing.mix(none, labels, F.expr(DOMAIN), weights, Scratch(spark, "t")).count() == 0
    assert {r.rate for r in mixing.mix(docs, labels.limit(0), F.expr(DOMAIN), weights, Scratch(spark, "t")).collect()} == {1.0}
    thinned = mixing.remixed(docs, labels, F.expr(DOMAIN), Scratch(spark, "t"), "good", {"poor": 0.1})
    assert thinned.columns == docs.columns and thinned.count() < len(rows)


def _brute_rates(p, t, target, low, high, turns=3000):
    """Plain projected gradient from 1, whose step is one over the largest eigenvalue."""
    r, scale = np.ones(len(t)), np.linalg.eigvalsh((p * t[:, None]).T @ p / t.sum()).max()
    for _ in range(turns):
        r = np.clip(r - p @ ((t * r) @ p - target) / t.sum() / scale, low, high)
    return r


def test_mixing_meets_its_targets_on_a_larger_table(spark):
    got = op6_soft_mixing(spark, "/root/testdata/sf0.1").toPandas()
    p, t, rate = got[[f"p_{d}" for d in WEIGHTS]].to_numpy(), got.n_tokens.to_numpy(float), got.rate.to_numpy()
    target = np.array(list(WEIGHTS.values())) * t.sum()
    far = lambda r: float(np.linalg.norm((r * t) @ p - target)) / t.sum()
    assert (rate >= 0).all() and far(rate) <= far(_brute_rates(p, t, target, 0, np.inf))
    assert np.allclose((rate * t) @ p, target, rtol=1e-3)


def test_thinning_keeps_good_text_whole_on_a_larger_table(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    model = mixing.fit(docs, mixing.labelled_sample(labels, F.expr(DOMAIN)))
    known = Scratch(spark, "t").keep(mixing.posteriors(docs, model))
    rows = known.toPandas()
    p, t, good = np.array(rows.posterior.tolist()), rows.n_tokens.to_numpy(float), model.domains.index("good")
    whole = p.argmax(axis=1) == good
    target = t @ p * np.array([{"good": 1.0, "poor": 0.5, "toxic": 0.1}[d] for d in model.domains])
    found = mixing.solve(known, model.domains, dict(zip(model.domains, target)), target.sum(), 0.0, 1.0, "good")
    best = _brute_rates(p, t, target, np.where(whole, 1.0, 0.0), 1.0)
    assert np.allclose(found.reached, (best * t) @ p, rtol=1e-3)
    kept = {r.doc_id for r in mixing.remixed(docs, labels, F.expr(DOMAIN), Scratch(spark, "t"), "good", {"poor": 0.5, "toxic": 0.1}).select("doc_id").collect()}
    assert set(rows.doc_id[whole]) <= kept and len(kept) < len(rows)
    clean = {r.doc_id for r in labels.filter("quality = 1 AND toxic = 0").join(docs, "doc_id").select("doc_id").collect()}
    assert len(clean & kept) >= 0.99 * len(clean)


def _texts(got, rows):
    by_id = collections.defaultdict(list)
    for r in rows:
        by_id[r[0]].append(r[1])
    for texts in by_id.values():
        texts.sort(key=lambda x: len(plain.words(x)))
    used = collections.Counter()
    order = {}
    for r in sorted(got, key=lambda r: r.n_tokens):
        order[id(r)] = by_id[r.doc_id][used[r.doc_id]]
        used[r.doc_id] += 1
    return [order[id(r)] for r in got]


def test_language_model(spark, docs, rows, none):
    counts = collections.Counter()
    token = lambda t: [*plain.words(plain.lower(t)), None]
    for doc_id, text, *_ in rows:
        if plain.crc_fold(doc_id, 7) not in (2, None):
            counts.update(token(text))
    n, v = sum(counts.values()), len(counts)
    got = lm.scores(docs, fold(7) != 2, fold(7) == 2, Scratch(spark, "t"), share=2).collect()
    assert len(got) == len(rows)
    want = collections.Counter()
    for doc_id, text, *_ in rows:
        w = token(text)
        base = sum(math.log10((counts[x] + 1) / (n + v + 1)) for x in w)
        want[doc_id, plain.crc_fold(doc_id, 7) == 2, len(w), sum(counts[x] > 0 for x in w), n, round(base, 4)] += 1
    assert collections.Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4)) for r in got) == want
    assert all(math.isfinite(r.score) and r.score < 0 for r in got)
    assert lm.scores(none, fold(7) != 2, fold(7) == 2, Scratch(spark, "t")).count() == 0


def test_language_model_beats_unigrams(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    r = lm.scores(docs, fold(7) != 2, fold(7) == 2, Scratch(spark, "t"), share=4).filter("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert r[0] > r[1]


def test_language_model_learns_from_every_document(spark):
    docs = spark.createDataFrame([(i, "a b a c b a") for i in range(5)], "doc_id long, text string").coalesce(1)
    words, c = lm.frequent(lm.word_counts(docs))
    first = lm.gru.start(np.concatenate([[0, 5], c]))
    untrained = lm.gru.to_bytes(lm.gru.Trainer(first).p)
    for i in range(5):
        alone = lm.train(docs.filter(F.col("doc_id") == i), words, c, first)
        assert lm.gru.to_bytes(alone) != untrained


def test_packing(spark, docs, rows, none):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_files()[0])
    want = collections.Counter()
    for doc_id, text, *_ in rows:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 0], dtype="<u4")
        stops = range((len(ids) - 1) % 2048 + 1, len(ids) + 1, 2048)
        at = 0
        for k, stop in enumerate(stops):
            want[doc_id, k, at, stop - at, zlib.crc32(ids[at:stop].tobytes())] += 1
            at = stop
    got = packing.pack(docs, tokenizer_files(), Scratch(spark, "t")).collect()
    assert collections.Counter(tuple(r)[:5] for r in got) == want
    sequences = collections.defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append((r.offset, r.length))
    for s in sequences.values():
        at = 0
        for offset, length in sorted(s):
            assert offset == at
            at += length
        assert at <= 2048
    total = sum(r.length for r in got)
    assert len(sequences) <= 1.1 * total / 2048 + 2
    assert packing.pack(none, tokenizer_files(), Scratch(spark, "t")).count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_plan_places_every_piece_once(seed):
    rng = np.random.default_rng(seed)
    lengths = np.clip((rng.lognormal(5.5, 1.2, 5000)).astype(int), 1, 2048) if seed else np.full(5000, 700)
    histogram = dict(zip(*(x.tolist() for x in np.unique(lengths, return_counts=True))))
    plan = packing.Plan(histogram)
    fill = collections.defaultdict(list)
    for length, runs in plan.intervals.items():
        ranks = []
        for rank, n, sequence, offset in runs:
            ranks += range(rank, rank + n)
            for k in range(n):
                fill[sequence + k].append((offset, length))
        assert sorted(ranks) == list(range(histogram[length])) and ranks == sorted(ranks)
    for s in fill.values():
        at = 0
        for offset, length in sorted(s):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(fill) <= (1.02 * lengths.sum() / 2048 + 3 if seed else 2500)


def test_fast_encoding_gives_the_tokenizers_ids():
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_files()[0])
    encode = packing.Encoder(*tokenizer_files())
    for t in ["", " ", "a", " a", "a  b", "a \n b", "\n\n a\t b ", "it's  a   test\n  of 3.5 % or -7", "x\xa0 y 　z é\U0001f600 ß", "a _b __c", "  ", "a\x85b\x1cc", "<|endoftext|> x", "“a” — b’s…", "don't I'LL 12a½"]:
        assert encode(t) == tokenizer.encode(t, add_special_tokens=False).ids, t
