"""Mixing of documents to target weights of domains, by soft membership.

A naive Bayes classifier, fitted on a bounded sample of a labelled table, gives every document a
posterior over the domains; its features are hashed words and hashed pairs of bytes.  Its evidence counts as
that of at most ``EVIDENCE`` features, so posteriors stay soft.  Then each document gets a rate, how often it
is to be seen: rates are bounded below by 0, start at 1, and minimise the squared distance between
the expected tokens of each domain (sum of rate times tokens times posterior) and their targets.  The descent is a projected
gradient method: a step moves each rate along its document's posterior, against the gradient, and clips it to its bounds.
Steps are implicit: the gradient is that at the step's end, so a step of any length goes downhill, also where rates lie
on their bounds.  That gradient, one number per domain, is found by Newton's method, each of whose passes is one distributed
aggregate of the expected tokens and second moments of all documents.  The descent ends when the targets are met or the
norm of the projected gradient is nothing, and not before.  A rate follows from the posterior and the list of steps, so
nothing per document is sent anywhere.

Defined results: a null or empty text has the priors as posterior and no tokens, so it moves no
total.  Rows with a null label, or with labels that disagree, teach nothing.  Without labels every rate is 1.
Domains without a target weight have weight 0, and so have targets no domain was learned for.  Repeated
rows are each mixed for themselves, by equal rates.  Other columns are not looked at.
"""

from __future__ import annotations

import warnings
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salescope.llm.scratch import Scratch
from salescope.llm.words import released, text_blocks, word_blocks

BUCKETS = 4096  # of words, and as many of pairs of bytes
SAMPLE = 20_000  # bound of the labelled documents that the classifier is fitted on
MAX_DOMAINS = 64
EVIDENCE = 40.0
TURNS = 60  # bound of steps, and of passes to find one; a descent that it ends is warned of
TOLERANCE = 1e-6  # distance to the targets, as a share of all tokens, that counts as met
SLOPE = 1e-8  # norm of the projected gradient that counts as none
DAMP, LEAST_DAMP = 1e-2, 1e-9  # of the first step, and of the last ones; a tenth of the one before in between


def features(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Of each row: its place, the counts of its features, and its number of words."""
    for (lo, hi, hashes, begin), (_, _, data, off) in zip(word_blocks(texts, lower=True), text_blocks(texts)):
        words = (hashes >> np.uint64(40)).astype(np.int64) % BUCKETS
        pairs = (data[:-1].astype(np.int64) << 8 | data[1:]) * 40503 % 65521 % BUCKETS + BUCKETS if len(data) > 1 else np.empty(0, np.int64)
        for i in range(hi - lo):
            a, b = off[i], off[i + 1]
            own = np.concatenate([words[begin[i] : begin[i + 1]], pairs[a : max(a, b - 1)]])
            yield lo + i, np.bincount(own, minlength=2 * BUCKETS), int(begin[i + 1] - begin[i])


@dataclass
class Classifier:
    domains: list[str]
    prior: np.ndarray
    weights: np.ndarray  # log-probability of each feature, by domain

    def posterior(self, counts: np.ndarray) -> np.ndarray:
        if not self.domains:
            return np.empty(0)
        n = counts.sum()
        x = self.prior + (self.weights @ counts) * (min(EVIDENCE, n) / n if n else 0.0)
        x = np.exp(x - x.max())
        return x / x.sum()


def labelled_sample(labels: DataFrame, domain: Column, bound: int = SAMPLE) -> DataFrame:
    """At most ``bound`` ids with one domain, those with the smallest hash of the id: __id, __domain."""
    rows = labels.select(F.col("doc_id").cast("long").alias("__id"), domain.alias("__domain")).filter("__id IS NOT NULL AND __domain IS NOT NULL")
    rows = rows.groupBy("__id").agg(F.min("__domain").alias("__domain"), F.max("__domain").alias("__other")).filter("__domain = __other")
    return rows.select("__id", "__domain").orderBy(F.xxhash64("__id"), "__id").limit(bound)


def fit(docs: DataFrame, sample: DataFrame) -> Classifier:
    """Feature counts of the sample's documents, summed by domain; ``sample`` is bounded and is broadcast."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            domains = batch.column(1).to_pylist()
            sums: dict[str, np.ndarray] = {}
            n: dict[str, int] = {}
            for i, counts, _ in features(batch.column(0)):
                name = domains[i]
                sums[name] = sums.get(name, 0) + counts
                n[name] = n.get(name, 0) + 1
            for name, total in sums.items():
                at = np.flatnonzero(total)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * (len(at) + 1)), pa.array(np.append(at, -1)), pa.array(np.append(total[at], n[name]))], ["domain", "feature", "n"]
                )

    rows = docs.select("doc_id", "text").join(F.broadcast(sample), F.col("doc_id") == F.col("__id")).select("text", "__domain")
    sums = rows.mapInArrow(released(count), "domain string, feature long, n long").groupBy("domain", "feature").agg(F.sum("n").alias("n"))
    got = sums.limit(MAX_DOMAINS * (2 * BUCKETS + 1) + 1).toArrow().to_pylist()
    domains = sorted({r["domain"] for r in got})
    if len(domains) > MAX_DOMAINS:
        raise ValueError(f"more than {MAX_DOMAINS} domains")
    counts, prior = np.ones((len(domains), 2 * BUCKETS)), np.zeros(len(domains))
    for r in got:
        j = domains.index(r["domain"])
        if r["feature"] < 0:
            prior[j] = r["n"]
        else:
            counts[j, r["feature"]] += r["n"]
    for half in (slice(0, BUCKETS), slice(BUCKETS, 2 * BUCKETS)):
        counts[:, half] /= counts[:, half].sum(axis=1, keepdims=True) if domains else 1
    return Classifier(domains, np.log(prior / prior.sum()) if domains else prior, np.log(counts))


def posteriors(docs: DataFrame, model: Classifier) -> DataFrame:
    """doc_id, n_tokens (words) and posterior of every row."""

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p, n = [], []
            for _, counts, words in features(batch.column(1)):
                p.append(model.posterior(counts))
                n.append(words)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(p, pa.list_(pa.float64()))], ["doc_id", "n_tokens", "posterior"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(released(predict), "doc_id long, n_tokens long, posterior array<double>")


def rates(p: np.ndarray, steps: list[np.ndarray], low: float, high: float, keep: int | None = None) -> np.ndarray:
    """Rates of documents with posteriors ``p``, after the projected steps; those most probably of domain ``keep`` stay at 1 at least."""
    r, floor = np.ones(len(p)), _floor(p, low, keep)
    for s in steps:
        r = np.clip(r - p @ s, floor, high)
    return r


def _floor(p: np.ndarray, low: float, keep: int | None) -> np.ndarray | float:
    return low if keep is None else np.where(p.argmax(axis=1) == keep, max(low, 1.0), low)


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


@dataclass
class View:
    """Sums over all documents, of rates one step on from those of the steps before it."""

    expected: np.ndarray  # tokens of each domain
    moments: np.ndarray  # tokens times the outer product of posteriors, where the rate lies between its bounds
    primitive: float  # of the expected tokens, as a function of the step
    moved: float  # tokens times the squared change of rates by a plain step along a gradient, from before the step


def look(known: DataFrame, width: int, steps: list[np.ndarray], step: np.ndarray, gradient: np.ndarray, low: float, high: float, keep: int | None = None) -> View:
    """One pass over the documents, as an aggregate of a few numbers."""

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p, tokens = _matrix(batch.column(1), width), batch.column(0).to_numpy()
            floor = _floor(p, low, keep)
            r = rates(p, steps, low, high, keep)
            wish = r - p @ step
            after = np.clip(wish, floor, high)
            free = tokens * ((wish > floor) & (wish < high))
            sums = [
                (after * tokens) @ p,
                ((p * free[:, None]).T @ p).ravel(),
                [tokens @ (r * r / 2 - (after * wish - after * after / 2)), tokens @ (r - np.clip(r - p @ gradient, floor, high)) ** 2],
            ]
            x = np.concatenate(sums)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(x))), pa.array(x)], ["d", "x"])

    rows = known.select("n_tokens", "posterior").mapInArrow(total, "d long, x double").groupBy("d").agg(F.sum("x").alias("x")).collect()
    out = np.zeros(width + width * width + 2)
    for r in rows:
        out[r["d"]] = r["x"]
    return View(out[:width], out[width:-2].reshape(width, width), float(out[-2]), float(out[-1]))


@dataclass
class Mix:
    steps: list[np.ndarray]
    target: np.ndarray
    reached: np.ndarray
    low: float
    high: float
    keep: int | None = None
    gradient: float = 0.0  # norm of the projected gradient at the end
    passes: int = 0


def solve(
    known: DataFrame, domains: list[str], weights: dict[str, float], budget: float | None = None, low: float = 0.0, high: float = np.inf, keep: str | None = None
) -> Mix:
    """Steps to rates whose expected tokens are nearest to ``weights`` of ``budget`` tokens (all there are, if not given).

    Rates of documents that are most probably of domain ``keep`` stay at 1 at least.
    """
    width, kept = len(domains), domains.index(keep) if keep in domains else None
    zero, passes = np.zeros(width), 0

    def at(step: np.ndarray, gradient: np.ndarray) -> View:
        nonlocal passes
        passes += 1
        return look(known, width, steps, step, gradient, low, high, kept)

    steps: list[np.ndarray] = []
    here = at(zero, zero) if width else View(zero, np.zeros((0, 0)), 0.0, 0.0)
    total = float(here.expected.sum())  # posteriors add up to 1
    share = np.array([weights.get(d, 0.0) for d in domains])
    if not width or not total or not share.sum():
        return Mix([], here.expected, here.expected, low, high, kept)
    target = share / share.sum() * (total if budget is None else budget)
    while True:
        gradient = (here.expected - target) / total
        here = at(zero, gradient)
        slope = float(np.sqrt(here.moved / total))
        done = np.linalg.norm(gradient) <= TOLERANCE or slope <= SLOPE
        if not done and len(steps) == TURNS:
            warnings.warn(f"mixing is not at its optimum: the projected gradient's norm is {slope:.1e} after {TURNS} steps")
        if done or len(steps) == TURNS:
            return Mix(steps, target, here.expected, low, high, kept, slope, passes)
        # The step is 1 / damp times the gradient at its own end, the zero of ``off``; that has a convex primitive.
        damp = max(DAMP / 10 ** len(steps), LEAST_DAMP)
        step, off, value = zero, -gradient, 0.0
        for _ in range(TURNS):
            if np.linalg.norm(off) <= 0.01 * max(slope, SLOPE):
                break
            newton = -np.linalg.solve(here.moments / total + damp * np.eye(width), off)
            pace = 1.0
            while pace > 1e-9:
                trial = step + pace * newton
                there = at(trial, gradient)
                height = damp / 2 * (trial @ trial) + (trial @ target - there.primitive) / total
                if height <= value + 1e-4 * pace * (off @ newton) + 1e-13 * (1 + abs(there.primitive) / total):
                    break
                pace /= 2
            step, here, value = trial, there, height
            off = damp * step - (here.expected - target) / total
        steps.append(step)


def _copies(rate: np.ndarray, draw: np.ndarray) -> np.ndarray:
    return np.floor(np.round(rate, 9) + draw).astype(np.int64)


DRAW = "pmod(xxhash64(doc_id, 'mix'), 1048576) / 1048576D"  # in [0, 1), the same for a document wherever it lies


def mixed(known: DataFrame, domains: list[str], mix: Mix) -> DataFrame:
    """doc_id, n_tokens, posterior of each domain, rate, and copies: the rate rounded up or down at random by the id's hash."""

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = _matrix(batch.column("posterior"), len(domains)) if domains else np.zeros((batch.num_rows, 0))
            r = rates(p, mix.steps, mix.low, mix.high, mix.keep)
            copies = _copies(r, batch.column("draw").to_numpy())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("n_tokens"), *[pa.array(p[:, j].copy()) for j in range(len(domains))], pa.array(np.round(r, 9)), pa.array(copies)],
                ["doc_id", "n_tokens", *[f"p_{d}" for d in domains], "rate", "copies"],
            )

    schema = "doc_id long, n_tokens long, " + "".join(f"`p_{d}` double, " for d in domains) + "rate double, copies long"
    return known.withColumn("draw", F.expr(DRAW)).mapInArrow(rate, schema)


def mix(docs: DataFrame, labels: DataFrame, domain: Column, weights: dict[str, float], scratch: Scratch, low: float = 0.0, high: float = np.inf) -> DataFrame:
    """Rates of all rows of ``docs``, for domains learned from ``labels``."""
    model = fit(docs, labelled_sample(labels, domain))
    known = scratch.keep(posteriors(docs, model))
    return mixed(known, model.domains, solve(known, model.domains, weights, low=low, high=high))


def remixed(docs: DataFrame, labels: DataFrame, domain: Column, scratch: Scratch, keep: str, shares: dict[str, float]) -> DataFrame:
    """The rows of ``docs`` thinned out: ``keep`` stays whole, other domains are brought down to ``shares`` of their expected tokens.

    No rate is over 1, and documents that are most probably of domain ``keep`` have rate 1, so all of them stay.  The
    others meet the targets as nearly as that allows; a document of ``keep`` that the classifier takes for another can go.
    """
    model = fit(docs, labelled_sample(labels, domain))
    known = scratch.keep(posteriors(docs, model))
    width = len(model.domains)
    natural = look(known, width, [], np.zeros(width), np.zeros(width), 0.0, 1.0).expected if width else np.zeros(0)
    target = {d: float(n) * (1.0 if d == keep else shares.get(d, 1.0)) for d, n in zip(model.domains, natural)}
    found = solve(known, model.domains, target, sum(target.values()), 0.0, 1.0, keep)
    scratch.drop(known)
    place = docs.columns.index("text")
    rows = docs.withColumn("__draw", F.expr(DRAW))

    def thin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = np.array([model.posterior(counts) for _, counts, _ in features(batch.column(place))]).reshape(-1, width)
            copies = _copies(rates(p, found.steps, found.low, found.high, found.keep), batch.column(len(batch.columns) - 1).to_numpy())
            yield batch.select(batch.schema.names[:-1]).filter(pa.array(copies > 0))

    return rows.mapInArrow(released(thin), docs.schema)
