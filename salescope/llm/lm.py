"""Language-model scores of whole documents: a recurrent network, beside smoothed unigrams.

Words are counted over all training documents; the counts stay a distributed table.  The most frequent words,
at most ``FREQUENT``, are sent to every task with their counts; other words of a document are joined
with the table, each once per document.  The network knows the ``VOCABULARY`` most frequent ones and
the end of a text; for any other word it gives the probability of an unknown word, which is multiplied by
the word's smoothed share among unknown words, so that probabilities of all texts add up to one.

The network is trained on all training documents, each once, in rounds; the id's hash tells in which.  In a
round each task trains a copy on its documents, from the same start, and the copies are averaged, by tokens,
as a distributed aggregate of parts of the parameter vector.  Only the mean comes to the driver.

Defined results: a null or empty text is its end alone.  A document without an id is not trained on, and
not held out.  Repeated rows are scored, and counted, each for itself.  Other columns are not looked at.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salescope.llm import gru
from salescope.llm.scratch import Scratch
from salescope.llm.words import BLOCK, word_blocks

FREQUENT = 65_536
VOCABULARY = 1_023
END = 1
ROUNDS = 2  # each trains on another one in so many training documents, together on all
LANES, TRAIN_LANES = 256, (32, 128)  # little text is trained on in few lanes, so that it makes enough steps
LANE = 4096  # tokens in a lane, between these bounds
RATE = 0.015
BLOCK_BYTES = 12 * BLOCK
CHUNK = 16_384


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for _, _, hashes, _ in word_blocks(batch.column(0), lower=True, size=BLOCK_BYTES):
            words, n = np.unique(hashes, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(words.view(np.int64)), pa.array(n)], ["word", "n"])


def word_counts(train: DataFrame) -> DataFrame:
    """``word`` (a hash) and ``c`` over all rows of ``train``."""
    return train.select("text").mapInArrow(_counts, "word long, n long").groupBy("word").agg(F.sum("n").alias("c"))


def frequent(counts: DataFrame, most: int = FREQUENT) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent words, at most ``most`` of them, by falling count, and their counts.

    A histogram of counts, in buckets of an eighth at most, tells where to cut; nothing is sorted.
    """
    shift = F.greatest(F.length(F.bin("c")) - 4, F.lit(0))
    level = F.call_function("shiftleft", F.call_function("shiftright", F.col("c"), shift), shift)
    levels = counts.groupBy(level.alias("level")).agg(F.count("*").alias("n")).collect()  # eight for each doubling
    least, held = None, 0
    for row in sorted(levels, key=lambda r: -r["level"]):
        held += row["n"]
        if held > most:
            break
        least = row["level"]
    if least is None:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    top = counts.filter(F.col("c") >= least).toArrow()
    words, c = top.column("word").to_numpy().view(np.uint64), top.column("c").to_numpy()
    order = np.lexsort((words, -c))
    return words[order], c[order]


class Lexicon:
    """Looks up the frequent words."""

    def __init__(self, words: np.ndarray, counts: np.ndarray):
        order = np.argsort(words)
        self.words, self.counts, self.rank = words[order], counts[order], order

    def __call__(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Whether each word is frequent, its count (0 if not), and its token."""
        if not len(self.words):
            return np.zeros(len(hashes), bool), np.zeros(len(hashes), np.int64), np.zeros(len(hashes), np.int64)
        at = np.minimum(np.searchsorted(self.words, hashes), len(self.words) - 1)
        found = self.words[at] == hashes
        rank = self.rank[at]
        return found, np.where(found, self.counts[at], 0), np.where(found & (rank < VOCABULARY), rank + 1 + END, 0)


def with_ends(tokens: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return np.insert(tokens, begin[1:], END), begin + np.arange(len(begin))


def train(docs: DataFrame, words: np.ndarray, counts: np.ndarray, first: gru.Params, share: int = ROUNDS) -> gru.Params:
    """The network after ``share`` rounds; each looks at another one in ``share`` of ``docs``, so every one is looked at once."""
    params = first
    pick = F.pmod(F.xxhash64("doc_id", F.lit("lm")), F.lit(share))
    for turn in range(share):

        def learn(batches: Iterator[pa.RecordBatch], now: gru.Params = params) -> Iterator[pa.RecordBatch]:
            lexicon, trainer = Lexicon(words, counts), gru.Trainer(now, RATE)
            for batch in batches:
                for _, _, hashes, begin in word_blocks(batch.column(0), lower=True, size=BLOCK_BYTES):
                    tokens, begin = with_ends(lexicon(hashes)[2], begin)
                    trainer.run(gru.Layout(tokens, begin, int(np.clip(len(tokens) // LANE, *TRAIN_LANES)), END))
            trainer.finish()
            if trainer.tokens:
                values = np.frombuffer(gru.to_bytes(trainer.p), dtype=np.float32)
                parts = [values[a : a + CHUNK].tobytes() for a in range(0, len(values), CHUNK)]
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(parts), dtype=np.int32)), pa.array([trainer.tokens] * len(parts), pa.int64()), pa.array(parts, pa.binary())], ["part", "n", "v"])

        def mean(table: pa.Table) -> pa.Table:
            n, total = 0, 0.0
            for k, v in zip(table.column("n").to_pylist(), table.column("v")):
                total = total + k * np.frombuffer(v.as_py(), dtype=np.float32).astype(np.float64)
                n += k
            return pa.table({"part": table.column("part").slice(0, 1), "v": pa.array([(total / n).astype(np.float32).tobytes()], pa.binary())})

        rows = docs.filter(pick == turn).select("text").mapInArrow(learn, "part int, n long, v binary")
        got = rows.groupBy("part").applyInArrow(mean, "part int, v binary").collect()
        if got:
            values = np.frombuffer(b"".join(bytes(r["v"]) for r in sorted(got, key=lambda r: r["part"])), dtype=np.float32)
            params = gru.from_values(values, first)
    return params


def _features(params: gru.Params, words: np.ndarray, counts: np.ndarray, ends: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon, row = Lexicon(words, counts), TaskContext.get().partitionId() << 40
        for batch in batches:
            for lo, hi, hashes, begin in word_blocks(batch.column(2), lower=True, size=BLOCK_BYTES):
                n, sizes = hi - lo, np.diff(begin)
                doc = np.repeat(np.arange(n), sizes)
                found, c, token = lexicon(hashes)
                log = np.log10(c + 1.0)
                total = lambda x: np.bincount(doc, x, minlength=n)
                layout = gru.Layout(*with_ends(token, begin), LANES, END)
                likely = gru.score(params, layout, n) / math.log(10)
                rare_doc, rare = doc[~found], hashes[~found]
                order = np.lexsort((rare, rare_doc))
                rare_doc, rare = rare_doc[order], rare[order]
                new = np.ones(len(rare), dtype=bool)
                new[1:] = (rare[1:] != rare[:-1]) | (rare_doc[1:] != rare_doc[:-1])
                at = np.flatnonzero(new)
                offsets = pa.array(np.searchsorted(rare_doc[at], np.arange(n + 1)).astype(np.int32))
                times = np.diff(at, append=len(rare))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(row + np.arange(n)),
                        *[batch.column(i).slice(lo, n) for i in range(2)],
                        pa.array(sizes + 1),
                        pa.array(total(found).astype(np.int64) + (ends > 0)),
                        pa.array(total(log) + math.log10(ends + 1)),
                        pa.array(total(token == 0).astype(np.int64)),
                        pa.array(total(np.where(token == 0, log, 0.0))),
                        pa.array(likely),
                        pa.ListArray.from_arrays(offsets, pa.array(rare[at].view(np.int64))),
                        pa.ListArray.from_arrays(offsets, pa.array(times)),
                    ],
                    ["row", "doc_id", "held_out", "n_tokens", "known", "logs", "unknown", "unknown_logs", "likely", "words", "times"],
                )
                row += n

    return run


def scores(docs: DataFrame, trains: Column, held_out: Column, scratch: Scratch, share: int = ROUNDS) -> DataFrame:
    """Per row of ``docs``: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score (both log10)."""
    learned = docs.filter(F.coalesce(trains, F.lit(False)))
    counts = scratch.keep(word_counts(learned))
    n_docs = learned.count()
    n_words, n_types = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    tokens, types = n_words + n_docs, n_types + (n_docs > 0)
    words, c = frequent(counts)
    vocabulary = c[:VOCABULARY]
    unknown = n_words - int(vocabulary.sum())
    first = gru.start(np.concatenate([[unknown, n_docs], vocabulary]))
    params = train(learned, words, c, first, share)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(held_out, F.lit(False)).alias("held_out"), "text")
    schema = "row long, doc_id long, held_out boolean, n_tokens long, known long, logs double, unknown long, unknown_logs double, likely double, words array<long>, times array<long>"
    seen = scratch.keep(rows.mapInArrow(_features(params, words, c, n_docs), schema))
    rare = seen.select("row", F.explode(F.arrays_zip("words", "times")).alias("x")).select("row", F.col("x.words").alias("word"), F.col("x.times").alias("n"))
    logs = rare.join(counts, "word").groupBy("row").agg(F.sum("n").alias("rare_known"), F.sum(F.col("n") * F.log10(F.col("c") + 1)).alias("rare_logs"))
    joined = seen.drop("words", "times").join(logs, "row", "left").na.fill(0, ["rare_known"]).na.fill(0.0, ["rare_logs"])
    # An unknown word's share among the words the network doesn't know, with one place for words never seen.
    per_unknown = math.log10(unknown + (n_types - len(vocabulary)) + 1)
    return joined.select(
        "doc_id", "held_out", "n_tokens", (F.col("known") + F.col("rare_known")).alias("n_known"), F.lit(tokens).cast("long").alias("train_tokens"),
        (F.col("logs") + F.col("rare_logs") - F.col("n_tokens") * math.log10(tokens + types + 1)).alias("base_score"),
        (F.col("likely") + F.col("unknown_logs") + F.col("rare_logs") - F.col("unknown") * per_unknown).alias("score"),
    )
