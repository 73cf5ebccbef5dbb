"""The corpus pipeline: five stages from raw documents to packed sequences.

Every stage reads all rows that the one before kept, as Parquet in the shared folder.  Stages return the
columns of ``documents``, except the last, which returns pieces and their places.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salescope.llm import langid, mixing, neardup, packing, secret_scan
from salescope.llm.queries import DOMAIN, tokenizer_files
from salescope.llm.scratch import Scratch

LEAST_SCORE = 0.25  # of language identification
SHARES = {"poor": 0.5, "toxic": 0.1}  # what is left of the expected tokens of these domains; good text stays whole


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Text in no learned language goes: without letters, or in no language's order of n-grams."""
    return langid.accepted(docs, langid.learn(docs), LEAST_SCORE)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays, the one with the smallest id; five-word shingles, 80 percent."""
    return neardup.one_of_each(docs, Scratch(spark, "neardup"), neardup.STAGE)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark; every document stays."""
    return secret_scan.redacted(docs, secret_scan.train(secret_scan.labelled_sample(docs)))


def mix_to_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Poor and toxic text is thinned out to its share of the expected tokens."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return mixing.remixed(docs, labels, F.expr(DOMAIN), Scratch(spark, "mixing"), "good", SHARES)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents, placed in sequences of 2048 tokens."""
    return packing.pack(docs, tokenizer_files(), Scratch(spark, "packing"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("secrets", secrets),
    ("mixing", mix_to_weights),
    ("packing", pack_sequences),
]

ORACLE_SQL = None  # the models of the stages are not to be stated in SQL; tests hold the stages against plain Python


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows, of all documents."""
    docs, scratch = spark.read.parquet(f"{sf_dir}/documents.parquet"), Scratch(spark, "pipeline")
    for k, (_, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        docs = out if k == len(STAGES) - 1 else scratch.keep(out)
    return docs
