"""The registered queries of the text operators: each reads whole tables of a folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salescope.llm import chat, codes, langid, lm, mixing, neardup, packing, phrases, quality, secret_scan, substrings, tiles, vptree
from salescope.llm.scratch import Scratch
from salescope.llm.sql import SQL  # noqa: F401  the SQL beside the queries


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def fold(n: int) -> Column:
    """crc32 of the document's id as text, modulo ``n``."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(n))


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from four of five folds."""
    docs = documents(spark, sf_dir)
    profiles = langid.learn(docs.filter(fold(5) != 0))
    return langid.predict(docs, profiles, {"doc_id": F.col("doc_id"), "held_out": F.coalesce(fold(5) == 0, F.lit(False))})


def op2_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class of every document under links of 85 percent."""
    return neardup.duplicates(documents(spark, sf_dir), Scratch(spark, "neardup"))


def op3_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without passages of 20 words that occur earlier."""
    return substrings.removed(documents(spark, sf_dir))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures of every document and whether it stays."""
    return quality.verdicts(documents(spark, sf_dir), Scratch(spark, "quality"))


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document."""
    docs = documents(spark, sf_dir)
    return secret_scan.scan(docs, secret_scan.train(secret_scan.labelled_sample(docs)))


DOMAIN = "CASE WHEN toxic = 1 THEN 'toxic' WHEN quality = 1 THEN 'good' WHEN quality = 0 THEN 'poor' END"
WEIGHTS = {"good": 0.90, "poor": 0.08, "toxic": 0.02}


def op6_soft_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rates of every document for target weights of good, poor and toxic text."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return mixing.mix(documents(spark, sf_dir), labels, F.expr(DOMAIN), WEIGHTS, Scratch(spark, "mixing"))


def op7_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest of every hundredth vector."""
    return vptree.nearest(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op8_recurrent_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of every document by unigrams and by the network, learned from six of seven folds."""
    return lm.scores(documents(spark, sf_dir), fold(7) != 2, fold(7) == 2, Scratch(spark, "lm"))


SAMPLE_TEXT = "\\### Assistant: </turn> ok"


def op9_chat_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digest of all conversations and one made of control strings, read back from their training examples."""
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    more = spark.range(2).select(F.lit(-7), "id", F.when(F.col("id") == 0, "user").otherwise("assistant"), F.lit(SAMPLE_TEXT))
    return chat.read_back(chat.examples(turns.union(more)))


def tokenizer_files() -> tuple[str, str, str]:
    """The tokenizer's file, its vocabulary as ranks, and its splitting pattern."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's pieces and their places in sequences of 2048 tokens."""
    return packing.pack(documents(spark, sf_dir), tokenizer_files(), Scratch(spark, "packing"))


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes of all vectors over codebooks of two rounds."""
    return codes.compress(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), Scratch(spark, "codes")).drop("label")


def op12_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and class of every vector under cosines of 0.93 within its label."""
    return tiles.near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), Scratch(spark, "tiles"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 2000 phrases of each language."""
    return phrases.collocations(documents(spark, sf_dir), Scratch(spark, "phrases"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_language_id": op1_language_id,
    "op2_near_duplicates": op2_near_duplicates,
    "op3_repeated_passages": op3_repeated_passages,
    "op4_quality_rules": op4_quality_rules,
    "op5_secret_scan": op5_secret_scan,
    "op6_soft_mixing": op6_soft_mixing,
    "op7_nearest_neighbours": op7_nearest_neighbours,
    "op8_recurrent_lm": op8_recurrent_lm,
    "op9_chat_examples": op9_chat_examples,
    "op10_best_fit_packing": op10_best_fit_packing,
    "op11_vector_codes": op11_vector_codes,
    "op12_near_vectors": op12_near_vectors,
    "op13_collocations": op13_collocations,
}
