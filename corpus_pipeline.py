"""From raw documents to a mixed, encoded corpus: five stages, each one operator of ``tabloom.llm``."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabloom.llm import bpe, language, lines, mixing, near_dup
from tabloom.llm.common import kept

#: Documents whose language is less likely than this are rejected.
LEAST_SCORE = 0.5
VOCABULARY = "byte_bpe_50k.json"


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters, and those of no clear language, go. Null and empty texts have no letters."""
    found = language.identify(docs)
    clear = (F.col("lang_pred") != language.UNDETERMINED) & (F.col("score") >= LEAST_SCORE)
    return found.where(clear).select(*docs.columns)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that stand on many sources go; ``n_chars`` follows the text. No document goes."""
    cleaned = lines.clean_lines(docs)
    chars = F.when(F.col("n_removed") > 0, F.length("text")).otherwise(F.col("n_chars")).cast("bigint")
    return cleaned.withColumn("n_chars", chars).select(*docs.columns)


def dedup_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates (five-word shingles, similarity 0.8) the document with the smallest id stays."""
    return near_dup.deduplicate(docs, width=5, percent=80)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixing.mix(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their token ids, and whether decoding these gives the text again (null texts: empty)."""
    tokenizer = bpe.load(spark, public_tokenizers.path(VOCABULARY))
    decoded = bpe.encode(docs, tokenizer, decoded="decoded")
    return decoded.withColumn("round_trip", F.col("decoded") == F.coalesce("text", F.lit(""))).drop("decoded")


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", dedup_lines),
    ("near_dedup", dedup_documents),
    ("source_mix", mix_sources),
    ("bpe", encode),
]

# The first stage is a fitted classifier, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in turn over the documents; every stage's result is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = kept(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
