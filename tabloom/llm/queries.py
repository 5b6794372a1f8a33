"""Registered queries of this subpackage, each over its whole table, with the SQL that checks them where SQL can."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabloom.llm import alignment, ball_tree, bloom_rank, bpe, cross_polytope, language, lines, mixing, near_dup, packing, pages, spans, token_counts

VOCABULARY = "byte_bpe_50k.json"
WORDS = "word_bpe_49k.json"
PIECES = "piece_bpe_32k.model"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def _query(name: str, sql: str | None = None):
    def add(function):
        QUERIES[name] = function
        if sql is not None:
            SQL[name] = sql
        return function

    return add


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@_query("op1_cross_polytope")
def cross_polytope_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    return cross_polytope.nearest(_table(spark, folder, "embeddings"), F.col("vec_id") % 20 == 0)


@_query("op5_ball_tree", ball_tree.SQL)
def ball_tree_top_products(spark: SparkSession, folder: str) -> DataFrame:
    return ball_tree.top_products(_table(spark, folder, "embeddings"), F.col("vec_id") % 20 == 0)


@_query("op3_mix_sources", mixing.SQL)
def mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix_report(_table(spark, folder, "documents"))


@_query("op2_token_counts")
def count_tokens(spark: SparkSession, folder: str) -> DataFrame:
    tokenizer = bpe.load(spark, public_tokenizers.path(VOCABULARY))
    return token_counts.token_counts(_table(spark, folder, "documents"), tokenizer)


@_query("op4_language_id")
def identify_language(spark: SparkSession, folder: str) -> DataFrame:
    found = language.identify(_table(spark, folder, "documents"))
    return found.select("doc_id", language.held_out("doc_id").alias("held_out"), "lang_pred", "score")


@_query("op6_page_differencing")
def extract_main_text(spark: SparkSession, folder: str) -> DataFrame:
    return pages.extract(_table(spark, folder, "pages")).select("page_id", "url", "text", "n_chars")


@_query("op7_bpe")
def encode_and_decode(spark: SparkSession, folder: str) -> DataFrame:
    tokenizer = bpe.load(spark, public_tokenizers.path(VOCABULARY))
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    return bpe.encode(docs, tokenizer, keep_text=False, decoded="decoded").select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"),
    )


@_query("op8_near_duplicates")
def near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return near_dup.near_duplicates(_table(spark, folder, "documents"), width=3, percent=85)


@_query("op9_substring_dedup")
def substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return spans.remove_repeats(_table(spark, folder, "documents")).select("doc_id", "text", "n_sentences", "n_removed")


@_query("op10_line_dedup", lines.SQL)
def line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return lines.clean_lines(_table(spark, folder, "documents")).select("doc_id", "text", "n_lines", "n_removed")


@_query("op12_best_fit_packing")
def pack_documents(spark: SparkSession, folder: str) -> DataFrame:
    tokenizer = packing.load(spark, public_tokenizers.path(WORDS))
    return packing.pack(packing.pieces(_table(spark, folder, "documents"), tokenizer))


@_query("op13_bloom_ranking", bloom_rank.SQL)
def rank_documents(spark: SparkSession, folder: str) -> DataFrame:
    return bloom_rank.search(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


@_query("op11_token_alignment")
def align_tokenizers(spark: SparkSession, folder: str) -> DataFrame:
    files = alignment.load(spark, public_tokenizers.path(VOCABULARY), public_tokenizers.path(PIECES))
    return alignment.align(_table(spark, folder, "documents"), files)
