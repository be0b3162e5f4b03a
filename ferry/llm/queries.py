"""The operators applied to the given tables, and the SQL that some of them must agree with."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from ferry.llm import (
    conversations, exact, mixing, neighbours, ngrams, pieces, quality, records, repeats, secrets, simhash, spelling, toolcalls,
)
from ferry.llm.common import table

WORD_TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
PIECE_MODEL = public_tokenizers.path("piece_bpe_32k.model")


def op1_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_report(table(spark, sf_dir, "documents"))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_groups(table(spark, sf_dir, "documents"))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_report(table(spark, sf_dir, "documents"))


def op4_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.neighbours(table(spark, sf_dir, "embeddings"))


def op5_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.token_records(table(spark, sf_dir, "documents"), WORD_TOKENIZER)


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.piece_report(table(spark, sf_dir, "documents"), PIECE_MODEL)


def op8_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toolcalls.linked_conversations(table(spark, sf_dir, "conversations"))


def op9_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.repeat_report(table(spark, sf_dir, "documents"))


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_groups(table(spark, sf_dir, "documents"))


def op11_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngrams.score_report(table(spark, sf_dir, "documents"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.repair_report(table(spark, sf_dir, "conversations"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_report(table(spark, sf_dir, "documents"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_secrets, op2_simhash, op3_mixing, op4_neighbours, op5_token_records, op6_quality, op7_sentencepiece, op8_tool_calls,
        op9_repeats, op10_exact_dedup, op11_language_model, op12_conversation_repair, op13_spelling_variants,
    )
}
ORACLES = {
    "op1_secrets": secrets.SQL, "op8_tool_calls": toolcalls.SQL, "op9_repeats": repeats.SQL, "op10_exact_dedup": exact.SQL,
    "op12_conversation_repair": conversations.SQL, "op13_spelling_variants": spelling.SQL,
}
