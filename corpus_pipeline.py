"""From raw documents to token counts of a training mix: five stages, each over all that the one before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ferry.llm import exact, mixing, pieces, quality, simhash
from ferry.llm.common import stored, table
from ferry.llm.queries import PIECE_MODEL


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts; it learns from labels of the documents it is given. Null and empty texts
    are scored as texts without words; repeated rows stay or go together; other columns stay as they are."""
    return quality.accepted(docs, table(spark, sf_dir, "labels"))


def different_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the smallest doc_id; null equals empty. Rows that repeat that doc_id all stay, and a
    null doc_id only where no other has the text."""
    return exact.exact_dedup(docs)


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest doc_id. Texts without words are one group; rows without a
    doc_id all stay."""
    return simhash.near_dedup(docs)


def mixed_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as the mix of sources takes them: one taken twice is there twice. A null source is a source; texts without words
    weigh nothing."""
    return mixing.mixed(docs)


def encoded_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document's pieces, and whether decoding them gives its text: a row for each row, null and empty texts with none."""
    return pieces.piece_report(docs, PIECE_MODEL)


STAGES = [
    ("quality classifier", good_documents),
    ("exact dedup", different_documents),
    ("SimHash near-dedup", distinct_documents),
    ("mixing sources to target weights", mixed_documents),
    ("SentencePiece encoding and decoding", encoded_documents),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; what each returns is written to the shared folder and read again for the next."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir))
    return docs


#: SQL has neither the learnt classifier nor SimHash components; the tests compare each stage with a plain version.
ORACLE_SQL = None
QUERIES = {"pipeline": run}
ORACLES = {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
