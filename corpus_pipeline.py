"""From raw documents to packed training sequences: rules, classifier, near copies, packing.

Each stage takes (spark, docs, sf_dir) and returns a frame that is written and read
again before the next one. All but the last return the columns they were given.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tamiz.llm.line_crf import passing as classified
from tamiz.llm.packing import pack_documents
from tamiz.llm.quality_rules import passing
from tamiz.llm.queries import QUALITY, table, tokenizer_path, train_quality
from tamiz.llm.simhash import one_of_each
from tamiz.sources.staged import shared_folder, stage


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that break no quality rule.

    NULL, empty and blank texts have no words and are rejected; texts of any length are
    judged whole; NULL ids and repeated rows are rows like others; other columns stay,
    whatever their names; an empty table gives none.
    """
    return passing(docs)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line field scores as good.

    The field learns from the raw documents that are labelled and not held out: what
    the rules have left holds too few bad ones. NULL and empty texts get a score like
    any text, whole texts of any length are scored line by line, repeated rows get the
    same verdict, NULL ids are never asked for; other columns stay, whatever their
    names; an empty table gives none.
    """
    field = train_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return classified(docs, field, QUALITY)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, that with the smallest id.

    Texts without words are copies of each other. Of rows with equal ids the one with
    the smaller text hash stays, of equal rows one; a group whose ids are all NULL keeps
    one too. Other columns stay, whatever their names; an empty table gives none.
    """
    return one_of_each(docs, size=3, max_bits=3)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 2048 tokens.

    NULL and empty texts are one end id; longer documents are cut, however long; rows
    with equal or NULL ids are packed each; an empty table gives none.
    """
    packed = pack_documents(docs, tokenizer_path("word_bpe_49k.json"), 2048, 0)
    return packed.select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    )


STAGES = [
    ("quality_rules", quality_rules),
    ("quality_classifier", quality_classifier),
    ("simhash_near_dedup", simhash_near_dedup),
    ("best_fit_packing", best_fit_packing),
]

# The classifier and the packing cannot be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage returns is staged for the next."""
    folder = shared_folder(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for i, (name, function) in enumerate(STAGES[:-1]):
        docs = stage(function(spark, docs, sf_dir), f"{folder}/{i}-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
