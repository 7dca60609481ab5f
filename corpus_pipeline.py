"""The corpus pipeline: every stage reads what the one before it wrote.

Quality, repeated passages, near duplicates, benchmark leaks, tokens. All stages but the last
return the columns of ``documents``; the last adds the token ids and figures about them.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from areastats.llm.common import table
from areastats.llm.decontam import remove_leaking
from areastats.llm.jaccard_join import keep_one_of_each
from areastats.llm.line_dedup import dedup_lines
from areastats.llm.quality import quality_scores
from areastats.llm.unigram import encode_pieces, read_pieces
from areastats.session import stage

#: The first stage trains a classifier, which SQL cannot express; the tests compare with plain Python.
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject."""
    scored = quality_scores(docs, table(spark, sf_dir, "labels"))
    return scored.where("predicted = 1").select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the later occurrences of repeated passages; a text that was nothing else goes."""
    return dedup_lines(docs, drop_emptied=True)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return keep_one_of_each(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark."""
    return remove_leaking(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts as pieces and back, with the ids."""
    return encode_pieces(docs, read_pieces(public_tokenizers.path("piece_bpe_32k.model"), scores="ranks"))


STAGES = [
    ("quality classifier", quality),
    ("line dedup", line_dedup),
    ("n-gram Jaccard join", near_dedup),
    ("benchmark decontamination", decontaminate),
    ("SentencePiece encoding and decoding", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each result written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, apply in STAGES:
        docs = stage(apply(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
