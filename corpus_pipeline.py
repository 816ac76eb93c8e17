"""A training corpus from raw documents: known languages, no copies, no near copies, no repeated passages, packed.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor
kept. All but the last return the columns of ``documents``; the last returns
the places of token pieces in training sequences.
"""
from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm.exact_dedup import drop_copies
from tidewater.llm.jaccard_join import keep_one
from tidewater.llm.language_id import held_out, keep_known, train
from tidewater.llm.packing import FEWER_REMEMBERED, pack, token_pieces
from tidewater.llm.substring_dedup import keep_unique_text
from tidewater.session import materialise, prepare, table


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents whose language the classifier rejects."""
    return keep_known(docs, train(docs.filter(~held_out(docs)).select("text", "lang")))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts (A to Z lower-cased) the document with the largest id stays."""
    return drop_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of similar documents (5 words, Jaccard 0.75) the one with the smallest id stays."""
    return keep_one(docs, n=5, percent=75)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut passages of 35 words or more that recur in what is left."""
    return keep_unique_text(docs, length=35)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack the tokens of the texts into sequences of 4096."""
    pieces = token_pieces(docs, public_tokenizers.path("word_bpe_49k.json"), remembered=FEWER_REMEMBERED)
    return pack(pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")))


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("packing", packing),
]

#: Training, signatures, automata and the packing search are not SQL; the tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage returns is written and read again as the next one's input."""
    docs = table(prepare(spark), sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
