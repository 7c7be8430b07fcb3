"""A corpus from raw documents to token ids: each stage reads what the one before kept.

Language identification rejects documents without a language, near-duplicate search keeps one document of each class,
mixing repeats or thins documents to the target weights, and byte-pair encoding ends the run.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from textloom.llm import bpe, langid, mixing, neardup
from textloom.runtime import materialize, read


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps texts with letters whose likeliest language has a mean probability of at least 0.3.

    Null, empty and letterless texts go; long texts are read whole; ties go to the first language; repeated rows are
    each judged; all columns stay, whatever their names; without labelled rows nothing has a language; an empty table
    stays empty.
    """
    return langid.accept(docs, langid.train(docs))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the least id of each class of near-duplicates.

    Classes follow texts: rows of one id and different texts, or without an id, are documents of their own. Null texts
    are in no class but that of their id; texts without a word only in that of equal ones; ties of ids go to the least
    digest, repeated rows to the least by their other columns; all columns stay; an empty table stays empty.
    """
    return neardup.keep_one(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats documents to the target weights; only documents that are likely toxic are thinned.

    Null and empty texts weigh nothing and follow their posterior; repeated rows and null ids are rows of their own;
    all columns stay, whatever their names; without labels nothing is thinned; an empty table stays empty.
    """
    return mixing.mixed(docs, read(spark, sf_dir, "labels"))


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every row.

    A null text is encoded as an empty one; texts of any length are whole; every repeated row gives a row; columns
    other than doc_id and text are not read; an empty table gives an empty one.
    """
    return bpe.round_trip(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [("language_id", language_id), ("near_dedup", near_dedup), ("mixing", mixing_stage), ("bpe", bpe_stage)]

#: No SQL expresses these stages; tests/llm holds the run against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
