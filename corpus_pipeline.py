"""The training-data pipeline: language, near duplicates, benchmark overlap, secrets, tokens.

Each stage gets the rows that the one before has kept, as written and reread Parquet, and
returns the columns of ``documents``; the last returns tokens.

Defined results, of every stage: an empty table passes through; further columns, whatever
their names, are dropped by the first; very long texts are read whole; repeated rows share
their fate but in ``keep_one_of_each``, which keeps one of them; NULLs as each stage says.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import bpe, decontaminate, language, near_duplicates, secrets
from tidemark.llm.common import fold, stored, table
from tidemark.llm.queries import RANKS

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def keep_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is certain; those without letters and ambiguous ones go.

    A NULL or empty text has no letter and goes.  Two languages that are equally near are
    ambiguous.  A NULL ``doc_id`` or ``lang`` is judged by its text and not learned from.
    """
    docs = docs.select(*COLUMNS)
    return language.accepted(docs, language.learn(docs, fold("doc_id", 4) != 2))


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the least id.

    Texts without words (NULL, empty) link with nothing and all stay.  Of equal rows one stays;
    a NULL id comes after all others.
    """
    return near_duplicates.one_of_each(docs)


def keep_uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth occurs in the benchmark.

    NULL and empty texts have no words and stay; exactly a twentieth goes.
    """
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def keep_without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no rule finds a secret; NULL and empty texts stay."""
    return secrets.clean(docs)


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, their digest, and the digest of what they decode to.

    NULL and empty texts have no tokens.
    """
    tokens = bpe.round_trip(docs, bpe.rank_file(RANKS), public_tokenizers.PATTERN)
    return tokens.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        "ids",
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("language", keep_languages),
    ("ngram_join", keep_one_of_each),
    ("decontaminate", keep_uncontaminated),
    ("secrets", keep_without_secrets),
    ("byte_bpe", encode_tokens),
]

#: The first stage is a trained classifier, which SQL does not express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, from ``documents`` to tokens."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
