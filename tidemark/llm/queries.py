"""One query per operator, over whole tables; SQL where it can express the result."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    bpe,
    decontaminate,
    language,
    log_bilinear,
    merkle,
    near_duplicates,
    passages,
    pii,
    prefix_trie,
    quality_classifier,
    quality_rules,
    secrets,
    toxicity,
)
from tidemark.llm.common import count_kind, fold, span_digest, table
from tidemark.llm.oracles import ORACLES  # noqa: F401  the entry module takes them from here

QUERIES = {}

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def query(function):
    QUERIES[function.__name__] = function
    return function


@query
def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


def held_out(parts: int, part: int) -> Column:
    """Whether a document is kept from learning; a NULL id is not used for it either."""
    return F.coalesce(fold("doc_id", parts) == part, F.lit(False)).alias("held_out")


@query
def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = quality_classifier.learn(docs, labels, fold("doc_id", 5) != 0)
    scored = quality_classifier.score(docs, model)
    predicted = (F.col("score") >= 0.3).cast("int").alias("predicted")
    return scored.select("doc_id", held_out(5, 0), "score", predicted)


@query
def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(table(spark, sf_dir, "documents"))


@query
def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_digests(table(spark, sf_dir, "documents"))


def token_digests(docs: DataFrame) -> DataFrame:
    tokens = bpe.round_trip(docs, bpe.rank_file(RANKS), public_tokenizers.PATTERN)
    return tokens.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query
def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.learn(docs, labels, fold("doc_id", 3) != 1)
    scored = toxicity.score(docs, model)
    predicted = (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted")
    return scored.select("doc_id", held_out(3, 1), "score", predicted)


@query
def op6_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates.join(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "class_id", "n_links", "copy_id")


@query
def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(table(spark, sf_dir, "documents"))
    spans = F.col("spans")
    return found.select(
        "doc_id",
        *(count_kind(spans, kind).alias(f"n_{kind}") for kind in pii.BASE_KINDS),
        F.sha2(span_digest(spans, pii.BASE_KINDS), 256).alias("base_sha256"),
        span_digest(spans).alias("spans"),
    )


@query
def op8_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.find(table(spark, sf_dir, "documents"))


@query
def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = language.predict(docs, language.learn(docs, fold("doc_id", 4) != 2))
    return found.select("doc_id", held_out(4, 2), "lang_pred", "score", "ambiguous")


@query
def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find(table(spark, sf_dir, "documents"))
    spans = F.col("spans")
    return found.select(
        "doc_id",
        *(count_kind(spans, kind).alias(f"n_{kind}") for kind in secrets.BASE_KINDS),
        F.sha2(span_digest(spans, secrets.BASE_KINDS), 256).alias("base_sha256"),
        span_digest(spans).alias("spans"),
    )


@query
def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = merkle.manifest(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


@query
def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    convs = prefix_trie.conversations(table(spark, sf_dir, "conversations"))
    nodes = prefix_trie.trie(prefix_trie.share_beginnings(convs))
    return nodes.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"
    )


@query
def op13_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = log_bilinear.log_probabilities(table(spark, sf_dir, "documents"), fold("doc_id", 7) != 2)
    return found.select(
        "doc_id", held_out(7, 2), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )
