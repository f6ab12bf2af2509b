"""The registered queries of this subpackage: each operator on its whole table, as digests."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import bpe, conversation_repair, decontamination, exact_dedup, langid, licenses, mil_quality, ngram_join, paragraph_dedup, pii, prefix_trie, repetition, secrets, spans
from tidemark.llm.workspace import materialize, ship_package
from tidemark.plans.inputs import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}
TOKENIZER = "byte_bpe_50k.json"


def query(function: Query) -> Query:
    @wraps(function)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return function(spark, sf_dir)

    QUERIES[function.__name__] = run
    return run


def fold(key: str, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; null for a null id."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % folds


def sha256_hex(value: Column) -> Column:
    return F.sha2(value, 256)


@query
def op1_attention_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document; labels are learnt outside the held-out fifth."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labelled = table(spark, sf_dir, "labels").filter(fold("doc_id", 5) != 0)
    model = mil_quality.train_quality_model(labelled, docs)
    scored = docs.select(
        "doc_id",
        F.coalesce(fold("doc_id", 5) == 0, F.lit(False)).alias("held_out"),
        mil_quality.quality_score(F.col("text"), model).alias("score"),
    )
    return scored.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


@query
def op2_repetition_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and the suffix-array verdict of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = docs.select("doc_id", repetition.repetition_verdict(F.col("text")).alias("v"))
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    return found.select("doc_id", *(f"v.{n}" for n in names), "v.covered_words", "v.longest_repeat_words")


@query
def op4_byte_cnn_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document; languages are learnt outside the held-out quarter."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = langid.train_language_model(docs.filter(fold("doc_id", 4) != 2), docs)
    return docs.select(
        "doc_id",
        F.coalesce(fold("doc_id", 4) == 2, F.lit(False)).alias("held_out"),
        langid.predicted_language(F.col("text"), model).alias("p"),
    ).select("doc_id", "held_out", "p.lang_pred", "p.score")


@query
def op5_prefix_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document to token ids and back."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = docs.select("doc_id", bpe.encode_and_decode(F.col("text"), public_tokenizers.path(TOKENIZER)).alias("c"))
    return coded.select(
        "doc_id",
        (F.octet_length("c.ids") / 4).cast("bigint").alias("n_tokens"),
        sha256_hex(F.col("c.ids")).alias("ids_sha256"),
        sha256_hex(F.col("c.decoded").cast("binary")).alias("decoded_sha256"),
    )


@query
def op10_suffix_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark passages in every document, and whether they spoil it."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    matched = decontamination.with_matches(docs, table(spark, sf_dir, "benchmark"), "found")
    found = F.col("found")
    return matched.select(
        "doc_id",
        found["n_words"].alias("n_words"),
        decontamination.hit_words(found).alias("n_hit"),
        F.size(found["items"]).cast("bigint").alias("n_items"),
        sha256_hex(F.concat_ws(",", found["items"]).cast("binary")).alias("items_sha256"),
        decontamination.contaminated(found).alias("contaminated"),
        found["longest_words"].alias("longest_words"),
    )


@query
def op3_license_bigrams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence notices among the lines and paragraphs of every document."""
    return licenses.scan_licenses(table(spark, sf_dir, "documents"))


ORACLE["op3_license_bigrams"] = licenses.oracle_sql()


def _digest(found: DataFrame, kinds: list[str]) -> DataFrame:
    """Counts of the base kinds, their digest, and all spans as text."""
    base = F.col("base")
    return found.select(
        "doc_id",
        *(spans.count_of(base, kind).alias(f"n_{kind}") for kind in kinds),
        sha256_hex(spans.joined(base).cast("binary")).alias("base_sha256"),
        spans.joined(F.col("spans")).alias("spans"),
    )


@query
def op9_markov_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document."""
    found = secrets.find_secrets(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return _digest(found, ["assign", "access", "hex"])


@query
def op7_weak_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = materialize(pii.with_candidates(docs, "candidates").select("doc_id", "candidates"), "pii-candidates")
    classifier = pii.train_classifier(found, "candidates")
    located = found.select(
        "doc_id",
        pii.base_spans(F.col("candidates")).alias("base"),
        pii.all_spans(F.col("candidates"), classifier).alias("spans"),
    )
    return _digest(located, ["email", "ip", "card", "phone"])


@query
def op6_bayes_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class, links and copies of every document among its near duplicates."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return ngram_join.near_duplicates(docs).select("doc_id", "class_id", "n_links", "n_copies")


@query
def op8_paragraph_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated paragraphs, passages and whole texts of all documents."""
    return paragraph_dedup.repeated_units(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query
def op11_lightest_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults and the cheapest repair of every damaged conversation."""
    return conversation_repair.repair_conversations(table(spark, sf_dir, "conversations"))


@query
def op12_monoid_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes of the prefix trie of all rebuilt conversations."""
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"))


@query
def op13_polynomial_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact copies among all documents, and the one of each group that stays."""
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"))


ORACLE["op13_polynomial_exact"] = exact_dedup.oracle_sql()
