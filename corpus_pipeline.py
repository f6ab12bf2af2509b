"""A corpus from raw documents to token ids, one operator a stage.

Stages run in order on what the one before kept; each result is written as Parquet and
read again. All but the last return the columns of ``documents``. A column of the
documents whose name equals one of a stage's own is kept; the stages' own begin with two
underscores and are dropped. An empty table passes through every stage.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import bpe, decontamination, ngram_join, pii, repetition
from tidemark.llm.workspace import materialize, ship_package

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents that pass the base rules and the repetition limits; null and empty texts fail."""
    ship_package(spark)
    judged = docs.withColumn("__verdict", repetition.repetition_verdict(F.col("text")))
    return judged.filter("__verdict.kept").drop("__verdict")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document of the least id of each class of near duplicates."""
    ship_package(spark)
    return ngram_join.one_of_each(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents of which a twentieth or more is benchmark text."""
    ship_package(spark)
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = decontamination.with_matches(docs, benchmark, "__found")
    return found.filter(~decontamination.contaminated(F.col("__found"))).drop("__found")


def redact_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Put the kind in brackets in place of personal data; n_chars follows the new text."""
    found = materialize(pii.with_candidates(docs, "__candidates"), "pii-candidates")
    classifier = pii.train_classifier(found, "__candidates")
    changed = F.size("__candidates") > 0
    text = F.when(changed, pii.redacted(F.col("text"), pii.all_spans(F.col("__candidates"), classifier))).otherwise(F.col("text"))
    out = found.withColumn("text", text)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.when(changed, F.char_length("text").cast(kind)).otherwise(F.col("n_chars")))
    return out.select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Add n_tokens, token_ids (little-endian 32-bit) and whether they decode to the text.

    Columns of these names that the documents have already are replaced.
    """
    ship_package(spark)
    coded = docs.withColumn("__coded", bpe.encode_and_decode(F.col("text"), public_tokenizers.path("byte_bpe_50k.json")))
    return (
        coded.withColumn("n_tokens", (F.octet_length("__coded.ids") / 4).cast("bigint"))
        .withColumn("token_ids", F.col("__coded.ids"))
        .withColumn("round_trip", F.col("__coded.decoded") == F.coalesce("text", F.lit("")))
        .drop("__coded")
    )


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("decontaminate", decontaminate),
    ("redact_pii", redact_pii),
    ("encode", encode),
]

#: Suffix arrays, MinHash and byte-level BPE cannot be put in SQL; tests hold the rows
#: against a brute-force pipeline instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs


QUERIES = {"pipeline": run}
ORACLE: dict[str, str] = {}
