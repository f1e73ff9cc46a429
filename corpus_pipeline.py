"""A training-data pipeline over ``documents``; each stage reads what the last one kept.

Classifiers are fitted as in their own queries, on rows that are not in the
held-out fold: languages on all of them, quality on a bounded sample. A stage keeps
all columns of the documents but the last, which gives token ids and what they decode to.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierflow.llm.byte_bpe import round_trip
from tierflow.llm.common import table
from tierflow.llm.decontaminate import drop_contaminated
from tierflow.llm.language_id import fit_languages, keep_identified, least_evidence
from tierflow.llm.quality import fit_quality, keep_good
from tierflow.llm.queries import held_out, split_pattern, tokenizer_path
from tierflow.llm.simhash import drop_near_duplicates
from tierflow.staging import stage


def identify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, of no clear language, or hardly like any that is known, go."""
    labelled = docs.where(~held_out(4, 2))
    model = fit_languages(labelled)
    return keep_identified(docs, model, min_evidence=least_evidence(labelled, model))


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier holds for low quality go."""
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    return keep_good(docs, fit_quality(docs, labels.where(~held_out(3, 1))))


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest id of each group of near duplicates stays."""
    return drop_near_duplicates(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of the benchmark go."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids, and the digest of what they decode to."""
    ranks = tokenizer_path("byte_bpe_50k.tiktoken")
    return round_trip(docs.select("doc_id", "text"), ranks, split_pattern()).select(
        "doc_id", "n_tokens", "ids", F.sha2("decoded_bytes", 256).alias("decoded_sha256")
    )


STAGES = [
    ("language_id", identify),
    ("quality", classify),
    ("near_duplicates", deduplicate),
    ("decontamination", decontaminate),
    ("byte_bpe", tokenize),
]

# Trained classifiers, fingerprints and token ids are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs, _ = stage(step(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
