"""From `documents` to training sequences in five stages, each one an operator of regiobank.llm.

Every stage gets what its predecessor kept, as a written table. All but the last return documents with all their columns.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from regiobank.llm import decontaminate, packing, quality, secrets, simhash
from regiobank.llm.queries import VOCABULARY
from regiobank.sources.scratch import stage


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").withColumnRenamed("quality", "label")
    return quality.good_documents(docs, labels)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    return simhash.keep_one(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents go of which a twentieth of the words or more lies in passages of the benchmark."""
    return decontaminate.clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secret_masking(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents stay; secrets in their texts are masked."""
    return secrets.redact(docs, path="source" if "source" in docs.columns else None)


def sequence_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of training sequences."""
    return packing.pack_documents(docs, public_tokenizers.path(VOCABULARY))


STAGES = [
    ("quality classifier", quality_classifier),
    ("SimHash near-dedup", near_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("secret scans", secret_masking),
    ("packing", sequence_packing),
]

#: The classifier, the forest and the tokenizer have no SQL; tests compare the rows with a stage-by-stage brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, work in STAGES:
        docs = stage(work(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
