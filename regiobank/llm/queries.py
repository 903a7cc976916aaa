"""The queries of this folder's operators: name -> (spark, folder of the Parquet tables) -> DataFrame, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regiobank.llm import collocations, decontaminate, langid, licenses, mainblocks, packing, quality, secrets, simhash, sql, substrings, tokens, topk, whitening

VOCABULARY = "byte_bpe_50k.json"

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return tokens.token_counts(_table(spark, folder, "documents"), public_tokenizers.path(VOCABULARY))


def op2_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate.contamination(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


def op3_quality(spark: SparkSession, folder: str) -> DataFrame:
    labels = _table(spark, folder, "labels").withColumnRenamed("quality", "label")
    return quality.classify(_table(spark, folder, "documents"), labels)


def op4_top_k(spark: SparkSession, folder: str) -> DataFrame:
    return topk.search_embeddings(_table(spark, folder, "embeddings"))


def op5_language_id(spark: SparkSession, folder: str) -> DataFrame:
    return langid.identify(_table(spark, folder, "documents"))


def op6_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack_documents(_table(spark, folder, "documents"), public_tokenizers.path(VOCABULARY))


def op7_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = secrets.scan(_table(spark, folder, "documents"), path="source")
    return found.select(
        "doc_id",
        "word",
        F.length("value").cast("long").alias("length"),
        F.sha2("value", 256).alias("value_sha256"),
        "score",
        "secret",
    )


def op8_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = licenses.scan(_table(spark, folder, "documents"), licenses.notice_table(spark))
    return found.select(
        "doc_id",
        "n_words",
        F.size("places").cast("long").alias("n_base"),
        F.array_min(F.col("places.word")).alias("first_word"),
        F.array_max(F.col("places.word")).alias("last_word"),
        F.array_join("base_labels", ",").alias("base_labels"),
        F.array_join("labels", ",").alias("labels"),
        "score",
    )


def op9_simhash(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(_table(spark, folder, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op10_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return substrings.remove_repeats(_table(spark, folder, "documents"))


def op11_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations.collocations(_table(spark, folder, "documents"))


def op12_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    return mainblocks.main_texts(_table(spark, folder, "pages"))


def op13_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.whiten(_table(spark, folder, "embeddings"))


def queries() -> dict[str, Query]:
    return {
        "op1_token_counts": op1_token_counts,
        "op2_decontamination": op2_decontamination,
        "op3_quality": op3_quality,
        "op4_top_k": op4_top_k,
        "op5_language_id": op5_language_id,
        "op6_packing": op6_packing,
        "op7_secret_scan": op7_secret_scan,
        "op8_license_scan": op8_license_scan,
        "op9_simhash": op9_simhash,
        "op10_substring_dedup": op10_substring_dedup,
        "op11_collocations": op11_collocations,
        "op12_html_extraction": op12_html_extraction,
        "op13_whitening": op13_whitening,
    }


def oracle_sql() -> dict[str, str]:
    return sql.oracle_sql()
