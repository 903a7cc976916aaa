"""Joins between transactions and accounts, written so that every join has plain equality keys.

A transaction names up to two accounts. "Either side equals the account" becomes one row per side, and counting
per account happens before the join, so an account with very many transactions is one row by then.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ACCOUNT_KEY = ["shard_location", "account_number"]


def home_account() -> Column:
    """The account a transaction is booked on: the source if there is one, else the destination."""
    return F.coalesce("from_account_number", "to_account_number")


def legs(transactions: DataFrame, *columns: str) -> DataFrame:
    """One row per account a transaction touches on its shard; a self-transfer touches its account once."""
    sides = F.array_distinct(F.array_compact(F.array("from_account_number", "to_account_number")))
    return transactions.select("shard_location", *columns, F.explode(sides).alias("account_number"))


def leg_totals(transactions: DataFrame) -> DataFrame:
    """Number of transactions and latest date per touched account."""
    return (
        legs(transactions, "transaction_date")
        .groupBy(*ACCOUNT_KEY)
        .agg(F.count(F.lit(1)).alias("legs"), F.max("transaction_date").alias("last_transaction_date"))
    )


def home_totals(transactions: DataFrame, *aggregates: Column) -> DataFrame:
    """Aggregates per home account; transactions without any side drop out."""
    return (
        transactions.withColumn("account_number", home_account())
        .where(F.col("account_number").isNotNull())
        .groupBy(*ACCOUNT_KEY)
        .agg(*aggregates)
    )


def row_weight() -> Column:
    """Rows an account contributes to an outer join with its transactions: at least one."""
    return F.greatest(F.coalesce("legs", F.lit(0)), F.lit(1)).cast("bigint")
