"""Lookups for whole batches of keys: one join each, a NULL result where nothing is found."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regiobank.operators.joins import left_lookup, references
from regiobank.sources.bank import Bank
from regiobank.sources.scratch import stage


def lookup(keys: DataFrame, table: DataFrame, key: str, *found: str) -> DataFrame:
    """Left join of keys with the first match per key; lower shards are searched first.

    The table shrinks to the keys asked for and to one row per key, and is written: few keys are joined without a
    shuffle, and a key asked for very often can be split, which Spark does only between plain tables.
    """
    order = [c for c in ("shard_location", "user_id", "account_id") if c in table.columns]
    asked = table.join(references(keys, [key], key), key, "left_semi")
    first = asked.groupBy(key).agg(F.min_by(F.struct(*found), F.struct(*order)).alias("_first"))
    first = stage(first, "found")
    kept = [c for c in keys.columns if c not in found]
    matched = left_lookup(keys.select(*kept), first, [key])
    return matched.select(*kept, *[F.col(f"_first.{c}").alias(c) for c in found])


def balances_for(keys: DataFrame, bank: Bank) -> DataFrame:
    return lookup(keys, bank.accounts_all.select("account_number", "shard_location", "balance"), "account_number", "balance")


def user_region(keys: DataFrame, bank: Bank) -> DataFrame:
    table = bank.users_all.select("user_id", "shard_location", F.upper("region").alias("region"))
    return lookup(keys, table, "user_id", "region")


def account_info(keys: DataFrame, bank: Bank) -> DataFrame:
    table = bank.accounts_all.select("account_number", "shard_location", F.upper("region").alias("region"))
    return lookup(keys, table, "account_number", "region", "shard_location")


def account_region(keys: DataFrame, bank: Bank) -> DataFrame:
    table = bank.accounts_all.select("account_number", "shard_location", F.upper("region").alias("region"))
    return lookup(keys, table, "account_number", "region")


def account_ids(keys: DataFrame, bank: Bank) -> DataFrame:
    table = bank.accounts.select("account_number", "shard_location", "account_id")
    return lookup(keys, table, "account_number", "account_id")


def find_users(keys: DataFrame, bank: Bank) -> DataFrame:
    """User id, region and shard per username; the lowest shard that knows the name wins."""
    table = bank.users_all.select("username", "shard_location", "user_id", F.upper("region").alias("region"))
    return lookup(keys, table, "username", "user_id", "region", "shard_location")
