"""Catalog queries, directories and account reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from regiobank.functions.values import ascending, descending, rounded_avg, rounded_ratio
from regiobank.model import BAND_LIMITS, LIVE_DAYS, REGIONS, TOP_BAND
from regiobank.operators.legs import ACCOUNT_KEY, leg_totals, row_weight
from regiobank.operators.numbering import number_rows
from regiobank.plans.dashboard import OWNER_KEY, account_summary_all, recent
from regiobank.sources.bank import Bank, only_region

LIST_SEPARATOR = ", "
PAGE_ROWS = 1000


def account_summary(bank: Bank, exact: bool = False) -> DataFrame:
    """Accounts of each shard with owner, transaction count and latest transaction.

    An account without transactions counts 1, as in the view it reproduces; exact counts 0 for it.
    """
    owners = bank.users.select(*OWNER_KEY, "username", "full_name")
    activity = leg_totals(bank.transactions)
    count = F.coalesce("legs", F.lit(0)).cast("bigint") if exact else row_weight()
    return (
        bank.accounts.join(owners, OWNER_KEY)
        .join(activity, ACCOUNT_KEY, "left")
        .select(
            "account_number",
            "user_id",
            "username",
            "full_name",
            "account_type",
            "balance",
            "currency",
            "region",
            "status",
            count.alias("transaction_count"),
            "last_transaction_date",
        )
    )


def users_per_shard(bank: Bank, page_rows: int = PAGE_ROWS) -> DataFrame:
    """User names of each shard in user_id order, in pages of a fixed number of names."""
    names = bank.users_all.select("shard_location", "user_id", "username")
    numbered = number_rows(names, by=["shard_location"], order=["user_id", "username"])
    return (
        numbered.withColumn("page", F.call_function("div", F.col("position"), F.lit(page_rows)))
        .groupBy("shard_location", "page")
        .agg(
            F.count(F.lit(1)).alias("user_count"),
            F.array_join(
                F.transform(
                    F.array_sort(F.collect_list(F.struct("position", "username"))), lambda pair: pair["username"]
                ),
                LIST_SEPARATOR,
            ).alias("users"),
        )
    )


def accounts_by_region_shard(bank: Bank) -> DataFrame:
    return (
        bank.accounts_all.groupBy("region", "shard_location")
        .agg(
            F.count(F.lit(1)).alias("account_count"),
            F.sum("balance").alias("total_balance"),
            rounded_avg(F.col("balance")).alias("avg_balance"),
        )
        .orderBy(*ascending("region", "shard_location"))
    )


def users_by_region(bank: Bank, region: str) -> DataFrame:
    return (
        only_region(bank.users_all, region)
        .select("user_id", "username", "email", "region", "shard_location")
        .orderBy(*ascending("user_id"))
    )


def accounts_by_region(bank: Bank, region: str) -> DataFrame:
    return only_region(bank.accounts_all, region)


def accounts_over_balance(bank: Bank, limit) -> DataFrame:
    return bank.accounts_all.where(F.col("balance") > F.lit(limit).cast("decimal(15,2)"))


def account_summary_by_balance(bank: Bank) -> DataFrame:
    """Accounts with owners, richest first; equal balances in account order."""
    return (
        account_summary_all(bank)
        .select("account_number", "username", "full_name", "account_type", "balance", "region", "shard_location")
        .orderBy(*descending("balance"), *ascending("shard_location", "account_number"))
    )


def find_user(bank: Bank, username: str) -> DataFrame:
    return bank.users_all.where(F.col("username") == username).select(
        "user_id", "username", "email", "full_name", "region", "shard_location"
    )


def transactions_by_shard_type(bank: Bank) -> DataFrame:
    return (
        bank.transactions_all.groupBy("shard_location", "transaction_type")
        .agg(
            F.count(F.lit(1)).alias("transaction_count"),
            F.sum("amount").alias("total_amount"),
            rounded_avg(F.col("amount")).alias("avg_amount"),
        )
        .orderBy(*ascending("shard_location", "transaction_type"))
    )


def balance_bands(bank: Bank) -> DataFrame:
    """Accounts per balance band; an unknown balance falls into the top band, as CASE ... ELSE does."""
    band = None
    for name, limit in BAND_LIMITS:
        below = F.col("balance") < limit
        band = F.when(below, name) if band is None else band.when(below, name)
    keys = ["region", "shard_location", "balance_category"]
    return (
        bank.accounts_all.withColumn("balance_category", band.otherwise(TOP_BAND))
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("account_count"))
        .orderBy(*ascending(*keys))
    )


def account_lookup(bank: Bank, account_number: str) -> DataFrame:
    """One account by number; the lowest shard wins if several shards know it."""
    return (
        bank.accounts.where(F.col("account_number") == account_number)
        .orderBy(*ascending("shard_location"))
        .limit(1)
        .select("account_number", "account_type", "balance", "region", "status", "shard_location")
    )


def region_aggregate(bank: Bank) -> DataFrame:
    return (
        bank.accounts_all.groupBy("region")
        .agg(
            F.count(F.lit(1)).alias("account_count"),
            F.sum("balance").alias("total_balance"),
            rounded_avg(F.col("balance")).alias("avg_balance"),
            F.min("balance").alias("min_balance"),
            F.max("balance").alias("max_balance"),
        )
        .orderBy(*ascending("region"))
    )


def user_accounts(bank: Bank, user_id: int | None = None) -> DataFrame:
    """Accounts of one user (the lowest user id by default), oldest first."""
    owners = bank.users_all
    wanted = owners.agg(F.min("user_id")).scalar() if user_id is None else F.lit(user_id)
    owner = owners.where(F.col("user_id") == wanted).select(*OWNER_KEY, "username", "full_name")
    return (
        bank.accounts_all.join(owner, OWNER_KEY)
        .orderBy(*ascending("created_date", "account_number"))
        .select("account_number", "account_type", "balance", "region", "username", "full_name")
    )


def account_history(bank: Bank, account_number: str) -> DataFrame:
    """Transactions with the account on either side, latest first."""
    touches = (F.col("from_account_number") == account_number) | (F.col("to_account_number") == account_number)
    return (
        bank.transactions_all.where(touches)
        .select(
            "from_account_number",
            "to_account_number",
            "transaction_type",
            "amount",
            "status",
            "transaction_date",
            "description",
            "reference_number",
        )
        .orderBy(*descending("transaction_date", "reference_number"))
    )


def transaction_distribution(bank: Bank) -> DataFrame:
    return bank.transactions_all.agg(
        F.count(F.lit(1)).alias("total_transactions"),
        F.sum("amount").alias("total_amount"),
        F.min("transaction_date").alias("first_transaction"),
        F.max("transaction_date").alias("last_transaction"),
    )


def realtime_analytics(bank: Bank, as_of=None, days: int = LIVE_DAYS) -> DataFrame:
    return (
        recent(bank, days, as_of)
        .groupBy("transaction_type")
        .agg(
            F.count(F.lit(1)).alias("transaction_count"),
            F.sum("amount").alias("total_amount"),
            rounded_avg(F.col("amount")).alias("avg_amount"),
            F.min("amount").alias("min_amount"),
            F.max("amount").alias("max_amount"),
        )
        .orderBy(*ascending("transaction_type"))
    )


def regional_share(bank: Bank) -> DataFrame:
    """Balance per region and its share of the grand total, largest first."""
    per_region = bank.accounts_all.groupBy("region").agg(
        F.count_distinct("account_number").alias("accounts"), F.sum("balance").alias("total_balance")
    )
    # One row per region is left, so the grand total is a sum over a handful of rows.
    grand_total = F.sum("total_balance").over(Window.partitionBy())
    percentage = rounded_ratio(F.col("total_balance") * 100, grand_total)
    return per_region.withColumn("percentage", percentage).orderBy(
        *descending("total_balance"), *ascending("region")
    )


def first_accounts(bank: Bank) -> DataFrame:
    """Lowest user id among the owners of accounts, and lowest account number, of each region.

    Users without an account are left out, unlike in a minimum over the table of users.
    """
    return (
        bank.accounts_all.groupBy("region")
        .agg(F.min("user_id").alias("first_user_id"), F.min("account_number").alias("first_account_number"))
        .orderBy(*ascending("region"))
    )


def balance_check(bank: Bank) -> DataFrame:
    """One account of each region, the lowest number, with its balance."""
    first = F.min_by(F.struct("account_number", "balance"), F.struct("account_number", "shard_location"))
    return (
        bank.accounts_all.where(F.col("region").isin(*REGIONS))
        .groupBy("region")
        .agg(first.alias("first"))
        .select("first.account_number", "first.balance", "region")
        .orderBy(*ascending("region"))
    )


def users_directory(bank: Bank) -> DataFrame:
    return bank.users_all.select("user_id", "username", "email", "region", "shard_location").orderBy(
        *ascending("user_id")
    )


def accounts_directory(bank: Bank) -> DataFrame:
    """Accounts of each shard in account id order."""
    return bank.accounts.select(
        "shard_location", "account_id", "user_id", "account_number", "account_type", "balance", "region"
    ).orderBy(*ascending("shard_location", "account_id"))


def users_dropdown(bank: Bank) -> DataFrame:
    return bank.users_all.select("user_id", "username", "full_name", "region").orderBy(*ascending("username", "user_id"))


def accounts_list(bank: Bank) -> DataFrame:
    owners = bank.users_all.select(*OWNER_KEY, "username", "full_name")
    return (
        bank.accounts_all.join(owners, OWNER_KEY, "left")
        .orderBy(*ascending("account_number", "shard_location"))
        .select(
            "account_number",
            "user_id",
            "account_type",
            "balance",
            "currency",
            "region",
            "status",
            "created_date",
            "username",
            "full_name",
        )
    )


def users_list(bank: Bank) -> DataFrame:
    """All users with number and balance of their accounts, aggregated per owner before the join."""
    held = bank.accounts_all.groupBy(*OWNER_KEY).agg(
        F.count_distinct("account_number").alias("account_count"), F.sum("balance").alias("total_balance")
    )
    return (
        bank.users_all.join(held, OWNER_KEY, "left")
        .select(
            "user_id",
            "username",
            "email",
            "full_name",
            "phone",
            "address",
            "region",
            "created_date",
            F.coalesce("account_count", F.lit(0)).cast("bigint").alias("account_count"),
            F.coalesce("total_balance", F.lit(0)).alias("total_balance"),
        )
        .orderBy(*ascending("user_id"))
    )


def transaction_summary(bank: Bank) -> DataFrame:
    return (
        bank.transactions.groupBy("transaction_type")
        .agg(F.count(F.lit(1)).alias("count"), F.sum("amount").alias("total_amount"))
        .orderBy(*ascending("transaction_type"))
    )


def account_count(bank: Bank) -> DataFrame:
    return bank.accounts_all.agg(F.count(F.lit(1)).alias("account_count"))


def accounts_per_region(bank: Bank) -> DataFrame:
    return (
        bank.accounts_all.groupBy("region")
        .agg(F.count(F.lit(1)).alias("account_count"))
        .orderBy(*ascending("region"))
    )
