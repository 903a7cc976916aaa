"""Statistics views over the cross-shard tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regiobank.functions.values import (
    ascending,
    count_of,
    descending,
    rounded_avg,
    rounded_ratio,
    sum_of_type,
    sum_or_zero,
)
from regiobank.model import RECENT_ROWS, VOLUME_DAYS
from regiobank.operators.legs import ACCOUNT_KEY, home_totals, leg_totals, row_weight
from regiobank.sources.bank import Bank

OWNER_KEY = ["user_id", "shard_location"]
TYPE_COUNTS = {"deposits": "DEPOSIT", "withdrawals": "WITHDRAWAL", "transfers": "TRANSFER"}
TYPE_TOTALS = {f"total_{name}": kind for name, kind in TYPE_COUNTS.items()}


def account_summary_all(bank: Bank) -> DataFrame:
    """Accounts with their owners, on all shards."""
    owners = bank.users_all.select(
        *OWNER_KEY, "username", "full_name", "email", F.col("created_date").alias("user_created")
    )
    held = bank.accounts_all.withColumnRenamed("created_date", "account_created")
    return held.join(owners, OWNER_KEY).select(
        "account_number",
        "user_id",
        "username",
        "full_name",
        "email",
        "account_type",
        "balance",
        "currency",
        "region",
        "status",
        "account_created",
        "user_created",
        "shard_location",
    )


def regional_stats(bank: Bank) -> DataFrame:
    """Per region statistics over accounts joined with their transactions.

    As in the view it reproduces, an account counts once per transaction that touches it (once if none does), in
    the counts and in the balances. The weight stands for those repeated rows.
    """
    owners = bank.users_all.select(*OWNER_KEY, F.col("user_id").alias("owner"))
    weighted = (
        bank.accounts_all.select(*OWNER_KEY, "account_number", "region", "balance")
        .join(owners, OWNER_KEY, "left")
        .join(leg_totals(bank.transactions_all).select(*ACCOUNT_KEY, "legs"), ACCOUNT_KEY, "left")
        .withColumn("weight", row_weight())
    )
    weighted_total = F.sum(F.col("balance") * F.col("weight"))
    counted = F.sum(F.when(F.col("balance").isNotNull(), F.col("weight")))
    return (
        weighted.groupBy("region")
        .agg(
            F.count_distinct("owner").alias("user_count"),
            F.count_distinct("account_number").alias("account_count"),
            F.sum("weight").alias("transaction_count"),
            weighted_total.alias("total_balance"),
            rounded_ratio(weighted_total, counted).alias("avg_balance"),
            F.min("balance").alias("min_balance"),
            F.max("balance").alias("max_balance"),
        )
        .orderBy(*ascending("region"))
    )


def regional_stats_exact(bank: Bank) -> DataFrame:
    """As regional_stats, but every account and every touching transaction counts once."""
    owners = bank.users_all.select(*OWNER_KEY, F.col("user_id").alias("owner"))
    counted = (
        bank.accounts_all.select(*OWNER_KEY, "account_number", "region", "balance")
        .join(owners, OWNER_KEY, "left")
        .join(leg_totals(bank.transactions_all).select(*ACCOUNT_KEY, "legs"), ACCOUNT_KEY, "left")
    )
    return (
        counted.groupBy("region")
        .agg(
            F.count_distinct("owner").alias("user_count"),
            F.count_distinct("account_number").alias("account_count"),
            F.coalesce(F.sum("legs"), F.lit(0)).alias("transaction_count"),
            F.sum("balance").alias("total_balance"),
            rounded_avg(F.col("balance")).alias("avg_balance"),
            F.min("balance").alias("min_balance"),
            F.max("balance").alias("max_balance"),
        )
        .orderBy(*ascending("region"))
    )


def transaction_stats_by_region(bank: Bank) -> DataFrame:
    """Transactions counted in the region of their home account, aggregated per account before the join."""
    per_account = home_totals(
        bank.transactions_all,
        F.count(F.lit(1)).alias("total_transactions"),
        *[count_of("transaction_type", kind).alias(name) for name, kind in TYPE_COUNTS.items()],
        *[sum_of_type(kind).alias(name) for name, kind in TYPE_TOTALS.items()],
    )
    places = bank.accounts_all.select(*ACCOUNT_KEY, "region")
    measures = ["total_transactions", *TYPE_COUNTS, *TYPE_TOTALS]
    return per_account.join(places, ACCOUNT_KEY).groupBy("region").agg(*[F.sum(m).alias(m) for m in measures])


def _owned(bank: Bank) -> DataFrame:
    """Accounts that have an owner, with the region they count in."""
    owners = bank.users_all.select(*OWNER_KEY, F.col("region").alias("_home"))
    owned = bank.accounts_all.select(*OWNER_KEY, "account_number", "region").join(owners, OWNER_KEY)
    return owned.withColumn("region", F.coalesce("region", "_home"))


def _holdings(bank: Bank) -> DataFrame:
    """Users with the balances they hold, aggregated per owner first: an owner of very many accounts is one row."""
    held = bank.accounts_all.groupBy(*OWNER_KEY, F.col("region").alias("_held_in")).agg(
        F.sum("balance").alias("held"), F.count("balance").alias("holdings")
    )
    users = bank.users_all.select(*OWNER_KEY, "region")
    return users.join(held, OWNER_KEY, "left").withColumn("region", F.coalesce("_held_in", "region"))


def _holding_measures() -> list:
    return [
        F.count_distinct("user_id").alias("total_users"),
        sum_or_zero(F.col("held")).alias("total_balance"),
        rounded_ratio(F.sum("held"), F.sum("holdings")).alias("avg_balance_per_account"),
    ]


def dashboard_regional_stats(bank: Bank) -> DataFrame:
    """Users, accounts, balances and transactions per region."""
    holdings = _holdings(bank).groupBy("region").agg(*_holding_measures())
    counted = _owned(bank).groupBy("region").agg(F.count_distinct("account_number").alias("total_accounts"))
    both = holdings.join(counted, "region", "left").join(transaction_stats_by_region(bank), "region", "full")

    def or_zero(name: str):
        return F.coalesce(name, F.lit(0)).alias(name)

    return both.select(
        "region",
        *[
            or_zero(name)
            for name in [
                "total_users",
                "total_accounts",
                "total_transactions",
                "total_balance",
                "avg_balance_per_account",
                *TYPE_COUNTS,
                *TYPE_TOTALS,
            ]
        ],
    ).orderBy(*ascending("region"))


def dashboard_overall_stats(bank: Bank) -> DataFrame:
    """One row of totals over all shards; the average stays NULL where there is no account."""
    holdings = _holdings(bank).agg(*_holding_measures())
    counted = _owned(bank).agg(F.count_distinct("account_number").alias("total_accounts"))
    flows = transaction_totals(bank.transactions_all)
    # Each part is one row; stacking them and taking the value present avoids a product of rows.
    stacked = holdings.unionByName(counted, allowMissingColumns=True).unionByName(flows, allowMissingColumns=True)
    order = [
        "total_users",
        "total_accounts",
        "total_transactions",
        "total_balance",
        "avg_balance_per_account",
        *STATUS_COUNTS,
        *TYPE_TOTALS,
    ]
    return stacked.agg(*[F.max(c).alias(c) for c in order]).select(F.lit("TOTAL").alias("metric"), *order)


STATUS_COUNTS = {
    "completed_transactions": "COMPLETED",
    "pending_transactions": "PENDING",
    "failed_transactions": "FAILED",
}


def transaction_totals(transactions: DataFrame) -> DataFrame:
    """Global transaction totals by status and type; works on a batch and on a stream."""
    return transactions.agg(
        F.count(F.lit(1)).alias("total_transactions"),
        *[count_of("status", status).alias(name) for name, status in STATUS_COUNTS.items()],
        *[sum_of_type(kind).alias(name) for name, kind in TYPE_TOTALS.items()],
    )


def dashboard_recent_transactions(bank: Bank, rows: int = RECENT_ROWS) -> DataFrame:
    """The latest transactions; ties go to the higher reference number."""
    return (
        bank.transactions_all.select(
            "from_account_number",
            "to_account_number",
            "transaction_type",
            "amount",
            "status",
            "transaction_date",
            "description",
            "reference_number",
            "shard_location",
        )
        .orderBy(*descending("transaction_date", "reference_number"))
        .limit(rows)
    )


def dashboard_accounts_by_region(bank: Bank) -> DataFrame:
    return (
        bank.accounts_all.groupBy("region", "account_type")
        .agg(
            F.count(F.lit(1)).alias("account_count"),
            sum_or_zero(F.col("balance")).alias("total_balance"),
            rounded_avg(F.col("balance")).alias("avg_balance"),
            F.min("balance").alias("min_balance"),
            F.max("balance").alias("max_balance"),
        )
        .orderBy(*ascending("region", "account_type"))
    )


def recent(bank: Bank, days: int, as_of=None) -> DataFrame:
    """`since` over a bank. A store knows its latest transaction, so it is read once, from the start of the window on."""
    return since(bank.transactions_all, days, bank.latest_transaction() if as_of is None else as_of)


def since(transactions: DataFrame, days: int, as_of=None) -> DataFrame:
    """Transactions of the last days before as_of, time of day included; as_of defaults to the latest one."""
    if as_of is None:
        latest = transactions.agg(F.max("transaction_date") - F.expr(f"INTERVAL {days} DAYS")).scalar()
        return transactions.where(F.col("transaction_date") >= latest)
    start = F.lit(as_of).cast("timestamp") - F.expr(f"INTERVAL {days} DAYS")
    return transactions.where(F.col("transaction_date") >= start)


def volume_measures() -> list:
    """Count, amount and type counts of one day of transactions."""
    return [
        F.count(F.lit(1)).alias("transaction_count"),
        sum_or_zero(F.col("amount")).alias("total_amount"),
        *[count_of("transaction_type", kind).alias(name) for name, kind in TYPE_COUNTS.items()],
    ]


def dashboard_transactions_by_date(bank: Bank, as_of=None, days: int = VOLUME_DAYS) -> DataFrame:
    """Daily volume of the last days, latest day first."""
    return (
        recent(bank, days, as_of)
        .groupBy(F.date_format("transaction_date", "yyyy-MM-dd").alias("transaction_date"))
        .agg(*volume_measures())
        .orderBy(*descending("transaction_date"))
    )
