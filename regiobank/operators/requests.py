"""Posting requests: static checks against the accounts, and the high-volume generator."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regiobank.functions.values import cents
from regiobank.model import POSTING_ERRORS, ROUTES, Route
from regiobank.operators.integrity import blanks_to_null
from regiobank.operators.joins import left_lookup, reference_counts
from regiobank.sources.scratch import stage

# Steps and range of the generated account keys, and the amounts drawn.
SOURCE_STEP, TARGET_STEP, KEY_RANGE = 12345, 54321, 30_000_000
LOWEST_AMOUNT, HIGHEST_AMOUNT = 10, 1000


def account_directory(accounts: DataFrame, routes: Iterable[Route] = ROUTES) -> DataFrame:
    """One row per account number: `home` on the first shard that knows it, and `active`, its active places.

    A place is shard, status, balance in cents and `named`, the number of requests that name the account, which comes
    with the accounts; there is at most one place per shard.
    """
    shown = accounts.select(
        "account_number",
        "shard_location",
        "named",
        F.struct(F.col("shard_location").alias("shard"), "status", cents(F.col("balance")).alias("cents")).alias("place"),
    )
    tags = [r.tag for r in routes]
    per_shard = shown.groupBy("account_number").agg(
        *[F.max(F.when(F.col("shard_location") == tag, F.col("place"))).alias(tag) for tag in tags],
        F.max("named").alias("named"),
    )
    places = F.transform(F.array_compact(F.array(*tags)), lambda place: place.withField("named", F.col("named")))
    return per_shard.select("account_number", places.alias("places")).selectExpr(
        "account_number", "places[0] AS home", "filter(places, p -> p.status = 'ACTIVE') AS active"
    )


# A transfer goes to the active account on the source's shard, else on the first shard that has an active one.
TRANSFER_PLACE = (
    "coalesce(try_element_at(filter(active_to, p -> p.shard = home_from.shard), 1), try_element_at(active_to, 1))"
)
DEBITS, CREDITS = "transaction_type IN ('TRANSFER', 'WITHDRAWAL')", "transaction_type IN ('TRANSFER', 'DEPOSIT')"
# Reasons a request fails for, in the order they are looked at.
CHECKS = {
    "account_not_found": (
        "(from_account_number IS NOT NULL AND home_from IS NULL) OR (to_account_number IS NOT NULL AND home_to IS NULL)"
    ),
    "invalid_type": "transaction_type IS NULL OR transaction_type NOT IN ('TRANSFER', 'DEPOSIT', 'WITHDRAWAL')",
    "missing_side": f"({DEBITS} AND from_account_number IS NULL) OR ({CREDITS} AND to_account_number IS NULL)",
    "self_transfer": "transaction_type = 'TRANSFER' AND from_account_number = to_account_number",
    "source_not_active": "source.status <> 'ACTIVE'",
    "account_not_active": "transaction_type = 'DEPOSIT' AND target.status <> 'ACTIVE'",
    "destination_not_active": "transaction_type = 'TRANSFER' AND target IS NULL",
    "null_state": (
        "(source IS NOT NULL AND (source.status IS NULL OR source.cents IS NULL)) "
        "OR (target IS NOT NULL AND (target.status IS NULL OR target.cents IS NULL))"
    ),
    "chk_amount": "amount IS NULL OR amount <= 0",
}


def validate_requests(requests: DataFrame, accounts: DataFrame, routes: Iterable[Route] = ROUTES) -> DataFrame:
    """Judge requests by everything that does not depend on running balances.

    Adds `reason` (NULL if fine), `error_code`, and source and target: shard, status and opening cents of each side,
    and how many requests name its account.
    """
    given = blanks_to_null(requests)
    named = reference_counts(given, ["from_account_number", "to_account_number"], "account_number", "named")
    # Written, so that few accounts are joined without a shuffle and a busy one can be split.
    directory = stage(account_directory(accounts.join(named, "account_number"), routes), "directory")
    source = directory.selectExpr("account_number AS from_account_number", "home AS home_from")
    target = directory.selectExpr("account_number AS to_account_number", "home AS home_to", "active AS active_to")
    found = left_lookup(given, source, ["from_account_number"])
    found = left_lookup(found, target, ["to_account_number"]).selectExpr(
        *requests.columns,
        "home_from",
        "home_to",
        f"IF({DEBITS}, home_from, NULL) AS source",
        f"CASE transaction_type WHEN 'TRANSFER' THEN {TRANSFER_PLACE} WHEN 'DEPOSIT' THEN home_to END AS target",
    )
    reason = "CASE " + " ".join(f"WHEN {broken} THEN '{name}'" for name, broken in CHECKS.items()) + " END AS reason"
    judged = found.selectExpr(*requests.columns, "source", "target", reason)
    return judged.withColumn("error_code", error_code(F.col("reason")))


def error_code(reason: Column) -> Column:
    codes = F.create_map(*[F.lit(v) for pair in POSTING_ERRORS.items() for v in pair])
    return codes[reason].cast("int")


def generate_requests(numbers: DataFrame, amount: Column | None = None, seed: int = 7) -> DataFrame:
    """One request per number i: keys step through the id range, types rotate, every second one has a source.

    Amounts are random but repeat with the seed unless an amount column is given.
    """
    i = F.col("i")
    kind = F.when(i % 3 == 0, "DEPOSIT").when(i % 3 == 1, "WITHDRAWAL").otherwise("TRANSFER")
    source = F.concat(F.lit("ACC-"), (i * SOURCE_STEP % KEY_RANGE + 1).cast("string"))
    target = F.concat(F.lit("ACC-"), ((i + 1) * TARGET_STEP % KEY_RANGE + 1).cast("string"))
    if amount is None:
        amount = F.rand(seed) * (HIGHEST_AMOUNT - LOWEST_AMOUNT) + LOWEST_AMOUNT
    return numbers.select(
        i.cast("bigint").alias("seq"),
        kind.alias("transaction_type"),
        F.when(i % 2 == 0, source).alias("from_account_number"),
        target.alias("to_account_number"),
        amount.cast("decimal(15,2)").alias("amount"),
        F.concat(F.lit("Batch transaction "), i.cast("string")).alias("description"),
    )
