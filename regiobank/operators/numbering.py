"""Consecutive numbers and ids without a single-task window."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from regiobank.functions.routing import region_bound
from regiobank.sources.scratch import stage

SLOT_BITS = 33


def number_rows(df: DataFrame, by: list[str], order: list[str]) -> DataFrame:
    """Add `position`, the 0-based place of a row within its group.

    Rows are range-partitioned and sorted by (group, order), so a large group spreads over many tasks. Each row
    keeps its slot in its task; the number of rows in earlier tasks, one value per task and group, is added to it.
    Sorted rows are written once, because range boundaries are sampled anew on every run; the offsets are written,
    so that Spark knows how few they are.
    """
    keys = [F.col(c) for c in [*by, *order]]
    staged = stage(
        df.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("_slot", F.monotonically_increasing_id()),
        "numbered",
    ).withColumn("_task", F.shiftright("_slot", SLOT_BITS))
    per_task = staged.groupBy("_task", *by).agg(F.count(F.lit(1)).alias("_rows"), F.min("_slot").alias("_first"))
    earlier = Window.partitionBy(*by).orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    starts = per_task.select(
        F.col("_task").alias("_at"),
        *[F.col(name).alias(f"_by_{name}") for name in by],
        "_first",
        F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_start"),
    )
    matched = F.col("_task") == F.col("_at")
    for name in by:
        matched = matched & F.col(name).eqNullSafe(F.col(f"_by_{name}"))
    position = F.col("_start") + F.col("_slot") - F.col("_first")
    return staged.join(stage(starts, "offsets"), matched).select(*df.columns, position.alias("position"))


#: How a batch gets its ids from a registry: (table, number of ids per place, highest given id per place) -> first ids.
Reserve = Callable[[str, dict[str, int], dict[str, int]], dict[str, int]]


def _per_place(rows: DataFrame, place: str, value: Column) -> dict[str, int]:
    """One number per region or shard, of which there are few."""
    found = rows.groupBy(place).agg(value.alias("value")).where(F.col(place).isNotNull() & F.col("value").isNotNull()).collect()
    return {row[place]: row["value"] for row in found}


def _reserved(reserve: Reserve, table: str, given: DataFrame, numbered: DataFrame, place: str, column: str) -> Column:
    """The first id for rows of a place."""
    asked = _per_place(numbered, place, F.count(F.lit(1)))
    first = reserve(table, asked, _per_place(given, place, F.max(column)))
    found = F.lit(None).cast("bigint")
    for name, start in first.items():
        found = F.when(F.col(place) == name, F.lit(start).cast("bigint")).otherwise(found)
    return found


def assign_user_ids(requests: DataFrame, users: DataFrame, key: str, reserve: Reserve | None = None) -> DataFrame:
    """Give rows without user_id the next ids of their region, in key order.

    Ids go on after the highest one in use by stored users or by the rows that bring their own; with `reserve` they come
    from the registry and stored users are not read. A full range is an error. Regions must be known.
    """
    region = F.upper("region").alias("region")
    given = requests.where(F.col("user_id").isNotNull()).withColumn("region", region)
    missing = requests.where(F.col("user_id").isNull()).withColumn("region", F.upper("region")).drop("user_id")
    numbered = number_rows(missing, by=["region"], order=[key])
    first, last = region_bound(F.col("region"), last=False), region_bound(F.col("region"), last=True)
    if reserve:
        start = _reserved(reserve, "users", given, numbered, "region", "user_id")
    else:
        used = (
            users.select("user_id", region)
            .unionByName(given.select("user_id", "region"))
            .groupBy("region")
            .agg(F.max("user_id").alias("last_used"))
        )
        numbered = numbered.join(stage(used, "used-ids"), "region", "left")
        start = F.greatest(F.coalesce(F.col("last_used") + 1, first), first)
    numbered = numbered.withColumn("user_id", _within(start + F.col("position"), last, "user ids"))
    return given.unionByName(numbered.select(*requests.columns))


def _continue_ids(rows: DataFrame, stored: DataFrame, table: str, column: str, key: str, reserve: Reserve | None) -> DataFrame:
    """Give rows without an id the next ids of their shard, after those stored and those the rows bring."""
    given = rows.where(F.col(column).isNotNull())
    missing = rows.where(F.col(column).isNull()).drop(column)
    numbered = number_rows(missing, by=["shard_location"], order=[key])
    if reserve:
        start = _reserved(reserve, table, given, numbered, "shard_location", column)
    else:
        used = (
            stored.select(column, "shard_location")
            .unionByName(given.select(column, "shard_location"))
            .groupBy("shard_location")
            .agg(F.max(column).alias("last_used"))
        )
        numbered = numbered.join(stage(used, "used-ids"), "shard_location", "left")
        start = F.coalesce("last_used", F.lit(0)) + 1
    return given.unionByName(numbered.withColumn(column, start + F.col("position")).select(*rows.columns))


def assign_account_ids(requests: DataFrame, accounts: DataFrame, key: str, reserve: Reserve | None = None) -> DataFrame:
    """Give rows without account_id the next ids of their shard, and rows without a number the number ACC-<id>."""
    numbered = _continue_ids(requests, accounts, "accounts", "account_id", key, reserve)
    return numbered.withColumn("account_number", F.coalesce("account_number", default_number(F.col("account_id"))))


def assign_transaction_ids(requests: DataFrame, transactions: DataFrame, key: str, reserve: Reserve | None = None) -> DataFrame:
    """Give transactions the next ids of their shard."""
    rows = requests.withColumn("transaction_id", F.lit(None).cast("bigint"))
    return _continue_ids(rows, transactions, "transactions", "transaction_id", key, reserve)


def default_number(account_id: Column) -> Column:
    return F.concat(F.lit("ACC-"), account_id.cast("string"))


def _within(value: Column, last: Column, what: str) -> Column:
    full = F.raise_error(F.concat(F.lit(f"no {what} left in region "), F.col("region"))).cast("bigint")
    return F.when(value <= last, value).otherwise(full)
