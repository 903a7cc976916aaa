"""Batches of new users, accounts and transactions: validate, number, route, append."""

from __future__ import annotations

from collections.abc import Callable
from typing import TypeVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regiobank.functions.routing import user_shard
from regiobank.operators.integrity import (
    blanks_to_null,
    derive_routing,
    split,
    validate_accounts,
    validate_transactions,
    validate_users,
    with_reasons,
)
from regiobank.operators.joins import left_lookup
from regiobank.operators.ledger import Posting, post_ledger, records_of
from regiobank.operators.lookups import lookup, user_region
from regiobank.operators.numbering import Reserve, assign_account_ids, assign_transaction_ids, assign_user_ids
from regiobank.sources import manifest
from regiobank.sources.bank import SCHEMAS, Bank, read_bank, write_run
from regiobank.sources.manifest import Manifest
from regiobank.sources.scratch import stage

T = TypeVar("T")


def table_columns(name: str) -> list[str]:
    return [part.split()[0] for part in SCHEMAS[name].split(", ")]


def _dated(rows: DataFrame, as_of) -> DataFrame:
    moment = F.lit(as_of).cast("timestamp")
    return rows.withColumns({"created_date": moment, "last_updated": moment})


def _asked(bank: Bank, name: str, rows: DataFrame, key: list[str]) -> DataFrame:
    """The stored keys that a batch holds, too; a batch is small beside the store, and a store reads few files for it."""
    wanted = stage(rows.dropna(subset=key).select(*key).distinct(), "asked-keys")
    stored = bank.holding(name, wanted, key[-1])
    return stored.select(*key).join(wanted, key, "left_semi").distinct().withColumn("_stored", F.lit(True))


def new_users(requests: DataFrame, bank: Bank, line: str, as_of, reserve: Reserve | None = None) -> tuple[DataFrame, DataFrame]:
    """(users ready to append, rejected requests); regions are taken in any letter case."""
    asked = requests.withColumn("region", F.upper("region"))
    accepted, rejected = split(stage(validate_users(asked, line), "judged-users"))
    taken = left_lookup(accepted, _asked(bank, "users", accepted, ["user_id"]), ["user_id"])
    clash = with_reasons(taken, [("duplicate_user_id", F.col("_stored").isNotNull())]).drop("_stored")
    accepted, clashing = split(stage(clash, "clashing-users"))
    numbered = assign_user_ids(accepted, bank.users, line, reserve)
    users = _dated(numbered.withColumn("shard_location", user_shard(F.col("user_id"))), as_of)
    return users.select(line, *table_columns("users")), rejected.unionByName(clashing)


def new_accounts(requests: DataFrame, bank: Bank, line: str, as_of, reserve: Reserve | None = None) -> tuple[DataFrame, DataFrame]:
    """(accounts ready to append, rejected requests); region and shard are those of the owner.

    An account id or number may be used once per shard, in the batch and in the store together.
    """
    asked = blanks_to_null(requests).drop("shard_location", "region")
    wanted = stage(asked.select("user_id").dropna().distinct(), "asked-owners")
    owners = stage(bank.holding("users", wanted, "user_id").join(wanted, "user_id", "left_semi").select(*bank.users.columns), "owners")
    placed = user_region(asked, Bank(owners, lambda: bank.accounts, lambda: bank.transactions)).withColumn("shard_location", user_shard(F.col("user_id")))
    opened = placed.withColumn("balance", F.coalesce("balance", F.lit(0).cast("decimal(15,2)")))
    accepted, rejected = split(stage(validate_accounts(opened, owners, line), "judged-accounts"))
    known = left_lookup(accepted, _asked(bank, "accounts", accepted, ["shard_location", "account_id"]), ["shard_location", "account_id"])
    known = with_reasons(known, [("duplicate_account_id", F.col("_stored").isNotNull())]).drop("_stored")
    accepted, reused = split(stage(known, "known-accounts"))
    # Numbers are made from ids, so they are known only now; a number in use on the shard is rejected.
    numbered = stage(assign_account_ids(accepted, bank.accounts, line, reserve), "numbered-accounts")
    key = ["shard_location", "account_number"]
    own = numbered.groupBy(*key).agg(F.min(line).alias("_first"))
    compared = numbered.join(_asked(bank, "accounts", numbered, key), key, "left").join(own, key, "left")
    taken = F.col("_stored").isNotNull() | (F.col(line) > F.col("_first"))
    accepted, clashing = split(with_reasons(compared, [("duplicate_account_number", taken)]).drop("_stored", "_first"))
    columns = rejected.columns
    return (
        _dated(accepted, as_of).select(line, *table_columns("accounts")),
        rejected.unionByName(reused.select(*columns)).unionByName(clashing.select(*columns)),
    )


def new_transactions(requests: DataFrame, bank: Bank, line: str, as_of, reserve: Reserve | None = None) -> tuple[DataFrame, DataFrame]:
    """(transactions ready to append, rejected requests); they go to the shard of their routing account."""
    routed = derive_routing(blanks_to_null(requests).drop("shard_location"))
    homes = bank.accounts.select("account_number", "shard_location")
    placed = lookup(routed, homes, "account_number", "shard_location")
    accepted, rejected = split(validate_transactions(placed, bank.accounts))
    moment = F.coalesce("transaction_date", F.lit(as_of).cast("timestamp"))
    numbered = assign_transaction_ids(accepted.withColumn("transaction_date", moment), bank.transactions, line, reserve)
    return numbered.select(line, *table_columns("transactions")), rejected


def _registry(requests: DataFrame, root: str, batch: int) -> Reserve:
    """Ids for a batch from the registry of a store."""
    return lambda table, asked, given: manifest.reserve(requests.sparkSession, root, table, batch, asked, given)


def _write_batch(spark: SparkSession, root: str, batch: int, against: tuple[str, ...], judge: Callable[[Manifest], tuple[dict[str, DataFrame], T]]) -> T:
    """Write what `judge` makes of the last state of a store: rows per table, and a result. All tables are there with one
    commit; if another batch has changed what this one was judged by, it is judged anew."""
    if batch < 1:
        raise ValueError("batches count from 1; 0 is the full load")
    while True:
        seen = manifest.load(spark, root)
        tables, result = judge(seen)
        runs = [write_run(rows, root, manifest.new_run(name, 0, ((batch, batch),))) for name, rows in tables.items()]
        try:
            manifest.commit(spark, root, batch, runs, seen, against)
        except manifest.Conflict:
            continue
        return result


def _append(made: Callable[..., tuple[DataFrame, DataFrame]], name: str, against: tuple[str, ...]) -> Callable[..., DataFrame]:
    def append(requests: DataFrame, root: str, line: str, as_of, batch: int) -> DataFrame:
        """Append what is accepted to the store as one batch; returns the rejected requests.

        A batch is judged and numbered without what it has written itself, and replaces that: a repeat changes nothing.
        """
        spark = requests.sparkSession

        def judge(seen: Manifest) -> tuple[dict[str, DataFrame], DataFrame]:
            rows, rejected = made(requests, read_bank(spark, root, batch, seen), line, as_of, _registry(requests, root, batch))
            return {name: stage(rows.drop(line), f"new-{name}")}, stage(rejected, f"rejected-{name}")

        return _write_batch(spark, root, batch, against, judge)

    return append


append_users = _append(new_users, "users", ("users",))
append_accounts = _append(new_accounts, "accounts", ("accounts",))
# accounts never go, so what was accepted stays right
append_transactions = _append(new_transactions, "transactions", ())


def save_posting(requests: DataFrame, root: str, as_of, batch: int, **sizes) -> Posting:
    """Post requests against the store and save the records, numbered, and the changes of the accounts, with one commit.

    As with the other batches a repeat replaces what the batch has written, from the accounts as they were before it. If
    another posting was faster, the requests are posted against its balances.
    """
    spark = requests.sparkSession

    def judge(seen: Manifest) -> tuple[dict[str, DataFrame], Posting]:
        bank = read_bank(spark, root, batch, seen)
        posting = post_ledger(bank.accounts, requests, as_of, **sizes)
        reserve = _registry(requests, root, batch)
        # numbered by place, so that the requests are not sorted a second time by all their columns
        numbered = assign_transaction_ids(records_of(posting.placed, as_of, "place"), bank.transactions, "place", reserve)
        return {"transactions": numbered.select(*table_columns("transactions")), "changes": posting.changes}, posting

    return _write_batch(spark, root, batch, ("changes",), judge)
