"""The bank as three region-partitioned tables, their cross-shard views and their Parquet store."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from regiobank.functions.routing import shard_tag_of
from regiobank.functions.values import cents, money
from regiobank.model import (
    ACCOUNTS,
    ACCOUNTS_ALL,
    ROUTES,
    TRANSACTIONS,
    TRANSACTIONS_ALL,
    USERS,
    USERS_ALL,
)

from regiobank.sources import manifest
from regiobank.sources.extremes import latest_moment, write_extremes
from regiobank.sources.manifest import Manifest, Run
from regiobank.sources.sketches import candidate_files, write_sketches

Table = DataFrame | Callable[[], DataFrame]
SCHEMAS = {"users": USERS, "accounts": ACCOUNTS, "transactions": TRANSACTIONS}


class Bank:
    """Users, accounts and transactions of all shards, each row tagged with shard_location.

    A table may be given as a function; it is called when a query first asks for the table.
    """

    def __init__(self, users: Table, accounts: Table, transactions: Table):
        self._tables = {"users": users, "accounts": accounts, "transactions": transactions}

    def _table(self, name: str) -> DataFrame:
        table = self._tables[name]
        if not isinstance(table, DataFrame):
            table = self._tables[name] = table()
        return table

    @property
    def users(self) -> DataFrame:
        return self._table("users")

    @property
    def accounts(self) -> DataFrame:
        return self._table("accounts")

    @property
    def transactions(self) -> DataFrame:
        return self._table("transactions")

    def holding(self, name: str, keys: DataFrame, column: str) -> DataFrame:
        """Rows of a table among which are all that have one of the values of `column` (on their shard, if `keys` has
        shards). Here that is the whole table."""
        return self._table(name)

    def latest_transaction(self) -> Column | None:
        """The latest transaction date as a literal, where it is known without reading the transactions."""
        return None

    @property
    def users_all(self) -> DataFrame:
        return self.users.select(*USERS_ALL)

    @property
    def accounts_all(self) -> DataFrame:
        """Accounts without account_id, which is only unique within a shard."""
        return self.accounts.select(*ACCOUNTS_ALL)

    @property
    def transactions_all(self) -> DataFrame:
        """Transactions without transaction_id, which is only unique within a shard."""
        return self.transactions.select(*TRANSACTIONS_ALL)


class StoredBank(Bank):
    """The bank of a store, which can tell the files that may hold a key."""

    def __init__(self, spark: SparkSession, root: str, runs: dict[str, list[Run]], **tables: Table):
        super().__init__(**tables)
        self._spark, self._root, self._runs = spark, root, runs

    def holding(self, name: str, keys: DataFrame, column: str) -> DataFrame:
        """Only the files whose sketches answer to a key are read. Balances are those of the files, without changes."""
        files = candidate_files(self._spark, self._root, self._runs[name], keys, column)
        return _read_files(self._spark, self._root, name, files)

    def latest_transaction(self) -> Column | None:
        return latest_moment(self._spark, self._root, self._runs["transactions"])


def union_shards(shards: dict[str, DataFrame]) -> DataFrame:
    """Bag union of per-shard tables, tagged with the shard they come from."""
    tagged = [df.withColumn("shard_location", F.lit(tag)) for tag, df in shards.items()]
    result = tagged[0]
    for df in tagged[1:]:
        result = result.unionByName(df)
    return result


def only_shard(table: DataFrame, tag: str) -> DataFrame:
    """One shard; on the store this reads one partition folder."""
    return table.where(F.col("shard_location") == tag)


def only_region(table: DataFrame, region: str) -> DataFrame:
    """Rows of one region. The shard predicate is implied by routing and lets the store prune folders."""
    return table.where((F.col("region") == region) & (F.col("shard_location") == shard_tag_of(region)))


# Sort order of the files of each table and the columns looked up by value. Sorted files give tight min/max
# statistics and value lookups get Bloom filters; later sort keys split an account with very many rows over files.
LAYOUT = {
    "users": (["user_id"], ["username", "email"]),
    "accounts": (["account_number"], ["account_number", "user_id"]),
    "transactions": (
        ["account_number", "transaction_date", "transaction_id"],
        ["account_number", "from_account_number", "to_account_number", "reference_number"],
    ),
}


#: What postings have added to accounts.
CHANGES = "shard_location string, account_number string, net_cents bigint, applied bigint, as_of timestamp"


def write_run(df: DataFrame, root: str, run: Run, cluster: bool = False) -> Run:
    """Write the rows of a run: one folder per shard, sorted files. It takes a commit to make them part of the store.

    With `cluster` rows are also range-partitioned first: every file then holds its own key range.
    """
    if run.table == "changes":
        df.write.parquet(f"{root}/{run.path}")
        return run
    keys, looked_up = LAYOUT[run.table]
    order = ["shard_location", *keys]
    placed = df.repartitionByRange(*order) if cluster else df
    writer = placed.sortWithinPartitions(*order).write.partitionBy("shard_location")
    for column in looked_up:
        writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true")
    writer.parquet(f"{root}/{run.path}")
    write_sketches(df.sparkSession, root, run)
    write_extremes(df.sparkSession, root, run)
    return run


#: The column that counts rows of a table, and the places that it counts in.
COUNTERS = {
    "users": ("user_id", "region"),
    "accounts": ("account_id", "shard_location"),
    "transactions": ("transaction_id", "shard_location"),
}


def write_bank(bank: Bank, root: str, tables: Iterable[str] = tuple(SCHEMAS)) -> None:
    """Full load of a new store; tables that are not named stay empty. It is there with one commit."""
    spark = bank.users.sparkSession
    runs = [write_run(getattr(bank, name), root, manifest.new_run(name, 0, ((0, 0),)), cluster=True) for name in tables]
    used = _first_counters()
    for run in runs:
        column, place = COUNTERS[run.table]
        rows = _read_runs(spark, root, run.table, [run])
        # a row per region or shard
        highest = rows.groupBy(F.upper(place).alias("place")).agg(F.max(column).alias("highest")).where("place IS NOT NULL").collect()
        used[run.table] |= {row["place"]: max(row["highest"] or 0, used[run.table].get(row["place"], 0)) for row in highest}
    manifest.update(spark, root, lambda last: last._replace(runs=tuple(runs), used=used, reserved={}))


def _first_counters() -> dict[str, dict[str, int]]:
    return {"users": {route.region: route.first_id - 1 for route in ROUTES}, "accounts": {}, "transactions": {}}


def create_bank(spark: SparkSession, root: str) -> Bank:
    """An empty store."""
    manifest.update(spark, root, lambda last: last._replace(runs=(), used=_first_counters(), reserved={}))
    return read_bank(spark, root)


def _read_files(spark: SparkSession, root: str, name: str, paths: list[str]) -> DataFrame:
    schema = {**SCHEMAS, "changes": CHANGES}[name]
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.schema(f"{schema}, run string").option("basePath", f"{root}/{name}").parquet(*paths).drop("run")


def _read_runs(spark: SparkSession, root: str, name: str, runs: list[Run]) -> DataFrame:
    return _read_files(spark, root, name, [f"{root}/{run.path}" for run in runs])


def read_bank(spark: SparkSession, root: str, without: int | None = None, at: Manifest | None = None) -> Bank:
    """The bank of a store as last committed or in the state `at`, on request without what one batch has written.

    A batch that has been merged into a larger run cannot be left out.
    """
    state = at or manifest.load(spark, root)
    runs = {name: state.runs_of(name, without) for name in SCHEMAS}
    tables = {name: _read_runs(spark, root, name, found) for name, found in runs.items()}
    changed = state.runs_of("changes", without)
    if changed:
        tables["accounts"] = apply_changes(tables["accounts"], summed_changes(_read_runs(spark, root, "changes", changed)))
    return StoredBank(spark, root, runs, **tables)


def compact(spark: SparkSession, root: str, fan: int = 8, full: bool = False) -> Manifest:
    """Merge small runs, so that a read opens few files.

    Where a table has `fan` runs of a level, they become one of the next level, with rows in order again and changes
    summed up per account. `full` merges all runs of each table, and the changes into the accounts. Readers go on with the
    runs they have; a batch that comes meanwhile stays, and a batch that is repeated meanwhile wins.
    """
    state = manifest.load(spark, root)
    if full:
        rows = {name: getattr(read_bank(spark, root, at=state), name) for name in SCHEMAS}
        groups = [(name, state.runs_of(name) + (state.runs_of("changes") if name == "accounts" else [])) for name in SCHEMAS]
    else:
        rows, groups = {}, []
        for name in (*SCHEMAS, "changes"):
            runs = state.runs_of(name)
            for level in {run.level for run in runs}:
                group = [run for run in runs if run.level == level]
                if len(group) >= fan:
                    groups.append((name, group))
    for name, group in groups:
        if len(group) < 2:
            continue
        run = manifest.new_run(name, max(old.level for old in group) + 1, manifest.joined(old.batches for old in group))
        merged = rows.get(name) if full else _read_runs(spark, root, name, group)
        write_run(summed_changes(merged) if name == "changes" else merged, root, run, cluster=True)
        try:
            state = manifest.replace(spark, root, group, [run])
        except manifest.Conflict:
            continue
    return state


def summed_changes(changes: DataFrame) -> DataFrame:
    """Changes per account over several batches."""
    return changes.groupBy("shard_location", "account_number").agg(
        F.sum("net_cents").alias("net_cents"), F.sum("applied").alias("applied"), F.max("as_of").alias("as_of")
    )


def apply_changes(accounts: DataFrame, changes: DataFrame) -> DataFrame:
    """Accounts with the net of their changes added; last_updated of touched accounts is that of the change."""
    key = ["shard_location", "account_number"]
    touched = F.col("net_cents").isNotNull()
    balance = F.when(touched, money(cents(F.col("balance")) + F.col("net_cents"))).otherwise(F.col("balance"))
    updated = F.when(touched, F.col("as_of")).otherwise(F.col("last_updated"))
    return (
        accounts.join(changes.select(*key, "net_cents", "as_of"), key, "left")
        .withColumns({"balance": balance, "last_updated": updated})
        .select(*accounts.columns)
    )
