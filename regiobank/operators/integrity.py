"""Row enrichment and integrity rules: every row is judged in one pass and keeps all reasons it fails for."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regiobank.functions.routing import region_bound
from regiobank.functions.values import blank_to_null
from regiobank.model import (
    ACCOUNT_ERRORS,
    ACCOUNT_STATUSES,
    ACCOUNT_TYPES,
    CURRENCY,
    MAX_LENGTHS,
    REGIONS,
    ROUTE_STATUSES,
    TRANSACTION_STATUSES,
    TRANSACTION_TYPES,
    USER_ERRORS,
)
from regiobank.operators.joins import left_lookup, unknown_references
from regiobank.sources.scratch import stage

Rules = list[tuple[str, Column]]


def with_reasons(rows: DataFrame, rules: Rules, codes: dict[str, int] | None = None) -> DataFrame:
    """Add `reasons`, the names of the broken rules in order, and `error_code`, the first numeric code among them."""
    broken = [F.when(condition, F.lit(name)) for name, condition in rules]
    numbered = [F.when(condition, F.lit(codes[name])) for name, condition in rules if codes and name in codes]
    code = F.coalesce(*numbered) if numbered else F.lit(None)
    return rows.withColumns({"reasons": F.array_compact(F.array(*broken)), "error_code": code.cast("int")})


def split(judged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected) of a judged table."""
    accepted = judged.where(F.size("reasons") == 0).drop("reasons", "error_code")
    return accepted, judged.where(F.size("reasons") > 0)


def _outside(column: str, values: tuple[str, ...]) -> Column:
    """A closed value set; NULL passes, as in a CHECK."""
    return ~F.col(column).isin(*values)


def _missing(*columns: str) -> Rules:
    return [(f"null_{c}", F.col(c).isNull()) for c in columns]


def _too_long(table: str, rows: DataFrame) -> Rules:
    return [(f"long_{c}", F.length(c) > n) for c, n in MAX_LENGTHS[table].items() if c in rows.columns]


def blanks_to_null(rows: DataFrame) -> DataFrame:
    """Empty text is NULL in every text column."""
    names = [f.name for f in rows.schema.fields if f.dataType.simpleString() == "string"]
    return rows.withColumns({c: blank_to_null(F.col(c)) for c in names})


def duplicates(rows: DataFrame, key: list[str]) -> DataFrame:
    """Keys that occur more than once, with how often; NULL keys are not compared."""
    present = rows.dropna(subset=key)
    return present.groupBy(*key).agg(F.count(F.lit(1)).alias("copies")).where(F.col("copies") > 1)


def mark_repeats(rows: DataFrame, key: list[str], line: str, name: str) -> DataFrame:
    """Add a flag that is true on every row of a repeated key but the first by `line`.

    Only the repeated keys are kept from the count; written, so that few of them are joined without a shuffle.
    """
    first = (
        rows.dropna(subset=key)
        .groupBy(*key)
        .agg(F.min(line).alias("_first"), F.count(F.lit(1)).alias("_copies"))
        .where(F.col("_copies") > 1)
        .drop("_copies")
    )
    marked = left_lookup(rows, stage(first, "repeats"), key)
    return marked.withColumn(name, F.coalesce(F.col(line) > F.col("_first"), F.lit(False))).drop("_first")


def user_rules(rows: DataFrame) -> Rules:
    known = F.upper("region").isin(*REGIONS)
    low, high = region_bound(F.col("region"), last=False), region_bound(F.col("region"), last=True)
    return [
        ("invalid_region", F.coalesce(~known, F.lit(True))),
        ("id_out_of_range", ~F.col("user_id").between(low, high)),
        ("chk_region", known & _outside("region", REGIONS)),
        *_missing("username", "email"),
        *_too_long("users", rows),
    ]


def validate_users(rows: DataFrame, line: str) -> DataFrame:
    """Judge user rows; a row without user_id is fine, it gets one later."""
    marked = mark_repeats(blanks_to_null(rows), ["user_id"], line, "_repeat")
    rules = [*user_rules(rows), ("duplicate_user_id", F.col("_repeat"))]
    return with_reasons(marked, rules, USER_ERRORS).drop("_repeat")


def enrich_accounts(rows: DataFrame) -> DataFrame:
    """Currency is always the bank's; omitted balance and status take their defaults."""
    return rows.withColumns({"currency": F.lit(CURRENCY), "status": F.coalesce("status", F.lit("ACTIVE"))})


def validate_accounts(rows: DataFrame, users: DataFrame, line: str) -> DataFrame:
    """Judge account rows against the rules of the table and against their owners on the same shard."""
    owners = users.select("user_id", "shard_location", F.col("region").alias("_owner_region"))
    filled = left_lookup(enrich_accounts(blanks_to_null(rows)), owners, ["shard_location", "user_id"])
    marked = mark_repeats(filled, ["shard_location", "account_number"], line, "_repeat")
    marked = mark_repeats(marked, ["shard_location", "account_id"], line, "_repeat_id")
    rules: Rules = [
        ("user_not_found", F.col("_owner_region").isNull()),
        ("region_mismatch", F.upper("region") != F.upper("_owner_region")),
        *_missing("user_id", "account_type", "region"),
        ("chk_account_type", _outside("account_type", ACCOUNT_TYPES)),
        ("chk_balance", F.col("balance") < 0),
        ("chk_status", _outside("status", ACCOUNT_STATUSES)),
        ("chk_region", _outside("region", REGIONS)),
        *_too_long("accounts", rows),
        ("duplicate_account_number", F.col("_repeat")),
        ("duplicate_account_id", F.col("_repeat_id")),
    ]
    return with_reasons(marked, rules, ACCOUNT_ERRORS).drop("_owner_region", "_repeat", "_repeat_id")


def routing_account() -> Column:
    """The account a transaction is routed by: given, or the side its type is booked on."""
    kind = F.col("transaction_type")
    derived = (
        F.when(kind.isin("TRANSFER", "WITHDRAWAL"), F.col("from_account_number"))
        .when(kind == "DEPOSIT", F.col("to_account_number"))
        .otherwise(F.coalesce("from_account_number", "to_account_number"))
    )
    return F.coalesce("account_number", derived)


def derive_routing(rows: DataFrame) -> DataFrame:
    """Fill currency, status and routing account of incoming transactions."""
    return rows.withColumns(
        {
            "currency": F.lit(CURRENCY),
            "status": F.coalesce("status", F.lit("PENDING")),
            "account_number": routing_account(),
        }
    )


def sides_match_type() -> Column:
    kind, source, target = F.col("transaction_type"), F.col("from_account_number"), F.col("to_account_number")
    return (source.isNotNull() & kind.isin("TRANSFER", "WITHDRAWAL")) | (
        target.isNotNull() & kind.isin("TRANSFER", "DEPOSIT")
    )


def _mark_orphans(rows: DataFrame, accounts: DataFrame) -> DataFrame:
    """Add _no_home and _no_source: the routing account or the source does not exist on the row's shard."""
    unknown = unknown_references(
        rows, accounts, "shard_location", ["account_number", "from_account_number"], "account_number"
    )
    homes = unknown.withColumn("_home", F.lit(True))
    sources = unknown.select(
        "shard_location", F.col("account_number").alias("from_account_number"), F.lit(True).alias("_source")
    )
    marked = left_lookup(rows, homes, ["shard_location", "account_number"])
    marked = left_lookup(marked, sources, ["shard_location", "from_account_number"])
    nowhere = F.col("shard_location").isNull()
    return marked.withColumns(
        {
            "_no_home": F.col("account_number").isNotNull() & (nowhere | F.col("_home").isNotNull()),
            "_no_source": F.col("from_account_number").isNotNull() & (nowhere | F.col("_source").isNotNull()),
        }
    ).drop("_home", "_source")


def validate_transactions(rows: DataFrame, accounts: DataFrame) -> DataFrame:
    """Judge transaction rows; the destination may live on another shard and is not looked up."""
    checked = _mark_orphans(derive_routing(blanks_to_null(rows)), accounts)
    rules: Rules = [
        *_missing("account_number", "transaction_type", "amount"),
        ("chk_transaction_type", _outside("transaction_type", TRANSACTION_TYPES)),
        ("chk_amount", F.col("amount") <= 0),
        ("chk_status", _outside("status", TRANSACTION_STATUSES)),
        ("chk_trans_accounts", ~F.coalesce(sides_match_type(), F.lit(True))),
        ("orphan_account", F.col("_no_home")),
        ("orphan_from_account", F.col("_no_source")),
        *_too_long("transactions", rows),
    ]
    return with_reasons(checked, rules).drop("_no_home", "_no_source")


def validate_routing(table: DataFrame) -> DataFrame:
    """Judge routing metadata rows."""
    return with_reasons(
        table,
        [
            *_missing("shard_id", "shard_name", "region", "user_id_range_start", "user_id_range_end"),
            ("chk_shard_region", _outside("region", REGIONS)),
            ("chk_shard_status", _outside("status", ROUTE_STATUSES)),
        ],
    )


def orphan_accounts(accounts: DataFrame, users: DataFrame) -> DataFrame:
    """Accounts whose owner does not exist on their shard. Accounts without an owner are among them, and spread."""
    owners = users.select("shard_location", "user_id", F.lit(True).alias("_owner"))
    return left_lookup(accounts, owners, ["shard_location", "user_id"]).where("_owner IS NULL").drop("_owner")


def orphan_transactions(transactions: DataFrame, accounts: DataFrame) -> DataFrame:
    """Transactions whose routing account or source account does not exist on their shard."""
    marked = _mark_orphans(transactions, accounts)
    lost = F.col("account_number").isNull() | F.col("_no_home") | F.col("_no_source")
    return marked.where(lost).select(*transactions.columns)


def account_number_collisions(accounts: DataFrame) -> DataFrame:
    """Account numbers that more than one row of the whole bank uses."""
    return duplicates(accounts, ["account_number"])
