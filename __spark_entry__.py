"""Registered queries: name -> (spark, folder of the Parquet tables) -> DataFrame, and their SQL counterparts."""

from __future__ import annotations

import os
import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import oracles  # noqa: E402
from regiobank.functions import routing  # noqa: E402
from regiobank.operators import integrity, lookups, numbering, onboarding  # noqa: E402
from regiobank.operators.ledger import Posting, post_ledger  # noqa: E402
from regiobank.operators.requests import generate_requests, validate_requests  # noqa: E402
from regiobank.plans import dashboard, reports  # noqa: E402
from regiobank.sources import orderbook  # noqa: E402
from regiobank.plans.catalog import register_views  # noqa: E402
from regiobank.sources.bank import Bank, compact, only_shard, read_bank, write_bank  # noqa: E402
from regiobank.sources.formatting import format_account_count, format_balance, format_result  # noqa: E402
from regiobank.sources.scratch import scratch_path  # noqa: E402
from regiobank.streaming import corrections, live, posting  # noqa: E402

try:  # the folder, or a library that only it needs, may be missing
    import corpus_pipeline
    from regiobank.llm import queries as corpus
except ImportError:
    corpus = None

Query = Callable[[SparkSession, str], DataFrame]

AS_OF = "2024-01-01 00:00:00"
SMOKE_FOLDER = "/root/testdata/sf0.001"


def _shown(df: DataFrame) -> DataFrame:
    """Result as clients get it, with whole numbers kept whole."""
    return format_result(df, counts_as_double=False)


def _on_bank(plan: Callable[..., DataFrame], *args) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return _shown(plan(orderbook.load_bank(spark, folder), *args))

    return query


def _on_tables(plan: Callable[[SparkSession, str], DataFrame]) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return _shown(plan(spark, folder))

    return query


def _judgement(judged: DataFrame, *columns: str) -> DataFrame:
    return judged.withColumn("reasons", F.concat_ws(",", "reasons")).select("line", "reasons", *columns)


def _formatted(spark: SparkSession, folder: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    bank = orderbook.load_bank(spark, folder)
    owned = bank.accounts.groupBy("user_id").agg(F.count(F.lit(1)).alias("owned"))
    accounts = bank.accounts.select("user_id", "account_number", "balance")
    rows = bank.users.join(owned, "user_id", "left").join(accounts, "user_id", "left")
    shown = rows.select(
        F.col("user_id").alias("USER_ID"),
        F.col("account_number").alias("Account_Number"),
        "balance",
        "created_date",
        format_balance(F.col("balance")).alias("shown_balance"),
        format_account_count(F.col("owned")).alias("shown_count"),
    )
    return format_result(shown)


# ---- routing and batch lookups ----


def _lookup(plan: Callable[[DataFrame, Bank], DataFrame]) -> Query:
    return _on_tables(lambda spark, folder: plan(orderbook.transfer_targets(spark, folder), orderbook.load_bank(spark, folder)))


def _user_lookup(plan: Callable[[DataFrame, Bank], DataFrame], *keys: str) -> Query:
    return _on_tables(
        lambda spark, folder: plan(orderbook.user_feed(spark, folder).select(*keys), orderbook.load_bank(spark, folder))
    )


def _user_route(column: Callable[..., object]) -> Query:
    return _on_tables(lambda spark, folder: orderbook.user_feed(spark, folder).select("line", column()))


def _route_regions(spark: SparkSession, folder: str) -> DataFrame:
    region = F.col("region")
    return orderbook.user_feed(spark, folder).select(
        "line", "region", routing.region_shard_id(region).alias("shard_id"), routing.region_shard(region).alias("shard")
    )


def _routing_usage(spark: SparkSession, folder: str) -> DataFrame:
    used = orderbook.users(spark, folder).groupBy(routing.user_shard_id(F.col("user_id")).alias("shard_id"))
    view = routing.routing_view(routing.routing_table(spark))
    counted = view.join(used.agg(F.count(F.lit(1)).alias("used_ids")), "shard_id", "left")
    return counted.withColumn("used_ids", F.coalesce("used_ids", F.lit(0))).orderBy("shard_id")


# ---- ids and integrity ----


def _assigned_users(spark: SparkSession, folder: str) -> DataFrame:
    feed = orderbook.user_feed(spark, folder).withColumn("region", F.upper("region"))
    accepted, _ = integrity.split(integrity.validate_users(feed, "line"))
    nobody = spark.createDataFrame([], "user_id bigint, region string")
    return numbering.assign_user_ids(accepted, nobody, "line").select("line", "user_id", "region")


def _store(spark: SparkSession, folder: str, *tables: str) -> str:
    """Tables of the bank as a new store."""
    root = scratch_path(spark, "store")
    write_bank(orderbook.load_bank(spark, folder), root, tables)
    return root


def _of_batch(table: DataFrame, column: str = "created_date") -> DataFrame:
    return table.where(F.col(column) == F.lit(AS_OF).cast("timestamp"))


def _appended_users(spark: SparkSession, folder: str) -> DataFrame:
    """Appended to a store and read back."""
    feed, root = orderbook.user_feed(spark, folder).drop("shard_location"), _store(spark, folder, "users")
    onboarding.append_users(feed, root, "line", AS_OF, batch=1)
    users = _of_batch(read_bank(spark, root).users)
    return users.select("user_id", "username", "email", "region", "created_date", "shard_location")


def _assigned_accounts(spark: SparkSession, folder: str) -> DataFrame:
    feed = orderbook.account_feed(spark, folder)
    numbered = numbering.assign_account_ids(feed, orderbook.accounts(spark, folder), "line")
    return numbered.select("line", "account_id", "account_number", "shard_location")


def _appended_accounts(spark: SparkSession, folder: str) -> DataFrame:
    feed = orderbook.account_feed(spark, folder).select(
        "line",
        "user_id",
        "account_type",
        "balance",
        F.lit(None).cast("bigint").alias("account_id"),
        F.lit(None).cast("string").alias("account_number"),
        F.lit(None).cast("string").alias("status"),
    )
    root = _store(spark, folder, "users", "accounts")
    onboarding.append_accounts(feed, root, "line", AS_OF, batch=1)
    return _of_batch(read_bank(spark, root).accounts).drop("last_updated")


def _validated_users(spark: SparkSession, folder: str) -> DataFrame:
    return _judgement(integrity.validate_users(orderbook.user_feed(spark, folder), "line"), "error_code")


def _validated_accounts(spark: SparkSession, folder: str) -> DataFrame:
    judged = integrity.validate_accounts(orderbook.account_feed(spark, folder), orderbook.users(spark, folder), "line")
    return _judgement(judged, "error_code", "currency", "status")


def _validated_transactions(spark: SparkSession, folder: str) -> DataFrame:
    feed = orderbook.transaction_feed(spark, folder)
    return _judgement(integrity.validate_transactions(feed, orderbook.accounts(spark, folder)))


def _derived_routing(spark: SparkSession, folder: str) -> DataFrame:
    return integrity.derive_routing(orderbook.transaction_feed(spark, folder)).select(
        "line", "account_number", "currency", "status"
    )


def _orphan_accounts(spark: SparkSession, folder: str) -> DataFrame:
    feed = orderbook.account_feed(spark, folder).select("line", "user_id", "account_number", "shard_location")
    return integrity.orphan_accounts(feed, orderbook.users(spark, folder))


def _orphan_transactions(spark: SparkSession, folder: str) -> DataFrame:
    rows = orderbook.raw_transactions(spark, folder).select(
        "transaction_id", "account_number", "from_account_number", "shard_location"
    )
    return integrity.orphan_transactions(rows, orderbook.accounts(spark, folder))


def _duplicates(feed: Callable[[SparkSession, str], DataFrame], key: list[str]) -> Query:
    return _on_tables(lambda spark, folder: integrity.duplicates(feed(spark, folder), key))


# ---- posting ----


def _posting(spark: SparkSession, folder: str) -> Posting:
    requests = orderbook.ledger_requests(orderbook.order_batch(spark, folder))
    return post_ledger(orderbook.accounts(spark, folder), requests, AS_OF)


def _posted(spark: SparkSession, folder: str) -> DataFrame:
    return _posting(spark, folder).requests.select("seq", "status", "reason", "error_code")


def _posted_accounts(spark: SparkSession, folder: str) -> DataFrame:
    return _posting(spark, folder).accounts.select("account_number", "shard_location", "balance", "last_updated")


def _saved(spark: SparkSession, folder: str) -> Bank:
    """The store after a posting that was saved."""
    root = _store(spark, folder, "accounts", "transactions")
    requests = orderbook.ledger_requests(orderbook.order_batch(spark, folder))
    onboarding.save_posting(requests, root, AS_OF, batch=1)
    return read_bank(spark, root)


def _saved_accounts(spark: SparkSession, folder: str) -> DataFrame:
    return _saved(spark, folder).accounts.select("account_number", "shard_location", "balance", "last_updated")


def _saved_records(spark: SparkSession, folder: str) -> DataFrame:
    return _of_batch(_saved(spark, folder).transactions, "transaction_date")


def _saved_in_batches(spark: SparkSession, folder: str) -> DataFrame:
    """Balances of a store after several saved postings, merged into its accounts."""
    root = _store(spark, folder, "accounts", "transactions")
    requests = orderbook.ledger_requests(orderbook.order_batch(spark, folder))
    # orders come in the order of their keys, so a third of the range of keys comes before the next one
    low, high = requests.agg(F.min("seq"), F.max("seq")).first()
    third = ((high or 0) - (low or 0)) // 3 + 1
    for part in range(3):
        later = F.coalesce((F.col("seq") - F.lit(low)) / third, F.lit(0))
        onboarding.save_posting(requests.where(F.floor(later) == part), root, AS_OF, batch=part + 1)
    compact(spark, root, full=True)
    return read_bank(spark, root).accounts.select("account_number", "shard_location", "balance", "last_updated")


def _on_store(plan: Callable[[Bank], DataFrame], *tables: str) -> Query:
    return _on_tables(lambda spark, folder: plan(read_bank(spark, _store(spark, folder, *tables))))


def _sql_functions(spark: SparkSession, folder: str) -> DataFrame:
    register_views(spark, orderbook.load_bank(spark, folder))
    orderbook.user_feed(spark, folder).createOrReplaceTempView("asked_users")
    return spark.sql(
        "SELECT line, get_user_shard(user_id) AS shard, get_shard_for_user(user_id) AS shard_id, "
        "get_shard_for_region(region) AS region_shard_id FROM asked_users"
    )


def _sql_balances(spark: SparkSession, folder: str) -> DataFrame:
    register_views(spark, orderbook.load_bank(spark, folder))
    orderbook.transfer_targets(spark, folder).createOrReplaceTempView("asked_accounts")
    return spark.sql("SELECT account_number, get_account_balance(account_number) AS balance FROM asked_accounts")


def _sql_region(spark: SparkSession, folder: str) -> DataFrame:
    register_views(spark, read_bank(spark, _store(spark, folder, "users", "accounts", "transactions")))
    return spark.sql("SELECT * FROM accounts_all WHERE region = 'EU'")


def _posted_tight(spark: SparkSession, folder: str) -> DataFrame:
    """Balances of a hundredth, so that failures follow from failures, in small blocks and several tasks."""
    accounts = orderbook.accounts(spark, folder)
    little = accounts.withColumn("balance", F.expr("CAST(floor(balance) / 100 AS DECIMAL(15,2))"))
    requests = orderbook.ledger_requests(orderbook.order_batch(spark, folder))
    found = post_ledger(little, requests, AS_OF, block_rows=4096, tasks=6)
    return found.requests.select("seq", "status", "reason", "error_code")


def _validated_requests(spark: SparkSession, folder: str) -> DataFrame:
    judged = validate_requests(orderbook.faulty_requests(spark, folder), orderbook.accounts(spark, folder))
    return judged.select("seq", "reason", "error_code")


def _generated_requests(spark: SparkSession, folder: str) -> DataFrame:
    orders = orderbook.order_batch(spark, folder)
    numbers = orders.select((F.col("o_orderkey") + 1).alias("i"), "o_totalprice")
    drawn = (F.col("o_totalprice").cast("decimal(15,2)") * 100).cast("bigint") % 99001 + 1000
    return generate_requests(numbers, amount=drawn.cast("decimal(15,0)") / 100)


# ---- streams ----


def _events(spark: SparkSession, folder: str) -> DataFrame:
    """The events as a stream of several micro-batches."""
    path = orderbook.in_files(orderbook.events(spark, folder), "event_id", scratch_path(spark, "events"))
    return orderbook.event_stream(spark, path)


def _stream_by_day(spark: SparkSession, folder: str) -> DataFrame:
    out = scratch_path(spark, "tx-by-day")
    stream = live.daily_volume(_events(spark, folder))
    live.run_append(stream, out, scratch_path(spark, "checkpoint"))
    return spark.read.schema(stream.schema).parquet(out)


def _stream_regions(spark: SparkSession, folder: str) -> DataFrame:
    out = scratch_path(spark, "live-regions")
    stream = orderbook.on_shards(_events(spark, folder), spark, folder)
    live.run_regional_totals(stream, orderbook.accounts(spark, folder), out, scratch_path(spark, "checkpoint"))
    return live.live_regional_totals(spark, out)


def _stream_overall(spark: SparkSession, folder: str) -> DataFrame:
    out = scratch_path(spark, "live-totals")
    live.run_complete(live.overall_totals(_events(spark, folder)), out, scratch_path(spark, "checkpoint"))
    return live.latest_totals(spark, out)


def _stream_corrected(spark: SparkSession, folder: str) -> DataFrame:
    """Days of a feed that repeats rows and brings some after their day was closed."""
    root = scratch_path(spark, "corrected-days")
    path = orderbook.repeated_and_late(orderbook.events(spark, folder), "event_id", scratch_path(spark, "events"))
    corrections.run_volumes(orderbook.event_stream(spark, path), root, scratch_path(spark, "checkpoint"))
    return corrections.corrected_days(spark, root)


def _batch_moment(batch: int) -> str:
    return f"2024-01-{batch + 1:02d} 00:00:00"


def _stream_posting(spark: SparkSession, folder: str) -> DataFrame:
    root = scratch_path(spark, "posted")
    path = orderbook.in_files(orderbook.order_batch(spark, folder), "o_orderkey", scratch_path(spark, "orders"))
    requests = orderbook.ledger_requests(orderbook.order_stream(spark, path))
    accounts = orderbook.accounts(spark, folder)
    posting.run_posting(requests, accounts, root, scratch_path(spark, "checkpoint"), _batch_moment, snapshot_every=2)
    return posting.current_accounts(accounts, root).select("account_number", "shard_location", "balance", "last_updated")


def entry(spark: SparkSession) -> DataFrame:
    """Flagship query: users, accounts, balances and transactions per region."""
    return queries()["dashboard_regional_stats"](spark, SMOKE_FOLDER)


def queries() -> dict[str, Query]:
    """Every registered query: those of the bank, and those over documents if that folder is there."""
    return bank_queries() | (corpus.queries() | {"pipeline": corpus_pipeline.run} if corpus else {})


def oracle_sql() -> dict[str, str]:
    return oracles.oracle_sql() | (corpus.oracle_sql() if corpus else {})


def bank_queries() -> dict[str, Query]:
    return {
        # scans and cross-shard tables
        "users_all": _on_bank(lambda bank: bank.users_all),
        "accounts_all": _on_bank(lambda bank: bank.accounts_all),
        "transactions_all": _on_bank(lambda bank: bank.transactions_all),
        "shard_scan": _on_bank(lambda bank: only_shard(bank.accounts, "SHARD2")),
        "format_result": _formatted,
        # filters and lookups of one key
        "users_by_region": _on_bank(reports.users_by_region, "NA"),
        "accounts_by_region_filter": _on_bank(reports.accounts_by_region, "NA"),
        "accounts_over_balance": _on_bank(reports.accounts_over_balance, 10000),
        "find_user": _on_bank(reports.find_user, "Customer#000000042"),
        "account_lookup": _on_bank(reports.account_lookup, "ACC-1"),
        "account_history": _on_bank(reports.account_history, "ACC-1"),
        "user_accounts": _on_bank(reports.user_accounts),
        # joins and directories
        "account_summary_all": _on_bank(dashboard.account_summary_all),
        "account_summary_by_balance": _on_bank(reports.account_summary_by_balance),
        "account_summary": _on_bank(reports.account_summary),
        "account_summary_exact": _on_bank(reports.account_summary, True),
        "accounts_list": _on_bank(reports.accounts_list),
        "users_list": _on_bank(reports.users_list),
        "users_directory": _on_bank(reports.users_directory),
        "accounts_directory": _on_bank(reports.accounts_directory),
        "users_dropdown": _on_bank(reports.users_dropdown),
        # statistics
        "regional_stats": _on_bank(dashboard.regional_stats),
        "regional_stats_exact": _on_bank(dashboard.regional_stats_exact),
        "transaction_stats_by_region": _on_bank(dashboard.transaction_stats_by_region),
        "dashboard_regional_stats": _on_bank(dashboard.dashboard_regional_stats),
        "dashboard_overall_stats": _on_bank(dashboard.dashboard_overall_stats),
        "dashboard_recent_transactions": _on_bank(dashboard.dashboard_recent_transactions),
        "dashboard_accounts_by_region": _on_bank(dashboard.dashboard_accounts_by_region),
        "tx_by_date": _on_bank(dashboard.dashboard_transactions_by_date),
        "realtime_analytics": _on_bank(reports.realtime_analytics),
        "users_per_shard": _on_bank(reports.users_per_shard),
        "users_per_shard_pages": _on_bank(reports.users_per_shard, 100),
        "accounts_by_region_shard": _on_bank(reports.accounts_by_region_shard),
        "tx_by_shard_type": _on_bank(reports.transactions_by_shard_type),
        "balance_bands": _on_bank(reports.balance_bands),
        "region_aggregate": _on_bank(reports.region_aggregate),
        "tx_distribution": _on_bank(reports.transaction_distribution),
        "tx_summary": _on_bank(reports.transaction_summary),
        "account_count": _on_bank(reports.account_count),
        "accounts_per_region": _on_bank(reports.accounts_per_region),
        "regional_share": _on_bank(reports.regional_share),
        "first_accounts": _on_bank(reports.first_accounts),
        "balance_check": _on_bank(reports.balance_check),
        "tx_by_date_stored": _on_store(dashboard.dashboard_transactions_by_date, "transactions"),
        "realtime_analytics_stored": _on_store(reports.realtime_analytics, "transactions"),
        # routing and batch lookups
        "get_user_shard": _user_route(lambda: routing.user_shard(F.col("user_id")).alias("shard")),
        "route_users": _user_route(lambda: routing.user_shard_id(F.col("user_id")).alias("shard_id")),
        "route_regions": _on_tables(_route_regions),
        "shard_routing_usage": _on_tables(_routing_usage),
        "balances_for": _lookup(lookups.balances_for),
        "account_info": _lookup(lookups.account_info),
        "account_region": _lookup(lookups.account_region),
        "account_id_lookup": _lookup(lookups.account_ids),
        "user_region": _user_lookup(lookups.user_region, "line", "user_id"),
        "find_user_shard": _user_lookup(lookups.find_users, "line", "username"),
        # ids and integrity
        "assign_user_ids": _on_tables(_assigned_users),
        "assign_account_ids": _on_tables(_assigned_accounts),
        "append_users": _on_tables(_appended_users),
        "append_accounts": _on_tables(_appended_accounts),
        "validate_users": _on_tables(_validated_users),
        "validate_accounts": _on_tables(_validated_accounts),
        "validate_transactions": _on_tables(_validated_transactions),
        "derive_routing": _on_tables(_derived_routing),
        "orphan_accounts": _on_tables(_orphan_accounts),
        "orphan_transactions": _on_tables(_orphan_transactions),
        "dup_users": _duplicates(orderbook.user_feed, ["user_id"]),
        "dup_accounts": _duplicates(orderbook.account_feed, ["shard_location", "account_number"]),
        "dup_accounts_global": _duplicates(orderbook.account_feed, ["account_number"]),
        # posting
        "validate_requests": _on_tables(_validated_requests),
        "generate_requests": _on_tables(_generated_requests),
        "post_ledger": _on_tables(_posted),
        "post_ledger_tight": _on_tables(_posted_tight),
        "post_ledger_records": _on_tables(lambda spark, folder: _posting(spark, folder).transactions),
        "post_ledger_accounts": _on_tables(_posted_accounts),
        "save_posting": _on_tables(_saved_accounts),
        "save_posting_records": _on_tables(_saved_records),
        "save_posting_merged": _on_tables(_saved_in_batches),
        # SQL
        "sql_functions": _on_tables(_sql_functions),
        "sql_account_balance": _on_tables(_sql_balances),
        "sql_region_filter": _on_tables(_sql_region),
        # streams
        "stream_tx_by_day": _on_tables(_stream_by_day),
        "tx_by_day_closed": _on_tables(lambda spark, folder: live.closed_days(orderbook.event_batch(spark, folder))),
        "stream_tx_by_day_corrected": _on_tables(_stream_corrected),
        "stream_regional_totals": _on_tables(_stream_regions),
        "stream_overall": _on_tables(_stream_overall),
        "stream_post_ledger": _on_tables(_stream_posting),
    }

