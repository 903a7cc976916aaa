"""SQL entry: every table and view of the bank under its name."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regiobank.functions.routing import routing_table, routing_view
from regiobank.model import ROUTES
from regiobank.plans import dashboard, reports
from regiobank.sources.bank import Bank


def _region_by_shard(table: DataFrame) -> DataFrame:
    """The region as the one its shard serves, which is the same: a filter on it then chooses folders of the store."""
    arms = " ".join(f"WHEN '{r.tag}' THEN '{r.region}'" for r in ROUTES)
    return table.withColumn("region", F.expr(f"CASE shard_location {arms} END")).select(*table.columns)


def views(spark: SparkSession, bank: Bank) -> dict[str, DataFrame]:
    routing = routing_table(spark)
    return {
        "users_all": _region_by_shard(bank.users_all),
        "accounts_all": _region_by_shard(bank.accounts_all),
        "transactions_all": bank.transactions_all,
        "account_summary_all": dashboard.account_summary_all(bank),
        "account_summary": reports.account_summary(bank),
        "regional_stats": dashboard.regional_stats(bank),
        "dashboard_regional_stats": dashboard.dashboard_regional_stats(bank),
        "dashboard_overall_stats": dashboard.dashboard_overall_stats(bank),
        "dashboard_recent_transactions": dashboard.dashboard_recent_transactions(bank),
        "dashboard_accounts_by_region": dashboard.dashboard_accounts_by_region(bank),
        "dashboard_transactions_by_date": dashboard.dashboard_transactions_by_date(bank),
        "shard_routing_metadata": routing,
        "shard_routing_view": routing_view(routing),
    }


def functions() -> list[str]:
    """Routing and balance as temporary SQL functions; the balance comes from the view accounts_all."""
    active = [r for r in ROUTES if r.status == "ACTIVE"]
    tags = " ".join(f"WHEN user_id BETWEEN {r.first_id} AND {r.last_id} THEN '{r.tag}'" for r in ROUTES)
    ids = " ".join(f"WHEN user_id BETWEEN {r.first_id} AND {r.last_id} THEN {r.shard_id}" for r in active)
    regions = " ".join(f"WHEN upper(region) = '{r.region}' THEN {r.shard_id}" for r in active)
    create = "CREATE OR REPLACE TEMPORARY FUNCTION"
    return [
        f"{create} get_user_shard(user_id BIGINT) RETURNS STRING RETURN CASE {tags} ELSE 'UNKNOWN' END",
        f"{create} get_shard_for_user(user_id BIGINT) RETURNS BIGINT RETURN CASE {ids} END",
        f"{create} get_shard_for_region(region STRING) RETURNS BIGINT RETURN CASE {regions} END",
        f"{create} get_account_balance(number STRING) RETURNS DECIMAL(15,2) RETURN (SELECT min_by(a.balance, "
        "a.shard_location) FROM accounts_all a WHERE a.account_number = get_account_balance.number)",
    ]


def register_views(spark: SparkSession, bank: Bank) -> None:
    """Make spark.sql(...) see the bank and its functions."""
    for name, df in views(spark, bank).items():
        df.createOrReplaceTempView(name)
    for statement in functions():
        spark.sql(statement)
