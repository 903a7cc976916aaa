"""Physical plans: plain equality joins, skew handling, equal results to the naive forms."""

import re

import pytest
from pyspark.sql import functions as F

from regiobank.model import ACCOUNTS, TRANSACTIONS
from regiobank.operators.joins import left_lookup
from regiobank.operators.legs import home_account, legs
from regiobank.operators.lookups import lookup
from regiobank.operators.requests import validate_requests
from regiobank.plans import dashboard, reports
from regiobank.sources import orderbook

FOLDER = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def bank(spark):
    return orderbook.load_bank(spark, FOLDER)


@pytest.mark.parametrize(
    "plan",
    [
        dashboard.dashboard_regional_stats,
        dashboard.regional_stats,
        dashboard.dashboard_overall_stats,
        reports.account_summary,
        reports.regional_share,
        reports.users_list,
    ],
)
def test_no_products_of_rows(spark, bank, plan):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan_of(plan(bank))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "NestedLoop" not in text and "Cartesian" not in text


def test_home_account_join_equals_either_or_join(bank):
    t, a = bank.transactions_all, bank.accounts_all
    source, target = F.col("t.from_account_number"), F.col("t.to_account_number")
    number = F.col("a.account_number")
    naive = t.alias("t").join(
        a.alias("a"),
        (F.col("t.shard_location") == F.col("a.shard_location"))
        & ((source.isNotNull() & (source == number)) | (source.isNull() & target.isNotNull() & (target == number))),
    )
    ours = t.withColumn("home", home_account()).alias("t").join(
        a.alias("a"),
        (F.col("t.shard_location") == F.col("a.shard_location")) & (F.col("home") == number),
    )
    columns = ["t.reference_number", "a.account_number"]
    assert naive.select(*columns).exceptAll(ours.select(*columns)).count() == 0
    assert naive.count() == ours.count()


def test_legs_equal_either_side_join(bank):
    t, a = bank.transactions_all, bank.accounts_all
    number = F.col("a.account_number")
    naive = a.alias("a").join(
        t.alias("t"),
        (F.col("t.shard_location") == F.col("a.shard_location"))
        & ((F.col("t.from_account_number") == number) | (F.col("t.to_account_number") == number)),
    )
    ours = legs(t, "reference_number").join(a, ["shard_location", "account_number"])
    assert naive.select("t.reference_number", number).exceptAll(ours.select("reference_number", "account_number")).count() == 0
    assert naive.count() == ours.count()


def test_sources_read_only_what_a_query_needs(bank):
    text = plan_of(reports.region_aggregate(bank))
    customer = re.search(r"ReadSchema: struct<c_custkey[^>]*>", text).group(0)
    assert customer == "ReadSchema: struct<c_custkey:bigint,c_nationkey:int,c_acctbal:double>"
    assert "GreaterThanOrEqual(c_acctbal,0.0)" in text


def test_one_account_with_a_third_of_all_transactions(spark):
    """The busy account is one row after partial aggregation, before any shuffle by account."""
    accounts = spark.range(1, 2001).selectExpr(
        "id AS account_id", "id AS user_id", "concat('A', id) AS account_number", "'CHECKING' AS account_type",
        "CAST(id AS DECIMAL(15,2)) AS balance", "'USD' AS currency", "'NA' AS region", "'ACTIVE' AS status",
        "CAST(NULL AS TIMESTAMP) AS created_date", "CAST(NULL AS TIMESTAMP) AS last_updated", "'SHARD1' AS shard_location",
    )
    transactions = spark.range(0, 120_000).selectExpr(
        "id AS transaction_id", "concat('A', IF(id % 3 = 0, 1, id % 2000 + 1)) AS account_number",
        "concat('A', IF(id % 3 = 0, 1, id % 2000 + 1)) AS from_account_number", "CAST(NULL AS STRING) AS to_account_number",
        "'WITHDRAWAL' AS transaction_type", "CAST(1 AS DECIMAL(15,2)) AS amount", "'USD' AS currency",
        "'COMPLETED' AS status", "CAST(NULL AS TIMESTAMP) AS transaction_date", "CAST(NULL AS STRING) AS description",
        "CAST(NULL AS STRING) AS reference_number", "'SHARD1' AS shard_location",
    )
    from regiobank.sources.bank import Bank

    assert [f.name for f in accounts.schema] == [p.split()[0] for p in ACCOUNTS.split(", ")]
    assert [f.name for f in transactions.schema] == [p.split()[0] for p in TRANSACTIONS.split(", ")]
    bank = Bank(None, accounts, transactions)
    stats = dashboard.transaction_stats_by_region(bank)
    assert stats.collect()[0].total_transactions == 120_000
    text = plan_of(stats)
    assert text.index("Join") < text.index("partial_count(1)")


def test_skewed_lookup_is_split(spark):
    """Row-level lookups of a hot key are split by the adaptive skew join."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000",
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    }
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        keys = spark.range(0, 90_000, 1, 8).selectExpr("IF(id % 3 = 0, 7, id) AS user_id", "id AS row")
        table = spark.range(0, 90_000).selectExpr("id AS user_id", "'SHARD1' AS shard_location", "'NA' AS region")
        found = lookup(keys, table, "user_id", "region")
        assert {r.region for r in found.collect()} == {"NA"}
        assert "skew=true" in plan_of(found)

        accounts = spark.range(0, 30_000).selectExpr(
            "concat('A', id) AS account_number", "'SHARD1' AS shard_location", "CAST(5 AS DECIMAL(15,2)) AS balance",
            "'ACTIVE' AS status",
        )
        requests = spark.range(0, 90_000, 1, 8).selectExpr(
            "id AS seq", "IF(id % 4 = 0, 'DEPOSIT', 'TRANSFER') AS transaction_type",
            "IF(id % 4 = 0, NULL, concat('A', IF(id % 3 = 0, 7, id % 30000))) AS from_account_number",
            "concat('A', id % 30000) AS to_account_number", "CAST(1 AS DECIMAL(15,2)) AS amount", "'x' AS description",
        )
        judged = validate_requests(requests, accounts)
        assert judged.count() == 90_000
        judged.collect()
        assert "skew=true" in plan_of(judged)
    finally:
        for name in settings:
            spark.conf.unset(name)


def test_missing_keys_spread(spark):
    """Rows without a key find nothing and do not meet in one task."""
    rows = spark.range(0, 10_000).selectExpr("id AS line", "IF(id % 10 = 0, concat('A', id), NULL) AS name", "'S' AS shard")
    table = spark.range(0, 10_000).selectExpr("concat('A', id) AS name", "'S' AS shard", "id AS value")
    found = left_lookup(rows, table, ["shard", "name"])
    assert found.where("value IS NOT NULL").count() == 1_000 and found.count() == 10_000
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        spread = left_lookup(rows, table, ["shard", "name"]).groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert len(spread) == 8 and max(r["count"] for r in spread) < 2_000


def test_store_holds_the_whole_bank_in_sorted_files(spark, bank, tmp_path):
    from regiobank.sources.bank import read_bank, write_bank

    root = str(tmp_path / "store")
    write_bank(bank, root)
    stored = read_bank(spark, root)
    for name in ("users", "accounts", "transactions"):
        kept, given = getattr(stored, name), getattr(bank, name)
        assert kept.count() == given.count()
        assert kept.exceptAll(given.select(*kept.columns)).count() == 0
    found = reports.account_history(stored, "ACC-1")
    assert found.exceptAll(reports.account_history(bank, "ACC-1")).count() == 0 and found.count() > 0
    text = plan_of(found)
    assert "Or(EqualTo(from_account_number,ACC-1),EqualTo(to_account_number,ACC-1))" in text
    numbers = stored.accounts.select(F.input_file_name().alias("file"), "account_number").groupBy("file")
    ranges = numbers.agg(F.min("account_number").alias("low"), F.max("account_number").alias("high")).collect()
    assert len(ranges) >= 3
    stats = [dashboard.dashboard_regional_stats(b).collect() for b in (stored, bank)]
    assert stats[0] == stats[1]
