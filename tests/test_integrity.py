"""Integrity rules, ids and null rules on hand-made rows."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from regiobank.functions.routing import routing_table
from regiobank.functions.values import ascending, descending, rounded_avg
from regiobank.model import ACCOUNTS, TRANSACTIONS, USERS, Route
from regiobank.operators import integrity, numbering
from regiobank.operators.onboarding import new_accounts, new_users
from regiobank.plans import dashboard, reports
from regiobank.sources.bank import Bank
from regiobank.sources.formatting import format_account_count, format_balance, format_result

AS_OF = "2024-05-01 00:00:00"
USER_REQUEST = "line bigint, user_id bigint, username string, email string, full_name string, phone string, address string, region string"


def users_of(spark, rows):
    return spark.createDataFrame([(i, f"u{i}", f"u{i}@x", None, None, None, r, None, None, s) for i, r, s in rows], USERS)


def accounts_of(spark, rows):
    """rows: (id, user, number, balance, region, shard)"""
    return spark.createDataFrame(
        [
            (i, u, n, "CHECKING", None if b is None else Decimal(b), "USD", r, "ACTIVE", None, None, s)
            for i, u, n, b, r, s in rows
        ],
        ACCOUNTS,
    )


def transactions_of(spark, rows):
    """rows: (from, to, type, amount, shard)"""
    return spark.createDataFrame(
        [
            (i, f or t, f, t, k, Decimal(a), "USD", "COMPLETED", None, None, f"R{i}", s)
            for i, (f, t, k, a, s) in enumerate(rows)
        ],
        TRANSACTIONS,
    )


def reasons(judged, key="line"):
    return {r[key]: r.reasons for r in judged.collect() if r.reasons}


def test_user_rules(spark):
    rows = [
        (1, 1, "a", "e", None, None, None, "NA"),
        (2, 10_000_000, "a", "e", None, None, None, "NA"),
        (3, 10_000_001, "a", "e", None, None, None, "NA"),
        (4, 0, "a", "e", None, None, None, "NA"),
        (5, 30_000_001, "a", "e", None, None, None, "APAC"),
        (6, None, "a", "e", None, None, None, "XX"),
        (7, None, "a", "e", None, None, None, None),
        (8, 5, "a", "e", None, None, None, "na"),
        (9, None, "", None, None, None, None, "EU"),
        (10, None, "n" * 51, "e", None, "p" * 21, None, "EU"),
        (11, 1, "a", "e", None, None, None, "NA"),
    ]
    judged = integrity.validate_users(spark.createDataFrame(rows, USER_REQUEST), "line")
    assert reasons(judged) == {
        3: ["id_out_of_range"],
        4: ["id_out_of_range"],
        5: ["id_out_of_range"],
        6: ["invalid_region"],
        7: ["invalid_region"],
        8: ["chk_region"],
        9: ["null_username", "null_email"],
        10: ["long_username", "long_phone"],
        11: ["duplicate_user_id"],
    }
    codes = {r.line: r.error_code for r in judged.collect() if r.error_code}
    assert codes == {3: -20002, 4: -20002, 5: -20002, 6: -20001, 7: -20001}
    accepted, rejected = integrity.split(judged)
    assert accepted.count() == 2 and rejected.count() == 9


def test_new_users_go_on_after_stored_ids(spark):
    bank = Bank(users_of(spark, [(7, "NA", "SHARD1"), (10_000_003, "EU", "SHARD2")]), None, None)
    rows = [
        (1, None, "a", "e", None, None, None, "na"),
        (2, None, "b", "e", None, None, None, "NA"),
        (3, None, "c", "e", None, None, None, "Eu"),
        (4, 20_000_009, "d", "e", None, None, None, "APAC"),
        (5, None, "e", "e", None, None, None, "APAC"),
        (6, 7, "f", "e", None, None, None, "NA"),
        (7, None, "g", "e", None, None, None, "ZZ"),
    ]
    users, rejected = new_users(spark.createDataFrame(rows, USER_REQUEST), bank, "line", AS_OF)
    got = {r.line: (r.user_id, r.region, r.shard_location) for r in users.collect()}
    assert got == {
        1: (8, "NA", "SHARD1"),
        2: (9, "NA", "SHARD1"),
        3: (10_000_004, "EU", "SHARD2"),
        4: (20_000_009, "APAC", "SHARD3"),
        5: (20_000_010, "APAC", "SHARD3"),
    }
    assert reasons(rejected) == {6: ["duplicate_user_id"], 7: ["invalid_region"]}


def test_full_id_range_is_an_error(spark):
    users = users_of(spark, [(9_999_999, "NA", "SHARD1")])
    rows = [(i, None, "a", "e", None, None, None, "NA") for i in (1, 2)]
    numbered = numbering.assign_user_ids(spark.createDataFrame(rows, USER_REQUEST), users, "line")
    with pytest.raises(Exception, match="no user ids left in region NA"):
        numbered.collect()


def test_numbers_are_consecutive_over_many_tasks(spark):
    rows = spark.range(0, 5000, 1, 13).select(
        F.when(F.col("id") % 10 < 8, "hot").when(F.col("id") % 10 == 8, "cold").alias("g"), (F.col("id") * 7919 % 5000).alias("k")
    )
    numbered = numbering.number_rows(rows, by=["g"], order=["k"])
    for group, n in (("hot", 4000), ("cold", 500), (None, 500)):
        got = numbered.where(F.col("g").eqNullSafe(F.lit(group))).orderBy("k").select("position").collect()
        assert [r[0] for r in got] == list(range(n))


def test_account_rules(spark):
    users = users_of(spark, [(1, "NA", "SHARD1"), (10_000_001, "EU", "SHARD2")])
    schema = (
        "line bigint, account_id bigint, user_id bigint, account_number string, account_type string, "
        "balance decimal(15,2), currency string, region string, status string, shard_location string"
    )
    rows = [
        (1, 1, 1, "A", "CHECKING", Decimal(0), "EUR", "NA", None, "SHARD1"),
        (2, 2, 1, "A", "SAVINGS", None, "USD", "NA", "CLOSED", "SHARD1"),
        (3, 3, 10_000_001, "A", "SAVINGS", Decimal(1), "USD", "NA", "ACTIVE", "SHARD2"),
        (4, 4, 99, "B", "OTHER", Decimal(-1), "USD", "XX", "ODD", "SHARD1"),
        (5, 5, 10_000_001, "C", "BUSINESS", Decimal(1), None, "eu", "FROZEN", "SHARD2"),
        (6, 6, 1, None, None, Decimal(1), "USD", None, "INACTIVE", "SHARD1"),
    ]
    judged = integrity.validate_accounts(spark.createDataFrame(rows, schema), users, "line")
    assert reasons(judged) == {
        2: ["duplicate_account_number"],
        3: ["region_mismatch"],
        4: ["user_not_found", "chk_account_type", "chk_balance", "chk_status", "chk_region"],
        5: ["chk_region"],
        6: ["null_account_type", "null_region"],
    }
    first = judged.where("line = 1").collect()[0]
    assert (first.currency, first.status) == ("USD", "ACTIVE")


def test_new_accounts_follow_their_owner(spark):
    users = users_of(spark, [(1, "NA", "SHARD1"), (10_000_001, "EU", "SHARD2")])
    stored = accounts_of(spark, [(4, 1, "ACC-4", "1", "NA", "SHARD1"), (9, 1, "ACC-6", "1", "NA", "SHARD1")])
    bank = Bank(users, stored, None)
    schema = (
        "line bigint, account_id bigint, user_id bigint, account_number string, account_type string, "
        "balance decimal(15,2), status string"
    )
    rows = [
        (1, None, 1, None, "CHECKING", None, None),
        (2, None, 10_000_001, None, "SAVINGS", Decimal(5), None),
        (3, None, 2, None, "SAVINGS", Decimal(5), None),
        (4, None, 1, "ACC-4", "SAVINGS", Decimal(5), None),
        (5, None, 10_000_001, "ACC-4", "SAVINGS", Decimal(5), None),
    ]
    accounts, rejected = new_accounts(spark.createDataFrame(rows, schema), bank, "line", AS_OF)
    got = {r.line: (r.account_id, r.account_number, r.region, r.shard_location, r.balance) for r in accounts.collect()}
    assert got == {
        1: (10, "ACC-10", "NA", "SHARD1", 0),
        2: (1, "ACC-1", "EU", "SHARD2", 5),
        5: (2, "ACC-4", "EU", "SHARD2", 5),
    }
    assert reasons(rejected) == {3: ["user_not_found", "null_region"], 4: ["duplicate_account_number"]}


def test_transaction_rules(spark):
    accounts = accounts_of(spark, [(1, 1, "A", "1", "NA", "SHARD1"), (1, 2, "B", "1", "EU", "SHARD2")])
    schema = (
        "line bigint, account_number string, from_account_number string, to_account_number string, "
        "transaction_type string, amount decimal(15,2), currency string, status string, shard_location string"
    )
    rows = [
        (1, None, "A", "B", "TRANSFER", Decimal(1), "EUR", None, "SHARD1"),
        (2, None, None, "B", "DEPOSIT", Decimal(1), None, "REVERSED", "SHARD2"),
        (3, None, "A", None, "FEE", Decimal(1), None, None, "SHARD1"),
        (4, None, None, "A", "INTEREST", Decimal(1), None, None, "SHARD1"),
        (5, None, "A", None, "DEPOSIT", Decimal(1), None, None, "SHARD1"),
        (6, None, None, None, "TRANSFER", Decimal(1), None, None, "SHARD1"),
        (7, None, "A", "A", "TRANSFER", Decimal(0), None, "ODD", "SHARD1"),
        (8, "A", "B", None, "WITHDRAWAL", Decimal(-1), None, None, "SHARD1"),
        (9, "", "A", "", "WITHDRAWAL", None, None, None, "SHARD1"),
        (10, None, "A", None, "GIFT", Decimal(1), None, None, "SHARD1"),
    ]
    judged = integrity.validate_transactions(spark.createDataFrame(rows, schema), accounts)
    assert reasons(judged) == {
        3: ["chk_trans_accounts"],
        4: ["chk_trans_accounts"],
        5: ["null_account_number", "chk_trans_accounts"],
        6: ["null_account_number", "chk_trans_accounts"],
        7: ["chk_amount", "chk_status"],
        8: ["chk_amount", "orphan_from_account"],
        9: ["null_amount"],
        10: ["chk_transaction_type", "chk_trans_accounts"],
    }
    routed = {r.line: (r.account_number, r.currency, r.status) for r in judged.where("line <= 4").collect()}
    assert routed == {
        1: ("A", "USD", "PENDING"),
        2: ("B", "USD", "REVERSED"),
        3: ("A", "USD", "PENDING"),
        4: ("A", "USD", "PENDING"),
    }


def test_routing_rules(spark):
    routes = [Route(1, "s1", "NA", 1, 2), Route(2, "s2", "XX", 3, 4), Route(3, "s3", "EU", 5, 6, status="GONE")]
    assert reasons(integrity.validate_routing(routing_table(spark, routes)), "shard_id") == {
        2: ["chk_shard_region"],
        3: ["chk_shard_status"],
    }


def test_same_number_on_two_shards(spark):
    """Joins carry the shard, so equal account numbers on two shards stay apart."""
    bank = Bank(
        users_of(spark, [(1, "NA", "SHARD1"), (10_000_001, "EU", "SHARD2"), (2, "NA", "SHARD1")]),
        accounts_of(spark, [(1, 1, "X", "10", "NA", "SHARD1"), (1, 10_000_001, "X", "20", "EU", "SHARD2"), (2, 1, "Y", None, "NA", "SHARD1")]),
        transactions_of(
            spark,
            [("X", "Y", "TRANSFER", 1, "SHARD1"), ("X", "X", "TRANSFER", 1, "SHARD1"), (None, "X", "FEE", 5, "SHARD2")],
        ),
    )
    counts = {(r.region, r.account_number): r.transaction_count for r in reports.account_summary(bank).collect()}
    assert counts == {("NA", "X"): 2, ("NA", "Y"): 1, ("EU", "X"): 1}
    stats = {r.region: r for r in dashboard.dashboard_regional_stats(bank).collect()}
    assert (stats["NA"].total_users, stats["NA"].total_accounts, stats["NA"].total_transactions) == (2, 2, 2)
    assert (stats["EU"].total_transactions, stats["EU"].deposits, stats["EU"].total_deposits) == (1, 0, 0)
    assert stats["NA"].avg_balance_per_account == 10
    regional = {r.region: r for r in dashboard.regional_stats(bank).collect()}
    assert (regional["NA"].transaction_count, regional["NA"].total_balance, regional["NA"].avg_balance) == (3, 20, 10)
    assert integrity.account_number_collisions(bank.accounts_all).collect()[0].copies == 2
    bands = {(r.region, r.balance_category): r.account_count for r in reports.balance_bands(bank).collect()}
    assert bands == {("NA", "Low"): 1, ("NA", "High"): 1, ("EU", "Low"): 1}


def test_empty_bank(spark):
    bank = Bank(users_of(spark, []), accounts_of(spark, []), transactions_of(spark, []))
    overall = dashboard.dashboard_overall_stats(bank).collect()[0]
    assert (overall.total_users, overall.total_balance, overall.total_transactions) == (0, 0, 0)
    assert overall.avg_balance_per_account is None
    assert reports.transaction_distribution(bank).collect()[0].total_transactions == 0
    for plan in (
        dashboard.dashboard_regional_stats,
        dashboard.regional_stats,
        dashboard.dashboard_transactions_by_date,
        dashboard.dashboard_recent_transactions,
        dashboard.dashboard_accounts_by_region,
        reports.account_summary,
        reports.regional_share,
        reports.users_per_shard,
        reports.users_list,
        reports.realtime_analytics,
    ):
        assert plan(bank).count() == 0


def test_null_order_and_rounding(spark):
    df = spark.createDataFrame([(Decimal("1.00"),), (None,), (Decimal("2.00"),)], "v decimal(15,2)")
    assert [r[0] for r in df.orderBy(*ascending("v")).collect()] == [1, 2, None]
    assert [r[0] for r in df.orderBy(*descending("v")).collect()] == [None, 2, 1]
    ties = spark.createDataFrame([(Decimal("0.01"),), (Decimal("0.00"),)], "v decimal(15,2)")
    assert ties.agg(rounded_avg(F.col("v"))).collect()[0][0] == Decimal("0.01")
    assert ties.agg(rounded_avg(-F.col("v"))).collect()[0][0] == Decimal("-0.01")
    # One cent short of a tie in a group too large for six digits of the average.
    long = spark.range(2_000_001).select(F.when(F.col("id") < 1_000_000, Decimal("0.01")).otherwise(Decimal("0.00")).cast("decimal(15,2)").alias("v"))
    assert long.agg(rounded_avg(F.col("v"))).collect()[0][0] == Decimal("0.00")


def test_cutoff_keeps_the_time_of_day(spark):
    rows = spark.createDataFrame([("2024-04-01 11:59:59",), ("2024-04-01 12:00:00",), ("2024-05-01 12:00:00",)], "t string")
    transactions = rows.select(F.col("t").cast("timestamp").alias("transaction_date"))
    assert dashboard.since(transactions, 30).count() == 2
    assert dashboard.since(transactions, 30, "2024-05-01 11:00:00").count() == 3


def test_value_formats(spark):
    df = spark.sql("SELECT CAST(NULL AS DECIMAL(15,2)) b, CAST(NULL AS BIGINT) n, TIMESTAMP '2024-01-02 03:04:05' AT_TIME")
    row = df.select(format_balance(F.col("b")).alias("b"), format_account_count(F.col("n")).alias("n")).collect()[0]
    assert row.b is None and row.n == 0
    assert format_result(df).collect()[0].at_time == "2024-01-02 03:04:05"
