"""Golden results on the sample bank, loaded through the batch operators into a store."""

import re
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from regiobank.functions.routing import find_region_route, find_route, region_shard_id, routing_table, routing_view, user_shard_id
from regiobank.operators import lookups
from regiobank.operators.ledger import post_ledger
from regiobank.plans import dashboard, reports
from regiobank.plans.catalog import register_views
from regiobank.model import REQUESTS
from regiobank.operators.onboarding import append_accounts, append_users, save_posting
from regiobank.sources.bank import only_region, only_shard, read_bank, union_shards
from regiobank.sources.formatting import to_json_rows
from regiobank.sources.sample import load_sample

AS_OF = "2024-05-01 10:00:00"


@pytest.fixture(scope="module")
def root(tmp_path_factory):
    return str(tmp_path_factory.mktemp("store"))


@pytest.fixture(scope="module")
def bank(spark, root):
    return load_sample(spark, root, AS_OF)


def rows(df):
    return [tuple(float(v) if isinstance(v, Decimal) else v for v in r) for r in df.collect()]


def test_loaded_rows(bank):
    users = rows(bank.users.orderBy("user_id").select("user_id", "username", "shard_location"))
    assert len(users) == 15
    assert users[0] == (1, "john_doe", "SHARD1")
    assert users[5] == (10_000_001, "jane_smith", "SHARD2")
    assert users[14] == (20_000_005, "min_choi", "SHARD3")
    accounts = rows(bank.accounts.orderBy("account_number").select("account_number", "account_id", "user_id", "status"))
    assert len(accounts) == 21
    assert accounts[0] == ("ACC001", 1, 1, "ACTIVE") and accounts[7] == ("ACC008", 1, 10_000_001, "ACTIVE")
    transactions = rows(
        bank.transactions.orderBy("shard_location", "transaction_id").select("shard_location", "transaction_id", "account_number")
    )
    assert len(transactions) == 12
    assert transactions[4] == ("SHARD2", 1, "ACC008")


def test_dashboard_regional_stats(bank):
    assert rows(dashboard.dashboard_regional_stats(bank)) == [
        ("APAC", 5, 7, 4, 357000.0, 51000.0, 2, 1, 1, 33000.0, 5000.0, 5000.0),
        ("EU", 5, 7, 4, 184400.0, 26342.86, 2, 1, 1, 16000.0, 500.0, 3000.0),
        ("NA", 5, 7, 4, 178000.0, 25428.57, 2, 1, 1, 8500.0, 500.0, 2000.0),
    ]


def test_regional_stats_repeats_accounts_per_transaction(bank):
    assert rows(dashboard.regional_stats(bank)) == [
        ("APAC", 5, 7, 8, 372000.0, 46500.0, 14000.0, 120000.0),
        ("EU", 5, 7, 8, 191900.0, 23987.5, 6200.0, 68000.0),
        ("NA", 5, 7, 8, 183000.0, 22875.0, 3500.0, 80000.0),
    ]
    assert [r[:5] for r in rows(dashboard.regional_stats_exact(bank))] == [
        ("APAC", 5, 7, 5, 357000.0),
        ("EU", 5, 7, 5, 184400.0),
        ("NA", 5, 7, 5, 178000.0),
    ]


def test_accounts_by_region(bank):
    assert rows(dashboard.dashboard_accounts_by_region(bank)) == [
        ("APAC", "CHECKING", 4, 72000.0, 18000.0, 14000.0, 25000.0),
        ("APAC", "SAVINGS", 3, 285000.0, 95000.0, 75000.0, 120000.0),
        ("EU", "CHECKING", 4, 31400.0, 7850.0, 6200.0, 9200.0),
        ("EU", "SAVINGS", 3, 153000.0, 51000.0, 30000.0, 68000.0),
        ("NA", "CHECKING", 4, 28000.0, 7000.0, 3500.0, 12000.0),
        ("NA", "SAVINGS", 3, 150000.0, 50000.0, 25000.0, 80000.0),
    ]


def test_overall_bands_share_and_summary(bank):
    assert rows(dashboard.dashboard_overall_stats(bank)) == [
        ("TOTAL", 15, 21, 12, 719400.0, 34257.14, 12, 0, 0, 57500.0, 6000.0, 10000.0)
    ]
    assert [(r[0], r[2], r[3]) for r in rows(reports.balance_bands(bank))] == [
        ("APAC", "High", 7),
        ("EU", "High", 3),
        ("EU", "Medium", 4),
        ("NA", "High", 4),
        ("NA", "Medium", 3),
    ]
    assert [(r[0], r[3]) for r in rows(reports.regional_share(bank))] == [("APAC", 49.62), ("EU", 25.63), ("NA", 24.74)]
    counts = {r.account_number: r.transaction_count for r in reports.account_summary(bank).collect()}
    assert {k for k, v in counts.items() if v == 2} == {"ACC001", "ACC008", "ACC015"}
    assert set(counts.values()) == {1, 2} and len(counts) == 21
    exact = {r.account_number: r.transaction_count for r in reports.account_summary(bank, exact=True).collect()}
    assert exact["ACC004"] == 0 and exact["ACC001"] == 2


def test_lists(bank):
    lists = {r.shard_location: (r.page, r.user_count, r.users) for r in reports.users_per_shard(bank).collect()}
    assert lists["SHARD1"] == (0, 5, "john_doe, maria_garcia, robert_smith, jennifer_wilson, david_brown")
    pages = reports.users_per_shard(bank, page_rows=2).where("shard_location = 'SHARD3'").orderBy("page").collect()
    assert [p.users for p in pages] == ["lee_wong, yuki_tanaka", "raj_kumar, wei_zhang", "min_choi"]
    assert rows(reports.user_accounts(bank)) == [
        ("ACC001", "CHECKING", 5000.0, "NA", "john_doe", "John Doe"),
        ("ACC002", "SAVINGS", 25000.0, "NA", "john_doe", "John Doe"),
    ]
    assert [r[0] for r in rows(reports.balance_check(bank))] == ["ACC015", "ACC008", "ACC001"]


def test_routing(spark, bank):
    table = routing_table(spark)
    ids = [0, 1, 10_000_000, 10_000_001, 20_000_000, 20_000_001, 30_000_000, 30_000_001, None, 5_000_000]
    keys = spark.createDataFrame([(i,) for i in ids], "user_id bigint")
    got = [r[0] for r in keys.select(user_shard_id(F.col("user_id"))).collect()]
    assert got == [None, 1, 1, 2, 2, 3, 3, None, None, 1]
    assert {r.user_id: r.shard_id for r in find_route(keys, table).collect()} == dict(zip(ids, got))
    closed = table.withColumn("status", F.when(F.col("shard_id") == 2, "MAINTENANCE").otherwise(F.col("status")))
    regions = spark.createDataFrame([("NA",), ("eu",), ("apac",), ("XX",), (None,)], "region string")
    assert [r[0] for r in regions.select(region_shard_id(F.col("region"))).collect()] == [1, 2, 3, None, None]
    found = {r.region: r.shard_id for r in find_region_route(regions, closed).collect()}
    assert found == {"NA": 1, "eu": None, "apac": 3, "XX": None, None: None}
    assert {r.user_id: r.shard_id for r in find_route(keys, closed).collect()}[20_000_000] is None
    assert [r.id_range_size for r in routing_view(table).collect()] == [10_000_000] * 3
    names = spark.createDataFrame([("john_doe",), ("min_choi",), ("nobody",)], "username string")
    found = {r.username: (r.user_id, r.region, r.shard_location) for r in lookups.find_users(names, bank).collect()}
    assert found == {
        "john_doe": (1, "NA", "SHARD1"),
        "min_choi": (20_000_005, "APAC", "SHARD3"),
        "nobody": (None, None, None),
    }


def test_overlapping_routes_give_the_first_match(spark):
    """The first active shard has an id that several routes hold, and every id one row."""
    routes = [(1, 10, 50, "ACTIVE"), (2, 30, 80, "ACTIVE"), (3, 40, 45, "MAINTENANCE"), (4, 5, 12, "ACTIVE"), (5, 60, 61, "ACTIVE"), (6, 200, 100, "ACTIVE")]
    table = spark.createDataFrame(routes, "shard_id long, user_id_range_start long, user_id_range_end long, status string")
    got = find_route(spark.range(0, 300).withColumnRenamed("id", "user_id"), table).collect()
    assert len(got) == 300
    for r in got:
        held = [s for s, low, high, status in routes if status == "ACTIVE" and low <= r.user_id <= high]
        assert r.shard_id == (min(held) if held else None)


def test_cross_shard_transfer(spark, bank):
    request = spark.createDataFrame([(1, "TRANSFER", "ACC001", "ACC008", Decimal(250), "demo")], REQUESTS)
    posting = post_ledger(bank.accounts, request, "2024-05-02 00:00:00")
    record = posting.transactions.collect()
    assert [(r.account_number, r.shard_location) for r in record] == [("ACC001", "SHARD1")]
    after = {r.account_number: r.balance for r in posting.accounts.collect()}
    assert after["ACC001"] == Decimal("4750.00") and after["ACC008"] == Decimal("7750.00")


def test_sql_entry(spark, bank):
    register_views(spark, bank)
    top = spark.sql("SELECT account_number FROM account_summary_all WHERE region = 'APAC' ORDER BY balance DESC LIMIT 1")
    assert top.collect()[0][0] == "ACC018"
    assert spark.sql("SELECT sum(total_accounts) FROM dashboard_regional_stats").collect()[0][0] == 21
    assert spark.sql("SELECT count(*) FROM dashboard_transactions_by_date").collect()[0][0] == 1
    assert spark.sql("SELECT count(*) FROM shard_routing_view").collect()[0][0] == 3
    row = spark.sql("SELECT get_user_shard(5000000), get_shard_for_region('na'), get_account_balance('ACC008'), get_account_balance('X')")
    assert [tuple(r) for r in row.collect()] == [("SHARD1", 1, Decimal("7500.00"), None)]


def test_sql_region_filter_reads_one_shard(spark, bank, root):
    register_views(spark, read_bank(spark, root))
    found = spark.sql("SELECT account_number FROM accounts_all WHERE region = 'EU'")
    assert found.count() == 7
    plan = found._jdf.queryExecution().executedPlan().toString()
    filters = re.search(r"PartitionFilters: \[[^\n]*", plan).group(0)
    assert "SHARD2" in filters.split("PushedFilters")[0] and len(found.inputFiles()) >= 1
    files = spark.sql("SELECT DISTINCT input_file_name() FROM accounts_all WHERE region = 'EU'").collect()
    assert all("shard_location=SHARD2" in r[0] for r in files)


def test_saved_batches_repeat_without_effect(spark, tmp_path):
    root = str(tmp_path / "bank")
    load_sample(spark, root, AS_OF)
    request = spark.createDataFrame([(1, "TRANSFER", "ACC001", "ACC008", Decimal(250), "demo")], REQUESTS)
    for _ in range(2):
        save_posting(request, root, "2024-05-02 00:00:00", batch=4)
        after = {r.account_number: r.balance for r in read_bank(spark, root).accounts.collect()}
        assert after["ACC001"] == Decimal("4750.00") and after["ACC008"] == Decimal("7750.00")
        stored = read_bank(spark, root).transactions
        assert sorted(r.transaction_id for r in stored.where("shard_location = 'SHARD1'").collect()) == [1, 2, 3, 4, 5]
    save_posting(request, root, "2024-05-03 00:00:00", batch=5)
    assert {r.account_number: r.balance for r in read_bank(spark, root).accounts.collect()}["ACC001"] == Decimal("4500.00")
    users = spark.createDataFrame([(1, 7, "x", "y@example.com", "z", None, None, "na"), (2, 1, "x", "y@example.com", "z", None, None, "NA")],
        "line bigint, user_id bigint, username string, email string, full_name string, phone string, address string, region string")
    for _ in range(2):
        rejected = append_users(users, root, "line", AS_OF, batch=6)
        assert [(r.line, r.reasons) for r in rejected.collect()] == [(2, ["duplicate_user_id"])]
        assert read_bank(spark, root).users.count() == 16


def test_account_ids_are_used_once(spark, tmp_path):
    root = str(tmp_path / "bank")
    load_sample(spark, root, AS_OF)
    schema = "line bigint, account_id bigint, user_id bigint, account_number string, account_type string, balance decimal(15,2), status string"
    rows = [(1, 70, 1, "N1", "SAVINGS", None, None), (2, 70, 1, "N2", "SAVINGS", None, None), (3, 1, 1, "N3", "SAVINGS", None, None)]
    rejected = append_accounts(spark.createDataFrame(rows, schema), root, "line", AS_OF, batch=9)
    assert sorted((r.line, r.reasons) for r in rejected.collect()) == [(2, ["duplicate_account_id"]), (3, ["duplicate_account_id"])]
    assert read_bank(spark, root).accounts.count() == 22


def test_store_prunes_shards_and_pushes_filters(spark, bank, root):
    stored = read_bank(spark, root)
    plan = only_region(stored.accounts_all, "EU")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(shard_location" in plan and "SHARD2" in plan
    assert len(only_region(stored.accounts_all, "EU").select("balance").inputFiles()) >= 1
    assert only_shard(stored.users, "SHARD3").count() == 5
    plan = reports.find_user(stored, "john_doe")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(username,john_doe)" in plan
    plan = reports.region_aggregate(stored)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<balance:decimal(15,2),region:string>" in plan


def test_union_of_shards_is_the_whole_table(bank):
    shards = {tag: only_shard(bank.users, tag).drop("shard_location") for tag in ("SHARD1", "SHARD2", "SHARD3")}
    both = union_shards(shards)
    assert both.exceptAll(bank.users).count() == 0 and both.count() == 15


def test_json_rows(bank):
    line = to_json_rows(reports.account_lookup(bank, "ACC001")).collect()[0].value
    assert '"balance":5000.0' in line and '"shard_location":"SHARD1"' in line


def test_rows_come_in_order(bank):
    found = reports.account_summary_by_balance(bank).collect()
    assert [r.balance for r in found] == sorted((r.balance for r in found), reverse=True)
    ties = [(r.balance, r.shard_location, r.account_number) for r in found]
    assert ties == sorted(ties, key=lambda r: (-r[0], r[1], r[2])) and len({b for b, _, _ in ties}) < len(ties)
    names = [r.username for r in reports.users_dropdown(bank).collect()]
    assert names == sorted(names)


def test_sample_users_have_contacts(bank):
    users = {r.username: (r.phone, r.address) for r in bank.users.collect()}
    assert users["wei_zhang"] == ("+65-6-123-4567", "1 Marina Bay, Singapore") and all(p and a for p, a in users.values())
