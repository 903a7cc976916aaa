"""Streams against their batch forms; replays change nothing."""

import os
from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from regiobank.model import REQUESTS
from regiobank.operators.ledger import post_ledger
from regiobank.sources import orderbook
from regiobank.sources.scratch import scratch_root
from regiobank.streaming import corrections, live, posting

FOLDER = "/root/testdata/sf0.001"
AS_OF = "2024-01-01 00:00:00"


@pytest.fixture(scope="module")
def split_orders(spark, tmp_path_factory):
    """The orders in three files by key, so that a stream takes them in three micro-batches."""
    folder = str(tmp_path_factory.mktemp("orders"))
    orders = orderbook.order_batch(spark, FOLDER)
    bounds = [(0, 500), (500, 900), (900, 1500)]
    for i, (low, high) in enumerate(bounds):
        orders.where(f"o_orderkey >= {low} AND o_orderkey < {high}").coalesce(1).write.parquet(f"{folder}/part={i}")
    return folder, orders.count(), bounds


def stream_of(spark, folder):
    files = (
        spark.readStream.schema(orderbook.SCHEMAS["orders"])
        .option("recursiveFileLookup", "true")
        .option("maxFilesPerTrigger", "1")
        .parquet(folder)
    )
    return orderbook.ledger_requests(files)


def test_posting_in_micro_batches_equals_one_batch(spark, split_orders, tmp_path):
    folder, n, _ = split_orders
    accounts = orderbook.accounts(spark, FOLDER)
    root = str(tmp_path / "posted")
    posting.run_posting(stream_of(spark, folder), accounts, root, str(tmp_path / "checkpoint"), AS_OF)
    requests = spark.read.parquet(f"{root}/requests")
    assert requests.count() == n and requests.select("batch").distinct().count() == 3
    whole = post_ledger(accounts, orderbook.ledger_requests(orderbook.order_batch(spark, FOLDER)), AS_OF)
    key = ["account_number", "shard_location", "balance"]
    streamed = posting.current_accounts(accounts, root).select(*key)
    assert streamed.exceptAll(whole.accounts.select(*key)).count() == 0
    assert requests.where("status = 'COMPLETED'").count() == whole.transactions.count()

    before = sorted(map(tuple, streamed.collect()))
    batch = requests.where("batch = 1").select(
        "seq", "transaction_type", "from_account_number", "to_account_number", "amount", "description"
    )
    replay = spark.createDataFrame(batch.collect(), batch.schema)
    posting.post_batch(replay, 1, accounts, root, AS_OF)
    assert sorted(map(tuple, posting.current_accounts(accounts, root).select(*key).collect())) == before


def test_accounts_keep_the_date_of_their_last_batch(spark, tmp_path):
    accounts = orderbook.accounts(spark, FOLDER).where("status = 'ACTIVE'").orderBy("account_id").limit(2)
    numbers = [r.account_number for r in accounts.collect()]
    root = str(tmp_path / "posted")
    posting.prepare(spark, root)
    for batch in range(5):
        request = [(batch, "DEPOSIT", None, numbers[batch % 2 if batch < 4 else 0], Decimal(1), "x")]
        moment = f"2024-0{batch + 1}-01 00:00:00"
        for _ in range(2):  # a replay changes nothing
            posting.post_batch(spark.createDataFrame(request, REQUESTS), batch, accounts, root, moment, snapshot_every=2)
    before = {r.account_number: r.balance for r in accounts.collect()}
    after = {r.account_number: (r.balance, str(r.last_updated)[:10]) for r in posting.current_accounts(accounts, root).collect()}
    assert after == {numbers[0]: (before[numbers[0]] + 3, "2024-05-01"), numbers[1]: (before[numbers[1]] + 2, "2024-04-01")}
    assert spark.read.parquet(f"{root}/snapshots").select("batch").distinct().count() == 2


def test_a_number_on_two_shards_counts_in_one_region(spark):
    accounts = spark.createDataFrame([("A", "SHARD1", "NA"), ("A", "SHARD2", "EU")], "account_number string, shard_location string, region string")
    rows = [("A", "SHARD1", "DEPOSIT", Decimal(5))]
    events = spark.createDataFrame(rows, "account_number string, shard_location string, transaction_type string, amount decimal(15,2)")
    got = live.regional_totals(events, accounts).collect()
    assert [(r.region, r.total_transactions) for r in got] == [("NA", 1)]


@pytest.fixture(scope="module")
def event_files(spark, tmp_path_factory):
    return orderbook.in_files(orderbook.events(spark, FOLDER), "event_id", str(tmp_path_factory.mktemp("events")))


def test_closed_days_equal_batch(spark, tmp_path, event_files):
    out = str(tmp_path / "days")
    stream = live.daily_volume(orderbook.event_stream(spark, event_files))
    live.run_append(stream, out, str(tmp_path / "checkpoint"))
    streamed = spark.read.schema(stream.schema).parquet(out)
    batch = live.closed_days(orderbook.event_batch(spark, FOLDER))
    assert sorted(map(tuple, streamed.collect())) == sorted(map(tuple, batch.collect()))


def test_live_totals_equal_batch(spark, tmp_path, event_files):
    out = str(tmp_path / "overall")
    live.run_complete(live.overall_totals(orderbook.event_stream(spark, event_files)), out, str(tmp_path / "checkpoint"))
    wanted = live.overall_totals(orderbook.event_batch(spark, FOLDER)).collect()
    assert live.latest_totals(spark, out).collect() == wanted


def test_regional_totals_over_micro_batches_equal_batch(spark, tmp_path, event_files):
    accounts = orderbook.accounts(spark, FOLDER)
    stream = orderbook.on_shards(orderbook.event_stream(spark, event_files), spark, FOLDER)
    out = str(tmp_path / "regions")
    live.run_regional_totals(stream, accounts, out, str(tmp_path / "checkpoint"))
    assert spark.read.parquet(out).select("batch").distinct().count() == 3
    batch = orderbook.on_shards(orderbook.event_batch(spark, FOLDER), spark, FOLDER)
    wanted = live.regional_totals(batch, accounts).collect()
    got = live.live_regional_totals(spark, out).collect()
    assert sorted(tuple(map(str, r)) for r in got) == sorted(tuple(map(str, r)) for r in wanted)


def feed(spark, *rows):
    schema = "event_id bigint, transaction_date timestamp, transaction_type string, amount decimal(15,2)"
    return spark.createDataFrame([(i, moment and datetime.fromisoformat(moment), "DEPOSIT", Decimal(amount)) for i, moment, amount in rows], schema)


def test_repeats_count_once_and_late_rows_correct_their_day(spark, tmp_path):
    root = str(tmp_path / "days")
    corrections.prepare(spark, root)
    first = feed(spark, (1, "2024-01-01 10:00:00", 5), (1, "2024-01-01 10:00:00", 5), (2, "2024-01-02 09:00:00", 7), (None, "2024-01-01 11:00:00", 1), (9, None, 1))
    second = feed(spark, (2, "2024-01-02 09:00:00", 7), (3, "2024-01-05 00:00:00", 9))
    third = feed(spark, (4, "2024-01-01 12:00:00", 2), (1, "2024-01-01 10:00:00", 5), (3, "2024-01-05 00:00:00", 9), (4, "2024-01-01 12:00:00", 2))

    def days():
        return sorted((r.transaction_date, r.transaction_count, r.total_amount, r.late_count) for r in corrections.corrected_days(spark, root).collect())

    corrections.volume_batch(first, 0, root)
    assert days() == []
    corrections.volume_batch(second, 1, root)
    assert days() == [("2024-01-01", 2, Decimal(6), 0), ("2024-01-02", 1, Decimal(7), 0)]
    for number, rows in ((2, third), (1, second), (2, third), (3, third.where("false"))):
        corrections.volume_batch(rows, number, root)  # replays change nothing
    assert days() == [("2024-01-01", 3, Decimal(8), 1), ("2024-01-02", 1, Decimal(7), 0)]


def test_files_of_a_stream_keep_rows_without_a_key(spark, tmp_path):
    rows = spark.createDataFrame([(k, "x") for k in [None, None, *range(40)]], "event_id bigint, event_type string")
    path = orderbook.in_files(rows, "event_id", str(tmp_path / "files"))
    got = spark.read.parquet(path)
    assert sorted((r.event_id is None, r.event_id or 0, r.part) for r in got.collect()) == sorted((k is None, k or 0, (k or 0) // 14) for k in [None, None, *range(40)])
    assert got.inputFiles() and all(got.where(f"part = {n}").select(F.input_file_name()).distinct().count() == orderbook.FILES for n in range(3))


def test_a_posted_batch_leaves_no_staged_tables(spark, tmp_path):
    accounts = orderbook.accounts(spark, FOLDER)
    number = accounts.where("status = 'ACTIVE'").first().account_number
    posting.prepare(spark, str(tmp_path / "posted"))
    place = scratch_root(spark).removeprefix("file:")
    before = set(os.listdir(place))
    posting.post_batch(spark.createDataFrame([(1, "DEPOSIT", None, number, Decimal(1), "x")], REQUESTS), 0, accounts, str(tmp_path / "posted"), AS_OF)
    assert set(os.listdir(place)) <= before
