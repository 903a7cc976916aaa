"""Batches of a store: all or nothing, ids that never meet, merged runs, and files that are not opened."""

from decimal import Decimal

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from regiobank.model import REQUESTS
from regiobank.operators import numbering, onboarding
from regiobank.operators.onboarding import append_accounts, append_users, save_posting
from regiobank.plans import dashboard, reports
from regiobank.sources import bank as store
from regiobank.sources import manifest
from regiobank.sources.bank import SCHEMAS, compact, create_bank, read_bank, write_bank
from regiobank.sources.sample import load_sample
from regiobank.sources.sketches import HASHES, KEYS, PIECE, candidate_files, write_sketches

AS_OF = "2024-05-01 00:00:00"
USER = "line bigint, user_id bigint, username string, email string, full_name string, phone string, address string, region string"
ACCOUNT = "line bigint, account_id bigint, user_id bigint, account_number string, account_type string, balance decimal(15,2), status string"


@pytest.fixture
def root(spark, tmp_path):
    folder = str(tmp_path / "a bank")
    load_sample(spark, folder, AS_OF)
    return folder


def transfer(spark, amount=250):
    return spark.createDataFrame([(1, "TRANSFER", "ACC001", "ACC008", Decimal(amount), "demo")], REQUESTS)


def users(spark, *ids, region="NA"):
    rows = [(line, user_id, f"u{line}", f"u{line}@example.com", "z", None, None, region) for line, user_id in enumerate(ids)]
    return spark.createDataFrame(rows, USER)


def balances(spark, root):
    return {r.account_number: r.balance for r in read_bank(spark, root).accounts.collect()}


def content(bank):
    return {name: sorted(map(str, getattr(bank, name).collect())) for name in SCHEMAS}


def test_a_writer_that_ends_between_tables_leaves_the_store_as_it_was(spark, root, monkeypatch):
    before, right = content(read_bank(spark, root)), store.write_run
    state = manifest.load(spark, root)

    def ends(df, folder, run, cluster=False):
        if run.table == "changes":
            raise RuntimeError("lost")
        return right(df, folder, run, cluster)

    monkeypatch.setattr(onboarding, "write_run", ends)
    with pytest.raises(RuntimeError):
        save_posting(transfer(spark), root, AS_OF, batch=4)
    assert manifest.load(spark, root).runs == state.runs
    assert content(read_bank(spark, root)) == before
    monkeypatch.setattr(onboarding, "write_run", right)
    save_posting(transfer(spark), root, AS_OF, batch=4)
    assert balances(spark, root)["ACC001"] == Decimal("4750.00")
    assert read_bank(spark, root).transactions.count() == 13
    # records of the first try are not part of the store, and go
    assert len(manifest.sweep(spark, root, SCHEMAS)) == 1
    assert read_bank(spark, root).transactions.count() == 13


def test_an_earlier_state_stays_readable(spark, root):
    state = manifest.load(spark, root)
    old = read_bank(spark, root)
    before = content(old)
    save_posting(transfer(spark), root, AS_OF, batch=4)
    assert content(read_bank(spark, root, at=state)) == before == content(old)


def between(monkeypatch, work):
    """Have another batch come after the next one was judged and before it is committed."""
    right, calls = manifest.commit, []

    def commit(*args):
        calls.append(args[2])
        if len(calls) == 1:
            work()
        return right(*args)

    monkeypatch.setattr(manifest, "commit", commit)
    return calls


def test_batches_judged_from_one_state_get_other_ids(spark, root, monkeypatch):
    calls = between(monkeypatch, lambda: append_users(users(spark, None, None), root, "line", AS_OF, batch=5))
    append_users(users(spark, None, None, None), root, "line", AS_OF, batch=4)
    assert calls == [4, 5, 4]
    found = [r.user_id for r in read_bank(spark, root).users.where("region = 'NA'").collect()]
    assert sorted(found) == list(range(1, 11))


def test_an_id_that_another_batch_brings_is_judged_anew(spark, root, monkeypatch):
    """The second batch brings the id that the first one was about to give, and comes first."""
    between(monkeypatch, lambda: append_users(users(spark, 6), root, "line", AS_OF, batch=5))
    append_users(users(spark, None, None), root, "line", AS_OF, batch=4)
    found = [r.user_id for r in read_bank(spark, root).users.where("region = 'NA'").collect()]
    assert len(found) == len(set(found)) == 8 and 6 in found


def test_postings_meet_the_balances_they_were_made_for(spark, root, monkeypatch):
    between(monkeypatch, lambda: save_posting(transfer(spark, 4900), root, AS_OF, batch=5))
    posting = save_posting(transfer(spark, 250), root, AS_OF, batch=4)
    assert [r.status for r in posting.requests.collect()] != ["COMPLETED"]
    assert balances(spark, root)["ACC001"] == Decimal("100.00")


def test_ids_are_found_without_reading_the_store(spark, root):
    ids = lambda table, asked, given: manifest.reserve(spark, root, table, 9, asked, given)
    numbered = numbering.assign_user_ids(users(spark, None, 30, None), None, "line", ids)
    assert {r.line: r.user_id for r in numbered.collect()} == {0: 31, 1: 30, 2: 32}
    rows = spark.createDataFrame([(0, None, None, "SHARD1")], "line bigint, account_id bigint, account_number string, shard_location string")
    assert numbering.assign_account_ids(rows, None, "line", ids).first().account_number == "ACC-8"
    assert manifest.reserve(spark, root, "users", 9, {"NA": 2}, {"NA": 30}) == {"NA": 31}
    assert manifest.reserve(spark, root, "users", 10, {"NA": 2}, {}) == {"NA": 33}
    assert manifest.reserve(spark, root, "users", 9, {"NA": 3}, {}) == {"NA": 35}


def test_two_writers_do_not_write_one_number(spark, root):
    files, version = manifest._Files(spark, root), manifest.load(spark, root).version
    assert not files.write_new("{}", manifest.COMMITS, manifest._name(version))
    assert manifest.load(spark, root).version == version
    assert all(not name.startswith("_") for name in files.names(manifest.COMMITS))


def opened(bank, name):
    return len(getattr(bank, name).inputFiles())


def test_twenty_batches_and_a_merge(spark, root):
    for batch in range(4, 24):
        rows = read_bank(spark, root).users.where("user_id = 1").withColumn("user_id", F.lit(1000 + batch).cast("bigint"))
        run = store.write_run(rows, root, manifest.new_run("users", 0, ((batch, batch),)))
        amount = spark.createDataFrame([("SHARD1", "ACC001", batch, 1, None)], store.CHANGES)
        changes = store.write_run(amount, root, manifest.new_run("changes", 0, ((batch, batch),)))
        manifest.commit(spark, root, batch, [run, changes], manifest.load(spark, root), ())
    bank = read_bank(spark, root)
    before, files, wanted = content(bank), opened(bank, "users"), Decimal(500000 + sum(range(4, 24))) / 100
    state = compact(spark, root, fan=8)
    assert len(state.runs_of("changes")) == 1 and state.runs_of("users")[0].level == 1
    merged = read_bank(spark, root)
    assert content(merged) == before and opened(merged, "users") < files / 3
    assert balances(spark, root)["ACC001"] == wanted
    with pytest.raises(manifest.BatchClosed):
        read_bank(spark, root, without=7)
    state = compact(spark, root, full=True)
    merged = read_bank(spark, root)
    assert not state.runs_of("changes") and len(state.runs_of("accounts")) == 1
    assert "Aggregate" not in merged.accounts._jdf.queryExecution().executedPlan().toString()
    assert balances(spark, root)["ACC001"] == wanted and merged.users.count() == 35
    with pytest.raises(manifest.BatchClosed):
        save_posting(transfer(spark), root, AS_OF, batch=8)
    append_users(users(spark, 1004, None), root, "line", AS_OF, batch=30)
    assert read_bank(spark, root).users.where("user_id IN (6, 1004)").count() == 2


def test_a_repeat_during_a_merge_wins(spark, root, monkeypatch):
    append_users(users(spark, None), root, "line", AS_OF, batch=4)
    append_users(users(spark, None), root, "line", AS_OF, batch=5)
    right = manifest.replace

    def late(*args):
        monkeypatch.setattr(manifest, "replace", right)
        append_users(users(spark, None, None), root, "line", AS_OF, batch=4)
        return right(*args)

    monkeypatch.setattr(manifest, "replace", late)
    compact(spark, root, fan=2)
    assert read_bank(spark, root).users.count() == 18


def names(files):
    return {file.rsplit("/", 1)[1] for file in files}


@pytest.fixture(scope="module")
def wide(spark, tmp_path_factory):
    """A store of many files: 4000 accounts, a file per few of them."""
    folder = str(tmp_path_factory.mktemp("wide") / "bank")
    rows = spark.range(1, 4001).selectExpr(
        "id AS user_id", "concat('n', id) AS username", "concat('n', id, '@example.com') AS email", "'z' AS full_name", "CAST(NULL AS STRING) AS phone",
        "CAST(NULL AS STRING) AS address", "'NA' AS region", "TIMESTAMP '2024-01-01 00:00:00' AS created_date", "TIMESTAMP '2024-01-01 00:00:00' AS last_updated",
        "'SHARD1' AS shard_location",
    )
    accounts = rows.selectExpr(
        "user_id AS account_id", "user_id", "concat('ACC-', user_id) AS account_number", "'SAVINGS' AS account_type", "CAST(5 AS DECIMAL(15,2)) AS balance",
        "'USD' AS currency", "region", "'ACTIVE' AS status", "created_date", "last_updated", "shard_location",
    )
    none = spark.createDataFrame([], SCHEMAS["transactions"])
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    try:
        write_bank(store.Bank(rows, accounts, none), folder)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    return folder


def test_only_files_that_may_hold_a_key_are_read(spark, wide):
    runs = manifest.load(spark, wide).runs_of("accounts")
    bank = read_bank(spark, wide)
    keys = spark.createDataFrame([("SHARD1", "ACC-17"), ("SHARD1", "ACC-3999"), ("SHARD2", "ACC-5"), ("SHARD1", "nobody")], "shard_location string, account_number string")
    files = candidate_files(spark, wide, runs, keys, "account_number")
    held = bank.accounts.where("account_number IN ('ACC-17', 'ACC-3999')").select(F.input_file_name().alias("f")).distinct()
    assert {r.f.rsplit("/", 1)[1] for r in held.collect()} <= names(files)
    assert 2 <= len(files) <= 4 and opened(bank, "accounts") == 40
    assert len(bank.holding("accounts", keys, "account_number").inputFiles()) == len(files)
    every = bank.accounts.select("shard_location", "account_id")
    assert len(candidate_files(spark, wide, runs, every, "account_id")) == 40


def test_a_batch_larger_than_a_file_reads_it_without_a_probe(spark, wide):
    """The files of the shards that the keys name, no matter which keys they hold."""
    runs = manifest.load(spark, wide).runs_of("accounts")
    keys = spark.range(3000).selectExpr("'SHARD1' AS shard_location", "concat('none-', id) AS account_number")
    files = candidate_files(spark, wide, runs, keys, "account_number")
    shard = [f for f in read_bank(spark, wide).accounts.inputFiles() if "shard_location=SHARD1" in f]
    assert names(files) == {f.rsplit("/", 1)[1] for f in shard}
    assert len(candidate_files(spark, wide, runs, keys.limit(100), "account_number")) < len(shard)


def test_answers_that_are_wrong_change_nothing(spark, wide, monkeypatch):
    """With every file a candidate, as if each sketch answered wrongly, and with the files that answer."""
    rows = [(1, None, 5, "ACC-17", "SAVINGS", None, None), (2, 18, 5, "new", "SAVINGS", None, None), (3, None, 999999, "x", "SAVINGS", None, None), (4, None, 7, None, "SAVINGS", None, None)]
    asked = spark.createDataFrame(rows, ACCOUNT)
    bank, read = read_bank(spark, wide), []
    right = store.candidate_files

    def counted(spark, root, runs, keys, column):
        read.append(len(right(spark, root, runs, keys, column)))
        return right(spark, root, runs, keys, column)

    def everything(spark, root, runs, keys, column):
        return [f"{root}/{run.path}" for run in runs]

    results = []
    for version in (counted, everything):
        monkeypatch.setattr(store, "candidate_files", version)
        made, rejected = onboarding.new_accounts(asked, bank, "line", AS_OF)
        results.append((sorted((r.line, r.account_id, r.account_number) for r in made.collect()), sorted((r.line, r.reasons) for r in rejected.collect())))
    assert results[0] == results[1]
    assert results[0][1] == [(1, ["duplicate_account_number"]), (2, ["duplicate_account_id"]), (3, ["user_not_found", "null_region"])]
    assert [line for line, *_ in results[0][0]] == [4] and max(read) <= 4 and len(read) == 3


def test_batches_read_few_files(spark, wide):
    rejected = append_accounts(spark.createDataFrame([(1, None, 5, None, "SAVINGS", None, None)], ACCOUNT), wide, "line", AS_OF, batch=1)
    assert rejected.count() == 0
    assert read_bank(spark, wide).accounts.where("account_number = 'ACC-4001'").count() == 1


def test_latest_transaction_without_a_scan(spark, root):
    save_posting(transfer(spark), root, "2031-05-01 10:00:00", batch=1)
    save_posting(transfer(spark), root, "2031-04-20 10:00:00", batch=2)
    for step in range(2):
        bank = read_bank(spark, root)
        plain = store.Bank(bank.users, bank.accounts, bank.transactions)
        for plan in (dashboard.dashboard_transactions_by_date, reports.realtime_analytics):
            got = plan(bank)
            text = got._jdf.queryExecution().executedPlan().toString()
            assert "Subquery" not in text and text.count("FileScan") == 1
            assert "GreaterThanOrEqual(transaction_date," in text
            assert got.collect() == plan(plain).collect() != []
        compact(spark, root, full=True)


def test_latest_transaction_of_an_empty_store(spark, tmp_path):
    bank = create_bank(spark, str(tmp_path / "empty"))
    assert dashboard.dashboard_transactions_by_date(bank).collect() == []
    assert dashboard.dashboard_transactions_by_date(bank, as_of=AS_OF).collect() == []


def test_a_posting_is_numbered_by_place_and_written_once(spark, root, monkeypatch):
    ordered, right = [], numbering.number_rows

    def numbers(df, by, order):
        ordered.extend(df.schema[name].dataType.simpleString() for name in order)
        return right(df, by, order)

    monkeypatch.setattr(numbering, "number_rows", numbers)
    monkeypatch.setattr(onboarding, "stage", lambda df, name: pytest.fail(f"{name} is written before its run"))
    # equal seq: taken in the order of the other columns; the rejected one gets no id
    rows = [
        (7, "DEPOSIT", None, "ACC001", Decimal(3), "c"),
        (7, "DEPOSIT", None, "ACC001", Decimal(2), "b"),
        (9, "WITHDRAWAL", "ACC001", None, Decimal(900000), "d"),
        (None, "DEPOSIT", None, "ACC001", Decimal(4), "a"),
        (11, "DEPOSIT", None, "ACC001", Decimal(5), "e"),
    ]
    save_posting(spark.createDataFrame(rows, REQUESTS).repartition(3), root, AS_OF, batch=4)
    assert ordered == ["bigint"]
    made = read_bank(spark, root).transactions.where(F.col("transaction_date") == AS_OF).where("length(description) = 1")
    found = made.orderBy("transaction_id").collect()
    assert [row.description for row in found] == ["a", "b", "c", "e"]
    assert [row.transaction_id - found[0].transaction_id for row in found] == [0, 1, 2, 3]


def test_sketches_are_bitmaps_of_the_keys_without_a_sort_of_their_bits(spark, root, tmp_path, monkeypatch):
    """Files of several pieces, of few keys and of one key; missing and repeated keys."""
    keys = "CAST(account_id AS BIGINT) AS account_id", "concat('ACC-', account_id) AS account_number", "account_id % 5000 AS user_id"
    rows = spark.range(1, 9001).selectExpr("IF(id % 100 = 3, NULL, id) AS account_id").selectExpr(*keys, "IF(account_id = 7, 'SHARD3', IF(account_id < 60, 'SHARD2', 'SHARD1')) AS shard_location")
    run, folder = manifest.new_run("accounts", 0, ((1, 1),)), str(tmp_path / "run")
    rows.coalesce(1).write.partitionBy("shard_location").parquet(f"{folder}/{run.path}")
    plans, right = [], DataFrameWriter.parquet

    def planned(writer, path, *args, **kwargs):
        plans.append(writer._df._jdf.queryExecution().executedPlan().toString())
        return right(writer, path, *args, **kwargs)

    monkeypatch.setattr(DataFrameWriter, "parquet", planned)
    write_sketches(spark, folder, run)
    assert plans and not any("SortAggregate" in plan for plan in plans)

    found = spark.read.parquet(f"{folder}/_sketches/{run.path}").drop("file")
    parts = []
    for column in KEYS["accounts"]:
        held = spark.read.parquet(f"{folder}/{run.path}").selectExpr("shard_location", f"'{column}' AS column", f"CAST({column} AS STRING) AS key")
        parts.append(held.where("key IS NOT NULL"))
    every = parts[0].unionByName(parts[1]).unionByName(parts[2])
    pieces = found.select("shard_location", "column", "pieces").distinct()
    bits = every.join(pieces, ["shard_location", "column"]).selectExpr("*", f"explode(sequence(1, {HASHES})) AS seed")
    bits = bits.selectExpr("*", f"pmod(xxhash64(key, seed), pieces * {PIECE}) AS place")
    plain = bits.groupBy("shard_location", "column", "pieces", F.expr(f"place div {PIECE} AS piece")).agg(F.expr(f"bitmap_construct_agg(place % {PIECE}) AS bits"))
    assert {r.pieces for r in pieces.collect()} == {1, 8}
    assert sorted(found.select(plain.columns).collect()) == sorted(plain.collect())
