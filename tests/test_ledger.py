"""Posting against a plain one-by-one loop."""

import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from regiobank.model import ACCOUNTS, REQUESTS
from regiobank.operators import ledger
from regiobank.operators.ledger import post_ledger
from regiobank.operators.requests import generate_requests, validate_requests

AS_OF = "2024-05-01 00:00:00"
REGION = {"SHARD1": "NA", "SHARD2": "EU", "SHARD3": "APAC"}


def accounts_of(spark, rows):
    """rows: (number, shard, balance, status)"""
    full = [
        (i, i, number, "CHECKING", None if balance is None else Decimal(balance), "USD", REGION[shard], status, None, None, shard)
        for i, (number, shard, balance, status) in enumerate(rows, 1)
    ]
    return spark.createDataFrame(full, ACCOUNTS)


def requests_of(spark, rows):
    return spark.createDataFrame(
        [(s, k, f, t, None if a is None else Decimal(a), "x") for s, k, f, t, a in rows], REQUESTS
    )


def one_by_one(accounts, requests):
    """Sequential execution over plain rows; accounts are searched on the lowest shard, transfers prefer the source's."""
    state = {}
    for number, shard, balance, status in accounts:
        state.setdefault(number, {})[shard] = [Decimal(balance), status]
    outcome = {}
    for seq, kind, source, target, amount in sorted(requests, key=lambda r: r[0]):
        outcome[seq] = "REJECTED"
        if amount is None or Decimal(amount) <= 0 or (source and source not in state) or (target and target not in state):
            continue
        amount = Decimal(amount)
        debit = credit = None
        if kind in ("TRANSFER", "WITHDRAWAL"):
            if not source:
                continue
            shard = min(state[source])
            debit = state[source][shard]
            if debit[1] != "ACTIVE" or debit[0] < amount:
                continue
        if kind in ("TRANSFER", "DEPOSIT"):
            if not target or (kind == "TRANSFER" and source == target):
                continue
            places = state[target]
            if kind == "DEPOSIT":
                credit = places[min(places)]
                if credit[1] != "ACTIVE":
                    continue
            else:
                order = [shard, *sorted(places)]
                credit = next((places[s] for s in order if s in places and places[s][1] == "ACTIVE"), None)
                if credit is None:
                    continue
        if debit is None and credit is None:
            continue
        if debit is not None:
            debit[0] -= amount
        if credit is not None:
            credit[0] += amount
        outcome[seq] = "COMPLETED"
    balances = {(number, shard): v[0] for number, places in state.items() for shard, v in places.items()}
    return outcome, balances


def check(spark, accounts, requests, **sizes):
    posting = post_ledger(accounts_of(spark, accounts), requests_of(spark, requests), AS_OF, **sizes)
    got = {r.seq: r.status for r in posting.requests.collect()}
    balances = {(r.account_number, r.shard_location): r.balance for r in posting.accounts.collect()}
    want, want_balances = one_by_one(accounts, requests)
    assert got == want
    assert balances == want_balances
    records = posting.transactions.collect()
    assert len(records) == sum(s == "COMPLETED" for s in want.values())
    assert min(balances.values()) >= 0
    flow = sum(r.amount if r.transaction_type == "DEPOSIT" else -r.amount for r in records if r.transaction_type != "TRANSFER")
    assert sum(balances.values()) == sum(Decimal(b) for _, _, b, _ in accounts) + flow
    return posting


def random_case(seed, n_accounts, n_requests, hot):
    rng = random.Random(seed)
    shards = ["SHARD1", "SHARD2", "SHARD3"]
    accounts = []
    for i in range(n_accounts):
        status = rng.choice(["ACTIVE"] * 9 + ["FROZEN"])
        accounts.append((f"A{i}", rng.choice(shards), str(rng.randint(0, 300)), status))
        if rng.random() < 0.1:
            other = [s for s in shards if s != accounts[-1][1]]
            accounts.append((f"A{i}", rng.choice(other), str(rng.randint(0, 300)), rng.choice(["ACTIVE", "CLOSED"])))
    numbers = [f"A{i}" for i in range(n_accounts)] + ["A-none"]

    def pick():
        return numbers[0] if rng.random() < hot else rng.choice(numbers)

    requests = []
    for seq in rng.sample(range(n_requests * 3), n_requests):
        kind = rng.choice(["DEPOSIT", "WITHDRAWAL", "TRANSFER", "TRANSFER", "TRANSFER"])
        source = pick() if kind != "DEPOSIT" else None
        target = pick() if kind != "WITHDRAWAL" else None
        requests.append((seq, kind, source, target, str(rng.randint(0, 120))))
    return accounts, requests


@pytest.mark.parametrize(
    "seed,hot,sizes",
    [
        (1, 0.0, {}),
        (2, 0.0, {"tasks": 7}),
        (3, 0.5, {"block_rows": 25, "tasks": 9}),
        (4, 0.33, {"block_rows": 10, "tasks": 3}),
    ],
)
def test_random_batches_match_one_by_one_execution(spark, seed, hot, sizes):
    accounts, requests = random_case(seed, 12, 400, hot)
    posting = check(spark, accounts, requests, **sizes)
    assert posting.rounds >= 1


def test_tight_account_in_many_blocks(spark):
    rng = random.Random(9)
    accounts = [("H", "SHARD1", "100", "ACTIVE"), ("B", "SHARD2", "0", "ACTIVE")]
    requests = []
    for seq in range(300):
        kind = rng.choice(["DEPOSIT", "WITHDRAWAL", "TRANSFER", "TRANSFER"])
        pair = ("H", "B") if rng.random() < 0.5 else ("B", "H")
        source = pair[0] if kind != "DEPOSIT" else None
        target = pair[1] if kind != "WITHDRAWAL" else None
        requests.append((seq, kind, source, target, str(rng.randint(1, 60))))
    check(spark, accounts, requests, block_rows=20, tasks=12)


def test_funding_chains(spark):
    accounts = [(f"C{i}", "SHARD1" if i % 2 else "SHARD3", "0", "ACTIVE") for i in range(8)]
    accounts[0] = ("C0", "SHARD1", "50", "ACTIVE")
    accounts.append(("FROZEN", "SHARD2", "500", "FROZEN"))
    requests = [(i, "TRANSFER", f"C{i}", f"C{i + 1}", "50") for i in range(7)]
    requests += [
        (20, "TRANSFER", "FROZEN", "C0", "10"),
        (21, "TRANSFER", "C0", "C1", "10"),
        (22, "WITHDRAWAL", "C7", None, "50"),
        (23, "WITHDRAWAL", "C7", None, "0.01"),
    ]
    check(spark, accounts, requests, tasks=5)


def test_reasons_codes_and_record_of_a_cross_shard_transfer(spark):
    accounts = accounts_of(
        spark,
        [
            ("ACC001", "SHARD1", "5000", "ACTIVE"),
            ("ACC008", "SHARD2", "7500", "ACTIVE"),
            ("F", "SHARD1", "10", "FROZEN"),
            ("C", "SHARD3", "10", "CLOSED"),
            ("N", "SHARD3", None, "ACTIVE"),
            ("S", "SHARD3", "10", None),
        ],
    )
    rows = [
        (1, "TRANSFER", "ACC001", "ACC008", "250.00"),
        (2, "TRANSFER", "ACC001", "ACC001", "1"),
        (3, "TRANSFER", "X", "ACC008", "1"),
        (4, "TRANSFER", "ACC001", "X", "1"),
        (5, "TRANSFER", "F", "ACC008", "1"),
        (6, "TRANSFER", "ACC001", "C", "1"),
        (7, "DEPOSIT", None, "C", "1"),
        (8, "WITHDRAWAL", "ACC001", None, "4750.01"),
        (9, "WITHDRAWAL", "ACC001", None, "0"),
        (10, "DEPOSIT", "ACC001", None, "1"),
        (11, "FEE", "ACC001", None, "1"),
        (12, "WITHDRAWAL", "N", None, "1"),
        (13, "DEPOSIT", None, "S", "1"),
        (14, "WITHDRAWAL", "ACC001", None, None),
        (15, "TRANSFER", "", "ACC008", "1"),
    ]
    posting = post_ledger(accounts, requests_of(spark, rows), AS_OF)
    got = {r.seq: (r.reason, r.error_code) for r in posting.requests.collect()}
    assert got == {
        1: (None, None),
        2: ("self_transfer", 400),
        3: ("account_not_found", 404),
        4: ("account_not_found", 404),
        5: ("source_not_active", -20001),
        6: ("destination_not_active", -20003),
        7: ("account_not_active", -20001),
        8: ("insufficient_balance", -20002),
        9: ("chk_amount", None),
        10: ("missing_side", 400),
        11: ("invalid_type", 400),
        12: ("null_state", None),
        13: ("null_state", None),
        14: ("chk_amount", None),
        15: ("missing_side", 400),
    }
    record = posting.transactions.collect()
    assert len(record) == 1
    assert (record[0].account_number, record[0].shard_location, record[0].status, record[0].currency) == (
        "ACC001",
        "SHARD1",
        "COMPLETED",
        "USD",
    )
    after = {r.account_number: (r.balance, r.last_updated) for r in posting.accounts.collect()}
    assert after["ACC001"][0] == Decimal("4750.00") and after["ACC008"][0] == Decimal("7750.00")
    assert str(after["ACC008"][1]) == AS_OF and after["F"][1] is None and after["N"][0] is None


def test_transfer_prefers_the_active_account_on_its_own_shard(spark):
    accounts = [
        ("S", "SHARD2", "100", "ACTIVE"),
        ("D", "SHARD1", "0", "ACTIVE"),
        ("D", "SHARD2", "0", "ACTIVE"),
        ("E", "SHARD1", "0", "CLOSED"),
        ("E", "SHARD3", "0", "ACTIVE"),
    ]
    requests = [(1, "TRANSFER", "S", "D", "10"), (2, "TRANSFER", "S", "E", "10"), (3, "DEPOSIT", None, "D", "5")]
    posting = check(spark, accounts, requests)
    after = {(r.account_number, r.shard_location): r.balance for r in posting.accounts.collect()}
    assert after[("D", "SHARD2")] == 10 and after[("D", "SHARD1")] == 5 and after[("E", "SHARD3")] == 10


def test_empty_batch_changes_nothing(spark):
    accounts = accounts_of(spark, [("A", "SHARD1", "1", "ACTIVE")])
    posting = post_ledger(accounts, requests_of(spark, []), AS_OF)
    assert posting.requests.count() == 0 and posting.transactions.count() == 0
    assert [r.balance for r in posting.accounts.collect()] == [Decimal("1.00")]


def test_overflow_is_an_error(spark):
    accounts = accounts_of(spark, [("A", "SHARD1", "9999999999999.99", "ACTIVE")])
    posting = post_ledger(accounts, requests_of(spark, [(1, "DEPOSIT", None, "A", "1")]), AS_OF)
    with pytest.raises(Exception, match="exceeds decimal"):
        posting.accounts.collect()


def test_covered_blocks_never_reach_python(spark, monkeypatch):
    """Accounts that stay covered are settled by running sums; only the entries of the others are walked."""
    rows = [("POOR", "SHARD1", "1", "ACTIVE")] + [(f"R{i}", "SHARD2", "100000", "ACTIVE") for i in range(50)]
    requests = [(n, "TRANSFER", f"R{n % 50}", f"R{(n + 1) % 50}", "3") for n in range(500)]
    walked = []
    inputs = ledger._Rounds._inputs

    def seen(self):
        walked.append({r.account for r in inputs(self).select("account").distinct().collect()})
        return inputs(self)

    monkeypatch.setattr(ledger._Rounds, "_inputs", seen)
    assert check(spark, rows, requests).rounds == 0 and walked == []
    posting = check(spark, rows, [*requests, (900, "WITHDRAWAL", "POOR", None, "2")])
    assert posting.rounds == 1 and walked == [{"POOR"}]


def test_chains_take_rounds(spark):
    """Each transfer fails because the one before does; tasks learn of it one after the other."""
    rows = [(f"C{i}", "SHARD1", "0", "ACTIVE") for i in range(40)]
    rows[0] = ("C0", "SHARD1", "1", "ACTIVE")
    requests = [(i, "TRANSFER", f"C{i}", f"C{i + 1}", "2") for i in range(39)]
    assert check(spark, rows, requests, tasks=8).rounds >= 3


def test_an_account_is_in_several_blocks_only_if_it_is_busy(spark, monkeypatch):
    """Requests of an account that lie far apart make no more blocks; those of a busy one are cut by their places."""
    rng = random.Random(3)
    rows = [(f"A{i}", "SHARD1", "50", "ACTIVE") for i in range(20)] + [("BUSY", "SHARD2", "50", "ACTIVE")]
    requests = [(n, "WITHDRAWAL", f"A{n % 20}", None, "9") for n in range(160)]
    requests += [(200 + n, rng.choice(["DEPOSIT", "TRANSFER"]), None, "BUSY", "1") for n in range(40)]
    requests = [(s, k, "A0" if k == "TRANSFER" else f, t, a) for s, k, f, t, a in requests]
    blocks = []
    run = ledger._Rounds.run

    def seen(self):
        blocks.extend((r.account, r.block) for r in self.blocks.collect())
        run(self)

    monkeypatch.setattr(ledger._Rounds, "run", seen)
    check(spark, rows, requests, block_rows=32, tasks=3)
    of_busy = {block for account, block in blocks if account == "BUSY"}
    assert len(of_busy) == 2 and ledger.WHOLE not in of_busy
    assert sorted(account for account, _ in blocks if account != "BUSY") == sorted(f"A{i}" for i in range(20))


def test_a_round_writes_only_what_it_walks(spark, monkeypatch):
    """A chain of ten blocks, one per round: each round adds its own block and does not write the earlier ones again."""
    rows = [("C0", "SHARD1", "1", "ACTIVE"), *[(f"C{i}", "SHARD1", "0", "ACTIVE") for i in range(1, 10)]]
    requests = [(i, "TRANSFER", f"C{i}", f"C{i + 1}", "2") for i in range(9)]
    written = []
    stage = ledger.stage

    def seen(df, name):
        staged = stage(df, name)
        if name == "walked":
            written.append(staged.count())
        return staged

    monkeypatch.setattr(ledger, "stage", seen)
    posting = check(spark, rows, requests, tasks=4)
    assert len(written) == posting.rounds >= 3 and max(written) <= 2


def test_generated_requests(spark):
    rows = generate_requests(spark.range(1, 101).withColumnRenamed("id", "i")).orderBy("seq").collect()
    assert len(rows) == 100
    assert rows[0].transaction_type == "WITHDRAWAL" and rows[0].from_account_number is None
    assert rows[1].from_account_number == f"ACC-{2 * 12345 % 30_000_000 + 1}"
    assert rows[2].to_account_number == f"ACC-{4 * 54321 % 30_000_000 + 1}" and rows[2].transaction_type == "DEPOSIT"
    assert all(10 <= r.amount <= 1000 for r in rows)
    judged = validate_requests(
        generate_requests(spark.range(1, 101).withColumnRenamed("id", "i")), accounts_of(spark, [("Z", "SHARD1", "1", "ACTIVE")])
    )
    assert judged.where(F.col("reason").isNull()).count() == 0
