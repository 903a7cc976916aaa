"""Posting of deposits, withdrawals and transfers, with the outcome of one-by-one execution in seq order.

Whether a debit is covered depends on which earlier requests succeeded, also on other accounts. Requests get
consecutive places in seq order. The entries of an account are one block; an account that more than `block_rows`
requests name has a block per range of `block_rows` places instead, so no block is larger, however busy the account,
and there are few more blocks than accounts, however many requests there are.

First everything is assumed to succeed. Running sums per block show which blocks stay covered then; they need no more
than that. Only the others are walked entry by entry, in tasks that hold many blocks each and walk them together in
order of place. What a walk finds may refute what other blocks assumed: the opening balance, if an earlier block of the
account has debits that fail, or a credit, if the debit of that transfer fails. Blocks that are refuted are walked in
the next round, until there is none. A round writes only what it changes: the states of the blocks it has walked, and the
debits that it rejects or no longer rejects. Nothing that earlier rounds wrote is written again.

The result is exact: an entry depends on earlier places only, so the earliest block that is still wrong becomes
right in every round, the rounds end by themselves, and there is only one fixed point.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import islice

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from regiobank.model import CURRENCY, ROUTES, Route
from regiobank.operators.numbering import number_rows
from regiobank.operators.requests import error_code, validate_requests
from regiobank.sources.bank import apply_changes
from regiobank.sources.scratch import stage
from regiobank.sources.shipping import ship_package

SIDE = ["shard", "account"]
BLOCK = [*SIDE, "block"]
BLOCK_ROWS = 1 << 18

#: The block of an account whose entries are all in one.
WHOLE = -1
#: Entries a task walks; where there are more than that for each task, there are more tasks.
TASK_ENTRIES = 1 << 21

# Kinds of settlement input, in the order they apply within one place. A failed credit and a rejected debit come once
# for each round that found or withdrew them, with 1 or -1 as cents.
OPENING, FAILED, REJECTED, DEBIT, CREDIT = 0, 1, 2, 3, 4
# Kinds of settlement output: the state of a block, a debit that it rejects (side 1) or no longer rejects (side -1).
STATE, TURNED = 10, 11

INPUT = (
    "shard string, account string, block bigint, place bigint, kind int, cents bigint, peer_shard string, "
    "peer_account string, peer_block bigint"
)
OUTCOME = (
    "shard string, account string, block bigint, place bigint, kind int, net bigint, opening bigint, "
    "applied bigint, side int, untold boolean, peer_shard string, peer_account string, peer_block bigint"
)
NO_PEER = ["CAST(NULL AS STRING) AS peer_shard", "CAST(NULL AS STRING) AS peer_account", "CAST(NULL AS BIGINT) AS peer_block"]
PEER = ["peer_shard AS shard", "peer_account AS account", "peer_block AS block"]


def _names(schema: str) -> list[str]:
    return [part.split()[0] for part in schema.split(", ")]


@dataclass(frozen=True)
class Posting:
    """Result of one batch: judged requests, also with their `place` in seq order, new account rows, transaction records,
    touched balances."""

    requests: DataFrame
    placed: DataFrame
    accounts: DataFrame
    transactions: DataFrame
    changes: DataFrame
    rounds: int

    @property
    def rejected(self) -> DataFrame:
        return self.requests.where(F.col("status") == "REJECTED")


def _settle(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Walk the entries of one task in order of place; only one state per block is kept.

    A debit that turns out otherwise than before is told to the block of its credit, unless that has been walked here.
    """
    columns = _names(OUTCOME)
    states: dict[tuple, list[int]] = {}
    failed = rejected = decided = -1
    sides = was = 0
    covered = True
    turned: list | None = None
    for batch in batches:
        out: list[list] = []
        for shard, account, block, place, kind, cents, *peer in batch.itertuples(False, None):
            key = (shard, account, block)
            if kind == OPENING:
                states[key] = [cents, cents, 0]
                continue
            if kind == FAILED:
                sides = cents + (sides if failed == place else 0)
                failed = place
                continue
            if kind == REJECTED:
                was = cents + (was if rejected == place else 0)
                rejected = place
                continue
            state = states[key]
            if kind == DEBIT:
                if turned:
                    out.append(turned)
                    turned = None
                decided, covered = place, state[1] >= cents
                if covered:
                    state[1] -= cents
                    state[2] += 1
                if covered == bool(was and rejected == place):
                    untold = isinstance(peer[0], str)
                    target = peer if untold else [None, None, None]
                    turned = [*key, place, TURNED, 0, 0, 0, -1 if covered else 1, untold, *target]
            else:
                if turned and place == decided:
                    turned[9] = False
                if covered if place == decided else not (sides and failed == place):
                    state[1] += cents
                    state[2] += 1
        yield _outcome(out, columns)
    if turned:
        yield _outcome([turned], columns)
    closing = (
        [*key, -1, STATE, balance - opening, opening, applied, 0, False, None, None, None]
        for key, (opening, balance, applied) in states.items()
    )
    while chunk := list(islice(closing, 10_000)):
        yield _outcome(chunk, columns)


def _outcome(rows: list[list], columns: list[str]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=columns).astype({"peer_block": "Int64"})


def _entries(valid: DataFrame, block_rows: int) -> DataFrame:
    """One debit entry per source and one credit entry per target. Both sides of a transfer have the same place."""

    def block(side: str) -> str:
        return f"IF({side}.named > {block_rows}, place div {block_rows}, {WHOLE}L)"

    def entry(side: str, account: str, kind: int, peer: str, peer_account: str) -> str:
        return (
            f"IF({side} IS NULL, NULL, struct({side}.shard AS shard, {account} AS account, {block(side)} AS block, "
            f"place, {kind} AS kind, CAST(amount * 100 AS BIGINT) AS cents, {side}.cents AS base, "
            f"{peer}.shard AS peer_shard, IF({peer} IS NULL, NULL, {peer_account}) AS peer_account, "
            f"IF({peer} IS NULL, NULL, {block(peer)}) AS peer_block))"
        )

    debit = entry("source", "from_account_number", DEBIT, "target", "to_account_number")
    credit = entry("target", "to_account_number", CREDIT, "source", "from_account_number")
    return valid.selectExpr(f"inline(array_compact(array({debit}, {credit})))")


def _if_all_succeed(entries: DataFrame) -> DataFrame:
    """Blocks with their net, and the lowest balance after a debit relative to the opening, if everything succeeds."""
    signed = F.when(F.col("kind") == CREDIT, F.col("cents")).otherwise(-F.col("cents"))
    running = F.sum(signed).over(Window.partitionBy(*BLOCK).orderBy("place"))
    followed = entries.select(*BLOCK, "kind", "base", signed.alias("signed"), running.alias("running"))
    return followed.groupBy(*BLOCK).agg(
        F.max("base").alias("base"),
        F.sum("signed").alias("net"),
        F.min(F.when(F.col("kind") == DEBIT, F.col("running"))).alias("low"),
        F.count(F.lit(1)).alias("entries"),
    )


def _opened(blocks: DataFrame, net: str) -> DataFrame:
    """Add the balance each block opens with: the account's plus the net of its earlier blocks, one row per block."""
    earlier = Window.partitionBy(*SIDE).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    return blocks.withColumn("opens", F.col("base") + F.coalesce(F.sum(net).over(earlier), F.lit(0)))


class _Rounds:
    """One settlement: its blocks as they are if everything succeeds, and what the walked ones turned out to be."""

    def __init__(self, valid: DataFrame, block_rows: int, tasks: int | None):
        self.spark = valid.sparkSession
        self.tasks = tasks or int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        self.entries = _entries(valid, block_rows)
        self.blocks = stage(_if_all_succeed(self.entries), "blocks")
        # blocks of the busy accounts, each of which opens with what the earlier ones leave
        self.several = self.blocks.where(F.col("block") != WHOLE)
        self.single = self.blocks.where(F.col("block") == WHOLE).withColumn("opens", F.col("base"))
        opened = self.single.unionByName(_opened(self.several, "net"))
        self.doubtful = stage(opened.where("opens + low < 0").select(*BLOCK, "opens"), "doubtful")
        self.walked = self.spark.createDataFrame([], f"{OUTCOME}, round int")
        self.number = 0

    def run(self) -> None:
        while not self.doubtful.isEmpty():
            if not self.number:
                ship_package(self.spark)
                self.entries = stage(self.entries, "entries")
                self.tasks = max(self.tasks, -(-self.entries.count() // TASK_ENTRIES))
                self.busy = not self.several.isEmpty()
            self._walk()
            self.number += 1

    def rejections(self) -> DataFrame:
        """Places of the debits that are rejected: each change of mind of a round cancels the one before."""
        return self._turned().groupBy("place").agg(F.sum("side").alias("side")).where("side = 1").select("place")

    def _turned(self) -> DataFrame:
        return self.walked.where(F.col("kind") == TURNED)

    def _states(self) -> DataFrame:
        """The last state of each walked block."""
        last = F.max_by(F.struct("net", "opening", "applied"), "round").alias("last")
        states = self.walked.where(F.col("kind") == STATE).groupBy(*BLOCK).agg(last)
        return states.selectExpr(*BLOCK, "last.net AS own_net", "last.opening AS opening", "last.applied AS applied")

    def _inputs(self) -> DataFrame:
        """Entries of the doubtful blocks, their opening balances, and what is known so far of debits that fail."""
        names = _names(INPUT)
        turned = self._turned()
        failed = turned.where("peer_block IS NOT NULL").selectExpr(*PEER, "place", f"{FAILED} AS kind", "CAST(side AS BIGINT) AS cents", *NO_PEER)
        rejected = turned.selectExpr(*BLOCK, "place", f"{REJECTED} AS kind", "CAST(side AS BIGINT) AS cents", *NO_PEER)
        known = self.entries.select(*names).unionByName(failed).unionByName(rejected) if self.number else self.entries.select(*names)
        openings = self.doubtful.selectExpr(*BLOCK, "-1L AS place", f"{OPENING} AS kind", "opens AS cents", *NO_PEER)
        return openings.unionByName(known.join(self.doubtful.select(*BLOCK), BLOCK, "left_semi").select(*names))

    def _walk(self) -> None:
        """Walk the doubtful blocks, add what they turned out to be, and find the blocks that this refutes."""
        ordered = self._inputs().repartition(self.tasks, *BLOCK).sortWithinPartitions("place", "kind")
        found = stage(ordered.mapInPandas(_settle, OUTCOME).withColumn("round", F.lit(self.number)), "walked")
        self.walked = self.walked.unionByName(found) if self.number else found
        self.doubtful = stage(self._refuted(found), "doubtful")

    def _refuted(self, found: DataFrame) -> DataFrame:
        told = found.where("untold").selectExpr(*PEER).distinct()
        refuted = self.single.join(told, BLOCK, "left_semi").select(*BLOCK, "opens")
        return refuted.unionByName(self._moved(found, told)) if self.busy else refuted

    def _moved(self, found: DataFrame, told: DataFrame) -> DataFrame:
        """Blocks of busy accounts that are told of other credits, or open otherwise than they were walked with."""
        told = told.where(F.col("block") != WHOLE)
        # only accounts of which a block was walked, or is told of a transfer, can have changed
        walked = found.where((F.col("kind") == STATE) & (F.col("block") != WHOLE))
        concerned = walked.select(*SIDE).unionByName(told.select(*SIDE)).distinct()
        states = self._states().where(F.col("block") != WHOLE).drop("applied")
        blocks = self.several.join(concerned, SIDE, "left_semi").join(states, BLOCK, "left")
        blocks = blocks.join(told.withColumn("differs", F.lit(True)), BLOCK, "left")
        opened = _opened(blocks.withColumn("now", F.coalesce("own_net", "net")), "now")
        moved = F.when(F.col("opening").isNull(), F.coalesce(F.expr("opens + low < 0"), F.lit(False))).otherwise(F.expr("opens <> opening"))
        return opened.where(moved | F.col("differs").isNotNull()).select(*BLOCK, "opens")

    def changes(self) -> DataFrame:
        """Net and number of applied entries per touched account."""
        final = self.blocks.join(self._states(), BLOCK, "left")
        per_account = final.groupBy(F.col("shard").alias("shard_location"), F.col("account").alias("account_number")).agg(
            F.sum(F.coalesce("own_net", "net")).alias("net_cents"), F.sum(F.coalesce("applied", "entries")).alias("applied")
        )
        return per_account.where("applied > 0")


def post_ledger(
    accounts: DataFrame,
    requests: DataFrame,
    as_of,
    routes: Iterable[Route] = ROUTES,
    block_rows: int = BLOCK_ROWS,
    tasks: int | None = None,
) -> Posting:
    """Post a batch of requests against accounts, as if executed one by one in seq order.

    Requests with equal seq are taken in the order of their other columns. Account status does not change within
    a batch. Rejected requests change nothing. Blocks are walked in `tasks` tasks, as many as there are shuffle
    partitions if it is left out, and in more where a task would get more than `TASK_ENTRIES` entries.
    """
    placed = number_rows(
        requests,
        by=[],
        order=["seq", *[c for c in requests.columns if c != "seq"]],
    ).withColumnRenamed("position", "place")
    judged = stage(validate_requests(placed, accounts, routes), "judged")
    rounds = _Rounds(judged.where("reason IS NULL"), block_rows, tasks)
    rounds.run()

    uncovered = rounds.rejections().selectExpr("place", "'insufficient_balance' AS _uncovered")
    decided = judged.join(uncovered, "place", "left").withColumn("reason", F.coalesce("reason", "_uncovered"))
    outcome = decided.select(
        "place",
        *requests.columns,
        F.when(F.col("reason").isNull(), "COMPLETED").otherwise("REJECTED").alias("status"),
        "reason",
        error_code(F.col("reason")).alias("error_code"),
        F.when(F.col("source").isNotNull(), F.col("source.shard")).otherwise(F.col("target.shard")).alias("shard_location"),
    )
    changes = rounds.changes().withColumn("as_of", F.lit(as_of).cast("timestamp"))
    return Posting(
        outcome.drop("place"), outcome, apply_changes(accounts, changes), records_of(outcome, as_of), changes, rounds.number
    )


def records_of(outcome: DataFrame, as_of, *kept: str) -> DataFrame:
    """Transaction records of the completed requests, on the source's shard (the destination's for deposits)."""
    booked_from = "IF(transaction_type <> 'DEPOSIT', from_account_number, NULL)"
    booked_to = "IF(transaction_type <> 'WITHDRAWAL', to_account_number, NULL)"
    return outcome.where("status = 'COMPLETED'").select(
        *kept,
        F.expr(f"coalesce({booked_from}, {booked_to}) AS account_number"),
        F.expr(f"{booked_from} AS from_account_number"),
        F.expr(f"{booked_to} AS to_account_number"),
        "transaction_type",
        "amount",
        F.lit(CURRENCY).alias("currency"),
        "status",
        F.lit(as_of).cast("timestamp").alias("transaction_date"),
        "description",
        F.lit(None).cast("string").alias("reference_number"),
        "shard_location",
    )
