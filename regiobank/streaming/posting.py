"""Posting of a request stream: one ledger batch per micro-batch.

Account states are the opening accounts plus the changes of the batches before, so a micro-batch writes only what
it touched. Every few batches the changes so far are summed up in a snapshot; later batches read the last snapshot and
the changes after it. A replayed batch starts from the same states and replaces its own folders; the changes are
written last and later batches see only them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regiobank.operators.ledger import post_ledger, records_of
from regiobank.sources.bank import CHANGES, apply_changes, summed_changes
from regiobank.sources.scratch import scratch_scope

SNAPSHOT_EVERY = 8

Moment = str | Callable[[int], str]


def _changes_before(spark: SparkSession, root: str, batch_id: int | None) -> DataFrame:
    """Changes per account of all batches, or of those before one: the last snapshot and what came after it."""
    schema = f"{CHANGES}, batch bigint"
    snapshots = spark.read.schema(schema).parquet(f"{root}/snapshots")
    changes = spark.read.schema(schema).parquet(f"{root}/changes")
    if batch_id is not None:
        snapshots, changes = snapshots.where(F.col("batch") < batch_id), changes.where(F.col("batch") < batch_id)
    last = snapshots.agg(F.max("batch")).first()[0]
    if last is not None:
        changes = changes.where(F.col("batch") > last).unionByName(snapshots.where(F.col("batch") == last))
    return summed_changes(changes)


def current_accounts(accounts: DataFrame, root: str, batch_id: int | None = None) -> DataFrame:
    """Accounts after all posted batches, or as they were before one of them."""
    return apply_changes(accounts, _changes_before(accounts.sparkSession, root, batch_id))


def prepare(spark: SparkSession, root: str) -> None:
    """Lay down an empty change log, so that it can be read before the first batch."""
    for name in ("changes", "snapshots"):
        spark.createDataFrame([], CHANGES).write.mode("overwrite").parquet(f"{root}/{name}/batch=-1")


def post_batch(
    requests: DataFrame, batch_id: int, accounts: DataFrame, root: str, as_of, snapshot_every: int = SNAPSHOT_EVERY
) -> None:
    """Post one micro-batch. What is staged for it goes with its end."""
    with scratch_scope(accounts.sparkSession):
        _post_batch(requests, batch_id, accounts, root, as_of, snapshot_every)


def _post_batch(requests: DataFrame, batch_id: int, accounts: DataFrame, root: str, as_of, snapshot_every: int) -> None:
    spark = accounts.sparkSession
    posting = post_ledger(current_accounts(accounts, root, batch_id), requests, as_of)
    posting.requests.write.mode("overwrite").parquet(f"{root}/requests/batch={batch_id}")
    written = spark.read.schema(posting.requests.schema).parquet(f"{root}/requests/batch={batch_id}")
    records_of(written, as_of).write.mode("overwrite").parquet(f"{root}/transactions/batch={batch_id}")
    posting.changes.write.mode("overwrite").parquet(f"{root}/changes/batch={batch_id}")
    if batch_id % snapshot_every == snapshot_every - 1:
        _changes_before(spark, root, batch_id + 1).write.mode("overwrite").parquet(f"{root}/snapshots/batch={batch_id}")


def run_posting(
    requests: DataFrame, accounts: DataFrame, root: str, checkpoint: str, as_of: Moment, snapshot_every: int = SNAPSHOT_EVERY
) -> None:
    """Post everything available on a request stream, then stop. `as_of` may depend on the number of the batch."""
    prepare(accounts.sparkSession, root)

    def post(batch: DataFrame, batch_id: int) -> None:
        post_batch(batch, batch_id, accounts, root, as_of(batch_id) if callable(as_of) else as_of, snapshot_every)

    (
        requests.writeStream.foreachBatch(post)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
