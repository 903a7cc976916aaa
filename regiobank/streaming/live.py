"""Live totals over a transaction stream; each job takes what is available and ends."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regiobank.plans.dashboard import TYPE_COUNTS, TYPE_TOTALS, transaction_totals, volume_measures
from regiobank.functions.values import count_of, sum_of_type

LATENESS = "1 day"


def daily_volume(transactions: DataFrame, lateness: str = LATENESS) -> DataFrame:
    """Volume per day; on a stream a day appears once it is closed by the watermark."""
    day = F.window("transaction_date", "1 day")
    return (
        transactions.withWatermark("transaction_date", lateness)
        .groupBy(day.alias("day"))
        .agg(*volume_measures())
        .select(
            F.date_format("day.start", "yyyy-MM-dd").alias("transaction_date"),
            "transaction_count",
            "total_amount",
            *TYPE_COUNTS,
        )
    )


def closed_days(transactions: DataFrame, days_late: int = 1) -> DataFrame:
    """The days a stream over the same rows has closed, from a batch."""
    start = F.date_trunc("day", "transaction_date")
    latest = transactions.agg(F.max("transaction_date")).scalar()
    over = transactions.where(start + F.make_dt_interval(days=F.lit(days_late + 1)) <= latest)
    return over.groupBy(F.date_format("transaction_date", "yyyy-MM-dd").alias("transaction_date")).agg(*volume_measures())


def regional_totals(transactions: DataFrame, accounts: DataFrame) -> DataFrame:
    """Totals per region of the account a batch of transactions is booked on, aggregated per account first.

    Transactions carry the shard they are booked on; a number alone may stand for accounts of several shards.
    """
    measures = ["total_transactions", *TYPE_COUNTS, *TYPE_TOTALS]
    key = ["shard_location", "account_number"]
    per_account = transactions.groupBy(*key).agg(
        F.count(F.lit(1)).alias("total_transactions"),
        *[count_of("transaction_type", kind).alias(name) for name, kind in TYPE_COUNTS.items()],
        *[sum_of_type(kind).alias(name) for name, kind in TYPE_TOTALS.items()],
    )
    placed = per_account.join(accounts.select(*key, "region"), key)
    return placed.groupBy("region").agg(*[F.sum(m).alias(m) for m in measures])


def overall_totals(transactions: DataFrame) -> DataFrame:
    return transaction_totals(transactions)


def run_append(stream: DataFrame, out: str, checkpoint: str) -> None:
    """Append finished rows to a Parquet folder."""
    (
        stream.writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )


def _run_batches(stream: DataFrame, write, checkpoint: str, mode: str) -> None:
    (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .outputMode(mode)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )


def run_regional_totals(stream: DataFrame, accounts: DataFrame, out: str, checkpoint: str) -> None:
    """Write the regional totals of each micro-batch to its own folder; a replayed batch replaces itself.

    A micro-batch is aggregated per account before it meets the accounts, which a stateful stream could not do.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        regional_totals(batch, accounts).write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    _run_batches(stream, write, checkpoint, "append")


def live_regional_totals(spark: SparkSession, out: str) -> DataFrame:
    """Totals over all micro-batches so far."""
    measures = ["total_transactions", *TYPE_COUNTS, *TYPE_TOTALS]
    return spark.read.parquet(out).groupBy("region").agg(*[F.sum(m).alias(m) for m in measures])


def run_complete(stream: DataFrame, out: str, checkpoint: str) -> None:
    """Write the whole result as of each micro-batch to its own folder; a replayed batch replaces itself."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    _run_batches(stream, write, checkpoint, "complete")


def latest_totals(spark: SparkSession, out: str) -> DataFrame:
    """The totals after the last micro-batch."""
    history = spark.read.parquet(out)
    last = history.agg(F.max("batch")).first()[0]
    return history.where(F.col("batch") == last).drop("batch")
