"""Daily volume of a feed that repeats rows and brings some late.

A day closes when the latest row seen is some days past it. Rows that come for a closed day are not dropped but kept as its
corrections, and a row that comes again, in the same micro-batch or any time later, counts once. The ids seen so far are
kept by day, so a micro-batch looks them up among its own days only.

Every micro-batch writes its own folders and reads those of the batches before it, so a replay replaces what it wrote.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from regiobank.plans.dashboard import TYPE_COUNTS, volume_measures
from regiobank.sources.scratch import scratch_scope, stage

DAYS_OPEN = 1
MEASURES = ["transaction_count", "total_amount", *TYPE_COUNTS]
SEEN = "event_id bigint, batch bigint, day date"
VOLUMES = "day date, late boolean, transaction_count bigint, total_amount decimal(38,2), deposits bigint, withdrawals bigint, transfers bigint, batch bigint"
MARKS = "latest timestamp, batch bigint"


def _closed(day: Column, latest: Column, days_open: int) -> Column:
    """Whether a day had ended that many days before the latest row."""
    return F.coalesce((F.date_add(day, days_open + 1).cast("timestamp") <= latest), F.lit(False))


def _read(spark: SparkSession, root: str, name: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).parquet(f"{root}/{name}")


def prepare(spark: SparkSession, root: str) -> None:
    """Empty tables, so that the first micro-batch can read them."""
    for name, schema in (("seen", SEEN), ("volumes", VOLUMES), ("marks", MARKS)):
        columns = [part for part in schema.split(", ") if not part.startswith("batch ")]
        writer = spark.createDataFrame([], ", ".join(columns)).write.mode("ignore")
        (writer.partitionBy("day") if name == "seen" else writer).parquet(f"{root}/{name}/batch=-1")


def volume_batch(rows: DataFrame, batch_id: int, root: str, days_open: int = DAYS_OPEN) -> None:
    """Add a micro-batch: event_id, transaction_date, transaction_type, amount. Rows without a date count nowhere."""
    spark = rows.sparkSession
    with scratch_scope(spark):
        dated = rows.where("transaction_date IS NOT NULL").withColumn("day", F.to_date("transaction_date"))
        kept = ["transaction_date", "transaction_type", "amount"]
        # one of several copies of an id, always the same one; rows without an id cannot be told to be copies
        known = dated.where("event_id IS NOT NULL").groupBy("event_id", "day").agg(F.min(F.struct(*kept)).alias("x"))
        arrived = stage(known.select("event_id", "day", "x.*"), "arrived")
        # a batch has few days, and these folders alone are read
        days = [row["day"] for row in arrived.select("day").distinct().collect()]
        seen = _read(spark, root, "seen", SEEN).where((F.col("batch") < batch_id) & F.col("day").isin(days))
        fresh = arrived.join(seen.select("event_id", "day"), ["event_id", "day"], "left_anti")
        fresh = stage(fresh.unionByName(dated.where("event_id IS NULL").select("event_id", "day", *kept)), "fresh")
        latest = _read(spark, root, "marks", MARKS).where(F.col("batch") < batch_id).agg(F.max("latest")).first()[0]
        late = _closed(F.col("day"), F.lit(latest).cast("timestamp"), days_open).alias("late")
        volumes = fresh.groupBy("day", late).agg(*volume_measures())
        volumes = volumes.withColumn("total_amount", F.col("total_amount").cast("decimal(38,2)"))
        fresh.where("event_id IS NOT NULL").select("event_id", "day").write.mode("overwrite").partitionBy("day").parquet(f"{root}/seen/batch={batch_id}")
        volumes.write.mode("overwrite").parquet(f"{root}/volumes/batch={batch_id}")
        dated.agg(F.max("transaction_date").alias("latest")).write.mode("overwrite").parquet(f"{root}/marks/batch={batch_id}")


def run_volumes(stream: DataFrame, root: str, checkpoint: str, days_open: int = DAYS_OPEN) -> None:
    """Take what is available on a stream, then stop."""
    prepare(stream.sparkSession, root)
    (
        stream.writeStream.foreachBatch(lambda batch, batch_id: volume_batch(batch, batch_id, root, days_open))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )


def corrected_days(spark: SparkSession, root: str, days_open: int = DAYS_OPEN) -> DataFrame:
    """The closed days with all rows that came for them, and how many of these came after the day was closed."""
    latest = _read(spark, root, "marks", MARKS).agg(F.max("latest")).scalar()
    sums = (
        _read(spark, root, "volumes", VOLUMES)
        .where(_closed(F.col("day"), latest, days_open))
        .groupBy("day")
        .agg(
            *[F.sum(name).alias(name) for name in MEASURES],
            F.sum(F.when(F.col("late"), F.col("transaction_count")).otherwise(0)).alias("late_count"),
        )
    )
    return sums.select(F.date_format("day", "yyyy-MM-dd").alias("transaction_date"), *MEASURES, "late_count")
