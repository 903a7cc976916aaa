"""Left joins whose work stays balanced."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regiobank.sources.scratch import stage


def left_lookup(rows: DataFrame, table: DataFrame, on: list[str]) -> DataFrame:
    """Left join on equal columns. Rows whose last key is NULL find nothing; a plain join would still send all of
    them to one task, here they spread by their content.
    """
    *others, last = on
    kind = rows.schema[last].dataType
    spread = F.coalesce(F.col(last), F.xxhash64(*rows.columns).cast(kind))
    keyed = rows.withColumn("_key", spread)
    right = table.select(*[F.col(c).alias(f"_on_{c}" if c in on else c) for c in table.columns])
    matched = (F.col("_key") == F.col(f"_on_{last}")) & F.col(last).isNotNull()
    for name in others:
        matched = matched & (F.col(name) == F.col(f"_on_{name}"))
    found = [F.col(c) for c in table.columns if c not in on]
    return keyed.join(right, matched, "left").select(*rows.columns, *found)


def references(rows: DataFrame, columns: list[str], key: str, *others: str) -> DataFrame:
    """Distinct values of the given columns, under one name; a busy value is one row per task before any shuffle."""
    return _named(rows, columns, key, *others).distinct()


def reference_counts(rows: DataFrame, columns: list[str], key: str, count: str) -> DataFrame:
    """Distinct values of the given columns, and how many rows name each."""
    return _named(rows, columns, key).groupBy(key).agg(F.count(F.lit(1)).alias(count))


def _named(rows: DataFrame, columns: list[str], key: str, *others: str) -> DataFrame:
    values = F.array_distinct(F.array_compact(F.array(*columns)))
    return rows.select(*others, F.explode(values).alias(key))


def unknown_references(rows: DataFrame, table: DataFrame, shard: str, columns: list[str], key: str) -> DataFrame:
    """Values of the given columns that no row of the table has on the same shard.

    Few are unknown as a rule. They are written, so that their size is known and marking the rows that hold them
    needs no shuffle of the rows.
    """
    referenced = references(rows, columns, key, shard)
    return stage(referenced.join(table.select(shard, key), [shard, key], "left_anti"), "unknown")
