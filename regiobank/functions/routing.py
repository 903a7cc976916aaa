"""Shard routing as column expressions: no lookup join, no Python UDF."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from regiobank.model import ROUTES, ROUTING, Route


def routing_table(spark: SparkSession, routes: Iterable[Route] = ROUTES) -> DataFrame:
    """The routing metadata as a table; one row per shard."""
    rows = [
        (r.shard_id, r.shard_name, r.region, r.first_id, r.last_id, None, r.hostname, r.port, r.status, None, None)
        for r in routes
    ]
    return spark.createDataFrame(rows, ROUTING)


def find_route(rows: DataFrame, table: DataFrame, user_id: str = "user_id") -> DataFrame:
    """Add `shard_id`, that of the active route of a metadata table which holds the user id, else NULL.

    Where routes overlap it is that of the smallest shard_id. Ids meet routes of the same stretch of ids; a stretch is as long as the longest route, so a route is in two at most.
    """
    active = table.where("status = 'ACTIVE' AND user_id_range_start <= user_id_range_end")
    width = active.agg(F.max(F.col("user_id_range_end") - F.col("user_id_range_start") + 1)).first()[0] or 1
    stretches = active.selectExpr(
        "shard_id",
        "user_id_range_start AS _low",
        "user_id_range_end AS _high",
        f"explode(sequence(user_id_range_start div {width}, user_id_range_end div {width})) AS _stretch",
    )
    # within a stretch the ranges are cut where one begins or ends, and of overlapping ones the first shard has the cut;
    # there are as many cuts as routes
    cuts = stretches.selectExpr("_stretch", "explode(array(_low, _high + 1)) AS _from").distinct()
    to = F.lead("_from").over(Window.partitionBy("_stretch").orderBy("_from")) - 1
    cuts = cuts.withColumn("_to", to).join(stretches, "_stretch").where("_low <= _from AND _to <= _high")
    first = cuts.groupBy("_stretch", "_from", "_to").agg(F.min("shard_id").alias("shard_id"))
    held = (F.expr(f"{user_id} div {width}") == F.col("_stretch")) & F.col(user_id).between(F.col("_from"), F.col("_to"))
    return rows.join(first, held, "left").select(*rows.columns, "shard_id")


def find_region_route(rows: DataFrame, table: DataFrame, region: str = "region") -> DataFrame:
    """Add `shard_id`, that of the active route of a region in any letter case, else NULL."""
    active = table.where("status = 'ACTIVE'").selectExpr("shard_id", "region AS _region")
    return rows.join(active, F.upper(region) == F.col("_region"), "left").select(*rows.columns, "shard_id")


def routing_view(table: DataFrame) -> DataFrame:
    """Routing metadata with the size of each id range."""
    return table.select(
        "shard_id",
        "shard_name",
        "region",
        "user_id_range_start",
        "user_id_range_end",
        "hostname",
        "port",
        "status",
        (F.col("user_id_range_end") - F.col("user_id_range_start") + 1).alias("id_range_size"),
    ).orderBy("shard_id")


def _first_match(arms: list[tuple[Column, Column]], otherwise: Column) -> Column:
    if not arms:
        return otherwise
    result = F.when(*arms[0])
    for condition, value in arms[1:]:
        result = result.when(condition, value)
    return result.otherwise(otherwise)


def user_shard(user_id: Column, routes: Iterable[Route] = ROUTES) -> Column:
    """Shard tag that holds a user id; 'UNKNOWN' outside every range and for NULL."""
    arms = [(user_id.between(r.first_id, r.last_id), F.lit(r.tag)) for r in routes]
    return _first_match(arms, F.lit("UNKNOWN"))


def user_shard_id(user_id: Column, routes: Iterable[Route] = ROUTES) -> Column:
    """Shard id of a user id among the active shards, else NULL."""
    arms = [(user_id.between(r.first_id, r.last_id), F.lit(r.shard_id)) for r in routes if r.status == "ACTIVE"]
    return _first_match(arms, F.lit(None)).cast("bigint")


def region_shard_id(region: Column, routes: Iterable[Route] = ROUTES) -> Column:
    """Shard id of a region in any letter case among the active shards, else NULL."""
    arms = [(F.upper(region) == r.region, F.lit(r.shard_id)) for r in routes if r.status == "ACTIVE"]
    return _first_match(arms, F.lit(None)).cast("bigint")


def region_shard(region: Column, routes: Iterable[Route] = ROUTES) -> Column:
    """Shard tag rows of a region are written to, else NULL."""
    return _first_match([(F.upper(region) == r.region, F.lit(r.tag)) for r in routes], F.lit(None).cast("string"))


def region_bound(region: Column, last: bool, routes: Iterable[Route] = ROUTES) -> Column:
    """First or last user id of a region, NULL for an unknown region."""
    arms = [(F.upper(region) == r.region, F.lit(r.last_id if last else r.first_id)) for r in routes]
    return _first_match(arms, F.lit(None)).cast("bigint")


def shard_tag_of(region: str, routes: Iterable[Route] = ROUTES) -> str:
    """Shard tag of one region; an unknown region is an error."""
    for route in routes:
        if route.region == region.upper():
            return route.tag
    raise ValueError(f"unknown region: {region}")
