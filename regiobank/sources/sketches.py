"""Key sketches of the files of a store: which files may hold a key, without opening them.

Every file has a Bloom filter per key column, in pieces of 32768 bits, kept beside its run. A batch probes them with its
keys and then reads the files that answer, so its checks are exact and a file that answers wrongly only costs a read. A
file with no more keys than the batch is read without a probe, which would cost more than the read; so all probes of a
batch together are no more than the keys of the store.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regiobank.sources.manifest import Run
from regiobank.sources.scratch import stage

FOLDER = "_sketches"
PIECE = 32768
HASHES = 6
BITS_PER_KEY = 16

#: The columns by which batches ask for rows.
KEYS = {"users": ["user_id"], "accounts": ["account_id", "account_number", "user_id"]}

_PIECES = f"CAST(power(2, ceil(log2(greatest(keys * {BITS_PER_KEY} / {PIECE}, 1)))) AS BIGINT)"
_PLACE = f"pmod(xxhash64(key, seed), pieces * {PIECE})"
_PIECE_AND_BIT = [f"{_PLACE} div {PIECE} AS piece", f"{_PLACE} % {PIECE} AS bit"]
_IS_SET = "shiftright(CAST(conv(hex(substring(bits, CAST(bit div 8 + 1 AS INT), 1)), 16, 10) AS INT), CAST(bit % 8 AS INT)) & 1 = 1"
# a bit within the hexadecimal digits of its word, so that bytes come in order and the lowest bit of a byte first
_IN_WORD = "shiftleft(1L, CAST((bit ^ 56) & 63 AS INT))"
_ZEROS = "repeat('0', CAST(16 * (x.word - coalesce(get(words, i - 1).word, -1) - 1) AS INT))"
_DIGITS = f"array_join(transform(words, (x, i) -> concat({_ZEROS}, lpad(hex(x.bits), 16, '0'))), '')"
_BYTES = f"unhex(rpad({_DIGITS}, {PIECE // 4}, '0'))"
_SEEDS = f"explode(sequence(1, {HASHES})) AS seed"


def write_sketches(spark: SparkSession, root: str, run: Run) -> None:
    """Sketches of the files of a run that has been written."""
    if run.table not in KEYS:
        return
    kinds = ", ".join(f"{name} {'string' if name == 'account_number' else 'bigint'}" for name in KEYS[run.table])
    rows = spark.read.schema(f"{kinds}, shard_location string").parquet(f"{root}/{run.path}")
    # the file below its shard's folder
    file = F.col("_metadata.file_name").alias("file")
    pairs = F.explode(F.array(*[F.struct(F.lit(name).alias("column"), F.col(name).cast("string").alias("key")) for name in KEYS[run.table]])).alias("x")
    keys = rows.select("shard_location", file, pairs).select("shard_location", "file", "x.column", "x.key").where("key IS NOT NULL")
    place = ["shard_location", "file", "column"]
    _sketches(keys).write.parquet(f"{root}/{FOLDER}/{run.path}")


def _sketches(keys: DataFrame) -> DataFrame:
    """The pieces of the Bloom filters of some keys, by shard, file and column.

    Bits meet in words of 64 in a hash table, in which a filter is named by a number. To make bitmaps of them at once would
    sort a row per bit, with the names of its file, and spill.
    """
    place = ["shard_location", "file", "column"]
    # a row per file and column
    sizes = keys.groupBy(*place).agg(F.count(F.lit(1)).alias("keys")).selectExpr(*place, f"{_PIECES} AS pieces")
    sizes = stage(sizes.withColumn("filter", F.monotonically_increasing_id()), "sizes")
    bits = keys.join(sizes, place).selectExpr("filter", "pieces", "key", _SEEDS).selectExpr("filter", *_PIECE_AND_BIT)
    words = bits.groupBy("filter", "piece", F.expr("bit div 64").alias("word")).agg(F.bit_or(F.expr(_IN_WORD)).alias("bits"))
    ordered = F.array_sort(F.collect_list(F.struct("word", "bits"))).alias("words")
    whole = words.groupBy("filter", "piece").agg(ordered).selectExpr("filter", "piece", f"{_BYTES} AS bits")
    return whole.join(sizes, "filter").select(*place, "pieces", "piece", "bits")


def candidate_files(spark: SparkSession, root: str, runs: list[Run], keys: DataFrame, column: str) -> list[str]:
    """Paths of the files of some runs of a table that may hold any of `keys` (`column`, and shard_location if it is
    there). Every file that holds one is among them."""
    if not runs:
        return []
    reader = spark.read.schema("shard_location string, file string, column string, pieces bigint, piece bigint, bits binary, run string")
    table = runs[0].table
    sketches = reader.option("basePath", f"{root}/{FOLDER}/{table}").parquet(*[f"{root}/{FOLDER}/{run.path}" for run in runs])
    sketches = sketches.where(F.col("column") == column)
    shard = [name for name in ("shard_location",) if name in keys.columns]
    asked = keys.dropna(subset=[column]).select(*shard, F.col(column).cast("string").alias("key")).distinct()
    names, count = ["run", "shard_location", "file"], asked.count()
    probed = f"pieces * {PIECE} div {BITS_PER_KEY} > {count}"
    read = sketches.where(f"NOT ({probed})").select(*names).distinct()
    if shard:
        read = read.join(asked.select(*shard).distinct(), shard, "left_semi")
    sketches = sketches.where(probed)
    # sizes are powers of two, so there are few
    sizes = [row["pieces"] for row in sketches.select("pieces").distinct().collect()]
    probes = asked.select("*", F.explode(F.array(*map(F.lit, sizes)).cast("array<bigint>")).alias("pieces"))
    probes = probes.selectExpr(*shard, "key", "pieces", _SEEDS).selectExpr(*shard, "key", "pieces", "seed", *_PIECE_AND_BIT)
    found = probes.join(sketches, [*shard, "pieces", "piece"]).where(_IS_SET)
    held = found.groupBy("run", "shard_location", "file", "key").agg(F.count(F.lit(1)).alias("hits")).where(F.col("hits") == HASHES)
    # names of files, as many as Spark lists for a table at most
    files = held.select(*names).unionByName(read.select(*names)).distinct().collect()
    return sorted(f"{root}/{table}/run={row['run']}/shard_location={row['shard_location']}/{row['file']}" for row in files)
