"""SimHash near-duplicates: every pair of fingerprints within a radius, by comparing tiles.

Fingerprints are grouped by the population counts of their halves and cut into tiles. Two tiles can hold a link only if
their counts differ by at most the radius in sum, so all other tile pairs are never formed. A tile pair is compared in
full with exclusive-or and bit counts, in numpy. What a pair returns are not its links, of which a group of near copies
has a square, but which groups of linked rows of the one tile meet which of the other. Spark joins then find the
components of these groups.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regiobank.llm.common import map_arrow, slices, text_hash, unused, utf8
from regiobank.llm.components import components
from regiobank.sources.scratch import stage

SHINGLE = 4
SEED = 42
RADIUS = 4
TILE_ROWS = 8192
_BLOCK = 1 << 20

_BITS = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.int64)
_COLUMN = np.arange(8, dtype=np.int64) * 256


def fingerprint(text: bytes, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """64-bit SimHash of a text's word shingles, repeats included. A bit is set if over half the hashes have it."""
    words = text.lower().split()
    if not words:
        return 0
    plain = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(plain, seed)
    blanks = np.flatnonzero(np.frombuffer(plain, dtype=np.uint8) == 0x20)
    starts = [0, *(blanks[: len(words) - shingle] + 1).tolist()]
    ends = [*blanks[shingle - 1 :].tolist(), len(plain)]
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(plain[start:end], seed) for start, end in zip(starts, ends)], dtype="<u8")
    seen = np.bincount((hashes.view(np.uint8).reshape(-1, 8) + _COLUMN).ravel(), minlength=2048).reshape(8, 256)
    set_bits = (seen @ _BITS).ravel() * 2 > len(hashes)
    return int.from_bytes(np.packbits(set_bits, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """(doc_id, fp): the fingerprint of every row's whole text as a signed long. Null and wordless texts get 0."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = np.array([fingerprint(text, shingle, seed) for text in utf8(batch.column("text"))], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found.view(np.int64))], ["doc_id", "fp"])

    return map_arrow(docs.select(F.col("doc_id").cast("long"), "text"), work, "doc_id long, fp long")


# ---- tiles ----


def _near(one: np.ndarray, others: np.ndarray, radius: int) -> np.ndarray:
    return np.bitwise_count(one ^ others) <= radius


def local_groups(fps: np.ndarray, nodes: np.ndarray, radius: int) -> np.ndarray:
    """Smallest node that each row reaches by links within the tile; memory stays in proportion to the tile."""
    roots = nodes.copy()
    open_rows = np.arange(len(fps))
    while len(open_rows):
        group, open_rows = [open_rows[:1]], open_rows[1:]
        todo = [int(group[0][0])]
        while todo and len(open_rows):
            hit = _near(fps[todo.pop()], fps[open_rows], radius)
            if hit.any():
                group.append(open_rows[hit])
                todo.extend(open_rows[hit].tolist())
                open_rows = open_rows[~hit]
        rows = np.concatenate(group)
        roots[rows] = nodes[rows].min()
    return roots


def _cells(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order of rows by the bit counts of their quarters, the different counts, and where their rows begin and end."""
    counts = np.stack([np.bitwise_count((fps >> np.uint64(at)) & np.uint64(0xFFFF)) for at in (48, 32, 16, 0)], axis=1).astype(np.int64)
    order = np.lexsort(counts.T)
    new = np.flatnonzero((np.diff(counts[order], axis=0) != 0).any(axis=1)) + 1
    bounds = np.concatenate([[0], new, [len(fps)]])
    return order, counts[order[bounds[:-1]]], bounds


def _links(fps: np.ndarray, roots: np.ndarray, fps2: np.ndarray, roots2: np.ndarray, radius: int) -> list[np.ndarray]:
    met = []
    rows = max(1, _BLOCK // max(1, len(fps2)))
    for at in range(0, len(fps), rows):
        one, two = np.nonzero(_near(fps[at : at + rows, None], fps2[None, :], radius))
        if len(one):
            met.append(np.unique(np.stack([roots[at + one], roots2[two]], axis=1), axis=0))
    return met


def meeting_groups(fps: np.ndarray, roots: np.ndarray, fps2: np.ndarray, roots2: np.ndarray, radius: int) -> np.ndarray:
    """Distinct pairs of groups (one of each tile) between which there is a link.

    In large tiles rows are grouped by the bit counts of their quarters, and the same skipping is done among these.
    """
    if len(fps) * len(fps2) <= _BLOCK:
        met = _links(fps, roots, fps2, roots2, radius)
    else:
        met = []
        order, counts, bounds = _cells(fps)
        order2, counts2, bounds2 = _cells(fps2)
        for number, mine in enumerate(counts):
            near = np.flatnonzero(np.abs(counts2 - mine).sum(axis=1) <= radius)
            if len(near):
                rows = order[bounds[number] : bounds[number + 1]]
                others = np.concatenate([order2[bounds2[n] : bounds2[n + 1]] for n in near.tolist()])
                met += _links(fps[rows], roots[rows], fps2[others], roots2[others], radius)
    return np.unique(np.concatenate(met), axis=0) if met else np.empty((0, 2), dtype=np.int64)


def _tiles(known: DataFrame, radius: int, tile_rows: int) -> DataFrame:
    """known: fp, node. One row per tile: the counts of both halves, and arrays of fingerprints, nodes and local roots."""
    high, low = F.bit_count(F.shiftrightunsigned("fp", 32)), F.bit_count(F.col("fp").bitwiseAND((1 << 32) - 1))
    rows = known.select("fp", "node", high.alias("high"), low.alias("low"))
    parts = rows.groupBy("high", "low").agg(F.ceil(F.count(F.lit(1)) / tile_rows).alias("parts"))  # 33 * 33 rows at most
    rows = rows.join(parts, ["high", "low"]).withColumn("part", F.expr("pmod(xxhash64(fp), parts)")).drop("parts")

    def work(tile: pd.DataFrame) -> pd.DataFrame:
        tile = tile.sort_values("fp")
        fps, nodes = tile["fp"].to_numpy(np.int64), tile["node"].to_numpy(np.int64)
        roots = local_groups(fps.view(np.uint64), nodes, radius)
        first = tile.iloc[0]
        return pd.DataFrame(
            [(int(first["high"]), int(first["low"]), int(first["part"]), fps, nodes, roots)],
            columns=["high", "low", "part", "fps", "nodes", "roots"],
        )

    schema = "high int, low int, part long, fps array<long>, nodes array<long>, roots array<long>"
    return rows.groupBy("high", "low", "part").applyInPandas(work, schema)


def _tile_pairs(tiles: DataFrame, radius: int) -> DataFrame:
    """Pairs of different tiles whose population counts differ by the radius at most, each pair once."""
    steps = [(h, w) for h in range(-radius, radius + 1) for w in range(-radius, radius + 1) if abs(h) + abs(w) <= radius]
    steps = F.array(*[F.struct(F.lit(h).alias("h"), F.lit(w).alias("w")) for h, w in steps if (h, w) >= (0, 0)])
    left = tiles.select("*", F.explode(steps).alias("step")).select(
        (F.col("high") + F.col("step.h")).alias("high"),
        (F.col("low") + F.col("step.w")).alias("low"),
        ((F.col("step.h") == 0) & (F.col("step.w") == 0)).alias("same"),
        F.col("part").alias("part1"),
        F.col("fps").alias("fps1"),
        F.col("roots").alias("roots1"),
    )
    pairs = left.join(tiles.select("high", "low", "part", "fps", "roots"), ["high", "low"])
    return pairs.where(~F.col("same") | (F.col("part1") < F.col("part"))).select("fps1", "roots1", "fps", "roots")


def _flat(column: pa.Array, kind: type) -> list[np.ndarray]:
    values, offsets = column.values.to_numpy(), column.offsets.to_numpy()
    return [values[a:b].view(kind) for a, b in zip(offsets[:-1], offsets[1:])]


def near_groups(known: DataFrame, radius: int = RADIUS, tile_rows: int = TILE_ROWS) -> DataFrame:
    """(fp, root) for the distinct fingerprints of `known` (fp, node: longs, no nulls).

    root is the smallest node that the fingerprint reaches over links of at most `radius` differing bits.
    """
    tiles = stage(_tiles(known, radius, tile_rows), "tiles")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [_flat(batch.column(i), (np.uint64, np.int64)[i % 2]) for i in range(4)]
            for fps1, roots1, fps, roots in zip(*columns):
                met = meeting_groups(fps1, roots1, fps, roots, radius)
                if len(met):
                    yield pa.RecordBatch.from_arrays([pa.array(met[:, 0]), pa.array(met[:, 1])], ["a", "b"])

    links = map_arrow(_tile_pairs(tiles, radius), work, "a long, b long")
    roots = components(links)
    local = tiles.select(F.explode(F.arrays_zip("fps", "roots")).alias("x")).select("x.fps", "x.roots")
    found = local.join(roots, local["roots"] == roots["node"], "left")
    return found.select(F.col("fps").alias("fp"), F.coalesce("root", "roots").alias("root"))


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, tile_rows: int = TILE_ROWS) -> DataFrame:
    """One row per row of `docs` (doc_id, text): doc_id, fp (long), component_id.

    component_id is the smallest doc_id that can be reached over links, the row's own included. Rows of equal
    fingerprint are linked, so empty and null texts (fingerprint 0) form one component. A row without doc_id is
    fingerprinted but takes no part in links and has no component_id. Rows that repeat a doc_id each get a row; where
    their texts differ, the doc_id may connect the components of these texts. Other columns are ignored. An empty
    table gives an empty result.
    """
    rows = stage(fingerprints(docs, shingle), "fingerprints")
    known = rows.where("doc_id IS NOT NULL").groupBy("fp").agg(F.min("doc_id").alias("node"))
    joined = rows.join(near_groups(known, radius, tile_rows), "fp", "left")
    return joined.select("doc_id", "fp", F.when(F.col("doc_id").isNotNull(), F.col("root")).alias("component_id"))


def keep_one(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """The row of the smallest doc_id of each component, with all its columns.

    Of rows that share this doc_id the one of the least text hash stays. Rows without doc_id can't be told apart and
    take no part in links, so all of them stay.
    """
    found = stage(near_duplicates(docs, shingle, radius), "components")
    roots = found.where("doc_id = component_id").select("doc_id").distinct()
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_hash(F.col("text")).alias("rid"))
    own_id, own_rid = unused(docs, "_id", "_rid")
    first = texts.join(roots, "doc_id").groupBy("doc_id").agg(F.min("rid").alias(own_rid)).withColumnRenamed("doc_id", own_id)
    mine = (F.col("doc_id").cast("long") == F.col(own_id)) & (text_hash(F.col("text")) == F.col(own_rid))
    kept = docs.join(first, mine).dropDuplicates([own_id]).select(*[F.col(f"`{name}`") for name in docs.columns])
    return kept.unionByName(docs.where(F.col("doc_id").isNull()))
