"""Exact top-k search by inner product, with the score bounds of MaxScore.

A vector is a document whose terms are its components. A query's term (a component) has a bound: the most that it can add
to any score in the shard, from the shard's largest and smallest value there. The threshold is the k-th best score so far;
it starts from the rows at the heads of the postings, those with the largest or smallest values of a term. Terms are ordered
by bound, and the essential ones are the shortest prefix whose remaining bounds together stay below the threshold, so a row
needs more than its non-essential terms to get among the best. The postings of the essential terms are traversed; rows whose
score there and the remaining bounds reach the threshold are then probed in the other terms, one term after the other, while
they can still compete. Essential terms differ from query to query and from shard to shard.

Rows are dealt to shards of a bounded size by a hash of the row, queries to groups of a bounded size. Every group meets
every shard in a task of its own, and the shards' results are merged by rank.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from regiobank.sources.scratch import stage
from regiobank.sources.shipping import ship_package

SHARD_ROWS = 8192
GROUP_ROWS = 2048
_EXACT = float(1 << 53)


def quantized(vectors: DataFrame, scale: int = 256) -> DataFrame:
    """(vec_id, v): floor(scale * x) of every component as a long, for vectors without null or non-finite parts.

    Vectors that are null or empty, and rows without vec_id, are left out, too.
    """
    whole = F.expr("embedding is not null and size(embedding) > 0 and forall(embedding, x -> x is not null and not isnan(x) and abs(x) < double('infinity'))")
    parts = F.transform("embedding", lambda x: F.floor(x.cast("double") * scale).cast("long"))
    return vectors.where(whole & F.col("vec_id").isNotNull()).select(F.col("vec_id").cast("long").alias("vec_id"), parts.alias("v"))


def _matrix(lists: list, width: int) -> np.ndarray:
    out = np.zeros((len(lists), width), dtype=np.int64)
    for row, values in enumerate(lists):
        out[row, : len(values)] = values
    return out


class Shard:
    """Rows of one shard, with the bounds of its terms. Numbers are exact: floats where sums stay below 2 ** 53."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.rows = ids[order], rows[order]
        self.most, self.least = self.rows.max(axis=0), self.rows.min(axis=0)
        self.peak = float(np.abs(self.rows).max()) if self.rows.size else 0.0
        self.postings = np.ascontiguousarray(self.rows.T.astype(np.float64))  # a term's weights, by row
        self._heads: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def heads(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """For each term the rows with its k largest values, and those with its k smallest."""
        if k not in self._heads:
            order = np.argsort(self.postings, axis=1, kind="stable")
            self._heads[k] = order[:, -k:], order[:, :k]
        return self._heads[k]

    def start(self, q: np.ndarray, others: np.ndarray, k: int) -> float:
        """The k-th best score of the rows at the heads of the query's postings."""
        large, small = self.heads(k)
        rows = np.unique(np.where((q >= 0)[:, None], large, small))
        rows = rows[others[rows]]
        if len(rows) < k:
            return -np.inf
        scores = q @ self.postings[:, rows]
        return float(np.partition(scores, len(rows) - k)[len(rows) - k])

    def split(self, q: np.ndarray, threshold: float) -> tuple[np.ndarray, int, np.ndarray]:
        """Terms by falling bound, how many of them are essential, and what the terms from each place on can add."""
        bound = np.maximum(q * self.most, q * self.least)
        terms = np.argsort(-bound, kind="stable")
        rest = np.concatenate([[0.0], np.cumsum(bound[terms][::-1])])[::-1]
        below = np.flatnonzero(rest < threshold)
        return terms, int(below[0]) if len(below) else len(terms), rest

    def search(self, query: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The k best (row ids, scores), ties to smaller ids; rows with the query's own id are no candidates."""
        if self.peak * float(np.abs(query).max(initial=0)) * len(query) >= _EXACT:
            return self._search_large(query, own, k)
        q, others = query.astype(np.float64), self.ids != own
        threshold = self.start(q, others, k)
        terms, essential, rest = self.split(q, threshold)
        score = q[terms[:essential]] @ self.postings[terms[:essential]]
        alive = np.flatnonzero(others & (score + rest[essential] >= threshold))
        score = score[alive]
        for done in range(essential, len(terms)):
            if len(alive) > k:
                sure = score + self._floor(q, terms[done:])
                threshold = max(threshold, np.partition(sure, len(sure) - k)[len(sure) - k])
                keep = score + rest[done] >= threshold
                alive, score = alive[keep], score[keep]
            score = score + q[terms[done]] * self.postings[terms[done], alive]
        return self._best(alive, score, k)

    def _floor(self, q: np.ndarray, terms: np.ndarray) -> float:
        """Least that some terms can add to a score."""
        return float(np.minimum(q[terms] * self.most[terms], q[terms] * self.least[terms]).sum())

    def _best(self, alive: np.ndarray, score: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        order = np.lexsort((self.ids[alive], -score))[:k]
        return self.ids[alive[order]], score[order].astype(np.int64)

    def _search_large(self, query: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Plain integers of any size; scores beyond a long become the nearest long."""
        parts = query.tolist()
        found = sorted((-sum(a * b for a, b in zip(parts, row)), i) for i, row in zip(self.ids.tolist(), self.rows.tolist()) if i != own)[:k]
        limits = [min(max(-s, -(1 << 63)), (1 << 63) - 1) for s, _ in found]
        return np.array([i for _, i in found], dtype=np.int64), np.array(limits, dtype=np.int64)


def top_k(rows: DataFrame, queries: DataFrame, k: int = 5, shard_rows: int = SHARD_ROWS, group_rows: int = GROUP_ROWS) -> DataFrame:
    """query_id, rank, vec_id, score: the k best rows for each query, ties to the smaller vec_id.

    rows and queries: vec_id and v (longs), as from `quantized`. A row is no candidate for a query of its own vec_id.
    Vectors of different lengths are compared as if filled up with zeros. Rows that repeat each count; queries that
    repeat are answered once per distinct vector. An empty table on either side gives an empty result.
    """
    ship_package(rows.sparkSession)
    queries = queries.distinct()
    totals = rows.agg(F.count(F.lit(1)), F.max(F.size("v"))).first(), queries.agg(F.count(F.lit(1)), F.max(F.size("v"))).first()
    width = max(totals[0][1] or 0, totals[1][1] or 0)
    shards, groups = max(1, -(-totals[0][0] // shard_rows)), max(1, -(-totals[1][0] // group_rows))
    spread = F.xxhash64("vec_id", "v", F.monotonically_increasing_id())  # rows that repeat spread, too
    dealt = rows.withColumn("shard", F.pmod(spread, F.lit(shards))).withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    asked = queries.withColumn("group", F.pmod(F.xxhash64("vec_id", "v"), F.lit(groups)).cast("int"))
    asked = asked.withColumn("shard", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))))

    def search(mine: pd.DataFrame, theirs: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(mine) and len(theirs):
            shard = Shard(mine["vec_id"].to_numpy(np.int64), _matrix(mine["v"].tolist(), width))
            for number, (query_id, vector) in enumerate(zip(theirs["vec_id"].tolist(), _matrix(theirs["v"].tolist(), width))):
                ids, scores = shard.search(vector, query_id, k)
                out.append((np.full(len(ids), query_id), np.full(len(ids), theirs["nth"].iloc[number]), ids, scores))
        columns = [np.concatenate(parts) for parts in zip(*out)] if out else [np.empty(0, np.int64)] * 4
        return pd.DataFrame(dict(zip(("query_id", "nth", "vec_id", "score"), columns)))

    asked = asked.withColumn("nth", F.xxhash64("v"))
    pairs = dealt.groupBy("shard", "group").cogroup(asked.groupBy("shard", "group"))
    found = pairs.applyInPandas(search, "query_id long, nth long, vec_id long, score long")
    order = Window.partitionBy("query_id", "nth").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def search_embeddings(vectors: DataFrame, every: int = 50, k: int = 5) -> DataFrame:
    """`top_k` of the rows whose vec_id is divisible by `every` against all rows of `vectors` (vec_id, embedding).

    Vectors that are null, empty, or hold null or non-finite components take no part, nor do rows without vec_id.
    Other columns are ignored.
    """
    rows = stage(quantized(vectors), "quantized")
    return top_k(rows, rows.where(F.col("vec_id") % every == 0), k)
