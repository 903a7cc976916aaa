import math
import random

import numpy as np
import pytest
from test_decontaminate import check_sql

from regiobank.llm import topk
from regiobank.llm.queries import op4_top_k


def test_query_equals_sql(spark, folder):
    check_sql(spark, folder, "op4_top_k", op4_top_k)


def brute_force(rows, k=5, every=50):
    whole = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, a in {(q, tuple(a)) for q, a in whole if q % every == 0}:
        found = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in whole if i != q)[:k]
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(found)]
    return sorted(out)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_pruning_is_exact(seed):
    rng = np.random.default_rng(seed)
    rows = np.floor(rng.standard_normal((500, 24)) * rng.choice([1, 5, 60], 24)).astype(np.int64)
    rows[100:140] = rows[7]
    ids = rng.permutation(500)
    shard = topk.Shard(ids, rows)
    for row in range(0, 500, 9):
        got_ids, got = shard.search(rows[row], int(ids[row]), 5)
        wanted = sorted((-int(rows[row] @ rows[n]), int(ids[n])) for n in range(500) if n != row)[:5]
        assert [(-int(s), int(i)) for i, s in zip(got_ids, got)] == wanted


def test_essential_terms_follow_from_the_threshold():
    rng = np.random.default_rng(4)
    rows = np.floor(rng.standard_normal((800, 16)) * 40).astype(np.int64)
    shard = topk.Shard(np.arange(800), rows)
    sizes = set()
    for row in range(0, 800, 20):
        asked = rng.random(16) < rng.choice([0.2, 0.5, 1.0])
        asked[rng.integers(16)] = True
        q = rows[row].astype(np.float64) * asked
        others = np.arange(800) != row
        threshold = shard.start(q, others, 5)
        best = np.sort(rows[others] @ q)[-5]
        assert threshold <= best
        terms, essential, rest = shard.split(q, threshold)
        bound = {t: max(int(q[t]) * int(x) for x in rows[:, t]) for t in range(16)}
        assert [bound[t] for t in terms.tolist()] == sorted(bound.values(), reverse=True)
        assert sum(bound[t] for t in terms[essential:].tolist()) < threshold
        assert sum(bound[t] for t in terms[essential - 1 :].tolist()) >= threshold
        sizes.add(essential)
    assert len(sizes) > 3
    # without a threshold above zero all terms are essential
    assert shard.split(np.zeros(16), 0.0)[1] == shard.split(rows[0].astype(np.float64), -np.inf)[1] == 16


def test_many_shards_and_groups(spark):
    rng = random.Random(3)
    rows = [(n, [rng.choice([-1.0, 0.0, 0.5, 1.0]) for _ in range(6)]) for n in range(400)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    made = topk.quantized(df)
    got = topk.top_k(made, made.where("vec_id % 50 = 0"), shard_rows=37, group_rows=3).collect()
    assert sorted(tuple(r) for r in got) == brute_force(rows)


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (50, [-1.0, 0.25]), (1, None), (2, []), (3, [None, 1.0]), (4, [nan, 1.0]), (5, [1.0, -inf]), (None, [1.0, 1.0]), (6, [1.0, 2.0]), (6, [1.0, 2.0]), (7, [3e20, 1e20]), (100, [1.0])]
    df = spark.createDataFrame([(i, v, "x", 3) for i, v in rows], "vec_id long, embedding array<double>, score string, shard int")
    got = sorted(tuple(r) for r in topk.search_embeddings(df).collect())
    limit = (1 << 63) - 1
    zero = [r for r in got if r[0] == 0]
    assert zero == [(0, 1, 7, limit), (0, 2, 6, 327680), (0, 3, 6, 327680), (0, 4, 100, 65536), (0, 5, 50, -32768)]
    assert {r[0] for r in got} == {0, 50, 100}
    assert topk.search_embeddings(df.where("vec_id = 50")).collect() == []
    assert topk.search_embeddings(df.where("false")).collect() == []
