import random

import numpy as np
import xxhash

from regiobank.llm import simhash
from regiobank.llm.queries import op9_simhash


def plain_fingerprint(text, k=4):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    grams = [b" ".join(words[i : i + k]) for i in range(len(words) - k + 1)] or [b" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints, radius):
    ids = sorted(prints)
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            if (prints[a] ^ prints[b]).bit_count() <= radius:
                a1, b1 = find(a), find(b)
                root[max(a1, b1)] = min(a1, b1)
    return {i: find(i) for i in ids}


def test_query_equals_brute_force(spark, folder, documents):
    prints = {i: plain_fingerprint(t) for i, t in documents}
    wanted = plain_components(prints, 4)
    got = op9_simhash(spark, folder).collect()
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in got} == {i: (f"{prints[i]:016x}", wanted[i]) for i in prints}
    assert len(got) == len(documents)


def test_chains_over_many_tiles(spark):
    rng = random.Random(5)
    prints, at = {}, 0
    for _ in range(30):
        value = rng.getrandbits(64)
        for _ in range(rng.choice([1, 2, 12, 40])):
            prints[at] = value
            at += 1
            for _ in range(rng.randint(0, 4)):
                value ^= 1 << rng.randrange(64)
    known = {}
    for i, value in prints.items():
        known.setdefault(value, i)
    rows = [(v - (1 << 64) if v >> 63 else v, i) for v, i in known.items()]
    found = simhash.near_groups(spark.createDataFrame(rows, "fp long, node long"), 4, tile_rows=3).collect()
    got = {r.fp % (1 << 64): r.root for r in found}
    wanted = plain_components(prints, 4)
    assert {i: got[v] for i, v in prints.items()} == wanted


def test_large_tiles_skip_without_loss(monkeypatch):
    rng = np.random.default_rng(8)
    fps = rng.integers(0, 1 << 64, 3000, dtype=np.uint64)
    fps[1000:2000] = fps[:1000] ^ (np.uint64(1) << rng.integers(0, 64, 1000).astype(np.uint64))
    fps[2000:] = fps[1000:2000] ^ np.uint64(0x80000007)
    one, two = np.arange(1500), np.arange(1500, 3000)
    far = (np.bitwise_count(fps[one][:, None] ^ fps[two][None, :]) <= 4).nonzero()
    wanted = {(int(one[a]), int(two[b])) for a, b in zip(*far)}
    monkeypatch.setattr(simhash, "_BLOCK", 1000)
    got = simhash.meeting_groups(fps[one], one, fps[two], two, 4)
    assert wanted and {tuple(row) for row in got.tolist()} == wanted


def test_edges(spark, table):
    long = "aa bb cc dd ee " * 30000
    rows = [(5, None), (2, ""), (9, " \t\n"), (None, "a b"), (4, "A b"), (3, "a  B"), (3, "a b"), (8, long), (7, long), (1, "x")]
    got = sorted((r.doc_id, r.component_id) for r in simhash.near_duplicates(table(rows)).collect() if r.doc_id)
    assert got == [(1, 1), (2, 2), (3, 3), (3, 3), (4, 3), (5, 2), (7, 7), (8, 7), (9, 2)]
    lone = simhash.near_duplicates(table([(None, "a b")])).collect()
    assert [r.component_id for r in lone] == [None]
    assert simhash.near_duplicates(table([])).collect() == []
