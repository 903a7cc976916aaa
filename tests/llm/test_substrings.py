import hashlib
import random

import numpy as np
import pytest

from regiobank.llm import substrings
from regiobank.llm.queries import op10_substring_dedup


def brute_force(rows, window=20):
    first, out = {}, {}
    ordered = sorted((i, (t or "").encode().split()) for i, t in rows)
    for i, words in ordered:
        for p in range(len(words) - window + 1):
            first.setdefault(tuple(words[p : p + window]), (i, p))
    for i, words in ordered:
        gone = set()
        for p in range(len(words) - window + 1):
            if first[tuple(words[p : p + window])] < (i, p):
                gone.update(range(p, p + window))
        left = b" ".join(w for n, w in enumerate(words) if n not in gone)
        out[i] = (len(words), len(gone), hashlib.sha256(left).hexdigest())
    return out


def as_dict(df):
    rows = df.collect()
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in rows}
    assert len(got) == len(rows)
    return got


def test_query_equals_brute_force(spark, folder, documents):
    wanted = brute_force(documents)
    assert sum(v[1] for v in wanted.values()) > 1000
    assert as_dict(op10_substring_dedup(spark, folder)) == wanted


@pytest.mark.parametrize("seed", [1, 2])
def test_made_up_repeats(spark, seed):
    rng = random.Random(seed)
    shared = [" ".join(rng.choices("ab", k=rng.randint(15, 60))) for _ in range(6)]
    shared += ["x " * 45, "x y " * 30, "x " * 19, "x " * 20, "q " + "x " * 30 + "z"]
    rows = []
    for i in range(60):
        parts = [rng.choice(shared) if rng.random() < 0.5 else " ".join(rng.choices("abcde", k=rng.randint(0, 30))) for _ in range(4)]
        rows.append((i, "\n ".join(parts)))
    rng.shuffle(rows)
    got = as_dict(substrings.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(7)))
    assert got == brute_force(rows)


def test_equal_windows_have_equal_anchors():
    rng = np.random.default_rng(3)
    for letters in (2, 3, 50):
        words = rng.integers(1, 1 << 62, letters, dtype=np.uint64)[rng.integers(0, letters, 400)]
        words[100:160] = words[300:360]
        words[200:240] = words[0]
        low, high, start, count, lone = substrings.anchors(words, np.arange(400) <= 380, 20)
        of = {}
        for lo, hi, s, c in zip(low.tolist(), high.tolist(), start.tolist(), count.tolist()):
            for p in range(s, s + c):
                assert p <= lo and hi <= p + 20
                key = words[p : p + 20].tobytes()
                assert of.setdefault(key, (lo - p, hi - p)) == (lo - p, hi - p)
        assert sum(count) == 381


def test_edges(spark, table):
    long = " ".join(str(n) for n in range(20000))
    block = " ".join(f"w{n}" for n in range(25))
    rows = [(1, None), (2, ""), (3, long), (4, long + " tail"), (5, block), (None, block), (6, "a b"), (7, "a b"), (8, block), (8, block)]
    got = sorted(
        (r.doc_id or 0, r.n_words, r.n_removed, r.kept_text) for r in substrings.remove_repeats(table(rows), with_text=True).collect()
    )
    assert got == sorted([
        (0, 25, 25, ""), (1, 0, 0, None), (2, 0, 0, None), (3, 20000, 0, None), (4, 20001, 20000, "tail"),
        (5, 25, 0, None), (6, 2, 0, None), (7, 2, 0, None), (8, 25, 25, ""), (8, 25, 25, ""),
    ])
    alone = substrings.remove_repeats(table([(8, block), (8, block)])).collect()
    assert [r.n_removed for r in alone] == [0, 0]
    assert substrings.remove_repeats(table([])).collect() == []


def test_query_equals_sql(spark, folder):
    from test_decontaminate import check_sql

    check_sql(spark, folder, "op10_substring_dedup", op10_substring_dedup)
