import zlib

import numpy as np

from regiobank.llm import quality
from regiobank.llm.common import BLANK_SEPARATED, find_words, word_hashes
from regiobank.llm.queries import op3_quality


def test_held_out_accuracy(spark, folder):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    rows = op3_quality(spark, folder).collect()
    assert len(rows) == spark.read.parquet(f"{folder}/documents.parquet").count()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    judged = [(labels[r.doc_id], r.predicted) for r in rows if r.held_out and r.doc_id in labels]
    assert judged and np.mean([a == b for a, b in judged]) >= 0.9


def test_scores_are_those_of_the_vectors():
    """The logits of buckets against an average of features taken one by one."""
    rng = np.random.default_rng(1)
    weights = np.append(rng.standard_normal(1 << quality.BITS), 0).astype(np.float32)
    texts = ["", "a", "ab cd", "Été été  x\n", "aa aa aa b", " ", "é" * 50]
    got = quality.scores(weights, [t.encode() for t in texts])
    for text, score in zip(texts, got):
        data = text.encode()
        buckets, at = [0], 0
        for size in quality.SIZES:
            for i in range(len(data) - size + 1):
                value = sum(int(quality._TABLES[at + k][data[i + k]]) for k in range(size)) % (1 << 32)
                buckets.append(value >> (32 - quality.BITS))
            at += size
        words = find_words([data], BLANK_SEPARATED)
        found = quality.features([data])
        hashes = word_hashes(words).tolist()
        buckets += found.words.tolist()
        pairs = found.pairs.tolist()
        assert len(pairs) == len(hashes) and [p == 1 for p in pairs[1:]] == [a == b for a, b in zip(hashes, hashes[1:])]
        buckets += pairs[1:]
        logit = np.mean([weights[b] for b in buckets], dtype=np.float64)
        assert abs(score - 1 / (1 + np.exp(-logit))) < 1e-6


def test_edges(spark, table):
    labels = spark.createDataFrame([(1, 0), (2, 1), (3, None), (None, 1), (77, 1)], "doc_id long, label int")
    rows = [(1, None), (2, ""), (3, "word " * 40000), (None, "x y"), (4, "x"), (4, "x")]
    docs = table(rows)
    got = quality.classify(docs, labels).collect()
    assert len(got) == 6 and all(0 <= r.score <= 1 for r in got)
    assert [r.held_out for r in got if r.doc_id is None] == [True]
    same = [r.score for r in got if r.doc_id == 4]
    assert same[0] == same[1]
    kept = quality.good_documents(docs, labels, threshold=0.0)
    assert kept.columns == docs.columns and kept.count() == 6
    assert quality.good_documents(docs, labels, threshold=1.1).count() == 0
    assert quality.classify(table([]), labels).collect() == []
    none = spark.createDataFrame([], "doc_id long, label int")
    assert {r.score for r in quality.classify(docs, none).collect()} == {0.5}
