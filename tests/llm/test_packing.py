import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from regiobank.llm import packing
from regiobank.llm.queries import op6_packing

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)


def ids_of(text):
    return np.array([*LIBRARY.encode(text or "", add_special_tokens=False).ids, 1], "<u4")


def check(rows, docs, window=2048):
    """Every id in one piece, gapless sequences, right sums, and no padding."""
    sequences, texts = defaultdict(list), defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append(r)
        texts[r.doc_id].append(r)
    for pieces in sequences.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at and r.length > 0
            at += r.length
        assert at == window or at < window and at & (at - 1) == 0
    for doc_id, text in docs:
        ids, at = ids_of(text), 0
        for r in sorted(texts[doc_id], key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids)
            assert r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    return sequences


def test_query(spark, folder, documents):
    rows = op6_packing(spark, folder).collect()
    sequences = check(rows, documents)
    total = sum(r.length for r in rows)
    assert len(sequences) <= total / 2048 + 12 * 8


def test_neighbours_share_words(spark):
    topics = ["apple pear plum grape cherry melon", "iron zinc lead gold silver copper", "river lake ocean creek pond sea"]
    docs = [(n, " ".join([topics[n % 3]] * 40)) for n in range(60)]
    df = spark.createDataFrame(docs, "doc_id long, text string").coalesce(1)
    sequences = check(packing.pack_documents(df, PATH).collect(), docs)
    same = [len({r.doc_id % 3 for r in pieces}) == 1 for pieces in sequences.values()]
    assert sum(same) >= 0.6 * len(same)


def bm25(docs):
    """Score of every document for all terms of one, by the formula."""
    counts, mean = [Counter(d) for d in docs], sum(map(len, docs)) / len(docs)
    held = Counter(t for c in counts for t in c)

    def score(query, doc):
        total = 0.0
        for term in counts[query].keys() & counts[doc].keys():
            n = counts[doc][term]
            idf = math.log(1 + (len(docs) - held[term] + 0.5) / (held[term] + 0.5))
            total += idf * n * 2.2 / (n + 1.2 * (0.25 + 0.75 * len(docs[doc]) / mean))
        return total

    return score


def indexed(docs, size):
    lengths, held = np.array([len(d) for d in docs]), np.zeros(size, dtype=np.int64)
    for d in docs:
        held[np.unique(d)] += 1
    idf = packing.inverse_frequency(held, len(docs))
    return packing.Shard(np.concatenate([np.array(d) for d in docs]), lengths, idf, lengths.mean()), lengths, idf


def some_docs(seed, count, size, most):
    rng = random.Random(seed)
    return [[int(size * rng.random() ** 2) for _ in range(rng.randint(1, most))] for _ in range(count)]


def test_scores_equal_the_formula():
    docs = some_docs(1, 40, 50, 60)
    index, _, _ = indexed(docs, 50)
    score = bm25(docs)
    for query in range(40):
        assert index.scores(query) == pytest.approx([score(query, doc) for doc in range(40)])


def test_packing_equals_plain_form():
    docs = some_docs(2, 60, 40, 30)
    index, lengths, _ = indexed(docs, 40)
    left, wanted = {n: len(d) for n, d in enumerate(docs)}, []
    for seed in sorted(left, key=lambda n: (-len(docs[n]), n)):
        room, sequence = 32, []
        if left[seed]:
            scores = index.scores(seed)
            for doc in [seed, *sorted((n for n in left if n != seed), key=lambda n: (-scores[n], n))]:
                used = min(left[doc], room)
                if used:
                    sequence.append((doc, len(docs[doc]) - left[doc], used))
                    left[doc], room = left[doc] - used, room - used
            wanted.append(sequence)
    assert packing.pack(index, lengths, 32) == wanted


def test_keys_are_the_strongest_terms():
    docs = [*some_docs(3, 30, 40, 30), [7], [7, 7, 8]]
    _, lengths, idf = indexed(docs, 40)
    keys = packing.lexical_keys(np.concatenate([np.array(d) for d in docs]), lengths, idf).T.tolist()
    for doc, key in zip(docs, keys):
        counts = Counter(doc)
        wanted = sorted(counts, key=lambda t: (-counts[t] * idf[t], t))[:4]
        assert key == wanted + [-1] * (4 - len(wanted))


def rests_of(spark, texts, parts):
    """Rests by document in a table of several parts, and what the operator needs besides."""
    rests = [ids[len(ids) // 2048 * 2048 :] for ids in map(ids_of, texts)]
    _, lengths, idf = indexed(rests, LIBRARY.get_vocab_size())
    rows = [(n, 0, len(r), bytearray(r.astype(np.uint16).tobytes())) for n, r in enumerate(rests)]
    df = spark.createDataFrame(rows, "doc_id long, start long, doc_tokens long, ids binary").repartition(parts)
    return rests, packing.keyed_rests(df, idf, np.uint16)


def recall(keyed, shards, rests, every):
    """Share of the ten best neighbours, by the formula over all rests, that are in the shard of their seed."""
    shard = dict(packing.deal(keyed, shards).select("doc_id", F.spark_partition_id()).collect())
    assert len(shard) == len(rests)
    index, _, _ = indexed(rests, LIBRARY.get_vocab_size())
    found = []
    for seed in range(0, len(rests), every):
        best = [n for n in np.argsort(-index.scores(seed), kind="stable").tolist() if n != seed][:10]
        found += [shard[n] == shard[seed] for n in best]
    return sum(found) / len(found)


def test_recall_whatever_the_input_splits(spark, documents):
    rests, keyed = rests_of(spark, [text for _, text in documents], 8)
    assert sum(map(len, rests)) <= packing.SHARD_TOKENS
    assert recall(keyed, 1, rests, 5) >= 0.9


def test_close_documents_share_a_shard(spark):
    rng = random.Random(5)
    words = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=6)) for _ in range(600)]
    topics = [rng.sample(words, 30) for _ in range(24)]
    texts = [" ".join(rng.choices(topics[n % 24], k=80)) for n in range(480)]
    copies = texts + [text.replace(" ", "  ", 2) for text in texts]
    rests, keyed = rests_of(spark, copies, 8)
    shard = dict(packing.deal(keyed, 8).select("doc_id", F.spark_partition_id()).collect())
    assert sum(shard[n] == shard[n + 480] for n in range(480)) >= 0.9 * 480
    assert recall(keyed, 8, rests, 7) >= 2 / 8


def test_hot_key_spreads(spark):
    rests, keyed = rests_of(spark, ["one text for all"] * 900 + [f"text {n}" for n in range(100)], 4)
    sizes = Counter(r[0] for r in packing.deal(keyed, 8).select(F.spark_partition_id()).collect())
    assert len(sizes) == 8 and max(sizes.values()) <= 2 * 1000 / 8


def test_edges(spark, table):
    docs = [(1, None), (2, ""), (3, "word " * 30000), (4, "<|endoftext|> a  b\n\n c " * 50), (5, "é" * 2047)]
    check(packing.pack_documents(table(docs), PATH).collect(), docs)
    check(packing.pack_documents(table(docs), PATH, shard_tokens=100, shard_rows=1).collect(), docs)
    rows = packing.pack_documents(table([(7, "a b"), (7, "a b"), (None, "a b")]), PATH).collect()
    assert sum(r.length for r in rows) == 3 * len(ids_of("a b"))
    assert packing.pack_documents(table([]), PATH).collect() == []


def test_encoder_equals_library():
    code = packing.Encoder(PATH)
    assert code.fast is not None
    texts = ["", " a", "We'll  see\n\n the\tend ", "Été ñandú ÄÖÜß", "日本 😀", "x <|endoftext|> y", "’quote’ – 12½", "a\x1cb", "-" * 70 + "ing"]
    assert [ids.tolist() for ids in code.encode(texts)] == [LIBRARY.encode(t, add_special_tokens=False).ids for t in texts]


def test_terms_are_counted_in_either_width():
    """Numbers of row and term together fit in 32 bits, or do not."""
    for rows in (3, 70_000):
        lengths = np.array([2] * rows)
        ids = np.tile(np.array([50_000, 7, 7, 7], dtype=np.uint32), rows)[: 2 * rows]
        row, term, times = packing.term_counts(ids, lengths, 50_001)
        even = {0: [(7, 1), (50_000, 1)], 1: [(7, 2)]}
        want = [(r, t, n) for r in range(rows) for t, n in even[r % 2]]
        assert list(zip(row.tolist(), term.tolist(), times.tolist())) == want
