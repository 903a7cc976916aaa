"""Quality classifier: supervised subword embeddings, trained in numpy.

A text is the average of the vectors of its features, and a softmax over a linear map of that average is the score.
Features are words, pairs of neighbouring words (with one feature for a word that follows itself), and all byte n-grams
of the text, hashed into buckets whose vectors are learned. One feature belongs to every text, so empty texts have a
score too.

The logits are linear in the average, so scoring needs one learned number per bucket: the vector's share in the
difference of both logits. Scores are the same as with the vectors.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from regiobank.llm.common import BLANK_SEPARATED, find_words, map_arrow, mix, slices, unused, utf8, word_hashes

BITS = 18
SIZES = (3, 4)
WIDTH = 16
SAMPLE_ROWS = 3000
SAMPLE_CHARS = 30_000
EPOCHS = 8
RATE = 0.4
THRESHOLD = 0.3

_EVERY, _SAME = 0, 1
_TABLES = np.random.default_rng(11).integers(0, 1 << 32, (sum(SIZES), 256), dtype=np.uint32)


class Features(NamedTuple):
    """Buckets of the features of several texts: n-grams by byte, then words, then pairs; `-1` where there is none."""

    grams: list[np.ndarray]
    words: np.ndarray
    pairs: np.ndarray
    begin: np.ndarray
    sizes: np.ndarray
    bounds: np.ndarray


def features(texts: list[bytes], bits: int = BITS) -> Features:
    found = find_words(texts, BLANK_SEPARATED)
    sizes = np.array([len(text) for text in texts], dtype=np.int64)
    begin = np.cumsum(sizes + 1) - sizes - 1
    grams, table = [], iter(_TABLES)
    for size in SIZES:
        total = len(found.buffer) - size + 1
        value = np.zeros(max(total, 0), dtype=np.uint32)
        for place in range(size):
            column = next(table)
            if total > 0:
                value += column[found.buffer[place : place + total]]
        bucket = np.full(len(found.buffer), -1, dtype=np.int64)
        bucket[: len(value)] = value >> np.uint32(32 - bits)
        for back in range(size):  # n-grams that would reach into the next text
            bucket[np.maximum(begin + sizes - back, 0)] = -1
        grams.append(bucket)
    shift, hashes = np.uint64(64 - bits), word_hashes(found)
    words = (mix(hashes) >> shift).astype(np.int64)
    pairs = np.full(len(words), -1, dtype=np.int64)
    if len(words) > 1:
        pairs[1:] = (mix(hashes[1:] * np.uint64(3) + mix(hashes[:-1])) >> shift).astype(np.int64)
        pairs[1:][hashes[1:] == hashes[:-1]] = _SAME
        first = found.bounds[:-1][np.diff(found.bounds) > 0]
        pairs[first] = -1
    return Features(grams, words, pairs, begin, sizes, found.bounds)


def _sums(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    running = np.concatenate([[0.0], np.cumsum(values, dtype=np.float64)])
    return running[ends] - running[starts]


def scores(weights: np.ndarray, texts: list[bytes], bits: int = BITS) -> np.ndarray:
    """Probability of label 1 for each text; `weights` is the logit of each bucket, and 0 at the end."""
    found = features(texts, bits)
    total = np.full(len(texts), weights[_EVERY])
    count = np.ones(len(texts))
    for bucket in found.grams:
        total += _sums(weights[bucket], found.begin, found.begin + found.sizes)
        count += _sums(bucket >= 0, found.begin, found.begin + found.sizes)
    for bucket in (found.words, found.pairs):
        total += _sums(weights[bucket], found.bounds[:-1], found.bounds[1:])
        count += _sums(bucket >= 0, found.bounds[:-1], found.bounds[1:])
    return 1 / (1 + np.exp(-np.clip(total / count, -50, 50)))


class _Rows:
    """Distinct buckets of each text and their shares, a few texts to an array."""

    def __init__(self, texts: list[bytes], bits: int, together: int = 64):
        self.together, self.parts = together, []
        for at in range(0, len(texts), together):
            found = features(texts[at : at + together], bits)
            rows = [self._distinct(found, text) for text in range(len(found.sizes))]
            bounds = np.cumsum([0, *(len(bucket) for bucket, _ in rows)])
            bucket = np.concatenate([bucket for bucket, _ in rows]).astype(np.int32)
            self.parts.append((bucket, np.concatenate([share for _, share in rows]), bounds))

    @staticmethod
    def _distinct(found: Features, text: int) -> tuple[np.ndarray, np.ndarray]:
        here = slice(found.begin[text], found.begin[text] + found.sizes[text])
        words = slice(found.bounds[text], found.bounds[text + 1])
        parts = [[_EVERY], *(b[here] for b in found.grams), found.words[words], found.pairs[words]]
        bucket, times = np.unique(np.concatenate(parts), return_counts=True)
        bucket, times = bucket[bucket >= 0], times[bucket >= 0]
        return bucket, (times / times.sum()).astype(np.float32)

    def __getitem__(self, text: int) -> tuple[np.ndarray, np.ndarray]:
        bucket, share, bounds = self.parts[text // self.together]
        mine = slice(bounds[text % self.together], bounds[text % self.together + 1])
        return bucket[mine], share[mine]


def train(texts: list[bytes], labels: list[int], bits: int = BITS, epochs: int = EPOCHS, seed: int = 7) -> np.ndarray:
    """Logits of the buckets (with 0 at the end), by stochastic gradient descent on the log loss of the softmax."""
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / WIDTH, 1 / WIDTH, (1 << bits, WIDTH)).astype(np.float32)
    output = np.zeros((2, WIDTH), dtype=np.float32)
    if len(set(labels)) == 2:
        rows = _Rows(texts, bits)
        share = np.bincount(labels, minlength=2) / len(labels)
        balance = (0.5 / share) ** 0.5  # the rarer label counts somewhat more
        for epoch in range(epochs):
            for number, row in enumerate(rng.permutation(len(texts)).tolist()):
                bucket, part = rows[row]
                rate = RATE * (1 - (epoch + number / len(texts)) / epochs) * balance[labels[row]]
                mean = part @ vectors[bucket]
                logit = output @ mean
                error = np.exp(logit - logit.max())
                error /= error.sum()
                error[labels[row]] -= 1
                step = (-rate * error).astype(np.float32)
                vectors[bucket] += np.outer(part * len(bucket), step @ output)
                output += np.outer(step, mean)
    logits = vectors @ (output[1] - output[0])
    return np.append(logits, np.float32(0)).astype(np.float32)


def sample(docs: DataFrame, labels: DataFrame, learn, rows: int = SAMPLE_ROWS, chars: int = SAMPLE_CHARS) -> tuple[list[bytes], list[int]]:
    """Texts and labels of about `rows` labelled documents, chosen by a hash of their id; longer texts are left out.

    `labels` has doc_id and label (0 or 1); `learn` is the condition on doc_id for being learned from.
    """
    known = labels.where(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & learn)
    count = max(known.count(), 1)
    share = min(1 << 20, -(-(rows << 20) // count))
    chosen = known.where(F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(1 << 20)) < share)
    chosen = chosen.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("label").cast("int").alias("label"))
    chosen = chosen.limit(2 * rows)  # bounded, so it may be sent to every task
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where(F.length("text") <= chars)
    found = texts.join(F.broadcast(chosen), "doc_id").limit(2 * rows).collect()
    found = sorted((row.doc_id, row.text.encode(), row.label) for row in found)
    return [text for _, text, _ in found], [label for _, _, label in found]


def score_documents(docs: DataFrame, weights: np.ndarray, name: str = "score") -> DataFrame:
    """`docs` with all their columns and the score of every whole text; null counts as empty."""
    (taken,) = unused(docs, f"_{name}_text")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, taken, most=1 << 20):
            found = scores(weights, utf8(batch.column(taken)))
            kept = [n for n in batch.schema.names if n != taken]
            yield pa.RecordBatch.from_arrays([*batch.select(kept).columns, pa.array(found, pa.float64())], [*kept, name])

    out = StructType([*docs.schema.fields, StructField(name, DoubleType())])
    return map_arrow(docs.withColumn(taken, F.col("text")), work, out)


def held_out(doc_id, parts: int = 5):
    """Rows that are never learned from: those whose id's crc32 leaves no remainder, and those without id."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % parts == 0, F.lit(True))


def classify(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of `docs` (doc_id, text): doc_id, held_out, score, predicted.

    `labels` has doc_id and label (0 or 1, others are ignored). Only rows that are not held out are learned from. score
    is the probability of label 1; predicted is 1 if it reaches the threshold. Null texts are empty; empty texts have
    the score of the feature that all texts share. Without labels of both kinds every score is 0.5. Rows that repeat
    each get a row. Other columns are ignored; an empty table gives an empty result.
    """
    weights = train(*sample(docs, labels, ~held_out(F.col("doc_id"))))
    scored = score_documents(docs.select("doc_id", "text"), weights).drop("text")
    predicted = (F.col("score") >= threshold).cast("int")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", predicted.alias("predicted"))


def good_documents(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of `docs`, with all their columns, that the classifier does not reject."""
    weights = train(*sample(docs, labels, ~held_out(F.col("doc_id"))))
    (name,) = unused(docs, "score")
    return score_documents(docs, weights, name).where(F.col(name) >= threshold).drop(name)
