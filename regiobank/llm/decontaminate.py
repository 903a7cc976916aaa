"""Benchmark decontamination by winnowing.

Of every `w` consecutive k-grams of a text the one with the least hash is kept as a fingerprint. Any span of w + k - 1
words that a document shares with a benchmark item holds w whole k-grams, and both sides keep the same one of them, so
the join of the fingerprints misses no shared span of that length. Around each joined fingerprint the document's windows
are then compared with the items' windows word by word, and the windows found are united to spans.

Items shorter than the window are one window each; their lengths (fewer than the window size, so few) get fingerprints
of their own size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from regiobank.llm.common import (
    ALPHANUMERIC,
    Words,
    find_words,
    keyed,
    lowered,
    map_arrow,
    mix,
    range_hashes,
    row_order,
    running_sums,
    slices,
    text_hash,
    unused,
    utf8,
    word_hashes,
)
from regiobank.sources.scratch import stage

WINDOW = 13
GRAM = 5
_ROW = ["ord", "rid", "size", "pos", "hash"]


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """Place of the leftmost least value in each run of `width` consecutive values."""
    level, span = np.arange(len(values)), 1
    while 2 * span <= width:
        one, two = level[:-span], level[span:]
        level, span = np.where(values[one] <= values[two], one, two), 2 * span
    count = len(values) - width + 1
    one, two = level[:count], level[width - span : width - span + count]
    return np.where(values[one] <= values[two], one, two)


def winnow(words: Words, hashes: np.ndarray, size: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each window of `size` words within a text: its first word, and place and hash of its fingerprint."""
    gram = min(gram, size)
    if len(hashes) < size:
        none = np.empty(0, dtype=np.int64)
        return none, none, none.view(np.uint64)
    at = np.arange(len(hashes) - gram + 1)
    grams = range_hashes(running_sums(hashes), at, at + gram)
    places = _least(grams, size - gram + 1)
    starts = np.arange(len(places))
    whole = starts + size <= words.bounds[1:][words.text_of[starts]]
    return starts[whole], places[whole], grams[places[whole]]


def _texts_of(batch: pa.RecordBatch) -> tuple[Words, np.ndarray]:
    words = find_words(utf8(batch.column("text")), ALPHANUMERIC)
    return words, word_hashes(words)


def _window_text(words: Words, first: int, size: int) -> str:
    ends = zip(words.starts[first : first + size].tolist(), words.ends[first : first + size].tolist())
    return b" ".join([words.buffer[a:b].tobytes() for a, b in ends]).decode("utf-8", "replace")


def _item_windows(window: int, gram: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            words, hashes = _texts_of(batch)
            counts, items = np.diff(words.bounds), batch.column("item_id").to_pylist()
            rows = []
            for size in np.unique(np.minimum(counts, window)).tolist():
                if not size:
                    continue
                mine = np.minimum(counts, window) == size
                starts, _, prints = winnow(words, hashes, size, gram)
                for start, value in zip(starts.tolist(), prints.view(np.int64).tolist()):
                    item = int(np.searchsorted(words.bounds, start, side="right")) - 1
                    if mine[item]:
                        rows.append((items[item], size, value, _window_text(words, start, size)))
            yield pa.RecordBatch.from_pylist(
                [dict(zip(("item", "size", "hash", "window"), row)) for row in rows],
                schema=pa.schema([("item", pa.string()), ("size", pa.int32()), ("hash", pa.int64()), ("window", pa.string())]),
            )

    return work


def _document_prints(sizes: list[int], gram: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            words, hashes = _texts_of(batch)
            counts = np.diff(words.bounds)
            # a row per text: its words, and whether it has a doc_id
            row = [batch.column("ord"), batch.column("rid"), pa.array(np.zeros(len(counts), np.int32)), pa.array(counts), batch.column("has_id")]
            yield pa.RecordBatch.from_arrays(row, _ROW)
            for size in sizes:
                _, places, prints = winnow(words, hashes, size, gram)
                kept = np.flatnonzero(np.diff(places, prepend=-1))
                places, prints = places[kept], prints[kept]
                text = words.text_of[places]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("ord").take(pa.array(text)),
                        batch.column("rid").take(pa.array(text)),
                        pa.array(np.full(len(text), size, np.int32)),
                        pa.array(places - words.bounds[text]),
                        pa.array(prints.view(np.int64)),
                    ],
                    _ROW,
                )

    return work


def _windows_around(gram: int):
    """Windows that hold a joined fingerprint; marks are word place * 64 + size."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            words = find_words(utf8(batch.column("text")), ALPHANUMERIC)
            counts = np.diff(words.bounds)
            for row, marks in enumerate(batch.column("marks").to_pylist()):
                found = np.unique(np.array(marks, dtype=np.int64))
                for size in np.unique(found & 63).tolist():
                    places = (found >> 6)[(found & 63) == size]
                    back = size - min(gram, size)
                    starts = np.unique(places[:, None] - np.arange(back + 1))
                    starts = starts[(starts >= 0) & (starts + size <= counts[row])]
                    texts = [_window_text(words, int(words.bounds[row]) + start, size) for start in starts.tolist()]
                    n = len(starts)
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column("ord").take(pa.array(np.full(n, row))),
                            batch.column("rid").take(pa.array(np.full(n, row))),
                            pa.array(np.full(n, size, np.int32)),
                            pa.array(starts, pa.int64()),
                            pa.array(texts, pa.string()),
                        ],
                        ["ord", "rid", "size", "start", "window"],
                    )

    return work


def item_windows(benchmark: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """(size, window, hash, items) for the distinct windows of the items; items are item_ids as strings, sorted."""
    rows = benchmark.select(F.col("item_id").cast("string").alias("item_id"), lowered(F.coalesce("text", F.lit(""))).alias("text"))
    found = map_arrow(rows, _item_windows(window, gram), "item string, size int, hash long, window string")
    return found.groupBy("size", "window", "hash").agg(F.sort_array(F.collect_set("item")).alias("items"))


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, gram: int = GRAM, share: int = 20) -> DataFrame:
    """One row per row of `docs` (doc_id, text): doc_id, rid, n_words, n_hit, items (array), spans, contaminated.

    A window is `window` consecutive words of an item of `benchmark` (item_id, text), or the whole of a shorter item.
    Words are runs of non-ASCII characters, digits and letters, A-Z lower-cased. A document word is hit if it lies in
    an occurrence of any window; spans are the maximal runs of hit words as (first word, words). contaminated: at least
    one word in `share` is hit. rid is a hash of the text (see `keyed`), for joining back.

    Null and empty texts have no words and no hits. Rows that repeat each get a row. An item without item_id is found
    like the others, but no id is listed for it. Other columns are ignored. An empty table on either side gives rows
    without hits, or none.
    """
    if not 1 <= window <= 63:
        raise ValueError("window: 1 to 63 words")
    items = stage(item_windows(benchmark, window, gram), "item-windows")
    sizes = sorted(row.size for row in items.select("size").distinct().toLocalIterator())  # at most `window` values
    texts = keyed(docs).withColumn("text", lowered("text"))
    prints = map_arrow(
        texts.select("ord", "rid", "text", F.col("doc_id").isNotNull().cast("long").alias("has_id")), _document_prints(sizes, gram), "ord long, rid long, size int, pos long, hash long"
    )
    known = stage(items.select(F.col("size").alias("of_size"), F.col("hash").alias("of_hash")).distinct(), "item-prints")
    marked = prints.join(known, (F.col("hash") == F.col("of_hash")) & (F.col("size") == F.col("of_size")), "left")
    counted = F.col("size") == 0
    rows = marked.where(counted | F.col("of_hash").isNotNull()).groupBy("ord", "rid").agg(
        F.max(F.when(counted, F.col("pos"))).alias("n_words"),
        F.count(F.when(counted, 1)).alias("copies"),
        F.sum(F.when(counted, F.col("hash"))).alias("with_id"),
        F.collect_set(F.when(~counted, F.col("pos") * 64 + F.col("size"))).alias("marks"),
    )
    rows = stage(rows, "marked")
    found = _hits(texts, rows, items, gram)
    per_row = rows.drop("marks").join(found, ["ord", "rid"], "left").withColumn("n_hit", F.coalesce("n_hit", F.lit(0)))
    # rows without an id come with those of the largest one
    numbered = per_row.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
    return numbered.select(
        F.when(F.col("copy") <= F.col("with_id"), F.col("ord")).alias("doc_id"),
        "rid",
        "n_words",
        "n_hit",
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        F.coalesce("spans", F.array().cast("array<struct<start:bigint,words:bigint>>")).alias("spans"),
        ((F.col("n_hit") > 0) & (F.col("n_hit") * share >= F.col("n_words"))).alias("contaminated"),
    )


def _hits(texts: DataFrame, rows: DataFrame, items: DataFrame, gram: int) -> DataFrame:
    """ord, rid, items, spans and n_hit of the rows with hits."""
    marked = rows.where(F.size("marks") > 0).select("ord", "rid", "marks")
    near = texts.select("ord", "rid", "text").join(marked, ["ord", "rid"])
    windows = map_arrow(near, _windows_around(gram), "ord long, rid long, size int, start long, window string")
    found = windows.join(items.select("size", "window", "items"), ["size", "window"])
    # occurrences of a text in order; a span begins where one starts behind the ends of all before it
    places = found.select("ord", "rid", "start", (F.col("start") + F.col("size")).alias("end"), "items").repartition("ord", "rid")
    order = Window.partitionBy("ord", "rid").orderBy("start", "end")
    ends = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    begins = places.withColumn("begins", (F.coalesce(ends, F.lit(-1)) < F.col("start")).cast("int"))
    spans = begins.withColumn("span", F.sum("begins").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    spans = spans.groupBy("ord", "rid", "span").agg(
        F.min("start").alias("start"),
        (F.max("end") - F.min("start")).alias("words"),
        F.array_distinct(F.flatten(F.collect_set("items"))).alias("items"),
    )
    return spans.groupBy("ord", "rid").agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
        F.array_sort(F.collect_list(F.struct("start", "words"))).alias("spans"),
        F.sum("words").alias("n_hit"),
    )


def clean_documents(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of `docs`, with all their columns, that are not contaminated."""
    bad = contamination(docs, benchmark, window).where("contaminated").select("doc_id", "rid").distinct()
    own_ord, own_rid = unused(docs, "_ord", "_rid")
    bad = bad.select(row_order(F.col("doc_id")).alias(own_ord), F.col("rid").alias(own_rid))
    return docs.join(bad, (row_order(F.col("doc_id")) == F.col(own_ord)) & (text_hash(F.col("text")) == F.col(own_rid)), "left_anti")
