"""Removal of long repeated word sequences, found by recompression.

Each text is rewritten in rounds: a maximal run of one symbol becomes one symbol, then neighbouring symbols are paired
where the left one's name has an even hash and the right one's an odd. A new symbol is named by the hash of what it
replaces, so a name means the same in every text and task without a shared dictionary. Every symbol remembers its
support, the words that its existence depends on. If the support lies within a window of words, then an equal window
elsewhere holds the same symbol at the same place: equal substrings have the same interior symbols.

1. Texts whose whole word sequences are equal are found by their digests; only the first one goes on.
2. Every window takes the symbol of least name among those whose support it covers (or itself, if there is none) as its
   anchor. Anchors are compared over all texts by the hash of their support. Anchors that stand alone have no repeat.
3. Windows of the anchors that are left are compared over all texts by 128 bits of their words. All but the first
   occurrence of a window in the order of documents are repeats.
4. Covered words are removed from the texts that have repeats.

Each task first compares what it has read itself, and sends one row for each anchor and window on, so a passage that
stands in a third of all texts is a row per task in the shuffle.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from regiobank.llm.common import (
    BLANK_SEPARATED,
    Words,
    find_words,
    keyed,
    map_arrow,
    mix,
    range_hashes,
    running_sums,
    slices,
    utf8,
    word_hashes,
)
from regiobank.sources.scratch import stage

WINDOW = 20
ROUNDS = 2
_GAP = np.uint64(0x5851F42D4C957F2D)
_LONE = np.uint64(0xD6E8FEB86659FD93)


# ---- recompression ----


def _runs(names: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Replace maximal runs. That a run ends is known by its neighbours, so their supports belong to its own."""
    first = np.flatnonzero(np.concatenate([[True], names[1:] != names[:-1]]))
    last = np.concatenate([first[1:], [len(names)]]) - 1
    length = (last - first + 1).astype(np.uint64)
    named = np.where(length > 1, mix(names[first] + length * np.uint64(0xA0761D6478BD642F)), names[first])
    return named, low[np.maximum(first - 1, 0)], high[np.minimum(last + 1, len(names) - 1)]


def _pairs(names: np.ndarray, low: np.ndarray, high: np.ndarray, salt: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Replace neighbours of which the first is a left and the second a right symbol."""
    right = (mix(names ^ np.uint64(salt)) & np.uint64(1)).astype(bool)
    opens = np.zeros(len(names), dtype=bool)
    opens[:-1] = ~right[:-1] & right[1:]
    closes = np.zeros(len(names), dtype=bool)
    closes[1:] = opens[:-1]
    keep = np.flatnonzero(~closes)
    after, before = np.minimum(keep + 1, len(names) - 1), np.maximum(keep - 1, 0)
    paired, lone_right = opens[keep], right[keep]
    named = np.where(paired, mix(names[keep] * np.uint64(3) + mix(names[after])), names[keep])
    return named, np.where(lone_right, low[before], low[keep]), np.where(lone_right, high[keep], high[after])


def symbols(words: np.ndarray, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Names and supports [low, high) of the symbols after some rounds over a sequence of word hashes."""
    low = np.arange(len(words))
    state = (words, low, low + 1)
    for number in range(rounds):
        state = _pairs(*_runs(*state), number + 1)
    return state


def anchors(words: np.ndarray, usable: np.ndarray, window: int) -> tuple[np.ndarray, ...]:
    """Anchors of the usable windows: for each one its low and high word, first window and number of windows.

    Windows without a symbol of their own are anchors of themselves.
    """
    names, low, high = symbols(words)
    starts = np.flatnonzero(usable)
    first, after = np.searchsorted(low, starts), np.searchsorted(high, starts + window, side="right")
    some = after > first
    chosen = np.full(len(starts), -1)
    level, width, best = np.arange(len(names)), 1, np.full(len(starts), -1)
    span = after - first
    while some.any() and width <= span.max():
        here = np.flatnonzero(some & (span >= width) & (span < 2 * width))
        one, two = level[first[here]], level[after[here] - width]
        best[here] = np.where(names[one] <= names[two], one, two)
        if len(level) <= width:
            break
        left, right = level[:-width], level[width:]
        level, width = np.where(names[left] <= names[right], left, right), 2 * width
    chosen = best
    new = np.concatenate([[True], (chosen[1:] != chosen[:-1]) | (np.diff(starts) != 1) | (chosen[1:] < 0)])
    at = np.flatnonzero(new)
    count = np.diff([*at, len(starts)])
    lone = chosen[at] < 0
    return (
        np.where(lone, starts[at], low[chosen[at]]),
        np.where(lone, starts[at] + window, high[chosen[at]]),
        starts[at],
        count,
        lone,
    )


class _Joined:
    """Word hashes of several texts in one sequence, with a gap before each text and at the end."""

    def __init__(self, words: Words, window: int):
        counts = np.diff(words.bounds)
        self.begin = words.bounds[:-1] + np.arange(len(counts)) + 1  # of each text
        total = int(words.bounds[-1]) + len(counts) + 1
        inside = np.ones(total, dtype=bool)
        inside[np.concatenate([self.begin - 1, [total - 1]])] = False
        self.inside = inside
        self.hashes = np.full(total, _GAP)
        self.hashes[inside] = word_hashes(words)
        left = np.zeros(total, dtype=np.int64)
        left[inside] = np.repeat(counts, counts) - (np.arange(int(counts.sum())) - np.repeat(words.bounds[:-1], counts))
        self.usable = left >= window
        self.text = np.zeros(total, dtype=np.int64)
        self.text[inside] = words.text_of


def _seen_before(keys: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Order by keys, and for each place in that order whether it begins a group of equal keys."""
    order = np.lexsort(keys[::-1])
    begins = np.zeros(len(order), dtype=bool)
    if len(order):
        begins[0] = True
        for key in keys:
            begins[1:] |= key[order[1:]] != key[order[:-1]]
    return order, begins


# ---- what tasks do with their slice of texts ----


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        split = [text.split() for text in utf8(batch.column("text"))]
        kept = pa.array([hashlib.sha256(b" ".join(words)).hexdigest() for words in split])
        counts = pa.array([len(words) for words in split], pa.int64())
        yield pa.RecordBatch.from_arrays([*batch.select(["doc_id", "ord", "rid"]).columns, counts, kept], _BASE)


_BASE = ["doc_id", "ord", "rid", "n_words", "kept"]


def _find_anchors(window: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = _Joined(find_words(utf8(batch.column("text")), BLANK_SEPARATED), window)
            if not texts.usable.any():
                continue
            low, high, start, count, lone = anchors(texts.hashes, texts.usable, window)
            keys = range_hashes(running_sums(texts.hashes), low, high)
            keys[lone] = mix(keys[lone] ^ _LONE)
            order, begins = _seen_before([keys])
            group = np.cumsum(begins) - 1
            known = np.empty(len(keys), dtype=bool)
            known[order] = np.bincount(group)[group] > 1
            rest = np.empty(len(keys), dtype=bool)
            rest[order] = ~begins
            text = texts.text[start]
            place = start - texts.begin[text]
            # one row per key asks the other tasks; the rest only has to be told, so it may go anywhere
            keys[rest] = mix(keys[rest] + place[rest].astype(np.uint64) + mix(text[rest].astype(np.uint64)))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(keys.view(np.int64)),
                    batch.column("ord").take(pa.array(text)),
                    batch.column("rid").take(pa.array(text)),
                    pa.array((place << 6) + count * 2 + known),
                ],
                ["key", "ord", "rid", "span"],
            )

    return work


def _compare_windows(window: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = _Joined(words := find_words(utf8(batch.column("text")), BLANK_SEPARATED), window)
            spans = batch.column("spans")
            sizes = np.diff(spans.offsets.to_numpy())
            span = spans.values.to_numpy()[spans.offsets[0].as_py() :][: sizes.sum()]
            count = (span & 63) >> 1
            first = np.repeat(texts.begin, sizes) + (span >> 6)
            at = np.repeat(first, count) + (np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count))
            second = np.full(len(texts.hashes), _GAP)
            second[texts.inside] = word_hashes(words, seed=2)
            h1 = range_hashes(running_sums(texts.hashes), at, at + window)
            h2 = range_hashes(running_sums(second), at, at + window)
            text = texts.text[at]
            place = at - texts.begin[text]
            ord_, rid = (batch.column(name).to_numpy()[text] for name in ("ord", "rid"))
            order, begins = _seen_before([h1, h2, ord_, rid, place])
            head = np.ones(len(order), dtype=bool)
            head[1:] = (h1[order[1:]] != h1[order[:-1]]) | (h2[order[1:]] != h2[order[:-1]])
            occurrence = np.cumsum(begins)
            found = order[occurrence != occurrence[head][np.cumsum(head) - 1]]  # repeats of an earlier window of this slice
            asks = np.ones(len(order), dtype=bool)
            asks[found] = False
            yield _window_rows(ord_[asks], rid[asks], place[asks], np.zeros(asks.sum(), np.int64), h1[asks], h2[asks])
            found = np.sort(found)
            joined = np.concatenate([[True], (np.diff(at[found]) != 1)])[: len(found)]
            cut = np.flatnonzero(joined)
            length = np.diff([*cut, len(found)])
            found = found[cut]
            spread = mix(rid[found].view(np.uint64) + place[found].astype(np.uint64))
            yield _window_rows(ord_[found], rid[found], place[found], length, spread, mix(spread + np.uint64(7)))

    return work


def _window_rows(ord_, rid, place, repeats, h1, h2) -> pa.RecordBatch:
    arrays = [ord_, rid, place, repeats, h1.view(np.int64), h2.view(np.int64)]
    return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in arrays], ["ord", "rid", "pos", "repeats", "h1", "h2"])


def _remove(window: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            removed, kept = [], []
            for text, spans in zip(utf8(batch.column("text")), batch.column("spans").to_pylist()):
                words = text.split()
                change = np.zeros(len(words) + 1, dtype=np.int64)
                for span in spans:
                    change[span["pos"]] += 1
                    change[span["pos"] + span["n"] - 1 + window] -= 1
                covered = np.cumsum(change[:-1]) > 0
                removed.append(int(covered.sum()))
                left = b" ".join([words[i] for i in np.flatnonzero(~covered).tolist()])
                kept.append((left, hashlib.sha256(left).hexdigest()))
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.select(["ord", "rid"]).columns,
                    pa.array(removed, pa.int64()),
                    pa.array([digest for _, digest in kept]),
                    pa.array([left.decode("utf-8", "replace") for left, _ in kept]),
                ],
                ["ord", "rid", "n_removed", "left_sha", "left_text"],
            )

    return work


# ---- the operator ----


def _repeats(texts: DataFrame, firsts: DataFrame, window: int) -> DataFrame:
    """(ord, rid, spans): places from which windows of a text repeat an earlier one, as (first window, windows)."""
    first_texts = texts.join(firsts, ["ord", "rid"], "left_semi")
    found = map_arrow(first_texts, _find_anchors(window), "key long, ord long, rid long, span long")
    told = found.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("key")))
    repeated = told.where((F.col("n") > 1) | (F.col("span") % 2 == 1))
    by_text = repeated.groupBy("ord", "rid").agg(F.sort_array(F.collect_list("span")).alias("spans"))
    candidates = texts.join(by_text, ["ord", "rid"])
    windows = map_arrow(
        candidates, _compare_windows(window), "ord long, rid long, pos long, repeats long, h1 long, h2 long"
    )
    ranked = windows.withColumn("nth", F.rank().over(Window.partitionBy("h1", "h2").orderBy("ord", "rid", "pos")))
    later = ranked.where("nth > 1 OR repeats > 0").select("ord", "rid", "pos", F.greatest("repeats", F.lit(1)).alias("n"))
    return later.groupBy("ord", "rid").agg(F.collect_list(F.struct("pos", "n")).alias("repeats"))


def remove_repeats(docs: DataFrame, window: int = WINDOW, with_text: bool = False) -> DataFrame:
    """One row per row of `docs` (doc_id, text): doc_id, n_words, n_removed, kept_sha256 and, if asked, kept_text.

    A word is removed if a window of `window` words that covers it also starts earlier: in a smaller doc_id, or earlier
    in the same document. Windows are judged on the texts as given. kept_sha256 is the digest of the words that are
    left, joined by one blank; kept_text is that text (null where nothing was removed: the text stands as it is).
    Null and empty texts have no words. Rows without doc_id come after all others. Rows that share a doc_id are
    ordered by a hash of their text; if they share the text as well, they are one document that gets a row each.
    Texts of less than `window` words lose nothing. Other columns are ignored. An empty table gives an empty result.
    """
    if not 2 <= window <= 31:
        raise ValueError("window: 2 to 31 words")
    rows = keyed(docs)
    texts = rows.select("ord", "rid", "text")
    base = stage(map_arrow(rows, _digests, "doc_id long, ord long, rid long, n_words long, kept string"), "digests")
    firsts = base.where(F.col("n_words") >= window).groupBy("kept").agg(F.min(F.struct("ord", "rid")).alias("of"))
    firsts = stage(firsts.select("kept", "of.ord", "of.rid"), "firsts")
    spans = _repeats(texts, firsts, window)
    changed = texts.join(spans.withColumnRenamed("repeats", "spans"), ["ord", "rid"])
    schema = "ord long, rid long, n_removed long, left_sha string, left_text string"
    changed = map_arrow(changed, _remove(window), schema)
    if not with_text:
        changed = changed.drop("left_text")
    changed = changed.dropDuplicates(["ord", "rid"])
    again = base.join(firsts.select("ord", "rid", F.lit(True).alias("first")), ["ord", "rid"], "left")
    copy = F.col("first").isNull() & (F.col("n_words") >= window)
    found = again.join(changed, ["ord", "rid"], "left")
    empty = hashlib.sha256(b"").hexdigest()
    return found.select(
        "doc_id",
        "n_words",
        F.when(copy, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.when(copy, F.lit(empty)).otherwise(F.coalesce("left_sha", "kept")).alias("kept_sha256"),
        *([F.when(copy, F.lit("")).otherwise(F.col("left_text")).alias("kept_text")] if with_text else []),
    )
