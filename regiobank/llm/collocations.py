"""Collocations by marginalisation of the longest windows.

Every word leads one window: itself and the words after it within its piece, padded with nulls behind the last one. Only
these windows are counted. A phrase of fewer words is a prefix of the windows that it leads, so a ROLLUP over the counts
of the windows sums up the counts of all shorter phrases, of the single words and of each language; no shorter phrase is
taken from the texts again. Words travel as 64-bit ids; the words of frequent phrases are looked up afterwards, and two
words under one id would be noticed then.

Phrases that are frequent enough are cut at every place and scored by their counts and those of both parts. All parts of
such a phrase are at least as frequent, so a table of the frequent ones holds everything that is looked up.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from regiobank.llm.common import SLICE_BYTES, Words, find_words, map_arrow, mix, slices, utf8, word_hashes
from regiobank.sources.scratch import stage

LONGEST = 3
LEAST = 10
HELD_BY_LONGER = 50
BEST = 2000
SCALE = 1_000_000
NO_LANGUAGE = "und"
SEED = 11
#: Windows that a task counts at a time, about as many as meet in a block, and words that a task remembers having named.
COUNTED_AT_ONCE = 300_000
BLOCK_WINDOWS = 1_000_000
KNOWN_AT_ONCE = 500_000
BATCH = 100_000

#: Bytes that end a piece of text, and those between words; fixed values.
PIECE_ENDS = b".,;:!?\n\x0b\x0c\r"
BLANKS = b" \t"

ENDS_PIECE = np.array([byte in PIECE_ENDS for byte in range(256)], dtype=np.int8)
IN_WORD = np.array([byte not in PIECE_ENDS + BLANKS for byte in range(256)], dtype=np.int8)
#: Windows travel in columns, packed.
PACKED = "zstd"

LOWER = np.frombuffer(bytes(range(256)).lower(), dtype=np.uint8)

#: Prefixes that lead so large a share of the windows of a sample (one in SAMPLED rows) are hot; their windows spread by
#: their last words.
HOT = 1 / 4096
HOT_LEAST = 100
SAMPLED = 64
SPREAD = 64

#: Rows of a language first compete in so many groups.
HEATS = 64

WHOLE = "decimal(38,0)"


def _word_blocks(batches: Iterator[pa.RecordBatch], seed: int) -> Iterator[tuple[Words, np.ndarray, np.ndarray, pa.RecordBatch]]:
    """Slices of texts with their words, the words' 64-bit ids (never 0, which pads), and whether the next word is in the
    same piece."""
    for batch in slices(batches, most=SLICE_BYTES // 2):
        words = find_words(utf8(batch.column("text")), IN_WORD)
        if not len(words.starts):
            continue
        ids = word_hashes(words, seed, lower=True).view(np.int64)
        piece = np.cumsum(ENDS_PIECE[words.buffer], dtype=np.int32)[words.starts]
        yield words, np.where(ids == 0, 1, ids), np.append(piece[1:] == piece[:-1], False), batch


def _counted(lang: np.ndarray, ids: np.ndarray, reach: np.ndarray, longest: int) -> list[np.ndarray]:
    """The distinct windows of a row of words, and how often each one is there: lang, w1 .. w<longest>, n. `reach` says how
    many words the window of each word has."""
    langs, lang = np.unique(lang, return_inverse=True)
    values, code = np.unique(ids, return_inverse=True)
    values, code = np.append(0, values), code + 1
    led = [np.where(reach > k, np.append(code[k:], np.zeros(k, dtype=np.int64)), 0) for k in range(longest)]
    if len(langs) * len(values) ** longest < 1 << 63:
        key = lang.astype(np.int64)
        for column in led:
            key = key * len(values) + column
        key, n = np.unique(key, return_counts=True)
        led = []
        for _ in range(longest):
            key, column = np.divmod(key, len(values))
            led.insert(0, column)
        lang = key
    else:
        *columns, n = _grouped([lang, *led, np.ones(len(lang), dtype=np.int64)], longest + 1, longest + 1)
        lang, *led = columns
    return [langs[lang], *(values[column] for column in led), n]


def _language(seed: int) -> Column:
    """The id of a row's language."""
    return F.xxhash64(F.coalesce(F.col("lang").cast("string"), F.lit(NO_LANGUAGE)), F.lit(seed))


def _names(longest: int) -> list[str]:
    return [f"w{k + 1}" for k in range(longest)]


def _batch(columns: list[np.ndarray], names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(column, pa.int64()) for column in columns], names)


def _window_counts(batches: Iterator[pa.RecordBatch], longest: int, seed: int) -> Iterator[list[np.ndarray]]:
    """lang, w1 .. w<longest>, n of windows, from batches with lang (an id) and text."""
    held: list[tuple[np.ndarray, ...]] = []
    size = 0
    for words, ids, goes_on, batch in _word_blocks(batches, seed):
        alive, reach = goes_on, np.ones(len(ids), dtype=np.int8)
        for _ in range(1, longest):
            reach += alive
            alive = np.append(alive[1:], False) & goes_on
        held.append((batch.column("lang").to_numpy()[words.text_of], ids, reach))
        size += len(ids)
        if size >= COUNTED_AT_ONCE:
            yield _counted(*map(np.concatenate, zip(*held)), longest)
            held.clear()
            size = 0
    if held:
        yield _counted(*map(np.concatenate, zip(*held)), longest)


def _told(docs: DataFrame, seed: int) -> DataFrame:
    return docs.select(_language(seed).alias("lang"), "text").where("text IS NOT NULL")


def windows(docs: DataFrame, longest: int = LONGEST, seed: int = SEED) -> DataFrame:
    """lang, w1 .. w<longest>, n: windows as ids of their words, 0 where padded, counted within slices of texts. lang is
    an id, too."""
    names = ["lang", *_names(longest), "n"]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns in _window_counts(batches, longest, seed):
            yield _batch(columns, names)

    return map_arrow(_told(docs, seed), count, ", ".join(f"{name} bigint" for name in names))


def _hashed(columns: list[np.ndarray]) -> np.ndarray:
    """One hash per row of some columns."""
    found = np.zeros(len(columns[0]), dtype=np.uint64)
    for column in columns:
        found = mix(found * np.uint64(3) + column.view(np.uint64))
    return found


class Shape(NamedTuple):
    """How windows are spread over blocks; it does not change what is counted."""

    blocks: int
    hot: np.ndarray  # sorted hashes of the prefixes whose windows are spread by their last word, too

    def place(self, columns: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """For windows (lang, w1 .. w<longest>) a hash that windows of a prefix have in common, and whether it is hot: then
        only those whose last words do, too."""
        at = _hashed(columns[:-1])
        is_hot = np.isin(at, self.hot)
        return np.where(is_hot, mix(at + np.uint64(1) + columns[-1].view(np.uint64) % np.uint64(SPREAD)), at), is_hot


def shape_of(docs: DataFrame, longest: int = LONGEST, seed: int = SEED) -> Shape:
    """From a sample of rows: 1 / HOT hot prefixes at most, and a number of blocks that grows with the windows."""
    keys = ["lang", *_names(longest - 1)]
    led = windows(docs.sample(1 / SAMPLED, seed), longest - 1, seed).groupBy(*keys).agg(F.sum("n").alias("n"))
    led = stage(led, "sampled-windows")
    total = led.agg(F.sum("n")).first()[0] or 0
    rows = led.where(F.col("n") >= max(total * HOT, HOT_LEAST)).select(*keys).collect()
    hot = _hashed([np.array(column, dtype=np.int64) for column in zip(*rows)]) if rows else np.zeros(0, dtype=np.uint64)
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return Shape(max(tasks, total * SAMPLED // BLOCK_WINDOWS), np.sort(hot))


def _grouped(columns: list[np.ndarray], keys: int, n: int) -> list[np.ndarray]:
    """Rows sorted by the first `keys` columns, equal ones as one with the sum of column number `n`."""
    order = np.lexsort(columns[:keys][::-1])
    columns = [column[order] for column in columns]
    at = np.flatnonzero(np.append(True, np.any([column[1:] != column[:-1] for column in columns[:keys]], axis=0)))
    return [np.add.reduceat(column, at) if i == n else column[at] for i, column in enumerate(columns)]


def _padded(columns: list[np.ndarray], shape: Shape, least: int) -> tuple[list[np.ndarray], list[np.ndarray], list[np.ndarray]]:
    """Windows of whole prefixes (lang, w1 .. w<longest>, n) as other rows with the same sums: those that occur `least`
    times; their prefixes with what is left, the last word padded; and prefixes that are rare as a whole, with their last
    word padded too."""
    *keys, last, n = columns
    at, is_hot = shape.place([*keys, last])
    order = np.lexsort([last, at])
    at, last, n, is_hot, keys = at[order], last[order], n[order], is_hot[order], [column[order] for column in keys]
    if any(np.any((at[1:] == at[:-1]) & (column[1:] != column[:-1])) for column in keys):
        # several prefixes under one hash
        at, is_hot, *keys, last, n = _grouped([at, is_hot, *keys, last, n], len(keys) + 3, len(keys) + 3)
    new = np.flatnonzero(np.append(True, (at[1:] != at[:-1]) | (last[1:] != last[:-1]) | np.any([column[1:] != column[:-1] for column in keys], axis=0)))
    n, at, last, is_hot, keys = np.add.reduceat(n, new), at[new], last[new], is_hot[new], [column[new] for column in keys]
    often = (n >= least) & (last != 0)
    first = np.flatnonzero(np.append(True, np.any([column[1:] != column[:-1] for column in (at, *keys)], axis=0)))
    total, rest = np.add.reduceat(n, first), np.add.reduceat(np.where(often, 0, n), first)
    prefix, rare = [column[first] for column in keys], ~is_hot[first] & (total < least)
    none = np.zeros(len(first), dtype=np.int64)
    found = [*(column[often] for column in keys), last[often], n[often]]
    common = [column[~rare] for column in (*prefix, none, rest)]
    scarce = [column[rare] for column in (*prefix[:-1], none, none, rest)]
    return found, common, _grouped(scarce, len(keys) + 1, len(keys) + 1) if rare.any() else scarce


def merged_windows(docs: DataFrame, longest: int = LONGEST, least: int = LEAST, seed: int = SEED) -> DataFrame:
    """`windows` of all tasks, in which rare ones are padded from their last word on, and rare prefixes from theirs.

    Windows meet in blocks by the hash of all their words but the last, so that a block has whole prefixes; those of a hot
    prefix are spread by their last word too. A task sends packed rows, one per block and slice, and one task merges a
    block.
    """
    names = ["lang", *_names(longest), "n"]
    shape = shape_of(docs, longest, seed)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns in _window_counts(batches, longest, seed):
            block = (shape.place(columns[:-1])[0] % np.uint64(shape.blocks)).astype(np.int64)
            order = np.argsort(block, kind="stable")
            numbers, first = np.unique(block[order], return_index=True)
            rows = np.stack(columns)[:, order]
            size = np.diff([*first, len(order)])
            parts = [pa.compress(rows[:, s : s + n].tobytes(), PACKED, asbytes=True) for s, n in zip(first.tolist(), size.tolist())]
            yield pa.RecordBatch.from_arrays([pa.array(numbers), pa.array(size), pa.array(parts, pa.binary())], ["block", "size", "rows"])

    dealt = map_arrow(_told(docs, seed), deal, "block bigint, size bigint, rows binary").repartitionById(shape.blocks, F.col("block").cast("int"))

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []
        size, most = 0, COUNTED_AT_ONCE
        for batch in batches:
            for length, rows in zip(batch.column("size").to_pylist(), batch.column("rows").to_pylist()):
                plain = pa.decompress(rows, length * len(names) * 8, PACKED)
                held.append(list(np.frombuffer(plain, dtype=np.int64).reshape(len(names), -1)))
                size += length
                if size >= most:
                    # equal windows become one
                    held = [_grouped([np.concatenate(column) for column in zip(*held)], len(names) - 1, len(names) - 1)]
                    size = len(held[0][0])
                    most = size + max(COUNTED_AT_ONCE, size)
        if held:
            for columns in _padded([np.concatenate(column) for column in zip(*held)], shape, least):
                for start in range(0, len(columns[0]), BATCH):
                    yield _batch([column[start : start + BATCH] for column in columns], names)

    return map_arrow(dealt, merge, ", ".join(f"{name} bigint" for name in names))


def frequent_phrases(docs: DataFrame, longest: int = LONGEST, least: int = LEAST, seed: int = SEED) -> DataFrame:
    """lang (its id), ids (of the words), n: all phrases of up to `longest` words that occur `least` times in a language,
    and for each language its number of words, under an empty array."""
    names = _names(longest)
    sums = merged_windows(docs, longest, least, seed).rollup("lang", *names).agg(F.sum("n").alias("n"), F.grouping_id().alias("summed"))
    # `summed` has a bit for each column that is summed over, the last columns first; the language is there for all but one
    size = F.expr(" ".join(["CASE summed", *[f"WHEN {(1 << (longest - size)) - 1} THEN {size}" for size in range(longest + 1)], "END"]))
    phrases = sums.select("lang", F.slice(F.array(*names), F.lit(1), size).alias("ids"), "n").where("ids IS NOT NULL")
    # a padded window is a shorter phrase, which its own level counts
    return phrases.where(~F.array_contains("ids", 0) & ((F.size("ids") == 0) | (F.col("n") >= least)))


def _dictionary(docs: DataFrame, seed: int) -> DataFrame:
    """The distinct (id, word) of all texts."""

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = np.zeros(0, dtype=np.uint64)
        for words, ids, _, _ in _word_blocks(batches, seed):
            # by a second hash besides, so that a word whose id another one has is not passed over
            both = mix(ids.view(np.uint64) + word_hashes(words, seed + 1, lower=True) * np.uint64(3))
            both, first = np.unique(both, return_index=True)
            new = ~np.isin(both, known, assume_unique=True)
            known = np.union1d(known, both) if len(known) < KNOWN_AT_ONCE else both
            first, small = first[new], LOWER[words.buffer]
            texts = [small[s:e].tobytes() for s, e in zip(words.starts[first].tolist(), words.ends[first].tolist())]
            yield pa.RecordBatch.from_arrays([pa.array(ids[first]), pa.array(texts, pa.binary()).cast(pa.string())], ["id", "word"])

    return map_arrow(docs.select("text").where("text IS NOT NULL"), look, "id bigint, word string").distinct()


def named_phrases(docs: DataFrame, longest: int = LONGEST, least: int = LEAST) -> DataFrame:
    """lang, words, phrase, n: `frequent_phrases` with their words. If two words share an id, all starts anew."""
    for seed in range(SEED, SEED + 100, 2):
        found = stage(frequent_phrases(docs, longest, least, seed), "phrases")
        single = found.where(F.size("ids") == 1).select(F.col("ids")[0].alias("id")).distinct()
        words = stage(_dictionary(docs, seed).join(single, "id"), "words")
        spoken = docs.where("text IS NOT NULL").select(_language(seed).alias("lang"), F.coalesce(F.col("lang").cast("string"), F.lit(NO_LANGUAGE)).alias("name"))
        langs = stage(spoken.distinct(), "languages")
        ids = words.select("id").unionByName(langs.select(F.col("lang").alias("id")))
        if ids.groupBy("id").count().where("count > 1").isEmpty():
            break
    parts = found.select("lang", "ids", "n", F.posexplode_outer("ids").alias("at", "id")).join(words, "id", "left")
    rows = parts.groupBy("lang", "ids", "n").agg(F.array_sort(F.collect_list(F.when(F.col("id").isNotNull(), F.struct("at", "word")))).alias("x"))
    named = rows.join(langs, "lang")
    return stage(named.select(F.col("name").alias("lang"), F.col("x.word").alias("words"), F.array_join("x.word", " ").alias("phrase"), "n"), "named-phrases")


def collocations(
    docs: DataFrame, longest: int = LONGEST, least: int = LEAST, held: int = HELD_BY_LONGER, best: int = BEST
) -> DataFrame:
    """The `best` phrases of 2 to `longest` words per language: lang, rank, phrase, a, l, r, n, score.

    `docs` has text and lang. A-Z count as a-z; pieces end at stops and line ends, words at blanks and tabs. a counts a
    phrase, l and r the two parts of its weakest cut, n all words of the language; score is 1000000 a a / (l r), rounded
    down, in exact arithmetic. The weakest cut has the lowest score, the first one if several have. A phrase goes if a
    longer one with at least `least` occurrences holds it and has `held` percent of its occurrences or more. Order: score,
    then a, both falling, then phrase by its UTF-8 bytes.

    Null and empty texts have no words; a null lang is `und`, as is the lang `und` itself. Rows that repeat count each
    time. Other columns are ignored, whatever their names. An empty table gives an empty result.
    """
    if longest < 2 or least < 1:
        raise ValueError("longest: from 2, least: from 1")
    found = named_phrases(docs, longest, least)
    known = found.where(F.size("words") > 0).select("lang", "phrase", "n")
    chosen = found.where(F.size("words") > 1).select("lang", "phrase", "words", F.col("n").alias("a"))
    cuts = chosen.select("lang", "phrase", "a", "words", F.explode(F.sequence(F.lit(1), F.size("words") - 1)).alias("k"))
    size = F.size("words")
    cuts = cuts.select(
        "lang",
        "phrase",
        "a",
        "k",
        F.array_join(F.slice("words", F.lit(1), F.col("k")), " ").alias("first"),
        F.array_join(F.slice("words", F.col("k") + 1, size - F.col("k")), " ").alias("rest"),
    )
    for part, count in (("first", "l"), ("rest", "r")):
        cuts = cuts.join(known.select("lang", F.col("phrase").alias(part), F.col("n").alias(count)), ["lang", part])
    a, l, r = (F.col(name).cast("decimal(18,0)") for name in "alr")
    cuts = cuts.withColumns({"_over": (F.lit(SCALE).cast("decimal(7,0)") * a * a).cast(WHOLE), "_under": (l * r).cast(WHOLE)})
    cuts = cuts.withColumn("score", F.expr("_over div _under"))
    weakest = cuts.groupBy("lang", "phrase").agg(F.first("a").alias("a"), F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    inner = chosen.where(size > 2).select("lang", "a", "words", F.explode(F.sequence(F.lit(2), size - 1)).alias("parts"))
    inner = inner.select("lang", "a", "words", "parts", F.explode(F.sequence(F.lit(1), size - F.col("parts") + 1)).alias("at"))
    inside = inner.select("lang", F.array_join(F.slice("words", F.col("at"), F.col("parts")), " ").alias("phrase"), F.col("a").alias("longer"))
    longer = inside.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    totals = found.where(size == 0).select("lang", F.col("n").alias("total"))
    kept = weakest.join(longer, ["lang", "phrase"], "left").where(
        F.col("longer").isNull() | (100 * F.col("longer").cast(WHOLE) < held * F.col("a").cast(WHOLE))
    )
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    scored = kept.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    # first within a share of the rows of a language, so that no task sorts all of them
    heat = F.pmod(F.xxhash64("phrase"), F.lit(HEATS))
    heats = Window.partitionBy("lang", "heat").orderBy(*order)
    first = scored.withColumn("heat", heat).withColumn("place", F.row_number().over(heats)).where(F.col("place") <= best)
    final = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= best)
    return final.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", F.col("total").alias("n"), "score")
