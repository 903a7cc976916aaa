"""Helpers that the operators of this folder share: Arrow batches of bounded size, word scanning and word hashes.

Words are found and hashed for a whole slice of texts at once with numpy, on UTF-8 bytes. All non-ASCII bytes belong to
words, so bytes decide as code points would.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from regiobank.sources.shipping import ship_package

SLICE_BYTES = 2 << 20
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

U64 = np.uint64
_ODD = 0x9E3779B97F4A7C15 | 1
_ODD_INVERSE = pow(_ODD, -1, 1 << 64)


def lowered(column):
    """A column with A-Z in lower case and everything else as it is."""
    return F.translate(column, UPPER, UPPER.lower())


def row_order(doc_id: Column) -> Column:
    """The doc_id as a long without nulls; rows without one come last."""
    return F.coalesce(doc_id.cast("long"), F.lit((1 << 63) - 1))


def text_hash(text: Column) -> Column:
    """What tells rows apart that share a doc_id; null counts as empty."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def keyed(docs: DataFrame, *others: Column) -> DataFrame:
    """doc_id, ord (see `row_order`), rid (see `text_hash`), text (null as empty) and the columns given besides."""
    doc_id, text = F.col("doc_id"), F.col("text")
    return docs.select(
        doc_id.cast("long").alias("doc_id"),
        row_order(doc_id).alias("ord"),
        text_hash(text).alias("rid"),
        F.coalesce(text, F.lit("")).alias("text"),
        *others,
    )


def unused(df: DataFrame, *names: str) -> list[str]:
    """The names, or names like them, under which `df` has no column in any letter case."""
    taken, found = {column.lower() for column in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        found.append(name)
    return found


def map_arrow(df: DataFrame, work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str | StructType) -> DataFrame:
    """`mapInArrow`, with this package sent along to the workers."""
    ship_package(df.sparkSession)
    return df.mapInArrow(work, schema)


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that each holds about `most` bytes of text, but at least one row: work memory stays bounded."""
    for batch in batches:
        if not batch.num_rows:
            continue
        size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        part = (np.cumsum(size) - size) // most
        for start, end in zip(*_runs(part)):
            yield batch.slice(start, end - start)


def _runs(values: np.ndarray) -> tuple[list[int], list[int]]:
    cuts = np.flatnonzero(np.diff(values)) + 1
    return [0, *cuts.tolist()], [*cuts.tolist(), len(values)]


def utf8(column: pa.Array) -> list[bytes]:
    """Texts as UTF-8; null as empty."""
    return [value or b"" for value in column.cast(pa.binary()).to_pylist()]


class Words(NamedTuple):
    """Words of a list of texts: where each one is in `buffer`, and the first word of each text."""

    buffer: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    bounds: np.ndarray  # words of text i are bounds[i] .. bounds[i + 1]

    @property
    def text_of(self) -> np.ndarray:
        """Number of the text of each word."""
        return np.repeat(np.arange(len(self.bounds) - 1), np.diff(self.bounds))


def _table(inside: Callable[[int], bool]) -> np.ndarray:
    return np.array([inside(byte) for byte in range(256)], dtype=np.int8)


#: `[^\x20\x09-\x0D]+`
BLANK_SEPARATED = _table(lambda b: b != 0x20 and not 0x09 <= b <= 0x0D)
#: `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+` of text in which A-Z became a-z
ALPHANUMERIC = _table(lambda b: b >= 0x80 or chr(b).isalnum())


def find_words(texts: list[bytes], kind: np.ndarray) -> Words:
    buffer = np.frombuffer(b"\n".join([*texts, b""]), dtype=np.uint8)
    edge = np.diff(kind[buffer], prepend=np.int8(0))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    offsets = np.cumsum([0, *(len(text) + 1 for text in texts)])
    return Words(buffer, starts, ends, np.searchsorted(starts, offsets))


_powers: dict[int, np.ndarray] = {}


def powers(count: int, base: int = _ODD) -> np.ndarray:
    """base ** 0 .. base ** (count - 1), modulo 2 ** 64."""
    have = _powers.get(base)
    if have is None or len(have) < count:
        have = np.full(max(count, 1 << 16, 2 * len(have) if have is not None else 0), base, dtype=U64)
        have[0] = 1
        _powers[base] = have = np.cumprod(have, dtype=U64)
    return have[:count]


def mix(values: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a bijection)."""
    values = (values ^ (values >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> U64(27))) * U64(0x94D049BB133111EB)
    return values ^ (values >> U64(31))


def byte_values(seed: int, lower: bool) -> np.ndarray:
    """A random 64-bit value per byte; with `lower`, A-Z get those of a-z."""
    values = np.random.default_rng(seed).integers(1, 1 << 63, 256, dtype=U64)
    if lower:
        values[ord("A") : ord("Z") + 1] = values[ord("a") : ord("z") + 1]
    return values


def range_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each range of a sequence from its running sums; equal content gives equal hashes wherever it stands."""
    return mix((sums[ends] - sums[starts]) * powers(len(sums), _ODD_INVERSE)[starts])


def running_sums(values: np.ndarray) -> np.ndarray:
    """Sums for `range_hashes` over a sequence of 64-bit values."""
    sums = np.zeros(len(values) + 1, dtype=U64)
    np.cumsum(values * powers(len(values)), out=sums[1:])
    return sums


def word_hashes(words: Words, seed: int = 1, lower: bool = False) -> np.ndarray:
    """64-bit hash of every word; the same in every task."""
    return range_hashes(running_sums(byte_values(seed, lower)[words.buffer]), words.starts, words.ends)
