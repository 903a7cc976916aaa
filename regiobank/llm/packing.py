"""Retrieval packing: documents that are lexically close share a training sequence.

1. Every document is encoded. Its full windows are sequences of their own; what is left of it, shorter than a window, is
   its rest. Token statistics (document frequencies, at most one row per vocabulary entry) are summed over all rests.
2. Rests are dealt to shards by lexical key, the strongest terms of a rest by idf and count, in order of strength. Shards
   are ranges of keys with a hash as the last part of the key, so a key that many rests share spreads over several shards,
   and which file a document came from plays no part.
3. Each shard is a BM25 inverted index. The longest unused rest is a seed; all its terms are the query, and the index
   returns its unused neighbours, which fill its window, best first. The last one is cut where it does not fit, and what
   is cut off stays unused. So all windows are full but the last of a shard, which is cut into powers of two.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import ByteLevel

from regiobank.llm.common import map_arrow, slices
from regiobank.llm.tokens import COMMON
from regiobank.sources.scratch import stage

WINDOW = 2048
END = 1
SHARD_TOKENS = 1 << 20
SHARD_ROWS = 4096
K1, B = 1.2, 0.75
#: Terms in a lexical key. It orders rests; what a shard compares is all terms.
KEY = [f"term{n}" for n in range(4)]
#: Terms that one in so many documents of a shard holds have a row of a matrix instead of a list of postings.
COMMON_TERM = 4
#: How byte-level vocabularies of this family split text; a fixed value.
_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


class Encoder:
    """Token ids of texts under one vocabulary file of `tokenizers`.

    Texts of common characters go through `tiktoken`, which applies the same merges several times faster, if the
    vocabulary allows it: ids in the order of the merges, and every token the encoding of its own text. Then both apply
    the same merges in the same order. Texts with other characters or special strings go through `tokenizers`.
    """

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.size = self.tokenizer.get_vocab_size()
        marks = [token.content for token in self.tokenizer.get_added_tokens_decoder().values()]
        self.find_mark = re.compile("|".join(map(re.escape, marks)) or r"(?!)")
        self.fast = self._ranked(path)

    def _ranked(self, path: str) -> tiktoken.Encoding | None:
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        words = self.tokenizer.get_vocab(with_added_tokens=False)
        merged = [words.get("".join(pair.split(" ") if isinstance(pair, str) else pair)) for pair in model.get("merges", [])]
        plain = isinstance(self.tokenizer.pre_tokenizer, ByteLevel) and self.tokenizer.normalizer is None
        if not plain or None in merged or merged != sorted(merged) or len(merged) + 256 != len(words):
            return None
        if any([token.value for token in self.tokenizer.model.tokenize(word)] != [word] for word in words):
            return None
        # the byte alphabet: printable bytes stand for themselves, the others follow from 256 on
        shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
        byte_of = {chr(b): b for b in shown} | {chr(256 + n): b for n, b in enumerate(b for b in range(256) if b not in shown)}
        ranks = {bytes(byte_of[char] for char in word): number for word, number in words.items()}
        return tiktoken.Encoding("ranked", pat_str=_PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        out: list[np.ndarray | None] = [None] * len(texts)
        slow = []
        for number, text in enumerate(texts):
            if self.fast and COMMON.fullmatch(text) and not self.find_mark.search(text):
                out[number] = np.array(self.fast.encode_ordinary(text), "<u4")
            else:
                slow.append(number)
        found = self.tokenizer.encode_batch_fast([texts[n] for n in slow], add_special_tokens=False)
        for number, encoding in zip(slow, found):
            out[number] = np.array(encoding.ids, "<u4")
        return out


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


_PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
_NAMES = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
_REST = ["doc_id", "start", "doc_tokens", "ids"]


def _crc(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


def term_counts(ids: np.ndarray, lengths: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, term, times) of the distinct terms of rests that follow each other in `ids`, by row and term."""
    bits = int(size).bit_length()
    # half as wide where that holds all numbers: sorting them takes most of the time
    kind = np.uint32 if len(lengths) << bits <= 1 << 32 else np.uint64
    row = np.repeat(np.arange(len(lengths), dtype=kind) << kind(bits), lengths)
    found, times = np.unique(row | ids.astype(kind), return_counts=True)
    return (found >> kind(bits)).astype(np.int64), (found & kind((1 << bits) - 1)).astype(np.int64), times


def inverse_frequency(documents: np.ndarray, count: int) -> np.ndarray:
    return np.log1p((count - documents + 0.5) / (documents + 0.5))


def _encode(path: str, window: int, end: int, size: int, kind: type):
    schema = pa.schema(
        [(name, pa.int64()) for name in _NAMES]
        + [("ids", pa.binary()), ("terms", pa.list_(pa.int32())), ("documents", pa.list_(pa.int64()))]
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Full windows as pieces, rests with their ids, and at the end the document frequencies of the task's rests."""
        code = encoder(path)
        sequence, documents = TaskContext.get().partitionId() << 40, np.zeros(size, dtype=np.int64)
        for batch in slices(batches):
            out, rests = [], []
            all_ids = code.encode([text or "" for text in batch.column("text").to_pylist()])
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), all_ids):
                ids = np.append(ids, np.uint32(end))
                whole = len(ids) // window * window
                for start in range(0, whole, window):
                    piece = (doc_id, start, window, _crc(ids[start : start + window]), len(ids), sequence, 0)
                    out.append(dict(zip(_NAMES, piece)))
                    sequence += 1
                if whole < len(ids):
                    rests.append(ids[whole:])
                    row = {"doc_id": doc_id, "start": whole, "length": len(rests[-1]), "doc_tokens": len(ids)}
                    out.append(row | {"ids": rests[-1].astype(kind).tobytes()})
            if rests:
                lengths = np.array([len(rest) for rest in rests])
                documents += np.bincount(term_counts(np.concatenate(rests), lengths, size)[1], minlength=size)
            yield pa.RecordBatch.from_pylist(out, schema=schema)
        terms = np.flatnonzero(documents)
        if len(terms):
            yield pa.RecordBatch.from_pylist([{"terms": terms, "documents": documents[terms]}], schema=schema)

    return work


def _add_keys(idf: np.ndarray, kind: type):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "ids"):
            parts = [np.frombuffer(value, kind) for value in batch.column("ids").to_pylist()]
            keys = lexical_keys(np.concatenate(parts), np.array([len(part) for part in parts]), idf)
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(k, pa.int32()) for k in keys)], [*batch.schema.names, *KEY])

    return work


def lexical_keys(ids: np.ndarray, lengths: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """The strongest terms of each rest, one row per place in `KEY`; -1 where a rest has fewer terms."""
    row, term, times = term_counts(ids, lengths, len(idf))
    order = np.lexsort((-idf[term] * times, row))
    first = np.searchsorted(row, np.arange(len(lengths) + 1))
    at = first[:-1] + np.arange(len(KEY))[:, None]
    return np.where(at < first[1:], term[order][np.minimum(at, len(term) - 1)], -1)


class Shard:
    """BM25 inverted index over the rests of one shard.

    Postings of common terms are rows of a matrix over all documents, so those of a query are added up as one product.
    """

    def __init__(self, ids: np.ndarray, lengths: np.ndarray, idf: np.ndarray, mean: float):
        doc, term, times = term_counts(ids, lengths, len(idf))
        weight = idf[term] * times * (K1 + 1) / (times + K1 * (1 - B + B * lengths[doc] / mean))
        held = np.bincount(term, minlength=len(idf))
        common = held * COMMON_TERM >= len(lengths)
        slot, rare = np.cumsum(common) - 1, ~common[term]
        self.matrix = np.zeros((np.count_nonzero(common), len(lengths)))
        self.matrix[slot[term[~rare]], doc[~rare]] = weight[~rare]
        self.common = slot[term[~rare]], np.searchsorted(doc[~rare], np.arange(len(lengths) + 1))
        self.rare = term[rare], np.searchsorted(doc[rare], np.arange(len(lengths) + 1))
        order = np.argsort(term[rare], kind="stable")
        self.docs, self.weights = doc[rare][order], weight[rare][order]
        self.first = np.searchsorted(term[rare][order], np.arange(len(idf) + 1))

    def scores(self, doc: int) -> np.ndarray:
        """Score of every document of the shard for all terms of one."""
        asked = np.zeros(len(self.matrix))
        asked[self.common[0][self.common[1][doc] : self.common[1][doc + 1]]] = 1
        score = asked @ self.matrix
        mine = self.rare[0][self.rare[1][doc] : self.rare[1][doc + 1]]
        if len(mine):
            spans = [slice(start, end) for start, end in zip(self.first[mine].tolist(), self.first[mine + 1].tolist())]
            docs = np.concatenate([self.docs[s] for s in spans])
            score += np.bincount(docs, np.concatenate([self.weights[s] for s in spans]), minlength=len(score))
        return score


def pack(index: Shard, lengths: np.ndarray, window: int) -> list[list[tuple[int, int, int]]]:
    """Sequences of (document, first token, tokens); each is `window` tokens long, but for the last one.

    Seeds are the longest documents first, neighbours the unused ones by falling score; ties go to the earlier document.
    """
    left, taken = lengths.copy(), np.zeros(len(lengths), dtype=np.int64)
    out: list[list[tuple[int, int, int]]] = []

    def take(doc: int, most: int) -> tuple[int, int, int]:
        n = int(min(left[doc], most))
        piece = (doc, int(taken[doc]), n)
        taken[doc] += n
        left[doc] -= n
        return piece

    for seed in np.argsort(-lengths, kind="stable").tolist():
        if not left[seed]:
            continue
        sequence = [take(seed, window)]
        room = window - sequence[0][2]
        if room:
            unused = np.flatnonzero(left)
            near = unused[np.argsort(-index.scores(seed)[unused], kind="stable")]
            for doc in near[: int(np.searchsorted(np.cumsum(left[near]), room)) + 1].tolist():
                sequence.append(take(doc, room))
                room -= sequence[-1][2]
        out.append(sequence)
    return out


def powers_of_two(sequence: list[tuple[int, int, int]]) -> list[list[tuple[int, int, int]]]:
    """Cut a sequence into sequences whose lengths are different powers of two, the longest first."""
    total = sum(n for _, _, n in sequence)
    out = []
    todo = list(sequence)
    for bit in range(total.bit_length() - 1, -1, -1):
        room, part = total & 1 << bit, []
        while room:
            doc, start, n = todo.pop(0)
            used = min(room, n)
            part.append((doc, start, used))
            room -= used
            if used < n:
                todo.insert(0, (doc, start + used, n - used))
        if part:
            out.append(part)
    return out


def _pack_shards(idf: np.ndarray, mean: float, kind: type, window: int, most_tokens: int, most_rows: int):
    def packed(rows: list[dict], first: int) -> pa.RecordBatch:
        parts = [np.frombuffer(row["ids"], kind) for row in rows]
        lengths, ids = np.array([len(part) for part in parts]), np.concatenate(parts)
        sequences = pack(Shard(ids, lengths, idf, mean), lengths, window)
        whole = [s for s in sequences if sum(n for _, _, n in s) == window]
        short = [part for s in sequences if sum(n for _, _, n in s) < window for part in powers_of_two(s)]
        out = []
        for number, sequence in enumerate(whole + short, first):
            offset = 0
            for doc, start, n in sequence:
                row, crc = rows[doc], _crc(parts[doc][start : start + n])
                out.append((row["doc_id"], row["start"] + start, n, crc, row["doc_tokens"], number, offset))
                offset += n
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], _NAMES)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A range of keys is a shard; should it be larger than it may be, it is several."""
        first, rows, tokens = TaskContext.get().partitionId() << 40 | 1 << 39, [], 0
        for batch in batches:
            for row in batch.to_pylist():
                rows.append(row)
                tokens += len(row["ids"]) // np.dtype(kind).itemsize
                if tokens >= most_tokens or len(rows) >= most_rows:
                    yield packed(rows, first)
                    first, rows, tokens = first + (1 << 24), [], 0
        if rows:
            yield packed(rows, first)

    return work


def keyed_rests(rests: DataFrame, idf: np.ndarray, kind: type) -> DataFrame:
    """The rests (doc_id, start, doc_tokens, ids) with the columns of their lexical key."""
    schema = "doc_id long, start long, doc_tokens long, ids binary, " + ", ".join(f"{name} int" for name in KEY)
    return map_arrow(rests.select(*_REST), _add_keys(idf, kind), schema)


def deal(keyed: DataFrame, shards: int) -> DataFrame:
    """Partitions that are ranges of lexical keys, ordered by key; a key that is in many rows is split by hash."""
    order = [*KEY, F.xxhash64("doc_id", "start", "ids"), "doc_id", "start", "ids"]
    return keyed.repartitionByRange(shards, *order[: len(KEY) + 1]).sortWithinPartitions(*order)


def pack_documents(
    docs: DataFrame, path: str, window: int = WINDOW, end: int = END,
    shard_tokens: int = SHARD_TOKENS, shard_rows: int = SHARD_ROWS,
) -> DataFrame:
    """Pieces of sequences: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A document (doc_id, text) is the ids of its text and the id `end`; each id lies in exactly one piece. Sequences
    have `window` tokens or a power of two. Null texts are empty: they consist of `end`. Rows without doc_id, and rows
    that repeat, are documents of their own. Other columns are ignored. An empty table gives an empty result.
    Shards aim at `shard_tokens` and at most `shard_rows` rests; none has more than twice as much.
    """
    size = max(Tokenizer.from_file(path).get_vocab_size(), end + 1)
    kind = np.uint16 if size <= 1 << 16 else np.uint32
    schema = f"{_PIECE}, ids binary, terms array<int>, documents array<long>"
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    encoded = stage(map_arrow(rows, _encode(path, window, end, size, kind), schema), "encoded")
    held = encoded.where("terms IS NOT NULL").select(F.explode(F.arrays_zip("terms", "documents")).alias("x"))
    documents = np.zeros(size, dtype=np.int64)  # one number per entry of the vocabulary
    for row in held.groupBy("x.terms").agg(F.sum("x.documents").alias("n")).toLocalIterator():
        documents[row["terms"]] = row["n"]
    rests = encoded.where("ids IS NOT NULL")
    count, tokens = rests.agg(F.count(F.lit(1)), F.coalesce(F.sum("length"), F.lit(0))).first()
    idf, mean = inverse_frequency(documents, count), max(tokens / max(count, 1), 1.0)
    # staged: ranges are found from a sample, which reads its input once more
    keyed = stage(keyed_rests(rests, idf, kind), "keyed")
    shards = max(1, -(-tokens // shard_tokens), -(-count // shard_rows))
    packing = _pack_shards(idf, mean, kind, window, 2 * shard_tokens, 2 * shard_rows)
    # staged: another run might find other ranges
    packed = stage(map_arrow(deal(keyed, shards).select(*_REST), packing, _PIECE), "packed")
    return encoded.where("sequence_id IS NOT NULL").select(*_NAMES).unionByName(packed)
