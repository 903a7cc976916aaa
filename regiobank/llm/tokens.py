"""Exact token counts at every prefix of a text, for byte-level BPE vocabularies of the `tokenizers` library.

A BPE encoding is right exactly if each pair of neighbouring tokens is what the pair's own text encodes to. So the last
token of a prefix can be found from shorter prefixes: it is the one token that ends there and agrees with the last token
of the prefix before it. One pass over a word therefore gives the token count of each of its prefixes, and these counts
answer how long a text is, where a budget ends, and how long any truncation is, without encoding again.

The vocabulary's pattern splits texts into words first, and tokens never cross from one word to the next. The same words
come up again and again, so each task keeps what it has counted, up to a bound.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from regiobank.llm.common import map_arrow, slices

LIMIT = 512
KEPT_WORDS = 500_000
KEPT_PAIRS = 1_000_000
#: Longer words are forgotten after their slice of texts: what a task remembers is bounded in bytes, too.
KEPT_CHARS = 64
#: White space as the vocabulary's splitting pattern understands it; fixed values.
_BLANK = [*range(9, 14), 32, 133, 160, 5760, *range(8192, 8203), 8232, 8233, 8239, 8287, 12288]
_BLANKS = re.compile(f"[{''.join(map(chr, _BLANK))}]{{2,}}")
#: Characters whose classes all Unicode versions agree on, and how the vocabulary's pattern splits texts of them;
#: fixed values.
COMMON = re.compile(r"[\t\n\r\x20-\x7E\xA0-ɏ‐-‧‰-›]*")
_LETTERS = r"A-Za-z\xAA\xB5\xBA\xC0-\xD6\xD8-\xF6\xF8-ɏ"
_DIGITS = r"0-9\xB2\xB3\xB9\xBC-\xBE"
_WORDS = re.compile(
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTERS}]+| ?[{_DIGITS}]+| ?[^\s{_LETTERS}{_DIGITS}]+|\s+(?!\S)|\s+"
)
_THREE = ("'re", "'ve", "'ll")


class PrefixCounter:
    """Token counts of prefixes under one vocabulary."""

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        for mark in self.special:
            if " " in mark or not mark:
                raise ValueError(f"special token with a blank: {mark!r}")
        self.find_special = re.compile("|".join(map(re.escape, self.special)) or r"(?!)")
        words = self.tokenizer.get_vocab(with_added_tokens=False)
        self.words = {w: i for w, i in words.items() if self._own_tokens(w) == [w]}
        self.names = {i: w for w, i in self.words.items()}
        self.endings = {word[n:] for word in self.words for n in range(len(word))}
        # the byte alphabet: printable bytes stand for themselves, the others follow from 256 on
        shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
        self.shown = {b: chr(256 + n) for n, b in enumerate(b for b in range(256) if b not in shown)}
        self.blank = self.shown[ord(" ")]
        self._agrees: dict[int, bool] = {}
        self._words: dict[str, list[int]] = {}
        self._texts: dict[str, bytes | array] = {}

    def _own_tokens(self, word: str) -> list[str]:
        return [token.value for token in self.model.tokenize(word)]

    def _agree(self, one: int, two: int) -> bool:
        if len(self._agrees) >= KEPT_PAIRS:
            self._agrees.clear()
        left, right = self.tokenizer.id_to_token(one), self.names[two]
        known = self._agrees[one << 32 | two] = self._own_tokens(left + right) == [left, right]
        return known

    def learn(self, words: set[str]) -> None:
        """Count the prefixes of new words (in the vocabulary's byte alphabet). In order, neighbours share prefixes."""
        ids, endings, agrees, kept = self.words, self.endings, self._agrees, self._words
        last, count, before = [-1], [0], ""
        for word in sorted(words):
            same = 0
            for one, two in zip(word, before):
                if one != two:
                    break
                same += 1
            del last[same + 1 :], count[same + 1 :]
            for end in range(same + 1, len(word) + 1):
                # exactly one token ends here and agrees with what is before it; most often a short one
                start = end - 1
                while True:
                    part = word[start:end]
                    token = ids.get(part)
                    if token is not None:
                        if not start:
                            break
                        key = last[start] << 32 | token
                        agree = agrees.get(key)
                        if agree if agree is not None else self._agree(last[start], token):
                            break
                    elif part not in endings:
                        start = -1
                        break
                    start -= 1
                if start >= 0:
                    last.append(token)
                    count.append(count[start] + 1)
                else:  # a vocabulary whose merges leave this to the library
                    found = self.model.tokenize(word[:end])
                    last.append(found[-1].id)
                    count.append(len(found))
            kept[word] = count.copy()
            before = word

    def word_counts(self, word: str) -> list[int]:
        """Tokens of every prefix of a word, by bytes."""
        if word not in self._words:
            if len(self._words) > 1000:
                self._words.clear()
            self.learn({word})
        return self._words[word]

    def _plain_counts(self, text: str) -> list[int]:
        """Counts by characters, of a text without special tokens."""
        out, base = [0] * (len(text) + 1), 0
        for word, (start, end) in self.tokenizer.pre_tokenizer.pre_tokenize_str(text):
            counts = self.word_counts(word)
            self._place(out, start, text[start:end], counts, base)
            if text[start:end] in _THREE:
                out[start + 2] = base + 2  # cut short, such an ending is a quote and a letter
            base += counts[-1]
        for run in _BLANKS.finditer(text):  # a prefix that ends in a run of blanks has them as one word
            [(word, _)] = self.tokenizer.pre_tokenizer.pre_tokenize_str(run.group())
            self._place(out, run.start(), run.group(), self.word_counts(word), out[run.start()])
        return out

    @staticmethod
    def _place(out: list[int], start: int, text: str, counts: list[int], base: int) -> None:
        at = 0
        for number, char in enumerate(text, start + 1):
            at += 1 if char < "\x80" else len(char.encode("utf-8", "surrogatepass"))
            out[number] = base + counts[at]

    def counts(self, text: str) -> list[int]:
        """Tokens of text[:n] for every n, as the library gives them by default (special strings are special tokens)."""
        out, at, base = [0], 0, 0
        for found in self.find_special.finditer(text):
            mark = found.group()
            part = self._plain_counts(text[at : found.start()] + mark[:-1])
            out += [base + n for n in part[1:]]
            base += part[found.start() - at] + 1
            out.append(base)
            at = found.end()
        return out + [base + n for n in self._plain_counts(text[at:])[1:]]

    def all_counts(self, text: str) -> np.ndarray:
        """Tokens of text[:n] for every n from 0."""
        return np.array(self.counts(text), np.int32)

    def _shown(self, word: str) -> str:
        """A word in the vocabulary's byte alphabet."""
        return word.encode().decode("latin-1").translate(self.shown)

    def summaries(self, texts: list[str], limit: int) -> list[tuple[int, int]]:
        """Tokens of each text, and the length of its longest prefix of at most `limit` tokens.

        Words that are new are counted together; what is known of a word serves every text.
        """
        split = [_WORDS.findall(text) if COMMON.fullmatch(text) and not self.find_special.search(text) else None for text in texts]
        kept = self._texts
        new = {word for words in split if words for word in words if word not in kept}
        if len(kept) + len(new) > KEPT_WORDS:
            kept.clear()
            new = {word for words in split if words for word in words}
        shown = {word: self._shown(word) for word in new}
        self.learn(set(shown.values()))
        for word, name in shown.items():
            counts = self._words[name]
            kept[word] = bytes(counts) if counts[-1] < 256 else array("I", counts)
        self._words.clear()
        out = []
        for text, words in zip(texts, split):
            if words is None:
                counts = self.counts(text)
                out.append((counts[-1], max(n for n, count in enumerate(counts) if count <= limit)))
                continue
            total = sum([kept[word][-1] for word in words])
            out.append((total, len(text) if total <= limit else self._fitting(text, words, limit)))
        for word in [word for word in new if len(word) > KEPT_CHARS]:
            del kept[word]
        return out

    def _fitting(self, text: str, words: list[str], limit: int) -> int:
        """Longest prefix within the limit: by whole words to the last cut before it, then by characters.

        A cut is a blank between two non-blanks. Token counts of the text up to there are those of its words.
        """
        base = place = cut = cut_base = 0
        blank = True
        for word in words:
            if not blank and word[0] == " " and len(word) > 1:
                if base >= limit:
                    break
                cut, cut_base = place, base
            base += self._texts[word][-1]
            place += len(word)
            blank = word[-1].isspace()
        return cut + max(n for n, count in enumerate(self.counts(text[cut:place])) if cut_base + count <= limit)


_counters: dict[str, PrefixCounter] = {}


def counter(path: str) -> PrefixCounter:
    """The counter of a vocabulary file, made once per worker."""
    if path not in _counters:
        _counters[path] = PrefixCounter(path)
    return _counters[path]


def token_counts(docs: DataFrame, path: str, limit: int = LIMIT) -> DataFrame:
    """One row per row of `docs` (doc_id, text): doc_id, n_bytes, n_tokens, over_limit, fits_chars.

    n_tokens is what the library gives for the whole text without added tokens. fits_chars is the length of the longest
    prefix of at most `limit` tokens. Null counts as empty: 0 bytes, 0 tokens. Rows that repeat each get a row. Other
    columns are ignored; an empty table gives an empty result.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(path)
        for batch in slices(batches):
            texts = [text or "" for text in batch.column("text").to_pylist()]
            totals, fits = zip(*count.summaries(texts, limit))
            sizes = pa.array([len(text.encode()) for text in texts], pa.int64())
            rows = [batch.column("doc_id"), sizes, pa.array(totals, pa.int64()), pa.array(fits, pa.int64())]
            yield pa.RecordBatch.from_arrays(rows, ["doc_id", "n_bytes", "n_tokens", "fits_chars"])

    found = map_arrow(docs.select("doc_id", "text"), work, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_bytes long, n_tokens long, fits_chars long")
    return found.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"), "fits_chars")


def prefix_counts(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, counts: `counts[n]` is the token count of the first n characters, for every n from 0 to the whole text.

    A table of these answers truncation and budget questions in SQL, as `tokens_of_prefix` and `longest_prefix` do.
    Null counts as empty: counts is [0].
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(path)
        for batch in slices(batches, most=1 << 18):
            rows = [count.all_counts(text or "") for text in batch.column("text").to_pylist()]
            offsets = np.cumsum([0, *map(len, rows)]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(rows)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), lists], ["doc_id", "counts"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_arrow(docs.select("doc_id", "text"), work, f"doc_id {kind}, counts array<int>")


def tokens_of_prefix(chars):
    """Token count of the first `chars` characters, over a table of `prefix_counts`; of the whole text beyond its end."""
    return F.get("counts", F.least(F.lit(chars), F.size("counts") - 1))


def longest_prefix(budget: int):
    """Characters of the longest prefix within a budget of tokens, over a table of `prefix_counts`."""
    return F.expr(f"size(counts) - 1 - aggregate(reverse(counts), named_struct('n', 0, 'done', false), (a, c) -> "
                  f"if(a.done or c <= {int(budget)}, named_struct('n', a.n, 'done', true), named_struct('n', a.n + 1, 'done', false)), a -> a.n)")  # fmt: skip
