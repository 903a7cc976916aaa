import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from regiobank.llm import tokens
from regiobank.llm.queries import op1_token_counts

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)
COUNTER = tokens.counter(PATH)
PARTS = ["don't", "'re", "'r", "we'll", "  ", " ", "\n", "\t", " ", "　", "\x1c", "a", "the", "Z9", "é", "日本", "😀", "!!", "'", "''",
         "<|endoftext|>", "<|endof", "12345", "_", "\x00", "²", "ⅷ", "é", "supercalifragilistic", "--------", "\r\n", " x"]


def library(text):
    return len(LIBRARY.encode(text, add_special_tokens=False).ids)


COMMON = ["don't", "we'll", "'re", "'r", "  ", " ", "\n", "\t", "\xa0", "a", "The", "é", "!!", "'", "½", "12", "…", "ı", " x", "\r\n"]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(COMMON), max_size=12))
def test_common_texts(parts):
    text = "".join(parts)
    assert tokens.COMMON.fullmatch(text)
    test_every_prefix.hypothesis.inner_test([text])


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.sampled_from(PARTS), st.text(max_size=4)), max_size=9))
def test_every_prefix(parts):
    text = "".join(parts)
    wanted = [library(text[:n]) for n in range(len(text) + 1)]
    assert COUNTER.counts(text) == wanted
    assert COUNTER.all_counts(text).tolist() == wanted
    for limit in (0, 1, 3, 7):
        fits = max(n for n, count in enumerate(wanted) if count <= limit)
        assert COUNTER.summaries([text], limit) == [(wanted[-1], fits)]


def test_query_equals_library(spark, folder, documents):
    got = {r.doc_id: r for r in op1_token_counts(spark, folder).collect()}
    assert len(got) == len(documents)
    for doc_id, text in documents:
        text, row = text or "", got[doc_id]
        count = library(text)
        assert (row.n_bytes, row.n_tokens, row.over_limit) == (len(text.encode()), count, count > 512)
        assert row.fits_chars == len(text) if count <= 512 else library(text[: row.fits_chars]) <= 512


def test_prefix_table(spark, table):
    rows = [(1, "We'll  see <|endoftext|> the end."), (2, None), (None, "ab")]
    counts = tokens.prefix_counts(table(rows), PATH)
    got = {r.doc_id: (r.at, r.far, r.fit) for r in counts.select("doc_id", tokens.tokens_of_prefix(7).alias("at"), tokens.tokens_of_prefix(999).alias("far"), tokens.longest_prefix(4).alias("fit")).collect()}
    text = rows[0][1]
    assert got[1] == (library(text[:7]), library(text), max(n for n in range(len(text) + 1) if library(text[:n]) <= 4))
    assert got[2] == (0, 0, 0) and got[None] == (library("ab"), library("ab"), 2)


def test_edges(spark, table):
    rows = [(1, None), (2, ""), (3, "a" * 30000), (3, "word " * 40000), (None, " x")]
    got = sorted((r.doc_id or 0, r.n_tokens) for r in tokens.token_counts(table(rows), PATH).collect())
    assert got == sorted((i or 0, library(t or "")) for i, t in rows)
    assert tokens.token_counts(table([]), PATH).collect() == []


def test_bounded_memory(monkeypatch):
    monkeypatch.setattr(tokens, "KEPT_WORDS", 3)
    monkeypatch.setattr(tokens, "KEPT_PAIRS", 2)
    small = tokens.PrefixCounter(PATH)
    text = "one two three four five six one two three"
    for part in (text, "seven " + text, "one two"):
        assert small.summaries([part], 99) == [(library(part), len(part))]
    assert len(small._texts) <= 3


def test_long_words_are_not_remembered():
    """Texts of long words that never come again: counts are the library's, and what is kept stays small."""
    import random
    import resource

    rng, count = random.Random(4), tokens.PrefixCounter(PATH)

    def texts(number):
        return [" ".join("".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=4000)) for _ in range(5)) for _ in range(number)]

    some = texts(4)
    assert [total for total, _ in count.summaries(some, 512)] == [library(text) for text in some]
    for _ in range(5):
        count.summaries(texts(20), 512)
    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    for _ in range(10):
        count.summaries(texts(20), 512)
    assert resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 60_000
    assert all(len(word) <= tokens.KEPT_CHARS for word in count._texts)
    assert [total for total, _ in count.summaries(some, 512)] == [library(text) for text in some]
