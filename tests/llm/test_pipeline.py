import re

import corpus_pipeline
import pytest
from test_decontaminate import brute_force as contaminated
from test_packing import check as check_sequences
from test_simhash import plain_components, plain_fingerprint

from regiobank.llm import quality, secrets
from regiobank.sources.scratch import stage


@pytest.fixture(scope="module")
def steps(spark, folder):
    docs = [spark.read.parquet(f"{folder}/documents.parquet")]
    for name, work in corpus_pipeline.STAGES:
        docs.append(stage(work(spark, docs[-1], folder), "step"))
    return docs


def rows_of(df):
    return {r.doc_id: r.text for r in df.select("doc_id", "text").collect()}


def test_stages_equal_brute_force(spark, folder, steps):
    start, good, single, clean, masked, packed = steps
    for df in (good, single, clean, masked):
        assert df.columns == start.columns
    labels = spark.read.parquet(f"{folder}/labels.parquet").withColumnRenamed("quality", "label")
    wanted = {r.doc_id for r in quality.classify(start, labels).where("predicted = 1").collect()}
    texts = rows_of(good)
    assert set(texts) == wanted and good.count() == len(wanted)
    roots = plain_components({i: plain_fingerprint(t) for i, t in texts.items()}, 4)
    texts = {i: t for i, t in texts.items() if roots[i] == i}
    assert rows_of(single) == texts and single.count() == len(texts) < len(wanted)
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    bad = {row[0] for row in contaminated(list(texts.items()), items) if row[4]}
    texts = {i: t for i, t in texts.items() if i not in bad}
    assert bad and rows_of(clean) == texts
    for r in secrets.scan(clean, "source").where("secret").collect():
        parts = re.split(r"(\s+)", texts[r.doc_id])
        assert r.value in parts[2 * r.word]
        parts[2 * r.word] = parts[2 * r.word].replace(r.value, secrets.MASK.lower())
        texts[r.doc_id] = "".join(parts)
    texts = {i: t and t.replace(secrets.MASK.lower(), secrets.MASK) for i, t in texts.items()}
    assert rows_of(masked) == texts
    check_sequences(packed.collect(), list(texts.items()))


def test_run(spark, folder, steps):
    assert sorted(map(tuple, corpus_pipeline.run(spark, folder).collect())) == sorted(map(tuple, steps[-1].collect()))


def test_edges(spark, folder, tmp_path):
    """Rows that repeat, nulls everywhere, empty tables."""
    rows = [(1, "a b c d e", "en", "s", 9), (1, "a b c d e", "en", "s", 9), (None, None, None, None, None), (None, "x", "en", None, 1), (2, "a b c d e", None, "s", 9), (3, None, "en", "s", 0), (4, "word " * 30000, "en", "s", 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    out = docs
    for name, work in corpus_pipeline.STAGES[:4]:
        out = stage(work(spark, out, folder), "step")
        assert out.columns == docs.columns
    assert sorted((r.doc_id or 0, r.text or "") for r in out.collect()) == [(0, ""), (0, "x"), (1, "a b c d e"), (3, ""), (4, "word " * 30000)]
    none = docs.where("false")
    for name, work in corpus_pipeline.STAGES:
        none = work(spark, none, folder)
        assert none.collect() == []


def test_columns_of_documents_may_have_any_names(spark, folder):
    names = ["_id", "_rid", "_ord", "_score_text", "score", "_masked", "has_id", "letter"]
    rows = [(n, f"some words of text number {n} and more of them", "en", "s", 9, *names) for n in range(4)]
    columns = ", ".join(f"{name} string" for name in names)
    out = spark.createDataFrame(rows, f"doc_id long, text string, lang string, source string, n_chars long, {columns}")
    for name, work in corpus_pipeline.STAGES[:4]:
        out = stage(work(spark, out, folder), "step")
        assert out.columns[5:] == names and all(tuple(r)[5:] == tuple(names) for r in out.collect())
