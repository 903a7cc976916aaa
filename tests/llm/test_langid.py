import zlib

import numpy as np

from regiobank.llm import langid
from regiobank.llm.queries import op5_language_id


def test_held_out_accuracy(spark, folder):
    langs = {r.doc_id: r.lang for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang").collect()}
    rows = op5_language_id(spark, folder).collect()
    assert len(rows) == len(langs)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 for r in rows)
    assert np.mean([r.lang_pred == langs[r.doc_id] for r in rows if r.held_out]) >= 0.9


def test_gradients():
    model = langid.new_model(3, state=4, kind=np.float64)
    rng = np.random.default_rng(0)
    windows, lengths = rng.integers(0, 256, (5, 9)).astype(np.uint8), np.array([9, 3, 1, 9, 6])
    labels = np.array([0, 1, 2, 1, 0])
    _, grads = langid.loss_and_gradients(model, windows, lengths, labels)
    for values, grad in zip(langid._parameters(model), grads):
        for _ in range(8):
            at = tuple(int(rng.integers(0, n)) for n in values.shape)
            if len(values) == 256:
                at = (int(windows[0, 4]), at[1])
            kept, sides = values[at], []
            for step in (1e-6, -1e-6):
                values[at] = kept + step
                sides.append(langid.loss_and_gradients(model, windows, lengths, labels)[0])
            values[at] = kept
            assert abs((sides[0] - sides[1]) / 2e-6 - grad[at]) < 1e-7


def test_pooling_is_the_mean_over_positions():
    model = langid.new_model(3)
    texts = [b"", b"x", b"ab" * 100, b"c" * langid.WINDOW]
    got = langid.document_probabilities(model, texts)
    for text, row in zip(texts, got):
        parts = [text[at : at + langid.WINDOW] for at in range(0, len(text), langid.WINDOW)]
        seen = [langid.position_probabilities(model, np.frombuffer(p, np.uint8)[None], np.array([len(p)]))[:, 0] for p in parts]
        wanted = np.concatenate(seen).mean(axis=0) if seen else np.zeros(3)
        assert np.allclose(row, wanted, atol=1e-5)


def test_edges(spark):
    rows = [(n, f"der die das und {n}" if n % 2 else f"the and of {n}", "de" if n % 2 else "en") for n in range(300)]
    rows += [(1000, None, "en"), (1001, "", None), (1002, "12 !?", "de"), (1004, "\u00bd \u00b2 \u2167", None), (1005, "\u00aa", None), (None, "the and", "en"), (1003, "the of and " * 9000, None), (7, "the", "x y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = langid.identify(docs.selectExpr("*", "'x' AS score", "1 AS lang_pred", "0 AS letter", "2 AS held_out")).collect()
    assert len(got) == len(rows)
    by_id = {r.doc_id: r for r in got}
    assert [(by_id[i].lang_pred, by_id[i].score) for i in (1000, 1001, 1002, 1004)] == [("und", 0.0)] * 4 and by_id[1005].lang_pred != "und"
    assert by_id[1003].lang_pred == "en" and by_id[None].held_out
    assert langid.identify(docs.where("false")).collect() == []
    blank = langid.identify(docs.where("doc_id < 5").selectExpr("doc_id", "text", "cast(null as string) lang"))
    assert {r.lang_pred for r in blank.collect()} == {"und"}
