import random
import re

from regiobank.llm import decontaminate
from regiobank.llm.queries import op2_decontamination

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words_of(text):
    return WORD.findall((text or "").translate(LOWER))


def brute_force(docs, items, size=13):
    windows = {}
    for item, text in items:
        words = words_of(text)
        n = min(size, len(words))
        for p in range(len(words) - n + 1 if n else 0):
            windows.setdefault(tuple(words[p : p + n]), set()).add(str(item))
    lengths = {len(w) for w in windows}
    out = []
    for doc, text in docs:
        words, hit, found = words_of(text), set(), set()
        for n in lengths:
            for p in range(len(words) - n + 1):
                if (items_here := windows.get(tuple(words[p : p + n]))) is not None:
                    hit.update(range(p, p + n))
                    found |= items_here
        out.append((doc, len(words), len(hit), tuple(sorted(found)), len(hit) > 0 and 20 * len(hit) >= len(words)))
    return sorted(out, key=str)


def found(df):
    rows = df.select("doc_id", "n_words", "n_hit", "items", "contaminated").collect()
    return sorted(((r[0], r[1], r[2], tuple(r[3]), r[4]) for r in rows), key=str)


def test_documents(spark, folder, documents):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    wanted = brute_force(documents, items)
    assert any(r[4] for r in wanted)
    tables = [spark.read.parquet(f"{folder}/{name}.parquet") for name in ("documents", "benchmark")]
    assert found(decontaminate.contamination(*tables)) == wanted
    clean = decontaminate.clean_documents(*tables)
    assert clean.columns == tables[0].columns
    assert {r.doc_id for r in clean.select("doc_id").collect()} == {r[0] for r in wanted if not r[4]}


def test_query_equals_sql(spark, folder):
    check_sql(spark, folder, "op2_decontamination", op2_decontamination)


def check_sql(spark, folder, name, query):
    import os
    import sys

    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    from compare import connect, differences

    from regiobank.llm.queries import oracle_sql

    with connect(folder) as engine:
        assert differences(query(spark, folder).toPandas(), engine.execute(oracle_sql()[name]).df()) is None


def test_short_items_and_few_letters(spark):
    rng = random.Random(4)
    items = [(n, " ".join(rng.choices("abc", k=rng.choice([1, 2, 3, 7, 12, 13, 14, 30])))) for n in range(25)] + [(98, None), (99, " .")]
    docs = [(n, " - ".join(rng.choices("ABcd", k=rng.randint(0, 80)))) for n in range(60)]
    for i in range(0, 60, 3):
        docs[i] = (i, docs[i][1] + "\n" + rng.choice(items[:25])[1].upper())
    got = decontaminate.contamination(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    )
    assert found(got) == brute_force(docs, items)


def test_edges(spark, table):
    passage = " ".join(f"w{n}" for n in range(15))
    bench = spark.createDataFrame([(7, passage), (7, passage), (10, passage.upper()), (3, None)], "item_id long, text string")
    rows = [(1, None), (2, ""), (3, passage), (3, passage), (None, passage), (4, "x " * 50000 + passage), (5, "w0 w1 w2")]
    got = decontaminate.contamination(table(rows), bench)
    assert found(got) == brute_force(rows, [(7, passage), (10, passage)])
    spans = {r.doc_id: [tuple(s) for s in r.spans] for r in got.collect()}
    assert spans[4] == [(50000, 15)] and spans[5] == []
    clean = decontaminate.clean_documents(table(rows), bench)
    assert sorted(r.doc_id for r in clean.collect()) == [1, 2, 4, 5]
    assert decontaminate.contamination(table([]), bench).count() == 0
    none = spark.createDataFrame([], "item_id long, text string")
    assert [r[2] for r in found(decontaminate.contamination(table(rows), none))] == [0] * 7


def test_largest_id_and_clashing_columns(spark):
    passage = " ".join(f"w{n}" for n in range(15))
    bench = spark.createDataFrame([(7, passage)], "item_id long, text string")
    most = (1 << 63) - 1
    rows = [(most, passage, 1, "r"), (None, passage, 2, "r"), (most, passage, 3, "r"), (most, "other", 4, "r"), (None, "free", 5, "r")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _ord long, _rid string")
    got = decontaminate.contamination(docs, bench).collect()
    assert sorted((str(r.doc_id), r.contaminated) for r in got) == sorted([(str(most), True)] * 2 + [("None", True), (str(most), False), ("None", False)])
    assert sorted(r["_ord"] for r in decontaminate.clean_documents(docs, bench).collect()) == [4, 5]


def test_many_spans_take_no_square_of_the_time(spark):
    """A one-word item and texts of which every other word is hit."""
    import time

    bench = spark.createDataFrame([(1, "hit")], "item_id long, text string")

    def seconds(words):
        docs = spark.createDataFrame([(1, "hit x " * (words // 2))], "doc_id long, text string")
        start = time.time()
        (row,) = decontaminate.contamination(docs, bench).collect()
        assert row.n_hit == words // 2 == len(row.spans) and row.spans[1].start == 2
        return time.time() - start

    seconds(2000)
    assert seconds(80000) < 20
