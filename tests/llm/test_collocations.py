import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from regiobank.llm import collocations, sql
from regiobank.llm.queries import op11_collocations

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_force(rows, longest=3, least=10, held=50, best=2000):
    counts, totals = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", (text or "").translate(LOWER)):
            words = re.findall("[^ \t]+", piece)
            totals[lang] += len(words)
            for size in range(1, longest + 1):
                counts[lang].update(tuple(words[p : p + size]) for p in range(len(words) - size + 1))
    out = []
    for lang, f in counts.items():
        chosen = {x: n for x, n in f.items() if len(x) > 1 and n >= least}
        longer = Counter()
        for x, n in chosen.items():
            for size in range(2, len(x)):
                for p in range(len(x) - size + 1):
                    longer[x[p : p + size]] = max(longer[x[p : p + size]], n)
        found = []
        for x, a in chosen.items():
            if x in longer and 100 * longer[x] >= held * a:
                continue
            score, _, l, r = min((1000000 * a * a // (f[x[:k]] * f[x[k:]]), k, f[x[:k]], f[x[k:]]) for k in range(1, len(x)))
            found.append((-score, -a, " ".join(x).encode(), l, r))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(found)[:best], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, totals[lang], -score))
    return sorted(out)


def as_rows(df):
    return sorted(tuple(row) for row in df.collect())


def docs(spark, rows):
    return spark.createDataFrame([(*row, "x", 1, "s") for row in rows], "lang string, text string, w1 string, n long, spread string")


def test_query_equals_brute_force(spark, folder):
    rows = [(r.lang, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    wanted = brute_force(rows)
    assert len(wanted) > 100
    assert as_rows(op11_collocations(spark, folder)) == wanted


def test_query_equals_sql(spark, folder):
    from compare import connect, differences

    with connect(folder) as con:
        assert differences(op11_collocations(spark, folder).toPandas(), con.execute(sql.oracle_sql()["op11_collocations"]).df()) is None


@pytest.mark.parametrize("longest,least,held,best", [(2, 3, 50, 20), (3, 2, 100, 1000), (4, 3, 60, 50), (3, 1, 0, 500)])
def test_made_up_texts(spark, longest, least, held, best):
    rng = random.Random(longest * 31 + least)
    parts = ["a", "B", "b", "c", "é", "É", "\t", " ", ".", "\n", "\x0b", "\r", "!", " x", "0", "a-b", "\x00", "日本", "d"]
    rows = [(rng.choice(["en", "de", None, "und", ""]), " ".join(rng.choices(parts, k=rng.randint(0, 60)))) for _ in range(80)]
    rows += [("en", None), (None, ""), ("en", " \t \n"), ("de", rows[0][1]), ("en", "q " * 3000), ("fr", "only")]
    rng.shuffle(rows)
    got = collocations.collocations(docs(spark, rows).repartition(5), longest, least, held, best)
    assert as_rows(got) == brute_force(rows, longest, least, held, best)


def test_a_hot_pair_is_spread(spark, monkeypatch):
    monkeypatch.setattr(collocations, "HOT_LEAST", 5)
    rng = random.Random(5)
    rows = [("en", " ".join(f"hot pair w{rng.randint(0, 40)}" for _ in range(30))) for _ in range(150)]
    monkeypatch.setattr(collocations, "SAMPLED", 2)
    assert len(collocations.shape_of(docs(spark, rows)).hot)
    assert as_rows(collocations.collocations(docs(spark, rows))) == brute_force(rows)


def test_all_starts_anew_if_two_words_share_an_id(spark, monkeypatch):
    right, seeds = collocations._dictionary, []

    def crude(docs, seed):
        seeds.append(seed)
        found = right(docs, seed)
        return found.unionByName(found.withColumn("word", F.concat("word", F.lit("x")))) if len(seeds) == 1 else found

    monkeypatch.setattr(collocations, "_dictionary", crude)
    rows = [("en", "one two three four five six " * 20)]
    assert as_rows(collocations.collocations(docs(spark, rows))) == brute_force(rows)
    assert len(seeds) == 2


def test_the_dictionary_has_every_word_once(spark):
    rows = [("en", "one two, ONE two three"), ("de", "three Ä ä"), ("de", None)]
    found = collocations._dictionary(docs(spark, rows), collocations.SEED).collect()
    assert sorted(r.word for r in found) == ["one", "three", "two", "Ä", "ä"]
    assert len({r.id for r in found}) == 5


def test_large_counts_stay_exact(spark):
    # 3e9 * 3e9 * 1000000 does not fit into 64 bits
    big = spark.range(1).select(F.lit(3_000_000_000).alias("a"))
    a = F.col("a").cast("decimal(18,0)")
    found = big.select((F.lit(1000000).cast("decimal(7,0)") * a * a).cast("decimal(38,0)").alias("x"), (a * (a + 1)).cast("decimal(38,0)").alias("y"))
    assert found.selectExpr("x div y AS score").first().score == 999999


def test_empty_table(spark):
    assert collocations.collocations(docs(spark, [])).collect() == []
