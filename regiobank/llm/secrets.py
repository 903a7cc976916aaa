"""Secret scan: candidates by pattern, and a random forest that removes false positives.

Candidates are, within blank-separated words, long runs of key characters and what is assigned to a secret-like name, with
or without blanks beside the sign. The forest judges each one by its length, its classes of characters and the transitions between them, how much of it a
dictionary covers, the path it was found under and the words next to it. The dictionary is made of the letter triples
of the words around all candidates, so it speaks the languages of the corpus.

Only DataFrame and SQL functions (with the forest of pyspark.ml); texts are scanned by the JVM.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regiobank.llm.common import keyed, row_order, text_hash, unused
from regiobank.sources.scratch import stage

TREES = 20
DEPTH = 6
SEED = 17
SAMPLE_ROWS = 20_000
THRESHOLD = 0.5
MASK = "[SECRET]"
#: A letter triple is known from this share of all triples of the words around candidates, a third of an even share.
KNOWN_TRIPLE = 2e-5
#: Of the words beside a candidate the ends next to it go with it, so a row is no longer than its own word; a name that
#: assigns a value fits in. Values from LEAST characters on are judged.
NEAR = 64
LEAST = 6

#: Characters of keys, and names that secrets are assigned to; fixed values.
_RUN = r"[A-Za-z0-9+/_\-]{16,}={0,2}"
_NAME = r"(?i:passw(?:or)?d|pwd|secret|token|api_?key|access_?key)"
_NAMED = rf"""{_NAME}\\?["']?\]?"""
_SIGN = r"(?::=|=>|==|[=:])"
_NEXT = rf"""{_NAMED}\s*[=:]"""
#: A value goes on to the closing quote or, without quotes, to a blank, less the signs that close it, or to the next of a
#: row of assignments. In any of them the assignment to another secret-like name starts anew.
_PLAIN = r"[^\s!-/:-@\[-`{-~]++"
_OTHER = r"[!#$%()*+,\-./:;<=>?@\[\]^_`{|}~&]"
_CLOSES = r"[,;&)\]}\\]"
_DOUBLE, _SINGLE = (rf"""(?:{_PLAIN}|\\\S|(?:{_OTHER}|{other})(?!{_NEXT}))*+""" for other in "'\"")
_ESCAPED = rf"""(?:{_PLAIN}|\\(?!["'])|{_OTHER}(?!{_NEXT}))*+"""
_BARE = rf"""(?:{_PLAIN}|(?!{_CLOSES}){_OTHER}(?!{_NEXT})|{_CLOSES}++(?![\s"']|$|(?<=[,;&])[A-Za-z0-9_.\-]++[=:]|{_NEXT}))*+"""
_VALUE = rf"""\\?["']?(?!{_NEXT})((?<=\\["']){_ESCAPED}|(?<=(?<!\\)"){_DOUBLE}|(?<=(?<!\\)'){_SINGLE}|(?<!["']){_BARE})"""
_GIVEN = rf"{_NAMED}{_SIGN}{_VALUE}"
#: The value at the start of a word (after a line feed) that the words before assign.
_LED = rf"{_NAMED}(?: ?{_SIGN}\n|\n{_SIGN}){_VALUE}"
_SPREAD = rf"(?=[pPsStTaA]){_NAMED}(?:\s+[=:]|{_SIGN}\s)"
_PART = r"[^,;&{}]*"
_KEY = r"[\p{Alnum}+/_\-]"
_CANDIDATE = rf"""(?<!{_KEY}){_KEY}{{16}}|[=:](?<={_NAMED}[=:])"""
_ONLY_LETTERS = r"^[\p{L}]+[.,]?$"
_PLACEHOLDER = r"(?i)example|sample|placeholder|changeme|your|dummy|x{6}|\*{4}"

#: How a value is found: assigned within its word, assigned by the words before, or as a run.
GIVEN, LED, RUN = range(3)

FEATURES = [
    "length", "digits", "uppers", "lowers", "others", "letter_digit", "digit_letter", "case_turns", "distinct", "hex",
    "coverage", "path_depth", "path_test", "named", "assigned", "before_length", "before_plain", "after_length", "after_plain",
]


def candidates(docs: DataFrame, path: str | None = None) -> DataFrame:
    """ord, rid, doc_id, path, word (its number among the blank-separated words), value, near, given, and of the words
    beside it before2, before, after (their ends, see NEAR), before_length, before_plain, after_length, after_plain.

    A row per distinct value of a word: all that is assigned to a secret-like name, there or in the two words before, and
    all runs. near is the value with
    what stands beside it: its assignment, or what the word has between it and the next separator or run on each side,
    after the two words before if that reaches to the start of the word. given are the assignments of the value within the
    word. Rows of `docs` (doc_id, text) that repeat count once. `path` names the column with the place a text comes from.
    """
    rows = docs.select("doc_id", "text", (F.col(path).cast("string") if path else F.lit(None).cast("string")).alias("path"))
    told = keyed(rows, F.coalesce("path", F.lit("")).alias("path"))
    told = told.withColumn("spread", F.col("text").rlike(_SPREAD))
    held = told.where(F.col("spread") | F.col("text").rlike(_CANDIDATE)).withColumn("words", F.split("text", r"\s+"))
    words = F.col("words")

    def beside(i: Column, step: int) -> Column:
        return F.coalesce(F.get(words, i + step), F.lit(""))

    def around(word: Column, i: Column) -> Column:
        before, after = beside(i, -1), beside(i, 1)
        return F.struct(
            i.cast("long").alias("word"),
            word.alias("whole"),
            F.right(beside(i, -2), F.lit(NEAR)).alias("before2"),
            F.right(before, F.lit(NEAR)).alias("before"),
            F.left(after, F.lit(NEAR)).alias("after"),
            F.length(before).alias("before_length"),
            before.rlike(_ONLY_LETTERS).alias("before_plain"),
            F.length(after).alias("after_length"),
            after.rlike(_ONLY_LETTERS).alias("after_plain"),
        )

    def led(word: Column, i: Column) -> Column:
        before = F.right(beside(i, -1), F.lit(NEAR))
        return before.rlike(_NAME) | (F.right(beside(i, -2), F.lit(NEAR)).rlike(_NAME) & before.rlike(f"^{_SIGN}$"))

    # words that may hold a candidate, by number; only these get neighbours
    some = F.transform(words, lambda word, i: F.when(word.rlike(_CANDIDATE) | (F.col("spread") & led(word, i)), i))
    picked = F.transform(F.filter(some, lambda i: i.isNotNull()), lambda i: around(F.get(words, i), i))
    found = held.select("ord", "rid", "doc_id", "path", F.explode(picked).alias("x")).select("ord", "rid", "doc_id", "path", "x.*")
    led_word = F.concat(F.concat_ws(" ", "before2", "before"), F.lit("\n"), "whole")
    kept = ["doc_id", "path", "before2", "before", "after", "before_length", "before_plain", "after_length", "after_plain"]
    found = found.select("ord", "rid", "word", *kept, F.explode(F.concat(_given("whole", _GIVEN, GIVEN), _given(led_word, _LED, LED), _runs())).alias("x"))
    # an assignment before a run of the same value
    best = F.min(F.struct("x.kind", "x.near"))["near"].alias("near")
    given = F.collect_set(F.when(F.col("x.kind") == GIVEN, F.col("x.near"))).alias("given")
    return found.groupBy("ord", "rid", "word", F.col("x.value").alias("value")).agg(best, given, *(F.first(c).alias(c) for c in kept))


def _value(kind: int, value: Column, near: Column) -> Column:
    return F.struct(F.lit(kind).alias("kind"), value.alias("value"), near.alias("near"))


def _given(words: Column | str, pattern: str, kind: int) -> Column:
    """The assignments within some words."""
    pairs = F.arrays_zip(F.regexp_extract_all(words, F.lit(pattern), F.lit(1)).alias("value"), F.regexp_extract_all(words, F.lit(pattern), F.lit(0)).alias("near"))
    return F.transform(F.filter(pairs, lambda x: F.length(x["value"]) >= LEAST), lambda x: _value(kind, x["value"], x["near"]))


def _runs() -> Column:
    """The runs of `whole`, each with the ends of the gaps beside it: together no longer than twice the word."""
    gaps = F.split("whole", _RUN)
    places = F.arrays_zip(F.regexp_extract_all("whole", F.lit(_RUN), F.lit(0)).alias("value"), gaps.alias("left"), F.slice(gaps, 2, F.length("whole")).alias("right"))

    def run(x: Column, i: Column) -> Column:
        left = F.regexp_extract(F.substring(x["left"], -NEAR, NEAR), rf"{_PART}$", 0)
        right = F.regexp_extract(F.substring(x["right"], 1, NEAR), f"^{_PART}", 0)
        near = F.concat(left, x["value"], right)
        return _value(RUN, x["value"], F.when((i == 0) & (left == x["left"]), F.concat_ws(" ", "before2", "before", near)).otherwise(near))

    return F.transform(F.filter(places, lambda x: x["value"].isNotNull()), run)


def _share(column: Column, kind: str) -> Column:
    return 1 - F.length(F.regexp_replace(column, kind, "")) / F.length(column)


def _turns(column: Column, one: str, two: str) -> Column:
    return F.regexp_count(column, F.lit(f"(?<={one})(?={two})")) / F.length(column)


def _triples(column: Column) -> Column:
    return F.regexp_extract_all(F.lower(column), F.lit("(?=([a-z]{3}))"), F.lit(1))


def _coverage(found: DataFrame) -> DataFrame:
    """(ord, rid, word, value, coverage): the share of a value's letter triples that the words around candidates know.
    Equal texts speak for them once."""
    around = found.select("rid", "word", "before2", "before", "after").dropDuplicates(["rid", "word"])
    near = around.select(F.explode(F.array("before2", "before", "after")).alias("near")).where(r"near rlike '^[A-Za-z]{3,}[.,]?$'")
    counts = near.select(F.explode(F.array_distinct(_triples(F.col("near")))).alias("triple")).groupBy("triple").agg(F.count(F.lit(1)).alias("n"))
    counts = stage(counts, "triples")  # 26 ** 3 rows at most
    total = counts.agg(F.sum("n")).first()[0] or 0
    known = counts.where(F.col("n") >= KNOWN_TRIPLE * total).select("triple")
    own = found.select("ord", "rid", "word", "value", F.explode(_triples(F.col("value"))).alias("triple"))
    hits = own.join(known.withColumn("hit", F.lit(1)), "triple", "left")
    return hits.groupBy("ord", "rid", "word", "value").agg(F.avg(F.coalesce("hit", F.lit(0))).alias("coverage"))


def with_features(found: DataFrame) -> DataFrame:
    """`candidates` with the columns named in FEATURES."""
    value = F.col("value")
    shown = found.join(_coverage(found), ["ord", "rid", "word", "value"], "left").withColumn("coverage", F.coalesce("coverage", F.lit(0.0)))
    return shown.select(
        "*",
        F.log2(F.length(value)).alias("length"),
        _share(value, "[0-9]").alias("digits"),
        _share(value, "[A-Z]").alias("uppers"),
        _share(value, "[a-z]").alias("lowers"),
        _share(value, "[^0-9A-Za-z]").alias("others"),
        _turns(value, "[A-Za-z]", "[0-9]").alias("letter_digit"),
        _turns(value, "[0-9]", "[A-Za-z]").alias("digit_letter"),
        _turns(value, "[a-z]", "[A-Z]").alias("case_turns"),
        (F.size(F.array_distinct(F.split(value, ""))) / F.length(value)).alias("distinct"),
        value.rlike("^([0-9a-f]+|[0-9A-F]+)$").cast("double").alias("hex"),
        (F.size(F.split("path", "/")) - 1).cast("double").alias("path_depth"),
        F.col("path").rlike("(?i)test|example|sample|mock|doc").cast("double").alias("path_test"),
        F.col("near").rlike(_NAME).cast("double").alias("named"),
        F.col("near").rlike(r"[=:]").cast("double").alias("assigned"),
    ).withColumns({name: F.col(name).cast("double") for name in ("before_length", "before_plain", "after_length", "after_plain")})


def label_by_rule() -> Column:
    """1 for values in the form of a known kind of key, 0 for what certainly is none, null for the rest.

    A stand-in for findings that people have judged, which a caller gives instead where there are any.
    """
    value, near = F.col("value"), F.col("near")
    mixed = value.rlike("[0-9]") & value.rlike("[A-Za-z]")
    return (
        F.when(value.rlike(_PLACEHOLDER), 0)
        .when(value.rlike("^(AKIA|ASIA)[0-9A-Z]{16}$") | value.rlike("^(ghp|gho|ghs|glpat|xox[bp]|sk)[_-][A-Za-z0-9_-]{16,}$"), 1)
        .when(mixed & near.rlike(_NEXT), 1)
        .when(value.rlike("^[a-z]+$") | value.rlike("^[A-Z]?[a-z]+$") | value.rlike("^[0-9]+$"), 0)
        .when(value.rlike("^[0-9A-Fa-f]{8}-([0-9A-Fa-f]{4}-){3}[0-9A-Fa-f]{12}$"), 0)
        .when(value.rlike("^[A-Z]+$") & ~near.rlike(_NAME), 0)
    )


def train(findings: DataFrame, rows: int = SAMPLE_ROWS) -> RandomForestClassificationModel | int:
    """A forest over findings: FEATURES and label (0, 1 or null). Learns from about `rows` distinct values,
    chosen by a hash.

    If all known labels are the same, that label; if there are none, 1.
    """
    known = findings.where(F.col("label").isin(0, 1))
    # one of the places of a value stands for all, so copies neither fill the sample nor hang on one draw
    first = F.min(F.struct("ord", "rid", "word", *FEATURES)).alias("x")
    distinct = stage(known.groupBy("value", "label").agg(first).select("value", "label", "x.*"), "distinct-findings")
    kinds = {row["label"]: row["n"] for row in distinct.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}  # two rows
    if len(kinds) < 2:
        return next(iter(kinds), 1)
    share = F.when(F.col("label") == 1, rows / 2 / kinds[1]).otherwise(rows / 2 / kinds[0])
    chosen = distinct.where(F.pmod(F.xxhash64("value"), F.lit(1 << 20)) < share * (1 << 20))
    vectors = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(chosen)
    forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=SEED, labelCol="label", featuresCol="features", cacheNodeIds=False)
    return forest.fit(vectors.select("features", F.col("label").cast("double").alias("label")))


def scan(docs: DataFrame, path: str | None = None, label: Column | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """A row per candidate of `docs` (doc_id, text): ord, rid, doc_id, word, value, score, secret.

    A word has a row per distinct value; word counts the blank-separated words from 0; ord and rid tell rows of `docs` apart (see `keyed`). score is the
    forest's probability, secret whether it reaches the threshold. `label` is a column over `candidates`: 1 secret, 0
    not, null unknown; without it, `label_by_rule`. Where the known labels are all the same, every
    candidate has that label as its score; without any it is 1, as nothing speaks against them. Null and empty texts have no candidates, rows that repeat count
    once, rows without doc_id keep a null. Other columns are ignored; an empty table gives an empty result.
    """
    found = stage(candidates(docs, path), "candidates")
    told = stage(with_features(found).withColumn("label", label_by_rule() if label is None else label), "findings")
    model = train(told)
    if isinstance(model, int):
        judged = told.withColumn("score", F.lit(float(model)))
    else:
        vectors = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(told)
        judged = model.transform(vectors).withColumn("score", vector_to_array("probability")[1])
    return judged.select("ord", "rid", "doc_id", "word", "value", "score", (F.col("score") >= threshold).alias("secret"), "given")


def _masked(word: Column, mask: str) -> Column:
    """A word in which the places of its secrets, (value, given) in `_secrets`, are masked; longer ones first."""

    def one(text: Column, secret: Column) -> Column:
        value = secret["value"]
        assigned = F.aggregate(
            F.array_sort(secret["given"], lambda a, b: F.length(b) - F.length(a)),
            text,
            lambda t, given: F.replace(t, given, F.concat(F.left(given, F.length(given) - F.length(value)), F.lit(mask))),
        )
        # assigned by the words before: after the sign and an opening quote at most
        at = F.instr(assigned, value)
        opening = F.left(assigned, at - 1)
        led = F.when((at > 0) & opening.rlike(rf"""^(?:{_SIGN})?\\?["']?$"""), F.concat(opening, F.lit(mask), F.substr(assigned, at + F.length(value)))).otherwise(assigned)
        run = F.concat(F.lit(rf"(?<!{_KEY})"), value, F.lit(rf"(?!{_KEY}|=)"))
        return F.when(value.rlike(f"^{_RUN}$"), F.regexp_replace(led, F.regexp_replace(run, r"\+", r"\\\+"), F.lit(mask))).otherwise(led)

    longest = F.array_sort("_secrets", lambda a, b: F.length(b["value"]) - F.length(a["value"]))
    return F.aggregate(longest, word, one)


def redact(docs: DataFrame, path: str | None = None, mask: str = MASK) -> DataFrame:
    """All rows and columns of `docs`; secrets in `text` are replaced by a mask at the places where they were found: as
    the value of an assignment, and as a run of its own within a word that holds it. A column n_chars follows the text."""
    flagged = scan(docs, path).where("secret").groupBy("ord", "rid", "word").agg(F.collect_list(F.struct("value", "given")).alias("_secrets"))
    flagged = stage(flagged, "secrets")
    texts = keyed(docs).select("ord", "rid", "text").join(flagged.select("ord", "rid").distinct(), ["ord", "rid"]).dropDuplicates(["ord", "rid"])
    # the words of a text, each with the blanks behind it
    blanks = F.regexp_extract_all("text", F.lit(r"\s+"), F.lit(0))
    words = texts.select("ord", "rid", F.posexplode(F.arrays_zip(F.split("text", r"\s+").alias("whole"), blanks.alias("blank"))).alias("word", "x"))
    words = words.select("ord", "rid", F.col("word").cast("long").alias("word"), "x.whole", F.coalesce("x.blank", F.lit("")).alias("blank"))
    judged = words.join(flagged, ["ord", "rid", "word"], "left")
    shown = F.when(F.col("_secrets").isNull(), F.col("whole")).otherwise(_masked(F.col("whole"), mask))
    parts = F.array_sort(F.collect_list(F.struct("word", F.concat(shown, "blank").alias("part"))))
    own_ord, own_rid, own_text = unused(docs, "_ord", "_rid", "_masked")
    masked = judged.groupBy(F.col("ord").alias(own_ord), F.col("rid").alias(own_rid)).agg(F.array_join(parts["part"], "").alias(own_text))
    joined = docs.join(masked, (row_order(F.col("doc_id")) == F.col(own_ord)) & (text_hash(F.col("text")) == F.col(own_rid)), "left")
    changed = F.col(own_text).isNotNull()
    out = {"text": F.when(changed, F.col(own_text)).otherwise(F.col("text"))}
    if "n_chars" in docs.columns:
        out["n_chars"] = F.when(changed, F.length(own_text).cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
    return joined.select(*[out[name].alias(name) if name in out else F.col(f"`{name}`") for name in docs.columns])
