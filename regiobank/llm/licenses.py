"""License scan: phrases at their places, and an exact set-similarity join of text blocks with license notices.

The join finds every block that contains at least a given share of a notice's distinct words, and all words that name its
license. Blocks are windows over the words of a text, whatever its lines: twice as long as the notices they are for and
half overlapping, so a notice lies within one wherever it stands and however it is wrapped. Words of the
notices are ordered by their frequency in all texts, rare ones first. A block with enough words in common must share one
of a notice's first words in that order (prefix filter), must have as many words as have to be shared (length filter),
and must have enough words left after the first shared one on both sides (position filter). What is left is compared in
full. Only DataFrame operations; the notices are a small table given by the caller, the texts are read as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from regiobank.llm.common import keyed, lowered
from regiobank.sources.scratch import stage

SHARE = 0.8
#: Runs of ASCII digits and letters and of all other characters beyond ASCII. In text in which A-Z became a-z these are
#: the words `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`; there are as many in the text as it is.
WORD = r"[\p{Alnum}[^\p{ASCII}]]+"

#: Phrases whose places are reported, with their labels; fixed values.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

#: Blocks are for notices of up to so many words, or up to a power of two of that.
WIDTH = 8

#: Sentences by which licenses are given, with their labels and the words without which they give another license.
NOTICES = [
    ("apache", "Licensed under the Apache License, Version 2.0", "apache license"),
    ("apache", "You may not use this file except in compliance with the License. You may obtain a copy of the License at", "compliance"),
    ("mit", "Released under the MIT License", "mit license"),
    ("mit", "Licensed under the MIT License", "mit license"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software", "permission granted"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3", "general public"),
    ("gpl", "you can redistribute it and/or modify it under the terms of the GNU General Public License", "general public"),
    ("lgpl", "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License", "lesser general public"),
    ("agpl", "you can redistribute it and/or modify it under the terms of the GNU Affero General Public License", "affero general public"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted", "redistribution"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0", "mozilla public"),
    ("cc-by", "Licensed under CC BY 4.0", "cc by"),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0", "cc by sa"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0", "cc by nc"),
    ("cc-by-nc-sa", "Licensed under CC BY-NC-SA 4.0", "cc by nc sa"),
    ("cc0", "has waived all copyright and related or neighboring rights to this work", "waived"),
    ("unlicense", "This is free and unencumbered software released into the public domain", "unencumbered"),
]


def notice_table(spark: SparkSession, notices: list[tuple[str, str, str]] = NOTICES) -> DataFrame:
    return spark.createDataFrame(notices, "label string, text string, naming string")


def _words(column: Column) -> Column:
    return F.regexp_extract_all(lowered(column), F.lit(WORD), F.lit(0))


def _ranked_notices(texts: DataFrame, notices: DataFrame, share: float) -> DataFrame:
    """notice, label, width, size, need, ranks (of all its words, rare ones first), tokens in that order, naming ranks."""
    if "naming" not in notices.columns:
        notices = notices.withColumn("naming", F.lit(""))
    told = notices.where(F.col("text").isNotNull() & F.col("label").isNotNull()).select("label", _words(F.col("text")).alias("w"), _words(F.coalesce("naming", F.lit(""))).alias("n"))
    # the least width, from WIDTH on by powers of two, that the notice fits in
    width = F.expr(f"CAST(power(2, greatest(ceil(log2(size(w))), {WIDTH.bit_length() - 1})) AS INT)").alias("width")
    sets = told.where(F.size("w") > 0).select("label", F.array_distinct("w").alias("set"), F.array_sort(F.array_distinct(F.array_intersect("n", "w"))).alias("naming"), width)
    sets = sets.distinct().withColumn("notice", F.xxhash64("label", F.array_join("set", " "), F.array_join("naming", " "), "width"))
    words = sets.select(F.explode("set").alias("token")).distinct()
    words = stage(words, "notice-words")
    seen = texts.select(F.explode(_words(F.col("text"))).alias("token")).join(words, "token").groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    counted = words.join(seen, "token", "left").select("token", F.coalesce("n", F.lit(0)).alias("n"))
    # a row per word of the notices, so one task numbers them
    order = counted.select("token", F.row_number().over(Window.orderBy("n", "token")).alias("rank"))
    parts = sets.select("notice", "label", "naming", "width", F.explode("set").alias("token")).join(order, "token")
    names = F.collect_list(F.when(F.array_contains("naming", F.col("token")), F.col("rank"))).alias("names")
    grouped = parts.groupBy("notice", "label", "width").agg(F.sort_array(F.collect_list(F.struct("rank", "token"))).alias("by_rank"), names)
    size = F.size("by_rank")
    return grouped.select(
        "notice",
        "label",
        "width",
        size.alias("size"),
        F.greatest(F.ceil(F.round(size * share, 9)), F.lit(1)).cast("int").alias("need"),
        F.col("by_rank.rank").alias("ranks"),
        F.col("by_rank.token").alias("tokens"),
        "names",
    )


def _blocks(heads: dict[int, list[str]]) -> Column:
    """For the words `w` of a text the blocks that hold a head of their width: (width, block, words)."""
    w, n = F.col("w"), F.size("w")

    def of_width(width: int) -> Column:
        at = F.filter(F.transform(w, lambda x, i: F.when(x.isin(heads[width]), F.floor(i / width).cast("int"))), lambda b: b.isNotNull())
        # every word lies in the block that begins with its own stretch and in the one before it
        blocks = F.filter(F.array_distinct(F.flatten(F.transform(at, lambda b: F.array(b - 1, b)))), lambda b: b >= 0)
        held = lambda b: F.transform(F.sequence(b * width, F.least(b * width + 2 * width, n) - 1), lambda i: F.get(w, i))
        return F.transform(blocks, lambda b: F.struct(F.lit(width).alias("width"), b.alias("block"), F.array_distinct(held(b)).alias("set")))

    return F.concat(*[of_width(width) for width in sorted(heads)])


def matching_blocks(docs: DataFrame, notices: DataFrame, share: float = SHARE) -> DataFrame:
    """(ord, rid, width, block, notice, label, ranks, containment) for every block that holds at least `share` of a notice's
    words and all its naming words.

    `notices` has label, text and, if wanted, naming: those words of the text without which it gives another license. ord
    and rid tell the rows of `docs` apart (see `keyed`); block b of a width has the words from b * width on, twice as many.
    Words are compared with A-Z as a-z, once per block.
    """
    if not 0 < share <= 1:
        raise ValueError("share: over 0, up to 1")
    texts = keyed(docs).select("ord", "rid", "text")
    table = stage(_ranked_notices(texts, notices, share), "notices")
    prefixes = table.select("notice", "size", "need", "width", F.posexplode(F.slice("tokens", F.lit(1), F.col("size") - F.col("need") + 1)).alias("place", "token"))
    # the words that any match must have one of: a few per notice, and the notices are the caller's; they travel in the plan
    heads: dict[int, list[str]] = {}
    for row in prefixes.select("width", "token").distinct().orderBy("width", "token").toLocalIterator():
        heads.setdefault(row.width, []).append(row.token)
    if not heads:
        heads = {WIDTH: [""]}
    words = texts.select("ord", "rid", _words(F.col("text")).alias("w"))
    sets = words.select("ord", "rid", F.explode(_blocks(heads)).alias("x")).select("ord", "rid", "x.*")
    ranked = table.select(F.explode(F.arrays_zip("ranks", "tokens")).alias("x")).select(F.col("x.tokens").alias("token"), F.col("x.ranks").alias("rank")).distinct()
    key = ["ord", "rid", "width", "block"]
    tokens = sets.select(*key, F.size("set").alias("words"), F.explode("set").alias("token")).join(ranked, "token")
    blocks = tokens.groupBy(*key).agg(F.max("words").alias("words"), F.sort_array(F.collect_set(F.struct("rank", "token"))).alias("known"))
    found = blocks.select("*", F.posexplode("known").alias("at", "x")).withColumn("token", F.col("x.token"))
    pairs = found.join(prefixes, ["token", "width"]).where(F.col("words") >= F.col("need"))
    pairs = pairs.where(F.least(F.col("size") - F.col("place"), F.size("known") - F.col("at")) >= F.col("need"))
    pairs = pairs.groupBy(*key, "notice").agg(F.first(F.col("known.rank")).alias("own"))
    shared = F.size(F.array_intersect("own", "ranks"))
    full = pairs.join(table.select("notice", "label", "size", "need", "ranks", "names"), "notice").withColumn("shared", shared)
    full = full.where((F.col("shared") >= F.col("need")) & (F.size(F.array_except("names", "own")) == 0))
    return full.select(*key, "notice", "label", "ranks", (F.col("shared") / F.col("size")).alias("containment"))


def best_matches(found: DataFrame) -> DataFrame:
    """Of matches in a block of which one notice is a part of the other, those that the block holds more completely;
    the longer ones, if equally."""
    blocks = found.groupBy("ord", "rid", "width", "block").agg(F.collect_list(F.struct("label", "ranks", "containment")).alias("all"))
    kept = F.expr(
        """filter(all, x -> not exists(all, y ->
             (size(y.ranks) > size(x.ranks) and size(array_except(x.ranks, y.ranks)) = 0 and y.containment >= x.containment)
             or (size(y.ranks) < size(x.ranks) and size(array_except(y.ranks, x.ranks)) = 0 and y.containment > x.containment)))"""
    )
    return blocks.select("ord", "rid", F.explode(kept).alias("x")).select("ord", "rid", "x.label", "x.containment")


def _places(words: str, phrase: str) -> str:
    parts = phrase.split()
    same = " and ".join(f"{words}[i + {n}] = '{part}'" for n, part in enumerate(parts))
    return f"filter(if(size({words}) >= {len(parts)}, sequence(0, size({words}) - {len(parts)}), array()), i -> {same})"


def phrase_places(docs: DataFrame, phrases: dict[str, str]) -> DataFrame:
    """ord, rid, doc_id, n_words and places: (word, label) of every occurrence of a phrase, counting words from 0."""
    rows = keyed(docs)
    last = "|".join(sorted({phrase.split()[-1] for phrase in phrases}))
    holds = F.col("text").rlike(f"(?i:{last})")
    words = F.when(holds, F.regexp_extract_all(lowered("text"), F.lit(WORD), F.lit(0)))
    named = [F.expr(f"transform({_places('w', p)}, i -> named_struct('word', cast(i as bigint), 'label', '{label}'))") for p, label in phrases.items()]
    base = rows.select("ord", "rid", "doc_id", F.regexp_count("text", F.lit(WORD)).cast("long").alias("n_words"), words.alias("w"))
    empty = F.array().cast("array<struct<word:bigint,label:string>>")
    return base.withColumn("places", F.when(F.col("w").isNull(), empty).otherwise(F.array_sort(F.concat(*named)))).drop("w")


def scan(docs: DataFrame, notices: DataFrame, phrases: dict[str, str] = PHRASES, share: float = SHARE) -> DataFrame:
    """One row per row of `docs` (doc_id, text): doc_id, n_words, places, base_labels, labels, score.

    places are the phrases found, as (word, label); base_labels their distinct labels, sorted. labels adds those of the
    notices that a block of the text holds to at least `share`, naming words included. score is 1 where a phrase was found, else the greatest
    containment of a notice, else 0. Null and empty texts have no words. Rows that repeat each get a row, and null
    doc_ids stay null. Other columns are ignored; an empty table gives an empty result.
    """
    matches = best_matches(matching_blocks(docs, notices, share))
    by_row = matches.groupBy("ord", "rid").agg(F.collect_set("label").alias("more"), F.max("containment").alias("most"))
    rows = phrase_places(docs, phrases).join(by_row, ["ord", "rid"], "left")
    base = F.array_sort(F.array_distinct(F.col("places.label")))
    none = F.array().cast("array<string>")
    return rows.select(
        "doc_id",
        "n_words",
        "places",
        base.alias("base_labels"),
        F.array_sort(F.array_union(base, F.coalesce("more", none))).alias("labels"),
        F.when(F.size("places") > 0, F.lit(1.0)).otherwise(F.coalesce("most", F.lit(0.0))).alias("score"),
    )
