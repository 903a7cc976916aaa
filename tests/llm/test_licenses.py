import random

from test_decontaminate import check_sql, words_of

from regiobank.llm import licenses
from regiobank.llm.queries import op8_license_scan


def test_query_equals_sql(spark, folder):
    check_sql(spark, folder, "op8_license_scan", op8_license_scan)
    found = op8_license_scan(spark, folder)
    assert found.where("labels like '%cc-by-nc%'").count() > 0
    assert found.where("labels rlike 'cc-by(,|$)'").count() == 0  # the more specific notice wins
    plan = found._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_join_equals_brute_force(spark):
    rng = random.Random(2)
    vocabulary = [f"t{n}" for n in range(14)]
    notices = [(f"n{n}", " ".join(rng.choices(vocabulary, k=rng.randint(1, 19))), rng.choice(["", "t1", "t2 t3 q"])) for n in range(25)]
    docs = [(n, "\n".join(" ".join(rng.choices(vocabulary + ["zz", "yy"] * 3, k=rng.randint(0, 14))) for _ in range(4))) for n in range(80)]
    for share in (0.5, 0.8, 1.0):
        got = licenses.matching_blocks(
            spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(notices, "label string, text string, naming string"), share
        )
        rows = got.select("ord", "width", "block", "label", "containment").collect()
        wanted = set()
        for doc_id, text in docs:
            words = words_of(text)
            for label, notice, naming in notices:
                want, width = words_of(notice), 8
                while width < len(want):
                    width *= 2
                for block in range(-(-len(words) // width)):
                    held = set(words[block * width : block * width + 2 * width])
                    part = len(set(want) & held) / len(set(want))
                    if part >= share - 1e-9 and set(words_of(naming)) & set(want) <= held:
                        wanted.add((doc_id, width, block, label, part))
        assert {tuple(r) for r in rows} == wanted and len(rows) == len(wanted)


CANONICAL = {
    "apache": "Licensed under the Apache License, Version 2.0 (the \"License\");\nyou may not use this file except in compliance with the License.\nYou may obtain a copy of the License at",
    "mit": "Permission is hereby granted, free of charge, to any person obtaining a copy\nof this software and associated documentation files (the \"Software\"), to deal",
    "gpl": "This program is free software: you can redistribute it and/or modify\nit under the terms of the GNU General Public License as published by\nthe Free Software Foundation",
    "lgpl": "This library is free software; you can redistribute it and/or\nmodify it under the terms of the GNU Lesser General Public\nLicense as published by the Free Software Foundation",
    "agpl": "This program is free software: you can redistribute it and/or modify\nit under the terms of the GNU Affero General Public License as\npublished by the Free Software Foundation",
    "bsd": "Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that the following conditions are met:",
    "mpl": "This Source Code Form is subject to the terms of the Mozilla Public\nLicense, v. 2.0. If a copy of the MPL was not distributed with this file",
    "cc0": "has waived all copyright and related or neighboring\nrights to this work",
    "unlicense": "This is free and unencumbered software released into\nthe public domain.",
    "cc-by-nc-sa": "Licensed under\nCC BY-NC-SA 4.0",
    "cc-by": "Licensed under CC BY 4.0",
}


def test_canonical_notices_give_their_own_label(spark):
    """Wrapped as they usually are, as comments, on one line, and anywhere in a text."""
    rows, wanted = [], []
    for label, text in CANONICAL.items():
        for before in (0, 1, 5, 11, 30):
            for form in (text, text.replace("\n", " "), "# " + text.replace("\n", "\n# "), " * " + text.replace("\n", "\n * ")):
                rows.append((len(rows), "filler " * before + form + " and so on" * 9))
                wanted.append(label)
    for line, label in (
        ("Licensed under the Apache License, Version 2.0", "apache"),
        ("This work is licensed under the GNU General Public License, version 3", "gpl"),
        ("Released under the MIT License", "mit"),
        ("Licensed under the BSD License", None),
        ("Released under the license of the house", None),
    ):
        rows.append((len(rows), line))
        wanted.append(label)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in licenses.scan(docs, licenses.notice_table(spark)).collect()}
    for number, label in enumerate(wanted):
        more = set(got[number].labels) - set(got[number].base_labels)
        assert set(got[number].labels) - {"gpl"} == {label} - {None, "gpl"} and (label is None or label in got[number].labels), rows[number]
        assert not more - {label}


def test_license_lines_of_the_table(spark, folder):
    """Lines that give one license get its label alone."""
    found = op8_license_scan(spark, folder).where("base_labels != ''")
    assert found.where("labels != base_labels AND base_labels NOT LIKE '%gpl%'").count() == 0


def test_edges(spark, table):
    notices = licenses.notice_table(spark)
    text = "The MIT-License; apache\nLICENSE x general  public license.\nReleased under the MIT License."
    rows = [(1, None), (2, ""), (3, text), (3, text), (None, "Licensed under CC BY-NC 4.0."), (4, "word " * 60000 + "\nmit license")]
    got = {r.doc_id: r for r in licenses.scan(table(rows), notices).collect()}
    assert licenses.scan(table(rows), notices).count() == 6
    assert (got[1].n_words, got[2].labels, got[2].score) == (0, [], 0.0)
    assert [tuple(p) for p in got[3].places] == [(1, "mit"), (3, "apache"), (6, "gpl"), (12, "mit")]
    assert got[3].base_labels == ["apache", "gpl", "mit"] and got[3].score == 1.0
    assert got[None].labels == ["cc-by-nc"] and got[None].base_labels == [] and got[None].score == 1.0
    assert [tuple(p) for p in got[4].places] == [(60000, "mit")]
    assert licenses.scan(table([]), notices).collect() == []
    none = spark.createDataFrame([], "label string, text string")
    assert {r.score for r in licenses.scan(table(rows), none).collect()} == {0.0, 1.0}
