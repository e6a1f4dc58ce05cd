import math

import pytest
from pyspark.sql import functions as F

from tidewater.llm import licenses as L
from tidewater.sources import table


@pytest.fixture(scope="module")
def scanner(spark):
    return L.train(table(spark, "/root/testdata/sf0.001", "documents"))


TEXTS = [(1, "plain text\nReleased under the MIT License.\nmore"), (2, "THIS WORK IS LICENSED UNDER THE GNU GENERAL PUBLIC LICENSE, VERSION 3."),
         (3, None), (4, ""), (5, " \n\t\n"), (6, "the license of this and that"), (7, "Licensed under CC BY-NC 4.0.\nLicensed under CC BY-NC 4.0.\n"
          "Released under the MIT License."), (8, "Licensed under the Apache License, Version 2.0."), (None, "Released under the MIT License."),
         (9, "word " * 100_000 + "\nReleased under the MIT License."), (1, "nothing"), (10, "This program is free software: you can redistribute it "
          "and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation")]


def test_families(docs_of, scanner):
    docs = docs_of(TEXTS).withColumn("row", F.lit(1)).withColumn("line", F.lit(2)).withColumn("family", F.lit("x"))
    rows = L.license_report(docs, scanner).collect()
    got = {(r.doc_id, r.n_paragraphs): (r.n_license, tuple(r.families), r.license) for r in rows}
    assert len(rows) == len(TEXTS)
    assert got[1, 3] == (1, ("mit",), "mit") and got[1, 1] == (1, ("mit",), "mit")
    assert got[2, 1] == (1, ("gpl",), "gpl") and got[7, 3] == (3, ("cc-by-nc", "mit"), "cc-by-nc")
    assert got[8, 1][2] == "apache" and got[9, 2][2] == "mit"
    for key in ((3, 0), (4, 0), (5, 0), (6, 1), (None, 1)):
        assert got[key] == (0, (), "unknown")


def test_notices_of_a_corpus_are_all_found_and_nothing_else(spark, scanner):
    docs = table(spark, "/root/testdata/sf0.01", "documents")  # mostly documents training has not seen
    found = L.scan(docs, scanner)
    lines = L.paragraphs(docs, "doc_id", "text").where(F.col("paragraph").rlike("(?i)licen[cs]e"))
    assert found.count() == lines.count() > 20
    assert found.join(lines, ["doc", "line"]).count() == lines.count()


def test_probabilities_equal_a_recomputation(spark, scanner):
    grams = ["released", "under", "released under", "unheard of"]
    df = spark.createDataFrame([(1, grams), (2, ["nothing"])], "k long, grams array<string>")
    rows = {r.k: r.p for r in L.probabilities(df, scanner, ["k"]).collect()}
    for k, gs in ((1, grams), (2, ["nothing"])):
        s = [b + sum(scanner.weights.get(g, [0] * len(scanner.biases))[i] for g in gs) for i, b in enumerate(scanner.biases)]
        total = sum(math.exp(x) for x in s)
        assert rows[k] == pytest.approx([math.exp(x) / total for x in s])


def test_telling_words_are_in_whatever_confirms():
    t = "a bb ccc dddd eeeee ffffff".split()
    words = L.telling_words([t], 0.75)
    assert words == sorted(["ffffff", "eeeee"])  # five of six words cannot avoid both


def test_empty_corpus(spark, docs_of):
    scanner = L.train(docs_of([]))
    assert L.license_report(docs_of([]), scanner).collect() == []
    assert L.license_report(docs_of(TEXTS[:1]), scanner).first().license == "mit"


def test_no_python_on_the_main_path(docs_of, scanner):
    plan = L.license_report(docs_of(TEXTS), scanner)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


MIT = """Copyright (c) 2020 Some Body

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software."""
BSD = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution."""
MPL = """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at https://mozilla.org/MPL/2.0/."""


@pytest.mark.parametrize("family, text", [("mit", MIT), ("bsd", BSD), ("mpl", MPL)])
def test_wrapped_texts(docs_of, scanner, family, text):
    code = "\nint main(void)\n{\n  return 0;\n}"
    long = "one word after another goes on\n" * 500
    forms = [text, "\n".join(f" * {x}" for x in text.split("\n")) + code, "\n".join(f"// {x}".strip() for x in text.split("\n")) + code,
             long + text + "\n" + long, "word " * 10_000 + text.replace("\n", "\n# ") + " word" * 10_000]
    rows = L.license_report(docs_of(list(enumerate(forms))), scanner).collect()
    assert [(r.doc_id, r.families, r.license) for r in sorted(rows)] == [(i, [family], family) for i in range(len(forms))]
    assert all(r.n_license >= 1 for r in rows)


def test_two_wrapped_licences_and_words_far_apart(docs_of, scanner):
    words = MPL.replace("\n", " ").split()
    apart = "\n".join(w + " and so it goes on" * 10 for w in words)
    rows = sorted(L.license_report(docs_of([(1, MIT + "\n\n" + MPL), (2, apart), (3, "\n\n".join(words))]), scanner).collect())
    assert [(r.families, r.license) for r in rows] == [(["mit", "mpl"], "mit"), ([], "unknown"), ([], "unknown")]


def test_training_learns_from_every_row(spark, docs_of, scanner):
    """Look-alikes in rows outside the 2,000 of 4,000 that a sample by id hash once took."""
    share = F.pmod(F.xxhash64("id"), F.lit(1 << 30)) / float(1 << 30)
    ids = {r.id for r in spark.range(4000).where(share * 4000 >= 2000).limit(40).collect()}
    like = "released under the mit bridge"
    grams = spark.createDataFrame([(1, like)], "k long, t string").select("k", L.grams_of(L.words_of(F.col("t"))).alias("grams"))
    taught = L.train(docs_of([(i, like if i in ids else "nothing to be seen here") for i in range(4000)]))
    mit = scanner.families.index("mit")
    plain, odds = (L.probabilities(grams, s, ["k"]).first().p[mit] for s in (scanner, taught))
    assert odds < plain / 2


def test_words_are_extracted_once(docs_of):
    plan = L.ordinary(docs_of(TEXTS), "doc_id", "text")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all(") == 1


def test_known_grams_equal_the_plain_ones(spark):
    features = ["a", "a b", "b", "c", "c a", "é"]
    words = [[], ["a"], ["b", "a"], ["a", "b", "x", "a", "b"], ["c", "x", "a"], ["a", "c", "a", "c"], ["É", "é", "A"], ["b", "c", "a", "b"]]
    lines = spark.createDataFrame([(w,) for w in words], "words array<string>").coalesce(1)
    plain = [sorted({*w, *map(" ".join, zip(w, w[1:]))} & set(features)) for w in words]
    assert [r.grams for r in L.known_grams(lines, features).collect()] == plain


def test_ordinary_paragraphs_and_their_words(docs_of):
    docs = docs_of([(1, "One two  THREE\nfour five\n \nthe licence of it\na copyright b\na copyrights b\nno permission given\nper redistribution3 b"),
                    (None, "ÀB cc-d 4.0"), (2, None), (3, "un-licensed or not\npre.redistribution is it\nx redistribution-free y")])
    rows = sorted(r.words for r in L.ordinary(docs, "doc_id", "text").collect())
    assert rows == [["a", "copyrights", "b"], ["one", "two", "three"], ["pre.redistribution", "is", "it"], ["Àb", "cc-d", "4.0"]]
