"""License scans: a trained paragraph classifier over sparse word n-grams.

A paragraph is a line of a text, or a wrapped one: consecutive lines with words that
together hold what no line holds alone. Its features are the 1- and 2-grams of its
lower-cased words, each counted once. A sparse (elastic-net) multinomial logistic
regression tells the licence families and the unknown class apart. Training data: passages of
the families' templates, varied by cutting, against all ordinary paragraphs of the corpus; of
these only the template features are kept, and equal ones are fitted once with their number as weight. The unknown class is
calibrated on all of them, each scored by a model that was fitted without it: a family is predicted only where its
probability lies above all but a wanted share of theirs. A prediction counts if the template confirms it: enough of
a template's words must be in the paragraph.

Scoring joins a paragraph's features with the table of weights, whose size is that of the
templates, and adds up. A confirmed paragraph holds at least one of the few longest words
of its template, so most paragraphs are settled by a look for these words.

Built-in functions and Spark's own MLlib only.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import CountVectorizerModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .tables import SPACES, ascii_lower, stored

#: A short notice and the opening words of each licence family.
TEMPLATES = {
    "apache": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is "
        "distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."),
    "bsd": (
        "Released under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the "
        "following disclaimer."),
    "cc-by": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    "cc-by-nc": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    "cc-by-sa": (
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    "gpl": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version.",
        "You should have received a copy of the GNU General Public License along with this program."),
    "mit": (
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files (the \"Software\"), to deal in the Software without restriction",
        "The above copyright notice and this permission notice shall be included in all copies or substantial "
        "portions of the Software."),
    "mpl": (
        "Released under the Mozilla Public License 2.0.",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL "
        "was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
}
UNKNOWN = "unknown"
#: Weight of all ordinary paragraphs in the regression, as a multiple of that of all passages of templates.
ORDINARY_WEIGHT = 10.0
#: Share of ordinary paragraphs that may lie above a family's threshold.
FALSE_ALARMS = 0.001
#: Share of a template's words that a paragraph must contain to be confirmed.
CONFIRM = 0.75


@dataclass
class Scanner:
    """What training leaves. Classes are the families, by name, and last the unknown class."""

    families: list[str]
    #: Weights per class of each feature that has any.
    weights: dict[str, list[float]]
    biases: list[float]
    #: Least probability of each family.
    thresholds: list[float]


def words_of(text: Column) -> Column:
    """Lower-cased words: runs of letters and digits, with the dots, plus and minus signs inside them."""
    return F.regexp_extract_all(ascii_lower(text), F.lit(r"[\p{L}\p{N}]+(?:[.+-][\p{L}\p{N}]+)*"), F.lit(0))


def grams_of(words: Column) -> Column:
    """The distinct 1- and 2-grams of an array of words."""
    pairs = F.zip_with(words, F.slice(words, 2, F.greatest(F.size(words) - 1, F.lit(0))),
                       lambda a, b: F.concat_ws(" ", a, F.coalesce(b, F.lit(""))))
    whole = F.slice(pairs, 1, F.greatest(F.size(words) - 1, F.lit(0)))
    return F.array_distinct(F.concat(words, whole))


def paragraphs(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc, line, paragraph) of every line that holds more than white space."""
    lines = docs.select(F.col(id_col).alias("doc"), F.posexplode(
        F.split(F.coalesce(F.col(text_col), F.lit("")), "\n", -1)).alias("line", "paragraph"))
    return lines.where(F.btrim("paragraph", F.lit(SPACES)) != "")


def template_rows(spark: SparkSession) -> DataFrame:
    """(family, number, text, words) of every template; the notice has number 0."""
    rows = [(f, i, t) for f, texts in TEMPLATES.items() for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "family string, number int, text string").withColumn("words", words_of(F.col("text")))


def passages(spark: SparkSession) -> DataFrame:
    """(family, words): every template, and its passages cut at both ends by up to a quarter of it."""
    whole = template_rows(spark)
    cuts = F.expr("sequence(0, size(words) div 4, greatest(size(words) div 16, 1))")
    cut = whole.withColumn("head", F.explode(cuts)).withColumn("tail", F.explode(cuts))
    left = F.size("words") - F.col("head") - F.col("tail")
    return cut.where(left >= 3).select("family", F.slice("words", F.col("head") + 1, left).alias("words"))


def ordinary(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(words): the paragraphs of all rows that have at least three words.

    Paragraphs that name a licence are left out of it: they are what is looked for.
    """
    # Exploded, so that the filters below and later steps take the words as they are instead of extracting them again.
    lines = paragraphs(docs, id_col, text_col).select(F.explode(F.array(words_of(F.col("paragraph")))).alias("words"))
    named = F.exists("words", lambda w: w.rlike("licen[cs]|^copyright$|^redistribution|^permission$"))
    return lines.where((F.size("words") >= 3) & ~named)


def known_grams(lines: DataFrame, features: list[str]) -> DataFrame:
    """(grams): of each row of ``words`` those of its distinct 1- and 2-grams that are in ``features``, sorted.

    ``features`` hold both words of each 2-gram, so pairs are made only of words that are features themselves.
    """
    single = [f for f in features if " " not in f]
    kept = lines.select(F.transform("words", lambda w: F.when(w.isin(single), w)).alias("kept"))
    pairs = F.zip_with("kept", F.slice("kept", 2, F.size("kept")), lambda a, b: F.concat(a, F.lit(" "), b))
    found = F.filter(F.concat("kept", pairs), lambda g: g.isin(features))
    return kept.select(F.array_sort(F.array_distinct(found)).alias("grams"))


def _fit(examples: DataFrame, passages: int) -> LogisticRegressionModel:
    """The regression on rows (ordinary, n, label, features); ``n`` paragraphs of the corpus count ``ORDINARY_WEIGHT`` in all."""
    total = examples.where("ordinary").agg(F.sum("n")).scalar()
    weight = F.when(F.col("ordinary"), F.col("n") * (ORDINARY_WEIGHT * passages) / total).otherwise(1.0)
    return LogisticRegression(family="multinomial", regParam=0.001, elasticNetParam=0.5, maxIter=25, weightCol="weight").fit(
        examples.withColumn("weight", weight))


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", false_alarms: float = FALSE_ALARMS) -> Scanner:
    """Fit the regression and calibrate the families' thresholds, both on all ordinary paragraphs of ``docs``.

    Ordinary paragraphs without any template feature say nothing about weights and are not
    fitted, but count in the calibration. Paragraphs of equal features are in one half, and each half is scored by a
    model of the other one. An empty corpus trains on templates alone.
    """
    spark = docs.sparkSession
    families = sorted(TEMPLATES)
    unknown = float(len(families))
    # The templates' passages are few: one partition, so that an iteration has hardly more tasks than the corpus needs.
    known = stored(passages(spark).withColumn("grams", grams_of(F.col("words"))).coalesce(1), "passages")
    features = sorted(r["g"] for r in known.select(F.explode("grams").alias("g")).distinct().collect())
    vectors = CountVectorizerModel.from_vocabulary(features, inputCol="grams", outputCol="features", minTF=1.0, binary=True)
    other = stored(known_grams(ordinary(docs, id_col, text_col), features), "ordinary").withColumn(
        "half", F.pmod(F.xxhash64("grams"), F.lit(2)))
    near = other.where(F.size("grams") > 0).groupBy("half", "grams").agg(F.count(F.lit(1)).alias("n"))
    number = F.array_position(F.array(*map(F.lit, families)), F.col("family")) - 1
    one, none = F.lit(1).cast("long").alias("n"), F.lit(-1).cast("long").alias("half")
    examples = near.select("half", F.lit(True).alias("ordinary"), "n", F.lit(unknown).alias("label"), "grams").union(
        known.select(none, F.lit(False), one, number.cast("double"), "grams")).union(
        known.limit(1).select(none, F.lit(False), one, F.lit(unknown), F.array(F.lit(""))))
    examples = vectors.transform(stored(examples, "examples"))
    templates = known.count()
    scored = [_fit(examples.where(F.col("half") != h), templates).transform(vectors.transform(other.where(F.col("half") == h)))
              .select(vector_to_array("probability").alias("p")) for h in (0, 1)]
    tops = scored[0].union(scored[1]).agg(*[
        F.percentile_approx(F.get("p", F.lit(i)), 1 - false_alarms, 100_000) for i in range(len(families))]).first()
    fitted = _fit(examples, templates)
    matrix = fitted.coefficientMatrix.toArray()
    weights = {f: [float(x) for x in matrix[:, i]] for i, f in enumerate(features) if abs(matrix[:, i]).max() > 1e-6}
    # Above the wanted share of ordinary paragraphs, and never below even odds.
    thresholds = [max(0.5, t if t is not None else 0.0) for t in tops]
    return Scanner(families, weights, [float(x) for x in fitted.interceptVector], thresholds)


def probabilities(lines: DataFrame, scanner: Scanner, keys: list[str]) -> DataFrame:
    """(keys, p): the probabilities of the classes for rows with ``grams``.

    The weights are a table of one row per template feature, small by construction.
    """
    classes = range(len(scanner.biases))
    rows = [("", *([0.0] * len(classes))), *((f, *ws) for f, ws in scanner.weights.items())]
    table = lines.sparkSession.createDataFrame(rows, "gram string, " + ", ".join(f"w{i} double" for i in classes))
    scores = (lines.select(*keys, F.explode("grams").alias("gram")).join(F.broadcast(table), "gram", "left")
                   .groupBy(*keys).agg(F.array(*[F.sum(F.coalesce(f"w{i}", F.lit(0.0))) + scanner.biases[i]
                                                 for i in classes]).alias("s")))
    return scores.select(*keys, F.transform("s", lambda x: 1 / F.aggregate(
        "s", F.lit(0.0), lambda total, y: total + F.exp(y - x))).alias("p"))


def telling_words(templates: list[list[str]], confirm: float) -> list[str]:
    """Words of which every paragraph that confirms a template has at least one: enough of its longest."""
    out = set()
    for t in templates:
        distinct = sorted(set(t), key=lambda w: (-len(w), w))
        out.update(distinct[:len(distinct) - math.ceil(confirm * len(distinct) - 1e-9) + 1])
    return sorted(out)


def scan(docs: DataFrame, scanner: Scanner, id_col: str = "doc_id", text_col: str = "text",
         confirm: float = CONFIRM) -> DataFrame:
    """Per paragraph that is predicted a licence: (doc, line, paragraph, family, probability, agreement).

    ``line`` is the first line of a wrapped paragraph.
    Of several families above their thresholds the most probable one is
    predicted (of equal ones the first by name); it stays if the templates confirm it.
    """
    spark = docs.sparkSession
    templates: dict[str, list[list[str]]] = {}
    for r in template_rows(spark).orderBy("family", "number").collect():
        templates.setdefault(r["family"], []).append(r["words"])
    texts = [t for ts in templates.values() for t in ts]
    telling = F.array(*map(F.lit, telling_words(texts, confirm)))
    lines = F.split(F.coalesce(F.col(text_col), F.lit("")), "\n", -1)
    rows = docs.where(F.arrays_overlap(words_of(F.col(text_col)), telling)).select(F.col(id_col).alias("doc"), lines.alias("lines"))
    rows = stored(rows.withColumn("words", F.transform("lines", words_of))
                      .withColumn("row", F.monotonically_increasing_id()), "rows")
    single = (rows.select("row", "lines", F.posexplode("words").alias("line", "words"))
                  .where(F.arrays_overlap("words", telling))
                  .select("row", F.col("line").alias("first"), F.col("line").alias("last"), F.lit(0).alias("between"),
                          "words", F.get("lines", F.col("line")).alias("paragraph")))
    spans = stored(single.unionByName(wrapped(rows, texts, telling, confirm)), "paragraphs")
    found = whole_findings(stored(confirmed(spans, scanner, confirm), "findings"))
    return found.join(rows.select("row", "doc"), "row").select("doc", "line", "paragraph", "family", "probability", "agreement")


def wrapped(rows: DataFrame, texts: list[list[str]], telling: Column, confirm: float) -> DataFrame:
    """(row, first, last, between, words, paragraph): spans of two and more consecutive lines that hold enough of a template.

    A template that begins in the first line of a span and ends in its last one holds all words
    ``between`` them, so these are at most its own number and what ``confirm`` leaves for others. Of the
    first line the last words count and of the last line the first ones, as many as
    the longest template has. Comment leaders are no words, and a line without words ends a paragraph.
    """
    longest = max(map(len, texts))
    most = math.floor(longest / confirm)
    sized = rows.select("row", "lines", "words", F.transform("words", F.size).alias("sizes"),
                        F.transform("words", lambda w: F.arrays_overlap(w, telling)).alias("tells"))
    at = sized.select("*", F.posexplode("sizes").alias("first", "size")).where("size > 0")
    # Lines after the first one that a span may take: all have words, those before the last at most ``most``.
    reach = F.aggregate(
        F.slice("sizes", F.col("first") + 2, most + 1),
        F.struct(F.lit(0).alias("n"), F.lit(0).alias("words"), F.lit(False).alias("end")),
        lambda a, n: F.when(a["end"] | (n == 0) | (a["words"] > most), F.struct(
            a["n"].alias("n"), a["words"].alias("words"), F.lit(True).alias("end"))).otherwise(F.struct(
                (a["n"] + 1).alias("n"), (a["words"] + n).alias("words"), F.lit(False).alias("end"))))
    at = at.withColumn("reach", reach["n"]).where("reach > 0")
    at = at.where(F.array_contains(F.slice("tells", F.col("first") + 1, F.col("reach") + 1), True))
    at = at.select("row", "first", F.slice("lines", F.col("first") + 1, F.col("reach") + 1).alias("lines"),
                   F.slice("words", F.col("first") + 1, F.col("reach") + 1).alias("words"),
                   F.explode(F.sequence(F.lit(1), "reach")).alias("n"))
    head, tail = F.get("words", F.lit(0)), F.get("words", F.col("n"))
    inner = F.flatten(F.slice("words", 2, F.col("n") - 1))
    spans = at.select(
        "row", "first", (F.col("first") + F.col("n")).alias("last"), F.size(inner).alias("between"),
        F.concat(F.slice(head, F.greatest(F.size(head) - longest, F.lit(0)) + 1, longest), inner,
                 F.slice(tail, 1, longest)).alias("words"),
        F.array_join(F.slice("lines", 1, F.col("n") + 1), "\n").alias("paragraph"))
    holds = F.lit(False)
    for t in texts:
        distinct = list(dict.fromkeys(t))
        share = F.size(F.array_intersect(F.array(*map(F.lit, distinct)), "words")) / F.lit(len(distinct))
        holds = holds | ((F.col("between") <= len(t) / confirm) & (share >= confirm))
    return spans.where(F.arrays_overlap("words", telling)).where(holds)


def confirmed(spans: DataFrame, scanner: Scanner, confirm: float) -> DataFrame:
    """(row, first, last, paragraph, family, probability, agreement) of the spans that are predicted and confirmed."""
    keys = ["row", "first", "last"]
    odds = probabilities(spans.select(*keys, grams_of(F.col("words")).alias("grams")), scanner, keys)
    limits = F.array(*map(F.lit, [*scanner.thresholds, 2.0]))  # the unknown class is never predicted
    above = F.filter(F.transform("p", lambda x, i: F.struct(x.alias("probability"), (-i).alias("order"))),
                     lambda x: x["probability"] >= F.get(limits, -x["order"]))
    best = spans.join(odds.select(*keys, F.array_max(above).alias("best")), keys).where(F.col("best").isNotNull())
    names = F.array(*map(F.lit, scanner.families))
    best = best.withColumn("family", F.get(names, -F.col("best.order")))
    texts = template_rows(spans.sparkSession).select(
        "family", F.size("words").alias("size"), F.array_distinct("words").alias("template"))
    share = F.size(F.array_intersect("template", "words")) / F.size("template")
    return (best.join(F.broadcast(texts), "family").where(F.col("between") <= F.col("size") / confirm)
                .groupBy(*keys, "paragraph", "family", F.col("best.probability").alias("probability"))
                .agg(F.max(share).alias("agreement")).where(F.col("agreement") >= confirm))


def whole_findings(spans: DataFrame) -> DataFrame:
    """(row, line, paragraph, family, probability, agreement): spans that overlap settled to one finding.

    A line that is found alone stands for itself. Of spans of different families the one of best
    agreement, then probability, has a line; a span that has not all of its lines goes. Spans
    of one family that overlap are one finding, told by the best of them.
    """
    spans = spans.withColumn("alone", F.col("first") == F.col("last"))
    lines = spans.withColumn("line", F.explode(F.sequence("first", "last")))
    best = lines.groupBy("row", "line").agg(
        F.max(F.struct("alone", "agreement", "probability", "family")).alias("top"))
    own = (F.col("top.alone") == F.col("alone")) & (F.col("top.family") == F.col("family"))
    stays = (lines.join(best, ["row", "line"]).groupBy("row", "first", "last").agg(F.every(own).alias("own"))
                  .where("own").drop("own"))
    order = Window.partitionBy("row", "family", "alone").orderBy("first", "last")
    before = F.max("last").over(order.rowsBetween(Window.unboundedPreceding, -1))
    runs = spans.join(stays, ["row", "first", "last"]).withColumn(
        "new", (F.coalesce(before, F.lit(-1)) < F.col("first")).cast("long"))
    runs = runs.withColumn("run", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    told = F.max(F.struct("agreement", "probability", "paragraph"))
    return runs.groupBy("row", "family", "alone", "run").agg(F.min("first").alias("line"), told.alias("told")).select(
        "row", "line", "told.paragraph", "family", "told.probability", "told.agreement")


def license_report(docs: DataFrame, scanner: Scanner, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: (doc_id, n_paragraphs, n_license, families sorted, license).

    ``n_paragraphs`` counts lines; a wrapped paragraph counts once in ``n_license``.
    ``license`` is the family of most paragraphs (ties: the first by name), ``unknown`` if
    none was found. Null and empty texts have no paragraphs. Rows that repeat
    a doc_id share their findings; a null id gets none.
    """
    found = (scan(docs, scanner, id_col, text_col).where(F.col("doc").isNotNull())
             .groupBy("doc", "family").agg(F.count_distinct("line").alias("n")))
    by_doc = found.groupBy(F.col("doc").alias("_doc")).agg(
        F.sum("n").alias("n_license"), F.sort_array(F.collect_list("family")).alias("families"),
        F.sort_array(F.collect_list(F.struct((-F.col("n")).alias("n"), "family"))).alias("ranked"))
    size = F.size(F.filter(F.split(F.coalesce(F.col(text_col), F.lit("")), "\n", -1),
                           lambda p: F.btrim(p, F.lit(SPACES)) != ""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), size.cast("long").alias("n_paragraphs"))
    out = rows.join(by_doc, rows["doc_id"] == by_doc["_doc"], "left")
    return out.select(
        "doc_id", "n_paragraphs", F.coalesce("n_license", F.lit(0)).alias("n_license"),
        F.coalesce("families", F.array().cast("array<string>")).alias("families"),
        F.coalesce(F.get("ranked", F.lit(0))["family"], F.lit(UNKNOWN)).alias("license"))
