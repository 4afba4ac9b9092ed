"""Licence scan by diagonal voting.

Every rolling word k-gram of a document (k = 3; 2 for a phrase of two words)
is joined by its hash to the k-grams of the templates, a fixed list that is
broadcast.  A hit at word p of the document and word q of the template votes
for the diagonal p - q.  Votes are counted for each (document, template,
diagonal), neighbouring diagonals (words put in or left out) are merged into
spans, and a span is a finding if it covers enough of the template's words.
Hits compare the words themselves besides their hashes, so the covered words
of a span are verified.

Base phrases are templates that must stand whole on one diagonal.

Defined cases: null text is empty; a document without words has no hits, empty
labels and score 0; overlapping places all count; rows equal in doc_id and
text are scanned once and returned as often as they occur; the size of a group
is bounded by one document's hits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Base phrases and their labels.
BASE = [("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved")]
# Notices of common licences and the paragraphs of the short ones, in words.
NOTICES = [
    ("mit", "released under the mit license"),
    ("mit", "licensed under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and "
            "associated documentation files"),
    ("apache", "licensed under the apache license version 2 0"),
    ("apache", "you may not use this file except in compliance with the license you may obtain a copy of the license"),
    ("gpl", "licensed under the gnu general public license version 3"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu "
            "general public license as published by the free software foundation"),
    ("lgpl", "gnu lesser general public license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided "
            "that the following conditions are met"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by", "licensed under a creative commons attribution 4 0 international license"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is "
            "hereby granted"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
    ("mit", "to deal in the software without restriction including without limitation the rights to use copy modify merge "
            "publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is "
            "furnished to do so subject to the following conditions"),
    ("mit", "the above copyright notice and this permission notice shall be included in all copies or substantial portions "
            "of the software"),
    ("mit", "in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in "
            "an action of contract tort or otherwise arising from out of or in connection with the software or the use or "
            "other dealings in the software"),
    ("bsd", "redistributions of source code must retain the above copyright notice this list of conditions and the following "
            "disclaimer"),
    ("bsd", "redistributions in binary form must reproduce the above copyright notice this list of conditions and the "
            "following disclaimer in the documentation and or other materials provided with the distribution"),
    ("bsd", "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
            "products derived from this software without specific prior written permission"),
    ("apache", "unless required by applicable law or agreed to in writing software distributed under the license is "
               "distributed on an as is basis without warranties or conditions of any kind either express or implied"),
    ("gpl", "this program is distributed in the hope that it will be useful but without any warranty without even the implied "
            "warranty of merchantability or fitness for a particular purpose"),
    ("gpl", "you should have received a copy of the gnu general public license along with this program"),
    ("zlib", "this software is provided as is without any express or implied warranty in no event will the authors be held "
             "liable for any damages arising from the use of this software"),
    ("cc0", "to the extent possible under law the author has waived all copyright and related or neighboring rights to this work"),
    ("reserved", "alle rechte vorbehalten"),
    ("reserved", "tous droits réservés"),
    ("reserved", "todos los derechos reservados"),
]

GRAM = 3
#: Diagonals this near are one span.
SLACK = 3
#: Hundredths of a template's words that a finding covers.
COVERED = 80

_SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_END = "-end-"


def words(text: Column) -> Column:
    """Words of a text, A-Z in lower case."""
    upper = "".join(map(chr, range(65, 91)))
    return F.array_remove(F.split(F.translate(F.coalesce(text, F.lit("")), upper, upper.lower()), _SEPARATORS, -1), "")


def template_grams(spark: SparkSession, base=BASE, notices=NOTICES) -> DataFrame:
    """One row for each k-gram of each template, and one that marks the end of a document."""
    rows = [(-1, "", False, 0, 0, 0, _END, _END, None)]
    templates = [(label, phrase, True) for phrase, label in base] + [(x, t, False) for x, t in notices]
    for number, (label, phrase, is_base) in enumerate(templates):
        ws = phrase.split()
        k = min(GRAM, len(ws))
        rows += [(number, label, is_base, len(ws), k, q, ws[q], ws[q + 1], ws[q + 2] if k > 2 else None)
                 for q in range(len(ws) - k + 1)]
    out = spark.createDataFrame(rows, "tid int, label string, base boolean, len int, k int, q int, w0 string, "
                                      "w1 string, w2 string")
    return out.withColumn("gram", F.xxhash64("w0", "w1"))


def _hits(spark: SparkSession, docs: DataFrame, grams: DataFrame) -> DataFrame:
    """All k-gram hits, and one row for the end of each document (tid -1)."""
    texts = docs.select("doc_id", F.xxhash64("text").alias("fp"), words(F.col("text")).alias("ws"))
    # The outer form, so that no filter on the array is pushed below and splits every text twice.
    places = texts.select("doc_id", "fp", "ws", F.explode_outer(F.sequence(F.lit(0), F.size("ws"))).alias("p"))
    n = F.size("ws")
    at = [F.when(F.col("p") == n, F.lit(_END)).otherwise(F.get("ws", F.col("p"))),
          F.when(F.col("p") == n, F.lit(_END)).otherwise(F.get("ws", F.col("p") + 1)),
          F.get("ws", F.col("p") + 2)]
    probe = places.select("doc_id", "fp", "p", n.alias("n"), at[0].alias("a0"), at[1].alias("a1"), at[2].alias("a2"),
                          F.xxhash64(at[0], at[1]).alias("h"))
    same = ((F.col("h") == F.col("gram")) & (F.col("a0") == F.col("w0")) & (F.col("a1") == F.col("w1"))
            & (F.col("w2").isNull() | (F.col("a2") == F.col("w2"))))
    return probe.join(F.broadcast(grams), same).select("doc_id", "fp", "n", "tid", "label", "base", "len", "k", "q", "p")


def scan(spark: SparkSession, docs: DataFrame, base=BASE, notices=NOTICES) -> DataFrame:
    """One row for each span: (doc_id, fp, n, rows, tid, label, base, first,
    last, covered, len); documents without a span have one row with tid -1.
    ``rows`` counts the rows that are equal to the document."""
    key = ["doc_id", "fp", "n"]
    template = ["tid", "label", "base", "len", "k"]
    diagonals = (_hits(spark, docs, template_grams(spark, base, notices))
                 .groupBy(*key, *template, (F.col("p") - F.col("q")).alias("diagonal"))
                 .agg(F.collect_set("q").alias("qs"), F.count(F.lit(1)).alias("hits")))
    diagonals = diagonals.where(~F.col("base") | (F.size("qs") == F.col("len") - F.col("k") + 1))
    # Every document has an end row, which all its other rows meet in one partition.
    along = Window.partitionBy(*key, "tid").orderBy("diagonal")
    far = F.col("base") | (F.col("diagonal") - F.lag("diagonal", 1, -1_000_000).over(along) > SLACK)
    spans = diagonals.withColumn("new", F.when(far, 1).otherwise(0)).withColumn("span", F.sum("new").over(along))
    seen = F.flatten(F.collect_list(F.flatten(F.transform("qs", lambda q: F.sequence(q, q + F.col("k") - 1)))))
    spans = spans.groupBy(*key, *template, "span").agg(
        F.max("hits").alias("rows"), F.size(F.array_distinct(seen)).alias("covered"),
        F.min(F.col("diagonal") + F.array_min("qs")).alias("first"),
        F.max(F.col("diagonal") + F.array_max("qs") + F.col("k") - 1).alias("last"))
    return spans


def findings(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """One row for each document: its words, base places, labels and score
    (the largest covered share of any template)."""
    spans = scan(spark, docs)
    is_base, is_end = F.col("base"), F.col("tid") == -1
    found = is_base | (~is_end & (100 * F.col("covered") >= COVERED * F.col("len")))

    def joined(condition):
        return F.array_join(F.array_sort(F.collect_set(F.when(condition, F.col("label")))), ",")

    share = F.when(is_end, F.lit(0.0)).otherwise(F.col("covered") / F.col("len"))
    out = spans.groupBy("doc_id", "fp", "n").agg(
        F.max(F.when(is_end, F.col("rows"))).alias("rows"),
        F.sum(F.when(is_base, 1).otherwise(0)).cast("long").alias("n_base"),
        F.min(F.when(is_base, F.col("first"))).cast("long").alias("first_word"),
        F.max(F.when(is_base, F.col("first"))).cast("long").alias("last_word"),
        joined(is_base).alias("base_labels"), joined(found).alias("labels"), F.max(share).alias("score"))
    again = F.explode(F.sequence(F.lit(1).cast("long"), F.col("rows")))
    return out.select("doc_id", F.col("n").cast("long").alias("n_words"), "n_base", "first_word", "last_word",
                      "base_labels", "labels", "score", again.alias("__copy")).drop("__copy")
