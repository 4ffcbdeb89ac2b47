"""License scans by diagonal voting.

Every run of ``GRAM`` words of a document is hashed and joined to the places of the same hash in
the license templates. A match votes for the diagonal ``document position - template position``:
a template that stands in the text unchanged gives all its votes to one diagonal, an edited one
to a few neighbours. Votes are counted per diagonal, neighbouring diagonals that follow each other
are merged into a span, and a span is verified by the share of the template's words that its
matches cover in order.

Words are runs of letters, digits and non-ASCII characters, ASCII letters in lower case. Besides
the templates, fixed phrases are looked for; their labels always stay. Null and empty texts have
no words and no labels. Rows with the same id are told apart by their texts; repeated rows get
the same result. Templates are a parameter of fixed size, so they are broadcast.
"""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StringType, StructField

from linksieve.llm.texts import column, text_columns

#: Words in a gram, the share of a template's words that makes a span valid, and how far apart
#: diagonals may lie that are one span.
GRAM = 3
LEAST_COVERED = 0.7
DRIFT = 4

# Phrases of the base scan, and the templates' wording.
PHRASES = {
    "cc by": "cc-by",
    "general public license": "gpl",
    "all rights reserved": "reserved",
}
TEMPLATES = (
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    (
        "apache-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is"
        " distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied",
    ),
    ("mit", "Released under the MIT License"),
    (
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated"
        " documentation files, to deal in the Software without restriction, including without limitation the rights"
        " to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
    ),
    ("gpl", "This work is licensed under the GNU General Public License, version 3"),
    (
        "gpl",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General"
        " Public License as published by the Free Software Foundation",
    ),
    ("lgpl", "under the terms of the GNU Lesser General Public License"),
    (
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that"
        " the following conditions are met",
    ),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("cc-by", "Licensed under CC BY 4.0"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    (
        "cc-by-nc",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License",
    ),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
)

#: Everything ASCII that is in no word, as a space; letters in lower case.
_AS_WORDS = bytes(b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").lower().translate(_AS_WORDS).split()


def gram_hashes(words: list[bytes]) -> np.ndarray:
    """A rolling 64-bit hash of every run of ``GRAM`` words."""
    if len(words) < GRAM:
        return np.empty(0, np.int64)
    hashed = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    rolled = hashed[: len(words) - GRAM + 1].copy()
    for shift in range(1, GRAM):
        rolled = rolled * np.uint64(0x9E3779B97F4A7C15) + hashed[shift : len(words) - GRAM + 1 + shift]
    return (rolled ^ (rolled >> np.uint64(29))).view(np.int64)


def template_grams(spark: SparkSession, templates=TEMPLATES) -> DataFrame:
    """A row per gram of a template: ``template, label, place, hash, length`` in words."""
    rows = []
    for number, (label, wording) in enumerate(templates):
        words = words_of(wording)
        rows += [(number, label, i, int(h), len(words)) for i, h in enumerate(gram_hashes(words))]
    return spark.createDataFrame(rows, "template int, label string, place int, hash long, length int")


def phrase_places(words: list[bytes]) -> list[tuple[int, str]]:
    """Where a fixed phrase stands, and its label, in order."""
    line, found = b" " + b" ".join(words) + b" ", []
    for phrase, label in PHRASES.items():
        wanted = f" {phrase} ".encode()
        at = line.find(wanted)
        while at >= 0:
            found.append((line.count(b" ", 0, at), label))
            at = line.find(wanted, at + 1)
    return sorted(found)


def base_scan(df: DataFrame, text: str, keep: list[str]) -> DataFrame:
    """Word count and places of the fixed phrases."""

    def make():
        def compute(texts):
            rows = []
            for t in texts:
                words = words_of(t)
                places = phrase_places(words)
                starts = [p for p, _ in places] or [None]
                labels = ",".join(sorted({label for _, label in places}))
                rows.append((len(words), len(places), starts[0], starts[-1], labels))
            return list(zip(*rows)) or [[]] * 5

        return compute

    longs = [StructField(c, LongType()) for c in ("n_words", "n_base", "first_word", "last_word")]
    return text_columns(df, make, [*longs, StructField("base_labels", StringType())], text, keep)


def votes(df: DataFrame, text: str, keep: list[str], templates=TEMPLATES) -> DataFrame:
    """Per document, template and diagonal: first word and the template places that matched."""

    def make():
        return lambda texts: [[gram_hashes(words_of(t)) for t in texts]]

    grams = text_columns(df, make, [StructField("grams", ArrayType(LongType()))], text, keep)
    known = template_grams(df.sparkSession, templates)
    return (
        grams.select(*map(column, keep), F.posexplode("grams").alias("at", "hash"))
        .join(F.broadcast(known), "hash")
        .groupBy(*map(column, keep), "template", "label", "length", (F.col("at") - F.col("place")).alias("diagonal"))
        .agg(F.min("at").alias("first"), F.max("at").alias("last"), F.collect_set("place").alias("places"))
    )


def spans(df: DataFrame, text: str, keep: list[str], templates=TEMPLATES) -> DataFrame:
    """Merged diagonals: ``template, label, first, last`` (words) and ``covered``, 0 to 1.

    Diagonals belong together if they differ by ``DRIFT`` at most and the next starts before the
    template could have ended.
    """
    order = Window.partitionBy(*map(column, keep), "template").orderBy("first", "diagonal")
    apart = (F.abs(F.col("diagonal") - F.lag("diagonal").over(order)) > DRIFT) | (
        F.col("first") > F.lag("last").over(order) + F.col("length")
    )
    merged = (
        votes(df, text, keep, templates)
        .withColumn("starts", F.coalesce(apart, F.lit(True)).cast("int"))
        .withColumn("span", F.sum("starts").over(order))
        .groupBy(*map(column, keep), "template", "label", "length", "span")
        .agg(
            F.min("first").alias("first"),
            (F.max("last") + GRAM - 1).alias("last"),
            F.array_distinct(F.flatten(F.collect_list("places"))).alias("places"),
        )
    )
    words = F.array_distinct(F.flatten(F.transform("places", lambda p: F.sequence(p, p + (GRAM - 1)))))
    return merged.select(
        *map(column, keep), "template", "label", "first", "last", (F.size(words) / F.col("length")).alias("covered")
    )


def scan(df: DataFrame, text: str = "text", key: str = "doc_id", templates=TEMPLATES) -> DataFrame:
    """A row per row of ``df``: base columns, all labels, and the best coverage as ``score``."""
    keyed = df.select(column(key), column(text), F.xxhash64(column(text)).alias("\x00hash"))
    ids = [key, "\x00hash"]
    found = spans(keyed, text, ids, templates)
    best = found.groupBy(*map(column, ids)).agg(
        F.collect_set(F.when(F.col("covered") >= LEAST_COVERED, F.col("label"))).alias("\x00labels"),
        F.max("covered").alias("\x00score"),
    )
    best = best.withColumnsRenamed({key: "\x00key", "\x00hash": "\x00text"})
    base = base_scan(keyed, text, ids)
    joined = base.join(
        best,
        base[f"`{key}`"].eqNullSafe(best["`\x00key`"]) & (base["`\x00hash`"] == best["`\x00text`"]),
        "left",
    )
    own = F.filter(F.split("base_labels", ","), lambda x: x != "")
    labels = F.array_join(
        F.array_sort(F.array_union(own, F.coalesce(column("\x00labels"), F.array().cast("array<string>")))), ","
    )
    return joined.select(
        column(key),
        *("n_words", "n_base", "first_word", "last_word", "base_labels"),
        labels.alias("labels"),
        F.coalesce(column("\x00score"), F.lit(0.0)).cast(DoubleType()).alias("score"),
    )
