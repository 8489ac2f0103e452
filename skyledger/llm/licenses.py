"""License scans: sparse TF-IDF cosine to templates, then inheritance from the nearest directory.

The sentences of a text are compared with the sentences of the templates. Document
frequencies of the templates' words are counted over all documents. A sentence can only
reach the cosine asked for if it has one of a template's heaviest words: the rest of the
template is too light. That exact rule, as one pattern, picks the sentences whose words are
counted and joined to the templates' word lists.

A file without a licence of its own takes that of the nearest directory above it that holds
a licence file. Directories, not files, are joined to their ancestors.
"""

from __future__ import annotations

import json
import math
import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyledger.llm.common import stored

LEAST_COSINE = 0.75
# A text of which this share of words is licence sentences is a licence file.
FILE_SHARE = 0.5
FILE_NAME = r"(?i)^(licen[cs]e|copying|unlicense)(\.(txt|md))?$"

# Names of licences, the usual sentences around a name, and opening sentences.
NAMES = {
    "MIT": ["the MIT License"],
    "Apache-2.0": ["the Apache License, Version 2.0"],
    "GPL-2.0": ["the GNU General Public License, version 2"],
    "GPL-3.0": ["the GNU General Public License, version 3"],
    "LGPL-3.0": ["the GNU Lesser General Public License, version 3"],
    "AGPL-3.0": ["the GNU Affero General Public License, version 3"],
    "MPL-2.0": ["the Mozilla Public License, Version 2.0"],
    "BSD-2-Clause": ["the BSD 2-Clause License"],
    "BSD-3-Clause": ["the BSD 3-Clause License"],
    "ISC": ["the ISC License"],
    "CC0-1.0": ["CC0 1.0", "the Creative Commons CC0 1.0 Universal Public Domain Dedication"],
    "CC-BY-4.0": ["CC BY 4.0", "a Creative Commons Attribution 4.0 International License"],
    "CC-BY-SA-4.0": ["CC BY-SA 4.0", "a Creative Commons Attribution-ShareAlike 4.0 International License"],
    "CC-BY-NC-4.0": ["CC BY-NC 4.0", "a Creative Commons Attribution-NonCommercial 4.0 International License"],
    "CC-BY-ND-4.0": ["CC BY-ND 4.0", "a Creative Commons Attribution-NoDerivatives 4.0 International License"],
}
FORMS = ["Licensed under {}.", "Released under {}.", "This work is licensed under {}."]
OPENINGS = {
    "MIT": [
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files"
    ],
    "Apache-2.0": ["You may not use this file except in compliance with the License"],
    "GPL-3.0": [
        "You can redistribute it and/or modify it under the terms of the GNU General Public License as published by the "
        "Free Software Foundation, either version 3 of the License, or any later version"
    ],
    "BSD-3-Clause": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met"
    ],
    "Unlicense": ["This is free and unencumbered software released into the public domain"],
}


def templates() -> list[tuple[str, str]]:
    """(licence, sentence) of all templates."""
    found = [(name, form.format(title)) for name, titles in NAMES.items() for title in titles for form in FORMS]
    found += [(name, f"SPDX-License-Identifier: {name}") for name in {**NAMES, **OPENINGS}]
    return found + [(name, text) for name, texts in OPENINGS.items() for text in texts]


NOT_WORD = r"[^\p{L}\p{N}]+"
SENTENCE_END = r"(?<=[.!?])\s+|\n+"


def words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), NOT_WORD, -1), lambda w: w != "")


def _python_words(text: str) -> list[str]:
    return re.findall(r"[^\W_]+", text.lower())


def document_counts(files: DataFrame, text: str, vocabulary: list[str]) -> tuple[int, dict[str, int]]:
    """Documents, and how many hold each word of the templates; a row per word reaches the driver."""
    known = F.from_json(F.lit(json.dumps(vocabulary)), "array<string>")
    held = F.array_intersect(words(F.coalesce(F.col(text), F.lit(""))), known)
    rows = files.select(F.explode(F.concat(F.array(F.lit("")), held)).alias("word")).groupBy("word").count().collect()
    counts = {row["word"]: row["count"] for row in rows}
    return counts.pop("", 0), counts


def weigh(sentences: list[tuple[str, str]], total: int, counts: dict[str, int]):
    """Unit vectors of the templates, the idf of their words, and that of a word in one document."""
    inverse = lambda n: math.log((1 + total) / (1 + n)) + 1
    vectors, idf = [], {}
    for licence, sentence in sentences:
        vector: dict[str, float] = {}
        for word in _python_words(sentence):
            idf[word] = inverse(counts.get(word, 0))
            vector[word] = vector.get(word, 0.0) + idf[word]
        length = math.sqrt(sum(w * w for w in vector.values()))
        vectors.append((licence, {word: w / length for word, w in vector.items()}))
    return vectors, idf, inverse(1)


def heavy_words(vectors, least: float) -> set[str]:
    """Words of which a sentence must have one to reach the cosine with any template.

    Without the heaviest words of a template, a sentence can match no more than the length
    of what is left of it.
    """
    needed = set()
    for _, vector in vectors:
        left = 1.0
        for word, weight in sorted(vector.items(), key=lambda item: (-item[1], item[0])):
            if math.sqrt(max(left, 0.0)) < least:
                break
            needed.add(word)
            left -= weight * weight
    return needed


def licence_sentences(files: DataFrame, text: str, least: float = LEAST_COSINE) -> DataFrame:
    """text_key, place, licence, score, n_words of each sentence that is a licence's.

    By the digest of the text, so repeated texts are compared once. The best licence of a
    sentence counts; of equal ones the first by name.
    """
    spark = files.sparkSession
    sentences = templates()
    vocabulary = sorted({word for _, sentence in sentences for word in _python_words(sentence)})
    total, counts = document_counts(files, text, vocabulary)
    vectors, idf, rare = weigh(sentences, total, counts)
    pattern = r"(?iu)(?<![\p{L}\p{N}])(" + "|".join(sorted(map(re.escape, heavy_words(vectors, least)))) + r")(?![\p{L}\p{N}])"
    whole = F.coalesce(F.col(text), F.lit(""))
    units = (
        files.select(F.md5(whole).alias("text_key"), whole.alias("text"))
        .where(F.col("text").rlike(pattern))
        .select("text_key", F.posexplode(F.split("text", SENTENCE_END, -1)).alias("place", "sentence"))
        .where(F.col("sentence").rlike(pattern))
    )
    terms = (
        units.select("text_key", "place", F.explode(words(F.col("sentence"))).alias("word"))
        .groupBy("text_key", "place", "word")
        .agg(F.count("*").alias("n"))
    )
    repeats = files.groupBy(F.md5(whole).alias("text_key")).agg(F.count("*").alias("rows"))
    # The word lists of the templates: as many rows as the templates have words.
    postings = spark.createDataFrame(
        [
            (word, idf[word], [(number, weight) for number, (_, vector) in enumerate(vectors) if (weight := vector.get(word))])
            for word in vocabulary
        ],
        "word string, idf double, uses array<struct<template:int,weight:double>>",
    )
    weighed = terms.join(repeats, "text_key").withColumn("n", F.col("n") / F.col("rows")).join(F.broadcast(postings), "word", "left")
    weight = F.col("n") * F.coalesce("idf", F.lit(rare))
    lengths = weighed.groupBy("text_key", "place").agg(
        F.sqrt(F.sum(weight * weight)).alias("length"), F.sum("n").cast("long").alias("n_words")
    )
    products = (
        weighed.where("uses IS NOT NULL")
        .select("text_key", "place", weight.alias("w"), F.inline("uses"))
        .groupBy("text_key", "place", "template")
        .agg(F.sum(F.col("w") * F.col("weight")).alias("product"))
    )
    names = F.from_json(F.lit(json.dumps([licence for licence, _ in vectors])), "array<string>")
    scored = (
        products.join(lengths, ["text_key", "place"])
        .withColumn("score", F.round(F.col("product") / F.col("length"), 6))
        .where(F.col("score") >= least)
        .withColumn("licence", F.element_at(names, F.col("template") + 1))
    )
    best = Window.partitionBy("text_key", "place").orderBy(F.desc("score"), "licence", "template")
    return (
        scored.withColumn("rank", F.row_number().over(best))
        .where("rank = 1")
        .select("text_key", "place", "licence", "score", "n_words")
    )


def directories(path: Column) -> Column:
    """The directories above a path, the nearest first; the last is the empty root."""
    parts = F.split(path, "/", -1)
    depth = F.size(parts) - 1
    return F.transform(F.sequence(F.lit(0), depth), lambda i: F.array_join(F.slice(parts, F.lit(1), depth - i), "/"))


def scan(
    files: DataFrame, key: str = "doc_id", path: str = "path", text: str = "text", least: float = LEAST_COSINE
) -> DataFrame:
    """One row per file: doc_id, path, n_sentences, own, score, is_file, licence, inherited_from.

    `own` joins the licences of a file's sentences, by name, with AND; `licence` is that, or
    what the nearest directory above with a licence file gives, which joins those of its
    licence files. A licence file has a name of one, or half its words in licence sentences.
    A null text is empty; a null path lies in the root. Repeated rows each have a row. An
    empty table gives no rows. Other columns play no part.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    picked = files.select(
        F.col(key).alias("doc_id"),
        F.col(path).alias("path"),
        whole.alias("text"),
    )
    sentences = stored(licence_sentences(picked, "text", least), "licence-sentences")
    per_text = sentences.groupBy("text_key").agg(
        F.count("*").alias("n_sentences"),
        F.array_join(F.array_sort(F.collect_set("licence")), " AND ").alias("own"),
        F.max("score").alias("score"),
        F.sum("n_words").alias("licence_words"),
    )
    slim = stored(
        picked.select(
            "doc_id",
            "path",
            F.md5("text").alias("text_key"),
            F.size(words(F.col("text"))).alias("all_words"),
            F.element_at(directories(F.coalesce("path", F.lit(""))), 1).alias("directory"),
        ),
        "licence-files",
    )
    name = F.element_at(F.split(F.coalesce("path", F.lit("")), "/", -1), -1)
    own = slim.join(per_text, "text_key", "left").withColumn(
        "is_file",
        F.col("own").isNotNull() & (name.rlike(FILE_NAME) | (F.col("licence_words") >= F.col("all_words") * FILE_SHARE)),
    )
    granted = (
        own.where("is_file")
        .select("directory", F.explode(F.split("own", " AND ")).alias("one"))
        .groupBy("directory")
        .agg(F.array_join(F.array_sort(F.collect_set("one")), " AND ").alias("given"))
        .withColumnRenamed("directory", "above")
    )
    steps = (
        slim.select("directory")
        .distinct()
        .select("directory", F.posexplode(directories(F.concat("directory", F.lit("/")))).alias("step", "above"))
        .where("step = 0 OR directory <> ''")
    )
    nearest = (
        steps.join(granted, "above")
        .groupBy("directory")
        .agg(F.min(F.struct("step", "above", "given")).alias("n"))
        .select("directory", F.col("n.above").alias("inherited_from"), F.col("n.given").alias("given"))
    )
    return own.join(nearest, "directory", "left").select(
        "doc_id",
        "path",
        F.coalesce("n_sentences", F.lit(0)).cast("long").alias("n_sentences"),
        "own",
        "score",
        "is_file",
        F.coalesce("own", "given").alias("licence"),
        F.when(F.col("own").isNull(), F.col("inherited_from")).alias("inherited_from"),
    )


def query(spark, sf_dir: str) -> DataFrame:
    """op9: licences of all documents, placed in a tree by source, language and thousand of ids."""
    from skyledger.llm.common import table

    part = lambda c: F.coalesce(c.cast("string"), F.lit("_"))
    place = F.concat_ws(
        "/", part(F.col("source")), part(F.col("lang")), part(F.floor(F.col("doc_id") / 1000)), part(F.col("doc_id"))
    )
    return scan(table(spark, sf_dir, "documents").withColumn("path", place))
