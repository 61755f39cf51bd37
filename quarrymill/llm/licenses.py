"""License scan: word grams vote for diagonals between a document and license templates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarrymill.llm.common import alphanumeric_words, bounded, gram_hash, rolling, staged

GRAM_WORDS = 2
LEAST_COVER = 0.7
DIAGONAL_GAP = 3

# Phrases whose every place is reported, with their labels.
PHRASES = [
    ("mit license", "mit"),
    ("apache license", "apache"),
    ("general public license", "gpl"),
]

# Opening words of public license notices, with their labels.
NOTICES = [
    (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction",
        "mit",
    ),
    (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at",
        "apache",
    ),
    (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation",
        "gpl",
    ),
    ("This work is licensed under the GNU General Public License, version 3", "gpl"),
    (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met",
        "bsd",
    ),
    (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted",
        "isc",
    ),
    (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
        "not distributed with this file",
        "mpl",
    ),
    ("This is free and unencumbered software released into the public domain", "unlicense"),
    ("Licensed under CC BY 4.0", "cc-by"),
    ("Licensed under CC BY-SA 4.0", "cc-by-sa"),
    ("Licensed under CC BY-NC 4.0", "cc-by-nc"),
    ("This work is licensed under a Creative Commons Attribution 4.0 International License", "cc-by"),
    ("This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License", "cc-by-nc"),
]


def shipped_templates(spark: SparkSession) -> DataFrame:
    """template, text, label, exact: the phrases and notices above. `exact` ones count at full cover only."""
    rows = [(text, label, True) for text, label in PHRASES] + [(text, label, False) for text, label in NOTICES]
    values = F.array(
        *[
            F.struct(
                F.lit(n).alias("template"),
                F.lit(text).alias("text"),
                F.lit(label).alias("label"),
                F.lit(exact).alias("exact"),
            )
            for n, (text, label, exact) in enumerate(rows)
        ]
    )
    return spark.range(1).select(F.inline(values))


def template_grams(templates: DataFrame, size: int) -> DataFrame:
    """template, label, exact, n_grams, width, place, t0..: every word gram of every template that has one."""
    worded = templates.select("template", "label", "exact", alphanumeric_words(F.col("text")).alias("words"))
    grams = worded.select(
        "template",
        "label",
        "exact",
        F.size("words").alias("width"),
        F.posexplode(rolling("words", size)).alias("place", "gram"),
    ).filter(F.col("place") <= F.col("width") - size)
    return grams.select(
        "template",
        "label",
        "exact",
        "width",
        (F.col("width") - size + 1).alias("n_grams"),
        "place",
        gram_hash("gram", size).alias("hash"),
        *[F.col(f"gram.g{i}").alias(f"t{i}") for i in range(size)],
    )


def license_spans(
    docs: DataFrame,
    templates: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    size: int = GRAM_WORDS,
    gap: int = DIAGONAL_GAP,
    least_cover: float = LEAST_COVER,
) -> DataFrame:
    """Spans of documents that follow a license template, by diagonal voting.

    The method: the hash of every rolling gram of `size` words of every document is joined to the places
    of the same gram in the templates; the words must be equal too. A vote names the diagonal, the place in
    the document minus the place in the template, and votes are summed by diagonal. An `exact` template
    has a span on each diagonal that got all its votes. For the others, diagonals at most `gap` apart
    (words put in or left out) are merged, diagonals with a single vote left aside, and a span is verified if
    it got `least_cover` of the template's grams within one and a half times its width. Only votes leave the
    task that read a text.

    Returns `row, doc_id, n_words, label, exact, start, stop, cover`: one row per span, and one row with NULLs
    in the last five for each document, so that every row of `docs`, repeated or not, is there. A NULL text
    has no words. Templates of fewer than `size` words find nothing.
    """
    grams = bounded(staged(template_grams(templates, size), "templates")).alias("t")
    worded = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(doc_id).alias("doc"),
        alphanumeric_words(F.col(text)).alias("words"),
    )
    places = worded.select(
        "row", "doc", F.size("words").alias("n_words"), F.posexplode_outer(rolling("words", size)).alias("at", "gram")
    )
    d = places.withColumn("hash", gram_hash("gram", size)).alias("d")
    same = F.col("d.hash") == F.col("t.hash")
    for i in range(size):
        same &= F.col(f"d.gram.g{i}") == F.col(f"t.t{i}")
    votes = (
        d.join(grams, same, "left")
        .filter(F.col("template").isNotNull() | F.col("at").isNull() | (F.col("at") == 0))
        .select(
            "row", "doc", "n_words", "template", "label", "exact", "n_grams", "width", "at",
            (F.col("at") - F.col("place")).alias("diagonal"),
        )
        .repartition("row")
    )
    keys = ["row", "doc", "n_words", "template", "label", "exact", "n_grams", "width"]
    diagonals = votes.groupBy(*keys, "diagonal").agg(
        F.count("template").alias("votes"), F.min("at").alias("first"), F.max("at").alias("last")
    )
    # An exact template keeps its complete diagonals, any other those with more than one vote.
    kept = diagonals.filter(
        F.col("template").isNull()
        | F.when(F.col("exact"), F.col("votes") == F.col("n_grams")).otherwise(
            (F.col("votes") > 1) | (F.col("n_grams") == 1)
        )
        | (F.col("first") == 0)
    )
    in_order = Window.partitionBy("row", "template").orderBy("diagonal")
    apart = F.col("diagonal") - F.lag("diagonal").over(in_order)
    new = F.when(F.col("exact") | apart.isNull() | (apart > gap), 1).otherwise(0)
    merged = (
        kept.withColumn("new", new)
        .withColumn("span", F.sum("new").over(in_order))
        .groupBy(*keys, "span")
        .agg(F.sum("votes").alias("votes"), F.min("first").alias("start"), (F.max("last") + size).alias("stop"))
    )
    cover = F.least(F.col("votes") / F.col("n_grams"), F.lit(1.0))
    verified = F.when(F.col("exact"), F.col("votes") == F.col("n_grams")).otherwise(
        (cover >= least_cover) & (F.col("stop") - F.col("start") <= 1.5 * F.col("width"))
    )
    good = F.coalesce(verified, F.lit(False))

    def if_good(column):
        return F.when(good, column)

    return merged.select(
        "row",
        F.col("doc").alias(doc_id),
        "n_words",
        if_good(F.col("label")).alias("label"),
        if_good(F.col("exact")).alias("exact"),
        if_good(F.col("start")).alias("start"),
        if_good(F.col("stop")).alias("stop"),
        if_good(cover).alias("cover"),
    )


def license_report(spans: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """One row per document from `license_spans`: places of exact phrases, labels and the best cover."""
    base = F.col("exact")
    places = F.when(base, F.col("start").cast("long"))

    def labels(column):
        return F.array_join(F.sort_array(F.collect_set(column)), ",")

    return (
        spans.groupBy("row", doc_id, "n_words")
        .agg(
            F.count(places).alias("n_base"),
            F.min(places).alias("first_word"),
            F.max(places).alias("last_word"),
            labels(F.when(base, F.col("label"))).alias("base_labels"),
            labels(F.col("label")).alias("labels"),
            F.coalesce(F.max("cover"), F.lit(0.0)).alias("score"),
        )
        .select(
            doc_id, F.col("n_words").cast("long").alias("n_words"), "n_base", "first_word", "last_word",
            "base_labels", "labels", "score",
        )
    )
