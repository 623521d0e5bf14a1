"""License scans by diagonal voting, with DataFrame functions only.

1. Every text is cut into words and the hash of each run of ``K`` words is joined with the table
   of all K-word runs of the license templates (a fixed list, so the table is small by design).
   A hit counts only if the words themselves agree.
2. A hit at word p of the text and word q of a template votes for the diagonal p - q.  Votes are
   counted by text, template and diagonal; neighbouring diagonals (up to ``DRIFT`` words inserted
   or left out) whose spans overlap or touch merge into one span.
3. A span is verified against its template: the distinct runs of the template that it holds must
   cover ``MIN_COVER`` of the template.  Base phrases need every run, on one diagonal, which is
   the whole phrase word by word.
4. Licenses share sentences, so of spans that overlap in a text the one with the largest share
   stays, then the one with the most runs (all of them if they tie).

Words are runs of digits, ASCII letters and non-ASCII characters after lower-casing A-Z; null
counts as empty.  A text without a match has n_base 0, null first_word and last_word, empty labels
and score 0.  Repeated rows each get their row; other columns are ignored; a template matches as
often as it occurs.  score is the largest share of a template's runs found in one verified span.  An empty table gives an
empty result.  A null doc_id is carried through.  A very long text is cut by Spark's own expressions, one row at a time, so
memory follows the longest text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import lower_ascii

K = 3
DRIFT = 8
MIN_COVER = 0.8
#: The base phrases and the labels of each.
BASE_PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}
#: Opening sentences of public license texts, found also with words left out or inserted.
TEMPLATES = {
    "mit": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction",
    "apache-2": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at",
    "bsd": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "gpl": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
    "mpl-2": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file",
    "cc-by": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "cc-by-sa": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
    "cc-by-nc": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License",
    "cc-by-nd": "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License",
    "cc-by-nc-sa": "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License",
    "cc-by-nc-nd": "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License",
    "lgpl": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation",
    "agpl": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation",
    "isc": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies",
    "zlib": "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software",
    "boost": "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license",
    "unlicense": "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software",
    "epl-2": "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0",
}
_BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(lower_ascii(F.coalesce(text, F.lit(""))), _BREAK), "")


def _runs(words: Column) -> Column:
    """The hash of K words from each position, and the words."""
    last = F.size(words) - K
    starts = F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))

    def run(i: Column) -> Column:
        gram = [F.get(words, i + j) for j in range(K)]
        return F.struct(F.xxhash64(*gram).alias("run"), *(w.alias(f"w{j}") for j, w in enumerate(gram)))

    return F.transform(starts, run)


def template_table(spark: SparkSession) -> DataFrame:
    """template, label, base, words, n_runs: one row for each phrase or template."""
    rows = [(f"base:{p}", label, True, p) for p, label in BASE_PHRASES.items()]
    rows += [(f"text:{label}", label, False, t) for label, t in TEMPLATES.items()]
    raw = spark.createDataFrame(rows, "template string, label string, base boolean, text string")
    words = raw.select("template", "label", "base", words_of(F.col("text")).alias("words"))
    return words.withColumn("n_runs", F.size("words") - (K - 1))


def _votes(texts: DataFrame, templates: DataFrame) -> DataFrame:
    """doc_id, key, template, ... , p, q: every text position that meets a template position."""
    places = templates.select("template", "label", "base", "n_runs", F.posexplode(_runs(F.col("words"))).alias("q", "at")).select("*", "at.*").drop("at")
    runs = texts.select("doc_id", "key", F.posexplode(_runs(F.col("words"))).alias("p", "at")).select("doc_id", "key", "p", "at.*")
    gram = ["run", *(f"w{j}" for j in range(K))]
    return runs.join(F.broadcast(places), gram).drop(*gram)


def _spans(votes: DataFrame) -> DataFrame:
    """Merged and verified spans: doc_id, key, label, base, start, share."""
    diagonals = (
        votes.groupBy("doc_id", "key", "template", "label", "base", "n_runs", (F.col("p") - F.col("q")).alias("diagonal"))
        .agg(F.collect_set("q").alias("qs"), F.min("p").alias("start"), F.max("p").alias("stop"))
    )
    by = Window.partitionBy("doc_id", "key", "template").orderBy("diagonal", "start")
    fresh = F.coalesce((F.col("diagonal") - F.lag("diagonal").over(by) > DRIFT), F.lit(True)) | (F.col("start") > F.lag("stop").over(by) + F.col("n_runs") + DRIFT)
    # a phrase stands on one diagonal, so each of its diagonals is a span
    numbered = diagonals.withColumn("fresh", (F.col("base") | fresh).cast("int")).withColumn("span", F.sum("fresh").over(by))
    merged = numbered.groupBy("doc_id", "key", "template", "label", "base", "n_runs", "span").agg(
        F.size(F.array_distinct(F.flatten(F.collect_list("qs")))).alias("found"), F.min("start").alias("start"), F.max("stop").alias("stop"))
    close = merged.withColumn("share", F.col("found") / F.col("n_runs")).filter(F.col("share") >= F.when(F.col("base"), 1.0).otherwise(MIN_COVER))
    return _best(close).select("doc_id", "key", "label", "base", "start", "share")


def _best(close: DataFrame) -> DataFrame:
    """All base spans, and of others that overlap in a text those with the largest share, then the most runs."""
    along = Window.partitionBy("doc_id", "key", "base").orderBy("start", "stop", "template")
    apart = F.coalesce(F.col("start") > F.max("stop").over(along.rowsBetween(Window.unboundedPreceding, -1)), F.lit(True))
    placed = close.withColumn("apart", apart.cast("int")).withColumn("place", F.sum("apart").over(along))
    by_place = Window.partitionBy("doc_id", "key", "base", "place").orderBy(F.desc("share"), F.desc("found"))
    return placed.withColumn("order", F.rank().over(by_place)).filter("base or order = 1")


def license_scan(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score of every row.

    Texts are matched under (doc_id, 64-bit hash of the text), and a text's places are a set, so
    repeated rows neither add to each other's counts nor are lost.
    """
    templates = template_table(docs.sparkSession)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("key"), words_of(F.col("text")).alias("words"))
    spans = _spans(_votes(texts, templates))
    base = F.when(F.col("base"), F.col("start"))
    found = spans.groupBy(F.col("doc_id").alias("_doc_id"), F.col("key").alias("_key")).agg(
        F.count(base).alias("n_base"), F.min(base).alias("first_word"), F.max(base).alias("last_word"),
        F.array_join(F.array_sort(F.collect_set(F.when(F.col("base"), F.col("label")))), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.collect_set("label")), ",").alias("labels"), F.max("share").alias("score"))
    counted = texts.select("doc_id", "key", F.size("words").cast("long").alias("n_words"))
    joined = counted.join(found, F.col("doc_id").eqNullSafe(F.col("_doc_id")) & (F.col("key") == F.col("_key")), "left")
    return joined.select(
        "doc_id", "n_words", F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"), F.col("first_word").cast("long"), F.col("last_word").cast("long"),
        F.coalesce("base_labels", F.lit("")).alias("base_labels"), F.coalesce("labels", F.lit("")).alias("labels"), F.coalesce("score", F.lit(0.0)).alias("score"))
