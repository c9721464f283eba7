"""License scan by diagonal voting, in built-in functions only.

Every run of ``GRAM`` words of every document is hashed and joined with the runs of the license
templates. A shared run votes for its diagonal, the difference of the two places; votes are summed
per document, template and diagonal. Diagonals that lie within ``DRIFT`` words of each other are
merged, which bridges inserted and missing words, and a merged group counts if its runs cover at
least the template's share of runs and do not stretch over much more than the template.

Beside it stand the base phrases: places where the words of a phrase follow each other. The template
table is a fixed part of this module, a few hundred rows, and is broadcast. Texts are not shuffled.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from riskspark.llm.native import gram_hash, plain_words, word_ids

GRAM = 3
DRIFT = 5
#: Least share of a template's runs that a document must have.
COVERED = 0.6

#: Phrases and their labels.
PHRASES = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)

#: Label and wording of notices in common use, and of the licenses' own texts.
TEMPLATES = (
    ("apache-2.0", "licensed under the apache license version 2.0"),
    ("gpl-3.0", "licensed under the gnu general public license version 3"),
    ("gpl-2.0", "licensed under the gnu general public license version 2"),
    ("mit", "released under the mit license"),
    ("mit", "licensed under the mit license"),
    ("cc-by-nc-4.0", "licensed under cc by nc 4.0"),
    ("cc-by-sa-4.0", "licensed under cc by sa 4.0"),
    ("cc-by-4.0", "licensed under cc by 4.0"),
    ("cc-by-4.0", "this work is licensed under a creative commons attribution 4.0 international license"),
    ("cc0-1.0", "to the extent possible under law the author has waived all copyright and related or neighboring rights to this work"),
    (
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
        "documentation files the software to deal in the software without restriction including without limitation "
        "the rights to use copy modify merge publish distribute sublicense and or sell copies of the software",
    ),
    (
        "bsd",
        "redistribution and use in source and binary forms with or without modification are permitted provided that "
        "the following conditions are met",
    ),
    (
        "isc",
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
        "granted provided that the above copyright notice and this permission notice appear in all copies",
    ),
    (
        "apache-2.0",
        "you may not use this file except in compliance with the license you may obtain a copy of the license at "
        "http www apache org licenses license 2.0",
    ),
    (
        "gpl-3.0",
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general "
        "public license as published by the free software foundation either version 3 of the license or at your "
        "option any later version",
    ),
    (
        "lgpl",
        "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser "
        "general public license as published by the free software foundation",
    ),
    (
        "mpl-2.0",
        "this source code form is subject to the terms of the mozilla public license v 2.0 if a copy of the mpl was "
        "not distributed with this file you can obtain one at",
    ),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
)


def template_runs(spark: SparkSession, templates: tuple[tuple[str, str], ...] = TEMPLATES) -> DataFrame:
    """``template``, ``label``, ``runs`` (how many), ``template_at`` and ``hash`` of each run."""
    table = spark.createDataFrame(
        [(i, label, text) for i, (label, text) in enumerate(templates)], "template int, label string, wording string"
    )
    ids = table.withColumn("ids", word_ids(plain_words(F.col("wording"))))
    placed = ids.select("template", "label", "ids", F.posexplode("ids").alias("template_at", "__id"))
    return placed.where(F.col("template_at") + GRAM <= F.size("ids")).select(
        "template",
        "label",
        (F.size("ids") - (GRAM - 1)).alias("runs"),
        "template_at",
        gram_hash(F.col("ids"), F.col("template_at"), tuple(range(GRAM))).alias("hash"),
    )


def _key(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def license_spans(docs: DataFrame, templates: tuple[tuple[str, str], ...] = TEMPLATES) -> DataFrame:
    """``doc_id``, ``text_hash``, ``label``, ``first``, ``last`` (words from 0), ``share`` of the runs.

    One row per verified place. Repeated rows count as one; null texts have none.
    """
    known = F.broadcast(template_runs(docs.sparkSession, templates))
    ids = docs.select("doc_id", _key(F.col("text")).alias("text_hash"), word_ids(plain_words(F.col("text"))).alias("ids"))
    runs = F.transform(
        F.sequence(F.lit(0), F.size("ids") - GRAM), lambda at: gram_hash(F.col("ids"), at, tuple(range(GRAM)))
    )
    # only a place and a hash go on from here, not the array; the condition is no filter on the rows,
    # which would compute the words once more
    runs = F.when(F.size("ids") >= GRAM, runs)
    placed = ids.select("doc_id", "text_hash", F.posexplode(runs).alias("at", "hash"))
    votes = (
        placed
        .join(known, "hash")
        .groupBy("doc_id", "text_hash", "template", "label", "runs", (F.col("at") - F.col("template_at")).alias("diagonal"))
        .agg(
            F.collect_set("template_at").alias("places"),
            F.min("at").alias("first"),
            (F.max("at") + (GRAM - 1)).alias("last"),
        )
    )
    along = Window.partitionBy("doc_id", "text_hash", "template").orderBy("diagonal")
    apart = F.coalesce((F.col("diagonal") - F.lag("diagonal").over(along) > DRIFT).cast("int"), F.lit(0))
    merged = (
        votes.withColumn("apart", apart)
        .withColumn("group", F.sum("apart").over(along.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy("doc_id", "text_hash", "template", "label", "runs", "group")
        .agg(
            F.size(F.array_distinct(F.flatten(F.collect_list("places")))).alias("covered"),
            F.min("first").alias("first"),
            F.max("last").alias("last"),
        )
    )
    spans = merged.where(
        (F.col("covered") >= F.ceil(F.col("runs") * COVERED))
        & (F.col("last") - F.col("first") + 1 <= 2 * (F.col("runs") + GRAM - 1))
    ).withColumn("share", F.col("covered") / F.col("runs"))
    # of templates that begin at one word, those with the largest share
    same_start = Window.partitionBy("doc_id", "text_hash", "first")
    best = spans.withColumn("best", F.max("share").over(same_start)).where("share = best")
    return best.select("doc_id", "text_hash", "label", "first", "last", "share").distinct()


def _phrase_places(words: Column, phrase: str) -> Column:
    first, *rest = phrase.split(" ")
    at = F.sequence(F.lit(0), F.size(words) - 1)

    def follows(i: Column) -> Column:
        steps = [F.get(words, i + k) == word for k, word in enumerate(rest, 1)]
        return reduce(lambda a, b: a & F.coalesce(b, F.lit(False)), steps, F.get(words, i) == first)

    return F.filter(at, follows)


def scan(docs: DataFrame, templates: tuple[tuple[str, str], ...] = TEMPLATES) -> DataFrame:
    """One row per document: word count, base phrases, labels, score and the verified ``spans``.

    ``score`` is the best share of a template's runs, and at least 0.5 where a base phrase stands.
    Null and empty texts have no words. Repeated rows and null ids each keep their row. Extra columns
    are not looked at.
    """
    found = (
        license_spans(docs, templates)
        .groupBy("doc_id", "text_hash")
        .agg(
            F.collect_set("label").alias("__labels"),
            F.max("share").alias("__share"),
            F.sort_array(F.collect_list(F.struct("first", "last", "label", "share"))).alias("spans"),
        )
        .select(F.col("doc_id").alias("__doc"), F.col("text_hash").alias("__text"), "__labels", "__share", "spans")
    )
    words = docs.select("doc_id", _key(F.col("text")).alias("text_hash"), plain_words(F.col("text")).alias("words"))
    none = F.array().cast("array<int>")
    likely = F.array_contains("words", "license") | F.array_contains("words", "cc")
    places = [F.when(likely, _phrase_places(F.col("words"), phrase)).otherwise(none) for phrase, _ in PHRASES]
    words = words.select("doc_id", "text_hash", F.size("words").cast("long").alias("n_words"), F.array(*places).alias("places"))
    every = F.flatten("places")
    labels = F.array(*[F.when(F.size(F.col("places")[i]) > 0, F.lit(label)) for i, (_, label) in enumerate(PHRASES)])
    base = words.select(
        "doc_id",
        "text_hash",
        "n_words",
        F.size(every).cast("long").alias("n_base"),
        F.array_min(every).cast("long").alias("first_word"),
        F.array_max(every).cast("long").alias("last_word"),
        F.array_sort(F.array_compact(labels)).alias("base"),
    )
    joined = base.join(
        found, F.col("doc_id").eqNullSafe(F.col("__doc")) & (F.col("text_hash") == F.col("__text")), "left"
    )
    extra = F.coalesce("__labels", F.array().cast("array<string>"))
    return joined.select(
        "doc_id",
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        F.array_join("base", ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("base", extra)), ",").alias("labels"),
        F.greatest(F.coalesce("__share", F.lit(0.0)), F.when(F.col("n_base") > 0, 0.5).otherwise(0.0)).alias("score"),
        "spans",
    )
