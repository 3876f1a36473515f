"""License scans by diagonal voting (DataFrame functions only).

Every rolling word k-gram of every text is joined to the grams of the license
templates (a fixed table, broadcast). A hit of gram t of a template at word p
votes for the diagonal p - t, the word where the template would start. Votes
are combined on the map side into one bit set a diagonal. A diagonal with all
its template's grams is verified by itself: there the words stand one after
another. That is the only way for base phrases and for notices under
``WHOLE_BELOW`` words, where one other word makes another license. Of longer
notices, diagonals within ``GAP`` words of their neighbour (words were added or
left out) are merged as far as a notice may stretch; a span is verified by the
share of the template's words that its hits cover and by the gram that tells
the notice from its like.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from txwatch.llm.common import ascii_lower, let
from txwatch.session import materialize

#: Fixed: the base phrases and their labels.
PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
#: The notices that the method looks for besides, and their labels.
NOTICES = {
    "this work is licensed under the gnu general public license version 3": "gpl-3",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public "
    "license as published by the free software foundation": "gpl-notice",
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "licensed under the apache license version 2 0": "apache-2",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
    "documentation files": "mit-notice",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the "
    "following conditions are met": "bsd",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
    "granted": "isc",
    "this source code form is subject to the terms of the mozilla public license": "mpl",
    "licensed under cc by nc 4 0": "cc-by-nc",
    "this work is licensed under a creative commons attribution 4 0 international license": "cc-by-4",
    "creative commons attribution sharealike": "cc-by-sa",
    "this is free and unencumbered software released into the public domain": "unlicense",
    "all rights reserved": "all-rights-reserved",
}
#: Fixed: the words by which a longer notice differs from those of other licenses; they must be there.
TELLING = {
    "gpl-notice": "the gnu general public",
    "mit-notice": "any person obtaining a",
    "bsd": "redistribution and use in",
    "isc": "this software for any",
    "mpl": "the mozilla public license",
    "cc-by-4": "commons attribution 4 0",
}
#: Grams of short and of long templates; words a template must have to be long, and to be found in part.
SHORT, LONG, LONG_FROM, WHOLE_BELOW = 2, 4, 12, 13
GAP, MIN_COVERED, MAX_STRETCH = 3, 0.75, 1.5
WORD_GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def gram(n_words: int) -> int:
    return LONG if n_words >= LONG_FROM else SHORT


def license_words(text: Column) -> Column:
    """Words of the text with A-Z lower-cased; an empty array for a null text."""
    lower = ascii_lower(F.coalesce(text.cast("string"), F.lit("")))
    return F.filter(F.split(lower, WORD_GAP), lambda w: w != "")


def templates(spark: SparkSession) -> DataFrame:
    """``template, label, base, size, k, whole, must, t, bit, hash``: one row a gram
    (``bit``: 1 shifted by t, ``whole``: the bits of all its grams, ``must``: of the telling one)."""
    rows = []
    for base, texts in ((True, PHRASES), (False, NOTICES)):
        for text, label in texts.items():
            w = text.split()
            k = gram(len(w))
            if len(w) > 60:
                raise ValueError("a template has at most 60 words")
            n = len(w) - k + 1
            rows += [(text, label, base, len(w), k, (1 << n) - 1, 1 << telling(text, label), t, 1 << t, w[t:t + k]) for t in range(n)]
    df = spark.createDataFrame(rows, "template string, label string, base boolean, size int, k int, whole long, must long, t int, "
                                     "bit long, words array<string>")
    hashed = F.when(F.col("k") == SHORT, _hash(F.col("words"), F.lit(0), SHORT)).otherwise(_hash(F.col("words"), F.lit(0), LONG))
    return df.withColumn("hash", hashed).drop("words")


def telling(text: str, label: str) -> int:
    """The number of the gram that must be hit (of notices that are found whole: the first)."""
    w, tells = text.split(), TELLING.get(label, "").split()
    return next(t for t in range(len(w)) if w[t:t + len(tells)] == tells)


def _hash(words: Column, at: Column, k: int) -> Column:
    return F.xxhash64(F.lit(k), *[F.get(words, at + j) for j in range(k)])


def grams(words: Column, k: int) -> Column:
    """``pos, hash`` of each rolling gram."""
    none = F.array().cast("array<struct<pos:int,hash:bigint>>")
    return F.when(F.size(words) < k, none).otherwise(F.transform(
        F.sequence(F.lit(0), F.size(words) - k), lambda i: F.struct(i.alias("pos"), _hash(words, i, k).alias("hash"))))


def spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, text_key, label, base, first, last, covered`` of every place of a
    base phrase and every verified span of a notice (words from 0, inclusive).
    Rows that repeat both id and text share their spans."""
    rolled = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.xxhash64(F.coalesce(F.col(text_col).cast("string"), F.lit(""))).alias("text_key"),
        F.explode(let(license_words(F.col(text_col)), lambda w: F.concat(grams(w, SHORT), grams(w, LONG)))).alias("g"))
    hits = (rolled.select("doc_id", "text_key", "g.pos", "g.hash")
            .join(F.broadcast(templates(docs.sparkSession)), "hash"))

    place = ["doc_id", "text_key", "template", "label", "base", "size", "k", "whole", "must"]
    diagonal = materialize(hits.groupBy(*place, (F.col("pos") - F.col("t")).alias("diag"))
                .agg(F.bit_or("bit").alias("hits"),
                     F.min("pos").alias("first"), F.max(F.col("pos") + F.col("k") - 1).alias("last")), "diagonals")
    alone = diagonal.where(F.col("hits") == F.col("whole")).select(
        "doc_id", "text_key", "label", "base", "first", "last", F.lit(1.0).alias("covered"))

    # neighbouring diagonals of one template in one text
    order = Window.partitionBy("doc_id", "text_key", "template").orderBy("diag")
    notices = diagonal.where(~F.col("base") & (F.col("size") >= WHOLE_BELOW) & (F.col("hits") != F.col("whole")))
    jump = F.coalesce(F.col("diag") - F.lag("diag").over(order) > GAP, F.lit(False)).cast("int")
    run = notices.withColumn("jump", jump).withColumn("run", F.sum("jump").over(order))
    start = F.min("diag").over(Window.partitionBy("doc_id", "text_key", "template", "run"))
    # a long run in stretches of what a notice may grow by, cut in two ways so that no notice falls between two of them
    parts = (run.withColumn("start", start).withColumn("cut", F.explode(F.array(F.lit(0), F.lit(1))))
             .withColumn("stretch", F.expr(f"(diag - start + cut * (floor(size * {MAX_STRETCH - 1}) div 2)) div floor(size * {MAX_STRETCH - 1})")))
    merged = (parts.groupBy(*place, "run", "cut", "stretch")
              .agg(F.bit_or("hits").alias("hits"), F.min("first").alias("first"), F.max("last").alias("last")))
    bits = F.col("hits")
    for j in range(1, LONG):  # a gram covers its k words
        more = F.shiftleft(F.col("hits"), j)
        bits = bits.bitwiseOR(more if j < SHORT else F.when(F.col("k") > j, more).otherwise(F.lit(0).cast("long")))
    covered = F.bit_count(bits) / F.col("size")
    verified = merged.withColumn("covered", covered).where(
        (F.col("covered") >= MIN_COVERED) & (F.col("hits").bitwiseAND(F.col("must")) != 0)
        & (F.col("last") - F.col("first") + 1 <= MAX_STRETCH * F.col("size")))
    return alone.unionByName(verified.select(*alone.columns).distinct())


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, n_words, n_base, first_word, last_word,
    base_labels, labels, score`` (the best share of a template that is covered).

    A null text has no words. Without a place of a base phrase, ``first_word``
    and ``last_word`` are null. Null ids and repeated rows keep their rows. An
    empty table gives no rows; other columns are not read."""
    found = spans(docs, id_col, text_col).withColumn("start", F.when(F.col("base"), F.col("first").cast("long")))
    names = F.array_join(F.array_sort(F.collect_set("label")), ",")
    per_doc = found.groupBy("doc_id", "text_key").agg(
        F.count("start").alias("n_base"), F.min("start").alias("first_word"), F.max("start").alias("last_word"),
        F.array_join(F.array_sort(F.collect_set(F.when(F.col("base"), F.col("label")))), ",").alias("base_labels"),
        names.alias("labels"), F.max("covered").alias("score"))
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text).alias("key"),
                       F.size(license_words(F.col(text_col))).cast("long").alias("n_words"))
    joined = rows.join(per_doc, F.col("id").eqNullSafe(F.col("doc_id")) & (F.col("key") == F.col("text_key")), "left")
    return joined.select(F.col("id").alias("doc_id"), "n_words", F.coalesce("n_base", F.lit(0).cast("long")).alias("n_base"),
                         "first_word", "last_word", F.coalesce("base_labels", F.lit("")).alias("base_labels"),
                         F.coalesce("labels", F.lit("")).alias("labels"), F.coalesce("score", F.lit(0.0)).alias("score"))
