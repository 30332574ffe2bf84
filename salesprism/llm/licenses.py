"""Licences of files: sparse TF-IDF cosine to templates, then inheritance from the nearest directory.

DataFrame functions only.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from salesprism.llm.store import stored

#: The customary notices of public licences.
TEMPLATES = {
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0",
        "You may not use this file except in compliance with the License. You may obtain a copy of the License at",
        "distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied",
    ),
    "MIT": (
        "Released under the MIT License",
        "Licensed under the MIT License",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
    ),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License",
    ),
    "GPL-2.0": ("This work is licensed under the GNU General Public License, version 2",),
    "LGPL-3.0": ("This work is licensed under the GNU Lesser General Public License, version 3",),
    "AGPL-3.0": ("This work is licensed under the GNU Affero General Public License, version 3",),
    "BSD-3-Clause": (
        "Licensed under the BSD 3-Clause License",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    ),
    "BSD-2-Clause": ("Licensed under the BSD 2-Clause License",),
    "MPL-2.0": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",),
    "CC-BY-4.0": ("Licensed under CC BY 4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    "CC-BY-SA-4.0": ("Licensed under CC BY-SA 4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    "CC-BY-NC-4.0": ("Licensed under CC BY-NC 4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    "CC0-1.0": ("To the extent possible under law, the author has waived all copyright and related rights to this work, CC0 1.0",),
    "ISC": ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",),
    "Unlicense": ("This is free and unencumbered software released into the public domain",),
}
#: Fixed value: a line with one of these words may be a notice.
NOTICE = r"(?i)(?:licen[cs]|copyright|permission|warrant|redistribut|public domain|creative commons|\bCC[ 0-])"
#: Fixed value: what the same words are as terms.
NOTICE_TERM = r"licen[cs]|copyright|permission|warrant|redistribut|domain|commons|^cc0?$"
#: Fixed value: names of licence files.
LICENCE_FILE = r"(?i)(?:^|/)(?:licen[cs]e|copying|unlicense|notice)[^/]*$"
_SIZES = 1 << 16  # more than any template has terms
LEAST = 0.6  # cosine from which a line is a template's notice
FILE_SHARE = 0.5  # share of a file's words in notices that makes it a licence file


def terms(text: Column) -> Column:
    """Words and numbers in lower case."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}]+(?:\.[0-9]+)*"), F.lit(0))


def _weights(words: DataFrame, idf: DataFrame, rarest: float) -> DataFrame:
    """Sparse unit vectors of (item, term): TF-IDF weights, each divided by its item's length.
    Terms of no line have the weight of the rarest."""
    counts = words.groupBy("item", "term").agg(F.count(F.lit(1)).alias("n"))
    weighed = counts.join(idf, "term", "left").withColumn(
        "w", (1 + F.log(F.col("n").cast("double"))) * F.coalesce("idf", F.lit(rarest))
    )
    norms = weighed.groupBy(F.col("item").alias("_item")).agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    return weighed.join(norms, F.col("item") == F.col("_item")).select("item", "term", (F.col("w") / F.col("norm")).alias("w"))


def _templates(spark: SparkSession) -> DataFrame:
    rows = [(f"{name}#{k}", name, text) for name, texts in TEMPLATES.items() for k, text in enumerate(texts)]
    return spark.createDataFrame(rows, "item string, license string, text string")


def _whole_templates(spark: SparkSession) -> DataFrame:
    """All notices of a licence as one, where it has several."""
    rows = [(f"{name}#all", name, " ".join(texts)) for name, texts in TEMPLATES.items() if len(texts) > 1]
    return spark.createDataFrame(rows, "item string, license string, text string")


def passages(files: DataFrame) -> DataFrame:
    """What may be a notice in the texts of (_row, path, text), line breaks or not: windows of
    each template's number of terms around a notice word, and for licence files all terms.
    (_row, start, size, line), line being the terms with blanks between.

    Windows start at every eighth of their size, so that one is off a notice by a sixteenth at most.
    """
    lengths = _templates(files.sparkSession).select(F.size(terms(F.col("text"))).alias("n")).distinct()
    sizes = F.array(*[F.lit(r["n"]) for r in lengths.collect()])  # a fixed list
    named = F.coalesce(F.col("path").rlike(LICENCE_FILE), F.lit(False))
    split = files.select("_row", named.alias("_named"), terms(F.col("text")).alias("_terms"))
    split = split.select("*", F.filter(F.transform("_terms", lambda t, k: F.when(t.rlike(NOTICE_TERM), k)), lambda k: k.isNotNull()).alias("_at"))

    def starts(at: Column, size: Column) -> Column:
        """Multiples of the step around a notice word, and the text's last window, each with its size in one number."""
        step = F.ceil(size / 8)
        first = F.greatest(F.lit(0), at - size + 1)
        last = F.least(at, F.greatest(F.lit(0), F.size("_terms") - size))
        begin = F.ceil(first / step) * step
        found = F.concat(F.array(last), F.when(begin <= last, F.sequence(begin, last, step)).otherwise(F.array(first)))
        return F.transform(found, lambda start: start.cast("bigint") * _SIZES + size)

    # told apart inside the row, so that no text is carried into a shuffle
    windows = F.array_distinct(F.flatten(F.transform("_at", lambda at: F.flatten(F.transform(sizes, lambda size: starts(at, size))))))
    whole = F.when(F.col("_named") & (F.size("_terms") > 0), F.array(F.lit(-1).cast("bigint"))).otherwise(F.array().cast("array<bigint>"))

    def passage(code: Column) -> Column:
        start = F.when(code < 0, F.lit(0).cast("bigint")).otherwise(F.floor(code / _SIZES))
        cut = F.slice("_terms", (start + 1).cast("int"), F.when(code < 0, F.size("_terms")).otherwise((code % _SIZES).cast("int")))
        return F.struct(start.alias("start"), F.size(cut).alias("size"), F.array_join(cut, " ").alias("line"))

    return split.select("_row", F.inline(F.transform(F.concat(windows, whole), passage)))


def notices(files: DataFrame, least: float = LEAST, more: DataFrame | None = None) -> DataFrame:
    """Best template of each distinct notice line in (row, text), and of each line in ``more``:
    (line, license, score).

    Lines are compared once however often they occur. The weight of a term falls with the
    number of distinct notice lines that have it, over the whole table and the templates.
    """
    spark = files.sparkSession
    lines = stored(files.select(F.explode(F.split("text", "\n")).alias("line")).where(F.col("line").rlike(NOTICE)).distinct())
    every = lines.withColumn("own", F.lit(True))
    if more is not None:
        extra = more.select("line").distinct().join(lines, "line", "left_anti")
        every = every.unionByName(extra.withColumn("own", F.lit(False)))
    # a number stands for its line, so that no text is carried along with each of its terms
    every = stored(every.withColumn("item", F.monotonically_increasing_id()))
    words = every.select("item", "own", F.explode(terms(F.col("line"))).alias("term"))
    models = _templates(spark)
    model_words = models.select("item", F.explode(terms(F.col("text"))).alias("term"))
    known = words.where("own").select("item", "term").distinct().select("term").unionByName(model_words.distinct().select("term"))
    total = lines.count() + models.count()
    idf = known.groupBy("term").agg(F.log(1 + F.lit(float(total)) / F.count(F.lit(1))).alias("idf"))
    idf, rarest = stored(idf), math.log(1 + total)
    whole = _whole_templates(spark)
    model_words = model_words.unionByName(whole.select("item", F.explode(terms(F.col("text"))).alias("term")))
    models = models.unionByName(whole)
    theirs = _weights(model_words, idf, rarest).join(models.select("item", "license"), "item").select(
        F.col("term").alias("_term"), F.col("item").alias("_template"), "license", F.col("w").alias("_w")
    )
    # the templates are a fixed list of a few hundred terms
    met = _weights(words, idf, rarest).join(F.broadcast(theirs), F.col("term") == F.col("_term"))
    scores = met.groupBy("item", "_template", "license").agg(F.round(F.sum(F.col("w") * F.col("_w")), 9).alias("score"))
    best = scores.groupBy("item").agg(F.max(F.struct("score", "license")).alias("best"))
    return best.where(F.col("best.score") >= least).join(every, "item").select(
        "line", F.col("best.license").alias("license"), F.col("best.score").alias("score")
    )


def scanned(files: DataFrame, least: float = LEAST) -> DataFrame:
    """Licence of each file of (path, text): path, license, score, found and directory.

    ``found`` is header for files with a notice of their own, licence file for those that are
    named like one or consist of notices for a share of ``FILE_SHARE``, inherited where the
    nearest directory above has a licence file, else none. A file with several notices has
    the best one's licence; a directory with several licence files has that of the best score, then
    of the least name. Null and empty texts have no notice of their own; a null path is in no
    directory; repeated rows are scanned each; an empty table gives no rows; other columns
    are kept, but for clashing names.
    """
    others = [c for c in files.columns if c not in ("path", "text", "license", "score", "found", "directory")]
    with_notice = stored(
        files.select("path", "text", *others).where(F.col("text").rlike(NOTICE)).withColumn("_row", F.monotonically_increasing_id())
    )
    own_lines = with_notice.select("_row", F.explode(F.split("text", "\n")).alias("_line")).where(F.col("_line").rlike(NOTICE))
    own_passages = stored(passages(with_notice))
    known = stored(notices(with_notice, least, own_passages))
    of_lines = (
        own_lines.join(known, F.col("_line") == F.col("line"))
        .groupBy("_row")
        .agg(
            F.max(F.struct("score", "license")).alias("_best"),
            F.sum(F.size(terms(F.col("_line")))).alias("_notice_words"),
        )
    )
    covered = F.flatten(F.collect_set(F.sequence(F.col("start"), F.col("start") + F.col("size") - 1)))
    of_passages = (
        own_passages.join(known, "line")
        .groupBy("_row")
        .agg(F.max(F.struct("score", "license")).alias("_best"), F.size(F.array_distinct(covered)).cast("bigint").alias("_notice_words"))
    )
    hits = of_lines.unionByName(of_passages).groupBy("_row").agg(
        F.max("_best").alias("_best"), F.max("_notice_words").alias("_notice_words")
    )
    named = F.coalesce(F.col("path").rlike(LICENCE_FILE), F.lit(False))
    whole = F.size(terms(F.col("text")))
    own = (
        with_notice.join(hits, "_row", "left")
        .withColumn("_file", F.col("_best").isNotNull() & (named | (F.col("_notice_words") >= FILE_SHARE * whole)))
        .select("path", *others, "_best", "_file")
    )
    rest = files.where(~F.coalesce(F.col("text").rlike(NOTICE), F.lit(False))).select(
        "path", *others, F.lit(None).cast("struct<score: double, license: string>").alias("_best"), F.lit(False).alias("_file")
    )
    rows = stored(own.unionByName(rest).withColumn("_row", F.monotonically_increasing_id()))
    folder = F.regexp_replace("path", r"/?[^/]*$", "")
    folders = (
        rows.where("_file and path is not null")
        .groupBy(folder.alias("_folder"))
        .agg(F.max_by(F.struct(F.col("_best.license").alias("license"), F.col("_best.score").alias("score")),
                      F.struct(F.col("_best.score"), F.col("_best.license"))).alias("_given"))
    )
    # a file's directories, from its own up to the root; joined by directory, not by file
    parts = F.split(folder, "/")
    above = F.when(
        folder == "", F.array(F.lit(""))
    ).otherwise(F.concat(F.array(F.lit("")), F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, 1, n), "/"))))
    places = rows.where("path is not null").select(folder.alias("_own"), above.alias("_above")).distinct()
    nearest = (
        places.select("_own", F.posexplode("_above").alias("_level", "_dir"))
        .join(folders, F.col("_dir") == F.col("_folder"))
        .groupBy("_own")
        .agg(F.max(F.struct("_level", "_dir", "_given")).alias("_near"))
    )
    met = rows.withColumn("_at", folder).join(nearest, F.col("_at") == F.col("_own"), "left")
    has = F.col("_best").isNotNull()
    return met.select(
        "path", *others,
        F.when(has, F.col("_best.license")).otherwise(F.col("_near._given.license")).alias("license"),
        F.when(has, F.col("_best.score")).otherwise(F.col("_near._given.score")).alias("score"),
        F.when(F.col("_file"), "licence file").when(has, "header").when(F.col("_near").isNotNull(), "inherited").otherwise("none").alias("found"),
        F.when(~has, F.col("_near._dir")).alias("directory"),
    )
