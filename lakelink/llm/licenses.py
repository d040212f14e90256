"""Licence scans in DataFrame functions only.

Segments that speak of a licence (lines of a file that hold a cue word, blocks of adjacent lines around one, without comment markers, as
notices are wrapped; all of a licence file) become sparse TF-IDF vectors
and are compared by cosine with template notices. Weights use the templates' document frequencies:
idf = ln((1 + n) / (1 + df)) + 1, and words in no template count with df = 0 in a segment's length. A file's own licence is that of
its best segment, if the cosine reaches `threshold`. Any other file inherits from the nearest directory above it, its own
first, that holds a licence file with a licence; a path join over distinct directories finds it.

Rows: null text is empty, a null path lies in no directory and inherits nothing; several licence files in a directory: the highest cosine,
then the smallest licence name; ties between templates likewise; repeated rows are kept; clashing extra columns are not read.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed template notices (name, text): public licence notices.
TEMPLATES = [
    ("MIT", "Released under the MIT License. Permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License, either version 3 of the License, or any later version."),
    ("GPL-2.0", "This program is free software; you can redistribute it under the terms of the GNU General Public License, version 2."),
    ("LGPL-2.1", "This library is free software; you can redistribute it under the terms of the GNU Lesser General Public License, version 2.1."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted. Neither the name of the copyright holder nor the names of its contributors may be used to endorse products."),
    ("BSD-2-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the conditions are met."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related rights to this work under CC0 1.0 Universal."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
]
#: Fixed cue pattern.
CUE = r"(?i)licen[sc]e|copyright|permission|redistribut|public domain|unencumbered"
MARKER = r"^[\x20\x09]*(?:/\*+!?|\*+/?|//+!?|#+!?|--+|;+|%+|<!--)?[\x20\x09]*|[\x20\x09\x0D]*(?:\*+/|-->)?[\x20\x09\x0D]*$"
#: A block has at most so many lines before and after its cue, and characters of the longest notice.
AROUND, ROOM = 12, 1.5
LICENSE_FILE = r"(?i)(^|/)(licen[sc]e|copying|unlicense)(\.(txt|md))?$"


def terms(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}.]+|\.+(?=\s|$)"), lambda w: w != "")


def cues(notices=None) -> str:
    """CUE, and the longest word of each notice in which it finds nothing."""
    words = {max(re.findall(r"\w+", x), key=lambda w: (len(w), w)) for _, x in notices or TEMPLATES if not re.search(CUE, x)}
    return "|".join([CUE, *sorted(map(re.escape, words))])


def blocks(text: Column, cue: str, room: int) -> Column:
    """array<string> of the blocks of two or more adjacent lines around each line with a cue, of at most room characters."""
    plain = F.transform(F.split(text, "\n"), lambda x: F.regexp_replace(x, MARKER, ""))

    def around(lines: Column, i: Column) -> Column:
        join = lambda a, b: F.array_join(F.slice(lines, a, b - a + 1), " ")
        starts = F.filter(F.sequence(F.greatest(i - AROUND, F.lit(1)), i), lambda a: F.length(join(a, i)) <= room)
        ends = F.filter(F.sequence(i, F.least(i + AROUND, F.size(lines))), lambda b: F.length(join(i, b)) <= room)
        return F.flatten(F.transform(starts, lambda a: F.transform(F.filter(ends, lambda b: (b > a) & (F.length(join(a, b)) <= room)), lambda b: F.trim(join(a, b)))))

    # one array in one variable: the lines are split once
    return F.flatten(F.flatten(F.transform(F.array(plain), lambda lines: F.transform(F.filter(F.sequence(F.lit(1), F.size(lines)), lambda i: F.get(lines, i - 1).rlike(cue)), lambda i: around(lines, i)))))


def templates(spark, notices=None) -> DataFrame:
    """(license, template, term, weight, idf): unit vectors of the notices. Bounded by the notices' words."""
    t = spark.createDataFrame([(i, n, x) for i, (n, x) in enumerate(notices or TEMPLATES)], "template int, license string, text string")
    n = len(notices or TEMPLATES)
    tf = t.select("template", "license", F.explode(terms(F.col("text"))).alias("term")).groupBy("template", "license", "term").agg(F.count("*").alias("tf"))
    df = tf.groupBy("term").agg(F.count("*").alias("df"))
    w = tf.join(F.broadcast(df), "term").withColumn("idf", F.log((1.0 + n) / (1.0 + F.col("df"))) + 1.0).withColumn("w", F.col("tf") * F.col("idf"))
    norm = w.groupBy("template").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    return w.join(F.broadcast(norm), "template").select("template", "license", "term", (F.col("w") / F.col("norm")).alias("w"), "idf")


def directory(path: Column) -> Column:
    return F.regexp_replace(path, "/?[^/]*$", "")


def scan(files: DataFrame, id_col: str = "file_id", path_col: str = "path", text_col: str = "text", *, threshold: float = 0.6, notices=None) -> DataFrame:
    """id, path, own_license, own_score (its best segment's cosine, 0 if none), license and license_from ('own', 'inherited' or null)."""
    spark = files.sparkSession
    f = files.select(F.col(id_col).alias("_i"), F.col(path_col).alias("_p"), F.coalesce(text_col, F.lit("")).alias("_t"))
    whole = F.coalesce(F.col("_p").rlike(LICENSE_FILE), F.lit(False))
    cue, room = cues(notices), int(ROOM * max(len(x) for _, x in notices or TEMPLATES))
    lines = F.filter(F.split("_t", "\n"), lambda x: x.rlike(cue))
    lines = F.when(F.col("_t").rlike(cue), F.concat(lines, blocks(F.col("_t"), cue, room))).otherwise(F.array().cast("array<string>"))
    segments = F.when(whole, F.concat(F.array("_t"), lines)).otherwise(lines)
    keyed = f.select("_i", "_p", F.explode(F.array_distinct(segments)).alias("_s")).withColumn("_x", F.sha2("_s", 256))
    # equal notices are compared once, however many files hold them; their digest stands for them in rows of terms
    distinct = keyed.select("_x", "_s").distinct()
    known = F.broadcast(templates(spark, notices))
    n = len(notices or TEMPLATES)
    tf = distinct.select("_x", F.explode(terms(F.col("_s"))).alias("term")).groupBy("_x", "term").agg(F.count("*").alias("tf"))
    idf = known.groupBy("term").agg(F.max("idf").alias("idf"))
    tf = tf.join(F.broadcast(idf), "term", "left").withColumn("w", F.col("tf") * F.coalesce("idf", F.lit(0.0) + F.log(F.lit(1.0 + n)) + 1.0))
    norm = tf.groupBy("_x").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    dots = tf.join(known.select("template", "license", "term", F.col("w").alias("tw")), "term").groupBy("_x", "template", "license").agg(F.sum(F.col("w") * F.col("tw")).alias("dot"))
    cosine = dots.join(norm, "_x").select("_x", "license", F.round(F.col("dot") / F.col("norm"), 9).alias("score"))
    best = cosine.groupBy("_x").agg(F.min(F.struct((-F.col("score")).alias("minus"), "license")).alias("b"))
    own = keyed.drop("_s").join(best, "_x").groupBy("_i", "_p").agg(F.min("b").alias("b"))
    own = own.select("_i", "_p", (-F.col("b.minus")).alias("own_score"), F.when(-F.col("b.minus") >= threshold, F.col("b.license")).alias("own_license"))
    # nearest ancestor: directories that hold licence files, joined with every distinct directory's ancestors
    holds = own.filter(F.col("_p").rlike(LICENSE_FILE) & F.col("own_license").isNotNull()).groupBy(directory(F.col("_p")).alias("above")).agg(F.min(F.struct((-F.col("own_score")).alias("m"), "own_license")).alias("h")).select("above", F.col("h.own_license").alias("inherited"))
    dirs = f.filter("_p is not null").select(directory(F.col("_p")).alias("dir")).distinct()
    parts = F.split("dir", "/")
    ladder = dirs.select("dir", F.explode(F.concat(F.array(F.lit("")), F.transform(F.sequence(F.lit(1), F.size(parts)), lambda k: F.array_join(F.slice(parts, F.lit(1), k), "/")))).alias("above"))
    nearest = ladder.distinct().join(holds, "above").groupBy("dir").agg(F.max(F.struct(F.length("above").alias("n"), "inherited")).alias("x")).select("dir", F.col("x.inherited").alias("inherited"))
    rows = files.select(F.col(id_col).alias("_i"), F.col(path_col).alias("_p"), directory(F.col(path_col)).alias("dir"))
    same = [rows["_i"].eqNullSafe(own["_i"]), rows["_p"].eqNullSafe(own["_p"])]
    out = rows.join(own, same, "left").select(rows["_i"].alias("_i"), rows["_p"].alias("_p"), "dir", "own_score", "own_license").join(nearest, "dir", "left")
    return out.select(
        F.col("_i").alias(id_col), F.col("_p").alias("path"), "own_license", F.coalesce("own_score", F.lit(0.0)).alias("own_score"),
        F.coalesce("own_license", "inherited").alias("license"), F.when(F.col("own_license").isNotNull(), "own").when(F.col("inherited").isNotNull(), "inherited").alias("license_from"),
    )
