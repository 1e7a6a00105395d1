"""Licence scans: TF-IDF cosine of lines and files to templates, inherited along directories."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from maskmetrics.functions.text import bind
from maskmetrics.operators.lookup import lookup_join, measure
from maskmetrics.session import settle

# Notices as they are usually written: (licence, text). Fixed values.
TEMPLATES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files, to deal in the Software without restriction."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0; you may not use this file except in compliance with the License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
                "Public License as published by the Free Software Foundation, either version 3 of the License, or any later version."),
    ("LGPL-3.0", "This library is licensed under the GNU Lesser General Public License, version 3."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
                     "that the following conditions are met."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
)
# A line, or a whole file, is a licence from these cosines on.
LINE_LEVEL = 0.7
FILE_LEVEL = 0.5
# Words of ordinary text; they are left out of templates and texts alike. Fixed values.
ORDINARY = ("the", "of", "and", "to", "a", "an", "in", "is", "it", "or", "this", "by", "with", "without", "at", "as", "for", "from",
            "on", "that", "are", "was", "you", "not", "any", "may", "can", "under", "be", "either", "all", "s")
SPLIT = "[^a-z0-9]+"


def _terms(text: str) -> list[str]:
    word, out = "", []
    for c in text.lower() + " ":
        if c.isascii() and c.isalnum():
            word += c
        elif word:
            out.append(word)
            word = ""
    return [w for w in out if w not in ORDINARY]


def template_weights(templates: Sequence[tuple[str, str]]) -> tuple[list[tuple[int, str, str, float]], dict[str, float], float]:
    """(template, licence, term, unit weight) rows, the idf of each term, and that of an unknown one.

    idf = ln((1 + templates) / (1 + templates with the term)) + 1; weights are counts times idf,
    scaled so that each template has length one.
    """
    counts = [Counter(_terms(text)) for _, text in templates]
    df = Counter(t for c in counts for t in c)
    idf = {t: math.log((1 + len(templates)) / (1 + n)) + 1 for t, n in df.items()}
    rows = []
    for i, (c, (licence, _)) in enumerate(zip(counts, templates)):
        length = math.sqrt(sum((n * idf[t]) ** 2 for t, n in c.items()))
        rows += [(i, licence, t, n * idf[t] / length) for t, n in sorted(c.items())]
    return rows, idf, math.log(1 + len(templates)) + 1


def _may_reach(words: Column, rows: Sequence[tuple[int, str, str, float]], level: float,
               idf: dict[str, float] | None = None, unknown: float = 0.0) -> Column:
    """True for every text whose cosine with some template is ``level`` or more, and few others.

    By Cauchy and Schwarz the cosine is at most the length of the template's terms that the
    text holds. With ``idf`` it is, more closely, at most that times the share of the text's own
    length which these terms make; each further word adds at least ``unknown`` to that length.
    """
    known = sorted({t for _, _, t, _ in rows})
    shared = F.array_intersect(words, F.array(*map(F.lit, known)))

    def reaches(held: Column) -> Column:
        share = F.lit(1.0)
        if idf is not None:
            times = {t: (F.size(words) - F.size(F.array_remove(words, t))) * idf[t] for t in known}
            own = sum((F.when(F.array_contains(held, t), times[t] * times[t]).otherwise(0.0) for t in known), F.lit(1e-9))
            rest = F.size(F.array_except(words, F.array(*map(F.lit, ["", *known, *ORDINARY])))) * (unknown * unknown)
            share = own / (own + rest)
        return bind(share, lambda part: reduce(Column.__or__, (
            sum((F.when(F.array_contains(held, t), w * w).otherwise(0.0) for i, _, t, w in rows if i == template), F.lit(1e-9))
            * part >= (level - 1e-6) ** 2 for template in sorted({r[0] for r in rows}))))

    return bind(shared, lambda held: F.when(F.size(held) > 0, reaches(held)).otherwise(False))


def scan(df: DataFrame, path: str = "path", text: str = "text", templates: Sequence[tuple[str, str]] = TEMPLATES,
         line_level: float = LINE_LEVEL, file_level: float = FILE_LEVEL) -> DataFrame:
    """(path, unit, licence, cosine): the best template of each text's lines and of the whole text.

    ``unit`` is "line" or "file"; only cosines at the level of the unit or above are returned,
    one row per path and unit: the highest, then the first template. Terms are runs of a to z
    and digits, lower-cased, but for ordinary words; every term counts in the length of a line, known or not. All lines
    of whole texts are compared. Rows with the same path count as one file. Null and empty
    texts have no lines; a null path is a path of its own.
    """
    spark = df.sparkSession
    weights, idf, unknown = template_weights(templates)
    ordinary = F.array(*map(F.lit, ("", *ORDINARY)))
    lowest = min(line_level, file_level)
    # As many rows as the fixed templates have terms.
    table = spark.createDataFrame(weights, "template int, licence string, term string, weight double")
    terms = spark.createDataFrame(sorted(idf.items()), "term string, idf double")
    body = F.lower(F.coalesce(F.col(text), F.lit("")))
    near = df.select(F.col(path).alias("path"), body.alias("body")).where(_may_reach(F.split("body", SPLIT), weights, lowest))
    near = settle(near, "licence-texts")
    units = near.select("path", F.posexplode(F.concat(F.array("body"), F.split("body", "\n"))).alias("place", "unit")) \
        .withColumn("words", F.filter(F.split("unit", SPLIT), lambda w: ~F.array_contains(ordinary, w))) \
        .where(_may_reach(F.col("words"), weights, lowest, idf, unknown)) \
        .select(F.coalesce("path", F.lit("")).alias("file"), F.col("path").isNull().alias("nameless"),
                F.when(F.col("place") == 0, "file").otherwise("line").alias("kind"), "words").distinct() \
        .withColumn("unit", F.xxhash64("file", "nameless", "kind", "words"))
    units = settle(units, "licence-units")
    spelled = units.select("unit", F.explode("words").alias("term")).groupBy("unit", "term").agg(F.count("*").alias("n"))
    valued = spelled.join(F.broadcast(terms), "term", "left").select(
        "unit", "term", (F.col("n") * F.coalesce("idf", F.lit(unknown))).alias("value"))
    lengths = valued.groupBy("unit").agg(F.sqrt(F.sum(F.col("value") * F.col("value"))).alias("length"))
    dots = valued.join(F.broadcast(table), "term").groupBy("unit", "template", "licence").agg(
        F.sum(F.col("value") * F.col("weight")).alias("dot"))
    cosines = dots.join(lengths, "unit").select("unit", "template", "licence", F.round(F.col("dot") / F.col("length"), 6).alias("cosine"))
    level = F.when(F.col("kind") == "file", file_level).otherwise(line_level)
    best = F.max_by(F.struct("licence", "cosine"), F.struct("cosine", -F.col("template")))
    found = units.drop("words").join(cosines, "unit").where(F.col("cosine") >= level) \
        .groupBy("file", "nameless", "kind").agg(best.alias("best"))
    return settle(found.select(F.when(~F.col("nameless"), F.col("file")).alias("path"), F.col("kind").alias("unit"),
                               F.col("best.licence").alias("licence"), F.col("best.cosine").alias("cosine")), "licences")


def _parent(path: str | Column) -> Column:
    """What stands before the last slash; the root, "", where there is none."""
    return F.regexp_replace(F.regexp_extract(path, "^(.*)/[^/]*$", 1), "/+$", "")


def _above(directory: str) -> Column:
    """A directory and all directories above it, the root last."""
    parts = F.split(directory, "/")
    chain = F.transform(F.sequence(F.size(parts), F.lit(1), F.lit(-1)), lambda n: F.array_join(F.slice(parts, 1, n), "/"))
    return F.array_distinct(F.concat(chain, F.array(F.lit(""))))


def with_licences(df: DataFrame, path: str = "path", text: str = "text", templates: Sequence[tuple[str, str]] = TEMPLATES,
                  line_level: float = LINE_LEVEL, file_level: float = FILE_LEVEL) -> DataFrame:
    """Add ``licence``, ``evidence``, ``cosine`` and ``licence_path`` to every row.

    ``evidence`` is "header" where a line of the text is a licence notice, else "file" where the
    whole text is one, else "inherited" where a directory above holds a licence file, the
    nearest one, else null. A directory's licence file is the text with the highest whole-text
    cosine directly in it, then the first path. Rows keep their other columns; columns of
    these names are replaced. A row with a null path inherits nothing.

    Only texts that hold enough of a template's terms are taken apart. Directories are resolved once each, by
    a join of their ancestors with the directories that hold a licence file; rows then look up
    their directory, broadcast below a checked size, salted beyond, so a directory with a third
    of all files is shared out.
    """
    new = ("licence", "evidence", "cosine", "licence_path")
    found = scan(df, path, text, templates, line_level, file_level)
    files = found.where((F.col("unit") == "file") & F.col("path").isNotNull())
    holders = settle(files.groupBy(_parent("path").alias("directory")).agg(F.min_by(
        F.struct("licence", "cosine", F.col("path").alias("licence_path")), F.struct(-F.col("cosine"), "path")).alias("up")), "holders")
    rows = df.select(F.struct(*(c for c in df.columns if c not in new)).alias("row"), F.col(path).alias("path"))
    rows = rows.withColumn("directory", _parent("path"))
    wanted = rows.where("path is not null").select("directory").distinct()
    chain = wanted.select("directory", F.posexplode(_above("directory")).alias("steps", "above"))
    met = lookup_join(chain, holders.withColumnRenamed("directory", "above"), ["above"], F.struct("directory", "steps"),
                      measure(holders, "directory"), "inner")
    nearest = settle(met.groupBy("directory").agg(F.min_by("up", "steps").alias("up")), "nearest")
    own = settle(found.where("path is not null").groupBy("path").agg(F.min_by(
        F.struct("licence", F.when(F.col("unit") == "line", "header").otherwise("file").alias("evidence"), "cosine"),
        F.when(F.col("unit") == "line", 0).otherwise(1)).alias("own")), "own")
    joined = lookup_join(rows, own, ["path"], F.col("path"), measure(own, "path"))
    joined = lookup_join(joined, nearest, ["directory"], F.col("path"), measure(nearest, "directory"))
    pick = F.when(F.col("own").isNotNull(), F.struct("own.licence", "own.evidence", "own.cosine", F.col("path").alias("licence_path"))) \
        .when(F.col("up").isNotNull(), F.struct("up.licence", F.lit("inherited").alias("evidence"), "up.cosine", "up.licence_path"))
    nameless = [(r["licence"], r["unit"], r["cosine"]) for r in found.where("path is null").orderBy(F.desc("unit")).collect()]
    out = joined.withColumn("pick", pick)
    if nameless:
        licence, unit, cosine = nameless[0]
        out = out.withColumn("pick", F.when(F.col("path").isNull(), F.struct(
            F.lit(licence).alias("licence"), F.lit("header" if unit == "line" else "file").alias("evidence"),
            F.lit(cosine).alias("cosine"), F.lit(None).cast("string").alias("licence_path"))).otherwise(F.col("pick")))
    return out.select("row.*", *(F.col(f"pick.{c}").alias(c) for c in new))


def oracle(paths: str, templates: Sequence[tuple[str, str]] = TEMPLATES, line_level: float = LINE_LEVEL,
           file_level: float = FILE_LEVEL) -> str:
    """SQL for the rows of ``with_licences`` over a query ``paths`` that gives doc_id, path, text."""
    values = ", ".join(f"({i}, '{licence}', '{text.replace(chr(39), chr(39) * 2)}')" for i, (licence, text) in enumerate(templates))
    n = len(templates)
    ordinary = ", ".join(f"'{w}'" for w in ORDINARY)
    return f"""
WITH files AS ({paths}),
templates(template, licence, text) AS (VALUES {values}),
tterms AS (SELECT template, licence, term, count(*) AS n FROM (
    SELECT template, licence, unnest(regexp_extract_all(lower(text), '[a-z0-9]+')) AS term FROM templates) WHERE term NOT IN ({ordinary}) GROUP BY ALL),
idf AS (SELECT term, ln((1.0 + {n}) / (1 + count(*))) + 1 AS idf FROM tterms GROUP BY term),
tweights AS (SELECT template, licence, term, n * idf / sqrt(sum((n * idf) ** 2) OVER (PARTITION BY template)) AS weight
             FROM tterms JOIN idf USING (term)),
units AS (
    SELECT path, 'file' AS kind, 0 AS place, lower(coalesce(text, '')) AS unit FROM files
    UNION ALL
    SELECT path, 'line', unnest(range(1, len(string_split(text, chr(10))) + 1)), unnest(string_split(lower(text), chr(10))) FROM files),
uterms AS (SELECT path, kind, place, term, count(*) AS n FROM (
    SELECT path, kind, place, unnest(regexp_extract_all(unit, '[a-z0-9]+')) AS term FROM units) WHERE term NOT IN ({ordinary}) GROUP BY ALL),
valued AS (SELECT u.*, n * coalesce(idf, ln(1.0 + {n}) + 1) AS value FROM uterms u LEFT JOIN idf USING (term)),
lengths AS (SELECT path, kind, place, sqrt(sum(value * value)) AS length FROM valued GROUP BY ALL),
dots AS (SELECT path, kind, place, template, licence, sum(value * weight) AS dot FROM valued JOIN tweights USING (term) GROUP BY ALL),
cosines AS (SELECT path, kind, template, licence, round(dot / length, 6) AS cosine FROM dots JOIN lengths USING (path, kind, place)),
found AS (SELECT * FROM cosines WHERE cosine >= CASE kind WHEN 'file' THEN {file_level} ELSE {line_level} END
          QUALIFY row_number() OVER (PARTITION BY path, kind ORDER BY cosine DESC, template) = 1),
holders AS (SELECT regexp_extract(path, '^(.*)/[^/]*$', 1) AS directory, licence, cosine, path AS licence_path
            FROM found WHERE kind = 'file'
            QUALIFY row_number() OVER (PARTITION BY directory ORDER BY cosine DESC, path) = 1),
own AS (SELECT path, licence, CASE kind WHEN 'line' THEN 'header' ELSE 'file' END AS evidence, cosine FROM found
        QUALIFY row_number() OVER (PARTITION BY path ORDER BY kind DESC) = 1),
up AS (SELECT f.doc_id, h.* FROM files f JOIN holders h
       ON starts_with(f.path, h.directory || '/') OR h.directory = ''
       QUALIFY row_number() OVER (PARTITION BY f.doc_id ORDER BY length(h.directory) DESC) = 1)
SELECT f.doc_id, f.path, coalesce(o.licence, u.licence) AS licence,
       CASE WHEN o.licence IS NOT NULL THEN o.evidence WHEN u.licence IS NOT NULL THEN 'inherited' END AS evidence,
       coalesce(o.cosine, u.cosine) AS cosine, CASE WHEN o.licence IS NOT NULL THEN f.path ELSE u.licence_path END AS licence_path
FROM files f LEFT JOIN own o USING (path) LEFT JOIN up u USING (doc_id)"""
