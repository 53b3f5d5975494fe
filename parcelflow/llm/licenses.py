"""Licence scans: TF-IDF cosine of headers to licence templates, then inheritance from the nearest directory.

DataFrame functions only. The weights come from all documents; there is one per template word, so they fit in
the plan, and each text is then matched in one pass without a shuffle. Weights are whole numbers, so sums are exact.
"""

from __future__ import annotations

import math
import re
from collections import Counter

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Identifiers and customary notices of public licences.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("MIT", "Released under the MIT License"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2"),
    ("LGPL-3.0", "This library is licensed under the GNU Lesser General Public License, version 3"),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3"),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted"),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0"),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0"),
)
#: A header is a line with one of these words.
ANCHOR = r"(?i)\b(licen[sc]e|licen[sc]ed|licensing|copyright|spdx|redistribution|permission)\b"
THRESHOLD = 0.6
#: A licence file: matched headers hold at least this share of its words.
FILE_PERCENT = 50

_NO_WORD = "[^a-z0-9]+"


def _words(text: str) -> list[str]:
    return [w for w in re.split(_NO_WORD, text.lower()) if w]


VOCABULARY = sorted({w for _, text in TEMPLATES for w in _words(text)})


def weights(docs: DataFrame, text: str = "text") -> dict[str, int]:
    """Whole-numbered inverse document frequency of each template word over all documents; '' is that of other words."""
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    vocabulary = F.array(*map(F.lit, VOCABULARY))
    # One row with one count per template word: no grouping, and bounded by the templates.
    found = docs.select(F.array_intersect(F.split(F.lower(body), _NO_WORD), vocabulary).alias("w"))
    counts = found.select(F.explode("w").alias("w")).groupBy("w").count().collect()
    total = docs.count()
    seen = {r["w"]: r["count"] for r in counts}

    def weight(n: int) -> int:
        return 100 + math.floor(100 * math.log((total + 1) / (n + 1)) + 0.5)

    return {w: weight(seen.get(w, 0)) for w in VOCABULARY} | {"": weight(0)}


def _scores(line: Column, found: dict[str, int]) -> Column:
    """Best (cosine, licence, words) of a header against all templates."""
    words = F.filter(F.split(F.lower(line), _NO_WORD), lambda x: x != "")
    square = [found[w] ** 2 for w in VOCABULARY]
    vocabulary, squares = F.array(*map(F.lit, VOCABULARY)), F.array(*(F.lit(s).cast("long") for s in square))

    def total(values: Column) -> Column:
        return F.aggregate(values, F.lit(0).cast("long"), lambda a, x: a + x)

    def best(x: Column) -> Column:
        counts, n = x.counts, x.n
        norm = total(F.zip_with(counts, squares, lambda c, s: c * c * s)) + (n - total(counts)) * F.lit(found[""] ** 2).cast("long")
        options = []
        for name, text in TEMPLATES:
            own = Counter(_words(text))
            times = F.array(*(F.lit(own[w] * s).cast("long") for w, s in zip(VOCABULARY, square, strict=True)))
            size = sum(own[w] ** 2 * s for w, s in zip(VOCABULARY, square, strict=True))
            dot = total(F.zip_with(counts, times, lambda c, t: c * t))
            cosine = dot.cast("double") / (F.sqrt(norm.cast("double")) * F.lit(math.sqrt(size)))
            options.append(F.struct(cosine.alias("cosine"), F.lit(name).alias("license"), n.alias("words")))
        return F.array_max(F.array(*options))

    counted = F.transform(
        F.array(words),
        lambda w: F.struct(
            F.size(w).cast("long").alias("n"),
            F.transform(vocabulary, lambda v: F.size(F.filter(w, lambda x: x == v)).cast("long")).alias("counts"),
        ),
    )
    return F.transform(counted, best)[0]


def headers(docs: DataFrame, found: dict[str, int], text: str = "text") -> DataFrame:
    """Add own_license, own_cosine and is_file; a text's licence is that of its best header at or over THRESHOLD."""
    lines = F.filter(F.split(F.col(text).cast("string"), "\n"), lambda line: F.regexp_like(line, F.lit(ANCHOR)))
    matched = F.filter(F.transform(lines, lambda line: _scores(line, found)), lambda m: m.cosine >= THRESHOLD)
    marked = docs.withColumn("_m", F.when(F.regexp_like(F.col(text).cast("string"), F.lit(ANCHOR)), matched))
    size = F.size(F.filter(F.split(F.lower(F.col(text).cast("string")), _NO_WORD), lambda x: x != ""))
    best = F.array_max("_m")
    inside = F.aggregate(F.col("_m"), F.lit(0).cast("long"), lambda a, m: a + m.words)
    return marked.select(
        *[c for c in docs.columns if c != text],
        best.license.alias("own_license"),
        best.cosine.alias("own_cosine"),
        F.when(best.license.isNotNull(), inside * 100 >= size * FILE_PERCENT).otherwise(False).alias("is_file"),
    )


def inherit(files: DataFrame) -> DataFrame:
    """Licence of each file of (path, own_license, is_file): its own, else that of the nearest directory above it.

    A directory's licence is that of its licence files, the first by path where they differ. Directories are
    resolved once each, however many files they hold. A null path has no directory and inherits nothing.
    """
    folder = F.when(F.instr("path", "/") > 0, F.regexp_replace("path", "/[^/]*$", ""))
    placed = files.withColumn("_folder", folder)
    known = placed.where("is_file and _folder is not null").groupBy("_folder").agg(F.min_by("own_license", F.struct("path", "own_license")).alias("_above"))
    parts = F.split("_folder", "/")
    up = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda k: F.struct(k.alias("depth"), F.array_join(F.slice(parts, F.lit(1), k), "/").alias("at")))
    folders = placed.where("_folder is not null").select("_folder").distinct().select("_folder", F.explode(up).alias("_up"))
    nearest = (
        folders.join(known.select(F.col("_folder").alias("_at"), "_above"), F.col("_up.at") == F.col("_at"))
        .groupBy("_folder")
        .agg(F.max(F.struct("_up.depth", "_at", "_above")).alias("_near"))
    )
    joined = placed.join(nearest, "_folder", "left")
    own = F.col("own_license").isNotNull()
    return joined.select(
        *files.columns,
        F.coalesce("own_license", "_near._above").alias("license"),
        F.when(own, "own").when(F.col("_near").isNotNull(), "inherited").alias("origin"),
        F.when(~own, F.col("_near._at")).alias("inherited_from"),
    )


def scan(docs: DataFrame) -> DataFrame:
    """Licences of files given as (doc_id, path, text).

    Null or empty texts have no licence of their own. Repeated rows are files of their own; an empty table
    gives no rows; other columns are ignored.
    """
    found = weights(docs)
    return inherit(headers(docs.select("doc_id", "path", "text"), found))


def op4_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as files ``source/lang/doc_id``."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    return scan(docs.select("doc_id", F.concat_ws("/", "source", "lang", F.col("doc_id").cast("string")).alias("path"), "text"))


def _sql() -> str:
    rows = ", ".join(f"({i}, '{name}', '{w}', {n})" for i, (name, text) in enumerate(TEMPLATES) for w, n in sorted(Counter(_words(text)).items()))
    return f"""
WITH template(t, license, w, n) AS (VALUES {rows}),
docs AS (SELECT doc_id, concat_ws('/', source, lang, CAST(doc_id AS VARCHAR)) AS path, coalesce(text, '') AS text FROM documents),
vocabulary AS (SELECT DISTINCT w FROM template),
seen AS (SELECT w, count(*) AS n FROM (SELECT DISTINCT doc_id, unnest(regexp_split_to_array(lower(text), '{_NO_WORD}')) AS w FROM docs) JOIN vocabulary USING (w) GROUP BY w),
total AS (SELECT count(*) AS n FROM docs),
weight AS (SELECT w, CAST(100 + floor(100 * ln((total.n + 1) / (coalesce(seen.n, 0) + 1)) + 0.5) AS BIGINT) AS x FROM vocabulary LEFT JOIN seen USING (w), total),
other AS (SELECT CAST(100 + floor(100 * ln((n + 1) / 1) + 0.5) AS BIGINT) AS x FROM total),
line AS (SELECT doc_id, k, lines[k] AS line FROM (SELECT doc_id, lines, unnest(range(1, len(lines) + 1)) AS k FROM (SELECT doc_id, string_split(text, chr(10)) AS lines FROM docs WHERE regexp_matches(text, '{ANCHOR}'))) WHERE regexp_matches(lines[k], '{ANCHOR}')),
word AS (SELECT doc_id, k, w, count(*) AS n FROM (SELECT doc_id, k, unnest(regexp_split_to_array(lower(line), '{_NO_WORD}')) AS w FROM line) WHERE w <> '' GROUP BY ALL),
norm AS (SELECT doc_id, k, CAST(sum(n) AS BIGINT) AS words, sum(CASE WHEN weight.x IS NULL THEN n * other.x * other.x ELSE n * n * weight.x * weight.x END) AS s FROM word LEFT JOIN weight USING (w), other GROUP BY ALL),
size AS (SELECT t, license, sum(n * n * x * x) AS s FROM template JOIN weight USING (w) GROUP BY ALL),
dot AS (SELECT doc_id, k, t, sum(word.n * template.n * x * x) AS s FROM word JOIN template USING (w) JOIN weight USING (w) GROUP BY ALL),
score AS (SELECT doc_id, k, license, CAST(dot.s AS DOUBLE) / (sqrt(CAST(norm.s AS DOUBLE)) * sqrt(CAST(size.s AS DOUBLE))) AS cosine, words FROM dot JOIN norm USING (doc_id, k) JOIN size USING (t)),
header AS (SELECT doc_id, k, max(struct_pack(cosine := cosine, license := license)) AS best, any_value(words) AS words FROM score WHERE cosine >= {THRESHOLD} GROUP BY ALL),
own AS (SELECT doc_id, max(best) AS best, sum(words) AS words FROM header GROUP BY ALL),
file AS (SELECT doc_id, path, best.license AS own_license, best.cosine AS own_cosine,
    coalesce(words * 100 >= {FILE_PERCENT} * len(list_filter(regexp_split_to_array(lower(text), '{_NO_WORD}'), lambda x: x <> '')), false) AS is_file,
    CASE WHEN contains(path, '/') THEN regexp_replace(path, '/[^/]*$', '') END AS folder FROM docs LEFT JOIN own USING (doc_id)),
known AS (SELECT folder, arg_min(own_license, struct_pack(p := path, l := own_license)) AS above FROM file WHERE is_file AND folder IS NOT NULL GROUP BY folder),
nearest AS (SELECT f.folder, arg_max(known.folder, len(known.folder)) AS near, arg_max(above, len(known.folder)) AS above
    FROM (SELECT DISTINCT folder FROM file) f JOIN known ON f.folder = known.folder OR starts_with(f.folder, known.folder || '/') GROUP BY ALL)
SELECT doc_id, path, own_license, own_cosine, is_file, coalesce(own_license, above) AS license,
    CASE WHEN own_license IS NOT NULL THEN 'own' WHEN near IS NOT NULL THEN 'inherited' END AS origin,
    CASE WHEN own_license IS NULL THEN near END AS inherited_from
FROM file LEFT JOIN nearest USING (folder)
"""


SQL = _sql()
