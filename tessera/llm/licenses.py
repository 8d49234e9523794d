"""License scan: MinHash bands over text windows, then exact containment.

Texts and templates become runs of lower-case tokens ``[a-z0-9]+`` and their
``K``-token shingles. A text is read in windows of ``WINDOW`` tokens every
``STRIDE`` tokens; a template in windows at every token (or as one window, if
it is no longer). Each window has ``BANDS`` MinHash values, one row to a band,
and a text window retrieves the templates with which it shares a band.

Band settings: a window holds any run of ``WINDOW - STRIDE + 1`` tokens whole,
so the shortest template (5 tokens, 3 shingles) meets a window of at most 10
shingles with a Jaccard similarity of 0.3 or more, which 32 bands find with
probability 1 - 0.7**32 > 0.99998; a verbatim part of a longer template
contains a window equal to a template window, which collides always.

A retrieved template matches when at least ``PERCENT`` percent of its distinct
shingles occur in the text. Notices of different licenses can share most of
their shingles, so of two matches that share any, what tells them apart decides:
a match goes if less than ``PERCENT`` percent of the shingles that it has and
its rival lacks occur, and a smaller part than of the rival's own (where one has
none of its own, half counts as found). A text with both notices has both sets
and keeps both. Windows without any template shingle can neither
collide nor match, so they are left out before hashing. All steps are
built-in functions; only template-sized data is broadcast.

Defined results: null and empty texts, and texts of fewer than ``K`` tokens,
match nothing; repeated rows match once each (as equal rows); rows without
doc_id keep a null id; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bind, cut_lineage, narrow, table

K, WINDOW, STRIDE, BANDS, PERCENT = 3, 12, 4, 32, 80

# fixed values: well-known public license statements and notices (license, statement)
TEMPLATES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
            "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0. Unless required by "
                   "applicable law or agreed to in writing, software distributed under the License is distributed on an "
                   "\"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
            "Public License as published by the Free Software Foundation"),
    ("LGPL", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
             "General Public License as published by the Free Software Foundation"),
    ("AGPL", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero "
             "General Public License as published by the Free Software Foundation"),
    ("LGPL", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser "
             "General Public License as published by the Free Software Foundation"),
    ("AGPL", "you can redistribute it and/or modify it under the terms of the GNU Affero General Public License"),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
            "the following conditions are met"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
)


def shingles(text: Column) -> Column:
    """64-bit hashes of the token shingles of a text, in order."""
    tokens = F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), "[^a-z0-9]+"), "")
    return bind(tokens, lambda t: F.when(F.size(t) < K, F.array().cast("array<bigint>")).otherwise(
        F.transform(F.sequence(F.lit(0), F.size(t) - K), lambda i: F.xxhash64(*[F.get(t, i + k) for k in range(K)]))))


def minhashes(window: Column) -> Column:
    """One value per band: the smallest of the window's shingles under that band's hash."""
    return F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)),
                       lambda j: F.array_min(F.transform(window, lambda x: F.xxhash64(x, j))))


def _windows(s: Column, stride: int) -> Column:
    """Windows of ``WINDOW`` tokens, as arrays of their shingles."""
    width = WINDOW - K + 1
    last = F.greatest(F.size(s) - (width if stride == 1 else 1), F.lit(0))
    return F.transform(F.sequence(F.lit(0), last, F.lit(stride)), lambda i: F.slice(s, i + 1, F.lit(width)))


def template_table(spark: SparkSession, templates=TEMPLATES) -> DataFrame:
    """template (number), license, shingles (distinct), n_shingles and windows."""
    t = spark.createDataFrame([(i, name, text) for i, (name, text) in enumerate(templates)], "template int, license string, text string")
    t = t.select("template", "license", shingles(F.col("text")).alias("s"))
    return cut_lineage(t.select("template", "license", F.array_distinct("s").alias("shingles"),
                                F.size(F.array_distinct("s")).alias("n_shingles"), _windows(F.col("s"), 1).alias("windows")).coalesce(1))


def rival_table(known: DataFrame) -> DataFrame:
    """Templates of different licenses that share shingles: template, rival, and
    the shingles that only the one (mine) or the other (its) has; template-sized."""
    a, b = known.alias("a"), known.alias("b")
    return a.join(b, (F.col("a.license") != F.col("b.license")) & F.arrays_overlap("a.shingles", "b.shingles")).select(
        F.col("a.template").alias("template"), F.col("b.template").alias("rival"),
        F.array_except("a.shingles", "b.shingles").alias("mine"), F.array_except("b.shingles", "a.shingles").alias("its"))


def beaten(matches: DataFrame, rivals: DataFrame) -> DataFrame:
    """The (id, template) of ``matches`` (id, template, own) that a rival in the same text explains better."""
    def found(which: str) -> tuple[Column, Column]:
        none = F.size(which) == 0
        return F.when(none, 1).otherwise(F.size(F.array_intersect("own", which))), F.when(none, 2).otherwise(F.size(which))

    (mine, n_mine), (its, n_its) = found("mine"), found("its")
    both = matches.join(F.broadcast(rivals), "template").join(
        matches.select("id", F.col("template").alias("rival")), ["id", "rival"])
    return both.where((mine * 100 < n_mine * PERCENT) & (mine * n_its < its * n_mine)).select("id", "template").distinct()


def scan_licenses(docs: DataFrame, templates=TEMPLATES, percent: int = PERCENT) -> DataFrame:
    """Per match: doc_id, license, template, n_shingles (the template's), n_found."""
    spark = docs.sparkSession
    known = template_table(spark, templates)
    every = [r[0] for r in known.select(F.explode("shingles")).distinct().collect()]      # template-sized
    bands = known.select("template", F.explode("windows").alias("w")).select(
        "template", F.posexplode(minhashes(F.col("w"))).alias("band", "value")).distinct()

    d = narrow(docs, {"doc_id": "long", "text": "string"}).select(
        "doc_id", F.xxhash64("text").alias("row"), shingles(F.col("text")).alias("s"))
    hit = d.where(F.exists("s", lambda x: x.isin(every)))
    # the windows and what verifies them; of each text only the template shingles matter
    hit = cut_lineage(hit.select(
        "doc_id", "row", F.array_distinct(F.filter("s", lambda x: x.isin(every))).alias("own"),
        F.filter(_windows(F.col("s"), STRIDE), lambda w: F.exists(w, lambda x: x.isin(every))).alias("windows"))
        .withColumn("id", F.monotonically_increasing_id()))
    found = hit.select("id", F.explode("windows").alias("w")).select("id", F.posexplode(minhashes(F.col("w"))).alias("band", "value")) \
        .join(F.broadcast(bands), ["band", "value"]).select("id", "template").distinct()
    pair = found.join(hit.select("id", "doc_id", "own"), "id").join(
        F.broadcast(known.select("template", "license", "shingles", "n_shingles")), "template")
    pair = pair.withColumn("n_found", F.size(F.array_intersect("own", "shingles")))
    match = cut_lineage(pair.where(F.col("n_found") * 100 >= F.col("n_shingles") * percent).drop("shingles"))
    return match.join(beaten(match.select("id", "template", "own"), rival_table(known)), ["id", "template"], "left_anti").select(
        "doc_id", "license", "template", F.col("n_shingles").cast("long").alias("n_shingles"), F.col("n_found").cast("long").alias("n_found"))


# query --------------------------------------------------------------------
def op4_license_scan(spark, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents"))


def _sql() -> str:
    rows = ", ".join(f"({i}, '{name}', '{text.replace(chr(39), chr(39) * 2)}')" for i, (name, text) in enumerate(TEMPLATES))
    cut = "regexp_extract_all(lower(coalesce({0}, '')), '[a-z0-9]+')"
    grams = f"unnest(list_transform(range(1, len(t) - {K} + 2), lambda i: array_to_string(t[i:i + {K - 1}], ' ')))"
    return f"""
WITH tpl(template, license, text) AS (VALUES {rows}),
a AS (SELECT DISTINCT template, license, {grams} AS g FROM (SELECT template, license, {cut.format('text')} AS t FROM tpl)),
n AS (SELECT template, license, count(*) AS n FROM a GROUP BY ALL),
d AS (SELECT DISTINCT doc_id, {grams} AS g FROM (SELECT doc_id, {cut.format('text')} AS t FROM documents)),
m AS (SELECT doc_id, license, template, n, count(*) AS f FROM d JOIN a USING (g) JOIN n USING (template, license)
      GROUP BY ALL HAVING count(*) * 100 >= n * {PERCENT}),
own AS (SELECT a.template, r.template AS rival, a.g FROM a, n r WHERE a.license <> r.license
          AND EXISTS (SELECT 1 FROM a x JOIN a y USING (g) WHERE x.template = a.template AND y.template = r.template)
          AND NOT EXISTS (SELECT 1 FROM a y WHERE y.template = r.template AND y.g = a.g)),
share AS (SELECT x.doc_id, x.template, y.template AS rival, CASE WHEN count(own.g) = 0 THEN 0.5::DOUBLE
            ELSE count(d.g)::DOUBLE / count(own.g) END AS part, count(own.g) AS size
          FROM m x JOIN m y ON x.doc_id = y.doc_id AND x.license <> y.license
            LEFT JOIN own ON own.template = x.template AND own.rival = y.template
            LEFT JOIN d ON d.doc_id = x.doc_id AND d.g = own.g GROUP BY ALL),
lost AS (SELECT DISTINCT s.doc_id, s.template FROM share s JOIN share o
           ON s.doc_id = o.doc_id AND s.template = o.rival AND s.rival = o.template
         WHERE s.size + o.size > 0 AND s.part < {PERCENT / 100} AND s.part < o.part)
SELECT doc_id, license, template::INT AS template, n::BIGINT AS n_shingles, f::BIGINT AS n_found
FROM m ANTI JOIN lost USING (doc_id, template)"""


OP4_SQL = _sql()
