"""License scan: MinHash bands retrieve templates for text windows, exact containment verifies.

Shingles are five consecutive lower-cased words (letters and digits). For a template of n words,
a text is looked at in windows of n + s - 1 words that start every s = max(1, n / 4) words, so any
run of n words lies wholly in a window. If such a window holds 0.8 of the template's shingles, its
Jaccard similarity to the template is at least 0.5, and 28 bands of 2 values miss it with
probability (1 - 0.25)^28 = 3e-4 at most; a window that holds the whole template (0.66 and more)
with 1e-7.

Two sets can only agree on a MinHash value if they share the shingle that has it. So windows
without any shingle of a template are left out before anything is hashed, which changes no result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hydrolens.llm.common import lower_ascii, small, table, words
from hydrolens.sources.folders import RunFolder

TERM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
SHINGLE = 5
BANDS, BAND_ROWS = 28, 2
LEAST = 0.8
# Template shingles that are held against each text as a constant; more of them are joined only.
CONSTANT_SHINGLES = 20_000

# Usual public license notices. Versions and sister licenses differ in a word or two, so
# their templates are cut close around what tells them apart: no text of one holds LEAST of another's
# shingles. Sentences that several licenses share have the family's name.
TEMPLATES = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("Apache-2.0", "you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("GPL-1.0", "under the GNU General Public License, version 1"),
    ("GPL-1.0", "GNU GENERAL PUBLIC LICENSE Version 1, February 1989"),
    ("GPL-1.0", "published by the Free Software Foundation; either version 1, or (at your option)"),
    ("GPL-2.0", "under the GNU General Public License, version 2"),
    ("GPL-2.0", "under the GNU General Public License v2"),
    ("GPL-2.0", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991"),
    ("GPL-2.0", "terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License"),
    ("GPL-2.0", "terms of the GNU General Public License as published by the Free Software Foundation; version 2 of the License"),
    ("GPL-2.0", "terms of the GNU General Public License version 2 as published by the Free Software Foundation"),
    ("GPL-3.0", "under the GNU General Public License, version 3"),
    ("GPL-3.0", "under the GNU General Public License v3"),
    ("GPL-3.0", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June"),
    ("GPL-3.0", "terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License"),
    ("LGPL-2.0", "GNU Library General Public License, version 2"),
    ("LGPL-2.0", "terms of the GNU Library General Public License as published by the Free Software Foundation; either version 2 of the License"),
    ("LGPL-2.1", "licensed under the GNU Lesser General Public License, version 2.1"),
    ("LGPL-2.1", "under the GNU Lesser General Public License v2.1"),
    ("LGPL-2.1", "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999"),
    ("LGPL-2.1", "terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License"),
    ("LGPL-3.0", "the GNU Lesser General Public License, version 3"),
    ("LGPL-3.0", "under the GNU Lesser General Public License v3"),
    ("LGPL-3.0", "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June"),
    ("LGPL-3.0", "terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License"),
    ("AGPL-3.0", "licensed under the GNU Affero General Public License, version 3"),
    ("AGPL-3.0", "under the GNU Affero General Public License v3"),
    ("AGPL-3.0", "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November"),
    ("AGPL-3.0", "terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License"),
    ("MPL-1.1", "Mozilla Public License Version 1.1"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("BSD-2-Clause", "materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY"),
    ("BSD-3-Clause", "materials provided with the distribution. 3. Neither the name of"),
    ("BSD-3-Clause", "materials provided with the distribution. Neither the name of"),
    ("BSD-3-Clause", "materials provided with the distribution. 3. The name of the author may not be used"),
    ("BSD-4-Clause", "All advertising materials mentioning features or use of this software must display the following acknowledgement"),
    ("ISC or 0BSD", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("ISC", "fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies"),
    ("0BSD", "fee is hereby granted. THE SOFTWARE IS PROVIDED AS IS"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "licensed under a Creative Commons Attribution 4.0 International License"),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("CC-BY-NC-SA-4.0", "Licensed under CC BY-NC-SA 4.0."),
    ("CC-BY-NC-SA-4.0", "licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License"),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
]


def shingle_hashes(text: Column) -> Column:
    """Hash of the shingle at each word position; a text of fewer words has none."""
    term_list = words(lower_ascii(text), TERM)
    shingle = lambda w: F.transform(
        F.sequence(F.lit(0), F.size(w) - SHINGLE),
        lambda i: F.xxhash64(*[F.get(w, i + j) for j in range(SHINGLE)]),
    )
    # The words are bound to a name by a one-element array, so that they are cut only once.
    return F.flatten(
        F.transform(F.array(term_list), lambda w: F.when(F.size(w) >= SHINGLE, shingle(w)).otherwise(F.array().cast("array<bigint>")))
    )


def templates(spark: SparkSession, notices: list[tuple[str, str]] | None = None) -> DataFrame:
    """template, license, n (words), stride, reach (shingles of a window), shingles."""
    rows = [(i, name, text) for i, (name, text) in enumerate(notices or TEMPLATES)]
    frame = spark.createDataFrame(rows, "template int, license string, text string")
    listed = frame.select("template", "license", shingle_hashes(F.col("text")).alias("shingles"))
    n = F.size("shingles") + SHINGLE - 1
    return (
        listed.where(F.size("shingles") > 0)
        .withColumn("stride", F.greatest(F.lit(1), F.floor(n / 4)).cast("int"))
        .withColumn("reach", F.size("shingles") + F.col("stride") - 1)
        .withColumn("shingles", F.array_distinct("shingles"))
    )


def _signature() -> list[Column]:
    """The smallest value of the column `shingle` under each of the hash functions."""
    return [F.min(F.xxhash64("shingle", F.lit(k))).alias(f"m{k}") for k in range(BANDS * BAND_ROWS)]


def _banded(df: DataFrame, *keep: str) -> DataFrame:
    bands = [
        F.xxhash64(F.lit(b), *[F.col(f"m{b * BAND_ROWS + r}") for r in range(BAND_ROWS)]) for b in range(BANDS)
    ]
    return df.select(*keep, F.explode(F.array(*bands)).alias("band"))


def scan(docs: DataFrame, notices: DataFrame, run: RunFolder, least: float = LEAST) -> DataFrame:
    """doc_id, license, n_windows (windows that hold enough of one of its templates), containment (the
    largest part of a template's shingles in a window) and first_word (start of the earliest window that
    holds most), per row and license found.

    Null, empty and very short texts have no shingles and no license. Rows with the same or no
    doc_id are scanned each for itself. Empty tables give an empty result. Other columns are not
    read."""
    notices = run.keep(notices, "templates")
    listed = notices.select("template", F.explode("shingles").alias("shingle"))
    marked = docs.select(
        F.monotonically_increasing_id().alias("row"), "doc_id", shingle_hashes(F.col("text").cast("string")).alias("at")
    )
    if 0 < (size := listed.count()) <= CONSTANT_SHINGLES:
        known = [r.shingle for r in listed.select("shingle").distinct().collect()]
        marked = marked.where(F.arrays_overlap("at", F.lit(known)))
    marked = run.keep(marked, "marked")
    hits = marked.select("row", F.posexplode("at").alias("pos", "shingle")).join(small(listed, 50_000), "shingle")
    hits = hits.join(small(notices.select("template", "stride", "reach")), "template")
    windows = run.keep(
        hits.select(
            "row", "template", "reach",
            F.explode(
                F.sequence(
                    F.greatest(F.lit(0), F.ceil((F.col("pos") - F.col("reach") + 1) / F.col("stride")).cast("int")),
                    F.floor(F.col("pos") / F.col("stride")).cast("int"),
                )
            ).alias("number"),
            "stride",
        )
        .select("row", "template", "reach", (F.col("number") * F.col("stride")).alias("start"))
        .distinct(),
        "windows",
    )
    # Templates of one length share their windows.
    spans = windows.select("row", "start", "reach").distinct().join(marked.select("row", "at"), "row")
    held = run.keep(
        spans.select("row", "start", "reach", F.array_distinct(F.slice("at", F.col("start") + 1, "reach")).alias("held")),
        "held",
    )
    signed = held.select("row", "start", "reach", F.explode("held").alias("shingle")).groupBy("row", "start", "reach").agg(*_signature())
    asked = listed.groupBy("template").agg(*_signature())
    asked = _banded(asked, "template").join(notices.select("template", "reach"), "template")
    candidates = (
        _banded(signed, "row", "start", "reach").join(small(run.keep(asked, "asked")), ["reach", "band"])
        .select("row", "start", "reach", "template").distinct()
    )
    full = small(notices.select("template", "license", "shingles"))
    part = F.size(F.array_intersect("shingles", "held")) / F.size("shingles")
    verified = (
        candidates.join(held, ["row", "start", "reach"]).join(full, "template")
        .select("row", "license", "start", part.alias("containment")).where(F.col("containment") >= least)
    )
    best = verified.groupBy("row", "license").agg(
        F.count_distinct("start").alias("n_windows"),
        F.max("containment").alias("containment"),
        F.min(F.struct(-F.col("containment"), "start")).alias("best"),
    )
    return best.join(marked.select("row", "doc_id"), "row").select(
        "doc_id", "license", "n_windows", "containment", F.col("best.start").alias("first_word")
    )


def document_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"), templates(spark), RunFolder(spark))


def _licenses_sql() -> str:
    def term_list(text: str) -> str:
        return (
            f"regexp_extract_all(translate(coalesce({text}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
            rf"'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
        )

    rows = ", ".join(f"({i}, '{name}', '{text}')" for i, (name, text) in enumerate(TEMPLATES))
    return f"""
with notice_words as (
  select template, license, {term_list('text')} as w from (values {rows}) t(template, license, text)
), notice as (
  select *, greatest(1, len(w) // 4) as stride, len(w) - 4 + greatest(1, len(w) // 4) - 1 as reach
  from notice_words where len(w) >= 5
), notice_shingles as (
  select distinct template, array_to_string(w[s : s + 4], ' ') as shingle
  from (select template, w, unnest(range(1, len(w) - 3)) as s from notice)
), sizes as (
  select template, count(*) as n from notice_shingles group by template
), doc as (
  select doc_id, row_number() over () as d, {term_list('text')} as w from documents
), doc_shingles as (
  select d, s - 1 as p, array_to_string(w[s : s + 4], ' ') as shingle
  from (select d, w, unnest(range(1, len(w) - 3)) as s from doc where len(w) >= 5)
), hit as (
  select d, p, template, license, stride, reach, shingle
  from doc_shingles join notice_shingles using (shingle) join notice using (template)
), placed as (
  select d, template, license, shingle, number * stride as start
  from (select *, unnest(range(cast(greatest(0, ceil((p - reach + 1) / stride)) as bigint), cast(floor(p / stride) as bigint) + 1)) as number from hit)
), held as (
  select d, template, license, start, count(distinct shingle) as n_held from placed group by all
), good as (
  select d, license, start, n_held / n as containment from held join sizes using (template) where n_held / n >= {LEAST}
)
select doc_id, license, count(distinct start) as n_windows, max(containment) as containment,
  min(start) filter (containment = best) as first_word
from (select *, max(containment) over (partition by d, license) as best from good) join doc using (d)
group by d, doc_id, license
"""


LICENSES_SQL = _licenses_sql()
