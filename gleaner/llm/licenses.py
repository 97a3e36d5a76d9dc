"""Licence scan: sparse TF-IDF cosine to notice templates, then inheritance from
the nearest ancestor directory.

Every line of a file that holds a licence word is compared with every template,
and so is the whole text of a file that has such a line (a licence file is one
whose text as a whole is close to a template, or whose name says so).  Terms are
runs of ASCII letters and digits, lower-cased; a template's term weighs
(1 + ln tf) * idf, with idf over the templates; a term in none of them weighs the
largest idf, however often it occurs (so a long text needs only its distinct terms).

A file without a licence of its own takes that of the nearest directory above it
that holds a licence file: the distinct directories are expanded to their
ancestors and equi-joined with the directories of licence files, deepest first;
files then join their own directory.  Only DataFrame functions are used, and one
row per directory is on the other side of the join that sees all files, so a
directory with a third of all files can be split by Spark.

Defined cases: null or empty text has no licence of its own; a null path has no
directory and inherits nothing; equal scores go to the smaller name, equal
licence files of a directory to the higher score, then the smaller path; repeated
rows each get a row; an empty table gives an empty table; columns named like an
output are replaced.
"""

from __future__ import annotations

import json
import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleaner.llm.common import written

# Licence names and the sentences by which files usually refer to them.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License"),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license; licensed under the BSD 3-Clause License"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0"),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0"),
    ("CC0-1.0", "Dedicated to the public domain under CC0 1.0 Universal"),
    ("EPL-2.0", "Made available under the terms of the Eclipse Public License 2.0"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3"),
    ("MIT", "Released under the MIT License"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("Unlicense", "This is free and unencumbered software released into the public domain"),
)
_GNU = ("This program is free software: you can redistribute it and/or modify it under the terms of the GNU {} License as "
        "published by the Free Software Foundation, either version {} of the License, or (at your option) any later version.")
_CC = "This work is licensed under a Creative Commons {} 4.0 International License"
#: Usual headers, titles and terms beside the sentences above, which keep their own weights.
NOTICES = (
    ("AGPL-3.0", _GNU.format("Affero General Public", 3)),
    ("AGPL-3.0", "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance "
                   "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("Apache-2.0", "Apache License Version 2.0, January 2004"),
    ("BSD-2-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
                     "that the following conditions are met"),
    ("BSD-3-Clause", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
                     "products derived from this software without specific prior written permission"),
    ("CC-BY-4.0", _CC.format("Attribution")),
    ("CC-BY-NC-4.0", _CC.format("Attribution-NonCommercial")),
    ("CC-BY-SA-4.0", _CC.format("Attribution-ShareAlike")),
    ("CC0-1.0", "To the extent possible under law, the author has dedicated all copyright and related and neighboring rights to "
                "this software to the public domain worldwide"),
    ("EPL-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 "
                "which is available at https://www.eclipse.org/legal/epl-2.0"),
    ("GPL-2.0", _GNU.format("General Public", 2)),
    ("GPL-2.0", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991"),
    ("GPL-3.0", _GNU.format("General Public", 3)),
    ("GPL-3.0", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
            "granted, provided that the above copyright notice and this permission notice appear in all copies"),
    ("LGPL-2.1", _GNU.format("Lesser General Public", "2.1")),
    ("LGPL-3.0", _GNU.format("Lesser General Public", 3)),
    ("LGPL-3.0", "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the Software), to deal in the Software without restriction, including without limitation the "
            "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
            "persons to whom the Software is furnished to do so, subject to the following conditions"),
    ("MIT", "Use of this source code is governed by an MIT-style license that can be found in the LICENSE file"),
    ("MIT", "The MIT License (MIT)"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
                "distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0"),
    ("MPL-2.0", "Mozilla Public License Version 2.0"),
    ("Unlicense", "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code "
                  "form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means"),
)
#: Said in so many words: an SPDX tag names its licence; a reservation of all rights counts where no licence is named.
SPDX = r"(?i)SPDX-License-Identifier:[ \t]*\(?([A-Za-z0-9.+-]+(?:[ \t]+(?:OR|AND|WITH)[ \t]+[A-Za-z0-9.+-]+)*)"
RESERVED = r"(?i)\ball[^a-z0-9]+rights[^a-z0-9]+reserved\b"
ALL_RIGHTS = "All-Rights-Reserved"
#: Words that many texts hold; only the order in which the prefilter takes its terms depends on them.
PLAIN = frozenset("0 1 2 3 4 a above all an and any anyone are as at available be been by can code conditions copies copy either except file "
                  "deal following for form free general has if in into including is it later law made may means name not of on one only or other "
                  "out people person program provided public purpose so source specific subject such terms that the this to under "
                  "use used was which will whom with within without work world you your".split())
#: Terms of the prefilter that are everyday words (of English or German) and no notice alone.
WEAK = frozenset(("by", "do", "mit", "this", "under"))
#: A sentence may be wrapped over this many lines; a paragraph is compared as a whole as well.
WRAPPED = 4
LINE_SCORE = 0.7
FILE_SCORE = 0.35
FILE_NAME = r"(?i)^((un)?licen[cs]e|copying|notice)([._-].*)?$"
NONE = "unknown"


def _terms(text: str) -> list[str]:
    return re.findall("[a-z0-9]+", text.lower())


def template_vectors(templates=TEMPLATES) -> tuple[list[str], dict[str, list[float]], dict[str, float], float]:
    """(names in order, unit weights of every term by template, idf, idf of unknown terms)."""
    names = [n for n, _ in templates]
    docs = [_terms(t) for _, t in templates]
    df = {w: sum(w in d for d in docs) for d in docs for w in d}
    idf = {w: math.log((1 + len(docs)) / (1 + n)) + 1 for w, n in df.items()}
    rows = []
    for d in docs:
        w = {t: (1 + math.log(d.count(t))) * idf[t] for t in d}
        norm = math.sqrt(sum(x * x for x in w.values())) or 1.0
        rows.append({t: x / norm for t, x in w.items()})
    return names, {t: [r.get(t, 0.0) for r in rows] for t in df}, idf, math.log(1 + len(docs)) + 1


def mark_terms(templates=TEMPLATES, least: float = LINE_SCORE) -> list[str]:
    """Terms of which a text must hold one to come to ``least`` with any template:
    the long terms of each (plain words last), until the others weigh too little by themselves
    (a cosine is at most the length of the template's unit vector on shared terms)."""
    out = set()
    vectors = template_vectors(templates)[1]
    for i, (_, text) in enumerate(templates):
        left = 1.0
        for t in sorted(set(_terms(text)), key=lambda t: (t in PLAIN, -len(t), t)):
            if left < least * least - 1e-9:
                break
            out.add(t)
            left -= vectors[t][i] ** 2
    return sorted(out)


def notice_terms() -> list[str]:
    """The terms of which a unit must hold one to be compared."""
    return sorted((set(mark_terms(TEMPLATES)) | set(mark_terms(NOTICES))) - WEAK)


def may_be_notice(text: Column) -> Column:
    """Whether a text holds a term of ``mark_terms`` that says something by itself:
    what shares only WEAK terms with the templates is not compared."""
    return F.lower(text).rlike("(?<![a-z0-9])(?:" + "|".join(notice_terms()) + ")(?![a-z0-9])")


def closest(text: Column, templates=TEMPLATES) -> Column:
    """The best template of a text as struct(score, name), by sparse cosine."""
    names, vectors, idf, unknown = template_vectors(templates)

    def table(values, kind: str) -> Column:  # one literal, not an expression of thousands
        return F.from_json(F.lit(json.dumps(values)), f"map<string,{kind}>")

    weights = table({t: vectors[t] for t in idf}, "array<double>")
    idfs = table(idf, "double")
    words = F.regexp_extract_all(F.lower(text), F.lit("([a-z0-9]+)"), 1)

    def bind(value: Column, use) -> Column:  # evaluates a value once for an expression
        return F.transform(F.array(value), use)[0]

    def scored(terms: Column) -> Column:
        distinct = F.array_distinct(terms)
        return bind(distinct, lambda own: bind(
            F.transform(F.array_intersect(own, F.array(*[F.lit(t) for t in idf])), lambda t: F.struct(
                t.alias("t"), ((1 + F.log(F.size(F.filter(terms, lambda x: x == t)).cast("double"))) * idfs[t]).alias("w"))),
            lambda known: best(known, F.size(own) - F.size(known))))

    def best(known: Column, others: Column) -> Column:
        norm = F.aggregate(known, others * F.lit(unknown * unknown), lambda a, x: a + x["w"] * x["w"], F.sqrt)
        dots = F.aggregate(known, F.array(*[F.lit(0.0)] * len(names)),
                           lambda a, x: F.zip_with(a, weights[x["t"]], lambda p, q: p + x["w"] * q))
        scores = bind(norm, lambda n: F.zip_with(dots, F.array(*[F.lit(x) for x in names]), lambda d, x: F.struct(
            F.round(F.when(n > 0, d / n).otherwise(0.0), 6).alias("score"), x.alias("name"))))
        return F.aggregate(scores, F.struct(F.lit(0.0).alias("score"), F.lit(NONE).alias("name")),
                           lambda a, x: F.when(x["score"] > a["score"], x).otherwise(a))

    return bind(words, scored)


def _units(text: Column) -> Column:
    """What may be a notice: every line, every run of up to WRAPPED lines and every paragraph."""
    lines = F.split(text, "\n")
    runs = F.flatten(F.transform(F.sequence(F.lit(1), F.lit(WRAPPED)), lambda w: F.when(
        F.size(lines) >= w, F.transform(F.sequence(F.lit(1), F.size(lines) - w + 1), lambda i: F.array_join(F.slice(lines, i, w), "\n")))
        .otherwise(F.array().cast("array<string>"))))
    return F.filter(F.array_distinct(F.concat(runs, F.split(text, "\n(?:[^A-Za-z0-9\n]*\n)+"))), may_be_notice)


def _said(text: Column) -> Column:
    """The licences of SPDX tags; a single id without its "or later"."""
    return F.transform(F.regexp_extract_all(text, F.lit(SPDX), 1), lambda x: F.struct(
        F.lit(1.0).alias("score"), F.when(x.contains(" "), x).otherwise(
            F.regexp_replace(x, r"(?i)(-only|-or-later|\+)$", "")).alias("name")))


OUT = ("license", "score", "how", "from_path")


def scan(files: DataFrame, path_col: str = "path", text_col: str = "text", keep_text: bool = False) -> DataFrame:
    """``files`` with ``license`` and ``score`` of their own notice, or those of
    the directory above (``how``: own, inherited or none; ``from_path``: the file
    that says so)."""
    names = [c for c in files.columns if c not in OUT and not c.startswith("_ls_") and (keep_text or c != text_col)]
    text = F.col(text_col).cast("string")
    none = F.struct(F.lit(0.0).alias("score"), F.lit(NONE).alias("name"))
    better = lambda a, x: F.when((x["score"] > a["score"]) | ((x["score"] == a["score"]) & (x["name"] < a["name"])),
                                 x).otherwise(a)
    scores = F.flatten(F.transform(_units(text), lambda s: F.array(closest(s), closest(s, NOTICES))))
    best_line = F.aggregate(F.concat(scores, _said(text)), none, better, lambda a: F.struct(
        F.when((a["score"] < LINE_SCORE) & text.rlike(RESERVED), 1.0).otherwise(a["score"]).alias("score"),
        F.when((a["score"] < LINE_SCORE) & text.rlike(RESERVED), ALL_RIGHTS)
        .when((a["name"] == "BSD-2-Clause") & text.rlike(r"(?i)\bendorse\s+or[\s*#/]+promote\b"), "BSD-3-Clause")
        .otherwise(a["name"]).alias("name")))
    path = F.col(path_col).cast("string")
    marked = text.isNotNull() & (may_be_notice(text) | text.rlike(SPDX) | text.rlike(RESERVED))
    # Read by the inheritance and by the result: written once, without the text.
    scored = written(files.select(*names, path.alias("_ls_path"), F.when(marked, F.struct(
        best_line.alias("line"), closest(text).alias("all"))).alias("_ls")), "licences")
    own = F.coalesce(F.col("_ls.line.score") >= LINE_SCORE, F.lit(False))
    known = scored.withColumns({
        "_ls_name": F.when(own, F.col("_ls.line.name")), "_ls_score": F.when(own, F.col("_ls.line.score")),
        "_ls_all": F.col("_ls.all.score"), "_ls_dir": F.regexp_extract("_ls_path", "^(.*)/[^/]*$", 1)})
    named = F.regexp_extract("_ls_path", "([^/]*)$", 1).rlike(FILE_NAME)
    papers = known.where(F.col("_ls_path").isNotNull() & F.col("_ls_name").isNotNull()
                         & ((F.col("_ls_all") >= FILE_SCORE) | named))
    by_dir = papers.groupBy(F.col("_ls_dir").alias("up")).agg(
        F.min(F.struct((-F.col("_ls_score")).alias("s"), F.col("_ls_path").alias("p"),
                       F.col("_ls_name").alias("n"))).alias("said"))
    steps = F.split("dir", "/")
    above = known.select(F.col("_ls_dir").alias("dir")).where("dir is not null").distinct().select(
        "dir", F.posexplode(F.transform(F.sequence(F.lit(1), F.size(steps)), lambda n: F.array_join(F.slice(steps, 1, n), "/")))
        .alias("depth", "up"))
    nearest = above.join(by_dir, "up").groupBy(F.col("dir").alias("_ls_dir")).agg(
        F.max_by("said", "depth").alias("_ls_said"))
    own = F.col("_ls_name").isNotNull()
    given = F.col("_ls_said").isNotNull()
    return known.join(nearest, "_ls_dir", "left").select(
        *names,
        F.when(own, F.col("_ls_name")).otherwise(F.coalesce("_ls_said.n", F.lit(NONE))).alias("license"),
        F.when(own, F.col("_ls_score")).otherwise(F.coalesce(-F.col("_ls_said.s"), F.lit(0.0))).alias("score"),
        F.when(own, "own").when(given, "inherited").otherwise("none").alias("how"),
        F.when(own, F.col("_ls_path")).otherwise(F.col("_ls_said.p")).alias("from_path"))
