"""License scan (DataFrame functions only).

Texts and templates become sequences of five-word shingles. Every template is assigned a window width W, the
largest power of two (up to MAX_WIDTH) for which an occurrence of the template surely holds a whole text
window; text windows of W shingles start at every W/4-th position, template windows at every position. Each
window has BANDS MinHash values, one row per band, because the templates are few and every candidate is
verified: a text window inside an exact occurrence equals a template window and always collides, and one of
Jaccard similarity 0.67 (a fifth of the shingles changed) misses all bands with probability
(1-0.67)**BANDS, below 2e-6 at 12 bands, for each window of the occurrence.

A window can collide only if it holds the shingle behind one of the templates' MinHash values. Texts without
any such shingle are done after one pass over their shingles; the others' shingles are written once, and only the
windows around such shingles are sketched. This skips work, never a collision. A window meets the templates of its
keys by a join with the broadcast table of the templates, whose size does not depend on the texts.

Windows that collide are verified exactly: the share of the template's distinct shingles found around the
window must reach ``containment``, and all of its shingles with a number must be there, because the version is
often all that tells two licences apart. No text is shuffled, only the windows that collide.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from veritab.llm.store import materialize

SHINGLE = 5
BANDS = 12
MAX_WIDTH = 64

#: Licences with the names their notices use (fixed values: SPDX identifiers and customary names).
NAMES = (
    ("AFL-3.0", "the Academic Free License version 3.0"),
    ("AGPL-3.0", "the GNU Affero General Public License, version 3", "the GNU Affero General Public License v3.0", "the GNU AGPL v3"),
    ("Apache-1.1", "the Apache Software License, Version 1.1"),
    ("Apache-2.0", "the Apache License, Version 2.0", "the Apache License 2.0", "the Apache 2.0 License", "Apache License 2.0"),
    ("Artistic-2.0", "the Artistic License 2.0"),
    ("BSD-2-Clause", "the BSD 2-Clause License", "the 2-Clause BSD License", "the Simplified BSD License"),
    ("BSD-3-Clause", "the BSD 3-Clause License", "the 3-Clause BSD License", "the New BSD License", "the Modified BSD License"),
    ("BSL-1.0", "the Boost Software License, Version 1.0", "the Boost Software License 1.0"),
    ("CC0-1.0", "CC0 1.0", "the CC0 1.0 Universal"),
    ("CDDL-1.0", "the Common Development and Distribution License 1.0", "the Common Development and Distribution License, Version 1.0"),
    ("EPL-1.0", "the Eclipse Public License 1.0", "the Eclipse Public License v1.0"),
    ("EPL-2.0", "the Eclipse Public License 2.0", "the Eclipse Public License v2.0"),
    ("EUPL-1.2", "the European Union Public License 1.2", "the EUPL 1.2"),
    ("GFDL-1.3", "the GNU Free Documentation License, Version 1.3"),
    ("GPL-2.0", "the GNU General Public License, version 2", "the GNU General Public License v2.0", "the GNU GPL v2", "the GPL v2"),
    ("GPL-3.0", "the GNU General Public License, version 3", "the GNU General Public License v3.0", "the GNU GPL v3", "the GPL v3"),
    ("ISC", "the ISC License"),
    ("LGPL-2.1", "the GNU Lesser General Public License, version 2.1", "the GNU Lesser General Public License v2.1", "the GNU LGPL v2.1", "LGPL v2.1", "the LGPL v2.1"),
    ("LGPL-3.0", "the GNU Lesser General Public License, version 3", "the GNU Lesser General Public License v3.0", "the GNU LGPL v3", "the LGPL v3"),
    ("MIT", "the MIT License", "the MIT/X11 License"),
    ("MPL-1.1", "the Mozilla Public License 1.1", "the Mozilla Public License, version 1.1"),
    ("MPL-2.0", "the Mozilla Public License 2.0", "the Mozilla Public License, version 2.0", "the Mozilla Public License, v. 2.0"),
    ("MS-PL", "the Microsoft Public License"),
    ("NCSA", "the University of Illinois/NCSA Open Source License"),
    ("ODbL-1.0", "the Open Database License 1.0", "the Open Data Commons Open Database License"),
    ("OFL-1.1", "the SIL Open Font License, Version 1.1", "the SIL Open Font License 1.1"),
    ("OSL-3.0", "the Open Software License version 3.0"),
    ("PostgreSQL", "the PostgreSQL License"),
    ("Python-2.0", "the Python Software Foundation License"),
    ("Zlib", "the zlib License"),
)
#: Creative Commons variants (fixed values).
COMMONS = (("BY", "Attribution"), ("BY-SA", "Attribution-ShareAlike"), ("BY-NC", "Attribution-NonCommercial"), ("BY-ND", "Attribution-NoDerivatives"), ("BY-NC-SA", "Attribution-NonCommercial-ShareAlike"), ("BY-NC-ND", "Attribution-NonCommercial-NoDerivatives"))
VERBS = ("Licensed under", "Released under", "Distributed under")
#: Longer notices (fixed values: the customary wording of each licence's notice).
NOTICES = (
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"),
    ("Apache-2.0", "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("LGPL-2.1", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
)


def words_of(text: str) -> list[str]:
    """The words of a template as :func:`shingles` sees them."""
    return [w for w in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.translate(str.maketrans(_UPPER, _LOWER)).replace("licence", "license")) if w]


def wordings() -> tuple[tuple[str, str], ...]:
    """(license, notice): every name after every verb, Creative Commons in versions 3.0 and 4.0, SPDX tags and the
    longer notices; those of fewer than five words are left out, being no shingle."""
    names = [(row[0], n) for row in NAMES for n in row[1:]]
    for code, long in COMMONS:
        for version, kind in (("3.0", "Unported"), ("4.0", "International")):
            names += [(f"CC-{code}-{version}", f"CC {code} {version}"), (f"CC-{code}-{version}", f"a Creative Commons {long} {version} {kind} License"), (f"CC-{code}-{version}", f"the Creative Commons {long} {version} {kind} License")]
    made = [(i, f"{v} {n}") for i, n in names for v in VERBS]
    made += [(i, f"SPDX-License-Identifier: {i}") for i in dict.fromkeys(i for i, _ in names)]
    return tuple((i, t) for i, t in (*made, *NOTICES) if len(words_of(t)) >= SHINGLE)


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
TEMPLATES = wordings()


def shingles(text: Column) -> Column:
    """Hashes of all runs of five words, in order (words: ASCII letters, digits and all beyond ASCII; A-Z lower-cased;
    "licence" reads as "license").
    Null texts and texts with fewer than five words have none."""
    words = F.filter(F.split(F.replace(F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER), F.lit("licence"), F.lit("license")), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"), lambda w: w != "")
    # the words stay one array per row: a one-element transform binds it to a name
    made = F.transform(F.array(words), lambda w: F.when(F.size(w) >= SHINGLE, F.transform(F.sequence(F.lit(0), F.size(w) - SHINGLE), lambda i: F.xxhash64(*[F.get(w, i + j) for j in range(SHINGLE)]))).otherwise(F.array().cast("array<bigint>")))
    return F.get(made, F.lit(0))


def _least(window: Column, k: Column) -> Column:
    """(MinHash value, shingle behind it) of a window under hash function ``k``."""
    return F.array_min(F.transform(window, lambda x: F.struct(F.xxhash64(x, k).alias("v"), x.alias("x"))))


def width_for(shingle_count: int) -> int:
    """Widest window that an occurrence of ``shingle_count`` shingles surely holds whole."""
    w = 1
    while w * 2 <= MAX_WIDTH and w * 2 + max(1, w // 2) - 1 <= shingle_count:
        w *= 2
    return w


def prepare(spark: SparkSession, templates: tuple[tuple[str, str], ...]) -> list[dict]:
    """Shingles, window width and band values of every template; templates of fewer than five words are refused."""
    frame = spark.createDataFrame([(i, n, t) for i, (n, t) in enumerate(templates)], "i int, license string, text string")
    rows = frame.select("i", "license", shingles(F.col("text")).alias("s")).collect()  # one row per template
    short = [templates[r["i"]][1] for r in rows if not r["s"]]
    if short:
        raise ValueError(f"templates need at least {SHINGLE} words: {short}")
    frame = spark.createDataFrame([(r["i"], r["license"], list(r["s"]), width_for(len(r["s"]))) for r in rows], "i int, license string, s array<bigint>, w int")
    windows = F.transform(F.sequence(F.lit(0), F.size("s") - F.col("w")), lambda j: F.slice("s", j + 1, F.col("w")))
    bands = F.flatten(F.transform(windows, lambda w: F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda k: F.struct(k.alias("k"), _least(w, k).alias("m")))))
    keyed = frame.withColumn("b", bands).select("i", "license", "s", "w", F.array_distinct(F.transform("b", lambda b: F.xxhash64(F.col("w"), b["k"], b["m"]["v"]))).alias("keys"), F.array_distinct(F.transform("b", lambda b: b["m"]["x"])).alias("leads"))
    out = [r.asDict() for r in keyed.orderBy("i").collect()]
    for t in out:
        said = words_of(templates[t["i"]][1])
        t["must"] = [x for j, x in enumerate(t["s"]) if any(c in "0123456789" for w in said[j : j + SHINGLE] for c in w)]
    return out


def _longs(values: list[int]) -> Column:
    return F.lit(sorted(set(values))) if values else F.array().cast("array<bigint>")


def _windows(h: Column, group: list[dict]) -> Column:
    """Structs (w, start, keys) of the windows around the templates' leading shingles."""
    out = []
    for w in sorted({t["w"] for t in group}):
        leads = [x for t in group if t["w"] == w for x in t["leads"]]
        step = max(1, w // 4)
        places = F.filter(F.sequence(F.lit(0), F.size(h) - 1), lambda p: F.get(h, p).isin(leads))
        first = lambda p: F.ceil(F.greatest(p - (w - 1), F.lit(0)) / step).cast("int") * step
        starts = F.array_distinct(F.flatten(F.transform(places, lambda p: F.when(first(p) <= p, F.sequence(first(p), p, F.lit(step))).otherwise(F.array().cast("array<int>")))))
        keys = lambda win: F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda k: F.xxhash64(F.lit(w), k, _least(win, k)["v"]))  # noqa: B023, E731
        out.append(F.transform(starts, lambda s: F.struct(F.lit(w).alias("w"), s.alias("start"), keys(F.slice(h, s + 1, w)).alias("keys"))))
    return F.concat(*out)


def _bind(df: DataFrame, keep: list[str], name: str, value: Column) -> DataFrame:
    """``keep`` and ``name`` = value, computed once per row: exploding a one-element array keeps the optimizer from
    copying the expression to each of its uses."""
    return df.select(*keep, F.explode(F.array(value)).alias(name))


def scan(docs: DataFrame, keep: list[str], templates: tuple[tuple[str, str], ...] = TEMPLATES, containment: float = 0.8, text: str = "text") -> DataFrame:
    """One row per text and license found in it: ``keep`` columns, license, containment (the best of its templates),
    windows (verified windows) and first_word (start of the first one, in shingles).

    Null, empty and short texts hold no license. Repeated rows give repeated results. Extra columns are ignored."""
    clash = {"license", "containment", "windows", "first_word"} & set(keep)
    if clash:
        raise ValueError(f"columns {sorted(clash)} are made by this operator")
    spark = docs.sparkSession
    ready = prepare(spark, templates)
    leads = [x for t in ready for x in t["leads"]]
    texts = _bind(docs, keep, "__h", shingles(F.col(text))).where(F.size(F.array_intersect("__h", _longs(leads))) > 0)
    texts = materialize(texts.withColumn("__id", F.monotonically_increasing_id()), "licenses")
    wide = max(len(t["s"]) for t in ready)
    wins = _bind(texts, ["__id", "__h"], "__w", _windows(F.col("__h"), ready)).select("__id", "__h", F.explode("__w").alias("__w"))
    # a window takes along the shingles around it, as far as the longest template reaches
    begin = F.greatest(F.col("__w.start") - wide, F.lit(0))
    wins = wins.select("__id", F.col("__w.w").alias("w"), F.col("__w.start").alias("start"), begin.alias("begin"), F.slice("__h", begin + 1, F.col("__w.w") + 2 * wide).alias("near"), F.explode(F.array_distinct("__w.keys")).alias("key"))
    known = spark.createDataFrame([(t["i"], t["license"], list(t["s"]), t["must"], t["w"], t["keys"]) for t in ready], "i int, license string, s array<bigint>, must array<bigint>, tw int, keys array<bigint>")
    known = known.select("i", "license", "s", "must", "tw", F.explode("keys").alias("key"))
    met = wins.join(F.broadcast(known), "key").where("w = tw").dropDuplicates(["__id", "i", "start"])
    m = F.size("s")
    around = F.expr("slice(near, greatest(start - size(s), 0) - begin + 1, tw + 2 * size(s))")
    share = F.size(F.array_intersect(around, "s")) / F.size(F.array_distinct("s"))
    met = met.withColumn("c", share).where((F.col("c") >= containment) & (F.size(F.array_except("must", around)) == 0) & (m > 0))
    found = met.groupBy("__id", "license").agg(F.max("c").alias("containment"), F.count("*").cast("int").alias("windows"), F.min("start").alias("first_word"))
    return texts.select("__id", *keep).join(found, "__id").select(*keep, "license", "containment", "windows", "first_word")
