"""License scans: MinHash bands over overlapping text windows retrieve templates.

A template of n word shingles (five words) belongs to the scale S, the power of two with
S / 2 < n <= S. Texts are cut into windows of 2 S shingles every S shingles, so that a run of S
shingles lies whole in some window. A window that contains 0.8 of a template's shingles has at least
the Jaccard similarity J = 0.8 (S / 2) / (2 S + 0.2 S / 2) with it; one-row bands (single minimum
hashes) in the number BANDS make a collision more likely than 1 - 10^-5. Windows that share a band with a
template are verified by exact containment of the template's shingles.

Before that, windows that cannot match are left out. For each template the words are chosen without
which less than 0.8 of its shingles remain; a text or window that has none of them cannot contain
0.8 of the template. This loses nothing and spares hashing the rest.

Only DataFrame and SQL functions are used. Words are letter or digit runs in lower case.

Nulls, empties, ties: null and empty texts, and texts shorter than a shingle, match nothing, as do
templates shorter than a shingle (they are an error). Of windows that contain a template equally
well the first counts. Rows that share an id are one document whose windows all count. Rows without id are reported without id. No other column is used.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from custodia.llm.common import let, staged

SHINGLE = 5
LEAST = 0.8

#: Notices looked for unless others are given: name and text.
TEMPLATES = {
    "MIT notice": "Released under the MIT License.",
    "Apache-2.0 notice": "Licensed under the Apache License, Version 2.0.",
    "CC-BY-NC-4.0 notice": "Licensed under CC BY-NC 4.0.",
    "GPL-3.0 notice": "This work is licensed under the GNU General Public License, version 3.",
    "BSD notice": "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    "MPL-2.0 notice": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "CC-BY-SA-4.0 notice": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "MIT permission": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
        "files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, "
        "modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"
    ),
    "Apache-2.0 header": (
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
        "\"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."
    ),
    "GPL header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License "
        "as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."
    ),
}


def template_words(text: str) -> list[str]:
    return re.findall(r"[a-z0-9]+", text.lower())


def template_shingles(text: str) -> list[str]:
    w = template_words(text)
    return sorted({" ".join(w[i : i + SHINGLE]) for i in range(len(w) - SHINGLE + 1)})


def anchors(shingles: list[str], frequent: set[str]) -> list[str]:
    """Words without which less than LEAST of the shingles remain, rare ones first."""
    left, out = [set(s.split()) for s in shingles], []
    while len(left) >= LEAST * len(shingles) - 1e-9:
        count: dict[str, int] = {}
        for s in left:
            for w in s:
                count[w] = count.get(w, 0) + 1
        best = min(count, key=lambda w: (w in frequent or len(w) < 4, -count[w], w))
        out.append(best)
        left = [s for s in left if best not in s]
    return out


def bands_for(scale: int, miss: float = 1e-5) -> int:
    """One-row bands that keep the chance of no collision below `miss` for any template of a scale."""
    least = scale // 2 + 1
    j = LEAST * least / (2 * scale + (1 - LEAST) * least)
    return math.ceil(math.log(miss) / math.log(1 - j))


def text_words(text: Column) -> Column:
    """Letter and digit runs of ASCII in lower case; anything else divides."""
    plain = F.btrim(F.regexp_replace(F.lower(text), "[^a-z0-9]+", " "))
    return F.when(plain == "", F.array().cast("array<string>")).otherwise(F.split(plain, " "))


def minimum_hashes(hashes: Column, n: int) -> Column:
    """n minimum hashes of an array of shingle hashes, each under another permutation."""

    def permuted(k: int) -> Column:
        return F.array_min(F.transform(hashes, lambda h: F.xxhash64(F.lit(k), h)))

    return F.array(*map(permuted, range(n)))


def scan(docs: DataFrame, templates: dict[str, str] | None = None) -> DataFrame:
    """doc_id, license, containment, shared and all shingles, and the words [first, last) of the window."""
    spark = docs.sparkSession
    parts = {k: template_shingles(t) for k, t in (templates or TEMPLATES).items()}
    if short := [k for k, s in parts.items() if not s]:
        raise ValueError(f"templates of less than {SHINGLE} words: {short}")
    frequent = {"this", "that", "with", "under", "from", "have", "which", "will", "your", "there"}
    keys = {k: anchors(s, frequent) for k, s in parts.items()}
    scale = {k: 1 << max(0, (len(s) - 1).bit_length()) for k, s in parts.items()}
    every = sorted({w for x in keys.values() for w in x})
    own = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    own = own.where(F.lower("text").rlike("|".join(map(re.escape, every))))
    own = own.select("doc_id", text_words(F.col("text")).alias("w")).where(F.size("w") >= SHINGLE)
    own = staged(own, "licensed")  # the texts that can match, read once for all scales
    found = None
    for s in sorted(set(scale.values())):
        names = [k for k in parts if scale[k] == s]
        n, wanted = bands_for(s), F.array(*[F.lit(w) for w in sorted({w for k in names for w in keys[k]})])
        given = F.array(*[F.struct(F.lit(k).alias("license"), F.array(*map(F.lit, parts[k])).alias("shingles")) for k in names])
        signs = spark.range(1).select(F.explode(given).alias("t")).select("t.license", "t.shingles")
        signs = signs.withColumn("mins", minimum_hashes(F.transform("shingles", lambda x: F.xxhash64(x)), n))
        # Windows: 2 S shingles (2 S + 2 words) every S words.
        cut = F.transform(F.sequence(F.lit(0), F.greatest(F.lit(0), F.ceil((F.size("w") - (SHINGLE - 1)) / s).cast("int") - 1)), lambda i: F.struct((i * s).alias("first"), F.slice("w", i * s + 1, 2 * s + SHINGLE - 1).alias("w")))
        windows = own.where(F.arrays_overlap("w", wanted)).select("doc_id", F.explode(F.filter(cut, lambda x: F.arrays_overlap(x["w"], wanted))).alias("x"))
        windows = windows.select("doc_id", "x.first", "x.w").where(F.size("w") >= SHINGLE)
        spans = F.transform(F.sequence(F.lit(1), F.size("w") - SHINGLE + 1), lambda i: F.array_join(F.slice("w", i, SHINGLE), " "))
        windows = windows.select("doc_id", "first", F.size("w").alias("n_words"), F.array_distinct(spans).alias("own"))
        windows = windows.withColumn("mins", let(F.transform("own", lambda x: F.xxhash64(x)), lambda h: minimum_hashes(h, n)))
        # Templates are given with the call, a few for each band: their bands are a small table.
        bands = signs.select("license", F.posexplode("mins").alias("band", "value")).groupBy("band", "value").agg(F.collect_set("license").alias("names"))
        hit = windows.select("doc_id", "first", "n_words", "own", F.posexplode("mins").alias("band", "value")).join(F.broadcast(bands), ["band", "value"])
        hit = hit.select("doc_id", "first", "n_words", "own", F.explode("names").alias("license"))
        hit = hit.join(F.broadcast(signs.select("license", "shingles")), "license")
        shared = F.size(F.array_intersect("own", "shingles"))
        hit = hit.select("doc_id", "license", "first", (F.col("first") + F.col("n_words")).alias("last"), shared.cast("long").alias("shared"), F.size("shingles").cast("long").alias("shingles"))
        hit = hit.where(F.col("shared") >= LEAST * F.col("shingles") - 1e-9)
        found = hit if found is None else found.union(hit)
    best = found.groupBy("doc_id", "license").agg(F.max("shingles").alias("shingles"), F.max(F.struct("shared", -F.col("first"), "last")).alias("b"))
    return best.select(
        "doc_id", "license", F.round(F.col("b.shared") / F.col("shingles"), 6).alias("containment"), F.col("b.shared").alias("shared"),
        "shingles", (-F.col("b.col2")).cast("long").alias("first"), F.col("b.last").cast("long").alias("last"),
    )


def scan_sql() -> str:
    """Exact containment of every template in every window, without bands or anchors."""
    rows, scales = [], []
    for k, t in TEMPLATES.items():
        s = template_shingles(t)
        rows += [f"('{k}', '{x}')" for x in s]
        scales.append(f"('{k}', {1 << max(0, (len(s) - 1).bit_length())}, {len(s)})")
    return f"""
with t(license, shingle) as (values {", ".join(rows)}),
n(license, scale, shingles) as (values {", ".join(scales)}),
w as (select doc_id, string_split(trim(regexp_replace(lower(coalesce(text, '')), '[^a-z0-9]+', ' ', 'g')), ' ') w from documents),
p as (select doc_id, len(w) n_words, w, unnest(range(0, len(w) - {SHINGLE - 1})) i from w where len(w) >= {SHINGLE}),
g as (select doc_id, n_words, i, array_to_string(w[i + 1 : i + {SHINGLE}], ' ') shingle from p),
m as (select g.doc_id, g.n_words, g.i, g.shingle, n.* from g join t using (shingle) join n using (license)),
x as (select *, unnest([i // scale, i // scale - 1]) slot from m),
c as (
  select doc_id, license, shingles, slot * scale "first", least(slot * scale + 2 * scale + {SHINGLE - 1}, n_words) "last", count(distinct shingle) shared
  from x where slot >= 0 group by all
), r as (
  select *, row_number() over (partition by doc_id, license order by shared desc, "first") k from c where shared >= {LEAST} * shingles - 1e-9
)
select doc_id, license, round(shared / shingles, 6) containment, shared, cast(shingles as bigint) shingles,
  cast("first" as bigint) "first", cast("last" as bigint) "last"
from r where k = 1
"""
