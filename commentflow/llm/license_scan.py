"""License scan: normalised text against licence templates by the Dice coefficient of word bigrams.

Each line of a document and the whole document are units of comparison. A template of ``b`` bigrams can only
reach a likeness ``t`` with units of ``t / (2 - t) * b`` to ``(2 - t) / t * b`` bigrams; units and templates
outside these bounds are never compared. The scan is one projection of built-in functions without a shuffle.

Edge cases: a null or empty text has no units with words and no licences; equal scores are ordered by licence
name; repeated rows give repeated results; other columns are ignored, whatever their names; an empty table gives
an empty result.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from commentflow.llm.tables import let

MIN_DICE = 0.8

#: Licence notices and permission texts (fixed values).
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."),
    ("BSD-2-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("Unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."),
)

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def template_bigrams(text: str) -> list[str]:
    words = re.findall("[a-z0-9]+", text.translate(str.maketrans(_UPPER, _LOWER)))
    return list(dict.fromkeys(f"{a} {b}" for a, b in zip(words, words[1:])))


def bounds(n: int, least: float) -> tuple[int, int]:
    """Numbers of bigrams a unit must have to reach the likeness ``least`` with a template of ``n`` bigrams."""
    return math.ceil(least / (2 - least) * n - 1e-9), math.floor((2 - least) / least * n + 1e-9)


def _words(unit: Column) -> Column:
    return F.filter(F.split(unit, " "), lambda w: w != "")


def _bigrams(unit: Column, low: int, high: int, vocabulary: list[str], least: float) -> Column:
    """Distinct bigrams of a unit; null where its words already show that no template is near enough.

    A unit near a template shares at least ``least / (2 - least)`` of its own bigrams, and each distinct word that
    no template has spoils half a bigram or more."""

    def of(w: Column) -> Column:
        pairs = F.transform(F.sequence(F.lit(0), F.size(w) - 2), lambda i: F.concat_ws(" ", F.get(w, i), F.get(w, i + 1)))

        def pruned(distinct: Column) -> Column:
            strange = F.size(F.filter(distinct, lambda x: ~x.isin(*vocabulary)))
            spoilt = 2 * (2 - 2 * least) / (2 - least)
            return F.when((F.size(distinct) <= high + 1) & (strange <= F.lit(spoilt + 1e-9) * (F.size(w) - 1)), F.array_distinct(pairs))

        return F.when((F.size(w) > low) & (F.size(w) > 1), let(F.array_distinct(w), pruned))

    return let(_words(unit), of)


def license_scores(text: Column, templates=TEMPLATES, least: float = MIN_DICE) -> Column:
    """Array of (dice, license) of all licences with a unit of the text at ``least`` or more, best first."""
    known = [(name, template_bigrams(body)) for name, body in templates]
    limits = [bounds(len(b), least) for _, b in known]
    low, high = min(x for x, _ in limits), max(y for _, y in limits)
    vocabulary = list(dict.fromkeys(w for _, grams in known for b in grams for w in b.split(" ")))
    every = list(dict.fromkeys(b for _, grams in known for b in grams))
    clean = F.regexp_replace(F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER), "[^a-z0-9\n]+", " ")

    def unit_hits(unit: Column) -> Column:
        return let(_bigrams(unit, low, high, vocabulary, least), lambda g: F.when(
            F.size(g).between(low, high),
            F.struct(F.size(g).alias("n"), F.array_intersect(g, F.array(*[F.lit(b) for b in every])).alias("hits"))))

    def units(c: Column) -> Column:
        return F.filter(F.transform(F.array_append(F.split(c, "\n"), F.translate(c, "\n", " ")), unit_hits),
                        lambda u: u.isNotNull() & (F.size(u["hits"]) > 0))

    def scored(found: Column) -> Column:
        rows = []
        for (name, grams), (few, many) in zip(known, limits):
            body = F.array(*[F.lit(b) for b in grams])
            best = F.array_max(F.transform(
                F.filter(found, lambda u: u["n"].between(few, many)),
                lambda u: F.lit(2.0) * F.size(F.array_intersect(u["hits"], body)) / (u["n"] + len(grams))))
            rows.append(F.struct(best.alias("dice"), F.lit(name).alias("license")))
        near = F.filter(F.array(*rows), lambda r: r["dice"] >= least)
        names = F.array_distinct(F.transform(near, lambda r: r["license"]))
        best_of = F.transform(names, lambda n: F.struct(
            (-F.array_max(F.transform(F.filter(near, lambda r: r["license"] == n), lambda r: r["dice"]))).alias("down"), n.alias("license")))
        return F.transform(F.sort_array(best_of), lambda r: F.struct((-r["down"]).alias("dice"), r["license"].alias("license")))

    empty = F.expr("cast(array() as array<struct<dice: double, license: string>>)")
    return let(let(clean, units), lambda found: F.when(F.size(found) > 0, scored(found)).otherwise(empty))


def license_scan(docs: DataFrame, templates=TEMPLATES, least: float = MIN_DICE) -> DataFrame:
    """One row for each document: the number of licences found, the best with its likeness, and all names, best first."""
    return docs.select("doc_id", license_scores(F.col("text"), templates, least).alias("found")).select(
        "doc_id",
        F.size("found").cast("bigint").alias("n_licenses"),
        F.get("found", F.lit(0))["license"].alias("license"),
        F.get("found", F.lit(0))["dice"].alias("dice"),
        F.array_join(F.transform("found", lambda r: r["license"]), ",").alias("licenses"),
    )


def _sql() -> str:
    rows = ", ".join(
        f"({k}, '{name}', [{', '.join(repr(b) for b in template_bigrams(body))}])" for k, (name, body) in enumerate(TEMPLATES))
    return f"""
with known(k, license, grams) as (values {rows}),
clean as (
  select doc_id, regexp_replace(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^a-z0-9' || chr(10) || ']+', ' ', 'g') as c
  from documents
), units as (
  select doc_id, unnest(list_append(string_split(c, chr(10)), replace(c, chr(10), ' '))) as unit from clean
), worded as (
  select doc_id, list_filter(string_split(unit, ' '), lambda w: w <> '') as ws from units
), grams as (
  select doc_id, list_distinct(list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1])) as g
  from worded where len(ws) > 1
), scored as (
  select doc_id, license, max(2.0::double * len(list_intersect(g, grams)) / (len(g) + len(grams))) as dice
  from (select doc_id, g from grams where len(list_intersect(g, (select flatten(list(grams)) from known))) > 0) u, known
  group by doc_id, license
), near as (
  select * from scored where dice >= {MIN_DICE}
), listed as (
  select doc_id, count(*) as n, string_agg(license, ',' order by dice desc, license) as names,
         first(license order by dice desc, license) as best, max(dice) as dice
  from near group by doc_id
)
select d.doc_id, cast(coalesce(n, 0) as bigint) as n_licenses, best as license, dice, coalesce(names, '') as licenses
from documents d left join listed l on d.doc_id = l.doc_id"""


SQL = _sql()
