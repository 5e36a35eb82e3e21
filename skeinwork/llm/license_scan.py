"""License scans by diagonal voting (operator 9), all in DataFrame expressions.

Base: places where the words of a fixed phrase stand one after the other.  Method:
every rolling word k-gram of a document is hashed and joined with the k-gram
positions of license templates.  Matches of one document and template that lie on
one offset diagonal (place in the document less place in the template) vote for
it; neighbouring diagonals, which small insertions and deletions make, are merged
where they follow each other in the document and in the template.  A span, of one
diagonal or merged, is verified by the share of the template's words that its k-grams
cover and by its length, so a notice that stands whole on one diagonal counts whatever
is repeated around it.  Of verified spans that begin or end at one word, as those of
templates with much in common do, the best covered counts.  The score is the largest
share of a template that a verified span covers, and 1 where a phrase stands.

Hashes are two 64-bit values with different seeds.  The templates' k-grams are
broadcast as long as there are no more than ``BROADCAST_GRAMS``; beyond that they
meet the documents' in a shuffled join, with the same result.  Only matches leave
that join, and a document's matches with a template are bound by its length, so no
group grows with the table.

A document is known by doc_id and a hash of its text, so nothing depends on the
order or the partitions in which rows are read.  Null text counts as empty: no
words, no labels, score 0.  Repeated rows are labelled alike; a null doc_id is like
any other.  A template of fewer than k words is an error.  An empty table gives an
empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut

GRAM = 4
#: Diagonals at most so far apart, one after the other, may be one alignment, if no more
#: words than PLACE_GAP lie between what they match.
DIAGONAL_GAP, PLACE_GAP = 4, 20
#: Least share of a template's words that a span must cover.
VERIFY_SHARE = 0.6
#: Some 3 MB.
BROADCAST_GRAMS = 50_000
NOT_WORD = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

#: Phrases and their labels.
PHRASES = [
    ("under the mit license", "mit"),
    ("apache license version 2", "apache-2"),
    ("cc by nc", "cc-by-nc"),
]

#: Notices of public licenses.
TEMPLATES = [
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    ("mit", "The Software is provided as is, without warranty of any kind, express or implied, including but not limited to the warranties of merchantability, fitness for a particular purpose and noninfringement. In no event shall the authors or copyright holders be liable for any claim, damages or other liability, whether in an action of contract, tort or otherwise, arising from, out of or in connection with the Software or the use or other dealings in the Software."),
    ("mit", "released under the mit license"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("bsd-2", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."),
    ("bsd-3", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."),
    ("zlib", "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software."),
    ("bsl-1", "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so."),
    ("unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."),
    ("apache-2", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("apache-2", "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."),
    ("apache-2", "licensed under the apache license version 2.0"),
    ("gpl-3", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("gpl-3", "This work is licensed under the GNU General Public License version 3"),
    ("gpl-2", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("lgpl-2.1", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."),
    ("agpl-3", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("mpl-2", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-nc", "licensed under cc by nc 4.0"),
]


def lowered(text: Column) -> Column:
    """Lower case that changes ASCII letters as A-Z to a-z does.

    Words beyond ASCII are lower-cased as well, which changes neither their number nor
    any comparison with an ASCII word; the two code points whose lower case would be
    ASCII are replaced first by one that stays.
    """
    plain = F.coalesce(text.cast("string"), F.lit(""))
    return F.lower(F.replace(F.replace(plain, F.lit("K"), F.lit("ſ")), F.lit("İ"), F.lit("ſ")))


def words_of(text: Column) -> Column:
    return F.filter(F.split(lowered(text), NOT_WORD), lambda w: w != "")


def _gram_hashes(words: str, size: int) -> Column:
    """Rolling k-grams as structs (a, b) of two hashes, in order."""
    n = F.size(words) - size

    def at(i: Column) -> Column:
        gram = [F.get(words, i + j) for j in range(size)]
        return F.struct(F.xxhash64(*gram).alias("a"), F.xxhash64(F.lit(1), *gram).alias("b"))

    return F.when(n >= 0, F.transform(F.sequence(F.lit(0), n), at)).otherwise(F.array().cast("array<struct<a:long,b:long>>"))


def template_grams(templates: DataFrame, size: int = GRAM) -> DataFrame:
    """template, label, n_template (words), t_at, a, b from columns label, body."""
    listed = templates.select("label", words_of(F.col("body")).alias("ws"))
    if listed.filter(F.size("ws") < size).count():
        raise ValueError(f"a template has fewer than {size} words")
    numbered = listed.select(
        F.xxhash64("label", "ws").alias("template"), "label", F.size("ws").alias("n_template"), F.posexplode(_gram_hashes("ws", size)).alias("t_at", "g")
    )
    return numbered.select("template", "label", "n_template", "t_at", F.col("g.a").alias("a"), F.col("g.b").alias("b"))


def phrase_places(words: Column, phrases: list[tuple[str, str]], text: Column) -> Column:
    """array<struct<at, size, label>> of all places of the phrases.

    Only texts that hold the words of a phrase in this order somewhere on a line of
    non-word characters are looked through word by word.
    """
    return F.concat(*[_places_of(words, phrase.split(), label, text) for phrase, label in phrases])


def _places_of(words: Column, parts: list[str], label: str, text: Column) -> Column:
    near = text.rlike("(?<![0-9a-z])" + NOT_WORD.join(parts))
    every = F.sequence(F.lit(0), F.greatest(F.size(words) - len(parts), F.lit(0)))
    starts = F.filter(every, lambda i: _all([F.get(words, i + j) == F.lit(p) for j, p in enumerate(parts)]))
    placed = F.transform(
        starts, lambda i: F.struct(i.alias("at"), F.lit(len(parts)).alias("size"), F.lit(label).alias("label"))
    )
    return F.when(near, placed).otherwise(F.array().cast("array<struct<at:int,size:int,label:string>>"))


def _all(conditions: list[Column]) -> Column:
    out = F.lit(True)
    for c in conditions:
        out = out & F.coalesce(c, F.lit(False))
    return out


def verified_spans(matches: DataFrame, size: int = GRAM, share: float = VERIFY_SHARE) -> DataFrame:
    """rid, label, first, last (words), covered: from rid, template, label, n_template, at, t_at.

    ``rid`` names a document.
    """
    names = ["rid", "template", "label", "n_template"]
    by_diagonal = (
        matches.withColumn("diagonal", F.col("at") - F.col("t_at"))
        .groupBy(*names, "diagonal")
        .agg(
            F.min("at").alias("first"),
            (F.max("at") + size - 1).alias("last"),
            F.min("t_at").alias("t_first"),
            F.max("t_at").alias("t_last"),
            F.collect_set("t_at").alias("t_ats"),
        )
    )
    # Written, as they are read twice; few documents have any.
    by_diagonal = cut(by_diagonal, "diagonals")
    order = Window.partitionBy("rid", "template").orderBy("diagonal")
    apart = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(order) > DIAGONAL_GAP, F.lit(True))
    banded = by_diagonal.withColumn("starts", apart.cast("int")).withColumn("band", F.sum("starts").over(order))
    # Within a band by place; what lies inside another's place, such as a repeated k-gram, breaks no alignment.
    along = Window.partitionBy("rid", "template", "band").orderBy("first", F.desc("last"), "diagonal")
    reached = F.max("last").over(along.rowsBetween(Window.unboundedPreceding, -1))
    outer = banded.withColumn("reached", reached).filter(F.col("reached").isNull() | (F.col("last") > F.col("reached")))
    goes_on = (
        (F.col("first") - F.lag("last").over(along) <= PLACE_GAP)
        & (F.col("t_first") > F.lag("t_first").over(along))
        & (F.col("t_last") > F.lag("t_last").over(along))
    )
    joined = outer.withColumn("starts", (~F.coalesce(goes_on, F.lit(False))).cast("int")).withColumn("alignment", F.sum("starts").over(along))
    merged = joined.groupBy(*names, "band", "alignment").agg(
        F.min("first").alias("first"), F.max("last").alias("last"), F.array_distinct(F.flatten(F.collect_list("t_ats"))).alias("t_ats")
    )
    spans = merged.select(*names, "first", "last", "t_ats").unionByName(by_diagonal.select(*names, "first", "last", "t_ats"))
    words = F.array_distinct(F.flatten(F.transform("t_ats", lambda t: F.sequence(t, t + (size - 1)))))
    covered = F.size(words) / F.col("n_template")
    fits = F.col("last") - F.col("first") + 1 <= 2 * F.col("n_template")
    fitting = spans.withColumn("covered", covered).filter((covered >= share) & fits).drop("t_ats")
    for end in ("first", "last"):
        best = F.max("covered").over(Window.partitionBy("rid", end))
        fitting = fitting.withColumn(f"best_{end}", best)
    better = F.greatest("best_first", "best_last") > F.col("covered")
    return fitting.filter(~better).select("rid", "label", "first", "last", "covered")


def license_scan(docs: DataFrame, templates: DataFrame, phrases: list[tuple[str, str]] = PHRASES) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    A row per row of ``docs``; columns used: doc_id, text.  ``templates``: label, body.
    """
    low = lowered(docs["text"])
    doc_id = docs["doc_id"].cast("long")
    # Documents with equal rid have equal text, so they share their matches.
    rid = F.struct(F.coalesce(doc_id, F.lit(-1)).alias("doc"), F.xxhash64(low).alias("mark"))
    read = docs.select(rid.alias("rid"), doc_id.alias("doc_id"), low.alias("low"))
    worded = read.select("rid", "doc_id", "low", F.filter(F.split("low", NOT_WORD), lambda w: w != "").alias("ws"))
    base = worded.select(
        "rid", "doc_id", F.size("ws").cast("long").alias("n_words"), phrase_places(F.col("ws"), phrases, F.col("low")).alias("found")
    )
    grams = worded.select("rid", F.posexplode(_gram_hashes("ws", GRAM)).alias("at", "g"))
    known = template_grams(templates)
    if known.count() <= BROADCAST_GRAMS:
        known = F.broadcast(known)
    matches = grams.join(known, (F.col("g.a") == F.col("a")) & (F.col("g.b") == F.col("b"))).select(
        "rid", "template", "label", "n_template", "at", "t_at"
    )
    by_row = verified_spans(matches).groupBy("rid").agg(
        F.collect_set("label").alias("more"), F.max("covered").alias("covered")
    )
    labels = F.array_sort(F.array_distinct(F.transform("found", lambda p: p["label"])))
    both = F.array_sort(F.array_union(labels, F.coalesce("more", F.array().cast("array<string>"))))
    any_base = F.size("found") > 0
    return base.join(by_row, "rid", "left").select(
        "doc_id",
        "n_words",
        F.size("found").cast("long").alias("n_base"),
        F.array_min(F.transform("found", lambda p: p["at"])).cast("long").alias("first_word"),
        F.array_max(F.transform("found", lambda p: p["at"])).cast("long").alias("last_word"),
        F.array_join(labels, ",").alias("base_labels"),
        F.array_join(both, ",").alias("labels"),
        F.when(any_base, F.lit(1.0)).otherwise(F.coalesce("covered", F.lit(0.0))).alias("score"),
    )
