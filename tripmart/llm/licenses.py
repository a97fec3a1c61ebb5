"""Licence notices in documents, by the Dice coefficient of word bigrams with licence templates.

Lines, sentences and paragraphs of a document are compared with every template whose size allows the threshold:
2 * shared / (a + b) >= t needs shared <= min(a, b), so b lies between a * t / (2 - t) and a * (2 - t) / t.

A notice may be in none of these: wrapped over lines among other words, in a comment, inside a longer line. So
runs of consecutive words are compared as well, whatever stands between the words. A run at the threshold shares
at least b * t / (2 - t) bigrams with the template, hence it has one of any b - need + 1 of them: those of
long words, as they are the rarest, are the template's anchors. Runs are tried around anchors only, each run at the first anchor
in it, and only where enough of the template's bigrams are near. A text without anchors has no passage either.

Whole licence texts are compared with whole documents, as a file of its own is what holds one; within a longer
text the notices speak for them.

DataFrame functions only; the templates are constants of the plan.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart.llm.decontaminate import computed, folded_words, shingle_texts

# Usual notices of public licences.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    (
        "Apache-2.0",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    ),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    (
        "CC-BY-NC-4.0",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    (
        "GPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version.",
    ),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the Software), to deal in the Software without restriction, including without limitation "
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software.",
    ),
    (
        "MPL-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
        "not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    ),
    ("Proprietary", "All rights reserved."),
    ("AGPL-3.0", "Licensed under the GNU Affero General Public License."),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    (
        "EPL-2.0",
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License "
        "2.0 which is available at https://www.eclipse.org/legal/epl-2.0/",
    ),
    ("ISC", "Licensed under the ISC License."),
    ("LGPL", "Licensed under the GNU Lesser General Public License."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
)

# Whole texts of public licences, without title and copyright line.
_BSD_TERMS = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list "
    "of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright "
    "notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided "
    "with the distribution. "
)
_BSD_THIRD = (
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
    "products derived from this software without specific prior written permission. "
)
_BSD_WARRANTY = (
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS AS IS AND ANY EXPRESS OR IMPLIED WARRANTIES, "
    "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
    "DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
    "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR "
    "SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, "
    "WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE "
    "OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
TEXTS = (
    ("BSD-2-Clause", _BSD_TERMS + _BSD_WARRANTY),
    ("BSD-3-Clause", _BSD_TERMS + _BSD_THIRD + _BSD_WARRANTY),
    (
        "BSL-1.0",
        "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and "
        "accompanying documentation covered by this license (the Software) to use, reproduce, display, distribute, "
        "execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties "
        "to whom the Software is furnished to do so, all subject to the following: The copyright notices in the Software "
        "and this entire statement, including the above license grant, this restriction and the following disclaimer, "
        "must be included in all copies of the Software, in whole or in part, and all derivative works of the Software, "
        "unless such copies or derivative works are solely in the form of machine-executable object code generated by a "
        "source language processor. THE SOFTWARE IS PROVIDED AS IS, WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, "
        "INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE, TITLE AND "
        "NON-INFRINGEMENT. IN NO EVENT SHALL THE COPYRIGHT HOLDERS OR ANYONE DISTRIBUTING THE SOFTWARE BE LIABLE FOR ANY "
        "DAMAGES OR OTHER LIABILITY, WHETHER IN CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE "
        "SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE "
        "IS PROVIDED AS IS AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED "
        "WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, "
        "INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER "
        "IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR "
        "PERFORMANCE OF THIS SOFTWARE.",
    ),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the Software), to deal in the Software without restriction, including without limitation "
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
        "to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above "
        "copyright notice and this permission notice shall be included in all copies or substantial portions of the "
        "Software. THE SOFTWARE IS PROVIDED AS IS, WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT "
        "LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT "
        "SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION "
        "OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER "
        "DEALINGS IN THE SOFTWARE.",
    ),
    (
        "Unlicense",
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, "
        "use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any "
        "purpose, commercial or non-commercial, and by any means. In jurisdictions that recognize copyright laws, the "
        "author or authors of this software dedicate any and all copyright interest in the software to the public domain. "
        "We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. "
        "We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to "
        "this software under copyright law. THE SOFTWARE IS PROVIDED AS IS, WITHOUT WARRANTY OF ANY KIND, EXPRESS OR "
        "IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND "
        "NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN "
        "ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER "
        "DEALINGS IN THE SOFTWARE. For more information, please refer to http://unlicense.org",
    ),
    (
        "Zlib",
        "This software is provided as-is, without any express or implied warranty. In no event will the authors be held "
        "liable for any damages arising from the use of this software. Permission is granted to anyone to use this software "
        "for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the "
        "following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you "
        "wrote the original software. If you use this software in a product, an acknowledgment in the product documentation "
        "would be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not "
        "be misrepresented as being the original software. 3. This notice may not be removed or altered from any source "
        "distribution.",
    ),
)


def template_bigrams(text: str) -> list[str]:
    """Distinct bigrams of a template, in order."""
    words = re.findall(r"[^\W_]+", text.lower())
    return list(dict.fromkeys(" ".join(pair) for pair in zip(words, words[1:], strict=False)))


def _units(text: str) -> Column:
    """Distinct lines, sentences and paragraphs."""
    lines = F.split(text, "\n")
    sentences = F.split(F.regexp_replace(text, r"([.!?;])\s+", "$1\n"), "\n")
    paragraphs = F.split(text, r"\n\s*\n")
    return F.array_distinct(F.concat(lines, sentences, paragraphs))


def _grams(words: str) -> Column:
    """All bigrams of two words or more, in order."""
    return F.expr(f"transform(sequence(0, size({words}) - 2), i -> concat_ws(' ', get({words}, i), get({words}, i + 1)))")


def _need(n_bigrams: int, threshold: float) -> int:
    """Bigrams of a template of so many that a passage at the threshold has at least."""
    return math.ceil(threshold / (2 - threshold) * n_bigrams - 1e-9)


def _anchors(threshold: float, templates: tuple[tuple[str, str], ...]) -> list[str]:
    """Bigrams of which a passage at the threshold has one, whichever template it is near."""
    anchors: dict[str, None] = {}
    for _, text in templates:
        bigrams = sorted(template_bigrams(text), key=lambda x: (-min(map(len, x.split())), -len(x), x))
        anchors |= dict.fromkeys(bigrams[: len(bigrams) - _need(len(bigrams), threshold) + 1])
    return list(anchors)


def _anchored(
    docs: DataFrame, threshold: float, templates: tuple[tuple[str, str], ...], texts: tuple[tuple[str, str], ...]
) -> DataFrame:
    """Documents that hold an anchor, with their ``__words`` and the places of the anchors: ``__at`` those of the
    templates, ``__long`` one of the texts."""
    row = ("__id", "__hash", "__text")
    split = computed(docs, "__words", folded_words("__text"), *row).where(F.size("__words") > 1)
    notices, long = _anchors(threshold, templates), _anchors(threshold, texts)

    # Single words first: most places end there, and no string is built for them.
    def is_in(anchors: list[str]):
        firsts, seconds = (set(x) for x in zip(*(x.split() for x in anchors), strict=True))

        def test(i: Column) -> Column:
            a, b = F.get("__words", i), F.get("__words", i + 1)
            return a.isin(*firsts) & b.isin(*seconds) & F.concat_ws(" ", a, b).isin(*anchors)

        return test

    places = F.sequence(F.lit(0), F.size("__words") - 2)
    marked = computed(split, "__all", F.filter(places, is_in(notices + long)), *row, "__words")
    marked = marked.where(F.size("__all") > 0)
    if not texts:
        return marked.withColumnRenamed("__all", "__at").withColumn("__long", F.lit(False))
    marked = computed(marked, "__at", F.filter("__all", is_in(notices)), *row, "__words", "__all")
    return marked.withColumn("__long", F.exists("__all", is_in(long))).drop("__all")


def _runs(anchored: DataFrame, threshold: float, templates: tuple[tuple[str, str], ...]) -> DataFrame:
    """Per first anchor and template the best run of consecutive words that reaches the threshold.

    ``__id``, ``__hash``, ``license``, ``__bigrams``, ``__dice``, ``__start``, ``__end`` (first and last bigram).
    """
    literal, reach = [], 0
    for name, text in templates:
        bigrams = template_bigrams(text)
        most = math.floor((2 - threshold) / threshold * (len(re.findall(r"[^\W_]+", text)) - 1) + 1e-9)
        reach = max(reach, most)
        literal.append(
            F.struct(
                F.lit(name).alias("name"),
                F.array(*map(F.lit, bigrams)).alias("bigrams"),
                F.lit(_need(len(bigrams), threshold)).alias("need"),
                F.lit(most).alias("most"),
            )
        )
    row = ("__id", "__hash")
    # Around each anchor the words that a run may take which has no anchor before it.
    around = F.expr(
        f"""transform(
            transform(__at, (p, k) -> struct(p, greatest(if(k = 0, 0, get(__at, k - 1) + 1), p - {reach - 1}) AS low)),
            x -> struct(x.low, x.p - x.low AS anchor, slice(__words, x.low + 1, x.p + {reach + 1} - x.low) AS words))"""
    )
    near = anchored.where(F.size("__at") > 0).select(*row, F.explode(around).alias("__x")).select(*row, "__x.low", "__x.anchor", "__x.words")
    near = computed(near, "__grams", _grams("words"), *row, "low", "anchor")
    near = near.select("*", F.explode(F.array(*literal)).alias("__t"))
    hits = F.expr(
        """filter(sequence(0, size(__grams) - 1), i -> i > anchor - __t.most AND i < anchor + __t.most
            AND array_contains(__t.bigrams, get(__grams, i)))"""
    )
    kept = (*row, "low", "anchor", "__grams", "__t")
    near = computed(near, "__hits", hits, *kept).where(
        """size(array_distinct(transform(__hits, i -> get(__grams, i)))) >= __t.need
            AND exists(__hits, i -> i <= anchor) AND exists(__hits, i -> i >= anchor)"""
    )
    # Each bigram by its first place, so that numbers are compared from here on.
    near = computed(near, "__first", F.expr("transform(__grams, x -> array_position(__grams, x))"), *kept, "__hits")
    near = near.withColumn("__known", F.expr("array_distinct(transform(__hits, i -> get(__first, i)))"))
    best = F.expr(
        """array_max(flatten(transform(filter(__hits, i -> i <= anchor), s -> transform(
            filter(__hits, i -> i >= anchor AND i - s < __t.most), e -> struct(
                2.0D * size(array_intersect(slice(__first, s + 1, e - s + 1), __known))
                    / (size(array_distinct(slice(__first, s + 1, e - s + 1))) + size(__t.bigrams)) AS dice,
                s - e AS shorter, s AS first, e AS last)))))"""
    )
    return (
        computed(near, "__best", best, *row, "low", "__grams", "__t")
        .where(F.col("__best.dice") >= threshold)
        .select(
            *row,
            F.col("__t.name").alias("license"),
            F.expr("array_distinct(slice(__grams, __best.first + 1, 1 - __best.shorter))").alias("__bigrams"),
            F.col("__best.dice").alias("__dice"),
            (F.col("low") + F.col("__best.first")).alias("__start"),
            (F.col("low") + F.col("__best.last")).alias("__end"),
        )
    )


def scan_licenses(
    docs: DataFrame,
    threshold: float = 0.8,
    templates: tuple[tuple[str, str], ...] = TEMPLATES,
    texts: tuple[tuple[str, str], ...] = TEXTS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``id_col``, ``license``, ``dice`` (best), ``n_matches`` (distinct passages that reach the threshold).

    A passage is a line, a sentence or a paragraph, or a run of consecutive words that none of these holds which
    reach the threshold themselves: line breaks and signs between its words do not count, it is at most
    (2 - t) / t times as long as the template, and of runs of one licence that overlap the best stands for all.
    The whole document is a passage too, and the only one, for ``texts``.
    Words are lower-cased runs of letters and digits, the coefficient is that of sets of bigrams. One row per
    document id and licence.

    Defined cases: a null or empty text, and a passage of fewer than two words, matches nothing; a passage may
    match several licences; rows of equal id count as one document (the passages of each row are counted); a
    null id is kept as one id; an empty table gives no rows.
    """
    known = [(name, template_bigrams(text)) for name, text in (*templates, *texts)]

    def bounds(of: list) -> tuple[int, int]:
        sizes = [len(bigrams) for _, bigrams in of] or [0]
        return math.ceil(threshold / (2 - threshold) * min(sizes)), math.floor((2 - threshold) / threshold * max(sizes))

    short, long = bounds(known[: len(templates)]), bounds(known[len(templates) :])
    names = F.array(*[F.lit(name) for name, _ in known])
    bigrams = F.array(*[F.array(*map(F.lit, x)) for _, x in known])
    sizes = F.array(
        *[F.struct(F.lit(k).alias("k"), F.lit(len(x)).alias("b"), F.lit(k >= len(templates)).alias("long"))
          for k, (_, x) in enumerate(known)]
    )
    any_bigram = F.array(*map(F.lit, dict.fromkeys(x for _, b in known[: len(templates)] for x in b)))
    rows = docs.select(F.col(id_col).alias("__id"), F.col(text_col).cast("string").alias("__text"))
    rows = _anchored(rows.withColumn("__hash", F.xxhash64("__text")), threshold, templates, texts)
    # The whole document, where it may be a licence text, and the shorter passages, where a notice may be.
    parts = F.when(F.size("__at") > 0, F.transform(_units("__text"), lambda x: F.struct(x.alias("u"), F.lit(False).alias("long"))))
    file = F.when(F.col("__long"), F.array(F.struct(F.col("__text").alias("u"), F.lit(True).alias("long"))))
    none = F.expr("slice(array(struct('' AS u, false AS long)), 1, 0)")
    units = rows.select("__id", "__hash", F.explode(F.concat(F.coalesce(parts, none), F.coalesce(file, none))).alias("__u"))
    units = units.select("__id", "__hash", F.col("__u.u").alias("__unit"), F.col("__u.long").alias("__whole"))
    # Distinct bigrams are at most one fewer than words; repeats within a passage can only lower them.
    row = ("__id", "__hash", "__whole")
    split = computed(units, "__words", folded_words("__unit"), *row).where(
        F.size("__words") > F.when(F.col("__whole"), long[0]).otherwise(short[0])
    )
    a, b = F.size("__bigrams"), F.col("__t.b")
    possible = F.when(F.col("__whole"), a.between(*long)).otherwise(
        a.between(*short) & F.arrays_overlap("__bigrams", any_bigram)
    )
    # Sizes decide which templates a passage meets; only then are bigrams looked up.
    met = (
        computed(split, "__bigrams", shingle_texts("__words", 2), *row)
        .where(possible)
        .select(*row, "__bigrams", F.explode(sizes).alias("__t"))
        .where(F.col("__whole") == F.col("__t.long"))
        .where((b >= a * threshold / (2 - threshold)) & (b <= a * (2 - threshold) / threshold))
    )
    dice = 2.0 * F.size(F.array_intersect("__bigrams", F.get(bigrams, F.col("__t.k")))) / (a + b)
    whole = (
        met.select("__id", "__hash", F.get(names, F.col("__t.k")).alias("license"), "__bigrams", dice.alias("__dice"))
        .where(F.col("__dice") >= threshold)
        .select("*", F.lit(None).cast("int").alias("__start"), F.lit(None).cast("int").alias("__end"))
    )
    rows = whole.unionByName(_runs(rows, threshold, templates)).withColumn("__bigrams", F.array_sort("__bigrams"))
    # What was found in one text: runs that overlap become the best of them, those inside a passage are left out.
    found = rows.groupBy("__id", "__hash", "license").agg(
        F.expr("collect_set(struct(__bigrams, __dice)) FILTER (WHERE __start IS NULL)").alias("__whole"),
        F.expr("collect_set(struct(__start, __end, __dice, __bigrams)) FILTER (WHERE __start IS NOT NULL)").alias("__runs"),
    )
    apart = F.expr(
        """aggregate(array_sort(__runs), slice(__runs, 1, 0), (some, r) -> CASE
            WHEN size(some) = 0 OR get(some, size(some) - 1).__end < r.__start THEN concat(some, array(r))
            WHEN struct(get(some, size(some) - 1).__dice, size(get(some, size(some) - 1).__bigrams))
                < struct(r.__dice, size(r.__bigrams)) THEN concat(slice(some, 1, size(some) - 1), array(r))
            ELSE some END)"""
    )
    found = computed(found, "__apart", apart, "__id", "license", "__whole")
    passages = F.expr(
        """concat(__whole, transform(
            filter(__apart, r -> NOT exists(__whole, u -> size(array_except(r.__bigrams, u.__bigrams)) = 0)),
            r -> struct(r.__bigrams, r.__dice)))"""
    )
    return (
        found.select("__id", "license", F.explode(passages).alias("__p"))
        .groupBy("__id", "license")
        .agg(F.max("__p.__dice").alias("dice"), F.count_distinct("__p.__bigrams").alias("n_matches"))
        .select(F.col("__id").alias(id_col), "license", "dice", "n_matches")
    )
