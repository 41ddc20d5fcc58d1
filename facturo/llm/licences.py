"""Licence scan by Dice coefficient over word bigrams (dealt operator 2; DataFrame operations only).

Each line, each sentence of a line of several, each paragraph of several lines
and the whole of a text is compared with every licence template whose size allows a match: with a and b
distinct bigrams, Dice can reach t only if a * t / (2 - t) <= b <= a * (2 - t) / t.
Texts are compared after the same normalisation: lower case, ``licence`` and
the copyright sign spelled one way, and anything but letters and digits a
break between words. A text needs one of a few words per template to reach t at all, which spares
most texts the comparison. The templates are a few kilobytes and stand in the plan
as a literal; nothing is shuffled.

One row per matching unit, with its best template (ties: the smaller id).
Cases: null and empty texts, and units of fewer than two words, match nothing;
repeated rows give repeated results; an empty table gives an empty result; a very
long text is read whole, its units in one row; other columns are not looked at.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Least Dice coefficient.
DICE = 0.8

# Public licence texts and notices, one or more per licence.
TEMPLATES: list[tuple[str, str]] = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "This project is licensed under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without limitation '
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
        "to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above "
        "copyright notice and this permission notice shall be included in all copies or substantial portions of the "
        'Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT '
        "LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT "
        "SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION "
        "OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER "
        "DEALINGS IN THE SOFTWARE.",
    ),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    (
        "Apache-2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance '
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    ),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    (
        "GPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any "
        "later version.",
    ),
    ("LGPL-3.0", "This library is licensed under the GNU Lesser General Public License, version 3."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"),
    (
        "BSD-3-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list "
        "of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright "
        "notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided "
        "with the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used "
        "to endorse or promote products derived from this software without specific prior written permission. THIS "
        'SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, '
        "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
        "DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
        "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR "
        "SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, "
        "WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE "
        "USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.",
    ),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC0-1.0", "This work is dedicated to the public domain under CC0 1.0 Universal."),
]
_WORD = r"[^\p{L}\p{N}]+"
_SENTENCE_END = r"[.!?]+[ \t]+"


def template_bigrams(text: str) -> list[str]:
    """Distinct bigrams of a template, by the rules of ``normalised_words``."""
    text = text.lower().replace("licence", "license").replace("©", " copyright ").replace("(c)", " copyright ")
    words = re.findall(r"[^\W_]+", text)
    return sorted({f"{a} {b}" for a, b in zip(words, words[1:], strict=False)})


def normalised_words(text: Column) -> Column:
    spelled = F.replace(F.replace(F.replace(F.lower(text), F.lit("licence"), F.lit("license")), F.lit("©"), F.lit(" copyright ")), F.lit("(c)"), F.lit(" copyright "))
    return F.filter(F.split(spelled, _WORD), lambda w: w != "")


def size_bounds(bigrams: int, dice: float = DICE) -> tuple[float, float]:
    """Least and most bigrams of a text that can reach ``dice`` against a template of ``bigrams``."""
    return bigrams * dice / (2 - dice), bigrams * (2 - dice) / dice


def gate_words(grams: tuple[str, ...], dice: float = DICE) -> set[str]:
    """Words of which any text that reaches ``dice`` has one.

    Dice of t needs at least t / (2 - t) of a template's bigrams, so a text
    that has none of the words of more than the rest cannot match.
    """
    missed = set(grams)
    most = len(grams) * (1 - dice / (2 - dice))
    chosen: set[str] = set()
    words = {w for g in grams for w in g.split()}
    while len(grams) - len(missed) <= most:
        held = lambda w: sum(w in g.split() for g in missed)
        best = max(words - chosen, key=lambda w: (held(w) > 0 and w != "copyright", "licens" in w, min(len(w), 9), held(w), w))
        chosen.add(best)
        missed = {g for g in missed if best not in g.split()}
    return chosen


def _gate_spellings(known: list[tuple[str, tuple[str, ...]]], dice: float) -> list[str]:
    """The gate words of all templates, in either spelling; a text that matches has one as a part of some word."""
    words = set().union(*(gate_words(grams, dice) for _, grams in known))
    # a word that has another as a part needs no test of its own
    words = {w for w in words if not any(x != w and x in w for x in words)}
    spellings = {v for w in words for v in ((w, "©", "(c)") if "copyright" in w else (w, w.replace("license", "licence")))}
    return sorted(spellings, key=lambda w: (len(w), w))


def _has_any(text: Column, parts: list[str]) -> Column:
    """Whether a text has one of ``parts`` after lower-casing."""
    lowered = F.lower(text)
    out = F.lit(False)
    for part in parts:
        out = out | F.contains(lowered, F.lit(part))
    return out


def bigrams(text: Column) -> Column:
    """Distinct word bigrams of a text."""
    words = normalised_words(text)
    pairs = F.transform(words, lambda w, i: F.struct(i.alias("i"), w.alias("w")))
    joined = F.zip_with(pairs, F.slice(words, F.lit(2), F.greatest(F.size(words), F.lit(1))), lambda a, b: F.when(b.isNotNull(), F.concat(a["w"], F.lit(" "), b)))
    return F.array_distinct(F.filter(joined, lambda x: x.isNotNull()))


def scan_licences(docs: DataFrame, dice: float = DICE, templates: list[tuple[str, str]] = TEMPLATES) -> DataFrame:
    """doc_id, scope, unit, license_id and dice (six places) per matching unit of ``docs`` (doc_id, text).

    scope is line, sentence (of a line of several; they end with ``.!?`` and a
    blank), paragraph (of several lines, in a text of several paragraphs) or
    text (of several lines); unit counts them from 0.
    """
    known = sorted({(name, tuple(template_bigrams(text))) for name, text in templates})
    known = [(name, grams) for name, grams in known if grams]
    bounds = [size_bounds(len(grams), dice) for _, grams in known]
    table = F.array(*[F.struct(F.lit(-i).alias("i"), F.lit(len(g)).alias("n"), F.array(*[F.lit(x) for x in g]).alias("grams")) for i, (_, g) in enumerate(known)])

    gates = _gate_spellings(known, dice)
    lines = F.split("text", r"\r?\n", -1)
    sentences = F.flatten(F.filter(F.transform(F.split(F.lower("text"), r"\r?\n", -1), lambda x: F.split(x, _SENTENCE_END, -1)), lambda x: F.size(x) > 1))
    has_gate = lambda u: F.exists(F.lit(gates), lambda g: F.contains(u["held"], g))
    blocks = F.split("text", r"\r?\n[ \t]*\r?\n", -1)
    unit = lambda scope: lambda x, i: F.struct(F.lit(scope).alias("scope"), i.alias("unit"), x.alias("held"))
    units = F.concat(
        F.transform(lines, unit("line")),
        F.filter(F.transform(sentences, unit("sentence")), has_gate),
        F.when(F.size(blocks) > 1, F.filter(F.transform(blocks, unit("paragraph")), lambda u: u["held"].contains("\n"))).otherwise(F.array()),
        F.when(F.col("text").contains("\n"), F.transform(F.array("text"), unit("text"))).otherwise(F.array()),
    )
    read = F.transform(units, lambda u: F.struct(u["scope"].alias("scope"), u["unit"].alias("unit"), bigrams(u["held"]).alias("grams")))
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).where("text is not null")
    base = base.where(_has_any(F.col("text"), gates))
    # the generator keeps each unit's bigrams as a value, so they are made once
    sized = base.select("doc_id", F.explode(read).alias("u")).where(F.size("u.grams").between(min(b[0] for b in bounds), max(b[1] for b in bounds)))
    n = F.size("u.grams")
    possible = F.filter(table, lambda t: (n >= t["n"] * (dice / (2 - dice))) & (n <= t["n"] * ((2 - dice) / dice)))
    scores = F.transform(possible, lambda t: F.struct((2 * F.size(F.array_intersect(t["grams"], F.col("u.grams"))) / (n + t["n"])).alias("dice"), t["i"].alias("i")))
    best = sized.select("doc_id", "u.scope", "u.unit", F.explode(F.array(F.array_max(scores))).alias("best")).where(F.col("best.dice") >= dice)
    names = F.lit([name for name, _ in known])
    return best.select("doc_id", "scope", "unit", F.element_at(names, 1 - F.col("best.i")).alias("license_id"), F.round("best.dice", 6).alias("dice"))


def licence_sql(dice: float = DICE, templates: list[tuple[str, str]] = TEMPLATES) -> str:
    """The same scan over a view ``documents`` in DuckDB's SQL."""
    quote = lambda x: "'" + x.replace("'", "''") + "'"
    known = sorted({(name, tuple(template_bigrams(text))) for name, text in templates})
    values = ", ".join(f"({i}, {quote(name)}, [{', '.join(map(quote, g))}])" for i, (name, g) in enumerate(known))
    return rf"""
with t(i, license_id, grams) as (values {values}),
d as (select doc_id, text, string_split_regex(text, '\r?\n') lines, string_split_regex(text, '\r?\n[ \t]*\r?\n') blocks from documents where text is not null),
u as (
  select doc_id, 'line' scope, unnest(range(len(lines)))::int unit, unnest(lines) held from d
  union all select doc_id, 'sentence', unnest(range(len(sentences)))::int, unnest(sentences) from (
    select doc_id, flatten(list_filter(list_transform(lines, lambda x: string_split_regex(x, '{_SENTENCE_END}')), lambda x: len(x) > 1)) sentences from d)
  union all select * from (select doc_id, 'paragraph', unnest(range(len(blocks)))::int, unnest(blocks) held from d where len(blocks) > 1) where contains(held, chr(10))
  union all select doc_id, 'text', 0, text from d where contains(text, chr(10))
),
w as (select doc_id, scope, unit, list_filter(string_split_regex(replace(replace(replace(lower(held), 'licence', 'license'), '©', ' copyright '), '(c)', ' copyright '), '[^\p{{L}}\p{{N}}]+'), lambda x: x <> '') words from u),
b as (select doc_id, scope, unit, list_distinct(list_transform(range(1, len(words)), lambda k: words[k] || ' ' || words[k + 1])) grams from w where len(words) > 1),
s as (
  select doc_id, scope, unit, license_id, i, 2 * len(list_intersect(b.grams, t.grams)) / (len(b.grams) + len(t.grams)) dice
  from b join t on len(b.grams) >= len(t.grams) * {dice / (2 - dice)} and len(b.grams) <= len(t.grams) * {(2 - dice) / dice}
)
select doc_id, scope, unit, license_id, round(dice, 6) dice
from (select *, row_number() over (partition by doc_id, scope, unit order by dice desc, i) rk from s) where rk = 1 and dice >= {dice}
"""
