"""License scans: Dice coefficient of word bigrams against licence templates.

A unit (a line, a whole text, or a window of as many words as the template has) is normalised to
lower-case words; its set of word bigrams is compared with a template's by 2 * common / (sizes
added). A Dice of ``least`` needs a size between ``least / (2 - least)`` and its inverse times the
template's, so other templates are not compared. It also needs that share of the template's
bigrams, which gives the two bounds that spare most texts and windows: a text must hold enough of
the template's words, and a window enough places of its bigrams. Windows begin at such places,
wherever lines break, so a notice inside a longer line or wrapped over several lines is found.
"""

import math
import re
from collections import Counter

from pyspark.sql import functions as F

from txlens.llm.textkit import once
from txlens.staging import stage

#: Wording of public licence notices.
TEMPLATES = {
    "MIT": "Released under the MIT License.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "MIT-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
                 "and associated documentation files (the \"Software\"), to deal in the Software without restriction",
    "Apache-2.0-header": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file "
                         "except in compliance with the License.",
    "BSD-grant": "Redistribution and use in source and binary forms, with or without modification, are permitted "
                 "provided that the following conditions are met",
    "MIT-text":
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
        "Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
        "conditions: The above copyright notice and this permission notice shall be included in all copies or "
        "substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS "
        "OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE "
        "AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR "
        "OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION "
        "WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    "ISC-text":
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies. THE "
        "SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING "
        "ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, "
        "DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR "
        "PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN "
        "CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    "BSD-2-Clause-text":
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, "
        "this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the "
        "above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other "
        "materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "
        "\"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF "
        "MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR "
        "CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES "
        "(INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR "
        "BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR "
        "TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF "
        "THE POSSIBILITY OF SUCH DAMAGE.",
    "Apache-2.0-notice":
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless "
        "required by applicable law or agreed to in writing, software distributed under the License is distributed on "
        "an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for "
        "the specific language governing permissions and limitations under the License.",
    "GPL-3.0-notice":
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY "
        "WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the "
        "GNU General Public License for more details. You should have received a copy of the GNU General Public License "
        "along with this program. If not, see https://www.gnu.org/licenses/.",
}
#: What ``line`` says of a whole text and of a window.
WHOLE, WINDOW = -1, -2


def _normal(text):
    return F.regexp_replace(F.lower(text), "[^\\p{L}\\p{N}\\n]+", " ")


def _words(unit):
    return F.filter(F.split(unit, " "), lambda w: w != "")


def _bigrams(words):
    return F.array_distinct(F.transform(
        F.sequence(F.lit(0), F.size(words) - 2),
        lambda i: F.concat_ws(" ", F.get(words, i), F.get(words, i + 1))))


def _template_words(text):
    return re.sub(r"[\W_]+", " ", text.lower()).split()


def template_bigrams(templates):
    """Name and sorted bigrams of each template with two words or more."""
    out = {}
    for name, text in templates.items():
        words = _template_words(text)
        if len(words) > 1:
            out[name] = sorted({f"{a} {b}" for a, b in zip(words, words[1:])})
    return out


def template_lengths(templates):
    """Name and number of words of each template with two words or more."""
    return {name: n for name, n in ((name, len(_template_words(text))) for name, text in templates.items()) if n > 1}


def _needed(bigrams, share):
    """How many of its bigrams, and of its distinct words, a text with a match must hold at least.

    A word that is missing costs the bigrams it stands in, and a bigram has two words at most.
    """
    common = math.ceil(share * len(bigrams) - 1e-9)
    uses = Counter(word for bigram in bigrams for word in set(bigram.split()))
    spare, missing = 2 * (len(bigrams) - common), 0
    for amount in sorted(uses.values()):
        spare -= amount
        if spare < 0:
            break
        missing += 1
    return common, sorted(uses), len(uses) - missing


def _strings(values):
    return F.array(*[F.lit(x) for x in values])


def _windows(pairs, t, least):
    """The best window of template ``t``: its negated Dice and first word, the least of all; null if none reaches ``least``."""
    places = F.filter(F.transform(pairs, lambda x, i: F.when(F.array_contains(t["bigrams"], x), i)), lambda i: i.isNotNull())

    def among(at):
        # the window must hold the common bigrams: the place so many places on lies in it
        starts = F.filter(F.transform(at, lambda i, k: F.when(F.get(at, k + t["common"] - 1) < i + t["length"] - 1, i)),
                          lambda i: i.isNotNull())

        def compared(i):
            return once(F.slice(pairs, i + 1, t["length"] - 1), lambda window: F.struct(
                (-2.0 * F.size(F.array_intersect(window, t["bigrams"]))
                 / (F.size(F.array_distinct(window)) + F.size(t["bigrams"]))).alias("least"), i.alias("word")))

        return F.array_min(F.filter(F.transform(starts, compared), lambda w: w["least"] <= -least))

    return once(places, among)


def license_hits(docs, templates=None, least=0.8):
    """``doc_id, line, word, license, dice`` of every unit that reaches ``least`` with a template.

    ``line`` counts from 0; -1 is the whole text (only for texts of several lines), -2 a window,
    whose first word in the text is ``word`` (from 0; null for the other units). Of the windows
    of a text and template only the best is given, the first one if several are, and none where a
    line or the whole text of the doc_id matches that template. Null, empty and one-word units
    match nothing. Rows that repeat give repeated hits.
    """
    texts = TEMPLATES if templates is None else templates
    known, lengths = template_bigrams(texts), template_lengths(texts)
    share = least / (2 - least)
    low = min((len(b) for b in known.values()), default=0) * share
    high = max((len(b) for b in known.values()), default=0) / share
    needed = {name: _needed(b, share) for name, b in known.items()}
    listed = F.array(*[F.struct(F.lit(n).alias("name"), _strings(b).alias("bigrams"), F.lit(lengths[n]).alias("length"),
                                F.lit(needed[n][0]).alias("common"), _strings(needed[n][1]).alias("words"),
                                F.lit(needed[n][2]).alias("enough")) for n, b in known.items()])
    anything = _strings(sorted({x for b in known.values() for x in b}))
    vocabulary = _strings(sorted({x for _, words, _ in needed.values() for x in words}))
    fewest = min((enough for _, _, enough in needed.values()), default=1)

    def perhaps(t, held):
        return F.size(F.array_intersect(held, t["words"])) >= t["enough"]

    df = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                     _normal(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("body"))
    if not known:
        listed = None
        df = df.where(F.lit(False))
    body_words = _words(F.translate("body", "\n", " "))
    if listed is None:
        return df.select("doc_id", F.lit(0).alias("line"), F.lit(0).alias("word"), F.lit("").alias("license"), F.lit(0.0).alias("dice"))
    def possible(held):
        return F.when(F.size(held) >= fewest, F.transform(F.filter(listed, lambda t: perhaps(t, held)), lambda t: t["name"]))

    # bound, or the words would be split again for every template
    names = once(F.array_intersect(body_words, vocabulary), possible)
    # the few texts that may match are written, as lines and windows are both looked at
    df = stage(df.withColumn("names", names).where(F.size("names") > 0).select("doc_id", "body", "names"))
    df = df.select("doc_id", "body", F.filter(listed, lambda t: F.array_contains("names", t["name"])).alias("fit"))

    # whole texts and lines
    lines = F.split("body", "\n")
    whole = F.when(F.size(lines) > 1, F.array(F.struct(F.lit(WHOLE).alias("line"), F.translate("body", "\n", " ").alias("unit"))))
    units = F.concat(F.coalesce(whole, F.array().cast("array<struct<line:int,unit:string>>")),
                     F.transform(lines, lambda x, i: F.struct(i.alias("line"), x.alias("unit"))))
    # a set of bigrams is no larger than the number of words less one
    sized = F.transform(units, lambda u: once(_words(u["unit"]), lambda w: F.when(
        F.size(w) - 1 >= max(low, 1), F.struct(u["line"].alias("line"), _bigrams(w).alias("bigrams")))))
    fitting = F.filter(sized, lambda x: x.isNotNull() & F.size(x["bigrams"]).between(low, high)
                       & F.arrays_overlap(x["bigrams"], anything))
    plain = df.select("doc_id", "fit", F.explode(fitting).alias("u")).select("doc_id", "fit", "u.*")
    plain = plain.select("doc_id", "line", "bigrams", F.explode(F.filter("fit", lambda t: F.size("bigrams").between(
        F.size(t["bigrams"]) * share, F.size(t["bigrams"]) / share))).alias("t"))
    common = F.size(F.array_intersect("bigrams", "t.bigrams"))
    dice = 2.0 * common / (F.size("bigrams") + F.size("t.bigrams"))
    plain = plain.select("doc_id", "line", F.lit(None).cast("int").alias("word"), F.col("t.name").alias("license"),
                         dice.alias("dice")).where(F.col("dice") >= least)

    # windows, in the order of the words of the whole text
    def best(words):
        pairs = F.transform(F.slice(words, 1, F.greatest(F.size(words) - 1, F.lit(0))),
                            lambda w, i: F.concat_ws(" ", w, F.get(words, i + 1)))
        return once(pairs, lambda p: F.transform("fit", lambda t: F.struct(
            t["name"].alias("name"), _windows(p, t, least).alias("best"))))

    inside = df.select("doc_id", F.explode(once(body_words, best)).alias("w")).where("w.best is not null")
    inside = inside.select("doc_id", F.lit(WINDOW).alias("line"), F.col("w.best.word").alias("word"),
                           F.col("w.name").alias("license"), (-F.col("w.best.least")).alias("dice"))
    matched = plain.select(F.col("doc_id").alias("_id"), F.col("license").alias("_license")).distinct()
    inside = inside.join(matched, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("license") == F.col("_license")), "left_anti")
    return plain.unionByName(inside)


def licenses(docs, **options):
    """One row per document: doc_id, n_hits, license, line, word and dice of the best hit (nulls: none).

    The best is the highest Dice, then the first name, then a line or whole text before a window,
    then the first line. Repeated rows of a doc_id give one row.
    """
    hits = license_hits(docs, **options).distinct()
    best = hits.groupBy("doc_id").agg(
        F.count("*").alias("n_hits"),
        F.min(F.struct((-F.col("dice")).alias("least"), "license", (F.col("line") == WINDOW).alias("inside"),
                       "line", "word")).alias("best"))
    ids = docs.select(F.col("doc_id").cast("long").alias("id")).distinct()
    joined = ids.join(best, F.col("id").eqNullSafe(F.col("doc_id")), "left")
    return joined.select(F.col("id").alias("doc_id"), F.coalesce("n_hits", F.lit(0)).cast("long").alias("n_hits"),
                         F.col("best.license").alias("license"), F.col("best.line").alias("line"),
                         F.col("best.word").alias("word"), (-F.col("best.least")).alias("dice"))
