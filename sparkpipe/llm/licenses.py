"""Licence scans by TF-IDF cosine to templates, inherited along directories; DataFrame functions only.

Headers are lines, sentences that may wrap over lines, and blocks between empty lines; the
leaders of comments are taken off.  Licence files are whole texts, or texts that begin with
the title block of a licence too long to be a template.  Each is a sparse vector of the
words of the templates, weighted by how rare a word is over all documents, plus one weight
for the words that no template has.  A text can only reach the threshold if it holds one of
the rare words that carry a template (the rest of the template's weight falls short of it),
so the other texts are ruled out by their words alone, without loss.  A licence file
licenses its directory; a document without a licence of its own takes that of its nearest
ancestor directory that has one, by joins on the paths.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import doc_key, key_id, text_of

THRESHOLD = 0.8
#: Public notices, title blocks and licence texts, by SPDX identifier.
NOTICES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("MIT", "Released under the MIT License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("BSD-2-Clause", "Released under the BSD 2-Clause License."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "Dedicated to the public domain under CC0 1.0 Universal."),
    ("ISC", "Released under the ISC License."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("Apache-2.0", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file
        except in compliance with the License. You may obtain a copy of the License at
        http://www.apache.org/licenses/LICENSE-2.0"""),
    ("Apache-2.0", """Unless required by applicable law or agreed to in writing, software distributed under the
        License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or
        implied. See the License for the specific language governing permissions and limitations under the License."""),
    *((name, f"""This {what} is free software{mark} you can redistribute it and/or modify it under the terms of the
        {title} as published by the Free Software Foundation{either} version {version} of the License, or (at your
        option) any later version.""")
      for name, what, title, mark, either, version in (
          ("GPL-2.0", "program", "GNU General Public License", ";", "; either", "2"),
          ("GPL-3.0", "program", "GNU General Public License", ":", ", either", "3"),
          ("LGPL-3.0", "library", "GNU Lesser General Public License", ":", ", either", "3"),
          ("AGPL-3.0", "program", "GNU Affero General Public License", ":", ", either", "3"))),
    ("MPL-2.0", """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of
        the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."""),
]
_COPYING = """Everyone is permitted to copy and distribute verbatim copies of this license document, but changing it
    is not allowed."""
#: Title blocks: the first lines of licence files.
TITLES = [
    ("Apache-2.0", """Apache License Version 2.0, January 2004 http://www.apache.org/licenses/
        TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION"""),
    ("GPL-2.0", f"""GNU GENERAL PUBLIC LICENSE Version 2, June 1991 Copyright (C) 1989, 1991 Free Software Foundation,
        Inc., 51 Franklin Street, Fifth Floor, Boston, MA 02110-1301 USA {_COPYING}"""),
    ("GPL-3.0", f"GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007 Copyright (C) 2007 Free Software Foundation, Inc. <http://fsf.org/> {_COPYING}"),
    ("LGPL-3.0", f"GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007 Copyright (C) 2007 Free Software Foundation, Inc. <http://fsf.org/> {_COPYING}"),
    ("AGPL-3.0", f"GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007 Copyright (C) 2007 Free Software Foundation, Inc. <http://fsf.org/> {_COPYING}"),
    ("MPL-2.0", "Mozilla Public License Version 2.0 1. Definitions"),
    ("CC0-1.0", "Creative Commons Legal Code CC0 1.0 Universal"),
    ("CC-BY-4.0", "Creative Commons Attribution 4.0 International Public License"),
    ("CC-BY-SA-4.0", "Creative Commons Attribution-ShareAlike 4.0 International Public License"),
    ("CC-BY-NC-4.0", "Creative Commons Attribution-NonCommercial 4.0 International Public License"),
]
_PERMISSION = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
    associated documentation files (the "Software"), to deal in the Software without restriction, including without
    limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the
    Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
    The above copyright notice and this permission notice shall be included in all copies or substantial portions of
    the Software."""
_AS_IS = """THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED
    TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
    AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT,
    TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
    SOFTWARE."""
_REDISTRIBUTION = """Redistribution and use in source and binary forms, with or without modification, are permitted
    provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright
    notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the
    above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other
    materials provided with the distribution."""
_ENDORSE = """3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or
    promote products derived from this software without specific prior written permission."""
_BSD_AS_IS = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED
    WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR
    PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT,
    INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE
    GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF
    LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY
    OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
#: Whole licences of moderate length; parts of them are notices too.
TEXTS = [
    ("MIT", f"MIT License {_PERMISSION} {_AS_IS}"),
    ("MIT", _PERMISSION),
    ("BSD-2-Clause", f"{_REDISTRIBUTION} {_BSD_AS_IS}"),
    ("BSD-2-Clause", _REDISTRIBUTION),
    ("BSD-3-Clause", f"{_REDISTRIBUTION} {_ENDORSE} {_BSD_AS_IS}"),
    ("BSD-3-Clause", f"{_REDISTRIBUTION} {_ENDORSE}"),
    ("ISC", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is
        hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE
        SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL
        IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL,
        DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR
        PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION
        WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""),
    ("Unlicense", """This is free and unencumbered software released into the public domain. Anyone is free to copy,
        modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled
        binary, for any purpose, commercial or non-commercial, and by any means. In jurisdictions that recognize
        copyright laws, the author or authors of this software dedicate any and all copyright interest in the software
        to the public domain. We make this dedication for the benefit of the public at large and to the detriment of
        our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all
        present and future rights to this software under copyright law. """ + _AS_IS),
]
#: (licence, is it a title block, text).
TEMPLATES = [(name, form, text) for form, of in ((False, NOTICES), (True, TITLES), (False, TEXTS)) for name, text in of]
#: Title blocks are looked for in the first lines that are not empty, so many at a time.
HEADS = (2, 3, 4, 5, 6, 8)
_SPLIT = "[^a-z0-9]+"
#: What may begin and end a line of a comment, besides spaces.
_LEADER = r"(?m)^[ \t\r*#;%/<!-]+|[ \t\r*/>-]+$"


def words_of(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), _SPLIT), lambda w: w != "")


def template_words(templates: list[tuple[str, bool, str]]) -> list[tuple[int, str, int]]:
    """(number of the template, word, times): a fixed, small table."""
    out: dict[tuple[int, str], int] = {}
    for number, (_, _, text) in enumerate(templates):
        for w in re.split(_SPLIT, text.lower()):
            if w:
                out[number, w] = out.get((number, w), 0) + 1
    return [(number, w, n) for (number, w), n in sorted(out.items())]


def inverse_frequencies(docs: DataFrame, words: list[str], text_col: str = "text") -> dict[str, float]:
    """ln((1 + N) / (1 + df)) + 1 of each template word over all documents."""
    known = F.array(*map(F.lit, words))
    found = docs.select(F.array_intersect(F.split(F.lower(text_of(text_col)), _SPLIT), known).alias("w"))
    counts = found.select(F.explode(F.concat("w", F.array(F.lit("")))).alias("w")).groupBy("w").agg(F.count("*").alias("n"))
    df = {r["w"]: r["n"] for r in counts.collect()}  # a row per template word, and '' for all documents
    n_docs = df.get("", 0)
    return {w: math.log((1 + n_docs) / (1 + df.get(w, 0))) + 1 for w in words}


def anchors(words: list[tuple[int, str, int]], idf: dict[str, float], threshold: float) -> list[str]:
    """Words such that a text with none of them stays below ``threshold`` to every template.

    Of each template the heaviest words, those that shorter templates took among them.
    """
    by: dict[int, list[tuple[float, str]]] = {}
    for number, w, n in words:
        by.setdefault(number, []).append(((n * idf[w]) ** 2, w))
    out: set[str] = set()
    for parts in sorted(by.values(), key=len):
        total = sum(x for x, _ in parts)
        rest = sum(x for x, w in parts if w not in out)
        for x, w in sorted(parts, reverse=True):
            if rest < 0.999 * threshold**2 * total:
                break
            if w not in out:
                out.add(w)
                rest -= x
    return sorted(out)


def _best(spark: SparkSession, units: DataFrame, templates: list, words: list, idf: dict, threshold: float) -> DataFrame:
    """unit columns doc, unit, body -> doc, unit, licence, title, score of the best template at the threshold."""
    oov = sum(idf.values()) / len(idf)
    norms: dict[int, float] = {}
    for number, w, n in words:
        norms[number] = norms.get(number, 0.0) + (n * idf[w]) ** 2
    weights = spark.createDataFrame([(w, number, n * idf[w] / norms[number] ** 0.5) for number, w, n in words],
                                    "word string, template int, weight double")
    rarity = spark.createDataFrame(list(idf.items()), "word string, idf double")
    terms = units.select("doc", "unit", F.explode(words_of(F.col("body"))).alias("word")) \
        .groupBy("doc", "unit", "word").agg(F.count("*").alias("tf")) \
        .join(F.broadcast(rarity), "word", "left")  # fixed size: the templates' words
    norm = F.sqrt(F.sum(F.pow(F.col("tf") * F.coalesce("idf", F.lit(oov)), F.lit(2))))
    lengths = terms.groupBy("doc", "unit").agg(norm.alias("norm"))
    dots = terms.where("idf is not null").join(F.broadcast(weights), "word") \
        .groupBy("doc", "unit", "template").agg(F.sum(F.col("tf") * F.col("idf") * F.col("weight")).alias("dot"))
    scored = dots.join(lengths, ["doc", "unit"]).withColumn("score", F.round(F.col("dot") / F.col("norm"), 6)) \
        .where(F.col("score") >= threshold)
    forms = F.array(*(F.struct(F.lit(name).alias("licence"), F.lit(title).alias("title")) for name, title, _ in templates))
    form = F.get(forms, F.col("template"))
    return scored.groupBy("doc", "unit").agg(F.max(F.struct("score", form["licence"].alias("licence"), form["title"].alias("title"))).alias("b")) \
        .select("doc", "unit", "b.licence", "b.title", "b.score")


def _pieces(body: Column) -> Column:
    """The different lines of a text, its blocks between empty lines, and their sentences, wrapped or not."""
    blocks = F.split(F.regexp_replace(body, _LEADER, ""), "\n\n+")
    sentences = F.flatten(F.transform(blocks, lambda b: F.split(b, r"(?<=[.!?])\s+")))
    return F.array_distinct(F.concat(F.split(body, "\n"), blocks, sentences))


def matches(docs: DataFrame, templates: list[tuple[str, bool, str]] = TEMPLATES, threshold: float = THRESHOLD,
            id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc, unit, licence, title, score: unit is the number of a piece, -1 for a whole text, -k for its first k lines.

    ``title`` tells whether the template is a title block.  Ties between templates go to the
    name that sorts last.
    """
    spark = docs.sparkSession
    words = template_words(templates)
    idf = inverse_frequencies(docs, sorted({w for _, w, _ in words}), text_col)
    keys = anchors(words, idf, threshold)
    some = F.array(*map(F.lit, keys)).cast("array<string>")

    def may_match(body: str) -> Column:
        return F.arrays_overlap(F.split(F.lower(body), _SPLIT), some)

    rows = docs.select(doc_key(id_col, text_col).alias("doc"), text_of(text_col).alias("body")).where(may_match("body"))
    first = F.slice(F.filter(F.split("body", "\n"), lambda line: F.trim(line) != ""), 1, max(HEADS))
    heads = [F.struct(F.lit(-k).alias("unit"), F.array_join(F.slice(first, 1, k), "\n").alias("body")) for k in HEADS]
    whole = F.struct(F.lit(-1).alias("unit"), F.col("body").alias("body"))
    pieces = F.transform(_pieces(F.col("body")), lambda piece, i: F.struct(i.alias("unit"), piece.alias("body")))
    units = rows.select("doc", F.inline(F.concat(F.array(whole, *heads), pieces))).where(may_match("body"))
    # one exchange: all that follows groups by document and unit at least
    return _best(spark, units.repartition("doc", "unit").distinct(), templates, words, idf, threshold)


def _folders(path: Column) -> Column:
    """All ancestor directories of a path, the root ('') first."""
    parts = F.split(path, "/")
    return F.transform(F.sequence(F.lit(0), F.size(parts) - 1), lambda i: F.array_join(F.slice(parts, 1, i), "/"))


def licence_scan(docs: DataFrame, path: Column, templates: list[tuple[str, bool, str]] = TEMPLATES,
                 threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc, path, licence, score, origin, folder.

    ``origin`` is 'file' when the whole text is a licence or begins with the title of one,
    'header' when a line, sentence or block is, 'folder' when the licence comes from the
    nearest ancestor ``folder`` with a licence file, else null.  Texts of any length are read whole.  The best score counts, then the licence that sorts last; of a folder's licence files the
    best score, then the name that sorts last.  Null text is empty, a null path has no
    ancestors; rows that share an id share their licence; other columns play no part; an
    empty table gives an empty result.
    """
    found = matches(docs, templates, threshold, id_col, text_col)
    is_file = (F.col("unit") == -1) | ((F.col("unit") < 0) & F.col("title"))
    own = found.groupBy("doc").agg(
        F.max(F.when(is_file, F.struct("score", "licence"))).alias("file"),
        F.max(F.when(~is_file, F.struct("score", "licence"))).alias("header"))
    every = docs.select(doc_key(id_col, text_col).alias("doc"), path.cast("string").alias("path")) \
        .withColumn("home", F.regexp_replace("path", "/?[^/]*$", "")).join(own, "doc", "left")
    licensed = every.where("file is not null and path is not null").groupBy("home").agg(F.max("file").alias("given")) \
        .select(F.col("home").alias("folder"), "given")
    homes = every.where("path is not null").select("home").distinct()
    up = homes.select("home", F.explode(_folders(F.concat(F.col("home"), F.when(F.col("home") != "", F.lit("/x")).otherwise(F.lit("x"))))).alias("folder"))
    depth = F.size(F.split("folder", "/")) + F.when(F.col("folder") != "", 1).otherwise(0)
    nearest = up.join(licensed, "folder").groupBy("home").agg(
        F.max(F.struct(depth.alias("depth"), F.col("folder"), F.col("given"))).alias("n")) \
        .select("home", F.col("n.folder").alias("folder"), F.col("n.given").alias("given"))
    best = F.coalesce("file", "header", "given")
    return every.join(nearest, "home", "left").select(
        "doc", "path", best["licence"].alias("licence"), best["score"].alias("score"),
        F.when(F.col("file").isNotNull(), "file").when(F.col("header").isNotNull(), "header")
        .when(F.col("given").isNotNull(), "folder").alias("origin"),
        F.when(F.col("file").isNull() & F.col("header").isNull(), F.col("folder")).alias("folder"))


def licence_report(docs: DataFrame, path: Column, **options) -> DataFrame:
    """``licence_scan`` with the document's id."""
    return licence_scan(docs, path, **options).select(
        key_id("doc").alias("doc_id"), "path", "licence", "score", "origin", "folder")
