"""Licence files and headers as they are in the wild; every cosine by brute force."""

import math
import re
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from sparkpipe.llm import licenses
from sparkpipe.llm.common import prepare

SYSTEM = Path("/usr/share/common-licenses")
MIT, BSD2, BSD3 = (max((t for n, _, t in licenses.TEMPLATES if n == name), key=len) for name in ("MIT", "BSD-2-Clause", "BSD-3-Clause"))


def wrapped(text, width=70, lead=""):
    lines, line = [], ""
    for w in text.split():
        if len(line) + len(w) > width:
            lines.append(lead + line.strip())
            line = ""
        line += " " + w
    return "\n".join([*lines, lead + line.strip()])


GPL3 = """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General
Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."""
APACHE = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with
the License. You may obtain a copy of the License at"""
GPL2_FILE = """                    GNU GENERAL PUBLIC LICENSE
                       Version 2, June 1991

 Copyright (C) 1989, 1991 Free Software Foundation, Inc.,
 51 Franklin Street, Fifth Floor, Boston, MA 02110-1301 USA
 Everyone is permitted to copy and distribute verbatim copies
 of this license document, but changing it is not allowed.

                            Preamble
"""
SHELL = "\n".join(f"mkdir -p out{i} && cp input{i} out{i}/data{i} || exit {i}" for i in range(30))
JAVA = "class A {\n" + "\n".join(f"  int field{i} = compute{i}(left{i}, right{i});" for i in range(40)) + "\n}\n"
PROSE = "Rain fell on the harbour while the crews mended nets and talked of the season to come. "


def report(spark, rows):
    docs = prepare(spark).createDataFrame([(i, *r) for i, r in enumerate(rows)], "doc_id long, text string, file string, doc string, unit string")
    return {r["doc_id"]: (r["licence"], r["origin"]) for r in licenses.licence_report(docs, F.col("file")).collect()}


def test_licence_files_and_wrapped_headers(spark):
    rows = [
        ("MIT License\n\nCopyright (c) 2019 Ada Example\n\n" + wrapped(MIT.removeprefix("MIT License ")), "a/LICENSE"),
        ("print('hello')", "a/src/main.py"),
        ("Copyright 2021, The Example Authors.\nAll rights reserved.\n\n" + wrapped(BSD3), "b/LICENSE"),
        ("x = 1", "b/lib/x.py"),
        ("Copyright 2021, The Example Authors.\n\n" + wrapped(BSD2), "c/LICENSE"),
        (GPL2_FILE + PROSE * 400, "d/COPYING"),
        ("int main() { return 0; }", "d/src/main.c"),
        ("#!/bin/sh\n#\n# A tool by Someone.\n#\n" + wrapped(GPL3, 60, "# ") + "\n#\n# Nothing more.\n" + SHELL, "e/run.sh"),
        ("/*\n * Copyright 2020 Someone\n *\n" + wrapped(APACHE, 60, " * ") + "\n *\n */\n" + JAVA, "f/A.java"),
        (PROSE * 3 + "Released under\nthe MIT\nLicense. " + PROSE, "g/note.txt"),
        (PROSE * 20_000 + "\n\n" + wrapped(GPL3) + "\n\n" + PROSE * 20_000, "h/long.txt"),
        (PROSE + "The software that the terms cover is sold as is.", "h/clean.txt"),
    ]
    got = report(spark, [(*r, "doc", "unit") for r in rows])
    assert got == {0: ("MIT", "file"), 1: ("MIT", "folder"), 2: ("BSD-3-Clause", "file"), 3: ("BSD-3-Clause", "folder"),
                   4: ("BSD-2-Clause", "file"), 5: ("GPL-2.0", "file"), 6: ("GPL-2.0", "folder"), 7: ("GPL-3.0", "header"),
                   8: ("Apache-2.0", "header"), 9: ("MIT", "header"), 10: ("GPL-3.0", "header"), 11: (None, None)}


@pytest.mark.skipif(not SYSTEM.is_dir(), reason="no licence files on this system")
def test_licence_files_of_this_system(spark):
    names = {"Apache-2.0": "Apache-2.0", "GPL-2": "GPL-2.0", "GPL-3": "GPL-3.0", "LGPL-3": "LGPL-3.0", "MPL-2.0": "MPL-2.0",
             "CC0-1.0": "CC0-1.0", "BSD": "BSD-3-Clause"}
    there = [n for n in names if (SYSTEM / n).is_file()]
    rows = [row for n in there for row in (((SYSTEM / n).read_text(), f"{n}/LICENSE", "", ""), ("words", f"{n}/a/b.c", "", ""))]
    got = report(spark, rows)
    assert [(got[2 * i], got[2 * i + 1]) for i in range(len(there))] == [((names[n], "file"), (names[n], "folder")) for n in there]


def words(text):
    return Counter(w for w in re.split("[^a-z0-9]+", text.lower()) if w)


def test_scores_equal_brute_force(spark):
    texts = [GPL2_FILE, MIT, f"{PROSE}\n{PROSE}", "# " + wrapped(APACHE, 40, "# "), f"{PROSE}Released under\nthe ISC License. {PROSE}", "", None,
             "Licensed under the Apache License\n\n" + wrapped(GPL3, 50), "the license of the work", "software software software", BSD2 + BSD3,
             "Licensed under CC BY-SA 4.0.\nLicensed under CC BY-SA 4.0.\nReleased under the BSD 2-Clause License."]
    docs = prepare(spark).createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc"]: r["score"] for r in licenses.matches(docs).groupBy("doc").agg(F.max("score").alias("score")).collect()}
    templates = [words(t) for _, _, t in licenses.TEMPLATES]
    known = set().union(*templates)
    df = Counter(w for t in texts for w in set(words(t or "")) & known)
    idf = {w: math.log((1 + len(texts)) / (1 + df[w])) + 1 for w in known}
    rare = sum(idf.values()) / len(idf)

    def cosine(v, t):
        dot = sum(n * idf[w] * t[w] * idf[w] for w, n in v.items() if w in t)
        norms = [math.sqrt(sum((n * idf.get(w, rare)) ** 2 for w, n in x.items())) for x in (v, t)]
        return dot / (norms[0] * norms[1]) if v else 0.0
    want = {}
    for i, text in enumerate(texts):
        body = text or ""
        blocks = re.split("\n\n+", re.sub(licenses._LEADER, "", body))
        first = [line for line in body.split("\n") if line.strip()]
        pieces = [body, *body.split("\n"), *blocks, *(s for b in blocks for s in re.split(r"(?<=[.!?])\s+", b)),
                  *("\n".join(first[:k]) for k in licenses.HEADS)]
        best = max(cosine(words(p), t) for p in pieces for t in templates)
        if best >= licenses.THRESHOLD:
            want[i] = best
    assert got.keys() == want.keys() and len(want) >= 6
    assert all(abs(got[i] - want[i]) < 1e-5 for i in want)


def test_tied_templates_and_no_text(spark):
    docs = prepare(spark).createDataFrame([(1, "Some Shared Notice"), (2, None), (None, "Some Shared Notice")], "doc_id long, text string")
    got = licenses.matches(docs, [("A", False, "some shared notice"), ("B", False, "Some shared notice.")]).collect()
    assert {r["licence"] for r in got} == {"B"} and len({r["doc"] for r in got}) == 2
    assert licenses.matches(docs.limit(0)).count() == 0
