import math
import re
from collections import Counter

import pytest

from screenrank.llm.catalogue import op7_licenses
from screenrank.llm.licenses import FULL_TEXTS, TEMPLATES, THRESHOLD, Templates, ancestors, licensed, words

SCHEMA = "path string, text string, is_licence_file boolean, license int"


def brute_line(line):
    """(licence, cosine) by comparing the line with every template."""
    tf = [Counter(words(t)) for _, t in TEMPLATES]
    df = Counter(w for c in tf for w in c)
    n = len(TEMPLATES)

    def vector(c):
        v = {w: (1 + math.log(k)) * (math.log((1 + n) / (1 + df.get(w, 0))) + 1) for w, k in c.items()}
        norm = math.sqrt(sum(x * x for x in v.values())) or 1
        return {w: x / norm for w, x in v.items()}

    line = vector(Counter(words(line)))
    sims = [sum(x * line.get(w, 0) for w, x in vector(c).items()) for c in tf]
    best = max(range(n), key=lambda i: (sims[i], -i))
    return (TEMPLATES[best][0], sims[best]) if sims[best] >= THRESHOLD - 1e-9 else (None, None)


@pytest.mark.parametrize("line", [t for _, t in TEMPLATES] + [
    "Licensed under the MIT License", "licensed under cc by-nc 4.0", "the quick brown fox", "", "MIT", "a licence to kill",
    "This work is licensed under the GNU General Public License, version 3 or so they say in this long line",
    "// Licensed under the Apache License, Version 2.0 //", "the the the of the and to the", "it is what it is"])
def test_scan_equals_comparing_with_every_template(line):
    name, at, cosine, _ = Templates().scan("some words\n" + line + "\nmore words")
    want = brute_line(line)
    assert name == want[0] and (name is None or (at == 1 and abs(cosine - want[1]) < 1e-9))


def test_best_line_of_a_whole_text_wins():
    text = "x\n" * 5000 + "Licensed under the Apache License, Version 2.0, they say\n" + "y\n" * 5000 + \
        "Released under the MIT License.\n"
    assert Templates().scan(text)[:2] == ("MIT", 10_001)


GPL_HEADER = """#!/usr/bin/env python
# This program is free software: you can redistribute it and/or modify
# it under the terms of the GNU General Public License as published by
# the Free Software Foundation, either version 3 of the License, or
# (at your option) any later version.
import os
"""


@pytest.mark.parametrize("text,name,line", [
    ("// x\n// Use of this source code is governed by a BSD-style\n// license that can be found in the LICENSE file.\nint x;",
     "BSD-3-Clause", 1),
    (GPL_HEADER, "GPL-3.0", None),
    ("Copyright (c) 2020 Jane Doe. Released under the MIT License.", "MIT", 0),
    ("Licensed under CC BY-NC 4.0. The photographs belong to the museum and its friends.", "CC-BY-NC-4.0", 0),
    ("MIT License", "MIT", 0),
    ("  GNU GENERAL PUBLIC LICENSE\n  Version 3, 29 June 2007\n\nPreamble and all the rest", "GPL-3.0", 0),
    ("GNU GENERAL PUBLIC LICENSE\nVersion 3", "GPL-3.0", 0),
    ("The museum is open to the public. Its version of the story is free to modify.\nNo licence here.", None, None)])
def test_notices_wrapped_or_next_to_other_sentences(text, name, line):
    got = Templates().scan(text)
    assert got[0] == name and (line is None or got[1] == line), got
    assert all((brute_line(x)[0]) is None for x in text.split("\n"))  # no line alone reaches it


def test_whole_text_of_a_licence_file():
    name, text = FULL_TEXTS[0]
    body = "Copyright 2020 Jane Doe\n" + text.replace(" ", "\n")  # one word a line: no group is long enough
    assert Templates().scan(body)[0] == name and Templates().scan(body)[3]
    assert [Templates().scan(t)[::3] for _, t in FULL_TEXTS] == [(n, True) for n, _ in FULL_TEXTS]
    wrapped = [t.replace("are permitted ", "are permitted\n").replace("are met: ", "are met:\n\n") for _, t in FULL_TEXTS]
    assert [Templates().scan(t)[0] for t in wrapped] == [n for n, _ in FULL_TEXTS]
    assert not Templates().scan("A story of a museum. " * 50 + TEMPLATES[0][1])[3]  # states one, but is none


@pytest.mark.parametrize("text,name", [
    ("GNU General Public License, version 2", "GPL-2.0"),
    ("This work is licensed under the GNU General Public License, version 2.", "GPL-2.0"),
    ("This library is licensed under the GNU Lesser General Public License, version 2.", "LGPL-2.0"),
    ("This library is licensed under the GNU Lesser General Public License, version 2.1.", "LGPL-2.1"),
    ("This program is licensed under the GNU Affero General Public License, version 3.", "AGPL-3.0"),
    ("This work is licensed under the GNU General Public License, version 5.", None),
    ("This work is licensed under the GNU General Public License.", None),
    ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 1.1.", "MPL-1.1"),
    ("Licensed under the Apache License, Version 2.1.", None),
    ("Licensed under CC BY-NC-SA 4.0.", "CC-BY-NC-SA-4.0"), ("Licensed under CC BY-ND 4.0.", "CC-BY-ND-4.0"),
    ("Licensed under CC BY-NC-ND 4.0.", "CC-BY-NC-ND-4.0"), ("Licensed under CC BY 3.0.", "CC-BY-3.0"),
    ("Licensed under CC BY 9.0.", None), ("Licensed under CC BY-ND-SA 4.0.", None),
    ("Creative Commons Attribution-NonCommercial 4.0 International", "CC-BY-NC-4.0"),
    ("This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.", "CC-BY-NC-4.0"),
    ("This work is licensed under a Creative Commons Attribution-ShareAlike\n4.0 International License.", "CC-BY-SA-4.0"),
    ("This work is licensed under a Creative Commons Attribution - No Derivatives 4.0 International License.", "CC-BY-ND-4.0"),
    ("// SPDX-License-Identifier: GPL-2.0-only", "GPL-2.0"), ("# SPDX-License-Identifier: lgpl-2.1-or-later", "LGPL-2.1"),
    ("SPDX-License-Identifier: Proprietary", None)])
def test_versions_and_qualifiers_name_the_licence(text, name):
    assert Templates().scan("x\n" + text + "\ny")[0] == name


def test_groups_equal_comparing_every_group():
    """Brute force: every run of up to 12 sentences, or parts at line borders."""
    t = Templates()
    notices = [x for _, x in TEMPLATES[:14]]
    for i, notice in enumerate(notices):
        w = notice.split()
        cut = len(w) // 2
        text = "one line before.\n" + " ".join(w[:cut]) + "\n" + " ".join(w[cut:]) + " And then more. The end of it\nlast"
        parts = [x for line in text.lower().split("\n") for x in re.split(r"(?<=[.!?])\s+", line) if words(x)]
        best = [(0.0, 0, None)]
        for a in range(len(parts)):
            for b in range(a + 1, min(a + 12, len(parts)) + 1):
                raw = " ".join(parts[a:b])
                if len(words(raw)) <= t.group_words and (hit := t.match(raw, Counter(words(raw)))):
                    best.append((-hit[0], hit[1], hit[2]))
        got = t.scan(text)
        assert (got[0], round(got[2] or 0, 9)) == (min(best)[2], -min(best)[0]), notice


def test_a_licence_text_covers_its_directory(spark, tmp_path):
    """A 170-word MIT file planted in the query's table."""
    rows = [(10, "MIT License\n\nCopyright 2020 Jane Doe\n\n" + FULL_TEXTS[0][1], "web", "en"), (11, "a story", "web", "en"),
            (2001, "another story", "web", "en"), (12, "a third", "web", "de"), (20, "a fourth", None, None),
            (3001, "Released under the MIT License. " + "It was a dark night. " * 40, "news", "en"), (3002, "x", "news", "en")]
    spark.createDataFrame(rows, "doc_id long, text string, source string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: (r.license, r.via) for r in op7_licenses(spark, str(tmp_path)).collect()}
    assert got == {10: ("MIT", "own"), 11: ("MIT", "inherited"), 2001: ("MIT", "inherited"), 12: (None, None),
                   20: (None, None), 3001: ("MIT", "own"), 3002: (None, None)}


def test_inheritance_from_the_nearest_ancestor(spark):
    mit, gpl, none = "Released under the MIT License.", TEMPLATES[7][1], "nothing here"
    whole = FULL_TEXTS[0][1]  # decides by itself where the flag is null
    rows = [("w/COPYING", whole, None), ("w/x", none, False), ("w/v/NOT", whole, False), ("w/v/y", none, False), ("LICENSE", gpl, True), ("a/LICENSE", mit, True), ("a/b/x.py", none, False), ("a/b/c/y.py", none, False),
            ("z.py", none, False), ("q/w.py", none, False), ("a/own.py", gpl, False), ("ab/x.py", none, False),
            (None, none, False), (None, mit, True), ("n/LICENSE", None, True), ("n/x", "", False),
            ("d/COPYING", mit, True), ("d/A-LICENSE", gpl, True), ("d/f", none, None), ("d/f", none, None)]
    df = spark.createDataFrame([(p, t, f, 1) for p, t, f in rows], SCHEMA)
    out = licensed(df)
    assert out.columns == ["path", "is_licence_file", "license", "via"] and out.count() == len(rows)
    got = {r.path: (r.license, r.via) for r in out.collect() if r.path}
    assert got == {"w/COPYING": ("MIT", "own"), "w/x": ("MIT", "inherited"), "w/v/NOT": ("MIT", "own"),
                   "w/v/y": ("MIT", "inherited"), "LICENSE": ("GPL-3.0", "own"), "a/LICENSE": ("MIT", "own"), "a/b/x.py": ("MIT", "inherited"),
                   "a/b/c/y.py": ("MIT", "inherited"), "z.py": ("GPL-3.0", "inherited"),
                   "q/w.py": ("GPL-3.0", "inherited"), "a/own.py": ("GPL-3.0", "own"),
                   "ab/x.py": ("GPL-3.0", "inherited"), "n/LICENSE": ("GPL-3.0", "inherited"),
                   "n/x": ("GPL-3.0", "inherited"), "d/COPYING": ("MIT", "own"), "d/A-LICENSE": ("GPL-3.0", "own"),
                   "d/f": ("GPL-3.0", "inherited")}
    assert sorted((r.license or "", r.via or "") for r in out.collect() if not r.path) == [("", ""), ("MIT", "own")]
    assert licensed(df.limit(0)).count() == 0


def test_ancestors(spark):
    df = spark.createDataFrame([("a/b/c",), ("",), ("a",)], "d string")
    assert [r.x for r in df.select(ancestors("d").alias("x")).collect()] == \
        [["", "a", "a/b", "a/b/c"], [""], ["", "a"]]
