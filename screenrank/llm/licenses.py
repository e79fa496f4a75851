"""License scans (operator 7): TF-IDF cosine to templates, then inheritance.

Every line of a file is a sparse TF-IDF vector over its words, with 1 + ln(count)
for the frequency, and so is every group of consecutive sentences (and parts of
them between line borders) of about a template's length: a notice counts wrapped
over lines or next to other sentences on its line. Inverse document frequencies
come from ``TEMPLATES``, and words that no template has weigh as the rarest.
The whole text is compared with ``FULL_TEXTS`` and the templates as well. A group
that has just the words of one of ``TITLES``, the headlines of licence texts,
or an SPDX line states that licence too, with a cosine of 1. The longer licences
(Apache, GPL family, MPL, CC) aren't in ``FULL_TEXTS``: their files are known by
headline and the notices within.

A cosine of ``THRESHOLD`` says which wording it is, not which licence: versions
and the qualifiers noncommercial, no derivatives, share alike, lesser and affero
weigh little in it. They are read from the matched words themselves, and only
together with the wording's family do they name a licence (GPL wording with
"version 2" is GPL-2.0, CC wording with "BY-NC-SA 3.0" is CC-BY-NC-SA-3.0). A
version or combination that the family doesn't have, or none where it needs one,
names no licence at all.

The file's own licence is the best such statement's, ties to the first template
and line. A file is a licence file if its caller says so or, where that is null,
if its whole text is nothing else than a notice, title or licence text. A file
without a licence inherits from the nearest ancestor directory that holds a
licence file with a licence of its own; of several licence files in a directory
the first by path counts.

Words of a template that together can't reach the threshold are left aside, the
most ordinary ones first; groups with none of the others are skipped. That loses
nothing, as such a group can't reach the threshold either.

Inheritance is worked out per distinct directory: directories are joined with
licence files on each of their ancestor paths, the deepest match wins, and
files take their directory's result. So a directory with a third of all files
is one row in that join.

Defined results: a null or empty text states no licence, and very long texts are
read whole; a null path has no
directory and inherits nothing; a path without "/" lies in the root directory
"", which is an ancestor of all; rows that repeat a path are scanned each, and
the first statement by licence name counts for a licence file; an empty table
gives no rows; other columns pass through, but for ``license`` and ``via``,
which are replaced.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from screenrank.llm.common import saved, small_side
from screenrank.session import ship_by_value

THRESHOLD = 0.75

# Usual notices of common licences.
TEMPLATES = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT license. See the LICENSE file in the project root for details."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files, to deal in the Software without restriction."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file "
                   "except in compliance with the License."),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted "
                     "provided that the following conditions are met."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "Redistribute and modify under the GNU General Public License as published by the Free Software "
                "Foundation, either version 3 of the License, or any later version."),
    ("LGPL-3.0", "This library is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This program is licensed under the GNU Affero General Public License, version 3."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright. CC0 1.0 Universal."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
]
# Headlines of licence texts.
TITLES = [
    ("MIT", "MIT License"),
    ("MIT", "The MIT License"),
    ("MIT", "The MIT License (MIT)"),
    ("Apache-2.0", "Apache License Version 2.0"),
    ("Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/"),
    ("BSD-3-Clause", "BSD 3-Clause License"),
    ("GPL-3.0", "GNU General Public License Version 3"),
    ("GPL-3.0", "GNU General Public License Version 3, 29 June 2007"),
    ("LGPL-3.0", "GNU Lesser General Public License Version 3"),
    ("LGPL-3.0", "GNU Lesser General Public License Version 3, 29 June 2007"),
    ("AGPL-3.0", "GNU Affero General Public License Version 3"),
    ("AGPL-3.0", "GNU Affero General Public License Version 3, 19 November 2007"),
    ("MPL-2.0", "Mozilla Public License Version 2.0"),
    ("CC-BY-4.0", "Creative Commons Attribution 4.0 International"),
    ("CC-BY-NC-4.0", "Creative Commons Attribution-NonCommercial 4.0 International"),
    ("CC-BY-SA-4.0", "Creative Commons Attribution-ShareAlike 4.0 International"),
    ("CC0-1.0", "Creative Commons CC0 1.0 Universal"),
    ("Unlicense", "The Unlicense"),
    ("BSD-2-Clause", "BSD 2-Clause License"),
    ("GPL-2.0", "GNU General Public License Version 2"),
    ("GPL-2.0", "GNU General Public License Version 2, June 1991"),
    ("LGPL-2.1", "GNU Lesser General Public License Version 2.1"),
    ("LGPL-2.1", "GNU Lesser General Public License Version 2.1, February 1999"),
    ("MPL-1.1", "Mozilla Public License Version 1.1"),
    ("CC-BY-ND-4.0", "Creative Commons Attribution-NoDerivatives 4.0 International"),
    ("CC-BY-NC-SA-4.0", "Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International"),
    ("CC-BY-NC-ND-4.0", "Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International"),
    ("CC-BY-3.0", "Creative Commons Attribution 3.0 Unported"),
]
# Versions that a family of licences has, by qualifiers.
GPL_VERSIONS = {"": ("GPL", "1.0 2.0 3.0"), "lesser": ("LGPL", "2.0 2.1 3.0"), "affero": ("AGPL", "1.0 3.0")}
CC_VERSIONS = "1.0 2.0 2.5 3.0 4.0"
CC_QUALIFIERS = ("", "nc", "nd", "sa", "nc nd", "nc sa")
PLAIN_VERSIONS = {"Apache": "1.0 1.1 2.0", "MPL": "1.0 1.1 2.0", "CC0": "1.0"}
#: Patterns (for lower-cased text, alike in Python and RE2) of a version behind
#: a word that announces one, and of the qualifiers.
VERSION = (r"\b(?:version|v|licen[cs]e|by|nc|nd|sa|cc0|attribution|commercial|noncommercial|alike|sharealike|"
           r"deriv[a-z]*|noderiv[a-z]*|[al]?gpl|[al]?gplv|mpl|apache)[^a-z0-9]*([0-9]{1,2}(?:\.[0-9]+)*)\b")
QUALIFIERS = {"nc": r"\b(?:nc|non[^a-z0-9]*commercial)\b", "nd": r"\b(?:nd|no[^a-z0-9]*deriv[a-z]*)\b",
              "sa": r"\b(?:sa|share[^a-z0-9]*alike)\b",
              "lesser": r"\b(?:lesser|lgpl|lgplv[0-9.]*|library[^a-z0-9]+general)\b", "affero": r"\b(?:affero|agpl|agplv[0-9.]*)\b"}
SPDX = r"spdx-license-identifier:[ \t]*([a-z0-9.+-]+)"
_AS_IS = ("THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED "
          "TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL "
          "THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF "
          "CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER "
          "DEALINGS IN THE SOFTWARE.")
_BSD_AS_IS = ("THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR "
              "IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND "
              "FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR "
              "CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL "
              "DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, "
              "DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER "
              "IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT "
              "OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.")
# Whole texts of short licences.
FULL_TEXTS = [
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
            "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of "
            "the Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
            "conditions: The above copyright notice and this permission notice shall be included in all copies or "
            "substantial portions of the Software. " + _AS_IS),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted "
                     "provided that the following conditions are met: 1. Redistributions of source code must retain the "
                     "above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions "
                     "in binary form must reproduce the above copyright notice, this list of conditions and the "
                     "following disclaimer in the documentation and/or other materials provided with the distribution. "
                     "3. Neither the name of the copyright holder nor the names of its contributors may be used to "
                     "endorse or promote products derived from this software without specific prior written permission. "
                     + _BSD_AS_IS),
    ("BSD-2-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted "
                     "provided that the following conditions are met: 1. Redistributions of source code must retain the "
                     "above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions "
                     "in binary form must reproduce the above copyright notice, this list of conditions and the "
                     "following disclaimer in the documentation and/or other materials provided with the distribution. "
                     + _BSD_AS_IS),
    ("Unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, "
                  "publish, use, compile, sell, or distribute this software, either in source code form or as a compiled "
                  "binary, for any purpose, commercial or non-commercial, and by any means. In jurisdictions that "
                  "recognize copyright laws, the author or authors of this software dedicate any and all copyright "
                  "interest in the software to the public domain. We make this dedication for the benefit of the public "
                  "at large and to the detriment of our heirs and successors. We intend this dedication to be an overt "
                  "act of relinquishment in perpetuity of all present and future rights to this software under copyright "
                  "law. " + _AS_IS + " For more information, please refer to http://unlicense.org/"),
]
# Ordinary words, which many lines have.
ORDINARY = set("a all an and any are as be by can either file following for found free from has in into is it may not "
               "of on or other person possible project provided see that the this to use under v version with without "
               "work you 1 2 3 4 0".split())
_WORD = re.compile(r"[a-z0-9]+")
_SENTENCE_END = re.compile(r"(?<=[.!?])\s+")
GROUP_PARTS = 12  # sentences, or parts of them, in a group


_VERSION = re.compile(VERSION, re.ASCII)
_QUALIFIERS = {q: re.compile(p, re.ASCII) for q, p in QUALIFIERS.items()}
_SPDX = re.compile(SPDX, re.ASCII)


def words(line: str) -> list[str]:
    return _WORD.findall(line.lower())


def family(name: str) -> str:
    """The family of wordings that a licence's templates belong to."""
    return "GPL" if name.startswith(("GPL-", "LGPL-", "AGPL-")) else "CC" if name.startswith("CC-") else name.split("-")[0]


def named_licences() -> dict[tuple[str, str, str], str]:
    """(family, version without trailing zeros, qualifiers) -> licence, for the
    families in which a version is needed."""
    out = {}
    for q, (name, versions) in GPL_VERSIONS.items():
        out |= {("GPL", v.removesuffix(".0"), q): f"{name}-{v}" for v in versions.split()}
    for q in CC_QUALIFIERS:
        name = "-".join(["CC-BY", *q.upper().split()])
        out |= {("CC", v.removesuffix(".0"), q): f"{name}-{v}" for v in CC_VERSIONS.split()}
    for name, versions in PLAIN_VERSIONS.items():
        out |= {(name, v.removesuffix(".0"), ""): f"{name}-{v}" for v in versions.split()}
    return out


_NAMED = named_licences()
_IDENTIFIERS = {n.lower(): n for n in [*_NAMED.values(), *(n for n, _ in TITLES)]}


def marks(text: str) -> tuple[str, str]:
    """The versions and the qualifiers that a lower-cased text names, each as one
    string in order."""
    versions = sorted({re.sub(r"(?:\.0)+$", "", v) for v in _VERSION.findall(text)})
    return " ".join(versions), " ".join(sorted(q for q, p in _QUALIFIERS.items() if p.search(text)))


def licence_of(template: str, text: str) -> str | None:
    """The licence that ``text``, worded like one of ``template``'s, states."""
    version, qualifiers = marks(text)
    kind = family(template)
    if any(k == kind for k, _, _ in _NAMED):
        return _NAMED.get((kind, version, qualifiers))
    return template if not version and not qualifiers else None


def spdx_licence(text: str) -> str | None:
    """The licence of a lower-cased SPDX line, if it is one of those known here."""
    found = _SPDX.search(text)
    return found and _IDENTIFIERS.get(re.sub(r"(?:-only|-or-later|\+)$", "", found[1]))


class Templates:
    """TF-IDF vectors of the templates and the words that can decide a match."""

    def __init__(self, templates: list[tuple[str, str]] = TEMPLATES, threshold: float = THRESHOLD,
                 titles: list[tuple[str, str]] = TITLES, full_texts: list[tuple[str, str]] = FULL_TEXTS) -> None:
        self.names = [name for name, _ in templates + titles + full_texts]
        self.threshold = threshold
        counts = [Counter(words(text)) for _, text in templates]
        df = Counter(w for c in counts for w in c)
        n = len(templates)
        self.idf = {w: math.log((1 + n) / (1 + k)) + 1 for w, k in df.items()}
        self.rarest = math.log(1 + n) + 1
        self.notices = n
        self.titles = {tuple(words(text)): n + i for i, (_, text) in enumerate(titles)}
        vectors = ([(i, self._unit(c)) for i, c in enumerate(counts)]
                   + [(n + len(titles) + i, self._unit(Counter(words(text)))) for i, (_, text) in enumerate(full_texts)])
        self.group_words = 2 * max((len(words(text)) for _, text in templates + titles), default=0)
        self.by_word: dict[str, list[tuple[int, float]]] = {}
        deciding = set()
        for i, v in vectors:
            light = 0.0
            for w, x in sorted(v.items(), key=lambda p: (p[0] not in ORDINARY, p[1], p[0])):
                self.by_word.setdefault(w, []).append((i, x))
                light += x * x
                if light >= threshold ** 2 - 1e-9 and i < self.notices:
                    deciding.add(w)
        deciding.add("spdx")
        for title in self.titles:
            if deciding.isdisjoint(title):
                deciding.add(max(title, key=lambda w: (w not in ORDINARY, self.idf.get(w, self.rarest), w)))
        self.deciding = re.compile(r"(?<![a-z0-9])(?:" + "|".join(sorted(deciding)) + r")(?![a-z0-9])")

    def _unit(self, counts: Counter) -> dict[str, float]:
        v = {w: (1 + math.log(k)) * self.idf.get(w, self.rarest) for w, k in counts.items()}
        norm = math.sqrt(sum(x * x for x in v.values())) or 1.0
        return {w: x / norm for w, x in v.items()}

    def match(self, text: str, counts: Counter, whole: bool = False) -> tuple[float, int, str] | None:
        """(cosine, template number, licence) of the best notice, or notice or
        full text if ``whole``, that reaches the threshold and whose family has a
        licence of the version and qualifiers in the lower-cased ``text``."""
        sums: dict[int, float] = {}
        for w, x in self._unit(counts).items():
            for i, y in self.by_word.get(w, ()):
                if whole or i < self.notices:
                    sums[i] = sums.get(i, 0.0) + x * y
        reach = sorted((-round(c, 9), i) for i, c in sums.items() if round(c, 9) >= self.threshold - 1e-9)
        for c, i in reach:
            # in a whole licence text other numbers and words may stand near
            name = self.names[i] if i >= self.notices else licence_of(self.names[i], text)
            if name:
                return -c, i, name
        return None

    def scan(self, text: str | None) -> tuple[str | None, int | None, float | None, bool]:
        """(licence, line number, cosine) of a whole text's best statement, and
        whether the text is nothing else than one."""
        low = (text or "").lower()
        found = []  # (-cosine, template number, line number, licence)
        all_of_it = False

        def compare(raw: str, counts: Counter, line: int, whole: bool = False) -> bool:
            hit = self.match(raw, counts, whole)
            if hit:
                found.append((-hit[0], hit[1], line, hit[2]))
            return hit is not None

        parts, done = [], 0
        if self.deciding.search(low):
            every = words(low)
            all_of_it = compare(low, Counter(every), 0, whole=True) or tuple(every) in self.titles
            lines = low.split("\n")
            holds = [bool(self.deciding.search(x)) for x in lines]
            near = np.convolve(holds, np.ones(2 * GROUP_PARTS + 1, dtype=int))[GROUP_PARTS:-GROUP_PARTS] > 0
            for n in np.flatnonzero(near).tolist():
                if holds[n]:
                    compare(lines[n], Counter(words(lines[n])), n)
                    name = spdx_licence(lines[n]) if "spdx" in lines[n] else None
                    if name:
                        found.append((-1.0, len(self.names), n, name))
                for x in _SENTENCE_END.split(lines[n]):
                    if w := words(x):
                        if self.deciding.search(x):
                            done = len(parts) + 1
                        parts.append((n, x, w, done))  # done: parts up to the last that can decide
        for i, (n, _, _, _) in enumerate(parts):
            if parts[min(i + GROUP_PARTS, len(parts)) - 1][3] <= i:
                continue
            group, raw = [], ""
            for _, x, w, upto in parts[i:i + GROUP_PARTS]:
                group += w
                raw = f"{raw} {x}"
                if len(group) > self.group_words:
                    break
                if upto > i:
                    compare(raw, Counter(group), n)
                    if tuple(group) in self.titles:
                        title = self.titles[tuple(group)]
                        found.append((-1.0, title, n, self.names[title]))
        if not found:
            return None, None, None, False
        cosine, _, line, name = min(found)
        if family(name) == "BSD":  # the conditions of two and three clauses begin alike
            conditions = " ".join(every)
            if "redistributions in binary form" in conditions:
                name = "BSD-3-Clause" if "endorse or promote" in conditions else "BSD-2-Clause"
        return name, line, -cosine, all_of_it


def scanner(templates: Templates) -> Callable[..., Column]:
    """Column function text -> struct(license, line, cosine, all_of_it)."""
    @F.pandas_udf("license string, line int, cosine double, all_of_it boolean")
    def scan(texts: pd.Series) -> pd.DataFrame:
        out = pd.DataFrame([templates.scan(t) for t in texts], columns=["license", "line", "cosine", "all_of_it"])
        return out.astype({"license": object, "line": "Int32", "cosine": "float64", "all_of_it": bool})

    return scan


def directory(path: str) -> Column:
    return F.regexp_extract(path, r"^(.*)/[^/]*$", 1)


def ancestors(directory: str) -> Column:
    """A directory and all above it, the root "" included."""
    parts = F.split(directory, "/", -1)
    return F.array_distinct(F.concat(
        F.array(F.lit("")),
        F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, 1, n), "/"))))


def licensed(files: DataFrame, templates: Templates | None = None) -> DataFrame:
    """``files`` (path, text, is_licence_file) with ``license`` and ``via``
    ("own", "inherited" or null). ``is_licence_file`` null: its text decides."""
    own = files.columns
    rows = saved(files.select(F.struct(*[F.col(f"`{c}`") for c in own if c != "text"]).alias("doc"),
                              scanner(templates or Templates())("text").alias("found"))
                 .withColumn("dir", directory("doc.path")), "licence-files")
    grants = (rows.where("coalesce(doc.is_licence_file, found.all_of_it) AND found.license IS NOT NULL AND dir IS NOT NULL")
              .groupBy("dir").agg(F.min(F.struct("doc.path", "found.license")).alias("grant"))
              .select(F.col("dir").alias("above"), F.col("grant.license").alias("granted")))
    dirs = rows.select("dir").where("dir IS NOT NULL").distinct()
    nearest = (dirs.select("dir", F.explode(ancestors("dir")).alias("above")).join(grants, "above")
               .groupBy("dir").agg(F.max(F.struct(F.length("above").alias("depth"), "granted")).alias("g"))
               .select("dir", F.col("g.granted").alias("inherited")))
    nearest = saved(nearest, "licence-directories")
    out = rows.join(small_side(nearest, nearest.count()), "dir", "left")
    keep = [F.col(f"doc.`{c}`") for c in own if c not in ("text", "license", "via")]
    return out.select(*keep, F.coalesce("found.license", "inherited").alias("license"),
                      F.when(F.col("found.license").isNotNull(), "own")
                      .when(F.col("inherited").isNotNull(), "inherited").alias("via"))


ship_by_value(__name__)
