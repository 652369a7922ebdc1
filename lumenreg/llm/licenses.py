"""License scans with DataFrame functions: TF-IDF cosine to templates, then inheritance.

Header blocks are runs of 1, 4 and 16 lines that start at a line which names a
licence, wherever in the file it stands; around every term that names a licence,
windows of the terms of each template with that name, laid as the template lies
around it, over line ends and inside long lines (compared with that template
only); and licence files by name as a whole. A block's terms are weighted by
frequency and by their inverse document frequency over all files; terms of no
template count towards its length with the highest weight. The licence of a file
is the template of the highest cosine of ``MIN_COSINE`` or more, over all blocks
(ties: the template's name). A block must hold the terms of the template that tell
licences apart (``TELLING``: names and versions), none of ``OTHERS`` that the
template lacks, and a word of granting (``GRANTS``) if the template has one, so that
talk about a licence is no notice. Long licence texts (Apache, GPL, MPL, Creative Commons) are known by
their titles and first sentences, shorter ones have their full text as a template.

Declarations (SPDX lines, manifest lines such as ``"license": "MIT"``, "dual licensed
under") name licences by identifiers: each identifier is scored as the SPDX header it
stands for. An expression of several (``MIT OR Apache-2.0``) is the file's licence,
before all single evidence: operators and exceptions as written, identifiers by their
templates' names, ``unknown`` for those of no template, with the lowest cosine of the
known ones (several expressions: the highest cosine, then the text). An expression of
unknown identifiers alone counts for nothing.

A file is a licence file of its directory if its name says so or if the
best block holds half of its terms. A file without a licence of its own takes
that of the nearest ancestor directory that has a licence file (the highest
cosine, then the smallest path, if several), by a join on directory paths.

Null and empty texts have no licence of their own; null paths have no
directory and inherit nothing. Repeated rows are scanned each.
"""

from __future__ import annotations

import json
import math
import re
from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumenreg.session import checkpointed

MIN_COSINE = 0.7
WINDOWS = (1, 4, 16)
ANCHOR = (r"(?i)licen[cs]e|spdx|copying conditions|permission is hereby granted|redistribution and use"
          r"|permission to use, copy|free and unencumbered|creative commons|cc0")
LICENCE_FILE = r"(?i)^(licen[cs]e|copying|unlicense|copyright)[^/]*$"
#: Terms by which a template's windows are laid: the first of them in the template.
NAMING = frozenset("""
apache mit mit0 sublicense gnu gpl lgpl agpl lesser affero bsd mozilla mpl creative cc sa nc sharealike
noncommercial attribution isc unencumbered unlicense cc0 endorse
""".split())
VERSIONS = frozenset("2 3 1.0 2.0 2.0+ 2.1 2.1+ 3.0 3.0+ 4.0".split())
#: Terms of a template that its blocks must hold.
TELLING = NAMING | VERSIONS
#: Terms of other licences that its blocks must not hold.
OTHERS = frozenset("""
gpl lgpl agpl lesser affero bsd mozilla mpl sa nc nd sharealike noncommercial noderivatives noderivs
isc cc0 endorse sublicense
""".split())
#: Words by which a notice grants; a template that has one asks for one in its blocks.
GRANTS = frozenset("""
licensed licenced released distributed distribute redistribute redistribution redistributions available
under governed subject terms identifier permission permitted granted dedicated free
""".split())
_ID = r"[A-Za-z0-9][A-Za-z0-9.+-]*+"
_OPERAND = rf"\(*+[ \t]*+{_ID}(?:[ \t]*+\))*+"


def _expression(operators: str) -> str:
    return rf"{_OPERAND}(?:(?:[ \t]++{operators}[ \t]++|/){_OPERAND})*+"


#: Declarations; group 1 is an identifier or an expression of several.
DECLARATIONS = (
    rf"(?i:SPDX-Licen[sc]e-Identifier):[ \t]*+({_expression('(?:OR|AND|WITH)')})",
    rf"(?im)^[ \t#/*;>{{-]*+[\"']?licen[sc]e[\"']?[ \t]*+[:=][ \t]*+[\"']?({_expression('(?:or|and|with)')})"
    r"[\"']?[ \t]*+[,;}]*+[ \t]*+$",
    rf"(?i)dual[ -]licen[sc]ed[ \t]++under[ \t]++(?:the[ \t]++|either[ \t]++)?({_expression('(?:or|and|with)')})")
OPERATORS = ("(", ")", "OR", "AND", "WITH")
#: The terms of BSD's second and third clauses: conditions that BSD-2 and BSD-3 share are BSD-2's in
#: a file that has the former without the latter.
SECOND_CLAUSE, THIRD_CLAUSE = "reproduce", "endorse"
TERM = r"[^a-z0-9.+]+"
#: MIT-0 is one term, or it would hold MIT's.
MIT_0 = ("mit-0", "mit0")

_MIT_GRANT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
    "associated documentation files (the \"Software\"), to deal in the Software without restriction, "
    "including without limitation the rights to use, copy, modify, merge, publish, distribute, "
    "sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is "
    "furnished to do so, subject to the following conditions: The above copyright notice and this "
    "permission notice shall be included in all copies or substantial portions of the Software.")
_NO_WARRANTY = (
    " THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT "
    "NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND "
    "NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS")
_LIABLE = (
    " BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR "
    "OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN "
    "THE SOFTWARE.")
_MIT = _MIT_GRANT + _NO_WARRANTY + " OR COPYRIGHT HOLDERS" + _LIABLE
_BSD_CONDITIONS = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted "
    "provided that the following conditions are met: Redistributions of source code must retain the "
    "above copyright notice, this list of conditions and the following disclaimer. Redistributions in "
    "binary form must reproduce the above copyright notice, this list of conditions and the following "
    "disclaimer in the documentation and/or other materials provided with the distribution.")
_BSD_THIRD = (
    " Neither the name of the copyright holder nor the names of its contributors may be used to endorse "
    "or promote products derived from this software without specific prior written permission.")
_BSD_DISCLAIMER = (
    " THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR "
    "IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND "
    "FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR "
    "CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL "
    "DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, "
    "DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN "
    "CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE "
    "USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.")
_ISC = (
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee "
    "is hereby granted, provided that the above copyright notice and this permission notice appear in all "
    "copies.")
_ISC_DISCLAIMER = (
    " THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS "
    "SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE "
    "AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES "
    "WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE "
    "OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS "
    "SOFTWARE.")
_UNLICENSE = (
    "This is free and unencumbered software released into the public domain. Anyone is free to copy, "
    "modify, publish, use, compile, sell, or distribute this software, either in source code form or as a "
    "compiled binary, for any purpose, commercial or non-commercial, and by any means. In jurisdictions "
    "that recognize copyright laws, the author or authors of this software dedicate any and all copyright "
    "interest in the software to the public domain. We make this dedication for the benefit of the public "
    "at large and to the detriment of our heirs and successors. We intend this dedication to be an overt "
    "act of relinquishment in perpetuity of all present and future rights to this software under "
    "copyright law." + _NO_WARRANTY + _LIABLE + " For more information, please refer to "
    "<https://unlicense.org/>")


def _gnu_notice(what: str, name: str, version: str) -> str:
    return (f"This {what} is free software: you can redistribute it and/or modify it under the terms of the "
            f"{name} as published by the Free Software Foundation, either version {version} of the License, "
            f"or (at your option) any later version. This {what} is distributed in the hope that it will be "
            "useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or "
            f"FITNESS FOR A PARTICULAR PURPOSE. See the {name} for more details.")


def _gnu_title(name: str, version: str) -> str:
    return (f"GNU {name} Public License Version {version} Copyright (C) Free Software Foundation, Inc. "
            "Everyone is permitted to copy and distribute verbatim copies of this license document, but "
            "changing it is not allowed.")


_SPDX = {
    "MIT": ["MIT"], "MIT-0": ["MIT-0"], "Apache-2.0": ["Apache-2.0"], "ISC": ["ISC"], "Unlicense": ["Unlicense"],
    "BSD-2-Clause": ["BSD-2-Clause"], "BSD-3-Clause": ["BSD-3-Clause"], "MPL-2.0": ["MPL-2.0"],
    "CC0-1.0": ["CC0-1.0"], "CC-BY-4.0": ["CC-BY-4.0"], "CC-BY-SA-4.0": ["CC-BY-SA-4.0"],
    "CC-BY-NC-4.0": ["CC-BY-NC-4.0"],
    **{f"{kind}-{v}": [f"{kind}-{v}{end}" for end in ("", "+", "-only", "-or-later")]
       for kind, v in (("GPL", "2.0"), ("GPL", "3.0"), ("LGPL", "2.1"), ("LGPL", "3.0"), ("AGPL", "3.0"))}}

#: Notices and headers by licence, in the words that their licences ask for.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use "
     "this file except in compliance with the License. You may obtain a copy of the License at "
     "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in "
     "writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT "
     "WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the "
     "specific language governing permissions and limitations under the License."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
     "software and associated documentation files (the \"Software\"), to deal in the Software without "
     "restriction, including without limitation the rights to use, copy, modify, merge, publish, "
     "distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the "
     "Software is furnished to do so, subject to the following conditions: The above copyright notice "
     "and this permission notice shall be included in all copies or substantial portions of the "
     "Software."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-2.0", "SPDX-License-Identifier: GPL-2.0-only"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the "
     "terms of the GNU General Public License as published by the Free Software Foundation, either "
     "version 3 of the License, or (at your option) any later version. This program is distributed in "
     "the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of "
     "MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more "
     "details."),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-or-later"),
    ("LGPL-3.0", "This library is licensed under the GNU Lesser General Public License, version 3."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, "
     "are permitted provided that the following conditions are met: Redistributions of source code must "
     "retain the above copyright notice, this list of conditions and the following disclaimer."),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in "
     "the LICENSE file."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If "
     "a copy of the MPL was not distributed with this file, You can obtain one at "
     "http://mozilla.org/MPL/2.0/."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("MIT", _MIT),
    ("MIT", "Licensed under the MIT License."),
    ("MIT-0", "MIT No Attribution"),
    ("MIT-0", "Licensed under the MIT-0 License."),
    ("Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/ TERMS AND "
     "CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION 1. Definitions."),
    ("BSD-2-Clause", _BSD_CONDITIONS + _BSD_DISCLAIMER),
    ("BSD-2-Clause", _BSD_CONDITIONS),
    ("BSD-3-Clause", _BSD_CONDITIONS + _BSD_THIRD + _BSD_DISCLAIMER),
    ("BSD-3-Clause", _BSD_CONDITIONS + _BSD_THIRD),
    ("ISC", _ISC),
    ("ISC", _ISC + _ISC_DISCLAIMER),
    ("ISC", "Licensed under the ISC License."),
    ("Unlicense", _UNLICENSE),
    ("Unlicense", _UNLICENSE.partition(" Anyone ")[0]),
    ("GPL-2.0", _gnu_notice("program", "GNU General Public License", "2")),
    ("GPL-2.0", _gnu_title("General", "2, June 1991")),
    ("GPL-3.0", _gnu_title("General", "3, 29 June 2007")),
    ("LGPL-2.1", "This library is licensed under the GNU Lesser General Public License, version 2.1."),
    ("LGPL-2.1", _gnu_notice("library", "GNU Lesser General Public License", "2.1")),
    ("LGPL-2.1", _gnu_title("Lesser General", "2.1, February 1999")),
    ("LGPL-3.0", _gnu_notice("library", "GNU Lesser General Public License", "3")),
    ("LGPL-3.0", _gnu_title("Lesser General", "3, 29 June 2007")),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("AGPL-3.0", _gnu_notice("program", "GNU Affero General Public License", "3")),
    ("AGPL-3.0", _gnu_title("Affero General", "3, 19 November 2007")),
    ("MPL-2.0", "Mozilla Public License Version 2.0 1. Definitions 1.1. Contributor means each individual "
     "or legal entity that creates, contributes to the creation of, or owns Covered Software."),
    ("CC0-1.0", "CC0 1.0 Universal"),
    ("CC0-1.0", "To the extent possible under law, the author has dedicated all copyright and related and "
     "neighboring rights to this work to the public domain worldwide under CC0 1.0 Universal. This "
     "software is distributed without any warranty."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 "
     "International License."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 "
     "International License."),
    ("CC-BY-4.0", "Creative Commons Attribution 4.0 International Public License"),
    ("CC-BY-SA-4.0", "Creative Commons Attribution-ShareAlike 4.0 International Public License"),
    ("CC-BY-NC-4.0", "Creative Commons Attribution-NonCommercial 4.0 International Public License"),
    *((name, f"SPDX-License-Identifier: {spdx}") for name, forms in _SPDX.items() for spdx in forms),
)


def plain_terms(text: str) -> list[str]:
    """The terms of a template, as ``terms`` has them."""
    return [t for t in (x.strip(".") for x in re.split(TERM, text.lower().replace(*MIT_0))) if t]


def naming_places() -> dict:
    """{naming term: [(template, place of the term in it, length of it)]} of all templates."""
    out: dict = {}
    for i, (_, text) in enumerate(TEMPLATES):
        found = plain_terms(text)
        at = next((k for k, t in enumerate(found) if t in NAMING), 0)
        out.setdefault(found[at], []).append({"template": i, "at": at, "n": len(found)})
    return out


def terms(text: Column) -> Column:
    """Lower-case terms of a text, without dots at their ends."""
    found = F.transform(F.split(F.replace(F.lower(text), *map(F.lit, MIT_0)), TERM), lambda t: F.btrim(t, F.lit(".")))
    return F.filter(found, lambda t: t != "")


def directory(path: Column) -> Column:
    """The path's directory, '' for the top one."""
    return F.regexp_replace(F.regexp_replace(path, r"[^/]*$", ""), r"/+$", "")


def ancestors(folder: Column) -> Column:
    """The directory and all above it, with '' last."""
    parts = F.split(folder, "/")
    return F.when(folder == "", F.array(F.lit(""))).otherwise(F.concat(F.transform(
        F.sequence(F.size(parts), F.lit(1), F.lit(-1)),
        lambda n: F.array_join(F.slice(parts, F.lit(1), n), "/")), F.array(F.lit(""))))


def let(value: Column, use) -> Column:
    """``use(value)`` with the value worked out once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def constant(value, kind: str) -> Column:
    """A large constant of a nested type."""
    return F.from_json(F.lit(json.dumps(value)), kind)


def document_frequencies(files: DataFrame, words: list[str]) -> dict:
    """{template term: files that hold it}; '' has the count of files. One pass over all files."""
    found = files.select(F.explode(F.concat(F.array(F.lit("")), F.coalesce(
        F.array_intersect(terms(F.col("text")), F.array(*[F.lit(w) for w in words])),
        F.array().cast("array<string>")))).alias("term"))
    return {r["term"]: r["df"] for r in found.groupBy("term").agg(F.count(F.lit(1)).alias("df")).collect()}


class Evidence:
    """Cosines of blocks of terms to the templates, as expressions over one row.

    A block never leaves its row: its terms are sorted, counted by their first places, and
    weighed with a constant map of the template terms.
    """

    def __init__(self, frequencies: dict):
        n_files = frequencies.get("", 0)
        idf = lambda t: math.log((1 + n_files) / (1 + frequencies.get(t, 0))) + 1
        counts = [Counter(plain_terms(text)) for _, text in TEMPLATES]
        words = sorted(set().union(*counts))
        lengths = [math.sqrt(sum((tf * idf(t)) ** 2 for t, tf in sorted(c.items()))) for c in counts]
        self.words, self.unseen = words, math.log(1 + n_files) + 1
        self.weights = constant(
            {t: {"i": idf(t), "v": [c[t] * idf(t) / size for c, size in zip(counts, lengths)]} for t in words},
            "map<string,struct<i:double,v:array<double>>>")
        self.rules = constant(
            [{"license": name, "telling": sorted(TELLING.intersection(plain_terms(t))),
              "others": sorted(OTHERS.difference(plain_terms(t))),
              "granting": not GRANTS.isdisjoint(plain_terms(t)),
              "clauses": None if "redistributions" not in plain_terms(t) or THIRD_CLAUSE in plain_terms(t)
              else name == "BSD-2-Clause"} for name, t in TEMPLATES],
            "array<struct<license:string,telling:array<string>,others:array<string>,granting:boolean,"
            "clauses:boolean>>")

    def marks(self, found: Column) -> Column:
        return F.array_intersect(found, F.array(*[F.lit(t) for t in sorted(TELLING | OTHERS | GRANTS)]))

    def fits(self, rule: Column, marks: Column, two_clause: Column) -> Column:
        return (~F.arrays_overlap(marks, rule["others"])
                & (~rule["granting"] | F.arrays_overlap(marks, F.array(*[F.lit(t) for t in sorted(GRANTS)])))
                & F.coalesce(rule["clauses"] == two_clause, F.lit(True))
                & (F.size(F.array_except(rule["telling"], marks)) == 0))

    def weighed(self, found: Column, use) -> Column:
        """``use(template terms with their weights and counts, length of the block's vector)``."""
        def counted(known):
            return let(F.sort_array(known), lambda s: let(F.array_distinct(s), lambda d: F.transform(
                d, lambda t, i: F.struct(
                    F.element_at(self.weights, t).alias("w"),
                    (F.coalesce(F.array_position(s, F.get(d, i + 1)), F.size(s) + 1)
                     - F.array_position(s, t)).cast("double").alias("tf")))))

        def length(known, c):
            squares = F.aggregate(c, F.lit(0.0), lambda a, x: a + (x["tf"] * x["w"]["i"]) ** 2)
            return F.sqrt(squares + (F.size(found) - F.size(known)) * F.lit(self.unseen ** 2))

        return let(F.filter(found, lambda t: t.isin(self.words)), lambda known: let(
            counted(known), lambda c: let(length(known, c), lambda size: use(c, size))))

    def cosine(self, counted: Column, size: Column, template: Column) -> Column:
        dot = F.aggregate(counted, F.lit(0.0), lambda a, x: a + x["tf"] * x["w"]["i"]
                          * F.get(x["w"]["v"], template))
        return F.round(dot / size, 6)

    def entry(self, cosine: Column, rule: Column, found: Column) -> Column:
        """(-cosine, licence, terms of the block): the least is the best; null below the limit."""
        return F.when(cosine >= MIN_COSINE, F.struct(
            (-cosine).alias("minus"), rule["license"].alias("license"), F.size(found).alias("n")))

    def any_template(self, found: Column, two_clause: Column) -> Column:
        """The best template of a block."""
        return F.when(F.size(found) > 0, let(self.marks(found), lambda marks: self.weighed(
            found, lambda c, size: F.array_min(F.transform(self.rules, lambda rule, k: F.when(
                self.fits(rule, marks, two_clause), self.entry(self.cosine(c, size, k), rule, found)))))))

    def one_template(self, found: Column, template: Column, two_clause: Column) -> Column:
        """A window's entry for its own template; windows of another licence go first."""
        return let(F.get(self.rules, template), lambda rule: F.when(
            self.fits(rule, self.marks(found), two_clause), self.weighed(
                found, lambda c, size: self.entry(self.cosine(c, size, template), rule, found))))

    def declared(self, text: Column, two_clause: Column) -> Column:
        """(joint, entry) of every declaration with a known licence; joint: of several identifiers."""
        def operands(expression):
            split = F.regexp_extract_all(F.replace(expression, F.lit("/"), F.lit(" OR ")),
                                         F.lit(r"[()]|[^\s()]+"), F.lit(0))
            return let(split, lambda ts: F.transform(ts, lambda t, i: F.struct(t.alias("token"), F.when(
                ~F.upper(t).isin(*OPERATORS) & F.coalesce(F.upper(F.get(ts, i - 1)) != "WITH", F.lit(True)),
                F.struct(self.any_template(terms(F.concat(F.lit("spdx license identifier "), t)), two_clause)
                         .alias("entry"))).alias("operand"))))

        def written(parts):
            joined = F.array_join(F.transform(parts, lambda p: F.when(
                p["operand"].isNotNull(), F.coalesce(p["operand"]["entry"]["license"], F.lit("unknown"))).when(
                F.upper(p["token"]).isin(*OPERATORS), F.upper(p["token"])).otherwise(p["token"])), " ")
            return F.replace(F.replace(joined, F.lit("( "), F.lit("(")), F.lit(" )"), F.lit(")"))

        def entry(expression, parts):
            several = F.size(F.filter(parts, lambda p: p["operand"].isNotNull())) > 1
            return let(F.filter(parts, lambda p: p["operand"]["entry"].isNotNull()), lambda known: F.when(
                F.size(known) > 0, F.struct(several.alias("joint"), F.when(several, F.struct(
                    F.array_max(F.transform(known, lambda p: p["operand"]["entry"]["minus"])).alias("minus"),
                    written(parts).alias("license"), F.size(terms(expression)).alias("n")))
                    .otherwise(F.get(known, F.lit(0))["operand"]["entry"]).alias("entry"))))

        found = F.array_distinct(F.concat(*[F.regexp_extract_all(text, F.lit(d), F.lit(1)) for d in DECLARATIONS]))
        return F.transform(found, lambda x: let(operands(x), lambda parts: entry(x, parts)))

    def best(self, text: Column, named: Column) -> Column:
        """(-cosine, licence, terms of the block, terms of the file) of a file's best block."""
        lines = F.split(text, "\n")
        places = constant(naming_places(), "map<string,array<struct<template:int,at:int,n:int>>>")

        def of_lines(lines, two_clause):
            starts = F.filter(F.sequence(F.lit(1), F.size(lines)),
                              lambda i: F.element_at(lines, i).rlike(ANCHOR))
            return F.array_min(F.transform(starts, lambda i: F.array_min(F.transform(
                F.array(*[F.lit(w) for w in WINDOWS]), lambda w: let(
                    terms(F.array_join(F.slice(lines, i, w), " ")),
                    lambda found: self.any_template(found, two_clause))))))

        def of_windows(all_terms, two_clause):
            hits = F.filter(F.transform(all_terms, lambda t, i: F.struct(t.alias("term"), i.alias("i"))),
                            lambda h: h["term"].isin(sorted(naming_places())))

            def around(h, p):
                start = h["i"] - p["at"]
                begin = F.greatest(start, F.lit(0))
                return let(F.slice(all_terms, begin + 1, p["n"] - (begin - start)),
                           lambda found: self.one_template(found, p["template"], two_clause))

            return F.array_min(F.transform(hits, lambda h: F.array_min(F.transform(
                F.element_at(places, h["term"]), lambda p: around(h, p)))))

        def found_in(lines, all_terms):
            two_clause = F.array_contains(all_terms, SECOND_CLAUSE) & ~F.array_contains(all_terms, THIRD_CLAUSE)
            whole = F.when(F.coalesce(named, F.lit(False)), self.any_template(all_terms, two_clause))
            return let(let(self.declared(text, two_clause), lambda ds: F.coalesce(
                F.array_min(F.transform(F.filter(ds, lambda d: d["joint"]), lambda d: d["entry"])),
                F.array_min(F.array(of_lines(lines, two_clause), of_windows(all_terms, two_clause), whole,
                                    F.array_min(F.transform(ds, lambda d: d["entry"])))))),
                       lambda b: F.when(b.isNotNull(), F.struct(
                           b["minus"].alias("minus"), b["license"].alias("license"), b["n"].alias("n"),
                           F.size(all_terms).alias("size"))))

        # a name may be parted by line ends and comment marks
        return F.when(text.rlike(ANCHOR.replace(" ", r"[^a-z0-9]+")), let(lines, lambda ls: let(
            terms(F.array_join(ls, " ")), lambda a: found_in(ls, a))))


def scan(files: DataFrame, path_col: str = "path", text_col: str = "text",
         id_col: str = "doc_id") -> DataFrame:
    """id, path, license, cosine (own evidence), origin (own, inherited or none), license_path."""
    rows = files.select(F.col(id_col).alias("doc_id"), F.col(path_col).alias("path"),
                        F.col(text_col).alias("text"))
    words = sorted({t for _, text in TEMPLATES for t in plain_terms(text)})
    evidence = Evidence(document_frequencies(rows, words))
    named = F.regexp_extract("path", r"([^/]*)$", 1).rlike(LICENCE_FILE)
    # every text is read in its own row; what stays of it is narrow
    own = checkpointed(rows.select("doc_id", "path", named.alias("named"), directory(F.col("path")).alias("folder"),
                                   evidence.best(F.col("text"), named).alias("b")).select(
        "doc_id", "path", "folder", F.col("b.license").alias("own_license"), (-F.col("b.minus")).alias("cosine"),
        (F.col("named") | (F.col("b.n") * 2 >= F.col("b.size"))).alias("licence_file")))
    # nearest ancestor with a licence file, worked out for each directory once
    folders = (own.where("own_license is not null and licence_file and path is not null")
               .groupBy(F.col("folder").alias("above"))
               .agg(F.min(F.struct((-F.col("cosine")).alias("minus"), "path", "own_license")).alias("l"))
               .select("above", F.col("l.path").alias("license_path"),
                       F.col("l.own_license").alias("folder_license")))
    nearest = checkpointed(own.where("path is not null").select("folder")
               .distinct().select("folder", F.explode(ancestors(F.col("folder"))).alias("above"))
               .join(folders, "above").groupBy("folder")
               .agg(F.max(F.struct(F.length("above").alias("depth"), "license_path", "folder_license")).alias("n"))
               .select("folder", "n.license_path", "n.folder_license"))
    return (own.join(nearest, "folder", "left")
            .select("doc_id", "path", F.coalesce("own_license", "folder_license").alias("license"),
                    "cosine", F.when(F.col("own_license").isNotNull(), "own")
                    .when(F.col("folder_license").isNotNull(), "inherited").otherwise("none")
                    .alias("origin"),
                    F.when(F.col("own_license").isNull(), F.col("license_path"))
                    .alias("license_path")))
