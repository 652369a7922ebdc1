"""Licence scans against a plain TF-IDF cosine, and directory inheritance."""

import math
import re
from collections import Counter

from lumenreg.llm import licenses as N
from lumenreg.llm.queries import document_files, op2_licenses
from tests.conftest import SF_SMALL
from tests.llm.cases import prose

MIT, APACHE = N.TEMPLATES[4][1], N.TEMPLATES[1][1]


def terms(text):
    return [t for t in (x.strip(".") for x in re.split(N.TERM, text.lower().replace("mit-0", "mit0"))) if t]


def plain_scan(texts):
    """{number: (license, cosine)} of the texts that have one, and the share of terms it spans."""
    vocabulary = {t for _, x in N.TEMPLATES for t in terms(x)}
    df = Counter(t for x in texts for t in set(terms(x or "")) & vocabulary)
    idf = lambda t: math.log((1 + len(texts)) / (1 + df[t])) + 1
    unseen, out = math.log(1 + len(texts)) + 1, {}
    vectors = []
    for name, text in N.TEMPLATES:
        v = {t: n * idf(t) for t, n in Counter(terms(text)).items()}
        vectors.append((name, v, math.sqrt(sum(x * x for x in v.values()))))
    anchor = re.compile(N.ANCHOR)
    for number, text in enumerate(texts):
        lines, best = (text or "").split("\n"), None
        for i, line in enumerate(lines):
            if not anchor.search(line):
                continue
            for window in N.WINDOWS:
                found = terms(" ".join(lines[i:i + window]))
                tf = Counter(found)
                squares = sum((n * idf(t)) ** 2 if t in vocabulary else n * unseen * unseen
                              for t, n in tf.items())
                # a term of no template weighs n * unseen^2 in the squared length
                for name, v, length in vectors:
                    dot = sum(n * idf(t) * v[t] for t, n in tf.items() if t in v)
                    cosine = round(dot / length / math.sqrt(squares), 6) if squares else 0
                    if cosine >= N.MIN_COSINE:
                        rank = (-cosine, name, len(found))
                        best = min(best, rank) if best else rank
        if best:
            out[number] = (best[1], -best[0], best[2] * 2 >= len(terms(text)))
    return out


def test_headers_and_inheritance(spark):
    files = [("a/LICENSE", MIT.replace(", ", ",\n")), ("a/b/c/x.py", prose(1, 50)),
             ("a/b/y.py", "\n".join([prose(2, 200)] + APACHE.split(". "))),
             ("a/b/d/COPYING", APACHE), ("a/b/d/e/z.py", prose(3, 20)), ("top.py", prose(4, 20)),
             ("ab/q.py", prose(5, 20)), (None, prose(6, 20)), (None, MIT), ("a/null.py", None),
             ("n/odd.py", "the license of this is " + prose(7, 300))]
    df = spark.createDataFrame([(i, *f) for i, f in enumerate(files)],
                               "doc_id long, path string, text string")
    out = {r["doc_id"]: r for r in N.scan(df).collect()}
    assert [(out[i]["license"], out[i]["origin"], out[i]["license_path"]) for i in range(11)] == [
        ("MIT", "own", None), ("MIT", "inherited", "a/LICENSE"), ("Apache-2.0", "own", None),
        ("Apache-2.0", "own", None), ("Apache-2.0", "inherited", "a/b/d/COPYING"),
        (None, "none", None), (None, "none", None), (None, "none", None), ("MIT", "own", None),
        ("MIT", "inherited", "a/LICENSE"), (None, "none", None)]


def test_query_against_plain_cosine(spark):
    files = document_files(spark, SF_SMALL).collect()
    want = plain_scan([r["text"] for r in files])
    own = {files[k]["doc_id"]: v[:2] for k, v in want.items()}
    folders = {}
    for k, (name, cosine, licence_file) in sorted(want.items()):
        if licence_file:
            path = files[k]["path"]
            folder = path.rpartition("/")[0]
            folders[folder] = min(folders.get(folder, (1, "")), (-cosine, path, name))
    out = {r["doc_id"]: r for r in op2_licenses(spark, SF_SMALL).collect()}
    assert len(out) == len(files)
    for f in files:
        r, above, parts = out[f["doc_id"]], None, f["path"].split("/")[:-1]
        for n in range(len(parts), -1, -1):
            above = above or folders.get("/".join(parts[:n]))
        if f["doc_id"] in own:
            assert (r["license"], r["cosine"], r["origin"]) == (*own[f["doc_id"]], "own")
        elif above:
            assert (r["license"], r["license_path"], r["origin"]) == (above[2], above[1], "inherited")
        else:
            assert (r["license"], r["origin"]) == (None, "none")


def own_licences(spark, texts):
    """The own licence of each text, among files of prose without one."""
    files = [(i, f"f{i}/x.txt", t) for i, t in enumerate(texts)]
    files += [(1000 + i, f"p{i}/x.txt", prose(i, 40)) for i in range(30)]
    df = spark.createDataFrame(files, "doc_id long, path string, text string")
    out = {r["doc_id"]: r for r in N.scan(df).collect()}
    assert all(out[1000 + i]["origin"] == "none" for i in range(30))
    return [out[i]["license"] if out[i]["origin"] == "own" else None for i in range(len(texts))]


def test_notices_inside_lines_and_over_line_ends(spark):
    notices = {"Apache-2.0": "Licensed under the Apache License, Version 2.0.",
               "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
               "MIT": "Released under the MIT License.", "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0."}
    texts, want = [], []
    for k, (name, notice) in enumerate(notices.items()):
        a, b = prose(2 * k, 120), prose(2 * k + 1, 120)
        wrapped = " ".join(notice.split()[:3]) + "\n * " + " ".join(notice.split()[3:])
        for text in (f"{a}. {notice} {b}", f"{a}. {notice}", f"{a[:60]}. {notice} {b[:60]}",
                     f"{wrapped}\n{b}", f"{a}\n{a} {wrapped} {b}"):
            texts.append(text)
            want.append(name)
    wide = "\n// ".join(MIT.split(" "))  # one word a line
    assert own_licences(spark, [*texts, f"{prose(50, 90)}\n{wide}"]) == [*want, "MIT"]


SPDX = {"MPL-2.0": "MPL-2.0", "AGPL-3.0-or-later": "AGPL-3.0", "BSD-3-Clause": "BSD-3-Clause",
        "BSD-2-Clause": "BSD-2-Clause", "LGPL-2.1-only": "LGPL-2.1", "GPL-2.0+": "GPL-2.0",
        "GPL-3.0-only": "GPL-3.0", "CC0-1.0": "CC0-1.0", "CC-BY-SA-4.0": "CC-BY-SA-4.0", "ISC": "ISC", "MIT-0": "MIT-0",
        "EPL-2.0": None, "MS-PL": None, "GPL-1.0-only": None, "Apache-1.1": None}


def test_licences_are_told_apart(spark):
    gpl = ("This program is free software; you can redistribute it and/or modify\nit under the terms of "
           "the GNU General Public License as published by\nthe Free Software Foundation; either version "
           "2 of the License, or\n(at your option) any later version.\n\nThis program is distributed in "
           "the hope that it will be useful,\nbut WITHOUT ANY WARRANTY; without even the implied warranty "
           "of\nMERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the\nGNU General Public License "
           "for more details.")
    head = "Copyright (c) 2020, Jane Roe\n\n"
    full = {"ISC": N._ISC + N._ISC_DISCLAIMER, "MIT": N._MIT, "Unlicense": N._UNLICENSE,
            "BSD-2-Clause": N._BSD_CONDITIONS + N._BSD_DISCLAIMER,
            "BSD-3-Clause": (N._BSD_CONDITIONS + N._BSD_THIRD + N._BSD_DISCLAIMER)
            .replace(". Redistributions", ". 2. Redistributions").replace(". Neither", ". 3. Neither"),
            "GPL-2.0": gpl,
            "AGPL-3.0": gpl.replace("GNU", "GNU Affero").replace("version 2", "version 3"),
            "LGPL-2.1": gpl.replace("GNU", "GNU Lesser").replace("version 2", "version 2.1")
            .replace("program", "library")}
    texts = [f"# SPDX-License-Identifier: {x}\n{prose(7, 50)}" for x in SPDX]
    texts += [head + "\n".join(t.split(". ")) + "\n" + prose(8, 60) for t in full.values()]
    assert own_licences(spark, texts) == [*SPDX.values(), *full]


def test_expressions_and_manifest_lines(spark):
    a, b = prose(1, 60), prose(2, 60)
    want = {
        f"// SPDX-License-Identifier: MIT OR Apache-2.0\n{a}": "MIT OR Apache-2.0",
        f"SPDX-License-Identifier: (GPL-2.0-only WITH Classpath-exception-2.0 OR MIT) AND ISC\n{a}":
            "(GPL-2.0 WITH Classpath-exception-2.0 OR MIT) AND ISC",
        f"SPDX-License-Identifier: MIT AND EPL-2.0\n{a}": "MIT AND unknown",
        f"SPDX-License-Identifier: EPL-2.0 OR MS-PL\n{a}": None,
        f"SPDX-License-Identifier: MIT or {a}": "MIT",
        f"{a} This crate is dual licensed under MIT or Apache-2.0. {b}": "MIT OR Apache-2.0",
        f"[package]\nname = 'x'\nlicense = \"MIT\"\n{a}": "MIT",
        f"[package]\nlicense = \"MIT/Apache-2.0\"\n{a}": "MIT OR Apache-2.0",
        f'{{\n  "name": "x",\n  "license": "Apache-2.0",\n  "v": 1}}\n{a}': "Apache-2.0",
        f'{{\n  "license": "(MIT OR CC0-1.0)"\r\n}}\n{a}': "(MIT OR CC0-1.0)",
        f"Name: x\nLicense: MIT\n{a}": "MIT", f"License: see the file\n{a}": None, f"license: unknown\n{a}": None,
        f"License: MIT-0\n{a}": "MIT-0", f"{a} Licensed under the MIT-0 License. {b}": "MIT-0",
        "MIT No Attribution\n\n" + N._MIT_GRANT.partition(", subject to")[0] + "." + N._NO_WARRANTY + N._LIABLE: "MIT-0",
        f"{a}\nlicensed: MIT is what one reads": None,
        "Apache License Version 2.0 is great, the driver's license version 2.0 too": None,
        f"{a}\nThe Apache License Version 2.0 has a licence of version 2.0 in it.\n{b}": None,
        "license: " + "( " * 20_000 + "\n" * 20_000 + "license: " + "a/" * 5_000 + " b": None}
    assert dict(zip(want, own_licences(spark, list(want)))) == want


def test_expressions_are_inherited(spark):
    rows = [(1, "a/LICENSE", "SPDX-License-Identifier: MIT OR Apache-2.0"), (2, "a/b/x.py", prose(1, 40)),
            (3, "a/c/LICENSE", N._MIT), (4, "a/c/x.py", None)]
    got = {r["doc_id"]: r for r in N.scan(spark.createDataFrame(rows, "doc_id long, path string, text string"))
           .collect()}
    assert [(got[i]["license"], got[i]["origin"]) for i in range(1, 5)] == [
        ("MIT OR Apache-2.0", "own"), ("MIT OR Apache-2.0", "inherited"), ("MIT", "own"), ("MIT", "inherited")]


def test_licence_files_are_whole(spark):
    texts = [N._BSD_CONDITIONS.replace("Redistributions", "* Redistributions") + N._BSD_DISCLAIMER, N._MIT,
             "GNU GENERAL PUBLIC LICENSE\nVersion 3, 29 June 2007\n\nCopyright (C) 2007 Free Software "
             "Foundation, Inc. <https://fsf.org/>\nEveryone is permitted to copy and distribute verbatim "
             "copies\nof this license document, but changing it is not allowed.\n" + prose(3, 900)]
    files = [(i, f"{i}/LICENSE", "\n".join(t.split(", "))) for i, t in enumerate(texts)]
    files += [(10 + i, f"{i}/x/y.py", prose(i, 30)) for i in range(30)]
    out = {r["doc_id"]: r for r in N.scan(spark.createDataFrame(
        files, "doc_id long, path string, text string")).collect()}
    names = ["BSD-2-Clause", "MIT", "GPL-3.0"]
    assert [out[i]["license"] for i in range(3)] == names
    assert [(out[10 + i]["license"], out[10 + i]["license_path"]) for i in range(3)] == [
        (n, f"{i}/LICENSE") for i, n in enumerate(names)]


def test_many_naming_terms_in_one_file(spark):
    """Windows are laid one at a time: a file that names licences 20,000 times is one row."""
    import time

    many = "gnu " * 20_000
    notice = "This work is licensed under the GNU General Public License, version 3."
    rows = [(1, "a/x", many), (2, "a/y", many + notice), (3, "b/z", "MIT License " + "word " * 300_000)]
    start = time.time()
    got = {r["doc_id"]: r for r in N.scan(spark.createDataFrame(rows, "doc_id long, path string, text string"))
           .collect()}
    assert time.time() - start < 60
    assert (got[1]["license"], got[2]["license"], got[2]["origin"]) == (None, "GPL-3.0", "own")
    assert len(got) == 3


def test_texts_are_not_shuffled(spark):
    """A block's cosine is worked out in its own row: no exchange carries terms or texts."""
    df = spark.createDataFrame([(1, "a/LICENSE", "Licensed under the MIT License.")],
                               "doc_id long, path string, text string")
    plan = N.scan(df)._jdf.queryExecution().toString()
    assert "text" not in plan.split("== Physical Plan ==")[1] and "Python" not in plan
