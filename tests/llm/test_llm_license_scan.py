import math
import re
from collections import Counter

from corpus_cases import documents, edge_docs, edge_rows, empty_docs

from sysledger.llm import license_scan as ls
from sysledger.llm.license_scan import LICENCE_FILE, TEMPLATES, THRESHOLD, WORD, scan, with_paths

NAMES = {n.lower(): n for n, _ in TEMPLATES}
COUNTS = [(n, Counter(re.findall(WORD, t.lower()))) for n, t in TEMPLATES]
DF = Counter(w for _, c in COUNTS for w in c)
IDF = {w: math.log((len(COUNTS) + 1) / (k + 1)) + 0.1 for w, k in DF.items()}
OTHER = sum(k * IDF[w] for w, k in DF.items()) / sum(DF.values())
VECTORS = []
for _name, _c in COUNTS:
    _v = {w: (1 + math.log(k)) * IDF[w] for w, k in _c.items()}
    _norm = math.sqrt(sum(x * x for x in _v.values()))
    VECTORS.append((_name, {w: x / _norm for w, x in _v.items()}))


def best(text, is_licence_file=False):
    """(licence, score) of a text's best unit, by dense vectors."""
    text = text or ""
    if line := re.search(ls.SPDX, text):
        for word in re.findall(ls.SPDX_ID, line[1].lower()):
            if (name := NAMES.get(re.sub(ls.SPDX_TAIL, "", word))) is not None:
                return name, 1.0
    bare = re.sub(ls.COMMENT, "", text)
    units = {u for line in bare.split("\n") for u in re.split(ls.SENTENCE_END, line)}
    units |= {p for p in re.split(ls.PARAGRAPH_END, bare) if "\n" in p.strip(" ")}
    if is_licence_file:
        units.add(bare)
    found = []
    for unit in units:
        if not re.search(ls.LICENCE_WORDS, unit):
            continue
        x = {w: (1 + math.log(k)) * IDF.get(w, OTHER) for w, k in Counter(re.findall(WORD, unit.lower())).items()}
        norm = math.sqrt(sum(v * v for v in x.values()))
        for name, t in VECTORS:
            dot = sum(v * t.get(w, 0) for w, v in x.items())
            if norm and (s := round(dot / norm, 9)) >= THRESHOLD:
                found.append((s, name))
    return max(found, default=(None, None))[::-1]


def expected(files):
    own = [(i, p, *best(t, bool(re.match(LICENCE_FILE, (p or '').rpartition('/')[2])))) for i, p, t in files]
    lent = {}
    for _, path, licence, s in own:
        folder, _, name = (path or "").rpartition("/")
        if licence and re.match(LICENCE_FILE, name):
            lent[folder] = max(lent.get(folder, (0, "")), (s, licence))
    out = []
    for i, path, licence, s in own:
        kind, at = ("own", None) if licence else ("none", None)
        if not licence:
            folder = (path or "").rpartition("/")[0]
            while True:
                if folder in lent:
                    kind, at, licence = "inherited", folder, lent[folder][1]
                    break
                if not folder:
                    break
                folder = folder.rpartition("/")[0]
        out.append((i, path, licence, kind, at))
    return Counter(out)


def got(df):
    return Counter((r.doc_id, r.path, r.licence, r.kind, r.licence_folder) for r in df.collect())


def test_every_template_is_its_own_licence():
    for name, text in TEMPLATES:
        assert best(text, True)[0] == name, text


def test_every_template_has_a_licence_word():
    assert all(re.search(ls.LICENCE_WORDS, text) for _, text in TEMPLATES)


def test_documents(spark):
    files = with_paths(documents(spark))
    assert got(scan(files)) == expected([tuple(r) for r in files.collect()])


def test_folders(spark):
    mit, gpl = "Released under the MIT License.", "This work is licensed under the GNU General Public License, version 3."
    rows = [
        (1, "LICENSE", mit), (2, "a.txt", "words"), (3, "x/y/z/b.txt", "words"), (4, "x/y/LICENSE.md", gpl), (5, "x/y/c.txt", mit + "\nwords"),
        (6, "x/y/z/w/d.txt", None), (7, "x/yy/e.txt", ""), (8, "x/COPYING", "no licence here"), (9, None, "words"),
        (10, "q/LICENSE", mit), (11, "q/LICENSE", gpl), (12, "q/f.txt", "words"), (12, "q/f.txt", "words"), (13, "x/y", "a file called y"),
        (14, "licence words in a name.txt", "released under the mit"),
    ]
    files = spark.createDataFrame(rows, "doc_id long, path string, text string")
    result = got(scan(files))
    assert result == expected(rows)
    assert result[(6, "x/y/z/w/d.txt", "GPL-3.0", "inherited", "x/y")] == 1
    assert result[(7, "x/yy/e.txt", "MIT", "inherited", "")] == 1


def test_edges(spark):
    files = with_paths(edge_docs(spark))
    assert sum(got(scan(files)).values()) == len(edge_rows())
    assert scan(with_paths(empty_docs(spark))).collect() == []


PROSE = "The committee met in the spring. It discussed the version of the work that was released to the public under new terms of use."
# Written by hand, not by the model: how files declare their licence, and texts that do not.
DECLARED = [
    ("MIT License", "MIT"), ("The MIT License (MIT)", "MIT"), ("GNU GENERAL PUBLIC LICENSE", "GPL"), ("GNU LESSER GENERAL PUBLIC LICENSE", "LGPL"),
    ("                    GNU GENERAL PUBLIC LICENSE\n                       Version 3, 29 June 2007\n\nEveryone is permitted to copy", "GPL-3.0"),
    ("GNU GENERAL PUBLIC LICENSE\nVersion 2, June 1991", "GPL-2.0"), ("GNU AFFERO GENERAL PUBLIC LICENSE\n Version 3, 19 November 2007", "AGPL-3.0"),
    ("Apache License\nVersion 2.0, January 2004\nhttp://www.apache.org/licenses/", "Apache-2.0"), ("BSD 3-Clause License", "BSD-3-Clause"),
    ("BSD 2-Clause License\n\nCopyright (c) 2021, Jo Do\nAll rights reserved.", "BSD-2-Clause"), ("Mozilla Public License Version 2.0", "MPL-2.0"),
    ("Copyright 2024 Foo Inc. Licensed under the Apache License, Version 2.0.", "Apache-2.0"),
    ("Copyright (c) 2020 Jane Doe. All rights reserved. Released under the MIT License.", "MIT"),
    ("This project is released under the MIT License.", "MIT"), ("# This file is distributed under the terms of the ISC License.", "ISC"),
    ("SPDX-License-Identifier: Apache-2.0", "Apache-2.0"), ("// SPDX-License-Identifier: GPL-2.0-or-later", "GPL-2.0"),
    ("/* SPDX-License-Identifier: (MIT OR Apache-2.0) */", "MIT"), ("# spdx-license-identifier: LGPL-2.1+", "LGPL-2.1"),
    ("SPDX-License-Identifier: Own-Licence-9\ncode", None),
    ("/*\n * Copyright 2019 The Authors\n *\n * Licensed under the Apache License, Version 2.0 (the \"License\");\n * you may not use this file except in"
     " compliance with the License.\n * You may obtain a copy of the License at\n *\n *     https://www.apache.org/licenses/LICENSE-2.0\n */\nint main;",
     "Apache-2.0"),
    ("# This program is free software: you can redistribute it and/or modify\n# it under the terms of the GNU General Public License as published by\n"
     "# the Free Software Foundation, either version 3 of the License, or\n# (at your option) any later version.\n#\n# This program is distributed in the"
     " hope that it will be useful,\n# but WITHOUT ANY WARRANTY; without even the implied warranty of\n# MERCHANTABILITY or FITNESS FOR A PARTICULAR"
     " PURPOSE.\nimport os", "GPL-3.0"),
    ("-- This Source Code Form is subject to the terms of the Mozilla Public\n-- License, v. 2.0. If a copy of the MPL was not distributed with this\n"
     "-- file, You can obtain one at https://mozilla.org/MPL/2.0/.\nselect 1", "MPL-2.0"),
    ("Use of this source code is governed by a BSD-style\nlicense that can be found in the LICENSE file.", "BSD-3-Clause"),
    ("Permission to use, copy, modify, and/or distribute this software for any\npurpose with or without fee is hereby granted, provided that the above\n"
     "copyright notice and this permission notice appear in all copies.", "ISC"),  # without the disclaimer
    (PROSE, None), ("Mit.", None), ("MIT!!", None), ("Nur mit der Lizenz.", None), ("Our students at MIT and Mozilla wrote about public life in Boston, general software and the apache people.", None),
    ("The gate is licensed under the law of the general assembly of the city.", None), ("All rights reserved.", None), ("Copyright 2024 Foo Inc.", None),
    ("Das Werk ist unter der Lizenz\nCreative Commons Attribution 4.0 International\nverfügbar.", "CC-BY-4.0"), ("", None), (None, None),
    ("Some of the rights to the software of this program are held by the author and the names of the copyright holders.", None),
    ("General terms and conditions of the public library: the license to use the source is granted to any person.", None),
]


def test_declarations_written_by_hand(spark):
    rows = [(i, f"f/{i}.txt", t if t is None or i % 2 else f"{t}\n\n{PROSE}") for i, (t, _) in enumerate(DECLARED)]
    got = {r.doc_id: r.own_licence for r in scan(spark.createDataFrame(rows, "doc_id long, path string, text string")).collect()}
    wrong = [(DECLARED[i][0], got[i], DECLARED[i][1]) for i in got if got[i] != DECLARED[i][1]]
    assert not wrong, wrong


def test_whole_licence_files(spark):
    """The short licences as files, with a holder, wrapped anew."""
    import textwrap

    from sysledger.llm.license_texts import TEXTS

    rows, want = [], {}
    for i, (name, text) in enumerate(TEXTS):
        if len(text) > 300:
            body = "\n".join(textwrap.wrap(text, 60))
            rows.append((i, f"p{i}/LICENSE", f"Copyright (c) 2017-2023 Some Holder, Inc. and contributors\n\n{body}\n"))
            rows.append((100 + i, f"p{i}/src/deep/a.txt", PROSE))
            want[i] = (name, "own")
            want[100 + i] = (name, "inherited")
    got = {r.doc_id: (r.licence, r.kind) for r in scan(spark.createDataFrame(rows, "doc_id long, path string, text string")).collect()}
    assert got == want


def test_common_units_by_the_shuffled_way(spark, monkeypatch):
    mit = "Released under the MIT License."
    rows = [(i, f"f/{i}", f"text number {i}\n{mit}" if i % 3 == 0 else f"Licensed under the ISC License. {i}") for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, path string, text string")
    whole = ls.join_totals
    monkeypatch.setattr(ls, "join_totals", lambda *a, **k: whole(*a, **k, limit=-1))
    assert Counter(r.licence for r in scan(df).collect()) == {"MIT": 100, "ISC": 200}
