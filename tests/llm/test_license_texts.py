"""Licences of real texts and headers; versions and variants are not confused."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tamiz.llm.license_scan import license_scan

SCHEMA = "path string, text string"
MIT = """MIT License

Copyright (c) 2019 Jane Roe

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.
"""
BSD2 = """Copyright (c) 2011, Jane Roe
All rights reserved.

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
%s
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"
AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE
FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL
DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR
SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER
CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY,
OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE
OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.
"""
NAMES = """
3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.
"""


def gnu(name, version, what="program"):
    return (
        f"This {what} is free software; you can redistribute it and/or modify\n"
        f"it under the terms of the GNU {name} as published by\n"
        "the Free Software Foundation; either version "
        f"{version} of the License, or\n(at your option) any later version.\n"
    )


def comment(text, marker="# "):
    return "".join((marker + x).rstrip() + "\n" for x in text.splitlines())


APACHE = """Copyright 2020 Jane Roe

Licensed under the Apache License, Version %s (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-%s
"""
GPL, LESSER = "General Public License", "Lesser General Public License"
WANT = [
    ("mit/LICENSE", MIT, "MIT"),
    ("bsd2/LICENSE", BSD2 % "", "BSD-2-Clause"), ("bsd3/LICENSE", BSD2 % NAMES, "BSD-3-Clause"),
    ("bsd3.py", comment(BSD2 % NAMES) + "import os\n", "BSD-3-Clause"),
    ("a.py", "#!/usr/bin/env python\n" + comment(APACHE % ("2.0", "2.0")) + "import os\n", "Apache-2.0"),
    ("a11.py", comment(APACHE % ("1.1", "1.1")), None),
    ("g2.c", "/*\n" + comment(gnu(GPL, "2"), " * ") + " */\nint x;\n", "GPL-2.0"),
    ("g3.c", "/*\n" + gnu(GPL, "3") + "*/\nint x;\n", "GPL-3.0"),
    ("l21.c", comment(gnu(LESSER, "2.1", "library"), "// ") + "int x;\n", "LGPL-2.1"),
    ("l3.c", comment(gnu(LESSER, "3", "library"), "// "), "LGPL-3.0"),
    ("ag.py", comment(gnu("Affero " + GPL, "3")), "AGPL-3.0"),
    ("g9.py", comment(gnu(GPL, "9")), None),
    ("m.js", "// This Source Code Form is subject to the terms of the Mozilla Public\n"
     "// License, v. 2.0. If a copy of the MPL was not distributed with this\n"
     "// file, You can obtain one at https://mozilla.org/MPL/2.0/.\nlet x;\n", "MPL-2.0"),
    ("gpl/COPYING", "                    GNU GENERAL PUBLIC LICENSE\n"
     "                       Version 3, 29 June 2007\n\n Copyright (C) 2007\n", "GPL-3.0"),
    ("cc1", "Licensed under CC BY-NC-SA 4.0.", "CC-BY-NC-SA-4.0"),
    ("cc2", "Licensed under CC BY-SA 4.0.", "CC-BY-SA-4.0"), ("cc3", "Licensed under CC BY-SA 3.0.", None),
    ("s1", "// SPDX-License-Identifier: GPL-2.0-only", "GPL-2.0"),
    ("s2", "SPDX-License-Identifier: MIT-0", "MIT-0"),
    ("plain", "A public version of the general software is free.\nNothing more.\n", None),
]


def test_texts_and_headers(spark):
    files = spark.createDataFrame([w[:2] for w in WANT], SCHEMA)
    got = {r["path"]: r["license"] for r in license_scan(files).collect()}
    assert got == {path: name for path, _, name in WANT}


@pytest.mark.parametrize("rows", [1, 30])
def test_whole_licence_files_of_this_machine(spark, rows):
    names = {
        "Apache-2.0": "Apache-2.0", "GPL-2": "GPL-2.0", "GPL-3": "GPL-3.0", "LGPL-2.1": "LGPL-2.1",
        "LGPL-3": "LGPL-3.0", "MPL-2.0": "MPL-2.0", "CC0-1.0": "CC0-1.0", "BSD": "BSD-3-Clause",
    }
    folder = Path("/usr/share/common-licenses")
    found = {k: v for k, v in names.items() if (folder / k).is_file()}
    if not found:
        pytest.skip("no licence texts on this machine")
    text = {k: (folder / k).read_text(errors="replace") for k in found}
    files = [(f"{k}/{i}/LICENSE", text[k]) for k in found for i in range(rows)]
    files += [(f"{k}/0/x.py", "x = 1") for k in found]
    got = license_scan(spark.createDataFrame(files, SCHEMA)).collect()
    assert {(r["path"].split("/")[0], r["license"]) for r in got} == set(found.items())


def test_verdicts_do_not_depend_on_the_size(spark):
    """A statement among ordinary words; the more lines, the more the words weighed."""
    ordinary = "This file is one of the files that is in the box and this is the house."
    statement = "This file is released under the MIT License."
    files = [(f"f{i}", ordinary + f"\nrow {i}") for i in range(400)] + [("said", statement)]
    scores = set()
    for times in (1, 50):
        rows = spark.createDataFrame(files, SCHEMA).crossJoin(spark.range(times)).drop("id")
        said = license_scan(rows).filter(F.col("path") == "said").select("license", "score").first()
        assert said["license"] == "MIT"
        scores.add(said["score"])
    assert len(scores) == 1


def test_many_licence_files_in_a_directory(spark):
    """The best score counts, then the first path; no directory is gathered in one value."""
    said = [("MIT", "Released under the MIT License."), ("CC-BY-4.0", "Licensed under CC BY 4.0.")]
    files = [(f"d/LICENSE-{i:03d}", said[i % 2][1]) for i in range(60)] + [("d/x.py", "x = 1")]
    scanned = license_scan(spark.createDataFrame(files, SCHEMA))
    assert "collect_" not in scanned._jdf.queryExecution().toString()
    row = scanned.filter(F.col("path") == "d/x.py").first()
    assert (row["license"], row["license_from"]) == ("MIT", "d/LICENSE-000") and row["inherited"]


def test_columns_of_any_name_stay(spark):
    """Columns named like helpers of the scan, and like its results."""
    names = ["source", "dir", "own_path", "own_license", "home", "__dir", "__source", "score", "word"]
    rows = [("a/LICENSE", "MIT License", *names), ("a/b/x.txt", "plain words", *names), (None, None, *names)]
    files = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in ["path", "text", *names]))
    found = license_scan(files)
    kept = [c for c in names if c != "score"]
    assert found.columns == ["path", "text", *kept, "license", "score", "license_from", "inherited"]
    got = {r["path"]: (r["license"], r["license_from"], r["inherited"]) for r in found.collect()}
    assert got["a/b/x.txt"] == (got["a/LICENSE"][0], "a/LICENSE", True) and got["a/LICENSE"][0]
    assert got[None] == (None, None, False)
    assert all(r[c] == c for r in found.collect() for c in kept)


def test_scores_equal_a_plain_cosine(spark):
    """Every line's cosine to every template, weights from the shares of lines."""
    import math
    import re

    templates = [("ONE", "alpha beta licence grant"), ("TWO", "gamma delta delta licence")]
    texts = [
        "alpha beta licence grant\nwords of no matter", "alpha licence grant and more words",
        "gamma delta delta licence", "delta delta gamma licence licence", "matter of words\nalpha", "", None,
    ]
    lines = [line for t in texts if t is not None for line in t.split("\n")]
    words = [re.findall(r"[^\W_]+", line.lower()) for line in lines]

    def weight(word):
        share = sum(word in w for w in words) / len(lines)
        return math.log(1.001 / (share + 0.001)) + 1

    def vector(ws):
        return {w: ws.count(w) * weight(w) for w in ws}

    def cosine(a, b):
        size = math.sqrt(sum(x * x for x in a.values()) * sum(x * x for x in b.values()))
        return sum(x * b.get(w, 0) for w, x in a.items()) / size if size else 0.0

    expected = {}
    for i, t in enumerate(texts):
        scored = [
            (round(cosine(vector(re.findall(r"[^\W_]+", line)), vector(text.split())), 6), -k, name)
            for line in (t or "").split("\n") for k, (name, text) in enumerate(templates)
        ]
        top = max(scored)
        expected[f"f{i}"] = (top[2], top[0]) if top[0] >= 0.5 else (None, None)
    files = spark.createDataFrame([(f"f{i}", t) for i, t in enumerate(texts)], "path string, text string")
    found = {r["path"]: (r["license"], r["score"]) for r in license_scan(files, templates, 0.5).collect()}
    assert found == expected and sum(v[0] is not None for v in expected.values()) >= 3


def test_small_tables_are_staged_in_few_files(spark, tmp_path, monkeypatch):
    """By their size, not one per shuffle partition."""
    monkeypatch.setattr(
        "tamiz.llm.license_scan.shared_folder", lambda spark, purpose: f"file://{tmp_path}/{purpose}"
    )
    held = {
        "spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "32",
    }
    before = {k: spark.conf.get(k) for k in held}
    rows = [(f"{i}/LICENSE", f"Released under the MIT License.\nword{i} of {i * i}") for i in range(100)]
    try:
        for k, v in held.items():
            spark.conf.set(k, v)
        found = license_scan(spark.createDataFrame(rows, SCHEMA).coalesce(2)).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert {r["license"] for r in found} == {"MIT"} and len(found) == len(rows)
    parts = {p.name: len(list(p.glob("part-*"))) for p in tmp_path.glob("*/*")}
    assert parts == {"near": 2, "often": 1, "known": 1, "own": 1}
