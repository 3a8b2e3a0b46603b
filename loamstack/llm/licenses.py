"""The licence of each file and repository.

A multinomial logistic regression over word n-grams, trained here on variants of statement templates, reads the sentences that
name a licence and the paragraphs that are a licence's own text. Sentences like no template, of other licences, or that only mention
one are rejected: by the classes `other` and `none`, by a least probability and by the share of known words. File statements are then
reconciled with the licence files in the repository's top folder.

The templates are written from the licences' public texts and names and from common ways to refer to them; no row of any table and
no sentence of one is used.
"""

from __future__ import annotations

import bisect
import itertools
import random
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loamstack.config import cut

# fixed values: the licences' names as their stewards and the SPDX list write them, and short forms in common use
_GPL = ("the GNU General Public License", "GNU General Public License", "the GNU GPL", "the GPL", "GPL", "GNU GPL")
_ONLY = ("{g} version 2", "{g} version 2 only", "{g}, version 2 only", "{g} v2 only", "{g}, version 2 as published by the Free Software Foundation", "version 2 of {g}", "version 2 only of {g}", "only version 2 of {g}", "version 2 (and no other version) of {g}", "{g} 2 only", "{g} version 2 and no later version", "{g} v2, no later version", "{g} 2.0 only")
_LATER = ("version {v} or later", "version {v} or any later version", "v{v} or later", "{v} or later", "either version {v} of the License, or (at your option) any later version", "version {v} or (at your option) any later version", "version {v} or newer", "version {v} or a newer one", "{v} or higher", "version {v} or above", "{v} or any newer version")
NAMES = {
    "MIT": ["MIT", "MIT License", "the MIT License", "the MIT licence", "the Expat License", "Expat", "MIT/Expat", "the MIT (Expat) license", "the MIT License (Expat)", "MIT license terms", "the terms of the MIT license", "an MIT-style license", "The MIT License (MIT)", "Expat (MIT) terms", "MIT terms"],
    "Apache-2.0": ["Apache-2.0", "Apache 2.0", "Apache 2", "the Apache License, Version 2.0", "Apache License 2.0", "the Apache License 2.0", "the Apache License v2.0", "the Apache-2.0 license", "ASL 2.0", "ALv2", "the Apache Software License, Version 2.0", "Apache License Version 2.0, January 2004", "version 2.0 of the Apache License", "the Apache 2 license", "the Apache 2.0 licence"],
    "BSD-3-Clause": ["BSD-3-Clause", "BSD 3-Clause", "the BSD 3-Clause License", "the 3-clause BSD license", "the three-clause BSD license", "the new BSD license", "the modified BSD license", "the revised BSD license", "BSD (3-clause)", "BSD (three clauses)", "the BSD license with three clauses", "a BSD-style license", "a 3-clause BSD licence", "BSD-3", "BSD 3 terms", "the New BSD License"],
    "BSD-2-Clause": ["BSD-2-Clause", "BSD 2-Clause", "the BSD 2-Clause License", "the 2-clause BSD license", "the two-clause BSD license", "the simplified BSD license", "the FreeBSD license", "BSD (2-clause)", "BSD (two clauses)", "the BSD license with two clauses", "a simplified 2-clause BSD licence", "BSD-2", "BSD 2 terms", "the Simplified BSD License", "the two-clause BSD licence"],
    "GPL-2.0-only": ["GPL-2.0-only", "GPLv2", "GPLv2 only", "GPL v2 only", *(f.format(g=g) for g in _GPL for f in _ONLY)],
    "GPL-3.0-or-later": ["GPL-3.0-or-later", "GPLv3+", "GPL-3.0+", "GPLv3 or later", "GPL v3 or later", "GPL 3+", *(f"{g}{sep}{f.format(v=3)}" for g in _GPL for sep in (" ", ", ", " as published by the Free Software Foundation, ") for f in _LATER), *(f"{f.format(v=3)} of {g}" for g in _GPL for f in _LATER if "License" not in f)],
    "MPL-2.0": ["MPL-2.0", "MPL 2.0", "MPLv2", "MPL v2", "the Mozilla Public License 2.0", "the Mozilla Public License, v. 2.0", "the Mozilla Public License, version 2.0", "Mozilla Public License Version 2.0", "Mozilla Public License 2.0", "version 2.0 of the Mozilla Public License", "the MPL 2.0", "the MPL, version 2.0"],
    "ISC": ["ISC", "ISC License", "the ISC License", "the ISC licence", "ISC license terms", "the Internet Systems Consortium license", "ISC terms", "the ISC (Internet Systems Consortium) license"],
    "other": [
        *(f"{g} {f.format(v=2)}" for g in _GPL for f in _LATER), *(f"{g}, {f.format(v=2)}" for g in _GPL for f in _LATER), *(f"{f.format(v=2)} of {g}" for g in _GPL for f in _LATER if "License" not in f), "GPL-2.0-or-later", "GPLv2+", "GPL-2.0+", "GPLv2 or later",
        "GPL-3.0-only", "GPLv3 only", *(f.format(g=g).replace("2.0", "3.0").replace("2", "3") for g in _GPL for f in _ONLY), "GPL-1.0-only", "GPL-1.0-or-later",
        *(f"{g}{sep}{f.format(v=v)}" for k in ("Lesser", "Library", "Affero") for g in (f"the GNU {k} General Public License", f"the {k[0]}GPL") for sep in (" ", " as published by the Free Software Foundation, ") for v in ("2.1", "3") for f in _LATER[:6]),
        "LGPL-2.1", "LGPL-2.1-only", "LGPL-2.1-or-later", "LGPL-3.0-or-later", "LGPLv2.1", "LGPLv3", "the GNU Lesser General Public License", "the GNU Lesser General Public License, version 2.1", "the GNU Lesser General Public License v3 or later", "the GNU Library General Public License version 2", "the LGPL", "AGPL-3.0-only", "AGPL-3.0-or-later", "AGPLv3", "the GNU Affero General Public License, version 3", "the GNU Affero General Public License version 3 or later", "the AGPL",
        "the Eclipse Public License 2.0", "EPL-2.0", "EPL-1.0", "the Eclipse Public License - v 1.0", "the zlib license", "Zlib", "the Boost Software License, Version 1.0", "BSL-1.0", "CC-BY-4.0", "CC-BY-SA-4.0", "CC0-1.0", "the Creative Commons Attribution 4.0 International License", "the Unlicense", "Unlicense", "the Artistic License 2.0", "Artistic-2.0", "WTFPL", "the Do What The Fuck You Want To Public License", "the Apache License, Version 1.1", "Apache-1.1", "Apache 1.0", "the Apache Software License, Version 1.1",
        "the Mozilla Public License Version 1.1", "MPL-1.1", "MPL 1.1", "MPL 1.0", "the Mozilla Public License, version 1.0", "the original BSD license", "the four-clause BSD license", "the 4-clause BSD license", "BSD-4-Clause", "0BSD", "the zero-clause BSD license", "MIT-0", "MIT No Attribution", "the Python Software Foundation License", "PSF-2.0", "CDDL-1.0", "the Common Development and Distribution License", "the European Union Public Licence", "EUPL-1.2", "OFL-1.1", "the SIL Open Font License", "the PostgreSQL License", "the Ruby license", "the PHP License 3.01", "the Vim license", "the Open Software License 3.0", "the Microsoft Public License", "MS-PL", "the Server Side Public License", "the Business Source License 1.1",
    ],
}
_CHOICE = ("{a} or {b}", "{a} OR {b}", "{a} or {b}, at your option", "either {a} or {b}", "either {a} or {b}, at your choice", "either of {a} or {b}", "{a} or {b}, whichever you prefer", "{a} or {b} (your choice)", "{a}/{b}", "{a} and {b}, as a dual license", "either {a} or, if you like better, {b}", "a choice of {a} and {b}", "your choice of {a} or {b}", "{a} or alternatively {b}", "one of {a} and {b}, as you wish")
# the ways to put a work under a licence, built from parts; {} is its name
_SUBJECTS = ("This file", "This program", "This code", "The code", "This source code", "This work", "This software", "This project", "This library", "This module", "This package", "The contents of this file", "All files", "Everything here", "The whole project", "It")
_GRANTS = ("is licensed", "are licensed", "is released", "is distributed", "is made available", "is available", "is provided", "is published", "is offered", "is shared", "may be used", "can be used", "may be copied and distributed", "can be redistributed and/or modified", "is free software", "comes")
_WAYS = ("under {}", "under the terms of {}", "under the conditions of {}", "on the terms of {}", "subject to {}", "as {} allows", "in accordance with {}", "to you under {}")
_TAILS = ("", "", "", ".", ".", "; see LICENSE.", ", see the LICENSE file for details.", " - see the file COPYING.", ". All rights reserved.", " that can be found in the LICENSE file.", " (the License)", "; you may not use this file except in compliance with the License.")
INTROS = [
    "{}", "{}", "{}", "# {}", "{}.", "The license is {}.", "License: {}", "License: {}", "Licence: {}", "License - {}", "Licensing: {}", "Terms: {}", "Terms and conditions: {}", "@license {}", "license {}", "SPDX-License-Identifier: {}", "Licensed under {}", "Licensed under {}.", "Released under {}.", "Distributed under {}.", "Available under {}.", "Published under {}.", "Provided under {}.", "Under {}.", "Dual licensed under {}.",
    "Use of this source code is governed by {} that can be found in the LICENSE file.", "Use is governed by {}.", "Governed by {}.", "Covered by {}.", "Subject to {}.", "Subject to the terms of {}.", "Use, modification and distribution are subject to {}.", "You may use, copy and change this file under {}.", "You can redistribute it and/or modify it under the terms of {}.", "We make this available to you under {}.", "We share this work under {}.", "The authors license this file to you under {}.", "The maintainers release this under {}.",
    "This program is free software: you can redistribute it and/or modify it under the terms of {}.", "This Source Code Form is subject to the terms of {}.", "This file is part of the library and is licensed under {}.", "The conditions of {} apply.", "As a whole this is under {}.",
]
# fixed values: the licences' own texts
BODIES = {
    "MIT": ["Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:", "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."],
    "ISC": ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."],
    "BSD-2-Clause": ["Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:", "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.", "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."],
}
_CLAUSE_3 = ["3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.", "Neither the name of the University nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.", "The name of the author may not be used to endorse or promote products derived from this software without specific prior written permission."]
_CLAUSE_4 = "3. All advertising materials mentioning features or use of this software must display the following acknowledgement: This product includes software developed by the organization."
_MIT_0 = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so."
_DISCLAIMERS = ["THE SOFTWARE IS PROVIDED AS IS, WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY.", "THE SOFTWARE IS PROVIDED AS IS AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS.", "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS AS IS AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED."]
# reserved works, from parts
_OWNERS = ("", "", " of the company", " of the authors", " of the {} team", " of the {} group", " of {}")
_CLOSED = (
    "Proprietary and confidential{}.", "This file is proprietary and confidential{}.", "This is proprietary software{}.", "Confidential and proprietary property{}.", "Proprietary.", "License: proprietary", "Terms: proprietary", "Licensed under a proprietary license{}.", "SPDX-License-Identifier: LicenseRef-Proprietary", "LicenseRef-Proprietary", "Closed source{}.", "This is closed source software{}.", "Closed-source code{}, not for redistribution.",
    "Internal property{}.", "Internal property{}, not open source.", "For internal use only, proprietary property{}; not for publication.", "This file contains confidential information{}.", "Trade secret and confidential property{}.", "Unauthorized copying of this proprietary file, via any medium, is strictly prohibited.", "Proprietary software{}; no part may be copied, published or shared without written permission.", "Confidential: do not copy or distribute without the prior written consent{}.", "Closed source{}: do not copy, publish or distribute.", "Proprietary code{}; all use needs a written agreement.", "Internal and confidential{}; all use is restricted.",
)
# sentences that mention a licence and put nothing under it, from parts: {n} a name, {w} a word
_VERBS = "checks compares maps converts detects parses finds lists counts sorts rejects accepts filters flags skips prints reads matches looks for recognises normalizes validates strips adds removes replaces translates tests explains describes stores returns shows warns about".split(" ")
_ACTORS = ("", "", "This parser", "The {w}", "This function", "It", "The check", "A test", "Our {w}", "This")
_OBJECTS = ("the {w} license against {n}", "{n}", "{n} and {n}", "{n}, {n} and {n}", "the names {n}, {n} and {n}", "whether the {w} is {n}", "the {w} for {n}", "{n} headers", "the text of {n}", "{n} to the {w}", "the {w} names {n} and {n}", "{n} in the {w}", "the license names {n}, {n} and {n} with the {w}", "{n} to its {w} code", "files under {n}")
_ASIDES = (
    "The {w} was under {n} until the {w} moved.", "It was {n} before the {w}.", "Formerly {n}, now something else.", "This is not licensed under {n}.", "Not under {n}.", "Unlike {n}, this needs no notice.", "The {w} depends on a library under {n}.", "The {w} is compatible with {n}.", "{n} is not compatible with the {w}.", "See {n} for the {w}.", "If the {w} is {n}, skip it.", "Is the {w} {n}?", "Why {n} and not {n}?", "A {w} under {n} is rejected.", "Any {w} that says {n} is flagged.", "You should have received a copy of {n} along with this program.", "You may obtain a copy of the License at", "{n} says otherwise.", "We asked about {n}.", "Some parts use {n} and others {n}.", "Use {n} for the {w} or nothing.", "No {n} code here.",
    "Students at MIT wrote the {w}.", "From a course at MIT.", "Needs GNU make and a BSD tar.", "Runs behind Apache 2.4 or newer.", "Works with Apache and nginx.", "Tested with Mozilla Firefox and GNU tools.", "Tested on BSD and GNU systems.", "Uses the ISC bind {w}.", "Confidential {w} fields are masked.", "Proprietary {w} formats are converted.", "Filters proprietary {w} headers.", "The {w} is confidential in the test.", "Supports proprietary and open {w} codecs.", "Masks confidential values in the {w}.", "Reads the GNU {w} format.", "The Apache {w} config.", "An Apache {w} is started first.",
)
FILLER = "buffer layer parser queue window table record driver cache token index reader score panel header file package license field value name list client build string model message user".split()

CUE = re.compile(r"\b(?:MIT|Expat|Apache|ASL|ALv2|(?:Free|Net|Open)?BSD|0BSD|[AL]?GPL(?:v?\d[\d.]*\+?)?|GNU|MPL(?:v?\d)?|Mozilla|ISC|Internet Systems|LicenseRef|EPL|EUPL|CDDL|WTFPL|Unlicense|[Pp]roprietary|PROPRIETARY|[Cc]onfidential|SPDX|spdx|[Cc]losed[ -]source|[Ii]nternal property|Permission is hereby granted|Permission to use, copy|Redistribution and use in)\b")
BODY = re.compile(r"Permission is hereby granted|Permission to use, copy|Redistribution and use in")
WORDS = re.compile(r"[a-z]+|\d+(?:\.\d+)*|\+")
SPDX = re.compile(r"(?i)spdx-licen[cs]e-identifier:\s*(\(?[\w.+\-]+(?:\s+(?:OR|AND|WITH)\s+[\w.+\-]+)*)")
MARK = re.compile(r"^[\s]*(?:#+|//[/!]?|/\*+!?|\*+/?|--|;+|%+|<!--|\"\"\"|''')?[ \t]*|[\s*]*(?:\*/|-->|\"\"\"|''')?\s*$")
LICENSE_FILE = r"(?i)^(?:licen[cs]e|copying|unlicense)(?:[.\-](?!(?:py|js|ts|go|rs|c|h|java|json|ya?ml|sh|rb|php)$)[\w.\-]+)?$"
CLASSES = [*(k for k in NAMES if k != "other"), "Apache-2.0 OR MIT", "LicenseRef-Proprietary", "other", "none"]
LEAST_PROBABILITY = 0.5
LEAST_KNOWN = 0.34
_FAMILIES = ("mit", "expat", "apache", "bsd", "gpl", "gnu", "mpl", "mozilla", "isc")
_OTHER_GPL = ("lesser", "library", "affero")
_EXTENT = ("later", "newer", "higher", "above", "+", "only", "no", "any")


def grams(sentence: str) -> list[str]:
    """Word 1- to 3-grams, and which versions stand with which extents and which families with each other anywhere in the sentence."""
    text = re.sub(r"\b(l|a)?gpl(?:\s*v)?[ -]?(\d)", r"\1gpl \2", sentence.lower().replace("licence", "license").replace("-", " "))
    w = WORDS.findall(re.sub(r"\bv\.?\s?(\d)", r"version \1", text).replace("mplv2", "mpl 2"))
    w = [re.sub(r"^(\d)\.0$", r"\1", x) for x in w]
    out = [" ".join(w[i : i + n]) for n in (1, 2, 3) for i in range(len(w) - n + 1)]
    have = set(w)
    if "gpl" in have or "gnu" in have:
        out += [f"gpl~{x}" for x in _OTHER_GPL if x in have]
        out += [f"{d}~{e}" for d in ("1", "2", "3") if d in have for e in ("open" if not have & set(_EXTENT[:5]) else "later", *(("only",) if have & {"only", "no"} else ()))]
    return out + [f"{a}~{b}" for a, b in itertools.combinations([f for f in _FAMILIES if f in have], 2)]


def training_set(seed: int = 7, each: int = 330) -> list[tuple[str, str]]:
    """(sentence, class) from the templates, about `each` a class; the same at every call. No rows of any table are used."""
    r = random.Random(seed)
    every = [n for k, ns in NAMES.items() for n in ns]

    def intro() -> str:
        return r.choice(INTROS) if r.random() < 0.6 else f"{r.choice(_SUBJECTS)} {r.choice(_GRANTS)} {r.choice(_WAYS)}{r.choice(_TAILS)}"

    def fill(t: str) -> str:
        t = re.sub(r"\{w\}", lambda _: r.choice(FILLER), t)
        return re.sub(r"\{n\}", lambda _: r.choice(("GPL", "MIT", "BSD", "Apache", "ISC", "MPL", r.choice(every))), t)

    out = []
    for k, ns in NAMES.items():
        for i in range(each if k != "other" else 3 * each):
            out.append((intro().replace("{}", ns[i] if i < len(ns) else r.choice(ns[:6]) if len(ns) > 30 and k != "other" and r.random() < 0.4 else r.choice(ns)), k))
    for _ in range(each):
        a, b = r.choice(NAMES["MIT"][:9]), r.choice(NAMES["Apache-2.0"])
        a, b = (a, b) if r.random() < 0.5 else (b, a)
        out.append((intro().replace("{}", r.choice(_CHOICE).format(a=a, b=b)), "Apache-2.0 OR MIT"))
    for _ in range(each // 3):  # other choices are none of the ten
        a, b = r.sample([n for k in ("MIT", "Apache-2.0", "BSD-3-Clause", "GPL-3.0-or-later", "MPL-2.0", "ISC", "GPL-2.0-only") for n in [r.choice(NAMES[k])]], 2)
        if {"MIT", "Apache"} != {x for x in ("MIT", "Apache") if x in a + b or x == "MIT" and "Expat" in a + b}:
            out.append((intro().replace("{}", r.choice(_CHOICE).format(a=a, b=b)), "other"))
    for _ in range(each):
        c = [r.choice(_CLOSED).replace("{}", r.choice(_OWNERS).replace("{}", r.choice(("Acme", "North", "Delta Systems", "Blue"))))]
        out.append((" ".join(c), "LicenseRef-Proprietary"))
    for k, parts in BODIES.items():
        for _ in range(each // 4):
            some = [p for p in parts if p == parts[0] or r.random() < 0.85]
            end = [r.choice(_DISCLAIMERS)] if r.random() < 0.7 else []
            out.append((" ".join(some + end), k))
            if k == "BSD-2-Clause":
                out.append((" ".join([*some, r.choice(_CLAUSE_3), *end]), "BSD-3-Clause"))
                out.append((" ".join([*some, _CLAUSE_4, r.choice(_CLAUSE_3), *end]), "other"))
            if k == "MIT":
                out.append((" ".join([_MIT_0, *end]), "other"))
    for _ in range(each):
        out.append((fill(f"{r.choice(_ACTORS)} {r.choice(_VERBS)} {r.choice(_OBJECTS)}{r.choice(('', '.', ' before each run.', ' and fails.'))}"), "none"))
        out.append((fill(r.choice(_ASIDES)), "none"))
    out += [(f"{r.choice(FILLER)} {r.choice(FILLER)} {r.choice(FILLER)} {r.choice(FILLER)}", "none") for _ in range(each // 4)]
    return out


class Model:
    """Softmax regression by full-batch gradient descent with momentum; weights are some hundred kilobytes."""

    def __init__(self, rounds: int = 150, rate: float = 0.5, decay: float = 1e-4):
        data = training_set()
        feats = [set(grams(s)) for s, _ in data]
        counts: dict[str, int] = {}
        for f in feats:
            for g in f:
                counts[g] = counts.get(g, 0) + 1
        self.vocabulary = {g: i for i, g in enumerate(sorted(g for g, c in counts.items() if c >= 4))}
        x = np.zeros((len(data), len(self.vocabulary) + 1), np.float32)
        for r, f in enumerate(feats):
            at = [self.vocabulary[g] for g in f if g in self.vocabulary]
            x[r, at] = 1 / max(1, len(at)) ** 0.5
            x[r, -1] = 1
        y = np.array([CLASSES.index(k) for _, k in data])
        t = np.eye(len(CLASSES), dtype=np.float32)[y]
        weight = (1 / np.bincount(y, minlength=len(CLASSES)).clip(1))[y].astype(np.float32)[:, None]
        weight /= weight.sum()
        w, v = np.zeros((x.shape[1], len(CLASSES)), np.float32), 0.0
        for _ in range(rounds):
            z = x @ w
            p = np.exp(z - z.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            v = 0.9 * v - rate * 30 * (x.T @ ((p - t) * weight) + decay * w)
            w = w + v
        self.w = w
        self.words = {g for g in self.vocabulary if " " not in g}

    def predict(self, sentence: str) -> tuple[str, float]:
        """(class, probability); unlike anything known: `none`."""
        g = set(grams(sentence))
        at = [self.vocabulary[x] for x in g if x in self.vocabulary]
        single = [x for x in g if " " not in x]
        if not at or sum(x in self.words for x in single) / len(single) < LEAST_KNOWN:
            return "none", 1.0
        z = self.w[at].sum(0) / len(at) ** 0.5 + self.w[-1]
        p = np.exp(z - z.max())
        p /= p.sum()
        k = int(p.argmax())
        return CLASSES[k], float(p[k])


_MODEL: Model | None = None


def model() -> Model:
    global _MODEL
    if _MODEL is None:
        _MODEL = Model()
    return _MODEL


def spdx_class(expression: str) -> str:
    """Exact reading of an SPDX expression: a known identifier, the known choice, else `other`."""
    expression = expression.strip().strip("()")
    parts = re.split(r"\s+OR\s+", expression, flags=re.I)
    known = {k.lower(): k for k in CLASSES[:-2]} | {"gpl-2.0": "GPL-2.0-only", "gpl-3.0+": "GPL-3.0-or-later"}  # the latter two: names of older lists
    if len(parts) == 2 and {p.lower() for p in parts} == {"mit", "apache-2.0"}:
        return "Apache-2.0 OR MIT"
    return known.get(expression.lower(), "other") if len(parts) == 1 else "other"


LONG = 2000  # a line beyond is read by the comments on it, not as a line of a paragraph
_END = re.compile(r"[.?!]\s+(?=[A-Z#])|[{}]|;(?!\s)")
_SPLIT = re.compile(r"(?<=[.?!])\s+(?=[A-Z#])|\s+(?=(?:SPDX|spdx)-[Ll]icense|\(c\)|Copyright\b|Author:)|(?<=authors|. group|.. team)\s+(?=[A-Z])")
_COMMENTS = re.compile(r"/\*.*?(?:\*/|$)|<!--.*?(?:-->|$)")


class _LongLine:
    """Stretches of one very long line: the sentence around a place within its comment; signs of code end one too."""

    def __init__(self, line: str):
        self.line = line
        self.comments = [m.span() for m in _COMMENTS.finditer(line)]
        self.ends = [(m.start() + 1, m.end(), m.group()[0] in ".?!") for m in _END.finditer(line)]
        self.starts = [e[1] for e in self.ends]

    def around(self, at: int) -> tuple[int, int]:
        k = bisect.bisect_right(self.comments, (at, len(self.line))) - 1
        inside = k >= 0 and self.comments[k][1] > at
        if inside:
            lo, hi = self.comments[k]
        else:
            lo = self.comments[k][1] if k >= 0 else 0
            hi = self.comments[k + 1][0] if k + 1 < len(self.comments) else len(self.line)
        i = bisect.bisect_right(self.starts, at)
        j = i - 1
        while j >= 0 and self.ends[j][1] > lo and inside and not self.ends[j][2]:
            j -= 1
        if j >= 0:
            lo = max(lo, self.ends[j][1])
        while i < len(self.ends) and self.ends[i][0] < hi and inside and not self.ends[i][2]:
            i += 1
        if i < len(self.ends):
            hi = min(hi, max(at + 1, self.ends[i][0]))
        return lo, hi


def sentences(text: str) -> Iterator[str]:
    """Sentences of comments or prose that name a licence and paragraphs that begin a licence's own text, line marks taken away;
    lines that hold it in a string are none."""
    lines, starts, seen_to = None, [0], -1
    for m in CUE.finditer(text):
        if m.start() < seen_to:
            continue
        if lines is None:
            lines = text.split("\n")
            for x in lines:
                starts.append(starts[-1] + len(x) + 1)
            kept: dict[int, _LongLine] = {}
        k = bisect.bisect_right(starts, m.start()) - 1
        at, x = m.start() - starts[k], lines[k]
        before = x[:at]
        long = len(x) > LONG
        if long:
            if k not in kept:
                kept[k] = _LongLine(x)
            a, b = kept[k].around(at)
            before = x[a:at]
            if x[max(0, a - 1) : a] in ("'", '"', "`"):
                continue
        bare = MARK.sub("", before, count=1)
        if "=" in bare or re.search(r"(?<!\w)[\"'`]\s*$|[\"'`]\w*\s*:\s*[\"'`]", before.replace('"""', "").replace("'''", "")):
            continue
        body = BODY.match(m.group())
        if long:
            seen_to = starts[k] + b
            if body:  # the licence's own text goes on to the comment's end
                inside = [e for s, e in kept[k].comments if s <= at < e]
                yield " ".join(_text(x[a : inside[0] if inside else len(x)]).split())
                seen_to = starts[k] + (inside[0] if inside else len(x))
            else:
                yield _text(x[a:b])
            continue
        # the paragraph: marked lines around that are not blank; a licence's own text has several
        a = b = k
        while a > 0 and starts[a] > seen_to and _text(lines[a - 1]) and len(lines[a - 1]) <= LONG:
            a -= 1
        marked = bool(before.strip())
        while b + 1 < len(lines) and len(lines[b + 1]) <= LONG and (_text(lines[b + 1]) or body and (not marked or lines[b + 1].strip() or b + 2 < len(lines) and re.match(r"\s*(?:#|//|\*|--|;|%)", lines[b + 2]))):
            b += 1
            if body and marked and lines[b].strip() and not re.match(r"\s*(?:#|//|/?\*|--|;|%|<!)", lines[b]) and re.match(r"\s*(?:#|//|\*|--|;|%)", lines[k]):
                b -= 1
                break
        seen_to = starts[b + 1]
        if body:
            yield " ".join(" ".join(_text(x) for x in lines[k : b + 1]).split())
            continue
        for s in _SPLIT.split(" ".join(_text(x) for x in lines[a : b + 1])):
            if CUE.search(s):
                yield s


def _text(line: str) -> str:
    """A line without its comment marks; empty for a line of nothing else."""
    s = line.strip()
    for mark in ("<!--", '"""', "'''", "///", "//!", "//", "/**", "/*!", "/*", "**", "*/", "*", "##", "#", "--", ";;", ";", "%"):
        if s.startswith(mark):
            s = s[len(mark) :].strip()
            break
    for mark in ("*/", "-->", '"""', "'''"):
        if s.endswith(mark):
            s = s[: -len(mark)].strip()
    return s


def statement(text: str | None, m: Model | None = None) -> str | None:
    """The licence the text puts itself under; None without a statement or if rejected. The first accepted statement counts."""
    if not text:
        return None
    m = m or model()
    for s in sentences(text.replace("\r", "")):
        tag = SPDX.search(s)
        kind, p = m.predict(tag.group() if tag else s)
        if tag:  # the expression itself settles what the model has found to be a statement
            kind, p = spdx_class(tag.group(1)), 1.0
        if kind not in ("none", "other") and p >= LEAST_PROBABILITY:
            return kind
    return None


def statement_column(spark: SparkSession, text: Column) -> Column:
    """`statement` of a text column; the model is trained once, on the driver, and sent as some hundred kilobytes."""
    trained = spark.sparkContext.broadcast(model())

    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        m = trained.value
        for s in parts:
            yield pd.Series([statement(t, m) for t in s], dtype=object)

    return F.pandas_udf(run, "string").asNondeterministic()(text)


def is_top_licence_file(path: Column) -> Column:
    """A licence file in a repository's top folder, by its path within the repository."""
    p = F.regexp_replace(F.regexp_replace(F.trim(path), r"\\", "/"), r"^(?:\./+|/+)+", "")
    return ~p.contains("/") & p.rlike(LICENSE_FILE)


BROADCAST_REPOSITORIES = 100_000
SALTS = 32


def _settled(df: DataFrame, repo: Column, identifier: str, text: str, path: str) -> DataFrame:
    """(id, repo, top, license, finding, r) of every row."""
    s = df.select(F.col(identifier).alias("id"), repo.alias("repo"), statement_column(df.sparkSession, F.col(text)).alias("s"), F.coalesce(is_top_licence_file(F.col(path)), F.lit(False)).alias("top"))
    s = cut(s)
    r = cut(s.where("top AND s IS NOT NULL AND repo IS NOT NULL").groupBy("repo").agg(F.collect_set("s").alias("r")))
    if r.count() <= BROADCAST_REPOSITORIES:  # at most that many rows of a name and some ten licences: below 20 MB
        j = s.join(F.broadcast(r), "repo", "left")
    else:
        r = r.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        j = s.withColumn("salt", F.pmod(F.hash("id"), F.lit(SALTS))).join(r, ["repo", "salt"], "left")
    j = j.withColumn("r", F.coalesce("r", F.array().cast("array<string>")))
    others = F.size(F.array_except("r", F.array("s"))) > 0
    own = F.col("s").isNotNull()
    return j.select(
        "id", "repo", "top", "r",
        F.when(own, F.col("s")).when(F.size("r") == 1, F.get("r", F.lit(0))).otherwise("").alias("license"),
        F.when(own & ~others, "own").when(own | (F.size("r") > 1), "conflict").when(F.size("r") == 1, "repository").otherwise("unknown").alias("finding"),
    )


def file_licences(df: DataFrame, repo: Column, identifier: str = "id", text: str = "content", path: str = "relative_path") -> DataFrame:
    """(id, license, finding) of every row: S the file's own statement, R those of its repository's top licence files.

    finding: `own` (S, nothing else in R), `conflict` (S and another in R, or no S and several in R), `repository` (no S, one in
    R), `unknown`. A file of a NULL repository has no R. NULL text has no S; a NULL path is no licence file. R is a row a
    repository: it is broadcast after a count, else joined by salted keys, so that no repository's files meet in one task.
    """
    return _settled(df, repo, identifier, text, path).select("id", "license", "finding")


def repository_licences(df: DataFrame, repo: Column, identifier: str = "id", text: str = "content", path: str = "relative_path") -> DataFrame:
    """(repo, license, finding, files, conflicts): the licence of each repository with the numbers behind it."""
    f = _settled(df, repo, identifier, text, path)
    g = f.groupBy("repo").agg(F.max("r").alias("r"), F.count("*").alias("files"), F.count_if(F.col("finding") == "conflict").alias("conflicts"))
    return g.select("repo", F.when(F.size("r") == 1, F.get("r", F.lit(0))).otherwise("").alias("license"), F.when(F.size("r") == 1, "stated").when(F.size("r") > 1, "conflict").otherwise("unknown").alias("finding"), "files", "conflicts")
