"""Licence scans by sentence rules (operator 8).

A text is read as words with sentence and line boundaries. From every boundary the known licence
sentences are tried on the normalised words (case, punctuation, comment marks and line breaks
don't matter; a sentence must end at a boundary), which turns the text into a sequence of sentence
identifiers. Licence rules are ordered sequences of identifiers, tried in order from each
position of that sequence, so long notices come before their short forms.
"""

from __future__ import annotations

import re
from bisect import bisect_left

from pyspark.sql import DataFrame, SparkSession

from streammetrics.llm.common import per_text, table

# Sentences of well-known licence notices and texts, by identifier. "*" at the end
# stands for the rest of the sentence or line.
SENTENCES: dict[str, tuple[str, ...]] = {
    "copyright": ("Copyright (c) *", "Copyright *", "(c) Copyright *"),
    "rights": ("All rights reserved",),
    "mit-title": ("MIT License", "The MIT License", "The MIT License (MIT)"),
    "mit-ref": ("Released under the MIT License", "Licensed under the MIT License", "This project is licensed under the MIT License",
                "This software is released under the MIT License", "Distributed under the MIT License",
                "Use of this source code is governed by an MIT-style license that can be found in the LICENSE file"),
    "mit-grant": ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions",),
    "mit-notice": ("The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software",),
    "mit-as-is": ("THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT",),
    "mit-liability": ("IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE",),
    "isc-grant": ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies",
                  "Permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies"),
    "isc-ref": ("Licensed under the ISC License", "Released under the ISC License"),
    "bsd-grant": ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",),
    "bsd-source": ("Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer",
                   "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer"),
    "bsd-binary": ("Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution",
                   "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution"),
    "bsd-endorse": ("Neither the name of *", "3. Neither the name of *"),
    "bsd2-ref": ("Licensed under the BSD 2-Clause License", "Licensed under the Simplified BSD License", "Released under the BSD 2-Clause License"),
    "bsd3-ref": ("Licensed under the BSD 3-Clause License", "Licensed under the New BSD License", "Released under the BSD 3-Clause License",
                 "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file"),
    "apache2-ref": ("Licensed under the Apache License, Version 2.0", "Released under the Apache License, Version 2.0",
                    "Licensed under the Apache License, Version 2.0 (the \"License\")", "Licensed under the Apache License 2.0",
                    "This work is licensed under the Apache License, Version 2.0"),
    "apache-compliance": ("you may not use this file except in compliance with the License",),
    "apache-copy": ("You may obtain a copy of the License at *",),
    "apache-as-is": ("Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied",),
    "apache-see": ("See the License for the specific language governing permissions and limitations under the License",),
    # the version follows a comma or semicolon; only without either does the notice take the rest of its sentence
    "gpl-free": ("This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
                 "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation *"),
    "gpl-v2": ("either version 2 of the License, or (at your option) any later version", "version 2 of the License"),
    "gpl-v3": ("either version 3 of the License, or (at your option) any later version", "version 3 of the License"),
    "gpl2-ref": ("This work is licensed under the GNU General Public License, version 2", "Licensed under the GNU General Public License, version 2",
                 "Licensed under the GPLv2", "Released under the GNU General Public License, version 2"),
    "gpl3-ref": ("This work is licensed under the GNU General Public License, version 3", "Licensed under the GNU General Public License, version 3",
                 "Licensed under the GPLv3", "Released under the GNU General Public License, version 3"),
    "lgpl-ref": ("Licensed under the GNU Lesser General Public License, version 3", "Licensed under the GNU Lesser General Public License, version 2.1",
                 "This work is licensed under the GNU Lesser General Public License, version 3"),
    "agpl3-ref": ("Licensed under the GNU Affero General Public License, version 3", "This work is licensed under the GNU Affero General Public License, version 3"),
    "mpl2-ref": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0", "Licensed under the Mozilla Public License, Version 2.0",
                 "Licensed under the Mozilla Public License 2.0"),
    "unlicense": ("This is free and unencumbered software released into the public domain",),
    "public-domain": ("This work is in the public domain", "Released into the public domain"),
    "proprietary": ("Unauthorized copying of this file, via any medium is strictly prohibited", "Proprietary and confidential"),
}
# Creative Commons licences, each with its usual notices.
for _part in ("BY", "BY-SA", "BY-NC", "BY-ND", "BY-NC-SA", "BY-NC-ND"):
    for _version in ("3.0", "4.0"):
        SENTENCES[f"cc-{_part.lower()}-{_version}"] = tuple(
            f"{_lead} CC {_part} {_version}" for _lead in ("Licensed under", "Released under", "This work is licensed under",
                                                           "This work is licensed under a"))
SENTENCES["cc0"] = ("Released under CC0", "Licensed under CC0 1.0", "Released under CC0 1.0")
# Identifiers that an SPDX line may name.
SPDX = ("MIT", "ISC", "BSD-2-Clause", "BSD-3-Clause", "Apache-2.0", "GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0-only",
        "GPL-3.0-or-later", "LGPL-2.1-only", "LGPL-3.0-only", "AGPL-3.0-only", "MPL-2.0", "CC0-1.0", "CC-BY-4.0",
        "CC-BY-SA-4.0", "Unlicense", "0BSD", "Zlib", "BSL-1.0")
for _name in SPDX:
    SENTENCES[f"spdx-{_name}"] = (f"SPDX-License-Identifier: {_name}",)

# Ordered rules: the first that fits at a position wins. At most MAX_GAP unknown sentences may
# stand between two of a rule's sentences.
RULES: tuple[tuple[str, tuple[str, ...]], ...] = (
    ("MIT", ("mit-grant", "mit-notice", "mit-as-is", "mit-liability")),
    ("MIT", ("mit-grant", "mit-notice")),
    ("MIT", ("mit-ref",)),
    ("MIT", ("mit-title",)),
    ("ISC", ("isc-grant",)),
    ("ISC", ("isc-ref",)),
    ("BSD-3-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse")),
    ("BSD-2-Clause", ("bsd-grant", "bsd-source", "bsd-binary")),
    ("BSD-1-Clause", ("bsd-grant", "bsd-source")),
    ("BSD-3-Clause", ("bsd3-ref",)),
    ("BSD-2-Clause", ("bsd2-ref",)),
    ("Apache-2.0", ("apache2-ref", "apache-compliance", "apache-copy", "apache-as-is", "apache-see")),
    ("Apache-2.0", ("apache2-ref",)),
    ("GPL-2.0", ("gpl-free", "gpl-v2")),
    ("GPL-3.0", ("gpl-free", "gpl-v3")),
    ("GPL-2.0", ("gpl2-ref",)),
    ("GPL-3.0", ("gpl3-ref",)),
    ("GPL", ("gpl-free",)),
    ("LGPL", ("lgpl-ref",)),
    ("AGPL-3.0", ("agpl3-ref",)),
    ("MPL-2.0", ("mpl2-ref",)),
    ("Unlicense", ("unlicense",)),
    ("CC0-1.0", ("cc0",)),
    ("public-domain", ("public-domain",)),
    ("proprietary", ("copyright", "rights", "proprietary")),
    ("proprietary", ("proprietary",)),
    *((f"CC-{s[3:].upper()}", (s,)) for s in SENTENCES if s.startswith("cc-")),
    *((s[5:], (s,)) for s in SENTENCES if s.startswith("spdx-")),
)
MAX_GAP = 2
# A word of every known sentence holds one of these; single words, since line breaks and comment marks part phrases.
KEYWORDS = ("licen", "copyright", "permission", "redistribut", "warrant", "domain", "rights", "software",
            "proprietary", "released", "neither", "event", "copying")

_ITEM = re.compile(r"[a-z0-9]+(?:\.[0-9]+)*|\n|[.!?;:,](?=\s|$)")


def _words(sentence: str) -> list[str]:
    return [w for w in _ITEM.findall(sentence.lower()) if w[0].isalnum()]


def _known() -> dict[str, list[tuple[list[str], bool, str]]]:
    """first word → (words, open at the end, identifier), longest first."""
    out: dict[str, list] = {}
    for ident, forms in SENTENCES.items():
        for form in forms:
            words = _words(form.rstrip("*"))
            out.setdefault(words[0], []).append((words, form.endswith("*"), ident))
    for forms in out.values():
        forms.sort(key=lambda f: (-len(f[0]), f[1], f[2]))
    return out


KNOWN = _known()


def sentences(text: str) -> list[tuple[str, int, int, int]]:
    """(identifier, start, end, sentence number) of the known licence sentences, in order."""
    low = text.lower()
    if not any(k in low for k in KEYWORDS):
        return []
    words: list[str] = []
    spans: list[tuple[int, int]] = []
    hard: list[int] = [0]      # word numbers that a sentence or line starts with
    soft: set[int] = {0}       # and those after a comma, where a known sentence may end or start as well
    for m in _ITEM.finditer(low):
        if m.group()[0].isalnum():
            words.append(m.group())
            spans.append(m.span())
        else:
            soft.add(len(words))
            if m.group() != "," and hard[-1] != len(words):
                hard.append(len(words))
    soft.add(len(words))
    number = {w: k for k, w in enumerate(hard)}
    out, busy_to = [], 0
    for at in sorted(soft):
        if at < busy_to or at >= len(words):
            continue
        for form, open_end, ident in KNOWN.get(words[at], ()):
            end = at + len(form)
            if words[at:end] != form:
                continue
            if open_end:  # up to the next sentence or line
                at_or_after = _after(hard, end)
                end = hard[at_or_after] if at_or_after < len(hard) else len(words)
            elif end not in soft:
                continue
            place = number.get(at, _after(hard, at) - 1)
            out.append((ident, spans[at][0], spans[end - 1][1], place))
            busy_to = end
            break
    return out


def _after(values: list[int], x: int) -> int:
    return bisect_left(values, x)


def licences(found: list[tuple[str, int, int, int]]) -> list[tuple[str, int, int]]:
    """(licence, start, end) by the ordered rules over a sequence of sentence identifiers."""
    out, at = [], 0
    while at < len(found):
        for name, rule in RULES:
            part = found[at:at + len(rule)]
            if len(part) < len(rule) or any(f[0] != want for f, want in zip(part, rule)):
                continue
            if all(b[3] - a[3] - 1 <= MAX_GAP + _lines(a) for a, b in zip(part, part[1:])):
                out.append((name, part[0][1], part[-1][2]))
                at += len(rule)
                break
        else:
            at += 1  # a sentence that no rule starts with here
    return out


def _lines(sentence: tuple[str, int, int, int]) -> int:
    """A sentence wrapped over lines counts as several; one line holds about 40 characters or more."""
    return (sentence[2] - sentence[1]) // 40


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, licences (distinct, in order), spans and sentences of every whole text.

    ``spans`` is licence:start:end and ``sentences`` identifier:start:end, comma-joined, ends
    exclusive, in code points of the text. Null and empty texts have none; repeated
    rows give the same row each; other columns are not read.
    """
    def one(text: str):
        if len(text.lower()) != len(text):  # a lower-case form of another length would shift offsets
            text = "".join(c if len(c.lower()) == 1 else "?" for c in text)
        found = sentences(text)
        lic = licences(found)
        return (",".join(dict.fromkeys(n for n, _, _ in lic)), len(lic),
                ",".join(f"{n}:{a}:{b}" for n, a, b in lic), ",".join(f"{n}:{a}:{b}" for n, a, b, _ in found))

    return per_text(docs, one, "licenses string, n_licenses int, spans string, sentences string", id_col, text_col)


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))


QUERIES = {"op8_license_scan": op8_license_scan}
