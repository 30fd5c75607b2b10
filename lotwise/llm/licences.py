"""Licence recognition by sentences and rules.

Texts are cut into words. At every place where a sentence can begin (start of a line, or after the end of a sentence)
the following words are compared with the known licence sentences; a known sentence has to end where a sentence or a
line ends. That gives each text a sequence of sentence identifiers; comment marks, case, quotes and line breaks do not
matter. The sequence is then read from left to right, and at each place the longest licence rule whose identifiers
follow in order is taken. Identifiers that no rule takes up, and sentences that speak of a licence but are not known,
are reported too.

Defined results: null and empty texts have empty results; texts of any length are read whole; repeated rows are
independent; a rule that occurs several times is named once, in order of first occurrence.
"""

from __future__ import annotations

import re
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

# Known sentences of public licences, normalised on use. "*" stands for one word or more, however many.
SENTENCES = {
    "mit-name": ("Released under the MIT License.", "Licensed under the MIT License.", "The MIT License (MIT)", "MIT License",
                 "This project is licensed under the MIT License.", "SPDX-License-Identifier: MIT"),
    "mit-grant": ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
                  "associated documentation files (the \"Software\"), to deal in the Software without restriction, "
                  "including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
                  "and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
                  "subject to the following conditions:",),
    "mit-notice": ("The above copyright notice and this permission notice shall be included in all copies or substantial "
                   "portions of the Software.",),
    "mit-warranty": ("THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT "
                     "LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.",),
    "mit-liability": ("IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, "
                      "WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE "
                      "SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",),
    "apache-name": ("Licensed under the Apache License, Version 2.0.", "Licensed under the Apache License, Version 2.0 (the "
                    "\"License\");", "SPDX-License-Identifier: Apache-2.0", "Apache License, Version 2.0"),
    "apache-comply": ("you may not use this file except in compliance with the License.",),
    "apache-copy": ("You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",),
    "apache-basis": ("Unless required by applicable law or agreed to in writing, software distributed under the License is "
                     "distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or "
                     "implied.",),
    "apache-see": ("See the License for the specific language governing permissions and limitations under the License.",),
    "gpl3-name": ("This work is licensed under the GNU General Public License, version 3.", "GNU General Public License, "
                  "version 3", "SPDX-License-Identifier: GPL-3.0-only", "Licensed under the GNU General Public License v3."),
    "gpl3-later": ("you can redistribute it and/or modify it under the terms of the GNU General Public License as published "
                   "by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
                   "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
                   "General Public License as published by the Free Software Foundation, either version 3 of the License, or "
                   "(at your option) any later version.", "SPDX-License-Identifier: GPL-3.0-or-later"),
    "gpl2-later": ("This program is free software; you can redistribute it and/or modify it under the terms of the GNU "
                   "General Public License as published by the Free Software Foundation; either version 2 of the License, or "
                   "(at your option) any later version.", "you can redistribute it and/or modify it under the terms of the GNU "
                   "General Public License as published by the Free Software Foundation; either version 2 of the License, or "
                   "(at your option) any later version.", "SPDX-License-Identifier: GPL-2.0-or-later"),
    "gpl-hope": ("This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the "
                 "implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.",),
    "gpl-see": ("See the GNU General Public License for more details.",),
    "bsd-grant": ("Redistribution and use in source and binary forms, with or without modification, are permitted provided "
                  "that the following conditions are met:",),
    "bsd-source": ("Redistributions of source code must retain the above copyright notice, this list of conditions and the "
                   "following disclaimer.",),
    "bsd-binary": ("Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the "
                   "following disclaimer in the documentation and/or other materials provided with the distribution.",),
    "bsd-names": ("Neither the name of * nor the names of its contributors may be used to endorse or promote products derived "
                  "from this software without specific prior written permission.",),
    "isc-grant": ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
                  "hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",),
    "cc-by-nc-4": ("Licensed under CC BY-NC 4.0.", "SPDX-License-Identifier: CC-BY-NC-4.0", "This work is licensed under a "
                   "Creative Commons Attribution-NonCommercial 4.0 International License."),
    "cc-by-4": ("Licensed under CC BY 4.0.", "SPDX-License-Identifier: CC-BY-4.0", "This work is licensed under a Creative "
                "Commons Attribution 4.0 International License."),
    "cc-by-sa-4": ("Licensed under CC BY-SA 4.0.", "SPDX-License-Identifier: CC-BY-SA-4.0", "This work is licensed under a "
                   "Creative Commons Attribution-ShareAlike 4.0 International License."),
    "mpl-2": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
              "SPDX-License-Identifier: MPL-2.0"),
    "rights": ("All rights reserved.",),
    "lgpl-hope": ("This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the "
                  "implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.",),
    "lgpl-see": ("See the GNU Lesser General Public License for more details.",),
    "agpl-see": ("See the GNU Affero General Public License for more details.",),
    "cc0-notice": ("To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring "
                   "rights to this software to the public domain worldwide.", "This work is licensed under a Creative Commons "
                   "Zero v1.0 Universal License.", "Licensed under CC0 1.0."),
    "cc0-warranty": ("This software is distributed without any warranty.",),
    "unlicense-notice": ("This is free and unencumbered software released into the public domain.",),
    "unlicense-anyone": ("Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in "
                         "source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any "
                         "means.",),
    "epl2-notice": ("This program and the accompanying materials are made available under the terms of the Eclipse Public License "
                    "2.0 which is available at https://www.eclipse.org/legal/epl-2.0/", "This program and the accompanying materials "
                    "are made available under the terms of the Eclipse Public License 2.0 which accompanies this distribution, and "
                    "is available at https://www.eclipse.org/legal/epl-2.0/", "Licensed under the Eclipse Public License 2.0."),
    "cc-by-3": ("Licensed under CC BY 3.0.", "This work is licensed under a Creative Commons Attribution 3.0 Unported License."),
}
# Licences of one wording, with the name and version that stand in it.
GNU = {
    "lgpl21-later": ("GNU Lesser General Public License", "2.1"), "lgpl3-later": ("GNU Lesser General Public License", "3"),
    "agpl3-later": ("GNU Affero General Public License", "3"),
}
SENTENCES |= {
    mark: tuple(
        f"{start} you can redistribute it and/or modify it under the terms of the {name} as published by the Free Software "
        f"Foundation, either version {version} of the License, or (at your option) any later version."
        for start in ("This program is free software:", "This library is free software;", "")
    ) for mark, (name, version) in GNU.items()
}

# Ordered sequences of sentence identifiers and the licence each stands for.
#: licences that an identifier alone names, besides those with an identifier among their sentences
IDENTIFIED = (
    "BSD-3-Clause", "BSD-2-Clause", "ISC", "GPL-2.0-only", "LGPL-2.1-only", "LGPL-2.1-or-later", "LGPL-3.0-only",
    "LGPL-3.0-or-later", "AGPL-3.0-only", "AGPL-3.0-or-later", "CC0-1.0", "CC-BY-3.0", "Unlicense", "EPL-2.0",
)
SENTENCES |= {f"spdx-{x.lower()}": (f"SPDX-License-Identifier: {x}",) for x in IDENTIFIED}
RULES = (
    ("MIT", ("mit-name", "mit-grant", "mit-notice", "mit-warranty", "mit-liability")),
    ("MIT", ("mit-grant", "mit-notice", "mit-warranty", "mit-liability")),
    ("MIT", ("mit-name",)),
    ("Apache-2.0", ("apache-name", "apache-comply", "apache-copy", "apache-basis", "apache-see")),
    ("Apache-2.0", ("apache-name",)),
    ("GPL-3.0-or-later", ("gpl3-later", "gpl-hope", "gpl-see")),
    ("GPL-3.0-or-later", ("gpl3-later",)),
    ("GPL-3.0-only", ("gpl3-name",)),
    ("GPL-2.0-or-later", ("gpl2-later", "gpl-hope", "gpl-see")),
    ("GPL-2.0-or-later", ("gpl2-later",)),
    ("BSD-3-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-names")),
    ("BSD-2-Clause", ("bsd-grant", "bsd-source", "bsd-binary")),
    ("ISC", ("isc-grant", "mit-warranty")),
    ("ISC", ("isc-grant",)),
    ("CC-BY-NC-4.0", ("cc-by-nc-4",)),
    ("CC-BY-4.0", ("cc-by-4",)),
    ("CC-BY-SA-4.0", ("cc-by-sa-4",)),
    ("MPL-2.0", ("mpl-2",)),
    ("LGPL-2.1-or-later", ("lgpl21-later", "lgpl-hope", "lgpl-see")),
    ("LGPL-2.1-or-later", ("lgpl21-later",)),
    ("LGPL-3.0-or-later", ("lgpl3-later", "gpl-hope", "lgpl-see")),
    ("LGPL-3.0-or-later", ("lgpl3-later", "lgpl-hope", "lgpl-see")),
    ("LGPL-3.0-or-later", ("lgpl3-later",)),
    ("AGPL-3.0-or-later", ("agpl3-later", "gpl-hope", "agpl-see")),
    ("AGPL-3.0-or-later", ("agpl3-later",)),
    ("CC0-1.0", ("cc0-notice", "cc0-warranty")),
    ("CC0-1.0", ("cc0-notice",)),
    ("Unlicense", ("unlicense-notice", "unlicense-anyone")),
    ("Unlicense", ("unlicense-notice",)),
    ("EPL-2.0", ("epl2-notice",)),
    ("CC-BY-3.0", ("cc-by-3",)),
    *((x, (f"spdx-{x.lower()}",)) for x in IDENTIFIED),
)

#: a text without any of these words holds no known sentence and none that speaks of a licence
HINTS = re.compile(r"licen[cs]|permission|copyright|warrant|redistribut|spdx|all rights|liable|neither the name|compliance|unencumbered|anyone is free", re.I)
SPEAKS = re.compile(r"licen[cs]ed?$|licen[cs]ing$|copyright$|spdx$")
_TOKEN = re.compile(r"(?P<line>\n)|(?P<word>[^\W_]+(?:[.\-/+][^\W_]+)*)|(?P<stop>[.!?;:]+)|(?P<other>[^\w\s]|_)")


@lru_cache(maxsize=1)
def _known() -> dict[str, list[tuple[tuple[str, ...], str]]]:
    """Known sentences by their first word, longest first."""
    out: dict[str, list[tuple[tuple[str, ...], str]]] = {}
    for name, variants in SENTENCES.items():
        for text in variants:
            words = tuple(w.lower() for w in re.findall(r"[^\W_]+(?:[.\-/+][^\W_]+)*|\*", text))
            out.setdefault(words[0], []).append((words, name))
    for found in out.values():
        found.sort(key=lambda x: -len(x[0]))
    return out


def _matches(words: list[str], at: int, pattern: tuple[str, ...]) -> int | None:
    """End of the pattern in ``words`` from ``at`` on, or None.

    A "*" takes as many words as it needs to the nearest place where the rest of the pattern follows; it does not reach
    over another beginning of the pattern, so a text is passed over once however often it begins.
    """
    if "*" not in pattern:
        end = at + len(pattern)
        return end if tuple(words[at:end]) == pattern else None
    start = pattern.index("*")
    head, rest = pattern[:start], pattern[start + 1 :]
    if tuple(words[at : at + start]) != head:
        return None
    at += start + 1
    while at < len(words):
        end = _matches(words, at, rest)
        if end is not None:
            return end
        if tuple(words[at : at + start]) == head:
            return None
        at += 1
    return None


def sentence_ids(text: str) -> tuple[list[str], int]:
    """Identifiers of the known sentences in order, and the number of other sentences that speak of a licence."""
    if not HINTS.search(text):
        return [], 0
    words: list[str] = []
    begins, ends = {0}, set()
    for m in _TOKEN.finditer(text):
        kind = m.lastgroup
        if kind == "word":
            words.append(m.group().lower())
        elif kind != "other":
            begins.add(len(words))
            ends.add(len(words))
    ends.add(len(words))
    known, found, covered, at = _known(), [], 0, 0
    spoken: list[int] = []
    while at < len(words):
        end = None
        if at in begins:
            for pattern, name in known.get(words[at], ()):
                end = _matches(words, at, pattern)
                if end is not None and end in ends:
                    found.append(name)
                    break
                end = None
        if end is not None:
            at = covered = end
            continue
        if SPEAKS.search(words[at]) and at >= covered:
            spoken.append(at)
        at += 1
    # several words of one sentence count once
    cuts = sorted(ends)
    sentences, i = set(), 0
    for place in spoken:
        while cuts[i] <= place:
            i += 1
        sentences.add(cuts[i])
    return found, len(sentences)


def licences_of(ids: list[str]) -> tuple[list[str], list[str]]:
    """Licences in order of first occurrence, and identifiers that no rule takes up."""
    names: dict[str, None] = {}
    rest, at = [], 0
    while at < len(ids):
        fitting = [(len(rule), -i, name) for i, (name, rule) in enumerate(RULES) if tuple(ids[at : at + len(rule)]) == rule]
        if fitting:
            length, _, name = max(fitting)
            names[name] = None
            at += length
        else:
            rest.append(ids[at])
            at += 1
    return list(names), rest


RESULT = "struct<licences:array<string>,sentences:array<string>,unmatched:array<string>,n_unknown:bigint>"


def scan(text: Column) -> Column:
    """The licences of a text column, with the evidence."""

    def batch(texts: pa.Array) -> pa.Array:
        rows = []
        for t in texts.to_pylist():
            ids, unknown = sentence_ids(t) if t else ([], 0)
            names, rest = licences_of(ids)
            rows.append({"licences": names, "sentences": ids, "unmatched": rest, "n_unknown": unknown})
        strings = pa.list_(pa.string())
        kind = pa.struct([("licences", strings), ("sentences", strings), ("unmatched", strings), ("n_unknown", pa.int64())])
        return pa.array(rows, kind)

    return F.arrow_udf(batch, RESULT).asNondeterministic()(text.cast("string"))
