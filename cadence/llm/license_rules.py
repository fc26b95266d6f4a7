"""Licence recognition by sentence rules (operator 5).

A text is cut into sentences, which are normalised (A-Z lower-cased, every run
of other characters than a-z and 0-9 one blank) and looked up among known
licence sentences.  A document becomes the sequence of the known sentences'
identifiers, and ordered rules name the licences: a rule is a sequence of
identifiers, and matches if they occur in that order, whatever stands between
them.  Rules are tried in their order (the more demanding ones first), and a
rule that matches uses up its sentences.

Sentences end at ``.``, ``!``, ``?``, ``;`` or ``:`` before white space or the
end, and at line ends.  A known sentence may run over several such units of
one paragraph (a wrapped line, a colon inside), so units are joined as long as
they begin a known sentence; the longest known one counts.

Null and empty texts hold no sentence.  Every row gives one row; equal texts
get equal results.  Texts are scanned whole, in a map without a shuffle.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame

from cadence.llm.text import as_bytes, bound_batches, only

# Sentences of public licence texts and notices, by identifier.
SENTENCES = {
    "mit-released": "Released under the MIT License.",
    "mit-licensed": "Licensed under the MIT License.",
    "mit-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
                 "and associated documentation files (the \"Software\"), to deal in the Software without "
                 "restriction, including without limitation the rights to use, copy, modify, merge, publish, "
                 "distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the "
                 "Software is furnished to do so, subject to the following conditions:",
    "mit-notice": "The above copyright notice and this permission notice shall be included in all copies or "
                  "substantial portions of the Software.",
    "mit-as-is": "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING "
                 "BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND "
                 "NONINFRINGEMENT.",
    "apache-licensed": "Licensed under the Apache License, Version 2.0.",
    "apache-header": "Licensed under the Apache License, Version 2.0 (the \"License\");",
    "apache-comply": "you may not use this file except in compliance with the License.",
    "apache-copy": "You may obtain a copy of the License at",
    "gpl3-licensed": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-free": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
                "General Public License as published by the Free Software Foundation, either version 3 of the "
                "License, or (at your option) any later version.",
    "gpl-hope": "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY;",
    "bsd-grant": "Redistribution and use in source and binary forms, with or without modification, are permitted "
                 "provided that the following conditions are met:",
    "bsd-source": "Redistributions of source code must retain the above copyright notice, this list of conditions "
                  "and the following disclaimer.",
    "bsd-binary": "Redistributions in binary form must reproduce the above copyright notice, this list of "
                  "conditions and the following disclaimer in the documentation and/or other materials provided "
                  "with the distribution.",
    "bsd-endorse": "Neither the name of the copyright holder nor the names of its contributors may be used to "
                   "endorse or promote products derived from this software without specific prior written "
                   "permission.",
    "mpl2": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "unlicense": "This is free and unencumbered software released into the public domain.",
    "isc-grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without "
                 "fee is hereby granted, provided that the above copyright notice and this permission notice "
                 "appear in all copies.",
    "boost-grant": "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of "
                   "the software and accompanying documentation covered by this license (the \"Software\") to use, "
                   "reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative "
                   "works of the Software, and to permit third-parties to whom the Software is furnished to do so, "
                   "all subject to the following:",
    "boost-licensed": "Distributed under the Boost Software License, Version 1.0.",
    "zlib-as-is": "This software is provided 'as-is', without any express or implied warranty.",
    "zlib-grant": "Permission is granted to anyone to use this software for any purpose, including commercial "
                  "applications, and to alter it and redistribute it freely, subject to the following restrictions:",
    "epl2-available": "This program and the accompanying materials are made available under the terms of the Eclipse "
                      "Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/",
    "cc0-waived": "To the extent possible under law, the person who associated CC0 with this work has waived all "
                  "copyright and related or neighboring rights to this work.",
    "rights-reserved": "All rights reserved.",
}
# Licences that are named in a notice, and identifiers of the SPDX list.
NAMED = {
    "MIT License": "MIT", "Apache License 2.0": "Apache-2.0", "BSD 2-Clause License": "BSD-2-Clause",
    "BSD 3-Clause License": "BSD-3-Clause", "ISC License": "ISC", "Mozilla Public License 2.0": "MPL-2.0",
    "Eclipse Public License 2.0": "EPL-2.0", "Boost Software License 1.0": "BSL-1.0", "zlib License": "Zlib",
    "GNU General Public License v2.0": "GPL-2.0-only", "GNU General Public License v3.0": "GPL-3.0-only",
    "GNU Lesser General Public License v2.1": "LGPL-2.1-only", "GNU Lesser General Public License v3.0": "LGPL-3.0-only",
    "GNU Affero General Public License v3.0": "AGPL-3.0-only",
}
SPDX = (*sorted(set(NAMED.values())), "0BSD", "Artistic-2.0", "CC0-1.0", "CC-BY-4.0", "CC-BY-SA-4.0", "Unlicense",
        "GPL-2.0-or-later", "GPL-3.0-or-later", "LGPL-2.1-or-later", "LGPL-3.0-or-later", "AGPL-3.0-or-later")
NOTICES = ("This project is licensed under the {}.", "This software is licensed under the {}.",
           "Licensed under the {}.", "Released under the {}.")
# The GNU licences' notices differ in the licence's name, its version and the word for the work.
GNU = {"GPL": ("GNU General Public License", ("2", "3")), "LGPL": ("GNU Lesser General Public License", ("2.1", "3")),
       "AGPL": ("GNU Affero General Public License", ("3",))}
GNU_WORKS = ("program", "library", "file")


def _made_notices() -> tuple[dict[str, str], dict[str, str]]:
    """(identifier -> sentence, identifier -> licence) of the notices that follow a form."""
    sentences, licence = {}, {}
    for spdx in SPDX:
        sentences[f"spdx-{spdx}"], licence[f"spdx-{spdx}"] = f"SPDX-License-Identifier: {spdx}", spdx
    for name, spdx in NAMED.items():
        for number, notice in enumerate(NOTICES):
            sentences[f"notice-{number}-{name}"], licence[f"notice-{number}-{name}"] = notice.format(name), spdx
    for short, (name, versions) in GNU.items():
        for v in versions:
            spdx = f"{short}-{v if '.' in v else v + '.0'}"
            for work in GNU_WORKS:
                key = f"{short.lower()}-{v}-{work}-later"
                sentences[key], licence[key] = (
                    f"This {work} is free software; you can redistribute it and/or modify it under the terms of the "
                    f"{name} as published by the Free Software Foundation; either version {v} of the License, or (at "
                    "your option) any later version."), f"{spdx}-or-later"
            key = f"{short.lower()}-{v}-licensed"
            sentences[key], licence[key] = f"This work is licensed under the {name}, version {v}.", f"{spdx}-only"
    return sentences, licence


OTHER = re.compile(rb"[^a-z0-9]+")


def normalise(sentence: bytes) -> bytes:
    return OTHER.sub(b" ", sentence.lower()).strip()


_KNOWN = {normalise(s.encode()) for s in SENTENCES.values()}
_MADE, _MADE_LICENCE = _made_notices()
# What is listed above keeps its identifier.
_MADE = {k: s for k, s in _MADE.items() if normalise(s.encode()) not in _KNOWN}
SENTENCES |= _MADE
# Creative Commons notices are made from the licence codes.
CC_CODES = ("BY", "BY-SA", "BY-NC", "BY-ND", "BY-NC-SA", "BY-NC-ND")
CC_VERSIONS = ("3.0", "4.0")
SENTENCES |= {f"cc-{c.lower()}-{v}": f"Licensed under CC {c} {v}." for c in CC_CODES for v in CC_VERSIONS}

# Ordered rules: the licence, and the sentences that must follow each other.
RULES = (
    ("MIT", ("mit-grant", "mit-notice", "mit-as-is")),
    ("BSD-3-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse")),
    ("BSD-2-Clause", ("bsd-grant", "bsd-source", "bsd-binary")),
    ("Apache-2.0", ("apache-header", "apache-comply", "apache-copy")),
    ("Apache-2.0", ("apache-header", "apache-comply")),
    ("GPL-3.0-or-later", ("gpl-free", "gpl-hope")),
    ("GPL-3.0-or-later", ("gpl-free",)),
    ("GPL-3.0-only", ("gpl3-licensed",)),
    ("Apache-2.0", ("apache-licensed",)),
    ("MIT", ("mit-released",)),
    ("MIT", ("mit-licensed",)),
    ("MPL-2.0", ("mpl2",)),
    ("Unlicense", ("unlicense",)),
    ("ISC", ("isc-grant",)),
    ("BSL-1.0", ("boost-grant",)),
    ("BSL-1.0", ("boost-licensed",)),
    ("Zlib", ("zlib-as-is", "zlib-grant")),
    ("Zlib", ("zlib-grant",)),
    ("EPL-2.0", ("epl2-available",)),
    ("CC0-1.0", ("cc0-waived",)),
    *((_MADE_LICENCE[k], (k,)) for k in _MADE),
    *((f"CC-{c}-{v}", (f"cc-{c.lower()}-{v}",)) for c in CC_CODES for v in CC_VERSIONS),
    ("LicenseRef-all-rights-reserved", ("rights-reserved",)),
)

UNIT = re.compile(rb"[^\n]+?(?:[.!?;:]+(?=[ \t\r\n]|$)|(?=\n)|$)", re.MULTILINE)
class Sentences:
    """The known sentences, and the beginnings of them, by their normalised words."""

    def __init__(self, sentences: dict[str, str] = SENTENCES):
        self.known = {normalise(s.encode()): name for name, s in sentences.items()}
        self.begins = set()
        for s in self.known:
            words = s.split(b" ")
            self.begins.update(b" ".join(words[:i]) for i in range(1, len(words)))
        self.first = {s.split(b" ")[0] for s in self.known}

    def identify(self, text: bytes) -> list[str]:
        """Identifiers of the known sentences of a text, in order."""
        units, paragraph, last_end = [], 0, 0
        for m in UNIT.finditer(text):
            # A blank line between two units begins a new paragraph.
            if text[last_end:m.start()].count(b"\n") > 1:
                paragraph += 1
            last_end = m.end()
            words = normalise(m.group())
            if words:
                units.append((paragraph, words))
        found, i = [], 0
        while i < len(units):
            paragraph, words = units[i]
            name, after = self.known.get(words), i + 1
            j = i + 1
            while words in self.begins and j < len(units) and units[j][0] == paragraph:
                words += b" " + units[j][1]
                j += 1
                if words in self.known:
                    name, after = self.known[words], j
            if name:
                found.append(name)
            i = after if name else i + 1
        return found


def licences(names: list[str], rules=RULES) -> list[str]:
    """The licences that the ordered rules find in a sequence of identifiers, sorted."""
    left, found = list(names), set()
    for licence, wanted in rules:
        following = iter(left)
        if left and all(name in following for name in wanted):
            found.add(licence)
            left = [x for x in left if x not in wanted]
    return sorted(found)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_sentences, sentences, licenses): identifiers in order, licences sorted."""
    bound_batches(docs.sparkSession)

    def run(batches):
        sentences = Sentences()
        for batch in batches:
            found = [sentences.identify(t) for t in as_bytes(batch.column(1))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(f) for f in found], pa.int32()),
                 pa.array([",".join(f) for f in found], pa.string()),
                 pa.array([",".join(licences(f)) for f in found], pa.string())],
                [id_col, "n_sentences", "sentences", "licenses"])

    rows = only(docs, id_col, text_col)
    id_type = rows.schema[id_col].dataType.simpleString()
    return rows.mapInArrow(run, f"`{id_col}` {id_type}, n_sentences int, sentences string, licenses string")
