from cadence.llm import license_rules as L
from cadence.llm import queries
from tests.llm.helpers import SF, awkward, documents, empty, rows, with_clashes

SHORT = {"Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0", "All rights reserved.": "LicenseRef-all-rights-reserved",
         "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0-only",
         "Licensed under the Apache License, Version 2.0.": "Apache-2.0", "Released under the MIT License.": "MIT"}


def text_of(*names):
    return "\n".join(L.SENTENCES[n] for n in names)


def test_given_documents_against_plain_search(spark):
    got = {r.doc_id: r for r in queries.op5_license_scan(spark, SF).collect()}
    for r in spark.read.parquet(f"{SF}/documents.parquet").collect():
        want = sorted({SHORT[s] for s in SHORT if s in (r.text or "").split("\n")})
        assert got[r.doc_id].licenses == ",".join(want)


def test_sentences_over_wrapped_lines_and_colons():
    s = L.Sentences()
    for name, sentence in L.SENTENCES.items():
        assert s.identify(f"Before.\n{sentence}\n\nAfter this.".encode()) == [name]
        assert s.identify(sentence.replace(" ", "\n").lower().encode()) == [name]
    assert s.identify(b"This is released under the MIT License.") == []
    assert s.identify(b"Permission is hereby\n\ngranted, free of charge") == []


def test_ordered_rules():
    mit = ["mit-grant", "mit-notice", "mit-as-is"]
    assert L.licences(mit) == ["MIT"]
    assert L.licences(mit[::-1]) == []
    assert L.licences(["mit-grant", "rights-reserved", "mit-notice", "mit-as-is"]) == ["LicenseRef-all-rights-reserved", "MIT"]
    bsd = ["bsd-grant", "bsd-source", "bsd-binary"]
    assert L.licences(bsd) == ["BSD-2-Clause"]
    assert L.licences([*bsd, "bsd-endorse"]) == ["BSD-3-Clause"]
    assert L.licences(["rights-reserved"] * 100_000) == ["LicenseRef-all-rights-reserved"]
    assert L.licences([]) == []


def test_awkward_rows(spark):
    docs = awkward(spark)
    got = L.scan(with_clashes(docs)).collect()
    assert len(got) == docs.count() and {(r.n_sentences, r.sentences, r.licenses) for r in got} == {(0, "", "")}
    assert L.scan(empty(spark)).count() == 0
    long_text = "x " * 200_000 + ".\n" + text_of("mit-grant", "mit-notice", "mit-as-is")
    assert rows(L.scan(documents(spark, [long_text])), "licenses") == [("MIT",)]


def test_common_notices_and_headers():
    def found(text):
        return L.licences(L.Sentences().identify(text.encode()))

    cases = {
        "/* SPDX-License-Identifier: GPL-2.0-or-later */": "GPL-2.0-or-later",
        "// SPDX-License-Identifier: Apache-2.0\n// Copyright": "Apache-2.0",
        "# SPDX-License-Identifier: CC0-1.0": "CC0-1.0",
        "This project is licensed under the MIT License.": "MIT",
        "This project is licensed under the GNU General Public License v2.0.": "GPL-2.0-only",
        " * This library is free software; you can redistribute it and/or\n * modify it under the terms of the GNU "
        "Lesser General Public\n * License as published by the Free Software Foundation; either\n * version 2.1 of the "
        "License, or (at your option) any later version.": "LGPL-2.1-or-later",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, or (at "
        "your option) any later version.": "AGPL-3.0-or-later",
        "Distributed under the Boost Software License, Version 1.0.\n(See accompanying file)": "BSL-1.0",
        text_of("zlib-as-is", "zlib-grant"): "Zlib", text_of("zlib-grant"): "Zlib",
        text_of("boost-grant"): "BSL-1.0", text_of("epl2-available"): "EPL-2.0", text_of("cc0-waived"): "CC0-1.0",
    }
    for text, licence in cases.items():
        assert found(text) == [licence], text
    assert found(text_of("zlib-as-is")) == [] and found("SPDX-License-Identifier: none of these") == []


def test_every_sentence_has_one_identifier_and_a_rule():
    assert len({L.normalise(s.encode()) for s in L.SENTENCES.values()}) == len(L.SENTENCES)
    assert {n for _, names in L.RULES for n in names} >= set(L.SENTENCES) - {"gpl-hope"}
