import re
from itertools import product

import pytest

from leadframe.llm.license_rules import KEYS, SENTENCES, identify, normalise, recognise, scan, sentences

MIT = """/*
 * Copyright (c) 2020 Somebody
 *
 * Permission is hereby granted, free of charge, to any person obtaining a copy
 * of this software and associated documentation files (the "Software"), to deal
 * in the Software without restriction.
 *
 * The above copyright notice and this permission notice shall be included in
 * all copies or substantial portions of the Software.
 *
 * THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
 * IMPLIED.  IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY
 * CLAIM, DAMAGES OR OTHER LIABILITY.
 */"""
BSD = """# Redistribution and use in source and binary forms, with or without
# modification, are permitted provided that the following conditions are met:
# 1. Redistributions of source code must retain the above copyright notice.
# 2. Redistributions in binary form must reproduce the above copyright notice.
{}# THIS SOFTWARE IS PROVIDED BY THE AUTHOR "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES ARE DISCLAIMED."""


def licences(text):
    return recognise([identify(s) for _, s in sentences(text)])


@pytest.mark.parametrize("text, found", [
    (MIT, ["MIT"]),
    (BSD.format(""), ["BSD-2-Clause"]),
    (BSD.format("# 3. Neither the name of X nor its staff may be used to endorse or promote products derived from it.\n"), ["BSD-3-Clause"]),
    ("Some prose. Released under the MIT License. More prose.", ["MIT"]),
    ("Licensed under the Apache License, Version 2.0.", ["Apache-2.0"]),
    ("This work is licensed under the GNU General Public License, version 3.", ["GPL-3.0"]),
    ("under the terms of the GNU General Public License as published by the FSF, either version 2 of the License, or (at your option) any later version.", ["GPL-2.0-or-later"]),
    ("Licensed under CC BY-NC 4.0.", ["CC-BY-NC-4.0"]), ("Licensed under CC BY 4.0.", ["CC-BY-4.0"]),
    ("// SPDX-License-Identifier: MPL-2.0", ["mpl-2.0"]),
    ("a poetic licence is needed here. The end.", []), ("plain prose without any such words. One more.", []),
    ("Released under the MIT License. Licensed under the Apache License, Version 2.0.", ["MIT", "Apache-2.0"]),
])
def test_recognition(text, found):
    assert licences(text)[0] == found


def test_order_matters():
    ids = [identify(s) for _, s in sentences(BSD.format(""))]
    assert recognise(ids)[0] == ["BSD-2-Clause"]
    assert recognise(ids[::-1])[0] == []
    assert recognise(["mit-grant", None, "mit-notice"]) == ([], 3)


def test_given_documents(documents, texts):
    known = {"Licensed under the Apache License, Version 2.0.": "Apache-2.0", "Released under the MIT License.": "MIT",
             "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0", "Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0"}
    found = {r.doc_id: set(r.licences) for r in scan(documents).collect()}
    expected = {d: {name for line, name in known.items() if line in (t or "")} for d, t in texts.items()}
    assert {d: x for d, x in found.items() if x} == {d: x for d, x in expected.items() if x}


def test_odd_rows(odd, empty, spark):
    assert scan(odd).collect() == [] and scan(empty).collect() == []
    text = "x " * 200_000 + "\nReleased under the MIT License.\n" + "license " * 50_000
    rows = scan(spark.createDataFrame([(None, text, "l"), (1, MIT, "l"), (1, MIT, "l")], "doc_id bigint, text string, licences string")).collect()
    assert sorted((r.doc_id or 0, r.licences) for r in rows) == [(0, ["MIT"]), (1, ["MIT"]), (1, ["MIT"])]


def test_patterns_do_not_blow_up():
    import time

    began = time.process_time()
    for word in ("gnu general public license ", "copyright ", "the names of ", "either version 2 ", "in no event shall "):
        identify((word * 200).strip())
    assert time.process_time() - began < 5
    assert all(p for _, p in SENTENCES) and KEYS


def written_out(parsed):
    """Texts that a parsed pattern matches: every alternative, nothing optional but a free word."""
    parts = []
    for kind, what in parsed:
        kind = str(kind)
        if kind == "LITERAL":
            parts.append([chr(what)])
        elif kind == "IN":
            parts.append([chr(v) if str(k) == "LITERAL" else chr(v[0]) if str(k) == "RANGE" else "2" for k, v in what[:1]])
        elif kind == "BRANCH":
            parts.append([t for branch in what[1] for t in written_out(branch)])
        elif kind == "SUBPATTERN":
            parts.append(written_out(what[3]))
        elif kind == "MAX_REPEAT":
            free = str(what[2][0][0]) == "ANY"
            parts.append([" x "] if free else [t * what[0] for t in written_out(what[2])] if what[0] else [""])
        else:
            assert kind in ("AT", "ASSERT_NOT"), kind
    return ["".join(p) for p in product(*parts)]


@pytest.mark.parametrize("name, pattern", SENTENCES)
def test_every_alternative_passes_the_filter(name, pattern):
    for text in map(normalise, written_out(re._parser.parse(pattern))):
        assert re.fullmatch(pattern, text), text
        for spelled in (text, text.upper().replace(" ", "\n")):
            assert [n for n, _ in sentences(spelled)] == [1], spelled


@pytest.mark.parametrize("text, found", [
    ("Released under Apache-2.0.", "Apache-2.0"), ("Creative Commons Attribution 4.0 International", "CC-BY-4.0"),
    ("Creative Commons\nZero", "CC0-1.0"), ("Proprietary and confidential.", "LicenseRef-proprietary"),
    ("Unauthorized copying of this file is strictly prohibited.", "LicenseRef-proprietary"),
    ("This document may not be copied.", "LicenseRef-proprietary")])
def test_sentences_without_another_key(text, found):
    assert licences(f"Some prose. {text}")[0] == [found]
    assert list(sentences("It may not be so. The Apache helicopter. Creative people in common use.")) == []


@pytest.mark.parametrize("words", [0, 20, 2_000, 20_000])
def test_surroundings_of_any_length_change_nothing(spark, words):
    filler = " ".join(f"word{i}" for i in range(words))
    text = f"{filler} Licensed under the Apache License,\nVersion 2.0 {filler}\n{filler} or under the MIT\nlicense {filler}"
    row = scan(spark.createDataFrame([(1, text)], "doc_id bigint, text string")).collect()[0]
    assert row.licences[0] == "Apache-2.0"
    if words >= 2_000:
        assert row.licences == ["Apache-2.0", "MIT"]
