"""Licences by their sentences (operator 10).

Normalised sentences are mapped to known sentence identifiers; sequences of
identifiers are matched against ordered licence rules, the longest first.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import column, only, shipped

#: A normalised sentence without one of these is no licence sentence.
KEYS = ("licen", "endorse", "copyright", "warrant", "permission", "permitted", "redistribut", "public domain", "liab", "spdx",
        "without modification", "all rights reserved", "apache-2.0", "creative commons", "proprietary and confidential",
        "unauthorized copying", "unauthorized use", "may not be copied", "may not be reproduced")
_V = r"(?:,? ?\(?(?:version|v\.?) ?{0}(?:\.0)?\)?)"
_GPL = r"(?:the )?(?:gnu )?{0}(?:general public licen[sc]e|gpl)"
#: (identifier, pattern of the whole normalised sentence)
SENTENCES = (
    ("spdx", r".*spdx-license-identifier:? ?(?P<name>[a-z0-9.+-]+)"),
    ("apache2-named", r".*\b(?:apache(?: software)? licen[sc]e" + _V.format(2) + r"|apache-2\.0)\b.*"),
    ("apache2-compliance", r"you may not use this file except in compliance with the licen[sc]e"),
    ("apache2-copy", r"you may obtain a copy of the licen[sc]e at.*"),
    ("apache2-as-is", r"unless required by applicable law or agreed to in writing,? software distributed under the licen[sc]e is distributed on an as is basis,? without warranties or conditions of any kind.*"),
    ("apache2-see", r"see the licen[sc]e for the specific language governing permissions and limitations under the licen[sc]e"),
    ("mit-named", r".*\bmit(?:/x11)? licen[sc]e\b.*|the mit licen[sc]e(?: \(mit\))?"),
    ("mit-grant", r"permission is hereby granted,? free of charge,? to any person obtaining a copy of this software and associated documentation files.*"),
    ("mit-notice", r"the above copyright notice and this permission notice (?:\(.*\) )?shall be included in all copies or substantial portions of the software"),
    ("mit-as-is", r"the software is provided as is,? without warranty of any kind,? express or implied.*"),
    ("mit-liability", r"in no event shall the authors or copyright holders be liable for any claim.*"),
    ("isc-grant", r"permission to use,? copy,? modify,? and(?:/or)? distribute this software for any purpose with or without fee is hereby granted,? provided that.*"),
    ("isc-as-is", r"the software is provided as is and the author disclaims all warranties with regard to this software.*"),
    ("bsd-grant", r"redistribution and use in source and binary forms,? with or without modification,? are permitted provided that the following conditions are met"),
    ("bsd-source", r"(?:\W*\d?\W*)redistributions of source code must retain the above copyright notice.*"),
    ("bsd-binary", r"(?:\W*\d?\W*)redistributions in binary form must reproduce the above copyright notice.*"),
    ("bsd-endorse", r"(?:\W*\d?\W*)(?:\d\W+)?neither the name of .* may be used to endorse or promote products.*|.*names? of .* may not be used to endorse or promote products.*without specific prior written permission.*"),
    ("bsd-as-is", r"this software is provided by .* as is and any express or implied warranties.* are disclaimed"),
    ("bsd-liability", r"in no event shall .* be liable for any direct,? indirect,? incidental.*"),
    ("bsd3-named", r".*\b(?:3-clause|new|modified|revised) bsd licen[sc]e\b.*|.*\bbsd[ -]3-clause\b.*"),
    ("bsd2-named", r".*\b(?:2-clause|simplified) bsd licen[sc]e\b.*|.*\bbsd[ -]2-clause\b.*"),
    ("lgpl-named", r".*\b(?:gnu )?(?:lesser|library) general public licen[sc]e\b.*|.*\blgpl\b.*"),
    ("agpl3-named", r".*\b(?:gnu )?affero general public licen[sc]e\b.*|.*\bagpl\b.*"),
    ("gpl3-named", r".*\b" + _GPL.format("") + _V.format(3) + r"(?! or).*|.*\bgplv3\b.*"),
    ("gpl2-later", r".*\b(?:gnu )?general public licen[sc]e\b.*\b(?:either )?version 2 .*\bor \(?at your option\)? any later version.*"),
    ("gpl3-later", r".*\b(?:gnu )?general public licen[sc]e\b.*\b(?:either )?version 3 .*\bor \(?at your option\)? any later version.*"),
    ("gpl2-named", r".*\b" + _GPL.format("") + _V.format(2) + r".*|.*\bgplv2\b.*"),
    ("gpl-any", r".*\bgnu general public licen[sc]e\b.*"),
    ("gpl-hope", r"this (?:program|library) is distributed in the hope that it will be useful.* without any warranty.*"),
    ("gpl-see", r"see the gnu (?:lesser |library )?general public licen[sc]e for more details"),
    ("gpl-received", r"you should have received a copy of the gnu .*licen[sc]e.*"),
    ("mpl2-named", r".*\bmozilla public licen[sc]e" + _V.format(2) + r".*"),
    ("epl2-named", r".*\beclipse public licen[sc]e" + _V.format(2) + r".*"),
    ("unlicense", r"this is free and unencumbered software released into the public domain"),
    ("cc0-named", r".*\bcc0(?: 1\.0)?\b.*|.*creative commons zero.*"),
    ("cc-by-nc-nd4", r".*\bcc[ -]by[ -]nc[ -]nd 4\.0\b.*"), ("cc-by-nc-sa4", r".*\bcc[ -]by[ -]nc[ -]sa 4\.0\b.*"),
    ("cc-by-nc4", r".*\bcc[ -]by[ -]nc 4\.0\b.*|.*creative commons attribution-noncommercial 4\.0\b.*"),
    ("cc-by-nd4", r".*\bcc[ -]by[ -]nd 4\.0\b.*"),
    ("cc-by-sa4", r".*\bcc[ -]by[ -]sa 4\.0\b.*|.*creative commons attribution-sharealike 4\.0\b.*"),
    ("cc-by4", r".*\bcc[ -]by 4\.0\b.*|.*creative commons attribution 4\.0\b.*"),
    ("copyright", r".*\bcopyright (?:\(c\)|©|\d{4}).*|all rights reserved"),
    ("proprietary", r".*\b(?:proprietary and confidential|unauthorized (?:copying|use)|may not be (?:copied|reproduced|redistributed))\b.*"),
)
#: (licence, identifiers in order); of the rules that fit at a place the longest wins, then the first.
RULES = (
    ("Apache-2.0", ("apache2-named", "apache2-compliance", "apache2-copy", "apache2-as-is", "apache2-see")),
    ("Apache-2.0", ("apache2-compliance", "apache2-copy", "apache2-as-is", "apache2-see")),
    ("Apache-2.0", ("apache2-named",)),
    ("MIT", ("mit-named", "mit-grant", "mit-notice", "mit-as-is", "mit-liability")),
    ("MIT", ("mit-grant", "mit-notice", "mit-as-is", "mit-liability")), ("MIT", ("mit-named",)),
    ("ISC", ("isc-grant", "isc-as-is", "bsd-liability")), ("ISC", ("isc-grant", "isc-as-is")),
    ("BSD-3-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse", "bsd-as-is", "bsd-liability")),
    ("BSD-3-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse")),
    ("BSD-2-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-as-is", "bsd-liability")),
    ("BSD-2-Clause", ("bsd-grant", "bsd-source", "bsd-binary")),
    ("BSD-3-Clause", ("bsd3-named",)), ("BSD-2-Clause", ("bsd2-named",)),
    ("GPL-2.0-or-later", ("gpl2-later", "gpl-hope", "gpl-see", "gpl-received")), ("GPL-2.0-or-later", ("gpl2-later",)),
    ("GPL-3.0-or-later", ("gpl3-later", "gpl-hope", "gpl-see", "gpl-received")), ("GPL-3.0-or-later", ("gpl3-later",)),
    ("GPL-3.0", ("gpl3-named",)), ("GPL-2.0", ("gpl2-named",)), ("GPL", ("gpl-any",)),
    ("LGPL", ("lgpl-named", "gpl-hope", "gpl-see", "gpl-received")), ("LGPL", ("lgpl-named",)),
    ("AGPL-3.0", ("agpl3-named", "gpl-hope", "gpl-see", "gpl-received")), ("AGPL-3.0", ("agpl3-named",)),
    ("MPL-2.0", ("mpl2-named",)), ("EPL-2.0", ("epl2-named",)), ("Unlicense", ("unlicense",)), ("CC0-1.0", ("cc0-named",)),
    ("CC-BY-NC-ND-4.0", ("cc-by-nc-nd4",)), ("CC-BY-NC-SA-4.0", ("cc-by-nc-sa4",)), ("CC-BY-NC-4.0", ("cc-by-nc4",)),
    ("CC-BY-ND-4.0", ("cc-by-nd4",)), ("CC-BY-SA-4.0", ("cc-by-sa4",)), ("CC-BY-4.0", ("cc-by4",)),
    ("LicenseRef-proprietary", ("proprietary",)),
)
#: Order of sentences for patterns that both fit: the more exact one first.
_FIRST = {"gpl2-later": 0, "gpl3-later": 0}
_PATTERNS = [(name, re.compile(p, re.S)) for name, p in sorted(SENTENCES, key=lambda s: _FIRST.get(s[0], 1))]
_COMMENT = re.compile(r"^[ \t]*(?:/\*+|\*+/|//+|#+|\*+|;+|--+|<!--|dnl\b|rem\b)?[ \t]*", re.M | re.I)
_END = re.compile(r"(?i)(?<=[.!?;])\s+|(?<!identifier):\s+(?=\S)|\n\s*\n|(?<=[.!?:;])\n")
_QUOTES = str.maketrans("“”„«»`", '"' * 6)
#: Characters around a key word that may belong to its licence sentence: more than the longest one has.
REACH = 600
_KEY = re.compile("|".join(map(re.escape, (*KEYS, "cc0", "gpl", "clause", "cc by", "cc-by"))))


def normalise(sentence: str) -> str:
    plain = sentence.lower().translate(_QUOTES).replace('"', "").replace("'as is'", "as is")
    return " ".join(plain.split()).strip(" .,;:!*-")


def _around_keys(plain: str) -> Iterator[str]:
    """The parts of a long stretch around its key words, each key word with all that may belong to it."""
    first = last = None
    for found in _KEY.finditer(plain):
        if first is not None and found.start() > first + REACH:
            yield plain[max(0, first - REACH):last + REACH]
            first = None
        first = found.start() if first is None else first
        last = found.end()
    if first is not None:
        yield plain[max(0, first - REACH):last + REACH]


def sentences(text: str) -> Iterator[tuple[int, str]]:
    """(number, normalised sentence) of the sentences that may belong to a licence.

    Of a stretch without a sentence end that is longer than any licence
    sentence, the parts around key words count; so what stands further away
    changes nothing.
    """
    for number, raw in enumerate(_END.split(_COMMENT.sub("", text)), 1):
        plain = normalise(raw)  # as identify() sees it: a key may run over lines
        for part in _around_keys(plain) if len(plain) > 2 * REACH else (plain,):
            if any(k in part for k in KEYS) or "cc" in part and "4.0" in part or "cc0" in part or "gpl" in part or "clause" in part:
                yield number, part


def identify(sentence: str) -> str | None:
    """Identifier of a normalised sentence; an SPDX tag carries its name along."""
    for name, pattern in _PATTERNS:
        found = pattern.fullmatch(sentence)
        if found:
            return f"spdx:{found['name']}" if name == "spdx" else name
    return None


def recognise(ids: list[str | None]) -> tuple[list[str], int]:
    """(licences in order of appearance, licence-like sentences that no rule explains)."""
    licences, unknown, at = [], 0, 0
    while at < len(ids):
        here = ids[at]
        if here is None:
            unknown += 1
            at += 1
        elif here.startswith("spdx:"):
            licences.append(here[5:])
            at += 1
        else:
            fits = [(name, rule) for name, rule in RULES if tuple(ids[at:at + len(rule)]) == rule]
            if fits:
                name, rule = max(fits, key=lambda f: len(f[1]))
                licences.append(name)
                at += len(rule)
            else:
                unknown += here != "copyright"
                at += 1
    return list(dict.fromkeys(licences)), unknown


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, licences, sentence_ids, sentence_numbers, unknown: documents with licence sentences.

    Comment signs at line starts, quotes, case and white space don't matter;
    sentences may run over lines.  ``sentence_ids`` are the identifiers in order
    (null: licence-like, but not known), ``unknown`` counts what no rule explains.
    A document without a licence-like sentence has no row; so has null or empty
    text.  Repeated rows are judged alike, an empty table gives an empty result,
    a null ``doc_id`` stays null.  Other columns are ignored.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], [], [], [], []]
            for doc_id, text in zip(column(batch, "doc_id"), column(batch, "text")):
                found = list(sentences(text)) if text else []
                if found:
                    ids = [identify(s) for _, s in found]
                    licences, unknown = recognise(ids)
                    for values, value in zip(out, (doc_id, licences, ids, [n for n, _ in found], unknown)):
                        values.append(value)
            kinds = (pa.int64(), pa.list_(pa.string()), pa.list_(pa.string()), pa.list_(pa.int32()), pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(out, kinds)],
                                             names=["doc_id", "licences", "sentence_ids", "sentence_numbers", "unknown"])

    return only(docs, "doc_id", "text").mapInArrow(
        run, "doc_id bigint, licences array<string>, sentence_ids array<string>, sentence_numbers array<int>, unknown int")


shipped(__name__)
