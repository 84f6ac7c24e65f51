"""Licence scans by sentence rules.

A text is cut into sentences, each normalised (lower case, letters, digits
and single spaces only). A sentence ends at punctuation or a blank line; it
may be wrapped, and it may also end with its line. Known sentences have
identifiers; what is left of a text is the sequence of the identifiers it contains. Ordered rules match
identifier sequences: a rule fits where its identifiers follow one another
(anything unknown between them is skipped). The first rule that fits takes
its identifiers; the remaining ones go to later rules.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sigflow.llm.common import map_rows, text_or_empty, worker_state

# Sentences of common licences and their notices, normalised.
SENTENCES = {
    "apache2.notice": "licensed under the apache license version 2 0",
    "apache2.mayNotUse": "you may not use this file except in compliance with the license",
    "apache2.obtainCopy": "you may obtain a copy of the license at",
    "asIsBasis": "unless required by applicable law or agreed to in writing software distributed under the license is"
    " distributed on an as is basis without warranties or conditions of any kind either express or implied",
    "gpl3.notice": "this work is licensed under the gnu general public license version 3",
    "gpl.redistribute3": "you can redistribute it and or modify it under the terms of the gnu general public license"
    " as published by the free software foundation either version 3 of the license or at your option any later version",
    "noWarrantyHope": "this program is distributed in the hope that it will be useful but without any warranty",
    "mit.notice": "released under the mit license",
    "mit.permission": "permission is hereby granted free of charge to any person obtaining a copy of this software and"
    " associated documentation files the software to deal in the software without restriction",
    "mit.notice.keep": "the above copyright notice and this permission notice shall be included in all copies or"
    " substantial portions of the software",
    "bsd.redistribute": "redistribution and use in source and binary forms with or without modification are permitted"
    " provided that the following conditions are met",
    "bsd.noEndorse": "neither the name of the copyright holder nor the names of its contributors may be used to endorse"
    " or promote products derived from this software without specific prior written permission",
    "asIs": "the software is provided as is without warranty of any kind express or implied",
    "apache2.asf": "the asf licenses this file to you under the apache license version 2 0 the license",
    "apache2.title": "apache license version 2 0 january 2004",
    "gpl.redistribute": "you can redistribute it and or modify it under the terms of the gnu general public license"
    " as published by the free software foundation",
    "gpl.redistribute2later": "you can redistribute it and or modify it under the terms of the gnu general public license"
    " as published by the free software foundation either version 2 of the license or at your option any later version",
    "gpl.either2": "either version 2 of the license or at your option any later version",
    "gpl.either3": "either version 3 of the license or at your option any later version",
    "gpl.version2": "version 2 of the license",
    "gpl.redistribute2": "you can redistribute it and or modify it under the terms of the gnu general public license"
    " version 2 as published by the free software foundation",
    "ccbync4.notice": "licensed under cc by nc 4 0",
    "ccby4.notice": "licensed under cc by 4 0",
    "ccbysa4.notice": "licensed under cc by sa 4 0",
    "ccbysa3.notice": "licensed under cc by sa 3 0",
    "cc0.notice": "to the extent possible under law the author has waived all copyright and related or neighboring rights to this work",
    "cc0.title": "cc0 1 0 universal",
    "gpl3.title": "gnu general public license version 3 29 june 2007",
    "gpl2.title": "gnu general public license version 2 june 1991",
    "lgpl.redistribute": "you can redistribute it and or modify it under the terms of the gnu lesser general public license"
    " as published by the free software foundation",
    "lgpl.redistribute21later": "you can redistribute it and or modify it under the terms of the gnu lesser general public license"
    " as published by the free software foundation either version 2 1 of the license or at your option any later version",
    "lgpl.redistribute3later": "you can redistribute it and or modify it under the terms of the gnu lesser general public license"
    " as published by the free software foundation either version 3 of the license or at your option any later version",
    "lgpl.either21": "either version 2 1 of the license or at your option any later version",
    "lgpl.noWarrantyHope": "this library is distributed in the hope that it will be useful but without any warranty",
    "lgpl21.title": "gnu lesser general public license version 2 1 february 1999",
    "lgpl3.title": "gnu lesser general public license version 3 29 june 2007",
    "agpl.redistribute": "you can redistribute it and or modify it under the terms of the gnu affero general public license"
    " as published by the free software foundation",
    "agpl.redistribute3later": "you can redistribute it and or modify it under the terms of the gnu affero general public license"
    " as published by the free software foundation either version 3 of the license or at your option any later version",
    "agpl3.title": "gnu affero general public license version 3 19 november 2007",
    # The point of "v. 2.0" ends a sentence.
    "mpl2.subject": "this source code form is subject to the terms of the mozilla public license v",
    "mpl2.copy": "if a copy of the mpl was not distributed with this file you can obtain one at https mozilla org mpl 2 0",
    "mpl2.title": "mozilla public license version 2 0",
    "epl2.terms": "this program and the accompanying materials are made available under the terms of the eclipse public license 2 0"
    " which is available at https www eclipse org legal epl 2 0",
    "epl2.title": "eclipse public license v 2 0",
    "isc.permission": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"
    " provided that the above copyright notice and this permission notice appear in all copies",
    "bsd0.permission": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted",
    "unlicense.release": "this is free and unencumbered software released into the public domain",
    "unlicense.anyone": "anyone is free to copy modify publish use compile sell or distribute this software either in source code form"
    " or as a compiled binary for any purpose commercial or non commercial and by any means",
    "boost.notice": "distributed under the boost software license version 1 0",
    "boost.title": "boost software license version 1 0 august 17th 2003",
    "zlib.permission": "permission is granted to anyone to use this software for any purpose including commercial applications and to"
    " alter it and redistribute it freely subject to the following restrictions",
    "wtfpl.title": "do what the fuck you want to public license",
    "mit.project": "this project is licensed under the mit license",
    "apache2.project": "this project is licensed under the apache license 2 0",
    "gpl3.project": "this project is licensed under the gnu general public license v3 0",
    "bsd3.project": "this project is licensed under the bsd 3 clause license",
    "mpl2.project": "this project is licensed under the mozilla public license 2 0",
    # A tag line is cut at its colon: the tag, then the licence's name.
    "spdx.tag": "spdx license identifier",
    "name.apache2": "apache 2 0",
    "name.mit": "mit",
    "name.bsd2": "bsd 2 clause",
    "name.bsd3": "bsd 3 clause",
    "name.gpl2": "gpl 2 0 only",
    "name.gpl2later": "gpl 2 0 or later",
    "name.gpl3": "gpl 3 0 only",
    "name.gpl3later": "gpl 3 0 or later",
    "name.lgpl21": "lgpl 2 1 only",
    "name.lgpl21later": "lgpl 2 1 or later",
    "name.lgpl3": "lgpl 3 0 only",
    "name.lgpl3later": "lgpl 3 0 or later",
    "name.agpl3": "agpl 3 0 only",
    "name.agpl3later": "agpl 3 0 or later",
    "name.mpl2": "mpl 2 0",
    "name.epl2": "epl 2 0",
    "name.isc": "isc",
    "name.bsd0": "0bsd",
    "name.unlicense": "unlicense",
    "name.boost": "bsl 1 0",
    "name.zlib": "zlib",
    "name.cc0": "cc0 1 0",
    "name.ccby4": "cc by 4 0",
    "name.ccbysa4": "cc by sa 4 0",
}

# Other published forms of the sentences, by their text.
VARIANTS = {
    "licensed under the apache license version 2 0 the license": "apache2.notice",
    "this file is licensed under the apache license version 2 0 the license": "apache2.notice",
    "the asf licenses this file to you under the apache license version 2 0": "apache2.asf",
    SENTENCES["mit.permission"] + " including without limitation the rights to use copy modify merge publish distribute"
    " sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so"
    " subject to the following conditions": "mit.permission",
    SENTENCES["mit.notice.keep"].replace("permission notice", "permission notice including the next paragraph"): "mit.notice.keep",
    SENTENCES["asIs"] + " including but not limited to the warranties of merchantability fitness for a particular purpose"
    " and noninfringement": "asIs",
    SENTENCES["gpl.redistribute3"].replace("you can", "this program is free software you can", 1): "gpl.redistribute3",
    SENTENCES["noWarrantyHope"] + " without even the implied warranty of merchantability or fitness for a particular purpose": "noWarrantyHope",
    SENTENCES["lgpl.noWarrantyHope"] + " without even the implied warranty of merchantability or fitness for a particular purpose": "lgpl.noWarrantyHope",
    "this library is free software you can" + SENTENCES["lgpl.redistribute21later"].removeprefix("you can"): "lgpl.redistribute21later",
    "this program is free software you can" + SENTENCES["lgpl.redistribute3later"].removeprefix("you can"): "lgpl.redistribute3later",
    "this program is free software you can" + SENTENCES["agpl.redistribute3later"].removeprefix("you can"): "agpl.redistribute3later",
    "this program is free software you can" + SENTENCES["gpl.redistribute2later"].removeprefix("you can"): "gpl.redistribute2later",
    "permission to use copy modify and distribute" + SENTENCES["isc.permission"].removeprefix("permission to use copy modify and or distribute"): "isc.permission",
    "this project is licensed under the mit license see the license file for details": "mit.project",
    "licensed under the mit license": "mit.notice",
    "the mit license mit": "mit.notice",
    "licensed under the apache license 2 0": "apache2.notice",
    "this project is licensed under the apache license version 2 0": "apache2.project",
    "if a copy of the mpl was not distributed with this file you can obtain one at http mozilla org mpl 2 0": "mpl2.copy",
    "this work is licensed under a creative commons attribution 4 0 international license": "ccby4.notice",
    "this work is licensed under a creative commons attribution sharealike 4 0 international license": "ccbysa4.notice",
    "this work is licensed under a creative commons attribution sharealike 3 0 unported license": "ccbysa3.notice",
    "gpl 2 0": "name.gpl2",
    "gpl 3 0": "name.gpl3",
    "lgpl 2 1": "name.lgpl21",
    "lgpl 3 0": "name.lgpl3",
    "agpl 3 0": "name.agpl3",
}

#: Sentences that name someone: identifier, how they begin, what follows the
#: name, how they end.
PATTERNS = (
    (
        "bsd.noEndorse",
        "neither the name",
        re.compile(r". nor the names of (?:its|their|any|the|other)\b").search,
        "contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    ),
)


@dataclass(frozen=True)
class LicenseRule:
    license: str
    sentences: tuple[str, ...]


#: In order; longer sequences come before their parts.
RULES = (
    LicenseRule("Apache-2.0", ("apache2.notice", "apache2.mayNotUse", "apache2.obtainCopy", "asIsBasis")),
    LicenseRule("Apache-2.0", ("apache2.notice", "apache2.mayNotUse")),
    LicenseRule("Apache-2.0", ("apache2.notice",)),
    LicenseRule("Apache-2.0", ("apache2.asf", "apache2.mayNotUse", "apache2.obtainCopy", "asIsBasis")),
    LicenseRule("Apache-2.0", ("apache2.asf",)),
    LicenseRule("Apache-2.0", ("apache2.title",)),
    LicenseRule("GPL-2.0-or-later", ("gpl.redistribute", "gpl.either2", "noWarrantyHope")),
    LicenseRule("GPL-2.0-or-later", ("gpl.redistribute", "gpl.either2")),
    LicenseRule("GPL-2.0-or-later", ("gpl.redistribute2later",)),
    LicenseRule("GPL-3.0-or-later", ("gpl.redistribute", "gpl.either3", "noWarrantyHope")),
    LicenseRule("GPL-3.0-or-later", ("gpl.redistribute", "gpl.either3")),
    LicenseRule("GPL-2.0-only", ("gpl.redistribute", "gpl.version2")),
    LicenseRule("GPL-2.0-only", ("gpl.redistribute2",)),
    LicenseRule("GPL-3.0-or-later", ("gpl.redistribute3", "noWarrantyHope")),
    LicenseRule("GPL-3.0-or-later", ("gpl.redistribute3",)),
    LicenseRule("GPL-3.0-only", ("gpl3.notice",)),
    LicenseRule("MIT", ("mit.permission", "mit.notice.keep", "asIs")),
    LicenseRule("MIT", ("mit.permission",)),
    LicenseRule("MIT", ("mit.notice",)),
    LicenseRule("BSD-3-Clause", ("bsd.redistribute", "bsd.noEndorse")),
    LicenseRule("BSD-2-Clause", ("bsd.redistribute",)),
    LicenseRule("CC-BY-NC-4.0", ("ccbync4.notice",)),
    LicenseRule("CC-BY-4.0", ("ccby4.notice",)),
    LicenseRule("CC-BY-SA-4.0", ("ccbysa4.notice",)),
    LicenseRule("CC-BY-SA-3.0", ("ccbysa3.notice",)),
    LicenseRule("CC0-1.0", ("cc0.title",)),
    LicenseRule("CC0-1.0", ("cc0.notice",)),
    LicenseRule("GPL-3.0-only", ("gpl3.title",)),
    LicenseRule("GPL-2.0-only", ("gpl2.title",)),
    LicenseRule("LGPL-2.1-or-later", ("lgpl.redistribute", "lgpl.either21", "lgpl.noWarrantyHope")),
    LicenseRule("LGPL-2.1-or-later", ("lgpl.redistribute", "lgpl.either21")),
    LicenseRule("LGPL-2.1-or-later", ("lgpl.redistribute21later", "lgpl.noWarrantyHope")),
    LicenseRule("LGPL-2.1-or-later", ("lgpl.redistribute21later",)),
    LicenseRule("LGPL-3.0-or-later", ("lgpl.redistribute", "gpl.either3", "noWarrantyHope")),
    LicenseRule("LGPL-3.0-or-later", ("lgpl.redistribute", "gpl.either3")),
    LicenseRule("LGPL-3.0-or-later", ("lgpl.redistribute3later",)),
    LicenseRule("LGPL-2.1-only", ("lgpl21.title",)),
    LicenseRule("LGPL-3.0-only", ("lgpl3.title",)),
    LicenseRule("AGPL-3.0-or-later", ("agpl.redistribute", "gpl.either3", "noWarrantyHope")),
    LicenseRule("AGPL-3.0-or-later", ("agpl.redistribute", "gpl.either3")),
    LicenseRule("AGPL-3.0-or-later", ("agpl.redistribute3later", "noWarrantyHope")),
    LicenseRule("AGPL-3.0-or-later", ("agpl.redistribute3later",)),
    LicenseRule("AGPL-3.0-only", ("agpl3.title",)),
    LicenseRule("MPL-2.0", ("mpl2.subject", "mpl2.copy")),
    LicenseRule("MPL-2.0", ("mpl2.subject",)),
    LicenseRule("MPL-2.0", ("mpl2.title",)),
    LicenseRule("EPL-2.0", ("epl2.terms",)),
    LicenseRule("EPL-2.0", ("epl2.title",)),
    LicenseRule("ISC", ("isc.permission", "asIs")),
    LicenseRule("ISC", ("isc.permission",)),
    LicenseRule("0BSD", ("bsd0.permission",)),
    LicenseRule("Unlicense", ("unlicense.release", "unlicense.anyone")),
    LicenseRule("Unlicense", ("unlicense.release",)),
    LicenseRule("BSL-1.0", ("boost.notice",)),
    LicenseRule("BSL-1.0", ("boost.title",)),
    LicenseRule("Zlib", ("zlib.permission",)),
    LicenseRule("WTFPL", ("wtfpl.title",)),
    LicenseRule("MIT", ("mit.project",)),
    LicenseRule("Apache-2.0", ("apache2.project",)),
    LicenseRule("GPL-3.0-only", ("gpl3.project",)),
    LicenseRule("BSD-3-Clause", ("bsd3.project",)),
    LicenseRule("MPL-2.0", ("mpl2.project",)),
    LicenseRule("Apache-2.0", ("spdx.tag", "name.apache2")),
    LicenseRule("MIT", ("spdx.tag", "name.mit")),
    LicenseRule("BSD-2-Clause", ("spdx.tag", "name.bsd2")),
    LicenseRule("BSD-3-Clause", ("spdx.tag", "name.bsd3")),
    LicenseRule("GPL-2.0-only", ("spdx.tag", "name.gpl2")),
    LicenseRule("GPL-2.0-or-later", ("spdx.tag", "name.gpl2later")),
    LicenseRule("GPL-3.0-only", ("spdx.tag", "name.gpl3")),
    LicenseRule("GPL-3.0-or-later", ("spdx.tag", "name.gpl3later")),
    LicenseRule("LGPL-2.1-only", ("spdx.tag", "name.lgpl21")),
    LicenseRule("LGPL-2.1-or-later", ("spdx.tag", "name.lgpl21later")),
    LicenseRule("LGPL-3.0-only", ("spdx.tag", "name.lgpl3")),
    LicenseRule("LGPL-3.0-or-later", ("spdx.tag", "name.lgpl3later")),
    LicenseRule("AGPL-3.0-only", ("spdx.tag", "name.agpl3")),
    LicenseRule("AGPL-3.0-or-later", ("spdx.tag", "name.agpl3later")),
    LicenseRule("MPL-2.0", ("spdx.tag", "name.mpl2")),
    LicenseRule("EPL-2.0", ("spdx.tag", "name.epl2")),
    LicenseRule("ISC", ("spdx.tag", "name.isc")),
    LicenseRule("0BSD", ("spdx.tag", "name.bsd0")),
    LicenseRule("Unlicense", ("spdx.tag", "name.unlicense")),
    LicenseRule("BSL-1.0", ("spdx.tag", "name.boost")),
    LicenseRule("Zlib", ("spdx.tag", "name.zlib")),
    LicenseRule("CC0-1.0", ("spdx.tag", "name.cc0")),
    LicenseRule("CC-BY-4.0", ("spdx.tag", "name.ccby4")),
    LicenseRule("CC-BY-SA-4.0", ("spdx.tag", "name.ccbysa4")),
)

#: A sentence ends at . ; : ! ? and white space; the end of a line may end it.
_ENDS = re.compile(r"[.;:!?](?=[\x20\x09-\x0D])").split
_WORD = re.compile("[A-Za-z0-9]").search
_OTHER = re.compile(r"[^a-z0-9]+").sub


def normalized_sentence(sentence: str) -> str:
    return _OTHER(" ", sentence.lower()).strip()


def _runs(text: str) -> Iterator[list[str]]:
    """Pieces of lines that punctuation or a blank line parts from others.
    What has no letter or digit, as a comment's mark, is left out."""
    run: list[str] = []
    for line in text.split("\n"):
        pieces = [p for p in _ENDS(line + " ") if _WORD(p)]
        if not pieces:
            if run:
                yield run
                run = []
            continue
        run.append(pieces[0])
        if len(pieces) > 1:
            yield run
            yield from ([p] for p in pieces[1:-1])
            run = [pieces[-1]]
        if line.rstrip()[-1] in ".;:!?":
            yield run
            run = []
    if run:
        yield run


class LicenseMatcher:
    def __init__(self, sentences: dict[str, str], rules: tuple[LicenseRule, ...], variants: dict[str, str] = {}, patterns: tuple = ()):
        self.known = {**variants, **{text: name for name, text in sentences.items()}}
        self.patterns = patterns
        #: What a sentence that goes on in the next line has so far.
        self.prefixes = {t[:i] for t in self.known for i, c in enumerate(t) if c == " "}
        self.rules = rules
        unknown = {s for r in rules for s in r.sentences} - set(sentences)
        if unknown:
            raise ValueError(f"rules name unknown sentences: {sorted(unknown)}")
        #: First words of the known sentences: others need no normalising.
        self.begin = re.compile("|".join(sorted({re.escape(t.split()[0]) for t in self.known})), re.IGNORECASE).search

    def identifiers(self, text: str) -> list[str]:
        found: list[str] = []
        for run in _runs(text):
            named, i = self._named(run), 0
            while i < len(run):
                name, i = named.get(i) or self._sentence(run, i)
                if name:
                    found.append(name)
        return found

    def _named(self, run: list[str]) -> dict[int, tuple[str, int]]:
        """Sentences that name someone, by their first piece: identifier and
        where to go on. Such a sentence goes from the last beginning before an
        end to that end, over any number of pieces."""
        spans: dict[int, tuple[str, int]] = {}
        for name, begins, holds, ends in self.patterns:
            word = re.compile(re.escape(begins.split()[0]), re.IGNORECASE).search
            if not any(map(word, run)):
                continue
            pieces = [normalized_sentence(p) for p in run]
            n, start, last = len(begins.split()), None, ""
            for k, piece in enumerate(pieces):
                if " ".join(pieces[k : k + n]).startswith(begins):
                    start = k
                last = f"{last} {piece}"[-len(ends) - 1 :]
                if start is not None and last.endswith(" " + ends):
                    whole = " ".join(pieces[start : k + 1])
                    if holds(whole, len(begins)):
                        spans[start] = (name, k + 1)
                    start = None
        return spans

    def _sentence(self, run: list[str], i: int) -> tuple[str | None, int]:
        """The longest known sentence that begins with run[i], and where to
        go on."""
        if not self.begin(run[i]):
            return None, i + 1
        name, end, k = None, i + 1, i + 1
        sentence = normalized_sentence(run[i])
        while True:
            if sentence in self.known:
                name, end = self.known[sentence], k
            if k >= len(run) or sentence not in self.prefixes:
                return name, end
            sentence = f"{sentence} {normalized_sentence(run[k])}"
            k += 1

    def licenses(self, names: list[str]) -> list[str]:
        """Licences in order of their first identifier. Each identifier is
        used once."""
        left: list[str | None] = list(names)
        found = []
        for rule in self.rules:
            k, i = len(rule.sentences), 0
            while i + k <= len(left):
                if tuple(left[i : i + k]) == rule.sentences:
                    found.append((i, rule.license))
                    left[i : i + k] = [None] * k
                    i += k
                else:
                    i += 1
        return [license for _, license in sorted(found)]


def scan_licenses(
    docs: DataFrame,
    sentences: dict[str, str] | None = None,
    rules: tuple[LicenseRule, ...] = RULES,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per input row: id, sentence_ids and licenses (arrays, in text
    order; a licence stands once for each place found), license (the distinct
    licences sorted and joined by " AND ", or null).

    Null or empty text: empty arrays. Null ids and repeated rows come back as
    they are; an empty table gives an empty result; other columns are
    ignored.
    """
    table = dict(SENTENCES if sentences is None else sentences)
    more = (VARIANTS, PATTERNS) if sentences is None else ({}, ())

    def run(batches: Iterator[dict]) -> Iterator[dict]:
        matcher = worker_state(f"licences:{table!r}{rules!r}{bool(more[1])}", lambda: LicenseMatcher(table, rules, *more))
        for b in batches:
            names = [matcher.identifiers(t) for t in b["t"]]
            found = [matcher.licenses(n) for n in names]
            yield {"id": b["id"], "sentence_ids": names, "licenses": found, "license": [" AND ".join(sorted(set(x))) or None for x in found]}

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), text_or_empty(F.col(text_col)).alias("t"))
    schema = f"id {kind}, sentence_ids array<string>, licenses array<string>, license string"
    return map_rows(rows, run, schema).withColumnRenamed("id", id_col)
