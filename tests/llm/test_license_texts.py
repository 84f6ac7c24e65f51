"""Published licence notices as they stand in files."""

import textwrap

import pytest

from sigflow.llm import license_rules as L

APACHE = """Copyright 2020 Some One

Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License.
"""
MIT = """MIT License

Copyright (c) 2020 Some One

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY.
"""
BSD2 = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
"""
BSD3 = BSD2 + """
3. Neither the name of %s nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.
"""
GPL = """This program is free software%s you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation%s either version %d of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU General Public License for more details.
"""
TEXTS = [
    (APACHE, "Apache-2.0"),
    (MIT, "MIT"),
    (BSD2, "BSD-2-Clause"),
    (BSD3 % "the copyright holder", "BSD-3-Clause"),
    (BSD3 % "the University of Somewhere, Inc", "BSD-3-Clause"),
    (GPL % (":", ",", 3), "GPL-3.0-or-later"),
    (GPL % (";", ";", 3), "GPL-3.0-or-later"),
    (GPL % (";", ";", 2), "GPL-2.0-or-later"),
]


@pytest.mark.parametrize("mark", ["", "# ", " * ", "// ", ";; ", "\r"])
def test_published_notices(spark, mark):
    put = (lambda t: t.replace("\n", "\r\n")) if mark == "\r" else (lambda t: "".join(mark + x + "\n" for x in t.split("\n")))
    frame = spark.createDataFrame([(i, put(t)) for i, (t, _) in enumerate(TEXTS)], "doc_id long, text string")
    got = {r.doc_id: r.licenses for r in L.scan_licenses(frame).collect()}
    assert got == {i: [x] for i, (_, x) in enumerate(TEXTS)}


def test_a_line_still_ends_a_sentence():
    m = L.LicenseMatcher(L.SENTENCES, L.RULES, L.VARIANTS, L.PATTERNS)
    assert m.identifiers("Some title\nReleased under the MIT License\nreleased under the MIT license\nmore") == ["mit.notice", "mit.notice"]
    assert m.identifiers("Permission is hereby granted\n\nfree of charge") == []


def wrapped(text, width):
    """Paragraphs wrapped anew."""
    return "\n\n".join(textwrap.fill(p, width, break_long_words=False, break_on_hyphens=False) for p in text.split("\n\n"))


@pytest.mark.parametrize("width", [6, 10, 14, 33, 400])
def test_any_wrap_width(width):
    m = L.LicenseMatcher(L.SENTENCES, L.RULES, L.VARIANTS, L.PATTERNS)
    for text, name in TEXTS:
        assert m.licenses(m.identifiers(wrapped(text, width))) == [name]
    holder = "the " + "very " * 2_000 + "long institute"
    assert m.licenses(m.identifiers(wrapped(BSD3 % holder, width))) == ["BSD-3-Clause"]


MORE = [
    ("This project is licensed under the MIT License.", "MIT"),
    ("// SPDX-License-Identifier: MPL-2.0", "MPL-2.0"),
    ("# SPDX-License-Identifier: GPL-2.0-or-later\ncode", "GPL-2.0-or-later"),
    ("This Source Code Form is subject to the terms of the Mozilla Public\nLicense, v. 2.0. If a copy of the MPL was not distributed with this\n"
     "file, You can obtain one at https://mozilla.org/MPL/2.0/.", "MPL-2.0"),
    ("This library is free software; you can redistribute it and/or\nmodify it under the terms of the GNU Lesser General Public\nLicense as published by"
     " the Free Software Foundation; either\nversion 2.1 of the License, or (at your option) any later version.\n", "LGPL-2.1-or-later"),
    ("This program is free software: you can redistribute it and/or modify\nit under the terms of the GNU Affero General Public License as published by\n"
     "the Free Software Foundation, either version 3 of the License, or\n(at your option) any later version.\n", "AGPL-3.0-or-later"),
    ("Permission to use, copy, modify, and/or distribute this software for any\npurpose with or without fee is hereby granted, provided that the above\n"
     "copyright notice and this permission notice appear in all copies.\n", "ISC"),
    ("This is free and unencumbered software released into the public domain.\n", "Unlicense"),
    ("This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.", "CC-BY-SA-4.0"),
    ("We like the MIT. Isc and zlib are words.\nmit\n", None),
]


def test_more_families_and_edge_rows(spark):
    rows = [(i, t) for i, (t, _) in enumerate(MORE)] + [(None, MORE[0][0]), (99, None), (99, None), (100, "neither the name " * 50_000)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS license", "'x' AS t")
    got = sorted(((r.doc_id, r.license) for r in L.scan_licenses(frame).collect()), key=str)
    assert got == sorted([*((i, x) for i, (_, x) in enumerate(MORE)), (None, "MIT"), (99, None), (99, None), (100, None)], key=str)
    assert L.scan_licenses(frame.limit(0)).count() == 0


def test_a_name_goes_to_the_nearest_beginning():
    m = L.LicenseMatcher(L.SENTENCES, L.RULES, L.VARIANTS, L.PATTERNS)
    tail = "contributors may be used to endorse or promote products derived from this software without specific prior written permission"
    assert m.identifiers("neither the name\n" * 20_000 + "of X nor the names of its\n" + tail) == ["bsd.noEndorse"]
    assert m.identifiers("neither the name of X\n" + tail) == []
    assert m.identifiers("nor the names of its\n" + tail) == []
