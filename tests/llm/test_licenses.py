"""License texts with several licenses, and as they are wrapped in files."""

from reachgrid.llm import licenses

from .cases import frame, plain

SEVERAL = [
    ("SPDX-License-Identifier: MIT\n\nSPDX-License-Identifier: GPL-2.0-only", "mit gpl-2.0-only"),
    ("Texts are under CC BY 4.0. Images are under CC BY-NC 4.0.", "cc-by-4.0 cc-by-nc-4.0"),
    ("GNU General Public License version 2. GNU General Public License version 3.",
     "gpl-2.0 gpl-3.0"),
    ("GNU Lesser General Public License version 2.1 or GNU Lesser General Public License version 3",
     "lgpl-2.1 lgpl-3"),
    ("It is dual licensed under the MIT license and the Apache License, Version 2.0",
     "mit apache-2.0"),
    ("under the GNU General Public License as published by the Free Software Foundation, either "
     "version 3 of the License, or (at your option) any later version.", "gpl-3.0-or-later"),
]


def scanned(spark, cases):
    rows = plain([(i, text) for i, (text, *_) in enumerate(cases)])
    return {r.doc_id: r for r in licenses.scan(frame(spark, rows)).collect()}


def test_every_license_of_a_document_is_found(spark):
    found = scanned(spark, SEVERAL)
    for i, (text, names) in enumerate(SEVERAL):
        assert found[i].licenses == names, text


WRAPPED = [
    ("All rights\nreserved.", "reserved", "proprietary"),
    ("all  rights  reserved", "reserved", "proprietary"),
    ("Released under CC0 1.0", "cc0", "cc0-1.0"),
    ("Images: CC-BY-SA 4.0", "cc:by-sa-4.0", "cc-by-sa-4.0"),
    ("the GNU\nGeneral Public License version 2", "gpl:2", "gpl-2.0"),
    ("under the terms of the GNU Lesser General Public\nLicense as published by the Free "
     "Software Foundation; either\nversion 2.1 of the License, or (at your option) any later "
     "version.", "lgpl-named later:2.1", "lgpl-2.1-or-later"),
    ("the GNU Affero General Public License as published by it, either version 3 of the\n"
     "License, or (at your option) any later version.", "agpl-named later:3", "agpl-3.0-or-later"),
    ("MIT License\nCopyright (c) 2020 A\nAll rights reserved", "copyright reserved", "proprietary"),
]


def test_wrapped_texts_are_found(spark):
    found = scanned(spark, WRAPPED)
    for i, (text, sentences, names) in enumerate(WRAPPED):
        assert (found[i].sentences, found[i].licenses) == (sentences, names), text


def test_every_pattern_has_a_cue(spark):
    wordings = [
        ("spdx license identifier mit",), ("CC-BY 4.0",), ("Creative Commons Attribution 4.0",),
        ("cc0",), ("GNU General Public License",), ("version 2 or later",), ("Apache License Version 2.0",),
        ("not use this file except in compliance with the license",),
        ("distributed on an as is basis without warranties",), ("mozilla public license v2.0",),
        ("Neither the name of A may be used to endorse",), ("copyright notice and this permission "
         "notice shall be included",), ("redistributions in binary form must reproduce",),
        ("free and unencumbered software released into the public domain",), ("All-rights reserved",),
    ]
    found = scanned(spark, wordings)
    # hyphens join words in the patterns, but not in the cues
    assert all(found[i].sentences for i in range(len(wordings) - 1))
    assert found[len(wordings) - 1].n_unknown == 1
