"""License scans, personal data and quality rules."""

import re
from collections import Counter


from reachgrid.llm import licenses, pii, quality

from .cases import awkward, frame, plain, words

NUMBER = r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": NUMBER,
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    doubled = [int(c) * 2 for c in digits[-2::-2]]
    return (sum(map(int, digits[-1::-2])) + sum(d - 9 * (d > 9) for d in doubled)) % 10 == 0


def passes(kind, value):
    digits = re.sub("[^0-9]", "", value)
    if kind == "ip":
        return all(int(p) <= 255 for p in value.split("."))
    if kind == "card":
        return 14 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 10 <= len(digits) <= 15


def brute_spans(text):
    found = [
        (m.start(), rank, m.end(), kind)
        for rank, (kind, pattern) in enumerate(PATTERNS.items())
        for m in re.finditer(pattern, text or "")
        if passes(kind, m.group())
    ]
    return [(kind, start, end) for start, _, end, kind in sorted(found)]


HARD = [
    "a@b.c_x@y.z é😀 q.w+e%r-t_u@v-w.x.y..z", "@@a@b a@b a@.b.c a@b.c.", "1.2.3.4.5.6.7.8 1.2.3",
    "256.1.1.1 0255.000.01.1 1.1.1.1", "4111 1111-1111 1111 4111111111111112", "+1 (269) 555-3296",
    "+1 (269) 555-3296 4524132264652876 end", "++12345678901 +1-2 + 1", "4" * 500 + "." + "a" * 500,
    "a.b" * 4_000 + "@" + "c." * 4_000 + "d", "1.1.1.1" * 50, "漢1.1.1.1漢a@b.cé",
]


def test_base_spans_equal_brute_force(spark):
    rows = awkward() + plain([(100 + i, t) for i, t in enumerate(HARD)])
    found = pii.personal_data(frame(spark, rows)).collect()
    got = sorted(((r.key, [(s.kind, s.start, s.end) for s in r.base]) for r in found), key=repr)
    assert got == sorted(((r[0], brute_spans(r[1])) for r in rows), key=repr)
    assert pii.personal_data(frame(spark, [])).count() == 0


def test_contexts_lead_to_unseen_identifiers(spark):
    seen = [(i, f"text call +1 (2{i}) 555-32{i} now") for i in range(10, 40)]
    hidden = [(90, "it is +1 (269) 555-3296 4524132264652876 end"), (91, "code 555-3296 4524 of")]
    found = {r.key: r for r in pii.personal_data(frame(spark, plain(seen + hidden))).collect()}
    assert found[90].base == []
    assert [(s.kind, s.value) for s in found[90].spans] == [("phone", "+1 (269) 555-3296")]
    assert found[91].spans == [] and all(found[i].spans == found[i].base for i, _ in seen)


def test_masks(spark):
    rows = plain([(1, "x a@b.c 1.1.1.1 ü +1 (269) 555-3296"), (2, None), (None, "a@b.c"), (3, "")])
    df = frame(spark, rows)
    masked = pii.masked(df)
    assert masked.columns == df.columns
    assert {(r.doc_id, r.text) for r in masked.collect()} == {
        (1, "x [EMAIL] [IP] ü [PHONE]"), (2, None), (None, "[EMAIL]"), (3, ""),
    }


LICENSES = [
    ("Licensed under the Apache License,\n Version 2.0 (the \"License\"); you may not use this file "
     "except in compliance with the License. You may obtain a copy of the License at\n http://x",
     "apache-named apache-file apache-copy", "apache-2.0"),
    ("# SPDX-License-Identifier: GPL-2.0-or-later", "spdx:gpl-2.0-or-later", "gpl-2.0-or-later"),
    ("Licensed under CC BY-NC-SA 4.0.", "cc:by-nc-sa-4.0", "cc-by-nc-sa-4.0"),
    ("Redistribution and use in source and binary forms is permitted. Redistributions of source code "
     "must retain it. Redistributions in binary form must reproduce it.",
     "bsd-grant bsd-source bsd-binary", "bsd-2-clause"),
    ("Redistributions in binary form must reproduce it. Redistribution and use in source and binary "
     "forms is permitted.", "bsd-binary bsd-grant", ""),
    ("All rights reserved. Released under the MIT License.", "reserved mit-named", "mit proprietary"),
    ("He has a fishing license.", "", ""),
    (None, "", ""),
    ("", "", ""),
]


def test_licenses(spark):
    rows = plain([(i, t) for i, (t, _, _) in enumerate(LICENSES)])
    found = {r.doc_id: r for r in licenses.scan(frame(spark, rows)).collect()}
    for i, (_, sentences, names) in enumerate(LICENSES):
        assert (found[i].sentences, found[i].licenses) == (sentences, names), i
    assert found[6].n_unknown == 1
    assert licenses.scan(frame(spark)).count() == len(awkward())
    assert licenses.scan(frame(spark, [])).count() == 0


def brute_measures(text):
    text = text or ""
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    often = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(8)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (
        len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text),
        len(lines) - len(set(lines)), len(covered),
    )


def test_measures_equal_brute_force(spark):
    rows = awkward() + plain(
        [(100, "a b " * 40), (101, "#*$ <x>\nline one\nline one\n \n \nline one"),
         (102, words(8, 12) + " " + words(8, 12) + " " + words(8, 9))]
    )
    found = quality.verdicts(frame(spark, rows)).collect()
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    got = sorted(((r.key, *(r[n] for n in names)) for r in found), key=repr)
    assert got == sorted(((r[0], *brute_measures(r[1])) for r in rows), key=repr)
    for r in found:
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
    assert quality.verdicts(frame(spark, [])).count() == 0


def test_lines_that_many_documents_share_go(spark):
    common = "We  use COOKIES on this site"
    own = [(i, f"{words(i, 30)}\n{common}\n{words(1000 + i, 5)}") for i in range(12)]
    mostly = [(50 + i, f"{words(500 + i, 19)}\nwe use cookies on this site") for i in range(2)]
    copies = [(80 + i, f"{words(9_999, 25)}\n{words(9_998, 25)}") for i in range(12)]
    other_host = [(99, f"{words(77, 30)}\n{common}", "g", *[None] * 9)]
    df = frame(spark, plain(own + mostly + copies) + other_host)
    found = {r.key: r for r in quality.verdicts(df, documents=5, share=0.0).collect()}
    assert all(found[i].kept and found[i].removed == [1] for i in range(12))
    assert not any(found[i].kept or found[i].base_failed for i in (50, 51))
    # copies of one document are one document
    assert all(found[80 + i].kept and found[80 + i].removed is None for i in range(12))
    assert found[99].kept and found[99].removed is None
    kept = quality.passed(df, documents=5, share=0.0)
    assert kept.columns == df.columns
    texts = {r.doc_id: r.text for r in kept.collect()}
    assert texts[3] == f"{words(3, 30)}\n{words(1003, 5)}" and 50 not in texts
    assert texts[99] == other_host[0][1]
    assert quality.passed(frame(spark, [])).count() == 0


def test_repeated_rows_and_nulls_are_kept_as_they_are(spark):
    rows = plain([(1, words(1, 30)), (1, words(1, 30)), (None, words(2, 30)), (2, None)])
    kept = quality.passed(frame(spark, rows))
    assert Counter(r.doc_id for r in kept.collect()) == {1: 2, None: 1}
