"""License scans: known sentences give identifiers, ordered rules give licenses."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A text without any of these, in lower case and with single spaces for all that is no
#: letter, digit, dot or plus, holds no known wording.
CUES = (
    "licen", "copyright", "permission", "rights reserved", "redistribut", "warrant",
    "public domain", "creative commons", "unencumbered", "cc by", "cc0", "endorse",
    "later",
)
LOOSE = r"[^a-z0-9.+]+"

#: What versions may be followed by: a license "or later" has no fixed one.
LATER = r"(?: of the license)? or(?: at your option)? (?:any )?later"
FIXED = rf"(?![0-9.]*[0-9]|{LATER})"

#: Known wordings, as patterns over normalised sentences, with their identifiers; a
#: sentence has those of all that follow one another in it, of several from the same
#: place the first. Groups go into the identifier.
SENTENCES = (
    (r"spdx license identifier ([a-z0-9.+-]+)", r"spdx:$1"),
    (r"cc[ -](by(?:-nc)?(?:-sa|-nd)?)[ -]([0-9.]*[0-9])", r"cc:$1-$2"),
    (r"creative commons attribution ([0-9.]*[0-9])", r"cc:by-$1"),
    (r"creative commons zero|cc0", r"cc0"),
    (rf"gnu affero general public license(?: as published.*?)? version ([0-9]){FIXED}", r"agpl:$1"),
    (rf"gnu lesser general public license(?: as published.*?)? version ([0-9.]*[0-9]){FIXED}", r"lgpl:$1"),
    (rf"gnu general public license(?: as published.*?)? version ([0-9]){FIXED}", r"gpl:$1"),
    (rf"version ([0-9.]*[0-9]){LATER}(?: version)?", r"later:$1"),
    (r"gnu affero general public license", r"agpl-named"),
    (r"gnu (?:lesser|library) general public license", r"lgpl-named"),
    (r"gnu general public license", r"gpl-named"),
    (r"^either version ([0-9.]*[0-9]) of the license", r"later:$1"),
    (r"apache license version 2.0", r"apache-named"),
    (r"not use this (?:file|work) except in compliance with the license", r"apache-file"),
    (r"obtain a copy of the license at", r"apache-copy"),
    (r"distributed on an as is basis without warranties", r"apache-basis"),
    (r"mozilla public license v(?:ersion)? ?2.0", r"mpl-named"),
    (r"(?:released|licensed|distributed|available) under (?:the terms of )?the mit license", r"mit-named"),
    (r"permission is hereby granted free of charge to any person obtaining a copy", r"mit-grant"),
    (r"copyright notice and this permission notice shall be included", r"mit-notice"),
    (r"the software is provided as is without warranty of any kind", r"mit-warranty"),
    (r"permission to use copy modify and(?: or)? distribute this software", r"isc-grant"),
    (r"redistribution and use in source and binary forms", r"bsd-grant"),
    (r"redistributions of source code must retain", r"bsd-source"),
    (r"redistributions in binary form must reproduce", r"bsd-binary"),
    (r"neither the name of .*? may be used to endorse", r"bsd-names"),
    (r"free and unencumbered software released into the public domain", r"unlicense"),
    (r"all rights reserved", r"reserved"),
    (r"^(?:c )?copyright ", r"copyright"),
)

#: Rules over the identifiers of a document in their order, each for all it matches
#: after the ones before it; what a rule matches is spent. Groups go into the license.
RULES = (
    (r"<spdx:([a-z0-9.+-]+)>", r"$1"),
    (r"<bsd-grant><bsd-source><bsd-binary><bsd-names>", r"bsd-3-clause"),
    (r"<bsd-grant><bsd-source><bsd-binary>", r"bsd-2-clause"),
    (r"<mit-grant><mit-notice>(?:<mit-warranty>)?", r"mit"),
    (r"<mit-named>", r"mit"),
    (r"<isc-grant>", r"isc"),
    (r"<apache-named>(?:<apache-file>)?(?:<apache-copy>)?(?:<apache-basis>)?", r"apache-2.0"),
    (r"<gpl-named><later:([0-9])(?:[.]0)?>", r"gpl-$1.0-or-later"),
    (r"<agpl-named><later:([0-9])(?:[.]0)?>", r"agpl-$1.0-or-later"),
    (r"<lgpl-named><later:([0-9])>", r"lgpl-$1.0-or-later"),
    (r"<lgpl-named><later:([0-9][.][0-9]+)>", r"lgpl-$1-or-later"),
    (r"<gpl:([0-9])>", r"gpl-$1.0"),
    (r"<agpl:([0-9])>", r"agpl-$1.0"),
    (r"<lgpl:([0-9.]*[0-9])>", r"lgpl-$1"),
    (r"<mpl-named>", r"mpl-2.0"),
    (r"<cc:(by[a-z0-9.-]+)>", r"cc-$1"),
    (r"<cc0>", r"cc0-1.0"),
    (r"<unlicense>", r"unlicense"),
    (r"<gpl-named>", r"gpl"),
    (r"<agpl-named>", r"agpl"),
    (r"<lgpl-named>", r"lgpl"),
    (r"<reserved>", r"proprietary"),
)

#: Ends of sentences: punctuation before white space, empty lines, copyright lines.
ENDS = (
    (r"([.!?;])[ \t\r\n]+", "$1\u0001"),
    (r"\n[ \t\r]*\n", "\u0001"),
    (r"\n[ \t]*((?:\([Cc]\) )?Copyright )", "\u0001$1"),
)

#: Steps to a normalised sentence: letters, digits, inner dots and hyphens remain.
NORMAL = (
    (r"[^a-z0-9.+-]+", " "),
    (r"[.]+( |$)", "$1"),
    (r"spdx-license-identifier", "spdx license identifier"),
    (r"^[ .+-]+| +$", ""),
)


def _replaced(text: Column, steps: tuple) -> Column:
    return reduce(lambda t, step: F.regexp_replace(t, step[0], step[1]), steps, text)


def _identifiers(sentence: Column) -> Column:
    """Of all known wordings in their order; an empty array if there is none."""
    whole = "|".join(re.sub(r"\((?![?])", "(?:", pattern) for pattern, _ in SENTENCES)

    def named(wording: Column) -> Column:
        found = F.lit(None).cast("string")
        for pattern, name in reversed(SENTENCES):
            full = f"^(?:{pattern})$"
            exact = F.regexp_replace(wording, full, name)
            found = F.when(wording.rlike(full), exact).otherwise(found)
        return found

    return F.transform(F.regexp_extract_all(sentence, F.lit(whole), F.lit(0)), named)


def _spelled(pattern: str, name: str):
    return lambda hit: F.regexp_replace(hit, pattern, name)


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, sentences, licenses, n_unknown``: the identifiers of the known wordings
    in order, the licenses that the rules find (each once, in the order of the
    rules), both joined by single spaces, and the number of sentences with a cue that
    are not known.

    Null and empty texts have empty lists; repeated rows and null keys stay as they
    are, one row each; other columns are not read. No shuffle, no Python.
    """
    whole = F.coalesce(F.col(text), F.lit(""))

    def cued(value: Column) -> Column:
        loose = F.array(F.regexp_replace(F.lower(value), LOOSE, " "))
        return F.exists(
            loose, lambda v: reduce(lambda a, b: a | b, (F.contains(v, F.lit(c)) for c in CUES))
        )

    def named(sentence: Column) -> Column:
        return F.transform(
            F.array(_replaced(sentence, NORMAL)), _identifiers
        )[0]

    def cut(value: Column) -> Column:
        sentences = F.split(_replaced(value, ENDS), "\u0001")
        lowered = F.transform(sentences, lambda s: F.lower(s))
        return F.transform(F.filter(lowered, cued), named)

    none = F.expr("cast(array() AS array<array<string>>)")
    ids = F.when(cued(whole), cut(whole)).otherwise(none)
    rows = docs.select(F.col(key), ids.alias("__ids"))

    def licensed(ids: Column) -> Column:
        rest = F.array_join(F.transform(ids, lambda x: F.concat(F.lit("<"), x, F.lit(">"))), "")
        out = []
        for pattern, name in RULES:
            hits = F.regexp_extract_all(rest, F.lit(pattern), F.lit(0))
            out.append(F.transform(hits, _spelled(pattern, name)))
            rest = F.regexp_replace(rest, pattern, "|")  # what is left stays apart
        return F.concat(*out)

    rows = rows.withColumn("__known", F.flatten("__ids"))
    licenses = F.when(F.size("__known") > 0, F.array_distinct(licensed(F.col("__known"))))
    return rows.select(
        F.col(key),
        F.array_join("__known", " ").alias("sentences"),
        F.coalesce(F.array_join(licenses, " "), F.lit("")).alias("licenses"),
        F.size(F.filter("__ids", lambda x: F.size(x) == 0)).cast("long").alias("n_unknown"),
    )
