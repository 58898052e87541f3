"""Token counts per section: one encoding per document, spans joined by offsets."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import tee

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reachgrid.llm.shared import library_units, texts_of, worker_value

#: To which section a token goes that several touch: that of its first character,
#: or that of its last.
RULES = ("first", "last")

FIELDS = ("start", "end", "n_tokens", "n_crossing", "doc_tokens")
COUNTS = f"array<struct<{','.join(f'{name}:long' for name in FIELDS)}>>"


def token_bytes(path: str) -> np.ndarray:
    """The number of bytes that each id of a byte-level vocabulary stands for."""

    def build() -> np.ndarray:
        from tokenizers import Tokenizer

        vocabulary = Tokenizer.from_file(path).get_vocab(with_added_tokens=False)
        sizes = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for token, i in vocabulary.items():
            sizes[i] = len(token)  # a letter for each byte
        return sizes

    return worker_value(("token bytes", path), build)


def token_spans(text: str, ids: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last characters of a document's tokens. Tokens cover its bytes without
    gaps; one that begins or ends within a character holds that character."""
    ends = np.cumsum(sizes[ids])
    starts = ends - sizes[ids]
    data = text.encode()
    if len(data) == len(text):
        return starts, ends - 1
    begins = (np.frombuffer(data, np.uint8) & 0xC0) != 0x80
    character = np.cumsum(begins) - 1
    return character[starts], character[ends - 1]


def line_bounds(text: str) -> tuple[np.ndarray, np.ndarray]:
    """First characters and ends of the lines, the line end being part of its line."""
    ends = np.cumsum(np.array([len(line) + 1 for line in text.split("\n")], np.int64))
    starts = np.concatenate(([0], ends[:-1]))
    ends[-1] -= 1
    return starts, ends


def counted(text: Column, sections: Column | None, path: str, rule: str = "first") -> Column:
    """Per section ``start, end, n_tokens``, by the rule, ``n_crossing``, those of them
    that reach beyond the section, and ``doc_tokens``, those of all its sections.

    ``sections`` are ``start, end`` in code points, end exclusive, in order and without
    overlap, tokens between them going to none; without them the lines are taken.
    """
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")

    def rows(texts: pa.Array, bounds: Iterator[tuple[np.ndarray, np.ndarray]]) -> pa.Array:
        units, sizes = library_units(path, keep_space=True), token_bytes(path)
        columns, lengths = [], [0]
        strings, same = tee(texts_of(texts))  # not all of a batch at once
        for string, values, (starts, ends) in zip(strings, units.encode(same), bounds):
            n = len(starts)
            lengths.append(lengths[-1] + n)
            if not n:
                continue
            first, last = token_spans(string, np.frombuffer(b"".join(values), "<u4"), sizes)
            at = first if rule == "first" else last
            owner = np.searchsorted(starts, at, "right") - 1
            inside = (owner >= 0) & (at < ends[owner])
            owner, first, last = owner[inside], first[inside], last[inside]
            over = (first < starts[owner]) | (last >= ends[owner])
            columns.append((
                starts, ends, np.bincount(owner, minlength=n),
                np.bincount(owner[over], minlength=n), np.full(n, len(owner)),
            ))
        none = [np.empty(0, np.int64)]
        arrays = [
            pa.array(np.concatenate([c[i] for c in columns] or none).astype(np.int64))
            for i in range(len(FIELDS))
        ]
        found = pa.StructArray.from_arrays(arrays, list(FIELDS))
        return pa.ListArray.from_arrays(pa.array(lengths, pa.int32()), found)

    if sections is None:

        @F.arrow_udf(COUNTS)
        def of_lines(texts: pa.Array) -> pa.Array:
            return rows(texts, map(line_bounds, texts_of(texts)))

        return of_lines(text)

    def given(sections: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for held in sections:
            spans = held.values if held.is_valid else None
            if spans is None or not len(spans):
                yield np.empty(0, np.int64), np.empty(0, np.int64)
            else:
                yield tuple(
                    spans.field(c).to_numpy().astype(np.int64) for c in ("start", "end")
                )

    @F.arrow_udf(COUNTS)
    def of_sections(texts: pa.Array, sections: pa.Array) -> pa.Array:
        return rows(texts, given(sections))

    return of_sections(text, sections)


def section_counts(
    docs: DataFrame,
    path: str,
    key: str = "doc_id",
    text: str = "text",
    sections: Column | None = None,
    rule: str = "first",
) -> DataFrame:
    """A row per section: ``key, section`` (its number), ``start, end, n_tokens,
    n_crossing, doc_tokens`` (those of all sections of the document).

    Whole documents are encoded once, special tokens being ordinary text; sections
    are the lines unless others are given. A null text is empty, an empty one has
    one line without tokens; empty sections have no tokens; null keys and repeated
    rows stay as they are; an empty table gives no rows; other columns are not read
    unless ``sections`` uses them.
    """
    counts = counted(F.col("__text"), sections, path, rule)
    whole = F.coalesce(F.col(text), F.lit(""))
    # the counts are used once: a second use would encode the texts again
    rows = docs.withColumn("__text", whole).select(
        F.col(key), F.posexplode(counts).alias("section", "s")
    )
    return rows.select(key, F.col("section").cast("long").alias("section"), "s.*")
