import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from reachgrid.llm import bpe, packing, shared, token_counts, token_files

from .cases import awkward, frame, plain, words

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
BYTES = public_tokenizers.path("byte_bpe_50k.json")
WORDS = public_tokenizers.path("word_bpe_49k.json")


def library(path):
    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    return tokenizer


def packed_ids(path, text, end):
    ids = library(path).encode(text or "", add_special_tokens=False).ids
    return np.array([*ids, end], "<u4").tobytes()


def test_backtracking_equals_the_library():
    ranks = bpe.read_ranks(RANKS)
    exact = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )
    units = bpe.rank_units(RANKS, public_tokenizers.PATTERN)
    rng = random.Random(2)
    parts = ["a", " ", "  ", "\n", "\t", "\x1c", "\x85", " ", "é", "ß", "漢", "😀", "'s", "12",
             "½", "_", "!!!", "́", "the", "ing", "aaaa", "\x00", "\r\n", "<|endoftext|>"]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 14))) for _ in range(3_000)]
    texts += [words(i, 50) for i in range(50)] + ["a" * 5_000, " " * 100]
    found = [np.frombuffer(b"".join(v), "<i4").tolist() for v in units.encode(texts)]
    assert found == [exact.encode_ordinary(t) for t in texts]


@pytest.mark.parametrize("path, keep_space", [(BYTES, True), (WORDS, False)])
def test_words_and_punctuation_equal_the_library(path, keep_space, monkeypatch):
    monkeypatch.setattr(shared, "WORD_CHARS", 300)
    monkeypatch.setattr(shared, "RECENT_WORDS", 40)
    monkeypatch.setattr(shared, "worker_value", lambda key, build: build())
    exact, units = library(path), shared.library_units(path, keep_space)
    rng = random.Random(4)
    parts = ["a", "The", " ", " ", " ", "  ", "\n", "\t", "\x1c", "\x85", "\u2003", "é", "É", "ß", "漢",
             "Σ", "İ", "😀", "'s", "'", "12", "½", "_", "!!!", "$$$", ".\n", ". ", "\u0301", "ing", "aaaa",
             "\x00", "\r\n", "<|endoftext|>", "|", "ñ", "a" * 70]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 14))) for _ in range(4_000)]
    texts += [words(i, 50) + ".\n" + words(i, 9).title() + "%%%" for i in range(50)]
    found = [np.frombuffer(b"".join(v), "<u4").tolist() for v in units.encode(texts)]
    assert found == [exact.encode(t, add_special_tokens=False).ids for t in texts]
    assert len(units.words) <= 40 and len(units.words.older) <= 40


def test_a_word_is_encoded_once_whatever_is_around_it():
    given = []

    def piece(text):
        given.append(text)
        return text.encode()

    def whole(text):
        raise AssertionError(text)

    units = shared.WordEncoder(piece, whole, True)
    texts = ["x word word. word$$$ word,\nword. word", "y word;\nword&&&"]
    assert [b"".join(v).decode() for v in units.encode(texts)] == texts
    assert given.count(" word") == 1 and given.count("word") == 1


def test_bpe_round_trip(spark):
    rows = bpe.round_trip(frame(spark), RANKS, public_tokenizers.PATTERN).collect()
    texts = sorted((t or "").encode() for _, t, *_ in awkward())
    assert sorted(bytes(r.decoded) for r in rows) == texts
    assert bpe.round_trip(frame(spark, []), RANKS, public_tokenizers.PATTERN).count() == 0


def test_token_files(spark, tmp_path):
    files, dictionary = token_files.write_ids(frame(spark), BYTES, str(tmp_path), 2)
    rows = token_files.read_ids(files, dictionary).orderBy("start").collect()
    expected = sorted(
        ((i, packed_ids(BYTES, t, 2)) for i, t, *_ in awkward()),
        key=lambda x: (x[0] is not None, x[0] or 0, x[1]),
    )
    got = [(r.doc_id, bytes(r.ids)) for r in rows]
    assert sorted(got, key=lambda x: (x[0] is not None, x[0] or 0, x[1])) == expected
    assert [r.doc_id for r in rows] == [i for i, _ in expected]
    assert [r.start for r in rows] == np.cumsum([0, *[r.n_tokens for r in rows]])[:-1].tolist()
    reader = token_files.Reader(files.orderBy("start").first().file, dictionary)
    assert reader.ids(0) == got[0][1]
    with pytest.raises(ValueError, match="another"):
        token_files.Reader(files.first().file, b"other")
    assert token_files.round_trip(frame(spark, []), BYTES).count() == 0


def test_dictionary_of_different_texts_of_all_lengths(spark, monkeypatch):
    copies = [(i, words(0, 200)) for i in range(400)]
    others = [(500 + i, words(i, 40 if i % 2 else 2_000)) for i in range(100)]
    found = token_files.train(frame(spark, plain(copies + others)), BYTES, "text", 2)
    alone = token_files.train(frame(spark, plain(copies[:1] + others)), BYTES, "text", 2)
    assert found == alone and len(found) == token_files.DICTIONARY_BYTES
    assert token_files.train(frame(spark, plain(copies)), BYTES, "text", 2) == b""
    assert token_files.train(frame(spark, []), BYTES, "text", 2) == b""
    # a part of many texts is the same part, however they are dealt out
    monkeypatch.setattr(token_files, "SAMPLE", 16)
    many = frame(spark, plain(others))
    one, two = (token_files.train(many.repartition(n), BYTES, "text", 2) for n in (1, 7))
    assert one == two and 0 < len(one) <= token_files.DICTIONARY_BYTES


def check_pieces(rows, documents, window):
    by_document, sequences = {}, {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
        assert len(r.ids) == 4 * r.length
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at and length > 0
            at += length
        assert at == window or at & (at - 1) == 0
    for r in sorted(rows, key=lambda r: r.start):
        by_document.setdefault((r.doc_id, r.doc_tokens), []).append(bytes(r.ids))
    return sum(r.length for r in rows) == sum(len(d) // 4 for d in documents)


@pytest.mark.parametrize("window", [32, 2048])
def test_packing(spark, window):
    rows = awkward() + plain([(1000 + i, words(i, i % 37 + 1)) for i in range(300)])
    pieces = packing.pack(frame(spark, rows).repartition(3), WORDS, 1, window=window).collect()
    documents = {i: packed_ids(WORDS, t, 1) for i, t, *_ in rows}
    assert check_pieces(pieces, [packed_ids(WORDS, t, 1) for _, t, *_ in rows], window)
    for key in range(1000, 1300):
        own = sorted((p for p in pieces if p.doc_id == key), key=lambda p: p.start)
        assert b"".join(bytes(p.ids) for p in own) == documents[key]
        assert {p.doc_tokens for p in own} == {len(documents[key]) // 4}


def test_packing_of_nothing(spark):
    assert packing.pack(frame(spark, []), WORDS).count() == 0


@pytest.mark.parametrize("n,window,step", [(2_000, 64, 4), (200, 2048, 64), (10_000, 2048, 64)])
def test_plan_uses_each_length_at_most_as_often_as_it_occurs(n, window, step):
    rng = np.random.default_rng(n)
    lengths = np.minimum(rng.lognormal(6, 1, n).astype(int) % window, window - 1)
    histogram = np.bincount(lengths, minlength=window)
    chosen, left = packing.plan(histogram, window, step)
    used = np.zeros(window, int)
    for lengths, times in chosen:
        assert sum(lengths) == window and times > 0
        for length in lengths:
            used[length] += times
    used[0] = histogram[0]
    assert (used + left == histogram).all() and (left >= 0).all()
    # little is left to be cut, the less the more there are to choose from
    weight = np.arange(window)
    assert (left * weight).sum() < (0.2 if n < 1_000 else 0.1) * (histogram * weight).sum()


def test_residuals_are_packed_in_longer_combinations():
    left = np.zeros(101, int)
    left[[44, 31, 18, 7]] = 2
    assert packing.packed_residuals(left, 100) == [([44, 31, 18, 7], 2)]
    assert not left.any()
    left[[90, 30]] = 2, 1  # nothing fills the window
    assert packing.packed_residuals(left, 100) == [] and left.sum() == 3


def test_section_counts(spark):
    rows = awkward()  # with null keys and repeated rows
    found = token_counts.section_counts(frame(spark, rows), BYTES).collect()
    got = Counter(
        (r.doc_id, r.section, r.start, r.end, r.n_tokens, r.n_crossing, r.doc_tokens) for r in found
    )
    expected = Counter()
    for key, text, *_ in rows:
        text = text or ""
        spans = library(BYTES).encode(text, add_special_tokens=False).offsets
        at = 0
        for n, line in enumerate(text.split("\n")):
            start, end = at, min(at + len(line) + 1, len(text))
            own = [(a, b) for a, b in spans if start <= a < end]
            over = sum(b > end for _, b in own)
            expected[key, n, start, end, len(own), over, len(spans)] += 1
            at += len(line) + 1
    assert got == expected
    assert token_counts.section_counts(frame(spark, []), BYTES).count() == 0


def test_sections_with_gaps_and_rules(spark):
    df = frame(spark, plain([(1, "one two three")]))
    parts = F.array(*[
        F.struct(F.lit(a).alias("start"), F.lit(b).alias("end")) for a, b in ((0, 4), (7, 13))
    ])
    first = token_counts.section_counts(df, BYTES, sections=parts).orderBy("section").collect()
    last = token_counts.section_counts(df, BYTES, sections=parts, rule="last")
    assert [(r.n_tokens, r.n_crossing) for r in first] == [(2, 1), (1, 0)]
    assert [r.n_tokens for r in last.orderBy("section").collect()] == [1, 1]
    with pytest.raises(ValueError, match="rule"):
        token_counts.section_counts(df, BYTES, rule="middle")
