"""What several of these operators share: stored tables, worker caches, texts in units."""

from __future__ import annotations

import re
import string
import sys
import types
from array import array
from collections.abc import Callable, Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from reachgrid.session import scratch

#: Characters of a text that are looked up and joined in one go.
CHUNK_CHARS = 1_000_000

#: Units a worker remembers; further ones are encoded again where they occur.
CACHED_UNITS = 1_000_000

#: Longer units are encoded, but not remembered.
CACHED_UNIT_CHARS = 64

#: Characters of texts whose units are told apart in one go by Arrow.
WORD_CHARS = 2_000_000

#: Words in each of the two generations that a worker remembers, about 270 bytes each.
RECENT_WORDS = 150_000


def store(df: DataFrame, name: str) -> DataFrame:
    """The table written to the shared folder (zstd) and read back."""
    path = scratch(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def worker_value(key: tuple, build: Callable):
    """A value built once per worker process. Functions travel to the workers
    by value, so that their own globals last for one task only."""
    kept = sys.modules.setdefault("_reachgrid_llm", types.ModuleType("_reachgrid_llm"))
    if key not in kept.__dict__:
        kept.__dict__[key] = build()
    return kept.__dict__[key]


def chunks_of(texts: Iterable[str], chars: int = CHUNK_CHARS) -> Iterator[list[str]]:
    """Consecutive texts of about ``chars`` in all; a longer one stands alone."""
    chunk, size = [], 0
    for text in texts:
        if chunk and size + len(text) > chars:
            yield chunk
            chunk, size = [], 0
        chunk.append(text)
        size += len(text)
    if chunk:
        yield chunk


class UnitEncoder:
    """Encodes texts by remembering what each space-delimited unit yields.

    ``encode_units`` takes a list of strings and returns a bytes value for each.
    With ``keep_space`` a unit holds the single space before it, as the byte-level
    vocabularies want it; their split pattern never joins characters over a space
    that has a character other than white space on either side, so that a text's
    ids are the ids of its units. Without it, white space has no ids at all.
    """

    def __init__(self, encode_units: Callable[[list[str]], list[bytes]], keep_space: bool):
        self.encode_units = encode_units
        self.keep_space = keep_space
        self.known: dict[str, bytes] = {}
        self.doubled = re.compile(r" \s|\s ")
        self.apart = re.compile(r"(?<=\S) (?=\S)")

    def units(self, text: str) -> list[str]:
        if not self.keep_space:
            return text.split(" ")
        if text[:1] == " " or text[-1:] == " " or self.doubled.search(text):
            return self.apart.split(text)
        return text.split(" ")

    def encode(self, texts: Iterable[str]) -> Iterator[list[bytes]]:
        """Per text, the values of its units."""
        for chunk in chunks_of(texts):
            cut = [self.units(text) for text in chunk]
            with_space = [units[self.keep_space :] for units in cut]
            extra = self.learn(set(chain.from_iterable(with_space)))
            get = self.known.__getitem__
            if self.keep_space:
                first = self.encode_units([units[0] for units in cut])
                found = [[value, *map(get, units)] for units, value in zip(with_space, first)]
            else:
                found = [list(map(get, units)) for units in with_space]
            for unit in extra:
                del self.known[unit]
            yield from found

    def learn(self, units: set[str]) -> list[str]:
        """Encode the units not known yet; returns those not to be remembered."""
        new = list(units.difference(self.known))
        lead = " " if self.keep_space else ""
        room = CACHED_UNITS - len(self.known)
        self.known.update(zip(new, self.encode_units([lead + u for u in new])))
        return new[max(room, 0) :] + [u for u in new[:room] if len(u) > CACHED_UNIT_CHARS]


class Recent(dict):
    """What ``build`` gives for strings, remembered in two generations of ``size``. When the
    younger is full, it becomes the older one, of which only what is met again stays."""

    def __init__(self, build: Callable[[str], bytes], size: int):
        self.build, self.size, self.older = build, size, {}

    def __missing__(self, text: str) -> bytes:
        value = self.older.get(text)
        if value is None:
            value = self.build(text)
        if len(text) <= CACHED_UNIT_CHARS:
            if len(self) >= self.size:
                self.older = self.copy()
                self.clear()
            self[text] = value
        return value


#: Punctuation that may follow a word.
ENDS = string.punctuation

#: A word of Latin letters with punctuation after it, for Arrow.
PLAIN = f"^(?P<word>[A-Za-zÀ-ÖØ-öø-ÿ]+)(?P<end>[{re.escape(ENDS)}]*)$"

#: The word alone.
LATIN = re.compile("[A-Za-zÀ-ÖØ-öø-ÿ]+")


class WordEncoder(UnitEncoder):
    """The same, where a unit of a word and punctuation takes its ids from those of the two.

    Arrow tells the units of many texts apart and puts their ids together; only words are
    remembered. ``piece`` gives the ids of a single piece of the split pattern, ``whole``
    those of any string.
    """

    def __init__(
        self, piece: Callable[[str], bytes], whole: Callable[[str], bytes], keep_space: bool
    ):
        super().__init__(lambda units: list(map(self.value, units)), keep_space)
        self.piece, self.whole = piece, whole
        self.words = Recent(piece, RECENT_WORDS)

    def plain(self, unit: str) -> bytes | None:
        """The ids of a word with punctuation after it, None for other units. Both split
        patterns cut such a unit before its punctuation, and nowhere else: letters of any
        kind are one piece, with the space before them, and so is the punctuation."""
        text = unit.rstrip(ENDS)
        word = text[1:] if self.keep_space and text[:1] == " " else text
        if not word.isalpha() or not (self.keep_space or LATIN.fullmatch(word)):
            return None
        end = unit[len(text) :]
        value = self.words[text if self.keep_space else text.lower()]
        return value + self.words[end] if end else value

    def value(self, unit: str) -> bytes:
        """The ids of any unit."""
        found = self.plain(unit)
        if found is None and self.keep_space and "\n" in unit and "\n " not in unit:
            # a line end alone before a character other than white space is a piece
            values = list(map(self.plain, unit.split("\n")))
            found = None if None in values else self.words["\n"].join(values)
        return self.whole(unit) if found is None else found

    def distinct(self, units: pa.Array) -> pa.Array:
        """The ids of distinct units, with the space before them if it is kept; null where
        such a unit has white space at an end, so that this space is not a single one."""
        found = pc.extract_regex(units, PLAIN)
        known = found.is_valid().to_numpy(zero_copy_only=False)
        found = found.drop_null()
        words, ends = (found.field(n).dictionary_encode() for n in ("word", "end"))
        spelled = words.dictionary if self.keep_space else pc.utf8_lower(words.dictionary)
        lead = " " if self.keep_space else ""
        ids = pa.array([self.words[lead + w] for w in strings(spelled)], pa.large_binary())
        after = [self.words[e] if e else b"" for e in strings(ends.dictionary)]
        after = pa.array(after, pa.large_binary()).take(ends.indices)
        both = pc.binary_join_element_wise(ids.take(words.indices), after, pa.scalar(b"", pa.large_binary()))
        others = []
        for unit in strings(units.filter(pa.array(~known))):
            apart = self.keep_space and (not unit or unit[0].isspace() or unit[-1].isspace())
            others.append(None if apart else self.value(lead + unit))
        place = np.where(known, np.cumsum(known) - 1, len(both) + np.cumsum(~known) - 1)
        return pa.concat_arrays([both, pa.array(others, pa.large_binary())]).take(pa.array(place))

    def encode(self, texts: Iterable[str]) -> Iterator[list[bytes]]:
        """Per text, its ids in one value."""
        for chunk in chunks_of(texts, WORD_CHARS):
            column = pa.array(chunk, pa.large_string())
            if self.keep_space:
                cut = pc.split_pattern(column, " ")
            else:
                cut = pc.ascii_split_whitespace(column)
            bounds = cut.offsets.to_numpy()
            units = cut.values.dictionary_encode()
            values = self.distinct(units.dictionary)
            index = units.indices.to_numpy().astype(np.int64)
            if not self.keep_space:
                yield from ([v] for v in self.joined(values, index, bounds))
                continue
            # the first unit of a text has no space before it
            first = bounds[:-1]
            index[first] = len(values)
            values = pa.concat_arrays([values, pa.array([b""], pa.large_binary())])
            bad = values.is_null().to_numpy(zero_copy_only=False)
            odd = np.add.reduceat(bad[index], first) > 0
            values = values.fill_null(b"")
            for text, apart, rest in zip(chunk, odd.tolist(), self.joined(values, index, bounds)):
                begin = text.partition(" ")[0]
                if not apart and begin and not begin[-1].isspace():
                    yield [self.value(begin), rest]
                else:
                    begin, *others = self.apart.split(text)
                    yield [self.whole(begin), *[self.value(" " + unit) for unit in others]]

    @staticmethod
    def joined(values: pa.Array, index: np.ndarray, bounds: np.ndarray) -> Iterator[bytes]:
        """The values of the units between bounds, one after the other."""
        taken = values.take(pa.array(index))
        ends = np.frombuffer(taken.buffers()[1], np.int64)[taken.offset :][: len(taken) + 1]
        data = taken.buffers()[2]
        places = ends[bounds].tolist()
        for low, high in zip(places, places[1:]):
            yield data[low:high].to_pybytes() if high > low else b""


def byte_letters() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies:
    printable bytes for themselves, the others in order from U+0100 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    table = {b: chr(b) for b in own}
    others = (b for b in range(256) if b not in table)
    table.update((b, chr(256 + n)) for n, b in enumerate(others))
    return [table[b] for b in range(256)]


def library_units(path: str, keep_space: bool) -> WordEncoder:
    """Units encoded by the tokenizers library, as little-endian unsigned 32-bit ids.

    With ``keep_space`` for byte-level vocabularies, else for those that lower-case
    and drop white space. Plain words go to the library's model at once, spelled as
    the vocabulary spells bytes; its own steps give the same, but take longer.
    """

    def build() -> WordEncoder:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        # the strings of special tokens are ordinary text here
        tokenizer.encode_special_tokens = True

        model, letters = tokenizer.model, byte_letters()

        def piece(text: str) -> bytes:
            lead = letters[32] if text[:1] == " " else ""
            rest = text[len(lead) :]
            if not rest.isascii() or rest == "\n":
                rest = "".join(map(letters.__getitem__, rest.encode()))
            return array("I", [token.id for token in model.tokenize(lead + rest)]).tobytes()

        def whole(unit: str) -> bytes:
            found = tokenizer.encode_batch_fast([unit], add_special_tokens=False)
            return array("I", found[0].ids).tobytes()

        return WordEncoder(piece, whole, keep_space)

    return worker_value(("units", path, keep_space), build)


def strings(column: pa.Array) -> list[str]:
    return column.to_numpy(zero_copy_only=False).tolist()


def texts_of(column: pa.Array) -> Iterator[str]:
    """The strings of an Arrow column, nulls as empty ones."""
    for value in column:
        yield value.as_py() or ""
