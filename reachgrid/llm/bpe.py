"""Byte-level BPE by backtracking over longest matches."""

from __future__ import annotations

import base64
from array import array
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column
from pyspark.sql import functions as F

from reachgrid.llm.shared import CACHED_UNIT_CHARS, UnitEncoder, texts_of, worker_value

#: Remembered answers on which tokens may stand side by side.
CACHED_PAIRS = 2_000_000

#: Pieces of units whose ids a worker remembers.
CACHED_PIECES = 400_000

#: Bytes of a long piece that are matched at once, longer than any token.
PART = 1_024

NEVER = 1 << 62


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as file:
        pairs = (line.split() for line in file if line.strip())
        return {base64.b64decode(token): int(rank) for token, rank in pairs}


class Backtracker:
    """Encodes bytes by the ranks of a vocabulary, in time linear in their number.

    A sequence of tokens is what the merges would give if each two neighbours are
    what the merges give for their joined bytes. So the encoder takes the longest
    token at each place (found by an Aho-Corasick automaton over the bytes as Latin-1
    characters) and falls back to shorter ones where neighbours do not go together;
    places that turned out to lead nowhere are not tried again.
    """

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.automaton = ahocorasick.Automaton()
        for token, rank in ranks.items():
            self.automaton.add_word(token.decode("latin-1"), rank)
        self.automaton.make_automaton()
        self.halves: dict[int, tuple[int, int] | None] = {}
        self.pairs: dict[tuple[int, int], bool] = {}
        self.edges: dict[tuple[int, int], list[tuple[int, int, int]]] = {}
        self.shorter: dict[int, int] = {}
        self.widest = max(map(len, ranks))
        self.sizes = [0] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.sizes[rank] = len(token)

    def split(self, token: int) -> tuple[int, int] | None:
        """The two tokens whose merge makes this one; None for a single byte."""
        if token not in self.halves:
            parts = [bytes([b]) for b in self.tokens[token]]
            while len(parts) > 2:
                ranked = [self.ranks.get(a + b, NEVER) for a, b in zip(parts, parts[1:])]
                at = ranked.index(min(ranked))
                parts[at : at + 2] = [parts[at] + parts[at + 1]]
            pair = (self.ranks[parts[0]], self.ranks[parts[1]]) if len(parts) == 2 else None
            self.halves[token] = pair
        return self.halves[token]

    def edge(self, token: int, side: int) -> list[tuple[int, int, int]]:
        """The tokens that stand at one end while the merges build a token, the whole
        first: ``(token, born, gone)``, times being ranks of merges."""
        key = (token, side)
        if key in self.edges:
            return self.edges[key]
        chain, gone = self.edges.setdefault(key, []), NEVER
        while True:
            pair = self.split(token)
            born = -1 if pair is None else token
            chain.append((token, born, gone))
            if pair is None:
                return chain
            gone, token = born, pair[side]

    def together(self, left: int, right: int) -> bool:
        """Whether the merges keep these neighbours as they are: no two tokens that
        stand side by side at their border for a while merge in that while. Of equal
        ranks the left one merges first."""
        key = (left, right)
        known = self.pairs.get(key)
        if known is None:
            a, b = self.edge(left, 1), self.edge(right, 0)
            i = j = 0
            known = True
            while i < len(a) and j < len(b):
                (x, x_born, x_gone), (y, y_born, y_gone) = a[i], b[j]
                merge = self.ranks.get(self.tokens[x] + self.tokens[y], NEVER)
                if merge < x_gone and merge <= y_gone and merge != NEVER:
                    known = False
                    break
                # the one that came last was not there before
                if x_born > y_born:
                    i += 1
                else:
                    j += 1
            if len(self.pairs) >= CACHED_PAIRS:
                self.pairs.clear()
            self.pairs[key] = known
        return known

    def shortened(self, token: int) -> int:
        """The longest token that is a proper beginning of this one, or -1."""
        if token not in self.shorter:
            whole = self.tokens[token]
            found = (self.ranks.get(whole[:n], -1) for n in range(len(whole) - 1, 0, -1))
            self.shorter[token] = next((rank for rank in found if rank >= 0), -1)
        return self.shorter[token]

    def encode(self, piece: bytes) -> list[int]:
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        spelled = piece.decode("latin-1")
        n, sizes, known = len(spelled), self.sizes, self.pairs.get
        dead: set[int] = set()
        out: list[int] = []
        at, last = 0, -1
        while at < n:
            stop = at + PART
            sure = n if stop >= n else stop - self.widest
            # the longest token at each place, one after the other
            for _, token in self.automaton.iter_long(spelled[at:stop]):
                if at > sure:  # it may be longer than this part shows
                    break
                end = at + sizes[token]
                fits = last < 0 or known((last, token))
                if fits is None:
                    fits = self.together(last, token)
                if not fits or end in dead:
                    at = self.shorten(out, token, at, dead)
                    last = out[-1]
                    break
                out.append(token)
                at, last = end, token
        return out

    def shorten(self, out: list[int], token: int, at: int, dead: set[int]) -> int:
        """Put a shorter token where this one does not go together with the last, or
        one place back; returns the place after it."""
        token = self.shortened(token)
        while True:
            if token < 0:
                dead.add(at)
                last = out.pop()
                at -= self.sizes[last]
                token = self.shortened(last)
            elif at + self.sizes[token] not in dead and (
                not out or self.together(out[-1], token)
            ):
                out.append(token)
                return at + self.sizes[token]
            else:
                token = self.shortened(token)


def rank_units(path: str, pattern: str) -> UnitEncoder:
    def build() -> UnitEncoder:
        encoder = Backtracker(read_ranks(path))
        pieces = regex.compile(pattern)

        known: dict[str, bytes] = {}

        def values_of(cut: list[str]) -> list[bytes]:
            fresh = list(set(cut).difference(known))
            for piece in fresh:
                known[piece] = array("i", encoder.encode(piece.encode())).tobytes()
            values = list(map(known.__getitem__, cut))
            room = max(0, CACHED_PIECES - len(known) + len(fresh))
            long = [piece for piece in fresh[:room] if len(piece) > CACHED_UNIT_CHARS]
            for piece in fresh[room:] + long:
                del known[piece]
            return values

        def encode_units(units: list[str]) -> list[bytes]:
            # no piece reaches over the space that a unit begins with, where the one
            # before ends with another character: such units are cut in one go
            joined = [u for u in units if u[:1] == " " and not u[-1:].isspace()]
            others = [u for u in units if u[:1] != " " or u[-1:].isspace()]
            cut = [pieces.findall("".join(joined)), *map(pieces.findall, others)]
            values = values_of(list(chain.from_iterable(cut)))
            spans = np.cumsum(np.fromiter(map(len, cut[0]), np.int64, len(cut[0])))
            ends = np.cumsum(np.fromiter(map(len, joined), np.int64, len(joined)))
            counts = [0, *(np.searchsorted(spans, ends) + 1).tolist()]
            for own in cut[1:]:
                counts.append(counts[-1] + len(own))
            bounds = np.cumsum([0, *map(len, values)])[counts].tolist()
            flat = b"".join(values)
            ids = dict(zip(joined + others, [flat[a:b] for a, b in zip(bounds, bounds[1:])]))
            return list(map(ids.__getitem__, units))

        return UnitEncoder(encode_units, keep_space=True)

    return worker_value(("ranks", path, pattern), build)


def encoded_batch(column: pa.Array, path: str, pattern: str) -> pa.Array:
    """The ids of each match of ``pattern`` in whole texts, special tokens being
    ordinary text. A null text has no ids, like an empty one."""
    units = rank_units(path, pattern)
    values = [np.frombuffer(b"".join(v), "<i4") for v in units.encode(texts_of(column))]
    offsets = np.concatenate(([0], np.cumsum([len(v) for v in values]))).astype(np.int32)
    flat = np.concatenate(values) if values else np.empty(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, pa.int32()))


def decoded_batch(column: pa.Array, path: str) -> pa.Array:
    """The bytes of lists of ids; a null list has none."""

    def build() -> pa.Array:
        tokens = {rank: token for token, rank in read_ranks(path).items()}
        return pa.array([tokens.get(i, b"") for i in range(max(tokens) + 1)], pa.large_binary())

    # the tokens of a whole batch lie side by side, as the bytes of its documents
    tokens = worker_value(("tokens", path), build).take(column.flatten())
    _, ends, data = tokens.buffers()
    at = np.frombuffer(ends, np.int64)[tokens.offset : tokens.offset + len(tokens) + 1]
    sizes = pc.fill_null(pc.list_value_length(column), 0).to_numpy().astype(np.int64)
    bounds = np.concatenate(([0], np.cumsum(sizes)))
    bounds = at[bounds].astype(np.int64) if len(tokens) else bounds
    whole = pa.py_buffer(np.ascontiguousarray(bounds))
    found = pa.Array.from_buffers(pa.large_binary(), len(column), [None, whole, data])
    return found.cast(pa.binary())


def encoded(text: Column, path: str, pattern: str) -> Column:
    """The ids of a text (see ``encoded_batch``)."""

    @F.arrow_udf("array<int>")
    def encode(column: pa.Array) -> pa.Array:
        return encoded_batch(column, path, pattern)

    return encode(text)


def decoded(ids: Column, path: str) -> Column:
    """The bytes of a list of ids; a null list has none."""

    @F.arrow_udf("binary")
    def decode(column: pa.Array) -> pa.Array:
        return decoded_batch(column, path)

    return decode(ids)


def round_trip(docs, path: str, pattern: str, key: str = "doc_id", text: str = "text"):
    """``key, ids, decoded`` of every row: the ids of its whole text, and the bytes
    that they decode to. Both come from one function, so that texts are encoded once.

    Null texts are empty: no ids, no bytes. Null keys and repeated rows stay as they
    are; an empty table gives no rows; other columns are not read.
    """

    @F.arrow_udf("struct<ids:array<int>,decoded:binary>")
    def both(column: pa.Array) -> pa.Array:
        ids = encoded_batch(column, path, pattern)
        return pa.StructArray.from_arrays([ids, decoded_batch(ids, path)], ["ids", "decoded"])

    rows = docs.select(F.col(key), both(F.col(text)).alias("__both"))
    return rows.select(key, "__both.ids", "__both.decoded")
