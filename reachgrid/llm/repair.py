"""Cheapest repairs of the turn structure of conversations, by shared suffixes."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reachgrid.llm.shared import store

#: What a text has to end with, white space aside.
STOPS = ".!?"

#: Costs of the edits: Keep, Rerole, Delete, Insert; of a truncated row that stays.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3

#: States of the grammar (s?(ua)+)?: nothing yet, after s, after u, after a. The role
#: that each wants next besides s at the beginning, and the state after it.
BEGIN, SYSTEM, USER, ASSISTANT = range(4)
WANTED = ("u", "u", "a", "u")
AFTER = (USER, USER, ASSISTANT, USER)
NAMES = {"u": "user", "a": "assistant"}

#: A row whose deletion is required, in a signature. Others are s, u, a or o (another
#: initial), upper-case if truncated.
MUST_GO = "x"

#: No choice: the conversation may end here.
END = ""

REPORT = (
    "conv_id long, signature string, gaps long, blank long, duplicate long, "
    "truncated long, illegal long"
)
ROWS = "conv_id long, place long, edit string, turn long, role string, text string"


class Suffixes:
    """Cheapest repairs by suffix of a signature and state of the grammar.

    A node of the automaton is a suffix; all signatures that end in it share it, with
    its cost to go and its first edit for each state. Signatures come in the order of
    their reversals, so that the suffixes of the last one are all that is held.
    """

    def __init__(self):
        self.signature = ""
        # the empty suffix: what is missing is inserted
        self.costs = [[0, 2 * INSERT, INSERT, 0]]
        self.edits = [[END, "I", "I", END]]

    def _push(self, symbol: str) -> None:
        below = self.costs[-1]
        cost, edit = [0] * 4, [""] * 4
        role, stays = symbol.lower(), TRUNCATED * symbol.isupper()
        for state in range(4):
            options = [(DELETE + below[state], "D")]
            if symbol != MUST_GO:
                if role == WANTED[state]:
                    options.append((stays + below[AFTER[state]], "K"))
                elif role == "s" and state == BEGIN:
                    options.append((stays + below[SYSTEM], "K"))
                options.append((REROLE + stays + below[AFTER[state]], "R"))
            cost[state], edit[state] = min(options)
        # an insertion stays at the node; three in a row lead from any state to any
        # that can be reached, and never pay twice
        for _ in range(3):
            for state in range(4):
                option = (INSERT + cost[AFTER[state]], "I")
                if option < (cost[state], edit[state]):
                    cost[state], edit[state] = option
        self.costs.append(cost)
        self.edits.append(edit)

    def repair(self, signature: str) -> tuple[int, str]:
        """The least cost of a repair and, of the cheapest, the least edits."""
        own = signature[::-1]
        shared = 0
        for a, b in zip(self.signature, own):
            if a != b:
                break
            shared += 1
        del self.costs[shared + 1 :], self.edits[shared + 1 :]
        for symbol in own[shared:]:
            self._push(symbol)
        self.signature = own
        node, state, audit = len(own), BEGIN, []
        while True:
            edit = self.edits[node][state]
            if edit == END:
                break
            audit.append(edit)
            symbol = own[node - 1] if node else ""
            if edit != "I":
                node -= 1
            if edit == "K" and symbol.lower() == "s":
                state = SYSTEM
            elif edit != "D":
                state = AFTER[state]
        return self.costs[len(own)][BEGIN], "".join(audit)


def cheapest(signatures: DataFrame) -> DataFrame:
    """``signature, cost, audit`` for each distinct ``signature``.

    They are sorted from their ends, over many tasks, so that neighbours share their
    suffixes; each task goes through a range of them and computes every node once.
    """
    rows = signatures.select("signature").distinct()
    rows = store(rows.withColumn("reversed", F.reverse("signature")), "signatures")
    ranged = rows.repartitionByRange("reversed").sortWithinPartitions("reversed")
    schema = pa.schema([("signature", pa.string()), ("cost", pa.int64()), ("audit", pa.string())])

    def repairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        suffixes = Suffixes()
        for batch in batches:
            own = batch["signature"].to_pylist()
            found = [suffixes.repair(s) for s in own]
            yield pa.RecordBatch.from_arrays(
                [pa.array(own, pa.string()), pa.array([c for c, _ in found], pa.int64()),
                 pa.array([a for _, a in found], pa.string())], schema=schema,
            )

    return ranged.mapInArrow(repairs, "signature string, cost long, audit string")


def read_rows(convs: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """``conv_id, turn, role, text`` with nulls in role and text as one space."""
    return convs.select(
        F.col(conv).cast("long").alias("conv_id"),
        F.col(turn).cast("long").alias("turn"),
        F.coalesce(F.col(role), F.lit(" ")).alias("role"),
        F.coalesce(F.col(text), F.lit(" ")).alias("text"),
    )


def _in_order(rows: DataFrame, *first: str) -> DataFrame:
    """Rows by conversation and turn, null turns first; ties by role, then by the MD5
    of the text."""
    return rows.repartition("conv_id").sortWithinPartitions(
        F.col("conv_id").asc_nulls_first(), *first, F.col("turn").asc_nulls_first(), "role", "digest"
    )


def signatures(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """``conv_id, signature`` with the counts of REPORT, for each of ``ids``.

    Texts do not travel: blank and truncated rows are told where the rows are read,
    repeated ones by role and MD5 of the text. A task holds 16 bytes and more for each
    row of the conversation it is at.
    """
    solid = F.rtrim("text", F.lit(" \t\n\x0b\x0c\r"))
    slim = rows.select(
        "conv_id", F.lit(True).alias("row"), "turn", "role", F.unhex(F.md5("text")).alias("digest"),
        F.when(solid == "", "blank").when(~F.substring(solid, -1, 1).isin(*STOPS), "truncated")
        .otherwise("").alias("fault"),
    )
    heads = ids.select("conv_id").distinct().withColumn("row", F.lit(False))
    dealt = _in_order(slim.unionByName(heads, allowMissingColumns=True), "row")
    schema = pa.schema(
        [(n, pa.string() if k == "string" else pa.int64()) for n, k in map(str.split, REPORT.split(", "))]
    )

    def reports(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state: dict | None = None
        for batch in batches:
            done: list[tuple] = []
            columns = (batch[c].to_pylist() for c in ("conv_id", "row", "turn", "role", "digest", "fault"))
            for conv, row, turn, role, digest, fault in zip(*columns):
                if not row:
                    if state is not None:
                        done.append(_report(state))
                    state = {"conv": conv, "seen": set(), "symbols": [], "turns": None, "number": 0,
                             "faults": dict.fromkeys(("blank", "duplicate", "truncated"), 0),
                             "before": None, "illegal": 0}
                    continue
                if turn is not None:
                    if state["turns"] is None:
                        state["turns"] = [turn, turn]
                        state["number"] = 1
                    elif turn != state["turns"][1]:
                        state["turns"][1] = turn
                        state["number"] += 1
                known = (role, digest)
                if fault != "blank" and known in state["seen"]:
                    fault = "duplicate"
                state["seen"].add(known)
                if fault:
                    state["faults"][fault] += 1
                initial = role[:1]
                if state["before"] is not None:
                    state["illegal"] += state["before"] + initial not in ("su", "ua", "au")
                state["before"] = initial
                symbol = initial if initial and initial in "sua" else "o"
                if fault in ("blank", "duplicate"):
                    symbol = MUST_GO
                state["symbols"].append(symbol.upper() if fault == "truncated" else symbol)
            yield from _batch(done, schema)
        if state is not None:
            yield from _batch([_report(state)], schema)

    return dealt.mapInArrow(reports, REPORT)


def _report(state: dict) -> tuple:
    low, high = state["turns"] or (0, -1)
    gaps = high - low + 1 - state["number"]
    faults = state["faults"]
    return (state["conv"], "".join(state["symbols"]), gaps, faults["blank"], faults["duplicate"],
            faults["truncated"], state["illegal"])


def _batch(rows: list[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    if rows:
        arrays = [pa.array(c, t) for c, t in zip(zip(*rows), schema.types)]
        yield pa.RecordBatch.from_arrays(arrays, schema=schema)


def reports(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """Per conversation of ``ids``: ``conv_id``, ``gaps`` (turn numbers that are missing
    between the least and the largest), ``blank``, ``duplicate``, ``truncated`` (rows by
    their first fault), ``illegal`` (neighbours whose roles do not follow each other),
    ``cost`` and ``audit`` of the cheapest repair. Stored in the shared folder."""
    found = store(signatures(rows, ids), "conversations")
    repairs = store(cheapest(found), "repairs")
    return store(found.join(repairs, "signature").drop("signature"), "reports")


def repaired(rows: DataFrame, found: DataFrame) -> DataFrame:
    """The repaired conversations, row by row: ``conv_id, place`` (from 0), ``edit`` (K,
    R, D or I), ``turn, role, text``. Deleted rows have no place, role or text;
    inserted ones no turn and an empty text.

    ``rows`` are those the reports were made of. Texts are shuffled once; a task goes
    through its conversations row by row. The rows of a conversation lie in one
    partition, in order.
    """
    slim = rows.withColumns({"digest": F.unhex(F.md5("text")), "audit": F.lit(None).cast("string")})
    heads = found.select("conv_id", "audit")
    union = slim.unionByName(heads, allowMissingColumns=True)
    dealt = _in_order(union.withColumn("row", F.col("audit").isNull()), "row")
    kinds = {"string": pa.string(), "long": pa.int64()}
    schema = pa.schema([(n, kinds[k]) for n, k in map(str.split, ROWS.split(", "))])

    def edited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        walk = Walk(None, "")
        for batch in batches:
            done: list[tuple] = []
            columns = (batch[c].to_pylist() for c in ("conv_id", "audit", "turn", "role", "text"))
            for conv, audit, turn, role, text in zip(*columns):
                if audit is not None:
                    done += walk.inserted()
                    walk = Walk(conv, audit)
                else:
                    done += walk.inserted()
                    done.append(walk.row(turn, role, text))
            yield from _batch(done, schema)
        yield from _batch(walk.inserted(), schema)

    return dealt.mapInArrow(edited, ROWS)


def spelled_digests(rows: DataFrame) -> DataFrame:
    """``conv_id, repaired_sha256`` of repaired rows as ``role:text``, newline-joined;
    conversations without rows that stay are absent. Rows are hashed one after the
    other, where ``repaired`` has left them."""
    schema = pa.schema([("conv_id", pa.int64()), ("repaired_sha256", pa.string())])

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, digest = None, None
        for batch in batches:
            done = []
            columns = (batch[c].to_pylist() for c in ("conv_id", "place", "role", "text"))
            for conv, place, role, text in zip(*columns):
                if place is None:
                    continue
                if place == 0:
                    if digest is not None:
                        done.append((own, digest.hexdigest()))
                    own, digest = conv, hashlib.sha256()
                else:
                    digest.update(b"\n")
                digest.update(f"{role}:{text}".encode())
            yield from _batch(done, schema)
        if digest is not None:
            yield from _batch([(own, digest.hexdigest())], schema)

    return rows.mapInArrow(hashed, "conv_id long, repaired_sha256 string")


class Walk:
    """Follows the edits of a conversation."""

    def __init__(self, conv: int | None, audit: str):
        self.conv, self.audit = conv, audit
        self.at = self.place = 0
        self.state = BEGIN

    def _put(self, edit: str, turn: int | None, role: str, text: str) -> tuple:
        place = self.place
        self.place += 1
        self.at += 1
        return (self.conv, place, edit, turn, role, text)

    def inserted(self) -> list[tuple]:
        """The rows to be inserted before the next one, or at the end."""
        done = []
        while self.audit[self.at : self.at + 1] == "I":
            role = NAMES[WANTED[self.state]]
            self.state = AFTER[self.state]
            done.append(self._put("I", None, role, ""))
        return done

    def row(self, turn: int | None, role: str, text: str) -> tuple:
        edit = self.audit[self.at]
        if edit == "D":
            self.at += 1
            return (self.conv, None, "D", turn, None, None)
        if edit == "K" and role[:1] == "s":
            self.state = SYSTEM
        else:
            if edit == "R":
                role = NAMES[WANTED[self.state]]
            self.state = AFTER[self.state]
        return self._put(edit, turn, role, text)


def repair(
    convs: DataFrame,
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    ids: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame]:
    """``reports`` and ``repaired`` rows of a table with a row per turn.

    A repaired conversation is empty, or a system turn that may be missing and user and
    assistant turns in pairs, by the initials of the roles. Keeping a row is free,
    giving it the role user or assistant costs 3, deleting it 4, inserting an empty
    user or assistant turn 3; blank rows, and rows whose role and text came before in
    the conversation, must go; a truncated row that stays costs 3 more. Of the cheapest
    repairs the one whose edits come first in ASCII is taken.

    Nulls in role and text are one space, null turns come first, equal turn numbers are
    ordered by role, then by the MD5 of the text; a null conversation is one. ``ids``
    (``conv_id``) names conversations to report on that may have no rows: their counts
    and costs are 0 and their audit is empty. An empty table gives no rows; other
    columns are not read.
    """
    rows = read_rows(convs, conv, turn, role, text)
    found = reports(rows, rows if ids is None else ids.unionByName(rows.select("conv_id")))
    return found, repaired(rows, found)


def damaged(convs: DataFrame, code: Column) -> DataFrame:
    """``conv_id, turn, role, text`` as ``read_rows`` gives them, with faults by a code:
    0 drops the row, 1 empties its text, 2 removes its stops, 3 repeats it, 4 makes it
    the user's; any other leaves it."""
    rows = convs.withColumn("__code", code).filter("__code <> 0")
    text = F.when(F.col("__code") == 1, "").when(
        F.col("__code") == 2, F.regexp_replace("text", "[.!?]", "")
    )
    twice = F.when(F.col("__code") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return rows.select(
        "conv_id", "turn",
        F.when(F.col("__code") == 4, "user").otherwise(F.col("role")).alias("role"),
        text.otherwise(F.col("text")).alias("text"),
        F.explode(twice).alias("__copy"),
    ).drop("__copy")
