"""Packing token sequences: non-negative least squares over a length histogram."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reachgrid.llm.shared import library_units, store, texts_of

#: Tokens of a sequence.
WINDOW = 2048

#: In combinations of three lengths, one is a multiple of this.
STEP = 64

#: Lengths of a combination for residuals, lengths that are tried for one place, and
#: rooms that are looked at to fill one sequence.
DEEPEST = 7
TRIES = 12
ROOMS = 200

#: Rounds of the least-squares solver.
ROUNDS = 300

#: Rows (part, rest) up to which their places are sent to all tasks; more are joined.
SENT_ROWS = 1_000_000

TOKEN_SCHEMA = "key {}, ids binary, doc_tokens long, part long, rest int, nth long, windows long"


def tokenized(
    docs: DataFrame, path: str, end_id: int, key: str, text: str, window: int = WINDOW
) -> DataFrame:
    """Ids of each whole text with the end id, and what a task knows of its rows:
    ``part`` (the task), ``rest`` (tokens beyond full windows), ``nth`` (rows before
    it in the part with the same rest), ``windows`` (full windows before it)."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units = library_units(path, keep_space=False)
        end = np.array([end_id], "<u4").tobytes()
        part = TaskContext.get().partitionId()
        met: dict[int, int] = {}
        windows = 0
        for batch in batches:
            ids, tokens, rests, nths, before = [], [], [], [], []
            for values in units.encode(texts_of(batch["text"])):
                joined = b"".join(values) + end
                n = len(joined) // 4
                rest = n % window
                ids.append(joined)
                tokens.append(n)
                rests.append(rest)
                nths.append(met.get(rest, 0))
                before.append(windows)
                met[rest] = met.get(rest, 0) + 1
                windows += n // window
            yield pa.RecordBatch.from_arrays(
                [
                    batch["key"],
                    pa.array(ids, pa.binary()),
                    pa.array(tokens, pa.int64()),
                    pa.array([part] * len(ids), pa.int64()),
                    pa.array(rests, pa.int32()),
                    pa.array(nths, pa.int64()),
                    pa.array(before, pa.int64()),
                ],
                ["key", "ids", "doc_tokens", "part", "rest", "nth", "windows"],
            )

    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind = rows.schema["key"].dataType.simpleString()
    return rows.mapInArrow(encode, TOKEN_SCHEMA.format(kind))


def combinations(present: np.ndarray, window: int, step: int) -> np.ndarray:
    """Two or three lengths, descending and 0-filled, that fill the window and whose
    parts are all present; in those of three, one length is a multiple of ``step``."""
    held = np.zeros(window + 1, bool)
    held[present] = True
    a = np.arange(1, window)
    pairs = np.stack([a, window - a, np.zeros_like(a)], 1)
    coarse = np.arange(step, window - 1, step)
    b, c = np.meshgrid(coarse, a, indexing="ij")
    triples = np.stack([b.ravel(), c.ravel(), window - b.ravel() - c.ravel()], 1)
    triples = triples[triples[:, 2] > 0]
    found = -np.sort(-np.concatenate([pairs, triples]), 1)
    found = np.unique(found, axis=0)
    return found[(held[found] | (found == 0)).all(1)]


def least_squares(combos: np.ndarray, histogram: np.ndarray, rounds: int) -> np.ndarray:
    """How often to use each combination: non-negative least squares of the lengths
    they use against the histogram, by accelerated projected gradients."""
    size = len(histogram)
    flat = combos.ravel()
    used = flat > 0
    owner = np.repeat(np.arange(len(combos)), 3)[used]
    flat = flat[used]

    def apply(x: np.ndarray) -> np.ndarray:
        return np.bincount(flat, x[owner], size)

    def back(r: np.ndarray) -> np.ndarray:
        return np.bincount(owner, r[flat], len(combos))

    # the largest eigenvalue bounds the step
    probe = np.ones(len(combos))
    for _ in range(20):
        probe = back(apply(probe))
        norm = np.linalg.norm(probe)
        probe /= norm
    x = y = np.zeros(len(combos))
    t = 1.0
    for _ in range(rounds):
        new = np.maximum(y - back(apply(y) - histogram) / (1.1 * norm), 0)
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        y = new + (t - 1) / t_new * (new - x)
        x, t = new, t_new
    return x


def filled(left: np.ndarray, room: int, deepest: int, tries: list[int]) -> list[int] | None:
    """Up to ``deepest`` lengths that are left and fill a room, or None: one or two that
    can be used most often, else the largest that leaves a room which can be filled.
    ``tries`` holds the number of rooms that may still be looked at."""
    tries[0] -= 1
    if tries[0] < 0 or deepest < 1:
        return None
    if left[room]:
        return [room]
    if deepest < 2 or room < 2:
        return None
    often = np.minimum(left[1 : room // 2 + 1], left[room - 1 : (room - 1) // 2 : -1])
    if room % 2 == 0:
        often[-1] = left[room // 2] // 2
    best = int(often.argmax())
    if often[best]:
        return [room - best - 1, best + 1]
    for length in np.flatnonzero(left[:room])[::-1][:TRIES].tolist():
        if length * deepest < room:
            break
        left[length] -= 1
        rest = filled(left, room - length, deepest - 1, tries)
        left[length] += 1
        if rest is not None:
            return [length, *rest]
    return None


def packed_residuals(left: np.ndarray, window: int) -> list[tuple[list[int], int]]:
    """Combinations of up to DEEPEST lengths that fill the window, found greedily for the
    longest that is left, each used as often as its lengths last; ``left`` is lowered."""
    chosen = []
    for length in range(window - 1, window // DEEPEST, -1):
        while left[length]:
            left[length] -= 1
            rest = filled(left, window - length, DEEPEST - 1, [ROOMS])
            left[length] += 1
            if rest is None:
                break
            kinds, each = np.unique([length, *rest], return_counts=True)
            times = int((left[kinds] // each).min())
            left[kinds] -= times * each
            chosen.append(([length, *rest], times))
    return chosen


def plan(histogram: np.ndarray, window: int, step: int = STEP) -> tuple[list[tuple], np.ndarray]:
    """How the rests of documents share sequences: ``(lengths, times)`` and, per
    length, how many are left.

    The solution is rounded to what the histogram holds; then each combination, largest
    solution first, takes what it still can of the residual. What is left after that
    is packed greedily, in combinations of more lengths.
    """
    left = histogram.astype(np.int64).copy()
    left[0] = 0
    combos = combinations(np.flatnonzero(left), window, step)
    chosen: dict[int, int] = {}
    if len(combos):
        x = least_squares(combos, left.astype(float), ROUNDS)
        order = np.argsort(-x, kind="stable")
        for wish in (np.floor(x + 0.5), np.full(len(x), np.inf)):
            for j in order:
                parts = combos[j][combos[j] > 0]
                if wish[j] < 1 or not left[parts].all():
                    continue
                kinds, each = np.unique(parts, return_counts=True)
                times = int(min(wish[j], (left[kinds] // each).min()))
                if times:
                    left[kinds] -= times * each
                    chosen[j] = chosen.get(j, 0) + times
    found = [(combos[j][combos[j] > 0].tolist(), n) for j, n in chosen.items()]
    return found + packed_residuals(left, window), left


def slots(histogram: np.ndarray, window: int) -> tuple[list[tuple], list[tuple[int, int]]]:
    """Per rest a row ``(rest, runs, used, stream)`` and the cuts of the stream.

    A run ``(low, high, sequence, offset)`` gives the low-th to high-th document of
    that rest a place each in the sequences from ``sequence`` on. Documents beyond
    ``used`` lie in a stream, longest rests first, from position ``stream`` on; it is
    cut into windows, and its end into powers of two: ``(position, sequence)``.
    """
    chosen, left = plan(histogram, window)
    runs: dict[int, list] = {}
    used: dict[int, int] = {}
    sequence = 0
    for lengths, times in chosen:
        offset = 0
        for length in lengths:
            low = used.get(length, 0)
            runs.setdefault(length, []).append((low, low + times, sequence, offset))
            used[length] = low + times
            offset += length
        sequence += times
    rows, position = [], 0
    for rest in np.flatnonzero(histogram)[::-1].tolist():
        if rest:
            rows.append((rest, runs.get(rest, []), used.get(rest, 0), position))
            position += int(left[rest]) * rest
    full, tail = divmod(position, window)
    cuts = [(0, sequence)]
    at = full * window
    sequence += full
    while tail:
        size = 1 << (tail.bit_length() - 1)
        cuts.append((at, sequence))
        at, tail, sequence = at + size, tail - size, sequence + 1
    return rows, [*cuts, (at, sequence)]


SLOT_SCHEMA = (
    "rest int, runs array<struct<low:long,high:long,sequence:long,offset:long>>, "
    "used long, stream long"
)


def _pieces(cuts: list[tuple[int, int]], window: int) -> Column:
    """The pieces of a row as start, length, sequence and offset."""

    def piece(start, length, sequence, offset) -> Column:
        values = zip(("start", "length", "sequence_id", "offset"), (start, length, sequence, offset))
        return F.struct(*[F.lit(v).cast("long").alias(n) for n, v in values])

    tail = cuts[1:-1]
    first_tail = tail[0][0] if tail else cuts[-1][0]
    n_planned = cuts[-1][1]
    windows = F.floor(F.col("doc_tokens") / window)
    full = F.transform(
        F.sequence(F.lit(0).cast("long"), windows - 1),
        lambda i: piece(
            i * window,
            F.lit(window),
            F.shiftleft(F.col("part"), 32) + F.col("windows") + i + n_planned,
            F.lit(0),
        ),
    )
    none = F.expr(
        "cast(array() AS array<struct<start:long,length:long,sequence_id:long,offset:long>>)"
    )
    full = F.when(windows > 0, full).otherwise(none)
    nth = F.col("nth") + F.coalesce("before", F.lit(0))
    run = F.get(F.filter("runs", lambda r: (r["low"] <= nth) & (nth < r["high"])), F.lit(0))
    done = windows * window
    whole = F.array(
        piece(done, F.col("rest"), run["sequence"] + nth - run["low"], run["offset"])
    )
    begin = F.col("stream") + (nth - F.col("used")) * F.col("rest")
    end = begin + F.col("rest")
    next_window = (F.floor(begin / window) + 1) * window
    inner = [F.when(next_window < first_tail, next_window)]
    inner += [F.lit(at).cast("long") for at, _ in tail]
    inside = F.filter(F.array_compact(F.array(*inner)), lambda x: (x > begin) & (x < end))
    marks = F.array_sort(F.array_distinct(F.concat(F.array(begin), inside)))

    def of_mark(mark: Column, i: Column) -> Column:
        stop = F.coalesce(F.get(marks, i + 1), end)
        sequence = F.lit(cuts[0][1]) + F.floor(mark / window)
        offset = F.pmod(mark, F.lit(window))
        for at, number in tail:
            sequence = F.when(mark >= at, number).otherwise(sequence)
            offset = F.when(mark >= at, mark - at).otherwise(offset)
        return piece(done + mark - begin, stop - mark, sequence, offset)

    last = F.when(F.col("rest") == 0, none)
    last = last.when(run.isNotNull(), whole).otherwise(F.transform(marks, of_mark))
    return F.concat(full, last)


def pack(
    docs: DataFrame,
    path: str,
    end_id: int = 1,
    key: str = "doc_id",
    text: str = "text",
    window: int = WINDOW,
) -> DataFrame:
    """A row per piece: ``key, start, length, ids, doc_tokens, sequence_id, offset``;
    ``ids`` are little-endian unsigned 32-bit numbers.

    Every id of a document, the end id included, lies in one piece. Full windows of a
    document are sequences of their own. The rests are packed by a plan over their
    histogram (at most ``window`` numbers, whatever the corpus), and what the plan
    leaves lies end to end in a stream cut into windows; the stream's end is cut into
    powers of two, so that nothing is padded. Null and empty texts hold the end id
    alone; null keys and repeated rows are documents of their own; an empty table
    gives no rows; other columns are not read.
    """
    tokens = store(tokenized(docs, path, end_id, key, text, window), "tokens")
    counts = tokens.filter("rest > 0").groupBy("part", "rest").agg(F.count("*").alias("n"))
    counts = store(counts, "rests")
    # one number per length of rest, bounded by the window
    totals = counts.groupBy("rest").agg(F.sum("n").alias("n")).collect()
    histogram = np.zeros(window, np.int64)
    for row in totals:
        histogram[row["rest"]] = row["n"]
    rows, cuts = slots(histogram, window)
    spark = docs.sparkSession
    planned = spark.createDataFrame(rows, SLOT_SCHEMA)
    order = Window.partitionBy("rest").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("part", "rest", F.sum("n").over(order).alias("before"))
    if counts.count() <= SENT_ROWS:
        bases = F.broadcast(bases)
    placed = tokens.join(bases, ["part", "rest"], "left")
    # at most one row per length of rest
    placed = placed.join(F.broadcast(planned), "rest", "left")
    pieces = placed.select("key", "ids", "doc_tokens", F.explode(_pieces(cuts, window)).alias("p"))
    return pieces.select(
        F.col("key").alias(key),
        "p.start",
        "p.length",
        F.expr("substring(ids, cast(4 * p.start + 1 AS int), cast(4 * p.length AS int))").alias("ids"),
        "doc_tokens",
        "p.sequence_id",
        "p.offset",
    )
