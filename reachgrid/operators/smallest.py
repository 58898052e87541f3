"""The smallest times of every cell, with how often they occur, from one scan.

The state of a cell is the list of its smallest times, each with its hospital and the
number of equal rows. States can be merged: a row that enough smaller rows precede
in a part of the table is preceded by them in the whole. So every task reduces
what it reads, in Arrow batches, to the states of its cells; these are shuffled, once,
and merged. A cell or a row that makes up a large part of the table costs every task a
few rows, and no rows of a cell are ever gathered.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reachgrid.functions.numbers import no_nan
from reachgrid.schema import CELL, HOSPITAL, SECONDS

# How many equal rows a row stands for.
COPIES = "_copies"

# The shortest time to another hospital than the nearest.
NEXT_SECONDS = "Naechste_Sekunden"

# Rows a task reads before it reduces them, and rows of reduced states it holds before
# it hands them on; more states are merged after the shuffle. They bound what a worker
# takes (about 340 MB at its peak), whatever a task reads.
READ_ROWS = 150_000
HELD_ROWS = 400_000
OUT_ROWS = 50_000


def _numbered(column: pa.ChunkedArray) -> tuple[np.ndarray, pa.Array]:
    """A number per value, missing ones included, and the values."""
    encoded = pc.dictionary_encode(column.combine_chunks(), null_encoding="encode")
    if isinstance(encoded, pa.ChunkedArray):
        encoded = encoded.combine_chunks()
    return encoded.indices.to_numpy(zero_copy_only=False).astype(np.int64), encoded.dictionary


def fewest_before(cells: np.ndarray, seconds: np.ndarray, copies: np.ndarray) -> np.ndarray:
    """For each row the number of rows of its cell with a smaller time."""
    order = np.lexsort((seconds, cells))
    cell, time, count = cells[order], seconds[order], copies[order]
    before = np.cumsum(count) - count
    new_cell = np.concatenate(([True], cell[1:] != cell[:-1]))
    new_time = new_cell | np.concatenate(([True], time[1:] != time[:-1]))
    starts = np.maximum.accumulate(np.where(new_cell, np.arange(len(cell)), 0))
    ties = np.maximum.accumulate(np.where(new_time, np.arange(len(cell)), 0))
    found = np.empty(len(cells), np.int64)
    found[order] = before[ties] - before[starts]
    return found


def smallest_rows(table: pa.Table, n: int, lists: list[str]) -> pa.Table:
    """The rows that fewer than ``n`` rows of their cell precede, equal rows counted.

    With several ``lists``, each a column of counts, a row stays if it is among the
    smallest of any of them; ``n`` is 1 then.
    """
    if not len(table):
        return table
    cells, values = _numbered(table[CELL])
    seconds = table[SECONDS].to_numpy()
    if n == 1:
        keep = np.zeros(len(table), bool)
        for name in lists:
            listed = table[name].to_numpy() > 0
            if listed.any():
                least = np.full(len(values), seconds.max(), seconds.dtype)
                np.minimum.at(least, cells[listed], seconds[listed])
                keep |= listed & (seconds == least[cells])
    else:
        keep = fewest_before(cells, seconds, table[lists[0]].to_numpy()) < n
    kept = table.filter(pa.array(keep)).group_by([CELL, HOSPITAL, SECONDS], use_threads=False)
    return kept.aggregate([(c, "sum") for c in lists]).rename_columns(table.column_names)


def nearest_two(table: pa.Table, n: int = 2) -> pa.Table:
    """The ``n`` nearest hospitals of each cell with their shortest times: known times
    first, ties by the hospital's number, missing numbers first."""
    if not len(table):
        return table
    best = table.group_by([CELL, HOSPITAL], use_threads=False).aggregate([(SECONDS, "min")])
    best = best.rename_columns([CELL, HOSPITAL, SECONDS])
    cells, _ = _numbered(best[CELL])
    hospitals, names = _numbered(best[HOSPITAL])
    by_name = pc.sort_indices(names, null_placement="at_start").to_numpy()
    place = np.empty(len(names), np.int64)
    place[by_name] = np.arange(len(names))
    unknown = best[SECONDS].is_null().combine_chunks().to_numpy(zero_copy_only=False)
    seconds = best[SECONDS].fill_null(0).to_numpy()
    order = np.lexsort((place[hospitals], seconds, unknown, cells))
    cell = cells[order]
    first = np.maximum.accumulate(
        np.where(np.concatenate(([True], cell[1:] != cell[:-1])), np.arange(len(cell)), 0)
    )
    return best.take(pa.array(order[np.arange(len(cell)) - first < n]))


def reduced(df: DataFrame, reduce) -> DataFrame:
    """Every task's rows, reduced by a function of a table that may be applied again to
    the tables it has returned. The columns stay what they are."""
    schema = df.schema

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read: list[pa.RecordBatch] = []
        held: pa.Table | None = None
        n = 0
        for batch in batches:
            read.append(batch)
            n += batch.num_rows
            if n < READ_ROWS:
                continue
            fresh = reduce(pa.Table.from_batches(read))
            held = fresh if held is None else reduce(pa.concat_tables([held, fresh]))
            read, n = [], 0
            if len(held) > HELD_ROWS:
                yield from held.to_batches(OUT_ROWS)
                held = None
        if read:
            fresh = reduce(pa.Table.from_batches(read))
            held = fresh if held is None else reduce(pa.concat_tables([held, fresh]))
        if held is not None:
            yield from held.to_batches(OUT_ROWS)

    return df.mapInArrow(parts, schema)


def smallest_times(
    times: DataFrame, n: int = 1, lists: tuple[str, ...] = ()
) -> DataFrame:
    """``Gitterzellen_ID, Krankenhaus_Standortnummer, Fahrzeit_Sekunden`` and counts of
    the rows that fewer than ``n`` rows of their cell precede by time, so of all that
    tie for the ``n``-th place.

    Equal rows are counted in ``_copies``. Or ``lists`` names columns with the number of
    times each row counts in several lists, and so often the row is found among the
    smallest of each list (0 where it is not); ``n`` is 1 then. Rows without a time take
    no part, a missing cell or hospital is a value like any other. The result is
    partitioned by cell.
    """
    if n > 1 and len(lists) > 1:
        raise ValueError("several lists are reduced to their first times only")
    counts = [F.col(c).cast("long").alias(c) for c in lists]
    names = list(lists) or [COPIES]
    known = times.select(
        CELL, HOSPITAL, no_nan(times, SECONDS).alias(SECONDS),
        *(counts or [F.lit(1).cast("long").alias(COPIES)]),
    ).filter(F.col(SECONDS).isNotNull())
    states = reduced(known, lambda table: smallest_rows(table, n, names))
    of_cell = Window.partitionBy(CELL)
    if n > 1:
        upto = F.sum(names[0]).over(of_cell.orderBy(SECONDS))
        ties = F.sum(names[0]).over(Window.partitionBy(CELL, SECONDS))
        kept = states.withColumn("_upto", upto).withColumn("_ties", ties)
        kept = kept.filter(F.col("_upto") - F.col("_ties") < n)
        return kept.groupBy(CELL, HOSPITAL, SECONDS).agg(F.sum(names[0]).alias(names[0]))
    least = {
        c: F.min(F.when(F.col(c) > 0, F.col(SECONDS))).over(of_cell).alias(f"_least{c}")
        for c in names
    }
    marked = states.select("*", *least.values()).select(
        CELL, HOSPITAL, SECONDS,
        *(F.when(F.col(SECONDS) == F.col(f"_least{c}"), F.col(c)).otherwise(0).alias(c) for c in names),
    )
    found = marked.groupBy(CELL, HOSPITAL, SECONDS).agg(*(F.sum(c).alias(c) for c in names))
    return found.filter(" OR ".join(f"`{c}` > 0" for c in names))


def two_nearest(times: DataFrame) -> DataFrame:
    """A row per cell with its nearest hospital and its shortest time to any other:
    ``Gitterzellen_ID, Krankenhaus_Standortnummer, Fahrzeit_Sekunden, Naechste_Sekunden``.

    Of hospitals that tie, the smallest number is the nearest, a missing one before all.
    Cells without a known time are there, without one; ``Naechste_Sekunden`` is missing
    where no other hospital has a known time.
    """
    rows = times.select(CELL, HOSPITAL, no_nan(times, SECONDS).alias(SECONDS))
    states = reduced(rows, nearest_two)
    entry = F.struct(F.col(SECONDS).isNull().alias("unknown"), SECONDS, HOSPITAL)
    cells = states.groupBy(CELL).agg(F.array_sort(F.collect_list(entry)).alias("_found"))
    first = F.col("_found")[0]
    others = F.filter("_found", lambda f: ~f[HOSPITAL].eqNullSafe(first[HOSPITAL]))
    return cells.select(
        CELL,
        first[HOSPITAL].alias(HOSPITAL),
        first[SECONDS].alias(SECONDS),
        F.get(others, F.lit(0))[SECONDS].alias(NEXT_SECONDS),
    )
