"""Time points that are stored, and compared by what has changed between them.

The rows of a time point are written in ranges of cells, each with a digest of its rows
and with its sums per group. A range whose digest is that of the time point before has
its sums as well, so only the others are read and summed again. A comparison adds up
sums and reads no rows at all.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reachgrid.functions.numbers import count_values
from reachgrid.operators.analyses import TIME_POINT
from reachgrid.operators.summary import partial_columns, prepared_rows, rolled_up
from reachgrid.schema import CELL, PEOPLE, SECONDS, require_columns
from reachgrid.sinks.complete import is_complete, mark_complete
from reachgrid.sources.tables import qualified

RANGE = "_bereich"
RANGES = 256
COPIES = "_copies"


@dataclass(frozen=True)
class TimePoint:
    """A stored time point and how much of it had to be read to sum it up."""

    folder: str
    by: tuple[str, ...]
    rows: int
    rows_read: int

    @property
    def share_read(self) -> float:
        return self.rows_read / self.rows if self.rows else 0.0


def _digests(rows: DataFrame) -> DataFrame:
    """Per range the number of rows and a sum over them that no order changes."""
    value = F.xxhash64(*[c for c in rows.columns if c != RANGE])
    return rows.groupBy(RANGE).agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum(value.cast("decimal(38,0)")).alias("first"),
        F.sum(F.xxhash64(value, F.lit(1)).cast("decimal(38,0)")).alias("second"),
    )


def _changed(now: DataFrame, before: DataFrame) -> list[int]:
    """Ranges whose rows are not those of the time point before, of RANGES at most."""
    same = ["rows", "first", "second"]
    return [row[0] for row in now.join(before, [RANGE, *same], "left_anti").select(RANGE).collect()]


def store_time_point(
    data: DataFrame,
    folder: str,
    by: list[str],
    copies: str | None = None,
    previous: str | None = None,
    ranges: int = RANGES,
) -> TimePoint:
    """Write the cell rows of a time point and their sums per group of ``by``.

    ``previous`` is the folder of another time point, stored with the same columns, groups and ranges:
    where a range holds the same rows, its sums are taken over. ``copies`` names a
    column with the number of rows each row stands for. Cells without a number are one
    range; equal rows count each; no rows give a time point without groups.
    """
    require_columns(data, [CELL, SECONDS, PEOPLE, *by])
    spark, folder = data.sparkSession, folder.rstrip("/")
    before = None if previous is None else previous.rstrip("/")
    if before is not None and qualified(spark, before) == qualified(spark, folder):
        raise ValueError("A time point cannot replace the one before it")
    count: Column = F.lit(1) if copies is None else F.col(copies)
    kept = data.select(*dict.fromkeys([CELL, SECONDS, PEOPLE, *by]), count.cast("long").alias(COPIES))
    placed = kept.withColumn(RANGE, F.pmod(F.xxhash64(CELL), F.lit(ranges)).cast("int"))
    schema = placed.schema
    placed.hint("rebalance", RANGE).write.mode("overwrite").partitionBy(RANGE).parquet(f"{folder}/rows")
    rows = spark.read.schema(schema).parquet(f"{folder}/rows")
    _digests(rows).write.mode("overwrite").parquet(f"{folder}/digests")
    digests = spark.read.parquet(f"{folder}/digests")

    taken, wanted = None, None
    if before is not None:
        if not is_complete(spark, f"{before}/sums"):
            raise FileNotFoundError(f"No stored time point: {before}")
        old = spark.read.parquet(f"{before}/sums")
        require_columns(old, [RANGE, *by])
        wanted = _changed(digests, spark.read.parquet(f"{before}/digests"))
        gone = digests.select(RANGE).filter(~F.col(RANGE).isin(wanted))
        taken = old.join(gone, RANGE, "left_semi")
    # a condition on the folders of the ranges: others are not opened
    part = rows if wanted is None else rows.filter(F.col(RANGE).isin(wanted))
    sums = prepared_rows(part, COPIES).groupBy(RANGE, *by).agg(
        *partial_columns([], count_values(F.col(CELL)))
    )
    if taken is not None:
        sums = sums.unionByName(taken.select(*sums.columns))
    sums.write.mode("overwrite").parquet(f"{folder}/sums")
    mark_complete(spark, f"{folder}/sums")
    read = F.lit(True) if wanted is None else F.col(RANGE).isin(wanted)
    counts = digests.agg(F.sum("rows"), F.sum(F.when(read, F.col("rows")))).first()
    return TimePoint(folder, tuple(by), counts[0] or 0, counts[1] or 0)


def compare_time_points(
    spark: SparkSession, folders: dict[str, str], by: list[str]
) -> DataFrame:
    """What ``zeitreihen_vergleich`` gives for the rows of stored time points, from
    their sums."""
    tagged = [
        spark.read.parquet(f"{folder.rstrip('/')}/sums").withColumn(TIME_POINT, F.lit(name))
        for name, folder in folders.items()
    ]
    sums = reduce(DataFrame.unionByName, tagged).withColumn("_cell", F.lit(None).cast("string"))
    return sums.groupBy(*by, TIME_POINT).agg(*rolled_up([]))
