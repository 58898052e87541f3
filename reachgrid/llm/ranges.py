"""Running totals over a whole table in a global order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reachgrid.llm.shared import store

#: Rows of a range, which one task sorts and sums.
RANGE_ROWS = 100_000


def running_totals(
    df: DataFrame, order: list[Column], values: list[str], name: str
) -> DataFrame:
    """The table with ``before_<value>`` for each of the long columns named: its sum
    over all rows that come earlier in the order.

    The rows are dealt out in ranges of the order, whose number follows theirs. Each
    range is summed on its own, and begins with the sums of those before it; only the
    sums of the ranges meet in one task. Rows that are equal in all of ``order`` stay
    in one range, in no fixed order: name enough columns to tell rows apart. The
    ranged table is stored in the shared folder under ``name``. ``df`` is read twice,
    and should be a stored table itself. An empty table gives no rows.
    """
    n = max(1, -(-df.count() // RANGE_ROWS))
    ranged = df.repartitionByRange(n, *order).withColumn("__range", F.spark_partition_id())
    ranged = store(ranged, name)
    sums = ranged.groupBy("__range").agg(*[F.sum(v).alias(f"__sum_{v}") for v in values])
    earlier = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(
        "__range",
        *[F.coalesce(F.sum(f"__sum_{v}").over(earlier), F.lit(0)).alias(f"__start_{v}") for v in values],
    )
    inside = (
        Window.partitionBy("__range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    )
    return ranged.join(starts, "__range").select(
        *df.columns,
        *[
            (F.col(f"__start_{v}") + F.coalesce(F.sum(v).over(inside), F.lit(0))).alias(f"before_{v}")
            for v in values
        ],
    )
