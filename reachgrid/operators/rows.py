"""Counting equal rows, and writing counted rows out again."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Rows one entry of a counted group is written out to at a time.
CHUNK = 100_000


def count_rows(
    df: DataFrame, by: list[str], name: str, copies: str | None = None
) -> DataFrame:
    """Distinct rows with their number; equal rows meet on the map side.

    Rows that were counted before name their count in ``copies``.
    """
    number = F.count(F.lit(1)) if copies is None else F.sum(copies)
    return df.groupBy(*by).agg(number.alias(name))


def repeat_rows(df: DataFrame, copies: str, number: str) -> DataFrame:
    """Every row as often as its count says, numbered from 1 on.

    A large count is cut into chunks that are spread over the tasks before
    they are written out.
    """
    keys = [c for c in df.columns if c != copies]
    last = F.floor((F.col(copies) - 1) / CHUNK)
    chunks = df.select(
        "*", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("_chunk")
    ).repartition(*keys, "_chunk")
    first = F.col("_chunk") * CHUNK + 1
    upto = F.least(first + (CHUNK - 1), F.col(copies))
    return chunks.select(*keys, F.explode(F.sequence(first, upto)).alias(number))
