"""Row counts and key checks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reachgrid.operators.rows import count_rows


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per table with its name and number of rows."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("tabelle"), "n")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that break a primary key: repeated, or with a missing part."""
    missing = reduce(lambda a, b: a | b, (F.col(k).isNull() for k in keys))
    return count_rows(df, keys, "n").filter((F.col("n") > 1) | missing)


def check_primary_key_exists(df: DataFrame, keys: list[str]) -> bool:
    """Whether the columns identify every row."""
    return duplicate_keys(df, keys).isEmpty()
