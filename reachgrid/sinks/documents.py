"""JSON documents as ordered lines.

A document is a table of lines with a section number and a key. Sorted by both
and written as text, its files joined in name order are the JSON document; no
task or driver ever holds the whole of it.
"""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reachgrid.operators.rows import count_rows, repeat_rows


def text_line(spark: SparkSession, section: int, text: str) -> DataFrame:
    """A fixed line of a document."""
    return spark.range(1).select(
        F.lit(section).alias("section"),
        F.lit(None).cast("string").alias("key"),
        F.lit(text).alias("line"),
    )


def value_line(one_row: DataFrame, section: int, line) -> DataFrame:
    """A line made from a table of one row."""
    return one_row.select(
        F.lit(section).alias("section"),
        F.lit(None).cast("string").alias("key"),
        line.alias("line"),
    )


def item_lines(items: DataFrame, section: int) -> DataFrame:
    """Lines of the elements of a JSON array or object, commas included.

    ``items`` has the columns key and line, and is read three times. Every
    element but the first gets a comma in front, the first a space, which sorts
    before it. Only elements with the smallest key are looked at closer, with
    equal ones counted, so that there is exactly one first row; the others pass
    without a shuffle.
    """
    least = items.agg(F.min(F.struct("key"))["key"]).scalar()
    ahead = F.col("key").eqNullSafe(least)
    head = count_rows(items.filter(ahead), ["key", "line"], "_copies")
    is_first = (F.col("line") == head.agg(F.min("line")).scalar()) & (F.col("_copy") == 1)
    comma = F.when(is_first, F.lit(" ")).otherwise(F.lit(","))
    return lines(
        *(
            part.select(
                F.lit(section).alias("section"),
                "key",
                F.concat(sign, F.col("line")).alias("line"),
            )
            for part, sign in (
                (repeat_rows(head, "_copies", "_copy"), comma),
                (items.filter(~ahead), F.lit(",")),
            )
        )
    )


def lines(*parts: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def write_document(document: DataFrame, path: str) -> None:
    """Write the lines in order as text files."""
    (
        document.repartitionByRange("section", "key", "line")
        .sortWithinPartitions("section", "key", "line")
        .select("line")
        .write.mode("overwrite")
        .text(path)
    )


def write_features(features: DataFrame, path: str) -> None:
    """Write one Feature per line, the form that needs no order at all."""
    features.select("line").write.mode("overwrite").text(path)


def json_text(value) -> str:
    """Compact JSON of a small constant."""
    return json.dumps(value, ensure_ascii=False, separators=(",", ":"))
