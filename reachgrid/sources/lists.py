"""User-supplied CSV lists. Every column is read as text, so that keys keep
their leading zeros."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from reachgrid.schema import HOSPITAL, MUNICIPALITY, TEMPLATE_COLUMNS, require_columns
from reachgrid.sources.tables import require_file_exists

LINE_NUMBER = "Zeile"


def _read_text_csv(spark: SparkSession, path: str, separator: str) -> DataFrame:
    require_file_exists(spark, path)
    return (
        spark.read.option("header", True)
        .option("sep", separator)
        .option("nullValue", "NA")
        .option("inferSchema", False)
        .option("encoding", "UTF-8")
        .csv(path)
    )


def read_hospital_list(spark: SparkSession, path: str) -> DataFrame:
    """Comma-separated list with a hospital number per row."""
    df = _read_text_csv(spark, path, ",")
    require_columns(df, [HOSPITAL])
    return df


def read_municipality_list(spark: SparkSession, path: str) -> DataFrame:
    """Comma-separated list with a municipality key per row."""
    df = _read_text_csv(spark, path, ",")
    require_columns(df, [MUNICIPALITY])
    return df


def number_lines(df: DataFrame, name: str = LINE_NUMBER) -> DataFrame:
    """Number the rows of a file from 1 on, without gathering them in one task.

    Spark numbers rows within a partition; the rows of the partitions before
    are added. The helper table has one row per partition. The table must be a
    plain file scan, whose partitions are the same each time it is read.
    """
    marked = df.withColumn("_id", F.monotonically_increasing_id())
    marked = marked.withColumn("_part", F.shiftright("_id", 33))
    sizes = marked.groupBy("_part").agg(F.count("*").alias("_rows"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        "_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start")
    )
    in_part = F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))
    return (
        marked.join(starts, "_part", "left")
        .withColumn(name, F.coalesce("_start", F.lit(0)) + in_part + 1)
        .select(name, *df.columns)
    )


def read_template(spark: SparkSession, path: str) -> DataFrame:
    """Semicolon-separated template naming areas on any administrative level."""
    df = _read_text_csv(spark, path, ";")
    if not any(c in df.columns for c in TEMPLATE_COLUMNS):
        raise ValueError(
            "Template CSV must have at least one of the columns: "
            + ", ".join(TEMPLATE_COLUMNS)
        )
    return number_lines(df)
