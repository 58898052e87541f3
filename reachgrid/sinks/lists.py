"""CSV output of cleaned lists."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_list(df: DataFrame, path: str) -> None:
    """Comma-separated files with a header; missing values are ``NA``.

    The folder holds one file per partition and reads back as one list.
    """
    df.write.mode("overwrite").option("header", True).option("nullValue", "NA").csv(path)
