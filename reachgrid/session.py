"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession

import reachgrid

# Runtime SQL settings the plans rely on. Joins are left to the planner, which
# broadcasts by measured size only; the skew settings let it split a hot key
# even where the split costs one more exchange.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
    "spark.sql.session.timeZone": "UTC",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the settings, and send the package along with its Python functions
    so that executors need no installation of it."""
    cloudpickle.register_pickle_by_value(reachgrid)
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def scratch(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder the cluster names for checkpoints.

    Only where no folder is configured, as in local tests, is one made here.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder")
        root = tempfile.mkdtemp(prefix="reachgrid-")
        spark.sparkContext.setCheckpointDir(root)
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """The table written to the shared scratch folder and read back.

    For results that a later step reads more than once: the plan behind them
    runs a single time, and a lost executor does not run it again.
    """
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
