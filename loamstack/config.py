"""Session settings and the shared folder in which lineage is cut."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    """Set the engine's session defaults (all of them may be changed at run time)."""
    for k, v in DEFAULTS.items():
        spark.conf.set(k, v)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; only where none is set (tests, local runs) is a temporary one made.

    On a cluster (any master but local[...]) a missing setting is an error: a machine-local folder would be lost
    with its executor.
    """
    sc = spark.sparkContext
    at = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not at:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        at = tempfile.mkdtemp(prefix="loamstack-checkpoint-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(at)
    return at


def cut(df: DataFrame) -> DataFrame:
    """Materialise `df` in the shared folder: later uses read it instead of computing it again."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def spread(df: DataFrame) -> DataFrame:
    """`df` in as many partitions as there are cores if it is read in fewer, as a small table of one file is; larger ones stay as they are.

    For work that is dear by the row. Only a table of fewer splits than cores is ever moved, so what is moved is bounded.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
