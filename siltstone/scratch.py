"""A fresh path in the folder that all executors share."""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_KEPT: list[str] = []


def scratch(spark: SparkSession) -> str:
    """Under the folder that ``spark.checkpoint.dir`` names. Where none is named, on one machine, one is made."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if spark.sparkContext.master.partition("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="siltstone-")
        spark.sparkContext.setCheckpointDir(base)
    return f"{base.rstrip('/')}/siltstone-{uuid.uuid4().hex}"


def once(df: DataFrame) -> DataFrame:
    """The rows of df, made once, written to the shared folder and read from there; deleted when the driver ends."""
    spark = df.sparkSession
    _KEPT.append(scratch(spark))
    df.write.parquet(_KEPT[-1])
    return spark.read.schema(df.schema).parquet(_KEPT[-1])


@atexit.register
def _at_end() -> None:
    spark = SparkSession.getActiveSession() if _KEPT else None
    if spark is not None:
        with contextlib.suppress(Exception):  # the session may be gone already
            for kept in _KEPT:
                path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(kept)
                path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
