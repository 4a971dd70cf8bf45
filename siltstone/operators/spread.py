"""Using all cores on a small input."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..shipping import ship

#: Input per core up to which rows are dealt anew. Above it, files have row groups enough for every core, and texts aren't moved.
SMALL_BYTES = 32 << 20


def spread(df: DataFrame) -> DataFrame:
    """df over all cores where its input is small: a file of one row group is one task however it is split.

    For operators that spend much more on a row than moving it costs. The size is the optimiser's
    estimate from file sizes, so nothing is read to decide.
    """
    ship(df.sparkSession)  # what follows runs Python
    cores = df.sparkSession.sparkContext.defaultParallelism
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return df.repartition(cores) if size <= SMALL_BYTES * cores else df
