"""The tracker as a table that is bucketed and sorted by id, so what is overlaid on it comes to it.

An overlay joins the tracker with far fewer rows: outcomes and sidecars of a day. Where the tracker is bucketed by the key, only these are shuffled, to its buckets; its own rows
are merged where they are read, and the result has the same buckets, so writing the next version doesn't shuffle it either.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.records import OUTCOME_COLUMNS
from .tracker import SIDE_TYPES, latest, overlay, sidecar_rows

BUCKETS = 64


def keep(tracker: DataFrame, name: str, buckets: int = BUCKETS, path: str | None = None, key: str = "id") -> DataFrame:
    """Writes the tracker as the bucketed table ``name`` (at ``path`` if one is given), replaced whole."""
    there = tracker if _bucketed(tracker, buckets, key) else tracker.repartition(buckets, key)
    writer = there.sortWithinPartitions(key).write.bucketBy(buckets, key).sortBy(key).mode("overwrite")
    (writer.option("path", path) if path else writer).saveAsTable(name)
    return tracker.sparkSession.table(name)


def _bucketed(df: DataFrame, buckets: int, key: str) -> bool:
    """Whether rows already lie by this key in so many partitions, as the physical plan has it."""
    said = df._jdf.queryExecution().executedPlan().outputPartitioning().toString()
    return said.startswith(f"hashpartitioning({key}#") and said.endswith(f", {buckets})")


def buckets_of(spark: SparkSession, name: str) -> int:
    rows = {r.col_name: r.data_type for r in spark.sql(f"describe table extended {name}").collect()}
    return int(rows["Num Buckets"])


def overlaid(spark: SparkSession, name: str, outcomes: DataFrame | None = None, sidecars: DataFrame | None = None) -> DataFrame:
    """The kept tracker with new outcomes and sidecars on it, as ``tracker.build`` overlays them; the table itself isn't changed."""
    buckets, out = buckets_of(spark, name), spark.table(name)
    if outcomes is not None:
        # dealt to the buckets first: the latest of each key is then found there
        out = overlay(out, latest(outcomes.repartition(buckets, "id"), ["id"], ["ingest_ts", "ingest_status"]).hint("merge"), "id", OUTCOME_COLUMNS)
    if sidecars is not None:
        for column, kind in SIDE_TYPES.items():
            out = out if column in out.columns else out.withColumn(column, F.lit(None).cast(kind))
        out = overlay(out, latest(sidecar_rows(sidecars).repartition(buckets, "id"), ["id"], ["sidecar_path"]).hint("merge"), "id", list(SIDE_TYPES))
    return out
