"""What the operators share: the shared scratch folder, shipping code, connected components.

Every cut of lineage here is a Parquet table under the folder that the cluster names in
``spark.checkpoint.dir``; it survives lost executors, and nothing is kept on a machine-local disk.
"""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..shipping import ship

__all__ = ["clean", "components", "far", "forgotten", "near", "parquet", "scratch", "ship", "swept", "without", "written"]

_MADE: list[str] = []
#: Edges that one task joins: some 100 MB there.
ONE_TASK = 1_000_000
#: Bits of a sieve, as a power of two. It has at most 2**20 words of 64 bits, so what is broadcast is bounded.
SIEVE_BITS = 26


def scratch(spark: SparkSession) -> str:
    """A fresh path in the shared folder. Where no folder is named (tests, one machine), one is set."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if spark.sparkContext.master.partition("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="siltstone-")
        spark.sparkContext.setCheckpointDir(base)
    _MADE.append(f"{base.rstrip('/')}/siltstone-{uuid.uuid4().hex}")
    return _MADE[-1]


def clean(spark: SparkSession) -> None:
    """Deletes the tables written so far. Results that were built on them can't be read any more, so this is for the end of a job."""
    while _MADE:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_MADE.pop())
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


@atexit.register
def _at_end() -> None:
    spark = SparkSession.getActiveSession() if _MADE else None
    if spark is not None:
        with contextlib.suppress(Exception):  # the session may be gone already
            clean(spark)


def written(df: DataFrame) -> DataFrame:
    """The rows of df, written once to the shared folder and read from there."""
    spark = df.sparkSession
    path = scratch(spark)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def forgotten(df: DataFrame) -> None:
    """Deletes what ``written`` gave df's rows. Nothing that reads them may come after."""
    spark = df.sparkSession
    for file in df.inputFiles()[:1]:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(file).getParent()
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def swept(df: DataFrame) -> None:
    """Lets executors delete the shuffle files of jobs that are over. Spark does so when the driver collects its garbage, which a large heap puts off."""
    df.sparkSession.sparkContext._jvm.System.gc()


def parquet(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def _sifted(df: DataFrame, of: list[Column], few: DataFrame, keys: list[str], hit: bool) -> DataFrame:
    """The rows of df whose bit is set (or isn't) in a bitmap of the hashed keys of few, which is broadcast."""
    def place(columns: list[Column]) -> Column:
        return F.xxhash64(*columns).bitwiseAND(F.lit((1 << SIEVE_BITS) - 1))

    bit = F.expr("shiftleft(1L, cast(place & 63 as int))")
    words = few.select(place([F.col(k) for k in keys]).alias("place")).groupBy(F.shiftright("place", 6).alias("word")).agg(F.bit_or(bit).alias("bits"))
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), place(of).alias("place"))  # names of df can't clash
    found = rows.join(F.broadcast(words), F.shiftright("place", 6) == F.col("word"), "left").withColumn("hit", F.coalesce(F.col("bits").bitwiseAND(bit) != 0, F.lit(False)))
    return found.where(F.col("hit") if hit else ~F.col("hit")).select("row.*")


def near(df: DataFrame, of: list[Column], few: DataFrame, keys: list[str]) -> DataFrame:
    """The rows of df whose ``of`` may be among the keys of few: all that are, and some others.

    For a join of wide rows with few keys: only these rows have to be moved. A bitmap of a fixed size
    is broadcast; with more than some tens of millions of keys it lets more pass, and then all.
    """
    return _sifted(df, of, few, keys, True)


def far(df: DataFrame, of: list[Column], few: DataFrame, keys: list[str]) -> DataFrame:
    """The rows of df that ``near`` leaves out."""
    return _sifted(df, of, few, keys, False)


def without(df: DataFrame, of: list[Column], gone: DataFrame, keys: list[str]) -> DataFrame:
    """The rows of df whose ``of`` isn't among the keys of gone; nulls are equal. Rows that can't be among them aren't shuffled."""
    maybe = near(df, of, gone, keys)
    maybe = maybe.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), *[c.alias(f"of{i}") for i, c in enumerate(of)])
    names = gone.select(*[F.col(k).alias(f"key{i}") for i, k in enumerate(keys)]).distinct().hint("merge")
    same = [F.col(f"of{i}").eqNullSafe(F.col(f"key{i}")) for i in range(len(of))]
    return far(df, of, gone, keys).unionByName(maybe.join(names, same, "left_anti").select("row.*"))


def _one_task(batches):
    """Components of all edges that come, by union-find."""
    a, b = [], []
    for batch in batches:
        a.append(batch.column(0).to_numpy())
        b.append(batch.column(1).to_numpy())
    nodes, at = np.unique(np.concatenate([*a, *b]) if a else np.zeros(0, np.int64), return_inverse=True)
    parent = list(range(len(nodes)))
    for x, y in zip(at[: len(at) // 2].tolist(), at[len(at) // 2 :].tolist(), strict=True):
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        while parent[y] != y:
            parent[y] = y = parent[parent[y]]
        if x != y:
            parent[max(x, y)] = min(x, y)
    root = np.array(parent, dtype=np.int64)  # a parent is never above its node, so one pass upwards is enough
    for i in range(len(root)):
        root[i] = root[root[i]]
    yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(nodes[root] if len(nodes) else nodes, pa.int64())], names=["node", "component"])


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the smallest node reachable from each node that has an edge.

    Up to ONE_TASK edges, a bound on that task's memory, one executor task joins them. More go
    through alternating large-star and small-star rounds, each written to the shared folder. A star moves
    an edge to the smallest neighbour; minima come from a grouped aggregate, so the neighbours of a
    node are never gathered in one task, and a hot node is joined as a skewed key that adaptive
    execution splits. Null ends and loops are dropped; no edges give no rows.
    """
    e = written(
        edges.select(F.least(a, b).alias("v"), F.greatest(a, b).alias("u"))
        .where("v is not null and u is not null and u <> v").distinct()
    )
    if e.count() <= ONE_TASK:
        return written(e.coalesce(1).mapInArrow(_one_task, "node bigint, component bigint"))
    while True:
        # large star: every neighbour above u is tied to the smallest one of u and its neighbours
        both = e.select(F.col("u").alias("x"), F.col("v").alias("y")).unionByName(
            e.select(F.col("v").alias("x"), F.col("u").alias("y")))
        low = both.groupBy("x").agg(F.min("y").alias("m")).select("x", F.least("x", "m").alias("m"))
        large = both.where("y > x").join(low, "x").select(F.col("y").alias("u"), F.col("m").alias("v")).distinct()
        large = written(large)
        # small star: the lower neighbours of u, and u, are tied to the smallest of them
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = written(
            large.join(low, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"),
                                        F.col("m").alias("v")).distinct())
        # done when no node is at the same time above one node and below another, or above two
        roots = small.select(F.col("v").alias("u")).distinct()
        if small.join(roots, "u", "left_semi").isEmpty() and small.groupBy("u").count().where("count > 1").isEmpty():
            break
        e = small
    return small.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        small.select("v").distinct().select(F.col("v").alias("node"), F.col("v").alias("component")))
