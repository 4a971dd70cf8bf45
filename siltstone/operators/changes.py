"""What changed between two tables, and judging again only that.

Rows are dealt into buckets by a hash of their key, and a bucket has a digest that doesn't depend on order: its count, and sums and an exclusive or
of its rows' hashes. Digests are aggregated where the rows are read, so comparing equal tables moves a row for each task and bucket; only rows of
buckets whose digests differ are moved and compared, as themselves. A digest that is equal by chance needs 128 bits of hash to agree.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..scratch import scratch

BUCKETS = 1024
#: Buckets of a stored table: each is a folder of files, so they should hold some MB each.
STORED = 256
HALF = 0xFFFFFFFF


def bucket_of(keys: list[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*[F.col(f"`{k}`") for k in keys]), F.lit(buckets)).cast("int")


def digests(df: DataFrame, keys: list[str], columns: list[str], buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n, x, low, high): at most ``buckets`` rows. Sums are of 32-bit halves of a second hash, so they don't overflow, and repeated rows count."""
    cells = [F.col(f"`{c}`") for c in columns]
    rows = df.select(bucket_of(keys, buckets).alias("bucket"), F.xxhash64(*cells).alias("h"), F.xxhash64(F.lit(columns[0]), *cells).alias("k"))
    return rows.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("n"), F.bit_xor("h").alias("x"), F.sum(F.col("k").bitwiseAND(F.lit(HALF))).alias("low"), F.sum(F.shiftrightunsigned("k", 32)).alias("high"))


def differing(a: DataFrame, b: DataFrame, keys: list[str], columns: list[str], buckets: int = BUCKETS) -> list[int]:
    """The buckets whose digests differ: a list of at most ``buckets`` numbers."""
    x, y = (digests(df, keys, columns, buckets).select("bucket", F.struct("n", "x", "low", "high").alias(name)) for df, name in ((a, "a"), (b, "b")))
    return sorted(r.bucket for r in x.join(y, "bucket", "full").where(~F.col("a").eqNullSafe(F.col("b"))).select("bucket").collect())


def _of(df: DataFrame, keys: list[str], found: list[int], buckets: int) -> DataFrame:
    return df.where(bucket_of(keys, buckets).isin(found) if found else F.lit(False))


def changed_rows(a: DataFrame, b: DataFrame, keys: list[str], buckets: int = BUCKETS) -> DataFrame:
    """a's columns, ``side`` (a or b) and ``times``: rows that one side has more often, and how many times more. What two ``exceptAll`` give, but of differing buckets alone."""
    columns = a.columns
    found = differing(a, b, keys, columns, buckets)
    both = _of(a, keys, found, buckets).withColumn("_side", F.lit(1)).unionByName(_of(b.select(*columns), keys, found, buckets).withColumn("_side", F.lit(-1)))
    n = both.groupBy(*columns).agg(F.sum("_side").alias("_n")).where("_n <> 0")
    return n.select(*columns, F.when(F.col("_n") > 0, "a").otherwise("b").alias("side"), F.abs("_n").alias("times"))


def differences(a: DataFrame, b: DataFrame, key: str, columns: list[str], buckets: int = BUCKETS) -> DataFrame:
    """How many rows differ in each column, and how many keys are on one side alone; a key is there once on a side."""
    found = differing(a.select(key, *columns), b.select(key, *columns), [key], [key, *columns], buckets)
    x = _of(a, [key], found, buckets).select(key, *[F.col(c).alias(f"a_{c}") for c in columns], F.lit(True).alias("in_a"))
    y = _of(b, [key], found, buckets).select(key, *[F.col(c).alias(f"b_{c}") for c in columns], F.lit(True).alias("in_b"))
    both = F.col("in_a") & F.col("in_b")
    return x.join(y, key, "full").agg(*[F.count_if(both & ~F.col(f"a_{c}").eqNullSafe(F.col(f"b_{c}"))).alias(c) for c in columns], F.count_if(~F.coalesce(both, F.lit(False))).alias("unpaired"))


# --- judging again what changed


def mark_of(content: Column | str, versions: dict[str, str | int]) -> Column:
    """The fingerprint of an input: of its content and of the versions of what judges it, so a new version makes all inputs change."""
    stamp = ",".join(f"{k}={v}" for k, v in sorted(versions.items()))
    text = F.col(content) if isinstance(content, str) else content
    return F.substring(F.sha2(F.concat(F.lit(stamp + "\n"), F.coalesce(F.sha2(text, 256), F.lit("missing"))), 256), 1, 16)


#: Bits of the sieve of ids, as a power of two: it has at most 2**18 words of 64, which are broadcast.
SIEVE_BITS = 24


def _sifted(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows whose id is among ids, and few others where ids are few: rows may be wide, and so only these are moved."""
    place = F.xxhash64("id").bitwiseAND(F.lit((1 << SIEVE_BITS) - 1))
    bit = F.expr("shiftleft(1L, cast(_place & 63 as int))")
    words = ids.select(place.alias("_place")).groupBy(F.shiftright("_place", 6).alias("_word")).agg(F.bit_or(bit).alias("_bits"))
    met = rows.withColumn("_place", place).join(F.broadcast(words), F.shiftright("_place", 6) == F.col("_word"))
    return met.where(F.col("_bits").bitwiseAND(bit) != 0).drop("_place", "_word", "_bits")


def _there(spark: SparkSession, path: str):
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs if fs.exists(at) else None


def rejudge(inputs: DataFrame, judge: Callable[[DataFrame], DataFrame], path: str, buckets: int = STORED) -> dict[str, int]:
    """Brings the table of judgements at ``path`` up to date with inputs (id, mark, ...): how many were judged, taken out, and how many buckets were written.

    judge gives (id, ...) for rows of inputs. The table has these columns, mark and the bucket, which is its partition. Ids are unique and not null. Only inputs
    that are new, or whose mark is another, are judged; only buckets that change are written, each whole. A bucket is replaced as one, and what a lost run
    didn't get to still differs, so the next run does it.
    """
    spark = inputs.sparkSession
    fs = _there(spark, path)
    now = inputs.select("id", "mark")
    schema = judge(inputs.limit(0)).schema
    kind = inputs.schema["id"].dataType.simpleString()
    if fs:
        kept = spark.read.schema(f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in schema)}, mark string, bucket int").parquet(path)
    else:
        kept = spark.createDataFrame([], schema).withColumns({"mark": F.lit(None).cast("string"), "bucket": F.lit(None).cast("int")})
    found = differing(now, kept.select("id", "mark"), ["id"], ["id", "mark"], buckets)
    if not found:
        return {"judged": 0, "gone": 0, "written": 0}
    some = _of(now, ["id"], found, buckets)
    old = kept.where(F.col("bucket").isin(found)).select("id", F.col("mark").alias("was"))  # prunes partitions
    pairs = some.join(old, "id", "full").where(~F.col("mark").eqNullSafe(F.col("was")))
    staged = scratch(spark)
    changes = f"{staged}/changes"
    pairs.select(F.col("id").cast(kind), F.col("mark").isNotNull().alias("here")).write.parquet(changes)
    changed = spark.read.parquet(changes)
    ids = changed.where("here").select("id")
    fresh = judge(_sifted(inputs, ids).join(ids.hint("merge"), "id", "left_semi") if fs else inputs)
    fresh = fresh.join(some, "id").withColumn("bucket", bucket_of(["id"], buckets))
    rest = kept.where(F.col("bucket").isin(found)).join(changed.select("id"), "id", "left_anti")
    columns = [*schema.fieldNames(), "mark", "bucket"]
    fresh.select(*columns).unionByName(rest.select(*columns)).repartition("bucket").write.partitionBy("bucket").parquet(f"{staged}/rows")
    rows = spark.read.schema(kept.schema).parquet(f"{staged}/rows")
    rows.repartition("bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(path)
    # a bucket that has no row any more isn't overwritten by the rows written
    left = {r.bucket for r in rows.select("bucket").distinct().collect()}
    fs, to = _there(spark, path), spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    for b in found:
        if fs and b not in left:
            fs.delete(to(f"{path}/bucket={b}"), True)
    tally = {r.here: r["count"] for r in changed.groupBy("here").count().collect()}
    _there(spark, staged).delete(to(staged), True)
    return {"judged": tally.get(True, 0), "gone": tally.get(False, 0), "written": len(found)}


def judged(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).drop("bucket")
