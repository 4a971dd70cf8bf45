"""Sharding by jump consistent hashing, in DataFrame functions only.

A shard is a function of the key and the number of shards: the published jump hash, whose state is
one 64-bit linear congruential generator and no ring table. When a shard is appended, a row either
stays or moves into the new shard. Spark's arithmetic raises on overflow, so the generator's product
modulo 2**64 is made of 16- and 32-bit parts.

Defined cases: a null key goes where the key 0 goes; a null text has no bytes (size 1, crc of
nothing); repeated rows keep a slot each; an empty table gives no rows; other columns are not touched.
"""

from __future__ import annotations

from math import ceil, log

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import parquet, written

# Fixed values of the published jump hash: the generator's multiplier, as 32-bit halves.
MULTIPLIER = 2862933555777941757
A_LOW, A_HIGH = MULTIPLIER & 0xFFFFFFFF, MULTIPLIER >> 32


def _times_plus_one(k: Column) -> Column:
    """(k * MULTIPLIER + 1) modulo 2**64, as a signed 64-bit number."""
    m16, m32 = F.lit(0xFFFF).cast("bigint"), F.lit(0xFFFFFFFF).cast("bigint")
    a_low, a_high = F.lit(A_LOW).cast("bigint"), F.lit(A_HIGH).cast("bigint")
    low, high = k.bitwiseAND(m32), F.shiftrightunsigned(k, 32)
    part0 = low.bitwiseAND(m16) * a_low + F.lit(1).cast("bigint")
    part1 = F.shiftrightunsigned(low, 16) * a_low + F.shiftrightunsigned(part0, 16)
    bottom = F.shiftleft(part1.bitwiseAND(m16), 16).bitwiseOR(part0.bitwiseAND(m16))

    def product(x: Column, a: Column) -> Column:  # modulo 2**32
        return (x.bitwiseAND(m16) * a + F.shiftleft((F.shiftrightunsigned(x, 16) * a).bitwiseAND(m16), 16)).bitwiseAND(m32)

    top = (F.shiftrightunsigned(part1, 16) + product(high, a_low) + product(low, a_high)).bitwiseAND(m32)
    return F.shiftleft(top, 32).bitwiseOR(bottom)


def jump_hash(key: Column, shards: int) -> Column:
    """The shard, from 0, of a 64-bit key.

    The expected number of jumps is the logarithm of the number of shards; the steps provided are
    as many as there are shards, or so many that more would be needed less than once in 10**30
    keys, and a key that needed more would raise an error rather than get a wrong shard.
    """
    if shards < 1:
        raise ValueError("at least one shard")
    steps = min(shards, 120 + ceil(8 * log(shards)))
    zero = F.lit(0).cast("bigint")

    def step(state: Column, _: Column) -> Column:
        k = _times_plus_one(state["k"])
        leap = (state["j"] + 1).cast("double") * (F.lit(float(1 << 31)) / (F.shiftrightunsigned(k, 33) + 1).cast("double"))
        return F.when(state["j"] >= shards, state).otherwise(
            F.struct(k.alias("k"), state["j"].alias("b"), F.least(leap, F.lit(9e15)).cast("bigint").alias("j")))

    start = F.struct(F.coalesce(key.cast("bigint"), zero).alias("k"), zero.alias("b"), zero.alias("j"))
    end = F.aggregate(F.sequence(F.lit(1), F.lit(steps)), start, step)
    # a row leaves the loop with b, its last position before it jumped out
    return F.when(end["j"] >= shards, end["b"]).otherwise(
        F.raise_error(F.lit("jump hash needs more steps")).cast("bigint")).cast("int")


def shard(rows: DataFrame, shards: int, key_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: key, size, text_crc32, law, shard, slot, grown_shard.

    slot numbers the rows of a shard from 0 without gaps. The rows, narrow by then, are written with
    the number of their input split; a shard's rows in one split are numbered by a window, splits
    are set one after another by a running sum over one row per shard and split. No window holds
    more than what one input split holds, whatever keys repeat.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    narrow = written(rows.select(
        F.col(key_col).alias(key_col), (F.octet_length(text) + 1).cast("bigint").alias("size"), F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
        F.spark_partition_id().alias("_split"), F.monotonically_increasing_id().alias("_at"),
    ).withColumns({"shard": jump_hash(F.col(key_col), shards), "grown_shard": jump_hash(F.col(key_col), shards + 1)}))
    before = Window.partitionBy("shard").orderBy("_split").rowsBetween(Window.unboundedPreceding, -1)
    starts = narrow.groupBy("shard", "_split").agg(F.count(F.lit(1)).alias("_n")).select(
        "shard", "_split", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    within = F.row_number().over(Window.partitionBy("shard", "_split").orderBy("_at")) - 1
    return narrow.withColumn("_within", within).join(starts, ["shard", "_split"]).select(
        key_col, "size", "text_crc32", F.lit("key").alias("law"), "shard",
        (F.col("_start") + F.col("_within")).alias("slot"), "grown_shard")


def op7_jump_shards(spark, sf_dir: str) -> DataFrame:
    return shard(parquet(spark, sf_dir, "documents"), shards=8)


#: Slots are those of one file that is ordered by its ids, as it is read in one split. The checksum goes over the bits of a text, with a fixed value for its polynomial.
OP7_SQL = """
with recursive d as (select doc_id, encode(coalesce(text, '')) as b from documents),
n as (select unnest([8, 9]) as shards),
j as (
  select doc_id, shards, cast(doc_id as uhugeint) as k, cast(-1 as bigint) as b, cast(0 as bigint) as j from documents, n
  union all
  select doc_id, shards, k2, j, cast(floor((j + 1) * (2147483648.0 / cast(k2 // 8589934592 + 1 as double))) as bigint)
  from (select *, (k * 2862933555777941757 + 1) % 18446744073709551616 as k2 from j where j < shards)
), s as (select doc_id, max(b) filter (where shards = 8 and j >= 8) as shard, max(b) filter (where shards = 9 and j >= 9) as grown from j group by doc_id),
h as (select doc_id, octet_length(b) as n, hex(b) as x from d),
v as (select doc_id, n, list_transform(regexp_extract_all(x, '..'), lambda y: cast('0x' || y as bigint)) as bytes from h),
w as (select doc_id, n, list_prepend(4294967295, flatten(list_transform(bytes, lambda y: [y & 1, (y >> 1) & 1, (y >> 2) & 1, (y >> 3) & 1, (y >> 4) & 1, (y >> 5) & 1, (y >> 6) & 1, (y >> 7) & 1]))) as bits from v),
c as (select doc_id, n, xor(list_reduce(bits, lambda a, y: xor(a >> 1, case when xor(a & 1, y) = 1 then 3988292384 else 0 end)), 4294967295) as crc from w)
select doc_id, cast(n + 1 as bigint) as size, cast(crc as bigint) as text_crc32, 'key' as law, cast(shard as integer) as shard, row_number() over (partition by shard order by doc_id) - 1 as slot, cast(grown as integer) as grown_shard
from c join s using (doc_id)
"""
