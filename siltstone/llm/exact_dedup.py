"""Exact deduplication by progressive refinement: length, then prefix hash, then full hash.

Only DataFrame functions. Rows that share no length with another row leave after the first level;
of the rest, those that share no prefix hash leave after the second; only what is left is grouped
by full hash. Each level counts with map-side aggregates and takes the rows on by a semi join, so a
group that holds a third of all rows is a skewed join key, which adaptive execution splits, and
never one task's state. Only narrow rows (ids, lengths, hashes) move, never texts.

Defined cases: a null text counts as empty; empty texts are equal to one another; a null id is kept
as a row and never stays before a row with an id; rows that repeat an id and its text stay or go
together, as one document; an empty table gives an empty result; other columns of the input are not
touched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import far, near, parquet, written

SPACES = "[\\x20\\x09-\\x0D]+"
PREFIX_CHARS = 256


def normalised(text: Column) -> Column:
    """Each run of ASCII white space as one space; null as the empty text."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACES, " ")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hash_all: bool = False, mark: Column | None = None) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256, and ``mark`` if one is given.

    keep_id is the smallest id among the rows whose normalised texts are equal. With ``hash_all``
    false, the full content is hashed in a second scan for survivors of the first two levels alone
    (by a sieve of their ids, so no text is moved), and text_sha256 is null for the others; true
    hashes every row in the first scan, for callers that want the digest of each row, and the
    levels then choose which rows are grouped by it. ``mark`` tells rows of one id apart.
    """
    marks = [] if mark is None else [mark.alias("mark")]
    source = docs.select(F.col(id_col).alias("id"), normalised(F.col(text_col)).alias("t"), *marks)
    marks = ["mark"] if marks else []
    level0 = written(source.select(
        "id", *marks, F.octet_length("t").alias("size"), F.xxhash64(F.octet_length("t"), F.substring("t", 1, PREFIX_CHARS)).alias("head"),
        *([F.unhex(F.sha2("t", 256)).alias("full")] if hash_all else [])))

    lengths = level0.groupBy("size").count().where("count > 1").select("size")
    level1 = level0.join(lengths, "size", "left_semi")
    heads = level1.groupBy("head").count().where("count > 1").select("head")
    level2 = level1.join(heads, "head", "left_semi")
    alone = None
    if hash_all:
        rows, grouped = level0.select("id", *marks, "full"), level2
    else:
        ids = written(level2.select("id").distinct())
        found = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t"), *([mark.alias("mark")] if marks else []))
        rows = grouped = written(near(found, [F.col("id")], ids, ["id"]).select("id", *marks, F.unhex(F.sha2(normalised(F.col("t")), 256)).alias("full")))
        alone = far(level0, [F.col("id")], ids, ["id"]).select("id", *marks, F.lit(None).cast("binary").alias("full"), F.col("id").alias("keep_id"), F.lit(1).cast("bigint").alias("n"))
    groups = grouped.groupBy("full").agg(F.min("id").alias("keep_id"), F.count(F.lit(1)).alias("n")).where("n > 1")
    got = rows.join(groups, "full", "left").select("id", *marks, "full", F.coalesce("keep_id", "id").alias("keep_id"), F.coalesce("n", F.lit(1).cast("bigint")).alias("n"))
    got = got if alone is None else got.unionByName(alone)
    return got.select(F.col("id").alias(id_col), "keep_id", F.col("n").alias("group_size"), F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"), F.lower(F.hex("full")).alias("text_sha256"), *marks)


def op9_exact_dedup(spark, sf_dir: str) -> DataFrame:
    return exact_dedup(parquet(spark, sf_dir, "documents"), hash_all=True)


OP9_SQL = r"""
with d as (
  select doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') as t from documents
), h as (select doc_id, sha256(t) as text_sha256 from d)
select doc_id, min(doc_id) over w as keep_id, count(*) over w as group_size,
       doc_id = min(doc_id) over w as kept, text_sha256
from h window w as (partition by text_sha256)
"""
