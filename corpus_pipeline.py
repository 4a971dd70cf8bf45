"""A corpus pipeline: toxicity, exact dedup, near dedup, mixing, packing.

Each stage works on all that the one before kept. Decisions are made on narrow rows and name a document
by its id and a hash of its text, so rows that repeat an id with other texts are decided apart, and rows
that repeat both stay or go together. Of the texts, a decision moves only those that a sieve of what
goes can't clear (see ``without``); the others are filtered where they are read. A null id is a name like
any other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.llm.common import parquet, without, written
from siltstone.llm.exact_dedup import exact_dedup
from siltstone.llm.minhash_dedup import near_duplicates
from siltstone.llm.mixing import mixed_documents
from siltstone.llm.packing import pack, vocabulary
from siltstone.llm.toxicity import fit, without_toxic


def _without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """The documents but those named by (doc_id, mark) in gone."""
    return without(docs, [F.col("doc_id"), F.xxhash64("text")], written(gone.select("doc_id", "mark")), ["doc_id", "mark"])


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_toxic(docs, fit(docs, parquet(spark, sf_dir, "labels")))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _without(docs, exact_dedup(docs, mark=F.xxhash64("text")).where("not kept"))


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _without(docs, near_duplicates(docs, width=5, percent=80, mark=F.xxhash64("text")).where("not kept"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _without(docs, mixed_documents(spark, docs, sf_dir, mark=F.xxhash64("text")).where("not sampled").withColumnRenamed("id", "doc_id"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    pieces = pack(docs, vocabulary())
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


STAGES = [("toxicity", toxicity), ("exact_dedup", exact), ("near_dedup", near), ("mixing", mixing), ("packing", packing)]
#: No stage but exact dedup can be said in SQL; tests hold the whole against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = parquet(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = written(docs)
    return docs
