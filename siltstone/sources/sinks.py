"""Writing: pages by year, manifests, house XML files, staged folders. Commits are Spark's.

The outcome log is the only truth; the tracker is a view built from it, so nothing is written twice and a
second write can't be missed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.tracker import latest, published
from .packages import write_packages


def write_pages(works: DataFrame, path: str, year: str = "year") -> None:
    """Works by year; the years in ``works`` are replaced whole, others stay."""
    works.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(year).parquet(path)


def append_manifest(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").json(path)


def upsert_manifest(rows: DataFrame, old: str, new: str, key: str = "id") -> None:
    """The manifest at ``old`` with these rows' versions of their keys, written to ``new``; the old one isn't touched."""
    spark = rows.sparkSession
    before = spark.read.schema(rows.schema).parquet(old).withColumn("_turn", F.lit(0))
    both = before.unionByName(rows.withColumn("_turn", F.lit(1)))
    latest(both, [key], ["_turn"]).drop("_turn").write.parquet(new)


def write_articles(articles: DataFrame, path: str, parts: int | None = None) -> None:
    """One line of JSON per article, id and text, in compressed files of bounded number: millions of small files would burden a store."""
    rows = articles.where("article is not null").select("id", "article")
    (rows.repartition(parts) if parts else rows).write.mode("overwrite").option("compression", "gzip").json(path)


def write_article_files(articles: DataFrame, path: str) -> None:
    """One XML file per article, named by its id, all committed as one; for deliveries, not for stores of millions."""
    rows = articles.where("article is not null")
    write_packages(rows.select(F.lit(None).alias("package"), F.concat("id", F.lit(".xml")).alias("file"), F.encode("article", "UTF-8").alias("content")), path)


def save_table(df: DataFrame, name: str) -> DataFrame:
    """df as a table of the catalogue, replaced whole."""
    df.write.mode("overwrite").saveAsTable(name)
    return df.sparkSession.table(name)


def publish_view(tracker: DataFrame, name: str = "ccby_vor") -> DataFrame:
    """The view of openly licensed published versions under a name that SQL can use."""
    published(tracker).createOrReplaceTempView(name)
    return tracker.sparkSession.table(name)


def write_report(rows: DataFrame, path: str) -> None:
    """A report, one JSON document a row, in one file: reports are small by what they are."""
    rows.coalesce(1).write.mode("overwrite").json(path)


def promote(spark: SparkSession, staged: str, final: str) -> None:
    """A folder that was written in full takes the place of another; the old one stays until then."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = path(final).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    old = path(final + ".old")
    if fs.exists(path(final)):
        fs.delete(old, True)
        fs.rename(path(final), old)
    if not fs.rename(path(staged), path(final)):
        fs.rename(old, path(final))
        raise OSError(f"{staged} could not be moved to {final}")
    fs.delete(old, True)
