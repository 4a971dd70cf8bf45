"""Samples and plans: balanced, hashed, tiered, budgeted; what is still to be fetched."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

LANE_B_ROUTES = ["gated_commercial", "repository", "convert"]


def balanced(works: DataFrame, per_publisher: int = 3, top: int = 10) -> DataFrame:
    """The first works by id of each of the publishers with most works. Limits are the feature; each is kept per group before the join."""
    counts = works.where("publisher is not null").groupBy("publisher").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "publisher").limit(top)
    place = F.row_number().over(Window.partitionBy("publisher").orderBy("id"))
    return works.join(counts.select("publisher"), "publisher").withColumn("place", place).where(F.col("place") <= per_publisher).orderBy("publisher", "id")


def hashed(works: DataFrame, want: int) -> DataFrame:
    """A sample that repeats: the first by the hash of the id, then by id."""
    return works.withColumn("h", F.md5("id")).orderBy("h", "id").limit(want)


def tiered(candidates: DataFrame, hosted: DataFrame, want: int, prefer_hosted: bool = True) -> DataFrame:
    """candidates (id, publisher) ranked per publisher: those hosted first, then by hash; ``want`` of each publisher."""
    flag = candidates.join(hosted.select("id").distinct().withColumn("is_hosted", F.lit(True)), "id", "left")
    tier = F.when(F.coalesce("is_hosted", F.lit(False)), 1).otherwise(2)
    order = [F.md5("id"), F.col("id")]
    place = F.row_number().over(Window.partitionBy("publisher").orderBy(*([tier] if prefer_hosted else []), *order))
    return flag.select("id", "publisher", tier.alias("tier"), place.alias("place")).where(F.col("place") <= want)


def fetch_plan(tracker: DataFrame, route: str, fetched: DataFrame, limit: int = 3) -> DataFrame:
    """The next works of a route without all their files. ``fetched``: (id, has_xml, has_pdf_file).

    As asked of a route: the first ``limit`` by id, then those among them that are done go. A work of
    a lane that converts is done with both files, others with their XML.
    """
    asked = tracker.where((F.col("route") == route) & F.col("doi").isNotNull())
    if route in LANE_B_ROUTES:
        asked = asked.where("has_grobid")
    first = asked.orderBy("id").limit(limit)
    done = fetched.where("has_xml and has_pdf_file" if route in LANE_B_ROUTES else "has_xml")
    return first.join(done.select("id"), "id", "left_anti")


def within_budget(items: DataFrame, per: int, budget: float) -> DataFrame:
    """items (slug, pos, cost, on_disk): the first ``per`` of each slug while the money lasts, in order of slug and place.

    What is on disk counts to the quota and costs nothing. Spending runs over slugs by a running sum
    of one row per slug, and within a slug over its quota, so no window spans the table.
    """
    place = F.row_number().over(Window.partitionBy("slug").orderBy("pos"))
    quota = items.withColumn("place", place).where(F.col("place") <= per).withColumn("pay", F.when(F.col("on_disk"), 0.0).otherwise(F.col("cost")))
    sums = quota.groupBy("slug").agg(F.sum("pay").alias("s"))
    before = sums.select("slug", F.coalesce(F.sum("s").over(Window.orderBy("slug").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)).alias("before"))
    spent = F.sum("pay").over(Window.partitionBy("slug").orderBy("place").rowsBetween(Window.unboundedPreceding, 0))
    return quota.withColumn("within", spent).join(before, "slug").withColumn("spent", F.col("before") + F.col("within")).where(F.col("spent") <= budget).drop("before", "within")


def year_of(ids: DataFrame, by_year: DataFrame, default: int = 2025) -> DataFrame:
    """The first year whose table holds an id, else the default."""
    first = by_year.groupBy("id").agg(F.min("year").alias("year"))
    return ids.join(first, "id", "left").select("id", F.coalesce("year", F.lit(default)).alias("year"))


def attempts(files: DataFrame, log: DataFrame, limit: int, redo: bool = False, no_retry: bool = False) -> DataFrame:
    """Which of a route's first ``limit`` files are tried; the limit comes before what is skipped."""
    done = [] if redo else ["ingested", "partial"]
    done += ["failed", "escalate"] if no_retry else []
    first = files.orderBy("id").limit(limit).join(log.select("id", "ingest_status"), "id", "left")
    return first.where(~F.coalesce(F.col("ingest_status").isin(done) if done else F.lit(False), F.lit(False)))
