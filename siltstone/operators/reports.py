"""Counts, shares, scorecards, distributions. Reports are frames; order is part of each, with the key as tiebreak."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .order import select_ranks


def lane_share(tracker: DataFrame) -> DataFrame:
    n = tracker.groupBy("lane").agg(F.count(F.lit(1)).alias("n"))
    share = F.round(100.0 * F.col("n").cast("double") / F.sum("n").over(Window.partitionBy()).cast("double"), 1)
    return n.select("lane", "n", share.alias("pct")).orderBy(F.desc("n"), "lane")


def counts_by(tracker: DataFrame, column: str, missing: str | None = None, limit: int | None = None) -> DataFrame:
    key = F.coalesce(F.col(column), F.lit(missing)) if missing else F.col(column)
    out = tracker.groupBy(key.alias(column)).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), column)
    return out.limit(limit) if limit else out


def routes(tracker: DataFrame) -> DataFrame:
    """route_access depends on route, so any value of a group is the value."""
    return tracker.groupBy("route").agg(F.any_value("route_access").alias("route_access"), F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "route")


def access(tracker: DataFrame) -> DataFrame:
    return counts_by(tracker.where("license = 'cc-by'"), "route_access")


def publishers(tracker: DataFrame, limit: int = 20) -> DataFrame:
    key = F.coalesce("publisher", F.lit("(none)")).alias("publisher")
    return tracker.groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.count_if("has_grobid").alias("with_tei")).orderBy(F.desc("n"), "publisher").limit(limit)


def landscape(works: DataFrame) -> DataFrame:
    """The six probes in one pass."""
    by = F.col("license") == "cc-by"
    return works.agg(F.count(F.lit(1)).alias("works"), F.count_if("is_oa").alias("oa"), F.count_if(by).alias("cc_by"), F.count_if(by & (F.col("version") == "publishedVersion")).alias("vor"),
                     F.count_if(by & F.col("has_grobid")).alias("with_tei"), F.count_if(by & F.col("has_pdf")).alias("with_pdf"))


def facets(works: DataFrame, top: int = 10) -> DataFrame:
    """Top values of journal, version, licence and year: one scan by grouping sets, the first ten of each facet."""
    spark = works.sparkSession
    n = spark.sql("""
        select case grouping_id(journal, version, license, year) when 7 then 'journal' when 11 then 'version' when 13 then 'license' else 'year' end as facet,
               coalesce(journal, version, license, cast(year as string), '(none)') as value, count(*) as n
        from {w} group by grouping sets ((journal), (version), (license), (year))""", w=works.where("is_oa"))
    place = F.row_number().over(Window.partitionBy("facet").orderBy(F.desc("n"), "value"))
    return n.withColumn("place", place).where(F.col("place") <= top)


def scorecard(attempts: DataFrame) -> DataFrame:
    return attempts.agg(F.count(F.lit(1)).alias("attempted"), F.count_if(F.col("validate") & F.col("lint")).alias("full_pass"), F.count_if(~F.col("validate")).alias("validate_failed"),
                        F.count_if(~F.col("lint")).alias("lint_failed"), F.coalesce(F.sum("figures"), F.lit(0)).cast("bigint").alias("figures"))


def status_tally(attempts: DataFrame, statuses: list[str], keep_zero: bool = False, column: str = "status") -> DataFrame:
    """Counts in a fixed order of values; ``keep_zero`` keeps values without rows."""
    order = attempts.sparkSession.createDataFrame(list(enumerate(statuses)), "place int, value string")
    n = attempts.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    return order.join(n, "value", "left" if keep_zero else "inner").select("place", "value", F.coalesce("n", F.lit(0).cast("bigint")).alias("n")).orderBy("place")


def publisher_stats(results: DataFrame) -> DataFrame:
    """Per publisher: documents, passes, errors and warnings; negative counts are nothing."""
    sure = lambda c: F.sum(F.greatest(F.col(c), F.lit(0))).cast("bigint")
    return results.groupBy("slug").agg(F.count(F.lit(1)).alias("n"), F.count_if("validate").alias("validate_pass"), F.count_if("lint").alias("lint_pass"), sure("errors").alias("errors"), sure("warnings").alias("warnings"))


def kinds(findings: DataFrame, kind: Column, limit: int = 12) -> DataFrame:
    return findings.groupBy(kind.alias("kind")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "kind").limit(limit)


def low_tail(values: Column) -> Column:
    """The calibration's 5th percentile of a sorted array: below 20 values the least, else the one at place n/20 (from 1)."""
    n = F.size(values)
    return F.when(n == 0, F.lit(None)).otherwise(F.get(values, F.when(n >= 20, F.greatest(F.floor(n * 0.05).cast("int") - 1, F.lit(0))).otherwise(0)))


def low_rank(n: Column) -> Column:
    """The rank of ``low_tail``."""
    return F.when(n >= 20, F.greatest(F.floor(n * 0.05), F.lit(1))).otherwise(1)


#: The ranks that the median is between.
MIDDLE = {"lower": lambda n: F.floor((n + 1) / 2), "upper": lambda n: F.floor(n / 2) + 1}


def middle() -> Column:
    return F.col("lower") * 0.5 + F.col("upper") * 0.5


def distribution(rows: DataFrame, by: str, metrics: list[str]) -> DataFrame:
    """n, min, low tail, median and max of each metric by group, in one pass over the rows.

    Equal values are combined, and ranks are found by ranges (``order``), so no group is sorted whole and dear metrics are computed once.
    """
    long = rows.select(by, F.explode(F.map_from_arrays(F.array(*[F.lit(m) for m in metrics]), F.array(*[F.col(m).cast("double") for m in metrics]))).alias("metric", "v"))
    ranks = {"p5": low_rank, **MIDDLE}
    return select_ranks(long, [by, "metric"], "v", ranks).select(by, "metric", "n", "least", "p5", middle().alias("median"), "most")


def calibration(verdicts: DataFrame, by: str, metrics: list[str]) -> DataFrame:
    return distribution(verdicts.select(by, *metrics), by, metrics)
