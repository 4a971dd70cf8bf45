"""Pilots and calibrations: manifests met with works, files and reports; findings by publisher."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import message_kind
from .order import select_ranks
from .reports import MIDDLE, middle, publisher_stats
from .tracker import pilot_numbers

#: What a metadata page and a document cost.
PAGE_COST, CONTENT_COST = 0.0001, 0.01
WRITTEN = ["article", "tei"]


def described(manifest: DataFrame, works: DataFrame) -> DataFrame:
    """manifest (id, publisher, ...) with publisher, journal and title of the work; an id that isn't there keeps the manifest's publisher, and only it."""
    known = works.select("id", F.struct("publisher", "journal", "title").alias("_work"))
    joined = manifest.join(known, "id", "left")
    met = F.col("_work").isNotNull()
    return joined.select(*[c for c in manifest.columns if c not in ("publisher", "journal", "title")],
                         F.when(met, F.col("_work.publisher")).otherwise(F.col("publisher")).alias("publisher"), F.col("_work.journal").alias("journal"), F.col("_work.title").alias("title"))


def measurable(report: DataFrame, manifest: DataFrame, files: DataFrame) -> DataFrame:
    """report rows (id, slug, mid, lint_pass) whose manifest entry (id, path), source text and article all exist.

    files (path): an inventory. The source text lies beside the file as ``slug/id.grobid.xml``, the article
    under ``mid/article.xml``; both are met by their last two parts. Repeated manifest ids: the last path counts.
    """
    tail = F.substring_index("path", "/", -2)
    entries = manifest.groupBy("id").agg(F.max("path").alias("path"))
    there = files.select(tail.alias("_tail")).distinct()
    rows = report.join(entries, "id").withColumns({"_pdf": tail, "_tei": F.concat("slug", F.lit("/"), "id", F.lit(".grobid.xml")), "_article": F.concat("mid", F.lit("/article.xml"))})
    for name in ("_pdf", "_tei", "_article"):
        rows = rows.join(there.select(F.col("_tail").alias(name)), name, "left_semi")
    return rows.select("id", "slug", "mid", "lint_pass", "path")


def completeness_by(rows: DataFrame, by: str = "slug") -> DataFrame:
    """n, median and least completeness of what the lint passes."""
    passed = rows.where("lint_pass")
    found = select_ranks(passed.select(by, F.col("completeness").cast("double").alias("v")), [by], "v", MIDDLE)
    n = passed.groupBy(by).agg(F.count(F.lit(1)).alias("n"))  # those without a completeness too
    return n.alias("a").join(found.alias("b"), F.col(f"a.{by}").eqNullSafe(F.col(f"b.{by}")), "left").select(f"a.{by}", "a.n", middle().alias("median"), "b.least")


def kinds_by(findings: DataFrame, by: str, message: Column, top: int = 8) -> DataFrame:
    """The commonest kinds of finding of each group."""
    n = findings.groupBy(by, message_kind(message).alias("kind")).agg(F.count(F.lit(1)).alias("n"))
    place = F.row_number().over(Window.partitionBy(by).orderBy(F.desc("n"), "kind"))
    return n.withColumn("place", place).where(F.col("place") <= top)


def pilot(manifest: DataFrame, works: DataFrame, verdicts: DataFrame, findings: DataFrame) -> dict[str, DataFrame]:
    """A pilot end to end, lazily: its numbered rows, statistics by publisher, and the kinds of finding.

    manifest (id, slug, publisher), verdicts (id, validate, lint, errors, warnings), findings (id, message).
    Rows without a verdict are failures of conversion: they count as documents, with no errors of their own.
    """
    rows = described(manifest, works).join(pilot_numbers(manifest.select("id", "slug")).select("id", "mid"), "id")
    no = F.lit(False)
    results = rows.join(verdicts, "id", "left").withColumns({"validate": F.coalesce("validate", no), "lint": F.coalesce("lint", no), "errors": F.coalesce("errors", F.lit(-1)), "warnings": F.coalesce("warnings", F.lit(-1))})
    said = findings.join(manifest.select("id", "slug"), "id")
    return {"results": results, "publishers": publisher_stats(results), "kinds": kinds_by(said, "slug", F.col("message"))}


def footprint(files: DataFrame, by: str = "folder") -> DataFrame:
    """Files and bytes by folder."""
    return files.groupBy(by).agg(F.count(F.lit(1)).alias("files"), F.sum("bytes").alias("bytes"))


def costs(pages: Column, documents: Column) -> Column:
    """What it costs to ask for so many pages of metadata and so many documents."""
    return pages * PAGE_COST + documents * CONTENT_COST
