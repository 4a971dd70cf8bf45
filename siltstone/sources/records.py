"""Metadata records, outcome logs and per-document sidecars."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Pinned, never inferred: a column that is null in a small batch would change its type.
WORKS_SCHEMA = (
    "in_pmc boolean, pmcid string, id string, doi string, title string, year bigint, date date, type string, journal string, source_type string, "
    "publisher string, is_oa boolean, oa_status string, license string, version string, pdf_url string, has_pdf boolean, has_grobid boolean")
PLACE = "struct<display_name: string, type: string, host_organization_name: string>"
RAW_SCHEMA = (
    f"id string, doi string, display_name string, publication_year bigint, publication_date date, type string, primary_location struct<source: {PLACE}>, "
    "best_oa_location struct<license: string, version: string, pdf_url: string>, open_access struct<is_oa: boolean, oa_status: string>, "
    f"has_content struct<pdf: boolean, grobid_xml: boolean>, locations array<struct<id: string, landing_page_url: string, pdf_url: string, source: {PLACE}>>")
OUTCOME = "struct<ingest_status: string, gates_passed: boolean, figures_status: string, escalate_reason: string, mid: string, ts: string>"
OUTCOME_COLUMNS = ["ingest_status", "gates_passed", "figures_status", "escalate_reason", "ingest_mid", "ingest_ts"]


def read_pages(spark: SparkSession, path: str, raw: bool = False) -> DataFrame:
    """JSON pages, each an array of records; columns missing from a page are null."""
    return spark.read.schema(RAW_SCHEMA if raw else WORKS_SCHEMA).option("multiLine", True).json(path)


def flatten(raw: DataFrame) -> DataFrame:
    """Nested records to the 18 columns of works."""
    return raw.select(
        pmc_flag().alias("in_pmc"), pmc_id().alias("pmcid"), F.substring_index("id", "/", -1).alias("id"),
        F.nullif(F.replace(F.coalesce("doi", F.lit("")), F.lit("https://doi.org/"), F.lit("")), F.lit("")).alias("doi"), F.col("display_name").alias("title"),
        F.col("publication_year").alias("year"), F.col("publication_date").alias("date"), "type", F.col("primary_location.source.display_name").alias("journal"),
        F.col("primary_location.source.type").alias("source_type"), F.col("primary_location.source.host_organization_name").alias("publisher"),
        F.col("open_access.is_oa").alias("is_oa"), F.col("open_access.oa_status").alias("oa_status"), F.col("best_oa_location.license").alias("license"),
        F.col("best_oa_location.version").alias("version"), F.col("best_oa_location.pdf_url").alias("pdf_url"),
        F.coalesce("has_content.pdf", F.lit(False)).alias("has_pdf"), F.coalesce("has_content.grobid_xml", F.lit(False)).alias("has_grobid"))


def _pmc_place() -> Column:
    def is_pmc(x: Column) -> Column:
        return F.coalesce(F.contains(F.lower(x["source"]["display_name"]), F.lit("pubmed central")), F.lit(False)) | F.coalesce(F.contains(x["id"], F.lit("pubmedcentral")), F.lit(False))
    return F.get(F.filter("locations", is_pmc), F.lit(0))


def pmc_flag() -> Column:
    return _pmc_place().isNotNull()


def pmc_id() -> Column:
    """The digits of the first central location: from its id, else from its addresses."""
    place, none = _pmc_place(), F.lit("")
    urls = F.concat(F.coalesce(place["landing_page_url"], none), F.lit(" "), F.coalesce(place["pdf_url"], none))
    digits = F.coalesce(F.nullif(F.regexp_extract(F.coalesce(place["id"], none), r"(\d{6,})", 1), none), F.nullif(F.regexp_extract(urls, r"PMC?(\d{6,})", 1), none))
    return F.concat(F.lit("PMC"), digits)


def pin_types(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Casts what may have been inferred wrongly; a value that doesn't fit is null; a missing column is added."""
    for name, kind in types.items():
        value = F.col(name) if name in df.columns else F.lit(None)
        plain = F.when(F.startswith(value.cast("string"), F.lit('"')), F.get_json_object(F.concat(F.lit('{"v":'), value.cast("string"), F.lit("}")), "$.v")).otherwise(value.cast("string"))
        df = df.withColumn(name, plain.try_cast(kind))
    return df


def read_outcomes(spark: SparkSession, path: str) -> DataFrame:
    """The outcome log, one JSON object keyed by work id, as rows."""
    return outcome_rows(spark.read.text(path, wholetext=True))


def outcome_rows(text: DataFrame) -> DataFrame:
    entries = text.select(F.explode(F.from_json("value", f"map<string, {OUTCOME}>")).alias("id", "o"))
    return entries.select("id", "o.ingest_status", "o.gates_passed", "o.figures_status", "o.escalate_reason", F.col("o.mid").alias("ingest_mid"), F.col("o.ts").alias("ingest_ts"))


def read_sidecars(spark: SparkSession, path: str) -> DataFrame:
    """Sidecar files under a folder: path, text, its fields, and ``bad`` where the text isn't JSON."""
    files = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "metadata.json").text(path, wholetext=True)
    return sidecar_fields(files.select(F.col("_metadata.file_path").alias("sidecar_path"), F.col("value").alias("sidecar")))


#: Fields of a sidecar that the tracker has columns of: path and type.
SIDECAR = {"work_id": ("$.identity.work_id", "string"), "n_assets": ("$.assets.count", "int"), "err_count": ("$.gates.errors", "int"), "warn_count": ("$.gates.warnings", "int")}


def sidecar_fields(rows: DataFrame, text: str = "sidecar", more: dict[str, tuple[str, str]] | None = None) -> DataFrame:
    """rows with ``bad`` and the fields of a sidecar, and ``more`` of them by name: path and type. A text is parsed once, to a variant; what is missing, or of another type, is null."""
    parsed = rows.withColumn("_parsed", F.try_parse_json(text))
    fields = {name: F.try_variant_get("_parsed", path, kind) for name, (path, kind) in {**SIDECAR, **(more or {})}.items()}
    return parsed.withColumns({"bad": F.col("_parsed").isNull(), **fields}).drop("_parsed")


def file_inventory(spark: SparkSession, path: str, glob: str) -> DataFrame:
    """Files by pattern, without their content: path, stem, folder, bytes."""
    f = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(path)
    name = F.substring_index("path", "/", -1)
    return f.select("path", F.regexp_replace(name, r"\.[^.]*$", "").alias("stem"), F.element_at(F.split("path", "/"), -2).alias("folder"), F.col("length").alias("bytes"))
