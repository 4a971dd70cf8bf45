"""What to ask for, and what came back: adapters by route, addresses, records, payload checks. Transport is left to the caller."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import doi_variants, native_urls
from .archives import starts

# Which adapter fetches the text and which the file of a route.
TEXT_ADAPTER = {
    "pmc": "pmc", "scoap3_aps": "scoap3", "scoap3_other": "scoap3", "scoap3_jhep": "scoap3", "scoap3_elsevier": "scoap3", "springer_oa_api": "springer",
    "jats_native_open": "native", "elsevier_entitlement": "elsevier", "gated_commercial": "tei", "repository": "tei", "convert": "tei",
}
FILE_ADAPTER = {
    "pmc": "pmc", "scoap3_aps": "scoap3", "scoap3_other": "scoap3", "scoap3_jhep": "scoap3", "scoap3_elsevier": "scoap3", "springer_oa_api": "generic",
    "jats_native_open": "generic", "gated_commercial": "content", "repository": "content", "convert": "content",
}
SPRINGER_PREFIXES = ["10.1007/", "10.1038/", "10.1186/"]
FULL_BYTES = 20_000
RECORDS = "array<struct<dois: array<string>, files: array<struct<file: string, filetype: string>>, eprints: array<string>>>"
CC_ADDRESS = r"(?i)(?:https?://)?creativecommons\.org/licenses/([a-z-]+)/([0-9.]+)"
CC_WORDING = r"(?i)Creative Commons Attribution\s*([-A-Za-z ]*?)\s*(\d\.\d)?\s*(?:Unported|International|Generic)?\s*Licen[cs]e"


def _lookup(table: dict[str, str], key: str) -> Column:
    return F.try_element_at(F.create_map(*[F.lit(x) for kv in table.items() for x in kv]), F.col(key))


def adapters(tracker: DataFrame) -> DataFrame:
    """tracker with the adapters of its routes; null where a route has none."""
    return tracker.withColumns({"text_adapter": _lookup(TEXT_ADAPTER, "route"), "file_adapter": _lookup(FILE_ADAPTER, "route")})


def allowed(force: bool = False) -> Column:
    """Only openly licensed works are fetched, unless one is forced."""
    return F.lit(force) | F.coalesce(F.col("license") == "cc-by", F.lit(False))


def lookups(works: DataFrame) -> DataFrame:
    """One row per spelling of a DOI that a case-sensitive index may know, in order."""
    return works.where("doi is not null").select("id", "doi", F.posexplode(doi_variants("doi")).alias("place", "ask"))


def file_addresses() -> Column:
    """Where a work's file may be: the address on record, then those its DOI makes."""
    doi = F.coalesce("doi", F.lit(""))
    name = F.replace(F.trim(F.regexp_replace(F.lower(F.coalesce("journal", F.lit(""))), "^frontiers (in|of) ", "")), F.lit(" "), F.lit("-"))
    springer = F.lit(False)
    for p in SPRINGER_PREFIXES:
        springer = springer | F.startswith(doi, F.lit(p))
    made = [F.col("pdf_url"), F.when(F.startswith(doi, F.lit("10.3389/")) & (name != ""), F.concat(F.lit("https://www.frontiersin.org/journals/"), name, F.lit("/articles/"), doi, F.lit("/pdf"))),
            F.when(springer, F.concat(F.lit("https://link.springer.com/content/pdf/"), doi, F.lit(".pdf")))]
    return F.filter(F.array(*made), lambda x: x.isNotNull())


def text_addresses() -> Column:
    return native_urls(F.coalesce("doi", F.lit("")), "journal")


def pick_file(records: Column, doi: Column, filetype: str) -> Column:
    """The first file of a type in the first record that has this DOI, whatever its case."""
    mine = F.filter(records, lambda r: F.exists(r["dois"], lambda d: F.lower(d) == F.lower(doi)))
    files = F.flatten(F.transform(mine, lambda r: F.filter(r["files"], lambda f: f["filetype"] == filetype)))
    return F.get(files, F.lit(0))["file"]


def eprint(records: Column) -> Column:
    """The first preprint number of the records."""
    every = F.flatten(F.transform(records, lambda r: F.coalesce(r["eprints"], F.array().cast("array<string>"))))
    return F.get(F.filter(every, lambda v: v.rlike(r"^\d{4}\.\d{4,5}$")), F.lit(0))


def topic(raw: str = "primary_topic") -> list[Column]:
    """(field, domain) of a record's main topic."""
    return [F.col(f"{raw}.field.display_name").alias("field"), F.col(f"{raw}.domain.display_name").alias("domain")]


def figure_addresses(doi: Column, images: Column) -> Column:
    """Addresses of a journal's figures by their number in the image's name, in order; none for other publishers."""
    number = lambda h: F.regexp_extract(h, r"\.(g\d+)", 1)
    made = F.transform(F.filter(images, lambda h: number(h) != ""), lambda h: F.concat(F.lit("https://journals.plos.org/plosone/article/figure/image?id="), doi, F.lit("."), number(h), F.lit("&size=large")))
    return F.when(F.startswith(doi, F.lit("10.1371/")), made).otherwise(F.array().cast("array<string>"))


def source_figures(picked: DataFrame, order: DataFrame, wanted: DataFrame) -> DataFrame:
    """picked (path, stem, member), order (path, place, stem), wanted (path, figures): (path, number, member), or nothing of an archive.

    Figures are numbered as the source includes them, or, where it includes none of them, by name. An archive with more
    or fewer images than the article has figures isn't used: which is which can't be told.
    """
    first = order.groupBy("path", "stem").agg(F.min("place").alias("place"))
    placed = picked.join(first, ["path", "stem"], "left")
    named = F.count("place").over(Window.partitionBy("path"))
    every = F.count(F.lit(1)).over(Window.partitionBy("path"))
    sure = placed.withColumns({"named": named, "every": every}).join(wanted, "path").where((F.col("every") == F.col("figures")) & F.col("named").isin(F.lit(0), F.col("every")))
    return sure.select("path", F.row_number().over(Window.partitionBy("path").orderBy("place", "stem")).alias("number"), "member")


def discovered_id(results: Column, doi: Column) -> Column:
    """The central id of the first result (array<struct<doi, pmcid>>) with this very DOI that has one."""
    return F.get(F.filter(results, lambda r: (F.lower(r["doi"]) == F.lower(doi)) & F.startswith(r["pmcid"], F.lit("PMC"))), F.lit(0))["pmcid"]


def with_fallback(primary: Column, fallback: Column, good) -> Column:
    """The first of two answers that is good, and null when neither is."""
    return F.when(F.coalesce(good(primary), F.lit(False)), primary).when(F.coalesce(good(fallback), F.lit(False)), fallback)


def body_reference(text: str) -> Column:
    """The address of the full text in a header-only deposit; null for a text that is an article already or has none."""
    found = F.nullif(F.regexp_extract(text, r'<BodyRef[^>]*FileRef="([^"]+\.ft\.xml)"', 1), F.lit(""))
    return F.when(~F.contains(F.substring(text, 1, 400), F.lit("<article")), found)


def is_full_text(text: str) -> Column:
    """Whether an entitled answer is more than a stub."""
    return F.coalesce(F.contains(text, F.lit("<ce:para")) | F.contains(text, F.lit("xocs:rawtext")) | (F.octet_length(text) > FULL_BYTES), F.lit(False))


def is_tei(text: str) -> Column:
    return F.coalesce(F.contains(F.substring(text, 1, 800), F.lit("tei-c.org/ns/1.0")), F.lit(False))


def is_pdf(content: str) -> Column:
    return F.coalesce(starts(content, b"%PDF-"), F.lit(False))


def printed_licence(pages: DataFrame) -> DataFrame:
    """pages (id, page, text, links array<string>) to (id, url, prose): the licence printed in a file.

    The first three pages and the last are read in order. On each an address comes first, then a
    link's, then wording that states a version; the first of these found decides. Without one, the
    first wording without a version is kept as prose.
    """
    last = pages.groupBy("id").agg(F.max("page").alias("last"))
    read = pages.join(last, "id").where((F.col("page") < 3) | (F.col("page") == F.col("last")))
    address = lambda t: F.when(F.regexp_extract(t, CC_ADDRESS, 2) != "", F.concat(F.lit("https://creativecommons.org/licenses/"), F.lower(F.regexp_extract(t, CC_ADDRESS, 1)), F.lit("/"), F.regexp_extract(t, CC_ADDRESS, 2), F.lit("/")))
    shown = F.regexp_replace("text", r"\s+", " ")
    extra = F.regexp_replace(F.lower(F.regexp_extract(shown, CC_WORDING, 1)), "[ -]", "")
    has = lambda word, mark: F.when(F.contains(extra, F.lit(word)), mark).otherwise("")
    flavour = F.concat(F.lit("by"), has("noncommercial", "-nc"), has("noderiv", "-nd"), has("sharealike", "-sa"))
    version = F.regexp_extract(shown, CC_WORDING, 2)
    stated = F.when(version != "", F.concat(F.lit("https://creativecommons.org/licenses/"), flavour, F.lit("/"), version, F.lit("/")))
    linked = F.get(F.filter(F.transform(F.coalesce("links", F.array().cast("array<string>")), address), lambda x: x.isNotNull()), F.lit(0))
    url = F.coalesce(address(F.regexp_replace("text", r"\s+", "")), linked, stated)
    prose = F.when(url.isNull(), F.nullif(F.regexp_extract(shown, CC_WORDING, 0), F.lit("")))
    per = read.select("id", "page", url.alias("url"), prose.alias("prose"))
    got = per.groupBy("id").agg(F.min_by("url", F.when(F.col("url").isNotNull(), F.col("page"))).alias("url"), F.min(F.when(F.col("url").isNotNull(), F.col("page"))).alias("at"),
                                F.min_by("prose", F.when(F.col("prose").isNotNull(), F.col("page"))).alias("prose"), F.min(F.when(F.col("prose").isNotNull(), F.col("page"))).alias("prose_at"))
    return got.select("id", "url", F.when(F.col("at").isNull() | (F.col("prose_at") < F.col("at")), F.col("prose")).alias("prose"))
