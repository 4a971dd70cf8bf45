"""Joins with a rule about what may match: unambiguous citations, guarded positions, ordered lookups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Division by field, then by domain; the last is for neither.
FIELD_DIVISION = {
    "Medicine": "32", "Nursing": "42", "Health Professions": "42", "Dentistry": "32", "Pharmacology, Toxicology and Pharmaceutics": "32",
    "Immunology and Microbiology": "32", "Neuroscience": "32", "Biochemistry, Genetics and Molecular Biology": "31",
    "Agricultural and Biological Sciences": "30", "Veterinary": "30", "Environmental Science": "41", "Chemistry": "34", "Chemical Engineering": "40",
    "Materials Science": "40", "Engineering": "40", "Energy": "40", "Physics and Astronomy": "51", "Earth and Planetary Sciences": "37", "Mathematics": "49",
    "Computer Science": "46", "Decision Sciences": "46", "Economics, Econometrics and Finance": "38", "Business, Management and Accounting": "35",
    "Social Sciences": "44", "Psychology": "52", "Arts and Humanities": "36",
}
DOMAIN_DIVISION = {"Health Sciences": "42", "Life Sciences": "31", "Physical Sciences": "51", "Social Sciences": "44"}
NO_DIVISION = "42"

# Fixed values: (slug, name, reference style, headings numbered or not known, fonts, completeness floor).
PUBLISHER_RULES = [
    ("wiley", "Wiley", "author-year", False, ["STIXTwoText", "AdvBOOKO-R", "AdvTimes"], None),
    ("oxford-university-press", "Oxford University Press", "author-year", True, ["Times-Roman", "TeXGyreTermesX-Regular", "CMR10"], None),
    ("cambridge-university-press", "Cambridge University Press", "author-year", None, ["NimbusRomNo9L-Regu"], None),
    ("royal-society-of-chemistry", "Royal Society of Chemistry", "numbered", True, ["AdvOT9b12cd41", "AdvOT999035f4", "LiberationSans"], None),
    ("taylor-francis", "Taylor & Francis", "author-year", None, ["OpenSans", "Helvetica"], None),
]
DEFAULT_RULE = ("_default", "(unknown publisher)", "author-year", None, [], None)
RULE_SCHEMA = "slug string, name string, reference_style string, headings_numbered boolean, fonts array<string>, floor double"


def _map(m: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for kv in m.items() for x in kv])


def division(field: Column, domain: Column) -> Column:
    return F.coalesce(F.try_element_at(_map(FIELD_DIVISION), field), F.try_element_at(_map(DOMAIN_DIVISION), domain), F.lit(NO_DIVISION))


def subject_codes(div: Column) -> Column:
    """The division and its "other" group and field codes."""
    return F.array(div, F.concat(div, F.lit("99")), F.concat(div, F.lit("9999")))


def publisher_rules(df: DataFrame, slug_col: str = "slug") -> DataFrame:
    """df with the publisher's rule as a struct, the default where no slug matches. The rules are a few literal rows."""
    rules = df.sparkSession.createDataFrame(PUBLISHER_RULES, RULE_SCHEMA)
    out = df.join(rules.select(F.col("slug").alias("_slug"), F.struct(*rules.columns).alias("rule")), F.col(slug_col) == F.col("_slug"), "left").drop("_slug")
    names = rules.schema.fields
    default = F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) if v != [] else F.array().cast("array<string>").alias(f.name) for v, f in zip(DEFAULT_RULE, names, strict=True)])
    return out.withColumn("rule", F.coalesce("rule", default))


def rule_by_font(fonts: Column) -> Column:
    """The slug of the first rule, in order, that shares a font."""
    out = None
    for slug, _, _, _, hints, _ in PUBLISHER_RULES:
        test = F.arrays_overlap(fonts, F.array(*[F.lit(h) for h in hints]))
        out = F.when(test, slug) if out is None else out.when(test, slug)
    return out.otherwise(DEFAULT_RULE[0])


def link_author_year(citations: DataFrame, references: DataFrame) -> DataFrame:
    """citations (doc, cite, surname, year) with the reference id, where exactly one reference has the name and year; others null."""
    only = references.groupBy("doc", "surname", "year").agg(F.count_distinct("ref").alias("k"), F.min("ref").alias("ref")).where("k = 1").drop("k")
    return citations.join(only, ["doc", "surname", "year"], "left")


def link_numbered(citations: DataFrame, references: DataFrame) -> DataFrame:
    """citations (doc, cite, number) with the reference of that label, first of equals, else the one at that place."""
    labelled = references.where("label is not null").groupBy("doc", F.col("label").alias("number")).agg(F.min_by("ref", "pos").alias("by_label"))
    placed = references.select("doc", (F.col("pos") + 1).cast("string").alias("number"), F.col("ref").alias("by_place"))
    return citations.join(labelled, ["doc", "number"], "left").join(placed, ["doc", "number"], "left").select(*citations.columns, F.coalesce("by_label", "by_place").alias("ref"))


def zip_positions(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Rows of equal place (from 0) on both sides of a key; the longer side's rest is left; ``uneven`` says so."""
    n = left.groupBy(key).agg(F.count(F.lit(1)).alias("n_left")).join(right.groupBy(key).agg(F.count(F.lit(1)).alias("n_right")), key)
    return left.join(right, [key, "pos"]).join(n, key).withColumn("uneven", F.col("n_left") != F.col("n_right")).drop("n_left", "n_right")


def exact_sequence(rows: DataFrame, key: str, number: str) -> DataFrame:
    """The keys whose distinct numbers are exactly 1 to n, with n."""
    g = rows.groupBy(key).agg(F.count_distinct(number).alias("n"), F.min(number).alias("lo"), F.max(number).alias("hi"), F.count_if(F.col(number).isNull()).alias("none"))
    return g.where("lo = 1 and hi = n and none = 0").select(key, "n")


def folded(units: DataFrame) -> DataFrame:
    """units (doc, pos, head): each joins the unit before it unless its head has three letters; the first always starts one. Adds ``unit``."""
    from pyspark.sql import Window

    w = Window.partitionBy("doc").orderBy("pos")
    starts = (F.row_number().over(w) == 1) | (F.length(F.regexp_replace(F.coalesce("head", F.lit("")), "[^A-Za-z]", "")) >= 3)
    return units.withColumn("_s", starts.cast("int")).withColumn("unit", F.sum("_s").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("_s")
