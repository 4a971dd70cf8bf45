"""Decision tables as data: an ordered list of arms, the first that holds wins.

A table compiles to one ``CASE`` column. A null condition is not true, as in SQL. Tables are applied
in dependency order in one projection chain: one scan, no shuffle, and Catalyst keeps each column's
CASE in a projection of its own where a later one reads it, so nothing is evaluated twice.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- Fixed values: publisher names (matched exactly), journal patterns (matched lower-cased), licences.
SPRINGER = ["Springer Science+Business Media", "Springer Nature", "Nature Portfolio", "BioMed Central"]
NATIVE_OPEN = [
    "Multidisciplinary Digital Publishing Institute", "Frontiers Media", "Public Library of Science", "eLife Sciences Publications Ltd",
    "eLife Sciences Publications", "PeerJ", "Copernicus GmbH", "Copernicus Publications", "Pensoft Publishers", "F1000 Research Ltd", "F1000 Research",
    "The Royal Society", "Royal Society", "NIHR Journals Library", "Ubiquity Press", "Open Library of the Humanities",
]
ELSEVIER = ["Elsevier BV", "Elsevier"]
GATED = [
    "Wiley", "Oxford University Press", "Taylor & Francis", "SAGE Publishing", "American Chemical Society", "Cambridge University Press",
    "Institute of Electrical and Electronics Engineers", "IOP Publishing", "Institute of Physics", "Royal Society of Chemistry",
    "American Physical Society", "EDP Sciences", "BMJ", "BMJ Publishing Group",
]
REPOSITORY = ["Figshare", "Figshare (United Kingdom)", "European Organization for Nuclear Research", "Zenodo"]
REUSABLE = ["cc-by", "cc-by-sa", "public-domain", "cc0"]
APS = ["physical review. d%", "physical review d%", "physical review. c%", "physical review c%", "physical review letters%"]
JHEP, EPJC, PLB, NPB = "%high energy physics%", "%european physical journal c%", "%physics letters b%", "%nuclear physics b%"
OTHER = [JHEP, EPJC, PLB, NPB, "%chinese physics c%", "%theoretical and experimental physics%", "%acta physica polonica b%"]
ACCESS = {
    "pmc": "open", "scoap3_aps": "open", "scoap3_other": "open", "scoap3_jhep": "open", "scoap3_elsevier": "open", "jats_native_open": "open",
    "springer_oa_api": "free_key", "elsevier_entitlement": "entitlement", "gated_commercial": "gated", "repository": "repository", "convert": "none",
}
LANES = {
    "pmc": "C_ingest", "scoap3_aps": "C_ingest", "scoap3_jhep": "C_ingest", "jats_native_open": "C_ingest", "springer_oa_api": "C_ingest",
    "scoap3_elsevier": "Cprime_transform", "scoap3_other": "Cprime_transform", "elsevier_entitlement": "Cprime_transform",
    "gated_commercial": "B_convert", "repository": "B_convert", "convert": "B_convert",
}
DERIVED = ["scoap3", "route", "route_access", "asset_route", "lane", "disposition"]


@dataclass(frozen=True)
class Arm:
    when: Callable[[], Column]
    then: str | None | Table  # a table decides further, so that its arms needn't repeat the condition
    label: str = ""


@dataclass(frozen=True)
class Table:
    column: str
    arms: tuple[Arm, ...]
    otherwise: str | None

    def compiled(self) -> Column:
        out = None
        for arm in self.arms:
            value = arm.then.compiled() if isinstance(arm.then, Table) else F.lit(arm.then).cast("string")
            out = F.when(arm.when(), value) if out is None else out.when(arm.when(), value)
        return out.otherwise(F.lit(self.otherwise).cast("string"))

    def fired(self) -> Column:
        """The number of the arm that decided, from 0; null for the default."""
        out = None
        for i, arm in enumerate(self.arms):
            out = F.when(arm.when(), F.lit(i)) if out is None else out.when(arm.when(), F.lit(i))
        return out


@dataclass(frozen=True)
class Lookup:
    """A table whose arms all compare one column with a constant: a map, which names the column once.

    A filter on a derived column is pushed to the scan with the derivation in place of the name; with
    arms that each name the route, what is pushed would grow with every table.
    """
    column: str
    by: str
    values: dict[str, str]
    otherwise: str

    @property
    def arms(self) -> tuple[Arm, ...]:
        return tuple(Arm(lambda k=k: F.col(self.by) == k, v) for k, v in self.values.items())

    def compiled(self) -> Column:
        pairs = F.create_map(*[F.lit(x) for kv in self.values.items() for x in kv])
        return F.coalesce(F.try_element_at(pairs, F.col(self.by)), F.lit(self.otherwise))


def journal_like(*patterns: str) -> Column:
    any_of = F.lit(False)
    for p in patterns:
        any_of = any_of | F.lower("journal").like(p)
    return any_of


def tables() -> list[Table | Lookup]:
    col = F.col
    scoap3 = Table("scoap3", (Arm(lambda: journal_like(*APS), "aps", "deposits house vocabulary"), Arm(lambda: journal_like(*OTHER), "other", "deposits a foreign one")), None)
    other = Table("route", (Arm(lambda: journal_like(JHEP), "scoap3_jhep"), Arm(lambda: journal_like(EPJC), "springer_oa_api"), Arm(lambda: journal_like(PLB, NPB), "scoap3_elsevier")), "scoap3_other")
    publisher = lambda names: col("publisher").isin(names)
    route = Table("route", (
        Arm(lambda: (col("license") != "cc-by") | col("license").isNull(), "out_of_scope", "licence isn't cc-by"),
        Arm(lambda: col("in_pmc"), "pmc", "in the open subset, cheapest whoever published it"),
        Arm(lambda: col("scoap3") == "aps", "scoap3_aps"), Arm(lambda: col("scoap3") == "other", other),
        Arm(lambda: publisher(SPRINGER), "springer_oa_api"), Arm(lambda: publisher(NATIVE_OPEN), "jats_native_open"),
        Arm(lambda: publisher(ELSEVIER), "elsevier_entitlement"), Arm(lambda: publisher(GATED), "gated_commercial"),
        Arm(lambda: publisher(REPOSITORY) | col("publisher").isNull(), "repository"),
    ), "convert")
    routed = lambda *names: col("route").isin(*names)
    asset = Table("asset_route", (
        Arm(lambda: routed("pmc"), "publisher_package"), Arm(lambda: routed("scoap3_aps", "scoap3_other", "scoap3_jhep", "scoap3_elsevier"), "repo_pdf"),
        Arm(lambda: routed("elsevier_entitlement"), "entitlement_pdf"),
        Arm(lambda: routed("jats_native_open", "springer_oa_api") & col("pdf_url").isNotNull(), "oa_pdf"),
        Arm(lambda: routed("jats_native_open", "springer_oa_api"), "publisher_urls"),
        Arm(lambda: routed("gated_commercial", "repository", "convert") & (col("pdf_url").isNotNull() | col("has_pdf")), "pdf_extract_laneB"),
        Arm(lambda: routed("out_of_scope"), "na"),
    ), "none")
    lane = Lookup("lane", "route", LANES, "out_of_scope")
    disposition = Table("disposition", (
        Arm(lambda: (col("license") == "cc-by") & col("lane").isin("C_ingest", "Cprime_transform"), "automated"),
        Arm(lambda: col("license").isin(REUSABLE), "convert_vor"),
    ), "source_aam")
    access = Lookup("route_access", "route", ACCESS, "na")
    return [scoap3, route, access, asset, lane, disposition]


def route_works(works: DataFrame, provenance: bool = False) -> DataFrame:
    """works with the six derived columns; with ``provenance``, also the arm of the route that fired."""
    out = works.drop(*DERIVED)
    for table in tables():
        if provenance and table.column == "route":
            out = out.withColumn("route_arm", table.fired())
        out = out.withColumn(table.column, table.compiled())
    return out


def explain() -> list[tuple[str, int, str, str]]:
    """(column, place, result, why) of every arm, for people."""
    return [(t.column, i, a.then.column if isinstance(a.then, Table) else str(a.then), a.label) for t in tables() for i, a in enumerate(t.arms)] + [(t.column, len(t.arms), str(t.otherwise), "default") for t in tables()]
