"""Works, outcomes and sidecars made from the test tables by integer arithmetic.

The expressions are SQL that Spark and DuckDB read alike, so a query and its oracle see the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

JOURNALS = [
    "Physical Review Letters", "Physical review. D/Physical review. D.", "Journal of High Energy Physics", "The European Physical Journal C", "Physics Letters B", "Nuclear Physics B",
    "Chinese Physics C", "Energies", "NATURE", None, "Frontiers in Plant Science", "Bone & Joint's Journal", "PHYSICAL REVIEW C",
]
PUBLISHERS = [
    "Springer Nature", "Elsevier BV", "Wiley", None, "Frontiers Media", "Figshare", "University of Manchester", "springer nature", "O'Reilly", "Oxford University Press",
    "Royal Society of Chemistry", "Taylor & Francis", "Public Library of Science", "Nature Portfolio", "Zenodo", "Cambridge University Press", "PeerJ",
]
LICENCES = ["cc-by", "cc-by", "cc-by", "cc-by", "cc-by-nc", None, "cc-by-sa", "cc0", "cc-by", "public-domain", "cc-by"]
DOIS = ["10.1103/physrevd.110.", "10.1007/jhep01(2025)", "10.1371/journal.pone.", "10.7554/eLife.", "10.3389/fpls.2025.", "10.7717/peerj.", "10.3390/en18.", "10.1098/rsos.", "10.12688/f1000research.", "10.1103/other.", "10.5194/acp-"]


def pick(values: list, by: str) -> str:
    arms = " ".join(f"WHEN {i} THEN '" + v.replace("'", "''") + "'" for i, v in enumerate(values) if v is not None)
    return f"CASE ({by}) % {len(values)} {arms} ELSE NULL END"


WORKS = f"""
 concat('W', doc_id) AS id, CASE WHEN doc_id % 29 = 0 THEN NULL ELSE concat({pick(DOIS, 'doc_id')}, doc_id) END AS doi, substring(text, 1, 40) AS title, 2021 + doc_id % 5 AS year,
 {pick(JOURNALS, 'doc_id')} AS journal, {pick(PUBLISHERS, 'doc_id')} AS publisher, {pick(LICENCES, 'doc_id')} AS license,
 CASE WHEN doc_id % 4 = 3 THEN 'submittedVersion' ELSE 'publishedVersion' END AS version, doc_id % 13 = 5 AS in_pmc, doc_id % 3 <> 0 AS is_oa,
 CASE WHEN doc_id % 3 = 1 THEN concat('https://example.org/', doc_id, '.pdf') ELSE NULL END AS pdf_url, n_chars % 2 = 0 AS has_pdf, doc_id % 5 < 2 AS has_grobid
"""
#: Outcomes: labelled documents; some with nulls that must overwrite, and some of works that don't exist.
OUTCOMES = """
 concat('W', CASE WHEN doc_id % 10 = 9 THEN doc_id + 100000000 ELSE doc_id END) AS id, quality = 1 AS validate, toxic = 0 AS lint, doc_id % 6 AS figures,
 doc_id % 8 <> 7 AS licence, CASE WHEN doc_id % 12 = 1 THEN 'needs a person' ELSE NULL END AS escalate,
 CASE doc_id % 3 WHEN 0 THEN 'complete' WHEN 1 THEN 'partial' ELSE 'none' END AS figures_status,
 CASE WHEN doc_id % 7 = 0 THEN NULL ELSE concat('MORE-2025-', CASE WHEN doc_id % 7 = 1 THEN 'x' ELSE '' END, 910000 + doc_id) END AS mid
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def works(spark: SparkSession, sf_dir: str) -> DataFrame:
    return columns(table(spark, sf_dir, "documents"), WORKS)


def columns(df: DataFrame, text: str) -> DataFrame:
    """df with the select list ``text``: one expression to a part at the top level's commas."""
    parts, depth, quoted, at = [], 0, False, 0
    for i, ch in enumerate(text):
        quoted ^= ch == "'"
        if not quoted:
            depth += (ch == "(") - (ch == ")")
            if ch == "," and depth == 0:
                parts.append(text[at:i])
                at = i + 1
    return df.select(*[F.expr(p) for p in [*parts, text[at:]]])


def outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return columns(table(spark, sf_dir, "labels"), OUTCOMES)
