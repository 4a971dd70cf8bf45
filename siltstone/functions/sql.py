"""The rules, names and addresses as functions of SQL, so that they can be used from ``spark.sql`` alone.

A scalar or table function's body is the SQL text of the very expression that the DataFrame functions build, so it is inlined in a query and optimised with it.
``latex_spans`` is a table function in Python: it reads texts that no pattern can.
"""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import udtf

from ..plans.rules import tables
from ..shipping import ship
from . import text as T


@udtf(returnType="start: int, end: int, kind: string, content: string")
class LatexSpans:
    """The formulas and citations of a text, from left to right."""

    def eval(self, text: str):
        from ..operators.house import latex_spans

        yield from latex_spans(text or "")


def sql_of(spark: SparkSession, column: Column, parameters: dict[str, str]) -> str:
    """The SQL text of an expression over columns of these names and types."""
    df = spark.createDataFrame([], ", ".join(f"{n} {t}" for n, t in parameters.items())).select(column.alias("_out"))
    return df._jdf.queryExecution().analyzed().expressions().head().child().sql()


#: Columns that the rule tables read, and their types.
RULED = {"journal": "string", "publisher": "string", "license": "string", "in_pmc": "boolean", "pdf_url": "string", "has_pdf": "boolean", "scoap3": "string", "route": "string", "lane": "string"}
#: What each derived column is made of, in the order of its function's parameters.
READS = {"scoap3": ["journal"], "route": ["license", "in_pmc", "scoap3", "journal", "publisher"], "route_access": ["route"], "asset_route": ["route", "pdf_url", "has_pdf"], "lane": ["route"], "disposition": ["license", "lane"]}


def _scalar(spark: SparkSession, name: str, column: Column, parameters: dict[str, str], returns: str) -> None:
    spark.sql(f"create or replace temporary function {name}({', '.join(f'{n} {t}' for n, t in parameters.items())}) returns {returns} return {sql_of(spark, column, parameters)}")


def _rows(spark: SparkSession, name: str, column: Column, parameters: dict[str, str], value: str) -> None:
    """A table function (place, value) of an array's elements, from place 0."""
    made = sql_of(spark, column, parameters)
    spark.sql(f"create or replace temporary function {name}({', '.join(f'{n} {t}' for n, t in parameters.items())}) returns table (place int, {value} string) return select * from posexplode({made})")


def register(spark: SparkSession) -> list[str]:
    """Makes the functions known to a session; their names.

    Scalars: scoap3_of(journal), route_of(license, in_pmc, scoap3, journal, publisher), route_access_of(route), asset_route_of(route, pdf_url, has_pdf), lane_of(route), disposition_of(license, lane), slug_of(name).
    Tables: doi_spellings(doi), xml_addresses(doi, journal), latex_spans(text).
    """
    ship(spark)
    made = []
    for table in tables():
        made.append(f"{table.column}_of")
        _scalar(spark, made[-1], table.compiled(), {n: RULED[n] for n in READS[table.column]}, "string")
    _scalar(spark, "slug_of", T.slug(F.col("name"), "unknown"), {"name": "string"}, "string")
    _rows(spark, "doi_spellings", T.doi_variants("doi"), {"doi": "string"}, "spelling")
    _rows(spark, "xml_addresses", T.native_urls(F.coalesce("doi", F.lit("")), "journal"), {"doi": "string", "journal": "string"}, "url")
    spark.udtf.register("latex_spans", LatexSpans)
    return [*made, "slug_of", "doi_spellings", "xml_addresses", "latex_spans"]
