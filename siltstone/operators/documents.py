"""Documents as rows: one parse each, in Arrow batches. A document that fails is a row with its error."""

from __future__ import annotations

import json

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.words import slices
from ..shipping import ship
from .foreign import bibliography_size, from_publisher, from_tei, source_journal
from .house import body_latex, captions, front_latex, measure, prose, residual, to_house, wire
from .spread import spread
from .tree import parse, serialise

DOCTYPE = '<?xml version="1.0" encoding="utf-8"?>\n<!DOCTYPE article PUBLIC "-//NLM//DTD JATS (Z39.96) Journal Archiving and Interchange DTD v1.4 20241031//EN" "JATS-archivearticle1-4.dtd">\n'
FINGERPRINT = "root_is_article boolean, has_title boolean, contrib_count int, affs_all_have_ids boolean, residual_latex int, bibr_links int, ref_count int, fig_count int, formula_count int, cc_license_typed boolean"


#: Characters of cells that are rows of Python objects at once.
SLICE_BYTES = 1 << 20


def _per_document(fields: list[tuple[str, pa.DataType]], make):
    """A function of Arrow batches: id first, then what ``make`` gives of the other cells, then its error.

    A batch is some 64 MB of texts. A part of SLICE_BYTES is taken, made and given away before the next, so a worker holds a batch as Arrow
    and never all its texts, trees and results as objects.
    """
    names, kinds = zip(*fields, strict=True)

    def made(batch):
        rows = []
        for id_, *cells in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            try:
                rows.append((id_, *make(*cells), None))
            except Exception as e:
                rows.append((id_, *[None] * len(fields), f"{type(e).__name__}: {e}"[:200]))
        columns = list(zip(*rows, strict=True)) or [()] * (len(fields) + 2)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), *kinds, pa.string()), strict=True)], names=["id", *names, "error"])

    def run(batches):
        for batch in batches:
            for part in slices(batch, [i for i, t in enumerate(batch.schema.types) if pa.types.is_string(t) or pa.types.is_large_string(t)], SLICE_BYTES):
                yield made(part)
    return run


def _housed(xml: str, kind: str, mid: str, meta: str | None, codes: list | None, have: list | None):
    known = json.loads(meta or "{}")
    root = parse(xml, recover=True)
    if kind == "tei":
        root = from_tei(root, known, known.get("reference_style", "author-year"), known.get("headings_numbered"))
    elif kind == "elsevier":
        root = from_publisher(root, {**known, "journal": source_journal(root) or known.get("journal")})
    root, missing = to_house(root, mid, [(c["code"], c["label"]) for c in codes or []], have)
    captions(root)
    if "\\" in xml or "$" in xml:
        front_latex(root)
    if "\\cite" in xml or "$" in xml:
        body_latex(root)
    return DOCTYPE + serialise(root) + "\n", missing, residual(root)


def crosswalk(sources: DataFrame) -> DataFrame:
    """sources (id, xml, kind, mid, meta JSON, codes array<struct<code,label>>, assets array<string>) to (id, article, missing, residual, error)."""
    cells = spread(sources).select(F.col("id").cast("string"), "xml", "kind", "mid", "meta", "codes", "assets")
    run = _per_document([("article", pa.string()), ("missing", pa.list_(pa.string())), ("residual", pa.int32())], _housed)
    return cells.mapInArrow(run, "id string, article string, missing array<string>, residual int, error string")


def fingerprint(articles: DataFrame, column: str = "article") -> DataFrame:
    """(id, the eleven measures but the external validation, error)."""
    kinds = {"boolean": pa.bool_(), "int": pa.int32()}
    ship(articles.sparkSession)
    fields = [(n, kinds[k]) for n, k in (x.split() for x in FINGERPRINT.split(", "))]
    run = _per_document(fields, lambda xml: tuple(measure(parse(xml)).values()))
    return articles.select(F.col("id").cast("string"), column).mapInArrow(run, f"id string, {FINGERPRINT}, error string")


#: The measures that one XPath expression gives, in the order of FINGERPRINT but for what is left of LaTeX.
COUNTED = {
    "root_is_article": "number(name(/*) = 'article')", "has_title": "number(normalize-space((//article-title)[1]) != '')", "contrib_count": "count(//contrib[@contrib-type = 'author'])",
    "affs_all_have_ids": "number(not(//aff[not(@id) or @id = '']))", "bibr_links": "count(//xref[@ref-type = 'bibr'])", "ref_count": "count(//ref)", "fig_count": "count(//fig)",
    "formula_count": "count(//inline-formula) + count(//disp-formula)", "cc_license_typed": "number(boolean(//license[@license-type = 'creative-commons']))"}
#: LaTeX in a text: a citation, a formula between its marks, or what a backslash stands before. A formula in dollars isn't empty.
MARKS = r"(?s)\\cite[tp]?\*?\s*\{[^{}]*\}|\\begin\{(equation|align|gather|eqnarray|multline|displaymath)\*?\}(?:\\(?!end\{\1\*?\}).|[^\\])*\\end\{\1\*?\}|\\\[(?:\\(?!\]).|[^\\])*\\\]|\\\((?:\\(?!\)).|[^\\])*\\\)|\$\$.(?:\\.|(?!\$\$)[^\\])*\$\$|\$(?!\$).(?:\\.|[^\\$])*\$|\\."


def measures(articles: DataFrame, column: str = "article") -> DataFrame:
    """(id and the measures of ``fingerprint``) of articles that are well formed, as ``crosswalk`` gives them, in the JVM: a text is parsed once, and again only if it may hold LaTeX. What isn't well formed raises an error; ``fingerprint`` reads it."""
    xml = F.regexp_replace(F.col(column), r"(?s)^\s*(<\?xml.*?\?>)?\s*<!DOCTYPE[^\[>]*(\[.*?\]\s*)?>", "")
    joined = "concat(" + ", ' ', ".join(COUNTED.values()) + ")"
    outside = " or ".join(f"ancestor::{n}" for n in ("inline-formula", "disp-formula", "tex-math", "math", "alternatives"))
    prose = F.xpath("_xml", F.lit(f"(//body)[1]//text()[not({outside})]"))
    spans = F.aggregate(prose, F.lit(0), lambda n, t: n + F.size(F.filter(F.regexp_extract_all(t, F.lit(MARKS), F.lit(0)), lambda m: F.length(m) > 2)))
    residual = F.when(F.contains("_xml", F.lit("$")) | F.contains("_xml", F.lit("\\")), spans).otherwise(0)
    rows = articles.select(F.col("id").cast("string").alias("id"), xml.alias("_xml")).withColumn("_counts", F.split(F.xpath_string("_xml", F.lit(joined)), " "))
    of = {name: F.get("_counts", F.lit(i)).cast("double").cast("int") for i, name in enumerate(COUNTED)}
    kinds = dict(x.split() for x in FINGERPRINT.split(", "))
    return rows.select("id", *[(residual if name == "residual_latex" else of[name]).cast(kind).alias(name) for name, kind in kinds.items()])


def texts(articles: DataFrame, column: str = "article") -> DataFrame:
    """(id, prose without mathematics, ref count, error), the input of the fidelity check."""
    ship(articles.sparkSession)
    run = _per_document([("text", pa.string()), ("refs", pa.int32())], lambda xml: (prose(r := parse(xml)), sum(1 for _ in r.walk("ref"))))
    return articles.select(F.col("id").cast("string"), column).mapInArrow(run, "id string, text string, refs int, error string")


def bibliographies(sources: DataFrame, column: str = "xml") -> DataFrame:
    """(id, references in the TEI's bibliography, error)."""
    ship(sources.sparkSession)
    run = _per_document([("refs", pa.int32())], lambda xml: (bibliography_size(parse(xml, recover=True)),))
    return sources.select(F.col("id").cast("string"), column).mapInArrow(run, "id string, refs int, error string")


def repair_figures(articles: DataFrame) -> DataFrame:
    """articles (id, article, found array<struct<file, caption, num>>) with recovered figures wired: (id, article, wired, uneven, error)."""
    def make(xml, found):
        root = parse(xml)
        n, uneven = wire(root, [(f["file"], f["caption"], f["num"]) for f in found or []])
        captions(root)
        return DOCTYPE + serialise(root) + "\n", n, uneven
    ship(articles.sparkSession)
    run = _per_document([("article", pa.string()), ("wired", pa.int32()), ("uneven", pa.bool_())], make)
    return articles.select(F.col("id").cast("string"), "article", "found").mapInArrow(run, "id string, article string, wired int, uneven boolean, error string")


def image_links(xml: str) -> Column:
    """Distinct base names of linked images, in order, by pattern: the text needn't be well formed."""
    found = F.regexp_extract_all(F.regexp_replace(xml, r"(?s)<!DOCTYPE.*?>", ""), F.lit(r'<(?:inline-)?graphic\b[^>]*?href="([^"]*)"'))
    return F.array_distinct(F.transform(found, lambda h: F.substring_index(h, "/", -1)))


def extra_links(xml: str) -> Column:
    """Distinct base names of local supplementary files that aren't images of the article."""
    from ..functions.text import local_href

    found = F.regexp_extract_all(xml, F.lit(r'<(?:media|(?:inline-)?supplementary-material)\b[^>]*?href="([^"]*)"'))
    names = F.array_distinct(F.transform(F.filter(found, local_href), lambda h: F.substring_index(h, "/", -1)))
    return F.array_except(names, image_links(xml))


def figure_stubs(xml: str) -> Column:
    """Paths of figures to stand in for: not addresses, and not outside of the package."""
    found = F.regexp_extract_all(xml, F.lit(r'<graphic\b[^>]*?href="([^"]*)"'))
    return F.array_distinct(F.filter(found, lambda h: (h != "") & ~F.startswith(h, F.lit("http")) & ~F.startswith(h, F.lit("/")) & ~F.contains(h, F.lit(".."))))


def linked_members(links: DataFrame, members: DataFrame) -> DataFrame:
    """links (id, path, names): one row per name, in order, that the archive at path has a member (path, member) of."""
    each = links.select("id", "path", F.posexplode("names").alias("place", "member"))
    return each.join(members.select("path", "member").where("member is not null"), ["path", "member"], "left_semi").select("id", "path", "place", "member")


def checked(articles: DataFrame, sources: DataFrame, source_texts: DataFrame, **thresholds) -> DataFrame:
    """The fidelity check of converted files: articles (id, article), sources (id, xml) for their reference counts, source_texts (id, text)."""
    from .fidelity import evaluate

    target = texts(articles).select("id", F.col("text").alias("target_text"), F.col("refs").alias("ref_target"))
    counts = bibliographies(sources).select("id", F.col("refs").alias("ref_source"))
    pairs = target.join(source_texts.select(F.col("id").cast("string").alias("id"), F.col("text").alias("source_text")), "id").join(counts, "id", "left")
    return evaluate(pairs.withColumnRenamed("id", "pair_id").withColumn("floor", F.lit(None).cast("double")), **thresholds)


def sample_articles(docs: DataFrame) -> DataFrame:
    """Articles of three vocabularies made from whole documents, for queries over the test tables."""
    body = F.replace(F.replace(F.col("text"), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
    parts = F.filter(F.split(body, "\n"), lambda x: F.trim(x) != "")
    paras = lambda tag: F.array_join(F.transform(parts, lambda x: F.concat(F.lit(f"<{tag}>"), x, F.lit(f"</{tag}>"))), "")
    jats = F.concat(F.lit('<article><front><journal-meta><journal-title>J</journal-title></journal-meta><article-meta><permissions><license><p>See https://creativecommons.org/licenses/by/4.0/</p></license></permissions><title-group><article-title>T '), "doc_id",
                    F.lit('</article-title></title-group><contrib-group><contrib><name><surname>S</surname></name></contrib></contrib-group><aff>A</aff></article-meta></front><body><sec><title>One</title><p>By <xref ref-type="bibr" rid="b1">1</xref></p>'), paras("p"),
                    F.lit('</sec></body><back><ref-list><ref id="b1"><citation citation-type="journal">Old</citation></ref></ref-list></back></article>'))
    tei = F.concat(F.lit('<TEI xmlns="http://www.tei-c.org/ns/1.0"><teiHeader><fileDesc><titleStmt><title type="main">T '), "doc_id", F.lit('</title></titleStmt></fileDesc></teiHeader><text><body><div><head n="1.">Intro</head><p>As <ref type="bibr">(Old, 2001)</ref>.</p>'), paras("p"),
                   F.lit('</div></body><back><listBibl><biblStruct xml:id="b0"><author><persName><surname>Old</surname></persName></author> 2001</biblStruct></listBibl></back></text></TEI>'))
    other = F.concat(F.lit('<!DOCTYPE x PUBLIC "-//ES//DTD a//EN" "b"><article xmlns:ce="urn:ce"><head><ce:title>T '), "doc_id", F.lit('</ce:title></head><body><ce:sections><ce:section id="s1"><ce:section-title>One</ce:section-title><ce:para>By <ce:cross-ref refid="bib1">[1]</ce:cross-ref></ce:para>'), paras("ce:para"),
                     F.lit('</ce:section></ce:sections></body><tail><ce:bib-reference id="bib1"><ce:label>[1]</ce:label>Old</ce:bib-reference></tail></article>'))
    kind = F.element_at(F.array(F.lit("jats"), F.lit("tei"), F.lit("elsevier")), (F.col("doc_id") % 3 + 1).cast("int"))
    return docs.select(F.col("doc_id").alias("id"), F.when(kind == "jats", jats).when(kind == "tei", tei).otherwise(other).alias("xml"), kind.alias("kind"), F.concat(F.lit("MORE-"), "doc_id").alias("mid"),
                       F.lit("{}").alias("meta"), F.array(F.struct(F.lit("42").alias("code"), F.lit("Health Sciences").alias("label"))).alias("codes"), F.array().cast("array<string>").alias("assets"))
