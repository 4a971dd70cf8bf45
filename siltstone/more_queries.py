"""Queries over small functions, sources and gates, each beside its SQL. They are part of the catalogue in ``queries``."""

from __future__ import annotations

from pyspark.sql import functions as F

from .functions import text as T
from .functions.latex import residual_count
from .operators import documents, gates, lineage, matching, order, pilot, tracker
from .plans import rules
from .queries import LOG_SQL, ROUTED_SQL, WORKS_SQL, logged, query
from .sources import acquire, archives, records, stores
from .standin import table, works


def _docs(spark, sf_dir, *exprs: str):
    return table(spark, sf_dir, "documents").selectExpr("doc_id", *exprs)


# --- text functions


@query(r"""with n as (select doc_id, trim(regexp_replace(substring(text, 1, 40), '\s+', ' ', 'g')) as name from documents), w as (select *, string_split(name, ' ') as w from n)
  select doc_id, array_to_string(w[:len(w) - 1], ' ') as given, w[-1] as surname, name from w""")
def person_names(spark, sf_dir):
    d = _docs(spark, sf_dir, "substring(text, 1, 40) as t")
    return d.select("doc_id", T.person("t").alias("p"), T.normalised_space("t").alias("name")).select("doc_id", "p.given", "p.surname", "name")


@query("""select doc_id, cast(case when doc_id % 3 = 0 then 2 when doc_id % 3 = 1 then 1 else 0 end as integer) as n, case when doc_id % 3 = 0 then 'A B|C ' || doc_id when doc_id % 3 = 1 then 'C ' || doc_id else '' end as who,
  case when doc_id % 3 = 2 then null when doc_id % 2 = 0 then 'Printed Place' else 'House ' || (doc_id % 7) end as place from documents""")
def author_lists(spark, sf_dir):
    raw = """transform(case when doc_id % 3 = 0 then array('A  B', concat('C ', doc_id)) when doc_id % 3 = 1 then array(concat(' C ', doc_id), ' ') else array(cast(null as string)) end,
      n -> named_struct('author', named_struct('display_name', n, 'orcid', cast(null as string)), 'raw_affiliation_strings', case when doc_id % 2 = 0 then array(' ', 'Printed Place') else array(' ') end,
        'institutions', array(named_struct('display_name', concat('House ', doc_id % 7)), named_struct('display_name', cast(null as string))))) as raw"""
    a = _docs(spark, sf_dir, raw).select("doc_id", T.authors("raw").alias("a"))
    return a.select("doc_id", F.size("a").alias("n"), F.array_join(F.transform("a", lambda x: F.trim(F.concat_ws(" ", x["given"], x["surname"]))), "|").alias("who"), F.get(F.get("a", F.lit(0))["affs"], F.lit(0)).alias("place"))


@query("""select doc_id, 'a,b|c ' || doc_id || case when doc_id % 2 = 0 then '|' || lang else '' end as parts from documents""")
def quoted_lists(spark, sf_dir):
    d = _docs(spark, sf_dir, """concat('"a,b",c ', doc_id, ',', case when doc_id % 2 = 0 then lang else '' end) as t""")
    return d.select("doc_id", F.array_join(T.split_list("t"), "|").alias("parts"))


@query("""select doc_id, replace(replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;') as escaped, case when doc_id % 5 <> 0 then substring(trim('T ' || lang || ' ' || doc_id), 1, 300) end as title from documents""")
def xml_texts(spark, sf_dir):
    d = _docs(spark, sf_dir, "text", "case when doc_id % 5 = 0 then text else concat('<x><article-title id=\"1\"> T <i>', lang, '</i> ', doc_id, ' </article-title></x>') end as xml")
    return d.select("doc_id", T.xml_escaped("text").alias("escaped"), T.title("xml").alias("title"))


@query("""select doc_id, cast(doc_id as varchar) as number, case when doc_id % 2 = 0 then 'key' || lang else '7' end as other from documents""")
def citation_numbers(spark, sf_dir):
    d = _docs(spark, sf_dir, "concat('Ref', lang, '00', doc_id, ' ') as a", "case when doc_id % 2 = 0 then concat('key', lang) else 'x007' end as b")
    return d.select("doc_id", F.when(F.col("doc_id") == 0, "0").otherwise(T.citation_number("a")).alias("number"), T.citation_number("b").alias("other"))


@query("""select doc_id, cast(2 as integer) as n, 'Pub: ' || lang as first, cast(doc_id % 90 as integer) as most, cast(3 as integer) as last from documents""")
def parsed_plans(spark, sf_dir):
    d = _docs(spark, sf_dir, "concat(' Pub: ', lang, ':', doc_id % 90, ', ,Other : 3') as p")
    p = T.plan_items("p")
    return d.select("doc_id", F.size(p).alias("n"), F.get(p, F.lit(0))["name"].alias("first"), F.get(p, F.lit(0))["n"].alias("most"), F.get(p, F.lit(1))["n"].alias("last"))


@query(r"""with k as (select doc_id, regexp_replace(lower(text), '[^a-z0-9]+', '', 'g') as a, regexp_replace(lower(substring(text, 1 + cast(doc_id % 60 as int), 200)), '[^a-z0-9]+', '', 'g') as b from documents), x as (select *, substring(a, 1, 80) as x from k)
  select doc_id, length(a) as key_chars, length(x) >= 8 and len(list_filter(range(1, greatest(length(x) - 6, 1)), lambda i: contains(b, substring(x, i, 8)))) > 0 as aligned from x""")
def caption_matches(spark, sf_dir):
    d = _docs(spark, sf_dir, "text", "substring(text, 1 + cast(doc_id % 60 as int), 200) as other")
    return d.select("doc_id", F.length(T.caption_key("text")).cast("bigint").alias("key_chars"), T.captions_aligned("text", "other").alias("aligned"))


@query(r"""select doc_id, len(regexp_extract_all(text, '\$')) + len(regexp_extract_all(text, '\\cite')) as marks, list_last(string_split(concat('a/b/', lang, '-', doc_id, '.png'), '/')) as name from documents""".replace("list_last(", "list_extract(").replace(", '/')) as name", ", '/'), -1) as name"))
def residual_marks(spark, sf_dir):
    d = _docs(spark, sf_dir, "replace(text, '\\\\$', '$') as text", "concat('a/b/', lang, '-', doc_id, '.png') as p")
    return d.select("doc_id", residual_count("text").cast("bigint").alias("marks"), T.basename("p").alias("name"))


# --- sources


@query("""select doc_id, case doc_id % 8 when 0 then 'pdf' when 1 then 'zip' when 2 then 'gzip' when 3 then 'jpeg' when 4 then 'png' when 5 then 'xml' else 'other' end as kind, doc_id % 8 = 0 as pdf from documents""")
def payload_kinds(spark, sf_dir):
    magic = "case doc_id % 8 when 0 then unhex('255044462D') when 1 then unhex('504B0304') when 2 then unhex('1F8B08') when 3 then unhex('FFD8FF') when 4 then unhex('89504E47') when 5 then encode('<?xml v', 'utf-8') when 6 then unhex('') end"
    d = _docs(spark, sf_dir, f"concat({magic}, encode(text, 'utf-8')) as content").withColumn("content", F.coalesce("content", F.lit(b"")))
    return d.select("doc_id", archives.kind("content").alias("kind"), acquire.is_pdf("content").alias("pdf"))


@query("""select doc_id, case doc_id % 3 when 0 then 'jats' when 1 then 'tei' else 'elsevier' end as transform, doc_id % 3 = 0 as jats, doc_id % 3 = 1 as tei, doc_id % 3 = 2 as full_text from documents""")
def sniffed_sources(spark, sf_dir):
    s = documents.sample_articles(table(spark, sf_dir, "documents")).select(F.col("id").cast("bigint").alias("doc_id"), "xml")
    full = F.when(F.octet_length("xml") <= acquire.FULL_BYTES, acquire.is_full_text("xml")).otherwise(F.contains("xml", F.lit("<ce:para")))
    return s.select("doc_id", archives.transform_for("xml").alias("transform"), archives.is_jats("xml").alias("jats"), acquire.is_tei("xml").alias("tei"), full.alias("full_text"))


@query("""select doc_id, doc_id % 4 < 2 as in_pmc, case when doc_id % 4 = 0 then 'PMC' || (1000000 + doc_id) when doc_id % 4 = 1 then 'PMC' || (2000000 + doc_id) end as pmcid, 'W' || doc_id as id, case when doc_id % 3 <> 0 then '10.1/' || doc_id end as doi from documents""")
def flattened_records(spark, sf_dir):
    """Nested records made of documents, flattened as the harvest does it."""
    json = """concat('{"id":"https://x.org/W', doc_id, '"', case when doc_id % 3 <> 0 then concat(',"doi":"https://doi.org/10.1/', doc_id, '"') else '' end, ',"locations":[{"id":"other:1","source":{"display_name":"Elsewhere"}}',
      case doc_id % 4 when 0 then concat(',{"id":"pmh:oai:pubmedcentral.nih.gov:', 1000000 + doc_id, '"}') when 1 then concat(',{"id":"x","source":{"display_name":"PubMed Central (US)"},"landing_page_url":"https://h/PMC', 2000000 + doc_id, '"}') else '' end, ']}') as j"""
    raw = _docs(spark, sf_dir, json).select("doc_id", F.from_json("j", records.RAW_SCHEMA).alias("r"))
    flat = raw.select("doc_id", "r.*")
    return flat.select("doc_id", records.pmc_flag().alias("in_pmc"), records.pmc_id().alias("pmcid"), F.substring_index("id", "/", -1).alias("id"), F.replace("doi", F.lit("https://doi.org/"), F.lit("")).alias("doi"))


@query("""select doc_id, 'fig' || (doc_id % 3) || case when doc_id % 2 = 0 then '.png' else '.jpeg' end as member from documents""")
def best_figures(spark, sf_dir):
    found = _docs(spark, sf_dir, "posexplode(array(concat('fig', doc_id % 3, '.eps'), concat('fig', doc_id % 3, '.jpeg'), case when doc_id % 2 = 0 then concat('fig', doc_id % 3, '.png') end, concat('fig', doc_id % 3, '.JPG'), 'logo.png', 'paper.tex')) as (place, member)")
    return archives.pick_figures(found.withColumnRenamed("doc_id", "path")).select(F.col("path").alias("doc_id"), "member")


@query("""select doc_id, case when doc_id % 2 = 0 then 'https://journals.plos.org/plosone/article/figure/image?id=10.1371/' || doc_id || '.g00' || (doc_id % 9) || '&size=large' end as first, cast(doc_id % 2 = 0 as integer) as n,
  case when doc_id % 5 = 0 then null else 'PMC' || doc_id end as pmcid, case when doc_id % 4 = 0 then 'good a' when doc_id % 4 = 1 then 'good b' end as chosen from documents""")
def figure_sources(spark, sf_dir):
    d = _docs(spark, sf_dir, "concat(case when doc_id % 2 = 0 then '10.1371/' else '10.9/' end, doc_id) as doi", "array('a.png', concat('x.g00', doc_id % 9, '.tif')) as images",
              "array(named_struct('doi', '10.0/q', 'pmcid', 'PMC1'), named_struct('doi', upper(concat(case when doc_id % 2 = 0 then '10.1371/' else '10.9/' end, doc_id)), 'pmcid', case when doc_id % 5 = 0 then cast(null as string) else concat('PMC', doc_id) end)) as results",
              "case when doc_id % 4 = 0 then 'good a' end as a", "case doc_id % 4 when 2 then null when 3 then 'bad' else 'good b' end as b")
    urls = acquire.figure_addresses(F.col("doi"), F.col("images"))
    return d.select("doc_id", F.get(urls, F.lit(0)).alias("first"), F.size(urls).alias("n"), acquire.discovered_id(F.col("results"), F.col("doi")).alias("pmcid"),
                    acquire.with_fallback(F.col("a"), F.col("b"), lambda x: F.startswith(x, F.lit("good"))).alias("chosen"))


@query("""with p as (select doc_id, case doc_id % 4 when 0 then 'https://creativecommons.org/licenses/by-nc/4.0/' when 1 then 'https://creativecommons.org/licenses/by/3.0/' when 2 then 'https://creativecommons.org/licenses/by-nd/4.0/' end as url,
  case when doc_id % 4 = 3 then 'Creative Commons Attribution License' end as prose from documents) select doc_id, url, prose from p""")
def printed_licences(spark, sf_dir):
    pages = _docs(spark, sf_dir, "posexplode(array('first page', case doc_id % 4 when 0 then 'see https://creativecommons.org/ licenses/by-nc/4.0/' when 2 then 'under a Creative Commons Attribution-NoDerivatives 4.0 International License' when 3 then 'Creative Commons Attribution License' else 'none' end, 'x')) as (page, text)")
    linked = pages.withColumn("links", F.when((F.col("doc_id") % 4 == 1) & (F.col("page") == 2), F.array(F.lit("http://creativecommons.org/licenses/by/3.0"))))
    return acquire.printed_licence(linked.withColumnRenamed("doc_id", "id")).withColumnRenamed("id", "doc_id")


@query("""select cast(row_number() over () - 1 as integer) as place, column_name as name, case column_type when 'BIGINT' then 'bigint' when 'VARCHAR' then 'string' end as type from (describe select doc_id, lang, n_chars from documents)""")
def store_columns(spark, sf_dir):
    return stores.catalogue(stores.subset(spark, f"{sf_dir}/documents.parquet", ["n_chars", "lang", "missing", "doc_id"]).select("doc_id", "lang", "n_chars"))


@query("""select doc_id, case when doc_id % 3 = 0 then null else cast(2000 + doc_id % 20 as integer) end as year, cast(doc_id * 0.0001 + n_chars * 0.01 as double) as cost from documents""")
def yearly_stores(spark, sf_dir):
    d = _docs(spark, sf_dir, "n_chars", "concat('/data/', case when doc_id % 3 = 0 then 'other_2001' else concat('works_', 2000 + doc_id % 20) end, '.parquet') as p")
    return d.select("doc_id", stores.year_of("p").alias("year"), pilot.costs(F.col("doc_id"), F.col("n_chars")).alias("cost"))


# --- matching


@query("""with r as (select source as doc, doc_id as ref, row_number() over (partition by source order by doc_id) - 1 as pos, cast(doc_id % 40 as varchar) as label from documents),
  c as (select source as doc, doc_id as cite, cast(doc_id % 60 as varchar) as number from documents), l as (select doc, label as number, arg_min(ref, pos) as by_label from r group by all), p as (select doc, cast(pos + 1 as varchar) as number, ref as by_place from r)
  select doc, cite, number, coalesce(by_label, by_place) as ref from c left join l using (doc, number) left join p using (doc, number)""")
def numbered_links(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    refs = order.places_within(d.select(F.col("source").alias("doc"), F.col("doc_id").alias("ref"), (F.col("doc_id") % 40).cast("string").alias("label")), ["doc"], "ref", "pos")
    cites = d.select(F.col("source").alias("doc"), F.col("doc_id").alias("cite"), (F.col("doc_id") % 60).cast("string").alias("number"))
    return matching.link_numbered(cites, refs)


@query(f"""select doc_id, case when doc_id % {len(matching.PUBLISHER_RULES) + 1} < {len(matching.PUBLISHER_RULES)} then list_extract([{', '.join("'" + r[0] + "'" for r in matching.PUBLISHER_RULES)}], cast(doc_id % {len(matching.PUBLISHER_RULES) + 1} as int) + 1) else '{matching.DEFAULT_RULE[0]}' end as slug from documents""")
def fonts_to_rules(spark, sf_dir):
    """The first font of each rule that no rule before it has."""
    hints, seen = [], set()
    for r in matching.PUBLISHER_RULES:
        hints.append(next((h for h in r[4] if h not in seen), None))
        seen |= set(r[4])
    arms = " ".join(f"when {i} then '{h}'" for i, h in enumerate(hints) if h)
    d = _docs(spark, sf_dir, f"array('Unknown', case doc_id % {len(hints) + 1} {arms} else 'Other' end) as fonts")
    return d.select("doc_id", matching.rule_by_font(F.col("fonts")).alias("slug"))


# --- gates and pilots


GATES_SQL = """v as (select doc_id, quality = 1 as validate_pass, toxic = 0 as lint_pass, cast(doc_id % 5 as integer) as errors, cast(doc_id % 3 as integer) as warnings, case when doc_id % 7 = 0 then null else doc_id % 4 <> 1 end as licence from labels)"""


def _gated(spark, sf_dir):
    """Labels as what gates print."""
    d = table(spark, sf_dir, "labels").selectExpr(
        "doc_id", "concat('checked\\n', case when quality = 1 then 'PASS' else 'FAIL' end) as v",
        "concat('ERROR M1 a.gif in ''x''\\nwarning W\\nResult: ', case when toxic = 0 then 'PASS' else 'FAIL' end, ' (', doc_id % 5, ' error(s), ', doc_id % 3, ' warning(s))') as l",
        "case when doc_id % 7 <> 0 then concat('<permissions>', case when doc_id % 4 <> 1 then 'https://creativecommons.org/licenses/by/4.0/' else '' end, '</permissions>') end as xml")
    engine = F.create_map(F.lit("validate"), F.lit("v1"))
    return d.select("doc_id", gates.record(F.element_at(F.split("v", "\n"), -1), F.col("l"), F.col("xml"), engine, F.lit("2025-03-01 10:20:30").cast("timestamp")).alias("g"))


@query(f"""with {GATES_SQL} select doc_id, validate_pass, lint_pass, errors, warnings, cast(1 as integer) as lines, coalesce(licence, false) as licence_pass,
  case when licence is null then 'unreadable article.xml' when licence then 'CC-BY (uri)' else 'no recognisable CC-BY licence' end as licence_detail, '2025-03-01T10:20:30' as checked_at, doc_id % 3 = 0 as provisional from v""")
def gate_records(spark, sf_dir):
    codes = F.array(F.struct(F.lit("42").alias("code"), F.lit("x").alias("label")), F.struct(F.when(F.col("doc_id") % 3 == 0, "4299").otherwise("4201").alias("code"), F.lit("y").alias("label")))
    return _gated(spark, sf_dir).select("doc_id", "g.validate_pass", "g.lint_pass", "g.errors", "g.warnings", F.size("g.error_lines").alias("lines"), "g.licence_pass", "g.licence_detail", "g.checked_at", gates.provisional(codes).alias("provisional"))


@query(f"""with {GATES_SQL}, a as (select *, cast(doc_id % 2 as integer) as residual, case doc_id % 6 when 0 then 'fail' when 1 then 'flag' when 2 then 'pass' end as fidelity, case when doc_id % 10 = 9 then 'a person' end as escalate, coalesce(licence, false) as lic from v),
  o as (select *, lint_pass and residual = 0 and coalesce(fidelity <> 'fail', true) as own_lint, errors + residual + cast(coalesce(fidelity = 'fail', false) as integer) as own_errors, warnings + cast(coalesce(fidelity = 'flag', false) as integer) as own_warnings from a),
  f as (select *, case when own_lint then 'complete' when doc_id % 3 > 0 then case when doc_id % 4 > 0 then 'partial' else 'none' end else 'complete' end as figures from o)
  select doc_id, case when not lic then 'failed' when escalate is not null then 'escalate' when validate_pass and own_lint then 'ingested' when validate_pass and figures in ('partial', 'none') then 'partial' else 'failed' end as ingest_status,
    validate_pass and own_lint and lic as gates_passed, figures as figures_status, cast(own_errors as integer) as err_count, cast(own_warnings as integer) as warn_count,
    case when escalate is not null then escalate when not (validate_pass and own_lint) then 'inline-math images -> ESCALATE' when not lic then 'licence not CC-BY -> FAILED' when fidelity = 'fail' then 'fidelity: low' when fidelity = 'flag' then 'fidelity flag: low' end as escalate_reason from f""")
def ingest_outcomes(spark, sf_dir):
    a = _gated(spark, sf_dir).selectExpr("cast(doc_id as string) as id", "doc_id", "concat('M-', doc_id) as mid", "g as gates", "cast(doc_id % 2 as int) as residual", "case doc_id % 6 when 0 then 'fail' when 1 then 'flag' when 2 then 'pass' end as fidelity", "'low' as fidelity_detail",
                                         "doc_id % 3 as figure_errors", "doc_id % 4 as figures", "case when doc_id % 10 = 9 then 'a person' end as escalate", "'2025' as ts")
    got = gates.ingested(a)
    return got.select(F.col("id").cast("bigint").alias("doc_id"), "ingest_status", "gates_passed", "figures_status", "err_count", "warn_count", "escalate_reason")


@query("""select doc_id, case when doc_id % 3 = 0 then 'inline-math images -> ESCALATE' when doc_id % 3 = 1 then 'ERROR in X line ' || doc_id else null end as gate, doc_id % 2 = 0 and doc_id % 5 <> 0 as lint, cast(doc_id % 4 + doc_id % 2 + cast(doc_id % 5 = 0 as int) as integer) as errors from documents""")
def failure_reasons(spark, sf_dir):
    d = _docs(spark, sf_dir, "case doc_id % 3 when 0 then array('ERROR M', 'ERROR M2 b.gif') when 1 then array(concat('ERROR in ''a b'' line ', doc_id)) else cast(array() as array<string>) end as e", "case when doc_id % 5 = 0 then 'fail' end as f")
    over = tracker.overridden(F.lit(True), (F.col("doc_id") % 4).cast("int"), F.lit(0), (F.col("doc_id") % 2).cast("int"), F.col("f"))
    reason = tracker.failure_reason(F.lit(False), F.col("e"), F.lit(True), F.lit("pass"), F.lit(None).cast("string"))
    return d.select("doc_id", F.nullif(reason, F.lit("")).alias("gate"), over["lint"].alias("lint"), over["errors"].alias("errors"))


def _manifest(spark, sf_dir):
    return table(spark, sf_dir, "labels").selectExpr("concat('W', case when doc_id % 9 = 0 then doc_id + 500000000 else doc_id end) as id", "concat('p', doc_id % 4) as slug", "concat('Manifest ', doc_id % 4) as publisher", "concat('/files/p', doc_id % 4, '/W', doc_id, '.pdf') as path", "quality", "toxic", "doc_id")


@query(f"""{WORKS_SQL}, m as (select 'W' || case when doc_id % 9 = 0 then doc_id + 500000000 else doc_id end as id, 'p' || (doc_id % 4) as slug, 'Manifest ' || (doc_id % 4) as publisher, quality, toxic, doc_id from labels),
  n as (select *, row_number() over (order by slug, id) - 1 as k from m)
  select n.id, slug, case when w.id is null then n.publisher else w.publisher end as publisher, w.journal, concat('MORE-2025-99', lpad(cast(k as varchar), cast(greatest(4, length(cast(k as varchar))) as integer), '0')) as mid from n left join works w using (id)""")
def pilot_rows(spark, sf_dir):
    m = _manifest(spark, sf_dir)
    got = pilot.pilot(m.select("id", "slug", "publisher"), works(spark, sf_dir), m.selectExpr("id", "quality = 1 as validate", "toxic = 0 as lint", "toxic as errors", "quality as warnings").where(F.lit(False)), m.selectExpr("id", "'' as message"))
    return got["results"].select("id", "slug", "publisher", "journal", "mid")


@query("""select 'p' || (doc_id % 4) as slug, count(*) as n, count(*) filter (where quality = 1 and doc_id % 5 > 0) as validate_pass, count(*) filter (where toxic = 0 and doc_id % 5 > 0) as lint_pass, cast(sum(case when doc_id % 5 > 0 then toxic * 3 else 0 end) as bigint) as errors, cast(sum(case when doc_id % 5 > 0 then quality else 0 end) as bigint) as warnings from labels group by 1""")
def pilot_publishers(spark, sf_dir):
    m = _manifest(spark, sf_dir)
    verdicts = m.selectExpr("case when doc_id % 5 > 0 then id else concat(id, 'x') end as id", "quality = 1 as validate", "toxic = 0 as lint", "cast(toxic * 3 as int) as errors", "cast(quality as int) as warnings")
    return pilot.pilot(m.select("id", "slug", "publisher"), works(spark, sf_dir), verdicts, m.selectExpr("id", "'' as message"))["publishers"]


@query("""with k as (select 'p' || (doc_id % 4) as slug, 'ref N ' || chr(cast(97 + doc_id % 11 as int)) || ' in N' as kind, count(*) as n from labels group by all) select slug, kind, n, row_number() over (partition by slug order by n desc, kind) as place from k qualify place <= 8""")
def pilot_kinds(spark, sf_dir):
    m = _manifest(spark, sf_dir)
    findings = m.selectExpr("id", "concat('ref b', doc_id, ' ', chr(97 + doc_id % 11), ' in 7:', doc_id) as message")
    return pilot.pilot(m.select("id", "slug", "publisher"), works(spark, sf_dir), m.selectExpr("id", "true as validate", "true as lint", "0 as errors", "0 as warnings"), findings)["kinds"]


@query("""select 'W' || doc_id as id, 'p' || (doc_id % 4) as slug, toxic = 0 as lint_pass from labels where doc_id % 9 > 0 and doc_id % 5 > 0 and doc_id % 7 > 0 and doc_id % 11 > 0""")
def measurable_pairs(spark, sf_dir):
    """Report x manifest x files: some ids are in no manifest, some files aren't there."""
    m = _manifest(spark, sf_dir)
    report = m.selectExpr("concat('W', doc_id) as id", "slug", "concat('M', doc_id) as mid", "toxic = 0 as lint_pass", "doc_id")
    files = m.selectExpr("explode(array(case when doc_id % 5 > 0 then path end, case when doc_id % 7 > 0 then concat('/files/', slug, '/W', doc_id, '.grobid.xml') end, case when doc_id % 11 > 0 then concat('/out/M', doc_id, '/article.xml') end)) as path").where("path is not null")
    return pilot.measurable(report.drop("doc_id"), m.select("id", "path"), files).select("id", "slug", "lint_pass")


@query("""select source as folder, count(*) as files, cast(sum(n_chars) as bigint) as bytes from documents group by 1""")
def folder_footprint(spark, sf_dir):
    return pilot.footprint(table(spark, sf_dir, "documents").selectExpr("source as folder", "n_chars as bytes"))


@query("""select source as slug, count(*) as n, median(cast(n_chars % 997 as double)) as median, cast(min(n_chars % 997) as double) as least from documents where doc_id % 3 > 0 group by 1""")
def slug_completeness(spark, sf_dir):
    return pilot.completeness_by(table(spark, sf_dir, "documents").selectExpr("source as slug", "doc_id % 3 > 0 as lint_pass", "cast(n_chars % 997 as double) as completeness"))


@query(f"""{LOG_SQL} select ingest_status, count(*) as n from logged group by 1""")
def logged_statuses(spark, sf_dir):
    return logged(spark, sf_dir).groupBy("ingest_status").agg(F.count(F.lit(1)).alias("n"))


@query("""select 'W' || (doc_id // 10) as id, doc_id as place, 'm' || doc_id as member from documents where doc_id % 2 = 0""")
def archive_links(spark, sf_dir):
    """Names that articles link, kept where the archive has them."""
    d = table(spark, sf_dir, "documents")
    links = d.selectExpr("concat('W', doc_id div 10) as id", "'a.zip' as path", "doc_id", "concat('m', doc_id) as name").groupBy("id", "path").agg(F.array_sort(F.collect_list(F.struct("doc_id", "name"))).alias("x")).select("id", "path", F.col("x.name").alias("names"))
    members = d.selectExpr("'a.zip' as path", "case when doc_id % 2 = 0 then concat('m', doc_id) end as member")
    return documents.linked_members(links, members).select("id", F.substring("member", 2, 20).cast("bigint").alias("place"), "member")


@query("""select doc_id, case when doc_id % 2 = 0 then 'fidelity,lint,validate' else 'lint,validate' end as gates, cast(case when doc_id % 2 = 0 then 3 else 2 end as integer) as n from documents""")
def engine_stamps(spark, sf_dir):
    d = _docs(spark, sf_dir, "map('validate', 'v1', 'lint', 'l2', 'fidelity', 'f1') as engine")
    s = d.select("doc_id", lineage.stamp(F.col("engine"), F.col("doc_id") % 2 == 0).alias("s"))
    return s.select("doc_id", F.array_join(F.array_sort(F.map_keys("s")), ",").alias("gates"), F.size("s").alias("n"))


@query("""select 'W' || doc_id as id, 'W' || doc_id as work_id, cast(doc_id % 5 as integer) as n_assets, cast(doc_id % 3 as integer) as err_count, cast(0 as integer) as warn_count, doc_id % 2 = 0 and doc_id % 7 > 0 as both_pass, lang as route from documents""")
def sidecar_records(spark, sf_dir):
    """Nested records made of flat columns, and read back by path."""
    rows = _docs(spark, sf_dir, "lang", "concat('W', doc_id) as id", "concat('M', doc_id) as mid", "'10.1/x' as doi", "'J' as journal", "'T' as title", "lang as route", "'B' as lane", "'oa' as asset_route", "doc_id % 2 = 0 as validate", "doc_id % 7 > 0 as lint",
                 "cast(doc_id % 3 as int) as errors", "0 as warnings", "cast(doc_id % 5 as int) as n_assets", "'publisher' as asset_source", "map('crosswalk', 1) as pipeline")
    found = records.sidecar_fields(lineage.sidecar(rows), more={"both_pass": ("$.gates.both_pass", "boolean"), "route": ("$.route.route", "string")})
    return found.select("id", *records.SIDECAR, "both_pass", "route")


# --- articles


CROSSWALK_SQL = r"""with d as (select doc_id, doc_id % 3 as k, len(list_filter(string_split(text, chr(10)), lambda x: trim(x) <> '')) as n from documents)
  select cast(doc_id as varchar) as id, 'T ' || doc_id as title, cast(1 + n as bigint) as paragraphs, cast(k = 0 as bigint) as contributors, cast(1 as bigint) as refs, cast(1 as bigint) as links, 'MORE-' || doc_id as manuscript, k = 0 as licensed,
    case when k = 0 then 'b1' when k = 1 then 'b0' else 'bib1' end as target from d"""


@query(CROSSWALK_SQL)
def crosswalk_structure(spark, sf_dir):
    """Articles of three vocabularies, brought to the house form, counted by patterns over its text."""
    got = documents.crosswalk(documents.sample_articles(table(spark, sf_dir, "documents"))).select("id", "article")
    n = lambda p: F.regexp_count("article", F.lit(p)).cast("bigint")
    one = lambda p: F.regexp_extract("article", p, 1)
    return got.select("id", one("<article-title>(.*?)</article-title>").alias("title"), n("<p>").alias("paragraphs"), n("<contrib [^>]*>").alias("contributors"), n("<ref id=").alias("refs"), n('<xref ref-type="bibr"').alias("links"),
                      one('<article-id pub-id-type="manuscript-id">(.*?)</article-id>').alias("manuscript"), F.contains("article", F.lit('license-type="creative-commons"')).alias("licensed"), one('<ref id="([^"]*)"').alias("target"))


@query("""select cast(doc_id as varchar) as id, case when doc_id % 4 = 3 then null else 'Title ' || doc_id end as title, case when doc_id % 4 = 3 then null else cast(2 as bigint) end as paragraphs from documents""")
def damaged_articles(spark, sf_dir):
    """Articles that are cut, or closed wrongly: what can be told of them is read; what has no element is an error row."""
    xml = """case doc_id % 4 when 0 then concat('<article><front><article-meta><title-group><article-title>Title ', doc_id, '</article-title></title-group></article-meta></front><body><sec><p>a &nbsp; b</p><p>cut <b>here')
      when 1 then concat('<article><front><article-meta><title-group><article-title>Title ', doc_id, '</article-title></title-group></article-meta></front><body><sec><p>a</i></p><p>1 < 2</p></sec></article>')
      when 2 then concat('<article><front><article-meta><title-group><article-title>Title ', doc_id, '</article-title></title-group></article-meta></front><body><sec><p>a</p><p>b</p></sec></body></article>') else 'no element' end"""
    s = _docs(spark, sf_dir, f"{xml} as xml").selectExpr("doc_id as id", "xml", "'jats' as kind", "concat('M-', doc_id) as mid", "'{}' as meta", "cast(null as array<struct<code:string,label:string>>) as codes", "cast(array() as array<string>) as assets")
    got = documents.crosswalk(s)
    return got.select("id", F.when(F.col("article").isNotNull(), F.regexp_extract("article", "<article-title>(.*?)</article-title>", 1)).alias("title"), F.regexp_count("article", F.lit("<p>")).cast("bigint").alias("paragraphs"))


def _articles(spark, sf_dir, xml: str, kind: str, meta: str = "'{}'"):
    """One article for each document, its text made of SQL text, brought to the house form."""
    s = _docs(spark, sf_dir, f"{xml} as xml", f"{meta} as meta").selectExpr("doc_id as id", "xml", f"'{kind}' as kind", "concat('M-', doc_id) as mid", "meta", "cast(null as array<struct<code:string,label:string>>) as codes", "array('a.jpg') as assets")
    return documents.crosswalk(s)


def _n(pattern: str):
    return F.regexp_count("article", F.lit(pattern)).cast("bigint")


@query("""select cast(doc_id as varchar) as id, cast(2 + doc_id % 2 as bigint) as inline, cast(1 as bigint) as display, case when doc_id % 3 = 0 then cast(2 as bigint) else cast(1 as bigint) end as links, 'GeV' || doc_id as tex, true as plain, 'Mass α' || (doc_id % 9) as caption, 'On β in ' || lang as title from documents""")
def latex_articles(spark, sf_dir):
    """Formulas, citations and captions written as LaTeX."""
    xml = r"""concat('<article><front><article-meta><title-group><article-title>On $\\beta$ in ', lang, '</article-title></title-group></article-meta></front><body><sec><p>By \\cite{b1, z9} where \\[ \\GeV', ' ', doc_id, ' \\] and $x_', doc_id, '$ or \\(y\\)',
      case when doc_id % 2 = 1 then ' $z$' else '' end, case when doc_id % 3 = 0 then ' \\citep{b1}' else '' end, '</p><fig id="f"><caption><p>Mass $\\alpha', ' $', doc_id % 9, '</p></caption></fig></sec></body><back><ref-list><ref id="b1"><mixed-citation>R</mixed-citation></ref></ref-list></back></article>')"""
    got = _articles(spark, sf_dir, xml, "jats")
    one = lambda p: F.regexp_extract("article", p, 1)
    return got.select("id", _n("<inline-formula>").alias("inline"), _n("<disp-formula>").alias("display"), _n('<xref ref-type="bibr" rid="b1">').alias("links"), F.replace(one("<disp-formula><tex-math>([^<]*)</tex-math>"), F.lit(" "), F.lit("")).alias("tex"),
                      (F.regexp_count("article", F.lit(r"\\cite")) == 0).alias("plain"), F.replace(one("<caption><p>([^<]*)</p>"), F.lit(" "), F.lit("")).alias("caption"), one("<article-title>([^<]*)<").alias("title")).withColumn("caption", F.concat(F.lit("Mass "), F.substring("caption", 5, 9)))


@query("""select cast(doc_id as varchar) as id, case when doc_id % 2 = 0 then 'b0' end as by_name, 'fg' as figure, case when doc_id % 3 < 2 then 'b' || (doc_id % 3) end as by_number, cast(1 as bigint) as apps, 'Money ' || doc_id as funding, case when doc_id % 4 = 0 then '1.2' end as label, 'Kept' as journal from documents""")
def tei_articles(spark, sf_dir):
    """References by name and year and by number, figures, annexes and headings of another vocabulary."""
    xml = """concat('<TEI xmlns="http://www.tei-c.org/ns/1.0"><teiHeader><fileDesc><titleStmt><title type="main">T</title></titleStmt></fileDesc></teiHeader><text><body><div><head>', case when doc_id % 4 = 0 then '1.2. ' else '' end, 'Intro</head>',
      '<p>See <ref type="bibr">(', case when doc_id % 2 = 0 then 'Smith' else 'Nobody' end, ' et al., 2020)</ref> and <ref type="figure">Fig. 1</ref> or <ref type="bibr">[', doc_id % 3 + 1, ']</ref></p></div><figure xml:id="fg"><head>Figure 1</head></figure></body>',
      '<back><div type="funding"><div><p>Money ', doc_id, '</p></div></div><div type="annex"><div><head>Appendix A</head><p>x</p></div><div><head>.1</head><p>y</p></div></div><listBibl><biblStruct xml:id="b0">Smith 2020</biblStruct><biblStruct xml:id="b1">Roe 2001</biblStruct></listBibl></back></text></TEI>')"""
    got = _articles(spark, sf_dir, xml, "tei", """'{"journal": "Kept", "reference_style": "numbered", "headings_numbered": true}'""")
    one = lambda p: F.nullif(F.regexp_extract("article", p, 1), F.lit(""))
    return got.select("id", one('rid="([^"]*)">Smith').alias("by_name"), one('ref-type="fig" rid="([^"]*)"').alias("figure"), one('rid="([^"]*)">[123]<').alias("by_number"), _n("<app[ >]").alias("apps"), one("<funding-statement>([^<]*)<").alias("funding"),
                      one("<sec[^>]*><label>([^<]*)</label><title>Intro").alias("label"), one("<journal-title>([^<]*)<").alias("journal"))


@query("""select doc_id, 'a.png|b' || (doc_id % 5) || '.gif' as images, case when doc_id % 2 = 0 then 'data' || doc_id || '.csv' else '' end as extra, cast(case when doc_id % 3 = 0 then 2 else 3 end as integer) as stubs from documents""")
def linked_files(spark, sf_dir):
    """Images and other files that an article links, each once and in order."""
    d = _docs(spark, sf_dir, """concat('<a><graphic xlink:href="x/a.png"/><inline-graphic href="a.png"/><graphic href="b', doc_id % 5, '.gif"/><media href="http://elsewhere.org/m.mp4"/><supplementary-material href="a.png"/>',
      case when doc_id % 2 = 0 then concat('<supplementary-material xlink:href="s/data', doc_id, '.csv"/>') else '' end, case when doc_id % 3 = 0 then '<graphic href="../out.png"/>' else '<graphic href="y/a.png"/>' end, '</a>') as xml""")
    return d.select("doc_id", F.array_join(F.filter(documents.image_links("xml"), lambda x: x != "out.png"), "|").alias("images"), F.array_join(documents.extra_links("xml"), "|").alias("extra"), F.size(documents.figure_stubs("xml")).alias("stubs"))


@query(f"""{LOG_SQL} select id, ingest_status, gates_passed, figures_status, escalate_reason, ingest_mid, ingest_ts from logged""")
def parsed_logs(spark, sf_dir):
    """The outcome log as it is kept, JSON maps by work id, read back as rows."""
    rows = logged(spark, sf_dir).withColumnsRenamed({"ingest_mid": "mid", "ingest_ts": "ts"})
    entry = F.struct("ingest_status", "gates_passed", "figures_status", "escalate_reason", "mid", "ts")
    files = rows.groupBy(F.pmod(F.xxhash64("id"), F.lit(1 << 40)).alias("file")).agg(F.to_json(F.map_from_entries(F.collect_list(F.struct("id", entry)))).alias("value"))
    return records.outcome_rows(files.select("value"))


@query(f"""{WORKS_SQL} select id, license, in_pmc, cast(null as boolean) as has_pdf, cast(year as integer) as year from works""")
def pinned_types(spark, sf_dir):
    """Columns that were inferred as JSON text, or as nothing, given their types."""
    w = works(spark, sf_dir).select("id", F.when(F.col("license").isNotNull(), F.concat(F.lit('"'), "license", F.lit('"'))).alias("license"), F.col("in_pmc").cast("string").alias("in_pmc"), F.lit("junk").alias("has_pdf"), F.col("year").cast("string").alias("year"))
    return records.pin_types(w, {"license": "string", "in_pmc": "boolean", "has_pdf": "boolean", "year": "int"})


@query(f"""{ROUTED_SQL} select id, case scoap3 when 'aps' then 0 when 'other' then 1 end as scoap3_arm, case when license = 'cc-by' and lane in ('C_ingest', 'Cprime_transform') then 0 when license in ('cc-by', 'cc-by-sa', 'public-domain', 'cc0') then 1 end as disposition_arm from routed""")
def fired_rules(spark, sf_dir):
    """Which arm of a table decided."""
    table_of = {t.column: t for t in rules.tables()}
    r = rules.route_works(works(spark, sf_dir))
    scoap3 = table_of["scoap3"].fired()
    last_aps = max(i for i, a in enumerate(table_of["scoap3"].arms) if a.then == "aps")
    return r.select("id", F.when(scoap3.isNotNull(), (scoap3 > last_aps).cast("int")).alias("scoap3_arm"), table_of["disposition"].fired().alias("disposition_arm"))
