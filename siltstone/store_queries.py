"""Queries over stores that change: filters sent to a store, tables compared, judgements brought up to date, the kept tracker. Part of the catalogue in ``queries``."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql.datasource import EqualTo, GreaterThan, In

from .functions.sql import register
from .operators import changes, kept, tracker
from .queries import LOG_SQL, ROUTED_SQL, WORKS_SQL, logged, query, routed
from .scratch import scratch
from .sources import acquire, ranged, records, stores
from .sources.records import OUTCOME_COLUMNS
from .standin import table, works

STORE = "id string, doi string, year bigint, license string, is_oa boolean"


@query(f"{WORKS_SQL} select id, doi, year, license, is_oa from works where year in (2022, 2024) and license = 'cc-by' and is_oa and doi > '10.12'")
def pushed_store(spark, sf_dir):
    """Works landed as a store of pages, read back with filters that the store applies, and one that it has no words for."""
    path = scratch(spark)
    stores.land(works(spark, sf_dir).select("id", "doi", "year", "license", "is_oa"), path, "year")
    asked = [In(("year",), (2022, 2024)), EqualTo(("license",), "cc-by"), EqualTo(("is_oa",), True), GreaterThan(("doi",), "10.12")]
    return stores.read_store(spark, "siltstone.sources.stores:fetch_landed", STORE, {"year": "by", "license": "license", "is_oa": "is_oa"}, asked, path, "year", list(range(2021, 2026)))


CHANGED_SQL = """with a as (select doc_id, lang, n_chars from documents), b as (select doc_id, case when doc_id % 50 = 7 then null else lang end as lang, case when doc_id % 40 = 3 then n_chars + 1 else n_chars end as n_chars from documents
  where doc_id % 100 <> 4 union all select doc_id, lang, n_chars from documents where doc_id % 100 = 11)"""


@query(f"""{CHANGED_SQL}, x as (select *, 1 as s from a union all select *, -1 from b)
  select doc_id, lang, n_chars, case when sum(s) > 0 then 'a' else 'b' end as side, cast(abs(sum(s)) as bigint) as times from x group by all having sum(s) <> 0""")
def changed_rows(spark, sf_dir):
    """A table and a version of it with rows changed, gone, new and repeated: what differs, by the digests of buckets."""
    a = table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars")
    b = a.where("doc_id % 100 <> 4").selectExpr("doc_id", "if(doc_id % 50 = 7, null, lang) as lang", "if(doc_id % 40 = 3, n_chars + 1, n_chars) as n_chars")
    return changes.changed_rows(a, b.unionByName(a.where("doc_id % 100 = 11")), ["doc_id"])


@query(r"""with v as (select doc_id as id, case when doc_id % 100 = 5 then text || ' again' else text end as text, lang from documents where doc_id % 97 <> 0)
  select id, length(text) as chars, lang = 'en' as english, doc_id_again as judged_again, substring(sha256('length=2' || chr(10) || sha256(text)), 1, 16) as mark from (select *, id % 100 = 5 or id % 89 = 2 as doc_id_again from v)""")
def rejudged(spark, sf_dir):
    """Judgements of documents, brought up to date after some changed, some went and some came: only these are judged again."""
    path, d = scratch(spark), table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "text", "lang")

    def judge(again: bool):
        return lambda rows: rows.select("id", F.length("text").cast("bigint").alias("chars"), (F.col("lang") == "en").alias("english"), F.lit(again).alias("judged_again"))

    def marked(rows):
        return rows.withColumn("mark", changes.mark_of("text", {"length": 2}))

    changes.rejudge(marked(d.where("id % 89 <> 2")), judge(False), path, buckets=32)
    now = d.where("id % 97 <> 0").withColumn("text", F.when(F.col("id") % 100 == 5, F.concat("text", F.lit(" again"))).otherwise(F.col("text")))
    changes.rejudge(marked(now), judge(True), path, buckets=32)
    return changes.judged(spark, path).select("id", "chars", "english", "judged_again", "mark")


@query(f"""{LOG_SQL}, seed as (select *, case when lane = 'out_of_scope' then 'out_of_scope' else 'pending' end as seeded from routed)
  select s.id, s.route, case when l.id is null then seeded else l.ingest_status end as ingest_status, l.gates_passed, l.figures_status, l.escalate_reason, l.ingest_mid, l.ingest_ts from seed s left join logged l using (id)""")
def kept_overlay(spark, sf_dir):
    """The tracker kept by buckets of its id, with outcomes laid over it where it is."""
    name = f"kept_{uuid.uuid4().hex}"
    kept.keep(tracker.seeded(routed(spark, sf_dir)), name, 16, scratch(spark))
    return kept.overlaid(spark, name, logged(spark, sf_dir)).select("id", "route", *OUTCOME_COLUMNS)


# --- SQL alone


@query(f"{ROUTED_SQL} select id, scoap3, route, route_access, asset_route, lane, disposition, coalesce(substring(trim(regexp_replace(lower(publisher), '[^a-z0-9]+', '-', 'g'), '-'), 1, 40), 'unknown') as slug from routed")
def sql_routes(spark, sf_dir):
    """The rule tables as functions of SQL."""
    register(spark)
    return spark.sql("""
        select id, scoap3_of(journal) as scoap3, route_of(license, in_pmc, scoap3, journal, publisher) as route, route_access_of(route) as route_access, asset_route_of(route, pdf_url, has_pdf) as asset_route,
               lane_of(route) as lane, disposition_of(license, lane) as disposition, slug_of(publisher) as slug from {w}""", w=works(spark, sf_dir))


@query(f"""{WORKS_SQL}, v as (select id, [doi, case when doi like '10.1103/physrevd.%' then replace(doi, 'physrevd', 'PhysRevD') end, case when regexp_matches(doi, '^10\\.1007/jhep[0-9]+\\([0-9]+\\)[0-9]+$') then replace(doi, 'jhep', 'JHEP') end] as vs from works where doi is not null),
  f as (select id, list_filter(vs, lambda x: x is not null) as vs from v) select id, unnest(vs) as spelling, cast(unnest(range(len(vs))) as integer) as place from f""")
def sql_spellings(spark, sf_dir):
    """Spellings of identifiers by a table function, beside each work."""
    register(spark)
    return spark.sql("select w.id, s.spelling, s.place from {w} w, lateral doi_spellings(w.doi) s where w.doi is not null", w=works(spark, sf_dir))


# --- sidecars and archives


@query("""select lang as folder, count(*) as files, count(*) filter (where doc_id % 9 = 4) as bad, count(*) filter (where doc_id % 9 <> 4 and doc_id % 5 <> 2) as of_works, cast(sum(case when doc_id % 9 = 4 or doc_id % 5 = 2 or doc_id % 7 = 1 then 0 else doc_id % 40 end) as bigint) as assets from documents group by 1""")
def corrupt_sidecars(spark, sf_dir):
    """Sidecars of which some are cut, lack a field or hold another type: what is there is read, and the bad ones are counted."""
    text = """case when doc_id % 9 = 4 then concat('{"identity": {"work_id": "W', doc_id) else concat('{"identity": {', case when doc_id % 5 = 2 then '' else concat('"work_id": "W', doc_id, '"') end, '}, "assets": {"count": ',
      case when doc_id % 7 = 1 then '"many"' else cast(doc_id % 40 as string) end, '}, "more": [1, {"x": null}]}') end"""
    rows = records.sidecar_fields(table(spark, sf_dir, "documents").selectExpr("lang as folder", f"{text} as sidecar"))
    of_work = F.col("work_id").isNotNull()
    return rows.groupBy("folder").agg(F.count(F.lit(1)).alias("files"), F.count_if("bad").alias("bad"), F.count_if(of_work).alias("of_works"), F.coalesce(F.sum(F.when(of_work, F.col("n_assets"))), F.lit(0)).cast("bigint").alias("assets"))


@query("""select 'b' || (doc_id // 200) as archive, 'd/' || doc_id || '.txt' as name, octet_length(encode(text)) as bytes, sha256(text) as sha256 from documents where doc_id % 3 > 0""")
def archived_members(spark, sf_dir):
    """Whole documents put in archives, and some of the members read back by their ranges."""
    d = table(spark, sf_dir, "documents").selectExpr("concat('b', doc_id div 200) as archive", "concat('d/', doc_id, '.txt') as member", "encode(text, 'UTF-8') as content")
    path = scratch(spark)
    ranged.write_archives(d, f"{path}/archives").write.parquet(f"{path}/list")
    made = spark.read.parquet(f"{path}/list")
    wanted = ranged.member_index(made).where("cast(regexp_extract(name, '([0-9]+)', 1) as bigint) % 3 > 0")
    got = ranged.read_ranges(wanted).where("error is null")
    archive = F.regexp_extract("path", "([^/]+)-[0-9a-f]+[.]tar$", 1)
    return got.select(archive.alias("archive"), "name", F.octet_length("content").cast("bigint").alias("bytes"), F.sha2("content", 256).alias("sha256"))


@query(f"""{WORKS_SQL}, d as (select doc_id, doc_id % 3 > 0 as has, doc_id % 2 = 0 as printed from documents)
  select doc_id, case when has then 'x' || doc_id || '.xml' end as xml, 'p' || doc_id || '.pdf' as pdf, case when printed then '2401.' || lpad(cast(doc_id % 100000 as varchar), 5, '0') end as eprint, case when doc_id % 4 = 0 then 'http://a/b' || doc_id || '.ft.xml' end as body from d""")
def file_records(spark, sf_dir):
    """What a repository's records and a header's references lead to: files by identifier and type, preprint numbers, bodies kept apart."""
    raw = """concat('[{"dois": ["10.1/other"], "files": [{"file": "o.xml", "filetype": "xml"}]}, {"dois": ["10.1/A', doc_id, '"], "files": [{"file": "p', doc_id, '.pdf", "filetype": "pdf"}', case when doc_id % 3 > 0 then concat(', {"file": "x', doc_id, '.xml", "filetype": "xml"}') else '' end,
      ']', case when doc_id % 2 = 0 then concat(', "eprints": ["10.1/a", "2401.', lpad(cast(doc_id % 100000 as string), 5, '0'), '"]') else ', "eprints": ["n/a"]' end, '}]')"""
    header = "case when doc_id % 4 = 0 then concat('<Header><BodyRef FileRef=\"http://a/b', doc_id, '.ft.xml\"/></Header>') else concat('<article/><BodyRef FileRef=\"http://a/b', doc_id, '.ft.xml\"/>') end"
    d = table(spark, sf_dir, "documents").selectExpr("doc_id", f"{raw} as raw", f"{header} as header").withColumn("records", F.from_json("raw", acquire.RECORDS))
    doi = F.concat(F.lit("10.1/a"), "doc_id")
    return d.select("doc_id", acquire.pick_file(F.col("records"), doi, "xml").alias("xml"), acquire.pick_file(F.col("records"), doi, "pdf").alias("pdf"), acquire.eprint(F.col("records")).alias("eprint"), acquire.body_reference("header").alias("body"))


@query(f"""{WORKS_SQL}, u as (select id, case when doi like '10.1371/%' then 1 when doi like '10.7554/%' then 1 when doi like '10.12688/%' then 1 when doi like '10.7717/%' then 1 when doi like '10.1098/%' then 1 when doi like '10.3390/%' then 1 when doi like '10.3389/%' and journal is not null then 1 else 0 end as n from works)
  select id, cast(n as integer) as addresses from u""")
def text_addresses(spark, sf_dir):
    """How many addresses there are to ask for a work's text."""
    return works(spark, sf_dir).select("id", F.size(acquire.text_addresses()).alias("addresses"))
