"""The catalogue of queries: each callable takes (spark, sf_dir); beside it, equivalent SQL for DuckDB.

The SQL is written by hand from the rules, not made by the code that it checks.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import text as T
from .functions.latex import clean_text
from .operators import changes, documents, fidelity, lineage, matching, reports, selection, tracker
from .operators.spread import spread
from .plans import rules
from .sources import acquire
from .sources.records import OUTCOME_COLUMNS
from .standin import OUTCOMES, WORKS, columns, outcomes, table, works

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f
    return add


def _in(column: str, values: list[str]) -> str:
    return f"{column} in (" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + ")"


def _like(*patterns: str) -> str:
    return "(" + " or ".join(f"lower(journal) like '{p}'" for p in patterns) + ")"


WORKS_SQL = f"with works as (select {WORKS} from documents)"
ROUTED_SQL = f"""{WORKS_SQL}, r1 as (
  select *, case when {_like('physical review. d%', 'physical review d%', 'physical review. c%', 'physical review c%', 'physical review letters%')} then 'aps'
    when {_like('%high energy physics%', '%european physical journal c%', '%physics letters b%', '%nuclear physics b%', '%chinese physics c%', '%theoretical and experimental physics%', '%acta physica polonica b%')} then 'other' end as scoap3 from works
), r2 as (
  select *, case when license is null or license <> 'cc-by' then 'out_of_scope' when in_pmc then 'pmc' when scoap3 = 'aps' then 'scoap3_aps'
    when scoap3 = 'other' and lower(journal) like '%high energy physics%' then 'scoap3_jhep' when scoap3 = 'other' and lower(journal) like '%european physical journal c%' then 'springer_oa_api'
    when scoap3 = 'other' and (lower(journal) like '%physics letters b%' or lower(journal) like '%nuclear physics b%') then 'scoap3_elsevier' when scoap3 = 'other' then 'scoap3_other'
    when {_in('publisher', rules.SPRINGER)} then 'springer_oa_api' when {_in('publisher', rules.NATIVE_OPEN)} then 'jats_native_open' when {_in('publisher', rules.ELSEVIER)} then 'elsevier_entitlement'
    when {_in('publisher', rules.GATED)} then 'gated_commercial' when publisher is null or {_in('publisher', rules.REPOSITORY)} then 'repository' else 'convert' end as route from r1
), r3 as (
  select *, case when route in ('pmc', 'scoap3_aps', 'scoap3_other', 'scoap3_jhep', 'scoap3_elsevier', 'jats_native_open') then 'open' when route = 'springer_oa_api' then 'free_key'
      when route = 'elsevier_entitlement' then 'entitlement' when route = 'gated_commercial' then 'gated' when route = 'repository' then 'repository' when route = 'convert' then 'none' else 'na' end as route_access,
    case when route = 'pmc' then 'publisher_package' when route like 'scoap3%' then 'repo_pdf' when route = 'elsevier_entitlement' then 'entitlement_pdf'
      when route in ('jats_native_open', 'springer_oa_api') and pdf_url is not null then 'oa_pdf' when route in ('jats_native_open', 'springer_oa_api') then 'publisher_urls'
      when route in ('gated_commercial', 'repository', 'convert') and (pdf_url is not null or has_pdf) then 'pdf_extract_laneB' when route = 'out_of_scope' then 'na' else 'none' end as asset_route,
    case when route in ('pmc', 'scoap3_aps', 'scoap3_jhep', 'jats_native_open', 'springer_oa_api') then 'C_ingest' when route in ('scoap3_elsevier', 'scoap3_other', 'elsevier_entitlement') then 'Cprime_transform'
      when route in ('gated_commercial', 'repository', 'convert') then 'B_convert' else 'out_of_scope' end as lane from r2
), routed as (
  select *, case when license = 'cc-by' and lane in ('C_ingest', 'Cprime_transform') then 'automated' when license in ('cc-by', 'cc-by-sa', 'public-domain', 'cc0') then 'convert_vor' else 'source_aam' end as disposition from r3
)"""
OUTCOMES_SQL = f", outcomes as (select {OUTCOMES} from labels)"
STATUS_SQL = "case when not licence then 'failed' when coalesce(escalate, '') <> '' then 'escalate' when validate and lint then 'ingested' when validate and not lint and figures_status in ('partial', 'none') then 'partial' else 'failed' end"


def routed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.route_works(works(spark, sf_dir))


def logged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outcomes as log rows."""
    o = outcomes(spark, sf_dir)
    status = tracker.status_of(F.col("licence"), F.col("escalate"), F.col("validate"), F.col("lint"), F.col("figures_status"))
    return o.select("id", status.alias("ingest_status"), F.when(F.col("figures") != 5, F.col("validate") & F.col("lint")).alias("gates_passed"), "figures_status",
                    F.col("escalate").alias("escalate_reason"), F.col("mid").alias("ingest_mid"), F.concat(F.lit("2025-01-0"), F.col("figures") + 1).alias("ingest_ts"))


LOG_SQL = f"""{ROUTED_SQL}{OUTCOMES_SQL}, logged as (select id, {STATUS_SQL} as ingest_status, case when figures <> 5 then validate and lint end as gates_passed, figures_status,
  escalate as escalate_reason, mid as ingest_mid, concat('2025-01-0', figures + 1) as ingest_ts from outcomes)"""


# --- the router


@query(f"{ROUTED_SQL} select id, scoap3, route, route_access, asset_route, lane, disposition from routed")
def route_works(spark, sf_dir):
    return routed(spark, sf_dir).select("id", *rules.DERIVED)


@query(f"{ROUTED_SQL} select lane, count(*) as n, round(100.0 * cast(count(*) as double) / sum(count(*)) over (), 1) as pct from routed group by lane")
def route_lane_share(spark, sf_dir):
    return reports.lane_share(routed(spark, sf_dir))


@query(f"{ROUTED_SQL} select route, any_value(route_access) as route_access, count(*) as n from routed group by route")
def route_counts(spark, sf_dir):
    return reports.routes(routed(spark, sf_dir))


@query(f"{ROUTED_SQL} select route_access, count(*) as n from routed where license = 'cc-by' group by 1")
def route_access_counts(spark, sf_dir):
    return reports.access(routed(spark, sf_dir))


@query(f"{ROUTED_SQL} select coalesce(publisher, '(none)') as publisher, count(*) as n, count(*) filter (where has_grobid) as with_tei from routed group by 1 order by n desc, 1 limit 20")
def publisher_top20(spark, sf_dir):
    return reports.publishers(routed(spark, sf_dir))


@query(f"{WORKS_SQL} select coalesce(license, '(non-OA/none)') as license, count(*) as n from works group by 1 order by n desc, 1 limit 12")
def license_mix(spark, sf_dir):
    return reports.counts_by(works(spark, sf_dir), "license", "(non-OA/none)", 12)


@query(f"""{WORKS_SQL} select count(*) as works, count(*) filter (where is_oa) as oa, count(*) filter (where license = 'cc-by') as cc_by, count(*) filter (where license = 'cc-by' and version = 'publishedVersion') as vor,
  count(*) filter (where license = 'cc-by' and has_grobid) as with_tei, count(*) filter (where license = 'cc-by' and has_pdf) as with_pdf from works""")
def landscape(spark, sf_dir):
    return reports.landscape(works(spark, sf_dir))


@query(f"""{WORKS_SQL}, f as (select 'journal' as facet, coalesce(journal, '(none)') as value from works where is_oa union all select 'version', coalesce(version, '(none)') from works where is_oa
  union all select 'license', coalesce(license, '(none)') from works where is_oa union all select 'year', cast(year as varchar) from works where is_oa),
  n as (select facet, value, count(*) as n from f group by all) select facet, value, n, row_number() over (partition by facet order by n desc, value) as place from n qualify place <= 10""")
def facets(spark, sf_dir):
    return reports.facets(works(spark, sf_dir))


@query(f"{ROUTED_SQL} select id, route, disposition from routed where license = 'cc-by' and version = 'publishedVersion' and has_pdf")
def ccby_vor(spark, sf_dir):
    return tracker.published(routed(spark, sf_dir)).select("id", "route", "disposition")


@query("""with d as (select doc_id % 500 as id, doc_id, n_chars, lang from documents) select id, doc_id, n_chars, lang from d qualify row_number() over (partition by id order by n_chars desc, doc_id) = 1""")
def dedupe_works(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select((F.col("doc_id") % 500).alias("id"), "doc_id", "n_chars", "lang")
    return tracker.dedupe(d, ["id"], [-F.col("n_chars"), F.col("doc_id")])


@query("select user_id, event_id, event_type, value from events qualify row_number() over (partition by user_id order by ts desc, event_id desc) = 1")
def latest_outcome(spark, sf_dir):
    return tracker.latest(table(spark, sf_dir, "events").select("user_id", "ts", "event_id", "event_type", "value"), ["user_id"], ["ts", "event_id"]).drop("ts")


@query(f"""{LOG_SQL}, seed as (select *, case when lane = 'out_of_scope' then 'out_of_scope' else 'pending' end as seeded from routed)
  select s.id, case when l.id is null then seeded else l.ingest_status end as ingest_status, l.gates_passed, l.figures_status, l.escalate_reason, l.ingest_mid, l.ingest_ts from seed s left join logged l using (id)""")
def overlay_outcomes(spark, sf_dir):
    return tracker.overlay(tracker.seeded(routed(spark, sf_dir)), logged(spark, sf_dir), "id", OUTCOME_COLUMNS).select("id", *OUTCOME_COLUMNS)


@query(f"""{LOG_SQL} select id, 'MORE' as schema, figures as n_assets, cast(case when validate then 0 else 2 end as integer) as err_count, cast(figures % 2 as integer) as warn_count
  from (select * from outcomes semi join routed using (id))""".replace("figures as n_assets", "cast(figures as integer) as n_assets"))
def sidecar_index(spark, sf_dir):
    o = outcomes(spark, sf_dir)
    record = F.struct(F.struct(F.col("id").alias("work_id")).alias("identity"), F.struct(F.when(F.col("validate"), 0).otherwise(2).alias("errors"), (F.col("figures") % 2).alias("warnings")).alias("gates"),
                      F.struct(F.col("figures").alias("count")).alias("assets"))
    sidecars = o.select(F.concat(F.lit("/x/"), "id").alias("sidecar_path"), F.to_json(record).alias("sidecar"), F.lit(False).alias("bad"))
    indexed = tracker.index_sidecars(routed(spark, sf_dir), sidecars)
    return indexed.where("sidecar is not null").select("id", F.lit("MORE").alias("schema"), "n_assets", "err_count", "warn_count")


@query(f"{LOG_SQL} select id, ingest_status as status, gates_passed from logged")
def classify_status(spark, sf_dir):
    return logged(spark, sf_dir).select("id", F.col("ingest_status").alias("status"), "gates_passed")


@query(f"""{ROUTED_SQL}{OUTCOMES_SQL} select count(*) as attempted, count(*) filter (where validate and lint) as full_pass, count(*) filter (where not validate) as validate_failed,
  count(*) filter (where not lint) as lint_failed, cast(coalesce(sum(figures), 0) as bigint) as figures from outcomes""")
def batch_scorecard(spark, sf_dir):
    return reports.scorecard(outcomes(spark, sf_dir))


@query(f"""{LOG_SQL}, s as (select * from (values (0, 'pending'), (1, 'ingested'), (2, 'partial'), (3, 'escalate'), (4, 'failed')) v(place, value))
  select cast(place as integer) as place, value, count(id) as n from s left join logged on ingest_status = value group by all""")
def status_tally(spark, sf_dir):
    return reports.status_tally(logged(spark, sf_dir), tracker.STATUSES, True, "ingest_status")


@query(f"""{ROUTED_SQL}{OUTCOMES_SQL}, p as (select publisher, o.* from outcomes o join works w using (id))
  select substring(trim(regexp_replace(lower(publisher), '[^a-z0-9]+', '-', 'g'), '-'), 1, 40) as slug, count(*) as n, count(*) filter (where validate) as validate_pass, count(*) filter (where lint) as lint_pass,
    cast(sum(greatest(figures - 2, 0)) as bigint) as errors, cast(sum(greatest(1 - figures, 0)) as bigint) as warnings from p where publisher is not null group by 1""")
def publisher_stats(spark, sf_dir):
    p = outcomes(spark, sf_dir).join(works(spark, sf_dir).select("id", "publisher").where("publisher is not null"), "id")
    return reports.publisher_stats(p.select(T.slug("publisher").alias("slug"), "validate", "lint", (F.col("figures") - 2).alias("errors"), (1 - F.col("figures")).alias("warnings")))


@query("""with m as (select concat('row ', o_orderkey, ' of ', o_orderpriority, ' has ', o_orderstatus, ' x', o_custkey % 5) as message from orders)
  select substring(regexp_replace(message, '\\S*[0-9]\\S*', 'N', 'g'), 1, 90) as kind, count(*) as n from m group by 1 order by n desc, 1 limit 12""")
def finding_kinds(spark, sf_dir):
    m = table(spark, sf_dir, "orders").select(F.concat(F.lit("row "), "o_orderkey", F.lit(" of "), "o_orderpriority", F.lit(" has "), "o_orderstatus", F.lit(" x"), F.col("o_custkey") % 5).alias("message"))
    return reports.kinds(m, T.message_kind("message"))


# --- selection


@query(f"""{WORKS_SQL}, t as (select publisher, count(*) as n from works where publisher is not null group by 1 order by n desc, 1 limit 10)
  select publisher, id, row_number() over (partition by publisher order by id) as place from works join t using (publisher) qualify place <= 3""")
def balanced_sample(spark, sf_dir):
    return selection.balanced(works(spark, sf_dir)).select("publisher", "id", "place")


@query(f"{WORKS_SQL} select id, md5(id) as h from works where has_grobid order by h, id limit 50")
def hash_sample(spark, sf_dir):
    return selection.hashed(works(spark, sf_dir).where("has_grobid"), 50).select("id", "h")


@query(f"""{ROUTED_SQL}, c as (select id, publisher, case when in_pmc then 1 else 2 end as tier from routed where disposition = 'convert_vor' and publisher is not null)
  select id, publisher, cast(tier as integer) as tier, row_number() over (partition by publisher order by tier, md5(id), id) as place from c qualify place <= 6""")
def tiered_plan(spark, sf_dir):
    r = routed(spark, sf_dir)
    return selection.tiered(r.where("disposition = 'convert_vor' and publisher is not null").select("id", "publisher"), r.where("in_pmc"), 6)


@query(f"""{ROUTED_SQL}, a as (select * from routed where route = 'gated_commercial' and doi is not null and has_grobid order by id limit 25)
  select id, doi, route from a where not exists (select 1 from labels l where concat('W', l.doc_id) = a.id and l.quality = 1 and l.toxic = 0)""")
def fetch_plan(spark, sf_dir):
    done = table(spark, sf_dir, "labels").select(F.concat(F.lit("W"), "doc_id").alias("id"), (F.col("quality") == 1).alias("has_xml"), (F.col("toxic") == 0).alias("has_pdf_file"))
    return selection.fetch_plan(routed(spark, sf_dir), "gated_commercial", done, 25).select("id", "doi", "route")


@query(f"""{LOG_SQL}, f as (select id from routed order by id limit 200) select id, ingest_status from f left join logged using (id) where coalesce(ingest_status not in ('ingested', 'partial'), true)""")
def attempts_plan(spark, sf_dir):
    return selection.attempts(routed(spark, sf_dir).select("id"), logged(spark, sf_dir), 200)


@query(f"""{ROUTED_SQL}{OUTCOMES_SQL}, known as (select id, mid from outcomes where mid is not null), f as (select concat('W', doc_id) as id, doc_id as place from documents),
  top as (select coalesce(max(cast(regexp_extract(mid, '-([0-9]+)$', 1) as bigint)), 910000) as top from known where regexp_matches(mid, '-[0-9]+$')),
  fresh as (select id, place, row_number() over (order by place) as r from f anti join known using (id))
  select id, place, mid from f join known using (id) union all select id, place, concat('MORE-2025-', lpad(cast(top + r as varchar), cast(greatest(6, length(cast(top + r as varchar))) as integer), '0')) from fresh, top""")
def mid_allocation(spark, sf_dir):
    files = table(spark, sf_dir, "documents").select(F.concat(F.lit("W"), "doc_id").alias("id"), F.col("doc_id").alias("place"))
    return tracker.allocate(files, outcomes(spark, sf_dir).where("mid is not null").select("id", "mid"))


@query("""with i as (select source as slug, doc_id as pos, 0.25 * (doc_id % 4) as cost, doc_id % 5 = 0 as on_disk from documents),
  q as (select *, case when on_disk then 0 else cost end as pay, row_number() over (partition by slug order by pos) as place from i qualify place <= 8),
  s as (select slug, pos, cast(sum(pay) over (order by slug, pos rows unbounded preceding) as double) as spent from q) select slug, pos, spent from s where spent <= 20""")
def budget_quota(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    items = d.select(F.col("source").alias("slug"), F.col("doc_id").alias("pos"), ((F.col("doc_id") % 4) * 0.25).cast("double").alias("cost"), (F.col("doc_id") % 5 == 0).alias("on_disk"))
    return selection.within_budget(items, 8, 20.0).select("slug", "pos", "spent")


@query("""with y as (select o_custkey as id, cast(year(o_orderdate) as integer) as year from orders) select c_custkey as id, coalesce(min(year), 2025) as year from customer left join y on id = c_custkey group by 1""")
def year_for(spark, sf_dir):
    by = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("id"), F.year("o_orderdate").alias("year"))
    return selection.year_of(table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id")), by)


@query(f"""{ROUTED_SQL} select id, route, case when route = 'out_of_scope' then null when route = 'pmc' then 'pmc' when route like 'scoap3%' then 'scoap3' when route = 'springer_oa_api' then 'springer' when route = 'jats_native_open' then 'native'
  when route = 'elsevier_entitlement' then 'elsevier' else 'tei' end as text_adapter, case when route in ('out_of_scope', 'elsevier_entitlement') then null when route = 'pmc' then 'pmc' when route like 'scoap3%' then 'scoap3'
  when route in ('springer_oa_api', 'jats_native_open') then 'generic' else 'content' end as file_adapter from routed""")
def adapter_dispatch(spark, sf_dir):
    return acquire.adapters(routed(spark, sf_dir)).select("id", "route", "text_adapter", "file_adapter")


@query(f"""{WORKS_SQL} select id, case when pdf_url is not null then pdf_url when doi like '10.3389/%' and journal is not null then concat('https://www.frontiersin.org/journals/', replace(regexp_replace(lower(journal), '^frontiers (in|of) ', ''), ' ', '-'), '/articles/', doi, '/pdf')
  when regexp_matches(doi, '^10[.](1007|1038|1186)/') then concat('https://link.springer.com/content/pdf/', doi, '.pdf') end as first, (pdf_url is not null)::int + coalesce((doi like '10.3389/%' and journal is not null), false)::int + coalesce(regexp_matches(doi, '^10[.](1007|1038|1186)/'), false)::int as n from works""")
def file_candidates(spark, sf_dir):
    return works(spark, sf_dir).select("id", acquire.file_addresses().alias("a")).select("id", F.get("a", F.lit(0)).alias("first"), F.size("a").alias("n"))


@query(f"{WORKS_SQL} select id, doi from works where lower(doi) = lower('10.7554/ELIFE.3')")
def doi_lookup(spark, sf_dir):
    return spark.sql("select id, doi from {w} where lower(doi) = lower(:doi)", args={"doi": "10.7554/ELIFE.3"}, w=works(spark, sf_dir))


@query(f"""{ROUTED_SQL}{OUTCOMES_SQL}, s as (select id, json_object('assets', json_object('source', case figures % 3 when 0 then 'repo_pdf' when 1 then 'publisher' end, 'manifest', case when figures = 5 then null else range(0, figures) end)) as j from outcomes)
  select id, coalesce(json_extract_string(j, '$.assets.source') = 'repo_pdf', false) as from_repository, cast(json_array_length(j, '$.assets.manifest') as integer) as n from s""".replace("json_array_length(j, '$.assets.manifest')", "case when json_type(j, '$.assets.manifest') = 'ARRAY' then json_array_length(j, '$.assets.manifest') end"))
def sidecar_idioms(spark, sf_dir):
    manifest = F.when(F.col("figures") != 5, F.when(F.col("figures") == 0, F.array().cast("array<bigint>")).otherwise(F.sequence(F.lit(0).cast("bigint"), F.greatest(F.col("figures") - 1, F.lit(0)))))
    source = F.when(F.col("figures") % 3 == 0, "repo_pdf").when(F.col("figures") % 3 == 1, "publisher")
    j = outcomes(spark, sf_dir).select("id", F.to_json(F.struct(F.struct(source.alias("source"), manifest.alias("manifest")).alias("assets"))).alias("j"))
    at = lambda p: F.get_json_object("j", p)
    return j.select("id", F.coalesce(at("$.assets.source") == "repo_pdf", F.lit(False)).alias("from_repository"), F.json_array_length(at("$.assets.manifest")).alias("n"))


@query(f"""{WORKS_SQL}, r as (select id, substring(trim(regexp_replace(lower(publisher), '[^a-z0-9]+', '-', 'g'), '-'), 1, 40) as slug from works where has_grobid and publisher is not null), o as (select *, row_number() over (order by slug, id) - 1 as n from r)
  select id, slug, concat('MORE-2025-99', lpad(cast(n as varchar), cast(greatest(4, length(cast(n as varchar))) as integer), '0')) as mid from o""")
def pilot_numbers(spark, sf_dir):
    w = works(spark, sf_dir).where("has_grobid and publisher is not null").select("id", T.slug("publisher").alias("slug"))
    return tracker.pilot_numbers(w)


# --- lookups


FIELDS = [*matching.FIELD_DIVISION, "Alchemy"]


@query(None)
def division_lookup(spark, sf_dir):
    from .standin import pick
    d = columns(table(spark, sf_dir, "documents"), f"doc_id, {pick(FIELDS, 'doc_id')} AS field, {pick([*matching.DOMAIN_DIVISION, 'Other'], 'doc_id')} AS domain")
    div = matching.division(F.col("field"), F.col("domain"))
    return d.select("doc_id", div.alias("division"), F.array_join(matching.subject_codes(div), ",").alias("codes"))


def _division_sql() -> str:
    from .standin import pick
    field = " ".join(f"when field = '{k}' then '{v}'" for k, v in matching.FIELD_DIVISION.items())
    domain = " ".join(f"when domain = '{k}' then '{v}'" for k, v in matching.DOMAIN_DIVISION.items())
    return f"""with d as (select doc_id, {pick(FIELDS, 'doc_id')} as field, {pick([*matching.DOMAIN_DIVISION, 'Other'], 'doc_id')} as domain from documents),
      e as (select doc_id, case {field} {domain} else '42' end as division from d) select doc_id, division, concat(division, ',', division, '99,', division, '9999') as codes from e"""


ORACLES["division_lookup"] = _division_sql()


@query(f"""{WORKS_SQL} select id, case when publisher in ('Wiley', 'Oxford University Press', 'Cambridge University Press', 'Royal Society of Chemistry', 'Taylor & Francis')
  then trim(regexp_replace(lower(publisher), '[^a-z0-9]+', '-', 'g'), '-') else '_default' end as rule, case publisher when 'Royal Society of Chemistry' then 'numbered' else 'author-year' end as reference_style,
  case when publisher = 'Wiley' then false when publisher in ('Oxford University Press', 'Royal Society of Chemistry') then true end as headings_numbered from works""")
def publisher_rule(spark, sf_dir):
    w = matching.publisher_rules(works(spark, sf_dir).select("id", T.slug("publisher").alias("slug")))
    return w.select("id", F.col("rule.slug").alias("rule"), "rule.reference_style", "rule.headings_numbered")


@query("""with c as (select l_orderkey as doc, l_linenumber as cite, concat('s', l_suppkey % 7) as surname, 2000 + l_partkey % 5 as year from lineitem),
  r as (select l_orderkey as doc, l_linenumber as ref, concat('s', (l_suppkey + l_linenumber % 2) % 7) as surname, 2000 + l_partkey % 5 as year from lineitem),
  o as (select doc, surname, year, min(ref) as ref from r group by all having count(distinct ref) = 1) select doc, cite, surname, year, ref from c left join o using (doc, surname, year)""")
def citation_link(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    year = (F.col("l_partkey") % 5 + 2000).alias("year")
    name = lambda x: F.concat(F.lit("s"), x % 7).alias("surname")
    cites = li.select(F.col("l_orderkey").alias("doc"), F.col("l_linenumber").alias("cite"), name(F.col("l_suppkey")), year)
    refs = li.select(F.col("l_orderkey").alias("doc"), F.col("l_linenumber").alias("ref"), name(F.col("l_suppkey") + F.col("l_linenumber") % 2), year)
    return matching.link_author_year(cites, refs).select("doc", "cite", "surname", "year", "ref")


@query("""with c as (select conv_id, row_number() over (partition by conv_id order by turn) - 1 as pos, turn from conversations where role = 'user'),
  a as (select conv_id, row_number() over (partition by conv_id order by turn) - 1 as pos, turn as answer from conversations where role = 'assistant'),
  k as (select conv_id, (select count(*) from c where c.conv_id = v.conv_id) <> (select count(*) from a where a.conv_id = v.conv_id) as uneven from (select distinct conv_id from conversations) v)
  select c.conv_id, c.pos, turn, answer, uneven from c join a using (conv_id, pos) join k using (conv_id)""")
def positional_wire(spark, sf_dir):
    from pyspark.sql import Window

    c = table(spark, sf_dir, "conversations")
    place = (F.row_number().over(Window.partitionBy("conv_id").orderBy("turn")) - 1).alias("pos")
    side = lambda role, name: c.where(F.col("role") == role).select("conv_id", place, F.col("turn").alias(name))
    return matching.zip_positions(side("user", "turn"), side("assistant", "answer"), "conv_id").select("conv_id", "pos", "turn", "answer", "uneven")


@query("""select l_orderkey, count(distinct l_linenumber) as n from lineitem where l_quantity < 40 group by 1 having min(l_linenumber) = 1 and max(l_linenumber) = count(distinct l_linenumber)""")
def exact_wire_guard(spark, sf_dir):
    return matching.exact_sequence(table(spark, sf_dir, "lineitem").where("l_quantity < 40"), "l_orderkey", "l_linenumber")


@query("""with u as (select conv_id as doc, turn as pos, case when turn % 3 = 0 then text else 'A1' end as head from conversations),
  f as (select doc, pos, case when row_number() over w = 1 or length(regexp_replace(coalesce(head, ''), '[^A-Za-z]', '', 'g')) >= 3 then 1 else 0 end as s from u window w as (partition by doc order by pos))
  select doc, pos, cast(sum(s) over (partition by doc order by pos rows unbounded preceding) as bigint) as unit from f""")
def annex_fold(spark, sf_dir):
    u = table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("doc"), F.col("turn").alias("pos"), F.when(F.col("turn") % 3 == 0, F.col("text")).otherwise("A1").alias("head"))
    return matching.folded(u).select("doc", "pos", "unit")


# --- text


@query(f"{WORKS_SQL} select id, coalesce(substring(trim(regexp_replace(lower(publisher), '[^a-z0-9]+', '-', 'g'), '-'), 1, 40), 'unknown') as slug from works")
def slugify(spark, sf_dir):
    return works(spark, sf_dir).select("id", T.slug("publisher", "unknown").alias("slug"))


@query(f"""{WORKS_SQL}, v as (select id, [doi, case when doi like '10.1103/physrevd.%' then replace(doi, 'physrevd', 'PhysRevD') end, case when regexp_matches(doi, '^10\\.1007/jhep[0-9]+\\([0-9]+\\)[0-9]+$') then replace(doi, 'jhep', 'JHEP') end] as vs from works where doi is not null)
  select id, unnest(list_filter(vs, lambda x: x is not null)) as variant from v""")
def doi_variants(spark, sf_dir):
    return works(spark, sf_dir).where("doi is not null").select("id", F.explode(T.doi_variants("doi")).alias("variant"))


@query(f"""{WORKS_SQL} select id, case when doi like '10.1371/%' then concat('https://journals.plos.org/plosone/article/file?id=', doi, '&type=manuscript')
  when doi like '10.7554/%' then concat('https://elifesciences.org/articles/', regexp_extract(doi, '(?i)elife\\.([0-9]+)', 1), '.xml') when doi like '10.12688/%' then concat('https://f1000research.com/extapi/article/xml?doi=', doi)
  when doi like '10.7717/%' then concat('https://peerj.com/articles/', regexp_extract(doi, 'peerj\\.([0-9]+)', 1), '.xml') when doi like '10.1098/%' then concat('https://royalsocietypublishing.org/doi/full-xml/', doi)
  when doi like '10.3390/%' then concat('https://www.mdpi.com/article/', doi, '/xml')
  when doi like '10.3389/%' and journal is not null then concat('https://www.frontiersin.org/journals/', replace(regexp_replace(lower(journal), '^frontiers (in|of) ', ''), ' ', '-'), '/articles/', doi, '/xml') end as url from works""")
def native_urls(spark, sf_dir):
    return works(spark, sf_dir).select("id", F.get(T.native_urls(F.coalesce("doi", F.lit("")), "journal"), F.lit(0)).alias("url"))


@query("""with h as (select page_id, unnest(regexp_extract_all(html, 'href="([^"]*)"', 1)) as href from pages)
  select page_id, href, count(*) as n, not (trim(href) = '' or href like '#%' or regexp_matches(lower(trim(href)), '^(https?://|ftps?://|sftp://|www\\.|ftp\\.)') or contains(split_part(trim(href), '/', 1), ':')) as is_local from h group by all""")
def href_inventory(spark, sf_dir):
    h = table(spark, sf_dir, "pages").select("page_id", F.explode(F.regexp_extract_all("html", F.lit('href="([^"]*)"'))).alias("href"))
    return h.groupBy("page_id", "href").agg(F.count(F.lit(1)).alias("n")).withColumn("is_local", T.local_href("href"))


@query("""select page_id, len(regexp_extract_all(html, '<p>')) as paragraphs, len(regexp_extract_all(html, '<a href')) as links, len(regexp_extract_all(html, '<h1>')) as headings,
  contains(html, '</article>') as closed, len(regexp_extract_all(html, '&[a-z]+;')) as refs from pages""")
def page_fingerprint(spark, sf_dir):
    n = lambda p: F.regexp_count("html", F.lit(p)).cast("bigint")
    return table(spark, sf_dir, "pages").select("page_id", n("<p>").alias("paragraphs"), n("<a href").alias("links"), n("<h1>").alias("headings"), F.contains("html", F.lit("</article>")).alias("closed"), n("&[a-z]+;").alias("refs"))


def _wrapped(spark, sf_dir):
    uri = F.when(F.col("doc_id") % 3 == 0, F.lit('<a href="https://creativecommons.org/licenses/by/4.0/"/>')).when(F.col("doc_id") % 3 == 1, F.lit("http://creativecommons.org/licenses/by-nd/4.0")).otherwise("")
    block = F.when(F.col("doc_id") % 2 == 0, F.concat(F.lit("<permissions>"), "text", uri, F.lit("</permissions>"))).otherwise(F.concat("text", F.when(F.col("doc_id") % 5 == 0, uri).otherwise("")))
    return table(spark, sf_dir, "documents").select("doc_id", F.when(F.col("doc_id") % 31 != 0, block).alias("xml"))


CC = r"https?://creativecommons\.org/licenses/([a-z-]+)/([0-9.]+)"


@query(rf"""with d as (select doc_id, text, case doc_id % 3 when 0 then '<a href="https://creativecommons.org/licenses/by/4.0/"/>' when 1 then 'http://creativecommons.org/licenses/by-nd/4.0' else '' end as u from documents),
  x as (select doc_id, case when doc_id % 31 = 0 then null when doc_id % 2 = 0 then concat('<permissions>', text, u, '</permissions>') else concat(text, case when doc_id % 5 = 0 then u else '' end) end as xml from d),
  b as (select *, regexp_extract(xml, '(?s)<permissions>.*?</permissions>', 0) as block from x),
  c as (select *, lower(block) as low, coalesce(nullif(regexp_extract(block, '(?i){CC}', 0), ''), nullif(regexp_extract(xml, '(?i){CC}', 0), '')) as uri from b),
  f as (select *, lower(regexp_extract(uri, '(?i){CC}', 1)) as fl, regexp_matches(low, 'non-?commercial|no-?derivati|share-?alike|by-nc|by-nd|by-sa') as bad, regexp_matches(low, 'creative commons attribution|cc[\s-]?by\b') as good from c)
  select doc_id, case when xml is null then false when uri is not null then fl = 'by' when block = '' or bad then false else good end as ok, uri,
    case when xml is null then 'unreadable article.xml' when fl = 'by' then 'CC-BY (uri)' when uri is not null then concat('CC-', upper(fl), ' is not CC-BY') when block = '' then 'no licence in article.xml'
      when bad then 'restrictive Creative Commons terms (not CC-BY)' when good then 'CC-BY (prose)' else 'no recognisable CC-BY licence' end as detail from f""")
def license_verdict(spark, sf_dir):
    return _wrapped(spark, sf_dir).select("doc_id", T.licence_verdict("xml").alias("v")).select("doc_id", "v.ok", "v.uri", "v.detail")


@query("""select doc_id, 'The √s = ' || (doc_id % 14) || ' TeV pT' || substr('⁰¹²³⁴⁵⁶⁷⁸', cast(doc_id % 9 as int) + 1, 1) || ' α≤β – ref ' as caption from documents""")
def latex_clean(spark, sf_dir):
    """Generated captions: the tables have no LaTeX."""
    d = table(spark, sf_dir, "documents").select("doc_id", F.concat(F.lit("The $\\sqrt{s}$ = "), F.col("doc_id") % 14, F.lit(" \\TeV~$p_{T}^{"), F.col("doc_id") % 9, F.lit("}$ \\alpha\\leq\\beta -- ref \\cite{a"), "doc_id", F.lit("}")).alias("caption"))
    return spread(d).select("doc_id", clean_text("caption").alias("caption"))


# --- fidelity


def _pairs(spark, sf_dir):
    """Documents against a cut of themselves: three quarters of the words, and every ninth document another's."""
    d, c = table(spark, sf_dir, "documents").select("doc_id", "text"), F.col("doc_id")
    ahead = (c % 40).cast("int")

    def cut(k):
        """The first k of every 40 words, where so many empty ones are ahead. A function of each word would take the JVM three times as long."""
        out = F.regexp_replace(F.concat(F.repeat(F.lit(" "), ahead + 1), "text"), f"((?: [^ ]*){{1,{k}}}+)(?: [^ ]*){{0,{40 - k}}}+", "$1")
        return F.substr(out, F.least(ahead, F.lit(k)) + 2)

    below = F.array_join(F.filter(F.split("text", " "), lambda x, i: (i + c) % 40 < 10), " ")  # remainders of ids below 0 are too, and what has no id has no words
    kept = F.when(c % 4 == 0, F.col("text")).when(c < 0, below).when(c % 4 == 1, cut(34)).when(c % 4 == 2, cut(24)).when(c % 4 == 3, cut(10)).otherwise(below)
    return d.select(F.col("doc_id").alias("pair_id"), F.col("text").alias("source_text"), kept.alias("target_text"), (F.col("doc_id") % 50).cast("int").alias("ref_target"),
                    F.when(F.col("doc_id") % 6 != 0, F.when(F.col("doc_id") % 25 == 0, 99).otherwise((F.col("doc_id") % 50).cast("int"))).alias("ref_source"), F.when(F.col("doc_id") % 2 == 0, 0.0).otherwise(0.7).alias("floor"))


TOKENS_SQL = r"""with d as (select doc_id as pair_id, text as s, array_to_string(list_filter(string_split(text, ' '), lambda x, i: ((i - 1 + doc_id) % 40) < case doc_id % 4 when 0 then 40 when 1 then 34 when 2 then 24 else 10 end), ' ') as t from documents),
  a as (select pair_id, regexp_extract_all(regexp_replace(lower(s), '([\p{L}\p{N}_])-\s*\n\s*([\p{L}\p{N}_])', '\1\2', 'g'), '[a-z0-9]+') as sa, regexp_extract_all(regexp_replace(lower(t), '([\p{L}\p{N}_])-\s*\n\s*([\p{L}\p{N}_])', '\1\2', 'g'), '[a-z0-9]+') as ta from d),
  k as (select *, list_filter(sa, lambda x: regexp_matches(x, '[a-z]')) as st, list_filter(ta, lambda x: regexp_matches(x, '[a-z]')) as tt from a),
  h as (select *, list_transform(range(1, greatest(len(st) - 3, 1)), lambda i: array_to_string(st[i:i+4], ' ')) as sl, list_transform(range(1, greatest(len(tt) - 3, 1)), lambda i: array_to_string(tt[i:i+4], ' ')) as tl from k),
  m as (select pair_id, len(st) as source_tokens, len(tt) as target_tokens, len(list_distinct(sl)) as sn, len(list_distinct(tl)) as tn, len(list_intersect(sl, tl)) as c, st, sl, tl,
    len(list_distinct(list_filter(sa, lambda x: regexp_matches(x, '[0-9]') and length(x) >= 2))) as nn, len(list_intersect(list_filter(sa, lambda x: regexp_matches(x, '[0-9]') and length(x) >= 2), list_filter(ta, lambda x: regexp_matches(x, '[0-9]') and length(x) >= 2))) as nc from h)"""
RATIO_SQL = f"""{TOKENS_SQL}, r as (select pair_id, cast(source_tokens as integer) as source_tokens, cast(target_tokens as integer) as target_tokens, case when sn > 0 then c / sn else 0.0 end as completeness, case when tn > 0 then c / tn else 0.0 end as grounding,
  case when source_tokens > 0 then target_tokens / source_tokens else 0.0 end as mass_ratio, case when nn > 0 then nc / nn else 1.0 end as num_recall from m)"""
JUDGED_SQL = f"""{RATIO_SQL}, j as (select *, pair_id % 50 as rt, case when pair_id % 6 = 0 then null when pair_id % 25 = 0 then 99 else pair_id % 50 end as rs, case when pair_id % 2 = 0 then 0.65 else 0.7 end as fl from r),
  v as (select *, case when coalesce(rt <> rs, false) or source_tokens < 100 or mass_ratio < 0.35 or grounding < 0.6 or completeness < 0.4 then 'fail' when completeness < fl then 'flag' else 'pass' end as verdict from j)"""


@query(f"{RATIO_SQL} select pair_id, source_tokens, target_tokens from r")
def token_stats(spark, sf_dir):
    return fidelity.metrics(_pairs(spark, sf_dir)).select("pair_id", "source_tokens", "target_tokens")


@query(f"{RATIO_SQL} select pair_id, completeness, grounding, mass_ratio, num_recall from r")
def shingle_overlap(spark, sf_dir):
    return fidelity.metrics(_pairs(spark, sf_dir)).select("pair_id", "completeness", "grounding", "mass_ratio", "num_recall")


@query(f"{JUDGED_SQL} select pair_id, verdict, source_tokens, target_tokens, cast(fl as double) as pass_floor from v")
def fidelity_verdict(spark, sf_dir):
    return fidelity.evaluate(_pairs(spark, sf_dir), source_tokens=100).select("pair_id", "verdict", "source_tokens", "target_tokens", "pass_floor")


@query(f"""{TOKENS_SQL}, p as (select pair_id, unnest(range(0, len(sl))) as pos, unnest(sl) as sh from m), t as (select distinct pair_id, unnest(tl) as sh from m),
  q as (select pair_id, pos from p anti join t using (pair_id, sh)), i as (select pair_id, pos, pos - row_number() over (partition by pair_id order by pos) as isl from q),
  g as (select pair_id, count(*) as shingles, min(pos) as at_token from i group by pair_id, isl), w as (select *, row_number() over (partition by pair_id order by shingles desc, at_token) as pl from g)
  select pair_id, shingles, cast(at_token as integer) as at_token, substring(array_to_string(st[at_token + 1:at_token + 24], ' '), 1, 160) as snippet from w join m using (pair_id) where pl <= 5 and shingles >= 5""")
def missing_runs(spark, sf_dir):
    return fidelity.missing_runs(_pairs(spark, sf_dir))


@query(f"""{JUDGED_SQL}, l as (unpivot (select verdict, completeness, grounding, mass_ratio, num_recall from v) on completeness, grounding, mass_ratio, num_recall into name metric value x),
  s as (select verdict, metric, list_sort(list(x)) as xs from l group by all) select verdict, metric, cast(len(xs) as bigint) as n, xs[1] as least,
    xs[case when len(xs) >= 20 then greatest(cast(floor(len(xs) * 0.05) as bigint), 1) else 1 end] as p5, list_median(xs) as median, xs[-1] as most from s""")
def calibration_distribution(spark, sf_dir):
    return reports.calibration(fidelity.judged(_pairs(spark, sf_dir), source_tokens=100), "verdict", fidelity.METRICS)


# --- lineage


def _recorded(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    known = F.create_map(F.lit("crosswalk"), (F.col("doc_id") % 2).cast("int"), F.lit("tei_to_jats"), (F.col("doc_id") % 5).cast("int"))
    return d.select("doc_id", F.when(F.col("doc_id") % 7 != 0, known).alias("pipeline"), F.when(F.col("doc_id") % 3 != 0, F.create_map(F.lit("validate"), F.lit("v1"), F.lit("lint"), F.concat(F.lit("l"), F.col("doc_id") % 4))).alias("engine"), (F.col("doc_id") % 2 == 0).alias("has_fidelity"))


@query("""with d as (select doc_id, unnest(['crosswalk', 'tei_to_jats', 'elsevier', 'body_clean', 'caption_clean', 'fig_repair', 'figures', 'fidelity']) as step from documents),
  v as (select doc_id, step, cast(case when step = 'tei_to_jats' then 3 else 1 end as integer) as now, cast(case when doc_id % 7 = 0 then 0 when step = 'crosswalk' then doc_id % 2 when step = 'tei_to_jats' then doc_id % 5 else 0 end as integer) as recorded from d)
  select doc_id, step, recorded, now from v where recorded < now""")
def stale_steps(spark, sf_dir):
    return _recorded(spark, sf_dir).select("doc_id", F.explode(lineage.stale_steps(F.col("pipeline"))).alias("step", "v")).select("doc_id", "step", "v.recorded", F.col("v.current").alias("now"))


@query("""with d as (select doc_id, unnest(['validate', 'lint', 'fidelity']) as gate from documents),
  v as (select doc_id, gate, case gate when 'validate' then 'v1' when 'lint' then 'l2' else 'f1' end as now, case when doc_id % 3 = 0 or gate = 'fidelity' then 'unstamped' when gate = 'validate' then 'v1' else concat('l', doc_id % 4) end as recorded from d)
  select doc_id, gate, recorded, now from v where recorded <> now and (gate <> 'fidelity' or doc_id % 2 = 0)""")
def stale_gates(spark, sf_dir):
    found = lineage.stale_gates(F.col("engine"), {"validate": "v1", "lint": "l2", "fidelity": "f1"}, F.col("has_fidelity"))
    return _recorded(spark, sf_dir).select("doc_id", F.explode(found).alias("gate", "v")).select("doc_id", "gate", "v.recorded", F.col("v.current").alias("now"))


@query("select doc_id, substring(sha256(text), 1, 16) as sha16 from documents")
def content_hash(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", T.hash16("text").alias("sha16"))


@query("""with a as (select doc_id, lang, n_chars from documents), b as (select case when doc_id % 10 = 4 then -1 - doc_id else doc_id end as doc_id, case when doc_id % 9 = 0 then null else lang end as lang, case when doc_id % 4 = 0 then n_chars + 1 else n_chars end as n_chars from documents)
  select count(*) filter (where a.doc_id is not null and b.doc_id is not null and a.lang is distinct from b.lang) as lang, count(*) filter (where a.doc_id is not null and b.doc_id is not null and a.n_chars is distinct from b.n_chars) as n_chars,
    count(*) filter (where a.doc_id is null or b.doc_id is null) as unpaired from a full join b using (doc_id)""")
def table_differences(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars")
    b = d.select(F.when(F.col("doc_id") % 10 == 4, -1 - F.col("doc_id")).otherwise(F.col("doc_id")).alias("doc_id"), F.when(F.col("doc_id") % 9 != 0, F.col("lang")).alias("lang"), (F.col("n_chars") + F.when(F.col("doc_id") % 4 == 0, 1).otherwise(0)).alias("n_chars"))
    return changes.differences(d, b, "doc_id", ["lang", "n_chars"])


# --- documents


@query(None)
def xml_crosswalk(spark, sf_dir):
    """Articles made from documents, crosswalked to the house form."""
    return documents.crosswalk(documents.sample_articles(table(spark, sf_dir, "documents")))


@query(r"""with d as (select doc_id, doc_id % 3 = 0 as jats, text from documents)
  select cast(doc_id as varchar) as id, true as root_is_article, true as has_title, cast(jats as integer) as contrib_count, true as affs_all_have_ids, 0 as residual_latex, 1 as bibr_links, 1 as ref_count, 0 as fig_count,
    cast(coalesce(list_sum(list_transform(string_split(text, chr(10)), lambda x: len(regexp_extract_all(x, '\$[^$]+\$')))), 0) as integer) as formula_count, jats as cc_license_typed, cast(null as varchar) as error from d""")
def article_fingerprint(spark, sf_dir):
    return documents.fingerprint(documents.crosswalk(documents.sample_articles(table(spark, sf_dir, "documents"))))
