import json

from pyspark.sql import functions as F

from siltstone.functions.sql import register
from siltstone.operators import lineage, matching, reports, selection, tracker
from siltstone.sources.records import OUTCOME_COLUMNS, flatten, outcome_rows, pin_types, read_pages, read_sidecars, sidecar_fields
from siltstone.streaming.outcomes import upsert_latest, windowed_counts


def work(i, **more):
    return {"id": f"W{i}", "license": "cc-by", "publisher": "Wiley", "journal": "x", "in_pmc": False, "has_pdf": True, "has_grobid": True, "version": "publishedVersion", "date": "2025-01-02"} | more


def test_build(spark, tmp_path):
    pages = tmp_path / "pages"
    pages.mkdir()
    (pages / "page_0001.json").write_text(json.dumps([work(1), work(2, license=None), work(3)]))
    (pages / "page_0002.json").write_text(json.dumps([work(3), work(4, journal="Physics Letters B")]))
    log = spark.createDataFrame([(json.dumps({"W1": {"ingest_status": "ingested", "gates_passed": True, "mid": "M-1", "ts": "t"}, "W2": {"ingest_status": None}, "W99": {"ingest_status": "failed"}}),)], "value string")
    (tmp_path / "s" / "a").mkdir(parents=True)
    (tmp_path / "s" / "b").mkdir()
    (tmp_path / "s" / "a" / "metadata.json").write_text(json.dumps({"identity": {"work_id": "W1"}, "assets": {"count": 3}, "gates": {"errors": 1, "warnings": 2}, "repair": {"x": 1}}))
    (tmp_path / "s" / "b" / "metadata.json").write_text("{not json")
    works = read_pages(spark, str(pages / "*.json"))
    got = {r.id: r for r in tracker.build(works, outcome_rows(log), read_sidecars(spark, str(tmp_path / "s"))).collect()}
    assert sorted(got) == ["W1", "W2", "W3", "W4"] and len(got["W1"].asDict()) == 35
    assert (got["W1"].ingest_status, got["W1"].gates_passed, got["W1"].n_assets, got["W1"].err_count, got["W1"].warn_count) == ("ingested", True, 3, 1, 2)
    assert got["W2"].ingest_status is None  # a match overwrites the seed, with null too
    assert got["W3"].ingest_status == "pending" and got["W4"].lane == "Cprime_transform" and got["W3"].sidecar is None
    assert tracker.published(tracker.build(works)).count() == 3


def test_flatten(spark):
    raw = [
        {"id": "https://o/W5", "doi": "https://doi.org/10.1/x", "locations": [{"id": "pmh:oai:pubmedcentral.nih.gov:1234567", "source": {"display_name": "X"}}], "has_content": {"pdf": True}},
        {"id": "W6", "doi": None, "locations": [{"source": {"display_name": "BioMed Central"}}, {"source": {"display_name": "PubMed Central (x)"}, "landing_page_url": "https://n/PMC7654321"}]},
        {"id": "W7", "locations": None},
    ]
    schema = __import__("siltstone.sources.records", fromlist=["RAW_SCHEMA"]).RAW_SCHEMA
    df = spark.createDataFrame([(json.dumps(r),) for r in raw], "v string").select(F.from_json("v", schema).alias("r")).select("r.*")
    got = {r.id: r for r in flatten(df).collect()}
    assert (got["W5"].doi, got["W5"].in_pmc, got["W5"].pmcid, got["W5"].has_pdf, got["W5"].has_grobid) == ("10.1/x", True, "PMC1234567", True, False)
    assert (got["W6"].in_pmc, got["W6"].pmcid, got["W6"].doi) == (True, "PMC7654321", None) and got["W7"].in_pmc is False


def test_pin_types(spark):
    df = spark.createDataFrame([('"cc-by"', "true"), ("x", "maybe"), (None, None)], "license string, has_pdf string")
    got = pin_types(df, {"license": "string", "has_pdf": "boolean", "extra": "int"}).collect()
    assert [tuple(r) for r in got] == [("cc-by", True, None), ("x", None, None), (None, None, None)]


def test_statuses(spark):
    rows = [(False, "e", True, True, "complete", "failed"), (True, "e", True, True, "complete", "escalate"), (True, "", True, True, "none", "ingested"), (True, None, True, False, "partial", "partial"),
            (True, None, True, False, "none", "partial"), (True, None, True, False, "complete", "failed"), (True, None, False, True, "none", "failed")]
    df = spark.createDataFrame(rows, "lic boolean, esc string, v boolean, l boolean, f string, want string")
    got = df.select("want", tracker.status_of(*[F.col(c) for c in ("lic", "esc", "v", "l", "f")]).alias("s")).collect()
    assert all(r.s == r.want for r in got)


def test_reasons_and_overrides(spark):
    rows = [(False, ["a M1.gif", "z"], True, None, None, "inline-math images -> ESCALATE"), (False, ["bad 'x' y"], True, None, None, "bad X y"), (True, [], False, None, None, "licence not CC-BY -> FAILED"),
            (True, [], True, "fail", "why", "fidelity: why"), (True, [], True, "flag", None, "fidelity flag: see sidecar"), (True, [], True, "pass", None, "")]
    df = spark.createDataFrame(rows, "both boolean, errors array<string>, lic boolean, fid string, detail string, want string")
    got = df.select("want", tracker.failure_reason(*[F.col(c) for c in ("both", "errors", "lic", "fid", "detail")]).alias("r")).collect()
    assert all(r.r == r.want for r in got)
    one = spark.range(1).select(tracker.overridden(F.lit(True), F.lit(1), F.lit(0), F.lit(2), F.lit("fail")).alias("o"), tracker.overridden(F.lit(True), F.lit(0), F.lit(0), F.lit(0), F.lit("flag")).alias("p")).first()
    assert tuple(one.o) == (False, 4, 0) and tuple(one.p) == (True, 0, 1)
    assert [r[0] for r in spark.createDataFrame([(True, 1, 1), (False, 1, 1), (False, 1, 0), (False, 0, 2)], "l boolean, e int, n int").select(tracker.figure_status(F.col("l"), F.col("e"), F.col("n"))).collect()] == ["complete", "partial", "none", "complete"]


def test_allocation_and_ranks(spark):
    files = spark.createDataFrame([(f"W{i}", i * 7) for i in range(50)], "id string, place bigint")
    known = spark.createDataFrame([("W3", "MORE-2025-910040"), ("W9", "MORE-2025-x")], "id string, mid string")
    got = {r.id: r.mid for r in tracker.allocate(files, known).collect()}
    assert got["W3"] == "MORE-2025-910040" and got["W0"] == "MORE-2025-910041" and got["W49"] == "MORE-2025-910088" and len(set(got.values())) == 50
    assert tracker.allocate(files, known.limit(0)).where("id = 'W0'").first().mid == "MORE-2025-910001"


def test_numbers_outgrow_their_width(spark):
    files = spark.createDataFrame([(f"W{i}", i) for i in range(30)], "id string, place bigint")
    known = spark.createDataFrame([("X", "MORE-2025-999989")], "id string, mid string")
    assert {r.id: r.mid for r in tracker.allocate(files, known).collect()} == {f"W{i}": f"MORE-2025-{999_990 + i}" for i in range(30)}
    rows = spark.range(10_020).selectExpr("format_string('W%05d', id) as id", "'s' as slug")
    assert {r.id: r.mid for r in tracker.pilot_numbers(rows).collect()} == {f"W{i:05d}": f"MORE-2025-99{i:04d}" for i in range(10_020)}


def test_ranks_by_ranges(spark, monkeypatch):
    """Many ranges, an outlier and a hot slug: every row has its place."""
    monkeypatch.setattr(tracker, "RANKED_ROWS", 50)
    ids = [*range(900), 10**15]
    got = {r.place: r["rank"] for r in tracker.ranked(spark.createDataFrame([(i,) for i in ids], "place bigint").repartition(5), "place").collect()}
    assert got == {x: i + 1 for i, x in enumerate(sorted(ids))}
    rows = [(f"W{i:04d}", "hot" if i % 3 else f"s{i % 7}") for i in range(600)]
    got = {r.id: int(r.mid[12:]) for r in tracker.pilot_numbers(spark.createDataFrame(rows, "id string, slug string")).collect()}
    assert got == {x[0]: i for i, x in enumerate(sorted(rows, key=lambda r: (r[1], r[0])))}
    assert tracker.ranked(spark.createDataFrame([], "place bigint"), "place").count() == 0


def test_limit_before_skip(spark):
    files = spark.createDataFrame([(f"W{i}",) for i in range(5)], "id string")
    log = spark.createDataFrame([("W0", "ingested"), ("W1", "failed")], "id string, ingest_status string")
    assert [r.id for r in selection.attempts(files, log, 3).orderBy("id").collect()] == ["W1", "W2"]
    assert selection.attempts(files, log, 3, redo=True).count() == 3 and selection.attempts(files, log, 3, no_retry=True).count() == 1


def test_low_tail(spark):
    for n in (0, 1, 19, 20, 39, 40, 100):
        xs = sorted(float(i) for i in range(n))
        want = None if not xs else xs[max(0, int(n * 0.05) - 1)] if n >= 20 else xs[0]
        df = spark.createDataFrame([("g", x) for x in xs], "g string, m double")
        got = reports.distribution(df, "g", ["m"]).collect()
        assert (got[0].p5 if got else None) == want
        assert spark.createDataFrame([(xs,)], "xs array<double>").select(reports.low_tail(F.col("xs"))).first()[0] == want


def test_links(spark):
    refs = spark.createDataFrame([("d", "r1", 0, "3"), ("d", "r2", 1, None), ("d", "r3", 2, "1")], "doc string, ref string, pos int, label string")
    cites = spark.createDataFrame([("d", 1, "1"), ("d", 2, "2"), ("d", 3, "9")], "doc string, cite int, number string")
    assert {r.cite: r.ref for r in matching.link_numbered(cites, refs).collect()} == {1: "r3", 2: "r2", 3: None}
    fonts = spark.createDataFrame([(["OpenSans", "AdvTimes"],), (["q"],)], "f array<string>").select(matching.rule_by_font(F.col("f"))).collect()
    assert [r[0] for r in fonts] == ["wiley", "_default"]


def test_stale(spark):
    df = spark.range(1).select(lineage.stale_steps(F.create_map(F.lit("tei_to_jats"), F.lit(3), F.lit("crosswalk"), F.lit(2))).alias("s"), lineage.stale_steps(F.lit(None).cast("map<string,int>")).alias("n")).first()
    assert set(df.s) == set(lineage.STEPS) - {"tei_to_jats", "crosswalk"} and set(df.n) == set(lineage.STEPS)


def test_stream(spark, tmp_path):
    src = str(tmp_path / "in")
    schema = "id string, ts timestamp, event_id bigint, status string"
    spark.createDataFrame([("a", 1, 1, "x"), ("b", 1, 2, "x")], "id string, s bigint, event_id bigint, status string").selectExpr("id", "timestamp_seconds(s) as ts", "event_id", "status").write.parquet(src)
    target, check = str(tmp_path / "out"), str(tmp_path / "check")
    for step in range(2):
        upsert_latest(spark.readStream.schema(schema).parquet(src), target, check).awaitTermination()
        if step == 0:
            spark.createDataFrame([("a", 5, 3, "y"), ("b", 0, 9, "old")], "id string, s bigint, event_id bigint, status string").selectExpr("id", "timestamp_seconds(s) as ts", "event_id", "status").write.mode("append").parquet(src)
    assert {r.id: r.status for r in spark.read.parquet(f"{target}/version=1").collect()} == {"a": "y", "b": "x"}
    q = windowed_counts(spark.readStream.schema(schema).parquet(src)).writeStream.format("memory").queryName("w").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination()
    assert sum(r.n for r in spark.table("w").collect()) == 4


def test_outcome_columns():
    assert list(tracker.OUTCOME_TYPES) == OUTCOME_COLUMNS


def test_sidecars_are_parsed_once(spark):
    texts = ['{"identity": {"work_id": "W1"}, "assets": {"count": 3}, "gates": {"errors": "7", "warnings": null}}', '{"identity": {}}', "[1]", "{", "", None, '{"identity": {"work_id": 5}, "assets": {"count": "x"}}']
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, sidecar string")
    found = sidecar_fields(df, more={"first": ("$[0]", "int")})
    got = {r.i: (r.bad, r.work_id, r.n_assets, r.err_count, r.warn_count, r.first) for r in found.collect()}
    assert got[0] == (False, "W1", 3, 7, None, None) and got[1][:2] == (False, None) and got[2] == (False, None, None, None, None, 1)
    assert got[3][0] and got[4][0] and got[5][0] and got[6] == (False, "5", None, None, None, None)
    assert found._jdf.queryExecution().executedPlan().toString().count("parse_json") <= 1 or found._jdf.queryExecution().executedPlan().toString().lower().count("parsejson") <= 1


def test_functions_of_sql(spark):
    names = register(spark)
    assert set(names) == {"scoap3_of", "route_of", "route_access_of", "asset_route_of", "lane_of", "disposition_of", "slug_of", "doi_spellings", "xml_addresses", "latex_spans"} and register(spark) == names
    rows = spark.sql(r"select t, s.* from values ('a $x$ \\cite{k}'), (null), ('none') as v(t), lateral latex_spans(t) s").collect()
    assert [(r.kind, r.content) for r in rows] == [("inline", "x"), ("cite", "k")]
    assert [tuple(r) for r in spark.sql("select u.place, u.url from values ('10.7717/peerj.12', 'J'), (null, null) as v(d, j), lateral xml_addresses(d, j) u").collect()] == [(0, "https://peerj.com/articles/12.xml")]
    plan = spark.sql("select lane_of(route_of(l, false, null, null, 'Wiley')) from values ('cc-by') as t(l)")._jdf.queryExecution().optimizedPlan().toString()
    assert "lane_of" not in plan.split("\n", 1)[1] if "\n" in plan else True  # inlined
