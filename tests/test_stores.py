import json
from datetime import date

import pytest
from pyspark.sql import functions as F
from pyspark.sql.datasource import EqualTo, GreaterThan, GreaterThanOrEqual, In, LessThan, LessThanOrEqual

from siltstone.operators import documents, pilot
from siltstone.sources import acquire, sinks, stores

PAGES = {("a", "*"): ([{"n": 1}, {"n": 2}], "c2"), ("a", "c2"): ([{"n": 3}], "c3"), ("a", "c3"): ([], "c4"), ("b", "*"): ([{"n": 9}], None)}


def transport(ask, cursor):
    """A remote store: the pages of two filters."""
    return PAGES[ask, cursor]


def test_paged_source(spark):
    got = stores.read_paged(spark, "tests.test_stores:transport", ["a", "b"])
    assert sorted((r.ask, json.loads(r.record)["n"]) for r in got.collect()) == [("a", 1), ("a", 2), ("a", 3), ("b", 9)]
    assert stores.read_paged(spark, "tests.test_stores:transport", []).count() == 0


COLUMNS = "id string, year int, kind string, score bigint, day date"
STORE = [{"id": f"w{y}-{i}", "year": y, "kind": "abc,"[i % 4] if i % 7 else None, "score": i, "day": f"2024-01-{1 + i % 28:02d}"} for y in range(2019, 2025) for i in range(95)]


def store_pages(store, asked, columns, cursor, most):
    """A remote store of 20 records a page that filters by itself, and writes down what it was asked."""
    tests = dict(c.split(":", 1) for c in asked.split(",") if c)
    rows = [r for r in STORE if all(stores._passes(r[{"publication_year": "year"}.get(k, k)], v) for k, v in tests.items())]
    at = 0 if cursor == "*" else int(cursor)
    n = min(20, most or 20)
    with open(store, "a") as f:
        f.write(f"{asked} {' '.join(columns)}\n")
    return [{c: r[c] for c in columns} for r in rows[at : at + n]], str(at + n) if at + n < len(rows) else None


FILTERS = {"year": "publication_year", "kind": "kind", "score": "score"}
YEARS = list(range(2019, 2025))
WHERE = [
    ([EqualTo(("year",), 2021)], "year = 2021"), ([In(("year",), (2020, 2023)), EqualTo(("kind",), "a")], "year in (2020, 2023) and kind = 'a'"),
    ([GreaterThan(("year",), 2021), LessThanOrEqual(("year",), 2023), GreaterThanOrEqual(("score",), 90)], "year > 2021 and year <= 2023 and score >= 90"),
    ([In(("kind",), ("b", "a")), LessThan(("score",), 3)], "kind in ('a', 'b') and score < 3"), ([EqualTo(("kind",), ",")], "kind = ','"), ([EqualTo(("day",), date(2024, 1, 3)), EqualTo(("year",), 2024)], "day = date'2024-01-03' and year = 2024"),
    ([EqualTo(("year",), 1900)], "false"), ([], "true")]


def read(spark, log, where=(), **more):
    return stores.read_store(spark, "tests.test_stores:store_pages", COLUMNS, FILTERS, list(where), str(log), "year", YEARS, **more)


def plain(spark):
    return spark.createDataFrame(STORE, "id string, year int, kind string, score bigint, day string").withColumn("day", F.col("day").cast("date")).select("id", "year", "kind", "score", "day")


@pytest.mark.parametrize("where, text", WHERE)
def test_store_filters_are_pushed(spark, tmp_path, where, text):
    """Rows are those of a plain table, whatever else a query asks of the frame."""
    got, want = read(spark, tmp_path / "asked", where), plain(spark).where(text)
    for more in ("true", "kind = 'b'", "year = 2020 or score > 50"):
        assert sorted(map(str, got.where(more).collect())) == sorted(map(str, want.where(more).collect()))


def test_queries_of_one_frame_keep_apart(spark, tmp_path):
    got, want = read(spark, tmp_path / "asked", [GreaterThan(("year",), 2020)]), plain(spark).where("year > 2020")
    one, two = (x.where("year = 2021").union(x.where("year = 2022 and kind = 'a'")).union(x.where("year > 2020")) for x in (got, want))
    assert sorted(map(str, one.collect())) == sorted(map(str, two.collect()))
    assert got.where("year = 2030").count() == 0 and got.count() == want.count()


def test_store_asks_for_less(spark, tmp_path):
    def asked(where, **more):
        log = tmp_path / f"asked{len(list(tmp_path.iterdir()))}"
        df = read(spark, log, where, **more)
        n = len(df.collect())
        return df, n, log.read_text().splitlines() if log.exists() else []

    _, n, every = asked([])
    assert n == len(STORE) and len(every) == 30 and every[0].endswith(" id year kind score day")
    df, n, some = asked([EqualTo(("year",), 2021), EqualTo(("kind",), "a")])
    plan = df._jdf.queryExecution().toString()
    assert "Filter (" not in plan.split("Physical Plan")[1]  # nothing is left for Spark to test
    assert set(some) == {"kind:a,publication_year:2021 id year kind score day"} and len(some) == -(-n // 20)
    assert asked([EqualTo(("year",), 1900)])[2] == []
    _, n, few = asked([], keep=["id", "year"], most=7)
    assert n == 7 and all(x.endswith(" id year") for x in few) and len(few) <= 6
    assert asked([EqualTo(("year",), 2020)], base="score:<5")[2] == ["score:<5,publication_year:2020 id year kind score day"]
    # a value that the store's words can't hold is tested by Spark, on all rows
    _, n, more = asked([EqualTo(("kind",), ","), EqualTo(("year",), 2020)], most=3)
    assert n == 3 and all("kind:" not in x for x in more)


def test_pushed_filters_in_the_plan(spark, tmp_path, capsys):
    read(spark, tmp_path / "asked", [EqualTo(("year",), 2021), EqualTo(("kind",), ",")]).explain("formatted")
    pushed = next(x for x in capsys.readouterr().out.splitlines() if x.startswith("PushedFilters"))
    assert "EqualTo(year,2021)" in pushed and "kind" not in pushed


def test_landed_store(spark, tmp_path):
    rows = spark.createDataFrame(STORE, "id string, year int, kind string, score bigint, day string")
    stores.land(rows, f"file://{tmp_path}/store", "year")
    args = ("siltstone.sources.stores:fetch_landed", "id string, year int, kind string, score bigint", {"year": "by", "kind": "kind", "score": "score"})
    got = stores.read_store(spark, *args, [EqualTo(("kind",), "b"), GreaterThan(("score",), 40)], f"file://{tmp_path}/store", "year", [2019, 2020, 2030])
    assert sorted(r.id for r in got.collect()) == sorted(r["id"] for r in STORE if r["year"] in (2019, 2020) and r["kind"] == "b" and r["score"] > 40)
    assert stores.read_store(spark, *args, [], f"file://{tmp_path}/store", "year", [2019, 2020, 2030]).count() == 190


def test_second_store_and_catalogue(spark, tmp_path):
    spark.createDataFrame([(1, "x", None)], "id int, name string, `odd name` double").write.parquet(f"{tmp_path}/t")
    sub = stores.subset(spark, f"{tmp_path}/t", ["odd name", "id", "missing"])
    assert sub.columns == ["id", "odd name"] and "name:string" not in sub._jdf.queryExecution().executedPlan().toString()
    assert [tuple(r) for r in stores.catalogue(sub).collect()] == [(0, "id", "int"), (1, "odd name", "double")]


def test_sinks(spark, tmp_path):
    rows = spark.createDataFrame([("a", "<x>é</x>"), ("b", None)], "id string, article string")
    sinks.write_article_files(rows, f"{tmp_path}/xml")
    sinks.write_article_files(rows, f"{tmp_path}/xml")
    assert [p.name for p in (tmp_path / "xml").iterdir()] == ["a.xml"] and (tmp_path / "xml/a.xml").read_text() == "<x>é</x>"
    sinks.write_report(rows, f"{tmp_path}/report")
    assert len(list((tmp_path / "report").glob("*.json"))) == 1
    assert sinks.save_table(rows, "saved_rows").count() == 2
    spark.sql("drop table saved_rows")
    works = spark.createDataFrame([("1", "cc-by", "publishedVersion", True), ("2", "cc-by", "x", True)], "id string, license string, version string, has_pdf boolean")
    assert [r.id for r in sinks.publish_view(works, "view_of_works").collect()] == ["1"] and spark.sql("select * from view_of_works").count() == 1


def test_source_figures(spark):
    picked = spark.createDataFrame([("a", "x", "x.png"), ("a", "y", "y.pdf"), ("b", "x", "x.png"), ("c", "q", "q.png"), ("c", "p", "p.png"), ("d", "x", "x.png"), ("d", "y", "y.png")], "path string, stem string, member string")
    order = spark.createDataFrame([("a", 0, "y"), ("a", 1, "x"), ("a", 2, "y"), ("d", 0, "x")], "path string, place int, stem string")
    wanted = spark.createDataFrame([("a", 2), ("b", 2), ("c", 2), ("d", 2)], "path string, figures int")
    got = sorted(map(tuple, acquire.source_figures(picked, order, wanted).collect()))
    assert got == [("a", 1, "y.pdf"), ("a", 2, "x.png"), ("c", 1, "p.png"), ("c", 2, "q.png")]  # b has too few, of d one isn't included


def test_described_and_checked(spark):
    works = spark.createDataFrame([("1", None, "J", "T")], "id string, publisher string, journal string, title string")
    m = spark.createDataFrame([("1", "p"), ("2", "q")], "id string, publisher string")
    assert sorted(map(tuple, pilot.described(m, works).collect())) == [("1", None, "J", "T"), ("2", "q", None, None)]
    words = " ".join(f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(200))
    articles = spark.createDataFrame([("1", f"<article><body><p>{words}</p></body><back><ref-list><ref/></ref-list></back></article>")], "id string, article string")
    sources = spark.createDataFrame([("1", "<TEI><back><listBibl><biblStruct/></listBibl></back></TEI>")], "id string, xml string")
    texts = spark.createDataFrame([("1", words)], "id string, text string")
    got = documents.checked(articles, sources, texts, source_tokens=100).first()
    assert (got.verdict, got.completeness, got.ref_target, got.ref_source) == ("pass", 1.0, 1, 1)
