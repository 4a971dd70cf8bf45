import json

from pyspark.sql import functions as F

from siltstone.__main__ import main
from siltstone.sources import acquire, sinks
from siltstone.sources.records import file_inventory


def test_records_and_payloads(spark):
    recs = json.dumps([{"dois": ["10.1/B"], "files": [{"file": "x", "filetype": "xml"}]}, {"dois": ["10.1/A"], "files": [{"file": "p", "filetype": "pdf"}, {"file": "y", "filetype": "xml"}], "eprints": ["10.1/a", "2401.01234"]}])
    r = F.from_json(F.lit(recs), acquire.RECORDS)
    row = spark.range(1).select(acquire.pick_file(r, F.lit("10.1/a"), "xml").alias("f"), acquire.eprint(r).alias("e"), acquire.pick_file(r, F.lit("zz"), "xml").alias("none")).first()
    assert tuple(row) == ("y", "2401.01234", None)
    df = spark.createDataFrame([('<Header><BodyRef FileRef="http://a/b.ft.xml"/>',), ('<article/><BodyRef FileRef="http://a/b.ft.xml"/>',), ("<ce:para>",), ("http://www.tei-c.org/ns/1.0",), (None,)], "t string")
    got = df.select(acquire.body_reference("t").alias("b"), acquire.is_full_text("t").alias("f"), acquire.is_tei("t").alias("x"), acquire.is_pdf("t").alias("p")).collect()
    assert [tuple(g) for g in got] == [("http://a/b.ft.xml", False, False, False), (None, False, False, False), (None, True, False, False), (None, False, True, False), (None, False, False, False)]
    assert spark.createDataFrame([("cc-by",), (None,), ("cc0",)], "license string").where(acquire.allowed()).count() == 1
    assert [r.ask for r in acquire.lookups(spark.createDataFrame([("W", "10.1007/jhep01(2025)1")], "id string, doi string")).orderBy("place").collect()] == ["10.1007/jhep01(2025)1", "10.1007/JHEP01(2025)1"]


def test_printed_licence(spark):
    rows = [("a", 0, "under the Creative Commons Attribution License", []), ("a", 1, "see https://creative\ncommons.org/licenses/BY-NC/4.0/", []), ("b", 0, "Creative Commons Attribution-NonCommercial 3.0 Unported Licence", []),
            ("c", 0, "Creative Commons Attribution License", ["http://x", "https://creativecommons.org/licenses/by/4.0/"]), ("d", 4, "creativecommons.org/licenses/by/4.0", []), ("d", 9, "x", []), ("e", 0, "Creative  Commons Attribution\nLicence", None)]
    got = {r.id: (r.url, r.prose) for r in acquire.printed_licence(spark.createDataFrame(rows, "id string, page int, text string, links array<string>")).collect()}
    assert got["a"][0] == "https://creativecommons.org/licenses/by-nc/4.0/" and got["b"][0] == "https://creativecommons.org/licenses/by-nc/3.0/" and got["c"][0] == "https://creativecommons.org/licenses/by/4.0/"
    assert got["d"] == (None, None) and got["e"] == (None, "Creative Commons Attribution Licence")


def test_sinks(spark, tmp_path):
    p = str(tmp_path / "pages")
    sinks.write_pages(spark.createDataFrame([(1, 2024), (2, 2025)], "id int, year int"), p)
    sinks.write_pages(spark.createDataFrame([(3, 2025)], "id int, year int"), p)
    assert sorted(tuple(r) for r in spark.read.parquet(p).select("id", "year").collect()) == [(1, 2024), (3, 2025)]
    one, two = str(tmp_path / "m1"), str(tmp_path / "m2")
    spark.createDataFrame([("a", 1), ("b", 1)], "id string, v int").write.parquet(one)
    sinks.upsert_manifest(spark.createDataFrame([("b", 2), ("c", 2)], "id string, v int"), one, two)
    assert {r.id: r.v for r in spark.read.parquet(two).collect()} == {"a": 1, "b": 2, "c": 2}
    sinks.promote(spark, two, one)
    assert spark.read.parquet(one).count() == 3 and not (tmp_path / "m2").exists()
    sinks.append_manifest(spark.range(1), str(tmp_path / "log"))
    sinks.append_manifest(spark.range(1), str(tmp_path / "log"))
    assert spark.read.json(str(tmp_path / "log")).count() == 2
    sinks.write_articles(spark.createDataFrame([("a", "<x/>"), ("b", None)], "id string, article string"), str(tmp_path / "art"), 1)
    assert spark.read.json(str(tmp_path / "art")).count() == 1
    got = file_inventory(spark, str(tmp_path / "art"), "*.gz").first()
    assert got.folder == "art" and got.bytes > 0


def test_command_line(spark, capsys):
    assert main(["query", "--limit-shown", "200"]) == 0 and "route_works" in capsys.readouterr().out
    assert main(["policy", "--limit-shown", "99"]) == 0 and "scoap3_aps" in capsys.readouterr().out
    assert main(["query", "landscape"]) == 0
