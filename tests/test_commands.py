import json

import pytest

from siltstone.__main__ import COMMANDS, main
from siltstone.operators.documents import sample_articles

D = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def at(spark, tmp_path_factory):
    """A tracker built from pages, and the tables that commands read."""
    d = tmp_path_factory.mktemp("commands")
    (d / "pages").mkdir()
    page = [{"id": f"W{i}", "doi": f"10.1/{i}", "year": 2020 + i % 5, "journal": "J", "publisher": "Wiley" if i % 2 else "Zenodo", "license": "cc-by", "version": "publishedVersion", "in_pmc": i % 7 == 0, "has_pdf": True, "has_grobid": i % 3 == 0, "is_oa": True} for i in range(60)]
    (d / "pages/page_0001.json").write_text(json.dumps(page))
    (d / "log.json").write_text(json.dumps({"W0": {"ingest_status": "ingested", "gates_passed": True, "mid": "M-1", "ts": "2025"}, "W7": {"ingest_status": "failed"}}))
    assert main(["build", f"{d}/pages", "--outcomes", f"{d}/log.json", "--out", f"{d}/tracker"]) == 0
    return d


def shown(capsys, *argv):
    assert main(list(argv)) == 0
    return capsys.readouterr().out


def test_over_a_tracker(spark, at, capsys):
    t = f"{at}/tracker"
    assert spark.read.parquet(t).where("ingest_status = 'ingested'").count() == 1
    assert "|   36|" in shown(capsys, "landscape", t, "--since", "2022")
    assert "pending" in shown(capsys, "status", t) and "10.1/5" in shown(capsys, "find", t, "--doi", "10.1/5")
    assert "W1" in shown(capsys, "fetch", t, "--route", "gated_commercial", "--limit", "5")
    assert "Wiley" in shown(capsys, "sample", t, "--per", "2") and "Zenodo" in shown(capsys, "corpus", t, "--plan", "Zenodo:3", "--with-tei")
    out = shown(capsys, "attempts", t, f"{at}/log.json", "--limit", "3", "--no-retry")
    assert "W0 " not in out and "W7 " not in out


def test_over_documents(spark, at, capsys):
    docs = spark.read.parquet(f"{D}/documents.parquet").limit(20)
    sample_articles(docs).write.parquet(f"{at}/sources")
    assert "<?xml" in shown(capsys, "crosswalk", f"{at}/sources", "--out", f"{at}/articles")
    spark.read.parquet(f"{at}/articles").selectExpr("id", "article", "cast(null as array<struct<file:string,caption:string,num:int>>) as found").write.parquet(f"{at}/found")
    assert "wired" in shown(capsys, "repair", f"{at}/found")
    spark.createDataFrame([("$\\alpha$",)], "caption string").write.parquet(f"{at}/captions")
    assert "α" in shown(capsys, "captions", f"{at}/captions")
    words = " ".join(f"word{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{chr(97 + i // 676)}" for i in range(3000))
    pairs = spark.createDataFrame([("1", words, words, 1, 1, None), ("2", words, "other", 1, 1, None)], "pair_id string, source_text string, target_text string, ref_target int, ref_source int, floor double")
    pairs.where("pair_id = '1'").write.parquet(f"{at}/good")
    pairs.write.parquet(f"{at}/pairs")
    assert main(["fidelity", f"{at}/good", "--floor", "0.7"]) == 0 and main(["fidelity", f"{at}/pairs"]) == 1


def test_reports(spark, at, capsys):
    spark.createDataFrame([("W1", "p", "Wiley"), ("W2", "q", "Zenodo")], "id string, slug string, publisher string").write.parquet(f"{at}/manifest")
    spark.createDataFrame([("W1", True, False, 2, 1)], "id string, validate boolean, lint boolean, errors int, warnings int").write.parquet(f"{at}/verdicts")
    spark.createDataFrame([("W1", "bad id 77")], "id string, message string").write.parquet(f"{at}/findings")
    four = [f"{at}/manifest", f"{at}/works", f"{at}/verdicts", f"{at}/findings"]
    spark.createDataFrame([("W1", "P", "J", "T")], "id string, publisher string, journal string, title string").write.parquet(f"{at}/works")
    assert "MORE-2025-990000" in shown(capsys, "pilot", *four, "--report", "results") and "bad id N" in shown(capsys, "pilot", *four, "--report", "kinds", "--only", "p")
    spark.createDataFrame([("p", True, 0.9, 0.8, 1.0, 1.0)], "slug string, lint_pass boolean, completeness double, grounding double, mass_ratio double, num_recall double").write.parquet(f"{at}/measured")
    assert "grounding" in shown(capsys, "calibrate", f"{at}/measured") and "0.9" in shown(capsys, "calibrate", f"{at}/measured", "--by-publisher")
    spark.createDataFrame([("a", 1, 0.5, False), ("a", 2, 9.0, False)], "slug string, pos int, cost double, on_disk boolean").write.parquet(f"{at}/items")
    assert "0.5" in shown(capsys, "budget", f"{at}/items", "--budget", "1")
    assert "shared folder" in shown(capsys, "doctor") and "route" in shown(capsys, "policy") and "route_works" in shown(capsys, "query", "--limit-shown", "200")
    assert len(shown(capsys, "query", "license_mix").splitlines()) > 3 and len(COMMANDS) == 18
