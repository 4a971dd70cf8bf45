import os
import re

from hypothesis import given, settings
from hypothesis import strategies as st

from siltstone.plans.rules import DERIVED, LANES, explain, route_works

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SCHEMA = "id string, publisher string, journal string, license string, in_pmc boolean, pdf_url string, has_pdf boolean, has_grobid boolean"


def golden():
    """The golden table of FIXTURES.md."""
    for line in open(os.path.join(ROOT, "FIXTURES.md"), encoding="utf-8"):
        cells = [c.strip() for c in line.strip().strip("|").split("|")]
        if re.fullmatch(r"W\d+", cells[0]) and len(cells) == 14:
            yield [None if c == "NULL" else c for c in cells]


def rows_of(cells):
    flag = {"T": True, "F": False}
    return [(c[0], c[1], c[2], c[3], flag[c[4]], "u" if c[5] == "T" else None, flag[c[6]], flag[c[7]]) for c in cells]


def test_golden(spark):
    want = list(golden())
    assert len(want) == 36
    got = {r.id: r for r in route_works(spark.createDataFrame(rows_of(want), SCHEMA)).collect()}
    for c in want:
        assert [got[c[0]][n] for n in DERIVED] == [c[8], c[9], c[10], c[11], c[12], c[13]], c[0]


def test_edges(spark):
    rows = [
        ("nulls", None, None, None, None, None, None, None), ("pmc-not-by", "Wiley", "X", None, True, None, False, False), ("case", "elsevier bv", "x", "cc-by", False, None, None, False),
        ("upper", "Wiley", "PHYSICAL REVIEW D", "cc-by", False, None, True, False), ("sa", "Wiley", "x", "cc-by-sa", False, "u", True, False), ("both", "Wiley", "Physical Review D and High Energy Physics", "cc-by", None, None, None, None),
        ("hp", "Wiley", "x", "cc-by", False, None, True, False), ("quote", "O'Reilly", "x", "cc-by", False, None, None, False),
    ]
    got = {r.id: tuple(r[c] for c in DERIVED) for r in route_works(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got["nulls"] == (None, "out_of_scope", "na", "na", "out_of_scope", "source_aam")
    assert got["pmc-not-by"][1] == "out_of_scope" and got["case"][1:] == ("convert", "none", "none", "B_convert", "convert_vor")
    assert got["upper"][0] == got["both"][0] == "aps" and got["upper"][1] == "scoap3_aps"
    assert got["sa"][1] == "out_of_scope" and got["sa"][5] == "convert_vor" and got["hp"][3] == "pdf_extract_laneB" and got["quote"][1] == "convert"


values = st.tuples(st.sampled_from([None, "Wiley", "Elsevier", "PeerJ", "Zenodo", "x"]), st.sampled_from([None, "Physics Letters B", "Physical Review C", "y"]), st.sampled_from([None, "cc-by", "cc0", "cc-by-nc"]),
                   st.sampled_from([None, True, False]), st.sampled_from([None, "u"]), st.sampled_from([None, True, False]))


@settings(max_examples=5, deadline=None)
@given(st.lists(values, min_size=1, max_size=60))
def test_lane_follows_route(spark, rows):
    df = spark.createDataFrame([(str(i), *r, False) for i, r in enumerate(rows)], SCHEMA)
    for r in route_works(df, provenance=True).collect():
        assert r.lane == LANES.get(r.route, "out_of_scope")
        assert (r.route_arm is None) == (r.route == "convert")
        assert (r.route == "out_of_scope") == (r.license != "cc-by")


def test_explain():
    assert ("route", 0, "out_of_scope", "licence isn't cc-by") in explain()


def test_plan_is_one_scan_without_shuffle(spark, tmp_path):
    path = str(tmp_path / "w")
    spark.createDataFrame(rows_of(golden()), SCHEMA).write.parquet(path)
    plan = route_works(spark.read.parquet(path)).select("id", "lane")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Exchange" not in plan and "has_grobid" not in plan.split("ReadSchema")[1]
