import math

import duckdb
import pytest

import siltstone.house_queries  # noqa: F401
import siltstone.more_queries  # noqa: F401
import siltstone.store_queries  # noqa: F401
from siltstone.queries import ORACLES, QUERIES

D = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{D}/{t}.parquet'")
    return c


def plain(v):
    return None if isinstance(v, float) and math.isnan(v) else round(v, 9) if isinstance(v, float) else v


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, D)
    columns = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=str)
    assert got
    if name in ORACLES:
        cur = con.execute(ORACLES[name])
        at = {d[0]: i for i, d in enumerate(cur.description)}
        assert sorted(at) == columns
        assert got == sorted((tuple(plain(r[at[c]]) for c in columns) for r in cur.fetchall()), key=str)


def test_latex_query(spark):
    row = QUERIES["latex_clean"](spark, D).where("doc_id = 15").first()
    assert row.caption == "The √s = 1 TeV pT⁶ α≤β – ref "


def test_crosswalked_articles(spark):
    rows = QUERIES["article_fingerprint"](spark, D).collect()
    assert all(r.error is None and r.root_is_article and r.has_title and r.ref_count == 1 and r.bibr_links == 1 for r in rows)
