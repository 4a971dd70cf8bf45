import glob

from siltstone.llm.common import clean, written


def test_written_tables_go_at_the_end(spark):
    base = spark.conf.get("spark.checkpoint.dir").removeprefix("file://")
    df = written(spark.range(10))
    assert df.count() == 10 and glob.glob(f"{base}/siltstone-*")
    clean(spark)
    assert not glob.glob(f"{base}/siltstone-*")
    clean(spark)


def test_oracles_are_texts_of_queries():
    from siltstone.llm.queries import ORACLES, QUERIES

    assert set(ORACLES) <= set(QUERIES) and all(isinstance(x, str) for x in ORACLES.values()) and len(QUERIES) == 13
