import pyarrow.fs as pafs
import pytest
from pyspark.sql import functions as F

from siltstone.sources import packages
from siltstone.sources.packages import read_packages, recover, write_packages

SCHEMA = "package string, file string, content binary"


def files_of(n, version=b"1"):
    return [(f"W{i}", name, version + name.encode() * i) for i in range(n) for name in ("article.xml", "assets/fig1.png", "metadata.json")]


def there(spark, path):
    return [(r.package, r.file, bytes(r.content)) for r in read_packages(spark, path).collect()]


def names(path):
    return sorted(x.base_name for x in pafs.LocalFileSystem().get_file_info(pafs.FileSelector(path, allow_not_found=True)))


def test_round_trip_and_replacement(spark, tmp_path):
    path = str(tmp_path / "out")
    rows = [*files_of(40), (None, "index.xml", b"<x/>"), ("empty", "none", None)]
    write_packages(spark.createDataFrame(rows, SCHEMA).repartition(5), path)
    assert sorted(there(spark, path), key=str) == sorted((r for r in rows if r[2]), key=str)
    assert (tmp_path / "out/empty/none").read_bytes() == b""  # Spark's readers pass over empty files
    assert not [n for n in names(path) if n.startswith(".")]
    # a package is replaced whole: its old figure goes
    write_packages(spark.createDataFrame([("W3", "article.xml", b"new"), ("W99", "article.xml", b"more")], SCHEMA), path)
    got = {(p, f): c for p, f, c in there(spark, path)}
    assert got["W3", "article.xml"] == b"new" and ("W3", "assets/fig1.png") not in got and got["W99", "article.xml"] == b"more" and ("W4", "assets/fig1.png") in got
    write_packages(spark.createDataFrame([], SCHEMA), path)
    assert len(there(spark, path)) == len(got)


def test_a_failed_task_leaves_nothing(spark, tmp_path):
    path = str(tmp_path / "out")
    write_packages(spark.createDataFrame(files_of(3), SCHEMA), path)
    before = set(there(spark, path))
    broken = spark.createDataFrame(files_of(60, b"2"), SCHEMA).repartition(6).withColumn("content", F.when(F.col("package") == "W57", F.raise_error(F.lit("lost")).cast("binary")).otherwise(F.col("content")))
    with pytest.raises(Exception, match="lost"):
        write_packages(broken, path)
    assert set(there(spark, path)) == before and not [n for n in names(path) if n.startswith(".")]
    for bad in (("..", "x"), ("W1", "../../x"), ("W1", "/x"), ("W1", "_x"), ("a/b", "x"), (None, "a/b"), (None, None)):
        with pytest.raises(Exception, match="not the name of a file|a package is one folder"):
            write_packages(spark.createDataFrame([("W0", "late", b"x"), (*bad, b"x")], SCHEMA), path)
    assert set(there(spark, path)) == before


@pytest.mark.parametrize("moves", [0, 1, 7])
def test_a_lost_driver_is_recovered(spark, tmp_path, monkeypatch, moves):
    """The driver ends after some moves: readers that recover see the whole job, once."""
    path = str(tmp_path / "out")
    write_packages(spark.createDataFrame(files_of(5), SCHEMA), path)
    place, done = packages._place, []

    def lost(fs, root, job, staged):
        if len(done) >= moves:
            raise KeyboardInterrupt
        done.append(staged)
        place(fs, root, job, staged)

    monkeypatch.setattr(packages, "_place", lost)
    monkeypatch.setattr(packages, "MOVES", 1)
    writer = packages.PackageWriter(path)
    batch = spark.createDataFrame(files_of(12, b"2"), SCHEMA).toArrow().to_batches()
    message = writer.write(iter(batch))
    with pytest.raises(KeyboardInterrupt):
        writer.commit([message, None])
    monkeypatch.setattr(packages, "_place", place)
    assert [n for n in names(path) if n.startswith(packages.JOURNAL)]
    assert set(there(spark, path)) == set(files_of(12, b"2"))
    assert not [n for n in names(path) if n.startswith(".")] and recover(path) == 0


def test_undecided_jobs_are_not_seen(spark, tmp_path):
    path = str(tmp_path / "out")
    writer = packages.PackageWriter(path)
    writer.write(iter(spark.createDataFrame(files_of(4), SCHEMA).toArrow().to_batches()))
    assert [n for n in names(path) if n.startswith(packages.STAGING)] and recover(path) == 0
    assert spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).count() == 0
    assert recover(path, abandoned=True) == 0 and names(path) == []
