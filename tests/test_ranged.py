import gzip
import io
import os
import tarfile
import zipfile

import pytest
from pyspark.sql import functions as F

from siltstone.sources import ranged
from siltstone.sources.ranged import member_index, read_ranges, write_archives


@pytest.fixture
def archives(tmp_path):
    """Archives of several kinds and what is in them."""
    want = {}
    files = [(f"d{i % 3}/file-{i}-{'é' * (i % 4)}{'long' * (40 if i == 7 else 1)}.txt", os.urandom(i * 37) if i % 2 else b"text " * i * 50) for i in range(30)]
    for kind in ("w", "w:gz"):
        p = tmp_path / f"a.tar{'.gz' if ':' in kind else ''}"
        with tarfile.open(p, kind) as t:
            for name, data in files:
                info = tarfile.TarInfo(name)
                info.size = len(data)
                t.addfile(info, io.BytesIO(data))
            folder = tarfile.TarInfo("folder")
            folder.type = tarfile.DIRTYPE
            t.addfile(folder)
        want[str(p)] = files
    for name, method in (("deflated", zipfile.ZIP_DEFLATED), ("stored", zipfile.ZIP_STORED)):
        p = tmp_path / f"{name}.zip"
        with zipfile.ZipFile(p, "w", method) as z:
            z.mkdir("empty")
            for n, data in files:
                z.writestr(n, data)
        want[str(p)] = files
    (tmp_path / "one.gz").write_bytes(gzip.compress(b"one") + gzip.compress(b" two"))
    want[str(tmp_path / "one.gz")] = [("one", b"one two")]
    with zipfile.ZipFile(tmp_path / "none.zip", "w"):
        pass
    return tmp_path, want


def test_members_of_every_kind(spark, archives):
    tmp_path, want = archives
    (tmp_path / "bad.zip").write_bytes(b"PK not one")
    (tmp_path / "cut.tar").write_bytes((tmp_path / "a.tar").read_bytes()[:9000])
    paths = [*want, str(tmp_path / "none.zip"), str(tmp_path / "bad.zip"), str(tmp_path / "cut.tar"), str(tmp_path / "missing.tar"), None]
    index = member_index(spark.createDataFrame([(p,) for p in paths], "path string"))
    got = read_ranges(index).collect()
    for p, files in want.items():
        assert [(r.name, bytes(r.content)) for r in sorted((r for r in got if r.path == p), key=lambda r: r.place)] == files
    odd = {os.path.basename(r.path): r.error for r in got if r.error}
    assert set(odd) == {"bad.zip", "cut.tar", "missing.tar"} and not [r for r in got if r.path.endswith("none.zip")]
    assert read_ranges(index.where("name like '%file-7-%'")).count() == 3  # of two zips and a tar; a gzip stream has no ranges, and is one row
    assert read_ranges(member_index(spark.createDataFrame([], "path string"))).count() == 0


def test_only_ranges_are_read(archives, monkeypatch):
    """An index reads headers; a member reads its bytes. Neither reads the archive."""
    tmp_path, _ = archives
    p = str(tmp_path / "big.tar")
    with tarfile.open(p, "w") as t:
        for i in range(40):
            info = tarfile.TarInfo(f"{i}")
            info.size = 1 << 20
            t.addfile(info, io.BytesIO(bytes([i]) * (1 << 20)))
    read = []

    class Counted:
        def __init__(self, f):
            self.f = f

        def __getattr__(self, name):
            return getattr(self.f, name)

        def __enter__(self):
            return self

        def __exit__(self, *a):
            self.f.close()

        def read(self, n=-1):
            out = self.f.read(n)
            read.append(len(out))
            return out

    opened = ranged._opened
    monkeypatch.setattr(ranged, "_opened", lambda path: Counted(opened(path)))
    rows = list(ranged.index_of(p))
    assert len(rows) == 40 and sum(read) < 40 * 2048
    read.clear()
    with ranged._opened(p) as f:
        assert ranged._one(f, *rows[33][3:7]) == bytes([33]) * (1 << 20)
    assert sum(read) == 1 << 20


@pytest.mark.parametrize("gz", [False, True])
def test_written_archives(spark, tmp_path, gz):
    rows = [(f"w{i % 5}", f"m{i:03d}", os.urandom(100)) for i in range(60)]
    made = write_archives(spark.createDataFrame(rows, "archive string, member string, content binary"), f"file://{tmp_path}/out", gz)
    made.write.parquet(f"{tmp_path}/list")
    listed = spark.read.parquet(f"{tmp_path}/list")
    assert {r.archive: r.members for r in listed.collect()} == {f"w{i}": 12 for i in range(5)}
    got = read_ranges(member_index(listed)).join(listed, "path").select("archive", "name", F.col("content")).collect()
    assert sorted((r.archive, r.name, bytes(r.content)) for r in got) == sorted(rows)
