"""Packages of files, one folder per document, written by all tasks and committed as one.

A task writes its packages under a folder of its own in ``.staging-JOB``, where no reader looks. The driver commits in three steps: it puts down a
journal that names the folders of the tasks that ended well, it moves their packages to their places, and it takes the journal away. Until there is a
journal nothing of the job is to be seen; from then on the job is decided, and ``recover`` moves what a lost driver left. A task that fails, or
runs twice, leaves nothing but its folder, which goes with the staging folder.

A package that is there already is replaced whole: its old folder is put aside before the new one takes its place, so files of two versions never mix.
Moves are renames, on stores that have them. Packages are for deliveries: tables belong in Parquet.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from ..shipping import ship

STAGING, JOURNAL, ASIDE = ".staging-", ".journal-", ".aside-"
#: Packages that are moved at the same time.
MOVES = 16


def checked_name(name: str | None) -> str:
    """A name below a folder: no parts that lead elsewhere, and none that readers pass over."""
    parts = (name or "").split("/")
    if any(p == "" or p[0] in "._" or "\\" in p or "\0" in p for p in parts):
        raise ValueError(f"not the name of a file in a package: {name!r}")
    return name


@dataclass
class Written(WriterCommitMessage):
    """A task's folder and how much it wrote."""

    folder: str | None
    files: int


class PackageWriter(DataSourceArrowWriter):
    def __init__(self, path: str):
        self.path, self.job = path, uuid.uuid4().hex

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        """Writes rows (package, file, content); a null package is a file that stands alone."""
        fs, root = pafs.FileSystem.from_uri(self.path)
        folder, files, made = uuid.uuid4().hex, 0, set()
        for batch in iterator:
            for package, file, content in zip(batch.column("package").to_pylist(), batch.column("file").to_pylist(), batch.column("content"), strict=True):
                name = checked_name(file if package is None else f"{package}/{file}")
                if package is not None and "/" in package or package is None and "/" in name:
                    raise ValueError(f"a package is one folder: {name!r}")
                to = f"{root}/{STAGING}{self.job}/{folder}/{name}"
                above = to.rpartition("/")[0]
                if above not in made:
                    fs.create_dir(above, recursive=True)
                    made.add(above)
                with fs.open_output_stream(to) as out:
                    if content.is_valid:
                        out.write(content.as_buffer())
                files += 1
        return Written(folder if files else None, files)

    def commit(self, messages: list[Written | None]) -> None:
        fs, root = pafs.FileSystem.from_uri(self.path)
        folders = sorted(m.folder for m in messages if m is not None and m.folder)
        if folders:
            fs.create_dir(root, recursive=True)
            draft = f"{root}/{STAGING}{self.job}/journal"
            with fs.open_output_stream(draft) as out:
                out.write(json.dumps(folders).encode())
            fs.move(draft, f"{root}/{JOURNAL}{self.job}")
            finish(fs, root, self.job)
        else:
            _drop(fs, f"{root}/{STAGING}{self.job}")

    def abort(self, messages: list[Written | None]) -> None:
        fs, root = pafs.FileSystem.from_uri(self.path)
        _drop(fs, f"{root}/{STAGING}{self.job}")


def _kind(fs: pafs.FileSystem, path: str) -> pafs.FileType:
    return fs.get_file_info(path).type


def _drop(fs: pafs.FileSystem, path: str) -> None:
    kind = _kind(fs, path)
    if kind == pafs.FileType.Directory:
        fs.delete_dir(path)
    elif kind == pafs.FileType.File:
        fs.delete_file(path)


def _place(fs: pafs.FileSystem, root: str, job: str, staged: str) -> None:
    """Moves one package to its place. What was moved already is staged no more, so this can be done again at any point."""
    name = staged.rpartition("/")[2]
    to = f"{root}/{name}"
    if _kind(fs, to) != pafs.FileType.NotFound:
        aside = f"{root}/{ASIDE}{job}"
        fs.create_dir(aside, recursive=True)
        _drop(fs, f"{aside}/{name}")
        fs.move(to, f"{aside}/{name}")
    fs.move(staged, to)


def finish(fs: pafs.FileSystem, root: str, job: str) -> None:
    """Does what a job's journal says, from wherever it was left."""
    with fs.open_input_stream(f"{root}/{JOURNAL}{job}") as f:
        folders = json.loads(f.read())
    with ThreadPoolExecutor(MOVES) as pool:
        for folder in folders:  # one task's packages at a time
            staged = fs.get_file_info(pafs.FileSelector(f"{root}/{STAGING}{job}/{folder}", allow_not_found=True))
            for done in [pool.submit(_place, fs, root, job, x.path) for x in staged]:
                done.result()
    for rest in (f"{STAGING}{job}", f"{ASIDE}{job}", f"{JOURNAL}{job}"):
        _drop(fs, f"{root}/{rest}")


def recover(path: str, abandoned: bool = False) -> int:
    """Finishes the jobs under a path that were decided; how many. ``abandoned`` also drops what undecided ones left, which must not be running any more."""
    fs, root = pafs.FileSystem.from_uri(path)
    names = [x.base_name for x in fs.get_file_info(pafs.FileSelector(root, allow_not_found=True))]
    jobs = [n.removeprefix(JOURNAL) for n in names if n.startswith(JOURNAL)]
    for job in jobs:
        finish(fs, root, job)
    if abandoned:
        for n in names:
            if n.startswith((STAGING, ASIDE)) and n.partition("-")[2] not in jobs:
                _drop(fs, f"{root}/{n}")
    return len(jobs)


class Packages(DataSource):
    """A sink: rows (package, file, content) to folders of files under ``path``."""

    @classmethod
    def name(cls) -> str:
        return "packages"

    def schema(self) -> str:
        return "package string, file string, content binary"

    def writer(self, schema, overwrite: bool) -> PackageWriter:
        return PackageWriter(self.options["path"])


def write_packages(files: DataFrame, path: str) -> None:
    """files (package, file, content): all packages are there in the end, or none of them. A package's rows are brought to one task, which has one file in memory at a time."""
    spark = files.sparkSession
    ship(spark)
    recover(path)
    spark.dataSource.register(Packages)
    rows = files.select(F.col("package").cast("string").alias("package"), F.col("file").cast("string").alias("file"), F.col("content").cast("binary").alias("content"))
    key = F.coalesce("package", "file")
    rows.repartition(key).sortWithinPartitions("package", "file").write.format("packages").option("path", path).mode("append").save()


def read_packages(spark: SparkSession, path: str) -> DataFrame:
    """(package, file, content) of the packages under a path, once jobs that were decided are finished. Files that stand alone have no package; Spark's readers pass over empty files."""
    recover(path)
    _, root = pafs.FileSystem.from_uri(path)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    below = F.substring_index("path", root.rstrip("/") + "/", -1)
    alone = ~F.contains(below, F.lit("/"))
    return files.select(F.when(~alone, F.substring_index(below, "/", 1)).alias("package"), F.when(alone, below).otherwise(F.substring(below, F.locate("/", below) + 1, 1 << 20)).alias("file"), "content")
