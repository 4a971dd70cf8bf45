"""Members of archives of any size: an index of where each lies, then reads of just these ranges.

An archive's index is read by seeking: the headers of a tar, the directory at the end of a zip. A member is then a row (path, offset, packed size), and members are read
by as many tasks as their bytes ask for, whichever archive they are in: a task holds one member and the batch it makes. An archive that is one gzip stream has no ranges; it is read
through once, by one task, a member at a time.

``archives.read_members`` is for small archives that are in a column already.
"""

from __future__ import annotations

import io
import struct
import tarfile
import uuid
import zipfile
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..shipping import ship

#: Bytes of members that a task reads, of content that a batch has, and of an archive that is read at a time.
TASK_BYTES, BATCH_BYTES, READ_BYTES = 128 << 20, 16 << 20, 1 << 20
SMALL = 1 << 16
INDEX = pa.schema([("path", pa.string()), ("place", pa.int64()), ("name", pa.string()), ("method", pa.string()), ("offset", pa.int64()), ("packed", pa.int64()), ("size", pa.int64()), ("error", pa.string())])
INDEX_SQL = "path string, place bigint, name string, method string, offset bigint, packed bigint, size bigint, error string"
READ = pa.schema([("path", pa.string()), ("place", pa.int64()), ("name", pa.string()), ("content", pa.binary()), ("error", pa.string())])
READ_SQL = "path string, place bigint, name string, content binary, error string"


def _opened(path: str):
    fs, at = pafs.FileSystem.from_uri(path)
    return fs.open_input_file(at)


def _zipped(f) -> Iterator[tuple]:
    """(name, method, offset, packed, size) from the directory; the data begins after a local header whose length only it knows."""
    # the end of a small one is looked for before its beginning, which only some files bear
    with zipfile.ZipFile(f if f.size() > SMALL else io.BytesIO(f.read())) as z:
        for i in z.infolist():
            if not i.is_dir():
                f.seek(i.header_offset + 26)
                name, extra = struct.unpack("<HH", f.read(4))
                method = {zipfile.ZIP_STORED: "stored", zipfile.ZIP_DEFLATED: "deflated"}.get(i.compress_type, "other") if not i.flag_bits & 1 else "encrypted"
                yield i.filename, method, i.header_offset + 30 + name + extra, i.compress_size, i.file_size


def _tarred(f) -> Iterator[tuple]:
    with tarfile.open(fileobj=f, mode="r:") as t:
        for i in t:
            if i.isfile():
                yield i.name, "sparse" if i.issparse() else "stored", i.offset_data, i.size, i.size
            t.members = []  # else it keeps every header


def index_of(path: str) -> Iterator[tuple]:
    """Rows of INDEX for one archive; what can't be read ends them with an error."""
    place = 0
    try:
        with _opened(path) as f:
            magic = f.read(2)
            f.seek(0)
            if magic == b"\x1f\x8b":
                yield path, 0, None, "gzip", 0, f.size(), None, None
                return
            for row in _zipped(f) if magic == b"PK" else _tarred(f):
                yield path, place, *row, None
                place += 1
    except Exception as e:  # one bad archive is a row with an error, not a failed job
        yield path, place, None, None, None, None, None, f"{type(e).__name__}: {e}"[:200]


def _batches(rows: Iterator[tuple], schema: pa.Schema, content: int | None = None) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for r in rows:
        held.append(r)
        size += 100 + len(r[content] or b"") if content is not None else 100
        if size >= BATCH_BYTES:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), schema.types, strict=True)], schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), schema.types, strict=True)], schema=schema)


def _indexed(batches):
    yield from _batches((r for b in batches for path in b.column(0).to_pylist() if path is not None for r in index_of(path)), INDEX)


def _streamed(path: str) -> Iterator[tuple]:
    """Members of a gzip stream: of a tar in it, or the stream itself as the only one."""
    place = 0
    try:
        with _opened(path) as f, tarfile.open(fileobj=io.BufferedReader(f, READ_BYTES), mode="r|gz", bufsize=READ_BYTES) as t:
            for i in t:
                if i.isfile():
                    yield path, place, i.name, t.extractfile(i).read(), None
                    place += 1
                t.members = []
            return
    except tarfile.ReadError as e:
        if place:
            yield path, place, None, None, f"{type(e).__name__}: {e}"[:200]
            return
    except Exception as e:
        yield path, place, None, None, f"{type(e).__name__}: {e}"[:200]
        return
    try:
        out, unpack = [], zlib.decompressobj(31)
        with _opened(path) as f:
            while block := f.read(READ_BYTES):
                while block:
                    out.append(unpack.decompress(block))
                    block, unpack = (unpack.unused_data, zlib.decompressobj(31)) if unpack.eof else (b"", unpack)
        name = path.rsplit("/", 1)[-1].removesuffix(".gz")
        yield path, 0, name, b"".join(out), None
    except Exception as e:
        yield path, 0, None, None, f"{type(e).__name__}: {e}"[:200]


def _one(f, method: str, offset: int, packed: int, size: int) -> bytes:
    if method not in ("stored", "deflated"):
        raise ValueError(f"a member that is {method}")
    f.seek(offset)
    data = f.read(packed)
    data = zlib.decompress(data, -15) if method == "deflated" else data
    if len(data) != size:
        raise ValueError(f"{len(data)} bytes of {size}")
    return data


def _ranges(batches):
    def rows():
        path, f = None, None
        for batch in batches:
            for at, place, name, method, offset, packed, size, error in zip(*(batch.column(c).to_pylist() for c in INDEX.names), strict=True):
                if error is not None:
                    yield at, place, name, None, error
                elif method == "gzip":
                    yield from _streamed(at)
                else:
                    if at != path:
                        if f is not None:
                            f.close()
                        path, f = at, _opened(at)
                    try:
                        yield at, place, name, _one(f, method, offset, packed, size), None
                    except Exception as e:
                        yield at, place, name, None, f"{type(e).__name__}: {e}"[:200]
        if f is not None:
            f.close()
    yield from _batches(rows(), READ, 3)


def member_index(files: DataFrame) -> DataFrame:
    """files (path) to a row per member: path, place, name, method, offset, packed, size, error. A gzip stream is one row. A null path gives none, an empty archive none."""
    ship(files.sparkSession)
    return files.select(F.col("path").cast("string").alias("path")).mapInArrow(_indexed, INDEX_SQL)


def read_ranges(index: DataFrame) -> DataFrame:
    """The members of an index, or of the rows of it that are wanted: path, place, name, content, error.

    Neighbours in an archive are read by one task, up to TASK_BYTES of them, in their order; so how many members an archive has, or how large it is, makes more tasks and not larger ones.
    """
    ship(index.sparkSession)
    stretch = F.floor(F.coalesce("offset", F.lit(0)) / TASK_BYTES)
    total = index.agg(F.coalesce(F.sum("packed"), F.lit(0))).first()[0]
    tasks = max(index.sparkSession.sparkContext.defaultParallelism, -(-total // TASK_BYTES))
    return index.repartition(tasks, "path", stretch).sortWithinPartitions("path", "offset").mapInArrow(_ranges, READ_SQL)


def _packed(path: str, gz: bool):
    def run(batches):
        name, tar, out, fs, n = None, None, None, *pafs.FileSystem.from_uri(path)[:1], 0
        root = pafs.FileSystem.from_uri(path)[1]
        done = []

        def close():
            if tar is not None:
                tar.close()
                out.close()
                done.append((name, to, n))

        for batch in batches:
            for archive, member, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                if archive != name:
                    close()
                    # a task that runs again writes another file, and only those of tasks that ended well are told of
                    name, to, n = archive, f"{root}/{archive}-{uuid.uuid4().hex}.tar{'.gz' if gz else ''}", 0
                    fs.create_dir(root, recursive=True)
                    out = fs.open_output_stream(to, compression="gzip" if gz else None)
                    tar = tarfile.open(fileobj=out, mode="w|")
                data = content.as_py() or b""
                info = tarfile.TarInfo(member)
                info.size = len(data)
                tar.addfile(info, io.BytesIO(data))
                n += 1
        close()
        yield pa.RecordBatch.from_arrays([pa.array([d[i] for d in done], t) for i, t in enumerate((pa.string(), pa.string(), pa.int64()))], names=["archive", "path", "members"])
    return run


def write_archives(files: DataFrame, path: str, gz: bool = False) -> DataFrame:
    """files (archive, member, content) as one tar per archive under a shared folder: archive, path, members. Written as often as the result is read, so write that down; an archive's files pass one task one at a time."""
    ship(files.sparkSession)
    rows = files.select(F.col("archive").cast("string"), "member", F.col("content").cast("binary").alias("content"))
    return rows.repartition("archive").sortWithinPartitions("archive", "member").mapInArrow(_packed(path, gz), "archive string, path string, members bigint")
