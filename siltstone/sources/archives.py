"""Members of zip and tar archives, gzip by magic, and what a payload is by its first bytes."""

from __future__ import annotations

import gzip
import io
import tarfile
import zipfile

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..shipping import ship

MEMBERS = "path string, place int, member string, content binary, error string"


def unzipped(data: bytes | None) -> bytes | None:
    """gzip content decompressed, other content as it is."""
    return gzip.decompress(data) if data and data[:2] == b"\x1f\x8b" else data


def members(data: bytes) -> list[tuple[str, bytes]]:
    """Files of an archive by base name, in archive order; a member that can't be read ends them with an error."""
    if data[:2] == b"PK":
        with zipfile.ZipFile(io.BytesIO(data)) as z:
            return [(i.filename.rsplit("/", 1)[-1], z.read(i)) for i in z.infolist() if not i.is_dir()]
    with tarfile.open(fileobj=io.BytesIO(unzipped(data))) as t:
        return [(i.name.rsplit("/", 1)[-1], t.extractfile(i).read()) for i in t if i.isfile()]


def _opened(batches):
    for batch in batches:
        for path, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            rows, error = [], None
            try:
                rows = members(content or b"")
            except Exception as e:  # one bad file is a row with an error, not a failed job
                error = f"{type(e).__name__}: {e}"[:200]
            cells = [(path, i, n, c, None) for i, (n, c) in enumerate(rows)] or [(path, None, None, None, error)]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*cells, strict=True), (pa.string(), pa.int32(), pa.string(), pa.binary(), pa.string()), strict=True)], names=["path", "place", "member", "content", "error"])


def read_members(files: DataFrame) -> DataFrame:
    """(path, content) to one row per archive member."""
    ship(files.sparkSession)
    return files.select("path", "content").mapInArrow(_opened, MEMBERS)


def starts(column: str, magic: bytes) -> Column:
    return F.substring(F.col(column).cast("binary"), 1, len(magic)) == F.lit(magic)


def kind(column: str) -> Column:
    """pdf, zip, gzip, jpeg, png or xml by magic, else other."""
    out = F.when(starts(column, b"%PDF-"), "pdf").when(starts(column, b"PK"), "zip").when(starts(column, b"\x1f\x8b"), "gzip")
    return out.when(starts(column, b"\xff\xd8"), "jpeg").when(starts(column, b"\x89PNG"), "png").when(starts(column, b"<?xml"), "xml").otherwise("other")


def is_jats(text: str) -> Column:
    """An article root early on, and either its vocabulary's name there or front matter within the first 6,000 characters."""
    head, more = F.substring(text, 1, 2000), F.substring(text, 1, 6000)
    return F.coalesce(F.contains(head, F.lit("<article")) & (F.contains(head, F.lit("JATS")) | F.contains(head, F.lit("jats")) | F.contains(more, F.lit("<front")) | F.contains(more, F.lit("article-meta"))), F.lit(False))


def transform_for(text: str) -> Column:
    """Which transform a source needs, by its first 600 characters."""
    head = F.substring(text, 1, 600)
    return F.when(F.contains(head, F.lit("//ES//DTD")), "elsevier").when(F.contains(head, F.lit("tei-c.org/ns/1.0")), "tei").otherwise("jats")


def pick_figures(found: DataFrame) -> DataFrame:
    """Of the image members of each archive, the best format per stem; of equals the first. Logos are left out."""
    rank = F.array_position(F.array(*[F.lit(x) for x in ("png", "jpg", "pdf", "eps")]), F.replace(F.lower(F.substring_index("member", ".", -1)), F.lit("jpeg"), F.lit("jpg")))
    images = found.where(F.col("member").isNotNull()).withColumns({"rank": rank, "stem": F.regexp_replace("member", r"\.[^.]*$", "")}).where((F.col("rank") > 0) & ~F.contains(F.lower("member"), F.lit("logo")))
    return images.groupBy("path", "stem").agg(F.min_by("member", F.struct("rank", "place")).alias("member"))
