"""Repeated byte strings by bucket-pointer refinement over sampled positions.

A string of LENGTH bytes repeats if it starts at another place too, in whichever text. Every such string holds one *anchor*: the place of its
least q-gram (q is half the LENGTH and one), by a hash, the leftmost of equals. The anchor follows from the string's bytes alone, so equal strings
have it at the same distance d, and some 20 of 1000 places are anchors.

1. Initial buckets: anchors are put in buckets by the identifier of their q-gram. A bucket of one is done: no string with that anchor repeats.
2. Refinement: the strings of an anchor with distances from d1 to d2 have a union, from p-d2 to p-d1+LENGTH, and a core that all of them
   hold. A union is named by the bucket identifiers at its start, at a later offset of q - 1 and at its last q-gram; a core by those at its two ends.
   Where a union is in its bucket twice, all its strings repeat. Where a core is alone in its bucket, none does. What is neither is split into FAN
   ranges of distances, whose buckets are refined by identifiers of offsets nearer to each other, and so on to single distances,
   where union and core are one string. Each round takes up what the one before left, one anchor for each bucket of equal unions.
3. Strings found are merged to runs of each text, and only texts that have some are moved to be cut.

Buckets are counted by map-side aggregates, and rows join their counts, so a bucket that holds a third of all rows is a skewed join key
and never one task's state; no pairs are made. Identifiers are 64-bit hashes of q-grams; a union is counted by a hash of its identifiers and
a second hash of its bytes, 128 bits.

Defined cases: a null text is empty; a text shorter than LENGTH keeps all; a text is named by its id and a hash, so rows that repeat an id are judged
each by its own text, and a repeated row is a repetition of its text; a null id is a name like any other; an empty table gives no rows; long
texts are whole, in pieces of PIECE places that overlap; what is kept of a text is bytes, as a cut may go through a character; other columns are not touched.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bytewords import P, chunks, mix, powers
from .common import far, forgotten, near, parquet, ship, swept, written

LENGTH, FAN, PIECE = 200, 5, 1 << 20
#: Bits of a packed value that hold a place within a piece; the others are those of the q-gram's hash.
PLACE = 22
NAME = ["id", "mark"]
P2 = 0xC2B2AE3D27D4EB4F


def _u(x: int) -> np.uint64:
    return np.uint64(x & 0xFFFFFFFFFFFFFFFF)


class Grams:
    """Identifiers of the q-grams of some bytes, and a second hash of any span."""

    def __init__(self, data: np.ndarray, q: int):
        self.q, self.n = q, len(data)
        up, down = powers(self.n)
        total = np.zeros(self.n + 1, dtype=np.uint64)
        np.cumsum((data.astype(np.uint64) + _u(1)) * up[: self.n], out=total[1:])
        size = max(0, self.n - q + 1)
        self.all = mix((total[q : q + size] - total[:size]) * down[:size])
        self.other, self.down = np.zeros(self.n + 1, dtype=np.uint64), down
        # another value for each byte, and so another sum
        np.cumsum(mix(np.arange(256, dtype=np.uint64) + _u(P2))[data] * up[: self.n], out=self.other[1:])

    def span(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.other[end] - self.other[start]) * self.down[start] + (end - start).astype(np.uint64) * _u(P2))

    def named(self, *places: np.ndarray, salt=0) -> np.ndarray:
        """One name from the identifiers at some places."""
        out = np.full(len(places[0]), _u(salt), dtype=np.uint64)
        for x in places:
            out = mix(out * _u(P) + self.all[x])
        return out


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """Minima of ``width`` values from each place on."""
    have, out = 1, values
    while 2 * have <= width:
        out = np.minimum(out[:-have], out[have:])
        have *= 2
    return np.minimum(out[: len(values) - width + 1], out[width - have :])


def anchored(grams: Grams, offsets: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place, low, high): anchors, and the least and greatest distance of a string of which each is the anchor."""
    width, found = length - grams.q + 1, []
    for a in range(0, grams.n - length + 1, PIECE):
        b = min(a + PIECE, grams.n - length + 1)  # strings that start from a to b
        packed = (grams.all[a : b + width - 1] >> _u(PLACE) << _u(PLACE)) | np.arange(b - a + width - 1, dtype=np.uint64)
        at = (_least(packed, width) & _u((1 << PLACE) - 1)).astype(np.int64) + a
        start, ends = np.arange(a, b), offsets[1:]
        over = np.zeros(b - a + 1, dtype=np.int64)  # strings that would go over the end of their text
        np.add.at(over, np.clip(ends - length + 1, a, b) - a, 1)
        np.add.at(over, np.clip(ends, a, b) - a, -1)
        inside = np.cumsum(over[:-1]) == 0
        at, start = at[inside], start[inside]
        edge = np.ones(len(at) + 1, dtype=bool)
        edge[1:-1] = at[1:] != at[:-1]
        first, last = np.flatnonzero(edge[:-1]), np.flatnonzero(edge[1:])
        found.append(np.stack([at[first], at[first] - start[last], at[first] - start[first]]))
    at, low, high = np.concatenate(found, axis=1) if found else np.zeros((3, 0), dtype=np.int64)
    if len(found) > 1:  # an anchor may go on in the next piece
        at, of = np.unique(at, return_inverse=True)
        lows, highs = np.full(len(at), length), np.zeros(len(at), dtype=np.int64)
        np.minimum.at(lows, of, low)
        np.maximum.at(highs, of, high)
        low, high = lows, highs
    return at, low, high


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def _bounds(at: np.ndarray, begin: np.ndarray, end: np.ndarray, low: np.ndarray, high: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest distance whose string is inside of its text."""
    return np.maximum(low, at + length - end), np.minimum(high, at - begin)


def _unions(grams: Grams, at: np.ndarray, low: np.ndarray, high: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Two names for the union of the strings with these distances."""
    start, end = at - high, at - low + length
    step = length - grams.q
    bounds = low.astype(np.uint64) * _u(length + 1) + high.astype(np.uint64)
    return mix(grams.named(start, start + step, end - grams.q) + bounds), mix(grams.span(start, end) + bounds)


def _anchors(length: int):
    q = length // 2 + 1

    def run(batches):
        for batch in batches:
            for first, data, offsets in chunks(batch.column(2)):
                grams = Grams(data, q)
                at, near_by, away = anchored(grams, offsets, length)
                own = np.searchsorted(offsets, at, side="right") - 1
                begin = offsets[own]
                low, high = _bounds(at, begin, offsets[own + 1], np.zeros(len(at), np.int64), np.full(len(at), length - q), length)
                u1, u2 = _unions(grams, at, low, high, length)
                row = pa.array(own + first)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(row), batch.column(1).take(row), pa.array(at - begin), pa.array(near_by.astype(np.int16)), pa.array(away.astype(np.int16)),
                     pa.array(low.astype(np.int16)), pa.array(high.astype(np.int16)), _signed(grams.all[at]), _signed(u1), _signed(u2)], names=ANCHOR)
    return run


ANCHOR = ["id", "mark", "at", "wants", "upto", "low", "high", "bucket", "u1", "u2"]
ANCHOR_TYPES = "id bigint, mark bigint, at bigint, wants smallint, upto smallint, low smallint, high smallint, bucket bigint, u1 bigint, u2 bigint"
#: Context: the bytes around an anchor that its strings reach.
CONTEXT_TYPES = "id bigint, mark bigint, at bigint, wants smallint, upto smallint, twice boolean, context binary"
FLUSH = 1 << 24


def _contexts(length: int):
    """The bytes around the anchors of each text."""
    reach, names = length - length // 2 - 1, [x.split()[0] for x in CONTEXT_TYPES.split(", ")]

    def run(batches):
        held, size = [], 0
        for batch in batches:
            for i in range(batch.num_rows):
                text, anchors = memoryview(batch.column(2)[i].as_py()), batch.column(3)[i].values
                at = anchors.field("at").to_numpy()
                made = pa.array([text[a:b] for a, b in zip(np.maximum(at - reach, 0).tolist(), (at + length).tolist(), strict=True)], pa.binary())
                same = pa.array(np.zeros(len(at), dtype=np.int64))
                held.append(pa.RecordBatch.from_arrays([batch.column(0).slice(i, 1).take(same), batch.column(1).slice(i, 1).take(same), *(anchors.field(c) for c in names[2:6]), made], names=names))
                size += made.nbytes
                if size > FLUSH:
                    yield from pa.Table.from_batches(held).combine_chunks().to_batches()
                    held, size = [], 0
        if held:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
    return run


NODE_TYPES = "id bigint, mark bigint, at bigint, wants smallint, upto smallint, twice boolean, d1 smallint, low smallint, high smallint, core bigint, u1 bigint, u2 bigint"
RANGES = "array<struct<d1: smallint, wants: smallint, upto: smallint, twice: boolean>>"


def _nodes(length: int, width: int, down_to: int):
    """An anchor's ranges of ``width`` distances, each split into ranges of ``down_to``: their bounds and names."""
    q = length // 2 + 1
    names = [x.split()[0] for x in NODE_TYPES.split(", ")]

    def run(batches):
        for batch in batches:
            for x in range(0, batch.num_rows, 4096):
                part = batch.slice(x, 4096)
                texts, ranges = part.column(3).to_pylist(), part.column(4)
                offsets = np.concatenate([[0], np.cumsum([len(v) for v in texts])]).astype(np.int64)
                grams = Grams(np.frombuffer(b"".join(texts), dtype=np.uint8), q)
                anchor = np.repeat(np.arange(part.num_rows), np.diff(np.asarray(ranges.offsets)))
                each = ranges.flatten()
                first, wants, upto = (each.field(c).to_numpy().astype(np.int64) for c in ("d1", "wants", "upto"))
                steps = -(-width // down_to)
                of = np.repeat(np.arange(len(anchor)), steps)
                d1 = first[of] + np.tile(np.arange(steps) * down_to, len(anchor))
                d2 = np.minimum(np.minimum(d1 + down_to, first[of] + width), length - q + 1) - 1
                row = anchor[of]
                at = offsets[row] + np.minimum(part.column(2).to_numpy()[row], length - q)
                low, high = _bounds(at, offsets[row], offsets[row + 1], d1, d2, length)
                on = (d1 <= d2) & (low <= high) & (d1 <= upto[of]) & (d2 >= wants[of])
                of, row, d1, d2, at, low, high = (v[on] for v in (of, row, d1, d2, at, low, high))
                u1, u2 = _unions(grams, at, low, high, length)
                core = mix(grams.named(at - d1, at - d2 + length - q) + d1.astype(np.uint64))
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c).take(pa.array(row)) for c in range(3)), *(each.field(c).take(pa.array(of)) for c in ("wants", "upto", "twice")),
                     *(pa.array(v.astype(np.int16)) for v in (d1, low, high)), _signed(core), _signed(u1), _signed(u2)], names=names)
    return run


def _reached(rows: DataFrame, length: int) -> DataFrame:
    """The strings of the distances from low to high, as one run."""
    return rows.select(*NAME, (F.col("at") - F.col("high")).alias("start"), (F.col("at") - F.col("low") + length).alias("end"))


def _open(classes: DataFrame, key: str) -> DataFrame:
    """Buckets that hold several unions, of which one at least is there once: those that have to be refined."""
    return classes.groupBy(key).agg(F.count(F.lit(1)).alias("classes"), F.min("n").alias("least")).where("classes > 1 and least = 1").select(key).hint("merge")


def repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """(id, mark, start, end): runs of bytes of repeating strings; they may overlap or be given twice, and are all of them. docs: id, mark, text."""
    anchors = written(docs.mapInArrow(_anchors(length), ANCHOR_TYPES))
    shared = written(anchors.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("bucket"))
    met = written(near(anchors, [F.col("bucket")], shared, ["bucket"]).join(shared.hint("merge"), "bucket"))
    forgotten(anchors)
    # classes: anchors of equal unions, of which one stands for all
    same, one = ["bucket", "u1", "u2"], F.min(F.struct(*NAME, "at")).alias("one")
    classes = written(met.groupBy(*same).agg(F.count(F.lit(1)).alias("n"), one, F.min("wants").alias("wants"), F.max("upto").alias("upto")))
    found = [written(_reached(met.join(classes.where("n > 1").select(*same).hint("merge"), same), length).distinct())]
    active = classes.join(_open(classes, "bucket"), "bucket").select("one.*", "wants", "upto", (F.col("n") > 1).alias("twice"))
    lists = written(active.groupBy(*NAME).agg(F.collect_list(F.struct("at", "wants", "upto", "twice")).alias("anchors")))
    forgotten(met)
    texts = near(docs, [F.col(c) for c in NAME], lists, NAME).alias("t").join(lists.alias("a").hint("merge"), [F.col(f"t.{c}").eqNullSafe(F.col(f"a.{c}")) for c in NAME])
    contexts = written(texts.select("t.id", "t.mark", F.encode("text", "UTF-8").alias("text"), "anchors").mapInArrow(_contexts(length), CONTEXT_TYPES))
    swept(docs)
    width = length - length // 2
    asked = contexts.select(*NAME, "at", "context", F.array(F.struct(F.lit(0).cast("smallint").alias("d1"), "wants", "upto", "twice")).cast(RANGES).alias("ranges"))
    while True:
        down_to = -(-width // FAN)
        nodes = written(asked.mapInArrow(_nodes(length, width, down_to), NODE_TYPES))
        pick = F.xxhash64(*NAME, "at", "d1")
        unions = written(nodes.groupBy("u1", "u2").agg(
            F.sum(F.when(F.col("twice"), 2).otherwise(1)).alias("n"), F.min(pick).alias("pick"), F.min("core").alias("core"), F.min("wants").alias("wants"), F.max("upto").alias("upto")))
        found.append(written(_reached(nodes.where("not twice").join(unions.where("n > 1").select("u1", "u2").hint("merge"), ["u1", "u2"]), length)))
        if down_to == 1:
            break
        open_ = unions.join(_open(unions, "core"), "core").select("u1", "u2", "pick", F.struct("wants", "upto", (F.col("n") > 1).alias("twice")).alias("now"))
        left = nodes.withColumn("pick", pick).select(*NAME, "at", "d1", "u1", "u2", "pick").join(open_.hint("merge"), ["u1", "u2", "pick"])
        ranges = left.groupBy(*NAME, "at").agg(F.collect_list(F.struct("d1", "now.*")).cast(RANGES).alias("ranges"))
        on = [F.col(f"c.{x}").eqNullSafe(F.col(f"r.{x}")) for x in (*NAME, "at")]
        asked = contexts.alias("c").join(ranges.alias("r").hint("merge"), on).select("c.id", "c.mark", "c.at", "c.context", "r.ranges")
        width = down_to
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def _merged(batches):
    """Runs of each text of a sorted stream that overlap or touch, as one, listed by text."""
    name, starts, ends, out = None, [], [], []

    def batch_of():
        ids, marks, a, b = zip(*out, strict=True) if out else ((), (), (), ())
        return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(marks, pa.int64()), pa.array(a, pa.list_(pa.int64())), pa.array(b, pa.list_(pa.int64()))], names=["id", "mark", "starts", "ends"])

    for batch in batches:
        for i, mark, s, e in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
            if name != (i, mark):
                if starts:
                    out.append((*name, starts, ends))
                    if len(out) >= 2000:
                        yield batch_of()
                        out = []
                name, starts, ends = (i, mark), [], []
            if starts and s <= ends[-1]:
                ends[-1] = max(ends[-1], e)
            else:
                starts.append(s)
                ends.append(e)
    if starts:
        out.append((*name, starts, ends))
    yield batch_of()


def _cut(batches):
    for batch in batches:
        kept, digests, sizes = [], [], []
        for text, starts, ends in zip(batch.column(2), batch.column(3).to_pylist(), batch.column(4).to_pylist(), strict=True):
            text, at, parts = memoryview(text.as_py()), 0, []
            for s, e in zip(starts, ends, strict=True):
                parts.append(text[at:s])
                at = e
            kept.append(b"".join([*parts, text[at:]]))
            digests.append(hashlib.sha256(kept[-1]).hexdigest())
            sizes.append(len(text))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), batch.column(3), batch.column(4), pa.array(kept, pa.binary()), pa.array(digests, pa.string())], names=["id", "mark", "n_bytes", "starts", "ends", "kept", "kept_sha256"])


def without_repeats(docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, n_bytes, spans (the maximal runs of bytes removed: start, end), kept (bytes) and kept_sha256."""
    if length < 4:
        raise ValueError("strings of 4 bytes at least")
    ship(docs.sparkSession)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.xxhash64(text).alias("mark"), text.alias("text"))
    spans = repeats(rows, length).repartition(*NAME).sortWithinPartitions(*NAME, "start")
    runs = written(spans.mapInArrow(_merged, "id bigint, mark bigint, starts array<bigint>, ends array<bigint>"))
    of = [F.col(c) for c in NAME]
    same = [F.col(f"t.{c}").eqNullSafe(F.col(f"r.{c}")) for c in NAME]
    maybe = near(rows, of, runs, NAME).alias("t").join(runs.alias("r").hint("merge"), same, "left")
    none = F.array().cast("array<bigint>")
    cut = maybe.select("t.id", "t.mark", F.encode("text", "UTF-8").alias("text"), F.coalesce("starts", none).alias("starts"), F.coalesce("ends", none).alias("ends")).mapInArrow(
        _cut, "id bigint, mark bigint, n_bytes bigint, starts array<bigint>, ends array<bigint>, kept binary, kept_sha256 string")
    cut = cut.select("id", "n_bytes", F.arrays_zip(F.col("starts").alias("start"), F.col("ends").alias("end")).alias("spans"), "kept", "kept_sha256")
    whole = far(rows, of, runs, NAME).select(
        "id", F.octet_length("text").cast("bigint").alias("n_bytes"), F.array().cast("array<struct<start: bigint, end: bigint>>").alias("spans"), F.encode("text", "UTF-8").alias("kept"), F.sha2("text", 256).alias("kept_sha256"))
    return cut.unionByName(whole).withColumnRenamed("id", id_col)


def op11_bucket_refinement(spark, sf_dir: str) -> DataFrame:
    cut = without_repeats(parquet(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, x: n + x["end"] - x["start"])
    return cut.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("bigint").alias("n_spans"), "kept_sha256")
