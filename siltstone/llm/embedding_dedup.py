"""Near-duplicate vectors by lattice hashing.

Unit vectors are projected at random to blocks of 8 numbers, and each block is decoded to its nearest
point of the E8 lattice; the points of a table's blocks name a cell. A vector is entered in its own
cell of each table and in the PROBES next nearest ones, where one block's point is exchanged for a
neighbour. Vectors that meet in a cell are compared by cosine in double precision.

Equal vectors form a class, which is numbered and hashed once. The number of tables is such that a pair of exactly
the threshold is missed at most once in 1/MISS by a simulation of the projection; more vectors get
more blocks, so that a cell keeps few chance members. A cell of more than BLOCK members is split, and
every two parts meet in one task. A pair that meets in several cells is counted in the one of the
smallest name; a task returns sums of links and a spanning forest of them, not pairs.

Defined cases: vectors that are null, empty, all zero, or hold a null or a value that isn't finite
link with nothing; vectors of different lengths don't link; a null id links with nothing; rows that
repeat an id are counted each, by its own vector, and link like rows of other ids; an empty table gives no rows; other columns
are not touched.
"""

from __future__ import annotations

from functools import lru_cache
from itertools import combinations, product
from math import ceil, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bytewords import mix
from .common import components, parquet, ship, written
from .minhash_dedup import forest, overlaps

SCALE, PROBES, MISS, BLOCK = 1.5, 2, 0.005, 1024
#: Chance that two unrelated unit vectors have one E8 cell at SCALE, and members a cell may have by chance.
CHANCE, CROWD = 1e-3, 100


@lru_cache(1)
def neighbours() -> np.ndarray:
    """The 240 shortest vectors of E8: two coordinates of 1 or -1, or eight halves with an even number of minus signs."""
    rows = [[s if k == i else t if k == j else 0 for k in range(8)] for i, j in combinations(range(8), 2) for s, t in product((1, -1), repeat=2)]
    rows += [[x / 2 for x in s] for s in product((1, -1), repeat=8) if sum(x < 0 for x in s) % 2 == 0]
    return np.array(rows, dtype=np.float64)


def _even(x: np.ndarray) -> np.ndarray:
    """The nearest whole vectors with an even sum: where rounding gives an odd one, the worst coordinate goes the other way."""
    r = np.rint(x)
    odd = np.flatnonzero(r.sum(axis=1) % 2)
    if len(odd):
        gap = x[odd] - r[odd]
        k = np.abs(gap).argmax(axis=1)
        r[odd, k] += np.where(gap[np.arange(len(odd)), k] >= 0, 1, -1)
    return r


def decode(x: np.ndarray) -> np.ndarray:
    """The nearest E8 points: of the even whole vectors and these shifted by a half."""
    a, b = _even(x), _even(x - 0.5) + 0.5
    nearer = ((x - a) ** 2).sum(axis=1) <= ((x - b) ** 2).sum(axis=1)
    return np.where(nearer[:, None], a, b)


def _name(points: np.ndarray, salt: int) -> np.ndarray:
    """A 64-bit name for each row of doubled points."""
    out = np.full(len(points), salt, dtype=np.uint64)
    for c in range(points.shape[1]):
        out = mix(out * np.uint64(0x9E3779B97F4A7C15) + np.rint(2 * points[:, c]).astype(np.int64).view(np.uint64))
    return out


class Lattice:
    """The cells of unit vectors of one length."""

    def __init__(self, dim: int, blocks: int, tables: int, seed: int = 8):
        rng = np.random.default_rng([seed, dim])
        self.dim, self.blocks, self.tables = dim, blocks, tables
        self.plan = [(rng.normal(size=(dim, 8 * blocks)) / SCALE, rng.random(8 * blocks)) for _ in range(tables)]

    def cells(self, rows: np.ndarray) -> np.ndarray:
        """(vector, table * (1 + PROBES)): own cell, then those of the nearest neighbours."""
        out = []
        for t, (matrix, shift) in enumerate(self.plan):
            x = rows @ matrix + shift
            points = np.hstack([decode(x[:, 8 * b : 8 * b + 8]) for b in range(self.blocks)])
            out.append(_name(points, t * 1009 + self.dim))
            near = np.hstack([(x - points)[:, 8 * b : 8 * b + 8] @ neighbours().T for b in range(self.blocks)])
            for _ in range(PROBES):
                best = near.argmax(axis=1)
                near[np.arange(len(near)), best] = -np.inf
                other = points.copy().reshape(len(points), self.blocks, 8)
                other[np.arange(len(points)), best // 240] += neighbours()[best % 240]
                out.append(_name(other.reshape(len(points), -1), t * 1009 + self.dim))
        return np.array(out).T.reshape(len(rows), -1)


def plan(n: int, cosine: float) -> tuple[int, int]:
    """(blocks, tables) for n vectors."""
    blocks = 1 + max(0, ceil(log(max(1.0, n * CHANCE / CROWD)) / log(1 / CHANCE)))
    rng = np.random.default_rng(1)
    a = rng.normal(size=(4000, 64))
    a /= np.linalg.norm(a, axis=1)[:, None]
    e = rng.normal(size=(4000, 64))
    e -= (e * a).sum(axis=1)[:, None] * a
    b = cosine * a + (1 - cosine**2) ** 0.5 * e / np.linalg.norm(e, axis=1)[:, None]
    one = Lattice(64, blocks, 1, seed=9)
    ca, cb = one.cells(a), one.cells(b)
    p = (ca[:, :, None] == cb[:, None, :]).any(axis=(1, 2)).mean()
    return blocks, max(1, ceil(log(MISS) / log(1 - min(0.999, max(p, 1e-3)))))


def unit(x: np.ndarray) -> np.ndarray:
    """Rows as unit vectors in double precision; scaled first, so that no square over- or underflows."""
    x = x.astype(np.float64)
    x /= np.abs(x).max(axis=1)[:, None]
    return x / np.linalg.norm(x, axis=1)[:, None]


def _hashed(blocks: int, tables: int, kind: str):
    """kind: the numpy type of the components, in which vectors are sent as they are."""
    def run(batches):
        by_dim: dict[int, Lattice] = {}
        for batch in batches:
            ids, sizes, vectors, names = [], [], [], []
            cells = [np.array(v, dtype=kind) for v in batch.column(2).to_pylist()]
            for dim in sorted({len(v) for v in cells}):
                at = [i for i, v in enumerate(cells) if len(v) == dim]
                by_dim.setdefault(dim, Lattice(dim, blocks, tables))
                found = by_dim[dim].cells(unit(np.array([cells[i] for i in at])))
                for k, i in enumerate(at):
                    ids.append(batch.column(0)[i].as_py())
                    sizes.append(batch.column(1)[i].as_py())
                    vectors.append(cells[i].tobytes())
                    names.append(np.unique(found[k]).view(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()), pa.array(vectors, pa.binary()), pa.array(names, pa.list_(pa.int64()))], names=["id", "size", "vector", "cells"])
    return run


def _compared(cosine: float, kind: str):
    def met(key, part, ids, sizes, vectors, cells):
        """Sums of links and a forest of them, for pairs whose smallest common cell is this one."""
        cell, i, j = key
        x, w, side = unit(np.array([np.frombuffer(v, dtype=kind) for v in vectors])), np.array(sizes, dtype=np.int64), np.array(part)
        linked = x @ x.T >= cosine
        np.fill_diagonal(linked, False)
        if i != j:
            linked &= side[:, None] != side[None, :]
        if linked.any():
            some = np.flatnonzero(linked.any(axis=1))
            before = overlaps([np.array([c for c in cells[k] if c < cell], dtype=np.int64) for k in some]) > 0
            linked[np.ix_(some, some)] &= ~before
        total, own = linked @ w, np.array(ids)
        out = [(int(own[k]), None, int(total[k])) for k in np.flatnonzero(total)]
        return out + [(a, b, 0) for a, b in forest(own, linked)]

    def batch_of(rows):
        a, b, n = zip(*rows, strict=True) if rows else ((), (), ())
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(n, pa.int64())], names=["a", "b", "n"])

    def run(batches):
        key, held, out = None, [], []
        for batch in batches:
            for cell, i, j, *row in zip(*(batch.column(c).to_pylist() for c in range(8)), strict=True):
                if (cell, i, j) != key:
                    if len(held) > 1:
                        out += met(key, *zip(*held, strict=True))
                    key, held = (cell, i, j), []
                    if len(out) > 5000:
                        yield batch_of(out)
                        out = []
                held.append(row)
        if len(held) > 1:
            out += met(key, *zip(*held, strict=True))
        yield batch_of(out)
    return run


def near_vectors(vectors: DataFrame, cosine: float = 0.9, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """One row per input row: id, n_links, component_id, kept."""
    ship(vectors.sparkSession)
    v = F.col("v")
    sound = v.isNotNull() & (F.size(v) > 0) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))) & F.exists(v, lambda x: x != 0) & F.col("id").isNotNull()
    rows = written(vectors.select(F.col(id_col).cast("bigint").alias("id"), F.col(vector_col).alias("v")).select(
        "id", "v", F.coalesce(sound, F.lit(False)).alias("sound"), F.xxhash64("v").alias("h1"), F.xxhash64(F.lit(1), "v").alias("h2"), F.hash("v").alias("h3")))
    same = ["h1", "h2", "h3"]
    classes = written(rows.where("sound").groupBy(*same).agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("size")).withColumn("class", F.monotonically_increasing_id()))
    held = rows.where("sound").join(classes, [*(rows[c] == classes[c] for c in same), rows["id"] == classes["rep"]]).select(F.col("class").alias("id"), "size", "v").dropDuplicates(["id"])
    blocks, tables = plan(classes.count(), cosine)
    kind = "<f4" if rows.schema["v"].dataType.simpleString() == "array<float>" else "<f8"
    hashed = written(held.mapInArrow(_hashed(blocks, tables, kind), "id bigint, size bigint, vector binary, cells array<bigint>"))
    entries = hashed.select("id", F.explode("cells").alias("cell"))
    shared = entries.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("cell", F.ceil(F.col("n") / BLOCK).alias("parts"))
    part = F.pmod(F.xxhash64("id"), F.col("parts"))
    spread = entries.join(shared, "cell").withColumn("part", part).select(
        "cell", "id", "part", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1)).alias("j")).select(
        "cell", F.least("part", "j").alias("i"), F.greatest("part", "j").alias("j"), "part", "id")
    sent = spread.join(hashed, "id").select("cell", "i", "j", "part", "id", "size", "vector", "cells")
    sent = sent.repartition("cell", "i", "j").sortWithinPartitions("cell", "i", "j", "id")
    found = written(sent.mapInArrow(_compared(cosine, kind), "a bigint, b bigint, n bigint"))
    sums = found.where("b is null").groupBy(F.col("a").alias("class")).agg(F.sum("n").alias("others"))
    joined = classes.join(components(found.where("b is not null")), F.col("class") == F.col("node"), "left").withColumn("of", F.coalesce("component", "class")).drop("node", "component")
    smallest = joined.groupBy("of").agg(F.min("rep").alias("least"))
    of_class = joined.join(sums, "class", "left").join(smallest, "of").select(*same, F.lit(True).alias("sound"), (F.col("size") - 1 + F.coalesce("others", F.lit(0))).alias("links"), "least")
    got = rows.drop("v").join(of_class, [*same, "sound"], "left")
    least = F.coalesce("least", "id")
    return got.select(F.col("id").alias(id_col), F.coalesce("links", F.lit(0).cast("bigint")).alias("n_links"), least.alias("component_id"), F.col("id").eqNullSafe(least).alias("kept"))


def op10_lattice_embeddings(spark, sf_dir: str) -> DataFrame:
    return near_vectors(parquet(spark, sf_dir, "embeddings"))


#: All pairs, exactly: the query's links are among these, and its recall is measured against them.
OP10_SQL = """
with recursive v as (
  select vec_id, cast(embedding as double[]) as x from embeddings
), g as (
  select vec_id, x from v where vec_id is not null and len(x) > 0 and len(list_filter(x, lambda c: c is null or isnan(c) or isinf(c))) = 0 and len(list_filter(x, lambda c: c <> 0)) > 0
), e as (
  select a.vec_id as a, b.vec_id as b from g a join g b on a.vec_id <> b.vec_id and len(a.x) = len(b.x) where list_cosine_similarity(a.x, b.x) >= 0.9
), r as (select a as vec_id, a as reached from e union select r.vec_id, e.b from r join e on e.a = r.reached),
c as (select vec_id, min(reached) as component_id from r group by vec_id), k as (select a as vec_id, count(*) as n from e group by a)
select vec_id, coalesce(n, 0) as n_links, coalesce(component_id, vec_id) as component_id, vec_id = coalesce(component_id, vec_id) as kept from v left join k using (vec_id) left join c using (vec_id)
"""
