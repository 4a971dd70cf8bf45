"""Hard negatives by bit-sliced integer products.

Vectors become whole numbers. An anchor's score with a row is their inner product, made from one bit plane of the row's
components after another, the most significant first. After each plane the planes that are left can add no more
than their largest value times the anchor's positive components, and take off no more than that times the negative ones. So each
score lies in an interval that halves with each plane, and a pair is dropped as soon as its interval can't qualify:

1. positives: below the worst of the best scores with rows of the anchor's label so far;
2. negatives: outside of every window of the anchor's positives, or below the worst of the best in those it touches.

A plane is a matrix product while many pairs are left; when few are, their rows are gathered. The first planes, which decide nothing alone, are one product. What is left after the last plane has its exact score.

Anchors, in groups of GROUP, meet rows, in slots of some SLOT. A task holds one group's anchors with their best rows so far and streams the rows
of a slot past them, so its memory doesn't grow with the table, whatever label or vector a third of all rows have. An anchor goes to each
slot and a row to each group: that many rows are moved. The best of each slot are ranked by windows over an anchor, of a few rows for each slot.

Defined cases: rows with a null id or label, a null vector, or a null or non-finite component take no part; rows that repeat an
id, a label and a vector are one; of those that repeat an id with another label or vector each is a row of its own, and after equal
scores and ids the order is by label and a hash of the vector; vectors of different lengths have no score with each other, and empty ones the score 0; an anchor
without positives or without negatives gives no rows; an empty table gives no rows; other columns are not touched. Scores
are exact; where a score might not fit 62 bits the operator raises an error rather than give a wrong one.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import parquet, ship, written

#: Anchors of a group, rows of a slot, rows that are compared at once, and anchors that are compared at once.
GROUP, SLOT, ROWS, ANCHORS = 4096, 1 << 16, 4096, 256
#: Slots per core, so that all cores work and end at about the same time, as long as each has LEAST rows.
SHARES, LEAST = 4, 4096
#: The plane after which pairs are first tested.
FIRST = 4
#: Scores and bounds are nearer to 0.
FAR = 1 << 61
#: Pairs are gathered when fewer than one in SPARSE are left.
SPARSE = 6


class Planes:
    """Bit planes of whole-number rows: the top one weighs -2**top, the others 2**k."""

    def __init__(self, rows: np.ndarray):
        low, high = (int(rows.min()), int(rows.max())) if rows.size else (0, 0)
        self.rows, self.top = rows, max(high, -low - 1).bit_length()

    def weight(self, k: int) -> int:
        return -(1 << k) if k == self.top else 1 << k

    def bits(self, k: int, at=slice(None)) -> np.ndarray:
        return (self.rows[at] >> k) & 1

    def rest(self, k: int) -> int:
        """The most that the planes below k come to."""
        return (1 << k) - 1


def sliced(anchors: np.ndarray, planes: Planes, alive: np.ndarray, lower: np.ndarray, upper: np.ndarray, qualify) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, row, score) of the pairs of ``alive`` whose score is from its anchor's ``lower`` to its ``upper``, and that qualify(anchor, low, high) keeps, low to high being what their score may be."""
    up, down = np.where(anchors > 0, anchors, 0).sum(axis=1), np.where(anchors < 0, anchors, 0).sum(axis=1)
    most = int(np.abs(anchors).sum(axis=1).max(initial=0)) << planes.top + 1
    exact = np.float32 if most < 1 << 24 else np.float64 if most < 1 << 52 else np.int64  # whole numbers are exact in all three
    whole, k = anchors.astype(exact), min(planes.top, FIRST)
    # planes above k can't decide anything yet, and are taken in one product
    total = whole @ (planes.rows >> k << k).astype(exact).T
    while True:
        rest = planes.rest(k)
        alive &= (total >= (lower - rest * up)[:, None]) & (total <= (upper - rest * down)[:, None])
        if not k or np.count_nonzero(alive) * SPARSE < alive.size:
            break
        k -= 1
        total += planes.weight(k) * (whole @ planes.bits(k).astype(exact).T)
    a, r = np.nonzero(alive)
    part = total[a, r].astype(np.int64)
    while len(a):
        rest = planes.rest(k)
        keep = qualify(a, part + rest * down[a], part + rest * up[a])
        a, r, part = a[keep], r[keep], part[keep]
        if not k:
            break
        k -= 1
        part = part + planes.weight(k) * np.einsum("ij,ij->i", anchors[a], planes.bits(k, r))
    return a, r, part


class Best:
    """The best ``most`` rows of each of n lists so far: by score, then id, then the row's hash."""

    def __init__(self, n: int, most: int):
        self.n, self.most = n, most
        self.list, self.score, self.id, self.label, self.mark = (np.zeros(0, dtype=np.int64) for _ in range(5))
        self.worst = np.full(n, -FAR, dtype=np.int64)

    def add(self, where: np.ndarray, score: np.ndarray, ids: np.ndarray, label: np.ndarray, mark: np.ndarray) -> None:
        if not len(where):
            return
        of, score, ids, label, mark = (np.concatenate(x) for x in ((self.list, where), (self.score, score), (self.id, ids), (self.label, label), (self.mark, mark)))
        order = np.lexsort((mark, label, ids, -score, of))
        of = of[order]
        place = np.arange(len(of)) - np.searchsorted(of, of)
        order = order[place < self.most]
        self.list, self.score, self.id, self.label, self.mark = of[place < self.most], score[order], ids[order], label[order], mark[order]
        full = place[place < self.most] == self.most - 1
        self.worst[self.list[full]] = self.score[full]


class Anchors:
    """Anchors of a group, by label, with the windows their rows have to be in, and the best so far."""

    def __init__(self, rows: pa.Table, dim: int, most: int, windows: bool):
        rows = rows.sort_by([("label", "ascending")])
        self.ids, self.label, self.mark = (rows[c].to_numpy().astype(np.int64) for c in ("id", "label", "mark"))
        self.values, self.windows = _matrix(rows["v"].combine_chunks(), dim), windows
        self.low, self.high = np.full((len(self.ids), 1), -FAR, dtype=np.int64), np.full((len(self.ids), 1), FAR, dtype=np.int64)
        if windows:
            lows, highs = rows["lows"].to_pylist(), rows["highs"].to_pylist()
            width = max(map(len, lows))
            # none is from FAR on
            self.low, self.high = (np.array([x + [fill] * (width - len(x)) for x in each], dtype=np.int64) for each, fill in ((lows, FAR), (highs, -FAR)))
        self.best = Best(self.low.size, most)

    def meet(self, ids: np.ndarray, label: np.ndarray, mark: np.ndarray, values: np.ndarray) -> None:
        """Brings some rows past the anchors: rows of each label past the anchors of the same, or of the others."""
        if self.windows:
            for first in range(0, len(self.ids), ANCHORS):
                some = slice(first, first + ANCHORS)
                self._compare(some, self.label[some, None] != label[None, :], ids, label, mark, Planes(values))
            return
        order = np.argsort(label, kind="stable")
        ids, label, mark, values = ids[order], label[order], mark[order], values[order]
        for one in np.unique(label).tolist():
            (a, b), of = np.searchsorted(self.label, [one, one + 1]), slice(*np.searchsorted(label, [one, one + 1]))
            for first in range(a, b, ANCHORS):
                some = slice(first, min(b, first + ANCHORS))
                # a row is no partner of itself
                others = (self.ids[some, None] != ids[None, of]) | (self.mark[some, None] != mark[None, of])
                self._compare(some, others, ids[of], label[of], mark[of], Planes(values[of]))

    def _compare(self, some: slice, alive: np.ndarray, ids: np.ndarray, label: np.ndarray, mark: np.ndarray, planes: Planes) -> None:
        width = self.low.shape[1]
        high = self.high[some]
        low = np.maximum(self.low[some], self.best.worst.reshape(-1, width)[some])

        def qualify(a, least, most):
            return (np.minimum(most[:, None], high[a]) >= np.maximum(least[:, None], low[a])).any(axis=1)

        a, r, score = sliced(self.values[some], planes, alive, low.min(axis=1), high.max(axis=1), qualify)
        at, w = np.nonzero((score[:, None] >= low[a]) & (score[:, None] <= high[a]))
        self.best.add((some.start + a[at]) * width + w, score[at], ids[r[at]], label[r[at]], mark[r[at]])

    def rows(self) -> pa.RecordBatch:
        of, width = self.best.list // self.low.shape[1], self.low.shape[1]
        return pa.RecordBatch.from_arrays([pa.array(x) for x in (self.ids[of], self.label[of], self.mark[of], self.best.list % width, self.best.id, self.best.label, self.best.mark, self.best.score)], names=MET)


def _matrix(rows: pa.Array, dim: int) -> np.ndarray:
    return rows.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(rows), dim)


MET = ["anchor", "anchor_label", "anchor_mark", "place", "id", "label", "mark", "score"]


def _met(most: int, windows: bool):
    """Streams sorted units: anchors first (kind 0), then the rows they meet."""
    def run(batches):
        key, waiting, anchors = None, [], None
        for batch in batches:
            kinds = np.stack([batch.column(c).to_numpy() for c in range(4)])
            edges = [0, *(np.flatnonzero((kinds[:, 1:] != kinds[:, :-1]).any(axis=0)) + 1).tolist(), batch.num_rows]
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                dim, group, slot, kind = kinds[:, a].tolist() if b > a else (0, 0, 0, 1)
                if b > a and (dim, group, slot) != key:
                    if anchors:
                        yield anchors.rows()
                    key, waiting, anchors = (dim, group, slot), [], None
                if kind == 0:
                    waiting.append(batch.slice(a, b - a))
                    continue
                if waiting:
                    anchors, waiting = Anchors(pa.Table.from_batches(waiting), dim, most, windows), []
                for x in range(a, b if anchors else a, ROWS):
                    part = batch.slice(x, min(ROWS, b - x))
                    anchors.meet(*(part.column(c).to_numpy().astype(np.int64) for c in ("id", "label", "mark")), _matrix(part.column("v"), dim))
        if anchors:
            yield anchors.rows()
    return run


def _units(anchors: DataFrame, rows: DataFrame, groups: int, slots: int) -> DataFrame:
    """Anchors and rows by the units they meet in, sorted: each anchor in every slot, each row in every group."""
    none = F.lit(None).cast("array<bigint>")
    lows, highs = (F.col(c) if c in anchors.columns else none for c in ("lows", "highs"))
    dealt = F.pmod(F.xxhash64("id", "mark", "label"), F.lit(groups)).cast("int")
    a = anchors.select(F.size("v").alias("dim"), dealt.alias("group"), F.explode(F.sequence(F.lit(0), F.lit(slots - 1))).alias("slot"), F.lit(0).alias("kind"), "id", "label", "mark", "v", lows.alias("lows"), highs.alias("highs"))
    slot = F.pmod(F.xxhash64("mark", "id", "label"), F.lit(slots)).cast("int")
    r = rows.select(F.size("v").alias("dim"), F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("group"), slot.alias("slot"), F.lit(1).alias("kind"), "id", "label", "mark", "v", none.alias("lows"), none.alias("highs"))
    return a.unionByName(r).repartition("dim", "group", "slot").sortWithinPartitions("dim", "group", "slot", "kind")


def _share(rounded, score: Column, percent: int) -> Column:
    """That many per cent of a score, in decimals: a product of two 62-bit numbers isn't exact in doubles."""
    return rounded(score.cast("decimal(20,0)") * percent / 100).cast("bigint")


def hard_negatives(vectors: DataFrame, is_anchor: Column, label: Column | None = None, positives: int = 5, negatives: int = 3, window: tuple[int, int] = (50, 95), scale: int = 256, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    A component x counts as floor(scale * x). For each anchor (``is_anchor``, over the input's columns) and each of its best ``positives`` rows of
    its label: the best ``negatives`` rows of another label whose score is ``window`` per cent of the positive's. ``label`` replaces the label column.
    """
    spark = vectors.sparkSession
    ship(spark)
    v = F.col(vector_col)
    sound = v.isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    source = vectors.where(F.coalesce(sound, F.lit(False))).select(
        F.col(id_col).cast("bigint").alias("id"), (F.col(label_col) if label is None else label).cast("bigint").alias("label"), F.coalesce(is_anchor, F.lit(False)).alias("asks"),
        F.transform(v, lambda x: F.floor(x.cast("double") * scale)).alias("v")).where("id is not null and label is not null")
    rows = written(source.withColumn("mark", F.xxhash64("v")).dropDuplicates(["id", "label", "mark", "v"]))
    n, asking, largest, dim = rows.select(
        F.count(F.lit(1)), F.count_if("asks"), F.max(F.coalesce(F.array_max(F.transform("v", lambda x: F.abs(x).cast("double"))), F.lit(0.0))), F.max(F.size("v"))).first()
    if n and float(largest) ** 2 * max(1, dim) * 4 >= 2.0**62:
        raise ArithmeticError(f"components up to {largest:.3g} in vectors of {dim}: their products do not fit whole numbers of 64 bits")
    kind = next(t for t, most in (("smallint", 1 << 15), ("int", 1 << 31), ("bigint", 1 << 62)) if float(largest or 0) < most)
    rows = rows.withColumn("v", F.col("v").cast(f"array<{kind}>"))
    groups = max(1, -(-asking // GROUP))
    slots = max(1, -(-n // SLOT), min(-(-n // LEAST), -(-SHARES * spark.sparkContext.defaultParallelism // groups)))
    asked = rows.where("asks").drop("asks")
    anchor, out = ["anchor", "anchor_label", "anchor_mark"], ", ".join(f"{c} bigint" for c in MET)

    found = _units(asked, rows.drop("asks"), groups, slots).mapInArrow(_met(positives, False), out)
    order = Window.partitionBy(*anchor).orderBy(F.desc("score"), "id", "label", "mark")
    best = written(found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= positives).select(*anchor, (F.col("rank") - 1).cast("bigint").alias("place"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score")))
    # whole numbers n with low * score <= 100 n <= high * score
    scores = F.transform("best", lambda x: x["positive_score"])
    lists = best.groupBy(*anchor).agg(F.sort_array(F.collect_list(F.struct("place", "positive_score"))).alias("best")).select(
        F.col("anchor").alias("id"), F.col("anchor_label").alias("label"), F.col("anchor_mark").alias("mark"),
        F.transform(scores, lambda s: _share(F.ceil, s, window[0])).alias("lows"), F.transform(scores, lambda s: _share(F.floor, s, window[1])).alias("highs"))
    again = asked.join(lists, ["id", "label", "mark"])
    found = _units(again, rows.drop("asks"), groups, slots).mapInArrow(_met(negatives, True), out)
    order = Window.partitionBy(*anchor, "place").orderBy(F.desc("score"), "id", "label", "mark")
    worst = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives).select(*anchor, "place", "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    return best.join(worst, [*anchor, "place"]).select(F.col("anchor").alias("anchor_id"), "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")


def op12_bit_sliced_negatives(spark, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(parquet(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, label)


OP12_SQL = """
with v as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label, list_transform(cast(embedding as double[]), lambda x: floor(x * 256)) as x
  from embeddings where label is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0
), s as (
  select a.vec_id as anchor_id, b.vec_id as other, a.label = b.label as alike, cast(list_dot_product(a.x, b.x) as bigint) as score
  from v a join v b on a.vec_id % 50 = 0 and a.vec_id <> b.vec_id
), p as (
  select anchor_id, other as positive_id, score as positive_score from s where alike qualify row_number() over (partition by anchor_id order by score desc, other) <= 5
), n as (
  select anchor_id, positive_id, positive_score, other as negative_id, score as negative_score, cast(row_number() over (partition by anchor_id, positive_id order by score desc, other) as integer) as rank
  from p join s using (anchor_id) where not alike and 50 * positive_score <= 100 * score and 100 * score <= 95 * positive_score
)
select anchor_id, positive_id, rank, negative_id, positive_score, negative_score from n where rank <= 3
"""
