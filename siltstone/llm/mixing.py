"""Mixing sources to target weights by iterative proportional fitting.

Tokens are summed by cell: source, language and topic. The cells' weights are raked to the three
target marginals in turn until all hold; that is the weight of a document. Documents are drawn with
the probability of their cell, so that a share of all tokens is drawn in expectation, with the target
marginals. No probability can pass 1: a cell that would is taken whole, and the others are raked to
what is left, so a rare cell doesn't scale down the rest. The draw is a hash of the id, so it
repeats, and a document is drawn at most once.

Where no target is given, it is the marginal's own token shares to a power below 1, for all of its
categories. These are wishes: a category that has fewer tokens than its target is taken whole, and the
others share the rest in their proportions. Given targets are held exactly, and the share that is
drawn is lowered to what their categories have. A marginal with given targets has the categories that
they name; others share one, "other". Only cells with tokens are fitted, on the driver: their number
is that of the combinations there are, and no category is left out.

Defined cases: a null category is a category of its own; a null or empty text has no tokens and is
drawn with its cell's probability, or, in a cell without tokens, with the share of all tokens that is
drawn; a target for a category without tokens, or a zero target, is
renormalised over the others (a zero target drops the category); a null id is drawn as id 0; repeated
rows are drawn alike; an empty table gives no rows; input columns named like outputs are not touched.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import parquet, written

#: Share of all tokens that is drawn, in expectation.
SHARE = 0.85
#: Cells up to which their weights are broadcast; beyond, they are joined.
BROADCAST_CELLS = 100_000
NULL, OTHER = "\x00null", "\x00other"
SOURCE_POWER, LANG_POWER, TOPIC_POWER = 0.9, 0.9, 1.0
#: The languages that the query mixes and their shares of its tokens; sources and topics are tempered.
LANG_TARGETS = {"en": 0.56, "de": 0.16, "fr": 0.16, "es": 0.12}


def word_count(text: Column) -> Column:
    """Tokens for weights: runs of characters that aren't white space."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit("[^\\x20\\x09-\\x0D]+")).cast("bigint")


def factors(n: np.ndarray, u: np.ndarray, group: np.ndarray, goal: np.ndarray) -> np.ndarray:
    """For each group the factor of u at which its sum of n * min(1, u) is its goal (or all of n, when that is less)."""
    total, most = np.bincount(group, n * u, len(goal)), np.bincount(group, n, len(goal))
    found = np.divide(goal, total, out=np.zeros(len(goal)), where=total > 0)
    top = np.zeros(len(goal))
    np.maximum.at(top, group, u)
    mine = np.flatnonzero((found * top > 1)[group])
    if not len(mine):
        return found
    # with the first m members at 1, by falling u, the others make up what is left; the first m at which these stay below 1
    mine = mine[np.lexsort((-u[mine], group[mine]))]
    g, u = group[mine], u[mine]
    first = np.flatnonzero(np.r_[True, g[1:] != g[:-1]])
    size = np.diff(np.r_[first, len(g)])
    a, b = n[mine] / most[g], n[mine] * u / total[g]
    whole, used = np.cumsum(a) - a, np.cumsum(b) - b
    whole, used = whole - np.repeat(whole[first], size), used - np.repeat(used[first], size)
    s = (goal[g] / most[g] - whole) / np.maximum(1 - used, b) * (most / np.where(total > 0, total, 1))[g]
    found[g[first]] = 1 / u[first + size - 1]
    fits = np.flatnonzero(s * u <= 1)[::-1]
    found[g[fits]] = s[fits]
    return found


def fitted(n: np.ndarray, at: list[np.ndarray], goals: list[np.ndarray], whole: bool = False, rounds: int = 1000, tolerance: float = 1e-10) -> tuple[np.ndarray, list[float]]:
    """(u, the largest miss of each axis): cells n * u, or n * min(1, u) if ``whole``, have the goals as sums along each axis.

    n, and for each axis the place of its category, by cell.
    """
    u, worst = np.ones(len(n)), [0.0] * len(at)
    for _ in range(rounds):
        for axis, (group, goal) in enumerate(zip(at, goals, strict=True)):
            now = np.bincount(group, n * np.minimum(u, 1) if whole else n * u, len(goal))
            worst[axis] = np.abs(now - goal).max(initial=0)
            u = u * (factors(n, u, group, goal) if whole else np.divide(goal, now, out=np.zeros(len(goal)), where=now > 0))[group]
        if max(worst, default=0) < tolerance:
            break
    return np.minimum(u, 1) if whole else u, worst


def shares(n: np.ndarray, group: np.ndarray, target: np.ndarray) -> np.ndarray:
    """The target over the categories that have tokens, as shares of 1."""
    there = np.where(np.bincount(group, n, len(target)) > 0, target, 0.0)
    return there / there.sum() if there.sum() else there


def rake(cells: np.ndarray, targets: list[np.ndarray]) -> np.ndarray:
    """The cells scaled along each axis in turn until each axis' sums are its target shares of 1."""
    at = np.nonzero(cells)
    n = cells[at] / (cells.sum() or 1.0)
    fit = np.zeros(cells.shape)
    fit[at] = n * fitted(n, list(at), [shares(n, g, np.asarray(t, float)) for g, t in zip(at, targets, strict=True)])[0]
    return fit


def chances(n: np.ndarray, at: list[np.ndarray], targets: list[np.ndarray], given: list[bool], ratio: np.ndarray, share: float) -> np.ndarray:
    """The probability of each cell at which a share of the tokens n is drawn with the target marginals.

    Targets that are given hold exactly, for as much as there is; of others, what a category doesn't
    have goes to those that do. ``ratio`` is the fit without a bound: with the largest made 1 given
    targets always hold, so the share isn't lowered beyond that.
    """
    live = np.flatnonzero(ratio > 0)
    chance = np.zeros(len(n))
    if not len(live):
        return chance
    n, at, ratio = n[live], [g[live] for g in at], ratio[live]
    sizes = [np.bincount(g, n, len(t)) for g, t in zip(at, targets, strict=True)]
    wanted = [shares(n, g, t) for g, t in zip(at, targets, strict=True)]
    least = 1 / ratio.max()
    drawn = min([share * n.sum(), *[float((z[t > 0] / t[t > 0]).min()) for z, t, fixed in zip(sizes, wanted, given, strict=True) if fixed]])
    while True:
        goals = []
        for z, t, fixed in zip(sizes, wanted, given, strict=True):
            over = np.divide(t, z, out=np.zeros(len(t)), where=z > 0)
            level = factors(z, over, np.zeros(len(t), dtype=np.int64), np.array([drawn]))[0]
            goals.append(drawn * t if fixed else z * np.minimum(1, over * level))
        chance[live], worst = fitted(n, at, goals, whole=True)
        if drawn <= least or not any(given) or max(w for w, fixed in zip(worst, given, strict=True) if fixed) < 1e-8:
            return chance
        drawn = max(least, drawn * 0.95)


def uniform(id_col: Column, seed: int) -> Column:
    """A number in [0, 1) from the id."""
    return F.pmod(F.xxhash64(F.lit(seed), F.coalesce(id_col.cast("bigint"), F.lit(0))), F.lit(1 << 53)).cast("double") / float(1 << 53)


def _named(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(NULL))


def calibrate(rows: DataFrame, given: list[dict[str, float] | None], powers: tuple[float, ...], share: float) -> pa.Table:
    """rows (k0, k1, ..., tokens): each cell that has tokens with its weight, raked share over share of tokens, and its probability."""
    keys = [f"k{i}" for i in range(len(given))]
    cells = rows.groupBy(*keys).agg(F.sum("tokens").alias("n")).where("n > 0").toArrow().sort_by([(k, "ascending") for k in keys])
    n = cells["n"].to_numpy().astype(float)
    n = n / (n.sum() or 1.0)
    at, targets = [], []
    for k, goal, power in zip(keys, given, powers, strict=True):
        coded = cells[k].combine_chunks().dictionary_encode()
        at.append(coded.indices.to_numpy().astype(np.int64))
        names = coded.dictionary.to_pylist()
        targets.append(np.array([goal.get(x, 0.0) for x in names]) if goal else np.bincount(at[-1], n, len(names)) ** power)
    weight = fitted(n, at, [shares(n, g, t) for g, t in zip(at, targets, strict=True)])[0]
    chance = chances(n, at, targets, [bool(g) for g in given], weight, share)
    return pa.table({**{k: cells[k] for k in keys}, "weight": weight, "probability": chance, "n": n})


def counted(docs: DataFrame, columns: tuple[str, ...], id_col: str = "doc_id", text_col: str = "text", mark: Column | None = None) -> DataFrame:
    """Id, the columns, tokens of each document and ``mark`` if one is given: texts are read once, what follows reads these narrow rows."""
    return written(docs.select(F.col(id_col).alias("id"), *[F.col(c) for c in columns], word_count(F.col(text_col)).alias("tokens"), *([] if mark is None else [mark.alias("mark")])))


def mix(rows: DataFrame, columns: tuple[str, ...] = ("source", "lang", "topic"), targets: dict[str, dict[str, float]] | None = None,
        powers: tuple[float, ...] = (SOURCE_POWER, LANG_POWER, TOPIC_POWER), seed: int = 17, share: float = SHARE) -> DataFrame:
    """One row per input row (see ``counted``): id, the columns, tokens, weight, probability, sampled, and its mark if it has one.

    weight is the raked share of the row's cell over its own share of tokens. ``targets`` maps a
    column to shares by category (the null category: None); a column without one gets its own
    shares to its power. ``share`` of the tokens is drawn in expectation, or what given targets allow.
    """
    named = {c: {NULL if k is None else str(k): float(v) for k, v in t.items()} for c, t in (targets or {}).items()}
    given = [named.get(c) or None for c in columns]
    keys = {f"k{i}": F.when(_named(c).isin([k for k in t if k != OTHER]), _named(c)).otherwise(F.lit(OTHER)) if t else _named(c) for i, (c, t) in enumerate(zip(columns, given, strict=True))}
    cells = calibrate(rows.select(*[v.alias(k) for k, v in keys.items()], "tokens"), given, powers, share)
    weights = rows.sparkSession.createDataFrame(cells, ", ".join(f"{k} string" for k in keys) + ", weight double, probability double, n double")
    mean = float((cells["probability"].to_numpy() * cells["n"].to_numpy()).sum()) if cells.num_rows else 1.0
    dropped = [_named(c).isin([k for k, v in t.items() if v <= 0]) if OTHER in t else ~_named(c).isin([k for k, v in t.items() if v > 0]) for c, t in zip(columns, given, strict=True) if t]
    bare = F.when(reduce(or_, dropped), F.lit(0.0)).otherwise(F.lit(mean)) if dropped else F.lit(mean)
    marks = [c for c in rows.columns if c == "mark"]
    placed = rows.select("id", *columns, "tokens", *marks, *[v.alias(k) for k, v in keys.items()])
    joined = placed.join(F.broadcast(weights) if cells.num_rows <= BROADCAST_CELLS else weights, list(keys), "left")
    chance = F.coalesce("probability", bare)
    return joined.select("id", *columns, "tokens", F.coalesce("weight", F.lit(0.0)).alias("weight"), chance.alias("probability"), (uniform(F.col("id"), seed) < chance).alias("sampled"), *marks)


def topics(spark, sf_dir: str) -> DataFrame:
    """(id, topic): the label of the vector of a document's id in the table of embeddings."""
    return parquet(spark, sf_dir, "embeddings").where("vec_id is not null").groupBy(F.col("vec_id").alias("id")).agg(F.min("label").cast("string").alias("topic"))


def mixed_documents(spark, docs: DataFrame, sf_dir: str, targets: dict[str, dict[str, float]] | None = None, mark: Column | None = None) -> DataFrame:
    """``mix`` over documents; topics come from the table of embeddings, none where it has no vector. Without targets all marginals are tempered."""
    return mix(counted(docs, ("source", "lang"), mark=mark).join(topics(spark, sf_dir), "id", "left"), targets=targets)


def op4_raked_mixing(spark, sf_dir: str) -> DataFrame:
    return mixed_documents(spark, parquet(spark, sf_dir, "documents"), sf_dir, {"lang": LANG_TARGETS}).withColumnRenamed("id", "doc_id")
