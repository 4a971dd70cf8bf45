"""Order statistics and places within groups that may each hold most of a table.

No group is sorted in one task. A group's values are dealt into RANGES ranges whose bounds a mergeable sketch of them gives,
rows of each range are counted, and the counts, a row for each range, say in which range a rank lies and how many come before it. Only that
range is sorted then, in a task of its own; for places, each range is.

Bounds affect how even the ranges are and never the result. Equal values are combined or lie in one range: a range holds more than its share only where
one value does, and then as one row.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..scratch import once

RANGES = 128
#: Groups whose bounds (of at most 8 KB each or so) are broadcast; with more they are joined.
BROADCAST_GROUPS = 2000


def _same(a: str, b: str, keys: list[str]) -> list[Column]:
    return [F.col(f"{a}.{k}").eqNullSafe(F.col(f"{b}.{k}")) for k in keys]


def _joined(rows: DataFrame, few: DataFrame, keys: list[str], add: list[str], broadcast: bool) -> DataFrame:
    """rows with columns of few, which has one row or some for each key; nulls are a key too."""
    few = F.broadcast(few) if broadcast else few.hint("merge")
    return rows.alias("a").join(few.alias("b"), _same("a", "b", keys)).select("a.*", *[f"b.{c}" for c in add])


def _ranged(rows: DataFrame, bounds: DataFrame, group: list[str], value: str, broadcast: bool) -> DataFrame:
    """rows with the range of their value: how many bounds it isn't below. A null value is below all."""
    placed = _joined(rows, bounds, group, ["bounds"], broadcast)
    return placed.withColumn("range", F.coalesce(F.size(F.filter("bounds", lambda b: b <= F.col(value))), F.lit(0))).drop("bounds")


def _steps(ranges: int) -> Column:
    return F.array(*[F.lit(i / ranges) for i in range(1, ranges)])


def _is_small(groups: DataFrame) -> bool:
    return groups.limit(BROADCAST_GROUPS + 1).count() <= BROADCAST_GROUPS


def select_ranks(rows: DataFrame, group: list[str], value: str, ranks: dict[str, Callable[[Column], Column]], ranges: int = RANGES) -> DataFrame:
    """One row per group: n, least, most, and for each of ``ranks`` the value of that rank (from 1), which is a function of n.

    Null values aren't counted; a group that has no other gives no row. Value: a number. rows are computed once: what follows reads
    the counted values, narrow rows, from the shared folder.
    """
    per = once(rows.where(F.col(value).isNotNull()).groupBy(*group, F.col(value).alias("v")).agg(F.count(F.lit(1)).alias("k")))
    facts = per.groupBy(*group).agg(F.sum("k").alias("n"), F.min("v").alias("least"), F.max("v").alias("most"), F.percentile_approx("v", _steps(ranges), 20 * ranges).alias("bounds"))
    small = _is_small(facts)
    placed = _ranged(per, facts.select(*group, "bounds"), group, "v", small)
    counted = placed.groupBy(*group, "range").agg(F.sum("k").alias("here"))
    within = Window.partitionBy(*group)  # a row for each range
    counted = counted.withColumns({"upto": F.sum("here").over(within.orderBy("range")), "n": F.sum("here").over(within)})
    asked = counted.withColumn("ask", F.explode(F.array(*[F.struct(F.lit(name).alias("name"), rank(F.col("n")).cast("bigint").alias("rank")) for name, rank in ranks.items()])))
    asked = asked.where("ask.rank > upto - here and ask.rank <= upto").select(*group, "range", "ask.name", (F.col("ask.rank") - F.col("upto") + F.col("here")).alias("inside"))
    held = _joined(placed, asked, [*group, "range"], ["name", "inside"], small)
    one = Window.partitionBy(*group, "range", "name").orderBy("v")
    found = held.withColumn("upto", F.sum("k").over(one)).where("upto >= inside").groupBy(*group, "name").agg(F.min("v").alias("v"))
    wide = found.groupBy(*group).agg(*[F.max(F.when(F.col("name") == name, F.col("v"))).alias(name) for name in ranks])
    return _joined(facts.drop("bounds"), wide, group, list(ranks), small)


def places_within(rows: DataFrame, group: list[str], order: str, name: str = "place", ranges: int = RANGES) -> DataFrame:
    """rows with their place (from 0) in their group by ``order``: a number that differs from row to row of a group, or null, which is first."""
    bounds = rows.groupBy(*group).agg(F.percentile_approx(order, _steps(ranges), 20 * ranges).alias("bounds"))
    small = _is_small(bounds)
    placed = _ranged(rows, bounds.withColumn("bounds", F.coalesce("bounds", F.array().cast(bounds.schema["bounds"].dataType))), group, order, small)
    counted = placed.groupBy(*group, "range").agg(F.count(F.lit(1)).alias("here"))
    before = F.coalesce(F.sum("here").over(Window.partitionBy(*group).orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = counted.select(*group, "range", before.alias("before"))
    numbered = placed.withColumn(name, F.row_number().over(Window.partitionBy(*group, "range").orderBy(order)) - 1)
    return _joined(numbered, starts, [*group, "range"], ["before"], small).withColumn(name, F.col("before") + F.col(name)).drop("before", "range")
