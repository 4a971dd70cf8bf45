import random

from pyspark.sql import functions as F

from siltstone.operators import order, pilot
from siltstone.operators.reports import MIDDLE, middle


def test_ranks_brute(spark, monkeypatch):
    """Ranks of groups with ties, nulls, NaN, infinities, one value and one row, with broadcast bounds and without."""
    rng = random.Random(4)
    rows = [("hot", rng.choice([rng.gauss(0, 1), float(rng.randrange(4)), 1e300, -1e-300])) for _ in range(3000)] + [("ties", 7.0)] * 500 + [("one", -0.5)] + [(None, float(i % 9)) for i in range(40)]
    rows += [("none", None)] * 3 + [("odd", x) for x in (float("inf"), float("-inf"), None, 0.0, 2.0)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(5)
    ranks = {"a": lambda n: F.lit(1), "b": lambda n: F.floor(n * 0.3) + 1, **MIDDLE, "z": lambda n: n}
    for groups in (order.BROADCAST_GROUPS, 1):
        monkeypatch.setattr(order, "BROADCAST_GROUPS", groups)
        got = {r.g: r for r in order.select_ranks(df, ["g"], "v", ranks, ranges=16).withColumn("median", middle()).collect()}
        assert set(got) == {"hot", "ties", "one", None, "odd"}
        for g, r in got.items():
            xs = sorted(v for h, v in rows if h == g and v is not None)
            n = len(xs)
            assert (r.n, r.least, r.most, r.a, r.b, r.z) == (n, xs[0], xs[-1], xs[0], xs[int(n * 0.3)], xs[-1])
            assert (r.lower, r.upper) == (xs[(n + 1) // 2 - 1], xs[n // 2])
    assert order.select_ranks(df.limit(0), ["g"], "v", ranks).count() == 0


def test_no_group_is_sorted_whole(spark):
    """Windows are over ranges; a large group is in many of them."""
    df = spark.range(200_000).select(F.lit("g").alias("g"), ((F.col("id") * 7919) % 200_003).cast("double").alias("v"))
    got = order.select_ranks(df, ["g"], "v", dict(MIDDLE))
    row = got.first()
    values = sorted(float(i * 7919 % 200_003) for i in range(200_000))
    assert (row.lower, row.upper) == (values[99_999], values[100_000])
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    windows = [x for x in plan.splitlines() if "Window [" in x]
    assert windows and all("range" in x or "sum(here" in x for x in windows)
    bounds = df.groupBy("g").agg(F.percentile_approx("v", order._steps(128), 2560).alias("bounds"))
    sizes = [r["count"] for r in order._ranged(df, bounds, ["g"], "v", True).groupBy("range").count().collect()]
    assert len(sizes) == 128 and max(sizes) < 2 * 200_000 / 128


def test_places_within(spark, monkeypatch):
    rows = [("a", i * 31 % 1009, "x") for i in range(1000)] + [("b", 5, "y"), ("b", None, "z"), (None, 2, "q"), (None, 1, "r")]
    df = spark.createDataFrame(rows, "g string, at bigint, other string").repartition(3)
    for groups in (order.BROADCAST_GROUPS, 1):
        monkeypatch.setattr(order, "BROADCAST_GROUPS", groups)
        got = {(r.g, r["at"]): r.pos for r in order.places_within(df, ["g"], "at", "pos", ranges=8).collect()}
        for g in ("a", "b", None):
            ordered = sorted((x for h, x, _ in rows if h == g), key=lambda x: (x is not None, x))
            assert [got[g, x] for x in ordered] == list(range(len(ordered)))
    assert order.places_within(df.limit(0), ["g"], "at").count() == 0


def test_completeness_of_slugs(spark):
    rows = [("a", True, 0.5), ("a", True, None), ("a", False, 0.1), ("a", True, 0.25), (None, True, 1.0), ("n", True, None)]
    got = {r.slug: (r.n, r.median, r.least) for r in pilot.completeness_by(spark.createDataFrame(rows, "slug string, lint_pass boolean, completeness double")).collect()}
    assert got == {"a": (3, 0.375, 0.25), None: (1, 1.0, 1.0), "n": (1, None, None)}


def test_rows_are_computed_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def dear(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch
    df = spark.range(300).selectExpr("id % 3 as g", "id % 50 as v").mapInArrow(dear, "g bigint, v bigint")
    got = {r.g: (r.n, r.lower, r.upper) for r in order.select_ranks(df, ["g"], "v", dict(MIDDLE)).collect()}
    assert got == {g: (100, 24, 25) for g in range(3)} and seen.value == 300
