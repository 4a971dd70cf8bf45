import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from siltstone.operators import changes, kept, tracker
from siltstone.sources.records import OUTCOME_COLUMNS, WORKS_SCHEMA

SCHEMA = "id bigint, a string, b double"


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.mark.parametrize("seed", range(4))
def test_changed_rows_are_those_of_except_all(spark, seed):
    rng = random.Random(seed)
    one = [(rng.choice([None, *range(60)]), rng.choice(["x", None, "é"]), rng.choice([0.5, None, float("nan")])) for _ in range(120)]
    two = [r for r in one if rng.random() < 0.8] + [(rng.randrange(60), "new", 1.0) for _ in range(seed * 5)]
    a, b = frame(spark, one), frame(spark, two)
    got = Counter()
    for r in changes.changed_rows(a, b, ["id"], buckets=16).collect():
        got[r.side, str((r.id, r.a, r.b))] += r.times
    want = Counter()
    for side, rows in (("a", a.exceptAll(b)), ("b", b.exceptAll(a))):
        want.update((side, str(tuple(r))) for r in rows.collect())
    assert got == want
    assert changes.changed_rows(a, a, ["id"]).count() == 0


def test_only_differing_buckets_are_met(spark):
    rows = [(i, f"x{i % 7}", float(i)) for i in range(4000)]
    a, b = frame(spark, rows), frame(spark, [(i, "changed" if i in (17, 99) else x, y) for i, x, y in rows])
    found = changes.differing(a, b, ["id"], ["id", "a", "b"], 256)
    assert 1 <= len(found) <= 2
    assert changes._of(a, ["id"], found, 256).count() < 4000 * 3 * len(found) / 256
    got = changes.differences(a, b, "id", ["a", "b"]).first()
    assert (got.a, got.b, got.unpaired) == (2, 0, 0)
    same = changes.differences(a, a, "id", ["a", "b"])
    assert tuple(same.first()) == (0, 0, 0) and "Exchange hashpartitioning" not in same._jdf.queryExecution().executedPlan().toString()  # no row is moved
    # an even number of repeats isn't nothing
    assert changes.differing(frame(spark, [(1, "x", 1.0)]), frame(spark, [(1, "x", 1.0)] * 3), ["id"], ["id", "a", "b"])


def test_rejudging_does_what_changed(spark, tmp_path):
    path, seen = f"file://{tmp_path}/judged", f"file://{tmp_path}/seen"

    def judge(rows):
        return rows.select("id", F.length("text").alias("n"))

    def run(texts, version=1):
        df = spark.createDataFrame(sorted(texts.items()), "id bigint, text string").withColumn("mark", changes.mark_of("text", {"judge": version}))
        done = changes.rejudge(df, judge, path, buckets=64)
        assert sorted((r.id, r.n) for r in changes.judged(spark, path).collect()) == sorted((i, len(t) if t is not None else None) for i, t in texts.items())
        return done

    texts = {i: "x" * (i % 50) for i in range(3000)}
    assert run(texts) == {"judged": 3000, "gone": 0, "written": 64}
    parts = {p: p.stat().st_mtime_ns for p in (tmp_path / "judged").rglob("*.parquet")}
    assert run(texts) == {"judged": 0, "gone": 0, "written": 0}
    bucket = {r.id: r.bucket for r in spark.range(3000).select("id", changes.bucket_of(["id"], 64).alias("bucket")).collect()}
    some = [i for i in texts if bucket[i] == 5][:30]  # 1 in 100, in one bucket
    for i in some:
        texts[i] += "changed"
    assert run(texts) == {"judged": len(some), "gone": 0, "written": 1}
    left = set((tmp_path / "judged").rglob("*.parquet")) & set(parts)
    assert all(p.stat().st_mtime_ns == parts[p] for p in left) and {p.parent.name for p in set(parts) - left} == {"bucket=5"}
    gone = [i for i in texts if bucket[i] == 6]
    for i in gone:
        del texts[i]
    texts[5000] = None
    assert run(texts) == {"judged": 1, "gone": len(gone), "written": 2} and not (tmp_path / "judged/bucket=6").exists() or bucket.get(5000) == 6
    assert run(texts, version=2)["judged"] == len(texts)
    assert seen


def test_the_kept_tracker_is_not_shuffled(spark, tmp_path):
    works = spark.createDataFrame([(None, None, f"W{i}", f"10.1/{i}", "t", 2024, None, None, "Energies", None, "Wiley", True, None, "cc-by", "publishedVersion", None, True, False) for i in range(300)], WORKS_SCHEMA)
    outcomes = spark.createDataFrame([(f"W{i}", "failed" if i % 2 else None, None, "none", None, "m", f"2025-0{1 + i % 3}") for i in [*range(0, 400, 7), *range(0, 400, 21)]], "id string, ingest_status string, gates_passed boolean, figures_status string, escalate_reason string, ingest_mid string, ingest_ts string")
    sidecars = spark.createDataFrame([(f"/{i}/metadata.json", f'{{"identity": {{"work_id": "W{i}"}}, "assets": {{"count": {i}}}}}', False) for i in range(0, 100, 9)] + [("/bad", "{", True)], "sidecar_path string, sidecar string, bad boolean")
    full = tracker.build(works, outcomes, sidecars)
    kept.keep(tracker.build(works), "kept_works", 8, f"file://{tmp_path}/kept")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = kept.overlaid(spark, "kept_works", outcomes, sidecars)
        rows = sorted(map(str, got.select(*full.columns).collect()))
        assert rows == sorted(map(str, full.collect()))
        plan = got._jdf.queryExecution().executedPlan().toString()
        join = plan.index("SortMergeJoin")
        # from the joins down to the table's scan nothing is exchanged: the only exchanges are of outcomes and sidecars
        scan = plan.index("kept_works")
        assert "Exchange" not in plan[join:scan] and plan.count("Bucketed: true") >= 1
        kept.keep(got, "kept_again", 8, f"file://{tmp_path}/again")
        assert sorted(map(str, spark.table("kept_again").select(*full.columns).collect())) == rows
        assert kept.buckets_of(spark, "kept_again") == 8 and set(OUTCOME_COLUMNS) <= set(got.columns)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("drop table if exists kept_works")
        spark.sql("drop table if exists kept_again")
