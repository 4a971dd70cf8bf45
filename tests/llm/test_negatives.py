import math

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from siltstone.llm import hard_negatives as hn
from siltstone.llm.hard_negatives import OP12_SQL, Planes, hard_negatives, op12_bit_sliced_negatives, sliced

SCHEMA = "vec_id bigint, embedding array<float>, label int, rank string, v int, slot int"


def plain(rows, asks, positives=5, negatives=3, window=(50, 95), scale=256):
    """Every pair, as the contract says. Rows: (id, vector, label); repeated rows are one."""
    kept = []
    for i, v, g in rows:
        if i is None or v is None or g is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        row = (i, tuple(math.floor(scale * float(np.float32(x))) for x in v), g)
        if row not in kept:
            kept.append(row)
    out = []
    for a in kept:
        if not asks(a[0]):
            continue
        score = {b: sum(x * y for x, y in zip(a[1], b[1], strict=True)) for b in kept if len(b[1]) == len(a[1]) and b != a}
        for p in sorted((b for b in score if b[2] == a[2]), key=lambda b: (-score[b], b[0]))[:positives]:
            fit = [b for b in score if b[2] != a[2] and window[0] * score[p] <= 100 * score[b] <= window[1] * score[p]]
            for rank, b in enumerate(sorted(fit, key=lambda b: (-score[b], b[0]))[:negatives], 1):
                out.append((a[0], p[0], rank, b[0], score[p], score[b]))
    return sorted(out)


def test_sliced_intervals_hold():
    rng = np.random.default_rng(1)
    anchors, rows = rng.integers(-300, 300, (7, 9)), rng.integers(-1000, 900, (40, 9))
    want = anchors @ rows.T

    def qualify(a, low, high):
        assert (low <= high).all()
        return (high >= 100_000) & (low <= 400_000)

    bounds = np.full(7, 100_000), np.full(7, 400_000)
    a, r, score = sliced(anchors, Planes(rows), np.ones((7, 40), dtype=bool), *bounds, qualify)
    hit = np.argwhere((want >= 100_000) & (want <= 400_000))
    assert sorted(zip(a.tolist(), r.tolist(), strict=True)) == sorted(map(tuple, hit.tolist())) and (score == want[a, r]).all()


def vectors(seed, n=160):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        base = rng.normal(size=6)
        v = base / np.linalg.norm(base) if i % 5 else np.eye(6)[i % 3]  # many ties
        rows.append((i, [float(x) for x in v], int(rng.integers(0, 3)) if rng.random() < 0.6 else 1))
    odd = [(1000, None, 1), (1001, [0.5] * 6, None), (None, [0.5] * 6, 1), (1010, [0.5, None, 0.1, 0.1, 0.1, 0.1], 1), (1020, [float("nan")] + [0.1] * 5, 1), (1030, [float("inf")] + [0.1] * 5, 2),
           (10, rows[10][1], rows[10][2]), (20, [-x for x in rows[20][1]], rows[20][2]), (1040, [0.1, 0.2], 1), (1041, [0.1, 0.2], 1), (1042, [0.1, 0.11], 2), (1050, [], 0), (1051, [], 0), (1052, [], 1), (1060, [0.0] * 6, 0), (1070, [300.0] * 6, 2)]
    return rows + odd


@pytest.mark.parametrize("small", [False, True])
def test_hard_negatives_brute(spark, monkeypatch, small):
    if small:
        for name, value in (("GROUP", 3), ("SLOT", 16), ("ROWS", 7), ("ANCHORS", 2)):
            monkeypatch.setattr(hn, name, value)
    rows = vectors(int(small))
    df = spark.createDataFrame([(*r, "x", 1, 2) for r in rows], SCHEMA)
    got = sorted(tuple(r) for r in hard_negatives(df, F.col("vec_id") % 10 == 0).collect())
    want = plain(rows, lambda i: i % 10 == 0)
    assert got == want and len(want) > 50
    assert hard_negatives(df.limit(0), F.col("vec_id") % 10 == 0).count() == 0
    assert hard_negatives(df, F.lit(False)).count() == 0


def test_scores_that_do_not_fit(spark):
    df = spark.createDataFrame([(10, [1e30], 1, "x", 1, 2), (11, [1e30], 1, "x", 1, 2)], SCHEMA)
    with pytest.raises(ArithmeticError):
        hard_negatives(df, F.col("vec_id") % 10 == 0)


def test_query_sql(spark):
    d = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.execute(f"create view embeddings as select * from '{d}/embeddings.parquet'")
    got = op12_bit_sliced_negatives(spark, d)
    assert sorted(map(tuple, got.collect())) == sorted(con.execute(OP12_SQL).fetchall())
    assert got.columns == [x[0] for x in con.execute(OP12_SQL).description]
