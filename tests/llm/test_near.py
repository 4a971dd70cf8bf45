import random

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from siltstone.llm import common, minhash_dedup
from siltstone.llm.bytewords import chunks, sets
from siltstone.llm.common import components, far, near, without
from siltstone.llm.minhash_dedup import near_duplicates, needed, op5_bottom_k_minhash

WS = " \t\n\x0b\x0c\r"


def words(t):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
    for c in WS:
        low = low.replace(c, " ")
    return [w for w in low.split(" ") if w]


def shingled(t, width):
    w = words(t)
    return {tuple(w[i : i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else ({tuple(w)} if w else set())


def brute(rows, width, percent):
    s = {i: shingled(t, width) for i, t in rows}
    ids, parent = sorted(s), {i: i for i in s}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, x in enumerate(ids):
        for y in ids[:a]:
            n, m = len(s[x]), len(s[y])
            if n and m and 100 * min(n, m) >= percent * max(n, m):
                k = len(s[x] & s[y])
                if 100 * k >= percent * (n + m - k):
                    p, q = root(x), root(y)
                    parent[max(p, q)] = min(p, q)
    return {i: (len(s[i]), root(i)) for i in ids}


def check(got, want):
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_sets_are_the_sets():
    texts = ["A b  c\td", None, "", "  x", "é É ü", "a b", "a b c a b c a b", " q r s t "]
    for width in (1, 2, 3, 5):
        arr = pa.array(texts)
        seen = {}
        for chunk in (4, 1 << 20):
            for first, data, offsets in chunks(arr, chunk):
                values, at = sets(data, offsets, width)
                for i in range(len(offsets) - 1):
                    want = shingled(texts[first + i], width)
                    got = values[at[i] : at[i + 1]].tolist()
                    assert len(got) == len(want)
                    assert seen.setdefault(frozenset(want), got) == got


@pytest.mark.parametrize("one_task", [0, 10**6])
def test_components(spark, monkeypatch, one_task):
    monkeypatch.setattr(common, "ONE_TASK", one_task)
    random.seed(3)
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 150)] + [(random.randrange(200, 300), random.randrange(200, 300)) for _ in range(80)] + [(None, 5), (7, 7)]
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and a != b:
            p, q = root(a), root(b)
            parent[max(p, q)] = min(p, q)
    got = components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()
    assert {r.node: r.component for r in got} == {x: root(x) for x in parent}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def mutated(rng, base, rate):
    return " ".join(f"z{rng.randrange(10**6)}" if rng.random() < rate else w for w in base)


def made(seed=5):
    rng, rows = random.Random(seed), []
    vocabulary = [f"w{i}" for i in range(3000)]
    passage = [rng.choice(vocabulary) for _ in range(60)]
    for g in range(12):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([3, 8, 30, 150, 600, 2500]))]
        rows += [mutated(rng, base, rng.choice([0, 0.003, 0.01, 0.02, 0.05])) for _ in range(12)]
    rows += [" ".join(passage + [rng.choice(vocabulary) for _ in range(rng.randrange(5, 200))]) for _ in range(60)]
    rows += ["", None, "  ", "one", "One ", "two words", "two  WORDS", "é x", rows[0], rows[1] + " \n"]
    return list(enumerate(rows, 10))


@pytest.mark.parametrize("block", [512, 5])
def test_near_duplicates_brute(spark, monkeypatch, block):
    monkeypatch.setattr(minhash_dedup, "BLOCK", block)
    rows = made()
    df = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "'a' as n", "1 as component_id", "'k' as key")
    check(near_duplicates(df, width=3, percent=85).collect(), brute(rows, 3, 85))
    check(near_duplicates(df).collect(), brute(rows, 5, 80))


def test_edges_of_the_input(spark):
    df = spark.createDataFrame([(None, "a b c"), (1, "a b c"), (1, "a b c")], "doc_id bigint, text string")
    got = sorted(((r.doc_id, r.component_id, r.kept) for r in near_duplicates(df).collect()), key=str)
    assert got == [(1, 1, True), (1, 1, True), (None, None, True)]
    assert near_duplicates(df.limit(0)).count() == 0
    long = [f"w{i}" for i in range(40)]
    rows = [(1, " ".join(long)), (1, "x y z"), (2, " ".join(long[:39])), (3, "x Y  z"), (3, "q r s"), (2, " ".join(long[:39]))]
    got = near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string"), mark=F.xxhash64("text")).collect()
    assert sorted((r.doc_id, r.component_id, r.n_shingles) for r in got) == [(1, 1, 1), (1, 1, 36), (2, 1, 35), (2, 1, 35), (3, 1, 1), (3, 3, 1)]
    assert len({r.mark for r in got}) == 5


def test_sieve(spark):
    df = spark.range(1000).selectExpr("id", "cast(null as string) as bits", "'x' as row")
    few = spark.createDataFrame([(3,), (None,), (999,), (5000,)], "k bigint")
    assert {3, 999} <= {r.id for r in near(df, [F.col("id")], few, ["k"]).collect()}
    assert near(df, [F.col("id")], few, ["k"]).count() + far(df, [F.col("id")], few, ["k"]).count() == 1000
    more = df.unionByName(df.selectExpr("cast(null as bigint) as id", "bits", "row").limit(2))
    got = without(more, [F.col("id")], few, ["k"])
    assert got.columns == df.columns and {r.id for r in got.collect()} == set(range(1000)) - {3, 999} and without(more, [F.col("id")], few.limit(0), ["k"]).count() == 1002


def test_query_brute(spark):
    d = "/root/testdata/sf0.001"
    t = pq.read_table(f"{d}/documents.parquet").to_pylist()
    check(op5_bottom_k_minhash(spark, d).collect(), brute([(r["doc_id"], r["text"]) for r in t], 3, 85))


def test_needed():
    assert needed(32, 0.85) < 32 * 0.85
    assert needed(32, 0.85) > needed(32, 0.8) >= 1
    a = [np.array([1, 2, 3], np.uint64), np.array([2, 3, 9], np.uint64), np.array([], np.uint64)]
    assert minhash_dedup.overlaps(a, columns=1).tolist() == [[2, 2, 0], [2, 2, 0], [0, 0, 0]]


def chained(n, words_each=40):
    """Documents of which each shares a passage with the next and none is like another, and two near copies."""
    passage = [[f"p{i}x{j}" for j in range(words_each)] for i in range(n + 1)]
    rows = [" ".join(passage[i] + [f"o{i}x{j}" for j in range(2 * words_each)] + passage[i + 1]) for i in range(n)]
    rows += [" ".join(f"c{j}" for j in range(120)), " ".join(f"c{j}" for j in range(119))]
    return list(enumerate(rows, 1))


def largest_cluster(monkeypatch):
    """Collects the size of the largest component of every call."""
    sizes = []

    def spied(edges):
        found = components(edges)
        sizes.append(found.groupBy("component").count().agg(F.max("count")).first()[0] or 0)
        return found

    monkeypatch.setattr(minhash_dedup, "components", spied)
    return sizes


def test_shared_passages_do_not_chain(spark, monkeypatch):
    # with the width and percent of the pipeline's near dedup
    sizes, rows = largest_cluster(monkeypatch), chained(80)
    check(near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string"), width=5, percent=80).collect(), brute(rows, 5, 80))
    assert sizes[0] == 2


def test_op5_clusters_hold_what_may_be_alike(spark, monkeypatch, tmp_path):
    # the query itself
    sizes, rows = largest_cluster(monkeypatch), chained(80)
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(str(tmp_path / "documents.parquet"))
    check(op5_bottom_k_minhash(spark, str(tmp_path)).collect(), brute(rows, 3, 85))
    assert sizes[0] == 2


@pytest.mark.parametrize("long, short", [(4, 2), (2048, 1), (3, 8)])
def test_lists_long_and_short(spark, monkeypatch, long, short):
    monkeypatch.setattr(minhash_dedup, "LONG", long)
    monkeypatch.setattr(minhash_dedup, "SHORT", short)
    rows = made(7)
    check(near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string"), width=3, percent=85).collect(), brute(rows, 3, 85))


def test_gathered_joins_all_that_may_be_alike(monkeypatch):
    monkeypatch.setattr(minhash_dedup, "TILE", 4)
    rng = np.random.default_rng(2)
    base = rng.integers(0, 1 << 16, (5, 40))
    lows = [np.sort(rng.permutation(base[rng.integers(5)])[: rng.integers(20, 33)]) for _ in range(60)]
    grid, size = np.full((60, minhash_dedup.LISTED), -1), np.array([len(x) for x in lows])
    for i, x in enumerate(lows):
        grid[i, : len(x)] = x
    shared = np.array([[len(set(x) & set(y)) for y in lows] for x in lows])
    assert (minhash_dedup._meeting(grid, grid) >= shared).all()
    enough = minhash_dedup._enough(shared, size[:, None], size, 60, minhash_dedup.LISTED)

    def joined(edges):
        label = list(range(60))
        for x, y in edges:
            label = [label[x] if z == label[y] else z for z in label]
        return [label.index(z) for z in label]

    edges = minhash_dedup.gathered(np.arange(60), size, grid, 60)
    assert joined(edges) == joined(np.argwhere(enough).tolist())
    assert len(edges) == 60 - len(set(joined(edges)))


def test_large_group_is_not_sent_to_all_its_blocks(spark, monkeypatch):
    # every member of a group went with every block of it; disk grew with the square of the group
    rng, base, n = random.Random(4), [f"b{i}" for i in range(100)], 200
    rows, apart = [" ".join(base[:i] + [f"m{j}"] + base[i + 1 :]) for j, i in enumerate(rng.choices(range(100), k=n))], []
    for g in range(8):  # not like the group, but each like another of them
        own = [f"s{g}x{i}" if i in (10 + g, 30 + g, 50 + g, 70 + g) else w for i, w in enumerate(base)]
        apart += [" ".join(own), " ".join([*own[:-1], f"e{g}"])]
    rows = list(enumerate(rng.sample(rows + apart, n + 16), 1))
    for name, value in (("BLOCK", 8), ("LONG", 16), ("AT_ONCE", 1)):
        monkeypatch.setattr(minhash_dedup, name, value, raising=False)
    keyed = []

    def spied(df):
        out = common.written(df)
        keyed.extend([out.count()] if "key" in out.columns else [])
        return out

    monkeypatch.setattr(minhash_dedup, "written", spied)
    want = brute(rows, 3, 85)
    assert len({c for _, c in want.values()}) == 9
    check(near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string"), width=3, percent=85).collect(), want)
    assert max(keyed) < 8 * n


def test_members_that_are_joined_are_not_asked():
    sets_of = [np.arange(a, a + 400, dtype=np.uint64) for a in (0, 2, 4, 300, 302)]
    assert len(minhash_dedup.links(np.arange(5), sets_of, 85)) == 3
    assert minhash_dedup.links(np.arange(5), sets_of, 85, np.array([7, 9, 9, 8, 8])) == [(0, 1)]
    grid, size = np.tile(np.arange(minhash_dedup.LISTED), (6, 1)), np.full(6, 100)
    assert len(minhash_dedup.gathered(np.arange(6), size, grid, 85)) == 5
    assert len(minhash_dedup.gathered(np.arange(6), size, grid, 85, np.array([3, 3, 3, 5, 5, 5]))) == 1
