import numpy as np
import pyarrow.parquet as pq
import pytest

from siltstone.llm.mixing import LANG_TARGETS, counted, factors, mix, op4_raked_mixing, rake
from siltstone.llm.toxicity import CumulativeLink, bags, fit, graded, marked, op3_ordinal_toxicity, score

SCHEMA = "doc_id bigint, text string, lang string, source string, topic string"


def test_ordinal_fit_recovers_order():
    rng = np.random.default_rng(0)
    x = rng.random((3000, 6)) < 0.3
    true = np.array([3.0, 2, -2, 0, 0, 1])
    y = x @ true + rng.logistic(size=3000)
    grades = (y > 1.5).astype(int) + (y > 3.5)
    rows, cols = np.nonzero(x)
    m = CumulativeLink.fit(rows, cols, grades, np.arange(6, dtype=np.uint64))
    assert np.abs(m.weights - true).max() < 0.5 and m.thresholds[0] < m.thresholds[1]
    assert np.abs(m.thresholds - [1.5, 3.5]).max() < 0.4
    p = m.at_least(cols.astype(np.uint64), rows, 3000)
    assert (p[:, 0] >= p[:, 1]).all()
    assert abs(p[:, 0].mean() - (grades >= 1).mean()) < 0.02


def test_gradient_is_the_slope():
    rng = np.random.default_rng(1)
    x = rng.random((200, 3)) < 0.5
    grades = rng.integers(0, 3, 200)
    rows, cols = np.nonzero(x)
    m = CumulativeLink.fit(rows, cols, grades, np.arange(3, dtype=np.uint64), steps=2000, rate=0.02, l2=0)

    def loss(w, t):
        c = np.hstack([np.zeros((200, 1)), 1 / (1 + np.exp(x @ w[:, None] - t)), np.ones((200, 1))])
        return -np.log(c[np.arange(200), grades + 1] - c[np.arange(200), grades]).mean()

    best = loss(m.weights, m.thresholds)
    for i in range(3):
        for d in (-0.2, 0.2):
            assert loss(m.weights + d * np.eye(3)[i], m.thresholds) > best - 1e-4


def test_held_out_accuracy(spark):
    d = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    model = fit(docs, labels.where("doc_id % 2 = 0"))
    got = {r.doc_id: r for r in score(docs.join(labels, "doc_id").where("doc_id % 2 = 1").select("doc_id", "text"), model).collect()}
    want = {r["doc_id"]: r["toxic"] for r in pq.read_table(f"{d}/labels.parquet").to_pylist()}
    hit = [(got[i].rejected, bool(want[i])) for i in got]
    assert sum(a == b for a, b in hit) / len(hit) > 0.97
    assert sum(a for a, b in hit if b) / sum(b for _, b in hit) > 0.88
    assert sum(a for a, b in hit if not b) / sum(not b for _, b in hit) < 0.015
    assert all(0 <= r.severity <= 2 for r in got.values())


def test_toxicity_edges(spark):
    rows = [(1, None), (2, ""), (None, "x"), (3, "bad " * 50_000), (3, "bad")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "1 as severity", "2 as id")
    none = fit(docs, spark.createDataFrame([], "doc_id bigint, toxic int"))
    assert [r.rejected for r in score(docs, none).collect()] == [False] * 5
    one = fit(docs, spark.createDataFrame([(1, 1), (2, None), (9, 0)], "doc_id bigint, toxic int"))
    assert not any(r.rejected for r in score(docs, one).collect())
    assert score(docs.limit(0), none).count() == 0


def test_rake_meets_marginals():
    rng = np.random.default_rng(2)
    cells = rng.random((4, 3, 5)) * (rng.random((4, 3, 5)) < 0.8)
    targets = [np.array(t, float) for t in ([4, 3, 2, 1], [1, 1, 1], [5, 1, 1, 1, 2])]
    got = rake(cells, targets)
    for axis, t in enumerate(targets):
        assert np.allclose(got.sum(axis=tuple(i for i in range(3) if i != axis)), t / t.sum(), atol=1e-6)
    assert ((got > 0) == (cells > 0)).all()


def mixed(spark, rows, **more):
    return mix(counted(spark.createDataFrame(rows, SCHEMA).withColumn("weight", pytest.importorskip("pyspark.sql.functions").lit(1)), ("source", "lang", "topic")), **more)


def test_mixing_calibrates(spark):
    rows = [(i, "w " * (1 + i % 7), "en" if i % 5 else None, ["a", "b", "c"][min(2, i % 6)], f"t{i % 2}") for i in range(6000)]
    goal = {"source": {"a": 0.4, "b": 0.3, "c": 0.3}, "lang": {"en": 0.6, None: 0.4}}
    got = mixed(spark, rows, targets=goal).toPandas()
    assert len(got) == 6000 and got.probability.max() <= 1 + 1e-9
    expected = (got.tokens * got.probability).groupby(got.source).sum()
    assert np.allclose(expected / expected.sum(), [0.4, 0.3, 0.3], atol=1e-6)
    drawn = got[got.sampled].groupby(got.lang.fillna("-")).tokens.sum()
    assert abs(drawn["-"] / drawn.sum() - 0.4) < 0.05


def test_mixing_edges(spark):
    rows = [(1, None, None, None, None), (2, "", "en", "a", None), (None, "x y", "en", "zzz", "t"), (3, "x " * 100_000, "en", "a", "t"), (3, "x", "en", "a", "t")]
    got = mixed(spark, rows, targets={"source": {"a": 1.0, "missing": 2.0}}).collect()
    assert len(got) == 5 and {r.tokens for r in got} == {0, 2, 100_000, 1}
    assert next(r for r in got if r.source == "zzz").sampled is False
    assert mixed(spark, []).count() == 0
    got = {r.id: r.probability for r in mixed(spark, [(1, "x y z", "en", "a", "t"), (2, "", "en", "bare", "t"), (3, None, None, None, None)]).collect()}
    assert got[2] == got[3] == pytest.approx(0.85)  # cells without tokens
    got = {r.id: r.probability for r in mixed(spark, [(1, "x y z", "en", "a", "t"), (2, "", "en", "bare", "t"), (3, "", "de", "a", "t")], targets={"source": {"a": 1.0}}).collect()}
    assert got[2] == 0 and got[3] == pytest.approx(got[1])


def test_a_rare_cell_leaves_the_draw(spark):
    rows = [(i, "w " * 20, "en" if i % 3 else "de", f"s{i % 5}", f"t{i % 4}") for i in range(6000)]
    kept = []
    for more in ([], [(9000, "w " * 50, "xx", "new", "t0")]):
        got = mixed(spark, rows + more).toPandas()
        kept.append((got.tokens * got.probability).sum() / got.tokens.sum())
        assert got.probability.max() <= 1 and len(got) == 6000 + len(more)
    assert np.allclose(kept, 0.85, atol=1e-6)
    assert got[got.source == "new"].probability.iloc[0] > 1 - 1e-9
    got = mixed(spark, [*rows, (9000, "w " * 50, "xx", "s0", "t0")], targets={"source": {f"s{i}": 1.0 for i in range(5)}}).toPandas()
    by = (got.tokens * got.probability).groupby(got.source).sum()
    assert np.allclose(by / by.sum(), 0.2, atol=1e-6) and by.sum() / got.tokens.sum() > 0.84


def test_probabilities_are_bounded_and_hold_goals():
    rng = np.random.default_rng(4)
    n, group, u = rng.random(200), rng.integers(0, 9, 200), rng.random(200) * 10
    goal = np.bincount(group, n, 9) * np.array([0.1, 0.3, 0.5, 0.7, 0.9, 0.99, 1.0, 0.0, 0.2])
    got = np.bincount(group, n * np.minimum(1, u * factors(n, u, group, goal)[group]), 9)
    assert np.allclose(got, goal)


def test_all_categories_are_raked(spark):
    sizes = np.r_[np.full(70, 40), np.arange(2, 62)]
    rows, at = [], 0
    for s, k in enumerate(sizes):
        for _ in range(k):
            rows.append((at, "w " * (1 + at % 3), "en" if at % 4 else "de", f"s{s:03d}", f"t{at % 90}"))
            at += 1
    got = mixed(spark, rows, powers=(0.5, 0.9, 1.0)).toPandas()
    n = got.groupby("source").tokens.sum()
    want = n ** 0.5 / (n ** 0.5).sum()
    have = (got.tokens * got.weight).groupby(got.source).sum() / got.tokens.sum()
    assert len(n) == 130 and np.allclose(have, want, rtol=1e-4)


def test_grades(spark):
    rows = [(1, 0), (1, 1), (2, 1), (4, None), (5, 0), (5, 0), (None, 1)]
    assert {r.id: r.grade for r in marked(spark.createDataFrame(rows, "doc_id bigint, toxic int")).collect()} == {1: 1, 2: 1, 5: 0}
    rng = np.random.default_rng(3)
    x = rng.random((2000, 5)) < 0.4
    label = (x.sum(axis=1) + rng.logistic(size=2000) * 0.3 > 2.5).astype(int)
    rows, cols = np.nonzero(x)
    got = graded(label, rows, cols, np.arange(5, dtype=np.uint64))
    assert ((got > 0) == (label > 0)).all() and x.sum(axis=1)[got == 2].mean() > x.sum(axis=1)[got == 1].mean() + 0.5


def test_mixing_query_brute(spark):
    """Plain fitting over dictionaries of the documents' cells."""
    d = "/root/testdata/sf0.01"
    docs, topic = pq.read_table(f"{d}/documents.parquet").to_pylist(), {}
    for r in pq.read_table(f"{d}/embeddings.parquet").to_pylist():
        topic[r["vec_id"]] = min(r["label"], topic.get(r["vec_id"], r["label"]))
    cell = {r["doc_id"]: (r["source"], r["lang"], topic.get(r["doc_id"])) for r in docs}
    n, cells = {r["doc_id"]: len((r["text"] or "").split()) for r in docs}, {}
    for i, c in cell.items():
        cells[c] = cells.get(c, 0) + n[i]
    total = sum(cells.values())
    targets = []
    for axis, power in enumerate((0.9, None, 1.0)):
        sums = {}
        for c, x in cells.items():
            sums[c[axis]] = sums.get(c[axis], 0) + x / total
        goal = {k: v**power for k, v in sums.items()} if power else {k: LANG_TARGETS.get(k, 0) for k in sums}
        targets.append({k: v / sum(goal.values()) for k, v in goal.items()})
    fit_ = {c: x / total for c, x in cells.items()}
    for _ in range(300):
        for axis, goal in enumerate(targets):
            sums = {}
            for c, x in fit_.items():
                sums[c[axis]] = sums.get(c[axis], 0) + x
            fit_ = {c: x * goal[c[axis]] / sums[c[axis]] if sums[c[axis]] else 0.0 for c, x in fit_.items()}
    got = op4_raked_mixing(spark, d).toPandas()
    assert len(got) == len(docs)
    for r in got.itertuples():
        assert r.tokens == n[r.doc_id]
        if r.tokens:
            assert r.weight == pytest.approx(fit_[cell[r.doc_id]] / (cells[cell[r.doc_id]] / total), rel=1e-5)
    have = (got.tokens * got.probability).groupby(got.lang).sum()
    assert all(have[k] / have.sum() == pytest.approx(v, abs=1e-4) for k, v in LANG_TARGETS.items()) and 0.5 < have.sum() / got.tokens.sum() <= 0.851


def test_toxicity_query(spark):
    """Scores are those of a plain sum of weights over the words of each text."""
    d = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{d}/documents.parquet")
    model = fit(docs, spark.read.parquet(f"{d}/labels.parquet"))
    got = {r.doc_id: r for r in op3_ordinal_toxicity(spark, d).collect()}
    table = pq.read_table(f"{d}/documents.parquet").to_pylist()
    assert len(got) == len(table) == 200
    weight = dict(zip(model.features.tolist(), model.weights.tolist(), strict=True))
    for r in table:
        raw = np.frombuffer((r["text"] or "").encode(), np.uint8)
        values, _, _ = bags(raw, np.array([0, len(raw)]))
        p = [1 / (1 + np.exp(-(sum(weight.get(v, 0.0) for v in values.tolist()) - t))) for t in model.thresholds]
        assert got[r["doc_id"]].severity == pytest.approx(sum(p)) and got[r["doc_id"]].rejected == (p[0] >= 0.2)
