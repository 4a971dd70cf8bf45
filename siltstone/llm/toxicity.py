"""Toxicity by cumulative-link ordinal regression.

A text is a sparse bag: the distinct words (runs of ASCII letters, digits and non-ASCII bytes,
A-Z lower-cased) and the distinct first 4 to 8 bytes of longer words, hashed. The model has one weight a
feature, shared by all grades, and ordered thresholds: P(grade >= k) = sigmoid(x.w - theta_k).
Expected severity is the sum of these probabilities.

Fitting takes labelled rows up to SAMPLE_ROWS, a documented bound: a larger labelled set is thinned
by a hash of the id. Features come from that sample, those whose occurrence in graded rows is beyond
chance, so no weight is below 0 and a long text that has many can't outweigh them; there are at most MAX_FEATURES weights (a parameter), so what is broadcast is bounded. Scoring reads every
row and whole texts, in one pass without a shuffle.

Labels carry 0 or 1. Where they carry no grades, the rows labelled 1 are split into two: a model with
one threshold is fitted on each half of the sample and scores the other half, and a row above the median
of these scores is of the more severe grade. So no row is graded by a model that has seen it. With several labels
of one document the most severe counts.

Defined cases: a null or empty text has no feature, expected severity of the thresholds alone and is
not rejected; labels that are null or without a document are left out; with no labelled rows, or
rows of one label only, nothing is rejected; repeated rows are scored each; an empty table gives no
rows; other columns are not touched.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bytewords import LETTER, LOWER, chunks, hashed, spans
from .common import parquet, ship, written

SAMPLE_ROWS, MAX_FEATURES, MIN_ROWS = 30_000, 20_000, 4
#: Of the rows with a feature, so many have a grade above 0; features of both kinds of row only blur the thresholds.
MIN_SHARE = 0.5
#: P(grade > 0) from which a text is rejected: a toxic text that stays costs more than a clean one that goes.
REJECT_AT = 0.2
PREFIXES = (4, 5, 6, 7, 8)
#: Bags that are looked at at once.
SLICE_ROWS = 1024


def bags(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(feature hashes, their texts), distinct in each text and ordered by text; and each text's number of words."""
    low = LOWER[data]
    starts, ends, owner = spans(low, offsets, LETTER[low])
    found, own = [hashed(low, starts, ends)], [owner]
    for k in PREFIXES:
        longer = ends - starts > k
        found.append(hashed(low, starts[longer], starts[longer] + k))
        own.append(owner[longer])
    n = np.bincount(owner, minlength=len(offsets) - 1)
    values, owner = np.concatenate(found), np.concatenate(own)
    order = np.lexsort((values, owner))
    values, owner = values[order], owner[order]
    new = np.ones(len(values), dtype=bool)
    new[1:] = (values[1:] != values[:-1]) | (owner[1:] != owner[:-1])
    return values[new], owner[new], n


def _bags(batches):
    """(id, grade, bag): the features of each text. Batches: id, grade, text."""
    for batch in batches:
        for first, data, offsets in chunks(batch.column(2)):
            values, owner, n = bags(data, offsets)
            at = np.cumsum(np.bincount(owner, minlength=len(n)))[:-1]
            yield pa.RecordBatch.from_arrays([*(batch.column(c).slice(first, len(n)) for c in (0, 1)), pa.array([v.tobytes() for v in np.split(values, at)], pa.binary())], names=["id", "grade", "bag"])


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The features of all bags, one after another, and the row of each."""
    cells = column.to_pylist()
    return np.frombuffer(b"".join(cells), dtype=np.uint64), np.repeat(np.arange(len(cells)), [len(c) // 8 for c in cells])


def _feature_counts(batches):
    """(feature, n, bad): rows and bad rows of each feature, summed for a batch. Batches: id, grade, bag."""
    for batch in (whole.slice(at, SLICE_ROWS) for whole in batches for at in range(0, whole.num_rows, SLICE_ROWS)):
        values, row = _flat(batch.column(2))
        bad = batch.column(1).to_numpy()[row] > 0
        names, cols = np.unique(values, return_inverse=True)
        n = np.bincount(cols, minlength=len(names))
        yield pa.RecordBatch.from_arrays([pa.array(names.view(np.int64)), pa.array(n.astype(np.int64)), pa.array(np.bincount(cols, weights=bad, minlength=len(names)).astype(np.int64))], names=["feature", "n", "bad"])


def _places(features: np.ndarray):
    """(id, grade, places): which of the features each text has. Batches: id, grade, bag."""
    def run(batches):
        for batch in (whole.slice(at, SLICE_ROWS) for whole in batches for at in range(0, whole.num_rows, SLICE_ROWS)):
            values, row = _flat(batch.column(2))
            place = np.minimum(np.searchsorted(features, values), len(features) - 1)
            hit = features[place] == values
            cuts = np.cumsum(np.bincount(row[hit], minlength=batch.num_rows))[:-1]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(np.split(place[hit], cuts), pa.list_(pa.int64()))], names=["id", "grade", "places"])
    return run


class CumulativeLink:
    """Shared weights and ordered thresholds, fitted by gradient steps with momentum, scaled by running squares, and projected where weights may not be negative."""

    def __init__(self, features: np.ndarray, weights: np.ndarray, thresholds: np.ndarray):
        self.features, self.weights, self.thresholds = features, weights, thresholds

    @classmethod
    def fit(cls, rows: np.ndarray, cols: np.ndarray, grades: np.ndarray, features: np.ndarray, steps: int = 400, rate: float = 0.15, l2: float = 1e-4, rising: bool = False) -> CumulativeLink:
        """rows, cols: the places of ones in a sparse matrix; grades from 0 for each row of it. ``rising``: no weight below 0."""
        n, top = len(grades), int(grades.max())
        share = np.clip([(grades >= k).mean() for k in range(1, top + 1)], 1e-6, 1 - 1e-6)
        w, theta = np.zeros(len(features)), np.log((1 - share) / share)
        state = [np.zeros(len(w) + top), np.zeros(len(w) + top)]
        for step in range(1, steps + 1):
            score = np.bincount(rows, weights=w[cols], minlength=n) if len(rows) else np.zeros(n)
            # c[:, k] = P(grade < k+1) for k in 0..top-1; the likelihood of a grade is a difference
            c = 1 / (1 + np.exp(np.clip(score[:, None] - theta[None, :], -40, 40)))
            edge = np.hstack([np.zeros((n, 1)), c, np.ones((n, 1))])
            slope = np.hstack([np.zeros((n, 1)), c * (1 - c), np.zeros((n, 1))])
            i = np.arange(n)
            p = np.maximum(edge[i, grades + 1] - edge[i, grades], 1e-12)
            up, down = slope[i, grades + 1] / p, slope[i, grades] / p
            by_score = (up - down) / n  # gradient of the negative log-likelihood
            g_w = np.bincount(cols, weights=by_score[rows], minlength=len(w)) + l2 * w if len(w) else np.zeros(0)
            g_t = np.array([(down[grades == k + 1].sum() - up[grades == k].sum()) / n for k in range(top)])
            g = np.concatenate([g_w, g_t])
            state[0] = 0.9 * state[0] + 0.1 * g
            state[1] = 0.99 * state[1] + 0.01 * g * g
            move = rate * (state[0] / (1 - 0.9**step)) / (np.sqrt(state[1] / (1 - 0.99**step)) + 1e-8)
            w = np.maximum(w - move[: len(w)], 0) if rising else w - move[: len(w)]
            theta = np.maximum.accumulate(theta - move[len(w) :] + np.arange(top) * 1e-9)
        order = np.argsort(features)
        return cls(features[order], w[order], theta)

    def at_least(self, values: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
        """P(grade >= k), k from 1, for n texts with these features."""
        score = np.zeros(n)
        if len(self.features):
            place = np.minimum(np.searchsorted(self.features, values), len(self.features) - 1)
            hit = self.features[place] == values
            score = np.bincount(owner[hit], weights=self.weights[place[hit]], minlength=n)
        return 1 / (1 + np.exp(-np.clip(score[:, None] - self.thresholds[None, :], -40, 40)))


def indicative(counts: DataFrame, rows: int, bad_rows: int, most: int = MAX_FEATURES) -> np.ndarray:
    """Of (feature, n, bad), the features whose share of bad rows is beyond chance, the most telling ones; ascending."""
    base = bad_rows / rows
    n, bad = F.col("n"), F.col("bad")
    z = (bad - n * base) / F.sqrt(n * (base * (1 - base)))
    lift = (bad + 0.5 * base) / (n + 0.5)
    good = counts.where((n >= MIN_ROWS) & (z >= 4) & (lift >= min(max(2.5 * base, MIN_SHARE), (1 + base) / 2)))
    got = good.orderBy(z.desc(), "feature").select("feature").limit(most).toArrow()
    return np.sort(got["feature"].to_numpy().view(np.uint64))


def marked(labels: DataFrame, label_col: str = "toxic", id_col: str = "doc_id") -> DataFrame:
    """(id, grade), one row per document, with the most severe of its labels."""
    return labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("grade")).where("id is not null and grade >= 0").groupBy("id").agg(F.max("grade").alias("grade"))


def graded(label: np.ndarray, rows: np.ndarray, cols: np.ndarray, features: np.ndarray) -> np.ndarray:
    """0 where the label is 0; of the others, 2 where a model of the other half of the rows gives more than the median, else 1."""
    half, score = np.arange(len(label)) % 2, np.zeros(len(label))
    for k in (0, 1):
        own = half == k
        if label[own].any() and not label[own].all():
            inside = own[rows]
            place = np.cumsum(own) - 1
            model = CumulativeLink.fit(place[rows[inside]], cols[inside], label[own], features, steps=150, rising=True)
            score[~own] = np.bincount(rows[~inside], weights=model.weights[cols[~inside]], minlength=len(label))[~own]
    return np.where(label > 0, 1 + (score > np.median(score[label > 0])), 0)


def fit(docs: DataFrame, labels: DataFrame, grade_col: str = "toxic", id_col: str = "doc_id", text_col: str = "text", grades: bool = False, sample_rows: int = SAMPLE_ROWS, max_features: int = MAX_FEATURES) -> CumulativeLink:
    """The model of a bounded sample of labelled rows. ``grades``: the labels are grades already.

    Features are counted and chosen by the executors; the driver gets at most ``max_features`` of them,
    and of each row of the sample which of these it has.
    """
    ship(docs.sparkSession)
    marks = marked(labels, grade_col, id_col)
    n = marks.count()
    if n > sample_rows:
        marks = marks.where(F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < int((1 << 30) * sample_rows / n))
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(marks), "id")  # ids of the bounded sample alone are broadcast
    sample = written(texts.select("id", "grade", "text").mapInArrow(_bags, "id bigint, grade int, bag binary"))
    rows, bad = sample.agg(F.count(F.lit(1)), F.count_if(F.col("grade") > 0)).first()
    none = CumulativeLink(np.zeros(0, np.uint64), np.zeros(0), np.array([np.inf]))
    if not bad or bad == rows:
        return none
    counts = sample.mapInArrow(_feature_counts, "feature bigint, n bigint, bad bigint").groupBy("feature").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    features = indicative(counts, rows, bad, max_features)
    if not len(features):
        return none
    got = sample.mapInArrow(_places(features), "id bigint, grade int, places array<bigint>").orderBy("id", "places").toArrow()
    places = [np.array(p, dtype=np.int64) for p in got["places"].to_pylist()]
    where, cols = np.repeat(np.arange(rows), [len(p) for p in places]), np.concatenate(places)
    grade = got["grade"].to_numpy().astype(np.int64)
    return CumulativeLink.fit(where, cols, grade if grades else graded(np.minimum(grade, 1), where, cols, features), features, rising=True)


def score(docs: DataFrame, model: CumulativeLink, id_col: str = "doc_id", text_col: str = "text", threshold: float = REJECT_AT) -> DataFrame:
    """One row per input row: id, severity (expected grade), p_any (that the grade is above 0), grade (most probable), rejected (p_any >= threshold)."""
    ship(docs.sparkSession)

    def run(batches):
        for batch in batches:
            for first, data, offsets in chunks(batch.column(1)):
                values, owner, n = bags(data, offsets)
                p = model.at_least(values, owner, len(n))
                exact = -np.diff(np.hstack([np.ones((len(n), 1)), p, np.zeros((len(n), 1))]), axis=1)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, len(n)), pa.array(p.sum(axis=1)), pa.array(p[:, 0]), pa.array(exact.argmax(axis=1).astype(np.int32)), pa.array(p[:, 0] >= threshold)],
                    names=["id", "severity", "p_any", "grade", "rejected"])

    texts = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    return texts.mapInArrow(run, "id bigint, severity double, p_any double, grade int, rejected boolean").withColumnRenamed("id", id_col)


def without_toxic(docs: DataFrame, model: CumulativeLink, text_col: str = "text", threshold: float = REJECT_AT) -> DataFrame:
    """The rows of docs, all columns, whose text isn't rejected: one pass without a shuffle."""
    ship(docs.sparkSession)
    place = docs.columns.index(text_col)

    def run(batches):
        for batch in batches:
            kept = [model.at_least(values, owner, len(n))[:, 0] < threshold for _, data, offsets in chunks(batch.column(place)) for values, owner, n in [bags(data, offsets)]]
            yield batch.filter(pa.array(np.concatenate(kept) if kept else np.zeros(0, bool)))

    return docs.mapInArrow(run, docs.schema)


def op3_ordinal_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = parquet(spark, sf_dir, "documents")
    return score(docs, fit(docs, parquet(spark, sf_dir, "labels")))
