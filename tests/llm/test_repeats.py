import hashlib
from collections import Counter

import numpy as np
import pyarrow.parquet as pq
import pytest

from siltstone.llm import repeated_spans
from siltstone.llm.repeated_spans import LENGTH, Grams, _least, anchored, op11_bucket_refinement, without_repeats

SCHEMA = "doc_id bigint, text string, kept string, start int, n_bytes int"


def plain(texts, length):
    """(n_bytes, spans, kept) of each text: every string of that many bytes is counted."""
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[i : i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        gone, upto = [], 0
        for i in range(len(d) - length + 1):
            if seen[d[i : i + length]] > 1:
                if gone and i <= gone[-1][1]:
                    gone[-1] = (gone[-1][0], i + length)
                else:
                    gone.append((i, i + length))
        kept, upto = b"", 0
        for a, b in gone:
            kept += d[upto:a]
            upto = b
        out.append((len(d), gone, kept + d[upto:]))
    return out


def rows_of(got):
    return Counter((r.doc_id, r.n_bytes, tuple((x.start, x.end) for x in r.spans), bytes(r.kept), r.kept_sha256) for r in got)


def held(rows, length):
    return Counter((i, n, tuple(spans), kept, hashlib.sha256(kept).hexdigest()) for (i, _), (n, spans, kept) in zip(rows, plain([t for _, t in rows], length), strict=True))


def made(seed, n=40):
    """Texts of few letters, with pieces of one another, edits, repetition and borders."""
    rng = np.random.default_rng(seed)
    texts = []
    for _ in range(n):
        parts = []
        for _ in range(rng.integers(0, 6)):
            kind = rng.random()
            if kind < 0.5 and texts:
                t = texts[rng.integers(len(texts))]
                a = rng.integers(0, len(t) + 1)
                parts.append(t[a : a + rng.integers(0, 90)])
            elif kind < 0.7:
                parts.append("ab"[rng.integers(2)] * rng.integers(0, 60))
            else:
                parts.append("".join("abcé "[x] for x in rng.integers(0, 5, rng.integers(0, 60))))
        texts.append("".join(parts))
    return texts


def test_least_windows():
    x = np.random.default_rng(0).integers(0, 99, 57).astype(np.uint64)
    for w in range(1, 57):
        assert _least(x, w).tolist() == [x[i : i + w].min() for i in range(57 - w + 1)]


def test_anchor_follows_from_the_string(monkeypatch):
    """Equal strings have their anchor at equal distance, in any text and at any edge of pieces."""
    monkeypatch.setattr(repeated_spans, "PIECE", 64)
    rng = np.random.default_rng(3)
    data = rng.integers(0, 2, 700).astype(np.uint8)
    data[500:640] = data[30:170]
    offsets = np.array([0, 0, 300, 310, 700])
    at, low, high = anchored(Grams(data, 11), offsets, 20)
    assert len(set(at.tolist())) == len(at)
    where = {p - d: d for p, a, b in zip(at.tolist(), low.tolist(), high.tolist(), strict=True) for d in range(a, b + 1)}
    starts = [i for a, b in zip(offsets[:-1], offsets[1:], strict=True) for i in range(a, b - 19)]
    assert sorted(where) == starts
    by = {}
    for i in starts:
        assert by.setdefault(data[i : i + 20].tobytes(), where[i]) == where[i]


@pytest.mark.parametrize("length", [4, 21, 40])
def test_made_texts_brute(spark, length):
    rows = list(enumerate(made(length)))
    got = without_repeats(spark.createDataFrame([(i, t, "x", 1, 2) for i, t in rows], SCHEMA).repartition(3), length).collect()
    assert rows_of(got) == held(rows, length)


def test_odd_rows(spark):
    passage = "The quick brown fox, née Zoë, jumps over the lazy dog again and again. " * 2 + "x" * 70
    rows = [(1, None), (2, ""), (3, "a" * 199), (4, "a" * 200), (5, "b" * 201), (6, passage), (7, "start " + passage), (8, passage[:150] + "!" + passage[150:]), (9, "é" * 100), (10, "y" + "é" * 100),
            (11, "same id, one text " * 12 + "z"), (11, "same id, other text"), (None, "no id " * 40), (None, "no id " * 40), (12, "twice " + "".join(map(chr, range(33, 126))) * 3), (12, "twice " + "".join(map(chr, range(33, 126))) * 3),
            (13, " ".join(str(x) for x in range(60_000))), (14, " ".join(str(x) for x in range(30_000, 30_100)))]
    got = without_repeats(spark.createDataFrame([(i, t, "x", 1, 2) for i, t in rows], SCHEMA).repartition(4)).collect()
    want = held(rows, LENGTH)
    assert rows_of(got) == want
    assert without_repeats(spark.createDataFrame([], SCHEMA)).count() == 0


def test_query_brute(spark):
    d = "/root/testdata/sf0.001"
    docs = pq.read_table(f"{d}/documents.parquet").to_pydict()
    got = op11_bucket_refinement(spark, d).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()
    want = [(i, n, sum(b - a for a, b in spans), len(spans), hashlib.sha256(kept).hexdigest()) for i, (n, spans, kept) in zip(docs["doc_id"], plain(docs["text"], LENGTH), strict=True)]
    assert sorted(map(tuple, got)) == sorted(want) and sum(r[3] > 0 for r in want) > 10
