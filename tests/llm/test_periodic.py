import hashlib
import re
import zlib
from fractions import Fraction

import numpy as np
import pyarrow.parquet as pq
import pytest

from siltstone.llm.periodic_runs import find_runs, op13_periodic_runs, runs_of

SCHEMA = "doc_id bigint, text string, runs string, n_words string, id int"
WORD = r"[^\x20\x09-\x0D]+"


def plain_runs(w, least=24, times=3):
    """(start, length, period) of every run, period by period."""
    n, out = len(w), []
    for p in range(1, n // times + 1):
        i = 0
        while i + p < n:
            if w[i] != w[i + p]:
                i += 1
                continue
            s = i
            while i + p < n and w[i] == w[i + p]:
                i += 1
            e = i + p
            if e - s >= max(least, times * p) and not any(w[s : e - q] == w[s + q : e] for q in range(1, p)):
                out.append((s, e - s, p))
    return sorted(out, key=lambda r: (r[0], r[2]))


def plain_row(doc_id, text):
    """A row of the query, from its contract."""
    w = re.findall(WORD, text or "")
    h = zlib.crc32(str(doc_id).encode())
    if h % 10 == 0 and w:
        g, n = h // 10, len(w)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(w)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (doc_id, len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
            sha("".join(f"{s},{length},{q}\n" for s, length, q in runs)), sha(" ".join(x for i, x in enumerate(w) if i not in gone)))


@pytest.mark.parametrize("seed", range(8))
def test_runs_of_brute(seed):
    rng = np.random.default_rng(seed)
    for _ in range(150):
        texts = []
        for _ in range(rng.integers(1, 5)):
            n = rng.integers(0, 40)
            d = rng.integers(0, rng.integers(1, 4), n)
            texts.append(d[np.arange(n) % rng.integers(1, n)] if rng.random() < 0.5 and n > 3 else d)
        least, times = int(rng.integers(2, 8)), int(rng.integers(2, 4))
        got = runs_of(np.concatenate(texts).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15), np.repeat(np.arange(len(texts)), [len(d) for d in texts]), len(texts), least, times)
        want, at = [], 0
        for d in texts:
            want += [(at + s, at + s + length, q) for s, length, q in plain_runs(d.tolist(), least, times)]
            at += len(d)
        assert list(zip(*(x.tolist() for x in got), strict=True)) == want


TEXTS = [None, "", " \t\n ", "a", "a " * 23, "a " * 24, "x " + "é b c d " * 12 + "é z", "a b\x0bc\x0c" * 8, "ab " * 40_000 + "cd", "q " * 30 + "r " + "q " * 30,
         " ".join(f"w{i}" for i in range(5000)) * 3, "one two three four five six seven eight " * 3]


def test_find_runs_rows(spark):
    rows = [(i, t, "x", "y", 1) for i, t in enumerate(TEXTS)] + [(None, TEXTS[5], None, None, None), (5, TEXTS[5], "x", "y", 1)]
    got = find_runs(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == len(rows)
    for r in got:
        text = TEXTS[5 if r.doc_id is None else r.doc_id]
        w = re.findall(WORD, text or "")
        assert r.n_words == len(w)
        if len(w) < 6000:
            assert [tuple(x) for x in r.runs] == plain_runs(w)
    long = next(r for r in got if r.doc_id == 8)
    assert [tuple(x) for x in long.runs] == [(0, 40_000, 1)] and long.collapsed == "ab cd"
    ten = next(r for r in got if r.doc_id == 10)
    assert len(ten.runs) == 0 and ten.n_words == 14_998
    assert find_runs(spark.createDataFrame([], SCHEMA)).count() == 0


def test_query_brute(spark):
    d = "/root/testdata/sf0.001"
    docs = pq.read_table(f"{d}/documents.parquet").to_pydict()
    got = op13_periodic_runs(spark, d).select("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256").collect()
    want = sorted(plain_row(i, t) for i, t in zip(docs["doc_id"], docs["text"], strict=True) if len(t or "") < 8000)
    have = {r[0]: tuple(r) for r in got}
    assert len(got) == len(docs["doc_id"]) and want == [have[r[0]] for r in want]
    assert sum(r[1] > 0 for r in want) > 10
