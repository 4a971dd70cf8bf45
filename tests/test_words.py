import random
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from siltstone.functions import text as T
from siltstone.functions import words
from siltstone.operators import fidelity

ODD = ["Eﬃcient hy-\n phen café ①2", "a-\nb-\nc", "a- \n\n b -\nc x-\n y", "İx-\nKK ²-\nq", "é-\ne ः-\nz !-\na-\nb", "q- \nw 1-\n2", "-\na", "a-\n", "", "   ", "A1 b2 33 4 x", "日本-\n語 a‍-\nb", "a-\x1c\nb c-\x0b\x0c\nd", "x" * 70000]


def test_tokens_are_those_of_the_jvm(spark):
    rng = random.Random(5)
    made = ["".join(rng.choice("aB1-\n ü ﬁ½́.") for _ in range(rng.randrange(60))) for _ in range(300)]
    for normalise in (True, False):
        df = spark.createDataFrame([(x,) for x in ODD + made], "t string")
        all_ = T.tokens(T.normal_form("t") if normalise else F.col("t"))
        want = [tuple(r) for r in df.select(all_.alias("a"), T.with_letter(all_), T.numerals(all_)).collect()]
        got = words.Tokens([x.encode() for x in ODD + made], normalise)
        said = got.words.to_pylist()
        for i, (a, letters, numerals) in enumerate(want):
            here = np.flatnonzero(got.row == i)
            assert [said[k] for k in here] == a and [said[k] for k in here if got.letter[k]] == letters
            assert list(dict.fromkeys(said[k] for k in here if got.numeral[k])) == numerals


def test_shingles_by_sets_even_where_hashes_meet(monkeypatch):
    rng = random.Random(7)
    texts = [[" ".join(rng.choice(["a", "b", "c1", "22"]) for _ in range(rng.randrange(40))).encode() for _ in range(60)] for _ in range(2)]
    texts[0][3] = texts[1][5] = None
    monkeypatch.setattr(words, "hashed", lambda columns: columns[1].astype(np.uint64) % np.uint64(3))
    s = words.Shingled(*texts, 3)
    sh = [[[tuple(w[i : i + 3]) for i in range(len(w) - 2)] for w in [[x for x in (t or b"").decode().split() if not x.isdigit()] for t in side]] for side in texts]
    assert s.per_pair(s.in_source).tolist() == [len(set(x)) for x in sh[0]] and s.per_pair(s.in_target).tolist() == [len(set(x)) for x in sh[1]]
    assert s.per_pair(s.in_source & s.in_target).tolist() == [len(set(x) & set(y)) for x, y in zip(*sh, strict=True)]
    assert list(zip(*(x.tolist() for x in s.lacking()), strict=True)) == [(i, j) for i, (x, y) in enumerate(zip(*sh, strict=True)) for j, z in enumerate(x) if z not in set(y)]


def test_null_texts(spark):
    rows = [("s", None, "a b"), ("t", "a b c d e 10", None), ("both", None, None), ("none", "", "")]
    got = {r.pair_id: r for r in fidelity.metrics(spark.createDataFrame(rows, "pair_id string, source_text string, target_text string")).collect()}
    pick = lambda k: tuple(got[k][c] for c in ("source_tokens", "target_tokens", *fidelity.METRICS))
    assert pick("s") == (None, 2, 0.0, 0.0, 0.0, 1.0) and pick("t") == (5, None, None, 0.0, None, None) and pick("both") == (None, None, 0.0, 0.0, 0.0, 1.0) and pick("none") == (0, 0, 0.0, 0.0, 0.0, 1.0)
    assert fidelity.missing_runs(spark.createDataFrame(rows, "pair_id string, source_text string, target_text string")).count() == 0


def test_one_plain_pass_over_texts(spark):
    """No sets of words in rows: lists of words cost the JVM ten times what it takes to count them from bytes."""
    df = spark.createDataFrame([("p", "a", "b", 1, 1, 0.0)], "pair_id string, source_text string, target_text string, ref_target int, ref_source int, floor double")
    for made in (fidelity.evaluate(df), fidelity.missing_runs(df)):
        plan = made._jdf.queryExecution().executedPlan().toString()
        assert len(re.findall("MapInArrow|ArrowEvalPython", plan)) == 1 and "array_distinct" not in plan and "split" not in plan
    assert "Python" not in fidelity.evaluate(df).select("pair_id", "ref_source")._jdf.queryExecution().executedPlan().toString()


def test_missing_runs_by_hand(spark):
    rng = random.Random(3)
    rows = [(i, *[" ".join(rng.choice(["Aa", "b", "c9", "77", "é"]) for _ in range(rng.randrange(200))) for _ in range(2)]) for i in range(40)]
    got = sorted(tuple(r) for r in fidelity.missing_runs(spark.createDataFrame(rows, "pair_id bigint, source_text string, target_text string")).collect())
    want = []
    for i, *texts in rows:
        source, target = ([x for x in t.lower().replace("é", " ").split() if not x.isdigit()] for t in texts)
        have = {tuple(target[k : k + 5]) for k in range(len(target) - 4)}
        runs: list[list[int]] = []
        for k in range(len(source) - 4):
            if tuple(source[k : k + 5]) not in have:
                if runs and runs[-1][0] + runs[-1][1] == k:
                    runs[-1][1] += 1
                else:
                    runs.append([k, 1])
        want += [(i, size, at, " ".join(source[at : at + 24])[:160]) for at, size in sorted(runs, key=lambda r: (-r[1], r[0]))[:5] if size >= 5]
    assert got == sorted(want) and len(want) > 40


def test_packed_columns_tell_the_same_rows_apart(monkeypatch):
    """shingles are sorted and compared by as few numbers as hold their tokens, not by one for each token."""
    rng = np.random.default_rng(2)
    columns = [rng.integers(0, top, 400) for top in (5, 3, 1, 1 << 40, 2, 1 << 30, 4)]
    for bits in (63, 41, 8, 3):
        monkeypatch.setattr(words, "WORD_BITS", bits)
        got = words.packed([c % 3 for c in columns] if bits < 41 else columns)
        want = list(zip(*[(c % 3 if bits < 41 else c).tolist() for c in columns], strict=True))
        assert len(set(zip(*[c.tolist() for c in got], strict=True))) == len(set(want)) == len(set(zip(want, zip(*[c.tolist() for c in got], strict=True), strict=True)))
    asked = []
    monkeypatch.setattr(words, "WORD_BITS", 63)
    monkeypatch.setattr(words, "hashed", lambda columns, f=words.hashed: asked.append(len(columns)) or f(columns))
    texts = [" ".join("w" * (1 + k % 7) + "xyz"[k % 3] * (k % 11) for k in range(i, i + 90)).encode() for i in range(300)]
    s = words.Shingled(texts, texts[1:] + [None], 9)
    assert all(k <= 2 for k in asked) and len(s.lacking()[0]) and asked


def test_packed_shingles_whose_hashes_meet(monkeypatch):
    rng = random.Random(11)
    texts = [[" ".join(rng.choice(["a", "b", "c1", "22"]) for _ in range(rng.randrange(40))).encode() for _ in range(60)] for _ in range(2)]
    want = [x.tolist() for x in words.Shingled(*texts, 3).lacking()]
    monkeypatch.setattr(words, "WORD_BITS", 7)
    monkeypatch.setattr(words, "hashed", lambda columns: columns[0].astype(np.uint64) % np.uint64(3))
    assert [x.tolist() for x in words.Shingled(*texts, 3).lacking()] == want and want[0]


def test_runs_are_said_in_one_step(monkeypatch):
    """one call for all the runs of a part of a batch, not one for each run."""
    calls, said = [], words.Shingled.said
    monkeypatch.setattr(words.Shingled, "said", lambda self, *a: calls.append(1) or said(self, *a))
    texts = [[f"{'long' * 30}{i} b é c9 77 d{k} e f " * 4 for i in range(50)] for k in (0, 1)]
    batch = pa.RecordBatch.from_arrays([pa.array([*texts[0], None, "", "a b c d e f g h i"]), pa.array([*texts[1], "a", "b", None]), pa.array(range(53))], names=["source_text", "target_text", "pair_id"])
    got = pa.Table.from_batches(fidelity._runs(5, 5, True)([batch])).to_pylist()
    assert len(calls) == 1 and {r["pair_id"] for r in got} == {*range(50), 52}
    assert got[-1] == {"pair_id": 52, "shingles": 5, "at_token": 0, "snippet": "a b c d e f g h i"}
    for r in got[:-1]:
        first = " ".join([x for x in texts[0][r["pair_id"]].replace("é", " ").split() if not x.isdigit()][r["at_token"] : r["at_token"] + 24])
        assert r["snippet"] == first[:160] and len(first) > 160


def test_cut_of_documents_word_by_word(spark, tmp_path):
    """also where ids pass 32 bits, are below 0 or null, and where texts have empty or no words."""
    from siltstone import queries

    rng = random.Random(13)
    made = [" ".join(rng.choice(["a", "bé", "", "\n", "日本", "$1\\"]) for _ in range(rng.randrange(200))) for _ in range(120)]
    made += ["", " ", "x" * 70000, " ".join("w" * (k % 3) for k in range(20000)), None, "  a  ", "\n"]
    ids = [*range(121), *range(-45, 0), *range((1 << 31) - 3, (1 << 31) + 42), None]
    rows = [(i, made[(k * 7 + j) % len(made)]) for k, i in enumerate(ids) for j in range(3)]
    rows += [(i, t) for i in (5, 6, 7, 33, 34, 35, 39) for t in made[-7:]]
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted((tuple(r) for r in queries._pairs(spark, str(tmp_path)).select("pair_id", "source_text", "target_text").collect()), key=str)

    def cut(i, t):
        if t is None or i is None:
            return None if t is None else ""
        left = lambda x, m: x % m if x >= 0 else -(-x % m)
        return " ".join(w for k, w in enumerate(t.split(" ")) if left(k + i, 40) < {0: 40, 1: 34, 2: 24}.get(left(i, 4), 10))

    assert got == sorted(((i, t, cut(i, t)) for i, t in rows), key=str)


def test_little_is_done_to_most_texts(monkeypatch):
    """small parts, and no text made anew that only has letters beyond ASCII."""
    plain = "Çé Übung A1 日本 x- y".encode()
    assert words.folded(plain, False) is plain and words.folded("É Ü İK a".encode(), False) == "É Ü İK a".lower().encode()
    for c in map(chr, range(128, 0x110000)):
        assert c in words.TO_ASCII or not any(x.isascii() for x in c.lower())
    seen, made = [], words.Shingled
    monkeypatch.setattr(fidelity, "Shingled", lambda s, t, *a: seen.append((len(s), sum(map(len, s + t)))) or made(s, t, *a))
    texts = pa.array([f"{k} few words " * (k % 90) for k in range(1500)])
    out = pa.Table.from_batches(fidelity._runs(5, 5, True)([pa.RecordBatch.from_arrays([texts, texts, pa.array(range(1500))], names=["s", "t", "pair_id"])]))
    assert out.num_rows == 0 and len(seen) > 8 and max(size for n, size in seen if n > 1) <= 1 << 17 and sum(n for n, _ in seen) == 1500
