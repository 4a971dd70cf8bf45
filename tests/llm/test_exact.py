import hashlib
import re
import zlib
from fractions import Fraction

import duckdb
import numpy as np
import pytest
from tokenizers import Tokenizer

from siltstone.llm.exact_dedup import OP9_SQL, exact_dedup, op9_exact_dedup
from siltstone.llm.packing import Schedule, encoder, op1_mixture_packing, pack, unpacked, vocabulary, whole_weights
from siltstone.llm.sharding import shard

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
LONG = "lorem  ipsum\t" * 30_000


def docs(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, None) for i, t, s in rows], SCHEMA)


ROWS = [(1, "a b", "x"), (2, "a \t\n b", "x"), (3, None, None), (4, "", "y"), (5, " ", "y"), (6, LONG, "x"), (7, LONG, None), (8, "é a", "z"), (8, "é a", "z"), (None, "a b", "z"), (9, "A b", "z")]


@pytest.mark.parametrize("hash_all", [True, False])
def test_exact_dedup_brute(spark, hash_all):
    got = exact_dedup(docs(spark, ROWS).withColumnRenamed("lang", "keep_id").withColumnRenamed("n_chars", "full"), hash_all=hash_all).collect()
    norm = [(i, re.sub("[\x20\x09-\x0d]+", " ", t or "")) for i, t, _ in ROWS]
    want = []
    for i, t in norm:
        same = [j for j, u in norm if u == t]
        keep = min([j for j in same if j is not None], default=None)
        want.append((i, keep, len(same), i == keep))
    assert sorted(map(str, want)) == sorted(str((r.doc_id, r.keep_id, r.group_size, r.kept)) for r in got)
    if hash_all:
        assert {hashlib.sha256(t.encode()).hexdigest() for _, t in norm} == {r.text_sha256 for r in got}


def test_exact_dedup_sql(spark):
    d = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{d}/documents.parquet'")
    got = sorted(map(tuple, op9_exact_dedup(spark, d).select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()))
    assert got == sorted(con.execute(f"select doc_id, keep_id, group_size, kept, text_sha256 from ({OP9_SQL})").fetchall())


def jump(key, n):
    key, b, j = key % 2**64, -1, 0
    while j < n:
        b, key = j, (key * 2862933555777941757 + 1) % 2**64
        j = int((b + 1) * (2.0**31 / ((key >> 33) + 1)))
    return b


@pytest.mark.parametrize("n", [1, 2, 8, 200])
def test_jump_hash(spark, n):
    rows = [(i, "x", "s") for i in (0, 1, 2, -5, 2**62, -(2**63), 2**63 - 1, *range(100, 400, 7))]
    for r in shard(docs(spark, rows), n).collect():
        assert (r.shard, r.grown_shard) == (jump(r.doc_id, n), jump(r.doc_id, n + 1))
        assert r.grown_shard in (r.shard, n)


def test_shard_slots(spark):
    got = shard(docs(spark, ROWS).repartition(3).withColumnRenamed("lang", "slot"), 3).collect()
    assert len(got) == len(ROWS)
    for s in range(3):
        slots = sorted(r.slot for r in got if r.shard == s)
        assert slots == list(range(len(slots)))
    assert {(r.doc_id, r.size, r.text_crc32) for r in got} == {(i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, _ in ROWS}
    assert shard(docs(spark, []), 3).count() == 0


def drained(tokens, weights, quantum):
    """Deficit round-robin, turn by turn: the queue whose next turn is due first, of equals the one with more turns."""
    left, done, at, out = list(tokens), [0] * len(tokens), 0, {}
    while any(left):
        s = min((x for x in range(len(left)) if left[x]), key=lambda x: (Fraction(2 * done[x] + 1, weights[x]), tokens[x] // -quantum, x))
        done[s] += 1
        out[s, done[s]] = at
        at += min(quantum, left[s])
        left[s] -= min(quantum, left[s])
    return out


@pytest.mark.parametrize("tokens, weights", [([1000, 37, 512, 0, 5], [5, 1, 2, 9, 1]), ([64, 64, 64], [1, 1, 1]), ([300], [7]), ([5000, 5000], [3, 1]), ([7 * (i % 11) for i in range(600)], [1 + i % 5 for i in range(600)])])
def test_schedule(tokens, weights):
    s = Schedule(tokens, weights, 16)
    want = drained(tokens, weights, 16)
    queues, turns = (np.array(x) for x in zip(*want, strict=True))
    assert s.position(queues, turns).tolist() == list(want.values())


def test_many_sources(spark):
    """600 sources and a large one are 601 queues, served turn by turn."""
    rows = [(i, "one two three four five six seven eight " * (1 + i % 25), "big" if i % 3 == 0 else f"s{i}") for i in range(900)]
    weights = {"big": 0.5, **{f"s{i}": 1 / (1200 + i % 7) for i in range(900) if i % 3}}
    got = pack(docs(spark, rows), vocabulary(), weights).collect()
    begin, n = {r.doc_id: r.sequence_id * 1024 + r.offset for r in got if r.start == 0}, {r.doc_id: r.doc_tokens for r in got}
    names = sorted(weights, key=lambda x: f"s:{x}")
    tokens = [sum(n[i] for i, _, s in rows if s == x) for x in names]
    want = drained(tokens, whole_weights([weights[x] for x in names]), 256)
    for q, x in enumerate(names):
        if x != "big":
            assert begin[int(x[1:])] == want[q, 1]
    assert sum(r.length for r in got) == sum(n.values())


def test_packing_round_trip(spark):
    tok = Tokenizer.from_file(vocabulary())
    rows = [*ROWS[:9], *[(100 + i, "word " * (i % 50) + str(i), f"s{i % 4}") for i in range(200)]]
    for weights in (None, {"s1": 0.5, None: 0.1, "x": 0.01}):
        got = pack(docs(spark, rows).repartition(4).withColumnRenamed("lang", "ids"), vocabulary(), weights).collect()
        by_doc, by_seq = {}, {}
        for r in got:
            by_doc.setdefault(r.doc_id, []).append(r)
            by_seq.setdefault(r.sequence_id, []).append(r)
        for i, text in {i: t for i, t, _ in rows}.items():
            want = [*tok.encode(text or "", add_special_tokens=False).ids, 0]
            pieces = sorted(by_doc[i], key=lambda r: r.start)
            if i != 8:  # the repeated row
                have = np.concatenate([np.frombuffer(p.ids, "<u4") for p in pieces]).tolist()
                assert have == want and [p.start for p in pieces] == np.cumsum([0, *[p.length for p in pieces[:-1]]]).tolist()
        assert sorted(by_seq) == list(range(len(by_seq)))
        for seq, pieces in by_seq.items():
            at = 0
            for p in sorted(pieces, key=lambda r: r.offset):
                assert p.offset == at
                at += p.length
            assert at == 1024 or seq == max(by_seq)
    assert pack(docs(spark, []), vocabulary()).count() == 0


def test_packing_query(spark):
    """Every document of a table, read back from the query's pieces."""
    d, tok = "/root/testdata/sf0.001", Tokenizer.from_file(vocabulary())
    by_doc, by_seq = {}, {}
    for r in op1_mixture_packing(spark, d).collect():
        by_doc.setdefault(r.doc_id, []).append(r)
        by_seq.setdefault(r.sequence_id, []).append(r)
    table = duckdb.sql(f"select doc_id, text from '{d}/documents.parquet'").fetchall()
    assert set(by_doc) == {i for i, _ in table}
    for i, text in table:
        want, at = np.array([*tok.encode(text or "", add_special_tokens=False).ids, 0], "<u4"), 0
        for p in sorted(by_doc[i], key=lambda r: r.start):
            assert (p.start, p.doc_tokens, p.ids_crc32) == (at, len(want), zlib.crc32(want[at : at + p.length].tobytes()))
            at += p.length
        assert at == len(want)
    for seq, pieces in by_seq.items():
        ends = np.cumsum([0, *[p.length for p in sorted(pieces, key=lambda r: r.offset)]])
        assert sorted(p.offset for p in pieces) == ends[:-1].tolist() and (ends[-1] == 1024 or seq == max(by_seq))


def test_windows_keep_proportions(spark):
    rows = [(i, "one two three four five six " * 40, "big" if i % 4 else "small") for i in range(400)]
    got = pack(docs(spark, rows), vocabulary(), {"big": 0.5, "small": 0.5}).collect()
    small = {i for i, _, s in rows if s == "small"}
    seqs = {}
    for r in got:
        seqs.setdefault(r.sequence_id, [0, 0])[r.doc_id in small] += r.length
    both = [x for k, x in sorted(seqs.items())][: int(len(seqs) * 0.45)]
    assert all(abs(a - b) <= 512 for a, b in both)


def test_ids_are_those_of_the_file():
    tok, fast = Tokenizer.from_file(vocabulary()), encoder(vocabulary())
    for t in ("Hello  world\n\n 12é", "it's x ﬁ \U0001f600", "", "a" * 3000, "%%% ### &&&", "a<|endoftext|>b <|endoftext|>", "<|endoftext|"):
        assert list(fast(t)) == tok.encode(t, add_special_tokens=False).ids
    big = np.array([1, 70000], dtype="<u4")
    assert unpacked(b"\xff" + big.tobytes()).tolist() == [1, 70000]
    assert whole_weights([1, 0]) == [1 << 20, 1]
