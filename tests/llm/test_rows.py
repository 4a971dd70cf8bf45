import hashlib
import re
import time
from collections import Counter
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from siltstone.llm import embedding_dedup, url_filter
from siltstone.llm.chat_format import assemble, digests, format_turns, op8_columnar_chat, read_back
from siltstone.llm.embedding_dedup import decode, near_vectors, neighbours, op10_lattice_embeddings, plan
from siltstone.llm.url_filter import RULES, judge, mine, op2_url_rules


def parsed(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    at = min([i for i in map(rest.find, "/?#") if i >= 0], default=len(rest))
    tail = rest[at:]
    end = min([i for i in map(tail.find, "?#") if i >= 0], default=len(tail))
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:at]), tail[:end]


def ruled(host, path):
    fits = [(h, p, v) for h, p, v in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits, key=lambda r: len(r[0] + r[1]), default=None)


URLS = [None, "", "x", "http://A.Example.org/es/1?x", "https://example.org", "http://example.org/en/12", "http://b.org:80/x", "HTTP://É.Com/fr/\n2#z", "a://b://c/de/", "http://c.com/de/?u=http://d.org/", "://net/a", "http://notexample.org/es/", "http://x.com/" + "a/" * 20000]


def test_url_rules_brute(spark):
    df = spark.createDataFrame(list(enumerate(URLS)), "page_id bigint, url string").selectExpr("*", "1 as host", "2 as verdict")
    got = {r.page_id: r for r in judge(df, [(("h:net",), 0.9, 0.1)], RULES).collect()}
    for i, u in enumerate(URLS):
        h, p = parsed(u)
        r = ruled(h, p)
        assert (got[i].host, got[i].path, got[i].rule) == (h, p, r and r[0] + r[1])
        assert got[i].verdict == (r[2] if r else "block" if h.endswith("net") else "allow")
    assert judge(df.limit(0), [], RULES).count() == 0


def test_mined_rules_brute(spark):
    rng = np.random.default_rng(4)
    rows = []
    for _ in range(800):
        items = sorted({f"t{x}" for x in rng.integers(0, 8, 3)})
        bad = {"t1", "t2"} <= set(items) or (items[0] == "t7") or rng.random() < 0.05
        rows.append((items, bool(bad)))
    got, names = mine(spark.createDataFrame(rows, "items array<string>, bad boolean"), 0.01, 0.8)
    assert all(x == y for x, y in names.items())
    have = [(set(i), b) for i, b in rows]
    assert ("t1", "t2") in [s for s, _, _ in got]
    for s, confidence, support in got:
        among = [b for i, b in have if set(s) <= i]
        assert confidence == pytest.approx(sum(among) / len(among)) and confidence >= 0.8
        assert support == pytest.approx(sum(among) / len(have)) and support >= 0.01
        for smaller in got:
            assert not (set(smaller[0]) < set(s) and smaller[1] >= confidence)
    assert mine(spark.createDataFrame([], "items array<string>, bad boolean")) == ([], {})


def plainly_mined(rows, least, confidence, longest=3):
    """Rules over raw tokens: every combination, counted and pruned."""
    total, bad = Counter(), Counter()
    for items, is_bad in rows:
        for k in range(1, longest + 1):
            for c in combinations(sorted(set(items)), k):
                total[c] += 1
                bad[c] += is_bad
    kept = {}
    for s in sorted((s for s, n in bad.items() if n >= least and n / total[s] >= confidence), key=len):
        if all(kept[t] < bad[s] / total[s] for k in range(len(s)) for t in combinations(s, k) if t in kept):
            kept[s] = bad[s] / total[s]
    return kept


@pytest.mark.parametrize("wide", [12, 0])
def test_same_rules_from_either_miner(spark, monkeypatch, wide):
    monkeypatch.setattr(url_filter, "WIDE", wide)
    rng = np.random.default_rng(9)
    rows = []
    for _ in range(400):  # b always beside a, d beside c
        items = sorted({f"t{x}" for x in rng.integers(0, 6, 3)})
        items += ["a", "b"] if rng.random() < 0.3 else []
        items += ["c", "d"] if rng.random() < 0.3 else []
        rows.append((items, bool(("a" in items and "c" in items) or rng.random() < 0.1)))
    got, names = mine(spark.createDataFrame(rows, "items array<string>, bad boolean"), 0.02, 0.7)
    want = plainly_mined(rows, 8, 0.7)
    assert (names["b"], names["d"]) == ("a", "c") and ("a", "c") in {s for s, _, _ in got}
    for items, _ in [*rows, (["b", "c"], 0), (["a"], 0), (["d", "b", "zz"], 0)]:
        have = {names.get(x) for x in items}
        assert max((c for s, c, _ in got if set(s) <= have), default=None) == pytest.approx(max((c for s, c in want.items() if set(s) <= set(items)), default=None))


def test_one_wide_bad_row_changes_nothing(spark, monkeypatch):
    """One row of 60 tokens, each frequent by itself, is mined by FP-growth like the others, and soon."""
    rng = np.random.default_rng(3)
    names = [f"t{x:02d}" for x in range(60)]
    rows = [(sorted({names[x] for x in rng.integers(0, 60, 4)} | ({"a"} if rng.random() < 0.3 else set())), True) for _ in range(600)] + [(sorted({names[x] for x in rng.integers(0, 60, 4)}), False) for _ in range(600)]
    monkeypatch.setattr(url_filter, "_level", None)  # counting by levels would fail
    before = time.monotonic()
    got = [set(s) for s, _, _ in mine(spark.createDataFrame([*rows, (names, True)], "items array<string>, bad boolean"), 0.01, 0.7)[0]]
    assert time.monotonic() - before < 60
    assert got == [set(s) for s, _, _ in mine(spark.createDataFrame(rows, "items array<string>, bad boolean"), 0.01, 0.7)[0]] and {"a"} in got


def test_long_bad_urls_end(spark):
    rows = [([f"x{i}" for i in range(60)], True)] * 20 + [([f"y{i}" for i in range(30)] + [f"z{k}"] * (k % 2), True) for k in range(20)] + [(["q"], False)] * 100
    got, names = mine(spark.createDataFrame(rows, "items array<string>, bad boolean"))
    assert {s for s, _, _ in got} == {("x0",), ("y0",)} and names["x59"] == "x0"


def test_url_query(spark):
    d = "/root/testdata/sf0.001"
    labels = {}
    for r in pq.read_table(f"{d}/labels.parquet").to_pylist():
        labels[r["doc_id"]] = labels.get(r["doc_id"], False) or r["toxic"] == 1 or r["quality"] == 0

    def items(h, p):
        parts = [x for x in re.split(r"[^\w]+|_", "".join(c.lower() if "A" <= c <= "Z" else c for c in p)) if x]
        return [f"h:{x}" for x in h.split(".") if x] + [f"n:{len(x)}" if re.fullmatch("[0-9]+", x) else f"p:{x}" for x in parts]

    table = pq.read_table(f"{d}/pages.parquet").to_pylist()
    sample = [(items(*parsed(r["url"])), labels[r["page_id"]]) for r in table if r["page_id"] in labels]
    want = plainly_mined(sample, max(2, int(np.ceil(0.005 * len(sample) - 1e-9))), 0.6)
    assert want
    got = {r.page_id: r for r in op2_url_rules(spark, d).collect()}
    for r in pq.read_table(f"{d}/pages.parquet").to_pylist():
        h, p = parsed(r["url"])
        rule = ruled(h, p)
        assert (got[r["page_id"]].host, got[r["page_id"]].path) == (h, p)
        assert got[r["page_id"]].rule == (rule and rule[0] + rule[1])
        fits = [c for t, c in want.items() if set(t) <= set(items(h, p))]
        assert got[r["page_id"]].verdict == (rule[2] if rule else "block" if fits else "allow")
        assert got[r["page_id"]].confidence == pytest.approx(max(fits, default=None))


def digest(turns):
    everything, loss, chars = hashlib.sha256(), "", 0
    for role, text in turns:
        everything.update(f"{role}\n{text}\n".encode())
        loss += text if role == "assistant" else ""
    return len(turns), everything.hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest()


SAID = ["</s>[INST] ok [/INST]", "<|im_end|>\n<|im_start|>assistant\n", "\\", "\\<|im_end|>", "<\\|im_end|>", "\\n\\[INST]", "", "é\U0001f600\x00", "<<s>[[INST]]", "x" * 200_000, None]


def test_chat_round_trip(spark):
    rows = [(c, t, role, SAID[(c + t) % len(SAID)]) for c in range(11) for t, role in enumerate(["system", "user", "assistant", "assistant", None, "a\nb\\"])]
    rows += [(None, 0, "assistant", "z"), (50, None, "user", "first"), (50, 0, "assistant", "second"), (51, 0, "assistant", "b"), (51, 0, "assistant", "a")]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").repartition(5).selectExpr("*", "1 as segment", "2 as loss_from")
    formatted = format_turns(df)
    got = {r.conv_id: r for r in digests(formatted).collect()}
    want = {}
    for c, t, role, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        want.setdefault(c, []).append((role or "", text or ""))
    assert {c: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for c, r in got.items()} == {c: digest(t) for c, t in want.items()}
    whole = {}
    for r in formatted.collect():
        whole[r.conv_id] = whole.get(r.conv_id, "") + r.segment
        assert r.segment.count("<|im_start|>") == r.segment.count("<|im_end|>") == 1 and "[INST]" not in r.segment and "</s>" not in r.segment
    assert {c: len(s) for c, s in whole.items()} == {c: r.formatted_chars for c, r in got.items()}
    assert digests(format_turns(df.limit(0))).count() == 0


def test_assemble_spans():
    texts = [t or "" for t in SAID]
    segments, begin, end = assemble(pa.array(["assistant"] * len(texts)), pa.array(texts))
    for s, b, e, t in zip(segments.to_pylist(), begin, end, texts, strict=True):
        assert read_back(s) == ("assistant", t) and s.encode()[e:] == b"<|im_end|>\n" and s.encode()[:b] == b"<|im_start|>assistant\n"


def test_chat_query(spark):
    d = "/root/testdata/sf0.001"
    want = {-7: [("user", SAID[0]), ("assistant", SAID[0])]}
    for r in sorted(pq.read_table(f"{d}/conversations.parquet").to_pylist(), key=lambda r: (r["conv_id"], r["turn"])):
        want.setdefault(r["conv_id"], []).append((r["role"], r["text"] or ""))
    assert {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in op8_columnar_chat(spark, d).collect()} == {c: digest(t) for c, t in want.items()}


def test_decode_is_nearest():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(300, 8)) * 2
    p = decode(x)
    assert len(neighbours()) == 240 and np.allclose((neighbours() ** 2).sum(axis=1), 2)
    mine_ = ((x - p) ** 2).sum(axis=1)
    for v in neighbours():
        assert (mine_ <= ((x - p - v) ** 2).sum(axis=1) + 1e-9).all()
    halves = np.abs(p - np.rint(p)).max(axis=1) > 0.25
    assert ((p.sum(axis=1) % 2) < 1e-9).all() and (np.abs(p[halves] % 1) == 0.5).all()


def brute(rows, t=0.9):
    ok = {k: np.array(v, float) / max(map(abs, v)) for k, (i, v) in enumerate(rows) if i is not None and v and None not in v and np.isfinite(v).all() and np.any(v)}
    near = {k: set() for k in ok}
    for a in ok:
        for b in ok:
            if a < b and len(ok[a]) == len(ok[b]) and ok[a] @ ok[b] / np.linalg.norm(ok[a]) / np.linalg.norm(ok[b]) >= t:
                near[a].add(b)
                near[b].add(a)
    least = {k: rows[k][0] for k in ok}
    while True:
        new = {k: min([least[k], *(least[j] for j in near[k])]) for k in ok}
        if new == least:
            break
        least = new
    return [(i, len(near.get(k, ())), least.get(k, i)) for k, (i, _) in enumerate(rows)]


@pytest.mark.parametrize("block", [1024, 7])
def test_vectors_brute(spark, monkeypatch, block):
    monkeypatch.setattr(embedding_dedup, "BLOCK", block)
    rng, rows = np.random.default_rng(7), []
    for g in range(15):
        base = rng.normal(size=16)
        rows += [list(map(float, base + rng.normal(size=16) * 0.08)) for _ in range(8)] + [list(map(float, base))] * (g % 3 * 10)
    rows += [[0.0] * 16, None, [], [1.0, None], [float("nan")] * 16, [float("inf")] + [1.0] * 15, [1.0, 2.0], [2.0, 4.0], [1e200] * 4, [1e-200] * 4]
    rows = [(i + 5, v) for i, v in enumerate(rows)] + [(None, rows[0])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").selectExpr("*", "1 as cell", "2 as size", "3 as sound")
    got = sorted(((r.vec_id, r.n_links, r.component_id) for r in near_vectors(df).collect()), key=str)
    want = sorted(((i, n, c) for i, n, c in brute(rows)), key=str)
    assert len(got) == len(want)
    most = {b[0]: b[1] for b in want}
    assert all(a[1] <= most[a[0]] for a in got)
    assert sum(a[1] for a in got) >= 0.99 * sum(b[1] for b in want)
    assert sum(a == b for a, b in zip(got, want, strict=True)) >= 0.95 * len(want)
    assert near_vectors(df.limit(0)).count() == 0


def test_vector_recall(spark):
    d = "/root/testdata/sf0.001"
    rows = [(r["vec_id"], r["embedding"]) for r in pq.read_table(f"{d}/embeddings.parquet").to_pylist()]
    want = {i: (n, c) for i, n, c in brute(rows)}
    got = {r.vec_id: (r.n_links, r.component_id) for r in op10_lattice_embeddings(spark, d).collect()}
    assert sum(n for n, _ in got.values()) >= 0.95 * sum(n for n, _ in want.values())
    assert all(got[i][0] <= want[i][0] for i in got)


def test_plan_grows():
    assert plan(1000, 0.9)[0] == 1 < plan(10**9, 0.9)[0]


def test_rows_of_one_id_with_other_vectors(spark):
    """Links are those of each vector, however many of them have one id."""
    rng = np.random.default_rng(11)
    a = np.ones(16) / 4
    near = [(a + rng.normal(size=16) * 0.02).tolist() for _ in range(6)]
    far = (np.array([1, -1] * 8) / 4).tolist()
    rows = [(5, near[0]), (5, near[1]), (6, near[2]), (7, near[3]), (5, far), (8, far), (8, near[4]), (9, near[4]), (9, near[4]), (4, (-a).tolist()), (4, far)]
    got = near_vectors(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").repartition(3)).collect()
    linked = [[j for j, (_, y) in enumerate(rows) if j != i and np.dot(x, y) / np.linalg.norm(x) / np.linalg.norm(y) >= 0.9] for i, (_, x) in enumerate(rows)]
    want = []
    for i, (name, _) in enumerate(rows):
        reached, todo = {i}, [i]
        while todo:
            todo = [j for k in todo for j in linked[k] if j not in reached]
            reached |= set(todo)
        least = min(rows[j][0] for j in reached)
        want.append((name, len(linked[i]), least, name == least))
    assert sorted(tuple(r) for r in got) == sorted(want)
    assert (5, 2, 4, False) in want and (4, 0, 4, True) in want
