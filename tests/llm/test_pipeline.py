import re
import zlib

import numpy as np
import pytest
from .test_near import brute
from tokenizers import Tokenizer

import corpus_pipeline
from siltstone.llm.mixing import mixed_documents
from siltstone.llm.packing import vocabulary

BAD = ["idiot", "moron", "scum", "trash"]


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("tables"))
    rng = np.random.default_rng(0)
    words = [f"w{i}" for i in range(400)]
    rows, labels = [], []
    for i in range(300):
        text = list(rng.choice(words, int(rng.integers(10, 80))))
        toxic = i % 5 == 0
        if toxic:
            for _ in range(3):
                text.insert(int(rng.integers(len(text))), str(rng.choice(BAD)))
        rows.append((i, " ".join(text), "en", f"s{i % 3}", 1))
        labels.append((i, 1, int(toxic)))
    rows += [(300 + i, re.sub(" ", " \n", rows[i][1]), "fr", "s9", None) for i in range(1, 40)]
    rows += [(400 + i, rows[i][1] + " end", "en", "s1", 5) for i in range(41, 80)]
    rows += [(900, None, None, None, None), (901, "", "en", "s1", 0), (902, "solo", "en", "s1", 1)]
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").repartition(3).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    spark.createDataFrame([(i, [1.0], i % 4) for i in range(200)], "vec_id bigint, embedding array<float>, label int").write.parquet(f"{d}/embeddings.parquet")
    return d, {r[0]: r for r in rows}


def test_stages_against_brute_force(spark, tables):
    d, rows = tables
    docs = spark.read.parquet(f"{d}/documents.parquet")
    stage = dict(corpus_pipeline.STAGES)
    columns = docs.columns

    def ids(df):
        assert df.columns == columns
        got = [r.doc_id for r in df.collect()]
        assert len(got) == len(set(got))
        return set(got)

    clean = stage["toxicity"](spark, docs, d)
    kept = ids(clean)
    bad = {i for i, r in rows.items() if set(BAD) & set((r[1] or "").split())}
    assert kept == set(rows) - bad
    once = stage["exact_dedup"](spark, clean, d)
    first = {}
    for i in sorted(kept):
        first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", rows[i][1] or ""), i)
    assert ids(once) == set(first.values())
    near = stage["near_dedup"](spark, once, d)
    want = {i for i, (_, c) in brute([(i, rows[i][1]) for i in first.values()], 5, 80).items() if c == i}
    assert ids(near) == want and len(want) < len(first)
    mixed = stage["mixing"](spark, near, d)
    drawn = {r.id for r in mixed_documents(spark, near, d).collect() if r.sampled}
    assert ids(mixed) == drawn and len(drawn) > len(want) / 2
    tok = Tokenizer.from_file(vocabulary())
    pieces = {}
    for r in stage["packing"](spark, mixed, d).collect():
        pieces.setdefault(r.doc_id, []).append(r)
    assert set(pieces) == drawn
    for i, got in pieces.items():
        have = [*tok.encode(rows[i][1] or "", add_special_tokens=False).ids, 0]
        for p in got:
            assert p.ids_crc32 == zlib.crc32(np.array(have[p.start : p.start + p.length], "<u4").tobytes()) and p.doc_tokens == len(have)
        assert sum(p.length for p in got) == len(have)
    whole = {r.doc_id for r in corpus_pipeline.run(spark, d).collect()}
    assert whole == drawn


def test_rows_that_repeat_an_id(spark, tables):
    """Rows of one id are decided by their texts, rows without an id too."""
    d, _ = tables
    stage = dict(corpus_pipeline.STAGES)
    long = " ".join(f"k{i}" for i in range(60))
    rows = [(3, "same text"), (5, "same text"), (5, "only here"), (7, long), (5, long + " more"), (None, "same  text"), (None, "without an id")]
    docs = spark.createDataFrame([(i, t, "en", "s1", 1) for i, t in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint").selectExpr("*", "1 as mark", "2 as word", "3 as place")
    got = stage["exact_dedup"](spark, docs, d)
    assert sorted(map(str, ((r.doc_id, r.text) for r in got.collect()))) == sorted(map(str, [(3, "same text"), *rows[2:5], rows[6]]))
    got = stage["near_dedup"](spark, docs, d)
    assert sorted(map(str, ((r.doc_id, r.text) for r in got.collect()))) == sorted(map(str, [(3, "same text"), (5, "only here"), (5, long + " more"), *rows[5:]]))
    assert got.columns == docs.columns
    drawn = stage["mixing"](spark, docs, d).collect()
    assert all(len({r.text for r in drawn if r.doc_id == i}) in (0, sum(i == j for j, _ in rows)) for i in (3, 5, 7))


def test_empty_table(spark, tables):
    d, _ = tables
    docs = spark.read.parquet(f"{d}/documents.parquet").limit(0)
    for _, f in corpus_pipeline.STAGES:
        got = f(spark, docs, d)
        assert got.count() == 0
        docs = docs if got.columns != docs.columns else got
