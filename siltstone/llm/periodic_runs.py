"""Periodic runs of words, by the runs theorem.

A run is a maximal stretch of words with a smallest period p that holds at least two periods. Each run has a
root that is the longest Lyndon word starting at its place, under an order of the words or under its
reverse. So of a text of n words there are 2n candidates, and all runs are among them:

1. Words are hashed, and suffixes of all texts of a chunk are ranked at once by prefix doubling, apart for each text.
   Only suffixes that aren't told apart yet are sorted again. This is done under an order of the hashes and under its reverse.
2. The longest Lyndon word at i ends before the next smaller value of the inverse suffix array, which is
   found by galloping over minima of 1, 2, 4, ... values.
3. A root from i to j is extended to the right by the common prefix of i and j, and to the left by the common suffix of what
   is before them: minima, by a sparse table, of the LCP array of the text and of that of the text in reverse.

A text is one row and is worked on in one task, in memory in proportion to its words; chunks of texts have about CHUNK bytes.
Nothing is shuffled, so no group can be hot.

Defined cases: a null text has no words; a text without a run gives an empty list, and its words joined by one space; repeated
rows give a row each; a null id is a name like any other; an empty table gives no rows; other columns are not touched.
Words whose 64-bit hashes are equal count as equal.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bytewords import SPACE, chunks, hashed, spans
from .common import parquet, ship

#: A run has LEAST words and TIMES periods at least.
LEAST, TIMES = 24, 3


class Minima:
    """Minima of 2**k values from each place on: for ranges, and to look for the next smaller value."""

    def __init__(self, values: np.ndarray):
        self.rows = [values]
        while 1 << len(self.rows) <= len(values):
            last, step = self.rows[-1], 1 << len(self.rows) - 1
            row = last.copy()
            np.minimum(last[:-step], last[step:], out=row[:-step])
            self.rows.append(row)

    def between(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The least of the values from a to b, b left out; a < b."""
        level = np.frexp((b - a).astype(np.float64))[1] - 1
        out = np.empty(len(a), dtype=self.rows[0].dtype)
        for k in np.unique(level).tolist():
            at = level == k
            out[at] = np.minimum(self.rows[k][a[at]], self.rows[k][b[at] - (1 << k)])
        return out

    def next_smaller(self, ends: np.ndarray) -> np.ndarray:
        """For each place the next one of a smaller value before ``ends``, or ``ends``. Values from there on are larger ones of other texts."""
        values, out = self.rows[0], ends.copy()
        i = np.arange(len(values))
        j = i + 1
        for row_at, row in enumerate(self.rows):
            i, j = i[j < ends[i]], j[j < ends[i]]
            hit = row[j] < values[i]
            found, at = i[hit], j[hit]
            for k in range(row_at - 1, -1, -1):
                at = at + ((self.rows[k][at] >= values[found]).astype(np.int64) << k)
            out[found] = at
            i, j = i[~hit], j[~hit] + (1 << row_at)
        return out


def ranked(letters: np.ndarray, owner: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """The rank of each suffix, texts one after another and a text's shorter suffix before longer ones it begins; and ranks by the first 1, 2, 4, ... letters.

    A rank is the number of suffixes before its group of equals, so groups that are told apart keep their place.
    """
    n = len(letters)
    order = np.argsort(letters)
    order = order[np.argsort(owner[order], kind="stable")]
    new = np.ones(n, dtype=bool)
    new[1:] = (letters[order[1:]] != letters[order[:-1]]) | (owner[order[1:]] != owner[order[:-1]])
    first = np.flatnonzero(new)
    size = np.diff(np.append(first, n))
    rank = np.empty(n, dtype=np.int64)
    rank[order] = np.repeat(first, size)
    levels, alike, width = [rank.astype(np.int32)], order[np.repeat(size > 1, size)], 1
    while len(alike):
        ahead = alike + width
        key = rank[alike] * (n + 1) + np.where(ahead < ends[alike], rank[np.minimum(ahead, n - 1)] + 1, 0)
        by = np.argsort(key)
        alike, key = alike[by], key[by]
        old, at = rank[alike], np.arange(len(alike))
        group, part = np.ones(len(alike), dtype=bool), np.ones(len(alike), dtype=bool)
        group[1:], part[1:] = old[1:] != old[:-1], key[1:] != key[:-1]
        rank[alike] = old + np.maximum.accumulate(np.where(part, at, 0)) - np.maximum.accumulate(np.where(group, at, 0))
        levels.append(rank.astype(np.int32))
        size = np.diff(np.append(np.flatnonzero(part), len(alike)))
        alike = alike[np.repeat(size > 1, size)]
        width *= 2
    return rank, levels


class Common:
    """Lengths of common prefixes of suffixes of one text, as minima of the LCP array."""

    def __init__(self, rank: np.ndarray, levels: list[np.ndarray]):
        self.rank, n = rank, len(rank)
        suffixes = np.empty(n, dtype=np.int64)
        suffixes[rank] = np.arange(n)
        at = np.flatnonzero(levels[0][suffixes[1:]] == levels[0][suffixes[:-1]]) + 1
        a, b = suffixes[at - 1], suffixes[at]
        length = np.zeros(len(at), dtype=np.int64)
        for k in range(len(levels) - 1, -1, -1):
            x, y = a + length, b + length
            same = np.maximum(x, y) < n
            same[same] = levels[k][x[same]] == levels[k][y[same]]
            length += same.astype(np.int64) << k
        lcp = np.zeros(n, dtype=np.int32)
        lcp[at] = length
        self.minima = Minima(lcp)

    def __call__(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        a, b = self.rank[i], self.rank[j]
        return self.minima.between(np.minimum(a, b) + 1, np.maximum(a, b) + 1).astype(np.int64)


def runs_of(letters: np.ndarray, owner: np.ndarray, n_texts: int, least: int = LEAST, times: int = TIMES) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, period) of all runs with ``least`` letters and ``times`` periods (2 at least), by start and period; places count over all texts."""
    none = np.zeros(0, dtype=np.int64)
    if not len(letters):
        return none, none, none
    n, counts = len(letters), np.bincount(owner, minlength=n_texts)
    stop = np.cumsum(counts)
    ends, starts = stop[owner], (stop - counts)[owner]
    narrow = owner.astype(np.uint16) if n_texts < 1 << 16 else owner
    rank, levels = ranked(letters, narrow, ends)
    reverse, _ = ranked(~letters, narrow, ends)
    i = np.tile(np.arange(n), 2)
    j = np.concatenate([Minima(rank).next_smaller(ends), Minima(reverse).next_smaller(ends)])
    right, left = j < ends[i], i > starts[i]
    right[right] = letters[i[right]] == letters[j[right]]
    left[left] = letters[i[left] - 1] == letters[j[left] - 1]
    some = np.flatnonzero((right | left) & (times * (j - i) <= counts[owner[i]]))
    if not len(some):
        return none, none, none
    i, j, right, left = i[some], j[some], right[some], left[some]
    begin, end = i.copy(), j.copy()
    end[right] += Common(rank, levels)(i[right], j[right])
    back = (n_texts - 1 - owner[::-1]).astype(narrow.dtype)
    backwards = Common(*ranked(letters[::-1], back, n - starts[::-1]))
    begin[left] -= backwards(n - i[left], n - j[left])
    keep = (end - begin >= least) & (end - begin >= times * (j - i))
    found = np.unique(np.stack([begin[keep], (j - i)[keep], end[keep]], axis=1), axis=0)
    return found[:, 0], found[:, 2], found[:, 1]


RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
FOUND = "id bigint, n_words bigint, runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string"


def _found(least: int, times: int):
    def run(batches):
        for batch in batches:
            for first, data, offsets in chunks(batch.column(1)):
                n = len(offsets) - 1
                a, b, owner = spans(data, offsets, ~SPACE[data])
                start, end, period = runs_of(hashed(data, a, b), owner, n, least, times)
                counts = np.bincount(owner, minlength=n)
                begin = np.cumsum(counts) - counts
                of = owner[start]
                at = np.zeros(n + 1, dtype=np.int32)
                np.cumsum(np.bincount(of, minlength=n), out=at[1:])
                runs = pa.ListArray.from_arrays(pa.array(at), pa.StructArray.from_arrays([pa.array(start - begin[of]), pa.array(end - start), pa.array(period)], fields=list(RUN)))
                gone = np.zeros(len(a) + 1, dtype=np.int64)
                np.add.at(gone, start + period, 1)
                np.add.at(gone, end, -1)
                kept, repeated = np.cumsum(gone[:-1]) == 0, np.diff(at) > 0
                texts = []
                for k in range(n):
                    words = data[offsets[k] : offsets[k + 1]].tobytes().split()
                    if repeated[k]:
                        words = [w for w, stays in zip(words, kept[begin[k] : begin[k] + len(words)].tolist(), strict=True) if stays]
                    texts.append(b" ".join(words))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, n), pa.array(counts.astype(np.int64)), runs, pa.array(texts, pa.binary()).cast(pa.string())], names=["id", "n_words", "runs", "collapsed"])
    return run


def find_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST, times: int = TIMES) -> DataFrame:
    """One row per input row: id, n_words, runs (by start, then period) and collapsed: the words that aren't in a run after its first period, joined by one space."""
    ship(docs.sparkSession)
    if times < 2:
        raise ValueError("a run has two periods at least")
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(_found(least, times), FOUND).withColumnRenamed("id", id_col)


def repeating(words: list[bytes], h: int) -> list[bytes]:
    """Words whose tail repeats a piece of itself, for one in ten values of h: from a on with period p."""
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + i % p] for i in range(n - a)]


def _planted(batches):
    for batch in batches:
        out = []
        for i, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            h = 1 if i is None else zlib.crc32(str(i).encode())
            out.append(text.as_py() if h % 10 else b" ".join(repeating((text.as_py() or "").encode().split(), h)).decode())
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.string())], names=["doc_id", "text"])


def planted(docs: DataFrame) -> DataFrame:
    """(doc_id, text): where the checksum of the id ends in 0, with words from some place on repeated in turn. A null id changes nothing."""
    ship(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(_planted, "doc_id bigint, text string")


def op13_periodic_runs(spark, sf_dir: str) -> DataFrame:
    found = find_runs(planted(parquet(spark, sf_dir, "documents")))
    none = F.lit(None).cast("struct<start: bigint, length: bigint, period: bigint>")
    longer = lambda best, r: F.when(best.isNull() | (r["length"] * best["period"] > best["length"] * r["period"]), r).otherwise(best)
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    text = F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    rows = found.select("doc_id", F.size("runs").cast("bigint").alias("n_runs"), F.aggregate("runs", none, longer).alias("best"), F.sha2(text, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
    return rows.select(
        "doc_id", "n_runs", "best.start", "best.length", "best.period", F.expr("best.length * 1000 div best.period").alias("exponent_milli"), "runs_sha256", "collapsed_sha256")
