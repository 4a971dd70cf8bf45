"""Mixture-controlled packing by deficit round-robin over source queues.

Every source is a queue of token ids, its documents one after another, each with an end id. Queues
are served in turns of ``quantum`` tokens. A queue earns credit in proportion to its target weight,
a turn costs a quantum, and the queue that can pay first is served; what a queue has earned and not
spent, its deficit, goes on to the next window and the next partition. Served turns, end to end, are
cut into windows of ``window`` tokens, so each window has the target proportions to within a quantum
a queue, and only the last window is short. A queue that runs dry drops out; the others keep their
proportions to one another.

The turn in which a queue is served doesn't depend on what is in it: turn j of a queue of weight w
is due at (2j-1)/w, so its place is a count over the other queues (see ``Schedule``). Partitions
therefore compute the same schedule independently. Besides it they need where their documents begin
in their queues: sums per partition and queue, running over partitions.

Defined cases: a null text is empty and has its end id alone; a null source is a queue of its own; a
null id is kept; repeated rows are packed each; an empty table gives no rows; a long document is cut
over as many windows as it needs; other columns of the input are not touched.
"""

from __future__ import annotations

import base64
import hashlib
import json

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import parquet, ship, written

WINDOW, QUANTUM, END = 1024, 256, 0
#: Without given weights, a queue's target is its share of all tokens to this power: rarer sources are served a little earlier.
POWER = 0.9
#: Rows of the table of running sums, one per input split and queue, up to which it is broadcast; beyond, it is joined.
BROADCAST_ROWS = 200_000
SLICE_TOKENS = 1 << 20
_ENCODERS: dict[str, object] = {}


def encoder(path: str):
    """Text to an array of ids. The vocabulary beside ``path`` as a faster library reads it; ids are those of the file named.

    ``path`` is a tokenizer file of the `tokenizers` library. Where the same vocabulary lies beside
    it as ranks (.tiktoken), that is read, as it gives the same ids in a quarter of the time.
    """
    if path not in _ENCODERS:
        ranks = path.removesuffix(".json") + ".tiktoken"
        try:
            import public_tokenizers
            import tiktoken

            with open(ranks, "rb") as f:
                table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            with open(path, encoding="utf-8") as f:  # a token that the file adds is one id wherever its text occurs
                added = {t["content"]: t["id"] for t in json.load(f).get("added_tokens", ())}
            made = tiktoken.Encoding(hashlib.md5(ranks.encode()).hexdigest(), pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens=added)
            _ENCODERS[path] = lambda text: made.encode_to_numpy(text, allowed_special="all")
        except (ImportError, FileNotFoundError):
            from tokenizers import Tokenizer

            plain = Tokenizer.from_file(path)
            _ENCODERS[path] = lambda text: np.array(plain.encode(text, add_special_tokens=False).ids, dtype=np.uint32)
    return _ENCODERS[path]


class Schedule:
    """Where each turn of each queue lies in the stream of all windows.

    Queues are numbered by falling number of turns. Then those of one weight that still have a turn
    are the first of them, so turns are counted by weight, with running sums, and not by queue. Weights
    are whole numbers with a sum near 2**20, so there are at most some 1,450 different ones,
    however many queues there are.
    """

    def __init__(self, tokens: list[int], weights: list[int], quantum: int):
        self.quantum, self.tokens, self.weights = quantum, np.array(tokens, dtype=np.int64), np.array(weights, dtype=np.int64)
        turns = -(-self.tokens // quantum)
        order = np.argsort(-turns, kind="stable")
        self.number = np.empty(len(order), dtype=np.int64)  # of each queue as given
        self.number[order] = np.arange(len(order))
        self.by_weight = []
        numbered, weighed = turns[order], self.weights[order]
        for w in np.unique(weighed):
            members = np.flatnonzero(weighed == w)
            up = numbered[members][::-1]
            self.by_weight.append((int(w), members, up, np.concatenate([[0], np.cumsum(up)])))
        live = np.flatnonzero(turns > 0)
        rank = self._rank(live, turns[live])
        short = (turns * quantum - self.tokens)[live]
        at = np.argsort(rank, kind="stable")
        self.end_ranks = rank[at]
        self.end_short = np.concatenate([[0], np.cumsum(short[at])])

    def _rank(self, s: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many turns are due before turns j (from 1) of queues s; of equal ones the lower number's is first."""
        due, own, number = 2 * j.astype(np.int64) - 1, self.weights[s], self.number[s]
        rank = np.zeros(len(due), dtype=np.int64)
        for w, members, up, total in self.by_weight:
            # turns i with (2i-1) * own < due * w, and with <= for those of a lower number; its own come to j-1
            before, upto = -(-(due * w) // own) // 2, -(-(due * w + 1) // own) // 2
            few = np.searchsorted(up, before)
            rank += total[few] + (len(up) - few) * before
            equal = np.flatnonzero(upto > before)
            if len(equal):
                have = len(up) - np.searchsorted(up, upto[equal])
                rank[equal] += np.minimum(have, np.searchsorted(members, number[equal]))
        return rank

    def position(self, s: np.ndarray, j: np.ndarray) -> np.ndarray:
        """The tokens of the whole stream at which turns j of queues s begin."""
        rank = self._rank(s, j)
        return rank * self.quantum - self.end_short[np.searchsorted(self.end_ranks, rank, side="left")]


def whole_weights(shares: list[float]) -> list[int]:
    """Shares as whole numbers up to 2**20, 1 at least."""
    total = sum(shares) or 1.0
    return [max(1, round(x / total * (1 << 20))) for x in shares]


def _tokenised(path: str, end_id: int):
    def run(batches):
        from pyspark import TaskContext

        encode, split = encoder(path), TaskContext.get().partitionId()
        seen: dict[str, int] = {}
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                ids, queues, counts, begins = [], [], [], []
                for text, source in zip(part.column(1).to_pylist(), part.column(2).to_pylist(), strict=True):
                    got = np.append(encode(text or ""), end_id).astype("<u4")
                    queue = "null" if source is None else f"s:{source}"
                    ids.append(got.astype("<u2").tobytes() if end_id < 65536 and (not len(got) or got.max() < 65536) else b"\xff" + got.tobytes())
                    queues.append(queue)
                    counts.append(len(got))
                    begins.append(seen.get(queue, 0))
                    seen[queue] = begins[-1] + len(got)
                n = part.num_rows
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(queues), pa.array([split] * n, pa.int32()), pa.array(begins, pa.int64()), pa.array(counts, pa.int64()), pa.array(ids, pa.binary())],
                    names=["doc_id", "queue", "split", "begin", "doc_tokens", "ids"])
    return run


def unpacked(data: bytes) -> np.ndarray:
    """The ids in a stored cell: 16 bits each, or, after a byte more, 32."""
    if len(data) % 2:
        return np.frombuffer(data, dtype="<u4", offset=1)
    return np.frombuffer(data, dtype="<u2").astype("<u4")


def _run_starts(count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For runs of these lengths end to end: each element's run, and its place in it."""
    run = np.repeat(np.arange(len(count)), count)
    return run, np.arange(len(run)) - (np.cumsum(count) - count)[run]


def _pieces(queue: np.ndarray, a: np.ndarray, b: np.ndarray, schedule: Schedule, window: int) -> tuple[np.ndarray, ...]:
    """(document, start in it, length, place in the stream) of all pieces of documents that lie from a to b in their queues."""
    quantum = schedule.quantum
    doc, k = _run_starts((b - 1) // quantum - a // quantum + 1)
    j = a[doc] // quantum + 1 + k
    lo, hi = np.maximum(a[doc], (j - 1) * quantum), np.minimum(b[doc], j * quantum)
    at = schedule.position(queue[doc], j) + lo - (j - 1) * quantum
    end = at + hi - lo
    turn, k = _run_starts((end - 1) // window - at // window + 1)  # turns cut at the ends of windows
    w = at[turn] // window + k
    place, stop = np.maximum(at[turn], w * window), np.minimum(end[turn], (w + 1) * window)
    doc, start = doc[turn], lo[turn] + place - at[turn] - a[doc[turn]]
    # neighbours in a document, in the stream and in a window are one piece
    first = np.ones(len(doc), dtype=bool)
    first[1:] = (doc[1:] != doc[:-1]) | (place[1:] != stop[:-1]) | (w[1:] != w[:-1])
    first = np.flatnonzero(first)
    return doc[first], start[first], np.add.reduceat(stop - place, first) if len(first) else first, place[first]


def _cut(queues: dict[str, int], schedule: Schedule, window: int):
    def run(batches):
        for whole in batches:
            ends, i = np.cumsum(whole.column(4).to_numpy()), 0
            while i < whole.num_rows:  # some SLICE_TOKENS at a time, one document at least
                stop = max(i + 1, int(np.searchsorted(ends, (ends[i - 1] if i else 0) + SLICE_TOKENS, side="right")))
                batch, i = whole.slice(i, stop - i), stop
                queue = np.array([queues[q] for q in batch.column(1).to_pylist()], dtype=np.int64)
                begin, base, n = (batch.column(c).to_numpy() for c in (2, 3, 4))
                doc, start, length, place = _pieces(queue, begin + base, begin + base + n, schedule, window)
                # pieces of a document are in its order and leave nothing out, so their ids lie end to end as they are
                ids = np.concatenate([unpacked(x) for x in batch.column(5).to_pylist()])
                offsets = np.zeros(len(doc) + 1, dtype=np.int32)
                np.cumsum(length * 4, out=offsets[1:])
                cells = pa.Array.from_buffers(pa.binary(), len(doc), [None, pa.py_buffer(offsets), pa.py_buffer(ids)])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(doc)), *(pa.array(c) for c in (start, length, n[doc], place // window, place % window)), cells],
                    names=["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"])
    return run


def pack(docs: DataFrame, tokenizer: str, weights: dict[str, float] | None = None, window: int = WINDOW, quantum: int = QUANTUM, end_id: int = END, power: float = POWER,
         id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """One row per piece: doc_id, start, length, doc_tokens, sequence_id, offset, ids (32-bit little-endian).

    ``weights`` are target shares by source (null: None as key); without them, and for sources not
    named, the target is the source's share of all tokens to ``power`` (1: no queue runs dry early).
    Documents are read once; their ids are written to the shared folder, 2 bytes a token.
    """
    spark = docs.sparkSession
    ship(spark)
    docs = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"), F.col(source_col).cast("string").alias("source"))
    ids = written(docs.mapInArrow(_tokenised(tokenizer, end_id), "doc_id bigint, queue string, split int, begin bigint, doc_tokens bigint, ids binary"))
    sums = ids.groupBy("queue", "split").agg(F.sum("doc_tokens").alias("n"))
    totals = sorted((r.queue, r.n) for r in sums.groupBy("queue").agg(F.sum("n").alias("n")).collect())
    named = {("null" if k is None else f"s:{k}"): v for k, v in (weights or {}).items()}
    whole = sum(n for _, n in totals) or 1
    schedule = Schedule([n for _, n in totals], whole_weights([named.get(q, (n / whole) ** power) for q, n in totals]), quantum)
    before = Window.partitionBy("queue").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    bases = sums.select("queue", "split", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    rows = sums.count()
    placed = ids.join(F.broadcast(bases) if rows <= BROADCAST_ROWS else bases, ["queue", "split"])
    cut = _cut({q: i for i, (q, _) in enumerate(totals)}, schedule, window)
    return placed.select("doc_id", "queue", "begin", "base", "doc_tokens", "ids").mapInArrow(
        cut, "doc_id bigint, start bigint, length bigint, doc_tokens bigint, sequence_id bigint, offset bigint, ids binary")


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_mixture_packing(spark, sf_dir: str) -> DataFrame:
    pieces = pack(parquet(spark, sf_dir, "documents"), vocabulary())
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
